"""Inputs and helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.operators.matrix import MatrixTable, from_rows
from frameml.sources.tables import read_table

# Embedding cells, the SQL twin of ``embedding_matrix``.
CELLS = ("a as (select vec_id i, unnest(range(0, len(embedding))) j, unnest(embedding)::double v "
         "from embeddings)")

# Scaled lineitem features and label, the SQL twin of ``scaled_lineitem``.
LINES = "x as (select l_quantity/50 q, l_discount*10 p, l_extendedprice/1e5 y, l_returnflag, l_linestatus from lineitem)"

# Scaled event features, the SQL twin of ``scaled_events``.
EVENTS = "x as (select event_id, event_type, value/100 a, hour(ts)/24.0::double b from events)"


def rounded(col, digits: int = 6) -> Column:
    """Round and turn -0.0 into 0.0, so that equal results hash alike."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, digits) + F.lit(0.0)


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "embeddings")


def embedding_matrix(spark: SparkSession, folder: str) -> MatrixTable:
    return from_rows(embeddings(spark, folder), "vec_id", "embedding")


def reversed_matrix(spark: SparkSession, folder: str) -> MatrixTable:
    """Each embedding back to front: a second operand of the same shape."""
    table = embeddings(spark, folder).select("vec_id", F.reverse("embedding").alias("embedding"))
    return from_rows(table, "vec_id", "embedding")


def scaled_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        (F.col("l_quantity") / 50).alias("q"), (F.col("l_discount") * 10).alias("p"),
        (F.col("l_extendedprice") / 1e5).alias("y"), "l_returnflag", "l_linestatus")


def scaled_events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        "event_id", "event_type", (F.col("value") / 100).alias("a"), (F.hour("ts") / 24.0).alias("b"))
