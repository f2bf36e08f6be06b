"""Models as Parquet tables."""

from __future__ import annotations

from pyspark.sql import SparkSession


def save_model(spark: SparkSession, model, path: str, mode: str = "error") -> None:
    """Write the model's table; any object with ``to_df`` will do."""
    model.to_df(spark).coalesce(1).write.mode(mode).parquet(path)


def load_model(spark: SparkSession, kind, path: str, **options):
    """Read a model of class ``kind`` back (``d=`` for trees and boosting)."""
    return kind.from_df(spark.read.parquet(path), **options)
