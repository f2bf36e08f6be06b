"""The corpus pipeline: documents through five of the operators of frameml.llm.

Every stage takes what its predecessor kept; all but the last return the
columns of documents.  ``run`` applies them in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.llm.decontamination import drop_contaminated
from frameml.llm.jaccard_join import jaccard_components
from frameml.llm.packing import pack_documents, vocabulary_path, vocabulary_special
from frameml.llm.pii import redact
from frameml.llm.quality import THRESHOLD, fit_quality, score_quality
from frameml.plans.lineage import cut_lineage, join_summary
from frameml.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose quality score is below the threshold.  The rules
    are learnt from the labelled documents among those given."""
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    name = "quality_score"
    while name in docs.columns:
        name += "_"
    return score_quality(docs, model, score=name).where(F.col(name) >= THRESHOLD).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of documents linked by a similarity of
    0.8 or more over five-word shingles.  Of several rows of one id the least one stays (by
    the columns in order).  Rows without id, which link with nothing, stay; so do null and empty texts."""
    groups = cut_lineage(jaccard_components(docs, width=5, percent=80))
    gone = cut_lineage(groups.where("doc_id <> component_id").select("doc_id").distinct())
    kept = join_summary(docs, gone, "doc_id", "left_anti").select(*docs.columns)
    many = cut_lineage(groups.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"))
    if many.isEmpty():
        return kept
    row = F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    least = join_summary(kept, many, "doc_id", "left_semi").groupBy("doc_id").agg(row.alias("row")).select("row.*")
    return join_summary(kept, many, "doc_id", "left_anti").select(*docs.columns).union(least.select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold an item of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind; n_chars follows the new text."""
    out = redact(docs)
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token ids of all documents into sequences of 2048; a null or empty text is its closing id alone."""
    return pack_documents(docs, vocabulary_path(), special=vocabulary_special())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Rule fitting, edit distances and token ids have no SQL twin; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
