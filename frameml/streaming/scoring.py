"""Scoring on streams.

Every ``*_predict`` and ``*_transform`` operator is a projection, so it takes
a streaming DataFrame as it is.  These helpers read a folder as a stream and
write the scored rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def read_stream(spark: SparkSession, path: str, schema, pattern: str | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; ``pattern`` picks file names."""
    reader = spark.readStream.schema(schema)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def score_available(stream: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, state: str) -> None:
    """Score what the stream holds now and append it to ``out`` as Parquet.
    ``state`` is the query's checkpoint folder; a rerun continues there."""
    query = (score(stream).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", state).trigger(availableNow=True).start())
    query.awaitTermination()
