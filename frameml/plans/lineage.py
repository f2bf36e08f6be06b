"""Durable lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when its counted rows and their bytes stay below these.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64_000_000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.  A temporary folder is used only in
    local mode, where there is a single machine anyway."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="frameml-")
    sc.setCheckpointDir(folder)
    return folder


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames made inside drop the shuffle files of an action when it ends, not when the driver next
    happens to collect garbage.  For frames that are executed once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame to the shared checkpoint folder and continue from it.  The shuffle files that
    it was made from are dropped then."""
    shared_folder(df.sparkSession)
    with released_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def collect_small(df: DataFrame, limit: int):
    """All rows as an Arrow table, refusing more than ``limit`` of them."""
    got = df.limit(limit + 1).toArrow()
    if got.num_rows > limit:
        raise ValueError(f"more than {limit} rows where a small table was expected")
    return got


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: 8 for a number, the contents of texts and of arrays of them."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            more = F.octet_length(c)
        elif isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType,
                                                                                 T.StructType, T.MapType)):
            more = F.size(c) * 8
        elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            more = F.octet_length(F.to_json(F.struct(c)))
        else:
            more = F.lit(0)
        total = total + 8 + F.greatest(F.coalesce(more, F.lit(0)), F.lit(0)).cast("long")
    return total


def is_small(df: DataFrame, rows: int | None = None, size: int | None = None) -> bool:
    """Whether the frame has at most ``rows`` lines of ``size`` bytes in all; one job, stopped past the lines."""
    rows, size = BROADCAST_ROWS if rows is None else rows, BROADCAST_BYTES if size is None else size
    seen = df.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return seen[0] <= rows and (seen[1] or 0) <= size


def join_summary(rows: DataFrame, summary: DataFrame, on, how: str = "inner", limit: int | None = None) -> DataFrame:
    """Join rows with a summary holding one line per key.

    The summary is broadcast when it has at most ``limit`` lines and
    BROADCAST_BYTES bytes.  Beyond that the join shuffles and AQE splits hot
    keys on the row side, which is sound because the other side has one line
    per key.
    """
    return rows.join(F.broadcast(summary) if is_small(summary, limit) else summary, on, how)


class Rolling:
    """At most one live copy of a frame that is written again and again.

    Each copy goes to the shared checkpoint folder as Parquet, so it outlives executors; the one before is
    deleted when the new one is complete.  ``close`` deletes the last."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.at, self.number = spark, f"{shared_folder(spark)}/rolling-{uuid.uuid4().hex}", None, 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Write the frame, drop the copy before, go on from the new one."""
        at, self.number = f"{self.folder}/{self.number}", self.number + 1
        df.write.parquet(at)
        self._delete(self.at)
        self.at = at
        return self.spark.read.schema(df.schema).parquet(at)

    def close(self) -> None:
        self._delete(self.folder)
        self.at = None

    def _delete(self, at: str | None) -> None:
        if at is not None:
            sc = self.spark.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
