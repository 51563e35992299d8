"""Session settings and cluster-safe scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may have before it is no longer broadcast by an explicit hint. The hinted frames
# hold one short row per input split (about 100 bytes), so this is at most some 50 MB.
BROADCAST_ROWS = 500_000


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on. Call it before building a plan."""
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.ansi.enabled", "true")
    # Last duplicate key wins; the flag is baked into a plan when it is analysed.
    conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # A reference check and the de-duplication after it may share one hot key: let the skewed
    # join split even though that costs another exchange.
    conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # The JVM does not compile methods beyond 8000 bytes of bytecode. A wide projection fused into one
    # such method runs interpreted; Spark's unfused form cuts it into small ones and is faster.
    conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # Outcomes of a load are few: write their files side by side instead of sorting every task first.
    conf.set("spark.sql.maxConcurrentOutputFileWriters", "8")
    # Input splits must not move when executors join or leave between two passes over a file.
    if conf.get("spark.sql.files.minPartitionNum", None) is None:
        conf.set("spark.sql.files.minPartitionNum", str(max(1, spark.sparkContext.defaultParallelism)))
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: spark.checkpoint.dir, else the context's checkpoint dir."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="loadkit-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


# Folders `stage` wrote: those of the scope at hand, or of the process outside any.
_STAGED: ContextVar[list[str]] = ContextVar("staged", default=[])


def drop_stages(spark: SparkSession) -> int:
    """Delete what `stage` wrote in the scope at hand; frames of loads in it must no longer be read."""
    staged = _STAGED.get()
    dropped = len(staged)
    while staged:
        where = spark._jvm.org.apache.hadoop.fs.Path(staged.pop())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return dropped


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Scope of a load: what is staged inside is deleted at its end, and nothing of other loads.

    Write what the load gives before the scope ends.
    """
    before = _STAGED.set([])
    try:
        yield
    finally:
        drop_stages(spark)
        _STAGED.reset(before)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    This cuts the lineage, so a lost executor costs a re-read and not a re-parse, and the columnar
    copy keeps column pruning for whatever reads it next.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/stage-{label}-{uuid.uuid4().hex}"
    _STAGED.get().append(path)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete what `stage` wrote for a frame that is no longer read."""
    spark, staged = df.sparkSession, _STAGED.get()
    folders = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    for path in [p for p in staged if p.rsplit("/", 1)[-1] in folders]:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        staged.remove(path)


def broadcast_checked(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting the rows; `df` should be staged."""
    return F.broadcast(df) if df.count() <= limit else df
