"""Batched fact loads (S1-S3; P7, P8): resumable, with progress per batch.

Each batch adds a folder `rows/batch=N/outcome=...` below the work folder, written in overwrite mode,
so repeating a batch after a failure changes nothing. The target is not rewritten per batch: the
rows of all batches are merged into it once, at the end, or whenever `merge_batches` is called.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.operators.keys import keep_one
from loadkit.operators.upsert import one_per_key, upsert_table
from loadkit.plans.common import ACCEPTED, ORPHAN, REJECTED
from loadkit.plans.facts import Fact
from loadkit.schemas import PROGRESS
from loadkit.session import broadcast_checked, stage
from loadkit.sinks import conform, exists, publish
from loadkit.sources.lines import POSITION, line_text, number_in_file, number_lines


def _batches(spark: SparkSession, fact: Fact, work: str, outcome: str) -> DataFrame:
    """Rows of one outcome in all finished batches, with `batch`."""
    if not exists(spark, f"{work}/rows"):
        return spark.createDataFrame([], _row_schema(fact))
    rows = spark.read.schema(_row_schema(fact)).parquet(f"{work}/rows")
    done = progress(spark, work).select(F.col("batch"))
    return rows.filter(F.col("outcome") == outcome).join(broadcast_checked(done), "batch", "left_semi")


def _row_schema(fact: Fact) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fact.table.schema)
    return f"file string, block bigint, pos bigint, line_no bigint, line string, {columns}, reason string, batch bigint, outcome string"


def progress(spark: SparkSession, work: str) -> DataFrame:
    """One row per finished batch (S3)."""
    if not exists(spark, f"{work}/progress"):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).parquet(f"{work}/progress")


def progress_view(spark: SparkSession, work: str) -> DataFrame:
    """State of the load: start, last update, lines, affected rows, percent (S3)."""
    done = progress(spark, work)
    return done.agg(
        F.min("started_at").alias("started_at"),
        F.max("updated_at").alias("updated_at"),
        F.max("total_lines").alias("total_lines"),
        F.coalesce(F.max("processed_lines"), F.lit(0)).alias("processed_lines"),
        F.coalesce(F.sum("inserted_rows"), F.lit(0)).alias("inserted_rows"),
        (F.max("processed_lines") * 100.0 / F.max("total_lines")).alias("percent"),
    )


def run_batch(
    lines: DataFrame, batch: int, fact: Fact, parent: DataFrame, work: str, orphans: str = "divert",
    on_dup: str | None = None, total: int | None = None, before: int | None = None, **options,
) -> int:
    """Classify one batch of lines (POSITION, `line`, perhaps `line_no`), store it, record progress.

    The lines are parsed once; one write holds accepted rows, orphans and rejects apart. `before` is the
    number of lines in earlier batches, looked up if not given. Returns the lines up to and with this batch.
    """
    spark = lines.sparkSession
    started = dt.datetime.now(dt.timezone.utc)
    target = f"{work}/rows/batch={batch}"
    judged = fact.judged(lines.withColumn("pos", F.col("line_no")) if "line_no" in lines.columns else lines, parent, **options)
    if "line_no" in lines.columns:
        # The load keeps the position, so the number takes the place of the counter in it.
        judged = judged.withColumn("line_no", F.col("pos"))
    else:
        judged = judged.withColumn("line_no", F.lit(None).cast("bigint"))
    if orphans == "fail":
        message = F.concat(F.lit("no parent for "), F.col(fact.table.parent_key).cast("string"))
        judged = judged.withColumn("outcome", F.when(F.col("outcome") == ORPHAN, F.raise_error(message)).otherwise(F.col("outcome")))
    judged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("outcome").parquet(target)
    stored = spark.read.schema(_row_schema(fact)).parquet(target)
    accepted = stored.filter(F.col("outcome") == ACCEPTED)
    keys = list(fact.table.key)
    if on_dup == "error":
        one_per_key(accepted, keys, "error")
    figures = stored.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct(F.when(F.col("outcome") == ACCEPTED, F.struct(*keys))).alias("affected"),
    ).first()
    if before is None:
        before = progress(spark, work).filter(F.col("batch") < batch).agg(F.max("processed_lines")).first()[0] or 0
    row = (batch, started, dt.datetime.now(dt.timezone.utc), total, before + figures.lines, figures.affected)
    entry = spark.createDataFrame([row], PROGRESS).drop("batch")
    entry.coalesce(1).write.mode("overwrite").parquet(f"{work}/progress/batch={batch}")
    return before + figures.lines


def merge_batches(spark: SparkSession, fact: Fact, work: str, root: str, policy: str | None = None, mode: str = "refresh",
                  partition_by: str | None = None) -> str:
    """Merge the accepted rows of all finished batches into the table with one shuffle.

    With `replace` the last line of a key wins, across batches as within one; with `keep` the first.
    """
    policy = policy or fact.policy
    order = ["batch", *POSITION]
    rows = _batches(spark, fact, work, ACCEPTED)
    keys = list(fact.table.key)
    on_dup = "first" if policy == "keep" else "last"
    if mode == "upsert":
        # Batches merged by an earlier call are not merged again.
        highest = progress(spark, work).agg(F.max("batch")).first()[0]
        seen = f"{work}/merged"
        last = spark.read.schema("batch bigint").parquet(seen).agg(F.max("batch")).first()[0] if exists(spark, seen) else None
        if highest is None or last is not None and last >= highest:
            return root
        rows = rows.filter(F.col("batch") <= highest)
        if last is not None:
            rows = rows.filter(F.col("batch") > last)
        upsert_table(root, rows, fact.table.schema, keys, policy, on_dup=on_dup, order_by=order, partition_by=partition_by)
        spark.createDataFrame([(highest,)], "batch bigint").write.mode("append").parquet(seen)
        return root
    merged = keep_one(rows, keys, order, last=policy != "keep")
    return publish(conform(merged, fact.table.schema), root, [partition_by] if partition_by else None)


def batch_orphans(spark: SparkSession, fact: Fact, work: str) -> DataFrame:
    """Rows without a parent in all finished batches (A9). Streamed ones have their number within the file and its name."""
    return _batches(spark, fact, work, ORPHAN).select("line_no", *fact.table.columns, F.col("line").alias("raw_line"), "batch", "file")


def batch_rejects(spark: SparkSession, fact: Fact, work: str) -> DataFrame:
    """Rejected lines in all finished batches (A7). Streamed ones have their number within the file and its name."""
    return _batches(spark, fact, work, REJECTED).select("line_no", "line", "reason", "batch", "file")


def load_in_batches(
    spark: SparkSession, lines: DataFrame, fact: Fact, root: str, parent: DataFrame, work: str, batch_lines: int = 500_000,
    policy: str | None = None, mode: str = "refresh", partition_by: str | None = None, merge_every: int | None = None, **options,
) -> DataFrame:
    """Load lines in slices of `batch_lines`, then merge. Returns the progress view.

    With mode `upsert` the batches are merged into the table after every `merge_every` of them (1 by default
    when it is partitioned, else at the end only), so a run that fails keeps what it has merged. `refresh`
    replaces the table once, at the end.

    Lines are numbered and stored by slice first; a run that finds the same `work` folder goes on
    after the last finished batch. No lines: no batch, and the table is left alone.
    """
    staged = f"{work}/lines"
    if not exists(spark, f"{staged}/_SUCCESS"):
        # The dense number replaces the position: it sorts the same way and needs one column.
        numbered = number_lines(lines).withColumn("batch", F.floor((F.col("line_no") - 1) / batch_lines))
        numbered.select("line_no", "line", "batch").write.mode("overwrite").partitionBy("batch").parquet(staged)
    held = spark.read.schema("line_no bigint, line string, batch bigint").parquet(staged)
    total = held.agg(F.max("line_no")).first()[0]
    if not total:
        return progress_view(spark, work)
    if merge_every is None and mode == "upsert" and partition_by:
        merge_every = 1
    # Batches finish in order, so the first one to run follows the last finished.
    last = progress(spark, work).agg(F.max("batch"), F.max("processed_lines")).first()
    before, count = last[1] or 0, -(-total // batch_lines)
    for batch in range(0 if last[0] is None else last[0] + 1, count):
        rows = held.filter(F.col("batch") == batch).select(
            F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"), F.col("line_no").alias("pos"), "line", "line_no"
        )
        before = run_batch(rows, batch, fact, parent, work, total=total, before=before, **options)
        if mode == "upsert" and merge_every and (batch + 1) % merge_every == 0 and batch + 1 < count:
            merge_batches(spark, fact, work, root, policy, mode, partition_by)
    merge_batches(spark, fact, work, root, policy, mode, partition_by)
    return progress_view(spark, work)


def stream_fact(
    spark: SparkSession, folder: str, fact: Fact, root: str, parent: DataFrame, work: str, files_per_batch: int | None = None,
    bytes_per_batch: str | None = None, policy: str | None = None, mode: str = "refresh", partition_by: str | None = None, **options,
) -> DataFrame:
    """S1 over a folder of files: take what is there in micro-batches, then stop and merge.

    The checkpoint below `work` remembers the files taken, so a later call loads only new ones.
    """
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    raw = reader.text(folder).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        line_text(F.col("value")).alias("line"),
    )

    def each(batch: DataFrame, number: int) -> None:
        # Staged, so that both passes of the numbering see the same positions. A file is in one batch whole.
        held = stage(batch.withColumn("pos", F.monotonically_increasing_id()), "stream-lines")
        run_batch(number_in_file(held), number, fact, parent, work, **options)
        if mode == "upsert" and partition_by:
            merge_batches(spark, fact, work, root, policy, mode, partition_by)

    query = raw.writeStream.foreachBatch(each).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if not progress(spark, work).isEmpty():
        merge_batches(spark, fact, work, root, policy, mode, partition_by)
    return progress_view(spark, work)
