"""NDJSON line scan and line numbers (A1, A3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadkit.schemas import POSITION
from loadkit.session import broadcast_checked, stage

_BLOCK = ["file", "block"]
_RANGES = 64


def line_text(value: Column, keep_cr: bool = False, bad_utf8: str = "replace") -> Column:
    """Text of a physical line: one trailing CR dropped, an empty line NULL."""
    value = F.validate_utf8(value) if bad_utf8 == "fail" else F.make_valid_utf8(value)
    if keep_cr:
        return value
    value = F.when(F.endswith(value, F.lit("\r")), F.substring(value, F.lit(1), F.length(value) - 1)).otherwise(value)
    return F.nullif(value, F.lit(""))


def scan_lines(
    spark: SparkSession, path: str | list[str], keep_cr: bool = False, bad_utf8: str = "replace", sep: str = "\n", among: Column | None = None,
) -> DataFrame:
    """One row per physical line; only LF ends a line, an empty line is NULL (A1).

    `keep_cr` leaves carriage returns and empty lines alone for the repair jobs, and adds `bytes`, the line's with
    its end, and `size`, the file's: their sum over a file is `size` if the last line is ended too. Invalid UTF-8 is
    replaced, or stops the job with `bad_utf8="fail"`. `sep` is another line end, `among` a condition on the files' `_metadata`.
    """
    text = spark.read.option("lineSep", sep).text(path)
    text = text if among is None else text.filter(among)
    whole = [(F.octet_length("value") + len(sep)).cast("bigint").alias("bytes"), F.col("_metadata.file_size").alias("size")]
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        line_text(F.col("value"), keep_cr, bad_utf8).alias("line"),
        *(whole if keep_cr else []),
    )


def block_offsets(df: DataFrame) -> DataFrame:
    """Lines before each input split, without a window over all of them.

    One short row per split is counted with map-side combine, range-partitioned into a fixed number
    of pieces and summed within each; only the piece totals (at most _RANGES rows) meet in one task.
    """
    counts = df.groupBy(*_BLOCK).agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    counts = counts.repartitionByRange(_RANGES, *_BLOCK).withColumn("piece", F.spark_partition_id())
    counts = stage(counts, "splits")
    earlier = Window.unboundedPreceding, -1
    within = Window.partitionBy("piece").orderBy(*_BLOCK).rowsBetween(*earlier)
    across = Window.orderBy("piece").rowsBetween(*earlier)
    totals = counts.groupBy("piece").agg(F.sum("n").alias("n"))
    totals = totals.select("piece", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("base"))
    return (
        counts.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(totals), "piece")
        .select(*_BLOCK, (F.col("base") + F.col("before") - F.col("first") + 1).alias("shift"))
    )


def line_offsets(df: DataFrame) -> DataFrame:
    """Staged `block_offsets` of all lines, to number several parts of them."""
    return stage(block_offsets(df), "offsets")


def number_in_file(df: DataFrame) -> DataFrame:
    """`line_no`, 1-based within each file, of staged lines with their POSITION."""
    offsets = block_offsets(df)
    first = offsets.join(df.groupBy(*_BLOCK).agg(F.min("pos").alias("pos")), _BLOCK)
    first = first.groupBy("file").agg(F.min(F.col("pos") + F.col("shift") - 1).alias("base"))
    shifts = stage(offsets.join(first, "file").select(*_BLOCK, (F.col("shift") - F.col("base")).alias("shift")), "offsets")
    return number_lines(df, shifts)


def number_lines(df: DataFrame, offsets: DataFrame | None = None, column: str = "line_no") -> DataFrame:
    """Dense 1-based line numbers in file order (A3).

    `offsets`, from `line_offsets` over every line, is needed when `df` is only a part of them. Lines
    already staged keep their POSITION; straight from `scan_lines` the splits must be the same in
    both passes, which `configure` sees to. Lines are not shuffled: the offsets are joined to them.
    """
    offsets = line_offsets(df) if offsets is None else offsets
    return (
        df.join(broadcast_checked(offsets), _BLOCK)
        .withColumn(column, F.col("pos") + F.col("shift"))
        .drop("shift")
    )
