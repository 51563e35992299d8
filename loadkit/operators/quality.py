"""Counts, breakdowns and previews after a load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.functions.text import blank


def row_counts(**frames: DataFrame) -> DataFrame:
    """`name`, `cnt` per frame, counted in one job (G1)."""
    parts = [df.select(F.lit(name).alias("name")) for name, df in frames.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    names = union.sparkSession.createDataFrame([(n,) for n in frames], "name string")
    counted = union.groupBy("name").agg(F.count(F.lit(1)).alias("cnt"))
    return names.join(counted, "name", "left").select("name", F.coalesce("cnt", F.lit(0)).alias("cnt"))


def filtered_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """`total` and one count per condition in a single pass; conditions may overlap."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def key_quality(df: DataFrame, key: str, ok: Column) -> DataFrame:
    """Total, blank and malformed keys; an empty string counts as both."""
    malformed = F.col(key).isNotNull() & ~F.coalesce(ok, F.lit(False))
    return filtered_counts(df, blank_key=blank(key), bad_key=malformed)


def reject_breakdown(rejects: DataFrame, reason: str = "reason") -> DataFrame:
    """Rejects by reason, most frequent first."""
    counted = rejects.groupBy(reason).agg(F.count(F.lit(1)).alias("cnt"))
    return counted.orderBy(F.desc("cnt"), F.asc(reason))


def value_range(df: DataFrame, column: str, low: str = "min_date", high: str = "max_date") -> DataFrame:
    """Smallest and largest value."""
    return df.agg(F.min(column).alias(low), F.max(column).alias(high))


def highest(df: DataFrame, column: str = "line_no") -> DataFrame:
    """Largest value, NULL for no rows."""
    return df.agg(F.max(column).alias(column))


def preview(df: DataFrame, order_by: list[Column], n: int = 5) -> DataFrame:
    """First rows in an order; NULLs come last ascending and first descending, by the caller's order."""
    return df.orderBy(*order_by).limit(n)


def repair_metrics(df: DataFrame, **flags: Column) -> DataFrame:
    """Rows and sums of per-row flags or counters of a repair."""
    sums = [F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in flags.items()]
    return df.agg(F.count(F.lit(1)).alias("rows"), *sums)
