"""One row per key and key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order_by: list[str | Column], last: bool = False) -> DataFrame:
    """First (or last) row per key in `order_by`.

    Spark limits each key within a task before the shuffle, so a key with many copies sends at most
    one row per task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    order = [c.desc_nulls_last() if last else c.asc_nulls_first() for c in order]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with the count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def key_check(df: DataFrame, keys: list[str], not_null: list[str] = ()) -> DataFrame:
    """One row of figures: rows, keys, surplus rows, rows with a NULL in the key or `not_null`."""
    required = list(dict.fromkeys([*keys, *not_null]))
    has_null = F.lit(False)
    for c in required:
        has_null = has_null | F.col(c).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(has_null).alias("nulls"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_rows"),
    )


def require_key(df: DataFrame, keys: list[str], not_null: list[str] = ()) -> None:
    """Fail on a repeated key or a NULL."""
    found = key_check(df, keys, not_null).first()
    if found.surplus_rows or found.null_rows:
        raise ValueError(f"key {keys}: {found.surplus_rows} repeated rows, {found.null_rows} rows with NULL")
