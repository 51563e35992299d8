"""Merging a batch into a target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.operators.keys import duplicate_keys, keep_one
from loadkit.session import stage
from loadkit.sinks import change_partitions, conform, current_path, publish, read_table


# Touched partitions up to which their values go into the scan's filter.
PRUNE_BY_LIST = 5000


def one_per_key(source: DataFrame, keys: list[str], on_dup: str = "last", order_by: list[str | Column] = ()) -> DataFrame:
    """Resolve keys that occur more than once in a batch (U4).

    `last` and `first` follow `order_by`; `error` fails at once when there are any.
    """
    if on_dup == "error":
        twice = duplicate_keys(source, keys).limit(1).collect()
        if twice:
            raise ValueError(f"key {tuple(twice[0])[:-1]} occurs {twice[0]['rows']} times in one batch")
        return source
    if not order_by:
        raise ValueError("order_by is needed to choose among rows with the same key")
    return keep_one(source, keys, list(order_by), last=on_dup == "last")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], policy: str = "replace", update_cols: list[str] | None = None) -> DataFrame:
    """Target after the merge. `source` has one row per key.

    `replace` takes the source's row (U1) or only its `update_cols` (U2), NULLs included; `keep`
    leaves a key that is already there alone (U3). Replacing whole rows and keeping need only the
    other side's keys in the join, which Spark broadcasts when the batch is small, so that a large
    target is not shuffled.
    """
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    if policy == "keep":
        new = source.join(target.select(*keys), keys, "left_anti")
        return target.unionByName(new.select(*columns))
    if policy != "replace":
        raise ValueError(f"unknown policy {policy!r}")
    if update_cols is None or set(rest) <= set(update_cols):
        return target.join(source.select(*keys), keys, "left_anti").select(*columns).unionByName(source.select(*columns))
    t, s = target.withColumn("__t", F.lit(True)).alias("t"), source.withColumn("__s", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    update = set(update_cols)
    picked = []
    for c in columns:
        if c in keys:
            picked.append(F.coalesce(f"t.{c}", f"s.{c}").alias(c))
        elif c in update:
            picked.append(F.when(F.col("s.__s"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in source.columns:
            picked.append(F.when(F.col("t.__t"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        else:
            picked.append(F.col(f"t.{c}").alias(c))
    return joined.select(*picked)


def upsert_counts(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """One row: affected, inserted and updated rows of merging `source`."""
    known = target.select(*keys).withColumn("__t", F.lit(True))
    joined = source.select(*keys).join(known, keys, "left")
    return joined.agg(
        F.count(F.lit(1)).alias("affected"),
        F.count_if(F.col("__t").isNull()).alias("inserted"),
        F.count_if(F.col("__t")).alias("updated"),
    )


def upsert_table(
    root: str,
    source: DataFrame,
    schema,
    keys: list[str],
    policy: str = "replace",
    update_cols: list[str] | None = None,
    on_dup: str = "last",
    order_by: list[str | Column] = (),
    partition_by: str | None = None,
) -> int:
    """Merge a batch into a stored table and return the affected rows.

    Without partitions the table is rewritten as a new version. With `partition_by`, one of the
    keys, only the partitions the batch touches are read and replaced, all of them or none: their merged rows
    are staged first, and a change that was broken off is finished by whoever opens the table next.
    """
    spark = source.sparkSession
    batch = stage(one_per_key(source, keys, on_dup, order_by), "batch")
    target = read_table(spark, root, schema)
    path = current_path(spark, root)
    if partition_by is None or path is None:
        merged = upsert(target, conform(batch, schema) if update_cols is None else batch, keys, policy, update_cols)
        publish(merged, root, [partition_by] if partition_by else None)
        return batch.count()
    if partition_by not in keys:
        raise ValueError("partition_by must be one of the keys")
    # One value per folder the batch will write; with ordinary numbers of them the scan is pruned by list.
    values = batch.select(partition_by).distinct()
    listed = [r[0] for r in values.limit(PRUNE_BY_LIST + 1).collect()]
    if len(listed) <= PRUNE_BY_LIST:
        touched = target.filter(F.col(partition_by).isin(listed))
    else:
        touched = target.join(values, partition_by, "left_semi").select(*target.columns)
    change_partitions(upsert(touched, batch, keys, policy, update_cols), root, partition_by)
    return batch.count()


def split_outcomes(df: DataFrame, outcome: str = "outcome") -> dict[str, DataFrame]:
    """One classified input, several outputs (U6): staged once, partitioned by outcome.

    Reading one outcome touches only its files, and the classification ran a single time.
    """
    staged = stage(df, "outcomes", [outcome])
    return {
        name: staged.filter(F.col(outcome) == name).drop(outcome) for name in ("accepted", "rejected", "orphan")
    } | {"all": staged}
