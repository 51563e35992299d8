"""Fact loads from NDJSON."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.functions.casts import metric_or_null, metric_or_zero, month_start, strict_key, to_timestamptz_loose
from loadkit.functions.json import parse_records
from loadkit.functions.text import blank, cross_fill
from loadkit.operators import classify
from loadkit.operators.upsert import one_per_key, split_outcomes, upsert_table
from loadkit.plans.common import ACCEPTED, ORPHAN, REJECTED, Load, judge
from loadkit.schemas import DAILY, MONTHLY, Table
from loadkit.sinks import conform, publish
from loadkit.sources.lines import POSITION, scan_lines


@dataclass(frozen=True)
class Fact:
    """A fact: its table, how lines become rows, and the date it is partitioned by when stored."""

    table: Table
    rows: object
    policy: str = "replace"

    def judged(self, lines: DataFrame, parent: DataFrame | None, **options) -> DataFrame:
        rows, rules = self.rows(lines, **options)
        judged = judge(rows, rules, parent, self.table.parent_key)
        return judged.select(*POSITION, "line", *self.table.columns, "reason", "outcome")


Rules = list[tuple[str, Column]]


def daily_rows(lines: DataFrame, strict_metrics: bool = False) -> tuple[DataFrame, Rules]:
    """Daily fact (T12, T15, T16, D4, D6). A metric that is no integer counts as 0, or rejects the
    line with `strict_metrics`."""
    source = DAILY.source
    parsed = parse_records(lines, list(source.values()))
    raw = {name: F.col(f"rec.{field}") for name, field in source.items()}
    metrics = DAILY.of_kind("bigint")
    rows = parsed.select(
        *POSITION,
        "line",
        "rec_ok",
        "rec",
        raw["app_id"].alias("app_id"),
        cross_fill(raw["country_android"], raw["country_ios"]).alias("country_android"),
        cross_fill(raw["country_ios"], raw["country_android"]).alias("country_ios"),
        to_timestamptz_loose(raw["date"]).alias("date"),
        *[metric_or_zero(raw[m]).alias(m) for m in metrics],
    )
    rules = classify.line_rules("line", F.col("rec_ok")) + classify.fact_rules(
        F.col("app_id"),
        raw["date"],
        F.col("date"),
        [raw["country_android"], raw["country_ios"]],
        {source[m]: raw[m] for m in metrics} if strict_metrics else {},
    )
    return rows, rules


def monthly_rows(lines: DataFrame, on_error: str = "reject") -> tuple[DataFrame, Rules]:
    """Monthly fact (T14, T17, T19, D4). `fail` stops on an id or month that cannot be read."""
    parsed = parse_records(lines, list(MONTHLY.columns))
    rows = parsed.select(
        *POSITION,
        "line",
        "rec_ok",
        F.col("rec.app_id").alias("id_text"),
        strict_key("rec.app_id", on_error).alias("app_id"),
        month_start("rec.month", "fail" if on_error == "fail" else "null").alias("month"),
        metric_or_null("rec.peak_ccu").alias("peak_ccu"),
    )
    rules = classify.line_rules("line", F.col("rec_ok")) + [
        ("blank_app_id", blank("id_text")),
        ("app_id_not_integer", F.col("app_id").isNull()),
        ("bad_month", F.col("month").isNull()),
    ]
    return rows, rules


DAILY_FACT = Fact(DAILY, daily_rows)
MONTHLY_FACT = Fact(MONTHLY, monthly_rows, policy="keep")


def load_fact(
    spark: SparkSession,
    source: str | DataFrame,
    fact: Fact,
    root: str,
    parent: DataFrame,
    orphans: str = "fail",
    mode: str = "refresh",
    policy: str | None = None,
    on_dup: str | None = None,
    partition_by: str | None = None,
    **options,
) -> Load:
    """One-shot load. P6 is the daily fact with `orphans="fail"`, P9 the monthly one with `drop` and policy `replace`.

    Orphans fail the load, are diverted to the result's `orphans`, or are dropped. When a key occurs
    more than once the last line wins, or the first with policy `keep`, unless `on_dup` says otherwise. The policy is the fact's own by default.
    `upsert` merges into the stored table under `policy`.
    """
    policy = policy or fact.policy
    on_dup = on_dup or ("first" if policy == "keep" else "last")
    lines = source if isinstance(source, DataFrame) else scan_lines(spark, source)
    parts = split_outcomes(fact.judged(lines, parent, **options))
    if orphans == "fail":
        lost = parts[ORPHAN].limit(5).select(fact.table.parent_key).collect()
        if lost:
            raise ValueError(f"{fact.table.parent_key} without parent, for example {[r[0] for r in lost]}")
    keys = list(fact.table.key)
    accepted = parts[ACCEPTED].drop("line", "reason")
    if mode == "refresh":
        path = publish(
            conform(one_per_key(accepted, keys, on_dup, POSITION), fact.table.schema), root, [partition_by] if partition_by else None
        )
    else:
        upsert_table(root, accepted, fact.table.schema, keys, policy, on_dup=on_dup, order_by=POSITION, partition_by=partition_by)
        path = root
    diverted = parts[ORPHAN] if orphans != "drop" else parts[ORPHAN].limit(0)
    shown = [*fact.table.columns, F.col("line").alias("raw_line")]
    return Load(parts["all"], accepted, parts[REJECTED], diverted, path, ["line", "reason"], shown)
