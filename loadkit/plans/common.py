"""Steps the dimension and fact loads share."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.functions.text import blank
from loadkit.operators.classify import first_reason
from loadkit.operators.quality import row_counts
from loadkit.operators.refcheck import mark_parent
from loadkit.sinks import write_split
from loadkit.sources.lines import line_offsets, number_lines

ACCEPTED, REJECTED, ORPHAN = "accepted", "rejected", "orphan"


@dataclass
class Load:
    """Frames of one load. `lines` has every input line whatever became of it.

    `rejects` and `orphans` are `rejected` and `lost` with their line numbers, which are worked out when first asked for;
    without columns to show they are the rows as they are.
    """

    lines: DataFrame
    accepted: DataFrame
    rejected: DataFrame
    lost: DataFrame
    path: str | None = None
    reject_columns: list[str | Column] | None = None
    orphan_columns: list[str | Column] | None = None

    @cached_property
    def _offsets(self) -> DataFrame:
        return line_offsets(self.lines)

    def _numbered(self, rows: DataFrame, columns: list[str | Column] | None) -> DataFrame:
        return rows if columns is None else number_lines(rows, self._offsets).select("line_no", *columns)

    @cached_property
    def rejects(self) -> DataFrame:
        return self._numbered(self.rejected, self.reject_columns)

    @cached_property
    def orphans(self) -> DataFrame:
        return self._numbered(self.lost, self.orphan_columns)

    def counts(self, table: DataFrame | None = None) -> DataFrame:
        """Row counts after the load (G1)."""
        frames = {"lines": self.lines, "accepted": self.accepted, "rejects": self.rejected, "orphans": self.lost}
        return row_counts(**frames, **({"table": table} if table is not None else {}))

    def write_splits(self, folder: str) -> None:
        """Write rejects and orphans."""
        write_split(self.rejects, f"{folder}/rejects")
        write_split(self.orphans, f"{folder}/orphans")


def judge(
    rows: DataFrame,
    rules: list[tuple[str, Column]],
    parent: DataFrame | None = None,
    parent_key: str | None = None,
    blank_ok: bool = False,
) -> DataFrame:
    """Add `reason` and `outcome`. One column decides, so no row is lost or counted twice.

    Rejected rows do not look for a parent. The raw line is dropped from accepted rows.
    """
    judged = rows.withColumn("reason", first_reason(rules))
    outcome = F.when(F.col("reason").isNotNull(), REJECTED)
    if parent is not None:
        judged = judged.withColumn("__ref", F.when(F.col("reason").isNull(), F.col(parent_key)))
        keys = parent.select(F.col(parent_key).alias("__ref"))
        judged = mark_parent(judged, keys, "__ref", blank_ok=blank_ok).drop("__ref")
        outcome = outcome.when(~F.col("has_parent"), ORPHAN)
    judged = judged.withColumn("outcome", outcome.otherwise(ACCEPTED)).drop("has_parent")
    return judged.withColumn("line", F.when(F.col("outcome") != ACCEPTED, F.col("line")))


def blank_as_null(c: str) -> Column:
    return F.when(~blank(c), F.col(c))
