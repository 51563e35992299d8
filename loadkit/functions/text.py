"""Text helpers shared by the casts and the repair jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column | str) -> Column:
    """NULL, empty or only spaces."""
    return F.coalesce(F.trim(col(c)), F.lit("")) == ""


def blank_to_null(c: Column | str) -> Column:
    """Trim spaces; an empty rest is NULL."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def strip_space(c: Column | str) -> Column:
    """Trim every kind of white space, as the repair jobs do; `trim` only takes spaces."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+\z", "")


def full_match(c: Column | str, pattern: str) -> Column:
    r"""Whole-value match. Java's `$` lets a trailing newline through, `\z` does not."""
    return F.rlike(col(c), F.lit(rf"\A(?:{pattern})\z"))


def cross_fill(a: Column | str, b: Column | str) -> Column:
    """First of two fields that is not blank, trimmed."""
    return F.coalesce(blank_to_null(a), blank_to_null(b))
