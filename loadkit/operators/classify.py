"""Row predicates and ordered reject reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadkit.functions.casts import METRIC
from loadkit.functions.json import is_valid_json
from loadkit.functions.text import blank, col, full_match

# Id patterns and length limits.
ID_PATTERN = r"[A-Za-z0-9][A-Za-z0-9._-]*"
NUMERIC_PATTERN = r"[0-9]+"
ID_LENGTH = 255
CSV_ID_LENGTH = 32


def usable_line(line: Column | str) -> Column:
    """Not NULL, not blank, exactly one JSON value."""
    return ~blank(line) & is_valid_json(line)


def id_ok(key: Column | str, pattern: str = ID_PATTERN, length: int = ID_LENGTH) -> Column:
    """D2, D3."""
    key = col(key)
    return F.coalesce(~blank(key) & (F.length(key) <= length) & full_match(key, pattern), F.lit(False))


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds, NULL when none does. An unknown condition does not hold."""
    reason = F.lit(None).cast("string")
    for name, condition in reversed(rules):
        reason = F.when(condition, F.lit(name)).otherwise(reason)
    return reason


# The names of the reasons in `line_rules`, `id_rules` and `fact_rules`, and their order.


def line_rules(line: Column | str, valid: Column) -> list[tuple[str, Column]]:
    return [("blank_line", blank(line)), ("invalid_json", ~F.coalesce(valid, F.lit(False)))]


def key_rules(key: Column | str, name: str) -> list[tuple[str, Column]]:
    """Key must be present."""
    return [(f"blank_{name}", blank(key))]


def id_rules(
    key: Column | str, name: str = "app_id", pattern: str = ID_PATTERN, length: int = ID_LENGTH
) -> list[tuple[str, Column]]:
    """Key must be present, short enough and well formed."""
    return key_rules(key, name) + [
        (f"{name}_too_long", F.length(col(key)) > length),
        (f"{name}_bad_format", ~full_match(key, pattern)),
    ]


def integer_id_rules(text: Column | str, parsed: Column | str, name: str = "app_id") -> list[tuple[str, Column]]:
    """Rules for an id that must also be an integer; a well-formed other id gets its own reason."""
    trimmed = F.trim(col(text))
    return id_rules(trimmed, name) + [
        (f"{name}_not_integer", ~full_match(trimmed, NUMERIC_PATTERN) | col(parsed).isNull())
    ]


def fact_rules(
    key: Column, date_text: Column, date: Column, countries: list[Column], metrics: dict[str, Column]
) -> list[tuple[str, Column]]:
    """The daily fact's reasons. A metric that is present, not blank and no integer is bad."""
    no_country = F.lit(True)
    for c in countries:
        no_country = no_country & blank(c)
    # Names and order of the reasons.
    rules = [
        ("missing_aid", blank(key)),
        ("missing_date", blank(date_text)),
        ("bad_date", date.isNull()),
        ("missing_country", no_country),
    ]
    return rules + [(f"bad_{n}", ~blank(c) & ~full_match(c, METRIC)) for n, c in metrics.items()]


def line_range(column: Column | str, start: int, end: int) -> Column:
    """D7."""
    return col(column).between(start, end)
