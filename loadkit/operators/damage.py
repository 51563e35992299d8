"""Records with bad escapes or bare quotes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.functions.casts import once
from loadkit.functions.json import is_valid_json
from loadkit.functions.text import col, strip_space
from loadkit.session import stage

# White space of any script, as around the marks of a record.
_SPACES = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# The string up to its closing quote, that is the first one before a comma or brace; and a quote with the text before it.
_STRING = rf'(?s)^(?:[^"\\]++|\\.|"(?!{_SPACES}*+[,}}]))*+"'
_BARE = r'(?s)\G((?:[^"\\]++|\\.)*+)"'


def sanitize(c: Column | str) -> Column:
    r"""B8. Drop control characters, turn \xHH into xHH, double a backslash that starts no escape."""
    # The patterns and their order decide the result.
    t = F.regexp_replace(col(c), r"[\x00-\x1f\x7f]", "")
    t = F.regexp_replace(t, r"\\x([0-9A-Fa-f]{2})", "x$1")
    return F.regexp_replace(t, r'\\([^"\\/bfnrtu])', r"\\\\$1")


def repair_quotes(c: Column | str, name: str = "description") -> Column:
    """B9. Escape quotes inside the named field's string that no comma or brace follows.

    The line comes back unchanged when the field is absent, no string, or never closes; NULL stays NULL.
    """
    c = col(c)
    # The first place of the name is kept even if no string follows there. The loops give nothing back, so long lines need no stack.
    quoted_name = rf'(?s)^(?>.*?(?="{re.escape(name)}"))[^:]*+:{_SPACES}*+"'

    def from_opening(head: Column) -> Column:
        return once(F.substring(c, F.length(head) + 1, F.length(c)), lambda rest: once(F.regexp_extract(rest, _STRING, 0), lambda whole: mended(head, rest, whole)))

    def mended(head: Column, rest: Column, whole: Column) -> Column:
        body = F.substring(whole, F.lit(1), F.length(whole) - 1)
        fixed = F.concat(head, F.regexp_replace(body, _BARE, r'$1\\"'), F.substring(rest, F.length(whole), F.length(rest)))
        return F.when((head != "") & (whole != ""), fixed).otherwise(c)

    return F.when(c.isNotNull(), once(F.regexp_extract(c, quoted_name, 0), from_opening))


def repair_records(df: DataFrame, name: str = "description", line: str = "line") -> DataFrame:
    """B10. Add `record` (JSON text, NULL when beyond repair) and `repaired`.

    The record is the text itself after the repair: numbers, key order and spaces stay as they were given. Blank lines give NULL too and are told apart by the caller. A line that is valid after B8 is
    left as it is; only the others go through B9.
    """
    df = df.withColumn("__clean", sanitize(line))
    # The row counters keep filters on the outcome above these projections, so each runs once.
    df = df.withColumns({"__json": F.when(is_valid_json("__clean"), F.col("__clean")), "__once": F.monotonically_increasing_id()})
    broken = F.col("__json").isNull() & (F.col("__once") >= 0)
    quoted = repair_quotes(F.when(broken, F.col("__clean")), name)
    df = df.withColumns({"__quoted": quoted, "__twice": F.monotonically_increasing_id()})
    again = F.when(is_valid_json("__quoted"), F.col("__quoted"))
    df = df.withColumn("__again", F.when(F.col("__quoted").isNotNull() & (F.col("__twice") >= 0), again))
    repaired = F.col("__json").isNull() | (F.col("__clean") != F.col(line))
    return (
        df.withColumn("record", F.coalesce("__json", "__again"))
        .withColumn("repaired", F.col("record").isNotNull() & repaired)
        .drop("__clean", "__json", "__once", "__quoted", "__twice", "__again")
    )


def repair_or_reject(df: DataFrame, name: str = "description", line: str = "line") -> tuple[DataFrame, DataFrame]:
    """Good records and rejects of B10; blank lines are in neither. Keeps the original line.

    The repair is staged, so that both outputs come from one run.
    """
    given = df.filter(F.coalesce(strip_space(line), F.lit("")) != "")
    whole = stage(repair_records(given, name, line), "repair")
    return whole.filter(F.col("record").isNotNull()), whole.filter(F.col("record").isNull())
