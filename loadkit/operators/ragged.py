"""Ragged CSV lines to columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.functions.casts import once
from loadkit.functions.text import col, full_match, strip_space
from loadkit.session import broadcast_checked, stage

_MARKS = re.compile(r'\\.|["\[\]{},]', re.DOTALL)
# A quoted run, closed or not; all but unquoted commas and brackets. The loops give nothing back, so long lines need no stack.
_QUOTED = r'"(?:[^"\\]++|\\.|\\\z)*+(?:"|\z)'
_NO_MARK = rf'[^"\\\[\]{{}},]++|\\.|\\\z|{_QUOTED}'
# The text after a comma up to the next one outside quotes.
_PIECE = rf'(?s),((?:{_NO_MARK}|[\[\]{{}}])*+)'


def _nested(depth: int) -> str:
    """Text in closed brackets, one within the other up to a depth."""
    inner = rf"{_NO_MARK}|,|{_nested(depth - 1)}" if depth > 1 else f"{_NO_MARK}|,"
    return rf"\[(?:{inner})*+\]|\{{(?:{inner})*+\}}"


# The text after a comma up to the next one outside quotes and brackets, or up to a bracket that is not closed or lies deeper.
_FIELD = rf"(?s),((?:{_NO_MARK}|{_nested(3)})*+)"


def cut_fields(line: str) -> list[str]:
    """B1 for one line, such as a header: cut at commas outside double quotes, brackets and braces; a backslash hides the next character."""
    fields, start, quoted = [], 0, False
    depth = {"[": 0, "{": 0}
    for mark in _MARKS.finditer(line):
        ch = mark.group()
        if ch == '"':
            quoted = not quoted
        elif quoted or ch[0] == "\\":
            continue
        elif ch in depth:
            depth[ch] += 1
        elif ch == ",":
            if not any(depth.values()):
                fields.append(line[start : mark.start()])
                start = mark.end()
        else:
            opener = "[" if ch == "]" else "{"
            depth[opener] = max(0, depth[opener] - 1)
    return [*fields, line[start:]]


def split_fields(line: Column | str) -> Column:
    """B1 over a column, by Spark's own expressions; NULL stays NULL.

    Lines without quotes, backslashes and brackets are plainly split, those with closed brackets up to three deep by one
    pattern. In the others the depths of the brackets say which commas stand between fields.
    """
    line = col(line)
    marked = F.rlike(line, F.lit(r'["\\\[\]{}]'))

    def found(pattern: str) -> Column:
        return F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(pattern), F.lit(1))

    def whole(fields: Column) -> Column:
        # Where the pattern stopped at a bracket, the fields lack it.
        walked = once(found(_PIECE), lambda pieces: _joined(pieces, line))
        return F.when(F.array_join(fields, ",") == line, fields).otherwise(walked)

    return F.when(marked, once(found(_FIELD), whole)).otherwise(F.split(line, ",", -1))


def _joined(pieces: Column, line: Column) -> Column:
    """Pieces put together again wherever the comma between them stands in brackets."""
    skeleton = F.regexp_replace(line, f"(?s){_NO_MARK}", "")

    def fields(last: Column) -> Column:
        """`last` holds the index of each field's last piece."""
        def field(end: Column, place: Column) -> Column:
            first = F.when(place == 0, F.lit(0)).otherwise(F.get(last, place - 1) + 1)
            return F.array_join(F.slice(pieces, first + 1, end - first + 1), ",")

        return F.transform(last, field)

    return once(F.concat(_separators(skeleton), F.array(F.size(pieces) - 1)), fields)


def _separators(skeleton: Column) -> Column:
    """Which commas, counted from 0, stand outside all brackets in a text of commas and brackets.

    The text is walked in blocks: adding to an array copies it, so a block's finds are added up first, and the work
    grows with the text and not with its square.
    """
    nothing = F.array().cast("array<int>")

    def state(square: Column, curly: Column, commas: Column, found: Column) -> Column:
        return F.struct(square.alias("square"), curly.alias("curly"), commas.alias("commas"), found.alias("found"))

    def depth(now: Column, mark: Column, opener: str, closer: str) -> Column:
        return F.when(mark == opener, now + 1).when(mark == closer, F.greatest(now - 1, F.lit(0))).otherwise(now)

    def step(now: Column, mark: Column) -> Column:
        comma = mark == ","
        outside = comma & (now["square"] == 0) & (now["curly"] == 0)
        return state(
            depth(now["square"], mark, "[", "]"), depth(now["curly"], mark, "{", "}"), now["commas"] + comma.cast("int"),
            F.when(outside, F.concat(now["found"], F.array(now["commas"]))).otherwise(now["found"]),
        )

    def block(now: Column, marks: Column) -> Column:
        start = state(now["square"], now["curly"], now["commas"], nothing)
        done = F.aggregate(F.regexp_extract_all(marks, F.lit("."), F.lit(0)), start, step)
        return once(done, lambda end: state(end["square"], end["curly"], end["commas"], F.concat(now["found"], F.array(end["found"]))))

    blocks = F.regexp_extract_all(skeleton, F.lit(".{1,256}"), F.lit(0))
    start = state(F.lit(0), F.lit(0), F.lit(0), F.array().cast("array<array<int>>"))
    return F.flatten(F.aggregate(blocks, start, block, lambda end: end["found"]))


def fit_fields(fields: Column | str, width: int, sink: int) -> Column:
    """B2. Surplus fields are cut from the end and appended to field `sink`; missing ones are ''.

    When the sink is not the last column, the columns after it keep the shifted values they have.
    """
    fields = col(fields)
    extra = F.array_join(F.slice(fields, width + 1, F.greatest(F.size(fields) - width, F.lit(0))), ",")
    kept = F.slice(fields, 1, width)
    absorbed = F.concat(
        F.slice(kept, 1, sink),
        F.array(F.concat(F.get(kept, F.lit(sink)), F.lit(","), extra)),
        F.slice(kept, sink + 2, max(width - sink - 1, 0)) if sink + 1 < width else F.array().cast("array<string>"),
    )
    padded = F.concat(fields, F.array_repeat(F.lit(""), F.lit(width) - F.size(fields)))
    return F.when(F.size(fields) > width, absorbed).when(F.size(fields) < width, padded).otherwise(fields)


def strip_outer_quotes(c: Column | str) -> Column:
    """B4. Trim; drop a wrapping pair of quotes and undouble those inside."""
    s = strip_space(c)
    inner = F.replace(F.substring(s, F.lit(2), F.greatest(F.length(s) - 2, F.lit(0))), F.lit('""'), F.lit('"'))
    return F.when(full_match(s, r'(?s)".*"'), inner).otherwise(s)


def field_text(c: Column | str, empty_to_null: bool = True) -> Column:
    """B6 then B4. A blank is NULL (or kept); a quoted empty is '' either way."""
    text = strip_outer_quotes(c)
    return F.when(strip_space(c) != "", text) if empty_to_null else text


def first_lines(lines: DataFrame) -> DataFrame:
    """First line of each file with its position, staged; `lines` comes from scan_lines(keep_cr=True)."""
    return stage(lines.filter("block = 0").groupBy("file").agg(F.min_by("line", "pos").alias("line"), F.min("pos").alias("pos")), "heads")


def header_names(heads: DataFrame, unquote: bool = True) -> list[str]:
    """B3. Column names, which must be the same in every file. `unquote` reads quoted names too."""
    names_only = heads.select(F.regexp_replace("line", r"\r+\z", "").alias("line")).distinct()
    found = [r.line for r in names_only.limit(2).collect()]
    if not found or not found[0]:
        raise ValueError("empty input")
    if len(found) > 1:
        raise ValueError("the files have different headers")
    line = found[0]
    if not unquote:
        return line.split(",")
    names = (name.strip() for name in cut_fields(line))
    return [n[1:-1].replace('""', '"') if len(n) > 1 and n[0] == n[-1] == '"' else n for n in names]


def body_lines(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """Lines after each file's first, without the empty ones and trailing carriage returns."""
    first = heads.select("file", F.lit(0).cast("long").alias("block"), "pos", F.lit(True).alias("head"))
    return (
        lines.join(broadcast_checked(first), ["file", "block", "pos"], "left")
        .filter(F.col("head").isNull())
        .withColumn("line", F.regexp_replace("line", r"\r+\z", ""))
        .filter(F.col("line") != "")
        .drop("head")
    )


def fit_lines(lines: DataFrame, header: list[str], sink: str | None = None, line: str = "line") -> DataFrame:
    """Add `fields`, fitted to the header, and the flag `repaired` (B1, B2)."""
    if sink is not None and sink not in header:
        raise ValueError(f"sink column {sink!r} not in header")
    index = len(header) - 1 if sink is None else header.index(sink)
    # The array is computed once: its size and its repair both read it.
    cut = lines.withColumn("__cut", split_fields(line))
    return (
        cut.withColumn("fields", fit_fields("__cut", len(header), index))
        .withColumn("repaired", F.size("__cut") != len(header))
        .drop("__cut")
    )


def bind_fields(df: DataFrame, header: list[str], keep: list[str] = (), fields: str = "fields") -> DataFrame:
    """Fitted array to columns by position, quotes kept."""
    return df.select(*keep, *[F.get(F.col(fields), F.lit(i)).alias(n) for i, n in enumerate(header)])
