"""Records broken over several lines, put back together in parallel (B7, and A4 for large files).

Whether a line break ends a record depends on everything before it: is it inside a string, after a
backslash, or inside brackets. The file is still read in parallel, in two passes over its splits.

1. Each split is summed up, for every state it might start in, by the state it ends in and what it
   does to the bracket depth. That is one short row per split.
2. The rows of a file are chained, which gives the true start state of every split (a file of 5 TB
   has some 40,000 of them), and each split then cuts its own records. Only the pieces of records
   that cross a split boundary are shuffled and joined.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.functions.json import is_valid_json, one_line
from loadkit.functions.text import strip_space
from loadkit.operators import blocks
from loadkit.operators.blocks import ESCAPED, INSIDE, OUTSIDE
from loadkit.schemas import POSITION
from loadkit.session import BROADCAST_ROWS, broadcast_checked, stage

_STATES = (OUTSIDE, INSIDE, ESCAPED)
_REST_OF_STRING = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+', re.DOTALL)
_BRACKETS = re.compile(r"[{}\[\]]")

# Effect of some text on a start state: end state, then depth -> max(depth + net, floor), then the
# greatest start depth for which a line in it ends a record (-1: none does).
Effect = tuple[int, int, int, int]
_NOTHING: tuple[Effect, ...] = tuple((s, 0, 0, -1) for s in _STATES)


# A plain dict travels with the functions of a task; the wrapper of a cached function would be looked up by its module's name.
_KNOWN: dict[str, tuple[int, int]] = {}


def nesting(brackets: str) -> tuple[int, int]:
    """Net and floor of a run of brackets; lines of one file mostly share a few of them."""
    known = _KNOWN.get(brackets)
    if known is not None:
        return known
    net = floor = 0
    for bracket in brackets:
        if bracket in "{[":
            net, floor = net + 1, floor + 1
        else:
            net, floor = net - 1, max(floor - 1, 0)
    if len(_KNOWN) >= 8192:
        _KNOWN.clear()
    _KNOWN[brackets] = net, floor
    return net, floor


def walk(text: str, state: int) -> tuple[int, int, int]:
    """End state, net and floor for text without line breaks."""
    at = 0
    if state == ESCAPED:
        if not text:
            return ESCAPED, 0, 0
        at, state = 1, INSIDE
    if "\\" not in text:
        parts = text[at:].split('"')
        outside = parts[state::2]
        state = state if len(parts) % 2 else 1 - state
    else:
        outside = []
        while True:
            if state == OUTSIDE:
                quote = text.find('"', at)
                if quote < 0:
                    outside.append(text[at:])
                    break
                outside.append(text[at:quote])
                at, state = quote + 1, INSIDE
            else:
                at = _REST_OF_STRING.match(text, at).end()
                if at == len(text):
                    break
                if text[at] == "\\":  # the last character; whatever comes next is escaped
                    state = ESCAPED
                    break
                at, state = at + 1, OUTSIDE
    return state, *nesting("".join(_BRACKETS.findall("".join(outside))))


def line_effect(line: str) -> tuple[Effect, ...]:
    """Effect of one line for each start state. A carriage return changes no state."""
    text = line.replace("\r", "") if "\r" in line else line
    effects = []
    for start in (OUTSIDE, INSIDE):
        end, net, floor = walk(text, start)
        effects.append((end, net, floor, -net if end == OUTSIDE and floor == 0 else -1))
    if text[:1] not in ("", '"', "\\"):
        return effects[0], effects[1], effects[1]  # an escaped ordinary character is an ordinary one
    end, net, floor = walk(text, ESCAPED)
    return effects[0], effects[1], (end, net, floor, -net if end == OUTSIDE and floor == 0 else -1)


def chain(first: tuple[Effect, ...], then: tuple[Effect, ...]) -> tuple[Effect, ...]:
    chained = []
    for end, net, floor, ends in first:
        end2, net2, floor2, ends2 = then[end]
        later = ends2 - net if floor <= ends2 else -1
        chained.append((end2, net + net2, max(floor + net2, floor2), max(ends, later, -1)))
    return tuple(chained)


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[str]]]:
    """Lines of consecutive rows with equal `columns`."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c) for c in columns]
        lines = batch.column("line").to_pylist()
        key = tuple(k[0].as_py() for k in keys)
        # Splits are contiguous, so a batch that starts and ends in one split is all of that split.
        if key == tuple(k[-1].as_py() for k in keys):
            yield key, lines
            continue
        start = 0
        rows = list(zip(*(k.to_pylist() for k in keys)))
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[start]:
                yield rows[start], lines[start:i]
                start = i


_EFFECTS = [f"{n}{s}" for s in _STATES for n in ("end", "net", "floor", "ends")]
_BATCH_CHARS = 4_000_000
_SUMMARIES = 1000
# Bytes of a record that crosses splits. It becomes one row, so one quote that is never closed must not gather a whole file.
LONGEST_RECORD = 1 << 28
_SUMMARY = "file string, block bigint, " + ", ".join(f"{c} bigint" for c in _EFFECTS)
_START = "file string, block bigint, state bigint, depth bigint, opened bigint, left boolean"

_PIECES = "file string, block bigint, seq bigint, idx bigint, text string, newlines bigint, returns bigint, partial boolean"


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _opened(line: str, block: int, opener: str) -> str:
    """First line of a file without the opening bracket."""
    if not opener or block:
        return line
    if not line.lstrip().startswith(opener):
        raise ValueError(f"expected a JSON list, found {line[:40]!r}")
    return line.lstrip()[len(opener) :]


def _summarise(opener: str, effect_of: Callable[[str], tuple[Effect, ...]] = line_effect):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, current, effect = [], None, _NOTHING
        for key, lines in _runs(batches, ["file", "block"]):
            if key != current:
                if current:
                    done.append((current, effect))
                current, effect = key, _NOTHING
                lines = [_opened(lines[0], key[1], opener), *lines[1:]]
            for line in lines:
                effect = chain(effect, effect_of(line))
            if len(done) == _SUMMARIES:
                yield told(done)
                done = []
        if current:
            done.append((current, effect))
        if done:
            yield told(done)

    def told(done: list[tuple[tuple, tuple[Effect, ...]]]) -> pa.RecordBatch:
        return _batch([(*key, *(v for e in effect for v in e)) for key, effect in done], _SUMMARY)

    return run


def _summarise_json(opener: str):
    """As `_summarise`, for the states of JSON text, all lines of a batch at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, effect = None, _NOTHING
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column("file"), batch.column("block")]
            first = blocks.firsts(columns)
            keys = list(zip(*(c.take(pa.array(first)).to_pylist() for c in columns)))
            fresh = [i for i, key in enumerate(keys) if key[1] == 0 and key != current]
            found = blocks.effects(blocks.opened(batch.column("line"), first[fresh], opener), first)
            done = []
            for key, more in zip(keys, found):
                if key == current:
                    effect = chain(effect, more)
                    continue
                if current:
                    done.append((*current, *(v for e in effect for v in e)))
                current, effect = key, more
            if done:
                yield _batch(done, _SUMMARY)
        if current:
            yield _batch([(*current, *(v for e in effect for v in e))], _SUMMARY)

    return run


def _start_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the splits of each file; rows come sorted by file and split, files are not divided.

    `opened` is the split where the record still open began, -1 between records; `left` says that a record is open at the split's end.
    """
    current = None
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["file"] != current:
                current, state, depth, opened = row["file"], OUTSIDE, 0, -1
            start = (current, row["block"], state, depth, opened)
            if (state, depth) == (OUTSIDE, 0) or depth <= row[f"ends{state}"]:
                opened = row["block"]
            state, depth = row[f"end{state}"], max(depth + row[f"net{state}"], row[f"floor{state}"])
            if (state, depth) == (OUTSIDE, 0):
                opened = -1
            rows.append((*start, opened >= 0))
        if rows:
            yield _batch(rows, _START)


def _cut(inside: str, nested: str, keep_returns: bool, opener: str, step: Callable[[str, int], tuple[int, int, int]] = walk, counted: bool = False):
    columns = ["file", "block", "state", "depth", "opened", "ended", *(["total"] if counted else [])]

    def clean(text: str, state: int) -> tuple[str, int]:
        """Carriage returns to their escape inside strings, to a space outside."""
        if keep_returns or "\r" not in text:
            return text, 0
        out, count = [], 0
        for i, part in enumerate(text.split("\r")):
            if i:
                out.append(" " if state == OUTSIDE else "\\r")
                count += state != OUTSIDE
            out.append(part)
            state = walk(part, state)[0]
        return "".join(out), count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, 0
        out: list[tuple] = []

        def emit(partial: bool) -> None:
            nonlocal held
            owner = opened if carried else block
            out.append((file, owner, block, -1 if carried else first, "".join(buf), newlines, returns, partial))
            held += len(out[-1][4]) + 100

        def flush() -> pa.RecordBatch:
            nonlocal held
            batch = _batch(out, _PIECES)
            out.clear()
            held = 0
            return batch

        def left_open() -> None:
            """What is still open at the end of a split; the last line break of the file belongs to it."""
            nonlocal newlines
            if ended:
                buf.append(nested if state == OUTSIDE else inside)
                newlines += state != OUTSIDE
            emit(True)

        def whole_split() -> None:
            if counted and index != counts[0]:
                raise ValueError(f"{file}, split at byte {block}: {index} lines, {counts[0]} before; the splits of a file must stay as they are until it is read")

        for key, lines in _runs(batches, columns):
            if key != current:
                if current:
                    whole_split()
                if current and buf:
                    left_open()
                current = key
                file, block, state, depth, opened, ended, *counts = key
                carried = (state, depth) != (OUTSIDE, 0)
                buf, index, first, newlines, returns = [], 0, 0, 0, 0
                lines = [_opened(lines[0], block, opener), *lines[1:]]
            for line in lines:
                if (state, depth) != (OUTSIDE, 0):
                    buf.append(nested if state == OUTSIDE else inside)
                    newlines += state != OUTSIDE
                else:
                    first = index
                text, count = clean(line, state)
                buf.append(text)
                returns += count
                state, net, floor = step(line.replace("\r", "") if "\r" in line else line, state)
                depth = max(depth + net, floor)
                index += 1
                if (state, depth) == (OUTSIDE, 0):
                    emit(carried)
                    buf, carried, newlines, returns = [], False, 0, 0
                if held > _BATCH_CHARS:
                    yield flush()
        if current:
            whole_split()
        if current and buf:
            left_open()
        if out:
            yield flush()

    return run


def splits_of(lines: DataFrame) -> DataFrame:
    """A row for each split: `bytes` and number (`total`) of its lines, `size` of its file, and the index in it of its first line that is not blank."""
    blank = F.col("line").isin("", "\r")
    first = F.min(F.when(~blank, F.col("pos"))) - F.min("pos")
    return lines.groupBy("file", "block").agg(F.sum("bytes").alias("bytes"), F.max("size").alias("size"), F.count("*").alias("total"), first.alias("first"))


def _last_splits(lines: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """(file, block, ended) of the last split of each file whose last line is ended too; no rows if `lines` has no `bytes` and `size`."""
    if "size" not in lines.columns:
        return lines.sparkSession.createDataFrame([], "file string, block bigint, ended boolean")
    files = splits if splits is not None else lines.groupBy("file", "block").agg(F.sum("bytes").alias("bytes"), F.max("size").alias("size"))
    files = files.groupBy("file").agg(F.max("block").alias("block"), F.sum("bytes").alias("bytes"), F.max("size").alias("size"))
    return files.filter("bytes = size").select("file", "block", F.lit(True).alias("ended"))


def reassemble(
    lines: DataFrame,
    inside: str = "\\n",
    nested: str = " ",
    keep_returns: bool = False,
    opener: str = "",
    keep_blank: bool = False,
    trim: bool = True,
    effect_of: Callable[[str], tuple[Effect, ...]] | None = None,
    step: Callable[[str, int], tuple[int, int, int]] | None = None,
    longest: int = LONGEST_RECORD,
    splits: DataFrame | None = None,
) -> DataFrame:
    """One row per record: `file`, `block`, `idx` (its order), `record`, `newlines`, `returns`.

    `lines` has POSITION and `line` columns, not NULL, as from `scan_lines(keep_cr=True)`; the rows
    of one (file, block) must follow each other within a partition, and both passes must see the
    same blocks. A line break inside a string becomes `inside`, one inside brackets `nested`.
    A file whose brackets or quotes never balance again is one record from there on; beyond `longest`
    bytes it fails, and the error names the file and the split where the record begins. The last line break of a file
    belongs to a record left open there; it is known from `bytes` and `size`, if `lines` has them. `effect_of` and `step` say
    what a line does to the state where that is not what JSON does; `trim` takes the white space around records away.
    With `splits`, from `splits_of(lines)`, and a `step`, records are cut when they are read and only the pieces of those that cross splits are staged: each
    text is on disk once, in its file. The files must be there until then, and their splits the same; a split with another number of lines fails.
    """
    rows = lines.select(*POSITION, "line")
    summarise = _summarise(opener, effect_of) if effect_of else _summarise_json(opener)
    summary = stage(rows.select("file", "block", "line").mapInArrow(summarise, _SUMMARY), "summary")
    in_order = summary.repartition("file").sortWithinPartitions("file", "block")
    starts = in_order.mapInArrow(_start_states, _START)
    starts = starts.join(_last_splits(lines, splits), ["file", "block"], "left").withColumn("ended", F.coalesce("ended", F.lit(False)))
    starts = stage(starts if splits is None else starts.join(splits.select("file", "block", "total"), ["file", "block"]), "starts")
    few = starts.count() <= BROADCAST_ROWS
    names = [field.split()[0] for field in _PIECES.split(", ")]
    cut = _cut(inside, nested, keep_returns, opener, step, splits is not None) if step else blocks.cut(inside, nested, keep_returns, opener, names)

    def cut_from(starts: DataFrame) -> DataFrame:
        if few:
            known = rows.join(F.broadcast(starts), ["file", "block"])
        else:
            known = rows.join(starts, ["file", "block"]).repartition("file", "block").sortWithinPartitions(*POSITION)
        return known.select(*[c for c in starts.columns if c != "left"], "line").mapInArrow(cut, _PIECES)

    if splits is None:
        pieces = stage(cut_from(starts), "pieces", ["partial"])
        whole, partial = pieces.filter("NOT partial"), pieces.filter("partial")
    else:
        whole = cut_from(starts).filter("NOT partial")
        partial = stage(cut_from(starts.filter("opened >= 0 OR left")).filter("partial"), "pieces")
    sizes = partial.groupBy("file", "block").agg(F.sum(F.octet_length("text")).alias("bytes"))
    over = sizes.filter(F.col("bytes") > longest).orderBy("file", "block").limit(5).collect()
    if over:
        found = ", ".join(f"{r.file} from the split at byte {r.block} ({r.bytes} bytes)" for r in over)
        raise ValueError(f"records of more than {longest} bytes, perhaps a quote or bracket that is never closed: {found}")
    joined = (
        partial
        .groupBy("file", "block")
        .agg(
            F.max("idx").alias("idx"),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda p: p["text"]), ""
            ).alias("text"),
            F.sum("newlines").alias("newlines"),
            F.sum("returns").alias("returns"),
        )
    )
    columns = ["file", "block", "idx", "text", "newlines", "returns"]
    records = whole.select(*columns).unionByName(joined.select(*columns))
    records = records.withColumn("record", strip_space("text") if trim else F.col("text")).drop("text")
    return records if keep_blank else records.filter("record <> ''")


def split_json_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A4 for large files: the list is read in parallel, cut at its top-level commas.

    `file`, `block`, `idx`, `line`, an element as given on one line; text that is not one JSON list fails the job when it is read.
    """
    parts = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.make_valid_utf8("value").alias("line"),
    )
    return join_list_parts(parts)


def join_list_parts(parts: DataFrame) -> DataFrame:
    """Elements of JSON lists cut at every comma (rows as for `reassemble`)."""
    records = reassemble(parts, inside=",", nested=",", keep_returns=True, opener="[", keep_blank=True)
    records = stage(records.withColumn("ok", is_valid_json("record")), "elements")
    # The closing bracket is still on the last element, the only one that is not valid as it stands.
    at = F.struct("block", "idx")
    ends = records.groupBy("file").agg(
        F.max(at).alias("last"), F.count_if(~F.col("ok")).alias("bad"), F.count(F.lit(1)).alias("n")
    )
    marked = records.join(broadcast_checked(stage(ends, "ends")), "file")
    last = at == F.col("last")
    body = strip_space(F.regexp_replace("record", r"\]\z", ""))
    closed = last & F.endswith("record", F.lit("]")) & ~F.col("ok")
    element = F.when(closed, body).otherwise(F.col("record"))
    valid = is_valid_json(element)
    empty_list = closed & (body == "") & (F.col("n") == 1)
    whole = (F.col("bad") == 1) & (F.col("ok") | closed)
    line = F.when(~whole | (~valid & ~empty_list), F.raise_error(F.lit("expected a JSON list"))).otherwise(one_line(element))
    return marked.select("file", "block", "idx", line.alias("line"), empty_list.alias("none")).filter("not none").drop("none")
