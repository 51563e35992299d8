"""CSV with every column as text (A2).

A file's rows end as its first row does: with CR, or with LF, before which one CR is dropped. Line breaks in quotes are kept as
they are. Whether a row end stands in quotes is decided by one state, in quotes or not, that runs through the file. Small files are
walked through by one task each. Larger ones are read by split: what a split does to either state is summed up first, the
summaries are chained, and each split then starts in its true state. Both ways apply the same step to the same lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.operators.reassemble import INSIDE, OUTSIDE, Effect, reassemble, splits_of
from loadkit.schemas import text_schema
from loadkit.session import broadcast_checked, stage
from loadkit.sources.lines import scan_lines

# Bytes of a file that one task reads whole where quoted line breaks are allowed; the records of larger ones are found by split.
# Either way gives the same rows.
WHOLE_FILE = 1 << 25
_HEAD = 1 << 16
_HEADS_AT_ONCE = 16
_BATCH_CHARS = 4_000_000
_REST_OF_QUOTED = re.compile(r'[^"]*+(?:""[^"]*+)*+"(?!")')


def first_row_end(text: str, whole: bool) -> str | None:
    """The row end after the first row: CR, or LF (also for CRLF). None if `text` does not show it yet; LF if it is all there is."""
    at = 0
    while True:
        if text.startswith('"', at):
            closed = _REST_OF_QUOTED.match(text, at + 1)
            if closed is None or closed.end() == len(text):
                return "\n" if whole else None
            at = closed.end()
        found = _FIELD_END.search(text, at)
        if found is None or found.group() == "\r" and found.end() == len(text) and not whole:
            return "\n" if whole else None
        if found.group() != ",":
            return "\r" if found.group() == "\r" and not text.startswith("\n", found.end()) else "\n"
        at = found.end()


_FIELD_END = re.compile(r"[,\r\n]")


def _row_end(spark: SparkSession, path: str) -> str:
    """Row end of one file, from its first bytes."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
    stream = where.getFileSystem(conf).open(where)
    stream = codec.createInputStream(stream) if codec is not None else stream
    try:
        held = b""
        while True:
            more = bytes(stream.readNBytes(max(_HEAD, len(held))))
            held += more
            found = first_row_end(held.decode("latin-1"), whole=not more)
            if found:
                return found
    finally:
        stream.close()


def _files(spark: SparkSession, path: str | list[str]) -> tuple[int, list[str]]:
    """Size of the largest file, and the files whose rows end with CR alone."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", F.col("_metadata.file_path").alias("file")).collect()
    with ThreadPoolExecutor(_HEADS_AT_ONCE) as pool:
        ends = list(pool.map(lambda f: _row_end(spark, f["path"]), files))
    return max((f["length"] for f in files), default=0), [f["file"] for f, end in zip(files, ends) if end == "\r"]


def csv_step(line: str, state: int) -> tuple[int, int, int]:
    """State after a line of CSV; a quote opens only where a field begins. There is no depth."""
    if '"' not in line:
        return state, 0, 0
    at = 0
    while True:
        if state == OUTSIDE and line.startswith('"', at):
            at, state = at + 1, INSIDE
        if state != OUTSIDE:
            closed = _REST_OF_QUOTED.match(line, at)
            if closed is None:
                return INSIDE, 0, 0
            at, state = closed.end(), OUTSIDE
        at = line.find(",", at) + 1
        if not at:
            return OUTSIDE, 0, 0


_UNQUOTED: tuple[Effect, ...] = ((OUTSIDE, 0, 0, 0), (INSIDE, 0, 0, -1), (INSIDE, 0, 0, -1))


def csv_effect(line: str) -> tuple[Effect, ...]:
    """Effect of a line for each start state; it ends a record where it ends outside quotes."""
    if '"' not in line:
        return _UNQUOTED
    line = line.replace("\r", "")
    ends = [csv_step(line, start)[0] for start in (OUTSIDE, INSIDE)]
    outside, inside = [(end, 0, 0, 0 if end == OUTSIDE else -1) for end in ends]
    return outside, inside, inside


def _by_split(lines: DataFrame, sep: str) -> DataFrame:
    """POSITION and `record`, without headers and blank records; lines are read by split. Texts are not staged: the files hold them."""
    splits = stage(splits_of(lines), "csv-splits")
    found = reassemble(lines, inside=sep, keep_returns=True, keep_blank=True, trim=False, effect_of=csv_effect, step=csv_step, splits=splits)
    record = F.regexp_replace("record", r"\r\z", "") if sep == "\n" else F.col("record")
    found = found.select("file", "block", F.col("idx").alias("pos"), record.alias("record")).filter("record <> ''")
    # Nothing but blank records can come before a file's first line that is not blank: there its header begins.
    heads = splits.filter("first IS NOT NULL").groupBy("file").agg(F.min(F.struct("block", F.col("first").alias("pos"))).alias("at"))
    heads = stage(heads, "csv-heads").select("file", "at.*", F.lit(True).alias("head"))
    return found.join(broadcast_checked(heads), ["file", "block", "pos"], "left").filter("head IS NULL").drop("head")


def _lines(text: str, sep: str) -> Iterator[str]:
    """Lines of a text one by one; what ends it is no line of its own."""
    at = 0
    while at < len(text):
        end = text.find(sep, at)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end + len(sep)


def rows_of(text: str, sep: str) -> Iterator[str]:
    """Rows of a whole file. One that is still open at its end keeps its last row end."""
    held: list[str] = []
    state = OUTSIDE
    for line in _lines(text, sep):
        if state == OUTSIDE and '"' not in line:
            yield line
            continue
        held.append(line)
        state = csv_step(line.replace("\r", "") if "\r" in line else line, state)[0]
        if state == OUTSIDE:
            yield sep.join(held)
            held = []
    if held:
        yield sep.join(held) + (sep if text.endswith(sep) else "")


def _walk_files(sep: str):
    def told(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
        files, places, records = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array([0] * len(rows), pa.int64()), pa.array(places, pa.int64()), pa.array(records, pa.string())], names=["file", "block", "pos", "record"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, chars = [], 0
        for batch in batches:
            for file, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                head = True
                for place, record in enumerate(rows_of(text.as_py(), sep)):
                    record = record.removesuffix("\r") if sep == "\n" else record
                    if not record or head:
                        head = head and not record
                        continue
                    rows.append((file, place, record))
                    chars += len(record) + 100
                    if chars > _BATCH_CHARS:
                        yield told(rows)
                        rows, chars = [], 0
        if rows:
            yield told(rows)

    return run


def _by_file(spark: SparkSession, path: str | list[str], sep: str, among: Column | None) -> DataFrame:
    """POSITION and `record`, without headers and blank records; every file is one row on the way."""
    files = spark.read.text(path, wholetext=True)
    files = files if among is None else files.filter(among)
    files = files.select(F.col("_metadata.file_path").alias("file"), F.make_valid_utf8("value").alias("value"))
    return files.mapInArrow(_walk_files(sep), "file string, block bigint, pos bigint, record string")


def _records(spark: SparkSession, path: str | list[str], whole_file: int) -> DataFrame:
    """POSITION and `record`, without headers and blank records."""
    largest, cr_files = _files(spark, path)
    ends_with_cr = F.col("_metadata.file_path").isin(cr_files)
    by_end = [("\n", ~ends_with_cr), ("\r", ends_with_cr)] if cr_files else [("\n", None)]
    if largest <= whole_file:
        parts = [_by_file(spark, path, sep, among) for sep, among in by_end]
    else:
        parts = [_by_split(scan_lines(spark, path, keep_cr=True, sep=sep, among=among), sep) for sep, among in by_end]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def scan_csv(
    spark: SparkSession, path: str | list[str], columns: list[str], multi_line: bool = True, ragged: str = "fail", position: bool = False,
    whole_file: int = WHOLE_FILE,
) -> DataFrame:
    """Header skipped, columns bound by position, unquoted empty = NULL, quoted empty = ''.

    A row with another number of fields fails the job; `ragged="pad"` fills short rows with NULL and fails for
    long ones. `position` adds POSITION, which sorts rows in file order. `multi_line` allows quoted line
    breaks and keeps them as they are: files up to `whole_file` bytes are a task each, and if one is larger, all are read by split;
    the rows are the same. Without it every line is a record, whatever ends it. A quote that is never closed takes the rest of the file.
    """
    surplus = "__surplus"
    schema = text_schema([*columns, surplus] if ragged == "pad" else columns)
    options = {
        "quote": '"', "escape": '"', "nullValue": "\x01", "emptyValue": "", "maxCharsPerColumn": "-1", "maxColumns": str(max(20480, len(columns))),
        "mode": "FAILFAST" if ragged == "fail" else "PERMISSIVE",
    }
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos")]
    if multi_line:
        rows = _records(spark, path, whole_file).withColumn("row", F.from_csv("record", ", ".join(f"`{c}` string" for c in schema.names), options))
        rows, place = rows.select("row.*", "file", "block", "pos"), ["file", "block", "pos"]
    else:
        reader = spark.read.schema(schema).options(header=True, enforceSchema=True, columnPruning=False, **options)
        rows = reader.csv(path)
    picked = [F.col(f"`{c}`") for c in columns]
    if ragged == "pad":
        message = F.concat(F.lit("more fields than columns: "), F.col(surplus))
        picked[0] = F.when(F.col(surplus).isNull(), picked[0]).otherwise(F.raise_error(message)).alias(columns[0])
    return rows.select(*picked, *(place if position else []))
