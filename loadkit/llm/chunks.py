"""Passages that repeat across documents, by content-defined chunking.

A gear hash rolls over the bytes of each whole text; where it falls below a threshold, a chunk ends. Where it stays above for
long, as in text of few different words, it ends where the hash is lowest among its neighbours. Both see nearby bytes
only, so equal passages are cut alike, but for their first and last few dozen bytes, wherever they stand, and an insertion moves no cut behind
it. Chunks are compared by digest. Repeated chunks that follow each other make a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import map_batches, unused
from loadkit.session import stage

WINDOW = 16
# Mean distance of cuts, in bytes. A cut that follows another within LEAST bytes does not count.
MEAN, LEAST = 24, 8
# Where no cut is this near, the lowest hashes within this distance cut.
NEAR = 24
# Words of repeated chunks in a row that make a passage: one of 50 words keeps so many besides the chunks at its edges.
# In text with fewer spaces than that so many bytes do.
WORDS, BYTES = 28, 512
GEAR = np.random.default_rng(9).integers(0, 1 << 32, 256, dtype=np.uint32)
_BELOW = np.uint32((1 << 32) // MEAN)
_PIECE = 1 << 22


def gear(raw: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes up to each place: the sum of GEAR[byte] << age, built up by doubling the window."""
    rolled, width = GEAR[raw], 1
    while width < WINDOW:
        older = np.zeros_like(rolled)
        older[width:] = rolled[:-width] << np.uint32(width)
        rolled = rolled + older
        width *= 2
    return rolled


def cuts(raw: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text, the last one at its end."""
    found, lows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(raw), _PIECE):
        # The pieces overlap by a window, so long texts are cut as a whole would be.
        start, stop = max(0, at - NEAR - WINDOW + 1), min(len(raw), at + _PIECE + NEAR)
        hashes = gear(raw[start:stop])
        found.append(np.flatnonzero(hashes[at - start : at - start + _PIECE] < _BELOW) + at + 1)
        if len(hashes) > 2 * NEAR:
            low = np.flatnonzero(hashes[NEAR : len(hashes) - NEAR] == _least(hashes)) + start + NEAR + 1
            lows.append(low[(low > at) & (low <= at + _PIECE)])
    ends, low = np.concatenate(found), np.concatenate(lows)
    # The hash is of full windows only from here on.
    ends = ends[ends >= WINDOW]
    ends = ends[np.diff(ends, prepend=-LEAST) >= LEAST]
    ends = ends[ends < len(raw)]
    low = low[(low >= WINDOW + NEAR) & (low + NEAR < len(raw))]
    low = low[np.searchsorted(ends, low - NEAR) == np.searchsorted(ends, low + NEAR, side="right")]
    return np.append(np.sort(np.concatenate([ends, low])), len(raw)) if len(raw) else ends


def _least(hashes: np.ndarray) -> np.ndarray:
    """The least of each hash and its NEAR neighbours on either side, where it has as many: built up by doubling."""
    least, width = hashes, 1
    while width < 2 * NEAR + 1:
        step = min(width, 2 * NEAR + 1 - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def _chunk(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    out: dict[str, list] = {n: [] for n in ("doc_id", "mark", "start", "stop", "size", "words", "high", "low")}
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal held
        arrays = [pa.array(np.concatenate(v)) for v in out.values()]
        made = pa.RecordBatch.from_arrays(arrays, names=list(out))
        for v in out.values():
            v.clear()
        held = 0
        return made

    digest = xxhash.xxh3_128_digest
    for key, mark, text in zip(*(c.to_pylist() for c in batch.columns)):
        raw = (text or "").encode()
        bytes_of = np.frombuffer(raw, np.uint8)
        ends = cuts(bytes_of)
        if not len(ends):
            continue
        starts = np.concatenate(([0], ends[:-1]))
        # Places in code points: count the bytes that begin one.
        point = np.concatenate(([0], np.cumsum((bytes_of & 0xC0) != 0x80, dtype=np.int32))) if len(raw) != len(text) else None
        digests = np.frombuffer(b"".join([digest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]), np.int64).reshape(-1, 2)
        # Equal chunks in a row, as in text that repeats itself, share a row from the first to the last.
        first = np.flatnonzero(np.concatenate(([True], (digests[1:] != digests[:-1]).any(axis=1))))
        starts, ends, digests = starts[first], ends[np.append(first[1:], len(ends)) - 1], digests[first]
        space = (bytes_of == 32) | ((bytes_of >= 9) & (bytes_of <= 13))
        begun = np.concatenate(([0], np.cumsum(~space & np.concatenate(([True], space[:-1])), dtype=np.int32)))
        # A cut may fall inside a character, which then counts with the chunk where it begins.
        places = (starts, ends) if point is None else (point[starts], point[ends])
        given = [np.full(len(ends), key), np.full(len(ends), mark), *[p.astype(np.int32) for p in (*places, ends - starts, begun[ends] - begun[starts])], digests[:, 0], digests[:, 1]]
        for name, values in zip(out, given):
            out[name].append(values)
        held += len(ends)
        if held > 100_000:
            yield flush()
    if held:
        yield flush()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _chunk(batch)


NO_ID = (1 << 63) - 1


def chunked(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, mark, start, stop, size, words, high, low) of every chunk; the mark tells documents apart, repeated rows share it.

    A word counts where it begins; high and low are the halves of a digest of 128 bits. Equal chunks in a row are one row.
    """
    number = F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID))
    given = docs.select(number.alias("doc_id"), F.xxhash64(F.col(key), F.col(text)).alias("mark"), F.col(text).alias("text"))
    return given.mapInArrow(_chunks, "doc_id bigint, mark bigint, start int, stop int, size int, words int, high bigint, low bigint")


def passages(docs: DataFrame, text: str = "text", key: str = "doc_id", least_words: int = WORDS, least_bytes: int = BYTES) -> DataFrame:
    """(doc_id, mark, start, stop, n_bytes, first_doc_id, removable): places of repeated passages, in code points.

    A chunk repeats if two different documents hold it; one that repeats within a document alone does not.
    Repeated chunks in a row of `least_words` words or `least_bytes` bytes are a passage, split where `removable` changes: a chunk is removable in
    all documents but the one with the smallest id that holds it. Documents without such a passage have no row; null and empty texts
    have none. Repeated rows are one document, as are its places. Ids are integers; null ids stay null and come last. Other
    columns are not read; no rows give no rows.
    """
    seen = chunked(docs, text, key).groupBy("high", "low").agg(F.min("mark").alias("first_mark"), F.max("mark").alias("last_mark"), F.min("doc_id").alias("first"))
    repeated = stage(seen.filter("first_mark <> last_mark").select("high", "low", "first"), "chunk-repeated")
    places = chunked(docs, text, key).join(repeated, ["high", "low"]).select("doc_id", "mark", "start", "stop", "size", "words", "first").distinct()
    by_mark = Window.partitionBy("mark", "doc_id").orderBy("start", "stop")
    runs = places.withColumn("fresh", F.coalesce((F.lag("stop").over(by_mark) != F.col("start")).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("fresh").over(by_mark.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("mark", "doc_id", "run")
    runs = runs.withColumns({"n_words": F.sum("words").over(whole), "n_bytes": F.sum("size").over(whole)})
    runs = runs.filter((F.col("n_words") >= least_words) | (F.col("n_bytes") >= least_bytes))
    runs = runs.withColumn("removable", F.col("doc_id") != F.col("first"))
    by_run = Window.partitionBy("mark", "doc_id", "run").orderBy("start", "stop")
    runs = runs.withColumn("turn", F.coalesce((F.lag("removable").over(by_run) != F.col("removable")).cast("int"), F.lit(0)))
    runs = runs.withColumn("part", F.sum("turn").over(by_run.rowsBetween(Window.unboundedPreceding, 0)))
    found = runs.groupBy("mark", "doc_id", "run", "part", "removable").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("size").alias("n_bytes"), F.min("first").alias("first_doc_id"))
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return found.select(named("doc_id"), "mark", "start", "stop", "n_bytes", named("first_doc_id"), "removable")


def remove(docs: DataFrame, found: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows and columns, with the removable places of `found` cut out of the text. Null texts stay null."""
    columns = docs.columns
    mark, where = unused(columns, "_mark"), unused(columns, "_places")
    places = found.filter("removable").groupBy(F.col("mark").alias(mark)).agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias(where))
    marked = docs.withColumn(mark, F.xxhash64(F.col(key), F.col(text))).join(places, mark, "left").select(*columns, where)
    place = columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t if t is None or not p else _without(t, p) for t, p in zip(batch.column(place).to_pylist(), batch.column(len(columns)).to_pylist())]
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == place else c for i, c in enumerate(batch.columns[:-1])], names=columns)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_batches(marked, run, fields)


def _without(text: str, places: list[dict]) -> str:
    out, done = [], 0
    for p in places:
        out.append(text[done : p["start"]])
        done = max(done, p["stop"])
    return "".join([*out, text[done:]])
