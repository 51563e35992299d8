"""Importance resampling towards a target corpus: texts are drawn by how much their word pairs look like the target's.

Words and pairs of neighbouring words are hashed into buckets. The bucket counts of the source and of the target give an array of gains, one for
each bucket; a text's weight is the mean gain of its features. Gumbel noise from a digest of the id turns the
highest scores into a draw without replacement.

The highest scores are found by parallel sorting by regular sampling. Every input split is sorted as a run and gives every
n-th key of it; the sorted samples give splitters, again at regular distances, so that a segment between two splitters
holds a bounded share of the rows. Rows are exchanged by segment and merged there, and the counts of the
segments before it give each row its exact rank. Segments behind the last rank are not sorted.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import texts_of
from loadkit.session import broadcast_checked, stage

# The feature space and the noise.
BUCKETS = 10_000
SEED = "7"
LEAST_WORDS = 20
SHARE = 25
# Words after ASCII lower-casing; bytes from 0x80 belong to characters that are all word characters.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# Longer words are hashed one by one.
SHORT = 48
# Samples for each segment. Together they are all that the driver sees of the keys.
SAMPLES = 16
SEGMENT_ROWS = 1 << 20
MOST_SEGMENTS = 1 << 12


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _feed(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC states after the given words, a byte of all words at a time; `sizes` must descend."""
    state = state.copy()
    for at in range(int(sizes[0]) if len(sizes) else 0):
        held = int(np.searchsorted(-sizes, -at, side="left"))
        part = state[:held]
        state[:held] = _CRC[(part ^ data[starts[:held] + at]) & 0xFF] ^ (part >> 8)
    return state


def features(text: str) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every feature: all words, then all pairs of neighbours."""
    raw = text.encode().lower()
    spans = np.array([m.span() for m in WORD.finditer(raw)], dtype=np.int64).reshape(-1, 2)
    n = len(spans)
    if not n:
        return 0, np.zeros(0, np.int64)
    data = np.frombuffer(raw, np.uint8)
    starts, sizes = spans[:, 0], spans[:, 1] - spans[:, 0]
    order = np.argsort(-np.minimum(sizes, SHORT + 1), kind="stable")
    short = order[np.searchsorted(-np.minimum(sizes, SHORT + 1)[order], -SHORT) :]
    state = np.full(n, 0xFFFFFFFF, np.uint32)
    state[short] = _feed(state[short], data, starts[short], sizes[short])
    for i in np.flatnonzero(sizes > SHORT).tolist():
        state[i] = zlib.crc32(raw[starts[i] : starts[i] + sizes[i]]) ^ 0xFFFFFFFF
    spaced = _CRC[(state ^ 32) & 0xFF] ^ (state >> 8)
    pairs = np.zeros(n, np.uint32)
    later = short[short > 0]
    pairs[later] = _feed(spaced[later - 1], data, starts[later], sizes[later])
    for i in np.flatnonzero(sizes > SHORT).tolist():
        if i:
            pairs[i] = zlib.crc32(raw[starts[i] : starts[i] + sizes[i]], int(spaced[i - 1]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    found = np.concatenate((state, pairs[1:])) ^ np.uint32(0xFFFFFFFF)
    return n, (found % BUCKETS).astype(np.int64)


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Features of all texts by bucket. Each task sums its own; the driver gets one row for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for t in texts_of(batch, text):
                counts += np.bincount(features(t)[1], minlength=BUCKETS)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    sums = docs.select(text).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for r in sums.collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of the smoothed shares of each bucket."""
    s, t = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def noise(key: object, seed: str = SEED) -> int:
    """floor(1000 * Gumbel noise) from a digest of the id; a null id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", key: str = "doc_id", seed: str = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, n_words) of every row. Texts without words (null too) weigh 0."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [(n, len(b), int(gain[b].sum()) // len(b) if n else 0) for n, b in map(features, texts_of(batch, text))]
            words, counts, weights = (np.array(c, np.int64) for c in zip(*found))
            scores = weights + np.array([noise(k, seed) for k in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (counts, weights, scores, words))], names=["doc_id", "n_features", "weight", "score", "n_words"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias(text)).mapInArrow(run, f"doc_id {kind}, n_features bigint, weight bigint, score bigint, n_words bigint")


def _packed(*columns: np.ndarray) -> np.ndarray:
    """Rows of signed 64-bit integers as fixed byte strings of the same order."""
    flipped = [(c.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8) for c in columns]
    return np.ascontiguousarray(np.concatenate(flipped, axis=1)).view(f"S{8 * len(columns)}").ravel()


def _every(step: int):
    """Every `step`-th row of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            first = (-seen - 1) % step
            seen += batch.num_rows
            if first < batch.num_rows:
                yield batch.take(pa.array(range(first, batch.num_rows, step)))

    return run


def exact_ranks(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Adds `rank`, from 1, to the first `most` rows in ascending order of the keys, null to the others.

    `rows` must be staged; keys are integers without nulls and the last one is unique, so any number of equal first keys is cut anywhere.
    """
    n = rows.count()
    cores = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = min(MOST_SEGMENTS, max(cores, -(-n // SEGMENT_ROWS)))
    step = max(1, n // (SAMPLES * segments))
    schema = ", ".join(f"`{k}` bigint" for k in keys)
    samples = rows.select(*[F.col(k).cast("bigint").alias(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(_every(step), schema)
    # At most SAMPLES * segments keys and one for the remainder, whatever the size of the input.
    found = samples.toArrow()
    packed = np.sort(_packed(*[found.column(k).to_numpy() for k in keys]))
    splitters = packed[np.arange(1, segments) * len(packed) // segments] if len(packed) else packed

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = _packed(*[batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys])
                at = np.searchsorted(splitters, key, side="right").astype(np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "segment"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = stage(rows.mapInArrow(place, f"{fields}, segment bigint"), "resample-segments")
    counts = placed.groupBy("segment").agg(F.count("*").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = broadcast_checked(stage(counts.select("segment", before.alias("before")), "resample-counts"))
    known = placed.join(counts, "segment")
    inside = F.row_number().over(Window.partitionBy("segment").orderBy(*keys)) + F.col("before")
    drawn = known.filter(F.col("before") < most).withColumn("rank", inside.cast("bigint"))
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = known.filter(F.col("before") >= most).withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.unionByName(rest).drop("segment", "before")


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least: int = LEAST_WORDS, text: str = "text", key: str = "doc_id", target_text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; `share` percent of those with `least` words or more have a rank.

    Ids are integers. Ties go to the smaller id, null first, then to the lighter text. Null and empty texts
    have no features, weigh 0 and are not drawn. Repeated rows are drawn each; no rows give no rows, and an empty target weighs all features by their rarity. Other columns are not read.
    """
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    weighed = weigh(docs, gain, text, key).withColumn("row", F.monotonically_increasing_id())
    lowest = F.lit(-(1 << 63)).cast("bigint")
    weighed = weighed.withColumn("down", -F.col("score")).withColumn("tie", F.coalesce(F.col("doc_id").cast("bigint"), lowest))
    weighed = stage(weighed, "resample-weights")
    eligible = weighed.filter(F.col("n_words") >= least)
    drawn = exact_ranks(eligible, ["down", "tie", "weight", "n_features", "row"], eligible.count() * share // 100)
    rest = weighed.filter(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
