"""Near-duplicates by 64-bit SimHash fingerprints, found exactly with pivot distance tables.

Keys of bit parts bring fingerprints together; pivot tables prune the pairs of a key.

Distances to reference fingerprints (pivots) are coordinates: two fingerprints within r bits differ by at most r in
every coordinate. Two kinds of pivots serve.

Single-bit pivots give blocking keys: the distances to the pivots of a part of the bits, less the distance to zero, spell that
part. Cut into six parts, two fingerprints within four bits agree in at least two, so every link shares one of fifteen keys.

Random pivots then form a table for each key's fingerprints. Pairs are discarded by their largest coordinate difference;
survivors are verified bit by bit. A key gives a spanning forest of its links, never all pairs. Keys with many
fingerprints are cut into chunks, and pairs of chunks become tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import map_batches, texts_of, unused
from loadkit.session import stage

SHINGLE = 4
SEED = 42
RADIUS = 4
PARTS = 6
# Fingerprints of one key that one task compares; a key with more is cut into chunks of half as many.
GROUP = 4096
PIVOTS = np.random.default_rng(2).integers(0, 1 << 64, 24, dtype=np.uint64)


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of each bit over the XXH64 hashes of the text's shingles; zero without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, bits) and the columns in `keep`; bits is the fingerprint as a signed long. Null texts count as empty."""
    given = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *keep)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits = np.array([fingerprint(t) for t in texts_of(batch, "text")], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits), *batch.columns[2:]], names=["doc_id", "bits", *keep])

    fields = [f"doc_id {given.schema['doc_id'].dataType.simpleString()}", "bits bigint", *[f"{k} {given.schema[k].dataType.simpleString()}" for k in keep]]
    return map_batches(given, run, ", ".join(fields))


def keys_of(bits: np.ndarray) -> np.ndarray:
    """Column for each pair of parts: the bits of both, hashed with the pair's number."""
    edges = np.linspace(0, 64, PARTS + 1).astype(int)
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    columns = [(bits & np.uint64(masks[i] | masks[j])) for i, j in combinations(range(PARTS), 2)]
    mixed = [(c ^ np.uint64(n + 1)) * np.uint64(0x9E3779B97F4A7C15) for n, c in enumerate(columns)]
    return np.stack([m ^ (m >> np.uint64(29)) for m in mixed], axis=1)


def _spread(batch: pa.RecordBatch) -> pa.RecordBatch:
    bits = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
    keys = keys_of(bits)
    return pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(bits.view(np.int64), keys.shape[1]))], names=["key", "bits"])


def _roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def forest(bits: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member it reaches) among fingerprints of the same group."""
    table = np.bitwise_count(bits[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], group))
    bits, group, table = bits[order], group[order], np.ascontiguousarray(table[order].T)
    root = np.arange(len(bits))
    lefts, rights, held, shift = [], [], 0, 0
    here = np.arange(len(bits))
    while len(here):
        shift += 1
        here = here[here + shift < len(bits)]
        # Members are in order of the first coordinate, so once it differs by more than the radius it always does.
        here = here[(group[here] == group[here + shift]) & (table[0][here + shift] - table[0][here] <= radius)]
        pair = here[root[here] != root[here + shift]]
        for column in table[1:]:
            if not len(pair):
                break
            pair = pair[np.abs(column[pair] - column[pair + shift]) <= radius]
        pair = pair[np.bitwise_count(bits[pair] ^ bits[pair + shift]) <= radius]
        if len(pair):
            lefts.append(pair)
            rights.append(pair + shift)
            held += len(pair)
        if held > len(bits):
            root = _roots(len(bits), np.concatenate([*lefts, np.arange(len(bits))]), np.concatenate([*rights, root]))
            lefts, rights, held = [], [], 0
    if held:
        root = _roots(len(bits), np.concatenate([*lefts, np.arange(len(bits))]), np.concatenate([*rights, root]))
    child = np.flatnonzero(root != np.arange(len(bits)))
    return bits[child], bits[root[child]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        if len(flat):
            a, b = forest(flat, np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints within the radius into the right components."""
    keyed = stage(map_batches(distinct, _spread, "key bigint, bits bigint"), "simhash-keys")
    counts = keyed.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    counts = stage(counts, "simhash-counts")
    shared = keyed.join(counts, "key")
    small = shared.filter(F.col("members") <= GROUP).groupBy("key").agg(F.collect_list("bits").alias("bits"))
    found = small.select("bits").mapInArrow(_links, "a bigint, b bigint")
    if counts.filter(F.col("members") > GROUP).limit(1).count():
        chunks = F.ceil(F.col("members") / (GROUP // 2)).cast("int")
        chunk = F.pmod(F.xxhash64("bits"), chunks)
        large = shared.filter(F.col("members") > GROUP).select("key", "bits", chunk.alias("chunk"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
        pairs = large.groupBy("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")).agg(F.collect_list("bits").alias("bits"))
        found = found.unionByName(pairs.select("bits").mapInArrow(_links, "a bigint, b bigint"))
    return stage(found.distinct(), "simhash-links")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of (a, b) reaches, by alternating stars.

    Neighbours are only ever reduced to their minimum, so a node with many links needs no list of them.
    """
    current = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "cc")
    seen = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").unionByName(low.select("u", F.col("low").alias("v")))
        current = stage(small.distinct(), "cc")
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def classes(marked: DataFrame) -> DataFrame:
    """(bits, root, component_id) of staged (doc_id, bits): the smallest fingerprint and the smallest doc_id that each fingerprint reaches."""
    first = stage(marked.groupBy("bits").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(first.select("bits")))
    rooted = first.join(roots, first.bits == roots.node, "left").select("bits", "first", F.coalesce("root", "bits").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(named, "root").select("bits", "root", "component_id")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component, all columns kept: that with the smallest id, then with the smallest hash of its text.

    Shingles and bits are those of `near_duplicates`. Rows without an id stay only where no row with one is near. Of repeated
    rows one stays. Texts without words (null too) are near each other, so one of them stays. No rows give no rows.
    """
    columns = docs.columns
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("mark"))
    marked = stage(fingerprints(named, keep=("mark",)), "simhash-marked")
    rows = marked.groupBy("doc_id", "mark", "bits").agg(F.count("*").alias("copies"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark", "copies")).alias("best")
    chosen = stage(rows.join(classes(marked), "bits").groupBy("root").agg(best).select("best.*"), "simhash-chosen")

    mark, wanted_key, wanted_mark = (unused(columns, f"_{n}") for n in ("mark", "wanted_key", "wanted_mark"))
    keyed = docs.withColumn(mark, F.xxhash64(F.col(text)))

    def held(part: DataFrame) -> DataFrame:
        wanted = part.select(F.col("doc_id").alias(wanted_key), F.col("mark").alias(wanted_mark))
        return keyed.join(wanted, F.col(key).eqNullSafe(F.col(wanted_key)) & (F.col(mark) == F.col(wanted_mark)), "left_semi")

    out = held(chosen.filter("copies = 1"))
    repeated = chosen.filter("copies > 1")
    if repeated.limit(1).count():
        out = out.unionByName(held(repeated).dropDuplicates([key, mark]))
    return out.select(*columns)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    Fingerprints within four bits link; component_id is the smallest doc_id reachable. Texts without words
    (null too) have fingerprint zero and link like others. Repeated rows stay; rows with a null id take part, and a
    component of such rows alone has a null component_id. No rows give no rows; other columns are not read.
    """
    marked = stage(fingerprints(docs, text, key), "simhash-marked")
    found = stage(classes(marked), "simhash-classes")
    return marked.join(found, "bits").select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
