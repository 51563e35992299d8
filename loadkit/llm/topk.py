"""Exact top-k inner products by term-at-a-time accumulation.

Vectors are packed into blocks, each with postings by term (component): the members where it is not
zero and their weights. A block of queries scatters its weighted postings into a dense array of scores, one term after the other; terms that
most members have are added at once, as a product of the weights. The best of the array are selected by partition, and later
only by what beats a query's list so far. Every query meets every block.

Candidates are dealt to chunks and queries to groups, both of bounded size, and a task is a chunk and a group: it holds the
postings of the chunk, takes the queries block by block and merges their best over the chunk. A vector goes to as many tasks as there are
groups, or chunks if it is a query's; nothing is broadcast or brought to the driver but counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.session import stage

BLOCK = 2048
QUERY_BLOCK = 512
# Components of a block, of a chunk of candidates and of a group of queries, about.
_BLOCK_VALUES, CHUNK, GROUP = 1 << 20, 1 << 22, 1 << 19
# Tasks for each core, if there are queries enough.
_TASKS = 3


def usable(vector: Column) -> Column:
    """True where a vector has no null and no NaN or infinite component; false for a null vector."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """Each component as floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def _pack(rows: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, values = [], 0, 0

        def out() -> pa.RecordBatch:
            ids, lengths, flat = (np.concatenate(x) for x in zip(*held))
            low, high = int(flat.min(initial=0)), int(flat.max(initial=0))
            width = next(w for w in _WIDTHS if np.iinfo(w).min <= low and high <= np.iinfo(w).max)
            made = [ids.tobytes(), lengths.tobytes(), flat.astype(width).tobytes()]
            return pa.RecordBatch.from_arrays([*[pa.array([m], pa.binary()) for m in made], pa.array([np.dtype(width).itemsize], pa.int32())], names=["ids", "lengths", "flat", "width"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, rows - size)
                vectors = part.column(1)
                flat = vectors.flatten()
                if flat.null_count:
                    raise ValueError("a vector has a null component")
                lengths = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
                held.append((part.column(0).to_numpy().astype(np.int64), lengths, flat.to_numpy().astype(np.int64)))
                at, size, values = at + part.num_rows, size + part.num_rows, values + len(flat)
                if size == rows or values >= _BLOCK_VALUES:
                    yield out()
                    held, size, values = [], 0, 0
        if held:
            yield out()

    return pack


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Rows of up to `rows` vectors each: (ids, lengths, flat, width) as bytes, `width` of a component. Column 1 is the id, 2 the integers."""
    return vectors.mapInArrow(_pack(rows), "ids binary, lengths binary, flat binary, width int")


def _coordinates(lengths: bytes, flat: bytes, width: int):
    sizes = np.frombuffer(lengths, np.int64)
    values = np.frombuffer(flat, f"i{width}")
    member = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = values != 0
    return member[kept], term[kept], values[kept].astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids: selection by partition, then a sort of what is left."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _postings(size: int, member: np.ndarray, term: np.ndarray, value: np.ndarray):
    """Names and weights, a row each for all members, of the terms that more than half the members have, and the members and weights of each other term."""
    order = np.argsort(term, kind="stable")
    member, term, value = member[order], term[order], value[order]
    names, starts = np.unique(term, return_index=True)
    ends = np.append(starts[1:], len(term))
    common = 2 * (ends - starts) > size
    weights = np.zeros((int(common.sum()), size), dtype=np.int64)
    for row, a, b in zip(weights, starts[common], ends[common]):
        row[member[a:b]] = value[a:b]
    rare = {name: (member[a:b], value[a:b]) for name, a, b in zip(names[~common].tolist(), starts[~common], ends[~common])}
    return names[common], weights, rare


def _largest(term: np.ndarray, value: np.ndarray) -> dict[int, int]:
    """The greatest absolute weight of each term."""
    order = np.argsort(term, kind="stable")
    names, starts = np.unique(term[order], return_index=True)
    if not len(names):
        return {}
    low, high = (f.reduceat(value[order], starts).tolist() for f in (np.minimum, np.maximum))
    return {name: max(-a, b) for name, a, b in zip(names.tolist(), low, high)}


class _Block:
    """Candidates of a block: ids, postings and the greatest weight of each term."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        member, term, value = _coordinates(row["lengths"], row["flat"], row["width"])
        self.largest = _largest(term, value)
        self.common, weights, self.rare = _postings(len(self.ids), member, term, value)
        # What 32 bits of a float hold is kept in them.
        self.weights = weights.astype(np.float32) if np.abs(weights).max(initial=0) < 1 << 24 else weights
        self.repeats = int(np.unique(self.ids, return_counts=True)[1].max())


class _Asked:
    """Queries of a block: ids and the weights of each term, a column each."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        member, term, value = _coordinates(row["lengths"], row["flat"], row["width"])
        self.largest = _largest(term, value)
        self.names, column = np.unique(term, return_inverse=True)
        self.weights = np.zeros((len(self.ids), len(self.names)), dtype=np.int64)
        self.weights[member, column] = value


def _kind(block: _Block, asked: _Asked):
    """The narrowest type in which every sum of products stays exact, in whatever order it is added; Python integers if none is wide enough."""
    bound = sum(weight * block.largest.get(name, 0) for name, weight in asked.largest.items())
    return next((kind for kind, bits in ((np.float32, 24), (np.float64, 53), (np.int64, 63)) if bound < 1 << bits), object)


def _scores(block: _Block, asked: _Asked) -> np.ndarray:
    """Scores of all members, a row for each query."""
    kind = _kind(block, asked)
    _, own, theirs = np.intersect1d(asked.names, block.common, assume_unique=True, return_indices=True)
    scores = asked.weights[:, own].astype(kind) @ block.weights[theirs].astype(np.int64 if kind is object else kind, copy=False).astype(kind, copy=False)
    for column, name in enumerate(asked.names.tolist()):
        if name in block.rare:
            # A member has a term once, so the places of one posting list are distinct.
            members, weights = block.rare[name]
            queries = np.flatnonzero(asked.weights[:, column])
            scores[np.ix_(queries, members)] += asked.weights[queries, column].astype(kind)[:, None] * weights.astype(kind)[None, :]
    return scores


def _best_objects(scores, ids, others, k) -> np.ndarray:
    return np.array(sorted(others, key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)


class _Lists:
    """The best k of each query of a block so far, in order."""

    def __init__(self, asked: _Asked, k: int):
        self.asked, self.k = asked, k
        count = len(asked.ids)
        self.held = np.zeros(count, dtype=np.int64)
        self.ids, self.scores = np.zeros((count, k), dtype=np.int64), np.zeros((count, k), dtype=np.int64)

    def add(self, block: _Block) -> None:
        scores, ids = _scores(block, self.asked), block.ids
        if scores.dtype == object:
            chosen = [_best_objects(s, ids, np.flatnonzero(ids != q), self.k) for s, q in zip(scores, self.asked.ids)]
            query, place = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen]), np.concatenate(chosen)
        else:
            query, place = self._near(scores, block)
        if len(query):
            self._merge(query, ids[place], scores[query, place].astype(np.int64))

    def _near(self, scores: np.ndarray, block: _Block) -> tuple[np.ndarray, np.ndarray]:
        """What may come into a list: the best of the block for lists that are not full, else what beats their end."""
        full = np.flatnonzero(self.held == self.k)
        ends, at = self.scores[full, self.k - 1], self.ids[full, self.k - 1]
        query, place = np.nonzero((scores if len(full) == len(scores) else scores[full]) >= ends[:, None].astype(scores.dtype))
        reached = scores[full[query], place].astype(np.int64)
        kept = (reached > ends[query]) | (block.ids[place] < at[query])
        query, place = full[query[kept]], place[kept]
        few = np.flatnonzero(self.held < self.k)
        # The query's own rows are left out below, so as many more are taken.
        chosen = [best_of(scores[q], block.ids, self.k + block.repeats) for q in few]
        query = np.concatenate([query, np.repeat(few, [len(c) for c in chosen])])
        place = np.concatenate([place, *chosen])
        others = block.ids[place] != self.asked.ids[query]
        return query[others], place[others]

    def _merge(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        touched = np.unique(query)
        held = np.arange(self.k) < self.held[touched, None]
        query = np.concatenate([query, np.repeat(touched, self.held[touched])])
        ids, scores = np.concatenate([ids, self.ids[touched][held]]), np.concatenate([scores, self.scores[touched][held]])
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        query, place = query[kept], place[kept]
        self.ids[query, place], self.scores[query, place] = ids[kept], scores[kept]
        self.held[touched] = np.bincount(query, minlength=len(self.held))[touched]

    def told(self) -> pa.RecordBatch:
        held = np.arange(self.k) < self.held[:, None]
        columns = [np.repeat(self.asked.ids, self.held), self.ids[held], self.scores[held]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])


def _score(k: int):
    """Rows sorted by task, candidates first. A task's candidates are held, its queries taken block by block."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, blocks = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["task"] != task:
                    task, blocks = row["task"], []
                if not row["asks"]:
                    blocks.append(_Block(row))
                    continue
                lists = _Lists(_Asked(row), k)
                for block in blocks:
                    lists.add(block)
                yield lists.told()

    return score


def _dealt(vectors: DataFrame, rows: int, parts: int, label: str) -> DataFrame:
    """Packed blocks dealt out evenly to so many `part`s."""
    return stage(packed(vectors.repartition(parts), rows).withColumn("part", F.spark_partition_id()), label)


def search(queries: DataFrame, candidates: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "vector") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest inner products for each query; vectors are arrays of bigint.

    A candidate with the query's own id is not its match. Ties go to the smaller id. Shorter vectors count
    as padded with zeros; empty ones score 0. Rows with a null id or vector take no part. Repeated query rows count once,
    repeated candidate rows each. Sums are exact whatever the weights; a score beyond 64 bits raises an error. Either side may be empty.
    """
    named = lambda df: df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector")).filter("id IS NOT NULL AND vector IS NOT NULL")
    sized = lambda df: tuple(x or 0 for x in df.agg(F.count("*"), F.sum(F.size("vector").cast("bigint"))).first())
    given, asked = named(candidates), stage(named(queries).distinct(), "topk-asked")
    (_, values), (count, asked_values) = sized(given), sized(asked)
    chunks = max(1, -(-values // CHUNK))
    # As many groups as their size asks for, and more to occupy all cores, but none much smaller than a block of queries.
    cores = candidates.sparkSession.sparkContext.defaultParallelism
    groups = max(1, -(-asked_values // GROUP), min(-(-_TASKS * cores // chunks), -(-count // QUERY_BLOCK)))
    blocks = _dealt(given, BLOCK, chunks, "topk-blocks").withColumn("chunk", F.col("part")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = _dealt(asked, QUERY_BLOCK, groups, "topk-queries").withColumn("group", F.col("part")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    both = blocks.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    both = both.select((F.col("chunk") * groups + F.col("group")).alias("task"), "asks", "ids", "lengths", "flat", "width")
    tasks = both.repartitionByRange(chunks * groups, "task").sortWithinPartitions("task", "asks")
    found = tasks.mapInArrow(_score(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
