import numpy as np
import pytest

from loadkit.llm import topk


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, vector array<long>, ids string, score int")


def plain(queries, rows, k):
    out = []
    for q, a in sorted({q: a for q, a in queries}.items()):
        dot = lambda b: sum(x * y for x, y in zip(a, b))
        best = sorted(((-dot(b), i) for i, b in rows if i != q))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return out


def run(queries, candidates, k):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(queries, candidates, k).collect())


def test_like_all_pairs(spark, monkeypatch):
    source = np.random.default_rng(7)
    rows = [(i, source.integers(-2, 3, 6).tolist()) for i in range(200)]
    rows += [(300, []), (301, [1]), (302, [0] * 6), (303, [5] * 9)]
    for block in (2048, 7):
        monkeypatch.setattr(topk, "BLOCK", block)
        frame = frame_of(spark, rows)
        asked = frame.filter("vec_id % 20 = 0 OR vec_id >= 300")
        assert run(asked, frame, 20) == plain([r for r in rows if r[0] % 20 == 0 or r[0] >= 300], rows, 20)


def test_large_weights(spark):
    rows = [(0, [1 << 30, 3]), (1, [1 << 31, 1]), (2, [(1 << 31) + 1, -5]), (3, [-1, -1])]
    assert run(frame_of(spark, rows), frame_of(spark, rows), 2) == plain(rows, rows, 2)


def test_odd_rows(spark):
    rows = [(None, [1, 2]), (1, None), (2, [1, 1]), (3, [1, 1]), (3, [1, 1]), (4, [2, 0])]
    frame = frame_of(spark, rows)
    good = [r for r in rows if r[0] is not None and r[1] is not None]
    assert run(frame, frame, 20) == plain(good, good, 20)
    assert run(frame, frame.limit(0), 20) == run(frame.limit(0), frame, 20) == []


def test_usable_and_integers(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v) for i, v in enumerate([[0.5, -0.01], [nan], [inf], [-inf], [None], None, []])]
    frame = spark.createDataFrame(rows, "i int, v array<float>")
    assert [r.i for r in frame.filter(topk.usable(frame.v)).orderBy("i").collect()] == [0, 6]
    assert frame.filter("i = 0").select(topk.integers(frame.v, 64).alias("x")).first().x == [32, -1]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_partition_selection(k):
    source = np.random.default_rng(8)
    scores, ids = source.integers(0, 4, 30), source.permutation(30)
    want = sorted(range(30), key=lambda i: (-scores[i], ids[i]))[:k]
    assert topk.best_of(scores, ids, k).tolist() == want


def test_nothing_is_broadcast_and_lists_are_merged_in_the_task(spark, monkeypatch):
    """Queries meet all blocks without a join, whose smaller side would go to the driver multiplied by the blocks; a task tells a query's best once for a chunk."""
    rows = [(i, np.random.default_rng(i).integers(-9, 10, 5).tolist()) for i in range(120)]
    frame = frame_of(spark, rows)
    found = topk.search(frame.filter("vec_id % 20 = 0"), frame, 3)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    for block, chunk, group in ((2048, 1 << 22, 1 << 19), (7, 100, 1 << 19), (7, 1 << 22, 10)):
        for name, value in (("BLOCK", block), ("CHUNK", chunk), ("GROUP", group)):
            monkeypatch.setattr(topk, name, value)
        assert run(frame.filter("vec_id % 20 = 0"), frame, 3) == plain([r for r in rows if r[0] % 20 == 0], rows, 3)


@pytest.mark.parametrize("size", [3, 1 << 18, 1 << 28, 1 << 40])
def test_sums_are_exact_and_rare_terms_count(spark, monkeypatch, size):
    """Each width of sums; most terms are in few vectors, one is in all, and many scores tie."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    source = np.random.default_rng(3)
    rows = []
    for i in range(90):
        vector = [int(source.integers(-size, size))] + [0] * 30
        for t in source.integers(1, 31, 3):
            vector[t] = int(source.integers(1, 3))
        rows.append((i % 80, vector))
    asked = [(q, [min(size, 1 << 20), *rows[q][1][1:]]) for q in (0, 7, 33)] + [(1 << 20, [1] * 31)]
    assert run(frame_of(spark, asked), frame_of(spark, rows), 8) == plain(asked, rows, 8)
