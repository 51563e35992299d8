import hashlib
import random
import re

import pytest

from loadkit.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, mix):
    """rows of (id, text, source): (id, size, source, target, copies) by one queue in memory."""
    sized = [(k, len(WORD.findall(t or "")), s) for k, t, s in rows]
    sources = sorted({s for *_, s in sized}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(sources)}
    total = {s: sum(n for _, n, x in sized if x == s) for s in sources}
    budget = mix.share * sum(total.values())
    open_, target = set(sources), {}
    while True:
        rest = budget - sum(target.values())
        level = {s: weight[s] * rest / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if level[s] > mix.most * total[s]]
        if not above:
            target |= level
            break
        for s in above:
            target[s] = float(mix.most * total[s])
            open_.discard(s)
    queue = []
    for p, s in enumerate(sources):
        mine = sorted((hashlib.md5(f"{mix.seed}:{k}".encode()).hexdigest() if k is not None else hashlib.md5(mix.seed.encode()).hexdigest(), -1 if k is None else k, n, i) for i, (k, n, x) in enumerate(sized) if x == s)
        for turn in range(mix.most):
            through = turn * total[s]
            for *_, n, i in mine:
                through += n
                if n:
                    queue.append((through / target[s], p, turn, i, n))
    copies, used = [0] * len(rows), 0
    for *_, i, n in sorted(queue):
        used += n
        if used > budget:
            break
        copies[i] += 1
    return sized, target, copies, total


def run(spark, rows, mix):
    frame = spark.createDataFrame([(k, t, s, 1, 2.0) for k, t, s in rows], "doc_id long, text string, source string, size int, target double")
    return mixing.mix_sources(mixing.measure(frame, mix), mix).collect()


@pytest.mark.parametrize("range_rows", [8192, 5])
def test_like_one_queue(spark, range_rows):
    source = random.Random(9)
    names = ["a"] * 60 + ["b", "c", "é", "Z", None, "", "c", "b"] * 5
    rows = [(i, "w " * source.choice([0, 1, 5, 30, 200]), s) for i, s in enumerate(names)] + [(7, None, "a"), (200, "x" * 10_000, "b"), (201, " ".join(["w"] * 3000), None)]
    mix = mixing.Mix(range_rows=range_rows)
    sized, target, copies, total = plain(rows, mix)
    got = sorted((r.doc_id, r.size, r.source or "-", r.source_size, round(r.target, 6), r.taken) for r in run(spark, rows, mix))
    want = sorted((k, n, s or "-", total[s], round(target[s], 6), n * c) for (k, n, s), c in zip(sized, copies))
    assert got == want
    taken = {}
    for r in run(spark, rows, mix):
        assert r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    largest = max(n for _, n, _ in sized)
    assert all(abs(taken[s] - target[s]) <= largest for s in target)


def test_odd_rows(spark):
    mix = mixing.Mix()
    assert run(spark, [], mix) == []
    assert [(r.size, r.copies, r.target) for r in run(spark, [(1, None, None), (None, "", "a")], mix)] == [(0, 0, 0.0)] * 2
    same = run(spark, [(5, "a b", "x")] * 4 + [(None, "a b", "x")] * 2, mix)
    assert sum(r.taken for r in same) == 18 and len(same) == 6 and all(r.copies in (1, 2) for r in same)


def test_weights_and_caps(spark):
    sizes = [("a", 100), ("b", 100), ("c", 1000), ("d", 10)]
    frame = spark.createDataFrame(sizes, "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame, mixing.Mix()).collect()}
    assert got["a"] == 200 and got["b"] == 200 and got["d"] == 20 and got["c"] == 1.5 * 1210 - 420
