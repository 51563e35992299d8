import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from loadkit.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(leaves):
    """(root, steps of each leaf): a step holds the digests left and right of the path."""
    nodes, steps, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = p // 16 * 16
            steps[i].append((nodes[run:p], nodes[p + 1 : run + 16]))
        nodes = [H(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at = [p // 16 for p in at]
    return (nodes[0] if nodes else None), steps


def plain(rows):
    """rows of (key, group, leaf): {position: (subroot, root, steps)}."""
    groups = sorted({g for _, g, _ in rows}, key=lambda g: (g is not None, (g or "").encode()))
    order = {g: sorted((i for i, r in enumerate(rows) if r[1] == g), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][2])) for g in groups}
    trees = {g: plain_tree([rows[i][2] for i in order[g]]) for g in groups}
    root, above = plain_tree([trees[g][0] for g in groups])
    return {i: (trees[g][0], root, trees[g][1][n] + above[j]) for j, g in enumerate(groups) for n, i in enumerate(order[g])}


def run(spark, rows):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, doc_id long, source string, leaf string").repartition(3)
    return merkle.manifest(frame, "source", ["doc_id"], ["i", "doc_id"]).collect()


@pytest.mark.parametrize("sizes", [[1], [2, 1], [16, 17, 15], [256, 257, 1], [300] + [3] * 20], ids=str)
def test_against_one_tree_in_memory(spark, sizes):
    source = random.Random(1)
    names = [None, *(f"s{source.random()}" for _ in sizes[1:])] if len(sizes) < 20 else [f"é{i}" if i % 2 else f"Z{i}" for i in range(len(sizes))]
    rows = [(i, g, H(str(source.random()))) for g, n in zip(names, sizes) for i in source.sample(range(10_000), n)]
    want = plain(rows)
    got = run(spark, rows)
    assert len(got) == len(rows)
    for r in got:
        subroot, root, steps = want[r.i]
        assert (r.leaf, r.subroot, r.root) == (rows[r.i][2], subroot, root)
        assert [(p.left, p.right) for p in r.proof] == [("".join(a), "".join(b)) for a, b in steps]


@pytest.mark.parametrize("digits", [1, 2])
def test_rounds_of_blocks(spark, monkeypatch, digits):
    """Small blocks make several rounds, as very many rows would."""
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "BLOCK", merkle.FAN**digits)
    source = random.Random(2)
    rows = [(i, "hot" if i % 3 else f"g{i % 60}", H(str(source.random()))) for i in range(900)]
    want = plain(rows)
    for r in run(spark, rows):
        subroot, root, steps = want[r.i]
        assert (r.subroot, r.root) == (subroot, root)
        assert [(p.left, p.right) for p in r.proof] == [("".join(a), "".join(b)) for a, b in steps]


def test_fold_finds_changes(spark):
    rows = [(i, f"s{i % 4}", H(str(i))) for i in range(70)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, leaf string").withColumn("probe", F.when(F.col("doc_id") % 7 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.col("leaf")))
    found = merkle.manifest(frame, "source", ["doc_id"], ["doc_id", "probe"])
    for r in found.select("doc_id", (merkle.fold(F.col("probe"), "proof") == F.col("root")).alias("same"), (merkle.fold(F.col("leaf"), "proof") == F.col("root")).alias("whole")).collect():
        assert r.whole and r.same == (r.doc_id % 7 != 0)


def test_odd_rows(spark):
    leaf = H("x")
    rows = [(None, None, leaf), (1, None, leaf), (1, None, leaf), (1, "", leaf), (2, "a", H("y")), (2, "a", H("z"))]
    want = plain(rows)
    got = run(spark, rows)
    assert sorted((str(r.doc_id), r.subroot, r.root) for r in got) == sorted((str(k), want[i][0], want[i][1]) for i, (k, _, _) in enumerate(rows))
    assert all(r.root == got[0].root for r in got)
    frame = spark.createDataFrame([(1, "a", leaf, 5, 6, "x")], "doc_id long, source string, leaf string, n int, rank int, hash string")
    assert merkle.manifest(frame, "source", ["doc_id"], ["n", "rank", "hash"]).select("n", "rank", "hash").first() == (5, 6, "x")
    assert merkle.manifest(frame.limit(0), "source", ["doc_id"], ["doc_id"]).count() == 0


def test_digest_of_columns(spark):
    values = [(None, None, None), (1, "", "é"), (-5, "a:b", "x" * 1000)]
    frame = spark.createDataFrame(values, "a long, b string, c string")
    assert [r.d for r in frame.select(merkle.digest_of([F.col("a"), F.col("b"), F.col("c")]).alias("d")).collect()] == [plain_leaf(v) for v in values]


def test_query(spark):
    from loadkit.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = [(d.doc_id, d.source, plain_leaf([d.doc_id, d.source, d.lang, d.n_chars, d.text])) for d in docs]
    want = {docs[i].doc_id: (i, *v) for i, v in plain(rows).items()}
    found = QUERIES["op13_manifest"](spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        i, subroot, root, steps = want[r.doc_id]
        d = docs[i]
        held = rows[i][2]
        if zlib.crc32(str(d.doc_id).encode()) % 5 == 0:
            held = plain_leaf([d.doc_id, d.source, d.lang, d.n_chars, d.text and d.text.translate(lower)])
        for left, right in steps:
            held = H(*left, held, *right)
        assert tuple(r) == (d.doc_id, rows[i][2], subroot, root, H(*[x for a, b in steps for x in a + b]), held, held == root)
