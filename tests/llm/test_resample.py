import hashlib
import math
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadkit.llm import resample
from loadkit.session import stage

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain(docs, target):
    """Rows of (id, n_features, weight, score, rank), straight from the definition."""
    s, t = [0] * 10_000, [0] * 10_000
    held = [(k, *plain_features(x)) for k, x in docs]
    for _, _, buckets in held:
        for b in buckets:
            s[b] += 1
    for x in target:
        for b in plain_features(x)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    rows = []
    for k, words, buckets in held:
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append([k, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= 20])
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1]))
    for place, r in enumerate(order, 1):
        r.append(place if place <= 25 * len(order) // 100 else None)
    return [(*r[:4], r[5] if r[4] else None) for r in rows]


def shown(rows):
    return sorted((tuple(r) for r in rows), key=str)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abzAZ09 ._-éKß\x00\x7f　😀")), max_size=80) | st.text(max_size=60).filter(lambda t: t.isprintable()))
def test_buckets(text):
    text = text.encode("utf-8", "ignore").decode()
    words, buckets = plain_features(text)
    n, got = resample.features(text)
    assert (n, got.tolist()) == (len(words), buckets)


def test_buckets_of_long_words():
    for text in ("x" * 100_000, "a " + "b" * 49 + " c " + "d" * 48 + " " + "e" * 500, "é" * 24 + " " + "é" * 25, "w" * 47 + " y"):
        assert resample.features(text)[1].tolist() == plain_features(text)[1]


def texts(seed, n):
    source = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "x" * 60, "a-b"]
    return [" ".join(source.choices(words, k=source.choice([0, 1, 5, 19, 20, 21, 40]))) for _ in range(n)]


def test_against_brute_force(spark):
    docs = [(i, t) for i, t in enumerate(texts(1, 300))] + [(500, None), (501, ""), (None, "a b " * 15), (502, "word " * 30_000)]
    target = texts(2, 20) + [None, ""]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, rank string").repartition(5)
    found = resample.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    assert shown(found.collect()) == shown(plain(docs, target))


def test_repeated_rows_and_ties(spark):
    docs = [(7, "a b c d e f g h i j " * 2)] * 200 + [(i, t) for i, t in enumerate(texts(3, 100))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = resample.resample(frame, frame.limit(0)).collect()
    assert shown(found) == shown(plain(docs, []))


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(frame, frame).count() == 0
    one = spark.createDataFrame([(1, "word " * 20)], "doc_id long, text string")
    assert resample.resample(one, frame).first().rank is None


def test_exact_ranks_of_hot_keys(spark, monkeypatch):
    """Most rows share their first keys; segments still hold a bounded share, and ranks stay exact."""
    monkeypatch.setattr(resample, "SEGMENT_ROWS", 100)
    rows = stage(spark.range(4000, numPartitions=7).select(F.expr("id % 3 div 2").alias("a"), F.col("id").alias("row")), "rows")
    found = resample.exact_ranks(rows, ["a", "row"], 2500)
    got = sorted((r.rank, r.a, r.row) for r in found.collect() if r["rank"])
    want = sorted((i % 3 // 2, i) for i in range(4000))[:2500]
    assert got == [(n, *w) for n, w in enumerate(want, 1)] and found.count() == 4000


def test_packed_keys_sort_like_numbers():
    source = np.random.default_rng(4)
    a, b = source.integers(-3, 3, 500), source.integers(-(1 << 62), 1 << 62, 500)
    assert resample._packed(a, b).argsort(kind="stable").tolist() == sorted(range(500), key=lambda i: (a[i], b[i]))


def test_query(spark):
    from loadkit.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert shown(QUERIES["op12_resample"](spark, folder).collect()) == shown(plain(docs, target))
