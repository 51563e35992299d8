import random
import re

import numpy as np
import xxhash

from loadkit.llm import simhash


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """rows of (id, fingerprint) -> smallest id reachable, by comparing all pairs."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    best = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            best[find(i)] = min(best.get(find(i), key), key)
    return [best.get(find(i)) for i in range(len(rows))]


def test_fingerprint():
    source = random.Random(1)
    texts = ["", " \n", "One", "one two three", "One two Three four", "É a b c d", "a b c d e f"] + [" ".join(source.choice(["the", "É", "x y", "\t", "Ab"]) for _ in range(n)) for n in (5, 50, 900)]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_long_text_in_pieces():
    text = " ".join(f"w{i % 977}" for i in range(70_000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def around(source, center, n, most):
    out = []
    for _ in range(n):
        x = center
        for b in source.sample(range(64), source.randint(0, most)):
            x ^= 1 << b
        out.append(x)
    return out


def linked(spark, values):
    rows = [(i, v - (1 << 64) if v >= 1 << 63 else v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "doc_id long, bits long")
    found = {r.bits: r.component_id for r in simhash.classes(frame).collect()}
    return [found[b] for _, b in rows]


def test_components_like_all_pairs(spark):
    source = random.Random(3)
    values = [source.getrandbits(64) for _ in range(40)]
    values += around(source, values[0], 60, 6) + around(source, values[1], 60, 3) + around(source, 0, 30, 8)
    values += [values[2] ^ 0b1111, values[2] ^ 0b11111110000, values[3] ^ (0b11111 << 59), values[0], values[0]]
    assert linked(spark, values) == plain_components(list(enumerate(values)))


def test_large_keys_are_cut(spark, monkeypatch):
    source = random.Random(4)
    values = around(source, source.getrandbits(64), 150, 9) + [source.getrandbits(64) for _ in range(20)]
    monkeypatch.setattr(simhash, "GROUP", 16)
    assert linked(spark, values) == plain_components(list(enumerate(values)))


def test_forest_keeps_groups_apart():
    bits = np.array([1, 3, 1, 3, 1 << 40], dtype=np.uint64)
    a, b = simhash.forest(bits, np.array([0, 0, 1, 2, 0]))
    assert {frozenset(p) for p in zip(a.tolist(), b.tolist())} == {frozenset((1, 3)), frozenset((1, 1 << 40))}


def test_long_chain(spark):
    values, x = [], 0
    for i in range(16):
        x |= 0b1111 << (4 * i)
        values.append(x)
    source = random.Random(6)
    order = list(range(16))
    source.shuffle(order)
    values = [values[i] for i in order]
    assert set(linked(spark, values)) == {0}


def test_odd_rows(spark, docs):
    rows = [(7, "one two three four five"), (None, "one two three four five"), (3, None), (4, ""), (9, "one two three four five"), (9, "one two three four five"), (None, "quite another text than that one"), (None, "x " * 100_000)]
    frame = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, bits int, component_id string")
    found = simhash.near_duplicates(frame).collect()
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id or -1) for r in found)
    prints = [plain_fingerprint(t) for _, t in rows]
    want = plain_components([(k, p) for (k, _), p in zip(rows, prints)])
    assert got == sorted((k or -1, f"{p:016x}", c or -1) for (k, _), p, c in zip(rows, prints, want))
    assert simhash.near_duplicates(docs([])).count() == 0


def test_query(spark):
    from loadkit.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    given = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = sorted((k, f"{p:016x}", c) for (k, p), c in zip(given, plain_components(given)))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op9_simhash"](spark, folder).collect()) == want
