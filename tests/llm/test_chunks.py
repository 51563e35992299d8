import random

import numpy as np
import pytest

from loadkit.llm import chunks

source = random.Random(8)


def words(n):
    return " ".join("".join(source.choice("thinraoé") for _ in range(source.randint(2, 9))) for _ in range(n))


def plain_hash(raw, i):
    return sum(int(chunks.GEAR[raw[i - k]]) << k for k in range(min(chunks.WINDOW, i + 1))) % 2**32


def test_gear_like_its_sum():
    raw = np.frombuffer(words(40).encode(), np.uint8)
    assert [int(h) for h in chunks.gear(raw)] == [plain_hash(raw, i) for i in range(len(raw))]


def pieces(text):
    ends = chunks.cuts(np.frombuffer(text.encode(), np.uint8))
    return list(zip([0, *ends[:-1].tolist()], ends.tolist()))


@pytest.mark.parametrize("text", ["", "a", "short text", "a" * 5000, "ab" * 3000, words(2000), "é" * 900])
def test_cuts_cover_the_text(text):
    found = pieces(text)
    size = len(text.encode())
    assert [a for a, _ in found] == [0] * bool(found) + [b for _, b in found[:-1]] and (found[-1][1] if found else 0) == size
    assert all(a < b for a, b in found)


def test_cuts_by_their_rule():
    """Cuts against a plain reading of the rule, place by place."""
    few = [" ".join(source.choice(["ha", "ho"][: k % 2 + 1]) for _ in range(300)) for k in range(4)]
    for text in [words(400), words(100) + "a" * 700 + words(50), *few, "word " * 300, "é" * 300, words(30) + " go on" * 200]:
        raw = np.frombuffer(text.encode(), np.uint8)
        hashes = {i: plain_hash(raw, i) for i in range(chunks.WINDOW - 1, len(raw))}
        low = [i for i, h in hashes.items() if h < 2**32 // chunks.MEAN]
        cut = {i for i, before in zip(low, [-chunks.LEAST - 1, *low]) if i - before >= chunks.LEAST and i + 1 < len(raw)}
        near = lambda i: range(i - chunks.NEAR, i + chunks.NEAR + 1)
        more = {i for i in hashes if all(j in hashes and j not in cut and j + 1 < len(raw) and hashes[j] >= hashes[i] for j in near(i))}
        assert [b for _, b in pieces(text)] == sorted(i + 1 for i in cut | more) + [len(raw)]


def test_most_passages_keep_their_chunks():
    """Recall of passages of 51 words in foreign text, of many different words and of few."""
    def run(chunked, other):
        best = now = 0
        for chunk in chunked:
            now = now + len(chunk.split()) if chunk in other else 0
            best = max(best, now)
        return best

    caught = {False: 0, True: 0}
    for few in caught:
        for _ in range(200):
            passage = words(51) if not few else " ".join(source.choice(names) for names in [words(3).split()] for _ in range(51))
            texts = [f"{words(30)} {passage} {words(30)}" for _ in range(2)]
            one, two = ([t.encode()[a:b] for a, b in pieces(t)] for t in texts)
            caught[few] += run(one, set(two)) >= chunks.WORDS
    assert caught[False] >= 195 and caught[True] >= 185


def test_long_texts_are_cut_as_a_whole(monkeypatch):
    text = words(3000)
    whole = pieces(text)
    monkeypatch.setattr(chunks, "_PIECE", 777)
    assert pieces(text) == whole


def test_insertions_move_no_cut_behind_them():
    text = words(500)
    raw, other = text.encode(), ("inserted " + text).encode()
    ends = {len(raw) - b for _, b in pieces(text)}
    moved = {len(other) - b for _, b in pieces("inserted " + text)}
    assert len(ends & moved) >= len(ends) - 3


def test_planted_passages_are_found_and_clean_texts_left_alone(docs):
    texts = [words(150) for _ in range(120)]
    planted = {}
    for p in range(20):
        passage = words(52)
        for i in source.sample(range(60), 2):
            at = source.randint(0, len(texts[i]))
            texts[i] = texts[i][:at] + " " + passage + " " + texts[i][at:]
            planted.setdefault(i, []).append(passage)
    rows = chunks.passages(docs(texts)).collect()
    assert {r.doc_id for r in rows} == set(planted)
    for r in rows:
        assert texts[r.doc_id][r.start : r.stop] in texts[r.first_doc_id]
        assert r.removable == (r.first_doc_id != r.doc_id)
    kept = {r.doc_id: r.text for r in chunks.remove(docs(texts), chunks.passages(docs(texts))).collect()}
    assert all(kept[i] == t for i, t in enumerate(texts) if i not in planted)
    cut = {r.doc_id for r in rows if r.removable}
    assert all(len(kept[i]) < len(texts[i]) for i in cut) and all(kept[i] == texts[i] for i in planted if i not in cut)
    assert not [r for r in chunks.passages(docs([kept[i] for i in range(120)])).collect() if r.n_bytes > 300]


def test_like_counting_chunks(spark, docs):
    """Passages against a plain count of every chunk's documents."""
    texts = [words(60) for _ in range(30)]
    texts += [texts[0], texts[1] + " " + texts[2], texts[3][100:], "x" + texts[4], texts[5] + texts[5], "go on " * 200, "so go on " * 300, "x" * 2000, "y" + "x" * 900]
    holders = {}
    for i, t in enumerate(texts):
        raw = t.encode()
        for a, b in pieces(t):
            holders.setdefault(raw[a:b], set()).add(i)
    want = set()
    for i, t in enumerate(texts):
        raw, runs = t.encode(), []
        for a, b in pieces(t):
            if len(holders[raw[a:b]]) > 1:
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
        begins = [k for k in range(len(raw)) if not raw[k : k + 1].isspace() and (k == 0 or raw[k - 1 : k].isspace())]
        want |= {(i, a, b) for a, b in runs if sum(a <= k < b for k in begins) >= chunks.WORDS or b - a >= chunks.BYTES}
    got = {}
    for r in sorted(chunks.passages(docs(texts)).collect(), key=lambda r: (r.doc_id, r.start)):
        runs = got.setdefault(r.doc_id, [])
        if runs and runs[-1][1] == r.start:
            runs[-1][1] = r.stop
        else:
            runs.append([r.start, r.stop])
    point = lambda i, at: sum((c & 0xC0) != 0x80 for c in texts[i].encode()[:at])
    assert {(i, a, b) for i, runs in got.items() for a, b in runs} == {(i, point(i, a), point(i, b)) for i, a, b in want}


def test_odd_rows(spark, docs):
    long = words(80)
    rows = [(None, long, 1, "a"), (5, long, 2, "b"), (5, long, 2, "b"), (6, None, 3, "c"), (7, "", 4, "d"), (8, "w " * 100_000, 5, "e"), (9, words(90), 6, "f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, size int, digest string")
    found = chunks.passages(frame)
    assert {(r.doc_id, r.first_doc_id, r.removable) for r in found.collect()} == {(None, 5, True), (5, 5, False)}
    left = chunks.remove(frame, found).collect()
    assert sorted((r.size, r.text) for r in left if r.size in (2, 3, 4)) == [(2, long), (2, long), (3, None), (4, "")]
    assert [r.text for r in left if r.size == 1] == [""]
    assert chunks.passages(docs([])).count() == 0 and chunks.remove(docs([]), chunks.passages(docs([]))).count() == 0
