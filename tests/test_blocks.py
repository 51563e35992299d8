"""Whole batches at once against the same lines one by one."""

import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from loadkit.operators import blocks
from loadkit.operators import reassemble as plain

LINE = st.text(alphabet='ab"\\{}[]\r é', max_size=8)
SPLITS = st.lists(st.tuples(st.lists(LINE, min_size=1, max_size=6), st.sampled_from([0, 1, 2]), st.integers(0, 3), st.booleans()), min_size=1, max_size=5)
NAMES = [field.split()[0] for field in plain._PIECES.split(", ")]


def batches(rows, names, rng):
    """The rows in batches of any size, some of them empty."""
    at, found = 0, []
    while at < len(rows):
        n = rng.choice([0, 1, 2, 3, 50])
        if n:
            found.append(pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[at : at + n])], names=names))
        at += n
    return found + [found[0].slice(0, 0)]


@settings(max_examples=400, deadline=None)
@given(SPLITS, st.integers(0, 9))
def test_effects(splits, seed):
    rows = [("f", 7 * i, line) for i, (lines, *_) in enumerate(splits) for line in lines]
    cut = batches(rows, ["file", "block", "line"], random.Random(seed))
    told = lambda run: [tuple(r.values()) for b in run(iter(cut)) for r in b.to_pylist()]
    assert told(plain._summarise_json("")) == told(plain._summarise(""))


@settings(max_examples=600, deadline=None)
@given(SPLITS, st.integers(0, 9), st.booleans())
def test_records(splits, seed, keep_returns):
    rows = []
    for i, (lines, state, depth, ended) in enumerate(splits):
        begun = 0 if (state, depth) != (0, 0) else -1
        rows += [("f", 7 * i + 7, state, depth, begun, ended, line) for line in lines]
    cut = batches(rows, ["file", "block", "state", "depth", "opened", "ended", "line"], random.Random(seed))
    told = lambda run: [tuple(r.values()) for b in run(iter(cut)) for r in b.to_pylist()]
    got = told(blocks.cut("\\n", " ", keep_returns, "", NAMES))
    assert got == told(plain._cut("\\n", " ", keep_returns, ""))


def test_opening_bracket_goes_once():
    rows = [(f, b, 0, 0, -1, False, line) for f, b, line in [("a", 0, " [1"), ("a", 0, "[2]"), ("a", 9, "[3"), ("b", 0, "[")]]
    cut = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "block", "state", "depth", "opened", "ended", "line"])]
    whole = [tuple(r.values()) for b in blocks.cut(",", ",", True, "[", NAMES)(iter(cut)) for r in b.to_pylist()]
    single = [tuple(r.values()) for c in [[b.slice(i, 1) for b in cut for i in range(4)]] for b in blocks.cut(",", ",", True, "[", NAMES)(iter(c)) for r in b.to_pylist()]
    assert whole == single == [tuple(r.values()) for b in plain._cut(",", ",", True, "[")(iter(cut)) for r in b.to_pylist()]
