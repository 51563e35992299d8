"""Personal data: exact base patterns, and more spans chosen by gradient boosted trees.

Generators with high recall propose overlapping spans: anything like an address with an at sign (also
written out), runs of digits with separators, dotted numbers. Boosted trees score each by its format and context; a
span is taken if its probability reaches a threshold calibrated on candidates the trees have not seen. Base spans always stay.

There are no labelled spans, so the trees learn from the text itself: candidates equal to a base span are positive, their
rewritten forms (at sign and dots written out, other separators, no plus sign) too; other candidates are negative.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import map_batches, texts_of
from loadkit.session import stage

KINDS = ("email", "ip", "card", "phone")
# Candidates in a row of the packed table the trees are grown from.
BLOCK = 8192
# Places between 0 and 1 where a threshold may lie.
GRID = 4096
ROUNDS, DEPTH, RATE, BINS = 60, 3, 0.2, 32
# Precision the calibrated threshold must have on unseen candidates.
PRECISION = 0.99

# The base patterns, as given. Prefixes keep a failing run from being tried again at each of its characters.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# What may stand for an at sign, and the host that must follow it.
_AT_SIGNS = ("@", " at ", " AT ", "(at)", "[at]", "(AT)", "[AT]")
_WIDE_AT = re.compile(r" ?@ ?| ?[\[(](?:at|AT)[\])] ?| (?:at|AT) ")
_WIDE_HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?| (?:dot|DOT) )[A-Za-z0-9-]{1,63}){1,8}")
_WIDE_DIGITS = re.compile(r"\+?\(?[0-9](?:[ ().\-/]{0,3}[0-9]){5,40}+")
_HEX = frozenset("abcdefABCDEF")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns: leftmost, not overlapping within a kind, failing matches dropped."""
    found = [(a, b, "email") for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            found.append((*m.span(), "phone"))
    return sorted(found, key=_order)


def _order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Spans that might be personal data, with the kind each would be; several kinds may claim the same place."""
    found = set()
    for m in _WIDE_AT.finditer(text) if any(s in text for s in _AT_SIGNS) else ():
        host = _WIDE_HOST.match(text, m.end())
        start = m.start()
        while host and start > max(0, m.start() - 64) and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.add((start, host.end(), "email"))
    for m in _WIDE_DIGITS.finditer(text):
        a, b = m.span()
        found |= {(a, b, kind) for kind in ("ip", "card", "phone")}
    return sorted(found, key=_order)


class Taken:
    """Places already covered, kept as disjoint intervals in order."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b, _ in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at == 0 or self.ends[at - 1] <= start

    def add(self, start: int, end: int) -> None:
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


_SEPARATORS = " ().-/"


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format of the span and what stands around it."""
    span = text[start:end]
    digits = [c for c in span if "0" <= c <= "9"]
    groups = [len(g) for g in re.split(r"[^0-9]+", span) if g]
    before, after = text[max(0, start - 24) : start], text[end : end + 24]
    left, right = before[-1:], after[:1]
    word = before.split()[-1].lower().strip(":=\"'(") if before.split() else ""
    dots = re.findall(r"[0-9]+", span)
    return [
        KINDS.index(kind), len(span), len(digits), len(digits) / max(1, len(span)), len(groups), max(groups, default=0), min(groups, default=0), groups[-1] if groups else 0,
        *[span.count(c) for c in _SEPARATORS], span.startswith("+"), "@" in span, bool(re.search(r"[ \[(](?:at|AT)[ \])]", span)), bool(re.search(r"[ \[(](?:dot|DOT)[ \])]", span)),
        bool(digits) and len(digits) <= 40 and luhn("".join(digits)), len(dots) == 4 and all(len(d) <= 3 and int(d) <= 255 for d in dots) and span.count(".") == 3,
        left.isalnum(), right.isalnum(), left in _HEX, right in _HEX, left == "-" or left == ".", right == "-" or (right == "." and after[1:2].isdigit()), left in "\"'=",
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in after), len(set(span)), word in ("tel", "phone", "call", "mobile", "fax"), word in ("card", "visa", "pay", "payment"),
        word in ("ip", "host", "server", "address"), word in ("mail", "email", "e-mail", "contact", "write"),
    ]


def _rewritten(text: str, start: int, end: int, kind: str) -> list[str]:
    """The span as people write it to escape patterns."""
    span = text[start:end]
    if kind == "email":
        name, _, host = span.partition("@")
        spelled = host.replace(".", " dot ")
        return [f"{name} at {spelled}", f"{name} (at) {host}", f"{name}[at]{host.replace('.', '[dot]')}", f"{name} @ {host}"]
    if kind == "phone":
        return [span[1:].replace(" ", "-"), span.replace(" ", "/"), span.replace("(", "").replace(")", "").replace(" ", ".")]
    if kind == "card":
        digits = re.sub(r"[^0-9]", "", span)
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".".join(four), "/".join(four), "  ".join(four)]
    return []


def examples(text: str) -> list[tuple[list[float], int]]:
    """Candidates of a text with what the base spans say of them."""
    base = base_spans(text)
    exact = set(base)
    known = {kind: Taken([s for s in base if s[2] == kind]) for kind in KINDS}
    out = []
    for a, b, kind in candidates(text):
        true = (a, b, kind) in exact
        # A candidate that only overlaps a base span of its kind says nothing.
        if true or known[kind].free(a, b):
            out.append((features(text, a, b, kind), int(true)))
    for a, b, kind in base:
        for form in _rewritten(text, a, b, kind):
            before, after = text[max(0, a - 64) : a], text[b : b + 64]
            whole = before + form + after
            for x, y, k in candidates(whole):
                if k == kind and x < len(before) + len(form) and len(before) < y:
                    out.append((features(whole, x, y, k), 1))
    return out


@dataclass
class Trees:
    """Boosted trees of fixed depth over binned features, with a threshold for each kind."""

    edges: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def binned(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, rows[:, i], "right") for i, e in enumerate(self.edges)], axis=1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        binned, total = self.binned(rows), np.full(len(rows), self.base)
        for tree in self.trees:
            total += RATE * tree[2][_leaf(binned, tree)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _leaf(binned: np.ndarray, tree) -> np.ndarray:
    column, cut, _ = tree
    node = np.zeros(len(binned), np.int64)
    for _ in range(DEPTH):
        right = binned[np.arange(len(binned)), column[node]] > cut[node]
        node = 2 * node + 1 + right
    return node - (2**DEPTH - 1)


def _histogram(binned: np.ndarray, y: np.ndarray, model: Trees, tree, level: int) -> np.ndarray:
    """Sums of gradients and Hessians by node of the level, column and bin. Terms are multiples of 2^-20, so the order of sums does not matter."""
    total = np.full(len(binned), model.base)
    for grown in model.trees:
        total += RATE * grown[2][_leaf(binned, grown)]
    p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
    column, cut = tree
    node = np.zeros(len(binned), np.int64)
    for _ in range(level):
        node = 2 * node + 1 + (binned[np.arange(len(binned)), column[node]] > cut[node])
    node -= 2**level - 1
    columns = binned.shape[1]
    place = ((node[:, None] * columns + np.arange(columns)) * (BINS + 1) + binned).ravel()
    sums = [np.bincount(place, np.repeat(np.round(v * 2.0**20) / 2.0**20, columns), 2**level * columns * (BINS + 1)) for v in (p - y, p * (1 - p))]
    return np.stack(sums, axis=1).reshape(2**level, columns, BINS + 1, 2)


def _grow(histogram: Callable[[tuple[np.ndarray, np.ndarray], int], np.ndarray]):
    """One tree: at each node the cut that lowers the loss most, by histograms of gradients."""
    inner = 2**DEPTH - 1
    column, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
    values = np.zeros(2**DEPTH)
    for level in range(DEPTH):
        sums = histogram((column, cut), level).cumsum(axis=2)
        for i in range(2**level):
            n, (g, h) = 2**level - 1 + i, sums[i, 0, -1]
            gl, hl = sums[i, :, :-1, 0], sums[i, :, :-1, 1]
            gain = gl**2 / (hl + 1.0) + (g - gl) ** 2 / (h - hl + 1.0) - g**2 / (h + 1.0)
            gain[(hl < 0.5) | (h - hl < 0.5)] = 0
            if gain.max() > 1e-6:
                column[n], cut[n] = np.unravel_index(gain.argmax(), gain.shape)
            if level == DEPTH - 1:
                left = sums[i, column[n], cut[n]]
                values[2 * i] = -left[0] / (left[1] + 1.0)
                values[2 * i + 1] = -(g - left[0]) / (h - left[1] + 1.0)
    return column, cut, values


def train(rows: np.ndarray, truth: np.ndarray) -> Trees | None:
    """Trees on every second row, thresholds on the others. None if either class is missing."""
    fit, held = np.arange(len(rows)) % 2 == 0, np.arange(len(rows)) % 2 == 1
    if len(rows) < 4 or not 0 < truth[fit].sum() < fit.sum():
        return None
    x, y = rows[fit], truth[fit].astype(float)
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(x.shape[1])]
    model = Trees(edges, float(np.log(y.mean() / (1 - y.mean()))))
    binned = model.binned(x)
    for _ in range(ROUNDS):
        model.trees.append(_grow(lambda tree, level: _histogram(binned, y, model, tree, level)))
    p = model.probability(rows[held])
    for i, kind in enumerate(KINDS):
        mine = rows[held][:, 0] == i
        model.thresholds[kind] = _threshold(p[mine], truth[held][mine])
    return model


def _threshold(p: np.ndarray, truth: np.ndarray) -> float:
    """Lowest probability from which on the share of true candidates is at least PRECISION; above 1 if there is none."""
    order = np.argsort(-p, kind="stable")
    share = np.cumsum(truth[order]) / np.arange(1, len(p) + 1)
    last = np.ones(len(p), bool)
    last[:-1] = p[order][:-1] > p[order][1:]
    good = np.flatnonzero((share >= PRECISION) & last)
    return max(0.5, float(p[order][good[-1]])) if len(good) else 2.0


def _pack(edges: list[np.ndarray]):
    """Blocks (bins, kinds, truth) of candidates (x, y)."""
    shape = Trees(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(part).tobytes()], pa.binary()) for part in zip(*held)], names=["bins", "kinds", "truth"])

        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                held.append((shape.binned(x).astype(np.uint8), x[:, 0].astype(np.uint8), batch.column(1).to_numpy().astype(np.uint8)))
            if sum(len(h[1]) for h in held) >= BLOCK:
                yield out()
                held = []
        if held:
            yield out()

    return run


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for bins, kinds, truth in zip(*(c.to_pylist() for c in batch.columns)):
        yield np.frombuffer(bins, np.uint8).reshape(len(kinds), -1).astype(np.int64), np.frombuffer(kinds, np.uint8), np.frombuffer(truth, np.uint8)


def _summed(blocks: DataFrame, sums: Callable[..., np.ndarray]) -> np.ndarray:
    """The sum over all blocks, one small array from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in _blocks(batch):
                total = sums(*block) if total is None else total + sums(*block)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([list(total.shape)], pa.list_(pa.int32()))], names=["total", "shape"])

    rows = blocks.mapInArrow(run, "total binary, shape array<int>").collect()
    return sum(np.frombuffer(r["total"], np.float64).reshape(r["shape"]) for r in rows)


def fit(docs: DataFrame, text: str = "text") -> Trees | None:
    """Train on all candidates of all documents, thresholds on half of them. None, so base spans only, without examples of both classes.

    Every level of every tree is one pass over the packed candidates; a task returns sums by node, column and bin.
    """

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat = [e for t in texts_of(batch, "text") for e in examples(t)]
        return pa.RecordBatch.from_arrays([pa.array([[float(v) for v in f] for f, _ in flat], pa.list_(pa.float64())), pa.array([t for _, t in flat], pa.int32())], names=["x", "y"])

    lot = F.pmod(F.xxhash64("x", "y"), F.lit(2))
    known = stage(map_batches(docs.select(F.col(text).alias("text")), measure, "x array<double>, y int").withColumn("lot", lot), "pii-examples")
    learn = known.filter("lot = 0")
    n, true, width = learn.agg(F.count("*"), F.sum("y"), F.max(F.size("x"))).first()
    if not n or not 0 < true < n:
        return None
    cuts = [float(q) for q in np.linspace(0, 1, BINS + 1)[1:-1]]
    quantiles = learn.agg(*[F.percentile(F.col("x")[i], cuts).alias(f"x{i}") for i in range(width)]).first()
    model = Trees([np.unique(q) for q in quantiles], float(np.log(true / (n - true))))
    packed = stage(known.filter("lot = 0").select("x", "y").mapInArrow(_pack(model.edges), "bins binary, kinds binary, truth binary"), "pii-learn")
    for _ in range(ROUNDS):
        model.trees.append(_grow(lambda tree, level: _summed(packed, lambda bins, _, truth: _histogram(bins, truth.astype(float), model, tree, level))))

    def judged(bins: np.ndarray, kinds: np.ndarray, truth: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), model.base)
        for tree in model.trees:
            total += RATE * tree[2][_leaf(bins, tree)]
        place = kinds.astype(np.int64) * (GRID + 1) + np.floor(GRID / (1 + np.exp(-np.clip(total, -30, 30)))).astype(np.int64)
        return np.stack([np.bincount(place, w, len(KINDS) * (GRID + 1)).reshape(len(KINDS), GRID + 1) for w in (truth, np.ones(len(truth)))])

    found = _summed(known.filter("lot = 1").select("x", "y").mapInArrow(_pack(model.edges), "bins binary, kinds binary, truth binary"), judged)
    for i, kind in enumerate(KINDS):
        model.thresholds[kind] = _grid_threshold(found[0, i], found[1, i]) if np.ndim(found) else 2.0
    return model


def _grid_threshold(true: np.ndarray, count: np.ndarray) -> float:
    """Lowest place of the grid from which on the share of true candidates is at least PRECISION; above 1 if there is none."""
    true, count = (np.cumsum(v[::-1])[::-1] for v in (true, count))
    good = np.flatnonzero((count > 0) & (true >= PRECISION * count))
    return max(0.5, float(good[0]) / GRID) if len(good) else 2.0


def all_spans(text: str, model: Trees | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and base spans with those the trees add where none of the base is touched."""
    base = base_spans(text)
    if model is None:
        return base, base
    taken = Taken(base)
    proposed = [c for c in candidates(text) if taken.free(c[0], c[1])]
    if not proposed:
        return base, base
    p = model.probability(np.array([features(text, *c) for c in proposed], float))
    added = []
    for score, c in sorted(zip(p.tolist(), proposed), key=lambda s: (-s[0], _order(s[1]))):
        if score >= model.thresholds[c[2]] and taken.free(c[0], c[1]):
            taken.add(c[0], c[1])
            added.append(c)
    return base, sorted(base + added, key=_order)


def find(docs: DataFrame, model: Trees | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, base, spans) for every row: arrays of (kind, start, end), code points, end exclusive, in order.

    Null and empty texts have no spans. Repeated rows are searched each, null ids stay, no rows give no
    rows, other columns are not read. `spans` holds every base span.
    """
    given = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [all_spans(t, model) for t in texts_of(batch, "text")]
        shaped = [pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in f[i]] for f in found], kind) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([batch.column(0), *shaped], names=["doc_id", "base", "spans"])

    spans = "array<struct<kind:string,start:int,end:int>>"
    return map_batches(given, run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, base {spans}, spans {spans}")


def redact_text(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with a mark like [EMAIL] for each span; overlapping spans share the mark of the first."""
    out, done = [], 0
    for a, b, kind in spans:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: Trees | None, text: str = "text") -> DataFrame:
    """All columns and rows as they are, the text redacted; null texts stay null."""
    place = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t if t is None else redact_text(t, all_spans(t, model)[1]) for t in batch.column(place).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == place else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_batches(docs, run, fields)
