"""Byte-level BPE encoding and decoding with a contiguous rank array.

The parts of a short word stand in one array, the ranks of adjacent pairs in another. The array is
scanned for its minimum again and again; the boundary found is deleted and the ranks beside it are
looked up anew. Words of one length form a matrix, so each scan serves all new words of a batch. Long
words keep their ranks in a heap, which picks the same pairs in the same order.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loadkit.llm.common import texts_of

# Words up to this many bytes use the rank array; its cost grows with the square of the length.
SHORT = 48
# Encoded units a task keeps. When full they are forgotten, which costs time and changes nothing.
CACHE = 400_000
_NONE = np.int32(1 << 30)


class Vocabulary:
    """A byte-level BPE vocabulary in the JSON form of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        split = given["pre_tokenizer"]
        if given["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or given["model"]["type"] != "BPE" or given["model"].get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        ids = given["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.byte_ids = np.array([ids[c] for c in _byte_characters()], dtype=np.int32)
        byte_of = {c: b for b, c in enumerate(_byte_characters())}
        self.pieces: dict[int, bytes] = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.pieces |= {i: content.encode() for content, i in self.special.items()}
        self.wide = max(self.pieces) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in given["model"]["merges"]]
        keys = np.array([ids[a] * self.wide + ids[b] for a, b in pairs], dtype=np.int64)
        made = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        letters, numbers, spaces = _class("L"), _class("N"), _spaces()
        self.pattern = f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
        self.spaces = spaces

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs of ids, and the ids they make."""
        wanted = left.astype(np.int64) * self.wide + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        return np.where(hit, self.ranks[at], _NONE), self.made[at]

    @cached_property
    def pair_of(self) -> dict[int, tuple[int, int]]:
        return {k: (r, m) for k, r, m in zip(self.keys.tolist(), self.ranks.tolist(), self.made.tolist())}


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next one from 256 up."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


def _ranges(points: list[int]) -> str:
    out, start = [], None
    for i, point in enumerate(points):
        start = point if start is None else start
        if i + 1 == len(points) or points[i + 1] != point + 1:
            out.append(f"\\U{start:08x}-\\U{point:08x}")
            start = None
    return "".join(out)


def _class(major: str) -> str:
    """Regex ranges of the characters of a general category."""
    return _ranges([c for c in range(0x110000) if unicodedata.category(chr(c))[0] == major])


def _spaces() -> str:
    """White space as Unicode has it: Python also counts the four separators from 0x1C."""
    return _ranges([c for c in range(0x110000) if chr(c).isspace() and c not in range(0x1C, 0x20)])


def merge_short(words: list[bytes], vocabulary: Vocabulary) -> list[np.ndarray]:
    """Ids of words of one length."""
    parts = vocabulary.byte_ids[np.frombuffer(b"".join(words), np.uint8)].reshape(len(words), -1)
    out: list = [None] * len(words)
    alive = np.arange(len(words))
    ranks, made = vocabulary.look(parts[:, :-1], parts[:, 1:])
    while parts.shape[1] > 1:
        least = ranks.argmin(axis=1)
        row = np.arange(len(alive))
        ended = ranks[row, least] == _NONE
        if ended.any():
            for i in np.flatnonzero(ended):
                out[alive[i]] = parts[i]
            going = ~ended
            alive, parts, ranks, made, least = alive[going], parts[going], ranks[going], made[going], least[going]
            row = np.arange(len(alive))
        if not len(alive):
            return out
        # Delete the boundary: what stands behind it moves up by one.
        parts[row, least] = made[row, least]
        width = parts.shape[1] - 1
        columns = np.arange(width)
        parts = np.take_along_axis(parts, columns + (columns > least[:, None]), axis=1)
        if width == 1:
            break
        columns = columns[:-1]
        moved = columns + (columns >= least[:, None])
        ranks, made = np.take_along_axis(ranks, moved, axis=1), np.take_along_axis(made, moved, axis=1)
        for side in (-1, 0):
            at = least + side
            inside = (at >= 0) & (at < width - 1)
            r, c = row[inside], at[inside]
            ranks[r, c], made[r, c] = vocabulary.look(parts[r, c], parts[r, c + 1])
    for i, w in enumerate(alive):
        out[w] = parts[i]
    return out


def merge_long(word: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """Ids of one long word: pairs wait in a heap by rank and place."""
    ids = vocabulary.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    size, wide, pair_of = len(ids), vocabulary.wide, vocabulary.pair_of
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < size and (found := pair_of.get(ids[i] * wide + ids[j])):
            heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

    for i in range(size):
        offer(i)
    while heap:
        _, i, left, right, made = heapq.heappop(heap)
        j = after[i] if i < size else size
        if ids[i] != left or j >= size or ids[j] != right:
            continue
        ids[i], ids[j] = made, -1
        after[i] = after[j]
        if after[i] < size:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return np.array([x for x in ids if x >= 0], dtype=np.int32)


class Encoder:
    """Encodes texts of one task. Ids are little-endian unsigned 32-bit integers.

    A single space between other characters always begins a word of its own, so text is cut there, and
    each piece with its space is encoded once and kept. Text with other spacing goes through the pattern as a whole.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.find = re.compile(vocabulary.pattern).findall
        self.edge = re.compile(f"[{vocabulary.spaces}]|.*[{vocabulary.spaces}]\\Z", re.S).match
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes | None] = {}

    def _learn(self, words: set[str]) -> None:
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            raw = word.encode()
            by_length.setdefault(len(raw), []).append((word, raw))
        for length, group in by_length.items():
            if length <= SHORT:
                merged = merge_short([raw for _, raw in group], self.vocabulary)
            else:
                merged = [merge_long(raw, self.vocabulary) for _, raw in group]
            for (word, _), ids in zip(group, merged):
                self.words[word] = ids.astype("<u4").tobytes()

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Texts through the pattern."""
        found = [self.find(t) for t in texts]
        new = {w for words in found for w in words if w not in self.words}
        if new:
            self._learn(new)
        return [b"".join([self.words[w] for w in words]) for words in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.units) > CACHE:
            self.units.clear()
        if len(self.words) > CACHE:
            self.words.clear()
        if self.special is None:
            return self._segments(texts)
        cut = [self.special.split(t) if any(s in t for s in self.vocabulary.special) else [t] for t in texts]
        encoded = iter(self._segments([s for parts in cut for s in parts[::2]]))
        marks = {s: int(i).to_bytes(4, "little") for s, i in self.vocabulary.special.items()}
        return [b"".join([next(encoded) if i % 2 == 0 else marks[s] for i, s in enumerate(parts)]) for parts in cut]

    def _segments(self, texts: list[str]) -> list[bytes]:
        split = [t.split(" ") for t in texts]
        new = {u for units in split for u in units[1:] if u not in self.units}
        good = [u for u in new if u and not self.edge(u)]
        self.units.update(dict.fromkeys(new))
        self.units.update(zip(good, self._plain([" " + u for u in good])))
        heads = self._plain([units[0] for units in split])
        out = []
        for text, units, head in zip(texts, split, heads):
            found = [self.units[u] for u in units[1:]]
            if None in found or len(units) > 1 and (not units[0] or self.edge(units[0])):
                out.append(self._plain([text])[0])
            else:
                out.append(head + b"".join(found))
        return out


def _vocabulary(held: dict) -> Vocabulary:
    """The vocabulary of its fields. Plain fields are broadcast: an object would be looked up by its module's name on workers, which need no copy of it."""
    out = Vocabulary.__new__(Vocabulary)
    vars(out).update(held)
    return out


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers in a binary column, without added special tokens.

    Null and empty texts give no ids. Special tokens written in a text become their id, as in the library.
    Repeated rows are encoded each; null ids stay null; other columns are not read. The vocabulary has a fixed size and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(vocabulary))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            if batch.num_rows:
                encoder = encoder or Encoder(_vocabulary(shared.value))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(encoder.encode(texts_of(batch, text)), pa.binary())], names=["doc_id", "ids"])

    return docs.select(key, text).mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """Adds column `decoded`: the text of the ids. Special tokens are written out, unknown ids left out, and
    bytes that are not UTF-8 replaced, as in the library. Null ids give an empty text. An existing `decoded` is replaced."""
    shared = encoded.sparkSession.sparkContext.broadcast(vars(vocabulary))
    given = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        for batch in batches:
            if batch.num_rows:
                if pieces is None:
                    pieces = [shared.value["pieces"].get(i, b"") for i in range(shared.value["wide"])]
                texts = [_text(raw or b"", pieces) for raw in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields)
    return given.mapInArrow(run, f"{fields}, decoded string")


def _text(raw: bytes, pieces: list[bytes]) -> str:
    ids = np.frombuffer(raw, "<u4")
    if len(ids) and ids.max() >= len(pieces):
        ids = ids[ids < len(pieces)]
    return b"".join([pieces[i] for i in ids.tolist()]).decode("utf-8", "replace")
