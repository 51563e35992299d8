r"""The states of JSON text over whole Arrow batches, for `loadkit.operators.reassemble`.

One batch of lines is one array of bytes, and only its quotes, backslashes and brackets matter. With arrays of where those stand:

- A backslash in a string escapes what follows, so a run of backslashes escapes the next byte if its length is odd.
- A plain quote turns the state over, an escaped one leaves it in a string whatever it was before. The state after a quote
  is therefore the parity of plain quotes since the last escaped one, or since the start of the split.
- Brackets outside strings sum up to a depth that never falls below zero: the running sum, less the lowest it has been if
  that is below zero.

A batch may hold lines of many splits. Quotes are counted from where their split starts, and the sums of each split are moved
below all sums of the splits before it, so one running minimum serves them all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OUTSIDE, INSIDE, ESCAPED = 0, 1, 2

_QUOTE, _BACK, _OPEN, _CLOSE, _RETURN = 1, 2, 3, 4, 5
_KIND = np.zeros(256, np.uint8)
for _chars, _kind in [(b'"', _QUOTE), (b"\\", _BACK), (b"{[", _OPEN), (b"}]", _CLOSE), (b"\r", _RETURN)]:
    _KIND[list(_chars)] = _kind


def _buffers(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the lines, and where each line ends in them after a leading 0."""
    width = np.int64 if pa.types.is_large_string(lines.type) else np.int32
    _, offsets, data = lines.buffers()
    bounds = np.frombuffer(offsets, width)[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return text[bounds[0] : bounds[-1]], bounds - bounds[0]


def _from_zero(values: np.ndarray) -> np.ndarray:
    """Running sums of `values` after a leading 0."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums


class Marks:
    """Where the bytes that matter stand in the lines of one batch; `first` is the first line of each split."""

    def __init__(self, lines: pa.Array, first: np.ndarray):
        self.text, self.given = _buffers(lines)
        kinds = _KIND[self.text]
        at = np.flatnonzero(kinds)
        kinds = kinds[at]
        # Carriage returns change no state: places are counted without them.
        gone = kinds == _RETURN
        self.returns = at[gone]
        self.bounds = self.given
        if len(self.returns):
            at = (at - (np.cumsum(gone) - gone))[~gone]
            kinds = kinds[~gone]
            self.bounds = self.given - np.searchsorted(self.returns, self.given)
        self.first = first
        self.line_split = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(lines))))
        self.last = np.append(first[1:], len(lines)) - 1
        self.starts, self.ends = self.bounds[first], self.bounds[self.last + 1]
        quotes = kinds == _QUOTE
        self.quotes = at[quotes]
        self.quotes_before = np.searchsorted(self.quotes, self.starts)
        brackets = (kinds == _OPEN) | (kinds == _CLOSE)
        self.brackets, self.bracket_quotes = at[brackets], (np.cumsum(quotes))[brackets]
        self.moves = np.where(kinds[brackets] == _OPEN, 1, -1)
        self.bracket_split = np.searchsorted(self.starts, self.brackets, "right") - 1
        self.backs = at[kinds == _BACK]
        self.runs = np.flatnonzero(np.diff(self.backs, prepend=-2) != 1)
        if len(self.backs):
            # A run does not go on into the next split.
            cuts = np.searchsorted(self.backs, self.starts)
            cuts = cuts[cuts < len(self.backs)]
            self.runs = np.union1d(self.runs, cuts[np.isin(self.backs[cuts], self.starts)])

    def after_odd_runs(self, led: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places just after an odd run of backslashes, and the places whose byte such a run escapes; `led` splits start after one backslash."""
        lead = self.starts[led & (self.starts < self.ends)]
        length = np.diff(np.append(self.runs, len(self.backs)))
        begins = self.backs[self.runs]
        odd = (length + np.isin(begins, lead)) % 2 == 1
        after = begins[odd] + length[odd]
        within = after[~np.isin(after, self.starts)]
        return after, np.concatenate([within, lead[~np.isin(lead, begins)]])


@dataclass
class Walked:
    """State and depth at the end of each line, and of each split."""

    inside: np.ndarray
    depth: np.ndarray
    net: np.ndarray
    state: np.ndarray
    returns_inside: np.ndarray


def walk_lines(marks: Marks, state: np.ndarray, depth: np.ndarray) -> Walked:
    """All lines, each split from its own `state` and `depth`; `net` is the sum of brackets since the split began."""
    after, escaped_at = marks.after_odd_runs(state == ESCAPED)
    start = (state != OUTSIDE).astype(np.int64)
    escaped = np.isin(marks.quotes, escaped_at)
    plain = _from_zero(~escaped)
    split = np.searchsorted(marks.starts, marks.quotes, "right") - 1
    nth = np.arange(len(marks.quotes))
    last = np.maximum.accumulate(np.where(escaped, nth, -1)) if len(nth) else nth
    since = np.where(last >= marks.quotes_before[split], 1 + plain[1:] - plain[last + 1], start[split] + plain[1:] - plain[marks.quotes_before[split]])
    # States after 0, 1, 2... quotes; what a split starts with stands in for those of the splits before.
    states = np.append(0, since & 1)

    def inside_after(quotes: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.where(quotes > marks.quotes_before[of], states[quotes], start[of]) == 1

    outside = ~inside_after(marks.bracket_quotes, marks.bracket_split)
    places, moves, of = marks.brackets[outside], marks.moves[outside], marks.bracket_split[outside]
    sums = _from_zero(moves)
    before = np.searchsorted(places, marks.starts)
    fall = 2 * len(moves) + int(depth.max(initial=0)) + 2
    reached = depth[of] + sums[1:] - sums[before[of]]
    lowest = np.append(0, np.minimum.accumulate(reached - of * fall)) if len(of) else np.zeros(1, np.int64)

    ends, lines = marks.bounds[1:], marks.line_split
    seen = np.searchsorted(places, ends)
    net = sums[seen] - sums[before[lines]]
    floor = np.where(seen > before[lines], np.minimum(lowest[seen] + lines * fall, 0), 0)
    inside = inside_after(np.searchsorted(marks.quotes, ends), lines)
    end_inside = inside[marks.last]
    begun = marks.starts < marks.ends
    last_state = np.where(end_inside, np.where(begun & np.isin(marks.ends, after), ESCAPED, INSIDE), OUTSIDE)
    line = np.searchsorted(marks.given, marks.returns, "right") - 1
    places = marks.returns - np.arange(len(marks.returns))
    returns_inside = inside_after(np.searchsorted(marks.quotes, places), marks.line_split[line])
    return Walked(inside, depth[lines] + net - floor, net, np.where(begun, last_state, state), returns_inside)


def firsts(columns: list[pa.Array]) -> np.ndarray:
    """First row of each run of equal rows."""
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for column in columns:
        new[1:] |= pc.fill_null(pc.not_equal(column[1:], column[:-1]), True).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def effects(lines: pa.Array, first: np.ndarray) -> list[tuple[tuple[int, int, int, int], ...]]:
    """Effect of the lines of each split for each state it might start in, as `reassemble.line_effect` has it for one line."""
    marks = Marks(lines, first)
    zero = np.zeros(len(first), np.int64)
    found = []
    for state in (OUTSIDE, INSIDE, ESCAPED):
        walked = walk_lines(marks, zero + state, zero)
        # From depth 0 the depth ends at `floor`; a line that ends there at 0 does so from any depth up to what it takes off.
        closes = np.where(~walked.inside & (walked.depth == 0), -walked.net, -1)
        found.append(list(zip(
            walked.state.tolist(), walked.net[marks.last].tolist(), walked.depth[marks.last].tolist(), np.maximum.reduceat(closes, first).tolist()
        )))
    return list(zip(*found))


def opened(lines: pa.Array, rows: np.ndarray, opener: str) -> pa.Array:
    """The lines, those at `rows` without the opening bracket."""
    if not opener or not len(rows):
        return lines
    texts = lines.to_pylist()
    for row in rows.tolist():
        text = texts[row].lstrip()
        if not text.startswith(opener):
            raise ValueError(f"expected a JSON list, found {texts[row][:40]!r}")
        texts[row] = text[len(opener) :]
    return pa.array(texts, lines.type)


def _clean(lines: pa.Array, marks: Marks, walked: Walked) -> tuple[pa.Array, np.ndarray]:
    """Carriage returns to their escape inside strings, to a space outside; how many of a line's were inside."""
    if not len(marks.returns):
        return lines, np.zeros(len(lines), np.int64)
    inside = marks.returns[walked.returns_inside]
    text = marks.text.copy()
    text[marks.returns] = ord(" ")
    text[inside] = ord("\\")
    text = np.insert(text, inside + 1, ord("r"))
    shift = np.searchsorted(inside, marks.given)
    bounds = pa.py_buffer((marks.given + shift).astype(np.int64))
    whole = pa.LargeStringArray.from_buffers(len(lines), bounds, pa.py_buffer(text))
    return whole.cast(lines.type), np.diff(shift)


@dataclass
class Held:
    """What a split has left open at the end of a batch."""

    key: tuple
    state: int
    depth: int
    index: int
    text: list[str]
    first: int
    carried: bool
    newlines: int
    returns: int


def cut(inside: str, nested: str, keep_returns: bool, opener: str, names: list[str]):
    """Cuts the lines of splits into records and parts of records; rows have the columns of `names`.

    Lines come with the state, depth and open record their split starts with. Equal to cutting line by line.
    """

    def row(held: Held, text: str, partial: bool) -> tuple:
        file, block, _, _, begun, _ = held.key
        return file, begun if held.carried else block, block, -1 if held.carried else held.first, text, held.newlines, held.returns, partial

    def closing(held: Held) -> tuple:
        """What is still open at the end of a split; the last line break of the file belongs to it."""
        text = "".join(held.text)
        if held.key[5]:
            text += nested if held.state == OUTSIDE else inside
            held.newlines += held.state != OUTSIDE
        return row(held, text, True)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.string() if n in ("file", "text") else pa.bool_() if n == "partial" else pa.int64()) for n, c in zip(names, zip(*rows))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Held | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c) for c in ("file", "block", "state", "depth", "opened", "ended")]
            first = firsts(columns[:2])
            starts = [c.take(pa.array(first)) for c in columns]
            keys = list(zip(*(s.to_pylist() for s in starts)))
            goes_on = held is not None and held.key == keys[0]
            if held is not None and not goes_on:
                if held.text:
                    yield batch_of([closing(held)])
                held = None
            state, depth, begun = (s.to_numpy().astype(np.int64) for s in starts[2:5])
            fresh = np.arange(len(first)) >= goes_on
            carried = fresh & ((state != OUTSIDE) | (depth != 0))
            base = np.zeros(len(first), np.int64)
            if goes_on:
                state[0], depth[0], base[0], carried[0] = held.state, held.depth, held.index, held.carried
            block = starts[1].to_numpy().astype(np.int64)
            lines = opened(batch.column("line"), first[fresh & (block == 0)], opener)
            marks = Marks(lines, first)
            walked = walk_lines(marks, state, depth)
            texts, returns = (lines, np.zeros(len(lines), np.int64)) if keep_returns else _clean(lines, marks, walked)

            done = ~walked.inside & (walked.depth == 0)
            stops = done.copy()
            stops[marks.last] = True
            stop = np.flatnonzero(stops)
            start = np.append(0, stop[:-1] + 1)
            # What comes before each line: nothing, or the form of the line break between it and the one before.
            in_string = np.append(False, walked.inside[:-1])
            is_open = np.append(False, ~done[:-1])
            in_string[first], is_open[first] = state != OUTSIDE, (state != OUTSIDE) | (depth != 0)
            form = np.where(is_open, np.where(in_string, 1, 2), 0)
            n = len(lines)
            parts = np.empty(2 * n, np.int64)
            parts[0::2], parts[1::2] = n + form, np.arange(n)
            pool = pa.concat_arrays([texts, pa.array(["", inside, nested], texts.type)])
            bounds = pa.array(np.append(2 * start, 2 * n), pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(bounds, pool.take(pa.array(parts))), "")

            of = marks.line_split[start]
            newlines = np.add.reduceat((in_string & is_open).astype(np.int64), start)
            returned = np.add.reduceat(returns, start)
            heads = start == first[of]
            is_carried = heads & carried[of]
            index = start - first[of] + base[of]
            partial = is_carried | ~done[stop]
            open_end = ~done[stop]
            keep = len(stop) - int(open_end[-1])
            # The end of the last split here is not known before the next batch.
            ended = starts[5].to_numpy(zero_copy_only=False)[of] & open_end & (np.arange(len(stop)) < keep)
            end_form = np.where(ended, np.where(walked.inside[stop], 1, 2), 0)
            if ended.any():
                joined = pc.binary_join_element_wise(joined, pool.take(pa.array(n + end_form)), "")
                newlines += end_form == 1
            earlier: list[str] = []
            if goes_on and held.text:
                earlier = held.text
                newlines[0] += held.newlines
                returned[0] += held.returns
                index[0] = held.first
                if keep:
                    joined = pa.concat_arrays([pa.array(["".join(earlier) + joined[0].as_py()], joined.type), joined[1:]])
                    earlier = []
            if keep:
                yield pa.RecordBatch.from_arrays([
                    starts[0].take(pa.array(of[:keep])).cast(pa.string()), pa.array(np.where(is_carried, begun[of], block[of])[:keep]), pa.array(block[of][:keep]),
                    pa.array(np.where(is_carried, -1, index)[:keep]), joined[:keep].cast(pa.string()), pa.array(newlines[:keep]), pa.array(returned[:keep]), pa.array(partial[:keep]),
                ], names=names)
            now = Held(keys[-1], int(walked.state[-1]), int(walked.depth[-1]), int(base[-1]) + n - int(first[-1]), [], 0, False, 0, 0)
            if open_end[-1]:
                # Parts of an open record are joined once, when it ends.
                now.text = [*earlier, joined[-1].as_py()]
                now.first, now.carried, now.newlines, now.returns = int(index[-1]), bool(is_carried[-1]), int(newlines[-1]), int(returned[-1])
            held = now
        if held is not None and held.text:
            yield batch_of([closing(held)])

    return run
