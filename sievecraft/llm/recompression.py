"""Removal of repeated word windows by recompression.

Rounds replace runs of one symbol and pairs of symbols by new symbols. A pair is replaced if a bit of the left one and a
bit of the right one say so, hence pairs never overlap, and what becomes of a stretch of words depends on little beside
it: equal stretches get equal symbols in their interior. New symbols are named by 64-bit hashes of what they replace, so
all tasks give the same names without a dictionary that would have to be exchanged.

Each symbol carries the range of words that its making depends on. A window is owned by one of the symbols of the highest
round whose range lies inside it; equal windows have equal owners, without exception, as the words themselves are the
symbols of round 0. Shared owners reveal repeats, and the hashes of whole pieces and single windows verify them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievecraft.llm import repeats, texts

WIDTH = 50
ROUNDS = 4
LONG = 4  # words of a symbol that is preferred as an owner
_U = np.uint64


@dataclass
class Level:
    """Symbols in text order: names, first word, words, and the range of words that they depend on."""

    name: np.ndarray
    start: np.ndarray
    size: np.ndarray
    low: np.ndarray
    high: np.ndarray
    fixed: np.ndarray  # not replaced any more: separators and long symbols


def _pick(level: Level, at: np.ndarray, **changes: np.ndarray) -> Level:
    names = ("name", "start", "size", "low", "high", "fixed")
    return Level(*(changes[x] if x in changes else getattr(level, x)[at] for x in names))


def _runs(level: Level) -> Level:
    """Each maximal run of one symbol as a symbol; depends on both neighbours of the run."""
    n = len(level.name)
    new = np.ones(n, bool)
    new[1:] = (level.name[1:] != level.name[:-1]) | level.fixed[1:] | level.fixed[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    long = last > first
    name = level.name[first].copy()
    name[long] = texts.pair_hash(name[long], (last - first + 1)[long].astype(np.uint64))
    return _pick(
        level,
        first,
        name=name,
        size=level.start[last] + level.size[last] - level.start[first],
        low=level.low[np.maximum(first - 1, 0)],
        high=level.high[np.minimum(last + 1, n - 1)],
    )


def _pairs(level: Level, round_: int, longest: int) -> Level:
    """Pairs of a left and a right symbol, side by side, as one; others depend on the neighbour that they could have met."""
    n = len(level.name)
    right = (texts.mix(level.name + _U(round_)) >> _U(63)).astype(bool)
    free = ~level.fixed & (level.size <= longest)
    left, right = free & ~right, free & right
    second = np.zeros(n, bool)
    second[1:] = left[:-1] & right[1:]
    first = np.append(second[1:], False)
    name, low, high, size = level.name.copy(), level.low.copy(), level.high.copy(), level.size.copy()
    a = np.flatnonzero(first)
    name[a] = texts.pair_hash(level.name[a], level.name[a + 1])
    size[a] += level.size[a + 1]
    high[a] = level.high[a + 1]
    x = np.flatnonzero(left & ~first)
    high[x] = level.high[np.minimum(x + 1, n - 1)]
    x = np.flatnonzero(right & ~second)
    low[x] = level.low[np.maximum(x - 1, 0)]
    return _pick(
        level, np.flatnonzero(~second), name=name[~second], size=size[~second], low=low[~second], high=high[~second]
    )


def levels(words: np.ndarray, separator: np.ndarray, longest: int, rounds: int = ROUNDS) -> list[Level]:
    """The sequence after each round; symbols of more than `longest` words stay as they are."""
    at = np.arange(len(words))
    level = Level(words, at, np.ones(len(words), np.int64), at, at + 1, separator)
    out = [level]
    for round_ in range(rounds):
        if round_ == 0:  # later rounds have equal neighbours in periodic texts only, which stay as they are
            level = _runs(level)
        level = _pairs(level, round_, longest)
        out.append(level)
    return out


def owners(found: list[Level], count: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For the window from each word on: an identifier of its owner's place, and the owner's hash."""
    place, name = np.zeros(count, np.int64), np.zeros(count, np.uint64)
    rest = np.arange(count)
    for height in range(len(found) - 1, -1, -1):
        level = found[height]
        low = np.searchsorted(level.low, rest)
        high = np.searchsorted(level.high, rest + width, side="right")
        has = high > low
        at, low, many = rest[has], low[has], (high - low)[has]
        order = texts.mix(level.name ^ _U(height)) >> _U(1)
        order |= (level.size < LONG).astype(np.uint64) << _U(63)  # rare symbols first: few texts share them by chance
        best, which = order[low], low
        for k in range(1, int(many.max(initial=1))):
            other = np.minimum(low + k, len(order) - 1)
            better = (k < many) & (order[other] < best)
            best, which = np.where(better, order[other], best), np.where(better, other, which)
        place[at] = (level.start[which] << 4) + height
        name[at] = best
        rest = rest[~has]
        if not len(rest):
            break
    return place, name


def _sequence(column: pa.Array):
    """Word hashes of all texts, one separator before each text and one at the end; offsets of the first words; counts."""
    data, offsets = texts.text_bytes(column)
    starts, ends, cuts = texts.words(data, offsets)
    hashes = texts.word_hashes(data, starts, ends)
    count = np.diff(cuts)
    owner = np.repeat(np.arange(len(count)), count)
    words = np.zeros(len(hashes) + len(count) + 1, np.uint64)
    words[np.arange(len(hashes)) + owner + 1] = hashes
    separator = np.zeros(len(words), bool)
    first = cuts[:-1] + np.arange(len(count)) + 1
    separator[first - 1] = True
    separator[-1] = True
    return words, separator, first, count


def _pieces(width: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            words, separator, first, count = _sequence(batch.column("text"))
            number = len(words) - width
            if number <= 0:
                continue
            end = first + count
            owner = np.minimum(np.searchsorted(end, np.arange(number), side="right"), len(end) - 1)
            valid = (end[owner] - np.arange(number) >= width) & ~separator[:number]
            if not valid.any():
                continue
            place, name = owners(levels(words, separator, max(width // 6, 1)), number, width)
            start, many = repeats.owned_pieces(place, valid, owner)
            content = texts.Windows(words, 1).hash(start, start + many + width - 1)
            own = owner[start]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("r").take(pa.array(own)),
                    batch.column("d").take(pa.array(own)),
                    repeats.packed(start - first[own], many),
                    texts.as_long(name[start]),
                    texts.as_long(texts.pair_hash(content, many.astype(np.uint64))),
                ],
                names=["r", "d", "at", "k", "p"],
            )

    return pieces


def _strings(width: int):
    """The words of the kinds that are compared whole, as hashes."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            words, _, first, _ = _sequence(batch.column("text"))
            row, fields = repeats.spread(batch.column("kinds").to_pylist(), repeats.FIELDS)
            at = fields["crowd"] <= repeats.CROWD
            row, fields = row[at], {name: x[at] for name, x in fields.items()}
            begin = first[row] + fields["s"]
            end = begin + fields["n"] + width - 1
            yield repeats.string_rows(fields, [words[a:b].tobytes() for a, b in zip(begin, end)])

    return strings


def _windows(width: int):
    """The single windows of the kinds of crowded anchors."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            words, _, first, _ = _sequence(batch.column("text"))
            row, fields = repeats.spread(batch.column("kinds").to_pylist(), repeats.FIELDS)
            at = fields["crowd"] > repeats.CROWD
            row, fields = row[at], {name: x[at] for name, x in fields.items()}
            sums = [texts.Windows(words, which) for which in (0, 1)]
            hashes = [lambda x, s=s: s.hash(x, x + width) for s in sums]
            yield pa.RecordBatch.from_pydict(repeats.window_rows(fields, first[row] + fields["s"], hashes))

    return windows


def _decide(width: int):
    """Runs of windows with the smallest document that has them, in the pieces of some anchors."""

    def decide(rows: list[dict]) -> pa.RecordBatch:
        words = np.frombuffer(b"".join(x["string"] for x in rows), np.uint64)
        sizes = np.array([len(x["string"]) >> 3 for x in rows], np.int64)
        fields = {
            name: np.array([x[name] for x in rows], np.int64) for name in ("k", "p", "c", "low", "n")
        }
        sums = [texts.Windows(words, which) for which in (0, 1)]
        hashes = [lambda x, s=s: s.hash(x, x + width) for s in sums]
        found = repeats.window_rows(fields, np.cumsum(sizes) - sizes, hashes)
        order = np.lexsort((found["w"], found["v"]))
        new = np.ones(len(order), bool)
        for name in ("v", "w"):
            value = found[name][order]
            new[1:] &= value[1:] == value[:-1]
        new = np.append(True, ~new[1:])
        group = np.cumsum(new) - 1
        low = np.empty(len(order), np.int64)
        low[order] = np.minimum.reduceat(found["low"][order], np.flatnonzero(new))[group]
        owner = np.repeat(np.arange(len(rows)), fields["n"])
        useful = (low < found["low"]) | (found["c"] > 1)
        new = np.ones(len(low), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (low[1:] != low[:-1]) | (useful[1:] != useful[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(low))
        start, end = start[useful[start]], end[useful[start]]
        inside = found["i"][start].astype(np.int64)
        return repeats.run_rows(rows, owner[start], inside, inside + end - start, low[start])

    return decide


def _compare(width: int):
    def compare(kinds: DataFrame, docs: DataFrame) -> DataFrame:
        there = repeats.wanted(kinds, docs)
        strings = there.mapInArrow(_strings(width), repeats.STRINGS)
        return repeats.compared(strings, there.mapInArrow(_windows(width), repeats.WINDOWS), _decide(width))

    return compare


_KEPT = "d long, n_words long, n_removed long, kept binary"


def _remove(digest: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            data, offsets = texts.text_bytes(batch.column("text"))
            starts, ends, cuts = texts.words(data, offsets)
            stay = np.ones(len(starts), bool)
            for row, found in enumerate(batch.column("spans").to_pylist()):
                for a, b in zip(*repeats.merged(found)):
                    stay[cuts[row] + a : cuts[row] + b] = False
            sizes = (ends - starts)[stay]
            last = np.cumsum(sizes + 1)
            inside = np.arange(int(last[-1]) if len(last) else 0) - np.repeat(last - sizes - 1, sizes + 1)
            out = data[np.repeat(starts[stay], sizes + 1) + inside]
            out[last - 1] = 32
            left = np.concatenate([[0], np.cumsum(stay)])[cuts]
            edge = np.concatenate([[0], last])[left]
            kept = [out[a : max(b - 1, a)].tobytes() for a, b in zip(edge[:-1], edge[1:])]
            if digest:
                kept = [hashlib.sha256(x).digest() for x in kept]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("d"),
                    pa.array(np.diff(cuts)),
                    pa.array(np.diff(cuts) - np.diff(left)),
                    pa.array(kept, pa.binary()),
                ],
                names=["d", "n_words", "n_removed", "kept"],
            )

    return remove


def without_repeats(docs: DataFrame, width: int = WIDTH, digest: bool = False) -> DataFrame:
    """Rows (d, n_words, n_removed, kept), one for each row of `docs`: the words that no earlier window covers.

    A word (a run without white space) goes if it lies in a window of `width` words of its text that also starts in a
    text of a smaller doc_id; windows are judged on the input. `kept` has the others, joined by one space, as UTF-8;
    digest: its SHA-256. Null texts have no words; a null id is smaller than all others; rows of one id do not count
    against each other. Only doc_id and text are read.
    """
    keyed = repeats.keyed(docs)
    spans = repeats.removed_spans(keyed, _pieces(width), _compare(width), width, first_stays=True)
    rows = keyed.join(spans.hint("shuffle_hash"), "r", "left").select("d", "text", "spans")
    return rows.mapInArrow(_remove(digest), _KEPT)
