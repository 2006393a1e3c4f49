"""Removal of repeated byte strings with suffix arrays of shards.

Anchors send every 200-byte string to a shard by its content, so that equal strings meet in one. A shard's suffix array
is made by induced sorting; its permuted common prefixes tell which strings start anywhere else. Pieces whose anchor
occurs once, or only in equal pieces, are decided before, and need no array.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievecraft.llm import repeats, texts
from sievecraft.llm.suffix_arrays import repeated_starts

WIDTH = 200
SEED = 40  # bytes of an anchor
SEGMENT = 1 << 20  # bytes of a text handled at once

_PLACE = np.uint64((1 << 24) - 1)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` consecutive values."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _pieces(width: int):
    seed = min(SEED, width)

    def segment(data: np.ndarray, room: np.ndarray):
        """Starts, lengths, anchor and content hashes of the pieces of some bytes; room: bytes from each to its text's end."""
        symbols = texts.BYTE_SYMBOLS[data]
        seeds = texts.Windows(symbols).rolling(seed)
        marked = (seeds & ~_PLACE) | np.arange(len(seeds), dtype=np.uint64)
        place = (sliding_least(marked, width - seed + 1) & _PLACE).astype(np.int64)
        room = room[: len(place)]
        start, count = repeats.owned_pieces(place, room >= width, room + np.arange(len(room)))
        content = texts.Windows(symbols, 1).hash(start, start + count + width - 1)
        return start, count, seeds[place[start]], texts.pair_hash(content, count.astype(np.uint64))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            data, offsets = texts.text_bytes(batch.column("text"))
            size = int(offsets[-1])
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            for base in range(0, size - width + 1, SEGMENT):
                to = min(base + SEGMENT + width - 1, size)
                own = owner[base:to]
                start, count, anchor, content = segment(
                    data[base:to], offsets[1:][own] - np.arange(base, to)
                )
                own = own[start]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("r").take(pa.array(own)),
                        batch.column("d").take(pa.array(own)),
                        repeats.packed(start + base - offsets[own], count),
                        texts.as_long(anchor),
                        texts.as_long(content),
                    ],
                    names=["r", "d", "at", "k", "p"],
                )

    return pieces


def _strings(width: int):
    """The strings of the kinds that go into shards."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            data, offsets = texts.text_bytes(batch.column("text"))
            row, fields = repeats.spread(batch.column("kinds").to_pylist(), repeats.FIELDS)
            at = fields["crowd"] <= repeats.CROWD
            row, fields = row[at], {name: x[at] for name, x in fields.items()}
            first = offsets[row] + fields["s"]
            last = first + fields["n"] + width - 1
            yield repeats.string_rows(fields, [data[a:b].tobytes() for a, b in zip(first, last)])

    return strings


def _windows(width: int):
    """The single windows of the kinds of crowded anchors."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            data, offsets = texts.text_bytes(batch.column("text"))
            row, fields = repeats.spread(batch.column("kinds").to_pylist(), repeats.FIELDS)
            at = fields["crowd"] > repeats.CROWD
            row, fields = row[at], {name: x[at] for name, x in fields.items()}
            if not len(row):
                continue
            symbols = texts.BYTE_SYMBOLS[data]
            sums = [texts.Windows(symbols, which) for which in (0, 1)]
            hashes = [lambda x, s=s: s.hash(x, x + width) for s in sums]
            rows = repeats.window_rows(fields, offsets[row] + fields["s"], hashes)
            yield pa.RecordBatch.from_pydict(rows)

    return windows


def _decide(width: int):
    """Runs of repeated windows in one shard."""

    def decide(rows: list[dict]) -> pa.RecordBatch:
        sizes = np.array([len(x["string"]) for x in rows], np.int64)
        data = np.frombuffer(b"".join(x["string"] for x in rows) + bytes(8), np.uint8)
        owner = np.repeat(np.arange(len(rows)), sizes)
        several = np.array([x["c"] > 1 for x in rows])
        inside = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
        flags = repeated_starts(data, sizes, width) | several[owner]
        flags &= inside < np.array([x["n"] for x in rows])[owner]
        start, end = repeats.runs_of(flags, owner)
        return repeats.run_rows(rows, owner[start], inside[start], inside[start] + end - start, np.zeros(len(start), np.int64))

    return decide


def _compare(width: int):
    def compare(kinds: DataFrame, docs: DataFrame) -> DataFrame:
        there = repeats.wanted(kinds, docs)
        strings = there.mapInArrow(_strings(width), repeats.STRINGS)
        return repeats.compared(strings, there.mapInArrow(_windows(width), repeats.WINDOWS), _decide(width))

    return compare


_KEPT = "d long, n_bytes long, n_removed long, n_spans long, kept binary"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts.slices(batches):
        data, offsets = texts.text_bytes(batch.column("text"))
        removed, spans, kept = [], [], []
        for row, found in enumerate(batch.column("spans").to_pylist()):
            start, end = repeats.merged(found)
            raw = data[offsets[row] : offsets[row + 1]].tobytes()
            inner = np.concatenate([[0], end]), np.concatenate([start, [len(raw)]])
            kept.append(b"".join(raw[a:b] for a, b in zip(*inner)) if len(start) else raw)
            removed.append(len(raw) - len(kept[-1]))
            spans.append(len(start))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("d"),
                pa.array(np.diff(offsets)),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            names=["d", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _remove(batches):
        kept = pa.array([hashlib.sha256(x.as_buffer()).digest() for x in batch.column("kept")], pa.binary())
        yield batch.set_column(4, "kept", kept)


def without_repeats(docs: DataFrame, width: int = WIDTH, digest: bool = False) -> DataFrame:
    """Rows (d, n_bytes, n_removed, n_spans, kept), one for each row of `docs`: the bytes that no repeated string covers.

    A byte goes if it lies in a `width`-byte string that also starts anywhere else, in the same text or another; overlaps
    count, and strings are judged on the input. Null texts are empty. Repeated rows are each other's repeats. `kept` may
    not be valid UTF-8, as strings are bytes; digest: its SHA-256 in its place. Only doc_id and text are read.
    """
    keyed = repeats.keyed(docs)
    spans = repeats.removed_spans(keyed, _pieces(width), _compare(width), width, first_stays=False)
    rows = keyed.join(spans.hint("shuffle_hash"), "r", "left").select("d", "text", "spans")
    return rows.mapInArrow(_digest if digest else _remove, _KEPT)
