"""Texts of Arrow batches as NumPy arrays: bytes, words, hashes.

A null text has no bytes. Words never cross documents. All hashes are deterministic functions of content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20  # bytes of text handled at once; a longer text is a chunk of its own

_U = np.uint64
_M1, _M2, _M3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)

# Bytes that separate words.
SPACES = bytes([9, 10, 11, 12, 13, 32])
NOT_ALPHANUMERIC = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_LOWER = bytes(range(256)).replace(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (SplitMix64)."""
    x = x + _M1
    x = (x ^ (x >> _U(30))) * _M2
    x = (x ^ (x >> _U(27))) * _M3
    return x ^ (x >> _U(31))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of ordered pairs."""
    return mix(a * _M2 + mix(b))


def slices(batches: Iterator[pa.RecordBatch], limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts hold about `limit` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes + 16)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated UTF-8 bytes (eight zero bytes follow) and the n + 1 offsets of the texts."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    start, end = int(offsets[0]), int(offsets[-1])
    raw = bytes(column.buffers()[2][start:end]) if end > start else b""
    if lower:
        raw = raw.translate(_LOWER)
    return np.frombuffer(raw + bytes(8), np.uint8), offsets - start


def words(data: np.ndarray, offsets: np.ndarray, separators: bytes = SPACES):
    """Starts and ends of all words, and the n + 1 word offsets of the texts."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    size = int(offsets[-1])
    inner = table[data[:size]]
    edges = np.zeros(size + 1, np.int8)
    edges[:size] = inner
    edges[1:] -= inner
    starts, ends = edges == 1, edges == -1
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < size)]
    cuts = cuts[inner[cuts] & inner[cuts - 1]] if len(cuts) else cuts
    starts[cuts] = True  # one word ends and the next begins where two texts meet
    ends[cuts] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0):
    """64-bit hashes of data[start:end]."""
    eights = np.ndarray((len(data) - 7,), np.dtype("<u8"), data, 0, (1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    sizes = ends - starts
    out = mix(
        (eights[starts] & masks[np.minimum(sizes, 8)])
        ^ (sizes.astype(np.uint64) * _M3 + _U(seed * 2 + 1) * _M1)
    )
    rest, at = np.flatnonzero(sizes > 8), 8
    while len(rest):
        left = sizes[rest] - at
        out[rest] = mix(out[rest] * _M2 + (eights[starts[rest] + at] & masks[np.minimum(left, 8)]))
        rest, at = rest[left > 8], at + 8
    return out


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    known = _POWERS.get(which)
    if known is None or len(known[0]) < size:
        size = max(size, 1 << 16)
        pair = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            pair.append(np.multiply.accumulate(row))
        _POWERS[which] = known = (pair[0], pair[1])
    return known


class Windows:
    """Hashes of any run of a symbol sequence in constant time each, from prefix sums; 64 bits for each `which` of 0 and 1."""

    def __init__(self, symbols: np.ndarray, which: int = 0):
        """symbols: well mixed 64-bit values."""
        n = len(symbols)
        self._up, self._down = _powers(which, n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        values = mix(symbols ^ _M3) if which else symbols
        np.cumsum(values * self._up[:n], out=self._sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])

    def rolling(self, width: int) -> np.ndarray:
        """Hashes of all runs of `width` symbols."""
        count = max(len(self._sums) - width, 0)
        return mix((self._sums[width:] - self._sums[:count]) * self._down[:count])


BYTE_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64))


def as_long(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
