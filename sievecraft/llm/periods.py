"""Runs: stretches of words that repeat with a period, found with a dictionary of basic factors.

For each power of two, equal factors (stretches of that many words) of a document get one name; the name of a factor of
2m words follows from the names of its halves. Where the next occurrence of a factor is at most as far as its own length,
the distance is a period of the words between; starts that follow each other with one distance are arithmetic
progressions that overlap, and propose one run. Proposals are extended while words agree, and one run proposed at
several lengths is kept once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sievecraft.llm import texts
from sievecraft.llm.common import id_key

LEAST = 6  # words of a run
POWER = 4  # a run is at least this many periods long

_RUNS = (
    "d long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs string, kept binary"
)


def _names(keys: np.ndarray) -> np.ndarray:
    """Equal keys get one number."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _successors(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start, in order: the distance to the next start of the same name (0: none), and whether its name is repeated."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    distance = np.zeros(len(starts), np.int64)
    distance[order[:-1][same]] = (starts[order[1:]] - starts[order[:-1]])[same]
    again = np.zeros(len(starts), bool)
    again[order[:-1][same]] = True
    again[order[1:][same]] = True
    return distance, again


def _extended(symbols: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches made as long as their period holds; symbols of different documents differ."""
    start, end = start.copy(), end.copy()
    size = len(symbols)
    left = np.arange(len(start))
    while len(left):
        left = left[start[left] > 0]
        left = left[symbols[start[left] - 1] == symbols[start[left] - 1 + period[left]]]
        start[left] -= 1
    right = np.arange(len(end))
    while len(right):
        right = right[end[right] < size]
        right = right[symbols[end[right]] == symbols[end[right] - period[right]]]
        end[right] += 1
    return start, end


def runs(symbols: np.ndarray, least: int = LEAST, power: int = POWER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every maximal run, by start and period.

    symbols: numbers of the words of documents that follow each other; documents share none. power is at least 3: only
    then does a run of period q hold a factor of q to 2q - 1 words together with its next occurrence.
    """
    names = _names(symbols)
    starts = np.arange(len(symbols))
    length = 1
    found = []
    while len(starts):
        distance, again = _successors(names, starts)
        near = (distance > 0) & (distance <= length)
        at, period = starts[near], distance[near]
        if len(at):
            first = np.ones(len(at), bool)
            first[1:] = (np.diff(at) != 1) | (np.diff(period) != 0)
            last = np.append(first[1:], True)
            found.append((at[first], at[last] + length + period[first], period[first]))
        # A factor of twice the length can only occur again if both of its halves do.
        there = np.full(len(symbols) + length, -1, np.int64)
        there[starts[again]] = names[again]
        starts = starts[again]
        second = there[np.minimum(starts + length, len(there) - 1)]
        starts, first_names, second = starts[second >= 0], there[starts][second >= 0], second[second >= 0]
        names = _names(first_names * (len(symbols) + 1) + second) if len(starts) else starts
        length *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, period = (np.concatenate(x) for x in zip(*found))
    start, end = _extended(symbols, start, end, period)
    long = end - start >= np.maximum(least, power * period)
    rows = np.unique(np.stack([start[long], period[long], end[long]]), axis=1)
    return rows[0], rows[2] - rows[0], rows[1]


def _document_symbols(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Numbers of words; the same only for equal words of one document."""
    first, second = (texts.word_hashes(data, starts, ends, seed) for seed in (0, 1))
    document = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)).astype(np.uint64)
    words = _names(texts.pair_hash(first, second)).astype(np.uint64)
    return _names(document << np.uint64(32) | words)


def _found(least: int, power: int, digest: bool):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            data, offsets = texts.text_bytes(batch.column("text"))
            begin, stop, cuts = texts.words(data, offsets)
            symbols = _document_symbols(data, begin, stop, cuts)
            start, length, period = runs(symbols, least, power)
            cover = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(cover, start + period, 1)
            np.add.at(cover, start + length, -1)
            kept = np.cumsum(cover[:-1]) == 0
            owner = np.searchsorted(start, cuts)
            raw = data.tobytes()
            rows = []
            for k in range(batch.num_rows):
                a, b = cuts[k], cuts[k + 1]
                own = slice(owner[k], owner[k + 1])
                s, n, q = (start[own] - a).tolist(), length[own].tolist(), period[own].tolist()
                best = min(range(len(s)), key=lambda i: (-n[i], s[i], q[i])) if s else None
                top = (None,) * 4 if best is None else (s[best], n[best], q[best], 1000 * n[best] // q[best])
                listed = "".join(f"{x},{y},{z}\n" for x, y, z in zip(s, n, q))
                picked = a + np.flatnonzero(kept[a:b])
                left = b" ".join([raw[x:y] for x, y in zip(begin[picked].tolist(), stop[picked].tolist())])
                rows.append((int(b - a), len(s), *top, listed, hashlib.sha256(left).digest() if digest else left))
            kinds = [pa.int64()] * 6 + [pa.string(), pa.binary()]
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
            names = [x.split()[0] for x in _RUNS.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("d"), *columns], names=names)

    return found


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", least: int = LEAST, power: int = POWER, digest: bool = False
) -> DataFrame:
    """Rows (d, n_words, n_runs, start, length, period, exponent_milli, runs, kept), one for each document.

    A run is a stretch of words with smallest period q, at least max(least, power * q) words long, that no neighbouring
    word extends. start to exponent_milli are those of the longest one (ties: smallest start, then period; nulls without
    runs); runs: `start,length,period` and a line end for each, by start and period; kept: the words that are in no run
    after its first q words, joined by one space, as UTF-8 or (digest) its SHA-256.

    Words are what white space of ASCII separates. A null or empty text has no words and no runs. Repeated rows are
    documents of their own; d of a null id is the smallest long. Documents are independent: nothing is shuffled.
    """
    if power < 3:
        raise ValueError("power is at least 3")
    rows = docs.select(id_key(id_column).alias("d"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_found(least, power, digest), _RUNS)


def with_planted_runs(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Documents in which one in ten, known by the CRC-32 h of its id's digits, repeats words from some place on.

    With n words and g = h div 10, each word i >= a becomes word a + (i - a) mod p; a = g mod n and
    p = 1 + (n - a) div (3 + g mod 8). A null id plants nothing.
    """
    h = F.crc32(F.col(id_column).cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(words: Column) -> Column:
        n, g = F.size(words), F.floor(h / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p))
        return F.array_join(F.transform(words, lambda _, i: F.get(words, place(i).cast("int"))), " ")

    planted = F.when(F.pmod(h, F.lit(10)) == 0, repeated(F.col("_words")))
    listed = docs.withColumn("_words", F.when(F.pmod(h, F.lit(10)) == 0, words))
    text = F.when(F.size("_words") > 0, planted).otherwise(F.col("text"))
    return listed.withColumn("text", text).drop("_words")
