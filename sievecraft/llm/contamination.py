"""Benchmark decontamination with suffix arrays of the training texts.

Every task builds the suffix array of the words of its shard of documents, and binary-searches every suffix of the test
items in it. That yields the longest verbatim match of each test suffix with its location, and all places where its
first `window` words occur. Affected documents can then be removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sievecraft.llm import common, texts

WINDOW = 13
SHARD = 4 << 20  # bytes of text under one suffix array
# Bytes of test items searched together, for which the driver needs some 600 MB; more items are searched block by block.
BLOCK = 16 << 20

SEPARATORS = texts.NOT_ALPHANUMERIC


@dataclass
class Items:
    """One block of test items. Words have dense numbers from 1, in the order of their hashes."""

    ids: list[str | None]
    item_of: np.ndarray  # item of each distinct (window, item)
    first: np.ndarray  # windows: offset of their items in item_of, one more at the end
    starts: np.ndarray  # windows: place of their first word in `words`
    sizes: np.ndarray  # windows: words
    words: np.ndarray  # numbers of the words of all items, 0 between items
    vocabulary: np.ndarray  # sorted hashes


def items_index(rows: list[tuple[str | None, str | None]], window: int = WINDOW) -> Items:
    """Index of (id, text) rows. Texts without words have no window; shorter ones than a window are one window."""
    data, offsets = texts.text_bytes(pa.array([text for _, text in rows], pa.string()), True)
    starts, ends, cuts = texts.words(data, offsets, SEPARATORS)
    hashes = texts.word_hashes(data, starts, ends)
    vocabulary, numbers = np.unique(hashes, return_inverse=True)
    count = np.diff(cuts)
    words = np.zeros(len(numbers) + len(rows), np.int64)  # a zero after each item
    place = np.arange(len(numbers)) + np.repeat(np.arange(len(rows)), count)
    words[place] = numbers + 1
    size = np.minimum(count, window)
    windows = np.where(count > 0, count - size + 1, 0)
    item = np.repeat(np.arange(len(rows)), windows)
    inside = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
    begin = (cuts[:-1] + np.arange(len(rows)))[item] + inside
    sizes = size[item]
    # Equal windows get one number; windows are equal if 128 bits of hash are, and no window is kept as such.
    first = cuts[:-1][item] + inside
    keys = [texts.Windows(hashes, k).hash(first, first + sizes) for k in (0, 1)] if len(item) else [np.zeros(0, np.uint64)] * 2
    order = np.lexsort(keys)
    fresh = np.ones(len(item), bool)
    fresh[1:] = (keys[0][order[1:]] != keys[0][order[:-1]]) | (keys[1][order[1:]] != keys[1][order[:-1]])
    which = np.empty(len(item), np.int64)
    which[order] = np.cumsum(fresh) - 1
    number_of_windows = int(fresh.sum())
    del keys, order
    pairs = np.unique(which * max(len(rows), 1) + item)
    pairs = np.stack(np.divmod(pairs, max(len(rows), 1)), 1)
    _, one = np.unique(which, return_index=True)
    return Items(
        [key for key, _ in rows],
        pairs[:, 1],
        np.searchsorted(pairs[:, 0], np.arange(number_of_windows + 1)),
        begin[one],
        sizes[one],
        words,
        vocabulary,
    )


class SuffixArray:
    """Suffixes of a word sequence in lexicographic order of their first `depth` words.

    Only suffixes that start with a known word are kept: no other can begin as a test suffix does.
    """

    def __init__(self, numbers: np.ndarray, depth: int, bits: int, kept: np.ndarray):
        """numbers: known words from 1; 0 for unknown ones and between texts. kept: starts of suffixes."""
        self.depth, self.bits, self.per = depth, bits, 63 // bits
        keys = self.keys(numbers, kept)
        order = np.lexsort(keys[::-1])
        self.places = kept[order]
        self.columns = [key[order] for key in keys]

    def keys(self, numbers: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The first `depth` words at the given places, packed into integers that compare like them; zeros follow a zero."""
        padded = np.concatenate([numbers, np.zeros(self.depth, np.int64)])
        out, alive = [], np.ones(len(at), bool)
        for base in range(0, self.depth, self.per):
            key = np.zeros(len(at), np.int64)
            for k in range(base, min(base + self.per, self.depth)):
                word = padded[at + k]
                alive &= word > 0
                key = (key << self.bits) | np.where(alive, word, 0)
            key <<= self.bits * max(0, base + self.per - self.depth)
            out.append(key)
        return out

    def masks(self, sizes: np.ndarray) -> list[np.ndarray]:
        """For each key column, a mask over its words beyond the given number of words."""
        out = []
        for base in range(0, self.depth, self.per):
            free = (self.per - np.clip(sizes - base, 0, self.per)) * self.bits
            out.append((np.int64(1) << free) - 1)
        return out

    def search(self, keys: list[np.ndarray], right: bool) -> np.ndarray:
        """Binary search of all keys at once: the first suffix not below (right: above) each."""
        low = np.zeros(len(keys[0]), np.int64)
        high = np.full(len(keys[0]), len(self.places), np.int64)
        for _ in range(len(self.places).bit_length()):
            open_ = low < high
            mid = np.where(open_, (low + high) >> 1, 0)
            below, equal = np.zeros(len(low), bool), np.ones(len(low), bool)
            for column, key in zip(self.columns, keys):
                value = column[mid]
                below |= equal & (value < key)
                equal &= value == key
            go = open_ & (below | (equal & right))
            low = np.where(go, mid + 1, low)
            high = np.where(open_ & ~go, mid, high)
        return low

    def interval(self, keys: list[np.ndarray], sizes: np.ndarray):
        """Ranges of the suffixes that begin with the first `sizes` words of each key."""
        masks = self.masks(sizes)
        low = self.search([key & ~mask for key, mask in zip(keys, masks)], False)
        return low, self.search([key | mask for key, mask in zip(keys, masks)], True)

    def longest(self, numbers: np.ndarray, other: np.ndarray, at: np.ndarray):
        """Longest match of each suffix of `other` (up to `depth` words), and the place of one."""
        keys = self.keys(other, at)
        here = self.search(keys, False)
        best, place = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
        numbers = np.concatenate([numbers, np.zeros(self.depth, np.int64)])
        other = np.concatenate([other, np.zeros(self.depth, np.int64)])
        for neighbour in (here - 1, here):
            there = (neighbour >= 0) & (neighbour < len(self.places))
            spot = np.where(there, self.places[np.clip(neighbour, 0, len(self.places) - 1)], 0)
            same, common_words = there.copy(), np.zeros(len(at), np.int64)
            for k in range(self.depth):
                same &= (numbers[spot + k] == other[at + k]) & (other[at + k] > 0)
                common_words += same
            better = common_words > best
            best, place = np.where(better, common_words, best), np.where(better, spot, place)
        return best, place


def _shard(column: pa.Array, items: Items):
    """Words of a shard by their numbers in `items`, a zero after each document; word counts; place of each document."""
    data, offsets = texts.text_bytes(column, True)
    starts, ends, cuts = texts.words(data, offsets, SEPARATORS)
    hashes = texts.word_hashes(data, starts, ends)
    at = np.minimum(np.searchsorted(items.vocabulary, hashes), max(len(items.vocabulary) - 1, 0))
    known = items.vocabulary[at] == hashes if len(items.vocabulary) else np.zeros(len(at), bool)
    count = np.diff(cuts)
    numbers = np.zeros(len(hashes) + len(count), np.int64)
    numbers[np.arange(len(hashes)) + np.repeat(np.arange(len(count)), count)] = np.where(
        known, at + 1, 0
    )
    return numbers, count, cuts[:-1] + np.arange(len(count))


def _suffix_array(numbers: np.ndarray, items: Items, least: int) -> SuffixArray:
    """Over the suffixes with at least `least` known words in a row."""
    gaps = np.flatnonzero(numbers == 0)
    ahead = np.append(gaps, len(numbers))[np.searchsorted(gaps, np.arange(len(numbers)))]
    kept = np.flatnonzero(ahead - np.arange(len(numbers)) >= max(least, 1))
    depth = max(int(items.sizes.max(initial=1)), 1)
    return SuffixArray(numbers, depth, max(int(len(items.vocabulary)).bit_length(), 1), kept)


def shard_hits(column: pa.Array, items: Items):
    """Word counts, and hit runs (document, start, end) and (document, item) pairs, of the texts of one shard."""
    numbers, count, base = _shard(column, items)
    none = np.zeros((0, 3), np.int64), np.zeros((0, 2), np.int64)
    if not len(items.sizes) or not len(numbers):
        return count, *none
    array = _suffix_array(numbers, items, int(items.sizes.min()))
    low, high = array.interval(array.keys(items.words, items.starts), items.sizes)
    found = high - low
    window = np.repeat(np.arange(len(found)), found)
    if not len(window):
        return count, *none
    inside = np.arange(len(window)) - np.repeat(np.cumsum(found) - found, found)
    place = array.places[low[window] + inside]
    cover = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + items.sizes[window], -1)
    hit = np.cumsum(cover) > 0  # never at a zero: windows hold known words only
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit])))
    begin, end = edges[::2], edges[1::2]
    doc = np.searchsorted(base, begin, side="right") - 1
    runs = np.stack([doc, begin - base[doc], end - base[doc]], 1)
    doc = np.searchsorted(base, place, side="right") - 1
    pairs = np.unique(np.stack([doc, window], 1), axis=0)
    many = np.diff(items.first)[pairs[:, 1]]
    inside = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    item = items.item_of[np.repeat(items.first[pairs[:, 1]], many) + inside]
    return count, runs, np.unique(np.stack([np.repeat(pairs[:, 0], many), item], 1), axis=0)


_HITS = "d long, t long, n_words long, runs array<struct<s:long,e:long>>, items array<string>"


def _lists(values: pa.Array, owner: np.ndarray, rows: int) -> pa.ListArray:
    offsets = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _find(broadcast):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = broadcast.value
        for batch in texts.slices(batches, SHARD):
            count, runs, pairs = shard_hits(batch.column("text"), items)
            spans = pa.StructArray.from_arrays(
                [pa.array(runs[:, 1]), pa.array(runs[:, 2])], names=["s", "e"]
            )
            names = pa.array([items.ids[k] for k in pairs[:, 1].tolist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("d"),
                    batch.column("t"),
                    pa.array(count.astype(np.int64)),
                    _lists(spans, runs[:, 0], batch.num_rows),
                    _lists(names, pairs[:, 0], batch.num_rows),
                ],
                names=["d", "t", "n_words", "runs", "items"],
            )

    return find


def _blocks(benchmark: DataFrame, id_column: str) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in blocks of about BLOCK bytes each: what is held at once is bounded, however many items there are."""
    rows = benchmark.select(
        F.col(id_column).cast("string").alias("id"), F.col("text").cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = 1 + size // BLOCK
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    for block in range(blocks):
        yield [(row["id"], row["text"]) for row in rows.filter(F.col("block") == block).collect()]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    item_column: str = "item_id",
) -> DataFrame:
    """Rows (d, t, n_words, n_hit, items), one for each row of `docs`: how much of it occurs in test items.

    Words are lower-case runs of letters, digits and all bytes above 127. A window is `window` consecutive words of an
    item, or all of a shorter one. Words inside an occurrence of a window are hit; `items` has the sorted ids whose
    windows occur. Null and empty texts have no words; an item without id counts for hits and is not listed. Repeated
    rows each give a row. Columns other than id and text are not read.
    """
    spark = docs.sparkSession
    found, blocks = None, 0
    for rows in _blocks(benchmark, item_column):
        index = spark.sparkContext.broadcast(items_index(rows, window))
        part = common.keyed_texts(docs, id_column).mapInArrow(_find(index), _HITS)
        found, blocks = part if found is None else found.union(part), blocks + 1
    merged = found.groupBy("d", "t").agg(
        F.max("n_words").alias("n_words"),
        (F.count(F.lit(1)) / blocks).cast("int").alias("copies"),
        F.array_sort(F.flatten(F.collect_set("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end"))
    hit = F.aggregate(
        "runs",
        start,
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"),
            F.greatest(a["end"], x["e"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    return merged.select(
        "d", "t", "n_words", hit.alias("n_hit"),
        F.filter("items", lambda x: x.isNotNull()).alias("items"),
        F.explode(F.sequence(F.lit(1), "copies")).alias("copy"),
    ).drop("copy")


def is_contaminated(percent: int = 5):
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent)


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """`docs` without those of which at least `percent` % of the words lie in occurrences of test windows."""
    affected = contamination(docs, benchmark, window).filter(is_contaminated(percent))
    keys = affected.select(F.col("d").alias("_d"), F.col("t").alias("_t")).distinct()
    here = (common.id_key("doc_id") == keys["_d"]) & (F.xxhash64("text") == keys["_t"])
    return docs.join(keys, here, "left_anti")


def longest_matches(docs: DataFrame, benchmark: DataFrame, depth: int = 64) -> DataFrame:
    """Rows (item_id, word, length, doc_id, place): the longest match of each test suffix, up to `depth` words.

    doc_id and place are one of several places of that length; suffixes without a match are left out.
    """

    def search(broadcast):
        def run(batches):
            items = broadcast.value
            at = np.flatnonzero(items.words)
            item_start = np.append(0, np.flatnonzero(items.words == 0) + 1)
            for batch in texts.slices(batches, SHARD):
                numbers, _, base = _shard(batch.column("text"), items)
                kept = np.flatnonzero(numbers)
                if not len(kept) or not len(at):
                    continue
                array = SuffixArray(numbers, depth, max(len(items.vocabulary).bit_length(), 1), kept)
                length, place = array.longest(numbers, items.words, at)
                hit = length > 0
                doc = np.searchsorted(base, place[hit], side="right") - 1
                item = np.searchsorted(item_start, at[hit], side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([items.ids[k] for k in item.tolist()], pa.string()),
                        pa.array(at[hit] - item_start[item]),
                        pa.array(length[hit]),
                        batch.column("d").take(pa.array(doc)),
                        pa.array(place[hit] - base[doc]),
                    ],
                    names=["item_id", "word", "length", "doc_id", "place"],
                )

        return run

    found = None
    for rows in _blocks(benchmark, "item_id"):
        index = docs.sparkSession.sparkContext.broadcast(items_index(rows))
        part = common.keyed_texts(docs).mapInArrow(
            search(index), "item_id string, word long, length long, doc_id long, place long"
        )
        found = part if found is None else found.union(part)
    best = F.min(F.struct((-F.col("length")).alias("l"), "doc_id", "place")).alias("m")
    return found.groupBy("item_id", "word").agg(best).select(
        "item_id", "word", (-F.col("m.l")).alias("length"), "m.doc_id", "m.place"
    )
