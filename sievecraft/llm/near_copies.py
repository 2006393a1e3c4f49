"""Near-copy detection: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

1. A document's shingles are hashed once. The range of hashes is cut into BINS equal bins, and the smallest hash of each
   bin is the signature. An empty bin borrows from the first filled one in a fixed random order of its own.
2. Documents with the same set are one class; only its representative goes on.
3. ROWS bins make a band; representatives that agree in a band share a bucket. Each is paired with the bucket's centre
   only (a star), and the pairs are confirmed on the full sets. The centre is the member that meets most others over all
   its buckets: of copies that differ more from each other than from their original, the original.
4. Buckets whose members are then still in different components get the pairs between those components, so no link is
   lost because it does not touch the star's centre. In buckets of more than SMALL members these are not made one by
   one: members are dealt into blocks, and a task counts what the sets of two blocks share by products of matrices.

A pair with similarity s shares a bucket with probability 1 - (1 - s^ROWS)^BANDS; at 0.8 it misses all with 5e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sievecraft.llm import common, texts
from sievecraft.llm.common import NO_ID, saved

ROWS, BANDS = 6, 40
BINS = ROWS * BANDS
SMALL = 128  # members of a bucket up to which pairs that stars leave apart are joined; more are compared by blocks
BLOCK, HEAVY = 1024, 2 << 20  # members of a block and shingles of all of them, about
WIDE = 4096  # shingles compared at a time

_ORDER = np.argsort(
    texts.mix(np.arange(BINS * BINS, dtype=np.uint64)).reshape(BINS, BINS), axis=1
)  # for each empty bin, the order in which it asks the others


def shingle_sets(column: pa.Array, width: int):
    """Sorted distinct shingle hashes of all texts, and their n + 1 offsets."""
    data, offsets = texts.text_bytes(column, True)
    starts, ends, cuts = texts.words(data, offsets)
    hashes = texts.word_hashes(data, starts, ends)
    count = np.diff(cuts)
    rolled = hashes.copy()
    for k in range(1, width):
        rolled[: len(hashes) - k] = texts.pair_hash(rolled[: len(hashes) - k], hashes[k:])
    whole = np.flatnonzero((count > 0) & (count < width))
    made = np.where(count >= width, count - width + 1, 0)
    made[whole] = 1
    out = np.empty(int(made.sum()), np.uint64)
    at = np.cumsum(made) - made
    own = np.repeat(np.arange(len(count)), made)
    out[:] = rolled[cuts[:-1][own] + np.arange(len(out)) - at[own]]
    for k in whole.tolist():  # fewer words than a shingle: all of them
        value = np.full(1, count[k], np.uint64)
        for word in range(cuts[k], cuts[k + 1]):
            value = texts.pair_hash(value, hashes[word : word + 1])
        out[at[k]] = value[0]
    for a, b in zip(at.tolist(), (at + made).tolist()):
        out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (own[1:] != own[:-1])
    return out[fresh], np.searchsorted(own[fresh], np.arange(len(count) + 1))


def signatures(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of BINS values for each set; rows of empty sets mean nothing."""
    rows = len(offsets) - 1
    own = np.repeat(np.arange(rows), np.diff(offsets))
    bins = ((sets >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    cell = own * BINS + bins
    first = np.ones(len(sets), bool)
    first[1:] = cell[1:] != cell[:-1]
    values, filled = np.zeros(rows * BINS, np.uint64), np.zeros(rows * BINS, bool)
    values[cell[first]], filled[cell[first]] = sets[first], True
    values, filled = values.reshape(rows, BINS), filled.reshape(rows, BINS)
    row, bin_ = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    out = values.copy()
    for ask in range(BINS):
        if not len(row):
            break
        other = _ORDER[bin_, ask]
        found = filled[row, other]
        out[row[found], bin_[found]] = values[row[found], other[found]]
        row, bin_ = row[~found], bin_[~found]
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One row of BANDS bucket keys for each signature."""
    cells = values.reshape(len(values), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), cells.shape[:2])
    for k in range(ROWS):
        keys = texts.pair_hash(keys, cells[:, :, k])
    return keys


_SKETCH = "d long, t long, n long, s1 long, s2 long, bands array<long>"


def _sketch(width: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            sets, offsets = shingle_sets(batch.column("text"), width)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(v)]) for v in (sets, texts.mix(sets))]
            count = np.diff(offsets)
            keys = band_keys(signatures(sets, offsets))[count > 0]
            at = np.concatenate([[0], np.cumsum(count > 0) * BANDS]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("d"),
                    batch.column("t"),
                    pa.array(count),
                    *(texts.as_long(s[offsets[1:]] - s[offsets[:-1]]) for s in sums),
                    pa.ListArray.from_arrays(pa.array(at), texts.as_long(keys.reshape(-1))),
                ],
                names=["d", "t", "n", "s1", "s2", "bands"],
            )

    return sketch


def _sets(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            values, offsets = shingle_sets(batch.column("text"), width)
            raw = [values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), pa.array(raw, pa.binary())], names=["v", "members"]
            )

    return sets


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (left, right))
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                hit.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return confirm


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set on the left has in common with each on the right."""
    values = [np.concatenate(side) for side in (left, right)]
    both = np.intersect1d(*values)
    out = np.zeros((len(left), len(right)), np.int64)
    if not len(both):
        return out
    places = []
    for side, flat in zip((left, right), values):
        own = np.repeat(np.arange(len(side)), [len(x) for x in side])
        at = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        held = both[at] == flat
        own, at = own[held], at[held]
        order = np.argsort(at, kind="stable")
        places.append((own[order], at[order]))
    for low in range(0, len(both), WIDE):
        cells = []
        for side, (own, at) in zip((left, right), places):
            part = slice(*np.searchsorted(at, (low, low + WIDE)))
            cells.append(np.zeros((len(side), min(WIDE, len(both) - low)), np.float32))
            cells[-1][own[part], at[part] - low] = 1
        out += (cells[0] @ cells[1].T).astype(np.int64)
    return out


def _forest(hit: np.ndarray) -> list[tuple[int, int]]:
    """Row and column of cells that hold the same rows and columns together as all true cells do."""
    new = [np.ones(n, bool) for n in hit.shape]
    out = []
    for start in np.flatnonzero(hit.any(axis=1)).tolist():
        todo = [(0, start)] if new[0][start] else []
        new[0][start] = False
        while todo:
            side, k = todo.pop()
            found = np.flatnonzero((hit[:, k] if side else hit[k]) & new[1 - side]).tolist()
            new[1 - side][found] = False
            out += [(x, k) if side else (k, x) for x in found]
            todo += [(1 - side, x) for x in found]
    return out


def _between(percent: int):
    """Links between two blocks, or within one: as many as hold together what all of them do."""

    def between(group: pa.Table) -> pa.Table:
        rep, component, block, i, j = (group.column(x).to_numpy() for x in ("rep", "c", "block", "i", "j"))
        sets = [np.frombuffer(v.as_py(), np.uint64) for v in group.column("members")]
        count = np.array([len(x) for x in sets])
        x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links = []
        if len(x) and len(y):
            both = _shared([sets[k] for k in x], [sets[k] for k in y])
            hit = 100 * both >= percent * (count[x][:, None] + count[y][None] - both)
            hit &= component[x][:, None] != component[y][None]
            links = [sorted((int(rep[x[a]]), int(rep[y[b]]))) for a, b in _forest(hit)]
        return pa.table({name: pa.array([link[k] for link in links], pa.int64()) for k, name in enumerate("ab")})

    return between


def _linked_blocks(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members (key, rep, n, c) of a bucket that are in different components c.

    A component of more than a block is dealt into blocks of its own, the others share blocks.
    """
    parts = placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("heavy"))

    def cuts():
        return F.ceil(F.greatest(F.col("many") / BLOCK, F.col("heavy") / HEAVY))

    parts = saved(parts.withColumn("own", cuts()))
    rest = parts.filter("own = 1").groupBy("key").agg(F.sum("many").alias("many"), F.sum("heavy").alias("heavy"))
    parts = parts.join(rest.select("key", cuts().alias("together")), "key", "left")
    alone = F.col("own") > 1
    block = F.xxhash64(
        F.when(alone, F.col("c")).otherwise(NO_ID),
        F.when(alone, F.pmod(F.xxhash64("rep"), "own")).otherwise(F.pmod(F.xxhash64("c"), "together")),
    )
    dealt = saved(
        placed.join(parts.select("key", "c", "own", "together"), ["key", "c"])
        .select("key", block.alias("block"), "rep", "n", "c")
    )
    cells = saved(
        dealt.groupBy("key", "block").agg(
            F.min("c").alias("low"), F.max("c").alias("high"), F.min("n").alias("n"), F.max("n").alias("most")
        )
    )
    x = cells.toDF("key", "i", "low", "high", "n", "most")
    y = cells.toDF("key", "j", "low_", "high_", "n_", "most_")
    apart = F.least("low", "low_") < F.greatest("high", "high_")
    near = (F.col("most") * 100 >= F.col("n_") * percent) & (F.col("most_") * 100 >= F.col("n") * percent)
    pairs = x.join(y, "key").filter((F.col("i") <= F.col("j")) & apart & near)
    sent = pairs.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    rows = sent.join(dealt.select("key", "block", "rep", "c").distinct(), ["key", "block"])
    rows = rows.join(sets.withColumnRenamed("v", "rep"), "rep")
    return saved(rows.groupBy("key", "i", "j").applyInArrow(_between(percent), "a long, b long"))


def _similar_size(percent: int):
    return F.least("n", "m") * 100 >= F.greatest("n", "m") * percent


def near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Rows (d, t, n, component), one for each row of `docs`: set size, and the smallest id reachable over links.

    Two documents are linked if their sets of `width`-word shingles (lower case; all words if there are fewer) have a
    Jaccard similarity of `percent` % or more. Texts without words are linked with nothing, and so are rows without an
    id. Rows of one id are one document, linked with all that any of their texts is. Columns other than doc_id and text
    are not read.
    """
    keyed = common.keyed_texts(docs)
    sketch = saved(keyed.mapInArrow(_sketch(width), _SKETCH))
    real = (F.col("n") > 0) & (F.col("d") != NO_ID)
    classes = saved(sketch.filter(real).groupBy("s1", "s2", "n").agg(F.min("d").alias("rep")))
    members = saved(
        sketch.withColumn("s1", F.when(real, F.col("s1")))
        .join(classes, ["s1", "s2", "n"], "left")
        .select("d", "t", "n", "rep", F.when(F.col("d") == F.col("rep"), F.col("bands")).alias("bands"))
    )
    buckets = members.filter("bands IS NOT NULL").select("rep", "n", F.explode("bands").alias("key"))
    crowds = saved(
        buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("a"), F.max("rep").alias("b"))
        .filter("a < b").select("key", "size")
    )
    shared = saved(buckets.join(crowds, "key"))
    company = saved(shared.groupBy("rep").agg(F.sum("size").alias("company")))
    shared = saved(shared.drop("size").join(company, "rep"))
    centres = saved(
        shared.groupBy("key").agg(F.max_by("rep", "company").alias("centre"), F.max_by("n", "company").alias("m"))
    )
    stars = saved(
        shared.join(centres, "key")
        .filter((F.col("rep") != F.col("centre")) & _similar_size(percent))
        .select(F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b"))
        .distinct()
    )
    ids = company.select(F.col("rep").alias("d"))
    sets = saved(
        keyed.join(ids, "d", "left_semi").select("d", "text").mapInArrow(_sets(width), "v long, members binary")
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("v").alias("a"), F.col("members").alias("left"))
        right = sets.select(F.col("v").alias("b"), F.col("members").alias("right"))
        rows = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
        return saved(rows.mapInArrow(_confirm(percent), "a long, b long"))

    several = (
        members.filter("rep IS NOT NULL").groupBy("d")
        .agg(F.min("rep").alias("a"), F.max("rep").alias("last")).filter("a < last").select("d", "a")
    )
    same_id = members.join(several, "d").filter("rep <> a").select("a", F.col("rep").alias("b"))
    links = saved(confirmed(stars).union(same_id).distinct())
    found = common.components(links)

    placed = shared.join(found.withColumnRenamed("v", "rep"), "rep", "left").select(
        "key", "rep", "n", F.coalesce("l", "rep").alias("c")
    )
    mixed = placed.groupBy("key").agg(
        F.min("c").alias("low"), F.max("c").alias("high"), F.count(F.lit(1)).alias("size")
    ).filter("low < high")
    placed = saved(placed.join(saved(mixed.select("key", "size")), "key"))
    blocks = _linked_blocks(placed.filter(F.col("size") > SMALL).drop("size"), sets, percent)
    placed = placed.filter(F.col("size") <= SMALL).drop("size")
    own = placed.groupBy("rep").agg(F.collect_set("key").alias("keys"))
    placed = placed.join(own, "rep")
    other = placed.select(
        "key", F.col("rep").alias("b"), F.col("n").alias("m"), F.col("c").alias("e"), F.col("keys").alias("others")
    )
    once = F.col("key") == F.array_min(F.array_intersect("keys", "others"))  # of all buckets that a pair shares, one
    across = (
        placed.join(other, "key")
        .filter((F.col("c") < F.col("e")) & _similar_size(percent) & once)
        .select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b"))
        .distinct()
    )
    rest = saved(across.join(stars, ["a", "b"], "left_anti"))
    found = common.components(saved(links.union(confirmed(rest)).union(blocks).distinct()))
    return members.join(found.withColumnRenamed("v", "rep"), "rep", "left").select(
        "d", "t", "n", F.coalesce("l", "rep", "d").alias("component")
    )


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of each group of near copies: the one with the smallest id. Rows without an id stay."""
    copies = near_copies(docs, width, percent).filter("d <> component").select(F.col("d").alias("_d")).distinct()
    return docs.join(copies, common.id_key("doc_id") == copies["_d"], "left_anti")
