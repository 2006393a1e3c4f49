"""Deduplication, exact cuts in a global order, and chronological splits.

The global order is that of one text key per row, by default the fixed-width commit instant
followed by the id. Keys are unique, and compare as bytes.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.storagelevel import StorageLevel

from sievecraft.functions.keys import group_key
from sievecraft.schemas import SPLITS

DEFAULT_CUTS = (8, 9)
DEFAULT_DENOMINATOR = 10
# Keys this few are sorted in one task.
SORTED_AT_ONCE = 100_000
# Items of a rank summary that wait on each level. With n keys a rank is off by log2(n / SUMMARY_SIZE) / SUMMARY_SIZE of n
# at most in each merge.
SUMMARY_SIZE = 4_096
MERGE_TASKS = 32
SPLITTERS = 1_000  # buckets of a range in which a cut lies


def chronological_key(instant: str = "committed_at_utc", row_id: str = "id") -> Column:
    return F.concat(F.col(instant), F.col(row_id))


def with_group_key(df: DataFrame) -> DataFrame:
    return df.withColumn("group_key", group_key(F.col("patch_id"), F.col("id")))


def dedup_earliest(
    df: DataFrame, group: str = "group_key", order: tuple[str, ...] = ("committed_at_utc", "id")
) -> DataFrame:
    """The earliest row of each group of copies.

    Spark keeps one row per group and task before the shuffle, so a group that holds a large part
    of all rows sends one row from each task.
    """
    first = Window.partitionBy(group).orderBy(*order)
    return (
        df.withColumn("_place", F.row_number().over(first))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def split_bounds(
    total: int, cuts: tuple[int, ...] = DEFAULT_CUTS, denominator: int = DEFAULT_DENOMINATOR
) -> list[int]:
    """Ranks at which the second and later splits start."""
    return [total * cut // denominator for cut in cuts]


def split_sizes(bounds: list[int], total: int) -> dict[str, int]:
    edges = [0, *bounds, total]
    return {name: edges[i + 1] - edges[i] for i, name in enumerate(SPLITS)}


def _at_places(keys: DataFrame, offsets: list[int]) -> list[str]:
    """Keys at the given ranks of a small range, which is sorted in one task."""
    ranked = keys.withColumn("place", F.row_number().over(Window.orderBy("key")) - 1)
    found = ranked.filter(F.col("place").isin(offsets)).collect()
    at = {row["place"]: row["key"] for row in found}
    return [at[offset] for offset in offsets]


def _summariser(size: int):
    """Function of a task that makes one rank summary of keys, or of the summaries of other tasks.

    A summary is rows (key, level, error): an item stands for 2**level keys. Whenever 2 * size items of a level wait, they
    are sorted and every other one goes up a level, which moves no rank by more than 2**level; a last row without a key
    adds these up. So a task holds about `size` items for each doubling of the keys, whatever they are.
    """

    def summarise(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        levels: dict[int, list] = {}
        kept_first: dict[int, int] = {}
        total = error = 0

        def promote(level):
            nonlocal error
            items = pa.concat_arrays(levels.pop(level))
            items = items.take(pc.sort_indices(items))
            even = len(items) // 2 * 2
            if len(items) > even:
                levels[level] = [items.slice(even)]
            first = kept_first.get(level, 0)
            kept_first[level] = 1 - first
            error += 1 << level
            add(level + 1, items.take(pa.array(np.arange(first, even, 2))))

        def add(level, items):
            if len(items):
                levels.setdefault(level, []).append(items)
                if sum(map(len, levels[level])) >= 2 * size:
                    promote(level)

        for batch in batches:
            key, level = batch.column("key"), batch.column("level").to_numpy()
            error += int(batch.column("error").to_numpy().sum())
            items = key.is_valid().to_numpy(zero_copy_only=False)
            for one in np.unique(level[items]).tolist():
                picked = np.flatnonzero(items & (level == one))
                total += len(picked) << one
                add(one, key.take(pa.array(picked)))
        # What is left in the low levels goes up too, as far as it is fine enough for this many keys.
        for level in range(max(0, (total // size).bit_length() - 3)):
            if sum(map(len, levels.get(level, []))) > 1:
                promote(level)
        for level, parts in sorted(levels.items()):
            items = pa.concat_arrays(parts)
            yield pa.RecordBatch.from_arrays(
                [items.cast(pa.string()), pa.array(np.full(len(items), level, np.int32)), pa.array(np.zeros(len(items), np.int64))],
                names=["key", "level", "error"],
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.string()), pa.array([0], pa.int32()), pa.array([error], pa.int64())],
            names=["key", "level", "error"],
        )

    return summarise


@dataclass(frozen=True)
class RankSummary:
    """Sorted items (key, number of keys before it, as far as the summary knows); no such number is off by more than
    `error`."""

    keys: list[str]
    before: list[int]
    error: int

    def around(self, rank: int) -> tuple[str | None, str | None]:
        """Keys low <= x < high between which the key x of that rank lies for certain; None: no bound."""
        low = bisect_right(self.before, rank - self.error) - 1
        high = bisect_right(self.before, rank + self.error)
        return (
            self.keys[low] if low >= 0 else None,
            self.keys[high] if high < len(self.keys) else None,
        )


def rank_summary(keys: DataFrame, size: int = SUMMARY_SIZE) -> RankSummary:
    """One pass over the column `key`. Summaries of tasks are merged in two steps; the driver gets a few thousand items."""
    schema = "key string, level int, error long"
    rows = keys.select("key", F.lit(0).alias("level"), F.lit(0).cast("long").alias("error"))
    summarise = _summariser(size)
    parts = rows.mapInArrow(summarise, schema)
    merged = parts.repartition(MERGE_TASKS).mapInArrow(summarise, schema)
    found = merged.repartition(1).mapInArrow(summarise, schema).collect()
    items = sorted((row["key"], 1 << row["level"]) for row in found if row["key"] is not None)
    names, before, count = [], [], 0
    for key, weight in items:
        if not names or names[-1] != key:
            names.append(key)
            before.append(count)
        count += weight
    return RankSummary(names, before, sum(row["error"] for row in found))


def _ranges(summary: RankSummary, ranks: list[int]) -> list[list[str | None]]:
    """Disjoint rising lists [low, ..., high]: where the keys of the ranks lie, with summary keys in between."""
    spans = sorted({summary.around(rank) for rank in ranks}, key=lambda span: (span[0] is not None, span[0] or ""))
    joined: list[list[str | None]] = []
    for low, high in spans:
        if joined and (joined[-1][1] is None or low is None or low < joined[-1][1]):
            ends = (joined[-1][1], high)
            joined[-1][1] = None if None in ends else max(ends)
        else:
            joined.append([low, high])
    lists = []
    for low, high in joined:
        start = 0 if low is None else bisect_right(summary.keys, low)
        stop = len(summary.keys) if high is None else bisect_left(summary.keys, high)
        step = max(1, (stop - start) // SPLITTERS)
        lists.append([low, *summary.keys[start:stop:step], high])
    return lists


def _exact_keys(keys: DataFrame, summary: RankSummary, ranks: list[int]) -> list[str]:
    """The keys at the ranks: one pass counts the keys between the lists' members, and keeps those inside a list."""
    key = F.col("key")
    bucket, inside, number = None, F.lit(False), 0
    for low, *inner, high in _ranges(summary, ranks):
        place = F.size(F.filter(F.array(*map(F.lit, inner)).cast("array<string>"), lambda x: x <= key))
        here = F.lit(True) if high is None else key < F.lit(high)
        if low is not None:
            bucket = (F if bucket is None else bucket).when(key < F.lit(low), F.lit(number))
            inside = inside | ((key >= F.lit(low)) & here)
        else:
            inside = inside | here
        bucket = (F if bucket is None else bucket).when(here, place + (number + 1))
        number += len(inner) + 2
    # Equal keys are one row, so a bucket holds few rows whatever the keys are.
    counted = (
        keys.select(bucket.otherwise(F.lit(number)).alias("bucket"), F.when(inside, key).alias("key"))
        .groupBy("bucket", "key")
        .agg(F.count("*").alias("n"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    upto = F.sum("n").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    try:
        sizes = sorted(tuple(row) for row in counted.groupBy("bucket").agg(F.sum("n")).collect())
        out = []
        for rank in ranks:
            before = 0
            for number, size in sizes:
                if rank < before + size:
                    break
                before += size
            here = counted.filter(F.col("bucket") == number).withColumn("upto", upto)
            out.append(here.filter(F.col("upto") > rank - before).orderBy("key").first()["key"])
        return out
    finally:
        counted.unpersist()


def keys_at(
    keys: DataFrame, ranks: list[int], total: int, sorted_at_once: int = SORTED_AT_ONCE
) -> list[str]:
    """The keys at zero-based ranks of the column `key`, without a global sort.

    More than `sorted_at_once` keys are read at most twice, whatever they look like: a mergeable summary narrows all ranks
    at once, to ranges in which they lie for certain, and one exact count over these settles them. Only keys in the
    ranges, a few thousandths of all, are shuffled, and those of one bucket are sorted in one task.
    """
    if not ranks:
        return []
    if total <= sorted_at_once:
        return _at_places(keys.select("key"), ranks)
    summary = rank_summary(keys)
    return _exact_keys(keys, summary, ranks)


def cut_keys(
    keys: DataFrame, total: int, bounds: list[int], sorted_at_once: int = SORTED_AT_ONCE
) -> list[str | None]:
    """The first key of every later split; None for one that starts behind the last row."""
    inside = [bound for bound in bounds if bound < total]
    found = keys_at(keys, inside, total, sorted_at_once)
    return found + [None] * (len(bounds) - len(inside))


def assign_split(key: Column, cuts: list[str | None], names: tuple[str, ...] = SPLITS) -> Column:
    """Split of a row by comparing its key with the cuts: no shuffle, no rank column."""
    column = F.lit(names[-1])
    for name, cut in reversed(list(zip(names, cuts))):
        before = F.lit(True) if cut is None else key < F.lit(cut)
        column = F.when(before, F.lit(name)).otherwise(column)
    return column


def chronological_split(
    df: DataFrame,
    key: Column | None = None,
    cuts: tuple[int, ...] = DEFAULT_CUTS,
    denominator: int = DEFAULT_DENOMINATOR,
    sorted_at_once: int = SORTED_AT_ONCE,
) -> DataFrame:
    """Adds `split`: the first `n * 8 // 10` rows in key order train, up to `n * 9 // 10`
    validation, the rest test. Runs the narrow counting passes at once; the rows themselves stay
    lazy."""
    order = chronological_key() if key is None else key
    keys = df.select(order.alias("key")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = keys.count()
        bounds = split_bounds(total, cuts, denominator)
        found = cut_keys(keys, total, bounds, sorted_at_once)
    finally:
        keys.unpersist()
    return df.withColumn("split", assign_split(order, found))
