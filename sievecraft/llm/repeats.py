"""Repeated windows of a fixed width over all texts, found through anchors.

Every window of WIDTH units (bytes, words) is owned by an anchor: a place that is chosen by the window's content alone,
so equal windows have equal anchors. Consecutive windows of one text with the same anchor place form a piece. Then

1. anchors are counted; one that occurs once owns no repeated window, and its pieces are done,
2. if all pieces of an anchor are equal, all their windows are repeated,
3. what is left, anchors with several kinds of pieces, is compared text by text, one piece of each kind.

Rows: r row of the text, d document id, at first window and number of windows (see `packed`), k hash of the anchor, p hash
of the piece's content. Equality of pieces is that of the two hashes, 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sievecraft.llm import common
from sievecraft.llm.common import saved

PIECES = "r long, d long, at long, k long, p long"
FOUND = "k long, p long, runs array<struct<a:int,b:int,m:long>>"

SHARD = 1 << 20  # bytes of pieces compared together in a task, at least
CROWD = 8192  # kinds of one anchor up to which they are compared in one task; above, window by window

_COUNT = 24  # bits for the number of windows


def packed(start: np.ndarray, count: np.ndarray) -> pa.Array:
    """First window and number of windows of pieces as one number."""
    return pa.array((start.astype(np.int64) << _COUNT) | count)


def _first():
    return F.shiftright("at", _COUNT).cast("int")


def _count():
    return F.col("at").bitwiseAND((1 << _COUNT) - 1).cast("int")


def keyed(docs: DataFrame) -> DataFrame:
    """Columns r, d and text: rows that agree in id and text agree in r."""
    return common.keyed_texts(docs).select("d", F.xxhash64("d", "t").alias("r"), "text")


def runs_of(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true flags that stay within one owner."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(flags), bool)
    new[1:] = owner[1:] != owner[:-1]
    before = np.concatenate([[False], flags[:-1]]) & ~new
    after = np.concatenate([flags[1:] & ~new[1:], [False]])
    return np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after) + 1


def owned_pieces(anchor: np.ndarray, valid: np.ndarray, owner: np.ndarray):
    """Starts and lengths of the runs of valid windows with one anchor place in one text."""
    at = np.flatnonzero(valid)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (anchor[at[1:]] != anchor[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at)))


def removed_spans(
    docs: DataFrame,
    pieces: Callable,
    compare: Callable[[DataFrame, DataFrame], DataFrame],
    width: int,
    first_stays: bool,
) -> DataFrame:
    """Rows (r, spans): the units of each text that lie in repeated windows, as (s, e) in any order.

    docs: rows of `keyed`. compare(kinds, docs) gives rows of FOUND for the kinds (k, p, c, low, r, s, n, crowd) of the
    anchors with several. first_stays: windows of the smallest d that has them are left in place; else all occurrences go.
    """
    rows = saved(docs.mapInArrow(pieces, PIECES))
    if not first_stays:
        rows = rows.withColumn("d", F.lit(0).cast("long"))
    anchors = saved(  # as tables, so that the joins can split hot keys
        rows.groupBy("k")
        .agg(F.count(F.lit(1)).alias("c"), F.min("p").alias("p0"), F.max("p").alias("p1"), F.min("d").alias("low"))
        .filter("c > 1")
        .select("k", (F.col("p0") == F.col("p1")).alias("alike"), "low")
    )
    again = saved(rows.join(anchors, "k"))
    rule = F.col("d") > F.col("low") if first_stays else F.lit(True)
    whole = again.filter("alike").filter(rule).select("r", _first().alias("s"), (_first() + _count() - 1 + width).alias("e"))
    unlike = again.filter("NOT alike").drop("alike", "low")
    order = F.xxhash64("r", "at")
    kinds = saved(
        unlike.groupBy("k", "p").agg(
            F.count(F.lit(1)).alias("c"),
            F.min("d").alias("low"),
            *(F.min_by(name, order).alias(name) for name in ("r", "at")),
        )
    )
    kinds = kinds.select("k", "p", "c", "low", "r", _first().alias("s"), _count().alias("n"))
    crowds = saved(kinds.groupBy("k").agg(F.count(F.lit(1)).alias("crowd")))
    found = saved(compare(kinds.join(crowds, "k"), docs))
    found = found.select("k", "p", F.explode("runs").alias("run")).select("k", "p", "run.*")
    rule = F.col("d") > F.col("m") if first_stays else F.lit(True)
    part = unlike.join(found, ["k", "p"]).filter(rule).select(
        "r", (_first() + F.col("a")).alias("s"), (_first() + F.col("b") - 1 + width).alias("e")
    )
    return whole.union(part).groupBy("r").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def merged(spans: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the union of spans, in order."""
    if not spans:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.array([(x["s"], x["e"]) for x in spans], np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    first = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] > reach[:-1]]))
    return pairs[first, 0], reach[np.append(first[1:], len(pairs)) - 1]


def wanted(kinds: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (text, kinds): each text that holds a piece to be looked at, once, with its pieces."""
    per_text = kinds.groupBy("r").agg(F.collect_list(F.struct(*(c for c in kinds.columns if c != "r"))).alias("kinds"))
    return docs.select("r", "text").join(per_text.hint("shuffle_hash"), "r").select("text", "kinds")


FIELDS = ("k", "p", "c", "low", "s", "n", "crowd")
STRINGS = "k long, p long, c long, low long, n int, string binary"
WINDOWS = "k long, p long, i int, v long, w long, c long, low long"


def string_rows(fields: dict[str, np.ndarray], strings: list[bytes]) -> pa.RecordBatch:
    """STRINGS rows of some kinds."""
    columns = [pa.array(fields[name]) for name in ("k", "p", "c", "low")]
    columns += [pa.array(fields["n"].astype(np.int32)), pa.array(strings, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["k", "p", "c", "low", "n", "string"])


def run_rows(rows: list[dict], owner: np.ndarray, start: np.ndarray, end: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    """FOUND rows of some kinds from their runs of windows, in order of `owner`."""
    offsets = np.searchsorted(owner, np.arange(len(rows) + 1)).astype(np.int32)
    runs = pa.StructArray.from_arrays(
        [pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(low)], names=["a", "b", "m"]
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array([x["k"] for x in rows], pa.int64()),
            pa.array([x["p"] for x in rows], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), runs),
        ],
        names=["k", "p", "runs"],
    )


def compared(strings: DataFrame, windows: DataFrame, decide: Callable[[list[dict]], pa.RecordBatch]) -> DataFrame:
    """FOUND rows: from shards of whole pieces, that end between anchors, and for crowded anchors from single windows."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if held >= SHARD and row["k"] != rows[-1]["k"]:
                    yield decide(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row["string"])
        if rows:
            yield decide(rows)

    ordered = strings.repartition("k").sortWithinPartitions("k")
    return ordered.mapInArrow(shards, FOUND).union(_equal_windows(windows))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of neighbouring windows with one m in place of single windows."""
    for batch in batches:
        rows = batch.select(["k", "p"]).to_pylist()
        lists = [sorted((x["i"], x["m"]) for x in part) for part in batch.column("found").to_pylist()]
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in lists])
        at, low = (np.array([x[k] for part in lists for x in part], np.int64) for k in (0, 1))
        new = np.ones(len(at), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        yield run_rows(rows, owner[first], at[first], at[last] + 1, low[first])


def _equal_windows(windows: DataFrame) -> DataFrame:
    """FOUND rows of windows that occur more than once; m is the smallest document that has the window.

    Equal windows are counted per task before they are shuffled.
    """
    totals = windows.groupBy("v", "w").agg(F.sum("c").alias("all"), F.min("low").alias("m")).filter("all > 1")
    found = windows.select("k", "p", "i", "v", "w").join(totals.select("v", "w", "m"), ["v", "w"])
    lists = found.groupBy("k", "p").agg(F.collect_set(F.struct("i", "m")).alias("found"))
    return lists.mapInArrow(_joined, FOUND)


def spread(kinds: list[list[dict]], fields: tuple[str, ...]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of each kind in a list column, and its fields as arrays."""
    row = np.repeat(np.arange(len(kinds)), [len(x) for x in kinds])
    return row, {name: np.array([x[name] for part in kinds for x in part], np.int64) for name in fields}


def window_rows(fields: dict[str, np.ndarray], start: np.ndarray, hashes: list) -> dict[str, np.ndarray]:
    """One row for each window of the given pieces; start: the first window's place in the hashed sequences."""
    n = fields["n"]
    piece = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    at = start[piece] + inside
    return {
        "k": fields["k"][piece],
        "p": fields["p"][piece],
        "i": inside.astype(np.int32),
        "v": hashes[0](at).view(np.int64),
        "w": hashes[1](at).view(np.int64),
        "c": fields["c"][piece],
        "low": fields["low"][piece],
    }
