"""Approximate nearest neighbours by inner product, over a forest of hash prefixes.

Every vector has one long hash string in each tree: symbols of random rotations, each the axis that the rotated vector is
closest to. Vectors are dealt to shards, and a shard keeps, for each tree, its strings as a sorted array. A query descends
to its longest prefix match in every tree and then ascends all trees together, one bit at a time, until the ranges of
equal prefixes hold enough candidates; these are scored on the original vectors.

How many are enough is measured: a sample of queries is compared with brute force over all vectors, and the smallest
quota that reaches the wanted recall there is used for all queries. Where none does, whole shards are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sievecraft.llm.common import saved

TREES = 64
SYMBOLS = 3  # symbols of a hash string
AXES = 64  # axes of a rotation, at most; two symbol values for each
SHARD_BYTES = 1 << 23  # exact vectors of a shard, as doubles
QUERIES = 1024  # queries of one block
PER_PART = 64  # shards that a copy of the queries is sent to, once there are many
SAMPLE = 256  # queries compared with brute force to find the quota
RECALL = 0.96  # wanted on that sample
QUOTAS = [1 << k for k in range(6, 21)]  # candidates of a shard, counted once for each tree that has them

_SHARD = "dim int, sizes binary, ids binary, exact binary, sorted binary, places binary"


def usable(vector: str) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@lru_cache(maxsize=4)
def _rotations(dim: int, seed: int) -> np.ndarray:
    """Orthonormal axes for each symbol of each tree: (trees x symbols x axes, dim)."""
    random = np.random.default_rng([seed, dim])
    axes = [np.linalg.qr(random.normal(size=(dim, min(dim, AXES))))[0].T for _ in range(TREES * SYMBOLS)]
    return np.concatenate(axes).astype(np.float32)


def hash_bits(dim: int) -> int:
    return SYMBOLS * (2 * min(dim, AXES) - 1).bit_length()


def hash_strings(vectors: np.ndarray, seed: int) -> np.ndarray:
    """The strings of each vector, (trees, vectors), as numbers whose first bits are the first symbols."""
    rows, dim = vectors.shape
    axes = min(dim, AXES)
    per_symbol = hash_bits(dim) // SYMBOLS
    out = np.zeros((TREES, rows), np.uint32)
    rotations = _rotations(dim, seed)
    for at in range(0, rows, 512):
        turned = (vectors[at : at + 512].astype(np.float32) @ rotations.T).reshape(-1, TREES, SYMBOLS, axes)
        nearest = np.abs(turned).argmax(axis=3)
        positive = np.take_along_axis(turned, nearest[..., None], 3)[..., 0] > 0
        symbols = (2 * nearest + positive).astype(np.uint32)
        for k in range(SYMBOLS):
            out[:, at : at + 512] = out[:, at : at + 512] << np.uint32(per_symbol) | symbols[:, :, k].T
    return out


def lengthened(vectors: np.ndarray, norm: float | None) -> np.ndarray:
    """One more component, so that all have the length `norm`, and the nearest by angle are those of the largest inner
    product. Queries (norm None) get a zero."""
    squares = np.einsum("ij,ij->i", vectors, vectors)
    more = np.zeros(len(vectors)) if norm is None else np.sqrt(np.maximum(norm * norm - squares, 0))
    return np.concatenate([vectors, more[:, None]], axis=1)


def ranges(ordered: np.ndarray, strings: np.ndarray, level: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each tree and query: where the strings begin and end that share the first `level` bits with the query's."""
    rest = (bits - level).astype(np.uint64)
    low = strings.astype(np.uint64) >> rest << rest
    high = low + (np.uint64(1) << rest) - np.uint64(1)
    begins = [np.searchsorted(row, x) for row, x in zip(ordered, low.astype(np.uint32))]
    ends = [np.searchsorted(row, x, side="right") for row, x in zip(ordered, high.astype(np.uint32))]
    return np.array(begins), np.array(ends)


def stop_level(ordered: np.ndarray, strings: np.ndarray, quota: int, bits: int) -> np.ndarray:
    """The longest prefix at which the trees together hold `quota` candidates, for each query.

    Candidates only get more on the way up from the longest match, so the level where the ascent ends is bisected.
    """
    low = np.zeros(strings.shape[1], np.int64)
    high = np.full(strings.shape[1], bits)
    while (low < high).any():
        middle = (low + high + 1) // 2
        begin, end = ranges(ordered, strings, middle, bits)
        enough = (end - begin).sum(axis=0) >= quota
        low, high = np.where(enough, middle, low), np.where(enough, high, middle - 1)
    return low


class Shard:
    """Sorted arrays of one shard and its vectors; each vector stands for all rows that hold it."""

    def __init__(self, dim, sizes, ids, exact, ordered, places):
        self.dim = dim
        self.offsets = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int32))])
        self.ids = np.frombuffer(ids, np.int64)
        self.exact = np.frombuffer(exact).reshape(-1, dim)
        self.ordered = np.frombuffer(ordered, np.uint32).reshape(TREES, -1)
        self.places = np.frombuffer(places, np.int32).reshape(TREES, -1)
        self.bits = hash_bits(dim + 1)

    def candidates(self, strings: np.ndarray, quota: int) -> Iterator[np.ndarray]:
        level = stop_level(self.ordered, strings, quota, self.bits)
        begin, end = ranges(self.ordered, strings, level, self.bits)
        for q in range(strings.shape[1]):
            found = np.zeros(len(self.exact), bool)
            for tree in range(TREES):
                found[self.places[tree, begin[tree, q] : end[tree, q]]] = True
            yield np.flatnonzero(found)

    def best(self, found: np.ndarray, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows of the candidates, ties to the smaller id; not those of the id `own`."""
        first = self.offsets[found]
        found = found[(self.offsets[found + 1] - first > 1) | (self.ids[first] != own)]
        if len(found) > k:  # each of the rest has a row that is not the query's own
            scores = self.exact[found] @ query
            least = np.partition(scores, len(found) - k)[len(found) - k]
            found = found[scores >= least - 1e-9 * (1 + abs(least))]
        scores = np.einsum("ij,j->i", self.exact[found], query)
        counts = self.offsets[found + 1] - self.offsets[found]
        flat = np.repeat(self.offsets[found] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        ids, scores = self.ids[flat], np.repeat(scores, counts)
        ids, scores = ids[ids != own], scores[ids != own]
        order = np.lexsort((ids, -scores))[:k]
        return ids[order], scores[order]

    def shared_prefix(self, strings: np.ndarray) -> np.ndarray:
        """Bits that a query (its strings, one for each tree) and each vector have in common in their best tree."""
        least = np.full(len(self.exact), np.uint32(0xFFFFFFFF))
        for tree in range(TREES):
            at = self.places[tree]
            least[at] = np.minimum(least[at], self.ordered[tree] ^ strings[tree])
        return self.bits - np.ceil(np.log2(least.astype(np.float64) + 1)).astype(np.int64)


def _pack(seed: int):
    def shard(dim: int, sizes: np.ndarray, ids: np.ndarray, exact: np.ndarray) -> pa.RecordBatch:
        norm = float(np.sqrt(np.einsum("ij,ij->i", exact, exact).max()))
        strings = hash_strings(lengthened(exact, norm), seed)
        places = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        ordered = np.take_along_axis(strings, places, 1)
        data = (sizes.astype(np.int32), ids.astype(np.int64), exact, ordered, places)
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in data)],
            names=["dim", "sizes", "ids", "exact", "sorted", "places"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def joined(dim: int) -> pa.RecordBatch:
            return shard(dim, *(np.concatenate(x) for x in zip(*waiting.pop(dim))))

        for batch in batches:
            vectors, ids = batch.column("vector"), batch.column("ids")
            dims = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                rows = max(1, SHARD_BYTES // (8 * dim))
                picked = pa.array(np.flatnonzero(dims == dim))
                exact = vectors.take(picked).flatten().to_numpy().reshape(-1, dim)
                lists = ids.take(picked)
                sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
                ends = np.concatenate([[0], np.cumsum(sizes)])
                at = 0
                while at < len(exact):
                    parts = waiting.setdefault(dim, [])
                    to = min(len(exact), at + rows - sum(len(x[0]) for x in parts))
                    parts.append((sizes[at:to], flat[ends[at] : ends[to]], exact[at:to]))
                    if sum(len(x[0]) for x in parts) >= rows:
                        yield joined(dim)
                    at = to
        for dim in list(waiting):
            yield joined(dim)

    return pack


def _blocks(rows: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, ids = batch.column("vector"), batch.column("id").to_numpy()
            dims = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                picked = np.flatnonzero(dims == dim)
                for at in range(0, len(picked), rows):
                    some = picked[at : at + rows]
                    exact = vectors.take(pa.array(some)).flatten().to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([dim], pa.int32()),
                            pa.array([ids[some].tobytes()], pa.binary()),
                            pa.array([exact.tobytes()], pa.binary()),
                        ],
                        names=["dim", "query_ids", "queries"],
                    )

    return blocks


_COLUMNS = ["dim", "sizes", "ids", "exact", "sorted", "places"]


def _shards(batch: pa.RecordBatch) -> Iterator[tuple[int, Shard]]:
    for row in range(batch.num_rows):
        yield row, Shard(*(batch.column(name)[row].as_py() for name in _COLUMNS))


def _search(k: int, quota: int, seed: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, shard in _shards(batch):
                query_ids = np.frombuffer(batch.column("query_ids")[row].as_py(), np.int64)
                queries = np.frombuffer(batch.column("queries")[row].as_py()).reshape(-1, shard.dim)
                strings = hash_strings(lengthened(queries, None), seed)
                asked, ids, scores = [], [], []
                for q, found in enumerate(shard.candidates(strings, quota)):
                    best, value = shard.best(found, query_ids[q], queries[q], k)
                    asked.append(np.full(len(best), query_ids[q]))
                    ids.append(best)
                    scores.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (asked, ids, scores)], names=["query_id", "id", "score"]
                )

    return search


def _tried(sample: list[tuple[int, list[float]]], k: int, seed: int):
    """For each query of the sample: the k best rows of a shard, and the smallest quota that finds each."""

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, shard in _shards(batch):
                queries = [(number, vector) for number, (_, vector) in enumerate(sample) if len(vector) == shard.dim]
                if not queries:
                    continue
                strings = hash_strings(lengthened(np.array([vector for _, vector in queries]), None), seed)
                levels = np.array([stop_level(shard.ordered, strings, quota, shard.bits) for quota in QUOTAS])
                everything = np.arange(len(shard.exact))
                owner = np.repeat(everything, np.diff(shard.offsets))
                order = np.argsort(shard.ids, kind="stable")
                rows: list[tuple] = []
                for at, (number, vector) in enumerate(queries):
                    ids, scores = shard.best(everything, sample[number][0], np.array(vector), k)
                    place = owner[order[np.searchsorted(shard.ids, ids, sorter=order)]]
                    common = shard.shared_prefix(strings[:, at])[place]
                    found = levels[:, at][:, None] <= common[None, :]
                    need = np.where(found.any(axis=0), found.argmax(axis=0), len(QUOTAS))
                    rows += zip([number] * len(ids), ids.tolist(), scores.tolist(), need.tolist())
                kinds = (pa.int32(), pa.int64(), pa.float64(), pa.int32())
                columns = zip(*rows) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(columns, kinds)], names=["number", "id", "score", "need"]
                )

    return tried


class Forest:
    """A built forest: `shards` is its table, a row for each shard."""

    def __init__(self, shards: DataFrame, k: int, seed: int):
        self.shards, self.k, self.seed = shards, k, seed

    def quota(self, queries: DataFrame, recall: float = RECALL, sample: int = SAMPLE) -> tuple[int, float]:
        """The smallest quota whose recall over a sample of the queries is at least `recall`, and that recall.

        The sample is compared with brute force over all vectors. The driver gets the sample's vectors and one count a quota.
        """
        some = queries.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
        if not some:
            return QUOTAS[0], 1.0
        tried = self.shards.mapInArrow(
            _tried([tuple(row) for row in some], self.k, self.seed), "number int, id long, score double, need int"
        )
        order = Window.partitionBy("number").orderBy(F.desc("score"), "id")
        best = tried.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= self.k)
        counts = dict(best.groupBy("need").count().collect())
        total, found = sum(counts.values()), 0
        for level, quota in enumerate(QUOTAS):
            found += counts.get(level, 0)
            if found >= recall * total:
                return quota, found / total if total else 1.0
        return 1 << 62, 1.0

    def search(self, queries: DataFrame, quota: int) -> DataFrame:
        """Rows (query_id, rank, id, score) for queries (id, vector)."""
        asked = saved(queries.mapInArrow(_blocks(QUERIES), "dim int, query_ids binary, queries binary"))
        spark = queries.sparkSession
        count = max(self.shards.count(), 1)
        parts = max(min(count, 2 * spark.sparkContext.defaultParallelism), count // PER_PART)
        left = self.shards.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int"))
        right = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        pairs = left.join(right, ["part", "dim"]).select(*_COLUMNS, "query_ids", "queries")
        found = pairs.mapInArrow(_search(self.k, quota, self.seed), "query_id long, id long, score double")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= self.k)
        return ranked.select("query_id", "rank", "id", "score")


def grown(vectors: DataFrame, k: int, seed: int = 0) -> Forest:
    """The forest of rows (id, vector). Rows of one vector are one entry with its k + 1 smallest ids: no other of them can
    be among the k nearest of any row, so a vector that very many rows hold costs no more than any other."""
    order = Window.partitionBy("vector").orderBy("id")
    firsts = vectors.withColumn("n", F.dense_rank().over(order)).filter(F.col("n") <= k + 1)
    entries = saved(firsts.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids")))
    numbers = entries.agg(F.sum(F.size("vector"))).first()[0] or 0
    parts = max(1, -(-8 * numbers // SHARD_BYTES))
    pack = _pack(seed)

    def packed(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(pack(iter(table.combine_chunks().to_batches()))))

    # Shards follow from the size of the data, not from partitions; a group is one shard's vectors.
    dealt = entries.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(int(parts))))
    return Forest(saved(dealt.groupBy("part").applyInArrow(packed, _SHARD)), k, seed)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    recall: float = RECALL,
    seed: int = 0,
) -> DataFrame:
    """Rows (query_id, rank, id, score): the k rows of the largest inner product found for each query, ties to the smaller id.

    Scores are sums over the original vectors in double precision. A row never meets rows of its own id. Rows without id,
    and vectors that are null, empty or zero or hold a null or non-finite component, take no part; vectors of different
    length never meet. Repeated rows count once; an id with several vectors asks with the smallest.
    """

    def named(df: DataFrame) -> DataFrame:
        rows = df.select(
            F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
        )
        return rows.filter(F.col("id").isNotNull() & usable("vector"))

    asked = saved(named(queries).groupBy("id").agg(F.min("vector").alias("vector")))
    forest = grown(named(vectors), k, seed)
    return forest.search(asked, forest.quota(asked, recall)[0])
