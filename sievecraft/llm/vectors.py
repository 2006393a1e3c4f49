"""Exact top-k inner products over a vector-approximation file.

The file holds, block by block, an 8-bit cell number per component beside the exact vectors. A query scans the cells,
which bound its score with every vector from both sides; it then reads exact vectors in the order of their bounds until
no unread one can be among its k best. Blocks of queries meet blocks of vectors; each pair gives k rows per query, and
the best of those are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sievecraft.llm.common import saved

BLOCK = 4096  # vectors of one block
QUERIES = 1024  # queries of one block
PER_PART = 64  # blocks of vectors that a copy of the queries is sent to, once there are many
LEVELS = 255
FIRST_READ = 64  # exact vectors read at first; doubled each time

_FILE = "dim int, ids binary, low binary, step binary, cells binary, exact binary"


def integer_vectors(column: pa.Array, scale: float):
    """For each length among them: rows that hold a vector of finite numbers, and floor(scale * x) as a matrix."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    raw = column.values
    values = raw.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    sizes = np.diff(offsets)
    good = (bad[offsets[1:]] == bad[offsets[:-1]]) & (sizes > 0)
    good &= column.is_valid().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[good]).tolist():
        rows = np.flatnonzero(good & (sizes == size))
        yield rows, np.floor(scale * values[offsets[rows][:, None] + np.arange(size)])


def _pack(rows: int, scale: float):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(size: int, ids: np.ndarray, exact: np.ndarray) -> pa.RecordBatch:
            low = exact.min(axis=0)
            step = np.maximum((exact.max(axis=0) - low) / LEVELS, 1e-300)
            cells = np.clip(np.floor((exact - low) / step), 0, LEVELS).astype(np.uint8)
            data = (ids.astype(np.int64), low, step, cells, exact)
            return pa.RecordBatch.from_arrays(
                [pa.array([size], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in data)],
                names=["dim", "ids", "low", "step", "cells", "exact"],
            )

        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for picked, exact in integer_vectors(batch.column("vector"), scale):
                size = exact.shape[1]
                parts = waiting.setdefault(size, [])
                parts.append((ids[picked], exact))
                if sum(len(x) for x, _ in parts) >= rows:
                    ids_, exact_ = (np.concatenate(x) for x in zip(*waiting.pop(size)))
                    for at in range(0, len(ids_), rows):
                        yield block(size, ids_[at : at + rows], exact_[at : at + rows])
        for size, parts in waiting.items():
            ids_, exact_ = (np.concatenate(x) for x in zip(*parts))
            for at in range(0, len(ids_), rows):
                yield block(size, ids_[at : at + rows], exact_[at : at + rows])

    return pack


def block_best(ids, low, step, cells, exact, query_ids, queries, k: int):
    """Query number, id and score of the k best of one block for each query; ties to the smaller id."""
    middle = low + (cells + 0.5) * step
    slack = np.abs(queries) @ (step * 0.5) + 1.0  # 1: far above the rounding of these sums
    scores = queries @ middle.T
    own = np.searchsorted(ids[(order := np.argsort(ids, kind="stable"))], query_ids)
    own_to = np.searchsorted(ids[order], query_ids, side="right")
    number, found, value = [], [], []
    for q in range(len(queries)):
        upper = scores[q] + slack[q]
        upper[order[own[q] : own_to[q]]] = -np.inf
        least = min(k, len(ids))
        certain = np.partition(upper, len(ids) - least)[len(ids) - least] - 2 * slack[q]
        near = np.flatnonzero((upper >= certain) & (upper > -np.inf))
        near = near[np.argsort(-upper[near], kind="stable")]
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        at, read = 0, FIRST_READ
        while at < len(near) and (len(best) < k or upper[near[at]] >= best[-1]):
            part = near[at : at + read]
            best_ids = np.concatenate([best_ids, ids[part]])
            best = np.concatenate([best, exact[part] @ queries[q]])
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
            at, read = at + read, read * 2
        number.append(np.full(len(best), q))
        found.append(best_ids)
        value.append(best)
    return np.concatenate(number), np.concatenate(found), np.concatenate(value).astype(np.int64)


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name: batch.column(name)[row].as_py()
                size = get("dim")
                ids = np.frombuffer(get("ids"), np.int64)
                query_ids = np.frombuffer(get("query_ids"), np.int64)
                number, found, value = block_best(
                    ids,
                    np.frombuffer(get("low")),
                    np.frombuffer(get("step")),
                    np.frombuffer(get("cells"), np.uint8).reshape(-1, size),
                    np.frombuffer(get("exact")).reshape(-1, size),
                    query_ids,
                    np.frombuffer(get("queries")).reshape(-1, size),
                    k,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[number]), pa.array(found), pa.array(value)],
                    names=["query_id", "id", "score"],
                )

    return search


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """Rows (query_id, rank, id, score): the k highest integer inner products of each query, ties to the smaller id.

    Components are floor(scale * x) of x as double; sums are exact below 2^53. A row never meets rows of its own id.
    Rows without id or vector, or with a null or non-finite component, take no part, nor do empty vectors; vectors of
    different length never meet. Repeated rows count each by themselves as candidates, once as queries.
    """

    def packed(df: DataFrame, rows: int) -> DataFrame:
        named = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
        return saved(named.filter("id IS NOT NULL AND vector IS NOT NULL").mapInArrow(_pack(rows, scale), _FILE))

    spark = vectors.sparkSession
    file = packed(vectors, BLOCK)
    asked = packed(queries.dropDuplicates([id_column]), QUERIES).select(
        "dim", F.col("ids").alias("query_ids"), F.col("exact").alias("queries")
    )
    blocks = max(file.count(), 1)
    parts = max(min(blocks, 2 * spark.sparkContext.defaultParallelism), blocks // PER_PART)
    left = file.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int"))
    right = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    pairs = left.join(right, ["part", "dim"]).select(*left.drop("part").columns, "query_ids", "queries")
    found = pairs.mapInArrow(_search(k), "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score"
    )
