from __future__ import annotations

import math
import random

import pytest

from sievecraft.llm import vectors


def brute(rows, asked, k):
    def whole(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]

    good = [(number, v) for number, v in ((n, whole(v)) for n, v in rows if n is not None) if v]
    out = []
    for number in sorted({n for n, _ in good if asked(n)}):
        v = next(x for n, x in good if n == number)
        found = [(-sum(a * b for a, b in zip(v, x)), n) for n, x in good if n != number and len(x) == len(v)]
        out += [(number, rank, n, -s) for rank, (s, n) in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.mark.parametrize("block", [4096, 7])
def test_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "QUERIES", 3)
    monkeypatch.setattr(vectors, "FIRST_READ", 2)
    random_ = random.Random(4)
    rows = [(k, [random_.gauss(0, 0.4) for _ in range(8)]) for k in range(80)]
    rows += [(80 + k, [0.25] * 8) for k in range(30)]  # ties
    rows += [(200, None), (205, []), (210, [1.0, None] * 4), (215, [math.nan] + [0.0] * 7), (220, [math.inf] + [1.0] * 7)]
    rows += [(225, [0.5, 0.5]), (230, [0.1, -0.9]), (None, [1.0] * 8), (235, [0.0] * 8), (240, [1e3] * 8)]
    rows += [(4, rows[4][1])]
    table = spark.createDataFrame([(*row, 0, 1) for row in rows], "vec_id long, embedding array<double>, id int, part int")
    table = table.repartition(4)
    found = vectors.exact_top_k(table, table.filter("vec_id % 5 = 0"), 5).collect()
    got = sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in found)
    assert got == brute(rows, lambda n: n % 5 == 0, 5)


def test_empty_table(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.exact_top_k(table, table, 5).count() == 0


def test_most_vectors_are_not_read():
    """Bounds from the cells decide most candidates."""
    import numpy as np

    random_ = np.random.default_rng(0)
    exact = np.floor(random_.normal(0, 32, (2000, 64)))
    low = exact.min(axis=0)
    step = (exact.max(axis=0) - low) / vectors.LEVELS
    cells = np.clip(np.floor((exact - low) / step), 0, vectors.LEVELS).astype(np.uint8)

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            Counted.read += len(key)
            return np.asarray(self)[key]

    _, found, score = vectors.block_best(
        np.arange(2000), low, step, cells, exact.view(Counted), np.array([5]), exact[5:6], 5
    )
    want = np.argsort(-(np.asarray(exact) @ exact[5]), kind="stable")[1:6]
    assert found.tolist() == want.tolist()
    assert Counted.read <= 200
