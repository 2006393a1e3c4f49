from __future__ import annotations

import math
import random

import numpy as np
import pytest

from sievecraft.llm import forest


def brute(rows, asked, k):
    """(query, rank, id, score) by comparing all; an id with several vectors asks with the smallest."""

    def fit(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = sorted({(n, tuple(v)) for n, v in rows if n is not None and fit(v)})
    out = []
    for number in sorted({n for n, _ in good if asked(n)}):
        v = next(x for n, x in good if n == number)
        found = [(-float(np.dot(v, x)), n) for n, x in good if n != number and len(x) == len(v)]
        out += [(number, rank, n, -s) for rank, (s, n) in enumerate(sorted(found)[:k], 1)]
    return out


def answered(spark, rows, **options):
    table = spark.createDataFrame(
        [(*row, 0, 1, "r") for row in rows], "vec_id long, embedding array<double>, id int, part int, rank string"
    ).repartition(5)
    found = forest.nearest(table, table.filter("vec_id % 5 = 0"), 4, **options)
    return sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in found.collect())


@pytest.mark.parametrize("shard_bytes", [1 << 23, 8 * 8 * 11])
def test_full_recall_is_brute_force(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(forest, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(forest, "QUERIES", 7)
    random_ = random.Random(8)
    rows = [(k, [random_.gauss(0, 1) for _ in range(8)]) for k in range(90)]
    rows += [(100 + k, [0.5] * 8) for k in range(40)]  # one vector in many rows
    rows += [(200, None), (205, []), (210, [1.0, None] * 4), (215, [math.nan] + [1.0] * 7), (220, [math.inf] + [1.0] * 7)]
    rows += [(225, [0.0] * 8), (230, [0.5, 2.0]), (235, [0.25, -1.0]), (None, [1.0] * 8), (240, [1e3] * 8), (245, [3.0])]
    rows += [(5, rows[5][1]), (10, [9.0] * 8)]  # a repeated row; an id of two vectors
    want = brute(rows, lambda n: n % 5 == 0, 4)
    got = answered(spark, rows, recall=1.0)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=1e-12)


def test_few_candidates_and_empty_tables(spark):
    assert answered(spark, [(5, [1.0, 2.0]), (6, [2.0, 1.0])]) == [(5, 1, 6, 4.0)]
    assert answered(spark, [(5, [1.0, 2.0])]) == []
    assert answered(spark, [(6, [1.0, 2.0]), (7, [1.0, 3.0])]) == []
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert forest.nearest(table, table, 5).count() == 0


def recall_and_share(spark, vectors):
    """Recall of the 20 nearest that the forest measures, that against brute force, and the share of vectors scored."""
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "id long, vector array<double>").repartition(4)
    asked = table.filter("id % 20 = 0")
    tree = forest.grown(table, 20, 0)
    quota, recall = tree.quota(asked)
    got = {}
    for row in tree.search(asked, quota).collect():
        got.setdefault(row["query_id"], set()).add(row["id"])
    scores = vectors[::20] @ vectors.T
    hits = 0
    for k, row in enumerate(scores):
        row[20 * k] = -np.inf
        hits += len(got[20 * k] & set(np.argsort(-row)[:20].tolist()))
    shard = next(forest._shards(tree.shards.toArrow().to_batches()[0]))[1]
    strings = forest.hash_strings(forest.lengthened(vectors[::20], None), 0)
    scored = np.mean([len(x) for x in shard.candidates(strings, quota)])
    return recall, hits / (20 * len(scores)), scored / len(shard.exact)


def test_recall_over_random_vectors(spark):
    """The hardest case: no cluster to be found, and lengths matter."""
    random_ = np.random.default_rng(5)
    vectors = random_.normal(size=(3000, 48)) * random_.uniform(0.5, 1.5, (3000, 1))
    measured, true, _ = recall_and_share(spark, vectors)
    assert measured >= 0.96 and true == pytest.approx(measured)


def test_clusters_need_few_candidates(spark):
    random_ = np.random.default_rng(6)
    vectors = random_.normal(size=(100, 48))[np.arange(3000) % 100] + 0.3 * random_.normal(size=(3000, 48))
    measured, true, share = recall_and_share(spark, vectors)
    assert measured >= 0.96 and true == pytest.approx(measured) and share < 0.25


def test_ascent_by_bisection_is_the_ascent():
    random_ = np.random.default_rng(1)
    strings = random_.integers(0, 1 << 12, (5, 300)).astype(np.uint32)
    asked = random_.integers(0, 1 << 12, (5, 9)).astype(np.uint32)
    level = forest.stop_level(np.sort(strings, axis=1), asked, 20, 12)
    for q in range(9):
        common = np.array([12 - int(x).bit_length() for x in (strings ^ asked[:, q : q + 1]).ravel()])
        climb = 12
        while climb and (common >= climb).sum() < 20:
            climb -= 1
        assert level[q] == climb


def test_sample_bounds_what_the_driver_gets(spark, monkeypatch):
    """The quota of a sample of two queries still serves all."""
    rows = [(5 * k, [math.cos(k), math.sin(k), k / 50]) for k in range(60)]
    monkeypatch.setattr(forest, "SAMPLE", 2)
    got = answered(spark, rows)
    assert len(got) == 60 * 4 and {x[1] for x in got} == {1, 2, 3, 4}
