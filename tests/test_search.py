"""Exact search for many needles, and identities of any lineage in any text."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sievecraft.operators import guards, joins, search


def found(spark, texts, needles):
    rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "id int, text string, anchor string")
    wanted = spark.createDataFrame([(n, 1) for n in needles], "needle string, size int")
    pairs = search.found_needles(rows.repartition(3), wanted.repartition(3))
    return sorted((r["id"], r["needle"]) for r in pairs.collect())


def expected(texts, needles):
    return sorted((k, n) for k, t in enumerate(texts) for n in {n for n in needles if n} if t and n in t)


def pool(seed, alphabet):
    """Texts, and needles of all sizes: pieces of texts, pieces with one change, others."""
    random_ = random.Random(seed)
    texts = ["".join(random_.choice(alphabet) for _ in range(random_.choice((0, 3, 30, 300, 900)))) for _ in range(40)]
    needles = []
    for size in (*range(1, 20), 39, 40, 41, 64, 130):
        for _ in range(4):
            text = random_.choice([t for t in texts if len(t) >= size])
            at = random_.randrange(len(text) - size + 1)
            needles.append(text[at : at + size])
            place = random_.randrange(size)
            needles.append(needles[-1][:place] + random_.choice(alphabet) + needles[-1][place + 1 :])
    return texts, needles


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij /.@", "aé漢🎉 "])
@pytest.mark.parametrize("broadcast_rows", [joins.BROADCAST_ROWS, 0])
def test_like_the_definition(spark, monkeypatch, alphabet, broadcast_rows):
    monkeypatch.setattr(joins.small_row_count, "__defaults__", (broadcast_rows, joins.BROADCAST_BYTES))
    texts, needles = pool(len(alphabet), alphabet)
    texts += [None, "", "x" * 100, "xx", "y" + "x" * 50 + "y"]
    needles += [None, "", "x" * 7, "x" * 8, "x" * 16, "x" * 40, "x" * 100, "x" * 101]
    assert found(spark, texts, needles) == expected(texts, needles)


def test_a_full_filter_costs_no_result(spark, monkeypatch):
    monkeypatch.setattr(search, "FILTER_BITS", 64)
    texts, needles = pool(9, "abcdefgh")
    assert found(spark, texts, needles) == expected(texts, needles)


def test_filter_grows_with_the_needles(spark, monkeypatch):
    """Few anchors that no needle has leave the texts, however many needles there are."""
    monkeypatch.setattr(search, "FILTER_BITS", 64)
    random_, sent = random.Random(8), []
    text = lambda size: "".join(random_.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size))

    def spy(emitted, *others):
        sent.append(emitted.count())
        return joins.lookup_join(emitted, *others)

    monkeypatch.setattr(search, "lookup_join", spy)
    texts, needles = [text(2000) for _ in range(20)], [text(40) for _ in range(3000)]
    texts[3] += needles[7]
    assert found(spark, texts, needles) == [(3, needles[7])]
    assert 1 <= sent[0] < 300  # of some 13,000
    assert [search.filter_bits(n) for n in (1, 3 << 20, 1 << 40)] == [64, 1 << 26, search.MOST_FILTER_BITS]


def test_needles_that_begin_alike_are_filed_apart(spark):
    """Long shared beginnings and ends are no place to look needles up by."""
    needles = spark.range(2_000).select(F.format_string("/srv/repositories/of/the/team/%05d/checkout", "id").alias("needle"))
    options = needles.mapInArrow(search._needle_anchors(), "needle string, class int, anchor long, before int, size int")
    shared = options.groupBy("anchor").count()
    best = options.join(shared, "anchor").groupBy("needle").agg(F.min("count").alias("n"))
    assert best.agg(F.max("n")).first()[0] <= 50


def test_empty_sides(spark):
    assert found(spark, [], ["a"]) == []
    assert found(spark, ["a"], []) == []
    assert found(spark, ["a"], [None, ""]) == []


def test_other_keys_and_a_text_longer_than_a_slice(spark):
    big = "ab " * 600_000 + "needle of some length"
    rows = spark.createDataFrame([("k", big), ("l", "x")], "name string, body string")
    wanted = spark.createDataFrame([("needle of some length",), ("ab ab ab ab ab ab",)], "what string")
    pairs = search.found_needles(rows, wanted, "name", "body", "what").collect()
    assert sorted(tuple(r) for r in pairs) == [("k", "ab ab ab ab ab ab"), ("k", "needle of some length")]


CANDIDATES = [
    ("1", "fix a bug", "+by OTHER@Example.com\n+in /srv/two"),
    ("2", "me@example.com did it", "+nothing"),
    ("3", None, None),
    ("4", "x" + "ab" * 20, "git@h:two.git"),
    ("5", "straSSE@x.org", ""),
]
LINEAGE = [
    ("1", "/srv/one", ["git@h:one.git"], "ab" * 20, " Me@Example.com "),
    ("2", "/srv/two", ["git@h:two.git", ""], "cd" * 20, "other@example.com"),
    ("4", "", None, None, None),
    ("5", "/srv/two/deep", ["git@h:two.git"], "ef" * 20, "Straße@x.org"),
    ("gone", "/srv", [], "00" * 20, "e@example.com"),
]


def shown(spark):
    rows = spark.createDataFrame(CANDIDATES, "id string, subject string, diff string")
    lineage = spark.createDataFrame(
        LINEAGE, "id string, repository_path string, remote_urls array<string>, commit_sha string, author_email string"
    )
    return guards.shown_identities(rows, lineage)


def test_identities_of_all_lineages(spark):
    assert sorted(tuple(r) for r in shown(spark).collect()) == [
        ("1", "author_email", "other@example.com", False),
        ("1", "repository_path", "/srv", False),
        ("1", "repository_path", "/srv/two", False),
        ("2", "author_email", "e@example.com", False),
        ("2", "author_email", "me@example.com", False),
        ("4", "commit_sha", "ab" * 20, False),
        ("4", "remote_url", "git@h:two.git", False),
        ("5", "author_email", "strasse@x.org", True),
    ]


def test_identity_counts(spark):
    counts = guards.shown_identity_counts(shown(spark)).collect()
    assert sorted(tuple(r) for r in counts) == [
        ("author_email", 3, 2, 4),
        ("commit_sha", 1, 1, 1),
        ("remote_url", 1, 1, 1),
        ("repository_path", 1, 1, 2),
    ]


def test_texts_are_not_shuffled(spark):
    plan = shown(spark)._jdf.queryExecution().optimizedPlan().toString()
    rows = spark.createDataFrame(CANDIDATES, "id string, subject string, diff string")
    texts = search.found_needles(rows.select("id", F.col("diff").alias("text")), spark.createDataFrame([("a",)], "needle string"))
    physical = texts._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan + physical and "Cartesian" not in plan + physical
    lines = physical.splitlines()
    indent = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(k for k, line in enumerate(lines) if "MapInArrow" in line and "around" in line)
    end = next((k for k in range(at + 1, len(lines)) if indent(lines[k]) <= indent(lines[at])), len(lines))
    assert any("Scan" in line for line in lines[at:end]) and not any("Exchange" in line for line in lines[at:end])
