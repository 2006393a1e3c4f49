"""Glob patterns as a table, against Python's own translation of globs."""

from __future__ import annotations

import fnmatch
import random
import re

import pytest
from pyspark.sql import functions as F

from sievecraft.functions.paths import glob_regex
from sievecraft.operators import joins, patterns
from sievecraft.plans.scan import with_status

ALPHABET = "ab/.-é[]!*?ß"


def random_texts(number, seed, alphabet=ALPHABET, longest=14):
    random_ = random.Random(seed)
    return ["".join(random_.choice(alphabet) for _ in range(random_.randrange(longest))) for _ in range(number)]


def matches(value, glob):
    return re.match(fnmatch.translate(glob.casefold()), value.casefold()) is not None


def found(spark, values, globs):
    left = spark.createDataFrame([(k, v, "x") for k, v in enumerate(values)], "key int, value string, size string")
    right = spark.createDataFrame([(g, 1) for g in globs], "pattern string, gram int")
    rows = patterns.glob_matches(left.repartition(3), right.repartition(3)).collect()
    assert all(r["size"] == "x" for r in rows)
    return sorted((r["key"], r["pattern"]) for r in rows)


def expected(values, globs):
    return sorted(
        (k, g) for k, v in enumerate(values) if v is not None for g in {g for g in globs if g is not None} if matches(v, g)
    )


GLOBS = [
    "*", "", "?", "??", "[a-b]*", "[!a]?", "[b-a]", "[]a]*", "[", "a[", "*.MIN.js", "*/Build/*", "*ss*", "src/*/test_?.py",
    "**a**b**", "node_modules", "*node_modules*", "[a-c][!x-z]", "*\n*", "a\x00b", "[\\d]*", "{a}", "é*", None, "*.min.js",
]
VALUES = [
    "", "a", "ab", "ba", "src/x/test_1.py", "SRC/y/z/TEST_2.PY", "lib/app.min.js", "x/build/y", "straße", "STRASSE", "[",
    "a[", "]a", "node_modules", "my/node_modules/x", None, "two\nlines", "a\x00b", "\\d", "{a}", "É tude", "a" * 3000 + "b",
]


@pytest.mark.parametrize("broadcast_rows", [joins.BROADCAST_ROWS, 0])
def test_like_the_definition(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(joins.small_row_count, "__defaults__", (broadcast_rows, joins.BROADCAST_BYTES))
    values, globs = VALUES + random_texts(150, 1), GLOBS + random_texts(60, 2, longest=7)
    assert found(spark, values, globs) == expected(values, globs)


def test_regex_of_a_column_is_that_of_the_list(spark):
    globs = [g for g in GLOBS if g is not None] + random_texts(300, 3) + ["🎉[🎈-🎉]x"]
    rows = spark.createDataFrame([(g,) for g in globs], "glob string")
    made = {r[0]: r[1] for r in rows.select("glob", patterns.glob_column_regex(F.col("glob"))).collect()}
    assert {g: made[g].lower().replace(r"\a", r"\a(?:", 1)[:-2] + r")\z" for g in globs} == {
        g: glob_regex([g]).lower() for g in globs
    }


def test_empty_sides(spark):
    assert found(spark, [], ["*"]) == []
    assert found(spark, ["a", None], []) == []
    assert found(spark, ["a"], [None]) == []


def test_reserved_names_are_an_error(spark):
    rows = spark.createDataFrame([("a", "b")], "value string, gram string")
    with pytest.raises(ValueError):
        patterns.glob_matches(rows, spark.createDataFrame([("a",)], "pattern string"))


def test_thousands_of_patterns_without_a_nested_loop(spark):
    """Each value meets the patterns of its own rarest grams only."""
    globs = spark.range(20_000).select(F.format_string("*/team%05d/repo?", "id").alias("pattern"))
    values = spark.range(3_000).select("id", F.format_string("/srv/team%05d/repo%d", F.col("id") * 7, F.col("id") % 12).alias("value"))
    pairs = patterns.glob_matches(values, globs)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    rows = pairs.collect()
    assert {r["id"] for r in rows} == {k for k in range(3_000) if k * 7 < 20_000 and k % 12 < 10}


def test_patterns_are_filed_under_rare_grams(spark):
    """A literal part that all values hold is not what a pattern is looked up by."""
    values = spark.range(500).select(F.format_string("https://host/%06d", "id").alias("value"))
    globs = spark.range(50).select(F.format_string("https://*/%06d", "id").alias("pattern"))
    options = patterns._filed(globs, "pattern")
    assert {r["size"] for r in options.select("size").collect()} == {8}
    pairs = patterns.glob_matches(values, globs)
    assert pairs.count() == 50


def test_status_by_tables_and_by_lists(spark):
    rows = [
        ("/srv/a/one", ["git@h.org:t/One.git"], False),
        ("/srv/a/two", ["https://h.org/t/two"], True),
        ("/srv/b/three", None, True),
        ("/srv/b/four", ["https://x.net/q"], False),
    ]
    repositories = spark.createDataFrame(rows, "path string, remotes array<string>, shallow boolean")
    paths, remotes = ["B/thr*", "two"], ["x.net/*", "h.org/t/ON?"]

    def table(globs):
        return spark.createDataFrame([(g,) for g in globs], "pattern string")

    want = sorted(tuple(r) for r in with_status(repositories, ["/srv"], paths, remotes).select("path", "shallow", "status").collect())
    for first, second in ((table(paths), table(remotes)), (table(paths), remotes), (paths, table(remotes))):
        status = with_status(repositories, ["/srv"], first, second)
        assert status.columns == ["path", "remotes", "shallow", "status"]
        assert sorted(tuple(r) for r in status.select("path", "shallow", "status").collect()) == want
    assert {r[2] for r in want} == {"ignored_path", "ignored_remote"}
    none = with_status(repositories, ["/srv"], table([]), table([])).select("status").distinct().collect()
    assert [r[0] for r in none] == ["included"]
