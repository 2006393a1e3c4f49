"""Languages by content, against a plain count."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sievecraft.functions.text import changed_files
from sievecraft.operators import joins, languages

TOKEN = re.compile(r"[^\W\d]\w*|[^\s\w]")


def thousandths(x):
    scaled = math.log(x) * 1000
    return int(math.copysign(math.floor(abs(scaled) + 0.5), scaled))


def brute(taught, files):
    sizes, counts = Counter(), defaultdict(Counter)
    for name, text in taught:
        if name not in (None, "unknown") and text is not None:
            sizes[name] += 1
            counts[name].update(set(TOKEN.findall(text)))
    known = {token for one in counts.values() for token in one}
    out = {}
    for key, text in files:
        tokens = set(TOKEN.findall(text or "")) & known
        if tokens:
            scores = {
                name: thousandths(n / sum(sizes.values()))
                + sum(thousandths((counts[name][token] + 1) / (n + 2)) for token in tokens)
                for name, n in sizes.items()
            }
            out[key] = min(scores, key=lambda name: (-scores[name], name))
    return out


def corpus(seed):
    random_ = random.Random(seed)
    words = {"go": "func := range { }", "python": "def : import self", "rust": "fn let mut { } ;"}
    rows = []
    for k in range(200):
        name = random_.choice([*words])
        text = " ".join(random_.choice((words[name] + " x y é 12").split()) for _ in range(random_.randrange(8)))
        rows.append((k, name if k % 4 else random_.choice((None, "unknown")), text if k % 31 else None))
    return rows


@pytest.mark.parametrize("broadcast_rows", [joins.BROADCAST_ROWS, 0])
def test_like_the_count(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(joins.small_row_count, "__defaults__", (broadcast_rows, joins.BROADCAST_BYTES))
    rows = corpus(5)
    df = spark.createDataFrame(rows, "key int, language string, content string").repartition(3)
    model = languages.learned(df)
    found = {r["key"]: r["language"] for r in languages.guessed_languages(df, model, "key").collect()}
    assert found == brute([row[1:] for row in rows], [(k, text) for k, _, text in rows])


def test_by_name_else_by_content(spark):
    rows = [
        (1, "a.py", "def f(self):"), (2, "b.py", "import self"), (3, "c.go", "func f() {"), (4, "d.go", "x := range y"),
        (5, "script", "def g(self):"), (6, "odd.zz9", "func := {"), (7, "empty", ""), (8, "none", None), (9, "new", "qqq"),
        (10, "e.go", "def self import"),
    ]
    df = spark.createDataFrame(rows, "key int, file string, content string")
    found = {r["key"]: r["language"] for r in languages.with_languages(df, "key").collect()}
    assert found == {
        1: "python", 2: "python", 3: "go", 4: "go", 5: "python", 6: "go", 7: "unknown", 8: "unknown", 9: "unknown", 10: "go",
    }
    unnamed = df.filter("key > 4 AND key < 10")
    assert {r["language"] for r in languages.with_languages(unnamed, "key").collect()} == {"unknown"}
    assert languages.with_languages(df.limit(0), "key").count() == 0


def test_sections(spark):
    diff = "\n".join([
        "diff --git a/x.py b/x.py", "--- a/x.py", "+++ b/x.py", "@@ -1 +1,2 @@", " kept", "-gone", "+one", "+two",
        "diff --git a/y b/y", "--- a/y", "+++ /dev/null", "-all", "diff --git a/z.go b/z.go", "+++ b/z.go", "+", "+++ more", "",
    ])
    df = spark.createDataFrame([(1, diff), (2, ""), (3, None), (4, "+++ b/last")], "key int, diff string")
    found = [tuple(r) for r in languages.file_sections(df).collect()]
    assert sorted(found) == [(1, 0, "x.py", "one\ntwo"), (1, 1, "z.go", ""), (4, 0, "last", "")]
    listed = df.select("key", F.explode(changed_files(F.col("diff"))).alias("file"))
    assert sorted((x[0], x[2]) for x in found) == sorted(tuple(r) for r in listed.collect())


def test_held_out_files(spark):
    """Of the invented languages' files, those not learned from are told apart by content."""
    from workloads.queries import QUERIES

    rows = [r for r in QUERIES["content_languages"](spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    named = [r for r in rows if r["named"] != "unknown"]
    assert len(named) > 100
    assert sum(r["guess"] == r["named"] for r in named) >= 0.97 * len(named)


def test_guesses_add_up_once_and_read_no_file_twice(spark, monkeypatch):
    """One row for each file and token is aggregated; frequent tokens come from the model, not from a pass over the files."""
    from sievecraft.operators import joins

    def refuse(*_):
        raise AssertionError("a pass over the files")

    monkeypatch.setattr(joins, "hot_keys_of", refuse)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "small_row_count", lambda *_: None)
    rows = [(k, f"a{k}", "py" if k % 2 else "go", f"same {'def' if k % 2 else 'func'} w{k}") for k in range(40)]
    files = spark.createDataFrame(rows, "key int, file string, language string, content string")
    model = languages.learned(files)
    assert set(model.frequent) >= {"same", "def", "func"}
    guesses = languages.guessed_languages(files, model, "key")
    assert {r["key"]: r["language"] for r in guesses.collect()} == {k: lang for k, _, lang, _ in rows}
    plan = guesses._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan.split("InMemoryRelation")[0] and plan.split("InMemoryRelation")[0].count("Aggregate") == 1
