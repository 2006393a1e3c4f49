"""Scan and candidate build on literal rows."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row, functions as F

from sievecraft import DataQualityError, build_candidates, scan_history, write_build
from sievecraft.operators import changes as change_ops, guards, joins
from sievecraft.plans import candidates as plan
from sievecraft.schemas import CANDIDATES, PROVENANCE
from sievecraft.sources import readers, writers

ME = "mira.holt@lab.test"
DIFF = "diff --git a/src/q b/src/q\n--- a/src/q\n+++ b/src/q\n@@ -4 +4,2 @@\n kept\n+\tindented\t \n"

# subject, e-mail, number of parents, numstat entries, reason
CASES = [
    ("Parse dates with offsets", ME, 0, ["7\t2\tsrc/dates.rs"], None),
    ("fixup! Parse dates with offsets", ME, 1, ["1\t1\tsrc/dates.rs"], "fixup"),
    ("Bump 14 packages", "robot@ci.test", 1, ["9\t9\tdeps.lock"], "author_not_matched"),
    ("Publish the manual", ME, 1, ["55\t0\tdist/manual/index.html"], "generated_only"),
    ("New icon", ME, 1, ["-\t-\tart/icon.ico"], "binary"),
    ("Trigger the nightly run", ME, 1, [], "empty_change"),
    ("Cache the lookup", "\tMira.Holt@LAB.test ", 1, ["3\t3\tsrc/cache.rs"], None),
    ("Split the parser", ME, 1, ["20\t5\tsrc/parser.rs", "1\t0\tdist/p.js"], None),
    ("Bring in release 3", ME, 2, ["4\t0\tnotes"], "merge"),
    (" \t\u3000", ME, 1, ["4\t0\tnotes"], "empty_subject"),
    ("Bring in the mirror", "robot@ci.test", 2, ["4\t0\tnotes"], "author_not_matched"),
    ("Ship fonts", ME, 1, ["-\t-\tdist/serif.woff"], "binary"),
    ("", ME, 2, [], "merge"),
    ("squash! Cache the lookup", ME, 1, [], "fixup"),
]
REASONS = {case[0]: case[4] for case in CASES}


@pytest.fixture
def commits(spark):
    rows = [
        Row(
            repository_path="/srv/one",
            commit_sha=f"{place:040x}",
            parents=[f"{n}" for n in range(parents)],
            subject=subject,
            author_name="Name",
            author_email=email,
            committed_at="2024-01-01T01:30:00+02:00",
            diff=DIFF,
            numstat="\0".join([*entries, ""]),
        )
        for place, (subject, email, parents, entries, _) in enumerate(CASES)
    ]
    return spark.createDataFrame(
        rows,
        "repository_path string, commit_sha string, parents array<string>, subject string,"
        "author_name string, author_email string, committed_at string, diff string, numstat string",
    )


@pytest.fixture
def repositories(spark):
    return spark.createDataFrame(
        [("/srv/one", ["git@h.com:a/b.git", "", "git@h.com:a/b.git"], False, "included")],
        "path string, remotes array<string>, shallow boolean, status string",
    )


def _split_changes(commits):
    return commits.drop("numstat"), change_ops.parse_numstat(
        commits.select("repository_path", "commit_sha", "numstat")
    )


@pytest.mark.parametrize("form", ["inline", "table"])
@pytest.mark.parametrize("allow", ["list", "table"])
def test_rejection_cascade(spark, commits, repositories, form, allow):
    allowed = [f" {ME.upper()}"]
    if allow == "table":
        allowed = spark.createDataFrame([(f" {ME.upper()}",), (" ",)], "author_email string")
    if form == "inline":
        build = build_candidates(repositories, commits, allowed)
    else:
        rest, changes = _split_changes(commits)
        build = build_candidates(repositories, rest, allowed, changes)
    decided = build.decided.join(commits.select("commit_sha", F.col("subject").alias("raw")), "commit_sha")
    assert {row["raw"]: row["reason"] for row in decided.collect()} == REASONS
    counts = {row["reason"]: row["rejected"] for row in build.rejections.collect()}
    assert counts == {
        "author_not_matched": 2, "binary": 2, "empty_change": 1, "empty_subject": 1, "fixup": 2,
        "generated_only": 1, "merge": 2,
    }
    assert [row["reason"] for row in build.rejections.collect()] == sorted(counts)
    totals = build.totals.first()
    assert (totals["accepted"], totals["rejected"], totals["inspected"]) == (3, 11, 14)


def test_tables_and_privacy(commits, repositories):
    build = build_candidates(repositories, commits, [ME])
    rows = [row.asDict() for row in build.candidates.collect()]
    assert build.candidates.columns == CANDIDATES.names
    assert {row["subject"] for row in rows} == {case[0] for case in CASES if case[4] is None}
    assert {row["committed_at_utc"] for row in rows} == {"2023-12-31T23:30:00Z"}
    assert all("+\tindented\t " in row["diff"].split("\n") for row in rows)
    assert len({row["patch_id"] for row in rows}) == 1
    public = json.dumps(rows)
    lineage = build.provenance.collect()
    assert build.provenance.columns == PROVENANCE.names
    for row in lineage:
        assert row["remote_urls"] == ["git@h.com:a/b.git"]
        for private in (row["commit_sha"], row["repository_path"], row["author_email"], "git@h.com"):
            assert private not in public
    assert {row["id"] for row in rows} == {row["id"] for row in lineage}
    assert tuple(build.leaks.first()) == (0, 0, 0, 0)
    assert tuple(guards.identity_leaks(build.candidates, build.provenance).first()) == (0, 0, 0, 0)


def test_leaks_are_found(spark, commits, repositories):
    shown = {
        "Parse dates with offsets": "ask MIRA.holt@lab.TEST",
        "Cache the lookup": "see /srv/one/notes and git@h.com:a/b.git",
        "Split the parser": F.col("commit_sha"),
    }
    diff = F.lit(DIFF)
    for subject, text in shown.items():
        more = F.lit(text) if isinstance(text, str) else text
        diff = F.when(F.col("subject") == subject, F.concat(F.lit(DIFF + "+"), more)).otherwise(diff)
    build = build_candidates(repositories, commits.withColumn("diff", diff), [ME])
    assert tuple(build.leaks.first()) == (1, 1, 1, 1)
    plan = build.leaks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") <= 4
    assert tuple(guards.identity_leaks(build.candidates, build.provenance).first()) == (1, 1, 1, 1)


def test_blank_needles_are_in_no_text(spark):
    rows = spark.createDataFrame(
        [("s", "d", " ", "", None, ["", None]), (None, None, None, None, None, None)],
        "subject string, diff string, author_email string, repository_path string,"
        "commit_sha string, remote_urls array<string>",
    )
    assert tuple(guards.leak_counts(rows).first()) == (0, 0, 0, 0)


@pytest.mark.parametrize("allow", ["list", "table"])
def test_nulls_fail_closed(spark, commits, repositories, allow):
    allowed = [ME] if allow == "list" else spark.createDataFrame([(ME,)], "author_email string")
    first = F.col("subject") == "Parse dates with offsets"
    changed = commits.withColumn("author_email", F.when(~first, F.col("author_email")))
    build = build_candidates(repositories, changed, allowed)
    assert build.totals.first()["accepted"] == 2
    assert {r["subject"]: r["reason"] for r in build.decided.collect()}["Parse dates with offsets"] == "author_not_matched"
    changed = commits.withColumn("subject", F.when(~first, F.col("subject")))
    reasons = [row["reason"] for row in build_candidates(repositories, changed, allowed).decided.collect()]
    assert reasons.count("empty_subject") == 2
    changed = commits.withColumn("parents", F.when(~first, F.col("parents")))
    assert build_candidates(repositories, changed, allowed).totals.first()["accepted"] == 3


def test_a_commit_that_occurs_twice_is_an_error(commits, repositories):
    twice = commits.unionAll(commits.filter("subject = 'Split the parser'"))
    build = build_candidates(repositories, twice, [ME])
    for df in (build.candidates, build.provenance):
        with pytest.raises(PySparkException, match="occurs twice"):
            df.collect()


def test_ready_made_patch_ids_win(commits, repositories):
    known = commits.withColumn("patch_id", F.when(F.col("subject") == "Split the parser", "given"))
    rows = build_candidates(repositories, known, [ME]).candidates.collect()
    ids = {row["subject"]: row["patch_id"] for row in rows}
    assert ids["Split the parser"] == "given"
    assert len(ids["Parse dates with offsets"]) == 40


def test_same_commit_in_two_clones(spark, commits, repositories):
    clone = repositories.withColumn("path", F.lit("/srv/two"))
    copies = commits.withColumn("repository_path", F.lit("/srv/two"))
    build = build_candidates(repositories.union(clone), commits.union(copies), [ME])
    row = build.candidates.agg(F.count_distinct("id"), F.count_distinct("patch_id")).first()
    assert tuple(row) == (6, 1)


def test_ignored_repositories_are_left_out(commits, repositories):
    ignored = repositories.withColumn("status", F.lit("ignored_path")).withColumn(
        "shallow", F.lit(True)
    )
    assert build_candidates(ignored, commits, [ME]).totals.first()["inspected"] == 0


def test_build_errors(spark, commits, repositories):
    with pytest.raises(DataQualityError, match="1 shallow repository"):
        build_candidates(repositories.withColumn("shallow", F.lit(True)), commits, [ME])
    with pytest.raises(ValueError, match="author_emails"):
        build_candidates(repositories, commits, ["  "])
    with pytest.raises(ValueError, match="author_emails"):
        build_candidates(
            repositories, commits, spark.createDataFrame([(" ",)], "author_email string")
        )


def test_counts_and_lineage_do_not_read_diffs(spark, commits, repositories, tmp_path):
    path = str(tmp_path / "commits")
    rest, changes = _split_changes(commits)
    rest.write.parquet(path)
    build = build_candidates(repositories, spark.read.parquet(path), [ME], changes)

    def scan_schema(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [part for part in plan.split("FileScan parquet")[1:]]

    for df in (build.rejections, build.totals, build.provenance):
        assert all("diff" not in part.split("]")[0] for part in scan_schema(df))
    assert any("diff" in part.split("]")[0] for part in scan_schema(build.candidates))


@pytest.mark.parametrize("partitions", [1, 3])
def test_write_build(spark, commits, repositories, tmp_path, partitions):
    build = build_candidates(repositories, commits, [ME])
    paths = [str(tmp_path / name) for name in ("candidates", "provenance")]
    counts = write_build(build, *paths, partitions)
    assert counts["accepted"] == 3 and sum(counts.values()) == 14
    read = readers.read_candidates(spark, paths[0])
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, build.candidates.collect()))
    ids = []
    for file in sorted((tmp_path / "candidates").glob("part-*.parquet")):
        ids += [row["id"] for row in spark.read.parquet(str(file)).collect()]
        assert ".zstd." in file.name
    assert ids == sorted(ids) and len(ids) == 3
    sound = guards.lineage_integrity(read, spark.read.parquet(paths[1])).first()
    assert tuple(sound) == (3, 3, 0, 0, 0)
    assert write_build(build, *paths, partitions) == counts  # a second run replaces the first
    assert readers.read_candidates(spark, paths[0]).count() == 3
    with pytest.raises(ValueError, match="different paths"):
        write_build(build, paths[0], paths[0] + "/")


def test_order_over_files(spark, tmp_path):
    from sievecraft.functions.keys import opaque_id

    rows = spark.range(2000).select(
        opaque_id("candidate", F.col("id").cast("string")).alias("id"),
        *[F.lit("x").alias(name) for name in CANDIDATES.names[1:]],
    )
    writers.write_candidates(rows, str(tmp_path / "c"), 7)
    files = sorted((tmp_path / "c").glob("part-*.parquet"))
    assert len(files) == 7
    ids = [[r["id"] for r in spark.read.parquet(str(file)).collect()] for file in files]
    assert sum(ids, []) == sorted(sum(ids, []))
    assert max(map(len, ids)) < 2 * min(map(len, ids))


def test_size_decides_on_the_files(spark, tmp_path, monkeypatch):
    from sievecraft.functions.keys import opaque_id

    rows = spark.range(400).select(
        opaque_id("candidate", F.col("id").cast("string")).alias("id"),
        *[F.repeat(F.lit("x"), 100).alias(name) for name in CANDIDATES.names[1:]],
    )
    monkeypatch.setattr(writers, "FILE_BYTES", 50_000)
    writers.write_candidates(rows, str(tmp_path / "c"))
    assert len(list((tmp_path / "c").glob("part-*.parquet"))) == 5
    with pytest.raises(PySparkException, match="not the form of an id"):
        writers.write_candidates(rows.withColumn("id", F.expr("uuid()")), str(tmp_path / "d"))


def test_null_in_required_column(spark, tmp_path):
    row = spark.createDataFrame(
        [("candidate_" + "0" * 24, "g", "s", None, "t", "p")], ", ".join(f"{n} string" for n in CANDIDATES.names)
    )
    with pytest.raises(PySparkException, match="diff is null"):
        writers.write_candidates(row, str(tmp_path / "c"))


def test_parse_numstat(spark):
    text = "1\t2\ta b\0-\t-\tx.bin\0\0" + "3\t0\tt\tab\0-\t1\to"
    df = spark.createDataFrame([("k", text), ("e", "")], "key string, numstat string")
    rows = [tuple(row) for row in change_ops.parse_numstat(df).collect()]
    assert rows == [
        ("k", 1, 2, "a b", False),
        ("k", None, None, "x.bin", True),
        ("k", 3, 0, "t\tab", False),
        ("k", None, 1, "o", True),
    ]
    with pytest.raises(PySparkException):
        change_ops.parse_numstat(
            spark.createDataFrame([("k", "1\t2")], "key string, numstat string")
        ).collect()


def test_inline_stats_equal_the_aggregate(spark, commits):
    rest, changes = _split_changes(commits)
    by_table = change_ops.change_stats(changes)
    inline = commits.select(
        "repository_path", "commit_sha",
        change_ops.inline_change_stats(F.col("numstat")).alias("s"),
    ).select("repository_path", "commit_sha", "s.*").filter("path_count > 0")
    assert sorted(map(tuple, by_table.collect())) == sorted(map(tuple, inline.collect()))


def test_commit_log(spark, tmp_path):
    record = "p1 p2\0subject \r x\0N\0e@x\x002024-01-01T00:00:00Z"
    (tmp_path / "log").write_text(f"/srv/one\0sha1\0{record}\n/srv/one\0sha2\0\0s\0n\0e\0d\n", newline="")
    rows = readers.read_commit_log(spark, str(tmp_path / "log")).collect()
    assert rows[0]["parents"] == ["p1", "p2"] and rows[0]["subject"] == "subject \r x"
    assert rows[1]["parents"] == [] and rows[1]["committed_at"] == "d"
    (tmp_path / "bad").write_text("/srv/one\0sha1\0a\0b\0c\0d\n")
    with pytest.raises(PySparkException, match="exactly 5 fields"):
        readers.read_commit_log(spark, str(tmp_path / "bad")).collect()


def test_patches_with_bad_utf8(spark, tmp_path):
    raw = [b"+ok  \r\n", b"\xff\xc3", b"a\xe2\x82b", b"\xf0\x9f\x98"]
    path = str(tmp_path / "p")
    spark.createDataFrame([(bytearray(b),) for b in raw], "diff binary").write.parquet(path)
    got = {row["diff"] for row in readers.read_patches(spark, path).collect()}
    assert got == {b.decode("utf-8", "replace") for b in raw}


# --- scan -------------------------------------------------------------------------------------


def _commits(spark, rows):
    return spark.createDataFrame(rows, "repository_path string, author_email string")


def _repositories(spark, rows):
    return spark.createDataFrame(rows, "path string, remotes array<string>, shallow boolean")


def test_scan_counts(spark):
    found = scan_history(
        _repositories(
            spark, [("/r/first", [], False), ("/r/Second", [], False), ("/r/none", [], True)] * 2
        ),
        _commits(
            spark,
            [
                ("/r/first", ME),
                ("/r/first", f" {ME.upper()}"),
                ("/r/Second", ME),
                ("/r/Second", "  "),
            ],
        ),
        ["/r"],
    )
    rows = {row["path"]: row for row in found.repositories.collect()}
    assert {p: (r["commit_count"], r["author_email_count"]) for p, r in rows.items()} == {
        "/r/first": (2, 1), "/r/Second": (2, 1), "/r/none": (0, 0),
    }
    assert found.totals.first().asDict() == {
        "commit_count": 4, "discovered_repository_count": 3, "ignored_repository_count": 0,
        "included_repository_count": 3, "shallow_repository_count": 1, "author_email_count": 1,
    }


def test_ignore_globs(spark):
    found = scan_history(
        _repositories(
            spark,
            [
                ("/r/tools/lint", ["ssh://git@forge.test/Core/lint.git"], False),
                ("/r/attic/v1", [], True),
                ("/r/mirror", ["git@forge.test:Vendor/zlib.git"], True),
                ("/r/attic/mirror", ["git@forge.test:vendor/zlib.git"], False),
                ("/r/local", [""], False),
                ("/r/two", ["git@forge.test:core/two.git"], False),
                ("/r/two", ["git@forge.test:vendor/zlib.git"], False),
            ],
        ),
        _commits(spark, [(p, ME) for p in ("/r/tools/lint", "/r/attic/v1", "/r/mirror")]),
        ["/r"],
        ignore_paths=["Attic/*"],
        ignore_remotes=["forge.test/vendor/*"],
    )
    rows = {row["path"]: row for row in found.repositories.collect()}
    assert {path: row["status"] for path, row in rows.items()} == {
        "/r/tools/lint": "included", "/r/attic/v1": "ignored_path", "/r/mirror": "ignored_remote",
        "/r/attic/mirror": "ignored_path", "/r/local": "included", "/r/two": "ignored_remote",
    }
    for path in ("/r/attic/v1", "/r/mirror"):
        row = rows[path]
        assert (row["commit_count"], row["author_email_count"], row["shallow"]) == (0, 0, False)
    totals = found.totals.first()
    assert totals["commit_count"] == totals["author_email_count"] == 1
    assert totals["ignored_repository_count"] == 4
    with pytest.raises(ValueError, match="root"):
        scan_history(found.repositories, _commits(spark, [("a", "b")]), [])


def test_scan_report(spark, tmp_path):
    found = scan_history(
        _repositories(spark, [("/r/b", [], False), ("/r/A", [], False), ("/r/a", [], False)]),
        _commits(spark, [("/r/b", ME)]),
        ["/r"],
    )
    writers.write_scan_report(found.repositories, found.totals, ["/r"], str(tmp_path / "out"))
    totals = (tmp_path / "out" / "totals.json").read_text()
    assert totals.endswith("}\n")
    payload = json.loads(totals)
    assert list(payload) == sorted(payload)
    assert set(payload) == {
        "author_email_count", "commit_count", "discovered_repository_count",
        "ignored_repository_count", "included_repository_count", "roots",
        "shallow_repository_count",
    }
    lines = []
    for file in sorted((tmp_path / "out" / "repositories").glob("part-*")):
        lines += [json.loads(line) for line in file.read_text().splitlines()]
    assert [line["path"] for line in lines] == ["/r/A", "/r/a", "/r/b"]
    assert all(
        list(line) == ["author_email_count", "commit_count", "path", "shallow", "status"]
        for line in lines
    )


# --- lookups ----------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_beyond_the_bound(spark, how):
    """One key holds a third of the rows; some keys have no partner, some are null."""
    facts = spark.range(3000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 100 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("key"),
    )
    lookup = spark.range(40).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("v")
    ).union(spark.createDataFrame([("hot", -1)], "key string, v long"))
    expected = facts.join(lookup, "key", how)
    salted = joins.lookup_join(facts, lookup, "key", ["n"], how, small=False, hot_keys=20)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    assert salted.columns == expected.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, expected.collect()))


def test_null_keys_are_spread(spark):
    """Most rows have no key; they do not meet in one task."""
    facts = spark.range(8000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 4 == 0, F.concat(F.lit("k"), F.col("id"))).alias("key")
    )
    lookup = spark.range(100).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.lookup_join(facts, lookup, "key", ["n"], "left", small=False, hot_keys=50)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(row["count"] for row in sizes) == 8000
    assert max(row["count"] for row in sizes) < 2500


def test_hot_keys(spark):
    facts = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "h").when(F.col("id") % 10 != 1, F.col("id").cast("string")).alias("k"))
    assert joins.hot_keys_of(facts, "k", 20) == ["h"]
    assert joins.hot_keys_of(facts.limit(0), "k", 20) == []


def test_broadcast_bound(spark):
    assert joins.small_row_count(spark.range(10), max_rows=10) == 10
    assert joins.small_row_count(spark.range(11), max_rows=10) is None
    wide = spark.range(5).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.small_row_count(wide, max_bytes=4000) is None


@pytest.mark.parametrize("allow", ["list", "table"])
def test_build_beyond_the_broadcast_bound(spark, commits, repositories, monkeypatch, allow):
    allowed = [ME] if allow == "list" else spark.createDataFrame([(ME,)], "author_email string")
    expected = build_candidates(repositories, commits, [ME])
    monkeypatch.setattr(plan, "small_row_count", lambda *_: None)
    build = build_candidates(repositories, commits, allowed)
    assert "diff" not in build.labelled.columns
    assert build.texts.count() < commits.count()
    for name in ("candidates", "provenance", "rejections", "decided", "accepted", "leaks"):
        got, want = getattr(build, name), getattr(expected, name)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_inline_stats_of_odd_texts(spark):
    texts = {
        "": (0, False, False),
        "1\t0\tdist/a\0": (1, False, True),
        "1\t0\ta/dist\0\0" + "2\t1\tx.min.js": (2, False, True),
        "1\t0\tdist/a\0" + "1\t0\tdistx/a": (2, False, False),
        "-\t-\tbuild/a\0": (1, True, True),
        "1\t-\ta\0": (1, True, False),
        "1\t0\t-\ta\0": (1, False, False),
        "1\t0\t\ndist/a\0": (1, False, False),
    }
    df = spark.createDataFrame([(text,) for text in texts], "numstat string")
    got = df.select("numstat", change_ops.inline_change_stats(F.col("numstat")).alias("s")).collect()
    assert {row["numstat"]: tuple(row["s"]) for row in got} == texts
    with pytest.raises(PySparkException, match="3 fields"):
        bad = spark.createDataFrame([("1\t0\ta\0" + "1\t0",)], "numstat string")
        bad.select(change_ops.inline_change_stats(F.col("numstat")).alias("s")).collect()
