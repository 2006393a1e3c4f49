"""All pipelines in a row, from input tables to the reviewed subset."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from sievecraft import (
    build_candidates,
    materialise_review,
    prepare_files,
    review_batch,
    scan_history,
    summarise_splits,
    write_build,
)
from sievecraft.plans.review import audit_queue
from sievecraft.schemas import DECISIONS
from sievecraft.sources import decision_log, readers, writers

COMMITS = 700


def test_from_commits_to_reviewed_rows(spark, tmp_path):
    out = str(tmp_path)
    clones = ["/srv/one", "/srv/two", "/srv/archive/old"]
    spark.createDataFrame(
        [(path, [f"git@h.com:a/{path[-3:]}.git"], False) for path in clones] * 2,
        "path string, remotes array<string>, shallow boolean",
    ).write.parquet(f"{out}/in/repositories")
    n = F.col("id")
    one = spark.range(COMMITS).select(
        F.lit("/srv/one").alias("repository_path"),
        F.sha1(n.cast("string")).alias("commit_sha"),
        F.when(n % 10 == 9, F.array(F.lit("p"), F.lit("q"))).otherwise(F.array()).alias("parents"),
        F.concat(F.lit(" Change  "), n.cast("string")).alias("subject"),
        F.lit("Me").alias("author_name"),
        F.lit("Me@example.com").alias("author_email"),
        F.concat(
            F.date_format(F.timestamp_seconds(n * 3600), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")
        ).alias("committed_at"),
        F.concat(
            F.lit("diff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py\n@@ -1 +1 @@\n+"),
            n.cast("string"), F.lit("\n"),
        ).alias("diff"),
        F.lit("1\t0\tx.py\0").alias("numstat"),
    )
    # The second clone holds the same commits: new ids, same patches.
    for path in clones:
        one.withColumn("repository_path", F.lit(path)).write.mode("append").parquet(
            f"{out}/in/commits"
        )

    repositories = readers.read_repositories(spark, f"{out}/in/repositories")
    commits = spark.read.parquet(f"{out}/in/commits")
    scan = scan_history(repositories, commits, ["/srv"], ["archive/*"], [])
    writers.write_scan_report(scan.repositories, scan.totals, ["/srv"], f"{out}/scan")
    totals = json.loads((tmp_path / "scan" / "totals.json").read_text())
    assert (totals["commit_count"], totals["author_email_count"]) == (2 * COMMITS, 1)
    assert (totals["included_repository_count"], totals["ignored_repository_count"]) == (2, 1)

    build = build_candidates(scan.statuses, commits, ["me@EXAMPLE.com"])
    counts = write_build(build, f"{out}/candidates", f"{out}/provenance", 4)
    kept = COMMITS * 9 // 10
    assert counts == {"accepted": 2 * kept, "merge": 2 * COMMITS // 10}

    manifest = prepare_files(spark, f"{out}/candidates", f"{out}/prepared")
    assert manifest["source_count"] == 2 * kept
    assert manifest["deduplicated_count"] == kept == 630
    assert manifest["split_counts"] == {"train": 504, "validation": 63, "test": 63}
    again = prepare_files(spark, f"{out}/candidates", f"{out}/prepared_again")
    assert again == manifest

    held_out = readers.read_splits(spark, f"{out}/prepared/splits")
    summary = {row["split"]: row for row in summarise_splits(held_out).collect()}
    assert summary["validation"]["rows"] == 63
    assert summary["test"]["languages"] == {"python": 63}
    assert summary["validation"]["date_range"]["last"] < summary["test"]["date_range"]["first"]

    queue, log = audit_queue(held_out), f"{out}/decisions"
    for expected in ("validation", "test"):
        batch = review_batch(queue, decision_log.read_decisions(spark, log), required=50, k=55)
        assert {row["split"] for row in batch.collect()} == {expected}
        decided = batch.select(
            "id", "split", (F.col("position") > 5).alias("approved"), F.col("position").alias("seq")
        )
        decision_log.append_decisions(spark.createDataFrame(decided.collect(), DECISIONS), log)
    decisions = decision_log.read_decisions(spark, log)
    assert review_batch(queue, decisions, required=50).isEmpty()
    written = materialise_review(held_out, decisions, f"{out}/reviewed", required=50)
    assert written == {"validation": 50, "test": 50}
