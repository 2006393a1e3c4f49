"""Summary, queue, decisions and the reviewed subset."""

from __future__ import annotations

import pytest

from sievecraft import DataQualityError, materialise_review, review_batch, summarise_splits
from sievecraft.plans import review
from sievecraft.schemas import CANDIDATES, DECISIONS
from sievecraft.sources import decision_log, readers, writers

SCHEMA = ", ".join(f"{name} string" for name in [*CANDIDATES.names, "split"])


@pytest.fixture
def splits(spark):
    rows = [
        (
            f"{split}{n}", f"g{n % 2}", "s" * (n + 1), f"+++ b/x{n}.py\n+++ b/y\n",
            f"2024-01-0{n + 1}T00:00:00Z", f"p{n}", split,
        )
        for split in ("train", "validation", "test")
        for n in range(6)
    ]
    return spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)


def decide(spark, *rows):
    return spark.createDataFrame(list(rows), DECISIONS)


def test_summary(splits):
    rows = {row["split"]: row for row in summarise_splits(splits).collect()}
    row = rows["test"]
    assert row["rows"] == 6 and row["repository_groups"] == 2
    assert row["subject_length"].asDict() == {"min": 1, "max": 6}
    assert row["date_range"].asDict() == {
        "first": "2024-01-01T00:00:00Z", "last": "2024-01-06T00:00:00Z",
    }
    assert row["languages"] == {"python": 6, "unknown": 6}
    with pytest.raises(DataQualityError, match="missing columns: subject"):
        summarise_splits(splits.drop("subject"))


def test_next_undecided(spark, splits):
    queue = review.audit_queue(splits)
    decisions = decide(spark, ("validation0", "validation", True, 1), ("test2", "test", False, 2))
    rows = review.next_undecided(queue, decisions, 2).collect()
    assert {(r["split"], r["position"], r["id"]) for r in rows} == {
        ("validation", 1, "validation1"), ("validation", 2, "validation2"),
        ("test", 1, "test0"), ("test", 2, "test1"),
    }


def batch_ids(spark, splits, rows, **options):
    queue = review.audit_queue(splits)
    batch = review_batch(queue, decide(spark, *rows), **options).orderBy("position")
    return [row["id"] for row in batch.collect()]


def test_review_batch_walks_the_splits(spark, splits):
    assert batch_ids(spark, splits, [], required=2) == ["validation0"]
    rejected = [("validation0", "validation", False, 1)]
    assert batch_ids(spark, splits, rejected, required=2, k=3) == [
        "validation1", "validation2", "validation3",
    ]
    done = [(f"validation{n}", "validation", True, n) for n in range(2)]
    assert batch_ids(spark, splits, done, required=2) == ["test0"]
    all_done = done + [(f"test{n}", "test", True, n) for n in range(2)]
    assert batch_ids(spark, splits, all_done, required=2) == []
    changed_mind = all_done + [("test1", "test", False, 99)]
    assert batch_ids(spark, splits, changed_mind, required=2) == ["test2"]
    none_left = [(f"validation{n}", "validation", n == 0, n) for n in range(6)]
    with pytest.raises(DataQualityError, match="validation ran out of rows with 1 of 2"):
        batch_ids(spark, splits, none_left, required=2)


def test_decision_log(spark, splits, tmp_path):
    path = str(tmp_path / "log")
    assert decision_log.read_decisions(spark, path).count() == 0
    decision_log.append_decisions(decide(spark, ("test0", "test", True, 1), ("gone", "test", True, 2)), path)
    decision_log.append_decisions(decide(spark, ("test0", "test", False, 3)), path)
    latest = decision_log.read_decisions(spark, path)
    assert {(r["id"], r["approved"]) for r in latest.collect()} == {("test0", False), ("gone", True)}
    current = review.current_decisions(latest, review.audit_queue(splits))
    assert [tuple(row) for row in current.collect()] == [("test0", "test", False, 3)]


def test_approvals_count_undecided_as_not_approved(spark, splits):
    decisions = decide(
        spark, ("test0", "test", True, 1), ("test1", "test", None, 2), ("train0", "train", True, 3)
    )
    rows = review.approval_counts(review.audit_queue(splits), decisions).collect()
    assert {(r["split"], r["rows"], r["decided"], r["approved"]) for r in rows} == {
        ("validation", 6, 0, 0), ("test", 6, 1, 1),
    }


def test_materialise(spark, splits, tmp_path):
    rows = [(f"{s}{n}", s, n != 1, n) for s in ("validation", "test") for n in range(5)]
    out = str(tmp_path / "reviewed")
    assert materialise_review(splits, decide(spark, *rows), out, 3) == {"validation": 4, "test": 4}
    written = readers.read_splits(spark, out)
    assert {r["id"] for r in written.collect()} == {row[0] for row in rows if row[2]}
    assert written.columns == [*CANDIDATES.names, "split"]


def test_materialise_checks(spark, splits, tmp_path):
    enough = [(f"{s}{n}", s, True, n) for s in ("validation", "test") for n in range(3)]
    out = str(tmp_path / "reviewed")
    with pytest.raises(DataQualityError, match="at least 4 approvals per split required; found val"):
        materialise_review(splits, decide(spark, *enough), out, 4)
    with pytest.raises(DataQualityError, match="2 approved ids absent"):
        stale = [("gone", "test", True, 8), ("validation5", "test", True, 9)]
        materialise_review(splits, decide(spark, *enough, *stale), out, 3)
    assert not (tmp_path / "reviewed").exists()


def test_union_splits_tags_rows(splits):
    tables = {name: splits.filter(f"split = '{name}'").drop("split") for name in ("test", "validation")}
    united = review.union_splits(**tables)
    assert united.groupBy("split").count().count() == 2 and united.count() == 12


def test_held_out_partitions_only(spark, splits, tmp_path):
    writers.write_splits(splits, str(tmp_path / "s"))
    queue = review.audit_queue(spark.read.parquet(str(tmp_path / "s")))
    plan = queue._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [split" in plan and "patch_id" not in plan


def test_large_batches_are_cut_by_counting(spark, monkeypatch):
    """More rows than each task would keep: only what comes before the cut is ranked."""
    from sievecraft.plans import review as plan

    rows = [("validation" if k % 3 else "test", f"{k:05d}", "s", "d", f"2020-01-01T00:{k % 50:02d}:00Z") for k in range(900)]
    queue = spark.createDataFrame(rows, "split string, id string, subject string, diff string, committed_at_utc string")
    none = spark.createDataFrame([], "id string, approved boolean")
    expected = {(r["split"], r["id"], r["position"]) for r in plan.next_undecided(queue, none, 120).collect()}
    monkeypatch.setattr(plan, "KEPT_PER_TASK", 50)
    found = plan.next_undecided(queue, none, 120)
    assert {(r["split"], r["id"], r["position"]) for r in found.collect()} == expected
    assert len(expected) == 240
    assert plan.next_undecided(queue, none, 700).count() == 900


def test_ties_in_the_log(spark):
    from sievecraft.sources import readers

    rows = [("a", "test", True, 5), ("a", "test", False, 5), ("a", "validation", True, 4), ("b", "test", True, 1), ("b", "validation", True, 1)]
    log = spark.createDataFrame(rows, "id string, split string, approved boolean, seq long")
    found = {r["id"]: (r["split"], r["approved"]) for r in readers.latest_decisions(log).collect()}
    assert found == {"a": ("test", False), "b": ("test", True)}


def log_rows(spark, *rows):
    return spark.createDataFrame(rows, "id string, split string, approved boolean, seq long")


def test_life_of_the_log(spark, tmp_path):
    from sievecraft.plans import review as plan

    log = str(tmp_path / "log")
    queue = spark.createDataFrame([("a", "test"), ("b", "validation")], "id string, split string")
    for seq, (row_id, approved) in enumerate([("a", True), ("a", False), ("b", True), ("gone", True)]):
        decision_log.append_decisions(log_rows(spark, (row_id, "test", approved, seq)), log)
    before = decision_log.DecisionLog(spark, log).read()
    assert before.count() == 4
    assert plan.compact_decisions(spark, log, queue) == 2
    found = {r["id"]: (r["split"], r["approved"]) for r in decision_log.read_decisions(spark, log).collect()}
    assert found == {"a": ("test", False), "b": ("validation", True)}
    assert before.count() == 4  # a reader of the earlier snapshot still sees all of it
    assert decision_log.DecisionLog(spark, log).vacuum(keep=1) == 4
    assert decision_log.read_decisions(spark, log).count() == 2
    decision_log.append_decisions(log_rows(spark, ("c", "test", True, 9)), log)
    assert decision_log.read_decisions(spark, log).count() == 3
    assert plan.retire_decisions(spark, log) and not plan.retire_decisions(spark, log)
    assert decision_log.read_decisions(spark, log).count() == 0


def test_a_failure_between_the_steps_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    log = decision_log.DecisionLog(spark, path)
    log.append(log_rows(spark, ("a", "test", True, 1), ("b", "test", True, 2)))
    queue = spark.createDataFrame([("a", "test")], "id string, split string")

    def fails(self, number, parts):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(decision_log.DecisionLog, "_commit", fails)
        with pytest.raises(OSError):
            log.append(log_rows(spark, ("c", "test", True, 3)))
        with pytest.raises(OSError):
            log.compact(queue)
    assert {r["id"] for r in log.read().collect()} == {"a", "b"}
    # A snapshot that was cut off while it was written is not there yet, and its number is not used again.
    (tmp_path / "log" / "snapshots" / "0000000002.json").write_text('{"parts": [')
    assert {r["id"] for r in log.read().collect()} == {"a", "b"}
    assert log.compact(queue) == 1
    assert [r["id"] for r in log.read().collect()] == ["a"]
    assert log._numbers() == [1, 2, 3]


def test_two_writers(spark, tmp_path, monkeypatch):
    """Both decisions are kept if another writer takes the number first; a second compaction of the same log is an error."""
    path = str(tmp_path / "log")
    one, two = (decision_log.DecisionLog(spark, path) for _ in range(2))
    one.append(log_rows(spark, ("a", "test", True, 1)))
    plain, calls = decision_log.DecisionLog._commit, []

    def late(self, number, parts):
        if not calls:
            calls.append(number)
            two.append(log_rows(spark, ("b", "test", True, 2)))
        return plain(self, number, parts)

    monkeypatch.setattr(decision_log.DecisionLog, "_commit", late)
    one.append(log_rows(spark, ("c", "test", True, 3)))
    assert {r["id"] for r in one.read().collect()} == {"a", "b", "c"}
    queue = spark.createDataFrame([("a", "test"), ("b", "test"), ("d", "test")], "id string, split string")
    calls.clear()

    def appended(self, number, parts):
        if not calls:
            calls.append(number)
            two.append(log_rows(spark, ("d", "test", True, 4)))
        return plain(self, number, parts)

    monkeypatch.setattr(decision_log.DecisionLog, "_commit", appended)
    assert one.compact(queue) == 2  # what was appended meanwhile stays beside them
    assert {r["id"] for r in one.read().collect()} == {"a", "b", "d"}
    calls.clear()

    def compacted(self, number, parts):
        if not calls:
            calls.append(number)
            two.compact(queue)
        return plain(self, number, parts)

    monkeypatch.setattr(decision_log.DecisionLog, "_commit", compacted)
    with pytest.raises(RuntimeError):
        one.compact(queue)
    assert {r["id"] for r in one.read().collect()} == {"a", "b", "d"}
