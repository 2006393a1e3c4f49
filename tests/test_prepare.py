"""Deduplication, splits, digests and the preparation pipeline."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from sievecraft import DataQualityError, prepare_dataset, prepare_files, summarise_splits
from sievecraft.operators import aggregates, guards, ordering
from sievecraft.plans import prepare
from sievecraft.schemas import CANDIDATES
from sievecraft.sources import readers, writers
from tests.conftest import SF_DIR
from workloads import views
from workloads.queries import QUERIES, SINCE, UNTIL

SCHEMA = ", ".join(f"{name} string" for name in CANDIDATES.names)
HOT = "2024-02-01T00:00:00Z"


def make_rows(count, seed=1, copies=0):
    """Rows of which a third share one instant; `copies` more repeat a third of one group."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    rows = []
    for n in range(count + copies):
        patch = f"p{n}" if n < count else "p0"
        at = start + dt.timedelta(seconds=rng.randrange(5_000_000))
        text = HOT if n % 3 == 0 else at.strftime("%Y-%m-%dT%H:%M:%SZ")
        row_id = "candidate_" + hashlib.sha256(f"{seed}-{n}".encode()).hexdigest()[:24]
        rows.append((row_id, f"repository_{n % 7}", f"subject {n}", f"diff {patch}", text, patch))
    rng.shuffle(rows)
    return rows


def expected_splits(rows, cuts=(8, 9)):
    """The definition, in order, over a list."""
    kept, seen = [], set()
    for row in sorted(rows, key=lambda r: (r[4], r[0])):
        key = row[5] or f"id:{row[0]}"
        if key not in seen:
            seen.add(key)
            kept.append(row)
    first, second = (len(kept) * cut // 10 for cut in cuts)
    return {
        row[0]: "train" if n < first else "validation" if n < second else "test"
        for n, row in enumerate(kept)
    }


def frame(spark, rows, partitions=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


@pytest.mark.parametrize(
    ("total", "sizes"),
    [(500, (400, 50, 50)), (505, (404, 50, 51)), (927, (741, 93, 93)), (1, (0, 0, 1)), (0, (0, 0, 0))],
)
def test_cuts(total, sizes):
    found = ordering.split_sizes(ordering.split_bounds(total), total)
    assert tuple(found.values()) == sizes


@pytest.mark.parametrize("sorted_at_once", [100_000, 1])
def test_keys_at_every_kind_of_rank(spark, sorted_at_once):
    rows = make_rows(900)
    keys = sorted(row[4] + row[0] for row in rows)
    df = spark.createDataFrame([(key,) for key in keys], "key string").repartition(5).cache()
    ranks = [899, 0, 1, 299, 450, 451, 720]
    assert ordering.keys_at(df, ranks, 900, sorted_at_once) == [keys[rank] for rank in ranks]
    assert ordering.keys_at(df, [], 900, sorted_at_once) == []


def test_keys_at_with_equal_keys(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 5, "key string")
    assert ordering.keys_at(df, [3, 7], 10, sorted_at_once=2) == ["a", "b"]


SHAPES = {
    "even": lambda k: f"{k * 7919 % 60_000:08d}",
    "one key holds half": lambda k: "m" if k % 2 else f"{k:08d}",
    "long common start": lambda k: "2020-01-01T00:00:00Zcandidate_" + f"{k * 31 % 60_000:08d}",
    "few keys": lambda k: "ä漢🎉"[k % 3] * (k % 5),
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("size", [16, 200])
def test_two_passes_settle_all_cuts(spark, monkeypatch, shape, size):
    """With summaries so small that they are coarse; each key is read twice whatever the keys look like."""
    monkeypatch.setattr(ordering.rank_summary, "__defaults__", (size,))
    n, make = 60_000, SHAPES[shape]
    keys = [make(k) for k in range(n)]
    df = spark.createDataFrame([(key,) for key in keys], "key string").repartition(7)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    ranks = [n * 8 // 10, n * 9 // 10, 0, n - 1, n // 3]
    found = ordering.keys_at(df.mapInArrow(counted, "key string"), ranks, n, sorted_at_once=10)
    in_order = sorted(keys)
    assert found == [in_order[rank] for rank in ranks]
    assert read.value == 2 * n


@pytest.mark.parametrize("partitions", [1, 3, 9])
def test_summaries_keep_their_promise(spark, partitions):
    keys = [f"{k * 48_271 % 65_537:06d}" for k in range(50_000)]
    df = spark.createDataFrame([(key,) for key in keys], "key string").repartition(partitions)
    summary = ordering.rank_summary(df, 64)
    in_order = sorted(keys)
    place = {key: k for k, key in enumerate(in_order)}
    assert all(abs(place[key] - before) <= summary.error for key, before in zip(summary.keys, summary.before))
    assert len(summary.keys) < 2_000 and summary.error < 25_000
    for rank in range(0, 50_000, 997):
        low, high = summary.around(rank)
        assert (low is None or low <= in_order[rank]) and (high is None or in_order[rank] < high)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_prepare_equals_the_definition(spark, partitions):
    rows = make_rows(600, copies=300)
    prepared = prepare_dataset(frame(spark, rows, partitions), sorted_at_once=50)
    got = {row["id"]: row["split"] for row in prepared.splits.collect()}
    assert got == expected_splits(rows)
    assert prepared.counts == {
        "source_count": 900, "filtered_count": 900, "deduplicated_count": 600,
    }
    assert prepared.split_counts == {"train": 480, "validation": 60, "test": 60}


def test_prepare_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(prepare, "small_row_count", lambda *_: None)
    rows = make_rows(600, copies=300)
    got = {r["id"]: r["split"] for r in prepare_dataset(frame(spark, rows)).splits.collect()}
    assert got == expected_splits(rows)


def test_prepare_with_repeated_rows(spark):
    """Whole rows that occur twice: an anti-join on ids could not drop one of them."""
    rows = make_rows(550)
    doubled = rows + rows[:100]
    splits = prepare_dataset(frame(spark, doubled)).splits
    assert splits.count() == 550
    assert {r["id"]: r["split"] for r in splits.collect()} == expected_splits(doubled)


def test_split_invariants(spark):
    rows = make_rows(700, copies=100)
    splits = prepare_dataset(frame(spark, rows)).splits.cache()
    ranges = {
        r["split"]: (r["low"], r["high"])
        for r in splits.groupBy("split")
        .agg(
            F.min(F.struct("committed_at_utc", "id")).alias("low"),
            F.max(F.struct("committed_at_utc", "id")).alias("high"),
        )
        .collect()
    }
    assert ranges["train"][1] < ranges["validation"][0]
    assert ranges["validation"][1] < ranges["test"][0]
    assert splits.groupBy("patch_id").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()


def test_dedup_rules(spark):
    rows = [
        ("b", "g", "s", "d", "2024-01-02T00:00:00Z", "p"),
        ("c", "g", "s", "d", "2024-01-01T00:00:00Z", "p"),
        ("a", "g", "s", "d", "2024-01-01T00:00:00Z", "p"),
        ("x", "g", "s", "d", "2024-01-01T00:00:00Z", ""),
        ("y", "g", "s", "d", "2024-01-01T00:00:00Z", ""),
        ("z", "g", "s", "d", "2024-01-01T00:00:00Z", None),
    ]
    kept = ordering.dedup_earliest(ordering.with_group_key(frame(spark, rows)))
    assert sorted(row["id"] for row in kept.collect()) == ["a", "x", "y", "z"]


def test_dedup_keeps_one_row_per_task_before_the_shuffle(spark):
    plan = (
        ordering.dedup_earliest(ordering.with_group_key(frame(spark, make_rows(10))))
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert plan.count("WindowGroupLimit") == 2


def test_minimum_rows(spark):
    with pytest.raises(DataQualityError, match="at least 500 rows required; found deduplicated: 499"):
        prepare_dataset(frame(spark, make_rows(499)))
    with pytest.raises(DataQualityError, match="validation: 4"):
        prepare_dataset(frame(spark, make_rows(40)), minimum_rows=1, minimum_evaluation_rows=5)


def test_malformed_instant_and_missing_columns(spark):
    rows = make_rows(20)
    bad = [(*rows[0][:4], "2024-01-01 00:00", rows[0][5]), *rows[1:]]
    with pytest.raises(DataQualityError, match="1 rows whose commit instant"):
        prepare_dataset(frame(spark, bad), minimum_rows=1)
    with pytest.raises(DataQualityError, match="candidates is missing columns: subject, patch_id"):
        prepare_dataset(frame(spark, rows).drop("patch_id", "subject"))


def test_window_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "c")
    frame(spark, make_rows(600)).write.parquet(path)
    since = dt.datetime(2024, 1, 5, tzinfo=dt.UTC)
    prepared = prepare_dataset(readers.read_candidates(spark, path), since, minimum_rows=1,
                               minimum_evaluation_rows=1)
    plan = prepared.splits._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(committed_at_utc,2024-01-05T00:00:00Z)" in plan
    assert "Exchange hashpartitioning" not in plan  # no copies: the texts are not shuffled


def test_fingerprint(spark):
    rows = make_rows(300)

    def digest(rows, partitions=3, **bounds):
        return aggregates.dataset_fingerprint(frame(spark, rows, partitions), **bounds).first()[0]

    base = digest(rows)
    assert base == digest(rows[::-1], 1) == digest(rows, 17)
    assert len({base, digest(rows[1:]), digest(rows, since="2024-01-01"), digest(rows + rows[:1])}) == 4
    changed = [(*rows[0][:2], rows[0][2] + " ", *rows[0][3:]), *rows[1:]]
    assert digest(changed) != base

    total = sum(
        int(
            hashlib.sha256(
                json.dumps(dict(zip(CANDIDATES.names, row)), sort_keys=True, separators=(",", ":")).encode()
            ).hexdigest(),
            16,
        )
        for row in rows
    )
    text = f'{{"since":null,"until":null}}{len(rows)}:{total % 2**256:064x}'
    assert base == hashlib.sha256(text.encode()).hexdigest()


def _sorted_digest(header, hashes):
    groups = {}
    for value in sorted(hashes):
        groups.setdefault(value[:4], []).append(value)
    leaves = [hashlib.sha256("".join(groups[prefix]).encode()).hexdigest() for prefix in sorted(groups)]
    return hashlib.sha256((header + "".join(leaves)).encode()).hexdigest()


def test_sorted_digest_hashes_every_value(spark):
    """Other values with the same number and sum are another set."""
    ends = [[("0" * 63 + a,), ("0" * 63 + b,), ("f" * 64,)] for a, b in ("14", "23")]
    frames = [spark.createDataFrame(rows, "row_hash string").repartition(3) for rows in ends]
    assert len({aggregates.set_digest(rows, "h").first()[0] for rows in frames}) == 1
    for rows, hashes in zip(frames, ends):
        assert aggregates.sorted_digest(rows, "h").first()[0] == _sorted_digest("h", [h for h, in hashes])
    assert aggregates.sorted_digest(frames[0].limit(0), "h").first()[0] == hashlib.sha256(b"h").hexdigest()


def _hashes(rows):
    return [r[0] for r in aggregates.row_hashes(rows.select(*CANDIDATES.names)).collect()]


def test_dataset_fingerprint_query_hashes_every_row(spark):
    kept = prepare_dataset(views.candidates(spark, SF_DIR), minimum_rows=1, minimum_evaluation_rows=1).splits
    want = _sorted_digest('{"since":null,"until":null}', _hashes(kept))
    assert QUERIES["dataset_fingerprint"](spark, SF_DIR).first()[0] == want


def test_source_digest_query_hashes_every_row(spark):
    want = _sorted_digest("", _hashes(views.candidates(spark, SF_DIR)))
    assert QUERIES["source_digest"](spark, SF_DIR).first()[0] == want


def test_manifests_hash_every_row(spark, tmp_path):
    prepared = prepare_dataset(
        views.candidates(spark, SF_DIR), SINCE, UNTIL, minimum_rows=1, minimum_evaluation_rows=1
    )
    header = f'{{"since":"{SINCE.isoformat()}","until":"{UNTIL.isoformat()}"}}'
    row = QUERIES["prepare_manifest"](spark, SF_DIR).first()
    assert row["fingerprint"] == _sorted_digest(header, _hashes(prepared.splits))

    rows, source = frame(spark, make_rows(520)), str(tmp_path / "candidates")
    rows.write.parquet(source)
    manifest = prepare_files(spark, source, str(tmp_path / "out"))
    assert manifest["source_sha256"] == _sorted_digest("", _hashes(rows))
    assert manifest["fingerprint"] == _sorted_digest('{"since":null,"until":null}', _hashes(rows))


def test_sums_carry_over_all_lanes(spark):
    hashes = ["f" * 64] * 70_000 + ["0" * 63 + "1"] * 3
    rows = spark.createDataFrame([(h,) for h in hashes], "row_hash string").repartition(4)
    total = (70_000 * (2**256 - 1) + 3) % 2**256
    want = hashlib.sha256(f"h{len(hashes)}:{total:064x}".encode()).hexdigest()
    assert aggregates.set_digest(rows, "h").first()[0] == want
    nothing = hashlib.sha256(f"h0:{0:064x}".encode()).hexdigest()
    assert aggregates.set_digest(rows.limit(0), "h").first()[0] == nothing


def test_sums_of_parts_merge(spark, tmp_path):
    """The digest of a table that got more files follows from the sums of old and new files."""
    rows, path = make_rows(90), str(tmp_path / "source")
    frame(spark, rows[:50], 3).write.parquet(path)
    old = readers.source_sums(spark.read.parquet(path))
    kept = old.collect()
    assert sum(r["rows"] for r in kept) == 50 and len(kept) == 3
    frame(spark, rows[50:], 2).write.mode("append").parquet(path)
    known = {r["file"] for r in kept}
    added = readers.source_sums(spark.read.parquet(path)).filter(~F.col("file").isin(*known))
    merged = aggregates.merged_sums(spark.createDataFrame(kept, old.schema).unionByName(added))
    digest = merged.select(aggregates.sums_digest("")).first()[0]
    assert digest == readers.rows_digest(spark.read.parquet(path)).first()[0]
    by_group = aggregates.hash_sums(
        aggregates.row_hashes(frame(spark, rows)).withColumn("part", F.substring("row_hash", 1, 1)), "part"
    )
    assert aggregates.merged_sums(by_group).select(aggregates.sums_digest("")).first()[0] == digest


def test_digests_gather_nothing(spark):
    plan = aggregates.dataset_fingerprint(frame(spark, make_rows(5)))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Sort" not in plan


def test_source_digest(spark, tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    files = {"a.parquet": b"one", "sub/b.parquet": b"two", "_SUCCESS": b""}
    for name, content in files.items():
        (tmp_path / "d" / name).write_bytes(content)
    listed = readers.file_digests(spark, str(tmp_path / "d"), "*.parquet").collect()
    assert {(r["name"], r["sha256"]) for r in listed} == {
        ("a.parquet", hashlib.sha256(b"one").hexdigest()),
        ("b.parquet", hashlib.sha256(b"two").hexdigest()),
    }


def test_rows_digest(spark, tmp_path):
    """Depends on the rows and not on their files or order."""
    rows = frame(spark, make_rows(40))
    before = readers.rows_digest(rows).first()[0]
    assert readers.rows_digest(rows.orderBy("patch_id").repartition(5)).first()[0] == before
    assert readers.rows_digest(rows.limit(39)).first()[0] != before
    assert readers.rows_digest(rows.withColumn("subject", F.lit(None).cast("string"))).first()[0] != before


@pytest.mark.parametrize("copies", [0, 80])
def test_prepare_files(spark, tmp_path, copies):
    rows = make_rows(520, copies=copies)
    source, out = str(tmp_path / "candidates"), tmp_path / "out"
    frame(spark, rows).write.parquet(source)
    until = dt.datetime(2030, 1, 1, tzinfo=dt.UTC)
    manifest = prepare_files(spark, source, str(out), None, until)
    assert prepare_files(spark, source, str(out), None, until) == manifest  # a second run replaces the first
    text = (out / "manifest.json").read_text()
    assert json.loads(text) == manifest and text.endswith("}\n")
    assert list(json.loads(text)) == sorted(manifest)
    assert manifest["split_counts"] == {"train": 416, "validation": 52, "test": 52}
    assert (manifest["source_file"], manifest["until"]) == ("candidates", "2030-01-01T00:00:00+00:00")
    assert manifest["deduplicated_count"] == 520
    held_out = readers.read_splits(spark, str(out / "splits"))
    wanted = {i: s for i, s in expected_splits(rows).items() if s != "train"}
    assert {row["id"]: row["split"] for row in held_out.collect()} == wanted
    for file in (out / "splits" / "split=train").glob("*.parquet"):
        order = [(r["committed_at_utc"], r["id"]) for r in spark.read.parquet(str(file)).collect()]
        assert order == sorted(order)


def test_read_splits_without_rows(spark, tmp_path):
    """A split without rows has no directory; a missing table is an error."""
    rows = frame(spark, make_rows(5)).withColumn("split", F.lit("validation"))
    writers.write_splits(rows, str(tmp_path / "s"))
    read = readers.read_splits(spark, str(tmp_path / "s"))
    assert {row["split"]: row["count"] for row in read.groupBy("split").count().collect()} == {"validation": 5}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_splits(spark, str(tmp_path / "none"))


def test_summary_sorts_nothing(spark, tmp_path):
    path = str(tmp_path / "splits")
    frame(spark, make_rows(20)).withColumn("split", F.lit("train")).write.parquet(path)
    splits = spark.read.parquet(path)
    for df in (aggregates.split_summary(splits), summarise_splits(splits)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan.split("FileScan")[0].split("ObjectHashAggregate")[-1]
        assert "Sort [" not in plan and plan.count("FileScan") == 1


def test_many_copies_are_joined_by_id(spark, tmp_path, monkeypatch):
    """Beyond the bound for a broadcast: one shuffle of the texts, and no sort of them."""
    path = str(tmp_path / "candidates")
    rows = make_rows(300, copies=80)
    frame(spark, rows).write.parquet(path)
    monkeypatch.setattr(prepare, "BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        splits = prepare.prepare_dataset(spark.read.parquet(path), minimum_rows=1, minimum_evaluation_rows=1).splits
        plan = splits._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert {row["id"]: row["split"] for row in splits.collect()} == expected_splits(rows)


def test_hash_tables_are_bounded(spark, monkeypatch):
    from sievecraft.operators import joins

    monkeypatch.setattr(joins, "HASHED_ROWS", 100)
    build = spark.range(5_000).withColumnRenamed("id", "k")
    joined = spark.range(20_000).withColumn("k", F.col("id") % 6_000).join(joins.hashed(build, 5_000, "k"), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and plan.count(", 50)") >= 2  # both sides, in 50 partitions
    assert joined.count() == sum(k % 6_000 < 5_000 for k in range(20_000))


def test_copies_are_searched_once_with_a_checkpoint_folder(spark, tmp_path, monkeypatch):
    """Whoever reads the splits later does not deduplicate again."""
    rows = make_rows(300, copies=80)
    searched = spark.sparkContext.accumulator(0)
    plain = prepare.dedup_earliest

    def counted(df, *options):
        def count(batches):
            for batch in batches:
                searched.add(batch.num_rows)
                yield batch

        return plain(df.mapInArrow(count, df.schema), *options)

    monkeypatch.setattr(prepare, "dedup_earliest", counted)
    monkeypatch.setattr(prepare, "BROADCAST_ROWS", 10)
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    splits = prepare.prepare_dataset(frame(spark, rows), minimum_rows=1, minimum_evaluation_rows=1).splits
    assert {row["id"]: row["split"] for row in splits.collect()} == expected_splits(rows)
    assert searched.value == len(rows)


def test_enforce_schema(spark):
    df = spark.createDataFrame([(1, "s")], "id int, subject string").withColumns(
        {name: F.lit("x") for name in CANDIDATES.names[2:] + ["repository_group_id"]}
    )
    strict = guards.enforce_schema(df, CANDIDATES)
    assert strict.columns == CANDIDATES.names
    assert {field.dataType.simpleString() for field in strict.schema} == {"string"}
    assert strict.first()["id"] == "1"


def test_lineage_integrity_finds_faults(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    right = spark.createDataFrame([("b",), ("c",), ("d",)], "id string")
    assert tuple(guards.lineage_integrity(left, right).first()) == (3, 3, 1, 2, 1)
