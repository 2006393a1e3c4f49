from __future__ import annotations

import pytest

from sievecraft.llm import mixing

WEIGHTS = {"a": 5, "b": 3, "c": 1}


def run(documents, sizes, block=2, weights=WEIGHTS):
    rows, number = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((number, f"text {number}", None, source))
            number += 1
    found = mixing.mixed(documents(rows), weights, 2, block).orderBy("mix_position").collect()
    assert sorted(r["doc_id"] for r in found) == list(range(number))
    assert len({r["mix_position"] for r in found}) == number
    assert found[0]["d"] == "x" if found else True
    return found


def blocks(found):
    """Source of each slot in order."""
    out = {}
    for r in found:
        out.setdefault((r["mix_period"], r["mix_slot"]), []).append(r["source"])
    assert all(len(set(x)) == 1 or None in x or x[0] not in WEIGHTS for x in out.values())
    return [x[0] if x[0] in WEIGHTS else "other" for _, x in sorted(out.items())]


def test_less_than_one_block_from_the_share(documents):
    found = blocks(run(documents, {"a": 100, "b": 60, "c": 20, "z": 30, None: 10}))
    weights = {**WEIGHTS, "other": 2}
    assert len(found) == 110
    for slot in range(len(found) + 1):
        for name, weight in weights.items():
            assert abs(found[:slot].count(name) - slot * weight / 11) < 1


def test_sources_run_out(documents):
    found = blocks(run(documents, {"a": 7, "b": 120, "c": 31}))
    left = [x for x in found[20:]]  # `a` has 4 blocks, all in the first period
    assert "a" not in left
    for slot in range(0, 40):
        assert abs(left[:slot].count("b") - slot * 3 / 4) < 2


def test_small_and_empty_tables(documents):
    assert run(documents, {}) == []
    assert len(run(documents, {None: 1})) == 1
    assert len(run(documents, {"c": 3}, weights={})) == 3


def test_repeated_rows_and_null_ids(documents):
    docs = documents([(1, "t", None, "a")] * 5 + [(None, None, None, "b")] * 3 + [(None, "u", None, None)])
    found = mixing.mixed(docs, WEIGHTS).collect()
    assert len(found) == 9 and len({r["mix_position"] for r in found}) == 9


def test_weights_are_checked(documents):
    for weights in ({"a": 0}, {"a": 1.5}, {"a": 10_000}):
        with pytest.raises(ValueError):
            mixing.mixed(documents([]), weights)


def test_order_of_files(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "PART", 400)
    docs = documents([(k, f"text {k}", None, "abz"[k % 3]) for k in range(200)])
    want = [r["doc_id"] for r in mixing.mixed(docs, WEIGHTS, block=4).orderBy("mix_position").collect()]
    mixing.mixed_in_order(docs, WEIGHTS, block=4).write.parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "_metadata.file_name", "_metadata.row_index")
    assert [r["doc_id"] for r in sorted(back.collect(), key=lambda r: (r["file_name"], r["row_index"]))] == want
    assert len({r["file_name"] for r in back.collect()}) > 3


def test_no_python_in_the_plan(documents):
    plan = mixing.mixed(documents([(1, "t", None, "a")]), WEIGHTS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
