from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sievecraft.llm import token_shards


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000, 4097])
def test_permutation(size):
    there = token_shards.permuted(np.arange(size), size)
    assert sorted(there.tolist()) == list(range(size))
    assert token_shards.permuted(there, size, inverse=True).tolist() == list(range(size))
    if size > 100:
        assert there.tolist() != token_shards.permuted(np.arange(size), size, key=1).tolist()


def test_round_trip(spark, documents, tmp_path):
    texts = [None, "", " ", "Ab cd\n\n  été <|endoftext|>", "x" * 5000, *(f"some words {k} " * (k % 9) for k in range(60))]
    documents([(k, x) for k, x in enumerate(texts)]).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = token_shards.token_shards(docs, length=16, per_shard=8)
    token_shards.write_shards(found, str(tmp_path / "out"))
    rows = sorted(token_shards.read_shards(spark, str(tmp_path / "out")).collect(), key=lambda r: r["sequence"])
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    assert all(len(r["ids"]) == 32 and r["shard"] == r["slot"] // 8 and r["byte_offset"] == r["slot"] % 8 * 32 for r in rows)
    stream = np.concatenate([np.frombuffer(r["ids"], np.uint16)[: r["n_tokens"]] for r in rows])
    ordered = docs.select("text", "_metadata.file_name", "_metadata.row_index").collect()
    ordered = [r["text"] for r in sorted(ordered, key=lambda r: (r["file_name"], r["row_index"])) if r["text"]]
    encode = token_shards.encoder(token_shards.vocabulary())
    want = [t for x in ordered for t in [*encode.encode_ordinary(x), token_shards.END]]
    assert stream.tolist() == want
    parts, at = [], 0
    for x in ordered:
        to = at + stream[at:].tolist().index(token_shards.END)
        parts.append(encode.decode(stream[at:to].tolist()))
        at = to + 1
    assert parts == ordered
    half = len(rows) // 2
    resumed = token_shards.read_shards(spark, str(tmp_path / "out"), half, 8).collect()
    assert sorted(r["slot"] for r in resumed) == list(range(half, len(rows)))


def test_other_tables(documents):
    """A table that is no file is saved first; an empty one has no sequences."""
    assert token_shards.token_shards(documents([(1, "a b"), (2, None)]), length=4).count() == 1
    assert token_shards.token_shards(documents([])).count() == 0
    assert token_shards.token_shards(documents([(1, None)])).count() == 0


def test_shards_are_in_order(documents):
    docs = documents([(k, "word " * 40) for k in range(50)])
    found = token_shards.token_shards(docs, length=8, per_shard=10)
    slots = found.rdd.mapPartitions(lambda rows: [[r["slot"] for r in rows]]).collect()
    assert all(part == sorted(part) for part in slots)
    assert all(len({s // 10 for s in part}) <= 1 for part in slots)


def test_files_of_one_name(spark, tmp_path):
    """Files of one name in several folders are several files."""
    want = []
    for folder in range(2):
        texts = [f"folder {folder} text {k} " * (k + 1 + folder) for k in range(5)]
        (tmp_path / f"part={folder}").mkdir()
        pq.write_table(pa.table({"text": texts}), tmp_path / f"part={folder}" / "part-0.parquet")
        encode = token_shards.encoder(token_shards.vocabulary()).encode_ordinary
        want += [t for x in texts for t in [*encode(x), token_shards.END]]
    rows = token_shards.token_shards(spark.read.parquet(str(tmp_path)), length=8).collect()
    rows.sort(key=lambda r: r["sequence"])
    assert np.concatenate([np.frombuffer(r["ids"], np.uint16)[: r["n_tokens"]] for r in rows]).tolist() == want
