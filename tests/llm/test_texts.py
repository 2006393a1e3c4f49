from __future__ import annotations

import re

import numpy as np
import pytest
import pyarrow as pa

from sievecraft.llm import texts

TEXTS = [None, "", " ", "a b", "b c", "Ab\tÉ\x0bc d", "x" * 70 + " y", "no", "yes", "x" * 70]


def _words(separators):
    column = pa.array(TEXTS).slice(1)
    data, offsets = texts.text_bytes(column, lower=True)
    starts, ends, cuts = texts.words(data, offsets, separators)
    return [
        [bytes(data[starts[k] : ends[k]]).decode() for k in range(cuts[i], cuts[i + 1])] for i in range(len(column))
    ], texts.word_hashes(data, starts, ends)


def test_words():
    lower = [(x or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in TEXTS[1:]]
    found, hashes = _words(texts.SPACES)
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", x) for x in lower]
    every = [x for row in found for x in row]
    assert len(set(hashes.tolist())) == len(set(every))
    found, _ = _words(texts.NOT_ALPHANUMERIC)
    assert found == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x) for x in lower]


def test_slices():
    batch = pa.record_batch({"text": pa.array(["a" * 100, None, "", "b" * 5000, "c"])})
    parts = list(texts.slices(iter([batch, batch.slice(0, 0)]), limit=200))
    assert [x for part in parts for x in part.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) > 1


def test_window_hashes():
    symbols = texts.mix(np.array([1, 2, 3, 1, 2, 3, 4], np.uint64))
    for which in (0, 1):
        found = texts.Windows(symbols, which)
        rolled = found.rolling(3)
        assert rolled.tolist() == found.hash(np.arange(5), np.arange(3, 8)).tolist()
        assert rolled[0] == rolled[3] and len(set(rolled.tolist())) == 4


def test_a_cluster_needs_a_shared_folder():
    """Executors of a cluster would write where the driver cannot read."""
    from types import SimpleNamespace

    from sievecraft.llm import common

    def session(master, folder=None):
        kept = {"spark.checkpoint.dir": folder} if folder else {}
        conf = SimpleNamespace(get=kept.get, set=kept.__setitem__)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    with pytest.raises(RuntimeError):
        common.shared_folder(session("spark://host:7077"))
    assert common.shared_folder(session("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    assert common.shared_folder(session("local[8]")).startswith("file://")
