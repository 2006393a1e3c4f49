from __future__ import annotations

import random
import re

import pytest

from sievecraft.llm import contamination
from sievecraft.llm.common import NO_ID


def _words(text):
    return re.findall(r"[a-z0-9]+", (text or "").lower())


def brute(docs, items, size):
    windows = {}
    for name, text in items:
        w = _words(text)
        for k in range(max(len(w) - size + 1, 1) if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(name)
    out = []
    for number, text in docs:
        w, hit, names = _words(text), set(), set()
        for k in range(len(w)):
            for length in {len(x) for x in windows}:
                found = windows.get(tuple(w[k : k + length]))
                if found and k + length <= len(w):
                    hit.update(range(k, k + length))
                    names |= found
        out.append((number, len(w), len(hit), sorted(x for x in names if x is not None)))
    return sorted(out, key=str)


def run(documents, spark, docs, items, size):
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = contamination.contamination(documents(docs), bench, size)
    rows = [(None if r["d"] == NO_ID else r["d"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]
    return sorted(rows, key=str)


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_like_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(contamination, "BLOCK", block)  # several blocks of items in the second run
    random_ = random.Random(5)
    text = lambda n: " ".join(random_.choice("abcd") for _ in range(n))
    items = [(f"i{k}", text(random_.randint(0, 9))) for k in range(8)] + [("short", "D, d."), ("i0", "c c"), (None, "b"), ("n", None)]
    docs = [(k, text(random_.randint(0, 40))) for k in range(30)] + [(None, "a b"), (5, None), (6, ""), (7, "b d d"), (7, "b d d")]
    assert run(documents, spark, docs, items, 4) == brute(docs, items, 4)


def test_empty_tables(spark, documents):
    assert run(documents, spark, [], [("a", "b c")], 3) == []
    assert run(documents, spark, [(1, "b c")], [], 3) == [(1, 2, 0, [])]


def test_long_text_and_removal(spark, documents):
    passage = " ".join(f"p{k}" for k in range(20))
    docs = documents([(1, "x " * 300_000 + passage), (2, passage + " y"), (3, "clean words only")])
    bench = spark.createDataFrame([(9, passage)], "item_id int, text string")
    hits = {r["d"]: r["n_hit"] for r in contamination.contamination(docs, bench).collect()}
    assert hits == {1: 20, 2: 20, 3: 0}
    kept = contamination.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_longest_matches(spark, documents):
    texts = {1: "a b c x a b c d", 2: "c d", 3: None}
    docs = documents(list(texts.items()))
    bench = spark.createDataFrame([("q", "b c d e")], "item_id string, text string")
    rows = contamination.longest_matches(docs, bench).collect()
    assert sorted((r["word"], r["length"]) for r in rows) == [(0, 3), (1, 2), (2, 1)]
    for r in rows:
        there = texts[r["doc_id"]].split()[r["place"] : r["place"] + r["length"]]
        assert there == "b c d e".split()[r["word"] : r["word"] + r["length"]]
