from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from sievecraft.llm import recompression, repeats, suffix_arrays, suffix_dedup
from sievecraft.llm.common import NO_ID


def test_suffix_array():
    random_ = np.random.default_rng(0)
    for trial in range(200):
        text = random_.integers(1, random_.integers(2, 6), random_.integers(0, 60)).astype(np.int64)
        if trial % 5 == 0:
            text[:] = 1
        row = text.tolist()
        assert suffix_arrays.suffix_array(text).tolist() == sorted(range(len(row)), key=lambda i: row[i:])


def test_repeated_starts():
    random_ = np.random.default_rng(1)
    for _ in range(200):
        letters = random_.integers(1, 4)
        strings = [
            bytes(random_.integers(97, 97 + letters, random_.integers(0, 30)).astype(np.uint8))
            for _ in range(random_.integers(1, 6))
        ]
        width = int(random_.integers(1, 6))
        data = np.frombuffer(b"".join(strings) + bytes(8), np.uint8)
        found = suffix_arrays.repeated_starts(data, np.array([len(x) for x in strings]), width)
        count = Counter(x[i : i + width] for x in strings for i in range(len(x) - width + 1))
        assert found.tolist() == [
            len(x[i : i + width]) == width and count[x[i : i + width]] > 1 for x in strings for i in range(len(x))
        ]


def brute_bytes(docs, width):
    raw = [(x or "").encode() for _, x in docs]
    count = Counter(x[i : i + width] for x in raw for i in range(len(x) - width + 1))
    out = []
    for (number, _), x in zip(docs, raw):
        gone = bytearray(len(x))
        for i in range(len(x) - width + 1):
            if count[x[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(x)))
        out.append((number, len(x), sum(gone), spans, bytes(a for a, b in zip(x, gone) if not b)))
    return sorted(out, key=str)


def brute_words(docs, width):
    rows = [(NO_ID if number is None else number, (x or "").split()) for number, x in docs]
    low = {}
    for number, w in rows:
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            low[key] = min(low.get(key, number), number)
    out = []
    for number, w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if low[tuple(w[i : i + width])] < number:
                gone[i : i + width] = [True] * width
        kept = " ".join(a for a, b in zip(w, gone) if not b).encode()
        out.append((None if number == NO_ID else number, len(w), sum(gone), kept))
    return sorted(out, key=str)


def corpus(seed):
    """Texts that share passages, copies, short and null ones, repeated rows, and long runs of one letter."""
    random_ = random.Random(seed)
    text = lambda n: " ".join(random_.choice(("ab", "c", "dé", "efg", "hi")) for _ in range(n))
    passages = [text(n) for n in (12, 30, 60)]
    docs = []
    for k in range(25):
        parts = [random_.choice(passages) if random_.random() < 0.5 else text(random_.randint(0, 25)) for _ in range(3)]
        docs.append((k * 2, " \n".join(parts)))
    return docs + [
        (1, docs[0][1]), (1, docs[0][1]), (3, None), (5, ""), (7, "z" * 90), (9, "z " * 70), (None, docs[4][1]), (None, passages[2]),
        (11, "a b c d " * 30),
    ]


@pytest.mark.parametrize("crowd", [8192, 2])
@pytest.mark.parametrize("width", [20, 64])
def test_strings_like_brute_force(documents, monkeypatch, width, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    docs = corpus(width)
    found = suffix_dedup.without_repeats(documents(docs), width).collect()
    rows = [(None if r["d"] == NO_ID else r["d"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found]
    assert sorted(rows, key=str) == brute_bytes(docs, width)


@pytest.mark.parametrize("crowd", [8192, 2])
@pytest.mark.parametrize("width", [5, 14])
def test_windows_like_brute_force(documents, monkeypatch, width, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    docs = corpus(width)
    found = recompression.without_repeats(documents(docs), width).collect()
    rows = [(None if r["d"] == NO_ID else r["d"], r["n_words"], r["n_removed"], bytes(r["kept"])) for r in found]
    assert sorted(rows, key=str) == brute_words(docs, width)


def test_empty_tables(documents):
    assert suffix_dedup.without_repeats(documents([])).count() == 0
    assert recompression.without_repeats(documents([])).count() == 0


def test_text_longer_than_a_segment(documents, monkeypatch):
    random_ = random.Random(2)
    base = "".join(random_.choice("abcdefgh ") for _ in range(1_300_000))
    docs = documents([(1, base), (2, base[700_000:1_250_000] + "!")])
    rows = {r["d"]: r["n_removed"] for r in suffix_dedup.without_repeats(docs).collect()}
    assert rows == {1: 550_000, 2: 550_000}


def test_equal_windows_have_equal_owners():
    random_ = np.random.default_rng(3)
    passage = random_.integers(1, 6, 40).astype(np.uint64)
    names = set()
    for _ in range(20):
        text = np.concatenate([random_.integers(1, 6, 15), passage, random_.integers(1, 6, 15)]).astype(np.uint64)
        edge = np.zeros(len(text), bool)
        edge[[0, -1]] = True
        from sievecraft.llm import texts

        _, name = recompression.owners(recompression.levels(texts.mix(text), edge, 4), len(text) - 20, 20)
        names.add(tuple(name[15:35].tolist()))
    assert len(names) == 1
