from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from sievecraft.llm import periods, texts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if w[q:] == w[: len(w) - q])


def brute(w, least=6, power=4):
    """(start, length, period) of all runs, from the definition."""
    out = []
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, power * q) and smallest_period(w[i : j + q]) == q:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda x: (x[0], x[2]))


def expected(text, digest=False):
    w = WORD.findall((text or "").encode())
    found = brute(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (len(w), len(found), *top, "".join(f"{s},{n},{q}\n" for s, n, q in found), kept)


COLUMNS = ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "kept")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4))
def test_small_alphabets(lists):
    symbols, cuts = [], [0]
    for k, one in enumerate(lists):
        symbols += [10 * k + x for x in one]
        cuts.append(len(symbols))
    start, length, period = periods.runs(np.array(symbols, np.int64))
    want = [(a + s, n, q) for one, a in zip(lists, cuts) for s, n, q in brute(one)]
    assert sorted(zip(start.tolist(), length.tolist(), period.tolist())) == sorted(want)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 37), st.integers(4, 9), st.integers(0, 60))
def test_long_periods(seed, period, times, rest):
    random_ = random.Random(seed)
    root = [random_.randrange(3) for _ in range(period)]
    w = [random_.randrange(3) for _ in range(rest)] + root * times + root[: rest % period] + [random_.randrange(3) for _ in range(rest)]
    start, length, found = periods.runs(np.array(w, np.int64))
    assert list(zip(start.tolist(), length.tolist(), found.tolist())) == brute(w)


def test_a_smaller_power():
    w = [0, 1, 2, 0, 1, 2, 0, 1, 2, 3, 3, 3]
    start, length, period = periods.runs(np.array(w, np.int64), least=3, power=3)
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == [(0, 9, 3), (9, 3, 1)]
    with pytest.raises(ValueError):
        periods.periodic_runs(None, power=2)


def rows_of(docs):
    random_ = random.Random(3)
    plain = " ".join(f"w{random_.randrange(500)}" for _ in range(3000))
    return [
        (1, "a a a a a a"),
        (2, "a a a a a"),
        (3, "x\ty\nx y  x y x y z"),
        (4, None),
        (5, ""),
        (6, " \n "),
        (7, plain + " " + "p q r " * 700 + plain),
        (8, "é ü é ü é ü é ü"),
        (8, "é ü é ü é ü é ü"),
        (None, "b b b b b b b c"),
        (9, "A a A a A a A a a a a a a a"),
        (10, "u " * 50 + "v " * 50),
        (11, "a b a b c " * 12),
    ]


@pytest.mark.parametrize("chunk", [texts.CHUNK, 40])
def test_documents(spark, documents, monkeypatch, chunk):
    monkeypatch.setattr(texts, "CHUNK", chunk)
    rows = rows_of(documents)
    found = periods.periodic_runs(documents(rows)).collect()
    got = sorted((r["d"], *(bytes(r[c]) if c == "kept" else r[c] for c in COLUMNS)) for r in found)
    assert got == sorted(((-(1 << 63) if n is None else n), *expected(t)) for n, t in rows)


def test_digest_and_empty_table(spark, documents):
    row = periods.periodic_runs(documents([(1, "a a a a a a b")]), digest=True).first()
    assert bytes(row["kept"]) == hashlib.sha256(b"a b").digest()
    assert periods.periodic_runs(documents([])).count() == 0


def planted(number, text):
    w = WORD.findall((text or "").encode())
    if number is None or not w:
        return w
    h = zlib.crc32(str(number).encode())
    g = h // 10
    if h % 10:
        return w
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def test_planted(spark, documents):
    random_ = random.Random(6)
    rows = [(k, " ".join(f"w{random_.randrange(50)}" for _ in range(random_.randrange(60)))) for k in range(300)]
    rows += [(None, "a b c"), (301, None), (302, "  "), (-5, "a b c d e f g h i j")]
    found = periods.with_planted_runs(documents(rows)).select("doc_id", "text").collect()
    got = {(r["doc_id"], b" ".join(WORD.findall((r["text"] or "").encode()))) for r in found}
    assert got == {(n, b" ".join(planted(n, t))) for n, t in rows}


def test_query_over_a_whole_table(spark):
    """All documents of the smallest set, from the definition."""
    from sievecraft.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for number, text in rows:
        _, n, start, length, period, exponent, listed, kept = expected((b" ".join(planted(number, text))).decode())
        digests = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
        want.append((number, n, start, length, period, exponent, *digests))
    found = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr) and any(x[1] for x in found)
