from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from sievecraft.llm import alignment, texts
from sievecraft.llm.token_shards import vocabulary


@pytest.fixture(scope="module")
def encoders():
    """Both libraries, and the bytes of their tokens, by other means than the operator's."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    first = Tokenizer.from_file(alignment.FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=alignment.SECOND)
    letters = {c: b for b, c in _characters().items()}

    def a(text):
        ids = first.encode(" " + text, add_special_tokens=False).ids
        return ids, [bytes(letters[c] for c in first.id_to_token(i)) for i in ids]

    def b(text):
        ids = second.encode(text)
        pieces = [second.id_to_piece(i) for i in ids]
        return ids, [
            bytes.fromhex(p[3:5]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, pieces)
        ]

    assert decoders.ByteLevel
    return a, b


def _characters():
    out, extra = {}, 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            out[byte] = chr(byte)
        else:
            out[byte] = chr(256 + extra)
            extra += 1
    return out


def brute(encoders, rows):
    a, b = encoders
    out, links = [], []
    for number, text in rows:
        own = []
        groups, sizes = "", (0, 0, 0)
        if text:
            (x, x_bytes), (y, y_bytes) = a(text), b(text)
            if b"".join(x_bytes) == b"".join(y_bytes) == (" " + text).encode():
                x_ends, y_ends = np.cumsum([len(p) for p in x_bytes]), np.cumsum([len(p) for p in y_bytes])
                shared = sorted(set(x_ends.tolist()) & set(y_ends.tolist()))
                parts, i, j = [], 0, 0
                for cut in shared:
                    to_i, to_j = bisect_left(x_ends, cut) + 1, bisect_left(y_ends, cut) + 1
                    parts.append(",".join(map(str, x[i:to_i])) + "|" + ",".join(map(str, y[j:to_j])))
                    own.append((x[to_i - 1], y[to_j - 1]))
                    i, j = to_i, to_j
                groups, sizes = ";".join(parts), (len(x), len(y), len(parts))
        out.append((number, *sizes, groups))
        links.append(own)
    counts = Counter(p for own in links for p in own)
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (number, n_a, n_b, n, len(own), sum(counts[p] == highest[p[1]] for p in own), sum(counts[p] for p in own), groups)
        for (number, n_a, n_b, n, groups), own in zip(out, links)
    ]


COLUMNS = ("d", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")

ROWS = [
    (1, "The quick brown fox"),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "<|endoftext|> and <s> or </s><unk> are plain"),
    (6, "naïve café – 漢字かな ไทย 👩‍👩‍👧 ﷽"),
    (7, "tabs\tand\n\nlines\r\n   spaces  "),
    (8, "The quick brown fox"),
    (8, "The quick brown fox"),
    (None, "a"),
    (9, "▁ a lower one eighth block"),
    (10, "\x00\x01\x7f    "),
    (11, "don't we'll 1234567 x=1;y==2"),
    (12, "word " * 2000 + "漢" * 500),
]


@pytest.mark.parametrize("chunk", [texts.CHUNK, 30])
def test_documents(spark, documents, monkeypatch, encoders, chunk):
    monkeypatch.setattr(texts, "CHUNK", chunk)
    found = alignment.aligned(documents(ROWS), digest=False).collect()
    got = sorted((tuple(r[c] if c != "groups" else r[c] or "" for c in COLUMNS) for r in found), key=repr)
    want = [(-(1 << 63) if x[0] is None else x[0], *x[1:]) for x in brute(encoders, ROWS)]
    assert got == sorted(want, key=repr)
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["n_a"] else "") for r in found)


def test_digest_is_that_of_the_groups(spark, documents):
    plain = alignment.aligned(documents(ROWS), digest=False).select("d", "n_best", "count_sum", "groups_sha256")
    short = alignment.aligned(documents(ROWS)).select("d", "n_best", "count_sum", "groups_sha256")
    assert sorted(plain.collect()) == sorted(short.collect())


def test_empty_table(spark, documents):
    assert alignment.aligned(documents([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_the_first_is_that_of_its_library(encoders, text):
    pair = alignment.tokenisers(vocabulary(alignment.FIRST), vocabulary(alignment.SECOND))
    assert pair._first.encode_ordinary(" " + text) == encoders[0](text)[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 40)), st.sets(st.integers(1, 40)), st.integers(41, 50)), max_size=4))
def test_shared_cuts(parts):
    a, b, last, base = [], [], [], 0
    for x, y, size in parts:
        a += [base + e for e in sorted(x | {size})]
        b += [base + e for e in sorted(y | {size})]
        last.append(len(a) - 1)
        base += size
    got = alignment.shared_cuts(*(np.array(x, np.int64) for x in (a, b, last)))
    assert got.tolist() == [k for k, e in enumerate(a) if e in set(b)]


def test_long_texts_without_cuts():
    """No common end inside: one leaf, found in passes over the ends, not in all pairs of them."""
    a, b = np.arange(2, 40_002, 2), np.append(np.arange(1, 40_001, 2), 40_000)
    assert alignment.shared_cuts(a, b, np.array([len(a) - 1])).tolist() == [len(a) - 1]


def test_query_over_a_whole_table(spark, encoders):
    from sievecraft.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*x[:-1], hashlib.sha256(x[-1].encode()).hexdigest() if x[1] else "") for x in brute(encoders, rows)]
    found = [tuple(r) for r in QUERIES["op13_token_alignment"](spark, sf_dir).collect()]
    assert sorted(found) == sorted(want)
