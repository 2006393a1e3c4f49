from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievecraft.llm import suffix_tree, texts
from sievecraft.llm.common import NO_ID

def learned():
    return F.col("doc_id") % 7 != 2


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_base_and_model(documents, monkeypatch, block):
    monkeypatch.setattr(suffix_tree, "BLOCK", block)
    random_ = random.Random(6)
    follow = {"a": "bc", "b": "ca", "c": "ab"}  # what follows depends on the word before
    docs = []
    for k in range(120):
        word, text = "a", []
        for _ in range(random_.randint(0, 40)):
            word = random_.choice(follow[word] + follow[word][0] * 8)
            text.append(word * 3 if random_.random() < 0.95 else f"rare{random_.randint(0, 50)}")
        docs.append((k, " ".join(text).upper() if k % 2 else "\n".join(text)))
    docs += [(200, None), (201, ""), (202, "unseen words only"), (None, "aaa bbb"), (3, docs[3][1]), (3, docs[3][1])]
    tokens = lambda x: [*(x or "").lower().split(), "<end>"]
    count = Counter(t for k, x in docs if k is not None and k % 7 != 2 for t in tokens(x))
    n, v = sum(count.values()), len(count)
    rows = suffix_tree.scored(documents(docs), learned()).collect()
    got = sorted(((r["d"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), r["train_tokens"]) for r in rows))
    assert got == sorted(
        (
            NO_ID if k is None else k,
            len(t := tokens(x)),
            sum(w in count for w in t),
            round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 6),
            n,
        )
        for k, x in docs
    )
    held = [r for r in rows if r["d"] % 7 == 2 and r["d"] < 200]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)


def test_empty_table_and_nothing_learned(documents):
    assert suffix_tree.scored(documents([]), learned()).count() == 0
    rows = suffix_tree.scored(documents([(2, "a b")]), learned()).collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"]) for r in rows] == [(3, 0, 0.0)]


def test_distributions_are_proper():
    """In every state, the symbols' probabilities add up to one, and so do the words of a symbol."""
    n = suffix_tree.SYMBOLS
    inside = np.ones(n)
    inside[:50] = np.arange(50, 0, -1)
    known = suffix_tree.Alphabet(np.zeros(0, np.uint64), np.zeros(0, np.int64), 500, 40, inside / inside.sum(), inside)
    random_ = np.random.default_rng(0)

    def row(last, older):
        count = random_.integers(1, 50, 5)
        return {"last": last, "older": older, "next": np.arange(last, last + 5).astype(np.uint8).tobytes(), "counts": count.astype(np.int64).tobytes()}

    model = suffix_tree.tree([row(1, -1), row(1, 2), row(3, -1)], known)
    assert np.allclose((10.0**model.log10.astype(float)).sum(axis=1), 1, atol=1e-4)
    assert model.state[1, 2] != model.state[1, 0] != 0 and model.state[1, 7] == model.state[1, 0] and model.state[9, 9] == 0


def test_divergence():
    parent = np.array([0.5, 0.5])
    assert suffix_tree.diverges(np.array([400, 10]), parent, 1000)
    assert not suffix_tree.diverges(np.array([205, 205]), parent, 1000)
    assert not suffix_tree.diverges(np.array([2, 0]), parent, 1000)


def test_tokens():
    hashes, _, owner, offsets = suffix_tree._tokens(pa.array(["A a", None, "x"]))
    assert hashes[0] == hashes[1] and hashes[2] == hashes[3] == hashes[5]
    assert owner.tolist() == [0, 0, 0, 1, 2, 2] and offsets.tolist() == [0, 3, 4, 6]


def plain_scores(docs):
    """Log10 probabilities of texts under the tree, from the definition. All words of the corpus are symbols of their own."""
    end = "<end>"
    tokens = lambda x: [*(x or "").lower().split(), end]
    spelled = {}

    def kind(word):
        if word == end:
            return 0
        if word not in spelled:
            spelled[word] = int(suffix_tree._tokens(pa.array([word]))[1][0]) + 1
        return spelled[word]

    def diverges(count, parent, corpus):
        total = sum(count.values())
        return sum(c * math.log(c / total / parent(x)) for x, c in count.items() if c) > 0.5 * len(count) * math.log(max(corpus, 2))

    def smoothed(count, parent):
        total, different = sum(count.values()), len(count)
        return lambda x: (count[x] + different * parent(x)) / (total + different)

    def walk(text):
        t = tokens(text)
        for k, word in enumerate(t):
            yield (t[k - 1] if k else end, t[k - 2] if k > 1 else end, word)

    train = [text for k, text in docs if k is not None and k % 7 != 2]
    seen = [x for text in train for x in walk(text)]
    n, count = len(seen), Counter(word for _, _, word in seen)
    assert len(count) - 1 <= suffix_tree.COMMON

    classes = suffix_tree.CLASSES
    whole = n + len(count) + classes
    root = lambda s: (count[s] + 1) / whole if isinstance(s, str) else 1 / whole  # noqa: E731  others: the class of unknown words
    symbol = lambda w: w if w in count else -kind(w)
    one, two = {}, {}
    for last, older, word in seen:
        one.setdefault(last, Counter())[word] += 1
        two.setdefault((last, older), Counter())[word] += 1
    plain = {k: Counter(v) for k, v in one.items()}
    share_of = lambda c: lambda x: c[x] / sum(c.values())
    kept = {k for k, c in two.items() if diverges(c, share_of(plain[k[0]]), n)}
    firsts = {k for k, c in one.items() if any(x[0] == k for x in kept) or diverges(c, root, n)}
    state = {k: smoothed(one[k], root) for k in firsts}
    # A longer context is smoothed with the state that its place had before: that of an end before the last word, if there is one.
    order = {k: int(texts.word_hashes(*_raw(k))[0].view(np.int64)) for k in count if k != end}
    best = sorted((w for w in count if w != end), key=lambda w: (-count[w], order[w]))
    number = {end: 0} | {w: 1 + k for k, w in enumerate(best)}
    grown = {}
    for last, older in sorted(kept, key=lambda k: (number[k[0]], number[k[1]])):
        grown[last, older] = smoothed(two[last, older], state[last])

    def symbols(last, older):
        last, older = symbol(last), symbol(older)
        return grown.get((last, older)) or state.get(last) or root

    kinds = Counter(kind(w) for _, _, w in seen)
    base = lambda x: (kinds[x] + 1) / (n + suffix_tree.KINDS)
    follow, after, longer = {}, {}, {}
    for last, older, word in seen:
        follow.setdefault(kind(last), Counter())[kind(word)] += 1
        after.setdefault(last, Counter())[kind(word)] += 1
        longer.setdefault((last, older), Counter())[kind(word)] += 1
    parent = {k: smoothed(c, base) for k, c in follow.items()}
    words = {w: smoothed(c, parent[kind(w)]) for w, c in after.items() if diverges(c, parent[kind(w)], n)}
    pairs = {k: smoothed(c, words[k[0]]) for k, c in longer.items() if k[0] in words and diverges(c, words[k[0]], n)}

    def chance(last, older, word):
        share, x = symbols(last, older), symbol(word)
        value = share(x)
        told = pairs.get((last, older)) or words.get(last)
        if told:
            same = sum(share(w) for w in count if kind(w) == kind(word)) + (share(-kind(word)) if word != end else 0)
            value *= told(kind(word)) / same
        return value

    return [sum(math.log10(chance(*x)) for x in walk(text)) for _, text in docs], len(words) + len(pairs)


def _raw(word):
    data, offsets = texts.text_bytes(pa.array([word]), True)
    starts, ends, _ = texts.words(data, offsets)
    return data, starts, ends


def corpus(number, seed):
    random_ = random.Random(seed)
    vocabulary = [a + b for a in "abcdef" for b in ("x", "yy", "zab", "")]
    docs = []
    for k in range(number):
        word, older, text = "ax", "ax", []
        for _ in range(random_.randint(0, 60)):
            pick = hash_of(word, older if word[0] in "ab" else "") if random_.random() < 0.8 else random_.randrange(10**6)
            older, word = word, vocabulary[pick % len(vocabulary)]
            text.append(word)
        docs.append((k, " ".join(text)))
    return docs


def hash_of(*words):
    import zlib

    return zlib.crc32("|".join(words).encode())


@pytest.mark.parametrize("block", [1 << 20, 3000])
def test_scores_are_those_of_the_definition(documents, monkeypatch, block):
    monkeypatch.setattr(suffix_tree, "BLOCK", block)
    docs = corpus(150, 4) + [(300, None), (303, "ax unseen cx byy"), (305, "q q q")]
    want, states = plain_scores(docs)
    assert states > 20
    rows = {r["d"]: r["score"] for r in suffix_tree.scored(documents(docs), learned()).collect()}
    assert np.allclose([rows[k] for k, _ in docs], want, rtol=1e-4, atol=1e-4)


def test_contexts_of_words_with_like_hashes_are_apart(documents):
    """Two words whose hashes begin with the same 16 bits, each with followers of its own two words on."""
    by_start = {}
    for k in range(10**4):
        word = f"w{k}"
        start = int(texts.word_hashes(*_raw(word))[0]) >> 48
        if start in by_start:
            break
        by_start[start] = word
    lines = [f"{by_start[start]} mone ax", f"{word} mone byy", "cx moon dzab"]
    docs = [(7 * k, " ".join(lines * 20)) for k in range(30)]
    want, states = plain_scores(docs)
    assert states > 3
    rows = {r["d"]: r["score"] for r in suffix_tree.scored(documents(docs), learned()).collect()}
    assert np.allclose([rows[k] for k, _ in docs], want, rtol=1e-4, atol=1e-4)


def test_states_of_parts(monkeypatch):
    random_ = np.random.default_rng(3)
    keys = np.unique(random_.integers(0, 40, 5000) << 24 | random_.integers(0, 3, 5000) << 8 | random_.integers(0, 129, 5000))
    seen, kinds = random_.integers(1, 90, len(keys)).astype(float), random_.integers(1, 129, 40)
    known = suffix_tree.kinds_of(np.full((suffix_tree.KINDS, suffix_tree.KINDS), 100.0))
    whole, states = suffix_tree.word_states(keys, seen, kinds, known)
    monkeypatch.setattr(suffix_tree, "PART_KEYS", 100)
    parts, of_parts = suffix_tree._states_of_parts(keys, seen, kinds, known, 16)
    assert np.array_equal(parts, whole) and of_parts == states > 0
    assert len(suffix_tree._states_of_parts(keys[:0], seen[:0], kinds, known, 16)[0]) == 0


def test_packed_numbers():
    random_ = np.random.default_rng(2)
    for values in ([], [0], [0, 0, 0], [2**64 - 1], [1, 2, 5], random_.integers(0, 2**54, 1001, np.uint64)):
        values = np.array(values, np.uint64)
        assert np.array_equal(suffix_tree._unbits(suffix_tree._bits(values)), values)
        assert np.array_equal(suffix_tree._risen(suffix_tree._rising(np.sort(values))), np.sort(values))
        small = values >> np.uint64(1)
        assert np.array_equal(suffix_tree._wide(suffix_tree._narrow(small), len(small)), small.astype(np.int64))


def test_states_of_words_grow_with_the_corpus():
    """Twice the corpus, with as many new words: about twice the states."""

    def states(parts):
        keys, seen, kinds = [], [], []
        random_ = np.random.default_rng(1)
        for part in range(parts):
            for word in range(200):
                kinds.append(1 + word % 100)
                follower = random_.permutation(100)[:3]
                keys += [(200 * part + word) << 24 | 7 << 8 | int(k) for k in np.sort(follower)]
                seen += [60, 30, 10]
        order = np.argsort(keys)
        counts = np.full((suffix_tree.KINDS, suffix_tree.KINDS), 100.0)
        known = suffix_tree.kinds_of(counts)
        return suffix_tree.word_states(np.array(keys)[order], np.array(seen, float)[order], np.array(kinds), known)

    (one, few), (two, many) = states(1), states(2)
    assert few >= 200 and many == 2 * few
    assert np.allclose(one, two[: len(one)]) and (one > 0).all()


def test_a_text_longer_than_a_block(documents, monkeypatch):
    monkeypatch.setattr(suffix_tree, "BLOCK", 1000)
    docs = [(0, "one two three " * 2000), (1, "two one"), (2, "three two one " * 500)]
    rows = {r["d"]: r for r in suffix_tree.scored(documents(docs), learned()).collect()}
    assert rows[0]["n_tokens"] == 6001 and rows[2]["n_known"] == 1501 and rows[0]["score"] / 6001 > -0.01
