from __future__ import annotations

import random

from sievecraft.llm import near_copies
from sievecraft.llm.common import NO_ID
from tests.llm.conftest import words


def brute(docs, width, percent):
    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())

    sets = [(number, shingles(text)) for number, text in docs if number is not None]
    parent = {number: number for number, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a != b and x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted((number, len(shingles(text)), find(number)) for number, text in docs if number is not None)


def run(docs, width=2, percent=80):
    rows = near_copies.near_copies(docs, width, percent).collect()
    return sorted((r["d"], r["n"], r["component"]) for r in rows if r["d"] != NO_ID), [r for r in rows if r["d"] == NO_ID]


def edited(text, number, random_):
    w = text.split()
    for _ in range(number):
        w[random_.randrange(len(w))] = f"e{random_.randrange(10**9)}"
    return " ".join(w)


def test_like_brute_force(documents):
    random_ = random.Random(3)
    docs, number = [], 0
    for group in range(12):
        base = words(random_.choice((4, 12, 60, 300)), group)
        for _ in range(random_.randint(1, 7)):
            docs.append((number, edited(base, random_.randint(0, max(1, len(base.split()) // 14)), random_)))
            number += 3
    docs += [(2, docs[0][1].upper()), (5, "one"), (8, "ONE"), (11, ""), (14, None), (17, " \n"), (20, docs[3][1]), (20, docs[3][1])]
    docs += [(23, docs[0][1]), (23, docs[-5][1] + " more"), (None, docs[0][1]), (None, None)]
    random_.shuffle(docs)
    found, nameless = run(documents(docs))
    assert found == brute(docs, 2, 80)
    assert len(nameless) == 2 and all(r["component"] == NO_ID for r in nameless)


def test_star_around_the_original(documents):
    """Copies that are all near the original and not near each other; the original has not the smallest id."""
    random_ = random.Random(8)
    base = words(200, 1)
    docs = [(k, edited(base, 9, random_)) for k in range(40) if k != 17] + [(17, base)]
    found, _ = run(documents(docs))
    assert found == brute(docs, 2, 80)
    assert {row[2] for row in found} == {0}


def test_links_that_miss_the_centre(documents, monkeypatch):
    """Hundreds of variants of one template, of which a few happen to be near each other; blocks of any size."""
    random_ = random.Random(5)
    base = words(100, 6).split()
    docs = []
    for k in range(400):
        changed = {p: f"x{p}" for p in range(0, 96, 4) if random_.random() < 0.5}
        docs.append((k, " ".join(changed.get(p, w) for p, w in enumerate(base))))
    want = brute(docs, 2, 80)
    assert 10 < len({row[2] for row in want}) < 400
    monkeypatch.setattr(near_copies, "SMALL", 16)
    for block in (1024, 30):
        monkeypatch.setattr(near_copies, "BLOCK", block)
        assert run(documents(docs))[0] == want


def test_one_stays(documents):
    base = words(50, 2)
    docs = documents([(4, base), (3, base + " end"), (9, words(50, 3)), (None, base), (1, None)])
    kept = near_copies.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3, 9, None]


def test_empty_table_and_long_text(documents):
    assert run(documents([])) == ([], [])
    long = words(200_000, 4)
    found, _ = run(documents([(1, long), (2, long + " x")]), 5)
    assert [row[2] for row in found] == [1, 1]
