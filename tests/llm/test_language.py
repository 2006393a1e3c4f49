from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from sievecraft.llm import language

SYLLABLES = {"aa": ["tha", "ing", "er", "on", "sh"], "bb": ["eau", "oué", "ré", "oi", "que"], "cc": ["zu", "sch", "ung", "ä", "keit"]}


def text(name, number, random_):
    return " ".join("".join(random_.choice(SYLLABLES[name]) for _ in range(random_.randint(1, 3))) for _ in range(number))


def corpus(seed, rows):
    random_ = random.Random(seed)
    names = [random_.choice(list(SYLLABLES)) for _ in range(rows)]
    return [(k, text(name, random_.randint(3, 60), random_), name) for k, name in enumerate(names)]


def test_held_out_accuracy_and_cases(documents):
    train = corpus(1, 300)
    filters = language.learned(documents([*train, (900, None, "aa"), (901, "x", None)]))
    assert filters.names == ["aa", "bb", "cc"]
    test = corpus(2, 100)
    odd = [(200, None, None), (201, "", None), (202, "12 %% 3", None), (203, "Ä", None), (204, "THAING " * 50_000, None)]
    rows = {r["d"]: r for r in language.predicted(documents(test + odd), filters).collect()}
    assert sum(rows[k]["lang_pred"] == name for k, _, name in test) >= 97
    assert [rows[k]["lang_pred"] for k in (200, 201, 202)] == [language.NONE] * 3
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert rows[203]["lang_pred"] in filters.names and rows[204]["lang_pred"] == "aa"


def test_filters_like_brute_force(documents):
    """Without false positives the shares are those of plain sets."""
    train = corpus(3, 60)
    filters = language.learned(documents(train))
    grams = {}
    for _, body, name in train:
        raw = f" {body} ".lower().encode()
        for g in {raw[i : i + language.GRAM] for i in range(len(raw) - language.GRAM + 1)}:
            grams.setdefault(name, {}).setdefault(g, 0)
            grams[name][g] += 1
    body = " thaing ouéque "
    raw = body.encode()
    own = [raw[i : i + language.GRAM] for i in range(len(raw) - language.GRAM + 1)]
    want = [sum(g in grams[name] for g in own) / len(own) for name in filters.names]
    found = language.shares(pa.array([body]), filters)[0]
    assert np.allclose(found, want, atol=0.02)


def test_more_languages_than_bits_of_a_mask(documents):
    names = [f"l{k:02}" for k in range(67)]
    bodies = [" ".join(f"{chr(0x4E00 + 9 * k + i)}{chr(0x4E00 + 9 * k + j)}" for i in range(9) for j in range(9)) for k in range(67)]
    filters = language.learned(documents([(k, body, name) for k, (body, name) in enumerate(zip(bodies, names))]))
    assert filters.names == names
    rows = {r["d"]: r for r in language.predicted(documents([(k, body) for k, body in enumerate(bodies)]), filters).collect()}
    assert [rows[k]["lang_pred"] for k in range(67)] == names and all(r["score"] > 0.9 for r in rows.values())


def test_nothing_learned_and_empty_table(documents):
    filters = language.learned(documents([]))
    rows = language.predicted(documents([(1, "abc")]), filters).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [(language.NONE, 0.0)]
    assert language.predicted(documents([]), filters).count() == 0


def test_rejected_documents_go(documents):
    train = documents(corpus(4, 100))
    docs = documents([(1, "tha ing er onsh"), (2, None), (3, "123"), (3, "oi que"), (None, "zu schung")])
    kept = language.understood(docs, language.learned(train))
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == [(1, "tha ing er onsh"), (3, "oi que"), (None, "zu schung")]


def test_jobs_do_not_grow_with_languages(spark, documents):
    def jobs(number):
        rows = [(k, f"wort{k % number}x und{k % number} {k}", f"l{k % number:02d}", "s") for k in range(4 * number)]
        table = documents(rows).cache()
        table.count()
        spark.sparkContext.setJobGroup(f"languages {number}", "")
        try:
            language.learned(table)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"languages {number}"))

    assert jobs(2) == jobs(70)


def test_repeated_rows(spark, documents):
    rows = [(1, "the text", "en", "s")] * 3 + [(2, "der text", "de", "s"), (1, "der satz", "de", "s")]
    found = language.predicted(documents(rows), language.learned(documents(rows))).collect()
    assert sorted((r["d"], r["lang_pred"]) for r in found) == [(1, "de"), (1, "en"), (1, "en"), (1, "en"), (2, "de")]
