from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, d string, t int, r string, text_ string, mix_slot string"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows, with further columns of clashing names."""

    def make(rows):
        full = [(*row, *(None, None)[: 4 - len(row)], "x", 1, "y", "z", "w") for row in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return make


def words(number: int, seed: int) -> str:
    """Invented words that hardly repeat."""
    return " ".join(f"w{(k * 7919 + seed * 104729) % 1_000_003}" for k in range(number))
