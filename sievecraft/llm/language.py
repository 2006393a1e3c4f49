"""Language prediction with bit-sliced Bloom filters of n-grams.

One table of bit masks serves WORD languages: bit l of the mask at a position belongs to the Bloom filter of language l, so
a few lookups return the set of all languages that hold an n-gram. There are as many tables as the languages need. A text's n-grams are counted for each language, the
counts are corrected for false positives, and the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sievecraft.llm import texts
from sievecraft.llm.common import id_key, keyed_texts

GRAM = 4  # bytes of an n-gram
SAMPLE = 4000  # training texts of a language, about; taken by a hash of the id
GRAMS = 20_000  # most frequent n-grams of a language that enter its filter
WORD = 64  # languages of a table; one bit each
LEAST = 0.01  # share of a language's training texts that must hold an n-gram
BITS, PROBES = 20, 3

NONE = "und"


@dataclass
class Filters:
    names: list[str]
    masks: np.ndarray  # for each WORD languages a row of 2^BITS masks, bit l % WORD of row l // WORD for language l
    false: np.ndarray  # false-positive rate of each language


def _grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts, as numbers, and the text of each."""
    data, offsets = texts.text_bytes(column)
    every = np.ndarray((len(data) - GRAM + 1,), np.dtype("<u4"), data, 0, (1,))
    count = np.maximum(np.diff(offsets) - GRAM + 1, 0)
    owner = np.repeat(np.arange(len(count)), count)
    at = offsets[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return every[at].astype(np.uint64), owner


def _probes(grams: np.ndarray) -> list[np.ndarray]:
    hashes = texts.mix(grams)
    return [(hashes >> np.uint64(1 + BITS * k) & np.uint64((1 << BITS) - 1)).astype(np.int64) for k in range(PROBES)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each language that hold each n-gram, for the texts of one slice."""
    for batch in texts.slices(batches):
        grams, owner = _grams(batch.column("text"))
        language = batch.column("l").to_numpy()
        pairs = np.unique(grams | owner.astype(np.uint64) << np.uint64(32))
        held = pairs & np.uint64(0xFFFFFFFF) | language[(pairs >> np.uint64(32)).astype(np.int64)].astype(
            np.uint64
        ) << np.uint64(32)
        keys, count = np.unique(held, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((keys >> np.uint64(32)).astype(np.int32)),
                pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                pa.array(count),
            ],
            names=["l", "gram", "c"],
        )


def _padded() -> Column:
    """Texts in lower case between blanks, so that short ones have n-grams, too."""
    return F.concat(F.lit(" "), F.lower("text"), F.lit(" "))


def learned(labelled: DataFrame, id_column: str = "doc_id") -> Filters:
    """Filters from the columns id, text and lang of labelled rows; rows without a text or language are left out.

    About SAMPLE texts of each language, chosen by a hash of the id, are read in whole; of these the GRAMS most frequent
    n-grams that at least LEAST of the texts hold. Both bounds keep what the driver gathers independent of the input.
    """
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {row["lang"]: row["n"] for row in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(sizes)
    masks = np.zeros((-(-len(names) // WORD), 1 << BITS), np.uint64)
    if not names:
        return Filters(names, masks, np.zeros(0))
    share = F.create_map(*(F.lit(x) for name in names for x in (name, SAMPLE / sizes[name])))
    place = F.create_map(*(F.lit(x) for k, name in enumerate(names) for x in (name, k)))
    draw = F.pmod(F.xxhash64(F.col(id_column), F.lit(1)), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.filter(draw < share[F.col("lang")]).select(
        place[F.col("lang")].cast("int").alias("l"), _padded().alias("text")
    )
    counts = sample.mapInArrow(_count, "l int, gram long, c long").groupBy("l", "gram").agg(F.sum("c").alias("c"))
    drawn = {row["l"]: row["n"] for row in sample.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    least = F.create_map(*(F.lit(x) for k in range(len(names)) for x in (k, max(1.0, LEAST * drawn.get(k, 0)))))
    frequent = counts.filter(F.col("c") >= least[F.col("l")])
    # Ranked within each language in one job; a task keeps at most GRAMS of each before the shuffle.
    order = Window.partitionBy("l").orderBy(F.desc("c"), "gram")
    top = frequent.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= GRAMS).select("l", "gram").toArrow()
    number, gram = (column.to_numpy() for column in top.columns)
    for k in range(len(names)):
        for at in _probes(gram[number == k].astype(np.uint64)):
            masks[k // WORD, at] |= np.uint64(1 << k % WORD)
    ones = np.array([np.count_nonzero(masks[k // WORD] >> np.uint64(k % WORD) & np.uint64(1)) for k in range(len(names))])
    return Filters(names, masks, (ones / masks.shape[1]) ** PROBES)


def shares(column: pa.Array, filters: Filters) -> np.ndarray:
    """For each text and language, the share of the text's n-grams that the language holds, corrected."""
    grams, owner = _grams(column)
    probes = _probes(grams)
    total = np.bincount(owner, minlength=len(column))
    out = np.zeros((len(column), len(filters.names)))
    for k in range(len(filters.names)):
        if k % WORD == 0:
            held = filters.masks[k // WORD, probes[0]]
            for at in probes[1:]:
                held &= filters.masks[k // WORD, at]
        hit = np.bincount(owner[(held >> np.uint64(k % WORD) & np.uint64(1)).astype(bool)], minlength=len(column))
        raw = hit / np.maximum(total, 1)
        out[:, k] = np.maximum((raw - filters.false[k]) / (1 - filters.false[k]), 0) if filters.false[k] < 1 else 0
    return out


def _predict(broadcast):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = broadcast.value
        for batch in texts.slices(batches):
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            if filters.names:
                found = shares(batch.column("text"), filters)
                best = found.argmax(axis=1)
                score = np.where(letters, found[np.arange(len(best)), best], 0.0)
                names = [filters.names[k] if known else NONE for k, known in zip(best.tolist(), letters)]
            else:
                score, names = np.zeros(batch.num_rows), [NONE] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), batch.column("t"), pa.array(names, pa.string()), pa.array(score)],
                names=["d", "t", "lang_pred", "score"],
            )

    return predict


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predicted(docs: DataFrame, filters: Filters) -> DataFrame:
    """Rows (d, t, lang_pred, score), one for each row of `docs`, from its whole text alone.

    score: the corrected share of the text's n-grams that the language holds, 0 to 1; ties go to the first name. A null
    text and one without a letter are `und` with score 0, and all are if nothing was learned.
    """
    rows = keyed_texts(docs).select("d", "t", _padded().alias("text"), has_letter(F.col("text")).alias("letters"))
    broadcast = docs.sparkSession.sparkContext.broadcast(filters)
    return rows.mapInArrow(_predict(broadcast), "d long, t long, lang_pred string, score double")


def understood(docs: DataFrame, filters: Filters, least: float = 0.05) -> DataFrame:
    """`docs` without texts that are in no language: null ones, ones without a letter, and ones of which a share below
    `least` of the n-grams is known in any."""
    rejected = predicted(docs, filters).filter((F.col("lang_pred") == NONE) | (F.col("score") < least))
    keys = rejected.select(F.col("d").alias("_d"), F.col("t").alias("_t")).distinct()
    here = (id_key("doc_id") == keys["_d"]) & (F.xxhash64("text") == keys["_t"])
    return docs.join(keys, here, "left_anti")
