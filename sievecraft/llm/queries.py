"""Registered queries of the operators, with SQL to compare against where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievecraft.llm import (
    alignment, common, contamination, forest, language, mixing, near_copies, pages, periods, recompression, suffix_dedup,
    suffix_tree, token_shards, vectors,
)
from sievecraft.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# Fixed values, as DuckDB's regex syntax writes them: white space; what is neither a letter, a digit nor above 127.
_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def real_id(column: str = "d"):
    return F.nullif(F.col(column), F.lit(common.NO_ID))


@query(
    "op9_decontamination",
    f"""WITH doc AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
         item AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark),
         win AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 12], ' ') AS s, least(len(w), 13) AS m
                 FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM item WHERE len(w) > 0)),
         sizes AS (SELECT DISTINCT m FROM win),
         place AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM doc),
         spot AS (SELECT doc_id, p, m, array_to_string(w[p:p + m - 1], ' ') AS s FROM place, sizes WHERE p + m - 1 <= len(w)),
         hit AS (SELECT doc_id, p, spot.m, item_id FROM spot JOIN win ON spot.s = win.s AND spot.m = win.m),
         covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit
                     FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY doc_id),
         listed AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
                    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)""",
)
def op9_decontamination(spark, sf_dir):
    found = contamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        real_id().alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contamination.is_contaminated().alias("contaminated"),
    )


@query(
    "op8_near_copies",
    f"""WITH doc AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
         shingle AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
                       ELSE list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) END) AS s FROM doc),
         sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
         both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingle x JOIN shingle y ON x.s = y.s
                   GROUP BY ALL HAVING a <> b),
         link AS (SELECT a, b FROM both_ JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
                  WHERE 100 * k >= 80 * (x.n + y.n - k))
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
           doc_id <= coalesce(m, doc_id) AS kept
    FROM doc LEFT JOIN sizes USING (doc_id) LEFT JOIN (
        WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
        SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)""",
)
def op8_near_copies(spark, sf_dir):
    found = near_copies.near_copies(table(spark, sf_dir, "documents"), width=2, percent=80)
    return found.select(
        real_id().alias("doc_id"),
        F.col("n").alias("n_shingles"),
        real_id("component").alias("component_id"),
        F.coalesce(real_id() == real_id("component"), F.lit(False)).alias("kept"),
    )


@query(
    "op7_exact_top_k",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
               FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
)
def op7_exact_top_k(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    found = vectors.exact_top_k(rows, rows.filter("vec_id % 50 = 0"), 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query(
    "op1_suffix_dedup",
    """WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
         part AS (SELECT doc_id, len(h) // 2 - 199 AS n, c, substr(h, 2 * c + 1, 1000) AS piece
                  FROM (SELECT *, unnest(range(0, len(h) // 2 - 199, 300)) AS c FROM doc WHERE len(h) >= 400)),
         win AS (SELECT doc_id, c + q AS p, md5(substr(piece, 2 * q + 1, 400)) AS k
                 FROM (SELECT *, unnest(range(0, least(300, n - c))) AS q FROM part)),
         again AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
         hit AS (SELECT doc_id, p, p - lag(p, 1, p - 201) OVER (PARTITION BY doc_id ORDER BY p) > 200 AS first
                 FROM win SEMI JOIN again USING (k)),
         run AS (SELECT doc_id, min(p) AS s, max(p) + 200 AS e FROM (
                   SELECT doc_id, p, sum(first::INTEGER) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM hit) GROUP BY doc_id, g),
         gap AS (SELECT doc_id, s, e, lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS next FROM run),
         kept AS (SELECT doc_id, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans,
                         substr(any_value(h), 1, 2 * min(s)) ||
                         string_agg(substr(h, 2 * e + 1, 2 * (coalesce(next, len(h) // 2) - e)), '' ORDER BY s) AS left_
                  FROM gap JOIN doc USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
           coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(left_, h))) AS kept_sha256
    FROM doc LEFT JOIN kept USING (doc_id)""",
)
def op1_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), digest=True)
    return found.select(
        real_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256")
    )


@query(
    "op10_recompression",
    f"""WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
         win AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h
                 FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM doc WHERE len(w) >= 50)),
         lows AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h),
         hit AS (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, unnest(range(p, p + 50)) AS q
                 FROM win JOIN lows USING (h) WHERE low < doc_id)),
         gone AS (SELECT doc_id, list(q) AS g FROM hit GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
           sha256(array_to_string(CASE WHEN g IS NULL THEN w ELSE
             list_transform(list_filter(list_transform(range(1, len(w) + 1), lambda i: [i, list_contains(g, i)::BIGINT]), lambda x: x[2] = 0), lambda x: w[x[1]]) END, ' ')) AS kept_sha256
    FROM doc LEFT JOIN gone USING (doc_id)""",
)
def op10_recompression(spark, sf_dir):
    found = recompression.without_repeats(table(spark, sf_dir, "documents"), digest=True)
    return found.select(
        real_id().alias("doc_id"), "n_words", "n_removed", F.lower(F.hex("kept")).alias("kept_sha256")
    )


def _fold(parts: int, column: str = "doc_id"):
    """Part of an id: CRC-32 of its decimal digits, modulo."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


@query("op3_language")
def op3_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    filters = language.learned(docs.filter(_fold(5) != 0))
    return language.predicted(docs, filters).select(
        real_id().alias("doc_id"),
        F.coalesce(_fold(5, "d") == 0, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


@query("op4_main_text")
def op4_main_text(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    return pages.extracted(rows, pages.learned(rows))


@query("op6_suffix_tree")
def op6_suffix_tree(spark, sf_dir):
    found = suffix_tree.scored(table(spark, sf_dir, "documents"), _fold(7) != 2)
    return found.select(
        real_id().alias("doc_id"),
        F.coalesce(_fold(7, "d") == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


WEIGHTS = {f"src{k}": 8 if k == 0 else 3 for k in range(20)}
_WEIGHT_ROWS = ", ".join(f"({k + 1}, '{name}', {w})" for k, (name, w) in enumerate([*WEIGHTS.items(), ("", 1)]))


@query(
    "op5_mixing",
    f"""WITH RECURSIVE weight(i, name, w) AS (VALUES {_WEIGHT_ROWS}),
         doc AS (SELECT doc_id, source, coalesce(i, {len(WEIGHTS) + 1}) AS i, row_number() OVER (
                   PARTITION BY coalesce(i, {len(WEIGHTS) + 1})
                   ORDER BY md5('0|' || doc_id || '|' || coalesce(text, ''))) - 1 AS place
                 FROM documents LEFT JOIN weight ON source = name),
         last AS (SELECT i, w, ceil(ceil(count(doc_id) / {mixing.BLOCK}) / w)::BIGINT AS periods
                  FROM weight LEFT JOIN doc USING (i) GROUP BY i, w),
         start AS (SELECT DISTINCT s FROM (SELECT 0 AS s UNION ALL SELECT periods FROM last)
                   WHERE s < (SELECT max(periods) FROM last)),
         phase AS (SELECT s, lead(s, 1, (SELECT max(periods) FROM last)) OVER (ORDER BY s) AS upto,
                          list(CASE WHEN periods > s THEN w ELSE 0 END ORDER BY i) AS w,
                          sum(CASE WHEN periods > s THEN w ELSE 0 END)::BIGINT AS total
                   FROM start, last GROUP BY s),
         based AS (SELECT *, coalesce(sum((upto - s) * total * {mixing.BLOCK}) OVER (
                     ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM phase),
         step(s, slot, w, total, done, pick) AS (
           SELECT s, -1::BIGINT, w, total, list_transform(w, lambda x: 0::BIGINT), NULL::BIGINT FROM phase
           UNION ALL
           SELECT s, slot + 1, w, total,
                  list_transform(done, lambda d, k: CASE WHEN k = best.i THEN d + 1 ELSE d END), best.i
           FROM (SELECT *, list_min(list_filter(list_transform(range(1, len(w) + 1), lambda k:
                     CASE WHEN done[k] < w[k] AND done[k] * total // w[k] <= slot + 1
                          THEN {{'due': ((done[k] + 1) * total + w[k] - 1) // w[k], 'i': k}} END),
                   lambda x: x IS NOT NULL)) AS best FROM step WHERE slot + 1 < total)),
         schedule AS (SELECT s, slot, pick AS i, done[pick] - 1 AS turn FROM step WHERE slot >= 0),
         placed AS (SELECT doc.*, w, place // {mixing.BLOCK} AS block FROM doc JOIN weight USING (i)),
         timed AS (SELECT doc_id, source, i, place, block // w AS period, block % w AS turn FROM placed)
    SELECT doc_id, source, period::BIGINT AS mix_period, slot::INTEGER AS mix_slot,
           (place % {mixing.BLOCK})::INTEGER AS mix_row,
           (base + ((period - s) * total + slot) * {mixing.BLOCK} + place % {mixing.BLOCK})::BIGINT AS mix_position
    FROM timed JOIN based ON period >= s AND period < upto JOIN schedule USING (s, i, turn)""",
)
def op5_mixing(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"), WEIGHTS).select(
        "doc_id", "source", "mix_period", "mix_slot", "mix_row", "mix_position"
    )


@query("op2_token_shards")
def op2_token_shards(spark, sf_dir):
    return token_shards.token_shards(table(spark, sf_dir, "documents"))


@query("op11_hash_forest")
def op11_hash_forest(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    found = forest.nearest(rows, rows.filter("vec_id % 20 = 0"), 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    planted = periods.with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periods.periodic_runs(planted, digest=True).select(
        real_id().alias("doc_id"),
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        F.sha2(F.col("runs").cast("binary"), 256).alias("runs_sha256"),
        F.lower(F.hex("kept")).alias("collapsed_sha256"),
    )


@query("op13_token_alignment")
def op13_token_alignment(spark, sf_dir):
    found = alignment.aligned(table(spark, sf_dir, "documents"))
    return found.select(
        real_id().alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
