"""Joins of a large table with a lookup table of unknown size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# At most HOT_KEYS keys can each hold more than 1/HOT_KEYS of the rows.
HOT_KEYS = 1_000


# Rows of a hash table that one task builds, about: a few hundred megabytes of keys and narrow columns.
HASHED_ROWS = 2_000_000


def hashed(df: DataFrame, rows: int, *on: str) -> DataFrame:
    """`df`, of a known number of rows and with nearly unique keys, as the side of a join that is built into hash tables.

    A hash table cannot spill, so there are as many partitions as keep it within HASHED_ROWS; the other side, which is
    shuffled to match, is neither sorted nor bounded.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(usual, -(-rows // HASHED_ROWS)), *on).hint("shuffle_hash")


def small_row_count(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> int | None:
    """Rows of a table that is within the bound for a broadcast, else None.

    Measures the table itself by one distributed aggregate: each task sends a count and a sum.
    """
    size = F.octet_length(F.to_json(F.struct("*")))
    rows, chars = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows if rows <= max_rows and chars <= max_bytes else None


def hot_keys_of(facts: DataFrame, on: str, hot_keys: int = HOT_KEYS) -> list:
    """The keys, null left out, that hold more than 1/`hot_keys` of the rows; fewer than `hot_keys`.

    One pass: the grand total comes from the same aggregate as the counts per key.
    """
    counts = facts.rollup(on).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
    largest = counts.orderBy(F.desc("n"), F.desc("level")).limit(hot_keys + 2).collect()
    total = next((row["n"] for row in largest if row["level"]), 0)
    return [
        row[0]
        for row in largest
        if not row["level"] and row[0] is not None and row["n"] * hot_keys > total
    ]


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    spread: list[str | Column],
    how: str = "left",
    small: bool | None = None,
    hot_keys: int = HOT_KEYS,
    hot: list | None = None,
) -> DataFrame:
    """Equi-join on a key that is unique in `lookup` and may be heavily skewed in `facts`.

    A lookup within the measured bound is broadcast. Otherwise both sides are shuffled, and the
    keys that hold more than 1/`hot_keys` of the facts are spread over that many salts, chosen by a
    hash of the `spread` columns; only those few lookup rows are repeated. Null keys, which match
    nothing, are spread alike. No row is lost either way. `small` passes on the outcome of a
    measurement already made, `hot` the keys to be spread, else found by a pass over the facts.
    """
    if small is None:
        small = small_row_count(lookup) is not None
    if small:
        return facts.join(F.broadcast(lookup), on, how)

    hot = hot_keys_of(facts, on, hot_keys) if hot is None else hot
    is_hot = F.coalesce(F.col(on).isin(hot), F.lit(False)) if hot else F.lit(False)
    cold_salt = F.lit(0).cast("long")
    salted = facts.withColumn(
        "_salt",
        F.when(
            is_hot | F.col(on).isNull(), F.pmod(F.xxhash64(*spread), F.lit(hot_keys))
        ).otherwise(cold_salt),
    )
    repeated = lookup.withColumn(
        "_salt",
        F.explode(
            F.when(is_hot, F.sequence(cold_salt, F.lit(hot_keys - 1).cast("long"))).otherwise(
                F.array(cold_salt)
            )
        ),
    )
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")
