"""Changed paths of a commit and what they say about it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievecraft.functions.paths import generated_path_regex, is_generated_path

COMMIT_KEY = ("repository_path", "commit_sha")


def parse_numstat(df: DataFrame, column: str = "numstat") -> DataFrame:
    """One row per changed path of NUL-separated `added⇥removed⇥path` entries.

    A dash in place of a number marks a binary file. An entry with fewer than three fields fails
    the query.
    """
    keys = [name for name in df.columns if name != column]
    entries = F.filter(F.split(F.col(column), "\u0000"), lambda entry: entry != "")
    fields = F.split(F.col("_entry"), "\t", 3)
    return df.select(*keys, F.explode(entries).alias("_entry")).select(
        *keys,
        fields[0].try_cast("int").alias("added"),
        fields[1].try_cast("int").alias("removed"),
        fields[2].alias("path"),
        ((fields[0] == "-") | (fields[1] == "-")).alias("is_binary"),
    )


def change_stats(changes: DataFrame, keys: tuple[str, ...] = COMMIT_KEY) -> DataFrame:
    """Per commit: number of changed paths, any binary one, all generated.

    The three aggregates are combined before the shuffle.
    """
    return changes.groupBy(*keys).agg(
        F.count("*").alias("path_count"),
        F.bool_or("is_binary").alias("has_binary"),
        F.bool_and(is_generated_path(F.col("path"))).alias("generated_only"),
    )


def inline_change_stats(numstat: Column) -> Column:
    """`change_stats` of a commit that carries its own numstat text: no child table, no shuffle.

    Works on whole entries; the search for one that is not generated ends at the first.
    """
    numbers = r"[^\t\x00]*\t[^\t\x00]*\t"
    start = r"(?:\A|\x00)"
    malformed = numstat.rlike(rf"{start}(?!{numbers}[^\x00])[^\x00]")
    component, ending = generated_path_regex()
    written = F.exists(
        F.split(numstat, "\u0000"),
        lambda entry: (entry != "")
        & ~entry.rlike(rf"(?:\A{numbers}|/){component}")
        & ~entry.rlike(ending),
    )
    return F.struct(
        F.when(malformed, F.raise_error(F.lit("a numstat entry needs 3 fields")))
        .otherwise(F.regexp_count(numstat, F.lit(r"[^\x00]+")))
        .cast("long")
        .alias("path_count"),
        numstat.rlike(rf"{start}(?:-\t|[^\t\x00]*\t-\t)").alias("has_binary"),
        (numstat.rlike(r"[^\x00]") & ~written).alias("generated_only"),
    )
