"""Counts, summaries and digests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from sievecraft.functions.text import (
    canonical_json,
    changed_files,
    guess_language,
    identity_key,
    text_length,
)
from sievecraft.schemas import CANDIDATES

DIGEST_PREFIX = 4  # hex digits of a SHA-256 value by which `sorted_digest` groups
LANES = 16  # of 16 bits, in a SHA-256 value


def rejection_counts(decided: DataFrame) -> DataFrame:
    """Rows per reason, for the reasons that occur. `reason` is null on accepted rows."""
    return (
        decided.filter(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count("*").alias("rejected"))
        .orderBy("reason")
    )


def build_totals(decided: DataFrame) -> DataFrame:
    """One row: accepted, rejected and inspected."""
    return decided.agg(
        F.count_if(F.col("reason").isNull()).alias("accepted"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        F.count("*").alias("inspected"),
    )


def author_pairs(
    commits: DataFrame, group: str = "repository_path", email: str = "author_email"
) -> DataFrame:
    """Commits per group and normalised author: the one pass behind every author count."""
    return commits.groupBy(group, identity_key(F.col(email)).alias("author")).agg(
        F.count("*").alias("commits")
    )


def group_counts(pairs: DataFrame, group: str = "repository_path") -> DataFrame:
    """Commits and distinct non-blank authors per group."""
    return pairs.groupBy(group).agg(
        F.sum("commits").alias("commit_count"),
        F.count_if(F.col("author") != "").alias("author_email_count"),
    )


def distinct_authors(pairs: DataFrame) -> DataFrame:
    """One row: distinct non-blank authors over all groups, which is not the sum per group."""
    # Not as a filter, which would be pushed into the commits and ask for a scan of its own.
    named = F.when(F.col("author") != "", F.col("author"))
    return pairs.agg(F.count_distinct(named).alias("author_email_count"))


_DIGITS = 14  # of an instant without its punctuation


def _as_number(instant: Column) -> Column:
    return F.translate(instant, "-T:Z", "").cast("long")


def _as_instant(number: Column) -> Column:
    text = F.lpad(number.cast("string"), _DIGITS, "0")
    parts = [F.substring(text, at, size) for at, size in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))]
    return F.when(
        number.isNotNull(),
        F.concat(
            parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2], F.lit("T"),
            parts[3], F.lit(":"), parts[4], F.lit(":"), parts[5], F.lit("Z"),
        ),
    )


_LEAST_AND_MOST = ("subject_length", "diff_length", "instant")


def _narrow(splits: DataFrame, *more: Column) -> DataFrame:
    """What a summary needs of a row, in numbers: neither a text nor an instant as text takes part
    in an aggregate, so nothing is sorted."""
    return splits.select(
        "split",
        "repository_group_id",
        text_length(F.col("subject")).alias("subject_length"),
        text_length(F.col("diff")).alias("diff_length"),
        _as_number(F.col("committed_at_utc")).alias("instant"),
        *more,
    )


def _ranges() -> list[Column]:
    return [
        edge(name).alias(f"{label}_{name}")
        for name in _LEAST_AND_MOST
        for label, edge in (("min", F.min), ("max", F.max))
    ]


def _range_columns() -> list[Column]:
    def pair(name: str, low: str, high: str, form=lambda column: column) -> Column:
        ends = (form(F.col(f"{label}_{name}")) for label in ("min", "max"))
        return F.struct(*(end.alias(label) for end, label in zip(ends, (low, high))))

    return [
        pair("subject_length", "min", "max").alias("subject_length"),
        pair("diff_length", "min", "max").alias("diff_length"),
        pair("instant", "first", "last", _as_instant).alias("date_range"),
    ]


def split_summary(splits: DataFrame) -> DataFrame:
    """Per split: rows, length and date ranges, distinct repositories."""
    counted = _narrow(splits).groupBy("split").agg(
        F.count("*").alias("rows"),
        *_ranges(),
        F.count_distinct("repository_group_id").alias("repository_groups"),
    )
    return counted.select("split", "rows", *_range_columns(), "repository_groups")


def split_summary_with_languages(splits: DataFrame) -> DataFrame:
    """`split_summary` and `language_maps` in one pass over the diffs.

    A row counts once under no language, and once more for each changed file under the file's.
    """
    languages = F.transform(changed_files(F.col("diff")), guess_language)
    marks = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(languages, F.array()))
    rows = _narrow(splits, F.explode(marks).alias("language"))
    itself = F.col("language").isNull()
    parts = rows.groupBy("split", "language").agg(
        F.count("*").alias("n"),
        *_ranges(),
        F.count_distinct(F.when(itself, F.col("repository_group_id"))).alias("groups"),
    )
    files = F.collect_list(F.when(~itself, F.struct("language", F.col("n").alias("files"))))
    whole = parts.groupBy("split").agg(
        F.max(F.when(itself, F.col("n"))).alias("rows"),
        *(
            F.max(F.when(itself, F.col(f"{label}_{name}"))).alias(f"{label}_{name}")
            for name in _LEAST_AND_MOST
            for label in ("min", "max")
        ),
        F.max("groups").alias("repository_groups"),
        F.map_from_entries(F.sort_array(files)).alias("languages"),
    )
    return whole.select("split", "rows", *_range_columns(), "repository_groups", "languages")


def language_counts(splits: DataFrame) -> DataFrame:
    """Changed files per split and language; a row with two changed files counts twice."""
    files = splits.select("split", F.explode(changed_files(F.col("diff"))).alias("file"))
    return files.groupBy("split", guess_language(F.col("file")).alias("language")).agg(
        F.count("*").alias("files")
    )


def language_maps(splits: DataFrame) -> DataFrame:
    """`language_counts` as one map per split; its size is bounded by the table of languages."""
    entries = F.collect_list(F.struct("language", "files"))
    return (
        language_counts(splits)
        .groupBy("split")
        .agg(F.map_from_entries(F.sort_array(entries)).alias("languages"))
    )


def split_counts(splits: DataFrame) -> DataFrame:
    return splits.groupBy("split").agg(F.count("*").alias("rows"))


def hash_sums(hashes: DataFrame, *by: str, column: str = "row_hash") -> DataFrame:
    """Rows (*by, rows, sums): a multiset of SHA-256 values as their number and their sum modulo 2**256.

    `sums` holds the sum in lanes of 16 bits, not yet carried, so that sums of parts add up lane by lane: partial
    aggregates merge, and so do the sums of files that were added later. A task holds one row per group, whatever the
    data look like; lanes are exact up to 2**47 rows. An empty multiset without `by` is a row of zeros.
    """
    lanes = [F.conv(F.substring(column, 4 * k + 1, 4), 16, 10).cast("long") for k in range(LANES)]
    totals = [F.coalesce(F.sum(lane), F.lit(0)) for lane in lanes]
    return hashes.groupBy(*by).agg(F.count(column).alias("rows"), F.array(*totals).alias("sums"))


def merged_sums(parts: DataFrame, *by: str) -> DataFrame:
    """`hash_sums` of the union of the multisets whose sums these are."""
    totals = [F.coalesce(F.sum(F.col("sums")[k]), F.lit(0)) for k in range(LANES)]
    rows = F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    return parts.groupBy(*by).agg(rows, F.array(*totals).alias("sums"))


def sums_digest(header: str) -> Column:
    """SHA-256 over a header, the number of rows and the carried sum, of the columns `rows` and `sums`."""
    zero = F.struct(F.lit(0).cast("long").alias("carry"), F.lit("").alias("hex"))

    def add(total: Column, lane: Column) -> Column:
        value = lane + total["carry"]
        digits = F.lower(F.lpad(F.hex(value.bitwiseAND(F.lit(0xFFFF))), 4, "0"))
        return F.struct(F.shiftright(value, 16).alias("carry"), F.concat(digits, total["hex"]).alias("hex"))

    carried = F.aggregate(F.reverse("sums"), zero, add)["hex"]
    return F.sha2(F.concat(F.lit(header), F.col("rows").cast("string"), F.lit(":"), carried), 256)


def set_digest(hashes: DataFrame, header: str, column: str = "row_hash") -> DataFrame:
    """One row with `digest` over a header and a multiset of SHA-256 values.

    The values are added up, so nothing is sorted or gathered, and the digest of a union follows from the sums of its
    parts (`hash_sums`, `merged_sums`, `sums_digest`). Made to notice change and damage; against someone who searches
    for other rows with the same sum it is weaker than a hash of all rows in sequence.
    """
    return hash_sums(hashes, column=column).select(sums_digest(header).alias("digest"))


def sorted_digest(hashes: DataFrame, header: str, column: str = "row_hash") -> DataFrame:
    """One row with `digest`: SHA-256 over a header and all SHA-256 values in sorted order, on two levels.

    The values are grouped by their own leading hex digits, which spreads them evenly whatever the data look like, and
    each group is hashed in sorted order; the second level hashes the 65,536 group digests at most. A group is one string
    while it is hashed, which bounds the rows: two billion characters are 2e12 rows in all. Unlike the sums of
    `set_digest`, it is as hard to forge as the hash itself.
    """
    leaf = F.sha2(F.array_join(F.sort_array(F.collect_list(column)), ""), 256)
    groups = hashes.groupBy(F.substring(column, 1, DIGEST_PREFIX).alias("prefix")).agg(leaf.alias("leaf"))
    leaves = F.sort_array(F.collect_list(F.struct("prefix", "leaf")))
    joined = F.array_join(F.transform(leaves, lambda item: item["leaf"]), "")
    return groups.agg(F.sha2(F.concat(F.lit(header), joined), 256).alias("digest"))


def row_hashes(rows: DataFrame, *names: str) -> DataFrame:
    """SHA-256 of the canonical JSON of each row, as `row_hash`."""
    return rows.select(F.sha2(canonical_json(*(names or rows.columns)), 256).alias("row_hash"))


def _bounds(since: str | None, until: str | None) -> str:
    return json.dumps({"since": since, "until": until}, separators=(",", ":"))


def dataset_fingerprint(
    rows: DataFrame, since: str | None = None, until: str | None = None
) -> DataFrame:
    """One row with `digest` over the date bounds and the canonical JSON of every row.

    Row order is a function of the rows (instant, then id), so the set of rows stands for their
    sequence: equal digests mean equal rows in equal order.
    """
    return set_digest(row_hashes(rows, *CANDIDATES.names), _bounds(since, until))


def sorted_fingerprint(rows: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """One row with `digest`: as `dataset_fingerprint`, but every row's hash is hashed again, none is added up."""
    return sorted_digest(row_hashes(rows, *CANDIDATES.names), _bounds(since, until))
