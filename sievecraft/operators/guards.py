"""Checks of columns, rows and counts. Each raises `DataQualityError` with the offending numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sievecraft.errors import DataQualityError
from sievecraft.functions.text import casefold, identity_key
from sievecraft.operators.joins import hashed, lookup_join
from sievecraft.operators.search import found_needles


def select_required(df: DataFrame, columns: Sequence[str], label: str = "table") -> DataFrame:
    """The columns in the given order; one error lists all that are missing."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise DataQualityError(f"{label} is missing columns: {', '.join(missing)}")
    return df.select(*columns)


def not_null(column: Column, label: str) -> Column:
    return F.when(column.isNull(), F.raise_error(F.lit(f"{label} is null"))).otherwise(column)


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fixed column order and types. A null in a required column fails the query that reads it,
    so the check costs no pass of its own."""
    select_required(df, schema.names)
    columns = []
    for field in schema.fields:
        column = F.col(field.name).cast(field.dataType.simpleString())
        columns.append(
            (column if field.nullable else not_null(column, field.name)).alias(field.name)
        )
    return df.select(*columns)


def null_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows (column, nulls) for every required column of a schema, in one pass: what `enforce_schema` would fail on."""
    required = [field.name for field in schema.fields if not field.nullable]
    rows = select_required(df, schema.names)
    counts = rows.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required])
    return counts.unpivot([], required, "column", "nulls")


def shallow_histories(repositories: DataFrame) -> DataFrame:
    """The included repositories that are shallow: what `require_full_history` would fail on."""
    return repositories.filter((F.col("status") == "included") & F.col("shallow"))


def require_minimum(counts: Mapping[str, int], minimum: int, what: str) -> None:
    short = {name: count for name, count in counts.items() if count < minimum}
    if short:
        found = ", ".join(f"{name}: {count}" for name, count in short.items())
        raise DataQualityError(f"at least {minimum} {what} required; found {found}")


def require_none(df: DataFrame, what: str) -> None:
    count = df.count()
    if count:
        raise DataQualityError(f"{count} {what}")


def require_full_history(repositories: DataFrame) -> None:
    """No included repository may be shallow."""
    count, path = shallow_histories(repositories).agg(F.count("*"), F.min("path")).first()
    if count:
        raise DataQualityError(f"{count} shallow repository histories, for example {path}")


def leak_counts(rows: DataFrame) -> DataFrame:
    """One row: how many rows show the author's e-mail (in any case), the repository path, the
    commit hash or a remote in `subject` or `diff`. For rows that hold text and lineage side by
    side, so it moves no text. Blank and null needles are in no text; neither is scrubbed, so this
    is a number to report."""
    text = F.concat_ws("\n", "subject", "diff")

    def shown(needle: Column) -> Column:
        return F.coalesce((needle != "") & F.contains(text, needle), F.lit(False))

    email = identity_key(F.col("author_email"))
    folded = F.coalesce((email != "") & F.contains(casefold(text), email), F.lit(False))
    remote = F.coalesce(F.exists("remote_urls", shown), F.lit(False))
    return rows.agg(
        F.count_if(folded).alias("author_email_count"),
        F.count_if(shown(F.col("repository_path"))).alias("repository_path_count"),
        F.count_if(shown(F.col("commit_sha"))).alias("commit_sha_count"),
        F.count_if(remote).alias("remote_url_count"),
    )


def identity_leaks(candidates: DataFrame, provenance: DataFrame) -> DataFrame:
    """`leak_counts` of two tables that were read back; the lineage, whose rows are counted, is built
    into hash tables of bounded size, so that the texts are shuffled but not sorted."""
    names = ("id", "author_email", "repository_path", "commit_sha", "remote_urls")
    lineage = provenance.select(*names)
    return leak_counts(candidates.join(hashed(lineage, provenance.count(), "id"), "id"))


def identity_needles(provenance: DataFrame) -> DataFrame:
    """Distinct rows (id, kind, needle): what must not show of each row's lineage. E-mails are stripped and case-folded;
    blank and null values are left out."""
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), needle.alias("needle"))
            for kind, needle in (
                ("author_email", identity_key(F.col("author_email"))),
                ("repository_path", F.col("repository_path")),
                ("commit_sha", F.col("commit_sha")),
            )
        ]
    )
    remotes = F.transform(
        F.coalesce("remote_urls", F.array().cast("array<string>")),
        lambda url: F.struct(F.lit("remote_url").alias("kind"), url.alias("needle")),
    )
    rows = provenance.select("id", F.explode(F.concat(kinds, remotes)).alias("_n")).select("id", "_n.*")
    return rows.filter(F.col("needle") != "").distinct()


def shown_identities(candidates: DataFrame, provenance: DataFrame) -> DataFrame:
    """Rows (id, kind, needle, own): every private value of any lineage row that shows in a candidate's subject or diff.

    `own`: whether it belongs to the row's own lineage. E-mails are found in any letter case. All values are looked for in
    all texts; texts are not shuffled.
    """
    needles = identity_needles(provenance)
    text = F.concat_ws("\n", "subject", "diff")
    is_email = F.col("kind") == "author_email"
    kinds = needles.select("kind", "needle").distinct().persist(StorageLevel.DISK_ONLY)
    found = None
    for text_, which in ((casefold(text), is_email), (text, ~is_email)):
        some = kinds.filter(which)
        pairs = found_needles(candidates.select("id", text_.alias("text")), some)
        named = lookup_join(pairs, some, "needle", ["id"], "inner")
        found = named if found is None else found.unionByName(named)
    own = needles.withColumn("own", F.lit(True))
    marked = found.join(own, ["id", "kind", "needle"], "left")
    return marked.select("id", "kind", "needle", F.coalesce("own", F.lit(False)).alias("own"))


def shown_identity_counts(shown: DataFrame) -> DataFrame:
    """Per kind: rows that show any private value, rows that show one of another lineage, and distinct values shown."""
    per_row = shown.groupBy("kind", "id").agg(F.bool_or(~F.col("own")).alias("foreign"))
    rows = per_row.groupBy("kind").agg(F.count("*").alias("rows"), F.count_if("foreign").alias("foreign_rows"))
    values = shown.groupBy("kind").agg(F.count_distinct("needle").alias("needles"))
    return rows.join(values, "kind")


def lineage_integrity(candidates: DataFrame, provenance: DataFrame) -> DataFrame:
    """One row: ids on each side, ids without a partner and repeated ids. The pair is sound if
    the last three are zero."""
    left = candidates.groupBy("id").agg(F.count("*").alias("candidate_rows"))
    right = provenance.groupBy("id").agg(F.count("*").alias("provenance_rows"))
    both = left.join(right, "id", "full_outer")
    return both.agg(
        F.coalesce(F.sum("candidate_rows"), F.lit(0)).alias("candidates"),
        F.coalesce(F.sum("provenance_rows"), F.lit(0)).alias("provenance"),
        F.count_if(F.col("provenance_rows").isNull()).alias("without_provenance"),
        F.count_if(F.col("candidate_rows").isNull()).alias("without_candidate"),
        F.count_if((F.col("candidate_rows") > 1) | (F.col("provenance_rows") > 1)).alias(
            "repeated_ids"
        ),
    )
