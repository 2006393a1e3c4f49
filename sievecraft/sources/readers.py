"""Readers. Each returns a lazy DataFrame; a missing path fails with Spark's own error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sievecraft.functions.text import canonical_json, parents
from sievecraft.operators.aggregates import hash_sums, row_hashes, set_digest, sorted_digest
from sievecraft.operators.guards import select_required
from sievecraft.schemas import CANDIDATES, HELD_OUT

_METADATA = ("parents", "subject", "author_name", "author_email", "committed_at")


def commit_metadata(record: Column) -> Column:
    """Struct of the five NUL-separated fields of a commit; any other number of fields fails."""
    fields = F.split(record, "\u0000")
    checked = F.when(F.size(fields) == len(_METADATA), fields).otherwise(
        F.raise_error(F.lit("a commit record needs exactly 5 fields"))
    )
    columns = {name: checked[place] for place, name in enumerate(_METADATA)}
    columns["parents"] = parents(columns["parents"])
    columns["committed_at"] = F.rtrim(columns["committed_at"], F.lit("\n"))
    return F.struct(*[column.alias(name) for name, column in columns.items()])


def record_arity(df: DataFrame, column: str = "record") -> DataFrame:
    """Rows (fields, records): how many records have how many fields. `parse_commit_log` fails unless all have five."""
    fields = F.size(F.split(F.col(column), "\u0000")).cast("long")
    return df.groupBy(fields.alias("fields")).agg(F.count("*").alias("records"))


def parse_commit_log(df: DataFrame, column: str = "record") -> DataFrame:
    """Expand a record column into the five metadata columns."""
    keys = [name for name in df.columns if name != column]
    return df.select(*keys, commit_metadata(F.col(column)).alias("_m")).select(*keys, "_m.*")


def read_commit_log(spark: SparkSession, path: str) -> DataFrame:
    """Text export, one commit per LF-ended line: repository path, commit hash and the five
    metadata fields, all separated by NUL."""
    parts = F.split(F.col("value"), "\u0000", 3)
    lines = spark.read.option("lineSep", "\n").text(path)
    return parse_commit_log(
        lines.select(
            parts[0].alias("repository_path"),
            parts[1].alias("commit_sha"),
            parts[2].alias("record"),
        )
    )


_EXPORT_FIELDS = 2 + len(_METADATA)


def read_commit_export(spark: SparkSession, path: str) -> DataFrame:
    """Export without line ends: repository path, commit hash and the five metadata fields of each commit, every field
    ended by NUL, so that a field may hold any other character.

    Files are read in splits. A field's number in its file is that in its split plus the fields of the splits before,
    which come from one count for each split; numbers give record and place, and fields meet their record by a shuffle.
    A file whose fields are no multiple of seven is an error.
    """
    raw = (
        spark.read.option("lineSep", "\u0000")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),  # consecutive within a split
            "value",
        )
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = raw.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    # A row for each split; the sum over a file's splits is its number of fields.
    placed = blocks.select(
        "file",
        "block",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("file")).alias("fields"),
    )
    number = F.when(F.col("fields") % _EXPORT_FIELDS == 0, F.col("row") + F.col("shift")).otherwise(
        F.raise_error(F.concat(F.lit("fields are missing in "), F.col("file")))
    )
    numbered = raw.join(placed, ["file", "block"]).select("file", number.alias("number"), "value")
    place = F.col("number") % _EXPORT_FIELDS
    names = ("repository_path", "commit_sha", *_METADATA)
    columns = [F.max(F.when(place == k, F.col("value"))).alias(name) for k, name in enumerate(names)]
    record = F.floor(F.col("number") / _EXPORT_FIELDS)
    rows = numbered.groupBy("file", record.alias("record")).agg(*columns).drop("file", "record")
    return rows.withColumn("parents", parents(F.col("parents"))).withColumn(
        "committed_at", F.rtrim("committed_at", F.lit("\n"))
    )


def patch_text(raw: Column) -> Column:
    """Patch bytes as text: invalid UTF-8 becomes U+FFFD, nothing is trimmed."""
    return F.make_valid_utf8(raw.cast("string"))


def read_patches(spark: SparkSession, path: str, column: str = "diff") -> DataFrame:
    return spark.read.parquet(path).withColumn(column, patch_text(F.col(column)))


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """The six candidate columns of a Parquet table, in order."""
    return select_required(spark.read.parquet(path), CANDIDATES.names, "candidates")


def read_splits(
    spark: SparkSession, directory: str, names: Sequence[str] = HELD_OUT
) -> DataFrame:
    """Named splits of a prepared directory; only their partitions are read. A split without rows
    has no directory and reads as empty."""
    rows = select_required(
        spark.read.parquet(directory), [*CANDIDATES.names, "split"], "splits"
    )
    return rows.filter(F.col("split").isin(*names))


def latest_decisions(decisions: DataFrame) -> DataFrame:
    """The last decision on each id, by `seq`; of several with one `seq`, a rejection, then the
    smaller split."""
    last = Window.partitionBy("id").orderBy(F.desc("seq"), F.asc("approved"), F.asc("split"))
    return (
        decisions.withColumn("_place", F.row_number().over(last))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def distinct_repositories(repositories: DataFrame) -> DataFrame:
    """One row per work tree, however many roots it was reached from: all its remotes in order, and
    shallow if any row says so."""
    remotes = F.array_sort(F.array_distinct(F.flatten(F.collect_set("remotes"))))
    return repositories.groupBy("path").agg(
        remotes.alias("remotes"),
        F.coalesce(F.bool_or("shallow"), F.lit(False)).alias("shallow"),
    )


def read_repositories(spark: SparkSession, path: str) -> DataFrame:
    return distinct_repositories(spark.read.parquet(path))


def file_digests(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Name and SHA-256 of each file below a path, for small files: one file is one row, up to
    2 GiB. Data sets are digested by their rows, see `rows_digest`."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.sha2("content", 256).alias("sha256"),
    )


def rows_digest(rows: DataFrame) -> DataFrame:
    """One row with `digest` over the canonical JSON of all rows, whatever files they lie in."""
    return set_digest(row_hashes(rows), "")


def sorted_rows_digest(rows: DataFrame) -> DataFrame:
    """One row with `digest`: as `rows_digest`, but every row's hash is hashed again, none is added up."""
    return sorted_digest(row_hashes(rows), "")


def source_sums(rows: DataFrame) -> DataFrame:
    """Rows (file, rows, sums) of a file table: the part of `rows_digest` that each file contributes.

    Kept with the data, they give the digest of the source after files were added without reading the old ones again:
    `merged_sums` of old and new, then `sums_digest("")`.
    """
    named = rows.select("*", F.col("_metadata.file_path").alias("_file"))
    hashed = named.select("_file", F.sha2(canonical_json(*rows.columns), 256).alias("row_hash"))
    return hash_sums(hashed, "_file").withColumnRenamed("_file", "file")
