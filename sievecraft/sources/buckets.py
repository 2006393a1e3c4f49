"""Histories stored in buckets of the commit key, so that builds over them join without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievecraft.operators.changes import COMMIT_KEY


def _write(df: DataFrame, table: str, buckets: int, mode: str) -> None:
    # One task for each bucket, so that a bucket is one file.
    rows = df.repartition(buckets, *COMMIT_KEY)
    writer = rows.write.mode(mode).bucketBy(buckets, *COMMIT_KEY).sortBy(*COMMIT_KEY)
    writer.option("compression", "zstd").saveAsTable(table)


def write_history(
    commits: DataFrame, changes: DataFrame, name: str, buckets: int, mode: str = "overwrite"
) -> None:
    """Tables `<name>_commits` and `<name>_changes` in the session's catalog, both in `buckets` buckets of the commit key.

    This is the one shuffle of a history. `build_candidates` over the tables combines changes per commit and joins them
    and the diffs bucket by bucket; only lookups that are too large for a broadcast still move commits, without diffs.
    Choose `buckets` so that one holds a few hundred megabytes.
    """
    _write(commits, f"{name}_commits", buckets, mode)
    _write(changes, f"{name}_changes", buckets, mode)


def read_history(spark: SparkSession, name: str) -> tuple[DataFrame, DataFrame]:
    """Commits and changes of `write_history`."""
    return spark.table(f"{name}_commits"), spark.table(f"{name}_changes")
