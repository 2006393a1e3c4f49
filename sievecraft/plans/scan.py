"""Repository scan: status, commit and author counts per repository, and totals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sievecraft.functions.paths import any_glob_match, path_candidates, remote_slugs
from sievecraft.operators.aggregates import author_pairs, distinct_authors, group_counts
from sievecraft.operators.filters import first_match, only_included, scan_status
from sievecraft.operators.joins import lookup_join
from sievecraft.operators.patterns import with_match_flag
from sievecraft.sources.readers import distinct_repositories


@dataclass(frozen=True)
class Scan:
    """`statuses`: path, remotes, shallow, status; what the build needs, without reading commits.
    `repositories`: the same with commit_count and author_email_count. `totals`: one row."""

    statuses: DataFrame
    repositories: DataFrame
    totals: DataFrame


def with_status(
    repositories: DataFrame,
    roots: Sequence[str] = (),
    ignore_paths: Sequence[str] | DataFrame = (),
    ignore_remotes: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """Distinct repositories with their status. An ignored one never counts as shallow.

    Ignore lists are a few globs, or tables with the column `pattern` of any size.
    """
    rows = distinct_repositories(repositories)
    options = path_candidates(F.col("path"), roots)
    slugs = remote_slugs(F.col("remotes"))
    if isinstance(ignore_paths, DataFrame) or isinstance(ignore_remotes, DataFrame):
        marks = []
        for values, globs, name in ((options, ignore_paths, "ignored_path"), (slugs, ignore_remotes, "ignored_remote")):
            if isinstance(globs, DataFrame):
                rows = with_match_flag(rows, "path", values, globs, f"_{name}")
                marks.append((F.col(f"_{name}"), name))
            else:
                marks.append((any_glob_match(values, globs), name))
        status = F.coalesce(first_match(marks), F.lit("included"))
    else:
        status = scan_status(options, slugs, ignore_paths, ignore_remotes)
    marked = rows.withColumn("status", status).withColumn(
        "shallow", F.col("shallow") & (F.col("status") == "included")
    )
    return marked.drop("_ignored_path", "_ignored_remote")


def scan_history(
    repositories: DataFrame,
    commits: DataFrame,
    roots: Sequence[str],
    ignore_paths: Sequence[str] | DataFrame = (),
    ignore_remotes: Sequence[str] | DataFrame = (),
) -> Scan:
    """Scan `repositories(path, remotes, shallow)` and `commits(repository_path, author_email, …)`.

    Commits are combined by (repository, author) first; everything else works on those pairs.
    """
    if not roots:
        raise ValueError("at least one root is needed")
    ranked = with_status(repositories, roots, ignore_paths, ignore_remotes)
    names = only_included(ranked).select(F.col("path").alias("repository_path"))
    pairs = lookup_join(
        author_pairs(commits), names, "repository_path", ["author"], "inner"
    )
    included = F.col("status") == "included"

    def counted(name: str):
        return F.when(included, F.coalesce(F.col(name), F.lit(0))).otherwise(0).alias(name)

    counts = group_counts(pairs).withColumnRenamed("repository_path", "path")
    scans = ranked.join(counts, "path", "left").select(
        "path", "remotes", "shallow", "status",
        counted("commit_count"), counted("author_email_count"),
    )

    authors = distinct_authors(pairs)
    totals = scans.agg(
        F.coalesce(F.sum("commit_count"), F.lit(0)).alias("commit_count"),
        F.count("*").alias("discovered_repository_count"),
        F.count_if(~included).alias("ignored_repository_count"),
        F.count_if(included).alias("included_repository_count"),
        F.count_if("shallow").alias("shallow_repository_count"),
    ).withColumn("author_email_count", authors.scalar())
    return Scan(ranked, scans, totals)
