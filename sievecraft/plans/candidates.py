"""Candidate build: from commits to a training table, a private lineage table and reason counts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievecraft.errors import DataQualityError
from sievecraft.functions.keys import candidate_id, patch_fingerprint, repository_group_id
from sievecraft.functions.paths import remote_urls
from sievecraft.functions.text import (
    as_utc,
    identity_key,
    normalise_patch_text,
    normalise_subject,
    squeeze,
)
from sievecraft.operators.aggregates import build_totals, rejection_counts
from sievecraft.operators.changes import COMMIT_KEY, change_stats, inline_change_stats
from sievecraft.operators.filters import (
    author_matched,
    change_reason,
    metadata_reason,
    only_included,
)
from sievecraft.operators.guards import leak_counts, lineage_integrity, require_full_history
from sievecraft.operators.joins import hashed, lookup_join, small_row_count
from sievecraft.schemas import CANDIDATES, PROVENANCE
from sievecraft.sources.writers import (
    delete_path,
    require_distinct_paths,
    staged,
    staging_path,
    write_candidates,
    write_provenance,
)


@dataclass(frozen=True)
class Build:
    """`labelled` holds every commit of an included repository with its `reason` (null if
    accepted) and `early_reason`, the part of it that needs no changed paths; the other tables
    derive from it. All are lazy, and whatever a consumer leaves out is not computed: counts and
    lineage never read the diffs. `texts` holds the diffs of commits that may be accepted; they
    join the accepted ones by the commit key, whatever the size of the lookups. Subjects are still as they came here."""

    labelled: DataFrame
    texts: DataFrame

    @property
    def decided(self) -> DataFrame:
        return _with_subjects(self.labelled.drop("early_reason"))

    @property
    def accepted(self) -> DataFrame:
        """Accepted commits, without diffs. A commit key that occurs twice among them is an error:
        its diff could not be told from the other's."""
        # The first filter moves below the join on paths, so that commits rejected by their
        # metadata are not shuffled.
        rows = self.labelled.filter(F.col("early_reason").isNull()).filter(
            F.col("reason").isNull()
        )
        place = F.row_number().over(Window.partitionBy(*COMMIT_KEY).orderBy("committed_at"))
        once = F.when(place == 1, F.col("id")).otherwise(
            F.raise_error(F.concat(F.lit("a commit occurs twice: "), F.col("id")))
        )
        return rows.withColumn("id", once)

    def with_texts(self, accepted_rows: int | None = None) -> DataFrame:
        """Accepted commits with their diffs: one shuffle of both by the commit key, none for a bucketed history.

        With the number of accepted commits known, these are built into hash tables of bounded size, and the diffs are not
        sorted; else Spark chooses a join that can spill.
        """
        accepted = self.accepted
        if accepted_rows is not None:
            accepted = hashed(accepted, accepted_rows, *COMMIT_KEY)
        return self.texts.join(accepted, list(COMMIT_KEY))

    @property
    def leaks(self) -> DataFrame:
        return leak_counts(_with_subjects(self.with_texts()))

    def rows(self, accepted_rows: int | None = None) -> DataFrame:
        """Accepted commits with the columns of both outputs."""
        accepted = self.with_texts(accepted_rows)
        known = F.col("patch_id") if "patch_id" in accepted.columns else F.lit(None)
        return accepted.select(
            *PROVENANCE.names,
            normalise_subject(F.col("subject")).alias("subject"),
            normalise_patch_text(F.col("diff")).alias("diff"),
            as_utc(F.col("committed_at")).alias("committed_at_utc"),
            # The raw diff, as the ready-made ids are made from it too.
            F.coalesce(known, patch_fingerprint(F.col("diff"))).alias("patch_id"),
        )

    @property
    def candidates(self) -> DataFrame:
        return self.rows().select(*CANDIDATES.names)

    @property
    def provenance(self) -> DataFrame:
        return self.accepted.select(*PROVENANCE.names)

    @property
    def rejections(self) -> DataFrame:
        return rejection_counts(self.labelled)

    @property
    def totals(self) -> DataFrame:
        return build_totals(self.labelled)


def _with_subjects(rows: DataFrame) -> DataFrame:
    """Subjects in their final form: after all joins, as Spark forgets how rows are partitioned when Python has seen them."""
    return rows.withColumn("subject", normalise_subject(F.col("subject")))


def _author_keys(allowed: DataFrame) -> DataFrame:
    keys = (
        allowed.select(identity_key(F.col("author_email")).alias("author_key"))
        .filter(F.col("author_key") != "")
        .distinct()
    )
    if keys.isEmpty():
        raise ValueError("author_emails needs at least one entry")
    return keys.withColumn("author_ok", F.lit(True))


def _stats(commits: DataFrame, changes: DataFrame | None) -> DataFrame:
    if changes is None:
        stats: Column = inline_change_stats(F.coalesce(F.col("numstat"), F.lit("")))
        return commits.withColumn("stats", stats).select("*", "stats.*").drop("stats", "numstat")
    return commits.join(change_stats(changes), list(COMMIT_KEY), "left")


def build_candidates(
    repositories: DataFrame,
    commits: DataFrame,
    author_emails: Iterable[str] | DataFrame,
    changes: DataFrame | None = None,
) -> Build:
    """Build from scanned `repositories` (with `status`), `commits` and their changed paths.

    `author_emails` is a list, or a table with that column. `changes` is a table of paths (see
    `parse_numstat`); without it the commits carry the column `numstat`, and no join on paths is
    needed. A shallow included repository is an error.

    Commits are decided on without their diffs; these join the accepted ones at the end. Rows and
    columns do not depend on the size of repositories and allow-list, only whether these are
    broadcast does.
    """
    require_full_history(repositories)
    lineage = only_included(repositories).select(
        F.col("path").alias("repository_path"),
        repository_group_id(F.col("path")).alias("repository_group_id"),
        remote_urls(F.col("remotes")).alias("remote_urls"),
    )
    small_lineage = small_row_count(lineage) is not None
    email = F.col("author_email")
    if isinstance(author_emails, DataFrame):
        keys = _author_keys(author_emails)
        small_keys = small_row_count(keys) is not None
        known_author = F.lit(True)
    else:
        keys, small_keys = None, True
        known_author = author_matched(email, author_emails)

    # NFC neither empties a subject nor changes an ASCII prefix that ends in `!`, so the reasons
    # need no Python.
    plain = squeeze(F.col("subject"))
    columns = [name for name in ("diff", "patch_id") if name in commits.columns]
    possible = metadata_reason(known_author, F.col("parents"), plain).isNull()
    texts = commits.filter(possible)
    if changes is None:  # what the paths say is known without a join, too
        paths = inline_change_stats(F.coalesce(F.col("numstat"), F.lit("")))
        rejected = change_reason(paths["path_count"], paths["has_binary"], paths["generated_only"])
        texts = texts.filter(rejected.isNull())
    texts = texts.select(*COMMIT_KEY, *columns)
    commits = commits.drop(*columns)

    if keys is None:
        flagged = commits.withColumn("author_ok", known_author)
    else:
        flagged = lookup_join(
            commits.withColumn("author_key", identity_key(email)),
            keys,
            "author_key",
            list(COMMIT_KEY),
            small=small_keys,
        ).withColumn("author_ok", F.coalesce("author_ok", F.lit(False)))
        flagged = flagged.drop("author_key")
    placed = lookup_join(
        flagged, lineage, "repository_path", ["commit_sha"], "inner", small=small_lineage
    )
    early = metadata_reason(F.col("author_ok"), F.col("parents"), plain)
    late = change_reason(F.col("path_count"), F.col("has_binary"), F.col("generated_only"))
    described = (
        placed.withColumn("early_reason", early)
        .withColumn("id", candidate_id(F.col("repository_group_id"), F.col("commit_sha")))
    )
    labelled = (
        _stats(described, changes)
        .withColumn("reason", F.coalesce("early_reason", late))
        .drop("author_ok", "path_count", "has_binary", "generated_only")
    )
    return Build(labelled, texts)


def write_build(
    build: Build, candidates_path: str, provenance_path: str, partitions: int | None = None
) -> dict[str, int]:
    """Write lineage, then candidates; returns counts by reason, and `accepted`.

    Without `partitions`, both come from one staging table beside the lineage, which is private too: the build is
    computed once, and that write observes the sizes by which the outputs are laid out.

    Counted by an aggregate of its own rather than by metrics of the write: retried tasks would
    count twice there. What was written is read back and checked, so that a source that grows
    between the passes is noticed.
    """
    require_distinct_paths(candidates_path, provenance_path)
    spark = build.labelled.sparkSession
    rows = build.labelled.groupBy("reason").count().collect()
    counts = {row["reason"] or "accepted": row["count"] for row in rows}
    accepted = counts.get("accepted", 0)
    if partitions is not None:
        write_provenance(build.provenance, provenance_path, partitions)
        write_candidates(build.rows(accepted).select(*CANDIDATES.names), candidates_path, partitions)
    else:
        stage = staging_path(provenance_path)
        try:
            tables = {"candidates": CANDIDATES, "provenance": PROVENANCE}
            written, files = staged(build.rows(accepted), stage, tables)
            write_provenance(written.select(*PROVENANCE.names), provenance_path, files["provenance"])
            write_candidates(written.select(*CANDIDATES.names), candidates_path, files["candidates"])
        finally:
            delete_path(spark, stage)
    found = lineage_integrity(
        spark.read.parquet(candidates_path), spark.read.parquet(provenance_path)
    ).first()
    unsound = any(found[name] for name in ("without_provenance", "without_candidate", "repeated_ids"))
    if unsound or found["candidates"] != accepted:
        raise DataQualityError(f"wrote {found.asDict()}, counted {counts}")
    return counts
