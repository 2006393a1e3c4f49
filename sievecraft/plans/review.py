"""Review of held-out rows: summary, queue, approvals, and the approved subset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.storagelevel import StorageLevel

from sievecraft.errors import DataQualityError
from sievecraft.operators.aggregates import split_summary_with_languages
from sievecraft.operators.guards import require_minimum, require_none, select_required
from sievecraft.operators.joins import BROADCAST_ROWS, small_row_count
from sievecraft.operators.ordering import chronological_key, keys_at
from sievecraft.schemas import HELD_OUT, QUEUE_COLUMNS, REFERENCE_COLUMNS
from sievecraft.sources.decision_log import DecisionLog
from sievecraft.sources.readers import latest_decisions
from sievecraft.sources.writers import delete_path, write_reviewed

REQUIRED_APPROVALS = 50
# Rows per group up to which Spark limits ranks in each task (its default for such limits).
KEPT_PER_TASK = 1_000


def summarise_splits(splits: DataFrame) -> DataFrame:
    """One row per split: counts, ranges, repositories and a map of languages."""
    rows = select_required(splits, [*REFERENCE_COLUMNS, "split"], "splits")
    return split_summary_with_languages(rows)


def audit_queue(splits: DataFrame, names: Sequence[str] = HELD_OUT) -> DataFrame:
    """Held-out rows with what a reviewer sees. Queue order is split, commit instant, id."""
    rows = select_required(splits, [*REFERENCE_COLUMNS, "split"], "splits")
    return rows.filter(F.col("split").isin(*names)).select(*QUEUE_COLUMNS, "committed_at_utc")


def union_splits(**tables: DataFrame) -> DataFrame:
    """Tables of rows tagged with their split name, in one table."""
    result = None
    for name, table in tables.items():
        tagged = table.withColumn("split", F.lit(name))
        result = tagged if result is None else result.unionByName(tagged)
    return result


def undecided(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    return queue.join(decisions.select("id"), "id", "left_anti")


def next_undecided(queue: DataFrame, decisions: DataFrame, k: int = 1) -> DataFrame:
    """The first `k` undecided rows of each split, with their `position` among the undecided.

    Ids are ranked without their texts. For a small `k`, Spark keeps `k` of them per split and task
    before the shuffle; for a larger one, the key that follows the `k`-th is found by counting, and
    only what comes before it is ranked. The texts of the chosen ones are then looked up.
    """
    order = Window.partitionBy("split").orderBy("committed_at_utc", "id")
    narrow = undecided(queue.select("split", "id", "committed_at_utc"), decisions)
    if k > KEPT_PER_TASK:
        narrow = _before_cuts(narrow, k)
    ranked = narrow.withColumn("position", F.row_number().over(order))
    chosen = ranked.filter(F.col("position") <= k).select("split", "id", "position")
    # `k` ids per split: small whatever the size of the queue, if `k` is.
    if k <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    return queue.select(*QUEUE_COLUMNS).join(chosen, ["split", "id"])


def _before_cuts(narrow: DataFrame, k: int) -> DataFrame:
    """Rows among the first `k` of their split; one row per split passes the driver."""
    keyed = narrow.withColumn("key", chronological_key()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {row["split"]: row["count"] for row in keyed.groupBy("split").count().collect()}
        early = F.lit(False)
        for name, size in sizes.items():
            here = F.col("split") == F.lit(name)
            if size > k:
                (cut,) = keys_at(keyed.filter(here).select("key"), [k], size)
                here = here & (chronological_key() < F.lit(cut))
            early = early | here
    finally:
        keyed.unpersist()
    return narrow.filter(early)


def approval_counts(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows, decided rows and approved rows of the queue per split; undecided is not approved."""
    marked = queue.select("split", "id").join(decisions.select("id", "approved"), "id", "left")
    return marked.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.count("approved").alias("decided"),
        F.count_if(F.coalesce("approved", F.lit(False))).alias("approved"),
    )


def review_batch(
    queue: DataFrame,
    decisions: DataFrame,
    required: int = REQUIRED_APPROVALS,
    k: int = 1,
    names: Sequence[str] = HELD_OUT,
) -> DataFrame:
    """The next rows to review: those of the first split short of approvals, at most `k`.

    Empty once all splits have enough; an error if the split has no undecided row left.
    """
    current = latest_decisions(decisions)
    approved = {
        row["split"]: row["approved"] for row in approval_counts(queue, current).collect()
    }  # one row per split
    active = next((name for name in names if approved.get(name, 0) < required), None)
    batch = next_undecided(queue.filter(F.col("split") == F.lit(active)), current, k)
    if active is not None and batch.isEmpty():
        raise DataQualityError(
            f"{active} ran out of rows with {approved.get(active, 0)} of {required} approvals"
        )
    return batch


def current_decisions(decisions: DataFrame, queue: DataFrame) -> DataFrame:
    """The last decision on each id that is still in the queue, under the queue's split."""
    last = latest_decisions(decisions).drop("split")
    return last.join(queue.select("id", "split"), "id").select("id", "split", "approved", "seq")


def approved_ids(decisions: DataFrame, names: Sequence[str] = HELD_OUT) -> DataFrame:
    chosen = F.col("approved") & F.col("split").isin(*names)
    return latest_decisions(decisions).filter(chosen).select("split", "id")


def stale_approvals(decisions: DataFrame, splits: DataFrame) -> DataFrame:
    """Approved (split, id) that the splits do not hold."""
    approved = approved_ids(decisions)
    held_out = splits.filter(F.col("split").isin(*HELD_OUT)).select("split", "id")
    few = held_out.join(approved, ["split", "id"], "left_semi")  # as many as there are approvals
    return approved.join(few, ["split", "id"], "left_anti")


def reviewed_rows(splits: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of the held-out splits with an approval; all of them, not only the required number.

    Approvals come from people, so their ids mostly fit a broadcast; the texts are shuffled only if
    they do not.
    """
    approved = approved_ids(decisions)
    if small_row_count(approved) is not None:
        approved = F.broadcast(approved)
    return splits.join(approved, ["split", "id"], "left_semi")


def _approvals_per_split(ids: DataFrame, names: Sequence[str]) -> dict[str, int]:
    found = {row["split"]: row["count"] for row in ids.groupBy("split").count().collect()}
    return {name: found.get(name, 0) for name in names}


def materialise_review(
    splits: DataFrame,
    decisions: DataFrame,
    directory: str,
    required: int = REQUIRED_APPROVALS,
    names: Sequence[str] = HELD_OUT,
) -> dict[str, int]:
    """Check the approvals, write the approved rows, and return the rows written per split."""
    approved = _approvals_per_split(approved_ids(decisions, names), names)
    require_minimum(approved, required, "approvals per split")
    require_none(stale_approvals(decisions, splits), "approved ids absent from the splits")
    written = write_reviewed(reviewed_rows(splits, decisions), directory)
    require_minimum(
        {name: written.get(name, 0) for name in names}, required, "reviewed rows per split"
    )
    return written


def compact_decisions(spark: SparkSession, path: str, queue: DataFrame) -> int:
    """Replace a log by the current decisions on the queue's ids, in one step; returns their number."""
    return DecisionLog(spark, path).compact(queue)


def retire_decisions(spark: SparkSession, path: str) -> bool:
    """Remove a log that is no longer needed; False if there is none."""
    return delete_path(spark, path)
