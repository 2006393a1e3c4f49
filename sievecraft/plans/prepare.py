"""Dataset preparation: date window, deduplication, chronological split, manifest."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from sievecraft.errors import DataQualityError
from sievecraft.operators.aggregates import sorted_fingerprint
from sievecraft.operators.filters import date_window
from sievecraft.operators.guards import require_minimum, select_required
from sievecraft.operators.joins import BROADCAST_ROWS, hashed, small_row_count
from sievecraft.operators.ordering import (
    SORTED_AT_ONCE,
    assign_split,
    chronological_key,
    cut_keys,
    dedup_earliest,
    split_bounds,
    split_sizes,
    with_group_key,
)
from sievecraft.schemas import CANDIDATES, HELD_OUT
from sievecraft.sources.readers import read_candidates, sorted_rows_digest
from sievecraft.sources.writers import write_manifest, write_splits

MINIMUM_ROWS = 500
MINIMUM_EVALUATION_ROWS = 50
# Fixed value: how a stored instant looks; its text order is time order only in this form.
UTC_TEXT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z"


@dataclass(frozen=True)
class Prepared:
    """`splits`: candidate columns and `split`, lazy. `counts`: rows after each stage."""

    splits: DataFrame
    counts: dict[str, int]
    split_counts: dict[str, int]


def _computed_once(df: DataFrame) -> DataFrame:
    """Narrow rows that several steps read: written to the session's checkpoint folder if it has one, so that whoever
    consumes the result later reads them too; else cached for this call only."""
    if df.sparkSession.sparkContext.getCheckpointDir():
        return df.checkpoint()
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _kept(
    window: DataFrame, keys: DataFrame, winners: DataFrame, total: int, copies: int
) -> DataFrame:
    """The deduplicated wide rows.

    Few copies: an anti-join against their broadcast ids, and the texts are not shuffled at all.
    Many copies: a semi-join with the winners' ids, one shuffle without a sort of the texts. Ids
    that repeat, within a group or over several: the window over the wide rows.
    """
    if copies == 0:
        return window
    if copies <= BROADCAST_ROWS:
        losers = keys.join(winners, "id", "left_anti").select("id")
        if small_row_count(losers) == copies:
            return window.join(F.broadcast(losers), "id", "left_anti")
    elif keys.join(winners, "id", "left_semi").count() + copies == keys.count():
        return window.join(hashed(winners, total, "id"), "id", "left_semi")
    return dedup_earliest(with_group_key(window)).drop("group_key")


def prepare_dataset(
    candidates: DataFrame,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    minimum_rows: int = MINIMUM_ROWS,
    minimum_evaluation_rows: int = MINIMUM_EVALUATION_ROWS,
    sorted_at_once: int = SORTED_AT_ONCE,
) -> Prepared:
    """Filter, deduplicate and split candidates.

    Counts and cuts come from a pass over three narrow columns. The texts are read by whoever
    consumes `splits`, where a row's split is a comparison with two keys.
    """
    rows = select_required(candidates, CANDIDATES.names, "candidates")
    window = date_window(rows, since, until)
    keys = with_group_key(window.select("id", "committed_at_utc", "patch_id")).drop("patch_id")
    winners = _computed_once(dedup_earliest(keys))
    try:
        filtered, malformed = keys.agg(
            F.count("*"), F.count_if(~F.col("committed_at_utc").rlike(UTC_TEXT))
        ).first()
        if malformed:
            raise DataQualityError(f"{malformed} rows whose commit instant is not UTC text")
        total = winners.count()
        require_minimum({"deduplicated": total}, minimum_rows, "rows")
        bounds = split_bounds(total)
        sizes = split_sizes(bounds, total)
        require_minimum(
            {name: sizes[name] for name in HELD_OUT}, minimum_evaluation_rows, "rows per split"
        )
        narrow = winners.select(chronological_key().alias("key"))
        cuts = cut_keys(narrow, total, bounds, sorted_at_once=sorted_at_once)
        kept = _kept(window, keys, winners.select("id"), total, filtered - total)
    finally:
        winners.unpersist()
    counts = {
        "source_count": rows.count() if since or until else filtered,
        "filtered_count": filtered,
        "deduplicated_count": total,
    }
    return Prepared(
        kept.select(*CANDIDATES.names).withColumn("split", assign_split(chronological_key(), cuts)),
        counts,
        sizes,
    )


def prepare_files(
    spark: SparkSession,
    candidates_path: str,
    directory: str,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    minimum_rows: int = MINIMUM_ROWS,
    minimum_evaluation_rows: int = MINIMUM_EVALUATION_ROWS,
) -> dict[str, object]:
    """Read candidates, write the splits and `manifest.json` next to them; returns the manifest.

    The fingerprint and the counts per split are taken from what was written; the source is digested
    by its rows before anything is. Splits of an earlier run are replaced, the manifest comes last.
    """
    prepared = prepare_dataset(
        read_candidates(spark, candidates_path), since, until, minimum_rows, minimum_evaluation_rows
    )
    source = sorted_rows_digest(read_candidates(spark, candidates_path)).first()["digest"]
    splits_path = f"{directory}/splits"
    write_splits(prepared.splits, splits_path)
    written = spark.read.parquet(splits_path)
    bounds = {
        "since": since.isoformat() if since else None,
        "until": until.isoformat() if until else None,
    }
    found = {row["split"]: row["count"] for row in written.groupBy("split").count().collect()}
    if found != {name: size for name, size in prepared.split_counts.items() if size}:
        raise DataQualityError(f"wrote {found}, expected {prepared.split_counts}")
    manifest = {
        "source_file": candidates_path.rstrip("/").rsplit("/", 1)[-1],
        "source_sha256": source,
        "fingerprint": sorted_fingerprint(written, **bounds).first()["digest"],
        "split_counts": prepared.split_counts,
        **prepared.counts,
        **bounds,
    }
    write_manifest(spark, manifest, f"{directory}/manifest.json")
    return manifest
