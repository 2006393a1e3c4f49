"""Deduplication that goes on: the earliest row of each group, kept between runs in buckets of the group key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievecraft.operators.filters import date_window
from sievecraft.operators.ordering import dedup_earliest, with_group_key

_COLUMNS = ("group_key", "committed_at_utc", "id")
_SCHEMA = ", ".join(f"{name} string" for name in _COLUMNS)


class GroupLog:
    """A table of the session's catalog with a row for each time a group got a new earliest row.

    Rows are only added. New candidates are compared with it bucket by bucket: they are shuffled, the table is not. The
    earliest row of a date window is not that of another window, so a log is of one window, which is kept with it.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: str,
        since: dt.datetime | None = None,
        until: dt.datetime | None = None,
        buckets: int = 200,
    ):
        self.spark, self.table, self.since, self.until = spark, table, since, until
        window = f"{since.isoformat() if since else ''}/{until.isoformat() if until else ''}"
        if not spark.catalog.tableExists(table):
            empty = spark.createDataFrame([], _SCHEMA)
            empty.write.bucketBy(buckets, "group_key").sortBy("group_key").saveAsTable(table)
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('candidate_window' = '{window}')")
        (kept,) = spark.sql(f"SHOW TBLPROPERTIES {table} ('candidate_window')").select("value").first()
        if kept != window:
            raise ValueError(f"{table} is of the window {kept}, not {window}")
        detail = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
        self.buckets = int(detail["data_type"])

    def winners(self) -> DataFrame:
        """The earliest row (group_key, committed_at_utc, id) of every group so far: no shuffle."""
        return dedup_earliest(self.spark.table(self.table))

    def gained(self, candidates: DataFrame) -> DataFrame:
        """Rows of the candidates that are the earliest of their group: of a new one, or before the known earliest."""
        narrow = date_window(candidates, self.since, self.until).select("id", "committed_at_utc", "patch_id")
        # One row of a group from each task, then as many partitions as the table has buckets: else Spark may rather shuffle
        # the table to as many as this side has.
        new = dedup_earliest(with_group_key(narrow).select(*_COLUMNS)).repartition(self.buckets, "group_key")
        known = self.winners().select("group_key", F.struct("committed_at_utc", "id").alias("known"))
        joined = new.join(known, "group_key", "left")
        earlier = F.col("known").isNull() | (F.struct("committed_at_utc", "id") < F.col("known"))
        return joined.filter(earlier).select(*_COLUMNS)

    def add(self, candidates: DataFrame) -> None:
        """Take in new candidates. Adding the same ones again changes nothing, so a run that failed can be repeated."""
        rows = self.gained(candidates).repartition(self.buckets, "group_key")
        rows.write.mode("append").bucketBy(self.buckets, "group_key").sortBy("group_key").saveAsTable(self.table)
