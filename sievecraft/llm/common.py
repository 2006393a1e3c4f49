"""Helpers of the operators: tables in the shared folder, row keys, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NO_ID = -(1 << 63)  # stands for a null id in keys; smaller than all others


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. If that is unset, a new local one where all run in one
    process, and an error on a cluster."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        known = "file://" + tempfile.mkdtemp(prefix="sievecraft-")
        spark.conf.set("spark.checkpoint.dir", known)
    return known.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """Written as Parquet to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/saved-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def keyed_texts(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Columns `d` (id, null as the smallest), `t` (hash of the text) and `text`: rows that agree in (d, t) are repeated rows."""
    return docs.select(
        id_key(id_column).alias("d"), F.xxhash64("text").alias("t"), F.col("text").cast("string")
    )


def components(edges: DataFrame) -> DataFrame:
    """Rows (v, l) for every vertex of the edges (a, b): the smallest vertex reachable from it.

    Smallest labels of the neighbours, then the label's own label: a chain of n takes about log n rounds, a star two.
    Each round is aggregated per vertex before it is shuffled, and saved.
    """
    both = saved(
        edges.select(F.col("a").alias("v"), F.col("b").alias("u"))
        .union(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
        .distinct()
    )
    labels = saved(
        both.groupBy("v").agg(F.min("u").alias("l")).select("v", F.least("v", "l").alias("l"))
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("v", "u"), "u").groupBy("v").agg(F.min("l").alias("m"))
        )
        lower = labels.join(near, "v").select("v", F.least("l", "m").alias("l"), F.col("l").alias("old"))
        jump = labels.select(F.col("v").alias("l"), F.col("l").alias("j"))
        after = saved(
            lower.join(jump, "l", "left").select(
                "v", F.least("l", F.coalesce("j", "l")).alias("l"), "old"
            )
        )
        changed = after.filter("l <> old").limit(1).count()
        labels = after.select("v", "l")
        if not changed:
            return labels
