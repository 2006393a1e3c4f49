"""Writers. Tables go through Spark's commit protocol; only one-row reports pass the driver."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from sievecraft.functions.text import casefold
from sievecraft.operators.guards import enforce_schema
from sievecraft.schemas import CANDIDATES, PROVENANCE, SPLIT_ROWS

# `candidate_` comes before the hex digits of an id.
_ID_DIGITS_AT = len("candidate_") + 1
_ID_DIGITS = 6
# Fixed value: how an id looks; only then are its leading digits a share of all rows.
_ID_FORM = r"\Acandidate_[0-9a-f]{24}\z"
FILE_BYTES = 256 * 1024 * 1024
FILE_RECORDS = 5_000_000


def _text_bytes(names: list[str]) -> Column:
    texts = [F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in names]
    return F.sum(sum(texts, F.lit(16)))


def staged(df: DataFrame, path: str, tables: Mapping[str, T.StructType]) -> tuple[DataFrame, dict[str, int]]:
    """The rows written once to a new folder at `path`, and how many files each of the tables made of them should have.

    The bytes of text of each table are observed by the write itself, so nothing is computed twice to lay the tables out.
    """
    spark = df.sparkSession
    sizes = Observation()
    texts = {
        name: _text_bytes([f.name for f in schema.fields if isinstance(f.dataType, T.StringType)])
        for name, schema in tables.items()
    }
    rows = df.observe(sizes, *[size.alias(name) for name, size in texts.items()])
    rows.write.option("compression", "zstd").parquet(path)
    partitions = {name: 1 + (size or 0) // FILE_BYTES for name, size in sizes.get.items()}
    return spark.read.schema(df.schema).parquet(path), partitions


def staging_path(path: str) -> str:
    """A folder beside an output, on the same file system."""
    return f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"


def _sorted_by_id(df: DataFrame, partitions: int) -> DataFrame:
    """Total order by id over all files.

    Ids are hashes, so equal shares of their value range are equal shares of the rows: the target
    partition follows from the leading digits, with no sampling run over the whole input. An id of
    another form is an error.
    """
    row_id = F.when(F.col("id").rlike(_ID_FORM), F.col("id")).otherwise(
        F.raise_error(F.concat(F.lit("not the form of an id: "), F.col("id")))
    )
    leading = F.conv(F.substring(row_id, _ID_DIGITS_AT, _ID_DIGITS), 16, 10).cast("long")
    target = F.floor(leading * partitions / F.lit(16**_ID_DIGITS)).cast("int")
    return df.repartitionById(partitions, target).sortWithinPartitions("id")


def _write_sorted(df: DataFrame, schema: T.StructType, path: str, partitions: int | None, mode: str) -> None:
    """Without `partitions`, the rows are staged first, and a file gets about FILE_BYTES of text."""
    rows = enforce_schema(df, schema)
    if partitions is not None:
        _write(_sorted_by_id(rows, partitions), path, mode)
        return
    stage = staging_path(path)
    try:
        written, counts = staged(rows, stage, {"rows": schema})
        _write(_sorted_by_id(enforce_schema(written, schema), counts["rows"]), path, mode)
    finally:
        delete_path(df.sparkSession, stage)


def _write(rows: DataFrame, path: str, mode: str) -> None:
    options = {"compression": "zstd", "maxRecordsPerFile": FILE_RECORDS}
    rows.write.mode(mode).options(**options).parquet(path)


def write_candidates(
    df: DataFrame, path: str, partitions: int | None = None, mode: str = "overwrite"
) -> None:
    """Candidates as zstd Parquet in id order, in place of an earlier run's."""
    _write_sorted(df, CANDIDATES, path, partitions, mode)


def write_provenance(
    df: DataFrame, path: str, partitions: int | None = None, mode: str = "overwrite"
) -> None:
    """The private lineage table, laid out like the candidates."""
    _write_sorted(df, PROVENANCE, path, partitions, mode)


def require_distinct_paths(candidates_path: str, provenance_path: str) -> None:
    if candidates_path.rstrip("/") == provenance_path.rstrip("/"):
        raise ValueError("candidate and provenance outputs must have different paths")


def write_splits(splits: DataFrame, directory: str, mode: str = "overwrite") -> None:
    """One zstd Parquet directory per split, in place of an earlier run's. Rows are in time order inside a file; the order over
    files is that of (`committed_at_utc`, `id`), so no shuffle is spent on it."""
    (
        enforce_schema(splits, SPLIT_ROWS)
        .sortWithinPartitions("split", "committed_at_utc", "id")
        .write.mode(mode)
        .partitionBy("split")
        .option("compression", "zstd")
        .parquet(directory)
    )


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file on whatever file system the path names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    stream = system.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder on whatever file system the path names; False if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return bool(system.delete(target, True))


def report_json(report: Mapping[str, object]) -> str:
    return json.dumps(report, indent=2, sort_keys=True) + "\n"


def write_manifest(spark: SparkSession, manifest: Mapping[str, object], path: str) -> None:
    """Pretty JSON with sorted keys."""
    _write_text(spark, path, report_json(manifest))


def write_scan_report(
    repositories: DataFrame, totals: DataFrame, roots: list[str], directory: str
) -> None:
    """`totals.json`, and `repositories/` with one JSON line per repository in path order.

    The listing grows with the data, so the tasks write it. E-mails are not part of it.
    """
    row = F.to_json(
        F.struct("author_email_count", "commit_count", "path", "shallow", "status")
    ).alias("value")
    ordered = repositories.orderBy(casefold(F.col("path")), "path")
    ordered.select(row).write.mode("overwrite").text(f"{directory}/repositories")
    report = totals.first().asDict() | {"roots": roots}
    _write_text(repositories.sparkSession, f"{directory}/totals.json", report_json(report))


def write_reviewed(reviewed: DataFrame, directory: str) -> dict[str, int]:
    """Reviewed splits as zstd Parquet; returns the rows written per split."""
    write_splits(reviewed, directory)
    written = reviewed.sparkSession.read.parquet(directory)
    return {row["split"]: row["count"] for row in written.groupBy("split").count().collect()}
