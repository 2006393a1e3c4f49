"""A corpus pipeline of the operators in sievecraft.llm: each stage works on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sievecraft.llm import common, contamination, language, mixing, near_copies, token_shards
from sievecraft.llm.queries import WEIGHTS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

ORACLE_SQL: str | None = None  # language prediction and near copies have no practical SQL


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.understood(docs, language.learned(docs))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.without_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.decontaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mixture: the next stage lays texts end to end as files and rows follow each other."""
    return mixing.mixed_in_order(docs, WEIGHTS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_shards.token_shards(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", known_language),
    ("near copies", one_of_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token shards", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each saved before the next reads it."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
