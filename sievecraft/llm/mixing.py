"""Mixing of sources to target weights by Pfair scheduling.

The rows of a source are put in a fixed random order and cut into blocks. A period has as many slots as the weights of
the sources that still have blocks add up to, and in each a source of weight w places w blocks; its k-th may not come
before k W / w slots have passed and must be placed before (k + 1) W / w have. The earliest deadline among the released
blocks goes first. So at every slot each source is less than one block from its share. When a source runs out, the
others go on in their proportions; no row is dropped or repeated.

All of it is expressed in DataFrame functions. What is gathered is one count for each weighted source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 32  # rows of a block
BUCKETS = 4096  # parts of a source's random order that are ranked by themselves
PERIOD = 10_000  # the weights' sum at most; bounds the schedule
PART = 32 << 20  # bytes of text in an output partition
ADDED = ("mix_period", "mix_slot", "mix_row", "mix_position")


def _source(name: str, weights: Mapping[str, int]) -> Column:
    """Number of the row's source: its place in `weights`, or one more than the last for all others and null."""
    number = F.create_map(*(F.lit(x) for k, name in enumerate(weights) for x in (name, k))) if weights else None
    return F.coalesce(number[F.col(name)], F.lit(len(weights))) if weights else F.lit(0)


def _earliest_deadline(weights: Column) -> Column:
    """The source of each slot of a period, from an array with the weight of each source (0: without blocks)."""
    total = F.aggregate(weights, F.lit(0).cast("long"), lambda a, x: a + x)

    def step(state: Column, slot: Column) -> Column:
        jobs = F.transform(
            F.arrays_zip(state["done"].alias("k"), weights.alias("w")),
            lambda job, source: F.when(
                (job["k"] < job["w"]) & (F.floor(job["k"] * total / job["w"]) <= slot),
                F.struct(F.ceil((job["k"] + 1) * total / job["w"]).alias("deadline"), source.alias("source")),
            ),
        )
        chosen = F.array_min(F.filter(jobs, lambda x: x.isNotNull()))["source"]
        done = F.transform(state["done"], lambda k, source: F.when(source == chosen, k + 1).otherwise(k))
        return F.struct(done.alias("done"), F.concat(state["order"], F.array(chosen)).alias("order"))

    start = F.struct(
        F.transform(weights, lambda w: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("order")
    )
    slots = F.sequence(F.lit(0).cast("long"), total - 1)
    return F.aggregate(slots, start, step, lambda state: state["order"])


def mixed(
    docs: DataFrame, weights: Mapping[str, int], other: int = 1, block: int = BLOCK, seed: int = 0
) -> DataFrame:
    """`docs` with the columns mix_period, mix_slot, mix_row (place in the block) and mix_position, which orders all rows.

    weights: positive whole numbers by source; `other` is the weight of all further sources, null included, together.
    Positions are distinct and grow with (period, slot, row); they have gaps where a block is not full. Rows that agree
    in doc_id and text share a place in the order of their source, one after the other. A column of `docs` with the name of
    an added one is replaced.
    """
    return _mixed(docs, weights, other, block, seed)[0]


def _mixed(docs: DataFrame, weights: Mapping[str, int], other: int, block: int, seed: int) -> tuple[DataFrame, int]:
    """Rows of `mixed`, and a bound of their positions."""
    values = [*weights.values(), other]
    if not all(isinstance(w, int) and w > 0 for w in values) or sum(values) > PERIOD:
        raise ValueError(f"weights are positive whole numbers of a sum up to {PERIOD}")
    names = {name: f"c{k}" for k, name in enumerate(docs.columns)}  # whatever they are called, ours differ
    plain = docs.toDF(*names.values())
    told = (F.coalesce(F.col(names[x]).cast("string"), F.lit("")) for x in ("doc_id", "text"))
    rank = F.md5(F.concat_ws("|", F.lit(str(seed)), *told))
    rows = plain.select("*", _source(names["source"], weights).alias("_source"), rank.alias("_rank"))
    rows = rows.withColumn("_bucket", F.conv(F.substring("_rank", 1, 3), 16, 10).cast("int") % BUCKETS)
    sizes = rows.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    counts = {row[0]: row[1] for row in sizes.groupBy("_source").agg(F.sum("_size")).collect()}
    before = F.sum("_size").over(
        Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select("_source", "_bucket", F.coalesce(before, F.lit(0)).alias("_offset"))
    own = F.row_number().over(Window.partitionBy("_source", "_bucket").orderBy("_rank"))
    placed = rows.withColumn("_own", own).join(offsets, ["_source", "_bucket"])

    last = {k: -(-(-(-counts.get(k, 0) // block)) // values[k]) for k in range(len(values))}  # periods with blocks
    starts = sorted({0, *last.values()} - {max(last.values())}) or [0]
    phases = [
        (k, start, [w if last[i] > start else 0 for i, w in enumerate(values)]) for k, start in enumerate(starts)
    ]
    base, bases = 0, []
    for (_, start, alive), end in zip(phases, [*starts[1:], max(last.values())]):
        bases.append(base)
        base += (end - start) * sum(alive) * block
    literal = F.array(
        *(F.struct(F.lit(k).alias("_phase"), F.array(*(F.lit(w).cast("long") for w in alive)).alias("w")) for k, _, alive in phases)
    )
    spark = docs.sparkSession
    schedule = (
        spark.range(1)
        .select(F.explode(literal).alias("x"))
        .select("x._phase", "x.w")
        .filter(F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x) > 0)
        .select("_phase", F.posexplode(_earliest_deadline(F.col("w"))).alias("mix_slot", "_source"))
        .withColumn("_turn", F.row_number().over(Window.partitionBy("_phase", "_source").orderBy("mix_slot")) - 1)
    )
    weight = F.array(*(F.lit(w) for w in values))[F.col("_source")]
    number = (F.col("_offset") + F.col("_own") - 1).cast("long")
    begin = F.array(*(F.lit(x) for x in starts))
    placed = (
        placed.withColumn("_block", F.floor(number / block))
        .withColumn("mix_row", (number % block).cast("int"))
        .withColumn("mix_period", F.floor(F.col("_block") / weight))
        .withColumn("_turn", (F.col("_block") % weight).cast("int"))
        .withColumn("_phase", F.size(F.filter(begin, lambda x: x <= F.col("mix_period"))) - 1)
    )
    at = lambda values: F.array(*(F.lit(x).cast("long") for x in values))[F.col("_phase")]
    period = F.col("mix_period") - at(starts)
    position = at(bases) + (period * at([sum(x[2]) for x in phases]) + F.col("mix_slot")) * block + F.col("mix_row")
    joined = placed.join(F.broadcast(schedule), ["_phase", "_source", "_turn"])  # at most phases x PERIOD small rows
    kept = [F.col(c).alias(name) for name, c in names.items() if name.lower() not in ADDED]
    period = F.col("mix_period").cast("long").alias("mix_period")
    return joined.select(*kept, period, "mix_slot", "mix_row", position.alias("mix_position")), base


def mixed_in_order(
    docs: DataFrame, weights: Mapping[str, int], other: int = 1, block: int = BLOCK, seed: int = 0
) -> DataFrame:
    """`docs`, partitioned and sorted by position, without sampling; written as Parquet, files follow each other in order."""
    rows, end = _mixed(docs, weights, other, block, seed)
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    parts = 1 + size // PART
    part = F.floor(F.col("mix_position") / max(-(-end // parts), 1)).cast("int")
    ordered = rows.repartitionById(int(parts), part).sortWithinPartitions("mix_position")
    return ordered.select(*(x for x in docs.columns if x.lower() not in ADDED))
