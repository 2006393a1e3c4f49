"""Glob patterns as a table.

A value can only match a glob if it holds every literal part of it. So each pattern is filed under one gram of its literal
parts, the one that the fewest values hold; values meet the patterns of their own grams in an equi-join, and a regex made
of the pattern decides. Nothing here depends on how many patterns there are: neither does the driver see them, nor is a
value compared with patterns that share no gram with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sievecraft.functions.text import casefold
from sievecraft.operators.joins import lookup_join

# Sizes of grams, in characters: a pattern is filed under the largest that its literal parts allow. Patterns without a
# literal character are filed under the empty gram, which every value holds.
GRAM_SIZES = (8, 4, 2, 1)

_MARK = "\u0000"  # between the pieces of a glob; a literal NUL is escaped in a regex and ends a literal part
_TOKEN = r"(?s)\[!?+.[^\]]*\]|\*+|."


def _tokens(glob: Column) -> Column:
    """Stars, question marks, brackets and single characters of a glob, in order."""
    return F.regexp_extract_all(glob, F.lit(_TOKEN), F.lit(0))


def _escaped(char: Column) -> Column:
    code = F.concat(F.lit(r"\x{"), F.hex(F.ascii(char)), F.lit("}"))
    return F.when(char.rlike(r"\A[A-Za-z0-9]\z"), char).otherwise(code)


def _class_regex(token: Column) -> Column:
    """A bracket: single characters and ranges, of which a reversed one holds nothing."""
    body = F.substr(token, F.lit(2), F.length(token) - 2)
    negated = body.startswith("!")
    members = F.regexp_extract_all(F.regexp_replace(body, r"\A!", ""), F.lit(r"(?s).-.|."), F.lit(0))

    def written(member: Column) -> Column:
        low, high = F.substr(member, F.lit(1), F.lit(1)), F.substr(member, F.lit(3), F.lit(1))
        between = F.when(low <= high, F.concat(_escaped(low), F.lit("-"), _escaped(high))).otherwise("")
        return F.when(F.length(member) == 3, between).otherwise(_escaped(member))

    inside = F.array_join(F.transform(members, written), "")
    empty = F.when(negated, F.lit(".")).otherwise(F.lit("(?!)"))
    return F.when(inside == "", empty).otherwise(
        F.concat(F.when(negated, F.lit("[^")).otherwise(F.lit("[")), inside, F.lit("]"))
    )


def glob_column_regex(glob: Column) -> Column:
    """Java regex of a glob; `*` and `?` match any character. For case-folded globs and values."""

    def piece(token: Column) -> Column:
        return (
            F.when(token.startswith("*"), F.lit(_MARK))
            .when(token == "?", F.lit("."))
            .when(F.length(token) > 1, _class_regex(token))
            .otherwise(_escaped(token))
        )

    pieces = F.split(F.array_join(F.transform(_tokens(glob), piece), ""), _MARK)
    count = F.size(pieces)
    # The first place where an inner piece fits is enough, so no backtracking into it.
    inner = F.transform(
        F.slice(pieces, F.lit(2), F.greatest(count - 2, F.lit(0))),
        lambda part: F.concat(F.lit("(?>.*?"), part, F.lit(")")),
    )
    tail = F.when(count == 1, F.lit("")).otherwise(
        F.concat(F.array_join(inner, ""), F.lit(".*"), F.element_at(pieces, -1))
    )
    return F.concat(F.lit(r"(?s)\A"), pieces[0], tail, F.lit(r"\z"))


def _grams(text: Column, size: int | Column) -> Column:
    """All pieces of `size` characters; none of a shorter text."""
    last = F.length(text) - size + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    width = F.lit(size) if isinstance(size, int) else size
    return F.transform(places, lambda place: F.substr(text, place, width))


def _filed(patterns: DataFrame, column: str) -> DataFrame:
    """Rows (pattern, folded, size, gram): the grams that each distinct pattern could be filed under."""
    folded = patterns.select(F.col(column).alias("pattern")).filter(F.col("pattern").isNotNull()).distinct()
    folded = folded.withColumn("folded", casefold(F.col("pattern")))
    plain = F.transform(
        _tokens(F.col("folded")),
        lambda token: F.when((F.length(token) == 1) & ~token.isin("*", "?"), token).otherwise(F.lit(_MARK)),
    )
    parts = folded.withColumn("parts", F.split(F.array_join(plain, ""), f"{_MARK}+"))
    longest = F.array_max(F.transform("parts", lambda part: F.length(part)))
    size = F.lit(0)
    for number in sorted(GRAM_SIZES):
        size = F.when(longest >= number, number).otherwise(size)
    sized = parts.withColumn("size", size)
    held = F.flatten(F.transform("parts", lambda part: _grams(part, F.col("size"))))
    grams = F.when(F.col("size") == 0, F.array(F.lit(""))).otherwise(F.array_distinct(held))
    return sized.select("pattern", "folded", "size", F.explode(grams).alias("gram"))


def _held(values: DataFrame, value: str, sizes: Sequence[int]) -> DataFrame:
    """The values with each distinct gram that they hold, case-folded in `_folded`."""
    folded = values.filter(F.col(value).isNotNull()).withColumn("_folded", casefold(F.col(value)))
    lists = [F.array(F.lit("")) if size == 0 else _grams(F.col("_folded"), size) for size in sizes]
    grams = F.array_distinct(F.concat(*lists)) if lists else F.array().cast("array<string>")
    return folded.withColumn("gram", F.explode(grams))


def glob_matches(
    values: DataFrame, patterns: DataFrame, value: str = "value", pattern: str = "pattern"
) -> DataFrame:
    """The rows of `values` once for each distinct pattern that their value matches, ignoring case, in the column `pattern`.

    Null values match nothing, null patterns are left out. The patterns, which may be very many, are broadcast only if
    they measure small; otherwise both sides are shuffled by gram, with the grams that very many values hold spread.
    `values` must not have columns named pattern, gram or _folded.
    """
    clash = {"pattern", "gram", "_folded"} & set(values.columns)
    if clash:
        raise ValueError(f"columns with reserved names: {', '.join(sorted(clash))}")
    options = _filed(patterns, pattern)
    # Bounded by GRAM_SIZES, whatever the patterns are.
    sizes = sorted(row["size"] for row in options.select("size").distinct().collect())
    held = _held(values, value, sizes)
    wanted = options.select("gram").distinct()
    counts = lookup_join(held.select("gram"), wanted, "gram", [F.rand(0)], "inner").groupBy("gram").count()
    rarest = F.min_by(F.col("gram"), F.struct("count", "gram"))
    # A pattern with a gram that no value holds matches nothing.
    filed = (
        options.join(counts, "gram", "left")
        .withColumn("count", F.coalesce("count", F.lit(0)))
        .groupBy("pattern", "folded")
        .agg(rarest.alias("gram"), F.min("count").alias("count"))
        .filter(F.col("count") > 0)
        .select("gram", "pattern", glob_column_regex(F.col("folded")).alias("_regex"))
    )
    # A value holds a gram once, and a pattern is filed once, so a pair meets at most once.
    pairs = lookup_join(held, filed, "gram", ["_folded"], "inner")
    found = pairs.filter(F.rlike("_folded", F.col("_regex")))
    return found.select(*values.columns, "pattern")


def with_match_flag(rows: DataFrame, key: str, values: Column, patterns: DataFrame, flag: str) -> DataFrame:
    """`rows` with a boolean column: whether any of an array of values matches a pattern of the table.

    `key` is unique in `rows`.
    """
    listed = rows.select(key, F.explode(F.array_distinct(values)).alias("value"))
    matched = glob_matches(listed, patterns).select(key).distinct().withColumn(flag, F.lit(True))
    return rows.join(matched, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
