"""Languages of changed files by name, and by content where the name says nothing.

The files whose names are known teach what each language looks like: in how many of its files each token occurs. A file
without a known name gets the language under which its tokens are likeliest. All of it is counting and joining; weights
are whole thousandths of a natural logarithm, so sums do not depend on their order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from sievecraft.functions.text import LINE_BREAK, changed_files, guess_language
from sievecraft.operators.joins import HOT_KEYS, lookup_join

UNKNOWN = "unknown"
_TOKEN = r"[\p{L}_][\p{L}\p{N}_]*|[^\s\p{L}\p{N}_]"
_HEADER = "+++ b/"


def content_tokens(text: Column) -> Column:
    """Distinct words and punctuation marks of a text; numbers are left out."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)))


def file_sections(patches: DataFrame, diff: str = "diff") -> DataFrame:
    """One row for each file that `changed_files` finds: its `place` from 0 on, `file`, and `content`, the lines added to it.

    The other columns are kept, without the diff.
    """
    keys = [name for name in patches.columns if name != diff]
    parts = F.split(F.col(diff), rf"(?:\r\n|[{LINE_BREAK}])")
    heads = F.array_compact(
        F.transform(parts, lambda line, k: F.when(line.startswith(_HEADER), k))
    )
    ends = F.slice(F.concat(heads, F.array(F.size(parts))), F.lit(2), F.size(heads))
    spans = F.arrays_zip(heads.alias("start"), ends.alias("end"))

    def added(span: Column) -> Column:
        lines = F.slice(F.col("_parts"), span["start"] + 2, F.greatest(span["end"] - span["start"] - 1, F.lit(0)))
        kept = F.filter(lines, lambda line: line.startswith("+") & ~line.startswith("+++"))
        return F.array_join(F.transform(kept, lambda line: F.substr(line, F.lit(2))), "\n")

    listed = patches.select(*keys, parts.alias("_parts"), spans.alias("_spans"), changed_files(F.col(diff)).alias("_files"))
    contents = F.transform("_spans", added)
    both = F.arrays_zip(F.col("_files").alias("file"), contents.alias("content"))
    return listed.select(*keys, F.posexplode(both).alias("place", "_f")).select(*keys, "place", "_f.file", "_f.content")


@dataclass(frozen=True)
class ContentModel:
    """`tokens`: (token, weights: array of (language, gain)), one row for each known token. `languages`: number of files of
    each language; there are no more of these than the library has names for, or the given table. `frequent`: the tokens
    that hold more than 1/HOT_KEYS of the tokens of all learned files, each file's counted once."""

    tokens: DataFrame
    languages: dict[str, int]
    frequent: list[str] | None = None

    def absent(self) -> Column:
        """Array of (language, start, absent): the score of a language before tokens, and for a token that it lacks."""
        total = sum(self.languages.values())
        return F.array(
            *[
                F.struct(
                    F.lit(name).alias("language"),
                    _thousandths(F.lit(files) / F.lit(total)).alias("start"),
                    _thousandths(F.lit(1) / F.lit(files + 2)).alias("absent"),
                )
                for name, files in sorted(self.languages.items())
            ]
        )


def _thousandths(share: Column) -> Column:
    return F.round(F.log(share) * 1000).cast("long")


def learned(files: DataFrame, language: str = "language", content: str = "content") -> ContentModel:
    """Count tokens per language over all files with a language other than unknown or null."""
    named = files.filter((F.col(language) != UNKNOWN) & F.col(content).isNotNull())
    sizes = {row[0]: row[1] for row in named.groupBy(language).count().collect()}
    rows = named.select(F.col(language).alias("language"), F.explode(content_tokens(F.col(content))).alias("token"))
    counts = rows.groupBy("language", "token").agg(F.count("*").alias("n"))
    table = F.create_map(*[F.lit(x) for pair in sorted(sizes.items()) for x in pair]) if sizes else F.create_map()
    files_of = F.element_at(table.cast("map<string,bigint>"), F.col("language"))
    gain = _thousandths((F.col("n") + 1) / (files_of + 2)) - _thousandths(F.lit(1) / (files_of + 2))
    gains = counts.select("token", "n", F.struct("language", gain.alias("gain")).alias("weight"))
    # A token has at most one weight for each language.
    weights = F.sort_array(F.collect_list("weight")).alias("weights")
    tokens = gains.groupBy("token").agg(weights, F.sum("n").alias("n")).persist(StorageLevel.DISK_ONLY)  # read four times
    total = tokens.agg(F.sum("n")).first()[0] or 0
    frequent = [row[0] for row in tokens.filter(F.col("n") * HOT_KEYS > total).select("token").collect()]
    return ContentModel(tokens.select("token", "weights"), sizes, frequent)


def guessed_languages(files: DataFrame, model: ContentModel, key: str, content: str = "content") -> DataFrame:
    """Rows (key, language) of the files with at least one known token: the likeliest language, ties to the smaller name.

    `key` is unique. Tokens are matched by a join in which those that very many learned files hold are spread; one row of
    gains by language is added up for each file and token.
    """
    rows = files.select(key, F.explode(content_tokens(F.col(content))).alias("token"))
    names = sorted(model.languages)
    held = F.map_from_entries("weights")
    gains = [F.coalesce(F.try_element_at(held, F.lit(name)), F.lit(0)).alias(f"_g{k}") for k, name in enumerate(names)]
    known = lookup_join(rows, model.tokens.select("token", *gains), "token", [key], "inner", hot=model.frequent)
    sums = [F.sum(f"_g{k}").alias(f"_g{k}") for k in range(len(names))]
    per_file = known.groupBy(key).agg(F.count("*").alias("n"), *sums)
    absent = model.absent()

    def score(k: int) -> Column:
        # Each known token counts as absent in every language; the languages that have it gain the difference.
        loss = -absent[k]["start"] - F.col("n") * absent[k]["absent"] - F.col(f"_g{k}")
        return F.struct(loss.alias("loss"), absent[k]["language"].alias("language"))

    scores = F.array(*map(score, range(len(names))))
    return per_file.select(key, F.array_min(scores)["language"].alias("language"))


def with_languages(files: DataFrame, key: str, file: str = "file", content: str = "content") -> DataFrame:
    """`files` with `language`: by name, else by content as the named files of the same table teach it, else unknown."""
    named = files.withColumn("_named", guess_language(F.col(file)))
    model = learned(named, "_named", content)
    if not model.languages:
        return named.withColumnRenamed("_named", "language")
    unnamed = named.filter(F.col("_named") == UNKNOWN)
    guesses = guessed_languages(unnamed, model, key, content).withColumnRenamed("language", "_guess")
    return named.join(guesses, key, "left").select(
        *files.columns, F.coalesce("_guess", "_named").alias("language")
    )


def language_counts_by_content(splits: DataFrame) -> DataFrame:
    """Changed files per split and language, where the content tells the language of files with unknown names."""
    files = file_sections(splits.select("split", "id", "diff"))
    keyed = files.withColumn("_key", F.concat_ws(":", "id", "place"))
    found = with_languages(keyed, "_key")
    return found.groupBy("split", "language").agg(F.count("*").alias("files"))
