"""Predicates and the two first-match cascades."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sievecraft.functions.paths import any_glob_match
from sievecraft.functions.text import LINE_BREAK, identity_key

# Fixed values: `fixup!`, `squash!` and `amend!` under case folding, to which the fi ligature and
# the long s belong.
FIXUP = (
    r"\A(?:(?:[fF][iI]|\uFB01)[xX][uU][pP]"
    r"|[sS\u017F][qQ][uU][aA][sS\u017F][hH]"
    r"|[aA][mM][eE][nN][dD])!"
)
# The reasons in the order in which they apply.
REJECTION_REASONS = (
    "author_not_matched",
    "merge",
    "empty_subject",
    "fixup",
    "empty_change",
    "binary",
    "generated_only",
)
MAX_SUBJECT_LENGTH = 72


def identity_set(names: Iterable[str]) -> list[str]:
    """Normalised, distinct, non-blank identities of an allow-list; an empty one is an error."""
    keys = sorted({name.strip().casefold() for name in names if name.strip()})
    if not keys:
        raise ValueError("author_emails needs at least one entry")
    return keys


def author_matched(email: Column, allowed: Iterable[str]) -> Column:
    """Whether an e-mail is on the list; a null one is not."""
    return F.coalesce(identity_key(email).isin(identity_set(allowed)), F.lit(False))


def is_merge(parent_hashes: Column) -> Column:
    return F.coalesce(F.size(parent_hashes) > 1, F.lit(False))


def is_fixup(subject: Column) -> Column:
    return subject.rlike(FIXUP)


def first_match(branches: Sequence[tuple[Column, str]]) -> Column:
    """Name of the first condition that holds, null if none does."""
    chain = F
    for condition, name in branches:
        chain = chain.when(condition, F.lit(name))
    return chain.otherwise(F.lit(None).cast("string"))


def metadata_reason(author_ok: Column, parent_hashes: Column, subject: Column) -> Column:
    """The part of the rejection cascade that needs no changed paths.

    It fails closed: an author who is not known to match does not, and a null subject is empty.
    Null parents are no merge.
    """
    return first_match(
        [
            (~F.coalesce(author_ok, F.lit(False)), "author_not_matched"),
            (is_merge(parent_hashes), "merge"),
            (F.coalesce(subject, F.lit("")) == "", "empty_subject"),
            (is_fixup(subject), "fixup"),
        ]
    )


def change_reason(path_count: Column, has_binary: Column, generated_only: Column) -> Column:
    """The rest of the cascade. A commit without change statistics has no changed path."""
    return first_match(
        [
            (F.coalesce(path_count, F.lit(0)) == 0, "empty_change"),
            (has_binary, "binary"),
            (generated_only, "generated_only"),
        ]
    )


def scan_status(
    path_options: Column,
    slugs: Column,
    ignore_paths: Sequence[str] = (),
    ignore_remotes: Sequence[str] = (),
) -> Column:
    """`ignored_path`, else `ignored_remote`, else `included`."""
    return F.coalesce(
        first_match(
            [
                (any_glob_match(path_options, ignore_paths), "ignored_path"),
                (any_glob_match(slugs, ignore_remotes), "ignored_remote"),
            ]
        ),
        F.lit("included"),
    )


def only_included(repositories: DataFrame) -> DataFrame:
    return repositories.filter(F.col("status") == "included")


def utc_bound(bound: dt.datetime) -> str:
    """A bound as text. Stored instants are whole seconds, so a fraction rounds up on both sides."""
    if bound.tzinfo is None:
        raise ValueError("a date bound needs a time zone")
    whole = bound.astimezone(dt.UTC)
    if whole.microsecond:
        whole = whole.replace(microsecond=0) + dt.timedelta(seconds=1)
    return whole.strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")


def date_window(
    df: DataFrame,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    column: str = "committed_at_utc",
) -> DataFrame:
    """Rows with `since <= t < until`. Compares the stored text, which sorts like time, so the
    filter reaches the Parquet scan."""
    if since is not None:
        df = df.filter(F.col(column) >= utc_bound(since))
    if until is not None:
        df = df.filter(F.col(column) < utc_bound(until))
    return df


def output_contract(subject: Column) -> Column:
    """Struct of one boolean per rule of a usable subject, and `ok` for all of them."""
    rules = {
        "short": F.length(subject) <= MAX_SUBJECT_LENGTH,
        "one_line": (subject != "") & ~subject.rlike(f"[{LINE_BREAK}]"),
        "no_markdown": ~subject.rlike(
            r"\A(?:#{1,6} |[-*+>] |[0-9]+[.)] |```)|`[^`]+`|\*\*[^*]+\*\*|__[^_]+__|\]\("
        ),
        "no_quotes": ~subject.rlike(r"""\A(?:"[^"]*"|'[^']*'|\u201C[^\u201D]*\u201D)\z"""),
        "no_preamble": ~subject.rlike(
            r"(?i)\A(?:sure|certainly|of course|okay|here is|here's|here are"
            r"|the commit (?:message|subject)|commit (?:message|subject)|subject)\b[^:]*:"
        ),
    }
    every = None
    for rule in rules.values():
        every = rule if every is None else every & rule
    return F.struct(*[rule.alias(name) for name, rule in rules.items()], every.alias("ok"))
