"""Text functions against Python's standard library and fixed vectors."""

from __future__ import annotations

import datetime as dt
import unicodedata

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievecraft.functions import text
from sievecraft.operators import filters

WHITESPACE_SAMPLES = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def test_whitespace_set_is_pythons():
    assert set(text.WHITESPACE_CHARS) == set(WHITESPACE_SAMPLES)


def test_subject(apply):
    values = [
        "Caf" + "e\u0301  au\tlait",
        "a\u00a0b\u3000c\u001cd\r\ne",
        "  Keep Case  ",
        " \t\u2003 ",
        "",
        "\u1112\u1161\u11ab \ufb01x",
        *[f"{c}x{c}{c}y{c}" for c in WHITESPACE_SAMPLES],
    ]
    expected = [" ".join(unicodedata.normalize("NFC", value).split()) for value in values]
    assert apply(text.normalise_subject, values) == expected


def test_patch_text_keeps_blanks_and_joins_line_ends(apply):
    values = ["+a   \r\n-b\r\r\n c \n\n", "+e\u0301   \n", "", "\u2028a\u000b"]
    expected = [
        unicodedata.normalize("NFC", v).replace("\r\n", "\n").replace("\r", "\n") for v in values
    ]
    assert apply(text.normalise_patch_text, values) == expected


def test_nfc_passes_nulls_and_all_forms(apply):
    values = [None, "plain", "\u00e9", "e\u0301", "\u1100\u1161", "\u0344", "q\u0307\u0323", "\u212b"]
    expected = [value and unicodedata.normalize("NFC", value) for value in values]
    assert apply(text.nfc, values) == expected


def test_casefold_of_every_assigned_character(apply):
    chars = [
        chr(c)
        for c in range(1, 0x20000)
        if not 0xD800 <= c <= 0xDFFF
        and chr(c) != "\ufeff"
        and unicodedata.category(chr(c)) != "Cn"
    ]
    folded = apply(text.casefold, chars)
    assert [(c, f) for c, f in zip(chars, folded) if f != c.casefold()] == []


def test_identity_key(apply):
    values = [" Person@Example.com\n", "STRASSE", "Stra\u00dfe\u2003", "\u039f\u0394\u039f\u03a3", ""]
    assert apply(text.identity_key, values) == [v.strip().casefold() for v in values]


UTC_VECTORS = {
    "2024-01-01T01:30:00+02:00": "2023-12-31T23:30:00Z",
    "2024-03-10T10:00:00Z": "2024-03-10T10:00:00Z",
    "2024-01-01T00:00:00-05:30": "2024-01-01T05:30:00Z",
    " 2024-03-31T02:30:00.999999+00:00\n": "2024-03-31T02:30:00Z",
    "1969-12-31T23:59:59.5+00:00": "1969-12-31T23:59:59Z",
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin"])
def test_as_utc_in_any_session_zone(spark, apply, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert apply(text.as_utc, list(UTC_VECTORS)) == list(UTC_VECTORS.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_utc_rejects_other_text(apply):
    assert apply(lambda c: F.unix_seconds(text.parse_utc(c)), ["1970-01-02T00:00:00Z"]) == [86400]
    with pytest.raises(PySparkException):
        apply(text.parse_utc, ["yesterday"])


def test_parents(apply):
    assert apply(text.parents, ["", "  ", "a", "a b\n c "]) == [[], [], ["a"], ["a", "b", "c"]]


def test_changed_files(apply):
    diffs = [
        "--- a/x\n+++ b/x.py\n@@\n+++ b/not at start\n",
        "+++ b/a.py\r\n+ +++ b/no\r+++ b/c d.md\u2028+++ b/e",
        "--- a/x\n+++ /dev/null\n",
        "x+++ b/a",
        "",
    ]
    expected = [
        [line[6:] for line in diff.splitlines() if line.startswith("+++ b/")] for diff in diffs
    ]
    assert apply(text.changed_files, diffs) == expected
    assert expected[1] == ["a.py", "c d.md", "e"]


def test_language(apply):
    names = ["src/a.py", "Makefile", "x/Dockerfile", "a.tar.GO", "README", "noext.", ".py", "a.b/c"]
    expected = ["python", "makefile", "dockerfile", "go", "unknown", "unknown", "python", "c"]
    assert apply(text.guess_language, names) == expected


def test_truncate_tokens(apply):
    values = ["a b c", " a  b \n", "a b c d", "a\tb\u3000c\nd e", "", "   ", None]
    got = apply(lambda c: text.truncate_tokens(c, 3), values)
    assert [tuple(row) for row in got[:-1]] == [
        ("a b c", False),
        (" a  b \n", False),
        ("a b c", True),
        ("a\tb\u3000c", True),
        ("", False),
        ("   ", False),
    ]


def test_truncate_long_text_without_recursion(apply):
    long = " ".join(f"word{i}" for i in range(60_000))
    (row,) = apply(lambda c: text.truncate_tokens(c, 50_000), [long])
    assert row["truncated"] and row["text"] == long[: long.index(" word50000")]


def test_review_prompt(spark):
    df = spark.createDataFrame([("s %s \\", "d")], "s string, d string")
    system, user = df.select(text.review_prompt(F.col("s"), F.col("d"))).first()[0]
    assert (system["role"], user["role"]) == ("system", "user")
    assert user["content"].startswith("Historical subject: s %s \\\n\nDiff:\nd\n\nReturn exactly")


def test_canonical_json(spark):
    df = spark.createDataFrame([("\u00e9\u2028", None, 1)], "b string, a string, c int")
    assert df.select(text.canonical_json("c", "b", "a")).first()[0] == (
        '{"a":null,"b":"\u00e9\u2028","c":1}'
    )


def test_fixup(apply):
    yes = ["Fixup! a", "\ufb01xup! a", "AMEND! c", "squa\u017fh! b", "\u017fQUASH! b", "fixup!"]
    no = ["amended", "fixup a", "xfixup!", " fixup! a", ""]
    assert apply(filters.is_fixup, yes + no) == [True] * len(yes) + [False] * len(no)
    prefixes = ("fixup!", "squash!", "amend!")
    assert all(value.casefold().startswith(prefixes) for value in yes)


def test_output_contract(apply):
    values = {
        "Add retry to upload": (),
        "x" * 72: (),
        "x" * 73: ("short",),
        "a\nb": ("one_line",),
        "": ("one_line",),
        "# Add": ("no_markdown",),
        "- Add": ("no_markdown",),
        "Use `x`": ("no_markdown",),
        "See [x](y)": ("no_markdown",),
        '"Add x"': ("no_quotes",),
        "'Add x'": ("no_quotes",),
        "Sure, here it is: Add x": ("no_preamble",),
        "Commit message: Add x": ("no_preamble",),
        "feat(core): add x": (),
        "Surely: works": (),
        "Don't use 'x'": (),
    }
    rows = apply(filters.output_contract, list(values))
    for (subject, broken), row in zip(values.items(), rows):
        found = tuple(name for name in row.asDict() if name != "ok" and not row[name])
        assert (found, row["ok"]) == (broken, not broken), subject


def test_date_bounds_round_up():
    at = dt.datetime(2024, 1, 1, 0, 0, 0, 1, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert filters.utc_bound(at) == "2023-12-31T22:00:01Z"
    assert filters.utc_bound(at.replace(microsecond=0)) == "2023-12-31T22:00:00Z"
    with pytest.raises(ValueError, match="time zone"):
        filters.utc_bound(dt.datetime(2024, 1, 1))


def test_date_window(spark):
    rows = [(f"2024-01-0{day}T00:00:00Z",) for day in range(1, 6)]
    df = spark.createDataFrame(rows, "committed_at_utc string")
    since = dt.datetime(2024, 1, 2, tzinfo=dt.UTC)
    until = dt.datetime(2024, 1, 4, tzinfo=dt.UTC)

    def days(*bounds):
        return sorted(int(r[0][9]) for r in filters.date_window(df, *bounds).collect())

    assert days(since, until) == [2, 3]
    assert days(since) == [2, 3, 4, 5]
    assert days(None, until) == [1, 2, 3]
    assert days(None, until + dt.timedelta(microseconds=1)) == [1, 2, 3, 4]
    assert days() == [1, 2, 3, 4, 5]


def test_language_of_a_name_with_blanks(apply):
    names = ["docs/my file.py\t", "my notes.md\t", "a.py\t\t", "x.py"]
    got = apply(text.guess_language, names)
    assert got[0] == got[3] != "unknown" and got[1] != "unknown" and got[2] == "unknown"
