"""Column functions over text, instants and diffs. Each takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's str.split() and str.strip() treat as white space.
# Java's \s covers fewer of them, so the set is spelled out.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200A"
    "\u2028\u2029\u202F\u205F\u3000"
)
WHITESPACE = (
    r"\u0009-\u000D\u001C- \u0085\u00A0\u1680"
    r"\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
)
# The same set with one range in front of the rare members, so that the regex engine turns down an
# ordinary character after two tests.
_BLANKS = (
    rf"[[\t-\r\x1C- ][\x85-\u3000&&[\x85\xA0\u1680\u2000-\u200A"
    rf"\u2028\u2029\u202F\u205F\u3000]]]++"
)
# The characters at which str.splitlines() ends a line (CR LF counts once).
LINE_BREAK = r"\n\r\u000B\u000C\u001C-\u001E\u0085\u2028\u2029"

# A text of code points below U+0300 only is in NFC already: it holds no combining mark and
# nothing that composes with one.
_MAY_NEED_NFC = r"[^\u0000-\u02FF]"

# Case folding differs from lower(upper(x)) on these only. U+FDD0 is a noncharacter; it carries
# the dotless i past upper(), which would turn it into a plain I.
_BEFORE_UPPER = ("\u0131\u1E9E", "\uFDD0\xdf")
_CHEROKEE_SMALL = "".join(map(chr, [*range(0xAB70, 0xABC0), *range(0x13F8, 0x13FE)]))
_CHEROKEE_CAPITAL = "".join(map(chr, [*range(0x13A0, 0x13F0), *range(0x13F0, 0x13F6)]))
_AFTER_LOWER = ("\uFDD0\u03C2" + _CHEROKEE_SMALL, "\u0131\u03C3" + _CHEROKEE_CAPITAL)

# File extension (or whole lower-case file name) to language.
LANGUAGES = {
    "bash": "bash", "bat": "batch", "c": "c", "cc": "cpp", "clj": "clojure", "cpp": "cpp",
    "cs": "csharp", "css": "css", "csv": "csv", "cxx": "cpp", "dart": "dart",
    "dockerfile": "dockerfile", "elm": "elm", "erl": "erlang", "ex": "elixir", "exs": "elixir",
    "fs": "fsharp", "go": "go", "gradle": "groovy", "groovy": "groovy", "h": "c", "hpp": "cpp",
    "hs": "haskell", "htm": "html", "html": "html", "ini": "ini", "java": "java",
    "jl": "julia", "js": "javascript", "json": "json", "jsx": "javascript", "kt": "kotlin",
    "kts": "kotlin", "less": "less", "lua": "lua", "m": "objective-c", "makefile": "makefile",
    "md": "markdown", "ml": "ocaml", "mjs": "javascript", "php": "php", "pl": "perl",
    "pm": "perl", "proto": "protobuf", "ps1": "powershell", "py": "python", "pyi": "python",
    "r": "r", "rb": "ruby", "rs": "rust", "rst": "restructuredtext", "sass": "sass",
    "scala": "scala", "scss": "scss", "sh": "bash", "sql": "sql", "swift": "swift",
    "tex": "tex", "toml": "toml", "ts": "typescript", "tsx": "typescript", "vb": "vbnet",
    "vue": "vue", "xml": "xml", "yaml": "yaml", "yml": "yaml", "zsh": "bash",
}

# The two review messages.
REVIEW_SYSTEM_MESSAGE = (
    "Summarize a Git diff for a human reviewing a historical commit subject. "
    "Be factual and concise. Do not decide whether to approve or reject the subject."
)
REVIEW_USER_FORMAT = (
    "Historical subject: %s\n\n"
    "Diff:\n%s\n\n"
    "Return exactly three bullets: main change, affected areas, and whether the subject "
    "appears accurate, vague, or mismatched with a brief reason."
)


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _arrow_nfc():
    # A closure, so that executors need no copy of this package. Arrow's own utf8_normalize is no
    # help: it leaves NFC text decomposed.
    def compose(texts):
        from unicodedata import normalize

        import pyarrow as pa

        composed = (text and normalize("NFC", text) for text in texts.to_pylist())
        return pa.array(composed, pa.string())

    return F.arrow_udf(compose, "string")


def nfc(text: Column) -> Column:
    """Unicode normalisation form C.

    Spark has no built-in for it. Only texts that may change are sent to Python, in Arrow batches;
    all others stay in the JVM.
    """
    doubtful = F.when(~_is_ascii(text) & text.rlike(_MAY_NEED_NFC), text)
    return F.coalesce(_arrow_nfc()(doubtful), text)


def strip(text: Column) -> Column:
    """Cut Unicode white space at both ends."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def casefold(text: Column) -> Column:
    """Full Unicode case folding from built-ins.

    The translate between upper and lower also keeps the optimizer from merging the two calls.
    """
    folded = F.translate(
        F.lower(F.translate(F.upper(F.translate(text, *_BEFORE_UPPER)), "\xdf", "\xdf")),
        *_AFTER_LOWER,
    )
    return F.when(_is_ascii(text), F.lower(text)).otherwise(folded)


def identity_key(text: Column) -> Column:
    """Comparable form of an e-mail or name: stripped and case-folded."""
    return casefold(strip(text))


def squeeze(text: Column) -> Column:
    """One line with single spaces between words."""
    return F.btrim(F.regexp_replace(text, _BLANKS, " "), F.lit(" "))


def normalise_subject(text: Column) -> Column:
    """NFC on one line, with single spaces between words; letter case is left alone."""
    return squeeze(nfc(text))


def normalise_patch_text(text: Column) -> Column:
    """NFC with every line end as LF; nothing is trimmed."""
    return F.regexp_replace(nfc(text), "\r\n?", "\n")


def as_utc(text: Column) -> Column:
    """ISO-8601 text to `YYYY-MM-DDTHH:MM:SSZ`, cut to whole seconds.

    Goes through a zone-less timestamp, so the result does not depend on the session time zone.
    Text without an offset is read in the session time zone.
    """
    seconds = F.unix_seconds(F.to_timestamp(strip(text)))
    wall_clock = F.timestamp_add(
        "SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )
    return F.concat(F.replace(wall_clock.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def parse_utc(text: Column) -> Column:
    """`…Z` text to an instant; malformed text fails the query under ANSI mode."""
    return F.to_timestamp(text)


def parents(text: Column) -> Column:
    """White-space separated hashes to an array; blank text gives an empty one."""
    return F.filter(F.split(text, f"[{WHITESPACE}]+"), lambda part: part != "")


def text_length(text: Column) -> Column:
    """Length in code points."""
    return F.length(text).cast("long")


def changed_files(diff: Column) -> Column:
    """New-side file names of a diff, one per `+++ b/` line; deletions name no file.

    An added text line that reads `++ b/x` looks the same and is counted too.
    """
    # The literal comes first, so that the engine can search for it; what precedes it is checked
    # afterwards.
    header = rf"\+\+\+ b/(?<![^{LINE_BREAK}]\+\+\+ b/)([^{LINE_BREAK}]*)"
    return F.regexp_extract_all(diff, F.lit(header), F.lit(1))


def guess_language(file_name: Column) -> Column:
    """Language by file extension, else by whole file name, else `unknown`.

    Names with blanks end in a tab in a diff; it is not part of the name.
    """
    table = F.create_map(*[F.lit(item) for pair in LANGUAGES.items() for item in pair])
    ending = F.lower(F.regexp_extract(file_name, r"([^./]*?)\t?\z", 1))
    return F.coalesce(F.element_at(table, ending), F.lit("unknown"))


def truncate_tokens(text: Column, limit: int = 4096) -> Column:
    """`struct(text, truncated)`: the text up to its `limit`-th white-space separated token.

    `truncated` is true only if a token was dropped.
    """
    # Possessive quantifiers: the match runs in a loop, without Java's recursion per repetition.
    # White space at the very end goes with the last token.
    token = rf"[{WHITESPACE}]*+[^{WHITESPACE}]++"
    pattern = rf"\A(?:{token}){{0,{limit}}}+(?:[{WHITESPACE}]*+\z)?"
    # A text shorter than this cannot hold more tokens.
    head = F.when(F.length(text) <= 2 * limit, text).otherwise(F.regexp_extract(text, pattern, 0))
    return F.struct(head.alias("text"), (F.length(text) > F.length(head)).alias("truncated"))


def review_prompt(subject: Column, diff: Column) -> Column:
    """System and user message for a reviewer's digest, as `array<struct<role, content>>`."""
    before, between, after = REVIEW_USER_FORMAT.split("%s")
    content = F.concat(F.lit(before), subject, F.lit(between), diff, F.lit(after))
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(REVIEW_SYSTEM_MESSAGE).alias("content")),
        F.struct(F.lit("user").alias("role"), content.alias("content")),
    )


def canonical_json(*names: str) -> Column:
    """Compact JSON object of the named columns: sorted keys, nulls written, no escaping of
    non-ASCII text."""
    return F.to_json(F.struct(*sorted(names)), {"ignoreNullFields": "false"})
