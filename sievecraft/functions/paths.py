"""Column functions over paths, remotes and glob patterns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from sievecraft.functions.text import casefold, strip

# Directory names and file-name globs of generated artifacts (case-sensitive).
GENERATED_DIRECTORIES = ("__pycache__", "build", "dist", "node_modules", "vendor")
GENERATED_FILES = (
    "*.designer.cs",
    "*.generated.*",
    "*.g.cs",
    "*.min.css",
    "*.min.js",
    "*.pb.go",
    "*.snap",
    "*.svgz",
    "*.map",
)

# `scheme://authority/path`, the scheme being optional: authority and path.
_URL = r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
# `user@host:path`: the part before the first colon and the path.
_SCP = r"\A([^/:]*):((?s:.+))\z"


def _slug(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("/"), F.btrim(path, F.lit("/")))


def _link_parts(text: Column) -> Column:
    # URL parsers drop tabs and line ends anywhere in a URL.
    link = F.translate(text, "\t\r\n", "")
    server = F.regexp_extract(F.regexp_extract(link, _URL, 1), r"([^@]*)\z", 1)
    host = F.regexp_extract(server, r"\A(?:\[[^\]]*|[^:\[]*)", 0)
    return F.struct(
        text.alias("text"),
        F.ltrim(host, F.lit("[")).alias("host"),
        F.regexp_extract(link, _URL, 2).alias("path"),
        F.regexp_extract(F.regexp_extract(text, _SCP, 1), r"([^@]*)\z", 1).alias("scp_host"),
        F.regexp_extract(text, _SCP, 2).alias("scp_path"),
    )


def _slugs(urls: Column) -> Column:
    # One transform per step: each step's value is then computed once, however often the next
    # step uses it.
    texts = F.transform(
        urls, lambda url: F.regexp_replace(F.rtrim(strip(url), F.lit("/")), r"\.git\z", "")
    )
    named = F.transform(
        F.transform(texts, _link_parts),
        lambda part: F.when(part["host"] != "", _slug(part["host"], part["path"]))
        .when(part["scp_host"] != "", _slug(part["scp_host"], part["scp_path"]))
        .otherwise(part["text"]),
    )
    return F.transform(named, casefold)


def remote_slug(url: Column) -> Column:
    """Comparable `host/path` of a remote: no user, port, query, fragment, `.git` or letter case.

    Anything that names no host is only case-folded.
    """
    return _slugs(F.array(url))[0]


def remote_slugs(remotes: Column) -> Column:
    """Sorted distinct slugs of an array of remotes."""
    return F.array_sort(F.array_distinct(_slugs(remotes)))


def remote_urls(remotes: Column) -> Column:
    """Sorted distinct remotes without blanks."""
    return F.array_sort(F.array_distinct(F.filter(remotes, lambda url: url != "")))


def _java_char(char: str) -> str:
    return char if char.isascii() and char.isalnum() else rf"\x{{{ord(char):x}}}"


def _java_class(body: str) -> str:
    negated = body.startswith("!")
    rest = body[negated:]
    members = []
    while rest:
        low, high = rest[0], rest[0]
        if len(rest) > 2 and rest[1] == "-":
            high, rest = rest[2], rest[2:]
        rest = rest[1:]
        if low <= high:
            members.append(_java_char(low) + (f"-{_java_char(high)}" if high != low else ""))
    if not members:
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(members)}]"


def _java_glob(glob: str) -> str:
    # A bracket with no partner is an ordinary character, and so is `]` right after `[` or `[!`.
    tokens = re.findall(r"\[!?+.[^\]]*\]|\*+|.", glob, flags=re.DOTALL)
    pieces = [""]
    for token in tokens:
        if token[0] == "*":
            pieces.append("")
        elif token == "?":
            pieces[-1] += "."
        elif len(token) > 1:
            pieces[-1] += _java_class(token[1:-1])
        else:
            pieces[-1] += _java_char(token)
    if len(pieces) == 1:
        return pieces[0]
    # The first place where an inner piece fits is enough, so no backtracking into it.
    return pieces[0] + "".join(f"(?>.*?{piece})" for piece in pieces[1:-1]) + ".*" + pieces[-1]


def glob_regex(globs: Iterable[str]) -> str | None:
    """One Java regex for all globs; None if there is no glob.

    `*` and `?` match any character, slashes and line ends included.
    """
    parts = [_java_glob(glob) for glob in globs]
    return rf"(?s)\A(?:{'|'.join(parts)})\z" if parts else None


def glob_match(value: Column, globs: Sequence[str]) -> Column:
    """Whether a value matches any glob, ignoring case."""
    regex = glob_regex(glob.casefold() for glob in globs)
    return F.lit(False) if regex is None else casefold(value).rlike(regex)


def any_glob_match(values: Column, globs: Sequence[str]) -> Column:
    """Whether any element of an array matches any glob, ignoring case."""
    regex = glob_regex(glob.casefold() for glob in globs)
    if regex is None:
        return F.lit(False)
    return F.exists(F.transform(values, casefold), lambda value: value.rlike(regex))


def generated_path_regex() -> tuple[str, str]:
    """Regexes of a generated path component and of the end of a generated file name."""
    folders = "|".join(GENERATED_DIRECTORIES)
    # All globs start with `*.`; the dot in front of the alternatives keeps the search fast.
    endings = "|".join(
        re.escape(glob[2:-1]) + "[^/]*" if glob.endswith("*") else re.escape(glob[2:])
        for glob in GENERATED_FILES
    )
    return rf"(?:{folders})(?:/|\z)", rf"\.(?:{endings})\z"


def is_generated_path(path: Column) -> Column:
    """Whether a path component is a generated directory name, or the file name a generated one."""
    component, ending = generated_path_regex()
    return path.rlike(rf"(?:^|/){component}") | path.rlike(ending)


def path_candidates(path: Column, roots: Sequence[str]) -> Column:
    """Base name, full path, and the path relative to each root that contains it."""

    def below(root: str) -> Column:
        prefix = root.rstrip("/") + "/"
        return F.when(path == root, F.lit(".")).when(
            path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1))
        )

    name = F.element_at(F.split(path, "/"), -1)
    return F.array_compact(F.array(name, path, *[below(root) for root in roots]))
