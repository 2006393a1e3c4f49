"""Path, remote and glob functions."""

from __future__ import annotations

import fnmatch
import re

from hypothesis import given, settings, strategies as st

from sievecraft.functions import paths

SLUGS = {
    "git@forge.test:maps/tiles.git": "forge.test/maps/tiles",
    "deploy@forge.test:maps/tiles": "forge.test/maps/tiles",
    "git@code.lab.test:a/b/c.git": "code.lab.test/a/b/c",
    "https://forge.test/maps/tiles.git": "forge.test/maps/tiles",
    " HTTPS://User:pw@Forge.TEST:443/Maps/Tiles.git/ ": "forge.test/maps/tiles",
    "ssh://git@host:22/x.git": "host/x",
    "//Host/a/b": "host/a/b",
    "file:///srv/git/r.git": "file/srv/git/r",
    "/srv/Git/R.git": "/srv/git/r",
    "forge.test:o/r": "forge.test/o/r",
    "https://forge.test": "forge.test/",
    "https://h.com/a?b=1#c": "h.com/a",
    "https://h.com/a.git?x=1": "h.com/a.git",
    "C:\\repo": "c/\\repo",
    "../rel/Path": "../rel/path",
    "user@h.com:": "user@h.com:",
    "https://[::1]:80/a": "::1/a",
    "https://h.com/Stra\u00dfe": "h.com/strasse",
    "": "",
}


def test_remote_slug(apply):
    assert dict(zip(SLUGS, apply(paths.remote_slug, list(SLUGS)))) == SLUGS


def test_remote_arrays(apply):
    remotes = [["git@B.com:x/y.git", "https://a.com/z", "https://b.com/X/y", ""], []]
    assert apply(lambda c: paths.remote_slugs(c), remotes, "array<string>") == [
        ["", "a.com/z", "b.com/x/y"], [],
    ]
    assert apply(lambda c: paths.remote_urls(c), [["b", "", "a", "b"], []], "array<string>") == [
        ["a", "b"], [],
    ]


GENERATED = [
    "a/b.designer.cs", "x.generated.ts", "x.generated.", ".map", "a/.map", "dist", "a/dist",
    "a/dist/x", "x.generated.a.b", "a.min.js", "node_modules/a", "v/__pycache__/x.pyc", "a.pb.go",
]
WRITTEN = [
    "generated.ts", "m.map/x", "distx/y", "Build/x", "x.MAP", "src/a.generated.d/x.py",
    "a.minxjs", "vendors/a", "mapx", "a.map\n",
]


def test_generated_path(apply):
    expected = [True] * len(GENERATED) + [False] * len(WRITTEN)
    assert apply(paths.is_generated_path, GENERATED + WRITTEN) == expected


def test_path_candidates(apply):
    roots = ["/srv", "/srv/git/", "/other"]
    got = apply(lambda c: paths.path_candidates(c, roots), ["/srv/git/a", "/srv", "/x/srv/a"])
    assert got == [
        ["a", "/srv/git/a", "git/a", "a"],
        ["srv", "/srv", "."],
        ["a", "/x/srv/a"],
    ]


GLOBS = [
    "*", "a?c", "attic/*", "forge.test/vendor/zlib", "[abc]x", "[!abc]x", "[a-c]", "[]]", "[!]]",
    "[", "a[", "[]", "[!]", "[a-]", "[-a]", "[z-a]", "[!z-a]", "[a-c-e]", "a*b*c", "**", "a.b",
    "\\d", "x{1}", "(a|b)", "^a$", "[\\]]", "[&&]", "[^a]", "*.git", "",
]
VALUES = [
    "", "a", "b", "abc", "a/c", "a\nc", "attic/old", "attic/a/b", "Github.com/ACME/ignored",
    "ax", "dx", "]", "[", "-", "a[", "[]", "[!]", "e", "d", "z", "axbyc", "abcabc", "a.b", "axb",
    "\\d", "1", "x{1}", "(a|b)", "^a$", "&", "^", "\\", "\\]", "r.git", "!", "^a",
]


def test_globs_match_like_fnmatch(apply):
    for glob in GLOBS:
        expected = [fnmatch.fnmatchcase(v.casefold(), glob.casefold()) for v in VALUES]
        got = apply(lambda c: paths.glob_match(c, [glob]), VALUES)
        assert [v for v, a, b in zip(VALUES, got, expected) if a != b] == [], glob


def test_many_globs_and_none(apply):
    values = [["x", "Attic/1"], ["x"], []]
    either = apply(
        lambda c: paths.any_glob_match(c, ["attic/*", "y"]), values, "array<string>"
    )
    assert either == [True, False, False]
    assert apply(lambda c: paths.any_glob_match(c, []), values, "array<string>") == [False] * 3
    assert apply(lambda c: paths.glob_match(c, []), ["a"]) == [False]


@settings(max_examples=300, deadline=None)
@given(st.text("ab*?[]!-.", max_size=8), st.text("ab]-.![", max_size=6))
def test_glob_regex_property(glob, value):
    """The regex has no Java-only syntax for this alphabet, so Python can run it."""
    regex = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: rf"\x{int(m[1], 16):02x}", paths.glob_regex([glob]))
    regex = regex.replace(r"\z", r"\Z")
    assert bool(re.match(regex, value)) == fnmatch.fnmatchcase(value, glob)


def test_glob_does_not_backtrack(apply):
    value = "a" * 5000
    assert apply(lambda c: paths.glob_match(c, ["*a*a*a*a*a*b"]), [value]) == [False]
