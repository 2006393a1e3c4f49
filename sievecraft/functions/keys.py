"""Column functions that build keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUL = "\u0000"


def opaque_id(kind: str, value: Column) -> Column:
    """Stable identifier that does not show its source: `<kind>_` and 24 hex digits."""
    return F.concat(F.lit(f"{kind}_"), F.substring(F.sha2(value, 256), 1, 24))


def repository_group_id(path: Column) -> Column:
    return opaque_id("repository", path)


def candidate_id(group_id: Column, commit_sha: Column) -> Column:
    return opaque_id("candidate", F.concat(group_id, F.lit(NUL), commit_sha))


def group_key(patch_id: Column, row_id: Column) -> Column:
    """Key of a group of copies: the patch id, or the row's own id where there is none."""
    return F.coalesce(F.nullif(patch_id, F.lit("")), F.concat(F.lit("id:"), row_id))


_WORDS = range(5)
_EMPTY_SUM = "0" * 40


def _little_endian(hex_digest: Column, word: int) -> Column:
    """The `word`-th 32 bits of a hex digest as a number, first byte least significant."""
    pairs = [F.substring(hex_digest, 8 * word + 2 * byte + 1, 2) for byte in (3, 2, 1, 0)]
    return F.conv(F.concat(*pairs), 16, 10).cast("long")


def _hex_little_endian(number: Column) -> Column:
    digits = F.lower(F.lpad(F.hex(number), 8, "0"))
    return F.concat(*[F.substring(digits, 2 * byte + 1, 2) for byte in (3, 2, 1, 0)])


def _hex_sum(hex_digests: Column) -> Column:
    """Sum of 160-bit digests modulo 2**160, in one pass over the array."""
    zeros = F.array(*[F.lit(0).cast("long") for _ in _WORDS])

    def add(totals: Column, digest: Column) -> Column:
        return F.array(*[totals[word] + _little_endian(digest, word) for word in _WORDS])

    def carry(totals: Column) -> Column:
        carried, digits = F.lit(0).cast("long"), []
        for word in _WORDS:
            total = totals[word] + carried
            digits.append(_hex_little_endian(total.bitwiseAND(F.lit(0xFFFFFFFF))))
            carried = F.shiftright(total, 32)
        return F.concat(*digits)

    return F.aggregate(hex_digests, zeros, add, carry)


def patch_fingerprint(diff: Column) -> Column:
    """Content key of a unified diff, the same for diffs that differ in line numbers, blob hashes,
    white space or file order only; null if the text holds no diff.

    Each file section is hashed without its white space, and the 160-bit hashes are added up.
    The value is the one `git patch-id --stable` prints for a text diff.
    """
    # (?d): only LF ends a line, whatever else the changed text contains.
    sections = F.filter(
        F.split(diff, r"(?dm)^(?=diff --git )"), lambda part: part.startswith("diff --git ")
    )

    def digest(section: Column) -> Column:
        text = F.regexp_replace(section, r"(?dm)^(?:index |@@ -|\\ .{10,}).*$", "")
        for blank in " \t\r\n":
            text = F.replace(text, F.lit(blank), F.lit(""))
        return F.sha1(text)

    digests = F.transform(sections, digest)
    return F.nullif(_hex_sum(digests), F.lit(_EMPTY_SUM))
