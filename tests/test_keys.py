"""Identifiers and content keys."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from sievecraft.functions import keys


def test_opaque_id(spark):
    df = spark.createDataFrame([("/srv/\u00e9", "abc")], "path string, sha string")
    group = keys.repository_group_id(F.col("path"))
    row = df.select(group.alias("g"), keys.candidate_id(group, F.col("sha")).alias("c")).first()
    digest = hashlib.sha256("/srv/\u00e9".encode()).hexdigest()[:24]
    assert row["g"] == f"repository_{digest}"
    both = hashlib.sha256(f"repository_{digest}\0abc".encode()).hexdigest()[:24]
    assert row["c"] == f"candidate_{both}"


def test_group_key(spark):
    df = spark.createDataFrame([("p", "1"), ("", "2"), (None, "3")], "p string, id string")
    got = [r[0] for r in df.select(keys.group_key(F.col("p"), F.col("id"))).collect()]
    assert got == ["p", "id:2", "id:3"]


# Diffs, and the ids that `git patch-id --stable` gives them.
VECTORS = [
    (
        "diff --git a/lib/sum.c b/lib/sum.c\n"
        "index 0f1..a22 100644\n"
        "--- a/lib/sum.c\n"
        "+++ b/lib/sum.c\n"
        "@@ -3,4 +3,5 @@ int sum(int *v)\n"
        "   int s = 0;\n"
        "-  while (n)\n"
        "+\twhile (n > 0)\n"
        "+  {\n"
        "     s += v[--n];\n",
        "f74b025073a212f1a4bd970142719abc23468c29",
    ),
    (
        "diff --git a/new \xe9.py b/new \xe9.py\n"
        "new file mode 100644\n"
        "index 000..b1c\n"
        "--- /dev/null\n"
        "+++ b/new \xe9.py\t\n"
        "@@ -0,0 +1,2 @@\n"
        "+index 12..34\n"
        "+@@ -1 +1 @@\n"
        "\\ No newline at end of file\n"
        "diff --git a/old b/old\n"
        "deleted file mode 100644\n"
        "index b1c..000\n"
        "--- a/old\n"
        "+++ /dev/null\n"
        "@@ -1 +0,0 @@\n"
        "-gone \t away\n",
        "4435707c63c34c94201f65f242d7359c9605ed93",
    ),
    (
        "diff --git a/run.sh b/run.sh\n"
        "old mode 100644\n"
        "new mode 100755\n",
        "0801bff7999b122f0df44a0663a00deef879a340",
    ),
    (
        "diff --git a/u b/u\n"
        "index 1..2 100644\n"
        "--- a/u\n"
        "+++ b/u\n"
        "@@ -1 +1 @@\n"
        "-a\u2028diff --git a/q b/q\x85z\n"
        "+b\x0bc\rd\n",
        "cbe91114b9e235b749e20a6e29cae57c9f7d0a7f",
    ),
    (
        "".join(
            f"diff --git a/m/{k} b/m/{k}\nindex 1..2 100644\n--- a/m/{k}\n+++ b/m/{k}\n@@ -{k + 1} +{k + 1} @@\n-{k}\n+{k * k}\n"
            for k in range(12)
        ),
        "1809fefc890c0bb44520539b50813a9a39ac1e89",
    ),
]


def test_fingerprint_is_the_stable_patch_id(apply):
    """New, deleted and changed files, no final newline, a change of mode alone, odd line breaks inside lines."""
    assert apply(keys.patch_fingerprint, [diff for diff, _ in VECTORS]) == [known for _, known in VECTORS]


SECTION = "diff --git a/{0} b/{0}\nindex 1..2 100644\n--- a/{0}\n+++ b/{0}\n@@ -{1} +{1} @@\n{2}"


def test_fingerprint_ignores_what_does_not_matter(apply):
    one, two = SECTION.format("x", 1, "-a\n+b c\n"), SECTION.format("y", 1, "+d\n")
    same = [
        one + two,
        two + one,
        SECTION.format("x", 77, "-a\n+b\t c  \n") + two.replace("index 1..2", "index 8..9"),
        one + "\\ No newline at end of file\n" + two,
        "leading text\n" + one + two,
    ]
    other = [one, SECTION.format("x", 1, "-a\n+B c\n") + two, SECTION.format("z", 1, "-a\n+b c\n")]
    got = apply(keys.patch_fingerprint, same + other + ["", "no diff", None])
    assert len(set(got[:5])) == 1
    assert len(set(got[:8])) == 4
    assert got[8:] == [None, None, None]
    assert all(len(value) == 40 for value in got[:8])
