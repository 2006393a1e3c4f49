"""Registered queries: each library operator over the test tables, with SQL to compare against."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievecraft import schemas
from sievecraft.functions import keys, paths, text
from sievecraft.operators import aggregates, changes, filters, guards, languages, ordering, patterns
from sievecraft.plans import candidates as build, prepare, review, scan
from sievecraft.sources import readers
from workloads import views
from workloads.views import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SINCE = dt.datetime(2020, 1, 1, 12, tzinfo=dt.UTC)
UNTIL = dt.datetime(2020, 3, 1, 0, 0, 0, 500_000, tzinfo=dt.UTC)
UNTIL_SQL = "2020-03-01T00:00:01Z"
QUEUE_ROWS = 20
QUOTA = 10_000_000
CONTRACT_FORMS = ("%s", "# %s", '"%s"', "Sure: %s", "Fix `%s`", "**%s**", "%s\n")

# Fixed values, as DuckDB's regex syntax writes them: white space and line breaks.
_WS = (
    r"\t-\r\x{1c}- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_LB = r"\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


_SHOWN_SQL = """shown AS (
           SELECT * REPLACE ('+++ b/src/' || id || '.py' || chr(10) || '+' || split_part(diff, chr(10), 1)
             || chr(10) || '+++ b/my notes.md' || chr(9) || chr(10) AS diff) FROM splits)"""


# --- scalar functions -------------------------------------------------------------------------


@query(
    "opaque_id",
    """SELECT doc_id, 'candidate_' || substr(sha256(source || chr(0) || doc_id), 1, 24) AS id,
              'repository_' || substr(sha256(source), 1, 24) AS repository_group_id
       FROM documents""",
)
def opaque_id(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        keys.candidate_id(F.col("source"), F.col("doc_id").cast("string")).alias("id"),
        keys.repository_group_id(F.col("source")).alias("repository_group_id"),
    )


@query(
    "normalise_subject",
    rf"""SELECT doc_id, subject, length(subject) AS subject_length FROM (
           SELECT doc_id, trim(regexp_replace(nfc_normalize(
             replace(text, chr(233), 'e' || chr(769))), '[{_WS}]+', ' ', 'g')) AS subject
           FROM documents)""",
)
def normalise_subject(spark, sf_dir):
    decomposed = F.replace("text", F.lit("\u00E9"), F.lit("e" + chr(769)))
    subject = text.normalise_subject(decomposed)
    return table(spark, sf_dir, "documents").select(
        "doc_id", subject.alias("subject"), text.text_length(subject).alias("subject_length")
    )


@query(
    "normalise_patch",
    """SELECT doc_id, nfc_normalize(replace(text, chr(232), 'e' || chr(768))) AS patch
       FROM documents""",
)
def normalise_patch(spark, sf_dir):
    raw = F.replace("text", F.lit("\u00E8"), F.lit("e" + chr(768)))
    dos = F.replace(raw, F.lit("\n"), F.when(F.col("doc_id") % 2 == 0, "\r\n").otherwise("\r"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.normalise_patch_text(dos).alias("patch")
    )


@query(
    "identity_key",
    """SELECT lower(c_mktsegment) || ' ss@example.com' AS identity, count(*) AS customers
       FROM customer GROUP BY ALL""",
)
def identity_key(spark, sf_dir):
    noisy = F.concat(
        F.lit("\t"), F.col("c_mktsegment"),
        F.when(F.col("c_custkey") % 2 == 0, " SS@").otherwise(" \u00DF@"), F.lit("Example.com "),
    )
    return (
        table(spark, sf_dir, "customer")
        .groupBy(text.identity_key(noisy).alias("identity"))
        .agg(F.count("*").alias("customers"))
    )


@query(
    "as_utc",
    """SELECT event_id, strftime(date_trunc('second', ts) - INTERVAL 330 MINUTE,
                                 '%Y-%m-%dT%H:%M:%SZ') AS utc,
              CAST(epoch(date_trunc('second', ts) - INTERVAL 330 MINUTE) AS BIGINT) AS epoch
       FROM events""",
)
def as_utc(spark, sf_dir):
    local = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("+05:30"))
    utc = text.as_utc(local)
    return table(spark, sf_dir, "events").select(
        "event_id", utc.alias("utc"), F.unix_seconds(text.parse_utc(utc)).alias("epoch")
    )


@query(
    "remote_slug",
    r"""SELECT page_id, slug, 'git.host/' || slug AS scp_slug FROM (
          SELECT page_id, lower(rtrim(regexp_extract(rtrim(url, '/'), '^[a-z]+://([^?#]*)', 1), '/'))
            AS slug FROM pages)""",
)
def remote_slug(spark, sf_dir):
    bare = F.regexp_extract(F.rtrim("url", F.lit("/")), r"\A[a-z]+://([^?#]*)", 1)
    scp = F.concat(F.lit(" me@Git.Host:"), bare, F.lit(".git/ "))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        paths.remote_slug(F.col("url")).alias("slug"),
        paths.remote_slug(scp).alias("scp_slug"),
    )


@query(
    "remote_arrays",
    r"""SELECT page_id,
               array_to_string(list_sort(list_distinct(
                 ['host.org/team/' || page_id,
                  lower(rtrim(regexp_extract(rtrim(url, '/'), '^[a-z]+://([^?#]*)', 1), '/'))])),
                 ' ') AS slugs,
               array_to_string(list_sort(['git@Host.org:Team/' || page_id || '.git', url]), ' ')
                 AS urls
        FROM pages""",
)
def remote_arrays(spark, sf_dir):
    scp = F.concat(F.lit("git@Host.org:Team/"), F.col("page_id").cast("string"), F.lit(".git"))
    remotes = F.array(F.col("url"), F.lit(""), scp, F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.array_join(paths.remote_slugs(paths.remote_urls(remotes)), " ").alias("slugs"),
        F.array_join(paths.remote_urls(remotes), " ").alias("urls"),
    )


@query(
    "glob_filter",
    r"""SELECT page_id, url FROM pages
        WHERE regexp_matches(lower(url), '^(.*\.example\.net/fr/.*|http://.*/8[0-9].|.*/[^a-d0-9].*_source=feed)$')
           OR regexp_matches(lower(url), '(?s)^.*/de/[5-7].*$')""",
)
def glob_filter(spark, sf_dir):
    globs = ["*.Example.NET/fr/*", "http://*/8[0-9]?", "*/[!a-d0-9]*_SOURCE=feed", "*/de/[567]*"]
    return table(spark, sf_dir, "pages").filter(paths.glob_match(F.col("url"), globs)).select(
        "page_id", "url"
    )


@query(
    "glob_table",
    f"""WITH {views.PAGE_PATTERNS}
        SELECT page_id, pattern FROM pages JOIN page_patterns ON regexp_full_match(lower(url), re, 's')""",
)
def glob_table(spark, sf_dir):
    """Every page with every pattern of a table that its URL matches."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = patterns.glob_matches(pages, views.page_patterns(spark, sf_dir), "url")
    return found.select("page_id", "pattern")


@query(
    "path_candidates",
    rf"""WITH {views.PAGE_REPOSITORIES}
         SELECT path, split_part(path, '/', -1) || '|' || path || '|' || substr(path, 6) AS options
         FROM page_repositories""",
)
def path_candidates(spark, sf_dir):
    repositories = readers.distinct_repositories(views.page_repositories(spark, sf_dir))
    options = paths.path_candidates(F.col("path"), ["/srv", "/opt/srv"])
    return repositories.select("path", F.array_join(options, "|").alias("options"))


@query(
    "generated_path",
    f"""WITH {views.LINE_CHANGES}
        SELECT o_orderkey, l_linenumber, path,
               path LIKE 'dist/%' OR path LIKE '%.min.js' AS is_generated,
               l_linenumber = 3 OR path LIKE 'dist/%' OR path LIKE '%.min.js' AS below_vendor
        FROM line_changes""",
)
def generated_path(spark, sf_dir):
    moved = F.when(F.col("l_linenumber") == 3, F.concat(F.lit("lib/vendor/"), F.col("path")))
    return views.line_changes(spark, sf_dir).select(
        "o_orderkey",
        "l_linenumber",
        "path",
        paths.is_generated_path(F.col("path")).alias("is_generated"),
        paths.is_generated_path(F.coalesce(moved, F.col("path"))).alias("below_vendor"),
    )


_PATCH_DIGITS = "substr(digest, 8 * word + {0}, 2)"
_LITTLE_ENDIAN = " || ".join(f"substr(digest, 8 * word + {at}, 2)" for at in (7, 5, 3, 1))


def _carried(word: int) -> str:
    """Word of the total after carries: the words below, divided by their base."""
    if word == 0:
        return "w0"
    return f"(w{word} + ({_carried(word - 1)} >> 32))"


def _hex_word(word: int) -> str:
    digits = f"printf('%08x', {_carried(word)} & 4294967295)"
    return " || ".join(f"substr({digits}, {at}, 2)" for at in (7, 5, 3, 1))


@query(
    "patch_fingerprint",
    rf"""WITH {views.PATCHES}, sections AS (
           SELECT doc_id, unnest(string_split(chr(10) || diff, chr(10) || 'diff --git ')) AS part
           FROM patches
         ), digests AS (
           SELECT doc_id, sha1(regexp_replace(regexp_replace('diff --git ' || part,
               '(?m)^(?:index |@@ -|\\ .{{10,}}).*$', '', 'g'), '[ \t\r\n]+', '', 'g')) AS digest
           FROM sections WHERE part <> ''
         ), words AS (
           SELECT doc_id, word, CAST(sum(CAST('0x' || {_LITTLE_ENDIAN} AS BIGINT)) AS BIGINT) AS total
           FROM digests, range(5) AS words(word) GROUP BY ALL
         ), wide AS (
           SELECT doc_id, {", ".join(
               f"max(CASE WHEN word = {w} THEN total END) AS w{w}" for w in range(5))}
           FROM words GROUP BY doc_id)
         SELECT doc_id, {" || ".join(_hex_word(w) for w in range(5))} AS patch_id FROM wide""",
)
def patch_fingerprint(spark, sf_dir):
    return views.patches(spark, sf_dir).select(
        "doc_id", keys.patch_fingerprint(F.col("diff")).alias("patch_id")
    )


@query(
    "changed_files",
    rf"""WITH {views.PATCHES}
         SELECT doc_id, array_to_string(
           regexp_extract_all(diff, '(?:^|[{_LB}])\+\+\+ b/([^{_LB}]*)', 1), '|') AS files
         FROM patches""",
)
def changed_files(spark, sf_dir):
    return views.patches(spark, sf_dir).select(
        "doc_id", F.array_join(text.changed_files(F.col("diff")), "|").alias("files")
    )


_LANGUAGE_ROWS = ", ".join(f"('{ending}', '{name}')" for ending, name in text.LANGUAGES.items())


@query(
    "language_counts",
    rf"""WITH {views.PATCHES}, languages(ending, language) AS (VALUES {_LANGUAGE_ROWS}),
         files AS (
           SELECT split, unnest(
             regexp_extract_all(diff, '(?:^|[{_LB}])\+\+\+ b/([^{_LB}]*)', 1)) AS file
           FROM patches)
         SELECT split, coalesce(language, 'unknown') AS language, count(*) AS files
         FROM files LEFT JOIN languages ON lower(regexp_extract(file, '[^./]*$')) = ending
         GROUP BY ALL""",
)
def language_counts(spark, sf_dir):
    return aggregates.language_counts(views.patches(spark, sf_dir))


_TOKENS = r"regexp_extract_all({}, '[\p{{L}}_][\p{{L}}\p{{N}}_]*|[^\s\p{{L}}\p{{N}}_]')"


# From `files` (key, named, content): taught says which of them teach.
_BY_CONTENT = rf"""taught AS (SELECT * FROM files WHERE named <> 'unknown' AND TAUGHT
  ), sizes AS (SELECT named AS language, count(*) AS files FROM taught GROUP BY named
  ), starts AS (
    SELECT *, CAST(round(ln(files / (SELECT sum(files) FROM sizes)) * 1000) AS BIGINT) AS start,
           CAST(round(ln(1 / (files + 2)) * 1000) AS BIGINT) AS absent FROM sizes
  ), counts AS (
    SELECT language, token, count(*) AS n FROM (
      SELECT named AS language, unnest(list_distinct({_TOKENS.format("content")})) AS token FROM taught) GROUP BY ALL
  ), gains AS (
    SELECT language, token, CAST(round(ln((n + 1) / (files + 2)) * 1000) AS BIGINT) - absent AS gain
    FROM counts JOIN starts USING (language)
  ), held AS (
    SELECT key, token FROM (
      SELECT key, unnest(list_distinct({_TOKENS.format("content")})) AS token FROM files)
    SEMI JOIN counts USING (token)
  ), scores AS (
    SELECT key, language, start + n * absent + coalesce(sum, 0) AS score
    FROM (SELECT key, count(*) AS n FROM held GROUP BY key) CROSS JOIN starts
    LEFT JOIN (SELECT key, language, sum(gain) AS sum FROM held JOIN gains USING (token) GROUP BY ALL)
    USING (key, language)
  ), guesses AS (
    SELECT key, first(language ORDER BY score DESC, language) AS guess FROM scores GROUP BY key)"""
_LANG_ENDINGS = " ".join(f"WHEN '{lang}' THEN '{ending}'" for lang, ending in views.EXTENSIONS.items())


@query(
    "content_languages",
    f"""WITH languages(ending, language) AS (VALUES {_LANGUAGE_ROWS}),
         files AS (
           SELECT doc_id AS key, coalesce(language, 'unknown') AS named, text AS content
           FROM documents LEFT JOIN languages ON ending = CASE lang {_LANG_ENDINGS} END
         ), {_BY_CONTENT.replace("TAUGHT", "key % 5 <> 0")}
         SELECT key AS doc_id, named, key % 5 = 0 AS held_out, guess FROM files LEFT JOIN guesses USING (key)""",
)
def content_languages(spark, sf_dir):
    """The language of each patch's first file by its content alone, learned from four fifths of the named ones."""
    sections = languages.file_sections(views.patches(spark, sf_dir).drop("split"))
    files = sections.filter(F.col("file").startswith("docs/")).withColumn("named", text.guess_language(F.col("file")))
    model = languages.learned(files.filter(F.col("doc_id") % 5 != 0), "named")
    guesses = languages.guessed_languages(files, model, "doc_id").withColumnRenamed("language", "guess")
    rows = files.select("doc_id", "named", (F.col("doc_id") % 5 == 0).alias("held_out"))
    return rows.join(guesses, "doc_id", "left")


@query(
    "language_counts_by_content",
    f"""WITH languages(ending, language) AS (VALUES {_LANGUAGE_ROWS}),
         files AS (
           SELECT 2 * doc_id AS key, source, coalesce(language, 'unknown') AS named, text AS content
           FROM documents LEFT JOIN languages ON ending = CASE lang {_LANG_ENDINGS} END
           UNION ALL SELECT 2 * doc_id + 1, source, 'makefile', split_part(text, chr(10), 1) FROM documents
         ), {_BY_CONTENT.replace("TAUGHT", "true")}
         SELECT source AS split, CASE WHEN named <> 'unknown' THEN named ELSE coalesce(guess, 'unknown') END AS language,
                count(*) AS files FROM files LEFT JOIN guesses USING (key) GROUP BY ALL""",
)
def language_counts_by_content(spark, sf_dir):
    rows = views.patches(spark, sf_dir).withColumn("id", F.col("doc_id").cast("string"))
    return languages.language_counts_by_content(rows)


@query(
    "group_key",
    """SELECT doc_id, CASE WHEN doc_id % 5 < 2 THEN 'id:' || doc_id ELSE sha256(text) END AS group_key
       FROM documents""",
)
def group_key(spark, sf_dir):
    patch_id = (
        F.when(F.col("doc_id") % 5 == 0, F.lit(""))
        .when(F.col("doc_id") % 5 == 1, F.lit(None))
        .otherwise(F.sha2("text", 256))
    )
    key = keys.group_key(patch_id, F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", key.alias("group_key"))


@query(
    "canonical_json",
    """SELECT conv_id, turn, CAST(to_json({'conv_id': conv_id, 'note': NULL::VARCHAR, 'role': role,
                                           'text': text, 'turn': turn}) AS VARCHAR) AS json
       FROM conversations""",
)
def canonical_json(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("note", F.lit(None).cast("string"))
    json = text.canonical_json("turn", "text", "role", "note", "conv_id")
    return rows.select("conv_id", "turn", json.alias("json"))


_SYSTEM_SQL = text.REVIEW_SYSTEM_MESSAGE.replace("'", "''")
_USER_SQL = [part.replace("'", "''") for part in text.REVIEW_USER_FORMAT.split("%s")]


@query(
    "review_prompt",
    rf"""WITH heads AS (
           SELECT doc_id, split_part(text, chr(10), 1) AS subject, text,
                  regexp_extract_all(text, '[{_WS}]*[^{_WS}]+') AS tokens FROM documents
         ), cut AS (
           SELECT *, len(tokens) > 4096 AS truncated,
                  CASE WHEN len(tokens) > 4096 THEN array_to_string(tokens[1:4096], '')
                       ELSE text END AS body FROM heads)
         SELECT doc_id, truncated, 'system' AS role_1, '{_SYSTEM_SQL}' AS content_1,
                'user' AS role_2,
                '{_USER_SQL[0]}' || subject || '{_USER_SQL[1]}' || body || '{_USER_SQL[2]}'
                  AS content_2
         FROM cut""",
)
def review_prompt(spark, sf_dir):
    head = F.split_part("text", F.lit("\n"), F.lit(1))
    cut = table(spark, sf_dir, "documents").select(
        "doc_id", head.alias("subject"), text.truncate_tokens(F.col("text")).alias("cut")
    )
    messages = cut.select(
        "doc_id",
        F.col("cut.truncated"),
        text.review_prompt(F.col("subject"), F.col("cut.text")).alias("m"),
    )
    parts = [
        F.col("m")[place][name].alias(f"{name}_{place + 1}")
        for place in (0, 1)
        for name in ("role", "content")
    ]
    return messages.select("doc_id", "truncated", *parts)


# --- sources ----------------------------------------------------------------------------------


@query(
    "commit_log",
    f"""WITH {views.COMMITS}
        SELECT repository_path, commit_sha, CASE WHEN merge THEN 2 ELSE 1 END AS parent_count,
               sha1(CAST(o_orderkey - 1 AS VARCHAR)) AS first_parent, subject, author_name,
               trim(author_email, ' ' || chr(9)) AS author_email, committed_at_utc FROM commits""",
)
def commit_log(spark, sf_dir):
    commits = views.commits(spark, sf_dir)
    record = F.concat_ws(
        keys.NUL, F.array_join("parents", " "), "subject", "author_name",
        text.strip(F.col("author_email")), F.concat("committed_at", F.lit("\n")),
    )
    log = commits.select("repository_path", "commit_sha", record.alias("record"))
    return readers.parse_commit_log(log).select(
        "repository_path",
        "commit_sha",
        F.size("parents").alias("parent_count"),
        F.element_at("parents", 1).alias("first_parent"),
        text.squeeze(F.col("subject")).alias("subject"),
        "author_name",
        "author_email",
        text.as_utc(F.col("committed_at")).alias("committed_at_utc"),
    )


def _numstat(spark, sf_dir):
    """Two entries per line item, and one more that is binary for every seventh line."""
    added = F.when(F.col("is_binary"), F.lit("-")).otherwise(F.col("added").cast("string"))
    entries = F.concat(
        added, F.lit("\t0\t"), F.col("path"), F.lit(keys.NUL),
        F.lit("1\t2\tsrc/tab\there.py"), F.lit(keys.NUL),
    )
    return views.line_changes(spark, sf_dir).select(
        "o_orderkey", "l_linenumber", entries.alias("numstat")
    )


@query(
    "parse_numstat",
    f"""WITH {views.LINE_CHANGES}
        SELECT o_orderkey, l_linenumber, CASE WHEN is_binary THEN NULL ELSE added END AS added,
               0 AS removed, path, is_binary FROM line_changes
        UNION ALL
        SELECT o_orderkey, l_linenumber, 1, 2, 'src/tab' || chr(9) || 'here.py', false
        FROM line_changes""",
)
def parse_numstat(spark, sf_dir):
    return changes.parse_numstat(_numstat(spark, sf_dir))


@query(
    "inline_change_stats",
    f"""WITH {views.LINE_CHANGES}, listed AS (
          SELECT *, path LIKE 'dist/%' OR path LIKE '%.min.js' AS generated FROM line_changes)
        SELECT o_orderkey, count(path) AS path_count, coalesce(bool_or(is_binary), false) AS has_binary,
               coalesce(bool_and(generated), false) AS generated_only
        FROM orders LEFT JOIN listed USING (o_orderkey) GROUP BY o_orderkey""",
)
def inline_change_stats(spark, sf_dir):
    """One text for each order, of an entry for each of its lines: none, some or all of them generated."""
    added = F.when(F.col("is_binary"), F.lit("-")).otherwise(F.col("added").cast("string"))
    entry = F.concat(added, F.lit("\t0\t"), F.col("path"), F.lit(keys.NUL))
    lines = views.line_changes(spark, sf_dir).groupBy("o_orderkey").agg(
        F.array_join(F.sort_array(F.collect_list(entry)), "").alias("numstat")
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey", "left")
    stats = changes.inline_change_stats(F.coalesce("numstat", F.lit("")))
    return rows.select("o_orderkey", stats.alias("s")).select("o_orderkey", "s.*")


@query(
    "record_arity",
    """SELECT CAST(length(text) - length(replace(text, '.', '')) + 1 AS BIGINT) AS fields, count(*) AS records
       FROM documents GROUP BY ALL""",
)
def record_arity(spark, sf_dir):
    """Texts as records whose fields end at full stops."""
    record = F.replace("text", F.lit("."), F.lit(keys.NUL))
    return readers.record_arity(table(spark, sf_dir, "documents").select(record.alias("record")))


@query(
    "null_counts",
    """SELECT unnest(['id', 'repository_group_id', 'subject', 'diff', 'committed_at_utc', 'patch_id']) AS "column",
              unnest([0, count(*) FILTER (coalesce(lang, 'de') = 'de' OR source IS NULL), count(*) FILTER (doc_id % 7 = 0),
                      count(*) FILTER (text IS NULL), count(*) FILTER (coalesce(source, 'src0') = 'src0'),
                      count(*) FILTER (coalesce(length(text), 0) < 500)]) AS nulls FROM documents""",
)
def null_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("lang") != "de", F.col("source")).alias("repository_group_id"),
        F.when(F.col("doc_id") % 7 != 0, F.lit("s")).alias("subject"),
        F.col("text").alias("diff"),
        F.when(F.col("source") != "src0", F.lit("t")).alias("committed_at_utc"),
        F.when(F.length("text") >= 500, F.lit("p")).alias("patch_id"),
    )
    return guards.null_counts(rows, schemas.CANDIDATES)


@query("patch_text", "SELECT doc_id, chr(65533) || text || '  ' AS diff FROM documents")
def patch_text(spark, sf_dir):
    raw = F.concat(F.lit(b"\xff"), F.col("text").cast("binary"), F.lit(b"  "))
    return table(spark, sf_dir, "documents").select(
        "doc_id", readers.patch_text(raw).alias("diff")
    )


# --- filters and cascades ---------------------------------------------------------------------


@query(
    "date_window",
    f"""WITH {views.CANDIDATES}
        SELECT id, committed_at_utc FROM candidates
        WHERE committed_at_utc >= '2020-01-01T12:00:00Z' AND committed_at_utc < '{UNTIL_SQL}'""",
)
def date_window(spark, sf_dir):
    rows = views.candidates(spark, sf_dir)
    return filters.date_window(rows, SINCE, UNTIL).select("id", "committed_at_utc")


_FORMS_SQL = " ".join(
    f"WHEN {place} THEN replace(replace('{form}', '%s', head), chr(92) || 'n', chr(10))"
    for place, form in enumerate(form.replace("\n", "\\n") for form in CONTRACT_FORMS)
)


@query(
    "output_contract",
    rf"""WITH subjects AS (
           SELECT doc_id, CASE doc_id % {len(CONTRACT_FORMS)} {_FORMS_SQL} END AS subject FROM (
             SELECT doc_id, split_part(text, chr(10), 1) AS head FROM documents)
         ), rules AS (
           SELECT doc_id, subject, length(subject) <= 72 AS short,
             subject <> '' AND NOT regexp_matches(subject, '[{_LB}]') AS one_line,
             NOT regexp_matches(subject,
               '^(?:#{{1,6}} |[-*+>] |[0-9]+[.)] |```)|`[^`]+`|\*\*[^*]+\*\*|__[^_]+__|\]\(')
               AS no_markdown,
             NOT regexp_matches(subject, '^(?:"[^"]*"|''[^'']*''|\x{{201c}}[^\x{{201d}}]*\x{{201d}})$')
               AS no_quotes,
             NOT regexp_matches(subject, '(?i)^(?:sure|certainly|of course|okay|here is|here''s|here are|the commit (?:message|subject)|commit (?:message|subject)|subject)\b[^:]*:')
               AS no_preamble FROM subjects)
         SELECT *, short AND one_line AND no_markdown AND no_quotes AND no_preamble AS ok
         FROM rules""",
)
def output_contract(spark, sf_dir):
    head = F.split_part("text", F.lit("\n"), F.lit(1))
    subject = F.lit(None).cast("string")
    for place, form in enumerate(CONTRACT_FORMS):
        before, after = form.split("%s")
        shaped = F.concat(F.lit(before), head, F.lit(after))
        subject = F.when(F.col("doc_id") % len(CONTRACT_FORMS) == place, shaped).otherwise(subject)
    rows = table(spark, sf_dir, "documents").select("doc_id", subject.alias("subject"))
    checked = rows.withColumn("rules", filters.output_contract(F.col("subject")))
    return checked.select("doc_id", "subject", "rules.*")


@query(
    "repository_status",
    rf"""WITH {views.PAGE_REPOSITORIES}, slugs AS (
           SELECT *, list_transform(urls, lambda url:
               lower(rtrim(regexp_extract(rtrim(url, '/'), '^[a-z]+://([^?#]*)', 1), '/')))
             AS slugs FROM page_repositories
         ), marked AS (
           SELECT path, shallow,
             CASE WHEN regexp_matches(lower(path), '^/srv/blog\..*/en/.*$')
                    OR regexp_matches(lower(split_part(path, '/', -1)), '^[89]..$')
                  THEN 'ignored_path'
                  WHEN len(list_filter(slugs, lambda slug:
                         regexp_matches(slug, '^.*\.example\.net/.*$'))) > 0 THEN 'ignored_remote'
                  ELSE 'included' END AS status FROM slugs)
         SELECT path, status, shallow AND status = 'included' AS shallow
         FROM marked""",
)
def repository_status(spark, sf_dir):
    repositories = scan.with_status(
        views.page_repositories(spark, sf_dir),
        roots=["/srv"],
        ignore_paths=["blog.*/EN/*", "[89]??"],
        ignore_remotes=["*.example.net/*"],
    )
    ordered = repositories.orderBy(text.casefold(F.col("path")), "path")
    return ordered.select("path", "status", "shallow")


@query(
    "repository_status_tables",
    rf"""WITH {views.PAGE_REPOSITORIES}, {views.PAGE_PATTERNS}, slugs AS (
           SELECT path, unnest(list_transform(urls, lambda url:
               lower(rtrim(regexp_extract(rtrim(url, '/'), '^[a-z]+://([^?#]*)', 1), '/')))) AS slug
           FROM page_repositories
         ), by_path AS (
           SELECT DISTINCT path FROM page_repositories JOIN nation
           ON split_part(path, '/', -1) LIKE '_' || n_nationkey || '_' OR path LIKE '%/en/' || n_nationkey || '%'
         ), by_remote AS (
           SELECT DISTINCT path FROM slugs JOIN page_patterns ON regexp_full_match('https://' || slug, re, 's')
           WHERE pattern LIKE 'HTTP%' AND hash_of_pattern(pattern))
         SELECT path, CASE WHEN path IN (FROM by_path) THEN 'ignored_path'
                           WHEN path IN (FROM by_remote) THEN 'ignored_remote' ELSE 'included' END AS status
         FROM page_repositories""".replace("AND hash_of_pattern(pattern)", "AND length(pattern) % 3 = 0"),
)
def repository_status_tables(spark, sf_dir):
    """Both ignore lists are tables; the hosts of a third of the patterns are ignored remotes."""
    number = F.col("n_nationkey").cast("string")
    nation = table(spark, sf_dir, "nation")
    by_path = nation.select(F.concat(F.lit("?"), number, F.lit("?")).alias("pattern")).unionByName(
        nation.select(F.concat(F.lit("*/en/"), number, F.lit("*")).alias("pattern"))
    )
    globs = views.page_patterns(spark, sf_dir).filter(
        F.col("pattern").startswith("HTTP") & (F.length("pattern") % 3 == 0)
    )
    by_remote = globs.select(F.replace("pattern", F.lit("HTTP*://"), F.lit("")).alias("pattern"))
    statuses = scan.with_status(views.page_repositories(spark, sf_dir), ["/srv"], by_path, by_remote)
    return statuses.select("path", "status")


# --- joins and the candidate build ------------------------------------------------------------


@query(
    "change_stats",
    f"""WITH {views.LINE_CHANGES}
        SELECT o_orderkey, count(*) AS path_count, bool_or(is_binary) AS has_binary,
               bool_and(path LIKE 'dist/%' OR path LIKE '%.min.js') AS generated_only
        FROM line_changes GROUP BY o_orderkey""",
)
def change_stats(spark, sf_dir):
    return changes.change_stats(views.line_changes(spark, sf_dir), ("o_orderkey",))


def _scanned(spark, sf_dir):
    return scan.with_status(
        views.repositories(spark, sf_dir), views.ROOTS, views.IGNORE_PATHS, views.IGNORE_REMOTES
    )


def _build(spark, sf_dir) -> build.Build:
    return build.build_candidates(
        _scanned(spark, sf_dir),
        views.commits(spark, sf_dir),
        views.AUTHORS,
        views.changes(spark, sf_dir),
    )


@query(
    "commit_reasons",
    f"""WITH {views.DECIDED}
        SELECT repository_path, commit_sha, subject, reason FROM decided""",
)
def commit_reasons(spark, sf_dir):
    return _build(spark, sf_dir).decided.select(
        "repository_path", "commit_sha", "subject", "reason"
    )


@query(
    "rejection_counts",
    f"""WITH {views.DECIDED}
        SELECT reason, count(*) AS rejected FROM decided WHERE reason IS NOT NULL GROUP BY reason""",
)
def rejection_counts(spark, sf_dir):
    """The allow-list is a table here: every e-mail but those of one market segment."""
    allowed = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") != "FURNITURE")
        .select(F.concat("c_mktsegment", F.lit("@example.com")).alias("author_email"))
    )
    built = build.build_candidates(
        _scanned(spark, sf_dir),
        views.commits(spark, sf_dir),
        allowed,
        views.changes(spark, sf_dir),
    )
    return built.rejections


@query(
    "build_totals",
    f"""WITH {views.DECIDED}
        SELECT count(*) FILTER (reason IS NULL) AS accepted,
               count(*) FILTER (reason IS NOT NULL) AS rejected, count(*) AS inspected
        FROM decided""",
)
def build_totals(spark, sf_dir):
    return _build(spark, sf_dir).totals


_COMMIT_PATCH = rf"""sections AS (
           SELECT id, unnest(string_split(chr(10) || diff, chr(10) || 'diff --git ')) AS part
           FROM decided WHERE reason IS NULL
         ), digests AS (
           SELECT id, sha1(regexp_replace(regexp_replace('diff --git ' || part,
               '(?m)^(?:index |@@ -|\\ .{{10,}}).*$', '', 'g'), '[ \t\r\n]+', '', 'g')) AS digest
           FROM sections WHERE part <> ''
         ), words AS (
           SELECT id, word, CAST(sum(CAST('0x' || {_LITTLE_ENDIAN} AS BIGINT)) AS BIGINT) AS total
           FROM digests, range(5) AS words(word) GROUP BY ALL
         ), wide AS (
           SELECT id, {", ".join(
               f"max(CASE WHEN word = {w} THEN total END) AS w{w}" for w in range(5))}
           FROM words GROUP BY id)"""


@query(
    "accepted_commits",
    rf"""WITH {views.DECIDED}, {_COMMIT_PATCH}
         SELECT id, repository_group_id, subject,
                nfc_normalize(replace(diff, chr(13) || chr(10), chr(10))) AS diff,
                committed_at_utc, {" || ".join(_hex_word(w) for w in range(5))} AS patch_id
         FROM decided JOIN wide USING (id)""",
)
def accepted_commits(spark, sf_dir):
    return _build(spark, sf_dir).candidates


@query(
    "commit_lineage",
    f"""WITH {views.DECIDED}
        SELECT id, repository_group_id, repository_path,
               'git@Git.Example.com:Org/' || split_part(repository_path, '/', -1) || '.git'
                 AS remote_urls,
               commit_sha, author_name, author_email FROM decided WHERE reason IS NULL""",
)
def commit_lineage(spark, sf_dir):
    lineage = _build(spark, sf_dir).provenance
    return lineage.withColumn("remote_urls", F.array_join("remote_urls", " "))


@query(
    "lineage_integrity",
    f"""WITH {views.DECIDED}, sides AS (
          SELECT substr(id, 11, 1) AS digit, id FROM decided WHERE reason IS NULL
        ), left_rows AS (
          SELECT id FROM sides WHERE digit NOT IN ('0', '1') UNION ALL SELECT id FROM sides WHERE digit = '2'
        ), right_rows AS (
          SELECT id FROM sides WHERE digit NOT IN ('1', '3') UNION ALL SELECT id FROM sides WHERE digit IN ('2', '4'))
        SELECT (SELECT count(*) FROM left_rows) AS candidates, (SELECT count(*) FROM right_rows) AS provenance,
               (SELECT count(*) FROM sides WHERE digit = '3') AS without_provenance,
               (SELECT count(*) FROM sides WHERE digit = '0') AS without_candidate,
               (SELECT count(*) FROM sides WHERE digit IN ('2', '4')) AS repeated_ids""",
)
def lineage_integrity(spark, sf_dir):
    """A damaged pair: known by the first digit of their id, rows are left out or repeated on either side."""
    built = _build(spark, sf_dir)
    digit = F.substring("id", 11, 1)
    left = built.candidates.filter(~digit.isin("0", "1"))
    right = built.provenance.filter(~digit.isin("1", "3"))
    return guards.lineage_integrity(
        left.unionByName(left.filter(digit == "2")), right.unionByName(right.filter(digit.isin("2", "4")))
    )


@query(
    "identity_leaks",
    f"""WITH {views.DECIDED}
        SELECT count(*) FILTER (contains(lower(subject || diff), author)) AS author_email_count,
               count(*) FILTER (contains(subject || diff, repository_path))
                 AS repository_path_count,
               count(*) FILTER (contains(subject || diff, commit_sha)) AS commit_sha_count,
               count(*) FILTER (contains(subject || diff, 'git@Git.Example.com:Org/'
                 || split_part(repository_path, '/', -1) || '.git')) AS remote_url_count
        FROM decided WHERE reason IS NULL""",
)
def identity_leaks(spark, sf_dir):
    return _build(spark, sf_dir).leaks


@query(
    "shown_identities",
    f"WITH {views.SHOWING}, {views.LINEAGE} SELECT id, kind, needle, own FROM shown",
)
def shown_identities(spark, sf_dir):
    """Private values of any document's lineage in any text."""
    return guards.shown_identities(views.showing(spark, sf_dir), views.lineage(spark, sf_dir))


@query(
    "shown_identity_counts",
    f"""WITH {views.SHOWING}, {views.LINEAGE}
        SELECT kind, count(DISTINCT id) AS rows, count(DISTINCT CASE WHEN NOT own THEN id END) AS foreign_rows,
               count(DISTINCT needle) AS needles FROM shown GROUP BY kind""",
)
def shown_identity_counts(spark, sf_dir):
    shown = guards.shown_identities(views.showing(spark, sf_dir), views.lineage(spark, sf_dir))
    return guards.shown_identity_counts(shown)


# --- scan -------------------------------------------------------------------------------------

_SCANNED = f"""{views.COMMITS}, marked AS (
  SELECT DISTINCT '/srv/repos/' || n_name AS path, n_nationkey % 4 = 0 AS at_depth,
         CASE WHEN regexp_matches(lower(n_name), '^nation_(1.|2)$') THEN 'ignored_path'
              WHEN regexp_matches(lower(n_name), '^nation_2[0-2]$') THEN 'ignored_remote'
              ELSE 'included' END AS status FROM nation
), counted AS (
  SELECT path, status, at_depth AND status = 'included' AS shallow, count(author) AS commits,
         count(DISTINCT author) AS authors
  FROM marked LEFT JOIN commits ON path = repository_path AND status = 'included' GROUP BY ALL)"""


def _scan(spark, sf_dir) -> scan.Scan:
    return scan.scan_history(
        views.repositories(spark, sf_dir, shallow=True),
        views.commits(spark, sf_dir),
        views.ROOTS,
        views.IGNORE_PATHS,
        views.IGNORE_REMOTES,
    )


@query(
    "scan_repositories",
    f"""WITH {_SCANNED}
        SELECT path, status, commits AS commit_count, authors AS author_email_count,
               shallow FROM counted""",
)
def scan_repositories(spark, sf_dir):
    return _scan(spark, sf_dir).repositories.drop("remotes")


@query(
    "shallow_histories",
    f"WITH {_SCANNED} SELECT path FROM counted WHERE shallow",
)
def shallow_histories(spark, sf_dir):
    return guards.shallow_histories(_scan(spark, sf_dir).repositories).select("path")


@query(
    "scan_totals",
    f"""WITH {_SCANNED}
        SELECT count(*) AS discovered_repository_count,
               count(*) FILTER (status = 'included') AS included_repository_count,
               count(*) FILTER (status <> 'included') AS ignored_repository_count,
               count(*) FILTER (shallow) AS shallow_repository_count,
               CAST(sum(commits) AS BIGINT) AS commit_count,
               (SELECT count(DISTINCT author) FROM marked JOIN commits ON path = repository_path
                WHERE status = 'included') AS author_email_count FROM counted""",
)
def scan_totals(spark, sf_dir):
    return _scan(spark, sf_dir).totals


@query(
    "author_counts",
    """SELECT event_type, count(*) AS commit_count, count(DISTINCT user_id) AS author_email_count,
              (SELECT count(DISTINCT user_id) FROM events) AS all_authors
       FROM events GROUP BY event_type""",
)
def author_counts(spark, sf_dir):
    email = F.concat(F.lit(" User"), F.col("user_id").cast("string"), F.lit("@X.org"))
    events = table(spark, sf_dir, "events").withColumn("email", email)
    pairs = aggregates.author_pairs(events, "event_type", "email")
    counts = aggregates.group_counts(pairs, "event_type")
    return counts.withColumn("all_authors", aggregates.distinct_authors(pairs).scalar())


# --- preparation ------------------------------------------------------------------------------


@query("dedup_earliest", f"WITH {views.DEDUPLICATED} SELECT id, committed_at_utc, patch_id FROM kept")
def dedup_earliest(spark, sf_dir):
    rows = ordering.with_group_key(views.candidates(spark, sf_dir))
    return ordering.dedup_earliest(rows).select("id", "committed_at_utc", "patch_id")


def _splits(spark, sf_dir) -> DataFrame:
    return prepare.prepare_dataset(
        views.candidates(spark, sf_dir), minimum_rows=1, minimum_evaluation_rows=1
    ).splits


@query("chronological_split", f"WITH {views.SPLITS} SELECT id, committed_at_utc, split FROM splits")
def chronological_split(spark, sf_dir):
    return _splits(spark, sf_dir).select("id", "committed_at_utc", "split")


@query("split_counts", f"WITH {views.SPLITS} SELECT split, count(*) AS rows FROM splits GROUP BY split")
def split_counts(spark, sf_dir):
    return aggregates.split_counts(_splits(spark, sf_dir))


def _split_sql(order: str, source: str, key: str) -> str:
    return f"""SELECT {key}, CASE WHEN place <= n * 8 // 10 THEN 'train'
                      WHEN place <= n * 9 // 10 THEN 'validation' ELSE 'test' END AS split
               FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS place,
                            count(*) OVER () AS n FROM {source})"""


@query("split_events", _split_sql("ts, event_id", "events", "event_id"))
def split_events(spark, sf_dir):
    instant = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    key = F.concat(instant, F.lpad(F.col("event_id").cast("string"), 20, "0"))
    events = table(spark, sf_dir, "events")
    return ordering.chronological_split(events, key, sorted_at_once=500).select(
        "event_id", "split"
    )


@query("split_orders", _split_sql("o_orderdate, o_orderkey", "orders", "o_orderkey"))
def split_orders(spark, sf_dir):
    key = F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lpad(F.col("o_orderkey").cast("string"), 20, "0"),
    )
    orders = table(spark, sf_dir, "orders")
    return ordering.chronological_split(orders, key).select("o_orderkey", "split")


_WINDOWED = f"""{views.CANDIDATES}, windowed AS (
  SELECT * FROM candidates
  WHERE committed_at_utc >= '2020-01-01T12:00:00Z' AND committed_at_utc < '{UNTIL_SQL}'
), kept AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY committed_at_utc, id) AS place
    FROM windowed) WHERE place = 1)"""

_FINGERPRINT = """hashes AS (
  SELECT sha256(to_json({'committed_at_utc': committed_at_utc, 'diff': diff, 'id': id,
                         'patch_id': patch_id, 'repository_group_id': repository_group_id,
                         'subject': subject})) AS row_hash FROM kept
), leaves AS (
  SELECT substr(row_hash, 1, 4) AS prefix,
         sha256(string_agg(row_hash, '' ORDER BY row_hash)) AS leaf
  FROM hashes GROUP BY ALL
), fingerprints AS (
  SELECT sha256('HEADER' || coalesce(string_agg(leaf, '' ORDER BY prefix), '')) AS fingerprint FROM leaves)"""


@query(
    "dataset_fingerprint",
    f"""WITH {views.DEDUPLICATED}, {_FINGERPRINT.replace("HEADER", '{"since":null,"until":null}')}
        SELECT fingerprint FROM fingerprints""",
)
def dataset_fingerprint(spark, sf_dir):
    return aggregates.sorted_fingerprint(_splits(spark, sf_dir)).withColumnRenamed(
        "digest", "fingerprint"
    )


@query(
    "source_digest",
    f"""WITH {views.CANDIDATES}, {_FINGERPRINT.replace("FROM kept", "FROM candidates").replace("HEADER", "")}
        SELECT fingerprint AS digest FROM fingerprints""",
)
def source_digest(spark, sf_dir):
    return readers.sorted_rows_digest(views.candidates(spark, sf_dir))


_BOUNDS = f'{{"since":"{SINCE.isoformat()}","until":"{UNTIL.isoformat()}"}}'


@query(
    "prepare_manifest",
    f"""WITH {_WINDOWED}, {_FINGERPRINT.replace("HEADER", _BOUNDS)}, sizes AS (SELECT count(*) AS n FROM kept)
        SELECT (SELECT count(*) FROM candidates) AS source_count,
               (SELECT count(*) FROM windowed) AS filtered_count, n AS deduplicated_count,
               n * 8 // 10 AS train_rows, n * 9 // 10 - n * 8 // 10 AS validation_rows,
               n - n * 9 // 10 AS test_rows, fingerprint
        FROM sizes, fingerprints""",
)
def prepare_manifest(spark, sf_dir):
    prepared = prepare.prepare_dataset(
        views.candidates(spark, sf_dir), SINCE, UNTIL, minimum_rows=1, minimum_evaluation_rows=1
    )
    digest = aggregates.sorted_fingerprint(
        prepared.splits, SINCE.isoformat(), UNTIL.isoformat()
    ).withColumnRenamed("digest", "fingerprint")
    numbers = prepared.counts | {
        f"{name}_rows": rows for name, rows in prepared.split_counts.items()
    }
    return digest.select(
        *[F.lit(number).cast("long").alias(name) for name, number in numbers.items()],
        "fingerprint",
    )


# --- review -----------------------------------------------------------------------------------


@query(
    "split_summary",
    rf"""WITH {views.SPLITS}
         SELECT split, count(*) AS rows, min(length(subject)) AS min_subject,
                max(length(subject)) AS max_subject, min(length(diff)) AS min_diff,
                max(length(diff)) AS max_diff, min(committed_at_utc) AS first_date,
                max(committed_at_utc) AS last_date,
                count(DISTINCT repository_group_id) AS repository_groups
         FROM splits GROUP BY split""",
)
def split_summary(spark, sf_dir):
    summary = aggregates.split_summary(_splits(spark, sf_dir))
    return summary.select(
        "split", "rows", "repository_groups",
        F.col("subject_length.min").alias("min_subject"),
        F.col("subject_length.max").alias("max_subject"),
        F.col("diff_length.min").alias("min_diff"),
        F.col("diff_length.max").alias("max_diff"),
        F.col("date_range.first").alias("first_date"),
        F.col("date_range.last").alias("last_date"),
    )


@query(
    "summarise_splits",
    rf"""WITH {views.SPLITS}, languages(ending, language) AS (VALUES {_LANGUAGE_ROWS}),
         {_SHOWN_SQL}, files AS (
           SELECT split, unnest(
             regexp_extract_all(diff, '(?:^|[{_LB}])\+\+\+ b/([^{_LB}]*)', 1)) AS file FROM shown
         ), counted AS (
           SELECT split, coalesce(language, 'unknown') AS language, count(*) AS n
           FROM files LEFT JOIN languages ON lower(regexp_extract(file, '([^./]*?)\t?$', 1)) = ending
           GROUP BY ALL)
         SELECT split, count(*) AS rows, min(length(subject)) AS min_subject,
                max(length(diff)) AS max_diff, min(committed_at_utc) AS first_date,
                max(committed_at_utc) AS last_date,
                count(DISTINCT repository_group_id) AS repository_groups,
                any_value((SELECT string_agg(language || ':' || n, ' ' ORDER BY language)
                           FROM counted c WHERE c.split = shown.split)) AS languages
         FROM shown GROUP BY split""",
)
def summarise_splits(spark, sf_dir):
    """The splits with diffs of two files each, one name with a blank and hence a tab."""
    head = F.split_part("diff", F.lit("\n"), F.lit(1))
    diff = F.concat(F.lit("+++ b/src/"), F.col("id"), F.lit(".py\n+"), head, F.lit("\n+++ b/my notes.md\t\n"))
    found = review.summarise_splits(_splits(spark, sf_dir).withColumn("diff", diff))
    pairs = F.transform(
        F.array_sort(F.map_entries("languages")),
        lambda x: F.concat(x["key"], F.lit(":"), x["value"].cast("string")),
    )
    return found.select(
        "split", "rows", "repository_groups",
        F.col("subject_length.min").alias("min_subject"),
        F.col("diff_length.max").alias("max_diff"),
        F.col("date_range.first").alias("first_date"),
        F.col("date_range.last").alias("last_date"),
        F.array_join(pairs, " ").alias("languages"),
    )


@query(
    "audit_queue",
    f"""WITH {views.SPLITS}
        SELECT split, id, subject, diff FROM splits WHERE split <> 'train'""",
)
def audit_queue(spark, sf_dir):
    """The queue from separate split tables, tagged and united."""
    splits = _splits(spark, sf_dir)
    tables = {
        name: splits.filter(F.col("split") == name).drop("split") for name in ("validation", "test")
    }
    return review.audit_queue(review.union_splits(**tables)).drop("committed_at_utc")


def _queue_and_decisions(spark, sf_dir):
    queue = review.audit_queue(_splits(spark, sf_dir))
    return queue, readers.latest_decisions(views.decisions(spark, sf_dir))


@query(
    "undecided_rows",
    f"""WITH {views.SPLITS}, {views.DECISIONS}
        SELECT split, id FROM splits
        WHERE split <> 'train' AND id NOT IN (SELECT id FROM decisions)""",
)
def undecided_rows(spark, sf_dir):
    return review.undecided(*_queue_and_decisions(spark, sf_dir)).select("split", "id")


@query(
    "review_queue",
    f"""WITH {views.SPLITS}, {views.DECISIONS}, ranked AS (
          SELECT split, id, subject, diff, CAST(row_number() OVER (
                   PARTITION BY split ORDER BY committed_at_utc, id) AS INTEGER) AS position
          FROM splits WHERE split <> 'train' AND id NOT IN (SELECT id FROM decisions))
        SELECT * FROM ranked WHERE position <= {QUEUE_ROWS}""",
)
def review_queue(spark, sf_dir):
    """A top-k report: the limit is the operator."""
    return review.next_undecided(*_queue_and_decisions(spark, sf_dir), QUEUE_ROWS)


@query(
    "review_batch",
    f"""WITH {views.SPLITS}, {views.DECISIONS}, approvals AS (
          SELECT s.split, count(*) FILTER (approved) AS n
          FROM splits s LEFT JOIN decisions d ON s.id = d.id WHERE s.split <> 'train' GROUP BY s.split
        ), active AS (
          SELECT split FROM approvals WHERE n < {QUOTA} ORDER BY split = 'test' LIMIT 1
        ), ranked AS (
          SELECT split, id, subject, diff, CAST(row_number() OVER (
                   ORDER BY committed_at_utc, id) AS INTEGER) AS position
          FROM splits SEMI JOIN active USING (split) WHERE id NOT IN (SELECT id FROM decisions))
        SELECT * FROM ranked WHERE position <= {QUEUE_ROWS}""",
)
def review_batch(spark, sf_dir):
    """Validation first, and test once validation has its approvals."""
    splits = _splits(spark, sf_dir)
    log = views.decisions(spark, sf_dir)
    return review.review_batch(review.audit_queue(splits), log, required=QUOTA, k=QUEUE_ROWS)


@query(
    "review_batch_next",
    f"""WITH {views.SPLITS}, {views.DECISIONS}, approvals AS (
          SELECT s.split, count(*) FILTER (approved) AS n
          FROM splits s LEFT JOIN decisions d ON s.id = d.id WHERE s.split <> 'train' GROUP BY s.split
        ), active AS (
          SELECT split FROM approvals WHERE n < (SELECT n FROM approvals WHERE split = 'validation')
        ), ranked AS (
          SELECT split, id, subject, diff, CAST(row_number() OVER (
                   ORDER BY committed_at_utc, id) AS INTEGER) AS position
          FROM splits SEMI JOIN active USING (split) WHERE id NOT IN (SELECT id FROM decisions))
        SELECT * FROM ranked WHERE position <= {QUEUE_ROWS}""",
)
def review_batch_next(spark, sf_dir):
    """As many approvals are required as validation has, so that test is next unless it has them too."""
    queue = review.audit_queue(_splits(spark, sf_dir))
    log = views.decisions(spark, sf_dir)
    counts = review.approval_counts(queue, readers.latest_decisions(log))
    required = counts.filter(F.col("split") == "validation").first()["approved"]
    return review.review_batch(queue, log, required=required, k=QUEUE_ROWS)


@query(
    "approval_counts",
    f"""WITH {views.SPLITS}, {views.DECISIONS}
        SELECT s.split, count(*) AS rows, count(approved) AS decided,
               count(*) FILTER (approved) AS approved
        FROM splits s LEFT JOIN decisions d ON s.id = d.id WHERE s.split <> 'train'
        GROUP BY s.split""",
)
def approval_counts(spark, sf_dir):
    return review.approval_counts(*_queue_and_decisions(spark, sf_dir))


@query("latest_decisions", f"WITH {views.DECISIONS} SELECT * FROM decisions")
def latest_decisions(spark, sf_dir):
    return readers.latest_decisions(views.decisions(spark, sf_dir))


@query(
    "current_decisions",
    f"""WITH {views.SPLITS}, {views.DECISIONS}
        SELECT d.id, s.split, approved, seq FROM decisions d JOIN splits s ON d.id = s.id
        WHERE s.split <> 'train'""",
)
def current_decisions(spark, sf_dir):
    queue = review.audit_queue(_splits(spark, sf_dir))
    return review.current_decisions(views.decisions(spark, sf_dir), queue)


@query(
    "stale_decisions",
    f"""WITH {views.SPLITS}, {views.DECISIONS}
        SELECT split, id FROM decisions WHERE approved
        EXCEPT SELECT split, id FROM splits""",
)
def stale_decisions(spark, sf_dir):
    return review.stale_approvals(views.decisions(spark, sf_dir), _splits(spark, sf_dir))


@query(
    "reviewed_split",
    f"""WITH {views.SPLITS}, {views.DECISIONS}
        SELECT s.* FROM splits s SEMI JOIN (SELECT * FROM decisions WHERE approved) d
        ON s.id = d.id AND s.split = d.split""",
)
def reviewed_split(spark, sf_dir):
    return review.reviewed_rows(_splits(spark, sf_dir), views.decisions(spark, sf_dir))
