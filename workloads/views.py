"""Views of the test tables in the library's layouts, in Spark and as SQL for the comparison.

Every view covers its whole tables. The two forms of a view are written independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievecraft.functions.keys import opaque_id

# A third of the candidates share this instant, so that only the id orders them.
BUSY_INSTANT = "2020-01-01T20:00:00Z"
AUTHORS = ("automobile@example.com", "BUILDING@example.com ", "household@Example.com",
           "machinery@example.com")
IGNORE_PATHS = ("NATION_1?", "*/repos/nation_2")
IGNORE_REMOTES = ("git.example.com/org/nation_2[0-2]",)
ROOTS = ("/srv", "/srv/repos")
# `es` stands for a file type nobody knows.
EXTENSIONS = {"en": "py", "fr": "rs", "de": "md", "es": "zz9"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _utc_text(wall_clock: Column) -> Column:
    return F.concat(F.replace(wall_clock.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def doc_key() -> Column:
    return opaque_id("candidate", F.col("doc_id").cast("string"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    minutes = F.floor(F.col("doc_id") / 3) * 37
    return table(spark, sf_dir, "documents").select(
        doc_key().alias("id"),
        opaque_id("repository", F.col("source")).alias("repository_group_id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("subject"),
        F.col("text").alias("diff"),
        F.when(F.col("doc_id") % 3 == 0, F.lit(BUSY_INSTANT))
        .otherwise(_utc_text(F.timestamp_add("MINUTE", minutes, start)))
        .alias("committed_at_utc"),
        F.sha2("text", 256).alias("patch_id"),
    )


CANDIDATES = f"""candidates AS (
  SELECT 'candidate_' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 24) AS id,
         'repository_' || substr(sha256(source), 1, 24) AS repository_group_id,
         split_part(text, chr(10), 1) AS subject,
         text AS diff,
         CASE WHEN doc_id % 3 = 0 THEN '{BUSY_INSTANT}'
              ELSE strftime(TIMESTAMP '2020-01-01 00:00:00'
                            + to_minutes(CAST(37 * (doc_id // 3) AS BIGINT)),
                            '%Y-%m-%dT%H:%M:%SZ') END AS committed_at_utc,
         sha256(text) AS patch_id
  FROM documents)"""

DEDUPLICATED = f"""{CANDIDATES}, kept AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY committed_at_utc, id) AS place
    FROM candidates) WHERE place = 1)"""

SPLITS = f"""{DEDUPLICATED}, splits AS (
  SELECT * EXCLUDE (place, n),
         CASE WHEN place <= n * 8 // 10 THEN 'train'
              WHEN place <= n * 9 // 10 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY committed_at_utc, id) AS place,
               count(*) OVER () AS n FROM kept))"""


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of decisions; the second overrules the first for two documents in three."""
    labels = table(spark, sf_dir, "labels")
    split = F.when(F.col("doc_id") % 2 == 0, "validation").otherwise("test").alias("split")
    first = labels.select(
        doc_key().alias("id"), split, (F.col("toxic") == 0).alias("approved"),
        F.col("doc_id").alias("seq"),
    )
    second = labels.filter(F.col("doc_id") % 3 != 0).select(
        doc_key().alias("id"), split, (F.col("quality") == 1).alias("approved"),
        (F.col("doc_id") + 1_000_000_000).alias("seq"),
    )
    return first.unionByName(second)


DECISIONS = """decisions AS (
  SELECT 'candidate_' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 24) AS id,
         CASE WHEN doc_id % 2 = 0 THEN 'validation' ELSE 'test' END AS split,
         CASE WHEN doc_id % 3 <> 0 THEN quality = 1 ELSE toxic = 0 END AS approved,
         CASE WHEN doc_id % 3 <> 0 THEN doc_id + 1000000000 ELSE doc_id END AS seq
  FROM labels)"""


def _line(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


def _file_section(path: Column, hunk: str, body: Column) -> Column:
    return _line(
        "diff --git a/", path, " b/", path, "\nindex 83db48f..bf269f4 100644\n--- a/", path,
        "\n+++ b/", path, f"\n@@ {hunk} @@\n+", F.replace(body, F.lit("\n"), F.lit("\n+")), "\n",
    )


def _file_section_sql(path: str, hunk: str, body: str) -> str:
    return (
        f"'diff --git a/' || {path} || ' b/' || {path} || chr(10) || "
        f"'index 83db48f..bf269f4 100644' || chr(10) || '--- a/' || {path} || chr(10) || "
        f"'+++ b/' || {path} || chr(10) || '@@ {hunk} @@' || chr(10) || '+' || "
        f"replace({body}, chr(10), chr(10) || '+') || chr(10)"
    )


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a diff of two files."""
    known = F.create_map(*[F.lit(item) for pair in EXTENSIONS.items() for item in pair])
    path = _line("docs/", F.col("source"), ".", known[F.col("lang")])
    head = F.split_part("text", F.lit("\n"), F.lit(1))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("split"),
        F.concat(
            _file_section(path, "-0,0 +1,9", F.col("text")),
            _file_section(F.lit("notes/Makefile"), "-3 +3", head),
        ).alias("diff"),
    )


_DOC_PATH = (
    "('docs/' || source || '.' || CASE lang "
    + " ".join(f"WHEN '{lang}' THEN '{ending}'" for lang, ending in EXTENSIONS.items())
    + " END)"
)
PATCHES = f"""patches AS (
  SELECT doc_id, source AS split,
         {_file_section_sql(_DOC_PATH, "-0,0 +1,9", "text")} ||
         {_file_section_sql("'notes/Makefile'", "-3 +3", "split_part(text, chr(10), 1)")} AS diff
  FROM documents)"""


def repositories(spark: SparkSession, sf_dir: str, shallow: bool = False) -> DataFrame:
    """Nations as repositories, each reached twice; every fourth is shallow if asked for."""
    name = F.col("n_name")
    once = table(spark, sf_dir, "nation").select(
        _line("/srv/repos/", name).alias("path"),
        F.array(_line("git@Git.Example.com:Org/", name, ".git"), F.lit("")).alias("remotes"),
        (F.lit(shallow) & (F.col("n_nationkey") % 4 == 0)).alias("shallow"),
    )
    return once.unionByName(once.withColumn("shallow", F.lit(False)))


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as commits of the customer's nation, by the customer's market segment."""
    orders, customer, nation = (
        table(spark, sf_dir, name) for name in ("orders", "customer", "nation")
    )
    key = F.col("o_orderkey")
    earlier = [F.sha1((key - back).cast("string")) for back in (1, 2)]
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    committed = F.timestamp_add("SECOND", key % 86400, F.col("o_orderdate"))
    cents = F.round(F.col("o_totalprice") * 100).cast("long").cast("string")
    # Some diffs show private data.
    private = (
        F.when(key % 11 == 0, _line("\nby ", F.upper("c_mktsegment"), "@EXAMPLE.com"))
        .when(key % 13 == 0, _line("\nin /srv/repos/", F.col("n_name")))
        .when(key % 17 == 0, _line("\nof ", F.sha1(key.cast("string"))))
        .when(key % 19 == 0, _line("\nat git@Git.Example.com:Org/", F.col("n_name"), ".git"))
        .otherwise("")
    )
    return placed.select(
        _line("/srv/repos/", F.col("n_name")).alias("repository_path"),
        F.sha1(key.cast("string")).alias("commit_sha"),
        F.when(F.col("o_orderstatus") == "P", F.array(*earlier))
        .otherwise(F.array(earlier[0]))
        .alias("parents"),
        F.when(key % 50 == 0, F.lit(" \t\u3000 "))
        .when(key % 37 == 0, _line("Fixup! ", F.col("o_orderpriority")))
        .otherwise(_line("  ", F.col("o_orderpriority"), " \n update ", key.cast("string")))
        .alias("subject"),
        F.col("c_name").alias("author_name"),
        _line(" ", F.col("c_mktsegment"), "@Example.com\t").alias("author_email"),
        _line(
            F.replace(committed.cast("string"), F.lit(" "), F.lit("T")), "+02:00"
        ).alias("committed_at"),
        F.concat(
            _file_section(_line("orders/", F.col("o_orderstatus"), ".csv"), "-1 +1", cents),
            _file_section(
                _line("customers/", F.col("c_mktsegment"), ".md"),
                "-7 +7",
                _line(F.col("o_orderpriority"), "  \r\ncafe\u0301", private),
            ),
        ).alias("diff"),
    )


COMMITS = f"""commits AS (
  SELECT '/srv/repos/' || n_name AS repository_path,
         o_orderkey,
         sha1(CAST(o_orderkey AS VARCHAR)) AS commit_sha,
         o_orderstatus = 'P' AS merge,
         CASE WHEN o_orderkey % 50 = 0 THEN ''
              WHEN o_orderkey % 37 = 0 THEN 'Fixup! ' || o_orderpriority
              ELSE o_orderpriority || ' update ' || o_orderkey END AS subject,
         c_name AS author_name,
         ' ' || c_mktsegment || '@Example.com' || chr(9) AS author_email,
         lower(c_mktsegment) || '@example.com' AS author,
         strftime(o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) - INTERVAL 2 HOUR,
                  '%Y-%m-%dT%H:%M:%SZ') AS committed_at_utc,
         {_file_section_sql("('orders/' || o_orderstatus || '.csv')", "-1 +1",
                            "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)")} ||
         {_file_section_sql("('customers/' || c_mktsegment || '.md')", "-7 +7",
                            "(o_orderpriority || '  ' || chr(13) || chr(10) || 'cafe' || chr(769) || private)")}
           AS diff
  FROM (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN chr(10) || 'by ' || upper(c_mktsegment) || '@EXAMPLE.com'
                       WHEN o_orderkey % 13 = 0 THEN chr(10) || 'in /srv/repos/' || n_name
                       WHEN o_orderkey % 17 = 0 THEN chr(10) || 'of ' || sha1(CAST(o_orderkey AS VARCHAR))
                       WHEN o_orderkey % 19 = 0 THEN chr(10) || 'at git@Git.Example.com:Org/' || n_name || '.git'
                       ELSE '' END AS private
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey))"""


def _item_path() -> Column:
    folder = F.when(F.col("p_type") == "PROMO", "dist/").otherwise("src/")
    ending = F.when(F.col("l_linestatus") == "F", ".min.js").otherwise(".py")
    return F.concat(folder, F.replace("p_name", F.lit(" "), F.lit("_")), ending)


_ITEM_PATH = """CASE WHEN p_type = 'PROMO' THEN 'dist/' ELSE 'src/' END
    || replace(p_name, ' ', '_') || CASE WHEN l_linestatus = 'F' THEN '.min.js' ELSE '.py' END"""


def line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as changed paths, keyed by order."""
    items = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return items.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linenumber"),
        F.col("l_quantity").cast("int").alias("added"),
        _item_path().alias("path"),
        (F.col("l_linenumber") == 7).alias("is_binary"),
    )


LINE_CHANGES = f"""line_changes AS (
  SELECT l_orderkey AS o_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS added,
         {_ITEM_PATH} AS path, l_linenumber = 7 AS is_binary
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as changed paths of the commits."""
    keys = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            _line("/srv/repos/", F.col("n_name")).alias("repository_path"),
            F.sha1(F.col("o_orderkey").cast("string")).alias("commit_sha"),
        )
    )
    return line_changes(spark, sf_dir).join(keys, "o_orderkey").select(
        "repository_path", "commit_sha", "path", "is_binary"
    )


# Generated: everything below dist/ and every .min.js.
DECIDED = f"""{COMMITS}, {LINE_CHANGES}, included AS (
  SELECT '/srv/repos/' || n_name AS repository_path FROM nation
  WHERE NOT regexp_matches(lower(n_name), '^nation_(1.|2|2[0-2])$')
), stats AS (
  SELECT o_orderkey, count(*) AS paths, bool_or(is_binary) AS has_binary,
         bool_and(path LIKE 'dist/%' OR path LIKE '%.min.js') AS generated
  FROM line_changes GROUP BY o_orderkey
), decided AS (
  SELECT c.*, CASE WHEN author = 'furniture@example.com' THEN 'author_not_matched'
                   WHEN merge THEN 'merge'
                   WHEN subject = '' THEN 'empty_subject'
                   WHEN lower(subject) LIKE 'fixup!%' THEN 'fixup'
                   WHEN coalesce(paths, 0) = 0 THEN 'empty_change'
                   WHEN has_binary THEN 'binary'
                   WHEN generated THEN 'generated_only' END AS reason,
         'repository_' || substr(sha256(repository_path), 1, 24) AS repository_group_id,
         'candidate_' || substr(sha256('repository_' || substr(sha256(repository_path), 1, 24)
                                       || chr(0) || commit_sha), 1, 24) AS id
  FROM commits c JOIN included USING (repository_path) LEFT JOIN stats USING (o_orderkey))"""


def page_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as repositories: the path is the URL without scheme and query."""
    return table(spark, sf_dir, "pages").select(
        _line("/srv/", F.regexp_extract("url", r"\A[a-z]+://([^?#]*)", 1)).alias("path"),
        F.array("url").alias("remotes"),
        (F.col("page_id") % 10 == 0).alias("shallow"),
    )


PAGE_REPOSITORIES = """page_repositories AS (
  SELECT '/srv/' || regexp_extract(url, '^[a-z]+://([^?#]*)', 1) AS path, list(DISTINCT url) AS urls,
         bool_or(page_id % 10 = 0) AS shallow FROM pages GROUP BY path)"""


def page_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glob from each page's URL, of five forms, and one without a letter for each nation."""
    pages = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", "://([^/]*)", 1)
    lang = F.regexp_extract("url", "/([a-z]{2})/", 1)
    number = F.regexp_extract("url", "/([0-9]+)", 1)
    kind = F.col("page_id") % 5
    glob = (
        F.when(kind == 0, _line("HTTP*://", F.upper(host), "/*"))
        .when(kind == 1, _line("*/", lang, "/", F.substring(number, 1, 2), "?*"))
        .when(kind == 2, _line("*/[!a-d]?/", number, "*"))
        .when(kind == 3, _line("*", number))
        .otherwise(_line("*", F.substring(host, 3, 7), "*", lang, "*[0-4]"))
    )
    marks = table(spark, sf_dir, "nation").select(
        _line(F.expr("repeat('?', 20 + n_nationkey)"), F.when(F.col("n_nationkey") == 24, "*").otherwise("")).alias("pattern")
    )
    return pages.select(glob.alias("pattern")).unionByName(marks)


PAGE_PATTERNS = """page_parts AS (
  SELECT page_id % 5 AS kind, regexp_extract(url, '://([^/]*)', 1) AS host,
         regexp_extract(url, '/([a-z]{2})/', 1) AS lang, regexp_extract(url, '/([0-9]+)', 1) AS num FROM pages
), page_patterns AS (
  SELECT DISTINCT CASE kind WHEN 0 THEN 'HTTP*://' || upper(host) || '/*'
                            WHEN 1 THEN '*/' || lang || '/' || substr(num, 1, 2) || '?*'
                            WHEN 2 THEN '*/[!a-d]?/' || num || '*'
                            WHEN 3 THEN '*' || num
                            ELSE '*' || substr(host, 3, 7) || '*' || lang || '*[0-4]' END AS pattern,
         CASE kind WHEN 0 THEN 'http.*://' || replace(host, '.', '[.]') || '/.*'
                   WHEN 1 THEN '.*/' || lang || '/' || substr(num, 1, 2) || '..*'
                   WHEN 2 THEN '.*/[^a-d]./' || num || '.*'
                   WHEN 3 THEN '.*' || num
                   ELSE '.*' || replace(substr(host, 3, 7), '.', '[.]') || '.*' || lang || '.*[0-4]' END AS re
  FROM page_parts
  UNION SELECT repeat('?', 20 + n_nationkey) || CASE n_nationkey WHEN 24 THEN '*' ELSE '' END,
               '.{' || (20 + n_nationkey) || CASE n_nationkey WHEN 24 THEN ',}' ELSE '}' END FROM nation)"""


def showing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates some of which show private values, their own or those of another document."""
    number = F.col("doc_id")
    sha = lambda n: F.sha1(n.cast("string"))
    extra = (
        F.when(number % 7 == 0, _line("\nby ", F.upper(_email(number + 5)), ">"))
        .when(number % 11 == 0, _line("\nin /srv/repos/src", (number * 3 % 20).cast("string"), "/x"))
        .when(number % 13 == 0, _line("\nof x", sha(number + 1), "y"))
        .when(number % 17 == 0, _line("\nof ", sha(number), "\nat git@host.org:team/src", (number % 23).cast("string"), ".git"))
        .otherwise("")
    )
    return table(spark, sf_dir, "documents").select(
        doc_key().alias("id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("subject"),
        F.concat(F.col("text"), extra).alias("diff"),
    )


def _email(number: Column) -> Column:
    return _line("Author", (number % 97).cast("string"), "@Mail.Example.com")


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lineage row for each document. One e-mail is the end of another, one path the start of another."""
    number = F.col("doc_id")
    email = F.when(number % 5 == 0, F.lit(None)).otherwise(_line(" ", _email(number), "\t"))
    return table(spark, sf_dir, "documents").select(
        doc_key().alias("id"),
        _line("/srv/repos/", F.col("source")).alias("repository_path"),
        F.array(_line("git@host.org:team/", F.col("source"), ".git"), F.lit("")).alias("remote_urls"),
        F.sha1(number.cast("string")).alias("commit_sha"),
        F.when(number % 96 == 1, F.lit("8@mail.example.com")).otherwise(email).alias("author_email"),
    )


_EMAIL_SQL = "lower('author' || ({} % 97) || '@mail.example.com')"
SHOWING = f"""showing AS (
  SELECT 'candidate_' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 24) AS id,
         split_part(text, chr(10), 1) || chr(10) || text ||
         CASE WHEN doc_id % 7 = 0 THEN chr(10) || 'by ' || upper({_EMAIL_SQL.format("(doc_id + 5)")}) || '>'
              WHEN doc_id % 11 = 0 THEN chr(10) || 'in /srv/repos/src' || (doc_id * 3 % 20) || '/x'
              WHEN doc_id % 13 = 0 THEN chr(10) || 'of x' || sha1(CAST(doc_id + 1 AS VARCHAR)) || 'y'
              WHEN doc_id % 17 = 0 THEN chr(10) || 'of ' || sha1(CAST(doc_id AS VARCHAR)) || chr(10)
                || 'at git@host.org:team/src' || (doc_id % 23) || '.git'
              ELSE '' END AS shown FROM documents)"""
LINEAGE = f"""lineage AS (
  SELECT 'candidate_' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 24) AS id,
         unnest([{{'kind': 'author_email', 'needle': CASE WHEN doc_id % 96 = 1 THEN '8@mail.example.com'
                   WHEN doc_id % 5 <> 0 THEN {_EMAIL_SQL.format("doc_id")} END}},
                 {{'kind': 'repository_path', 'needle': '/srv/repos/' || source}},
                 {{'kind': 'commit_sha', 'needle': sha1(CAST(doc_id AS VARCHAR))}},
                 {{'kind': 'remote_url', 'needle': 'git@host.org:team/' || source || '.git'}}], recursive := true)
  FROM documents
), needles AS (SELECT DISTINCT kind, needle FROM lineage WHERE needle <> ''
), shown AS (
  SELECT s.id, n.kind, n.needle, EXISTS (FROM lineage l WHERE l.id = s.id AND l.kind = n.kind AND l.needle = n.needle) AS own
  FROM showing s JOIN needles n ON contains(CASE n.kind WHEN 'author_email' THEN lower(shown) ELSE shown END, n.needle))"""
