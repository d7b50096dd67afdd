"""Registered queries of the library's own operators over the given tables, and the SQL that each is held against."""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import refs
from lectern.functions.ids import canonical_number, number_prefix
from lectern.functions.refs import coordinates, reference_tokens
from lectern.functions.text import license_text, public_text_col, slug_col
from lectern.operators import checks, collapse, commentary, documents, lexicon, policy, publish, validate
from lectern.sources import conf, ndjson, shapes, store
from lectern.sources.shared import scratch, written
from lectern.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(column: str) -> F.Column:
    """An array as a string, so that engines agree on it."""
    return F.array_join(F.transform(F.col(column), lambda x: x.cast("string")), ",").alias(column)


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text is not null")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "text"))
    return lines.select("doc_id", (F.col("at") + 1).cast("long").alias("verse"), "text")


LINES = """lines AS (
  SELECT doc_id, unnest(range(1, len(s) + 1)) AS verse, unnest(s) AS text
  FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)
)"""
COLLAPSED = f"""WITH {LINES}, collapsed AS (
  SELECT doc_id, text, min(verse) AS verse, list_sort(list(DISTINCT verse)) AS covered, count(*) AS copies FROM lines GROUP BY doc_id, text
)"""


@query(f"{COLLAPSED} SELECT doc_id, text, verse, array_to_string(covered, ',') AS covered, copies FROM collapsed")
def collapse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse.collapse(numbered_lines(spark, sf_dir), ["doc_id"], order="verse")
    return found.select("doc_id", "text", "verse", joined("covered"), "copies")


@query("""SELECT source, lang, text, min(doc_id) AS verse, array_to_string(list_sort(list(DISTINCT doc_id)), ',') AS covered, count(*) AS copies
FROM documents GROUP BY source, lang, text""")
def collapse_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("source", "lang", "text", F.col("doc_id").alias("verse"))
    return collapse.collapse(rows, ["source", "lang"], order="verse").select("source", "lang", "text", "verse", joined("covered"), "copies")


@query("""SELECT conv_id, text, min(turn) AS verse, arg_min(role, turn) AS role, count(*) AS copies FROM conversations GROUP BY conv_id, text""")
def collapse_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumnRenamed("turn", "verse")
    return collapse.collapse(rows, ["conv_id"], order="verse", anchor="role").select("conv_id", "text", "verse", "role", "copies")


@query("""SELECT conv_id, string_agg(turn || ':' || text, chr(30) ORDER BY turn, text) AS entries, count(*) AS entry_count
FROM (SELECT conv_id, text, min(turn) AS turn FROM conversations GROUP BY conv_id, text) GROUP BY conv_id""")
def chapter_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumnRenamed("turn", "verse")
    found = collapse.chapters(collapse.collapse(rows, ["conv_id"], order="verse"), ["conv_id"])
    text = F.array_join(F.transform("entries", lambda x: F.concat(x["verse"].cast("string"), F.lit(":"), x["text"])), "\x1e")
    return found.select("conv_id", text.alias("entries"), "entry_count")


@query(f"""{COLLAPSED}, per AS (SELECT doc_id, count(*) AS n FROM collapsed GROUP BY doc_id)
SELECT source, array_to_string(list_sort(list(DISTINCT doc_id)), ',') AS chapters, CAST(sum(n) AS BIGINT) AS entry_count, bool_or(doc_id = 0) AS has_introduction
FROM per JOIN documents USING (doc_id) GROUP BY source""")
def book_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are chapters, and their source is the book."""
    lines = collapse.collapse(numbered_lines(spark, sf_dir), ["doc_id"], order="verse")
    per = lines.groupBy("doc_id").agg(F.count("*").alias("entry_count"))
    per = per.join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    found = collapse.book_index(per, ["source"], "doc_id")
    return found.select("source", joined("chapters"), F.col("entry_count").cast("long").alias("entry_count"), "has_introduction")


@query(f"""{COLLAPSED}
SELECT (SELECT count(*) FROM lines) AS source_entries, (SELECT CAST(sum(octet_length(encode(text))) AS BIGINT) FROM lines) AS source_bytes,
       count(*) AS published_entries, CAST(sum(octet_length(encode(text))) AS BIGINT) AS published_bytes FROM collapsed""")
def storage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse.storage(collapse.collapse(numbered_lines(spark, sf_dir), ["doc_id"], order="verse"))


@query(f"{COLLAPSED} SELECT doc_id, text, verse FROM collapsed WHERE list_contains(covered, 3)")
def verse_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse.collapse(numbered_lines(spark, sf_dir), ["doc_id"], order="verse")
    return collapse.covering(found, F.lit(3).cast("long")).select("doc_id", "text", "verse")


@query(f"{COLLAPSED} SELECT doc_id, verse, unnest(covered) AS at, copies FROM collapsed")
def verse_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse.collapse(numbered_lines(spark, sf_dir), ["doc_id"], order="verse")
    return collapse.coverage(found).select("doc_id", "verse", "at", "copies")


TOKEN_SQL = "'[1-4]?[A-Za-z][A-Za-z0-9]+\\.\\p{Nd}+(?:\\.\\p{Nd}+)?'"
TEXTS = """texts AS (
  SELECT 'd' || doc_id AS id, text FROM documents
  UNION ALL SELECT 'n' || n_nationkey, r_name || '.' || n_nationkey || '.' || n_regionkey FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def cited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey)
    cited = named.select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat_ws(".", "r_name", "n_nationkey", "n_regionkey").alias("text"))
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text").union(cited)


@query(f"""WITH {TEXTS}, tokens AS (SELECT id, list_sort(list_distinct(regexp_extract_all(text, {TOKEN_SQL}))) AS tokens FROM texts)
SELECT id, array_to_string(tokens, ',') AS tokens FROM tokens WHERE len(tokens) > 0""")
def reference_token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cited_texts(spark, sf_dir).select("id", reference_tokens("text").alias("tokens"))
    return found.where(F.size("tokens") > 0).select("id", joined("tokens"))


@query(f"""WITH {TEXTS}, tokens AS (SELECT id, unnest(list_distinct(regexp_extract_all(text, {TOKEN_SQL}))) AS token FROM texts)
SELECT id, token, r_regionkey AS book, TRY_CAST(split_part(token, '.', 2) AS INTEGER) AS chapter, TRY_CAST(NULLIF(split_part(token, '.', 3), '') AS INTEGER) AS verse
FROM tokens JOIN region ON lower(split_part(token, '.', 1)) = lower(r_name) WHERE TRY_CAST(split_part(token, '.', 2) AS INTEGER) IS NOT NULL""")
def reference_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region stands in for the dimension of books."""
    from lectern.functions.refs import resolve_by_join

    tokens = cited_texts(spark, sf_dir).select("id", F.explode(reference_tokens("text")).alias("token"))
    books = table(spark, sf_dir, "region").select(F.lower("r_name").alias("alias"), F.col("r_regionkey").alias("book"))
    return resolve_by_join(tokens, books).select("id", "token", "book", "chapter", "verse")


@query(r"""WITH bare AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<!--.*?-->', '', 'g'), '(?is)<(?:script|style)\b[^>]*>.*?(?:</(?:script|style)\s*>|$)', '', 'g'),
    '(?i)</?(?:blockquote|br|dd|div|dt|h[1-6]|hr|li|ol|p|table|tr|ul)(?:[\s/][^>]*)?>', chr(10), 'g'), '<[!/A-Za-z][^>]*>', '', 'g') AS text FROM pages
), decoded AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS text FROM bare
) SELECT page_id, trim(regexp_replace(text, '[ \t]+' || chr(10), chr(10), 'g'), ' ' || chr(9) || chr(10)) AS text FROM decoded""")
def markup_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", public_text_col(F.lit(None).cast("string"), "html").alias("text"))


TITLE = r"<title>\s*([^<\s]+)"


def page_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a dictionary: a page's key is the first word of its title; the host is its module."""
    pages = table(spark, sf_dir, "pages")
    key = F.regexp_extract("html", TITLE, 1)
    return pages.select(F.lit("pages").alias("module"), F.col("page_id").alias("ordinal"), key.alias("key"), "html").where("key <> ''")


def named_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.assign_ids(lexicon.base_ids(page_entries(spark, sf_dir).drop("html")), ascii_only=True)  # bases are ASCII: keys that aren't are encoded


BASES = r"""entries AS (
  SELECT page_id AS ordinal, regexp_extract(html, '<title>\s*([^<\s]+)', 1) AS key, html FROM pages
), based AS (
  SELECT ordinal, key, html, CASE
    WHEN regexp_matches(key, '^[A-Za-z0-9][A-Za-z0-9._-]{0,119}$') THEN 'k-' || key
    WHEN length(rtrim(base64(encode(key)), '=')) <= 180 THEN 'k-' || translate(rtrim(base64(encode(key)), '='), '+/', '-_')
    ELSE 'h-' || sha256(key) END AS base
  FROM entries WHERE key <> ''
), owned AS (
  SELECT *, CASE WHEN first_value(key) OVER (PARTITION BY lower(base) ORDER BY ordinal) = key THEN base ELSE 'h-' || sha256(key) END AS final FROM based
), counted AS (
  SELECT *, row_number() OVER (PARTITION BY lower(final) ORDER BY ordinal) AS occurrence FROM owned
), named AS (
  SELECT ordinal, key, html, final || CASE WHEN occurrence > 1 THEN '--' || occurrence ELSE '' END AS id, occurrence,
    coalesce(nullif(trim(regexp_replace(regexp_replace(replace(lower(strip_accents(key)), 'ß', 'ss'), '[^\w\s-]', ' ', 'g'), '\s+', ' ', 'g')), ''), replace(lower(key), 'ß', 'ss')) AS search,
    replace(lower(key), 'ß', 'ss') AS folded
  FROM counted
)"""


@query(f"WITH {BASES} SELECT ordinal, key, id, occurrence FROM named")
def entry_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_pages(spark, sf_dir).select("ordinal", "key", "id", "occurrence")


def searched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.searchable(named_pages(spark, sf_dir))


@query(f"WITH {BASES} SELECT ordinal, key, search FROM named")
def search_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return searched_pages(spark, sf_dir).select("ordinal", "key", "search")


@query(f"""WITH {BASES} SELECT row_number() OVER (ORDER BY search, folded, occurrence, ordinal) AS rank, id, key, search,
CASE WHEN occurrence > 1 THEN occurrence END AS occurrence FROM named""")
def search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.search_index(searched_pages(spark, sf_dir)).select("rank", "id", "key", "search", "occurrence")


@query(f"WITH {BASES} SELECT id, key, search FROM named WHERE starts_with(search, 'th')")
def prefix_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the parts of the index that can hold the prefix are read."""
    path = scratch(spark, "index")
    lexicon.write_index(searched_pages(spark, sf_dir), path)
    return lexicon.read_index(spark, path, prefix="th").select("id", "key", "search")


@query(f"""WITH {BASES}, ranked AS (SELECT *, row_number() OVER (ORDER BY search, folded, occurrence, ordinal) AS rank FROM named)
SELECT rank, id, key, search FROM ranked WHERE search = 'the'""")
def term_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One term's records with their ranks, out of the whole index."""
    path = scratch(spark, "index")
    lexicon.write_index(searched_pages(spark, sf_dir), path)
    return lexicon.read_index(spark, path, term="the").select("rank", "id", "key", "search")


@query(f"WITH {BASES} SELECT count(DISTINCT folded) AS unique_keys FROM named")
def unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.unique_keys(page_entries(spark, sf_dir)).select("unique_keys")


ALIASES = """aliases AS (
  SELECT alias, arg_min(id, ordinal * 2 + rank) AS target FROM (
    SELECT ordinal, id, folded AS alias, 0 AS rank FROM named UNION ALL SELECT ordinal, id, search, 1 FROM named) WHERE alias <> '' GROUP BY alias
)"""
EDGES = rf"""WITH {BASES}, {ALIASES}, found AS (
  SELECT id, unnest(regexp_extract_all(html, '(?i)<(?:ref|reference|a)\b[^>]*?\b(?:target|href|osisref)\s*=\s*["'']([^"'']+)["'']', 1)) AS raw FROM named
), cut AS (
  SELECT DISTINCT id, regexp_replace(trim(regexp_replace(regexp_replace(raw, '^.*/', ''), '^[^:]*:', '')), '^#+|#+$', '', 'g') AS target FROM found
), wanted AS (
  SELECT id, replace(lower(target), 'ß', 'ss') AS direct,
    coalesce(nullif(trim(regexp_replace(regexp_replace(replace(lower(strip_accents(target)), 'ß', 'ss'), '[^\w\s-]', ' ', 'g'), '\s+', ' ', 'g')), ''), replace(lower(target), 'ß', 'ss')) AS loose
  FROM cut WHERE target <> '' AND NOT regexp_matches(target, '^[1-4]?[A-Za-z][A-Za-z0-9]+\.[0-9]+(?:\.[0-9]+)?$')
), edges AS (
  SELECT DISTINCT wanted.id AS src, coalesce(a.target, b.target) AS dst
  FROM wanted LEFT JOIN aliases a ON direct = a.alias LEFT JOIN aliases b ON loose = b.alias WHERE coalesce(a.target, b.target) <> wanted.id
)"""


def page_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges_of(spark, sf_dir, named_pages(spark, sf_dir))


def edges_of(spark: SparkSession, sf_dir: str, named: DataFrame) -> DataFrame:
    return lexicon.link_edges(lexicon.searchable(named), lexicon.candidates_of(page_entries(spark, sf_dir), "html", ids=named))


@query(f"WITH {BASES}, {ALIASES} SELECT alias, target FROM aliases")
def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.alias_index(searched_pages(spark, sf_dir)).select("alias", "target")


@query(f"{EDGES} SELECT src, dst FROM edges")
def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_edges(spark, sf_dir).select("src", "dst")


@query(f"{EDGES} SELECT src AS id, array_to_string(list_sort(list(dst)), ',') AS ids FROM edges GROUP BY src")
def forward_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.neighbours(page_edges(spark, sf_dir)).select("id", joined("ids"))


@query(f"{EDGES} SELECT dst AS id, array_to_string(list_sort(list(src)), ',') AS ids FROM edges GROUP BY dst")
def backlinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.neighbours(page_edges(spark, sf_dir), forward=False).select("id", joined("ids"))


@query(f"""{EDGES} SELECT e.src, a.key AS src_key, e.dst, b.key AS dst_key FROM edges e JOIN named a ON e.src = a.id JOIN named b ON e.dst = b.id""")
def link_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = named_pages(spark, sf_dir)
    src, dst = named.select(F.col("id").alias("src"), F.col("key").alias("src_key")), named.select(F.col("id").alias("dst"), F.col("key").alias("dst_key"))
    return edges_of(spark, sf_dir, named).join(src, "src").join(dst, "dst").select("src", "src_key", "dst", "dst_key")


@query(r"""WITH keys AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN lpad(CAST(p_partkey AS VARCHAR), 5, '0') WHEN 1 THEN 'g' || lpad(CAST(p_partkey AS VARCHAR), 5, '0')
  WHEN 2 THEN 'strong:H' || p_partkey WHEN 3 THEN p_partkey || '!a' ELSE p_name END AS key, CASE WHEN p_partkey % 2 = 0 THEN 'G' END AS prefix FROM part),
cut AS (SELECT *, upper(regexp_extract(key, '(?i)^(?:strong:)?([GH])?0*(\d{1,5})(?:!.*)?$', 1)) AS letter, regexp_extract(key, '(?i)^(?:strong:)?([GH])?0*(\d{1,5})(?:!.*)?$', 2) AS digits FROM keys)
SELECT p_partkey, key, CASE WHEN digits = '' THEN NULL ELSE CASE coalesce(nullif(letter, ''), prefix) WHEN 'G' THEN 'G' || CAST(CAST(digits AS INTEGER) AS VARCHAR)
  WHEN 'H' THEN 'H0' || CAST(CAST(digits AS INTEGER) AS VARCHAR) END END AS canonical FROM cut""")
def strong_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, n = table(spark, sf_dir, "part"), F.col("p_partkey")
    padded = F.lpad(n.cast("string"), 5, "0")
    key = F.when(n % 5 == 0, padded).when(n % 5 == 1, F.concat(F.lit("g"), padded)).when(n % 5 == 2, F.concat(F.lit("strong:H"), n)).when(n % 5 == 3, F.concat(n, F.lit("!a"))).otherwise(F.col("p_name"))
    prefix = number_prefix(F.when(n % 2 == 0, F.lit("GreekDef")))
    return part.select("p_partkey", key.alias("key"), prefix.alias("prefix")).select("p_partkey", "key", canonical_number(F.col("key"), F.col("prefix")).alias("canonical"))


DRIVERS = {"ECONOMY": "RawCom", "PROMO": "zLD", "MEDIUM": "RawFiles", "LARGE": "RawText", "STANDARD": "RawLD4", "SMALL": "zCom4"}


def part_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    driver = F.create_map(*[F.lit(x) for pair in DRIVERS.items() for x in pair])[F.col("p_type")]
    category = F.when(F.col("p_size") % 2 == 0, "Commentaries").otherwise("Lexicons / Dictionaries")
    rows = part.select("p_partkey", F.col("p_name").alias("name"), F.col("p_type").alias("type"), F.trim("p_brand").alias("license"), F.lower(F.trim("p_brand")).alias("license_key"), driver.alias("driver"), category.alias("category"))
    return rows.withColumn("kind", policy.module_kind(F.col("driver"), F.col("category"), F.lit("")))


@query("""WITH m AS (SELECT p_partkey, p_name AS name, lower(p_brand) AS license,
  CASE p_type WHEN 'ECONOMY' THEN 'rawcom' WHEN 'PROMO' THEN 'zld' WHEN 'MEDIUM' THEN 'rawfiles' WHEN 'LARGE' THEN 'rawtext' WHEN 'STANDARD' THEN 'rawld4' ELSE 'zcom4' END AS driver, p_size % 2 = 0 AS comment FROM part),
k AS (SELECT *, CASE WHEN driver IN ('rawcom', 'zcom4') OR driver = 'rawfiles' AND comment THEN 'commentaries' WHEN driver IN ('zld', 'rawld4', 'rawfiles') THEN 'dictionaries' END AS kind FROM m)
SELECT p_partkey, kind, name <> 'red widget' AND (name = 'small ring' OR license IN ('brand#3', 'brand#13')) AS allowed,
  CASE WHEN name = 'red widget' THEN 'denied: asked to' WHEN name = 'small ring' THEN 'approved: by letter' WHEN license IN ('brand#3', 'brand#13') THEN 'licence: ' || license ELSE 'licence not approved' END AS reason
FROM k""")
def classify_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    denied = spark.createDataFrame([("red widget", "asked to")], "name string, why string")
    approved = spark.createDataFrame([("small ring", "by letter"), ("red widget", "by mistake")], "name string, why string")
    licenses = spark.createDataFrame([("brand#3",), ("brand#13",)], "license string")
    return policy.decide(part_modules(spark, sf_dir), denied, approved, licenses).select("p_partkey", "kind", "allowed", "reason")


def slugged(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.concat_ws("/", "p_name", F.lower("p_type")).alias("name"))
    loud = table(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.concat_ws(" ", F.upper("p_name"), "p_type").alias("name"))
    nation = table(spark, sf_dir, "nation").select(F.lit("nation").alias("kind"), F.col("n_name").alias("name"))
    region = table(spark, sf_dir, "region").select(F.lit("region").alias("kind"), F.col("r_name").alias("name"))
    return part.union(loud).union(nation).union(region).distinct().withColumn("slug", slug_col("name"))


SLUGS = """WITH names AS (
  SELECT 'part' AS kind, p_name || '/' || lower(p_type) AS name FROM part UNION SELECT 'part', upper(p_name) || ' ' || p_type FROM part
  UNION SELECT 'nation', n_name FROM nation UNION SELECT 'region', r_name FROM region
), slugs AS (SELECT kind, name, trim(regexp_replace(lower(name), '[^a-z0-9._-]+', '-', 'g'), '-.') AS slug FROM names)"""


@query(f"{SLUGS} SELECT kind, slug, count(DISTINCT name) AS names FROM slugs GROUP BY kind, slug HAVING count(DISTINCT name) > 1")
def slug_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.slug_collisions(slugged(spark, sf_dir))


@query(f"{SLUGS} SELECT kind, count(*) AS module_count, array_to_string(list_sort(list(slug)), ',') AS ids FROM slugs GROUP BY kind")
def catalog_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.catalog_rollup(slugged(spark, sf_dir)).select("kind", "module_count", joined("ids"))


@query("""SELECT name FROM (SELECT n_name AS name FROM nation UNION SELECT replace(r_name, ' ', '_') FROM region) WHERE name NOT IN (SELECT CASE WHEN c_nationkey < 20 THEN 'NATION_' ELSE 'OTHER_' END || c_nationkey FROM customer)""")
def missing_requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).union(table(spark, sf_dir, "region").select(F.translate("r_name", " ", "_")))
    found = table(spark, sf_dir, "customer").select(F.concat(F.when(F.col("c_nationkey") < 20, "NATION_").otherwise("OTHER_"), "c_nationkey").alias("name"))
    return policy.missing_names(asked, found)


@query("""WITH listed AS (SELECT CASE WHEN doc_id % 10 = 3 THEN 'l/' ELSE 'd/' END || doc_id AS path, sha256(text) AS sha FROM documents),
tree AS (SELECT CASE WHEN doc_id % 10 = 7 THEN 't/' ELSE 'd/' END || doc_id AS path, sha256(CASE WHEN doc_id % 10 = 5 THEN text || ' ' ELSE text END) AS sha FROM documents)
SELECT path, CASE WHEN tree.sha IS NULL THEN 'missing' WHEN listed.sha IS NULL THEN 'extra' ELSE 'mismatch' END AS fault
FROM listed FULL JOIN tree USING (path) WHERE listed.sha IS DISTINCT FROM tree.sha""")
def manifest_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on both sides; some are listed or filed under other names, some differ."""
    docs, n = table(spark, sf_dir, "documents"), F.col("doc_id")
    path = lambda odd, name: F.concat(F.when(n % 10 == odd, name).otherwise("d/"), n).alias("path")
    listed = docs.select(path(3, "l/"), F.sha2("text", 256).alias("sha256"))
    tree = docs.select(path(7, "t/"), F.sha2(F.when(n % 10 == 5, F.concat("text", F.lit(" "))).otherwise(F.col("text")), 256).alias("sha256"))
    return checks.manifest_faults(listed, tree)


@query("""SELECT conv_id, count(*) AS rows, count(DISTINCT turn) <> count(*) OR min(turn) <> 0 OR max(turn) <> count(*) - 1 AS broken FROM conversations GROUP BY conv_id
UNION ALL SELECT -1, count(*), count(DISTINCT event_id) <> count(*) OR min(event_id) <> 0 OR max(event_id) <> count(*) - 1 FROM events
UNION ALL SELECT -2 - user_id, count(*), count(DISTINCT event_id) <> count(*) OR min(event_id) <> 0 OR max(event_id) <> count(*) - 1 FROM events GROUP BY user_id""")
def ordinal_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = checks.ordinal_gaps(table(spark, sf_dir, "conversations"), ["conv_id"], "turn").select("conv_id", "rows", "broken")
    events = table(spark, sf_dir, "events")
    whole = checks.ordinal_gaps(events.withColumn("conv_id", F.lit(-1).cast("long")), ["conv_id"], "event_id").select("conv_id", "rows", "broken")
    users = checks.ordinal_gaps(events.withColumn("conv_id", -2 - F.col("user_id")), ["conv_id"], "event_id").select("conv_id", "rows", "broken")
    return turns.union(whole).union(users)


@query("""SELECT doc_id, CASE doc_id % 6 WHEN 1 THEN 'size' WHEN 2 THEN 'sha256' WHEN 3 THEN 'base64' WHEN 4 THEN 'utf8' WHEN 5 THEN 'encoding' END AS fault FROM documents""")
def byte_value_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as byte values, five in six of them spoiled in one member."""
    docs, n, text = table(spark, sf_dir, "documents"), F.col("doc_id") % 6, F.col("text")
    value = F.struct(
        F.when(n == 3, F.lit("not base64!")).otherwise(F.regexp_replace(F.base64(F.encode(text, "UTF-8")), "[\r\n]", "")).alias("base64"),
        F.when(n == 5, "hex").otherwise("base64").alias("encoding"), F.when(n == 2, F.sha2(F.lit("x"), 256)).otherwise(F.sha2(text, 256)).alias("sha256"),
        (F.octet_length(F.encode(text, "UTF-8")) + F.when(n == 1, 1).otherwise(0)).cast("long").alias("size"), F.when(n == 4, F.concat(text, F.lit("."))).otherwise(text).alias("utf8"),
    )
    return docs.select("doc_id", checks.byte_value_fault(value).alias("fault"))


@query("""SELECT event_type AS kind, count(*) AS seen, count(*) FILTER (event_type <> 'error') AS expected FROM events GROUP BY event_type HAVING count(*) <> count(*) FILTER (event_type <> 'error')
UNION ALL SELECT 'footer', 0, count(*) FROM events""")
def count_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The footer lacks the errors and lists a kind that there is none of."""
    events = table(spark, sf_dir, "events")
    footer = events.where("event_type <> 'error'").groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("expected"))
    return checks.count_mismatches(events, "event_type", footer.union(events.agg(F.lit("footer"), F.count("*"))))


@query("""SELECT conv_id AS artifact_id, CASE WHEN conv_id % 4 = 1 THEN 'size' WHEN conv_id % 4 = 2 THEN 'sha256' ELSE 'size expected' END AS fault
FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 4 > 0""")
def artifact_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as artifacts whose turns are chunks; three in four have a false size or digest."""
    turns = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "artifact_id")
    chunks = turns.select("artifact_id", F.col("turn").alias("index"), F.encode("text", "UTF-8").alias("data"))
    whole = turns.groupBy("artifact_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    whole = whole.select("artifact_id", F.encode(F.array_join("t.text", ""), "UTF-8").alias("data"))
    n, size = F.col("artifact_id") % 4, F.octet_length("data").cast("long")
    begins = whole.select("artifact_id", F.lit("regular").alias("file_type"), F.when(n == 3, size + 1).otherwise(size).alias("size_expected"))
    ends = whole.select("artifact_id", F.when(n == 1, size + 1).otherwise(size).alias("size"), F.when(n == 2, F.sha2(F.lit("x"), 256)).otherwise(F.sha2("data", 256)).alias("sha256"))
    return checks.artifact_faults(begins, chunks, ends)


@query(r"""SELECT p_partkey, lower(trim(regexp_replace('  ' || p_brand || chr(9) || ' ' || p_type || chr(10), '\s+', ' ', 'g'))) AS license FROM part""")
def license_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand and type as a licence's name, blanks around and between them."""
    said = F.concat(F.lit("  "), "p_brand", F.lit("\t "), "p_type", F.lit("\n"))
    return table(spark, sf_dir, "part").select("p_partkey", license_text(said).alias("license"))


KINDS = """m AS (SELECT p_partkey, p_name AS name,
  CASE p_type WHEN 'ECONOMY' THEN 'rawcom' WHEN 'PROMO' THEN 'zld' WHEN 'MEDIUM' THEN 'rawfiles' WHEN 'LARGE' THEN 'rawtext' WHEN 'STANDARD' THEN 'rawld4' ELSE 'zcom4' END AS driver, p_size % 2 = 0 AS comment FROM part),
kinds AS (SELECT *, CASE WHEN driver IN ('rawcom', 'zcom4') OR driver = 'rawfiles' AND comment THEN 'commentaries' WHEN driver IN ('zld', 'rawld4', 'rawfiles') THEN 'dictionaries' END AS kind FROM m)"""


@query(f"WITH {KINDS} SELECT p_partkey, p_type AS name, kind FROM kinds JOIN part USING (p_partkey) WHERE kind = 'dictionaries' AND p_type IN ('PROMO', 'STANDARD')")
def selected_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = policy.select_modules(part_modules(spark, sf_dir).withColumn("name", F.col("type")), "dictionaries", ["Promo", "standard"])
    return found.select("p_partkey", "name", "kind")


@query(f"""WITH {KINDS} SELECT p_partkey, name, kind FROM kinds WHERE (p_partkey % 3 = 0) <> (kind = 'dictionaries') AND kind IS NOT NULL""")
def misclassified_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams that call every third module a dictionary, and all others commentaries."""
    modules = part_modules(spark, sf_dir).where("kind is not null").withColumn("title", F.col("name")).withColumn("name", F.col("p_partkey").cast("string"))
    streams = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("name"), F.when(F.col("p_partkey") % 3 == 0, "dictionary").otherwise("commentary").alias("classification"))
    names = modules.select(F.col("name"), "p_partkey", "title")
    return policy.misclassified(modules, streams).join(names, "name").select("p_partkey", F.col("title").alias("name"), "kind")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'build' ELSE 'schema' END AS slug FROM part WHERE p_partkey % 7 = 0 OR p_size = 9""")
def reserved_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of which some are named like the folders that no module may take."""
    part = table(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 7 == 0, "Build.").when(F.col("p_size") == 9, " SCHEMA ").otherwise(F.col("p_name"))
    return policy.reserved_names(part.select("p_partkey", slug_col(name).alias("slug")))


@query("SELECT p_partkey, p_brand AS value, 'KJV' AS versification FROM part")
def last_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field's last value, and the default of one that isn't there."""
    part = table(spark, sf_dir, "part").withColumn("fields", F.create_map(F.lit("description"), F.array("p_name", F.concat(F.lit(" "), "p_brand", F.lit(" ")))))
    return part.select("p_partkey", policy.last_value(F.col("fields"), "description").alias("value"), policy.last_value(F.col("fields"), "versification", "KJV").alias("versification"))


@query("""WITH v AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN 'John.3.16' END AS osis, p_partkey % 3 AS half, p_size AS place FROM part)
SELECT p_partkey, CASE WHEN osis IS NOT NULL THEN 43 WHEN half = 1 AND place BETWEEN 1 AND 39 THEN place WHEN half = 2 AND place BETWEEN 1 AND 27 THEN place + 39 END AS book FROM v""")
def book_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_partkey")
    verse = F.struct(F.when(n % 10 == 0, "John.3.16").alias("osis"), (n % 3).alias("testament"), F.col("p_size").alias("book"))
    return table(spark, sf_dir, "part").select("p_partkey", coordinates(verse).cast("long").alias("book"))


@query("""WITH e AS (SELECT p_brand AS module, p_partkey, CASE p_partkey % 3 WHEN 1 THEN CASE WHEN p_size <= 39 THEN p_size END WHEN 2 THEN CASE WHEN p_size <= 27 THEN p_size + 39 END END AS book,
  p_partkey % 4 - 1 AS chapter, p_partkey % 11 AS verse, p_name AS text, 'Gen.' || p_size || '.' || (p_partkey % 5 + 1) AS ref FROM part)
SELECT module, CAST(book AS BIGINT) AS book, CAST(chapter AS BIGINT) AS chapter, CAST(min(verse) AS BIGINT) AS verse, text, array_to_string(list_sort(list(DISTINCT ref)), ',') AS refs, count(*) AS copies
FROM e WHERE book IS NOT NULL AND chapter >= 0 AND text <> '' GROUP BY module, book, chapter, text""")
def commentary_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as entries of commentaries: the brand is the module, the size the book; entries of a chapter with one text
    become one, which has the references of all."""
    n = F.col("p_partkey")
    verse = F.struct(F.lit(None).cast("string").alias("osis"), (n % 3).cast("int").alias("testament"), F.col("p_size").cast("int").alias("book"), (n % 4 - 1).cast("int").alias("chapter"), (n % 11).cast("int").alias("verse"))
    raw = F.concat(F.lit("see Gen."), "p_size", F.lit("."), n % 5 + 1)
    entries = table(spark, sf_dir, "part").select(F.col("p_brand").alias("module"), n.alias("ordinal"), F.lit("").alias("key"), raw.alias("raw"), F.lit("<p>no</p>").alias("html"), F.col("p_name").alias("plain"), verse.alias("verse"))
    found = commentary.commentary_entries(commentary.commentary_rows(entries))
    refs = F.array_join(F.array_sort(F.transform("references", lambda x: x["osis"])), ",").alias("refs")
    return found.select("module", *[F.col(x).cast("long").alias(x) for x in ("book", "chapter", "verse")], "text", refs, "copies")


@query(f"WITH {LINES} SELECT doc_id, text, count(*) AS times FROM lines GROUP BY doc_id, text HAVING count(*) > 1")
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.repeated_texts(numbered_lines(spark, sf_dir), ["doc_id"]).select("doc_id", "text", "times")


@query(f"{COLLAPSED} SELECT doc_id, verse FROM collapsed WHERE len(covered) > 1 AND doc_id % 3 = 0")
def false_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document's collapsed lines with an anchor one too high."""
    found = collapse.collapse(numbered_lines(spark, sf_dir), ["doc_id"], order="verse").withColumn("right", F.col("verse"))
    spoiled = found.withColumn("verse", F.col("verse") + F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0))
    return validate.false_anchors(spoiled).select("doc_id", F.col("right").alias("verse"))


@query(f"{EDGES} SELECT src, dst FROM edges WHERE length(src) % 2 = 0")
def one_way_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links both ways; sources with ids of even length are lacking from the lists back."""
    edges = written(page_edges(spark, sf_dir), "edges")
    back = lexicon.neighbours(edges, forward=False).withColumn("ids", F.filter("ids", lambda x: F.length(x) % 2 == 1))
    return validate.one_way_links(lexicon.neighbours(edges), back).select("src", "dst")


@query("""SELECT 'd/' || doc_id || '.json' AS path, CAST(octet_length(encode(text)) AS BIGINT) AS size FROM documents WHERE octet_length(encode(text)) > 4096""")
def oversized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d/"), "doc_id", F.lit(".json")).alias("path"), collapse.utf8_bytes().alias("size"))
    return publish.oversized(docs, 4096)


@query("SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 5 = 0")
def composition_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations against their turns, some of which were changed."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.concat_ws(":", "turn", "role", "text").alias("entry"))
    whole = turns.withColumn("entry", F.when(F.col("conv_id") % 5 == 0, F.concat("entry", F.lit("."))).otherwise(F.col("entry")))
    return validate.composition_faults(turns, whole, ["conv_id"]).select("conv_id")


BOOK_NAMES = "names(book, name) AS (VALUES " + ", ".join(f"({number}, '{name}')" for number, name, _ in refs.BOOKS) + ")"


def line_modules(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, modules, books): a source is a commentary, a document a chapter of one of 66 books, its lines are the verses."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("none")).alias("module"))
    lines = collapse.collapse(numbered_lines(spark, sf_dir).where("text <> ''"), ["doc_id"], order="verse")
    none = F.lit(None).cast("string")
    rows = lines.join(docs, "doc_id").select("module", (F.col("doc_id") % 66 + 1).alias("book"), F.col("doc_id").alias("chapter"), "verse", "positions", none.alias("osis"), "text", F.array().cast(refs.REFERENCES).alias("references"), "copies")
    modules = docs.select("module").distinct().select("module", F.lower("module").alias("id"), F.lit("en").alias("language"), F.concat(F.lit("All of "), "module").alias("description"))
    return rows.withColumn("entry", documents.shown_entry()), modules, refs.books(spark).select("book", "name").distinct()


STORED = rf"""WITH {LINES}, {BOOK_NAMES}, e AS (
  SELECT coalesce(source, 'none') AS module, doc_id % 66 + 1 AS book, doc_id AS chapter, lines.text AS text, min(verse) AS verse, list_distinct(list(verse)) AS covered, count(*) AS copies
  FROM lines JOIN documents USING (doc_id) WHERE lines.text <> '' GROUP BY ALL
), sized AS (
  SELECT *, octet_length(encode(text)) AS size,
    2 + 14 + length(CAST(book AS VARCHAR)) + 17 + length(CAST(chapter AS VARCHAR)) + 15 + length(CAST(verse AS VARCHAR)) + 14 + octet_length(encode(CAST(to_json(text) AS VARCHAR))) + 6
      + CASE WHEN len(covered) > 1 THEN 2 + 16 + 10 + list_sum(list_transform(covered, lambda x: 8 + length(CAST(x AS VARCHAR)))) + 2 * (len(covered) - 1) ELSE 0 END + 6 AS bytes,
    6 + CASE WHEN len(covered) > 1 THEN len(covered) + 2 ELSE 0 END AS lines
  FROM e
), heads AS (
  SELECT module, book, chapter, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(lines) AS BIGINT) AS lines,
    '",' || chr(10) || '  "commentary": "' || lower(module) || '",' || chr(10) || '  "language": "en",' || chr(10) AS about, '  "book": ' || book || ',' || chr(10) || '  "name": "' || name || '",' || chr(10) AS named
  FROM sized JOIN names USING (book) GROUP BY module, book, chapter, name
), chapters AS (
  SELECT *, length('{{' || chr(10) || '  "schema": "commentary-chapter-v1' || about || named || '  "chapter": ' || chapter || ',' || chr(10) || '  "entries": [' || chr(10)) + bytes + 4 * n + 2 * (n - 1) + length(chr(10) || '  ]' || chr(10) || '}}' || chr(10)) AS size,
    8 + lines + 2 AS rows FROM heads
), book_rows AS (
  SELECT module, book, about, CAST(length('{{' || chr(10) || '  "schema": "commentary-book-v1' || about || named || '  "chapters": [' || chr(10)) + sum(size - 1 + 4 * rows) + 2 * (count(*) - 1) + 7 AS BIGINT) AS size, CAST(7 + sum(rows) + 2 AS BIGINT) AS rows, sum(size) AS chapters
  FROM chapters GROUP BY module, book, about, named
), blocks AS (
  SELECT module, CAST(sum(chapters) AS BIGINT) AS chapter_bytes, CAST(sum(size) AS BIGINT) AS book_bytes,
    CAST(length('{{' || chr(10) || '  "schema": "commentary-v1' || about || '  "name": "All of ' || module || '",' || chr(10) || '  "books": [' || chr(10)) + sum(size - 1 + 4 * rows) + 2 * (count(*) - 1) + 7 AS BIGINT) AS commentary_bytes
  FROM book_rows GROUP BY module, about
), texts AS (SELECT module, CAST(sum(copies) AS BIGINT) AS source_entry_count, CAST(sum(copies * size) AS BIGINT) AS source_text_bytes, CAST(sum(size) AS BIGINT) AS text_bytes FROM sized GROUP BY module)"""


@query(f"{STORED} SELECT *, chapter_bytes + book_bytes + commentary_bytes AS published_bytes FROM texts JOIN blocks USING (module)")
def storage_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source would be published with at every level; the rounded ratio, which SQL rounds otherwise, is left out."""
    return collapse.storage_blocks(*line_modules(spark, sf_dir)).drop("repetition_ratio")


@query(r"""WITH turns AS (
  SELECT conv_id, string_agg('    {' || chr(10) || '      "turn": ' || turn || coalesce(',' || chr(10) || '      "role": ' || CAST(to_json(role) AS VARCHAR), '') || coalesce(',' || chr(10) || '      "text": ' || CAST(to_json(text) AS VARCHAR), '') || chr(10) || '    }',
    ',' || chr(10) ORDER BY turn, role, text) AS turns FROM conversations GROUP BY conv_id
), shown AS (SELECT conv_id, '{' || chr(10) || '  "schema": "conversation-v1",' || chr(10) || '  "id": ' || conv_id || ',' || chr(10) || '  "turns": [' || chr(10) || turns || chr(10) || '  ]' || chr(10) || '}' || chr(10) AS json FROM turns)
SELECT 'conversations/' || conv_id || '.json' AS path, sha256(json) AS sha256, CAST(octet_length(encode(json)) AS BIGINT) AS size FROM shown""")
def published_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents: rendered, published by commit, and read back from the files."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    document = documents.named("conversation-v1", F.col("conv_id").alias("id"), F.col("turns"))
    folder = scratch(spark, "published")
    store.write_documents(publish.render(rows, F.concat(F.lit("conversations/"), "conv_id", F.lit(".json")), document), folder, publish.CEILING)
    found = store.read_documents(spark, folder)
    return found.select("path", F.sha2("json", 256).alias("sha256"), F.octet_length("json").cast("long").alias("size"))


#: The shape of a document's record in ``shape_check``.
RECORD = {
    "$defs": {"text": {"type": "object", "required": ["size", "value"], "properties": {"size": {"type": "integer", "minimum": 0}, "value": {"type": "string", "minLength": 1}}, "additionalProperties": False}},
    "type": "object", "required": ["id", "text"],
    "properties": {"id": {"type": "integer", "minimum": 0}, "lang": {"enum": ["de", "en", "es", "fr"]}, "tags": {"type": "array", "minItems": 1, "items": {"type": "string", "pattern": "^[a-z0-9]+$"}}, "text": {"$ref": "#/$defs/text"}},
}


@query("""SELECT doc_id, CASE doc_id % 11 WHEN 1 THEN 'id' WHEN 2 THEN 'record' WHEN 3 THEN 'tags.1' WHEN 4 THEN 'text' WHEN 5 THEN 'text.size' WHEN 6 THEN 'lang' WHEN 7 THEN 'tags' WHEN 8 THEN 'text.value' WHEN 9 THEN 'record' END AS path,
  CASE doc_id % 11 WHEN 1 THEN 'minimum' WHEN 2 THEN 'required' WHEN 3 THEN 'pattern' WHEN 4 THEN 'additionalProperties' WHEN 5 THEN 'type' WHEN 6 THEN 'enum' WHEN 7 THEN 'minItems' WHEN 8 THEN 'type' WHEN 9 THEN 'type' END AS rule FROM documents""")
def shape_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records, nine in eleven of them spoiled in one or two places, of which the first is told."""
    docs, n = table(spark, sf_dir, "documents"), F.col("doc_id") % 11
    text, size = F.coalesce("text", F.lit("-")), F.octet_length(F.coalesce("text", F.lit("-")))
    member = lambda odd, spoiled, good: F.when(n == odd, spoiled).otherwise(good)
    said = F.to_json(F.struct(F.concat(text, F.lit(".")).alias("value")))  # {"value":"..."}
    inner = F.concat(F.lit('{"size":'), member(5, F.lit('"many"'), size.cast("string")), member(4, F.lit(',"html":1'), F.lit("")), F.lit(","), member(8, F.lit('"value":7}'), F.substring(said, 2, 1 << 30)))
    whole = F.concat(
        F.lit('{"id":'), F.when(n == 1, F.concat(F.lit("-"), F.col("doc_id") + 1)).otherwise(F.col("doc_id").cast("string")), F.lit(',"lang":'), member(6, F.lit('"xx"'), F.lit('"de"')), F.lit(',"tags":'), member(7, F.lit("[]"), member(3, F.lit('["a","B","c"]'), F.lit('["a","b"]'))),
        member(2, F.lit(""), F.concat(F.lit(',"text":'), inner)), F.lit("}"),
    )
    records = docs.select("doc_id", F.lit("document").alias("type"), member(9, F.substring(whole, 1, 9), whole).alias("record"))
    return shapes.shape_faults(records, {"document": RECORD}).select("doc_id", "path", "rule")


@query(f"""{COLLAPSED}, marked AS (
  SELECT doc_id || ':' || verse AS path, doc_id % 3 = 0 AND len(covered) > 1 AS anchor, octet_length(encode(text)) > 400 AS large, text = '' AS blank, false AS repeated FROM collapsed
), told AS (
  SELECT 'anchor is the lowest' AS rule, path, anchor AS broken FROM marked UNION ALL SELECT 'no text repeats', path, repeated FROM marked
  UNION ALL SELECT 'text is short', path, large FROM marked UNION ALL SELECT 'text is there', path, blank FROM marked
), ranked AS (SELECT rule, path, row_number() OVER (PARTITION BY rule ORDER BY path) AS n FROM told WHERE broken)
SELECT rule, count(*) AS rows, count(*) FILTER (broken) AS broken, coalesce((SELECT string_agg(path, ',' ORDER BY n) FROM ranked WHERE ranked.rule = told.rule AND n <= 20), '') AS problems FROM told GROUP BY rule""")
def validation_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on collapsed lines, counted while they are written; every third document's anchors are spoiled."""
    found = collapse.collapse(numbered_lines(spark, sf_dir), ["doc_id"], order="verse").withColumn("path", F.concat_ws(":", "doc_id", "verse"))
    spoiled = found.withColumn("verse", F.col("verse") + F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0))
    rules = {
        "anchor is the lowest": F.col("positions").isNull() | (F.array_min("covered") == F.col("verse")), "no text repeats": F.count("*").over(Window.partitionBy("doc_id", "text")) == 1,
        "text is short": collapse.utf8_bytes() <= 400, "text is there": F.col("text") != "",
    }
    report = validate.write_checked(spoiled, rules, scratch(spark, "checked"))
    return report.select("rule", "rows", "broken", joined("problems"))


@query(f"{EDGES} SELECT count(*) AS entries, count(*) FILTER (id IN (SELECT src FROM edges)) AS linked FROM named")
def linked_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = named_pages(spark, sf_dir)
    return validate.linked_count(named, lexicon.neighbours(edges_of(spark, sf_dir, named))).select("entries", "linked")


@query("""SELECT p_partkey, map_keys AS names, language, feature, prefix FROM (
  SELECT p_partkey, 'classification,description,driver,feature,language,name,sword_type' AS map_keys, p_type AS language, CASE WHEN p_size % 2 = 0 THEN 'GreekDef' ELSE 'none' END AS feature,
    CASE WHEN p_size % 2 = 0 THEN 'G' WHEN p_partkey % 3 = 0 THEN 'H' END AS prefix FROM part)""")
def module_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as modules of record streams: a module record each, and settings of which the last ones are laid over it."""

    def value(text: F.Column) -> F.Column:
        packed = F.regexp_replace(F.base64(F.encode(text, "UTF-8")), "[\r\n]", "")
        return F.struct(packed.alias("base64"), F.lit("base64").alias("encoding"), F.sha2(text, 256).alias("sha256"), F.octet_length(text).cast("long").alias("size"))

    part, n = table(spark, sf_dir, "part"), F.col("p_partkey")
    about = F.when(n % 3 == 0, F.concat(F.lit("Strong Hebrew "), "p_name")).otherwise(F.col("p_name"))
    module = F.struct(value(about).alias("description"), value(F.lit("d")).alias("driver"), value(F.lit("en")).alias("language"), value(F.col("p_name")).alias("name"), value(F.lit("s")).alias("sword_type"))
    setting = lambda k, name, text: F.struct(value(F.lit(name)).alias("name"), F.lit(k).alias("ordinal"), value(text).alias("value"))
    settings = [setting(0, "Language", F.col("p_brand")), setting(1, "Feature", F.when(F.col("p_size") % 2 == 0, "GreekDef").otherwise("none")), setting(2, "LANGUAGE", F.col("p_type"))]
    lines = [("module", F.to_json(module)), *[("config_entry", F.to_json(x)) for x in settings]]
    rows = part.select(n.cast("string").alias("file"), F.explode(F.array(*[F.struct(F.lit(k).alias("sequence"), F.lit(kind).alias("type"), x.alias("record")) for k, (kind, x) in enumerate(lines)])).alias("r")).select("file", "r.*")
    found = ndjson.described_stream(rows)
    return found.select(F.col("module").cast("long").alias("p_partkey"), F.array_join(F.array_sort(F.map_keys("metadata")), ",").alias("names"), "language", F.try_element_at("metadata", F.lit("feature")).alias("feature"), "prefix")


@query(rf"""WITH {BASES}, records AS (
  SELECT row_number() OVER (ORDER BY search, folded, occurrence, ordinal) AS rank, '    {{' || chr(10) || '      "id": ' || to_json(id)::VARCHAR || ',' || chr(10) || '      "key": ' || to_json(key)::VARCHAR || ',' || chr(10)
    || '      "search": ' || to_json(search)::VARCHAR || CASE WHEN occurrence > 1 THEN ',' || chr(10) || '      "occurrence": ' || occurrence ELSE '' END || chr(10) || '    }}' AS record FROM named
), whole AS (
  SELECT '{{' || chr(10) || '  "schema": "dictionary-index-v1",' || chr(10) || '  "dictionary": "pages",' || chr(10) || '  "language": "en",' || chr(10) || '  "name": "All pages",' || chr(10) || '  "entry_url_template": "{{entry}}.json",' || chr(10)
    || '  "entry_count": ' || count(*) || ',' || chr(10) || '  "unique_key_count": ' || (SELECT count(DISTINCT folded) FROM named) || ',' || chr(10) || '  "entries": [' || chr(10) || string_agg(record, ',' || chr(10) ORDER BY rank) || chr(10) || '  ]' || chr(10) || '}}' || chr(10) AS json
  FROM records
) SELECT 'pages/index.json' AS path, sha256(json) AS sha256, CAST(octet_length(encode(json)) AS BIGINT) AS size FROM whole""")
def index_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of all pages as one published document, written a record at a time and read back by its bytes."""
    named = searched_pages(spark, sf_dir)
    modules = named.select("module").distinct().select("module", F.col("module").alias("id"), F.lit("en").alias("language"), F.lit("All pages").alias("description"))
    folder = scratch(spark, "published")
    store.write_documents(documents.index_documents(lexicon.search_index(named), lexicon.unique_keys(named), modules), folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(folder)
    return files.select(F.concat_ws("/", F.slice(F.split("path", "/"), -2, 2)).alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


@query("""SELECT book, chapter, min(verse) AS verse, text, array_to_string(list_sort(list(DISTINCT verse)), ',') AS covered, count(*) AS copies
FROM (SELECT conv_id % 66 + 1 AS book, conv_id AS chapter, turn AS verse, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text FROM conversations) WHERE text <> '' GROUP BY book, chapter, text""")
def stream_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as entries of commentaries that arrive in files, dealt so that a chapter comes in pieces; passages keep what they cover as state."""
    verse = F.struct(F.lit(None).cast("string").alias("osis"), F.when(F.col("conv_id") % 66 < 39, 1).otherwise(2).alias("testament"), F.when(F.col("conv_id") % 66 < 39, F.col("conv_id") % 66 + 1).otherwise(F.col("conv_id") % 66 - 38).cast("int").alias("book"), F.col("conv_id").cast("int").alias("chapter"), F.col("turn").cast("int").alias("verse"))
    rows = table(spark, sf_dir, "conversations").select(F.lit("c").alias("module"), F.col("turn").cast("long").alias("ordinal"), F.lit("").alias("key"), F.lit("").alias("raw"), F.lit("").alias("html"), F.col("text").alias("plain"), verse.alias("verse"))
    arrived, found = scratch(spark, "arrived"), scratch(spark, "collapsed")
    rows.repartition(12).write.json(arrived)  # round robin: a chapter's turns part, and no file is larger than others
    ingest.collapse_into(ingest.entry_stream(spark, arrived, files_a_batch=4), found, scratch(spark, "progress")).awaitTermination()
    got = ingest.collapsed(spark, found)
    return got.select(F.col("book").cast("long").alias("book"), F.col("chapter").cast("long").alias("chapter"), F.col("verse").cast("long").alias("verse"), "text", joined("covered"), "copies")


def stream_text(pdf: pd.DataFrame) -> pd.DataFrame:
    """A conversation as one record stream: its turns are the entries, its role their key."""
    pdf = pdf.sort_values(["turn", "role", "text"], ignore_index=True)

    def value(text: str) -> dict:
        data = text.encode()
        return {"base64": base64.b64encode(data).decode(), "encoding": "base64", "sha256": hashlib.sha256(data).hexdigest(), "size": len(data), "utf8": text}

    about = {x: value(x) for x in ndjson.ABOUT} | {"name": value(f"c{pdf['conv_id'].iat[0]}")}
    records = [{"type": "header", "command": "extract", "contract": "turns/1"}, {"type": "module", "classification": "commentary", **about}]
    records += [{"type": "entry", "ordinal": k, "key": value(x.role or ""), "raw": value(x.text or ""), "stripped": value(x.text or "")} for k, x in enumerate(pdf.itertuples())]
    lines = [json.dumps(dict(sorted((x | {"sequence": k}).items())), ensure_ascii=False) + "\n" for k, x in enumerate(records)]
    footer = {
        "type": "footer", "sequence": len(lines), "success": True, "stream_sha256": hashlib.sha256("".join(lines).encode()).hexdigest(), "entries": len(pdf), "artifacts": 0, "artifact_bytes": 0,
        "counts": {"header": 1, "module": 1} | ({"entry": len(pdf)} if len(pdf) else {}), "diagnostics": dict.fromkeys(ndjson.SEVERITIES, 0),
    }
    return pd.DataFrame({"path": [f"c{pdf['conv_id'].iat[0]}.ndjson"], "json": ["".join(lines) + json.dumps(dict(sorted(footer.items()))) + "\n"]})


@query("""SELECT 'c' || conv_id AS module, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS BIGINT) AS ordinal, coalesce(role, '') AS key, coalesce(text, '') AS plain FROM conversations""")
def record_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as record streams with digests, written as files and read by the data source that checks each line by line."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    folder = scratch(spark, "streams")
    store.write_documents(rows.groupBy("conv_id").applyInPandas(stream_text, store.SCHEMA), folder, suffix=".ndjson")
    streams = ndjson.read_streams(spark, folder, contract="turns/1")
    names = ndjson.described_stream(streams).select("module", "name")
    return ndjson.entries(streams).join(names, "module").select(F.col("name").alias("module"), "ordinal", "key", "plain")


CONF_DRIVERS = ("zCom", "zLD", "RawFiles", "RawText", "rawld4")


@query("""SELECT replace(s_name, '#', '-') AS name, 'Of ' || s_name || ' in ' || s_nationkey AS description, CASE WHEN s_suppkey % 3 = 0 THEN 'und' ELSE 'de' END AS language, 'nation ' || s_nationkey || ' licence' AS license_key,
  CASE s_suppkey % 5 WHEN 0 THEN 'commentaries' WHEN 1 THEN 'dictionaries' WHEN 2 THEN CASE WHEN s_nationkey % 2 = 0 THEN 'commentaries' ELSE 'dictionaries' END WHEN 4 THEN 'dictionaries' END AS kind,
  'first,' || s_nationkey AS features FROM supplier""")
def conf_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as configuration files with comments, continued lines, repeated keys and odd blanks; parsed and described."""
    rows, nation = table(spark, sf_dir, "supplier"), F.col("s_nationkey")
    driver = F.element_at(F.array(*map(F.lit, CONF_DRIVERS)), (F.col("s_suppkey") % 5 + 1).cast("int"))
    category = F.when(nation % 2 == 0, "Commentaries").otherwise("Lexicons / Dictionaries")
    lang = F.when(F.col("s_suppkey") % 3 == 0, "; no language\n").otherwise("Lang= DE \n")
    text = F.concat(
        F.lit("# a module\n[Old]\n["), F.replace("s_name", F.lit("#"), F.lit("-")), F.lit("]\nDescription=old\nDESCRIPTION = Of "), "s_name", F.lit(" \\\n# between\n  in "), nation, F.lit("\n indented=no\n"), lang,
        F.lit("ModDrv="), driver, F.lit("\nCategory="), category, F.lit("\nFeature=first\nfeature="), nation, F.lit("\nDistributionLicense=  NATION \t "), nation, F.lit("  Licence\n"),
    )
    folder = scratch(spark, "confs")
    path = F.concat(F.col("s_suppkey") % 100, F.lit("/s"), "s_suppkey", F.lit(".conf")).alias("path")
    store.write_documents(rows.select(path, text.alias("json")), folder, suffix=".conf")
    found = conf.described(conf.read_confs(spark, folder))
    return found.select("name", "description", "language", "license_key", "kind", F.array_join(F.try_element_at("fields", F.lit("feature")), ",").alias("features"))


@query(rf"""{STORED}, shown AS (
  SELECT module, book, chapter, string_agg('    {{' || chr(10) || '      "book": ' || book || ',' || chr(10) || '      "chapter": ' || chapter || ',' || chr(10) || '      "verse": ' || verse || ',' || chr(10)
    || CASE WHEN len(covered) > 1 THEN '      "verses": [' || chr(10) || '        ' || array_to_string(list_sort(covered), ',' || chr(10) || '        ') || chr(10) || '      ],' || chr(10) ELSE '' END
    || '      "text": ' || CAST(to_json(text) AS VARCHAR) || chr(10) || '    }}', ',' || chr(10) ORDER BY verse, text) AS entries
  FROM e GROUP BY module, book, chapter
), docs AS (
  SELECT lower(module) || '/' || book || '/' || chapter || '.json' AS path, '{{' || chr(10) || '  "schema": "commentary-chapter-v1' || about || named || '  "chapter": ' || chapter || ',' || chr(10) || '  "entries": [' || chr(10) || entries || chr(10) || '  ]' || chr(10) || '}}' || chr(10) AS json
  FROM shown JOIN heads USING (module, book, chapter)
) SELECT path, sha256(json) AS sha256, CAST(octet_length(encode(json)) AS BIGINT) AS size FROM docs""")
def chapter_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chapters, rendered as published."""
    entries, modules, _ = line_modules(spark, sf_dir)
    made = documents.chapter_documents(entries, modules)
    return publish.render(made, F.col("path"), F.col("document"), 0).select("path", F.sha2("json", 256).alias("sha256"), "size")


def supplier_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as modules, as a configuration describes them."""
    fields = F.create_map(F.lit("sourcetype"), F.array(F.lit("TEI")), F.lit("about"), F.array(F.lit("old"), F.lit(" new ")), F.lit("copyrightcontactname"), F.array(F.concat(F.lit("N"), "s_nationkey")))
    names = {"language": "de", "version": "1.0", "license": "free", "driver": "zLD"}
    rows = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("module"), slug_col("s_name").alias("id"), F.concat(F.lit("Of "), "s_name").alias("description"), fields.alias("fields"), "s_suppkey", "s_nationkey")
    return rows.withColumns({k: F.lit(v) for k, v in names.items()})


@query(r"""WITH modules AS (SELECT *, trim(regexp_replace(lower(s_name), '[^a-z0-9._-]+', '-', 'g'), '-.') AS id FROM supplier), docs AS (
  SELECT id || '/metadata.json' AS path, '{' || chr(10) || '  "schema": ' || '"dictionary-metadata-v1"' || ',' || chr(10) ||
    '  "id": ' || to_json(id)::VARCHAR || ',' || chr(10) ||
    '  "module": ' || to_json(s_name)::VARCHAR || ',' || chr(10) ||
    '  "name": ' || to_json('Of ' || s_name)::VARCHAR || ',' || chr(10) ||
    '  "language": ' || '"de"' || ',' || chr(10) ||
    '  "version": ' || '"1.0"' || ',' || chr(10) ||
    '  "license": ' || '"free"' || ',' || chr(10) ||
    '  "driver": ' || '"zLD"' || ',' || chr(10) ||
    '  "source_type": ' || '"TEI"' || ',' || chr(10) ||
    '  "entry_count": ' || s_suppkey || ',' || chr(10) ||
    '  "unique_key_count": ' || s_nationkey || ',' || chr(10) ||
    '  "strong_prefix": ' || CASE WHEN s_nationkey % 2 = 0 THEN '"G"' ELSE 'null' END || ',' || chr(10) ||
    '  "bytes": ' || s_suppkey * 100 || ',' || chr(10) ||
    '  "index_url": ' || '"index.json"' || ',' || chr(10) ||
    '  "entry_url_template": ' || '"{entry}.json"' || ',' || chr(10) ||
    '  "source": ' || '"tables"' || ',' || chr(10) ||
    '  "source_module_url": ' || '"https://example.org/?m=' || replace(replace(s_name, '#', '%23'), ' ', '%20') || '"' || ',' || chr(10) ||
    '  "text_source": ' || '""' || ',' || chr(10) ||
    '  "copyright": ' || '""' || ',' || chr(10) ||
    '  "copyright_holder": ' || '""' || ',' || chr(10) ||
    '  "copyright_contact": ' || '{' || chr(10) || '    "name": "N' || s_nationkey || '",' || chr(10) || '    "email": "",' || chr(10) || '    "address": ""' || chr(10) || '  }' || ',' || chr(10) ||
    '  "distribution_notes": ' || '""' || ',' || chr(10) ||
    '  "about": ' || '"new"' || ',' || chr(10) ||
    '  "conversion_note": ' || '"Converted."' || '' || chr(10) || '}' || chr(10) AS json FROM modules
) SELECT path, sha256(json) AS sha256, CAST(octet_length(encode(json)) AS BIGINT) AS size FROM docs""")
def metadata_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata of each supplier's module, rendered as published, all members."""
    modules = supplier_modules(spark, sf_dir)
    prefix = F.when(F.col("s_nationkey") % 2 == 0, "G").alias("strong_prefix")
    counts = modules.select("module", F.col("s_suppkey").alias("entry_count"), F.col("s_nationkey").alias("unique_key_count"), prefix, (F.col("s_suppkey") * 100).alias("bytes"))
    made = documents.metadata_documents(modules, counts, "dictionary", "tables", "https://example.org/?m=", "Converted.")
    return documents.rendered(made).select("path", F.sha2("json", 256).alias("sha256"), "size")


@query(r"""WITH modules AS (SELECT *, trim(regexp_replace(lower(s_name), '[^a-z0-9._-]+', '-', 'g'), '-.') AS id FROM supplier), docs AS (
  SELECT '{' || chr(10) || '  "schema": "dictionaries-catalog-v1",' || chr(10) || '  "version": 1,' || chr(10) || '  "generated_at": "2026-01-02T03:04:05Z",' || chr(10) || '  "base_url": "https://example.org/",' || chr(10)
    || '  "metadata_url_template": "{dictionary}/metadata.json",' || chr(10) || '  "index_url_template": "{dictionary}/index.json",' || chr(10) || '  "dictionary_url_template": "{dictionary}.json",' || chr(10) || '  "entry_url_template": "{dictionary}/{entry}.json",' || chr(10)
    || '  "module_count": ' || count(*) || ',' || chr(10) || '  "dictionaries": [' || chr(10)
    || string_agg('    {' || chr(10) || '      "id": "' || id || '",' || chr(10) || '      "name": "Of ' || s_name || '",' || chr(10) || '      "language": "de",' || chr(10) || '      "bytes": ' || s_suppkey || chr(10) || '    }', ',' || chr(10) ORDER BY id)
    || chr(10) || '  ]' || chr(10) || '}' || chr(10) AS json FROM modules
) SELECT 'dictionaries.json' AS path, sha256(json) AS sha256, CAST(octet_length(encode(json)) AS BIGINT) AS size FROM docs""")
def catalog_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog of all suppliers' modules, written in pieces and read back."""
    records = supplier_modules(spark, sf_dir).select("id", F.col("description").alias("name"), "language", F.col("s_suppkey").alias("bytes"))
    folder, at = scratch(spark, "published"), F.to_timestamp(F.lit("2026-01-02T03:04:05Z"))
    store.write_documents(documents.catalog(records, "dictionaries", "https://example.org/", at), folder)
    return store.read_documents(spark, folder).select("path", F.sha2("json", 256).alias("sha256"), F.octet_length("json").cast("long").alias("size"))
