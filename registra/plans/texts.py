"""Text, identifier, date and number functions on the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.functions import dates, identifiers, text
from registra.operators import markdown
from registra.plans.common import Catalog, table

CATALOG = Catalog()


def _squeezed(column: str) -> str:
    return f"regexp_replace(regexp_replace({column}, '^\\s+', ''), '\\s+$', '')"


#: Documents made into Markdown, so that every rule has something to do.
_MD = "'## ' || coalesce(lang, '') || chr(10) || '> *' || source || '* [link](http://x/' || doc_id || ')[^1]' || chr(10) || '---' || chr(10) || chr(10) || chr(10) || chr(10) || '**' || text || '**' || chr(10)"
_MD_SPARK = "concat('## ', coalesce(lang, ''), '\n> *', source, '* [link](http://x/', doc_id, ')[^1]\n---\n\n\n\n**', text, '**\n')"


@CATALOG.add(f"""
WITH d AS (SELECT doc_id, {_MD} AS md FROM documents)
SELECT doc_id, {_squeezed("regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(md, '(?m)^#{1,6}\\s+', '', 'g'), '\\*{1,3}([^*]+)\\*{1,3}', '\\1', 'g'), '\\[([^\\]]*?)\\]\\([^)]*\\)', '\\1', 'g'), '(?m)^>\\s?', '', 'g'), '(?m)^---+$', '', 'g'), '\\[\\^[^\\]]+\\]', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")} AS plain
FROM d""")
def strip_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("md", F.expr(_MD_SPARK))
    return docs.select("doc_id", text.strip_markdown(F.col("md")).alias("plain"))


@CATALOG.add(f"""
WITH d AS (SELECT doc_id, {_MD} AS md FROM documents)
SELECT doc_id, substring({_squeezed("regexp_replace(regexp_replace(md, '(?m)^#{1,6}\\s+.*$', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")}, 1, 5000) AS body FROM d""")
def search_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("md", F.expr(_MD_SPARK))
    return docs.select("doc_id", text.search_body(F.col("md")).alias("body"))


@CATALOG.add(f"SELECT doc_id, {_squeezed(chr(39).join(['regexp_replace(text, ', chr(92) + 's+', ', ', ' ', ', ', 'g', ')']))} AS line, regexp_replace({_squeezed('text')}, '\\n\\s*\\n', chr(10) || chr(10), 'g') AS paragraphs FROM documents")
def whitespace_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.one_line(F.col("text")).alias("line"), text.paragraphs(F.col("text")).alias("paragraphs"))


@CATALOG.add("""
SELECT source, sum(ceil(length(text) / 4.0))::BIGINT AS per_section, ceil(sum(length(text)) / 4.0)::BIGINT AS of_all, sum(round(length(text) / 4.0))::BIGINT AS rounded
FROM documents GROUP BY source""")
def token_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    return table(spark, sf_dir, "documents").groupBy("source").agg(
        F.sum(text.token_estimate(body)).alias("per_section"),
        F.ceil(F.sum(F.length(body)) / 4).cast("long").alias("of_all"),
        F.sum(text.token_estimate(body, "round")).alias("rounded"),
    )


@CATALOG.add("SELECT doc_id, sha256(text) AS content_hash, substring(sha256(text), 1, 16) AS etag FROM documents")
def content_hash_etag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"), text.etag(F.col("text")).alias("etag"))


@CATALOG.add("SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9_-]', '_', 'g') AS id FROM pages")
def sanitize_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.sanitize_id(F.col("url")).alias("id"))


@CATALOG.add("""
SELECT doc_id, coalesce(nullif(substring(regexp_replace(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-', ''), '-$', ''), 1, 50), ''), 'untitled') AS slug FROM documents""")
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.slug(F.col("text"), "untitled").alias("slug"))


@CATALOG.add("""
SELECT p_partkey, CASE WHEN p_size < 10 THEN '0' || p_size ELSE p_size::VARCHAR END AS padded, p_brand AS unchanged, p_size AS leading FROM part""")
def pad_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    mixed = F.concat(F.lit(" "), size, F.lit("abc"))
    return table(spark, sf_dir, "part").select("p_partkey", identifiers.pad_two(size).alias("padded"), identifiers.pad_two(F.col("p_brand")).alias("unchanged"), identifiers.leading_int(mixed).alias("leading"))


_ROMAN = "CASE {0} % 10 WHEN 0 THEN '' WHEN 1 THEN 'I' WHEN 2 THEN 'II' WHEN 3 THEN 'III' WHEN 4 THEN 'IV' WHEN 5 THEN 'V' WHEN 6 THEN 'VI' WHEN 7 THEN 'VII' WHEN 8 THEN 'VIII' ELSE 'IX' END"


@CATALOG.add("SELECT p_partkey, p_size AS value FROM part")
def roman_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    tens = F.expr("CASE p_size div 10 WHEN 0 THEN '' WHEN 1 THEN 'X' WHEN 2 THEN 'XX' WHEN 3 THEN 'XXX' WHEN 4 THEN 'XL' ELSE 'L' END")
    numeral = F.concat(tens, F.expr(_ROMAN.format("p_size")))
    return table(spark, sf_dir, "part").select("p_partkey", identifiers.roman(numeral).alias("value"))


@CATALOG.add("""
SELECT l_orderkey, l_linenumber, 'us' AS jurisdiction, CASE WHEN l_linenumber = 1 THEN 'fr' WHEN l_linenumber % 2 = 0 THEN 'usc' ELSE 'cfr' END AS code,
  CASE WHEN l_linenumber > 1 THEN l_suppkey::VARCHAR END AS title, CASE WHEN l_linenumber = 1 THEN l_orderkey || '-' || l_suppkey WHEN l_linenumber > 2 THEN l_partkey::VARCHAR END AS section,
  CASE WHEN l_linenumber > 4 THEN 'a/1' END AS sub_path
FROM lineitem
UNION ALL SELECT o_orderkey, 0, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderstatus = 'P'""")
def parse_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = """CASE WHEN l_linenumber = 1 THEN concat('/us/fr/', l_orderkey, '-', l_suppkey)
      ELSE concat('/us/', if(l_linenumber % 2 = 0, 'usc', 'cfr'), '/t', l_suppkey, if(l_linenumber > 2, concat('/s', l_partkey), ''), if(l_linenumber > 4, '/a/1', '')) END"""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(given).alias("identifier"))
    other = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("l_linenumber"), F.concat(F.lit("/us/stat/"), F.col("o_orderkey").cast("string")).alias("identifier"))
    return items.unionByName(other).select("l_orderkey", "l_linenumber", identifiers.parse_identifier(F.col("identifier")).alias("p")).select("l_orderkey", "l_linenumber", "p.*")


@CATALOG.add("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 'https://www.federalregister.gov/d/' || l_orderkey
  WHEN l_linenumber = 2 THEN 'https://uscode.house.gov/view.xhtml?req=granuleid:USC-prelim-title' || l_suppkey || '-section' || l_partkey
  WHEN l_linenumber = 3 THEN 'https://www.ecfr.gov/current/title-' || l_suppkey END AS url FROM lineitem""")
def fallback_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = """CASE l_linenumber WHEN 1 THEN concat('/us/fr/', l_orderkey) WHEN 2 THEN concat('/us/usc/t', l_suppkey, '/s', l_partkey, '/b')
      WHEN 3 THEN concat('/us/cfr/t', l_suppkey) ELSE concat('/us/pl/', l_suppkey) END"""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", identifiers.fallback_url(F.expr(given)).alias("url"))


@CATALOG.add("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN '19' || (90 + o_orderkey % 10) || '-' || lpad(o_orderkey::VARCHAR, 5, '0') END AS document_number,
  CASE WHEN o_orderkey % 7 > 0 THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') END AS publication_date FROM orders""")
def frdoc_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = "if(o_orderkey % 5 > 0, concat('[FR Doc. 19', 90 + o_orderkey % 10, '-', lpad(o_orderkey, 5, '0'), ' '), '[')"
    filed = "if(o_orderkey % 7 > 0, date_format(o_orderdate, \"'Filed 'M-d-yy\"), 'Filed 2-30-98')"
    given = F.concat(F.expr(number), F.expr(filed), F.lit("; 8:45 am]"))
    parsed = dates.filed_document(given)
    return table(spark, sf_dir, "orders").select("o_orderkey", parsed.alias("p")).select("o_orderkey", "p.*")


@CATALOG.add("""
WITH r AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS z FROM orders), m AS (
  SELECT a, z, unnest(generate_series(date_trunc('month', a)::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS first FROM r)
SELECT greatest(first, a) AS chunk_start, least(last_day(first), z) AS chunk_end, date_diff('day', greatest(first, a), least(last_day(first), z))::BIGINT + 1 AS n_days FROM m""")
def date_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = table(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("z"))
    each = span.select(F.inline(dates.month_chunks(F.col("a"), F.col("z"))))
    return each.withColumn("n_days", F.size(dates.days(F.col("chunk_start"), F.col("chunk_end"))).cast("long"))


@CATALOG.add("""
SELECT o_orderkey, (100 + o_custkey % 20) || '-' || o_custkey AS point, (100 + o_custkey % 20) || '-' || o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN 'not60' ELSE '' END AS full_point,
  (100 + o_custkey % 20) || '/' || o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN 'not60' ELSE '' END AS path, strftime(o_orderdate, '%Y-%m-%d') AS date_part FROM orders""")
def release_point_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.expr("concat('Online@', 100 + o_custkey % 20, '-', o_custkey, if(o_orderkey % 3 = 0, 'not60', ''))")
    full = identifiers.release_point(given, suffix=True)
    stamp = dates.date_part(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "orders").select("o_orderkey", identifiers.release_point(given).alias("point"), full.alias("full_point"), identifiers.release_path(full).alias("path"), stamp.alias("date_part"))


@CATALOG.add("""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') || '-01' END AS date FROM orders""")
def path_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.expr("CASE o_orderkey % 3 WHEN 0 THEN concat('a/FR-', date_format(o_orderdate, 'yyyy-MM-dd'), '.xml') WHEN 1 THEN concat('a/', date_format(o_orderdate, 'yyyy/MM'), '/x.xml') ELSE 'a/x.xml' END")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.path_date(path).alias("date"))


@CATALOG.add("""
SELECT event_id, CASE WHEN event_id % 4 > 0 THEN 'a,' || event_type END AS agencies, CASE WHEN event_id % 4 > 0 THEN 'a' ELSE event_type END AS agency,
  (props->>'$.k')::BIGINT AS k, '{"event_type":"' || event_type || '"}' AS json FROM events""")
def json_array_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.expr("if(event_id % 4 > 0, concat('[\"a\",\"', event_type, '\"]'), '[broken')")
    names = identifiers.json_array(given)
    return table(spark, sf_dir, "events").select(
        "event_id", F.array_join(names, ",").alias("agencies"), F.coalesce(F.get(names, 0), "event_type").alias("agency"),
        F.get_json_object("props", "$.k").cast("long").alias("k"), F.to_json(F.struct("event_type")).alias("json"),
    )


@CATALOG.add("""
SELECT l_orderkey, string_agg(l_suppkey || ' CFR Part ' || l_partkey, '; ' ORDER BY l_linenumber, l_suppkey, l_partkey) AS refs FROM lineitem GROUP BY l_orderkey""")
def cfr_reference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey")))
    refs = F.transform(order, lambda r: identifiers.cfr_reference(r["l_suppkey"], r["l_partkey"]))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(refs, "; ").alias("refs"))


@CATALOG.add("SELECT event_id, CASE event_type WHEN 'view' THEN 'rule' WHEN 'click' THEN 'proposed_rule' ELSE event_type || '_x' END AS document_type FROM events")
def document_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.expr("CASE event_type WHEN 'view' THEN 'Rule' WHEN 'click' THEN 'Proposed Rule' ELSE concat(initcap(event_type), ' X') END")
    return table(spark, sf_dir, "events").select("event_id", identifiers.document_type(given).alias("document_type"))


@CATALOG.add("SELECT p_partkey, p_name AS heading FROM part")
def heading_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.expr("CASE p_partkey % 3 WHEN 0 THEN concat('CHAPTER I—', p_name) WHEN 1 THEN concat('Title 7—', p_name, '--Volume 2') ELSE concat(' ', p_name, ' ') END")
    return table(spark, sf_dir, "part").select("p_partkey", identifiers.heading_stripped(given).alias("heading"))


@CATALOG.add("""
WITH s AS (SELECT doc_id, 'A ' || chr(27) || '[31m' || text || chr(7) || chr(10) AS t FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(t, '\\x1B\\[[0-9;]*[a-zA-Z]', '', 'g'), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g') AS cleaned FROM s""")
def control_char_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.concat(F.lit("A \x1b[31m"), F.col("text"), F.lit("\x07\n"))
    return table(spark, sf_dir, "documents").select("doc_id", text.control_stripped(given).alias("cleaned"))


@CATALOG.add("""
SELECT n_regionkey, '| key | name |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || CASE WHEN n_nationkey % 2 = 0 THEN n_name || '\\|x' ELSE '' END || ' |', chr(10) ORDER BY n_nationkey) AS md
FROM nation GROUP BY n_regionkey""")
def table_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.when(F.col("n_nationkey") % 2 == 0, F.array(F.col("n_nationkey").cast("string"), F.concat("n_name", F.lit("|x")))).otherwise(F.array(F.col("n_nationkey").cast("string")))
    rows = F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", cells.alias("cells")))), lambda r: r["cells"])
    headers = F.array(F.array(F.lit("key"), F.lit("name")), F.array(F.lit("one")))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(markdown.table(headers, rows).alias("md"))


@CATALOG.add("""
SELECT page_id, replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&apos;') AS loc,
  CASE len(string_split(regexp_replace(url, '^[a-z]+://', ''), '/')) WHEN 1 THEN '1.0' WHEN 2 THEN '0.8' WHEN 3 THEN '0.6' ELSE '0.4' END AS priority FROM pages""")
def sitemap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    depth = F.size(F.split(F.regexp_replace("url", "^[a-z]+://", ""), "/"))
    priority = F.when(depth == 1, "1.0").when(depth == 2, "0.8").when(depth == 3, "0.6").otherwise("0.4")
    return table(spark, sf_dir, "pages").select("page_id", text.xml_escaped(F.col("url")).alias("loc"), priority.alias("priority"))


@CATALOG.add("""
SELECT doc_id, CASE WHEN length(text) > 120 THEN substring(text, 1, 117) || '...' ELSE text END AS title FROM documents""")
def truncated_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.truncated(F.col("text")).alias("title"))


#: Words in a row, as they are given and as they are shown.
_TITLES = ["EPA RULES ON", "(THE AIR) AND", "\tSO IT IS", "YET U.S. FROM", "A  SEC.", "Mixed case stays", "§ NASA — WITH"]
_SHOWN = ["EPA Rules on", "(The Air) and", "\tso It Is", "yet U.S. From", "a  Sec.", None, "§ NASA — With"]


@CATALOG.add(f"""
WITH p AS (SELECT p_partkey, p_name, [{", ".join(f"'{t}'" for t in _TITLES)}][p_partkey % {len(_TITLES)} + 1] AS given, [{", ".join("NULL" if t is None else f"'{t}'" for t in _SHOWN)}][p_partkey % {len(_TITLES)} + 1] AS shown FROM part)
SELECT p_partkey, CASE WHEN shown IS NULL THEN lower(p_name) || ' ' || given || ' of the usc'
  ELSE upper(p_name[1:1]) || p_name[2:position(' ' in p_name)] || upper(p_name[position(' ' in p_name) + 1:position(' ' in p_name) + 1]) || p_name[position(' ' in p_name) + 2:] || ' ' || shown || ' of the USC' END AS title FROM p""")
def title_cased(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.get(F.array(*[F.lit(t) for t in _TITLES]), (F.col("p_partkey") % len(_TITLES)).cast("int"))
    raised = F.upper(F.concat("p_name", F.lit(" "), given, F.lit(" of the usc")))
    low = F.concat(F.lower("p_name"), F.lit(" "), given, F.lit(" of the usc"))
    shown = F.when(F.array_contains(F.array(*[F.lit(t) for t, s in zip(_TITLES, _SHOWN, strict=True) if s is None]), given), low).otherwise(raised)
    return table(spark, sf_dir, "part").select("p_partkey", text.title_case(shown).alias("title"))


@CATALOG.add("""
SELECT doc_id, '---' || chr(10) || 'identifier: "/us/usc/t' || doc_id || '"' || chr(10) || 'title: "' || replace(source, '"', '\\"') || '"' || CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'positive_law: true' ELSE '' END || chr(10) || '---' AS block,
  source AS title_back FROM documents""")
def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = text.front_matter([
        ("identifier", text.yaml_quoted(F.concat(F.lit("/us/usc/t"), F.col("doc_id").cast("string")))),
        ("title", text.yaml_quoted(F.col("source"))),
        ("positive_law", F.when(F.col("doc_id") % 2 == 0, F.lit("true"))),
    ])
    docs = table(spark, sf_dir, "documents").select("doc_id", block.alias("block"))
    return docs.withColumn("title_back", text.front_matter_field(text.front_matter_block(F.col("block")), "title"))


@CATALOG.add("SELECT month(o_orderdate)::BIGINT AS month, strftime(min(o_orderdate), '%B') AS name, count(*) AS n FROM orders GROUP BY 1")
def month_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.month("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy(month.cast("long").alias("month"), dates.month_name(month).alias("name")).agg(F.count("*").alias("n"))
