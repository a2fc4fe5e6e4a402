"""Paths, front matter, metadata and emphasis of the three sources, on documents made of the standard tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registra.functions import metadata, paths
from registra.operators import bundles, search, sections, selection
from registra.plans.common import Catalog, table
from registra.plans.convert import _composed
from registra.plans.search import _HITS
from registra.sources import xml

CATALOG = Catalog()
_LINK = "array<struct<level_type:string,identifier:string,number:string,heading:string>>"


def _above(*levels: tuple[str, str, str, str]) -> Column:
    """Ancestors from (condition, level, number, heading) in SQL."""
    made = [F.expr(f"if({when}, named_struct('level_type', '{level}', 'identifier', cast(null as string), 'number', {number}, 'heading', {head}), null)") for when, level, number, head in levels]
    return F.array_compact(F.array(*made)).cast(_LINK)


_STATUTE = [
    ("p_partkey % 5 <> 0", "title", "cast(p_size as string)", "p_brand"),
    ("p_partkey % 7 = 0", "appendix", "concat(p_size, 'a')", "p_type"),
    ("p_partkey % 3 = 0", "chapter", "cast(p_partkey % 40 as string)", "p_type"),
    ("p_partkey % 3 = 1", "compiledAct", "cast(null as string)", "p_name"),
]


@CATALOG.add("""
WITH u AS (SELECT *, CASE WHEN p_partkey % 11 = 0 THEN p_size || 'A' END AS doc_number FROM part),
f AS (SELECT p_partkey, p_size, CASE WHEN doc_number IS NOT NULL OR p_partkey % 7 = 0 THEN 'title-' || lpad(p_size::VARCHAR, 2, '0') || '-appendix' WHEN p_partkey % 5 <> 0 THEN 'title-' || lpad(p_size::VARCHAR, 2, '0') ELSE 'title-00' END AS title,
  CASE p_partkey % 3 WHEN 0 THEN '/chapter-' || lpad((p_partkey % 40)::VARCHAR, 2, '0') WHEN 1 THEN '/' || regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') ELSE '' END AS chapter FROM u)
SELECT 'usc' AS source, p_partkey AS key, 'out/usc/' || title || chapter || '/section-' || p_partkey || CASE WHEN p_partkey % 4 = 0 THEN '-2' ELSE '' END || '.md' AS path FROM f
UNION ALL SELECT 'ecfr', s_suppkey, 'out/ecfr/' || CASE s_suppkey % 5
  WHEN 0 THEN 'title-' || lpad(s_nationkey::VARCHAR, 2, '0') || '.md'
  WHEN 1 THEN 'title-' || lpad(s_nationkey::VARCHAR, 2, '0') || '/chapter-IV.md'
  WHEN 2 THEN 'title-' || lpad(s_nationkey::VARCHAR, 2, '0') || '/chapter-I/part-' || s_suppkey || '.md'
  WHEN 3 THEN 'title-' || lpad(s_nationkey::VARCHAR, 2, '0') || '/chapter-I/part-9/appendix-a-to-' || s_suppkey || '.md'
  ELSE 'title-' || lpad(s_nationkey::VARCHAR, 2, '0') || '/chapter-I/part-9/section-9.' || s_suppkey || '.md' END FROM supplier
UNION ALL SELECT 'fr', o_orderkey, 'out/fr/' || strftime(o_orderdate, '%Y/%m') || '/1998-' || o_orderkey || '.md' FROM orders""")
def document_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    statutes = table(spark, sf_dir, "part").select(
        F.lit("usc").alias("source"), F.col("p_partkey").alias("key"),
        paths.code_path("out", _above(*_STATUTE), F.col("p_partkey").cast("string"), F.expr("if(p_partkey % 4 = 0, '-2', '')"), F.expr("if(p_partkey % 11 = 0, concat(p_size, 'A'), null)")).alias("path"),
    )
    level = F.expr("element_at(array('title', 'chapter', 'part', 'appendix', 'section'), cast(s_suppkey % 5 as int) + 1)")
    number = F.expr("CASE s_suppkey % 5 WHEN 0 THEN cast(s_nationkey as string) WHEN 1 THEN 'IV' WHEN 2 THEN cast(s_suppkey as string) WHEN 3 THEN null ELSE concat('9.', s_suppkey) END")
    above = _above(("s_suppkey % 5 > 0", "title", "cast(s_nationkey as string)", "'T'"), ("s_suppkey % 5 > 1", "chapter", "'I'", "'C'"), ("s_suppkey % 5 > 2", "part", "'9'", "'P'"))
    rules = table(spark, sf_dir, "supplier").select(F.lit("ecfr"), "s_suppkey", paths.regulation_path("out", level, above, number, F.expr("concat('Appendix A to ', s_suppkey)")))
    register = table(spark, sf_dir, "orders").select(F.lit("fr"), "o_orderkey", paths.register_path("out", F.expr("concat('1998-', o_orderkey)"), F.date_format("o_orderdate", "yyyy-MM-dd")))
    return statutes.union(rules).union(register)


def _line(name: str, value: str) -> str:
    return f"coalesce(chr(10) || '{name}: ' || {value}, '')"


def _quoted(value: str) -> str:
    return f"'\"' || {value} || '\"'"


@CATALOG.add(f"""
SELECT p_partkey, '---' || chr(10) || 'identifier: "/us/usc/t' || p_size || '/s' || p_partkey || '"' || chr(10) || 'source: "usc"' || chr(10) || 'legal_status: "' || CASE WHEN p_size % 2 = 0 THEN 'official_legal_evidence' ELSE 'official_prima_facie' END || '"'
  || {_line("title", _quoted("p_size || ' USC § ' || p_partkey || ' - ' || p_name"))} || {_line("title_number", "p_size")} || {_line("title_name", _quoted("p_brand"))} || {_line("section_number", _quoted("p_partkey"))} || {_line("section_name", _quoted("p_name"))}
  || {_line("chapter_number", "CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 40 END")} || {_line("chapter_name", _quoted("CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 1 THEN p_name END"))}
  || {_line("positive_law", "(p_size % 2 = 0)::VARCHAR")} || {_line("currency", _quoted("'119-' || p_size"))} || {_line("last_updated", _quoted("'2025-12-03'"))} || {_line("format_version", _quoted("'1.1.0'"))} || {_line("generator", _quoted("'registra'"))}
  || {_line("source_credit", _quoted("CASE WHEN p_partkey % 4 = 0 THEN '(Pub. L. ' || chr(92) || '\"1' || chr(92) || '\".)' END"))} || {_line("status", _quoted("CASE WHEN p_partkey % 9 = 0 THEN 'repealed' END"))} || chr(10) || '---' AS block FROM part""")
def front_matter_usc(spark: SparkSession, sf_dir: str) -> DataFrame:
    above = _above(("true", "title", "cast(p_size as string)", "concat(' ', p_brand)"), *_STATUTE[2:])
    meta = {"doc_number": F.lit(None).cast("string"), "dc_title": F.lit("unused"), "publication_name": F.expr("concat('Online@119-', p_size, 'not60')"), "created": F.lit("2025-12-03T10:00:00"), "positive_law": F.expr("p_size % 2 = 0")}
    fields = metadata.code_fields(F.col("p_partkey").cast("string"), F.col("p_name"), above, F.lit(None).cast("string"), F.expr("if(p_partkey % 9 = 0, 'repealed', null)"), F.expr("if(p_partkey % 4 = 0, '(Pub. L. \"1\".)', '')"), meta)
    return table(spark, sf_dir, "part").select("p_partkey", metadata.block(fields).alias("block"))


@CATALOG.add(f"""
WITH s AS (SELECT *, CASE s_suppkey % 3 WHEN 0 THEN 'title' WHEN 1 THEN 'part' ELSE 'section' END AS level FROM supplier)
SELECT s_suppkey, '---' || chr(10) || 'identifier: "/us/cfr/t' || s_nationkey || '/s' || CASE level WHEN 'title' THEN s_nationkey::VARCHAR ELSE '1.' || s_suppkey END || '"' || chr(10) || 'source: "ecfr"' || chr(10) || 'legal_status: "authoritative_unofficial"'
  || {_line("title", _quoted("CASE level WHEN 'title' THEN 'Title ' || s_nationkey || ' — ' || s_name WHEN 'part' THEN s_nationkey || ' CFR Part 1.' || s_suppkey || ' - ' || s_name ELSE s_nationkey || ' CFR § 1.' || s_suppkey || ' - ' || s_name END"))}
  || {_line("title_number", "s_nationkey")} || {_line("title_name", _quoted("CASE level WHEN 'title' THEN s_name ELSE 'Trade' END"))} || {_line("section_number", _quoted("CASE WHEN level <> 'title' THEN '1.' || s_suppkey END"))} || {_line("section_name", _quoted("CASE WHEN level <> 'title' THEN s_name END"))}
  || {_line("chapter_name", _quoted("CASE WHEN level <> 'title' THEN 'Commission' END"))} || {_line("part_number", _quoted("CASE level WHEN 'section' THEN '1' WHEN 'part' THEN '1.' || s_suppkey END"))} || {_line("part_name", _quoted("CASE level WHEN 'section' THEN 'Supply' WHEN 'part' THEN s_name END"))}
  || chr(10) || 'positive_law: false' || {_line("currency", _quoted("'2026-01-02'"))} || {_line("last_updated", _quoted("'2026-01-02'"))} || {_line("format_version", _quoted("'1.1.0'"))} || {_line("generator", _quoted("'registra'"))}
  || {_line("authority", _quoted("CASE WHEN s_suppkey % 2 = 0 THEN '15 U.S.C. 78a' END"))} || {_line("cfr_part", _quoted("CASE level WHEN 'section' THEN '1' WHEN 'part' THEN '1.' || s_suppkey END"))} || chr(10) || '---' AS block FROM s""")
def front_matter_ecfr(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.expr("element_at(array('title', 'part', 'section'), cast(s_suppkey % 3 as int) + 1)")
    number = F.expr("if(s_suppkey % 3 = 0, cast(s_nationkey as string), concat('1.', s_suppkey))")
    above = _above(("s_suppkey % 3 > 0", "title", "cast(s_nationkey as string)", "'Trade'"), ("s_suppkey % 3 > 0", "chapter", "'II'", "'Commission'"), ("s_suppkey % 3 = 2", "part", "'1'", "' Supply'"))
    none, date = F.lit(None).cast("string"), F.lit("2026-01-02")
    fields = metadata.regulation_fields(level, number, F.col("s_name"), above, none, none, none, F.expr("if(s_suppkey % 2 = 0, '15 U.S.C. 78a', '')"), none, date)
    return table(spark, sf_dir, "supplier").select("s_suppkey", metadata.block(fields).alias("block"))


@CATALOG.add(f"""
WITH o AS (SELECT *, '1998-' || o_orderkey AS n, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderkey % 2 = 0 AS j FROM orders)
SELECT o_orderkey, '---' || chr(10) || 'identifier: "/us/fr/' || n || '"' || chr(10) || 'source: "fr"' || chr(10) || 'legal_status: "authoritative_unofficial"' || {_line("title", _quoted("CASE WHEN j THEN o_orderpriority ELSE 'Order' END"))} || chr(10) || 'title_number: 0' || chr(10) || 'title_name: "Federal Register"'
  || {_line("section_number", _quoted("n"))} || {_line("section_name", _quoted("CASE WHEN j THEN o_orderpriority ELSE 'Order' END"))} || chr(10) || 'positive_law: false' || {_line("currency", _quoted("d"))} || {_line("last_updated", _quoted("d"))} || {_line("format_version", _quoted("'1.1.0'"))} || {_line("generator", _quoted("'registra'"))}
  || {_line("agency", _quoted("CASE WHEN j THEN 'Agency ' || o_orderstatus ELSE 'Markup' END"))} || {_line("document_number", _quoted("n"))} || {_line("document_type", _quoted("CASE WHEN j THEN 'rule' ELSE 'notice' END"))} || {_line("fr_volume", "CASE WHEN j THEN 63 END")} || {_line("publication_date", _quoted("d"))}
  || chr(10) || 'agencies:' || CASE WHEN j THEN chr(10) || '  - "Agency ' || o_orderstatus || '"' || chr(10) || '  - "Two"' ELSE chr(10) || '  - "Markup"' || chr(10) || '  - "Sub"' END
  || coalesce(chr(10) || 'cfr_references:' || chr(10) || '  - "' || CASE WHEN NOT j THEN '40 CFR Part 52' END || '"', '') || {_line("rin", _quoted("CASE WHEN j THEN '2060-A' ELSE '1-B' END"))} || {_line("effective_date", _quoted("CASE WHEN j THEN d END"))} || chr(10) || '---' AS block FROM o""")
def front_matter_fr(spark: SparkSession, sf_dir: str) -> DataFrame:
    number, date = F.expr("concat('1998-', o_orderkey)"), F.date_format("o_orderdate", "yyyy-MM-dd")
    markup = {"document_number": number, "subject": F.lit("Order"), "publication_date": date, "document_type": F.lit("notice"), "agency": F.lit("Markup"), "sub_agency": F.lit("Sub"), "cfr": F.expr("if(o_orderkey % 2 = 0, '', '40 CFR Part 52')"), "rin": F.lit("1-B")}
    sidecar = F.col("o_orderkey") % 2 == 0
    given = {"title": F.col("o_orderpriority"), "document_type": F.lit("rule"), "agencies": F.array(F.concat(F.lit("Agency "), "o_orderstatus"), F.lit("Two")), "docket_ids": F.array().cast("array<string>"), "volume": F.lit(63), "rin": F.lit("2060-A"), "effective_on": date}
    fields = metadata.register_fields(markup, {n: F.when(sidecar, c) for n, c in given.items()})
    return table(spark, sf_dir, "orders").select("o_orderkey", metadata.block(fields).alias("block"))


@CATALOG.add("""
SELECT c_custkey, '{"identifier":"/x/' || c_custkey || '","source":"' || CASE c_custkey % 3 WHEN 0 THEN 'usc' WHEN 1 THEN 'ecfr' ELSE 'fr' END || '","title_number":' || c_nationkey || ',"positive_law":' || (c_custkey % 2 = 1)::VARCHAR
  || CASE c_custkey % 3 WHEN 0 THEN ',"source_credit":"' || c_mktsegment || '"' WHEN 1 THEN ',"agency":"' || c_name || '"' ELSE ',"agency":"' || c_name || '"' || CASE WHEN c_custkey % 4 > 0 THEN ',"agencies":["a","' || c_mktsegment || '"]' ELSE '' END END || '}' AS metadata FROM customer""")
def source_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr("concat('/x/', c_custkey)").alias("identifier"), F.expr("element_at(array('usc', 'ecfr', 'fr'), cast(c_custkey % 3 as int) + 1)").alias("source"),
        F.col("c_nationkey").alias("title_number"), (F.col("c_custkey") % 2).alias("positive_law"), F.col("c_mktsegment").alias("source_credit"), F.col("c_name").alias("agency"),
        F.expr("if(c_custkey % 4 > 0, concat('[\"a\",\"', c_mktsegment, '\"]'), '[broken')").alias("agencies"),
    )
    return docs.select("c_custkey", metadata.source_metadata(docs.columns).alias("metadata"))


@CATALOG.add("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 'usc' WHEN l_linenumber = 2 THEN 'ecfr' WHEN l_linenumber = 3 THEN 'fr' END AS source,
  CASE l_linenumber WHEN 1 THEN '/us/usc/t' || l_suppkey || '/s' || l_partkey WHEN 2 THEN '/us/cfr/t' || l_suppkey WHEN 3 THEN '1998-' || l_partkey END AS identifier FROM lineitem""")
def resource_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.expr("""CASE l_linenumber WHEN 1 THEN concat('law://us/usc/t', l_suppkey, '/s', l_partkey) WHEN 2 THEN concat('law://us/cfr/t', l_suppkey)
      WHEN 3 THEN concat('law://us/fr/1998-', l_partkey) WHEN 4 THEN 'law://us/fr/' WHEN 5 THEN concat('law://us/stat/', l_partkey) ELSE concat('http://us/usc/t', l_suppkey) END""")
    parsed = metadata.parse_resource(uri, "law").alias("r")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", parsed).select("l_orderkey", "l_linenumber", "r.*")


@CATALOG.add("""
SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN '/docs?title=5+a%26b&sort=-date&limit=20&offset=' || (p_partkey + 20) END AS by_offset,
  CASE WHEN p_partkey % 3 > 0 AND p_partkey % 2 = 0 THEN '/docs?title=5+a%26b&sort=-date&limit=20&cursor=' || replace(p_name, ' ', '+') END AS by_cursor FROM part""")
def next_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = {"title": "5 a&b", "offset": 3, "status": None, "cursor": "x", "sort": "-date"}
    more, cursor = F.col("p_partkey") % 3 > 0, F.when(F.col("p_partkey") % 2 == 0, F.col("p_name"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", metadata.next_link("/docs", params, more, 20, F.col("p_partkey")).alias("by_offset"), metadata.next_link("/docs", params, more, 20, F.lit(0), cursor).alias("by_cursor")
    )


_CODES = ["01", "02", "03", "04", "05", "51", "52", "54", "7462", "99"]
_CODED = "CASE k % 10 WHEN 0 THEN '**x**' WHEN 2 THEN {03} WHEN 5 THEN '<sub>x</sub>' WHEN 6 THEN '<sub>x</sub>' WHEN 7 THEN '<sub>x</sub>' ELSE '*x*' END"


@CATALOG.add(f"""
WITH s AS (SELECT *, s_suppkey AS k FROM supplier), o AS (SELECT *, o_orderkey AS k FROM orders)
SELECT '/us/cfr/t' || s_nationkey || '/s1.' || k AS identifier, 'See ' || {_CODED.replace("{03}", "'**x**'")} || ' **b** *i* <sup>1</sup> here.' || chr(10) || chr(10) || 'Form ____' AS markdown FROM s
UNION ALL SELECT '/us/fr/1998-' || k, '**Order ' || k || '**' || chr(10) || chr(10) || 'See ' || {_CODED.replace("{03}", "'*x*'")} || ' **b** here.' FROM o""")
def emphasis_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = lambda key: f"element_at(array({', '.join(repr(c) for c in _CODES)}), cast({key} % 10 as int) + 1)"
    section = f"""concat('<DIV8 N="1.', s_suppkey, '" TYPE="SECTION"><HEAD>§ 1.', s_suppkey, ' ', s_name, '</HEAD><FRP>See <E T="', {code('s_suppkey')}, '">x</E> <B>b</B> <I>i</I> <SU>1</SU> here.</FRP><FP-DASH>Form ____</FP-DASH></DIV8>')"""
    head = """concat('<ECFR><DIV1 N="2" NODE="', s_nationkey, ':2" TYPE="TITLE"><HEAD>Title ', s_nationkey, '—Trade</HEAD>')"""
    rules = _composed(table(spark, sf_dir, "supplier"), F.expr("concat(s_nationkey, '-', s_suppkey div 1000)"), "s_suppkey", F.expr(section), F.expr(head), "</DIV1></ECFR>")
    piece = f"""concat('<NOTICE><PREAMB><SUBJECT>Order ', o_orderkey, '</SUBJECT></PREAMB><P>See <E T="', {code('o_orderkey')}, '">x</E> <B>b</B> here.</P><FRDOC>[FR Doc. 1998-', o_orderkey, ' Filed 1-2-98]</FRDOC></NOTICE>')"""
    issues = _composed(table(spark, sf_dir, "orders"), F.expr("concat('issue-', o_orderkey div 200)"), "o_orderkey", F.expr(piece), F.lit("<FEDREG>"), "</FEDREG>")
    both = [sections.regulation_documents(sections.scan(rules, "doc", "xml", sections.ECFR)), sections.register_documents(sections.scan(issues, "doc", "xml", sections.FR))]
    return both[0].select("identifier", "markdown").unionByName(both[1].select("identifier", "markdown"))


@CATALOG.add("""
SELECT n_name AS doc, 'Title ' || n_nationkey AS dc_title, n_nationkey || 'a' AS doc_number, 'Online@119-' || n_regionkey AS publication_name, n_nationkey % 2 = 0 AS positive_law, '2025-01-02' AS created FROM nation""")
def document_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = """concat('<uscDoc xmlns="http://xml.house.gov/schemas/uslm/1.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:dcterms="http://purl.org/dc/terms/"><meta><dc:title> Title ', n_nationkey, ' </dc:title><docNumber>', n_nationkey, 'a</docNumber><docPublicationName>Online@119-', n_regionkey,
      '</docPublicationName><property role="other">no</property><property role="is-positive-law">', if(n_nationkey % 2 = 0, 'Yes', 'no'), '</property><dcterms:created>2025-01-02</dcterms:created></meta><main><title><dc:title>not this</dc:title></title></main></uscDoc>')"""
    docs = table(spark, sf_dir, "nation").select("n_name", F.expr(doc).alias("xml"))
    return sections.document_meta(xml.events(docs, "n_name", "xml")).select("doc", "dc_title", "doc_number", "publication_name", "positive_law", "created")


def _statutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_size").cast("long").alias("title_number"), F.expr("if(p_partkey % 3 = 2, null, concat('/us/usc/t', p_size, '/ch', p_partkey % 3 + 1))").alias("chapter_identifier"),
        (F.col("p_partkey") % 3 + 1).alias("chapter_number"), F.expr("concat('Chapter of ', p_partkey % 3)").alias("chapter_name"), F.expr("concat('chapter-0', p_partkey % 3 + 1)").alias("directory"),
        F.col("p_partkey").alias("ord"), F.expr("concat('/us/usc/t', p_size, '/s', p_partkey)").alias("identifier"), F.col("p_partkey").cast("string").alias("number"), F.col("p_name").alias("name"),
        F.expr("concat('section-', p_partkey, '.md')").alias("file"), F.length("p_type").cast("long").alias("token_estimate"), (F.col("p_partkey") % 2 == 0).alias("has_notes"), F.lit("current").alias("status"), F.col("p_type").alias("markdown"),
    )


_ENTRY = """'{"identifier":"/us/usc/t' || p_size || '/s' || p_partkey || '","number":"' || p_partkey || '","name":"' || p_name || '","file":"section-' || p_partkey || '.md","token_estimate":' || length(p_type) || ',"has_notes":' || (p_partkey % 2 = 0)::VARCHAR || ',"status":"current"}'"""
_CHAPTERS = f"""
WITH c AS (SELECT p_size, p_partkey % 3 AS m, min(p_partkey) AS first, string_agg({_ENTRY}, ',' ORDER BY p_partkey) AS entries, count(*) AS n, string_agg('## § ' || p_partkey || '. ' || p_name || chr(10) || chr(10) || p_type, chr(10) || chr(10) ORDER BY p_partkey) AS body
  FROM part WHERE p_partkey % 3 < 2 GROUP BY 1, 2)"""


@CATALOG.add(f"""{_CHAPTERS}
SELECT p_size::BIGINT AS title_number, 'chapter-0' || (m + 1) AS directory, '{{"format_version":"1.1.0","identifier":"/us/usc/t' || p_size || '/ch' || (m + 1) || '","chapter_number":' || (m + 1) || ',"chapter_name":"Chapter of ' || m || '","title_number":' || p_size || ',"section_count":' || n || ',"sections":[' || entries || ']}}' AS json FROM c""")
def chapter_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.chapter_meta(bundles.chapter_entries(_statutes(spark, sf_dir)))


@CATALOG.add(f"""{_CHAPTERS},
l AS (SELECT p_size, count(*) AS chapters, string_agg('{{"identifier":"/us/usc/t' || p_size || '/ch' || (m + 1) || '","number":' || (m + 1) || ',"name":"Chapter of ' || m || '","directory":"chapter-0' || (m + 1) || '","sections":[' || entries || ']}}', ',' ORDER BY first) AS listed,
  string_agg('### Chapter ' || (m + 1) || ' — Chapter of ' || m || chr(10) || chr(10) || n || CASE WHEN n = 1 THEN ' section' ELSE ' sections' END || ' · [chapter-0' || (m + 1) || '/](chapter-0' || (m + 1) || '/)' || chr(10), chr(10) ORDER BY first) AS parts FROM c GROUP BY 1),
t AS (SELECT p_size, count(*) AS n, sum(length(p_type))::BIGINT AS tokens FROM part GROUP BY 1)
SELECT p_size::BIGINT AS title_number,
  '{{"format_version":"1.1.0","generator":"registra","generated_at":"2026-01-02","identifier":"/us/usc/t' || p_size || '","title_number":' || p_size || ',"title_name":"Size ' || p_size || '","positive_law":' || (p_size % 2 = 0)::VARCHAR || ',"currency":"119-73","release_point":"119-73not60","source_xml":"usc.xml","granularity":"section","stats":{{"chapter_count":' || coalesce(chapters, 0) || ',"section_count":' || n || ',"total_files":' || n || ',"total_tokens_estimate":' || tokens || '}},"chapters":[' || coalesce(listed, '') || ']}}' AS json,
  '# Title ' || p_size || ' — Size ' || p_size || chr(10) || chr(10) || '| | |' || chr(10) || '| --- | --- |' || chr(10) || '| **Positive Law** | ' || CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END || ' |' || chr(10) || '| **Currency** | 119-73 |' || chr(10) || '| **Chapters** | ' || coalesce(chapters, 0) || ' |' || chr(10)
  || '| **Sections** | ' || format('{{:,}}', n) || ' |' || chr(10) || '| **Est. Tokens** | ' || format('{{:,}}', tokens) || ' |' || chr(10) || '| **Granularity** | section |' || chr(10) || chr(10) || '## Chapters' || chr(10) || chr(10) || coalesce(parts || chr(10), '') || '---' || chr(10) || chr(10) || 'Generated by registra' || chr(10) AS readme
FROM t LEFT JOIN l USING (p_size)""")
def title_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _statutes(spark, sf_dir)
    titles = docs.select("title_number").distinct().select(
        "title_number", F.expr("concat('/us/usc/t', title_number)").alias("identifier"), F.expr("concat('Size ', title_number)").alias("title_name"), (F.col("title_number") % 2 == 0).alias("positive_law"),
        F.lit("119-73").alias("currency"), F.lit("119-73not60").alias("release_point"), F.lit("usc.xml").alias("source_xml"), F.lit("2026-01-02").alias("generated_at"),
    )
    return bundles.title_meta(docs, bundles.chapter_entries(docs), titles)


@CATALOG.add(f"""{_CHAPTERS}
SELECT '/us/usc/t' || p_size || '/ch' || (m + 1) AS chapter_identifier, '# Chapter ' || (m + 1) || ' — Chapter of ' || m || chr(10) || chr(10) || body AS markdown FROM c""")
def chapter_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.chapter_texts(_statutes(spark, sf_dir)).select("chapter_identifier", "markdown")


def _regulations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_size").cast("long").alias("title_number"), F.expr("if(p_partkey % 7 = 3, '', concat('/us/cfr/t', p_size, '/p', p_partkey % 7))").alias("part_identifier"),
        F.expr("cast(p_partkey % 7 as string)").alias("part_number"), F.col("p_brand").alias("part_name"), F.length("p_type").cast("long").alias("content_length"), F.col("p_partkey").alias("ord"),
        F.expr("concat('/us/cfr/t', p_size, '/s', p_partkey)").alias("identifier"), F.col("p_partkey").cast("string").alias("number"), F.col("p_name").alias("name"),
        F.expr("concat('section-', p_partkey, '.md')").alias("file"), (F.col("p_partkey") % 2 == 0).alias("has_notes"), F.lit("current").alias("status"),
    )


_RULE = """'{"identifier":"/us/cfr/t' || p_size || '/s' || p_partkey || '","number":"' || p_partkey || '","name":"' || p_name || '","file":"section-' || p_partkey || '.md","token_estimate":' || ((length(p_type) + 3) // 4) || ',"has_notes":' || (p_partkey % 2 = 0)::VARCHAR || ',"status":"current"}'"""
_PARTS = f"""
WITH p AS (SELECT p_size, p_partkey % 7 AS m, '/us/cfr/t' || p_size || CASE WHEN p_partkey % 7 = 3 THEN '/pt' ELSE '/p' END || p_partkey % 7 AS id, min(p_partkey) AS first, arg_min(p_brand, p_partkey) AS name,
  string_agg({_RULE}, ',' ORDER BY p_partkey) AS entries, count(*) AS n, sum(length(p_type)) AS chars FROM part GROUP BY 1, 2, 3)"""


@CATALOG.add(f"""{_PARTS}
SELECT p_size::BIGINT AS title_number, 'part-' || m AS directory, '{{"format_version":"1.1.0","identifier":"' || id || '","part_number":"' || m || '","part_name":"' || name || '","title_number":' || p_size || ',"section_count":' || n || ',"sections":[' || entries || ']}}' AS json FROM p""")
def part_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.part_meta(bundles.part_entries(_regulations(spark, sf_dir)))


@CATALOG.add(f"""{_PARTS},
t AS (SELECT p_size, count(*) AS k, sum(n)::BIGINT AS n, ((sum(chars) + 3) // 4)::BIGINT AS tokens,
  string_agg('{{"identifier":"' || id || '","number":"' || m || '","name":"' || name || '","directory":"part-' || m || '","sections":[' || entries || ']}}', ',' ORDER BY first) AS listed,
  string_agg('### Part ' || m || ' — ' || name || ' (' || n || ' sections)' || chr(10) || chr(10), '' ORDER BY first) AS heads FROM p GROUP BY 1)
SELECT p_size::BIGINT AS title_number,
  '{{"format_version":"1.1.0","generator":"registra","generated_at":"2026-01-02","identifier":"/us/cfr/t' || p_size || '","title_number":' || p_size || ',"title_name":"Size ' || p_size || '","source":"ecfr","legal_status":"authoritative_unofficial","currency":"2026-01-01","source_xml":"ecfr.xml","granularity":"section","stats":{{"part_count":' || k || ',"section_count":' || n || ',"total_files":' || n || ',"total_tokens_estimate":' || tokens || '}},"parts":[' || listed || ']}}' AS json,
  '# Title ' || p_size || ' — Size ' || p_size || chr(10) || chr(10) || '| Metric | Value |' || chr(10) || '|--------|-------|' || chr(10) || '| Source | eCFR (govinfo.gov) |' || chr(10) || '| Legal Status | Authoritative, unofficial |' || chr(10)
  || '| Parts | ' || format('{{:,}}', k) || ' |' || chr(10) || '| Sections | ' || format('{{:,}}', n) || ' |' || chr(10) || '| Estimated Tokens | ' || format('{{:,}}', tokens) || ' |' || chr(10) || '| Granularity | section |' || chr(10) || chr(10)
  || '## Parts' || chr(10) || chr(10) || heads || '---' || chr(10) || chr(10) || 'Generated by registra' || chr(10) AS readme FROM t""")
def regulation_title_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = _regulations(spark, sf_dir)
    titles = rules.select("title_number").distinct().select(
        "title_number", F.expr("concat('Size ', title_number)").alias("title_name"), F.lit("2026-01-01").alias("currency"), F.lit("ecfr.xml").alias("source_xml"), F.lit("2026-01-02").alias("generated_at"),
    )
    return bundles.regulation_title_meta(bundles.part_entries(rules), titles)


_FILTERED = _HITS.replace("FROM documents", "FROM (SELECT * FROM documents WHERE lang = 'en' AND doc_id % 31 >= 10 AND doc_id % 31 <= 20)")


@CATALOG.add(_FILTERED.replace("attribute, exact DESC", "attribute, doc_id % 31 DESC, exact DESC") + " SELECT item_id, doc_id, rank FROM r WHERE rank <= 10")
def search_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.expr("concat('2026-01-', lpad(doc_id % 31 + 1, 2, '0'))")
    docs = table(spark, sf_dir, "documents").withColumn("publication_date", day).withColumn("status", F.col("lang"))
    picked = search.filtered(docs, status='e"n\\', date_from="2026-01-11", date_to="2026-01-21")
    hits = search.ranked(picked, "doc_id", ["source", "text"], table(spark, sf_dir, "benchmark"), "item_id", "text", 10, "-publication_date")
    return hits.select("item_id", "doc_id", "rank")


@CATALOG.add("""
SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND (o_orderkey % 3 = 0 OR (strftime(o_orderdate, '%Y-%m-%d') BETWEEN '1995-03-10' AND '1996-02-20'))
  AND (o_orderkey % 5 = 0 OR strftime(o_orderdate, '%Y-%m') BETWEEN '1995-03' AND '1996-02')""")
def register_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.expr("if(o_orderkey % 5 = 0, 'downloads/x.xml', concat('downloads/', date_format(o_orderdate, 'yyyy/MM'), '/x.xml'))")
    docs = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("document_type"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("publication_date"), (F.col("o_orderkey") % 3 > 0).alias("has_sidecar"), path.alias("path"))
    months = docs.where(selection.in_months(F.col("path"), "1995-03-10", "1996-02-20"))
    return selection.register_selected(months, ["F", "P"], "1995-03-10", "1996-02-20").select("o_orderkey")


@CATALOG.add("""
WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN '2026-01-' || lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0') END AS own, c_custkey % 3 = 0 AS busy FROM customer)
SELECT c_custkey AS title_number, CASE WHEN busy AND own IS NOT NULL THEN own ELSE least(own, '2026-01-14') END AS date FROM t""")
def title_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.expr("if(c_custkey % 4 > 0, concat('2026-01-', lpad(c_custkey % 28 + 1, 2, '0')), null)")
    titles = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("title_number"), own.alias("up_to_date_as_of"), (F.col("c_custkey") % 3 == 0).alias("processing"))
    return selection.title_dates(titles, "2026-01-15", importing=True)


@CATALOG.add("""
SELECT p_partkey % 7 AS chapter, count(*) AS parts, sum(p_size)::BIGINT AS size, (SELECT count(*) FROM part WHERE p_partkey % 7 = 0) AS skipped FROM part WHERE p_partkey % 7 > 0 GROUP BY 1""")
def chapter_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumn("chapter", F.when(F.col("p_partkey") % 7 > 0, F.col("p_partkey") % 7))
    groups, skipped = selection.by_chapter(parts, "chapter", F.count("*").alias("parts"), F.sum("p_size").cast("long").alias("size"))
    return groups.join(F.broadcast(parts.agg(skipped.alias("skipped"))))  # one row


@CATALOG.add("""
WITH k AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_partkey / 2.0 END AS n FROM part)
SELECT p_partkey, row_number() OVER (PARTITION BY p_size ORDER BY n, p_partkey) AS place FROM k""")
def nav_part_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.expr("if(p_partkey % 5 = 0, 'Reserved', concat(p_partkey / 2, 'b'))")
    place = F.row_number().over(Window.partitionBy("p_size").orderBy(selection.number_key(number), "p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", place.cast("long").alias("place"))


@CATALOG.add("""
SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, CASE WHEN max(year(o_orderdate)) < 1995 THEN count(*) * 10 ELSE count(*) END AS n FROM orders GROUP BY 1, 2""")
def snapshot_or_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    return selection.snapshot_or_live(live.where("year < 1995").withColumn("n", F.col("n") * 10), live, ["year", "month"], "n")


@CATALOG.add("""
SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'title' WHEN 2 THEN 'section' WHEN 3 THEN 'document' WHEN 4 THEN 'year' END AS kind FROM lineitem""")
def route_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.expr("""CASE l_linenumber WHEN 1 THEN concat('title-', l_suppkey) WHEN 2 THEN concat('title-', l_suppkey, '/chapter-IV/section-', l_partkey, '.1') WHEN 5 THEN 'title-1/../section-2' WHEN 6 THEN 'title-1/chapter-1/section-1/x-1' ELSE 'titles-1' END""")
    register = F.expr("CASE l_linenumber WHEN 3 THEN concat('1998/02/1998-', l_partkey) WHEN 4 THEN '1998' ELSE '98/2' END")
    kind = F.when(F.col("l_linenumber").isin(3, 4, 7), selection.route("fr", register)).otherwise(selection.route("usc", code))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", kind.alias("kind"))
