"""XML conversion on documents that Spark composes from the standard tables, some hundred sections in each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.operators import sections
from registra.plans.common import Catalog, table
from registra.sources import xml

CATALOG = Catalog()
_USLM = 'xmlns="http://xml.house.gov/schemas/uslm/1.0"'


def _composed(rows: DataFrame, doc: Column, order: str, piece: Column, before: Column, after: str) -> DataFrame:
    """(doc, xml): the pieces of each document in order between its beginning and its end."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("x"))))
    grouped = rows.groupBy(doc.alias("doc")).agg(F.min(before).alias("head"), F.array_join(F.transform(parts, lambda p: p["x"]), "").alias("body"))
    return grouped.select("doc", F.concat("head", "body", F.lit(after)).alias("xml"))


def _code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, xml) of statutes."""
    brand = "regexp_extract(p_brand, '([0-9]+)$', 1)"
    section = f"""concat('<section identifier="/us/usc/t', {brand}, '/s', p_partkey, '"', if(p_partkey % 9 = 0, ' status="repealed"', ''), '><num value="', p_partkey, '">§ ', p_partkey, '.</num><heading>', p_name,
      '</heading><content>Size <b>', p_size, '</b>  is | set.</content><subsection><num>(a)</num><heading>Type</heading><content>', p_type, '</content></subsection>',
      if(p_partkey % 4 = 0, '<sourceCredit>(Pub. L. 1.)</sourceCredit>', ''),
      if(p_partkey % 3 = 0, '<notes><note role="crossHeading" topic="editorialNotes"><heading>Editorial Notes</heading></note><note topic="codification"><heading>Codification</heading><p>Moved.</p></note><note topic="amendments"><heading>Amendments</heading><p>Struck.</p></note></notes>', ''), '</section>')"""
    head = f"""concat('<uscDoc {_USLM}><meta><x>skipped</x></meta><main><title identifier="/us/usc/t', {brand}, '"><num value="', {brand}, '">Title ', {brand}, '—</num><heading>', p_brand, '</heading>')"""
    doc = F.expr("concat(p_brand, '-', p_partkey div 500)")
    return _composed(table(spark, sf_dir, "part"), doc, "p_partkey", F.expr(section), F.expr(head), "</title></main></uscDoc>")


def _code_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.scan(_code(spark, sf_dir), "doc", "xml", sections.USLM)


_CODE = """
WITH p AS (SELECT *, regexp_extract(p_brand, '([0-9]+)$', 1) AS b FROM part)
SELECT '/us/usc/t' || b || '/s' || p_partkey AS identifier, p_partkey::VARCHAR AS number, p_name AS heading, CASE WHEN p_partkey % 9 = 0 THEN 'repealed' END AS status,
  b || ' USC § ' || p_partkey || ' - ' || p_name AS display_title, 'title ' || b || ' ' || p_brand AS ancestors, CASE WHEN p_partkey % 4 = 0 THEN '(Pub. L. 1.)' END AS source_credit,
  'Size **' || p_size || '** is | set.' || chr(10) || chr(10) || '**(a)** **Type** ' || p_type || CASE WHEN p_partkey % 4 = 0 THEN chr(10) || chr(10) || '---' || chr(10) || chr(10) || '**Source Credit**: (Pub. L. 1.)' ELSE '' END
  || CASE WHEN p_partkey % 3 = 0 THEN {notes} ELSE '' END AS markdown FROM p"""
_BREAK = "chr(10) || chr(10)"


def _shown(docs: DataFrame) -> DataFrame:
    levels = F.transform("ancestors", lambda a: F.concat_ws(" ", a["level_type"], a["number"], a["heading"]))
    return docs.withColumn("ancestors", F.array_join(levels, " > ")).select("identifier", "number", "heading", "status", "display_title", "ancestors", "source_credit", "markdown")


@CATALOG.add(_CODE.format(notes=f"{_BREAK} || '## Editorial Notes' || {_BREAK} || '### Codification' || {_BREAK} || 'Moved.' || {_BREAK} || '### Amendments' || {_BREAK} || 'Struck.'"))
def uslm_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(sections.code_documents(_code_rows(spark, sf_dir)))


@CATALOG.add(_CODE.format(notes=f"{_BREAK} || '## Editorial Notes' || {_BREAK} || '### Amendments' || {_BREAK} || 'Struck.'"))
def uslm_amendment_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(sections.code_documents(_code_rows(spark, sf_dir), notes=(False, False, True)))


@CATALOG.add("""
SELECT p_brand || '-' || (p_partkey // 500) AS doc, count(*) AS n_sections FROM part GROUP BY 1""")
def uslm_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = sections.documents(_code_rows(spark, sf_dir), sections.USLM, "title")
    marks = F.regexp_extract_all("markdown", F.lit(r"\*\*§ [0-9]+\.\*\*"), 0)
    return titles.select("doc", F.size(marks).cast("long").alias("n_sections"))


@CATALOG.add("""
WITH e AS (SELECT 'section' AS name, p_brand || '-' || (p_partkey // 500) AS doc FROM part UNION ALL SELECT 'subsection', p_brand || '-' || (p_partkey // 500) FROM part)
SELECT doc, name, count(*) AS opened FROM e GROUP BY ALL""")
def xml_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = xml.events(_code(spark, sf_dir), "doc", "xml").where("kind = 'open' and name in ('section', 'subsection')")
    return opened.groupBy("doc", "name").agg(F.count("*").alias("opened"))


@CATALOG.add("""
SELECT '/us/cfr/t' || s_nationkey || '/s1.' || s_suppkey AS identifier, '1.' || s_suppkey AS number, s_name AS heading, 'title ' || s_nationkey || ' Trade > part 1 Supply' AS ancestors,
  'See *' || s_acctbal::DECIMAL(18,2) || '* here.' || chr(10) || chr(10) || '| a | b |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || s_suppkey || ' | x\\|y |' || chr(10) || chr(10) || '[1 FR ' || s_suppkey || ']' AS markdown
FROM supplier""")
def ecfr_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    section = """concat('<DIV8 N="1.', s_suppkey, '" TYPE="SECTION"><HEAD>§ 1.', s_suppkey, ' ', s_name, '</HEAD><P>See <I>', cast(s_acctbal AS DECIMAL(18,2)), '</I> here.</P><TABLE><TR><TH>a</TH><TH>b</TH></TR><TR><TD>', s_suppkey, '</TD><TD>x|y</TD></TR></TABLE><CITA>[1 FR ', s_suppkey, ']</CITA></DIV8>')"""
    head = """concat('<ECFR><HEADER><X>skipped</X></HEADER><DIV1 N="', s_nationkey, '" TYPE="TITLE"><HEAD>Title ', s_nationkey, '—Trade</HEAD><DIV5 N="1" TYPE="PART"><HEAD>PART 1—Supply</HEAD>')"""
    doc = F.expr("concat(s_nationkey, '-', s_suppkey div 1000)")
    composed = _composed(table(spark, sf_dir, "supplier"), doc, "s_suppkey", F.expr(section), F.expr(head), "</DIV5></DIV1></ECFR>")
    docs = sections.regulation_documents(sections.scan(composed, "doc", "xml", sections.ECFR))
    levels = F.transform("ancestors", lambda a: F.concat_ws(" ", a["level_type"], a["number"], a["heading"]))
    return docs.withColumn("ancestors", F.array_join(levels, " > ")).select("identifier", "number", "heading", "ancestors", "markdown")


@CATALOG.add("""
SELECT '/us/fr/' || year(o_orderdate) || '-' || lpad(o_orderkey::VARCHAR, 5, '0') AS identifier, 'Order ' || o_orderkey AS subject, 'Agency ' || o_orderstatus AS agency,
  CASE WHEN o_orderstatus = 'P' THEN 'proposed_rule' ELSE 'notice' END AS document_type, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS publication_date,
  'Agency ' || o_orderstatus || chr(10) || chr(10) || '**Order ' || o_orderkey || '**' || chr(10) || chr(10) || '**Background**' || chr(10) || chr(10) || 'Priority ' || o_orderpriority || '<sup>1</sup>.' AS markdown
FROM orders""")
def fr_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = "if(o_orderstatus = 'P', 'PRORULE', 'NOTICE')"
    piece = f"""concat('<', {kind}, '><PREAMB><AGENCY>Agency ', o_orderstatus, '</AGENCY><SUBJECT>Order ', o_orderkey, '</SUBJECT></PREAMB><SUPLINF><HD SOURCE="HD1">Background</HD><P>Priority ', o_orderpriority, '<SU>1</SU>.</P></SUPLINF><FRDOC>[FR Doc. ',
      year(o_orderdate), '-', lpad(o_orderkey, 5, '0'), ' ', date_format(o_orderdate, "'Filed 'M-d-yy"), '; 8:45 am]</FRDOC></', {kind}, '>')"""
    doc = F.expr("concat('issue-', o_orderkey div 200)")
    composed = _composed(table(spark, sf_dir, "orders"), doc, "o_orderkey", F.expr(piece), F.lit("<FEDREG>"), "</FEDREG>")
    docs = sections.register_documents(sections.scan(composed, "doc", "xml", sections.FR))
    return docs.select("identifier", "subject", "agency", "document_type", "publication_date", "markdown")
