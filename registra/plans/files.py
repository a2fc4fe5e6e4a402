"""From scanned statutes to files: links inside text, whole files with front matter, and chapters as one text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.operators import convert, sections, split_scan
from registra.plans.common import Catalog, table
from registra.plans.convert import _USLM
from registra.shared import fresh_path
from registra.sources import files as sink

CATALOG = Catalog()


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, xml) of a title for each brand: chapters, of which all but the first have subchapters, and sections with references."""
    parts = table(spark, sf_dir, "part").withColumn("b", F.expr("regexp_extract(p_brand, '([0-9]+)$', 1)")).withColumn("ch", F.expr("p_size % 3 + 1")).withColumn("sub", F.expr("if(p_size % 3 = 0, '', if(p_partkey % 2 = 0, 'A', 'B'))"))
    section = F.expr("""concat('<section identifier="/us/usc/t', b, '/s', p_partkey, '"><num value="', p_partkey, '">§ ', p_partkey, '.</num><heading>', p_name, '</heading><content>See <ref href="/us/usc/t', b, '/s', p_partkey - 25, '">section <i>', p_partkey - 25, '</i></ref>, <ref href="/us/usc/t',
      b, '/s', p_partkey, '/a">here</ref> and <ref href="/us/pl/1/', p_size, '">a law</ref><ref class="footnoteRef" idref="f">', p_size, '</ref>; it says <quotedContent>size <b>', p_size, '</b></quotedContent>.</content><sourceCredit>(Pub. L. ', p_size, '.)</sourceCredit></section>')""")
    listed = lambda order: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col("x")))), lambda e: e["x"]), "")
    subs = parts.select("p_brand", "b", "ch", "sub", "p_partkey", section.alias("x")).groupBy("p_brand", "b", "ch", "sub").agg(listed("p_partkey").alias("x"))
    wrapped = F.expr("""if(sub = '', x, concat('<subchapter><num value="', sub, '">SUBCHAPTER ', sub, '—</num><heading>Sub ', sub, '</heading>', x, '</subchapter>'))""")
    chapters = subs.select("p_brand", "b", "ch", "sub", wrapped.alias("x")).groupBy("p_brand", "b", "ch").agg(listed("sub").alias("x"))
    whole = F.expr("""concat('<chapter identifier="/us/usc/t', b, '/ch', ch, '"><num value="', ch, '">CHAPTER ', ch, '—</num><heading>Part ', ch, '</heading><note><heading>Purpose</heading><p>All of ', ch, '.</p></note>', x, '</chapter>')""")
    titles = chapters.select("p_brand", "b", "ch", whole.alias("x")).groupBy("p_brand", "b").agg(listed("ch").alias("x"))
    return titles.select(F.col("p_brand").alias("doc"), F.expr(f"""concat('<uscDoc {_USLM}><main><title identifier="/us/usc/t', b, '"><num value="', b, '">Title ', b, '—</num><heading>', p_brand, '</heading>', x, '</title></main></uscDoc>')""").alias("xml"))


#: Section, its file, and what its first reference shows: a file of the same title if there is one, else the publisher's page.
_SECTIONS = """
WITH p AS (SELECT *, regexp_extract(p_brand, '([0-9]+)$', 1) AS b, p_size % 3 + 1 AS ch, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS sub FROM part),
s AS (
  SELECT p.*, 'out/usc/title-' || lpad(p.b, 2, '0') || '/chapter-0' || p.ch || '/section-' || p.p_partkey || '.md' AS path,
    CASE WHEN t.p_partkey IS NULL THEN 'https://uscode.house.gov/view.xhtml?req=granuleid:USC-prelim-title' || p.b || '-section' || (p.p_partkey - 25)
      WHEN t.ch = p.ch THEN 'section-' || t.p_partkey || '.md' ELSE '../chapter-0' || t.ch || '/section-' || t.p_partkey || '.md' END AS url
  FROM p LEFT JOIN p t ON t.p_partkey = p.p_partkey - 25 AND t.b = p.b),
m AS (
  SELECT *, 'See ' || CASE WHEN {linked} THEN '[section *' || (p_partkey - 25) || '*](' || url || '), [here](section-' || p_partkey || '.md)' ELSE 'section *' || (p_partkey - 25) || '*, here' END || ' and a law[^' || p_size || ']; it says "size ' || p_size || '".'
    || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '**Source Credit**: (Pub. L. ' || p_size || '.)' AS body FROM s)"""


@CATALOG.add(f"""{_SECTIONS.format(linked="true")}
SELECT '/us/usc/t' || b || '/s' || p_partkey AS identifier, path, body AS markdown FROM m""")
def linked_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sections.scan(_nested(spark, sf_dir), "doc", "xml", sections.USLM)
    files = convert.code_paths(sections.units(rows, sections.USLM), "out")
    linked = sections.linked(rows, files, files.select("identifier", "file_path"))
    docs = sections.code_documents(linked).join(files.select("doc", "ord", F.col("file_path").alias("path")), ["doc", "ord"])
    return docs.select("identifier", "path", "markdown")


@CATALOG.add(f"""{_SECTIONS.format(linked="true")}
SELECT path, '---' || chr(10) || 'identifier: "/us/usc/t' || b || '/s' || p_partkey || '"' || chr(10) || 'source: "usc"' || chr(10) || 'legal_status: "official_prima_facie"' || chr(10) || 'title: "' || b || ' USC § ' || p_partkey || ' - ' || p_name || '"' || chr(10)
  || 'title_number: ' || b || chr(10) || 'title_name: "' || p_brand || '"' || chr(10) || 'section_number: "' || p_partkey || '"' || chr(10) || 'section_name: "' || p_name || '"' || chr(10) || 'chapter_number: ' || ch || chr(10) || 'chapter_name: "Part ' || ch || '"' || chr(10)
  || CASE WHEN sub = '' THEN '' ELSE 'subchapter_number: "' || sub || '"' || chr(10) || 'subchapter_name: "Sub ' || sub || '"' || chr(10) END || 'positive_law: false' || chr(10) || 'currency: "unknown"' || chr(10) || 'last_updated: "unknown"' || chr(10) || 'format_version: "1.1.0"' || chr(10) || 'generator: "registra"' || chr(10)
  || 'source_credit: "(Pub. L. ' || p_size || '.)"' || chr(10) || '---' || chr(10) || chr(10) || '# § ' || p_partkey || '. ' || p_name || chr(10) || chr(10) || body || chr(10) AS text FROM m""")
def converted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.code_files(_nested(spark, sf_dir), "doc", "xml", "out")


@CATALOG.add(f"""{_SECTIONS.format(linked="false")},
g AS (SELECT b, ch, sub, string_agg('###' || CASE WHEN sub = '' THEN '' ELSE '#' END || ' § ' || p_partkey || '. ' || p_name || chr(10) || chr(10) || body, chr(10) || chr(10) ORDER BY p_partkey) AS t, count(*) AS n FROM m GROUP BY ALL),
c AS (
  SELECT b, ch, sum(n)::BIGINT AS n, string_agg(CASE WHEN sub = '' THEN '' ELSE '### SUBCHAPTER ' || sub || '— Sub ' || sub || chr(10) || chr(10) END || t, chr(10) || chr(10) ORDER BY sub) AS t FROM g GROUP BY ALL),
w AS (SELECT *, '## CHAPTER ' || ch || '— Part ' || ch || chr(10) || chr(10) || '### Purpose' || chr(10) || chr(10) || 'All of ' || ch || '.' || chr(10) || chr(10) || t AS part FROM c)
SELECT '/us/usc/t' || b || '/ch' || ch AS identifier, n AS n_sections, regexp_replace(regexp_replace(part, '(^|\\n)#(#+ (?:§|CHAPTER|SUBCHAPTER))', '\\1\\2', 'g'), '^$', '') AS markdown FROM w
UNION ALL SELECT '/us/usc/t' || b, sum(n)::BIGINT, '# Title ' || b || '— Brand#' || b || chr(10) || chr(10) || string_agg(part, chr(10) || chr(10) ORDER BY ch) FROM w GROUP BY b""")
def chapter_composites(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sections.scan(_nested(spark, sf_dir), "doc", "xml", sections.USLM)
    made = [sections.composites(rows, sections.USLM, emit).select("identifier", "n_sections", "markdown") for emit in ("chapter", "title")]
    return made[0].unionByName(made[1])


#: Characters of the ranges that a title's file is read in.
SPLIT = 20_000


@CATALOG.add(f"""{_SECTIONS.format(linked="false")}
SELECT '/us/usc/t' || b || '/s' || p_partkey AS identifier, body AS markdown FROM m""")
def xml_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles written as files and read in ranges, whatever lies across their ends."""
    base = fresh_path(spark, "titles")
    titles = _nested(spark, sf_dir).select(F.concat(F.regexp_replace("doc", "[^A-Za-z0-9]", "-"), F.lit(".xml")).alias("path"), F.col("xml").alias("text"))
    sink.write_changed(titles, base)
    return sections.code_documents(split_scan.scan(spark, base, sections.USLM, size=SPLIT)).select("identifier", "markdown")
