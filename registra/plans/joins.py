"""Joins, windows, change detection and mutation on the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.functions import identifiers
from registra.operators import keys, markdown, relations, store
from registra.plans.common import Catalog, table

CATALOG = Catalog()


@CATALOG.add("""
WITH r AS (SELECT '/us/usc/t' || p_size || '/s' || p_partkey AS identifier, 'usc/title-' || lpad(p_size::VARCHAR, 2, '0') || '/section-' || p_partkey || '.md' AS file_path FROM part WHERE p_partkey % 3 <> 0),
l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '/us/usc/t' || (l_partkey % 50) || '/s' || l_partkey || CASE WHEN l_linenumber > 3 THEN '/a' ELSE '' END AS href FROM lineitem),
j AS (SELECT l.*, r.file_path AS target_file FROM l LEFT JOIN r ON r.identifier = regexp_replace(href, '/a$', ''))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, href, target_file, CASE WHEN target_file IS NOT NULL THEN '../../' || target_file END AS link,
  CASE WHEN target_file IS NOT NULL THEN '../../' || target_file ELSE 'https://uscode.house.gov/view.xhtml?req=granuleid:USC-prelim-title' || (l_partkey % 50) || '-section' || l_partkey END AS url
FROM j""")
def link_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.lpad(F.col("p_size").cast("string"), 2, "0")
    registry = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(
        F.concat_ws("", F.lit("/us/usc/t"), "p_size", F.lit("/s"), "p_partkey").alias("identifier"),
        F.concat_ws("", F.lit("usc/title-"), size, F.lit("/section-"), "p_partkey", F.lit(".md")).alias("file_path"),
    )
    href = F.expr("concat('/us/usc/t', l_partkey % 50, '/s', l_partkey, if(l_linenumber > 3, '/a', ''))")
    refs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", href.alias("href")).withColumn("file", F.lit("fr/1998/x.md"))
    return relations.resolved_links(refs, "href", registry, "file").drop("file")


@CATALOG.add("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'x-' || p_partkey || '.md' WHEN 1 THEN '../b/' || p_partkey || '.md' ELSE '../../other/y.md' END AS path FROM part""")
def relative_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.expr("CASE p_partkey % 3 WHEN 0 THEN concat('u/a/x-', p_partkey, '.md') WHEN 1 THEN concat('u/b/', p_partkey, '.md') ELSE 'other/y.md' END")
    return table(spark, sf_dir, "part").select("p_partkey", identifiers.relative_path(F.lit("u/a/from.md"), target).alias("path"))


@CATALOG.add("""
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END, n_name) AS authority FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def inherit_parent_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.when(F.col("c_custkey") % 4 == 0, F.col("c_mktsegment"))
    sections = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), own.alias("authority"))
    return relations.inherited(sections, table(spark, sf_dir, "nation"), "n_nationkey", {"authority": "n_name"}).select("c_custkey", "authority")


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nation = table(spark, sf_dir, "nation").join(F.broadcast(region), "n_regionkey").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")  # 25 rows
    above = F.array(*[F.struct(F.lit(level).alias("level_type"), F.col(c).alias("identifier")) for level, c in (("title", "r_name"), ("chapter", "n_name"))])
    return table(spark, sf_dir, "customer").join(F.broadcast(nation), "c_nationkey").withColumn("ancestors", above)


@CATALOG.add("""
SELECT c_custkey, r_name AS title, n_name AS chapter, NULL::VARCHAR AS part, r_name || ' > ' || n_name AS chain
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def ancestor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = lambda name: relations.nearest_ancestor(F.col("ancestors"), name)["identifier"]
    chain = F.array_join(F.transform("ancestors", lambda a: a["identifier"]), " > ")
    return _chains(spark, sf_dir).select("c_custkey", level("title").alias("title"), level("chapter").alias("chapter"), level("part").alias("part"), chain.alias("chain"))


@CATALOG.add("""
SELECT c_custkey, '/usc/title-' || n_regionkey || ',/usc/title-' || n_regionkey || '/chapter-' || c_nationkey || ',/usc/title-' || n_regionkey || '/chapter-' || c_nationkey || '/other' AS paths,
  'Title ' || n_regionkey || ' > Chapter ' || c_nationkey || ' > other' AS labels FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def breadcrumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    slugs = F.split(F.concat_ws("", F.lit("title-"), "n_regionkey", F.lit("/chapter-"), "c_nationkey", F.lit("/other")), "/")
    rows = table(spark, sf_dir, "customer").join(F.broadcast(nation), "c_nationkey").withColumn("slugs", slugs)  # 25 rows
    labels = F.transform("slugs", identifiers.segment_label)
    return rows.select("c_custkey", F.array_join(identifiers.breadcrumb_paths("/usc", F.col("slugs")), ",").alias("paths"), F.array_join(labels, " > ").alias("labels"))


_ENRICHED = """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 9 END AS quality, CASE WHEN doc_id % 10 = 0 THEN 8 END AS toxic FROM documents)
SELECT d.doc_id, CASE WHEN d.doc_id % 10 = 0 OR l.doc_id IS NULL THEN d.quality ELSE coalesce(l.quality, d.quality) END AS quality,
  CASE WHEN d.doc_id % 10 = 0 OR l.doc_id IS NULL THEN d.toxic ELSE coalesce(l.toxic, d.toxic) END AS toxic,
  CASE WHEN d.doc_id % 10 = 0 THEN 'already' WHEN l.doc_id IS NULL THEN 'not_found' ELSE 'enriched' END AS outcome
FROM d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@CATALOG.add(_ENRICHED)
def sidecar_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr("if(doc_id % 5 = 0, 9, null)").alias("quality"), F.expr("if(doc_id % 10 = 0, 8, null)").alias("toxic"))
    return relations.enriched(docs, table(spark, sf_dir, "labels"), "doc_id", ["quality", "toxic"])


@CATALOG.add(f"SELECT outcome, count(*) AS n FROM ({_ENRICHED}) GROUP BY outcome")
def enrichment_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sidecar_enrichment(spark, sf_dir).groupBy("outcome").agg(F.count("*").alias("n"))


def _stored_and_found(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents")
    stored = docs.where("doc_id % 7 <> 0").select("doc_id", F.sha2(F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), 256).alias("hash"))
    return stored, docs.where("doc_id % 11 <> 0").select("doc_id", F.sha2("text", 256).alias("hash"))


_DIFF = """
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'new' WHEN doc_id % 11 = 0 THEN 'pruned' WHEN doc_id % 5 = 0 THEN 'updated' ELSE 'unchanged' END AS outcome
FROM documents WHERE doc_id % 7 <> 0 OR doc_id % 11 <> 0"""


@CATALOG.add(_DIFF)
def incremental_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.changes(*_stored_and_found(spark, sf_dir), "doc_id", "hash")


@CATALOG.add(f"SELECT outcome, count(*) AS n FROM ({_DIFF}) GROUP BY outcome")
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_diff(spark, sf_dir).groupBy("outcome").agg(F.count("*").alias("n"))


@CATALOG.add("SELECT doc_id FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 = 0")
def prune_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.orphans(*_stored_and_found(spark, sf_dir), "doc_id").select("doc_id")


@CATALOG.add("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def last_event_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.last_wins(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "value")


@CATALOG.add("""
WITH n AS (SELECT user_id, value FROM events WHERE event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, value FROM n UNION ALL SELECT u.user_id, -1.0 FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 2 = 0) u WHERE u.user_id NOT IN (SELECT user_id FROM n)""")
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    stored = events.where("user_id % 2 = 0").select("user_id").distinct().withColumn("value", F.lit(-1.0))
    batch = events.where("event_type = 'purchase'").select("user_id", "value", "ts", "event_id")
    return relations.upserted(stored, batch, "user_id", [F.desc("ts"), F.desc("event_id")]).select("user_id", "value")


@CATALOG.add("""
WITH s AS (SELECT o_custkey, max(o_orderdate) AS amended FROM orders GROUP BY 1), c AS (SELECT o_custkey, max(o_orderdate) AS amended FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01' AND o_custkey % 3 <> 0 GROUP BY 1)
SELECT s.o_custkey, s.amended FROM s LEFT JOIN c USING (o_custkey) WHERE c.amended IS NULL OR s.amended > c.amended""")
def changed_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    latest = lambda df: df.groupBy("o_custkey").agg(F.max("o_orderdate").alias("amended"))
    before = latest(orders.where("o_orderdate < '2001-01-01' and o_custkey % 3 <> 0"))
    return relations.changed_since(latest(orders), before, "o_custkey", "amended")


@CATALOG.add("""
SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2 UNION ALL SELECT s_nationkey, NULL FROM (SELECT DISTINCT s_nationkey FROM supplier)
WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)""")
def reserved_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").where("n_regionkey <> 2").select("n_nationkey", "n_name")
    expected = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    return relations.padded(nation, expected, "n_nationkey")


@CATALOG.add("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN n > 1 THEN '-' || n ELSE '' END AS suffix
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS n FROM lineitem)""")
def duplicate_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")]
    out = relations.duplicate_suffixes(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", order)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "suffix")


@CATALOG.add("""
SELECT conv_id, turn, last_value(CASE WHEN role <> 'assistant' THEN role || turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS category FROM conversations""")
def note_category_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("role") != "assistant", F.concat("role", F.col("turn").cast("string")))
    rows = relations.carried(table(spark, sf_dir, "conversations"), ["conv_id"], [F.col("turn"), F.col("role"), F.col("text")], value, "category")
    return rows.select("conv_id", "turn", "category")


_TOPICS = "CASE turn % 5 WHEN 1 THEN 'amendments' WHEN 2 THEN 'codification' WHEN 3 THEN 'repeals' ELSE 'other' END"


@CATALOG.add(f"""
WITH n AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'crossHeading' ELSE 'note' END AS r, CASE WHEN role = 'user' THEN CASE WHEN turn % 4 = 0 THEN 'editorialNotes' ELSE 'statutoryNotes' END ELSE {_TOPICS} END AS topic, text FROM conversations),
c AS (SELECT *, last_value(CASE WHEN r = 'crossHeading' THEN topic END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, text ROWS UNBOUNDED PRECEDING) AS cat FROM n)
SELECT conv_id, turn, topic FROM c WHERE CASE WHEN r = 'crossHeading' THEN topic = 'statutoryNotes' WHEN topic IN ('amendments', 'codification') THEN false WHEN topic = 'repeals' THEN true
  WHEN cat = 'editorialNotes' THEN false ELSE true END""")
def note_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    heading = F.col("role") == "user"
    topic = F.when(heading, F.when(F.col("turn") % 4 == 0, "editorialNotes").otherwise("statutoryNotes")).otherwise(F.expr(_TOPICS))
    notes = table(spark, sf_dir, "conversations").withColumn("topic", topic).withColumn("role", F.when(heading, "crossHeading").otherwise("note"))
    kept = relations.notes_kept(notes, ["conv_id"], [F.col("turn"), F.col("text")], editorial=False, statutory=True, amendments=False)
    return kept.select("conv_id", "turn", "topic")


@CATALOG.add("""
WITH s AS (SELECT conv_id, turn, '**(' || turn || ')** **' || role || '** ' || text AS md, turn // 2 AS parent, turn % 2 = 0 AS top FROM conversations),
b AS (SELECT conv_id, parent, string_agg(md, chr(10) || chr(10) ORDER BY turn) AS below FROM s WHERE NOT top GROUP BY ALL),
a AS (SELECT s.conv_id, turn, md || CASE WHEN below IS NULL THEN '' ELSE chr(10) || chr(10) || below END AS md FROM s LEFT JOIN b ON s.conv_id = b.conv_id AND s.parent = b.parent WHERE top)
SELECT conv_id, string_agg(md, chr(10) || chr(10) ORDER BY turn) AS markdown FROM a GROUP BY conv_id""")
def section_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.concat(F.lit("("), F.col("turn").cast("string"), F.lit(")"))
    md = markdown.small_level(number, F.col("role"), F.col("text"))
    nodes = table(spark, sf_dir, "conversations").select(
        "conv_id", F.col("turn").alias("node_id"), F.expr("if(turn % 2 = 0, null, turn - 1)").alias("parent_id"), F.col("turn").alias("ord"), F.expr("turn % 2").alias("depth"), md.alias("own")
    )
    return markdown.folded(nodes, "own", ["conv_id"], 1)


@CATALOG.add("""
SELECT user_id AS key_id, count(*) AS total_requests, max(ts) AS last_used FROM events GROUP BY user_id""")
def api_usage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.usage(table(spark, sf_dir, "events"), "user_id", "ts").withColumnRenamed("user_id", "key_id")


@CATALOG.add("""
WITH k AS (SELECT user_id, min(ts) AS created, max(CASE WHEN event_type = 'error' AND value > 90 THEN ts END) AS revoked_at, max(CASE WHEN event_type = 'purchase' THEN ts END) AS expires_at FROM events GROUP BY 1)
SELECT user_id FROM k WHERE revoked_at IS NULL AND (expires_at IS NULL OR expires_at > TIMESTAMP '2024-01-15')""")
def active_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = lambda which: F.max(F.when(F.expr(which), F.col("ts")))
    revoked, expires = stamp("event_type = 'error' and value > 90"), stamp("event_type = 'purchase'")
    made = table(spark, sf_dir, "events").groupBy("user_id").agg(revoked.alias("revoked_at"), expires.alias("expires_at"))
    return keys.active(made, F.lit("2024-01-15").cast("timestamp")).select("user_id")


@CATALOG.add("""
SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'unlimited' WHEN user_id % 3 = 1 THEN 'elevated' ELSE 'standard' END AS tier,
  CASE WHEN user_id % 3 = 0 THEN 0 WHEN user_id % 3 = 1 THEN 5000 ELSE 1000 END AS rate_limit FROM (SELECT DISTINCT user_id FROM events)""")
def key_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.expr("CASE user_id % 3 WHEN 0 THEN 'unlimited' WHEN 1 THEN 'elevated' ELSE 'standard' END")
    return keys.with_defaults(table(spark, sf_dir, "events").select("user_id").distinct().withColumn("tier", tier), "tier").select("user_id", "tier", "rate_limit")


@CATALOG.add("SELECT source, greatest(max(CASE WHEN doc_id % 2 = 0 THEN doc_id END), max(CASE WHEN doc_id % 2 = 1 THEN doc_id END)) AS cursor FROM documents GROUP BY source")
def monotone_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    seen = lambda rest: docs.where(f"doc_id % 2 = {rest}").groupBy("source").agg(F.max("doc_id").alias("cursor"))
    return store.advanced(seen(0), seen(1), "source", "cursor")
