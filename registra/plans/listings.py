"""Listings, lookups, hierarchies and statistics on the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.functions import identifiers
from registra.operators import hierarchy, listing
from registra.plans.common import Catalog, table

CATALOG = Catalog()
ORDERS = listing.Listing(
    columns=("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate", "o_totalprice"),
    equal=("o_orderpriority", "o_orderstatus", "o_custkey"),
    ranges={"date_from": "o_orderdate", "date_to": "o_orderdate"},
    sorts=("o_orderdate", "o_totalprice", "o_orderkey"),
    key="o_orderkey",
)
DATES = {"date_from": "1996-03-01", "date_to": "1997-09-30", "o_orderpriority": "1-URGENT", "unknown": "ignored"}
_WHERE = "o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1997-09-30' AND o_orderpriority = '1-URGENT'"
_SHOWN = ", ".join(ORDERS.columns)


@CATALOG.add(f"""
WITH f AS (SELECT {_SHOWN} FROM orders WHERE {_WHERE}), t AS (SELECT count(*) AS total FROM f)
SELECT p.*, total, total > 40 AS has_more
FROM (SELECT * FROM f ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 20) p, t""")
def listing_filtered_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.offset_page(table(spark, sf_dir, "orders"), ORDERS, DATES, "-o_totalprice", 20, 20)


@CATALOG.add(f"SELECT {_SHOWN} FROM orders WHERE {_WHERE} AND o_totalprice < 300000 ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 26")
def listing_keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.keyset_page(table(spark, sf_dir, "orders"), ORDERS, DATES, "-o_totalprice", 25, "300000")


@CATALOG.add(f"""
SELECT {_SHOWN} FROM orders WHERE o_orderstatus = 'F'
AND (o_orderdate > TIMESTAMP '1997-01-01' OR (o_orderdate = TIMESTAMP '1997-01-01' AND o_orderkey > 100))
ORDER BY o_orderdate NULLS FIRST, o_orderkey LIMIT 26""")
def listing_keyset_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.keyset_page(table(spark, sf_dir, "orders"), ORDERS, {"o_orderstatus": "F"}, "o_orderdate", 25, "1997-01-01", tie=100)


@CATALOG.add(f"SELECT {_SHOWN} FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 20")
def listing_unknown_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = listing.offset_page(table(spark, sf_dir, "orders"), ORDERS, {"o_orderstatus": "P"}, "password", 20)
    return page.select(*ORDERS.columns)


@CATALOG.add("SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id = 7")
def lookup_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.lookup(table(spark, sf_dir, "documents"), "metadata", ["text"], ["doc_id", "source"], doc_id=7)


@CATALOG.add("SELECT doc_id, text, source FROM documents WHERE source = 'src3'")
def lookup_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.lookup(table(spark, sf_dir, "documents"), "body", ["text"], ["doc_id", "source"], source="src3")


@CATALOG.add("SELECT doc_id, lang, source FROM documents")
def lookup_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.lookup(table(spark, sf_dir, "documents"), ["lang", "no_such"], ["text"], ["doc_id", "source"])


@CATALOG.add("SELECT item_id, text FROM benchmark WHERE strlen('{\"item_id\":' || item_id || ',\"text\":' || to_json(text)::VARCHAR || '}') <= 260")
def byte_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.within_budget(table(spark, sf_dir, "benchmark"), 260)


@CATALOG.add("""
SELECT p_brand, p_type, count(*) AS document_count, count(DISTINCT p_size) AS chapter_count, max(p_retailprice) AS positive_law
FROM part GROUP BY ALL""")
def titles_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.titles(table(spark, sf_dir, "part"), ["p_brand", "p_type"], "p_size", "p_retailprice")


@CATALOG.add("SELECT p_type, CASE WHEN p_size > 10 THEN p_size END AS chapter, count(*) AS document_count FROM part WHERE p_brand = 'Brand#2' GROUP BY ALL")
def title_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where("p_brand = 'Brand#2'")
    return hierarchy.chapters(part.withColumn("chapter", F.when(F.col("p_size") > 10, F.col("p_size"))), ["p_type", "chapter"])


@CATALOG.add("SELECT year(o_orderdate)::BIGINT AS year, count(*) AS document_count FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def fr_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = hierarchy.year_months(table(spark, sf_dir, "orders"), F.col("o_orderdate"))
    return counts.groupBy("year").agg(F.sum("count").alias("document_count"))


@CATALOG.add("SELECT year(o_orderdate)::BIGINT AS year, month(o_orderdate)::BIGINT AS month, count(*) AS count FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL")
def fr_year_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.year_months(table(spark, sf_dir, "orders"), F.col("o_orderdate"))


@CATALOG.add("""
WITH m AS (SELECT year(o_orderdate)::BIGINT AS year, month(o_orderdate)::BIGINT AS month, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL)
SELECT year, sum(n)::BIGINT AS total, string_agg(month || ':' || n, ',' ORDER BY month) AS months FROM m GROUP BY year""")
def fr_years_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = hierarchy.years_nested(hierarchy.year_months(table(spark, sf_dir, "orders"), F.col("o_orderdate")))
    return nested.withColumn("months", F.array_join(F.transform("months", lambda m: F.concat_ws(":", m["month"], m["count"])), ","))


@CATALOG.add("""
WITH m AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-02-01' AND o_orderdate < TIMESTAMP '1996-03-01'), t AS (SELECT count(*) AS month_total FROM m)
SELECT o_orderkey, o_orderdate, o_orderpriority, month_total FROM m, t ORDER BY o_orderdate, o_orderkey LIMIT 100""")
def fr_month_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = hierarchy.month_rows(table(spark, sf_dir, "orders"), "o_orderdate", 1996, 2)
    page = month.select("o_orderkey", "o_orderdate", "o_orderpriority").orderBy("o_orderdate", "o_orderkey").limit(100)
    return page.join(F.broadcast(month.agg(F.count("*").alias("month_total"))))  # one row


@CATALOG.add("""
SELECT year(o_orderdate)::BIGINT AS year, month(o_orderdate)::BIGINT AS month, count(*) AS count
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ROLLUP (1, 2)""")
def year_month_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("o_orderdate")
    rows = table(spark, sf_dir, "orders").where(date.isNotNull()).select(F.year(date).cast("long").alias("year"), F.month(date).cast("long").alias("month"))
    return rows.rollup("year", "month").agg(F.count("*").alias("count"))


@CATALOG.add("SELECT source, count(*) AS document_count, count(DISTINCT lang) AS title_count, max(doc_id) AS last_updated FROM documents GROUP BY source")
def source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.source_stats(table(spark, sf_dir, "documents"), "source", "lang", "doc_id")


@CATALOG.add("SELECT count(*) AS total, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders")
def dated_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    return rows.agg(F.count("*").alias("total"), F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))


@CATALOG.add("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type is not null").groupBy("event_type").agg(F.count("*").alias("n"))


@CATALOG.add("""
SELECT n_name AS source, count(c_custkey) AS document_count FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 5000
GROUP BY n_nationkey, n_name""")
def source_registry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "customer").where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("document_count"))
    out = hierarchy.with_registry(counts, table(spark, sf_dir, "nation"), "n_nationkey")
    return out.select(F.col("n_name").alias("source"), "document_count")


@CATALOG.add("""
WITH y AS (SELECT year(o_orderdate)::BIGINT AS y, month(o_orderdate)::BIGINT AS m, count(*) AS n FROM orders GROUP BY ALL)
SELECT 'total' AS scope, '' AS name, count(*)::BIGINT AS n FROM documents
UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source
UNION ALL SELECT 'year', y::VARCHAR, sum(n)::BIGINT FROM y GROUP BY y
UNION ALL SELECT 'month', y || '-' || lpad(m::VARCHAR, 2, '0'), n FROM y
UNION ALL SELECT 'type', o_orderpriority, count(*) FROM orders GROUP BY o_orderpriority""")
def aggregate_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, orders = table(spark, sf_dir, "documents"), table(spark, sf_dir, "orders")
    months = hierarchy.year_months(orders, F.col("o_orderdate"))
    row = lambda df, scope, name, n: df.select(F.lit(scope).alias("scope"), name.cast("string").alias("name"), n.cast("long").alias("n"))
    parts = [
        row(docs.agg(F.count("*").alias("n")), "total", F.lit(""), F.col("n")),
        row(docs.groupBy("source").count(), "source", F.col("source"), F.col("count")),
        row(months.groupBy("year").agg(F.sum("count").alias("n")), "year", F.col("year"), F.col("n")),
        row(months, "month", F.concat_ws("-", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0")), F.col("count")),
        row(orders.groupBy("o_orderpriority").count(), "type", F.col("o_orderpriority"), F.col("count")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@CATALOG.add("""
SELECT 'source' AS facet, source AS value, count(*) AS n FROM documents WHERE length(text) > 500 GROUP BY source
UNION ALL SELECT 'lang', lang, count(*) FROM documents WHERE length(text) > 500 GROUP BY lang""")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from registra.operators.search import facets

    return facets(table(spark, sf_dir, "documents").where(F.length("text") > 500), ["source", "lang"])


@CATALOG.add("""
SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS sections, count(*) AS section_count,
  sum(ceil(length(l_returnflag || l_linestatus || l_partkey) / 4.0))::BIGINT AS token_estimate
FROM lineitem GROUP BY l_orderkey""")
def section_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("l_returnflag", "l_linestatus", F.col("l_partkey").cast("string"))
    out = hierarchy.section_rollup(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], text, [])
    return out.withColumn("sections", F.array_join(F.transform("sections", lambda s: F.concat_ws(":", s["l_linenumber"], s["l_partkey"])), ","))


@CATALOG.add("""
SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS chapter, o_orderpriority AS part, count(*) AS section_count,
  sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)::BIGINT AS without_chapter FROM orders GROUP BY ALL""")
def part_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    chapter = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    rows = table(spark, sf_dir, "orders").select(chapter.alias("chapter"), F.col("o_orderpriority").alias("part"))
    return rows.groupBy("chapter", "part").agg(F.count("*").alias("section_count"), F.count_if(F.col("chapter").isNull()).alias("without_chapter"))


@CATALOG.add("""
WITH c AS (SELECT year(o_orderdate)::BIGINT AS year, month(o_orderdate)::BIGINT AS month, coalesce(nullif(o_orderpriority, '2-HIGH'), 'unknown') AS kind, count(*) AS n FROM orders GROUP BY ALL)
SELECT year, month, sum(n)::BIGINT AS documents, string_agg(kind || '=' || n, ',' ORDER BY kind) AS types FROM c GROUP BY year, month""")
def nav_month_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("kind", F.expr("nullif(o_orderpriority, '2-HIGH')"))
    out = hierarchy.month_types(orders, "o_orderdate", "kind")
    pairs = F.transform(F.map_entries("types"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return out.withColumn("types", F.array_join(pairs, ","))


@CATALOG.add("""
SELECT p_type AS directory, string_agg(p_name, ',' ORDER BY p_brand, p_partkey) AS items FROM part GROUP BY p_type""")
def nav_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", "p_name"))), lambda e: e["p_name"])
    lists = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("directory"), "p_brand").agg(names.alias("items"))
    return hierarchy.merged(lists, "directory", ["p_brand"], "items").withColumn("items", F.array_join("items", ","))


@CATALOG.add("""
SELECT l_suppkey, min(l_orderkey) AS first_seen FROM lineitem GROUP BY l_suppkey""")
def first_seen_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.first_seen(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_orderkey")


@CATALOG.add("""
SELECT o_orderdate, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY o_orderdate ORDER BY n DESC, min(o_orderkey), o_orderdate LIMIT 1""")
def download_date_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.most_frequent(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey")


@CATALOG.add("SELECT p_partkey, (row_number() OVER (ORDER BY p_brand, p_partkey) - 1) // 250 AS chunk FROM part")
def fixed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.chunks(table(spark, sf_dir, "part"), ["p_brand", "p_partkey"], 250).select("p_partkey", "chunk")


@CATALOG.add("""
SELECT CASE WHEN source LIKE '/us/%' THEN source ELSE '/us/cfr/t' || source END AS identifier, doc_id
FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '/us/usc/t' || doc_id ELSE doc_id || '/s§ ' || lang END AS source FROM documents)""")
def resolve_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    given = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("/us/usc/t"), doc)).otherwise(F.concat(doc, F.lit("%2Fs%C2%A7%20"), "lang"))
    return table(spark, sf_dir, "documents").select(identifiers.resolve_identifier(given, "/us/cfr/t").alias("identifier"), "doc_id")
