"""Rate limits, windows and markup scans on the standard tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.functions import identifiers
from registra.operators import markup, store
from registra.plans.common import Catalog, table
from registra.shared import fresh_path
from registra.streaming import ingest, limits

CATALOG = Catalog()
DAY_US = 86_400_000_000


_FIXED = f"""
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
w AS (
  SELECT user_id, n, event_id, us AS start, 1 AS count, us FROM e WHERE n = 1
  UNION ALL SELECT e.user_id, e.n, e.event_id, CASE WHEN e.us - w.start >= {DAY_US} THEN e.us ELSE w.start END, CASE WHEN e.us - w.start >= {DAY_US} THEN 1 ELSE w.count + 1 END, e.us
  FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1)
SELECT user_id AS key, event_id, count <= 3 AS allowed, greatest(0, 3 - count)::INT AS remaining FROM w"""
_WINDOWS = "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY ALL"


def _streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of the files that it has; a pattern, as a table may be one file or a folder."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """What a stream gives until its source is read up, from files in the shared folder."""
    spark, path = stream.sparkSession, fresh_path(stream.sparkSession, name)
    write = stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).outputMode(mode)
    if mode == "append":
        query = write.format("parquet").option("path", f"{path}/out").start()
    else:  # each batch has the whole result, so the last one stays
        query = write.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{path}/out")).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


@CATALOG.add(_FIXED)
def rate_limit_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.limited(table(spark, sf_dir, "events"), "user_id", "event_id", "ts", partial(limits.Fixed, 3, DAY_US))


@CATALOG.add(f"""
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
w AS (
  SELECT user_id, n, event_id, [us] AS log, true AS allowed FROM e WHERE n = 1
  UNION ALL SELECT user_id, n, event_id, CASE WHEN len(live) >= 3 THEN live ELSE list_append(live, us) END, len(live) < 3
  FROM (SELECT e.*, list_filter(w.log, lambda t: t >= e.us - {DAY_US}) AS live FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1))
SELECT user_id AS key, event_id, allowed, CASE WHEN allowed THEN 3 - len(log) ELSE 0 END::INT AS remaining FROM w""")
def rate_limit_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.limited(table(spark, sf_dir, "events"), "user_id", "event_id", "ts", partial(limits.Sliding, 3, DAY_US))


@CATALOG.add(_FIXED)
def stream_rate_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As late as the table is long: its files need not come in the order of time.
    return _drained(limits.limited_stream(_streamed(spark, sf_dir, "events"), "user_id", "event_id", "ts", limits.Fixed, 3, DAY_US, late="3650 days"), "limits")


@CATALOG.add(_WINDOWS)
def stream_request_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(ingest.request_counts(_streamed(spark, sf_dir, "events"), "ts", "event_type"), "counts", "complete")


@CATALOG.add("SELECT DISTINCT user_id FROM events")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(ingest.latest_once(_streamed(spark, sf_dir, "events"), "ts", "user_id", late="3650 days"), "seen").select("user_id")


@CATALOG.add("SELECT source, arg_max(doc_id, doc_id) AS doc_id, arg_max(n_chars, doc_id) AS n_chars FROM documents WHERE source IS NOT NULL GROUP BY source")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "table")
    found = _streamed(spark, sf_dir, "documents").where("source is not null").select("source", "doc_id", "n_chars", F.md5("text").alias("hash"))
    ingest.ingest_stream(spark, found, f"{path}/out", f"{path}/checkpoint", "source", "hash", [F.desc("doc_id")]).awaitTermination()
    return store.read(spark, f"{path}/out").select("source", "doc_id", "n_chars")


@CATALOG.add(_WINDOWS)
def request_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return windows.select(F.col("w.start").alias("start"), "event_type", "n")


@CATALOG.add("""
WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '<(/?[a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pages)
SELECT page_id, lower(ltrim(tag, '/')) AS name, count(*) FILTER (WHERE tag NOT LIKE '/%') AS opened, count(*) FILTER (WHERE tag LIKE '/%') AS closed FROM t GROUP BY ALL""")
def html_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.tag_counts(table(spark, sf_dir, "pages"), "page_id", "html")


@CATALOG.add("""
WITH a AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS hrefs FROM pages)
SELECT page_id, unnest(hrefs) AS href, (generate_subscripts(hrefs, 1) - 1)::INT AS pos FROM a""")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.links(table(spark, sf_dir, "pages"), "page_id", "html")


@CATALOG.add("""
WITH h AS (SELECT page_id, regexp_extract_all(html, '(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>', 1) AS depths, regexp_extract_all(html, '(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>', 2) AS texts FROM pages)
SELECT page_id, (generate_subscripts(texts, 1) - 1)::INT AS pos, unnest(depths)::INT AS depth, trim(regexp_replace(unnest(texts), '<[^>]*>', '', 'g')) AS heading FROM h""")
def html_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.headings(table(spark, sf_dir, "pages"), "page_id", "html")


@CATALOG.add("""
SELECT page_id, nullif(regexp_extract(url, '^([a-z]+)://', 1), '') AS scheme, nullif(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '') AS host,
  nullif(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '') AS path, len(string_split(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/')) AS depth FROM pages""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.url_parts(table(spark, sf_dir, "pages"), "url").select("page_id", "scheme", "host", "path", "depth")


@CATALOG.add("""
SELECT page_id, CASE WHEN url LIKE 'https%' THEN 'title' ELSE 'section' END AS granularity, '/us/usc/t' || page_id || CASE WHEN url LIKE 'https%' THEN '' ELSE '/s1' END AS identifier FROM pages""")
def route_granularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = F.expr("if(url LIKE 'https%', concat('title-', page_id), concat('title-', page_id, '/chapter-2/section-1'))")
    kind = F.element_at(F.create_map(F.lit(1), F.lit("title"), F.lit(2), F.lit("chapter"), F.lit(3), F.lit("section")), F.size(F.split(slug, "/")))
    pages = table(spark, sf_dir, "pages").select("page_id", kind.alias("granularity"))
    suffix = F.when(F.col("granularity") == "section", "/s1").otherwise("")
    return pages.withColumn("identifier", identifiers.resolve_identifier(F.concat(F.col("page_id").cast("string"), suffix), "/us/usc/t"))
