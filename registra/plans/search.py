"""Full-text search on the standard tables; the queries are the items of benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.operators import index, search
from registra.plans.common import Catalog, table
from registra.shared import fresh_path

CATALOG = Catalog()
TOP = 10
#: Words of a snippet.
CROP = 40
MARKED = ["the", "ou", "der", "que"]

_HITS = f"""
WITH q AS (SELECT item_id, string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+') AS words FROM benchmark),
qw AS (SELECT item_id, word, min(nth) AS nth FROM (SELECT item_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS nth FROM q) WHERE word <> '' GROUP BY ALL),
a AS (SELECT doc_id, 0 AS attribute, string_split_regex(lower(source), '[^\\p{{L}}\\p{{N}}]+') AS words FROM documents
  UNION ALL SELECT doc_id, 1, string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+') FROM documents),
idx AS (SELECT * FROM (SELECT doc_id, attribute, unnest(words) AS token, generate_subscripts(words, 1) - 1 AS pos FROM a) WHERE token <> ''),
voc AS (SELECT DISTINCT token FROM idx),
near AS (
  SELECT word, token, CASE WHEN word = token THEN 0 ELSE levenshtein(word, token) END AS typos,
    CASE WHEN NOT (regexp_matches(word, '^[a-z0-9]+$') AND regexp_matches(token, '^[a-z0-9]+$')) THEN 0 WHEN length(word) >= {search.TWO_TYPOS} THEN 2 WHEN length(word) >= {search.ONE_TYPO} THEN 1 ELSE 0 END AS allowed
  FROM voc JOIN (SELECT DISTINCT word FROM qw) w ON substring(token, 1, 1) = substring(word, 1, 1)),
m AS (SELECT word, token, typos FROM near WHERE typos <= allowed AND abs(length(word) - length(token)) <= allowed),
best AS (
  SELECT item_id, doc_id, word, nth, typos, attribute, pos FROM idx JOIN m USING (token) JOIN qw USING (word)
  QUALIFY row_number() OVER (PARTITION BY item_id, doc_id, word ORDER BY typos, attribute, pos) = 1),
g AS (SELECT *, coalesce(least(abs(pos - lag(pos) OVER (PARTITION BY item_id, doc_id ORDER BY nth, word)), {search.FARTHEST}), 0) AS gap FROM best),
s AS (SELECT item_id, doc_id, count(*) AS words, sum(typos)::BIGINT AS typos, sum(gap)::BIGINT AS proximity, min(attribute)::BIGINT AS attribute, count(*) FILTER (WHERE typos = 0) AS exact FROM g GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY words DESC, typos, proximity, attribute, exact DESC, doc_id) AS rank FROM s)"""


def _searched(spark: SparkSession, sf_dir: str, top: int) -> DataFrame:
    queries = table(spark, sf_dir, "benchmark")
    return search.ranked(table(spark, sf_dir, "documents"), "doc_id", ["source", "text"], queries, "item_id", "text", top)


@CATALOG.add(f"{_HITS} SELECT item_id, doc_id, words, typos, proximity, attribute, exact, rank FROM r WHERE rank <= {TOP}")
def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _searched(spark, sf_dir, TOP)


@CATALOG.add(f"{_HITS} SELECT item_id, doc_id, rank, (SELECT count(*) FROM s WHERE s.item_id = r.item_id) AS total FROM r WHERE item_id = 3 AND rank > 5 AND rank <= 10")
def search_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = table(spark, sf_dir, "benchmark").where("item_id = 3")
    hits = search.ranked(table(spark, sf_dir, "documents"), "doc_id", ["source", "text"], query, "item_id", "text", None)
    page = hits.where("rank > 5 and rank <= 10").select("item_id", "doc_id", "rank")
    return page.join(F.broadcast(hits.agg(F.count("*").alias("total"))))  # one row


def _built(spark: SparkSession, sf_dir: str) -> index.Index:
    return index.built(table(spark, sf_dir, "documents"), "doc_id", ["source", "text"])


@CATALOG.add(f"{_HITS} SELECT item_id, doc_id, words, typos, proximity, attribute, exact, rank FROM r WHERE rank <= {TOP}")
def search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index that is written once as a table of its own and opened again for the search."""
    base = fresh_path(spark, "index")
    docs = table(spark, sf_dir, "documents").withColumn("digest", F.md5(F.concat_ws("|", "source", "text")))
    index.update(docs, base, "doc_id", ["source", "text"], "digest")
    return index.search(index.opened(spark, base, "doc_id"), table(spark, sf_dir, "benchmark"), "item_id", "text", TOP).hits


@CATALOG.add(f"{_HITS} SELECT item_id, doc_id, words, typos, proximity, attribute, exact, rank FROM r WHERE rank <= {TOP}")
def search_index_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches with new, changed and vanished documents leave the index that the last state of the table gives."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    stale = docs.where("doc_id % 3 <> 2").withColumn("text", F.expr("if(doc_id % 2 = 0, concat('an older text ', text), text)"))
    gone = docs.where("doc_id % 5 = 0").withColumn("doc_id", F.col("doc_id") + 10**12)
    base = fresh_path(spark, "index")
    for n, (batch, prune) in enumerate([(stale.unionByName(gone), False), (docs.where("doc_id % 3 <> 1"), False), (docs, True)]):
        digested = batch.withColumn("digest", F.md5(F.concat_ws("|", "source", "text")))
        index.update(digested, base, "doc_id", ["source", "text"], "digest", {"documents": str(n)}, prune)
    return index.search(index.opened(spark, base, "doc_id"), table(spark, sf_dir, "benchmark"), "item_id", "text", TOP).hits


_SORTED = _HITS.replace("proximity, attribute, exact DESC", "proximity, attribute, (doc_id * 7919) % 365 DESC, exact DESC")


@CATALOG.add(f"{_SORTED} SELECT item_id, doc_id, words, exact, rank FROM r WHERE rank <= {TOP}")
def search_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = table(spark, sf_dir, "documents").withColumn("publication_date", F.expr("date_add(DATE'2025-01-01', CAST((doc_id * 7919) % 365 AS INT))"))
    hits = search.ranked(dated, "doc_id", ["source", "text"], table(spark, sf_dir, "benchmark"), "item_id", "text", TOP, "-publication_date")
    return hits.select("item_id", "doc_id", "words", "exact", "rank")


@CATALOG.add(f"""{_HITS},
h AS (SELECT s.item_id, d.source, d.lang AS status FROM s JOIN documents d USING (doc_id))
SELECT item_id, 'source' AS facet, source AS value, count(*) AS n FROM h GROUP BY ALL
UNION ALL SELECT item_id, 'status', status, count(*) FROM h GROUP BY ALL""")
def search_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("lang").alias("status"))
    hits = index.matching(_built(spark, sf_dir), table(spark, sf_dir, "benchmark"), "item_id", "text")
    return search.facets(hits.join(docs, "doc_id"), search.allowed_facets(None), "item_id")


@CATALOG.add(f"""{_HITS},
f AS (SELECT item_id, doc_id, min(pos) FILTER (WHERE attribute = 1) AS first FROM best GROUP BY ALL),
t AS (SELECT item_id, list(DISTINCT token) AS tokens FROM qw JOIN m USING (word) GROUP BY item_id),
w AS (SELECT doc_id, string_split_regex(text, '[^\\p{{L}}\\p{{N}}]+') AS ws, regexp_extract_all(text, '[^\\p{{L}}\\p{{N}}]+') AS seps FROM documents),
c AS (
  SELECT item_id, doc_id, ws, seps, tokens, greatest(coalesce(first, 0) - {CROP // 2}, 0) + 1 AS start
  FROM (SELECT item_id, doc_id FROM r WHERE rank <= {TOP}) JOIN f USING (item_id, doc_id) JOIN t USING (item_id) JOIN w USING (doc_id))
SELECT item_id, doc_id, array_to_string(list_transform(range(start, least(start + {CROP}, len(ws) + 1)),
  lambda i: CASE WHEN list_contains(tokens, lower(ws[i])) THEN '<mark>' || ws[i] || '</mark>' ELSE ws[i] END || coalesce(seps[i], '')), '') AS snippet FROM c""")
def search_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = index.search(_built(spark, sf_dir), table(spark, sf_dir, "benchmark"), "item_id", "text", TOP)
    return search.snippets(found, table(spark, sf_dir, "documents"), "doc_id", "text", "item_id", 1, CROP)


@CATALOG.add(f"""
WITH c AS (SELECT doc_id, substring(text, greatest(coalesce(least({', '.join(f"nullif(position('{w}' in lower(text)), 0)" for w in MARKED)}), 1) - 100, 1), 200) AS t FROM documents),
-- A private character on both sides of every word stands for what RE2 cannot look at.
b AS (SELECT doc_id, chr(57344) || regexp_replace(t, '([^\\p{{L}}\\p{{N}}]+)', chr(57344) || '\\1' || chr(57344), 'g') || chr(57344) AS t FROM c)
SELECT doc_id, replace(regexp_replace(t, '(?i)' || chr(57344) || '({'|'.join(sorted(MARKED))})' || chr(57344), '<mark>\\1</mark>', 'g'), chr(57344), '') AS snippet FROM b""")
def search_highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", search.highlighted(search.cropped(F.col("text"), MARKED, 200), MARKED).alias("snippet"))


@CATALOG.add("""
SELECT doc_id::VARCHAR || '_' || source AS id, doc_id || '/' || source AS identifier, source AS heading,
  substring(regexp_replace(regexp_replace(regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+', ''), '\\s+$', ''), 1, 5000) AS body,
  lang || '>' || source AS hierarchy, 'https://example.org/' || doc_id || '/' || source AS url, lang
FROM documents""")
def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    identifier = F.concat_ws("/", F.col("doc_id").cast("string"), "source")
    columns = search.document(identifier, F.col("source"), F.col("text"), [F.col("lang"), F.col("source")], "https://example.org/", lang=F.col("lang"))
    return table(spark, sf_dir, "documents").select(*columns).withColumn("hierarchy", F.array_join("hierarchy", ">"))


@CATALOG.add("""
WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS token FROM documents)
SELECT token, count(*) AS occurrences, count(DISTINCT doc_id) AS documents FROM w WHERE token <> '' GROUP BY token""")
def search_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.tokens(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    per_doc = index.groupBy("token", "doc_id").agg(F.count("*").alias("n"))
    return per_doc.groupBy("token").agg(F.sum("n").alias("occurrences"), F.count("*").alias("documents"))
