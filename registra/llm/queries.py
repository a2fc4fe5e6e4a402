"""The operators on the standard tables: QUERIES maps a name to a function of (spark, sf_dir), ORACLE_SQL to DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.llm import alignment, bpe, forest, langid, lines, lm, mixing, partcodes, projections, simhash, tokenids, voronoi, warc
from registra.llm.common import tables

#: The mixing tree: domain, language and source, with integer weights; others weigh 1.
DOMAIN = "concat('domain', coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 4, 0))"
DOMAIN_WEIGHTS = {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}
LANG_WEIGHTS = {"en": 4, "fr": 2, "de": 2, "es": 1}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 2, 17


def _weights(value: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, weight in weights.items():
        out = F.when(value == name, weight).otherwise(out)
    return out


def mix_levels() -> list[tuple[str, Column, Column]]:
    domain = F.expr(DOMAIN)
    return [
        ("domain", domain, _weights(domain, DOMAIN_WEIGHTS)),
        ("lang", F.col("lang"), _weights(F.col("lang"), LANG_WEIGHTS)),
        ("source", F.col("source"), F.lit(1)),
    ]


def op1_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(tables(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.pseudo_likelihood(tables(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mix_levels(), budget_share=MIX_SHARE, max_epochs=MIX_EPOCHS, seed=MIX_SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "epoch", "tokens", "leaf_budget")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    model = langid.fit(docs)
    marked = docs.withColumn("held_out", langid.held_out(F.col("doc_id")))
    return langid.classify(marked, model, ["doc_id", "held_out"])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(tables(spark, sf_dir, "pages"))


def op6_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.exact_top_k(tables(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(tables(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    return lines.drop_boilerplate(docs, F.col("source"), dropped_col="n_dropped").select("doc_id", "source", "text", "n_dropped")


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return tokenids.round_trip(tables(spark, sf_dir, "documents"), path, end_id=2)


def bpe_path() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(tables(spark, sf_dir, "documents"), bpe_path(), keep=["doc_id"])


def op11_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_duplicate_vectors(tables(spark, sf_dir, "embeddings"))


def op12_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = partcodes.compress(tables(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(tables(spark, sf_dir, "documents"), *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_prefix_forest, op2_pseudo_likelihood, op3_mix_sources, op4_language_id, op5_warc, op6_voronoi_top_k, op7_simhash_anchors, op8_line_dedup, op9_token_ids, op10_byte_bpe, op11_projection_passes, op12_part_codes, op13_token_alignment)
}

_OP8 = f"""
WITH pages AS (SELECT row_number() OVER () AS page, doc_id, source, text, coalesce(source, '') AS host FROM documents),
split AS (SELECT page, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM pages),
often AS (
  SELECT host, trim(line) AS line, count(DISTINCT page) AS k FROM split WHERE trim(line) <> '' GROUP BY ALL HAVING count(DISTINCT page) >= {lines.MIN_PAGES}),
totals AS (SELECT host, count(*) AS total FROM pages GROUP BY host),
bad AS (SELECT host, line FROM often JOIN totals USING (host) WHERE k > total * {lines.RATIO}::DOUBLE),
kept AS (
  SELECT page, string_agg(s.line, chr(10) ORDER BY n) FILTER (WHERE b.line IS NULL) AS text, count(b.line) AS n_dropped
  FROM split s LEFT JOIN bad b ON s.host = b.host AND trim(s.line) = b.line GROUP BY page)
SELECT doc_id, source, CASE WHEN p.text IS NOT NULL THEN coalesce(k.text, '') END AS text, coalesce(k.n_dropped, 0)::BIGINT AS n_dropped
FROM pages p LEFT JOIN kept k USING (page)"""


def _case(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"


def _dealt(level: str, parent: str, above: str) -> str:
    """SQL that deals the budgets in ``above`` to the nodes of one level; parent: the path above, comma-separated."""
    path = f"{parent}{', ' if parent else ''}{level}"
    by = f"PARTITION BY {parent}" if parent else ""
    join = f"USING ({parent})" if parent else "ON true"
    return f"""
n_{level} AS (SELECT {path}, sum(leaf_tokens * {MIX_EPOCHS})::HUGEINT AS cap, max(w_{level})::HUGEINT AS w FROM leaves GROUP BY {path}),
g_{level} AS (
  SELECT n.*, least(budget, sum(cap) OVER ({by})) AS given,
    coalesce(sum(cap) OVER o, 0) AS cap_before, sum(w) OVER ({by}) - coalesce(sum(w) OVER o, 0) AS w_left
  FROM n_{level} n JOIN {above} {join}
  WINDOW o AS ({by} ORDER BY cap::DOUBLE / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f_{level} AS (SELECT *, cap * w_left <= (given - cap_before) * w AS is_full FROM g_{level}),
s_{level} AS (
  SELECT *, CASE WHEN is_full THEN cap ELSE ((given - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({by})) * w)
    // nullif(sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({by}), 0) END AS share FROM f_{level}),
b_{level} AS (
  SELECT {path}, share + CASE WHEN NOT is_full AND row_number() OVER ({by} ORDER BY is_full, {level})
    <= given - sum(share) OVER ({by}) THEN 1 ELSE 0 END AS budget FROM s_{level})"""


_OP3 = f"""
WITH base AS (
  SELECT doc_id, text, lang AS lang0, source AS source0, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    'domain' || coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 4, 0) AS domain,
    coalesce(ceil(strlen(text) / 4.0), 0)::BIGINT AS tokens, coalesce(doc_id::VARCHAR, '') AS id FROM documents),
leaves AS (
  SELECT domain, lang, source, sum(tokens)::HUGEINT AS leaf_tokens, {_case('domain', DOMAIN_WEIGHTS)} AS w_domain,
    {_case('lang', LANG_WEIGHTS)} AS w_lang, 1 AS w_source FROM base GROUP BY domain, lang, source),
total AS (SELECT floor(sum(leaf_tokens) * {MIX_SHARE}::DOUBLE)::HUGEINT AS budget FROM leaves),
{_dealt('domain', '', 'total')},
{_dealt('lang', 'domain', 'b_domain')},
{_dealt('source', 'domain, lang', 'b_lang')},
plan AS (
  SELECT domain, lang, source, leaf_tokens, budget AS leaf_budget,
    CASE WHEN leaf_tokens > 0 THEN budget // leaf_tokens ELSE 1 END AS whole FROM b_source JOIN leaves USING (domain, lang, source)),
epochs AS (SELECT *, unnest(range(0, whole::BIGINT + 1)) AS epoch FROM base JOIN plan USING (domain, lang, source)),
ordered AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source, epoch
    ORDER BY md5('{MIX_SEED}:' || epoch || ':' || id), md5(coalesce(text, '')) ROWS UNBOUNDED PRECEDING) AS upto FROM epochs)
SELECT doc_id, domain, lang0 AS lang, source0 AS source, epoch::INT AS epoch, tokens, leaf_budget::BIGINT AS leaf_budget
FROM ordered
WHERE epoch < whole OR (leaf_budget - whole * leaf_tokens > 0 AND upto <= leaf_budget - whole * leaf_tokens)"""

_OP5 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM m"""

_OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.x, d.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q, v d WHERE q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""

_VECTORS = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

#: All pairs; the passes compare all pairs of a table of up to projections.WINDOW + 1 vectors, and of a larger one nearly all that link.
_OP11 = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND {_VECTORS} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.r AS a, b.r AS b, b.vec_id AS other FROM v a, v b WHERE a.r <> b.r AND list_cosine_similarity(a.x, b.x) >= {projections.THRESHOLD}::DOUBLE),
reach AS (SELECT r AS a, r AS b, vec_id AS low FROM v UNION SELECT reach.a, links.b, links.other FROM reach JOIN links ON reach.b = links.a),
lows AS (SELECT a, min(low) AS low FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
rows AS (
  SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, low AS component_id FROM v JOIN lows ON v.r = lows.a LEFT JOIN counts ON v.r = counts.a
  UNION ALL SELECT vec_id, 0, vec_id FROM embeddings
  WHERE NOT coalesce(vec_id IS NOT NULL AND {_VECTORS} AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false))
SELECT vec_id, n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM rows"""


def _op12() -> str:
    """All distances of all parts to all entries, in as many rounds as the operator has."""
    n, rounds = partcodes.ENTRIES, partcodes.ROUNDS
    sql = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor({partcodes.SCALE} * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE {_VECTORS}),
parts AS MATERIALIZED (
  SELECT r, p AS part, list_slice(x, p * len(x) // {partcodes.PARTS} + 1, (p + 1) * len(x) // {partcodes.PARTS}) AS x FROM kept, range({partcodes.PARTS}) AS t(p)),
books0 AS (SELECT part, (r - 1) AS entry, x AS c FROM parts WHERE r <= {n})"""
    for k in range(rounds + 1):
        sql += f""",
near{k} AS MATERIALIZED (
  SELECT r, part, any_value(x) AS x, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'entry': entry}}) AS best
  FROM parts JOIN books{k} USING (part) GROUP BY r, part)"""
        if k < rounds:
            sql += f""",
sums{k} AS (
  SELECT part, best.entry AS entry, pos, sum(x[pos])::BIGINT AS s, count(*) AS n FROM near{k}, range(1, 1025) AS t(pos) WHERE pos <= len(x) GROUP BY ALL),
moved{k} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS c FROM sums{k} GROUP BY part, entry),
books{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c FROM books{k} b LEFT JOIN moved{k} m USING (part, entry))"""
    return sql + f""",
codes AS (SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN codes USING (r), digest"""


#: DuckDB has no XXH64, so op7 has no SQL; its test is a brute-force version.
ORACLE_SQL: dict[str, str] = {"op3_mix_sources": _OP3, "op5_warc": _OP5, "op6_voronoi_top_k": _OP6, "op8_line_dedup": _OP8, "op11_projection_passes": _OP11, "op12_part_codes": _op12()}
