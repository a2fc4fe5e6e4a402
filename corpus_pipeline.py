"""From raw documents to encoded training data: language ID, line dedup, near-dedup, mixing, BPE encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.llm import bpe, langid, lines, mixing, neartexts, queries
from registra.llm.common import tables, written

#: A document whose best language gets less than this is rejected, as is one without a letter.
MIN_SCORE = 0.3
#: Near-duplicates share this part of their five-word shingles.
SIMILARITY, SHINGLE_WORDS = 0.8, 5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the languages learned from the labels of ``docs``."""
    seen = langid.classify(docs, langid.fit(docs), lang_out="_pred", score_out="_score")
    good = (F.col("_pred") != langid.UNDETERMINED) & (F.col("_score") >= MIN_SCORE)
    return seen.where(good).select(*docs.columns)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that exceed the boilerplate ratio of their source; n_chars follows the text."""
    kept = lines.drop_boilerplate(docs, F.col("source"))
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each component of verified pairs that meet at SimHash anchors."""
    return neartexts.one_of_each(docs, similarity=SIMILARITY, words=SHINGLE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fill the budgets of the mixing tree, each document at most once."""
    mixed = mixing.mix(docs, queries.mix_levels(), budget_share=queries.MIX_SHARE, max_epochs=1, seed=queries.MIX_SEED)
    return mixed.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return bpe.encode(docs, queries.bpe_path(), keep=["doc_id", "lang", "source"])


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe_encoding", encode),
]

#: SQL can express neither the network nor XXH64 nor BPE; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; each result is written as Parquet and read by the next stage."""
    docs = tables(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
