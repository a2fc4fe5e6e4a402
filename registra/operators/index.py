"""A written inverted index: typo keys, postings in blocks of documents, searches that stop early, and upkeep by segments.

An index is a folder of plain Parquet tables, each partitioned by segment:

* ``postings``: for each token and block of documents the documents that have the token, with the first place of it;
* ``terms``: each token with the number of its documents;
* ``keys``: what is left of each token without one or two letters, so that a word meets the tokens within its typos by equality;
* ``docs``: which documents a segment put in or took out, with their digests and blocks; the last segment that names a document counts;
* ``commits``: written last, so a segment without a commit does not exist, and the next one takes its number.

A block's postings are made of its documents, and ranked for all queries, in one group: what a search shuffles is postings once, whatever
the number of queries that ask for them.

A search orders the words of each query by their documents.  Once some documents are known to match m words, one that
beats or equals them matches one of the rarest words, all but m - 1, so only these words' postings are looked at in full; of the others, only the blocks
in which such documents are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from registra.operators import relations
from registra.shared import fresh_path, remove, small_or_shuffled, written

SPLIT = r"[^\p{L}\p{N}]+"
#: Shortest words that may differ by one and by two characters, and the largest distance that counts.
ONE_TYPO, TWO_TYPOS, FARTHEST = 5, 9, 8
PLAIN = "^[a-z0-9]+$"
#: Letters after the first that keys are made of: what differs further on is found by the distance.
KEY_LETTERS = 6
#: Documents of a block, and folders of postings by token.
BLOCK_DOCS, BUCKETS = 256, 16
#: Bits of a place within its attribute.
POS_BITS = 40
#: Documents of the rarest words that are looked at for a first bound, and how much more than needed is read of postings to rule out more.
SEED_DOCS, MORE = 2_000, 2.0


def _bucket() -> Column:
    return F.pmod(F.xxhash64("token"), F.lit(BUCKETS)).cast("int")


def allowed(word: Column) -> Column:
    """How many typos a word may have."""
    return F.when(word.rlike(PLAIN) & (F.length(word) >= TWO_TYPOS), 2).when(word.rlike(PLAIN) & (F.length(word) >= ONE_TYPO), 1).otherwise(0)


def tokens(df: DataFrame, doc: str, attributes: Sequence[str], *more: Column) -> DataFrame:
    """(doc, attribute, pos, token) and ``more``: all occurrences; attributes in order of weight, 0 first."""
    lists = [F.struct(F.lit(i).alias("attribute"), F.split(F.lower(F.col(a)), SPLIT).alias("words")) for i, a in enumerate(attributes)]
    each = df.select(F.col(doc), *more, F.explode(F.array(*lists)).alias("a"))
    rest = [c for c in each.columns if c not in (doc, "a")]
    placed = each.select(doc, *rest, "a.attribute", F.posexplode("a.words").alias("pos", "token"))
    return placed.where("token <> ''")


def keys(word: str, typos: Column) -> Column:
    """Hashes of what is left of the beginning of a word without up to ``typos`` of its letters; the first letter stays."""
    head = f"substring({word}, 1, {KEY_LETTERS + 1})"
    less = lambda s: f"transform(sequence(2, greatest(length({s}), 2)), i -> concat(substring({s}, 1, i - 1), substring({s}, i + 1)))"
    one = less(head)
    two = f"flatten(transform({one}, s -> {less('s')}))"
    all_ = F.when(typos >= 2, F.expr(f"concat(array({head}), {one}, {two})")).when(typos == 1, F.expr(f"concat(array({head}), {one})")).otherwise(F.expr(f"array({head})"))
    return F.transform(F.array_distinct(all_), lambda s: F.xxhash64(s))


class Index(NamedTuple):
    """The tables of the committed segments.

    ``placed`` is (doc, segment, block) of the documents in the index; ``live`` is the same, None while no document was changed or taken out.
    """

    doc: str
    postings: DataFrame
    terms: DataFrame
    keys: DataFrame
    live: DataFrame | None
    placed: DataFrame


class Hits(NamedTuple):
    """What a search found.

    ``occurrences`` are the best places of the words in the documents that were ranked, ``tokens`` what each query matches, ``reading``
    (query, read, all) the postings that were looked at for the ranking and those that the query's words have.
    """

    hits: DataFrame
    occurrences: DataFrame
    tokens: DataFrame
    reading: DataFrame


# Writing


def _block(doc: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(blocks)).cast("int")


def _lists(attributes: int) -> Callable[[pa.Table], pa.Table]:
    """The postings of a block from its documents, given as ``doc`` and the words of each attribute."""

    def run(rows: pa.Table) -> pa.Table:
        ids = rows.column("doc").combine_chunks()
        words, docs, places = [], [], []
        for a in range(attributes):
            listed = rows.column(f"a{a}").combine_chunks()
            n = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            words.append(listed.flatten())
            docs.append(np.repeat(np.arange(len(ids)), n))
            places.append((a << POS_BITS) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        coded = pa.concat_arrays(words).dictionary_encode()
        code, doc, at = coded.indices.to_numpy().astype(np.int64), np.concatenate(docs), np.concatenate(places)
        word = code != pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
        code, doc, at = code[word], doc[word], at[word]
        # Places ascend, so the first of a token and document is its least.
        key, first = np.unique(code * len(ids) + doc, return_index=True)
        starts = np.flatnonzero(np.diff(key // len(ids), prepend=-1))
        pairs = pa.StructArray.from_arrays([ids.take(pa.array(key % len(ids))), pa.array(at[first])], ["doc", "at"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(key)), pa.int32()), pairs)
        block = pa.repeat(rows.column("block")[0], len(starts))
        return pa.table({"block": block, "token": coded.dictionary.take(pa.array(code[first[starts]])), "docs": lists})

    return run


def _segment(fresh: DataFrame, base: str, segment: int, doc: str, attributes: Sequence[str], known: DataFrame | None) -> int:
    """Write the postings of ``fresh``, the terms and the keys of tokens that are not in ``known``; the number of blocks."""
    blocks = max(1, -(-fresh.count() // BLOCK_DOCS))
    # Texts are shuffled once and become words where their block is.
    placed = fresh.select(F.col(doc).alias("doc"), *[F.col(a).alias(f"a{i}") for i, a in enumerate(attributes)]).withColumn("block", _block("doc", blocks)).repartition("block")
    words = placed.select("doc", "block", *[F.split(F.lower(F.col(f"a{i}")), SPLIT).alias(f"a{i}") for i in range(len(attributes))])
    lists = words.groupBy("block").applyInArrow(_lists(len(attributes)), f"block int, token string, docs array<struct<doc:{fresh.schema[doc].dataType.simpleString()},at:bigint>>")
    path = f"{base}/postings/segment={segment}"
    _write_postings(lists.withColumn("bucket", _bucket()), base, segment)
    spark = fresh.sparkSession
    terms = spark.read.parquet(path).groupBy("token").agg(F.sum("n").alias("docs"))
    terms.write.mode("overwrite").parquet(f"{base}/terms/segment={segment}")
    _write_keys(spark.read.parquet(f"{base}/terms/segment={segment}"), base, segment, known)
    return blocks


def _write_postings(lists: DataFrame, base: str, segment: int) -> None:
    rows = lists.withColumn("n", F.size("docs"))
    rows.sortWithinPartitions("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/postings/segment={segment}")


def _write_keys(terms: DataFrame, base: str, segment: int, known: DataFrame | None) -> None:
    new = terms.select("token").where(F.col("token").rlike(PLAIN) & (F.length("token") >= ONE_TYPO - 1))
    if known is not None:
        new = new.join(known.select("token"), "token", "left_anti")
    typos = F.when(F.length("token") >= TWO_TYPOS - 2, 2).otherwise(1)
    new.select(F.explode(keys("token", typos)).alias("key"), "token").write.mode("overwrite").parquet(f"{base}/keys/segment={segment}")


def commits(spark: SparkSession, base: str) -> DataFrame | None:
    """(segment, source, checkpoint, merged) of the segments that count; None if there is none."""
    try:
        found = spark.read.parquet(f"{base}/commits")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    start = found.where("merged").agg(F.coalesce(F.max("segment"), F.lit(0))).first()[0]
    return found.where(F.col("segment") >= start)


def checkpoints(spark: SparkSession, base: str) -> dict[str, str]:
    """The checkpoint of each source, as of the last segment that names it."""
    found = commits(spark, base)
    if found is None:
        return {}
    last = found.where("source is not null").groupBy("source").agg(F.max_by("checkpoint", "segment").alias("checkpoint"))
    return {r["source"]: r["checkpoint"] for r in last.collect()}  # a row for each source


def _docs(spark: SparkSession, base: str, segments: Sequence[int]) -> DataFrame:
    """(doc, digest, segment, block) of the documents that are in the index."""
    log = spark.read.parquet(f"{base}/docs").where(F.col("segment").isin(*segments))
    last = log.groupBy("doc").agg(F.max_by(F.struct("digest", "gone", "segment", "block"), "segment").alias("at"))
    return last.where("not at.gone").select("doc", "at.digest", "at.segment", "at.block")


def _commit(spark: SparkSession, base: str, segment: int, moved: dict[str, str], merged: bool) -> None:
    rows = [(s, c, merged) for s, c in moved.items()] or [(None, None, merged)]
    spark.createDataFrame(rows, "source string, checkpoint string, merged boolean").coalesce(1).write.mode("overwrite").parquet(f"{base}/commits/segment={segment}")


def update(found: DataFrame, base: str, doc: str, attributes: Sequence[str], digest: str, moved: dict[str, str] | None = None, prune: bool = False) -> dict[str, int]:
    """Put the rows of ``found`` whose digest is new into a segment of their own; counts by outcome.

    ``prune`` takes out the documents that ``found`` does not have.  ``moved`` are the sources' new checkpoints, which hold only
    once the whole segment is written; a run that is stopped before leaves the index as it was and can be repeated.  Rows must not repeat a
    document.  Nothing but the documents that differ is tokenized or written.
    """
    spark = found.sparkSession
    done = commits(spark, base)
    segments = [] if done is None else sorted({r["segment"] for r in done.select("segment").distinct().collect()})
    segment = max(segments, default=-1) + 1
    given = found.select(F.col(doc).alias("doc"), F.col(digest).alias("digest"))
    if segments:
        outcome = written(relations.changes(_docs(spark, base, segments).select("doc", "digest"), given, "doc", "digest"), "outcome")
        counts = {r["outcome"]: r["count"] for r in outcome.groupBy("outcome").count().collect() if prune or r["outcome"] != "pruned"}
        put = outcome.where("outcome in ('new', 'updated')").select("doc")
        fresh = found.join(small_or_shuffled(put).withColumnRenamed("doc", doc), doc, "left_semi")
        log = given.join(put, "doc", "left_semi").withColumn("gone", F.lit(False))
        if prune:
            log = log.unionByName(outcome.where("outcome = 'pruned'").select("doc", F.lit(None).cast(given.schema["digest"].dataType).alias("digest"), F.lit(True).alias("gone")))
        known = spark.read.parquet(f"{base}/terms").where(F.col("segment").isin(*segments))
    else:
        fresh, known, log = found, None, given.withColumn("gone", F.lit(False))
        counts = {"new": found.count()}
    if counts.keys() - {"unchanged"}:
        blocks = _segment(fresh, base, segment, doc, attributes, known)
        log.withColumn("block", _block("doc", blocks)).write.mode("overwrite").parquet(f"{base}/docs/segment={segment}")
    if counts.keys() - {"unchanged"} or moved:
        _commit(spark, base, segment, moved or {}, False)
    return counts


def merge(spark: SparkSession, base: str) -> None:
    """Write what is live of all segments as one and delete the others; a reader sees the old ones until it is committed."""
    done = commits(spark, base)
    segments = sorted({r["segment"] for r in done.select("segment").distinct().collect()})
    segment = segments[-1] + 1
    marks = checkpoints(spark, base)
    live = _docs(spark, base, segments)
    n = max(1, -(-live.count() // BLOCK_DOCS))
    each = spark.read.parquet(f"{base}/postings").where(F.col("segment").isin(*segments)).select("segment", "bucket", "token", F.explode("docs").alias("d"))
    kept = each.join(live.select(F.col("doc").alias("_doc"), "segment"), (F.col("d.doc") == F.col("_doc")) & (each["segment"] == live["segment"]), "left_semi")
    lists = kept.groupBy("bucket", _block("d.doc", n).alias("block"), "token").agg(F.collect_list("d").alias("docs"))
    path = f"{base}/postings/segment={segment}"
    _write_postings(lists, base, segment)
    spark.read.parquet(path).groupBy("token").agg(F.sum("n").alias("docs")).write.mode("overwrite").parquet(f"{base}/terms/segment={segment}")
    _write_keys(spark.read.parquet(f"{base}/terms/segment={segment}"), base, segment, None)
    live.select("doc", "digest", F.lit(False).alias("gone"), _block("doc", n).alias("block")).write.mode("overwrite").parquet(f"{base}/docs/segment={segment}")
    _commit(spark, base, segment, marks, True)
    for old in segments:
        for table in ("commits", "postings", "terms", "keys", "docs"):
            remove(spark, f"{base}/{table}/segment={old}")


def opened(spark: SparkSession, base: str, doc: str) -> Index:
    """The index at ``base`` as of its last commit."""
    segments = sorted({r["segment"] for r in commits(spark, base).select("segment").distinct().collect()})
    table = lambda name: spark.read.parquet(f"{base}/{name}").where(F.col("segment").isin(*segments))
    docs = table("docs")
    changed = docs.where("gone").limit(1).count() or (len(segments) > 1 and docs.groupBy("doc").count().where("count > 1").limit(1).count())
    placed = _docs(spark, base, segments).select("doc", "segment", "block") if changed else docs.select("doc", "segment", "block")
    live = written(placed, "live") if changed else None
    terms = table("terms").groupBy("token").agg(F.sum("docs").alias("docs")) if len(segments) > 1 else table("terms").select("token", "docs")
    return Index(doc, table("postings"), terms, table("keys").select("key", "token"), live, live if changed else placed)


def built(df: DataFrame, doc: str, attributes: Sequence[str]) -> Index:
    """An index of ``df`` in the shared folder."""
    base = fresh_path(df.sparkSession, "index")
    blocks = _segment(df, base, 0, doc, attributes, None)
    read = df.sparkSession.read.parquet
    placed = df.select(F.col(doc).alias("doc"), F.lit(0).alias("segment")).withColumn("block", _block("doc", blocks))
    return Index(doc, read(f"{base}/postings"), read(f"{base}/terms").select("token", "docs"), read(f"{base}/keys").select("key", "token"), None, placed)


# Searching


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, marked for broadcast if it is small; rows are of ids, words and numbers, some 50 bytes."""
    return small_or_shuffled(written(df, name))


def matches(index: Index, words: DataFrame) -> DataFrame:
    """(word, token, typos, docs) of the tokens that a word matches.

    A token matches if it is the word, or begins alike and is within the typos that the word's length allows.
    """
    own = _kept(words.select("word").distinct().withColumn("allowed", allowed(F.col("word"))), "own")
    same = index.terms.join(own.withColumnRenamed("word", "token"), "token").select(F.col("token").alias("word"), "token", F.lit(0).alias("typos"), "docs")
    asked = _kept(own.where("allowed > 0").select("word", "allowed", F.explode(keys("word", F.col("allowed"))).alias("key")), "asked")
    met = index.keys.join(asked, "key").where("word <> token").select("word", "token", "allowed").distinct()
    near = met.withColumn("typos", F.levenshtein("word", "token")).where("typos <= allowed")
    return same.unionByName(near.select("word", "token", "typos").join(index.terms, "token").select("word", "token", "typos", "docs"))


def _live(index: Index, rows: DataFrame, among: DataFrame | None) -> DataFrame:
    """``rows`` (doc, segment, ...) of documents that are in the index and in ``among`` (doc)."""
    if index.live is not None:
        rows = rows.join(small_or_shuffled(index.live), ["doc", "segment"], "left_semi")
    return rows if among is None else rows.join(small_or_shuffled(among), "doc", "left_semi")


def _with_segment(index: Index) -> DataFrame:
    return index.postings if "segment" in index.postings.columns else index.postings.withColumn("segment", F.lit(0))


def _listed(index: Index, asked: DataFrame, query: str, among: DataFrame | None) -> DataFrame:
    """(query, nth, doc, segment, block, typos, at) of all postings of the tokens in ``asked`` (query, nth, token, typos)."""
    rows = _with_segment(index).join(asked, "token").select(query, "nth", "typos", "segment", "block", F.explode("docs").alias("d"))
    return _live(index, rows.select(query, "nth", "typos", "segment", "block", "d.doc", "d.at"), among)


def query_words(queries: DataFrame, query: str, text: str) -> DataFrame:
    """(query, word, nth): distinct words of each query with their first place."""
    rows = queries.select(F.col(query), F.posexplode(F.split(F.lower(F.col(text)), SPLIT)).alias("nth", "word")).where("word <> ''")
    return rows.groupBy(query, "word").agg(F.min("nth").alias("nth"))


def _asked(index: Index, queries: DataFrame, query: str, text: str) -> DataFrame:
    """(query, nth, word, token, typos, docs, r, words, upto): the tokens of each query; r is the word's place by rarity.

    nth names the word within its query, upto is the number of documents of this word and all rarer ones.
    """
    words = written(query_words(queries, query, text), "words")
    found = _kept(matches(index, words), "matches")
    of_word = found.groupBy("word").agg(F.sum("docs").alias("n"))
    rare = Window.partitionBy(query).orderBy("n", "word")
    placed = words.join(of_word, "word").select(query, "nth", "word", F.row_number().over(rare).alias("r"), F.sum("n").over(rare.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    placed = placed.withColumn("words", F.count("*").over(Window.partitionBy(query)))
    return written(placed.join(found, "word"), "asked")


def _reduced(index: Index, asked: DataFrame) -> Index:
    """The index with the folders of the tokens that are asked for only."""
    buckets = [r[0] for r in asked.select(_bucket()).distinct().collect()]  # BUCKETS at most
    return index if len(buckets) == BUCKETS else index._replace(postings=index.postings.where(F.col("bucket").isin(*buckets)))


def _limits(index: Index, asked: DataFrame, query: str, top: int, among: DataFrame | None) -> DataFrame:
    """(query, read, least): words up to the place ``read`` by rarity are looked at in full, and a document that matches fewer than ``least`` of them cannot rank."""
    by_n = Window.partitionBy(query).orderBy(F.desc("n"))
    # What the documents of the rarest words match of these is a bound for all.
    seeds = _kept(asked.where((F.col("r") == 1) | (F.col("upto") <= SEED_DOCS)).select(query, "nth", "token", "typos"), "seeds")
    some = _listed(index, seeds, query, among).groupBy(query, "doc").agg(F.count_distinct("nth").alias("n"))
    bound = some.withColumn("k", F.row_number().over(by_n)).where(F.col("k") == top).select(query, F.col("n").alias("bound"))
    # Of the rarest words - bound + 1 + more words, a document that is not ruled out matches 1 + more.
    limits = asked.select(query, "nth", "r", "words", "upto").distinct().join(_kept(bound, "bound"), query, "left").withColumn("bound", F.coalesce("bound", F.lit(0)))
    needed = F.least("words", F.greatest(F.col("words") - F.col("bound") + 1, F.lit(1)))
    limits = limits.withColumn("needed", needed)
    base = limits.groupBy(query, "words", "bound", "needed").agg(F.max(F.when(F.col("r") == F.col("needed"), F.col("upto"))).alias("upto_needed"))
    limits = limits.join(base.select(query, "upto_needed"), query)
    read = limits.groupBy(query, "words", "bound").agg(F.max(F.when((F.col("r") <= F.col("needed")) | (F.col("upto") <= F.col("upto_needed") * MORE), F.col("r"))).alias("read"))
    return read.select(query, "read", (F.col("bound") - (F.col("words") - F.col("read"))).cast("int").alias("least"))


#: Cells of the table of a block's documents by the words of all queries, up to which it is made whole.
CELLS = 1 << 22
_FAR = np.iinfo(np.int64).max


def _least(key: np.ndarray, value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys that occur, ascending, and the least value of each."""
    names = None
    if size > CELLS:
        names, key = np.unique(key, return_inverse=True)
        size = len(names)
    out = np.full(size, _FAR)
    np.minimum.at(out, key, value)
    there = np.flatnonzero(out < _FAR)
    return there if names is None else names, out[there]


def _ranking(top: int | None, picked: bool) -> Callable[[pa.Table], pa.Table]:
    """Of a block's postings the documents that can be among the ``top`` of each query, ties included, with criteria and best places.

    A row is a token's postings and who asks for it, or, without a token, documents of the block that may be found (all others
    may not, if ``picked``).  A row without a document says how many postings were looked at for a query.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        lists, is_list = rows.column("docs").combine_chunks(), pc.is_valid(rows.column("token")).to_numpy()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = lists.flatten()
        coded = pc.struct_field(pairs, "doc").dictionary_encode()
        doc, place = coded.indices.to_numpy().astype(np.int64), pc.struct_field(pairs, "at").to_numpy()
        n_docs, begins = len(coded.dictionary), np.cumsum(sizes) - sizes
        may = np.ones(n_docs, bool)
        if picked:
            may[:] = False
            may[doc[np.repeat(~is_list, sizes)]] = True
        column = lambda c: rows.column(c).combine_chunks()
        entries = pc.fill_null(pc.list_value_length(column("q")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        queries = column("q").flatten().dictionary_encode()
        q, (nth, typos, rare, least) = queries.indices.to_numpy().astype(np.int64), (column(c).flatten().to_numpy(zero_copy_only=False) for c in ("nth", "typos", "rare", "least"))
        of, n_queries = np.repeat(np.arange(len(sizes)), entries), len(queries.dictionary)
        words, slot = np.unique(q * (1 << 31) + nth, return_inverse=True)
        need, looked = np.zeros(n_queries, np.int64), np.zeros(n_queries, np.int64)
        need[q] = least

        def cells(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """(entry, document, place) of the postings of some entries."""
            n = sizes[of[which]]
            np.add.at(looked, q[which], n)
            entry = np.repeat(which, n)
            at = begins[of[entry]] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            ok = may[doc[at]]
            return entry[ok], doc[at[ok]], place[at[ok]]

        def best(entry: np.ndarray, docs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return _least(docs * len(words) + slot[entry], (typos[entry].astype(np.int64) << (POS_BITS + 8)) + places, n_docs * len(words))

        of_word = (words >> 31).astype(np.int64)
        entry, docs, places = cells(np.flatnonzero(rare))
        key, _ = best(entry, docs, places)
        pair, n = np.unique(key // len(words) * n_queries + of_word[key % len(words)], return_counts=True)
        can = np.zeros(n_docs * n_queries, bool)
        can[pair[n >= need[pair % n_queries]]] = True
        some = can.reshape(n_docs, n_queries).any(0)
        more = cells(np.flatnonzero(~rare & some[q]))
        entry, docs, places = (np.concatenate(c) for c in zip((entry, docs, places), more, strict=True))
        ok = can[docs * n_queries + q[entry]]
        key, value = best(entry[ok], docs[ok], places[ok])
        # By document, query and the word's place in the query.
        d, w = key // len(words), key % len(words)
        group = d * n_queries + of_word[w]
        new = np.diff(group, prepend=-1) != 0
        starts = np.flatnonzero(new)
        off, at = value >> (POS_BITS + 8), value & ((1 << (POS_BITS + 8)) - 1)
        pos = at & ((1 << POS_BITS) - 1)
        # The first word has no distance and counts as the farthest.
        gap = np.where(new, FARTHEST, np.minimum(np.abs(np.diff(pos, prepend=0)), FARTHEST))
        total = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0, np.int64)
        count, typo, near, exact = total(np.ones(len(key), np.int64)), total(off), total(gap), total((off == 0).astype(np.int64))
        heavy = np.minimum.reduceat(at >> POS_BITS, starts) if len(starts) else total(off)
        of_query = group[starts] % n_queries
        keep = np.arange(len(starts))
        if top is not None and len(starts):
            order = np.lexsort((heavy, near, typo, -count, of_query))
            criteria = np.stack([of_query, count, typo, near, heavy])[:, order]
            first = np.flatnonzero(np.append(True, (criteria[:, 1:] != criteria[:, :-1]).any(0)))
            tie = first[np.searchsorted(first, np.arange(len(order)), "right") - 1]
            query_start = np.searchsorted(criteria[0], criteria[0])
            keep = np.sort(order[tie - query_start < top])
        size = np.diff(np.append(starts, len(key)))
        ends = np.cumsum(size[keep])
        inside = np.repeat(starts[keep] - (ends - size[keep]), size[keep]) + np.arange(ends[-1] if len(ends) else 0)
        values = [words[w[inside]] & ((1 << 31) - 1), off[inside], at[inside]]
        found = pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int32(), pa.int64()), strict=True)], ["nth", "typos", "at"])
        found = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), found)
        read = np.flatnonzero(looked)
        none = lambda t: pa.nulls(len(read), t)
        columns = {
            "query": pa.chunked_array([queries.dictionary.take(pa.array(of_query[keep])), queries.dictionary.take(pa.array(read))]),
            "doc": pa.chunked_array([coded.dictionary.take(pa.array(d[starts[keep]])), none(coded.dictionary.type)]),
            **{n: pa.chunked_array([pa.array(c[keep], pa.int64()), none(pa.int64())]) for n, c in {"words": count, "typos": typo, "proximity": near, "attribute": heavy, "exact": exact}.items()},
            "found": pa.chunked_array([found, none(found.type)]),
            "read": pa.chunked_array([pa.nulls(len(keep), pa.int64()), pa.array(looked[read], pa.int64())]),
        }
        return pa.table(columns)

    return run


def _candidates(index: Index, asked: DataFrame, query: str, top: int | None, among: DataFrame | None) -> DataFrame:
    """(query, doc, words, typos, proximity, attribute, exact, found, read) as ``_ranking`` gives them for all blocks."""
    if top is None:
        who = asked.select("token", query, "nth", "typos", F.lit(True).alias("rare"), F.lit(1).alias("least"))
    else:
        limits = _kept(_limits(index, asked, query, top, among), "limits")
        who = asked.join(limits, query).select("token", query, "nth", "typos", (F.col("r") <= F.col("read")).alias("rare"), "least")
    # Short arrays side by side: they are copied to every block that has the token.
    each = F.sort_array(F.collect_list(F.struct(query, "nth", "typos", "rare", "least")))
    who = who.groupBy("token").agg(each.alias("e")).select("token", *[F.col("e")[c].alias(n) for n, c in (("q", query), ("nth", "nth"), ("typos", "typos"), ("rare", "rare"), ("least", "least"))])
    who = _kept(who, "who")
    rows = _with_segment(index).join(small_or_shuffled(written(who.select("token"), "tokens")), "token", "left_semi").select("segment", "block", "token", "docs")
    may = index.placed if among is not None else index.live
    if may is not None:
        may = may if among is None else may.join(small_or_shuffled(among), "doc", "left_semi")
        docs = F.collect_list(F.struct("doc", F.lit(0).cast("long").alias("at"))).alias("docs")
        rows = rows.unionByName(may.groupBy(F.col("segment").cast("int").alias("segment"), "block").agg(docs).withColumn("token", F.lit(None).cast("string")))
    placed = rows.repartition("segment", "block").sortWithinPartitions("segment", "block").join(who, "token", "left")
    doc_type, query_type = index.placed.schema["doc"].dataType.simpleString(), asked.schema[query].dataType.simpleString()
    schema = f"query {query_type}, doc {doc_type}, words long, typos long, proximity long, attribute long, exact long, found array<struct<nth:int,typos:int,at:bigint>>, read long"
    found = placed.groupBy("segment", "block").applyInArrow(_ranking(top, may is not None), schema)
    return written(found.withColumnRenamed("query", query), "candidates")


def matching(index: Index, queries: DataFrame, query: str, text: str) -> DataFrame:
    """(query, doc, words): every document that matches a word of a query, and how many."""
    found = _candidates(index, _asked(index, queries, query, text), query, None, None).where("doc is not null")
    return found.select(query, F.col("doc").alias(index.doc), "words")


def search(index: Index, queries: DataFrame, query: str, text: str, top: int | None, among: DataFrame | None = None, sort: Column | None = None) -> Hits:
    """The ``top`` documents of each query (None: all) with rank and criteria.

    Criteria in order: more words matched, fewer typos, shorter distance of words that follow each other in the query, heavier
    attribute, ``sort``, more exact words, smaller id.  ``among`` has the documents that may be found and the columns that ``sort`` is over.
    """
    asked = _asked(index, queries, query, text)
    index = _reduced(index, asked)
    allowed_docs = None if among is None else written(among.select(F.col(index.doc).alias("doc")).distinct(), "among")
    found = _candidates(index, asked, query, top, allowed_docs)
    scored = found.where("doc is not null")
    best = scored.select(query, "doc", F.explode("found").alias("f")).select(
        query, "doc", "f.nth", "f.typos", F.shiftright("f.at", POS_BITS).alias("attribute"), F.col("f.at").bitwiseAND(F.lit((1 << POS_BITS) - 1)).alias("pos")
    )
    scored = scored.drop("found", "read")
    scored = scored.withColumnRenamed("doc", index.doc)
    if sort is not None:
        more = [c for c in among.columns if c not in scored.columns]
        scored = scored.join(among.select(index.doc, *more), index.doc)
    order = [F.desc("words"), "typos", "proximity", "attribute", *([] if sort is None else [sort]), F.desc("exact"), index.doc]
    scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(*order)).cast("long"))
    total = asked.groupBy(query).agg(F.sum("docs").alias("all"))
    reading = total.join(found.groupBy(query).agg(F.sum("read").alias("read")), query).select(query, "read", "all")
    return Hits(scored if top is None else scored.where(F.col("rank") <= top), best, asked.select(query, "nth", "token", "typos"), reading)
