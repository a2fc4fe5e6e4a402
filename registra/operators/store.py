"""The documents table: incremental ingest, pruning and cursors over a Parquet table in hashed buckets of its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.operators import relations
from registra.shared import drop_written, remove, written

#: Folders of a table; an ingest rewrites those that its keys fall into.
BUCKETS, BUCKET = 64, "_bucket"


def advanced(old: DataFrame, new: DataFrame, key: str, cursor: str) -> DataFrame:
    """Cursors that never go back: the greater of both sides for each key."""
    return old.select(key, cursor).unionByName(new.select(key, cursor)).groupBy(key).agg(F.max(cursor).alias(cursor))


def ingested(stored: DataFrame, found: DataFrame, key: str, digest: str, prune: bool, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(the new table, a row for each key with its outcome) after an incremental ingest."""
    outcome = relations.changes(stored, found, key, digest)
    fresh = found.join(outcome.where("outcome in ('new', 'updated')").select(key), key, "left_semi")
    table = relations.upserted(stored, fresh, key, order)
    if prune:
        table = table.join(outcome.where("outcome = 'pruned'").select(key), key, "left_anti")
    return table, outcome


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table; None if nothing was ingested yet."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return None
    return spark.read.parquet(path).drop(BUCKET)


def ingest(found: DataFrame, path: str, key: str, digest: str, prune: bool = False, order: list[Column] | None = None) -> dict[str, int]:
    """Upsert what is new or changed into the table at ``path``; counts by outcome.

    Of rows that repeat a key the first in ``order`` counts (by default that with the greatest digest).  Only the buckets of
    the given keys are read and, as dynamic partitions of a plain Parquet table, written again.  ``prune`` also drops
    what was not found, for which the whole table is read and written.
    """
    spark = found.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
    fresh = written(relations.last_wins(found, [key], order or [F.desc(digest)]).withColumn(BUCKET, bucket), "found")
    stored = spark.read.parquet(path) if read(spark, path) is not None else None
    if stored is None:
        fresh.write.partitionBy(BUCKET).parquet(path)
        counts = {"new": fresh.count()}
    else:
        if not prune:
            stored = stored.where(F.col(BUCKET).isin([r[0] for r in fresh.select(BUCKET).distinct().collect()]))  # BUCKETS at most
        table, outcome = ingested(stored, fresh, key, digest, prune, order or [F.desc(digest)])
        counts = {r["outcome"]: r["count"] for r in outcome.groupBy("outcome").count().collect() if prune or r["outcome"] != "pruned"}
        if counts.keys() - {"unchanged"}:
            buckets = lambda t: {r[0] for r in t.select(BUCKET).distinct().collect()}  # noqa: E731  BUCKETS at most
            before = buckets(stored)
            # Written apart first, as the table can't be read while it is overwritten.
            staged = written(table, "staged")
            staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
            # Folders that nothing is left in go last: a run that is stopped leaves a table, and can be repeated.
            for bucket in before - buckets(staged):
                remove(spark, f"{path}/{BUCKET}={bucket}")
            drop_written(staged)
    drop_written(fresh)
    return counts
