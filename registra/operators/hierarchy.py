"""Roll-ups: titles and chapters, years and months, source statistics, sections of parents, navigation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.shared import written


def titles(df: DataFrame, title: Sequence[str], chapter: str, positive: str, approximate: bool = False) -> DataFrame:
    """Documents, distinct chapters (nulls not counted) and whether any is positive law, for each title."""
    distinct = F.approx_count_distinct(chapter) if approximate else F.count_distinct(F.col(chapter))
    return df.groupBy(*title).agg(F.count("*").alias("document_count"), distinct.alias("chapter_count"), F.max(positive).alias("positive_law"))


def chapters(df: DataFrame, chapter: Sequence[str]) -> DataFrame:
    """Documents of each chapter; nulls are a group."""
    return df.groupBy(*chapter).agg(F.count("*").alias("document_count"))


def year_months(df: DataFrame, date: Column) -> DataFrame:
    """Documents of each year and month."""
    dated = df.where(date.isNotNull())
    return dated.groupBy(F.year(date).cast("long").alias("year"), F.month(date).cast("long").alias("month")).agg(F.count("*").alias("count"))


def years_nested(counts: DataFrame) -> DataFrame:
    """Each year with its total and its months in order, from ``year_months``."""
    months = F.sort_array(F.collect_list(F.struct("month", "count")))
    return counts.groupBy("year").agg(F.sum("count").alias("total"), months.alias("months"))


def month_rows(df: DataFrame, date: str, year: int, month: int) -> DataFrame:
    """Rows of one month by a half-open range, which statistics can prune."""
    start = F.lit(f"{year:04d}-{month:02d}-01").cast("date")
    return df.where((F.col(date) >= start.cast("timestamp")) & (F.col(date) < F.add_months(start, 1).cast("timestamp")))


def source_stats(df: DataFrame, source: str, title: str, updated: str) -> DataFrame:
    return df.groupBy(source).agg(
        F.count("*").alias("document_count"), F.count_distinct(F.col(title)).alias("title_count"), F.max(updated).alias("last_updated")
    )


def with_registry(counts: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Every registered source with its count, 0 if it has none; the registry is the small, preserved side."""
    return registry.join(counts, key, "left").withColumn("document_count", F.coalesce("document_count", F.lit(0)).cast("long"))


def section_rollup(df: DataFrame, parent: Sequence[str], order: Sequence[str], text: Column, listed: Sequence[str]) -> DataFrame:
    """Sections of each parent in order, with their count and the sum of their token estimates."""
    rows = df.withColumn("_tokens", F.ceil(F.length(text) / 4).cast("long"))
    entries = F.sort_array(F.collect_list(F.struct(*order, *[c for c in listed if c not in order])))
    return rows.groupBy(*parent).agg(entries.alias("sections"), F.count("*").alias("section_count"), F.sum("_tokens").alias("token_estimate"))


def first_seen(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Groups with the place at which each was first seen."""
    seen = df.groupBy(*group).agg(F.min(order).alias("first_seen"))
    return seen


def month_types(df: DataFrame, date: str, kind: str, default: str = "unknown") -> DataFrame:
    """Documents of each month with a map of their types."""
    parts = df.groupBy(F.year(date).cast("long").alias("year"), F.month(date).cast("long").alias("month"), F.coalesce(F.col(kind), F.lit(default)).alias("kind"))
    counts = parts.agg(F.count("*").alias("n"))
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "n"))))
    return counts.groupBy("year", "month").agg(F.sum("n").alias("documents"), entries.alias("types"))


def merged(df: DataFrame, directory: str, order: Sequence[str], items: str) -> DataFrame:
    """Entries that share a directory, their item lists put together in order."""
    lists = F.sort_array(F.collect_list(F.struct(*order, items)))
    return df.groupBy(directory).agg(F.flatten(F.transform(lists, lambda e: e[items])).alias(items))


def most_frequent(df: DataFrame, value: str, order: str) -> DataFrame:
    """The most frequent value, of equals the first seen; a value is counted before any sort."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.orderBy(F.desc("n"), "first", value).limit(1).select(value, "n")


def chunks(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """``df`` with the number of the chunk of ``size`` rows it falls into, in a global order.

    Two passes: rows are ranked inside range partitions and written, so that both passes see the same ranks; the sizes of
    the partitions (a number for each) are then summed up, so no task holds all rows.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    ranged = written(ranged.withColumn("_at", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("long"), 33)), "ranged")
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = ranged.join(F.broadcast(starts.select("_p", "_start")), "_p")  # a row for each partition
    return numbered.withColumn("row", F.col("_start") + F.col("_at")).withColumn("chunk", F.expr(f"row div {size}")).drop("_p", "_at", "_start")
