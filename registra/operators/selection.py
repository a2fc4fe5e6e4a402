"""What is taken of the sources: kinds and dates of register documents, months of paths, dates of titles, valid routes, orders of navigation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.functions import dates, identifiers

GRANULARITIES = ("section", "part", "chapter", "title")
#: The number of segments of a route and what it leads to, by source.
ROUTES = {"usc": ("title", "chapter", "section"), "ecfr": ("title", "chapter", "part", "section"), "fr": ("year", "month", "document")}


def granularities(one: str | None = None, several: Sequence[str] | None = None, known: Sequence[str] = GRANULARITIES) -> list[str]:
    """The granularities asked for, by one name or a list; neither means sections."""
    if one is not None and several is not None:
        raise ValueError("either one granularity or a list of them")
    chosen = ["section" if one is None else one] if several is None else list(several)
    if not chosen:
        raise ValueError("the list of granularities is empty")
    if len(set(chosen)) < len(chosen):
        raise ValueError("a granularity is listed twice")
    if unknown := [g for g in chosen if g not in known]:
        raise ValueError(f"unknown granularities: {', '.join(unknown)}")
    return chosen


def in_months(path: Column, first: str | None, last: str | None) -> Column:
    """Whether a path's month is within the months of two dates; paths without a date are."""
    month = F.substring(dates.path_date(path), 1, 7)
    within = F.lit(True)
    if first:
        within = within & (month >= first[:7])
    if last:
        within = within & (month <= last[:7])
    return F.coalesce(within, F.lit(True))


def register_selected(docs: DataFrame, types: Sequence[str] = (), first: str | None = None, last: str | None = None) -> DataFrame:
    """Register documents of some types and days.

    ``docs`` has document_type, publication_date and has_sidecar; only a sidecar's date is a day, so documents
    without one are left to ``in_months``.
    """
    out = docs.where(F.col("document_type").isin(list(types))) if types else docs
    within = F.lit(True)
    if first:
        within = within & (F.col("publication_date") >= first)
    if last:
        within = within & (F.col("publication_date") <= last)
    return out.where(~F.col("has_sidecar") | within)


def title_dates(titles: DataFrame, date: str, importing: bool) -> DataFrame:
    """(title_number, date): the day of which a title is taken.

    ``titles`` has title_number, up_to_date_as_of (may be null) and processing.  While the corpus is being imported its date is
    the day before; a title that is being processed has its own date, others the earlier of both.
    """
    overall = F.date_format(F.date_sub(F.to_date(F.lit(date)), 1 if importing else 0), "yyyy-MM-dd")
    own = F.col("up_to_date_as_of")
    taken = F.when(F.col("processing") & own.isNotNull(), own).otherwise(F.least(own, overall))
    return titles.select("title_number", taken.alias("date"))


def by_chapter(parts: DataFrame, chapter: str, *sums: Column) -> tuple[DataFrame, Column]:
    """(groups of the rows that lie in a chapter, a Column that counts the rows left out)."""
    return parts.where(F.col(chapter).isNotNull()).groupBy(chapter).agg(*sums), F.count_if(F.col(chapter).isNull())


def number_key(column: Column) -> Column:
    """Order of numbers like '240.10b': the number that a text begins with, 0 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(column, r"^\s*([+-]?\d*\.?\d+)", 1), F.lit("")).try_cast("double"), F.lit(0.0))


def chapter_key(column: Column) -> Column:
    """Order of chapters with Roman numerals."""
    return identifiers.roman(column)


def snapshot_or_live(snapshot: DataFrame, live: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Values of the snapshot, where it has none those counted live."""
    kept = snapshot.select(*key, F.col(value).alias("_kept"))
    both = kept.join(live.select(*key, F.col(value).alias("_live")), list(key), "full")
    return both.select(*key, F.coalesce("_kept", "_live").alias(value))


def route(source: str, slug: Column) -> Column:
    """What a route leads to by its number of segments; null if there is no such number or a segment is not valid."""
    kinds, segments = ROUTES[source], F.split(slug, "/")
    kind = F.try_element_at(F.array(*map(F.lit, kinds)), F.size(segments))
    if source == "fr":
        patterns = (r"^\d{4}$", r"^\d{2}$", r"^\w[\w-]+$")
        valid = F.lit(True)
        for i, pattern in enumerate(patterns):
            valid = valid & F.coalesce(F.get(segments, i).rlike(pattern), F.lit(True))
    else:
        valid = F.forall(segments, lambda s: s.rlike(r"^(title|chapter|part|section)-[\w.-]+$"))
    safe = ~F.exists(segments, lambda s: s.contains("..") | s.contains("\0"))
    return F.when(valid & safe, kind)
