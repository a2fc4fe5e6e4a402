"""Dates as Column expressions; dates of the data model are ISO texts, compared as such."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_part(column: Column) -> Column:
    """The date of an ISO timestamp; an empty or null text is 'unknown'."""
    return F.coalesce(F.nullif(F.split_part(column, F.lit("T"), F.lit(1)), F.lit("")), F.lit("unknown"))


def filed_document(column: Column) -> Column:
    """Struct of document_number and publication_date from '[FR Doc. N Filed M-D-YY; …]'.

    Publication is the day after filing.  Two-digit years below 50 are of this century.  Days that do not
    exist give no date.
    """
    filed = r"Filed\s+(\d{1,2})-(\d{1,2})-(\d{2})\b"
    piece = lambda g: F.regexp_extract(column, filed, g).try_cast("int")
    year = F.when(piece(3) < 50, 2000 + piece(3)).otherwise(1900 + piece(3))
    iso = F.concat_ws("-", year.cast("string"), F.lpad(F.regexp_extract(column, filed, 1), 2, "0"), F.lpad(F.regexp_extract(column, filed, 2), 2, "0"))
    day = F.when(column.rlike(filed), F.try_to_date(iso, "yyyy-MM-dd"))
    return F.struct(
        F.nullif(F.regexp_extract(column, r"(?i)FR\s+Doc\.\s+([\w-]+)", 1), F.lit("")).alias("document_number"),
        F.date_format(F.date_add(day, 1), "yyyy-MM-dd").alias("publication_date"),
    )


def path_date(column: Column) -> Column:
    """Date in a path: FR-YYYY-MM-DD.xml as it is, YYYY/MM/x.xml as the month's first day."""
    day = F.nullif(F.regexp_extract(column, r"FR-(\d{4}-\d{2}-\d{2})\.xml$", 1), F.lit(""))
    month = F.regexp_extract(column, r"(\d{4})/(\d{2})/[^/]*\.xml$", 1)
    first = F.concat_ws("-", month, F.regexp_extract(column, r"(\d{4})/(\d{2})/[^/]*\.xml$", 2), F.lit("01"))
    return F.coalesce(day, F.when(month != "", first))


def month_bounds(year: Column, month: Column) -> tuple[Column, Column]:
    """First day of a month and of the next one, for half-open ranges that statistics can prune."""
    start = F.make_date(year, month, F.lit(1))
    return start, F.add_months(start, 1)


def month_chunks(start: Column, end: Column) -> Column:
    """Array of (chunk_start, chunk_end) that cut a range of days at month ends."""
    firsts = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    return F.transform(firsts, lambda m: F.struct(F.greatest(m, start).alias("chunk_start"), F.least(F.last_day(m), end).alias("chunk_end")))


def days(start: Column, end: Column) -> Column:
    return F.sequence(start, end, F.expr("interval 1 day"))


def month_name(month: Column) -> Column:
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM")
