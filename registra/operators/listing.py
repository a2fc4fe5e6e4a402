"""Listings: allow-listed filters, sort keys, offset and keyset pages, lookups and field selection."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LIMIT, DEFAULT_LIMIT = 100, 20
_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


@dataclass(frozen=True)
class Listing:
    """What may be filtered and sorted on, and what a listing shows (never a body)."""

    columns: Sequence[str]
    equal: Sequence[str] = ()
    ranges: Mapping[str, str] = field(default_factory=dict)  # parameter to its column: from, to
    flags: Sequence[str] = ()
    sorts: Sequence[str] = ()
    key: str = "identifier"


def page_bounds(limit: int | None = None, offset: int | None = None, most: int = MAX_LIMIT) -> tuple[int, int]:
    """Validated limit (1 to ``most``) and offset (0 or more)."""
    limit, offset = DEFAULT_LIMIT if limit is None else int(limit), 0 if offset is None else int(offset)
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be from 1 to {most}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    return limit, offset


def flag(value: bool | str | None) -> bool | None:
    """A boolean parameter; the text 'false' is false."""
    if value is None or isinstance(value, bool):
        return value
    if value.lower() in ("true", "1"):
        return True
    if value.lower() in ("false", "0"):
        return False
    raise ValueError(f"{value!r} is no boolean")


def predicate(spec: Listing, params: Mapping[str, object]) -> Column | None:
    """AND of all known filters; unknown names and None are ignored."""
    parts: list[Column] = []
    for name, value in params.items():
        if value is None:
            continue
        if name in spec.equal:
            parts.append(F.col(name) == F.lit(value))
        elif name in spec.flags:
            parts.append(F.col(name) == F.lit(flag(value)))
        elif name in spec.ranges:
            if not _DATE.fullmatch(str(value)):
                raise ValueError(f"{name} must be a date like 2024-01-31")
            column = F.col(spec.ranges[name])
            parts.append(column >= value if name.endswith("_from") else column <= value)
    return reduce(lambda a, b: a & b, parts) if parts else None


def filtered(df: DataFrame, spec: Listing, params: Mapping[str, object]) -> DataFrame:
    where = predicate(spec, params)
    return df if where is None else df.where(where)


def sort_key(spec: Listing, sort: str | None) -> tuple[str, bool]:
    """(column, descending); a name outside the allow-list means the key ascending."""
    name = (sort or "").removeprefix("-")
    return (name, sort.startswith("-")) if name in spec.sorts else (spec.key, False)


def ordering(spec: Listing, sort: str | None) -> list[Column]:
    """Sort key and the listing's key, nulls lowest."""
    name, down = sort_key(spec, sort)
    first = F.col(name).desc_nulls_last() if down else F.col(name).asc_nulls_first()
    return [first] if name == spec.key else [first, F.col(spec.key).asc_nulls_first()]


def offset_page(df: DataFrame, spec: Listing, params: Mapping[str, object], sort: str | None, limit: int, offset: int = 0) -> DataFrame:
    """One page with total and has_more; the total is an aggregate of its own and reads filter columns only."""
    limit, offset = page_bounds(limit, offset)
    rows = filtered(df, spec, params)
    page = rows.select(*spec.columns).orderBy(*ordering(spec, sort)).offset(offset).limit(limit)
    total = rows.agg(F.count("*").alias("total"))
    return page.join(F.broadcast(total)).withColumn("has_more", F.col("total") > offset + limit)  # one row


def keyset_page(df: DataFrame, spec: Listing, params: Mapping[str, object], sort: str | None, limit: int, cursor: object = None, tie: object = None) -> DataFrame:
    """Rows after ``cursor``, one more than ``limit`` so that a caller sees whether more follow.

    With ``tie``, the key of the last row seen, rows that share its sort value are not lost; without it they
    are skipped, as are rows with a null sort value.
    """
    limit, _ = page_bounds(limit)
    name, down = sort_key(spec, sort)
    rows = filtered(df, spec, params)
    if cursor is not None:
        value = F.lit(cursor).cast(df.schema[name].dataType)
        after = F.col(name) < value if down else F.col(name) > value
        if tie is not None:
            after = after | ((F.col(name) == value) & (F.col(spec.key) > F.lit(tie)))
        rows = rows.where(after)
    return rows.select(*spec.columns).orderBy(*ordering(spec, sort)).limit(limit + 1)


def lookup(df: DataFrame, fields: str | Sequence[str], body: Sequence[str], always: Sequence[str], **equal: object) -> DataFrame:
    """Rows with the given values; ``fields`` is 'all', 'metadata', 'body' or a list.  Bodies not asked for aren't read."""
    names = df.columns
    if fields == "metadata":
        names = [c for c in names if c not in body]
    elif fields == "body":
        names = [c for c in names if c in body or c in always]
    elif fields != "all":
        names = [c for c in names if c in fields or c in always]
    rows = df
    for name, value in equal.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows.select(*names)


def within_budget(df: DataFrame, max_bytes: int) -> DataFrame:
    """Rows whose JSON form takes at most ``max_bytes``."""
    return df.where(F.octet_length(F.to_json(F.struct("*"))) <= max_bytes)
