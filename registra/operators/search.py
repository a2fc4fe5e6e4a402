"""Full-text search: ranking by a written index, filters, sort, facets over all hits, highlights and snippets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.operators import index
from registra.operators.index import FARTHEST, ONE_TYPO, SPLIT, TWO_TYPOS, Hits, tokens

__all__ = ["FARTHEST", "ONE_TYPO", "SPLIT", "TWO_TYPOS", "tokens"]

#: Fields that a search may be sorted by.
SORT_FIELDS = ("publication_date", "title_number", "identifier", "document_number")
#: Fields that facets may be asked for.
FACET_FIELDS = ("source", "title_number", "document_type", "agency", "status", "granularity", "publication_date")


def filtered(df: DataFrame, source: str | None = None, title_number: int | None = None, document_type: str | None = None, agency: str | None = None, status: str | None = None, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Documents that fulfil all given conditions; quotes, backslashes and line ends are taken out of agency and status.

    Applied before ``ranked``, so Spark prunes what it scans.
    """
    clean = lambda text: None if text is None else "".join(c for c in text if c not in '"\\\n\r')
    equal = {"source": source, "title_number": title_number, "document_type": document_type or None, "agency": clean(agency or None), "status": clean(status or None)}
    for name, value in equal.items():
        if value is not None and value != "":
            df = df.where(F.col(name) == value)
    if date_from:
        df = df.where(F.col("publication_date") >= date_from)
    if date_to:
        df = df.where(F.col("publication_date") <= date_to)
    return df


def sort_order(sort: str | None) -> Column | None:
    """The order of a sort field ('-' in front: descending), nulls last; None for relevance and for fields that may not be sorted by."""
    field = (sort or "").removeprefix("-")
    if field not in SORT_FIELDS:
        return None
    return F.col(field).desc_nulls_last() if (sort or "").startswith("-") else F.col(field).asc_nulls_last()


def ranked(df: DataFrame, doc: str, attributes: Sequence[str], queries: DataFrame, query: str, text: str, top: int | None, sort: str | None = None) -> DataFrame:
    """The ``top`` documents of each query (None: all) with rank and criteria, by an index of ``df``; see ``index.search``.

    A sort field of ``df`` ranks after the attribute and before exact words, ahead of any cut.
    """
    order = sort_order(sort)
    return index.search(index.built(df, doc, attributes), queries, query, text, top, None if order is None else df, order).hits


def allowed_facets(asked: str | None) -> list[str]:
    """The facets of a comma-separated list that may be asked for; by default source and status."""
    if asked is None:
        return ["source", "status"]
    return [f for f in (part.strip() for part in asked.split(",")) if f in FACET_FIELDS]


def facets(hits: DataFrame, fields: Sequence[str], query: str | None = None) -> DataFrame:
    """(query, facet, value, n) over all hits, in one pass by grouping sets; without ``query`` over all together."""
    key = [query] if query else []
    if not fields:
        return hits.limit(0).select(*key, F.lit("").alias("facet"), F.lit("").alias("value"), F.lit(0).cast("long").alias("n"))
    # A field of its own for each set, so that a null value is told from a field that is not of the set.
    cols = [F.struct(F.col(f).cast("string").alias("value")).alias(f"_{f}") for f in fields]
    each = hits.select(*key, *cols).groupingSets([[*key, f"_{f}"] for f in fields], *key, *[f"_{f}" for f in fields]).agg(F.count("*").alias("n"))
    named = [F.when(F.col(f"_{f}").isNotNull(), F.struct(F.lit(f).alias("facet"), F.col(f"_{f}.value").alias("value"))) for f in fields]
    return each.select(*key, F.coalesce(*named).alias("p"), "n").select(*key, "p.facet", "p.value", "n")


def snippets(found: Hits, df: DataFrame, doc: str, text: str, query: str, attribute: int, words: int) -> DataFrame:
    """(query, doc, snippet): ``words`` words of each hit around the first that matched in ``text``, matched ones between <mark> and </mark>.

    A word is marked if the query matches it, typos included.  A hit that matches in other attributes only begins with the text.  ``attribute`` is
    the place of ``text`` among the attributes of the index.
    """
    first = F.min(F.when(F.col("attribute") == attribute, F.col("pos"))).alias("first")
    places = found.occurrences.groupBy(query, F.col("doc").alias(doc)).agg(first)
    marked = found.tokens.groupBy(query).agg(F.collect_set("token").alias("tokens"))
    rows = found.hits.select(query, doc).join(places, [query, doc]).join(marked, query).join(df.select(doc, F.col(text).alias("_text")), doc)
    # A piece is a word and what stands between it and the next one; a text that begins with something else has that as its first piece.
    pieces = F.split("_text", r"(?<=[^\p{L}\p{N}])(?=[\p{L}\p{N}])")
    start = F.greatest(F.coalesce("first", F.lit(0)) - words // 2, F.lit(0)) + 1
    word = lambda p: F.regexp_extract(p, r"^[\p{L}\p{N}]+", 0)
    mark = lambda p: F.when(F.array_contains("tokens", F.lower(word(p))), F.regexp_replace(p, r"^([\p{L}\p{N}]+)", "<mark>$1</mark>")).otherwise(p)
    return rows.select(query, doc, F.array_join(F.transform(F.slice(pieces, start, words), mark), "").alias("snippet"))


def highlighted(text: Column, words: Sequence[str]) -> Column:
    """Words between <mark> and </mark>, whatever their case; no letter or digit of any script stands next to them."""
    return F.regexp_replace(text, r"(?i)(?<![\p{L}\p{N}])(" + "|".join(sorted(words)) + r")(?![\p{L}\p{N}])", "<mark>$1</mark>")


def cropped(text: Column, words: Sequence[str], length: int) -> Column:
    """``length`` characters around the first word found, or from the start."""
    lower = F.lower(text)
    places = [F.nullif(F.locate(w, lower), F.lit(0)) for w in words]
    first = reduce(F.least, places) if len(places) > 1 else places[0]
    start = F.greatest(F.coalesce(first, F.lit(1)) - length // 2, F.lit(1))
    return F.substr(text, start, F.lit(length))


def document(identifier: Column, heading: Column, body: Column, hierarchy: Sequence[Column], base: str, **more: Column) -> list[Column]:
    """Columns of a search document: id, identifier, heading, body, hierarchy, url and others."""
    from registra.functions import text

    columns = [
        text.sanitize_id(identifier).alias("id"),
        identifier.alias("identifier"),
        heading.alias("heading"),
        text.search_body(body).alias("body"),
        F.array_compact(F.array(*hierarchy)).alias("hierarchy"),
        F.concat(F.lit(base), identifier).alias("url"),
    ]
    return columns + [c.alias(n) for n, c in more.items()]
