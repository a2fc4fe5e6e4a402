"""Markup scans by regular expressions that explode into rows; nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_counts(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, name, opened, closed): how often each element is opened and closed."""
    tags = F.regexp_extract_all(F.col(html), F.lit("<(/?[a-zA-Z][a-zA-Z0-9]*)"), 1)
    rows = df.select(key, F.explode(tags).alias("tag"))
    closing = F.col("tag").startswith("/")
    name = F.lower(F.regexp_replace("tag", "^/", ""))
    return rows.groupBy(key, name.alias("name")).agg(F.count_if(~closing).alias("opened"), F.count_if(closing).alias("closed"))


def links(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, href) of the anchors."""
    return df.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit('<a [^>]*href="([^"]*)"'), 1)).alias("pos", "href"))


def headings(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, depth, heading) of h1 to h6, tags inside them dropped."""
    pattern = F.lit("(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>")
    pairs = F.arrays_zip(F.regexp_extract_all(F.col(html), pattern, 1).alias("d"), F.regexp_extract_all(F.col(html), pattern, 2).alias("t"))
    rows = df.select(key, F.posexplode(pairs).alias("pos", "h"))
    return rows.select(key, "pos", F.col("h.d").cast("int").alias("depth"), F.trim(F.regexp_replace(F.col("h.t"), "<[^>]*>", "")).alias("heading"))


def url_parts(df: DataFrame, url: str) -> DataFrame:
    """``df`` with scheme, host, path and depth; parts that are missing are null."""
    piece = lambda pattern: F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]+([^?#]*)", 1)
    return df.select(
        "*", piece(r"^([a-z]+)://").alias("scheme"), piece(r"^[a-z]+://([^/?#:]+)").alias("host"), F.nullif(path, F.lit("")).alias("path"), F.size(F.split(path, "/")).cast("long").alias("depth")
    )
