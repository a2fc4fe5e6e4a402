"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.llm.common import free_name, written

#: A line on more than RATIO of its host's pages, and on MIN_PAGES of them at least, is boilerplate.  On a host of less
#: than 1 / RATIO pages every line would exceed RATIO, so a few pages must have it before a share says anything.
RATIO, MIN_PAGES = 0.01, 5
#: Lines in a part of a host's set, on average; parts are told by the hash of a line, so that a line is compared with few others.
PART_LINES = 4
#: Bytes of a table that may be broadcast, and bytes that a row or a line of a set has at most besides the host's name.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 160


def _joinable(side: DataFrame, rows: DataFrame) -> DataFrame:
    """``side`` with a broadcast hint if the (host) ``rows`` that it is made of come to BROADCAST_BYTES at most, else as it is."""
    size = rows.agg(F.sum(F.octet_length("host") + F.lit(ROW_BYTES))).first()[0] or 0
    return F.broadcast(side) if size <= BROADCAST_BYTES else side


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line, pages, total): MD5 of each boilerplate line of each host.

    Lines are cut at \\n and stripped of blanks at both ends; blank lines are none.  A page counts once
    for a line, however often it has it.
    """
    rows = pages.select(F.coalesce(host.cast("string"), F.lit("")).alias("host"), text.cast("string").alias("text"))
    digests = F.expr("transform(array_distinct(filter(transform(split(text, '\\n'), l -> trim(l)), l -> l <> '')), l -> unhex(md5(l)))")
    counts = rows.select("host", F.explode(digests).alias("line")).groupBy("host", "line").agg(F.count("*").alias("pages"))
    totals = written(rows.groupBy("host").agg(F.count("*").alias("total")), "hosts")
    often = counts.where(F.col("pages") >= min_pages).join(_joinable(totals, totals), "host")
    return often.where(F.col("pages") > F.col("total") * F.lit(ratio))


def drop_boilerplate(
    pages: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, dropped_col: str | None = None
) -> DataFrame:
    """``pages`` without the lines that exceed ``ratio`` on their host and are on ``min_pages`` of its pages.

    The pages that hold a line are divided by all pages of the host.  The other columns and the order of
    the kept lines stay; ``dropped_col`` adds the number of dropped lines, in place of a column of that name.  A null text stays null and
    counts as a page; a null host is the host ''.  Repeated rows are pages of their own.  An empty table
    gives an empty one.

    The lines to drop are gathered in one set for each host, of at most (lines per page) / ratio entries, in parts by hash
    whose number follows the entries, and joined to the pages by host, so texts are not shuffled while all sets together are
    small enough to broadcast, by their bytes.
    """
    host_name, set_name, kept_name = (free_name(pages.columns, n) for n in ("_host", "_lines", "_kept"))
    found = written(boilerplate(pages, host, F.col(f"`{text_col}`"), ratio, min_pages), "boilerplate")
    part = lambda digest, n: F.pmod(F.xxhash64(digest), n).cast("int")
    n_parts = F.ceil(F.count("*").over(Window.partitionBy("host")) / PART_LINES).cast("int")
    parts = found.withColumn("n", n_parts).groupBy("host", "n", part(F.col("line"), F.col("n")).alias("part")).agg(F.collect_set("line").alias("lines"))
    by_part = parts.groupBy("host", "n").agg(F.map_from_entries(F.collect_list(F.struct("part", "lines"))).alias("m"))
    none = F.array().cast("array<binary>")
    filled = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda p: F.coalesce(F.try_element_at("m", p), none))
    sets = written(by_part.select(F.col("host").alias(host_name), filled.alias(set_name)), "sets")
    bad, kept_col = F.col(set_name), F.col(kept_name)
    joined = pages.join(_joinable(sets, found), F.coalesce(host.cast("string"), F.lit("")) == F.col(host_name), "left")
    lines = F.split(F.col(f"`{text_col}`").cast("string"), "\n")
    is_bad = lambda digest: F.array_contains(F.get(bad, part(digest, F.size(bad))), digest)
    kept = F.filter(lines, lambda l: ~is_bad(F.unhex(F.md5(F.trim(l)))) | (F.trim(l) == ""))
    kept = F.when(bad.isNull(), lines).otherwise(kept)
    stay = [c for c in pages.columns if not dropped_col or c.lower() != dropped_col.lower()]
    cols = [F.array_join(kept_col, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in stay]
    if dropped_col:
        cols.append(F.coalesce(F.size(lines) - F.size(kept_col), F.lit(0)).cast("long").alias(dropped_col))
    return joined.withColumn(kept_name, kept).select(*cols)
