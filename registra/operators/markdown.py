"""Tables and nested sections as Markdown, with higher-order functions and groupings only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.functions.text import cell_escaped


def table(headers: Column, rows: Column) -> Column:
    """A pipe table from arrays of rows of cells.

    As wide as the widest row; its header is the last header row of that width, else blank; short rows are
    filled up.  Without any cell it is an empty text.
    """
    headers, rows = F.coalesce(headers, F.array().cast("array<array<string>>")), F.coalesce(rows, F.array().cast("array<array<string>>"))
    width = F.coalesce(F.array_max(F.transform(F.concat(headers, rows), lambda r: F.size(r))), F.lit(0))
    full = F.filter(headers, lambda r: F.size(r) == width)
    blank = F.array_repeat(F.lit(""), width)
    header = F.coalesce(F.get(full, F.size(full) - 1), blank)
    line = lambda cells: F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda c: cell_escaped(F.coalesce(c, F.lit("")))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    body = F.transform(rows, lambda r: line(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))))
    return F.when(width > 0, F.array_join(F.concat(F.array(line(header), rule), body), "\n")).otherwise("")


def heading(depth: Column, text: Column, deepest: int = 6) -> Column:
    """A Markdown heading; beyond the deepest level bold text."""
    return F.when(depth <= deepest, F.concat(F.repeat(F.lit("#"), depth), F.lit(" "), text)).otherwise(F.concat(F.lit("**"), text, F.lit("**")))


def small_level(number: Column, title: Column, content: Column) -> Column:
    """'**(a)** **Heading** text'; missing parts are left out."""
    bold = lambda c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit("**"), c, F.lit("**")))
    return F.array_join(F.array_compact(F.array(bold(number), bold(title), F.nullif(content, F.lit("")))), " ")


#: How inline elements are shown: marks before and after.
INLINE_MARKS = {"bold": ("**", "**"), "italic": ("*", "*"), "sup": ("<sup>", "</sup>"), "sub": ("<sub>", "</sub>"), "quoted": ('"', '"'), "term": ("**", "**"), "footnoteRef": ("[^", "]")}


def inline(kind: Column, text: Column) -> Column:
    out = text
    for name, (before, after) in INLINE_MARKS.items():
        out = F.when(kind == name, F.concat(F.lit(before), text, F.lit(after))).otherwise(out)
    return out


def folded(nodes: DataFrame, own: str, doc: Sequence[str], depths: int, separator: str = "\n\n") -> DataFrame:
    """Each document's text: children are put behind their parent's own text, deepest first.

    ``nodes`` has the columns of ``doc``, node_id, parent_id, ord, depth (0 at the roots) and ``own``.  One
    grouping for each of ``depths`` levels; a group is the children of one node.
    """
    level = nodes.where(F.col("depth") == depths).select(*doc, "node_id", "parent_id", "ord", F.col(own).alias("md"))
    for depth in range(depths - 1, -1, -1):
        children = level.groupBy(*doc, F.col("parent_id").alias("node_id")).agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "md"))), lambda c: F.nullif(c["md"], F.lit(""))), separator).alias("below")
        )
        here = nodes.where(F.col("depth") == depth).select(*doc, "node_id", "parent_id", "ord", own)
        joined = here.join(children, [*doc, "node_id"], "left")
        parts = F.array_compact(F.array(F.nullif(F.col(own), F.lit("")), F.nullif(F.col("below"), F.lit(""))))
        level = joined.select(*doc, "node_id", "parent_id", "ord", F.array_join(parts, separator).alias("md"))
    return level.groupBy(*doc).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "md"))), lambda c: c["md"]), separator).alias("markdown"))
