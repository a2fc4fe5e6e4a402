"""Mixing sources to target weights by hierarchical budgets; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.llm.common import free_name, small_or_shuffled, written

#: Hex digits by which the place where a leaf's budget ends is narrowed down in a round (256 sums for each leaf), and
#: rows of a leaf that may be left between the digits found and that place.
ROUND_DIGITS, EDGE_ROWS = 2, 64
#: Hex digits of an order: MD5 of the id and MD5 of the text.
ORDER_DIGITS = 64


def allocate(leaves: DataFrame, levels: Sequence[str], budget: DataFrame) -> DataFrame:
    """Budgets of the leaves of a tree, exact in integers.

    ``leaves`` has one row for each leaf: ``levels`` from the root down, the long ``capacity``, and for each
    level L an integer ``weight_L`` > 0, the same for all rows below one node.  ``budget`` is one row with
    the long ``budget``.  From the root down each node deals its budget to its children in proportion to
    their weights; a child that cannot take its share takes all it has, and the shortage goes to its
    siblings.  As a node never gets more than all below it can take, a shortage reaches the ancestors'
    siblings only when no sibling can take it.  What whole numbers leave over goes to the first children by
    name that still have room.
    """
    table = leaves.crossJoin(F.broadcast(budget))  # one row
    parent: list[str] = []
    for level in levels:
        path = [*parent, level]
        nodes = table.groupBy(*path).agg(
            F.sum("capacity").alias("cap"), F.max(f"weight_{level}").alias("w"), F.max("budget").alias("given")
        )
        siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
        order = siblings.orderBy(F.col("cap") / F.col("w"), level)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        nodes = (
            nodes.withColumn("given", F.least("given", F.sum("cap").over(siblings)))
            .withColumn("left", F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            .withColumn("w_left", F.sum("w").over(siblings) - F.coalesce(F.sum("w").over(before), F.lit(0)))
            # Children full at their fair share come first in this order; from the first other on, all share alike.
            .withColumn("full", F.expr("CAST(cap AS DECIMAL(38,0)) * w_left <= CAST(left AS DECIMAL(38,0)) * w"))
            .withColumn("open_w", F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0)).over(siblings))
            .withColumn("open_given", F.col("given") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(siblings))
            .withColumn("share", F.expr("CASE WHEN full THEN cap ELSE CAST(CAST(open_given AS DECIMAL(38,0)) * w div open_w AS BIGINT) END"))
            .withColumn("over", F.col("given") - F.sum("share").over(siblings))
            .withColumn("nth", F.row_number().over(siblings.orderBy(F.col("full"), level)))
            .withColumn("share", F.col("share") + F.when(~F.col("full") & (F.col("nth") <= F.col("over")), 1).otherwise(0))
        )
        got = nodes.select(*path, F.col("share").alias("budget"))
        table = table.drop("budget").join(got, path)
        parent = path
    return table


def _cuts(keyed: DataFrame, names: Sequence[str], leaves: int) -> tuple[DataFrame, int]:
    """(names, _end, _room) of the leaves of ``keyed``, and the digits of _end.

    ``keyed`` has names, rest, tokens and _order.  The orders that begin with _end are where ``rest`` runs out, and _room is
    what is left of it there.  Each round sums up the tokens below the digits found so far by the next ROUND_DIGITS and
    goes on into the one of these parts in which the budget ends, until it has EDGE_ROWS rows or fewer.
    """
    digits, cut = 0, None
    while True:
        if cut is None:
            part = keyed.select("*", F.col("rest").alias("_room"))
        else:
            part = keyed.join(small_or_shuffled(cut.select(*names, "_end", "_room"), leaves), names).where(F.substring("_order", 1, digits) == F.col("_end")).drop("_end")
        digits += ROUND_DIGITS
        sums = part.groupBy(*names, F.substring("_order", 1, digits).alias("_end"), "_room").agg(F.sum("tokens").alias("sum"), F.count("*").alias("n"))
        upto = F.sum("sum").over(Window.partitionBy(*names).orderBy("_end"))
        ends = sums.withColumn("upto", upto).where(F.col("upto") > F.col("_room"))
        first = ends.groupBy(*names).agg(F.min(F.struct("_end", (F.col("_room") - F.col("upto") + F.col("sum")).alias("room"), "n")).alias("e"))
        cut = written(first.select(*names, F.col("e._end").alias("_end"), F.col("e.room").alias("_room"), F.col("e.n").alias("n")), "cuts")
        most = cut.agg(F.max("n")).first()[0]
        if most is None or most <= EDGE_ROWS or digits >= ORDER_DIGITS:
            return cut.drop("n"), digits


def mix(
    docs: DataFrame,
    levels: Sequence[tuple[str, Column, Column]],
    budget: int | None = None,
    budget_share: float = 0.5,
    max_epochs: int = 2,
    seed: int = 17,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that fill the budget of each leaf, with the level columns, epoch, tokens and leaf_budget.

    ``levels`` lists (name, value, weight) from the root down; a null value is the value ''.  The budget is
    ``budget`` tokens, or ``budget_share`` of all.  A leaf has its tokens ``max_epochs`` times over.  In each
    epoch its rows stand in the order of md5(seed:epoch:id); the leaf takes the longest prefix of rows of
    epoch 0, 1, ... whose tokens fit its budget, whole rows only.  Tokens are by default the UTF-8 bytes of
    the text over 4, rounded up; null and empty texts have none and cost nothing.  Rows that repeat an id
    stand together, by the digest of their text; a null id counts as ''.  An empty table gives an empty one.

    All columns of ``docs`` stay as they are.  A level with the name of one of them is not added; epoch, tokens and
    leaf_budget get a name with underscores behind it where ``docs`` has a column of that name.

    Where the budget of a leaf ends is found by sums over digits of the order, so a leaf with a third of all rows is spread
    over many tasks and only the last few rows are sorted.  Rows with equal id and text are equal for the order; all of
    one leaf that stand where its budget ends are sorted in one task, as are the children of a node, one row each.
    """
    names = [n for n, _, _ in levels]
    count = tokens if tokens is not None else F.ceil(F.octet_length(F.col(f"`{text_col}`").cast("string")) / 4).cast("long")
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        *[F.coalesce(v.cast("string"), F.lit("")).alias(n) for n, v, _ in levels],
        *[F.coalesce(w.cast("long"), F.lit(1)).alias(f"weight_{n}") for n, _, w in levels],
        F.coalesce(count, F.lit(0)).alias("tokens"),
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_id"),
    )
    leaves = written(
        base.groupBy(*names).agg(
            F.sum("tokens").alias("leaf_tokens"), *[F.max(f"weight_{n}").alias(f"weight_{n}") for n in names]
        ),
        "leaves",
    )
    if budget is None:
        total = leaves.agg(F.floor(F.coalesce(F.sum("leaf_tokens"), F.lit(0)) * F.lit(budget_share)).cast("long").alias("budget"))
    else:
        total = docs.sparkSession.range(1).select(F.lit(budget).cast("long").alias("budget"))
    capacities = leaves.withColumn("capacity", F.col("leaf_tokens") * max_epochs)
    given = written(allocate(capacities, names, total).select(*names, "leaf_tokens", F.col("budget").alias("leaf_budget")), "budgets")
    n = given.count()

    # Whole epochs, then the part of the last one that fits.  With no tokens at all, one epoch.
    whole = F.when(F.col("leaf_tokens") > 0, F.expr("leaf_budget div leaf_tokens")).otherwise(1).cast("int")
    plan = given.withColumn("whole", whole).withColumn("rest", F.col("leaf_budget") - F.col("whole") * F.col("leaf_tokens"))
    planned = small_or_shuffled(plan, n)
    text_digest = F.md5(F.coalesce(F.col("_row").getField(text_col).cast("string"), F.lit("")))
    order = F.concat(F.md5(F.concat(F.lit(f"{seed}:"), F.col("whole").cast("string"), F.lit(":"), F.col("_id"))), text_digest)
    keyed = base.join(planned, names).where(F.col("rest") > 0).select(*names, "rest", "tokens", order.alias("_order"))
    cut, digits = _cuts(written(keyed, "orders"), names, n)

    rows = base.join(planned, names).join(small_or_shuffled(cut, n), names, "left").withColumn("_order", F.when(F.col("rest") > 0, order))
    rows = rows.withColumn("_part", F.substring("_order", 1, digits)).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole"))))
    last = F.col("epoch") == F.col("whole")
    sure = rows.where(~last | ((F.col("rest") > 0) & (F.col("_end").isNull() | (F.col("_part") < F.col("_end")))))
    edge = rows.where(last & (F.col("rest") > 0) & (F.col("_part") == F.col("_end")))
    upto = Window.partitionBy(*names).orderBy("_order").rowsBetween(Window.unboundedPreceding, 0)
    edge = edge.withColumn("_upto", F.sum("tokens").over(upto)).where(F.col("_upto") <= F.col("_room")).drop("_upto")
    out = [F.col("_row").getField(c).alias(c) for c in docs.columns]
    shown = [F.col(n) for n in names if n.lower() not in {c.lower() for c in docs.columns}]
    shown += [F.col(c).alias(free_name(docs.columns, c)) for c in ("epoch", "tokens", "leaf_budget")]
    return sure.unionByName(edge).select(*out, *shown)
