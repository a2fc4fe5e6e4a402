"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets a string of random hashes (on which side of random planes it lies), the vectors are put
in lexicographic order of these strings, and each is compared with its neighbours in a window of bounded
width.  Windows are laid out by rank: a block of ranks meets itself and the block before it, so all tasks are alike, wherever the
vectors are crowded.  Runs of vectors that share more leading hashes than a window can hold, as thousands of near
copies do, are compared whole besides, in pairs of blocks, so crowding costs no links.

A pair that several passes find counts once: each vector carries its ranks and runs of the passes before, which tell whether an earlier
pass has compared the pair.  So no pair leaves a task; tasks return the number of links of each vector and spanning stars,
whose union over all passes is contracted to components.  Equal vectors are one class that counts as often as it occurs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registra.llm.common import drop_written, small_or_shuffled, written
from registra.llm.components import connected_components, local_stars

THRESHOLD = 0.9
#: Ranks that a vector is compared over, in both directions, and the chance that a pair right at the threshold is compared in some pass.
WINDOW, RECALL = 512, 0.95
#: Vectors of a crowded run that meet in one task are two blocks of this size.
RUN_BLOCK = 4_096
KEY_BITS, SEED = 40, 11
#: Rows of a matrix of cosines.
TILE = 256


def layout(n: int, threshold: float, window: int, recall: float) -> tuple[int, int]:
    """How many leading hashes two vectors must share to be near in the order of ``n``, and the number of passes."""
    if n <= window + 1:
        return 0, 1
    shared = min(KEY_BITS, math.ceil(math.log2(2 * n / window)))
    chance = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** shared
    return shared, max(1, math.ceil(math.log(1 - recall) / math.log1p(-min(chance, 1 - 1e-9))))


def _numbers(col: pa.Array, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(len(col), dim).astype(np.float64)


def units(x: np.ndarray) -> np.ndarray:
    """Vectors of length one; very large and very small components don't overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def packed(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str, int]:
    """(vec_id, v) of every row, v null where the vector takes no part; kind and number of components."""
    x = F.col("x")
    single = df.schema[vec_col].dataType.simpleString() == "array<float>"
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("x"))
    good = x.isNotNull() & (F.size(x) > 0) & F.exists(x, lambda e: e != 0) & ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = rows.withColumn("x", F.when(F.col("vec_id").isNotNull() & good, x))
    common = rows.where(x.isNotNull()).groupBy(F.size(x).alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim, kind = (int(common["d"]) if common else 1), "<f4" if single else "<f8"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(1)
            m = np.ascontiguousarray(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) + 0.0, kind)  # no negative zeros
            there = iter(m)
            v = [next(there).tobytes() if ok else None for ok in vectors.is_valid().to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(v, pa.binary())], names=["vec_id", "v"])

    rows = rows.withColumn("x", F.when(F.size(x) == dim, x))
    return rows.mapInArrow(pack, "vec_id long, v binary"), kind, dim


def _spots(classes: DataFrame, n: int, kind: str, dim: int, shared: int, passes: int, window: int) -> DataFrame:
    """(node, pass, rank, run, m): where each vector stands in each pass; run and its size m are set in crowded runs only."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(SEED).standard_normal((dim, passes * KEY_BITS))
        weights = 1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 1_024):
                cut = b.slice(at, 1_024)
                sides = units(_numbers(cut.column(1), kind, dim)) @ planes > 0
                keys = (sides.reshape(-1, passes, KEY_BITS) * weights).sum(2)
                arrays = [np.repeat(cut.column(0).to_numpy(), passes), np.tile(np.arange(passes, dtype=np.int32), len(keys)), keys.ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["node", "pass", "key"])

    keys = classes.select("node", "v").mapInArrow(strings, "node long, pass int, key long")
    ordered = keys.repartitionByRange("pass", "key", "node").sortWithinPartitions("pass", "key", "node")
    # The number counts up within a partition from its index times 2^33.
    ordered = written(ordered.withColumn("at", F.monotonically_increasing_id()), "order")
    part = F.shiftright("at", 33)
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = ordered.groupBy(part.alias("part")).count().select("part", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("start"))
    rank = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) - F.col("pass") * F.lit(n)
    placed = ordered.withColumn("part", part).join(F.broadcast(starts), "part")
    placed = placed.select("node", "pass", rank.alias("rank"), F.shiftright("key", KEY_BITS - shared).alias("prefix"))
    runs = written(placed.groupBy("pass", "prefix").agg(F.count("*").alias("m")).where(F.col("m") > window + 1), "runs")
    crowded = placed.join(small_or_shuffled(runs), ["pass", "prefix"], "left")
    return crowded.select("node", "pass", "rank", F.when(F.col("m").isNotNull(), F.col("prefix")).alias("run"), "m")


def _compare(batches: Iterator[pa.RecordBatch], kind: str, dim: int, threshold: float, window: int) -> Iterator[pa.RecordBatch]:
    """Link counts (u, null, n) and stars (u, v, 0) of each group of rows, which come sorted by group.

    Columns: pass, runs (compared whole or by window), g, i, j (the group), side, node, v, n, ranks, own (runs up to this pass).
    """

    def compare(p: int, whole: bool, split: bool, side: np.ndarray, node: np.ndarray, x: np.ndarray, n: np.ndarray, ranks: np.ndarray, runs: np.ndarray):
        first, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        counts, stars = np.zeros(len(node), np.int64), []
        facing = other if split else np.concatenate([first, other])
        for at in range(0, len(first), TILE):
            tile = first[at : at + TILE]
            a, b = np.nonzero(x[tile] @ x[facing].T >= threshold)
            a, b = tile[a], facing[b]
            fresh = (side[b] == 1) | (a < b)
            near = np.abs(ranks[a, p] - ranks[b, p]) <= window
            fresh &= ~near if whole else near
            a, b = a[fresh], b[fresh]
            for q in range(p):  # compared by an earlier pass
                new = (np.abs(ranks[a, q] - ranks[b, q]) > window) & (runs[a, q] != runs[b, q])
                a, b = a[new], b[new]
            if len(a):
                np.add.at(counts, a, n[b])
                np.add.at(counts, b, n[a])
                stars.append(local_stars(node[a], node[b]))
        has = np.flatnonzero(counts)
        if len(has):
            u, v = local_stars(np.concatenate([s[0] for s in stars]), np.concatenate([s[1] for s in stars]))
            columns = [pa.array(np.concatenate([node[has], u])), pa.array([None] * len(has) + v.tolist(), pa.int64()), pa.array(np.concatenate([counts[has], np.zeros(len(u), np.int64)]))]
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v", "n"])

    held: list[pa.RecordBatch] = []
    group = None

    def done() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        p = group[0]
        flat = lambda c: t.column(c).combine_chunks().flatten().to_numpy().reshape(-1, p + 1)
        side, node, n = (t.column(c).to_numpy() for c in ("side", "node", "n"))
        x = units(_numbers(t.column("v"), kind, dim))
        yield from compare(p, group[1], group[3] != group[4], side, node, x, n, flat("ranks"), flat("own"))

    for b in batches:
        if not b.num_rows:
            continue
        keys = list(zip(*(b.column(c).to_pylist() for c in ("pass", "runs", "g", "i", "j")), strict=True))
        edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
        for s, e in zip(edges, edges[1:], strict=False):
            if held and keys[s] != group:
                yield from done()
                held = []
            group = keys[s]
            held.append(b.slice(s, e - s))
    if held:
        yield from done()


def _met(table: DataFrame, kind: str, dim: int, threshold: float, window: int, run_block: int) -> DataFrame:
    """Link counts and stars of all passes; ``table`` has node, v, n and spots, one (pass, rank, run, m) for each pass."""
    none = F.lit(0)
    upto = lambda f: F.transform(F.slice("spots", 1, F.col("pass") + 1), f)
    # Outside crowded runs no two vectors share a run.
    carried = ["node", "v", "n", upto(lambda s: s["rank"]).alias("ranks"), upto(lambda s: F.coalesce(s["run"], -1 - s["rank"])).alias("own")]
    each = table.select("node", "v", "n", "spots", F.explode("spots").alias("s")).select("*", F.col("s.pass").alias("pass"), F.col("s.rank").alias("rank"), F.col("s.run").alias("run"), F.col("s.m").alias("m"))
    block = F.floor(F.col("rank") / window)
    windows = each.withColumn("side", F.explode(F.array(none, F.lit(1))))
    windows = windows.select("pass", F.lit(False).alias("runs"), (block + F.col("side")).cast("long").alias("g"), none.alias("i"), none.alias("j"), "side", *carried)
    blocks = F.ceil(F.col("m") / run_block).cast("int")
    crowded = each.where(F.col("run").isNotNull()).withColumn("mine", F.pmod(F.xxhash64("node", "pass"), blocks).cast("int"))
    crowded = crowded.withColumn("c", F.explode(F.sequence(none, blocks - 1)))
    low, high = F.least("c", "mine"), F.greatest("c", "mine")
    crowded = crowded.select("pass", F.lit(True).alias("runs"), F.col("run").alias("g"), low.alias("i"), high.alias("j"), F.when(F.col("mine") > F.col("c"), 1).otherwise(0).alias("side"), *carried)
    place = ["pass", "runs", "g", "i", "j"]
    dealt = windows.unionByName(crowded).repartition(*place).sortWithinPartitions(*place)
    return dealt.mapInArrow(lambda it: _compare(it, kind, dim, threshold, window), "u long, v long, n long")


def near_duplicate_vectors(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL, run_block: int = RUN_BLOCK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Two vectors are linked if their cosine, in double precision, is ``threshold`` or more and some pass compared them.  ``n_links`` is the
    number of other rows that a row is linked with, ``component_id`` the smallest id that can be reached over links, its own
    included, and ``kept`` says that it is the row's own.  Tables of up to window + 1 different vectors are compared whole.

    A row whose vector is null, empty, zero, or holds null or non-finite components links with nothing, and so does one whose
    vector has another length than the most common one (of equally common ones the smallest), and a row without an id, whose
    component is null and which is kept.  Repeated rows each return a row and link with each other.  An empty table gives an
    empty one.  Other columns are not read.
    """
    rows, kind, dim = packed(df, id_col, vec_col)
    rows = written(rows, "vectors")
    distinct = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"))
    classes = written(distinct.select(F.monotonically_increasing_id().alias("node"), "v", "low", "n"), "classes")
    n = classes.count()
    shared, passes = layout(n, threshold, window, recall)
    spots = _spots(classes, n, kind, dim, shared, passes, window)
    by_node = spots.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("pass", "rank", "run", "m"))).alias("spots"))
    table = written(classes.select("node", "v", "n").join(by_node, "node"), "spots")
    found = written(_met(table, kind, dim, threshold, window, run_block), "met")
    drop_written(table)
    counts = found.where("v is null").groupBy("u").agg(F.sum("n").alias("others")).withColumnRenamed("u", "node")
    roots = connected_components(found.where("v is not null").select("u", "v"))
    member = classes.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lows = member.groupBy("root").agg(F.min("low").alias("component"))
    known = member.join(lows, "root").select("v", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("links"), "component")
    linked = rows.where("v is not null").join(known, "v").select("vec_id", F.col("links").cast("long").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
