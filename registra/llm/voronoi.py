"""Exact top-k by inner product through a Voronoi partition.

Data are grouped by pivots, and queries by the first of the same pivots.  A summary of each data group holds its
size, its radius, its longest vector and the distances of the k + 1 vectors nearest its pivot; that of a query group
its radius and its longest query.  From summaries alone a query group gets a score that k other vectors surely reach
for each of its queries, and each pair of groups a score that none of its pairs exceeds; a data group is replicated
only to the query groups whose bound it can reach.  Inside a query group the same bounds, taken for each query,
leave out the data that this query needs not see.  Groups are solved locally: large query groups in blocks and large
data groups in parts, each block against each part that it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.llm import vectors
from registra.llm.common import written

SCALE, MAX_PIVOTS = 256.0, 1_024
#: Queries for each query group on average, and the largest block of them.
GROUP_QUERIES, BLOCK_QUERIES = 512, 2_048
#: Room for rounding in distances and scores, relative to the lengths involved.
SLACK = 1e-7


class Data(NamedTuple):
    """Summaries of the data groups: arrays over groups, and over the vectors nearest each pivot."""

    pivots: np.ndarray
    count: np.ndarray
    radius: np.ndarray
    longest: np.ndarray
    near_group: np.ndarray
    near_distance: np.ndarray


class Plan(NamedTuple):
    """``needed`` (query groups, data groups) tells which data each query group must see."""

    data: Data
    query_pivots: np.ndarray
    query_count: np.ndarray
    needed: np.ndarray


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (vectors, pivots), never too small."""
    xx, pp = (x * x).sum(1), (pivots * pivots).sum(1)
    d2 = xx[:, None] - 2 * (x @ pivots.T) + pp[None]
    d = np.sqrt(np.maximum(d2, 0)) + SLACK * (np.sqrt(xx)[:, None] + np.sqrt(pp)[None])
    return np.nan_to_num(d, nan=np.inf)


def reach(centre: np.ndarray, spread: np.ndarray, length: np.ndarray, data: Data, k: int) -> np.ndarray:
    """Which data groups can hold one of the k best for a query within ``spread`` of each centre and of at most that length."""
    with np.errstate(all="ignore"):
        at_pivot = centre @ data.pivots.T
        wobble = spread[:, None] * np.sqrt((data.pivots**2).sum(1))[None]
        length = length[:, None]
        room = SLACK * length * (data.longest.max() + 1)
        sure = np.sort((at_pivot - wobble)[:, data.near_group] - length * data.near_distance[None], axis=1)
        least = sure[:, -(k + 1)][:, None] - room if sure.shape[1] > k else np.full_like(length, -np.inf)
        most = np.minimum(at_pivot + wobble + length * data.radius[None], length * data.longest[None]) + room
    return ~(most < least) & (data.count > 0)[None]  # a bound that overflowed excludes nothing


def _grouped(rows: DataFrame, pivots: np.ndarray, form: vectors.Form) -> DataFrame:
    """(g, d, length, rep): the nearest pivot of each vector, the distance from it, and the vector's length."""

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in vectors.slices(batches):
            x = form.unpack(b.column(1))
            d = _distances(x, pivots)
            g = d.argmin(1)
            arrays = [pa.array(g.astype(np.int32)), pa.array(d[np.arange(len(x)), g]), pa.array(np.sqrt((x * x).sum(1))), b.column(0)]
            yield pa.RecordBatch.from_arrays(arrays, names=["g", "d", "length", "rep"])

    return rows.select("rep", "v").mapInArrow(group, "g int, d double, length double, rep long")


def plan(all_: DataFrame, wanted: DataFrame, form: vectors.Form, k: int, max_pivots: int = MAX_PIVOTS, group_queries: int = GROUP_QUERIES) -> Plan:
    """Pivots and summaries of the classes and the query classes of ``vectors.prepare``; only these come to the driver."""
    n, asked = all_.count(), wanted.count()
    n_pivots = int(min(max_pivots, max(1, np.ceil(np.sqrt(n) / 4))))
    chosen = all_.orderBy(F.xxhash64("v"), "v").limit(n_pivots).select("v").collect()  # MAX_PIVOTS at most
    pivots = form.unpack(pa.array([bytes(r[0]) for r in chosen], pa.binary())) if chosen else np.zeros((1, form.dim))
    query_pivots = pivots[: max(1, -(-asked // group_queries))]

    def summary(grouped: DataFrame, size: int) -> np.ndarray:
        out = np.zeros((3, size))
        for r in grouped.groupBy("g").agg(F.count("*"), F.max("d"), F.max("length")).collect():
            out[:, r[0]] = r[1:]
        return out

    grouped = written(_grouped(all_, pivots, form), "groups")
    near = Window.partitionBy("g").orderBy("d", "rep")
    closest = grouped.select("g", "d", "rep").withColumn("n", F.row_number().over(near)).where(F.col("n") <= k + 1).select("g", "d").collect()
    data = Data(pivots, *summary(grouped, len(pivots)), np.array([r[0] for r in closest], np.int64), np.array([r[1] for r in closest]))
    count, radius, longest = summary(_grouped(wanted, query_pivots, form), len(query_pivots))
    needed = reach(query_pivots, radius, longest, data, k) & (count > 0)[:, None]
    return Plan(data, query_pivots, count, needed)


def exact_top_k(
    df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = SCALE, max_pivots: int = MAX_PIVOTS
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest integer inner products for each query.

    Components become floor(scale * x).  ``is_query`` is a condition over the column vec_id.  Ties go to the
    smaller vec_id; a query's own id is left out; with fewer candidates all are returned.  Vectors that are
    null, empty, with null or non-finite components or of an uncommon length, and rows with a null id, take
    no part; zero vectors do.  A repeated row is one candidate.  Scores that a long cannot hold become the
    nearest that it can, but for its lowest.  An empty table gives an empty one; other columns are not read.
    """
    all_, wanted, queries, form = vectors.prepare(df, id_col, vec_col, is_query, k, nonzero=False, scale=scale)
    data, query_pivots, query_count, needed = plan(all_, wanted, form, k, max_pivots)
    parts = np.maximum(1, -(-data.count.astype(np.int64) // vectors.PART_ROWS))
    first_part = np.concatenate([[0], np.cumsum(parts)])
    blocks = np.maximum(1, -(-query_count.astype(np.int64) // BLOCK_QUERIES))
    first_block = np.concatenate([[0], np.cumsum(blocks)])[:-1]
    group_of_block = np.repeat(np.arange(len(blocks)), blocks)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Data rows, to each block of each query group that needs their group."""
        for b in vectors.slices(batches):
            rep = b.column(0).to_numpy()
            g = _distances(form.unpack(b.column(1)), data.pivots).argmin(1)
            part = first_part[g] + vectors.parts_of(rep, parts[g])
            for n, i in enumerate(group_of_block):
                at = np.flatnonzero(needed[i, g])
                if len(at):
                    yield vectors.block(n * first_part[-1] + part[at], 0, rep[at], b.column(1).take(pa.array(at)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Query rows, to the parts of the data groups that they can reach."""
        for b in vectors.slices(batches):
            rep, q = b.column(0).to_numpy(), form.unpack(b.column(1))
            own = _distances(q, query_pivots).argmin(1)
            block = first_block[own] + vectors.parts_of(rep, blocks[own])
            i, g = np.nonzero(reach(q, np.zeros(len(q)), np.sqrt((q * q).sum(1)), data, k) & needed[own])
            for p in range(int(parts.max())):
                has = parts[g] > p
                if has.any():
                    yield vectors.block(block[i[has]] * first_part[-1] + first_part[g[has]] + p, 1, rep[i[has]], b.column(1).take(pa.array(i[has])))

    rows = all_.select("rep", "v").mapInArrow(replicate, vectors.BLOCK_SCHEMA).unionByName(wanted.mapInArrow(ask, vectors.BLOCK_SCHEMA))
    return vectors.ranked(vectors.search(rows, form, k + 1), all_, queries, k)
