"""What the vector searches share: packed vectors, classes of equal vectors, and block scoring.

Rows that hold the same vector are one class with its smallest ids, as many as a result can name, so a
vector that a third of all rows share is searched and found once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from registra.llm.common import written

#: Rows of data that a task scores against at once; larger groups are dealt out in parts of this size.
PART_ROWS = 20_000
#: Queries scored at once.
QUERY_BLOCK = 256
BLOCK_SCHEMA = "part long, kind int, id long, v binary"
FOUND_SCHEMA = "q long, c long, score {}"
#: Integer sums of products below this are exact in doubles; scores that a long cannot hold become this or its negative.
EXACT, LARGEST = float(1 << 53), (1 << 63) - 1


class Form(NamedTuple):
    """How vectors are packed: their dimensions, and the smallest kind of number that holds all components."""

    dim: int
    kind: str

    def pack(self, m: np.ndarray) -> pa.Array:
        m = np.ascontiguousarray(m + 0.0, self.kind)  # no negative zeros
        offsets = np.arange(len(m) + 1, dtype=np.int32) * (m.shape[1] * m.itemsize)
        return pa.BinaryArray.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(offsets), pa.py_buffer(m)])

    def unpack(self, col: pa.Array) -> np.ndarray:
        """Doubles (rows, dim)."""
        return np.frombuffer(b"".join(col.to_pylist()), self.kind).reshape(len(col), self.dim).astype(np.float64)


def packed(df: DataFrame, id_col: str, vec_col: str, nonzero: bool, scale: float | None = None) -> tuple[DataFrame, Form]:
    """(vec_id, v) of the rows that take part, and the form of v.

    v holds the components, or floor(scale * component).  Rows with a null id, a null
    or empty vector, components that are null or not finite (once scaled), only zeros (if ``nonzero``), or another length than the
    most common one (of equally common ones the smallest) take no part.
    """
    x = F.col("x")
    single = isinstance(getattr(df.schema[vec_col].dataType, "elementType", None), FloatType)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("x"))
    finite = ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e * F.lit(scale or 1.0)) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(finite)
    if nonzero:
        rows = rows.where(F.exists(x, lambda e: e != 0))
    most = F.max(F.array_max(F.transform(x, F.abs))).alias("most")
    common = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"), most).orderBy(F.desc("n"), "d").first()
    dim = int(common["d"]) if common else 1
    kind = "<f4" if single else "<f8"
    if scale is not None:
        high = scale * common["most"] + 1 if common else 0
        kind = next((k for k in ("<i1", "<i2", "<i4") if high < np.iinfo(k).max), "<f8")
    form = Form(dim, kind)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)
                yield pa.RecordBatch.from_arrays([b.column(0), form.pack(m if scale is None else np.floor(scale * m))], names=["vec_id", "v"])

    return rows.where(F.size("x") == dim).mapInArrow(pack, "vec_id long, v binary"), form


def classes(vecs: DataFrame, keep: int) -> DataFrame:
    """(rep, v, ids): the distinct vectors with their ``keep`` smallest ids; rep is the first of them."""
    order = Window.partitionBy("v").orderBy("vec_id")
    low = vecs.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= keep)
    grouped = low.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("rep"), "v", "ids")


def prepare(df: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int, nonzero: bool, scale: float | None = None):
    """(classes, query classes (rep, v), queries (query_id, rep), form); ``is_query`` is over vec_id."""
    vecs, form = packed(df, id_col, vec_col, nonzero, scale)
    all_ = written(classes(vecs, k + 1), "classes")
    asked = vecs.where(is_query).select(F.col("vec_id").alias("query_id"), "v")
    queries = written(asked.join(all_.select("v", "rep"), "v").select("query_id", "rep").distinct(), "queries")
    wanted = written(all_.join(queries.select("rep").distinct(), "rep", "left_semi").select("rep", "v"), "asked")
    return all_, wanted, queries, form


def parts_of(rep: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Which of its cell's parts a class belongs to."""
    mixed = (rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % parts.astype(np.uint64)).astype(np.int64)


def block(part: np.ndarray, kind: int, ids: np.ndarray, v: pa.Array) -> pa.RecordBatch:
    """Rows of BLOCK_SCHEMA."""
    arrays = [pa.array(part.astype(np.int64)), pa.array(np.full(len(part), kind, np.int32)), pa.array(ids), v]
    return pa.RecordBatch.from_arrays(arrays, names=["part", "kind", "id", "v"])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1_024) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def search(blocks: DataFrame, form: Form, k: int) -> DataFrame:
    """The k best classes for each query in each part, by integer inner product, ties to the smaller id.

    ``blocks`` has BLOCK_SCHEMA: data rows (kind 0), PART_ROWS or so in a part, and query rows (kind 1), any number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, data = None, [], []
        ready = None
        for b in batches:
            if not b.num_rows:
                continue
            parts, kinds, own = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edges = np.flatnonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0)) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows], strict=True):
                if parts[s] != part:
                    part, ids, data, ready = parts[s], [], [], None
                if kinds[s] == 0:
                    ids.append(own[s:e])
                    data.append(form.unpack(b.column(3).slice(s, e - s)))
                    continue
                if not data:
                    continue
                if ready is None:
                    ready = np.concatenate(ids), np.concatenate(data)
                for at in range(s, e, QUERY_BLOCK):
                    n = min(e - at, QUERY_BLOCK)
                    yield _best(own[at : at + n], whole_scores(form.unpack(b.column(3).slice(at, n)), ready[1]), ready[0], k)

    dealt = blocks.repartition("part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(run, FOUND_SCHEMA.format("long"))


def whole_scores(q: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as longs."""
    if np.sqrt((q * q).sum(1).max() * (data * data).sum(1).max()) < EXACT:
        return (q @ data.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(q) @ exact(data).T, -LARGEST, LARGEST).astype(np.int64)


def _best(q_ids: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best of each query, as found rows."""
    top = min(k, len(ids))
    least = np.partition(scores, len(ids) - top, axis=1)[:, len(ids) - top]
    out_q, out_c, out_s = [], [], []
    for i, row in enumerate(scores):
        c, s = best_of(row, ids, top, least[i])
        out_q.append(np.full(len(c), q_ids[i]))
        out_c.append(c)
        out_s.append(s)
    return found_rows(out_q, out_c, out_s)


def best_of(row: np.ndarray, ids: np.ndarray, k: int, least=None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best of one query; ``least`` is the k-th best score."""
    if least is None:
        k = min(k, len(row))
        least = np.partition(row, len(row) - k)[len(row) - k]
    at = np.flatnonzero(row >= least)
    best = at[np.lexsort((ids[at], -row[at]))][:k]
    return ids[best], row[best]


def found_rows(q: list[np.ndarray], c: list[np.ndarray], s: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in (q, c, s)], names=["q", "c", "score"])


def ranked(found: DataFrame, all_: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best ids of each query, its own left out, ties to the smaller id."""
    once = found.groupBy("q", "c").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    top = once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    named = top.join(all_.select(F.col("rep").alias("c"), "ids"), "c")
    lists = named.groupBy("q").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    rows = queries.join(lists, queries["rep"] == lists["q"])
    flat = F.flatten(F.transform("found", lambda f: F.transform(f["ids"], lambda i: F.struct((-f["score"]).alias("minus"), i.alias("vec_id")))))
    others = F.array_sort(F.filter(flat, lambda p: p["vec_id"] != F.col("query_id")))
    out = rows.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "p"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("p.vec_id").alias("vec_id"), (-F.col("p.minus")).alias("score"))
