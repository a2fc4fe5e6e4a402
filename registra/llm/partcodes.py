"""Compression of vectors to codes of parts; LAESA pivots order and prune the exact evaluations.

A vector of whole numbers is cut into equal parts, and a part is replaced by the nearest entry of its position's
codebook.  The distances of every part to a few fixed pivots, taken from the first codebook, are computed once and written
beside the vectors.  In each round the entries' distances to the pivots give, by the triangle inequality, a
lower bound of each part's distance to each entry: entries are evaluated in the order of their bounds, in whole numbers, until
no bound is below the best distance found.

A round is one pass over the written table.  Every task sums what falls to each entry, so only a row for each task, entry and
position is shuffled, and the driver holds codebooks only: entries times the length of a vector.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import small_or_shuffled, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Fixed pivots of each part position, the first entry and then always the one farthest from those chosen.
PIVOTS = 4
#: Parts compared at once.
BLOCK = 8_192
LONGEST = (1 << 63) - 1


class Books(NamedTuple):
    """Codebooks (parts, entries, width) and the pivots (parts, pivots, width) that were chosen from the first ones."""

    entries: np.ndarray
    pivots: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def largest(dim: int) -> int:
    """Where components end, so that squared distances of ``dim`` components fit a long."""
    return 1 << (60 - max(1, dim - 1).bit_length()) // 2


def distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances (rows, rows of ``to``), whole numbers."""
    return np.stack([((x - t) ** 2).sum(1) for t in to], axis=1) if len(to) else np.zeros((len(x), 0), np.int64)


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """For each part position ``count`` of its entries (or all), each the farthest from those before; ties to the lower index."""
    out = []
    for book in entries:
        chosen = [0]
        while len(chosen) < min(count, len(book)):
            chosen.append(int(distances(book, book[chosen]).min(1).argmax()))
        out.append(book[chosen])
    return np.array(out)


def nearest(x: np.ndarray, near: np.ndarray, book: np.ndarray, book_near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For the parts ``x`` of one position: index of the nearest entry, squared distance, and how many distances were evaluated.

    ``near`` and ``book_near`` are the distances of parts and of entries to the pivots.
    """
    low = np.abs(near[:, None, :] - book_near[None]).max(2)
    low -= 1e-12 * (near.max(initial=0.0) + book_near.max(initial=0.0))  # what rounding can add to a bound
    order = np.argsort(low, axis=1, kind="stable")
    best = np.full(len(x), LONGEST, np.int64)
    index = np.zeros(len(x), np.int64)
    open_, done = np.arange(len(x)), 0
    for step in range(len(book)):
        entry = order[open_, step]
        still = low[open_, entry] <= np.sqrt(best[open_].astype(np.float64))
        open_, entry = open_[still], entry[still]
        if not len(open_):
            break
        done += len(open_)
        d = ((x[open_] - book[entry]) ** 2).sum(1)
        better = (d < best[open_]) | ((d == best[open_]) & (entry < index[open_]))
        best[open_[better]] = d[better]
        index[open_[better]] = entry[better]
    return index, best, done


def encode_rows(x: np.ndarray, near: np.ndarray, books: Books) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes and squared distances (rows, parts) of vectors (rows, parts, width), and the evaluations made."""
    codes, errors, done = np.zeros(x.shape[:2], np.int64), np.zeros(x.shape[:2], np.int64), 0
    for p, (book, pivots) in enumerate(zip(books.entries, books.pivots, strict=True)):
        book_near = np.sqrt(distances(book, pivots).astype(np.float64))
        codes[:, p], errors[:, p], n = nearest(x[:, p], near[:, p], book, book_near)
        done += n
    return codes, errors, done


def _vectors(df: DataFrame, vec_col: str, parts: int, carried: list[Column]) -> tuple[DataFrame, int]:
    """The rows that take part, with their components as doubles in _x, and the length of a vector (0: there are none)."""
    x = F.col("_x")
    rows = df.select(*carried, F.col(f"`{vec_col}`").cast("array<double>").alias("_x"))
    finite = ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = rows.where(x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0)).where(finite)
    common = rows.groupBy(F.size(x).alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = int(common["d"]) if common else 0
    return rows.where(F.size(x) == dim), dim


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, Books]:
    """(vec_id, label, code, error, label_error) of every vector, and the codebooks that the codes refer to.

    A component x becomes floor(scale * x); beyond ``largest(dim)`` it ends there.  The codebooks begin as the parts of
    the ``entries`` smallest ids (of equal ids, the smaller vectors first; rows without an id come last).  ``rounds`` times
    every part goes to its nearest entry (ties to the lower index), and an entry becomes the floor of the mean of what went
    to it; an entry that nothing went to stays.  Then all parts are assigned once more.  ``code`` has two hex digits for
    each part, ``error`` is the squared distance summed over the parts, ``label_error`` the sum of ``error`` over the rows
    of equal label (nulls are equal), not above the largest long.

    Left out are rows whose vector is null, empty, holds null or non-finite components, or has another length than the most common
    one that can be cut into ``parts`` (of equally common ones the smallest).  Repeated rows each return a row and weigh as often.  Fewer
    rows than ``entries`` give shorter codebooks.  An empty table gives an empty one.  Other columns are not read.
    """
    ids, label = F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label")
    rows, dim = _vectors(df, vec_col, parts, [ids, label])
    width, most = dim // parts, largest(max(dim, 1))

    def floors(x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.clip(np.floor(scale * x), -most, most).astype(np.int64).reshape(-1, parts, width)

    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "_x").select("_x").limit(entries).collect() if dim else []
    start = floors(np.array([r["_x"] for r in first]).reshape(-1, dim)).transpose(1, 0, 2) if first else np.zeros((parts, 0, width), np.int64)
    books = Books(start, choose_pivots(start, pivots) if first else start)
    kept = rows.schema["label"].dataType.simpleString()
    size = books.pivots.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = floors(b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
            near = np.stack([np.sqrt(distances(x[:, p], books.pivots[p]).astype(np.float64)) for p in range(parts)], axis=1)
            columns = [b.column(0), b.column(1), _binary(x.astype(np.int32)), _binary(near)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "v", "near"])

    table = written(rows.mapInArrow(measure, f"vec_id long, label {kept}, v binary, near binary"), "parts")

    def read(b: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for at in range(0, b.num_rows, BLOCK):
            cut = b.slice(at, BLOCK)
            x = np.frombuffer(b"".join(cut.column("v").to_pylist()), np.int32).astype(np.int64)
            near = np.frombuffer(b"".join(cut.column("near").to_pylist()), np.float64)
            yield slice(at, at + cut.num_rows), x.reshape(-1, parts, width), near.reshape(-1, parts, size)

    for _ in range(rounds if first else 0):
        books = Books(_moved(table.select("v", "near"), books, read), books.pivots)

    final = books

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows_of, x, near in read(b):
                codes, errors, _ = encode_rows(x, near, final)
                cut = b.slice(rows_of.start, len(x))
                text = [bytes(c).hex() for c in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([cut.column(0), cut.column(1), pa.array(text, pa.string()), pa.array(errors.sum(1))], names=["vec_id", "label", "code", "error"])

    coded = written(table.mapInArrow(code, f"vec_id long, label {kept}, code string, error long"), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST)).cast("long")
    sums = written(coded.groupBy("label").agg(total.alias("label_error")), "labels").withColumnRenamed("label", "_label")
    joined = coded.join(small_or_shuffled(sums), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "label", "code", "error", "label_error"), final


def _binary(m: np.ndarray) -> pa.Array:
    """One binary value for each row of an array."""
    m = np.ascontiguousarray(m)
    bytes_ = m.itemsize * (m.size // len(m))
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(np.arange(len(m) + 1, dtype=np.int32) * bytes_), pa.py_buffer(m)])


def _moved(table: DataFrame, books: Books, read) -> np.ndarray:
    """The entries after one round."""
    parts, entries, width = books.entries.shape

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for b in batches:
            for _, x, near in read(b):
                codes, _, _ = encode_rows(x, near, books)
                for p in range(parts):
                    counts[p] += np.bincount(codes[:, p], minlength=entries)
                    np.add.at(sums[p], codes[:, p], x[:, p])
        p, e = np.nonzero(counts)
        columns = [np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p)), np.repeat(counts[p, e], width), sums[p, e].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "pos", "n", "total"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    dealt = table.mapInArrow(gather, "part long, entry long, pos long, n long, total long").groupBy("part", "entry", "pos")
    new = books.entries.copy()
    for r in dealt.agg(wide("n").alias("n"), wide("total").alias("total")).collect():  # entries times the length of a vector at most
        new[r["part"], r["entry"], r["pos"]] = int(r["total"]) // int(r["n"])
    return new
