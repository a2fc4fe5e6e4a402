"""Approximate nearest neighbours by a hash-prefix forest.

In each tree a vector has one long hash string of bits: for each of several random rotations the sign and the number
of the axis that it points to most.  A tree is the array of all strings in order; Spark deals it out in
cells by the first bits, crowded cells in parts.  A query descends in every tree to its longest common prefix with any
string there, and learns how many strings share each of its prefixes.  From there it ascends in all trees at once, one
bit in a step, and stops at the longest prefix at which the strings met in all trees are expected to belong to ``wanted``
distinct vectors, and surely to k others.  So prefixes are long where vectors are dense and short where they are sparse.

Only numbers of vectors leave the trees.  A query's numbers are gathered, what several trees hold is dropped, and the
rest goes to the blocks in which the vectors lie; a vector is sent to its block once, and each that a query met is scored
exactly, once.

Vectors are lifted by one dimension so that the nearest in angle are those of the largest inner product.
They are dealt to bands by their length, within a factor of BAND of each other, and each band has a forest of its
own that is lifted to its longest vector and searched by every query; ``wanted`` is CANDIDATES * n ** POWER
for the n distinct vectors of a band.  In one forest for all, the lifted dimension of the short vectors
would outweigh the others, and a query would meet them instead of the long ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.llm import vectors
from registra.llm.common import written

TREES, CANDIDATES, POWER, SEED = 56, 1.8, 0.8, 11
BAND = 1.25
#: Bits of a string, and the most bits by which a tree is cut into cells.
STRING_BITS, CELL_BITS = 56, 12
#: Vectors of a block on average; what lies in a block is numbered by two bytes.
BLOCK_ROWS = 20_000
#: A block is multiplied as a whole with the queries that want more than this part of it.
DENSE = 1 / 8
CELL_SCHEMA = "cell long, kind int, a long, b long, tree int, id long"


class Strings:
    """The hash functions of all trees."""

    def __init__(self, dim: int, trees: int = TREES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.axes = 1 << (dim.bit_length() - 1)  # a power of two, so that every symbol has as many bits
        self.bits = self.axes.bit_length()
        self.symbols = STRING_BITS // self.bits
        self.length = self.symbols * self.bits
        self.turn = [np.concatenate([np.linalg.qr(rng.standard_normal((dim, dim)))[0][:, : self.axes] for _ in range(self.symbols)], axis=1) for _ in range(trees)]

    def __call__(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The strings of vectors in a tree, as numbers of ``length`` bits."""
        y = (x @ self.turn[tree]).reshape(len(x), self.symbols, self.axes)
        axis = np.abs(y).argmax(2)
        sign = np.take_along_axis(y, axis[:, :, None], 2)[:, :, 0] < 0
        symbol = axis + np.where(sign, self.axes, 0)
        return symbol.astype(np.int64) @ (1 << (self.bits * np.arange(self.symbols - 1, -1, -1, dtype=np.int64)))


def band_of(x: np.ndarray, longest: float) -> np.ndarray:
    """Which band of lengths each vector is in; 0 has the longest."""
    with np.errstate(all="ignore"):
        steps = np.log(longest / np.sqrt((x * x).sum(1))) / np.log(BAND)
    return np.clip(np.nan_to_num(steps, nan=0.0), 0, 1 << 20).astype(np.int64)


def lifted(x: np.ndarray, longest: float | np.ndarray, query: bool) -> np.ndarray:
    """Vectors of length ``longest`` that keep inner products with queries."""
    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, longest**2 - (x * x).sum(1)))
    return np.concatenate([x, extra[:, None]], axis=1)


def prefix_counts(ordered: np.ndarray, strings: np.ndarray, length: int, first: int) -> np.ndarray:
    """How many of the ordered strings share the prefixes of ``first``, first + 1, ... bits of each string, up to the longest common one."""
    out = []
    for level in range(first, length + 1):
        low = strings >> (length - level) << (length - level)
        n = np.searchsorted(ordered, low + (1 << (length - level))) - np.searchsorted(ordered, low)
        if not n.any():
            break
        out.append(n)
    return np.stack(out, axis=1).astype("<u4") if out else np.zeros((len(strings), 0), "<u4")


def stop_level(counts: np.ndarray, n: int, wanted: float, k: int) -> int:
    """The longest prefix with enough vectors; ``counts`` (trees, levels) are those that share it in each tree, of ``n``.

    Trees are independent, so a vector is in none of the prefixes' ranges with a chance of prod(1 - count / n).  One tree
    alone has all its vectors distinct, so k of them in a tree are sure.
    """
    with np.errstate(divide="ignore"):
        expected = n * (1 - np.exp(np.log1p(-counts / n).sum(0)))
    enough = (expected >= min(wanted, n) * (1 - 1e-9)) & (counts.max(0) >= min(k, n))
    return int(np.flatnonzero(enough)[-1])


class _Cells:
    """Where the cells of each tree lie, and how many strings share each of their prefixes."""

    def __init__(self, sizes: np.ndarray, length: int, trees: int, counts: list):
        # Bits of the cells of each band, so that even ones hold PART_ROWS or fewer.
        need = np.ceil(np.log2(np.maximum(1, sizes / vectors.PART_ROWS))).astype(int)
        self.bits = np.minimum(np.minimum(need, CELL_BITS), length)
        self.length, self.trees = length, trees
        self.count = [np.zeros(1 << self.bits[t // trees], np.int64) for t in range(len(sizes) * trees)]
        for t, cell, n in counts:
            self.count[t][cell] = n
        self.parts = [np.maximum(1, -(-c // vectors.PART_ROWS)) for c in self.count]
        starts = np.concatenate([[0], np.cumsum([p.sum() for p in self.parts])]).astype(np.int64)
        self.first = [starts[t] + np.cumsum(p) - p for t, p in enumerate(self.parts)]

    def shift(self, tree: int) -> int:
        return self.length - int(self.bits[tree // self.trees])

    def above(self, tree: int, string: int) -> list[int]:
        """Counts at the levels above the cells."""
        bits, cell = int(self.bits[tree // self.trees]), string >> self.shift(tree)
        return [int(self.count[tree][cell >> (bits - lv) << (bits - lv) : ((cell >> (bits - lv)) + 1) << (bits - lv)].sum()) for lv in range(bits)]


def _rows(cell, kind: int, a, b, tree, ids) -> pa.RecordBatch:
    arrays = [pa.array(cell, pa.int64()), pa.array(np.full(len(cell), kind, np.int32)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(tree, pa.int32()), pa.array(ids, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["cell", "kind", "a", "b", "tree", "id"])


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
    """(ordered strings, their vectors' numbers, some queries' columns) of each cell; rows come by cell, kind and string."""
    cell, strings, ids, ready = None, [], [], None
    for b in batches:
        if not b.num_rows:
            continue
        col = {name: b.column(i).to_numpy() for i, name in enumerate(b.schema.names)}
        edges = np.flatnonzero((np.diff(col["cell"]) != 0) | (np.diff(col["kind"]) != 0)) + 1
        for s, e in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows], strict=True):
            if col["cell"][s] != cell:
                cell, strings, ids, ready = col["cell"][s], [], [], None
            if col["kind"][s] == 0:
                strings.append(col["a"][s:e])
                ids.append(col["id"][s:e])
            elif strings:
                ready = ready or (np.concatenate(strings), np.concatenate(ids))
                yield *ready, {name: c[s:e] for name, c in col.items()}


def nearest(
    df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, candidates: float = CANDIDATES, power: float = POWER
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest inner products found for each query, nearest first.

    ``is_query`` is a condition over the column vec_id.  Scores are computed in double precision from the
    vectors as given.  Ties go to the smaller vec_id; a query's own id is left out; fewer than k rows come
    only if there are fewer candidates.  Vectors that are null, empty, zero, with null or non-finite
    components or of an uncommon length, and rows with a null id, take no part.  A repeated row is one
    candidate.  An empty table gives an empty one; other columns are not read.
    """
    all_, asked, queries, form = vectors.prepare(df, id_col, vec_col, is_query, k, nonzero=True)
    numbered = number(all_)
    _, met = search(numbered, asked, form, k, trees, candidates, power)
    return vectors.ranked(_scored(numbered, asked, met, form, k), all_, queries, k)


def number(all_: DataFrame) -> DataFrame:
    """(rep, v, block, place): vectors are dealt to blocks by a hash and numbered there in the order of rep."""
    blocks = max(1, -(-all_.count() // BLOCK_ROWS))
    dealt = all_.select("rep", "v", F.pmod(F.xxhash64("rep"), F.lit(blocks)).alias("block"))
    place = F.row_number().over(Window.partitionBy("block").orderBy("rep")) - 1
    return written(dealt.withColumn("place", place.cast("long")), "numbered")


def search(all_: DataFrame, asked: DataFrame, form: vectors.Form, k: int, trees: int = TREES, candidates: float = CANDIDATES, power: float = POWER) -> tuple[DataFrame, DataFrame]:
    """Of numbered vectors and queries (rep, v): (q, tree, a, level, lcp) and the vectors met, (block, q, places).

    ``level`` is the length of the prefix at which a query stopped, ``lcp`` that of its longest one in a tree; places
    are distinct 16-bit places in a block.
    """
    strings = Strings(form.dim + 1, trees)
    length = strings.length

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in vectors.slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array((form.unpack(b.column(0)) ** 2).sum(1))], names=["norm"])

    norm = all_.select("v").mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0]
    longest = float(np.sqrt(norm)) if norm else 1.0

    def band_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in vectors.slices(batches):
            x = form.unpack(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(band_of(x, longest)), pa.array((x * x).sum(1))], names=["band", "norm"])

    # One row for each band, a factor of BAND in length.
    found_bands = sorted(all_.select("v").mapInArrow(band_lengths, "band long, norm double").groupBy("band").agg(F.count("*"), F.max("norm")).collect())
    bands = np.array([r[0] for r in found_bands], np.int64)
    sizes = np.array([r[1] for r in found_bands], np.int64)
    band_longest = np.sqrt(np.array([r[2] for r in found_bands], np.float64))
    wanted = candidates * sizes.astype(np.float64) ** power

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in vectors.slices(batches):
            own = form.unpack(b.column(1))
            band = np.searchsorted(bands, band_of(own, longest))
            x = lifted(own, band_longest[band], False)
            for t in range(trees):  # tree t of band b is number b * trees + t
                yield pa.RecordBatch.from_arrays([pa.array((band * trees + t).astype(np.int32)), pa.array(strings(x, t)), b.column(0)], names=["tree", "a", "id"])

    # A vector's number is its block and its place there; four bytes hold it up to 65,536 blocks.
    packed = "<u4" if (all_.agg(F.max("block")).first()[0] or 0) < 1 << 16 else "<i8"
    hashed = written(all_.select((F.shiftleft("block", 16) + F.col("place")).alias("nr"), "v").mapInArrow(hash_all, "tree int, a long, id long"), "strings")
    cell_bits = _Cells(sizes, length, trees, []).bits
    shift = F.element_at(F.array(*[F.lit(length - int(c)) for c in cell_bits] or [F.lit(0)]), (F.expr(f"tree div {trees}") + 1).cast("int"))
    histogram = hashed.groupBy("tree", F.call_function("shiftright", "a", shift).alias("cell")).count().collect()  # 2 ** CELL_BITS for a tree at most
    cells = _Cells(sizes, length, trees, histogram)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tree, a, ids = (b.column(i).to_numpy() for i in range(3))
            for t in np.unique(tree).tolist():
                at = np.flatnonzero(tree == t)
                cell = a[at] >> cells.shift(t)
                part = cells.first[t][cell] + vectors.parts_of(ids[at], cells.parts[t][cell])
                yield _rows(part, 0, a[at], a[at], tree[at], ids[at])

    def hash_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in vectors.slices(batches):
            x = lifted(form.unpack(b.column(1)), longest, True)
            for t in range(trees):
                a = pa.array(strings(x, t))
                for band in range(len(bands)):
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(x), band * trees + t, np.int32)), a], names=["q", "tree", "a"])

    probes = written(asked.select("rep", "v").mapInArrow(hash_queries, "q long, tree int, a long"), "probes")

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """To the parts of each query's own cells."""
        for b in batches:
            cell, at = [], []
            for i, (t, a) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                c = a >> cells.shift(t)
                for p in range(int(cells.parts[t][c]) if cells.count[t][c] else 0):
                    cell.append(int(cells.first[t][c]) + p)
                    at.append(i)
            q, tree, a = (b.column(i).to_numpy()[at] for i in range(3))
            yield _rows(cell, 1, a, a, tree, q)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ordered, _, asks in _cells_of(batches):
            first = int(cells.bits[asks["tree"][0] // trees])
            n = prefix_counts(ordered, asks["a"], length, first)
            yield pa.RecordBatch.from_arrays([pa.array(asks["id"]), pa.array(asks["tree"]), pa.array(asks["a"]), pa.array([r.tobytes() for r in n], pa.binary())], names=["q", "tree", "a", "counts"])

    kinds = "q long, tree int, a long, counts binary"
    data = hashed.mapInArrow(place, CELL_SCHEMA)
    in_cells = data.unionByName(probes.mapInArrow(descend, CELL_SCHEMA)).repartition("cell").sortWithinPartitions("cell", "kind", "a")
    own = probes.withColumn("counts", F.lit(b""))
    seen = own.unionByName(in_cells.mapInArrow(count, kinds)).repartition("q").sortWithinPartitions("q", "tree")

    def ascend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("q", pa.int64()), ("tree", pa.int32()), ("a", pa.int64()), ("level", pa.int32()), ("lcp", pa.int32())])
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True))
        out: list[tuple] = []
        for q, of_query in groupby(rows, lambda r: r[0]):
            for band, of_band in groupby(of_query, lambda r: r[1] // trees):
                n, at = np.zeros((trees, length + 1), np.int64), np.zeros(trees, np.int64)
                for _, t, a, raw in of_band:
                    bits = int(cells.bits[band])
                    if not raw:  # the probe itself, once for each tree
                        at[t % trees] = a
                        n[t % trees, :bits] = cells.above(t, a)
                    found = np.frombuffer(raw, "<u4")
                    n[t % trees, bits : bits + len(found)] += found
                level = stop_level(n, int(sizes[band]), float(wanted[band]), k + 1)
                lcp = (n > 0).sum(1) - 1
                out += zip([q] * trees, range(band * trees, (band + 1) * trees), at.tolist(), [level] * trees, lcp.tolist(), strict=True)
            if len(out) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    stops = written(seen.mapInArrow(ascend, "q long, tree int, a long, level int, lcp int"), "stops")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """To all parts of the cells under each query's prefixes, with the range of strings that share it."""
        for b in (b for b in batches if b.num_rows):
            q, tree, a, level = (b.column(i).to_numpy().astype(np.int64) for i in range(4))
            low = a >> (length - level) << (length - level)
            high = low + (np.int64(1) << (length - level)) - 1
            parts, of = [], []
            for i, t in enumerate(tree.tolist()):
                under = np.arange(low[i] >> cells.shift(t), (high[i] >> cells.shift(t)) + 1)
                n = np.where(cells.count[t][under] > 0, cells.parts[t][under], 0)
                part = np.repeat(cells.first[t][under], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                parts.append(part)
                of.append(np.full(len(part), i))
            at = np.concatenate(of)
            yield _rows(np.concatenate(parts), 1, low[at], high[at], tree[at], q[at])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ordered, ids, asks in _cells_of(batches):
            ids = ids.astype(packed)
            ends = zip(np.searchsorted(ordered, asks["a"]).tolist(), np.searchsorted(ordered, asks["b"], "right").tolist(), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(asks["id"]), pa.array([ids[i:j].tobytes() for i, j in ends], pa.binary())], names=["q", "ids"])

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for q, of_query in groupby(rows, lambda r: r[0]):
            nr = np.unique(np.concatenate([np.frombuffer(ids, packed) for _, ids in of_query])).astype(np.int64)
            block = nr >> 16
            first = np.flatnonzero(np.diff(block, prepend=-1))
            places = [p.tobytes() for p in np.split((nr & 0xFFFF).astype("<u2"), first[1:])] if len(nr) else []
            yield pa.RecordBatch.from_arrays([pa.array(block[first]), pa.array(np.full(len(first), q)), pa.array(places, pa.binary())], names=["block", "q", "places"])

    ranges = stops.repartition(F.col("q"), F.col("tree")).mapInArrow(reach, CELL_SCHEMA)
    in_cells = data.unionByName(ranges).repartition("cell").sortWithinPartitions("cell", "kind", "a")
    of_queries = in_cells.mapInArrow(meet, "q long, ids binary").repartition("q").sortWithinPartitions("q")
    return stops, written(of_queries.mapInArrow(distinct, "block long, q long, places binary"), "met")


def _scored(all_: DataFrame, asked: DataFrame, met: DataFrame, form: vectors.Form, k: int) -> DataFrame:
    """(q, c, score): the k + 1 best of each query in each block."""
    none = F.lit(None)
    data = all_.select("block", none.cast("long").alias("q"), F.lit(0).alias("kind"), "rep", "place", "v")
    pairs = met.select("block", "q").join(asked.select(F.col("rep").alias("q"), "v"), "q")
    ask = pairs.select("block", "q", F.lit(1).alias("kind"), F.col("q").alias("rep"), none.cast("long").alias("place"), "v")
    places = met.select("block", "q", F.lit(2).alias("kind"), F.col("q").alias("rep"), none.cast("long").alias("place"), F.col("places").alias("v"))
    # Data have no q and so come first in their block; then each query's vector, then its places.
    dealt = data.unionByName(ask).unionByName(places).repartition("block").sortWithinPartitions("block", F.asc_nulls_first("q"), "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ready, now, waiting = None, [], None, None, []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            if waiting:
                yield _best_met(waiting, *ready, k + 1)
                waiting = []

        for b in batches:
            blocks, kinds = b.column(0).to_numpy(), b.column(2).to_numpy()
            s = 0
            while s < b.num_rows:
                if blocks[s] != block:
                    if now is not None:
                        waiting.append(now)
                    yield from flush()
                    block, held, ready, now = blocks[s], [], None, None
                if kinds[s] == 0:
                    e = s + int(np.argmin(np.append((kinds[s:] == 0) & (blocks[s:] == block), False)))
                    held.append((b.column(4).slice(s, e - s).to_numpy(), b.column(3).slice(s, e - s).to_numpy(), form.unpack(b.column(5).slice(s, e - s))))
                    s = e
                    continue
                if ready is None:
                    place, rep, v = (np.concatenate(z) for z in zip(*held, strict=True))
                    order = np.argsort(place)
                    ready, held = (place[order], rep[order], v[order]), []
                if kinds[s] == 1:
                    if now is not None:
                        waiting.append(now)
                        if len(waiting) >= vectors.QUERY_BLOCK // 4:
                            yield from flush()
                    now = b.column(3)[s].as_py(), form.unpack(b.column(5).slice(s, 1))[0], []
                else:
                    now[2].append(np.frombuffer(b.column(5)[s].as_py(), "<u2"))
                s += 1
        if now is not None:
            waiting.append(now)
        yield from flush()

    return dealt.mapInArrow(run, vectors.FOUND_SCHEMA.format("double"))


def _best_met(asks: list[tuple], place: np.ndarray, rep: np.ndarray, data: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best of some queries among the distinct places that each has met."""
    at = [np.searchsorted(place, np.concatenate(a[2])) for a in asks]
    many = [i for i, x in enumerate(at) if len(x) > DENSE * len(place)]
    dense = dict(zip(many, np.stack([asks[i][1] for i in many]) @ data.T, strict=True)) if many else {}
    out_q, out_c, out_s = [], [], []
    for i, (q, v, _) in enumerate(asks):
        scores = dense[i][at[i]] if i in dense else data[at[i]] @ v
        c, s = vectors.best_of(scores, rep[at[i]], k)
        out_q.append(np.full(len(c), q))
        out_c.append(c)
        out_s.append(s)
    return vectors.found_rows(out_q, out_c, out_s)
