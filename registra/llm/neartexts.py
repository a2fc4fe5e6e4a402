"""Near-duplicate texts: pairs that SimHash anchors bring together, verified by the Jaccard similarity of their shingles.

Every fingerprint, of several lanes of 64 bits, is replicated to its anchors as in ``simhash``, with one lane that it is
checked by.  In the first round each anchor pairs its first text, in the order of nodes, with its others; pairs whose fingerprints
are near in all lanes are verified, each once, and contracted to components.  In the second, the anchors with more than two texts
connect what is near on them but not connected yet, as stars.  So texts fall into clusters: all that chains of near pairs reach.
The clusters that are not of one verified component are compared whole, in pairs of blocks, by the hashes that their sets
share; what is inside the largest of a cluster's components is left out, as it is connected.  No step writes a row for each pair of a
group: a crowd of texts that are near but not similar takes work of the square of its size in the last step, and rows in proportion
to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.llm import simhash
from registra.llm.common import drop_written, small_or_shuffled, text_parts, written
from registra.llm.components import connected_components, local_stars

SIMILARITY, WORDS, LANES = 0.8, 5, 6
#: Standard deviations of the distance of fingerprints, above the distance to be expected, that a pair may have.
DEVIATIONS = 4.0
#: Bytes of texts whose sets are made at once.
PART_BYTES = 1 << 20
#: Pairs of rows of an anchor that are compared at once.
CELLS = 1 << 20
#: Texts, and hashes of their sets, of a block of a cluster; columns of the matrix in which shared hashes are counted.
BLOCK, BLOCK_HASHES, COLUMNS = 256, 1 << 18, 2048


def most_bits(similarity: float, lanes: int) -> int:
    """The distance up to which fingerprints of ``lanes`` lanes are taken for those of similar texts."""
    bits, mean = 64 * lanes, simhash.bits_for(similarity, lanes)
    return min(bits, round(mean + DEVIATIONS * (mean * (1 - mean / bits)) ** 0.5))


def shingles(text: str | None, words: int = WORDS, seed: int = simhash.SEED) -> np.ndarray:
    """Distinct hashes of the shingles of a text, ascending, by the words and shingles that its fingerprint is made of."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    spans = (b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))) if tokens else ()
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in spans), np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two ascending sets; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _anchors(nodes: DataFrame, lanes: int) -> DataFrame:
    """(key, node, check): each fingerprint at each of its anchors, with the lane after the one that the anchor is of."""
    after = F.expr(f"element_at(array({', '.join(f'l{i}' for i in range(lanes))}), CAST(pmod(shiftright(part, 1) + 1, {lanes}) AS INT) + 1)")
    return simhash._anchored(nodes, lanes).select(F.expr("shiftleft(CAST(part AS BIGINT), 31) | anchor").alias("key"), "node", after.alias("check"))


def _stars(batches: Iterator[pa.RecordBatch], near: int) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v, null) of each anchor's first node with its others, and the rows (node, check, key) of anchors with more than two.

    Rows (key, node, check) come sorted by key and node.  Of the anchor that goes on in the next batch two rows are kept at most.
    """
    at, first, seen = None, (0, 0), 0
    waiting = tuple(np.zeros(0, np.int64) for _ in range(3))  # rows of this anchor while it has two or fewer
    for b in batches:
        if not b.num_rows:
            continue
        key, node, check = (c.to_numpy() for c in b.columns)
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(start, len(key)))
        goes_on = at is not None and key[0] == at
        centre, centre_check = np.repeat(node[start], size), np.repeat(check[start], size)
        place = np.arange(len(key)) - np.repeat(start, size)
        total = size.copy()
        if goes_on:
            centre[: size[0]], centre_check[: size[0]] = first
            place[: size[0]] += seen
            total[0] += seen
        i = np.flatnonzero(place > 0)
        i = i[np.bitwise_count((check[i] ^ centre_check[i]).view(np.uint64)) <= near]
        many = np.repeat(total > 2, size)
        rows = [node[many], check[many], key[many]]
        if goes_on and total[0] > 2:
            rows = [np.concatenate(x) for x in zip(waiting, rows, strict=True)]
        keys = pa.array(np.concatenate([np.zeros(len(i), np.int64), rows[2]]), mask=np.arange(len(i) + len(rows[2])) < len(i))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([centre[i], rows[0]])), pa.array(np.concatenate([node[i], rows[1]])), keys], names=["u", "v", "key"])
        last = slice(start[-1], None)
        kept = [node[last], check[last], key[last]]
        if goes_on and len(start) == 1:
            kept = [np.concatenate(x) for x in zip(waiting, kept, strict=True)]
        waiting = tuple(x[:0] if total[-1] > 2 else x for x in kept)
        at, first, seen = key[-1], (centre[-1], centre_check[-1]), int(total[-1])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], pa.Table]]:
    """Each group (its key, i and j, which are the first three columns) with its rows; rows come sorted by group."""
    held, group = [], None
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(c).to_numpy().astype(np.int64) for c in range(3)])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), b.num_rows]
        for s, e in zip(edges, edges[1:], strict=False):
            now = tuple(keys[:, s].tolist())
            if held and now != group:
                yield group, pa.Table.from_batches(held).combine_chunks()
                held = []
            group = now
            held.append(b.slice(s, e - s))
    if held:
        yield group, pa.Table.from_batches(held).combine_chunks()


def _sides(group: tuple[int, int, int], side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a group's two blocks; a block that meets itself is both."""
    first = np.flatnonzero(side == 0)
    return first, first if group[1] == group[2] else np.flatnonzero(side == 1)


def _across(batches: Iterator[pa.RecordBatch], near: int, near_all: int) -> Iterator[pa.RecordBatch]:
    """Stars (u, v) of the roots that near rows of one group connect; rows (key, i, j, side, node, check, root, l0, l1, ...) come sorted by group.

    In a group of two blocks (i < j) rows of one meet those of the other.  No group gives as many stars' rows as it has roots.
    """
    for group, t in _groups(batches):
        side, _, check, root, *lanes = (c.to_numpy() for c in t.columns[3:])
        first, other = _sides(group, side)
        found = [np.zeros(0, np.int64)] * 2
        step = max(1, CELLS // max(1, len(other)))
        for at in range(0, len(first), step):
            a = first[at : at + step]
            close = np.bitwise_count((check[a, None] ^ check[None, other]).view(np.uint64)) <= near
            i, j = np.nonzero(close & (root[a, None] != root[None, other]))
            i, j = a[i], other[j]
            i, j = (x[sum(np.bitwise_count((c[i] ^ c[j]).view(np.uint64)).astype(np.int64) for c in lanes) <= near_all] for x in (i, j))
            if len(i):  # what is connected now needs no further comparison
                member, low = local_stars(root[i], root[j])
                found = local_stars(*(np.concatenate(x) for x in zip(found, (member, low), strict=True)))
                nth = np.minimum(np.searchsorted(member, root), len(member) - 1)
                root = np.where(member[nth] == root, low[nth], root)
        if len(found[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["u", "v"])


def _candidates(many: DataFrame, roots: DataFrame, nodes: DataFrame, similarity: float, lanes: int, split_above: int) -> DataFrame:
    """Edges (u, v) between those ``roots`` that pairs with near fingerprints connect at the anchors of ``many`` (key, node, check)."""
    rows = many.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counts = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    open_ = written(counts.where("low < high").select("key", "n"), "open")
    own = [f"l{i}" for i in range(lanes)]
    rows = rows.join(small_or_shuffled(open_), "key").join(nodes.select("node", *own), "node")
    blocks = F.ceil(F.col("n") * 2 / split_above).cast("int")
    rows = rows.withColumn("mine", F.when(F.col("n") > split_above, F.pmod(F.xxhash64("node"), blocks)).otherwise(0).cast("int"))
    rows = rows.withColumn("c", F.explode(F.when(F.col("n") > split_above, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(F.lit(0)))))
    side = F.when(F.col("mine") > F.col("c"), 1).otherwise(0)
    dealt = rows.select("key", F.least("mine", "c").alias("i"), F.greatest("mine", "c").alias("j"), side.alias("side"), "node", "check", "root", *own)
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    near, near_all = most_bits(similarity, 1), most_bits(similarity, lanes)
    return written(dealt.mapInArrow(lambda it: _across(it, near, near_all), "u long, v long"), "candidates")


def _near(pairs: DataFrame, nodes: DataFrame, similarity: float, lanes: int) -> DataFrame:
    """The pairs (u, v) of ``pairs`` whose fingerprints are near in all lanes."""
    own = [f"l{i}" for i in range(lanes)]
    u_side = nodes.select(F.col("node").alias("u"), *[F.col(c).alias(f"u_{c}") for c in own])
    v_side = nodes.select(F.col("node").alias("v"), *[F.col(c).alias(f"v_{c}") for c in own])
    apart = F.expr(" + ".join(f"bit_count(u_{c} ^ v_{c})" for c in own))
    return written(pairs.join(u_side, "u").join(v_side, "v").where(apart <= most_bits(similarity, lanes)).select("u", "v"), "near")


def _sets(asked: DataFrame, nodes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(node, set, size) of the nodes in ``asked`` (node); ``texts`` has (digest, text), rows repeated or not."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_parts(whole, 1, PART_BYTES):
                found = [shingles(t.as_py(), words) for t in b.column(1)]
                size = pa.array([len(x) for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in found], pa.binary()), size], names=["node", "set", "size"])

    wanted = written(nodes.select("node", "digest").join(asked, "node", "left_semi"), "wanted")
    one = texts.join(small_or_shuffled(wanted), "digest").groupBy("node").agg(F.first("text").alias("text"))
    return written(one.mapInArrow(sets, "node long, set binary, size long"), "sets")


def _verified(near: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) of ``near`` whose sets have that similarity."""
    both = near.join(sets.select(F.col("node").alias("u"), F.col("set").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("set").alias("b")), "v")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            alike = [jaccard(*(np.frombuffer(s.as_buffer(), np.uint64) for s in pair)) >= similarity for pair in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["u", "v"]).filter(pa.array(alike, pa.bool_()))

    return written(both.select("u", "v", "a", "b").mapInArrow(check, "u long, v long"), "verified")


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of ``a`` shares with each of ``b``."""
    n, sizes = len(a), [len(x) for x in (*a, *b)]
    row = np.repeat(np.arange(len(sizes)), sizes)
    _, at, times = np.unique(np.concatenate([*a, *b]), return_inverse=True, return_counts=True)
    row, at = row[times[at] > 1], at[times[at] > 1]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    at = np.cumsum(np.append(False, at[1:] != at[:-1])) if len(at) else at
    out = np.zeros((n, len(b)), np.int64)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        s, e = np.searchsorted(at, (low, low + COLUMNS))
        has = np.zeros((len(sizes), COLUMNS), np.float32)
        has[row[s:e], at[s:e] - low] = 1
        out += (has[:n] @ has[n:].T).astype(np.int64)
    return out


def _alike(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Stars (u, v) of the similar rows of different roots of each group; rows (cluster, i, j, side, node, root, set) come sorted by group."""
    for group, t in _groups(batches):
        side, node, root = (c.to_numpy() for c in t.columns[3:6])
        if (root == root[0]).all():
            continue
        first, other = _sides(group, side)
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in t.column(6)]
        size = np.array([len(s) for s in sets])
        both = common_counts([sets[k] for k in first], [sets[k] for k in other])
        either = size[first][:, None] + size[other][None] - both
        alike = np.where(either > 0, both / np.maximum(either, 1), 1.0) >= similarity
        i, j = np.nonzero(alike & (root[first][:, None] != root[other][None]))
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in local_stars(node[first[i]], node[other[j]])], names=["u", "v"])


def _members(clusters: DataFrame, roots: DataFrame) -> DataFrame:
    """(cluster, node, root, main) of the clusters that are not of one root; ``main``: the root is the one with most members."""
    member = clusters.select("node", F.col("root").alias("cluster")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = member.groupBy("cluster", "root").agg(F.count("*").alias("n"))
    open_ = by_root.groupBy("cluster").agg(F.max_by("root", F.struct("n", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1")
    open_ = written(open_.select("cluster", "most"), "clusters")
    return written(member.join(small_or_shuffled(open_), "cluster").select("cluster", "node", "root", (F.col("root") == F.col("most")).alias("main")), "members")


def _linked(members: DataFrame, sets: DataFrame, similarity: float, block: int) -> DataFrame:
    """Edges (u, v) that connect the similar texts of each cluster; ``members`` are those of ``_members``.

    All pairs of a cluster are compared but those inside its main root.  Members are dealt to blocks, those of the main root to blocks of
    their own if there is more than one, and a task holds two blocks.
    """
    rest = ~F.col("main")
    of = members.join(sets.select("node", "size"), "node").groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum("size").alias("size"), F.count_if(rest).alias("rest"), F.sum(F.when(rest, F.col("size")).otherwise(0)).alias("rest_size")
    )
    blocks = lambda n, size: F.ceil(F.greatest(F.col(n) / block, F.col(size) / BLOCK_HASHES)).cast("int")
    of = of.withColumn("more", F.greatest(blocks("n", "size"), F.lit(1)) > 1).withColumn("main_n", F.expr("n - rest")).withColumn("main_size", F.expr("size - rest_size"))
    of = of.select("cluster", F.when(F.col("more"), blocks("rest", "rest_size")).otherwise(1).alias("x"), F.when(F.col("more"), blocks("main_n", "main_size")).otherwise(0).alias("y"))
    rows = members.join(small_or_shuffled(written(of, "blocks")), "cluster")
    apart = F.col("main") & (F.col("y") > 0)
    hashed = F.xxhash64("node")
    rows = rows.withColumn("mine", F.when(apart, F.col("x") + F.pmod(hashed, F.greatest("y", F.lit(1)))).otherwise(F.pmod(hashed, F.col("x"))).cast("int"))
    rows = rows.withColumn("c", F.explode(F.sequence(F.lit(0), F.when(apart, F.col("x")).otherwise(F.col("x") + F.col("y")) - 1)))
    side = F.when(F.col("mine") > F.col("c"), 1).otherwise(0)
    dealt = rows.select("cluster", F.least("mine", "c").alias("i"), F.greatest("mine", "c").alias("j"), side.alias("side"), "node", "root").join(sets.select("node", "set"), "node")
    dealt = dealt.select("cluster", "i", "j", "side", "node", "root", "set").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return written(dealt.mapInArrow(lambda it: _alike(it, similarity), "u long, v long"), "linked")


def _stars_of(roots: DataFrame) -> DataFrame:
    """Components (node, root) as edges (u, v), a root with itself."""
    return roots.select(F.col("node").alias("u"), F.col("root").alias("v"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    words: int = WORDS,
    lanes: int = LANES,
    split_above: int | None = None,
) -> DataFrame:
    """(doc_id, component_id) of every row.

    Two texts are linked if the Jaccard similarity of their sets of shingles of ``words`` words is ``similarity`` or more and they are in one
    cluster; equal texts are linked in any case, none below it ever.  Texts are lower-cased in A-Z only and cut at ASCII white space; a
    text of fewer words is one shingle, null texts and those without a word have none and are alike.  ``component_id`` is
    the smallest doc_id that links reach, null where no member has one.  Repeated rows each return a row.  An empty table
    gives an empty one.  Other columns are not read.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    digest = F.unhex(F.md5("text"))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [simhash.fingerprint(t.as_py(), words, lanes=lanes) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.list_(pa.int64()))], ["doc_id", "digest", "fp"])

    by_doc = written(texts.select("doc_id", digest.alias("digest"), "text").mapInArrow(prints, "doc_id long, digest binary, fp array<long>"), "fingerprints")
    distinct = by_doc.groupBy("digest").agg(F.min("doc_id").alias("low"), F.first("fp").alias("fp"))
    nodes = written(distinct.select(F.monotonically_increasing_id().alias("node"), "digest", "low", *[F.col("fp")[i].alias(f"l{i}") for i in range(lanes)]), "nodes")
    near = most_bits(similarity, 1)
    met = _anchors(nodes.drop("digest", "low"), lanes).repartition("key").sortWithinPartitions("key", "node")
    met = written(met.mapInArrow(lambda it: _stars(it, near), "u long, v long, key long"), "met")
    by_digest = texts.select(digest.alias("digest"), "text")
    pairs = written(met.where("key is null").select("u", "v").distinct(), "pairs")
    close = _near(pairs, nodes, similarity, lanes)
    sets = _sets(close.select(F.explode(F.array("u", "v")).alias("node")).distinct(), nodes, by_digest, words)
    first = _stars_of(connected_components(_verified(close, sets, similarity)))
    many = met.where("key is not null").select(F.col("u").alias("node"), F.col("v").alias("check"), "key")
    met_in = connected_components(close)
    found = _candidates(many, met_in, nodes, similarity, lanes, split_above or simhash.SPLIT_ABOVE)
    drop_written(met)
    members = _members(connected_components(_stars_of(met_in).unionByName(found)), first.toDF("node", "root"))
    sets = sets.unionByName(_sets(members.select("node").join(sets, "node", "left_anti"), nodes, by_digest, words))
    roots = connected_components(first.unionByName(_linked(members, sets, similarity, min(BLOCK, split_above or BLOCK))))
    member = nodes.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"), "low")
    lows = member.groupBy("root").agg(F.min("low").alias("component_id"))
    return by_doc.select("doc_id", "digest").join(member.join(lows, "root").select("digest", "component_id"), "digest").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, words: int = WORDS, lanes: int = LANES) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, in the columns of ``docs``; see ``simhash.one_of_each``."""
    return simhash.firsts(docs, near_duplicates(docs, id_col, text_col, similarity, words, lanes), id_col)
