"""SimHash near-duplicates, found by anchor points that form a covering code.

A fingerprint has 64 bits or several times as many (lanes), and is cut into 32-bit halves.  In each half the perfect
Hamming code on 31 bits, with covering radius 1, gives the anchors: every word is within 1 of exactly one anchor, its
home.  A fingerprint is replicated to every anchor within covering radius plus threshold (1 + 1) of each half, 16 anchors
or fewer.

Narrow search, up to 3 bits of 64: fingerprints within that distance differ in at most one bit of one of their
halves.  On each anchor the fingerprints at home there are compared with all that reached it.  If two halves differ in
one bit or none, the home of the first is within 2 of the second, so no pair is missed.

Wide search: on each anchor all that reached it are compared.  Two words that differ in two bits or fewer have an anchor
within 2 of both (of the anchors within 2 of the first, one differs from it in one of these bits and the one that the code
pairs with it), so no pair is missed that differs in two bits or fewer of some half.  That is every pair within
6 * lanes - 1 bits, and a growing part of the farther ones the more lanes there are.

Each anchor yields spanning stars and not its pairs.  Copies are merged before anything is replicated.  In the narrow search,
an anchor that holds more than ``SPLIT_ABOVE`` fingerprints is dealt out again by the four bytes of the
other half, one of which must be equal in any linked pair.  What holds more after that is dealt to pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.llm.common import small_or_shuffled, written
from registra.llm.components import connected_components, local_stars

SHINGLE_WORDS, SEED, MAX_BITS = 3, 42, 3
#: Fingerprints of an anchor that are compared in one place.
SPLIT_ABOVE = 50_000
#: Edges that a task holds before it reduces them to stars.
EDGES_HELD = 1_000_000
#: Neighbours that each fingerprint of an anchor is compared with before those that are connected already are looked for; then four
#: times as many, and so on.
CONNECTED_AFTER = 8
_MASK31 = 0x7FFFFFFF


def bits_for(similarity: float, lanes: int) -> int:
    """The distance of fingerprints to expect of two texts whose sets of shingles have this Jaccard similarity."""
    return round(64 * lanes * np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def _lane(hashes: np.ndarray, lane: int) -> np.ndarray:
    """The hashes of a lane; those of the first are the shingles' own."""
    if lane == 0:
        return hashes
    x = hashes + np.uint64(lane * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit; sums of 255 rows fit a byte."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = len(bits) // 255 * 255
    return bits[:full].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64) + bits[full:].sum(0, dtype=np.int64)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED, lanes: int = 1) -> list[int]:
    """SimHash of a text as signed 64-bit integers, one for each lane; zeros for null and for texts without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not tokens:
        return [0] * lanes
    joined = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(tokens) > words:
        spans = zip(starts.tolist(), ends[words - 1 :].tolist(), strict=False)
    else:
        spans = iter([(0, len(joined))])
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros((lanes, 64), np.int64), 0
    while block := [digest(joined[a:b], seed) for _, (a, b) in zip(range(65_536), spans, strict=False)]:
        hashes = np.array(block, np.uint64)
        for lane in range(lanes):
            counts[lane] += _bit_counts(_lane(hashes, lane))
        n += len(block)
    return np.packbits(counts * 2 > n, axis=1, bitorder="little").view(np.int64)[:, 0].tolist()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, lanes: int = 1) -> DataFrame:
    """(doc_id, fp) of every row, repeated rows included; fp is an array of longs, one for each lane."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), words, lanes=lanes) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.list_(pa.int64()))], ["doc_id", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp array<long>")


def _anchored(fps: DataFrame, lanes: int) -> DataFrame:
    """(node, part, anchor, at_home, home, l0, l1, ...): each fingerprint at every anchor within 2 of each half, and the one where it is at home."""
    syndrome = " + ".join(
        f"{1 << j} * (bit_count(x & {sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1)}L) % 2)" for j in range(5)
    )
    flip = lambda i: f"shiftright(shiftleft(1L, {i}), 1)"  # noqa: E731  the bit of position i, none for 0
    own = ["node", *[f"l{i}" for i in range(lanes)]]
    halves = [f"struct({2 * i} AS part, l{i} & {_MASK31}L AS x), struct({2 * i + 1} AS part, shiftrightunsigned(l{i}, 32) & {_MASK31}L AS x)" for i in range(lanes)]
    return (
        fps.select(*own, F.expr(f"explode(array({', '.join(halves)})) AS p"))
        .select(*own, "p.part", "p.x")
        .withColumn("s", F.expr(f"CAST({syndrome} AS INT)"))
        .select(
            *own,
            "part",
            F.expr(f"x ^ {flip('s')}").alias("at_home"),
            # Positions i < j with i xor j = s; i = 0 stands for the home itself.
            F.expr(
                "explode(CASE WHEN s = 0 THEN array(x) ELSE transform(filter(sequence(0, 31), i -> i < (i ^ s)), "
                f"i -> x ^ {flip('i')} ^ {flip('(i ^ s)')}) END) AS anchor"
            ),
        )
        .select("part", "anchor", "at_home", (F.col("anchor") == F.col("at_home")).alias("home"), *own)
    )


def _compare(batches: Iterator[pa.RecordBatch], max_bits: int, wide: bool) -> Iterator[pa.RecordBatch]:
    """Stars of the linked nodes of each anchor; rows (key, home, node, l0, l1, ...) come sorted by key."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def stars(edges: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        return [local_stars(np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges]))] if edges else []

    def link(key: np.ndarray, home: np.ndarray, node: np.ndarray, *lanes: np.ndarray) -> None:
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        run = np.repeat(np.arange(len(first)), np.diff(first, append=len(key)))
        own: list[tuple[np.ndarray, np.ndarray]] = []
        i, step, size, look = np.arange(len(key)), 1, 0, CONNECTED_AFTER
        while len(i):
            i = i[i + step < len(key)]
            i = i[key[i] == key[i + step]]
            met = i if wide else i[home[i] | home[i + step]]
            apart = sum(np.bitwise_count(x[met] ^ x[met + step]).astype(np.int16) for x in lanes)
            met = met[(apart <= max_bits) & (node[met] != node[met + step])]
            if len(met):
                own.append((node[met], node[met + step]))
                size += len(met)
            if size > EDGES_HELD or (own and step == look):
                own = stars(own)
                size = len(own[0][0])
            if own and step == look:  # what is connected already needs no further comparison
                look *= 4
                member, root = own[0]
                order = np.argsort(member)
                at = np.minimum(np.searchsorted(member[order], node), len(member) - 1)
                root = np.where(member[order][at] == node, root[order][at], node)
                open_ = np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first)
                i = i[open_[run[i]]]
            step += 1
        held.extend(stars(own))
        if sum(len(h[0]) for h in held) > EDGES_HELD:
            held[:] = stars(held)

    rest: list[np.ndarray] | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        cols[3:] = [c.view(np.uint64) for c in cols[3:]]
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last key may go on in the next batch
        if cut:
            link(*[c[:cut] for c in cols])
        rest = [c[cut:] for c in cols]
    if rest is not None:
        link(*rest)
    for u, v in stars(held):
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)


def _above(rows: DataFrame, most: int) -> tuple[DataFrame, int]:
    """(key, n) of the keys with more than ``most`` rows, and how many they are."""
    hot = written(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most), "hot")
    return hot, hot.count()


def links(fps: DataFrame, max_bits: int = MAX_BITS, split_above: int | None = None, lanes: int = 1) -> DataFrame:
    """Edges (u, v) between the nodes of ``fps`` (node, l0, l1, ...) that connect those within ``max_bits``, through chains.

    Up to 3 bits of one lane, and up to 6 * lanes - 1 bits, all are connected; beyond that, those that differ in two bits or
    fewer of some 32-bit half.
    """
    split_above = split_above or SPLIT_ABOVE
    wide = lanes > 1 or max_bits > 3
    shown = ["home", "node", *[f"l{i}" for i in range(lanes)]]
    key_of = lambda name: F.expr(f"shiftleft(CAST(part AS BIGINT), 31) | {name}")
    rows = _anchored(fps, lanes).withColumn("key", key_of("anchor"))
    # What is within 2 of an anchor is at home there or at one of the 155 anchors at distance 3, so a full anchor is reached
    # from a home that has more than a 156th; only the anchors reached from such homes are counted.
    homes = rows.where("home").groupBy("key").count().where(F.col("count") > split_above // 156).select(F.col("key").alias("_home"))
    homes = written(homes, "homes")
    n_homes = homes.count()
    hot, n_hot = None, 0
    if n_homes:
        near = written(rows.join(small_or_shuffled(homes, n_homes), key_of("at_home") == F.col("_home"), "left_semi").select("key").distinct(), "near")
        hot, n_hot = _above(rows.select("key").join(small_or_shuffled(near), "key", "left_semi"), split_above)
    if n_hot and not wide:
        marked = rows.join(small_or_shuffled(hot, n_hot), "key", "left")
        other = "CASE WHEN part = 0 THEN shiftrightunsigned(l0, 32) ELSE l0 END"
        sub = f"CASE WHEN n IS NULL THEN array(key) ELSE transform(sequence(0, 3), j -> xxhash64(key, j, shiftright({other}, 8 * j) & 255L)) END"
        rows = marked.select(F.expr(f"explode({sub})").alias("key"), *shown)
        hot, n_hot = _above(rows, split_above)
    if n_hot:
        # Blocks of half that size; two of them meet in one place, and so does each with itself.
        marked = rows.select("key", *shown).join(small_or_shuffled(hot, n_hot), "key", "left")
        blocks = f"CAST(ceil(2 * n / {split_above}) AS INT)"
        pairs = f"transform(sequence(0, {blocks} - 1), c -> xxhash64(key, least(c, own), greatest(c, own)))"
        marked = marked.withColumn("own", F.expr(f"CAST(pmod(xxhash64(node), {blocks}) AS INT)"))
        rows = marked.select(F.expr(f"explode(CASE WHEN n IS NULL THEN array(key) ELSE {pairs} END)").alias("key"), *shown)
    dealt = rows.select("key", *shown).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(lambda it: _compare(it, max_bits, wide), "u long, v long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, words: int = SHINGLE_WORDS, lanes: int = 1
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Texts are lower-cased in A-Z only, cut at ASCII white space and shingled by ``words`` words; a bit is 1 if
    set in over half of the shingles' XXH64, or of what is made of it for further lanes.  ``fingerprint`` is 16 hex digits
    a lane, ``component_id`` the smallest doc_id that can be reached by ``links`` of ``max_bits`` or fewer.  Null and empty texts have
    fingerprint zero and link like others.  Repeated rows each return a row.  A null doc_id never names a
    component unless no member has an id; then component_id is null.  An empty table gives an empty one.
    Other columns of ``docs`` are not read.
    """
    by_doc = written(fingerprints(docs, id_col, text_col, words, lanes), "fingerprints")
    distinct = by_doc.groupBy("fp").agg(F.min("doc_id").alias("low"))
    # One lane names its node itself.
    node = F.col("fp")[0] if lanes == 1 else F.monotonically_increasing_id()
    distinct = written(distinct.select(node.alias("node"), "fp", "low", *[F.col("fp")[i].alias(f"l{i}") for i in range(lanes)]), "distinct")
    roots = connected_components(links(distinct.drop("fp", "low"), max_bits, lanes=lanes))
    member = distinct.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("root"), "low")
    lows = member.groupBy("root").agg(F.min("low").alias("component_id"))
    component = member.join(lows, "root").select("fp", "component_id")
    digits = F.array_join(F.transform("fp", lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")
    return by_doc.join(component, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, words: int = SHINGLE_WORDS, lanes: int = 1
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, in the columns of ``docs``.

    Rows that repeat such an id are reduced to the one whose JSON form is smallest.  Rows without an id can't be named and
    all stay.  Texts are shuffled only if the ids that go or are repeated are too many to broadcast.
    """
    return firsts(docs, near_duplicates(docs, id_col, text_col, max_bits, words, lanes), id_col)


def firsts(docs: DataFrame, members: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``one_of_each`` keeps, by the components in ``members`` (doc_id, component_id)."""
    found = written(members.where("doc_id is not null"), "members")
    ids = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.col("doc_id") == F.col("component_id")).alias("stays"))
    odd = written(ids.where("n > 1 or not stays").select(F.col("doc_id").alias("_odd"), "stays"), "odd")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), whole.alias("_row"))
    marked = rows.join(small_or_shuffled(odd), F.col("_id") == F.col("_odd"), "left")
    single = marked.where("_odd is null").select("_row")
    repeated = marked.where("stays").groupBy("_id").agg(F.min_by("_row", F.to_json(F.struct("_row"))).alias("_row")).select("_row")
    return single.unionByName(repeated).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
