"""Byte-level BPE encoding and decoding with public rank files.

Every text is cut into overlapping chunks that are pre-tokenised each on its own.  The pattern only looks
ahead, so from any position where two neighbouring chunks both begin a match they match alike; the first
such position in their overlap that follows no white space is where they are stitched.  What lies between two stitches is a piece, and
pieces are encoded apart.  Neighbours without such a position, as inside a pre-token that is as long as an
overlap, are pre-tokenised again as one chunk; the others stay as they are.

The chunks of a text of up to DEAL_ABOVE characters stay in its task.  Those of longer texts, of DEALT
characters, are dealt out to tasks in each step, and a last pass strings the ids of a text together in order.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registra.llm.common import written

#: Characters of a chunk and of the overlap of two chunks, and the same for the chunks that are dealt out.
CHUNK, OVERLAP = 4_096, 256
DEALT, DEALT_OVERLAP = 16_384, 1_024
#: Characters above which a text's chunks are dealt out.
DEAL_ABOVE = 65_536
#: A match that ends this close to a chunk's end may be cut short ('re needs two characters after the quote).
LOOKAHEAD = 2


@lru_cache(maxsize=2)
def library(path: str) -> tiktoken.Encoding:
    """The encoding of a rank file: lines of base64 token and rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def pattern() -> regex.Pattern:
    """The pre-token pattern; white space is Unicode's, as in the library."""
    white = r"\p{White_Space}"
    own = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^{white}\p{{L}}\p{{N}}]").replace(r"\S", rf"\P{{White_Space}}")
    return regex.compile(own.replace(r"\s", white))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[list[bytes], list[str]]:
    """Bytes and decimal form of each id."""
    enc = library(path)
    held = [b""] * enc.n_vocab
    for token in enc.token_byte_values():
        held[enc.encode_single_token(token)] = token
    return held, [str(i) for i in range(enc.n_vocab)]


def match_ends(text: str, last: bool) -> np.ndarray:
    """Ends of the pre-tokens of a chunk that are certain, if its start is one; matches leave no gaps."""
    ends = np.cumsum(np.fromiter(map(len, pattern().findall(text)), np.int64))
    return ends if last else ends[ends <= len(text) - LOOKAHEAD]


def after_solid(text: str, ends: np.ndarray) -> np.ndarray:
    """Ends that follow no white space; a text that is cut there has the matches of the whole text before the cut."""
    return ends[np.fromiter((not text[e - 1].isspace() for e in ends.tolist()), bool, len(ends))]


def stitches(text: str, chunk: int, overlap: int) -> list[int]:
    """Where the pieces of a text begin and end, from its chunks stitched together."""
    step = chunk - overlap
    cuts, first, ends = [0], 0, None
    for at in range(0, max(1, len(text) - overlap), step):
        stop = min(at + chunk, len(text))
        own = at + match_ends(text[at:stop], stop == len(text))
        if at:
            head = np.concatenate([[at], own[own <= at + overlap]])
            met = np.intersect1d(after_solid(text, ends[ends >= at]), head)
            if len(met):
                cuts.append(int(met[0]))
                first = at
            else:  # this chunk and the one before become one
                own = first + match_ends(text[first:stop], stop == len(text))
        ends = own
    return [*cuts, len(text)]


class Digest:
    """Count and digests of the ids of one text that come in parts."""

    def __init__(self, path: str):
        self.held, self.decimal = vocabulary(path)
        self.n, self.ids, self.decoded = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: list[int]) -> None:
        if ids:
            self.ids.update(((b"," if self.n else b"") + ",".join(map(self.decimal.__getitem__, ids)).encode()))
            self.decoded.update(b"".join(map(self.held.__getitem__, ids)))
            self.n += len(ids)

    def row(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


def _table(columns: list[pa.Array], rows: list[tuple[int, str, str]], names: list[str]) -> pa.RecordBatch:
    n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=names)


def encode(
    docs: DataFrame,
    path: str,
    keep: list[str],
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    dealt: int = DEALT,
    dealt_overlap: int = DEALT_OVERLAP,
    deal_above: int = DEAL_ABOVE,
) -> DataFrame:
    """The columns ``keep`` of every row, with n_tokens, ids_sha256, decoded_sha256 and n_pieces.

    The digests are over the decimal ids joined by commas and over the bytes that the ids decode to, which
    are the text's; n_pieces counts the pieces that were encoded apart.  A null text is empty: no tokens, the
    digests of nothing and one piece.  Repeated rows each return a row; an empty table gives an empty one.
    ``keep`` may not hold the names of the results, which replace them.  A task holds one piece of a long text at
    a time, which is longer than a chunk only by the length of its pre-tokens.
    """
    results = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "n_pieces": "long"}
    keep = [c for c in keep if c not in results]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), text.alias("_text"))
    carried = rows.select("_row").schema
    for name, kind in results.items():
        carried = carried.add(name, kind)
    short = F.length("_text") <= deal_above

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library(path)
        for b in batches:
            out, pieces = [], []
            for t in b.column(b.num_columns - 1):
                text = t.as_py()
                cuts = stitches(text, chunk, overlap)
                digest = Digest(path)
                for a, z in pairwise(cuts):
                    digest.add(enc.encode_ordinary(text[a:z]))
                out.append(digest.row())
                pieces.append(len(cuts) - 1)
            table = _table(b.columns[:-1], out, carried.names[:-1])
            yield pa.RecordBatch.from_arrays([*table.columns, pa.array(pieces, pa.int64())], names=carried.names)

    done = rows.where(short).mapInArrow(in_task, carried)
    done = done.unionByName(_encode_long(rows.where(~short), path, dealt, dealt_overlap))
    return done.select(*[F.col("_row").getField(c).alias(c) for c in keep], *results)


def _chunks_of(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """One row for each chunk of (_row, _key, _text)."""
    for b in batches:
        for i in range(b.num_rows):
            text, one = b.column(b.num_columns - 1)[i].as_py(), b.slice(i, 1)
            for at in range(0, max(1, len(text) - overlap), chunk - overlap):
                part = text[at : at + chunk]
                arrays = [pa.array([at]), pa.array([at + len(part) == len(text)]), pa.array([part])]
                yield pa.RecordBatch.from_arrays([*one.columns[:-1], *arrays], names=["_row", "_key", "_at", "_last", "_chunk"])


def _ends(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[pa.RecordBatch]:
    """Match ends of each chunk in the overlaps with the one before and the one after."""
    for b in batches:
        heads, tails = [], []
        for base, last, t in zip(b.column("_at").to_pylist(), b.column("_last").to_pylist(), b.column("_chunk"), strict=True):
            text = t.as_py()
            ends = match_ends(text, last)
            heads.append([base, *(base + ends[ends <= overlap]).tolist()] if base else [])
            tails.append([] if last else (base + after_solid(text, ends[ends >= len(text) - overlap])).tolist())
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
        yield pa.RecordBatch.from_arrays([b.column("_key"), b.column("_at"), *lists], names=["_key", "_at", "heads", "tails"])


def _encode_long(rows: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Of rows (_row, _text): _row and the results."""
    head = rows.select("_row", F.monotonically_increasing_id().alias("_key"), "_text")
    kinds = head.drop("_text").schema.add("_at", "long").add("_last", "boolean").add("_chunk", "string")
    # Written, so that the keys stay as they are; the long texts alone go through these files.
    all_ = written(head.mapInArrow(lambda it: _chunks_of(it, chunk, overlap), kinds).repartition("_key", "_at"), "chunks")
    chunks = all_.drop("_row")
    by_text = Window.partitionBy("_key").orderBy("_at")
    while True:
        found = chunks.mapInArrow(lambda it: _ends(it, overlap), "_key long, _at long, heads array<long>, tails array<long>")
        more = F.lead("_at").over(by_text).isNotNull()
        met = F.array_min(F.array_intersect("tails", F.lead("heads").over(by_text)))
        cuts = found.select("_key", "_at", met.alias("end"), (more & met.isNull()).alias("failed"))
        joined = F.coalesce(F.lag("failed").over(by_text), F.lit(False))
        run = F.sum((~joined).cast("int")).over(by_text)
        cuts = written(cuts.select("*", F.lag("end").over(by_text).alias("start"), run.alias("run"), (joined | F.col("failed")).alias("merge")), "stitches")
        if not cuts.where("failed").limit(1).count():
            break
        # Each run of chunks that did not meet becomes one chunk, without what they hold twice.
        parts = chunks.join(cuts.select("_key", "_at", "run", "merge"), ["_key", "_at"])
        follows = F.lead("_at").over(Window.partitionBy("_key", "run").orderBy("_at"))
        own = F.expr("CASE WHEN follows IS NULL THEN _chunk ELSE substring(_chunk, 1, CAST(follows - _at AS INT)) END")
        merged = (
            parts.where("merge").withColumn("follows", follows)
            .groupBy("_key", "run")
            .agg(F.min("_at").alias("_at"), F.max("_last").alias("_last"), F.array_sort(F.collect_list(F.struct("_at", own.alias("t")))).alias("p"))
            .select("_key", "_at", "_last", F.array_join(F.transform("p", lambda p: p["t"]), "").alias("_chunk"))
        )
        chunks = written(parts.where("not merge").select("_key", "_at", "_last", "_chunk").unionByName(merged), "chunks")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library(path)
        for b in batches:
            out = []
            for base, start, end, t in zip(*(b.column(c).to_pylist() for c in ("_at", "start", "end")), b.column("_chunk"), strict=True):
                text = t.as_py()
                piece = text[0 if start is None else start - base : len(text) if end is None else end - base]
                out.append(np.array(enc.encode_ordinary(piece), np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("_key"), b.column("_at"), pa.array(out, pa.binary())], names=["_key", "_at", "ids"])

    encoded = chunks.join(cuts.select("_key", "_at", "start", "end"), ["_key", "_at"])
    encoded = encoded.select("_key", "_at", "start", "end", "_chunk").mapInArrow(pieces, "_key long, _at long, ids binary")
    names = ["_key", "n_tokens", "ids_sha256", "decoded_sha256"]

    def string_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for b in batches:
            keys, done = [], []
            for own, ids in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                if own != key:
                    if digest is not None:
                        keys.append(key)
                        done.append(digest.row())
                    key, digest = own, Digest(path)
                digest.add(np.frombuffer(ids.as_py(), np.uint32).tolist())
            if keys:
                yield _table([pa.array(keys, pa.int64())], done, names)
        if digest is not None:
            yield _table([pa.array([key], pa.int64())], [digest.row()], names)

    ordered = encoded.repartition("_key").sortWithinPartitions("_key", "_at")
    digests = ordered.mapInArrow(string_together, "_key long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    counts = cuts.groupBy("_key").agg(F.count("*").alias("n_pieces"))
    return all_.where("_at = 0").select("_key", "_row").join(digests, "_key").join(counts, "_key").drop("_key")
