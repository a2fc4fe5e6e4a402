"""Alignment of two tokenizers' tokens over the bytes of each text.

Both tokenizers cut the same bytes; where tokens of both end at one offset, a group ends.  What a range of bytes says of
the groups is a fragment: the tokens up to the first common end (an open prefix), the groups between the first and the last
common end (closed, they never change any more), and the tokens after the last one (an open suffix).  A range without a common
end is open as a whole.  Fragments form a monoid: neighbours compose by making one group of the first's suffix and the second's
prefix, or by running together where one of them is open.

Short texts are one range each.  Long ones are cut into pieces, which tasks tokenize apart, their tokens are dealt out by ranges of
bytes, whatever pieces they come from, and the ranges' fragments are reduced in a tree: only open ends move up,
closed groups stay where they were found, and each composition adds the group that it closes.  The pieces begin at a blank
after a character that is no white space, where no match of the first tokenizer's pattern and no piece of the second one lies across.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from registra.llm.common import text_parts, written
from registra.llm.vectors import slices

#: Characters above which a text is dealt out, characters of its pieces at least, and bytes of the ranges.
DEAL_ABOVE, PIECE, RANGE = 65_536, 16_384, 16_384
#: Fragments that are composed in one place.
ARITY = 16
#: Bytes of short texts handled at once.
PART_BYTES = 1 << 20
#: Pairs of ids that every task has the counts of, the most frequent ones (13 bytes each); the rest are joined.
TABLE_PAIRS = 1_000_000
#: Distinct pairs that a task gathers before it gives their counts away.
HELD_PAIRS = 2_000_000
#: Where a piece may begin; not with the last blank of a text, as a piece of one blank encodes to nothing.
_CUT = re.compile(r"(?<=\S) (?=[\s\S])")
BLOCK = "start long, n_a long, n_b long, n_groups long, groups string, links binary, counts binary"


def key_kind(a_ids: int, b_ids: int) -> str:
    """The smallest kind of number that holds the keys of all pairs of ids."""
    return "<u4" if a_ids * b_ids < 1 << 32 else "<i8"


class Side(NamedTuple):
    """A tokenizer: ids of texts that begin with a blank, and the bytes of each id with their lengths."""

    encode: Callable[[list[str]], list[np.ndarray]]
    held: list[bytes]
    sizes: np.ndarray


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level(path: str) -> Side:
    """A byte-level BPE of the tokenizers library; its special tokens are plain text.

    If ids follow the merges, as they do in plain files, they are ranks, and the same ids are had four times as fast by ranks.
    """
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    letters = _byte_letters()
    vocab = {t: i for t, i in told["model"]["vocab"].items()}
    held = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        held[i] = bytes(letters[c] for c in token)
    merges = [m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"]]
    byte_ids = len(held) - len(merges)
    splitter = told["pre_tokenizer"] or {}
    plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space") and not told["normalizer"]
    if plain and byte_ids == 256 and all(vocab["".join(m)] == byte_ids + i for i, m in enumerate(merges)):
        ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(held)}, special_tokens={})
        encode = lambda texts: [np.array(ranks.encode_ordinary(t), np.int64) for t in texts]
    else:
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True
        encode = lambda texts: [np.array(library.encode(t, add_special_tokens=False).ids, np.int64) for t in texts]
    return Side(encode, held, np.array([len(t) for t in held], np.int64))


def pieces_side(path: str) -> Side:
    """A sentencepiece model that puts a blank before what it encodes."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    held = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        held.append(bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    encode = lambda texts: [np.array(x, np.int64) for x in model.encode([t[1:] for t in texts], num_threads=1)]
    return Side(encode, held, np.array([len(t) for t in held], np.int64))


@lru_cache(maxsize=2)
def sides(a_path: str, b_path: str) -> tuple[Side, Side]:
    return byte_level(a_path), pieces_side(b_path)


class Tokens(NamedTuple):
    """Ids and ends (byte offsets, ascending) of the tokens of both sides."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def pack(self) -> bytes:
        return np.concatenate([[len(self.a)], *self]).astype(np.int64).tobytes()

    @staticmethod
    def unpack(data: bytes) -> Tokens:
        x = np.frombuffer(data, np.int64)
        n, m = int(x[0]), (len(x) - 1 - 2 * int(x[0])) // 2
        return Tokens(*np.split(x[1:], [n, 2 * n, 2 * n + m]))

    def between(self, low: int, high: int) -> Tokens:
        """Those that end after ``low`` and not after ``high``."""
        p, q = np.searchsorted(self.a_ends, [low, high], "right")
        r, s = np.searchsorted(self.b_ends, [low, high], "right")
        return Tokens(self.a[p:q], self.a_ends[p:q], self.b[r:s], self.b_ends[r:s])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(x) for x in zip(self, other, strict=True)))

    def __bool__(self) -> bool:
        return bool(len(self.a) or len(self.b))


NONE = Tokens(*[np.zeros(0, np.int64)] * 4)


class Fragment(NamedTuple):
    """What is open of a range; without a common end (``ended`` false) all of it is in ``prefix``."""

    ended: bool
    prefix: Tokens
    suffix: Tokens


def fragment(t: Tokens) -> tuple[Fragment, Tokens]:
    """The fragment of a range's tokens, and the tokens of its closed groups."""
    common = np.intersect1d(t.a_ends, t.b_ends, assume_unique=True)
    if not len(common):
        return Fragment(False, t, NONE), NONE
    first, last = int(common[0]), int(common[-1])
    return Fragment(True, t.between(-1, first), t.between(last, np.iinfo(np.int64).max)), t.between(first, last)


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, Tokens]:
    """The fragment of two neighbouring ranges, and the tokens of the group that this closes (none: no tokens)."""
    if not x.ended:
        return Fragment(y.ended, x.prefix + y.prefix, y.suffix), NONE
    if not y.ended:
        return Fragment(True, x.prefix, x.suffix + y.prefix), NONE
    return Fragment(True, x.prefix, y.suffix), x.suffix + y.prefix


def link_keys(t: Tokens, b_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Key (a * b_ids + b) and end of each link of closed groups: between two neighbouring ends lie one token of each side."""
    ends = np.sort(np.concatenate([t.a_ends, t.b_ends]), kind="stable")
    ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])] if len(ends) else ends
    return t.a[np.searchsorted(t.a_ends, ends)] * b_ids + t.b[np.searchsorted(t.b_ends, ends)], ends


@lru_cache(maxsize=2)
def _spelled(ids: int) -> list[str]:
    """Decimal ids followed by nothing, a comma, a bar and a semicolon."""
    return [f"{i}{mark}" for mark in ("", ",", "|", ";") for i in range(ids)]


def spelled(t: Tokens, starts: np.ndarray, ids: int) -> list[str]:
    """Groups as text, for each of the runs of closed groups that begin at the ascending byte offsets ``starts``.

    ``ids`` is above all ids.  The tokens of a run end after its start.
    """
    common = np.intersect1d(t.a_ends, t.b_ends, assume_unique=True)
    place = np.concatenate([2 * np.searchsorted(common, t.a_ends), 2 * np.searchsorted(common, t.b_ends) + 1])
    order = np.argsort(place, kind="stable")
    place = place[order]
    upto = np.searchsorted(common, starts, "right")  # groups before each run
    edges = np.append(np.searchsorted(place, 2 * upto), len(place))
    mark = np.where(np.append(place[1:] == place[:-1], False), 1, 2 + (place & 1))
    last = edges[1:][edges[1:] > edges[:-1]] - 1
    mark[last] = 0
    words = _spelled(ids)
    codes = (mark * ids + np.concatenate([t.a, t.b])[order]).tolist()
    get = words.__getitem__
    return ["".join(map(get, codes[s:e])) for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def block_rows(t: Tokens, starts: np.ndarray, a_ids: int, b_ids: int) -> dict[str, list]:
    """Columns of BLOCK for each of the runs of closed groups that begin at ``starts``; distinct links with their counts."""
    common = np.intersect1d(t.a_ends, t.b_ends, assume_unique=True)
    bounds = np.append(starts[1:], np.iinfo(np.int64).max)
    held = lambda ends: (np.searchsorted(ends, bounds, "right") - np.searchsorted(ends, starts, "right")).tolist()
    keys, ends = link_keys(t, b_ids)
    run = np.searchsorted(starts, ends - 1, "right") - 1
    distinct, counts = np.unique(run * (a_ids * b_ids) + keys, return_counts=True)
    edges = np.searchsorted(distinct, np.arange(len(starts) + 1) * (a_ids * b_ids)).tolist()
    distinct = (distinct % (a_ids * b_ids)).astype(key_kind(a_ids, b_ids))
    cut = lambda x: [x[s:e].tobytes() for s, e in zip(edges, edges[1:], strict=False)]
    texts = spelled(t, starts, max(a_ids, b_ids))
    return {"start": starts.tolist(), "n_a": held(t.a_ends), "n_b": held(t.b_ends), "n_groups": held(common), "groups": texts, "links": cut(distinct), "counts": cut(counts.astype(np.uint32))}


def tokenized(texts: list[str], pair: tuple[Side, Side], at: list[int]) -> list[Tokens | None]:
    """Tokens of texts that begin with a blank, with ends counted from ``at``; None if either side's bytes are not the text's."""
    out: list[Tokens | None] = []
    for text, offset, a, b in zip(texts, at, *(s.encode(texts) for s in pair), strict=True):
        raw = text.encode()
        same = all(b"".join(map(s.held.__getitem__, ids.tolist())) == raw for s, ids in zip(pair, (a, b), strict=True))
        out.append(Tokens(a, offset + np.cumsum(pair[0].sizes[a]), b, offset + np.cumsum(pair[1].sizes[b])) if same else None)
    return out


def _short(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], digest: bool) -> Iterator[pa.RecordBatch]:
    """BLOCK of each of the texts (_key, _text): one run for a text; ``groups`` is its digest, or the text of the groups."""
    pair = sides(*paths)
    a_ids, b_ids = (len(s.held) for s in pair)
    for whole in batches:
        for b in text_parts(whole, 1, PART_BYTES):
            texts = b.column(1).to_pylist()
            full = [i for i, t in enumerate(texts) if t]
            at = np.cumsum([0, *(len(texts[i].encode()) + 1 for i in full)]).tolist()
            found = tokenized([" " + texts[i] for i in full], pair, at[:-1]) if full else []
            good = [k for k, t in enumerate(found) if t]
            rows = {"start": [0] * len(texts), "n_a": [0] * len(texts), "n_b": [0] * len(texts), "n_groups": [0] * len(texts), "groups": [""] * len(texts), "links": [b""] * len(texts), "counts": [b""] * len(texts)}
            if good:
                all_ = Tokens(*(np.concatenate(x) for x in zip(*(found[k] for k in good), strict=True)))
                runs = block_rows(all_, np.array([at[k] for k in good], np.int64), a_ids, b_ids)
                for name, values in runs.items():
                    if name == "groups" and digest:
                        values = [hashlib.sha256(v.encode()).hexdigest() for v in values]
                    if name != "start":
                        for k, v in zip(good, values, strict=True):
                            rows[name][full[k]] = v
            yield _batch([b.column(0)], ["_key"], rows)


def _batch(columns: list[pa.Array], names: list[str], rows: dict[str, list]) -> pa.RecordBatch:
    kinds = {"groups": pa.string(), "links": pa.binary(), "counts": pa.binary()}
    arrays = [pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()]
    return pa.RecordBatch.from_arrays([*columns, *arrays], names=[*names, *rows])


def _pieces(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(_key, _at, _piece) of the texts (_key, _text)."""
    for b in batches:
        for key, text in zip(b.column(0), b.column(1), strict=True):
            text, at, begin = " " + text.as_py(), 0, 0
            while begin < len(text):
                cut = _CUT.search(text, begin + least)
                end = cut.start() if cut else len(text)
                piece = text[begin:end]
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()]), pa.array([at]), pa.array([piece])], names=["_key", "_at", "_piece"])
                at, begin = at + len(piece.encode()), end


def _dealt(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], size: int) -> Iterator[pa.RecordBatch]:
    """(_key, idx, _at, tokens): the tokens of each piece by the range of bytes in which they end; null tokens: a piece's bytes differ."""
    pair = sides(*paths)
    for b in batches:
        for key, at, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            text = piece.as_py()
            t = tokenized([text], pair, [at])[0]
            first, last = at // size, (at + len(text.encode()) - 1) // size
            idx = [first] if t is None else list(range(first, last + 1))
            tokens = [None] if t is None else [t.between(i * size, (i + 1) * size).pack() for i in idx]
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(idx)), pa.array(idx), pa.array([at] * len(idx)), pa.array(tokens, pa.binary())], names=["_key", "idx", "_at", "tokens"])


FRAGMENT = f"_key long, idx long, ended boolean, prefix binary, suffix binary, {BLOCK}"


def _fragment_rows(key: int, idx: int, f: Fragment | None, closed: list[Tokens], a_ids: int, b_ids: int) -> pa.RecordBatch:
    """The row of a fragment, if there is one, and a row for each of the runs of groups that are closed."""
    runs = [t for t in closed if t]
    # A run begins where its first token does, which its order among runs needs and nothing else.
    starts = [min(int(t.a_ends[0]), int(t.b_ends[0])) - 1 for t in runs]
    blocks = [block_rows(t, np.array([s]), a_ids, b_ids) for t, s in zip(runs, starts, strict=True)]
    rows = {n: [None] * (f is not None) + [b[n][0] for b in blocks] for n in ("start", "n_a", "n_b", "n_groups", "groups", "links", "counts")}
    head = [[key] * (len(runs) + (f is not None))]
    for value in (idx, f and f.ended, f and f.prefix.pack(), f and f.suffix.pack()):
        head.append([value] * (f is not None) + [None] * len(runs))
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
    return _batch([pa.array(v, k) for v, k in zip(head, kinds, strict=True)], ["_key", "idx", "ended", "prefix", "suffix"], rows)


def _groups_of(batches: Iterator[pa.RecordBatch], arity: int) -> Iterator[tuple[int, int, list[dict]]]:
    """Neighbouring rows of one _key and one idx // arity."""
    at, held = None, []
    for b in batches:
        for row in b.to_pylist():
            now = row["_key"], row["idx"] // arity
            if held and now != at:
                yield *at, held
                held = []
            at = now
            held.append(row)
    if held:
        yield *at, held


def _long(texts: DataFrame, paths: tuple[str, str], piece: int, size: int, arity: int) -> DataFrame:
    """_key and BLOCK of the long texts (_key, _text): several runs of groups for each, in the order of ``start``."""
    counts_of = lambda: tuple(len(s.held) for s in sides(*paths))
    cut = texts.mapInArrow(lambda it: _pieces(it, piece), "_key long, _at long, _piece string").repartition("_key", "_at")
    dealt = written(cut.mapInArrow(lambda it: _dealt(it, paths, size), "_key long, idx long, _at long, tokens binary"), "dealt")
    odd = dealt.where("tokens is null").select("_key").distinct()
    good = dealt.join(odd, "_key", "left_anti")

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, idx, rows in _groups_of(batches, 1):
            t = NONE
            for row in rows:
                t = t + Tokens.unpack(row["tokens"])
            f, closed = fragment(t)
            yield _fragment_rows(key, idx, f, [closed], *counts_of())

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, idx, rows in _groups_of(batches, arity):
            f, closed = None, []
            for row in rows:
                y = Fragment(row["ended"], Tokens.unpack(row["prefix"]), Tokens.unpack(row["suffix"]))
                f, seam = (y, NONE) if f is None else compose(f, y)
                closed.append(seam)
            yield _fragment_rows(key, idx, f, closed, *counts_of())

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Both sides end with the text, so what is open of a whole text is the group that it begins with.
        for key, idx, rows in _groups_of(batches, 1):
            yield _fragment_rows(key, idx, None, [Tokens.unpack(rows[0]["prefix"])], *counts_of())

    open_ = ["_key", "idx", "ended", "prefix", "suffix"]
    closed_ = ["_key", *(c.split()[0] for c in BLOCK.split(", "))]
    now = written(good.repartition("_key", "idx").sortWithinPartitions("_key", "idx", "_at").mapInArrow(fragments, FRAGMENT), "fragments")
    blocks = now.where("idx is null").select(*closed_)
    last = now.agg(F.max("idx")).first()[0] or 0
    while last:
        up = now.where("idx is not null").select(*open_).repartition("_key", F.floor(F.col("idx") / arity)).sortWithinPartitions("_key", "idx")
        now = written(up.mapInArrow(composed, FRAGMENT), "fragments")
        blocks = blocks.unionByName(now.where("idx is null").select(*closed_))
        last //= arity
    firsts = now.where("idx is not null").select(*open_).mapInArrow(ended, FRAGMENT)
    return blocks.unionByName(firsts.select(*closed_))


def _counted(blocks: DataFrame, kind: str) -> DataFrame:
    """(pair, n): how many links of the corpus hold each pair of ids."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            all_, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(all_), np.int64)
            np.add.at(total, inverse, np.concatenate(counts))
            return all_, total

        for b in batches:
            keys.append(np.frombuffer(b"".join(b.column(0).to_pylist()), kind).astype(np.int64))
            counts.append(np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).astype(np.int64))
            held += len(keys[-1])
            if held > HELD_PAIRS:
                k, n = summed()
                keys, counts, held = [k], [n], len(k)
                if held > HELD_PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], names=["pair", "n"])
                    keys, counts, held = [], [], 0
        if keys:
            k, n = summed()
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], names=["pair", "n"])

    return blocks.select("links", "counts").mapInArrow(gather, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _ranked(blocks: DataFrame, b_ids: int, kind: str) -> DataFrame:
    """(pair, n, best): best says that no pair with the same second id has a higher count."""
    pairs = written(_counted(blocks, kind), "pairs").withColumn("b", F.col("pair") % b_ids)
    highest = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return written(pairs.join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "ranked")  # a row for each id of a vocabulary


def _table(ranked: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Keys, counts and marks of the most frequent pairs, ``most`` or fewer, and whether these are all."""
    level = F.floor(8 * F.log2("n")).cast("int")  # at most 505 levels
    levels = sorted(((r["level"], r["count"]) for r in ranked.groupBy(level.alias("level")).count().collect()), reverse=True)
    upto = np.cumsum([n for _, n in levels])
    taken = int(np.searchsorted(upto, most, "right"))
    rows = ranked.where(level >= levels[taken - 1][0]) if taken else ranked.limit(0)
    t = rows.toArrow()
    pair, n, best = (t.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    return pair[order], n[order], best[order], taken == len(levels)


def _scored(blocks: DataFrame, ranked: DataFrame, most: int, kind: str) -> DataFrame:
    """(_key, n_best, count_sum) of every text, from its blocks."""
    pair, n, best, all_ = _table(ranked, most)
    sent = blocks.sparkSession.sparkContext.broadcast((pair, n, best))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts_of, marks = sent.value
        for b in slices(batches, 512):
            links, counts = b.column(1).to_pylist(), b.column(2).to_pylist()
            row = np.repeat(np.arange(b.num_rows), [len(x) // 4 for x in counts])
            link = np.frombuffer(b"".join(links), kind).astype(np.int64)
            times = np.frombuffer(b"".join(counts), np.uint32).astype(np.int64)
            at = np.minimum(np.searchsorted(keys, link), max(0, len(keys) - 1))
            known = keys[at] == link if len(keys) else np.zeros(len(link), bool)
            sums = np.zeros((2, b.num_rows), np.int64)
            if len(keys):
                np.add.at(sums[0], row[known], times[known] * marks[at[known]])
                np.add.at(sums[1], row[known], times[known] * counts_of[at[known]])
            own = b.column(0).to_numpy()
            rest = row[~known]
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[0]), pa.array(sums[1]), none, none], names=["_key", "n_best", "count_sum", "pair", "times"])
            if len(rest):
                zero = pa.array(np.zeros(len(rest), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(own[rest]), zero, zero, pa.array(link[~known]), pa.array(times[~known])], names=["_key", "n_best", "count_sum", "pair", "times"])

    found = blocks.select("_key", "links", "counts").mapInArrow(score, "_key long, n_best long, count_sum long, pair long, times long")
    if not all_:
        found = written(found, "scores")
        rest = found.where("pair is not null").select("_key", "pair", "times").join(ranked, "pair")
        rest = rest.select("_key", (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
        found = found.where("pair is null").select("_key", "n_best", "count_sum").unionByName(rest)
    return found.groupBy("_key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _digests(blocks: DataFrame) -> DataFrame:
    """(_key, n_a, n_b, n_groups, groups_sha256) of the long texts, from their blocks in order."""
    names = ["_key", "n_a", "n_b", "n_groups", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums, digest = None, [0, 0, 0], None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at]), *(pa.array([s]) for s in sums), pa.array([digest.hexdigest()])], names=names)

        for b in batches:
            for key, *own, text in zip(*(b.column(c).to_pylist() for c in ("_key", "n_a", "n_b", "n_groups")), b.column("groups"), strict=True):
                if key != at:
                    if digest is not None:
                        yield row()
                    at, sums, digest = key, [0, 0, 0], hashlib.sha256()
                else:
                    digest.update(b";")
                digest.update(text.as_py().encode())
                sums = [s + o for s, o in zip(sums, own, strict=True)]
        if digest is not None:
            yield row()

    ordered = blocks.select("_key", "start", "n_a", "n_b", "n_groups", "groups").repartition("_key").sortWithinPartitions("_key", "start")
    return ordered.mapInArrow(run, "_key long, n_a long, n_b long, n_groups long, groups_sha256 string")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("_key"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("_text"))


def groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", deal_above: int = DEAL_ABOVE) -> DataFrame:
    """(doc_id, start, groups): the groups of every text with tokens, as ``a1,a2|b1;a3|b2,b3``.

    A long text has several rows, in the order of ``start``.
    """
    rows = _keyed(docs, id_col, text_col)
    rows = written(rows.where("_text <> ''"), "texts")
    short = F.length("_text") <= deal_above
    texts = rows.select("_key", "_text")
    found = texts.where(short).mapInArrow(lambda it: _short(it, (a_path, b_path), False), f"_key long, {BLOCK}")
    found = found.unionByName(_long(texts.where(~short), (a_path, b_path), PIECE, RANGE, ARITY)).where("n_groups > 0")
    return rows.select("_key", "doc_id").join(found, "_key").select("doc_id", "start", "groups")


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    deal_above: int = DEAL_ABOVE,
    piece: int = PIECE,
    size: int = RANGE,
    arity: int = ARITY,
    table_pairs: int | None = None,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Tokens of the byte-level tokenizer of ``a_path`` over a blank and the text, and of the sentencepiece model of ``b_path`` over
    the text.  ``n_links`` counts the pairs of tokens, one of each side, whose bytes overlap; the count of a pair of ids is
    the number of links of the whole corpus that hold it; ``n_best`` counts the links whose count is the highest of their second
    id, ties included, ``count_sum`` sums the counts over the links.  ``groups_sha256`` is over the groups as ``groups`` spells them.

    Null and empty texts, and texts whose bytes either tokenizer does not give back, have no tokens: zeros and an empty digest.  Repeated rows
    each return a row and count each time; a null id stays null.  An empty table gives an empty one.  Other columns are not read.
    A task holds the tokens of one range of a long text, and what is open of ``arity`` ranges; the whole text is held
    where it is cut into pieces, and one piece, which is longer than ``piece`` by what has no blank, where it is tokenized.
    """
    paths = (a_path, b_path)
    rows = _keyed(docs, id_col, text_col)
    short = F.length("_text") <= deal_above
    # A row keeps its key and id through the tokenizing; long texts, which pass several steps, are written first.
    ids = rows.where(short).select("_key", "doc_id", "_text")
    near = written(_with_ids(ids, paths), "short")
    far = written(rows.where(~short), "long")
    long_blocks = written(_long(far.select("_key", "_text"), paths, piece, size, arity), "blocks")
    blocks = near.select("_key", "links", "counts").unionByName(long_blocks.select("_key", "links", "counts"))
    # Of the two parts of a table each key counts up by itself, so those of long texts are told apart by their sign.
    a_ids, b_ids = (len(s.held) for s in sides(*paths))
    kind = key_kind(a_ids, b_ids)
    ranked = _ranked(blocks, b_ids, kind)
    signed = near.select("_key", "links", "counts").unionByName(long_blocks.select((-1 - F.col("_key")).alias("_key"), "links", "counts"))
    scores = _scored(signed, ranked, TABLE_PAIRS if table_pairs is None else table_pairs, kind)
    done = near.select("_key", "doc_id", "n_a", "n_b", "n_groups", F.col("groups").alias("groups_sha256"))
    digests = far.select("_key", "doc_id").join(_digests(long_blocks), "_key", "left")
    done = done.unionByName(digests.withColumn("_key", -1 - F.col("_key"))).join(scores, "_key", "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    links = n("n_a") + n("n_b") - n("n_groups")
    counts = [n(c).alias(c) for c in ("n_a", "n_b", "n_groups")]
    return done.select("doc_id", *counts, links.alias("n_links"), n("n_best").alias("n_best"), n("count_sum").alias("count_sum"), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def _with_ids(rows: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(_key, doc_id) and BLOCK of the short texts (_key, doc_id, _text), with the digest in place of the groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            for b in _short(iter([whole.select(["_key", "_text"])]), paths, True):
                ids = whole.column("doc_id").slice(at, b.num_rows)
                at += b.num_rows
                yield pa.RecordBatch.from_arrays([b.column(0), ids, *b.columns[1:]], names=["_key", "doc_id", *b.schema.names[1:]])

    return rows.mapInArrow(run, f"_key long, doc_id long, {BLOCK}")
