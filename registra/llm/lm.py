"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network predicts each token from the WINDOW tokens on both of its sides: embeddings by place, a hidden
layer, and a softmax in two steps, first over classes of words of like frequency, then within the class.
It is trained in numpy on the whole corpus: every document is dealt to a shard by a hash of its id and words, a shard is
passed over in the order of ids, a seeded share of its places being the targets, and the shards' weights are averaged by
the number of places; this is repeated until each place of the corpus was a target once.  So equal tables give equal
weights, however their rows lie.  A document's score is the sum of the log-probabilities of all its tokens, each given both sides.

Words are lower-cased text between ASCII white space, and all words of the corpus are its vocabulary.  The
most frequent have entries of their own in the network; the others share hashed entries, and a word's part
of its entry is its part of the entry's tokens: log p(word) = log p(entry | both sides) + log(n(word) /
n(entry)).  These counts are a table that grows with the corpus.  The parts of the TABLE_WORDS most frequent words are
known to every task, by their hashes; those of all other words are joined, never collected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from registra.llm.common import text_parts, written

#: Entries of the vocabulary (CLASSES classes of CLASS_WORDS) and how many of them are hashed.
CLASSES, CLASS_WORDS, HASHED = 32, 32, 64
VOCABULARY = CLASSES * CLASS_WORDS
PAD = VOCABULARY
WINDOW, EMBED, HIDDEN = 2, 16, 32
PLACES = [o for o in range(-WINDOW, WINDOW + 1) if o]
RATES, BATCH, SEED = (6e-3, 2e-3), 8_192, 3
#: Tokens scored at once, and words whose parts of their entries every task knows (18 bytes each).
BLOCK, TABLE_WORDS = 16_384, 1_000_000
#: Bytes of 16-bit ids laid out at once, and rows of a word that are summed before its runs are.
ID_BYTES, RUN = 1 << 20, 8
#: Tokens of a training shard, and bytes of text whose distinct words are counted and looked up together.
SHARD_TOKENS, TEXT_BYTES, LOOKUP_BYTES = 4_000_000, 8 << 20, 2 << 20
#: Fixed-point units of shares and of summed weights.
SHARE_UNITS, WEIGHT_UNITS = 1 << 32, 1 << 28
SHAPES = {
    "embed": (VOCABULARY + 1, EMBED),
    "mix": (len(PLACES), EMBED, HIDDEN),
    "bias": (HIDDEN,),
    "to_class": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "to_word": (CLASSES, HIDDEN, CLASS_WORDS),
    "word_bias": (CLASSES, CLASS_WORDS),
}
Weights = dict[str, np.ndarray]


def start_weights(seed: int = SEED) -> Weights:
    rng = np.random.default_rng(seed)
    return {k: (np.zeros(s) if "bias" in k else rng.normal(0, 0.1, s)).astype(np.float32) for k, s in SHAPES.items()}


def flat(w: Weights) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def shaped(v: np.ndarray) -> Weights:
    ends = np.cumsum([int(np.prod(s)) for s in SHAPES.values()])
    return {k: p.reshape(s).astype(np.float32) for (k, s), p in zip(SHAPES.items(), np.split(v, ends[:-1]), strict=True)}


def _softmax_parts(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each column: the sum of exp(z - max), which is made in place, and max + log(sum), the log of the sum of exp(z)."""
    most = z.max(0)
    z -= most
    np.exp(z, out=z)
    total = z.sum(0)
    return total, most + np.log(total)


def _hidden(w: Weights, folded: np.ndarray, context: np.ndarray, order: np.ndarray) -> np.ndarray:
    hidden = folded[0].take(context[:, 0].take(order), 0)
    for j in range(1, len(PLACES)):
        hidden += folded[j].take(context[:, j].take(order), 0)
    hidden += w["bias"]
    return np.maximum(hidden, 0, out=hidden)


def _logits(to: np.ndarray, bias: np.ndarray, hidden: np.ndarray) -> np.ndarray:
    """(choices, places): choices along the first axis, so that sums over them go along rows of places."""
    z = to.T @ hidden.T
    z += bias[:, None]
    return z


def _by_class(target: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """An order of the targets by class, and where the classes end in it."""
    group = (target // CLASS_WORDS).astype(np.int16)
    order = np.argsort(group, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(group, minlength=CLASSES))]).tolist()


def laid(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents (``ends``: where each ends in ``ids``) with WINDOW pads around each, and where each id stands in that."""
    at = np.arange(len(ids)) + np.repeat(WINDOW * np.arange(1, len(ends) + 1), np.diff(ends, prepend=0))
    padded = np.full(len(ids) + WINDOW * (len(ends) + 1), PAD, np.int32)
    padded[at] = ids
    return padded, at


def around(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Neighbours (places, PLACES) of places of ``laid`` documents, each column in one piece."""
    return np.stack([padded.take(at + o) for o in PLACES]).T


def contexts(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Neighbours (places, PLACES) of the places ``at`` of one document."""
    padded, places = laid(ids, np.array([len(ids)]))
    return around(padded, places[at])


def log_probabilities(w: Weights, folded: np.ndarray, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log p(target | both sides); ``folded`` is ``fold(w)``.  Rows are brought in the order of their classes once."""
    order, ends = _by_class(target)
    hidden, word = _hidden(w, folded, context, order), (target % CLASS_WORDS).take(order)
    logits, n = _logits(w["to_class"], w["class_bias"], hidden), np.arange(len(target))
    score = np.concatenate([logits[c, ends[c] : ends[c + 1]] for c in range(CLASSES)])
    score -= _softmax_parts(logits)[1]
    for c in range(CLASSES):
        rows = slice(ends[c], ends[c + 1])
        if ends[c] < ends[c + 1]:
            logits = _logits(w["to_word"][c], w["word_bias"][c], hidden[rows])
            score[rows] += logits[word[rows], n[: logits.shape[1]]]
            score[rows] -= _softmax_parts(logits)[1]
    out = np.empty_like(score)
    out[order] = score
    return out


def fold(w: Weights) -> np.ndarray:
    """What each word at each place adds to the hidden layer."""
    return np.stack([w["embed"] @ m for m in w["mix"]])


def _summed(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words, ascending, and the sum of each one's rows; the last row, zero, is none's.

    Up to RUN rows of a word are summed by whole columns of row numbers, then what is left of each word.
    """
    order = np.argsort(words.astype(np.int16), kind="stable")
    counts = np.bincount(words, minlength=VOCABULARY + 1)
    found = np.flatnonzero(counts)
    counts = counts[found]
    runs = -(-counts // RUN)
    first = np.cumsum(runs) - runs
    which = np.full(int(runs.sum()) * RUN, len(rows) - 1)
    which[np.arange(len(words)) + np.repeat(first * RUN - (np.cumsum(counts) - counts), counts)] = order
    columns = np.ascontiguousarray(which.reshape(-1, RUN).T)
    out = rows.take(columns[0], 0)
    for column in columns[1:]:
        out += rows.take(column, 0)
    return found, np.add.reduceat(out, first)


def gradients(w: Weights, context: np.ndarray, target: np.ndarray) -> Weights:
    """Of the mean negative log-probability."""
    n = len(target)
    order, ends = _by_class(target)
    word = (target % CLASS_WORDS).take(order)
    hidden, at = _hidden(w, fold(w), context, order), np.arange(n)
    d = _logits(w["to_class"], w["class_bias"], hidden)
    d /= _softmax_parts(d)[0]
    for c in range(CLASSES):
        d[c, ends[c] : ends[c + 1]] -= 1
    g = {"to_class": hidden.T @ d.T / n, "class_bias": d.sum(1) / n, "to_word": np.zeros_like(w["to_word"]), "word_bias": np.zeros_like(w["word_bias"])}
    d_hidden = np.zeros((n + 1, HIDDEN), hidden.dtype)  # the last row stays zero
    np.matmul(d.T, w["to_class"].T, out=d_hidden[:n])
    for c in range(CLASSES):
        rows = slice(ends[c], ends[c + 1])
        if ends[c] < ends[c + 1]:
            h = hidden[rows]
            d = _logits(w["to_word"][c], w["word_bias"][c], h)
            d /= _softmax_parts(d)[0]
            d[word[rows], at[: len(h)]] -= 1
            g["to_word"][c], g["word_bias"][c] = h.T @ d.T / n, d.sum(1) / n
            d_hidden[rows] += d.T @ w["to_word"][c].T
    d_hidden[:n] *= hidden > 0
    g["bias"] = d_hidden.sum(0) / n
    g["mix"], g["embed"] = np.zeros_like(w["mix"]), np.zeros_like(w["embed"])
    for p in range(len(PLACES)):  # what repeated words add is summed before it is multiplied
        words, d_word = _summed(context[:, p].take(order), d_hidden)
        d_word /= n
        g["mix"][p] = w["embed"][words].T @ d_word
        g["embed"][words] += d_word @ w["mix"][p].T
    return g


def targets_of(ids: np.ndarray, ends: np.ndarray, n_pass: int, passes: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The places of documents that a pass takes as targets, and how many of each; the passes share out all places."""
    sizes = np.diff(ends, prepend=0)
    begins = ends - sizes
    starts = np.fromiter((zlib.crc32(ids[a : min(a + 64, b)].data, seed) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)), np.int64, len(ends))
    mixed = ((np.arange(len(ids)) + np.repeat(starts - begins, sizes)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    at = np.flatnonzero(mixed.astype(np.uint32) % np.uint32(passes) == n_pass)
    return at, np.diff(np.searchsorted(at, ends), prepend=0)


def targets(doc: np.ndarray, n_pass: int, passes: int, seed: int = SEED) -> np.ndarray:
    """The places of a document that a pass takes as targets."""
    return targets_of(np.ascontiguousarray(doc, np.int64), np.array([len(doc)]), n_pass, passes, seed)[0]


def learning_batches(blocks: Iterable[tuple[np.ndarray, np.ndarray]], n_pass: int, passes: int, batch: int, seed: int = SEED) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(context, target) of the targets in documents (ids, ends) that a pass takes, in their order.

    A document's targets come in pieces of ``batch`` at most, and a batch ends with the piece that fills it.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for ids, ends in blocks:
        padded, place = laid(ids, ends)
        at, counts = targets_of(ids, ends, n_pass, passes, seed)
        at, begin, upto = place[at], 0, 0
        for count in counts.tolist():
            while count:
                piece = min(batch, count)
                count, upto, size = count - piece, upto + piece, size + piece
                if size >= batch:
                    held.append((around(padded, at[begin:upto]), padded[at[begin:upto]]))
                    yield _joined(held)
                    held, begin, size = [], upto, 0
        if begin < upto:
            held.append((around(padded, at[begin:]), padded[at[begin:]]))
    if held:
        yield _joined(held)


def _joined(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(held) == 1:
        return held[0]
    return np.concatenate([c.T for c, _ in held], axis=1).T, np.concatenate([t for _, t in held])


def id_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of little-endian 16-bit entries, and where each document ends in them."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)) // 2
    raw = b"".join(x.as_buffer() for x in column)
    return np.frombuffer(raw, "<u2").astype(np.int64), ends


class Adam:
    def __init__(self, w: Weights, rate: float):
        self.w, self.rate, self.step = w, rate, 0
        self.m, self.v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))

    def __call__(self, context: np.ndarray, target: np.ndarray) -> None:
        self.step += 1
        for k, g in gradients(self.w, context, target).items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            self.w[k] = (self.w[k] - self.rate * (self.m[k] / (1 - 0.9**self.step)) / (np.sqrt(self.v[k] / (1 - 0.999**self.step)) + 1e-8)).astype(np.float32)


class Table(NamedTuple):
    """Entries and shares of words by their XXH64, in its order.

    A share is the log of a word's part of its hashed entry, in whole numbers of 1 / SHARE_UNITS, so that sums do not
    depend on order; it is 0 for words with an entry of their own.
    """

    hashes: np.ndarray
    entries: np.ndarray
    shares: np.ndarray

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where hashes stand, and which of them do."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        return at, self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)


def table_of(counts: DataFrame) -> tuple[Table, DataFrame]:
    """The most frequent words of (word, n), ties by name, and (h, share) of all others."""
    # Classes of frequency, a sixteenth of an octave each, are counted first; only those that fit as a whole are collected.
    octave = F.floor(16 * F.log2("n")).cast("int")
    least, held = None, 0
    for r in sorted(counts.groupBy(octave.alias("o")).count().collect(), reverse=True):
        held += r["count"]
        if held > TABLE_WORDS:
            break
        least = r["o"]
    own = [r[0] for r in counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - HASHED).collect()]
    # VOCABULARY - HASHED words and HASHED entries are broadcast.
    spark = counts.sparkSession
    rare = counts.join(F.broadcast(spark.createDataFrame([(w,) for w in own], "word string")), "word", "left_anti").withColumn("entry", F.expr(f"crc32(CAST(word AS BINARY)) % {HASHED}"))
    totals = rare.groupBy("entry").agg(F.sum("n").alias("total"))
    share = F.round((F.log("n") - F.log("total")) * SHARE_UNITS).cast("long")
    # Hashed entries lie among the rare words, in the last classes.
    shares = rare.join(F.broadcast(totals), "entry").select(F.xxhash64("word").alias("h"), (F.col("entry") + (VOCABULARY - HASHED)).cast("int").alias("entry"), share.alias("share"), octave.alias("o"))
    known = F.lit(False) if least is None else F.col("o") >= least
    near = shares.where(known).select("h", "entry", "share").toArrow()  # TABLE_WORDS at most
    h = np.concatenate([np.array([digest(w) for w in own], np.int64), near.column("h").to_numpy()])
    entry = np.concatenate([np.arange(len(own)), near.column("entry").to_numpy()]).astype("<u2")
    part = np.concatenate([np.zeros(len(own), np.int64), near.column("share").to_numpy()])
    order = np.argsort(h, kind="stable")
    return Table(h[order], entry[order], part[order]), shares.where(~known).select("h", "share")


def digest(word: str) -> int:
    """A word's hash, as Spark's xxhash64."""
    h = xxhash.xxh64_intdigest(word, 42)
    return h - (1 << 64) if h >> 63 else h


def hashed_entry(word: str | bytes) -> int:
    return VOCABULARY - HASHED + zlib.crc32(word.encode() if isinstance(word, str) else word) % HASHED


def _parts(batches: Iterable[pa.RecordBatch], col: int, size: int) -> Iterator[pa.RecordBatch]:
    """``text_parts`` of all batches; what Arrow holds unused goes back to the system after each batch, as workers live on."""
    for b in batches:
        yield from text_parts(b, col, size)
        pa.default_memory_pool().release_unused()


def counted_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the words of parts of the texts, each word once a part."""
    for b in _parts(batches, 0, TEXT_BYTES):
        found = pc.value_counts(pc.ascii_split_whitespace(b.column(0)).flatten())
        counts = pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "n"])
        yield counts.filter(pc.not_equal(pc.binary_length(counts.column(0)), 0))


def entries(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, ids, share, rare) of every row, and (h, share) of the words that ``rare`` holds.

    ids are little-endian 16-bit entries; share sums the shares of the words in the table; rare holds XXH64 of the other
    words in hashed entries, as often as they occur; row numbers the rows.
    """
    text = F.lower(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    words = rows.select("text").mapInArrow(counted_words, "word string, n long")
    table, shares = table_of(written(words.groupBy("word").agg(F.sum("n").alias("n")), "words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches, 2, LOOKUP_BYTES):
            lists = pc.ascii_split_whitespace(b.column(2))
            coded = lists.flatten().dictionary_encode()
            found = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in found), np.uint64, len(found)).view(np.int64)
            place, known = table.find(hashes)
            entry = np.zeros(len(found), "<u2")
            entry[known] = table.entries[place[known]]
            share = np.where(known, table.shares[place], 0) if len(table.shares) else np.zeros(len(found), np.int64)
            entry[~known] = [hashed_entry(w) for w in found[~known]]
            at = coded.indices.to_numpy()
            real = pc.not_equal(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)[at]  # white space at the ends gives empty words
            upto = np.concatenate([[0], np.cumsum(real)])
            ends = upto[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            at = at[real]
            sums = np.concatenate([[0], np.cumsum(share[at])])
            rare = ~known[at]
            rare_ends = np.concatenate([[0], np.cumsum(rare)])[ends].astype(np.int32)
            ids = pa.BinaryArray.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer((2 * ends).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(entry[at]))])
            arrays = [b.column(0), b.column(1), ids, pa.array(np.diff(sums[ends])), pa.ListArray.from_arrays(pa.array(rare_ends), pa.array(hashes[at[rare]]))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row", "ids", "share", "rare"])

    schema = rows.select("doc_id", "row").schema.add("ids", "binary").add("share", "long").add("rare", ArrayType(LongType()))
    return rows.mapInArrow(run, schema), shares


def deal(ids: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The columns shard and ids of rows (doc_id, ids), each shard in one partition and in order."""
    tokens = ids.agg(F.sum(F.octet_length("ids") / 2)).first()[0] or 0
    shards = max(1, int(-(-tokens // shard_tokens)))
    shard = F.pmod(F.xxhash64("doc_id", "ids"), F.lit(shards)).cast("int")
    return ids.select(shard.alias("shard"), "doc_id", "ids").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "doc_id", "ids").select("shard", "ids")


def shard_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, ids, ends) of some documents of a shard, in the order of rows (shard, ids)."""
    for b in _parts(batches, 1, ID_BYTES):
        shard = b.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(shard)) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)], strict=True):
            yield int(shard[s]), *id_arrays(b.column(1).slice(s, e - s))


def train(dealt: DataFrame, rates: tuple[float, ...] = RATES, seed: int = SEED, batch: int = BATCH) -> Weights:
    """Weights fitted to rows (shard, ids) as ``deal`` returns them, one pass for each rate; each place is a target in one of them.

    All shards start a pass from equal weights.  (weights x places) of the shards are summed in a shuffle, in whole
    numbers of 1 / WEIGHT_UNITS; only the sums come to the driver.
    """
    w = start_weights(seed)
    for n_pass, rate in enumerate(rates):
        given = flat(w)

        def one_pass(batches: Iterator[pa.RecordBatch], given=given, rate=rate, n_pass=n_pass) -> Iterator[pa.RecordBatch]:
            for _, of_shard in groupby(shard_blocks(batches), lambda r: r[0]):
                learn, seen = Adam(shaped(given), rate), 0
                for context, target in learning_batches(((i, e) for _, i, e in of_shard), n_pass, len(rates), batch, seed):
                    learn(context, target)
                    seen += len(target)
                if seen:
                    sums = np.append(np.rint(flat(learn.w).astype(np.float64) * (seen * WEIGHT_UNITS)), float(seen)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], names=["i", "x"])

        sums = dealt.mapInArrow(one_pass, "i int, x long").groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
        if not sums:
            break
        total = np.zeros(len(given) + 1)
        for r in sums:
            total[r[0]] = float(r[1])
        w = shaped(total[:-1] / (total[-1] * WEIGHT_UNITS))
    return w


def score_laid(w: Weights, folded: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Summed conditional log-probabilities of each document (``ends``: where each ends in ``ids``)."""
    sums = np.zeros(len(ends))
    padded, places = laid(ids, ends)
    where = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    for s in range(0, len(ids), BLOCK):
        at, of = places[s : s + BLOCK], where[s : s + BLOCK]
        scores = log_probabilities(w, folded, around(padded, at), padded[at]).astype(np.float64)
        sums[of[0] : of[-1] + 1] += np.bincount(of - of[0], scores)
    return sums


def score_ids(w: Weights, docs: list[np.ndarray]) -> list[float]:
    """Summed conditional log-probabilities of each document."""
    ids = np.concatenate([np.zeros(0, np.int64), *docs])
    return score_laid(w, fold(w), ids, np.cumsum([len(d) for d in docs])).tolist()


def pseudo_likelihood(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rates: tuple[float, ...] = RATES, batch: int = BATCH, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """(doc_id, n_tokens, pll, mean_pll) of every row under a network trained on all rows.

    ``pll`` sums natural logarithms over all tokens, 0 for null and empty texts, whose mean is null.
    The network's weights do not depend on order or layout, and scores only by the rounding of 32-bit products.  An empty table gives an
    empty one; other columns are not read.
    """
    ids, shares = entries(docs, id_col, text_col)
    ids = written(ids, "entries")
    w = train(deal(ids, shard_tokens), rates, batch=batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded = fold(w)
        for b in _parts(batches, 2, ID_BYTES):
            found, ends = id_arrays(b.column(2))
            sizes = np.diff(ends, prepend=0)
            scores = score_laid(w, folded, found, ends)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes), b.column(3), pa.array(scores)], names=["doc_id", "row", "n_tokens", "known", "network"])

    schema = ids.select("doc_id", "row").schema.add("n_tokens", "long").add("known", "long").add("network", "double")
    scored = ids.select("doc_id", "row", "ids", "share").mapInArrow(run, schema)
    rare = ids.select("row", F.explode("rare").alias("h")).join(shares, "h").groupBy("row").agg(F.sum("share").alias("share"))
    pll = F.col("network") + (F.col("known") + F.coalesce(F.col("share"), F.lit(0))) / SHARE_UNITS
    out = scored.join(rare, "row", "left").select("doc_id", "n_tokens", pll.alias("pll"))
    return out.withColumn("mean_pll", F.when(F.col("n_tokens") > 0, F.col("pll") / F.col("n_tokens")))
