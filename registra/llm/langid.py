"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths run over every position, each filter keeps its largest
value in a window, and a softmax over the languages follows.  The network is trained in numpy with Adam
on a bounded sample of labelled rows.  It is applied to whole texts, cut into windows of a fixed length;
a text's probabilities are the mean over its windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.llm.common import free_name

WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 8
SPAN = max(WIDTHS)
#: Bytes of a window; a window also sees the SPAN - 1 bytes after it, so every position of a text is covered.
WINDOW = 256
#: Bounds of the training sample: rows of all languages, windows of a row (spread over the text).
SAMPLE_ROWS, SAMPLE_WINDOWS = 1_600, 6
OVERSAMPLE = 4
EPOCHS, BATCH, RATE, SEED = 4, 128, 4e-3, 5
UNDETERMINED = "und"
#: Windows that are scored at once.
BLOCK = 64


@dataclass(frozen=True)
class Model:
    """embed (256, EMBED); kernel (SPAN, EMBED, filters), zero beyond a filter's width; dense (filters, languages)."""

    langs: tuple[str, ...]
    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray


def windows(data: bytes) -> np.ndarray:
    """All windows of a text as rows of WINDOW + SPAN - 1 bytes, the last filled up with zeros."""
    n = -(-len(data) // WINDOW)
    padded = np.zeros(n * WINDOW + SPAN - 1, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (n, WINDOW + SPAN - 1), (WINDOW, 1))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, langs: tuple[str, ...], epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Fit the network to windows ``x`` and language numbers ``y``."""
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    mask = np.zeros((SPAN, EMBED, n_filters), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width, :, i * FILTERS : (i + 1) * FILTERS] = 1
    p = {
        "embed": rng.normal(0, 0.5, (256, EMBED)),
        "kernel": rng.normal(0, 0.3, mask.shape) * mask,
        "bias": np.zeros(n_filters),
        "dense": rng.normal(0, 0.1, (n_filters, len(langs))),
        "offset": np.zeros(len(langs)),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            xb, yb, k = x[rows], y[rows], len(rows)
            emb = p["embed"][xb]
            conv = sum(emb[:, j : j + WINDOW] @ p["kernel"][j] for j in range(SPAN)) + p["bias"]
            where = conv.argmax(1)  # (k, filters)
            top = np.take_along_axis(conv, where[:, None], 1)[:, 0]
            hidden = np.maximum(top, 0)
            d_out = _softmax(hidden @ p["dense"] + p["offset"])
            d_out[np.arange(k), yb] -= 1
            d_out /= k
            d_top = (d_out @ p["dense"].T) * (top > 0)
            grad = {"dense": hidden.T @ d_out, "offset": d_out.sum(0), "bias": d_top.sum(0)}
            grad["kernel"], grad["embed"] = np.zeros_like(p["kernel"]), np.zeros_like(p["embed"])
            for j in range(SPAN):
                seen = np.take_along_axis(xb, where + j, 1)  # the byte under tap j of each filter's best place
                grad["kernel"][j] = np.einsum("kf,kfe->ef", d_top, p["embed"][seen])
                np.add.at(grad["embed"], seen, d_top[:, :, None] * p["kernel"][j].T[None])
            grad["kernel"] *= mask
            step += 1
            for name, g in grad.items():
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                p[name] -= RATE * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
    return Model(langs, p["embed"], p["kernel"], p["bias"], p["dense"], p["offset"])


class Scorer:
    """Applies a model to windows; the taps of each two neighbouring bytes are summed in tables beforehand."""

    def __init__(self, model: Model):
        taps = [model.embed @ model.kernel[j] for j in range(SPAN)]  # (256, filters)
        self.pairs = [(a[:, None] + b[None]).reshape(65_536, -1) for a, b in zip(taps[::2], taps[1::2], strict=True)]
        self.model = model

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (windows, languages)."""
        out = []
        for at in range(0, len(x), BLOCK):
            b = x[at : at + BLOCK].astype(np.uint16)
            pair = (b[:, :-1] << 8) | b[:, 1:]
            conv = self.pairs[0].take(pair[:, :WINDOW], 0)
            for j in range(1, len(self.pairs)):
                conv += self.pairs[j].take(pair[:, 2 * j : 2 * j + WINDOW], 0)
            hidden = np.maximum(conv.max(1) + self.model.bias, 0)
            out.append(_softmax((hidden @ self.model.dense + self.model.offset).astype(np.float64)))
        return np.concatenate(out)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Rows that training never sees: crc32 of the id as text is a multiple of ``folds``; false for null ids."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``rows`` labelled rows that are not held out, as many of each language as possible.

    The sample takes the ids with the smallest hashes in each language.  Rows with a null id, a null
    language or no letter are not used; of rows that repeat an id and language the smallest text is.
    Without any labelled row the model knows no language.
    """
    text = F.col(f"`{text_col}`").cast("string")
    usable = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), text.alias("text"))
    usable = usable.where("id is not null and lang is not null").where(~held_out(F.col("id")))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()
    if not counts:
        return Model((), *(np.zeros(0, np.float32) for _ in range(5)))
    each = max(1, rows // len(counts))
    # Ids are first thinned out by their hash to about OVERSAMPLE times the sample, before any shuffle.
    highest = {r["lang"]: int((1 << 63) * (2 * min(1.0, OVERSAMPLE * each / r["count"]) - 1)) - 1 for r in counts}
    limits = F.create_map(*[F.lit(x) for pair in highest.items() for x in pair])
    near = usable.select("id", "lang", F.xxhash64("id").alias("h")).where(F.col("h") <= F.try_element_at(limits, F.col("lang")))
    order = Window.partitionBy("lang").orderBy("h", "id")
    chosen = near.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= each)
    chosen = F.broadcast(chosen.select("id", "lang").distinct().limit(rows))  # the bound of the sample
    sample = usable.where(F.col("text").rlike("\\p{L}")).join(chosen, ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text"))
    # Windows spread evenly over each text; only these bytes come to the driver.
    got = sample.select("lang", F.col("id").cast("string"), F.col("text").cast("binary")).mapInArrow(_spread_all, "lang string, id string, seen binary").collect()
    langs = tuple(sorted({r[0] for r in got}))
    if not langs:
        return Model((), *(np.zeros(0, np.float32) for _ in range(5)))
    got.sort(key=lambda r: (r[0], r[1]))
    x = np.concatenate([np.frombuffer(r[2], np.uint8).reshape(-1, WINDOW + SPAN - 1) for r in got])
    y = np.concatenate([np.full(len(r[2]) // (WINDOW + SPAN - 1), langs.index(r[0])) for r in got])
    return train(x, y, langs)


def _spread_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seen = [_spread(t.as_py()) for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(seen, pa.binary())], ["lang", "id", "seen"])


def _spread(data: bytes) -> bytes:
    all_ = windows(data)
    return all_[np.unique(np.linspace(0, len(all_) - 1, SAMPLE_WINDOWS).astype(int))].tobytes()


def classify(
    docs: DataFrame, model: Model, keep: list[str] | None = None, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score"
) -> DataFrame:
    """The columns ``keep`` (all by default) of every row, with the predicted language and its probability.

    Nothing but the text is an input of a prediction.  A null text and a text without a letter are 'und'
    with score 0, as is every text if the model knows no language; ties go to the language first by name.
    Columns of ``keep`` named like the outputs are replaced by them.  Repeated rows get equal results; an
    empty table gives an empty one.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (lang_out, score_out)]
    text = F.col(f"`{text_col}`").cast("string")
    own = text_col if text_col in keep else None
    letter = text.rlike("\\p{L}")
    seen = F.when(letter, text.cast("binary") if own is None else F.lit(True)).alias(free_name(keep, "_seen"))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], seen)
    at = keep.index(own) if own else len(keep)
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add(lang_out, "string").add(score_out, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(model) if model.langs else None
        for b in batches:
            langs, scores = [UNDETERMINED] * b.num_rows, np.zeros(b.num_rows)
            if score is not None:
                sums = np.zeros((b.num_rows, len(model.langs)))
                for rows_, x, weight in _blocks(b.column(at), b.column(len(keep))):
                    np.add.at(sums, rows_, score(x) * weight[:, None])
                total = sums.sum(1)
                for i in np.flatnonzero(total):
                    best = int(sums[i].argmax())
                    langs[i], scores[i] = model.langs[best], min(1.0, sums[i, best] / total[i])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(keep)], pa.array(langs, pa.string()), pa.array(scores)], names=schema.names
            )

    return rows.mapInArrow(run, schema)


def _blocks(texts: pa.Array, seen: pa.Array, size: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, windows, bytes of each window) of all texts, some thousand windows at a time."""
    held, count = [], 0
    for i, (t, s) in enumerate(zip(texts, seen, strict=True)):
        if not s.is_valid:
            continue
        data = memoryview(t.as_buffer())
        for start in range(0, len(data), size * WINDOW):
            part = bytes(data[start : start + size * WINDOW + SPAN - 1])
            n = -(-min(len(data) - start, size * WINDOW) // WINDOW)
            x = windows(part)[:n]
            weight = np.full(n, float(WINDOW))
            weight[-1] = min(len(data) - start, n * WINDOW) - (n - 1) * WINDOW
            held.append((np.full(n, i), x, weight))
            count += n
            if count >= size:
                yield tuple(np.concatenate(z) for z in zip(*held, strict=True))
                held, count = [], 0
    if held:
        yield tuple(np.concatenate(z) for z in zip(*held, strict=True))
