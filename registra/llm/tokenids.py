"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

Ids are ranked by how often they occur in the whole corpus, so the 256 most frequent take one byte.  Two
bits in a control byte give the length of each code, four codes to a control byte; control bytes and data
bytes stand in separate sections.  Decoding looks lengths up in a table of 256 rows and gathers bytes with
numpy.

A file holds: MAGIC; the sizes of its four sections as 64-bit integers; the documents' ids, numbers of
tokens and null marks; all control bytes; all data bytes.  Each document begins at a control byte.  Files
are in ascending doc_id order, nulls first.  The table of ranks lies beside the files.
"""

from __future__ import annotations

import json
import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from registra.llm import shards
from registra.llm.common import drop_written, fresh_path, text_parts, written

MAGIC = b"TOKIDS01"
#: Least and most tokens of a shard, and bytes of data at which a file is closed and the next begun.
LEAST_TOKENS, MOST_TOKENS, FILE_BYTES = 6_000_000, 64_000_000, 64 << 20
#: Bytes of text whose distinct words are encoded together, pieces of words (of the last such part) whose ids a worker remembers, and words that
#: the library gets in one call.
TEXT_BYTES, WORDS_HELD, WORDS_AT_ONCE = 4 << 20, 150_000, 16_384
#: Ids between the steps; in the files they are coded by rank.
PACKED = "<u2"
#: The steps of a tokenizer file that allow its words to be encoded apart, as they stand in the file.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Marks that end a run of letters and begin no contraction.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Runs of lower-case Latin letters, none of which normalization changes.
ONE_PRE_TOKEN = rf"\A[{''.join(c for c in map(chr, range(0x250)) if c.isalpha() and c == c.lower() and unicodedata.is_normalized('NFC', c))}]+\z"
#: The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on.
PRINTABLE = np.isin(np.arange(256), [*range(33, 127), *range(161, 173), *range(174, 256)])
ALPHABET = np.where(PRINTABLE, np.arange(256), 255 + np.cumsum(~PRINTABLE)).astype("<u4")
#: Lengths of the four codes of each control byte.
LENGTHS = np.stack([(np.arange(256) >> 2 * j & 3) + 1 for j in range(4)], axis=1).astype(np.int64)


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes of each document, and which of their codes stand for a value."""
    quads = -(-sizes // 4)
    real = np.ones(int(quads.sum()) * 4, bool)
    ends = 4 * np.cumsum(quads)
    for j in (1, 2, 3):
        real[ends[4 * quads - sizes >= j] - j] = False
    return quads, real


def pack(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes, data bytes, and how many of each belong to each document; ``values`` are all documents' in a row."""
    values = values.astype("<u4")
    length = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    quads, real = _places(sizes)
    codes = np.zeros(len(real), np.uint8)
    codes[real] = length - 1
    q = codes.reshape(-1, 4)
    control = (q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6).astype(np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < length[:, None]]
    upto = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return control, data, quads, upto[ends] - upto[ends - sizes]


def unpack(control: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of all documents in a row."""
    size = LENGTHS[control].reshape(-1)[_places(sizes)[1]]
    at = np.cumsum(size) - size
    out = data[at].astype(np.uint32)
    for j in range(1, 4):
        more = np.flatnonzero(size > j)
        if not len(more):
            break
        out[more] |= data[at[more] + j].astype(np.uint32) << np.uint32(8 * j)
    return out


def _pieces(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An array of binaries that lie in a row."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _in_a_row(col: pa.Array, kind: str) -> np.ndarray:
    """The bytes of an array of binaries without nulls, as numbers."""
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind) if len(col) and offsets[-1] > offsets[0] else np.zeros(0, kind)


def _ordinary(path: str) -> bool:
    """Whether the file's tokenizer lower-cases, never merges across white space, and takes runs of letters and of marks apart."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    parts = lambda step: spec.get(step) and spec[step].get("normalizers" if step == "normalizer" else "pretokenizers")
    model = spec["model"]
    return (
        parts("normalizer") == NORMALIZERS
        and parts("pre_tokenizer") == PRE_TOKENIZERS
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        and all(chr(c) + end in model["vocab"] for c in ALPHABET for end in ("", model.get("end_of_word_suffix") or ""))
        and all("<|" in t["content"] for t in spec.get("added_tokens") or ())
        and not any(spec.get(k) for k in ("truncation", "padding"))
    )


class Words:
    """Ids of many texts at once; the library encodes their distinct words in bulk, and numpy puts the ids in their places.

    That needs a tokenizer whose steps are NORMALIZERS and PRE_TOKENIZERS; with another file the library gets
    whole texts, as it does a text that may hold a special token's string.  Lower-casing A-Z first leaves the ids
    as they are.  Words are cut at ASCII white space; other white space stays inside a word.  A run of plain letters, with
    marks on its sides or not, is a pre-token, so only the merges are to be done; all other words take all steps.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.library.model)  # for pre-tokens in byte-level letters
        self.ordinary = _ordinary(path)
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        suffix = getattr(self.library.model, "end_of_word_suffix", None) or ""
        self.letters = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.letters[i] = len(token.removesuffix(suffix))
        self.known: tuple[pa.Array, np.ndarray, np.ndarray] = (pa.array([], pa.string()), np.zeros(0, PACKED), np.zeros(0, np.int32))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many belong to each text."""
        whole = pc.match_substring(texts, "<|") if self.ordinary else pa.array(np.ones(len(texts), bool))
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(whole, "", texts)))
        coded = lists.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        values, sizes = self.encoded(coded.dictionary)
        ids = _gather(values, _starts(sizes), sizes, at)
        upto = np.concatenate([[0], np.cumsum(sizes[at], dtype=np.int64)])
        counts = np.diff(upto[lists.offsets.to_numpy() - lists.offsets[0].as_py()])
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            own = np.array(self.library.encode(texts[i].as_py(), add_special_tokens=False).ids, PACKED)
            ids, counts[i] = np.insert(ids, int(counts[:i].sum()), own), len(own)
        return ids, counts

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All packed ids of some distinct words in a row, and how many belong to each."""
        core = pc.utf8_trim(words, MARKS)
        # The runs of marks on both sides of such a core are pre-tokens of their own; other words stay whole.
        core = pc.if_else(pc.match_substring_regex(core, ONE_PRE_TOKEN), core, words)
        raw, size = _in_a_row(words, np.uint8), pc.binary_length(words).to_numpy()
        left = np.where(pc.binary_length(core).to_numpy() < size, size - pc.binary_length(pc.utf8_ltrim(words, MARKS)).to_numpy(), 0)
        right = size - left - pc.binary_length(core).to_numpy()
        every, end = np.arange(len(words)), np.cumsum(size)
        sides = [_pieces(_gather(raw, at, n, every), n).cast(pa.string()) for at, n in ((end - size, left), (end - right, right))]
        coded = pa.concat_arrays([sides[0], core, sides[1]]).dictionary_encode()
        at = coded.indices.to_numpy().reshape(3, -1).T.ravel()
        values, sizes = self.pieces(coded.dictionary)
        return _gather(values, _starts(sizes), sizes, at), sizes[at].reshape(-1, 3).sum(axis=1, dtype=np.int32)

    def pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encoded``, of the distinct pieces of words; those of the last call are remembered."""
        held, values, sizes = self.known
        at = pc.index_in(pieces, value_set=held)
        new = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        at = at.fill_null(0).to_numpy().copy()
        unknown = pieces.take(pa.array(new))
        plain = pc.match_substring_regex(unknown, ONE_PRE_TOKEN)
        mask = plain.to_numpy(zero_copy_only=False)
        at[new[mask]] = len(held) + np.arange(mask.sum())
        at[new[~mask]] = len(held) + mask.sum() + np.arange((~mask).sum())
        others = self.library.encode_batch_fast(unknown.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)
        others = [np.array(e.ids, PACKED) for e in others]
        ids, n = self.merged(unknown.filter(plain))
        values = np.concatenate([values, ids, *others])
        sizes = np.concatenate([sizes, n, np.fromiter(map(len, others), np.int32, len(others))])
        values, sizes = _gather(values, _starts(sizes), sizes, at), sizes[at]
        kept = min(len(pieces), WORDS_HELD)
        self.known = (pieces.take(pa.array(np.arange(kept))), values[: sizes[:kept].sum()].copy(), sizes[:kept].copy())
        return values, sizes

    def merged(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encoded``, of words that are one pre-token each and that the steps before the merges leave as they are."""
        ids = [np.zeros(0, PACKED)]
        for i in range(0, len(words), WORDS_AT_ONCE):
            text = "\n".join(words.slice(i, WORDS_AT_ONCE).to_numpy(zero_copy_only=False))
            letters = ALPHABET[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le").split(chr(ALPHABET[ord("\n")]))
            ids.append(np.array(self.merges.encode_batch_fast([letters], is_pretokenized=True, add_special_tokens=False)[0].ids, PACKED))
        row = np.concatenate(ids)
        # A token has a letter for each byte of its part of a word, so a word's last token ends where the word does.
        last = np.searchsorted(np.cumsum(self.letters[row]), np.cumsum(pc.binary_length(words).to_numpy(), dtype=np.int64))
        return row, np.diff(last, prepend=-1).astype(np.int32)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes, dtype=np.int32) - sizes


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs ``at`` of ``values`` in a row; run i begins at starts[i] and has sizes[i] values."""
    n = sizes[at]
    place = np.repeat(starts[at] - (np.cumsum(n, dtype=np.int32) - n), n)
    place += np.arange(len(place), dtype=np.int32)
    return values[place]


@lru_cache(maxsize=1)
def words_of(path: str) -> Words:
    """One memory of words for all tasks of a worker."""
    return Words(path)


def tokenise(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, ids) of every row, ids packed with the end id."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = words_of(path)
        for b in (part for whole in batches for part in text_parts(whole, 1, TEXT_BYTES)):
            ids, sizes = ids_of(b.column(1))
            ids = np.insert(ids, np.cumsum(sizes), np.array(end_id, PACKED))
            sizes = sizes + 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), _pieces(ids.view(np.uint8), 2 * sizes)], names=["doc_id", "n", "ids"])

    return rows.mapInArrow(run, "doc_id long, n long, ids binary")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(np.iinfo(PACKED).max + 1, np.int64)
    for b in batches:
        total += np.bincount(_in_a_row(b.column(0), PACKED), minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["id", "count"])


def _store(base: str, name: str, docs: list[tuple], control: list[bytes], data: list[bytes]) -> tuple[str, str, int, int]:
    """Write one file under a temporary name: (temp, name, documents, tokens)."""
    ids = np.array([d[0] or 0 for d in docs], "<i8")
    sizes = np.array([d[1] for d in docs], "<i8")
    nulls = np.array([d[0] is None for d in docs], np.uint8)
    index = ids.tobytes() + sizes.tobytes() + nulls.tobytes()
    store, path = shards.file_system(base)
    temp = f"_temporary/{name}.{uuid.uuid4().hex}"
    store.create_dir(f"{path}/_temporary", recursive=True)
    with store.open_output_stream(f"{path}/{temp}") as out:
        out.write(MAGIC + np.array([len(docs), len(index), sum(map(len, control)), sum(map(len, data))], "<i8").tobytes())
        for part in chain((index,), control, data):
            out.write(part)
    return temp, name, len(docs), int(sizes.sum())


def write_token_ids(
    docs: DataFrame, path: str, end_id: int, base: str, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int | None = None, file_bytes: int = FILE_BYTES
) -> None:
    """Write the ids of all texts, each followed by ``end_id``, as files under ``base`` in ascending id order.

    The vocabulary may have 65,536 entries at most.  Null texts are empty; a text of any length is encoded whole, in the
    task that reads it.  Rows that repeat an id each have an entry, in the order of the CRC-32 and then the number of
    their ids; null ids come first.  An empty table gives a manifest without files.  Other columns are not read.
    """
    spark = docs.sparkSession
    ids = written(tokenise(docs, path, end_id, id_col, text_col), "ids")
    counts = ids.select("ids").mapInArrow(_count, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))
    ranked = np.array([r[0] for r in counts.orderBy(F.desc("count"), "id").select("id").collect()], np.int64)  # a vocabulary at most
    rank = np.zeros(int(ranked.max()) + 1 if len(ranked) else 1, np.uint32)
    rank[ranked] = np.arange(len(ranked))
    shard_tokens = shard_tokens or shards.sized(ids.agg(F.sum("n")).first()[0] or 0, LEAST_TOKENS, MOST_TOKENS)
    cuts = shards.cut_points(ids, "doc_id", "n", shard_tokens)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            control, data, quads, sizes = pack(rank[_in_a_row(b.column(2), PACKED)], b.column(1).to_numpy())
            crc = np.array([zlib.crc32(x.as_buffer()) for x in b.column(2)], np.int64)
            arrays = [pa.array(cuts.shard_of(b.column(0), crc)), b.column(0), pa.array(crc), b.column(1), _pieces(control, quads), _pieces(data, sizes)]
            yield pa.RecordBatch.from_arrays(arrays, names=["shard", "doc_id", "crc", "n", "control", "data"])

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("temp", pa.string()), ("name", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])

        def files() -> Iterator[tuple]:
            held: tuple[list, list, list] = ([], [], [])
            shard, part, size = None, 0, 0
            for b in batches:
                for s, d, n, c, x in zip(*(col for col in b.columns), strict=True):
                    if held[0] and (s.as_py() != shard or size >= file_bytes):
                        yield _store(base, f"{shard:06d}-{part:04d}.ids", *held)
                        held, size = ([], [], []), 0
                        part = part + 1 if s.as_py() == shard else 0
                    shard = s.as_py()
                    held[0].append((d.as_py(), n.as_py()))
                    held[1].append(c.as_py())
                    held[2].append(x.as_py())
                    size += len(held[2][-1]) + len(held[1][-1])
            if held[0]:
                yield _store(base, f"{shard:06d}-{part:04d}.ids", *held)

        return shards.batches_of(files(), schema, 64)

    coded = ids.select("doc_id", "n", "ids").mapInArrow(code, "shard int, doc_id long, crc long, n long, control binary, data binary")
    dealt = coded.repartitionById(cuts.count, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "crc", "n", "data").drop("crc")
    done = dealt.mapInArrow(store, "temp string, name string, documents long, tokens long").collect()  # a row for each file
    files = sorted((r.asDict() for r in done), key=lambda f: f["name"])
    fs_, folder = shards.file_system(base)
    fs_.create_dir(folder, recursive=True)
    with fs_.open_output_stream(f"{folder}/RANKS") as out:
        out.write(ranked.astype("<u4").tobytes())
    shards.commit(spark, base, files)
    drop_written(ids)


def read_token_ids(spark, base: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): each document's ids as little-endian 32-bit integers, and those before it."""
    files, start = shards.manifest(base), 0
    for f in files:
        f["start"] = start
        start += f["tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = shards.file_system(base)
        with store.open_input_stream(f"{folder}/RANKS") as f:
            ranked = np.frombuffer(f.read(), "<u4")
        for b in batches:
            for name, begin in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield from _documents(store, f"{folder}/{name}", ranked, begin)

    return shards.file_rows(spark, files, "name string, start long").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _documents(store, path: str, ranked: np.ndarray, start: int, step: int = 512) -> Iterator[pa.RecordBatch]:
    """The documents of one file, some hundreds at a time."""
    with store.open_input_stream(path) as f:
        raw = f.read()
    if raw[: len(MAGIC)] != MAGIC:
        raise ValueError(f"{path} is no token-id file")
    n, index, controls, _ = np.frombuffer(raw, "<i8", 4, len(MAGIC)).tolist()
    at = len(MAGIC) + 32
    ids, sizes = np.frombuffer(raw, "<i8", n, at), np.frombuffer(raw, "<i8", n, at + 8 * n)
    nulls = np.frombuffer(raw, np.uint8, n, at + 16 * n).astype(bool)
    control, data = np.frombuffer(raw, np.uint8, controls, at + index), np.frombuffer(raw, np.uint8, -1, at + index + controls)
    c = d = 0
    for i in range(0, n, step):
        part = sizes[i : i + step]
        quads = control[c : c + int((-(-part // 4)).sum())]
        length = int(LENGTHS[quads].sum()) - int((-part % 4).sum())  # a code that stands for nothing counts one
        values = ranked[unpack(quads, data[d : d + length], part)].astype("<u4")
        starts = start + np.cumsum(part) - part
        arrays = [pa.array(ids[i : i + step], mask=nulls[i : i + step]), pa.array(starts), pa.array(part), _pieces(values.view(np.uint8), 4 * part)]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids"])
        c, d, start = c + len(quads), d + length, start + int(part.sum())


def round_trip(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row, from files written and read back."""
    base = fresh_path(docs.sparkSession, "tokens")
    write_token_ids(docs, path, end_id, base, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = [zlib.crc32(x.as_buffer()) for x in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_token_ids(docs.sparkSession, base).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
