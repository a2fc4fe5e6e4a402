"""Operators on texts: SimHash, line dedup, mixing, language ID, token ids, BPE, pseudo-likelihood."""

from __future__ import annotations

import hashlib
import random
import struct
import sys
import zlib
from collections import Counter, defaultdict
from functools import reduce
from operator import xor

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from registra.llm import bpe, components, langid, lines, lm, mixing, queries, simhash, tokenids
from registra.llm.common import fresh_path
from tests.llm import odd


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def brute_near_duplicates(rows):
    fps = {t: odd.simhash(t) for _, t in rows}
    root = odd.components(set(fps.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    low = defaultdict(list)
    for i, t in rows:
        low[root[fps[t]]].append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in low.items()}
    return order((i, f"{fps[t]:016x}", least[root[fps[t]]]) for i, t in rows)


def test_simhash_odd_rows(spark):
    docs = odd.documents(spark)
    want = brute_near_duplicates([(r.doc_id, r.text) for r in docs.collect()])
    assert order(simhash.near_duplicates(docs).collect()) == want
    assert simhash.near_duplicates(odd.none_of(spark)).count() == 0


def test_simhash_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert order(queries.op7_simhash_anchors(spark, sf_dir).collect()) == brute_near_duplicates([tuple(r) for r in rows])


@pytest.mark.parametrize("split_above", [10**9, 40, 3])
def test_anchors_lose_no_link(spark, split_above):
    rng = random.Random(7)
    fps = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                x ^= 1 << b
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame([(*f, *f) for f in signed], "node long, l0 long"), split_above=split_above)
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    want = odd.components({s[0] for s in signed}, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
    assert {n: got.get(n, n) for n in want} == want


def anchors_near(x):
    """Brute force: the words of the perfect code on 31 bits within 2 of x."""
    syndrome = lambda w: reduce(xor, (p for p in range(1, 32) if w >> (p - 1) & 1), 0)
    flips = [0, *[1 << i for i in range(31)], *[1 << i | 1 << j for i in range(31) for j in range(i)]]
    return {x ^ f for f in flips if syndrome(x ^ f) == 0}


def meet(a, b):
    """Whether two fingerprints (lists of lanes) have an anchor within 2 of both in some half."""
    halves = lambda f: [h & 0x7FFFFFFF for x in f for h in (x, x >> 32)]
    return any((x ^ y).bit_count() <= 2 or ((x ^ y).bit_count() <= 4 and anchors_near(x) & anchors_near(y)) for x, y in zip(halves(a), halves(b), strict=True))


def apart(a, b):
    return sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("split_above", [10**9, 6])
def test_wide_anchors_link_what_meets(spark, split_above):
    rng = random.Random(9)
    fps = []
    for _ in range(12):
        x = [rng.getrandbits(64), rng.getrandbits(64)]
        for _ in range(8):
            fps.append(list(x))
            for b in rng.sample(range(128), rng.choice([2, 6, 11, 16])):
                x[b // 64] ^= 1 << b % 64
    rows = [(i, *[v - (1 << 64) if v >> 63 else v for v in f]) for i, f in enumerate(fps)]
    edges = simhash.links(spark.createDataFrame(rows, "node long, l0 long, l1 long"), 14, split_above, lanes=2)
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    want = odd.components(set(range(len(fps))), lambda a, b: apart(fps[a], fps[b]) <= 14 and meet(fps[a], fps[b]))
    assert {n: got.get(n, n) for n in want} == want
    sure = odd.components(set(range(len(fps))), lambda a, b: apart(fps[a], fps[b]) <= 11)
    assert all(want[n] == want[r] for n, r in sure.items()) and len(set(want.values())) > 12


def test_large_groups_are_linked_without_all_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    n, compared = 3_000, []
    centre = rng.integers(-(2**62), 2**62, 2)
    flips = np.zeros((n, 2), np.int64)
    for _ in range(5):
        flips[np.arange(n), rng.integers(0, 2, n)] ^= np.int64(1) << rng.integers(0, 62, n)
    rows = np.concatenate([centre ^ flips, rng.integers(-(2**62), 2**62, (50, 2))])
    key = np.concatenate([np.full(n, 7), np.full(25, 7), np.arange(25) + 8])
    batch = pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.zeros(n + 50, bool)), pa.array(np.arange(n + 50)), pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["key", "home", "node", "l0", "l1"])
    count = np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: (compared.append(len(x)), count(x))[1])
    parts = [batch.slice(0, 1_000), batch.slice(1_000)]
    edges = [(u, v) for b in simhash._compare(iter(parts), 20, True) for u, v in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert len(edges) == n - 1 and {v for _, v in edges} == {0} and {u for u, _ in edges} == set(range(1, n))
    alone = batch.slice(0, n)
    compared.clear()
    assert sum(b.num_rows for b in simhash._compare(iter([alone]), 20, True)) == n - 1
    assert sum(compared) < 2 * n * 40  # two lanes, and far fewer than n * n / 2 pairs


def test_one_of_each_keeps_columns_and_clean_rows(spark):
    docs = odd.documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert ids == sorted([i for i in set(found) - {None} if found[i] == i] + [None, None], key=str)


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1100)}}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_lines(rows, ratio, least):
    strip = lambda s: s.strip(" ")
    total, pages = Counter(), Counter()
    for _, t, host in rows:
        total[host or ""] += 1
        for line in {strip(x) for x in (t or "").split("\n")} - {""}:
            pages[host or "", line] += 1
    bad = {k for k, n in pages.items() if n >= least and n > total[k[0]] * ratio}
    return order((i, None if t is None else "\n".join(x for x in t.split("\n") if (host or "", strip(x)) not in bad)) for i, t, host in rows)


def test_line_dedup(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["menu", " menu ", "", f"own {i}", "foot"]) for _ in range(4)), rng.choice(["a", "b", None])) for i in range(40)]
    rows += [(50, None, "a"), (51, "", "b"), (1, rows[1][1], rows[1][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string").withColumn("line", F.lit(1)).withColumn("_lines", F.lit(2))
    got = lines.drop_boilerplate(docs, F.col("host"), ratio=0.3, min_pages=2)
    assert order(got.select("doc_id", "text").collect()) == brute_lines(rows, 0.3, 2)
    assert got.columns == docs.columns
    assert lines.drop_boilerplate(odd.none_of(spark), F.col("source")).count() == 0
    kept = lines.drop_boilerplate(odd.documents(spark), F.col("source"), min_pages=2, ratio=0.5, dropped_col="n").collect()
    assert len(kept) == 16 and all(r.n >= 0 for r in kept)
    clash = lines.drop_boilerplate(docs, F.col("host"), ratio=0.3, min_pages=2, dropped_col="LINE")
    assert clash.columns == ["doc_id", "text", "host", "_lines", "LINE"] and clash.agg(F.sum("LINE")).first()[0] > 5


def test_line_dedup_of_many_hosts_with_few_lines(spark, monkeypatch):
    rows = [(i, "own\nmenu\nnews %d" % i, f"h{i // 2}") for i in range(40_000)] + [(i, "\n".join(f"line {j}" for j in range(300)) + f"\nown {i}", "big") for i in range(50_000, 50_040)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string")
    want = brute_lines(rows, 0.6, 2)
    for size in (lines.BROADCAST_BYTES, 0):  # by a broadcast, and by a shuffle of both sides
        monkeypatch.setattr(lines, "BROADCAST_BYTES", size)
        got = lines.drop_boilerplate(docs, F.col("host"), ratio=0.6, min_pages=2)
        assert ("ResolvedHint (strategy=broadcast)" in got._jdf.queryExecution().analyzed().toString()) == (size > 0)
        assert order(got.select("doc_id", "text").collect()) == want
    sets = next(spark.read.parquet(f.rsplit("/", 1)[0]) for f in got.inputFiles() if "registra-sets-" in f)
    by_host = {r._host: (r.n, r.m) for r in sets.select("_host", F.size("_lines").alias("n"), F.aggregate("_lines", F.lit(0), lambda a, x: a + F.size(x)).alias("m")).collect()}
    assert len(by_host) == 20_001 and by_host["h7"] == (1, 2) and by_host["big"] == (75, 300)  # no empty parts to speak of


def test_line_dedup_by_hosts_of_urls(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = lines.drop_boilerplate(pages, F.parse_url("url", F.lit("HOST")), "html", ratio=0.3, min_pages=2)
    rows = [(r.page_id, r.html, r.host) for r in pages.withColumn("host", F.parse_url("url", F.lit("HOST"))).collect()]
    assert order(got.select("page_id", "html").collect()) == order(brute_lines(rows, 0.3, 2))


def brute_share(children, budget):
    """{name: share} of (name, capacity, weight) children, by filling up step by step."""
    share, open_ = {}, list(children)
    budget = min(budget, sum(c for _, c, _ in children))
    while open_:
        w = sum(x[2] for x in open_)
        full = [x for x in open_ if x[1] * w <= budget * x[2]]
        if not full:
            over = budget - sum(budget * x[2] // w for x in open_)
            for n, (name, _, weight) in enumerate(sorted(open_)):
                share[name] = budget * weight // w + (n < over)
            break
        for x in full:
            share[x[0]] = x[1]
            budget -= x[1]
            open_.remove(x)
    return share


def test_mixing_keeps_columns_with_the_names_of_its_results(spark):
    docs = spark.createDataFrame([(i, "abcd" * 9, "en", "own", "mine") for i in range(20)], "doc_id long, text string, lang string, tokens string, EPOCH string")
    got = mixing.mix(docs, [("lang", F.col("lang"), F.lit(1)), ("kind", F.col("tokens"), F.lit(1))])
    assert got.columns == [*docs.columns, "kind", "epoch_", "tokens_", "leaf_budget"]
    assert {(r.tokens, r.EPOCH, r.kind, r.epoch_, r.tokens_) for r in got.collect()} == {("own", "mine", "own", 0, 9)}
    assert mixing.mix(docs.limit(0), [("lang", F.col("lang"), F.lit(1))]).count() == 0


@pytest.mark.parametrize("share,epochs,edge", [(0.5, 2, 1), (1.7, 2, 64), (0.0, 1, 64), (1.0, 1, 64), (5.0, 3, 2)])
def test_mixing(spark, monkeypatch, share, epochs, edge):
    monkeypatch.setattr(mixing, "EDGE_ROWS", edge)
    rng = random.Random(5)
    rows = [(i, "y" * rng.choice([0, 5, 40, 400]), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c"])) for i in range(120)]
    rows += [(3, rows[3][1], rows[3][2], rows[3][3]), (None, "yyyy", "en", "a"), (200, None, "fr", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("leaf_tokens", F.lit(1)).withColumn("_order", F.lit(0))
    levels = [("lang", F.col("lang"), F.when(F.col("lang") == "en", 3).otherwise(1)), ("source", F.col("source"), F.lit(1))]
    got = mixing.mix(docs, levels, budget_share=share, max_epochs=epochs).collect()
    size = lambda t: -(-len(t or "") // 4)
    leaf = defaultdict(list)
    for r in rows:
        leaf[r[2] or "", r[3]].append(r)
    tokens = {k: sum(size(r[1]) for r in v) for k, v in leaf.items()}
    langs = sorted({k[0] for k in leaf})
    caps = [(g, epochs * sum(n for k, n in tokens.items() if k[0] == g), 3 if g == "en" else 1) for g in langs]
    by_lang = brute_share(caps, int(sum(tokens.values()) * share))
    budget = {}
    for g in langs:
        part = brute_share([(k[1], epochs * n, 1) for k, n in tokens.items() if k[0] == g], by_lang[g])
        budget |= {(g, s): n for s, n in part.items()}
    want = []
    for k, members in leaf.items():
        left, epoch = budget[k], 0
        while epoch <= epochs:
            if (left <= 0 and tokens[k]) or (not tokens[k] and epoch):
                break
            stand = sorted(members, key=lambda r: (hashlib.md5(f"17:{epoch}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), hashlib.md5((r[1] or "").encode()).hexdigest()))
            used = 0
            for r in stand:
                used += size(r[1])
                if used > left:
                    break
                want.append((r[0], k[0], k[1], epoch))
            left -= sum(size(r[1]) for r in members)
            epoch += 1
    assert order((r.doc_id, r.lang or "", r.source, r.epoch) for r in got) == order(want)
    assert mixing.mix(docs.limit(0), levels).count() == 0


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rows = langid.classify(docs.withColumn("held_out", langid.held_out(F.col("doc_id"))), model, ["doc_id", "held_out", "lang"]).collect()
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 100 and sum(r.lang == r.lang_pred for r in unseen) / len(unseen) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    out = langid.classify(odd.documents(spark), model)
    assert out.columns == [c for c in odd.documents(spark).columns if c != "score"] + ["lang_pred", "score"]
    und = {str(r.text)[:5] for r in out.collect() if r.lang_pred == "und"}
    assert und == {"None", "", " \n\t ", "12345"}
    assert langid.classify(odd.none_of(spark), langid.fit(odd.none_of(spark))).count() == 0
    assert {r.lang_pred for r in langid.classify(odd.documents(spark), langid.fit(odd.none_of(spark))).collect()} == {"und"}


def test_held_out_rows_never_reach_the_model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = langid.held_out(F.col("doc_id"))
    changed = docs.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang"))).withColumn("text", F.when(out, F.reverse("text")).otherwise(F.col("text")))
    a, b = langid.fit(docs, rows=60), langid.fit(changed, rows=60)
    assert a.langs == b.langs and all((getattr(a, n) == getattr(b, n)).all() for n in ("embed", "kernel", "bias", "dense", "offset"))


def test_scores_of_whole_texts_equal_a_plain_loop(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs, rows=60)
    texts = ["a", "été " * 3, "The quick brown fox. " * 40, "x" * langid.WINDOW, "y" * (langid.WINDOW + 1), "\u65e5\u672c" * 200]
    got = langid.classify(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()
    for r in got:
        data = np.concatenate([np.frombuffer(r.text.encode(), np.uint8), np.zeros(2 * langid.WINDOW, np.uint8)])
        n, total = len(r.text.encode()), np.zeros(len(model.langs))
        for start in range(0, n, langid.WINDOW):
            window = data[start : start + langid.WINDOW + langid.SPAN - 1]
            conv = np.array([sum(model.embed[window[p + j]] @ model.kernel[j] for j in range(langid.SPAN)) for p in range(langid.WINDOW)]) + model.bias
            z = np.maximum(conv.max(0), 0) @ model.dense + model.offset
            total += np.exp(z - z.max()) / np.exp(z - z.max()).sum() * (min(n, start + langid.WINDOW) - start)
        assert r.lang_pred == model.langs[int(total.argmax())] and abs(r.score - total.max() / n) < 1e-3


def test_network_tables_equal_the_convolution():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (70, langid.WINDOW + langid.SPAN - 1)).astype(np.uint8)
    model = langid.train(x, rng.integers(0, 2, 70), ("a", "b"), epochs=1)
    emb = model.embed[x]
    conv = sum(emb[:, j : j + langid.WINDOW] @ model.kernel[j] for j in range(langid.SPAN)) + model.bias
    want = langid._softmax(np.maximum(conv.max(1), 0) @ model.dense + model.offset)
    assert np.allclose(langid.Scorer(model)(x), want, atol=1e-4)


@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=9), max_size=9))
@settings(max_examples=50, deadline=None)
def test_codes_round_trip(docs):
    sizes = np.array([len(d) for d in docs], np.int64)
    v = np.array([x for d in docs for x in d], np.uint32)
    control, data, quads, lengths = tokenids.pack(v, sizes)
    assert quads.sum() == len(control) and lengths.sum() == len(data)
    assert (tokenids.unpack(control, data, sizes) == v).all()


def test_token_ids(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [(r.doc_id, r.text) for r in odd.documents(spark).collect()] + [(-4, "a\x1cb <|endoftext|> é ́x"), (99, "Σίσυφος 'RE don't it")]
    want, start = {}, 0
    crc = lambda t: zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u2").tobytes())
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, crc(r[1]))):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.setdefault(i, []).append((start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = defaultdict(list)
    for r in sorted(tokenids.round_trip(docs, path, 2).collect(), key=lambda r: r.start):
        got[r.doc_id].append((r.start, r.n_tokens, r.ids_crc32))
    assert got == want
    base = fresh_path(spark, "test")
    tokenids.write_token_ids(docs, path, 2, base, shard_tokens=50, file_bytes=40)
    assert sum(1 for _ in tokenids.shards.manifest(base)) > 3
    again = {(r.start, r.n_tokens, zlib.crc32(r.ids)) for r in tokenids.read_token_ids(spark, base).collect()}
    assert again == {x for v in want.values() for x in v}
    assert tokenids.round_trip(docs.limit(0), path, 2).count() == 0


@pytest.mark.parametrize("chunk,overlap,deal_above", [(64, 16, 1 << 30), (64, 16, 64), (bpe.CHUNK, bpe.OVERLAP, bpe.DEAL_ABOVE)])
def test_bpe(spark, chunk, overlap, deal_above):
    path = queries.bpe_path()
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\n\n", " \n", "'re", "'s", "'", "12", "é", "日本", "!!", "😀", "\t", "\x1c", " ", "́", "x" * 9]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.choice([0, 5, 50, 300])))) for i in range(150)]
    rows += [(i, t) for i, t in ((r.doc_id, r.text) for r in odd.documents(spark).collect()) if len(t or "") < 5000 or chunk > 64]
    rows += [(1000, "y" * 700), (1001, " " * 500), (1002, "z" * 150 + " " + "q" * 90 + "\n" * 80 + "k"), (1003, "ab\n\nc " * 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    library = bpe.library(path)
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        assert library.decode(ids) == (t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = bpe.encode(docs, path, ["doc_id"], chunk=chunk, overlap=overlap, dealt=chunk, dealt_overlap=overlap, deal_above=deal_above).collect()
    assert order([r[:4] for r in got]) == order(want)
    pieces = {r.doc_id: r.n_pieces for r in got}
    assert pieces[1000] == 1 and (chunk > 64 or pieces[1003] > 8)
    assert bpe.encode(docs.limit(0), path, ["doc_id"]).count() == 0


def test_bpe_whole_table(spark, sf_dir):
    library = bpe.library(queries.bpe_path())
    got = {r.doc_id: r for r in queries.op10_byte_bpe(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert sum(r.n_pieces > 1 for r in got.values()) > 10


def test_token_ids_whole_table(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, got = 0, {r.doc_id: r for r in queries.op9_token_ids(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        assert tuple(got[r.doc_id])[1:] == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_words_apart_and_in_whole():
    """Odd texts encode alike with words apart, and a file with other steps gets whole texts."""
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(4)
    parts = ["a", "the", " ", "\n", "'re", "'s", "'", "12", "é", "É", "İ", "日本", "!!", "($%", "<|", "|>", "😀", "\x1c", "\u2003", "́", "ſ", "Σς", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 12, 40]))) for _ in range(1_500)]
    words = tokenids.Words(path)
    want = [e.ids for e in words.library.encode_batch(texts, add_special_tokens=False)]
    for ordinary in (True, False):
        words.ordinary = ordinary
        ids, sizes = words(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    assert tokenids._ordinary(path) and not tokenids._ordinary(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("at_once,held", [(7, 20), (tokenids.WORDS_AT_ONCE, tokenids.WORDS_HELD)])
def test_words_are_pieced_together(monkeypatch, at_once, held):
    """Every letter that is taken as plain, marks on both sides and remembered words give the library's ids, in calls of any size."""
    monkeypatch.setattr(tokenids, "WORDS_AT_ONCE", at_once)
    monkeypatch.setattr(tokenids, "WORDS_HELD", held)
    words = tokenids.Words(public_tokenizers.path("word_bpe_49k.json"))
    texts = [f"{c} a{c} {c}b {c}{c}, ({c}e) {c}." for c in map(chr, range(33, 0x260)) if not c.isspace()]
    texts += ["", " ", "...", "!! ,,", "ab\x00c " + "é" * 700, "'s (don't) --it's-- l'été x'", "($%a%$) a%$a $$a a$$"]
    for part in (texts, texts[::-1], texts[60:70], [], ["", ""], ["the a"]):
        want = [e.ids for e in words.library.encode_batch(part, add_special_tokens=False)]
        ids, sizes = words(pa.array(part, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes))[:-1]] == want


def test_words_take_no_call_each():
    words = tokenids.Words(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(5)
    distinct = {rng.choice(["", "("]) + "".join(rng.choices("abcdefghiéü", k=8)) + rng.choice(["", ",", "!!"]) for _ in range(10_000)}
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        words(pa.array([" ".join(distinct)]))
    finally:
        sys.setprofile(None)
    assert calls < len(distinct) / 10


def test_pseudo_likelihood(spark):
    rng = random.Random(2)
    phrases = ["the cat sat on the mat", "a dog ran in the park", "we like green tea"]
    rows = [(i, " ".join(rng.choice(phrases) for _ in range(60))) for i in range(150)]
    words = rows[0][1].split()
    rng.shuffle(words)
    rows += [(900, " ".join(words)), (901, None), (902, ""), (903, " \n"), (903, " \n"), (None, "the cat"), (904, "the cat sat " * 15_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("pll", F.lit("clash"))
    got = {r.doc_id: r for r in lm.pseudo_likelihood(docs, rates=(5e-3,) * 4, batch=64).collect()}
    assert got[0].mean_pll > got[900].mean_pll + 0.1
    assert got[901].n_tokens == got[902].n_tokens == got[903].n_tokens == 0 and got[901].pll == 0 and got[901].mean_pll is None
    assert got[904].n_tokens == 45_000 and np.isfinite(got[904].pll)
    assert lm.pseudo_likelihood(docs.limit(0)).count() == 0


def test_pseudo_likelihood_is_normalised_and_follows_its_gradient():
    w = {k: v.astype(np.float64) for k, v in lm.start_weights().items()}
    context = lm.contexts(np.array([5, 900, 77, 1]), np.arange(4))
    every = [lm.log_probabilities(w, lm.fold(w), context[:1], np.array([t]))[0] for t in range(lm.VOCABULARY)]
    assert abs(np.exp(every).sum() - 1) < 1e-6
    target = np.array([5, 900, 77, 1])
    loss = lambda: -lm.log_probabilities(w, lm.fold(w), context, target).mean()
    grad = lm.gradients(w, context, target)
    for name, at in (("embed", (900, 3)), ("mix", (1, 2, 5)), ("to_word", (28, 4, 4)), ("to_class", (3, 2)), ("bias", (7,))):
        kept = w[name][at]
        w[name][at] = kept + 1e-5
        high = loss()
        w[name][at] = kept - 1e-5
        assert abs((high - loss()) / 2e-5 - grad[name][at]) < 1e-5
        w[name][at] = kept
    rng = np.random.default_rng(0)
    doc = rng.integers(0, lm.VOCABULARY, 70_000)
    parts = sum(lm.log_probabilities(w, lm.fold(w), lm.contexts(doc, np.arange(a, min(a + 999, len(doc)))), doc[a : a + 999]).sum() for a in range(0, len(doc), 999))
    assert abs(lm.score_ids(w, [doc])[0] - parts) < 1e-3 * abs(parts)
