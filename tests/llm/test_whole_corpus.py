"""The operators take in all words, places and pairs of a corpus."""

from __future__ import annotations

import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from registra.llm import forest, lm, vectors


@pytest.mark.parametrize("passes", [1, 2, 5])
def test_every_place_is_a_target_once(passes):
    for size in (0, 1, 7, 5_000):
        doc = np.arange(size) % 900
        seen = np.concatenate([lm.targets(doc, n, passes) for n in range(passes)])
        assert sorted(seen) == list(range(size))


@pytest.mark.parametrize("table_words", [0, 4, 100_000])
def test_rare_words_have_probabilities_of_their_own(spark, monkeypatch, table_words):
    # Words with entries of their own are in the first classes of frequency.
    monkeypatch.setattr(lm, "TABLE_WORDS", table_words and table_words + lm.VOCABULARY - lm.HASHED)
    own = lm.VOCABULARY - lm.HASHED
    entry = lambda w: zlib.crc32(w.encode()) % lm.HASHED
    rare, garbage = "rare", next(w for i in range(10_000) if entry(w := f"junk{i}") == entry("rare"))
    common = " ".join(f"w{i}" for i in range(own)) + " "
    texts = [common * 20, "one two rare three", f"one two {garbage} three", "rare " * 9, "one two rare three", " Straße é " + common, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lm.pseudo_likelihood(docs, rates=(5e-3,), batch=64).collect()}
    assert len(got) == len(texts) and got[1].n_tokens == got[2].n_tokens == 4
    assert abs(got[1].pll - got[2].pll - np.log(11 / 1)) < 1e-4  # "rare" occurs 11 times, the other word once
    assert got[1].pll == got[4].pll and abs(got[1].mean_pll - got[1].pll / 4) < 1e-12
    table, shares = lm.table_of(spark.createDataFrame([(w, n) for w, n in Counter(w for t in texts for w in (t or "").lower().split()).items()], "word string, n long"))
    # One word occurs 11 times, three thrice, three less often.
    assert len(table.hashes) == own + {0: 0, 4: 4, 100_000: 7}[table_words]
    own_words = [lm.digest(f"w{i}") for i in range(own)]
    at, known = table.find(np.array(own_words))
    assert known.all() and sorted(table.entries[at]) == list(range(own)) and not table.shares[at].any()
    logs = [s for h, s in zip(table.hashes, table.shares, strict=True) if h not in set(own_words)] + [r.share for r in shares.collect()]
    parts = [np.exp(s / lm.SHARE_UNITS) for s in logs]
    assert len(parts) == 7 and abs(sum(parts) - len({entry(w) for w in ("one", "two", "rare", garbage, "three", "straße", "é")})) < 1e-6


def test_scores_equal_a_plain_loop_in_any_layout(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(1_100)] + ["É", "x\u2003y"]
    texts = [" ".join(rng.choice(words, rng.integers(0, 40))) for _ in range(60)] + [None, "", " \t"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "w1 w2"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kinds = {"rates": (5e-3, 2e-3), "batch": 32, "shard_tokens": 300}
    got = sorted(lm.pseudo_likelihood(docs.repartition(1), **kinds).collect(), key=lambda r: (str(r.doc_id), r.n_tokens, r.pll))
    other = docs.repartition(5, "text").orderBy(F.desc("text"))
    again = sorted(lm.pseudo_likelihood(other, **kinds).collect(), key=lambda r: (str(r.doc_id), r.n_tokens, r.pll))
    assert all(a.doc_id == b.doc_id and a.n_tokens == b.n_tokens and abs(a.pll - b.pll) <= 1e-6 * abs(a.pll) for a, b in zip(got, again, strict=True))

    ids, _ = lm.entries(docs, "doc_id", "text")
    w = lm.train(lm.deal(ids, 300), kinds["rates"], batch=32)
    same = lm.train(lm.deal(lm.entries(other, "doc_id", "text")[0], 300), kinds["rates"], batch=32)
    assert all((w[k] == same[k]).all() for k in w)
    count = Counter(x for _, t in rows for x in (t or "").lower().split())
    own = sorted(count, key=lambda x: (-count[x], x))[: lm.VOCABULARY - lm.HASHED]
    entry = {x: own.index(x) if x in own else lm.hashed_entry(x) for x in count}
    total = Counter()
    for x, n in count.items():
        total[entry[x]] += n
    soft = lambda z: z - np.log(np.exp(z).sum())

    def brute(text):
        seq, sum_ = (text or "").lower().split(), 0.0
        for i, x in enumerate(seq):
            hidden = np.zeros(lm.HIDDEN)
            for j, o in enumerate(lm.PLACES):
                near = entry[seq[i + o]] if 0 <= i + o < len(seq) else lm.PAD
                hidden += w["embed"][near].astype(float) @ w["mix"][j]
            hidden = np.maximum(hidden + w["bias"], 0)
            c, k = divmod(entry[x], lm.CLASS_WORDS)
            sum_ += soft(hidden @ w["to_class"] + w["class_bias"])[c] + soft(hidden @ w["to_word"][c] + w["word_bias"][c])[k]
            sum_ += 0.0 if x in own else np.log(count[x] / total[entry[x]])
        return sum_

    assert len(got) == len(rows)
    for r in got:
        texts_of = [t for i, t in rows if i == r.doc_id]
        assert any(abs(r.pll - brute(t)) < 1e-3 * max(1, abs(r.pll)) and r.n_tokens == len((t or "").split()) for t in texts_of)


def _calls(f):
    """What f returns, and the calls made in it, of Python and of C."""
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        return f(), calls
    finally:
        sys.setprofile(None)


def test_documents_are_learnt_and_scored_many_at_once():
    rng = np.random.default_rng(11)
    docs = [rng.integers(0, lm.VOCABULARY, n) for n in rng.integers(0, 8, 3_000)]
    w = lm.start_weights()
    got, calls = _calls(lambda: lm.score_ids(w, docs))
    assert calls < 3 * len(docs)
    folded = lm.fold(w)
    for i in range(0, len(docs), 100):
        want = lm.log_probabilities(w, folded, lm.contexts(docs[i], np.arange(len(docs[i]))), docs[i]).sum()
        assert abs(got[i] - want) < 1e-3
    blocks = [(np.concatenate(docs[a : a + 500]), np.cumsum([len(d) for d in docs[a : a + 500]])) for a in range(0, len(docs), 500)]
    _, calls = _calls(lambda: list(lm.learning_batches(blocks, 0, 2, 8_192)))
    assert calls < 5 * len(docs)


@pytest.mark.parametrize("in_block", [1, 4, 100])
def test_batches_do_not_depend_on_blocks(in_block):
    rng = np.random.default_rng(12)
    docs = [rng.integers(0, lm.VOCABULARY, n) for n in [0, 1, 300, *rng.integers(0, 40, 30), 0, 65, 0]]
    want, held, size = [], [], 0
    for doc in docs:
        at = lm.targets(doc, 1, 3)
        for s in range(0, len(at), 32):
            held.append((lm.contexts(doc, at[s : s + 32]), doc[at[s : s + 32]]))
            size += len(held[-1][1])
            if size >= 32:
                want.append(held)
                held, size = [], 0
    want += [held] if held else []
    blocks = [(np.concatenate(docs[a : a + in_block]), np.cumsum([len(d) for d in docs[a : a + in_block]])) for a in range(0, len(docs), in_block)]
    got = list(lm.learning_batches(blocks, 1, 3, 32))
    assert len(got) == len(want)
    for (context, target), of in zip(got, want, strict=True):
        assert (context == np.concatenate([c for c, _ in of])).all() and (target == np.concatenate([t for _, t in of])).all()


def test_rows_of_repeated_words_are_summed():
    rng = np.random.default_rng(13)
    words = np.concatenate([np.full(100, lm.PAD), np.full(lm.RUN, 7), np.full(lm.RUN + 1, 8), [0], rng.integers(0, 50, 300)]).astype(np.int32)
    rows = np.vstack([rng.integers(-9, 9, (len(words), lm.HIDDEN)), np.zeros((1, lm.HIDDEN))])
    found, sums = lm._summed(words, rows)
    want = np.zeros((lm.VOCABULARY + 1, lm.HIDDEN))
    np.add.at(want, words, rows[:-1])
    assert found.tolist() == sorted(set(words.tolist())) and (sums == want[found]).all()


@pytest.mark.parametrize("size", [1, 40, 8 << 20])
def test_words_are_counted_as_spark_splits_them(spark, monkeypatch, size):
    monkeypatch.setattr(lm, "TEXT_BYTES", size)
    texts = ["a b\tb\x0bé  É", "", " \n", "x\x1cy z\u2003z a\x85", "\r\na\f", "b" * 50 + " b"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = Counter()
    for b in lm.counted_words([batch.slice(0, 4), batch.slice(4)]):
        for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            got[word] += n
    words = docs.select(F.explode(F.split("text", "[\\x20\\x09-\\x0D]+")).alias("word")).where("word <> ''")
    assert got == {r.word: r["count"] for r in words.groupBy("word").count().collect()}


def test_forest_keeps_recall_on_uneven_lengths(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((8_000, 32))
    x *= (rng.lognormal(0, 0.7, 8_000) / np.linalg.norm(x, axis=1))[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in forest.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].add(r.vec_id)
    recall = []
    for q in range(0, 8_000, 100):
        s = x @ x[q]
        s[q] = -np.inf
        recall.append(len(got[q] & set(np.argsort(-s)[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.95 and min(recall) >= 0.8


def test_prefixes_are_long_where_vectors_are_dense(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PART_ROWS", 300)  # several cells in a tree, and crowded ones in parts
    rng = np.random.default_rng(2)
    x = np.concatenate([np.ones(16) + rng.standard_normal((3_000, 16)) * 0.05, rng.standard_normal((3_000, 16))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    all_, asked, _, form = vectors.prepare(df, "vec_id", "embedding", F.col("vec_id") % 100 == 0, 20, nonzero=True)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 1_000)
    all_ = forest.number(all_)
    stops, met = forest.search(all_, asked, form, 20, trees=6, candidates=1.0)
    strings = forest.Strings(17, 6)
    place = {r.rep: (r.block, r.place) for r in all_.collect()}
    assert len({b for b, _ in place.values()}) == 6
    lifted = forest.lifted(x, 1.0, False)
    levels = defaultdict(set)
    got = defaultdict(list)
    for r in met.collect():
        got[r.q] += [(r.block, p) for p in np.frombuffer(r.places, "<u2").tolist()]
    hashed = [strings(lifted, t) for t in range(6)]
    for r in stops.collect():
        levels[r.q].add(r.level)
        own = hashed[r.tree]
        assert r.a == own[r.q]  # unit vectors: the query's string is its own
        shared = [strings.length - int(z).bit_length() for z in own ^ own[r.q]]
        assert r.lcp == max(shared) == strings.length  # itself
    wanted = 1.0 * 6_000**0.8
    for q, level in levels.items():
        assert len(level) == 1  # the same in all trees
        level = level.pop()
        shift = strings.length - level
        want = {place[i] for own in hashed for i in np.flatnonzero(own >> shift == own[q] >> shift).tolist()}
        assert sorted(got[q]) == sorted(want)
        counts = np.array([[((own >> (strings.length - lv)) == own[q] >> (strings.length - lv)).sum() for lv in range(strings.length + 1)] for own in hashed])
        assert level == forest.stop_level(counts, 6_000, wanted, 21)
        levels[q] = level
    dense, sparse = ([n for q, n in levels.items() if (q < 3_000) == side] for side in (True, False))
    assert min(dense) > max(sparse) > 0
