"""Sorted projection passes, codes of parts, and alignment of two tokenizers, against brute force."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from registra.llm import alignment, partcodes, projections, queries
from registra.llm.alignment import Fragment, Tokens
from tests.llm import odd
from tests.llm.test_vectors_and_archives import odd_vectors

VECTORS = "vec_id long, embedding array<double>, label string, node long, v string, n int, n_links long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, g, 1, "clash", 2, 3) for i, v, g in rows], VECTORS)


# Sorted projection passes


def links_of(rows, threshold=0.9):
    """{place of row: (n_links, component)} by all pairs."""
    size = Counter(len(v) for i, v in rows if good(i, v)).most_common(1)
    keep = [k for k, (i, v) in enumerate(rows) if good(i, v) and len(v) == size[0][0]]
    x = projections.units(np.array([rows[k][1] for k in keep], np.float64))
    near = x @ x.T >= threshold
    label = np.array([rows[k][0] for k in keep])
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    out = {k: (0, rows[k][0]) for k in range(len(rows))}
    return out | {k: (int(n.sum()) - 1, int(c)) for k, n, c in zip(keep, near, label, strict=True)}


def good(i, v):
    return i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)


def test_passes_find_all_links_of_odd_rows(spark):
    df = odd_vectors(spark)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = links_of(rows)
    for kinds in ({}, {"window": 16, "recall": 0.9999}, {"window": 16, "recall": 0.9999, "run_block": 5}):
        got = projections.near_duplicate_vectors(df, **kinds).collect()
        key = lambda r: (str(r[0]), r[1], str(r[2]))
        assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=key) == sorted([(rows[k][0], *w) for k, w in want.items()], key=key)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert projections.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("run_block", [4_096, 100])
def test_passes_count_near_copies_beyond_the_window(spark, run_block):
    rng = np.random.default_rng(3)
    far = rng.standard_normal((1_500, 16))
    near = rng.standard_normal(16) + rng.standard_normal((700, 16)) * 0.05  # a third of all rows, all different
    pairs = np.repeat(rng.standard_normal((150, 16)), 2, axis=0) + rng.standard_normal((300, 16)) * 0.1
    x = np.concatenate([far, near, pairs])[rng.permutation(2_500)]
    df = frame(spark, [(i, v.tolist(), None) for i, v in enumerate(x)])
    got = {r.vec_id: (r.n_links, r.component_id) for r in projections.near_duplicate_vectors(df, window=64, run_block=run_block).collect()}
    want = links_of([(i, v.tolist()) for i, v in enumerate(x)])
    assert all(got[i][0] <= want[i][0] for i in got)  # no pair counts twice, and none below the threshold
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert sum(got[i] == want[i] for i in got) >= 0.97 * len(got)


def test_passes_grow_with_the_table():
    few, more = projections.layout(50_000, 0.9, 512, 0.95), projections.layout(50_000_000, 0.9, 512, 0.95)
    assert projections.layout(513, 0.9, 512, 0.95) == (0, 1) and few[0] < more[0] and few[1] < more[1]


def test_units_of_huge_and_tiny_components():
    x = projections.units(np.array([[1e300, 1e300], [1e-300, 0.0], [-3.0, 4.0]]))
    assert np.allclose((x * x).sum(1), 1) and np.allclose(x[2], [-0.6, 0.8])


# Codes of parts


def compressed(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Codes, errors and codebooks by a plain loop; rows (id, vector, label) that take part, by id."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[int(np.floor(scale * c)) for c in v] for _, v, _ in rows]
    width = len(whole[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[cut[e][p] for e in range(min(entries, len(cut)))] for p in range(parts)]
    apart = lambda a, b: sum((c - d) ** 2 for c, d in zip(a, b, strict=True))
    best = lambda x, book: min((apart(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            met = defaultdict(list)
            for v in cut:
                met[best(v[p], books[p])[1]].append(v[p])
            for e, xs in met.items():
                books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs, strict=True))
    found = [[best(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    of_label = Counter()
    for (_, _, g), e in zip(rows, errors, strict=True):
        of_label[g] += e
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted([(i, "".join(f"{k:02x}" for _, k in f), e, of_label[g]) for (i, _, g), f, e in zip(rows, found, errors, strict=True)], key=str), digest


def test_codes_equal_a_plain_loop(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), (rng.standard_normal(16) * 2).round(2).tolist(), ["a", "b", None][i % 3]) for i in rng.permutation(250)]
    rows += [(7, rows[3][1], "a")] * 40 + [(None, [0.5] * 16, None), (300, [0.0] * 16, "c"), (301, [1e3, -1e3] * 8, "c")]
    bad = [(400, None, "a"), (401, [], "a"), (402, [None] * 16, "a"), (403, [float("nan")] * 16, "b"), (404, [float("-inf")] * 16, "b"), (405, [1.0] * 8, "b"), (406, [1.0] * 9, "b")]
    df = frame(spark, rows + bad)
    coded, books = partcodes.compress(df)
    got = sorted([(r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()], key=str)
    assert (got, books.digest()) == compressed(rows)
    few, books = partcodes.compress(frame(spark, rows[:5]))  # fewer rows than entries
    assert (sorted([(r.vec_id, r.code, r.error, r.label_error) for r in few.collect()], key=str), books.digest()) == compressed(rows[:5])
    assert partcodes.compress(df.limit(0))[0].count() == 0


def test_codes_of_huge_components_stay_whole(spark):
    rows = [(i, [1e300 * (-1) ** i, 5.0] * 4, "x") for i in range(20)]
    got = partcodes.compress(frame(spark, rows))[0].collect()
    assert len(got) == 20 and all(r.error == 0 for r in got)


def test_bounds_prune_evaluations_and_lose_nothing():
    rng = np.random.default_rng(6)
    centres = rng.integers(-20_000, 20_000, (16, 8))
    x = centres[rng.integers(0, 16, 3_000)] + rng.integers(-500, 500, (3_000, 8))
    pivots = partcodes.choose_pivots(centres[None], 4)[0]
    near = np.sqrt(partcodes.distances(x, pivots).astype(float))
    index, best, done = partcodes.nearest(x, near, centres, np.sqrt(partcodes.distances(centres, pivots).astype(float)))
    every = partcodes.distances(x, centres)
    assert (best == every.min(1)).all() and (index == every.argmin(1)).all()
    assert done < 0.2 * every.size  # of 16 entries a part meets three or fewer
    tied = np.zeros((4, 8), np.int64)
    assert partcodes.nearest(tied, np.zeros((4, 1)), np.ones((3, 8), np.int64), np.full((3, 1), np.sqrt(8)))[0].tolist() == [0] * 4


# Alignment

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def aligned(rows):
    """Results of ``align`` by the libraries and plain loops."""
    a_side, b_side = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_side.encode_special_tokens = True
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    piece = lambda i: bytes([int(b_side.id_to_piece(i)[3:-1], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode()
    counts, each = Counter(), []
    for i, text in rows:
        e = a_side.encode(" " + (text or ""), add_special_tokens=False)
        a = [(k, bytes(letter[c] for c in t)) for k, t in zip(e.ids, e.tokens, strict=True)]
        b = [(k, piece(k)) for k in b_side.encode(text or "")]
        if not text or any(b"".join(t for _, t in s) != (" " + text).encode() for s in (a, b)):
            each.append((i, None))
            continue
        spans = []
        for side in (a, b):
            ends = np.cumsum([len(t) for _, t in side]).tolist()
            spans.append([(k, e - len(t), e) for (k, t), e in zip(side, ends, strict=True)])
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        links, at = [], 0
        for k, s, e in spans[0]:
            while spans[1][at][2] <= s:
                at += 1
            links += [(k, m) for m, t, _ in spans[1][at : at + e - s] if t < e]
        lists = [[[] for _ in common] for _ in spans]
        for side, out in zip(spans, lists, strict=True):
            for k, _, e in side:
                out[bisect_left(common, e)].append(str(k))
        text_of = ";".join(",".join(x) + "|" + ",".join(y) for x, y in zip(*lists, strict=True))
        counts.update(links)
        each.append((i, (len(a), len(b), len(common), links, text_of)))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for i, found in each:
        n = found or (0, 0, 0, [], "")
        links = n[3]
        digest = hashlib.sha256(n[4].encode()).hexdigest() if found else ""
        out.append((i, *n[:3], len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(out, key=str), {i: n[4] for i, n in each if n}


ODD_TEXTS = [(91, "x" * 3_000), (92, "日本語のテキスト" * 200 + " " + "été  a  b\t\n" * 300), (93, "a▁b " * 900), (94, "▁"), (95, " " * 700 + "a\x00" + "\n" * 400), (96, "<|endoftext|> <s></s> <0x41>"), (96, "🤖 naïve ﬁ é　x y"), (None, "no id"), (98, "don't we'LL 12345  !?")]


def small_documents(spark):
    return odd.documents(spark).select("doc_id", "text").where("doc_id not in (11, 12) or doc_id is null").unionByName(spark.createDataFrame(ODD_TEXTS, "doc_id long, text string"))


@pytest.mark.parametrize("kinds", [{}, {"deal_above": 200, "piece": 90, "size": 37, "arity": 3, "table_pairs": 40}, {"deal_above": 0, "piece": 1_000, "size": 5, "arity": 2, "table_pairs": 0}])
def test_alignment_equals_plain_loops(spark, kinds):
    docs = small_documents(spark)
    want, texts = aligned([tuple(r) for r in docs.collect()])
    assert sorted([tuple(r) for r in alignment.align(docs, *PATHS, **kinds).collect()], key=str) == want
    assert alignment.align(docs.limit(0), *PATHS, **kinds).count() == 0
    if kinds:
        return
    spelled = defaultdict(list)
    for r in sorted(alignment.groups(docs.where("doc_id in (92, 98)"), *PATHS, deal_above=200).collect(), key=lambda r: r.start):
        spelled[r.doc_id].append(r.groups)
    assert {i: ";".join(g) for i, g in spelled.items()} == {i: texts[i] for i in (92, 98)}


def test_alignment_of_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted([tuple(r) for r in queries.op13_token_alignment(spark, sf_dir).collect()], key=str)
    assert got == aligned(rows)[0]


def test_fragments_compose_in_any_order():
    rng = np.random.default_rng(9)
    ends = lambda n: np.sort(np.append(rng.choice(np.arange(1, 400), n, replace=False), 400))
    for n, m in ((150, 90), (3, 200), (1, 1)):
        a, b = ends(n), ends(m)
        whole = Tokens(np.arange(n + 1), a, np.arange(m + 1), b)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        cuts = [0, *sorted(rng.choice(np.arange(1, 400), 30, replace=False).tolist()), 400]
        items, closed = [], []
        for low, high in zip(cuts, cuts[1:], strict=False):
            f, inside = alignment.fragment(whole.between(low, high))
            items.append(f)
            closed.append(inside)
        while len(items) > 1:
            k = int(rng.integers(0, len(items) - 1))
            f, seam = alignment.compose(items[k], items[k + 1])
            items[k : k + 2] = [f]
            closed.append(seam)
        last: Fragment = items[0]
        assert not last.suffix
        found = [last.prefix, *[t for t in closed if t]]
        seen = sorted(e for t in found for e in np.intersect1d(t.a_ends, t.b_ends).tolist())
        assert seen == common and sum(len(t.a) for t in found) == n + 1 and sum(len(t.b) for t in found) == m + 1
