"""Near-duplicate texts of verified pairs, against the exact similarities."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from registra.llm import neartexts
from tests.llm import odd


def changed(rng, words, n):
    """``words`` with ``n`` of them replaced."""
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.randrange(10**6)}"
    return out


def planted(seed=1):
    """Texts with copies at similarities around 0.8, and a crowd of different near copies of one text."""
    rng = random.Random(seed)
    texts = []
    for _ in range(120):
        base = [f"w{rng.randrange(5_000)}" for _ in range(rng.randrange(60, 400))]
        texts += [" ".join(changed(rng, base, n)) for n in (0, max(1, len(base) // 90), len(base) // 45, len(base) // 20)]
    crowd = [f"c{rng.randrange(5_000)}" for _ in range(300)]
    texts += [" ".join(changed(rng, crowd, 2)) for _ in range(160)]
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(1_000, None), (1_001, ""), (1_002, " \n"), (1_003, "two words"), (1_004, "Two  WORDS"), (1_005, "two word")]


@pytest.mark.parametrize("split_above", [None, 40])
def test_links_are_the_similar_pairs(spark, split_above):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in neartexts.near_duplicates(df, split_above=split_above).collect()}
    sets = {i: neartexts.shingles(t) for i, t in rows}
    ids = sorted(sets)
    true = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if neartexts.jaccard(sets[a], sets[b]) >= 0.8]
    alike = set(true)
    exact = odd.components(ids, lambda a, b: (a, b) in alike)
    assert all(exact[a] == exact[got[a]] for a in ids)  # nothing is joined that similar pairs don't join
    assert sum(got[a] == got[b] for a, b in true) >= 0.98 * len(true) and len(true) > 10_000
    assert got[1_000] == got[1_001] == got[1_002] == 1_000 and got[1_003] == got[1_004] == 1_003 and got[1_005] == 1_005


def test_odd_rows_each_return_one(spark):
    docs = odd.documents(spark)
    got = sorted(((r.doc_id, r.component_id) for r in neartexts.near_duplicates(docs).collect()), key=str)
    assert len(got) == docs.count() and {r for r in got if r[0] in (1, 2, 3, 8)} == {(1, 1), (2, 1), (3, 1), (8, 8)}
    assert neartexts.near_duplicates(odd.none_of(spark)).count() == 0
    kept = neartexts.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id in (1, 2, 3, 8, 5, 6, 7)) == [1, 5, 8]


def test_shingles_follow_the_fingerprint():
    assert len(neartexts.shingles("a b c d e f")) == 2 and len(neartexts.shingles("A b")) == 1 and not len(neartexts.shingles(" \n"))
    assert np.array_equal(neartexts.shingles("A  b c d E"), neartexts.shingles("a b c d e"))
    assert neartexts.most_bits(0.8, 8) == 111 and neartexts.jaccard(neartexts.shingles(""), neartexts.shingles(None)) == 1.0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1_000])
def test_stars_in_any_batches(size):
    rng = np.random.default_rng(4)
    key = np.sort(rng.integers(0, 40, 150))
    node, check = np.arange(150), rng.integers(0, 4, 150)
    rows = pa.table({"key": key, "node": node, "check": check}).combine_chunks()
    got = pa.Table.from_batches(list(neartexts._stars(iter(rows.to_batches(max_chunksize=size)), 1))).to_pylist()
    pairs, many = set(), set()
    for k in set(key.tolist()):
        own = np.flatnonzero(key == k)
        pairs |= {(int(own[0]), int(i)) for i in own[1:] if int(check[own[0]] ^ check[i]).bit_count() <= 1}
        many |= {(int(i), int(check[i]), int(k)) for i in own} if len(own) > 2 else set()
    assert sorted((r["u"], r["v"]) for r in got if r["key"] is None) == sorted(pairs)
    assert sorted((r["u"], r["v"], r["key"]) for r in got if r["key"] is not None) == sorted(many)


def test_crowd_below_the_bar_gives_no_row_for_each_pair(spark, monkeypatch):
    """Texts of which nearly all pairs are near but not similar: rows follow their number, and the few links are all found."""
    rng, counts = random.Random(9), {}
    base = [f"c{k}" for k in range(300)]
    texts = [" ".join(changed(rng, base, 5)) for _ in range(600)]
    texts += [" ".join(changed(rng, t.split(), 1)) for t in texts[:20]]
    kept = neartexts.written

    def counted(df, name):
        out = kept(df, name)
        counts[name] = max(counts.get(name, 0), out.count())
        return out

    monkeypatch.setattr(neartexts, "written", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neartexts.near_duplicates(df).collect()}
    sets = [neartexts.shingles(t) for t in texts]
    both = neartexts.common_counts(sets, sets)
    size = np.array([len(s) for s in sets])
    links = both / (size[:, None] + size - both) >= 0.8
    assert got == odd.components(range(len(texts)), lambda a, b: links[a, b])
    assert len(set(got.values())) > 500
    # A text is at 192 anchors or fewer, each with a row of its own and one with the anchor's first text.
    assert counts.pop("met") < 384 * len(texts) and counts.pop("pairs") < 192 * len(texts) and counts.pop("near") < 192 * len(texts)
    assert max(counts.values()) < 2 * len(texts), counts


@pytest.mark.parametrize("columns", [3, 2048])
def test_common_counts(monkeypatch, columns):
    monkeypatch.setattr(neartexts, "COLUMNS", columns)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, n, np.uint64)) for n in (0, 1, 30, 40, 50, 0, 25)]
    got = neartexts.common_counts(sets[:3], sets[3:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[3:]] for a in sets[:3]]
    assert neartexts.common_counts([sets[0]], [sets[5]]).tolist() == [[0]]


@pytest.mark.parametrize("size", [1, 4, 1_000])
def test_similar_rows_of_groups_in_any_batches(size):
    rng = np.random.default_rng(6)
    rows = []
    for group in [(1, 0, 0), (1, 0, 1), (2, 0, 0), (5, 2, 3)]:
        for n in range(9):
            of = np.unique(rng.integers(0, 8, rng.integers(0, 15), np.uint64))
            rows.append((*group, int(n % 2 and group[1] != group[2]), len(rows), len(rows) // 2, of))
    names = ["cluster", "i", "j", "side", "node", "root"]
    table = pa.table({c: [r[k] for r in rows] for k, c in enumerate(names)} | {"set": pa.array([r[6].tobytes() for r in rows], pa.binary())})
    got = pa.Table.from_batches(list(neartexts._alike(iter(table.to_batches(max_chunksize=size)), 0.5))).to_pylist()
    meet = lambda a, b: a[:3] == b[:3] and a[5] != b[5] and (a[1] == a[2] or a[3] != b[3]) and neartexts.jaccard(a[6], b[6]) >= 0.5
    edges = {(r["u"], r["v"]) for r in got}
    nodes = range(len(rows))
    exact = odd.components(nodes, lambda a, b: meet(rows[a], rows[b]))
    assert len(edges) == len(got) > 3 and odd.components(nodes, lambda a, b: (a, b) in edges or (b, a) in edges) == exact
