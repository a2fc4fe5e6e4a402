"""Nearest neighbours, exact top-k, WARC archives, and the pipeline."""

from __future__ import annotations

import gzip
import hashlib
import io
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from registra.llm import forest, neartexts, queries, shards, vectors, voronoi, warc
from registra.llm.common import fresh_path, shared_dir
from tests.llm import odd

SCHEMA = "vec_id long, embedding array<float>, v string, rep long, part int"


def odd_vectors(spark, dim=8, n=300):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(dim)]) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(120)]  # one common vector
    rows += [(2000, None), (2001, []), (2002, [0.0] * dim), (2003, [None] * dim), (2004, [float("nan")] + [1.0] * (dim - 1)), (2005, [float("inf")] * dim), (2006, [1.0, 2.0]), (None, rows[3][1]), (5, rows[5][1])]
    return spark.createDataFrame([(i, v, "clash", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, every, k, scale=None):
    keep = {}
    for i, v in rows:
        if i is None or not v or len(v) != 8 or any(x is None or not np.isfinite(x) for x in v) or (scale is None and not any(v)):
            continue
        keep[i] = [int(np.floor(scale * x)) for x in v] if scale else np.array(v, np.float64)
    out = {}
    for q in (i for i in keep if i % every == 0):
        pairs = [((sum(a * b for a, b in zip(keep[q], x, strict=True)) if scale else float(np.dot(keep[q], x))), i) for i, x in keep.items() if i != q]
        out[q] = sorted(pairs, key=lambda p: (-p[0], p[1]))[:k]
    return out


def test_top_k_is_exact_with_ties_and_odd_rows(spark, monkeypatch):
    df = odd_vectors(spark)
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], 50, 5, 256)
    for rows, asked in ((vectors.PART_ROWS, voronoi.BLOCK_QUERIES), (20, 2)):
        monkeypatch.setattr(vectors, "PART_ROWS", rows)
        monkeypatch.setattr(voronoi, "BLOCK_QUERIES", asked)
        got = defaultdict(list)
        for r in sorted(voronoi.exact_top_k(df, F.col("vec_id") % 50 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
            got[r.query_id].append((r.score, r.vec_id))
        assert got == want
    assert voronoi.exact_top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_prunes_groups_of_clusters(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((5, 8)) * 10
    x = centres[np.arange(4_000) % 5] + rng.standard_normal((4_000, 8)) * 0.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    chosen = F.col("vec_id") % 71 == 0
    got = {r.query_id: r.score for r in voronoi.exact_top_k(df, chosen).where("rank = 1").collect()}
    z = np.floor(256 * x)
    for q in range(0, 4_000, 71):
        s = z @ z[q]
        s[q] = -np.inf
        assert got[q] == s.max()
    all_, wanted, _, form = vectors.prepare(df, "vec_id", "embedding", chosen, 5, nonzero=False, scale=256.0)
    plan = voronoi.plan(all_, wanted, form, 5, group_queries=1)
    assert form.kind == "<i2" and len(plan.query_pivots) > 4
    pairs = (plan.query_count > 0).sum() * (plan.data.count > 0).sum()
    assert 0 < plan.needed.sum() < 0.6 * pairs  # whole groups of data stay at home
    q = z[::71]
    each = voronoi.reach(q, np.zeros(len(q)), np.linalg.norm(q, axis=1), plan.data, 5)
    assert each.sum() < 0.5 * len(q) * (plan.data.count > 0).sum()


def test_top_k_of_huge_components(spark):
    rows = [(0, [3e15, 1.0]), (1, [3e15, 2.0]), (2, [3e15, 3.0]), (3, [-1e300, 0.0]), (4, [1e308, 1e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in voronoi.exact_top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    top = vectors.LARGEST
    assert got == [(1, top), (2, top), (3, -top)]


@pytest.mark.parametrize("limit", [None, 20])
def test_forest(spark, monkeypatch, limit):
    if limit:
        monkeypatch.setattr(vectors, "PART_ROWS", limit)
    df = odd_vectors(spark)
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], 20, 20)
    got = defaultdict(list)
    for r in sorted(forest.nearest(df, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.score, r.vec_id))
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(len(v) for v in want.values())
    assert [i for _, i in got[1000]] == [i for _, i in want[1000]]  # the common vector, ties by id
    assert all(abs(s - dict((i, s) for s, i in brute_scores(df, q))[i]) < 1e-9 for q in list(want)[:3] for s, i in got[q])
    assert forest.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def brute_scores(df, q):
    rows = {r.vec_id: np.array(r.embedding, np.float64) for r in df.collect() if r.embedding and len(r.embedding) == 8 and r.vec_id is not None and None not in r.embedding}
    return [(float(np.dot(rows[q], x)), i) for i, x in rows.items()]


def test_forest_descends_where_crowded_and_keeps_recall(spark):
    rng = np.random.default_rng(2)
    near = np.ones(16) + rng.standard_normal((3000, 16)) * 0.05  # most rows point one way
    x = np.concatenate([near, rng.standard_normal((1000, 16))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in forest.nearest(df, F.col("vec_id") % 100 == 0, candidates=0.5).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, 4000, 100):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits >= 0.5 * 20 * 40


def test_forest_recall_on_the_table(spark):
    import duckdb

    sf = "/root/testdata/sf0.1"
    rows = duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet' ORDER BY 1").fetchall()
    x = np.array([r[1] for r in rows], np.float64)
    got = defaultdict(set)
    for r in queries.op1_prefix_forest(spark, sf).collect():
        got[r.query_id].add(r.vec_id)
    hits = total = 0
    for q in (i for i, r in enumerate(rows) if r[0] % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        best = {rows[i][0] for i in np.argsort(-s)[:20]}
        hits, total = hits + len(best & got[rows[q][0]]), total + 20
    assert total and hits / total >= 0.9


def pages(spark):
    body = "<html>" + "é" * 600 + "</html>"
    rows = [(3, "http://a.example/x?q=1%20", body), (9, "http://b.example/\r\nX: y", body), (5, None, body), (1, "u", None), (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (None, "n", body), (7, "long", "z" * 300_000), (8, "v", body[:-1]), (8, "v", body[:-1])]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, digest int, shard string")


def brute_pages(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            first[b] = max(i, first.get(b, i))
    out = []
    for i, u, h in rows:
        b = (h or "").encode()
        to = first.get(b)
        revisit = to is not None and i != to
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    df = pages(spark)
    rows = [(r.page_id, r.url, r.html) for r in df.collect()]
    assert sorted((tuple(r) for r in warc.round_trip(df).collect()), key=str) == brute_pages(rows)
    assert warc.round_trip(df.limit(0)).count() == 0
    bases = [fresh_path(spark, "test") for _ in range(2)]
    warc.write_warc(df, bases[0], shard_bytes=3000, file_bytes=800)
    warc.write_warc(df.repartition(7), bases[1], shard_bytes=3000, file_bytes=800)
    assert len(shards.manifest(bases[0])) > 4 and shards.manifest(bases[0]) == shards.manifest(bases[1])  # equal digests
    back = warc.read_warc(spark, bases[0]).collect()
    assert sorted((r.url for r in back), key=str) == sorted((r[1] for r in rows), key=str)
    assert {bytes(r.payload).decode() for r in back if r.record_type == "response"} == {h or "" for _, _, h in rows}


def test_warc_records_stand_alone():
    a = warc.page_record(1, "http://x/é", b"body", hashlib.sha1(b"body").digest(), None)
    (h, block), = warc.parse(io.BytesIO(a))
    assert h["warc-type"] == "response" and block.endswith(b"\r\n\r\nbody") and gzip.decompress(a).startswith(b"WARC/1.1\r\n")
    broken = gzip.compress(gzip.decompress(a).replace(b"body\r\n\r\n", b"bodx\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(broken)))


def test_files_of_failed_attempts_stay_invisible(spark):
    base = fresh_path(spark, "test")
    warc.write_warc(pages(spark), base)
    store, path = shards.file_system(base)
    names = {f["name"] for f in shards.manifest(base)}
    found = {f.base_name for f in store.get_file_info(shards.fs.FileSelector(path, recursive=True)) if f.is_file}
    assert found == names | {shards.MANIFEST}


def test_cut_points_are_exact_for_skewed_keys(spark):
    rng = random.Random(0)
    keys = [rng.randrange(1000) for _ in range(2000)] + [2**62, -(2**63), 2**63 - 1, 5, 5, 5]
    df = spark.createDataFrame([(k, 1) for k in keys] + [(None, 3)], "k long, w long")
    cuts = shards.cut_points(df, "k", "w", 100)
    sizes = np.bincount(np.searchsorted(cuts.starts, np.array(keys), side="right"))
    assert sizes.max() <= 100 and sorted(cuts.starts) == list(cuts.starts) and len(cuts.starts) >= 20
    again = shards.cut_points(df.repartition(9), "k", "w", 100)
    assert (cuts.starts == again.starts).all() and (cuts.shards == again.shards).all() and (cuts.shards == 1).all()


def test_hot_and_null_keys_are_dealt_to_several_shards(spark):
    df = spark.createDataFrame([(7, 1)] * 900 + [(None, 1)] * 450 + [(k, 1) for k in range(200)], "k long, w long")
    cuts = shards.cut_points(df, "k", "w", 100)
    assert cuts.shards[0] == 5 and max(cuts.shards[1:]) == 10
    keys = pa.array([None] * 450 + [6] + [7] * 900 + [8])
    hashes = np.random.default_rng(1).integers(0, 1 << 32, len(keys))
    found = cuts.shard_of(keys, hashes)
    assert set(found[:450]) == set(range(5)) and len(set(found[451:-1])) == 10 and found[450] < min(found[451:-1]) and found[-1] > max(found[451:-1])
    assert found.max() < cuts.count
    body = "<html>" + "x" * 1000
    rows = [(None, "u", f"{body}{i % 40}") for i in range(200)] + [(5, "u", body)] * 60 + [(i, None, None) for i in range(40)]
    pages_ = spark.createDataFrame(rows, "page_id long, url string, html string")
    base = fresh_path(spark, "test")
    warc.write_warc(pages_, base, shard_bytes=20_000)
    back = warc.read_warc(spark, base).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.payload_digest) for r in back) == sorted((i is None, i or 0, hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in rows)
    store, path = shards.file_system(base)
    ids = []
    for f in shards.manifest(base):
        with store.open_input_stream(f"{path}/{f['name']}", compression=None) as stream:
            ids += [h["warc-record-id"] for h, _ in warc.parse(stream)]
    assert len(shards.manifest(base)) > 10 and len(ids) == len(set(ids))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = docs.collect() if name == "near_dedup" else None
        out = stage(spark, docs, sf_dir)
        path = fresh_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        if name in ("language_id", "line_dedup"):
            assert docs.count() == n
        if name == "near_dedup":
            sets = {r.doc_id: neartexts.shingles(r.text) for r in given}
            near = lambda a, b: neartexts.jaccard(sets[a], sets[b]) >= 0.8
            assert {r.doc_id for r in docs.collect()} == set(odd.components(set(sets), near).values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count() and {"doc_id", "n_tokens", "ids_sha256"} <= set(last.columns)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows_and_empty_tables(spark, name, stage):
    docs = odd.documents(spark)
    got = stage(spark, docs, "")
    assert got.count() > 0
    if name != "bpe_encoding":
        assert got.columns == docs.columns
    if name == "language_id":
        assert {str(r.text)[:5] for r in docs.collect()} - {str(r.text)[:5] for r in got.collect()} == {"None", "", " \n\t ", "12345"}
    assert stage(spark, odd.none_of(spark), "").count() == 0


def test_shared_folder_follows_the_session(spark):
    assert shared_dir(spark) == (spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
