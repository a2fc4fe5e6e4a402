"""The written index: typo keys, early stop, upkeep by segments, facets and snippets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from registra.operators import index, search
from registra.shared import fresh_path

COLUMNS = ["q", "id", "words", "typos", "proximity", "attribute", "exact", "rank"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_words_meet_all_tokens_within_their_typos(spark):
    rng = random.Random(3)
    base = ["harbour", "regulation", "organisation", "plain", "tests", "abcdefghijkl", "aaaaaaaaaa", "über", "x1y2z3"]
    tokens = set(base)
    for word in base:
        for _ in range(60):
            w = list(word)
            for _ in range(rng.randint(1, 3)):
                k = rng.randrange(len(w) + 1)
                w[k : k + rng.choice([0, 1, 1])] = rng.choice(["", "a", "e", "q"])
            tokens.add("".join(w) or "a")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(tokens))], "id long, t string")
    queries = spark.createDataFrame([(0, " ".join(base))], "q int, text string")
    built = index.built(df, "id", ["t"])
    got = {(r.word, r.token): r.typos for r in index.matches(built, index.query_words(queries, "q", "text")).collect()}
    plain = lambda w: w.isascii() and w.isalnum()
    want = {}
    for w in base:
        most = 0 if not plain(w) or len(w) < 5 else 1 if len(w) < 9 else 2
        for t in tokens:
            d = distance(w, t)
            if w == t or (most and plain(t) and w[0] == t[0] and d <= most):
                want[w, t] = d
    assert got == want


def corpus(n=3_000):
    """Documents of frequent words, of which few also hold rare ones."""
    rng = random.Random(5)
    often = [f"w{i}" for i in range(40)]
    return [(i, " ".join([*rng.choices(often, k=25), *([f"rare{i % 7}", f"odd{i % 5}"] if i % 60 == 0 else [])])) for i in range(n)]


def test_a_search_reads_few_postings_and_finds_the_same(spark, monkeypatch):
    monkeypatch.setattr(index, "BLOCK_DOCS", 8)  # as many blocks as a large table has
    df = spark.createDataFrame(corpus(), "id long, t string")
    queries = spark.createDataFrame([(0, "rare3 odd0 w1 w2"), (1, "w1 w7 nothing"), (2, "rare0 rare1"), (3, "")], "q int, text string")
    built = index.built(df, "id", ["t"])
    every = index.search(built, queries, "q", "text", None)
    some = index.search(built, queries, "q", "text", 5)
    pick = lambda h: sorted(tuple(r) for r in h.hits.where("rank <= 5").select(*COLUMNS).collect())
    assert pick(every) == pick(some) and {r[0] for r in pick(some)} == {0, 1, 2}
    reading = {r.q: (r.read, r["all"]) for r in some.reading.collect()}
    assert reading[0][0] < 0.6 * reading[0][1]  # of the frequent words only the blocks with documents that can rank
    among = df.where("id % 2 = 1")
    assert {r.id % 2 for r in index.search(built, queries, "q", "text", 5, among).hits.collect()} == {1}


def test_batches_leave_the_index_of_the_last_state(spark):
    base = fresh_path(spark, "index")
    first, last = corpus(700), [(i, t if i % 3 else t + " changed") for i, t in corpus(900)][50:]
    digested = lambda rows: spark.createDataFrame(rows, "id long, t string").withColumn("digest", F.md5("t"))
    queries = spark.createDataFrame([(0, "rare3 odd0 w1 changed w2 w3"), (1, "w1 w7")], "q int, text string")
    found = lambda ix: sorted(tuple(r) for r in index.search(ix, queries, "q", "text", 8).hits.select(*COLUMNS).collect())
    assert index.commits(spark, base) is None and index.checkpoints(spark, base) == {}
    assert index.update(digested(first), base, "id", ["t"], "digest", {"a": "1"}) == {"new": 700}
    assert index.update(digested(first), base, "id", ["t"], "digest") == {"unchanged": 700}
    want = found(index.built(spark.createDataFrame(first, "id long, t string"), "id", ["t"]))
    assert found(index.opened(spark, base, "id")) == want
    # A run that is stopped before its commit changes nothing, and the next one takes its place.
    index._segment(digested(last), base, 1, "id", ["t"], None)
    assert found(index.opened(spark, base, "id")) == want and index.checkpoints(spark, base) == {"a": "1"}
    counts = index.update(digested(last), base, "id", ["t"], "digest", {"a": "2", "b": "x"}, prune=True)
    assert counts["new"] == 200 and counts["pruned"] == 50 and counts["updated"] + counts["unchanged"] == 650
    want = found(index.built(spark.createDataFrame(last, "id long, t string"), "id", ["t"]))
    assert found(index.opened(spark, base, "id")) == want and index.checkpoints(spark, base) == {"a": "2", "b": "x"}
    index.merge(spark, base)
    one = index.opened(spark, base, "id")
    assert found(one) == want and one.live is None and index.checkpoints(spark, base) == {"a": "2", "b": "x"}
    assert index.update(digested(last[:100]), base, "id", ["t"], "digest") == {"unchanged": 100}


def test_facets_count_nulls_and_refuse_other_fields(spark):
    assert search.allowed_facets(None) == ["source", "status"] and search.allowed_facets("agency, body,title_number") == ["agency", "title_number"]
    hits = spark.createDataFrame([(0, "usc", None), (0, "fr", "x"), (1, "usc", None)], "q int, source string, status string")
    got = {(r.q, r.facet, r.value): r.n for r in search.facets(hits, ["source", "status"], "q").collect()}
    assert got == {(0, "source", "usc"): 1, (0, "source", "fr"): 1, (0, "status", None): 1, (0, "status", "x"): 1, (1, "source", "usc"): 1, (1, "status", None): 1}
    assert search.facets(hits, []).count() == 0


@pytest.mark.parametrize("words", [4, 50])
def test_snippets_mark_what_matched(spark, words):
    text = "... A quiet town with a big harbor, then the HARBOUR's master"
    df = spark.createDataFrame([(1, "x", text), (2, "harbour", "...nothing else")], "id long, h string, t string")
    queries = spark.createDataFrame([(0, "harbour")], "q int, text string")
    found = index.search(index.built(df, "id", ["h", "t"]), queries, "q", "text", 5)
    got = {r.id: r.snippet for r in search.snippets(found, df, "id", "t", "q", 1, words).collect()}
    # The exact word is the best occurrence; words in front and behind it stay as they are.
    assert got[2] == "...nothing else"
    assert "<mark>HARBOUR</mark>'s" in got[1] and (words < 50 or got[1] == text.replace("harbor", "<mark>harbor</mark>").replace("HARBOUR", "<mark>HARBOUR</mark>"))
