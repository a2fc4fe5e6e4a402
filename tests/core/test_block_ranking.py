"""Postings and rankings of a block are the same however its cells are kept, for null texts and ids of any kind."""

from __future__ import annotations

import pyarrow as pa
import pytest

from registra.operators import index


def block(*texts):
    lists = [None if t is None else index_words(t) for t in texts]
    table = pa.table({"doc": pa.array([f"d{i}" for i in range(len(texts))]), "block": pa.array([0] * len(texts), pa.int32()), "a0": pa.array([["x"]] * len(texts)), "a1": pa.array(lists, pa.list_(pa.string()))})
    return index._lists(2)(table).to_pylist()


def index_words(text):
    return text.split(" ")


def test_postings_of_a_block_have_first_places():
    rows = {r["token"]: [(d["doc"], d["at"] >> index.POS_BITS, d["at"] & 0xFF) for d in r["docs"]] for r in block("b a  b", None, "x a", "")}
    assert rows == {"x": [(f"d{i}", 0, 0) for i in range(4)], "b": [("d0", 1, 0)], "a": [("d0", 1, 1), ("d2", 1, 1)]}


@pytest.mark.parametrize("cells", [1, 1 << 22])
def test_a_block_keeps_ties_and_looks_at_frequent_words_where_needed(monkeypatch, cells):
    monkeypatch.setattr(index, "CELLS", cells)
    docs = {"rare": [1, 2, 3], "often": [0, 1, 2, 3, 4], "near": [4]}
    asked = {"rare": ([7], [0], [0], [True], [1]), "often": ([7, 8], [1, 0], [0, 0], [False, True], [1, 1]), "near": ([7, 8], [0, 1], [1, 0], [True, False], [1, 2])}
    at = [[{"doc": d, "at": 10 * d} for d in ids] for ids in docs.values()]
    columns = {"token": list(docs), "docs": at, **{n: [asked[t][i] for t in docs] for i, n in enumerate(("q", "nth", "typos", "rare", "least"))}}
    found = index._ranking(2, False)(pa.table(columns)).to_pylist()
    hits = {(r["query"], r["doc"]): (r["words"], r["typos"], r["exact"]) for r in found if r["doc"] is not None}
    # All of 1, 2 and 3 tie for query 7; document 4 has a typo there; query 8 needs one word of document 4 only.
    assert {k: v for k, v in hits.items() if k[0] == 7} == {(7, 1): (2, 0, 2), (7, 2): (2, 0, 2), (7, 3): (2, 0, 2)}
    assert {r["query"]: r["read"] for r in found if r["doc"] is None}[7] == 3 + 1 + 5
    only = index._ranking(2, True)(pa.table({n: [*c, None if n != "docs" else [{"doc": 4, "at": 0}]] for n, c in columns.items()})).to_pylist()
    assert {r["doc"] for r in only if r["doc"] is not None} == {4}
