"""Plans that give way to cheaper ones when they are out of time."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from registra.operators import fallback, index, search
from registra.shared import written


def slow(spark, rows=60):
    """A job of a second a row in each of four tasks."""

    def wait(batches):
        for b in batches:
            for _ in range(b.num_rows):
                time.sleep(1)
            yield b

    return spark.range(rows * 4, numPartitions=4).mapInArrow(wait, "id long").count()


def running(spark):
    return list(spark.sparkContext.statusTracker().getActiveJobsIds())


def test_the_next_plan_answers_and_no_job_is_left(spark):
    ran = []

    def twice():
        # The second job begins after the first one was cancelled.
        for _ in range(2):
            try:
                slow(spark)
            except Exception:
                ran.append("cancelled")
        return "late"

    began = time.monotonic()
    name, result = fallback.first_in_time(spark, [("rich", twice), ("plain", lambda: spark.range(10).count()), ("never", lambda: ran.append("never"))], 5)
    assert (name, result) == ("plain", 10) and ran == ["cancelled", "cancelled"]
    assert time.monotonic() - began < 30 and running(spark) == []


def test_errors_are_raised_and_only_time_outs_fall_back(spark):
    with pytest.raises(ZeroDivisionError):
        fallback.first_in_time(spark, [("rich", lambda: 1 // 0), ("plain", lambda: 1)], 20)
    with pytest.raises(fallback.OutOfTime):
        fallback.first_in_time(spark, [("rich", lambda: slow(spark)), ("plain", lambda: slow(spark))], 1)
    assert running(spark) == [] and spark.range(3).count() == 3


def test_a_search_answers_by_the_richest_plan_in_time(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "usc" if i % 2 else "fr", f"word{i % 5} and some text") for i in range(40)], "id long, source string, t string")
    queries = spark.createDataFrame([(0, "word1 text"), (1, "word3")], "q int, text string")
    ix = index.built(docs, "id", ["t"])
    ask = lambda limit: fallback.answered(ix, docs, queries, "q", "text", "t", 0, ["source"], 5, 10, limit)
    want = sorted(tuple(r) for r in index.search(ix, queries, "q", "text", 5).hits.collect())
    name, rich = ask(120)
    assert name == "rich" and sorted(tuple(r) for r in rich.hits.collect()) == want
    assert rich.snippets.where(F.col("snippet").contains("<mark>")).count() == rich.snippets.count() == len(want)
    assert {(r.q, r.value): r.n for r in rich.facets.collect()} == {(0, "usc"): 20, (0, "fr"): 20, (1, "usc"): 20, (1, "fr"): 20}  # word3 is a typo away from the others
    # What the plans share is at hand now, so only the snippets are out of time.
    found, matching = index.search(ix, queries, "q", "text", 5), written(index.matching(ix, queries, "q", "text"), "matching")
    monkeypatch.setattr(index, "search", lambda *_: found._replace(hits=rich.hits))
    monkeypatch.setattr(index, "matching", lambda *_: matching)
    monkeypatch.setattr(search, "snippets", lambda *_: slow(spark))
    name, plain = ask(20)
    assert name == "no_snippets" and plain.snippets is None and sorted(tuple(r) for r in plain.hits.collect()) == want
    assert plain.facets.count() == 4 and running(spark) == []
