"""Plans of falling cost for one answer: the next one runs if a plan has not answered in time."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

from registra.operators import index, search
from registra.shared import written

#: Seconds that a plan may take, and between two looks at a plan that is being stopped.
LIMIT, LOOK = 5.0, 0.1


class OutOfTime(Exception):
    """No plan answered in time."""


class Answer(NamedTuple):
    """``hits``, ``snippets`` and ``facets`` as written tables; what the plan leaves out is None."""

    hits: DataFrame
    snippets: DataFrame | None
    facets: DataFrame | None


def first_in_time[T](spark: SparkSession, plans: Sequence[tuple[str, Callable[[], T]]], limit: float = LIMIT) -> tuple[str, T]:
    """(name, result) of the first plan that answers within ``limit`` seconds.

    A plan is a function that runs its Spark jobs before it returns.  Only a plan out of time gives way to the next one; an
    error of a plan is raised.  The jobs of a plan out of time are cancelled by their tag until it has ended, those that
    it begins meanwhile as well, so none is left running beside the next plan.  If no plan answers, OutOfTime is raised.
    """
    for name, plan in plans:
        tag, done, gave_up = f"registra-{uuid.uuid4().hex}", [], threading.Event()

        def run(plan=plan, tag=tag, done=done) -> None:
            spark.sparkContext.addJobTag(tag)
            try:
                done.append((True, plan()))
            except Exception as error:  # raised again below, in the caller's thread
                done.append((False, error))
            finally:
                spark.sparkContext.removeJobTag(tag)

        thread = InheritableThread(target=run, daemon=True)
        thread.start()
        thread.join(limit)
        while thread.is_alive():
            gave_up.set()
            spark.sparkContext.cancelJobsWithTag(tag)
            thread.join(LOOK)
        good, result = done[0]
        if good and not gave_up.is_set():
            return name, result
        if not good and not gave_up.is_set():
            raise result
    raise OutOfTime(f"no answer in {limit} seconds by {', '.join(name for name, _ in plans)}")


def answered(
    ix: index.Index, docs: DataFrame, queries: DataFrame, query: str, text: str, body: str, attribute: int, facets: Sequence[str], top: int, words: int, limit: float = LIMIT
) -> tuple[str, Answer]:
    """The richest answer in time: hits with snippets and facets, then without snippets, then without both.

    ``docs`` has the id of ``ix``, ``body`` (the attribute of that place in the index) and the facets' fields; see ``search``.
    """
    spark = docs.sparkSession

    def plan(with_snippets: bool, with_facets: bool) -> Answer:
        found = index.search(ix, queries, query, text, top)
        hits = written(found.hits, "hits")
        cropped = written(search.snippets(found, docs, ix.doc, body, query, attribute, words), "snippets") if with_snippets else None
        if not with_facets:
            return Answer(hits, cropped, None)
        all_hits = index.matching(ix, queries, query, text).join(docs.select(ix.doc, *facets), ix.doc)
        return Answer(hits, cropped, written(search.facets(all_hits, facets, query), "facets"))

    plans = [("rich", (True, True)), ("no_snippets", (False, True)), ("no_facets", (False, False))]
    return first_in_time(spark, [(name, lambda parts=parts: plan(*parts)) for name, parts in plans], limit)
