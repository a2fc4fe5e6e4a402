"""The entry module without its optional parts, and the mends of operators that no query shows."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from registra.functions import identifiers, text
from registra.operators import hierarchy, relations, search, sections, selection
from registra.plans.catalog import QUERIES
from registra.sources import xml
from tests.conftest import ROOT


@pytest.mark.parametrize("gone", [["registra/llm", "tests/llm"], ["registra/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_loads_without_optional_parts(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for part in gone:
        shutil.rmtree(copy / part) if (copy / part).is_dir() else (copy / part).unlink(missing_ok=True)
    had_llm = "registra/llm" not in gone and os.path.isdir(os.path.join(ROOT, "registra", "llm"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql().keys() - q.keys()), 'pipeline' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(copy)}, check=True).stdout.split()
    assert int(out[0]) == len(QUERIES) + (13 if had_llm else 0) and out[1] == "0" and out[2] == "False"


def test_a_reference_stays_one_row_whatever_the_registry(spark):
    refs = spark.createDataFrame([("/us/usc/t1/s1/a", "f.md")], "href string, file string")
    registry = spark.createDataFrame([("/us/usc/t1/s1", "a.md", 1), ("/us/usc/t1/s1", "z.md", 0), ("/us/usc/t1/s1", "a.md", 1)], "identifier string, file_path string, at int")
    assert [r.target_file for r in relations.resolved_links(refs, "href", registry, "file").collect()] == ["z.md"]
    assert [r.target_file for r in relations.resolved_links(refs, "href", registry, "file", F.col("at")).collect()] == ["a.md"]


def test_chunks_number_all_rows_once(spark):
    df = spark.range(5_000).select((F.col("id") * 7 % 5_000).alias("k"), F.lit("x" * 20).alias("pad"))
    got = hierarchy.chunks(df, ["k"], 64).collect()
    assert sorted((r.k, r.row, r.chunk) for r in got) == [(i, i, i // 64) for i in range(5_000)]


def test_titles_keep_white_space_and_abbreviations(spark):
    given = ["EPA RULES", "THE  \tLAW OF THE\nSEA", "YET U.S. SO", "so it stays", "", "§ 5 — X"]
    df = spark.createDataFrame([(t,) for t in given], "t string")
    assert [r[0] for r in df.select(text.title_case(F.col("t"))).collect()] == ["EPA Rules", "The  \tLaw of The\nSea", "Yet U.S. So", "so it stays", "", "§ 5 — X"]


def test_highlights_of_words_next_to_other_scripts(spark):
    df = spark.createDataFrame([("the thé the, Theé athe the2 the the",)], "t string")
    assert df.select(search.highlighted(F.col("t"), ["the"])).first()[0] == "<mark>the</mark> thé <mark>the</mark>, Theé athe the2 <mark>the</mark> <mark>the</mark>"


def test_search_filters_and_sorts(spark):
    df = spark.createDataFrame([(1, "fr", 5, "EPA", "2026-01-02"), (2, "fr", 5, "EPA", "2026-02-02"), (3, "usc", 5, "x", None)], "id int, source string, title_number int, agency string, publication_date string")
    ids = lambda **k: sorted(r.id for r in search.filtered(df, **k).collect())
    assert ids() == [1, 2, 3] and ids(source="fr", agency='E"P\\A\n') == [1, 2] and ids(title_number=5, date_from="2026-01-03") == [2] and ids(date_to="2026-01-31") == [1]
    for bad in (None, "agency", "-agency", "relevance"):
        assert search.sort_order(bad) is None
    # Ten documents match alike: the newest come first whatever their ids, and those without a date last.
    docs = spark.createDataFrame([(i, "same words", f"2026-01-{10 + i}" if i else None) for i in range(10)], "id int, t string, publication_date string")
    queries = spark.createDataFrame([(0, "same words")], "q int, text string")
    order = lambda s, n=5: [r.id for r in search.ranked(docs, "id", ["t"], queries, "q", "text", n, s).orderBy("rank").collect()]
    assert order("-publication_date") == [9, 8, 7, 6, 5] and order("publication_date") == [1, 2, 3, 4, 5] and order("agency") == order(None) == [0, 1, 2, 3, 4]
    assert order("publication_date", 10)[-1] == 0


def test_credits_can_be_left_out_and_meta_names_titles(spark):
    doc = '<uscDoc xmlns="http://xml.house.gov/schemas/uslm/1.0"><meta><docNumber>5A</docNumber><property role="is-positive-law">yes</property></meta><main><title><num value="5">T</num><section><num value="1">1</num><heading>H</heading><content>C</content><sourceCredit>(Credit.)</sourceCredit></section></title></main></uscDoc>'
    df = spark.createDataFrame([("d", doc)], "k string, x string")
    rows = sections.scan(df, "k", "x", sections.USLM)
    plain = sections.code_documents(rows, credits=False, meta=sections.document_meta(xml.events(df, "k", "x"))).first()
    assert (plain.markdown, plain.source_credit, plain.display_title, plain.legal_status, plain.title_number) == ("C", "(Credit.)", "5 USC § 1 - H", "official_legal_evidence", 5)
    assert sections.code_documents(rows).first().markdown == "C\n\n---\n\n**Source Credit**: (Credit.)"


def test_numbers_padded(spark):
    assert spark.range(1).select(identifiers.pad_two(F.lit("5a"))).first()[0] == "05"


def test_granularities_are_checked():
    assert selection.granularities() == ["section"] and selection.granularities("part") == ["part"] and selection.granularities(several=["title", "part"]) == ["title", "part"]
    for one, several in (("part", ["title"]), (None, []), (None, ["part", "part"]), ("page", None)):
        with pytest.raises(ValueError):
            selection.granularities(one, several)
