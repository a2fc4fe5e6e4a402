"""Documents beyond one part of the parser's input, and what a large one must not change."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from registra.functions import text as texts
from registra.operators import sections, split_scan
from registra.sources import xml


@pytest.mark.parametrize("chars", [1, 3, 7, 64])
def test_texts_across_parts_stay_whole(monkeypatch, chars):
    text = '<a>x <i>marked &amp; long</i> é<ref class="footnoteRef">12</ref><![CDATA[ <y> ]]>tail<!-- c --> of it</a>'
    whole = list(xml.parse(text))
    unit = list(split_scan._unit_rows(text, [], 0, sections.USLM))
    monkeypatch.setattr(xml, "CHARS", chars)
    assert list(xml.parse(text)) == whole
    assert list(split_scan._unit_rows(text, [], 0, sections.USLM)) == unit
    assert [e[3] for e in whole if e[0] == "text"] == ["x ", "marked & long", " é", "12", " <y> tail of it"]


def test_titles_are_cut_into_words_once(spark, capsys):
    given = ["", "  ", "THE", " OF THE AIR OF ", "A\nTO  U.S. A", "OF " + "X" * 50_000 + " OF THE", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "id int, t string").select("id", texts.title_case(F.col("t")).alias("t"))
    assert [r.t for r in df.orderBy("id").collect()] == ["", "  ", "The", " Of the Air Of ", "A\nto  U.S. A", "Of " + "X" + "x" * 49_999 + " Of The", None]
    df.explain("simple")
    assert capsys.readouterr().out.count("regexp_extract_all(") <= 1


def test_metadata_is_read_to_its_end(spark):
    docs = [(f"d{i}", f"<u><meta><m>{i}</m></meta><main>{'<p>x</p>' * 50}</main></u>" if i % 2 else "<u><main><p>x</p></main></u>") for i in range(20)]
    df = spark.createDataFrame(docs, "doc string, xml string")
    rows = xml.events(df, "doc", "xml", "meta").collect()
    assert {r.doc for r in rows} == {f"d{i}" for i in range(1, 20, 2)} and len(rows) == 10 * 6
