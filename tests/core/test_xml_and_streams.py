"""XML conversion, rate limits in batch and as streams, and streamed ingest."""

from __future__ import annotations

from functools import partial

import pytest
from pyspark.sql import functions as F

from registra.operators import sections, store
from registra.sources import xml
from registra.streaming import ingest, limits

CODE = """<uscDoc xmlns="http://xml.house.gov/schemas/uslm/1.0" xmlns:x="http://www.w3.org/1999/xhtml"><meta><n>gone</n></meta><main>
<title identifier="/us/usc/t5"><num value="5">Title 5—</num><heading>Offices</heading><chapter identifier="/us/usc/t5/ch1"><num value="1">CHAPTER 1</num><heading>Rules</heading>
<section identifier="/us/usc/t5/s1" status="repealed"><num value="1">§ 1.</num><heading> Words </heading><chapeau>In <b>this</b>  Act—</chapeau>
<subsection><num>(a)</num><heading>First</heading><content>One <i>two</i>.</content><paragraph><num>(1)</num><content>Deep.</content></paragraph><continuation>After.</continuation></subsection>
<x:table><x:tr><x:th>A</x:th><x:th>B</x:th></x:tr><x:tr><x:td>1</x:td><x:td>2|3</x:td></x:tr><x:tr><x:td>4</x:td></x:tr></x:table>
<quotedContent><section identifier="/us/usc/t5/s9"><content>Quoted.</content></section></quotedContent><sourceCredit>(Aug. 2.)</sourceCredit></section>
<section identifier="/us/usc/t5/s2"><num value="2">§ 2.</num><heading>Same</heading><content>B</content></section>
<section identifier="/us/usc/t5/s2"><num value="2">§ 2.</num><heading>Same</heading><content>C</content></section></chapter></title></main></uscDoc>"""


def scan(spark, *texts):
    df = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "k string, x string")
    return xml.events(df, "k", "x")


def rows_of(spark, d, *texts):
    df = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "k string, x string")
    return sections.scan(df, "k", "x", d)


def test_sections_of_a_code(spark):
    docs = sections.code_documents(rows_of(spark, sections.USLM, CODE, None, "<a><unclosed>", "")).orderBy("ord").collect()
    assert [(d.identifier, d.number, d.heading, d.status, d.suffix, d.source_credit) for d in docs] == [
        ("/us/usc/t5/s1", "1", "Words", "repealed", "", "(Aug. 2.)"),
        ("/us/usc/t5/s2", "2", "Same", None, "", None),
        ("/us/usc/t5/s2", "2", "Same", None, "-2", None),
    ]
    assert docs[0].markdown == "In **this** Act—\n\n**(a)** **First** One *two*.\n\n**(1)** Deep.\n\nAfter.\n\n| A | B |\n| --- | --- |\n| 1 | 2\\|3 |\n| 4 |  |\n\n> Quoted.\n\n---\n\n**Source Credit**: (Aug. 2.)"
    assert [(a.level_type, a.number, a.heading) for a in docs[0].ancestors] == [("title", "5", "Offices"), ("chapter", "1", "Rules")]
    assert docs[0].display_title == "5 USC § 1 - Words"


def test_one_scan_feeds_every_granularity(spark):
    rows = rows_of(spark, sections.USLM, CODE)
    one = {g: sections.documents(rows, sections.USLM, g).collect() for g in ("section", "chapter", "title")}
    assert len(one["section"]) == 3 and len(one["title"]) == 1
    assert "**§ 2.** **Same** B" in one["chapter"][0].markdown and one["chapter"][0].markdown in one["title"][0].markdown
    estimate = {r.ord: r.token_estimate for r in sections.plain_tokens(rows).collect()}
    assert len(estimate) == 3 and all(abs(estimate[r.ord] - r.token_estimate) < 30 for r in one["section"])


def test_regulations_and_register(spark):
    reg = """<ECFR><DIV1 N="8" TYPE="TITLE"><HEAD>Title 8—Travel</HEAD><DIV5 N="31" TYPE="PART"><HEAD>PART 31—Visits</HEAD><DIV8 N="31.7a" TYPE="SECTION"><HEAD>§ 31.7a Delay.</HEAD><P>It <I>is</I>.</P><CITA>[13 FR 1]</CITA></DIV8></DIV5></DIV1></ECFR>"""
    doc = sections.regulation_documents(rows_of(spark, sections.ECFR, reg)).first()
    assert (doc.identifier, doc.heading, doc.markdown) == ("/us/cfr/t8/s31.7a", "Delay.", "It *is*.\n\n[13 FR 1]")
    issue = """<FEDREG><RULE><PREAMB><AGENCY>EPA</AGENCY><SUBJECT>Air</SUBJECT><RIN>RIN 2060-A</RIN></PREAMB><P>Text<SU>1</SU></P><FRDOC>[FR Doc. 2026-1 Filed 5-11-26; 8:45 am]</FRDOC></RULE><NOTICE><SUBJECT>Two</SUBJECT><P>x</P></NOTICE></FEDREG>"""
    rows = sections.register_documents(rows_of(spark, sections.FR, issue)).orderBy("ord").collect()
    assert [(r.identifier, r.document_type, r.agency, r.rin, r.publication_date) for r in rows] == [("/us/fr/2026-1", "rule", "EPA", "2060-A", "2026-05-12"), (None, "notice", None, None, None)]


def test_scan_refuses_entities_and_reports_errors(spark):
    bad = '<!DOCTYPE a [<!ENTITY x "y">]><a>&x;</a>'
    rows = scan(spark, bad, "<a><b></a>", '<a xmlns="urn:u" q="1"><p:b xmlns:p="http://purl.org/dc/terms/" p:k="v">t</p:b></a>').collect()
    assert {r.doc for r in rows if r.kind == "error"} == {"d0", "d1"}
    assert [(r.kind, r.name, r.attrs, r.text) for r in rows if r.doc == "d2"][:3] == [("open", "{urn:u}a", {"q": "1"}, None), ("open", "dcterms:b", {"dcterms:k": "v"}, None), ("text", None, {}, "t")]


@pytest.mark.parametrize("kind", [limits.Fixed, limits.Sliding])
def test_streamed_limits_equal_batch(spark, sf_dir, tmp_path, kind):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    week = 7 * 86_400_000_000
    batch = limits.limited(events, "user_id", "event_id", "ts", partial(kind, 2, week))
    source = tmp_path / "in"
    ordered = events.orderBy("ts")
    ordered.where("event_id < 400").coalesce(1).write.parquet(str(source))
    stream = lambda: limits.limited_stream(spark.readStream.schema(events.schema).parquet(str(source)), "user_id", "event_id", "ts", kind, 2, week)

    def go():
        query = stream().writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert query.awaitTermination(60)

    go()
    ordered.where("event_id >= 400").coalesce(1).write.mode("append").parquet(str(source))
    go()  # state outlives the first run
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("key", "event_id", "allowed", "remaining").collect())) == sorted(map(tuple, batch.collect()))


def test_streamed_ingest_equals_one_batch(spark, tmp_path):
    rows = [(f"p{i % 30}", f"h{i // 30}", i) for i in range(90)]
    df = spark.createDataFrame(rows, "path string, hash string, walk long")
    source = str(tmp_path / "in")
    for low in (0, 45):
        df.where(f"walk >= {low} and walk < {low + 45}").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        ingest.ingest_stream(spark, stream, str(tmp_path / "store"), str(tmp_path / "cp"), "path", "hash", [F.desc("walk")]).awaitTermination()
    got = store.read(spark, str(tmp_path / "store"))
    assert sorted((r.path, r.hash) for r in got.collect()) == sorted((f"p{i}", "h2") for i in range(30))


def test_windowed_counts_stream(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = ingest.request_counts(stream, "ts", "event_type").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    assert query.awaitTermination(60)
    want = events.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, want.collect()))
