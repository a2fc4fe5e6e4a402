"""Functions and operators on small inputs with known outcomes."""

from __future__ import annotations

import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from registra.functions import dates, identifiers, text
from registra.operators import hierarchy, keys, listing, markdown, relations, search, store
from registra.sources import files, xml


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(column(F.col("x")).alias("y")).collect()]


def test_strip_markdown(spark):
    md = "# Head\n**bold** and [text](http://x)[^1]\n> quote\n---\n\n\n\nend "
    assert one(spark, text.strip_markdown, md, None) == ["Head\nbold and text\nquote\n\nend", None]


def test_search_body_drops_heading_lines(spark):
    assert one(spark, lambda c: text.search_body(c, 8), "## Gone\nbody text") == ["body tex"]


def test_slug_and_ids(spark):
    assert one(spark, lambda c: text.slug(c, "none"), "Ab -- C!", "!!!", "") == ["ab-c", "none", "none"]
    assert one(spark, text.sanitize_id, "/us/usc/t1§") == ["_us_usc_t1_"]


def test_title_case(spark):
    given = ["RULES OF THE U.S. COURT", "Mixed case stays as is", "(THE END)", "", None]
    assert one(spark, text.title_case, *given) == ["Rules of the U.S. Court", "Mixed case stays as is", "(The End)", "", None]


def test_control_characters_and_markers(spark):
    assert one(spark, text.control_stripped, "a\x1b[31mb\x00c\td") == ["abc\td"]
    assert one(spark, text.untrusted, "x")[0].split("\n")[1] == "x"


def test_front_matter_round_trip(spark):
    df = spark.createDataFrame([('a "b" \\ c', None)], "t string, n string")
    doc = df.select(F.concat(text.front_matter([("title", text.yaml_quoted(F.col("t"))), ("none", F.col("n"))]), F.lit("\nBody\n")).alias("d"))
    row = doc.select(text.front_matter_block(F.col("d")).alias("b"), text.front_matter_body(F.col("d")).alias("body")).first()
    assert row.b == 'title: "a \\"b\\" \\\\ c"' and row.body == "Body\n"


def test_identifiers(spark):
    got = one(spark, identifiers.parse_identifier, "/us/usc/t1/s2/a/1", "/us/cfr/t17", "/us/fr/2026-1", "/us/stat/1", None)
    assert [tuple(r) for r in got] == [("us", "usc", "1", "2", "a/1"), ("us", "cfr", "17", None, None), ("us", "fr", None, "2026-1", None), (None,) * 5, (None,) * 5]
    assert one(spark, identifiers.section_identifier, "/us/usc/t1/s2/a", "/us/usc/t1", "/us/fr/1") == ["/us/usc/t1/s2", None, None]
    assert one(spark, identifiers.fallback_url, "/us/usc/t1/s2/a", "/us/pl/1")[1] is None


def test_numbers(spark):
    assert one(spark, identifiers.roman, "XIV", "MCMXC", "", "Q") == [14, 1990, 0, 0]
    assert one(spark, identifiers.pad_two, "7", "12", "7a", "x") == ["07", "12", "07", "x"]
    assert one(spark, identifiers.leading_int, " 12a", "a") == [12, None]


def test_relative_paths(spark):
    pairs = [("u/a/x.md", "u/a/y.md", "y.md"), ("u/a/x.md", "u/b/y.md", "../b/y.md"), ("x.md", "a/y.md", "a/y.md"), ("u/a/b/x.md", "v/y.md", "../../../v/y.md"), ("u/a/x.md", "u/a", "../a")]
    df = spark.createDataFrame([p[:2] for p in pairs], "a string, b string")
    assert [r[0] for r in df.select(identifiers.relative_path(F.col("a"), F.col("b"))).collect()] == [p[2] for p in pairs]


def test_headings_and_types(spark):
    assert one(spark, identifiers.heading_stripped, "CHAPTER I—ADMIN", "Title 1—Rules--Volume 2", "PART 1—", " Plain ") == ["ADMIN", "Rules", "PART 1—", "Plain"]
    assert one(spark, identifiers.document_type, "Proposed Rule", "Sunshine Act Notice") == ["proposed_rule", "sunshine_act_notice"]
    assert one(spark, identifiers.release_point, "Online@119-73not60", "", "x") == ["119-73", "unknown", "x"]


def test_filed_documents(spark):
    given = ["[FR Doc. 2026-06029 Filed 3-27-26; 8:45 am]", "[FR Doc. E8-17594 Filed 12-31-99; 8:45 am]", "[FR Doc. 00-1 Filed 2-30-26]", "none"]
    got = [tuple(r) for r in one(spark, dates.filed_document, *given)]
    assert got == [("2026-06029", "2026-03-28"), ("E8-17594", "2000-01-01"), ("00-1", None), (None, None)]


def test_dates(spark):
    assert one(spark, dates.date_part, "2025-12-03T10:11:39", "", None) == ["2025-12-03", "unknown", "unknown"]
    assert one(spark, dates.path_date, "a/FR-2026-03-04.xml", "a/2026/03/x.xml", "x.xml") == ["2026-03-04", "2026-03-01", None]


def test_tables(spark):
    df = spark.createDataFrame([([["t"], ["a", "b"]], [["1|\\", "2"], ["3"]]), ([], [["x"]]), ([], [])], "h array<array<string>>, r array<array<string>>")
    got = [r[0] for r in df.select(markdown.table(F.col("h"), F.col("r"))).collect()]
    assert got == ["| a | b |\n| --- | --- |\n| 1\\|\\\\ | 2 |\n| 3 |  |", "|  |\n| --- |\n| x |", ""]


SPEC = listing.Listing(("id", "d"), equal=("k",), ranges={"date_from": "d", "date_to": "d"}, flags=("f",), sorts=("d",), key="id")


def test_listing_filters(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "a", True), (2, "2024-02-01", "a", False), (3, None, "b", True)], "id int, d string, k string, f boolean")
    ids = lambda **p: sorted(r.id for r in listing.filtered(df, SPEC, p).collect())
    assert ids() == [1, 2, 3] and ids(k="a", x="ignored", f=None) == [1, 2] and ids(f="false") == [2]
    assert ids(date_from="2024-01-01", date_to="2024-01-31") == [1]
    for bad in ({"date_from": "January"}, {"f": "maybe"}):
        with pytest.raises(ValueError):
            listing.filtered(df, SPEC, bad)
    for bad in ((0, 0), (101, 0), (5, -1)):
        with pytest.raises(ValueError):
            listing.page_bounds(*bad)


def test_keyset_pages_meet_offset_pages(spark):
    df = spark.createDataFrame([(i, f"2024-01-{1 + i // 4:02d}", "a", True) for i in range(20)], "id int, d string, k string, f boolean")
    seen, cursor, tie = [], None, None
    while True:
        page = listing.keyset_page(df, SPEC, {}, "d", 3, cursor, tie).collect()
        seen += [r.id for r in page[:3]]
        if len(page) <= 3:
            break
        cursor, tie = page[2].d, page[2].id
    assert seen == list(range(20))
    assert [r.id for r in listing.keyset_page(df, SPEC, {}, "d", 3, "2024-01-01").collect()] == [4, 5, 6, 7]  # ties are skipped without a tie key
    offset = listing.offset_page(df, SPEC, {}, "-d", 5, 18).collect()
    assert [(r.id, r.total, r.has_more) for r in offset] == [(2, 20, False), (3, 20, False)]


def test_chunks_number_rows_in_order(spark):
    df = spark.range(1000).withColumn("k", F.expr("(id * 7919) % 1000"))
    got = sorted((r.k, r.chunk) for r in hierarchy.chunks(df, ["k"], 64).collect())
    assert got == [(k, k // 64) for k in range(1000)]


def test_changes_and_store(spark, tmp_path):
    path = str(tmp_path / "s")
    now = lambda: sorted(map(tuple, store.read(spark, path).collect()))
    assert store.read(spark, path) is None
    v1 = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "2")], "path string, hash string")
    assert store.ingest(v1, path, "path", "hash") == {"new": 2} and now() == [("a", "1"), ("b", "2")]
    v2 = spark.createDataFrame([("b", "3"), ("c", "1")], "path string, hash string")
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/_bucket=*/*.parquet")}
    assert store.ingest(v2, path, "path", "hash") == {"updated": 1, "new": 1} and now() == [("a", "1"), ("b", "3"), ("c", "1")]
    assert sum(os.path.exists(f) and os.path.getmtime(f) == t for f, t in before.items()) == 1  # the bucket of a is as it was
    assert store.ingest(v2, path, "path", "hash") == {"unchanged": 2}
    assert store.ingest(v2, path, "path", "hash", prune=True) == {"unchanged": 2, "pruned": 1} and now() == [("b", "3"), ("c", "1")]
    assert store.ingest(v2.limit(0), path, "path", "hash") == {} and len(now()) == 2


def test_keys(spark):
    df = keys.derived(spark.createDataFrame([("secret-key-0001",), (None,)], "k string"), "k", b"salt", 10)
    rows = df.collect()
    assert rows[0].key_hash == hashlib.pbkdf2_hmac("sha256", b"secret-key-0001", b"salt", 10).hex() and rows[0].key_prefix == "secret-key-0"
    assert rows[1].key_hash is None


def test_notes(spark):
    notes = [(1, "crossHeading", "editorialNotes"), (2, None, "x"), (3, None, "amendments"), (4, "crossHeading", "statutoryNotes"), (5, None, "x"), (6, None, "codification")]
    df = spark.createDataFrame([("d", *n) for n in notes], "d string, o int, role string, topic string")
    kept = lambda *f: sorted(r.o for r in relations.notes_kept(df, ["d"], [F.col("o")], *f).collect())
    assert kept(True, False, False) == [1, 2, 6] and kept(False, True, False) == [4, 5] and kept(False, False, True) == [1, 3, 4] and kept(False, False, False) == []


def test_search_allows_typos(spark):
    docs = spark.createDataFrame([(1, "The harbor master"), (2, "a harbour master spoke"), (3, "nothing here")], "id int, t string")
    queries = spark.createDataFrame([(0, "harbour master")], "q int, text string")
    got = [(r.id, r.words, r.typos, r["rank"]) for r in search.ranked(docs, "id", ["t"], queries, "q", "text", 5).orderBy("rank").collect()]
    assert got == [(2, 2, 0, 1), (1, 2, 1, 2)]


def test_title_spec():
    assert xml.title_numbers("1-3,8, 2") == [1, 2, 3, 8]
    for bad in ("0", "5-2", "a", "1-99", ""):
        with pytest.raises(ValueError):
            xml.title_numbers(bad)


def test_markdown_and_sidecar_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.md").write_text('---\nidentifier: "/us/usc/t1/s1"\ntitle: "One"\nagencies:\n  - "A"\n---\n\nBody\n')
    (tmp_path / "a/README.md").write_text("no")
    (tmp_path / "a/x.json").write_text('{"document_number": "1", "agencies": [{"name": "EPA"}]}')
    (tmp_path / "a/bad.json").write_text("{broken")
    docs = files.markdown_files(spark, str(tmp_path)).collect()
    assert len(docs) == 1 and docs[0].front_matter["title"] == "One" and docs[0].body.strip() == "Body" and docs[0].content_hash == hashlib.sha256((tmp_path / "a/x.md").read_bytes()).hexdigest()
    side = files.sidecars(spark, str(tmp_path), "document_number string, agencies array<struct<name:string>>").collect()
    assert [(r.document_number, r.agencies[0].name) for r in side] == [("1", "EPA")]
    out = tmp_path / "out"
    df = spark.createDataFrame([("t/a.md", "A"), ("t/b.md", "B")], "path string, text string")
    assert sorted(r.path for r in files.write_changed(df, str(out)).collect()) == ["t/a.md", "t/b.md"]
    (out / "t/b.md").write_text("old")
    assert [r.path for r in files.write_changed(df, str(out)).collect()] == ["t/b.md"] and (out / "t/b.md").read_text() == "B"
