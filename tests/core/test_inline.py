"""Links, footnotes, quotes and labels inside the text of the three sources."""

from __future__ import annotations

from registra.operators import sections
from tests.core.test_xml_and_streams import rows_of

USLM = '<uscDoc xmlns="http://xml.house.gov/schemas/uslm/1.0"><main><title identifier="/us/usc/t9"><num value="9">T</num>{}</title></main></uscDoc>'
SECTION = '<section identifier="/us/usc/t9/s{0}"><num value="{0}">§ {0}.</num><heading>H</heading>{1}</section>'


def bodies(docs):
    return [r.markdown for r in docs.orderBy("doc", "ord").collect()]


def code(*contents):
    return USLM.format("".join(SECTION.format(n + 1, c) for n, c in enumerate(contents)))


def test_quotes_stay_in_their_sentence_or_stand_alone(spark):
    inside = '<content>Strike <quotedContent>the <b>old</b> <p>word</p></quotedContent> and go on.</content>'
    apart = '<chapeau>Read:</chapeau><quotedContent><p>All <b>new</b>.</p></quotedContent><continuation>So.</continuation>'
    level = '<content>Say <quotedContent><section><num>5</num><content>five</content></section></quotedContent>.</content>'
    got = bodies(sections.code_documents(rows_of(spark, sections.USLM, code(inside, apart, level))))
    assert got == ['Strike "the old word" and go on.', "Read:\n\n> All **new**.\n\nSo.", 'Say "5five".']


def test_references_become_links(spark):
    text = (
        '<content>See <ref href="/us/usc/t9/s2">section <b>2</b></ref>, <ref href="/us/usc/t9/s2/a/1">(a)(1)</ref>, <ref href="/us/usc/t7/s4">7 USC 4</ref>, <ref href="/us/pl/1/2">Pub. L.</ref>, '
        '<ref>nowhere</ref><ref class="footnoteRef" idref="fn1">1</ref>.</content>'
    )
    rows = rows_of(spark, sections.USLM, code(text, "<content>B</content>"))
    plain = "See section **2**, (a)(1), 7 USC 4, Pub. L., nowhere[^1]."
    assert bodies(sections.code_documents(rows)) == [plain, "B"]
    units = sections.units(rows, sections.USLM)
    files = units.selectExpr("doc", "ord", "concat('out/t9/c', number, '/s.md') as file_path", "identifier")
    linked = sections.linked(rows, files, files.select("identifier", "file_path"))
    page = "https://uscode.house.gov/view.xhtml?req=granuleid:USC-prelim-title7-section4"
    assert bodies(sections.code_documents(linked)) == [f"See [section **2**](../c2/s.md), [(a)(1)](../c2/s.md), [7 USC 4]({page}), Pub. L., nowhere[^1].", "B"]
    assert bodies(sections.code_documents(sections.linked(rows, files.limit(0), files.limit(0).select("identifier", "file_path")))) == [plain, "B"]


def test_footnotes_of_the_register(spark):
    issue = (
        "<FEDREG><RULE><PREAMB><AGENCY>EPA</AGENCY><SUBAGY>Air Office</SUBAGY><SUBJECT>Own subject</SUBJECT></PREAMB>"
        "<P>First<SU>1</SU> and <I>x</I><SU>2</SU> <FTREF/> more, m<SU>3</SU>.</P><P>None<SU>4</SU></P><FTREF/>"
        '<FTNT><P><SU>2</SU> The note.</P></FTNT><REGTEXT TITLE="40" PART="52"><AMDPAR>1. Amend:</AMDPAR><SECTION><SECTNO>§ 52.1</SECTNO><SUBJECT>Scope.</SUBJECT><P>Body.</P></SECTION></REGTEXT></RULE></FEDREG>'
    )
    doc = sections.register_documents(rows_of(spark, sections.FR, issue)).first()
    assert (doc.subject, doc.agency, doc.sub_agency) == ("Own subject", "EPA", "Air Office")
    assert doc.markdown.split("\n\n") == [
        "EPA", "Air Office", "**Own subject**", "First<sup>1</sup> and *x*[^2] more, m<sup>3</sup>.", "None<sup>4</sup>", "[^2] The note.",
        "**40 CFR Part 52**", "1. Amend:", "§ 52.1", "**Scope.**", "Body.",
    ]


def test_cross_references_and_skipped_parts_of_regulations(spark):
    reg = """<ECFR><DIV1 N="8" TYPE="TITLE"><HEAD>Title 8—Travel</HEAD><DIV5 N="31" TYPE="PART"><HEAD>PART 31—Visits</HEAD><DIV8 N="31.7" TYPE="SECTION"><HEAD>§ 31.7 Delay.</HEAD><AMDDATE>July 1</AMDDATE>
<HD1>General <I>rules</I></HD1><P>see <XREF ID="x">part 5</XREF> end<FTREF ID="f">2</FTREF>.</P><STARS/><PG>12</PG><SECAUTH>(5 USC 1)</SECAUTH></DIV8></DIV5></DIV1></ECFR>"""
    doc = sections.regulation_documents(rows_of(spark, sections.ECFR, reg)).first()
    assert doc.markdown == "**General** *rules*\n\nsee part 5 end[^2].\n\n(5 USC 1)"
