"""Ranges of a document against the whole document."""

from __future__ import annotations

import pytest

from registra.operators import sections, split_scan
from tests.core.test_xml_and_streams import CODE

ODD = """<?xml version="1.0" encoding="UTF-8"?>
<!-- before > the <root> --><!DOCTYPE uscDoc [ <!ELEMENT a ANY> <!ATTLIST a b CDATA #IMPLIED> ]>
<?style a > b?><uscDoc xmlns="http://xml.house.gov/schemas/uslm/1.0"><main><title identifier="/us/usc/t5" note="a > b 'c'"><num value="5">Title 5—</num><heading>Of > and &lt; ü</heading>
<chapter identifier='/us/usc/t5/ch1 "x" > y'><num value="1">CH 1</num><heading/><!-- a > comment <section> - ><p --><note topic="t"><p>n <![CDATA[ raw <b> > ]] > text ]]> end</p></note>
<section identifier="/us/usc/t5/s1"><num value="1">§ 1.</num><content>See <ref href="/us/usc/t5/s2">two <i>x</i></ref> > <?pi > ?>then <quotedContent>old <b>w</b></quotedContent>.</content><table><tr><td>1</td></tr></table></section>
<section identifier="/us/usc/t5/s2"><content>B</content><sourceCredit>(C.)</sourceCredit></section></chapter></title></main></uscDoc>
<!-- after > it -->
"""


def rows_of(df):
    return sorted([tuple(str(v) for v in r[1:]) for r in df.select(*sections.COLUMNS).collect()], key=lambda r: (int(r[0]), r))


@pytest.mark.parametrize("size,cut", [(100, 50), (1 << 20, 1)])
def test_ranges_give_the_rows_of_the_whole(spark, tmp_path, size, cut):
    texts = {"a.xml": CODE, "b.xml": ODD, "empty.xml": ""}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        got = split_scan.scan(spark, str(tmp_path), sections.USLM, size=cut)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    for name, text in texts.items():
        whole = sections.scan(spark.createDataFrame([(name, text)], "k string, x string"), "k", "x", sections.USLM)
        assert rows_of(got.where(f"doc like '%{name}'")) == rows_of(whole), name
    assert rows_of(got) and sections.code_documents(got).count() == 5


def test_a_title_is_read_in_many_ranges(spark, tmp_path):
    (tmp_path / "t.xml").write_text(CODE.replace("</chapter>", CODE[CODE.index("<section") : CODE.index("</chapter>")] * 40 + "</chapter>"), encoding="utf-8")
    parts = split_scan.units(split_scan.chunks(spark, str(tmp_path), size=500)).collect()
    assert len(parts) > 30 and all(p.text.endswith(">") for p in parts) and max(len(p.text) for p in parts) < 1_500


def test_states_behind_records():
    steps = [("N", "text <!-- a", "XC"), ("XC", "b --", "X"), ("X", " more <p", "N"), ("N", '<a b="', '"'), ('"', 'x" c=\'', "'"), ("'", "y'", "N"), ("R", "<?xml?", "R"), ("R", "<!DOCTYPE a [ <!ELEMENT b", "RT"), ("RT", " ]", "R"), ("N", "<![CDATA[ x", "XD"), ("XD", "]]", "X"), ("N", "a ", "X")]
    assert [split_scan.after(s, r) for s, r, _ in steps] == [e for *_, e in steps]


def test_marks_that_look_back_are_read_whole(spark):
    with pytest.raises(ValueError):
        split_scan.scan(spark, "x", sections.FR)
