"""Levels, documents and Markdown from XML, by groupings over one scan.

A scan turns each document into rows for its texts and levels.  While the markup is read, the stack of open elements is at
hand, so each row says what it lies in: the levels above it, the note, table, cell and mark, and the block of text.  Nothing
is nested or recursive, no window runs over a document, and a level of any kind can be emitted from the same rows.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.functions import dates, identifiers
from registra.functions.text import quoted_block
from registra.operators import markdown, relations
from registra.shared import small_or_shuffled, written
from registra.sources import xml as markup

#: From the largest level down; those after the section are numbered inside its text.
BIG = ("title", "appendix", "subtitle", "chapter", "subchapter", "division", "part", "subpart", "section")
SMALL = ("subsection", "paragraph", "subparagraph", "clause", "subclause", "item", "subitem")


#: The mark of what stands for a footnote, whatever element says so.
NOTE_MARK = "footnoteRef"


@dataclass(frozen=True)
class Dialect:
    """Which elements play which part."""

    source: str
    levels: dict[str, str]  # element name, or value of level_attr, to level
    level_attr: str | None = None
    number_attr: str | None = None  # attribute of a level that holds its number
    identifier_attr: str | None = "identifier"
    numbers: Sequence[str] = ("num",)
    headings: Sequence[str] = ("heading",)
    blocks: Sequence[str] = ("content", "chapeau", "continuation", "proviso", "p")
    notes: dict[str, str] = field(default_factory=lambda: {"note": ""})  # element to note type
    credits: Sequence[str] = ("sourceCredit",)
    quoted: Sequence[str] = ("quotedContent",)
    skipped: Sequence[str] = ("toc", "meta")
    marks: dict[str, str] = field(default_factory=lambda: {"b": "bold", "term": "bold", "i": "italic", "sup": "sup", "sub": "sub", NOTE_MARK: "footnoteRef"})
    refs: dict[str, str] = field(default_factory=lambda: {"ref": "href"})  # element to the attribute that says where it leads
    note_ref: tuple[str, str] | None = None  # attribute and value by which a reference is the mark of a footnote
    sup: str | None = None  # element that is the mark of a footnote inside notes, and where ``sup_mark`` follows it
    sup_mark: str | None = None
    labels: dict[str, tuple[str, str]] = field(default_factory=dict)  # element to the attributes with title and part of its bold label
    credit_label: str = ""
    codes: dict[str, str] = field(default_factory=dict)  # attribute T of an inline element to how it is shown, before marks
    fields: Sequence[str] = ()  # elements whose texts are asked for as columns, skipped or not, unless they are inside ``labels``
    title_attr: str | None = None  # attribute whose beginning, up to a colon, is a title's number
    tables: Sequence[str] = ("xhtml:table", "table", "layout")
    rows: Sequence[str] = ("xhtml:tr", "tr", "row", "header", "tocItem")
    cells: Sequence[str] = ("xhtml:td", "td", "xhtml:th", "th", "column")
    header_rows: Sequence[str] = ("header",)
    header_cells: Sequence[str] = ("xhtml:th", "th")


#: Emphasis codes of regulations and of the register.
ECFR_CODES = {"01": "bold", "02": "italic", "03": "bold", "04": "italic", "05": "italic", "51": "sub", "52": "sub", "54": "sub", "7462": "italic"}
FR_CODES = {"01": "bold", "02": "italic", "03": "italic", "04": "italic", "05": "italic", "51": "sub", "52": "sub", "54": "sub", "7462": "italic"}
#: Element names of the three sources.
USLM = Dialect("usc", {n: n for n in (*BIG, *SMALL)} | {"compiledAct": "chapter", "reorganizationPlan": "chapter"}, note_ref=("class", "footnoteRef"), credit_label="---\n\n**Source Credit**: ")
ECFR = Dialect(
    "ecfr",
    {"TITLE": "title", "SUBTITLE": "subtitle", "CHAPTER": "chapter", "SUBCHAP": "subchapter", "PART": "part", "SUBPART": "subpart", "SUBJGRP": "subpart", "SECTION": "section", "APPENDIX": "appendix"},
    level_attr="TYPE",
    number_attr="N",
    numbers=(),
    headings=("HEAD",),
    title_attr="NODE",
    blocks=("P", "FP", "PSPACE", "FP-1", "FP-2", "FP-DASH", "FP1-2", "FRP", "HD1", "HD2", "HD3"),
    notes={"AUTH": "authority", "SOURCE": "source", "EDNOTE": "editorial", "NOTE": "general", "EFFDNOT": "effectiveDate", "CROSSREF": "crossReference", "APPRO": "approval", "SECAUTH": "sectionAuthority", "FTNT": "footnote"},
    credits=("CITA",),
    quoted=("EXTRACT",),
    skipped=("HED", "CFRTOC", "HEADER", "PTHD", "CHAPTI", "SECHD", "SUBJECT", "RESERVED", "PG", "STARS", "AMDDATE", "VOLUME"),
    marks={"I": "italic", "E": "italic", "B": "bold", "SU": "sup", "FTREF": "footnoteRef", "HD1": "bold", "HD2": "bold", "HD3": "bold"},
    refs={"XREF": "ID"},
    codes=ECFR_CODES,
    tables=("TABLE",),
    rows=("TR",),
    cells=("TD", "TH"),
    header_rows=(),
    header_cells=("TH",),
)
FR = Dialect(
    "fr",
    {"RULE": "section", "PRORULE": "section", "NOTICE": "section", "PRESDOCU": "section"},
    identifier_attr=None,
    numbers=(),
    headings=("SUBJECT", "HD"),
    blocks=("P", "FP", "FP-1", "FP-2", "FRP", "AMDPAR", "SECTNO", "NAME", "DATED", "ACT", "AGY", "SUM", "DATES", "ADD", "FURINF", "SUBAGY"),
    notes={"AUTH": "authority", "FTNT": "footnote", "SIG": "signature"},
    credits=(),
    quoted=("EXTRACT",),
    skipped=("PRTPAGE", "GPH", "BILCOD", "TTITLE", "FRDOC", "CNTNTS"),
    marks={"I": "italic", "B": "bold", "E": "italic", "SU": "sup", NOTE_MARK: "footnoteRef"},
    refs={},
    sup="SU",
    sup_mark="FTREF",
    labels={"REGTEXT": ("TITLE", "PART")},
    codes=FR_CODES,
    fields=("AGENCY", "SUBAGY", "SUBJECT", "CFR", "RIN", "FRDOC"),
    tables=("GPOTABLE",),
    rows=("BOXHD", "ROW"),
    cells=("CHED", "ENT"),
    header_rows=("BOXHD",),
    header_cells=("CHED",),
)


_COLUMNS = {
    "doc": pa.string(), "seq": pa.int64(), "kind": pa.string(), "text": pa.string(), "gone": pa.bool_(), "block": pa.int64(), "quoted": pa.bool_(),
    # Of levels: what they are, and by number of the event the open levels of each kind in BIG, themselves included.
    "level": pa.string(), "name": pa.string(), "identifier": pa.string(), "number": pa.string(), "status": pa.string(), "above": pa.list_(pa.int64()),
    # Of texts: the last level that was opened, and what they lie in.
    "last_level": pa.int64(), "note": pa.int64(), "topic": pa.string(), "role": pa.string(), "in_num": pa.bool_(), "num_value": pa.string(), "head": pa.int64(), "credit": pa.bool_(),
    "table": pa.int64(), "row": pa.int64(), "row_name": pa.string(), "cell": pa.int64(), "cell_name": pa.string(), "mark": pa.string(), "code": pa.string(), "field": pa.string(), "field_seq": pa.int64(),
    # Of texts at the ends of a reference, which are empty until it is known where it leads.
    "href": pa.string(), "edge": pa.string(),
}
COLUMNS = list(_COLUMNS)
_ARROW = pa.schema(list(_COLUMNS.items()))
_SQL = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<long>"}
SCAN_SCHEMA = ", ".join(f"`{n}` {_SQL[t]}" for n, t in _COLUMNS.items())


@dataclass
class _Inside:
    """What an open element lies in; elements that change nothing share their parent's, and none is changed."""

    gone: bool = False
    quoted: bool = False
    above: tuple[int | None, ...] = (None,) * len(BIG)
    note: tuple = (None, None, None)
    num: tuple = (False, None)
    head: int | None = None
    credit: bool = False
    table: int | None = None
    row: tuple = (None, None)
    cell: tuple = (None, None)
    mark: tuple = (None, None)
    field: tuple = (None, None)
    flat: bool = False  # in a quote inside a sentence: plain text
    label: bool = False

    def having(self, **new: object) -> _Inside:
        out = object.__new__(_Inside)
        out.__dict__.update(self.__dict__, **new)
        out.__dict__.pop("texts", None)
        return out

    @cached_property
    def texts(self) -> list:
        """A text's row without what differs from text to text; their lists of levels are one."""
        return [None, "text", None, self.gone, None, self.quoted, None, None, None, None, None, list(self.above), None, *self.note, *self.num, self.head, self.credit, self.table, *self.row, *self.cell, None, None, *self.field, None, None]


#: Of an element's name: which parts of ``Dialect`` have it.
_Parts = namedtuple("_Parts", "skipped quoted note num head credit table row cell mark field label border ref sentence")


def _rows_of(text: str, d: Dialect) -> Iterator[tuple]:
    """Rows of one document, without its key; a malformed one ends where its error is."""
    reader = Reader(d)
    for seq, event in enumerate(markup.parse(text)):
        yield from reader.rows(seq, *event)
    yield from reader.rest()


class Reader:
    """Turns events into rows; what it needs to know of those before is the stack of open elements and the block."""

    def __init__(self, d: Dialect):
        self.d = d
        kinds = (("skipped", d.skipped), ("quoted", d.quoted), ("note", d.notes), ("num", d.numbers), ("head", d.headings), ("credit", d.credits), ("table", d.tables), ("row", d.rows), ("cell", d.cells), ("mark", d.marks), ("field", d.fields))
        self.named = {kind: set(names) for kind, names in kinds} | {"label": set(d.labels), "ref": set(d.refs)}
        self.named["border"] = set().union(d.numbers, d.headings, d.blocks, d.notes, d.credits, d.quoted, d.labels)
        # A quote inside one of these is part of a sentence.
        self.named["sentence"] = set().union(d.blocks, d.credits, d.marks, d.refs)
        self.parts: dict[str | None, _Parts] = {}
        # What an element lies in, whether it begins a block, its name, and the row that its end makes.
        self.stack: list[tuple[_Inside, bool, str | None, tuple | None]] = [(_Inside(), False, None, None)]
        self.block, self.last = 0, None
        # Rows since a superscript that a mark may follow, and which of them are its own.
        self.held: list[list] = []
        self.own: list[int] = []

    def _text(self, seq: int, now: _Inside, data: str, mark: tuple = (None, None), href: str | None = None, edge: str | None = None) -> list:
        row = now.texts.copy()
        row[0], row[2], row[4], row[12] = seq, data, self.block, self.last
        row[25], row[26] = mark
        row[29], row[30] = href, edge
        return row

    def _parts_of(self, name: str | None) -> _Parts:
        if name not in self.parts:
            self.parts[name] = _Parts(*[name in self.named[kind] for kind in _Parts._fields])
        return self.parts[name]

    def rest(self) -> list[list]:
        out, self.held, self.own = self.held, [], []
        return out

    def _marked(self) -> None:
        """The superscript that was held is the mark of a footnote."""
        for i in self.own:
            row = self.held[i]
            row[-6], row[-5] = NOTE_MARK, None

    def rows(self, seq: int, kind: str, name: str | None, attrs: dict[str, str], data: str | None) -> Sequence[list]:
        if kind == "text":
            now = self.stack[-1][0]
            if now.gone and now.field[0] is None:
                return ()
            row = self._text(seq, now, data, (None, None) if now.flat else now.mark)
            if self.d.sup_mark and now.mark[0] == self.d.sup:
                self.own.append(len(self.held))
                self.held.append(row)
                return ()
            if self.held:
                self.held.append(row)
                return ()
            return (row,)
        if kind == "open":
            return self._opened(seq, name, attrs)
        if kind != "close":
            return ()
        now, border, _, ending = self.stack.pop()
        out = self.rest() if border and self.held else []
        self.block += border
        if ending is not None:
            row = self._text(seq, self.stack[-1][0], *ending)
            (self.held if self.held else out).append(row)
        return out

    def _opened(self, seq: int, name: str, attrs: dict[str, str]) -> list[list]:
        d, parts = self.d, self._parts_of(name)
        now, _, parent, _ = self.stack[-1]
        ending, out = None, []
        if name == d.sup_mark:
            self._marked()
        if name in (d.sup, d.sup_mark):
            out += self.rest()
        if now.flat or (parts.quoted and self._parts_of(parent).sentence and not now.gone):
            if not now.flat:
                out += self.rest()
                out.append(self._text(seq, now, '"'))
                ending = ('"',)
                now = now.having(flat=True)
            self.stack.append((now, False, name, ending))
            return out
        new: dict = {}
        if parts.skipped:
            new["gone"] = True
        if parts.quoted:
            new["quoted"] = True
        free = not (now.gone or now.quoted or new)
        level = d.levels.get(attrs.get(d.level_attr) if d.level_attr else name) if free else None
        if level is not None:
            self.last = seq
            if level in BIG:
                i = BIG.index(level)
                new["above"] = (*now.above[:i], seq, *now.above[i + 1 :])
        if parts.note:
            new["note"] = (seq, attrs.get("topic"), attrs.get("role"))
        if parts.num:
            new["num"] = (True, attrs.get("value"))
        if parts.head:
            new["head"] = seq
        if parts.credit:
            new["credit"] = True
        if parts.row:
            new["row"] = (seq, name)
        if parts.cell:
            new["cell"] = (seq, name)
        if parts.mark:
            new["mark"] = (NOTE_MARK, None) if name == d.sup and now.note[0] is not None else (name, attrs.get("T"))
        if parts.field and not now.label:
            new["field"] = (name, seq)
        table = parts.table
        if table:
            new["table"] = seq
        if parts.label:
            new["label"] = True
        border = table or ((level is not None or parts.border) and now.table is None)
        border = border and not (now.gone or new.get("gone"))
        if border:
            out += self.rest()
        self.block += border
        if parts.ref and not now.gone:
            if d.note_ref and attrs.get(d.note_ref[0]) == d.note_ref[1]:
                new["mark"] = (NOTE_MARK, None)
            elif attrs.get(d.refs[name]):
                href = attrs[d.refs[name]]
                out.append(self._text(seq, now, "", href=href, edge="open"))
                ending = ("", (None, None), href, "close")
        if parts.label and not now.gone:
            title, part = (attrs.get(a, "") for a in d.labels[name])
            if title and part:
                out.append(self._text(seq, now.having(head=seq), f"{title} CFR Part {part}"))
                self.block += 1
        inside = now.having(**new) if new else now
        self.stack.append((inside, border, name, ending))
        if level is not None:
            number = attrs.get(d.number_attr) if d.number_attr else None
            if level == "title" and d.title_attr:  # there N is the number of a volume
                number = attrs.get(d.title_attr, "").partition(":")[0] or number
            identifier = attrs.get(d.identifier_attr) if d.identifier_attr else None
            out.append([seq, "open", None, False, self.block, False, level, name, identifier, number, attrs.get("status"), list(inside.above), self.last, *(None,) * 3, False, None, None, False, *(None,) * 11])
        return out


def column(values: Sequence, kind: pa.DataType) -> pa.Array:
    """An Arrow array; rows mostly leave most columns empty, and texts of one place share their list."""
    if values.count(None) == len(values):
        return pa.nulls(len(values), kind)
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    nth: dict[int, int] = {}
    at = [None if v is None else nth.setdefault(id(v), len(nth)) for v in values]
    own = {id(v): v for v in values if v is not None}
    return pa.array([own[i] for i in nth], kind).take(pa.array(at, pa.int32()))


def scan(df: DataFrame, doc: str, xml: str, d: Dialect) -> DataFrame:
    """The texts and levels of every document, written to the shared folder so that all that is made of them reads them there.

    Null documents have no rows.  A document is read in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = [column(c, t) for c, t in zip(zip(*held, strict=True), _COLUMNS.values(), strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if not text.is_valid:
                    continue
                for row in _rows_of(text.as_py(), d):
                    held.append((key, *row))
                    if len(held) >= markup.BATCH:
                        yield flush()
        if held:
            yield flush()

    return written(df.select(F.col(doc).cast("string").alias("doc"), F.col(xml).cast("string").alias("xml")).mapInArrow(run, SCAN_SCHEMA), "scan")


def _unit(emit: str) -> Column:
    """The open level of a kind that a row lies in, by the number of its event."""
    return F.col("above")[BIG.index(emit)]


def _in_order(value: Column, *keys: str) -> Column:
    return F.transform(F.sort_array(F.collect_list(F.struct(*keys, value.alias("v")))), lambda e: e["v"])


def _joined(column: str = "text") -> Column:
    """Texts of a group in order, white space squeezed, blanks at the ends gone."""
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", F.col(column).alias("t")))), lambda e: e["t"]), "")
    return F.trim(F.regexp_replace(whole, r"\s+", " "))


def level_heads(rows: DataFrame) -> DataFrame:
    """(doc, level_seq, number, shown, heading): of every level, from the num, its value or else its text, and the heading in front of its text."""
    texts = rows.where("kind = 'text' and not gone and note is null and (in_num or head is not null) and last_level is not null")
    parts = texts.groupBy("doc", F.col("last_level").alias("level_seq"), "in_num", F.when(~F.col("in_num"), F.col("head")).alias("_h"))
    of_part = parts.agg(_joined().alias("t"), F.max("num_value").alias("value"), F.min("seq").alias("at"))
    plain = ~F.col("in_num")
    return of_part.groupBy("doc", "level_seq").agg(
        F.min(F.when(F.col("in_num"), F.coalesce("value", "t"))).alias("number"), F.min(F.when(F.col("in_num"), F.col("t"))).alias("shown"), F.min_by(F.when(plain, F.col("t")), F.when(plain, F.col("at"))).alias("heading")
    )


def units(rows: DataFrame, d: Dialect, emit: str = "section") -> DataFrame:
    """One row for each emitted level: doc, ord, identifier, number, heading, status, element, ancestors, parent, suffix.

    ``suffix`` tells apart levels that share a number inside their parent.
    """
    above = [t for t in BIG if t != emit and t in d.levels.values()]
    levels = rows.where("kind = 'open'").select("doc", "seq", "level", "name", "identifier", F.col("number").alias("_number"), "status", "above")
    levels = levels.join(level_heads(rows).drop("shown").withColumnRenamed("level_seq", "seq"), ["doc", "seq"], "left").withColumn("number", F.coalesce("_number", "number"))
    own = levels.where(F.col("level") == emit)
    link = F.struct(F.col("level").alias("level_type"), "identifier", "number", "heading")
    named = levels.where(F.col("level").isin(above)).select("doc", F.col("seq").alias("at"), link.alias("a"))
    places = F.array_compact(F.array(*[F.when(_unit(t).isNotNull(), F.struct(F.lit(n).alias("nth"), _unit(t).alias("at"))) for n, t in enumerate(above)])).cast("array<struct<nth:int,at:bigint>>")
    each = own.select("doc", "seq", F.explode(places).alias("p")).select("doc", "seq", "p.nth", "p.at")
    ancestors = each.join(named, ["doc", "at"]).groupBy("doc", "seq").agg(_in_order(F.col("a"), "nth").alias("ancestors"))
    own = own.select("doc", "seq", "identifier", "number", "heading", "status", F.col("name").alias("element"))
    out = own.join(ancestors, ["doc", "seq"], "left").withColumnRenamed("seq", "ord")
    parent = F.concat_ws("/", F.transform(F.coalesce("ancestors", F.array()), lambda a: F.concat_ws("-", a["level_type"], a["number"])))
    out = relations.duplicate_suffixes(out.withColumn("parent", parent), ["doc", "parent"], "number", [F.col("ord")])
    return out.withColumn("suffix", F.when(F.col("number").isNull(), "").otherwise(F.col("suffix")))


def linked(rows: DataFrame, files: DataFrame, registry: DataFrame, emit: str = "section") -> DataFrame:
    """``rows`` of ``scan`` with references as links: to the file of what they name, else of its section, else to the publisher's page.

    ``files`` has doc, ord and file_path of the units that the references lie in, ``registry`` identifier and file_path of all
    there is.  A reference outside of units, or one that leads nowhere, stays plain text.  Only distinct targets are resolved.
    """
    refs = rows.where(F.col("href").isNotNull()).withColumn("ord", _unit(emit))
    inside = refs.select("doc", "ord", "href").distinct().join(files.select("doc", "ord", "file_path"), ["doc", "ord"])
    urls = written(relations.resolved_links(inside, "href", registry, "file_path").where(F.col("url").isNotNull()).select("doc", "ord", "href", "url"), "urls")
    shown = F.when(F.col("url").isNull(), "").when(F.col("edge") == "open", "[").otherwise(F.concat(F.lit("]("), "url", F.lit(")")))
    known = refs.drop("text").join(small_or_shuffled(urls), ["doc", "ord", "href"], "left").withColumn("text", shown)
    return rows.where(F.col("href").isNull()).unionByName(known.select(*rows.columns))


def documents(rows: DataFrame, d: Dialect, emit: str = "section", notes: tuple[bool, bool, bool] | None = None, credits: bool = True) -> DataFrame:
    """One row for each emitted level: doc, ord, identifier, number, heading, status, ancestors, markdown, source_credit, token_estimate, suffix.

    ``rows`` are those of ``scan``.  ``notes``: whether editorial, statutory and amendment notes stay; None keeps all.  ``suffix`` tells apart
    levels that share a number inside their parent.  Without ``credits`` they are in a column alone, not in the Markdown.
    """
    out = units(rows, d, emit).join(_bodies(rows, d, emit, notes, credits), ["doc", "ord"], "left")
    out = out.withColumn("markdown", F.coalesce("markdown", F.lit("")))
    return out.withColumn("token_estimate", F.ceil(F.length("markdown") / 4).cast("long"))


def _marked(kind: Column, text: Column) -> Column:
    """An inline text with its marks; white space at its ends stays outside of them."""
    at = lambda pattern: F.regexp_extract(text, pattern, 0)
    return F.concat(at(r"^\s*"), markdown.inline(kind, F.regexp_replace(text, r"^\s+|\s+$", "")), at(r"\s*$"))


def _bodies(rows: DataFrame, d: Dialect, emit: str, notes: tuple[bool, bool, bool] | None, credits: bool = True) -> DataFrame:
    """(doc, ord, markdown, source_credit) of every unit."""
    inside = rows.where((F.col("kind") == "text") & ~F.col("gone") & _unit(emit).isNotNull()).withColumn("ord", _unit(emit))
    own_head = F.expr("note is null and (in_num or head is not null) and last_level = ord")
    texts = inside.where("table is null").where(~(own_head & F.lit(d.source != "fr")))
    kind = F.try_element_at(F.create_map(*[F.lit(x) for pair in d.marks.items() for x in pair]), F.col("mark"))
    if d.codes:
        kind = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in d.codes.items() for x in pair]), F.col("code")), kind)
    # White space alone stays as it is: it parts the elements around it.
    shown = F.when(F.col("mark").isNotNull() & F.col("text").rlike(r"\S"), _marked(kind, F.col("text"))).otherwise(F.col("text"))
    part = F.when(F.col("credit"), "credit").when(F.col("in_num"), "num").when(F.col("head").isNotNull(), "head").otherwise("text")
    blocks = (
        texts.withColumn("shown", shown)
        .withColumn("part", part)
        .groupBy("doc", "ord", "block", "part", "note", "quoted", "topic", "role")
        .agg(_joined("shown").alias("t"))
        .where("t <> ''")
    )
    if notes is not None:
        blocks = written(blocks, "blocks")
        each = blocks.where("note is not null").groupBy("doc", "ord", "note").agg(F.first("topic", True).alias("topic"), F.first("role", True).alias("role"))
        kept = relations.notes_kept(each, ["doc", "ord"], [F.col("note")], *notes).select("doc", "ord", "note")
        blocks = blocks.where("note is null").unionByName(blocks.where("note is not null").join(kept, ["doc", "ord", "note"], "left_semi"))
    bold = F.concat(F.lit("**"), F.col("t"), F.lit("**"))
    of_note = F.concat(F.when(F.col("role") == "crossHeading", "## ").otherwise("### "), "t")
    head_of_note = (F.col("part") == "head") & F.col("note").isNotNull()
    md = F.when(head_of_note, of_note).when(F.col("part").isin("num", "head"), bold).when(F.col("quoted"), quoted_block(F.col("t"))).otherwise(F.col("t"))
    lines = blocks.select("doc", "ord", "block", "part", md.alias("md"), F.col("note").isNotNull().alias("in_note"), F.when(F.col("part") == "credit", F.col("t")).alias("credit"))
    lines = lines.withColumn("md", F.when(F.col("part") == "credit", F.concat(F.lit(d.credit_label), "md")).otherwise(F.col("md")))
    lines = lines.unionByName(_tables(inside, d))
    # Numbers and headings lead the text behind them; what begins a paragraph is told from the line before in an array.
    follow = "(l.part = 'head' AND before = 'num')" + (" OR (l.part = 'text' AND before IN ('num', 'head') AND NOT l.in_note)" if d.source == "usc" else "")
    listed = "array_sort(collect_list(struct(block, part, md, in_note, credit)))"
    shown_lines = "l" if credits else "filter(l, x -> x.part <> 'credit')"
    gathered = lines.groupBy("doc", "ord").agg(F.expr(listed).alias("l")).select("doc", "ord", F.expr(shown_lines).alias("s"), F.expr("nullif(array_join(filter(transform(l, x -> x.credit), x -> x IS NOT NULL), ' '), '')").alias("source_credit"))
    joined = f"""array_join(transform(s, (l, i) -> concat(
      CASE WHEN i = 0 THEN '' WHEN {follow.replace("before", "element_at(s, i).part")} THEN ' ' ELSE '\\n\\n' END, l.md)), '')"""
    return gathered.select("doc", "ord", F.expr(joined).alias("markdown"), "source_credit")


def _tables(inside: DataFrame, d: Dialect) -> DataFrame:
    """Tables of the units as blocks."""
    cells = inside.where("table is not null and cell is not null")
    header = F.col("cell_name").isin(list(d.header_cells)) | F.col("row_name").isin(list(d.header_rows))
    texts = cells.groupBy("doc", "ord", "table", "row", "cell").agg(_joined().alias("t"), F.max(header).alias("header"), F.min("block").alias("block"))
    lines = texts.groupBy("doc", "ord", "table", "row").agg(_in_order(F.col("t"), "cell").alias("cells"), F.max("header").alias("header"), F.min("block").alias("block"))
    ordered = F.sort_array(F.collect_list(F.struct("row", "header", "cells")))
    tables = lines.groupBy("doc", "ord", "table").agg(ordered.alias("r"), F.min("block").alias("block"))
    pick = lambda header: F.transform(F.filter("r", lambda e: e["header"] == header), lambda e: e["cells"])
    return tables.select("doc", "ord", "block", F.lit("table").alias("part"), markdown.table(pick(F.lit(True)), pick(F.lit(False))).alias("md"), F.lit(False).alias("in_note"), F.lit(None).cast("string").alias("credit"))


def field_texts(rows: DataFrame, d: Dialect, emit: str = "section") -> DataFrame:
    """(doc, ord) of every emitted level with a column for each of the dialect's fields: the element's text, of several the last."""
    texts = rows.where((F.col("kind") == "text") & F.col("field").isNotNull() & _unit(emit).isNotNull())
    each = texts.groupBy("doc", _unit(emit).alias("ord"), F.col("field").alias("name"), F.col("field_seq").alias("at")).agg(_joined().alias("t"))
    return each.groupBy("doc", "ord").agg(*[F.max_by(F.when(F.col("name") == n, F.col("t")), F.when(F.col("name") == n, F.col("at"))).alias(n) for n in d.fields])


def document_meta(events: DataFrame) -> DataFrame:
    """(doc, dc_title, dc_type, doc_number, publication_name, release_point, publisher, created, creator, positive_law) of each document.

    Each is the text of an element of the document's ``meta`` block, of several the last; positive_law is whether its property says yes.
    """
    names = {"dc:title": "dc_title", "dc:type": "dc_type", "docNumber": "doc_number", "docPublicationName": "publication_name", "docReleasePoint": "release_point", "dc:publisher": "publisher", "dcterms:created": "created", "dc:creator": "creator"}
    # Such blocks are short and stand at the beginning: only what is before their end is sorted.
    ends = events.where((F.col("kind") == "close") & (F.col("name") == "meta")).groupBy("doc").agg(F.min("seq").alias("_end"))
    rows = events.where("kind <> 'error'").join(ends, "doc").where("seq < _end")
    held = F.last(F.when(F.col("kind").isin("open", "close"), F.when(F.col("kind") == "open", F.struct("seq", "name", F.col("attrs")["role"].alias("role"))).otherwise(F.struct(F.lit(-1).cast("long").alias("seq"), "name", F.lit(None).cast("string").alias("role")))), ignorenulls=True)
    texts = rows.withColumn("at", held.over(Window.partitionBy("doc").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))).where("kind = 'text' and at.seq >= 0")
    each = texts.groupBy("doc", "at.seq", "at.name", "at.role").agg(_joined().alias("t"))
    latest = lambda which, value=F.col("t"): F.max_by(F.when(which, value), F.when(which, F.col("seq")))
    law = (F.col("name") == "property") & (F.col("role") == "is-positive-law")
    return each.groupBy("doc").agg(*[latest(F.col("name") == n).alias(c) for n, c in names.items()], latest(law, F.lower("t") == "yes").alias("positive_law"))


def code_documents(rows: DataFrame, emit: str = "section", notes: tuple[bool, bool, bool] | None = None, credits: bool = True, meta: DataFrame | None = None) -> DataFrame:
    """Statutes: documents with legal status, title number and display title.

    ``meta``, as ``document_meta`` returns it, tells whether a title is positive law (without it none is) and its number, which
    may end in 'a' for an appendix; without one it is that of the level above.
    """
    out = documents(rows, USLM, emit, notes, credits)
    none = F.lit(None)
    out = out.withColumn("doc_number", none.cast("string")).withColumn("positive_law", none.cast("boolean")) if meta is None else out.join(meta.select("doc", "doc_number", "positive_law"), "doc", "left")
    title = F.get(F.filter(F.col("ancestors"), lambda a: a["level_type"].isin("title", "appendix")), 0)["number"]
    number = F.regexp_replace(F.coalesce("doc_number", title), "(?i)a$", "")
    status = F.when(F.coalesce("positive_law", F.lit(False)), "official_legal_evidence").otherwise("official_prima_facie")
    shown = F.concat_ws("", number, F.lit(" USC § "), "number", F.lit(" - "), "heading")
    return out.withColumn("legal_status", status).withColumn("title_number", identifiers.leading_int(number)).withColumn("display_title", shown)


def regulation_documents(rows: DataFrame, emit: str = "section") -> DataFrame:
    """Regulations: identifiers are made from the title's and the level's numbers, prefixes leave the headings."""
    out = documents(rows, ECFR, emit)
    title = F.get(F.filter(F.col("ancestors"), lambda a: a["level_type"] == "title"), 0)["number"]
    mark = {"section": "/s", "part": "/pt", "chapter": "/ch"}.get(emit)
    identifier = F.concat(F.lit("/us/cfr/t"), F.col("number") if mark is None else F.concat(title, F.lit(mark), F.col("number")))
    own = F.regexp_replace("heading", "^§+\\s*", "")
    own = F.when(own.startswith(F.col("number")), F.regexp_replace(F.substr(own, F.length("number") + 1), "^[. ]+", "")).otherwise(own)
    stripped = F.transform("ancestors", lambda a: a.withField("heading", identifiers.heading_stripped(a["heading"])))
    return out.withColumn("identifier", identifier).withColumn("heading", identifiers.heading_stripped(own)).withColumn("ancestors", stripped)


def register_documents(rows: DataFrame) -> DataFrame:
    """Register documents of daily issues: many from one file, with number, dates and preamble fields."""
    fields = field_texts(rows, FR)
    filed = dates.filed_document(F.col("FRDOC"))
    meta = fields.select("doc", "ord", F.col("AGENCY").alias("agency"), F.col("SUBAGY").alias("sub_agency"), F.col("SUBJECT").alias("subject"), F.col("CFR").alias("cfr"), F.regexp_replace("RIN", "^RIN\\s+", "").alias("rin"), filed.alias("f"))
    out = documents(rows, FR).drop("identifier").join(meta, ["doc", "ord"], "left")
    kinds = F.create_map(*[F.lit(x) for pair in (("RULE", "rule"), ("PRORULE", "proposed_rule"), ("NOTICE", "notice"), ("PRESDOCU", "presidential_document")) for x in pair])
    out = out.withColumn("document_type", F.try_element_at(kinds, F.col("element")))
    out = out.withColumn("identifier", F.concat(F.lit("/us/fr/"), F.col("f.document_number")))
    return out.withColumn("document_number", F.col("f.document_number")).withColumn("publication_date", F.coalesce("f.publication_date", dates.path_date(F.col("doc")))).drop("f")


def plain_tokens(rows: DataFrame, emit: str = "section") -> DataFrame:
    """Dry run: token estimates of the emitted levels from their texts, nothing rendered."""
    texts = rows.where((F.col("kind") == "text") & ~F.col("gone") & _unit(emit).isNotNull())
    return texts.groupBy("doc", _unit(emit).alias("ord")).agg(F.ceil(F.sum(F.length("text")) / 4).cast("long").alias("token_estimate"))


def composites(rows: DataFrame, d: Dialect, emit: str = "chapter", notes: tuple[bool, bool, bool] | None = None, credits: bool = True) -> DataFrame:
    """One row for each level of a kind above sections, with all that lies in it as one text: ``units`` and markdown, n_sections, token_estimate.

    The level itself is a heading of the first level.  Below it levels and sections follow each other in the order of the
    document, each one heading deeper than the level that it lies in; levels end at headings of the fifth level and are bold
    beyond it, sections end at the sixth.  Text that lies in a level and in no section stands where it does in the document.  A text is
    one row of output, as a file is; nothing else is gathered in one place.
    """
    if emit not in BIG or emit == "section":
        raise ValueError(f"{emit!r} is no level above sections")
    section = BIG.index("section")
    heads = level_heads(rows).withColumnRenamed("level_seq", "seq").select("doc", "seq", "shown", "heading")
    inside = rows.where((F.col("kind") == "open") & F.col("level").isin(*BIG) & _unit(emit).isNotNull()).withColumn("unit", _unit(emit))
    # Of the levels inside one that stand open at once, each is opened after those around it.
    depth = F.size(F.filter("above", lambda at: at > F.col("unit"))) + 1
    levels = inside.where((F.col("seq") >= F.col("unit")) & ((F.col("level") == "section") | _unit("section").isNull()))
    levels = levels.select("doc", "unit", "seq", "level", depth.alias("depth")).join(heads, ["doc", "seq"], "left")
    text = F.concat_ws(" ", F.nullif("shown", F.lit("")), F.nullif("heading", F.lit("")))
    is_section = F.col("level") == "section"
    lead = F.when(is_section, markdown.heading(F.least("depth", F.lit(6)), text)).otherwise(markdown.heading(F.col("depth"), text, 5))
    bodies = _bodies(rows, d, "section", notes, credits).select("doc", F.col("ord").alias("seq"), F.col("markdown").alias("body"))
    pieces = levels.join(bodies, ["doc", "seq"], "left")
    whole = F.when(is_section, F.concat_ws("\n\n", lead, F.nullif("body", F.lit("")))).otherwise(lead)
    pieces = pieces.select("doc", "unit", F.col("seq").alias("at"), F.lit(0).alias("nth"), whole.alias("md"), is_section.cast("long").alias("is_section"))
    # What lies in no section is placed behind the level that was opened last; for these texts that level takes the section's part.
    outside = rows.where((F.col("kind") == "text") & _unit(emit).isNotNull() & _unit("section").isNull() & F.col("last_level").isNotNull())
    slots = F.array(*[F.col("last_level") if i == section else F.col("above")[i] for i in range(len(BIG))])
    own = _bodies(outside.withColumn("above", slots), d, "section", notes, credits)
    where = outside.select("doc", F.col("last_level").alias("ord"), _unit(emit).alias("unit")).distinct()
    own = own.join(where, ["doc", "ord"]).where("markdown <> ''").select("doc", "unit", F.col("ord").alias("at"), F.lit(1).alias("nth"), F.col("markdown").alias("md"), F.lit(0).cast("long").alias("is_section"))
    gathered = pieces.unionByName(own).groupBy("doc", F.col("unit").alias("ord")).agg(F.array_join(_in_order(F.col("md"), "at", "nth"), "\n\n").alias("markdown"), F.sum("is_section").alias("n_sections"))
    out = units(rows, d, emit).join(gathered, ["doc", "ord"], "left")
    return out.withColumn("token_estimate", F.ceil(F.length("markdown") / 4).cast("long"))
