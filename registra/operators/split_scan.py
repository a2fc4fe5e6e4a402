"""One large document read by many tasks: the rows of ``sections.scan`` from ranges of files.

Spark's text reader splits files of any store by bytes when '>' is the line separator, so records are what stands up to
the end of a tag, and neighbours may lie in different tasks.  Three small scans over one row for each range, and none
over the text, make each range readable by itself:

1. whether it begins inside a comment, a quoted attribute or the like: every range says where it ends for each state it could
   begin in, and these functions are applied one after the other;
2. which elements are open where it begins: every range says how many elements it closes that were opened before, and which it
   leaves open;
3. how many blocks of text and which level came before.

A range is then parsed behind the tags that are open there, and its rows get the numbers that they have in the whole document.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registra.operators import sections
from registra.operators.sections import Dialect
from registra.shared import written
from registra.sources import xml as markup

#: Characters of a range.
RANGE = 1 << 20
#: Before the root, behind a tag, in text, and inside of comments, instructions, CDATA, a document type and quoted attributes.
STATES = ("R", "N", "X", "RC", "XC", "RP", "XP", "XD", "RT", '"', "'")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_MARKUP = re.compile(r"<!--.*?-->|<!\[CDATA\[(.*?)\]\]>|<\?.*?\?>|<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>|<(/?)([^\s/>!?]+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>", re.S)


def after(state: str, record: str) -> str:
    """The state behind a record, which ends before a '>', and the '>'."""
    base = "R" if state[0] == "R" else "X"
    if state in ("RC", "XC"):
        return base if record.endswith("--") else state
    if state in ("RP", "XP"):
        return base if record.endswith("?") else state
    if state == "XD":
        return "X" if record.endswith("]]") else state
    if state == "RT":
        return "R" if record.rstrip().endswith("]") else state
    if state in "\"'":
        end = record.find(state)
        if end < 0:
            return state
        return _open_quote(record[end + 1 :])
    at = record.find("<")
    if at < 0:  # a '>' that is text
        return base
    own = record[at:]
    if own.startswith("<!--"):
        return base if len(own) >= 6 and own.endswith("--") else base + "C"
    if own.startswith("<![CDATA["):
        return "X" if len(own) >= 11 and own.endswith("]]") else "XD"
    if own.startswith("<?"):
        return base if len(own) > 2 and own.endswith("?") else base + "P"
    if own.startswith("<!"):
        return "RT" if "[" in own and not own.rstrip().endswith("]") else "R"
    return _open_quote(own)


def _open_quote(tag: str) -> str:
    rest = _QUOTED.sub("", tag)
    places = [(i, q) for q in "\"'" if (i := rest.find(q)) >= 0]
    return min(places)[1] if places else "N"


def effect(text: str, first: bool) -> tuple[int, list[tuple[int, str]], int]:
    """(elements closed that were open before, [number of its event, tag] of those left open, events) of a range of whole tags."""
    closes, opens, events, run, begun = 0, [], 0, False, not first
    at = 0
    for m in _MARKUP.finditer(text):
        run = run or m.start() > at or bool(m[1])
        at = m.end()
        if m[3] is None:
            continue
        events += run and begun
        run, begun = False, True
        if m[2]:
            if opens:
                opens.pop()
            else:
                closes += 1
        else:
            if m[5]:
                events += 1
            else:
                opens.append((events, m[0]))
        events += 1
    return closes, opens, events


def chunks(spark: SparkSession, path: str, glob: str = "*.xml", size: int = RANGE) -> DataFrame:
    """(doc, block, part, text): ranges of about ``size`` characters of all files; doc is the file, block and part put them in order."""
    records = spark.read.option("lineSep", ">").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
    rows = records.select(F.col("_metadata.file_path").alias("doc"), F.col("_metadata.file_block_start").alias("block"), "value")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part, held, length = None, 0, [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"doc": [at[0]], "block": [at[1]], "part": [part], "text": [">".join([*held, ""])]})

        for b in batches:
            for doc, block, value in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and ((doc, block) != at or length >= size):
                    yield row()
                    part = part + 1 if (doc, block) == at else 0
                    held, length = [], 0
                elif (doc, block) != at:
                    part = 0
                at = doc, block
                held.append(value)
                length += len(value) + 1
        if held:
            yield row()

    return rows.mapInArrow(gather, "doc string, block long, part long, text string")


def _ordered(df: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over the ranges of each document in order; a row for each range meets in one task, and no text."""
    return df.groupBy("doc").applyInPandas(lambda pdf: run(pdf.sort_values([c for c in ("block", "part", "unit") if c in pdf])), schema)


def _states(pdf: pd.DataFrame) -> pd.DataFrame:
    state, out = "R", []
    for ends in pdf["ends"]:
        out.append(state)
        state = json.loads(ends)[state]
    return pdf[["doc", "block", "part"]].assign(state=out, nth=range(len(out)))


def _stacks(pdf: pd.DataFrame) -> pd.DataFrame:
    stack, seq, out, starts = [], 0, [], []
    for closes, opens, events in zip(pdf["closes"], pdf["opens"], pdf["events"], strict=True):
        out.append(json.dumps(stack))
        starts.append(seq)
        stack = [*stack[: max(0, len(stack) - closes)], *([seq + n, tag] for n, tag in json.loads(opens))]
        seq += events
    return pdf[["doc", "unit"]].assign(stack=out, start=starts)


def units(parts: DataFrame) -> DataFrame:
    """(doc, unit, text): the ranges moved to where tags end, so that each holds whole tags and the text in front of them."""
    parts = written(parts, "ranges")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                now = {s: s for s in STATES}
                for record in text.split(">")[:-1]:
                    step = {s: after(s, record) for s in set(now.values())}
                    now = {s: step[e] for s, e in now.items()}
                out.append(json.dumps(now))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc", "block", "part")), pa.array(out, pa.string())], names=["doc", "block", "part", "ends"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, bodies = [], []
            for text, state, nth in zip(*(b.column(c).to_pylist() for c in ("text", "state", "nth")), strict=True):
                at = 0
                if nth:
                    while state != "N" and at < len(text):
                        end = text.index(">", at)
                        state = after(state, text[at:end])
                        at = end + 1
                heads.append(text[:at])
                # What ends behind the last tag is the beginning of the next range's first one and stays in front of it.
                bodies.append(text[at:] if at < len(text) or not nth else None)
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("nth"), pa.array(heads, pa.string()), pa.array(bodies, pa.string())], names=["doc", "nth", "head", "body"])

    known = _ordered(parts.mapInArrow(ends, "doc string, block long, part long, ends string"), _states, "doc string, block long, part long, state string, nth int")
    split = written(parts.join(known, ["doc", "block", "part"]).select("doc", "nth", "text", "state").mapInArrow(cut, "doc string, nth int, head string, body string"), "cut")
    begun = F.count("body").over(Window.partitionBy("doc").orderBy("nth"))  # over a row for each range
    numbered = split.select("doc", "nth", begun.alias("n"), F.col("body").isNotNull().alias("has")).withColumn("unit", F.col("n").cast("int") - 1)
    joined = split.join(numbered, ["doc", "nth"])
    pieces = joined.select("doc", (F.col("unit") - F.col("has").cast("int")).alias("unit"), F.col("nth").alias("at"), F.col("head").alias("t")).where("t <> ''")
    pieces = pieces.unionByName(joined.where("has").select("doc", "unit", F.col("nth").alias("at"), F.col("body").alias("t")))
    gathered = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "t"))), lambda e: e["t"]), "")
    return written(pieces.groupBy("doc", "unit").agg(gathered.alias("text")), "units")


def scan(spark: SparkSession, path: str, d: Dialect, glob: str = "*.xml", size: int = RANGE) -> DataFrame:
    """The rows of ``sections.scan`` for the files at ``path``, each read by as many tasks as it has ranges; doc is the file's path.

    Files are UTF-8.  Where a document is malformed, the range that is so ends, and the others go on.  Dialects in which a mark changes what stands before it
    (``sup_mark``) are not read in ranges.  Empty files have no rows.
    """
    if d.sup_mark:
        raise ValueError(f"documents of {d.source!r} are not read in ranges")
    whole = units(chunks(spark, path, glob, size))

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [effect(t, u == 0) for t, u in zip(b.column("text").to_pylist(), b.column("unit").to_pylist(), strict=True)]
            columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([json.dumps(f[1]) for f in found], pa.string()), pa.array([f[2] for f in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("unit"), *columns], names=["doc", "unit", "closes", "opens", "events"])

    stacks = _ordered(whole.select("doc", "unit", "text").mapInArrow(effects, "doc string, unit int, closes long, opens string, events long"), _stacks, "doc string, unit int, stack string, start long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, unit, text, stack, start in zip(*(b.column(c).to_pylist() for c in ("doc", "unit", "text", "stack", "start")), strict=True):
                yield from _batches(doc, unit, _unit_rows(text, json.loads(stack), start, d))

    rows = written(whole.join(stacks, ["doc", "unit"]).select("doc", "unit", "text", "stack", "start").mapInArrow(read, f"{sections.SCAN_SCHEMA}, unit int, end boolean"), "rows")
    # The last row of a range says how many blocks it began and which level it opened last.
    ends = rows.where("end").select("doc", "unit", "block", "last_level")
    before = Window.partitionBy("doc").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each range
    ends = written(ends.select("doc", "unit", F.coalesce(F.sum("block").over(before), F.lit(0)).alias("_blocks"), F.last("last_level", True).over(before).alias("_last")), "ends")
    placed = rows.where("not end").join(ends, ["doc", "unit"])
    placed = placed.withColumn("block", F.col("block") + F.col("_blocks")).withColumn("last_level", F.coalesce("last_level", "_last"))
    return written(placed.select(*sections.COLUMNS), "scan")


def _unit_rows(text: str, stack: list[tuple[int, str]], start: int, d: Dialect) -> Iterator[list]:
    """Rows of a range, without its document; the last one tells how it ends."""
    found: list[tuple] = []
    parser, reader = markup.parser(found), sections.Reader(d)
    try:
        parser.Parse("".join(tag for _, tag in stack).encode(), False)
        for (seq, _), event in zip(stack, found, strict=True):
            list(reader.rows(seq, *event))
        found.clear()
        reader.block, reader.last = 0, None
        seq = start
        for event in markup.fed(parser, found, text):
            yield from reader.rows(seq, *event)
            seq += 1
    except (markup.expat.ExpatError, ValueError):
        pass
    for event in found:
        yield from reader.rows(seq, *event)
        seq += 1
    row: list = [None] * (len(sections.COLUMNS) - 1)
    row[sections.COLUMNS.index("block") - 1], row[sections.COLUMNS.index("last_level") - 1] = reader.block, reader.last
    yield row


def _batches(doc: str, unit: int, rows: Iterator[list]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    schema = sections._ARROW.append(pa.field("unit", pa.int32())).append(pa.field("end", pa.bool_()))

    def flush() -> pa.RecordBatch:
        columns = [sections.column(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row in rows:
        held.append((doc, *row, unit, row[1] is None))
        if len(held) >= markup.BATCH:
            yield flush()
    if held:
        yield flush()
