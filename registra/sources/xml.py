"""XML scans: a document becomes rows of open, close and text events, in order.

Only reading the markup is done in Python, by the standard library's streaming parser; trees, levels and
rendering are built from the events by windows and groupings (operators.sections).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefixes that stand for known namespaces; names of the default ones stay bare.
NAMESPACES = {
    "http://xml.house.gov/schemas/uslm/1.0": "",
    "http://schemas.gpo.gov/xml/uslm": "",
    "http://purl.org/dc/elements/1.1/": "dc",
    "http://purl.org/dc/terms/": "dcterms",
    "http://www.w3.org/1999/xhtml": "xhtml",
    "http://www.w3.org/2001/XMLSchema-instance": "xsi",
}
EVENT_SCHEMA = "doc string, seq long, kind string, name string, attrs map<string,string>, text string"
_ARROW = pa.schema([("doc", pa.string()), ("seq", pa.int64()), ("kind", pa.string()), ("name", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string())])
#: Events of a batch and characters given to the parser at once.
BATCH, CHARS = 8_192, 1 << 20


@lru_cache(maxsize=4_096)
def normalised(name: str) -> str:
    """'uri local' as local, prefix:local or {uri}local."""
    uri, _, local = name.rpartition(" ")
    if not uri:
        return local
    prefix = NAMESPACES.get(uri)
    return f"{{{uri}}}{local}" if prefix is None else f"{prefix}:{local}" if prefix else local


def parser(found: list[tuple]) -> expat.XMLParserType:
    """A parser that appends (kind, name, attributes, text) to ``found``; entity declarations are an error."""
    out = expat.ParserCreate(encoding="utf-8", namespace_separator=" ")
    out.buffer_text = True
    out.buffer_size = CHARS

    def refuse(*_: object) -> None:
        raise ValueError("entity declarations are not read")

    out.EntityDeclHandler = refuse
    out.StartElementHandler = lambda n, a: found.append(("open", normalised(n), {normalised(k): v for k, v in a.items()}, None))
    out.EndElementHandler = lambda n: found.append(("close", normalised(n), {}, None))

    def text(t: str) -> None:
        if found and found[-1][0] == "text":
            found[-1] = ("text", None, {}, found[-1][3] + t)
        else:
            found.append(("text", None, {}, t))

    out.CharacterDataHandler = text
    return out


def fed(reader: expat.XMLParserType, found: list[tuple], xml: str) -> Iterator[tuple]:
    """The events of ``xml``, given to the parser in parts; a text that a part ends in stays in ``found`` until it is whole."""
    for at in range(0, max(1, len(xml)), CHARS):
        reader.Parse(xml[at : at + CHARS].encode("utf-8", "surrogatepass"), False)
        begun = found.pop() if found and found[-1][0] == "text" else None
        yield from found
        found.clear()
        if begun is not None:
            found.append(begun)


def parse(xml: str) -> Iterator[tuple[str, str | None, dict[str, str], str | None]]:
    """(kind, name, attributes, text); an error ends a document that is malformed or declares entities."""
    found: list[tuple] = []
    reader = parser(found)
    try:
        yield from fed(reader, found, xml)
        reader.Parse(b"", True)
        yield from found
    except (expat.ExpatError, ValueError) as error:
        yield from found
        yield "error", None, {}, str(error)


def events(df: DataFrame, doc: str, xml: str, until: str | None = None) -> DataFrame:
    """Events of every document; null documents have none.

    With ``until`` a document is read to the first end of this element only, and not at all if it has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

        for b in batches:
            for key, text in zip(b.column(0), b.column(1), strict=True):
                if not text.is_valid or (until and not re.search(rf"</(?:[^\s<>/]+:)?{re.escape(until)}\s*>|<(?:[^\s<>/]+:)?{re.escape(until)}[\s/]", text.as_py())):
                    continue
                for seq, (kind, name, attrs, data) in enumerate(parse(text.as_py())):
                    held.append((key.as_py(), seq, kind, name, list(attrs.items()), data))
                    if len(held) >= BATCH:
                        yield flush()
                        held.clear()
                    if (kind, name) == ("close", until):
                        break
        if held:
            yield flush()

    return df.select(F.col(doc).cast("string").alias("doc"), F.col(xml).cast("string").alias("xml")).mapInArrow(run, EVENT_SCHEMA)


def read_files(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """(path, text, modified) of whole files, one row each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.decode("content", "UTF-8").alias("text"), F.col("modificationTime").alias("modified"))


def title_numbers(spec: str, lowest: int = 1, highest: int = 54) -> list[int]:
    """'1-5,8,11' as sorted distinct numbers within bounds."""
    out: set[int] = set()
    for part in spec.split(","):
        low, dash, high = part.strip().partition("-")
        if not low.isdigit() or (dash and not high.isdigit()):
            raise ValueError(f"{part!r} is neither a number nor a range")
        first, last = int(low), int(high) if dash else int(low)
        if not lowest <= first <= last <= highest:
            raise ValueError(f"{part.strip()!r} is not within {lowest} to {highest}")
        out.update(range(first, last + 1))
    return sorted(out)


def with_titles(files: DataFrame, titles: list[int] | None = None) -> DataFrame:
    """Files named usc01.xml and so on, with their title number, those of ``titles`` only."""
    number = F.regexp_extract("path", r"usc(\d{2})\.xml$", 1).try_cast("int")
    out = files.withColumn("title_number", number).where(F.col("title_number").isNotNull())
    return out if titles is None else out.where(F.col("title_number").isin(titles))
