"""XML to files in one run: path, front matter, heading and body with links, written if changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.functions import metadata, paths
from registra.operators import sections
from registra.shared import written
from registra.sources import files as sink
from registra.sources import xml as markup


def code_paths(units: DataFrame, root: str, meta: DataFrame | None = None) -> DataFrame:
    """``units`` of statutes with file_path; ``meta`` as ``sections.document_meta`` gives it."""
    number = F.lit(None).cast("string")
    if meta is not None:
        units, number = units.join(meta.select("doc", F.col("doc_number").alias("_doc_number")), "doc", "left"), F.col("_doc_number")
    above = F.coalesce("ancestors", F.array().cast(units.schema["ancestors"].dataType))
    return units.withColumn("file_path", paths.code_path(root, above, F.col("number"), F.col("suffix"), number)).drop("_doc_number")


def code_files(df: DataFrame, doc: str, xml: str, root: str, registry: DataFrame | None = None, links: bool = True, notes: tuple[bool, bool, bool] | None = None, credits: bool = True) -> DataFrame:
    """(path, text) of the file of each section of the statutes in ``df``.

    The documents are scanned once for their texts and, up to the end of their metadata, once for these.  References lead to files of this run, of
    ``registry`` (identifier, file_path), or to the publisher's pages; without ``links`` they are plain text.
    """
    rows = sections.scan(df, doc, xml, sections.USLM)
    meta = sections.document_meta(written(markup.events(df, doc, xml, "meta"), "events"))
    files = code_paths(sections.units(rows, sections.USLM), root, meta).select("doc", "ord", "identifier", "file_path")
    if links:
        known = files.select("identifier", "file_path")
        rows = sections.linked(rows, files, known if registry is None else known.unionByName(registry.select("identifier", "file_path")))
    docs = sections.documents(rows, sections.USLM, "section", notes, credits).join(files.select("doc", "ord", "file_path"), ["doc", "ord"])
    shown = sections.level_heads(rows).select("doc", F.col("level_seq").alias("ord"), "shown")
    docs = docs.join(shown, ["doc", "ord"], "left").join(meta, "doc", "left")
    about = {n: F.col(n) for n in ("doc_number", "dc_title", "publication_name", "created", "positive_law")}
    above = F.coalesce("ancestors", F.array().cast(docs.schema["ancestors"].dataType))
    front = metadata.block(metadata.code_fields(F.col("number"), F.col("heading"), above, F.col("identifier"), F.col("status"), F.col("source_credit"), about))
    head = F.concat_ws(" ", F.lit("#"), F.nullif("shown", F.lit("")), F.nullif("heading", F.lit("")))
    return docs.select(F.col("file_path").alias("path"), F.concat(F.concat_ws("\n\n", front, head, F.nullif("markdown", F.lit(""))), F.lit("\n")).alias("text"))


def write_code(df: DataFrame, doc: str, xml: str, base: str, root: str = "output", **how: object) -> DataFrame:
    """Convert and write what differs from the files at ``base``; (path) of the files written."""
    return sink.write_changed(code_files(df, doc, xml, root, **how), base)
