"""Markdown files with front matter, JSON sidecars, and a sink that writes only what changed."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra import shared
from registra.functions import text


def markdown_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content_hash, front_matter, body) of all .md files but READMEs; front_matter maps scalar fields to texts."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(path)
    docs = raw.where(~F.col("path").rlike("(^|/)README\\.md$")).select("path", "modificationTime", F.decode("content", "UTF-8").alias("doc"))
    block = text.front_matter_block(F.col("doc"))
    pairs = F.arrays_zip(
        F.regexp_extract_all(block, F.lit('(?m)^([A-Za-z_]+):[ \\t]*"?([^"\\n]+)"?[ \\t]*$'), 1).alias("key"),
        F.regexp_extract_all(block, F.lit('(?m)^([A-Za-z_]+):[ \\t]*"?([^"\\n]+)"?[ \\t]*$'), 2).alias("value"),
    )
    return docs.select("path", F.col("modificationTime").alias("modified"), text.content_hash(F.col("doc")).alias("content_hash"), F.map_from_entries(pairs).alias("front_matter"), text.front_matter_body(F.col("doc")).alias("body"))


def sidecars(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files of one object each; malformed ones are left out."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").option("wholetext", "true").text(path)
    parsed = raw.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("j"))
    first = schema.split()[0]
    return parsed.where(F.col(f"j.{first}").isNotNull()).select("path", "j.*")


def changed_since(files: DataFrame, checkpoint: pd.Timestamp | None) -> DataFrame:
    """Files modified after a checkpoint; all without one."""
    return files if checkpoint is None else files.where(F.col("modified") > F.lit(checkpoint))


def write_changed(df: DataFrame, base: str) -> DataFrame:
    """Write each row's ``text`` to base/path unless it is there already; (path) of the files written.

    Tasks write to a temporary name and move it, so a repeated task finds its file unchanged.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(base if "://" in base else f"file://{base}")
        for pdf in batches:
            written = []
            for path, body in zip(pdf["path"], pdf["text"], strict=True):
                target, data = f"{root}/{path}", body.encode()
                info = store.get_file_info(target)
                if info.type == fs.FileType.File and info.size == len(data):
                    with store.open_input_stream(target) as f:
                        if f.read() == data:
                            continue
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                temp = f"{target}.{uuid4().hex}.tmp"
                with store.open_output_stream(temp) as f:
                    f.write(data)
                store.move(temp, target)
                written.append(path)
            if written:
                yield pd.DataFrame({"path": written})

    done = df.select("path", "text").mapInPandas(run, "path string")
    return shared.written(done, "files")
