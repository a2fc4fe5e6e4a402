"""Deterministic shards of a table by a long key, and files that tasks write and that are committed together.

Cut points come from an exact histogram of the keys that is refined only where it is heavy, so equal
input gives equal shards however it is split over tasks.  A key that is heavier than a shard, and the null keys, are dealt
to several shards by a hash of the row.  Tasks write files under temporary names that no
other attempt has; only names that a successful task reported are moved to their final ones, and the
manifest, a row for each file, is written last.  Readers follow the manifest, so a job that fails half-way leaves nothing visible.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells of one round of the histogram, as a power of two, and the largest number of shards.
CELL_BITS, MAX_SHARDS = 12, 100_000
SIGN = 1 << 63
MANIFEST = "MANIFEST.json"


class Cuts(NamedTuple):
    """Ascending keys at which a new range begins, and the shards of each range; the first range has the null keys."""

    starts: np.ndarray
    shards: np.ndarray

    @property
    def count(self) -> int:
        return int(self.shards.sum())

    def shard_of(self, keys: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the shards of an array of keys; ``hashes`` are 32-bit numbers that stand for the rows."""
        null = keys.is_null().to_numpy(zero_copy_only=False)
        at = np.searchsorted(self.starts, keys.fill_null(0).to_numpy(zero_copy_only=False), side="right") + 1
        at[null] = 0
        first = np.cumsum(self.shards) - self.shards
        return (first[at] + (hashes.astype(np.int64) * self.shards[at] >> 32)).astype(np.int32)


def cut_points(df: DataFrame, key: str, weight: str, target: int) -> Cuts:
    """Ranges of keys of about ``target`` weight; a heavier single key is a range of several shards.

    Each round collects one sum for each of at most 4,096 cells of each heavy cell; heavy cells number at most
    (all weight) / target.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(weight).cast("long").alias("weight"))
    low, high, total, nulls = rows.agg(F.min("key"), F.max("key"), F.sum("weight"), F.sum(F.when(F.col("key").isNull(), F.col("weight")))).first()
    target = max(1, target, -(-(total or 0) // MAX_SHARDS))
    of_nulls = -(-(nulls or 0) // target)
    if low is None or not total:
        return Cuts(np.zeros(0, np.int64), np.array([max(1, of_nulls), 1]))
    # With the sign bit flipped, keys are in order as unsigned numbers, and a cell is a common prefix of them.
    shift = max(0, ((int(low) + SIGN) ^ (int(high) + SIGN)).bit_length() - CELL_BITS)
    cell = lambda s: F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-SIGN)), s)
    first_key = lambda c, s: ((c % (1 << 64)) << s) - SIGN
    rows = rows.where("key is not null")
    light: list[tuple[int, int]] = []
    part = rows
    while True:
        found = part.groupBy(cell(shift).alias("c")).agg(F.sum("weight").alias("w")).collect()
        heavy = [r["c"] for r in found if r["w"] > target and shift > 0]
        light += [(first_key(r["c"], shift), int(r["w"])) for r in found if r["w"] <= target or shift == 0]
        if not heavy:
            break
        part = rows.where(cell(shift).isin(heavy))
        shift = max(0, shift - CELL_BITS)
    starts, shards, held = [], [max(1, of_nulls), 1], 0
    for at, weight_ in sorted(light):
        if held and held + weight_ > target:
            starts.append(at)
            shards.append(1)
            held = 0
        held += weight_
        shards[-1] = max(shards[-1], -(-weight_ // target))  # above 1 only for a heavy key, which is alone in its range
    return Cuts(np.array(starts, np.int64), np.array(shards, np.int64))


def sized(total: int, least: int, most: int, count: int = 2_000) -> int:
    """Bytes of a shard: a ``count``-th of all within the bounds, so that small tables have shards enough and large ones not too many."""
    return max(least, min(most, -(-total // count)))


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """A file system that tasks can write to and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def commit(spark: SparkSession, base: str, files: list[dict]) -> None:
    """Move each file from its ``temp`` to its ``name`` under ``base``, then write the manifest.

    ``files`` has an entry for each file, not for each record.  Tasks do the moving; one that is run again finds a file
    under its final name and leaves it.
    """

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(base)
        for b in batches:
            for temp, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    store.move(f"{path}/{temp}", f"{path}/{name}")
                except OSError:
                    if store.get_file_info(f"{path}/{name}").type != fs.FileType.File:
                        raise
            yield pa.RecordBatch.from_arrays([b.column(1)], names=["name"])

    if files:
        file_rows(spark, files, "temp string, name string").mapInArrow(move, "name string").count()
    store, path = file_system(base)
    with store.open_output_stream(f"{path}/{MANIFEST}.tmp") as out:
        out.write(json.dumps([{k: v for k, v in f.items() if k != "temp"} for f in files]).encode())
    store.move(f"{path}/{MANIFEST}.tmp", f"{path}/{MANIFEST}")
    if store.get_file_info(f"{path}/_temporary").type == fs.FileType.Directory:
        store.delete_dir(f"{path}/_temporary")


def manifest(base: str) -> list[dict]:
    store, path = file_system(base)
    with store.open_input_stream(f"{path}/{MANIFEST}") as f:
        return json.loads(f.read())


def file_rows(spark: SparkSession, files: list[dict], schema: str, most: int = 10_000) -> DataFrame:
    """A table of the manifest's files, one file in a partition or, beyond ``most``, a few."""
    names = [c.split()[0] for c in schema.split(",")]
    parts = max(1, min(most, len(files)))
    rows = [(i % parts, *(f[n] for n in names)) for i, f in enumerate(files)]
    df = spark.createDataFrame(rows, f"_n int, {schema}")
    return df.repartitionById(parts, F.col("_n")).drop("_n")


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of tuples."""
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
