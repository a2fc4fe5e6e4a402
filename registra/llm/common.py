"""Helpers that several operators share; the shared folder and checked broadcasts are those of ``registra.shared``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from registra.shared import BROADCAST_ROWS, drop_written, fresh_path, remove, shared_dir, small_or_shuffled, written

__all__ = ["BROADCAST_ROWS", "drop_written", "free_name", "fresh_path", "remove", "shared_dir", "small_or_shuffled", "tables", "text_parts", "written"]


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(columns: list[str], name: str) -> str:
    """``name`` with as many underscores as it takes to differ from all ``columns``, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_parts(batch: pa.RecordBatch, col: int, size: int) -> Iterator[pa.RecordBatch]:
    """Slices with about ``size`` bytes in a column of strings; a text is never cut."""
    upto = np.cumsum(pc.binary_length(batch.column(col)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, end - at)
        at = end
