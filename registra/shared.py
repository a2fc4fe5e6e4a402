"""The folder that driver and executors share, tables written there to cut lineage, and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a side table that may be broadcast; each user states the bytes of a row, about 100 at most.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder of its own; on a cluster that is an error, as executors
    elsewhere could not read it.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="registra-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/registra-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``written`` or ``fresh_path`` made."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_written(df: DataFrame) -> None:
    """Delete the files behind a table made by ``written``."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)


def small_or_shuffled(side: DataFrame, rows: int | None = None) -> DataFrame:
    """``side`` with a broadcast hint if it has at most BROADCAST_ROWS rows, else as it is.

    ``side`` must be cheap to count, such as a written table; beyond the bound Spark shuffles both sides
    and splits skewed partitions.
    """
    n = side.count() if rows is None else rows
    return F.broadcast(side) if n <= BROADCAST_ROWS else side
