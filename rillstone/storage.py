"""Tables that cut lineage: written to the shared folder, so they outlive executors."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folders: dict[str, str] = {}
#: Rows of a table that a join may broadcast, as counted.
LIGHT = 100_000
#: Of each thread: the paths written in the scratch blocks that are open.
_open = threading.local()


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a folder of our own only where it is unset and all runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not (spark.sparkContext.master or "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="spark-")
    return _own_folders[app]


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/rillstone/{tag}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, tag: str, row_group_bytes: int | None = None) -> tuple[DataFrame, str]:
    """Write df as Parquet to the shared folder; return the table read again and its path."""
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    writer = df.write.option("compression", "zstd")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.page.size", 1 << 20)
    writer.parquet(path)
    for paths in getattr(_open, "blocks", [])[-1:]:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, tag: str, row_group_bytes: int | None = None) -> DataFrame:
    """df, computed once and read from the shared folder from now on."""
    return write_table(df, tag, row_group_bytes)[0]


def beside(table: DataFrame) -> DataFrame:
    """A written table as one side of a join: sent to all tasks if its rows are few, else merged, whatever its files' size."""
    return F.broadcast(table) if table.count() <= LIGHT else table.hint("merge")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of ours that no later plan reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """A block whose tables go when it ends; paths taken out of the list that it gives stay (and belong to the block around)."""
    blocks = _open.__dict__.setdefault("blocks", [])
    blocks.append([])
    try:
        yield blocks[-1]
    finally:
        written = blocks.pop()
        for path in written:
            remove(spark, path)


def keep(held: list[str], path: str) -> None:
    """Take a path out of a scratch block; the block around it, if any, holds it from now on."""
    held.remove(path)
    for outer in _open.blocks[-2:-1]:
        outer.append(path)


def clear(spark: SparkSession) -> None:
    """Delete all temporary tables of this library in the shared folder; results that still read them fail from then on."""
    remove(spark, f"{shared_root(spark)}/rillstone")
