"""Paths, samples, features, lookup tables and pit catalogs as sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rillstone.storage import remove


def catalog_files(spark: SparkSession, path: str, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """(path, length, name) of files below path whose path has every string of include and none of exclude; names of over 3 characters."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    files = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).where(F.length("name") > 3)
    for text in include:
        files = files.where(F.col("path").contains(text))
    for text in exclude:
        files = files.where(~F.col("path").contains(text))
    return files


def _holding(tiles: DataFrame, paths: DataFrame, tile: str, path: str) -> DataFrame:
    """Pairs of a tile and a path that names it: paths are cut into their parts, so the join is on equal strings."""
    parts = paths.withColumn("_t", F.explode(F.array_distinct(F.split(path, "[/._?=&:-]+"))))
    return tiles.join(parts, F.col(tile) == F.col("_t")).drop("_t")


def resolve_tile_paths(tiles: DataFrame, paths: DataFrame, tile: str = "tile", path: str = "path", position: str = "pos") -> DataFrame:
    """(tile, path): the first path in list order with the tile's name as one of its parts."""
    return _holding(tiles, paths, tile, path).groupBy(tile).agg(F.min_by(path, position).alias(path))


def resolve_versioned(tiles: DataFrame, paths: DataFrame, prefer: Sequence[str], tile: str = "tile", path: str = "path", position: str = "pos") -> DataFrame:
    """(tile, path): the path with the most preferred mark, then the first in the list."""
    rank = F.lit(len(prefer))
    for i, mark in reversed(list(enumerate(prefer))):
        rank = F.when(F.col(path).contains(mark), i).otherwise(rank)
    ranked = _holding(tiles, paths, tile, path).withColumn("_k", F.row_number().over(Window.partitionBy(tile).orderBy(rank, position)))
    return ranked.where("_k = 1").select(tile, path)


def tag_source(paths: DataFrame, path: str = "path", marks: Sequence[str] = ("TDT", "TDF"), out: str = "source") -> DataFrame:
    """The first mark that a path has, or an empty string."""
    tag = F.lit("")
    for mark in reversed(marks):
        tag = F.when(F.col(path).contains(mark), mark).otherwise(tag)
    return paths.withColumn(out, tag)


def read_samples(samples: DataFrame, columns: Sequence[str], slope: int | None = None, cover: str = "treecover", slope_col: str = "slope_smooth") -> DataFrame:
    """Chosen columns of one slope's samples, without covers of 200 and more; both filters reach the scan."""
    chosen = samples.where(F.col(cover) < 200)
    return (chosen if slope is None else chosen.where(F.col(slope_col) == slope)).select(*columns)


def write_bias_cube(cube: DataFrame, path: str) -> None:
    """One JSON line per slope: a list of rows (cover) of biases by height."""
    rows = cube.groupBy("slope", "tc").agg(F.array_sort(F.collect_list(F.struct("th", "bias"))).alias("v"))
    rows = rows.select("slope", "tc", F.transform("v", lambda x: x["bias"]).alias("v"))
    table = rows.groupBy("slope").agg(F.array_sort(F.collect_list(F.struct("tc", "v"))).alias("m"))
    table.select(F.to_json(F.struct("slope", F.transform("m", lambda x: x["v"]).alias("m"))).alias("value")).write.text(path)


def read_bias_cube(spark: SparkSession, path: str) -> DataFrame:
    """(slope, tc, th, bias) from write_bias_cube's files."""
    lines = spark.read.text(path).select(F.from_json("value", "slope int, m array<array<double>>").alias("j"))
    rows = lines.select("j.slope", F.posexplode("j.m").alias("tc", "v"))
    return rows.select("slope", "tc", F.posexplode("v").alias("th", "bias"))


#: Column that numbers the runs of a pit catalog.
RUN = "catalog_run"


def _runs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the runs in a folder, in order; none if there is no folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(hadoop)] if files.exists(hadoop) else []
    return sorted(int(n.removeprefix(f"{RUN}=")) for n in names if n.startswith(f"{RUN}="))


def write_pit_catalog(solved: DataFrame, path: str, unit: str) -> None:
    """Solved pits as Parquet, a folder for each run; a run replaces the units that it holds.

    Files grow with the rows, not with the units.  They are sorted by unit, so that a filter on it skips most of them, and a unit of
    very many pits is spread over tasks.  A run counts from when its list of units is there; runs none of whose units
    are the newest go.
    """
    spark = solved.sparkSession
    n = max(_runs(spark, f"{path}/pits"), default=0) + 1
    rest = F.xxhash64(*[c for c in solved.columns if c != unit])
    solved.repartitionByRange(F.col(unit), rest).sortWithinPartitions(unit).write.parquet(f"{path}/pits/{RUN}={n}")
    spark.read.schema(solved.schema).parquet(f"{path}/pits/{RUN}={n}").select(unit).distinct().write.parquet(f"{path}/units/{RUN}={n}")
    live = {row[RUN] for row in _newest(spark, path).select(RUN).distinct().collect()}
    for old in _runs(spark, f"{path}/pits"):
        if old != n and old not in live:
            remove(spark, f"{path}/units/{RUN}={old}")
            remove(spark, f"{path}/pits/{RUN}={old}")


def _newest(spark: SparkSession, path: str) -> DataFrame:
    """The last run that holds each unit: the unit's column and RUN."""
    held = spark.read.parquet(f"{path}/units")
    return held.groupBy([c for c in held.columns if c != RUN]).agg(F.max(RUN).alias(RUN))


def read_pit_catalog(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Pits of write_pit_catalog, each unit's of its last run; a filter on the unit reaches the scan."""
    newest = _newest(spark, path)
    unit = newest.columns[0]
    pits = spark.read.schema(StructType([*schema, StructField(RUN, IntegerType())])).parquet(f"{path}/pits")
    newest = newest.select(F.col(unit).alias("_unit"), F.col(RUN).alias("_run"))
    return pits.join(newest, pits[unit].eqNullSafe(newest["_unit"]) & (F.col(RUN) == F.col("_run")), "left_semi").drop(RUN)


def write_features(features: DataFrame, path: str, by: str) -> None:
    """Features as Parquet in a folder for each value of the column by, which a filter on it reads alone.

    A value's rows stay in as many files as tasks hold them, so a frequent value has no task of its own.
    """
    features.write.mode("overwrite").partitionBy(by).parquet(path)


def read_features(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table if where is None else table.where(where)
