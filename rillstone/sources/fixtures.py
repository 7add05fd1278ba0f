"""Rasters, samples, units and features that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned layers of one grid: a row per vector, a column per component, elevations in millimetres."""
    base = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("r"), F.posexplode("embedding").alias("c", "e"))
    base = base.select("r", F.col("c").cast("long").alias("c"), F.round(F.col("e").cast("double") * 1000).cast("long").alias("z_mm"))
    return base.select(
        "r",
        "c",
        "z_mm",
        (F.col("z_mm") + 20 * F.col("r") + 5 * F.col("c")).alias("zt_mm"),
        F.greatest(F.lit(0), F.least(F.lit(100), 50 - F.floor(F.col("z_mm") / 5.0))).cast("int").alias("swo"),
        F.expr("CASE WHEN z_mm <= -200 THEN 3 WHEN z_mm <= -175 THEN 2 WHEN c >= 60 AND z_mm <= 50 THEN 4 WHEN (r*7 + c*11) % 53 = 0 THEN 5 ELSE 0 END").alias("edm"),
        F.expr("CASE WHEN (r*5 + c*3) % 97 = 0 THEN NULL ELSE CAST((r*13 + c*29) % 101 AS INT) END").alias("tc"),
        F.expr("CAST((r + c) % 31 AS INT)").alias("th"),
    )


LAYERS = """
WITH base AS (
  SELECT vec_id r, unnest(range(len(embedding))) c,
         CAST(round(CAST(unnest(embedding) AS DOUBLE)*1000) AS BIGINT) z_mm FROM embeddings),
layers AS (
  SELECT r, c, z_mm, z_mm + 20*r + 5*c AS zt_mm,
    CAST(greatest(0, least(100, 50 - floor(z_mm/5.0))) AS INT) AS swo,
    CASE WHEN z_mm <= -200 THEN 3 WHEN z_mm <= -175 THEN 2
         WHEN c >= 60 AND z_mm <= 50 THEN 4
         WHEN (r*7 + c*11) % 53 = 0 THEN 5 ELSE 0 END AS edm,
    CASE WHEN (r*5 + c*3) % 97 = 0 THEN NULL ELSE CAST((r*13 + c*29) % 101 AS INT) END AS tc,
    CAST((r + c) % 31 AS INT) AS th FROM base)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences between a surface model and sparse ground heights, with what grows there."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_quantity*2 AS INT) treecover",
        "l_linenumber tree_height_m",
        "CAST(round(l_tax*100) AS INT) slope_smooth",
        "CAST(round(l_discount*10000) AS BIGINT) - CAST(round(l_tax*5000) AS BIGINT) + CAST(l_partkey % 7 AS BIGINT)*100 h_diff_mm",
        "CAST(l_orderkey % 90 AS DOUBLE) lat",
        "CAST(l_suppkey % 180 AS DOUBLE) lon",
    )


SAMPLES = """
WITH samples AS (
  SELECT CAST(l_quantity*2 AS INT) treecover, l_linenumber tree_height_m, CAST(round(l_tax*100) AS INT) slope_smooth,
    CAST(round(l_discount*10000) AS BIGINT) - CAST(round(l_tax*5000) AS BIGINT) + CAST(l_partkey % 7 AS BIGINT)*100 h_diff_mm,
    CAST(l_orderkey % 90 AS DOUBLE) lat, CAST(l_suppkey % 180 AS DOUBLE) lon FROM lineitem)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "CAST(user_id % 64 AS INT) c", "CAST(event_id % 500 AS INT) r", "value")


POINTS = "WITH points AS (SELECT event_id, CAST(user_id % 64 AS INT) c, CAST(event_id % 500 AS INT) r, value FROM events)"


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey unit_id", "n_regionkey parent_id", "n_nationkey % 5 tx", "CAST(floor(n_nationkey/5.0) AS INT) ty",
        "CASE WHEN n_nationkey % 4 = 0 THEN 1 ELSE 0 END coast", "CASE WHEN n_nationkey % 6 = 0 THEN 2 ELSE 0 END endo",
    )


UNITS = """
WITH units AS (
  SELECT n_nationkey unit_id, n_regionkey parent_id, n_nationkey % 5 tx, CAST(floor(n_nationkey/5.0) AS INT) ty,
    CASE WHEN n_nationkey % 4 = 0 THEN 1 ELSE 0 END coast, CASE WHEN n_nationkey % 6 = 0 THEN 2 ELSE 0 END endo FROM nation)"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Water features as rectangles in cell units."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey fid",
        "CASE p_size % 5 WHEN 0 THEN 'river' WHEN 1 THEN 'stream' WHEN 2 THEN 'canal' WHEN 3 THEN 'drain' ELSE 'lake' END fclass",
        "CASE WHEN p_size % 7 = 0 THEN 'wetland' WHEN p_size % 3 = 0 THEN 'water' END natural_",
        "CASE WHEN p_size % 11 = 0 THEN 'reservoir' END landuse",
        "p_name other_tags",
        "p_partkey % 500 r0",
        "p_partkey % 60 c0",
        "p_partkey % 500 + p_size % 9 + 2 r1",
        "p_partkey % 60 + p_size % 4 + 1 c1",
    )


FEATURES = """
WITH features AS (
  SELECT p_partkey fid,
    CASE p_size % 5 WHEN 0 THEN 'river' WHEN 1 THEN 'stream' WHEN 2 THEN 'canal' WHEN 3 THEN 'drain' ELSE 'lake' END fclass,
    CASE WHEN p_size % 7 = 0 THEN 'wetland' WHEN p_size % 3 = 0 THEN 'water' END natural_,
    CASE WHEN p_size % 11 = 0 THEN 'reservoir' END landuse, p_name other_tags,
    p_partkey % 500 r0, p_partkey % 60 c0,
    p_partkey % 500 + p_size % 9 + 2 r1, p_partkey % 60 + p_size % 4 + 1 c1 FROM part)"""


def valley(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Water in a valley, heights in millimetres with the layers' noise: a river that zigzags, a stream down one side, humps
    on both, and reaches where the land lies below the river.  code is the water class."""
    cells = layers(spark, sf_dir).select("r", "c", "z_mm", "swo")
    t = F.pmod("r", F.lit(96))
    off = F.abs(F.col("c") - (12 + F.when(t < 48, t).otherwise(96 - t) * F.lit(0.9)))
    river, bank, stream = off <= 4, off <= 6, F.col("c") == 2
    hump = F.when(F.pmod("r", F.lit(48)).between(12, 34) & (F.pmod(F.floor(F.col("r") / 48), F.lit(4)) != 3), 3000).otherwise(0)
    ridge = F.when(F.pmod("r", F.lit(40)).between(10, 25), 7000).otherwise(0)
    fall, noise = 10_000 - 3 * F.col("r"), F.pmod("z_mm", F.lit(40))
    land = F.when((F.col("c") > 6) & (F.pmod(F.floor(F.col("r") / 96), F.lit(3)) == 2), fall - 2000).otherwise(fall + 15_000)
    z = F.when(river, fall + hump).when(stream, fall + ridge).otherwise(land) + noise
    code = F.when(river & (F.pmod("r", F.lit(192)) > 184), 3).when(river, 4).when(bank, 2).when(stream, 8).otherwise(0)
    return cells.select("r", "c", z.cast("long").alias("z"), "swo", code.cast("int").alias("code"))
