"""Queries on a grid with more rows than the smallest tables have."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.queries.registry import QUERIES

ROWS = 520


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tall"))
    rng = np.random.default_rng(5)
    z = rng.normal(scale=0.05, size=(ROWS, 64))
    z[ROWS - 3 :, 20:30] = -0.5
    spark.createDataFrame([(r, v.tolist()) for r, v in enumerate(z)], "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    spark.createDataFrame([(495, 39, "lake"), (498, 8, "drain")], "p_partkey long, p_size int, p_name string").write.parquet(f"{path}/part.parquet")
    return path


def last_row(spark, sf, name):
    return QUERIES[name](spark, sf).agg(F.max("r")).first()[0]


def test_row_counts_follow_the_layers(spark, sf):
    assert last_row(spark, sf, "b09_clip_window") == ROWS - 1
    assert last_row(spark, sf, "b12_trim_halo") == ROWS - 6
    assert last_row(spark, sf, "b20_realign_shifted") == ROWS - 2
    assert last_row(spark, sf, "p08_rasterize") == 507


def test_lakes_below_row_500_count(spark, sf):
    assert {r for (r,) in QUERIES["h06_large_lakes"](spark, sf).select("r").collect()} >= set(range(495, 501))
