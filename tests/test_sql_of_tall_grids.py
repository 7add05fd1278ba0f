"""Queries and their SQL on a grid with more rows than the smallest tables have."""

import duckdb
import numpy as np
import pytest

from rillstone.queries.registry import QUERIES, SQL

ROWS = 600


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tall"))
    z = np.random.default_rng(8).normal(scale=0.05, size=(ROWS, 64))
    # low ground around a third wall, and a way of 500 cells that winds from the edge through a region
    z[510:545] = -0.5
    z[560:580] = -0.3
    for k in range(9):
        z[561 + 2 * k, 0 if k == 0 else 2 : 62] = 0.1
        z[562 + 2 * k, 61 if k % 2 == 0 else 2] = 0.1
    z[579, 2] = z[579, 61] = -0.3
    spark.createDataFrame([(r, v.tolist()) for r, v in enumerate(z)], "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.mark.parametrize("name", ["b13_add_halo", "d12_close_holes", "h30_noflow_wall"])
def test_query_and_sql_agree(spark, sf, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet/*.parquet'")
    out = QUERIES[name](spark, sf)
    want = con.sql(f"SELECT {', '.join(out.columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)
