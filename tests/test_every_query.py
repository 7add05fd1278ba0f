"""Every registered query runs on the smallest tables; those with SQL return its columns."""

from concurrent.futures import ThreadPoolExecutor

import duckdb

import __spark_entry__ as entry
from rillstone import queries as core

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Queries that find nothing on the smallest tables.
EMPTY = {"a11_bias_cube_json", "v03_bias_slice", "v04_bias_cube"}


def test_all_queries_run(spark):
    known, sql = entry.queries(), entry.oracle_sql()

    def run(name: str) -> tuple[str, str | None, list[str]]:
        try:
            out = known[name](spark, SF)
            return name, None if out.limit(1).collect() or name in EMPTY else "no rows", out.columns
        except Exception as error:  # all failures are told together
            return name, repr(error)[:300], []

    with ThreadPoolExecutor(8) as pool:
        results = list(pool.map(run, sorted(core.QUERIES)))
    assert not [(name, error) for name, error, _ in results if error]
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, _, columns in results:
        if name in sql:
            assert sorted(columns) == sorted(c[0] for c in con.sql(f"DESCRIBE {sql[name]}").fetchall()), name
