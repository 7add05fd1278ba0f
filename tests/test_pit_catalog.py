"""The pit catalog: later runs replace units, and its files do not grow with the units."""

from pathlib import Path

from rillstone.sources.catalog import read_pit_catalog, write_pit_catalog

SCHEMA = "unit long, pit int, name string"


def rows_of(spark, path):
    frame = spark.createDataFrame([], SCHEMA)
    return sorted((tuple(r) for r in read_pit_catalog(spark, path, frame.schema).select("unit", "pit", "name").collect()), key=str)


def test_runs_replace_units(spark, tmp_path):
    path = str(tmp_path / "catalog")
    first = [(u, p, "first") for u in [None, *range(400)] for p in range(3)]
    write_pit_catalog(spark.createDataFrame(first, SCHEMA), path, "unit")
    assert len(list(Path(path).rglob("*.parquet"))) < 40  # was one for each unit
    assert rows_of(spark, path) == sorted(first, key=str)
    second = [(u, 7, "second") for u in [None, *range(0, 400, 3), 900]]
    write_pit_catalog(spark.createDataFrame(second, SCHEMA), path, "unit")
    replaced = {u for u, _, _ in second}
    assert rows_of(spark, path) == sorted([x for x in first if x[0] not in replaced] + second, key=str)
    write_pit_catalog(spark.createDataFrame([], SCHEMA), path, "unit")
    assert len(rows_of(spark, path)) == sum(x[0] not in replaced for x in first) + len(second)
    whole = [(u, 1, "third") for u in [None, *range(400), 900]]
    write_pit_catalog(spark.createDataFrame(whole, SCHEMA), path, "unit")
    assert rows_of(spark, path) == sorted(whole, key=str)
    assert len(list(Path(path, "pits").iterdir())) == 1  # runs that nothing reads are gone
