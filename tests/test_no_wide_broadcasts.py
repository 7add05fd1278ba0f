"""Joins of tables that grow with the grid: no side of them is collected by the driver, however small its files are."""

from rillstone.operators.components import star_components
from rillstone.queries import hydro

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_pit_catalog_broadcasts_no_cells(spark):
    plan = plan_of(hydro._catalog(spark, SF))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_pits_meet_cells_by_merge(spark):
    cells, pits = hydro.pit_tables(spark, SF)
    for out in (hydro.bottoms_of(cells, pits), hydro.I.fill_shallow(cells, pits, 40), hydro.I.fill_behind(cells, cells.selectExpr("r", "c", "z AS value"), pits, 64)[1]):
        assert "SortMergeJoin" in plan_of(out) and "Broadcast" not in plan_of(out)


def test_many_labels_are_merged(spark):
    edges = spark.range(200_000).selectExpr("2 * id AS a", "2 * id + 1 AS b")
    found = star_components(edges, few=500_000)
    out = edges.join(found.withColumnRenamed("node", "b"), "b", "left")
    assert "SortMergeJoin" in plan_of(out) and "Broadcast" not in plan_of(out)
    assert out.where("component <> a").count() == 0
