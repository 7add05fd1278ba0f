"""Queries of connected components, zones and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import stats as E
from rillstone.operators import zones as D
from rillstone.operators.focal import ring_offsets  # noqa: F401
from rillstone.queries.focal import _round
from rillstone.queries.registry import query
from rillstone.sources.fixtures import FEATURES, LAYERS, features, layers, table

LOW = "z_mm < -60"
ROUNDS = 120


def labels_sql(mask: str, connectivity: int = 8, name: str = "zones", source: str = "layers", rounds: int = ROUNDS, by: str = "") -> str:
    """Common table expressions that label the cells of a mask by their least linear index; by (a column and a comma) keeps groups apart."""
    four = f"least(min(l) OVER (PARTITION BY {by}r ORDER BY c RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING), min(l) OVER (PARTITION BY {by}c ORDER BY r RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)"
    diagonal = f", min(l) OVER (PARTITION BY {by}r - c ORDER BY r RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING), min(l) OVER (PARTITION BY {by}r + c ORDER BY r RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)"
    return f"""{name}_it AS (SELECT 0 AS k, {by}r, c, r * 64 + c AS l FROM {source} WHERE {mask}
      UNION ALL SELECT k + 1, {by}r, c, {four}{diagonal if connectivity == 8 else ""}) FROM {name}_it WHERE k < {rounds}),
    {name} AS (SELECT {by}r, c, l AS zone FROM {name}_it WHERE k = {rounds})"""


Z = f"WITH RECURSIVE {labels_sql(LOW)}"


def low(spark, sf):
    return D.label(layers(spark, sf), F.expr(LOW), 64)


@query("d01_label", Z + " SELECT r, c, zone FROM zones", LAYERS)
def d01(spark, sf):
    return low(spark, sf)


@query("d01_label_4", f"WITH RECURSIVE {labels_sql(LOW, 4)} SELECT r, c, zone FROM zones", LAYERS)
def d01_4(spark, sf):
    return D.label(layers(spark, sf), F.expr(LOW), 64, 4)


@query("d02_clump", f"WITH RECURSIVE {labels_sql(LOW)}, n AS (SELECT zone, row_number() OVER (ORDER BY zone) AS label FROM (SELECT DISTINCT zone FROM zones) q) SELECT r, c, label FROM zones JOIN n USING (zone)", LAYERS)
def d02(spark, sf):
    return D.clump(layers(spark, sf), F.expr(LOW), 64).select("r", "c", F.col("label").cast("long").alias("label"))


@query("d03_zone_size_filter", Z + " SELECT r, c, zone FROM zones WHERE zone IN (SELECT zone FROM zones GROUP BY zone HAVING count(*) BETWEEN 5 AND 50)", LAYERS)
def d03(spark, sf):
    return D.zone_size_filter(low(spark, sf), "zone", 5, 50).select("r", "c", "zone")


@query("d04_drop_zones_touching", Z + " SELECT r, c, zone FROM zones WHERE zone NOT IN (SELECT zone FROM zones WHERE c = 0 OR c = 63)", LAYERS)
def d04(spark, sf):
    return D.drop_zones_touching(low(spark, sf), layers(spark, sf).where("c = 0 or c = 63"), "zone").select("r", "c", "zone")


@query("d05_zones_within", Z + " SELECT r, c, zone FROM zones WHERE zone IN (SELECT zone FROM zones JOIN layers USING (r, c) GROUP BY zone HAVING min(swo) > 65)", LAYERS)
def d05(spark, sf):
    return D.zones_within(low(spark, sf), layers(spark, sf).where("swo > 65"), "zone").select("r", "c", "zone")


@query("d06_zones_intersecting", Z + " SELECT r, c, zone FROM zones WHERE zone IN (SELECT zone FROM zones JOIN layers USING (r, c) WHERE edm = 3)", LAYERS)
def d06(spark, sf):
    return D.zones_intersecting(low(spark, sf), layers(spark, sf).where("edm = 3"), "zone").select("r", "c", "zone")


@query("d07_largest_zone", Z + " SELECT r, c, zone FROM zones WHERE zone = (SELECT zone FROM zones GROUP BY zone ORDER BY count(*) DESC, zone LIMIT 1)", LAYERS)
def d07(spark, sf):
    return D.largest_zone(low(spark, sf), "zone").select("r", "c", "zone")


@query("d08_zone_coverage", Z + " SELECT zone, round(avg(CASE WHEN swo > 80 THEN 1.0 ELSE 0.0 END), 9) AS share FROM zones JOIN layers USING (r, c) GROUP BY zone", LAYERS)
def d08(spark, sf):
    return D.zone_coverage(low(spark, sf), layers(spark, sf).where("swo > 80"), "zone").select("zone", _round("share", 9).alias("share"))


@query("d09_zone_match", f"""
    WITH RECURSIVE {labels_sql(LOW)}, {labels_sql("z_mm < -50", name="fresh")},
    p AS (SELECT z.zone AS old_zone, f.zone AS new_zone, count(*) AS overlap FROM zones z JOIN fresh f USING (r, c) GROUP BY 1, 2 HAVING count(*) >= 8),
    b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY old_zone ORDER BY overlap DESC, new_zone) AS k FROM p) q WHERE k = 1)
    SELECT old_zone, new_zone, overlap FROM b WHERE (SELECT count(*) FROM fresh f WHERE f.zone = b.new_zone) / CAST((SELECT count(*) FROM zones z WHERE z.zone = b.old_zone) AS DOUBLE) BETWEEN 0.5 AND 2.0""", LAYERS)  # fmt: skip
def d09(spark, sf):
    return D.zone_match(low(spark, sf), D.label(layers(spark, sf), F.expr("z_mm < -50"), 64), 8)


@query("d10_zone_outline", Z + """, s AS (SELECT * FROM (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) AS s(i, j))
    SELECT zone, r + i AS r, c + j AS c, r AS ar, c AS ac FROM zones CROSS JOIN s WHERE NOT EXISTS (SELECT 1 FROM zones o WHERE o.zone = zones.zone AND o.r = zones.r + i AND o.c = zones.c + j)""", LAYERS)  # fmt: skip
def d10(spark, sf):
    return D.zone_outline(low(spark, sf), "zone")


def feature_cells(spark, sf, where):
    f = features(spark, sf).where(where)
    return f.select("fid", F.explode(F.sequence("r0", "r1")).alias("r"), "c0", "c1").select("fid", "r", F.explode(F.sequence("c0", "c1")).alias("c"))


FCELLS = "fcells AS (SELECT fid, fclass, a.r, b.c FROM features JOIN range(600) a(r) ON a.r BETWEEN r0 AND r1 JOIN range(70) b(c) ON b.c BETWEEN c0 AND c1)"


@query("d11_dissolve", f"WITH RECURSIVE {FCELLS}, u AS (SELECT DISTINCT r, c FROM fcells WHERE fclass = 'lake'), {labels_sql('true', source='u')} SELECT r, c, zone FROM zones", FEATURES)
def d11(spark, sf):
    return D.dissolve(feature_cells(spark, sf, "fclass = 'lake'"), 64)


@query("d12_close_holes", """
    WITH RECURSIVE rest AS (SELECT r, c FROM layers WHERE z_mm >= -20), k4 AS (SELECT * FROM (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) AS k(i, j)),
    flood AS (SELECT r, c FROM rest WHERE r = 0 OR c = 0 OR c = 63 OR r = (SELECT max(r) FROM layers)
      UNION SELECT rest.r, rest.c FROM flood CROSS JOIN k4 JOIN rest ON rest.r = flood.r + i AND rest.c = flood.c + j)
    SELECT r, c FROM layers EXCEPT SELECT r, c FROM flood""", LAYERS)  # fmt: skip
def d12(spark, sf):
    cells = layers(spark, sf)
    return D.close_holes(cells.where("z_mm < -20"), cells.agg(F.max("r")).first()[0] + 1, 64)


@query("d13_zone_bbox", Z + " SELECT zone, min(r) - 4 AS ra, max(r) + 4 AS rb, min(c) - 4 AS ca, max(c) + 4 AS cb FROM zones GROUP BY zone", LAYERS)
def d13(spark, sf):
    return D.zone_bbox(low(spark, sf), "zone", 4)


BORDER = """, k AS (SELECT i, j FROM range(-1, 2) a(i), range(-1, 2) b(j) WHERE i <> 0 OR j <> 0),
    ring AS (SELECT DISTINCT zone, r + i AS r, c + j AS c FROM zones CROSS JOIN k WHERE NOT EXISTS (SELECT 1 FROM zones o WHERE o.zone = zones.zone AND o.r = zones.r + i AND o.c = zones.c + j))"""


@query("d14_zone_border", Z + BORDER + " SELECT zone, count(*) AS cells, count(*) FILTER (WHERE swo > 60) AS wet FROM ring JOIN layers USING (r, c) GROUP BY zone", LAYERS)
def d14(spark, sf):
    ring = D.zone_border(low(spark, sf), "zone").join(layers(spark, sf), ["r", "c"])
    return ring.groupBy("zone").agg(F.count("*").alias("cells"), F.count_if(F.col("swo") > 60).alias("wet"))


@query("d15_border_parts", Z + BORDER + """, wet AS (SELECT zone AS z, r, c FROM ring JOIN layers USING (r, c) WHERE swo > 55),
    parts_it AS (SELECT 0 AS k, z, r, c, r * 64 + c AS l FROM wet UNION ALL SELECT k + 1, z, r, c,
      least(min(l) OVER (PARTITION BY z, r ORDER BY c RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING), min(l) OVER (PARTITION BY z, c ORDER BY r RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING),
            min(l) OVER (PARTITION BY z, r - c ORDER BY r RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING), min(l) OVER (PARTITION BY z, r + c ORDER BY r RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)) FROM parts_it WHERE k < 60)
    SELECT a.zone, count(DISTINCT p.l) AS parts FROM (SELECT DISTINCT zone FROM zones) a LEFT JOIN parts_it p ON p.z = a.zone AND p.k = 60 GROUP BY a.zone""", LAYERS)  # fmt: skip
def d15(spark, sf):
    cells = layers(spark, sf)
    return D.border_parts(low(spark, sf), "zone", cells.where("swo > 55"), cells.agg(F.max("r")).first()[0] + 1, 64)


@query("m05_component_rank", Z + " SELECT zone, dense_rank() OVER (ORDER BY zone) AS label, count(*) AS n FROM zones GROUP BY zone", LAYERS)
def m05(spark, sf):
    out = D.dense_labels(low(spark, sf)).groupBy("zone", "label").agg(F.count("*").alias("n"))
    return out.select("zone", F.col("label").cast("long").alias("label"), "n")


@query("e01_zonal_stats", Z + " SELECT zone, min(z_mm) AS lo, max(z_mm) AS hi, round(avg(z_mm), 6) AS mean, CAST(sum(z_mm) AS BIGINT) AS total, count(*) AS n FROM zones JOIN layers USING (r, c) GROUP BY zone", LAYERS)
def e01(spark, sf):
    out = E.zonal_stats(low(spark, sf).join(layers(spark, sf), ["r", "c"]), "zone", "z_mm")
    return out.select("zone", "lo", "hi", _round("mean", 6).alias("mean"), "total", "n")


@query("e02_masked_percentile", "SELECT round(quantile_cont(z_mm, 0.01), 6) AS p1, round(quantile_cont(z_mm, 0.1), 6) AS p10, round(quantile_cont(z_mm, 0.99), 6) AS p99 FROM layers WHERE swo > 40", LAYERS)
def e02(spark, sf):
    out = E.masked_percentiles(layers(spark, sf), "z_mm", F.col("swo") > 40, [1, 10, 99])
    return out.select(*[_round(p, 6).alias(p) for p in ("p1", "p10", "p99")])


@query("e03_zonal_percentile", "SELECT edm, round(quantile_cont(z_mm, 0.25), 6) AS p FROM layers GROUP BY edm", LAYERS)
def e03(spark, sf):
    return E.zonal_percentile(layers(spark, sf), "edm", "z_mm", 25).select("edm", _round("p", 6).alias("p"))


@query("e04_grid_std", "SELECT round(stddev_pop(z_mm), 6) AS std FROM layers", LAYERS)
def e04(spark, sf):
    return E.grid_std(layers(spark, sf), "z_mm").select(_round("std", 6).alias("std"))


@query("e07_value_counts", "SELECT CAST(round(z_mm / 10.0) AS BIGINT) AS value, count(*) AS n FROM layers GROUP BY 1 HAVING count(*) > 100", LAYERS)
def e07(spark, sf):
    return E.value_counts(layers(spark, sf), F.round(F.col("z_mm") / 10.0).cast("long"))


@query("e09_class_share", "SELECT edm, round(avg(CASE WHEN swo > 80 THEN 1.0 ELSE 0.0 END), 9) AS share, count(*) FILTER (WHERE swo > 80) AS n FROM layers GROUP BY edm", LAYERS)
def e09(spark, sf):
    return E.class_share(layers(spark, sf), F.col("swo") > 80, ["edm"]).select("edm", _round("share", 9).alias("share"), "n")


@query("e10_height_steps", """
    WITH b AS (SELECT edm, min(zt_mm) AS lo, max(zt_mm) AS hi FROM layers GROUP BY edm),
    s AS (SELECT *, CASE WHEN hi - lo >= 250000 THEN 10000 WHEN hi - lo >= 100000 THEN 5000 WHEN hi - lo >= 50000 THEN 2000 WHEN hi - lo >= 25000 THEN 1000 ELSE 500 END AS step FROM b)
    SELECT edm, step, lo + k * step AS h FROM s JOIN range(1000) a(k) ON lo + k * step <= hi""", LAYERS)  # fmt: skip
def e10(spark, sf):
    bounds = layers(spark, sf).groupBy("edm").agg(F.min("zt_mm").alias("lo"), F.max("zt_mm").alias("hi"))
    return E.height_steps(bounds, "lo", "hi").select("edm", "step", "h")


@query("e11_distinct_ids", "SELECT count(DISTINCT edm) AS classes, count(DISTINCT th) AS heights, count(DISTINCT tc) AS covers FROM layers", LAYERS)
def e11(spark, sf):
    return layers(spark, sf).agg(F.count_distinct("edm").alias("classes"), F.count_distinct("th").alias("heights"), F.count_distinct("tc").alias("covers"))


@query("e12_arg_extreme", """
    SELECT edm, min(r * 64 + c) FILTER (WHERE z_mm = hi) AS at_max, min(r * 64 + c) FILTER (WHERE z_mm = lo) AS at_min
    FROM (SELECT *, max(z_mm) OVER (PARTITION BY edm) AS hi, min(z_mm) OVER (PARTITION BY edm) AS lo FROM layers) q GROUP BY edm""", LAYERS)  # fmt: skip
def e12(spark, sf):
    return E.arg_extreme(layers(spark, sf).withColumn("i", F.expr("r * 64 + c")), "edm", "z_mm", "i")


@query("e13_dissolve_attr", "SELECT fclass, array_to_string(list_sort(list(DISTINCT natural_)), ',') AS natural_, count(*) AS n FROM features GROUP BY fclass", FEATURES)
def e13(spark, sf):
    out = E.dissolve_attr(features(spark, sf), "fclass", ["natural_", "fid"])
    return out.select("fclass", F.array_join("natural_", ",").alias("natural_"), F.size("fid").cast("long").alias("n"))


@query("m04_sequential_id", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS id FROM events")
def m04(spark, sf):
    from rillstone.operators.spatial import sequential_id

    return sequential_id(table(spark, sf, "events").select("event_id", "ts"), ["ts", "event_id"], "id").select("event_id", "id")
