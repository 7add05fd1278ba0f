"""Queries of samples, bias, spatial joins, hierarchies, set operations and catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import bias as V
from rillstone.operators import focal as K
from rillstone.operators import spatial as S
from rillstone.operators import stats as E
from rillstone.queries.focal import _round
from rillstone.queries.registry import query
from rillstone.queries.zones import FCELLS, feature_cells, low
from rillstone.sources import catalog as A
from rillstone.sources.fixtures import FEATURES, LAYERS, POINTS, SAMPLES, UNITS, features, layers, points, samples, table, units
from rillstone.storage import new_path

# samples and bias


@query("a09_read_samples", "SELECT treecover, tree_height_m, h_diff_mm FROM samples WHERE slope_smooth = 3 AND treecover < 200", SAMPLES)
def a09(spark, sf):
    return A.read_samples(samples(spark, sf), ["treecover", "tree_height_m", "h_diff_mm"], 3)


@query("e05_lookup_mean_std_count", "SELECT treecover, tree_height_m, round(avg(h_diff_mm), 6) AS mean, round(stddev_samp(h_diff_mm), 6) AS std, count(*) AS n FROM samples GROUP BY 1, 2 HAVING count(*) > 30", SAMPLES)
def e05(spark, sf):
    out = E.lookup_mean_std_count(samples(spark, sf), ["treecover", "tree_height_m"], "h_diff_mm", 30)
    return out.select("treecover", "tree_height_m", _round("mean", 6).alias("mean"), _round("std", 6).alias("std"), "n")


@query("e06_pivot_table", "SELECT treecover, " + ", ".join(f"round(avg(h_diff_mm) FILTER (WHERE tree_height_m = {h}), 6) AS h{h}" for h in range(1, 8)) + " FROM samples GROUP BY treecover", SAMPLES)
def e06(spark, sf):
    means = E.lookup_mean_std_count(samples(spark, sf), ["treecover", "tree_height_m"], "h_diff_mm")
    wide = E.pivot_table(means, "treecover", "tree_height_m", "mean", list(range(1, 8)))
    return wide.select("treecover", *[_round(str(h), 6).alias(f"h{h}") for h in range(1, 8)])


@query("v01_prep_samples", """
    WITH f AS (SELECT * FROM samples WHERE h_diff_mm > -200 AND lat BETWEEN 10 AND 80)
    SELECT treecover, slope_smooth, count(*) AS n, CAST(sum(h_diff_mm) AS BIGINT) AS total FROM f
    WHERE h_diff_mm BETWEEN (SELECT quantile_cont(h_diff_mm, 0.05) FROM f) AND (SELECT quantile_cont(h_diff_mm, 0.99) FROM f) GROUP BY 1, 2""", SAMPLES)  # fmt: skip
def v01(spark, sf):
    kept = V.prep_samples(samples(spark, sf), "h_diff_mm", floor=-200, box={"lat": (10, 80)})
    return kept.groupBy("treecover", "slope_smooth").agg(F.count("*").alias("n"), F.sum("h_diff_mm").alias("total"))


@query("v02_sample_files")
def v02(spark, sf):
    return V.sample_files(table(spark, sf, "pages").select("url"), "url", 100, seed=3)


def bias_samples(spark, sf):
    return samples(spark, sf).select(F.col("slope_smooth").alias("slope"), F.col("treecover").alias("tc"), F.col("tree_height_m").alias("th"), F.col("h_diff_mm"))


SLICE = """
    means AS (SELECT slope_smooth AS slope, treecover AS mt, tree_height_m AS mh, avg(h_diff_mm) AS mean FROM samples GROUP BY 1, 2, 3 HAVING count(*) > 10),
    grid AS (SELECT slope, a.tc, b.th FROM (SELECT DISTINCT slope FROM means) s CROSS JOIN range(101) a(tc) CROSS JOIN range(31) b(th)),
    near AS (SELECT g.slope, tc, th, arg_min(mean, (tc - mt) * (tc - mt) + (th - mh) * (th - mh) + mt * 1e-6 + mh * 1e-10) AS b FROM grid g JOIN means m ON g.slope = m.slope GROUP BY 1, 2, 3),
    zero AS (SELECT slope, tc, th, CASE WHEN tc < 10 OR th = 0 THEN 0.0 ELSE b END AS b FROM near),
    tall AS (SELECT * FROM zero UNION ALL SELECT slope, -1, th, b FROM zero WHERE tc = 0 UNION ALL SELECT slope, 101, th, b FROM zero WHERE tc = 100),
    full_ AS (SELECT * FROM tall UNION ALL SELECT slope, tc, -1, b FROM tall WHERE th = 0 UNION ALL SELECT slope, tc, 31, b FROM tall WHERE th = 30),
    cube AS (SELECT z.slope, z.tc, z.th, CASE WHEN z.tc < 10 OR z.th = 0 THEN 0.0 ELSE sum(f.b * CASE WHEN f.tc = z.tc AND f.th = z.th THEN 1.0 ELSE 0.5 END) / 5.0 END AS bias
             FROM zero z JOIN full_ f ON f.slope = z.slope AND f.tc BETWEEN z.tc - 1 AND z.tc + 1 AND f.th BETWEEN z.th - 1 AND z.th + 1 GROUP BY z.slope, z.tc, z.th)"""


def cube(spark, sf):
    return V.bias_slice(bias_samples(spark, sf), "h_diff_mm", n_cutoff=10)


@query("v03_bias_slice", f"WITH {SLICE} SELECT slope, tc, th, round(bias, 4) + 0.0 AS bias FROM cube", SAMPLES)
def v03(spark, sf):
    return cube(spark, sf).select("slope", F.col("tc").cast("long").alias("tc"), F.col("th").cast("long").alias("th"), _round("bias", 4).alias("bias"))


def _axis(source: str, axis: str, top: int, name: str) -> str:
    others = [a for a in ("slope", "tc", "th") if a != axis]
    o = ", ".join(others)
    pad = f"{name}p AS (SELECT slope, tc, th, bias FROM {source} UNION ALL SELECT {o}, -1 AS {axis}, bias FROM {source} WHERE {axis} = 0 UNION ALL SELECT {o}, {top + 1} AS {axis}, bias FROM {source} WHERE {axis} = {top})"
    pad = f"{name}p AS (SELECT slope, tc, th, bias FROM {source} UNION ALL BY NAME SELECT {o}, -1 AS {axis}, bias FROM {source} WHERE {axis} = 0 UNION ALL BY NAME SELECT {o}, {top + 1} AS {axis}, bias FROM {source} WHERE {axis} = {top})"
    return f"{pad}, {name} AS (SELECT s.slope, s.tc, s.th, sum(p.bias * CASE WHEN p.{axis} = s.{axis} THEN 0.5 ELSE 0.25 END) AS bias FROM {source} s JOIN {name}p p ON " + " AND ".join(f"p.{x} = s.{x}" for x in others) + f" AND p.{axis} BETWEEN s.{axis} - 1 AND s.{axis} + 1 GROUP BY s.slope, s.tc, s.th)"


@query("v04_bias_cube", f"WITH {SLICE}, {_axis('cube', 'slope', 8, 'c1')}, {_axis('c1', 'tc', 100, 'c2')}, {_axis('c2', 'th', 30, 'c3')} SELECT slope, tc, th, round(bias, 4) + 0.0 AS bias FROM c3", SAMPLES)
def v04(spark, sf):
    out = V.bias_cube(cube(spark, sf), 9, 101, 31, smooth_axes=True)
    return out.select("slope", F.col("tc").cast("long").alias("tc"), F.col("th").cast("long").alias("th"), _round("bias", 4).alias("bias"))


@query("a11_bias_cube_json", f"WITH {SLICE} SELECT slope, tc, th, round(bias, 4) + 0.0 AS bias FROM cube", SAMPLES)
def a11(spark, sf):
    path = new_path(spark, "cube")
    A.write_bias_cube(cube(spark, sf), path)
    return A.read_bias_cube(spark, path).select("slope", F.col("tc").cast("long").alias("tc"), F.col("th").cast("long").alias("th"), _round("bias", 4).alias("bias"))


@query("v06_apply_bias_2d", """
    WITH t AS (SELECT slope_smooth * 10 AS slope, treecover AS tc, avg(h_diff_mm) AS bias FROM samples WHERE slope_smooth * 10 <= 50 GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice - coalesce(t.bias, 0), 4) + 0.0 AS corrected
    FROM lineitem LEFT JOIN t ON t.slope = least(50, CAST(round(l_tax*100) AS INT) * 10) AND t.tc = CAST(l_quantity*2 AS INT)""", SAMPLES)  # fmt: skip
def v06(spark, sf):
    lookup = bias_samples(spark, sf).groupBy((F.col("slope") * 10).alias("slope"), "tc").agg(F.avg("h_diff_mm").alias("bias")).withColumn("lc", F.lit(999))
    cells = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "CAST(round(l_tax*100) AS INT) * 10 slope", "CAST(l_quantity*2 AS INT) tc")
    return V.apply_bias_2d(cells, lookup, "l_extendedprice").select("l_orderkey", "l_linenumber", "l_partkey", _round("corrected", 4).alias("corrected"))


@query("v07_apply_bias_poly", """
    SELECT r, c, round(z_mm - (0.03789534968886686 + 0.1395174341829395 * coalesce(tc, 0) - 0.019562663304545865 * th - 0.005218094300390786 * coalesce(tc, 0) * coalesce(tc, 0)
      + 0.0015878676683811661 * coalesce(tc, 0) * th + 0.0050266251217852215 * th * th), 6) + 0.0 AS corrected FROM layers""", LAYERS)  # fmt: skip
def v07(spark, sf):
    cells = layers(spark, sf).withColumn("tc", F.coalesce("tc", F.lit(0)).cast("double")).withColumn("th", F.col("th").cast("double"))
    return V.apply_bias_poly(cells, "z_mm", "tc", "th").select("r", "c", _round("corrected", 6).alias("corrected"))


@query("v08_bias_in_cm", "SELECT treecover, CAST(round(avg(h_diff_mm) / 1000.0 * 100) AS INT) AS bias_cm FROM samples GROUP BY treecover", SAMPLES)
def v08(spark, sf):
    means = samples(spark, sf).groupBy("treecover").agg((F.avg("h_diff_mm") / 1000.0).alias("bias"))
    return V.bias_in_cm(means).select("treecover", "bias_cm")


# joins and hierarchies


def unit_boxes(spark, sf):
    return units(spark, sf).select("unit_id", "parent_id", F.col("tx").alias("xmin"), F.col("ty").alias("ymin"), (F.col("tx") + 1).alias("xmax"), (F.col("ty") + 1).alias("ymax"))


def feature_boxes(spark, sf):
    return features(spark, sf).select("fid", "fclass", F.col("c0").alias("xmin"), F.col("r0").alias("ymin"), F.col("c1").alias("xmax"), F.col("r1").alias("ymax"))


@query("f01_select_tiles", "SELECT DISTINCT u.unit_id AS tile FROM units u JOIN units a ON a.endo = 2 WHERE u.tx <= a.tx + 1.001 AND u.tx + 1 >= a.tx - 0.001 AND u.ty <= a.ty + 1.001 AND u.ty + 1 >= a.ty - 0.001", UNITS)
def f01(spark, sf):
    boxes = unit_boxes(spark, sf)
    aoi = boxes.join(units(spark, sf).where("endo = 2").select("unit_id"), "unit_id", "left_semi")
    return S.select_tiles(boxes.withColumnRenamed("unit_id", "tile").drop("parent_id"), aoi, ring=0.001)


@query("f02_region_from_id", "SELECT c_custkey, CASE substr(CAST(c_custkey AS VARCHAR), 1, 1) WHEN '1' THEN 'af' WHEN '2' THEN 'eu' WHEN '3' THEN 'si' WHEN '4' THEN 'as' WHEN '5' THEN 'au' END AS region FROM customer")
def f02(spark, sf):
    return S.region_from_id(table(spark, sf, "customer").select("c_custkey"), "c_custkey", {"1": "af", "2": "eu", "3": "si", "4": "as", "5": "au"})


@query("f03_clip_features", "SELECT DISTINCT f.fid FROM features f JOIN features k ON k.fclass = 'river' AND f.fclass <> 'river' AND f.c0 >= k.c0 AND f.c1 <= k.c1 AND f.r0 >= k.r0 AND f.r1 <= k.r1", FEATURES)
def f03(spark, sf):
    boxes = feature_boxes(spark, sf)
    return S.clip_features(boxes.where("fclass <> 'river'"), boxes.where("fclass = 'river'"), "within", 8.0).select("fid")


RING = "array(struct(c0 x1, r0 y1, c1 x2, r0 y2), struct(c1 x1, r0 y1, c1 x2, r1 y2), struct(c1 x1, r1 y1, c0 x2, r1 y2), struct(c0 x1, r1 y1, c0 x2, r0 y2))"


def feature_segments(spark, sf):
    return features(spark, sf).select("fid", F.explode(F.expr(RING)).alias("s")).select("fid", *[F.col(f"s.{x}").cast("double").alias(x) for x in ("x1", "y1", "x2", "y2")])


@query("f04_points_in_polygons", "SELECT event_id, fid FROM points JOIN features ON c + 0.5 > c0 AND c + 0.5 < c1 AND r + 0.5 > r0 AND r + 0.5 < r1", POINTS + "," + FEATURES.strip()[4:])
def f04(spark, sf):
    at = points(spark, sf).select("event_id", (F.col("c") + 0.5).alias("x"), (F.col("r") + 0.5).alias("y"))
    return S.points_in_polygons(at, feature_segments(spark, sf), "event_id", "fid")


def basin_tables(spark, sf):
    top = table(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("unit"), F.lit(None).cast("long").alias("parent"))
    customers = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("area"))
    middle = units(spark, sf).select((F.col("unit_id") + 100).cast("long").alias("unit"), F.col("parent_id").cast("long").alias("parent"), "unit_id").join(customers, F.col("unit_id") == F.col("c_nationkey")).select("unit", "parent", "area")
    top = top.join(middle.groupBy("parent").agg(F.sum("area").alias("area")).withColumnRenamed("parent", "unit"), "unit").select("unit", "parent", "area")
    low_ = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1000).cast("long").alias("unit"), (F.col("s_nationkey") + 100).cast("long").alias("parent"), F.lit(1).cast("long").alias("area"))
    return [top, middle, low_]


BASINS = """
WITH middle AS (SELECT CAST(n_nationkey + 100 AS BIGINT) AS unit, CAST(n_regionkey AS BIGINT) AS parent, count(*) AS area FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2),
top AS (SELECT CAST(r_regionkey AS BIGINT) AS unit, CAST(sum(area) AS BIGINT) AS area FROM region JOIN middle ON parent = r_regionkey GROUP BY 1),
low AS (SELECT CAST(s_suppkey + 1000 AS BIGINT) AS unit, CAST(s_nationkey + 100 AS BIGINT) AS parent, CAST(1 AS BIGINT) AS area FROM supplier)"""


def _levels(limit: str) -> str:
    return f"""
    WITH s0 AS (SELECT t.unit FROM top t WHERE area > {limit} AND EXISTS (SELECT 1 FROM middle m WHERE m.parent = t.unit)),
    m1 AS (SELECT * FROM middle WHERE parent IN (SELECT unit FROM s0)),
    s1 AS (SELECT m.unit FROM m1 m WHERE area > {limit} AND EXISTS (SELECT 1 FROM low l WHERE l.parent = m.unit))
    SELECT unit, area, 0 AS level FROM top WHERE unit NOT IN (SELECT unit FROM s0)
    UNION ALL SELECT unit, area, 1 FROM m1 WHERE unit NOT IN (SELECT unit FROM s1)
    UNION ALL SELECT unit, area, 2 FROM low WHERE parent IN (SELECT unit FROM s1)"""


@query("f05_basin_levels", _levels("60"), BASINS)
def f05(spark, sf):
    return S.basin_levels(basin_tables(spark, sf), 60)


@query("f06_basin_single", "SELECT unit, area FROM middle WHERE parent = 2", BASINS)
def f06(spark, sf):
    return basin_tables(spark, sf)[1].where("parent = 2").select("unit", "area")


@query("f07_coverage_check", """
    WITH done AS (SELECT unit FROM middle WHERE parent <> 3 AND unit % 3 <> 0), missing AS (SELECT * FROM middle WHERE unit NOT IN (SELECT unit FROM done)),
    whole AS (SELECT parent FROM middle GROUP BY parent HAVING count(*) = count(*) FILTER (WHERE unit NOT IN (SELECT unit FROM done)))
    SELECT unit, 'child' AS level FROM missing WHERE parent NOT IN (SELECT parent FROM whole) UNION ALL SELECT parent, 'parent' FROM whole""", BASINS)  # fmt: skip
def f07(spark, sf):
    middle = basin_tables(spark, sf)[1]
    return S.coverage_check(middle, middle.where("parent <> 3 and unit % 3 <> 0"))


def status(spark, sf):
    return table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("unit_id"), F.lit("DEM").alias("artifact"))


@query("f08_unfinished", "SELECT o_orderkey AS unit_id FROM orders WHERE o_orderstatus <> 'F'")
def f08(spark, sf):
    return S.unfinished(table(spark, sf, "orders").select(F.col("o_orderkey").alias("unit_id")), status(spark, sf), "DEM")


@query("f08_finished", "SELECT o_orderkey AS unit_id FROM orders WHERE o_orderstatus = 'F'")
def f08_finished(spark, sf):
    return S.finished(table(spark, sf, "orders").select(F.col("o_orderkey").alias("unit_id")), status(spark, sf), "DEM")


@query("f18_resplit_unfinished", _levels("20").replace("FROM top", "FROM rest").replace("SELECT t.unit FROM rest t", "SELECT t.unit FROM rest t").replace("WITH s0", "WITH rest AS (SELECT * FROM top WHERE unit % 2 = 1), s0"), BASINS)
def f18(spark, sf):
    levels = basin_tables(spark, sf)
    return S.resplit_unfinished(levels, levels[0].where("unit % 2 = 0"), 20)


_SIDES = ", ".join(f"('{s}', {i}, {dx}, {dy})" for i, (s, (dx, dy)) in enumerate(S.SIDES.items()))


@query("f09_neighbours8", f"SELECT a.unit_id, k.side, k.position, b.unit_id AS neighbour FROM units a CROSS JOIN (VALUES {_SIDES}) AS k(side, position, dx, dy) JOIN units b ON b.tx = a.tx + k.dx AND b.ty = a.ty + k.dy", UNITS)
def f09(spark, sf):
    return S.neighbours8(units(spark, sf), "unit_id", "tx", "ty")


def known_points(spark, sf):
    p = points(spark, sf).where("event_id % 3 = 0").groupBy("r", "c").agg(F.min("event_id").alias("pid"), F.max("value").alias("z"))
    return p.select("pid", F.col("c").cast("double").alias("x"), F.col("r").cast("double").alias("y"), "z")


KNOWN = POINTS + """, known AS (SELECT min(event_id) AS pid, CAST(c AS DOUBLE) AS x, CAST(r AS DOUBLE) AS y, max(value) AS z FROM points WHERE event_id % 3 = 0 GROUP BY r, c),
    q AS (SELECT p_partkey AS qid, p_partkey % 60 + 0.3 AS x, p_partkey % 500 + 0.6 AS y FROM part),
    d AS (SELECT qid, pid, z, sqrt((q.x - k.x) * (q.x - k.x) + (q.y - k.y) * (q.y - k.y)) AS d FROM q CROSS JOIN known k),
    near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, pid) AS rank FROM d) s WHERE rank <= 4)"""  # fmt: skip


def part_queries(spark, sf):
    return table(spark, sf, "part").selectExpr("p_partkey qid", "p_partkey % 60 + 0.3D AS x", "p_partkey % 500 + 0.6D AS y")


@query("f10_knn_idw", "SELECT qid, round(CASE WHEN max(d) > 30 THEN -999.0 ELSE sum(z / (d * d)) / sum(1 / (d * d)) END, 5) + 0.0 AS value FROM near GROUP BY qid", KNOWN)
def f10(spark, sf):
    return S.knn_idw(known_points(spark, sf), part_queries(spark, sf), 4, 2.0, 6.0, 30.0).select("qid", _round("value", 5).alias("value"))


@query("l03_top_k_nearest", "SELECT qid, pid, rank FROM near", KNOWN)
def l03(spark, sf):
    return S.nearest_points(known_points(spark, sf), part_queries(spark, sf), 4, 6.0).select("qid", "pid", F.col("rank").cast("long").alias("rank"))


@query("f11_bilinear_points", """
    SELECT p_partkey AS qid, round(CASE WHEN p_size % 10 > 8 THEN NULL ELSE
      (1 - u) * (1 - v) * p_size + (1 - u) * v * (p_size + 3) + u * (1 - v) * (p_size + 5) + u * v * (p_size + 11) END, 6) + 0.0 AS value
    FROM (SELECT *, (p_size % 10) / 8.0 AS u, (p_partkey % 7) / 7.0 AS v FROM part) p""")  # fmt: skip
def f11(spark, sf):
    corner = F.explode(F.expr("array(struct(4 x, 7 y, p_size + 11 z), struct(0 x, 7 y, p_size + 3 z), struct(4 x, 0 y, p_size + 5 z), struct(0 x, 0 y, p_size z))"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("qid"), ((F.col("p_size") % 10) / 2.0).alias("px"), (F.col("p_partkey") % 7).cast("double").alias("py"), corner.alias("k"))
    return S.bilinear_points(p.select("qid", "px", "py", "k.x", "k.y", "k.z")).select("qid", _round("value", 6).alias("value"))


@query("f12_nearest_fill", """
    WITH v AS (SELECT r, c, CASE WHEN edm <> 5 THEN z_mm END AS z FROM layers),
    n AS (SELECT a.r, a.c, b.z, row_number() OVER (PARTITION BY a.r, a.c ORDER BY (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c), b.r, b.c) AS k
          FROM v a JOIN v b ON a.z IS NULL AND b.z IS NOT NULL AND b.r BETWEEN a.r - 4 AND a.r + 4 AND b.c BETWEEN a.c - 4 AND a.c + 4)
    SELECT v.r, v.c, coalesce(v.z, n.z) AS z FROM v LEFT JOIN n ON v.r = n.r AND v.c = n.c AND n.k = 1""", LAYERS)  # fmt: skip
def f12(spark, sf):
    return S.nearest_fill(layers(spark, sf).select("r", "c", F.when(F.col("edm") != 5, F.col("z_mm")).alias("z")), "z").select("r", "c", "z")


@query("f13_nearest_member", """
    WITH m AS (SELECT event_id, user_id % 40 AS g, c, r, avg(c) OVER (PARTITION BY user_id % 40) AS x, avg(r) OVER (PARTITION BY user_id % 40) AS y FROM (SELECT p.*, e.user_id FROM points p JOIN events e USING (event_id)) s)
    SELECT g, event_id FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY round((c - x) * (c - x) + (r - y) * (r - y), 9), event_id) AS k FROM m) q WHERE k = 1""", POINTS)  # fmt: skip
def f13(spark, sf):
    e = table(spark, sf, "events").selectExpr("event_id", "user_id % 40 AS g", "CAST(user_id % 64 AS DOUBLE) AS x", "CAST(event_id % 500 AS DOUBLE) AS y")
    return S.nearest_member(e, "g", "event_id")


RANKS = {1: 6, 2: 5, 3: 13, 4: 4, 5: 3, 6: 2, 7: 1, 8: 9, 9: 10, 10: 11, 11: 14, 12: 12, 13: 7, 14: 8, 15: 15}


@query("f14_overlap_min", f"""
    WITH u AS (SELECT r, c, z_mm AS z, edm AS m FROM layers WHERE r < 255 UNION ALL SELECT r, c, z_mm - (c % 3) + 1, (edm + c) % 8 FROM layers WHERE r >= 245),
    k AS (SELECT *, coalesce(w, 99) AS rank FROM u LEFT JOIN (VALUES {", ".join(f"({a}, {b})" for a, b in RANKS.items())}) AS v(code, w) ON code = m)
    SELECT r, c, min(z) AS z, arg_min(m, rank * 100 + m) AS m, count(*) AS units FROM k GROUP BY r, c HAVING count(*) >= 2""", LAYERS)  # fmt: skip
def f14(spark, sf):
    cells = layers(spark, sf)
    a = cells.where("r < 255").select("r", "c", F.col("z_mm").alias("z"), F.col("edm").cast("long").alias("m"))
    b = cells.where("r >= 245").select("r", "c", F.expr("z_mm - (c % 3) + 1").alias("z"), F.expr("(edm + c) % 8").cast("long").alias("m"))
    codes = a.unionByName(b).withColumn("m", F.col("m").cast("int"))
    return S.overlap_min(codes, "z", "m", RANKS).select("r", "c", "z", F.col("m").cast("long").alias("m"), "units")


@query("f15_overlap_pairs", "SELECT a.fid AS a, b.fid AS b FROM features a JOIN features b ON a.fid <> b.fid AND a.fclass = 'lake' AND b.fclass = 'lake' AND a.c0 <= b.c1 AND a.c1 >= b.c0 AND a.r0 <= b.r1 AND a.r1 >= b.r0", FEATURES)
def f15(spark, sf):
    return S.overlap_pairs(feature_boxes(spark, sf).where("fclass = 'lake'"), "fid", 8.0)


@query("f16_lines_polys_for_bbox", "SELECT unit_id, fid FROM features JOIN units ON c0 / 10.0 <= tx + 1.1 AND c1 / 10.0 >= tx - 0.1 AND r0 / 100.0 <= ty + 1.1 AND r1 / 100.0 >= ty - 0.1", FEATURES + "," + UNITS.strip()[4:])
def f16(spark, sf):
    f = feature_boxes(spark, sf).select("fid", *[(F.col(c) / d).alias(c) for c, d in (("xmin", 10.0), ("xmax", 10.0), ("ymin", 100.0), ("ymax", 100.0))])
    u = unit_boxes(spark, sf)
    return S.features_for_units(f, u, "unit_id", 0.1, 1.0)


@query("f17_merge_sinks", "SELECT r, c, row_number() OVER (ORDER BY r, c) AS id FROM (SELECT r, c FROM layers WHERE z_mm < -420 UNION SELECT CAST(r AS BIGINT), CAST(c AS BIGINT) FROM points WHERE value > 95) q", LAYERS + "," + POINTS[4:])
def f17(spark, sf):
    found = layers(spark, sf).where("z_mm < -420").select("r", "c")
    supplied = points(spark, sf).where("value > 95").select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"))
    return S.merge_sinks(found, supplied, ["r", "c"]).withColumn("id", F.col("id").cast("long"))


# polygons as cells

ROUND = """, k AS (SELECT i, j FROM range(-3, 4) a(i), range(-3, 4) b(j) WHERE i * i * 100 * 100 + j * j * 80 * 80 <= 250 * 250),
    grown AS (SELECT DISTINCT r + i AS r, c + j AS c FROM lake CROSS JOIN k)"""
LAKE = FEATURES + ", " + FCELLS + ", lake AS (SELECT DISTINCT r, c FROM fcells WHERE fclass = 'lake')"


@query("p01_buffer_cells", ROUND + " SELECT r, c FROM grown", LAKE)
def p01(spark, sf):
    return S.buffer_cells(feature_cells(spark, sf, "fclass = 'lake'"), 250.0, 80.0, 100.0).select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"))


@query("p02_donut", """, k AS (SELECT i, j FROM range(-2, 3) a(i), range(-2, 3) b(j) WHERE i * i * 100 * 100 + j * j * 80 * 80 <= 150 * 150),
    rim AS (SELECT DISTINCT r + i AS r, c + j AS c FROM lake CROSS JOIN range(-1, 2) a(i) CROSS JOIN range(-1, 2) b(j) EXCEPT SELECT r, c FROM lake)
    SELECT DISTINCT l.r, l.c FROM lake l JOIN (SELECT rim.r + i AS r, rim.c + j AS c FROM rim CROSS JOIN k) g ON g.r = l.r AND g.c = l.c""", LAKE)  # fmt: skip
def p02(spark, sf):
    return S.donut(feature_cells(spark, sf, "fclass = 'lake'").select("r", "c").distinct(), 150.0, 80.0, 100.0).select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"))


@query("p03_overlay", " SELECT r, c, 'both' AS kind FROM lake WHERE (r, c) IN (SELECT (r, c) FROM fcells WHERE fclass = 'river') UNION ALL SELECT r, c, 'lake' FROM lake WHERE (r, c) NOT IN (SELECT (r, c) FROM fcells WHERE fclass = 'river')".replace("(r, c) IN (SELECT (r, c)", "EXISTS (SELECT 1").replace("(r, c) NOT IN (SELECT (r, c)", "NOT EXISTS (SELECT 1").replace("WHERE fclass = 'river')", "f WHERE f.fclass = 'river' AND f.r = lake.r AND f.c = lake.c)"), LAKE)
def p03(spark, sf):
    lake, river = feature_cells(spark, sf, "fclass = 'lake'").select("r", "c").distinct(), feature_cells(spark, sf, "fclass = 'river'")
    out = S.overlay(lake, river, "intersection").withColumn("kind", F.lit("both")).unionByName(S.overlay(lake, river, "difference").withColumn("kind", F.lit("lake")))
    return out.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), "kind")


@query("p04_split_antimeridian", """
    WITH b AS (SELECT c_custkey, CAST(-(c_custkey % 180) AS DOUBLE) AS xmin, CAST(c_custkey % 170 + 5 AS DOUBLE) AS xmax FROM customer)
    SELECT c_custkey, xmin, xmax FROM b WHERE xmax - xmin <= 180 UNION ALL SELECT c_custkey, -180.0, xmin FROM b WHERE xmax - xmin > 180 UNION ALL SELECT c_custkey, xmax, 180.0 FROM b WHERE xmax - xmin > 180""")  # fmt: skip
def p04(spark, sf):
    return S.split_antimeridian(table(spark, sf, "customer").selectExpr("c_custkey", "CAST(-(c_custkey % 180) AS DOUBLE) xmin", "CAST(c_custkey % 170 + 5 AS DOUBLE) xmax"))


@query("p05_region_bboxes", "SELECT fid % 5 AS region, min(c0) AS xmin, min(r0) AS ymin, max(c1) AS xmax, max(r1) AS ymax FROM features GROUP BY 1", FEATURES)
def p05(spark, sf):
    from rillstone.operators.grid import bounds

    return bounds(features(spark, sf).withColumn("region", F.col("fid") % 5), ["region"])


@query("p06_valid_geometry", "SELECT p_partkey AS fid FROM part WHERE p_size % 3 <> 0 AND p_size % 4 <> 0")
def p06(spark, sf):
    ring = "CASE WHEN p_size % 3 = 0 THEN array(struct(0D x, 0D y), struct(1D x, 0D y), struct(1D x, 1D y), struct(2D x, 2D y)) WHEN p_size % 4 = 0 THEN array(struct(0D x, 0D y), struct(1D x, 1D y), struct(0D x, 0D y)) ELSE array(struct(0D x, 0D y), struct(1D x, 0D y), struct(CAST(p_size AS DOUBLE) x, 1D y), struct(0D x, 0D y)) END"
    return S.valid_rings(table(spark, sf, "part").selectExpr("p_partkey AS fid", f"{ring} AS ring")).select("fid")


@query("p07_relation", """
    SELECT a.fid AS a, b.fid AS b, true AS intersects, a.c0 >= b.c0 AND a.c1 <= b.c1 AND a.r0 >= b.r0 AND a.r1 <= b.r1 AS within
    FROM features a JOIN features b ON a.fclass = 'canal' AND b.fclass = 'river' AND a.c0 <= b.c1 AND a.c1 >= b.c0 AND a.r0 <= b.r1 AND a.r1 >= b.r0""", FEATURES)  # fmt: skip
def p07(spark, sf):
    a, b = (feature_cells(spark, sf, f"fclass = '{k}'").withColumnRenamed("fid", "zone") for k in ("canal", "river"))
    return S.relation(a, b)


@query("p08_rasterize", "SELECT a.r, b.c, max(fid) AS fid, arg_max(fclass, fid) AS fclass FROM features JOIN (SELECT DISTINCT r FROM layers) a ON a.r >= r0 AND a.r < r1 JOIN range(64) b(c) ON b.c >= c0 AND b.c < c1 GROUP BY 1, 2", LAYERS + "," + FEATURES.strip()[4:])
def p08(spark, sf):
    return S.rasterize(feature_segments(spark, sf), features(spark, sf), "fid", "fclass", *K.extent(layers(spark, sf)))


@query("p09_perimeter_area_ratio", "SELECT fid FROM (SELECT fid, (c1 - c0) * (r1 - r0) AS a, 2 * (c1 - c0 + r1 - r0) AS p FROM features) q WHERE p / CAST(a AS DOUBLE) < 1.5", FEATURES)
def p09(spark, sf):
    shapes = features(spark, sf).selectExpr("fid", "(c1 - c0) * (r1 - r0) AS area_km2", "2 * (c1 - c0 + r1 - r0) AS perimeter_km")
    return S.perimeter_area_ratio(shapes, 1.5).select("fid")


@query("p10_project_outline", """
    WITH RECURSIVE f AS (SELECT DISTINCT r, c FROM lake WHERE c < 64 AND r < 500),
    g AS (SELECT DISTINCT l.r + i AS r, l.c + j AS c FROM lake l CROSS JOIN (SELECT i, j FROM range(-1, 2) a(i), range(-1, 2) b(j) WHERE i * i * 10000 + j * j * 6400 <= 12100) k WHERE l.r + i BETWEEN 0 AND 511 AND l.c + j BETWEEN 0 AND 71 UNION SELECT r, c FROM lake),
    rest AS (SELECT a.r, b.c FROM range(512) a(r) CROSS JOIN range(72) b(c) EXCEPT SELECT r, c FROM g),
    k4 AS (SELECT * FROM (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) AS k(i, j)),
    flood AS (SELECT r, c FROM rest WHERE r = 0 OR c = 0 OR r = 511 OR c = 71
      UNION SELECT x.r, x.c FROM flood f CROSS JOIN k4 JOIN rest x ON x.r = f.r + k4.i AND x.c = f.c + k4.j)
    SELECT r, c FROM g UNION SELECT r, c FROM rest WHERE NOT EXISTS (SELECT 1 FROM flood f WHERE f.r = rest.r AND f.c = rest.c)""", LAKE)  # fmt: skip
def p10(spark, sf):
    cells = feature_cells(spark, sf, "fclass = 'lake'").select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"))
    return S.project_outline(cells, 512, 72, 110.0, 80.0, 100.0)


# sets and order


@query("g01_concat", "SELECT p_partkey AS k, p_size AS size, NULL AS name FROM part UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier")
def g01(spark, sf):
    return S.concat([table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("size")), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))])


@query("g02_sets", "SELECT r, c, 'both' AS kind FROM (SELECT r, c FROM points INTERSECT SELECT r, c FROM layers WHERE edm = 3) a UNION ALL SELECT r, c, 'first' FROM (SELECT r, c FROM points EXCEPT SELECT r, c FROM layers WHERE edm = 3) b", LAYERS + "," + POINTS[4:])
def g02(spark, sf):
    a = points(spark, sf).select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"))
    b = layers(spark, sf).where("edm = 3").select("r", "c")
    return a.intersect(b).withColumn("kind", F.lit("both")).unionByName(a.distinct().join(b, ["r", "c"], "left_anti").withColumn("kind", F.lit("first")))


@query("g03_duplicates", "SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) q WHERE k > 1")
def g03(spark, sf):
    return S.duplicates(table(spark, sf, "events").select("event_id", "user_id"), "user_id", "event_id")


@query("g04_outer_merge", "SELECT o_orderkey AS unit_id FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_orderkey FROM orders WHERE o_totalprice > 200000")
def g04(spark, sf):
    return S.outer_merge(status(spark, sf).select("unit_id"), table(spark, sf, "orders").where("o_totalprice > 200000").select(F.col("o_orderkey").alias("unit_id")))


@query("l01_order_units", "SELECT unit_id, row_number() OVER (ORDER BY unit_id DESC) AS position FROM units", UNITS)
def l01(spark, sf):
    return S.sequential_id(units(spark, sf).select("unit_id", (-F.col("unit_id")).alias("_k")), ["_k"], "position", 4).select("unit_id", "position")


@query("l04_sort_points", "SELECT user_id, array_to_string(list(event_id ORDER BY event_id % 64, event_id), ',') AS ids FROM events GROUP BY user_id")
def l04(spark, sf):
    e = table(spark, sf, "events")
    ids = F.transform(F.array_sort(F.collect_list(F.struct((F.col("event_id") % 64).alias("x"), "event_id"))), lambda p: p["event_id"].cast("string"))
    return e.groupBy("user_id").agg(F.array_join(ids, ",").alias("ids"))


# catalogs

PATHS = "WITH paths AS (SELECT page_id AS pos, url AS path FROM pages), tiles AS (SELECT DISTINCT CAST(page_id AS VARCHAR) AS tile FROM pages)"


def page_paths(spark, sf):
    return table(spark, sf, "pages").select(F.col("page_id").alias("pos"), F.col("url").alias("path"))


def page_tiles(spark, sf):
    return table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("tile")).distinct()


HOLDING = "hold AS (SELECT DISTINCT tile, pos, path FROM tiles JOIN (SELECT pos, path, unnest(regexp_split_to_array(path, '[/._?=&:-]+')) AS part FROM paths) p ON part = tile)"


@query("a05_catalog_files")
def a05(spark, sf):
    return A.catalog_files(spark, sf, include=["parquet"], exclude=["labels"]).select("name", "length")


@query("a06_resolve_tile_paths", f"WITH {HOLDING} SELECT tile, arg_min(path, pos) AS path FROM hold GROUP BY tile", PATHS)
def a06(spark, sf):
    return A.resolve_tile_paths(page_tiles(spark, sf), page_paths(spark, sf))


@query("l02_first_match", f"WITH {HOLDING} SELECT tile, path FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY pos) AS k FROM hold) q WHERE k = 1", PATHS)
def l02(spark, sf):
    return A.resolve_tile_paths(page_tiles(spark, sf), page_paths(spark, sf))


@query("a07_resolve_versioned", f"WITH {HOLDING} SELECT tile, path FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY CASE WHEN contains(path, 'en') THEN 0 WHEN contains(path, 'de') THEN 1 ELSE 2 END, pos) AS k FROM hold) q WHERE k = 1", PATHS)
def a07(spark, sf):
    return A.resolve_versioned(page_tiles(spark, sf), page_paths(spark, sf), ["en", "de"])


@query("a08_tag_source", "SELECT pos, CASE WHEN contains(path, 'https') THEN 'https' WHEN contains(path, 'http') THEN 'http' ELSE '' END AS source FROM paths", PATHS)
def a08(spark, sf):
    return A.tag_source(page_paths(spark, sf), marks=("https", "http")).select("pos", "source")


@query("a10_read_write_features", "SELECT fid, r0, c0, r1, c1 FROM features WHERE fclass = 'river'", FEATURES)
def a10(spark, sf):
    path = new_path(spark, "features")
    A.write_features(features(spark, sf), path, "fclass")
    return A.read_features(spark, path, "fclass = 'river'").select("fid", "r0", "c0", "r1", "c1")
