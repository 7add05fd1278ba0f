"""Queries of storage, addressing, clipping, mosaics and recoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import focal as K
from rillstone.operators import grid as G
from rillstone.queries.focal import _round
from rillstone.queries.registry import query
from rillstone.sources.fixtures import FEATURES, LAYERS, UNITS, features, layers, table, units
from rillstone.storage import new_path

GRID = G.Grid(10.0, 0.01, 50.0, 0.0125, 500, 64)


def grids(cells):
    """The layers' grid and a coarser one over the same ground."""
    rows = K.extent(cells)[0]
    return G.Grid(10.0, 0.01, 50.0, 0.0125, rows, 64), G.Grid(10.0, 0.025, 50.0, 0.03, rows * 5 // 12, 25)


TILE = "CASE WHEN n_nationkey % 2 = 0 THEN 'N' ELSE 'S' END || lpad(CAST((n_nationkey * 7) % 60 AS VARCHAR), 2, '0') || CASE WHEN n_nationkey % 3 = 0 THEN 'W' ELSE 'E' END || lpad(CAST((n_nationkey * 13) % 180 AS VARCHAR), 3, '0')"
TILES = f"WITH tiles AS (SELECT n_nationkey, {TILE} AS tile FROM nation)"


def tiles(spark, sf):
    return table(spark, sf, "nation").selectExpr("n_nationkey", TILE.replace("VARCHAR", "STRING") + " AS tile")


@query("a01_read_grid", "SELECT r, c, z_mm AS v FROM layers WHERE r BETWEEN 100 AND 227 AND c BETWEEN 10 AND 40", LAYERS)
def a01(spark, sf):
    path = new_path(spark, "blocks")
    G.to_blocks(layers(spark, sf), ["z_mm", "zt_mm"]).write.partitionBy("layer").parquet(path)
    return G.from_blocks(spark.read.parquet(path), "z_mm", box=(100, 10, 227, 40)).select("r", "c", "v")


@query("a02_write_grid", """
    SELECT CAST(floor(r / 64) AS BIGINT) AS br, CAST(floor(c / 64) AS BIGINT) AS bc, count(*) AS n, CAST(sum(z_mm) AS BIGINT) AS total, CAST(sum(z_mm * ((r % 64) * 64 + c % 64)) AS BIGINT) AS moment
    FROM layers GROUP BY 1, 2""", LAYERS)  # fmt: skip
def a02(spark, sf):
    blocks = G.to_blocks(layers(spark, sf), ["z_mm"])
    flat = blocks.select("br", "bc", F.posexplode("vals").alias("i", "v")).where("v is not null")
    return flat.groupBy("br", "bc").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.sum(F.col("v") * F.col("i")).alias("moment"))


@query("a03_grid_from_arrays", "SELECT vec_id AS r, unnest(range(len(embedding))) AS c, unnest(embedding) AS v FROM embeddings")
def a03(spark, sf):
    return G.grid_from_arrays(table(spark, sf, "embeddings"), "vec_id", "embedding").withColumn("c", F.col("c").cast("long"))


@query("a04_pack_rows", "SELECT r, array_to_string(list(z_mm ORDER BY c), ',') AS vals FROM layers GROUP BY r", LAYERS)
def a04(spark, sf):
    return G.pack_rows(layers(spark, sf), "z_mm").select("r", F.array_join(F.transform("vals", lambda x: x.cast("string")), ",").alias("vals"))


@query("a13_compact_layer", "SELECT r, c, CAST(z_mm / 1000.0 AS FLOAT) AS z FROM layers", LAYERS)
def a13(spark, sf):
    return G.compact_layer(layers(spark, sf).select("r", "c", (F.col("z_mm") / 1000.0).alias("z")), "z")


@query("a14_set_nodata", "SELECT r, c, coalesce(tc, 255) AS tc, nullif(edm, 0) AS edm FROM layers", LAYERS)
def a14(spark, sf):
    return G.set_nodata(G.set_nodata(layers(spark, sf), "tc", None, 255), "edm", 0, None).select("r", "c", "tc", "edm")


@query("b01_cell_to_xy", "SELECT r, c, round(10.0 + c * 0.01 + 0.005, 9) AS x, round(50.0 - r * 0.0125 - 0.00625, 9) AS y FROM layers", LAYERS)
def b01(spark, sf):
    return G.cell_to_xy(layers(spark, sf), GRID).select("r", "c", _round("x", 9).alias("x"), _round("y", 9).alias("y"))


@query("b02_xy_to_cell", "SELECT event_id, CAST(trunc((9.9e0 + user_id % 100 * 0.0123e0 - 10.0e0) / 0.01e0) AS INT) AS c, CAST(trunc((50.0e0 - (44.0e0 + event_id % 700 * 0.0101e0)) / 0.0125e0) AS INT) AS r FROM events")
def b02(spark, sf):
    points = table(spark, sf, "events").selectExpr("event_id", "9.9D + user_id % 100 * 0.0123D AS x", "44.0D + event_id % 700 * 0.0101D AS y")
    return G.xy_to_cell(points, GRID).select("event_id", "c", "r")


@query("b03_grid_extent", "SELECT fclass, min(c0) AS xmin, min(r0) AS ymin, max(c1) AS xmax, max(r1) AS ymax FROM features GROUP BY fclass", FEATURES)
def b03(spark, sf):
    return G.bounds(features(spark, sf), ["fclass"])


@query("b04_tile_bbox", """
    SELECT tile, x AS xmin, y AS ymin, x + 1 AS xmax, y + 1 AS ymax FROM (SELECT tile,
      CASE WHEN substr(tile, 4, 1) = 'W' THEN -1 ELSE 1 END * CAST(substr(tile, 5, 3) AS INT) AS x,
      CASE WHEN substr(tile, 1, 1) = 'S' THEN -1 ELSE 1 END * CAST(substr(tile, 2, 2) AS INT) AS y FROM tiles) t""", TILES)  # fmt: skip
def b04(spark, sf):
    return G.tile_bbox(tiles(spark, sf)).drop("n_nationkey")


@query("b05_parent_tile", """
    , p AS (SELECT tile, substr(tile, 1, 1) AS ns, substr(tile, 4, 1) AS ew, CAST(substr(tile, 2, 2) AS INT) AS la, CAST(substr(tile, 5, 3) AS INT) AS lo FROM tiles),
    w AS (SELECT *, CASE ew WHEN 'E' THEN lo - lo % 10 ELSE lo - lo % 10 + 10 END AS wx, CAST(floor((la - 1) / 10.0) * 10 + CASE ns WHEN 'N' THEN 10 ELSE 0 END AS INT) AS wy FROM p)
    SELECT tile, wx || ew || '_' || wy || CASE WHEN wy = 0 THEN 'N' ELSE ns END AS water,
      lower(ns) || lpad(CAST(CASE ns WHEN 'N' THEN la - la % 5 ELSE la + 5 - la % 5 END AS VARCHAR), 2, '0') || lower(ew) || lpad(CAST(CASE ew WHEN 'E' THEN lo - lo % 5 ELSE lo + 5 - lo % 5 END AS VARCHAR), 3, '0') AS osm,
      ns || lpad(CAST(CASE ns WHEN 'N' THEN la - la % 3 ELSE la + 3 - la % 3 END AS VARCHAR), 2, '0') || ew || lpad(CAST(CASE ew WHEN 'E' THEN lo - lo % 3 ELSE lo + 3 - lo % 3 END AS VARCHAR), 3, '0') AS cover FROM w""", TILES)  # fmt: skip
def b05(spark, sf):
    out = tiles(spark, sf)
    for scheme in ("water", "osm", "cover"):
        out = G.parent_tile(out, scheme, out=scheme)
    return out.drop("n_nationkey")


@query("b06_fishnet", """
    SELECT unit_id, i, j, tx + i * 0.25 - 0.05 AS bx0, ty + j * 0.25 - 0.05 AS by0, tx + i * 0.25 + 0.3 AS bx1, ty + j * 0.25 + 0.3 AS by1
    FROM units CROSS JOIN range(4) a(i) CROSS JOIN range(4) b(j)""".replace("tx + i * 0.25 - 0.05", "round(tx + i * 0.25 - 0.05, 6)").replace("ty + j * 0.25 - 0.05", "round(ty + j * 0.25 - 0.05, 6)").replace("tx + i * 0.25 + 0.3", "round(tx + i * 0.25 + 0.3, 6)").replace("ty + j * 0.25 + 0.3", "round(ty + j * 0.25 + 0.3, 6)"), UNITS)  # fmt: skip
def b06(spark, sf):
    boxes = units(spark, sf).select("unit_id", F.col("tx").alias("xmin"), F.col("ty").alias("ymin"), (F.col("tx") + 1).alias("xmax"), (F.col("ty") + 1).alias("ymax"))
    return G.fishnet(boxes, 0.25, 0.05).select("unit_id", F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), *[_round(x, 6).alias(x) for x in ("bx0", "by0", "bx1", "by1")])


@query("b07_cell_size_m", "SELECT n_nationkey, round(0.0125 * 111000.0, 6) AS dy_m, round(0.01 * 111000.0 * cos(radians(n_nationkey - 0.0125 * 500 / 2)), 6) AS dx_m FROM nation")
def b07(spark, sf):
    grids = table(spark, sf, "nation").select("n_nationkey", F.col("n_nationkey").cast("double").alias("y0"), F.lit(0.0125).alias("dy"), F.lit(0.01).alias("dx"), F.lit(500).alias("n_rows"))
    return G.cell_size_m(grids).select("n_nationkey", _round("dy_m", 6).alias("dy_m"), _round("dx_m", 6).alias("dx_m"))


@query("b08_valid_mask", "SELECT r, c, tc IS NOT NULL AS valid FROM layers", LAYERS)
def b08(spark, sf):
    return G.valid_mask(layers(spark, sf), "tc").select("r", "c", "valid")


@query("b09_clip_window", """
    WITH z AS (SELECT CAST(r % 7 AS BIGINT) AS zone, r, c FROM layers WHERE z_mm < -380),
    b AS (SELECT zone, greatest(min(r) - 3, 0) AS ra, least(max(r) + 3, (SELECT max(r) FROM layers)) AS rb, greatest(min(c) - 3, 0) AS ca, least(max(c) + 3, 63) AS cb FROM z GROUP BY zone)
    SELECT zone, l.r, l.c, l.z_mm FROM b JOIN layers l ON l.r BETWEEN ra AND rb AND l.c BETWEEN ca AND cb""", LAYERS)  # fmt: skip
def b09(spark, sf):
    cells = layers(spark, sf)
    zones = cells.where("z_mm < -380").select(F.expr("r % 7").alias("zone"), "r", "c")
    return G.clip_window(cells.select("r", "c", "z_mm"), zones, "zone", 3, *K.extent(cells))


@query("b10_clip_polygon", "SELECT l.r, l.c, CASE WHEN EXISTS (SELECT 1 FROM features f WHERE f.fclass = 'lake' AND l.r BETWEEN f.r0 AND f.r1 AND l.c BETWEEN f.c0 AND f.c1) THEN z_mm END AS z_mm FROM layers l", LAYERS + "," + FEATURES.strip()[4:])
def b10(spark, sf):
    lake = features(spark, sf).where("fclass = 'lake'")
    mask = lake.select(F.explode(F.sequence("r0", "r1")).alias("r"), "c0", "c1").select("r", F.explode(F.sequence("c0", "c1")).alias("c"))
    return G.clip_mask(layers(spark, sf).select("r", "c", "z_mm"), mask, "z_mm")


@query("b11_align_window", """
    SELECT fid, CAST(floor(c0 * 0.013e0 / 0.01e0) - 2 AS INT) AS ca, CAST(ceil(c1 * 0.013e0 / 0.01e0) + 2 AS INT) AS cb,
      CAST(floor(r0 * 0.011e0 / 0.0125e0) - 2 AS INT) AS ra, CAST(ceil(r1 * 0.011e0 / 0.0125e0) + 2 AS INT) AS rb FROM features""", FEATURES)  # fmt: skip
def b11(spark, sf):
    grid = G.Grid(0.0, 0.01, 0.0, 0.0125, 500, 64)
    boxes = features(spark, sf).select("fid", (F.col("c0") * 0.013).alias("xmin"), (F.col("c1") * 0.013).alias("xmax"), (-F.col("r1") * 0.011).alias("ymin"), (-F.col("r0") * 0.011).alias("ymax"))
    return G.align_window(boxes, grid, 2).select("fid", "ca", "cb", "ra", "rb")


@query("b12_trim_halo", "SELECT r, c, z_mm FROM layers WHERE r BETWEEN 5 AND (SELECT max(r) FROM layers) - 5 AND c BETWEEN 5 AND 58", LAYERS)
def b12(spark, sf):
    cells = layers(spark, sf).select("r", "c", "z_mm")
    return G.trim_halo(cells, 5, *K.extent(cells))


@query("b13_add_halo", "SELECT t.tr, u.tc, l.r, l.c, l.z_mm FROM (SELECT unnest(range(max(r) // 125 + 1)) AS tr FROM layers) t CROSS JOIN range(2) u(tc) JOIN layers l ON l.r BETWEEN t.tr * 125 - 4 AND t.tr * 125 + 128 AND l.c BETWEEN u.tc * 32 - 4 AND u.tc * 32 + 35", LAYERS)
def b13(spark, sf):
    return G.add_halo(layers(spark, sf).select("r", "c", "z_mm"), 125, 32, 4).select("tr", "tc", "r", "c", "z_mm")


@query("b14_cross_section", "SELECT r, c, z_mm FROM layers WHERE r = 77", LAYERS)
def b14(spark, sf):
    return G.cross_section(layers(spark, sf).select("r", "c", "z_mm"), row=77)


TARGET = "(SELECT DISTINCT r FROM layers WHERE r < (SELECT (max(r) + 1) * 5 // 12 FROM layers)) a"


def _target(spark, rows):
    return spark.range(rows).select(F.col("id").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(24))).alias("c")).withColumn("c", F.col("c").cast("long"))


@query("b15_resample_nearest", f"""
    WITH t AS (SELECT a.r AS tr, b.c AS tcol, CAST(trunc((50.0e0 - (50.0e0 - a.r * 0.03e0 - 0.03e0 / 2)) / 0.0125e0) AS BIGINT) AS r, CAST(trunc((10.0e0 + b.c * 0.025e0 + 0.025e0 / 2 - 10.0e0) / 0.01e0) AS BIGINT) AS c FROM {TARGET} CROSS JOIN range(25) b(c))
    SELECT tr AS r, tcol AS c, l.z_mm FROM t LEFT JOIN layers l ON l.r = t.r AND l.c = t.c""", LAYERS)  # fmt: skip
def b15(spark, sf):
    cells = layers(spark, sf)
    fine, coarse = grids(cells)
    return G.resample_nearest(cells, fine, _target(spark, coarse.n_rows), coarse, ["z_mm"])


@query("b16_resample_bilinear", f"""
    WITH t AS (SELECT a.r AS tr, b.c AS tcol, (50.0 - (50.0 - a.r * 0.03 - 0.015)) / 0.0125 - 0.5 AS fr, (10.0 + b.c * 0.025 + 0.0125 - 10.0) / 0.01 - 0.5 AS fc FROM {TARGET} CROSS JOIN range(25) b(c)),
    k AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS k(i, j)),
    w AS (SELECT tr, tcol, floor(fr) + i AS r, floor(fc) + j AS c, (CASE WHEN i = 1 THEN fr - floor(fr) ELSE 1 - fr + floor(fr) END) * (CASE WHEN j = 1 THEN fc - floor(fc) ELSE 1 - fc + floor(fc) END) AS w FROM t CROSS JOIN k)
    SELECT tr AS r, tcol AS c, round(sum(w * swo) / sum(w), 4) + 0.0 AS out FROM w JOIN layers l ON l.r = w.r AND l.c = w.c WHERE w > 0 GROUP BY tr, tcol""", LAYERS)  # fmt: skip
def b16(spark, sf):
    cells = layers(spark, sf)
    fine, coarse = grids(cells)
    return G.resample_bilinear(cells, "swo", fine, _target(spark, coarse.n_rows), coarse).select("r", "c", _round("out", 4).alias("out"))


@query("b17_mosaic", "SELECT r, c, CASE WHEN r >= 245 THEN z_mm + 3 ELSE z_mm END AS z_mm FROM layers WHERE r >= 245 OR r < 250", LAYERS)
def b17(spark, sf):
    cells = layers(spark, sf).select("r", "c", "z_mm")
    return G.mosaic([cells.where("r < 250"), cells.where("r >= 245").withColumn("z_mm", F.col("z_mm") + 3)], "z_mm")


@query("b18_mosaic_order", """
    SELECT unit_id, CASE WHEN tx = 3 THEN 4 WHEN ty = 2 THEN 3 WHEN endo = 2 THEN 0 WHEN coast = 1 THEN 1 ELSE 2 END AS rank FROM units""", UNITS)  # fmt: skip
def b18(spark, sf):
    counted = units(spark, sf).withColumns({"n_river": F.when(F.col("tx") == 3, 5).otherwise(0), "n_stream": F.when(F.col("ty") == 2, 2).otherwise(0), "island": F.when(F.col("endo") == 2, 1).otherwise(0)})
    return G.mosaic_rank(counted).select("unit_id", "rank")


@query("b19_grid_difference", "SELECT r, c, round((zt_mm - z_mm) / 1000.0, 3) AS diff FROM layers", LAYERS)
def b19(spark, sf):
    cells = layers(spark, sf)
    new = cells.select("r", "c", (F.col("zt_mm") / 1000.0).alias("z"))
    return G.grid_difference(new, cells.select("r", "c", (F.col("z_mm") / 1000.0).alias("z")), "z", 3).select("r", "c", _round("diff", 3).alias("diff"))


@query("b20_realign_shifted", "SELECT r, c, CAST(7 AS BIGINT) AS diff FROM layers WHERE r < (SELECT max(r) FROM layers)", LAYERS)
def b20(spark, sf):
    cells = layers(spark, sf).select("r", "c", "z_mm")
    cells = cells.where(F.col("r") < K.extent(cells)[0] - 1)
    moved = cells.select((F.col("r") + 1).alias("r"), "c", (F.col("z_mm") + 7).alias("z_mm"))
    return G.realign_shifted(moved, cells, "z_mm")


@query("b21_recode", "SELECT r, c, CASE edm WHEN 2 THEN 20 WHEN 3 THEN 30 ELSE 0 END AS edm FROM layers", LAYERS)
def b21(spark, sf):
    return G.recode(layers(spark, sf), "edm", {2: 20, 3: 30}, 0).select("r", "c", "edm")


@query("b22_fill_from_layers", "SELECT r, c, coalesce(CASE WHEN swo + 30 <= 100 THEN swo + 30 END, tc, th) AS v FROM layers", LAYERS)
def b22(spark, sf):
    return G.fill_from_layers(layers(spark, sf).withColumn("v", F.col("swo") + 30), "v", ["tc", "th"]).select("r", "c", "v")


@query("b23_artifact_mask", "SELECT r, c, CASE WHEN r < 250 AND c >= 64 - 40 THEN 1 WHEN r >= 250 AND c < 5 THEN 1 ELSE 0 END AS artifact FROM layers", LAYERS)
def b23(spark, sf):
    cells = layers(spark, sf).withColumn("tile", F.when(F.col("r") < 250, "N50W001").otherwise("N50E000"))
    return G.artifact_mask(cells, "tile", 64, 80.0, "TDT", "TDT").select("r", "c", "artifact")


@query("b24_threshold_mask", "SELECT r, c, swo > 60 AS wet, edm IN (2, 3) AS water FROM layers", LAYERS)
def b24(spark, sf):
    return layers(spark, sf).select("r", "c", (F.col("swo") > 60).alias("wet"), F.col("edm").isin(2, 3).alias("water"))


@query("b25_modulo_mask", """
    WITH h AS (SELECT r, c, CASE WHEN (z_mm // 200) * 200 % 400 = 0 AND swo >= 2 THEN 1 ELSE 0 END AS m FROM (SELECT r, c, swo, CAST(floor(z_mm / 200.0) AS BIGINT) * 200 AS z_mm FROM layers) q),
    a AS (SELECT r, c, min(m) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v, count(*) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS n FROM h),
    e AS (SELECT r, c, CASE WHEN sum(n) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) = 9 THEN min(v) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) ELSE 0 END AS e FROM a),
    d AS (SELECT r, c, max(e) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v FROM e)
    SELECT r, c, max(v) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS mask FROM d""", LAYERS)  # fmt: skip
def b25(spark, sf):
    cells = layers(spark, sf).withColumn("z_mm", (F.floor(F.col("z_mm") / 200.0) * 200).cast("long"))
    return G.modulo_mask(cells, "z_mm", "swo", step_mm=400).select("r", "c", "mask")


@query("b26_mercator_equal_area", """
    WITH s AS (SELECT fid, unnest([c0, c1, c1, c0]) * 0.1 AS x1, unnest([r0, r0, r1, r1]) * 0.1 AS y1, unnest([c1, c1, c0, c0]) * 0.1 AS x2, unnest([r0, r1, r1, r0]) * 0.1 AS y2 FROM features),
    k AS (SELECT 6378137.0 AS a, 0.081819190842622 AS e, cos(radians(30.0)) / sqrt(1 - power(0.081819190842622 * sin(radians(30.0)), 2)) AS k0),
    p AS (SELECT fid, radians(x1) * a * k0 AS a1, radians(x2) * a * k0 AS a2,
      a / (2 * k0) * (1 - e*e) * (sin(radians(y1)) / (1 - power(e * sin(radians(y1)), 2)) - ln((1 - e * sin(radians(y1))) / (1 + e * sin(radians(y1)))) / (2 * e)) AS b1,
      a / (2 * k0) * (1 - e*e) * (sin(radians(y2)) / (1 - power(e * sin(radians(y2)), 2)) - ln((1 - e * sin(radians(y2))) / (1 + e * sin(radians(y2)))) / (2 * e)) AS b2 FROM s, k)
    SELECT fid, round(abs(sum(a1 * b2 - a2 * b1)) / 2e6, 3) AS area_km2, round(sum(sqrt(power(a2 - a1, 2) + power(b2 - b1, 2))) / 1e3, 4) AS perimeter_km FROM p GROUP BY fid""", FEATURES)  # fmt: skip
def b26(spark, sf):
    ring = F.explode(F.expr("array(struct(c0 x1, r0 y1, c1 x2, r0 y2), struct(c1 x1, r0 y1, c1 x2, r1 y2), struct(c1 x1, r1 y1, c0 x2, r1 y2), struct(c0 x1, r1 y1, c0 x2, r0 y2))"))
    segments = features(spark, sf).select("fid", ring.alias("s")).select("fid", *[(F.col(f"s.{x}") * 0.1).alias(x) for x in ("x1", "y1", "x2", "y2")])
    return G.area_perimeter_km(segments).select("fid", _round("area_km2", 3).alias("area_km2"), _round("perimeter_km", 4).alias("perimeter_km"))
