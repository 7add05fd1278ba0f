"""Queries of water, depressions, drainage and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions import scalar as S
from rillstone.operators import depressions as I
from rillstone.operators import drainage as J
from rillstone.operators import focal as K
from rillstone.operators import ladders as L
from rillstone.operators import water as H
from rillstone.plans.noise import KERNELS, adaptive_filter
from rillstone.plans.rivers import enforce_rivers
from rillstone.queries.focal import NEAR, _gradient, _pad, _round, ring_sql
from rillstone.queries.registry import query
from rillstone.queries.spatial import SLICE, cube
from rillstone.queries.zones import ROUNDS, feature_cells, labels_sql, low
from rillstone.sources import catalog as A
from rillstone.sources.fixtures import FEATURES, LAYERS, SAMPLES, UNITS, features, layers, table, units, valley
from rillstone.storage import materialize, new_path


def size(spark, sf):
    return K.extent(layers(spark, sf))


def _sized(k: int) -> str:
    return f"RANGE BETWEEN {k} PRECEDING AND {k} FOLLOWING"


def box_sql(source: str, name: str, outputs: dict[str, tuple[str, str, int]]) -> str:
    """Two common table expressions: square windows over source, all its columns kept."""
    first = ", ".join(f"{how}({value}) OVER (PARTITION BY r ORDER BY c {_sized(k)}) AS a_{out}" for out, (how, value, k) in outputs.items())
    second = ", ".join(f"{how if how in ('min', 'max') else 'sum'}(a_{out}) OVER (PARTITION BY c ORDER BY r {_sized(k)}) AS {out}" for out, (how, value, k) in outputs.items())
    return f"{name}_1 AS (SELECT *, {first} FROM {source}), {name} AS (SELECT *, {second} FROM {name}_1)"


# water


@query("h01_osm_filter_lines", "SELECT fid, fclass FROM features WHERE fclass IN ('canal', 'drain', 'river', 'riverbank', 'stream')", FEATURES)
def h01(spark, sf):
    return H.filter_lines(features(spark, sf).withColumnRenamed("fclass", "waterway")).select("fid", "fclass")


@query("h01_osm_filter_polys", "SELECT fid FROM features WHERE landuse = 'reservoir' OR natural_ IN ('water', 'wetland')", FEATURES)
def h01b(spark, sf):
    return H.filter_polygons(features(spark, sf)).select("fid")


@query("h02_label_water", """
    SELECT fid, CASE WHEN natural_ = 'wetland' THEN 'wetland' WHEN landuse = 'reservoir' THEN 'reservoir' WHEN natural_ = 'water' THEN
      CASE WHEN contains(other_tags, 'river') THEN 'river' WHEN contains(other_tags, 'pond') THEN 'pond' ELSE 'water' END ELSE 'NULL' END AS kind FROM features""", FEATURES)  # fmt: skip
def h02(spark, sf):
    return H.label_water(features(spark, sf), out="kind").select("fid", "kind")


@query("h03_osm_class", "SELECT fid, CASE fclass WHEN 'river' THEN 5 WHEN 'stream' THEN 6 WHEN 'canal' THEN 7 WHEN 'drain' THEN 8 END AS watertype FROM features", FEATURES)
def h03(spark, sf):
    return H.class_code(features(spark, sf), H.LINE_CLASSES).select("fid", "watertype")


def wet_cells(spark, sf):
    return layers(spark, sf).selectExpr("r", "c", "z_mm AS z", "swo", "edm", "CASE WHEN th < 6 THEN th END AS osm", "CASE WHEN (r + 2*c) % 19 = 0 THEN 1 ELSE 0 END AS land")


WET = LAYERS + ", wet AS (SELECT r, c, z_mm AS z, swo, edm, CASE WHEN th < 6 THEN th END AS osm, CASE WHEN (r + 2*c) % 19 = 0 THEN 1 ELSE 0 END AS land FROM layers)"


def _big(n: int) -> str:
    return f" SELECT r, c, zone FROM zones WHERE zone IN (SELECT zone FROM zones GROUP BY zone HAVING count(*) >= {n})"


@query("h04_reservoir_mask", f"WITH RECURSIVE {labels_sql('(swo > 70 OR coalesce(osm IN (1, 2, 3), false)) AND land = 0 AND coalesce(osm, 0) <> 4', source='wet')}" + _big(6), WET)
def h04(spark, sf):
    return H.reservoir_mask(wet_cells(spark, sf), 64, 70, 6, 100.0)


@query("h05_river_candidates", f"WITH RECURSIVE {labels_sql('(swo > 75 OR coalesce(osm IN (1, 2, 3), false) OR edm IN (2, 3)) AND NOT (land = 1 OR coalesce(osm, 0) = 4 AND swo < 90 OR edm = 4)', source='wet')}" + _big(8), WET)
def h05(spark, sf):
    return H.river_candidates(wet_cells(spark, sf), 64, 75, 8)


@query("h06_large_lakes")
def h06(spark, sf):
    lakes = feature_cells(spark, sf, "fclass = 'lake' and c1 < 64").select("fid", F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"))
    rows, cols = (max(x) for x in zip(K.extent(layers(spark, sf)), K.extent(lakes), strict=True))  # lakes may reach below the grid
    return H.large_lakes(lakes, rows, cols, 20, 100.0, 80.0, 100.0)


BURN = "CASE WHEN swo >= 80 THEN {d} ELSE greatest(0.0, least({d}, (swo - {c}) * {d} / (80.0 - {c}))) END"


@query("h07_flatten_lakes", f"""
    WITH k AS (SELECT *, CAST(floor(r / 50) AS BIGINT) AS lake FROM layers WHERE swo > 55),
    s AS (SELECT lake, avg(CASE WHEN swo > 80 THEN 1.0 ELSE 0.0 END) AS share, quantile_cont(z_mm, 0.1) FILTER (WHERE swo > 80) AS level FROM k GROUP BY lake)
    SELECT l.r, l.c, round(CASE WHEN s.share >= 0.2 AND k.r IS NOT NULL AND l.swo > 60 AND s.level - {BURN.format(d="1000.0", c="60.0").replace("swo", "l.swo")} - l.z_mm <= 5 THEN s.level - {BURN.format(d="1000.0", c="60.0").replace("swo", "l.swo")} ELSE l.z_mm END, 4) + 0.0 AS flat
    FROM layers l LEFT JOIN k ON k.r = l.r AND k.c = l.c LEFT JOIN s ON s.lake = k.lake""", LAYERS)  # fmt: skip
def h07(spark, sf):
    cells = layers(spark, sf).withColumnRenamed("z_mm", "z")
    lakes = cells.where("swo > 55").select("r", "c", F.floor(F.col("r") / 50).alias("lake"))
    return H.flatten_lakes(cells, lakes, 60, 1000.0, 1e9, 5.0).select("r", "c", _round("flat", 4).alias("flat"))


@query("h08_swo_burn", f"SELECT r, c, round({BURN.format(d='1000.0', c='20.0')}, 6) + 0.0 AS burn FROM layers", LAYERS)
def h08(spark, sf):
    return layers(spark, sf).withColumn("b", H.swo_burn(F.col("swo"), 20, 1000.0)).select("r", "c", _round("b", 6).alias("burn"))


def line_cells(spark, sf):
    return layers(spark, sf).withColumn("line", F.when(F.col("z_mm") < -150, 5 + F.col("th") % 4).cast("int"))


OWN = "CASE line WHEN 5 THEN 3000.0 WHEN 6 THEN 1500.0 WHEN 7 THEN 1000.0 WHEN 8 THEN 500.0 ELSE 0.0 END"


@query("h09_vector_burn", f"""
    WITH w AS (SELECT r, c, line, CAST({OWN} AS DOUBLE) AS b FROM (SELECT r, c, CASE WHEN z_mm < -150 THEN 5 + th % 4 END AS line FROM layers) q),
    {_pad(1, "b", "w", "p1")}, {ring_sql("p1", "s1", "b", {"b": [1.0, 0.5]})}, f1 AS (SELECT s1.* FROM s1 JOIN w ON w.r = s1.r AND w.c = s1.c), {_pad(1, "b", "f1", "p2")}, {ring_sql("p2", "s2", "b", {"b": [1.0, 0.5]})},
    f2 AS (SELECT s2.* FROM s2 JOIN w ON w.r = s2.r AND w.c = s2.c), {_pad(1, "b", "f2", "p3")}, {ring_sql("p3", "s3", "b", {"b": [1.0, 0.5]})}, {box_sql("w", "m", {"near_class": ("min", "line", 1)})}
    SELECT m.r, m.c, round(least(greatest(s3.b * 3, m.b), 3000.0), 4) + 0.0 AS burn, near_class FROM m JOIN s3 ON s3.r = m.r AND s3.c = m.c""", LAYERS)  # fmt: skip
def h09(spark, sf):
    return H.vector_burn(line_cells(spark, sf), "line", {5: 3000, 6: 1500, 7: 1000, 8: 500}, *size(spark, sf)).select("r", "c", _round("burn", 4).alias("burn"), "near_class")


def stream_cells(spark, sf):
    return layers(spark, sf).selectExpr("r", "c", "z_mm AS z", "swo", "edm", "CASE WHEN z_mm < -120 THEN 1 + th % 3 ELSE 0 END AS stream", "CASE WHEN edm = 3 THEN 1 ELSE 0 END AS big_river", "CASE WHEN edm IN (2, 3) THEN 1 ELSE 0 END AS river")


STREAM = LAYERS + ", st AS (SELECT r, c, z_mm AS z, swo, edm, CASE WHEN z_mm < -120 THEN 1 + th % 3 ELSE 0 END AS stream, CASE WHEN edm = 3 THEN 1 ELSE 0 END AS big_river, CASE WHEN edm IN (2, 3) THEN 1 ELSE 0 END AS river FROM layers)"


@query("h10_stream_minimize", f"""
    WITH {_pad(1, "z", "st", "p1")}, {ring_sql("p1", "s1", "z", {"t": [1.0, 0.5]})},
    a AS (SELECT st.*, s1.t, CASE WHEN stream > 0 AND big_river = 0 THEN 1 ELSE 0 END AS on_, CASE WHEN stream = 1 THEN 1 ELSE 0 END AS riv FROM st JOIN s1 ON s1.r = st.r AND s1.c = st.c),
    {box_sql("a", "b", {"adj": ("max", "on_", 5), "bank": ("max", "on_", 3), "wide": ("max", "riv", 1)})},
    d AS (SELECT *, CASE WHEN adj = 1 THEN t END AS near_t, CASE WHEN adj = 1 AND bank = 0 THEN t END AS land FROM b),
    {box_sql("d", "e", {"m1": ("min", "near_t", 15), "m2": ("min", "near_t", 12), "m3": ("min", "near_t", 10), "ml": ("min", "land", 5)})},
    f AS (SELECT *, CASE WHEN big_river = 1 THEN 0 WHEN wide = 1 THEN 1 ELSE stream END AS kind, coalesce(ml, t) AS mland FROM e),
    g AS (SELECT *, greatest(CASE kind WHEN 1 THEN coalesce(m1, z) WHEN 2 THEN coalesce(m2, z) WHEN 3 THEN coalesce(m3, z) ELSE z END, z - 300) AS lo, CASE WHEN kind > 0 THEN 7 + kind ELSE 0 END AS code FROM f),
    h AS (SELECT *, CASE WHEN bank = 1 THEN mland - lo ELSE 0 END AS gap FROM g)
    SELECT r, c, round(CASE WHEN gap < 20 AND code > 0 AND on_ = 1 THEN mland - 20 WHEN gap > 200 AND code > 0 AND big_river = 0 THEN mland - 200 ELSE lo END, 4) + 0.0 AS low, code FROM h""", STREAM)  # fmt: skip
def h10(spark, sf):
    return H.stream_minimize(stream_cells(spark, sf), {1: 15, 2: 12, 3: 10}, *size(spark, sf), 300.0, 200.0, 20.0).select("r", "c", _round("low", 4).alias("low"), "code")


@query("h11_river_minimize", f"""
    WITH w AS (SELECT *, CASE WHEN swo > 75 THEN 1 ELSE 0 END AS rv, CASE WHEN swo > 75 THEN 0 ELSE 1 END AS bank FROM st), {box_sql("w", "e", {"edge": ("max", "bank", 1)})},
    i AS (SELECT r, c, z, CASE WHEN rv = 1 AND edge = 0 AND swo > 5 THEN z END AS zi FROM e), {box_sql("i", "m", {"lo": ("min", "zi", 6)})}
    SELECT r, c, CASE WHEN zi IS NOT NULL THEN greatest(lo, z - 150) ELSE z END AS low FROM m""", STREAM)  # fmt: skip
def h11(spark, sf):
    cells = stream_cells(spark, sf).withColumn("river", (F.col("swo") > 75).cast("int"))
    return H.river_minimize(cells, 6, 150).select("r", "c", "low")


@query("h12_smooth_rivers", f"""
    WITH {_pad(2, "z", "st", "p1")}, {ring_sql("p1", "s1", "z", {"mean": [1.0, 1.0, 1.0]})},
    a AS (SELECT st.*, CASE WHEN swo > 90 THEN mean END AS w FROM st JOIN s1 ON s1.r = st.r AND s1.c = st.c), {box_sql("a", "b", {"m": ("min", "w", 5)})}
    SELECT r, c, round(CASE WHEN swo > 90 AND z - m BETWEEN 10 AND 400 THEN m ELSE z END, 4) + 0.0 AS low FROM b""", STREAM)  # fmt: skip
def h12(spark, sf):
    return H.smooth_rivers(stream_cells(spark, sf), *size(spark, sf), 5, 400.0).select("r", "c", _round("low", 4).alias("low"))


def _raise(small: str, large: str, k: int) -> str:
    return f"""
    WITH w AS (SELECT *, CASE WHEN {large} THEN z END AS lz, CASE WHEN {large} THEN 1 ELSE 0 END AS lg FROM st), {box_sql("w", "m", {"lo": ("min", "lz", k), "near": ("max", "lg", k)})}
    SELECT r, c, CASE WHEN {small} AND near = 1 AND lo + 50 - z > 0 AND lo + 50 - z <= 200 THEN lo + 50 ELSE z END AS raised FROM m"""


for _name, _small, _large, _k in (("h13_raise_small_streams", "stream = 2", "big_river = 1", 9), ("h14_raise_small_rivers", "river = 1 AND swo < 90", "swo >= 95", 7), ("h15_raise_canals", "stream = 3", "river = 1", 12)):

    def _raised(spark, sf, small=_small, large=_large, k=_k):
        return H.raise_small(stream_cells(spark, sf), F.expr(small), F.expr(large), k, 50, 200).select("r", "c", "raised")

    query(_name, _raise(_small, _large, _k), STREAM)(_raised)


@query("h16_set_ocean_elev", "SELECT r, c, CASE WHEN edm = 4 THEN -5 ELSE z END AS z FROM st", STREAM)
def h16(spark, sf):
    return H.set_ocean(stream_cells(spark, sf), F.col("edm") == 4, -5).select("r", "c", F.col("z").cast("long").alias("z"))


@query("h17_clip_ocean", "SELECT r, c, CASE WHEN NOT (edm IN (4, 5) AND NOT (c < 10) AND NOT (swo > 90)) THEN z END AS z FROM st", STREAM)
def h17(spark, sf):
    return H.clip_ocean(stream_cells(spark, sf), F.col("c") < 10, F.col("swo") > 90).select("r", "c", "z")


SEA = "(z = 0 AND edm = 5 OR edm = 4) AND NOT swo > 90"


@query("h18_coast_land_mask", f"""
    WITH s AS (SELECT *, CASE WHEN {SEA} THEN 1 ELSE 0 END AS m FROM st), {box_sql("s", "g", {"gr": ("max", "m", 2)})},
    {box_sql("g", "e", {"lo": ("min", "gr", 2), "n": ("count", "gr", 2)})}, o AS (SELECT r, c, CASE WHEN {SEA} OR n = 25 AND lo = 1 AND z < 0 AND edm >= 4 AND NOT swo > 90 THEN 1 ELSE 0 END AS ocean FROM e),
    w AS (SELECT o.*, 1 - ocean AS land, greatest(1 - ocean, coalesce(1 - lag(ocean) OVER (PARTITION BY r ORDER BY c), 0), coalesce(1 - lead(ocean) OVER (PARTITION BY r ORDER BY c), 0),
          coalesce(1 - lag(ocean) OVER (PARTITION BY c ORDER BY r), 0), coalesce(1 - lead(ocean) OVER (PARTITION BY c ORDER BY r), 0)) AS land_wide FROM o), {box_sql("w", "f", {"shore": ("max", "ocean", 3)})}
    SELECT r, c, ocean, land, land_wide, shore FROM f""", STREAM)  # fmt: skip
def h18(spark, sf):
    return H.coast_land_mask(stream_cells(spark, sf), F.col("swo") > 90, 2, dx_m=80.0, dy_m=100.0).select("r", "c", "ocean", "land", "land_wide", "shore")


@query("h19_is_coastal", "SELECT CAST(floor(r / 100) AS BIGINT) AS unit, count(*) FILTER (WHERE edm = 4) > 235 AS coastal, CASE WHEN count(*) FILTER (WHERE edm = 4) > 235 THEN 65 ELSE 20 END AS swo_cutoff FROM st GROUP BY 1", STREAM)
def h19(spark, sf):
    return H.is_coastal(stream_cells(spark, sf).withColumn("unit", F.floor(F.col("r") / 100)), "unit", 235)


@query("h20_water_mask", f"""
    WITH RECURSIVE w AS (SELECT *, CASE WHEN swo > 88 THEN 1 ELSE 0 END AS m FROM wet), {box_sql("w", "g", {"near": ("max", "m", 1)})}, {labels_sql("near = 1", name="joined", source="g", rounds=200)},
    z AS (SELECT r, c, zone, osm FROM joined JOIN wet USING (r, c) WHERE swo > 88),
    cross_ AS (SELECT r, c, zone FROM z WHERE c < 2 OR c > 61), {labels_sql("true", name="piece", source="cross_", rounds=200)},
    pieces AS (SELECT cross_.zone, count(DISTINCT piece.zone) AS pieces FROM piece JOIN cross_ USING (r, c) GROUP BY 1),
    share AS (SELECT zone, max(CASE WHEN osm = 2 THEN 1 ELSE 0 END) AS river, avg(CASE WHEN osm IN (1, 3) THEN 1.0 ELSE 0.0 END) AS lake, avg(CASE WHEN osm > 0 THEN 1.0 ELSE 0.0 END) AS mapped FROM z GROUP BY zone),
    kind AS (SELECT zone, CASE WHEN lake > 0.9 THEN 3 WHEN river = 1 OR coalesce(pieces, 0) >= 2 AND (coalesce(pieces, 0) <= 4 OR mapped >= 0.1) THEN 4 ELSE 3 END AS kind FROM share LEFT JOIN pieces USING (zone))
    SELECT r, c, zone, kind FROM z JOIN kind USING (zone)""", WET)  # fmt: skip
def h20(spark, sf):
    cells = wet_cells(spark, sf)
    return H.water_mask(cells.where("swo > 88"), cells, cells.where("c < 2 or c > 61"), 64, 1)


@query("h21_alt_dem_init", f"""
    WITH RECURSIVE a AS (SELECT *, CAST(round(z / 100.0) * 100 AS BIGINT) AS alt FROM st), b AS (SELECT *, CASE WHEN ((alt % 200) + 200) % 200 = 0 AND swo >= 2 THEN 1 ELSE 0 END AS m FROM a),
    {box_sql("b", "d", {"lo": ("min", "m", 1), "n": ("count", "m", 1)})}, e AS (SELECT * EXCLUDE (lo, n, m), CASE WHEN n = 9 THEN lo ELSE 0 END AS e FROM d), {box_sql("e", "f", {"hit": ("max", "e", 1)})},
    {labels_sql("hit = 1", source="f", rounds=200)}, {labels_sql("edm IN (2, 3)", name="water", source="st", rounds=200)},
    t AS (SELECT DISTINCT zone FROM zones JOIN st USING (r, c) WHERE big_river = 1), u AS (SELECT DISTINCT zone FROM water JOIN st USING (r, c) WHERE big_river = 1),
    g AS (SELECT a.*, CASE WHEN z1.zone IN (SELECT zone FROM t) THEN 1 ELSE 0 END AS s, CASE WHEN z2.zone IN (SELECT zone FROM u) THEN 1 ELSE 0 END AS w FROM a LEFT JOIN zones z1 ON z1.r = a.r AND z1.c = a.c LEFT JOIN water z2 ON z2.r = a.r AND z2.c = a.c),
    {box_sql("g", "h", {"near": ("max", "s", 1)})}, i AS (SELECT r, c, z, alt, swo, edm, big_river, greatest(near, w) AS taken FROM h), {box_sql("i", "j", {"around": ("max", "taken", 2)})},
    k AS (SELECT *, CASE WHEN around = 1 AND taken = 0 THEN 1 ELSE 0 END AS edge, CASE WHEN around = 1 AND taken = 0 THEN NULL WHEN taken = 1 THEN alt ELSE z END AS x FROM j),
    fill AS (SELECT p.r, p.c, sum(q.x * 1.0 / ((p.r - q.r) * (p.r - q.r) + (p.c - q.c) * (p.c - q.c))) / sum(1.0 / ((p.r - q.r) * (p.r - q.r) + (p.c - q.c) * (p.c - q.c))) AS v
             FROM k p JOIN (SELECT unnest(range(-5, 6)) AS dr) o ON true JOIN k q ON q.r = p.r + o.dr AND q.c BETWEEN p.c - 5 AND p.c + 5 WHERE p.edge = 1 AND q.x IS NOT NULL GROUP BY p.r, p.c)
    SELECT k.r, k.c, taken, round(CASE WHEN edm = 2 THEN least(coalesce(x, v), alt) ELSE coalesce(x, v, z) END, 4) + 0.0 AS z_new, CASE WHEN edm = 2 THEN 3 WHEN edge = 1 THEN 15 WHEN taken = 1 OR big_river = 1 THEN 11 ELSE 0 END AS code_new
    FROM k LEFT JOIN fill ON fill.r = k.r AND fill.c = k.c""", STREAM)  # fmt: skip
def h21(spark, sf):
    cells = stream_cells(spark, sf).withColumns({"alt": F.round(F.col("z") / 100.0) * 100, "lake": (F.col("edm") == 2).cast("int")}).withColumn("alt", F.col("alt").cast("long"))
    out = H.alternate_dem(cells, 64, 200, F.col("big_river") == 1, edm="edm")
    return out.select("r", "c", "taken", _round("z_new", 4).alias("z_new"), "code_new")


@query("h22_river_bank", f"""
    WITH w AS (SELECT *, river AS rv FROM st), {box_sql("w", "m", {"any_": ("max", "rv", 3), "n": ("sum", "rv", 3)})}, p AS (SELECT quantile_cont(n, 0.9) AS p FROM m WHERE any_ = 1 AND rv = 0)
    SELECT r, c, CASE WHEN any_ = 1 AND rv = 0 THEN 1 ELSE 0 END AS bank, round(CASE WHEN any_ = 1 AND rv = 0 THEN least(1000.0, n * (1000.0 / p)) ELSE 0.0 END, 6) + 0.0 AS burn FROM m, p""", STREAM)  # fmt: skip
def h22(spark, sf):
    return H.river_bank(stream_cells(spark, sf), F.col("river") == 1, 1000.0).select("r", "c", "bank", _round("burn", 6).alias("burn"))


@query("h23_lower_river_below_land")
def h23(spark, sf):
    return L.lower_river_below_land(valley(spark, sf), 64).select("r", "c", _round("z", 4).alias("z"), "code")


@query("h24_monotonic_streams")
def h24(spark, sf):
    return L.monotonic_streams(valley(spark, sf), 64).select("r", "c", _round("z", 4).alias("z"), "code")


@query("h25_monotonic_rivers")
def h25(spark, sf):
    return L.monotonic_rivers(valley(spark, sf), 64).select("r", "c", _round("z", 4).alias("z"), "code")


@query("h26_water_floor", "SELECT r, c, CASE WHEN th BETWEEN 1 AND 7 OR th = 15 THEN greatest(z_mm, -100) WHEN th BETWEEN 8 AND 14 THEN greatest(z_mm, -50) ELSE z_mm END AS z FROM layers", LAYERS)
def h26(spark, sf):
    return H.water_floor(layers(spark, sf).withColumnRenamed("z_mm", "z"), -100, -50, "th").select("r", "c", "z")


@query("h27_all_water_unit", f"""
    WITH u AS (SELECT *, CAST(floor(r / 50) AS BIGINT) AS unit, CASE WHEN swo > 20 THEN 1 ELSE 0 END AS water FROM layers), a AS (SELECT unit, avg(water) > 0.88 AS full_ FROM u GROUP BY unit)
    SELECT r, c, round(CASE WHEN full_ THEN z_mm - {BURN.format(d="1000.0", c="20.0")} ELSE z_mm END, 6) + 0.0 AS z_new, CASE WHEN full_ THEN 3 ELSE 0 END AS code FROM u JOIN a USING (unit)""", LAYERS)  # fmt: skip
def h27(spark, sf):
    cells = layers(spark, sf).withColumnRenamed("z_mm", "z").withColumns({"unit": F.floor(F.col("r") / 50), "water": (F.col("swo") > 20).cast("int")})
    return H.all_water_unit(cells, "unit", 20, 1000.0, 0.88).select("r", "c", _round("z_new", 6).alias("z_new"), "code")


def valley_units(spark, sf):
    """The valley as a surface without classes: lines on its streams, candidates on its river and lakes."""
    cells = valley(spark, sf)
    bare = cells.select("r", "c", "z", "swo", F.when(F.col("code") == 3, 3).when(F.col("code") == 4, 2).cast("int").alias("osm"), F.when(F.col("code") == 8, 6).cast("int").alias("line"))
    return bare, cells.where("code in (3, 4)").select("r", "c")


@query("h28_enforce_rivers")
def h28(spark, sf):
    cells, candidates = valley_units(spark, sf)
    out = enforce_rivers(cells, candidates, *size(spark, sf), floor=0.0)
    return out.select("r", "c", _round("z_water", 4).alias("z_water"), "code")


@query("h29_reservoir_barrier")
def h29(spark, sf):
    cells = stream_cells(spark, sf)
    return H.reservoir_barrier(cells, low(spark, sf), cells.select("r", "c"), 64, 150.0, 80.0, 100.0, 20.0, 100_000, min_area=160_000.0).select("r", "c", "z", "wall")


@query("h30_noflow_wall", f"""
    WITH w AS (SELECT r, c, z_mm, CASE WHEN r % 50 = 25 THEN 1 + CAST(floor(r / 250) AS INT) END AS wall, greatest(0, zt_mm % 40) AS fill FROM layers),
    f AS (SELECT *, CASE WHEN wall IS NULL AND fill > 20 THEN z_mm END AS fz FROM w), {box_sql("f", "m", {"top": ("max", "fz", 2)})}
    SELECT r, c, CAST(CASE WHEN wall IS NULL THEN z_mm WHEN wall = 1 THEN greatest(z_mm + 100, top + 100, -50) WHEN wall = 2 THEN greatest(z_mm + 100, top + 100, 80) ELSE greatest(z_mm + 100, top + 100) END AS DOUBLE) AS z FROM m""", LAYERS)  # fmt: skip
def h30(spark, sf):
    cells = layers(spark, sf).select("r", "c", F.col("z_mm").alias("z"), F.greatest(F.lit(0), F.col("zt_mm") % 40).alias("fill"))
    walls = cells.where("r % 50 = 25").select("r", "c", (1 + F.floor(F.col("r") / 250)).cast("int").alias("wall"))
    return H.remove_wall(H.noflow_wall(cells, walls, 50_000), {1: -50, 2: 80}, 100, 20).select("r", "c", "z")


# depressions

PIT = " AND ".join(f"{d} IS NOT NULL" for d in I.EIGHT) + f" AND z < least({', '.join(I.EIGHT)})"


@query("i01_single_cell_pits", f"WITH {NEAR.format(t='layers')} SELECT r, c, CASE WHEN {PIT} THEN least({', '.join(I.EIGHT)}) ELSE z END AS out FROM near", LAYERS)
def i01(spark, sf):
    return I.single_cell_pits(layers(spark, sf), "z_mm").select("r", "c", "out")


FILL = """
    fill_it AS (SELECT 0 AS k, r, c, z_mm AS z, CASE WHEN r = 0 OR c = 0 OR c = 63 OR r = (SELECT max(r) FROM layers) THEN z_mm ELSE 1000000 END AS w FROM layers
      UNION ALL SELECT k + 1, r, c, z, greatest(z, least(w, min(m) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)))
      FROM (SELECT *, min(w) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM fill_it WHERE k < 300) q),
    filled AS (SELECT r, c, z, w AS filled FROM fill_it WHERE k = 300)"""


def filled_cells(spark, sf):
    return I.fill_depressions(layers(spark, sf), "z_mm", 64)


@query("i02_fill_depressions", f"WITH RECURSIVE {FILL} SELECT r, c, filled FROM filled", LAYERS)
def i02(spark, sf):
    return filled_cells(spark, sf).select("r", "c", F.col("filled").cast("long").alias("filled"))


def pit_tables(spark, sf):
    cells = materialize(filled_cells(spark, sf).selectExpr("r", "c", "z_mm AS z", "CAST(filled AS BIGINT) AS filled", "swo", "edm", "CASE WHEN swo > 80 THEN 1 ELSE 0 END AS water"), "filled")
    return cells, materialize(I.pit_zones(cells, "filled", "z", 64), "pits")


def bottoms_of(cells, pits):
    held = pits.hint("merge").join(cells, ["r", "c"])
    return held.groupBy(F.col("label").cast("long").alias("pit")).agg(F.min_by(F.struct("r", "c"), F.struct("z", "r", "c")).alias("b")).select("pit", "b.r", "b.c")


@query("i03_breach_depressions")
def i03(spark, sf):
    cells, pits = pit_tables(spark, sf)
    return I.breach_depressions(cells, bottoms_of(cells, pits), 10, 200.0).select("pit", "r", "c", _round("value", 4).alias("value"))


PITS = f"{FILL}, {labels_sql('filled > z', source='filled', rounds=ROUNDS + 180)}, pits AS (SELECT r, c, zone, dense_rank() OVER (ORDER BY zone) AS label FROM zones)"


@query("i04_pit_zones", f"WITH RECURSIVE {PITS} SELECT r, c, label FROM pits", LAYERS)
def i04(spark, sf):
    _, pits = pit_tables(spark, sf)
    return pits.select("r", "c", F.col("label").cast("long").alias("label"))


@query("i05_fill_shallow", f"""
    WITH RECURSIVE {PITS}, s AS (SELECT label FROM pits JOIN filled USING (r, c) JOIN layers USING (r, c) GROUP BY label HAVING max(filled - z) <= 40 AND max(CASE WHEN swo > 80 THEN 1 ELSE 0 END) = 0)
    SELECT f.r, f.c, CASE WHEN s.label IS NOT NULL THEN filled ELSE z END AS z FROM filled f LEFT JOIN pits p ON p.r = f.r AND p.c = f.c LEFT JOIN s ON s.label = p.label""", LAYERS)  # fmt: skip
def i05(spark, sf):
    cells, pits = pit_tables(spark, sf)
    return I.fill_shallow(cells, pits, 40).select("r", "c", "z")


@query("i06_raise_lake_pits", f"""
    WITH RECURSIVE {PITS}, s AS (SELECT label, min(z) FILTER (WHERE edm = 2) AS lo FROM pits JOIN filled USING (r, c) JOIN layers USING (r, c) GROUP BY label HAVING count(*) FILTER (WHERE edm = 2) > 1)
    SELECT f.r, f.c, CASE WHEN z < s.lo THEN s.lo + 10 ELSE z END AS z FROM filled f LEFT JOIN pits p ON p.r = f.r AND p.c = f.c LEFT JOIN s ON s.label = p.label""", LAYERS)  # fmt: skip
def i06(spark, sf):
    cells, pits = pit_tables(spark, sf)
    return I.raise_lake_pits(cells, pits, F.col("edm") == 2, 10, 1).select("r", "c", "z")


def _catalog(spark, sf):
    cells, pits = pit_tables(spark, sf)
    carve = materialize(I.breach_depressions(cells, bottoms_of(cells, pits), 10, 200.0), "carves")
    lowest = carve.groupBy("r", "c").agg(F.min("value").alias("value"), F.min_by("pit", F.struct("value", "pit")).alias("label"))
    done, behind = I.fill_behind(cells, lowest, pits, 64)
    return I.pit_catalog(done, pits, lowest.select("r", "c", "label"), behind, 64)


@query("i07_pit_catalog")
def i07(spark, sf):
    out = _catalog(spark, sf)
    return out.select("pit", *[_round(x, 3).alias(x) for x in ("maxfill", "volfill", "maxcarve", "volcarve", "maxfillbehind", "volfillbehind")], "n", "carves", "completecarve")


def pit_rows(spark, sf):
    """Catalog rows with every rule's inputs, from orders' lines."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice / 1000 AS maxfill", "l_extendedprice AS volfill", "CAST(l_quantity AS BIGINT) AS n", "l_discount * 400 AS maxcarve", "l_extendedprice * l_tax * 10 AS volcarve",
        "CASE WHEN l_linenumber = 3 THEN l_extendedprice * 0.95 ELSE 0.0 END AS volfillbehind", "l_tax * 10 AS maxfillbehind", "CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS completecarve",
        "CASE WHEN l_partkey % 97 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS n_wall", "CASE WHEN l_suppkey % 89 = 0 THEN 1 ELSE 0 END AS n_sink", "l_linenumber AS n_carve", "CASE WHEN l_linenumber = 2 THEN 2 ELSE 0 END AS n_carve_water",
    )


PIT_ROWS = """
WITH p AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice / 1000 AS maxfill, l_extendedprice AS volfill, CAST(l_quantity AS BIGINT) AS n, l_discount * 400 AS maxcarve, l_extendedprice * l_tax * 10 AS volcarve,
  CASE WHEN l_linenumber = 3 THEN l_extendedprice * 0.95e0 ELSE 0.0e0 END AS vfb, l_tax * 10 AS mfb, CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS complete,
  CASE WHEN l_partkey % 97 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS n_wall, CASE WHEN l_suppkey % 89 = 0 THEN 1 ELSE 0 END AS n_sink, l_linenumber AS n_carve, CASE WHEN l_linenumber = 2 THEN 2 ELSE 0 END AS n_carve_water FROM lineitem)"""

SOLUTION = """CASE WHEN n_wall = n THEN 1 WHEN n_sink > 0 THEN 7 WHEN maxfill / n < 0.01e0 AND volfill / n < 1 THEN 2006 WHEN maxfill < 0.01e0 THEN 2005
      WHEN complete = 1 AND maxcarve + mfb <= 100 AND maxcarve <= maxfill * 1.25e0 + CASE WHEN n_carve_water > 0 THEN 5 ELSE 0 END THEN
        CASE WHEN n_carve_water = n_carve THEN 1002
             WHEN volcarve + vfb < volfill THEN CASE WHEN volcarve + vfb > 12000 THEN CASE WHEN vfb >= volfill * 0.9e0 THEN 2004 ELSE 4000 END WHEN volcarve < 4000 THEN 1200 WHEN volfill < 12000 THEN 2000 ELSE 4000 END
             WHEN volfill < 12000 THEN CASE WHEN volcarve < 4000 THEN 2100 ELSE 2000 END WHEN vfb >= volfill * 0.9e0 THEN 2004 ELSE 4000 END
      WHEN volfill < 12000 THEN 2009 ELSE 4000 END"""


@query("i08_select_solution", f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {SOLUTION} AS solution FROM p", PIT_ROWS)
def i08(spark, sf):
    return I.select_solution(pit_rows(spark, sf)).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "solution")


@query("e08_solution_counts", f"SELECT {SOLUTION} AS solution, count(*) AS n FROM p GROUP BY 1", PIT_ROWS)
def e08(spark, sf):
    return I.select_solution(pit_rows(spark, sf)).groupBy("solution").agg(F.count("*").alias("n"))


@query("i13_unsolved_units", f"SELECT DISTINCT l_suppkey AS unit FROM (SELECT l_suppkey, {SOLUTION} AS s FROM p) q WHERE s > 3000", PIT_ROWS)
def i13(spark, sf):
    return I.unsolved_units(I.select_solution(pit_rows(spark, sf)).withColumnRenamed("l_suppkey", "unit"), "unit", 3000)


@query("i09_apply_solution", """
    WITH s AS (SELECT k AS pit, CASE WHEN k % 5 = 0 THEN 1200 WHEN k % 5 = 1 THEN 2000 WHEN k % 5 = 2 THEN 1 WHEN k % 5 = 3 THEN 4000 ELSE 2009 END AS solution FROM range(101) t(k)),
    pc AS (SELECT r, c, (r + c) % 101 AS pit, CAST(z_mm + 7 AS DOUBLE) AS v FROM layers WHERE swo > 60), cc AS (SELECT r, c, (r * 3 + c) % 101 AS pit, CAST(z_mm - 9 AS DOUBLE) AS v FROM layers WHERE swo > 40),
    bc AS (SELECT r, c, (r * 3 + c) % 101 AS pit, CAST(z_mm + 2 AS DOUBLE) AS v FROM layers WHERE swo > 70),
    w AS (SELECT r, c, pit, 0 AS phase, v, solution FROM pc JOIN s USING (pit) WHERE solution BETWEEN 2000 AND 2999 UNION ALL SELECT r, c, pit, 0, v, solution FROM cc JOIN s USING (pit) WHERE solution BETWEEN 1000 AND 1999
      UNION ALL SELECT r, c, pit, 1, v, solution FROM bc JOIN s USING (pit) WHERE solution BETWEEN 1000 AND 1999 UNION ALL SELECT r, c, pit, -1, NULL, solution FROM pc JOIN s USING (pit) WHERE solution > 3000 OR solution = 1),
    k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY pit DESC, phase DESC) AS n FROM w) q WHERE n = 1)
    SELECT l.r, l.c, coalesce(k.v, l.z_mm) AS solved, coalesce(k.solution, 0) AS code FROM layers l LEFT JOIN k ON k.r = l.r AND k.c = l.c""", LAYERS)  # fmt: skip
def i09(spark, sf):
    cells = layers(spark, sf).withColumnRenamed("z_mm", "z")
    solved = spark.range(101).selectExpr("id AS pit", "CASE WHEN id % 5 = 0 THEN 1200 WHEN id % 5 = 1 THEN 2000 WHEN id % 5 = 2 THEN 1 WHEN id % 5 = 3 THEN 4000 ELSE 2009 END AS solution")
    pit = cells.where("swo > 60").selectExpr("r", "c", "(r + c) % 101 AS pit", "z + 7 AS value")
    carve = cells.where("swo > 40").selectExpr("r", "c", "(r * 3 + c) % 101 AS pit", "z - 9 AS value")
    behind = cells.where("swo > 70").selectExpr("r", "c", "(r * 3 + c) % 101 AS pit", "z + 2 AS value")
    return I.apply_solution(cells, solved, pit, carve, behind).select("r", "c", "solved", "code")


@query("i10_partial_fill")
def i10(spark, sf):
    cells, pits = pit_tables(spark, sf)
    held = pits.select("r", "c", F.col("label").cast("long").alias("pit")).hint("merge").join(cells, ["r", "c"])
    big = held.groupBy("pit").agg(F.max(F.col("filled") - F.col("z")).alias("maxfill"), F.sum(F.col("filled") - F.col("z")).alias("volfill")).where("maxfill > 60")
    return I.partial_fill(cells, big, held.join(big.select("pit"), "pit", "left_semi"), 0.2, 8, 300.0).select("pit", "solution", _round("volume", 3).alias("volume"))


@query("i11_apply_partial", """
    WITH w AS (SELECT r, c, (r + c) % 101 AS pit, z_mm + 7 AS v FROM layers WHERE swo > 60 UNION ALL SELECT r, c, (r * 3 + c) % 101, z_mm - 9 FROM layers WHERE swo > 40 AND (r * 3 + c) % 101 <> (r + c) % 101),
    k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY pit DESC) AS n FROM w) q WHERE n = 1)
    SELECT l.r, l.c, CAST(coalesce(k.v, l.z_mm) AS DOUBLE) AS z, CASE WHEN k.pit IS NULL THEN 0 ELSE 3004 END AS code FROM layers l LEFT JOIN k ON k.r = l.r AND k.c = l.c""", LAYERS)  # fmt: skip
def i11(spark, sf):
    cells = layers(spark, sf).withColumnRenamed("z_mm", "z")
    a = cells.where("swo > 60").selectExpr("r", "c", "(r + c) % 101 AS pit", "CAST(z + 7 AS DOUBLE) AS value", "3004 AS solution")
    b = cells.where("swo > 40 and (r * 3 + c) % 101 <> (r + c) % 101").selectExpr("r", "c", "(r * 3 + c) % 101 AS pit", "CAST(z - 9 AS DOUBLE) AS value", "3004 AS solution")
    return I.apply_partial(cells, a.unionByName(b)).select("r", "c", "z", "code")


@query("i12_final_fill_and_diff", f"WITH RECURSIVE {FILL} SELECT r, c, CASE WHEN z > -430 THEN CAST(filled AS DOUBLE) END AS final, CASE WHEN z > -430 THEN CAST(filled - z AS DOUBLE) END AS diff FROM filled", LAYERS)
def i12(spark, sf):
    cells = layers(spark, sf)
    return I.final_fill_and_diff(cells, "z_mm", "z_mm", 64, cells.where("z_mm <= -430")).select("r", "c", "final", "diff")


@query("i14_empty_units", "SELECT unit FROM (SELECT CAST(floor(r / 10) AS BIGINT) AS unit, count(CASE WHEN r % 70 >= 10 THEN z_mm END) AS n FROM layers GROUP BY 1) q WHERE n = 0", LAYERS)
def i14(spark, sf):
    cells = layers(spark, sf).select(F.floor(F.col("r") / 10).alias("unit"), F.when(F.col("r") % 70 >= 10, F.col("z_mm")).alias("z"))
    return I.empty_units(cells, "unit", "z")


@query("i15_condition_unit")
def i15(spark, sf):
    # the valley falls for 2,500 rows and rises for as many, or rivers of taller grids would lie below the ladder, which ends at -3 m
    up = "3 * (r - least(pmod(r, 5000), 5000 - pmod(r, 5000)))"
    cells = valley(spark, sf).selectExpr("r", "c", f"CAST(z + {up} AS DOUBLE) AS z", "swo", "code AS class", "CASE WHEN code > 2 THEN 1 ELSE 0 END AS water")
    # a wall across the grid, a sink in every hundredth row, lakes as reservoirs
    walls = cells.where("r % 250 = 125").select("r", "c", F.lit(1).alias("wall"))
    sinks = cells.where("r % 100 = 50 and c = 32").select("r", "c")
    reservoirs = cells.where("class = 3").select("r", "c", F.floor(F.col("r") / 192).alias("zone"))
    out = I.condition_unit(
        cells, 64, 5.0, 8, I.SolutionLimits(fill=600.0, max_carve_depth=300.0), walls, 50_000.0, {1: -50.0}, sinks, 10.0, metre=1000.0, reservoirs=reservoirs, cell_metres=(80.0, 100.0),
    )
    return out.select("r", "c", "class", _round("solved", 4).alias("solved"), "code", _round("final", 4).alias("final"))


@query("a12_write_pit_catalog", f"SELECT l_suppkey, l_orderkey, l_linenumber, volfill, {SOLUTION} AS solution FROM p", PIT_ROWS)
def a12(spark, sf):
    path = new_path(spark, "pit-catalog")
    solved = I.select_solution(pit_rows(spark, sf)).select("l_suppkey", "l_orderkey", "l_linenumber", "volfill", "solution")
    A.write_pit_catalog(solved, path, "l_suppkey")
    # a second run over some units replaces those and leaves the others
    A.write_pit_catalog(solved.where("l_suppkey % 3 = 0"), path, "l_suppkey")
    return A.read_pit_catalog(spark, path, solved.schema).select(*solved.columns)


# drainage

DROPS = ", ".join(f"(z - {d}) / {'sqrt(2.0e0)' if i and j else '1.0e0'} AS d{k}" for k, (d, i, j) in enumerate(J.DIRECTIONS, 1))
POINTER = NEAR.format(t="tilted") + f", drops AS (SELECT r, c, {DROPS} FROM near), best AS (SELECT *, greatest(d1, d2, d3, d4, d5, d6, d7, d8) AS b FROM drops), ptr AS (SELECT r, c, CASE WHEN b > 0 THEN b ELSE 0 END AS slope, CASE WHEN b > 0 THEN CASE " + " ".join(f"WHEN d{k} = b THEN {k}" for k in range(1, 9)) + " END ELSE 0 END AS dir FROM best)"
TILTED = LAYERS + ", tilted AS (SELECT r, c, zt_mm AS z_mm FROM layers)"


def pointers(spark, sf):
    return J.d8_pointer(layers(spark, sf).select("r", "c", "zt_mm"), "zt_mm")


@query("j02_d8_pointer", f"WITH {POINTER} SELECT r, c, dir FROM ptr", TILTED)
def j02(spark, sf):
    return pointers(spark, sf).select("r", "c", "dir")


@query("j03_d8_slope", f"WITH {POINTER} SELECT r, c, round(slope, 6) + 0.0 AS slope FROM ptr", TILTED)
def j03(spark, sf):
    return pointers(spark, sf).select("r", "c", _round("slope", 6).alias("slope"))


@query("j04_flow_accumulation", f"""
    WITH RECURSIVE {POINTER}, k AS (SELECT * FROM (VALUES {", ".join(f"({n}, {i}, {j})" for n, (_, i, j) in enumerate(J.DIRECTIONS, 1))}) AS k(dir, i, j)),
    nxt AS (SELECT r, c, r + i AS nr, c + j AS nc FROM ptr JOIN k USING (dir)),
    walk AS (SELECT r, c FROM layers UNION ALL SELECT n.nr, n.nc FROM walk w JOIN nxt n ON n.r = w.r AND n.c = w.c)
    SELECT r, c, count(*) AS cells FROM walk GROUP BY r, c""", TILTED)  # fmt: skip
def j04(spark, sf):
    return J.flow_accumulation(pointers(spark, sf), 64)


FLATS = NEAR.format(t="flat")


@query("j01_fix_flats", f"""
    WITH RECURSIVE flat AS (SELECT r, c, floor(zt_mm / 100.0) * 100 AS z_mm FROM layers), {FLATS},
    out_ AS (SELECT r, c, z FROM near WHERE {" OR ".join(f"{d} IS NULL OR {d} < z" for d in I.EIGHT)}),
    walk AS (SELECT r, c, z, 0 AS d FROM out_ UNION SELECT n.r, n.c, n.z, w.d + 1 FROM walk w CROSS JOIN (SELECT i, j FROM range(-1, 2) a(i), range(-1, 2) b(j)) k
      JOIN near n ON n.r = w.r + k.i AND n.c = w.c + k.j AND n.z = w.z WHERE w.d < 25),
    least_ AS (SELECT r, c, min(d) AS d FROM walk GROUP BY 1, 2)
    SELECT n.r, n.c, round(n.z + coalesce(l.d, 0) * 0.01, 4) AS out FROM near n LEFT JOIN least_ l ON l.r = n.r AND l.c = n.c""", LAYERS)  # fmt: skip
def j01(spark, sf):
    cells = layers(spark, sf).select("r", "c", (F.floor(F.col("zt_mm") / 100.0) * 100).alias("z"))
    return J.fix_flats(cells, "z", 0.01, 64).select("r", "c", _round("out", 4).alias("out"))


@query("j05_flowdir_check", f"WITH {POINTER} SELECT CAST(floor(p.r / 25) AS BIGINT) AS unit, count(*) FILTER (WHERE dir = 0 AND th BETWEEN 2 AND 5 AND edm < 4) AS n FROM ptr p JOIN layers l ON l.r = p.r AND l.c = p.c WHERE floor(p.r / 25) <> 3 GROUP BY 1", TILTED)
def j05(spark, sf):
    cells = J.d8_pointer(layers(spark, sf), "zt_mm").withColumns({"z": F.col("zt_mm"), "code": F.col("th"), "unit": F.floor(F.col("r") / 25)})
    return J.flowdir_check(cells, "unit", cells.where("unit = 3").select("unit").distinct())


@query("j06_flowdir_fix", "SELECT r, c, CASE WHEN CAST(floor(r / 25) AS BIGINT) % 3 = 0 AND th BETWEEN 2 AND 5 THEN z_mm + 100 ELSE z_mm END AS z FROM layers", LAYERS)
def j06(spark, sf):
    cells = layers(spark, sf).withColumns({"z": F.col("z_mm"), "code": F.col("th"), "unit": F.floor(F.col("r") / 25)})
    return J.flowdir_fix(cells, cells.where("unit % 3 = 0").select("unit"), "unit", 100).select("r", "c", "z")


@query("k01_endorheic_units", "SELECT unit_id FROM units WHERE endo = 2", UNITS)
def k01(spark, sf):
    return J.endorheic_units(units(spark, sf), 5).select("unit_id")


def unit_cells(spark, sf):
    return layers(spark, sf).select(F.floor(F.col("r") / 50).alias("unit"), "r", "c", F.col("z_mm").alias("z"), "swo")


@query("k02_find_sink", f"""
    WITH RECURSIVE u AS (SELECT CAST(floor(r / 50) AS BIGINT) AS unit, r, c, z_mm AS z, swo FROM layers), p AS (SELECT unit, quantile_cont(z, 0.05) AS p FROM u GROUP BY unit),
    lowest AS (SELECT u.* FROM u JOIN p USING (unit) WHERE z <= p), {labels_sql("true", source="lowest", by="unit, ")},
    n AS (SELECT unit, zone, count(*) AS n FROM zones GROUP BY 1, 2), best AS (SELECT unit, zone FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY n DESC, zone) AS k FROM n) q WHERE k = 1),
    held AS (SELECT l.* FROM lowest l JOIN zones z ON z.unit = l.unit AND z.r = l.r AND z.c = l.c JOIN best b ON b.unit = z.unit AND b.zone = z.zone),
    wet_ AS (SELECT * FROM (SELECT *, max(CASE WHEN swo >= 80 THEN 1 ELSE 0 END) OVER (PARTITION BY unit) AS any_ FROM held) q WHERE any_ = 0 OR swo >= 80),
    ties AS (SELECT * FROM (SELECT *, min(z) OVER (PARTITION BY unit) AS lo FROM wet_) q WHERE z = lo),
    far AS (SELECT *, round((r - avg(r) OVER (PARTITION BY unit)) ** 2 + (c - avg(c) OVER (PARTITION BY unit)) ** 2, 9) AS d FROM ties)
    SELECT unit, r, c FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY d, r, c) AS k FROM far) q WHERE k = 1""", LAYERS)  # fmt: skip
def k02(spark, sf):
    return J.find_sink(unit_cells(spark, sf), "unit", 64, 0.05)


@query("k03_burn_sinks", "SELECT r, c, CASE WHEN (r * 13 + c * 7) % 401 = 0 AND r % 2 = 0 THEN 1 ELSE 0 END AS sink, CASE WHEN NOT ((r * 13 + c * 7) % 401 = 0 AND r % 2 = 0) THEN z_mm END AS z FROM layers", LAYERS)
def k03(spark, sf):
    cells = unit_cells(spark, sf)
    sinks = cells.where("(r * 13 + c * 7) % 401 = 0").select(F.when(F.col("r") % 2 == 0, F.col("unit")).otherwise(-1).alias("unit"), "r", "c")
    return J.burn_sinks(cells, sinks, "unit").select("r", "c", "sink", "z")


# the adaptive filter, bias removal and the noise-removal plan


def filtered_sql(source: str, value: str, swo_limit: int) -> str:
    """Common table expressions ending in adapted (r, c, filtered, filter_mask) over a grid with swo and edm."""
    return f"""{_pad(4, value, source, "fp")}, {ring_sql("fp", "kernels", value, {f"k{k}": list(w) for k, w in KERNELS.items()})},
    smooth AS (SELECT l.*, k9, k7, k5, k3 FROM {source} l JOIN kernels k ON k.r = l.r AND k.c = l.c),
    {_gradient("smooth", "k9", 1000.0, 1200.0)},
    bend AS (SELECT *, lag(gx) OVER (PARTITION BY r ORDER BY c) AS gw, lead(gx) OVER (PARTITION BY r ORDER BY c) AS ge, lag(gy) OVER (PARTITION BY c ORDER BY r) AS gn, lead(gy) OVER (PARTITION BY c ORDER BY r) AS gs FROM grad),
    curve AS (SELECT *, CAST(floor(degrees(atan(sqrt(gx * gx + gy * gy)))) AS INT) AS slope,
      CASE WHEN gw IS NULL THEN (ge - gx) / 1000.0 WHEN ge IS NULL THEN (gx - gw) / 1000.0 ELSE (ge - gw) / 2000.0 END
      + CASE WHEN gn IS NULL THEN (gs - gy) / 1200.0 WHEN gs IS NULL THEN (gy - gn) / 1200.0 ELSE (gs - gn) / 2400.0 END AS cv FROM bend),
    judged AS (SELECT *, CASE WHEN cv > 2.5 * sd THEN 0 WHEN cv < -2.5 * sd THEN 2 WHEN slope >= 30 THEN 1
      WHEN abs(cv) > sd OR slope BETWEEN 15 AND 30 THEN 3 WHEN slope BETWEEN 6 AND 15 THEN 5 WHEN slope BETWEEN 2 AND 6 THEN 7 ELSE 9 END AS m FROM curve CROSS JOIN (SELECT stddev_pop(cv) AS sd FROM curve) x),
    soaked AS (SELECT *, CASE WHEN swo > {swo_limit} THEN 3 ELSE m END AS m2 FROM judged),
    patched AS (SELECT *, CASE WHEN edm = 5 AND m2 < 3 THEN 3 ELSE m2 END AS m3 FROM soaked),
    adapted AS (SELECT r, c, CASE WHEN edm IN (2, 3) THEN 1 ELSE m3 END AS filter_mask,
      CASE WHEN edm IN (2, 3) THEN {value} WHEN m3 = 9 THEN k9 WHEN m3 = 7 THEN k7 WHEN m3 = 5 THEN k5 WHEN m3 = 3 THEN k3 ELSE {value} END AS filtered FROM patched)"""


FILTERED = f"WITH {filtered_sql('layers', 'z_mm', 80)} SELECT r, c, filter_mask, round(filtered, 4) + 0.0 AS filtered FROM adapted"

UNBIASED = f"""{SLICE},
    ground AS (SELECT r, c, CAST(z_mm AS DOUBLE) AS z, coalesce(tc, 0) AS gtc, coalesce(th, 0) AS gth, swo, edm FROM layers),
    {_pad(4, "z, gtc, gth", "ground", "bp")}, {ring_sql("bp", "bz", "z", {"s9": list(KERNELS[9])})}, {ring_sql("bp", "bt", "gtc", {"tcs": [1.0, 1.0]})}, {ring_sql("bp", "bh", "gth", {"ths": [1.0, 1.0]})},
    shaped AS (SELECT g.*, s9, tcs, ths FROM ground g JOIN bz ON bz.r = g.r AND bz.c = g.c JOIN bt ON bt.r = g.r AND bt.c = g.c JOIN bh ON bh.r = g.r AND bh.c = g.c),
    {_gradient("shaped", "s9", 1000.0, 1200.0).replace("grad AS", "bgrad AS").replace(" g AS", " bg AS").replace("FROM g)", "FROM bg)")},
    keyed AS (SELECT *, least(CAST(floor(degrees(atan(sqrt(gx * gx + gy * gy)))) AS INT), 19) AS sk, CAST(floor(round(tcs, 9)) AS INT) AS tk, CAST(floor(round(ths, 9)) AS INT) AS hk FROM bgrad),
    unbiased AS (SELECT k.r, k.c, k.z, k.swo, k.edm, CASE WHEN gtc = 0 OR gth = 0 OR edm IN (2, 3) THEN 0.0 ELSE coalesce(cube.bias, 0.0) END AS bias FROM keyed k LEFT JOIN cube ON cube.slope = sk AND cube.tc = tk AND cube.th = hk),
    clean AS (SELECT r, c, z - bias AS corrected, swo, edm, bias FROM unbiased)"""


@query("c24_adaptive_filter", FILTERED, LAYERS)
def c24(spark, sf):
    cells = layers(spark, sf).withColumn("z", F.col("z_mm").cast("double"))
    out = adaptive_filter(cells, "z", 1000.0, 1200.0, *K.extent(cells), water=F.col("swo") > 80, edited=F.col("edm").isin(2, 3), fill=F.col("edm") == 5)
    return out.select("r", "c", _round("filtered", 4).alias("filtered"), "filter_mask")


@query("c25_noise_removal", f"""
    WITH {UNBIASED}, {filtered_sql("clean", "corrected", 10)},
    {_gradient("adapted", "filtered", 1000.0, 1200.0).replace("grad AS", "fgrad AS").replace(" g AS", " fg AS").replace("FROM g)", "FROM fg)")}
    SELECT r, c, round(filtered, 4) + 0.0 AS filtered, filter_mask, CAST(floor(degrees(atan(sqrt(gx * gx + gy * gy)))) AS INT) AS slope FROM fgrad
    WHERE r BETWEEN 5 AND (SELECT max(r) FROM layers) - 5 AND c BETWEEN 5 AND 58""", LAYERS + "," + SAMPLES.strip()[4:])  # fmt: skip
def c25(spark, sf):
    from rillstone.plans.noise import noise_removal

    cells = layers(spark, sf).withColumn("z", F.col("z_mm").cast("double"))
    out = noise_removal(cells, cube(spark, sf), "z", 1000.0, 1200.0, *K.extent(cells), halo=5)
    return out.select("r", "c", _round("filtered", 4).alias("filtered"), "filter_mask", F.col("slope").cast("int").alias("slope"))


@query("v05_apply_bias_3d", f"WITH {UNBIASED} SELECT r, c, round(bias, 4) + 0.0 AS bias, round(corrected, 4) + 0.0 AS corrected FROM clean", LAYERS + "," + SAMPLES.strip()[4:])
def v05(spark, sf):
    from rillstone.operators.bias import apply_bias_3d

    cells = layers(spark, sf).withColumn("z", F.col("z_mm").cast("double"))
    out = apply_bias_3d(cells, cube(spark, sf), "z", 1000.0, 1200.0, *K.extent(cells), water=F.col("edm").isin(2, 3))
    return out.select("r", "c", _round("bias", 4).alias("bias"), _round("corrected", 4).alias("corrected"))


# scalar functions


@query("s01_strings", "SELECT page_id, substr(url, 1, 8) AS head, replace(url, '/', '|') AS bars, lower(url) AS low, lpad(CAST(page_id AS VARCHAR), 6, '0') AS padded, contains(url, 'en') AS has FROM pages")
def s01(spark, sf):
    return S.strings(table(spark, sf, "pages").select("page_id", "url"), "url", "page_id").drop("url")


@query("s02_math", "SELECT r, c, round(sqrt(abs(z_mm)), 6) AS root, round(degrees(atan(z_mm / 100.0)), 6) + 0.0 AS angle, CAST(floor(z_mm / 7.0) AS BIGINT) AS low, ((z_mm % 7) + 7) % 7 AS rest, greatest(z_mm, swo) AS top FROM layers", LAYERS)
def s02(spark, sf):
    out = S.arithmetic(layers(spark, sf), "z_mm", "swo")
    return out.select("r", "c", _round("root", 6).alias("root"), _round("angle", 6).alias("angle"), "low", "rest", "top")


@query("s03_casts", "SELECT r, c, CAST(trunc(z_mm / 100.0) AS INT) AS cut, CAST(swo > 50 AS INT) AS flag, CAST(least(127, greatest(-128, z_mm)) AS INT) AS byte FROM layers", LAYERS)
def s03(spark, sf):
    return S.casts(layers(spark, sf), "z_mm", "swo").select("r", "c", "cut", "flag", "byte")


@query("s04_nulls", "SELECT r, c, coalesce(tc, -1) AS filled, tc IS NULL AS missing, nullif(edm, 0) AS code FROM layers", LAYERS)
def s04(spark, sf):
    return S.nulls(layers(spark, sf), "tc", "edm").select("r", "c", "filled", "missing", "code")


@query("s05_arrays", "SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS positive, list_max(embedding) AS top, list_position(embedding, list_max(embedding)) AS place FROM embeddings")
def s05(spark, sf):
    out = S.arrays(table(spark, sf, "embeddings"), "embedding")
    return out.select("vec_id", F.col("positive").cast("long").alias("positive"), "top", F.col("place").cast("int").alias("place"))


@query("s06_maps", "SELECT fid, CASE fclass WHEN 'river' THEN 5 WHEN 'stream' THEN 6 WHEN 'canal' THEN 7 WHEN 'drain' THEN 8 ELSE -1 END AS code FROM features", FEATURES)
def s06(spark, sf):
    return S.map_lookup(features(spark, sf), "fclass", H.LINE_CLASSES, -1).select("fid", "code")


@query("s07_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def s07(spark, sf):
    return S.json_field(table(spark, sf, "events"), "props", "k").select("event_id", "k")


@query("s08_elapsed", "SELECT event_id, lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS elapsed FROM (SELECT event_id, CAST(user_id * 977 % 86400 AS BIGINT) AS s FROM events) q")
def s08(spark, sf):
    return S.elapsed(table(spark, sf, "events").selectExpr("event_id", "user_id * 977 % 86400 AS s"), "s").select("event_id", "elapsed")


@query("s09_random")
def s09(spark, sf):
    return S.sample(table(spark, sf, "events").select("event_id", "user_id"), 0.25, 11)
