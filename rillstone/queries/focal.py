"""Queries of the moving-window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import focal as K
from rillstone.queries.registry import query
from rillstone.sources.fixtures import LAYERS, layers



def _round(name: str, digits: int):
    """A rounded double without a negative zero."""
    return F.round(F.col(name).cast("double"), digits) + F.lit(0.0)


def _box(how: str, value: str, k: int) -> str:
    """SQL of a square window by two frames."""
    second = "sum" if how in ("sum", "count") else how
    return f"""
    WITH one AS (SELECT r, c, {how}({value}) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN {k} PRECEDING AND {k} FOLLOWING) AS v FROM layers)
    SELECT r, c, {second}(v) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN {k} PRECEDING AND {k} FOLLOWING) AS out FROM one"""


def _pad(k: int, columns: str = "z_mm", source: str = "layers", name: str = "padded") -> str:
    """SQL of a grid's columns with k mirrored rows and columns."""
    return f"""
    {name}_size AS (SELECT max(r) + 1 AS nr, max(c) + 1 AS nc FROM {source}),
    {name}_tall AS (SELECT r, c, {columns} FROM {source} UNION ALL SELECT -1 - r, c, {columns} FROM {source} WHERE r < {k}
             UNION ALL SELECT 2 * nr - 1 - r, c, {columns} FROM {source}, {name}_size WHERE r >= nr - {k}),
    {name} AS (SELECT r, c, {columns} FROM {name}_tall UNION ALL SELECT r, -1 - c, {columns} FROM {name}_tall WHERE c < {k}
               UNION ALL SELECT r, 2 * nc - 1 - c, {columns} FROM {name}_tall, {name}_size WHERE c >= nc - {k})"""


def ring_sql(source: str, name: str, value: str, kernels: dict[str, list[float]]) -> str:
    """Two common table expressions: normalized ring kernels over a padded grid, as weighted sums of square windows."""
    widest = max(len(w) for w in kernels.values())
    frame = "RANGE BETWEEN {j} PRECEDING AND {j} FOLLOWING"
    first = ", ".join(f"sum({value}) OVER (PARTITION BY r ORDER BY c {frame.format(j=j)}) AS b{j}" for j in range(widest))
    second = []
    for out, weights in kernels.items():
        parts = [f"sum(b{j}) OVER (PARTITION BY c ORDER BY r {frame.format(j=j)}) * CAST({w - after} AS DOUBLE)" for j, (w, after) in enumerate(zip(weights, [*weights[1:], 0.0], strict=True))]
        second.append(f"({' + '.join(parts)}) / CAST({sum(w for _, _, w in K.ring_offsets(weights))} AS DOUBLE) AS {out}")
    return f"{name}_b AS (SELECT r, c, {first} FROM {source}), {name} AS (SELECT r, c, {', '.join(second)} FROM {name}_b)"


def _kernel(weights: list[float]) -> str:
    return "(VALUES " + ", ".join(f"({i}, {j}, CAST({w} AS DOUBLE))" for i, j, w in K.ring_offsets(weights)) + ") AS k(i, j, w)"


def _ring(weights: list[float]) -> str:
    total = sum(w for _, _, w in K.ring_offsets(weights))
    return f"""
    WITH {_pad(len(weights) - 1)}
    SELECT l.r, l.c, round(sum(p.z_mm * k.w) / {total}, 4) + 0.0 AS out
    FROM layers l CROSS JOIN {_kernel(weights)} JOIN padded p ON p.r = l.r + k.i AND p.c = l.c + k.j GROUP BY l.r, l.c"""


GRADIENT = """
    g AS (SELECT *, {z} AS v, lag({z}) OVER (PARTITION BY r ORDER BY c) AS w, lead({z}) OVER (PARTITION BY r ORDER BY c) AS e,
                 lag({z}) OVER (PARTITION BY c ORDER BY r) AS n, lead({z}) OVER (PARTITION BY c ORDER BY r) AS s FROM {t}),
    grad AS (SELECT *, CASE WHEN w IS NULL THEN (e - v) / {dx} WHEN e IS NULL THEN (v - w) / {dx} ELSE (e - w) / (2 * {dx}) END AS gx,
                    CASE WHEN n IS NULL THEN (s - v) / {dy} WHEN s IS NULL THEN (v - n) / {dy} ELSE (s - n) / (2 * {dy}) END AS gy FROM g)"""


def _gradient(t: str = "layers", z: str = "CAST(z_mm AS DOUBLE)", dx: float = 100.0, dy: float = 120.0) -> str:
    return GRADIENT.format(t=t, z=z, dx=dx, dy=dy)


_SIDES = {"w": "lag(z_mm) OVER (PARTITION BY r ORDER BY c)", "e": "lead(z_mm) OVER (PARTITION BY r ORDER BY c)", "n": "lag(z_mm) OVER (PARTITION BY c ORDER BY r)", "s": "lead(z_mm) OVER (PARTITION BY c ORDER BY r)",
          "nw": "lag(z_mm) OVER (PARTITION BY r - c ORDER BY r)", "se": "lead(z_mm) OVER (PARTITION BY r - c ORDER BY r)", "ne": "lag(z_mm) OVER (PARTITION BY r + c ORDER BY r)", "sw": "lead(z_mm) OVER (PARTITION BY r + c ORDER BY r)"}
#: The eight neighbours of each cell of a whole rectangle.
NEAR = "near AS (SELECT r, c, z_mm AS z, " + ", ".join(f"{sql} AS {d}" for d, sql in _SIDES.items()) + " FROM {t})"


@query("c01_ring_kernel", f"SELECT k.i AS dr, k.j AS dc, k.w / 10.2 AS w, count(*) AS n, CAST(sum(l.z_mm) AS BIGINT) AS total FROM {_kernel([1.0, 0.7, 0.35])} JOIN layers l ON l.r + k.i >= 0 AND l.c + k.j BETWEEN 0 AND 63 GROUP BY 1, 2, 3", LAYERS)
def c01(spark, sf):
    # 25 rows of kernel
    kernel = K.ring_kernel(spark, [1.0, 0.7, 0.35]).withColumn("w", F.col("w") / 10.2)
    held = layers(spark, sf).join(F.broadcast(kernel), (F.col("r") + F.col("dr") >= 0) & (F.col("c") + F.col("dc")).between(0, 63))
    return held.groupBy("dr", "dc", "w").agg(F.count("*").alias("n"), F.sum("z_mm").alias("total"))


@query("c02_convolve", f"""
    WITH {_pad(1)}
    SELECT l.r, l.c, round(sum(p.z_mm * k.w), 4) + 0.0 AS out
    FROM layers l CROSS JOIN (VALUES (-1, 0, 0.25), (0, 0, 0.5), (1, 1, -0.125), (0, -1, 1.0)) AS k(i, j, w)
    JOIN padded p ON p.r = l.r + k.i AND p.c = l.c + k.j GROUP BY l.r, l.c""", LAYERS)  # fmt: skip
def c02(spark, sf):
    cells = layers(spark, sf).select("r", "c", "z_mm")
    out = K.convolve(cells, "z_mm", [(-1, 0, 0.25), (0, 0, 0.5), (1, 1, -0.125), (0, -1, 1.0)], *K.extent(cells))
    return out.select("r", "c", _round("out", 4).alias("out"))


def _smooth(weights):
    def run(spark, sf):
        cells = layers(spark, sf).select("r", "c", "z_mm")
        return K.ring_smooth(cells, "z_mm", {"out": weights}, *K.extent(cells)).select("r", "c", _round("out", 4).alias("out"))

    return run


for _size, _weights in ((3, [1.0, 0.5]), (5, [1.0, 0.7, 0.35]), (7, [1.0, 0.75, 0.5, 0.25]), (9, [1.0, 0.8, 0.6, 0.4, 0.2])):
    query(f"c03_smooth_bank_{_size}", _ring(_weights), LAYERS)(_smooth(_weights))


@query("c04_focal_min", _box("min", "z_mm", 4), LAYERS)
def c04(spark, sf):
    return K.focal_min(layers(spark, sf), "z_mm", 4).select("r", "c", "out")


@query("c05_focal_max", _box("max", "z_mm", 3), LAYERS)
def c05(spark, sf):
    return K.focal_max(layers(spark, sf), "z_mm", 3).select("r", "c", "out")


@query("c06_box_any", _box("max", "CASE WHEN edm = 5 THEN 1 ELSE 0 END", 2), LAYERS)
def c06(spark, sf):
    return K.box_any(layers(spark, sf), F.col("edm") == 5, 2).select("r", "c", "out")


@query("c07_box_count", _box("sum", "CASE WHEN swo > 80 THEN 1 ELSE 0 END", 1), LAYERS)
def c07(spark, sf):
    return K.box_count(layers(spark, sf), F.col("swo") > 80, 1).select("r", "c", "out")


@query("c08_binary_close", """
    WITH g1 AS (SELECT r, c, max(CASE WHEN swo > 80 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v FROM layers),
    g2 AS (SELECT r, c, max(v) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v FROM g1),
    e1 AS (SELECT r, c, min(v) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v,
                  count(*) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS n FROM g2)
    SELECT r, c, CASE WHEN sum(n) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) = 25
                 THEN min(v) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) ELSE 0 END AS out FROM e1""", LAYERS)  # fmt: skip
def c08(spark, sf):
    return K.binary_close(layers(spark, sf), F.col("swo") > 80, 2).select("r", "c", "out")


@query("c09_gradient", f"WITH {_gradient()} SELECT r, c, round(gx, 6) + 0.0 AS gx, round(gy, 6) + 0.0 AS gy FROM grad", LAYERS)
def c09(spark, sf):
    return K.gradient(layers(spark, sf), "z_mm", 100.0, 120.0).select("r", "c", _round("gx", 6).alias("gx"), _round("gy", 6).alias("gy"))


@query("c10_slope_d2", f"WITH {_gradient(dx=1000.0, dy=1200.0)} SELECT r, c, CAST(floor(degrees(atan(sqrt(gx*gx + gy*gy)))) AS INT) AS slope FROM grad", LAYERS)
def c10(spark, sf):
    return K.slope_d2(layers(spark, sf), "z_mm", 1000.0, 1200.0).select("r", "c", F.col("slope").cast("int").alias("slope"))


D4 = f"""
    WITH {_pad(1)}, {_gradient()}, {NEAR.format(t="padded")},
    d4 AS (SELECT g.r, g.c, -g.gx AS gx, (n.ne - n.sw) / (2 * sqrt(100.0*100.0 + 120.0*120.0)) AS gne, g.gy, (n.nw - n.se) / (2 * sqrt(100.0*100.0 + 120.0*120.0)) AS gnw
           FROM grad g JOIN near n ON g.r = n.r AND g.c = n.c)"""


@query("c11_gradient_d4", D4 + " SELECT r, c, round(gx, 6) + 0.0 AS gx, round(gne, 6) + 0.0 AS gne, round(gy, 6) + 0.0 AS gy, round(gnw, 6) + 0.0 AS gnw FROM d4", LAYERS)
def c11(spark, sf):
    cells = layers(spark, sf)
    out = K.gradient_d4(cells, "z_mm", 100.0, 120.0, *K.extent(cells))
    return out.select("r", "c", *[_round(x, 6).alias(x) for x in ("gx", "gne", "gy", "gnw")])


@query("c12_slope_d4", D4 + " SELECT r, c, CAST(floor(degrees(atan(greatest(abs(gx), abs(gne), abs(gy), abs(gnw))))) AS INT) AS slope FROM d4", LAYERS)
def c12(spark, sf):
    cells = layers(spark, sf)
    return K.slope_d4(cells, "z_mm", 100.0, 120.0, *K.extent(cells)).select("r", "c", F.col("slope").cast("int").alias("slope"))


@query("c13_curvature_d2", f"""
    WITH {_gradient()}, h AS (SELECT r, c, gx, gy,
      lag(gx) OVER (PARTITION BY r ORDER BY c) AS w, lead(gx) OVER (PARTITION BY r ORDER BY c) AS e,
      lag(gy) OVER (PARTITION BY c ORDER BY r) AS n, lead(gy) OVER (PARTITION BY c ORDER BY r) AS s FROM grad)
    SELECT r, c, round(CASE WHEN w IS NULL THEN (e - gx) / 100.0 WHEN e IS NULL THEN (gx - w) / 100.0 ELSE (e - w) / 200.0 END
               + CASE WHEN n IS NULL THEN (s - gy) / 120.0 WHEN s IS NULL THEN (gy - n) / 120.0 ELSE (s - n) / 240.0 END, 8) + 0.0 AS curvature FROM h""", LAYERS)  # fmt: skip
def c13(spark, sf):
    return K.curvature_d2(layers(spark, sf), "z_mm", 100.0, 120.0).select("r", "c", _round("curvature", 8).alias("curvature"))


@query("c14_curvature_d4", f"""
    WITH {_pad(1)}, {NEAR.format(t="padded")}
    SELECT n.r, n.c, round(((e + w - 2*z) / 10000.0 + (n.n + s - 2*z) / 14400.0 + (ne + sw - 2*z) / 24400.0 + (nw + se - 2*z) / 24400.0) / 2, 8) + 0.0 AS curvature
    FROM near n JOIN layers l ON n.r = l.r AND n.c = l.c""", LAYERS)  # fmt: skip
def c14(spark, sf):
    cells = layers(spark, sf)
    return K.curvature_d4(cells, "z_mm", 100.0, 120.0, *K.extent(cells)).select("r", "c", _round("curvature", 8).alias("curvature"))


@query("c15_aspect_d2", f"""
    WITH {_gradient()}, a AS (SELECT r, c, degrees(atan2(-gy, gx)) AS d FROM grad)
    SELECT r, c, CAST(round(CASE WHEN d < 0 THEN d + 360 ELSE d END / 10) AS INT) AS aspect FROM a""", LAYERS)  # fmt: skip
def c15(spark, sf):
    return K.aspect_d2(layers(spark, sf), "z_mm", 100.0, 120.0).select("r", "c", "aspect")


@query("c16_grad_operator", f"""
    WITH {NEAR.format(t="layers")}
    SELECT * FROM (SELECT r, c, 'x' AS dir, (e - w) / 2.0 AS d FROM near UNION ALL SELECT r, c, 'ne', (ne - sw) / 2.0 FROM near
      UNION ALL SELECT r, c, 'y', (s - n) / 2.0 FROM near UNION ALL SELECT r, c, 'nw', (nw - se) / 2.0 FROM near) q WHERE d IS NOT NULL""", LAYERS)  # fmt: skip
def c16(spark, sf):
    return K.grad_operator(layers(spark, sf), "z_mm")


_D8 = ["e", "ne", "n", "nw", "w", "sw", "s", "se"]


@query("c17_d8_differences", f"WITH {NEAR.format(t='layers')} " + " UNION ALL ".join(f"SELECT r, c, '{d}' AS dir, coalesce({d} - z, z - {_D8[(i + 4) % 8]}) AS diff FROM near" for i, d in enumerate(_D8)), LAYERS)
def c17(spark, sf):
    return K.d8_differences(layers(spark, sf), "z_mm")


@query("c18_laplacian", f"WITH {NEAR.format(t='layers')} SELECT r, c, coalesce(e - z, 0) + coalesce(w - z, 0) + coalesce(n - z, 0) + coalesce(s - z, 0) AS laplacian FROM near", LAYERS)
def c18(spark, sf):
    return K.laplacian(layers(spark, sf), "z_mm").select("r", "c", "laplacian")


@query("c19_smooth_edge_normalised", f"""
    SELECT l.r, l.c, round(sum(p.z_mm * k.w) / sum(k.w), 4) + 0.0 AS out FROM layers l CROSS JOIN {_kernel([1.0, 0.5])}
    JOIN layers p ON p.r = l.r + k.i AND p.c = l.c + k.j GROUP BY l.r, l.c""", LAYERS)  # fmt: skip
def c19(spark, sf):
    return K.smooth_edge_normalised(layers(spark, sf), "z_mm", [1.0, 0.5]).select("r", "c", _round("out", 4).alias("out"))


@query("c20_pin_boundary_rows", f"""
    SELECT l.r, l.c, CASE WHEN l.edm = 4 THEN CAST(any_value(l.z_mm) AS DOUBLE) ELSE round(sum(p.z_mm * k.w) / sum(k.w), 4) + 0.0 END AS out
    FROM layers l CROSS JOIN {_kernel([1.0, 0.5])} JOIN layers p ON p.r = l.r + k.i AND p.c = l.c + k.j GROUP BY l.r, l.c, l.edm""", LAYERS)  # fmt: skip
def c20(spark, sf):
    return K.smooth_edge_normalised(layers(spark, sf), "z_mm", [1.0, 0.5], pinned=F.col("edm") == 4).select("r", "c", _round("out", 4).alias("out"))


@query("c21_fill_missing", """
    WITH h AS (SELECT r, c, CASE WHEN edm = 5 THEN NULL ELSE z_mm END AS z FROM layers),
    o AS (SELECT i, j FROM range(-5, 6) a(i), range(-5, 6) b(j) WHERE i <> 0 OR j <> 0),
    m AS (SELECT x.r, x.c, sum(h.z / power(sqrt(o.i*o.i + o.j*o.j), 2.0)) / sum(1 / power(sqrt(o.i*o.i + o.j*o.j), 2.0)) AS v
          FROM h x CROSS JOIN o JOIN h ON h.r = x.r + o.i AND h.c = x.c + o.j WHERE x.z IS NULL AND h.z IS NOT NULL GROUP BY x.r, x.c)
    SELECT h.r, h.c, round(coalesce(CAST(h.z AS DOUBLE), m.v), 4) + 0.0 AS z FROM h LEFT JOIN m ON h.r = m.r AND h.c = m.c""", LAYERS)  # fmt: skip
def c21(spark, sf):
    cells = layers(spark, sf).select("r", "c", F.when(F.col("edm") != 5, F.col("z_mm")).alias("z"))
    return K.fill_missing(cells, "z", 5).select("r", "c", _round("z", 4).alias("z"))


@query("c22_fill_leftover_mean", """
    WITH h AS (SELECT r, c, tc, CASE WHEN tc IS NULL THEN 1 ELSE 0 END AS m FROM layers),
    a AS (SELECT r, c, tc, max(m) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM h),
    b AS (SELECT r, c, tc, max(m) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM a)
    SELECT r, c, round(CASE WHEN m = 1 THEN (SELECT avg(tc) FROM b WHERE m = 1) ELSE tc END, 6) + 0.0 AS tc FROM b""", LAYERS)  # fmt: skip
def c22(spark, sf):
    return K.fill_leftover_mean(layers(spark, sf).select("r", "c", "tc"), "tc", 2).select("r", "c", _round("tc", 6).alias("tc"))


@query("c23_convolve1d", """
    WITH s AS (SELECT c, th, sum(z_mm) AS v FROM layers GROUP BY c, th),
    k AS (SELECT * FROM (VALUES (-2, 0.25), (-1, 0.5), (0, 1.0), (1, 0.5), (2, 0.25)) AS k(d, w)),
    p AS (SELECT c, th, v FROM s UNION ALL SELECT c, -1 - th, v FROM s WHERE th < 2 UNION ALL SELECT c, 61 - th, v FROM s WHERE th > 28)
    SELECT s.c, s.th, round(sum(p.v * k.w) / 2.5, 4) + 0.0 AS out FROM s CROSS JOIN k JOIN p ON p.c = s.c AND p.th = s.th + k.d GROUP BY s.c, s.th""", LAYERS)  # fmt: skip
def c23(spark, sf):
    table = layers(spark, sf).groupBy("c", "th").agg(F.sum("z_mm").alias("v"))
    return K.convolve1d(table, "th", ["c"], "v", [0.25, 0.5, 1.0, 0.5, 0.25], 0, 30).select("c", "th", _round("out", 4).alias("out"))


@query("m01_neighbour", "SELECT r, c, lag(z_mm) OVER (PARTITION BY r ORDER BY c) AS west, lead(z_mm) OVER (PARTITION BY c ORDER BY r) AS south FROM layers", LAYERS)
def m01(spark, sf):
    return K.neighbours(layers(spark, sf).select("r", "c", "z_mm"), "z_mm").select("r", "c", F.col("w").alias("west"), F.col("s").alias("south"))


@query("m02_centred_frame", "SELECT r, c, sum(z_mm) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS s, min(z_mm) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS m FROM layers", LAYERS)
def m02(spark, sf):
    return layers(spark, sf).select("r", "c", F.sum("z_mm").over(K.row_frame(7)).alias("s"), F.min("z_mm").over(K.column_frame(7)).alias("m"))


@query("m03_diagonal_frame", f"WITH {NEAR.format(t='layers')} SELECT r, c, ne - sw AS ne_sw, nw - se AS nw_se FROM near", LAYERS)
def m03(spark, sf):
    return K.neighbours(layers(spark, sf).select("r", "c", "z_mm"), "z_mm").select("r", "c", (F.col("ne") - F.col("sw")).alias("ne_sw"), (F.col("nw") - F.col("se")).alias("nw_se"))
