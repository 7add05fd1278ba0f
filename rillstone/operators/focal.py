"""Moving-window operators on cells (keys..., r, c, values), as range frames over rows and columns.

A cell table holds one row per cell; keys name the columns that tell grids apart.  A square window
is a frame along rows and then one along columns, which is exact for minimum, maximum, sum and
count; diagonals are frames within r - c and r + c.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rillstone.operators.tiles import SIDE, map_tiles, places_of

AGGREGATES = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
_SECOND = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}


def row_frame(k: int, keys: Sequence[str] = ()) -> Window:
    return Window.partitionBy(*keys, "r").orderBy("c").rangeBetween(-k, k)


def column_frame(k: int, keys: Sequence[str] = ()) -> Window:
    return Window.partitionBy(*keys, "c").orderBy("r").rangeBetween(-k, k)


def moving(cells: DataFrame, outputs: dict[str, tuple[str, str, int]], keys: Sequence[str] = ()) -> DataFrame:
    """Square windows: outputs names (aggregate, value column, half width); all share two shuffles."""
    first = {f"_{name}": AGGREGATES[how](F.col(value)).over(row_frame(k, keys)) for name, (how, value, k) in outputs.items()}
    second = {name: _SECOND[how](F.col(f"_{name}")).over(column_frame(k, keys)) for name, (how, _, k) in outputs.items()}
    return cells.withColumns(first).withColumns(second).drop(*first)


def focal_min(cells: DataFrame, value: str, k: int, out: str = "out", keys: Sequence[str] = ()) -> DataFrame:
    """Minimum over the (2k+1) x (2k+1) cells around each cell."""
    return moving(cells, {out: ("min", value, k)}, keys)


def focal_max(cells: DataFrame, value: str, k: int, out: str = "out", keys: Sequence[str] = ()) -> DataFrame:
    """Maximum over the window; on a 0/1 mask, its dilation."""
    return moving(cells, {out: ("max", value, k)}, keys)


def box_any(cells: DataFrame, mask: Column, k: int, out: str = "out", keys: Sequence[str] = ()) -> DataFrame:
    """1 where any cell of the window has the mask, else 0."""
    return moving(cells.withColumn("_m", mask.cast("int")), {out: ("max", "_m", k)}, keys).drop("_m")


def box_count(cells: DataFrame, mask: Column, k: int, out: str = "out", keys: Sequence[str] = ()) -> DataFrame:
    """How many cells of the window have the mask."""
    return moving(cells.withColumn("_m", mask.cast("int")), {out: ("sum", "_m", k)}, keys).drop("_m")


def binary_close(cells: DataFrame, mask: Column, k: int, out: str = "out", keys: Sequence[str] = ()) -> DataFrame:
    """Closing: dilation, then erosion that takes cells outside the grid as 0."""
    grown = box_any(cells, mask, k, "_g", keys)
    both = moving(grown, {"_lo": ("min", "_g", k), "_n": ("count", "_g", k)}, keys)
    return both.withColumn(out, F.when(F.col("_n") == (2 * k + 1) ** 2, F.col("_lo")).otherwise(0)).drop("_g", "_lo", "_n")


def pad_symmetric(cells: DataFrame, k: int, n_rows: int, n_cols: int) -> DataFrame:
    """cells with k mirrored rows and columns on each side (the edge cell is repeated)."""

    def mirrored(name: str, n: int) -> Column:
        x = F.col(name)
        return F.explode(F.array_compact(F.array(x, F.when(x < k, -1 - x), F.when(x >= n - k, 2 * n - 1 - x))))

    return cells.withColumn("r", mirrored("r", n_rows)).withColumn("c", mirrored("c", n_cols))


def ring_offsets(weights: Sequence[float]) -> list[tuple[int, int, float]]:
    """The kernel of weights given from the centre outward: (row offset, column offset, weight)."""
    k = len(weights) - 1
    return [(i, j, float(weights[max(abs(i), abs(j))])) for i in range(-k, k + 1) for j in range(-k, k + 1)]


def ring_kernel(spark, weights: Sequence[float], normalize: bool = False) -> DataFrame:
    """ring_offsets as a table dr, dc, w; normalized weights add up to 1."""
    k = len(weights) - 1
    steps = spark.range(-k, k + 1)
    ring = F.greatest(F.abs("dr"), F.abs("dc"))
    both = steps.select(F.col("id").alias("dr"), F.explode(F.sequence(F.lit(-k).cast("long"), F.lit(k).cast("long"))).alias("dc"))
    total = sum(w for _, _, w in ring_offsets(weights)) if normalize else 1.0
    return both.withColumn("w", F.element_at(F.array(*[F.lit(float(w) / total) for w in weights]), (ring + 1).cast("int")))


def ring_smooth(cells: DataFrame, value: str, kernels: dict[str, Sequence[float]], n_rows: int, n_cols: int, keys: Sequence[str] = ()) -> DataFrame:
    """Normalized ring kernels with mirrored edges: a weighted sum of box sums, all from one padding.

    kernels names outputs and their weights from the centre outward.
    """
    k = max(len(w) for w in kernels.values()) - 1
    padded = pad_symmetric(cells, k, n_rows, n_cols)
    boxes = {f"_s{j}": ("sum", value, j) for j in range(1, k + 1)}
    summed = moving(padded, boxes, keys).withColumn("_s0", F.col(value))
    summed = summed.where(F.col("r").between(0, n_rows - 1) & F.col("c").between(0, n_cols - 1))

    def kernel(weights: Sequence[float]) -> Column:
        weights = [float(w) for w in weights]
        steps = [(j, w - after) for j, (w, after) in enumerate(zip(weights, [*weights[1:], 0.0], strict=True))]
        total = sum(w for _, _, w in ring_offsets(weights))
        return sum((F.col(f"_s{j}") * d for j, d in steps if d), F.lit(0.0)) / total

    return summed.withColumns({name: kernel(w) for name, w in kernels.items()}).drop("_s0", *boxes)


def convolve(cells: DataFrame, value: str, kernel: Sequence[tuple[int, int, float]], n_rows: int, n_cols: int, out: str = "out", keys: Sequence[str] = ()) -> DataFrame:
    """Any kernel (row offset, column offset, weight), mirrored edges: each cell sends its weighted value to its neighbours."""
    k = max(max(abs(i), abs(j)) for i, j, _ in kernel)
    send = F.explode(F.array(*[F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc"), F.lit(float(w)).alias("w")) for i, j, w in kernel]))
    sent = pad_symmetric(cells.select(*keys, "r", "c", value), k, n_rows, n_cols).withColumn("s", send)
    sent = sent.select(*keys, (F.col("r") - F.col("s.dr")).alias("r"), (F.col("c") - F.col("s.dc")).alias("c"), (F.col(value) * F.col("s.w")).alias("_v"))
    sent = sent.where(F.col("r").between(0, n_rows - 1) & F.col("c").between(0, n_cols - 1))
    return cells.join(sent.groupBy(*keys, "r", "c").agg(F.sum("_v").alias(out)), [*keys, "r", "c"], "left")


def smooth_edge_normalised(cells: DataFrame, value: str, weights: Sequence[float], out: str = "out", keys: Sequence[str] = (), pinned: Column | None = None) -> DataFrame:
    """Ring smoothing whose weights add up to 1 over the cells that exist; pinned cells keep their value."""
    k = len(weights) - 1
    boxes = {f"_s{j}": ("sum", value, j) for j in range(k + 1)} | {f"_n{j}": ("count", value, j) for j in range(k + 1)}
    steps = [float(w) - float(a) for w, a in zip(weights, [*weights[1:], 0.0], strict=True)]
    mean = sum((F.col(f"_s{j}") * d for j, d in enumerate(steps)), F.lit(0.0)) / sum((F.col(f"_n{j}") * d for j, d in enumerate(steps)), F.lit(0.0))
    smooth = moving(cells, boxes, keys).withColumn(out, mean).drop(*boxes)
    return smooth if pinned is None else smooth.withColumn(out, F.when(pinned, F.col(value)).otherwise(F.col(out)))


def neighbours(cells: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """The eight neighbours' values as e, ne, n, nw, w, sw, s, se (null outside); north is the smaller r."""
    step = F.first(value)

    def at(window: Window, k: int) -> Column:
        return step.over(window.rangeBetween(k, k))

    row, col = Window.partitionBy(*keys, "r").orderBy("c"), Window.partitionBy(*keys, "c").orderBy("r")
    down, up = Window.partitionBy(*keys, F.col("r") - F.col("c")).orderBy("r"), Window.partitionBy(*keys, F.col("r") + F.col("c")).orderBy("r")
    return cells.withColumns({"e": at(row, 1), "w": at(row, -1), "n": at(col, -1), "s": at(col, 1), "nw": at(down, -1), "se": at(down, 1), "ne": at(up, -1), "sw": at(up, 1)})


def gradient(cells: DataFrame, value: str, dx: float, dy: float, keys: Sequence[str] = (), gx: str = "gx", gy: str = "gy") -> DataFrame:
    """Central differences along c and r, one-sided at the edges."""

    def along(axis: str, other: str, step: float) -> Column:
        w = Window.partitionBy(*keys, other).orderBy(axis)
        before, after = F.first(value).over(w.rangeBetween(-1, -1)), F.first(value).over(w.rangeBetween(1, 1))
        return F.when(before.isNull(), (after - F.col(value)) / step).when(after.isNull(), (F.col(value) - before) / step).otherwise((after - before) / (2 * step))

    return cells.withColumns({gx: along("c", "r", dx), gy: along("r", "c", dy)})


def slope_d2(cells: DataFrame, value: str, dx: float, dy: float, keys: Sequence[str] = (), out: str = "slope", degrees: bool = True) -> DataFrame:
    """Length of the gradient; in degrees it is cut to a whole number."""
    steep = F.sqrt(F.col("_gx") ** 2 + F.col("_gy") ** 2)
    found = gradient(cells, value, dx, dy, keys, "_gx", "_gy").withColumn(out, F.degrees(F.atan(steep)).cast("tinyint") if degrees else steep)
    return found.drop("_gx", "_gy")


def gradient_d4(cells: DataFrame, value: str, dx: float, dy: float, n_rows: int, n_cols: int, keys: Sequence[str] = ()) -> DataFrame:
    """Central differences in four directions: gx (westward), gne, gy (southward) and gnw; mirrored edges on the diagonals."""
    flat = gradient(cells, value, dx, dy, keys, "_gx", "_gy")
    sides = neighbours(pad_symmetric(cells.select(*keys, "r", "c", value), 1, n_rows, n_cols), value, keys)
    sides = sides.where(F.col("r").between(0, n_rows - 1) & F.col("c").between(0, n_cols - 1)).select(*keys, "r", "c", "ne", "sw", "nw", "se")
    step = 2 * (dx * dx + dy * dy) ** 0.5
    both = flat.join(sides, [*keys, "r", "c"])
    out = {"gx": -F.col("_gx"), "gne": (F.col("ne") - F.col("sw")) / step, "gy": F.col("_gy"), "gnw": (F.col("nw") - F.col("se")) / step}
    return both.withColumns(out).drop("_gx", "_gy", "ne", "sw", "nw", "se")


def slope_d4(cells: DataFrame, value: str, dx: float, dy: float, n_rows: int, n_cols: int, keys: Sequence[str] = (), out: str = "slope") -> DataFrame:
    """The steepest of the four directions, in whole degrees."""
    four = gradient_d4(cells, value, dx, dy, n_rows, n_cols, keys)
    return four.withColumn(out, F.degrees(F.atan(F.greatest(F.abs("gx"), F.abs("gne"), F.abs("gy"), F.abs("gnw")))).cast("tinyint")).drop("gx", "gne", "gy", "gnw")


def curvature_d2(cells: DataFrame, value: str, dx: float, dy: float, keys: Sequence[str] = (), out: str = "curvature", geometric: bool = False) -> DataFrame:
    """Divergence of the gradient; geometric: of the gradient over slope + 0.1."""
    g = gradient(cells, value, dx, dy, keys, "_gx", "_gy")
    if geometric:
        length = F.sqrt(F.col("_gx") ** 2 + F.col("_gy") ** 2) + 0.1
        g = g.withColumns({"_gx": F.col("_gx") / length, "_gy": F.col("_gy") / length})
    xx = gradient(g, "_gx", dx, dy, keys, "_gxx", "_u")
    yy = gradient(xx.drop("_u"), "_gy", dx, dy, keys, "_u", "_gyy")
    return yy.withColumn(out, F.col("_gxx") + F.col("_gyy")).drop("_gx", "_gy", "_gxx", "_gyy", "_u")


def curvature_d4(cells: DataFrame, value: str, dx: float, dy: float, n_rows: int, n_cols: int, keys: Sequence[str] = (), out: str = "curvature", geometric: bool = False) -> DataFrame:
    """Divergence over four directions: half the sum of second differences along rows, columns and diagonals, mirrored edges.

    Geometric: the sum, over the directions, of central differences of gradient_d4, each pair (rows and
    columns, the diagonals) first divided by its length + 0.1; one-sided at edges of rows and columns, mirrored on diagonals.
    """
    if geometric:
        four = gradient_d4(cells, value, dx, dy, n_rows, n_cols, keys)
        flat, slant = (F.sqrt(F.col(a) ** 2 + F.col(b) ** 2) + 0.1 for a, b in (("gx", "gy"), ("gne", "gnw")))
        unit = four.select(*keys, "r", "c", (F.col("gx") / flat).alias("_x"), (F.col("gne") / slant).alias("_ne"), (F.col("gy") / flat).alias("_y"), (F.col("gnw") / slant).alias("_nw"))
        along = gradient(gradient(unit, "_x", dx, dy, keys, "_xx", "_u").drop("_u"), "_y", dx, dy, keys, "_u", "_yy").drop("_u")
        step = 2 * (dx * dx + dy * dy) ** 0.5
        for name, (a, b) in (("_ne", ("ne", "sw")), ("_nw", ("nw", "se"))):
            sides = neighbours(pad_symmetric(unit.select(*keys, "r", "c", name), 1, n_rows, n_cols), name, keys)
            along = along.join(sides.select(*keys, "r", "c", ((F.col(a) - F.col(b)) / step).alias(f"_{name}")), [*keys, "r", "c"])
        # gx points west, so its difference along the row is that of -gx
        return cells.join(along.select(*keys, "r", "c", (F.col("_yy") - F.col("_xx") + F.col("__ne") + F.col("__nw")).alias(out)), [*keys, "r", "c"])
    padded = neighbours(pad_symmetric(cells.select(*keys, "r", "c", value), 1, n_rows, n_cols), value, keys)
    z, diagonal = F.col(value), dx * dx + dy * dy
    total = (F.col("e") + F.col("w") - 2 * z) / (dx * dx) + (F.col("n") + F.col("s") - 2 * z) / (dy * dy) + (F.col("ne") + F.col("sw") - 2 * z) / diagonal + (F.col("nw") + F.col("se") - 2 * z) / diagonal
    found = padded.where(F.col("r").between(0, n_rows - 1) & F.col("c").between(0, n_cols - 1)).select(*keys, "r", "c", (total / 2).alias(out))
    return cells.join(found, [*keys, "r", "c"])


def aspect_d2(cells: DataFrame, value: str, dx: float, dy: float, keys: Sequence[str] = (), out: str = "aspect") -> DataFrame:
    """Direction of the gradient, counter-clockwise from east, in tens of degrees from 0 to 36."""
    g = gradient(cells, value, dx, dy, keys, "_gx", "_gy")
    angle = F.degrees(F.atan2(-F.col("_gy"), F.col("_gx")))
    return g.withColumn(out, F.round(F.when(angle < 0, angle + 360).otherwise(angle) / 10).cast("int")).drop("_gx", "_gy")


def d8_differences(cells: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Eight rows a cell: (dir, diff) with diff = neighbour - cell; at the edge, minus the opposite difference."""
    names = ["e", "ne", "n", "nw", "w", "sw", "s", "se"]
    near = neighbours(cells, value, keys)
    diff = [F.coalesce(F.col(d) - F.col(value), F.col(value) - F.col(names[(i + 4) % 8])) for i, d in enumerate(names)]
    entry = F.explode(F.array(*[F.struct(F.lit(d).alias("dir"), x.alias("diff")) for d, x in zip(names, diff, strict=True)])).alias("_d")
    return near.select(*keys, "r", "c", entry).select(*keys, "r", "c", "_d.dir", "_d.diff")


def grad_operator(cells: DataFrame, value: str, scheme: str = "central", directions: int = 4, keys: Sequence[str] = ()) -> DataFrame:
    """Differences in 2 (x, y) or 4 (x, ne, y, nw) directions as rows (dir, d); forward or halved central, null past the edge."""
    near = neighbours(cells, value, keys)
    pairs = {"x": ("e", "w"), "y": ("s", "n")} if directions == 2 else {"x": ("e", "w"), "ne": ("ne", "sw"), "y": ("s", "n"), "nw": ("nw", "se")}
    z = F.col(value)
    rows = [F.struct(F.lit(d).alias("dir"), (F.col(a) - z if scheme == "forward" else (F.col(a) - F.col(b)) / 2).alias("d")) for d, (a, b) in pairs.items()]
    return near.select(*keys, "r", "c", F.explode(F.array(*rows)).alias("_d")).select(*keys, "r", "c", "_d.dir", "_d.d").where("d is not null")


def laplacian(cells: DataFrame, value: str, keys: Sequence[str] = (), out: str = "laplacian") -> DataFrame:
    """Sum over the four side neighbours that exist of neighbour - cell."""
    near = neighbours(cells, value, keys)
    total = sum((F.coalesce(F.col(d) - F.col(value), F.lit(0)) for d in ("e", "w", "n", "s")), F.lit(0))
    return near.select(*cells.columns, total.alias(out))


def fill_missing(cells: DataFrame, value: str, k: int, power: float = 2.0, keys: Sequence[str] = ()) -> DataFrame:
    """Null cells take the inverse-distance mean of the valid cells within k; others stay.  A tile holds all that its null cells look at, so cells move once."""
    place = cells.columns.index(value)
    schema = StructType([StructField(value, DoubleType()) if f.name == value else f for f in cells.schema])
    offsets = [(i, j, 1.0 / ((i * i + j * j) ** 0.5) ** power) for i in range(-k, k + 1) for j in range(-k, k + 1) if i or j]

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, k)
        core = (i >= k) & (i < k + SIDE) & (j >= k) & (j < k + SIDE)
        if not core.any():
            return None
        column = table.column(place).cast(pa.float64())
        held = column.is_valid().to_numpy()
        z, known = np.zeros((SIDE + 2 * k, SIDE + 2 * k)), np.zeros((SIDE + 2 * k, SIDE + 2 * k))
        z[i[held], j[held]], known[i[held], j[held]] = column.drop_null().to_numpy(), 1.0
        holes = np.flatnonzero(core & ~held)
        total, weight = np.zeros(len(holes)), np.zeros(len(holes))
        for di, dj, w in offsets:
            at = i[holes] + di, j[holes] + dj
            total += w * z[at]
            weight += w * known[at]
        new, valid = column.fill_null(0.0).to_numpy().copy(), held.copy()
        found = weight > 0
        new[holes[found]] = total[found] / weight[found]
        valid[holes[found]] = True
        return table.set_column(place, value, pa.array(new, mask=~valid)).filter(pa.array(core))

    return map_tiles(cells, k, run, schema, keys)


def fill_leftover_mean(cells: DataFrame, value: str, k: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """Null cells and all within k of one take the mean of the valid cells within k of a null cell of their grid."""
    near = box_any(cells, F.col(value).isNull(), k, "_near", keys)
    mean = near.where("_near = 1").groupBy(*keys).agg(F.avg(value).alias("_mean"))
    joined = near.join(mean, list(keys)) if keys else near.join(F.broadcast(mean), F.lit(True), "left")
    return joined.withColumn(value, F.when(F.col("_near") == 1, F.coalesce("_mean", F.col(value))).otherwise(F.col(value))).drop("_near", "_mean")


def convolve1d(table: DataFrame, axis: str, others: Sequence[str], value: str, weights: Sequence[float], lo: int, hi: int, out: str = "out") -> DataFrame:
    """Weights (odd, centred) along one axis of a table whose axis runs from lo to hi, mirrored edges, normalized."""
    k = len(weights) // 2
    x = F.col(axis)
    mirrored = F.array_compact(F.array(x, F.when(x - lo < k, 2 * lo - 1 - x), F.when(hi - x < k, 2 * hi + 1 - x)))
    sent = table.select(*others, F.explode(mirrored).alias("_x"), F.col(value).alias("_v"))
    to = F.explode(F.array(*[F.struct(F.lit(i - k).alias("d"), F.lit(float(w) / sum(weights)).alias("w")) for i, w in enumerate(weights)]))
    sent = sent.withColumn("_s", to).select(*others, (F.col("_x") + F.col("_s.d")).alias(axis), (F.col("_v") * F.col("_s.w")).alias("_p"))
    return sent.where(F.col(axis).between(lo, hi)).groupBy(*others, axis).agg(F.sum("_p").alias(out))


def extent(cells: DataFrame) -> tuple[int, int]:
    """Rows and columns of a single grid whose indices start at 0."""
    top = cells.agg((F.max("r") + 1).alias("r"), (F.max("c") + 1).alias("c")).first()
    return int(top["r"] or 0), int(top["c"] or 0)
