"""Grids as tables of cells: storage, addressing, clipping, mosaics, recoding.

A grid is described by a row (x0, dx, y0, dy, n_rows, n_cols) with square-to-axis pixels and y
falling with r.  Cells are rows (keys..., r, c, layers...); blocks hold h x w cells in an array.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.operators.focal import moving

METRES_PER_DEGREE = 111e3


@dataclass(frozen=True)
class Grid:
    x0: float
    dx: float
    y0: float
    dy: float
    n_rows: int
    n_cols: int


# storage


def to_blocks(cells: DataFrame, values: Sequence[str], size: int = 64, keys: Sequence[str] = ()) -> DataFrame:
    """Blocks (keys..., br, bc, layer, vals) of size x size cells in row-major order; a cell that is missing is null."""
    at = ((F.col("r") % size) * size + F.col("c") % size).cast("int")
    long = cells.select(*keys, F.floor(F.col("r") / size).alias("br"), F.floor(F.col("c") / size).alias("bc"), at.alias("_i"), *values)
    long = long.unpivot([*keys, "br", "bc", "_i"], list(values), "layer", "v")
    on = [*keys, "br", "bc", "layer", "_i"]
    places = long.select(*on[:-1]).distinct().withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(size * size - 1))))
    ordered = F.array_sort(F.collect_list(F.struct("_i", "v")))
    return places.join(long, on, "left").groupBy(*on[:-1]).agg(F.transform(ordered, lambda x: x["v"]).alias("vals"))


def from_blocks(blocks: DataFrame, layer: str, size: int = 64, keys: Sequence[str] = (), box: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Cells of one layer; box (r0, c0, r1, c1, ends included) prunes whole blocks first, then cells."""
    if box:
        r0, c0, r1, c1 = box
        blocks = blocks.where(F.col("br").between(r0 // size, r1 // size) & F.col("bc").between(c0 // size, c1 // size))
    out = blocks.where(F.col("layer") == layer).select(*keys, "br", "bc", F.posexplode("vals").alias("_i", "v")).where("v is not null")
    out = out.select(*keys, (F.col("br") * size + F.floor(F.col("_i") / size)).alias("r"), (F.col("bc") * size + F.col("_i") % size).alias("c"), "v")
    return out.where(F.col("r").between(r0, r1) & F.col("c").between(c0, c1)) if box else out


def grid_from_arrays(rows: DataFrame, row_id: str, values: str, out: str = "v") -> DataFrame:
    """A table with one array per grid row, as cells."""
    return rows.select(F.col(row_id).alias("r"), F.posexplode(values).alias("c", out))


def pack_rows(cells: DataFrame, value: str, keys: Sequence[str] = (), out: str = "vals") -> DataFrame:
    """One array per grid row, in order of c."""
    ordered = F.array_sort(F.collect_list(F.struct("c", F.col(value).alias("v"))))
    return cells.groupBy(*keys, "r").agg(F.transform(ordered, lambda x: x["v"]).alias(out))


def compact_layer(cells: DataFrame, value: str) -> DataFrame:
    """The layer as single-precision numbers."""
    return cells.withColumn(value, F.col(value).cast("float"))


def set_nodata(cells: DataFrame, value: str, source: float | None, target: float | None) -> DataFrame:
    """Recode no-data: source (None: null) becomes target (None: null)."""
    x = F.col(value)
    new = F.nullif(x, F.lit(source)) if source is not None else x
    return cells.withColumn(value, F.coalesce(new, F.lit(target)) if target is not None else new)


# addressing


def cell_to_xy(cells: DataFrame, grid: Grid) -> DataFrame:
    """Adds x, y of the pixel centre."""
    return cells.withColumns({"x": F.lit(grid.x0) + F.col("c") * grid.dx + grid.dx / 2, "y": F.lit(grid.y0) - F.col("r") * grid.dy - grid.dy / 2})


def xy_to_cell(points: DataFrame, grid: Grid) -> DataFrame:
    """Adds r, c, cut towards zero."""
    return points.withColumns({"c": ((F.col("x") - grid.x0) / grid.dx).cast("int"), "r": ((F.lit(grid.y0) - F.col("y")) / grid.dy).cast("int")})


def bounds(df: DataFrame, keys: Sequence[str] = (), box: tuple[str, str, str, str] = ("c0", "r0", "c1", "r1")) -> DataFrame:
    """The smallest box around all of a group's boxes."""
    x0, y0, x1, y1 = box
    return df.groupBy(*keys).agg(F.min(x0).alias("xmin"), F.min(y0).alias("ymin"), F.max(x1).alias("xmax"), F.max(y1).alias("ymax"))


def tile_bbox(tiles: DataFrame, tile: str = "tile") -> DataFrame:
    """xmin, ymin, xmax, ymax of one-degree tiles named like N39E047; S and W count down."""
    lat, lon = F.substring(tile, 2, 2).cast("int"), F.substring(tile, 5, 3).cast("int")
    south, west = F.substring(tile, 1, 1) == "S", F.substring(tile, 4, 1) == "W"
    y, x = F.when(south, -lat).otherwise(lat), F.when(west, -lon).otherwise(lon)
    return tiles.withColumns({"xmin": x, "ymin": y, "xmax": x + 1, "ymax": y + 1})


def parent_tile(tiles: DataFrame, scheme: str, tile: str = "tile", out: str = "parent") -> DataFrame:
    """Name of the enclosing coarse tile: water 10 degrees (70E_40N), osm and terrain 5 degrees (n35e045), cover 3 degrees (N39E045).

    Water tiles are named by their upper left corner, the others by their lower left one; west and
    south count away from zero.
    """
    lat, lon = F.substring(tile, 2, 2).cast("int"), F.substring(tile, 5, 3).cast("int")
    ns, ew = F.substring(tile, 1, 1), F.substring(tile, 4, 1)
    if scheme == "water":
        x = F.when(ew == "E", lon - lon % 10).otherwise(lon - lon % 10 + 10)
        y = F.floor((lat - 1) / 10) * 10 + F.when(ns == "N", 10).otherwise(0)
        side = F.when(y == 0, "N").otherwise(ns)
        return tiles.withColumn(out, F.format_string("%d%s_%d%s", x, ew, y.cast("int"), side))
    step = 3 if scheme == "cover" else 5
    x = F.when(ew == "E", lon - lon % step).otherwise(lon + (step - lon % step))
    y = F.when(ns == "N", lat - lat % step).otherwise(lat + (step - lat % step))
    ns, ew = (ns, ew) if scheme == "cover" else (F.lower(ns), F.lower(ew))
    return tiles.withColumn(out, F.format_string("%s%02d%s%03d", ns, y, ew, x))


def fishnet(boxes: DataFrame, step: float, buffer: float = 0.0) -> DataFrame:
    """Square boxes of side step over each row's box (xmin, ymin, xmax, ymax), each grown by buffer."""
    i = F.explode(F.sequence(F.lit(0), F.ceil((F.col("xmax") - F.col("xmin")) / step).cast("int") - 1))
    j = F.explode(F.sequence(F.lit(0), F.ceil((F.col("ymax") - F.col("ymin")) / step).cast("int") - 1))
    cut = boxes.withColumn("i", i).withColumn("j", j)
    x, y = F.col("xmin") + F.col("i") * step, F.col("ymin") + F.col("j") * step
    return cut.withColumns({"bx0": x - buffer, "by0": y - buffer, "bx1": x + step + buffer, "by1": y + step + buffer})


def cell_size_m(grids: DataFrame) -> DataFrame:
    """Metres per cell, dy_m and dx_m, at the grid's middle latitude (columns y0, dy, n_rows, dx)."""
    middle = F.col("y0") - F.col("dy") * F.col("n_rows") / 2
    return grids.withColumns({"dy_m": F.col("dy") * METRES_PER_DEGREE, "dx_m": F.col("dx") * METRES_PER_DEGREE * F.cos(F.radians(middle))})


def valid_mask(cells: DataFrame, value: str, out: str = "valid") -> DataFrame:
    return cells.withColumn(out, F.col(value).isNotNull())


def clip_window(cells: DataFrame, zones: DataFrame, zone: str, buffer: int, n_rows: int, n_cols: int) -> DataFrame:
    """Cells in each zone's index box grown by buffer and held inside the grid; a cell may serve several zones."""
    box = zones.groupBy(zone).agg(
        F.greatest(F.min("r") - buffer, F.lit(0)).alias("ra"), F.least(F.max("r") + buffer, F.lit(n_rows - 1)).alias("rb"), F.greatest(F.min("c") - buffer, F.lit(0)).alias("ca"), F.least(F.max("c") + buffer, F.lit(n_cols - 1)).alias("cb")
    )
    # a box becomes the rows that it spans, so the join is on equal rows
    rows = box.withColumn("r", F.explode(F.sequence("ra", "rb")))
    return cells.join(rows, "r").where("c between ca and cb").select(zone, *cells.columns)


def clip_mask(cells: DataFrame, mask: DataFrame, value: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Cells inside a mask's cells; with value, all cells stay and value is null outside."""
    on = [*keys, "r", "c"]
    inside = mask.select(*on).distinct()
    if value is None:
        return cells.join(inside, on, "left_semi")
    marked = cells.join(inside.withColumn("_in", F.lit(True)), on, "left")
    return marked.withColumn(value, F.when(F.col("_in"), F.col(value))).drop("_in")


def align_window(boxes: DataFrame, grid: Grid, buffer: int = 0) -> DataFrame:
    """Adds the index window ca, ra, cb, rb of each box, snapped outward to pixel edges and grown by buffer."""
    return boxes.withColumns(
        {
            "ca": (F.floor((F.col("xmin") - grid.x0) / grid.dx) - buffer).cast("int"),
            "cb": (F.ceil((F.col("xmax") - grid.x0) / grid.dx) + buffer).cast("int"),
            "ra": (F.floor((F.lit(grid.y0) - F.col("ymax")) / grid.dy) - buffer).cast("int"),
            "rb": (F.ceil((F.lit(grid.y0) - F.col("ymin")) / grid.dy) + buffer).cast("int"),
        }
    )


def trim_halo(cells: DataFrame, b: int, n_rows: int, n_cols: int, value: str | None = None) -> DataFrame:
    """Without the outer b rows and columns; with value, they stay as nulls."""
    inner = F.col("r").between(b, n_rows - 1 - b) & F.col("c").between(b, n_cols - 1 - b)
    return cells.where(inner) if value is None else cells.withColumn(value, F.when(inner, F.col(value)))


def add_halo(cells: DataFrame, tile_rows: int, tile_cols: int, b: int) -> DataFrame:
    """Each tile (tr, tc) with its cells and those of other tiles within b of it: a cell goes to at most nine tiles by its address."""
    near_r = F.array_distinct(F.array(F.floor((F.col("r") - b) / tile_rows), F.floor(F.col("r") / tile_rows), F.floor((F.col("r") + b) / tile_rows)))
    near_c = F.array_distinct(F.array(F.floor((F.col("c") - b) / tile_cols), F.floor(F.col("c") / tile_cols), F.floor((F.col("c") + b) / tile_cols)))
    top = cells.agg(F.floor(F.max("r") / tile_rows).alias("_tr"), F.floor(F.max("c") / tile_cols).alias("_tc"))
    spread = cells.withColumn("tr", F.explode(near_r)).withColumn("tc", F.explode(near_c))
    # the grid's size is a single row
    return spread.join(F.broadcast(top), F.col("tr").between(0, F.col("_tr")) & F.col("tc").between(0, F.col("_tc"))).drop("_tr", "_tc")


def cross_section(cells: DataFrame, row: int | None = None, col: int | None = None) -> DataFrame:
    """One row or one column, in order."""
    return cells.where(F.col("r") == row).orderBy("c") if row is not None else cells.where(F.col("c") == col).orderBy("r")


def resample_nearest(cells: DataFrame, source: Grid, target: DataFrame, target_grid: Grid, values: Sequence[str]) -> DataFrame:
    """values at the target's cells (r, c), from the source cell that holds their centre."""
    at = cell_to_xy(target.select("r", "c"), target_grid).select(F.col("r").alias("tr"), F.col("c").alias("tc"), "x", "y")
    # a grid of cells is no small table, whatever its estimate
    found = xy_to_cell(at, source).join(cells.select("r", "c", *values).hint("merge"), ["r", "c"], "left")
    return found.select(F.col("tr").alias("r"), F.col("tc").alias("c"), *values)


def resample_bilinear(cells: DataFrame, value: str, source: Grid, target: DataFrame, target_grid: Grid, out: str = "out") -> DataFrame:
    """value at the target's cells from the four source centres around; weights of missing ones are left out."""
    at = cell_to_xy(target.select("r", "c"), target_grid).withColumnRenamed("r", "tr").withColumnRenamed("c", "tc")
    at = at.withColumns({"fc": (F.col("x") - source.x0) / source.dx - 0.5, "fr": (F.lit(source.y0) - F.col("y")) / source.dy - 0.5})
    at = at.withColumns({"c0": F.floor("fc"), "r0": F.floor("fr")}).withColumns({"u": F.col("fc") - F.col("c0"), "v": F.col("fr") - F.col("r0")})
    corners = [(0, 0, (1 - F.col("u")) * (1 - F.col("v"))), (0, 1, F.col("u") * (1 - F.col("v"))), (1, 0, (1 - F.col("u")) * F.col("v")), (1, 1, F.col("u") * F.col("v"))]
    four = F.explode(F.array(*[F.struct((F.col("r0") + i).alias("r"), (F.col("c0") + j).alias("c"), w.alias("w")) for i, j, w in corners]))
    spread = at.withColumn("q", four).select("tr", "tc", "q.r", "q.c", "q.w").where("w > 0")
    # neither side is small: the target's plan is estimated without what it is multiplied by
    found = spread.hint("merge").join(cells.where(F.col(value).isNotNull()).select("r", "c", value), ["r", "c"])
    return found.groupBy(F.col("tr").alias("r"), F.col("tc").alias("c")).agg((F.sum(F.col("w") * F.col(value)) / F.sum("w")).alias(out))


def mosaic(layers: Sequence[DataFrame] | DataFrame, value: str, priority: str = "priority", keys: Sequence[str] = ()) -> DataFrame:
    """One value per cell: that of the highest priority that is not null.  A list takes its order as priority."""
    if not isinstance(layers, DataFrame):
        tagged = [x.select(*keys, "r", "c", value, F.lit(i).alias(priority)) for i, x in enumerate(layers)]
        layers = tagged[0]
        for x in tagged[1:]:
            layers = layers.unionByName(x)
    return layers.where(F.col(value).isNotNull()).groupBy(*keys, "r", "c").agg(F.max_by(value, priority).alias(value))


def mosaic_rank(units: DataFrame) -> DataFrame:
    """Adds rank, higher on top: island 0 < coast 1 < unburned 2 < stream-burned 3 < river-flattened 4 (columns island, coast, n_stream, n_river)."""
    rank = F.when(F.col("n_river") > 0, 4).when(F.col("n_stream") > 0, 3).when(F.col("island") == 1, 0).when(F.col("coast") == 1, 1).otherwise(2)
    return units.withColumn("rank", rank)


def grid_difference(new: DataFrame, old: DataFrame, value: str, digits: int | None = None, out: str = "diff", keys: Sequence[str] = ()) -> DataFrame:
    """new - old per cell, rounded if digits is given."""
    on = [*keys, "r", "c"]
    both = new.select(*on, F.col(value).alias("_new")).join(old.select(*on, F.col(value).alias("_old")), on)
    diff = F.col("_new") - F.col("_old")
    return both.select(*on, (diff if digits is None else F.round(diff, digits)).alias(out))


def realign_shifted(moved: DataFrame, base: DataFrame, value: str, out: str = "diff") -> DataFrame:
    """Difference moved - base after shifting moved so that the last data row and column of both agree."""
    last = [df.where(F.col(value).isNotNull()).agg(F.max("r").alias(f"_{n}r"), F.max("c").alias(f"_{n}c")) for n, df in (("m", moved), ("b", base))]
    shift = last[0].crossJoin(last[1]).select((F.col("_br") - F.col("_mr")).alias("_dr"), (F.col("_bc") - F.col("_mc")).alias("_dc"))
    placed = moved.join(F.broadcast(shift), F.lit(True)).select((F.col("r") + F.col("_dr")).alias("r"), (F.col("c") + F.col("_dc")).alias("c"), value)
    return grid_difference(placed, base, value, out=out)


def sign_violations(diff: DataFrame, value: str = "diff", tolerance: float = 0.0) -> DataFrame:
    """How many cells fell although filling may only raise."""
    return diff.agg(F.count_if(F.col(value) < -tolerance).alias("violations"), F.count("*").alias("cells"))


def recode(cells: DataFrame, value: str, codes: dict[int, int], default: int | None = None) -> DataFrame:
    """New codes for old; default for others (None: they stay)."""
    new = F.element_at(F.create_map(*[F.lit(x) for pair in codes.items() for x in pair]), F.col(value))
    return cells.withColumn(value, F.coalesce(new, F.col(value) if default is None else F.lit(default)))


#: Alternate codes of the edit mask, used where codes above 5 occur.
EDIT_MASK_CODES = {2: 5, 8: 4, 9: 2, 10: 3}


def recode_edit_mask(cells: DataFrame, value: str = "edm", keys: Sequence[str] = ()) -> DataFrame:
    """Recode grids whose edit mask has codes above 5; others stay."""
    top = F.max(value).over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    if not keys:
        highest = cells.agg(F.max(value).alias("m")).first()["m"]
        return recode(cells, value, EDIT_MASK_CODES, 0) if (highest or 0) > 5 else cells
    new = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in EDIT_MASK_CODES.items() for x in p]), F.col(value)), F.lit(0))
    return cells.withColumn(value, F.when(top > 5, new).otherwise(F.col(value)))


def fill_from_layers(cells: DataFrame, value: str, others: Sequence[str], bad_above: int = 100, min_bad: int = 10) -> DataFrame:
    """Values above bad_above are missing; if more than min_bad are, they come from the next layer that has one."""

    def good(name: str) -> Column:
        return F.when(F.col(name) <= bad_above, F.col(name))

    bad = cells.agg(F.count_if(good(value).isNull()).alias("n")).first()["n"]
    return cells.withColumn(value, F.coalesce(good(value), *[good(x) for x in others]) if bad > min_bad else good(value))


def artifact_mask(cells: DataFrame, tile: str, n_cols: int, dx_m: float, east_source: str | None, west_source: str | None, out: str = "artifact") -> DataFrame:
    """Strip along the prime meridian: 3200 m at the east edge of W001 tiles, 5 cells at the west edge of E000 tiles, if the neighbour there is of the other source."""
    width = int(3200 / dx_m)
    east = F.col(tile).endswith("W001") & F.lit(east_source == "TDT") & (F.col("c") >= n_cols - width)
    west = F.col(tile).endswith("E000") & F.lit(west_source == "TDT") & (F.col("c") < 5)
    return cells.withColumn(out, F.when(east | west, 1).otherwise(0))


def modulo_mask(cells: DataFrame, value_mm: str, swo: str, step_mm: int = 500, min_swo: int = 2, keys: Sequence[str] = (), out: str = "mask") -> DataFrame:
    """Cells on whole steps of a conditioned surface that are sometimes wet, opened by a 3 x 3 window (eroded, then grown)."""
    hit = cells.withColumn("_m", F.when((F.pmod(F.col(value_mm), F.lit(step_mm)) == 0) & (F.col(swo) >= min_swo), 1).otherwise(0))
    eroded = moving(hit, {"_lo": ("min", "_m", 1), "_n": ("count", "_m", 1)}, keys)
    eroded = eroded.withColumn("_e", F.when(F.col("_n") == 9, F.col("_lo")).otherwise(0))
    return moving(eroded, {out: ("max", "_e", 1)}, keys).drop("_m", "_lo", "_n", "_e")


#: WGS 84 semi-major axis, eccentricity, and the standard parallel (degrees) of the equal-area cylinder.
WGS84_A, WGS84_E, STANDARD_PARALLEL = 6378137.0, 0.081819190842622, 30.0


def equal_area_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Lambert cylindrical equal-area coordinates in metres of longitudes and latitudes in degrees."""
    e, p = WGS84_E, math.radians(STANDARD_PARALLEL)
    k0 = math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    s = F.sin(F.radians(lat))
    q = (1 - e * e) * (s / (1 - (e * s) ** 2) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    return F.radians(lon) * (WGS84_A * k0), q * (WGS84_A / (2 * k0))


def area_perimeter_km(segments: DataFrame, fid: str = "fid") -> DataFrame:
    """Area (km2) and perimeter (km) of features from their ring segments (x1, y1, x2, y2 in degrees), by the shoelace sum."""
    x1, y1 = equal_area_xy(F.col("x1"), F.col("y1"))
    x2, y2 = equal_area_xy(F.col("x2"), F.col("y2"))
    flat = segments.select(fid, x1.alias("a"), y1.alias("b"), x2.alias("c"), y2.alias("d"))
    return flat.groupBy(fid).agg((F.abs(F.sum(F.col("a") * F.col("d") - F.col("c") * F.col("b"))) / 2e6).alias("area_km2"), (F.sum(F.hypot(F.col("c") - F.col("a"), F.col("d") - F.col("b"))) / 1e3).alias("perimeter_km"))
