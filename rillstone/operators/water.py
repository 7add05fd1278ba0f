"""Surface water: classification, burning, moving minima, lakes, coasts and barriers.

Elevations and depths share one unit (the library's tables use millimetres).  Masks are 0/1
columns; water codes and their ranks follow the class table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from rillstone.operators.focal import binary_close, box_any, moving, ring_smooth
from rillstone.operators.spatial import buffer_cells, outside_of
from rillstone.operators.tiles import SIDE, dense, extremes, map_tiles, places_of
from rillstone.operators.zones import close_holes, label
from rillstone.storage import materialize

#: Class of rasterised features.
POLYGON_CLASSES = {"reservoir": 1, "river": 2, "riverbank": 2, "water": 3, "wetland": 4}
LINE_CLASSES = {"river": 5, "stream": 6, "canal": 7, "drain": 8}
WATERWAYS = ("canal", "drain", "river", "riverbank", "stream")


def filter_lines(lines: DataFrame, kind: str = "waterway") -> DataFrame:
    return lines.where(F.col(kind).isin(*WATERWAYS)).withColumnRenamed(kind, "fclass")


def filter_polygons(polygons: DataFrame, natural: str = "natural_", landuse: str = "landuse") -> DataFrame:
    return polygons.where((F.col(landuse) == "reservoir") | F.col(natural).isin("water", "wetland"))


def label_water(polygons: DataFrame, natural: str = "natural_", landuse: str = "landuse", tags: str = "other_tags", out: str = "fclass") -> DataFrame:
    """The class of a water polygon by ordered rules; 'NULL' if none holds."""
    has = F.coalesce(F.col(tags), F.lit(""))
    water = F.col(natural) == "water"
    rule = F.when(F.col(natural) == "wetland", "wetland").when(F.col(landuse) == "reservoir", "reservoir")
    for tag, name in (("river", "river"), ("riverbank", "riverbank"), ("aquaculture", "aquaculture"), ("pond", "pond"), ("reservoir", "reservoir")):
        rule = rule.when(water & has.contains(tag), name)
    return polygons.withColumn(out, rule.when(water, "water").otherwise("NULL"))


def class_code(features: DataFrame, codes: dict[str, int], fclass: str = "fclass", out: str = "watertype") -> DataFrame:
    return features.withColumn(out, F.element_at(F.create_map(*[F.lit(x) for p in codes.items() for x in p]), F.col(fclass)))


def reservoir_mask(cells: DataFrame, n_cols: int, swo_limit: int, min_cells: int, min_drop: float, classes: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """(r, c, zone) of reservoirs: wet or mapped water that is not land or wetland, in zones of min_cells.

    Nothing is found with 20 cells or fewer, or if the heights' first and 99th percentiles differ by
    less than min_drop.  cells has z, swo, osm, land.
    """
    wet = cells.where(((F.col("swo") > swo_limit) | F.col("osm").isin(*classes)) & (F.col("land") == 0) & (F.coalesce("osm", F.lit(0)) != 4))
    gate = wet.agg(F.count("*").alias("n"), (F.percentile("z", F.lit(0.99)) - F.percentile("z", F.lit(0.01))).alias("d")).first()
    zones = label(wet, F.lit(gate["n"] > 20 and (gate["d"] or 0) >= min_drop), n_cols)
    big = zones.groupBy("zone").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_cells).select("zone")
    return zones.join(big, "zone", "left_semi")


def river_candidates(cells: DataFrame, n_cols: int, swo_limit: int, min_cells: int) -> DataFrame:
    """(r, c, zone): wet, mapped or edited water without land, dry wetland, ocean or missing heights, in zones of min_cells.

    cells has z, swo, osm, edm, land.
    """
    water = (F.col("swo") > swo_limit) | F.col("osm").isin(1, 2, 3) | F.col("edm").isin(2, 3)
    out = (F.col("land") == 1) | ((F.coalesce("osm", F.lit(0)) == 4) & (F.col("swo") < 90)) | (F.col("edm") == 4) | F.col("z").isNull()
    zones = label(cells, water & ~out, n_cols)
    big = zones.groupBy("zone").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_cells).select("zone")
    return zones.join(big, "zone", "left_semi")


def large_lakes(lakes: DataFrame, n_rows: int, n_cols: int, min_cells: int, metres: float, dx_m: float, dy_m: float, max_ratio: float = 1.0) -> DataFrame:
    """(r, c) of large lakes: cells (fid, r, c) of lakes over a tenth of min_cells, merged, over min_cells, holes closed,
    with less than max_ratio edges per cell, grown by metres."""
    sizes = lakes.groupBy("fid").agg(F.count("*").alias("_n")).where(F.col("_n") > min_cells / 10).select("fid")
    merged = label(lakes.join(sizes, "fid", "left_semi").select("r", "c").distinct(), F.lit(True), n_cols)
    big = merged.groupBy("zone").agg(F.count("*").alias("_n")).where(F.col("_n") > min_cells).select("zone")
    full = close_holes(merged.join(big, "zone", "left_semi").select("r", "c"), n_rows, n_cols)
    zones = label(full, F.lit(True), n_cols)
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, 0), (0, -1), (-1, 0))]))
    edges = zones.select("zone", F.col("r").alias("a"), F.col("c").alias("b"), step.alias("s")).select("zone", (F.col("a") + F.col("s.i")).alias("r"), (F.col("b") + F.col("s.j")).alias("c"))
    edges = edges.join(full, ["r", "c"], "left_anti").groupBy("zone").agg(F.count("*").alias("_e"))
    round_ = zones.groupBy("zone").agg(F.count("*").alias("_n")).join(edges, "zone", "left").where(F.coalesce("_e", F.lit(0)) / F.col("_n") < max_ratio).select("zone")
    grown = buffer_cells(zones.join(round_, "zone", "left_semi"), metres, dx_m, dy_m)
    return grown.where(F.col("r").between(0, n_rows - 1) & F.col("c").between(0, n_cols - 1))


def swo_burn(swo: Column, cutoff: float, depth: float) -> Column:
    """Depth of burning by water occurrence: a ramp from cutoff to 80, full depth above; from 40 to 90 if cutoff is 80 or more."""
    lo, hi = (40.0, 90.0) if cutoff >= 80 else (float(cutoff), 80.0)
    ramp = (swo - lo) * depth / (hi - lo)
    return F.when(swo >= hi, F.lit(float(depth))).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(float(depth)), ramp)))


def flatten_lakes(cells: DataFrame, lakes: DataFrame, cutoff: int, depth: float, flood: float, max_raise: float) -> DataFrame:
    """Adds flat: lake cells set to their lake's level.

    lakes has r, c, lake.  A lake whose share of deep water (swo > 80) is under 20 % stays.  Its level
    is the tenth percentile of deep heights; if they spread by more than flood (p90 - p10) and the
    level is below 0, that of the positive ones.  Cells with swo above cutoff take the level, lowered
    by the ramped burn; raises of more than max_raise are undone.
    """
    # cells meet lakes once; neither is a small table, whatever its estimate
    joined = materialize(cells.join(lakes.select("r", "c", "lake").hint("merge"), ["r", "c"], "left"), "lakes")
    deep = F.col("swo") > 80
    level = joined.where("lake is not null").groupBy("lake").agg(
        F.avg(deep.cast("int")).alias("_share"), F.percentile(F.when(deep, F.col("z")), F.lit(0.1)).alias("_p10"), F.percentile(F.when(deep, F.col("z")), F.lit(0.9)).alias("_p90"), F.percentile(F.when(deep & (F.col("z") > 0), F.col("z")), F.lit(0.1)).alias("_pos")
    )
    level = level.where("_share >= 0.2").withColumn("_level", F.when((F.col("_p90") - F.col("_p10") > flood) & (F.col("_p10") < 0) & F.col("_pos").isNotNull(), F.col("_pos")).otherwise(F.col("_p10")))
    # only lake cells seek a level: all others would meet in the task of no lake
    wet = joined.where("lake is not null").join(level.select("lake", "_level"), "lake", "left")
    joined = wet.unionByName(joined.where("lake is null").withColumn("_level", F.lit(None).cast("double")))
    burned = F.col("_level") - swo_burn(F.col("swo"), cutoff, depth)
    new = F.when(F.col("_level").isNotNull() & (F.col("swo") > cutoff) & (burned - F.col("z") <= max_raise), burned).otherwise(F.col("z").cast("double"))
    return joined.withColumn("flat", new).drop("_level")


def vector_burn(cells: DataFrame, line_class: str, depths: dict[int, float], n_rows: int, n_cols: int) -> DataFrame:
    """Adds burn: depth by line class, smoothed three times by the (1, 0.5) kernel, tripled, at least the class's depth on
    the line and at most the deepest; and near_class, the least class among adjacent lines."""
    own = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, v in depths.items() for x in (k, float(v))]), F.col(line_class)), F.lit(0.0))
    out = cells.withColumn("_own", own).withColumn("_b", F.col("_own"))
    for _ in range(3):
        out = ring_smooth(out, "_b", {"_s": [1.0, 0.5]}, n_rows, n_cols).drop("_b").withColumnRenamed("_s", "_b")
    out = out.withColumn("burn", F.least(F.greatest(F.col("_b") * 3, F.col("_own")), F.lit(max(map(float, depths.values())))))
    out = moving(out.withColumn("_c", F.when(F.col(line_class).isin(*depths), F.col(line_class))), {"near_class": ("min", "_c", 1)})
    return out.drop("_own", "_b", "_c")


def stream_minimize(cells: DataFrame, windows: dict[int, int], n_rows: int, n_cols: int, max_burn: float, adjacent_diff: float, least_drop: float, reach: int = 5) -> DataFrame:
    """Adds low and code: streams lowered to a moving minimum of the smoothed surface near streams.

    cells has z, stream (0 none, 1 river, 2 stream, 3 canal) and big_river (0/1).  windows gives each
    class its half width.  A cell falls by max_burn at most; on and near streams it lies at least
    least_drop and at most adjacent_diff below adjacent land, the window minimum of land off the
    banks.  Codes are 8, 9, 10 for river, stream and canal; other cells keep z and have code 0.
    """
    on = (F.col("stream") > 0) & (F.col("big_river") == 0)
    out = ring_smooth(cells, "z", {"_t": [1.0, 0.5]}, n_rows, n_cols)
    out = moving(out.withColumns({"_on": on.cast("int"), "_riv": (F.col("stream") == 1).cast("int")}), {"_adj": ("max", "_on", reach), "_bank": ("max", "_on", 3), "_wide": ("max", "_riv", 1)})
    out = out.withColumns({"_near": F.when(F.col("_adj") == 1, F.col("_t")), "_land": F.when((F.col("_adj") == 1) & (F.col("_bank") == 0), F.col("_t"))})
    out = moving(out, {f"_m{k}": ("min", "_near", w) for k, w in windows.items()} | {"_ml": ("min", "_land", reach)})
    kind = F.when(F.col("big_river") == 1, 0).when(F.col("_wide") == 1, 1).otherwise(F.col("stream"))
    floor = F.col("z").cast("double")
    code = F.lit(0)
    for k in windows:
        floor = F.when(kind == k, F.coalesce(f"_m{k}", F.col("z").cast("double"))).otherwise(floor)
        code = F.when(kind == k, 7 + k).otherwise(code)
    out = out.withColumns({"_low": floor, "code": code, "_ml": F.coalesce("_ml", "_t")})
    out = out.withColumn("_low", F.greatest(F.col("_low"), F.col("z") - max_burn))
    gap = F.when(F.col("_bank") == 1, F.col("_ml") - F.col("_low")).otherwise(0.0)
    on_water = F.col("code") > 0
    low = F.when((gap < least_drop) & on_water & on, F.col("_ml") - least_drop).when((gap > adjacent_diff) & on_water & (F.col("big_river") == 0), F.col("_ml") - adjacent_diff).otherwise(F.col("_low"))
    return out.withColumn("low", low).select(*cells.columns, "low", "code")


def river_minimize(cells: DataFrame, k: int, max_burn: float, min_swo: int = 5) -> DataFrame:
    """Adds low: cells of narrow rivers (river = 1, banks left out, swo above min_swo) fall to the window's minimum river height."""
    halo, kind = k + 1, cells.schema["z"].dataType
    schema = StructType([*cells.schema.fields, StructField("_in", BooleanType()), StructField("_m", DoubleType())])

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        side, width = SIDE, SIDE + 2 * halo
        i, j = places_of(table, r0, c0, halo)
        core = (i >= halo) & (i < halo + side) & (j >= halo) & (j < halo + side)
        if not core.any():
            return None
        river, swo, z = (dense(table, name, i, j, width) for name in ("river", "swo", "z"))
        bank = np.pad(river == 0, 1)
        edge = np.logical_or.reduce([bank[1 + di : 1 + di + width, 1 + dj : 1 + dj + width] for di in (-1, 0, 1) for dj in (-1, 0, 1)])
        inside = (river == 1) & ~edge & (swo > min_swo)
        low = np.where(inside & ~np.isnan(z), z, np.inf)
        low = np.minimum.reduce([low[halo + d : halo + d + side] for d in range(-k, k + 1)])
        low = np.minimum.reduce([low[:, halo + d : halo + d + side] for d in range(-k, k + 1)])[i[core] - halo, j[core] - halo]
        own = table.filter(pa.array(core)).append_column("_in", pa.array(inside[i[core], j[core]]))
        return own.append_column("_m", pa.array(low, mask=np.isinf(low)))

    out = map_tiles(cells, halo, run, schema)
    return out.withColumn("low", F.when(F.col("_in"), F.greatest(F.col("_m").cast(kind), F.col("z") - max_burn)).otherwise(F.col("z"))).drop("_in", "_m")


def smooth_rivers(cells: DataFrame, n_rows: int, n_cols: int, k: int, max_lower: float, least: float = 10.0, min_swo: int = 90) -> DataFrame:
    """Adds low: cells with swo above min_swo fall to the window's minimum of the 5 x 5 mean if that lowers them by least to max_lower."""
    out = ring_smooth(cells, "z", {"_mean": [1.0, 1.0, 1.0]}, n_rows, n_cols)
    out = moving(out.withColumn("_w", F.when(F.col("swo") > min_swo, F.col("_mean"))), {"_m": ("min", "_w", k)})
    drop = F.col("z") - F.col("_m")
    return out.withColumn("low", F.when((F.col("swo") > min_swo) & drop.between(least, max_lower), F.col("_m")).otherwise(F.col("z").cast("double"))).drop("_mean", "_w", "_m")


def raise_small(cells: DataFrame, small: Column, large: Column, k: int, extra: float, max_raise: float) -> DataFrame:
    """Adds raised: small waters within k cells of large ones lie at least extra above the large ones' window minimum if they
    lack no more than max_raise.  Streams, small rivers and canals differ in their masks and widths."""
    out = cells.withColumn("_lz", F.when(large, F.col("z"))).withColumn("_l", large.cast("int"))
    out = extremes(out, {"_m": ("min", "_lz", k), "_near": ("max", "_l", k)})
    lack = F.col("_m") + extra - F.col("z")
    return out.withColumn("raised", F.when(small & (F.col("_near") == 1) & (lack > 0) & (lack <= max_raise), F.col("_m") + extra).otherwise(F.col("z"))).drop("_lz", "_l", "_m", "_near")


def set_ocean(cells: DataFrame, ocean: Column, level: float) -> DataFrame:
    return cells.withColumn("z", F.when(ocean, F.lit(level)).otherwise(F.col("z")))


def clip_ocean(cells: DataFrame, land: Column, osm_water: Column, edm: str = "edm", codes: Sequence[int] = (4, 5), interior: Column | None = None) -> DataFrame:
    """z is null where the edit mask says ocean or fill, outside land, mapped water and the interior."""
    sea = F.col(edm).isin(*codes) & ~land & ~osm_water
    return cells.withColumn("z", F.when(~(sea if interior is None else sea & ~interior), F.col("z")))


def coast_land_mask(cells: DataFrame, osm_water: Column, k: int = 7, edm: str = "edm", dx_m: float = 12.0, dy_m: float = 12.0, tight: float = 10.0, wide: float = 100.0) -> DataFrame:
    """Adds ocean, land, land_wide and shore (0/1).

    Ocean is height 0 with fill, or edited ocean, without mapped water; cells below 0 with edited fill or ocean (codes 4
    and more) that its closing over (2k+1) x (2k+1) cells takes in are ocean too.  land is all other cells with
    a height, grown by tight metres, land_wide by wide metres; shore lies within three cells of a cell off land.
    """
    sea = (((F.col("z") == 0) & (F.col(edm) == 5)) | (F.col(edm) == 4)) & ~osm_water
    out = binary_close(cells, F.coalesce(sea, F.lit(False)), k, "_closed")
    hole = (F.col("_closed") == 1) & (F.col("z") < 0) & (F.col(edm) >= 4) & ~osm_water
    out = out.withColumn("ocean", F.coalesce(sea | hole, F.lit(False)).cast("int")).withColumn("_land", ((F.col("ocean") == 0) & F.col("z").isNotNull()).cast("int"))
    # only land beside other cells can reach them
    rim = box_any(out, F.col("_land") == 0, 1, "_rim").where("_rim = 1 and _land = 1").select("r", "c")
    for name, metres in (("land", tight), ("land_wide", wide)):
        grown = buffer_cells(rim, metres, dx_m, dy_m).withColumn(name, F.lit(1))
        out = out.join(grown, ["r", "c"], "left").withColumn(name, F.greatest(F.coalesce(name, F.lit(0)), "_land"))
    return box_any(out, F.col("land") == 0, 3, "shore").drop("_closed", "_land")


def is_coastal(cells: DataFrame, unit: str, min_cells: int = 1000, edm: str = "edm", inland_cutoff: int = 20, coast_cutoff: int = 65) -> DataFrame:
    """(unit, coastal, swo_cutoff) by the number of ocean cells."""
    out = cells.groupBy(unit).agg(F.count_if(F.col(edm) == 4).alias("_n"))
    coastal = F.col("_n") > min_cells
    return out.select(unit, coastal.alias("coastal"), F.when(coastal, coast_cutoff).otherwise(inland_cutoff).alias("swo_cutoff"))


def water_mask(candidates: DataFrame, cells: DataFrame, border: DataFrame, n_cols: int, gap: int, lake_share: float = 0.9, min_pieces: int = 2, many_pieces: int = 4, min_river_share: float = 0.1) -> DataFrame:
    """(r, c, zone, kind): candidates joined over gaps of 2 * gap cells; kind 4 river, 3 lake.

    A zone is a river if mapped rivers (osm 2) touch it and mapped lakes do not cover lake_share of
    it, or if it crosses the border in min_pieces pieces (with more than many_pieces only if mapped
    water covers min_river_share).  cells has osm; border has r, c.
    """
    near = candidates.select("r", "c").distinct()
    grown = near.select(F.explode(F.sequence(F.col("r") - gap, F.col("r") + gap)).alias("r"), "c").select("r", F.explode(F.sequence(F.col("c") - gap, F.col("c") + gap)).alias("c")).distinct()
    # within the grid two squares touch if they do beyond it
    grown = grown.where(F.col("c").between(0, n_cols - 1) & (F.col("r") >= 0))
    zones = label(grown, F.lit(True), n_cols).join(near, ["r", "c"], "left_semi")
    osm = zones.join(cells.select("r", "c", "osm"), ["r", "c"], "left")
    share = osm.groupBy("zone").agg(F.max((F.col("osm") == 2).cast("int")).alias("river"), F.avg(F.coalesce(F.col("osm").isin(1, 3), F.lit(False)).cast("int")).alias("lake"), F.avg(F.coalesce(F.col("osm") > 0, F.lit(False)).cast("int")).alias("mapped"))
    cross = zones.join(border.select("r", "c"), ["r", "c"], "left_semi")
    pieces = label(cross, F.lit(True), n_cols).withColumnRenamed("zone", "piece").join(cross, ["r", "c"]).groupBy("zone").agg(F.count_distinct("piece").alias("pieces"))
    judged = share.join(pieces, "zone", "left").withColumn("pieces", F.coalesce("pieces", F.lit(0)))
    flows = (F.col("pieces") >= min_pieces) & ((F.col("pieces") <= many_pieces) | (F.col("mapped") >= min_river_share))
    kind = F.when(F.col("lake") > lake_share, 3).when((F.coalesce("river", F.lit(0)) == 1) | flows, 4).otherwise(3)
    return zones.join(judged.select("zone", kind.alias("kind")), "zone").select("r", "c", "zone", "kind")


def alternate_dem(
    cells: DataFrame, n_cols: int, step: int, river: Column, min_swo: int = 2, edm: str | None = None, edm_codes: Sequence[int] = (2, 3), code: Column | None = None, redraw: bool = False, swo_cutoff: int = 20, min_overlap: int = 1000,
    fill_reach: int = 5,
) -> DataFrame:
    """Adds taken (0/1), z_new and code_new where an alternate surface takes the place of heights in and around rivers.

    cells has z, alt, swo, lake (0/1).  taken are the zones of the alternate surface's whole steps (opened, sometimes
    wet) that touch rivers, grown by a cell, and the zones of the edit mask's codes (edm_codes; with fill,
    5, for surfaces whose fill belongs to rivers) that have edited water in a river.  They take alt; the cells within two cells
    of them are filled in anew from the rest; lakes take the lower of both.  code_new is 15 on that edge, 11 on what was taken
    and on rivers, 3 on lakes, else code (0 if not given).  With redraw, the wet part of that and the zones of steps are the new river: a
    river zone of more than min_overlap cells gives way to the new zone that overlaps it most, by min_overlap cells at least,
    if that has half to twice its cells, else it stays; rivers have code 4.
    """
    from rillstone.operators.focal import fill_missing
    from rillstone.operators.grid import modulo_mask
    from rillstone.operators.zones import zone_match, zone_size_filter, zones_intersecting

    base = materialize(cells.withColumns({"_river": F.coalesce(river, F.lit(False)).cast("int"), "code_new": F.lit(0) if code is None else code}), "alternate")
    streams = base.where("_river = 1").select("r", "c")
    zones = label(modulo_mask(base, "alt", "swo", step, min_swo, out="_m"), F.col("_m") == 1, n_cols)
    steps = zones_intersecting(zones, streams, "zone").select("r", "c").withColumn("_steps", F.lit(1))
    taken = box_any(base.join(steps, ["r", "c"], "left"), F.col("_steps") == 1, 1, "_only").withColumn("taken", F.coalesce("_only", F.lit(0)))
    if edm is not None:
        water = label(base, F.col(edm).isin(*edm_codes), n_cols)
        with_river = zones_intersecting(water, base.where(F.col(edm).isin(2, 3) & (F.col("_river") == 1)).select("r", "c"), "zone")
        taken = taken.join(with_river.select("r", "c", F.lit(1).alias("_edm")), ["r", "c"], "left").withColumn("taken", F.greatest("taken", F.coalesce("_edm", F.lit(0)))).drop("_edm")
    edge = box_any(taken.drop("_steps"), F.col("taken") == 1, 2, "_near").withColumn("_edge", (F.col("_near") == 1) & (F.col("taken") == 0))
    new = edge.withColumn("z_new", F.when(F.col("_edge"), None).when(F.col("taken") == 1, F.col("alt")).otherwise(F.col("z")).cast("double")).withColumn("_missing", F.col("z").isNull())
    new = fill_missing(materialize(new, "alternate"), "z_new", fill_reach)
    lake = F.col("lake") == 1
    new = new.withColumn("z_new", F.when(F.col("_missing"), None).otherwise(F.when(lake, F.least("z_new", F.col("alt").cast("double"))).otherwise(F.coalesce("z_new", F.col("z").cast("double")))))
    mark = F.when(lake, 3).when(F.col("_edge"), 15).when((F.col("taken") == 1) | (F.col("_river") == 1), 11).otherwise(F.col("code_new"))
    new = new.withColumn("code_new", mark.cast("int"))
    if redraw:
        new = materialize(new, "alternate")
        drawn = label(new, ((F.col("code_new") == 11) & (F.col("swo") >= swo_cutoff) & (F.col("_river") == 0) & (F.col("taken") == 1)) | (F.col("_only") == 1), n_cols)
        old = zone_size_filter(label(new, F.col("_river") == 1, n_cols), "zone", min_overlap + 1)
        match = materialize(zone_match(old, drawn, min_overlap), "alternate-match")
        keep = old.join(match.select(F.col("old_zone").alias("zone")), "zone", "left_anti").select("r", "c")
        take = drawn.join(match.select(F.col("new_zone").alias("zone")).distinct(), "zone", "left_semi").select("r", "c")
        rivers = keep.unionByName(take).distinct().withColumn("_four", F.lit(4))
        new = new.join(rivers, ["r", "c"], "left").withColumn("code_new", F.when(lake, 3).otherwise(F.coalesce("_four", "code_new")).cast("int"))
    return new.select(*cells.columns, "taken", "z_new", "code_new")


def river_bank(cells: DataFrame, river: Column, depth: float, k: int = 3) -> DataFrame:
    """Adds bank (0/1) and burn: the ring of k cells around rivers, burned by the share of river in the window over its 90th percentile."""
    out = moving(cells.withColumn("_r", river.cast("int")), {"_any": ("max", "_r", k), "_sum": ("sum", "_r", k)})
    out = out.withColumn("bank", F.when((F.col("_any") == 1) & (F.col("_r") == 0), 1).otherwise(0))
    # one number
    p90 = out.where("bank = 1").agg(F.percentile("_sum", F.lit(0.9)).alias("p")).first()["p"] or 1.0
    return out.withColumn("burn", F.when(F.col("bank") == 1, F.least(F.lit(float(depth)), F.col("_sum") * (depth / p90))).otherwise(0.0)).drop("_r", "_any", "_sum")


def water_floor(cells: DataFrame, river_floor: float, stream_floor: float, code: str = "code") -> DataFrame:
    """z of rivers (codes 1 to 7 and 15) not below river_floor, of streams (8 to 14) not below stream_floor."""
    z = F.col("z")
    return cells.withColumn("z", F.when(F.col(code).between(1, 7) | (F.col(code) == 15), F.greatest(z, F.lit(river_floor))).when(F.col(code).between(8, 14), F.greatest(z, F.lit(stream_floor))).otherwise(z))


def all_water_unit(cells: DataFrame, unit: str, cutoff: float, depth: float, share: float = 0.99) -> DataFrame:
    """Adds z_new and code for units that are water almost everywhere (water = 1): burned by occurrence, code 3; other units stay with code 0."""
    wet = cells.groupBy(unit).agg((F.avg("water") > share).alias("_all"))
    out = cells.join(wet, unit)
    return out.withColumn("z_new", F.when(F.col("_all"), F.col("z") - swo_burn(F.col("swo"), cutoff, depth)).otherwise(F.col("z").cast("double"))).withColumn("code", F.when(F.col("_all"), 3).otherwise(0)).drop("_all")


def reservoir_barrier(cells: DataFrame, reservoirs: DataFrame, unit: DataFrame, n_cols: int, metres: float, dx_m: float, dy_m: float, step: float, height: float, min_area: float = 3e6) -> DataFrame:
    """z raised by height on pieces of the unit's rim that a reservoir of at least min_area square metres crosses where the
    rim's water is step above the reservoir.

    reservoirs has r, c, zone; unit r, c; the rim is the ring between the unit and its inset.
    """
    large = reservoirs.groupBy("zone").agg((F.count("*") * (dx_m * dy_m)).alias("_a")).where(F.col("_a") >= min_area).select("zone")
    reservoirs = reservoirs.join(large, "zone", "left_semi")
    # of the rim only what reservoirs have is needed
    rim = buffer_cells(outside_of(unit, dx_m, dy_m), metres, dx_m, dy_m)
    crossing = materialize(reservoirs.join(rim, ["r", "c"], "left_semi").join(unit.select("r", "c"), ["r", "c"], "left_semi"), "crossing")
    pieces = materialize(label(crossing, F.lit(True), n_cols).withColumnRenamed("zone", "piece").join(crossing.select("r", "c", "zone"), ["r", "c"]), "crossing-pieces")
    whole = reservoirs.join(cells.select("r", "c", "z"), ["r", "c"]).groupBy("zone").agg(F.percentile("z", F.lit(0.001)).alias("base"), (F.max("z") - F.min("z")).alias("range"))
    ends = pieces.join(cells.select("r", "c", "z"), ["r", "c"]).groupBy("piece", "zone").agg(F.percentile("z", F.lit(0.001)).alias("low"))
    walls = ends.join(whole, "zone").where((F.col("low") > F.col("base") + step) & (F.col("range") >= step)).select("piece")
    wall = materialize(pieces.join(walls, "piece", "left_semi").select("r", "c", F.lit(1).alias("wall")), "barrier")
    return cells.join(wall, ["r", "c"], "left").withColumn("wall", F.coalesce("wall", F.lit(0))).withColumn("z", F.when(F.col("wall") == 1, F.col("z") + height).otherwise(F.col("z")))


def noflow_wall(cells: DataFrame, walls: DataFrame, height: float) -> DataFrame:
    """z raised by height on wall cells (r, c, wall); adds wall and base, the height before."""
    marked = cells.join(walls.select("r", "c", "wall"), ["r", "c"], "left")
    return marked.withColumn("base", F.col("z")).withColumn("z", F.when(F.col("wall").isNotNull(), F.col("z") + height).otherwise(F.col("z")))


def remove_wall(cells: DataFrame, floors: dict[int, float], margin: float, min_fill: float, k: int = 2) -> DataFrame:
    """z of wall cells set to the largest of base + margin, the highest adjacent fill + margin, and the wall's floor, if floors has one.

    cells has z, base, wall, fill (how far a cell was filled); adjacent are the (2k+1)^2 cells without
    wall filled by more than min_fill.
    """
    out = extremes(cells.withColumn("_f", F.when(F.col("wall").isNull() & (F.col("fill") > min_fill), F.col("z"))), {"_m": ("max", "_f", k)})
    floor = F.element_at(F.create_map(*[F.lit(x) for a, b in floors.items() for x in (a, float(b))]), F.col("wall"))
    top = F.greatest((F.col("base") + margin).cast("double"), (F.col("_m") + margin).cast("double"), floor)
    return out.withColumn("z", F.when(F.col("wall").isNotNull(), top).otherwise(F.col("z").cast("double"))).drop("_f", "_m")
