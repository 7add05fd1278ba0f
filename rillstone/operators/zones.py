"""Connected components of cells and what is asked of zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.operators.components import star_components
from rillstone.operators.focal import box_any
from rillstone.operators.spatial import sequential_id
from rillstone.operators.tiles import tile_labels

STEPS_4 = [(0, 1), (1, 0)]
STEPS_8 = [*STEPS_4, (1, 1), (1, -1)]
#: Edges between tiles that one task may join, 16 bytes each.
FEW = 500_000
RING = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]


def label(cells: DataFrame, mask: Column, n_cols: int, connectivity: int = 8, keys: Sequence[str] = (), out: str = "zone") -> DataFrame:
    """(keys..., r, c, out) for masked cells; out is the zone's least linear index r * n_cols + c.

    With keys (short integers such as a step number), cells meet only within equal keys, and the
    index counts them in front.  Tiles are labelled on their own; only where zones cross from tile to
    tile do their parts meet as edges of a graph.
    """
    on = [*keys, "r", "c"]
    index = F.col("r") * n_cols + F.col("c")
    for k in reversed(keys):
        index = index + F.col(k).cast("long") * (1 << 40)
    held = cells.where(mask).select(*on).withColumn("_id", index.cast("long"))
    parts, edges = tile_labels(held, n_cols, STEPS_4 if connectivity == 4 else STEPS_8, keys)
    # a part lies within one tile, so no part has very many cells
    found = parts.join(star_components(edges, few=FEW).select(F.col("node").alias("local"), "component"), "local", "left")
    return found.select(*on, F.coalesce("component", "local").alias(out))


def dense_labels(zones: DataFrame, zone: str = "zone", out: str = "label") -> DataFrame:
    """Zones numbered 1..n in order of their index: the distinct zones are ranked in ranges, not the cells."""
    ranked = sequential_id(zones.select(zone).distinct(), [zone], out)
    return zones.join(ranked, zone)


def clump(cells: DataFrame, condition: Column, n_cols: int, buffer: int = 0, split: Column | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Zones of cells that meet the condition; grown by buffer they join at sides only.

    With split, cells inside and outside it are labelled apart, and the numbers of the second set
    follow those of the first.
    """
    grown = box_any(cells, condition, buffer, "_m", keys) if buffer else cells.withColumn("_m", condition.cast("int"))
    kind = 4 if buffer else 8
    if split is None:
        return dense_labels(label(grown, F.col("_m") == 1, n_cols, kind, keys)).drop("zone")
    parted = grown.where("_m = 1").withColumn("_part", F.coalesce(split, F.lit(False)).cast("int"))
    return dense_labels(label(parted, F.lit(True), n_cols, kind, [*keys, "_part"])).drop("zone", "_part")


def zone_size_filter(zones: DataFrame, zone: str, low: int = 0, high: int | None = None) -> DataFrame:
    """Cells of zones with at least low and at most high cells."""
    n = zones.groupBy(zone).agg(F.count("*").alias("_n")).where(F.col("_n") >= low if high is None else F.col("_n").between(low, high))
    return zones.join(n.select(zone), zone, "left_semi")


def drop_zones_touching(zones: DataFrame, mask: DataFrame, zone: str) -> DataFrame:
    touched = zones.join(mask.select("r", "c"), ["r", "c"], "left_semi").select(zone).distinct()
    return zones.join(touched, zone, "left_anti")


def zones_within(zones: DataFrame, mask: DataFrame, zone: str) -> DataFrame:
    """Zones all of whose cells are in the mask."""
    outside = zones.join(mask.select("r", "c"), ["r", "c"], "left_anti").select(zone).distinct()
    return zones.join(outside, zone, "left_anti")


def zones_intersecting(zones: DataFrame, mask: DataFrame, zone: str) -> DataFrame:
    return zones.join(zones.join(mask.select("r", "c"), ["r", "c"], "left_semi").select(zone).distinct(), zone, "left_semi")


def largest_zone(zones: DataFrame, zone: str, keys: Sequence[str] = ()) -> DataFrame:
    """Cells of the zone with most cells, ties to the smaller number; one for each key."""
    n = zones.groupBy(*keys, zone).agg(F.count("*").alias("_n"))
    best = n.groupBy(*keys).agg(F.max_by(zone, F.struct(F.col("_n"), -F.col(zone))).alias(zone))
    return zones.join(best, [*keys, zone], "left_semi")


def zone_coverage(zones: DataFrame, mask: DataFrame, zone: str) -> DataFrame:
    """(zone, share): the share of a zone's cells that the mask has."""
    hit = zones.join(mask.select("r", "c").distinct().withColumn("_h", F.lit(1)), ["r", "c"], "left")
    return hit.groupBy(zone).agg((F.count("_h") / F.count("*")).alias("share"))


def zone_match(old: DataFrame, new: DataFrame, min_overlap: int = 1000, ratio: tuple[float, float] = (0.5, 2.0)) -> DataFrame:
    """(old_zone, new_zone, overlap): each old zone's largest overlap of at least min_overlap cells, kept if the sizes' ratio fits.

    Both inputs have columns r, c, zone.
    """
    a, b = old.select("r", "c", F.col("zone").alias("old_zone")), new.select("r", "c", F.col("zone").alias("new_zone"))
    pairs = a.join(b, ["r", "c"]).groupBy("old_zone", "new_zone").agg(F.count("*").alias("overlap")).where(F.col("overlap") >= min_overlap)
    best = pairs.withColumn("_k", F.row_number().over(Window.partitionBy("old_zone").orderBy(F.desc("overlap"), "new_zone"))).where("_k = 1").drop("_k")
    sizes = best.join(a.groupBy("old_zone").agg(F.count("*").alias("_a")), "old_zone").join(b.groupBy("new_zone").agg(F.count("*").alias("_b")), "new_zone")
    return sizes.where((F.col("_b") / F.col("_a")).between(*ratio)).select("old_zone", "new_zone", "overlap")


def _sent(zones: DataFrame, zone: str, steps: Sequence[tuple[int, int]]) -> DataFrame:
    """Each zone cell once for each neighbour place: (zone, r, c of the neighbour, ar, ac of the cell)."""
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps]))
    return zones.select(zone, F.col("r").alias("ar"), F.col("c").alias("ac"), step.alias("_s")).select(zone, (F.col("ar") + F.col("_s.i")).alias("r"), (F.col("ac") + F.col("_s.j")).alias("c"), "ar", "ac")


def zone_outline(zones: DataFrame, zone: str) -> DataFrame:
    """Unit edges between a zone's cell (ar, ac) and a side neighbour (r, c) outside the zone."""
    return _sent(zones, zone, [(0, 1), (1, 0), (0, -1), (-1, 0)]).join(zones.select(zone, "r", "c"), [zone, "r", "c"], "left_anti")


def zone_border(zones: DataFrame, zone: str, n_rows: int | None = None, n_cols: int | None = None) -> DataFrame:
    """Cells (zone, r, c) around a zone, diagonals too, held inside the grid if its size is given."""
    ring = _sent(zones, zone, RING).select(zone, "r", "c").distinct().join(zones.select(zone, "r", "c"), [zone, "r", "c"], "left_anti")
    return ring if n_rows is None else ring.where(F.col("r").between(0, n_rows - 1) & F.col("c").between(0, n_cols - 1))


def border_parts(zones: DataFrame, zone: str, mask: DataFrame, n_rows: int, n_cols: int) -> DataFrame:
    """(zone, parts): how many separate pieces of a zone's border lie in the mask.

    A border belongs to one zone, so its pieces are labelled with the zone's rank in the key.
    """
    ring = zone_border(zones, zone, n_rows, n_cols).join(mask.select("r", "c"), ["r", "c"], "left_semi")
    rank = sequential_id(zones.select(zone).distinct(), [zone], "_k")
    pieces = label(ring.join(rank, zone), F.lit(True), n_cols, 8, ["_k"], "_piece")
    found = pieces.join(rank, "_k").groupBy(zone).agg(F.count_distinct("_piece").alias("parts"))
    return zones.select(zone).distinct().join(found, zone, "left").select(zone, F.coalesce("parts", F.lit(0)).alias("parts"))


def dissolve(features: DataFrame, n_cols: int, connectivity: int = 8) -> DataFrame:
    """Cells (r, c, zone) of features merged where they touch and split where they do not."""
    return label(features.select("r", "c").distinct(), F.lit(True), n_cols, connectivity)


def close_holes(zone_cells: DataFrame, n_rows: int, n_cols: int) -> DataFrame:
    """The region with its holes: complement zones (joined at sides) that do not reach the grid's edge become members."""
    grid = zone_cells.sparkSession.range(n_rows).select(F.col("id").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(n_cols - 1))).alias("c")).withColumn("c", F.col("c").cast("long"))
    outside = label(grid.join(zone_cells.select("r", "c"), ["r", "c"], "left_anti"), F.lit(True), n_cols, 4)
    edge = outside.where((F.col("r") == 0) | (F.col("r") == n_rows - 1) | (F.col("c") == 0) | (F.col("c") == n_cols - 1)).select("zone").distinct()
    return zone_cells.select("r", "c").unionByName(outside.join(edge, "zone", "left_anti").select("r", "c")).distinct()


def zone_bbox(zones: DataFrame, zone: str, pad: int = 0) -> DataFrame:
    return zones.groupBy(zone).agg((F.min("r") - pad).alias("ra"), (F.max("r") + pad).alias("rb"), (F.min("c") - pad).alias("ca"), (F.max("c") + pad).alias("cb"))
