"""Depressions: filling, carving, the pit catalog, the choice of a solution and its application.

Tables of cells and of pits compress very well, and Spark takes the size of their files for that of their rows.  So joins
with them are hinted as merges: what grows with the grid is never collected to be broadcast.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from rillstone.operators.components import OUTSIDE, spill_levels
from rillstone.operators.focal import moving, neighbours
from rillstone.operators.tiles import SIDE, dense, map_tiles, near_tiles, places_of
from rillstone.operators.zones import clump, label
from rillstone.storage import beside, materialize

#: Labels of places without a height, and of those that no flood has met.
NOWHERE, UNSEEN = -3, -2
EIGHT = ("e", "ne", "n", "nw", "w", "sw", "s", "se")


def single_cell_pits(cells: DataFrame, value: str = "z", out: str = "out", method: str = "fill") -> DataFrame:
    """Adds out: a cell lower than all its eight neighbours rises to the lowest of them (fill), or the lowest of them falls to it (breach)."""
    if method == "fill":
        return _fill_single(cells, value, out)
    near = neighbours(cells, value)
    low = F.least(*[F.col(d) for d in EIGHT])
    whole = F.col("e").isNotNull()
    for d in EIGHT[1:]:
        whole &= F.col(d).isNotNull()
    pit = whole & (F.col(value) < low)
    marked = near.withColumn("_pit", F.when(pit, F.col(value))).withColumn("_low", F.when(pit, low)).select(*cells.columns, "_pit", "_low")
    around = moving(marked, {"_p": ("min", "_pit", 1), "_l": ("min", "_low", 1)})
    cut = (F.col(value) == F.col("_l")) & F.col("_pit").isNull()
    return around.withColumn(out, F.when(cut & F.col("_p").isNotNull(), F.least("_p", value)).otherwise(F.col(value))).select(*cells.columns, out)


def _fill_single(cells: DataFrame, value: str, out: str) -> DataFrame:
    place = cells.columns.index(value)

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, 1)
        core = (i > 0) & (i <= SIDE) & (j > 0) & (j <= SIDE)
        if not core.any():
            return None
        column, own = table.column(place).combine_chunks(), table.filter(pa.array(core))
        # the row of each place's value, and of each core cell's eight
        at = np.full((SIDE + 2, SIDE + 2), -1)
        there = column.is_valid().to_numpy(zero_copy_only=False)
        at[i[there], j[there]] = np.flatnonzero(there)
        near = np.stack([at[i[core] + di, j[core] + dj] for di in (-1, 0, 1) for dj in (-1, 0, 1) if di or dj])
        z = column.fill_null(0).to_numpy(zero_copy_only=False)
        low = z[near].min(axis=0)
        pit = (near >= 0).all(axis=0) & there[core] & (z[core] < low)
        new = pa.array(np.where(pit, low, z[core]), mask=~there[core])
        return own.append_column(out, new)

    return map_tiles(cells, 1, run, StructType([*cells.schema.fields, StructField(out, cells.schema[value].dataType)]))


def _flood(z: np.ndarray, start: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Local fill of one tile: (level, label) of each place, where label is the name of the start that reaches it at the least level.

    z has a rim of nan; places without a height are nan and get no label (NOWHERE).
    """
    stride = z.shape[1]
    height, level, tag = z.ravel().tolist(), z.ravel().tolist(), np.where(np.isnan(z), NOWHERE, UNSEEN).ravel()
    tag[start] = names
    tag = tag.tolist()
    heap = [(height[i], i) for i in start.tolist()]
    heapq.heapify(heap)
    steps = (1, -1, stride, -stride, stride + 1, stride - 1, -stride + 1, -stride - 1)
    under: list[int] = []  # places below the present level, which need no order
    while heap or under:
        i = under.pop() if under else heapq.heappop(heap)[1]
        v, name = level[i], tag[i]
        for s in steps:
            j = i + s
            if tag[j] == UNSEEN:
                tag[j] = name
                if height[j] <= v:
                    level[j] = v
                    under.append(j)
                else:
                    heapq.heappush(heap, (height[j], j))
    return np.array(level).reshape(z.shape), np.array(tag).reshape(z.shape)


def _lowest_ways(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning forest of the edges (a, b, w): the least highest weight between any two nodes is kept."""
    order = np.lexsort((b, a, w))
    nodes, ends = np.unique(np.concatenate([a, b])[np.concatenate([order, order + len(a)])], return_inverse=True)
    root, kept = list(range(len(nodes))), []
    for k, (x, y) in enumerate(zip(ends[: len(a)].tolist(), ends[len(a) :].tolist(), strict=True)):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[x] = y
            kept.append(k)
    found = order[kept]
    return a[found], b[found], w[found]


def fill_depressions(cells: DataFrame, value: str, n_cols: int, block: int = SIDE, out: str = "filled", few: int = 500_000) -> DataFrame:
    """Adds out: the least level at which each cell drains to the grid's edge or to missing cells.

    Each block is flooded on its own from its rim and from its outlets, which are all outside; where two floods meet, the labels
    get an edge with the higher of the two levels, of which a block keeps a minimum spanning forest.  Cells of different blocks
    meet at their rims only.  The least level at which each label spills (the minimax of paths) comes from
    spill_levels, whose rounds grow with the logarithm of the labels, and a cell's fill is the higher of its
    local fill and its label's level.  Cells move to their blocks once, with all their columns; a block is block x block cells.
    """
    # edges are rows without cells
    rest = [StructField(f.name, f.dataType) for f in cells.schema if f.name not in ("r", "c")]
    schema = StructType([StructField("r", LongType()), StructField("c", LongType()), *rest])
    for name, kind in (("_f", DoubleType()), ("_label", LongType()), ("_kind", IntegerType()), ("_a", LongType()), ("_b", LongType()), ("_w", DoubleType())):
        schema = schema.add(name, kind)
    width = block + 2

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, 1)
        core = (i > 0) & (i <= block) & (j > 0) & (j <= block)
        if not core.any():
            return None
        own, i, j = table.filter(pa.array(core)), i[core], j[core]
        around = dense(table, value, *places_of(table, r0, c0, 1), width)
        z = np.full((width, width), np.nan)
        z[i, j] = around[i, j]
        there, inner = ~np.isnan(around), ~np.isnan(z)
        whole = np.zeros((width, width), bool)
        whole[1:-1, 1:-1] = np.logical_and.reduce([there[1 + di : width - 1 + di, 1 + dj : width - 1 + dj] for di in (-1, 0, 1) for dj in (-1, 0, 1)])
        edge = np.zeros((width, width), bool)
        edge[[1, -2], :] = edge[:, [1, -2]] = True
        ids = (np.arange(width)[:, None] + (r0 - 1)) * n_cols + (np.arange(width) + (c0 - 1))
        start = np.flatnonzero((inner & (edge | ~whole)).ravel())
        level, tag = _flood(z, start, np.where(whole, ids, OUTSIDE).ravel()[start])
        a, b, w = [], [], []
        for di, dj in ((0, 1), (1, 0), (1, 1), (1, -1)):
            x, y = tag[1 : width - 1, 1:-1], tag[1 + di : width - 1 + di, 1 + dj : width - 1 + dj]
            met = (x != y) & (x >= OUTSIDE) & (y >= OUTSIDE)
            a.append(x[met])
            b.append(y[met])
            w.append(np.maximum(level[1 : width - 1, 1:-1], level[1 + di : width - 1 + di, 1 + dj : width - 1 + dj])[met])
        a, b, w = _lowest_ways(np.concatenate(a), np.concatenate(b), np.concatenate(w))
        # rim cells that other blocks may meet, and by what name; the outside needs no more ways
        rim = edge[i, j] & inner[i, j]
        n, m, k = own.num_rows, len(a), int(rim.sum())
        out_ = own.set_column(own.schema.get_field_index("r"), "r", own.column("r").cast(pa.int64())) if own.schema.field("r").type != pa.int64() else own
        out_ = out_.set_column(out_.schema.get_field_index("c"), "c", out_.column("c").cast(pa.int64())) if out_.schema.field("c").type != pa.int64() else out_
        held = tag[i, j] >= OUTSIDE
        main = {f.name: out_.column(f.name).combine_chunks() for f in out_.schema}
        far = {"r": np.concatenate([np.zeros(m, np.int64), i[rim] + (r0 - 1)]), "c": np.concatenate([np.zeros(m, np.int64), j[rim] + (c0 - 1)])}
        columns = {name: pa.concat_arrays([main[name], pa.array(far[name], pa.int64()) if name in far else pa.nulls(m + k, main[name].type)]) for name in ("r", "c", *(f.name for f in rest))}
        columns["_f"] = pa.array(np.concatenate([level[i, j], np.zeros(m), level[i, j][rim]]), mask=np.concatenate([~held, np.ones(m, bool), np.zeros(k, bool)]))
        columns["_label"] = pa.array(np.concatenate([tag[i, j], np.zeros(m, np.int64), tag[i, j][rim]]), mask=np.concatenate([~held, np.ones(m, bool), np.zeros(k, bool)]))
        columns["_kind"] = pa.array(np.repeat([0, 1, 2], [n, m, k]), pa.int32())
        for name, ends in (("_a", a), ("_b", b), ("_w", w)):
            columns[name] = pa.concat_arrays([pa.nulls(n, pa.float64() if name == "_w" else pa.int64()), pa.array(ends), pa.nulls(k, pa.float64() if name == "_w" else pa.int64())])
        return pa.table(columns)

    found = materialize(map_tiles(cells.select("r", "c", *(f.name for f in rest)), 1, run, schema, (), block), "floods")
    local = found.where("_kind = 0").drop("_kind", "_a", "_b", "_w")
    within = found.where("_kind = 1").select(F.col("_a").alias("a"), F.col("_b").alias("b"), F.col("_w").alias("w"))
    rim = found.where("_kind = 2").select("r", "c", F.col("_label").alias("b"), F.col("_f").alias("fb"))
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, 0), (1, 1), (1, -1))]))
    sent = rim.select(F.col("b").alias("a"), F.col("fb").alias("fa"), "r", "c", step.alias("s")).select("a", "fa", "r", "c", (F.col("r") + F.col("s.i")).alias("_r"), (F.col("c") + F.col("s.j")).alias("_c"))
    sent = sent.where((F.floor(F.col("r") / block) != F.floor(F.col("_r") / block)) | (F.floor(F.col("c") / block) != F.floor(F.col("_c") / block)))
    met = sent.select("a", "fa", F.col("_r").alias("r"), F.col("_c").alias("c")).join(rim.hint("merge"), ["r", "c"]).where("a <> b")
    pairs = within.unionByName(met.select("a", "b", F.greatest("fa", "fb").alias("w")))
    ends = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w").groupBy("a", "b").agg(F.min("w").alias("w"))
    ends = materialize(ends, "flood-edges")
    level = spill_levels(ends.where(F.col("a") != OUTSIDE), ends.where(F.col("a") == OUTSIDE).select(F.col("b").alias("node"), "w"), few)
    # what the outside fills is done; those cells and missing ones seek no label, each by a key of its own
    none = -2 - (F.col("r") * n_cols + F.col("c"))
    sought = local.withColumn("_key", F.when(F.col("_label") > OUTSIDE, F.col("_label")).otherwise(none))
    done = sought.join(beside(level).select(F.col("node").alias("_key"), F.col("level").alias("_level")), "_key", "left")
    return done.select("r", "c", *(f.name for f in rest), F.greatest("_f", "_level").alias(out))


def pit_zones(cells: DataFrame, filled: str, value: str, n_cols: int, buffer: int = 0) -> DataFrame:
    """(r, c, label) of pits: cells that filling raised."""
    return clump(cells, F.col(filled) > F.col(value), n_cols, buffer)


def fill_shallow(cells: DataFrame, pits: DataFrame, depth: float, filled: str = "filled", value: str = "z", water: str = "water") -> DataFrame:
    """value of pits no deeper than depth and without water becomes the filled one; pits has r, c, label."""
    held = pits.hint("merge").join(cells, ["r", "c"])
    shallow = held.groupBy("label").agg(F.max(F.col(filled) - F.col(value)).alias("d"), F.max(water).alias("w")).where((F.col("d") <= depth) & (F.coalesce("w", F.lit(0)) == 0)).select("label")
    chosen = pits.join(shallow, "label", "left_semi").select("r", "c", F.lit(True).alias("_s"))
    return cells.join(chosen.hint("merge"), ["r", "c"], "left").withColumn(value, F.when(F.col("_s"), F.col(filled)).otherwise(F.col(value))).drop("_s")


def raise_lake_pits(cells: DataFrame, pits: DataFrame, lake: Column, step: float, min_cells: int = 20, value: str = "z") -> DataFrame:
    """In pits with more than min_cells lake cells, cells below the lake's lowest rise to it plus step."""
    held = pits.hint("merge").join(cells.withColumn("_lake", lake), ["r", "c"])
    level = held.groupBy("label").agg(F.min(F.when(F.col("_lake"), F.col(value))).alias("_lo"), F.count_if("_lake").alias("_n")).where(F.col("_n") > min_cells)
    raised = pits.join(level, "label").select("r", "c", (F.col("_lo") + step).alias("_to"), "_lo")
    return cells.join(raised.hint("merge"), ["r", "c"], "left").withColumn(value, F.when(F.col(value) < F.col("_lo"), F.col("_to")).otherwise(F.col(value))).drop("_to", "_lo")


def fill_behind(cells: DataFrame, carves: DataFrame, pits: DataFrame, n_cols: int, value: str = "z") -> tuple[DataFrame, DataFrame]:
    """cells with carved (the surface after carving, then filled again where water still stands), and what that fill raised above ground.

    carves has r, c and value, at most one row per cell; pits has r, c, label.  The second table has r, c and
    the label of the pit that a raised cell lies in.
    """
    cut = cells.join(carves.select("r", "c", F.col("value").alias("_cut")).hint("merge"), ["r", "c"], "left").withColumn("_cut", F.coalesce("_cut", F.col(value).cast("double")))
    done = materialize(fill_depressions(cut, "_cut", n_cols, out="carved").drop("_cut"), "carved")
    raised = done.where(F.col("carved") > F.col(value)).select("r", "c").join(pits.select("r", "c", "label").hint("merge"), ["r", "c"])
    return done, raised


def pit_catalog(cells: DataFrame, pits: DataFrame, carves: DataFrame, behind: DataFrame, n_cols: int) -> DataFrame:
    """One row per pit: maxfill, volfill, n, carves attached, maxcarve, volcarve, maxfillbehind, volfillbehind, completecarve.

    cells has z, filled, carved (after carving and filling behind); pits, carves and behind have r, c,
    label.  A carve belongs to a pit that it touches if its highest cell lies in the pit or its lowest
    does not; a pit that a carve labelled 0 (open edge) touches has none.
    """
    c = cells.select("r", "c", "z", "filled", "carved", (F.col("r") * n_cols + F.col("c")).alias("i")).hint("merge")
    pit = pits.select("r", "c", F.col("label").alias("pit")).hint("merge")
    base = pit.join(c, ["r", "c"]).groupBy("pit").agg(F.max(F.col("filled") - F.col("z")).alias("maxfill"), F.sum(F.col("filled") - F.col("z")).alias("volfill"), F.count("*").alias("n"))
    cut = carves.select("r", "c", F.col("label").alias("carve")).join(c, ["r", "c"])
    ends = cut.groupBy("carve").agg(F.max_by("i", F.struct("z", -F.col("i"))).alias("top"), F.min_by("i", F.struct("z", "i")).alias("bottom"))
    inside = pit.withColumn("i", F.col("r") * n_cols + F.col("c")).select("i", "pit")
    touch = carves.select("r", "c", F.col("label").alias("carve")).join(pit, ["r", "c"]).select("pit", "carve").distinct()
    placed = touch.join(ends.hint("merge"), "carve").join(inside.select(F.col("i").alias("top"), F.col("pit").alias("top_pit")), "top", "left").join(inside.select(F.col("i").alias("bottom"), F.col("pit").alias("bottom_pit")), "bottom", "left")
    placed = placed.where((F.col("top_pit") == F.col("pit")) | F.col("bottom_pit").isNull() | (F.col("bottom_pit") != F.col("pit")))
    open_ = touch.where("carve = 0").select("pit").distinct()
    own = placed.join(open_.hint("merge"), "pit", "left_anti").select("pit", "carve")
    cost = cut.groupBy("carve").agg(F.abs(F.min(F.col("carved") - F.col("z"))).alias("mc"), F.abs(F.sum(F.col("carved") - F.col("z"))).alias("vc"), F.count("*").alias("k"))
    carved = own.join(cost.hint("merge"), "carve").groupBy("pit").agg(F.count("*").alias("carves"), F.max("mc").alias("maxcarve"), F.sum("vc").alias("volcarve"), F.sum("k").alias("cells"))
    back = behind.select("r", "c").join(pit, ["r", "c"]).join(c, ["r", "c"]).groupBy("pit").agg(F.max(F.col("carved") - F.col("z")).alias("maxfillbehind"), F.sum(F.col("carved") - F.col("z")).alias("volfillbehind"))
    out = base.join(carved, "pit", "left").join(back, "pit", "left").na.fill(0)
    return out.withColumn("completecarve", F.when(F.col("cells") > 0, 1).otherwise(0)).drop("cells")


@dataclass(frozen=True)
class SolutionLimits:
    fill: float = 12_000.0
    carve: float = 4_000.0
    max_carve_depth: float = 100.0
    shallow: bool = True
    water_allowance: float = 5.0


def select_solution(pits: DataFrame, limits: SolutionLimits = SolutionLimits()) -> DataFrame:
    """Adds solution, the first rule that holds.

    pits has the catalog's columns and n_wall, n_sink (fill cells in walls, sinks), n_carve, n_carve_water.
    """
    depth = F.abs("maxcarve") + F.abs("maxfillbehind")
    vol = F.abs("volcarve") + F.abs("volfillbehind")
    limit = F.col("maxfill") * 1.25 + F.when(F.col("n_carve_water") > 0, limits.water_allowance).otherwise(0.0)
    valid = (F.col("completecarve") == 1) & (depth <= limits.max_carve_depth) & (F.col("maxcarve") <= limit)
    thin = (F.col("maxfill") / F.col("n") < 0.01) & (F.col("volfill") / F.col("n") < 1)
    mostly_behind = F.abs("volfillbehind") >= F.col("volfill") * 0.9
    small_fill = F.col("volfill") < limits.fill
    cheaper = F.when(vol > limits.fill, F.when(thin, 1006).when(mostly_behind, 2004).otherwise(4000)).when(F.col("volcarve") < limits.carve, 1200).when(small_fill, 2000).otherwise(4000)
    dearer = F.when(small_fill, F.when(F.col("volcarve") < limits.carve, 2100).otherwise(2000)).when(mostly_behind, 2004).otherwise(4000)
    carve = F.when(F.col("n_carve_water") == F.col("n_carve"), 1002).when(vol < F.col("volfill"), cheaper).otherwise(dearer)
    rule = F.when(F.col("n_wall") == F.col("n"), 1).when(F.col("n_sink") > 0, 7)
    if limits.shallow:
        rule = rule.when(thin, 2006)
    rule = rule.when(F.col("maxfill") < 0.01, 2005)
    return pits.withColumn("solution", rule.when(valid, carve).when(small_fill, 2009).otherwise(4000))


def apply_solution(cells: DataFrame, solved: DataFrame, pit_cells: DataFrame, carve_cells: DataFrame, behind_cells: DataFrame) -> DataFrame:
    """Adds solved and code: filled cells for 2xxx, carved cells and then the fill behind for 1xxx; on shared cells the later pit wins.

    solved has pit, solution; the cell tables have r, c, pit and value.  Walls (1), sinks (7) and
    solutions above 3000 change no height; their codes are kept.
    """
    solved = solved.select("pit", "solution").hint("merge")
    fill = pit_cells.join(solved.where("solution between 2000 and 2999"), "pit").select("r", "c", "pit", F.lit(0).alias("phase"), "value", "solution")
    carve = carve_cells.join(solved.where("solution between 1000 and 1999"), "pit").select("r", "c", "pit", F.lit(0).alias("phase"), "value", "solution")
    back = behind_cells.join(solved.where("solution between 1000 and 1999"), "pit").select("r", "c", "pit", F.lit(1).alias("phase"), "value", "solution")
    marks = pit_cells.join(solved.where("solution > 3000 or solution in (1, 7)"), "pit").select("r", "c", "pit", F.lit(-1).alias("phase"), F.lit(None).cast("double").alias("value"), "solution")
    writes = fill.unionByName(carve).unionByName(back).select("r", "c", "pit", "phase", F.col("value").cast("double").alias("value"), "solution").unionByName(marks)
    last = writes.groupBy("r", "c").agg(F.max_by(F.struct("value", "solution"), F.struct("pit", "phase")).alias("w"))
    out = cells.join(last, ["r", "c"], "left")
    return out.withColumns({"solved": F.coalesce("w.value", F.col("z").cast("double")), "code": F.coalesce("w.solution", F.lit(0))}).drop("w")


@dataclass(frozen=True)
class Carving:
    """How carves are sought: constrained (the least depth cut, then the shortest) or, with least_cost, by the cost of all that is cut.

    least_cost ways end at max_cost, weigh each step by its length if shortest, and fall by increment a step.
    """

    radius: int = 50
    max_depth: float = 1e9
    least_cost: bool = False
    max_cost: float = float("inf")
    shortest: bool = False
    increment: float = 0.0


#: Steps to the eight neighbours and their lengths.
_STEPS = tuple((i, j, (i * i + j * j) ** 0.5) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j)


def _carve(z: list[float], stride: int, start: int, how: Carving, raised: dict[int, float]) -> tuple[list[int], list[float]] | None:
    """The way of at most radius steps from a pit's lowest cell to a lower one, over the places of a tile, and its heights.

    Its cost is the depth to cut.  A cell keeps each way that no other beats in both cost and length, as a dearer but
    shorter one may go further.  Places without a height are nan.
    """
    row, col = divmod(start, stride)
    low = raised.get(start, z[start])
    came, best, heap, shortest = {(start, 0): None}, {}, [(0.0, 0, start)], {}
    while heap:
        cost, length, here = heapq.heappop(heap)
        # ways come in order of cost, so only shorter ones than before are of use
        if length >= shortest.get(here, length + 1):
            continue
        shortest[here] = length
        at = raised.get(here, z[here])
        if at < low - how.increment * length:
            path = []
            while here is not None:
                path.append(here)
                here, length = came[here, length], length - 1
            path.reverse()
            n, ground = len(path) - 1, [raised.get(p, z[p]) for p in path]
            if how.least_cost:
                return path, [min(g, low - how.increment * k) for k, g in enumerate(ground)]
            return path, [min(g, low + (at - low) * k / n) for k, g in enumerate(ground)]
        if length == how.radius:
            continue
        for i, j, away in _STEPS:
            there = here + i * stride + j
            if abs(there // stride - row) > how.radius or abs(there % stride - col) > how.radius or length + 1 >= shortest.get(there, length + 2):
                continue
            height = raised.get(there, z[there])
            if height - low <= how.max_depth:  # not if nan
                new = cost + max(0.0, height - (low - how.increment * (length + 1))) * (away if how.shortest else 1.0)
                if new <= how.max_cost and new < best.get((there, length + 1), float("inf")):
                    came[there, length + 1], best[there, length + 1] = here, new
                    heapq.heappush(heap, (new, length + 1, there))
    return None


def breach_depressions(cells: DataFrame, bottoms: DataFrame, radius: int = 50, max_depth: float = 1e9, raised: DataFrame | None = None, how: Carving | None = None, side: int = SIDE) -> DataFrame:
    """(pit, r, c, value): the carve of each pit that has a way to lower ground within radius steps and max_depth.

    bottoms has pit, r, c of each pit's lowest cell; raised (pit, r, c, level) holds heights that one
    pit sees instead of the ground's.  how (see Carving) takes the place of radius and max_depth.  A tile holds its cells and
    those within radius once, for all pits whose lowest cell it has.  Heights along a constrained way fall
    evenly and never rise above the surface.
    """
    how = how or Carving(radius, max_depth)
    reach = how.radius + 1  # a rim of nothing around
    bottoms = materialize(bottoms.select("pit", "r", "c"), "bottoms")
    held = near_tiles(cells.select("r", "c", "z"), bottoms, reach, side).where("z is not null").select("r", "c", F.col("z").cast("double").alias("z"), F.lit(None).cast("long").alias("pit"), F.lit(0).alias("kind"))
    held = held.unionByName(bottoms.select("r", "c", F.lit(None).cast("double").alias("z"), F.col("pit").cast("long").alias("pit"), F.lit(1).alias("kind")))
    if raised is not None:
        held = held.unionByName(raised.select("r", "c", F.col("level").cast("double").alias("z"), F.col("pit").cast("long").alias("pit"), F.lit(2).alias("kind")))
    width = side + 2 * reach

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, reach)
        kind, pit = table.column("kind").to_numpy(), table.column("pit").fill_null(0).to_numpy()
        place, value = i * width + j, table.column("z").fill_null(0).to_numpy()
        starts = np.flatnonzero((kind == 1) & (i >= reach) & (i < reach + side) & (j >= reach) & (j < reach + side))
        if not len(starts):
            return None
        z = np.full(width * width, np.nan)
        z[place[kind == 0]] = value[kind == 0]
        z[[*range(width), *range(width * (width - 1), width * width)]] = np.nan
        own: dict[int, dict[int, float]] = {}
        for k in np.flatnonzero((kind == 2) & np.isin(pit, pit[starts])).tolist():
            own.setdefault(int(pit[k]), {})[int(place[k])] = float(value[k])
        z, names, where, heights = z.tolist(), [], [], []
        for k in starts.tolist():
            found = _carve(z, width, int(place[k]), how, own.get(int(pit[k]), {}))
            if found is not None:
                names += [int(pit[k])] * len(found[0])
                where += found[0]
                heights += found[1]
        row, col = np.divmod(np.array(where, np.int64), width)
        return pa.Table.from_arrays([pa.array(names, pa.int64()), pa.array(row + r0 - reach), pa.array(col + c0 - reach), pa.array(heights, pa.float64())], names=["pit", "r", "c", "value"])

    return map_tiles(held, reach, run, "pit long, r long, c long, value double", (), side)


def breach_and_fill(cells: DataFrame, bottoms: DataFrame, n_cols: int, how: Carving = Carving(least_cost=True), out: str = "out") -> DataFrame:
    """Adds out: the surface after the carves (the lowest where they cross), and then a fill of the pits that are left."""
    lowest = breach_depressions(cells, bottoms, how=how).groupBy("r", "c").agg(F.min("value").alias("_cut"))
    cut = materialize(cells.join(lowest, ["r", "c"], "left").withColumn("_cut", F.least(F.col("z").cast("double"), "_cut")), "breached")
    return fill_depressions(cut, "_cut", n_cols, out=out).drop("_cut")


def partial_fills(cells: DataFrame, pits: DataFrame, pit_cells: DataFrame, interval: float = 0.2, radius: int = 50, max_depth: float = 1e9) -> tuple[DataFrame, DataFrame]:
    """Every way to solve each pit (pit, solution, volume), and the cells that it writes (pit, solution, r, c, value).

    pits has pit, maxfill, volfill; pit_cells has pit, r, c, z, filled.  The ways are filling wholly
    (2003), carving wholly (1003), and for each fraction f below 1 in steps of interval (0.1 or
    more, so that each has a code of its own) the fill lowered by maxfill * (1 - f), not below ground, with a carve from the lowest cell
    of that surface (3000 + 10 f).  Partial fills stand only where the pit has no carve of its own,
    which would lie below any of them.  A way without a carve, or with one deeper than max_depth below ground,
    drops out.  The volume is that of all changes of height, carved cells of the pit counted once.
    """
    if interval < 0.1:
        raise ValueError("fractions closer than 0.1 would share a code")
    steps = F.sequence(F.lit(0), F.lit(round(1 / interval) - 1))
    plans = pit_cells.join(pits.select("pit", "maxfill").hint("merge"), "pit").withColumn("k", F.explode(steps)).withColumn("f", F.col("k") * interval)
    plans = plans.withColumn("level", F.greatest(F.col("z").cast("double"), F.col("filled") - F.col("maxfill") * (1 - F.col("f"))))
    plans = materialize(plans.select((F.col("pit") * 1000 + F.col("k")).alias("pit"), "r", "c", F.col("z").cast("double").alias("z"), "level"), "partial-levels")
    bottoms = plans.groupBy("pit").agg(F.min_by(F.struct("r", "c"), F.struct("level", "r", "c")).alias("b")).select("pit", "b.r", "b.c")
    carved = materialize(breach_depressions(cells, bottoms, radius, max_depth, plans).join(cells.select("r", "c", F.col("z").cast("double").alias("z")).hint("merge"), ["r", "c"]), "partial-carves")
    k, pit = F.col("pit") % 1000, F.floor(F.col("pit") / 1000)
    cost = carved.groupBy("pit").agg(F.sum(F.abs(F.col("z") - F.col("value"))).alias("cut"), F.max(F.col("z") - F.col("value")).alias("deep")).where(F.col("deep") <= max_depth)
    whole = cost.where(k == 0).select(pit.alias("own")).distinct()
    kept = cost.join(whole, (pit == F.col("own")) & (k > 0), "left_anti").hint("merge")
    rest = plans.join(carved.select("pit", "r", "c").hint("merge"), ["pit", "r", "c"], "left_anti").join(kept.select("pit"), "pit")
    fill = rest.groupBy("pit").agg(F.sum(F.col("level") - F.col("z")).alias("fill"))
    code = F.when(k == 0, 1003).otherwise(3000 + F.round(k * 10 * interval)).cast("int").alias("solution")
    ways = kept.join(fill, "pit", "left").select(pit.alias("pit"), code, (F.coalesce("fill", F.lit(0.0)) + F.col("cut")).alias("volume"))
    ways = ways.unionByName(pits.select("pit", F.lit(2003).alias("solution"), F.col("volfill").cast("double").alias("volume")))
    writes = rest.select(pit.alias("pit"), code, "r", "c", F.col("level").alias("value"))
    writes = writes.unionByName(carved.join(kept.select("pit"), "pit").select(pit.alias("pit"), code, "r", "c", "value"))
    return ways, writes.unionByName(pit_cells.select("pit", F.lit(2003).alias("solution"), "r", "c", F.col("filled").cast("double").alias("value")))


def partial_fill(cells: DataFrame, pits: DataFrame, pit_cells: DataFrame, interval: float = 0.2, radius: int = 50, max_depth: float = 1e9) -> DataFrame:
    """(pit, solution, volume): of the ways of partial_fills the one with the least volume, ties to the smaller code."""
    ways, _ = partial_fills(cells, pits, pit_cells, interval, radius, max_depth)
    return ways.groupBy("pit").agg(F.min_by(F.struct("solution", "volume"), F.struct("volume", "solution")).alias("s")).select("pit", "s.solution", "s.volume")


def apply_partial(cells: DataFrame, writes: DataFrame) -> DataFrame:
    """z and code after the chosen footprints (r, c, pit, value, solution), in order of pits."""
    last = writes.groupBy("r", "c").agg(F.max_by(F.struct("value", "solution"), "pit").alias("w"))
    return cells.join(last, ["r", "c"], "left").withColumns({"z": F.coalesce("w.value", F.col("z").cast("double")), "code": F.coalesce("w.solution", F.lit(0))}).drop("w")


def final_fill_and_diff(cells: DataFrame, value: str, original: str, n_cols: int, sinks: DataFrame | None = None, digits: int = 3) -> DataFrame:
    """Adds final (the last fill, null at sinks) and diff against the original."""
    filled = fill_depressions(cells, value, n_cols, out="final")
    if sinks is not None:
        filled = filled.join(sinks.select("r", "c", F.lit(True).alias("_k")), ["r", "c"], "left").withColumn("final", F.when(F.col("_k").isNull(), F.col("final"))).drop("_k")
    return filled.withColumn("diff", F.round(F.col("final") - F.col(original), digits))


def unsolved_units(pits: DataFrame, unit: str, above: int = 8000) -> DataFrame:
    return pits.where(F.col("solution") > above).select(unit).distinct()


def empty_units(cells: DataFrame, unit: str, value: str) -> DataFrame:
    return cells.groupBy(unit).agg(F.count(value).alias("n")).where("n = 0").select(unit)


def condition_unit(
    cells: DataFrame, n_cols: int, shallow: float, radius: int = 20, limits: SolutionLimits = SolutionLimits(), walls: DataFrame | None = None, wall_height: float = 0.0, wall_floors: dict[int, float] | None = None,
    sinks: DataFrame | None = None, lake_step: float | None = None, interval: float = 0.2, metre: float | None = None, reservoirs: DataFrame | None = None, cell_metres: tuple[float, float] = (12.0, 12.0),
    rim_metres: float = 150.0, heights: Sequence[float] | None = None,
) -> DataFrame:
    """The conditioning of a grid with z and water (0/1); adds solved, code and final.

    If metre, the units of height in one, is given, cells has swo and class too, the water class, and the river steps
    take part.  In order: single-cell pits; humps of rivers lowered and narrow rivers brought to their window's
    minimum (river steps); barriers where reservoirs (r, c, zone) cross the grid's rim; walls (r, c, wall) raised by wall_height; fill and pits; pits with lakes
    raised by lake_step above the lake; shallow pits; carves and the fill behind them; catalog; choice;
    application; the pits left over (4000) filled in part and carved, if that is less than filling
    them; walls taken off (with wall_floors); small streams and rivers raised above large ones beside them (river
    steps); the last fill, with no height at sinks (r, c) and barriers.
    """
    from rillstone.operators.ladders import monotonic_rivers
    from rillstone.operators.water import noflow_wall, raise_small, remove_wall, reservoir_barrier, river_minimize

    start = single_cell_pits(cells, "z", "_z").withColumn("z", F.col("_z")).drop("_z")
    if metre is not None:
        mono = monotonic_rivers(materialize(start.withColumnRenamed("class", "code"), "unit-start"), n_cols, None, metre, radius, heights=heights).withColumnRenamed("code", "class")
        river = river_minimize(materialize(mono, "unit-mono").withColumn("river", F.col("class").between(4, 7).cast("int")), 2, 15 * metre)
        start = river.withColumn("z", F.col("low").cast("double")).drop("low", "river")
    barrier = None
    if reservoirs is not None:
        start = materialize(start, "unit-open")
        raised = reservoir_barrier(start, reservoirs, start.select("r", "c"), n_cols, rim_metres, *cell_metres, 20 * (metre or 1.0), limits.max_carve_depth)
        barrier = materialize(raised.where("wall = 1").select("r", "c"), "unit-barrier")
        start = raised.drop("wall")
    if walls is not None:
        start = noflow_wall(start, walls, wall_height)
    filled = materialize(fill_depressions(materialize(start, "unit"), "z", n_cols), "unit-filled")
    pits = materialize(label(filled, F.col("filled") > F.col("z"), n_cols, out="label"), "unit-pits")
    if lake_step is not None:
        raised = raise_lake_pits(filled, pits, F.col("water") == 1, lake_step).drop("filled", "label")
        filled = materialize(fill_depressions(materialize(raised, "unit-raised"), "z", n_cols), "unit-filled")
        pits = materialize(label(filled, F.col("filled") > F.col("z"), n_cols, out="label"), "unit-pits")
    level = materialize(fill_shallow(filled, pits, shallow), "unit-level")
    held = materialize(pits.hint("merge").join(level, ["r", "c"]).where("filled > z").withColumn("pit", F.col("label").cast("long")), "unit-held")
    bottoms = held.groupBy("pit").agg(F.min_by(F.struct("r", "c"), F.struct("z", "r", "c")).alias("b")).select("pit", "b.r", "b.c")
    carve = materialize(breach_depressions(level, bottoms, radius, limits.max_carve_depth), "unit-carves")
    lowest = carve.groupBy("r", "c").agg(F.min("value").alias("value"), F.min_by("pit", F.struct("value", "pit")).alias("label"))
    done, behind = fill_behind(level, lowest, held.select("r", "c", F.col("pit").alias("label")), n_cols)
    wet = carve.join(level.select("r", "c", "water").hint("merge"), ["r", "c"]).groupBy("pit").agg(F.count("*").alias("n_carve"), F.count_if(F.col("water") == 1).alias("n_carve_water"))
    catalog = pit_catalog(done, held.select("r", "c", F.col("pit").alias("label")), lowest, behind, n_cols).join(wet, "pit", "left")
    marks = held.select("pit", "r", "c")
    in_wall = marks.join(walls.select("r", "c"), ["r", "c"], "left_semi") if walls is not None else marks.limit(0)
    in_sink = marks.join(sinks.select("r", "c"), ["r", "c"], "left_semi") if sinks is not None else marks.limit(0)
    catalog = catalog.join(in_wall.groupBy("pit").agg(F.count("*").alias("n_wall")), "pit", "left").join(in_sink.groupBy("pit").agg(F.count("*").alias("n_sink")), "pit", "left").na.fill(0)
    solved = materialize(select_solution(catalog, limits), "unit-solutions")
    back = behind.select("r", "c", F.col("label").alias("pit")).join(done.select("r", "c", F.col("carved").alias("value")).hint("merge"), ["r", "c"])
    out = materialize(apply_solution(level, solved, held.select("r", "c", "pit", F.col("filled").alias("value")), carve, back), "unit-solved")
    left = solved.where("solution = 4000").select("pit", "maxfill", "volfill")
    surface = out.withColumn("z", F.col("solved"))
    ways, writes = partial_fills(surface, left, held.select("pit", "r", "c", "filled").join(surface.select("r", "c", "z").hint("merge"), ["r", "c"]), interval, radius, limits.max_carve_depth)
    best = ways.groupBy("pit").agg(F.min_by("solution", F.struct("volume", "solution")).alias("solution"))
    chosen = writes.join(best, ["pit", "solution"]).groupBy("r", "c").agg(F.max_by(F.struct("value", "solution"), "pit").alias("_w"))
    out = out.join(chosen, ["r", "c"], "left").withColumns({"solved": F.coalesce("_w.value", "solved"), "code": F.coalesce("_w.solution", "code")}).drop("_w", "filled")
    if walls is not None:
        bare = remove_wall(out.withColumns({"fill": F.col("solved") - F.col("z"), "z": F.col("solved")}), wall_floors or {}, 0.0, 0.0)
        out = bare.withColumn("solved", F.col("z")).drop("fill", "wall", "base")
    if metre is not None:
        # small waters beside rivers end above them: streams, then narrow rivers beside wide ones
        for small, large in ((F.col("class").between(8, 10) | (F.col("class") == 13), F.col("class").between(4, 7)), (F.col("class").between(4, 7) & (F.col("swo") < 50), F.col("class").between(4, 7) & (F.col("swo") >= 90))):
            raised = raise_small(out.withColumn("z", F.col("solved").cast("double")), small, large, 2, 0.4 * metre, 5 * metre)
            out = materialize(raised.withColumn("solved", F.col("raised").cast("double")).drop("raised"), "unit-raised")
    final = fill_depressions(materialize(out.withColumn("z", F.col("solved")), "unit-out"), "solved", n_cols, out="final")
    if barrier is not None:
        sinks = barrier if sinks is None else sinks.select("r", "c").unionByName(barrier).distinct()
    if sinks is not None:
        final = final.join(sinks.select("r", "c", F.lit(True).alias("_k")), ["r", "c"], "left").withColumn("final", F.when(F.col("_k").isNull(), F.col("final"))).drop("_k")
    return final
