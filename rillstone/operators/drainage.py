"""Flow direction, accumulation and their checks; sinks of closed basins."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from rillstone.operators.spatial import sequential_id
from rillstone.operators.tiles import SIDE, dense, map_tiles, places_of
from rillstone.operators.zones import label, largest_zone
from rillstone.storage import materialize, remove, write_table

#: Directions in order of precedence at equal slopes: name, row step, column step.
DIRECTIONS = (("e", 0, 1), ("ne", -1, 1), ("n", -1, 0), ("nw", -1, -1), ("w", 0, -1), ("sw", 1, -1), ("s", 1, 0), ("se", 1, 1))


#: Row and column steps by direction; direction 0 stays.
_DR, _DC = (np.array([0, *steps]) for steps in zip(*((i, j) for _, i, j in DIRECTIONS), strict=True))


def d8_pointer(cells: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Adds dir (1 to 8 in the order of DIRECTIONS, 0 without lower neighbour) and slope, the steepest drop per cell width."""

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, 1)
        core = (i > 0) & (i <= SIDE) & (j > 0) & (j <= SIDE)
        if not core.any():
            return None
        z = dense(table, value, i, j, SIDE + 2)
        here = z[1:-1, 1:-1]
        slope, pointer = np.zeros((SIDE, SIDE)), np.zeros((SIDE, SIDE), np.int32)
        for k, (_, a, b) in enumerate(DIRECTIONS, 1):
            drop = (here - z[1 + a : SIDE + 1 + a, 1 + b : SIDE + 1 + b]) / (math.sqrt(2) if a and b else 1.0)
            steeper = drop > slope
            slope[steeper], pointer[steeper] = drop[steeper], k
        at = i[core] - 1, j[core] - 1
        return table.filter(pa.array(core)).append_column("dir", pa.array(pointer[at])).append_column("slope", pa.array(slope[at]))

    return map_tiles(cells, 1, run, StructType([*cells.schema, StructField("dir", IntegerType()), StructField("slope", DoubleType())]), keys)


def _drain(p: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a over all that drain through each place, and the last place of each one's way; p is the next place, len(p) if none."""
    n = len(p)
    a, last = a.copy(), np.where(p < n, p, np.arange(n))
    while len(live := np.flatnonzero(p < n)):
        gain = a[live]
        np.add.at(a, p[live], gain)
        last = last[last]
        p = np.append(p, n)[p]
    return a, last


def _next_places(table: pa.Table, i: np.ndarray, j: np.ndarray, width: int) -> np.ndarray:
    """The row that each row's direction points to, -1 if there is none in the square."""
    at = np.full((width, width), -1)
    at[i, j] = np.arange(len(i))
    k = table.column("dir").to_numpy()
    ti, tj = i + _DR[k], j + _DC[k]
    inside = (k > 0) & (ti >= 0) & (ti < width) & (tj >= 0) & (tj < width)
    return np.where(inside, at[np.clip(ti, 0, width - 1), np.clip(tj, 0, width - 1)], -1)


def flow_accumulation(pointers: DataFrame, n_cols: int, out: str = "cells", side: int = SIDE) -> DataFrame:
    """(r, c, out): how many cells drain through each, itself included.

    Tiles of side x side cells are summed on their own.  Only cells whose way leaves their tile are nodes of a graph, which
    path doubling sums in rounds that grow with the logarithm of the tiles on a way; what flows into a tile is then
    added where it enters.
    """
    spark = pointers.sparkSession
    flow = materialize(pointers.select("r", "c", F.coalesce(F.col("dir"), F.lit(0)).cast("int").alias("dir")), "flow")

    def leaving(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, 1)
        core = (i > 0) & (i <= side) & (j > 0) & (j <= side)
        if not core.any():
            return None
        r, c = table.column("r").to_numpy(), table.column("c").to_numpy()
        ids, to, n = r * n_cols + c, _next_places(table, i, j, side + 2), len(i)
        goes = to >= 0
        stays = goes & core & core[to]
        a, last = _drain(np.where(stays, to, n), core.astype(np.int64))
        gone = goes & core & ~core[to]
        x, entry = np.flatnonzero(gone), np.flatnonzero(goes & ~core & core[to])
        end = last[to[entry]]
        on, none = gone[end], np.zeros(len(x), bool)
        return pa.Table.from_arrays([
            pa.array(np.concatenate([ids[x], ids[entry]])),
            pa.array(np.concatenate([ids[x], ids[end]]), mask=~np.concatenate([none, on])),
            pa.array(np.concatenate([a[x], np.zeros(len(entry), np.int64)])),
            *(pa.array(np.concatenate([y[to[x]], y[to[entry]]])) for y in (r, c)),
        ], names=["v", "p", "a", "tr", "tc"])

    # its own tile knows what a node brings, the tile that it enters where that goes on
    now, path = write_table(map_tiles(flow, 1, leaving, "v long, p long, a long, tr long, tc long", (), side).groupBy("v", "tr", "tc").agg(F.max("p").alias("p"), F.sum("a").alias("a")), "flow-links")
    while now.where("p is not null").first() is not None:
        gained = now.where("p is not null").groupBy(F.col("p").alias("v")).agg(F.sum("a").alias("g"))
        # ways that have ended meet themselves, so no task gets them all
        far = now.select(F.col("v").alias("_k"), F.col("p").alias("pp"))
        new = now.join(gained, "v", "left").withColumn("_k", F.coalesce("p", "v")).join(far, "_k")
        new = new.select("v", "tr", "tc", F.when(F.col("p").isNotNull(), F.col("pp")).alias("p"), (F.col("a") + F.coalesce("g", F.lit(0))).alias("a"))
        now, next_path = write_table(new, "flow-links")
        remove(spark, path)
        path = next_path
    inflow = now.groupBy(F.col("tr").alias("r"), F.col("tc").alias("c")).agg(F.sum("a").alias("inflow")).select("r", "c", F.lit(-1).alias("dir"), "inflow")

    def sums(table: pa.Table, r0: int, c0: int) -> pa.Table:
        into = table.filter(pc.less(table.column("dir"), 0))
        table = table.filter(pc.greater_equal(table.column("dir"), 0))
        i, j = places_of(table, r0, c0, 0)
        to, at = _next_places(table, i, j, side), np.zeros((side, side), np.int64)
        at[i, j] = np.arange(len(i))
        a = np.ones(len(i), np.int64)
        np.add.at(a, at[places_of(into, r0, c0, 0)], into.column("inflow").to_numpy())
        return table.select(["r", "c"]).append_column(out, pa.array(_drain(np.where(to >= 0, to, len(i)), a)[0]))

    return map_tiles(flow.withColumn("inflow", F.lit(0).cast("long")).unionByName(inflow), 0, sums, f"r long, c long, {out} long", (), side)


def fix_flats(cells: DataFrame, value: str, increment: float, n_cols: int, out: str = "out", side: int = SIDE) -> DataFrame:
    """Adds out: cells of flats rise by increment for each step from the flat's nearest outlet.

    An outlet is a cell of equal height with a lower neighbour, or at the edge; flats without one stay.
    Distances spread within tiles of side x side cells, then from tile to tile, so rounds grow with the
    tiles that a way to an outlet crosses.  The rounds carry the cells' columns, so that nothing is joined.
    """
    spark, columns = cells.sparkSession, cells.columns
    schema = StructType([*cells.schema, StructField("_d", IntegerType()), StructField("_moved", BooleanType())])

    def spread(z: np.ndarray, d: np.ndarray, table: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.Table:
        """The tile's rows after walking as far as it reaches; i and j count from the corner of a halo of one."""
        core = (i > 0) & (i <= side) & (j > 0) & (j <= side)
        before = d
        while True:
            least = d.copy()
            for a, b in ((a, b) for _, a, b in DIRECTIONS):
                here = slice(max(0, -a), side + 2 - max(0, a)), slice(max(0, -b), side + 2 - max(0, b))
                there = slice(max(0, a), side + 2 - max(0, -a)), slice(max(0, b), side + 2 - max(0, -b))
                same = z[here] == z[there]
                least[here][same] = np.minimum(least[here][same], d[there][same] + 1)
            if np.array_equal(least, d):
                break
            d = least
        i, j, table = i[core], j[core], table.filter(pa.array(core))
        found, moved = d[i, j], (d != before)[i, j] & ((i == 1) | (i == side) | (j == 1) | (j == side))
        steps = pa.array(np.where(np.isfinite(found), found, np.nan), from_pandas=True).cast(pa.int32())
        return pa.Table.from_arrays([*table.select(columns).columns, steps, pa.array(moved)], names=[*columns, "_d", "_moved"])

    def start(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, 2)
        if not ((i > 1) & (i < side + 2) & (j > 1) & (j < side + 2)).any():
            return None
        z = dense(table, value, i, j, side + 4)
        low = np.where(np.isnan(z), -np.inf, z)
        low = np.min([low[1 + a : side + 3 + a, 1 + b : side + 3 + b] for _, a, b in DIRECTIONS], axis=0)
        z = z[1:-1, 1:-1]
        near = (i > 0) & (i < side + 3) & (j > 0) & (j < side + 3)
        return spread(z, np.where(low < z, 0.0, np.inf), table.filter(pa.array(near)), i[near] - 1, j[near] - 1)

    def walk(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, 1)
        if not ((i > 0) & (i <= side) & (j > 0) & (j <= side)).any():
            return None
        d = dense(table, "_d", i, j, side + 2)
        return spread(dense(table, value, i, j, side + 2), np.where(np.isnan(d), np.inf, d), table, i, j)

    # each round walks as far as a tile reaches; only steps onto a tile's rim matter to others
    state, path = write_table(map_tiles(cells, 2, start, schema, (), side), "flats")
    while not state.where("_moved").isEmpty():
        new, next_path = write_table(map_tiles(state, 1, walk, schema, (), side), "flats")
        remove(spark, path)
        state, path = new, next_path
    return state.withColumn(out, F.col(value) + F.coalesce("_d", F.lit(0)) * increment).drop("_d", "_moved")


def flowdir_check(cells: DataFrame, unit: str, skip: DataFrame | None = None) -> DataFrame:
    """(unit, n): cells with height but no direction in water of codes 2 to 5 outside edited ocean; skipped units are left out.

    cells has z, dir, code, edm.
    """
    bad = (F.col("dir") == 0) & F.col("z").isNotNull() & F.col("code").between(2, 5) & (F.col("edm") < 4)
    out = cells.groupBy(unit).agg(F.count_if(bad).alias("n"))
    return out if skip is None else out.join(skip.select(unit), unit, "left_anti")


def flowdir_fix(cells: DataFrame, flagged: DataFrame, unit: str, step: float) -> DataFrame:
    """z of codes 2 to 5 raised by step in flagged units."""
    marked = cells.join(flagged.select(unit, F.lit(True).alias("_f")).distinct(), unit, "left")
    return marked.withColumn("z", F.when(F.col("_f") & F.col("code").between(2, 5), F.col("z") + step).otherwise(F.col("z"))).drop("_f")


def endorheic_units(units: DataFrame, expected: int | None = None) -> DataFrame:
    """Units with endo = 2; their number must be the expected one, if that is given."""
    out = units.where("endo = 2")
    if expected is not None and (n := out.count()) != expected:
        raise ValueError(f"{n} closed units, {expected} expected")
    return out


def find_sink(cells: DataFrame, unit: str, n_cols: int, share: float = 0.01, wet: int = 80) -> DataFrame:
    """(unit, r, c): the sink of each unit.

    Among a unit's cells at or below the share's percentile, the largest zone; of it the wet cells if
    there are any; of those the lowest, ties to the one nearest to the ties' centre, then the first.
    """
    level = cells.groupBy(unit).agg(F.percentile("z", F.lit(share)).alias("_p"))
    low = materialize(cells.join(level, unit).where("z <= _p").select(unit, "r", "c", "z", "swo"), "sinks")
    rank = sequential_id(low.select(unit).distinct(), [unit], "_k")
    keyed = low.join(rank, unit)
    zones = label(keyed, F.lit(True), n_cols, 8, ["_k"]).join(keyed, ["_k", "r", "c"])
    best = largest_zone(zones, "zone", [unit])
    any_wet = best.groupBy(unit).agg(F.max((F.col("swo") >= wet).cast("int")).alias("_w"))
    best = best.join(any_wet, unit).where((F.col("_w") == 0) | (F.col("swo") >= wet))
    ties = best.join(best.groupBy(unit).agg(F.min("z").alias("_lo")), unit).where("z = _lo")
    centre = ties.groupBy(unit).agg(F.avg("r").alias("_r"), F.avg("c").alias("_c"))
    d = F.round((F.col("r") - F.col("_r")) * (F.col("r") - F.col("_r")) + (F.col("c") - F.col("_c")) * (F.col("c") - F.col("_c")), 9)
    return ties.join(centre, unit).groupBy(unit).agg(F.min_by(F.struct("r", "c"), F.struct(d, "r", "c")).alias("s")).select(unit, "s.r", "s.c")


def burn_sinks(cells: DataFrame, sinks: DataFrame, unit: str) -> DataFrame:
    """Adds sink (0/1); z is null at sinks that lie in the cell's own unit."""
    marked = cells.join(sinks.select(unit, "r", "c", F.lit(1).alias("sink")), [unit, "r", "c"], "left")
    return marked.withColumn("sink", F.coalesce("sink", F.lit(0))).withColumn("z", F.when(F.col("sink") == 0, F.col("z")))
