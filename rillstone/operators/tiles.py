"""Square tiles with a halo: one exchange brings all that windows, zones and rings of a tile need.

A cell goes to the tile that holds it and, if it lies within the halo of others, to those too.  A
task holds one tile at a time, so its memory is bounded by the tile's side and halo, whatever the
grid's size and shape.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillstone.operators.components import union_find
from rillstone.storage import materialize

#: Cells along the side of a tile.
SIDE = 256


def to_tiles(cells: DataFrame, halo: int, side: int = SIDE) -> DataFrame:
    """cells with _tile_r and _tile_c, the place of a tile; once for each tile that holds them or has them in its halo."""

    def places(name: str) -> F.Column:
        x = F.col(name)
        return F.explode(F.sequence(F.floor((x - halo) / side), F.floor((x + halo) / side))) if halo else F.floor(x / side)

    return cells.withColumn("_tile_r", places("r")).withColumn("_tile_c", places("c"))


def map_tiles(cells: DataFrame, halo: int, fn: Callable[[pa.Table, int, int], pa.Table | None], schema: str | StructType, keys: Sequence[str] = (), side: int = SIDE) -> DataFrame:
    """fn(a tile's rows, its first r, its first c) for each tile of each grid; None returns nothing."""
    empty = cells.sparkSession.createDataFrame([], schema).limit(0).toArrow().schema

    def run(table: pa.Table) -> pa.Table:
        at = table.column("_tile_r")[0].as_py() * side, table.column("_tile_c")[0].as_py() * side
        out = fn(table.drop_columns(["_tile_r", "_tile_c"]), *at)
        return empty.empty_table() if out is None else out.cast(empty)

    return to_tiles(cells, halo, side).groupBy(*keys, "_tile_r", "_tile_c").applyInArrow(run, schema)


def places_of(table: pa.Table, r0: int, c0: int, halo: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a tile's cells, counted from the corner of its halo."""
    return table.column("r").to_numpy() - r0 + halo, table.column("c").to_numpy() - c0 + halo


def dense(table: pa.Table, name: str, i: np.ndarray, j: np.ndarray, width: int) -> np.ndarray:
    """A column as a square of doubles; nan where there is no cell or no value."""
    out = np.full((width, width), np.nan)
    out[i, j] = table.column(name).cast(pa.float64()).to_numpy()
    return out


def box_sums(z: np.ndarray, k: int) -> list[np.ndarray]:
    """Sums over the (2j+1) x (2j+1) cells around each, for j from 0 to k, of all but the outer k rows and columns."""
    n, m = z.shape[0] - 2 * k, z.shape[1] - 2 * k
    out = []
    for j in range(k + 1):
        rows = sum(z[k + d : k + d + n] for d in range(-j, j + 1))
        out.append(sum(rows[:, k + d : k + d + m] for d in range(-j, j + 1)))
    return out


def ring_means(z: np.ndarray, kernels: dict[str, Sequence[float]], k: int) -> dict[str, np.ndarray]:
    """Normalized ring kernels (weights from the centre outward) of all but the outer k rows and columns; nan counts as 0 and stays."""
    sums = box_sums(np.nan_to_num(z), k)
    gone = np.isnan(z[k : z.shape[0] - k, k : z.shape[1] - k])
    out = {}
    for name, weights in kernels.items():
        total = weights[0] + sum(8 * j * w for j, w in enumerate(weights))
        mean = sum(s * (w - a) for s, w, a in zip(sums, weights, [*weights[1:], 0.0], strict=False)) / total
        out[name] = np.where(gone, np.nan, mean)
    return out


def central(z: np.ndarray, axis: int, step: float) -> np.ndarray:
    """Central differences of all but the outer row and column, one-sided where a side is nan."""
    here = z[1:-1, 1:-1]
    before, after = (z[:-2, 1:-1], z[2:, 1:-1]) if axis == 0 else (z[1:-1, :-2], z[1:-1, 2:])
    both = (after - before) / (2 * step)
    return np.where(np.isnan(before), (after - here) / step, np.where(np.isnan(after), (here - before) / step, both))


def near_tiles(cells: DataFrame, pieces: DataFrame, reach: int, side: int = SIDE) -> DataFrame:
    """The cells of tiles that have a cell of pieces (r, c) within a tile and reach of them."""
    # a row for a tile, which has up to side x side cells
    seen = to_tiles(pieces.select("r", "c"), side + reach, side).select("_tile_r", "_tile_c").distinct()
    return to_tiles(cells, 0, side).join(F.broadcast(seen), ["_tile_r", "_tile_c"], "left_semi").select(*cells.columns)


def extremes(cells: DataFrame, outputs: dict[str, tuple[str, str, int]]) -> DataFrame:
    """Square windows: outputs names (min or max, value column, half width); a tile and its halo hold all that they look at."""
    halo, schema = max(k for _, _, k in outputs.values()), StructType([*cells.schema.fields])
    for name, (_, value, _) in outputs.items():
        schema = schema.add(name, cells.schema[value].dataType)
    width = SIDE + 2 * halo

    def window(x: np.ndarray, k: int, least: bool) -> np.ndarray:
        pick, n = (np.minimum if least else np.maximum), SIDE
        rows = pick.reduce([x[halo + d : halo + d + n] for d in range(-k, k + 1)])
        return pick.reduce([rows[:, halo + d : halo + d + n] for d in range(-k, k + 1)])

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, halo)
        core = (i >= halo) & (i < halo + SIDE) & (j >= halo) & (j < halo + SIDE)
        if not core.any():
            return None
        out, at = table.filter(pa.array(core)), (i[core] - halo, j[core] - halo)
        for name, (how, value, k) in outputs.items():
            column, least = table.column(value), how == "min"
            there = column.is_valid().to_numpy()
            held = column.drop_null().to_numpy()
            ends = np.iinfo(held.dtype) if held.dtype.kind == "i" else np.finfo(held.dtype)
            x, known = np.full((width, width), ends.max if least else ends.min, held.dtype), np.zeros((width, width), bool)
            x[i[there], j[there]], known[i[there], j[there]] = held, True
            out = out.append_column(name, pa.array(window(x, k, least)[at], mask=~window(known, k, False)[at]))
        return out

    return map_tiles(cells, halo, run, schema)


def outer_ring(zone: DataFrame, kr: int, kc: int) -> DataFrame:
    """Places (r, c) outside a zone within kr rows and kc columns of it; each tile looks at the zone's cells that it holds or has near."""
    halo = max(kr, kc)

    def grown(x: np.ndarray, k: int) -> np.ndarray:
        return np.logical_or.reduce([x[halo + d : halo + d + SIDE] for d in range(-k, k + 1)])

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table:
        held = np.zeros((SIDE + 2 * halo, SIDE + 2 * halo), bool)
        held[places_of(table, r0, c0, halo)] = True
        near = grown(grown(held, kr).T, kc).T
        row, col = np.nonzero(near & ~held[halo : halo + SIDE, halo : halo + SIDE])
        return pa.table({"r": pa.array(row + r0, pa.int64()), "c": pa.array(col + c0, pa.int64())})

    return map_tiles(zone.select("r", "c"), halo, run, "r long, c long")


def tile_labels(held: DataFrame, n_cols: int, steps: Sequence[tuple[int, int]], keys: Sequence[str], side: int = SIDE) -> tuple[DataFrame, DataFrame]:
    """Cells (keys..., r, c, local) with the least _id of their part of a zone within their tile, and edges (a, b) between parts.

    held has keys, r, c, _id.  Edges stand only where a zone crosses from tile to tile: (part, cell beyond the
    border) and (cell at a border, its part).
    """
    schema = f"{''.join(f'{k} {held.schema[k].dataType.simpleString()}, ' for k in keys)}r long, c long, a long, b long"

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, 1)
        ids, core = table.column("_id").to_numpy(), (i > 0) & (i <= side) & (j > 0) & (j <= side)
        if not core.any():
            return None
        place = np.full((side + 2, side + 2), -1)
        place[i, j] = np.arange(len(ids))
        a, b = [], []
        for dr, dc in steps:
            near = place[np.minimum(i + dr, side + 1), np.clip(j + dc, 0, side + 1)]
            near[(i + dr > side + 1) | (j + dc > side + 1) | (j + dc < 0)] = -1
            a.append(np.flatnonzero(near >= 0))
            b.append(near[near >= 0])
        a, b = np.concatenate(a), np.concatenate(b)
        inside = core[a] & core[b]
        nodes, root = union_find(a[inside], b[inside]) if inside.any() else (np.zeros(0, int), np.zeros(0, int))
        part = np.arange(len(ids))
        part[nodes] = root
        # the least id of each part
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, part[core], ids[core])
        local = least[part]
        cross = core[a] != core[b]
        x, y = np.where(core[a], a, b)[cross], np.where(core[a], b, a)[cross]
        rim = np.unique(x)
        ea, eb = np.concatenate([local[x], ids[rim]]), np.concatenate([ids[y], local[rim]])
        differ = ea != eb
        ea, eb = ea[differ], eb[differ]
        n, m = int(core.sum()), len(ea)
        columns = [pa.concat_arrays([table.column(k).combine_chunks().filter(pa.array(core)), pa.nulls(m, table.schema.field(k).type)]) for k in keys]
        columns += [pa.concat_arrays([pa.array(table.column(x).to_numpy()[core].astype(np.int64)), pa.nulls(m, pa.int64())]) for x in ("r", "c")]
        columns += [pa.array(np.concatenate([local[core], ea])), pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(eb)])]
        return pa.Table.from_arrays(columns, names=[*keys, "r", "c", "a", "b"])

    found = materialize(map_tiles(held, 1, run, schema, keys, side), "tile-labels")
    return found.where("b is null").select(*keys, "r", "c", F.col("a").alias("local")), found.where("b is not null").select("a", "b")


def around(cells: DataFrame, pieces: DataFrame, reach: int, zone: str = "zone", side: int = SIDE) -> DataFrame:
    """(zone, d, cell's columns) for all cells outside a piece within reach of it: d is the distance in king's moves.

    pieces has zone, r, c; pieces may overlap.  Rows grow with the pieces' outlines and reach.
    """
    cells = near_tiles(cells, pieces, reach, side)
    both = cells.withColumn(zone, F.lit(None).cast("long")).unionByName(pieces.select(F.col(zone).cast("long").alias(zone), "r", "c"), allowMissingColumns=True)
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in cells.schema)}, {zone} long, d int"
    width, names_in = side + 2 * reach, cells.columns

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        i, j = places_of(table, r0, c0, reach)
        zones = table.column(zone)
        piece = zones.is_valid().to_numpy()
        at = np.full((width, width), -1)
        own = np.flatnonzero(~piece)
        inner = own[(i[own] >= reach) & (i[own] < width - reach) & (j[own] >= reach) & (j[own] < width - reach)]
        at[i[inner], j[inner]] = inner
        mine = np.flatnonzero(piece)
        if not len(mine) or not len(inner):
            return None
        z = zones.take(pa.array(mine)).to_numpy()
        order = np.argsort(z, kind="stable")
        mine, z = mine[order], z[order]
        cuts = [*np.flatnonzero(np.r_[True, z[1:] != z[:-1]]).tolist(), len(z)]
        rows, names, far = [], [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            pi, pj = i[mine[a:b]], j[mine[a:b]]
            ra, rb, ca, cb = max(pi.min() - reach, 0), min(pi.max() + reach + 1, width), max(pj.min() - reach, 0), min(pj.max() + reach + 1, width)
            d = np.where(np.zeros((rb - ra, cb - ca), bool), 0, reach + 1)
            d[pi - ra, pj - ca] = 0
            for step in range(1, reach + 1):
                hit = d < step
                grown = hit.copy()
                grown[1:] |= hit[:-1]
                grown[:-1] |= hit[1:]
                wide = grown.copy()
                wide[:, 1:] |= grown[:, :-1]
                wide[:, :-1] |= grown[:, 1:]
                d[wide & ~hit] = step
            found = (d > 0) & (d <= reach) & (at[ra:rb, ca:cb] >= 0)
            rows.append(at[ra:rb, ca:cb][found])
            far.append(d[found])
            names.append(np.full(int(found.sum()), z[a]))
        rows = np.concatenate(rows)
        out = table.drop_columns([zone]).take(pa.array(rows)).append_column(zone, pa.array(np.concatenate(names))).append_column("d", pa.array(np.concatenate(far).astype(np.int32)))
        return out.select([*names_in, zone, "d"])

    return map_tiles(both, reach, run, schema, (), side)
