"""Noise removal: bias, four smoothings, and for each cell the one that its slope and curvature call for."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillstone.operators.bias import apply_bias_3d
from rillstone.operators.focal import slope_d2
from rillstone.operators.grid import trim_halo
from rillstone.operators.tiles import SIDE, central, dense, map_tiles, places_of, ring_means
from rillstone.storage import materialize

#: Kernel weights from the centre outward, by window size.
KERNELS = {9: (1.0, 0.8, 0.6, 0.4, 0.2), 7: (1.0, 0.75, 0.5, 0.25), 5: (1.0, 0.7, 0.35), 3: (1.0, 0.5)}


def smoothed_tiles(cells: DataFrame, value: str, dx: float, dy: float, n_rows: int, n_cols: int) -> DataFrame:
    """Adds _k9, _k7, _k5 and _k3 (the kernels' means), and _slope (whole degrees) and _curve of _k9.

    One exchange brings tiles with their halo together; edges of the grid are mirrored.  The result is a
    table in the shared folder, as it is read for the curvature's deviation and again for the choice.
    """
    k, halo = len(KERNELS[9]) - 1, len(KERNELS[9]) + 1
    names = {f"_k{size}": weights for size, weights in KERNELS.items()}
    schema = StructType([*cells.schema.fields])
    for name in (*names, "_slope", "_curve"):
        schema = schema.add(name, "integer" if name == "_slope" else "double")

    def run(table: pa.Table, r0: int, c0: int) -> pa.Table | None:
        side = SIDE
        i, j = places_of(table, r0, c0, halo)
        core = np.flatnonzero((i >= halo) & (i < halo + side) & (j >= halo) & (j < halo + side))
        if not len(core):
            return None
        z = dense(table, value, i, j, side + 2 * halo)
        # the part within the grid, then mirrored beyond it
        top, left = max(0, halo - r0), max(0, halo - c0)
        bottom, right = min(side + 2 * halo, n_rows - r0 + halo), min(side + 2 * halo, n_cols - c0 + halo)
        padded = np.pad(z[top:bottom, left:right], k, "symmetric")
        means = ring_means(padded, names, k)
        at = i[core] - top, j[core] - left
        rim = np.pad(means["_k9"], 2, constant_values=np.nan)
        gx, gy = central(rim, 1, dx), central(rim, 0, dy)
        steep = np.sqrt(gx**2 + gy**2)[1:-1, 1:-1]
        curve = central(gx, 1, dx) + central(gy, 0, dy)
        slope = np.degrees(np.arctan(steep))[at]
        out = table.take(pa.array(core))
        for name, mean in means.items():
            out = out.append_column(name, pa.array(mean[at], from_pandas=True))
        out = out.append_column("_slope", pa.array(np.floor(slope), from_pandas=True).cast(pa.int32()))
        return out.append_column("_curve", pa.array(curve[at], from_pandas=True))

    return materialize(map_tiles(cells, halo, run, schema), "smoothed")


def adaptive_filter(
    cells: DataFrame, value: str, dx: float, dy: float, n_rows: int, n_cols: int, water: Column, edited: Column, fill: Column, artifact: Column | None = None,
    slope_breaks: Sequence[float] = (0, 2, 6, 15, 30), curve_breaks: Sequence[float] = (1.0, 2.5),
) -> DataFrame:
    """Adds filtered and filter_mask: 9, 7, 5 or 3 for the kernel, 1 for none, 2 at peaks, 0 in valleys.

    The 9-cell kernel gives way to smaller ones as the slope (of the 9-cell surface, whole degrees)
    reaches the breaks, both ends included, later ranges first; curvature beyond the first break
    (times its deviation over the grid) takes the 3-cell kernel; steep cells, peaks and valleys stay.
    Then water takes the 3-cell kernel, filled cells without a larger kernel too, and edited water
    and artifacts stay.
    """
    shaped = smoothed_tiles(cells, value, dx, dy, n_rows, n_cols)
    # one number for the whole grid
    shaped = shaped.join(F.broadcast(shaped.agg(F.stddev_pop("_curve").alias("_sigma"))), F.lit(True))
    low, high = (F.col("_sigma") * b for b in curve_breaks)
    curve, slope = F.col("_curve"), F.col("_slope")
    valley, peak, steep = curve > high, curve < -high, slope >= slope_breaks[-1]
    bent = ((curve <= high) & (curve > low)) | ((curve >= -high) & (curve < -low))
    kernel = F.when(bent | slope.between(slope_breaks[3], slope_breaks[4]), 3).when(slope.between(slope_breaks[2], slope_breaks[3]), 5).when(slope.between(slope_breaks[1], slope_breaks[2]), 7).otherwise(9)
    mask = F.when(valley, 0).when(peak, 2).when(steep, 1).otherwise(kernel)
    raw = F.col(value)
    picked = F.when(valley | peak | steep, raw)
    for k in KERNELS:
        picked = picked.when(kernel == k, F.col(f"_k{k}"))
    found = shaped.withColumns({"_mask": mask, "_pick": picked})
    found = found.withColumns({"_mask": F.when(water, 3).otherwise(F.col("_mask")), "_pick": F.when(water, F.col("_k3")).otherwise(F.col("_pick"))})
    patch = fill & (F.col("_mask") < 3)
    found = found.withColumns({"_mask": F.when(patch, 3).otherwise(F.col("_mask")), "_pick": F.when(patch, F.col("_k3")).otherwise(F.col("_pick"))})
    keep = edited if artifact is None else edited | artifact
    return found.withColumns({"filter_mask": F.when(edited, 1).otherwise(F.col("_mask")), "filtered": F.when(keep, raw).otherwise(F.col("_pick"))}).select(*cells.columns, "filtered", "filter_mask")


def noise_removal(cells: DataFrame, cube: DataFrame, value: str, dx: float, dy: float, n_rows: int, n_cols: int, halo: int = 0, swo_cutoff: int = 10, artifact: Column | None = None) -> DataFrame:
    """The plan of a tile on cells with swo, edm, tc, th: bias off, adaptive filter, final slope, halo off.

    Cells of artifact (see artifact_mask) keep their unbiased height.
    """
    water = F.col("edm").isin(2, 3)
    clean = apply_bias_3d(cells, cube, value, dx, dy, n_rows, n_cols, water).drop("bias")
    kept = adaptive_filter(clean, "corrected", dx, dy, n_rows, n_cols, water=F.col("swo") > swo_cutoff, edited=water, fill=F.col("edm") == 5, artifact=artifact)
    return trim_halo(slope_d2(kept, "filtered", dx, dy, out="slope"), halo, n_rows, n_cols)
