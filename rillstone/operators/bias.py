"""Vegetation bias: samples, lookup cube, and its removal from a surface."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.operators.focal import convolve1d, ring_smooth, slope_d2
from rillstone.operators.spatial import sequential_id
from rillstone.operators.stats import lookup_mean_std_count

#: Coefficients of the cover and slope polynomial, in the order 1, cover, slope, cover^2, cover*slope, slope^2.
POLYNOMIAL = (0.03789534968886686, 0.1395174341829395, -0.019562663304545865, -0.005218094300390786, 0.0015878676683811661, 0.0050266251217852215)


def prep_samples(samples: DataFrame, value: str, floor: float | None = None, keep_below: bool = False, box: dict[str, tuple[float, float]] | None = None, quantiles: tuple[float, float] | None = (0.05, 0.99), fraction: float | None = None, seed: int = 0) -> DataFrame:
    """Samples above floor (below it with keep_below), inside box, between two quantiles of value (ends included), then a random share."""
    if floor is not None:
        samples = samples.where(F.col(value) < floor if keep_below else F.col(value) > floor)
    for name, (lo, hi) in (box or {}).items():
        samples = samples.where(F.col(name).between(lo, hi))
    if quantiles:
        # one row of two numbers
        ends = samples.agg(F.percentile(value, F.lit(quantiles[0])).alias("_lo"), F.percentile(value, F.lit(quantiles[1])).alias("_hi"))
        samples = samples.join(F.broadcast(ends), F.col(value).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")
    return samples if fraction is None else samples.sample(fraction, seed=seed)


def sample_files(catalog: DataFrame, path: str, n: int, seed: int = 0) -> DataFrame:
    """n draws with replacement from a list of paths: (draw, path)."""
    ranked = sequential_id(catalog.select(path), [path], "_k").withColumn("_k", F.col("_k") - 1)
    total = catalog.count()
    draws = catalog.sparkSession.range(n).select(F.col("id").alias("draw"), F.floor(F.rand(seed) * total).alias("_k"))
    return draws.join(ranked, "_k").select("draw", path)


def bias_slice(samples: DataFrame, value: str, n_cutoff: int = 30, cover_cutoff: int = 10, covers: int = 101, heights: int = 31) -> DataFrame:
    """The bias table (slope, tc, th, bias) over the full range of covers and heights, for all slopes at once.

    Group means over more than n_cutoff samples; gaps take the nearest mean of their slope (ties to
    the smaller cover, then height); no bias below cover_cutoff or without height; then a 3 x 3 ring
    smoothing (1, 0.5) with mirrored edges, and the same zeros again.
    """
    means = lookup_mean_std_count(samples, ["slope", "tc", "th"], value, n_cutoff).select("slope", F.col("tc").alias("_tc"), F.col("th").alias("_th"), "mean")
    grid = means.select("slope").distinct().select("slope", F.explode(F.sequence(F.lit(0), F.lit(covers - 1))).alias("tc")).select("slope", "tc", F.explode(F.sequence(F.lit(0), F.lit(heights - 1))).alias("th"))
    # nearest along the height first, in the covers that have means; then along the cover: covers + heights steps for a place, not covers x heights
    rows = means.select("slope", "_tc").distinct().select("slope", "_tc", F.explode(F.sequence(F.lit(0), F.lit(heights - 1))).alias("th"))
    rows = rows.join(means.withColumnRenamed("_th", "th").withColumn("_at", F.col("th")), ["slope", "_tc", "th"], "left")
    line = Window.partitionBy("slope", "_tc").orderBy("th")
    mean = F.when(F.col("_at").isNotNull(), F.struct("_at", "mean"))
    rows = rows.withColumns({"_below": F.last(mean, True).over(line.rowsBetween(Window.unboundedPreceding, 0)), "_above": F.first(mean, True).over(line.rowsBetween(0, Window.unboundedFollowing))})
    lower = F.col("_above").isNull() | (F.col("th") - F.col("_below._at") <= F.col("_above._at") - F.col("th"))
    rows = rows.withColumn("_m", F.when(F.col("_below").isNotNull() & lower, F.col("_below")).otherwise(F.col("_above"))).select("slope", "th", "_tc", F.col("_m._at").alias("_th"), F.col("_m.mean").alias("mean"))
    distance = (F.col("tc") - F.col("_tc")) * (F.col("tc") - F.col("_tc")) + (F.col("th") - F.col("_th")) * (F.col("th") - F.col("_th"))
    near = grid.join(rows, ["slope", "th"]).groupBy("slope", "tc", "th").agg(F.min_by("mean", F.struct(distance, "_tc", "_th")).alias("bias"))
    zero = (F.col("tc") < cover_cutoff) | (F.col("th") == 0)
    cells = near.select("slope", F.col("tc").alias("r"), F.col("th").alias("c"), F.when(zero, 0.0).otherwise(F.col("bias")).alias("b"))
    smooth = ring_smooth(cells, "b", {"bias": [1.0, 0.5]}, covers, heights, ["slope"])
    out = smooth.select("slope", F.col("r").alias("tc"), F.col("c").alias("th"), "bias")
    return out.withColumn("bias", F.when(zero, 0.0).otherwise(F.col("bias")))


def bias_cube(slices: DataFrame, slopes: int = 21, covers: int = 101, heights: int = 31, smooth_axes: bool = False) -> DataFrame:
    """All slices as one cube; with smooth_axes smoothed by (.5, 1, .5) along each axis."""
    if not smooth_axes:
        return slices
    weights, axes = [0.5, 1.0, 0.5], {"slope": slopes, "tc": covers, "th": heights}
    for axis, n in axes.items():
        slices = convolve1d(slices, axis, [a for a in axes if a != axis], "bias", weights, 0, n - 1, "bias")
    return slices


def bias_in_cm(table: DataFrame, value: str = "bias") -> DataFrame:
    return table.withColumn("bias_cm", F.round(F.col(value) * 100).cast("int"))


def apply_bias_3d(cells: DataFrame, cube: DataFrame, value: str, dx: float, dy: float, n_rows: int, n_cols: int, water: Column, max_slope: int = 19, cover: str = "tc", height: str = "th") -> DataFrame:
    """Adds bias and corrected: the cube's bias at the cell's smoothed cover and height and the slope of the smoothed surface.

    Cover and height are 3 x 3 means cut to whole numbers, the slope is that of the 9 x 9 smoothed
    surface, at most max_slope; there is no bias without cover, without height, or on water.
    """
    filled = cells.withColumns({"_tc": F.coalesce(cover, F.lit(0)), "_th": F.coalesce(height, F.lit(0))})
    smooth = ring_smooth(filled, value, {"_z": [1.0, 0.8, 0.6, 0.4, 0.2]}, n_rows, n_cols)
    smooth = slope_d2(smooth, "_z", dx, dy, out="_slope")
    for name in ("_tc", "_th"):
        smooth = ring_smooth(smooth, name, {f"{name}s": [1.0, 1.0]}, n_rows, n_cols)
    none = (F.col("_tc") == 0) | (F.col("_th") == 0)
    # the mean of whole numbers is cut after the rounding of its last digits
    key = {"tck": F.floor(F.round("_tcs", 9)).cast("int"), "thk": F.floor(F.round("_ths", 9)).cast("int"), "sk": F.least(F.col("_slope").cast("int"), F.lit(max_slope))}
    # a cube has at most slopes x covers x heights rows
    table = cube.select(F.col("slope").alias("sk"), F.col("tc").alias("tck"), F.col("th").alias("thk"), F.col("bias").alias("_bias"))
    found = smooth.withColumns(key).join(F.broadcast(table), ["sk", "tck", "thk"], "left")
    found = found.withColumn("bias", F.when(none | water, 0.0).otherwise(F.coalesce("_bias", F.lit(0.0))))
    return found.withColumn("corrected", F.col(value) - F.col("bias")).select(*cells.columns, "bias", "corrected")


def apply_bias_2d(cells: DataFrame, table: DataFrame, value: str, land_cover: int = 999, max_slope: int = 50) -> DataFrame:
    """corrected from a table (lc, slope, tc, bias) of one land cover; columns slope (at most max_slope counts) and tc of cells are the keys."""
    chosen = table.where((F.col("lc") == land_cover) & (F.col("slope") <= max_slope)).select(F.col("slope").alias("_slope"), F.col("tc").alias("_tc"), F.col("bias").alias("_bias"))
    # a table has at most max_slope x covers rows; a larger one is joined by a shuffle
    found = cells.join(chosen, (F.least("slope", F.lit(max_slope)) == F.col("_slope")) & (F.col("tc") == F.col("_tc")), "left")
    return found.withColumn("corrected", F.col(value) - F.coalesce("_bias", F.lit(0.0))).drop("_slope", "_tc", "_bias")


def apply_bias_poly(cells: DataFrame, value: str, cover: str, slope: str, coefficients: Sequence[float] = POLYNOMIAL) -> DataFrame:
    """corrected by a quadratic in cover and slope."""
    t, s = F.col(cover), F.col(slope)
    terms = [F.lit(1.0), t, s, t * t, t * s, s * s]
    bias = sum((x * float(a) for x, a in zip(terms, coefficients, strict=True)), F.lit(0.0))
    return cells.withColumn("bias", bias).withColumn("corrected", F.col(value) - F.col("bias"))
