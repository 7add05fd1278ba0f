"""Zonal and tabular aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zonal_stats(cells: DataFrame, zone: str, value: str) -> DataFrame:
    v = F.col(value)
    return cells.groupBy(zone).agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"), F.sum(v).alias("total"), F.count(v).alias("n"))


def masked_percentiles(cells: DataFrame, value: str, mask: Column, shares: Sequence[float], exact: bool = True) -> DataFrame:
    """One row with p<share>: linear-interpolated percentiles of masked values; approximate ones cost less on many values."""
    fn = F.percentile if exact else F.percentile_approx
    return cells.where(mask).agg(*[fn(value, s / 100.0).alias(f"p{s:g}".replace(".", "_")) for s in shares])


def zonal_percentile(cells: DataFrame, zone: str, value: str, share: float, out: str = "p") -> DataFrame:
    return cells.groupBy(zone).agg(F.percentile(value, share / 100.0).alias(out))


def grid_std(cells: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    return cells.groupBy(*keys).agg(F.stddev_pop(value).alias("std"))


def lookup_mean_std_count(rows: DataFrame, keys: Sequence[str], value: str, n_cutoff: int = 0) -> DataFrame:
    """Mean, sample deviation and size of groups of more than n_cutoff rows."""
    return rows.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count("*").alias("n")).where(F.col("n") > n_cutoff)


def pivot_table(rows: DataFrame, index: str, columns: str, values: str, names: Sequence) -> DataFrame:
    """Long to wide with the column values given; missing combinations are null."""
    return rows.groupBy(index).pivot(columns, list(names)).agg(F.first(values))


def value_counts(cells: DataFrame, value: Column, above: int = 100, out: str = "value") -> DataFrame:
    return cells.groupBy(value.alias(out)).agg(F.count("*").alias("n")).where(F.col("n") > above)


def class_share(cells: DataFrame, predicate: Column, keys: Sequence[str] = ()) -> DataFrame:
    return cells.groupBy(*keys).agg(F.avg(F.coalesce(predicate, F.lit(False)).cast("int")).alias("share"), F.count_if(predicate).alias("n"))


#: From which range of heights (mm) on steps are how large (mm).
HEIGHT_STEPS = ((0, 500), (25_000, 1_000), (50_000, 2_000), (100_000, 5_000), (250_000, 10_000))


def height_steps(bounds: DataFrame, low: str, high: str, steps: Sequence[tuple[int, int]] = HEIGHT_STEPS) -> DataFrame:
    """Each row's ladder of heights h from low to high; the step grows with the range."""
    size = F.lit(steps[0][1])
    for start, step in steps[1:]:
        size = F.when(F.col(high) - F.col(low) >= start, step).otherwise(size)
    return bounds.withColumn("step", size).withColumn("h", F.explode(F.sequence(F.col(low).cast("long"), F.col(high).cast("long"), F.col("step").cast("long"))))


def arg_extreme(cells: DataFrame, zone: str, value: str, index: str) -> DataFrame:
    """The index of each zone's highest and lowest cell; ties to the first."""
    first = F.struct(F.col(value), -F.col(index))
    return cells.groupBy(zone).agg(F.max_by(index, first).alias("at_max"), F.min_by(index, F.struct(value, index)).alias("at_min"))


def dissolve_attr(rows: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """One row per key with the sorted distinct values of each column."""
    return rows.groupBy(key).agg(*[F.array_sort(F.collect_set(v)).alias(v) for v in values])
