"""The enforcement of a unit's water: from candidates and lines to a surface on which rivers and streams run down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.operators.ladders import lower_river_below_land, monotonic_rivers, monotonic_streams
from rillstone.operators.water import alternate_dem, raise_small, river_bank, stream_minimize, swo_burn, vector_burn, water_floor, water_mask
from rillstone.storage import materialize

#: Burn depth in metres by line class: river, stream, canal, drain.
LINE_DEPTHS = {5: 1.0, 6: 0.5, 7: 0.5, 8: 0.5}
#: Half widths of the moving minimum by stream kind: river, stream, canal.
WINDOWS = {1: 15, 2: 12, 3: 10}


def enforce_rivers(
    cells: DataFrame, candidates: DataFrame, n_rows: int, n_cols: int, border: DataFrame | None = None, rim: DataFrame | None = None, metre: float = 1000.0, swo_cutoff: int = 20, initial_burn: float = 3.0, swo_depth: float = 2.0,
    radius: float = 25.0, gap: int = 1, floor: float | None = None, alternate_step: float | None = None, least_river: int = 3000,
) -> DataFrame:
    """cells with z_water and code.

    cells has r, c, z, swo, osm and line (class of a rasterised line or null), and alt, an alternate surface, if
    alternate_step is given; candidates are the cells (r, c) that may be lakes or rivers; border is the grid's edge
    (by default its outer rows and columns), rim the unit's.  In order:

    1. candidates become lakes (3) and rivers (4); lines are burned in, off lakes and rivers (12);
    2. river zones of the alternate surface take its heights, lakes the lower ones;
    3. rivers fall by initial_burn metres, the banks around them (1) by a share of it;
    4. stretches above the land beside them (5) and humps (6, 7) are lowered;
    5. rivers and banks fall by their water occurrence, to floor metres at the lowest;
    6. streams take a moving minimum (8, 9, 10) and their burn; their humps are lowered (13, 14), to half a metre above floor;
    7. small streams beside rivers end at least 0.4 m above them.
    """
    if border is None:
        border = cells.where((F.col("r") == 0) | (F.col("r") == n_rows - 1) | (F.col("c") == 0) | (F.col("c") == n_cols - 1)).select("r", "c")
    kinds = water_mask(candidates.select("r", "c"), cells, border, n_cols, gap).select("r", "c", F.col("kind").alias("code"))
    now = cells.join(kinds, ["r", "c"], "left").withColumns({"code": F.coalesce("code", F.lit(0)), "z": F.col("z").cast("double")})
    now = vector_burn(now, "line", {k: d * metre for k, d in LINE_DEPTHS.items()}, n_rows, n_cols).withColumnRenamed("burn", "_line_burn")
    now = now.withColumn("code", F.when((F.col("_line_burn") > 0) & F.col("line").isNotNull() & (F.col("code") == 0), 12).otherwise(F.col("code")))
    if alternate_step is not None:
        now = alternate_dem(now.withColumn("lake", (F.col("code") == 3).cast("int")), n_cols, alternate_step, F.col("code") == 4, code=F.col("code"), redraw=True, swo_cutoff=swo_cutoff)
        now = now.withColumns({"z": F.col("z_new"), "code": F.col("code_new")}).drop("z_new", "code_new", "lake", "taken")
    now = river_bank(materialize(now, "rivers-start"), F.col("code") == 4, initial_burn * metre)
    fall = F.when(F.col("code") == 4, initial_burn * metre).when((F.col("bank") == 1) & (F.col("code") == 0), F.col("burn")).otherwise(0.0)
    now = now.withColumns({"z": F.col("z") - fall, "code": F.when((F.col("bank") == 1) & (F.col("code") == 0), 1).otherwise(F.col("code"))}).drop("bank", "burn")
    now = materialize(now, "rivers-burned")

    low = lower_river_below_land(now, n_cols, metre, swo_cutoff)
    low = materialize(low, "rivers-low")
    low = materialize(monotonic_rivers(low, n_cols, rim, metre, radius, swo_cutoff, least_river=least_river), "rivers-mono")
    low = low.withColumn("z", F.when(F.col("code").between(1, 7), F.col("z") - swo_burn(F.col("swo"), swo_cutoff, swo_depth * metre)).otherwise(F.col("z")))
    if floor is not None:
        low = low.withColumn("z", F.when(F.col("code") > 0, F.greatest(F.col("z"), F.lit(floor * metre))).otherwise(F.col("z")))

    kind = F.when(F.col("line").isNull() | (F.col("code").between(3, 7)), 0).when(F.col("line") == 5, 1).when(F.col("line") == 7, 3).otherwise(2)
    low = low.withColumns({"stream": kind, "big_river": F.col("code").between(3, 7).cast("int"), "_code": F.col("code")}).drop("code")
    low = materialize(stream_minimize(low, WINDOWS, n_rows, n_cols, 15 * metre, 5 * metre, 0.5 * metre), "rivers-streams")
    code = F.when(F.col("code") > 0, F.col("code")).otherwise(F.col("_code")).cast("int")
    low = low.withColumns({"z": F.when(F.col("_code") == 12, F.col("low") - F.col("_line_burn")).otherwise(F.col("low")), "code": code}).drop("low", "_code", "stream", "big_river")
    low = materialize(monotonic_streams(low, n_cols, rim, metre, radius), "rivers-streams")
    if floor is not None:
        low = water_floor(low, floor * metre, (floor + 0.5) * metre)
    small = F.col("code").between(8, 10) | (F.col("code") == 13)
    low = raise_small(low, small, F.col("code").between(4, 7), 2, 0.4 * metre, 5 * metre)
    return cells.join(low.select("r", "c", F.col("raised").cast("double").alias("z_water"), "code"), ["r", "c"])
