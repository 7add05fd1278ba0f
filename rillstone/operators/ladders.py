"""Height ladders: pieces of water that stand too high along a ladder of heights, and how they are lowered.

All steps of a ladder are looked at together, with the step as a key of the pieces.  Where a step
must see what lower steps have changed, a piece falls only if no chain of pieces, each a step above the one
before and near it, leads to it from another that falls; pieces that such a chain reaches are looked at anew.
So the result is that of going up step by step, in as many rounds as falls follow on each other in one place,
however long a river is.

Tables have r, c, z, swo and code, the water class (0 to 2 land and banks, 3 lake, 4 to 7 river, 8 to 10
streams); metre says how many units of height make one metre.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import ceil, floor, pi

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.focal import fill_missing
from rillstone.operators.spatial import sequential_id
from rillstone.operators.tiles import SIDE, around, to_tiles
from rillstone.operators.zones import FEW, RING, label
from rillstone.storage import beside as _beside
from rillstone.storage import keep, materialize, remove, scratch, write_table


def _percentile(value: Column, p: float) -> Column:
    return F.percentile(value, F.lit(p))


def _parts(rows: DataFrame, n_cols: int, connectivity: int) -> DataFrame:
    """(zone, r, c, part): the connected parts of rows (zone, r, c) within each zone."""
    rank = sequential_id(rows.select("zone").distinct(), ["zone"], "_k")
    found = label(rows.select("zone", "r", "c").join(rank, "zone"), F.lit(True), n_cols, connectivity, ["_k"], "part")
    return found.join(rank, "_k").select("zone", "r", "c", "part")


def _refill(cells: DataFrame, gone: DataFrame, k: int) -> DataFrame:
    """z of the cells (r, c) of gone anew from valid cells within k; as it was where there are none.  Tiles without such cells are not moved."""
    gone = materialize(gone.select("r", "c").distinct().withColumn("_gone", F.lit(True)), "ladder-gone")
    marked = to_tiles(cells.join(_beside(gone), ["r", "c"], "left"), 0)
    # a row for a tile, which has up to SIDE x SIDE cells
    tiles = to_tiles(gone, 0).select("_tile_r", "_tile_c", F.lit(True).alias("_own")).unionByName(to_tiles(gone, SIDE).select("_tile_r", "_tile_c", F.lit(False).alias("_own")))
    tiles = tiles.groupBy("_tile_r", "_tile_c").agg(F.max("_own").alias("_own"))
    marked = marked.join(F.broadcast(tiles), ["_tile_r", "_tile_c"], "left").drop("_tile_r", "_tile_c")
    open_ = marked.where("_own is not null").withColumns({"_z": F.col("z"), "z": F.when(F.col("_gone").isNull(), F.col("z"))})
    new = fill_missing(open_, "z", k).where("_own").withColumn("z", F.when(F.col("_gone"), F.coalesce("z", "_z")).otherwise(F.col("_z")))
    rest = marked.where("_own is null or not _own").withColumn("z", F.col("z").cast("double"))
    return new.select(*cells.columns).unionByName(rest.select(*cells.columns))


def _unchanged(cells: DataFrame) -> DataFrame:
    return cells.withColumn("z", F.col("z").cast("double"))


def ladder_of(low: float, high: float, steps: Sequence[tuple[float, float]]) -> list[float]:
    """Heights from low, below high; steps pairs a range that must be exceeded with the step then."""
    step = [s for over, s in steps if high - low > over or over < 0][-1]
    return [low + k * step for k in range(max(0, ceil((high - low) / step - 1e-9)))]


# rivers below land


def lower_river_below_land(cells: DataFrame, n_cols: int, metre: float = 1000.0, swo_cutoff: int = 20, least_cells: int = 50, land_reach: int = 15, fill_reach: int = 8) -> DataFrame:
    """z and code after stretches of river and lake (code 3, 4) that stand above the land beside them are lowered.

    Heights are cut into steps (0.5 m; 1, 2 or 5 m where the water spans more than 10, 100 or 200 m); the
    pieces of all steps are judged side by side.  A piece of at least least_cells cells needs land beside it
    and, where other water touches it, two separate banks that make up a fifth of its border.  It lies too
    high if its lower quarter stands above the lowest twentieth of the land within land_reach (without
    frequent water) less 0.5 m; where that calls for more than 30 m, above its lowest tenth less 1 m.  A piece
    whose surround of 3 cells holds much more river of like height than itself is a strip of bank and
    stays.  A piece falls as a whole, no cell more than 1 m below the level its lower quarter reaches, and gets code
    5 (lakes keep 3).  Water within 3 cells, and banks where it fell by more than 3 m, are filled in
    anew; such banks get code 2.  A height on a step's border belongs to the upper one.
    """
    water = F.col("code").isin(3, 4) & F.col("z").isNotNull()
    found = cells.where(water).agg(F.count("*").alias("n"), _percentile(F.col("z"), 0.03).alias("lo"), _percentile(F.col("z"), 0.99).alias("hi")).first()
    if found["n"] < 100:
        return _unchanged(cells)
    low, high = floor(max(-2.0, found["lo"] / metre)) - 1.25, ceil(max(0.0, found["hi"] / metre)) + 0.25
    step = [s for over, s in ((-1, 0.5), (10, 1.0), (100, 2.0), (200, 5.0)) if high - low > over][-1]
    count = ceil((high + step - low) / step - 1e-9)
    step_of = F.floor((F.col("z") / metre - low) / step).cast("int")
    held = cells.select("r", "c", F.col("z").cast("double").alias("z"), "swo", "code", F.when(water & step_of.between(0, count - 1), step_of).alias("step"))
    pieces = label(held, F.col("step").isNotNull(), n_cols, 8, ["step"])
    sizes = pieces.groupBy("zone").agg(F.count("*").alias("n")).where(F.col("n") >= least_cells)
    pieces = materialize(pieces.join(sizes.select("zone"), "zone", "left_semi"), "ladder-pieces")
    inside = pieces.join(held.select("r", "c", "z"), ["r", "c"])
    own = inside.groupBy("zone", "step").agg(F.count("*").alias("n"), _percentile(F.col("z"), 0.25).alias("p25"))
    near = materialize(around(held.where("z is not null"), pieces, land_reach), "ladder-near")
    bank, touching = F.col("code") < 3, F.col("d") == 1
    land = F.when(bank & (F.col("swo") < swo_cutoff), F.col("z"))
    beside = near.groupBy("zone").agg(
        F.count_if(touching & bank).alias("banks"), F.count_if(touching & ~bank).alias("waters"), _percentile(land, 0.05).alias("p5"), _percentile(land, 0.1).alias("p10")
    )
    parts = _parts(near.where(touching & bank), n_cols, 8).groupBy("zone").agg(F.count_distinct("part").alias("parts"))
    judged = own.join(beside, "zone").join(parts, "zone", "left").where((F.col("banks") > 0) & F.col("p5").isNotNull())
    judged = judged.where((F.col("waters") == 0) | ((F.col("parts") >= 2) & (5 * F.col("banks") >= F.col("banks") + F.col("waters"))))
    first = F.col("p25") - (F.col("p5") - 0.5 * metre)
    judged = judged.withColumn("drop", F.when(first > 30 * metre, F.col("p25") - (F.col("p10") - metre)).otherwise(first)).where("drop > 0")
    level = judged.select("zone", "step", "n", "p25", "drop", (F.col("p25") - F.col("drop")).alias("level"))
    # river of like height within 3 cells that is in no piece of this step, and the piece itself
    like = near.where((F.col("d") <= 3) & ~bank).join(level.select("zone", F.col("step").alias("_own"), "level"), "zone")
    like = like.where((F.col("z") >= F.col("level")) & ~F.col("step").eqNullSafe(F.col("_own"))).groupBy("zone").agg(F.count("*").alias("_a"))
    self_ = inside.join(level.select("zone", "level"), "zone").where(F.col("z") >= F.col("level")).groupBy("zone").agg(F.count("*").alias("_b"))
    level = level.join(like, "zone", "left").join(self_, "zone", "left").where(F.coalesce("_a", F.lit(0)) + F.coalesce("_b", F.lit(0)) < 2.5 * F.col("n"))
    level = materialize(level.select("zone", "p25", "drop"), "ladder-level")
    fall = pieces.join(level, "zone").select("r", "c", "p25", "drop")
    ring = near.where("d <= 3").join(level, "zone").select("r", "c", F.when(F.col("code").between(3, 5), 1).when((F.col("code") < 2) & (F.col("drop") > 3 * metre), 2).alias("kind")).where("kind is not null")
    ring = materialize(ring.groupBy("r", "c").agg(F.max("kind").alias("kind")), "ladder-ring")
    lowered = cells.join(fall, ["r", "c"], "left").join(ring, ["r", "c"], "left").withColumn("z", F.col("z").cast("double"))
    to = F.greatest(F.col("z") - F.col("drop"), F.col("p25") - F.col("drop") - metre)
    code = F.when(F.col("kind") == 2, 2).when(F.col("drop").isNotNull() & (F.col("code") != 3), 5).otherwise(F.col("code"))
    lowered = lowered.withColumns({"z": F.when(F.col("drop").isNotNull(), to).otherwise(F.col("z")), "code": code.cast("int")}).select(*cells.columns)
    return _refill(lowered, ring, fill_reach)


# rounds of the ladders that see what they have changed


#: Side of the blocks that say which pieces are near: more than any piece looks around for water, and one more.
BLOCK = 8


def _reached(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(zone) of all that the zones of start reach along edges (a, b); few edges are walked in one task."""
    if edges.count() <= FEW:
        both = edges.unionByName(start.select(F.lit(None).cast("long").alias("a"), F.col("zone").alias("b")))
        return both.coalesce(1).mapInArrow(_walk, "zone long")
    front = edges.join(start.select(F.col("zone").alias("a")), "a", "left_semi").select(F.col("b").alias("zone")).distinct()
    found = front = materialize(front, "ladder-front")
    while not front.isEmpty():
        ahead = edges.join(front.select(F.col("zone").alias("a")), "a", "left_semi").select(F.col("b").alias("zone")).distinct()
        front = materialize(ahead.join(found, "zone", "left_anti"), "ladder-front")
        found = materialize(found.unionByName(front), "ladder-found")
    return found


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the starts (null, b) reach along the edges (a, b) of a partition; for graphs whose size has been checked."""
    ahead: dict[int | None, list[int]] = {}
    for batch in batches:
        for a, b in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            ahead.setdefault(a, []).append(b)
    todo, found = ahead.pop(None, []), set()
    while todo:
        for b in ahead.pop(todo.pop(), []):
            if b not in found:
                found.add(b)
                todo.append(b)
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64())], names=["zone"])


def _rounds(state: DataFrame, heights: Sequence[float], on: Column, pieces: Callable[[DataFrame], DataFrame], fit: Callable[[DataFrame], DataFrame], judge: Callable[[DataFrame, DataFrame], DataFrame], apply: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Goes up the ladder until no step changes anything.

    state has r, c, z, code and what judge and apply need; on says which cells are water of the kind.
    pieces(held) gives (zone, step, r, c) from held, the state's water cells once for each step (with h, its
    height) that is still to come for them, fit(pieces) those that may fall; judge(pieces, state) the zones that fall, with
    their step and what apply needs; apply(state, pieces, fall) the state after them.

    A fall changes cells of its piece only.  Pieces of the step above within BLOCK cells may see it, or what they
    do then, and so on; as pieces of higher steps lie in those of lower ones, all that a fall may come to change or
    reshape is reached so.  What is not reached is settled, whether it fell or not.
    """
    last = len(heights) - 1
    state = materialize(state.withColumn("done", F.lit(-1)), "ladder-state")
    ladder = F.array(*[F.struct(F.lit(k).alias("step"), F.lit(float(h)).alias("h")) for k, h in enumerate(heights)])
    spark, path = state.sparkSession, None
    while heights:
        with scratch(spark) as held_paths:
            held = state.where(on & (F.col("done") < last)).withColumn("_s", F.explode(ladder)).where(F.col("_s.step") > F.col("done")).withColumns({"step": F.col("_s.step"), "h": F.col("_s.h")}).drop("_s")
            every = materialize(pieces(held), "ladder-every")
            found = materialize(fit(every), "ladder-pieces")
            fall = materialize(judge(found, state), "ladder-fall")
            if fall.isEmpty():
                break
            blocks = materialize(every.select("zone", "step", F.floor(F.col("r") / BLOCK).alias("i"), F.floor(F.col("c") / BLOCK).alias("j")).distinct(), "ladder-blocks")
            near = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in [(0, 0), *RING]]))
            above = blocks.withColumn("_s", near).select(F.col("zone").alias("b"), (F.col("step") - 1).alias("step"), (F.col("i") + F.col("_s.i")).alias("i"), (F.col("j") + F.col("_s.j")).alias("j"))
            edges = materialize(blocks.withColumnRenamed("zone", "a").join(above, ["step", "i", "j"]).select("a", "b").distinct(), "ladder-edges")
            waits = materialize(_reached(edges, fall), "ladder-waits")
            fall = materialize(fall.join(waits, "zone", "left_anti"), "ladder-fall")
            changed = apply(state, found.join(fall.select("zone"), "zone", "left_semi"), fall)
            open_ = every.join(waits, "zone", "left_semi").select("r", "c", (F.col("step") - 1).alias("_done"))
            open_ = open_.unionByName(found.join(fall.select("zone"), "zone", "left_semi").select("r", "c", F.col("step").alias("_done")))
            open_ = materialize(open_.groupBy("r", "c").agg(F.min("_done").alias("_done")), "ladder-open")
            state, next_path = write_table(changed.join(_beside(open_), ["r", "c"], "left").withColumn("done", F.coalesce("_done", F.lit(last))).drop("_done"), "ladder-state")
            keep(held_paths, next_path)
        if path is not None:
            remove(spark, path)
        path = next_path
    return state.drop("done")


def _off_rim(pieces: DataFrame, rim: DataFrame | None) -> DataFrame:
    """Pieces without a cell in rim (r, c), the unit's edge."""
    if rim is None:
        return pieces
    touched = pieces.join(rim.select("r", "c").distinct(), ["r", "c"], "left_semi").select("zone").distinct()
    return pieces.join(touched, "zone", "left_anti")


def _keys(pieces: DataFrame) -> DataFrame:
    return pieces.select("zone", "step").distinct()


# rivers that run over a hump


def monotonic_rivers(cells: DataFrame, n_cols: int, rim: DataFrame | None = None, metre: float = 1000.0, radius: float = 25.0, swo_cutoff: int = 20, strict: bool = True, max_range: float = 100.0, least_river: int = 3000, heights: Sequence[float] | None = None, fill_reach: int = 8) -> DataFrame:
    """z and code after raised stretches of river (code 4 to 7) between lower ends are lowered.

    The ladder runs over the heights of the river from 1 m below its first percentile (-3 m at least) to 3 m
    above its 99th, in steps of 0.5 m (1, 3, 5 m for spans over 50, 100, 200 m), if least_river cells are river;
    or over heights.  A piece is river above a step's height with the river cells beside it, joined at sides,
    in no cell of rim, of more than pi (radius / 10)^2 cells.  It stays if

    * only water touches it and it is small, or the river within 3 cells has over half as many cells as it,
    * banks (code 1, 2) within 3 cells are fewer than 1.5 times the river there, unless it is mostly frequent water,
    * it has not two or three end caps: parts (joined at sides) of the river within 3 cells that is not above the
      step; if strict, parts of fewer than 3 cells, well inside the piece's box, or walled in by the piece do not count,
    * its end caps' outermost cells do not lie in different caps, along both axes at least half (a tenth, if
      not strict) of its box's diagonal apart,
    * its lowest tenth is below the end caps' lowest fifth.

    Else it falls by that difference, no deeper than the end caps' level: code 6; or, if it has fallen before
    and spans less than max_range metres, to that level: code 7.  No cell rises by more than 0.1 m.  River within
    3 cells of pieces that fell, and banks there if they fell to a level, are filled in anew at the end; such banks get code 2.
    """
    river = F.col("code").between(4, 7) & F.col("z").isNotNull()
    if heights is None:
        got = cells.where(river).agg(F.count("*").alias("n"), _percentile(F.col("z"), 0.01).alias("lo"), _percentile(F.col("z"), 0.99).alias("hi")).first()
        if not got["n"] or got["n"] < least_river:
            return _unchanged(cells)
        low, high = floor(max(-3.0, got["lo"] / metre - 1.0)) - 0.5, floor(got["hi"] / metre) + 3.5
        heights = [metre * h for h in ladder_of(low, high, ((-1, 0.5), (50, 1.0), (100, 3.0), (200, 5.0)))]
        if len(heights) < 2:
            return _unchanged(cells)
    area = round(pi * (radius / 10) ** 2)
    state = cells.withColumn("z", F.col("z").cast("double")).withColumns({"_first": F.col("z"), "_was": F.col("code"), "_on": river, "_left": F.lit(1), "_ring": F.lit(0)})

    def pieces(held: DataFrame) -> DataFrame:
        above = held.where(F.col("z") > F.col("h")).select("step", "r", "c")
        step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in [(0, 0), *RING]]))
        beside = above.withColumn("_s", step).select("step", (F.col("r") + F.col("_s.i")).alias("r"), (F.col("c") + F.col("_s.j")).alias("c")).distinct()
        near = held.where(F.col("z") != F.col("h")).select("step", "r", "c").join(beside, ["step", "r", "c"], "left_semi")
        return label(near, F.lit(True), n_cols, 4, ["step"])

    def fit(every: DataFrame) -> DataFrame:
        found = _off_rim(every, rim)
        big = found.groupBy("zone").agg(F.count("*").alias("n")).where(F.col("n") > area)
        return found.join(big.select("zone"), "zone", "left_semi")

    def judge(found: DataFrame, state: DataFrame) -> DataFrame:
        level = F.element_at(F.array(*[F.lit(float(h)) for h in heights]), F.col("step") + 1)
        inside = state.select("r", "c", "z", "swo", "_left").join(_beside(found), ["r", "c"])
        own = inside.groupBy("zone", "step").agg(
            F.count("*").alias("n"), _percentile(F.col("z"), 0.1).alias("p10"), _percentile(F.col("z"), 0.95).alias("p95"), _percentile(F.col("swo"), 0.8).alias("wet"), F.min("_left").alias("left"),
            F.min("r").alias("ra"), F.max("r").alias("rb"), F.min("c").alias("ca"), F.max("c").alias("cb"),
        )
        near = materialize(around(state.select("r", "c", "z", F.col("_was").alias("code")), found, 3).join(_keys(found), "zone"), "ladder-near")
        water = F.col("code").between(3, 6)
        beside = near.groupBy("zone").agg(F.count_if((F.col("d") == 1) & (F.col("code") < 3)).alias("touch"), F.count_if(F.col("code").isin(1, 2)).alias("banks"), F.count_if(water).alias("waters"))
        good = own.join(beside, "zone").where(~((F.col("touch") == 0) & (F.col("n") < 4 * area)) & (F.col("n") >= 2 * F.col("waters")) & ((F.col("banks") >= 1.5 * F.col("waters")) | (F.col("wet") >= swo_cutoff)))
        good = materialize(good, "ladder-good")
        ends = near.where(water & (F.col("z") <= level)).join(good.select("zone"), "zone", "left_semi")
        caps = materialize(_parts(ends, n_cols, 4).join(ends.select("zone", "r", "c", "z"), ["zone", "r", "c"]), "ladder-caps")
        if strict:
            box = caps.groupBy("zone", "part").agg(F.count("*").alias("m"), F.min("r").alias("pa"), F.max("r").alias("pb"), F.min("c").alias("qa"), F.max("c").alias("qb")).join(good.select("zone", "ra", "rb", "ca", "cb"), "zone")
            interior = (F.col("ca") + 10 < F.col("qa")) & (F.col("cb") - 10 > F.col("qb")) & (F.col("ra") + 10 < F.col("pa")) & (F.col("rb") - 10 > F.col("pb"))
            step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in RING]))
            out = caps.withColumn("_s", step).select("zone", "part", (F.col("r") + F.col("_s.i")).alias("r"), (F.col("c") + F.col("_s.j")).alias("c"))
            out = out.join(ends.select("zone", "r", "c"), ["zone", "r", "c"], "left_anti").join(found.select("zone", "r", "c"), ["zone", "r", "c"], "left_anti").select("zone", "part").distinct()
            kept = box.where((F.col("m") >= 3) & ~interior).join(out, ["zone", "part"], "left_semi").select("zone", "part")
            caps = materialize(caps.join(kept, ["zone", "part"], "left_semi"), "ladder-caps")
        at = F.struct("r", "c", "part")
        far = caps.groupBy("zone").agg(
            F.count_distinct("part").alias("caps"), _percentile(F.col("z"), 0.2).alias("level"),
            F.min(F.struct(F.col("c").alias("k"), at.alias("at"))).alias("w"), F.min(F.struct((-F.col("c")).alias("k"), at.alias("at"))).alias("e"),
            F.min(F.struct(F.col("r").alias("k"), at.alias("at"))).alias("n_"), F.min(F.struct((-F.col("r")).alias("k"), at.alias("at"))).alias("s_"),
        )

        def apart(a: str, b: str) -> Column:
            d = F.sqrt((F.col(f"{a}.at.r") - F.col(f"{b}.at.r")) ** 2 + (F.col(f"{a}.at.c") - F.col(f"{b}.at.c")) ** 2)
            return F.when(F.col(f"{a}.at.part") == F.col(f"{b}.at.part"), 0.0).otherwise(d)

        both = good.join(far, "zone").where(F.col("caps").between(2, 3))
        least = F.sqrt((F.col("rb") - F.col("ra") + 9) ** 2 + (F.col("cb") - F.col("ca") + 9) ** 2) / (2 if strict else 10)
        both = both.where((apart("w", "e") >= least) & (apart("n_", "s_") >= least)).withColumn("drop", F.col("p10") - F.col("level")).where("drop >= 0")
        absolute = (F.col("p95") - F.col("p10") < max_range * metre) & (F.col("left") == 2)
        return both.select("zone", "step", "level", "drop", absolute.alias("absolute"))

    def apply(state: DataFrame, found: DataFrame, fall: DataFrame) -> DataFrame:
        level = F.element_at(F.array(*[F.lit(float(h)) for h in heights]), F.col("_step") + 1)
        # side-joined pieces of one step do not overlap
        to = found.join(fall.select("zone", "level", "drop", "absolute"), "zone").select("r", "c", F.col("step").alias("_step"), "level", "drop", "absolute")
        ring = around(state.select("r", "c", F.col("_was").alias("_code")), found, 3).join(fall.select("zone", "absolute"), "zone")
        ring = ring.select("r", "c", F.when(F.col("_code").between(3, 6), 2).when(F.col("_code").isin(1, 2) & F.col("absolute"), 1).alias("_new")).where("_new is not null").groupBy("r", "c").agg(F.max("_new").alias("_new"))
        to, ring = materialize(to, "ladder-to"), materialize(ring, "ladder-ring")
        moved = state.join(_beside(to), ["r", "c"], "left").join(_beside(ring), ["r", "c"], "left")
        relative = F.when(F.col("z") - level < F.col("drop"), F.col("level")).otherwise(F.col("z") - F.col("drop"))
        z = F.when(F.col("absolute").isNull(), F.col("z")).when(F.col("absolute"), F.col("level")).otherwise(relative)
        z = F.when(z - F.col("_first") > 0.1 * metre, F.col("_first")).otherwise(z)
        code = F.when(F.col("absolute"), 7).when(~F.col("absolute"), 6).otherwise(F.col("code"))
        moved = moved.withColumns({"_z": z, "code": code.cast("int"), "_left": F.when(~F.col("absolute"), 2).otherwise(F.col("_left")), "_ring": F.coalesce("_new", "_ring")})
        return moved.withColumn("z", F.col("_z")).select(*state.columns)

    done = _rounds(state, heights, F.col("_on"), pieces, fit, judge, apply)
    done = done.withColumn("code", F.when(F.col("_ring") == 1, 2).otherwise(F.col("code")).cast("int"))
    return _refill(done, done.where("_ring > 0"), fill_reach).select(*cells.columns)


# streams that run over a hump


def monotonic_streams(cells: DataFrame, n_cols: int, rim: DataFrame | None = None, metre: float = 1000.0, radius: float = 25.0, least_stream: int = 50, heights: Sequence[float] | None = None, fill_reach: int = 5) -> DataFrame:
    """z and code after raised pieces of streams (code 8 to 10) between lower ones are lowered.

    The ladder runs over the 2nd to the 98th percentile of the streams' heights (whole metres and a half, not below 0) in
    steps of 2 m (3, 5, 10 m for spans over 20, 100, 500 m), if they span more than 5 m and have more than least_stream
    cells; or over heights, whose first two give the step.  A piece is stream above a step's height, in no cell of rim, of
    radius / 4 cells to a quarter of all stream cells.  It stays if

    * its top is less than half a step above the height,
    * the stream below the height within 2 cells is not in two or more parts, all of two or more cells,
    * there is as much land within 8 cells that is at most a step above the height as it has cells,
    * its shape is no line or Y: more than three cells have the fewest neighbours, or three with fewer than three
      parts, or a cell has more than three neighbours and fewer than three have the fewest,
    * it has two parts, whose first cells are less than half as far apart as it has cells.

    Else it falls to the highest of those parts: code 13; all within 2 cells of it is filled in anew at the
    end: code 14.
    """
    stream = F.col("code").between(8, 10) & F.col("z").isNotNull()
    got = cells.where(stream).agg(F.count("*").alias("n"), _percentile(F.col("z"), 0.02).alias("lo"), _percentile(F.col("z"), 0.98).alias("hi")).first()
    if not got["n"] or got["n"] <= least_stream:
        return _unchanged(cells)
    if heights is None:
        low, high = floor(max(0.0, got["lo"] / metre)) + 0.5, floor(got["hi"] / metre) + 0.5
        if high - low <= 5:
            return _unchanged(cells)
        heights = [metre * h for h in ladder_of(low, high, ((-1, 2.0), (20, 3.0), (100, 5.0), (500, 10.0)))]
    rise = heights[1] - heights[0] if len(heights) > 1 else 2.0 * metre
    state = cells.withColumn("z", F.col("z").cast("double")).withColumns({"_on": stream, "_was": F.col("code"), "_ring": F.lit(0)})
    level = F.element_at(F.array(*[F.lit(float(h)) for h in heights]), F.col("step") + 1)

    def pieces(held: DataFrame) -> DataFrame:
        return label(held.where(F.col("z") > F.col("h")), F.lit(True), n_cols, 8, ["step"])

    def fit(every: DataFrame) -> DataFrame:
        found = _off_rim(every, rim)
        fits = found.groupBy("zone").agg(F.count("*").alias("n")).where((F.col("n") >= radius / 4) & (F.col("n") <= got["n"] / 4))
        return found.join(fits.select("zone"), "zone", "left_semi")

    def judge(found: DataFrame, state: DataFrame) -> DataFrame:
        own = found.join(state.select("r", "c", "z"), ["r", "c"]).groupBy("zone", "step").agg(F.count("*").alias("n"), F.max("z").alias("top"))
        own = own.where(F.col("top") - level >= 0.5 * rise)
        near = materialize(around(state.select("r", "c", "z", "_was", "_on"), found, 8).join(_keys(found), "zone"), "ladder-near")
        lower = near.where((F.col("d") <= 2) & F.col("_on") & (F.col("z") < level))
        parts = _parts(lower, n_cols, 8).join(lower.select("zone", "r", "c", "z"), ["zone", "r", "c"])
        parts = parts.groupBy("zone", "part").agg(F.count("*").alias("m"), F.max("z").alias("z"), F.min(F.struct("r", "c")).alias("first"))
        parts = parts.groupBy("zone").agg(F.count("*").alias("parts"), F.min("m").alias("m"), F.max("z").alias("to"), F.min("first").alias("f1"), F.max("first").alias("f2"))
        land = near.groupBy("zone").agg(F.count_if(~F.col("_on") & (F.col("_was") < 3) & (F.col("z") <= level + rise)).alias("land"))
        # a line's ends have one neighbour, the branches of a Y meet in a cell with three
        step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in [(0, 0), *RING]]))
        degree = found.withColumn("_s", step).select("zone", (F.col("r") + F.col("_s.i")).alias("r"), (F.col("c") + F.col("_s.j")).alias("c")).join(found.select("zone", "r", "c"), ["zone", "r", "c"], "left_semi")
        degree = degree.groupBy("zone", "r", "c").agg(F.count("*").alias("k")).groupBy("zone", "k").agg(F.count("*").alias("m"))
        shape = degree.groupBy("zone").agg(F.min(F.struct("k", "m")).alias("least"), F.max("k").alias("most")).select("zone", F.col("least.m").alias("ends"), "most")
        both = own.join(parts, "zone").join(land, "zone").join(shape, "zone").where((F.col("parts") >= 2) & (F.col("m") >= 2) & (F.col("land") < F.col("n")))
        both = both.where((F.col("ends") <= 3) & ~((F.col("ends") == 3) & (F.col("parts") < 3)) & ~((F.col("most") > 4) & (F.col("ends") < 3)))
        apart = F.sqrt((F.col("f1.r") - F.col("f2.r")) ** 2 + (F.col("f1.c") - F.col("f2.c")) ** 2)
        return both.where((F.col("parts") != 2) | (apart >= F.col("n") / 2)).select("zone", "step", "to")

    def apply(state: DataFrame, found: DataFrame, fall: DataFrame) -> DataFrame:
        to = found.join(fall.select("zone", "to"), "zone").select("r", "c", "to")
        ring = around(state.select("r", "c", F.col("_was").alias("_code")), found, 2).where("_code <> 7").select("r", "c", F.lit(1).alias("_new")).distinct()
        moved = state.join(to, ["r", "c"], "left").join(ring, ["r", "c"], "left")
        mark = F.when(F.col("to").isNotNull(), 2).otherwise(F.coalesce("_new", "_ring"))
        return moved.withColumns({"z": F.coalesce("to", "z"), "_ring": mark}).select(*state.columns)

    done = _rounds(state, heights, F.col("_on"), pieces, fit, judge, apply)
    done = done.withColumn("code", F.when(F.col("_ring") == 2, 13).when(F.col("_ring") == 1, 14).otherwise(F.col("code")).cast("int"))
    return _refill(done, done.where("_ring = 1"), fill_reach).select(*cells.columns)
