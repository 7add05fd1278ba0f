"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.storage import materialize

#: Keys of the ring: places of the hash space that move as one.  A fixed number, so what is known of them is bounded.
CELLS = 1 << 14
VIRTUAL_NODES = 64
SLACK = 0.001
#: Rows of a shard that are numbered together.
SLICE_ROWS = 1 << 13


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS, seed: int = 9) -> tuple[list[int], list[int]]:
    """Places of the virtual nodes on the ring, ascending, and their shards.  A shard's nodes do not depend on the others."""
    nodes = sorted((int(p), s) for s in range(shards) for p in np.random.default_rng([seed, s]).integers(0, cells, virtual_nodes))
    return [p for p, _ in nodes], [s for _, s in nodes]


def place(weights: dict[int, int], shards: int, slack: float = SLACK, virtual_nodes: int = VIRTUAL_NODES) -> dict[int, int]:
    """The shard of each cell: the next virtual node clockwise whose shard has room for it.

    No shard may hold more than (1 + slack) of the mean load.  Heavy cells choose first, then cells
    in the order of the ring; a cell that fits nowhere goes to the emptiest shard.
    """
    places, owner = ring(shards, virtual_nodes)
    room = [(1 + slack) * sum(weights.values()) / shards] * shards
    heavy = room[0] * slack / 2
    out = {}
    for cell in sorted(weights, key=lambda c: (-weights[c] if weights[c] > heavy else 0, c)):
        start = bisect.bisect_left(places, cell)
        tried: set[int] = set()
        for step in range(len(owner)):
            shard = owner[(start + step) % len(owner)]
            if shard in tried:
                continue
            if room[shard] >= weights[cell]:
                break
            tried.add(shard)
            if len(tried) == shards:
                shard = max(range(shards), key=lambda s: (room[s], -s))
                break
        out[cell] = shard
        room[shard] -= weights[cell]
    return out


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", slack: float = SLACK, keep_text: bool = True) -> DataFrame:
    """docs with the columns size, text_crc32, law, shard, slot and grown_shard.

    The law is 'bytes': shards' sizes are near equal, and rows with equal texts share a shard.  A
    text's hash gives its cell on the ring; a cell goes to the first virtual node clockwise whose
    shard still has room (at most 1 + slack of the mean, unless one group of equal texts is larger
    than that), so a change of sizes or shards moves few cells.  size is the text's UTF-8 bytes plus
    1 (a null text has none and counts as one group); slot numbers a shard's rows from 0 without
    gaps; grown_shard is null, as this law looks at sizes too.  Only the bounded table of cells
    meets the driver.  Slots are dealt in slices by a row's place in the table, whatever it holds, so
    any share of the rows may have equal texts, equal ids or none.  Rows that repeat an id or have
    none are rows of their own.  Other columns are returned as they are (the text unless keep_text
    is false); columns named like the new ones are replaced.  An empty table stays empty.
    """
    docs = docs.drop("size", "text_crc32", "law", "shard", "slot", "grown_shard", "_cell", "_slice", "_place")
    raw = F.encode(F.col(text_col), "utf-8")
    keyed = docs.withColumns(
        {"size": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1, "text_crc32": F.coalesce(F.crc32(raw), F.lit(0)).cast("long"), "_cell": F.pmod(F.xxhash64(text_col, F.lit("ring")), F.lit(CELLS)).cast("int"), "_place": F.monotonically_increasing_id()}
    )
    names = [c for c in docs.columns if keep_text or c != text_col]
    # written once, so that a row's place is the same in both passes
    keyed = materialize(keyed.select(*names, "size", "text_crc32", "_cell", "_place"), "places")
    weights = {r["_cell"]: r["w"] for r in keyed.groupBy("_cell").agg(F.sum("size").alias("w")).collect()}  # at most CELLS rows
    shard_of = docs.sparkSession.createDataFrame(list(place(weights, shards, slack).items()), "_cell int, shard int")
    slices = max(1, -(-keyed.count() // (shards * SLICE_ROWS)))
    dealt = keyed.join(F.broadcast(shard_of), "_cell").withColumn("_slice", F.pmod(F.xxhash64("_place"), F.lit(slices)))
    counts = dealt.groupBy("shard", "_slice").agg(F.count("*").alias("n"))
    before = counts.select("shard", "_slice", (F.sum("n").over(Window.partitionBy("shard").orderBy("_slice")) - F.col("n")).alias("_base"))
    row = F.row_number().over(Window.partitionBy("shard", "_slice").orderBy("_place")) - 1
    out = dealt.withColumn("_row", row).join(before, ["shard", "_slice"])
    return out.select(*names, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_base") + F.col("_row")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
