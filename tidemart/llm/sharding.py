"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of equal cells. Each shard owns virtual nodes on cells of its own; a
key belongs to the first virtual node at or clockwise of its cell, and where that shard is full
it goes on clockwise to the next shard with room. All keys of a cell meet the shards in the same
order, so the row counts of the cells decide everything: a cell's rows, ranked along the ring, are
cut into one interval per shard that takes some. The table of cells is bounded by the ring's
size, not by the data; rows never leave the executors.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.tables import stored, utf8

SHARDS = 16
VIRTUAL_NODES = 64
CELL_BITS = 12
# Each cell is cut into this many arcs (2 ** ARC_BITS) and each arc's rows into SALTS parts, so
# that ranks within a cell need no task to hold the cell, not even if one key has most rows.
ARC_BITS = 10
SALTS = 64

_ALLOTMENT = "array<struct<cell: int, shard: int, low: bigint, high: bigint, base: bigint>>"


def ring(n_shards: int, virtual_nodes: int = VIRTUAL_NODES, cell_bits: int = CELL_BITS) -> list[int]:
    """For each cell the shard of the virtual node on it, or -1.

    A virtual node takes the cell its name hashes to, or the next free one clockwise. Shards come
    in order, so one more shard leaves all earlier virtual nodes where they are.
    """
    size = 1 << cell_bits
    if n_shards < 1 or virtual_nodes < 1 or n_shards * virtual_nodes > size:
        raise ValueError(f"1 to {size} virtual nodes fit the ring")
    owner = [-1] * size
    for shard in range(n_shards):
        for node in range(virtual_nodes):
            name = hashlib.sha256(f"{shard}/{node}".encode()).digest()
            cell = int.from_bytes(name[:8], "big") % size
            while owner[cell] >= 0:
                cell = (cell + 1) % size
            owner[cell] = shard
    return owner


def capacities(rows: int, n_shards: int, slack: float | None) -> list[int]:
    """Rows that each shard may take: sharp bounds that differ by one, or the mean and some slack."""
    if slack is None:
        return [rows // n_shards + (shard < rows % n_shards) for shard in range(n_shards)]
    if slack < 0:
        raise ValueError("slack must not be negative")
    return [math.ceil((1 + slack) * rows / n_shards)] * n_shards


def allot(counts: dict[int, int], owner: list[int], room: list[int]) -> list[dict[str, int]]:
    """Cut each cell's ranks into intervals ``low <= rank < high`` of a shard, whose slots start at ``base``."""
    room, used, cuts, size = list(room), [0] * len(room), [], len(owner)
    for cell in sorted(counts):
        low, rest, at = 0, counts[cell], cell
        while rest:
            shard = owner[at % size]
            if shard >= 0 and room[shard]:
                take = min(rest, room[shard])
                cuts.append({"cell": cell, "shard": shard, "low": low, "high": low + take, "base": used[shard]})
                low, rest = low + take, rest - take
                room[shard] -= take
                used[shard] += take
            at += 1
    return cuts


def bounded_shards(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_shards: int = SHARDS,
    virtual_nodes: int = VIRTUAL_NODES,
    slack: float | None = None,
) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``, one row per input row.

    With ``slack=None`` the shards' row counts differ by one at most; otherwise no shard takes more
    than ``(1 + slack)`` times the mean, which moves fewer keys when a shard is added. Slots are
    gapless from 0 in each shard. Null texts count as empty. Null ids are one key; rows of one key
    are interchangeable and may be cut between shards, as the bound comes first. An empty table
    gives an empty result. Other columns are ignored.
    """
    point = F.xxhash64(F.col(id_col))
    cell = F.shiftrightunsigned(point, 64 - CELL_BITS).cast("int")
    arc = F.shiftrightunsigned(point, 64 - CELL_BITS - ARC_BITS)
    arc = arc.bitwiseAND(F.lit((1 << ARC_BITS) - 1).cast("long"))
    rows = stored(
        documents.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(utf8(text_col)) + 1).cast("long").alias("size"),
            F.crc32(utf8(text_col)).alias("text_crc32"),
            point.alias("point"),
            cell.alias("cell"),
            arc.cast("int").alias("arc"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "ring",
    ).withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))

    part = ["cell", "arc", "salt"]
    before = Window.partitionBy("cell").orderBy("arc", "salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*part).agg(F.count("*").alias("n"))
    offsets = parts.select(*part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    per_cell = rows.groupBy("cell").agg(F.count("*").alias("n")).collect()  # a row per cell at most
    counts = {r["cell"]: r["n"] for r in per_cell}
    owner = ring(n_shards, virtual_nodes)
    cuts = json.dumps(allot(counts, owner, capacities(sum(counts.values()), n_shards, slack)))
    # At most one cut per cell and one more each time a shard fills up.
    table = documents.sparkSession.range(1).select(F.inline(F.from_json(F.lit(cuts), _ALLOTMENT)))

    along = Window.partitionBy(*part).orderBy("point", "row")
    ranked = rows.join(offsets, part).withColumn("rank", F.col("offset") + F.row_number().over(along) - 1)
    cut = F.broadcast(table.withColumnRenamed("cell", "at"))
    inside = (F.col("cell") == F.col("at")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    return ranked.join(cut, inside).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("low")).alias("slot")
    )


def moved(before: DataFrame, after: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of two shardings of the same unique ids whose shard differs."""
    then = before.select(F.col(id_col), F.col("shard").alias("shard_before"))
    return after.join(then, id_col).where("shard <> shard_before").select(id_col, "shard_before", "shard")
