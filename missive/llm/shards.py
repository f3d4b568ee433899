"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``2 ** ring_bits`` bins; every shard owns ``nodes`` virtual nodes, each at the start of a bin.  A row's
key hashes to a bin, and the bin belongs to the next virtual node clockwise.  A shard takes load up to its bound, in
ring order; what overflows continues clockwise to the next node of a shard with room.  The bounds add up to all rows
at least, so every row finds a shard.

Only the load of each (bin, sub-bin) reaches the driver: a table of at most ``2 ** (ring_bits + sub_bits)`` rows,
whatever the input.  A key that holds a third of all rows falls into one bin, whose rows are spread over sub-bins by a
hash of the whole row; a placement is a range of row numbers inside a sub-bin, so a hot bin can be split anywhere.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved


def ring(shards: int, nodes: int, ring_bits: int) -> list[tuple[int, int]]:
    """(bin, shard) of the virtual nodes, clockwise.  A shard's nodes don't depend on how many shards there are.

    Where two nodes fall on one bin, the smaller digest keeps it.
    """
    taken: dict[int, tuple[bytes, int]] = {}
    for shard in range(shards):
        for node in range(nodes):
            digest = hashlib.sha256(f"shard {shard} node {node}".encode()).digest()
            place = int.from_bytes(digest[:8], "big") >> (64 - ring_bits)
            taken[place] = min(taken.get(place, (digest, shard)), (digest, shard))
    return [(place, taken[place][1]) for place in sorted(taken)]


def place(
    loads: list[tuple[int, int, int]], bounds: list[int], points: list[tuple[int, int]]
) -> Iterator[tuple[int, int, int, int, int]]:
    """(bin, sub, low, high, shard): which shard takes the load [low, high) of each (bin, sub, load).

    All nodes take their own bins first, in ring order, then the overflow moves on, one node at a time.
    """
    starts = [p for p, _ in points]
    room = list(bounds)
    waiting: list[tuple[int, int, int, int, int]] = []
    for bin_, sub, load in sorted(loads):
        waiting.append((bisect.bisect_left(starts, bin_) % len(points), bin_, sub, 0, load))
    while waiting:
        left = []
        for node, bin_, sub, low, high in waiting:
            shard = points[node][1]
            take = min(room[shard], high - low)
            if take:
                room[shard] -= take
                yield bin_, sub, low, low + take, shard
            if low + take < high:
                ahead = node + 1
                while not room[points[ahead % len(points)][1]]:
                    ahead += 1
                    if ahead > node + len(points):
                        raise ValueError("the bounds hold less than the rows")
                left.append((ahead % len(points), bin_, sub, low + take, high))
        waiting = left


def bounds_of(total: int, shards: int, slack: float) -> list[int]:
    """Equal bounds, a fraction ``slack`` over the mean; without slack they add up to ``total`` exactly."""
    if slack:
        return [-(-int(total * (1 + slack)) // shards) + 1] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def assign(
    docs: DataFrame,
    key: list[str],
    shards: int = 8,
    nodes: int = 512,
    slack: float = 0.0,
    weight: str | None = None,
    ring_bits: int = 14,
    sub_bits: int = 2,
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (gapless from 0 within a shard).

    Loads are rows, or the sum of the column ``weight`` (a positive integer); a row goes where its first unit of load
    falls, so with weights a shard exceeds its bound by less than one row.  With no slack and no weight the shards' row
    counts differ by one at most.  Null keys hash like any value; identical rows are interchangeable.  Columns named
    ``shard`` or ``slot`` are an error, any other name is kept.
    """
    for name in ("shard", "slot"):
        if name in docs.columns:
            raise ValueError(f"the documents already have a column {name}")
    # the caller's columns are numbered until the end, so that no name meets one of those added here
    names, own = docs.columns, [f"c{k}" for k in range(len(docs.columns))]
    numbered = dict(zip(names, own))
    docs, key, weight = docs.toDF(*own), [numbered[c] for c in key], numbered[weight] if weight else None
    keyed = docs.select(
        *own,
        F.expr(f"cast(shiftrightunsigned({_hash(key)}, {64 - ring_bits}) as int)").alias("_bin"),
        F.pmod(F.xxhash64(F.lit(7), *own), F.lit(1 << sub_bits)).cast("int").alias("_sub"),
    )
    keyed = saved(keyed, "keyed")
    load = F.sum(weight) if weight else F.count("*")
    rows = keyed.groupBy("_bin", "_sub").agg(load.cast("bigint").alias("load")).collect()
    total = sum(r["load"] for r in rows)
    points = ring(shards, nodes, ring_bits)
    placed = list(place([tuple(r) for r in rows], bounds_of(total, shards, slack), points))
    order = Window.partitionBy("_bin", "_sub").orderBy(F.xxhash64(*key), F.xxhash64(F.lit(7), *own), *own)
    ranked = keyed.withColumn("_rank", F.row_number().over(order) - 1)
    if weight:
        before = F.sum(weight).over(order.rowsBetween(Window.unboundedPreceding, -1))
        ranked = ranked.withColumn("_at", F.coalesce(before, F.lit(0)).cast("bigint"))
    else:
        ranked = ranked.withColumn("_at", F.col("_rank").cast("bigint"))
    ddl = "_bin int, _sub int, _low bigint, _high bigint, shard int"
    pieces = docs.sparkSession.createDataFrame(placed, ddl)
    # at most one row for each sub-bin and overflow step: bounded by the ring, not by the input
    on = ["_bin", "_sub"]
    met = ranked.join(F.broadcast(pieces), on).where((F.col("_at") >= F.col("_low")) & (F.col("_at") < F.col("_high")))
    if weight:
        met = saved(met, "met")
        counted = met.groupBy(*on, "_low", "shard").agg(F.count("*").alias("n"), F.min("_rank").alias("first"))
        offsets = [(r["_bin"], r["_sub"], r["_low"], r["shard"], r["n"], r["first"]) for r in counted.collect()]
    else:
        offsets = [(b, s, low, shard, high - low, low) for b, s, low, high, shard in placed]
    used, starts = [0] * shards, []
    for bin_, sub, low, shard, n, first in sorted(offsets):
        starts.append((bin_, sub, low, used[shard] - first))
        used[shard] += n
    shift = docs.sparkSession.createDataFrame(starts, "_bin int, _sub int, _low bigint, _shift bigint")
    slotted = met.join(F.broadcast(shift), [*on, "_low"])
    slot = (F.col("_rank") + F.col("_shift")).cast("bigint")
    return slotted.select(*own, "shard", slot.alias("slot")).toDF(*names, "shard", "slot")


def _hash(columns: list[str]) -> str:
    return "xxhash64(" + ", ".join(f"`{c}`" for c in columns) + ")"
