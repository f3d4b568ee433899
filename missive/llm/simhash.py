"""SimHash near-duplicates by segment popcounts.

A fingerprint is cut into 32 segments of two bits; the bit counts of the segments are a point of a grid, packed into
one long.  The Manhattan distance of two points never exceeds the Hamming distance of the fingerprints.  Two
fingerprints at distance two or less therefore share a grid cell one step or less from either: each enters its own cell
and the neighbours, and only cells with two or more fingerprints are kept (the range join's lower bound).

Exact verification stays inside a shared cell: a fingerprint lists the values of that cell that differ from it in one
bit or less, and two fingerprints with a common value differ in two bits or less, and the other way round.  At most 65
distinct fingerprints can share one value, so no list grows with the data and no pairs of a group are formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, components, raw_texts, saved, shuffle_width

_BITS = np.array([1 << k for k in range(64)], np.uint64)
_EVEN = 0x5555555555555555


def fingerprint(text: bytes, size: int = 3) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' XXH64 (seed 42).  No words: zero."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= size:
        return xxh64_intdigest(b" ".join(words), 42)
    join = b" ".join
    hashes = [xxh64_intdigest(join(s), 42) for s in zip(*(words[k:] for k in range(size)))]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.array(hashes[at : at + 65_536], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(_BITS[counts * 2 > len(hashes)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp): one row for each document, fp the fingerprint as a signed long.  A null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, size) for t in raw_texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp bigint")


def popcounts(fp: Column) -> Column:
    """The bit counts of the 32 two-bit segments, each in the place of its segment."""
    high = F.shiftrightunsigned(fp, 1)
    both, one = high.bitwiseAND(fp).bitwiseAND(F.lit(_EVEN)), high.bitwiseXOR(fp).bitwiseAND(F.lit(_EVEN))
    return F.shiftleft(both, 1).bitwiseOR(one)


def cells(prints: DataFrame) -> DataFrame:
    """(fp, seg, step, cell): the cell of each fingerprint (seg -1) and the cells one step away in one segment."""
    base = prints.select("fp", popcounts(F.col("fp")).alias("own"))
    moves = base.select(
        "fp",
        "own",
        F.explode(
            F.array(
                F.struct(F.lit(-1).alias("seg"), F.lit(0).alias("step")),
                *[F.struct(F.lit(k).alias("seg"), F.lit(s).alias("step")) for k in range(32) for s in (1, -1)],
            )
        ).alias("m"),
    ).select("fp", "own", "m.seg", "m.step")
    count = F.expr("cast(shiftrightunsigned(own, 2 * greatest(seg, 0)) & 3 as int)")
    inside = (F.col("seg") == -1) | (count + F.col("step")).between(0, 2)
    # without carries: 0 and 1 differ in the low bit of the two, 1 and 2 in both
    change = F.when(F.col("seg") == -1, F.lit(0)).when(F.least(count, count + F.col("step")) == 0, 1).otherwise(3)
    moved = moves.where(inside).withColumn("change", change.cast("bigint"))
    cell = F.col("own").bitwiseXOR(F.expr("shiftleft(change, 2 * greatest(seg, 0))"))
    return moved.select("fp", "seg", "step", cell.alias("cell"))


def middles(shared: DataFrame) -> DataFrame:
    """(fp, mid): the values of the shared cells that differ from the fingerprint in one bit or less.

    In the own cell that is the fingerprint itself.  One step up sets one of the segment's clear bits, one step down
    clears one of its set bits: one or two values.
    """
    low, high = F.expr("shiftleft(1L, 2 * greatest(seg, 0))"), F.expr("shiftleft(1L, 2 * greatest(seg, 0) + 1)")
    flips = F.when(F.col("seg") == -1, F.array(F.lit(0).cast("bigint"))).otherwise(F.array(low, high))
    flipped = shared.select("fp", "seg", "step", F.explode(flips).alias("flip"))
    was_set = F.col("fp").bitwiseAND(F.col("flip")) != 0
    fits = (F.col("seg") == -1) | (was_set == (F.col("step") == -1))
    return flipped.where(fits).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): edges that join all fingerprints of ``distinct`` (fp) at two or fewer differing bits.

    Each value in the middle joins its fingerprints (65 at most) to the smallest of them.
    """
    width = shuffle_width(distinct)
    grid = saved(cells(distinct).repartition(width, "cell"), "cells")
    crowded = saved(grid.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell"), "crowded")
    near = middles(grid.join(crowded, "cell"))
    stars = near.groupBy("mid").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b").distinct()


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3
) -> DataFrame:
    """(id, fp, component): component is the smallest id reachable over links of two or fewer differing bits.

    Documents without words share fingerprint zero and are linked like any other.  A null id keeps its row and never
    names a component unless the whole component has none.
    """
    prints = saved(fingerprints(docs, id_col, text_col, size), "prints")
    distinct = saved(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp")))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = saved(named, "named")
    smallest = saved(named.groupBy("root").agg(F.min("least").alias("component")), "smallest")
    of_print = saved(named.join(smallest, "root").select("fp", "component"), "of-print")
    return prints.join(of_print, "fp").select("id", "fp", "component")
