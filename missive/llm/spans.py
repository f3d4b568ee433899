"""Where a pattern matches, with column functions only: offsets in code points, and the text around each match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches are numbered in blocks, so that a text with very many costs a block's square at most per block.
_BLOCK = 256


def matches(text: Column, pattern: str, when: Column | None = None) -> Column:
    """The leftmost non-overlapping matches.  The pattern must not match an empty string.

    Where ``when`` is false there are none, and the pattern isn't tried.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return values if when is None else F.when(when, values).otherwise(F.array().cast("array<string>"))


def pieces(text: Column, pattern: str, values: Column) -> Column:
    """What lies between ``values``; only cut where there are any."""
    return F.when(F.size(values) > 0, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>"))


def located(values: Column, between: Column, around: int) -> Column:
    """array<struct<start, end, value, left, right>>: matches with ``around`` code points on either side.

    Left and right end at the neighbouring match.
    """
    cut = F.transform(
        values,
        lambda v, i: F.struct(
            F.length(F.get(between, i)).alias("gap"),
            v.alias("value"),
            F.right(F.get(between, i), F.lit(around)).alias("left"),
            F.left(F.get(between, i + 1), F.lit(around)).alias("right"),
        ),
    )
    return _numbered(cut)


def _numbered(items: Column) -> Column:
    """Running offsets over (gap, value, left, right), block by block."""
    kind = "array<struct<start: int, end: int, value: string, left: string, right: string>>"
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(items, b * _BLOCK + 1, _BLOCK),
    )
    sums = F.transform(
        blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x["gap"] + F.length(x["value"]))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("bases"))
    bases = F.aggregate(
        sums,
        start,
        lambda a, s: F.struct((a["at"] + s).alias("at"), F.concat(a["bases"], F.array(a["at"])).alias("bases")),
        lambda a: a["bases"],
    )

    def step(a: Column, x: Column) -> Column:
        first = a["at"] + x["gap"]
        last = first + F.length(x["value"])
        row = F.struct(first.alias("start"), last.alias("end"), x["value"], x["left"], x["right"])
        return F.struct(last.alias("at"), F.concat(a["out"], F.array(row)).alias("out"))

    placed = F.zip_with(
        blocks,
        bases,
        lambda b, base: F.aggregate(
            b,
            F.struct(base.alias("at"), F.array().cast(kind).alias("out")),
            step,
            lambda a: a["out"],
        ),
    )
    return F.when(F.size(items) > 0, F.flatten(placed)).otherwise(F.array().cast(kind))
