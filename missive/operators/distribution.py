"""Exact order statistics and running totals without an unbounded single-task sort.

The input is first folded to one row per distinct value and materialised, so the rows behind it are read once.
The axis is cut into ranges at approximate quantiles of the distinct values; the totals per range (a few hundred rows)
give every range its starting offset, and the running sum inside a range is a window partitioned by range.  The cut
points only balance the work; the results do not depend on them.  There is one path for every size, and null groups
are groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import checkpoint, shuffle_width


def running_totals(
    points: DataFrame,
    value: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<c>`` (running total including this point) and ``total_<c>`` for every column in ``sums``.

    ``points`` holds one row per (by, value), so a hot value is one row.  Rows with a null value are left out.
    """
    by = list(by)
    points = checkpoint(points.where(F.col(value).isNotNull()))
    ranges = max(shuffle_width(points), 2)
    steps = [i / ranges for i in range(1, ranges)]
    found = points.agg(F.percentile_approx(value, steps, 100 * ranges).alias("cuts")).first().cuts

    groups = [F.col(c) for c in by] or [F.lit(0)]
    step = F.desc if descending else F.asc
    up_to_here = (W.unboundedPreceding, W.currentRow)
    cuts = sorted(set(found or ()))
    place = F.size(F.filter(F.lit(cuts), lambda cut: cut < F.col(value))) if cuts else F.lit(0)
    placed = points.withColumn("_range", place)
    per_range = placed.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_in_{c}") for c in sums])
    # at most `ranges` rows per group reach these two windows
    whole = W.partitionBy(*groups)
    before = whole.orderBy(step("_range")).rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        *[F.col(c).alias(f"_of_{c}") for c in by],
        F.col("_range").alias("_at"),
        *[F.coalesce(F.sum(f"_in_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.sum(f"_in_{c}").over(whole).alias(f"total_{c}") for c in sums],
    )
    inside = W.partitionBy(*by, "_range").orderBy(step(value)).rowsBetween(*up_to_here)
    same = F.col("_range") == F.col("_at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    joined = placed.join(offsets, same)
    for c in sums:
        joined = joined.withColumn(f"cum_{c}", F.sum(c).over(inside) + F.col(f"_before_{c}"))
    return joined.drop("_range", "_at", *[f"_of_{c}" for c in by], *[f"_before_{c}" for c in sums])


def _interpolated(q: float, value: str, cum: str, total: str):
    """Linear interpolation between the two order statistics around position q · (n - 1)."""
    position = F.lit(q) * (F.col(total) - 1)
    low = F.min(F.when(F.col(cum) > F.floor(position), F.col(value))).cast("double")
    high = F.min(F.when(F.col(cum) > F.ceil(position), F.col(value))).cast("double")
    part = F.max(position - F.floor(position))
    return low + (high - low) * part


def percentiles_from_totals(
    totals: DataFrame, value: str, wanted: Mapping[str, tuple[str, float]], by: Sequence[str] = ()
) -> DataFrame:
    """Percentiles read off ``running_totals``: result column → (counted column, quantile)."""
    aggs = [
        _interpolated(q, value, f"cum_{c}", f"total_{c}").alias(name) for name, (c, q) in wanted.items()
    ]
    return totals.groupBy(*by).agg(*aggs)


def percentiles(
    df: DataFrame,
    value: str,
    wanted: Mapping[str, float],
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Exact percentiles with linear interpolation; ``weight`` is a row multiplicity."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    points = df.groupBy(*by, value).agg(n.alias("_n"))
    totals = running_totals(points, value, ["_n"], by=by)
    return percentiles_from_totals(totals, value, {name: ("_n", q) for name, q in wanted.items()}, by)
