"""Exact top-k search by inner product: a Voronoi join of queries and rows.

Vectors are whole numbers, floor(scale * x).  Queries and rows are grouped by their nearest pivot.  Each cell of rows is
summarised by the k + 1 rows nearest to its pivot, each cell of queries by its radius u and largest norm N.  For a query
q of cell i and a row o of cell j, at a distance r from its pivot,

    p_i.p_j - u |p_j| - N r  <=  q.o  <=  p_i.p_j + u |p_j| + N r

The k + 1 greatest of the left sides bound the k-th score of the whole cell i from below; a row goes to cell i only if its
right side reaches that bound.  Cells of queries near to each other share one copy of the rows.  A group of queries and
what it needs are cut into blocks on both sides, each solved in one task, and the best of the blocks are the result.

Of rows with equal vectors only the k + 1 smallest ids can be in any answer, so copies are reduced to them first.  Where
the bounds exclude nothing, as for vectors without clusters in many dimensions, every group of queries meets all rows.

Defined results: vectors that are null or hold a null or a number that isn't finite take no part, nor do rows without an
id; a shorter vector is filled up with zeros; rows equal in id and vector are one row; equal scores go by id.  Components
so large that a score could exceed 63 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import in_parts, saved, shuffle_width

SCALE, K = 256, 5
#: Pivots at most: with the dimension they bound what the driver holds.  Queries and rows of one task.
PIVOTS, QUERIES, ROWS = 1_024, 1_024, 8_192

#: The narrowest type that holds the components.
_KINDS = (("smallint", 1 << 15), ("int", 1 << 31), ("bigint", 1 << 63))


def whole(rows: DataFrame, id_col: str, vector_col: str, scale: float = SCALE) -> DataFrame:
    """(id, v): the vectors that take part, as whole numbers."""
    vector = F.col(vector_col)

    def unfit(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == inf)

    fit = rows.where(F.col(id_col).isNotNull() & vector.isNotNull()).where(~F.exists(vector, unfit))
    return fit.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"),
    )


def matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """The vectors of a list column, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), kind)
    at = np.repeat(np.arange(len(sizes)), sizes)
    out[at, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


class Pivots:
    def __init__(self, points: np.ndarray):
        self.points = points
        self.norms = np.sqrt((points**2).sum(1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cell of each vector, its distance from the pivot and its norm, both rounded up."""
        norms = np.sqrt((x**2).sum(1))
        squares = norms[:, None] ** 2 - 2 * (x @ self.points.T) + self.norms**2
        cells = squares.argmin(1)
        r = np.sqrt(np.maximum(squares[np.arange(len(x)), cells], 0))
        return cells, r + 1e-5 * (norms + self.norms[cells] + 1), norms * (1 + 1e-9)


def _in_cells(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """The rows (id, v) with their cell, distance r and norm."""
    width = pivots.points.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_parts(batch, 1):
                cells, r, norms = pivots.nearest(matrix(part.column(1), width))
                arrays = [*part.columns, pa.array(cells, pa.int32()), pa.array(r), pa.array(norms)]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "v", "cell", "r", "norm"])

    kind = rows.schema["v"].dataType.simpleString()
    return rows.mapInArrow(run, f"id bigint, v {kind}, cell int, r double, norm double")


class Plan:
    """Which cells of queries form a group, and from which distance on a group needs the rows of a cell."""

    def __init__(self, pivots: Pivots, queries: list, nearest: list, k: int, most: int):
        """queries: (cell, u, N, number) of each cell with queries; nearest: (cell, r) of the k + 1 nearest rows."""
        at = np.array([c for c, _ in nearest], np.int64)
        r = np.array([x for _, x in nearest])
        products = pivots.points @ pivots.points.T
        slack = 1e-9 * (1 + np.abs(products).max(initial=0))
        needs = {}
        for cell, u, norm, _ in queries:
            reach = products[cell] + u * pivots.norms + slack
            least = np.sort(products[cell, at] - u * pivots.norms[at] - norm * r - slack)[::-1]
            bound = least[k] if len(least) > k else -inf
            needs[cell] = (bound - reach) / norm if norm else np.full(len(reach), -inf)
        self.groups: list[list[int]] = []
        self.slices: list[int] = []
        sizes = {cell: number for cell, _, _, number in queries}
        left, size = sorted(sizes), 0
        last = None
        while left:  # each next cell is the one nearest to the last
            last = left[0] if last is None else max(left, key=lambda c: 2 * products[last, c] - products[c, c])
            left.remove(last)
            if not self.groups or size + sizes[last] > most:
                self.groups.append([])
                size = 0
            self.groups[-1].append(last)
            size += sizes[last]
        self.slices = [-(-sum(sizes[c] for c in cells) // most) for cells in self.groups]
        self.of_cell = {c: g for g, cells in enumerate(self.groups) for c in cells}
        self.least = np.array([np.min([needs[c] for c in cells], 0) for cells in self.groups])

    def needed(self, group: int, cells: np.ndarray, r: np.ndarray) -> np.ndarray:
        return r >= self.least[group, cells]


def _needs(rows: DataFrame, plan: Plan) -> dict[int, int]:
    """The rows that each group needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(plan.groups), np.int64)
        for batch in batches:
            cells, r = (c.to_numpy() for c in batch.columns)
            found += [int(plan.needed(g, cells, r).sum()) for g in range(len(found))]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int32()), pa.array(found)], ["grp", "n"])

    counts = rows.select("cell", "r").mapInArrow(run, "grp int, n bigint").groupBy("grp").agg(F.sum("n").alias("n"))
    return {g: n for g, n in counts.collect()}


def _dealt(rows: DataFrame, plan: Plan, blocks: list[int]) -> DataFrame:
    """The rows (id, v) once for each slice of each group that needs them, in one of its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_parts(batch, 1):
                cells, r, salt = (part.column(c).to_numpy() for c in ("cell", "r", "salt"))
                for g, parts in enumerate(plan.slices):
                    at = np.flatnonzero(plan.needed(g, cells, r))
                    if not len(at):
                        continue
                    own = part.select(["id", "v"]).take(pa.array(at))
                    block = pa.array((salt[at].view(np.uint64) % np.uint64(blocks[g])).astype(np.int32))
                    for k in range(parts):
                        keys = [pa.array(np.full(len(at), x, np.int32)) for x in (g, k)]
                        yield pa.RecordBatch.from_arrays([*keys, block, *own.columns], ["grp", "slice", "block", "id", "v"])

    kind = rows.schema["v"].dataType.simpleString()
    salted = rows.withColumn("salt", F.xxhash64("id", "v"))
    return salted.mapInArrow(run, f"grp int, slice int, block int, id bigint, v {kind}")


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the k greatest of ``scores``; ``ids`` ascend, so of equal ones the first."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:k]


def _solved(width: int, kind, k: int):
    """The k best rows of a block for each query of a slice."""

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, x = rows["id"].to_numpy(), matrix(rows["v"], width, kind)
        numbers, own, y = asked["q"].to_numpy(), asked["id"].to_numpy(), matrix(asked["v"], width, kind)
        found = []
        for start in range(0, len(own), 128):
            scores = y[start : start + 128] @ x.T
            for i, line in enumerate(scores, start):
                first, last = np.searchsorted(ids, own[i]), np.searchsorted(ids, own[i], "right")
                same = [j for j in range(first, last) if (x[j] == y[i]).all()]
                at = np.delete(np.arange(len(ids)), same) if same else slice(None)
                line, names = line[at], ids[at]
                found += [(numbers[i], own[i], names[j], int(line[j])) for j in best(names, line, k)]
        columns = list(zip(*found)) if found else [[]] * 4
        names = ["q", "query_id", "vec_id", "score"]
        return pa.table([pa.array(np.array(c, np.int64)) for c in columns], names)

    return run


def search(
    table: DataFrame,
    asked,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: float = SCALE,
    pivots: int = PIVOTS,
    queries: int = QUERIES,
    rows: int = ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the greatest inner products for each row with ``asked``.

    ``asked`` is a condition on ``id``.  A query's own row is no answer.  ``queries`` and ``rows`` bound what a task
    compares, ``pivots`` the cells; none of them changes the result.
    """
    taken = whole(table, id_col, vector_col, scale)
    size = F.max(F.array_max(F.transform("v", F.abs)))
    top, width = taken.agg(size, F.max(F.size("v"))).first()
    top, width = top or 0, width or 0
    if top * top * max(1, width) >= 1 << 63:
        raise ValueError("The scores of these vectors exceed 63 bits")
    narrow = next(name for name, most in _KINDS if top < most)
    exact = np.float64 if top * top * max(1, width) < 1 << 53 else np.int64
    every = saved(taken.select("id", F.col("v").cast(f"array<{narrow}>").alias("v")).distinct(), "vectors")
    first = F.row_number().over(W.partitionBy("v").orderBy("id"))
    reduced = every.withColumn("copy", first).where(F.col("copy") <= k + 1).drop("copy")
    reduced = saved(reduced, "reduced")
    number = min(pivots, int(np.ceil(np.sqrt(reduced.count()))))
    points = reduced.orderBy(F.xxhash64("v", "id"), "id").select("v").limit(number).toArrow()
    if not points.num_rows:
        return _ranked(every.select(*[F.col("id").alias(c) for c in ("q", "query_id", "vec_id", "score")]), k)
    cells = Pivots(matrix(points["v"], width))
    data = saved(_in_cells(reduced, cells), "rows")
    wanted = saved(_in_cells(every.where(asked), cells), "queries")
    of_cell = wanted.groupBy("cell").agg(F.max("r"), F.max("norm"), F.count("*")).collect()
    near = F.row_number().over(W.partitionBy("cell").orderBy("r"))
    near = data.select("cell", "r").withColumn("place", near).where(F.col("place") <= k + 1)
    plan = Plan(cells, of_cell, near.select("cell", "r").collect(), k, queries)
    if not plan.groups:
        return _ranked(wanted.select(*[F.col("id").alias(c) for c in ("q", "query_id", "vec_id", "score")]), k)
    needs = _needs(data, plan)
    blocks = [max(1, -(-needs.get(g, 0) // rows)) for g in range(len(plan.groups))]
    dealt = _dealt(data, plan, blocks)
    spread = _spread(wanted.withColumn("q", F.monotonically_increasing_id()), plan, blocks)
    keys = ["grp", "slice", "block"]
    run = _solved(width, exact, k)
    both = spread.groupBy(*keys).cogroup(dealt.groupBy(*keys))
    return _ranked(both.applyInArrow(run, "q bigint, query_id bigint, vec_id bigint, score bigint"), k)


def _spread(wanted: DataFrame, plan: Plan, blocks: list[int]) -> DataFrame:
    """The queries (q, id, v) in their slice, once for each block of their group."""
    rows = [(c, g, plan.slices[g], blocks[g]) for c, g in plan.of_cell.items()]
    where = wanted.sparkSession.createDataFrame(rows, "cell int, grp int, slices int, blocks int")
    placed = wanted.join(F.broadcast(where), "cell")  # a row for each cell
    return placed.select(
        "grp",
        F.pmod(F.xxhash64("q"), F.col("slices")).cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        "q",
        "id",
        "v",
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
