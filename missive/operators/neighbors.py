"""Exact nearest neighbours.

``nearest`` answers one query vector with a scan and a top-k.  ``knn_join`` answers a table of queries without
pairing every query with every row (the pivot scheme of Lu et al., "Efficient Processing of k Nearest Neighbor
Joins using MapReduce", 2012):

1. The collection is divided into cells around pivots; per cell the row count, the radii and the k smallest
   distances to the pivot are kept.
2. From these each query gets an upper bound on its k-th distance, and is sent only to the cells which the
   triangle inequality cannot rule out.
3. Small cells that lie side by side form groups, and a query goes to a group once: where little can be ruled out, it
   is copied once for each block, not once for each cell.  Crowded cells are cut into blocks of bounded
   size, and so are the queries of a group.  A task multiplies its two blocks and emits k rows per query.
4. The partial lists are merged with a top-k per query.

Pruning only saves work: the result equals the brute-force one.  Vectors are centred first, and what pruning and
matrix products are allowed to be wrong by follows from the vectors' norms, so vectors far from the origin are as
exact as others.  One plan serves every size; the number of cells grows with the square root of the collection.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql import Window as W

from ..functions.text import hash_key

METRICS = ("l2", "cosine")

# Rows of a batch that are compared with all pivots or block rows at a time.
ROWS_AT_A_TIME = 512
# Distances that a task holds at a time.
PAIRS_AT_A_TIME = 1 << 21
# Neighbouring distances of which the least stands for all when the k-th one is bounded.
STRIP = 64
# Rows of a block, an eighth of the collection within these limits.  Small cells are joined to groups of at most as many.
BLOCK_ROWS = (1 << 12, 1 << 15)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances between the rows of a and b by one matrix product."""
    cross = a @ b.T
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * cross, 0.0)


def _rounding(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What ``_squared`` may be wrong by, for each row of a; a larger value only visits and rechecks more."""
    norms = (a * a).sum(1) + (b * b).sum(1).max(initial=0.0)
    return 8.0 * (a.shape[1] + 8) * np.finfo(np.float64).eps * norms


def _pair_distance(q: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """Row-wise distances; q is one vector or one per row.  Equal vectors give equal results wherever they stand."""
    if metric == "l2":
        diff = rows - q
        return (diff * diff).sum(1)
    norms = np.sqrt((rows * rows).sum(1)) * np.sqrt((q * q).sum(-1))
    return 1.0 - np.divide((rows * q).sum(1), norms, out=np.zeros(len(rows)), where=norms > 0)


def _pair_distances(
    q: np.ndarray, x: np.ndarray, row: np.ndarray, column: np.ndarray, metric: str, step: int = 16384
) -> np.ndarray:
    """Distances of the pairs (q[row], x[column]), a slice of pairs at a time."""
    out = np.empty(len(row))
    for start in range(0, len(row), step):
        part = slice(start, start + step)
        out[part] = _pair_distance(q[row[part]], x[column[part]], metric)
    return out


def _search_form(vectors: np.ndarray, metric: str, side: int, centre: np.ndarray | float = 0.0) -> np.ndarray:
    """Vectors whose Euclidean order is the metric's order.

    For l2 they are moved by ``centre``, so that their norms are of the size of their distances.  For cosine these are unit vectors.  A zero vector has distance 1 to everything: it becomes a unit vector on
    an axis of its own, one axis for queries and another for the collection.
    """
    if metric == "l2":
        return vectors - centre
    norms = np.sqrt((vectors * vectors).sum(1))
    zero = norms == 0
    unit = vectors / np.where(zero, 1.0, norms)[:, None]
    extra = np.zeros((len(vectors), 2))
    extra[zero, side] = 1.0
    return np.hstack([unit, extra])


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    """String columns as objects: Arrow-backed ones come in chunks after a concatenation, which can't be sent."""
    return frame.astype({c: object for c in frame.columns if isinstance(frame[c].dtype, pd.StringDtype)})


def _top(block: pd.DataFrame, k: int) -> pd.DataFrame:
    return block.sort_values(["distance", "id"], kind="stable").head(k)


def nearest(
    collection: DataFrame,
    vector,
    n_results: int = 5,
    metric: str = "l2",
    id_col: str = "id",
    vec_col: str = "embedding",
) -> DataFrame:
    """The ``n_results`` rows closest to one vector, nearest first, ties to the smaller id.

    Each task reduces every Arrow batch to its own best rows; the driver-side merge sees only those.
    """
    _check_metric(metric)
    query = np.asarray(vector, dtype=np.float64)
    schema = t.StructType([collection.schema[id_col], t.StructField("distance", t.DoubleType())])

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = pd.DataFrame(
                    {"id": batch[id_col], "distance": _pair_distance(query, _matrix(batch[vec_col]), metric)}
                )
                yield _plain(_top(found, n_results)).rename(columns={"id": id_col})

    ranked = collection.select(id_col, vec_col).mapInPandas(best, schema).orderBy("distance", id_col).limit(n_results)
    # n_results rows on the broadcast side
    return collection.join(F.broadcast(ranked), id_col).orderBy("distance", id_col)


def _match(asked: pd.DataFrame, offered: pd.DataFrame, k: int, metric: str) -> pd.DataFrame:
    """(query_id, id, distance): the k nearest of the offered rows for each asking row.

    A matrix product finds the rows near the k-th distance; their distances are then computed pair by pair.
    """
    q, x = _matrix(asked["vec"]), _matrix(offered["vec"])
    ids, query_ids = offered["id"].to_numpy(), asked["query_id"].to_numpy()
    centre = x.mean(0)
    qs, xs = _search_form(q, metric, 1, centre), _search_form(x, metric, 0, centre)
    kth = min(k, len(x)) - 1
    parts = []
    step = max(1, min(ROWS_AT_A_TIME, PAIRS_AT_A_TIME // len(x)))
    doubled, squares = -2.0 * xs.T, (xs * xs).sum(1)
    whole = len(x) // STRIP * STRIP
    for start in range(0, len(q), step):
        some = qs[start : start + step]
        rough = some @ doubled  # squared distances less the query's own norm, which is the same along a row
        rough += squares
        least = rough[:, :whole].reshape(len(some), -1, STRIP).min(2)
        # k strips hold k different rows, so the k-th of their least distances is no less than the k-th distance
        edge = np.partition(np.hstack([least, rough[:, whole:]]), kth, axis=1)[:, kth] if least.shape[1] > kth else (
            np.partition(rough, kth, axis=1)[:, kth]
        )
        row, column = np.nonzero(rough <= (edge + 2 * _rounding(some, xs))[:, None])
        row = row + start
        distance = _pair_distances(q, x, row, column, metric)
        found = pd.DataFrame({"query": row, "id": ids[column], "distance": distance})
        found = found.sort_values(["query", "distance", "id"], kind="stable")
        parts.append(found.groupby("query", sort=False).head(k))
    best = pd.concat(parts, ignore_index=True)
    best.insert(0, "query_id", query_ids[best["query"].to_numpy()])
    return _plain(best[["query_id", "id", "distance"]])


def _groups(sizes: list[int], most: int) -> np.ndarray:
    """The group of each cell: neighbours in the given order are joined while they hold ``most`` rows together."""
    group, held, out = -1, most, []
    for size in sizes:
        if held + size > most:
            group, held = group + 1, 0
        held += size
        out.append(group)
    return np.array(out, dtype=np.int32)


def _check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"Unknown metric: {metric}. Expected one of {METRICS}.")


def knn_join(
    queries: DataFrame,
    collection: DataFrame,
    k: int = 5,
    metric: str = "l2",
    query_id: str = "query_id",
    id_col: str = "id",
    vec_col: str = "embedding",
    block_rows: int | None = None,
) -> DataFrame:
    """(query_id, id, distance, rank): the k nearest collection rows of every query, ties to the smaller id.

    ``l2`` reports squared Euclidean distance.  The driver holds the pivots, the square root of the collection's rows
    in number, and k distances for each.
    """
    _check_metric(metric)
    items = collection.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    asks = queries.select(F.col(query_id).alias("query_id"), F.col(vec_col).alias("vec"))
    id_type, query_type = items.schema["id"].dataType, asks.schema["query_id"].dataType
    result_schema = t.StructType(
        [
            t.StructField("query_id", query_type),
            t.StructField("id", id_type),
            t.StructField("distance", t.DoubleType()),
        ]
    )

    best = W.partitionBy("query_id").orderBy("distance", "id")

    def merged(partial: DataFrame) -> DataFrame:
        return partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    n_items = items.count()
    if not n_items:
        return merged(queries.sparkSession.createDataFrame([], result_schema))
    if block_rows is None:
        block_rows = min(max(n_items // 8, BLOCK_ROWS[0]), BLOCK_ROWS[1])
    wanted = math.isqrt(n_items - 1) + 1
    picked = items.orderBy(hash_key(F.col("id"), 0), "id").limit(wanted).select("vec").collect()
    chosen = _matrix(pd.Series([r.vec for r in picked]))
    centre = chosen.mean(0)
    pivots = np.unique(_search_form(chosen, metric, 0, centre), axis=0)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d = np.sqrt(_squared(_search_form(_matrix(batch["vec"]), metric, 0, centre), pivots))
                cell = d.argmin(1)
                yield _plain(batch).assign(cell=cell.astype(np.int32), to_pivot=d[np.arange(len(batch)), cell])

    placed = items.mapInPandas(
        place,
        t.StructType(
            items.schema.fields
            + [t.StructField("cell", t.IntegerType()), t.StructField("to_pivot", t.DoubleType())]
        ),
    )

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cell, d in batch.groupby("cell")["to_pivot"]:
                close = np.sort(d.to_numpy())[:k]
                yield pd.DataFrame({"cell": [cell], "n": [len(d)], "near": d.min(), "far": d.max(), "close": [close]})

    # one pass: every batch becomes one short row per cell, and these merge into one row per pivot
    summary = (
        placed.select("cell", "to_pivot")
        .mapInPandas(summarise, "cell int, n long, near double, far double, close array<double>")
        .groupBy("cell")
        .agg(
            F.sum("n").alias("n"),
            F.min("near").alias("near"),
            F.max("far").alias("far"),
            F.slice(F.array_sort(F.flatten(F.collect_list("close"))), 1, k).alias("close"),
        )
        .orderBy("cell")
        .collect()
    )
    cells = np.array([r.cell for r in summary])
    near, far = np.array([r.near for r in summary]), np.array([r.far for r in summary])
    known = [np.array(r.close) for r in summary]
    home = pivots[cells]
    # the rounding of the items' own distances: none is farther from the centre than its pivot and its radius
    reach_of_items = (np.sqrt((home * home).sum(1)) + far).max() ** 2
    farthest = 8.0 * (pivots.shape[1] + 8) * np.finfo(np.float64).eps * 2 * reach_of_items

    group = _groups([r.n for r in summary], block_rows)
    first = np.flatnonzero(np.diff(group, prepend=-1))
    group_of = np.zeros(len(pivots), dtype=np.int32)
    group_of[cells] = group

    def reached(vectors: pd.Series) -> np.ndarray:
        """For each query and group, whether any cell of the group may hold one of the nearest rows."""
        form = _search_form(_matrix(vectors), metric, 1, centre)
        d = np.sqrt(_squared(form, home))
        bounds = np.hstack([d[:, [j]] + known[j][None, :] for j in range(len(cells))])
        kth = min(k, bounds.shape[1]) - 1
        reach = np.partition(bounds, kth, axis=1)[:, kth]
        floor = np.maximum(np.maximum(d - far[None, :], near[None, :] - d), 0.0)
        # three distances and the radii are each wrong by the root of the rounding at most
        slack = 4 * np.sqrt(_rounding(form, home) + farthest)
        return np.logical_or.reduceat(floor <= (reach + slack)[:, None], first, axis=1)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), ROWS_AT_A_TIME):
                found = reached(batch["vec"].iloc[start : start + ROWS_AT_A_TIME]).sum(0)
                yield pd.DataFrame({"cell": np.arange(len(found), dtype=np.int32), "n": found})

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), ROWS_AT_A_TIME):
                some = _plain(batch.iloc[start : start + ROWS_AT_A_TIME])
                for number, asking in enumerate(reached(some["vec"]).T):
                    if asking.any():
                        yield some[asking].assign(cell=np.int32(number))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in place(batches):
            yield batch.assign(cell=group_of[batch["cell"].to_numpy()])

    cell_field = t.StructField("cell", t.IntegerType())
    routed = asks.mapInPandas(route, t.StructType(asks.schema.fields + [cell_field]))
    gathered = items.mapInPandas(gather, placed.schema)
    counted = asks.select("vec").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    visits = {r.cell: r.n for r in counted.collect()}  # one row per group
    rows_of = np.add.reduceat([r.n for r in summary], first)
    blocks = [
        (at, -(-int(n) // block_rows), max(1, -(-visits.get(at, 0) // block_rows))) for at, n in enumerate(rows_of)
    ]
    plan = F.broadcast(  # one row per group
        queries.sparkSession.createDataFrame(blocks, "cell int, item_blocks long, query_blocks long")
    )

    def block_of(column: str, count: str):
        return F.pmod(F.xxhash64(column), F.col(count))

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))

    left = (
        routed.join(plan, "cell")
        .withColumn("query_block", block_of("query_id", "query_blocks"))
        .withColumn("item_block", every("item_blocks"))
        .select("cell", "item_block", "query_block", "query_id", "vec")
    )
    right = (
        gathered.join(plan, "cell")
        .withColumn("item_block", block_of("id", "item_blocks"))
        .withColumn("query_block", every("query_blocks"))
        .select("cell", "item_block", "query_block", "id", "vec")
    )

    def match(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(offered):
            # typed by the inputs: an untyped empty column can't be sent as a string
            none = np.empty(0)
            return pd.DataFrame({"query_id": asked["query_id"].iloc[:0], "id": offered["id"].iloc[:0], "distance": none})
        return _match(asked, offered, k, metric)

    keys = ["cell", "item_block", "query_block"]
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(match, result_schema)
    return merged(partial)
