"""Reproducible stratified splits, folds and samples.

Every choice is a function of (seed, id), so it does not change with partitioning or with the run.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scoring import LABEL_CODES
from ..functions.text import hash_key

SEED = 42
TEST_SIZE = 0.2


def _keyed(df: DataFrame, id_col: str, y_col: str, seed: int) -> DataFrame:
    """(id, class, sort key, bucket): 65,536 buckets of the sort key per class, uniform by construction."""
    keyed = df.select(id_col, y_col, hash_key(F.col(id_col), seed).alias("_key"))
    return keyed.withColumn("_bucket", F.substring("_key", 1, 4))


def _bucket_offsets(keyed: DataFrame, y_col: str) -> DataFrame:
    """Rows of the class before each bucket, and in it."""
    sizes = keyed.groupBy(y_col, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    # at most 65,536 rows per class reach this window
    before = W.partitionBy(y_col).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))


def stratified_rank(df: DataFrame, id_col: str = "msg_id", y_col: str = "y", seed: int = SEED) -> DataFrame:
    """(id, class, rank): position 1..n_c of every row in its class's seeded order.

    The rows are sorted inside (class, bucket), never inside a whole class.
    """
    keyed = _keyed(df, id_col, y_col, seed)
    inside = W.partitionBy(y_col, "_bucket").orderBy("_key", id_col)
    return (
        keyed.join(_bucket_offsets(keyed, y_col), [y_col, "_bucket"])
        .withColumn("rank", (F.row_number().over(inside) + F.col("_before")).cast("bigint"))
        .select(id_col, y_col, "rank")
    )


def test_quotas(df: DataFrame, test_size: float = TEST_SIZE, y_col: str = "y") -> DataFrame:
    """(class, n, quota): ceil(test_size · n) test rows, shared out by largest remainder, ties to the lower class."""
    counts = df.groupBy(y_col).agg(F.count(F.lit(1)).alias("n"))
    # one row per class reaches these windows
    everything = W.partitionBy(F.lit(0))
    total = F.sum("n").over(everything)
    wanted = F.ceil(F.lit(test_size) * total)
    shared = counts.withColumn("_exact", F.col("n") * wanted / total).withColumn("_wanted", wanted)
    shared = shared.withColumn("_base", F.floor("_exact"))
    spare = F.col("_wanted") - F.sum("_base").over(everything)
    order = everything.orderBy(F.desc(F.col("_exact") - F.col("_base")), F.asc(y_col))
    return shared.select(
        y_col, "n", (F.col("_base") + (F.row_number().over(order) <= spare).cast("bigint")).alias("quota")
    )


test_quotas.__test__ = False


def split_exact(
    df: DataFrame,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    id_col: str = "msg_id",
    y_col: str = "y",
) -> DataFrame:
    """Add ``split`` with exactly ceil(test_size · n) test rows and the class shares kept.

    Per class only the bucket holding the last test row is sorted (1/65,536 of the class); its key becomes the
    class's cutoff, and the assignment is then a comparison per row, without a shuffle of the table.  A class that is
    unknown or null is an error.
    """
    strangers = df.where(~F.coalesce(F.col(y_col).isin(*LABEL_CODES.values()), F.lit(False)))
    if not strangers.isEmpty():
        raise ValueError(f"{y_col} has values other than {sorted(LABEL_CODES.values())}")
    keyed = _keyed(df, id_col, y_col, seed)
    edges = _bucket_offsets(keyed, y_col).join(F.broadcast(test_quotas(df, test_size, y_col)), y_col)
    edges = edges.where((F.col("_before") < F.col("quota")) & (F.col("quota") <= F.col("_before") + F.col("_size")))
    inside = W.partitionBy(y_col, "_bucket").orderBy("_key", id_col)
    cutoffs = (
        keyed.join(F.broadcast(edges), [y_col, "_bucket"])
        .withColumn("_rank", F.row_number().over(inside) + F.col("_before"))
        .where(F.col("_rank") == F.col("quota"))
        .select(y_col, F.struct(F.col("_key").alias("k"), F.col(id_col).alias("i")).alias("_cutoff"))
    )
    # quotas, edges and cutoffs hold one row per class, and there are len(LABEL_CODES) classes
    mine = F.struct(hash_key(F.col(id_col), seed).alias("k"), F.col(id_col).alias("i"))
    return (
        df.join(F.broadcast(cutoffs), y_col, "left")
        .withColumn("split", F.when(mine <= F.col("_cutoff"), F.lit("test")).otherwise(F.lit("train")))
        .drop("_cutoff")
    )


def split_hash(
    df: DataFrame, test_size: float = TEST_SIZE, seed: int = SEED, id_col: str = "msg_id"
) -> DataFrame:
    """Add ``split`` by a hash threshold: no shuffle at all, class shares kept in expectation."""
    # fixed-width lower-case hexadecimal compares like the number it writes
    edge = f"{min(math.ceil(test_size * 16**8), 16**8 - 1):08x}"
    is_test = F.substring(hash_key(F.col(id_col), seed), 1, 8) < edge
    return df.withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def split_report(df: DataFrame, y_col: str = "y") -> DataFrame:
    """Rows per split and class, the class's share of the split, and the split's share of the table."""
    counts = df.groupBy("split", y_col).agg(F.count(F.lit(1)).alias("n"))
    # one row per (split, class) reaches these windows
    in_split = F.sum("n").over(W.partitionBy("split"))
    total = F.sum("n").over(W.partitionBy(F.lit(0)))
    return counts.select(
        "split",
        y_col,
        "n",
        (F.col("n") / in_split * 100).alias("class_pct"),
        (in_split / total * 100).alias("split_pct"),
    )


def folds(df: DataFrame, k: int = 5, seed: int = SEED, id_col: str = "msg_id", y_col: str = "y") -> DataFrame:
    """(id, class, fold): stratified folds 0..k-1 whose sizes differ by at most one per class."""
    if k < 2:
        raise ValueError(f"Need at least two folds, got {k}")
    ranked = stratified_rank(df, id_col, y_col, seed)
    return ranked.select(id_col, y_col, ((F.col("rank") - 1) % k).cast("int").alias("fold"))


def sample_per_class(
    df: DataFrame, n: int = 5, seed: int = SEED, id_col: str = "msg_id", label_col: str = "label"
) -> DataFrame:
    """``n`` seeded random rows of every class.

    Only ids are sorted, and each task keeps its own first ``n`` per class before the shuffle, so neither the texts
    nor a class gather anywhere.
    """
    order = W.partitionBy(label_col).orderBy(hash_key(F.col(id_col), seed), id_col)
    ranked = df.select(id_col, label_col).withColumn("rank", F.row_number().over(order))
    picked = ranked.where(F.col("rank") <= n).select(id_col, "rank")
    return df.join(F.broadcast(picked), id_col)  # n rows per class of a closed label set


def class_weights(df: DataFrame, y_col: str = "y") -> DataFrame:
    """(class, n, weight) with weight = n / (k · n_c)."""
    counts = df.groupBy(y_col).agg(F.count(F.lit(1)).alias("n"))
    # one row per class reaches the window
    everything = W.partitionBy(F.lit(0))
    total, k = F.sum("n").over(everything), F.count(F.lit(1)).over(everything)
    return counts.select(y_col, "n", (total / (k * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, y_col: str = "y", out_col: str = "weight") -> DataFrame:
    weights = class_weights(df, y_col).select(y_col, F.col("weight").alias(out_col))
    return df.join(F.broadcast(weights), y_col)  # one row per class
