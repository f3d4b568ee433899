"""Validation, deduplication and description of a labelled message table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as T
from ..functions.scoring import LABEL_CODES
from ..session import checkpoint, shuffle_width
from .distribution import percentiles

VALID_LABELS = tuple(LABEL_CODES)


def _digest(column: str) -> Column:
    """A 32-byte stand-in for a text as a grouping key: it moves 32 bytes instead of the text."""
    return F.unhex(F.sha2(F.col(column), 256))


def drop_missing(df: DataFrame, columns: Sequence[str] = ("message", "label")) -> DataFrame:
    return df.na.drop(subset=list(columns))


def deduplicate(
    df: DataFrame, key: str = "message", id_col: str = "msg_id", colocate: bool = False
) -> DataFrame:
    """Keep the row with the smallest id of every distinct ``key``; the other columns are not in the key.

    Only (digest, id) pairs are shuffled for the grouping, and partial aggregation folds a hot text into one pair
    per task before the shuffle.  The surviving ids then select the rows through a semi join on the unique id.
    ``colocate`` partitions the rows by id, which a join that shuffles needs anyway and later steps can build on.
    """
    kept = df.groupBy(_digest(key).alias("_digest")).agg(F.min(id_col).alias(id_col)).select(id_col)
    rows = df.repartition(shuffle_width(df), id_col) if colocate else df
    return rows.join(kept, id_col, "left_semi")


def invalid_labels(df: DataFrame, valid: Sequence[str] = VALID_LABELS, label_col: str = "label") -> DataFrame:
    """The distinct labels outside the closed set."""
    return df.where(~F.col(label_col).isin(*valid)).select(label_col).distinct()


def check_labels(df: DataFrame, valid: Sequence[str] = VALID_LABELS, label_col: str = "label") -> None:
    """Raise with the list of all unknown labels."""
    bad = [row[0] for row in invalid_labels(df, valid, label_col).orderBy(label_col).collect()]
    if bad:
        raise ValueError(f"Invalid labels found: {bad}. Expected one of {list(valid)}.")


def validate(
    df: DataFrame, id_col: str = "msg_id", strict: bool = False, colocate: bool = False
) -> DataFrame:
    """Drop rows without message or label, then repeated messages; ``strict`` also checks the label set."""
    rows = drop_missing(df).withColumn("message", F.col("message").cast("string"))
    rows = deduplicate(rows, "message", id_col, colocate)
    if strict:
        check_labels(rows)
    return rows


def clean_messages(df: DataFrame, text_col: str = "message", out_col: str = "message_clean") -> DataFrame:
    """Add the cleaned text and drop rows left without any.  Narrow: no shuffle."""
    cleaned = df.withColumn(out_col, T.clean_text(F.col(text_col).cast("string")))
    return cleaned.where(F.col(out_col) != "")


def drop_report(df: DataFrame) -> DataFrame:
    """Rows in, dropped as missing, dropped as repeated, dropped as empty after cleaning, rows left."""
    missing = F.col("message").isNull() | F.col("label").isNull()
    # equal messages clean to equal texts, so one flag per distinct message is enough
    groups = df.groupBy(F.when(~missing, _digest("message")).alias("_digest")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(~missing, (T.clean_text(F.col("message")) == "").cast("int"))).alias("empty"),
    )
    present = F.col("_digest").isNotNull()
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("dropped_missing"),
        F.coalesce(F.sum(F.when(present, F.col("n") - 1)), F.lit(0)).alias("dropped_duplicate"),
        F.coalesce(F.sum(F.when(present, F.col("empty").cast("bigint"))), F.lit(0)).alias("dropped_empty"),
        F.count_if(present & (F.col("empty") == 0)).alias("n_left"),
    )


def class_balance(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows per class, their share in per cent, and the row and column count of the table."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    # one row per label reaches the window
    total = F.sum("n").over(W.partitionBy(F.lit(0)))
    return counts.select(
        label_col,
        "n",
        (F.col("n") / total * 100).alias("pct"),
        total.alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
    )


def imbalance(df: DataFrame, label_col: str = "label") -> DataFrame:
    """ham : spam, null unless both occur."""
    ham = F.count_if(F.col(label_col) == "ham")
    spam = F.count_if(F.col(label_col) == "spam")
    return df.agg(ham.alias("ham"), spam.alias("spam")).withColumn(
        "ratio", F.when(F.col("ham") > 0, F.try_divide(F.col("ham").cast("double"), F.col("spam").cast("double")))
    )


def text_lengths(df: DataFrame, text_col: str = "message", id_col: str = "msg_id") -> DataFrame:
    return df.select(
        id_col,
        T.char_count(F.col(text_col)).cast("bigint").alias("char_count"),
        T.word_count(F.col(text_col)).cast("bigint").alias("word_count"),
    )


def length_stats(df: DataFrame, text_col: str = "message", by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample standard deviation, median and maximum of characters and words, overall or per group.

    The medians are exact and come from counts per distinct length, not from a sort of the rows.
    """
    by = list(by)
    counted = df.select(
        *by,
        T.char_count(F.col(text_col)).alias("char_count"),
        T.word_count(F.col(text_col)).alias("word_count"),
    )
    # one row per distinct pair of lengths carries everything the statistics need
    pairs = checkpoint(counted.groupBy(*by, "char_count", "word_count").agg(F.count(F.lit(1)).alias("n")))
    aggs = []
    for unit in ("char", "word"):
        value = F.col(f"{unit}_count").cast("double")
        n, s, q = F.sum("n"), F.sum(value * F.col("n")), F.sum(value * value * F.col("n"))
        spread = F.try_divide(F.greatest(q - s * s / n, F.lit(0.0)), (n - 1).cast("double"))
        aggs += [
            (s / n).alias(f"{unit}_mean"),
            F.sqrt(spread).alias(f"{unit}_std"),
            F.max(f"{unit}_count").cast("bigint").alias(f"{unit}_max"),
        ]
    stats = pairs.groupBy(*by).agg(*aggs)
    for unit in ("char", "word"):
        median = percentiles(pairs, f"{unit}_count", {f"{unit}_median": 0.5}, by=by, weight="n")
        if by:
            keys = {c: f"_of_{c}" for c in by}
            same = [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]
            stats = stats.join(median.withColumnsRenamed(keys), same).drop(*keys.values())
        else:
            stats = stats.withColumn(f"{unit}_median", median.scalar())
    order = [f"{unit}_{stat}" for unit in ("char", "word") for stat in ("mean", "std", "median", "max")]
    return stats.select(*by, *order)


def clean_examples(df: DataFrame, n: int = 3, id_col: str = "msg_id") -> DataFrame:
    """The first ``n`` messages before and after cleaning, 100 characters of each."""
    return (
        df.orderBy(id_col)
        .limit(n)
        .select(
            id_col,
            F.substring("message", 1, 100).alias("original"),
            F.substring("message_clean", 1, 100).alias("cleaned"),
        )
    )
