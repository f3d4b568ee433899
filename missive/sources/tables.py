"""Files at the seams between steps: features, embeddings, metrics, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from ..session import forgotten_later, shared_folder
from .messages import found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's shared folder, removed when the driver ends."""
    return forgotten_later(spark, f"{shared_folder(spark)}/missive/{name}-{uuid.uuid4().hex}")


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def load_csv(spark: SparkSession, path: str, schema: str | t.StructType) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
    return found(reader.csv, path)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def load_json(spark: SparkSession, path: str, schema: str | t.StructType) -> DataFrame:
    return found(spark.read.schema(schema).json, path)


def save_array(df: DataFrame, path: str, array_col: str = "embedding", id_col: str = "msg_id") -> None:
    """Dense vectors keyed by id."""
    df.select(id_col, array_col).write.mode("overwrite").parquet(path)


def load_array(spark: SparkSession, path: str) -> DataFrame:
    return found(spark.read.parquet, path)


def save_features(weights: DataFrame, path: str) -> None:
    """Sparse features in long form (msg_id, split, term, idx, tf, weight), one directory per split."""
    weights.select("msg_id", "term", "idx", "tf", "weight", "split").write.mode("overwrite").partitionBy(
        "split"
    ).parquet(path)


def save_embeddings(df: DataFrame, path: str) -> None:
    df.select("msg_id", "embedding", "split").write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a feature or embedding table; partition pruning skips the other."""
    return found(spark.read.parquet, path).where(F.col("split") == split)


def save_report(report: DataFrame, path: str) -> None:
    """Numbered report lines (n, value) as one text file.  A report has a few dozen lines."""
    report.coalesce(1).sortWithinPartitions("n").select("value").write.mode("overwrite").text(path)
