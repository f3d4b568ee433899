"""Text to vector encoders."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql import Window as W

from ..functions.text import hash_bucket, tokens
from ..session import shuffle_width

# Default settings of the encoder.
BATCH_SIZE = 32
DIMENSION = 384


def hash_weights(
    df: DataFrame,
    dim: int = DIMENSION,
    id_col: str = "msg_id",
    text_col: str = "message_clean",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, *keep, idx, weight): token counts per hash bucket, scaled to unit length per message.

    One shuffle of the text by id; counting and scaling keep that partitioning.  A token is hashed once per
    message it occurs in.
    """
    words = df.select(id_col, *keep, tokens(F.col(text_col)).alias("_words")).repartition(shuffle_width(df), id_col)
    found = words.select(id_col, *keep, F.explode("_words").alias("token"))
    counts = found.groupBy(id_col, *keep, "token").agg(F.count(F.lit(1)).alias("_tf"))
    buckets = counts.groupBy(id_col, *keep, hash_bucket(F.col("token"), dim).alias("idx")).agg(
        F.sum("_tf").cast("double").alias("_n")
    )
    norm = F.sqrt(F.sum(F.col("_n") * F.col("_n")).over(W.partitionBy(id_col)))
    return buckets.select(id_col, *keep, "idx", (F.col("_n") / norm).alias("weight"))


def densify(
    weights: DataFrame,
    documents: DataFrame,
    dim: int,
    id_col: str = "msg_id",
    out_col: str = "embedding",
    element: str = "float",
) -> DataFrame:
    """``documents`` plus one array of length ``dim`` per row; absent positions are 0."""
    positions = F.sequence(F.lit(0), F.lit(dim - 1))
    entries = weights.groupBy(id_col).agg(F.collect_list(F.struct("idx", "weight")).alias("_entries"))
    rows = documents.join(entries, id_col, "left").withColumn(
        "_entries", F.coalesce("_entries", F.array().cast("array<struct<idx:int,weight:double>>"))
    )
    zeros = F.transform(
        F.array_except(positions, F.col("_entries.idx")),
        lambda i: F.struct(i.alias("idx"), F.lit(0.0).alias("weight")),
    )
    full = F.array_sort(F.concat(F.col("_entries"), zeros))
    return rows.withColumn(out_col, full["weight"].cast(f"array<{element}>")).drop("_entries")


def hash_embedding(
    df: DataFrame,
    dim: int = DIMENSION,
    id_col: str = "msg_id",
    text_col: str = "message_clean",
    out_col: str = "embedding",
) -> DataFrame:
    """The built-in encoder: hashed token counts of unit length.  Needs no model files and no Python."""
    return densify(hash_weights(df, dim, id_col, text_col), df, dim, id_col, out_col)


@lru_cache(1 << 17)
def _digits(token: str) -> int:
    """The number of which ``hash_bucket`` takes the rest."""
    return int.from_bytes(md5(token.encode()).digest()[:4], "big")


def hash_vectors(
    df: DataFrame,
    dim: int = DIMENSION,
    text_col: str = "message_clean",
    out_col: str = "embedding",
    element: str = "float",
) -> DataFrame:
    """``df`` with the vectors of ``hash_embedding``, row by row where the rows stand: no shuffle, no exploded tokens."""

    @F.arrow_udf(f"array<{element}>")
    def vectors(texts: pa.Array) -> pa.Array:
        out = np.zeros((len(texts), dim), np.float32 if element == "float" else np.float64)
        for k, text in enumerate(texts):
            found = [_digits(w) % dim for w in (text.as_py() or "").split(" ") if len(w) > 1]
            if found:
                n = np.bincount(found, minlength=dim)
                out[k] = n / math.sqrt(n @ n)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * dim, pa.int32()), pa.array(out.ravel()))

    return df.withColumn(out_col, vectors(F.col(text_col)))


def encode(
    df: DataFrame,
    make_encoder: Callable[[], Callable],
    text_col: str = "message_clean",
    out_col: str = "embedding",
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Embed with a user's model.

    ``make_encoder`` runs once per Python worker and returns ``encoder(texts: ndarray of str) -> (n, dim) ndarray``;
    batches of ``batch_size`` texts reach it through Arrow.  Filter before calling this: Spark does not move
    a filter below a Python operator.
    """
    embed = predict_batch_udf(make_encoder, return_type=t.ArrayType(t.FloatType()), batch_size=batch_size)
    return df.withColumn(out_col, embed(F.col(text_col)))


class EmbeddingGenerator:
    """An encoder with its dimension: the hashed encoder by default, a user's model otherwise."""

    def __init__(self, make_encoder: Callable[[], Callable] | None = None, dim: int = DIMENSION):
        self.make_encoder = make_encoder
        self.dim = dim

    def generate(
        self,
        df: DataFrame,
        batch_size: int = BATCH_SIZE,
        id_col: str = "msg_id",
        text_col: str = "message_clean",
        out_col: str = "embedding",
    ) -> DataFrame:
        if self.make_encoder is None:
            return hash_embedding(df, self.dim, id_col, text_col, out_col)
        return encode(df, self.make_encoder, text_col, out_col, batch_size)

    def embedding_dim(self) -> int:
        return self.dim
