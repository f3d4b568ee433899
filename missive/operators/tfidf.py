"""TF-IDF over word n-grams in long form: one row per (message, term).

The text is shuffled once, by message id, before it is exploded.  Term counting, the vocabulary join and the
normalisation all keep that partitioning, so the exploded rows (about ten times the text) never move.  The
vocabulary, at most ``max_features`` rows, is the only side that travels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import ngrams, tokens
from ..session import shuffle_width

# Default settings of the featurizer.
MAX_FEATURES = 3000
NGRAM_RANGE = (1, 2)
MIN_DF = 2
MAX_DF = 0.95


def term_counts(
    df: DataFrame,
    ngram_range: tuple[int, int] = NGRAM_RANGE,
    id_col: str = "msg_id",
    text_col: str = "message_clean",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, *keep, term, tf).  ``keep`` names columns that depend on the id, such as the split."""
    # a fixed width: exploding multiplies the rows, which size-based coalescing of the words cannot know
    words = df.select(id_col, *keep, tokens(F.col(text_col)).alias("_words")).repartition(shuffle_width(df), id_col)
    terms = words.select(id_col, *keep, F.explode(ngrams(F.col("_words"), *ngram_range)).alias("term"))
    return terms.groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(counts: DataFrame) -> DataFrame:
    """(term, df, cf): documents holding the term, and its occurrences."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def text_stats(
    df: DataFrame, ngram_range: tuple[int, int] = NGRAM_RANGE, text_col: str = "message_clean"
) -> DataFrame:
    """``term_stats`` of the texts themselves: the terms are counted where they stand, so a task holds the distinct
    terms that it has met, not the terms of every message, and the text does not move."""
    grams = df.select(ngrams(tokens(F.col(text_col)), *ngram_range).alias("_all"))
    # first each term once, then all of them
    kinds = grams.select(F.posexplode(F.array(F.array_distinct("_all"), F.col("_all"))).alias("_kind", "_terms"))
    terms = kinds.select("_kind", F.explode("_terms").alias("term"))
    return terms.groupBy("term").agg(F.count_if(F.col("_kind") == 0).alias("df"), F.count_if(F.col("_kind") == 1).alias("cf"))


def known_counts(
    df: DataFrame,
    vocab: DataFrame,
    ngram_range: tuple[int, int] = NGRAM_RANGE,
    id_col: str = "msg_id",
    text_col: str = "message_clean",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``term_counts`` of the terms in ``vocab``: the others go before anything is counted or moved."""
    grams = df.select(id_col, *keep, F.explode(ngrams(tokens(F.col(text_col)), *ngram_range)).alias("term"))
    # the vocabulary has at most max_features rows, checked when it is fitted
    known = grams.join(F.broadcast(vocab.select("term")), "term")
    return known.groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(
    counts: DataFrame | None,
    documents: DataFrame,
    min_df: int | float = MIN_DF,
    max_df: int | float = MAX_DF,
    max_features: int = MAX_FEATURES,
    stats: DataFrame | None = None,
) -> DataFrame:
    """(term, idx, df, cf, idf): the ``max_features`` most frequent admissible terms, ties to the smaller term.

    Integers are document counts and floats are shares for both limits.  ``documents`` gives n, as documents
    without any term count too.  ``stats`` (term, df, cf) takes the place of ``counts``.
    """
    if not isinstance(max_features, int) or max_features < 1:
        raise ValueError(f"max_features must be a positive integer, got {max_features!r}")
    n = documents.agg(F.count(F.lit(1))).scalar()

    def limit(value: int | float):
        return F.lit(value) * n if isinstance(value, float) else F.lit(value)

    stats = (term_stats(counts) if stats is None else stats).where((F.col("df") >= limit(min_df)) & (F.col("df") <= limit(max_df)))
    top = stats.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    # at most max_features rows reach this window
    position = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("term")) - 1
    idf = F.log((1 + n) / (1 + F.col("df"))) + 1
    return top.select("term", position.cast("int").alias("idx"), "df", "cf", idf.alias("idf"))


def transform(
    counts: DataFrame,
    vocab: DataFrame,
    sublinear_tf: bool = True,
    id_col: str = "msg_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, *keep, term, idx, tf, weight), each document scaled to unit length.  Unknown terms vanish."""
    tf = F.col("tf").cast("double")
    raw = (1 + F.log(tf) if sublinear_tf else tf) * F.col("idf")
    # the vocabulary has at most max_features rows, checked when it is fitted
    known = counts.join(F.broadcast(vocab.select("term", "idx", "idf")), "term").withColumn("_raw", raw)
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(W.partitionBy(id_col)))
    return known.select(id_col, *keep, "term", "idx", "tf", (F.col("_raw") / norm).alias("weight"))


def feature_names(vocab: DataFrame, n: int | None = None) -> DataFrame:
    names = vocab.select("idx", "term")
    return names.orderBy("term").limit(n) if n else names


def vocabulary_size(vocab: DataFrame) -> int:
    return vocab.count()


def to_vectors(
    weights: DataFrame,
    documents: DataFrame,
    size: int,
    id_col: str = "msg_id",
    out_col: str = "features",
    weight_col: str = "weight",
) -> DataFrame:
    """``documents`` plus one sparse vector per row; documents without a known term get the empty vector.

    A document contributes at most ``size`` entries, so the collected lists are bounded.
    """

    @F.pandas_udf(VectorUDT())
    def sparse(indices: pd.Series, values: pd.Series) -> pd.DataFrame:
        n = len(indices)
        return pd.DataFrame(
            {
                "type": np.zeros(n, np.int8),
                "size": np.full(n, size, np.int32),
                "indices": indices,
                "values": values,
            }
        )

    entries = weights.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("idx", F.col(weight_col).alias("w")))).alias("_entries")
    )
    filled = F.coalesce("_entries", F.array().cast("array<struct<idx:int,w:double>>"))
    rows = documents.join(entries, id_col, "left").withColumn("_entries", filled)
    return rows.withColumn(out_col, sparse(F.col("_entries.idx"), F.col("_entries.w"))).drop("_entries")


@dataclass
class TfidfFeaturizer:
    """Fit on one frame, transform others.  The fitted state is the vocabulary table."""

    max_features: int = MAX_FEATURES
    ngram_range: tuple[int, int] = NGRAM_RANGE
    min_df: int | float = MIN_DF
    max_df: int | float = MAX_DF
    sublinear_tf: bool = True
    id_col: str = "msg_id"
    text_col: str = "message_clean"
    vocab: DataFrame | None = None

    def fit(self, df: DataFrame) -> TfidfFeaturizer:
        counts = term_counts(df, self.ngram_range, self.id_col, self.text_col)
        self.vocab = vocabulary(counts, df, self.min_df, self.max_df, self.max_features)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        self._check()
        counts = term_counts(df, self.ngram_range, self.id_col, self.text_col)
        return transform(counts, self.vocab, self.sublinear_tf, self.id_col)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def vectors(self, df: DataFrame, out_col: str = "features") -> DataFrame:
        """``df`` plus the sparse vector column Spark ML trains on."""
        return to_vectors(self.transform(df), df, self.max_features, self.id_col, out_col)

    def feature_names(self, n: int | None = None) -> DataFrame:
        self._check()
        return feature_names(self.vocab, n)

    def vocabulary_size(self) -> int:
        self._check()
        return vocabulary_size(self.vocab)

    def save(self, path: str) -> None:
        self._check()
        self.vocab.withColumns(
            {
                "max_features": F.lit(self.max_features),
                "ngram_low": F.lit(self.ngram_range[0]),
                "ngram_high": F.lit(self.ngram_range[1]),
                "sublinear_tf": F.lit(self.sublinear_tf),
            }
        ).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> TfidfFeaturizer:
        table = spark.read.parquet(path)
        settings = table.select("max_features", "ngram_low", "ngram_high", "sublinear_tf").first()
        if settings is None:
            raise ValueError(f"Empty vocabulary: {path}")
        return cls(
            max_features=settings.max_features,
            ngram_range=(settings.ngram_low, settings.ngram_high),
            sublinear_tf=settings.sublinear_tf,
            vocab=table.select("term", "idx", "df", "cf", "idf"),
        )

    def _check(self) -> None:
        if self.vocab is None:
            raise ValueError("Featurizer not fitted. Call fit() first.")
