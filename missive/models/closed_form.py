"""Classifiers whose parameters are sums over the training rows.

One aggregation of the long feature table (id, key, weight) gives, per feature and class, the rows holding the
feature, the sum and the sum of squares.  From these follow Bernoulli, multinomial and Gaussian naive Bayes, the
nearest centroid and the majority class.  Scoring is one join with the parameter table and one sum per message,
for all of them at once; features a message does not hold enter through a constant per class, so the table stays
sparse.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import sigmoid
from ..session import bounded, freeze

MODELS = ("BernoulliNB", "DummyClassifier", "GaussianNB", "MultinomialNB", "NearestCentroid")

# Smoothing of the naive Bayes counts, and the share of the largest variance added to all variances.
SMOOTHING = 1.0
VARIANCE_SMOOTHING = 1e-9

# Parameter tables are joined by broadcast and held by the driver while fitting.
MAX_KEYS = 1 << 17

_SUMS = ("n1", "n0", "s1", "s0", "q1", "q0")


def moments(features: DataFrame, key: str, y_col: str = "y", keys: DataFrame | None = None) -> DataFrame:
    """Per key and class: rows with a positive weight, sum and sum of squares.

    ``keys`` lists the features that may be absent from every training row.
    """
    w = F.col("weight")

    def of(cls: int, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col(y_col) == cls, value)), F.lit(0.0))

    sums = features.groupBy(key).agg(
        *[of(c, (w > 0).cast("double")).alias(f"n{c}") for c in (1, 0)],
        *[of(c, w).alias(f"s{c}") for c in (1, 0)],
        *[of(c, w * w).alias(f"q{c}") for c in (1, 0)],
    )
    return sums if keys is None else keys.select(key).join(sums, key, "left").na.fill(0.0, list(_SUMS))


def _log_normal(x: Column, mean: Column, variance: Column) -> Column:
    return -0.5 * (F.log(variance) + (x - mean) * (x - mean) / variance)


@dataclass
class ClosedFormModel:
    """``params``: a row per feature; ``base``: one row of class constants."""

    params: DataFrame
    base: DataFrame
    key: str
    id_col: str = "msg_id"

    def scores(
        self,
        features: DataFrame,
        documents: DataFrame,
        models: Sequence[str] = MODELS,
        digits: int | None = None,
    ) -> DataFrame:
        """(model, *columns of documents, p, pred): every model's score of every document.

        Documents without any known feature are scored by the class constants alone.
        """
        unknown = set(models) - set(MODELS)
        if unknown:
            raise ValueError(f"Unknown model: {sorted(unknown)}. Expected some of {MODELS}.")
        w, on = F.col("weight"), (F.col("weight") > 0).cast("double")
        at = {c: _log_normal(w, F.col(f"mu{c}"), F.col(f"v{c}")) for c in (1, 0)}
        zero = {c: _log_normal(F.lit(0.0), F.col(f"mu{c}"), F.col(f"v{c}")) for c in (1, 0)}
        sums = {
            "_bern": F.col("bernoulli") * on,
            "_mult": F.col("multinomial") * w,
            "_gauss": at[1] - zero[1] - at[0] + zero[0],
            "_dot1": w * F.col("mu1"),
            "_dot0": w * F.col("mu0"),
            "_xx": w * w,
        }
        used = {
            "BernoulliNB": ["_bern"],
            "DummyClassifier": [],
            "GaussianNB": ["_gauss"],
            "MultinomialNB": ["_mult"],
            "NearestCentroid": ["_dot1", "_dot0", "_xx"],
        }
        needed = sorted({c for m in models for c in used[m]} or {"_xx"})
        # at most MAX_KEYS rows of numbers
        joined = features.select(self.id_col, self.key, "weight").join(F.broadcast(self.params), self.key)
        totals = joined.groupBy(self.id_col).agg(*[F.sum(sums[c]).alias(c) for c in needed])
        rows = documents.join(totals, self.id_col, "left").na.fill(0.0, needed)
        b = {c: F.lit(v) for c, v in self.base.first().asDict().items()}  # one row of class constants

        def margin(total: str, constant: str) -> Column:
            return F.col(total) + b[constant] + b["prior"]

        # squared distances to the two centroids; rounding must not take them below zero
        distance = {c: F.greatest(F.col("_xx") - 2 * F.col(f"_dot{c}") + b[f"norm{c}"], F.lit(0.0)) for c in (1, 0)}
        nb = {"BernoulliNB": ("_bern", "bern0"), "GaussianNB": ("_gauss", "gauss0"), "MultinomialNB": ("_mult", "zero")}
        results = []
        for name in models:
            if name in nb:
                p, pred = sigmoid(margin(*nb[name])), margin(*nb[name]) > 0
            elif name == "NearestCentroid":
                d1, d0 = F.sqrt(distance[1]), F.sqrt(distance[0])
                p, pred = F.coalesce(F.try_divide(d0, d0 + d1), F.lit(0.5)), distance[1] < distance[0]
            else:
                p, pred = b["share1"], b["share1"] > 0.5
            results.append(
                F.struct(
                    F.lit(name).alias("model"),
                    (F.round(p, digits) if digits is not None else p).alias("p"),
                    pred.cast("int").alias("pred"),
                )
            )
        return rows.select(*documents.columns, F.inline(F.array(*results)))

    def score(self, features: DataFrame, documents: DataFrame, model: str, digits: int | None = None) -> DataFrame:
        return self.scores(features, documents, [model], digits).drop("model")

    def save(self, path: str) -> None:
        self.params.write.mode("overwrite").parquet(f"{path}/params")
        self.base.write.mode("overwrite").parquet(f"{path}/base")

    @classmethod
    def load(cls, spark: SparkSession, path: str, key: str, id_col: str = "msg_id") -> ClosedFormModel:
        params = freeze(spark.read.parquet(f"{path}/params"), MAX_KEYS)
        return cls(params, freeze(spark.read.parquet(f"{path}/base"), 1), key, id_col)


def fit(
    features: DataFrame,
    documents: DataFrame,
    key: str,
    id_col: str = "msg_id",
    y_col: str = "y",
    keys: DataFrame | None = None,
) -> ClosedFormModel:
    """Fit all closed-form models.

    ``features`` is (id, y, key, weight), ``documents`` (id, y) has every training message.  The sums per feature
    are the fitted state and are kept as a local table of at most ``MAX_KEYS`` rows.
    """
    sums = bounded(moments(features, key, y_col, keys), MAX_KEYS).to_pandas()
    sizes = documents.agg(F.count_if(F.col(y_col) == 1).alias("n1"), F.count_if(F.col(y_col) == 0).alias("n0"))
    size = sizes.first()
    if not size.n1 or not size.n0:
        raise ValueError("Both classes must occur in the training rows")
    n = {1: float(size.n1), 0: float(size.n0)}
    both = n[1] + n[0]

    mean = (sums.s1 + sums.s0) / both
    floor = VARIANCE_SMOOTHING * ((sums.q1 + sums.q0) / both - mean * mean).max()
    table = pd.DataFrame({key: sums[key]})
    held, share, absent_log_density = {}, {}, {}
    for c in (1, 0):
        held[c] = (sums[f"n{c}"] + SMOOTHING) / (n[c] + 2 * SMOOTHING)
        share[c] = (sums[f"s{c}"] + SMOOTHING) / (sums[f"s{c}"].sum() + SMOOTHING * len(sums))
        mu = sums[f"s{c}"] / n[c]
        table[f"mu{c}"] = mu
        table[f"v{c}"] = (sums[f"q{c}"] / n[c] - mu * mu).clip(lower=0.0) + floor
        absent_log_density[c] = -0.5 * (np.log(table[f"v{c}"]) + mu * mu / table[f"v{c}"])
    table["bernoulli"] = np.log(held[1] / (1 - held[1])) - np.log(held[0] / (1 - held[0]))
    table["multinomial"] = np.log(share[1]) - np.log(share[0])
    base = pd.DataFrame(
        {
            "bern0": [(np.log(1 - held[1]) - np.log(1 - held[0])).sum()],
            "gauss0": [(absent_log_density[1] - absent_log_density[0]).sum()],
            "zero": [0.0],
            "norm1": [(table.mu1 * table.mu1).sum()],
            "norm0": [(table.mu0 * table.mu0).sum()],
            "prior": [np.log(n[1] / n[0])],
            "share1": [n[1] / both],
        }
    )
    spark = features.sparkSession
    return ClosedFormModel(spark.createDataFrame(table), spark.createDataFrame(base), key, id_col)
