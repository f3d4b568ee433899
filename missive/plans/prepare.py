"""From raw labelled messages to split, featurised tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import encode_label
from ..models import closed_form
from ..operators import embedding, quality, splits, tfidf
from ..session import checkpoint, freeze
from ..sources.tables import scratch_path


def prepare(
    messages: DataFrame,
    exact_split: bool = False,
    test_size: float = splits.TEST_SIZE,
    colocate: bool = False,
) -> DataFrame:
    """(msg_id, label, message, message_clean, y, split): validated, cleaned, encoded and split.

    The hash split is the default as it needs no shuffle; the exact one keeps the class shares to the row.
    """
    rows = quality.clean_messages(quality.validate(messages, colocate=colocate))
    rows = rows.withColumn("y", encode_label(F.col("label")))
    return splits.split_exact(rows, test_size) if exact_split else splits.split_hash(rows, test_size)


def part(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split)


@dataclass
class Prepared:
    """The prepared messages, materialised once, and what is derived from them.

    Everything downstream reads the table several times, so it is written to the shared checkpoint folder first.
    """

    rows: DataFrame

    @classmethod
    def of(cls, messages: DataFrame, exact_split: bool = False) -> Prepared:
        rows = prepare(messages, exact_split, colocate=True)
        return cls(checkpoint(rows.select("msg_id", "message_clean", "y", "split")))

    def documents(self, split: str) -> DataFrame:
        return part(self.rows, split).select("msg_id", "y")

    def tfidf(self, max_features: int = tfidf.MAX_FEATURES) -> TextFeatures:
        train = part(self.rows, "train")
        vocab = tfidf.vocabulary(None, train, max_features=max_features, stats=tfidf.text_stats(train))
        return TextFeatures(self, freeze(vocab, max_features), max_features)

    def hashed(self, split: str, dim: int) -> DataFrame:
        """(msg_id, y, idx, weight) of the hashed embedding."""
        return embedding.hash_weights(part(self.rows, split), dim, keep=("y",))

    def embedded(self, split: str, dim: int, element: str = "float") -> DataFrame:
        """(msg_id, y, embedding)."""
        rows = embedding.hash_vectors(part(self.rows, split), dim, element=element)
        return rows.select("msg_id", "y", "embedding")

    def fit_embedding(self, dim: int) -> closed_form.ClosedFormModel:
        keys = self.rows.sparkSession.range(dim).select(F.col("id").cast("int").alias("idx"))
        return closed_form.fit(self.hashed("train", dim), self.documents("train"), "idx", keys=keys)


@dataclass
class TextFeatures:
    source: Prepared
    vocab: DataFrame
    max_features: int

    @cached_property
    def entries(self) -> DataFrame:
        """(msg_id, y, split, entries): the known terms of each message of both splits, computed once and kept.

        A message has at most ``max_features`` entries.
        """
        keep = ("y", "split")
        counts = tfidf.known_counts(self.source.rows, self.vocab, keep=keep)
        weights = tfidf.transform(counts, self.vocab, keep=keep)
        entry = F.struct("idx", "tf", "weight")
        rows = weights.groupBy("msg_id", *keep).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        path = scratch_path(self.source.rows.sparkSession, "entries")
        rows.write.parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def weights(self, split: str) -> DataFrame:
        """(msg_id, y, term, idx, tf, weight)."""
        long = part(self.entries, split).select("msg_id", "y", F.inline("entries"))
        # at most max_features rows
        return long.join(F.broadcast(self.vocab.select("idx", "term")), "idx").select(
            "msg_id", "y", "term", "idx", "tf", "weight"
        )

    def vectors(self, split: str) -> DataFrame:
        """(msg_id, y, features) with sparse vectors."""
        return tfidf.to_vectors(self.weights(split), self.source.documents(split), self.max_features)

    def fit(self) -> closed_form.ClosedFormModel:
        return closed_form.fit(self.weights("train"), self.source.documents("train"), "term")
