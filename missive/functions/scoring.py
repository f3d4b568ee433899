"""Column expressions over labels, scores and counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label names and their codes.
LABEL_CODES = {"ham": 0, "spam": 1}

# Default settings of the cascade.
STAGE1_LOW = 0.1
STAGE1_HIGH = 0.9
STAGE2_THRESHOLD = 0.5


def encode_label(label: Column) -> Column:
    """ham → 0, spam → 1, anything else → null."""
    return F.when(label == "ham", F.lit(0)).when(label == "spam", F.lit(1))


def decode_label(code: Column) -> Column:
    """0 → ham, 1 → spam, anything else → null."""
    return F.when(code == 0, F.lit("ham")).when(code == 1, F.lit("spam"))


def collection_label(code: Column) -> Column:
    """The vector collection's naming: 0 → ham, everything else → spam."""
    return F.when(code == 0, F.lit("ham")).otherwise(F.lit("spam"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def f_score(precision: Column, recall: Column) -> Column:
    """Harmonic mean, 0 where both are 0."""
    return ratio(2 * precision * recall, precision + recall)


def sigmoid(margin: Column) -> Column:
    """Logistic function, written so that exp never overflows."""
    small = F.exp(-F.abs(margin))
    return F.when(margin >= 0, 1 / (1 + small)).otherwise(small / (1 + small))


def threshold(p: Column, at: Column | float) -> Column:
    return (p >= (F.lit(at) if isinstance(at, (int, float)) else at)).cast("int")


def stage_used(p1: Column, low: Column, high: Column) -> Column:
    """1 where stage 1 is sure enough to decide, else 2."""
    return F.when((p1 <= low) | (p1 >= high), F.lit(1)).otherwise(F.lit(2))


def cascade_prediction(p1: Column, p2: Column, low: Column, high: Column, stage2: Column) -> Column:
    """The low test comes first, as it wins when the thresholds cross."""
    return F.when(p1 <= low, F.lit(0)).when(p1 >= high, F.lit(1)).otherwise(threshold(p2, stage2))


def cascade_confidence(p1: Column, p2: Column, low: Column, high: Column, stage2: Column) -> Column:
    return (
        F.when(p1 <= low, 1 - p1)
        .when(p1 >= high, p1)
        .otherwise(F.when(p2 >= stage2, p2).otherwise(1 - p2))
    )
