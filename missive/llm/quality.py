"""A quality classifier without hand labels.

Thirteen overlapping heuristics vote on every document, or keep silent.  Expectation-maximisation over the vote patterns of
all documents estimates their accuracies; the posteriors are soft labels for a linear scorer over hashed features,
fitted on a bounded sample.  The scorer then rates every document.  No step shuffles a text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_texts
from .digest import counts as triplet_counts
from .weak import fit, logistic

#: Rows the scorer is fitted on, chosen by a hash of the row.
SAMPLE_ROWS = 4096
#: Hashed features: byte triplets in 256 buckets, binned signals in as many again.
TRIPLETS, BINNED = 256, 256
#: A document is rejected when its chance of being junk exceeds this: in doubt it stays.
REJECT = 0.9

_ODD = np.zeros(256, np.int64)
_ODD[list(b"#$%&*+/<=>@[]^_{|}~\\")] = 1
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_PLAIN_END = np.zeros(256, bool)
_PLAIN_END[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b".,", *b" \t\n\r\x0b\x0c"]] = True

SIGNALS = (
    "odd", "shout", "upper", "adjacent", "top", "distinct", "bars", "ends", "sentence", "lines", "runs", "letters"
)
#: One labeller for each signal, and one that finds prose natural in all respects.
LABELLERS = len(SIGNALS) + 1


def signals(text: bytes) -> tuple[int, np.ndarray]:
    """Number of words and the signals; all zero without words."""
    words = text.split()
    n = len(words)
    if not n:
        return 0, np.zeros(len(SIGNALS))
    data = np.frombuffer(text, np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    upper, lower = bytes_[65:91].sum(), bytes_[97:123].sum() + bytes_[128:].sum() / 2
    seen = Counter(words)
    odd_ends = int((~_PLAIN_END[data[:-1]] & _SPACE[data[1:]]).sum()) + int(not _PLAIN_END[data[-1]])
    lines = text.split(b"\n")
    runs = ((data[:-2] == data[1:-1]) & (data[1:-1] == data[2:]) & (_ODD[data[2:]] > 0)).sum()
    letters = upper + bytes_[97:123].sum() + bytes_[128:].sum()
    return n, np.array(
        [
            (bytes_ * _ODD).sum() / n,
            bytes_[33] / n,
            upper / max(20.0, upper + lower),
            sum(map(eq, words, islice(words, 1, None))) / n,
            max(seen.values()) / n,
            len(seen) / n,
            bytes_[124] / n,
            odd_ends / n,
            n / max(1, bytes_[46] + bytes_[33] + bytes_[63]),
            len(set(lines)) / len(lines) if len(lines) >= 5 else 1.0,
            runs / n,
            letters / max(1, len(text) - bytes_[_SPACE].sum()),
        ]
    )


def votes(n: int, s: np.ndarray) -> np.ndarray:
    """0 no opinion, 1 clean, 2 junk, for each labeller.  No words: no opinions."""
    odd, shout, upper, adjacent, top, distinct, bars, ends, sentence, lines, runs, letters = s
    out = np.zeros(LABELLERS, np.int64)
    if not n:
        return out
    out[0] = 2 * (odd > 0.4)
    out[1] = 2 * (shout > 0.4)
    out[2] = 2 * (upper > 0.5)
    out[3] = 2 * (n >= 20 and adjacent > 0.2)
    out[4] = 2 * (n >= 20 and top > 0.25)
    out[5] = 2 * (n >= 30 and distinct < 0.25)
    out[6] = 2 * (bars > 0.2)
    out[7] = 2 * (n >= 10 and ends > 0.3)
    out[8] = 2 * (n >= 30 and not 2 <= sentence <= 60)
    out[9] = 2 * (lines < 0.6)
    out[10] = 2 * (runs > 0.2)
    out[11] = 2 * (n >= 20 and letters < 0.7)
    out[12] = int(not out.any() and distinct > 0.5 and ends < 0.05 and 3 <= sentence <= 40 and letters > 0.85)
    return out


def features(text: bytes, n: int, s: np.ndarray) -> np.ndarray:
    """Hashed features: square roots of triplet shares, and one bucket for each signal's bin."""
    out = np.zeros(TRIPLETS + BINNED, np.float32)
    triplets = triplet_counts(text)
    out[:TRIPLETS] = np.sqrt(triplets / max(1, triplets.sum()))
    if n:
        bins = np.minimum(15, np.where(s > 0, np.maximum(0, np.floor(2 * np.log2(np.maximum(s, 1e-9)) + 12)), 0))
        places = (np.arange(len(SIGNALS)) * 16 + bins.astype(np.int64)) * 0x9E3779B1 % 0x1_0000_0000 * BINNED >> 32
        np.add.at(out, TRIPLETS + places, 1.0)
    return out


def _spell(v: np.ndarray) -> str:
    return "".join(map(str, v.tolist()))


def train(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> dict:
    """Labeller accuracies, the posterior of each vote pattern, and the scorer's weights."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_spell(votes(*signals(t))) for t in raw_texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["votes"])

    texts = docs.select(F.col(text_col).alias("text"))
    # at most 2 ** 12 + 1 patterns
    tally = texts.mapInArrow(vote, "votes string").groupBy("votes").agg(F.count("*").alias("n")).collect()
    tally.sort(key=lambda r: r["votes"])
    patterns = np.array([[int(c) for c in r["votes"]] for r in tally]).reshape(-1, LABELLERS)
    model = fit(patterns, np.array([r["n"] for r in tally]), prior=0.2)
    posterior = {r["votes"]: float(p) for r, p in zip(tally, model["posterior"])}
    total = sum(r["n"] for r in tally)
    share = min(1.0, sample_rows / max(1, total))
    low = -(2**63) + int(share * 2**64)
    shared = docs.sparkSession.sparkContext.broadcast(posterior)

    def picture(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, soft = [], []
            for text in raw_texts(batch.column(0)):
                n, s = signals(text)
                rows.append(features(text, n, s))
                soft.append(shared.value[_spell(votes(n, s))])
            flat = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.float32))
            lists = pa.FixedSizeListArray.from_arrays(flat, TRIPLETS + BINNED).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([lists, pa.array(soft, pa.float64())], ["x", "y"])

    keyed = docs.select(F.col(text_col).alias("text"), F.xxhash64(*docs.columns).alias("h"))
    # the hash makes the sample; the limit is its bound where many rows are the same and so are all picked
    picked = keyed.where(F.col("h") <= F.lit(min(low, 2**63 - 1))).select("text")
    sample = picked.mapInArrow(picture, "x array<float>, y double").limit(2 * sample_rows).toArrow()
    weights = np.zeros(TRIPLETS + BINNED + 1)
    if sample.num_rows:
        x = np.concatenate([np.asarray(c.values) for c in sample["x"].chunks]).reshape(-1, TRIPLETS + BINNED)
        y = sample["y"].to_numpy()
        weights = logistic(x.astype(np.float64), y, np.ones(len(y)))
    return {"accuracy": model["accuracy"], "share": model["share"], "posterior": posterior, "weights": weights}


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``votes``, ``posterior`` and ``junk``, the scorer's chance that the document is junk.

    A text without words, null included, has no votes and is junk by definition (1.0): there is nothing to keep.
    """
    names = docs.columns
    for name in ("votes", "posterior", "junk"):
        if name in names:
            raise ValueError(f"the documents already have a column {name}")
    shared = docs.sparkSession.sparkContext.broadcast({k: model[k] for k in ("posterior", "weights", "share")})

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        posterior, weights, share = (shared.value[k] for k in ("posterior", "weights", "share"))
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            spelled, soft, junk = [], [], []
            for text in raw_texts(column):
                n, s = signals(text)
                spelled.append(_spell(votes(n, s)))
                soft.append(posterior.get(spelled[-1], share))
                z = float(features(text, n, s) @ weights[:-1] + weights[-1])
                junk.append(1.0 / (1.0 + np.exp(-max(-50.0, min(50.0, z)))) if n else 1.0)
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in names]
            more = [pa.array(spelled, pa.string()), pa.array(soft, pa.float64()), pa.array(junk, pa.float64())]
            yield pa.RecordBatch.from_arrays([*arrays, *more], [*names, "votes", "posterior", "junk"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.mapInArrow(rate, f"{fields}, votes string, posterior double, junk double")


def classify(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``train`` and ``score`` on the same documents."""
    return score(docs, train(docs, text_col, sample_rows), text_col)
