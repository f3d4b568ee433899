"""Quartile bucket digests of texts (a locality-sensitive fingerprint), and their likeness.

The byte triplets of a text are hashed to 256 buckets and counted.  The digest holds the text's length on a
logarithmic scale, two quartile ratios, and for each bucket which quartile its count is in (two bits).  The difference
of two digests adds up bucket steps and header steps and is bounded; likeness is one less the difference over the
bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_texts, saved, shuffle_width

#: Difference at which two digests are not alike at all.  Unrelated texts of one language come to 150 or more.
BOUND = 400
#: What a bucket costs whose quartiles are 0, 1, 2 or 3 apart.
STEPS = np.array([0, 1, 2, 6], np.int64)
LENGTH_WEIGHT, RATIO_WEIGHT = 4, 2
_TABLES = [np.random.default_rng(seed).permutation(256).astype(np.uint8) for seed in (11, 12, 13)]


def counts(text: bytes, tables: list[np.ndarray] = _TABLES) -> np.ndarray:
    """Triplets in each of the 256 buckets, whatever the text's length, in chunks of bounded size."""
    data, total = np.frombuffer(text, np.uint8), np.zeros(256, np.int64)
    for at in range(0, max(0, len(data) - 2), 1 << 20):
        part = data[at : at + (1 << 20) + 2]
        code = tables[0][part[:-2]] ^ tables[1][part[1:-1]] ^ tables[2][part[2:]]
        total += np.bincount(code, minlength=256)
    return total


def digest(text: bytes, tables: list[np.ndarray] = _TABLES) -> np.ndarray:
    """259 small numbers: length code, two quartile ratios, 256 quartiles.  Equal texts have equal digests."""
    total = counts(text, tables)
    q1, q2, q3 = np.partition(total, (63, 127, 191))[[63, 127, 191]]
    out = np.empty(259, np.uint8)
    out[0] = min(255, round(8 * np.log2(len(text) + 1)))
    out[1], out[2] = (q1 * 15 // q3, q2 * 15 // q3) if q3 else (0, 0)
    out[3:] = (total > q1).astype(np.uint8) + (total > q2) + (total > q3)
    return out


def spelled(code: np.ndarray) -> str:
    """A digest as 132 hex digits: length, ratios, then four buckets a byte."""
    four = code[3:].reshape(64, 4)
    body = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return bytes([code[0], code[1] << 4 | code[2]]).hex() + body.tobytes().hex()


def read(spelling: str) -> np.ndarray:
    """The inverse of ``spelled``."""
    raw = np.frombuffer(bytes.fromhex(spelling), np.uint8)
    body = (raw[2:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3
    return np.concatenate(([raw[0], raw[1] >> 4, raw[1] & 15], body.ravel())).astype(np.uint8)


def difference(a: np.ndarray, b: np.ndarray, steps: np.ndarray = STEPS) -> int:
    gap = np.abs(a.astype(np.int64) - b)
    return int(steps[gap[3:]].sum() + LENGTH_WEIGHT * max(0, gap[0] - 1) + RATIO_WEIGHT * (gap[1] + gap[2]))


def likeness(a: np.ndarray, b: np.ndarray, bound: int = BOUND) -> float:
    """1 for equal digests, 0 from a difference of ``bound`` on."""
    return max(0.0, 1.0 - difference(a, b) / bound)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint), one row for each document; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([spelled(digest(t)) for t in raw_texts(batch.column(1))], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"id {kind}, fingerprint string")


_EDITED = (
    "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_KINDS = pa.schema(
    [("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _compared(id_, text: str, code: np.ndarray, after: str, after_code: np.ndarray) -> tuple:
    """One result row: the text, its edit with the head of the next text, and the next text."""
    moved = len(text) // 4
    edited = (text[: len(text) - moved] + after[:moved]).encode()
    new = digest(edited)
    return (
        id_, len(text), hashlib.sha256(edited).hexdigest(), spelled(code), spelled(new),
        likeness(code, new), likeness(code, after_code),
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema
    )


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edit and against the next document in id order; the last one's next is the first.

    Documents are dealt by id ranges and read in order, so a text moves once.  Where a range ends, its last text and
    the first of the next range wait in a small table, two rows a range.  Rows with equal ids follow each other by the
    hash of their text, null ids come first, a null text is empty.
    """
    order = [F.col("id"), F.xxhash64("text")]
    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    dealt = picked.repartitionByRange(shuffle_width(docs), *order).sortWithinPartitions(*order)
    schema = pa.schema([*_KINDS, ("part", pa.int32()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        blank = (None,) * 6
        for batch in batches:
            rows = []
            for id_, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                text, code = raw.decode(), digest(raw)
                if held is None:
                    rows.append((id_, *blank, part, "head", text))
                else:
                    rows.append((*_compared(*held, text, code), part, "done", None))
                held = (id_, text, code)
            yield _batch(rows, schema)
        if held is not None:
            yield _batch([(held[0], *blank, part, "tail", held[1])], schema)

    table = saved(dealt.mapInArrow(run, f"{_EDITED}, part int, role string, text string"), "compared")
    done = table.where("role = 'done'").select(*_KINDS.names)
    parts = sorted(r[0] for r in table.where("role = 'head'").select("part").collect())
    follows = docs.sparkSession.createDataFrame(
        [(p, parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)], "part int, after int"
    )
    heads = table.where("role = 'head'").select(F.col("part").alias("after"), F.col("text").alias("next_text"))
    tails = table.where("role = 'tail'").select("id", "text", "part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = batch.column(0).to_pylist(), raw_texts(batch.column(1)), raw_texts(batch.column(2))
            for id_, raw, after in zip(*columns):
                rows.append(_compared(id_, raw.decode(), digest(raw), after.decode(), digest(after)))
            yield _batch(rows, _KINDS)

    edges = tails.join(follows, "part").join(heads, "after").select("id", "text", "next_text")
    return done.unionByName(edges.mapInArrow(finish, _EDITED))
