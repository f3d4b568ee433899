"""Line dedup: repeated runs of lines, from the suffixes of line-id sequences by prefix doubling.

Every line has a name, a hash of its bytes, and a document is the sequence of its names.  Prefix doubling names the
runs of 1, 2, 4, ... lines from the names of two halves; as names are content hashes, the name at a later offset is
known in every document without a join, and suffixes that start alike have equal names.

Round 0 runs over the whole corpus: lines whose name occurs once can't be part of a repeated run, so their suffixes
leave the sort, as singletons do in prefix doubling.  What remains is doubled, and each suffix is grouped at the depth
where its run reaches ``min_words``: suffixes that share that name are an interval of the suffix array whose longest
common prefix is at least that deep.  Runs are taken forwards from their first line and backwards from their last, so
that together they cover every maximal repeated run of ``min_words`` or more exactly.  In each interval the first
occurrence stays, by document id and line, and the lines of all later ones are deleted.

No list is longer than one document.  Counts are pre-aggregated, and a name that is everywhere only meets its count
and its first occurrence, in joins that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_texts, saved

MIN_WORDS = 50
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Names for pairs of names, in two lanes of 64 bits (the last axis)."""
    x = a * _A + (b ^ np.uint64(salt)) * _B
    x ^= x >> np.uint64(29)
    x *= _B
    return x ^ (x >> np.uint64(32))


def runs_of(lines: np.ndarray, names: np.ndarray, words: np.ndarray, min_words: int) -> tuple:
    """(start, end, name) of the shortest runs with ``min_words`` words, forwards and backwards.

    ``lines`` are ascending numbers; a run never crosses a gap.  ``names`` has two lanes.
    """
    starts, ends, keys = [], [], []
    groups = np.split(np.arange(len(lines)), np.flatnonzero(np.diff(lines) != 1) + 1)
    for group in groups:
        if not len(group) or words[group].sum() < min_words:
            continue
        total = np.concatenate(([0], np.cumsum(words[group])))
        size = len(group)
        at = np.arange(size)
        ahead = np.searchsorted(total, total[:-1] + min_words)
        behind = np.searchsorted(total, total[1:] - min_words, side="right") - 1
        forwards, backwards = ahead <= size, behind >= 0
        pairs = np.unique(
            np.concatenate(
                (
                    np.stack((at[forwards], ahead[forwards]), 1),
                    np.stack((behind[backwards], at[backwards] + 1), 1),
                )
            ),
            axis=0,
        )
        s, e = pairs[:, 0], pairs[:, 1]
        key = np.empty((len(s), 2), np.uint64)
        doubled, span = names[group], 1
        longest = int((e - s).max())
        while True:
            mine = (e - s >= span) & (e - s < 2 * span)
            key[mine] = _pair(doubled[s[mine]], doubled[e[mine] - span], 0x5851F42D)
            # the length is part of the name: of one pair of halves there can be several overlaps
            key[mine] ^= ((e - s)[mine].astype(np.uint64) * _A)[:, None]
            if 2 * span > longest:
                break
            doubled, span = _pair(doubled[:-span], doubled[span:], span), 2 * span
        starts.append(lines[group][s])
        ends.append(lines[group][e - 1] + 1)
        keys.append(key)
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 2), np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(keys)


def _named(docs: DataFrame) -> DataFrame:
    """(id, key, line, name, more, words): one row for each line of (id, key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest

        low = (1 << 64) - 1
        for batch in batches:
            sizes, first, second, words = [], [], [], []
            for text in raw_texts(batch.column(2)):
                parts = text.split(b"\n")
                sizes.append(len(parts))
                for part in parts:
                    name = xxh3_128_intdigest(part)
                    first.append(name & low)
                    second.append(name >> 64)
                    words.append(len(part.split()))
            rows = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            numbers = [np.arange(n, dtype=np.int32) for n in sizes]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(np.concatenate(numbers) if numbers else np.empty(0, np.int32)),
                    pa.array(np.array(first, np.uint64).view(np.int64)),
                    pa.array(np.array(second, np.uint64).view(np.int64)),
                    pa.array(np.array(words, np.int32)),
                ],
                ["id", "key", "line", "name", "more", "words"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, key bigint, line int, name bigint, more bigint, words int")


def _runs(grouped: DataFrame, min_words: int) -> DataFrame:
    """(id, key, start, end, a, b): the named runs of each document of (id, key, rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, sizes = [], []
            for lists in batch.column(2):
                fields = lists.values.flatten()
                line = fields[0].to_numpy().astype(np.int64)
                names = np.stack([f.to_numpy(zero_copy_only=False).view(np.uint64) for f in fields[1:3]], 1)
                out.append(runs_of(line, names, fields[3].to_numpy().astype(np.int64), min_words))
                sizes.append(len(out[-1][0]))
            rows = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            start, end, keys = (np.concatenate([o[k] for o in out]) for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(start.astype(np.int32)),
                    pa.array(end.astype(np.int32)),
                    pa.array(np.ascontiguousarray(keys[:, 0]).view(np.int64)),
                    pa.array(np.ascontiguousarray(keys[:, 1]).view(np.int64)),
                ],
                ["id", "key", "start", "end", "a", "b"],
            )

    kind = grouped.schema["id"].dataType.simpleString()
    return grouped.mapInArrow(run, f"id {kind}, key bigint, start int, end int, a bigint, b bigint")


def _merged(cuts: DataFrame) -> DataFrame:
    """(id, key, removed, keeps): disjoint deleted runs, and what lies between them as (offset, lines)."""
    removed = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    keeps = pa.list_(pa.struct([("offset", pa.int32()), ("lines", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, kept = [], []
            for runs in batch.column(2).to_pylist():
                joined: list[dict] = []
                for r in sorted(runs, key=lambda r: r["start"]):
                    if joined and r["start"] <= joined[-1]["end"]:
                        joined[-1]["end"] = max(joined[-1]["end"], r["end"])
                    else:
                        joined.append(dict(r))
                froms = [0, *(r["end"] for r in joined)]
                tos = [*(r["start"] for r in joined), 2**31 - 2]
                gone.append(joined)
                kept.append([{"offset": a, "lines": b - a} for a, b in zip(froms, tos) if a < b])
            columns = [batch.column(0), batch.column(1), pa.array(gone, removed), pa.array(kept, keeps)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "removed", "keeps"])

    kind = cuts.schema["id"].dataType.simpleString()
    return cuts.mapInArrow(
        run,
        f"id {kind}, key bigint, removed array<struct<start: int, end: int>>, "
        "keeps array<struct<offset: int, lines: int>>",
    )


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with the later copies of repeated line runs cut from the text, and two more columns.

    ``line_count`` is the number of lines before, ``removed_runs`` the deleted runs (first line, line after the last).
    A null text has no lines and stays null.  A text whose lines all go becomes empty.  Rows that are the same in id
    and text count as one document: they lose the same lines, and don't delete each other.  Among equal ids the hash of
    the text decides which copy is first; a null id comes before all others.
    """
    for name in ("line_count", "removed_runs"):
        if name in docs.columns:
            raise ValueError(f"the documents already have a column {name}")
    key = F.xxhash64(text_col)
    picked = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).alias("text")
    )
    lines = saved(_named(picked), "lines")
    common = saved(lines.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "common")
    row = F.struct("line", "name", "more", "words")
    alive = lines.join(common.hint("merge"), "name").groupBy("id", "key").agg(F.sort_array(F.collect_set(row)).alias("rows"))
    runs = saved(_runs(alive, min_words), "runs")
    place = F.struct("id", "key", "start")
    first = saved(
        runs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n"),
        "first",
    )
    later = runs.join(first.hint("merge"), ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    cuts = later.groupBy("id", "key").agg(F.collect_set(F.struct("start", "end")).alias("runs"))
    cuts = saved(_merged(cuts), "cuts").select(
        F.struct(F.col("id").alias("id"), F.col("key").alias("key")).alias("_of"),
        F.struct("removed", "keeps").alias("_cut"),
    )
    # the same plan at every size: how many documents lose lines isn't bounded, so their list is never broadcast
    own = docs[id_col].eqNullSafe(F.col("_of.id")) & (F.xxhash64(docs[text_col]) == F.col("_of.key"))
    joined = docs.join(cuts.hint("merge"), own, "left")
    text, kept = docs[text_col], F.col("_cut.keeps")
    body = F.split(text, "\n", -1)
    left = F.array_join(F.flatten(F.transform(kept, lambda k: F.slice(body, k["offset"] + 1, k["lines"]))), "\n")
    columns = [
        F.when(kept.isNull(), text).otherwise(left).alias(c) if c == text_col else docs[c] for c in docs.columns
    ]
    none = F.array().cast("array<struct<start: int, end: int>>")
    return joined.select(
        *columns,
        F.coalesce(F.size(body), F.lit(0)).alias("line_count"),
        F.coalesce("_cut.removed", none).alias("removed_runs"),
    )


def removed_lines():
    """How many lines ``removed_runs`` holds."""
    return F.aggregate("removed_runs", F.lit(0), lambda n, r: n + r["end"] - r["start"])
