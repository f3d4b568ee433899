"""Suffix-array dedup of byte strings by bucket-pointer refinement.

A byte is removed if some string of ``span`` bytes that covers it also starts anywhere else.  In a suffix array, such
strings are buckets of suffixes with equal prefixes.  Bucket-pointer refinement starts with q-gram buckets and splits
them by the bucket identifiers of later offsets, until the prefixes are long enough; identifiers found once are used
again for every suffix that reaches them.

*Identifiers.*  The identifier of a prefix of 2k bytes is a hash of the identifiers of its k-byte halves, so in every
document they follow from the document alone, and equal prefixes have equal identifiers everywhere.

*Which suffixes.*  A string of ``span`` bytes contains the q-grams of ``span - q + 1`` offsets; the one with the least
identifier (the leftmost of them) is its anchor, and equal strings have equal anchors.  Consecutive strings with the
same anchor form a block, so the buckets hold one entry for some 80 bytes, not one for each byte.

*Refinement.*  Buckets of one entry are dropped.  A block whose whole text is also another block's is settled.  The
blocks left are cut into ranges of offsets from the anchor, 40, then 8, then 1 strings wide: a range's bucket is named by the
bytes that its strings share, and it is split by the bytes that they cover together.  Ranges alone in their bucket end
there; ranges that share all bytes are settled; one of each class goes on as long as a bucket has an unsettled one.
The last step compares strings of ``span`` bytes, so the result is exact (identifiers that settle have 128 bits).

Equal texts are one row of the text table, which is compressed, written once and bucketed by its key; all steps
join it in place.  Every count is pre-aggregated; a bucket that is everywhere is split by joins, and no bucket is ever
collected.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_parts, raw_texts, saved, scratch_path, shuffle_width

SPAN, GRAM = 200, 40
#: Widths of the ranges in each step; the last is one string.
STEPS = (40, 8, 1)
#: Offsets whose identifiers are computed at a time: 8 MB for each array.
_CHUNK = 1 << 20
#: Bytes of compressed texts that a task takes at a time.
_PART = 1 << 20
_LOW = np.uint64((1 << 24) - 1)
_M = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(29).integers(0, 2**64, 256, dtype=np.uint64)


def _halves(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifiers of pairs of identifiers."""
    x = a * _M
    x += b
    x ^= x >> np.uint64(32)
    x *= _M
    return x


def gram_ids(data: np.ndarray, gram: int) -> np.ndarray:
    """Identifier of the q-gram at every offset, from those of 1, 2, 4, ... bytes."""
    ids, width, known = _BYTES[data], 1, 0
    total: np.ndarray | None = None
    size = len(data) - gram + 1
    left = gram
    while left:  # the set bits of the length, from the small end: offsets before them are already covered
        if left & 1:
            part = ids[known : known + size]
            total = part if total is None else _halves(total, part)
            known += width
        left >>= 1
        if left:
            ids, width = _halves(ids[:-width], ids[width:]), 2 * width
    return total


def blocks(text: bytes, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(first, last, anchor, identifier) of the blocks of strings that share an anchor."""
    none = np.empty(0, np.int64)
    if len(text) < span:
        return none, none, none, np.empty(0, np.uint64)
    data, reach = np.frombuffer(text, np.uint8), span - gram + 1
    anchors, names = [], []
    for at in range(0, len(text) - span + 1, _CHUNK):
        part = data[at : at + _CHUNK + span - 1]
        ids = gram_ids(part, gram)
        least = (ids & ~_LOW) | np.arange(len(ids), dtype=np.uint64)
        width = 1
        while 2 * width <= reach:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        size = len(part) - span + 1
        least = np.minimum(least[:size], least[reach - width : reach - width + size])
        places = (least & _LOW).astype(np.int64)
        anchors.append(places + at)
        names.append(ids[places])
    anchor, name = np.concatenate(anchors), np.concatenate(names)
    edges = np.flatnonzero(np.diff(anchor)) + 1
    first = np.concatenate(([0], edges))
    last = np.concatenate((edges, [len(anchor)])) - 1
    return first, last, anchor[first], name[first]


def _packed(first, last, anchor):
    """A range in one long: first string, number of strings less one, distance of the anchor (a byte each)."""
    return first << 16 | (last - first) << 8 | (anchor - first)


def _unpacked(value):
    first = value >> 16
    return first, first + (value >> 8 & 255), first + (value & 255)


def text_table(texts: DataFrame) -> DataFrame:
    """The distinct texts of (key, text), as a table bucketed by key: key, z (zstd), copies."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        zip_ = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = pa.array([zip_(t) for t in raw_texts(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], ["key", "z"])

    rows = texts.mapInArrow(pack, "key bigint, z binary")
    distinct = rows.groupBy("key").agg(F.first("z").alias("z"), F.count("*").alias("copies"))
    name = f"texts_{uuid.uuid4().hex}"
    path = scratch_path(texts.sparkSession, "texts")
    distinct.write.bucketBy(shuffle_width(texts), "key").option("path", path).format("parquet").saveAsTable(name)
    return texts.sparkSession.read.table(name)


def _each(rows: DataFrame, schema: str, names: list[str], emit: Callable) -> DataFrame:
    """Call ``emit(key, text, rest of the row)`` for each row of (key, z, ...) and stack the arrays it returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unzip = zstandard.ZstdDecompressor().decompress
        for batch in (part for whole in batches for part in in_parts(whole, 1, _PART)):
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            out = []
            for key, z, *rest in zip(*columns):
                made = emit(key, unzip(z), *rest)
                if made is not None:
                    out.append(made)
            if out:
                arrays = [pa.array(np.concatenate([o[k] for o in out])) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, schema)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _grams(table: DataFrame, span: int, gram: int) -> DataFrame:
    def emit(_key, text):
        return (blocks(text, span, gram)[3].view(np.int64),)

    return _each(table.select("key", "z"), "i bigint", ["i"], emit)


_ROW = "i bigint, u bigint, v bigint, key bigint, range bigint, open boolean"
_NAMES = ["i", "u", "v", "key", "range", "open"]


def _entries(table: DataFrame, span: int, gram: int) -> DataFrame:
    """The blocks of all texts: bucket i, whole text (u, v).  Texts with copies are settled, they only bear witness."""

    def emit(key, text, copies):
        from xxhash import xxh3_128_intdigest

        first, last, anchor, name = blocks(text, span, gram)
        whole = [xxh3_128_intdigest(text[a : b + span]) for a, b in zip(first.tolist(), last.tolist())]
        n = len(first)
        return (
            name.view(np.int64),
            _signed([w & (1 << 64) - 1 for w in whole]),
            _signed([w >> 64 for w in whole]),
            np.full(n, key, np.int64),
            _packed(first, last, anchor),
            np.full(n, copies == 1),
        )

    return _each(table.select("key", "z", "copies"), _ROW, _NAMES, emit)


def _ranges(table: DataFrame, pending: DataFrame, step: int, span: int) -> DataFrame:
    """The pending ranges (key, range, open) cut into ``step`` strings each, counted from the anchor."""
    items = pending.groupBy("key").agg(F.collect_list(F.struct("range", "open")).alias("items"))

    def emit(key, text, items):
        from xxhash import xxh3_64_intdigest, xxh3_128_intdigest

        shared, low, high, range_, open_ = [], [], [], [], []
        for item in items:
            first, last, anchor = _unpacked(item["range"])
            for g in range((anchor - last) // step, (anchor - first) // step + 1):
                upto = anchor - g * step  # strings upto - step + 1 to upto have these bytes in common
                from_ = upto - step + 1
                # only the strings of this range itself: then equal bytes are never the same place twice
                own, end = max(first, from_), min(last, upto)
                mine = _packed(own, end, anchor)
                shared.append(xxh3_64_intdigest(text[upto : from_ + span]))
                whole = xxh3_128_intdigest(text[own : end + span])
                low.append(whole & (1 << 64) - 1)
                high.append(whole >> 64)
                range_.append(mine)
                open_.append(item["open"])
        n = len(shared)
        return (
            _signed(shared), _signed(low), _signed(high), np.full(n, key, np.int64), np.array(range_, np.int64),
            np.array(open_, bool),
        )

    return _each(table.select("key", "z").join(items.hint("merge"), "key"), _ROW, _NAMES, emit)


def _refined(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(settled ranges, pending ranges) of rows in buckets i with classes (u, v)."""
    classes = saved(
        rows.groupBy("i", "u", "v").agg(
            F.count("*").alias("n"), F.min(F.struct("key", "range")).alias("one"), F.max("open").alias("open")
        ),
        f"{name}-classes",
    )
    twice = saved(classes.where("n > 1 and open").select("u", "v"), f"{name}-twice")
    settled = rows.where("open").join(twice.hint("merge"), ["u", "v"]).select("key", "range")
    alone = (F.col("n") == 1) & F.col("open")
    busy = classes.groupBy("i").agg(F.count("*").alias("classes"), F.max(alone).alias("pending"))
    busy = saved(busy.where("classes > 1 and pending").select("i"), f"{name}-busy")
    pending = classes.join(busy.hint("merge"), "i").select("one.key", "one.range", alone.alias("open"))
    return settled, saved(pending, f"{name}-pending")


def _repeated(rows: DataFrame, name: str) -> DataFrame:
    """Rows in buckets of two or more."""
    common = saved(
        rows.groupBy("i").agg(F.count("*").alias("n")).where("n > 1").select("i"), f"{name}-common"
    )
    return rows.join(common.hint("merge"), "i")


def repeats(table: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(key, range): the strings of ``span`` bytes that start elsewhere too, as packed ranges of their starts.

    Texts with copies are left out: all their strings do.
    """
    grams = _grams(table, span, gram)
    common = saved(grams.groupBy("i").agg(F.count("*").alias("n")).where("n > 1").select("i"), "grams")
    entries = saved(_entries(table, span, gram).join(common.hint("merge"), "i"), "entries")
    settled, pending = _refined(entries, "blocks")
    parts = [settled]
    for step in STEPS[:-1]:
        rows = saved(_repeated(saved(_ranges(table, pending, step, span), f"ranges-{step}"), f"ranges-{step}"), "alive")
        settled, pending = _refined(rows, f"ranges-{step}")
        parts.append(settled)
    strings = saved(_ranges(table, pending, STEPS[-1], span), "strings")
    twice = strings.groupBy("u", "v").agg(F.count("*").alias("n")).where("n > 1").select("u", "v")
    parts.append(strings.where("open").join(saved(twice, "twice").hint("merge"), ["u", "v"]).select("key", "range"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _cut(text: bytes, starts: list[int] | None, copies: int, span: int) -> tuple[int, list[tuple[int, int]]]:
    """Removed bytes, and the maximal removed runs, for packed ranges of starts."""
    if copies > 1 and len(text) >= span:
        return len(text), [(0, len(text))]
    runs: list[tuple[int, int]] = []
    for first, last, _ in sorted(map(_unpacked, starts or ())):
        if runs and first <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], last + span))
        else:
            runs.append((first, last + span))
    return sum(b - a for a, b in runs), runs


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    digest: list[Column] | None = None,
) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept): one row for each document.

    ``spans`` are the maximal removed runs in bytes, ``kept`` the remaining bytes.  A null text is empty.  Strings
    never cross documents; overlapping occurrences count.  Rows with equal texts have equal results, whatever
    their ids.  With ``digest``, these columns of ``spans`` and ``kept`` are returned instead of the two.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(body).alias("key"), body.alias("text"))
    table = text_table(texts)
    found = repeats(table, span, gram).groupBy("key").agg(F.collect_list("range").alias("ranges"))
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unzip = zstandard.ZstdDecompressor().decompress
        for batch in (part for whole in batches for part in in_parts(whole, 1, _PART)):
            sizes, removed, spans, kept = [], [], [], []
            columns = [batch.column(k).to_pylist() for k in range(1, 4)]
            for z, copies, ranges in zip(*columns):
                text = unzip(z)
                gone, runs = _cut(text, ranges, copies, span)
                ends = [0, *(b for _, b in runs)]
                kept.append(b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(text)])))
                sizes.append(len(text))
                removed.append(gone)
                spans.append([{"start": a, "end": b} for a, b in runs])
            columns = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kinds)]
            columns = [batch.column(0), *columns, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_bytes", "n_removed", "spans", "kept"])

    schema = "key bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    results = table.join(found.hint("merge"), "key", "left").select("key", "z", "copies", "ranges").mapInArrow(run, schema)
    # only what the caller asks for is joined to the ids: a column of ``results`` that isn't used isn't written
    keyed = saved(docs.select(F.col(id_col).alias("id"), F.xxhash64(body).alias("key")), "keyed")
    results = results if digest is None else results.select("key", "n_bytes", "n_removed", *digest)
    return keyed.join(saved(results, "results").hint("merge"), "key").drop("key")
