"""Benchmark decontamination with an Aho-Corasick automaton over normalised test items.

Normalisation lower-cases A-Z and keeps words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A window is ``width``
consecutive words of an item; an item of fewer words, but not none, is one window.  The automaton runs over word
numbers, so one pass over a text finds every occurrence of every window, overlapping ones included, and the hit words
are mapped back to code points of the original.

The documents are never shuffled: the automaton travels.  Its size is bounded by ``max_words``; a larger benchmark is
cut into blocks by item, and one pass per block follows in the same stage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, raw_texts

#: Item words in one automaton.  2,000,000 words of 13-word windows take some 250 MB in a worker.
MAX_WORDS = 500_000
#: Bytes that end a word, and the lower case of A-Z, as one translation.
_CUT = bytes(
    LOWER[c] if c >= 0x80 or 0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: An item without id still marks words; this is the name it gets.
NO_ID = "null"


def words_of(text: bytes) -> list[bytes]:
    """Normalised words of UTF-8 bytes."""
    return text.translate(_CUT).split()


def windows_of(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


def build(items: list[tuple[str, bytes]], width: int) -> dict:
    """The automaton over word numbers, with the items that own each window."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = {}
    for name, text in items:
        for window in windows_of(words_of(text), width):
            owners.setdefault(tuple(numbers.setdefault(w, len(numbers) + 1) for w in window), set()).add(name)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window, names in owners.items():
        automaton.add_word(window, (len(window), tuple(sorted(names))))
    automaton.make_automaton()
    return {"numbers": numbers, "automaton": automaton if owners else None}


def _marks(text: bytes, block: dict) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words, hit runs [first, last + 1) in words, and the items met."""
    words = words_of(text)
    if block["automaton"] is None or not words:
        return len(words), [], set()
    found = block["automaton"].iter(tuple(map(block["numbers"].get, words, repeat(0))))
    runs, names = [], set()
    for last, (size, owners) in found:
        names.update(owners)
        first = last - size + 1
        while runs and runs[-1][1] >= first:
            first = min(first, runs.pop()[0])
        runs.append((first, last + 1))
    return len(words), runs, names


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", _SPANS)]
)
_DDL = "struct<n_words: bigint, n_hit: bigint, items: array<string>, spans: array<struct<start: bigint, end: bigint>>>"


def scan(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 13,
    max_words: int = MAX_WORDS,
    out: str = "found",
) -> DataFrame:
    """``docs`` with a struct column ``out`` (n_words, n_hit, items, spans); all columns and rows stay.

    ``items`` is sorted by name, ``spans`` are code points of the original text, merged.  A null text has no words, a
    null item text no windows, a null item id the name ``null``; repeated items count once.  A column of ``docs`` that
    is already called ``out`` is an error.
    """
    if out in docs.columns:
        raise ValueError(f"the documents already have a column {out}")
    spark = docs.sparkSession
    picked = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit(NO_ID)).alias("name"),
        F.coalesce(F.col(item_text), F.lit("")).alias("body"),
    )
    total = picked.agg(F.sum(F.length("body") + 1)).first()[0] or 0
    # a word takes two characters at least, so a block of 2 * max_words characters keeps the bound
    blocks = max(1, -(-int(total) // (2 * max_words)))
    part = F.pmod(F.xxhash64("name"), F.lit(blocks))
    result = docs
    for k in range(blocks):
        rows = picked.where(part == k).collect() if blocks > 1 else picked.collect()
        shared = spark.sparkContext.broadcast({"items": [(r["name"], r["body"].encode()) for r in rows]})
        result = _pass(result, shared, text_col, width, out, first=k == 0)
    return result


def _pass(docs: DataFrame, shared, text_col: str, width: int, out: str, first: bool) -> DataFrame:
    keep = [c for c in docs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        if "block" not in state:  # once per worker, the broadcast's value lives as long as the worker
            state["block"] = build(state["items"], width)
        block = state["block"]
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            old = None if first else batch.column(batch.schema.get_field_index(out)).to_pylist()
            rows = []
            for i, text in enumerate(raw_texts(column)):
                n, runs, names = _marks(text, block)
                if old is not None and (runs or old[i]["spans"]):
                    names |= set(old[i]["items"])
                    hits, spans = _mapped(text, runs, old[i]["spans"])
                else:
                    hits, spans = _mapped(text, runs, [])
                rows.append({"n_words": n, "n_hit": hits, "items": sorted(names), "spans": spans})
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(rows, _FOUND)], [*keep, out])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.mapInArrow(run, f"{fields}, `{out}` {_DDL}")


def _mapped(text: bytes, runs: list[tuple[int, int]], spans: list[dict]) -> tuple[int, list[dict]]:
    """Number of hit words and their code point spans, joined with the spans of earlier blocks."""
    if not runs and not spans:
        return 0, []
    places = [m.span() for m in _WORD.finditer(text.translate(LOWER).decode())]
    hit = np.zeros(len(places), bool)
    for first, end in runs:
        hit[first:end] = True
    if spans:
        starts = np.array([p[0] for p in places])
        for s in spans:
            hit[np.searchsorted(starts, s["start"]) : np.searchsorted(starts, s["end"])] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return int(hit.sum()), [
        {"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())
    ]


def contaminated(found: str = "found"):
    """Contaminated: some word is hit, and one word in twenty or more."""
    hit, words = F.col(f"{found}.n_hit"), F.col(f"{found}.n_words")
    return (hit > 0) & (hit * 20 >= words)
