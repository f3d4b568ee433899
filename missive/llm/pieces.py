"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The text is read once, code point by code point.  For each position the best score and a backpointer are kept; no
piece is longer than ``longest``, so only the last ``longest`` positions can still be extended.  When the backpointer
paths of all of them meet in one position, the ids up to there are final and leave the window.  Memory is bounded by
that window, however long the text.

Scores are those of a unigram model.  A model of merge ranks (BPE) has no probabilities: its pieces, in the order of
their scores, then get Zipf's, log(1 / (rank * H)).  Characters that no piece has are spelled in byte pieces, the
sign U+2581 itself as well, so decoding restores every text exactly.

Short runs recur, so a run between two positions that no piece of the vocabulary can span is looked up in a bounded
memo first; the search itself only sees a run once in a while, and then whole, without a window.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_parts, raw_texts

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Pieces in a vocabulary that is sent to the workers.
MAX_PIECES = 1_000_000
#: Runs of a memo's generation, of which a worker holds two.  Longer runs are never remembered.
MEMO_RUNS, MEMO_CHARS = 150_000, 64
#: An unknown character costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0
_LETTER, _OTHER = r"[^\W\d_²³¹]", r"(?:[\W\d_²³¹])"
#: Runs end where a letter meets another character, before a space, and around line breaks ...
_RUN = re.compile(rf"\n| *{_LETTER}+| *(?:(?![ \n]){_OTHER})+| +")
#: ... provided that no piece of the vocabulary has such a place inside.
_SPANNED = re.compile(rf"\n|[^ ] |{_LETTER}{_OTHER}|(?! ){_OTHER}{_LETTER}")
#: Scores are whole millionths, so that sums are exact and ties don't depend on where a search began.
UNIT = 1_000_000


def load(model_file: str) -> dict:
    """The vocabulary as plain tables: pieces with ``▁`` read as a space, scores, byte pieces, surface bytes."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model_file)
    size = sp.vocab_size()
    if size > MAX_PIECES:
        raise ValueError(f"{size} pieces; at most {MAX_PIECES} are sent to the workers")
    normal = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    scores = {i: sp.get_score(i) for i in normal}
    ranks = all(s <= 0 and float(s).is_integer() for s in scores.values())  # merge ranks, not probabilities
    if ranks:
        order = sorted(normal, key=lambda i: (-scores[i], i))
        harmonic = sum(1 / r for r in range(1, len(order) + 1))
        scores = {i: -math.log(r * harmonic) for r, i in enumerate(order, 1)}
    surface = [b""] * size
    bytes_: list[int] = [-1] * 256
    pieces: dict[str, tuple[float, int]] = {}
    for i in range(size):
        if sp.is_byte(i):
            value = int(sp.id_to_piece(i)[3:5], 16)
            bytes_[value], surface[i] = i, bytes([value])
    for i in normal:
        text = sp.id_to_piece(i).replace("▁", " ")
        pieces[text], surface[i] = (round(scores[i] * UNIT), i), text.encode()
    if -1 in bytes_:
        raise ValueError("the model has no byte pieces, so some texts can't be restored")
    # every prefix of a piece, with (score, id) where it is a piece itself
    prefixes = {p[:k]: None for p in pieces for k in range(1, len(p))} | pieces
    return {
        "pieces": prefixes,
        "bytes": bytes_,
        "surface": surface,
        "longest": max(map(len, pieces)),
        "unknown": round((min(scores.values()) - UNKNOWN_PENALTY) * UNIT),
        "cuts": not any(_SPANNED.search(p) for p in pieces),
    }


def viterbi(text: str, model: dict) -> Iterator[list[int]]:
    """Lists of final ids, in order.  Of equal scores the later start (the shorter last piece) wins.

    The window holds positions ``base`` to ``base + len(best) - 1``; those without a score yet hold None.
    """
    look, longest, unknown, bytes_ = model["pieces"].get, model["longest"], model["unknown"], model["bytes"]
    base, size = 0, len(text)
    best: list = [0]
    back, ids = [0], [-1]
    for at in range(size):
        here = at - base
        score = best[here]
        known = False
        for end in range(at + 1, min(at + longest, size) + 1):
            piece = look(text[at:end], 0)
            if piece == 0:
                break
            while len(best) <= end - base:
                best.append(None)
                back.append(0)
                ids.append(-1)
            if piece is not None:
                known = known or end == at + 1
                old, new = best[end - base], score + piece[0]
                if old is None or new >= old:
                    best[end - base], back[end - base], ids[end - base] = new, at, piece[1]
        if not known:
            while len(best) <= here + 1:
                best.append(None)
                back.append(0)
                ids.append(-1)
            old, new = best[here + 1], score + unknown
            if old is None or new >= old:
                best[here + 1], back[here + 1], ids[here + 1] = new, at, -1
        if here >= 2 * longest:
            # positions ahead that a path has reached; what they share is final
            alive = {k + base for k in range(here + 1, len(best)) if best[k] is not None}
            while len(alive) > 1 and max(alive) > base:
                last = max(alive)
                alive.discard(last)
                alive.add(back[last - base])
            meet = alive.pop()
            if meet > base:
                yield _trace(text, base, meet, back, ids, bytes_)
                cut = meet - base
                best, back, ids, base = best[cut:], back[cut:], ids[cut:], meet
    if size > base:
        yield _trace(text, base, size, back, ids, bytes_)


def _trace(text: str, base: int, end: int, back: list[int], ids: list[int], bytes_: list[int]) -> list[int]:
    out: list[int] = []
    while end > base:
        if ids[end - base] < 0:
            out.extend(bytes_[b] for b in reversed(text[end - 1 : end].encode()))
        else:
            out.append(ids[end - base])
        end = back[end - base]
    return out[::-1]


def best_path(run: str, model: dict) -> list[int]:
    """The ids that ``viterbi`` finds, of a short text that needs no window."""
    look, unknown, size = model["pieces"].get, model["unknown"], len(run)
    best, back, ids = [-math.inf] * (size + 1), [0] * (size + 1), [-1] * (size + 1)
    best[0] = 0
    for at in range(size):
        score, end = best[at], at + 1
        piece = look(run[at:end], 0)
        if not piece and score + unknown >= best[end]:  # no piece of one character
            best[end], back[end], ids[end] = score + unknown, at, -1
        while piece != 0:
            if piece is not None:
                value, name = piece
                if score + value >= best[end]:
                    best[end], back[end], ids[end] = score + value, at, name
            if end == size:
                break
            end += 1
            piece = look(run[at:end], 0)
    return _trace(run, 0, size, back, ids, model["bytes"])


class Memo(dict):
    """Ids of short runs as bytes of 32-bit numbers, filled by the search.

    When it is full it becomes the older generation; runs that come again move to the new one, the others are forgotten.
    """

    def __init__(self, model: dict):
        self.model, self.older = model, {}

    def __missing__(self, run: str) -> bytes:
        short = len(run) <= MEMO_CHARS
        ids = self.older.get(run)
        if ids is None:
            found = best_path(run, self.model) if short else chain.from_iterable(viterbi(run, self.model))
            ids = array("i", found).tobytes()
        if short:
            if len(self) >= MEMO_RUNS:
                self.older = dict(self)
                self.clear()
            self[run] = ids
        return ids


def encode_text(text: str, model: dict, memo: Memo) -> np.ndarray:
    """Ids of one text.  A space is put in front, as the model's normaliser does; an empty text has no ids."""
    if not text:
        return np.empty(0, np.int32)
    text = " " + text
    if not model["cuts"]:
        return np.fromiter(chain.from_iterable(viterbi(text, model)), np.int32)
    return np.frombuffer(b"".join(map(memo.__getitem__, _RUN.findall(text))), np.int32)


def decode_ids(ids: list[int] | np.ndarray, surface: list[bytes]) -> str:
    """The text of ids of this vocabulary.  Ids outside it and control ids spell nothing."""
    ids = np.asarray(ids, np.int64)
    known = ids[(ids >= 0) & (ids < len(surface))].tolist()
    return b"".join(map(surface.__getitem__, known)).decode("utf-8", "replace").removeprefix(" ")


def _field(docs: DataFrame, name: str) -> str:
    return f"`{name}` {docs.schema[name].dataType.simpleString()}"


def encode(
    docs: DataFrame,
    model_file: str = DEFAULT_MODEL,
    text_col: str = "text",
    out: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` with the array column ``out``.  A null text is encoded as an empty one: no ids.

    ``decoded`` names a further column for the text that these ids spell, so that both ways share a worker.

    No shuffle; other columns stay.  A column that is already called ``out`` or ``decoded`` is an error.
    """
    for name in (out, decoded):
        if name in docs.columns:
            raise ValueError(f"the documents already have a column {name}")
    shared = docs.sparkSession.sparkContext.broadcast(load(model_file))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        memo = model.setdefault("memo", None) or Memo({k: v for k, v in model.items() if k != "memo"})
        model["memo"] = memo  # lives as long as the worker keeps the broadcast
        for batch in (part for whole in batches for part in in_parts(whole, names.index(text_col))):
            column = batch.column(names.index(text_col))
            rows = [encode_text(t.decode(), model, memo) for t in raw_texts(column)]
            ends = np.cumsum([0, *map(len, rows)])
            flat = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32), pa.int32())
            added = {out: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)}
            if decoded:
                added[decoded] = pa.array([decode_ids(row, model["surface"]) for row in rows], pa.string())
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, *added.values()], [*names, *added])

    fields = ", ".join([*(_field(docs, c) for c in names), f"`{out}` array<int>"])
    return docs.mapInArrow(run, f"{fields}, `{decoded}` string" if decoded else fields)


def decode(
    docs: DataFrame, model_file: str = DEFAULT_MODEL, ids_col: str = "ids", out: str = "decoded"
) -> DataFrame:
    """``docs`` with the string column ``out``.  Null ids are decoded as none: an empty text."""
    if out in docs.columns:
        raise ValueError(f"the documents already have a column {out}")
    shared = docs.sparkSession.sparkContext.broadcast(load(model_file)["surface"])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surface = shared.value
        for batch in batches:
            column = batch.column(names.index(ids_col))
            numbers = column.values.fill_null(-1).to_numpy()
            ends = column.offsets.to_numpy().tolist()
            empty = column.is_null().to_pylist()
            texts = [
                "" if empty[k] else decode_ids(numbers[ends[k] : ends[k + 1]], surface) for k in range(len(column))
            ]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], [*names, out])

    fields = ", ".join(_field(docs, c) for c in names)
    return docs.mapInArrow(run, f"{fields}, `{out}` string")
