import hashlib

import numpy as np
import pytest

from missive.llm import digest


def test_digest_and_spelling():
    one = digest.digest(b"the quick brown fox jumps over the lazy dog" * 20)
    assert (digest.read(digest.spelled(one)) == one).all()
    assert len(digest.spelled(one)) == 132
    assert (one == digest.digest(b"the quick brown fox jumps over the lazy dog" * 20)).all()
    assert digest.likeness(one, one) == 1.0
    assert (digest.counts(b"ab") == 0).all()
    assert digest.counts(b"abcd" * 1000).sum() == 3998
    far = digest.digest(bytes(range(256)) * 40)
    assert 0.0 <= digest.likeness(one, far) < 0.5


def test_chunks_count_every_triplet_once(monkeypatch):
    text = np.random.default_rng(1).integers(0, 256, (1 << 20) + 7, dtype=np.uint8).tobytes()
    assert digest.counts(text).sum() == len(text) - 2


@pytest.mark.parametrize("slices", [1, 7])
def test_against_next_is_the_brute_force(docs, edges, slices):
    rows = [(k * 3, x) for k, x in enumerate(edges)]
    got = {r["id"]: r for r in digest.against_next(docs(rows, slices)).collect()}
    texts = [x or "" for _, x in rows]
    for k, (id_, _) in enumerate(rows):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        moved = len(text) // 4
        edited = text[: len(text) - moved] + after[:moved]
        row = got[id_]
        codes = [digest.digest(x.encode()) for x in (text, edited, after)]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == digest.spelled(codes[0])
        assert row["edited_fingerprint"] == digest.spelled(codes[1])
        assert row["near_edited"] == digest.likeness(codes[0], codes[1])
        assert row["near_next"] == digest.likeness(codes[0], codes[2])
    assert got[12]["fingerprint"] == got[15]["fingerprint"]


def test_one_row_no_row_and_repeated_ids(docs):
    assert digest.against_next(docs([(5, "alone here")])).first()["near_next"] == 1.0
    assert digest.against_next(docs([])).collect() == []
    assert digest.against_next(docs([(1, "a"), (1, "a"), (1, "b"), (None, "c")])).count() == 4
    assert digest.fingerprints(docs(["a", None, ""])).count() == 3


def test_an_edit_is_nearer_than_another_text(spark, small):
    rows = digest.against_next(spark.read.parquet(f"{small}/documents.parquet")).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.9 * len(rows)
