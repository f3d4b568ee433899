"""Near-copies by Jaccard similarity of five-word shingles, against all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from missive.llm import near


def brute_sets(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_near(texts):
    sets, root = [brute_sets(x) for x in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def copies(seed, bases=8, words=160):
    """Texts and copies with some words replaced: the pairs lie between 0.3 and 0.99."""
    random.seed(seed)
    out = []
    for _ in range(bases):
        base = [f"w{random.randrange(10**6)}" for _ in range(words)]
        out.append(" ".join(base))
        for changes in (1, 2, 3, 4, 5, 6, 8):
            edited = list(base)
            for at in random.sample(range(words), changes):
                edited[at] = f"x{random.randrange(10**6)}"
            out.append(" ".join(edited))
        out.append(" ".join(base[: words * 4 // 5]))
        out.append(" ".join(base + [f"y{k}" for k in range(random.randrange(1, 60))]))
    return out


def test_classes_equal_those_of_all_pairs(docs):
    hub = copies(3, 1, 146)[0].split()
    crowd = []  # one text often, each with other words replaced: classes over chains, and some copies left alone
    for _ in range(150):
        edited = list(hub)
        for at in random.sample(range(len(hub)), random.randrange(1, 12)):
            edited[at] = f"z{random.randrange(10**6)}"
        crowd.append(" ".join(edited))
    exact = ["a b c d e f g h i", "a b c d e f g h", "a b c d e f g h i j", "a b c d", "A  b c\nd", "", None, " \n"]
    texts = copies(1) + crowd + exact
    got = {r["id"]: r["component"] for r in near.classes(docs(texts)).collect()}
    assert [got[k] for k in range(len(texts))] == brute_near(texts)


@pytest.mark.parametrize("least", [0.8, 0.9, 0.97])
def test_stage_finds_planted_near_copies(spark, docs, small, least):
    """Of a text and a copy at 0.8 to 0.99 one stays; three-word fingerprints at two bits kept nearly all."""
    random.seed(int(least * 100))
    rows, pairs = [], 0
    while pairs < 30:
        base = [f"w{random.randrange(10**6)}" for _ in range(200)]
        edited = list(base)
        for at in random.sample(range(200), random.randrange(1, 5)):
            edited[at] = f"x{random.randrange(10**6)}"
        a, b = brute_sets(" ".join(base)), brute_sets(" ".join(edited))
        if len(a & b) / len(a | b) >= least:
            rows += [(2 * pairs, " ".join(base)), (2 * pairs + 1, " ".join(edited))]
            pairs += 1
    kept = {r["doc_id"] for r in corpus_pipeline.one_of_each_class(spark, docs(rows), small).collect()}
    assert kept == set(range(0, 60, 2))


def test_bounds_never_exceed_the_difference():
    texts = copies(7, 2, 60) + copies(8, 2, 300)
    sets = [near.shingles(x.encode()) for x in texts]
    members = near.Members(np.array([len(x) for x in sets]), [near.sketch(x) for x in sets])
    for k, a in enumerate(sets):
        bounds = members.bounds(k)
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            if 9 * both >= 4 * (len(a) + len(b)):
                assert bounds[j] <= len(a) + len(b) - 2 * both


def test_empty_table(docs):
    assert near.classes(docs([])).collect() == []


def test_lists_hold_what_can_be_similar_only():
    """Of two sets with a shingle in common one list holds both if sizes and places allow it; far sizes make no list."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    s, n = rng.integers(-40, 40, 600), rng.integers(1, 300, 600)
    at = (rng.random(600) * [near.prefix_length(int(k)) for k in n]).astype(np.int64)
    most = np.array([near.largest(int(k), a) for k, a in zip(n, at)])
    order = np.lexsort((n, s))
    columns = [x[order] for x in (s, np.arange(600), n, most)]
    for rows in (1, 7, 600):
        parts = [pa.RecordBatch.from_arrays([pa.array(x[k : k + rows]) for x in columns], ["s", "node", "n", "most"])
                 for k in range(0, 600, rows)]
        lists = {}
        for batch in near._shared(iter(parts)):
            for key, node in zip(*(c.to_pylist() for c in batch.columns)):
                lists.setdefault(key, set()).add(node)
        together = {(a, b) for found in lists.values() for a in found for b in found}
        for a in range(600):
            for b in range(a):
                if s[a] == s[b] and n[a] <= most[b] and n[b] <= most[a]:
                    assert (a, b) in together
        assert all(len(found) > 1 for found in lists.values())
        assert sum(map(len, lists.values())) < 500
    far = pa.RecordBatch.from_arrays([pa.array(x) for x in ([1, 1], [1, 2], [10, 20], [12, 25])], ["s", "node", "n", "most"])
    assert sum(b.num_rows for b in near._shared(iter([far]))) == 0


def test_largest_is_the_largest_similar_size():
    for n in range(1, 60):
        for at in range(near.prefix_length(n)):
            fits = [m for m in range(1, 100) if 9 * min(n - at, m) >= 4 * (n + m)]
            assert near.largest(n, np.array([at]))[0] >= max(fits, default=0)


def test_leaders_settle_lists_of_two(docs, monkeypatch):
    """Pairs that share shingles but aren't similar are compared in the first turn and never again."""
    kept, plain = [], near.saved
    monkeypatch.setattr(near, "saved", lambda df, name: kept.append((name, plain(df, name))) or kept[-1][1])
    rows = []
    monkeypatch.setattr(near, "sweep", lambda *_: rows.append([t.count() for n, t in kept if n == "rooted"]))
    texts = copies(11, 1, 100)[:3]
    for k in range(20):
        common = [f"c{k}{j}" for j in range(60)]
        texts += [" ".join([*common, *(f"{side}{k}{j}" for j in range(20))]) for side in "ab"]
    found = near.classes(docs(texts)).collect()
    assert [r["component"] for r in sorted(found, key=lambda r: r["id"])] == brute_near(texts)
    assert rows[-1][0] > 0 and all(n < rows[-1][0] for n in rows[-1][1:])
