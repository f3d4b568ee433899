import hashlib
import random

import pytest

from missive.llm import lines, suffix


def brute_lines(rows, min_words):
    """Every line of a run of ``min_words`` that also starts at an earlier (id, line)."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    texts = {k: rows[k][1].split("\n") for k in order if rows[k][1] is not None}
    where, gone = {}, {k: set() for k in order}
    for rank, k in enumerate(order):
        for j, line in enumerate(texts.get(k, ())):
            best = 0
            for a, b in where.get(line, ()):
                n = 0
                while j + n < len(texts[k]) and b + n < len(texts[a]) and texts[k][j + n] == texts[a][b + n]:
                    n += 1
                best = max(best, n)
            if best and sum(len(x.encode().split()) for x in texts[k][j : j + best]) >= min_words:
                gone[k] |= set(range(j, j + best))
            where.setdefault(line, []).append((k, j))
    return gone


@pytest.mark.parametrize("seed,min_words", [(1, 1), (2, 4), (3, 9)])
def test_lines_are_the_brute_force(docs, seed, min_words):
    random.seed(seed)
    pool = [" ".join(random.choice("abcd") for _ in range(random.randrange(5))) for _ in range(9)]
    rows = [(3 * k, "\n".join(random.choice(pool) for _ in range(random.randrange(12)))) for k in range(40)]
    rows += [(500, "a b c d e\n" * 20), (501, None), (502, ""), (503, rows[0][1]), (None, rows[1][1])]
    gone = brute_lines(rows, min_words)
    got = {r["doc_id"]: r for r in lines.dedup(docs(rows), min_words=min_words).collect()}
    for k, (id_, text) in enumerate(rows):
        row = got[id_]
        if text is None:
            assert (row["text"], row["line_count"], row["removed_runs"]) == (None, 0, [])
            continue
        assert row["text"] == "\n".join(x for j, x in enumerate(text.split("\n")) if j not in gone[k])
        assert {j for r in row["removed_runs"] for j in range(r["start"], r["end"])} == gone[k]


def test_lines_ties_edges_and_clashes(docs, edges):
    assert lines.dedup(docs([])).collect() == []
    same = lines.dedup(docs([(4, "w " * 60), (4, "w " * 60)])).collect()
    assert [r["removed_runs"] for r in same] == [[], []]
    assert lines.dedup(docs(edges)).count() == len(edges)
    with pytest.raises(ValueError, match="already"):
        lines.dedup(docs(["a"]).withColumnRenamed("lang", "line_count"))
    clash = docs(["a b", "a b"]).withColumnsRenamed({"lang": "key", "source": "keeps"})
    assert lines.dedup(clash, min_words=2).count() == 2


def brute_bytes(texts, span):
    seen = {}
    for t in texts:
        for p in range(len(t) - span + 1):
            seen[t[p : p + span]] = seen.get(t[p : p + span], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - span + 1):
            if seen[t[p : p + span]] > 1:
                gone[p : p + span] = b"\1" * span
        runs = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check_bytes(docs, rows, span, gram):
    cut = suffix.dedup(docs(rows), span=span, gram=gram).collect()
    wanted = brute_bytes([(x or "").encode() for _, x in rows], span)
    got = sorted(
        (r["id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in cut
    )
    assert got == sorted((i, *w) for (i, _), w in zip(rows, wanted))


@pytest.mark.parametrize("span,gram", [(200, 40), (60, 16)])
def test_suffixes_are_the_brute_force(docs, span, gram):
    random.seed(span)

    def prose(n):
        return "".join(random.choice("abcdefg éß\n") for _ in range(n))

    passages = [prose(n) for n in (150, 199, 200, 201, 240, 400, 1000)]
    rows = []
    for k in range(60):
        body = prose(random.randrange(300))
        for _ in range(random.randrange(4)):
            p = random.choice(passages)
            a = random.randrange(40)
            body += p[a:] if random.random() < 0.3 else p
            body += prose(random.randrange(120))
        rows.append((k, body))
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, None), (103, ""), (104, "x"), (105, "x")]
    rows += [(106, "ab" * 700), (107, "z" * 900), (108, passages[6] * 2), (109, passages[2][:-1])]
    check_bytes(docs, rows, span, gram)


def test_suffixes_over_chunks(docs, monkeypatch):
    monkeypatch.setattr(suffix, "_CHUNK", 97)
    random.seed(8)
    part = "".join(random.choice("abcdef") for _ in range(700))
    check_bytes(docs, [(1, part + "q" * 300 + part), (2, "r" + part[50:600]), (3, part[::-1])], 60, 16)
    a = suffix.blocks((part * 3).encode(), 60, 16)
    monkeypatch.setattr(suffix, "_CHUNK", 1 << 20)
    assert all((x == y).all() for x, y in zip(a, suffix.blocks((part * 3).encode(), 60, 16)))


def test_suffixes_empty_and_clashing(docs):
    assert suffix.dedup(docs([])).collect() == []
    clash = docs(["x" * 300, "y"]).withColumnsRenamed({"lang": "key", "source": "copies"})
    assert sorted(r["n_removed"] for r in suffix.dedup(clash).collect()) == [0, 300]
