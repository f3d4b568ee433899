"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from missive.llm import trie
from missive.llm.queries import op12_trie

DDL = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def told(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest(), role, text


def in_order(rows):
    own = {}
    for row in rows:
        if row[0] is not None:
            own.setdefault(row[0], []).append(row)
    for c, found in own.items():
        found.sort(key=lambda r: (r[1] is not None, r[1] or 0, told(r)[0]))
        own[c] = [told(r)[1:] for r in found]
    return own


def brute_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    """The rows of the trie of {conv: [(role, text)]}."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    leaves, tokens = {}, {}
    for key in sorted(members, key=len, reverse=True):
        kids = children.get(key, [])
        text = key[-1][1] if key else ""
        words = len([w for w in text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w])
        leaves[key] = sum(leaves[k] for k in kids) or 1
        tokens[key] = (len(members[key]) - 1) * words + sum(tokens[k] for k in kids)
    out = []
    for key, own in members.items():
        last = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(key))))
        parent = min(members[key[:-1]]) if key else None
        out.append(
            (min(own), len(key), parent, len(own), len(children.get(key, [])), leaves[key], tokens[key],
             hashlib.sha256(last.encode()).hexdigest())
        )
    return sorted(out, key=str)


def plain(found):
    return sorted((tuple(r) for r in found.select(COLUMNS).collect()), key=str)


def test_query_against_plain_trie(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").collect()]
    expected = brute(brute_rebuilt(in_order(rows)))
    found = op12_trie(spark, small)
    assert found.columns == COLUMNS
    assert plain(found) == expected


def test_hot_nulls_ties_repeats_and_clashing_columns(spark, edges):
    draw = random.Random(5)
    rows = []
    for c in [None, -41, -5, *range(0, 90), 10_000_000_007]:
        for t in range(draw.choice([0, 1, 2, 4, 6])):
            role, text = draw.choice(["user", "a", None, ""]), draw.choice(["same one", "", None, "two\twords"])
            rows.append((c, draw.choice([t, t, None, 1]), role, text))
    rows += [(20 * k, 0, "user", x) for k, x in enumerate(edges)] + rows[:20]
    own = spark.createDataFrame(rows, DDL)
    own = own.withColumns({c: F.lit(7) for c in ("conv", "depth", "h", "words", "pos", "n", "chunk", "node", "_row")})
    found = trie.sequences(own)
    assert plain(trie.trie(*trie.rebuilt(*found), limit=3, chunk=2)) == brute(brute_rebuilt(in_order(rows)))
    assert plain(trie.trie(*found)) == brute(in_order(rows))
    assert trie.trie(*trie.rebuilt(*trie.sequences(own.limit(0)))).count() == 0


def test_deep_conversations_halve(spark):
    """A chain of 300 turns with branches: components of four nodes at most, chunks of seven turns."""
    rows = [(1, t, "u", f"w {t}") for t in range(300)]
    for c, d in ((2, 299), (3, 150), (4, 150), (5, 10), (6, 300)):
        rows += [(c, t, "u", f"w {t}") for t in range(d)] + [(c, d + k, "u", f"own {c % 2}") for k in range(20)]
    found = trie.sequences(spark.createDataFrame(rows, DDL))
    assert plain(trie.trie(*found, limit=40, chunk=7)) == brute(in_order(rows))


def test_lists_of_ends_over_several_rows(spark):
    steps = spark.createDataFrame([(c, 1, b"x") for c in range(0, 2_000, 3)] + [(5_001, 1, b"y")], "conv bigint, depth int, node binary")
    convs = steps.select("conv", F.lit(1).alias("len"))
    found = {bytes(r["node"]): r["ends_sha256"] for r in trie.ends(steps, convs, 100).collect()}
    listed = {b"x": range(0, 2_000, 3), b"y": [5_001]}
    assert found == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in listed.items()}
