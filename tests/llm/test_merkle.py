"""The Merkle manifest against a plain rebuild of every tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from missive.llm import merkle
from missive.llm.queries import op13_merkle


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def levels(hashes):
    out = [list(hashes)]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def steps(tree, i):
    for level in tree[:-1]:
        first = i // 8 * 8
        run = level[first : first + 8]
        yield i - first, run[: i - first] + run[i - first + 1 :]
        i //= 8


def brute(rows, altered=lambda row: row):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda x: b"" if x is None else b"=" + x.encode())
    trees, sorted_rows = {}, {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        sorted_rows[name], trees[name] = own, levels(map(leaf, own))
    top = levels(trees[name][-1][0] for name in names)
    out = []
    for place, name in enumerate(names):
        for i, row in enumerate(sorted_rows[name]):
            way = [*steps(trees[name], i), *steps(top, place)]
            node = leaf(altered(row))
            for at, others in way:
                node = sha(*others[:at], node, *others[at:])
            proof = sha(*(h for _, others in way for h in others))
            out.append((row[0], leaf(row), trees[name][-1][0], top[-1][0], proof, node))
    return out


def plain(found):
    columns = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    return sorted((tuple(r) for r in found.select(columns).collect()), key=str)


def lowered(row):
    if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 3:
        return row
    return (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))


def test_missing_coordinates():
    for count in (1, 2, 8, 9, 64, 65, 700):
        for start, end in ((0, 1), (count - 1, count), (0, count), (count // 3, count // 2 + 1)):
            known = {(0, i) for i in range(start, end)}
            lacks = merkle.missing(start, end, count)
            assert len(set(lacks)) == len(lacks) and not known & set(lacks)
            known |= set(lacks)
            n, level = count, 0
            while n > 1:  # with them, and only with all of them, the way up can be derived
                start, end = start // 8, (end - 1) // 8 + 1
                for i in range(start, end):
                    run = {(level, j) for j in range(8 * i, min(8 * i + 8, n))}
                    assert run <= known
                    known.add((level + 1, i))
                n, level = -(-n // 8), level + 1
            assert (level, 0) in known


def test_query_against_plain_trees(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    expected = [(*r, r[5] == r[3]) for r in brute(rows, lowered)]
    found = [tuple(r) for r in op13_merkle(spark, small).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("count", [1, 8, 9, 513, 4_100])
def test_heights(spark, count):
    rows = [(i, "s", "en" if i % 50 else "de", i, f"Text {i}") for i in range(count)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    found = merkle.prove(docs, altered={"text": F.lower("text")}, with_proofs=True)
    assert plain(found) == sorted(brute(rows, lambda r: (*r[:4], r[4].lower())), key=str)
    for row in found.limit(5).collect():
        assert sha(*row.proof) == row.proof_sha256


def test_nulls_ties_repeats_and_clashing_columns(spark, edges):
    rows = [(None if i % 7 == 0 else i // 3, None if i % 2 else "s", (None, "", "en", "é", "=")[i % 5], None, x)
            for i, x in enumerate(edges * 3)]
    rows += rows[:9]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    clashing = docs.withColumns({c: F.lit("x") for c in ("tree", "pos", "n", "hash", "block", "id", "_tie", "_part")})
    assert plain(merkle.prove(clashing)) == sorted(brute(rows), key=str)
    assert merkle.prove(docs.limit(0)).count() == 0


def test_every_node_of_the_manifest(spark):
    leaves = spark.range(700).select(
        F.lit("=en").alias("tree"), F.col("id").alias("pos"), F.lit(700).cast("bigint").alias("n"),
        F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("hash"),
    )
    found = {(r["level"], r["idx"]): r["hash"].hex() for r in merkle.nodes(leaves, every=True).collect()}
    tree = levels(sha(str(i)) for i in range(700))
    assert found == {(k, i): h for k, level in enumerate(tree) if k for i, h in enumerate(level)}
