import random

from xxhash import xxh64_intdigest

from missive.llm import simhash
from missive.llm.common import components


def brute_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ")]
    words = [w for part in words for w in part.replace("\t", "\n").replace("\r", "\n").replace("\x0b", "\n").replace("\x0c", "\n").split("\n") if w]  # noqa: E501
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_classes(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_and_classes(docs, edges):
    random.seed(3)
    base = [" ".join(random.choice(["ab", "cd", "Ef", "gé", "ij", "kl"]) for _ in range(80)) for _ in range(6)]
    near = [b + " zz" for b in base] + [b.upper() for b in base] + base
    texts = edges + base + near
    got = {r["id"]: r for r in simhash.classes(docs(texts)).collect()}
    prints = [brute_print(x) for x in texts]
    assert [got[k]["fp"] % (1 << 64) for k in range(len(texts))] == prints
    assert [got[k]["component"] for k in range(len(texts))] == brute_classes(prints)


def test_links_over_chains_and_crowded_cells(spark):
    """Fingerprints within two bits of each other, in chains, at the sign bit, and thousands in one ball."""
    random.seed(5)
    prints = {0, 1 << 63, (1 << 64) - 1}
    for _ in range(40):
        at = random.getrandbits(64)
        for _ in range(12):
            prints.add(at)
            at ^= 1 << random.randrange(64)
            at ^= 1 << random.randrange(64)
    hub = random.getrandbits(64)
    prints |= {hub ^ 1 << a ^ 1 << b for a in range(0, 64, 2) for b in range(1, 64, 3)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    distinct = spark.createDataFrame(signed, "fp bigint")
    roots = {r["node"] % (1 << 64): r["root"] for r in components(simhash.links(distinct)).collect()}
    wanted = brute_classes(prints)
    classes = {}
    for p, w in zip(prints, wanted):
        classes.setdefault(w, []).append(p)
    for members in classes.values():
        if len(members) > 1:
            assert len({roots[m] for m in members}) == 1
        else:
            assert members[0] not in roots
    assert len({roots[m[0]] for m in classes.values() if len(m) > 1}) == sum(len(m) > 1 for m in classes.values())


def test_popcounts_bound_the_distance(spark):
    rows = spark.createDataFrame([(random.getrandbits(64) - (1 << 63),) for _ in range(200)], "fp bigint")
    for r in rows.select("fp", simhash.popcounts(rows["fp"]).alias("p")).collect():
        fp, packed = r["fp"] % (1 << 64), r["p"] % (1 << 64)
        assert all((packed >> 2 * k & 3) == (fp >> 2 * k & 3).bit_count() for k in range(32))


def test_nulls_ties_and_empty(docs):
    assert simhash.classes(docs([])).collect() == []
    rows = simhash.classes(docs([(None, "a b"), (7, "a b"), (7, "a b"), (3, None), (9, "")])).collect()
    assert sorted((r["id"] or 0, r["component"]) for r in rows) == [(0, 7), (3, 3), (7, 7), (7, 7), (9, 3)]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 901), (5, 5)], "a bigint, b bigint")
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    assert all(roots[k] == 0 for k in range(301)) and roots[901] == 900
    assert components(edges.limit(0)).count() == 0
