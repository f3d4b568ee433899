import re

import pytest

from missive.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(texts, items, width):
    windows = {}
    for name, body in items:
        words = WORD.findall(lowered(body))
        for i in range(max(1, len(words) - width + 1)) if words else ():
            windows.setdefault(tuple(words[i : i + width]), set()).add("null" if name is None else str(name))
    out = []
    for text in texts:
        low = lowered(text)
        places = [m.span() for m in WORD.finditer(low)]
        words = [low[a:b] for a, b in places]
        hit, names = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                owners = windows.get(tuple(words[i : i + size]))
                if owners:
                    hit.update(range(i, i + size))
                    names |= owners
        out.append((len(words), len(hit), sorted(names), [places[i] for i in sorted(hit)]))
    return out


ITEMS = [
    (1, "Alpha beta, gamma delta"), (2, "short one"), (3, None), (4, ""), (None, "no id item"), (2, "short one"),
    (5, "beta gamma delta epsilon zeta"), (6, "!!"), (7, "été straße"),
]
TEXTS = [
    "ALPHA-beta gamma... delta epsilon zeta eta", "a short ONE and no ID item", "Été STRAßE été straße", "alpha beta",
    "beta gamma delta epsilon " * 30 + "zeta", "short\x1fone\x00short one", "ÉTÉ straße",
]


@pytest.mark.parametrize("max_words", [1_000_000, 8])
def test_scan_is_the_brute_force(spark, docs, edges, max_words):
    texts = TEXTS + edges
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontam.scan(docs(texts), items, width=3, max_words=max_words).collect()
    wanted = brute(texts, ITEMS, 3)
    assert len(got) == len(texts)
    for row in got:
        n, hits, names, places = wanted[row["doc_id"]]
        found = row["found"]
        assert (found["n_words"], found["n_hit"], found["items"]) == (n, hits, names)
        inside = [p for p in places if any(s["start"] <= p[0] and p[1] <= s["end"] for s in found["spans"])]
        assert inside == places


def test_rule_empty_tables_and_clashes(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    far = "w " * 38 + "short one"
    flags = decontam.scan(docs([far, far + " w", "none"]), items, width=13)
    rows = {r["doc_id"]: r["bad"] for r in flags.select("doc_id", decontam.contaminated().alias("bad")).collect()}
    assert rows == {0: True, 1: False, 2: False}
    assert decontam.scan(docs([]), items).count() == 0
    assert decontam.scan(docs(["a b"]), items.limit(0)).first()["found"]["n_hit"] == 0
    with pytest.raises(ValueError, match="already"):
        decontam.scan(docs(["a"]).withColumnRenamed("lang", "found"), items)
    clash = docs(["short one"]).withColumnRenamed("lang", "item_id")
    assert decontam.scan(clash, items).first()["found"]["items"] == ["2"]


def test_no_shuffle(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = decontam.scan(source, items)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
