import random
import re

import pytest
from pyspark.sql import functions as F

from missive.llm import pii, secrets, weak
from missive.llm.spans import located, matches, pieces

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def fits(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    spans = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        spans += [(m.start(), n, m.end()) for m in re.finditer(pattern, text or "") if fits(kind, m.group())]
    return ",".join(f"{pii.KINDS[n]}:{a}:{b}" for a, n, b in sorted(spans))


TEXTS = [
    "mail a.b@c.de, x@y.z.w; a@b.c%d@e.f @no a@b", "ips 1.2.3.4 256.1.1.1 001.2.3.04 1.2.3.4.5.6.7.8 9.9.9",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 79927398713", "call +1 (425) 555-0100 or +49 30 1234567",
    "\U0001F600 é +44 20 7946 0958 x@y.org 4242424242424242", "+1 (23)+4 555 123 45678", "+12345678901234567 1.1.1.1",
    "write to jane [at] mail [dot] com or 425-555-0100, version 425-555-0100", "4111111111111111 " * 600,
]


def test_base_spans_are_the_brute_force(docs, edges):
    random.seed(2)
    noise = ["".join(random.choice("a@.1 2-+()9é") for _ in range(random.randrange(60))) for _ in range(400)]
    texts = TEXTS + edges + noise
    rows = pii.detect(docs(texts)).select("id", pii.listed("base").alias("b"), pii.listed("spans").alias("s"))
    for r in rows.collect():
        assert r["b"] == brute(texts[r["id"]]), texts[r["id"]]
        assert set(filter(None, r["b"].split(","))) <= set(r["s"].split(","))


def test_empty_table_ids_and_clashing_columns(docs):
    assert pii.detect(docs([])).collect() == []
    clash = docs([(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c")]).withColumnsRenamed({"lang": "base", "source": "key"})
    assert [len(r["spans"]) for r in pii.detect(clash).collect()] == [1, 1, 1]


def test_no_python_on_executors(docs):
    found = pii.candidates(docs(["a@b.c"]))
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())


def test_spans_over_many_matches(spark):
    text = "é7 " * 1500
    row = spark.createDataFrame([(text,)], "text string").withColumn("v", matches(F.col("text"), "[0-9]"))
    row = row.withColumn("p", pieces(F.col("text"), "[0-9]", F.col("v")))
    spans = row.select(located(F.col("v"), F.col("p"), 2).alias("s")).first()["s"]
    assert [(s["start"], s["end"]) for s in spans] == [(3 * k + 1, 3 * k + 2) for k in range(1500)]
    assert spans[5]["left"] == " é"


def test_em_recovers_accuracies_and_logistic_is_stationary():
    import numpy as np

    rng = np.random.default_rng(4)
    truth = rng.random(40_000) < 0.3
    votes = np.stack([np.where(rng.random(40_000) < 0.85, 1 + truth, 2 - truth) for _ in range(5)], 1)
    votes[rng.random(votes.shape) < 0.4] = 0
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = weak.fit(patterns, counts, prior=0.5)
    assert abs(model["share"] - 0.3) < 0.03
    assert ((model["posterior"][inverse.ravel()] > 0.5) == truth).mean() > 0.85
    x, y = rng.normal(size=(500, 4)), rng.random(500)
    w = weak.logistic(x, y, np.ones(500), penalty=0.01)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    gradient = np.append(x.T @ (p - y) / 500 + 0.01 * w[:-1], (p - y).mean())
    assert np.abs(gradient).max() < 1e-5


def test_secrets(docs, spark):
    hexes = ["%040x" % random.getrandbits(160) for _ in range(60)]
    texts = [f'prose word token = "{h}" more prose' for h in hexes]
    texts += [f"prose thing {random.randrange(10**15, 10**16)} more" for _ in range(60)]
    texts += [f"see mail{k % 9}.example.com/index.html now" for k in range(60)]
    found = secrets.scan(docs(texts)).collect()
    assert len(found) == 180
    for r in found:
        assert texts[r["id"]][r["start"] : r["end"]] == r["value"]
        assert r["secret"] == (r["id"] < 60)
    assert secrets.scan(docs([])).collect() == []
    assert secrets.scan(docs([None, "", "no findings"])).collect() == []
    lone = secrets.scan(docs(["abcdefghijklmnopq1 x"])).first()
    assert (lone["chance"], lone["secret"]) == (0.5, False)
    given = spark.createDataFrame(
        [(h, 'key "', '"', 1) for h in hexes] + [(f"id-{k:016d}", "no ", " x", 0) for k in range(60)],
        "value string, left string, right string, label int",
    )
    rated = {r["value"]: r["secret"] for r in secrets.scan(docs([f'a "{hexes[0]}" b id-{7:016d} c']), given).collect()}
    assert rated == {hexes[0]: True, f"id-{7:016d}": False}


def test_secret_offsets_are_those_of_a_plain_search(docs, edges):
    texts = edges + ["a" * 15 + "1", "a" * 14 + "1", "é" + "ab1" * 9 + "é", "x=" + "Z9/" * 8 + ". end"]
    found = {(r["id"], r["start"], r["end"]) for r in secrets.scan(docs(texts)).collect()}
    wanted = set()
    for k, x in enumerate(texts):
        for m in re.finditer(r"[A-Za-z0-9_+/=.\-]+", x or ""):
            if len(m.group()) >= 16 and re.search("[0-9]", m.group()):
                wanted.add((k, m.start(), m.end()))
    assert found == wanted


@pytest.mark.parametrize("number,right", [("79927398713", True), ("79927398710", False), ("0", True)])
def test_luhn(spark, number, right):
    assert spark.range(1).select(pii.luhn(F.lit(number)).alias("x")).first()["x"] == right
