import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from missive.functions.text import hash_bucket
from missive.operators import embedding, tfidf
from missive.plans.prepare import Prepared
from missive.session import checkpoint

TEXTS = [
    (1, "free prize call now call"),
    (2, "call me now"),
    (3, "free free prize a b"),
    (4, "unique words only here"),
    (5, "a b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "msg_id bigint, message_clean string")


def grams(text):
    k = [w for w in text.split(" ") if len(w) >= 2]
    return k + [f"{a} {b}" for a, b in zip(k, k[1:])]


def expected_tfidf(max_features=3000, min_df=2, max_df=0.95):
    tf = {i: Counter(grams(t)) for i, t in TEXTS}
    n = len(TEXTS)
    df, cf = Counter(), Counter()
    for c in tf.values():
        df.update(c.keys())
        cf.update(c)
    kept = sorted((t for t in df if df[t] >= min_df and df[t] <= max_df * n), key=lambda t: (-cf[t], t))[:max_features]
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for i, c in tf.items():
        raw = {t: (1 + math.log(f)) * idf[t] for t, f in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(i, t): v / norm for t, v in raw.items()})
    return sorted(kept), out


@pytest.mark.parametrize("max_features", [3000, 3])
def test_tfidf(spark, docs, max_features):
    terms, weights = expected_tfidf(max_features)
    model = tfidf.TfidfFeaturizer(max_features=max_features).fit(docs)
    assert [r.term for r in model.feature_names().orderBy("idx").collect()] == terms
    assert model.vocabulary_size() == len(terms)
    got = {(r.msg_id, r.term): r.weight for r in model.transform(docs).collect()}
    assert got == {k: pytest.approx(v) for k, v in weights.items()}


def test_unseen_terms_and_empty_documents(spark, docs):
    model = tfidf.TfidfFeaturizer().fit(docs)
    new = spark.createDataFrame([(9, "call nobody"), (10, "zzz")], "msg_id bigint, message_clean string")
    assert [(r.msg_id, r.term, r.weight) for r in model.transform(new).collect()] == [(9, "call", 1.0)]
    vectors = {r.msg_id: r.features for r in model.vectors(new).collect()}
    assert vectors[9].numNonzeros() == 1 and vectors[10].numNonzeros() == 0 and vectors[10].size == 3000


def test_featurizer_contract(spark, docs, tmp_path):
    with pytest.raises(ValueError, match="not fitted"):
        tfidf.TfidfFeaturizer().transform(docs)
    with pytest.raises(ValueError, match="max_features"):
        tfidf.TfidfFeaturizer(max_features=0).fit(docs)
    model = tfidf.TfidfFeaturizer(max_features=4, sublinear_tf=False).fit(docs)
    model.save(str(tmp_path / "v"))
    again = tfidf.TfidfFeaturizer.load(spark, str(tmp_path / "v"))
    assert again.max_features == 4 and again.sublinear_tf is False
    assert sorted(again.transform(docs).collect()) == sorted(model.transform(docs).collect())


def test_exploded_terms_are_not_shuffled(spark, docs):
    counts = tfidf.term_counts(docs)
    vocab = spark.createDataFrame([("call", 0, 1.0)], "term string, idx int, idf double")
    plan = tfidf.transform(counts, vocab)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan


def test_terms_are_counted_where_they_stand(spark, docs):
    stats = tfidf.text_stats(docs)
    assert sorted(stats.collect()) == sorted(tfidf.term_stats(tfidf.term_counts(docs)).collect())
    plan = tfidf.text_stats(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(term" in plan
    vocab = spark.createDataFrame([("call",), ("free prize",)], "term string")
    known = tfidf.term_counts(docs).join(vocab, "term", "left_semi").select("msg_id", "term", "tf")
    assert sorted(tfidf.known_counts(docs, vocab).collect()) == sorted(known.collect())


def test_hash_embedding(spark, docs):
    dim = 16
    got = {r.msg_id: np.array(r.embedding) for r in embedding.hash_embedding(docs, dim).collect()}
    words = sorted({w for _, t in TEXTS for w in t.split(" ")})
    table = spark.createDataFrame([(w,) for w in words], "w string").select("w", hash_bucket(F.col("w"), dim))
    bucket = dict(table.collect())
    for i, text in TEXTS:
        expected = np.zeros(dim)
        for w in text.split(" "):
            if len(w) >= 2:
                expected[bucket[w]] += 1
        norm = np.linalg.norm(expected)
        assert got[i] == pytest.approx(expected / norm if norm else expected, abs=1e-6)


def test_plugged_in_encoder(spark, docs):
    def make():
        return lambda texts: np.array([[len(t), t.count(" ")] for t in texts], dtype=np.float32)

    generator = embedding.EmbeddingGenerator(make, dim=2)
    got = {r.msg_id: r.embedding for r in generator.generate(docs, batch_size=2).collect()}
    assert got == {i: [len(t), t.count(" ")] for i, t in TEXTS}
    assert generator.embedding_dim() == 2 and embedding.EmbeddingGenerator().embedding_dim() == 384


def test_prepared_vectors_need_no_shuffle(spark):
    """The vectors of a split are those of the long format, to the bit, and are made where the rows stand."""
    texts = ["aa bb aa c", "", None, "x y z", " ".join(f"w{k % 37}" for k in range(500)), "é çà \U0001f600 \U0001f600\U0001f600 aa"]
    rows = [(k, t, k % 2, ("train", "test")[k % 4 == 3]) for k, t in enumerate(texts * 4)]
    p = Prepared(checkpoint(spark.createDataFrame(rows, "msg_id long, message_clean string, y int, split string").repartition(3)))
    for split in ("train", "test"):
        for element in ("float", "double"):
            made = p.embedded(split, 24, element)
            assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
            long = embedding.densify(p.hashed(split, 24), p.documents(split), 24, element=element)
            assert made.schema["embedding"].dataType.elementType == long.schema["embedding"].dataType.elementType
            assert sorted(made.collect()) == sorted(long.select(*made.columns).collect())
