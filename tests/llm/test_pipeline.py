"""Every stage against brute force on its own input, and the edge rows through all stages."""

import pytest
from test_decontam import brute
from test_lines_and_suffixes import brute_lines
from test_near import brute_near
from test_pieces_shards_quality import whole_search

import corpus_pipeline
from missive.llm import pieces, quality
from missive.llm.common import saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, small):
    docs, seen = spark.read.parquet(f"{small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, saved(stage(spark, docs, small), "stage")
        seen.append((name, before, docs))
    return seen


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_order_and_columns(stages):
    assert [n for n, _, _ in stages] == [
        "quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "sentencepiece"
    ]
    assert all(out.columns == COLUMNS for _, _, out in stages[:-1])


def test_quality_stage(stages):
    _, before, after = stages[0]
    model = quality.train(before)
    kept = set()
    for k, text in texts(before).items():
        n, s = quality.signals(text.encode())
        z = float(quality.features(text.encode(), n, s) @ model["weights"][:-1] + model["weights"][-1])
        if n and z <= 2.1972245773362196:  # log(0.9 / 0.1)
            kept.add(k)
    assert set(texts(after)) == kept


def test_line_stage(stages):
    _, before, after = stages[1]
    rows = sorted(texts(before).items())
    gone, wanted = brute_lines(rows, 50), {}
    for k, (id_, text) in enumerate(rows):
        left = [x for j, x in enumerate(text.split("\n")) if j not in gone[k]]
        if left:
            wanted[id_] = "\n".join(left)
    assert texts(after) == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_near_copy_stage(stages):
    """Five words, a similarity of 0.8: one document of each class of all pairs stays."""
    _, before, after = stages[2]
    rows = sorted(texts(before).items())
    classes = brute_near([x for _, x in rows])
    assert set(texts(after)) == {rows[c][0] for c in classes}


def test_decontamination_stage(stages, spark, small):
    _, before, after = stages[3]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    rows = sorted(texts(before).items())
    found = brute([x for _, x in rows], items, 13)
    assert set(texts(after)) == {k for (k, _), (n, hit, *_) in zip(rows, found) if not (hit and 20 * hit >= n)}


def test_last_stage(stages):
    _, before, after = stages[4]
    model = pieces.load(pieces.DEFAULT_MODEL)
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == set(texts(before))
    assert all(r["restored"] for r in rows)
    for r in sorted(rows, key=lambda r: r["n_chars"])[:40]:
        assert r["ids"] == whole_search(" " + r["text"], model) and r["n_tokens"] == len(r["ids"])


def test_edge_rows_and_empty_tables(spark, docs, edges, small):
    rows = [*enumerate(edges), (3, "a b c"), (3, "a b c"), (None, "no id here"), (None, "no id here")]
    for table in (docs(rows), docs([])):
        for _, stage in corpus_pipeline.STAGES:
            before, table = table, saved(stage(spark, table, small), "edge")
            assert table.count() <= before.count()


def test_one_of_equal_rows_stays(spark, docs, small):
    rows = [(5, "some words in here"), (5, "some words in here"), (7, "some words in here"), (None, "other words only")]
    left = corpus_pipeline.one_of_each_class(spark, docs(rows), small).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in left) == [(False, 5), (True, None)]
