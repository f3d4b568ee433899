import pytest
from pyspark.sql import functions as F

from missive.plans.prepare import prepare
from missive.sources import collection, messages, tables

CSV = (
    'v1,v2,x,y\n'
    'ham,"two\nlines and ""quotes""",,\n'
    "spam,WIN £5 at the café,,\n"
    "ham,NA,,\n"
    ",no label,,\n"
    "ham,plain,,\n"
)


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "m.csv"
    path.write_bytes(CSV.encode("latin-1"))
    return str(path)


def test_load_messages(spark, csv_path):
    rows = messages.load_messages(spark, csv_path).orderBy("msg_id").collect()
    assert [(r.label, r.message) for r in rows] == [
        ("ham", 'two\nlines and "quotes"'),
        ("spam", "WIN £5 at the café"),
        ("ham", None),
        (None, "no label"),
        ("ham", "plain"),
    ]
    kept = messages.load_messages(spark, csv_path, missing_words=False).where("message = 'NA'")
    assert kept.count() == 1


def test_missing_inputs_are_errors(spark, tmp_path, csv_path):
    gone = str(tmp_path / "gone")
    for read in (
        lambda: messages.load_messages(spark, gone),
        lambda: messages.load_processed(spark, gone),
        lambda: tables.load_csv(spark, gone, "a int"),
        lambda: tables.load_json(spark, gone, "a int"),
        lambda: tables.load_array(spark, gone),
    ):
        with pytest.raises(FileNotFoundError, match="not found"):
            read()
    with pytest.raises(ValueError, match="nope"):
        messages.load_messages(spark, csv_path, label_col="nope")


def test_processed_split_prunes_partitions(spark, csv_path, tmp_path):
    path = str(tmp_path / "p")
    rows = prepare(messages.load_messages(spark, csv_path))
    messages.save_processed(rows, path)
    train = messages.load_processed(spark, path, "train")
    assert train.count() == rows.where("split = 'train'").count()
    assert "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().executedPlan().toString()


def test_file_helpers(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'say "hi",\nthere', 0.5), (2, "b", None)], "n int, s string, x double")
    tables.save_csv(frame, str(tmp_path / "c"))
    assert sorted(tables.load_csv(spark, str(tmp_path / "c"), frame.schema).collect()) == sorted(frame.collect())
    tables.save_json(frame, str(tmp_path / "j"))
    assert sorted(tables.load_json(spark, str(tmp_path / "j"), frame.schema).collect()) == sorted(frame.collect())
    vectors = spark.createDataFrame([(1, [0.5, 1.5], "train"), (2, [1.0, 0.0], "test")],
                                    "msg_id bigint, embedding array<float>, split string")
    tables.save_array(vectors, str(tmp_path / "a"))
    assert tables.load_array(spark, str(tmp_path / "a")).count() == 2
    tables.save_embeddings(vectors, str(tmp_path / "e"))
    assert [r.msg_id for r in tables.load_split(spark, str(tmp_path / "e"), "test").collect()] == [2]
    weights = spark.createDataFrame([(1, "aa", 0, 2, 1.0, "train")],
                                    "msg_id bigint, term string, idx int, tf bigint, weight double, split string")
    tables.save_features(weights, str(tmp_path / "f"))
    assert tables.load_split(spark, str(tmp_path / "f"), "train").first().term == "aa"


def test_report_lines_stay_in_order(spark, tmp_path):
    lines = spark.createDataFrame([(i, f"line {i}") for i in range(30)], "n bigint, value string").repartition(4)
    tables.save_report(lines, str(tmp_path / "r"))
    text = next((tmp_path / "r").glob("part-*")).read_text().splitlines()
    assert text == [f"line {i}" for i in range(30)]


def test_vector_collection(spark, tmp_path):
    rows = spark.createDataFrame(
        [(i, f"m{i}", [float(i), 1.0], i % 3) for i in range(6)],
        "msg_id bigint, message string, embedding array<float>, y int",
    )
    store = collection.VectorCollection(spark, str(tmp_path), "c")
    with pytest.raises(ValueError, match="not initialized"):
        store.query([0.0, 1.0])
    store.add(rows, "train")
    store.add(rows, "train")
    assert tuple(store.stats().first()) == ("c", 6)
    store.add(rows.limit(2), "test")
    assert store.rows().count() == 8
    assert {r.label for r in store.rows().where(F.col("id").isin("train_0", "train_3")).collect()} == {"ham"}
    assert {r.label for r in store.rows().where(F.col("id").isin("train_1", "train_2")).collect()} == {"spam"}
    best = store.query([0.0, 1.0], 3).collect()
    assert [(r.id, r.distance) for r in best] == [("test_0", 0.0), ("train_0", 0.0), ("test_1", 1.0)] or [
        r.distance for r in best
    ] == [0.0, 0.0, 1.0]
    asked = spark.createDataFrame([(1, [5.0, 1.0])], "query_id bigint, embedding array<float>")
    assert store.query_many(asked, 1).first().document == "m5"
    store.create(delete_existing=True)
    assert store.rows().count() == 0
    both = collection.build_collection(spark, str(tmp_path), rows.limit(4), rows.limit(1), "d")
    assert both.rows().groupBy("split").count().orderBy("split").collect() == [("test", 1), ("train", 4)]
