import math

import pytest
from pyspark.sql import functions as F

from missive.operators import splits


def frame(spark, n=399, every=8, partitions=3):
    rows = spark.range(0, n, 1, partitions).withColumnRenamed("id", "msg_id")
    return rows.select("msg_id", (F.col("msg_id") % every == 0).cast("int").alias("y"))


@pytest.mark.parametrize(("n", "every"), [(399, 8), (10, 3), (1000, 2)])
def test_exact_split_size_and_shares(spark, n, every):
    rows = splits.split_exact(frame(spark, n, every)).where("split = 'test'").collect()
    wanted = math.ceil(0.2 * n)
    positives = len(range(0, n, every))
    assert len(rows) == wanted
    assert abs(sum(r.y for r in rows) - positives * wanted / n) < 1


def test_exact_split_is_the_smallest_keys_of_each_class(spark):
    rows = splits.split_exact(frame(spark))
    ranked = splits.stratified_rank(frame(spark))
    both = rows.join(ranked, ["msg_id", "y"])
    for y in (0, 1):
        mine = both.where(F.col("y") == y)
        tested = mine.where("split = 'test'").agg(F.max("rank"), F.count("*")).first()
        assert tested[0] == tested[1]


def test_splits_do_not_depend_on_partitioning(spark):
    for split in (splits.split_exact, splits.split_hash):
        one, many = ({(r.msg_id, r.split) for r in split(frame(spark, partitions=k)).collect()} for k in (1, 7))
        assert one == many


def test_hash_split_has_no_shuffle(spark):
    assert "Exchange" not in splits.split_hash(frame(spark))._jdf.queryExecution().toString()


def test_folds_are_balanced_per_class(spark):
    counts = splits.folds(frame(spark), 5).groupBy("y").pivot("fold").count().collect()
    for row in counts:
        sizes = [row[str(i)] for i in range(5)]
        assert max(sizes) - min(sizes) <= 1
    with pytest.raises(ValueError):
        splits.folds(frame(spark), 1)


def test_sample_keeps_few_rows_per_task(spark):
    rows = frame(spark).withColumn("label", F.col("y").cast("string"))
    sample = splits.sample_per_class(rows, 4)
    assert sample.groupBy("label").count().agg(F.min("count"), F.max("count")).first() == (4, 4)
    assert "WindowGroupLimit" in sample._jdf.queryExecution().toString()


def test_class_weights(spark):
    weights = {r.y: r.weight for r in splits.class_weights(frame(spark, 100, 4)).collect()}
    assert weights == {0: 100 / (2 * 75), 1: 100 / (2 * 25)}


def test_an_unknown_class_is_an_error(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "msg_id bigint, y int")
    with pytest.raises(ValueError, match="values other"):
        splits.split_exact(rows)
