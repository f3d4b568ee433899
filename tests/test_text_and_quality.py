import pytest
from pyspark.sql import functions as F

from missive.functions import text as T
from missive.operators import quality

CLEANING = [
    ("WINNER!! Call 0800-123 NOW", "winner call 0800 123 now"),
    ("see http://x.co/a?b=1 now", "see now"),
    ("visit WWW.Site.com, ok", "visit ok"),
    ("£1,000 café", "1 000 caf"),
    ("  a  b\t\r\nc  ", "a b c"),
    ("!!! ???", ""),
    ("http://only.url", ""),
    ("see http://a.b win now", "see win now"),
    ("see http://a.b\x1cwin now", "see win now"),
    ("httpfoo bar", "bar"),
    ("www. x", "www x"),
]


@pytest.mark.parametrize(("raw", "expected"), CLEANING)
def test_clean_text(spark, raw, expected):
    assert spark.createDataFrame([(raw,)], "t string").select(T.clean_text(F.col("t"))).first()[0] == expected


def test_clean_text_matches_the_rule_on_whole_documents(spark, small):
    import re

    def rule(text):
        text = re.sub(r"http\S+|www\.\S+", "", text.lower())
        return re.sub(r"\s+", " ", re.sub(r"[^a-zA-Z0-9\s]", " ", text)).strip()

    for table, column in (("documents", "text"), ("pages", "html")):
        rows = spark.read.parquet(f"{small}/{table}.parquet")
        for raw, cleaned in rows.select(column, T.clean_text(F.col(column))).collect():
            assert cleaned == rule(raw)


def test_cleaning_stays_in_the_jvm(spark):
    plan = spark.range(3).select(T.clean_text(F.col("id").cast("string")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_lengths_words_and_truncation(spark):
    rows = [("",), ("one",), (" two  words three ",), ("x" * 100,), ("y" * 101,)]
    got = spark.createDataFrame(rows, "t string").select(
        T.char_count(F.col("t")), T.word_count(F.col("t")), T.truncate(F.col("t"))
    ).collect()
    assert [r[0] for r in got] == [0, 3, 18, 100, 101]
    assert [r[1] for r in got] == [0, 1, 3, 1, 1]
    assert got[3][2] == "x" * 100 and got[4][2] == "y" * 97 + "..."


@pytest.mark.parametrize(
    ("low", "high", "expected"),
    [
        (1, 1, ["aa", "bb", "cc"]),
        (1, 2, ["aa", "bb", "cc", "aa bb", "bb cc"]),
        (2, 3, ["aa bb", "bb cc", "aa bb cc"]),
        (3, 4, ["aa bb cc"]),
    ],
)
def test_ngrams(spark, low, high, expected):
    words = spark.createDataFrame([("aa b bb cc",)], "t string").select(T.tokens(F.col("t")).alias("k"))
    assert words.select(T.ngrams(F.col("k"), low, high)).first()[0] == expected


def test_ngrams_of_short_texts(spark):
    words = spark.createDataFrame([("",), ("aa",)], "t string").select(T.tokens(F.col("t")).alias("k"))
    assert [r[0] for r in words.select(T.ngrams(F.col("k"))).collect()] == [[], ["aa"]]
    with pytest.raises(ValueError, match="n-gram"):
        T.ngrams(F.col("k"), 2, 1)


ROWS = [
    (1, "ham", "same"),
    (2, None, "no label"),
    (3, "spam", None),
    (4, "spam", "same"),
    (5, "spam", "http://gone"),
    (6, "spam", "kept"),
    (7, "ham", "kept"),
]
SCHEMA = "msg_id bigint, label string, message string"


def test_validation_keeps_the_first_of_equal_messages(spark):
    rows = quality.validate(spark.createDataFrame(ROWS, SCHEMA), strict=True)
    assert sorted((r.msg_id, r.label) for r in rows.collect()) == [(1, "ham"), (5, "spam"), (6, "spam")]


def test_unknown_labels_are_listed(spark):
    rows = spark.createDataFrame([*ROWS, (8, "Spam", "new")], SCHEMA)
    assert [r[0] for r in quality.invalid_labels(rows).collect()] == ["Spam"]
    with pytest.raises(ValueError, match="Spam"):
        quality.validate(rows, strict=True)


def test_drop_report(spark):
    row = quality.drop_report(spark.createDataFrame(ROWS, SCHEMA)).first()
    assert tuple(row) == (7, 2, 2, 1, 2)


def test_imbalance_needs_both_classes(spark):
    only = spark.createDataFrame([(1, "spam", "a")], SCHEMA)
    assert quality.imbalance(only).first().ratio is None
    assert quality.imbalance(spark.createDataFrame(ROWS, SCHEMA)).first().ratio == pytest.approx(2 / 4)


def test_hot_message_is_folded_before_the_shuffle(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("msg_id"),
        F.lit("ham").alias("label"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("message"),
    )
    kept = quality.deduplicate(rows)
    assert kept.count() == 2001
    plan = kept._jdf.queryExecution().toString()
    assert "partial_min(msg_id" in plan
