"""Reading labelled messages and writing the processed split."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

# Words that mean "missing" in a CSV field.
MISSING_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def found(df_reader, path: str) -> DataFrame:
    """Run a reader; a path that does not exist is a FileNotFoundError."""
    try:
        return df_reader(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Dataset not found: {path}") from error
        raise


def load_messages(
    spark: SparkSession,
    path: str,
    encoding: str = "ISO-8859-1",
    label_col: str = "v1",
    message_col: str = "v2",
    missing_words: bool = True,
) -> DataFrame:
    """(msg_id, label, message) from CSV with a header; other columns are ignored.

    Quoted fields may hold line breaks and doubled quotes.  ``msg_id`` follows the order of the rows in a file;
    write the table once and read that, where ids must outlive a change of the input.
    """

    def read(p: str) -> DataFrame:
        # the header gives the number of columns, so that surplus ones are not an error; all are read as strings
        return (
            spark.read.option("header", True)
            .option("encoding", encoding)
            .option("multiLine", True)
            .option("escape", '"')
            .csv(p)
        )

    raw = found(read, path)
    for column in (label_col, message_col):
        if column not in raw.columns:
            raise ValueError(f"Column {column!r} not in {path}: {raw.columns}")

    def value(column: str):
        c = F.col(column)
        return F.when(~c.isin(*MISSING_WORDS), c) if missing_words else c

    return raw.select(
        F.monotonically_increasing_id().alias("msg_id"),
        value(label_col).alias("label"),
        value(message_col).alias("message"),
    )


def from_tables(documents: DataFrame, labels: DataFrame, flag: str = "toxic", positive: int = 1) -> DataFrame:
    """(msg_id, label, message) from a text table and a label table with the same key."""
    named = labels.select("doc_id", F.when(F.col(flag) == positive, "spam").otherwise("ham").alias("label"))
    return documents.select("doc_id", "text").join(named, "doc_id").select(
        F.col("doc_id").alias("msg_id"), "label", F.col("text").alias("message")
    )


PROCESSED_SCHEMA = t.StructType(
    [
        t.StructField("msg_id", t.LongType()),
        t.StructField("message", t.StringType()),
        t.StructField("y", t.IntegerType()),
        t.StructField("split", t.StringType()),
    ]
)


def save_processed(df: DataFrame, path: str, text_col: str = "message_clean") -> None:
    """Write (msg_id, message, y) under one directory per split."""
    df.select("msg_id", F.col(text_col).alias("message"), "y", "split").write.mode("overwrite").partitionBy(
        "split"
    ).parquet(path)


def load_processed(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The processed table; with ``split`` only that directory is read."""
    table = found(spark.read.schema(PROCESSED_SCHEMA).parquet, path)
    return table if split is None else table.where(F.col("split") == split)
