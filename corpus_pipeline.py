"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage works on all that its predecessor kept, and its decisions take effect.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from missive.llm import decontam, lines, near, pieces, quality
from missive.llm.common import saved, scratch, sweep

#: The stages fit a model, run graph rounds and search paths, which SQL cannot express; tests hold ``run`` against a
#: brute-force version.
ORACLE_SQL = None


#: Scratch tables of the stage before: its result is written when the next stage begins.
_before: list[str] = []


def stage(function):
    """A stage that removes the scratch tables of the one before."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        sweep(spark, _before)
        with scratch() as paths:
            out = function(spark, docs, sf_dir)
        _before[:] = paths
        return out

    return run_stage


@stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier rejects go; those without a word are among them."""
    rated = quality.classify(docs)
    return rated.where(F.col("junk") <= quality.REJECT).select(*docs.columns)


@stage
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut; a document of which no line is left goes.  n_chars follows."""
    cut = lines.dedup(docs).where(lines.removed_lines() < F.col("line_count"))
    sized = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return sized.select(*docs.columns)


@stage
def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies stays (five-word shingles, Jaccard similarity of 0.8 or more): the
    smallest id, and of equal ids the smallest hash of the text.

    Documents without an id come last.  Rows that are the same in id and text are one document.
    """
    key = F.struct(
        F.col("doc_id").isNull().alias("missing"),
        F.coalesce("doc_id", F.lit(0)).alias("number"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
    )
    found = near.classes(docs.select(key.alias("key"), "text"), id_col="key")
    kept = saved(found.where("id = component").groupBy("id").agg(F.count("*").alias("rows")), "kept")
    stays = docs.join(kept.select("id.*"), _same(docs, kept), "left_semi")
    if kept.where("rows > 1").isEmpty():
        return stays
    return stays.dropDuplicates(["doc_id", "text"])


def _same(docs: DataFrame, kept: DataFrame):
    return (
        (docs["doc_id"].isNull() == F.col("missing"))
        & (F.coalesce(docs["doc_id"], F.lit(0)) == F.col("number"))
        & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("hash"))
    )


@stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.scan(docs, items).where(~decontam.contaminated()).select(*docs.columns)


@stage
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids, the number of ids, and whether decoding gives the text back."""
    both = pieces.encode(docs, decoded="decoded")
    restored = F.col("decoded") == F.coalesce("text", F.lit(""))
    return both.select(*docs.columns, "ids", F.size("ids").alias("n_tokens"), restored.alias("restored"))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("simhash near-dedup", one_of_each_class),
    ("benchmark decontamination", decontaminated),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = saved(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
