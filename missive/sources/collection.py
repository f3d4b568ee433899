"""A vector collection kept as a Parquet table: id, document, embedding, label, split."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from ..functions.scoring import collection_label
from ..operators.neighbors import knn_join, nearest

SCHEMA = t.StructType(
    [
        t.StructField("id", t.StringType()),
        t.StructField("document", t.StringType()),
        t.StructField("embedding", t.ArrayType(t.FloatType())),
        t.StructField("label", t.StringType()),
        t.StructField("split", t.StringType()),
    ]
)


def collection_rows(df: DataFrame, split: str | None = None, text_col: str = "message") -> DataFrame:
    """Rows of the collection from (msg_id, text, embedding, y[, split]); the id is ``{split}_{msg_id}``."""
    part = F.col("split") if split is None else F.lit(split)
    return df.select(
        F.concat_ws("_", part, F.col("msg_id").cast("string")).alias("id"),
        F.col(text_col).alias("document"),
        F.col("embedding").cast("array<float>").alias("embedding"),
        collection_label(F.col("y")).alias("label"),
        part.alias("split"),
    )


class VectorCollection:
    def __init__(self, spark: SparkSession, path: str, name: str = "messages"):
        self.spark = spark
        self.path = f"{path.rstrip('/')}/{name}"
        self.name = name

    def create(self, delete_existing: bool = False) -> VectorCollection:
        """Create the table if it is missing; ``delete_existing`` starts it anew."""
        mode = "overwrite" if delete_existing else "ignore"
        self.spark.createDataFrame([], SCHEMA).write.mode(mode).parquet(self.path)
        return self

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise ValueError("The collection is not initialized") from error
            raise

    def add(self, df: DataFrame, split: str | None = "train", text_col: str = "message") -> None:
        """Append rows whose id is not in the collection yet.

        Of rows with the same id in one batch, the one with the smallest document is taken.
        """
        self.create()
        fresh = collection_rows(df, split, text_col).join(self.rows().select("id"), "id", "left_anti")
        fields = F.struct(*[c for c in fresh.columns if c != "id"])
        one = fresh.groupBy("id").agg(F.min_by(fields, "document").alias("row")).select("id", "row.*")
        one.select(*fresh.columns).write.mode("append").parquet(self.path)

    def query(self, vector, n_results: int = 5, metric: str = "l2") -> DataFrame:
        """The nearest rows to one vector: id, document, distance, label, split."""
        found = nearest(self.rows(), vector, n_results, metric)
        return found.select("id", "document", "distance", "label", "split")

    def query_many(self, queries: DataFrame, n_results: int = 5, metric: str = "l2") -> DataFrame:
        """The nearest rows to every (query_id, embedding)."""
        best = knn_join(queries, self.rows(), n_results, metric)
        details = self.rows().select("id", "document", "label", "split")
        return best.join(details, "id").select(
            "query_id", "rank", "id", "document", "distance", "label", "split"
        )

    def stats(self) -> DataFrame:
        return self.rows().agg(F.count(F.lit(1)).alias("count")).select(F.lit(self.name).alias("name"), "count")


def build_collection(spark: SparkSession, path: str, train: DataFrame, test: DataFrame, name: str = "messages"):
    """A new collection with both splits."""
    collection = VectorCollection(spark, path, name).create(delete_existing=True)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    collection.add(both, split=None)
    return collection
