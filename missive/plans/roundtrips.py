"""Queries that write a table with a sink and read it again, and the answers of the vector collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..models.classifier import EmbeddingClassifier, TextClassifier, load_classifier
from ..operators import cascade, embedding, splits, thresholds
from ..session import checkpoint
from ..sources import tables
from ..sources.messages import load_messages
from ..sources.tables import scratch_path
from . import catalog, oracle
from . import leaderboard as boards
from .catalog import corpus, labelled, query, rounded, table
from .comparison import report_lines
from .prepare import Prepared


@query
def csv_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled messages through the CSV reader: latin-1, quoted line breaks, columns v1 and v2."""
    path = scratch_path(spark, "csv")
    rows = labelled(spark, folder).select(F.col("label").alias("v1"), F.col("message").alias("v2"))
    rows.write.option("header", True).option("escape", '"').option("encoding", "ISO-8859-1").csv(path)
    return load_messages(spark, path).select("label", "message")


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    tables.save_csv(corpus(spark, folder), path)
    return tables.load_csv(spark, path, "msg_id bigint, message string")


@query
def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json")
    tables.save_json(corpus(spark, folder), path)
    return tables.load_json(spark, path, "msg_id bigint, message string")


@query
def array_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "array")
    tables.save_array(table(spark, folder, "embeddings"), path, "embedding", "vec_id")
    values = tables.load_array(spark, path).select("vec_id", F.posexplode("embedding").alias("dim", "value"))
    return rounded(values)


@query
def embedding_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of both splits of an embedding table; each is read from its own folder."""
    path = scratch_path(spark, "embeddings")
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("msg_id"), "embedding")
    tables.save_embeddings(splits.split_hash(rows), path)
    parts = [tables.load_split(spark, path, s) for s in ("train", "test")]
    both = parts[0].unionByName(parts[1])
    return rounded(both.select("msg_id", "split", F.posexplode("embedding").alias("dim", "value")))


@query
def feature_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse TF-IDF weights of both splits; each is read from its own folder."""
    path = scratch_path(spark, "features")
    features = Prepared.of(labelled(spark, folder)).tfidf()
    train, test = (features.weights(s).withColumn("split", F.lit(s)) for s in ("train", "test"))
    tables.save_features(train.unionByName(test), path)
    parts = [tables.load_split(spark, path, s) for s in ("train", "test")]
    return rounded(parts[0].unionByName(parts[1]).select("msg_id", "split", "term", "weight"))


@query
def threshold_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "thresholds")
    train = checkpoint(catalog._stage1(Prepared.of(labelled(spark, folder)), "train"))
    tuned = rounded(thresholds.cascade_thresholds(train, digits=catalog.DIGITS))
    tables.save_json(tuned, path)
    return tables.load_json(spark, path, tuned.schema)


@query
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Test scores of a text classifier that was fitted, saved and loaded."""
    path = scratch_path(spark, "model")
    features = Prepared.of(labelled(spark, folder)).tfidf()
    TextClassifier(catalog.STAGE1).fit(checkpoint(features.vectors("train"))).save(path)
    loaded = load_classifier(spark, path, TextClassifier.__name__)
    return rounded(loaded.score(features.vectors("test")).select("msg_id", "y", "p", "pred"))


def _saved_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions of a cascade of two fitted classifiers that was saved and loaded with its thresholds."""
    path = scratch_path(spark, "cascade")
    p = Prepared.of(labelled(spark, folder))
    features = p.tfidf()
    train, test = (checkpoint(features.vectors(split)) for split in ("train", "test"))
    text = TextClassifier(catalog.STAGE1).fit(train)
    vector = EmbeddingClassifier(catalog.STAGE2).fit(checkpoint(p.embedded("train", catalog.DIM, "double")))
    scored = text.score(train).withColumn("p", F.round("p", catalog.DIGITS))
    tuned = thresholds.cascade_thresholds(checkpoint(scored.select("msg_id", "y", "p", "pred")), digits=catalog.DIGITS).first()
    limits = (tuned.stage1_low_threshold, tuned.stage1_high_threshold, tuned.stage2_threshold)
    cascade.HybridCascade(text, vector, *limits, digits=catalog.DIGITS).save(spark, path)

    def encode(rows: DataFrame) -> DataFrame:
        wanted = p.rows.join(rows.select("msg_id"), "msg_id", "left_semi")
        weights = embedding.hash_weights(wanted, catalog.DIM, keep=("y",))
        return embedding.densify(weights, wanted.select("msg_id", "y"), catalog.DIM, element="double")

    loaded = cascade.HybridCascade.load(spark, path, encode)
    return loaded.predict_with_metadata(test)


@query
def cascade_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions of a loaded cascade and the stages that made them."""
    return _saved_cascade(spark, folder).select("msg_id", "y", "prediction", "stage_used")


@query
def report_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of the evaluation report, written as text and read again."""
    path = scratch_path(spark, "report")
    routed = checkpoint(catalog._cascade(Prepared.of(labelled(spark, folder))))
    comparison = catalog.final_comparison(spark, folder)
    lines = report_lines(comparison, rounded(cascade.stage_metrics(routed)), rounded(cascade.stage_stats(routed)))
    tables.save_report(lines, path)
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("n"), "value")


@query
def board_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The leaderboard as a CSV file with a header."""
    path = scratch_path(spark, "board")
    board = catalog.leaderboard(spark, folder)
    tables.save_csv(board, path)
    return tables.load_csv(spark, path, board.schema)


@query
def collection_answers(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest entries of the collection, with document, label and split, for every vector."""
    asked = table(spark, folder, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    found = catalog._collection(spark, folder).query_many(asked, catalog.K_NEIGHBORS)
    return rounded(found.select("query_id", "rank", "document", "distance", "label", "split"))


@query
def top_five(spark: SparkSession, folder: str) -> DataFrame:
    return boards.top(catalog.leaderboard(spark, folder))


_METRICS = ("accuracy", "precision", "recall", "f1", "f1_macro", "roc_auc", "avg_precision")


def _lines(names) -> str:
    """A metrics row as report lines."""
    return "[model, " + ", ".join(f"'  {c}: ' || coalesce(printf('%.4f', {c}), '-')" for c in names) + "]"


MESSAGES = "SELECT doc_id AS msg_id, text AS message FROM documents"
SQL = {
    "csv_messages": oracle._with(oracle.MSGS, select="SELECT label, message FROM msgs"),
    "csv_roundtrip": MESSAGES,
    "json_roundtrip": MESSAGES,
    "array_roundtrip": """SELECT vec_id, (i - 1)::INTEGER AS dim, round(embedding[i]::DOUBLE, 6) AS value
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
    "embedding_roundtrip": f"""SELECT msg_id, split, (i - 1)::INTEGER AS dim, round(embedding[i]::DOUBLE, 6) AS value
FROM (SELECT vec_id AS msg_id, {oracle._split('vec_id')} AS split, embedding,
             unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
    "feature_roundtrip": f"""SELECT msg_id, 'train' AS split, term, weight FROM ({oracle.ORACLE['tfidf_train']})
UNION ALL SELECT msg_id, 'test', term, weight FROM ({oracle.ORACLE['tfidf_test']})""",
    "model_roundtrip": oracle._with(*oracle.SCORED, select="SELECT msg_id, y, round(p, 6) AS p, pred FROM scored"),
    "cascade_roundtrip": f"SELECT msg_id, y, prediction, stage_used FROM ({oracle.ORACLE['cascade_rows']})",
    "board_roundtrip": oracle.ORACLE["leaderboard"],
    "report_roundtrip": f"""WITH told AS (
  SELECT 0 AS block, '' AS model, 0 AS part, 'Test rows by approach' AS value
  UNION ALL SELECT 2, '', -1, 'Who decided in the cascade, and how well'
  UNION ALL SELECT 1, model, unnest(range(0, {len(_METRICS) + 1})), unnest({_lines(_METRICS)})
  FROM ({oracle.ORACLE['final_comparison']})
  UNION ALL SELECT 2, '', unnest([0, 1]), unnest([
    '  first stage decided ' || printf('%.1f', stage1_pct) || '%', '  second stage decided ' || printf('%.1f', stage2_pct) || '%'])
  FROM ({oracle.ORACLE['stage_stats']})
  UNION ALL SELECT 3, model, unnest(range(0, {len(_METRICS) + 1})), unnest({_lines(_METRICS)})
  FROM ({oracle.ORACLE['stage_metrics']}))
SELECT row_number() OVER (ORDER BY block, model, part) - 1 AS n, value FROM told""",
    "threshold_roundtrip": oracle.ORACLE["cascade_thresholds"],
    "collection_answers": f"""WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, CASE WHEN label = 0 THEN 'ham' ELSE 'spam' END AS label,
         {oracle._split('vec_id')} AS split FROM embeddings),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, c.label, c.split, c.split || '_' || c.vec_id::VARCHAR AS id,
         list_distance(q.e, c.e) * list_distance(q.e, c.e) AS distance FROM v q CROSS JOIN v c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM near)
SELECT query_id, rank::INTEGER AS rank, 'vector ' || vec_id::VARCHAR AS document, round(distance, 6) AS distance,
       label, split FROM ranked WHERE rank <= {catalog.K_NEIGHBORS}""",
    "top_five": f"SELECT * FROM ({oracle.ORACLE['leaderboard']}) ORDER BY f1 DESC, model LIMIT 5",
}
oracle.ORACLE.update(SQL)
