"""The named queries: each takes (spark, table folder) and returns a DataFrame.

Doubles are rounded to six digits at the end, so that engines which add in another order compare equal.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from ..functions import scoring as S
from ..functions import text as T
from ..models.closed_form import ClosedFormModel
from ..models.classifier import EmbeddingClassifier, TextClassifier
from ..models.factory import FAMILIES
from ..models.search import SHARED, RandomSearch
from ..operators import cascade, embedding, metrics, neighbors, quality, splits, tfidf, thresholds
from ..session import checkpoint
from ..sources.collection import VectorCollection, build_collection
from ..sources.messages import from_tables, load_processed, save_processed
from ..sources.tables import scratch_path
from . import leaderboard as boards
from .comparison import fit_and_rank
from .prepare import Prepared, TextFeatures, prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6
DIM = 64
#: The width of the fitted queries; those with an SQL counterpart keep DIM, which stands in their SQL.
FULL_DIM = embedding.DIMENSION
STAGE1, STAGE2 = "NearestCentroid", "GaussianNB"
K_NEIGHBORS = 5


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame) -> DataFrame:
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, (t.DoubleType, t.FloatType))}
    return df.select(*[F.round(F.col(c).cast("double"), DIGITS).alias(c) if c in real else F.col(c) for c in df.columns])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return from_tables(table(spark, folder, "documents"), table(spark, folder, "labels"))


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("msg_id"), F.col("text").alias("message"))


def coded(df: DataFrame) -> DataFrame:
    return df.withColumn("y", S.encode_label(F.col("label")))


def _text_board(p: Prepared) -> DataFrame:
    """Predictions of the closed-form models over TF-IDF."""
    features = p.tfidf()
    return features.fit().scores(features.weights("test"), p.documents("test"), digits=DIGITS)


def neighbor_votes(p: Prepared, dim: int = DIM, k: int = K_NEIGHBORS) -> DataFrame:
    """(model, msg_id, y, p, pred): share of spam among the k nearest training vectors."""
    test, train = (checkpoint(p.embedded(s, dim)) for s in ("test", "train"))
    near = neighbors.knn_join(test, train, k, query_id="msg_id", id_col="msg_id")
    truth = p.documents("train").select(F.col("msg_id").alias("id"), F.col("y").alias("_vote"))
    votes = near.join(truth, "id").groupBy(F.col("query_id").alias("msg_id")).agg(F.avg("_vote").alias("p"))
    return p.documents("test").join(votes, "msg_id").select(
        F.lit("KNeighborsClassifier").alias("model"),
        "msg_id",
        "y",
        F.round("p", DIGITS).alias("p"),
        (F.col("p") > 0.5).cast("int").alias("pred"),
    )


def _embedding_board(p: Prepared) -> DataFrame:
    model = p.fit_embedding(DIM)
    closed = model.scores(p.hashed("test", DIM), p.documents("test"), digits=DIGITS)
    order = ["model", "msg_id", "y", "p", "pred"]
    return closed.select(*order).unionByName(neighbor_votes(p).select(*order))


class Stages:
    """The two fitted stages over one prepared table; each is fitted once, when first asked for."""

    def __init__(self, prepared: Prepared):
        self.prepared = prepared

    @cached_property
    def text(self) -> tuple[TextFeatures, ClosedFormModel]:
        features = self.prepared.tfidf()
        return features, features.fit()

    @cached_property
    def vector(self) -> ClosedFormModel:
        return self.prepared.fit_embedding(DIM)

    def stage1(self, split: str) -> DataFrame:
        """(msg_id, y, p, pred) of the text model."""
        features, model = self.text
        return model.score(features.weights(split), self.prepared.documents(split), STAGE1, DIGITS)

    def stage2(self, wanted: DataFrame) -> DataFrame:
        """(msg_id, y, p, pred) of the embedding model for the wanted ids only; filtered before encoding."""
        rows = self.prepared.rows.join(wanted.select("msg_id"), "msg_id", "left_semi")
        weights = embedding.hash_weights(rows, DIM)
        return self.vector.score(weights, rows.select("msg_id", "y"), STAGE2, DIGITS)

    def cascade(self, test: DataFrame) -> DataFrame:
        """Thresholds from the training scores, decisions on the scored test rows."""
        tuned = thresholds.cascade_thresholds(self.stage1("train"), digits=DIGITS).first()  # one row
        low, high = tuned.stage1_low_threshold, tuned.stage1_high_threshold
        second = self.stage2(cascade.uncertain(test, low, high))
        return cascade.cascade_rows(test, second, low, high, tuned.stage2_threshold)


def _stage1(p: Prepared, split: str) -> DataFrame:
    return Stages(p).stage1(split)


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return _stage1(Prepared.of(labelled(spark, folder)), "test")


def _cascade(p: Prepared) -> DataFrame:
    stages = Stages(p)
    return stages.cascade(checkpoint(stages.stage1("test")))


# --- sources and validation ---------------------------------------------------------------------------------


@query
def load_labelled(spark: SparkSession, folder: str) -> DataFrame:
    return labelled(spark, folder)


@query
def split_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "processed")
    save_processed(prepare(labelled(spark, folder)), path)
    return load_processed(spark, path).select("msg_id", "message", "y", "split")


@query
def validate(spark: SparkSession, folder: str) -> DataFrame:
    return quality.validate(labelled(spark, folder)).select("msg_id", "label", "message")


@query
def dedup(spark: SparkSession, folder: str) -> DataFrame:
    return quality.deduplicate(corpus(spark, folder)).select("msg_id", "message")


@query
def invalid_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The language column checked against a closed set of two."""
    return quality.invalid_labels(table(spark, folder, "documents"), ["en", "de"], "lang")


@query
def drop_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.drop_report(labelled(spark, folder))


@query
def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.class_balance(labelled(spark, folder)))


@query
def imbalance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.imbalance(labelled(spark, folder)))


# --- text ----------------------------------------------------------------------------------------------------


@query
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return corpus(spark, folder).select("msg_id", T.clean_text(F.col("message")).alias("message_clean"))


@query
def clean_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", T.clean_text(F.col("html")).alias("html_clean"))


@query
def clean_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    return quality.clean_messages(labelled(spark, folder)).select("msg_id", "label", "message_clean")


@query
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    rows = coded(labelled(spark, folder))
    return rows.select(
        "msg_id",
        "y",
        S.decode_label(F.col("y")).alias("decoded"),
        S.collection_label(F.col("y")).alias("collection_label"),
    )


@query
def truncate(spark: SparkSession, folder: str) -> DataFrame:
    return corpus(spark, folder).select("msg_id", T.truncate(F.col("message")).alias("shown"))


@query
def text_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return quality.text_lengths(corpus(spark, folder))


@query
def clean_examples(spark: SparkSession, folder: str) -> DataFrame:
    return quality.clean_examples(quality.clean_messages(labelled(spark, folder)))


def _words() -> Column:
    return T.tokens(T.clean_text(F.col("message")))


@query
def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return corpus(spark, folder).select("msg_id", F.array_join(_words(), " ").alias("tokens"))


@query
def ngrams(spark: SparkSession, folder: str) -> DataFrame:
    words = corpus(spark, folder).select("msg_id", _words().alias("k"))
    return words.select("msg_id", F.array_join(T.ngrams(F.col("k"), 1, 2), "|").alias("ngrams"))


@query
def length_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.length_stats(labelled(spark, folder)))


@query
def length_stats_by_class(spark: SparkSession, folder: str) -> DataFrame:
    stats = quality.length_stats(labelled(spark, folder), by=["label"])
    names = [f.name for f in stats.schema.fields if isinstance(f.dataType, t.DoubleType)]
    return stats.withColumns({c: F.bround(c, 2) for c in names})


# --- splits --------------------------------------------------------------------------------------------------


@query
def split_exact(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_exact(coded(labelled(spark, folder))).select("msg_id", "y", "split")


@query
def split_hash(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_hash(corpus(spark, folder)).select("msg_id", "split")


@query
def split_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(splits.split_report(splits.split_exact(coded(labelled(spark, folder)))))


@query
def sample_per_class(spark: SparkSession, folder: str) -> DataFrame:
    rows = splits.sample_per_class(labelled(spark, folder))
    return rows.select("label", "rank", "msg_id", T.truncate(F.col("message")).alias("shown"))


@query
def folds(spark: SparkSession, folder: str) -> DataFrame:
    return splits.folds(coded(labelled(spark, folder)))


@query
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(splits.class_weights(coded(labelled(spark, folder))))


# --- features ------------------------------------------------------------------------------------------------


@query
def term_stats(spark: SparkSession, folder: str) -> DataFrame:
    # the cleaned text is kept first: the steps of the counting would clean it again
    rows = Prepared.of(labelled(spark, folder)).rows
    return tfidf.text_stats(rows.where(F.col("split") == "train"))


@query
def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(Prepared.of(labelled(spark, folder)).tfidf().vocab)


@query
def feature_names(spark: SparkSession, folder: str) -> DataFrame:
    return tfidf.feature_names(Prepared.of(labelled(spark, folder)).tfidf().vocab, 20)


@query
def tfidf_train(spark: SparkSession, folder: str) -> DataFrame:
    weights = Prepared.of(labelled(spark, folder)).tfidf().weights("train")
    return rounded(weights.select("msg_id", "term", "weight"))


@query
def tfidf_test(spark: SparkSession, folder: str) -> DataFrame:
    weights = Prepared.of(labelled(spark, folder)).tfidf().weights("test")
    return rounded(weights.select("msg_id", "term", "weight"))


@query
def hash_embedding(spark: SparkSession, folder: str) -> DataFrame:
    rows = corpus(spark, folder).select("msg_id", T.clean_text(F.col("message")).alias("message_clean"))
    vectors = embedding.hash_embedding(rows, DIM)
    return vectors.select("msg_id", F.posexplode("embedding").alias("dim", "value")).select(
        "msg_id", "dim", F.round(F.col("value").cast("double"), 5).alias("value")
    )


# --- vectors -------------------------------------------------------------------------------------------------


def _neighbors(spark: SparkSession, folder: str, metric: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    near = neighbors.knn_join(vectors, vectors, K_NEIGHBORS, metric, query_id="vec_id", id_col="vec_id")
    return rounded(near.select("query_id", "rank", "id", "distance"))


@query
def knn_l2(spark: SparkSession, folder: str) -> DataFrame:
    return _neighbors(spark, folder, "l2")


@query
def knn_cosine(spark: SparkSession, folder: str) -> DataFrame:
    return _neighbors(spark, folder, "cosine")


def _collection(spark: SparkSession, folder: str) -> VectorCollection:
    """The vectors of the table as a collection, split by hash; class 0 is ham, the others spam."""
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("msg_id"),
        F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("message"),
        "embedding",
        F.col("label").alias("y"),
    )
    parts = splits.split_hash(rows)
    train, test = (parts.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    collection = build_collection(spark, scratch_path(spark, "collection"), train, test)
    collection.add(train, "train")  # a second load adds nothing: the ids are there
    return collection


@query
def vector_collection(spark: SparkSession, folder: str) -> DataFrame:
    rows = _collection(spark, folder).rows()
    return rows.select("id", "document", F.size("embedding").cast("bigint").alias("dim"), "label", "split")


@query
def collection_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _collection(spark, folder).stats()


# --- metrics and thresholds ----------------------------------------------------------------------------------


@query
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(_scored(spark, folder))


@query
def class_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.class_report(_scored(spark, folder)))


def _named(scored: DataFrame, name: str) -> DataFrame:
    return scored.withColumn("model", F.lit(name))


@query
def metrics_row(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.evaluate(_named(checkpoint(_scored(spark, folder)), STAGE1)))


@query
def class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored(spark, folder)
    both = metrics.rates(scored, ["recall", "ham_precision"])
    return rounded(both.withColumnRenamed("recall", "spam_recall"))


@query
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.pr_curve(_scored(spark, folder)))


@query
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.ranking_metrics(_scored(spark, folder)).select("roc_auc"))


@query
def avg_precision(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.ranking_metrics(_scored(spark, folder)).select("avg_precision"))


@query
def best_threshold_f1(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(thresholds.best_threshold(_scored(spark, folder), "f1"))


@query
def best_threshold_precision(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(thresholds.best_threshold(_scored(spark, folder), "precision"))


@query
def best_threshold_recall(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(thresholds.best_threshold(_scored(spark, folder), "recall"))


@query
def high_recall_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(thresholds.high_recall_threshold(_scored(spark, folder)))


@query
def cascade_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    train = checkpoint(_stage1(Prepared.of(labelled(spark, folder)), "train"))
    return rounded(thresholds.cascade_thresholds(train, digits=DIGITS))


@query
def cascade_thresholds_target(spark: SparkSession, folder: str) -> DataFrame:
    train = checkpoint(_stage1(Prepared.of(labelled(spark, folder)), "train"))
    return rounded(thresholds.cascade_thresholds_target(train))


# --- models, cascade, comparison -----------------------------------------------------------------------------


@query
def leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(boards.leaderboard(_text_board(Prepared.of(labelled(spark, folder)))))


@query
def leaderboard_embedding(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(boards.leaderboard(_embedding_board(Prepared.of(labelled(spark, folder)))))


@query
def top_models(spark: SparkSession, folder: str) -> DataFrame:
    return boards.top_models(leaderboard(spark, folder))


@query
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    return boards.best_model(checkpoint(leaderboard(spark, folder)))


@query
def approach_summary(spark: SparkSession, folder: str) -> DataFrame:
    p = Prepared.of(labelled(spark, folder))
    text, vector = (checkpoint(rounded(boards.leaderboard(b(p)))) for b in (_text_board, _embedding_board))
    return rounded(boards.approach_summary({"Traditional ML": text, "Embedding-based": vector}))


@query
def cascade_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_cascade(Prepared.of(labelled(spark, folder))))


@query
def stage_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cascade.stage_stats(_cascade(Prepared.of(labelled(spark, folder)))))


@query
def stage_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cascade.stage_metrics(checkpoint(_cascade(Prepared.of(labelled(spark, folder))))))


@query
def final_comparison(spark: SparkSession, folder: str) -> DataFrame:
    p = Prepared.of(labelled(spark, folder))
    stages = Stages(p)
    text = checkpoint(stages.stage1("test"))
    vector = checkpoint(stages.stage2(p.documents("test")))
    routed = stages.cascade(text).withColumnRenamed("prediction", "pred")
    order = ["model", "msg_id", "y", "p", "pred"]
    stacked = _named(text, "Traditional-ML").select(*order)
    for part, name in ((vector, "Embedding-ML"), (routed, "HybridCascade")):
        stacked = stacked.unionByName(_named(part, name).select(*order))
    return rounded(metrics.evaluate(checkpoint(stacked)))


# --- fitted by Spark ML: rows only ---------------------------------------------------------------------------

TEXT_FAMILIES = tuple(FAMILIES)
EMBEDDING_FAMILIES = (
    "LogisticRegression",
    "LinearSVC",
    "SGDClassifier",
    "RidgeClassifier",
    "RidgeClassifierCV",
    "DecisionTreeClassifier",
    "RandomForestClassifier",
    "ExtraTreesClassifier",
    "ExtraTreeClassifier",
    "BaggingClassifier",
    "GradientBoostingClassifier",
    "LGBMClassifier",
    "AdaBoostClassifier",
    "LinearDiscriminantAnalysis",
    "QuadraticDiscriminantAnalysis",
    "CalibratedClassifierCV",
    "SVC",
    "KNeighborsClassifier",
    "LabelPropagation",
    "LabelSpreading",
    "BernoulliNB",
    "GaussianNB",
    "NearestCentroid",
    "DummyClassifier",
)


@query
def score_text(spark: SparkSession, folder: str) -> DataFrame:
    """Balanced logistic regression over TF-IDF: test scores."""
    features = Prepared.of(labelled(spark, folder)).tfidf()
    model = TextClassifier().fit(checkpoint(features.vectors("train")))
    return rounded(model.score(features.vectors("test")).select("msg_id", "y", "p", "pred"))


@query
def score_embedding(spark: SparkSession, folder: str) -> DataFrame:
    """Balanced logistic regression over embeddings: test scores."""
    p = Prepared.of(labelled(spark, folder))
    model = EmbeddingClassifier().fit(checkpoint(p.embedded("train", FULL_DIM)))
    return rounded(model.score(p.embedded("test", FULL_DIM)).select("msg_id", "y", "p", "pred"))


@query
def leaderboard_ml(spark: SparkSession, folder: str) -> DataFrame:
    features = Prepared.of(labelled(spark, folder)).tfidf()
    return fit_and_rank(features.vectors("train"), features.vectors("test"), TEXT_FAMILIES)[0].drop("seconds")


def _embedding_vectors(p: Prepared, split: str) -> DataFrame:
    return EmbeddingClassifier().prepare(p.embedded(split, FULL_DIM))


@query
def leaderboard_embedding_ml(spark: SparkSession, folder: str) -> DataFrame:
    p = Prepared.of(labelled(spark, folder))
    train, test = (_embedding_vectors(p, s) for s in ("train", "test"))
    return fit_and_rank(train, test, EMBEDDING_FAMILIES, EmbeddingClassifier.columns())[0].drop("seconds")


@query
def search_results(spark: SparkSession, folder: str) -> DataFrame:
    """The search spaces whose trials share their passes, over embeddings, with the search's own trials and folds."""
    p = Prepared.of(labelled(spark, folder))
    vectors, trials = checkpoint(_embedding_vectors(p, "train")), None
    for name in SHARED:
        search = RandomSearch(name, columns=EmbeddingClassifier.columns())
        search.optimize(vectors)
        found = search.results(spark).select(
            F.lit(name).alias("model"), "trial", F.to_json("params").alias("params"), "score"
        )
        trials = found if trials is None else trials.unionByName(found)
    return rounded(trials)


QUERIES["metrics"] = QUERIES.pop("metrics_row")
