"""Secret scan: pattern findings, and a random forest that removes the false positives.  DataFrame functions only.

A finding is a run of 16 or more characters of keys and tokens that holds a digit.  Features: length, character
transitions and classes, the share that dictionary words cover, how much it looks like a path or a host name, and the
neighbouring words.  The dictionary is learned: letter runs that occur in several distinct findings.

Labelled findings can be given.  Without them, findings in the documents are labelled by certain marks only (issued
prefixes, key assignments, plain numbers, host names, placeholders); the forest sees none of these marks as such and
decides on all findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .spans import located, matches, pieces

_CLASS = r"A-Za-z0-9_+/=.\-"
FINDING = rf"(?<![{_CLASS}])(?=[A-Za-z_+/=.\-]*+[0-9])[{_CLASS}]{{16,}}+"
AROUND = 32
#: Labelled findings the forest is fitted on, at most, chosen by a hash.
TRAINING_ROWS = 20_000
#: Distinct findings in which a letter run has to occur to be a word of the dictionary.
WORD_FINDINGS = 5
TREES, DEPTH = 40, 8
#: Prefixes that issuers give, and words that stand before a secret.
PREFIXES = r"^(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abpr]-|sk_live_|rk_live_|sk-|AIza|ya29\.|eyJ)"
SECRET_WORDS = r"token|secret|password|passwd|pwd|api_?key|access_?key|private_?key|auth|bearer|credential"

FEATURES = (
    "size", "switches", "digits", "uppers", "symbols", "variety", "hex_only", "covered", "longest_word", "slashes",
    "dots", "extension", "assigned", "quoted", "secret_word", "prose_before", "prose_after",
)


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, end, value, left, right), one row for each match; a null text has none."""
    text = F.col("text")
    step = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    step = step.withColumn("values", matches(text, FINDING))
    step = step.where(F.size("values") > 0).withColumn("between", pieces(text, FINDING, F.col("values")))
    spans = located(F.col("values"), F.col("between"), AROUND)
    return step.select("id", F.explode(spans).alias("s")).select("id", "s.*")


def _count(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern))


def _runs(value: Column) -> Column:
    """Letter runs of three or more, in lower case."""
    return F.transform(F.regexp_extract_all(value, F.lit("[A-Za-z]{3,}"), F.lit(0)), F.lower)


def with_features(found: DataFrame) -> DataFrame:
    """``found`` with the columns of ``FEATURES``.

    Dictionary coverage needs the words of all findings: runs are counted over distinct values and joined back by
    value, so a run that is everywhere meets its count, not its rows.
    """
    values = found.select("value").distinct()
    runs = values.select("value", F.explode(F.array_distinct(_runs(F.col("value")))).alias("run"))
    # one value is one vote: copies of a document don't make a dictionary
    words = runs.groupBy("run").agg(F.count("*").alias("n")).where(F.col("n") >= WORD_FINDINGS).select("run")
    words = saved(words, "words")
    known = runs.join(words, "run").groupBy("value").agg(F.collect_set("run").alias("words"))
    known = saved(known, "known")
    size = F.length("value")
    joined = found.join(known, "value", "left").withColumn(
        "hits", F.filter(_runs(F.col("value")), lambda r: F.coalesce(F.array_contains("words", r), F.lit(False)))
    )
    v, left, right = F.col("value"), F.col("left"), F.col("right")
    number = {
        "size": F.least(size, F.lit(256)),
        "switches": _count(v, r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])") / size,
        "digits": _count(v, "[0-9]") / size,
        "uppers": _count(v, "[A-Z]") / size,
        "symbols": _count(v, "[^A-Za-z0-9]") / size,
        "variety": F.size(F.array_distinct(F.split(F.left(v, F.lit(256)), ""))) / F.least(size, F.lit(64)),
        "hex_only": v.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("int"),
        "covered": F.aggregate("hits", F.lit(0), lambda n, r: n + F.length(r)) / size,
        "longest_word": F.coalesce(F.array_max(F.transform(_runs(v), F.length)), F.lit(0)) / size,
        "slashes": _count(v, "/") / size,
        "dots": _count(v, r"\.") / size,
        "extension": v.rlike(r"\.[A-Za-z]{2,5}$").cast("int"),
        "assigned": left.rlike(r"[:=]\s*[\"']?$").cast("int"),
        "quoted": (left.rlike(r"[\"']$") & right.rlike(r"^[\"']")).cast("int"),
        "secret_word": left.rlike(rf"(?i)(?:{SECRET_WORDS})[^A-Za-z]{{0,6}}$").cast("int"),
        "prose_before": left.rlike(r"\p{L}{2,}[,.]?\s$").cast("int"),
        "prose_after": right.rlike(r"^[,.]?\s\p{L}{2,}").cast("int"),
    }
    return joined.select(*found.columns, *[number[f].cast("double").alias(f) for f in FEATURES])


def certain(value: Column, left: Column) -> Column:
    """1 for findings that are secrets by issuer or assignment, 0 for plain numbers, hosts and fillers, else null."""
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    secret = value.rlike(PREFIXES) | (
        left.rlike(rf"(?i)(?:{SECRET_WORDS})[\"']?\s*[:=]\s*[\"']?$") & mixed & (F.length(value) >= 24)
    )
    plain = (
        value.rlike(r"^[0-9.+\-/=]+$")
        | value.rlike(r"^(?:[A-Za-z][A-Za-z0-9\-]*\.)+[A-Za-z]{2,}\.?$")
        | value.rlike(r"(?i)example|sample|dummy|placeholder|xxxx|0000000")
        | value.rlike(r"^(?:[A-Za-z]+[._\-/])+[0-9]{1,4}\.?$")
    )
    return F.when(plain, 0).when(secret, 1)


def forest(labelled: DataFrame, rows: int = TRAINING_ROWS, seed: int = 7):
    """A random forest on ``labelled`` (FEATURES, label 0/1); None unless both labels occur."""
    bounded = labelled.select(*FEATURES, "label", F.xxhash64(*FEATURES, "label", "value").alias("_h"))
    # each label has a half of the sample, so that the rarer one isn't crowded out
    halves = [bounded.where(F.col("label") == k).orderBy("_h").limit(rows // 2) for k in (0, 1)]
    sample = saved(halves[0].unionByName(halves[1]), "sample")
    if sample.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    trees = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, labelCol="label")
    return trees.fit(vectors.select("features", F.col("label").cast("double").alias("label")))


def scan(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, start, end, value, chance, secret): every finding, in code points, with the forest's chance.

    ``labelled`` has columns value, left, right and label (0 or 1); without it the documents' certain findings are
    used.  If only one label occurs the marks themselves decide, and a finding without a mark gets 0.5.
    """
    found = saved(findings(docs, id_col, text_col), "findings")
    featured = saved(with_features(found), "featured")
    if labelled is None:
        marked = featured.withColumn("label", certain(F.col("value"), F.col("left"))).where("label is not null")
    else:
        columns = F.lit(None).cast("bigint").alias("id"), F.lit(0).alias("start"), F.lit(0).alias("end")
        given = labelled.select(*columns, "value", "left", "right")
        marked = with_features(given).join(labelled.select("value", "left", "right", "label"), ["value", "left", "right"])
    model = forest(marked)
    if model is None:
        mark = certain(F.col("value"), F.col("left"))
        rated = featured.withColumn("chance", F.coalesce(mark.cast("double"), F.lit(0.5)))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(featured)
        rated = model.transform(vectors).withColumn("chance", vector_to_array("probability")[1])
    return rated.select("id", "start", "end", "value", "chance", (F.col("chance") > 0.5).alias("secret"))
