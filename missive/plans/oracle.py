"""The same results stated in DuckDB SQL, one text per query."""

from __future__ import annotations

from .catalog import DIM, K_NEIGHBORS

ORACLE: dict[str, str] = {}


def _clean(column: str) -> str:
    no_urls = rf"regexp_replace(lower({column}), 'http\S+|www\.\S+', '', 'g')"
    plain = rf"regexp_replace({no_urls}, '[^a-zA-Z0-9\s]', ' ', 'g')"
    return rf"trim(regexp_replace({plain}, '\s+', ' ', 'g'))"


def _split(key: str) -> str:
    return f"CASE WHEN substr(md5('42:' || {key}::VARCHAR), 1, 8) < '33333334' THEN 'test' ELSE 'train' END"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _words(column: str) -> str:
    return f"list_filter(string_split({column}, ' '), lambda x: length(x) >= 2)"


def _grams(k: str) -> str:
    return f"list_concat({k}, list_transform(range(1, len({k})), lambda i: {k}[i] || ' ' || {k}[i + 1]))"


MSGS = """msgs AS (
  SELECT d.doc_id AS msg_id, CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label, d.text AS message
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
CODED = "coded AS (SELECT *, CASE label WHEN 'ham' THEN 0 WHEN 'spam' THEN 1 END AS y FROM msgs)"
VALID = """valid AS (
  SELECT msg_id, label, message FROM (
    SELECT *, row_number() OVER (PARTITION BY message ORDER BY msg_id) AS rn
    FROM msgs WHERE message IS NOT NULL AND label IS NOT NULL) WHERE rn = 1)"""
PREP = f"""prep AS MATERIALIZED (
  SELECT msg_id, label, message, message_clean, CASE label WHEN 'ham' THEN 0 WHEN 'spam' THEN 1 END AS y,
         {_split('msg_id')} AS split
  FROM (SELECT *, {_clean('message')} AS message_clean FROM valid) WHERE message_clean <> '')"""
PREPARED = (MSGS, VALID, PREP)

TF = f"""toks AS (SELECT msg_id, y, split, {_words('message_clean')} AS k FROM prep),
tf AS MATERIALIZED (
  SELECT msg_id, y, split, term, count(*) AS tf
  FROM (SELECT msg_id, y, split, unnest({_grams('k')}) AS term FROM toks) GROUP BY ALL)"""
VOCAB = """stats AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf WHERE split = 'train' GROUP BY term),
vocab AS MATERIALIZED (
  SELECT term, (row_number() OVER (ORDER BY term) - 1)::INTEGER AS idx, df, cf,
         ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf
  FROM (SELECT * FROM stats, (SELECT count(*)::DOUBLE AS n FROM prep WHERE split = 'train')
        WHERE df >= 2 AND df <= 0.95::DOUBLE * n ORDER BY cf DESC, term LIMIT 3000))"""
WEIGHTS = """raw AS (
  SELECT msg_id, y, split, term, (1 + ln(tf)) * idf AS r FROM tf JOIN vocab USING (term)),
weights AS MATERIALIZED (
  SELECT msg_id, y, split, term, r / sqrt(sum(r * r) OVER (PARTITION BY msg_id)) AS w FROM raw)"""
TFIDF = (*PREPARED, TF, VOCAB, WEIGHTS)

HASHED = f"""hashed AS MATERIALIZED (
  SELECT msg_id, y, split, idx AS term, n / sqrt(sum(n * n) OVER (PARTITION BY msg_id)) AS w
  FROM (SELECT msg_id, y, split, (('0x' || substr(md5(tok), 1, 8))::BIGINT % {DIM})::INTEGER AS idx,
               count(*)::DOUBLE AS n
        FROM (SELECT msg_id, y, split, unnest({_words('message_clean')}) AS tok FROM prep) GROUP BY ALL))"""


def _model(x: str, features: str, keys: str) -> str:
    """CTEs of the closed-form models over ``features``; names end in ``x``."""
    logn = "-0.5 * (ln(v{c}) + ({v} - mu{c}) * ({v} - mu{c}) / v{c})"
    at1, at0 = logn.format(c=1, v="w"), logn.format(c=0, v="w")
    z1, z0 = logn.format(c=1, v="0.0"), logn.format(c=0, v="0.0")
    return f"""keys{x} AS ({keys}),
mom{x} AS (
  SELECT k.term,
         coalesce(sum((w > 0)::INTEGER) FILTER (y = 1), 0)::DOUBLE AS n1,
         coalesce(sum((w > 0)::INTEGER) FILTER (y = 0), 0)::DOUBLE AS n0,
         coalesce(sum(w) FILTER (y = 1), 0)::DOUBLE AS s1, coalesce(sum(w) FILTER (y = 0), 0)::DOUBLE AS s0,
         coalesce(sum(w * w) FILTER (y = 1), 0)::DOUBLE AS q1, coalesce(sum(w * w) FILTER (y = 0), 0)::DOUBLE AS q0
  FROM keys{x} k LEFT JOIN (SELECT * FROM {features} WHERE split = 'train') f ON k.term = f.term GROUP BY k.term),
size{x} AS (
  SELECT count(*) FILTER (y = 1)::DOUBLE AS t1, count(*) FILTER (y = 0)::DOUBLE AS t0, count(*)::DOUBLE AS t
  FROM prep WHERE split = 'train'),
tot{x} AS (
  SELECT sum(s1) AS m1, sum(s0) AS m0, count(*)::DOUBLE AS k,
         1e-9::DOUBLE * max((q1 + q0) / t - ((s1 + s0) / t) * ((s1 + s0) / t)) AS eps FROM mom{x}, size{x}),
par{x} AS MATERIALIZED (
  SELECT term, ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)) AS bern, ln(1 - p1) - ln(1 - p0) AS absent,
         ln(h1) - ln(h0) AS mult, mu1, mu0, v1, v0
  FROM (SELECT term, (n1 + 1) / (t1 + 2) AS p1, (n0 + 1) / (t0 + 2) AS p0,
               (s1 + 1) / (m1 + k) AS h1, (s0 + 1) / (m0 + k) AS h0, s1 / t1 AS mu1, s0 / t0 AS mu0,
               greatest(q1 / t1 - (s1 / t1) * (s1 / t1), 0) + eps AS v1,
               greatest(q0 / t0 - (s0 / t0) * (s0 / t0), 0) + eps AS v0
        FROM mom{x}, size{x}, tot{x})),
base{x} AS MATERIALIZED (
  SELECT sum(absent) AS bern0, sum({z1} - ({z0})) AS gauss0, sum(mu1 * mu1) AS norm1, sum(mu0 * mu0) AS norm0,
         any_value(ln(t1 / t0)) AS prior, any_value(t1 / t) AS share1 FROM par{x}, size{x}),
sums{x} AS (
  SELECT msg_id, sum(bern * (w > 0)::INTEGER) AS b, sum(mult * w) AS m,
         sum({at1} - ({z1}) - ({at0}) + ({z0})) AS g, sum(w * mu1) AS d1, sum(w * mu0) AS d0, sum(w * w) AS xx
  FROM {features} JOIN par{x} USING (term) GROUP BY msg_id),
marg{x} AS (
  SELECT p.msg_id, p.y, p.split, coalesce(b, 0) + bern0 + prior AS bern, coalesce(m, 0) + prior AS mult,
         coalesce(g, 0) + gauss0 + prior AS gauss,
         greatest(coalesce(xx, 0) - 2 * coalesce(d1, 0) + norm1, 0) AS e1,
         greatest(coalesce(xx, 0) - 2 * coalesce(d0, 0) + norm0, 0) AS e0, share1
  FROM prep p LEFT JOIN sums{x} USING (msg_id), base{x}),
pred{x} AS MATERIALIZED (
  SELECT 'BernoulliNB' AS model, msg_id, y, split, round({_sigmoid('bern')}, 6) AS p, (bern > 0)::INTEGER AS pred
  FROM marg{x} UNION ALL
  SELECT 'MultinomialNB', msg_id, y, split, round({_sigmoid('mult')}, 6), (mult > 0)::INTEGER FROM marg{x} UNION ALL
  SELECT 'GaussianNB', msg_id, y, split, round({_sigmoid('gauss')}, 6), (gauss > 0)::INTEGER FROM marg{x} UNION ALL
  SELECT 'NearestCentroid', msg_id, y, split,
         round(CASE WHEN e0 + e1 = 0 THEN 0.5::DOUBLE ELSE sqrt(e0) / (sqrt(e0) + sqrt(e1)) END, 6),
         (e1 < e0)::INTEGER FROM marg{x} UNION ALL
  SELECT 'DummyClassifier', msg_id, y, split, round(share1, 6), (share1 > 0.5)::INTEGER FROM marg{x})"""


def _sigmoid(m: str) -> str:
    return f"CASE WHEN {m} >= 0 THEN 1 / (1 + exp(-{m})) ELSE exp({m}) / (1 + exp({m})) END"


TEXT_MODEL = _model("_t", "weights", "SELECT term FROM vocab")
HASH_MODEL = _model("_h", "hashed", f"SELECT unnest(range(0, {DIM}))::INTEGER AS term")
STAGE1 = (*TFIDF, TEXT_MODEL, "s1 AS (SELECT * FROM pred_t WHERE model = 'NearestCentroid')")
SCORED = (*STAGE1, "scored AS MATERIALIZED (SELECT msg_id, y, p, pred FROM s1 WHERE split = 'test')")
TRAIN_SCORED = (*STAGE1, "scored AS MATERIALIZED (SELECT msg_id, y, p, pred FROM s1 WHERE split = 'train')")
STAGE2 = (HASHED, HASH_MODEL, "s2 AS (SELECT * FROM pred_h WHERE model = 'GaussianNB')")

DENSE = f"""dense AS MATERIALIZED (
  SELECT p.msg_id, p.y, p.split, list(coalesce(w, 0)::FLOAT::DOUBLE ORDER BY dim) AS vec
  FROM prep p CROSS JOIN (SELECT unnest(range(0, {DIM}))::INTEGER AS dim)
  LEFT JOIN hashed h ON h.msg_id = p.msg_id AND h.term = dim GROUP BY ALL)"""


def _squared(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


VOTES = f"""pairs AS (
  SELECT q.msg_id, q.y, t.y AS vote,
         row_number() OVER (PARTITION BY q.msg_id ORDER BY {_squared('q.vec', 't.vec')}, t.msg_id) AS rank
  FROM dense q JOIN dense t ON q.split = 'test' AND t.split = 'train'),
knn AS (
  SELECT 'KNeighborsClassifier' AS model, msg_id, y, round(avg(vote), 6) AS p, (avg(vote) > 0.5)::INTEGER AS pred
  FROM pairs WHERE rank <= {K_NEIGHBORS} GROUP BY msg_id, y)"""

CURVE = """pts AS (
  SELECT p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY p),
cum AS (
  SELECT p, pos, neg, sum(pos) OVER (ORDER BY p DESC)::DOUBLE AS cp, sum(neg) OVER (ORDER BY p DESC)::DOUBLE AS cn,
         sum(pos) OVER ()::DOUBLE AS tp, sum(neg) OVER ()::DOUBLE AS tn FROM pts),
curve AS (
  SELECT p AS threshold, cp / (cp + cn) AS precision, CASE WHEN tp = 0 THEN 1.0::DOUBLE ELSE cp / tp END AS recall
  FROM cum UNION ALL SELECT NULL, 1.0, 0.0)"""
AUC = "CASE WHEN max(tp) > 0 AND max(tn) > 0 THEN sum(pos * (tn - cn + neg / 2)) / (max(tp) * max(tn)) END"
AP = "CASE WHEN max(tp) > 0 AND max(tn) > 0 THEN sum(pos * cp / (cp + cn)) / max(tp) END"


def _cells(source: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    return f"""SELECT {keys}count(*) FILTER (y = 1 AND pred = 1)::DOUBLE AS tp, count(*) FILTER (y = 0 AND pred = 1)::DOUBLE AS fp,
       count(*) FILTER (y = 1 AND pred = 0)::DOUBLE AS fn, count(*) FILTER (y = 0 AND pred = 0)::DOUBLE AS tn
FROM {source}{f' GROUP BY {by}' if by else ''}"""


def _rates(cells: str, by: str = "") -> str:
    """Rates from a cell table; each division by zero is 0."""
    keys = f"{by}, " if by else ""
    return f"""SELECT {keys}tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn) AS accuracy,
       coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
       coalesce(tn / nullif(tn + fn, 0), 0) AS ham_precision, coalesce(tn / nullif(tn + fp, 0), 0) AS ham_recall,
       coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS ham_f1, tp + fn AS n1, tn + fp AS n0 FROM ({cells})"""


def _round(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def _board(source: str) -> str:
    """Leaderboard rows of a prediction table, unrounded."""
    return f"""SELECT model, accuracy,
       CASE WHEN n1 = 0 THEN ham_recall WHEN n0 = 0 THEN recall ELSE (recall + ham_recall) / 2 END AS balanced_accuracy,
       CASE WHEN n1 > 0 AND n0 > 0 THEN (recall + ham_recall) / 2 END AS roc_auc,
       (f1 * n1 + ham_f1 * n0) / (n1 + n0) AS f1, precision, recall
FROM ({_rates(_cells(source, 'model'), 'model')})"""


def _rounded_board(source: str) -> str:
    columns = _round("accuracy", "balanced_accuracy", "roc_auc", "f1", "precision", "recall")
    return f"SELECT model, {columns} FROM ({_board(source)})"


TEXT_TEST = "text_pred AS (SELECT model, msg_id, y, p, pred FROM pred_t WHERE split = 'test')"
HASH_TEST = """hash_pred AS (
  SELECT model, msg_id, y, p, pred FROM pred_h WHERE split = 'test' UNION ALL SELECT * FROM knn)"""

TUNED = """tuned AS MATERIALIZED (
  SELECT round(quantile_cont(p, 0.2) FILTER (y = 0), 6) AS low, round(quantile_cont(p, 0.8) FILTER (y = 1), 6) AS high
  FROM s1 WHERE split = 'train')"""
ROUTED = """routed AS MATERIALIZED (
  SELECT a.msg_id, a.y,
         CASE WHEN a.p <= low THEN 0 WHEN a.p >= high THEN 1 ELSE (b.p >= 0.5)::INTEGER END AS prediction,
         CASE WHEN a.p <= low THEN 1 - a.p WHEN a.p >= high THEN a.p WHEN b.p >= 0.5 THEN b.p ELSE 1 - b.p END AS confidence,
         CASE WHEN a.p <= low OR a.p >= high THEN 1 ELSE 2 END AS stage_used,
         a.p AS stage1_proba, CASE WHEN a.p <= low OR a.p >= high THEN NULL ELSE b.p END AS stage2_proba,
         CASE WHEN a.p <= low OR a.p >= high THEN a.p ELSE b.p END AS p
  FROM s1 a JOIN s2 b USING (msg_id), tuned WHERE a.split = 'test')"""
CASCADE = (*STAGE1, *STAGE2, TUNED, ROUTED)


def _evaluated(source: str) -> tuple[str, ...]:
    """CTEs ending in ``ranked``: AUC and average precision per model of a prediction table."""
    return (
        f"""mpts AS (
  SELECT model, p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM {source} GROUP BY model, p)""",
        """mcum AS (
  SELECT model, p, pos, neg, sum(pos) OVER (PARTITION BY model ORDER BY p DESC)::DOUBLE AS cp,
         sum(neg) OVER (PARTITION BY model ORDER BY p DESC)::DOUBLE AS cn,
         sum(pos) OVER (PARTITION BY model)::DOUBLE AS tp, sum(neg) OVER (PARTITION BY model)::DOUBLE AS tn FROM mpts)""",
        f"ranked AS (SELECT model, {AUC} AS roc_auc, {AP} AS avg_precision FROM mcum GROUP BY model)",
    )


def _metric_rows(source: str) -> str:
    columns = _round("accuracy", "precision", "recall", "f1", "f1_macro", "roc_auc", "avg_precision")
    return f"""SELECT model, {columns}
FROM (SELECT *, (f1 + ham_f1) / 2 AS f1_macro FROM ({_rates(_cells(source, 'model'), 'model')})) JOIN ranked USING (model)"""


# --- sources and validation ---------------------------------------------------------------------------------

ORACLE["load_labelled"] = _with(MSGS, select="SELECT msg_id, label, message FROM msgs")
ORACLE["split_roundtrip"] = _with(
    *PREPARED, select="SELECT msg_id, message_clean AS message, y, split FROM prep"
)
ORACLE["validate"] = _with(MSGS, VALID, select="SELECT msg_id, label, message FROM valid")
ORACLE["dedup"] = "SELECT min(doc_id) AS msg_id, text AS message FROM documents GROUP BY text"
ORACLE["invalid_labels"] = "SELECT DISTINCT lang FROM documents WHERE lang NOT IN ('en', 'de')"
ORACLE["drop_report"] = _with(
    MSGS,
    f"""marked AS (
  SELECT message IS NULL OR label IS NULL AS missing, {_clean('message')} = '' AS empty,
         row_number() OVER (PARTITION BY message, message IS NULL OR label IS NULL ORDER BY msg_id) AS rn FROM msgs)""",
    select="""SELECT count(*) AS n_rows, count(*) FILTER (missing) AS dropped_missing,
       count(*) FILTER (NOT missing AND rn > 1) AS dropped_duplicate,
       count(*) FILTER (NOT missing AND rn = 1 AND empty) AS dropped_empty,
       count(*) FILTER (NOT missing AND rn = 1 AND NOT empty) AS n_left FROM marked""",
)
ORACLE["class_balance"] = _with(
    MSGS,
    select="""SELECT label, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM msgs), 6) AS pct,
       (SELECT count(*) FROM msgs) AS n_rows, 3 AS n_columns FROM msgs GROUP BY label""",
)
ORACLE["imbalance"] = _with(
    MSGS,
    select="""SELECT ham, spam, CASE WHEN ham > 0 AND spam > 0 THEN round(ham / spam::DOUBLE, 6) END AS ratio
FROM (SELECT count(*) FILTER (label = 'ham') AS ham, count(*) FILTER (label = 'spam') AS spam FROM msgs)""",
)

# --- text ----------------------------------------------------------------------------------------------------

ORACLE["clean_text"] = f"SELECT doc_id AS msg_id, {_clean('text')} AS message_clean FROM documents"
ORACLE["clean_pages"] = f"SELECT page_id, {_clean('html')} AS html_clean FROM pages"
ORACLE["clean_nonempty"] = _with(
    MSGS,
    select=f"""SELECT * FROM (SELECT msg_id, label, {_clean('message')} AS message_clean FROM msgs)
WHERE message_clean <> ''""",
)
ORACLE["label_encode"] = _with(
    MSGS,
    CODED,
    select="""SELECT msg_id, y, CASE y WHEN 0 THEN 'ham' WHEN 1 THEN 'spam' END AS decoded,
       CASE WHEN y = 0 THEN 'ham' ELSE 'spam' END AS collection_label FROM coded""",
)
SHOWN = "CASE WHEN length({0}) > 100 THEN substr({0}, 1, 97) || '...' ELSE {0} END"
ORACLE["truncate"] = f"SELECT doc_id AS msg_id, {SHOWN.format('text')} AS shown FROM documents"
LENGTHS = r"length({0}) AS char_count, len(regexp_extract_all({0}, '\S+')) AS word_count"
ORACLE["text_lengths"] = f"SELECT doc_id AS msg_id, {LENGTHS.format('text')} FROM documents"
ORACLE["clean_examples"] = _with(
    MSGS,
    select=f"""SELECT msg_id, substr(message, 1, 100) AS original, substr(c, 1, 100) AS cleaned
FROM (SELECT *, {_clean('message')} AS c FROM msgs) WHERE c <> '' ORDER BY msg_id LIMIT 3""",
)
ORACLE["tokens"] = f"""SELECT doc_id AS msg_id, array_to_string({_words(_clean('text'))}, ' ') AS tokens FROM documents"""
ORACLE["ngrams"] = f"""SELECT msg_id, array_to_string({_grams('k')}, '|') AS ngrams
FROM (SELECT doc_id AS msg_id, {_words(_clean('text'))} AS k FROM documents)"""
_LENGTH_STATS = ", ".join(
    f"{{0}}(avg({u}_count), {{1}}) AS {u}_mean, {{0}}(stddev_samp({u}_count), {{1}}) AS {u}_std, "
    f"{{0}}(median({u}_count), {{1}}) AS {u}_median, max({u}_count) AS {u}_max"
    for u in ("char", "word")
)
ORACLE["length_stats"] = _with(
    MSGS,
    select=f"SELECT {_LENGTH_STATS.format('round', 6)} FROM (SELECT {LENGTHS.format('message')} FROM msgs)",
)
ORACLE["length_stats_by_class"] = _with(
    MSGS,
    select=f"""SELECT label, {_LENGTH_STATS.format('round_even', 2)}
FROM (SELECT label, {LENGTHS.format('message')} FROM msgs) GROUP BY label""",
)

# --- splits --------------------------------------------------------------------------------------------------

EXACT = """sized AS (SELECT y, count(*) AS n FROM coded GROUP BY y),
shared AS (
  SELECT y, n, n * ceil(0.2::DOUBLE * sum(n) OVER ()) / sum(n) OVER () AS exact, ceil(0.2::DOUBLE * sum(n) OVER ()) AS wanted
  FROM sized),
quotas AS (
  SELECT y, floor(exact) + (row_number() OVER (ORDER BY exact - floor(exact) DESC, y)
         <= wanted - sum(floor(exact)) OVER ())::INTEGER AS quota FROM shared),
ranked AS (
  SELECT msg_id, y, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || msg_id::VARCHAR), msg_id) AS rank FROM coded),
exact AS (
  SELECT msg_id, y, CASE WHEN rank <= quota THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quotas USING (y))"""
ORACLE["split_exact"] = _with(MSGS, CODED, EXACT, select="SELECT msg_id, y, split FROM exact")
ORACLE["split_report"] = _with(
    MSGS,
    CODED,
    EXACT,
    select="""SELECT split, y, n, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY split), 6) AS class_pct,
       round(sum(n) OVER (PARTITION BY split) * 100.0::DOUBLE / sum(n) OVER (), 6) AS split_pct
FROM (SELECT split, y, count(*) AS n FROM exact GROUP BY split, y)""",
)
ORACLE["split_hash"] = f"SELECT doc_id AS msg_id, {_split('doc_id')} AS split FROM documents"
ORACLE["sample_per_class"] = _with(
    MSGS,
    select=f"""SELECT label, rank::INTEGER AS rank, msg_id, {SHOWN.format('message')} AS shown
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || msg_id::VARCHAR), msg_id) AS rank FROM msgs)
WHERE rank <= 5""",
)
ORACLE["folds"] = _with(
    MSGS,
    CODED,
    select="""SELECT msg_id, y, ((row_number() OVER (
         PARTITION BY y ORDER BY md5('42:' || msg_id::VARCHAR), msg_id) - 1) % 5)::INTEGER AS fold FROM coded""",
)
ORACLE["class_weights"] = _with(
    MSGS,
    CODED,
    select="""SELECT y, n, round(sum(n) OVER () / (count(*) OVER () * n)::DOUBLE, 6) AS weight
FROM (SELECT y, count(*) AS n FROM coded GROUP BY y)""",
)

# --- features ------------------------------------------------------------------------------------------------

ORACLE["term_stats"] = _with(
    *PREPARED,
    TF,
    select="SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf WHERE split = 'train' GROUP BY term",
)
ORACLE["vocabulary"] = _with(
    *PREPARED, TF, VOCAB, select="SELECT term, idx, df, cf, round(idf, 6) AS idf FROM vocab"
)
ORACLE["feature_names"] = _with(
    *PREPARED, TF, VOCAB, select="SELECT idx, term FROM vocab ORDER BY term LIMIT 20"
)
for _part in ("train", "test"):
    ORACLE[f"tfidf_{_part}"] = _with(
        *TFIDF, select=f"SELECT msg_id, term, round(w, 6) AS weight FROM weights WHERE split = '{_part}'"
    )
ORACLE["hash_embedding"] = f"""WITH toks AS (
  SELECT msg_id, (('0x' || substr(md5(tok), 1, 8))::BIGINT % {DIM})::INTEGER AS dim, count(*)::DOUBLE AS n
  FROM (SELECT doc_id AS msg_id, unnest({_words(_clean('text'))}) AS tok FROM documents) GROUP BY ALL),
scaled AS (SELECT msg_id, dim, n / sqrt(sum(n * n) OVER (PARTITION BY msg_id)) AS w FROM toks)
SELECT doc_id AS msg_id, g.dim, round(coalesce(w, 0)::FLOAT::DOUBLE, 5) AS value
FROM documents d CROSS JOIN (SELECT unnest(range(0, {DIM}))::INTEGER AS dim) g
LEFT JOIN scaled s ON s.msg_id = d.doc_id AND s.dim = g.dim"""

# --- vectors -------------------------------------------------------------------------------------------------


def _neighbors(distance: str) -> str:
    return f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
SELECT query_id, rank::INTEGER AS rank, id, round(distance, 6) AS distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
      FROM (SELECT q.vec_id AS query_id, c.vec_id AS id, {distance} AS distance FROM v q CROSS JOIN v c))
WHERE rank <= {K_NEIGHBORS}"""


ORACLE["knn_l2"] = _neighbors("list_distance(q.e, c.e) * list_distance(q.e, c.e)")
ORACLE["knn_cosine"] = _neighbors("list_cosine_distance(q.e, c.e)")
ORACLE["vector_collection"] = f"""SELECT split || '_' || vec_id::VARCHAR AS id, 'vector ' || vec_id::VARCHAR AS document,
       len(embedding) AS dim, CASE WHEN label = 0 THEN 'ham' ELSE 'spam' END AS label, split
FROM (SELECT *, {_split('vec_id')} AS split FROM embeddings)"""
ORACLE["collection_stats"] = "SELECT 'messages' AS name, count(*) AS count FROM embeddings"

# --- metrics and thresholds ----------------------------------------------------------------------------------

ORACLE["confusion"] = _with(
    *SCORED,
    select="""SELECT g.y, g.pred, count(s.msg_id) AS n FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(y, pred)
LEFT JOIN scored s ON s.y = g.y AND s.pred = g.pred GROUP BY g.y, g.pred""",
)
ORACLE["class_report"] = _with(
    *SCORED,
    f"r AS ({_rates(_cells('scored'))})",
    select="""SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support
FROM (SELECT 'ham' AS class, ham_precision AS precision, ham_recall AS recall, ham_f1 AS f1, n0 AS support FROM r UNION ALL
      SELECT 'spam', precision, recall, f1, n1 FROM r UNION ALL
      SELECT 'accuracy', accuracy, accuracy, accuracy, n0 + n1 FROM r UNION ALL
      SELECT 'macro avg', (precision + ham_precision) / 2, (recall + ham_recall) / 2, (f1 + ham_f1) / 2, n0 + n1 FROM r UNION ALL
      SELECT 'weighted avg', (precision * n1 + ham_precision * n0) / (n0 + n1),
             (recall * n1 + ham_recall * n0) / (n0 + n1), (f1 * n1 + ham_f1 * n0) / (n0 + n1), n0 + n1 FROM r)""",
)
_NAMED = "named AS (SELECT 'NearestCentroid' AS model, * FROM scored)"
ORACLE["metrics"] = _with(*SCORED, _NAMED, *_evaluated("named"), select=_metric_rows("named"))
ORACLE["class_metrics"] = _with(
    *SCORED,
    select=f"""SELECT round(recall, 6) AS spam_recall, round(ham_precision, 6) AS ham_precision
FROM ({_rates(_cells('scored'))})""",
)
ORACLE["pr_curve"] = _with(*SCORED, CURVE, select=f"SELECT {_round('threshold', 'precision', 'recall')} FROM curve")
ORACLE["roc_auc"] = _with(*SCORED, CURVE, select=f"SELECT round({AUC}, 6) AS roc_auc FROM cum")
ORACLE["avg_precision"] = _with(*SCORED, CURVE, select=f"SELECT round({AP}, 6) AS avg_precision FROM cum")
for _metric, _score in {
    "f1": "2 * precision * recall / (precision + recall + 1e-10)",
    "precision": "precision",
    "recall": "recall",
}.items():
    ORACLE[f"best_threshold_{_metric}"] = _with(
        *SCORED,
        CURVE,
        select=f"""SELECT round(coalesce(threshold, 0.5), 6) AS threshold, round(score, 6) AS score
FROM (SELECT threshold, {_score} AS score FROM curve) c ORDER BY c.score DESC, c.threshold NULLS LAST LIMIT 1""",
    )
ORACLE["high_recall_threshold"] = _with(
    *SCORED,
    CURVE,
    select="""SELECT round(coalesce(threshold, 0.0), 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall
FROM curve c WHERE c.recall >= 1.0 ORDER BY c.precision DESC, c.threshold NULLS LAST LIMIT 1""",
)
ORACLE["cascade_thresholds"] = _with(
    *STAGE1,
    TUNED,
    select="""SELECT any_value(low) AS stage1_low_threshold, any_value(high) AS stage1_high_threshold,
       round(1 - avg((p > low AND p < high)::INTEGER), 6) AS stage1_coverage, 0.5::DOUBLE AS stage2_threshold
FROM s1, tuned WHERE split = 'train'""",
)
ORACLE["cascade_thresholds_target"] = _with(
    *TRAIN_SCORED,
    CURVE,
    """edge AS (
  SELECT coalesce(threshold, 0.0) AS edge FROM curve c WHERE c.recall >= 1.0
  ORDER BY c.precision DESC, c.threshold NULLS LAST LIMIT 1)""",
    "lows AS (SELECT coalesce(max(p) FILTER (p < edge), -1.0) AS low FROM scored, edge)",
    """tried AS (
  SELECT c.p AS high, (SELECT count(*) FROM scored s, lows l WHERE s.p > l.low AND s.p < c.p) AS undecided
  FROM (SELECT DISTINCT p FROM scored) c, lows WHERE c.p > low)""",
    """highs AS (
  SELECT coalesce(max(high) FILTER (1 - undecided / (SELECT count(*) FROM scored)::DOUBLE >= 0.8::DOUBLE),
                  (SELECT low FROM lows)) AS high FROM tried)""",
    select="""SELECT any_value(low)::DOUBLE AS stage1_low_threshold, any_value(high)::DOUBLE AS stage1_high_threshold,
       round(1 - avg((p > low AND p < high)::INTEGER), 6) AS stage1_coverage, 0.5::DOUBLE AS stage2_threshold
FROM scored, lows, highs""",
)

# --- models, cascade, comparison -----------------------------------------------------------------------------

TEXT_BOARD = (*TFIDF, TEXT_MODEL, TEXT_TEST)
HASH_BOARD = (HASHED, HASH_MODEL, DENSE, VOTES, HASH_TEST)
ORACLE["leaderboard"] = _with(*TEXT_BOARD, select=_rounded_board("text_pred"))
ORACLE["leaderboard_embedding"] = _with(*PREPARED, *HASH_BOARD, select=_rounded_board("hash_pred"))
ORACLE["top_models"] = _with(
    *TEXT_BOARD, select=f"SELECT * FROM ({_rounded_board('text_pred')}) ORDER BY f1 DESC, model LIMIT 10"
)
ORACLE["best_model"] = _with(
    *TEXT_BOARD,
    select=f"SELECT model, f1 AS score FROM ({_rounded_board('text_pred')}) ORDER BY f1 DESC, model LIMIT 1",
)
ORACLE["approach_summary"] = _with(
    *TEXT_BOARD,
    *HASH_BOARD,
    f"""boards AS (
  SELECT 'Traditional ML' AS approach, * FROM ({_rounded_board('text_pred')}) UNION ALL
  SELECT 'Embedding-based', * FROM ({_rounded_board('hash_pred')}))""",
    """firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY approach ORDER BY f1 DESC, model) AS rn FROM boards) WHERE rn = 1)""",
    select="""SELECT approach, f.model AS best_model, f.f1 AS best_f1, f.accuracy AS best_accuracy, f.precision AS best_precision,
       f.recall AS best_recall, f.roc_auc AS best_roc_auc, mean_f1, median_f1, std_f1
FROM firsts f JOIN (SELECT approach, round(avg(f1), 6) AS mean_f1, round(median(f1), 6) AS median_f1,
                           round(stddev_samp(f1), 6) AS std_f1 FROM boards GROUP BY approach) USING (approach)""",
)
ORACLE["cascade_rows"] = _with(
    *CASCADE,
    select="""SELECT msg_id, y, prediction, round(confidence, 6) AS confidence, stage_used, stage1_proba, stage2_proba, p
FROM routed""",
)
ORACLE["stage_stats"] = _with(
    *CASCADE,
    select="""SELECT count(*) AS total, count(*) FILTER (stage_used = 1) AS stage1_count,
       count(*) FILTER (stage_used = 2) AS stage2_count,
       round(count(*) FILTER (stage_used = 1) / count(*)::DOUBLE * 100, 6) AS stage1_pct,
       round(count(*) FILTER (stage_used = 2) / count(*)::DOUBLE * 100, 6) AS stage2_pct FROM routed""",
)
ORACLE["stage_metrics"] = _with(
    *CASCADE,
    """staged AS (
  SELECT 'HybridCascade' AS model, y, prediction AS pred, p FROM routed UNION ALL
  SELECT 'Stage' || stage_used, y, prediction, p FROM routed)""",
    "whole AS (SELECT * FROM staged WHERE model = 'HybridCascade')",
    *_evaluated("whole"),
    select=f"""SELECT model, (n1 + n0)::BIGINT AS n,
       {_round('accuracy', 'precision', 'recall', 'f1', 'f1_macro', 'roc_auc', 'avg_precision')}
FROM (SELECT *, (f1 + ham_f1) / 2 AS f1_macro FROM ({_rates(_cells('staged', 'model'), 'model')}))
LEFT JOIN ranked USING (model)""",
)
ORACLE["final_comparison"] = _with(
    *CASCADE,
    """stacked AS (
  SELECT 'Traditional-ML' AS model, y, p, pred FROM s1 WHERE split = 'test' UNION ALL
  SELECT 'Embedding-ML', y, p, pred FROM s2 WHERE split = 'test' UNION ALL
  SELECT 'HybridCascade', y, p, prediction FROM routed)""",
    *_evaluated("stacked"),
    select=_metric_rows("stacked"),
)
