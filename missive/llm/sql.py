"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_WORDS} AS w FROM benchmark),
places AS (SELECT item, w, least(13, len(w)) AS size, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i
           FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS key FROM places),
pos AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i
        FROM dw CROSS JOIN (SELECT DISTINCT size FROM win) WHERE len(w) >= size),
met AS (SELECT doc_id, i, p.size, item
        FROM (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS key FROM pos) p
        JOIN win ON win.size = p.size AND win.key = p.key),
hit AS (SELECT doc_id, count(DISTINCT j) AS n
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM met) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit ON hit.doc_id = dw.doc_id LEFT JOIN its ON its.doc_id = dw.doc_id"""

# Runs of 50 words, forwards from every line and backwards from every line, grouped by their text.
LINES = r"""WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL),
line AS (
  SELECT doc_id, i, x[i] AS body, len(regexp_extract_all(x[i], '[^ \t\r\x0B\x0C]+')) AS words
  FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM split)),
total AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM line),
runs AS (
  SELECT DISTINCT doc_id, a, b FROM (
    SELECT s.doc_id, s.i AS a, min(e.i) AS b FROM total s JOIN total e
      ON e.doc_id = s.doc_id AND e.i >= s.i AND e.upto - s.upto + s.words >= 50 GROUP BY ALL
    UNION ALL
    SELECT e.doc_id, max(s.i) AS a, e.i AS b FROM total s JOIN total e
      ON e.doc_id = s.doc_id AND e.i >= s.i AND e.upto - s.upto + s.words >= 50 GROUP BY e.doc_id, e.i)),
named AS (SELECT r.doc_id, a, b, array_to_string(x[a:b], chr(10)) AS key FROM runs r JOIN split USING (doc_id)),
later AS (
  SELECT doc_id, a, b FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, a) AS place FROM named) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(a, b + 1)) AS i FROM later)),
marked AS (SELECT l.doc_id, l.i, l.body, g.i IS NOT NULL AS out,
                  g.i IS NOT NULL AND lag(g.i) OVER (PARTITION BY l.doc_id ORDER BY l.i) IS NULL AS starts
           FROM line l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i),
numbered AS (SELECT *, sum(starts::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
texts AS (
  SELECT doc_id, min(i) - 1 AS s, max(i) AS e FROM numbered WHERE out GROUP BY doc_id, run),
listed AS (SELECT doc_id, count(*) AS n, string_agg(s || ':' || e, ',' ORDER BY s) AS runs FROM texts GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n, 0) AS n_runs,
       coalesce(runs, '') AS runs, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (out) AS n_removed,
                  string_agg(body, chr(10) ORDER BY i) FILTER (NOT out) AS kept FROM marked GROUP BY doc_id) m
  ON m.doc_id = d.doc_id
LEFT JOIN listed ON listed.doc_id = d.doc_id"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text: after each byte eight shifts, marked -1."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: [unicode(ch)::BIGINT{', -1' * 8}]))"
    turn = "CASE WHEN e >= 0 THEN xor(c, e) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, e: {turn}), 4294967295)"


def _climb(name: str, start: str, leaves: str, levels: int) -> str:
    """From nodes ``start`` (tree, i, n, h): levels ``name``0 and up; along them what follows from ``leaves`` (key, tree,
    i, cur, proof), with the siblings passed, as ``name``w0 and up."""
    out = [f"{name}0 AS ({start}), {name}w0 AS ({leaves})"]
    for k in range(levels):
        own = f"w.i // {8**k}"
        out.append(
            f"""{name}{k + 1} AS (SELECT tree, i // 8 AS i, (n + 7) // 8 AS n,
  CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY tree, i // 8, n),
{name}w{k + 1} AS (SELECT w.key, w.tree, w.i, CASE WHEN n = 1 THEN cur
    ELSE sha256(string_agg(CASE WHEN l.i = {own} THEN cur ELSE h END, '' ORDER BY l.i)) END AS cur,
  proof || coalesce(string_agg(h, '' ORDER BY l.i) FILTER (l.i <> {own}), '') AS proof
  FROM {name}w{k} w JOIN {name}{k} l ON l.tree = w.tree AND l.i // 8 = {own} // 8
  GROUP BY w.key, w.tree, w.i, cur, proof, n)"""
        )
    return ",\n".join(out)


_TEXT = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_TEXT.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_TAMPERED = (
    f"CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 "
    "THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
)

MERKLE = f"""WITH told AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_LEAF.format(text="text")} AS h,
  {_LEAF.format(text="tampered")} AS other FROM (SELECT *, {_TAMPERED} AS tampered FROM documents)),
leaf AS (SELECT *, row_number() OVER (ORDER BY tree) AS key, count(*) OVER (PARTITION BY tree) AS n,
  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM told),
{_climb("a", "SELECT tree, i, n, h FROM leaf", "SELECT key, tree, i, other AS cur, '' AS proof FROM leaf", 8)},
sub AS (SELECT tree AS name, '' AS tree, h, count(*) OVER () AS n, row_number() OVER (ORDER BY encode(tree)) - 1 AS i
  FROM a8),
{_climb("b", "SELECT tree, i, n, h FROM sub",
        "SELECT key, '' AS tree, sub.i, cur, proof FROM aw8 JOIN sub ON sub.name = aw8.tree", 3)}
SELECT doc_id, leaf.h AS leaf, sub.h AS subroot, b3.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
       cur = b3.h AS verified
FROM leaf JOIN bw3 ON bw3.key = leaf.key JOIN sub ON sub.name = leaf.tree CROSS JOIN b3"""

TRIE = rf"""WITH named AS (SELECT conv_id AS c, turn, sha256(strlen(r) || ':' || r || t) AS h,
    len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
own AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, h) AS d FROM named),
conv AS (SELECT c, max(d) AS n, {_crc32("c::VARCHAR")} % 4 AS skip, c - c % 20 AS base FROM own GROUP BY c),
meant AS (SELECT a.c, a.n, a.skip, a.base, least(a.skip, coalesce(b.n, 0)) AS taken FROM conv a LEFT JOIN conv b ON b.c = a.base),
turns AS (SELECT m.c, d, h, words FROM meant m JOIN own ON own.c = m.base AND d <= taken
  UNION ALL SELECT m.c, d - skip + taken, h, words FROM meant m JOIN own ON own.c = m.c AND d > skip),
path AS (SELECT c, d, words, string_agg(h, '') OVER (PARTITION BY c ORDER BY d) AS k FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM conv),
node AS (SELECT k, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
  CASE WHEN any_value(d) > 0 THEN left(k, -64) END AS up FROM path GROUP BY k),
kids AS (SELECT up, count(*) AS n FROM node GROUP BY up),
full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids ON kids.up = node.k),
below AS (SELECT a.k, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words)::BIGINT AS saved_tokens
  FROM full_node a JOIN full_node b ON starts_with(b.k, a.k) GROUP BY a.k),
last AS (SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM (SELECT *, max(d) OVER (PARTITION BY c) AS most FROM path) WHERE d = most GROUP BY k)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM full_node a JOIN below USING (k) LEFT JOIN node p ON p.k = a.up LEFT JOIN last ON last.k = a.k"""

TOP_K = """WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, o.vec_id, list_inner_product(q.v, o.v)::BIGINT AS score
  FROM v q JOIN v o ON q.vec_id % 50 = 0 AND (o.vec_id <> q.vec_id OR o.v <> q.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
