"""Merkle manifest of a dataset, with the proofs of all leaves (octopus multiproof).

A leaf is the SHA-256 of a row's fields.  The leaves of a group (a language) ascend by id; while several nodes remain,
every ``RUN`` consecutive ones become their hash, and the last is the subroot of the group.  Subroots, in the order of
their groups, are the leaves of one more tree, whose last node is the root.

A task holds an aligned block of leaves.  It names the coordinates of the nodes that it lacks and that no other of its
leaves can derive (``missing``), gets each of them once from the table of nodes, derives the interiors that its leaves
share, and then writes out the proof of every single leaf.  Blocks have ``RUN ** LEVELS`` rows whatever a group's size,
so a hot group is many blocks.  A node high up is wanted by many blocks: it is asked for under several salts.

Defined results: a null field is ``-``; a null group is a group of its own, the first; ids ascend with nulls first,
equal ids by their leaves; repeated rows are leaves of their own; a table without rows has no root and no row.  Other
columns of the table play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import placed, saved

#: Nodes hashed together, and the levels that one block of leaves spans.
RUN, LEVELS = 8, 3
BLOCK = RUN**LEVELS
#: Blocks that ask for one copy of a node.
ASKING = RUN**3

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "at int, others array<binary>"


def hashed(digests) -> bytes:
    """The SHA-256 of the hexadecimal text of ``digests``."""
    return hashlib.sha256("".join(x.hex() for x in digests).encode()).digest()


def above(count: int) -> int:
    return -(-count // RUN)


def height(count: int) -> int:
    levels = 0
    while count > 1:
        count, levels = above(count), levels + 1
    return levels


def missing(start: int, end: int, count: int) -> list[tuple[int, int]]:
    """The coordinates (level, index) that leaves ``start`` to ``end`` of ``count`` need besides what they derive."""
    out, level = [], 0
    while count > 1:
        first, last = start // RUN * RUN, min(((end - 1) // RUN + 1) * RUN, count)
        out += [(level, i) for i in (*range(first, start), *range(end, last))]
        start, end, count, level = start // RUN, (end - 1) // RUN + 1, above(count), level + 1
    return out


def leaf(fields: dict[str, Column]) -> Column:
    """The digest of a row's fields."""

    def told(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.unhex(F.sha2(F.concat(*map(told, fields.values())), 256))


def _raise(levels: int, every: bool):
    """From the nodes (tree, level, idx, count, hash) of a block, those above, ``levels`` high: all or the last only."""

    def run(part: pa.Table) -> pa.Table:
        rows = sorted(zip(part["idx"].to_pylist(), part["hash"].to_pylist()))
        count, level, first = part["count"][0].as_py(), part["level"][0].as_py(), rows[0][0]
        tree, own = part["tree"][0].as_py(), [h for _, h in rows]
        found = [(level, first, count, own)]
        for _ in range(levels):
            if count == 1:
                break
            own = [hashed(own[k : k + RUN]) for k in range(0, len(own), RUN)]
            count, level, first = above(count), level + 1, first // RUN
            found.append((level, first, count, own))
        found = found[1:] if every else found[-1:]
        rows = [(tree, lv, at + k, n, h) for lv, at, n, hs in found for k, h in enumerate(hs)]
        return pa.Table.from_pylist([dict(zip(_NODE.names, r)) for r in rows], _NODE)

    return run


_NODE = pa.schema(
    [("tree", pa.string()), ("level", pa.int32()), ("idx", pa.int64()), ("count", pa.int64()), ("hash", pa.binary())]
)
_NODE_DDL = "tree string, level int, idx bigint, count bigint, hash binary"


def nodes(leaves: DataFrame, every: bool = False) -> DataFrame:
    """The nodes (tree, level, idx, count, hash) over ``leaves`` (tree, pos, n, hash); count: the nodes of that level.

    Without ``every`` the levels inside blocks of leaves are left out, but for the tops of the blocks and trees.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    rows = leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("n").alias("count"), "hash")
    found = []
    for base in range(0, max(1, height(most)), LEVELS):
        blocks = rows.groupBy("tree", F.floor(F.col("idx") / BLOCK).alias("block"))
        up = saved(blocks.applyInArrow(_raise(LEVELS, every or base > 0), _NODE_DDL), "nodes")
        found.append(up)
        rows = up.where(F.col("level") == base + LEVELS).where("count > 1")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    if every:  # the leaves of trees of one leaf are in no other level
        out = out.unionByName(leaves.where("n = 1").select("tree", F.lit(0).alias("level"), "pos", "n", "hash").toDF(*_NODE.names))
    return out


def subroots(found: DataFrame) -> DataFrame:
    return found.where("count = 1").select("tree", F.col("hash").alias("subroot"))


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tree, block, level, idx): what each block (tree, block, n) lacks."""
    for batch in batches:
        rows = []
        for tree, block, n in zip(*(c.to_pylist() for c in batch.columns)):
            lacks = missing(block * BLOCK, min((block + 1) * BLOCK, n), n)
            rows += [{"tree": tree, "block": block, "level": level, "idx": i} for level, i in lacks]
        kinds = [("tree", pa.string()), ("block", pa.int64()), ("level", pa.int32()), ("idx", pa.int64())]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def _fetched(leaves: DataFrame, found: DataFrame, higher: DataFrame | None) -> DataFrame:
    """(tree, block, level, idx, hash, higher, root): each node once for each block that lacks it, and one row of the
    block with the way from its subroot to the root."""
    blocks = leaves.where(F.col("pos") % BLOCK == 0).select("tree", F.floor(F.col("pos") / BLOCK).alias("block"), "n")
    # at a level r above the blocks, RUN ** r blocks have a node in common and its siblings' ask for it
    copies = F.greatest(F.lit(1.0), F.pow(F.lit(float(RUN)), F.col("level") - LEVELS) / ASKING).cast("bigint")
    asked = blocks.mapInArrow(_wanted, "tree string, block bigint, level int, idx bigint")
    asked = asked.withColumn("salt", F.pmod("block", copies))
    held = found.select("tree", "level", "idx", "hash", F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt"))
    got = asked.join(held, ["tree", "level", "idx", "salt"]).select("tree", "block", "level", "idx", "hash")
    got = got.withColumns({"higher": F.lit(None).cast(f"array<struct<{_STEP}>>"), "root": F.lit(None).cast("binary")})
    if higher is None:
        return got
    ways = blocks.join(higher, "tree").select(
        "tree", "block", F.lit(-1).alias("level"), F.lit(0).alias("idx"), F.lit(None).cast("binary").alias("hash"), "higher", "root"
    )
    return got.unionByName(ways)


class Family:
    """All that the leaves of one block know: own and fetched nodes, and the interiors derived from them."""

    def __init__(self, part: pa.Table, got: pa.Table):
        at = part["pos"].to_pylist()
        self.count = part["n"][0].as_py()
        self.known = {(0, p): h for p, h in zip(at, part["hash"].to_pylist())}
        self.higher, self.root = [], None
        for row in got.to_pylist():
            if row["level"] >= 0:
                self.known[row["level"], row["idx"]] = row["hash"]
            else:
                self.higher, self.root = row["higher"], row["root"]
        start, end, count, level = min(at), max(at) + 1, self.count, 0
        while count > 1:
            for i in range(start // RUN, (end - 1) // RUN + 1):
                run = range(i * RUN, min((i + 1) * RUN, count))
                self.known[level + 1, i] = hashed(self.known[level, j] for j in run)
            start, end, count, level = start // RUN, (end - 1) // RUN + 1, above(count), level + 1
        self.subroot = self.known[level, 0]
        if self.root is None:
            self.root = self.subroot
        self._ways: dict[tuple[int, int], list] = {}
        self._texts: dict[tuple[int, int], str] = {}

    def _step(self, level: int, i: int, count: int) -> dict:
        run = range(i // RUN * RUN, min((i // RUN + 1) * RUN, count))
        return {"at": i % RUN, "others": [self.known[level, j] for j in run if j != i]}

    def way(self, i: int, level: int = 0, count: int | None = None) -> list[dict]:
        """The siblings of node ``i`` up to the root: for each level its place in the run and the others of the run."""
        count = self.count if count is None else count
        if count == 1:
            return self.higher
        key = (level + 1, i // RUN)
        if key not in self._ways:
            self._ways[key] = self.way(i // RUN, level + 1, above(count))
        return [self._step(level, i, count), *self._ways[key]]

    def proof(self, i: int) -> list[str]:
        return [h.hex() for step in self.way(i) for h in step["others"]]

    def proof_sha256(self, i: int) -> str:
        key = (1, i // RUN)
        steps = self.way(i)
        if self.count == 1:
            return hashlib.sha256("".join(self.proof(i)).encode()).hexdigest()
        if key not in self._texts:
            self._texts[key] = "".join(h.hex() for step in steps[1:] for h in step["others"])
        own = "".join(h.hex() for h in steps[0]["others"])
        return hashlib.sha256((own + self._texts[key]).encode()).hexdigest()


def folded(node: bytes, way: list[dict]) -> bytes:
    """The root that follows from a node and its siblings."""
    for step in way:
        node = hashed([*step["others"][: step["at"]], node, *step["others"][step["at"] :]])
    return node


def _of_block(rows: DataFrame, got: DataFrame, make, ddl: str) -> DataFrame:
    """``make(family, part)`` of every block of the rows (tree, pos, n, hash, ...)."""

    def run(part: pa.Table, more: pa.Table) -> pa.Table:
        return make(Family(part, more), part)

    left = rows.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("tree", "block")
    return left.cogroup(got.groupBy("tree", "block")).applyInArrow(run, ddl)


def tops(roots: DataFrame) -> DataFrame:
    """(tree, higher, root) of each subroot: its way to the root, through blocks like those of the leaves."""
    rows = placed(roots.select(F.lit("").alias("all"), F.col("tree").alias("name"), F.col("subroot").alias("hash")), "all", ["name"])
    rows = saved(rows.withColumnRenamed("all", "tree"), "subroots")
    kinds = pa.schema(
        [("tree", pa.string()), ("higher", pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.binary()))]))), ("root", pa.binary())]
    )

    def make(family: Family, part: pa.Table) -> pa.Table:
        found = [
            {"tree": name, "higher": family.way(at), "root": family.root}
            for name, at in zip(part["name"].to_pylist(), part["pos"].to_pylist())
        ]
        return pa.Table.from_pylist(found, kinds)

    got = _fetched(rows, nodes(rows), None)
    return _of_block(rows, got, make, f"tree string, higher array<struct<{_STEP}>>, root binary")


def prove(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    altered: dict[str, Column] | None = None,
    with_proofs: bool = False,
) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root) of each row, and ``proof``, its siblings, if asked for.

    ``altered`` has columns that stand in for fields of the same name: folded_root then follows from the leaf of the
    altered row and the siblings of the unaltered ones.
    """
    group = F.col(group_col).cast("string")
    own = leaf({c: F.col(c) for c in fields})
    other = leaf({c: (altered or {}).get(c, F.col(c)) for c in fields})
    rows = docs.select(
        F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("tree"),
        F.col(id_col).alias("id"),
        own.alias("hash"),
        (other if altered else F.lit(None).cast("binary")).alias("other"),
    )
    rows = rows.withColumn("other", F.when(F.col("other") != F.col("hash"), F.col("other")))
    rows = saved(placed(rows, "tree", ["id", "hash"]), "leaves")
    found = nodes(rows)
    got = _fetched(rows, found, saved(tops(subroots(found)), "tops"))
    kind = rows.schema["id"].dataType.simpleString()
    texts = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def make(family: Family, part: pa.Table) -> pa.Table:
        at, own, other = (part[c].to_pylist() for c in ("pos", "hash", "other"))
        arrays = [
            part["id"],
            [x.hex() for x in own],
            [family.subroot.hex()] * len(at),
            [family.root.hex()] * len(at),
            [family.proof_sha256(i) for i in at],
            [folded(changed or x, family.way(i)).hex() for i, x, changed in zip(at, own, other)],
        ]
        if with_proofs:
            arrays.append(pa.array([family.proof(i) for i in at], pa.list_(pa.string())))
        return pa.table([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, pa.string()) for x in arrays], names)

    names = ["id", *texts, *(["proof"] if with_proofs else [])]
    ddl = ", ".join([f"id {kind}", *(f"{c} string" for c in texts), *(["proof array<string>"] if with_proofs else [])])
    return _of_block(rows, got, make, ddl)
