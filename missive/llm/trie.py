"""Conversation prefix trie with totals of all subtrees.

A node is a distinct sequence of first turns.  Nodes are named by the running sum of 128-bit hashes of (place, role,
text), so that a conversation's turns can lie in many tasks: running sums go over chunks of turns, offset by the sums
of the chunks before.

``rollup`` totals subtrees by centroid decomposition of the parent-edge forest: in every round each large component is
cut at its centroid (the deepest node with half of the component in its subtree).  What hangs below becomes components
of their own, what is above stays one; the total of all that was cut off is added along the path from the centroid to
the component's top.  Components halve, so a trie as deep as the table is long takes a logarithmic number of rounds.
Components of at most ``LIMIT`` nodes are totalled in one task each, many to a task, streamed.

Every node has an owner, the smallest conversation through it.  The nodes that a conversation owns end its path, so the
sizes of all subtrees come from one aggregate: each member adds the nodes that it owns at that depth or below.

Defined results: turns ascend with nulls first, equal turns by the SHA-256 of role and text; a null role or text is
empty; rows without conv_id take no part; repeated rows are turns of their own; without conversations there is no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import placed, saved, shuffle_width

#: Turns of one conversation that one task sums, and the nodes of a component that one task totals.
CHUNK, LIMIT = 16_384, 256
#: Conversation ids that are written into one row before a list of them is hashed.
IDS_A_ROW = 65_536

_SUMS = ("s0", "s1", "s2", "s3")
_NODE = ("comp", "node", "parent", "depth", "owner", "size")
WORD = r"[^\x20\x09-\x0D]+"


def turns(rows: DataFrame) -> DataFrame:
    """(conv, turn, h, words) of rows (conv_id, turn, role, text); h: SHA-256 of role and text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"),
        "turn",
        F.unhex(F.sha2(told, 256)).alias("h"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )


def sequences(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns in order, as (conv, depth, h, words) from depth 1 on, and the conversations (conv, len)."""
    laid = saved(placed(turns(rows), "conv", ["turn", "h"]), "turns")
    convs = laid.where("pos = 0").select("conv", F.col("n").alias("len"))
    return laid.select("conv", (F.col("pos") + 1).alias("depth"), "h", "words"), convs


def rebuilt(own: DataFrame, convs: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of another one, in the form of ``sequences``.

    Conversation c begins with the first h = crc32(c) % ``most`` turns of conversation c - c % ``every`` (all, if there
    are fewer), and goes on with its own turns after its first h.
    """
    h = (F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % most).alias("skip")
    named = convs.select("conv", "len", h, (F.col("conv") - F.col("conv") % every).alias("base"))
    bases = convs.where(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.col("len").alias("base_len"))
    taken = F.least("skip", F.coalesce("base_len", F.lit(0)))
    named = saved(named.join(bases, "base", "left").select("conv", "len", "skip", "base", taken.alias("taken")), "named")
    heads = own.where((F.col("depth") < most) & (F.col("conv") % every == 0)).withColumnRenamed("conv", "base")
    heads = heads.join(named, "base").where("depth <= taken").select("conv", "depth", "h", "words")
    tails = own.join(named.select("conv", "skip", "taken"), "conv").where("depth > skip")
    tails = tails.select("conv", (F.col("depth") - F.col("skip") + F.col("taken")).alias("depth"), "h", "words")
    length = F.col("taken") + F.greatest(F.lit(0), F.col("len") - F.col("skip"))
    return heads.unionByName(tails), named.select("conv", length.alias("len"))


def _key(depth, sums):
    return F.unhex(F.md5(F.concat_ws(",", depth, *sums)))


def root_key():
    zero = F.lit(0).cast("bigint")
    return _key(zero, [zero] * 4)


def paths(sequence: DataFrame, convs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv, depth, node, parent, words) of each conversation's prefixes, from the root (depth 0) on."""
    low = F.lit((1 << 32) - 1)
    hashes = [F.xxhash64(F.lit(seed), "depth", "h") for seed in (1, 2)]
    parts = [x for h in hashes for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(low))]
    rows = sequence.withColumns({f"x{k}": x for k, x in enumerate(parts)})
    rows = rows.withColumn("chunk", F.floor((F.col("depth") - 1) / chunk)).drop("h")
    inside = W.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    rows = saved(rows.withColumns({s: F.sum(f"x{k}").over(inside) for k, s in enumerate(_SUMS)}), "sums")
    # only conversations of several chunks have offsets
    long = rows.join(rows.where("chunk > 0").select("conv").distinct(), "conv", "left_semi").groupBy("conv", "chunk")
    totals = long.agg(*[F.sum(f"x{k}").alias(f"t{k}") for k in range(4)])
    before = W.partitionBy("conv").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("conv", "chunk", *[F.sum(f"t{k}").over(before).alias(f"o{k}") for k in range(4)])
    rows = rows.join(offsets, ["conv", "chunk"], "left")
    sums = [F.col(s) + F.coalesce(f"o{k}", F.lit(0)) for k, s in enumerate(_SUMS)]
    above = [s - F.col(f"x{k}") for k, s in enumerate(sums)]
    found = rows.select(
        "conv", "depth", _key(F.col("depth"), sums).alias("node"), _key(F.col("depth") - 1, above).alias("parent"), "words"
    )
    zero = F.lit(0).cast("bigint")
    root = convs.select(
        "conv",
        zero.alias("depth"),
        root_key().alias("node"),
        F.lit(None).cast("binary").alias("parent"),
        zero.alias("words"),
    )
    return found.unionByName(root)


def numbered(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """(node, parent, depth, words, owner, n_convs, size, n_children) of all nodes of ``paths``.

    owner: the smallest conversation through a node; size: the nodes of its subtree.
    """
    found = steps.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("words").alias("words"),
        F.min("conv").alias("owner"),
        F.count("*").alias("n_convs"),
    )
    found = saved(found, "nodes")
    owned = found.groupBy(F.col("owner").alias("conv")).agg(F.min("depth").alias("from")).join(convs, "conv")
    held = F.col("len") - F.greatest("from", "depth") + 1
    sizes = steps.join(owned, "conv").groupBy("node").agg(F.sum(held).alias("size"))
    children = found.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
    children = children.agg(F.count("*").alias("n_children"))
    joined = found.join(sizes, "node").join(children, "node", "left")
    return joined.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))


def _local(names: list[str], weights: int):
    """Totals of small components; rows (comp, node, parent, weights, added), the deepest of a component first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comp, waiting = None, {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            out = []
            for own, node, parent, *numbers in zip(*columns):
                if own != comp:
                    comp, waiting = own, {}
                total = [x + y for x, y in zip(numbers[:weights], waiting.pop(node, (0,) * weights))]
                more = waiting.get(parent)
                waiting[parent] = total if more is None else [x + y for x, y in zip(total, more)]
                out.append([x + y for x, y in zip(total, numbers[weights:])])
            arrays = [pa.array([r[k] for r in out], pa.int64()) for k in range(weights)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *arrays], ["node", *names])

    return run


def rollup(nodes: DataFrame, steps: DataFrame, weights: list[str], limit: int = LIMIT) -> DataFrame:
    """(node, weights): the weights (whole numbers) summed over each node's subtree, itself included.

    ``nodes`` has (comp, node, parent, depth, owner, size, weights), comp being the root of the node's tree; ``steps``
    has the prefixes of the owners (conv, depth, node, parent).  Only rows in large components are in a round's joins.
    """
    added = [f"added_{c}" for c in weights]
    zero = F.lit(0).cast("bigint")
    rows = nodes.select(*_NODE, *[F.col(c).cast("bigint") for c in weights], *[zero.alias(a) for a in added])
    steps = steps.select(
        F.col("conv").alias("owner"), F.col("depth").alias("at"), F.col("node").alias("label"), F.col("parent").alias("via")
    )
    small, cut = [], []
    while True:
        totals = rows.groupBy("comp").agg(F.max("size").alias("total"))
        rows = saved(rows.join(totals, "comp"), "components")
        small.append(rows.where(F.col("total") <= limit))
        rows = rows.where(F.col("total") > limit)
        if rows.isEmpty():
            break
        # the nodes with half of a component below them lie on one path; the deepest is the centroid
        half = rows.where(2 * F.col("size") >= F.col("total"))
        core = half.groupBy("comp").agg(F.max_by(F.struct("node", "depth", "owner", "size"), "depth").alias("c"))
        core = saved(core.select("comp", *[F.col(f"c.{x}").alias(f"c_{x}") for x in ("node", "depth", "owner", "size")]), "centroids")
        upward = core.join(steps, F.col("c_owner") == F.col("owner")).where("at < c_depth")
        upward = upward.select("comp", F.col("label").alias("node"), F.lit(True).alias("on_path"))
        split = rows.join(core, "comp").withColumn("at", F.col("c_depth") + 1).join(steps, ["owner", "at"], "left")
        below = (F.col("depth") > F.col("c_depth")) & F.coalesce(F.col("via") == F.col("c_node"), F.lit(False))
        split = split.withColumns({"below": below, "core": F.col("node") == F.col("c_node")})
        split = saved(split.join(upward, ["comp", "node"], "left").withColumn("on_path", F.coalesce("on_path", F.lit(False))), "split")
        off = split.where("below OR core").groupBy("comp").agg(*[F.sum(c).alias(f"off_{c}") for c in weights])
        split = split.join(off, "comp")
        cut.append(
            saved(split.where("core").select("node", *[(F.col(f"off_{c}") + F.col(f"added_{c}")).alias(c) for c in weights]), "cut")
        )
        rest = split.where("NOT core")
        rows = rest.select(
            F.when(F.col("below"), F.col("label")).otherwise(F.col("comp")).alias("comp"),
            "node",
            "parent",
            "depth",
            "owner",
            F.when(F.col("on_path"), F.col("size") - F.col("c_size")).otherwise(F.col("size")).alias("size"),
            *weights,
            *[F.when(F.col("on_path"), F.col(a) + F.col(f"off_{c}")).otherwise(F.col(a)).alias(a) for a, c in zip(added, weights)],
        )
    out = None
    for part in small:
        out = part if out is None else out.unionByName(part)
    out = out.select("comp", "node", "parent", *weights, *added, "depth").repartition(shuffle_width(nodes), "comp")
    out = out.sortWithinPartitions("comp", F.desc("depth")).drop("depth")
    ddl = ", ".join(["node binary", *(f"{c} bigint" for c in weights)])
    out = out.mapInArrow(_local(weights, len(weights)), ddl)
    for part in cut:
        out = out.unionByName(part)
    return out


def _id_rows(most: int):
    """(node, first, ids) of the sorted rows (node, conv): the decimal ids, comma-joined, ``most`` at most a row."""
    kinds = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])

    def row(node, ids):
        return {"node": node, "first": ids[0], "ids": ",".join(map(str, ids))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        for batch in batches:
            out = []
            for own, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (own != node or len(ids) == most):
                    out.append(row(node, ids))
                    ids = []
                node = own
                ids.append(conv)
            yield pa.RecordBatch.from_pylist(out, kinds)
        if ids:
            yield pa.RecordBatch.from_pylist([row(node, ids)], kinds)

    return run


def _list_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sha256) of the sorted rows (node, first, ids), streamed."""
    kinds = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    node, state = None, None
    for batch in batches:
        out = []
        for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if own != node:
                if state is not None:
                    out.append({"node": node, "ends_sha256": state.hexdigest()})
                node, state = own, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pa.RecordBatch.from_pylist(out, kinds)
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"node": node, "ends_sha256": state.hexdigest()}], kinds)


def ends(steps: DataFrame, convs: DataFrame, ids_a_row: int = IDS_A_ROW) -> DataFrame:
    """(node, ends_sha256) of the nodes where conversations end: the hash of their ids, ascending.

    Ids are sorted by ranges of (node, id) and joined to long rows first, so the one task that hashes the list of a node
    streams few rows.
    """
    width = shuffle_width(steps)
    last = steps.join(convs, "conv").where("depth = len").select("node", "conv")
    dealt = saved(last, "ends").repartitionByRange(width, "node", "conv").sortWithinPartitions("node", "conv")
    lists = dealt.mapInArrow(_id_rows(ids_a_row), "node binary, first bigint, ids string")
    lists = lists.repartition(width, "node").sortWithinPartitions("node", "first")
    return lists.mapInArrow(_list_hashes, "node binary, ends_sha256 string")


def trie(sequence: DataFrame, convs: DataFrame, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, node, parent).

    conv_id: the smallest conversation through the node; saved_tokens: over the subtree, the words of each node's last
    turn times the conversations that share it, less one.
    """
    steps = saved(paths(sequence, convs, chunk), "paths")
    convs = saved(convs, "convs")
    nodes = numbered(steps, convs)
    nodes = nodes.withColumns(
        {
            "comp": root_key(),
            "n_leaves": (F.col("n_children") == 0).cast("bigint"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    nodes = saved(nodes, "numbered")
    totals = rollup(nodes, steps, ["n_leaves", "saved_tokens"], limit)
    over = nodes.select(F.col("node").alias("parent"), F.col("owner").alias("parent_conv_id"))
    named = nodes.drop("comp", "n_leaves", "saved_tokens").join(over, "parent", "left")
    named = named.join(totals, "node").join(ends(steps, convs), "node", "left")
    empty = F.sha2(F.lit(""), 256)
    return named.select(
        F.col("owner").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        "node",
        "parent",
    )
