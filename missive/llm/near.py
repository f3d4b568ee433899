"""Classes of near-copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

The join is exact.  No radius of a 64-bit fingerprint is: pairs at 0.8 lie 3 to 11 and more bits apart, and at 11 bits
the pigeonhole leaves blocks of five bits, a thirty-second of all rows in each cell.

Candidates come from prefixes.  All shingles have one order, seldom ones first; two similar sets of sizes m and n share
a shingle among the first m - ceil(0.8 m) + 1 and n - ceil(0.8 n) + 1.  The order is taken from a sample, which decides
about speed only.  Sets with a common prefix shingle form a list, which is cut where sizes, and what is left of the sets
from that shingle on, exclude the similarity (``_shared``).  The classes of SimHash fingerprints (``simhash``, over
five-word shingles too) are lists as well: they bring near-copies together first.  A parity sketch (one bit for each of
some 4 n bins of the hashes) bounds the difference of two sets from below: the differing bits never exceed the differing
shingles.

Lists don't become pairs, whatever their size.  First every list has a leader, the others are compared with it alone, and
what is similar grows together; each turn draws other leaders.  What a leader was compared with is settled: it leaves its
list, and lists within one class go.  Then only members of different classes are left to
compare: a list is cut into blocks of bounded size by size class (a factor of 1.25: similar sets are in the same or the
next one) and class so far, and two blocks meet only if they hold different classes.  Of two classes the nearest members
are verified first, and all others only if these don't join them.

Sets are known by 128-bit hashes and numbered; shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import LOWER, components, forget, in_parts, placed, raw_texts, saved, scratch, shuffle_width, sweep

#: The least similarity as a fraction, so that 0.8 itself is decided without rounding.
LEAST = (4, 5)
SIZE = 5
#: Texts from which the order of the shingles is learned, and shingles it ranks.  Both decide about speed only.
SAMPLE_ROWS, RANKED = 16_384, 100_000

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
_FAR = np.iinfo(np.int64).max
_ODD = np.int64(0x1E3779B97F4A7C15)

#: Turns in which lists draw leaders; members of a block at most, and the bytes of their sketches.
TURNS, BLOCK, BLOCK_BYTES = 3, 256, 1 << 20


def shingles(text: bytes, size: int = SIZE) -> np.ndarray:
    """The distinct 64-bit hashes of all runs of ``size`` words, ascending.  A shorter text is one shingle."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    single = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    count = max(1, len(single) - size + 1)
    mixed = np.zeros(count, np.uint64)
    for k in range(min(size, len(single))):
        mixed = mixed * _P + single[k : k + count]
    mixed = (mixed ^ (mixed >> np.uint64(33))) * _Q
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def name_of(found: np.ndarray) -> bytes:
    """The 128-bit hash of a whole set."""
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(found.tobytes())


def print_of(found: np.ndarray) -> int:
    """The SimHash fingerprint of a set: a bit is set if it is set in over half of the shingles' hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(found), 65_536):
        part = np.ascontiguousarray(found[at : at + 65_536], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(found), bitorder="little").view("<u8")[0]) if len(found) else 0


def prefix_length(n: int, least: tuple[int, int] = LEAST) -> int:
    return n + (-n * least[0] // least[1]) + 1 if n else 0


def largest(n: int, at: np.ndarray, least: tuple[int, int] = LEAST) -> np.ndarray:
    """The sizes of the largest sets to which one of ``n`` shingles can be similar, if the first that both have is its
    shingle ``at``: they have n - at in common at most."""
    return np.maximum(sum(least) * (n - at) // least[0] - n, 0)


def sketch(found: np.ndarray) -> bytes:
    """The parities of the bins; their number is a power of two, four times the set or more."""
    bins = 1 << max(6, (4 * len(found) - 1).bit_length()) if len(found) else 64
    counts = np.bincount((found & np.uint64(bins - 1)).astype(np.int64), minlength=bins)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """(number, shingles) of the rows (number, text); shingles as signed longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_parts(batch, 1):
                found = [shingles(x, size).view(np.int64) for x in raw_texts(part.column(1))]
                arrays = [part.column(0), pa.array(found, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["number", "shingles"])

    return texts.select("number", "text").mapInArrow(run, "number bigint, shingles array<bigint>")


def _ranks(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that are frequent in a sample, ascending, and how often they are there."""
    share = max(1, docs.count() // SAMPLE_ROWS)
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).select(F.lit(0).cast("bigint").alias("number"), "text")
    counts = _sets(sample, size).select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    rows = counts.where("n > 2").orderBy(F.desc("n"), "s").limit(RANKED).collect()
    found = np.array([r["s"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], np.array([r["n"] for r in rows], np.int64)[order]


def _marks(docs: DataFrame, size: int) -> DataFrame:
    """(id, key, node, n, sketch, fp) of each row (id, key, text); fp: the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_parts(batch, 2):
                found = [shingles(x, size) for x in raw_texts(part.column(2))]
                prints = np.array([print_of(x) for x in found], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:2],
                        pa.array([name_of(x) for x in found], pa.binary()),
                        pa.array([len(x) for x in found], pa.int64()),
                        pa.array([sketch(x) for x in found], pa.binary()),
                        pa.array(prints.view(np.int64)),
                    ],
                    ["id", "key", "node", "n", "sketch", "fp"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, key binary, node binary, n bigint, sketch binary, fp bigint")


def _prefixes(texts: DataFrame, size: int, least: tuple[int, int]) -> DataFrame:
    """(s, node, n, most): the prefix shingles of each set (number, text), its size, and the ``largest`` one by them."""
    ranked, often = _ranks(texts, size)

    def prefix(found: np.ndarray) -> tuple[np.ndarray, int]:
        rank = np.zeros(len(found), np.int64)
        if len(ranked) and len(found):
            at = np.minimum(np.searchsorted(ranked, found), len(ranked) - 1)
            rank = np.where(ranked[at] == found, often[at], 0)
        first = np.argsort(rank, kind="stable")[: prefix_length(len(found), least)]
        return found[first].view(np.int64), len(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_parts(batch, 1, 1 << 20):
                found = [prefix(shingles(x, size)) for x in raw_texts(part.column(1))]
                if not found:
                    continue
                counts = [len(x) for x, _ in found]
                s = np.concatenate([x for x, _ in found])
                most = np.concatenate([largest(n, np.arange(len(x)), least) for x, n in found])
                columns = s, np.repeat(part.column(0).to_numpy(), counts), np.repeat([n for _, n in found], counts), most
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["s", "node", "n", "most"])

    return texts.select("number", "text").mapInArrow(run, "s bigint, node bigint, n bigint, most bigint")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(s, node): the lists of the rows (s, node, n, most), which ascend by s and n; one row is held back at a time.

    A list is cut before a size that is larger than any ``most`` before it, and a row whose ``most`` is smaller than the
    first size of its list goes: neither side has a pair that the other one allows.  Each list has its own s.
    """
    last = None  # of the last row: s, the largest ``most`` of its s so far, the first size of its list
    held, more = None, False  # the last row kept, and whether the one before it was of its list
    for batch in batches:
        s, node, n, most = (c.to_numpy() for c in batch.columns)
        if not len(s):
            continue
        new = np.r_[last is None or s[0] != last[0], s[1:] != s[:-1]]
        group = np.cumsum(new) << 40  # above all sizes, so that one running maximum serves all groups
        before = last[1:] if last else (0, 0)
        reach = np.maximum.accumulate(np.r_[before[0], group + most])
        cut = new | (n > reach[:-1] - group)
        first = np.r_[before[1], n[cut]][np.cumsum(cut)]
        last = s[-1], reach[-1] - group[-1], first[-1]
        alive = most >= first
        s, node = (s ^ (first * _ODD))[alive], node[alive]
        if not len(s):
            continue
        if held is not None:
            s, node = np.r_[held[0], s], np.r_[held[1], node]
        same = s[1:] == s[:-1]
        keep = np.r_[more, same] | np.r_[same, False]
        yield pa.RecordBatch.from_arrays([pa.array(s[:-1][keep[:-1]]), pa.array(node[:-1][keep[:-1]])], ["s", "node"])
        held, more = (s[-1:], node[-1:]), bool(keep[-1])
    if held is not None and more:
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["s", "node"])


class Members:
    """The members of one list: sizes and sketches, grouped by the number of bins."""

    def __init__(self, sizes: np.ndarray, sketches: list[bytes], least: tuple[int, int] = LEAST):
        self.sizes, self.least = sizes, least
        self.width = np.array([len(x) for x in sketches])
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            self.rows[w] = at, np.frombuffer(b"".join(sketches[k] for k in at), np.uint64).reshape(len(at), w // 8)
        self.place = np.zeros(len(sizes), np.int64)
        for at, _ in self.rows.values():
            self.place[at] = np.arange(len(at))

    @staticmethod
    def _folded(x: np.ndarray) -> np.ndarray:
        half = x.shape[-1] // 2
        return x[..., :half] ^ x[..., half:]

    def bounds(self, k: int) -> np.ndarray:
        """For each member the least possible difference to member k, ``_FAR`` where it excludes the similarity."""
        out = np.full(len(self.sizes), _FAR)
        w = int(self.width[k])
        own = self.rows[w][1][self.place[k]]
        for other, mine in ((w, own), (w // 2, None), (2 * w, own)):  # sizes a factor of 0.8 apart at most
            if other not in self.rows:
                continue
            at, theirs = self.rows[other]
            if other < w:
                mine = self._folded(own)
            elif other > w:
                theirs = self._folded(theirs)
            out[at] = np.bitwise_count(theirs ^ mine).sum(1, dtype=np.int64)
        out = np.maximum(out, np.abs(self.sizes - self.sizes[k]))
        up, down = self.least
        both = self.sizes + self.sizes[k]
        possible = (out != _FAR) & (np.minimum(out, both) * (up + down) <= both * (down - up)) & (out <= both)
        return np.where(possible, out, _FAR)

    def across(self, roots: np.ndarray, left: int) -> Iterator[tuple[int, int, int]]:
        """The possible pairs (k, j, bound) of different roots; with ``left``, of one of the first ``left`` members and
        a later one only."""
        for k in range(left or len(roots)):
            near = self.bounds(k)
            for j in np.flatnonzero((near != _FAR) & (roots != roots[k])).tolist():
                if j >= left if left else j > k:
                    yield k, j, int(near[j])


def gap(a: bytes, b: bytes) -> int:
    """The bits in which two sketches differ, the wider one folded."""
    x, y = (np.frombuffer(s, np.uint64) for s in ((a, b) if len(a) <= len(b) else (b, a)))
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _possible(pairs: DataFrame, reps: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't exclude."""
    up, down = least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_parts(batch, 4):
                n, m, x, y = (part.column(c).to_pylist() for c in ("na", "nb", "xa", "xb"))
                far = [gap(*s) * (up + down) > (i + j) * (down - up) for i, j, s in zip(n, m, zip(x, y))]
                keep = pa.array([not f for f in far], pa.bool_())
                yield part.filter(keep).select(["a", "b"])

    ends = [reps.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"x{c}")) for c in "ab"]
    sized = pairs.join(ends[0].drop("xa"), "a").join(ends[1].drop("xb"), "b")
    near = sized.where(F.least("na", "nb") * down >= F.greatest("na", "nb") * up).select("a", "b")
    return near.join(ends[0], "a").join(ends[1], "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a bigint, b bigint")


def _across(rows: DataFrame, every: bool, least: tuple[int, int]) -> DataFrame:
    """(a, b): possible pairs of different roots in the rows (s, one, two, side, node, number, root, sketch) of two blocks:
    all of them, or for each two roots the nearest one."""

    def chosen(part: pa.Table) -> list[dict]:
        nodes, roots = part.column("node").to_pylist(), part.column("root").to_pylist()
        place = {r: k for k, r in enumerate(dict.fromkeys(roots))}
        members = Members(part.column("number").to_numpy(), part.column("sketch").to_pylist(), least)
        left = part.column("side").to_pylist().count(0)
        found = members.across(np.array([place[r] for r in roots]), left if left < len(nodes) else 0)
        best: dict = {}
        for k, j, bound in found:
            ends = tuple(sorted((nodes[k], nodes[j])))
            of = ends if every else tuple(sorted((roots[k], roots[j])))
            if of not in best or bound < best[of][0]:
                best[of] = bound, *ends
        return [{"ra": o[0], "rb": o[1], "gap": g, "a": a, "b": b} for o, (g, a, b) in best.items()]

    kinds = pa.schema([(c, pa.int64()) for c in ("ra", "rb", "gap", "a", "b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, last = [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("s", "one", "two"))))
            starts = [k for k, x in enumerate(keys) if not k or x != keys[k - 1]]
            for at, end in zip(starts, [*starts[1:], len(keys)]):
                if open_ and keys[at] != last:
                    yield pa.RecordBatch.from_pylist(chosen(pa.Table.from_batches(open_)), kinds)
                    open_ = []
                open_.append(batch.slice(at, end - at))
                last = keys[at]
        if open_:
            yield pa.RecordBatch.from_pylist(chosen(pa.Table.from_batches(open_)), kinds)

    keys = ["s", "one", "two"]
    ordered = rows.repartition(shuffle_width(rows), *keys).sortWithinPartitions(*keys, "side", "node")
    found = ordered.mapInArrow(run, "ra bigint, rb bigint, gap bigint, a bigint, b bigint")
    if every:
        return found.select("a", "b").distinct()
    nearest = found.groupBy("ra", "rb").agg(F.min_by(F.struct("a", "b"), F.struct("gap", "a", "b")).alias("p"))
    return nearest.select("p.a", "p.b").distinct()


def _blocks(rows: DataFrame) -> DataFrame:
    """(s, one, two, side, node, number, root): the rows (s, node, number, root) once for each pair of blocks that they
    are in; ``side`` is 1 for the second block of a pair."""
    level = F.floor(F.log(F.greatest("number", F.lit(1))) / np.log(1.25))
    sized = rows.withColumn("level", level)
    sized = sized.withColumn("group", F.concat_ws(":", "s", "level"))
    laid = placed(sized, "group", ["root", "node"])
    # a sketch has a byte for each two shingles, at most
    most = F.greatest(F.lit(1.0), F.least(F.lit(float(BLOCK)), BLOCK_BYTES / F.pow(F.lit(1.25), F.col("level"))))
    laid = saved(laid.withColumn("block", F.floor(F.col("pos") / F.floor(most))).drop("group", "pos", "n"), "laid")
    blocks = laid.groupBy("s", "level", "block").agg(F.min("root").alias("first"), F.max("root").alias("last"))
    one, two = (blocks.select("s", *[F.col(c).alias(f"{c}{k}") for c in ("level", "block", "first", "last")]) for k in (1, 2))
    same = (F.col("level1") == F.col("level2")) & (F.col("block1") <= F.col("block2"))
    mixed = ~((F.col("first1") == F.col("last1")) & (F.col("first2") == F.col("last2")) & (F.col("first1") == F.col("first2")))
    pairs = one.join(two, "s").where((same | (F.col("level1") + 1 == F.col("level2"))) & mixed)
    name = [F.concat_ws(":", f"level{k}", f"block{k}").alias(c) for k, c in ((1, "one"), (2, "two"))]
    pairs = saved(pairs.select("s", *name, "level1", "block1", "level2", "block2"), "block-pairs")
    columns = ["s", "one", "two", "side", "node", "number", "root"]
    sides = []
    for k in (1, 2):
        wanted = pairs if k == 1 else pairs.where("one <> two")
        wanted = wanted.select("s", "one", "two", F.col(f"level{k}").alias("level"), F.col(f"block{k}").alias("block"))
        sides.append(laid.join(wanted, ["s", "level", "block"]).withColumn("side", F.lit(k - 1)).select(columns))
    return sides[0].unionByName(sides[1])


def _verified(pairs: DataFrame, texts: DataFrame, size: int, least: tuple[int, int]) -> DataFrame:
    """The pairs whose shingle sets are similar enough, counted on the sets themselves."""
    ends = pairs.select(F.col("a").alias("number")).unionByName(pairs.select(F.col("b").alias("number"))).distinct()
    sets = saved(_sets(texts.join(saved(ends, "ends"), "number", "left_semi"), size), "sets")
    left, right = (sets.select(F.col("number").alias(c), F.col("shingles").alias(f"_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_a", "_b"))
    enough = shared * sum(least) >= (F.size("_a") + F.size("_b")) * least[0]
    found = saved(both.where(enough).select("a", "b").distinct(), "edges")
    forget(sets)
    return found


def lists(texts: DataFrame, named: DataFrame, size: int, least: tuple[int, int]) -> DataFrame:
    """(s, node): the sets that a common prefix shingle may make similar, and those of a SimHash class; of equal lists
    one is left."""
    width = shuffle_width(texts)
    dealt = _prefixes(texts, size, least).repartition(width, "s").sortWithinPartitions("s", "n")
    shared = dealt.mapInArrow(_shared, "s bigint, node bigint")  # most shingles are in one set only
    groups = components(simhash.links(saved(named.select("fp").distinct(), "prints"))).withColumnRenamed("node", "fp")
    prints = named.groupBy("fp").agg(F.count("*").alias("rows")).join(groups, "fp", "left")
    prints = prints.where("rows > 1 OR root IS NOT NULL")
    of_class = F.xxhash64(F.lit("class"), F.coalesce("root", "fp")).alias("s")
    alike = named.select("fp", F.col("number").alias("node")).join(prints, "fp").select(of_class, "node")
    entries = saved(shared.unionByName(alike), "entries")
    low = F.lit((1 << 32) - 1)
    hashes = [F.xxhash64(F.lit(seed), "node") for seed in (1, 2)]
    parts = [x for h in hashes for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(low))]
    told = entries.groupBy("s").agg(F.count("*").alias("rows"), *[F.sum(x).alias(f"h{k}") for k, x in enumerate(parts)])
    kept = told.where("rows > 1").groupBy("rows", *[f"h{k}" for k in range(4)]).agg(F.min("s").alias("s"))
    return saved(entries.join(kept.select("s"), "s"), "lists")


def links(
    texts: DataFrame, marks: DataFrame, named: DataFrame, size: int = SIZE, least: tuple[int, int] = LEAST
) -> DataFrame:
    """(number, root): the classes of those sets of ``named`` that any similar pair joins to others.

    ``texts`` has a text of each set (number, text), ``marks`` what is known of each document, ``named`` a row for each
    set (number, node, fp).
    """
    spark = texts.sparkSession
    with scratch() as own:
        rows = lists(texts, named, size, least)
    sweep(spark, own, rows)
    listed = rows.select(F.col("node").alias("number")).distinct()
    names = named.join(listed, "number", "left_semi").select("node", "number")
    sized = marks.select("node", "n", "sketch").join(names, "node").groupBy("number")
    sized = sized.agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    sized = saved(sized.withColumnRenamed("number", "node"), "sized")
    roots = tried = None
    rest = rows  # without what is settled

    def rooted() -> DataFrame:
        listed = rest.select("s", "node")
        if roots is None:
            return listed.withColumn("root", F.col("node"))
        return listed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def joined(pairs: DataFrame) -> bool:
        """Verify the pairs; whether any is similar."""
        nonlocal roots
        found = _verified(pairs, texts, size, least)
        if found.isEmpty():
            return False
        if roots is not None:  # classes so far are the nodes of what is new
            for c in "ab":
                found = found.join(roots.withColumnRenamed("node", c), c, "left")
                found = found.withColumn(c, F.coalesce("root", c)).drop("root")
        fresh = saved(components(found), "fresh")
        if roots is not None:
            higher = fresh.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            moved = roots.join(higher, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
            fresh = moved.unionByName(fresh.join(roots.select("node"), "node", "left_anti"))
        roots = saved(fresh, "roots")
        return True

    def lead(turn: int) -> bool:
        nonlocal tried, rest
        now = saved(rooted(), "rooted")
        drawn = F.max_by(F.struct("node", "root"), F.struct(F.xxhash64(F.lit(turn), "node"), "node"))
        leaders = now.groupBy("s").agg(drawn.alias("l"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
        leaders = leaders.select("s", F.col("l.node").alias("lead"), F.col("l.root").alias("of"))
        rest = saved(now.join(leaders, "s").where("node <> lead"), "rest")
        pairs = rest.where(F.col("root") != F.col("of"))
        pairs = pairs.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
        pairs = saved(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "leads")
        tried = pairs if tried is None else saved(tried.unionByName(pairs), "tried")
        return joined(saved(_possible(pairs, sized, least), "possible"))

    def meet(every: bool) -> None:
        nonlocal tried
        now = rooted()
        mixed = now.groupBy("s").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("s")
        numbers = sized.select("node", F.col("n").alias("number"))
        blocks = _blocks(now.join(mixed, "s").join(numbers, "node").select("s", "node", "number", "root"))
        pairs = _across(blocks.join(sized.select("node", "sketch"), "node"), every, least)
        pairs = saved(pairs.join(tried, ["a", "b"], "left_anti"), "across")
        tried = saved(tried.unionByName(pairs), "tried")
        joined(pairs)

    # what a step wrote goes when it has ended, but for the classes and the pairs tried so far
    with scratch() as own:
        for turn in range(TURNS):
            found = lead(turn)
            sweep(spark, own, roots, tried, rest)
            if not found:
                break
        for every in (False, True):
            meet(every)
            sweep(spark, own, roots, tried, rest)
    forget(rows, sized)
    if roots is None:
        return named.select("number", F.col("number").alias("root")).limit(0)
    return roots.withColumnRenamed("node", "number")


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, least: tuple[int, int] = LEAST
) -> DataFrame:
    """(id, number, component): component is the smallest id reachable over pairs of similarity ``least`` or more.

    Texts without words are one class.  A null id never names a component unless the whole component has none.
    """
    key = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).alias("text"))
    marks = saved(_marks(rows, size), "marks")
    named = marks.groupBy("node").agg(F.min("id").alias("id"), F.min(F.hex("key")).alias("key"), F.first("fp").alias("fp"))
    named = saved(named.withColumn("number", F.monotonically_increasing_id()), "named")
    # one text of each set; copies go before the texts move
    texts = rows.select(F.hex("key").alias("key"), "text").groupBy("key").agg(F.first("text").alias("text"))
    texts = saved(texts.join(named.select("key", "number"), "key").select("number", "text"), "texts")
    roots = links(texts, marks, named, size, least)
    named = named.select("node", "number", "id").join(roots, "number", "left")
    named = saved(named.withColumn("root", F.coalesce("root", "number")), "rooted")
    smallest = saved(named.groupBy("root").agg(F.min("id").alias("component")), "smallest")
    of_node = saved(named.join(smallest, "root").select("node", "number", "component"), "of-node")
    forget(texts)
    return marks.select("id", "node").join(of_node, "node").select("id", "number", "component")
