"""What the operators share: scratch tables in the shared folder, raw text of Arrow batches, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A-Z to a-z, every other byte as it is.  UTF-8 never uses these bytes inside a longer code point.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


#: Lists that take the scratch tables made while they are open.
_OPEN: list[list[str]] = []


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The paths of the scratch tables that are made inside, for ``sweep``."""
    _OPEN.append(paths := [])
    try:
        yield paths
    finally:
        _OPEN.remove(paths)


def sweep(spark: SparkSession, paths: list[str], *keep: DataFrame | None) -> None:
    """Remove scratch tables that nothing reads any more, all but those of ``keep``."""
    kept = {t._scratch for t in keep if t is not None}
    for path in [p for p in paths if p not in kept]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    paths[:] = kept.intersection(paths)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, removed when the driver's JVM ends.

    Local sessions without that setting get a temporary folder; on a cluster it has to be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="missive-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    for paths in _OPEN:
        paths.append(path)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: the lineage is cut, losses cost a reread."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove tables that ``saved`` wrote and nothing reads any more."""
    for table in tables:
        sweep(table.sparkSession, [table._scratch])


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def placed(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place of each row among those of its key from 0 on, and ``n``, their number.

    Rows are dealt by ranges of (key, order, row), so that no key, tie or repeated row meets in one task; nulls of
    ``order`` come first.  The key isn't null.  Only one row for each range and key is summed over the ranges.
    """
    tied = saved(rows.withColumn("_tie", F.monotonically_increasing_id()), "tied")
    keys = [key, *order, "_tie"]
    dealt = tied.repartitionByRange(shuffle_width(rows), *keys).sortWithinPartitions(*keys).drop("_tie")
    laid = dealt.withColumn("_at", F.monotonically_increasing_id())
    laid = laid.select("*", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_row"))
    laid = saved(laid.drop("_at"), "laid")
    parts = laid.groupBy(key, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    whole = W.partitionBy(key)
    before = F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows")
    parts = parts.select(key, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("n"))
    found = laid.join(parts, [key, "_part"])
    return found.select(*rows.columns, (F.col("_row") + F.col("_shift")).alias("pos"), "n")


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each row of a string or binary column, without decoding; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        yield from (b"" for _ in range(len(column)))
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    missing = column.is_null().to_pylist() if column.null_count else None
    for i in range(len(column)):
        yield b"" if missing and missing[i] else bytes(view[ends[i] : ends[i + 1]])


def in_parts(batch: pa.RecordBatch, column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with ``most`` bytes of text each, or one row: what a task holds at a time is bounded."""
    sizes = batch.column(column).nbytes
    rows = batch.num_rows
    if rows < 2 or sizes <= most:
        yield batch
        return
    half = rows // 2
    yield from in_parts(batch.slice(0, half), column, most)
    yield from in_parts(batch.slice(half), column, most)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b), as (node, root): root is the smallest node.

    Alternating large-star and small-star rounds (Kiveris et al. 2014).  Every round is written to the shared
    folder; the driver sees one count and one hash a round.  Self-loops are allowed.
    """
    width = shuffle_width(edges)

    def star(links: DataFrame, large: bool) -> DataFrame:
        if large:
            both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(least, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b"))
            )
        return out.where("a <> b").distinct()

    links = saved(edges.select("a", "b").where("a <> b").distinct().repartition(width, "a"), "links")
    digest = (F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = links.agg(*digest).first()
    for _ in range(max_rounds if before[0] else 0):
        older, links = links, saved(star(star(links, True), False), "links")
        forget(older)
        state = links.agg(*digest).first()
        if state == before:
            break
        before = state
    else:
        if before[0]:
            raise RuntimeError("the components did not settle")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
