"""Session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session the platform hands out."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("missive")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    A local session that names none gets a temporary folder; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="missive-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def forgotten_later(spark: SparkSession, path: str) -> str:
    """``path``, which is removed when the driver's JVM ends."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` through the session's shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
        forgotten_later(spark, spark.sparkContext.getCheckpointDir())
    return df.checkpoint(eager=True)


def shuffle_width(df: DataFrame) -> int:
    """Number of shuffle partitions the session is set up for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bounded(df: DataFrame, max_rows: int):
    """The rows of ``df`` as an Arrow table, for fitted state of a proven size only.

    Raises when there are more than ``max_rows`` rows, rather than pulling an unbounded table to the driver.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        raise ValueError(f"Fitted state has more than {max_rows} rows")
    return table


def freeze(df: DataFrame, max_rows: int) -> DataFrame:
    """Run ``df`` and return its bounded rows as a local table."""
    return df.sparkSession.createDataFrame(bounded(df, max_rows), df.schema)
