"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCAN_PARTITIONS = "spark.chatterscope.scanPartitions"
#: Whether Spark deletes the shuffle files of a query as soon as it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Codec of large tables that are read a few times and then dropped.
COMPACT = "zstd"
#: Large shuffles are made in rounds of about so many rows each, and in so many rounds at most.
ROUND_ROWS = 1 << 22
ROUNDS = 8
#: Folders of ``fresh_cut`` made inside each open ``cuts_dropped``.
_open_cuts: list[list[str]] = []


def get_spark(app: str = "chatterscope", master: str | None = None, **conf: object) -> SparkSession:
    """A session with UTC and adaptive execution; partition counts are left to AQE."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, else one below the warehouse; all executors must
    reach it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "intermediate")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def fresh_cut(spark: SparkSession, name: str = "cut") -> str:
    """A new path for an intermediate table."""
    path = fresh_path(spark, name)
    if _open_cuts:
        _open_cuts[-1].append(path)
    return path


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    The result is computed once however often it is used, survives lost executors, and has a known
    size, by which Spark decides on broadcasts.
    """
    spark = df.sparkSession
    path = fresh_cut(spark)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files, which else stay until the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def cuts_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete at the end the intermediate tables written inside; nothing that reads them may be used later."""
    _open_cuts.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for path in _open_cuts.pop():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def rounds_of(rows: int) -> int:
    """In how many rounds so many rows are shuffled."""
    return max(1, min(ROUNDS, -(-rows // ROUND_ROWS)))


def cut_rounds(parts: Sequence[DataFrame], of: Callable[[DataFrame], DataFrame] = lambda part: part) -> DataFrame:
    """The rows that ``of`` makes of all parts, which must not depend on each other: of a single part as they are, of
    several written one after another to one folder.  Shuffle files and intermediate tables of no more than one part
    are on disk."""
    if len(parts) == 1:
        return of(parts[0])
    spark = parts[0].sparkSession
    path = fresh_cut(spark)
    for part in parts:
        with cuts_dropped(spark), shuffles_dropped(spark):
            rows = of(part)
            rows.write.mode("append").parquet(path, compression=COMPACT)
    return spark.read.schema(rows.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan to as many partitions as ``spark.chatterscope.scanPartitions`` says, if it is set.

    For small files of one row group, which one task would read; the benchmark sets it.
    """
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n else df
