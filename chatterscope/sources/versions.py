"""Tables with versions: what a table holds is told by a manifest, which is switched last.

Layout below a table's folder: ``data/<write>/part=<p>`` holds the files of one write, ``versions/<n>.json`` the
manifest of version n - schema, applied batches, and the folders that are live for every part (a batch or a
bucket).  A write puts new files aside, then one rename makes a manifest that names them; readers see
the version before or the one after, also when a writer dies in between, and files of a version stay
until ``expire``.  Replacing parts, merging into buckets, compacting and rolling back are all
one more version.

One writer at a time is meant; of two at once one fails on its rename and can start again.  Manifests are as
long as the table has live parts; they and the folder lists are all that passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterscope.session import cut_lineage

PART = "part"


class _Files:
    """The few calls of the Hadoop file system that manifests need."""

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.table = table.rstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), conf)
        self.gateway = spark.sparkContext._gateway

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.table}/{name}" if name else self.table)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """A file that appears whole or not at all; an error if it is there already."""
        aside = self.path(f"aside/{uuid.uuid4().hex}")
        stream = self.fs.create(aside)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.fs.mkdirs(self.path(name).getParent())
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self.context.rename(aside, self.path(name), none)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def versions(spark: SparkSession, table: str) -> list[int]:
    """The numbers of all versions, oldest first."""
    return [int(n.removesuffix(".json")) for n in _Files(spark, table).names("versions") if n.endswith(".json")]


def manifest(spark: SparkSession, table: str, version: int | None = None) -> dict:
    """version, schema, applied batches and parts (part to folders) of a version, by default the last."""
    if version is None:
        there = versions(spark, table)
        if not there:
            return {"version": -1, "schema": None, "applied": {}, "parts": {}}
        version = there[-1]
    return json.loads(_Files(spark, table).read(f"versions/{version:012}.json"))


def _switch(spark: SparkSession, table: str, old: dict, **changed: object) -> int:
    new = old | changed | {"version": old["version"] + 1}
    _Files(spark, table).write_new(f"versions/{new['version']:012}.json", json.dumps(new))
    return new["version"]


def _put(df: DataFrame, table: str, part: Column, sort_by: Sequence[str]) -> dict[str, list[str]]:
    """Write rows aside; the folders of each part."""
    spark, write = df.sparkSession, uuid.uuid4().hex
    rows = df.withColumn(PART, part.cast("string")).hint("rebalance", PART)
    if sort_by:
        rows = rows.sortWithinPartitions(PART, *sort_by)
    rows.write.partitionBy(PART).parquet(f"{table.rstrip('/')}/data/{write}")
    names = [n for n in _Files(spark, table).names(f"data/{write}") if n.startswith(f"{PART}=")]
    return {n.removeprefix(f"{PART}="): [f"data/{write}/{n}"] for n in names}


def read(
    spark: SparkSession, table: str, version: int | None = None, parts: Iterable[object] | None = None, schema: str | None = None
) -> DataFrame:
    """The rows of a version; only those of some ``parts`` if they are given.  ``schema`` is for tables
    without any version yet."""
    held = manifest(spark, table, version)
    if held["schema"] is None and schema is None:
        raise ValueError(f"no version of {table} yet")
    kind = T.StructType.fromJson(held["schema"]) if held["schema"] else schema
    wanted = None if parts is None else {str(p) for p in parts}
    folders = [f"{table.rstrip('/')}/{f}" for p, fs in sorted(held["parts"].items()) if wanted is None or p in wanted for f in fs]
    return spark.read.schema(kind).parquet(*folders) if folders else spark.createDataFrame([], kind)


def replace_parts(df: DataFrame, table: str, by: str = "batch", owned: Sequence[object] = (), sort_by: Sequence[str] = ()) -> int:
    """Replace the parts (values of column ``by``) that ``df`` has rows for, and empty the others that the
    run ``owned``; the new version's number."""
    spark = df.sparkSession
    old = manifest(spark, table)
    put = _put(df, table, F.col(by), sort_by)
    kept = {p: f for p, f in old["parts"].items() if p not in {str(o) for o in owned}}
    return _switch(spark, table, old, schema=df.schema.jsonValue(), parts=kept | put)


def bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def merge_buckets(
    updates: DataFrame,
    table: str,
    key: str,
    merge: Callable[[DataFrame], DataFrame],
    n: int = 64,
    batch: tuple[str, int] | None = None,
) -> int:
    """Merge rows into the buckets of their keys; buckets without updates stay as they are.

    ``merge`` makes one table of the rows that a bucket holds and the new ones; it must give the same
    for rows that it gets twice.  ``batch`` (source, number) marks the batch as applied, so that a
    replay of it or of an older one of that source makes no version.
    """
    spark = updates.sparkSession
    old = manifest(spark, table)
    if batch and old["applied"].get(batch[0], -1) >= batch[1]:
        return old["version"]
    n = old.get("buckets") or n  # a table keeps its number of buckets
    updates = cut_lineage(updates)
    touched = [r[0] for r in updates.select(bucket(F.col(key), n)).distinct().collect()]
    merged = updates
    if set(map(str, touched)) & set(old["parts"]):
        merged = read(spark, table, old["version"], touched).unionByName(updates)
    put = _put(merge(merged).select(updates.columns), table, bucket(F.col(key), n), [key])
    applied = old["applied"] | ({batch[0]: batch[1]} if batch else {})
    kept = {p: f for p, f in old["parts"].items() if p not in set(map(str, touched))}
    return _switch(spark, table, old, schema=updates.schema.jsonValue(), parts=kept | put, applied=applied, buckets=n)


def lookup(spark: SparkSession, table: str, key: str, value: object, version: int | None = None) -> DataFrame:
    """The rows of one key, from the one bucket that can hold them."""
    held = manifest(spark, table, version)
    kind = T.StructType.fromJson(held["schema"])[key].dataType
    own = spark.range(1).select(bucket(F.lit(value).cast(kind), held["buckets"]).alias("b")).first().b
    return read(spark, table, held["version"], [own]).where(F.col(key) == F.lit(value))


def compact(
    spark: SparkSession, table: str, upto: int, merge: Callable[[DataFrame], DataFrame], sort_by: Sequence[str] = ()
) -> int:
    """Make one batch, ``upto``, of all batches up to it, as a new version; readers of others go on."""
    old = manifest(spark, table)
    chosen = [p for p in old["parts"] if int(p) <= upto]
    if not chosen:
        return old["version"]
    schema = T.StructType.fromJson(old["schema"])
    rows = merge(read(spark, table, old["version"], chosen)).withColumn("batch", F.lit(upto).cast(schema["batch"].dataType))
    put = _put(rows.select(schema.names), table, F.col("batch"), sort_by)
    kept = {p: f for p, f in old["parts"].items() if p not in chosen}
    return _switch(spark, table, old, parts=kept | put)


def roll_back(spark: SparkSession, table: str, version: int) -> int:
    """Make an older version's rows the newest version again."""
    then, now = manifest(spark, table, version), manifest(spark, table)
    return _switch(spark, table, then | {"version": now["version"]})


def expire(spark: SparkSession, table: str, keep: int = 1) -> None:
    """Delete all but the last ``keep`` versions, and files that none of these names.

    Not while a write is under way, whose files no version names yet.
    """
    files, all_ = _Files(spark, table), versions(spark, table)
    live = {f.split("/")[1] for v in all_[-keep:] for fs in manifest(spark, table, v)["parts"].values() for f in fs}
    for v in all_[:-keep]:
        files.delete(f"versions/{v:012}.json")
    for write in files.names("data"):
        if write not in live:
            files.delete(f"data/{write}")
