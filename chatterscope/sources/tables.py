"""Result tables written in batches.

Each batch owns the partition ``batch=<id>``; writing it again replaces it, so a repeated batch
changes nothing.  What a table holds is then a matter of reading: the last row per key, sums per
key, or the set of all rows.  These need one aggregation by key with map-side combining, no
ledger and no locks.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StructType

from chatterscope.session import cut_lineage


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Replace those partitions of a table that ``df`` has rows for.

    The rebalance hint gathers the rows of a partition for few files and lets AQE split a partition
    that holds most rows over several tasks.  Files sorted by a lookup key can be skipped by it.
    """
    rows = df.hint("rebalance", *partition_by)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def clear_partitions(df: DataFrame, path: str, column: str, owned: Sequence[object]) -> None:
    """Drop those of the partitions ``column=value`` of a table that the rows of a run, now written,
    left out, for values that the run owns.  What is read is then what the run computed."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [v for v in owned if files.exists(jvm.org.apache.hadoop.fs.Path(folder, f"{column}={v}"))]
    if there:
        full = {r[0] for r in df.select(column).where(F.col(column).isin(there)).distinct().collect()}
        for value in set(there) - full:
            files.delete(jvm.org.apache.hadoop.fs.Path(folder, f"{column}={value}"), True)


def write_batches(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    owned: Sequence[int] = (),
) -> None:
    """Write the rows of all batches in ``df`` (column batch), replacing those batches.

    Batches that the run ``owned`` and has no rows for are emptied.
    """
    if owned:
        df = cut_lineage(df)
    write_partitioned(df, path, ["batch", *partition_by], sort_by)
    if owned:
        clear_partitions(df, path, "batch", owned)


def read_batches(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """All batches; with a schema a table that has no rows yet reads as empty."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _order(batches: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> list[str]:
    """What settles which of a key's rows is the last: the sequence, then values that can be compared."""
    kinds = {f.name: f.dataType.simpleString() for f in batches.schema.fields}
    values = [c for c in batches.columns if c not in (*keys, *sequence)]
    return [*sequence, *(c for c in values if not re.search(r"map<|variant", kinds[c]))]


def last_rows(
    batches: DataFrame, keys: Sequence[str], sequence: Sequence[str] = ("batch",)
) -> DataFrame:
    """The last row per key with all its columns, in the order of ``sequence``.

    Rows of numbers besides their keys are ranked by key.  Of others only keys and numbers are aggregated: each row gets a hash of what orders it besides the sequence, and
    the rows of the largest (sequence, hash) are what is left; so long values go through one join and
    no sort of theirs.  Rows equal in both are equal in what can be compared, and one of them stays.
    """
    order = _order(batches, keys, sequence)
    rest = [c for c in order if c not in sequence]
    if all(isinstance(batches.schema[c].dataType, (NumericType, DateType, BooleanType)) for c in batches.columns if c not in keys):
        # short rows are shuffled once, by key
        last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
        return batches.withColumn("__place", F.row_number().over(last)).where("__place = 1").drop("__place")
    # the order of ties is that of the values, for the few keys that have ties
    own = batches.withColumn("__rank", F.struct(*sequence))
    newest = own.groupBy(*keys).agg(F.max("__rank").alias("__rank"))
    same = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in (*keys, "__rank")]
    kept = own.alias("x").join(newest.alias("y"), same, "left_semi").drop("__rank")
    if not rest:
        return kept.dropDuplicates(list(keys))
    row = F.max_by(F.struct(*[c for c in batches.columns if c not in keys]), F.struct(*rest))
    return kept.groupBy(*keys).agg(row.alias("__row")).select(*keys, "__row.*").select(batches.columns)


def upsert_last_wins(
    batches: DataFrame, keys: Sequence[str], sequence: Sequence[str] = ("batch",)
) -> DataFrame:
    """The last row per key in the order of ``sequence``; ties are settled by those values of the row
    that can be compared.  The batch is not part of the result."""
    return last_rows(batches, keys, sequence).drop("batch")


def merge_counters(batches: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Counters added up over batches."""
    return batches.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def upsert_set_union(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Page table with backlinks: title, id, linksto, source - a row for every backlink, whatever their
    number, and one with source NULL for a page without.

    ``pages``: batch, title, id, linksto - the last batch wins.  ``links``: target, title - the
    union of all batches.  A target without page of its own has id and linksto NULL.
    """
    links = links.select("target", "title").distinct()
    return with_sources(upsert_last_wins(pages, ["title"]), links)


def with_sources(pages: DataFrame, links: DataFrame) -> DataFrame:
    """title, id, linksto, source of pages, each title once, and links, each once."""
    referred = links.select(F.col("target").alias("title"), F.col("title").alias("source"))
    return pages.join(referred, "title", "full_outer").select("title", "id", "linksto", "source")


def collect_backlinks(table: DataFrame, titles: Sequence[str] | None = None) -> DataFrame:
    """title, id, linksto, referredby: one row per title, for the titles asked for.

    Without ``titles`` every title's set is built; a set holds all backlinks of its title.
    """
    if titles is not None:
        table = table.where(F.col("title").isin(list(titles)))
    # equal in all rows of a title
    page = [F.any_value(c, F.lit(True)).alias(c) for c in ("id", "linksto")]
    sources = F.collect_list("source")
    return table.groupBy("title").agg(
        *page, F.when(F.size(sources) > 0, F.array_sort(sources)).alias("referredby")
    )


def compact(
    batches: DataFrame, path: str, upto: int, partition_by: Sequence[str] = ()
) -> None:
    """Write the merged rows of all batches up to ``upto`` as the first batch of a new table."""
    write_batches(batches.withColumn("batch", F.lit(upto)), path, partition_by)
