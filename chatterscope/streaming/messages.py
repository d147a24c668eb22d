"""Message stream: tracked words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatterscope.operators.filters import filter_many_terms, filter_track_terms
from chatterscope.sources import versions
from chatterscope.sources.messages import TWEET_SCHEMA


def stream_messages(
    spark: SparkSession, path: str, schema: str = TWEET_SCHEMA, **options: str
) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).json(path)


def stream_track_terms(messages: DataFrame, terms: Sequence[str], lang: str = "en") -> DataFrame:
    """The batch filter on a stream; no state."""
    return filter_track_terms(messages, terms, lang)


def write_tracked(
    messages: DataFrame, terms: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, lang: str = "en"
) -> StreamingQuery:
    """Every tick: its messages that hold one of many terms, as a part of the versioned table ``path``.

    The terms are read again at every tick, so a table that grows is followed.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        kept = filter_many_terms(batch, terms, lang).withColumn("batch", F.lit(batch_id).cast("bigint"))
        versions.replace_parts(kept, path, owned=[batch_id])

    writer = messages.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()
