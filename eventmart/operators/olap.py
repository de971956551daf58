"""The typed, key-deduplicated event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scalars import millis, typed_time

# The table's sorting key, which is also its identity.
EVENT_KEY = ["user_id", "event_type", "event_time", "event_id"]


def typed_events(unified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events with a millisecond timestamp, and those whose time cannot be read."""
    parsed = unified.withColumn("_ts", millis(typed_time("event_time")))
    typed = (parsed.filter(F.col("_ts").isNotNull())
             .select(*[F.col("_ts").alias(c) if c == "event_time" else c for c in unified.columns]))
    rejected = parsed.filter(F.col("_ts").isNull()).drop("_ts").withColumn("reason", F.lit("bad_event_time"))
    return typed, rejected


def replace_by_key(df: DataFrame, keys: list[str], version: str | Column) -> DataFrame:
    """One row per key, the one with the highest version.

    An aggregation rather than a ranking: copies of a key collapse before the shuffle, so a key with
    any number of copies sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def sorted_table(df: DataFrame, keys: list[str] = EVENT_KEY) -> DataFrame:
    """Range-partitioned and sorted by the key, for a table whose files can be skipped by min and max."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def dedup_stream(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """First row of each key within the watermark; state older than the delay is dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
