"""Topic sources. A topic is a stream; the same topic is mirrored as a parquet folder or a lake table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.schemas import topic_schema


def read_topic(spark: SparkSession, topic: str, source: str, with_proctime: bool = False,
               streaming: bool = True, max_files_per_trigger: int | None = None, with_order: bool = False) -> DataFrame:
    """The typed rows of a topic.

    `source` is a folder holding one sub-folder per topic, or `kafka:<bootstrap servers>`. Kafka reads from the
    earliest offset and expects JSON values of the topic's schema; a malformed value becomes a row of nulls, which
    `ingest.unreadable` finds. `with_order` adds `ingest_order`, by which rows of one batch compare as the source has them:
    offset and partition of a message, or else a file's time, its name and the row's place in it.
    """
    order = "ingest_order"
    schema = topic_schema(topic)
    reader = spark.readStream if streaming else spark.read
    if source.startswith("kafka:"):
        raw = (reader.format("kafka").option("kafka.bootstrap.servers", source[len("kafka:"):])
               .option("subscribe", topic).option("startingOffsets", "earliest").load())
        rows = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("v"),
                          F.struct("timestamp", "partition", "offset").alias(order))
        rows = rows.select("v.*", *[order] * with_order)
    else:
        if max_files_per_trigger and streaming:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        rows = reader.schema(schema).parquet(f"{source.rstrip('/')}/{topic}")
        if with_order:
            place = [F.col(f"_metadata.{c}") for c in ("file_modification_time", "file_path", "row_index")]
            rows = rows.select("*", F.struct(*place).alias(order))
    return rows.withColumn("proctime", F.current_timestamp()) if with_proctime else rows
