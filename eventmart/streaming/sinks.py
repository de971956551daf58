"""Sinks. Every micro-batch write can be repeated: it replaces what an earlier attempt of the same batch left."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmart.functions.scalars import json_object, typed_time
from eventmart.operators.olap import replace_by_key

BatchWriter = Callable[[DataFrame, int], None]


def with_row_id(df: DataFrame, source: str) -> DataFrame:
    """A stable id from the source topic and the row itself, the same each time the row is replayed."""
    return df.withColumn("row_id", F.sha2(json_object(source=F.lit(source), row=F.struct(*df.columns)), 256))


def append_sink(target: str, source: str = "", connections: int = 16) -> BatchWriter:
    """Append-only table of rows with a stable id.

    A folder gets one partition per source and batch, which a repeated batch overwrites. A `jdbc:` address gets
    plain inserts into `<url>#<table>_staging` over `connections` connections, with the source and the batch; the database
    moves them on with an insert that ignores known (source, batch_id, row_id), so repeats neither fail nor double there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = with_row_id(batch, source)
        if target.startswith("jdbc:"):
            url, name = target.split("#")
            (rows.withColumns({"source": F.lit(source or "stream"), "batch_id": F.lit(batch_id)})
                 .write.mode("append").options(batchsize=10_000, numPartitions=connections).jdbc(url, f"{name}_staging"))
        else:
            (rows.withColumns({"source": F.lit(source or "stream"), "batch_id": F.lit(batch_id)})
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("source", "batch_id").parquet(target))

    return write


def fan_out(targets: Mapping[str, tuple[Column | None, list | Callable[[DataFrame], DataFrame]]],
            writer: Callable[[str], BatchWriter]) -> BatchWriter:
    """One batch into many sinks, computed once: each target takes the rows of its predicate in its own columns."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for target, (predicate, shape) in targets.items():
                rows = batch if predicate is None else batch.filter(predicate)
                writer(target)(shape(rows) if callable(shape) else rows.select(*shape), batch_id)
        finally:
            batch.unpersist()

    return write


def start(stream: DataFrame, writer: BatchWriter, checkpoint: str, interval: str | None = None, mode: str = "append") -> StreamingQuery:
    """Run a batch writer over a stream: until caught up, or at an interval if one is given."""
    job = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).outputMode(mode)
    return (job.trigger(processingTime=interval) if interval else job.trigger(availableNow=True)).start()


def topic_sink(stream: DataFrame, topic: str, target: str, checkpoint: str, interval: str | None = None,
               key: str = "user_id") -> StreamingQuery:
    """A stream into a topic: a folder under `target`, or `kafka:<bootstrap servers>` as JSON values keyed by `key`."""
    if target.startswith("kafka:"):
        out = (stream.select(F.col(key).alias("key"), F.to_json(F.struct(*stream.columns)).alias("value"))
               .writeStream.format("kafka").option("kafka.bootstrap.servers", target[len("kafka:"):])
               .option("topic", topic))
    else:
        out = stream.writeStream.format("parquet").option("path", f"{target.rstrip('/')}/{topic}")
    out = out.option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(processingTime=interval) if interval else out.trigger(availableNow=True)).start()


def materialise_topic(stream: DataFrame, table: str, checkpoint: str, time: str | None = None,
                      interval: str | None = None) -> StreamingQuery:
    """A topic's rows into its lake table, one commit per trigger.

    With `time`, the name of the wire-time column, rows also get it typed (`login_time` -> `login_ts`) and are
    partitioned by its day (`event_date`), so that a job over one day opens that day's files only.
    """
    if time is None:
        dated = stream.withColumn("event_date", F.to_date(F.current_timestamp()))
    else:
        ts = typed_time(time)
        dated = stream.withColumns({f"{time.removesuffix('_time')}_ts": ts, "event_date": F.to_date(ts)})
    out = (dated.writeStream.format("parquet").option("path", table).partitionBy("event_date")
           .option("checkpointLocation", checkpoint).outputMode("append"))
    return (out.trigger(processingTime=interval) if interval else out.trigger(availableNow=True)).start()


def merge_by_key(target: str, keys: list[str], version: str | Column, partition: str) -> BatchWriter:
    """A key-deduplicated folder table: a batch rewrites only the partitions it touches, newest version per key.

    The new partitions are first completed in a side folder. A batch that is repeated after a crash finds them there
    and only publishes them again, so a half-replaced partition is never read back.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, files = batch.sparkSession, _Files(batch.sparkSession)
        side = f"{target.rstrip('/')}__next/{batch_id}"
        if not files.exists(f"{side}/_SUCCESS"):
            merged = batch
            if files.exists(target):
                # the few partitions of one batch, as literals: only their files are opened
                touched = [row[0] for row in batch.select(partition).distinct().collect()]
                old = spark.read.schema(batch.schema).parquet(target)
                in_touched = F.col(partition).isin([t for t in touched if t is not None])
                if None in touched:
                    in_touched |= F.col(partition).isNull()
                merged = old.filter(in_touched).unionByName(batch)
            replace_by_key(merged, keys, version).write.mode("overwrite").parquet(side)
        rows = spark.read.schema(batch.schema).parquet(side).hint("rebalance", partition)
        (rows.sortWithinPartitions(partition, *keys).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(target))
        files.delete(side)

    return write


class _Files:
    """The two file operations Spark's readers and writers do not offer, on whatever file system a path is on."""

    def __init__(self, spark):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.conf = spark._jsc.hadoopConfiguration()

    def exists(self, path: str) -> bool:
        where = self.path(path)
        return where.getFileSystem(self.conf).exists(where)

    def delete(self, path: str) -> None:
        where = self.path(path)
        where.getFileSystem(self.conf).delete(where, True)


def overwrite_partitions(df: DataFrame, target: str, partition: str = "dt") -> None:
    """Replace only the partitions `df` has rows for. A folder or a catalog table."""
    if "/" in target:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition)
           .parquet(target))
    else:
        df.writeTo(target).overwritePartitions()
