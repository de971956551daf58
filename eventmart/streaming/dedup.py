"""Exact deduplication of replays of any age, without keys in state.

A table keeps the first row of each key, by day of the row's time. Beside it lie bitmaps of the keys of each day, of a fixed size. A batch
asks the bitmaps of the days it touches; a row whose bit is not set is new, and only the others are held against the
table, in the days touched. What a batch reads follows its days and what may be a replay, not the table.

* `<target>/rows/batch=N/day=D`: the rows that batch N brought
* `<target>/bits/batch=N`: day, bucket, bits of their keys

A repeated batch looks at earlier batches only and replaces its own rows, so it gives what its first attempt gave.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators import olap
from eventmart.streaming.sinks import BatchWriter, _Files

BITS = 1 << 23  # of a day: 1 MB when all its buckets are in use; more of them only save looking at the table
_NO_DAY = "1900-01-01"  # the day of rows without a time
_BITMAPS = "batch long, day date, bucket long, bits binary"


def first_rows(target: str, keys: list[str], time: str | Column, bits: int = BITS) -> BatchWriter:
    """A writer that adds a batch's rows whose key the table does not hold.

    Of rows of a batch with one key, one stays, the same in each attempt. The same key on two days is two rows, as the time
    belongs to what is repeated. Null keys are equal to each other; rows without a readable time have a day of their own.
    """
    target = target.rstrip("/")
    place = F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1
    marks = {"_bucket": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)}

    def write(rows: DataFrame, batch: int) -> None:
        spark, shape = rows.sparkSession, rows.schema
        moment = F.col(time) if isinstance(time, str) else time
        day = F.coalesce(moment.try_cast("date"), F.lit(_NO_DAY).cast("date"))
        new = olap.replace_by_key(rows.withColumn("day", day), [*keys, "day"], F.xxhash64(*rows.columns)).withColumns(marks)
        days = [r.day for r in rows.select(day.alias("day")).distinct().collect()]  # as many as the calendar has
        before = (F.col("batch") < batch) & F.col("day").isin(days)
        if days and _Files(spark).exists(f"{target}/bits"):
            known = (spark.read.schema(_BITMAPS).parquet(f"{target}/bits").where(before)
                     .groupBy(F.col("day").alias("_day"), F.col("bucket").alias("_of")).agg(F.bitmap_or_agg("bits").alias("_bits")))
            byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            is_set = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (F.col("_bit") % 8).cast("int"))) > 0
            asked = new.join(known, (F.col("day") == F.col("_day")) & (F.col("_bucket") == F.col("_of")), "left")
            asked = asked.withColumn("_maybe", F.coalesce(is_set, F.lit(False))).drop("_day", "_of", "_bits")
            held = table(spark, target, shape).where(before).select(F.col("day").alias("_day"), *[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
            same = F.col("_maybe") & (F.col("day") == F.col("_day"))
            for i, key in enumerate(keys):
                same = same & F.col(key).eqNullSafe(F.col(f"_{i}"))
            new = asked.where("not _maybe").unionByName(asked.where("_maybe").join(held, same, "left_anti"))
        new.select(*rows.columns, "day").write.mode("overwrite").partitionBy("day").parquet(f"{target}/rows/batch={batch}")
        kept = spark.read.schema(T.StructType([*shape, T.StructField("day", T.DateType())])).parquet(f"{target}/rows/batch={batch}")
        (kept.withColumns(marks).groupBy("day", F.col("_bucket").alias("bucket")).agg(F.bitmap_construct_agg("_bit").alias("bits"))
         .coalesce(1 + len(days) // 64).write.mode("overwrite").parquet(f"{target}/bits/batch={batch}"))

    return write


def table(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows kept, with batch and day. `schema` is that of the rows written."""
    whole = T.StructType([*schema, T.StructField("batch", T.LongType()), T.StructField("day", T.DateType())])
    return spark.read.schema(whole).parquet(f"{target.rstrip('/')}/rows")
