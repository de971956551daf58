"""Tables between the steps of an operator, and values sent to all tasks."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 20_000
_temporary: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where a session names none, as in a local test, it is a temporary one; a
    session on several machines has to name one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _temporary:
        _temporary.append(tempfile.mkdtemp(prefix="checkpoints-"))
        atexit.register(shutil.rmtree, _temporary[0], ignore_errors=True)
    return _temporary[0]


def shared_folder(spark: SparkSession) -> str:
    """A path of its own for a run, where nothing is yet."""
    return f"{checkpoint_root(spark).rstrip('/')}/run-{uuid.uuid4().hex}"


def settle(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows, kept in the checkpoint folder all executors share, so that a lost executor costs no earlier step.

    rows: about how many rows there are, if known. A small table then comes from few tasks, whatever the number of shuffle
    partitions; with ROWS_PER_TASK rows or more for each partition this changes nothing.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(df.sparkSession))
    return (df if rows is None else df.coalesce(1 + rows // ROWS_PER_TASK)).checkpoint()


def written(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows as a Parquet table of their own in the shared folder, from as few tasks as in `settle`.

    For steps in rounds. A checkpointed table keeps the size Spark guessed for its plan, where a join's is the product of its
    sides': from round to round such a guess grows threefold in digits, to millions of them. Here it is the files' own size.
    """
    path = shared_folder(df.sparkSession)
    (df if rows is None else df.coalesce(1 + rows // ROWS_PER_TASK)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Has the driver look for tables that nothing refers to any more: until it does, Spark keeps their shuffle files on disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared(spark: SparkSession, value) -> Broadcast:
    """A value of bounded size for every task."""
    return spark.sparkContext.broadcast(value)
