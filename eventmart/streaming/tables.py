"""Kept tables: what a stream has made so far, as a base and the deltas since, published by one small pointer file.

A micro-batch writes its own rows only, reduced by the table's `combine`, so the bytes written follow the batch and not the
table. `combine` must give the same rows whether it is applied to parts first and then to the parts' results, or to all rows at
once (newest version of a key, newest n of a viewer): reading applies it to base and deltas together. After `compact_after`
deltas they are combined into a new base.

Files are complete before the pointer names them, and a pointer is a new file each time, so a reader sees a table as one batch left
it, and never half of one. A batch that is repeated is written again if no pointer names it yet, and left out if one does.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventmart.streaming.sinks import BatchWriter

Combine = Callable[[DataFrame], DataFrame]
COMPACT_AFTER = 16


@dataclass
class Pointer:
    last: int = -1  # the last batch that is in the table
    base: int | None = None
    deltas: list[int] = field(default_factory=list)

    def folders(self) -> list[str]:
        return ([] if self.base is None else [f"base-{self.base}"]) + [f"delta-{d}" for d in self.deltas]


class _Folder:
    """A table's folder on whatever file system it is on."""

    def __init__(self, spark: SparkSession, target: str):
        jvm = spark._jvm
        self.target, self.jvm = target.rstrip("/"), jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.target).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, pattern: str) -> list[str]:
        found = self.fs.globStatus(self.path(f"{self.target}/{pattern}"))
        return [f.getPath().getName() for f in found or []]

    def pointers(self) -> list[Pointer]:
        """All whole pointers, oldest first. One that is being written has no end yet."""
        out = []
        for name in sorted(self._names("_pointer-*"), key=lambda n: int(n.split("-")[1])):
            stream = self.fs.open(self.path(f"{self.target}/{name}"))
            try:
                text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):
                out.append(Pointer(**json.loads(text)))
        return out

    def publish(self, pointer: Pointer) -> None:
        stream = self.fs.create(self.path(f"{self.target}/_pointer-{pointer.last:012d}"), True)
        try:
            stream.write(bytearray((json.dumps(asdict(pointer)) + "\n").encode()))
        finally:
            stream.close()

    def drop(self, name: str) -> None:
        self.fs.delete(self.path(f"{self.target}/{name}"), True)

    def data(self) -> list[str]:
        return self._names("base-*") + self._names("delta-*")


def _union(spark: SparkSession, target: str, pointer: Pointer, schema: T.StructType) -> DataFrame:
    out = spark.createDataFrame([], schema)
    for name in pointer.folders():
        out = out.unionByName(spark.read.schema(schema).parquet(f"{target.rstrip('/')}/{name}"))
    return out


def read(spark: SparkSession, target: str, schema: T.StructType, combine: Combine) -> DataFrame:
    """The table as the last published batch left it."""
    pointers = _Folder(spark, target).pointers()
    return combine(_union(spark, target, pointers[-1] if pointers else Pointer(), schema))


def keep(target: str, combine: Combine, partition: list[str] | None = None, compact_after: int = COMPACT_AFTER) -> BatchWriter:
    """A batch writer that adds each batch to a kept table. partition: columns whose values get folders of their own."""
    target = target.rstrip("/")

    def save(rows: DataFrame, name: str) -> None:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*partition) if partition else writer).parquet(f"{target}/{name}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, _Folder(batch.sparkSession, target)
        pointers = folder.pointers()
        known = pointers[-1] if pointers else Pointer()
        if batch_id <= known.last:
            return
        save(combine(batch), f"delta-{batch_id}")
        new = Pointer(batch_id, known.base, [*known.deltas, batch_id])
        if len(new.deltas) > compact_after:
            save(combine(_union(spark, target, new, batch.schema)), f"base-{batch_id}")
            new = Pointer(batch_id, batch_id, [])
        folder.publish(new)

    return write


def vacuum(spark: SparkSession, target: str, keep_pointers: int = 2) -> list[str]:
    """Deletes the files that none of the last pointers names, and older pointers. For a time when no batch is being written."""
    folder = _Folder(spark, target)
    pointers = folder.pointers()
    if not pointers:
        return []
    named = {f for p in pointers[-keep_pointers:] for f in p.folders()}
    gone = [f for f in folder.data() if f not in named]
    for name in gone + [f"_pointer-{p.last:012d}" for p in pointers[:-keep_pointers]]:
        folder.drop(name)
    return gone
