"""What each of several filters removes, in every order in which they can be applied. A Gray-code walk over all subsets.

1. A document's mask has a bit for each filter that it fails. Documents are counted by part and mask, so a part has at most
   2 ** filters cells, however many documents it has.
2. The walk goes through all subsets of active filters and switches one filter at a time. Every cell keeps the number of
   active filters that it fails. A cell whose number leaves 0 is taken from the running survivors, and one whose number
   comes back to 0 is added to them. The survivors of each subset are stored.
3. A step of an order goes from one subset to the next, so what it removes is the difference of two stored states.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10  # the limits of A, B and C, the last two as percentages
_BLANKS = r"[\x20\x09-\x0D]+"


def text_failures(documents: DataFrame) -> DataFrame:
    """doc_id, part, digest, mask: the filters A to D that the text fails, a row for each document."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"),
                            F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", _BLANKS), ""))
    fails = [F.size("words") < MIN_WORDS,
             F.size(F.array_distinct("words")) * 100 < F.size("words") * MIN_DISTINCT,
             F.regexp_count("text", F.lit("[A-Z]")).cast("long") * 100 > F.length("text").cast("long") * MAX_CAPITALS,
             F.col("text").rlike("[#$%&*|]")]
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def mask_cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, n_good, n_toxic: the documents of each part that fail exactly the filters of a mask.

    Rows are counted before they meet anything: by text, part and id, then by text, part and label. So the copies of a text
    are a few rows by the time they are compared, however many there are.
    """
    rows = text_failures(documents).groupBy("digest", "mask", "part", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1 << 31)) + 1).otherwise(0))
    has = lambda column: F.max(F.coalesce(F.col(column) == 1, F.lit(False)))
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null")
              .groupBy("doc_id").agg(has("quality").alias("good"), has("toxic").alias("bad"))
              .withColumn("spread", F.lit(0).cast("long")))
    rows = rows.join(marked, ["doc_id", "spread"], "left").fillna(False, ["good", "bad"])
    with_id = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    groups = rows.groupBy("digest", "mask", "part", "good", "bad").agg(
        F.sum("n").alias("n"), F.min(with_id).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_no_id"))
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    leads = F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0) + F.col("n_no_id")
    split = groups.withColumn("leads", leads).select("part", "good", "bad", F.explode(F.array(
        F.struct(F.col("mask"), F.col("leads").alias("n")),
        F.struct((F.col("mask") + F.lit(1 << 4)).alias("mask"), (F.col("n") - F.col("leads")).alias("n")))).alias("cell"))
    of = lambda flag: F.sum(F.when(F.col(flag), F.col("cell.n")).otherwise(0))
    return (split.where("cell.n > 0").groupBy("part", F.col("cell.mask").alias("mask"))
            .agg(F.sum("cell.n").alias("n"), of("good").alias("n_good"), of("bad").alias("n_toxic")))


def walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters, by subset and part. cells: measures by part and mask, all masks in order."""
    masks = np.arange(cells.shape[1])
    failing, left, subset = np.zeros(len(masks), np.int64), cells.sum(axis=1), 0
    states = np.empty((len(masks), *left.shape), np.int64)
    states[0] = left
    for step in range(1, len(masks)):
        bit = step & -step
        subset ^= bit
        hit = masks & bit > 0
        if subset & bit:
            left = left - cells[:, hit & (failing == 0)].sum(axis=1)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            left = left + cells[:, hit & (failing == 0)].sum(axis=1)
        states[subset] = left
    return states


_OUT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
                 + [(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])


def _all_orders(filters: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (1 << len(filters)) - 1
        orders = list(permutations(range(len(filters))))
        for batch in batches:
            parts = batch.column(0).to_pylist()
            cells = np.zeros((len(parts), every + 1, 3), np.int64)
            for k, found in enumerate(batch.column(1).to_pylist()):
                for c in found:
                    cells[k, c["mask"]] = c["n"], c["n_good"], c["n_toxic"]
            states = walk(cells)
            for k, part in enumerate(parts):
                rows, shapley = [], [0] * len(filters)
                for order in orders:
                    active = 0
                    for step, f in enumerate(order):
                        after = active | 1 << f
                        kept, _, _ = states[after, k]
                        removed, good, toxic = states[active, k] - states[after, k]
                        fails = states[0, k, 0] - states[1 << f, k, 0]
                        alone = states[every ^ 1 << f, k, 0] - states[every, k, 0]
                        rows.append([part, "".join(filters[x] for x in order), step + 1, kept, removed, fails - removed, alone, good, toxic, f])
                        shapley[f] += int(removed)
                        active = after
                columns = list(zip(*[r[:-1] + [shapley[r[-1]]] for r in rows]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)
    return run


def all_orders(cells: DataFrame, filters: str) -> DataFrame:
    """A row for each part, order of the filters (a letter each) and step. cells: part, mask, n, n_good, n_toxic."""
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "n_good", "n_toxic")).alias("cells"))
    counts = ", ".join(f"{f.name} bigint" for f in _OUT if f.type == pa.int64())
    return packed.mapInArrow(_all_orders(filters), f"part string, filter_order string, step int, {counts}")


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    documents: doc_id, text, lang; labels: doc_id, quality, toxic; other columns are ignored, whatever their names. A part is
    a language. The filters are A (few words), B (few distinct words), C (many capitals), D (a sign of markup) and E (the text
    of a document with a smaller id). A null text counts as empty, a null language as the part ''. Rows without a doc_id have
    no smaller one and no label. Repeated rows are counted each and do not fail E for one another. Of several labels of a
    document one is enough. A document with several labels is lost once. An empty table gives no rows.
    """
    return all_orders(mask_cells(documents, labels), FILTERS)
