"""Training and held-out rows of the labels table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
MAX_ROWS = 20_000  # labelled documents a model is fitted on, at most


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents whose labels are never learned from. A row without an id is not one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def training_labels(labels: DataFrame, column: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, label (0 or 1) of the training fold: all, or a sample of `max_rows` drawn by a hash of the id."""
    rows = (labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
            .groupBy("doc_id").agg(F.max(column).cast("int").alias("label")))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
