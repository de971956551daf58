"""License scan by diagonal voting.

1. Templates (short phrases and public notices) are cut into runs of `k` words. A bitmap of their hashes, of fixed size,
   goes to all tasks; one pass over the documents keeps the runs that may be a template's.
2. Those runs are joined to the templates' runs on their words. A match votes for the diagonal
   `place in the document - place in the template`, on which a copy's matches all lie.
3. Neighbouring diagonals, as a dropped or added word makes them, are merged into one candidate. It is verified by the
   share of the template's runs that it covers; matches are equal words, so no hash collision counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm import grams, words
from eventmart.llm.tables import settle, shared

# Phrases and labels of the contract.
BASE_PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Wording of public license notices, A-Z lowered, without punctuation.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
     "license", "apache-2"),
    ("under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("this work is licensed under a creative commons attribution noncommercial license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution license", "cc-by"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
]

K_WORDS = 3
SLACK = 3  # diagonals this near belong to one copy
MIN_SHARE = 0.75


def templates(spark: SparkSession, phrases=None, notices=None) -> DataFrame:
    """Template table: template, words, label, exact (a phrase, of which only whole copies count)."""
    rows = [(t, label, True) for t, label in (BASE_PHRASES if phrases is None else phrases)]
    rows += [(t, label, False) for t, label in (NOTICES if notices is None else notices)]
    return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "template int, words string, label string, exact boolean")


def template_runs(table: DataFrame, k: int = K_WORDS) -> DataFrame:
    """template, label, exact, n_runs, t_pos, run, of templates with at least k words."""
    parts = F.split("words", " ")
    starts = F.sequence(F.lit(0), F.size(parts) - k)
    return (table.where(F.size(parts) >= k)
            .select("template", "label", "exact", (F.size(parts) - (k - 1)).alias("n_runs"),
                    F.posexplode(F.transform(starts, lambda i: F.array_join(F.slice(parts, i + 1, F.lit(k)), " "))).alias("t_pos", "run")))


def _hash_runs(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros(0, np.uint64)] + [words.runs(part.hashes(), k)[words.inside(part.text, k)]
                                              for part in words.slices(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64))], names=["hash"])
    return run


def _scan(bits, k: int):
    """Per document, its number of words and its runs that may be a template's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch.column(1)):
                runs = words.runs(part.hashes(), k)
                at = np.flatnonzero(words.inside(part.text, k))
                at = at[grams.may_hold(bits.value, runs[at])]
                offsets = part.word_offsets()
                found = np.concatenate(([0], np.cumsum(np.bincount(part.text[at], minlength=part.n_texts)))).astype(np.int32)
                hits = pa.StructArray.from_arrays(
                    [pa.array(at - offsets[part.text[at]], pa.int64()),
                     pa.array([" ".join(part.word(j) for j in range(i, i + k)) for i in at], pa.string())], names=["pos", "run"])
                texts = slice(part.first, part.first + part.n_texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[texts], batch.column(2)[texts], pa.array(np.diff(offsets), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(found), hits)], names=["doc_id", "text_hash", "n_words", "hits"])
    return run


def license_scan(documents: DataFrame, table: DataFrame | None = None, k: int = K_WORDS, slack: int = SLACK,
                 min_share: float = MIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Per-document rows, and the copies found.

    documents: doc_id, text; other columns are ignored, whatever their names. First result, one row per input row:
    doc_id, n_words, n_base, first_word, last_word (places of exact phrases), base_labels, labels, score (the best
    covered share). Second: doc_id, text_hash, template, label, exact, first_word, last_word, share.
    Null and empty texts have no words and no labels; repeated rows each get the same row; an empty table gives none.
    """
    spark = documents.sparkSession
    table = templates(spark) if table is None else table
    runs_table = template_runs(table, k)
    hashed = table.select("words").mapInArrow(_hash_runs(k), "hash bigint")
    bits = shared(spark, grams.bitmap_of(hashed, "hash"))
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    docs = settle(documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
                  .mapInArrow(_scan(bits, k), f"doc_id {doc_type}, text_hash bigint, n_words bigint, "
                                              "hits array<struct<pos: bigint, run: string>>"))
    # a document is its id and the hash of its text, so that repeated rows count once and get equal rows
    key = ["doc_id", "text_hash"]
    hits = docs.where(F.size("hits") > 0).dropDuplicates(key).select(*key, F.inline("hits"))
    votes = (hits.join(runs_table, "run")
             .groupBy(*key, "template", "label", "exact", "n_runs", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
             .agg(F.collect_list("t_pos").alias("matched"), F.min("pos").alias("first_word"),
                  (F.max("pos") + (k - 1)).alias("last_word")))
    along = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(along) > slack)
    merged = (votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
              .withColumn("copy", F.sum("new").over(along))
              .groupBy(*key, "template", "label", "exact", "n_runs", "copy")
              .agg(F.size(F.array_distinct(F.flatten(F.collect_list("matched")))).alias("covered"),
                   F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word")))
    share = F.col("covered") / F.col("n_runs")
    copies = (merged.withColumn("share", share)
              .where(F.when(F.col("exact"), F.col("covered") == F.col("n_runs")).otherwise(F.col("share") >= min_share))
              .select(*key, "template", "label", "exact", "first_word", "last_word", "share"))
    base = F.when(F.col("exact"), F.col("first_word"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per_doc = copies.groupBy(*key).agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        joined(F.when(F.col("exact"), F.col("label"))).alias("base_labels"), joined("label").alias("labels"),
        F.max("share").alias("score"))
    per_doc = per_doc.withColumnsRenamed({c: f"_{c}" for c in key})
    same = docs["doc_id"].eqNullSafe(per_doc["_doc_id"]) & docs["text_hash"].eqNullSafe(per_doc["_text_hash"])
    rows = (docs.drop("hits").join(per_doc, same, "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))
    return rows, copies
