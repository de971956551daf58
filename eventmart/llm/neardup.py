"""MinHash near-duplicates on HyperMinHash registers.

1. A document's distinct 3-word shingles are hashed once. The hash's top bits choose one of 128 buckets; a bucket keeps, of
   its smallest hash, the number of leading zeros and ten bits after the first one: two bytes. Empty buckets borrow
   from full ones in an order fixed for all documents, so short texts have whole registers too.
2. Documents with equal sets are one class from here on, named by their smallest doc_id.
3. Registers are banded, four to a band. With 32 bands a pair of similarity 0.85 shares none once in 10**10.
4. A pair's similarity is estimated from its registers, corrected for registers that agree by chance. Pairs six standard
   errors below the limit go; all others are confirmed on their full sets.
5. Confirmed links are joined into components, and similar documents that are still apart are found by their rarest
   shingles and confirmed as well (see `links`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm import grams, links, words
from eventmart.llm.tables import settle, shared

BUCKETS = 128
MANTISSA = 10
ROWS = 4  # registers of a band
BANDS = BUCKETS // ROWS
_PREFIX = np.uint64(BUCKETS.bit_length() - 1)


def _borrow_order() -> np.ndarray:
    """For every bucket, the buckets it borrows from if empty, in order."""
    rng = np.random.default_rng(7)
    return np.array([rng.permutation(BUCKETS) for _ in range(BUCKETS)])


_ORDER = _borrow_order()


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a set of distinct, sorted 64-bit hashes that is not empty."""
    bucket = (hashes >> (np.uint64(64) - _PREFIX)).astype(np.int64)
    full, at = np.unique(bucket, return_index=True)  # sorted, so the first of a bucket is its smallest
    rest = hashes[at] << _PREFIX | np.uint64(1)  # never zero
    zeros = (64 - np.frexp(rest.astype(np.float64))[1]).astype(np.int64)
    zeros = np.maximum(zeros, 0)
    after = rest << (zeros + 1).astype(np.uint64)
    mantissa = (after >> np.uint64(64 - MANTISSA)).astype(np.int64)
    out = np.full(BUCKETS, -1, np.int64)
    out[full] = zeros << MANTISSA | mantissa
    empty = np.flatnonzero(out < 0)
    if len(empty):
        order = _ORDER[empty]
        lender = order[np.arange(len(empty)), (out[order] >= 0).argmax(axis=1)]
        out[empty] = out[lender]
    return out.astype(np.uint16)


_chances: dict[tuple[int, int], float] = {}


def _chance(n: int, m: int) -> float:
    """Probability that registers of unrelated sets of 2**(n/4) and 2**(m/4) shingles agree."""
    if (n, m) in _chances:
        return _chances[n, m]
    zeros = np.arange(0, 56)[:, None]
    low = 2.0 ** -(zeros + 1) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA))
    high = low + 2.0 ** -(zeros + 1) / (1 << MANTISSA)
    share = [np.exp(-low * s) - np.exp(-high * s) for s in (max(1.0, 2.0 ** (k / 4) / BUCKETS) for k in (n, m))]
    _chances[n, m] = float((share[0] * share[1]).sum())
    return _chances[n, m]


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """Similarity estimated from two sets' registers, corrected for chance agreement."""
    chance = _chance(round(4 * np.log2(n_a)), round(4 * np.log2(n_b)))
    return max(0.0, (float((a == b).mean()) - chance) / (1 - chance))


def _shingles(part: words.Words, hashes: np.ndarray, offsets: np.ndarray, t: int, n: int) -> np.ndarray:
    """Distinct sorted shingle hashes of a text; with fewer than n words, of the whole sequence; none without words."""
    a, b = offsets[t], offsets[t + 1]
    return np.unique(words.runs(hashes[a:b], min(n, b - a))) if b > a else np.zeros(0, np.uint64)


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch.column(1), words.SPACED):
                hashes, offsets = part.hashes(), part.word_offsets()
                sizes, digests, regs = [], [], []
                for t in range(part.n_texts):
                    own = _shingles(part, hashes, offsets, t, n)
                    sizes.append(len(own))
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                    regs.append(registers(own).tobytes() if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part.first:part.first + part.n_texts], pa.array(sizes, pa.int64()),
                     pa.array(digests, pa.binary()), pa.array(regs, pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "registers"])
    return run


def _sets(wanted, n: int):
    """Shingle sets of the documents whose ids may be wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = pa.array(np.flatnonzero(grams.may_hold(wanted.value, words.mix(ids)) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)))
            if not len(at):
                continue
            ids, texts = batch.column(0).take(at), batch.column(1).take(at)
            for part in words.slices(texts, words.SPACED):
                hashes, offsets = part.hashes(), part.word_offsets()
                sets = [_shingles(part, hashes, offsets, t, n) for t in range(part.n_texts)]
                bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids[part.first:part.first + part.n_texts],
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(sets).view(np.int64)))],
                    names=["node", "shingles"])
    return run


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = percent / 100
        for batch in batches:
            keep = []
            for n_a, n_b, a, b in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "regs_a", "regs_b"))):
                own = BUCKETS * (1 - np.exp(-min(n_a, n_b) / BUCKETS))  # registers of its own
                error = np.sqrt(limit * (1 - limit) / own)
                near = min(n_a, n_b) < BUCKETS // 2 or estimate(
                    np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16), n_a, n_b) >= limit - 6 * error
                keep.append(near)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("shingles_a"), batch.column("shingles_b")):
                a, b = (x.values.to_numpy(zero_copy_only=False) for x in (a, b))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _shingle_sets(nodes: DataFrame, texts: DataFrame, n: int, rows: int) -> DataFrame:
    """node, shingles of the named classes."""
    nodes = nodes.distinct()
    wanted = shared(texts.sparkSession, grams.bitmap_of(nodes.mapInArrow(_mixed, "hash bigint"), "hash"))
    return settle(texts.mapInArrow(_sets(wanted, n), "node bigint, shingles array<bigint>").join(nodes, "node", "left_semi")
                  .dropDuplicates(["node", "shingles"]), rows)


def _confirm(pairs: DataFrame, classes: DataFrame, texts: DataFrame, n: int, percent: int, rows: int) -> DataFrame:
    """The pairs a, b of class names that are links."""
    side = lambda s: classes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("registers").alias(f"regs_{s}"))
    likely = settle(pairs.join(side("a"), "a").join(side("b"), "b")
                    .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
                    .mapInArrow(_likely(percent), "a bigint, b bigint"), rows)
    sets = _shingle_sets(likely.select(F.explode(F.array("a", "b")).alias("node")), texts, n, rows)
    side = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"shingles_{s}"))
    return settle(likely.join(side("a"), "a").join(side("b"), "b").mapInArrow(_linked(percent), "a bigint, b bigint"), rows)


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(words.mix(ids).view(np.int64))], names=["hash"])


def near_duplicates(documents: DataFrame, n: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of documents (doc_id, text; other columns are ignored).

    Words end at ASCII white space, A-Z lowered. Documents are linked where 100 * shared shingles >= percent * all
    shingles of both. component_id is the smallest doc_id reachable over links, itself included; kept marks that one.
    Null and empty texts have no shingles and no links. doc_id names a document: rows that share one are linked.
    A row without a doc_id has no links, a null component_id, and is kept. An empty table gives no rows.
    """
    docs = settle(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _signatures(n), "doc_id bigint, n_shingles bigint, digest binary, registers binary"))
    rows = docs.count()
    linkable = docs.where("digest is not null and doc_id is not null")
    names = settle(linkable.groupBy("digest").agg(F.min("doc_id").alias("node")), rows)
    named = linkable.join(names, "digest")
    classes = settle(named.where("doc_id = node").select("node", "n_shingles", "registers").distinct(), rows)
    bands = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        F.substring(F.col("registers"), i * (2 * ROWS) + 1, F.lit(2 * ROWS)), i)))
    members = classes.select("node", bands.alias("bucket"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # rows that share a doc_id but not a text are linked through it
    same_id = named.where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    same_id = same_id.join(classes.select(F.col("node").alias("b")).distinct(), "b", "left_semi").select("a", "b")
    elements = lambda asked: (_shingle_sets(asked, texts, n, rows)
                              .select("node", F.explode("shingles").alias("element")))
    component = links.linked(members, lambda pairs: _confirm(pairs, classes, texts, n, percent, rows), elements, percent, rows, same_id)
    of_class = settle(names.join(component, "node", "left")
                      .select("digest", F.coalesce("component", "node").alias("component_id")), rows)
    out = docs.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"),
                      F.coalesce(component_id == F.col("doc_id"), F.lit(True)).alias("kept"))


def without_copies(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id, with all columns.

    Documents without words or with a null text are near nothing and stay, as do rows with a null doc_id. Of rows that repeat a
    doc_id, one stays. An empty table gives an empty one.
    """
    gone = near_duplicates(documents, n, percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    left = documents.join(gone, documents["doc_id"].cast("long") == gone["_gone"], "left_anti")
    repeated = left.where("doc_id is not null").dropDuplicates(["doc_id"])
    return repeated.unionByName(left.where("doc_id is null"))
