"""Benchmark decontamination: rare word runs seed alignments between training passages and test items.

1. All runs of up to LONGEST words of all items are counted in the documents, in one pass behind a bitmap of fixed size.
2. An alignment that scores MIN_SCORE has at most `most_edits` edits, so of `most_edits` + 1 disjoint pieces of an item one
   stays whole. The pieces are put where the runs are rarest, by a small dynamic programme over the counts, and are the
   item's seeds. A frequent run is a seed only where no rarer one can stand for it; a run that no document holds is none.
3. A second pass over the documents keeps the places that may be seeds, with as many words around them as an alignment with
   that seed's item can reach: the passages. Seeds are joined to the passages' runs on the hash.
4. A pair of passage and item is aligned by Smith-Waterman over words (match 1, other word -1, gap -1), unless no stretch of
   the passage has enough words of the item for MIN_SCORE (`reachable`). The score is the alignment's over the item's
   length: 1 for a copy, 0.6 if each fifth word is another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm import grams, words
from eventmart.llm.tables import settle, shared

MIN_SCORE = 0.6
LONGEST = 4  # words of a seed
_BLOCK = 512  # words of an item over which pieces are placed at once
_ASIDE = np.uint64(0x9FB21C651E98DF25)
_SIGN = r"[^\x00-\x7F\pL\pM\pN]"  # outside ASCII
_SINGLE = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"  # scripts without blanks


def most_edits(length: int, min_score: float) -> int:
    """Edits that an alignment of the score can have: the most are words put in, at one point each."""
    return length - max(1, math.ceil(min_score * length))


def run_length(length: int, min_score: float) -> int:
    """Words of the longest run of the item that every alignment of the score keeps.

    With e edits the matched words lie in at most e + 1 unchanged runs. A word that is another or left out costs a match
    as well, so of all edits, words put in leave the shortest runs: the whole item in `most_edits` + 1 of them.
    """
    return -(-length // (most_edits(length, min_score) + 1))


def rarest_pieces(places: list[np.ndarray], count: int) -> list[tuple[int, int]]:
    """(first word, words) of `count` disjoint runs that have the fewest places together.

    places: for runs of 1, 2, ... words the number of places in the documents, by first word.
    """
    length = len(places[0])
    best, picks = np.zeros(length + 1), []
    for _ in range(count):
        new, pick = np.full(length + 1, np.inf), np.zeros(length + 1, np.int8)
        for n, of_n in enumerate(places, 1):
            if n <= length:
                cost = best[:length + 1 - n] + of_n
                better = cost <= new[n:]
                new[n:][better] = cost[better]
                pick[n:][better] = n
        best = np.minimum.accumulate(new)
        pick[best < new] = 0  # the last piece ends before
        picks.append(pick)
    out, at = [], length
    while picks:
        n = int(picks[-1][at])
        at -= max(n, 1)
        if n:
            out.append((at, n))
            picks.pop()
    return out[::-1]


def seeds_of(places: list[np.ndarray], min_score: float) -> list[tuple[int, int]]:
    """(first word, words) of an item's seeds: every alignment of the score keeps one of them whole.

    They are its rarest disjoint pieces, or all its runs of `run_length` words where those have fewer places.
    """
    length = len(places[0])
    count, every = most_edits(length, min_score) + 1, run_length(length, min_score)
    pieces = []
    for lo in range(0, length, _BLOCK):
        hi = min(length, lo + _BLOCK)
        part = [of_n[lo:max(lo, hi - n + 1)] for n, of_n in enumerate(places, 1)]
        pieces += [(lo + at, n) for at, n in rarest_pieces(part, count * hi // length - count * lo // length)]
    if every <= len(places) and places[every - 1].sum() < sum(places[n - 1][at] for at, n in pieces):
        pieces = [(at, every) for at in range(length - every + 1)]
    return pieces


def plain_words(texts: pa.Array) -> pa.Array:
    """Texts with blanks for the signs and blanks of all scripts, and around each character of a script that puts no blanks
    between words. Marks without a width (soft hyphens, joiners) go."""
    changed = pc.fill_null(pc.match_substring_regex(texts, f"{_SIGN}|{_SINGLE}"), False)
    if not pc.any(changed).as_py():
        return texts
    new = texts.filter(changed)
    for pattern, by in ((r"\p{Cf}+", ""), (f"{_SIGN}+", " "), (f"({_SINGLE})", r" \1 ")):
        new = pc.replace_substring_regex(new, pattern, by)
    return pc.replace_with_mask(texts, changed, new)


def _mark(runs: np.ndarray, level: int) -> np.ndarray:
    """A hash of a run and of the reach of its item, a power of two."""
    return words.mix(runs ^ (_ASIDE * np.uint64(2 * level + 1)))


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = batch.column(0), []
        for part in words.slices(plain_words(batch.column(1))):
            hashes, offsets = part.hashes(), part.word_offsets()
            for t in range(part.n_texts):
                a, b = offsets[t], offsets[t + 1]
                if b > a:
                    out.append((ids[part.first + t].as_py(), " ".join(part.word(k) for k in range(a, b)), int(b - a),
                                np.concatenate([words.runs(hashes[a:b], n) for n in range(1, LONGEST + 1)]).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], batch.schema.field(0).type), pa.array([r[1] for r in out], pa.string()),
             pa.array([r[2] for r in out], pa.int32()), pa.array([r[3] for r in out], pa.list_(pa.int64()))],
            names=["item_id", "item_words", "n_words", "runs"])


def _counted(bits):
    """Runs that items may hold, and their places in a slice of the documents.

    A run of several words is looked at only where the run without its last word has passed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(plain_words(batch.column(0))):
                hashes, at, found = part.hashes(), np.arange(len(part.text)), []
                for n in range(1, LONGEST + 1):
                    at = at[at + n <= len(hashes)]
                    at = at[part.text[at] == part.text[at + n - 1]]
                    runs = words.runs_at(hashes, at, n)
                    held = grams.may_hold(bits.value, runs)
                    at = at[held]
                    found.append(runs[held])
                runs, places = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64)), pa.array(places, pa.int64())], names=["run", "places"])
    return run


def _chosen(min_score: float):
    """The seeds of each item that some document holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, n_words, run_hash, marks, levels = [], [], [], [], []
            for k, (length, runs, known) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n_words", "runs", "known")))):
                runs, flat = np.array(runs, np.int64), np.zeros(len(runs), np.int64)
                for entry in known:
                    flat[entry["pos"]] = entry["places"]
                sizes = [max(0, length - n + 1) for n in range(1, LONGEST + 1)]
                begin = np.concatenate(([0], np.cumsum(sizes)))
                level = (length + most_edits(length, min_score) - 1).bit_length()
                for at, n in seeds_of(np.split(flat, begin[1:-1]), min_score):
                    if flat[begin[n - 1] + at]:
                        rows.append(k)
                        n_words.append(n)
                        run_hash.append(runs[begin[n - 1] + at])
                        levels.append(level)
                        marks.append(_mark(runs[begin[n - 1] + at:begin[n - 1] + at + 1].view(np.uint64), level).view(np.int64)[0])
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(take), batch.column("item_words").take(take), pa.array(run_hash, pa.int64()),
                 pa.array(marks, pa.int64()), pa.array(n_words, pa.int32()), pa.array(levels, pa.int32())],
                names=["item_id", "item_words", "run", "mark", "n", "level"])
    return run


def _passages(bits, lengths: list[int], levels: list[int]):
    """Stretches of a text around its runs that may be seeds, each with those runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for part in words.slices(plain_words(batch.column(1))):
                hashes, offsets = part.hashes(), part.word_offsets()
                found = []
                for n in lengths:
                    runs = words.runs(hashes, n)
                    at = np.flatnonzero(words.inside(part.text, n))
                    at = at[grams.may_hold(bits.value, runs[at])]
                    margin = np.zeros(len(at), np.int64)
                    for level in levels:
                        margin[grams.may_hold(bits.value, _mark(runs[at], level))] = 1 << level
                    at, margin = at[margin > 0], margin[margin > 0]
                    text = part.text[at]
                    found.append((np.maximum(offsets[text], at - margin), np.minimum(offsets[text + 1], at + n + margin), runs[at]))
                lo, hi, run_hash = (np.concatenate(x) for x in zip(*found))
                if not len(lo):
                    continue
                order = np.argsort(lo, kind="stable")
                lo, hi, run_hash = lo[order], np.maximum.accumulate(hi[order]), run_hash[order]
                # stretches stay in their texts, so those of two texts never overlap
                first = np.flatnonzero(np.concatenate(([True], lo[1:] >= hi[:-1])))
                last = np.append(first[1:], len(lo))
                out = []
                for a, b in zip(first, last):
                    t = part.text[lo[a]]
                    out.append((part.first + t, lo[a] - offsets[t], " ".join(part.word(k) for k in range(lo[a], hi[b - 1])),
                                np.unique(run_hash[a:b]).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([r[0] for r in out])), pa.array([r[1] for r in out], pa.int64()),
                     pa.array([r[2] for r in out], pa.string()), pa.array([r[3] for r in out], pa.list_(pa.int64()))],
                    names=["doc_id", "first_word", "passage", "runs"])
    return run


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman score of two word sequences, and the place in the passage after the alignment's last word."""
    step = np.arange(len(passage) + 1, dtype=np.int32)
    row = np.zeros(len(passage) + 1, np.int32)
    best, end = 0, 0
    for word in item:
        new = np.maximum(row - 1, 0)
        np.maximum(new[1:], row[:-1] + np.where(passage == word, 1, -1), out=new[1:])
        row = (np.maximum.accumulate(new + step) - step).astype(np.int32)
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def reachable(passage: np.ndarray, item: np.ndarray) -> int:
    """No alignment scores more: the most, over all stretches of the passage, of its words in the item less its others."""
    sums = np.concatenate(([0], np.cumsum(np.where(np.isin(passage, item), 1, -1))))
    return int((sums - np.minimum.accumulate(sums)).max())


def _aligned(min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, score, first, last = [], [], [], []
            for k, (p, i, at) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("passage", "item_words", "first_word")))):
                number: dict[str, int] = {}
                a, b = (np.array([number.setdefault(w, len(number)) for w in x.split(" ")]) for x in (p, i))
                if reachable(a, b) < min_score * len(b):
                    continue
                points, end = align(a, b)
                if points >= min_score * len(b):
                    _, back = align(a[:end][::-1], b[::-1])
                    keep.append(k)
                    score.append(points / len(b))
                    first.append(at + end - back)
                    last.append(at + end - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(keep, pa.int64())), batch.column("item_id").take(pa.array(keep, pa.int64())),
                 pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                names=["doc_id", "item_id", "score", "first_word", "last_word"])
    return run


def caseless(text: str) -> Column:
    """A text without case, in all scripts: in capitals, since small letters with several forms (ß and ss, σ and ς) share them.

    Capitals that the small letter does not lead to are set to those it does. No letter becomes a blank or a sign, so
    words keep their places. Lowering the capitals again would do nothing: Spark reduces lower(upper(x)) to lower(x).
    """
    plain = F.replace(F.replace(F.col(text), F.lit("ẞ"), F.lit("SS")), F.lit("İ"), F.lit("I"))
    return F.upper(plain).alias(text)


def contaminated(documents: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Pairs of document and test item of which the document holds a copy, exact or edited.

    documents: doc_id, text; benchmark: item_id, text; other columns are ignored, whatever their names. Words are runs
    of letters and digits, compared without case; in scripts without blanks each character is one. One row per doc_id and
    item_id with the best score and the place of that copy (words from 0). Repeated rows give one row; a null id is an id
    of its own; null and empty texts and items without words match nothing; an empty table on either side gives no rows.
    Among copies with the best score the first counts.
    """
    docs = documents.select("doc_id", caseless("text"))
    spark = docs.sparkSession
    doc_type, item_type = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    items = settle(benchmark.select("item_id", caseless("text")).mapInArrow(
        _item_rows, f"item_id {item_type}, item_words string, n_words int, runs array<bigint>")
        .dropDuplicates(["item_id", "item_words"]).withColumn("item_key", F.xxhash64("item_id", "item_words")))
    own = items.select("item_key", F.posexplode("runs").alias("pos", "run"))
    held = shared(spark, grams.bitmap_of(own.select("run").distinct(), "run"))
    counts = settle(docs.select("text").mapInArrow(_counted(held), "run bigint, places bigint")
                    .groupBy("run").agg(F.sum("places").alias("places")))
    known = own.join(counts, "run").groupBy("item_key").agg(F.collect_list(F.struct("pos", "places")).alias("known"))
    seeds = settle(items.join(known, "item_key").select("item_id", "item_words", "n_words", "runs", "known").mapInArrow(
        _chosen(min_score), f"item_id {item_type}, item_words string, run bigint, mark bigint, n int, level int"))
    kinds = seeds.select("n", "level").distinct().collect()
    if not kinds:
        return spark.createDataFrame([], f"doc_id {doc_type}, item_id {item_type}, score double, first_word bigint, last_word bigint")
    bits = shared(spark, grams.bitmap_of(seeds.select(F.explode(F.array("run", "mark")).alias("run")).distinct(), "run"))
    passages = settle(docs.mapInArrow(
        _passages(bits, sorted({k.n for k in kinds}), sorted({k.level for k in kinds})),
        f"doc_id {doc_type}, first_word bigint, passage string, runs array<bigint>")
        .withColumn("passage_key", F.xxhash64("doc_id", "first_word", "passage")))
    places = passages.select("passage_key", F.explode("runs").alias("run"))
    pairs = places.join(seeds.select("item_id", "item_words", "run"), "run").select("passage_key", "item_id", "item_words").distinct()
    found = (pairs.join(passages.select("passage_key", "doc_id", "first_word", "passage")
                        .dropDuplicates(["passage_key"]), "passage_key")
             .select("doc_id", "first_word", "passage", "item_id", "item_words")
             .mapInArrow(_aligned(min_score),
                         f"doc_id {doc_type}, item_id {item_type}, score double, first_word bigint, last_word bigint"))
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("score", -F.col("first_word"), "last_word")).alias("best"))
            .select("doc_id", "item_id", "best.score", (-F.col("best.col2")).alias("first_word"), "best.last_word"))


def clean_documents(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no copy of a test item, with all their columns.

    Documents with null or empty texts stay. Rows that share a doc_id (also a null one) with a document that holds a copy go
    with it, repeated rows as well. An empty benchmark removes nothing, empty documents give none.
    """
    bad = contaminated(documents, benchmark, **options).select(F.col("doc_id").alias("_bad")).distinct()
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")
