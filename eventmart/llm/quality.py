"""Text quality by a generalised additive model with pairwise interactions.

Every feature has a lookup table over its bins, and so have a few pairs of features. Training goes round the features
again and again; each step fits a shallow tree to the gradients of the logistic loss, summed by bin, and adds a small
share of it to the feature's table. Then the pairs whose tables would lower the loss most are boosted in the same
way. A score is the sum of the tables' entries, so scoring is one vectorised addition for each table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm import words
from eventmart.llm.folds import MAX_ROWS, held_out, training_labels
from eventmart.llm.tables import settle

FEATURES = [
    "log_words", "log_bytes", "mean_word", "longest_word", "upper", "symbols", "exclamations", "bars", "digits",
    "non_ascii", "distinct_words", "distinct_triples", "repeats_previous", "top_word", "short_words", "ends_symbol",
    "equal_bytes", "log_lines", "repeated_lines", "log_line", "stops",
]


def _byte_set(found) -> np.ndarray:
    return np.array([found(chr(b)) if b < 128 else False for b in range(256)])


_UPPER = _byte_set(str.isupper)
_LETTER = _byte_set(str.isalpha)
_DIGIT = _byte_set(str.isdigit)
_SYMBOL = _byte_set(lambda c: c.isprintable() and not c.isalnum() and c not in " .,'")
_STOP = _byte_set(lambda c: c in ".,;:?")
_NON_ASCII = np.arange(256) >= 128


def _ratio(a, b) -> np.ndarray:
    return np.where(b > 0, a / np.maximum(b, 1), 0.0)


def _longest_run(text: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For every text, its number of distinct keys, and how often its most frequent one occurs."""
    distinct, top = np.zeros(n), np.zeros(n)
    if len(text):
        salted = words.mix(key ^ words.mix(text.astype(np.uint64) + np.uint64(1)))
        _, at, count = np.unique(salted, return_index=True, return_counts=True)
        distinct = np.bincount(text[at], minlength=n).astype(float)
        np.maximum.at(top, text[at], count)
    return distinct, top


def features(part: words.Words) -> np.ndarray:
    """One row of FEATURES for each text of a slice; words end at white space."""
    n, raw = part.n_texts, part.raw
    edges = part.text_start
    size = np.diff(edges).astype(float)

    def share(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[raw], dtype=np.int32)))
        return (sums[edges[1:]] - sums[edges[:-1]]).astype(float)

    count = part.counts().astype(float)
    hashes, text = part.hashes(), part.text
    length = (part.end - part.start).astype(float)
    per_text = lambda weights: np.bincount(text, weights, minlength=n) if len(text) else np.zeros(n)
    longest = np.zeros(n)
    np.maximum.at(longest, text, length)
    distinct, top = _longest_run(text, hashes, n)
    in_text = words.inside(text, 3)
    triple_text = text[:len(in_text)][in_text]
    triples, _ = _longest_run(triple_text, words.runs(hashes, 3)[in_text], n)
    n_triples = np.bincount(triple_text, minlength=n) if len(triple_text) else np.zeros(n)
    same = np.zeros(len(text))
    if len(text) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    last = raw[part.end - 1] if len(text) else raw[:0]
    # lines: a line's hash is made of its words' hashes in order, a line's words those before the next line end
    line_of = np.concatenate(([0], np.cumsum(raw == 10)))
    word_line = line_of[part.start] if len(text) else np.zeros(0, np.int64)
    new_line = np.ones(len(text), bool)
    if len(text) > 1:
        new_line[1:] = (word_line[1:] != word_line[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new_line)
    if len(first):
        within = np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))
        line_hash = np.add.reduceat(words.mix(hashes + within.astype(np.uint64)), first)
        lines, _ = _longest_run(text[first], line_hash, n)
        n_lines = np.bincount(text[first], minlength=n).astype(float)
    else:
        lines = n_lines = np.zeros(n)
    equal = np.zeros(len(raw) + 1, np.int32)
    if len(raw) > 1:
        equal[2:] = np.cumsum(raw[1:] == raw[:-1], dtype=np.int32)
    letters = share(_LETTER)
    return np.column_stack([
        np.log1p(count), np.log1p(size), _ratio(per_text(length), count), longest, _ratio(share(_UPPER), letters),
        _ratio(share(_SYMBOL), size), _ratio(share(_byte_set(lambda c: c == "!")), size),
        _ratio(share(_byte_set(lambda c: c == "|")), size), _ratio(share(_DIGIT), size), _ratio(share(_NON_ASCII), size),
        _ratio(distinct, count), _ratio(triples, n_triples), _ratio(per_text(same), count), _ratio(top, count),
        _ratio(per_text(length <= 3), count), _ratio(per_text(_SYMBOL[last]), count),
        _ratio(equal[edges[1:]] - equal[np.minimum(edges[:-1] + 1, edges[1:])], size), np.log1p(n_lines),
        _ratio(n_lines - lines, n_lines), np.log1p(_ratio(size, n_lines)), _ratio(share(_STOP), count),
    ])


@dataclass
class AdditiveModel:
    base: float
    cuts: list[np.ndarray]  # borders of the bins of each feature
    tables: list[np.ndarray]  # a value for each bin
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]  # two features, their coarse cuts, a value for each two bins

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for k, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            out += table[np.searchsorted(cuts, x[:, k], "right")]
        for a, b, cuts_a, cuts_b, table in self.pairs:
            out += table[np.searchsorted(cuts_a, x[:, a], "right"), np.searchsorted(cuts_b, x[:, b], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


_LAMBDA = 1.0


def _gain(g, h):
    return g * g / (h + _LAMBDA)


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values over ordered bins of a tree with up to 2**depth leaves."""
    out = np.full(len(g), g.sum() / (h.sum() + _LAMBDA))
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
        k = int(gain.argmax()) + 1
        if gain[k - 1] > 1e-9:
            out[:k], out[k:] = _shallow_tree(g[:k], h[:k], depth - 1), _shallow_tree(g[k:], h[k:], depth - 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Leaf values of the best tree that cuts a grid once on each axis, and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = lambda c: (c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1],
                       c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1])
    if min(g.shape) < 2:
        return np.zeros_like(g), 0.0
    pg, ph = parts(cg), parts(ch)
    gain = sum(_gain(a, b) for a, b in zip(pg, ph)) - _gain(g.sum(), h.sum())
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    leaf = [a[i, j] / (b[i, j] + _LAMBDA) for a, b in zip(pg, ph)]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = leaf
    return out, float(gain[i, j])


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, bins: int = 48, depth: int = 2, n_pairs: int = 8,
        pair_rounds: int = 60, pair_bins: int = 8) -> AdditiveModel:
    """Cyclic boosting. Without rows of both labels, the model is the labels' share, or one half without any."""
    n_features = x.shape[1]
    share = y.mean() if len(y) else 0.5
    share = min(max(share, 1 / (len(y) + 2)), 1 - 1 / (len(y) + 2))
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return AdditiveModel(base, [np.zeros(0)] * n_features, [np.zeros(1)] * n_features, [])
    cuts = [_cuts(x[:, k], bins) for k in range(n_features)]
    binned = [np.searchsorted(c, x[:, k], "right") for k, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    margin = np.full(len(y), base)

    def gradients():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, b in enumerate(binned):
            g, h = gradients()
            size = len(tables[k])
            step = rate * _shallow_tree(np.bincount(b, g, size), np.bincount(b, h, size), depth)
            tables[k] += step
            margin += step[b]
    coarse = [_cuts(x[:, k], pair_bins) for k in range(n_features)]
    spot = [np.searchsorted(c, x[:, k], "right") for k, c in enumerate(coarse)]

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        return np.bincount(spot[a] * shape[1] + spot[b], v, shape[0] * shape[1]).reshape(shape)

    g, h = gradients()
    ranked = sorted(((_quadrants(grid(a, b, g), grid(a, b, h))[1], a, b) for a in range(n_features) for b in range(a)), reverse=True)
    pairs = [(a, b, np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for gain, a, b in ranked[:n_pairs] if gain > 1e-9]
    for _ in range(pair_rounds):
        for a, b, table in pairs:
            g, h = gradients()
            step = rate * _quadrants(grid(a, b, g), grid(a, b, h))[0]
            table += step
            margin += step[spot[a], spot[b]]
    return AdditiveModel(base, cuts, tables, [(a, b, coarse[a], coarse[b], t) for a, b, t in pairs])


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.slices(batch.column(1), words.SPACED):
            flat = pa.array(features(part).ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[part.first:part.first + part.n_texts],
                 pa.ListArray.from_arrays(pa.array(np.arange(part.n_texts + 1, dtype=np.int32) * len(FEATURES)), flat)],
                names=["doc_id", "x"])


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])
    return run


def quality_scores(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, limit: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of documents (doc_id, text; other columns are ignored).

    The model learns from at most `max_rows` labelled documents of the training fold, and only from their texts. Null and
    empty texts are scored as texts without words. Repeated rows get equal rows; an empty table gives none. Without
    labels every score is one half; with one label only, near that label.
    """
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    table = settle(documents.select("doc_id", "text").mapInArrow(_feature_rows, f"doc_id {doc_type}, x array<double>"))
    rows = (table.join(F.broadcast(training_labels(labels.select("doc_id", "quality"), "quality", max_rows)), "doc_id")
            .dropDuplicates(["doc_id"]).sort("doc_id").select("x", "label").toArrow())  # max_rows at most
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    model = fit(x, rows.column("label").to_numpy().astype(float))
    scored = table.mapInArrow(_scores(model), f"doc_id {doc_type}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, limit: float = 0.3) -> DataFrame:
    """The documents that are not rejected (score at least `limit`), with all columns, whatever their names.

    Null and empty texts are scored like any other. Of rows that share a doc_id, also a null one, all go if any is rejected;
    repeated rows stay or go together. A score equal to the limit stays. An empty table gives an empty one.
    """
    bad = quality_scores(documents, labels, max_rows, limit).where("predicted = 0").select(F.col("doc_id").alias("_bad")).distinct()
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")
