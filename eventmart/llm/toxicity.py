"""Toxicity by a learned lexicon, found through a trie intersected with a Levenshtein automaton.

1. Words, and stems that many different words share, which occur in toxic training documents and hardly elsewhere, become
   the lexicon's entries.
2. The lexicon's trie and the automaton of all strings within one edit are multiplied into one deterministic automaton
   over characters. It runs over all words of a batch at once, character by character; most words leave it after three.
3. Every match has a kind: exact or misspelled, and by the words around it, plain or quoted (inside quotation marks, or
   near words that report speech). Misspellings that clean training documents also hold are not counted.
4. A logistic model over a document's counts of each kind gives the score. Kinds that training never shows weigh as
   their nearest known kind, quoted ones nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm import words
from eventmart.llm.folds import MAX_ROWS, held_out, training_labels
from eventmart.llm.tables import settle

WINDOW = 6  # words on each side that tell quotation from abuse
PURITY = 0.9  # share of an entry's documents that are toxic, both classes given equal weight
VARIETY = 0.2  # different neighbours that an entry needs, for each of its documents
STEM, STEM_MAX = 4, 8  # characters of a stem; entries of at most STEM characters are matched exactly
STEM_WORDS = 4  # different words that share a stem

# Words that report or discuss what somebody said.
REPORTING = ["said", "says", "called", "wrote", "word", "words", "term", "quote", "quoted", "insult", "insults", "slur",
             "dijo", "dice", "palabra", "insulto", "dit", "mot", "insulte", "sagte", "wort", "schimpfwort"]
QUOTES = '"“”„«»'


# ---- automaton ------------------------------------------------------------------------------------

@dataclass
class Automaton:
    """table[state, class] -> state, 0 is dead and 1 the start; accept[state] -> match number, -1 for none.

    Classes are characters of the lexicon, 0 any other one, and the last one bytes inside a character, which keep the state.
    matches: entry number and edits of each match number; the one with fewest edits, then the longest entry.
    """

    table: np.ndarray
    accept: np.ndarray
    classes: dict[str, int]
    matches: list[tuple[int, int]]

    def symbols(self, low: np.ndarray) -> np.ndarray:
        """Class of each byte of UTF-8 text; a character's class stands at its first byte."""
        keep = self.table.shape[1] - 1
        of_byte = np.zeros(256, np.uint8)
        for c, k in self.classes.items():
            if ord(c) < 128:
                of_byte[ord(c)] = k
        of_byte[128:192] = keep
        out = of_byte[low]
        for c, k in self.classes.items():
            code = c.encode()
            if len(code) > 1:
                at = np.flatnonzero(low == code[0])
                for j, b in enumerate(code[1:], 1):
                    at = at[at + j < len(low)]
                    at = at[low[at + j] == b]
                out[at] = k
        return out

    def run(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that match, and their match numbers."""
        symbols = self.symbols(low)
        word = np.arange(len(start))
        at, state = start.copy(), np.ones(len(start), np.int32)
        found, number = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        stop = end
        while len(word):
            state = self.table[state, symbols[at]]
            at = at + 1
            done = at == stop
            match = done & (self.accept[state] >= 0)
            found.append(word[match])
            number.append(self.accept[state[match]])
            on = ~done & (state > 0)
            word, at, state, stop = word[on], at[on], state[on], stop[on]
        found, number = np.concatenate(found), np.concatenate(number)
        order = np.argsort(found, kind="stable")
        return found[order], number[order]


def compile_lexicon(entries: list[tuple[str, bool]], edits: int = 1) -> Automaton:
    """Automaton of all words within `edits` of an entry (text, is a stem, which any ending may follow).

    Entries of at most STEM characters are matched exactly: with an edit they are too near to other words.
    """
    children: list[dict[str, int]] = [{}]
    ends: list[list[int]] = [[]]
    for n, (entry, _) in enumerate(entries):
        node = 0
        for c in entry:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                ends.append([])
            node = children[node][c]
        ends[node].append(n)
    # entries below each node that may still be reached with an edit
    loose = [False] * len(children)
    for entry, _ in entries:
        node = 0
        for c in entry:
            loose[node] |= len(entry) > STEM
            node = children[node][c]
        loose[node] |= len(entry) > STEM
    alphabet = sorted({c for entry, _ in entries for c in entry})
    classes = {c: k for k, c in enumerate(alphabet, 1)}
    keep = len(alphabet) + 1

    # an item is (trie node, edits, done): done is the number of a stem already read, so that any ending goes
    def close(items: set) -> frozenset:
        todo, out = list(items), set(items)
        while todo:
            node, e, done = todo.pop()
            more = []
            if done is None:
                if e < edits:  # a character of the entry is missing
                    more += [(child, e + 1, None) for child in children[node].values() if loose[child]]
                more += [(node, e, n) for n in ends[node] if entries[n][1] and (e == 0 or len(entries[n][0]) > STEM)]
            for item in more:
                if item not in out:
                    out.add(item)
                    todo.append(item)
        return frozenset(out)

    def step(state: frozenset, c: str | None) -> frozenset:
        out = set()
        for node, e, done in state:
            if done is not None:
                out.add((node, e, done))
                continue
            if c in children[node] and (e == 0 or loose[children[node][c]]):
                out.add((children[node][c], e, None))
            if e < edits:
                out |= {(child, e + 1, None) for child in children[node].values() if loose[child]}
                if loose[node]:
                    out.add((node, e + 1, None))
        return close(out)

    def best(state: frozenset) -> tuple[int, int] | None:
        hits = [(e, -len(entries[n][0]), n) for node, e, done in state
                for n in ([done] if done is not None else ends[node]) if e == 0 or len(entries[n][0]) > STEM]
        return (min(hits)[2], min(hits)[0]) if hits else None

    start = close({(0, 0, None)}) if entries else frozenset()
    number, rows, matches, accept = {frozenset(): 0, start: 1}, [], [], []
    if not entries:
        number = {frozenset(): 0, frozenset([None]): 1}
    queue = [frozenset(), start]
    seen = 0
    while seen < len(queue):
        state = queue[seen]
        row = [0] * (keep + 1)
        for c, k in [*classes.items(), (None, 0)]:
            after = step(state, c) if entries else frozenset()
            if after not in number:
                number[after] = len(number)
                queue.append(after)
            row[k] = number[after]
        row[keep] = seen
        rows.append(row)
        hit = best(state) if entries else None
        if hit is not None and hit not in matches:
            matches.append(hit)
        accept.append(matches.index(hit) if hit is not None else -1)
        seen += 1
    return Automaton(np.array(rows, np.int32), np.array(accept, np.int64), classes, matches)


# ---- lexicon --------------------------------------------------------------------------------------

def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of labelled documents, counted by label."""
    for batch in batches:
        label = batch.column(1).to_numpy()
        for part in words.slices(batch.column(0)):
            if not len(part.start):
                continue
            hashes = part.hashes()
            _, at = np.unique(words.mix(hashes ^ words.mix(part.text.astype(np.uint64) + np.uint64(1))), return_index=True)
            toxic = label[part.first + part.text[at]]
            _, first, group = np.unique(hashes[at], return_index=True, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.word(at[k]) for k in first], pa.string()), pa.array(np.bincount(group, toxic).astype(np.int64)),
                 pa.array(np.bincount(group, 1 - toxic).astype(np.int64))], names=["word", "toxic", "clean"])


def _neighbours(candidates: Automaton):
    """Words that match a candidate exactly, with hashes of the words before and after (0 at a text's ends)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch.column(0)):
                at, _ = candidates.run(part.low, part.start, part.end)
                if not len(at):
                    continue
                hashes = part.hashes()
                inner = part.text[1:] == part.text[:-1]
                before, after = np.zeros(len(hashes), np.uint64), np.zeros(len(hashes), np.uint64)
                before[1:][inner], after[:-1][inner] = hashes[:-1][inner], hashes[1:][inner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.word(k) for k in at], pa.string()), pa.array(before[at].view(np.int64)),
                     pa.array(after[at].view(np.int64))], names=["word", "before", "after"])
    return run


def _beginnings(word: str = "word"):
    """A word's possible stems."""
    return F.explode(F.transform(F.sequence(F.lit(STEM), F.least(F.length(word) - 1, F.lit(STEM_MAX))),
                                 lambda n: F.substring(F.col(word), F.lit(1), n)))


def learn_lexicon(texts: DataFrame, purity: float = PURITY, variety: float = VARIETY) -> list[tuple[str, bool]]:
    """Entries (text, is a stem) from labelled documents (text, label).

    An entry's documents are toxic, and so many that chance would hardly make one such entry of all words tried. It also
    has to occur between as many different words, which a word from a group of copies does not.
    """
    texts = settle(texts.dropDuplicates(["text", "label"]))
    n_docs, n_toxic = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    n_clean = n_docs - n_toxic
    if not n_toxic or not n_clean:
        return []
    counts = settle(texts.mapInArrow(_document_words, "word string, toxic bigint, clean bigint")
                    .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    stems = settle(counts.where(F.length("word") > STEM).select(_beginnings().alias("word"), "toxic", "clean")
                   .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
                                        F.sum((F.col("toxic") > 0).cast("int")).alias("n_words")))
    tried = counts.count() + stems.count()
    needed = math.ceil(math.log(100 * tried) / math.log(n_docs / n_toxic))
    share = (F.col("toxic") / n_toxic) / (F.col("toxic") / n_toxic + F.col("clean") / n_clean)
    pure = (F.col("toxic") >= needed) & (share >= purity)
    # pure entries come from MAX_ROWS documents at most
    found = {(r.word, False): r.toxic for r in counts.where(pure & (F.length("word") >= 3)).collect()}
    found |= {(r.word, True): r.toxic for r in stems.where(pure & (F.col("n_words") >= STEM_WORDS)).collect()}
    candidates = compile_lexicon(sorted(found), edits=0)
    around = settle(texts.where("label = 1").select("text").mapInArrow(
        _neighbours(candidates), "word string, before bigint, after bigint").distinct())

    def varied(rows: DataFrame, stem: bool) -> dict:
        sides = rows.groupBy("word").agg(F.count_distinct("before").alias("b"), F.count_distinct("after").alias("a"))
        return {(r.word, stem): min(r.a, r.b) for r in sides.where((F.col("a") >= needed) & (F.col("b") >= needed)).collect()}

    seen = varied(around, False)
    seen |= varied(around.where(F.length("word") > STEM).select(_beginnings().alias("word"), "before", "after"), True)
    found = {k: n for k, n in found.items() if seen.get(k, 0) >= max(needed, variety * n)}
    # a stem is as long as it can be without losing documents
    chosen: list[str] = []
    stem_docs = {w: n for (w, stem), n in found.items() if stem}
    for stem in sorted(stem_docs, key=lambda s: (len(s), s)):
        if any(stem.startswith(c) for c in chosen):
            continue
        while longer := [s for s in stem_docs if len(s) == len(stem) + 1 and s.startswith(stem) and stem_docs[s] >= 0.98 * stem_docs[stem]]:
            stem = longer[0]
        if stem not in chosen:
            chosen.append(stem)
    plain = [w for (w, stem) in found if not stem and not any(w.startswith(c) for c in chosen)]
    return sorted([(s, True) for s in chosen] + [(w, False) for w in plain])


# ---- matches and score ----------------------------------------------------------------------------

KINDS = 4  # exact plain, misspelled plain, exact quoted, misspelled quoted


def _near(flag: np.ndarray, text: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Whether a flagged word lies within the window of word `at`, in the same text."""
    out = np.zeros(len(at), bool)
    for d in range(-window, window + 1):
        k = at + d
        ok = (k >= 0) & (k < len(text))
        k = np.where(ok, k, 0)
        out |= ok & flag[k] & (text[k] == text[at])
    return out


def find(part: words.Words, lexicon: Automaton, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words that match, their match numbers, and whether each stands in a quotation."""
    at, number = lexicon.run(part.low, part.start, part.end)
    if not len(at):
        return at, number, np.zeros(0, bool)
    # quotation marks before a match in its line: an odd number leaves one open
    raw = part.raw
    mark = raw == ord('"')
    for quote in QUOTES[1:]:
        code = quote.encode()
        first = np.flatnonzero(raw == code[0])
        first = first[first + len(code) <= len(raw)]
        for j, b in enumerate(code[1:], 1):
            first = first[raw[first + j] == b]
        mark[first] = True
    marks = np.concatenate(([0], np.cumsum(mark)))
    line = np.zeros(len(raw), np.int64)
    breaks = np.flatnonzero(raw == 10) + 1
    breaks = np.union1d(breaks[breaks < len(raw)], part.text_start[:-1][part.text_start[:-1] < len(raw)])
    line[breaks] = breaks
    line = np.maximum.accumulate(line)
    begin = line[part.start[at]]
    follows = np.searchsorted(breaks, part.start[at], "right")
    stop = np.append(breaks, len(raw))[follows]
    middle = (part.start[at] + part.end[at]) // 2  # a mark outside ASCII is part of the word it touches
    quoted = ((marks[middle] - marks[begin]) % 2 == 1) & (marks[stop] > marks[middle])
    report = np.zeros(len(part.start), bool)
    lo, hi = np.maximum(0, at - window), np.minimum(len(part.start), at + window + 1)
    for a, b in zip(lo, hi):
        for k in range(a, b):
            if part.end[k] - part.start[k] <= 12 and part.word(k) in _REPORTING:
                report[k] = True
    return at, number, quoted | _near(report, part.text, at, window)


_REPORTING = frozenset(REPORTING)


def _matches(lexicon: Automaton, window: int, with_label: bool):
    """Per document: its id, (label,) words and matches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch.column(1)):
                at, number, quoted = find(part, lexicon, window)
                bounds = np.searchsorted(part.text[at] if len(at) else at, np.arange(part.n_texts + 1)).astype(np.int32)
                code = pa.array(number * 2 + quoted, pa.int64())
                own = slice(part.first, part.first + part.n_texts)
                head = [batch.column(0)[own]] + ([batch.column(2)[own]] if with_label else [])
                yield pa.RecordBatch.from_arrays(
                    [*head, pa.array(part.counts(), pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), code)],
                    names=["doc_id", *(["label"] if with_label else []), "n_words", "matches"])
    return run


@dataclass
class Scorer:
    lexicon: Automaton
    counted: np.ndarray  # of each match number, whether it counts
    weights: np.ndarray  # the base, then for each kind one for its presence and one for its share of the words

    def inputs(self, n_words: np.ndarray, owner: np.ndarray, code: np.ndarray) -> np.ndarray:
        number, quoted = code >> 1, code & 1
        edits = np.array([e for _, e in self.lexicon.matches], np.int64)
        ok = self.counted[number] if len(number) else np.zeros(0, bool)
        kind = 2 * quoted + np.minimum(1, edits[number]) if len(number) else number
        counts = np.zeros((len(n_words), KINDS))
        np.add.at(counts, (owner[ok], kind[ok]), 1)
        rate = 100 * counts / np.maximum(n_words, 1)[:, None]
        return np.hstack([np.ones((len(n_words), 1)), counts > 0, np.log1p(rate)])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05, steps: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(lexicon: Automaton, n_words: np.ndarray, owner: np.ndarray, code: np.ndarray, y: np.ndarray, purity: float = PURITY) -> Scorer:
    """Weights of the kinds, from labelled documents' matches."""
    number = code >> 1
    counted = np.ones(len(lexicon.matches), bool)
    toxic, clean = max(1, y.sum()), max(1, (1 - y).sum())
    for k in range(len(lexicon.matches)):
        docs = np.unique(owner[number == k])
        t, c = y[docs].sum() / toxic, (1 - y[docs]).sum() / clean
        counted[k] = t + c == 0 or t / (t + c) >= purity
    scorer = Scorer(lexicon, counted, np.zeros(1 + 2 * KINDS))
    if not len(y) or y.min() == y.max():
        share = min(max(y.mean(), 1 / (len(y) + 2)), 1 - 1 / (len(y) + 2)) if len(y) else 0.5
        scorer.weights[0] = np.log(share / (1 - share))
        return scorer
    x = scorer.inputs(n_words, owner, code)
    w = _fit_logistic(x, y)
    shown = (x[:, 1:1 + KINDS] > 0).any(axis=0)
    if not shown[1]:  # no misspelling in training: as exact ones
        w[2], w[2 + KINDS] = w[1], w[1 + KINDS]
    scorer.weights = w
    return scorer


def _scores(scorer: Scorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("matches")
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            x = scorer.inputs(batch.column("n_words").to_numpy(), owner, lists.flatten().to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scorer.score(x)),
                                              pa.array(np.diff(lists.offsets.to_numpy()), pa.int64())],
                                             names=["doc_id", "score", "n_matches"])
    return run


def toxicity_scores(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, window: int = WINDOW) -> DataFrame:
    """doc_id, held_out, score, predicted, n_matches of every row of documents (doc_id, text; other columns are ignored).

    Lexicon and weights are learned from at most `max_rows` labelled documents of the training fold, from their texts only.
    Null and empty texts are scored as texts without matches. Repeated rows get equal rows; an empty table gives none.
    Without labels every score is one half; with one label only, near that label.
    """
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    sample = (documents.select("doc_id", "text")
              .join(F.broadcast(training_labels(labels.select("doc_id", "toxic"), "toxic", max_rows)), "doc_id")
              .dropDuplicates(["doc_id"]).select("doc_id", "text", F.col("label").cast("double").alias("label")))
    sample = settle(sample)
    lexicon = compile_lexicon(learn_lexicon(sample.select("text", "label")))
    rows = (sample.mapInArrow(_matches(lexicon, window, True), f"doc_id {doc_type}, label double, n_words bigint, matches array<bigint>")
            .select("label", "n_words", "matches").toArrow())  # max_rows at most
    lists = rows.column("matches").combine_chunks()
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    scorer = fit(lexicon, rows.column("n_words").to_numpy(), owner, lists.flatten().to_numpy(), rows.column("label").to_numpy())
    found = documents.select("doc_id", "text").mapInArrow(
        _matches(lexicon, window, False), f"doc_id {doc_type}, n_words bigint, matches array<bigint>")
    scored = found.mapInArrow(_scores(scorer), f"doc_id {doc_type}, score double, n_matches bigint")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_matches")
