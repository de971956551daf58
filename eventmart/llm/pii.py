"""Personal data by a linear-chain conditional random field over word-shape features, decoded by Viterbi in NumPy batches.

1. Patterns find the base spans: e-mail addresses, IP addresses, card numbers and phone numbers in their plain forms.
2. The field reads the stretches of a text around digits and at signs; each is a sequence of tokens (runs of letters, runs of
   digits, single signs). Its features are shapes (case and length of letters, number of digits, the sign itself, the gap before)
   of a token and its neighbours, hashed to a row of a weight table. Words themselves are features only where they name
   or spell out what they stand beside ("tel", "at", "dot").
3. It learns from a small labelled table: marked lines that `labelled_lines` makes by rule. Weights fit the log-likelihood,
   whose gradient comes from forward and backward sums, by AdaGrad. No document, label, source or id is an input.
4. Stretches of about equal length are decoded together. What the field finds is checked (digits of a phone, check digit of
   a card, ...) and joins the base spans where it meets none of them.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.tables import shared

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O"] + [f"{b}-{k}" for k in KINDS for b in "BI"]
LINES = 2_000  # of the labelled table
REACH = 40  # characters around a mark that its stretch holds at least
SLOTS = 1 << 15

# -- base spans

# The plain forms. Possessive runs give what greedy ones give here, without going back over long runs.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def luhn(digits: str) -> bool:
    """The check digit of a card number."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the plain forms, leftmost and without overlap within a kind, by start and then kind."""
    found = [(s, e, 0) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(map(_octet, m.groups())):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda f: (f[0], f[2]))


# -- the labelled table

_PATTERNS = {  # what a kind looks like: 0 stands for a digit, b for a number up to 255, L for a word
    "email": ["L.L@L.com", "L.00@L0.L.com", "L.00@L0.L.com", "L0@L.org", "L-L@L.L.net", "L_L@L.co.uk", "L.L @ L.com", "L.00 (at) L0.L.com",
              "L.L [at] L.org", "L (at) L (dot) com", "L.00 [at] L0 [dot] L [dot] com", "L.00 at L0 dot L dot com", "L.L@L dot com"],
    "ip": ["b.b.b.b", "b.b.b.b", "b.b.b.b", "b.b.b.b", "00.00.00.00", "b.b.0.0", "b . b . b . b", "b[.]b[.]b[.]b"],
    "card": ["0000000000000000", "0000000000000000", "0000000000000000", "0000 0000 0000 0000", "0000-0000-0000-0000", "0000 000000 00000", "0000.0000.0000.0000",
             "0000/0000/0000/0000", "0000_0000_0000_0000", "0000  0000  0000  0000"],
    "phone": ["+0 (000) 000-0000", "+0 (000) 000-0000", "+00 00 0000 0000", "+00 000 0000000", "+0-000-000-0000", "+00000000000", "+00.000.000.000",
              "(000) 000-0000", "000-000-0000", "000.000.0000", "(000) 000 0000", "0-000-000-0000", "+00/000/0000000", "00000 000000",
              "+00 (0) 00 0000 0000"],
}
_PLAIN = ["0", "00", "0000", "000000000", "00000", "0000-00-00", "00/00/0000", "00:00", "00:00:00", "0.0", "0.0.0", "v0.0.0", "$0,000.00", "00%", "00,000,000",
          "0000-0000", "0-0", "00-00", "(0)", "(0000)", "L0", "@L", "L@L", "@", "#0000", "no 0000", "aa0a0aa00a0aa", "AKIA0A0AA00AA", "a0-0a", "00th", "000.00",
          "0 000 000", "http://www.L.com/en/000", "L.com", "at 00:00", "at 0 dot", "000-00", "000-0-00-000000-0", "00x00", "0a0a0a00aa00a0a0", "page 00", "00 L 00",
          "= \"a0a0aa000aa00a\"", "0000.00.00", "00.0 - 00.0", "000000", "0000000", "0.00000000"]
_CUES = {"email": ["mail", "email:", "e-mail", "write to"], "ip": ["ip", "from", "host"], "card": ["card", "card no.", "visa", "pay with"],
         "phone": ["tel", "phone:", "call", "fax", "ring"]}


def labelled_lines(n: int = LINES, seed: int = 20240115) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Lines of invented words with numbers and personal data in them, and the spans (start, end, kind) of the latter."""
    draw = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzéäñç"

    def word() -> str:
        made = "".join(draw.choice(letters) for _ in range(draw.choice((1, 2, 3, 4, 5, 6, 8, 11))))
        return draw.choice((made, made, made, made.capitalize(), made.upper()))

    def fill(pattern: str) -> str:
        out = re.sub("0", lambda m: str(draw.randrange(10)), pattern)
        if pattern in _PATTERNS["ip"]:
            return re.sub("b", lambda m: str(draw.randrange(256)), out)
        return re.sub("L", lambda m: word().lower(), out)

    def value(kind: str) -> str:
        made = fill(draw.choice(_PATTERNS[kind]))
        if kind == "card":
            digits = _NOT_DIGIT.sub("", made)
            last = next(str(d) for d in range(10) if luhn(digits[:-1] + str(d)))
            made = made[:-1] + last
        return made

    def words(least: int, most: int) -> list[str]:
        return [word() + draw.choice(("", "", "", "", ",", ".")) for _ in range(draw.randint(least, most))]

    lines = []
    for _ in range(n):
        parts: list[tuple[str, int]] = [(w, -1) for w in words(0, 5)]
        for _ in range(draw.choice((0, 1, 1, 2, 3))):
            if draw.random() < 0.45:
                parts.append((fill(draw.choice(_PLAIN)), -1))
            else:
                kind = draw.randrange(len(KINDS))
                if draw.random() < 0.15:
                    parts.append((draw.choice(_CUES[KINDS[kind]]), -1))
                parts.append((value(KINDS[kind]), kind))
            if draw.random() < 0.6:
                parts += [(w, -1) for w in words(1, 4)]
        parts += [(w, -1) for w in words(0, 4)]
        text, spans = "", []
        for part, kind in parts:
            if kind >= 0:
                spans.append((len(text), len(text) + len(part), kind))
            text += part + draw.choice(("", "", "", ".", ",") if kind >= 0 else ("",)) + draw.choice((" ", " ", " ", " ", "\n"))
        lines.append((text, spans))
    return lines


# -- tokens and features

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
_NAMED = ("at", "dot", "tel", "phone", "fax", "call", "ring", "card", "visa", "ip", "host", "from", "mail", "email", "no", "com", "org", "net")
_NAMED_AT = {w: 100 + k for k, w in enumerate(_NAMED)}
_EDGE = 127  # the shape before and after a stretch


def _shape(token: str) -> int:
    """A number under 128: of a sign its own, of digits their number, of letters their case and length."""
    c = token[0]
    if "0" <= c <= "9":
        return 1 + min(len(token), 20)
    if c.isalpha():
        if token.lower() in _NAMED_AT:
            return _NAMED_AT[token.lower()]
        case = 0 if token.islower() else 1 if token[1:].islower() else 2
        return 22 + 4 * case + min(len(token), 4) - 1
    code = ord(c)
    return 34 + code - 33 if 33 <= code < 48 else 50 + code - 58 if 58 <= code < 65 else 58 + code - 91 if 91 <= code < 97 else 65 + code - 123 if 123 <= code < 127 else 70


def _features(tokens: list[tuple[str, int, int]]) -> np.ndarray:
    """Rows of the weight table for each token (text, start, end): one for each template."""
    shape = np.array([_shape(t) for t, _, _ in tokens])
    start, end = np.array([t[1] for t in tokens]), np.array([t[2] for t in tokens])
    gap = np.ones(len(tokens), np.int64)
    gap[1:] = np.minimum(start[1:] - end[:-1], 2)
    small = np.array([t[0].isdigit() and len(t[0]) <= 3 and int(t[0]) <= 255 for t in tokens], np.int64)
    padded = np.full(len(tokens) + 8, _EDGE * 4, np.int64)
    padded[4:-4] = shape * 4 + gap
    c = {k: padded[4 + k:4 + k + len(tokens)] for k in range(-4, 5)}  # a token's shape and the gap before it
    s = {k: c[k] >> 2 for k in c}  # its shape alone
    templates = [(s[0],), (s[-1], s[0], s[1]), (s[0], s[1], s[2], s[3]), (c[0],), (s[-1], c[0]), (c[0], c[1]), (s[-1], c[0], c[1]), (c[0], c[1], c[2]), (s[-2], c[-1], c[0]), (small, c[0], c[1]),
                 (s[-2], c[-1], c[0], c[1]), (s[-3], c[-2], c[-1], c[0]), (c[0], c[1], c[2], c[3]), (s[-2], c[-1], c[0], c[1], c[2]),
                 (s[-4], c[-3], c[-2], c[-1], c[0])]
    out = np.empty((len(tokens), len(templates)), np.int64)
    for k, parts in enumerate(templates):
        code = np.full(len(tokens), k + 1, np.uint64)
        for part in parts:
            code = (code * np.uint64(0x9E3779B97F4A7C15)) ^ part.astype(np.uint64)
            code ^= code >> np.uint64(29)
        out[:, k] = (code * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - SLOTS.bit_length() + 1)
    return out


def tokens_of(text: str, low: int = 0, high: int | None = None) -> list[tuple[str, int, int]]:
    return [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(text, low, len(text) if high is None else high)]


_MARK = re.compile(r"[0-9@]|[\[(]at[\])]")


def stretches(text: str, reach: int = REACH) -> list[tuple[int, int]]:
    """Parts of the text around its marks, at least `reach` characters to either side and up to a blank, but not further
    than twice that. Parts that touch are one."""
    out: list[list[int]] = []
    at = 0
    while m := _MARK.search(text, at):
        low, high = max(0, m.start() - reach), min(len(text), m.end() + reach)
        stop = max(0, low - reach)
        while low > stop and not text[low - 1].isspace():
            low -= 1
        stop = min(len(text), high + reach)
        while high < stop and not text[high].isspace():
            high += 1
        if out and low <= out[-1][1]:
            out[-1][1] = high
        else:
            out.append([low, high])
        # all marks but the last one within reach say the same
        last = max(text.rfind(d, m.end(), min(len(text), m.end() + reach)) for d in "0123456789@")
        at = last if last > m.start() else m.end()
    return [(a, b) for a, b in out]


# -- the field

@dataclass
class Field:
    weights: np.ndarray  # by feature slot and label
    steps: np.ndarray  # from label to label
    first: np.ndarray

    def viterbi(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each sequence of feature rows. Sequences of about equal length are decoded together."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = sorted((k for k in range(len(sequences)) if len(sequences[k])), key=lambda k: len(sequences[k]))
        at = 0
        while at < len(order):
            longest = len(sequences[order[at]])
            to = at
            while to < len(order) and len(sequences[order[to]]) <= longest + longest // 4 + 4 and (to - at + 1) * len(sequences[order[to]]) <= 65_536:
                to += 1
            to = max(to, at + 1)
            for k, labels in zip(order[at:to], self._decode([sequences[k] for k in order[at:to]])):
                out[k] = labels
            at = to
        return out

    def _decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        lengths = np.array([len(s) for s in sequences])
        n, longest, n_labels = len(sequences), int(lengths.max()), len(self.first)
        emitted = np.zeros((longest, n, n_labels), np.float32)
        for k, s in enumerate(sequences):
            for low in range(0, len(s), 16_384):
                emitted[low:low + 16_384, k][:len(s) - low] = self.weights[s[low:low + 16_384]].sum(axis=1)
        back = np.zeros((longest, n, n_labels), np.int8)
        score = self.first + emitted[0]
        last = score.copy()
        for t in range(1, longest):
            paths = score[:, :, None] + self.steps
            back[t] = paths.argmax(axis=1)
            score = paths.max(axis=1) + emitted[t]
            going = lengths > t
            last[going] = score[going]
        labels, label = np.zeros((longest, n), np.int64), last.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            labels[t] = label
            going = np.flatnonzero(lengths > t)
            label[going] = back[t][going, label[going]]
        return [labels[:length, k] for k, length in enumerate(lengths)]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)


def _gradients(field: Field, rows: np.ndarray, gold: np.ndarray, lengths: np.ndarray):
    """Expected minus seen features of a batch: for each token and label, for steps and for first labels."""
    n, longest = gold.shape
    e = field.weights[rows].sum(axis=2)  # by sequence, place, label
    ahead, behind = np.empty_like(e), np.zeros_like(e)
    ahead[:, 0] = field.first + e[:, 0]
    for t in range(1, longest):
        ahead[:, t] = _log_sum(ahead[:, t - 1][:, :, None] + field.steps, 1) + e[:, t]
    for t in range(longest - 2, -1, -1):
        inner = _log_sum(field.steps + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where((lengths > t + 1)[:, None], inner, 0)
    total = _log_sum(ahead[np.arange(n), lengths - 1], 1)
    valid = np.arange(longest) < lengths[:, None]
    at_label = np.exp(ahead + behind - total[:, None, None]) * valid[:, :, None]
    both = ahead[:, :-1, :, None] + field.steps + (e[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
    pairs = (np.exp(np.minimum(both, 0)) * valid[:, 1:, None, None]).sum(axis=(0, 1))
    seen = (gold[:, :, None] == np.arange(e.shape[2])) & valid[:, :, None]
    seen_pairs = np.zeros_like(pairs)
    np.add.at(seen_pairs, (gold[:, :-1][valid[:, 1:]], gold[:, 1:][valid[:, 1:]]), 1)
    return at_label - seen, pairs - seen_pairs, (at_label - seen)[:, 0].sum(axis=0), valid


def labels_of(tokens: list[tuple[str, int, int]], spans: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(len(tokens), np.int64)
    for start, end, kind in spans:
        inside = [k for k, (_, s, e) in enumerate(tokens) if s >= start and e <= end]
        out[inside] = 2 + 2 * kind
        out[inside[:1]] = 1 + 2 * kind
    return out


def fit(lines: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 10, rate: float = 0.3, batch: int = 64, decay: float = 1e-4) -> Field:
    """AdaGrad on the log-likelihood of the marked lines. Without lines, a field that finds nothing."""
    n_labels = len(LABELS)
    field = Field(np.zeros((SLOTS, n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels))
    # what may not follow: the inside of a kind after anything but that kind
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        field.steps[[k for k in range(n_labels) if k not in (inside - 1, inside)], inside] = -1e4
        field.first[inside] = -1e4
    free_steps, free_first = field.steps > -1e3, field.first > -1e3
    data = [(_features(t), labels_of(t, spans)) for t, spans in ((tokens_of(text), spans) for text, spans in lines) if t]
    data.sort(key=lambda d: len(d[1]))
    sums = [np.full_like(a, 1e-6) for a in (field.weights, field.steps, field.first)]
    starts = list(range(0, len(data), batch))
    draw = random.Random(7)
    for _ in range(rounds):
        draw.shuffle(starts)
        for low in starts:
            part = data[low:low + batch]
            lengths = np.array([len(g) for _, g in part])
            rows = np.zeros((len(part), int(lengths.max()), part[0][0].shape[1]), np.int64)
            gold = np.zeros(rows.shape[:2], np.int64)
            for k, (r, g) in enumerate(part):
                rows[k, :len(g)], gold[k, :len(g)] = r, g
            at_label, pairs, first, valid = _gradients(field, rows, gold, lengths)
            used, where = np.unique(rows[valid], return_inverse=True)
            flat = np.repeat(at_label[valid], rows.shape[2], axis=0)
            g = np.stack([np.bincount(where.ravel(), flat[:, k], len(used)) for k in range(n_labels)], axis=1) + decay * field.weights[used]
            sums[0][used] += g * g
            field.weights[used] -= rate * g / np.sqrt(sums[0][used])
            for value, grad, total, free in ((field.steps, pairs, sums[1], free_steps), (field.first, first, sums[2], free_first)):
                grad = np.where(free, grad, 0)
                total += grad * grad
                value -= rate * grad / np.sqrt(total)
    return Field(field.weights.astype(np.float32), field.steps.astype(np.float32), field.first.astype(np.float32))


@lru_cache(maxsize=2)
def trained(n_lines: int = LINES) -> Field:
    return fit(labelled_lines(n_lines))


# -- spans

_NAME_FORM = re.compile(r"[^\s@]+\s?(?:@|[\[(]?\bat\b[\])]?)\s?\S*[^\W\d_].*(?:\.|\bdot\b[\])]?\s?)\s?[A-Za-z0-9-]{2,}", re.DOTALL)


def plausible(found: str, kind: int) -> bool:
    """The check of what the field finds."""
    digits = _NOT_DIGIT.sub("", found)
    if kind == 0:
        return len(found) <= 320 and _NAME_FORM.fullmatch(found) is not None
    if kind == 1:
        parts = _NOT_DIGIT.split(found)
        return len(parts) == 4 and all(p and _octet(p) for p in parts)
    if kind == 2:
        return 12 <= len(digits) <= 19 and len(found) <= 3 * len(digits) and luhn(digits)
    return (9 if found[0] == "+" else 10) <= len(digits) <= 15 and len(found) <= 3 * len(digits)


def field_spans(field: Field, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, end, kind) of what the field finds in each text and passes its check."""
    places, tokens = [], []
    for k, text in enumerate(texts):
        for low, high in stretches(text):
            part = tokens_of(text, low, high)
            if part:
                places.append(k)
                tokens.append(part)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    best = field.viterbi([_features(t) for t in tokens])
    for k, part, labels in zip(places, tokens, best):
        at = 0
        labels = labels.tolist()
        while at < len(labels):
            label, to = labels[at], at + 1
            if label:
                kind = (label - 1) // 2
                while to < len(labels) and labels[to] == 2 + 2 * kind:
                    to += 1
                span = part[at][1], part[to - 1][2]
                if plausible(texts[k][span[0]:span[1]], kind):
                    out[k].append((*span, kind))
            at = to
    return out


def all_spans(base: list[tuple[int, int, int]], added: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans, and of the others those that meet none of them."""
    kept = list(base)
    reach, k = 0, 0
    for span in sorted(added):
        while k < len(base) and base[k][0] < span[1]:
            reach = max(reach, base[k][1])
            k += 1
        if reach <= span[0] or not any(b[0] < span[1] and span[0] < b[1] for b in base[:k]):
            kept.append(span)
    return sorted(kept, key=lambda f: (f[0], f[2]))


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def _scan(field, batch_chars: int = 1 << 21):
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, low = batch.num_rows, 0
            size = np.cumsum(batch.column("size").to_numpy())
            while low < rows:  # about batch_chars at a time, or one long text
                before = size[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(size, before + batch_chars, "right")))
                texts = [t or "" for t in batch.column("text")[low:high].to_pylist()]
                base = [base_spans(t) for t in texts]
                spans = [all_spans(b, f) for b, f in zip(base, field_spans(field.value, texts))]
                counts = [pa.array([sum(s[2] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[low:high], *counts,
                     pa.array([hashlib.sha256(_written(b).encode()).hexdigest() for b in base], pa.string()),
                     pa.array([_written(s) for s in spans], pa.string())], names=names)
                low = high
    return run


def personal_data(documents: DataFrame, n_lines: int = LINES) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 (of the base spans as text), spans (all of them, as
    kind:start:end in code points, by start and kind, joined by commas): a row for each row of documents.

    documents: doc_id, text; other columns are ignored, whatever their names. A null or empty text has no spans. Repeated
    rows get equal rows; an empty table gives none. Spans of two kinds may overlap where both are base spans. n_lines: of
    the labelled table the field learns from.
    """
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return (documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .select("doc_id", "text", (F.length("text") + 1).cast("long").alias("size"))
            .mapInArrow(_scan(shared(documents.sparkSession, trained(n_lines))),
                        f"doc_id {doc_type}, {counts}, base_sha256 string, spans string"))
