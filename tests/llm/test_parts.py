"""The filter audit, personal data and the prefix trie against brute force, on small tables with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from eventmart.llm import audit, pii, trie

DOCS = "doc_id long, text string, lang string, mask int, words string"
LABELS = "doc_id long, quality int, toxic int, part string"


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# -- filter audit

def brute_audit(docs, labels):
    good = {d for d, q, _, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, _ in labels if t == 1 and d is not None}
    least = {}
    for d, text, *_ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    rows = []
    for d, text, lang, *_ in docs:
        text = text or ""
        words = blank_words(text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": d is not None and d > least[text]}
        rows.append((lang or "", d, {f for f in fails if fails[f]}))
    out = {}
    for part in {r[0] for r in rows}:
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                all_f = [r for r in rows if r[0] == part and f in r[2]]
                gone, left = [r for r in left if f in r[2]], [r for r in left if f not in r[2]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(all_f) - len(gone), sum(r[2] == {f} for r in all_f),
                                                   sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def awkward_docs():
    draw = random.Random(3)
    long = " ".join(f"w{k}" for k in range(120))
    texts = [None, "", "a", long, long + " #", "SHOUT " * 130, "x y " * 300, long.upper(), "é" * 5000, "\x0b \t\n", "one | two", long + " z"]
    docs = [(draw.choice([None, *range(12)]) if k % 5 else k, draw.choice(texts), draw.choice(["en", "de", None, ""]), 7, "clash") for k in range(90)]
    docs += [(500 + k, long, "en", 0, "") for k in range(40)] + [(500, long, "en", 0, "")] * 3  # a group of copies, a repeated row
    labels = [(draw.choice([None, *range(12), 500, 501]), draw.choice([0, 1, None]), draw.choice([0, 1, None]), "p") for _ in range(30)]
    return docs, labels


def test_filter_audit_against_brute_force(spark):
    docs, labels = awkward_docs()
    got = audit.filter_audit(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)).collect()
    mine = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got}
    assert len(got) == len(mine) == 600 * 3
    assert mine == brute_audit(docs, labels)


def test_filter_audit_without_rows_or_labels(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.filter_audit(docs, labels).count() == 0
    rows = audit.filter_audit(spark.createDataFrame([(1, "a", "en", 0, "")], DOCS), labels).collect()
    assert len(rows) == 600 and {r.kept for r in rows if r.step == 5} == {0}


def test_walk_counts_every_subset():
    draw = np.random.default_rng(1)
    cells = draw.integers(0, 9, (3, 32, 2))
    states = audit.walk(cells)
    for subset in range(32):
        assert (states[subset] == cells[:, [m for m in range(32) if not m & subset]].sum(axis=1)).all()


# -- personal data

def brute_base(text):
    """The plain forms, by the patterns as they are stated."""
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]

    def card(digits):
        total = 0
        for k, d in enumerate(reversed(digits)):
            d = int(d) * (1 + k % 2)
            total += d - 9 if d > 9 else d
        return 12 <= len(digits) <= 19 and total % 10 == 0
    out += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if card(re.sub("[^0-9]", "", m.group()))]
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_against_the_stated_patterns():
    draw = random.Random(5)
    parts = ["a.b@c.d", "@", ".", "1.2.3.4", "0300.1.2.256", "4111111111111111", "4111 1111-1111 1111", "+1 (555) 010-9999", "+", " ", "  ", "-", "é", "x",
             "7", "00", "a@b", "a@b.", "@c.d", "1.2.3", "+4", "(", ")", "\n", "q%+-@x-.y", "6011 0000 0000 0004", "12.13.14.15.16.17.18.19"]
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert pii.base_spans(text) == brute_base(text), text
    for text in ("a" * 200_000, "1" * 200_000, "1 " * 200_000, "a@" * 100_000, "1." * 200_000, "+1" * 100_000, "(" * 200_000):
        assert len(pii.base_spans(text)) < 100_001  # and ends


def test_viterbi_finds_the_best_labels():
    draw = np.random.default_rng(2)
    field = pii.Field(draw.normal(size=(40, 3)).astype(np.float32), draw.normal(size=(3, 3)).astype(np.float32), draw.normal(size=3).astype(np.float32))
    sequences = [draw.integers(0, 40, (n, 2)) for n in (1, 2, 5, 4, 0, 3, 5)]

    def score(rows, labels):
        total = field.first[labels[0]] + sum(field.weights[r].sum(axis=0)[k] for r, k in zip(rows, labels))
        return total + sum(field.steps[a, b] for a, b in zip(labels, labels[1:]))
    for rows, found in zip(sequences, field.viterbi(sequences)):
        assert len(found) == len(rows)
        if len(rows):
            every = np.stack(np.meshgrid(*[range(3)] * len(rows)), -1).reshape(-1, len(rows))
            assert score(rows, found) == pytest.approx(max(score(rows, e) for e in every), abs=1e-4)


def test_gradient_is_that_of_the_log_likelihood():
    draw = np.random.default_rng(4)
    rows, gold, lengths = draw.integers(0, 6, (2, 4, 2)), draw.integers(0, 9, (2, 4)), np.array([4, 2])
    field = pii.Field(draw.normal(size=(6, 9)), draw.normal(size=(9, 9)), draw.normal(size=9))

    def loss():
        total = 0.0
        for r, g, n in zip(rows, gold, lengths):
            e = field.weights[r].sum(axis=1)
            score = lambda p: field.first[p[0]] + sum(e[t, p[t]] for t in range(n)) + sum(field.steps[p[t], p[t + 1]] for t in range(n - 1))  # noqa: E731, B023
            every = np.stack(np.meshgrid(*[range(9)] * n), -1).reshape(-1, n)
            total += np.log(sum(np.exp(score(p)) for p in every)) - score(g)
        return total
    _, pairs, first, _ = pii._gradients(field, rows, gold, lengths)
    for value, at, gradient in ((field.steps, (2, 5), pairs[2, 5]), (field.first, (3,), first[3]), (field.steps, (gold[0, 0], gold[0, 1]), pairs[gold[0, 0], gold[0, 1]])):
        before, low = value[at], None
        value[at] = before - 1e-4
        low = loss()
        value[at] = before + 1e-4
        assert (loss() - low) / 2e-4 == pytest.approx(gradient, rel=1e-2, abs=1e-3)
        value[at] = before


def test_field_on_lines_it_has_not_seen():
    lines = pii.labelled_lines(500, seed=99)
    found = pii.field_spans(pii.trained(), [t for t, _ in lines])
    right = sum(len(set(a) & set(b)) for a, (_, b) in zip(found, lines))
    assert right >= 0.97 * sum(map(len, found)) and right >= 0.9 * sum(len(s) for _, s in lines)


def test_personal_data_rows(spark):
    texts = [None, "", "nothing here, 2024-01-15 and 485701465.", "mail gtch.20@mail5.example.com now",
             "ring +1 (855) 555-4208 4866351201689520 an", "x " * 100_000 + " 10.0.0.1 " + "7 " * 100_000, "é 1.2.3.4"]
    docs = spark.createDataFrame([(k, t, "en", 0, "") for k, t in enumerate(texts)] + [(3, texts[3], "de", 1, "z")], DOCS)
    rows = pii.personal_data(docs.repartition(3)).collect()
    assert len(rows) == 8
    by_id = {r.doc_id: r for r in rows}
    for k, t in enumerate(texts):
        base = brute_base(t or "")
        r = by_id[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == x for s in base) for x in range(4)]
        written = [f"{pii.KINDS[x]}:{s}:{e}" for s, e, x in base]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(",")) | {""}
    assert by_id[0].spans == by_id[1].spans == by_id[2].spans == ""
    assert by_id[4].spans == "phone:5:22,card:23:39"  # neither is a base span: together they are too long a number
    assert pii.personal_data(spark.createDataFrame([], DOCS)).count() == 0


def test_clean_documents_stay_clean(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for d in docs.collect():
        base, r = brute_base(d.text or ""), rows[d.doc_id]
        assert bool(r.spans) >= bool(base)
        if not re.search("[0-9@]", d.text or ""):
            assert r.spans == ""


# -- the trie

def brute_trie(turns):
    rows = defaultdict(list)
    for c, turn, role, text, *_ in turns:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            rows[c].append((turn is not None, turn or 0, digest, role, text))
    original = {c: [(r, t) for *_, r, t in sorted(v, key=lambda x: x[:3])] for c, v in rows.items()}
    rebuilt = {}
    for c in original:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = original.get(c - c % 20, [])[:h] + original[c][h:]
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = Counter(n[:-1] for n in members if n)
    out = {}
    for node, convs in members.items():
        under = [n for n in members if n[:len(node)] == node]
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        out[min(convs), len(node)] = (
            min(members[node[:-1]]) if node else None, len(convs), kids[node], sum(not kids[n] for n in under),
            sum((len(members[n]) - 1) * len(blank_words(n[-1][1])) for n in under if n), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


TURNS = "conv_id long, turn long, role string, text string, depth int, last string"


def awkward_turns():
    draw = random.Random(11)
    turns = []
    for c in [*range(0, 45), *range(61, 140), 205, 206]:
        n = draw.choice([1, 1, 2, 3, 4, 6])
        turns += [(c, draw.choice([None, k, k]), draw.choice(["user", "", None]), draw.choice(["hello there", "a b c", "", None, f"own {c}"]), 1, "x") for k in range(n)]
    turns += [(c, k, "user", f"say {k}", 1, "") for c in range(300, 360) for k in range(5)]  # a common conversation
    turns += [(c, k, "user", f"say {k if k < 3 else c}", 1, "") for c in range(400, 430) for k in range(6)]  # and a common beginning
    turns += [(500, k, "user", f"long {k} " * 3, 1, "") for k in range(200)] + [(501, k, "user", f"long {k} " * 3, 1, "") for k in range(190)]
    return turns + [(None, 0, "user", "nobody", 1, ""), (7, 0, "user", "twice", 1, ""), (7, 0, "user", "twice", 1, "")]


@pytest.mark.parametrize("limits", [(2048, 16384, 32), (6, 40, 2)])
def test_trie_against_brute_force(spark, limits):
    turns = awkward_turns()
    got = trie.conversation_trie(spark.createDataFrame(turns, TURNS).repartition(6), *limits).collect()
    mine = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(mine) == len(got)
    assert mine == brute_trie(turns)


def test_trie_of_nothing(spark):
    assert trie.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert trie.conversation_trie(spark.createDataFrame([(None, 0, "user", "x", 1, "")], TURNS)).count() == 0


def test_ids_are_joined_in_runs(spark):
    paths = spark.createDataFrame([(k, b"p" if k % 3 else b"q") for k in range(-50, 400)], "conv_id long, last binary").repartition(5)
    got = {bytes(r.last): r.ends for r in trie.end_digests(paths, run_ids=7).collect()}
    for key, rest in ((b"p", (1, 2)), (b"q", (0,))):
        assert got[key] == hashlib.sha256(",".join(str(k) for k in range(-50, 400) if k % 3 in rest).encode()).hexdigest()
