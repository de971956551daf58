"""Near-duplicates, line dedup and decontamination against brute force, with empty, null, long and repeated rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from eventmart.llm import decontaminate, lines, links, neardup
from eventmart.llm import shingles as character

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n):
    w = WORD.findall(lowered(text))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def reach(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def copies(seed=3, groups=12):
    """Texts with exact copies, copies with a few other words, and chains in which only neighbours are similar."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([2, 5, 30, 120, 400]))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            other = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 40)):
                other[rng.randrange(len(other))] = rng.choice(words)
            out.append(" ".join(other))
            base = other if rng.random() < 0.5 else base
    return out


def test_near_duplicates_equal_brute_force(spark):
    texts = copies() + [None, "", " \t\n", "one", "One", "one two", "one two", "x " * 3000]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, texts[0]), (None, None)]
    docs = spark.createDataFrame([(i, t, "left", "right") for i, t in rows], "doc_id long, text string, node string, component string")
    sets = {i: shingles(t, 3) for i, t in enumerate(texts)}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = reach(sets, edges)
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_duplicates_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(docs).count() == 0


def test_rows_that_share_an_id_are_linked(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (5, "a b c d"), (5, "x y z q"), (7, "x y z q")], "doc_id long, text string")
    assert {r.component_id for r in neardup.near_duplicates(docs).collect()} == {1}


def test_one_document_of_a_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(3, text), (2, text), (2, text), (9, "other"), (None, text)], "doc_id long, text string")
    assert sorted((r.doc_id or -1) for r in neardup.without_copies(docs).collect()) == [-1, 2, 9]


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(1)
    for size, same in ((100, 90), (2000, 1600), (20000, 2000)):
        pool = np.unique(rng.integers(0, 2 ** 63, size=2 * size, dtype=np.uint64) * np.uint64(2))
        a, b = np.sort(pool[:size]), np.sort(pool[size - same:2 * size - same])
        true = same / (2 * size - same)
        assert abs(neardup.estimate(neardup.registers(a), neardup.registers(b), size, size) - true) < 0.2


@pytest.mark.parametrize("broadcast_rows", [links.BROADCAST_ROWS, 20])
def test_components_of_a_long_chain_and_a_star(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(links, "BROADCAST_ROWS", broadcast_rows)
    edges = [(k, k + 1) for k in range(100, 180)] + [(5, k) for k in range(6, 30)] + [(-4, 2), (2, 2)]
    got = {r.node: r.component for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = reach({x for e in edges for x in e}, edges)
    assert got == want


def test_guessed_sizes_do_not_grow_with_the_rounds(spark):
    edges = spark.range(400).selectExpr("id a", "id + 1 b")
    component = links.components(edges)
    size = str(component._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert component.count() == 401 and len(size) < 7


def test_prefix_pairs_lose_no_link(spark):
    rng = random.Random(5)
    sets = {}
    for n in range(60):
        base = sets[rng.choice(list(sets))] if sets and rng.random() < 0.8 else set(rng.sample(range(500), rng.randint(1, 60)))
        sets[n] = {x if rng.random() > 0.06 else rng.randrange(500) for x in base}
    nodes = spark.createDataFrame([(n, n) for n in sets], "node long, component long")
    elements = spark.createDataFrame([(n, x) for n, s in sets.items() for x in s], "node long, element long")
    got = {(r.a, r.b) for r in links.prefix_pairs(nodes, elements, 80).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert want <= got


def line_sets(line):
    k = lines.SHINGLE
    return {line[i:i + k] for i in range(max(1, len(line) - k + 1))}


def test_line_classes_equal_brute_force(spark):
    rng = random.Random(8)
    bases = ["".join(rng.choice("abcdefgh     ijklmnop") for _ in range(n)).strip() for n in (3, 20, 60, 90, 150, 400, 900)]
    texts = []
    for _ in range(40):
        own = []
        for _ in range(rng.randint(0, 4)):
            line = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 2])):
                line[rng.randrange(len(line))] = rng.choice("xyz")
            own.append("".join(line))
        texts.append("\n".join(own))
    texts += [None, "", "\n\n", "漢字" * 40, "漢字" * 39 + "漢", "no-blanks-" * 30, "no-blanks-" * 29 + "no-blinks-"]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, "x", 0)], "doc_id long, text string, line_no int")
    known = {(i, k): x.strip(" ") for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n")) if x.strip(" ")}
    distinct = sorted(set(known.values()))
    sets = {x: line_sets(x) for x in distinct}
    want = reach(distinct, [(a, b) for a in distinct for b in distinct if a < b
                            and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    got = {(r.doc_id, r.line_no): (r.component, r.kept) for r in lines.line_classes(docs).collect()}
    assert set(got) == set(known)
    groups, kept = {}, {}
    for at, line in known.items():
        groups.setdefault(got[at][0], set()).add(want[line])
        kept.setdefault(got[at][0], []).extend([at] if got[at][1] else [])
    # bands miss a pair of 0.8 once in 600, so a component may fall apart, but never joins what is not linked
    assert all(len(w) == 1 for w in groups.values())
    assert len(groups) <= 1.02 * len(set(want.values())) + 1
    assert all(len(k) == 1 for k in kept.values())


@pytest.mark.parametrize("size", [None, 40])
def test_shingles_equal_brute_force(monkeypatch, size):
    if size:
        monkeypatch.setattr(character, "SLICE_BYTES", size)
        monkeypatch.setattr(character, "PAIR_BYTES", 3 * size)
    rng = random.Random(1)
    texts = ["abc", "abcdefgh", "a" * 9, "漢字" * 5, "é漢a", "漢" * 8, "ab漢字cdefghé"]
    texts += ["".join(rng.choice("ab漢é ") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    found = {}
    for first, _, text, hashes in character.of_texts(pa.array(["", None, *texts]), lines.SHINGLE):
        for t, h in zip(*character.distinct(text, hashes), strict=True):
            found.setdefault(first + t, set()).add(int(h))
    assert [len(found[i + 2]) for i in range(len(texts))] == [len(line_sets(x)) for x in texts] and len(found) == len(texts)
    a, b = ([rng.choice(texts) for _ in range(5000)] for _ in range(2))
    want = [100 * len(line_sets(x) & line_sets(y)) >= 30 * len(line_sets(x) | line_sets(y)) for x, y in zip(a, b, strict=True)]
    assert character.similar(pa.array(a), pa.array(b), lines.SHINGLE, 30).tolist() == want
    assert not len(character.similar(pa.array([], pa.string()), pa.array([], pa.string()), lines.SHINGLE, 30))


@pytest.mark.parametrize("size", [None, 40])
def test_sketches_lose_no_similar_pair(monkeypatch, size):
    if size:
        monkeypatch.setattr(character, "SLICE_BYTES", size)
        monkeypatch.setattr(character, "PAIR_BYTES", 3 * size)
        monkeypatch.setattr(character, "SKETCH_BITS", 128)
    rng = random.Random(31)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop 漢é") for _ in range(n))
    a = [text(rng.choice([1, 7, 8, 60, 64, 75, 130, 260, 700, 2000])) for _ in range(400)]
    b = [x[:max(1, int(len(x) * rng.uniform(0.3, 1)))] + text(rng.choice([0, 0, 1, 9])) for x in a]
    a, b = a + a + ["x" * 9000, "xy" * 40], b + b[1:] + b[:1] + ["x" * 10, "yx" * 40]
    (size_a, of_a), (size_b, of_b) = (character.sketches(pa.array(["", *x])[1:], lines.SHINGLE) for x in (a, b))
    assert size_a.tolist() == [len(line_sets(x)) for x in a]
    left = 0
    for percent in (30, 80, 100):
        near = character.may_be_similar(of_a, of_b, size_a, size_b, percent)
        similar = character.similar(pa.array(a), pa.array(b), lines.SHINGLE, percent)
        assert similar.any() and not (similar & ~near).any()
        left += int(near.sum() - similar.sum())
    assert size or left < 0.1 * 3 * len(a)
    empty = character.sketches(pa.array([], pa.string()), lines.SHINGLE)
    assert not len(empty[0]) and not len(character.may_be_similar(empty[1], empty[1], empty[0], empty[0], 80))


def test_only_lines_that_may_be_similar_are_compared(spark, monkeypatch):
    """Lines made of the same few phrases meet in bands and by rare shingles, and few of those pairs are similar."""
    rng = random.Random(17)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    phrases = [text(60) for _ in range(8)]
    texts = ["#".join([*rng.sample(phrases, 6), text(40), "."]) for _ in range(120)]
    texts += [x[:-2] + "!." for x in texts[:20]]
    compared, plain = spark.sparkContext.accumulator(0), lines._linked

    def counted(percent):
        compare = plain(percent)

        def run(batches):
            for batch in batches:
                compared.add(batch.num_rows)
                yield from compare(iter([batch]))
        return run

    monkeypatch.setattr(lines, "_linked", counted)
    sets = [line_sets(x) for x in texts]
    links_ = [(a, b) for a in range(140) for b in range(a + 1, 140) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = reach(range(140), links_)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in lines.line_classes(docs).collect()}
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a in range(140) for b in range(140))
    assert len(links_) <= compared.value <= 3 * len(links_)


def test_links_in_large_buckets_equal_brute_force(spark):
    """Few centres see all of a large group whose members differ: what they leave apart is found by rare shingles."""
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefghijklmnop ") for _ in range(200)).strip()
    texts = set()
    while len(texts) < 60:
        x = list(base)
        for at in rng.sample(range(len(x)), rng.choice([1, 2, 2])):
            x[at] = rng.choice("XYZ")
        texts.add("".join(x).strip())
    texts = sorted(texts)
    sets = {x: line_sets(x) for x in texts}
    want = reach(texts, [(a, b) for a in texts for b in texts if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {texts[r.doc_id]: r.component for r in lines.line_classes(docs, 90).collect()}
    groups = {}
    for x in texts:
        groups.setdefault(got[x], set()).add(want[x])
    assert len(set(want.values())) == len(groups) and all(len(g) == 1 for g in groups.values())


def test_a_large_bucket_is_paired_with_a_few_centres(spark):
    members = spark.createDataFrame([(1, n) for n in range(100)] + [(2, n) for n in (3, 7, 9)], "bucket long, node long")
    pairs = {(r.a, r.b) for r in links.star_pairs(members, 4, 8).collect()}
    assert {(0, n) for n in range(1, 100)} | {(3, 7), (3, 9)} <= pairs and len(pairs) <= 2 + 4 * 99
    assert len({a for a, b in pairs} | {b for a, b in pairs}) == 100


def test_similar_lines_of_all_lengths_share_a_band(spark):
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n - 1)) + "e"
    pairs = [(x, x[:-1] + "#") for n in (20, 30, 40, 76, 95, 101, 120) for x in (text(n) for _ in range(60))]
    pairs += [(x * k, x * (k + 4)) for k in (9, 13) for x in (text(8) for _ in range(20))]  # few shingles, many times
    assert all(len(line_sets(a) & line_sets(b)) >= 0.8 * len(line_sets(a) | line_sets(b)) for a, b in pairs)
    docs = spark.createDataFrame([(2 * i + k, x) for i, pair in enumerate(pairs) for k, x in enumerate(pair)], "doc_id long, text string")
    component = {r.doc_id: r.component for r in lines.line_classes(docs).collect()}
    assert sum(component[2 * i] != component[2 * i + 1] for i in range(len(pairs))) <= 1


def test_recall_by_similarity(spark):
    """Pairs of two lines that are apart in all else: found, but for one in 200 at the limit and none above 0.85."""
    rng = random.Random(21)
    pairs = []
    while len(pairs) < 400:
        x = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rng.choice([60, 120, 240]))).strip() + "."
        y = list(x)
        for _ in range(rng.randint(1, 3)):
            y[rng.randrange(8, len(y) - 8)] = "#"
        y = "".join(y)
        share = len(line_sets(x) & line_sets(y)) / len(line_sets(x) | line_sets(y))
        if share >= 0.8:
            pairs.append((x, y, share))
    docs = spark.createDataFrame([(2 * i + k, p[k]) for i, p in enumerate(pairs) for k in (0, 1)], "doc_id long, text string")
    component = {r.doc_id: r.component for r in lines.line_classes(docs).collect()}
    missed = [p[2] for i, p in enumerate(pairs) if component[2 * i] != component[2 * i + 1]]
    assert len(missed) <= 2 and all(m < 0.85 for m in missed)


@pytest.mark.parametrize("names", [("_id", "_version", "_gone"), ("_row", "_left", "line")])
def test_columns_of_the_caller_do_not_clash(spark, names):
    docs = spark.createDataFrame([(1, "a line of text", 1, 2, 3), (2, "a line of text\nand one more", 4, 5, 6)],
                                 "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    got = sorted(tuple(r) for r in lines.without_copies(docs).collect())
    assert got == [(1, "a line of text", 1, 2, 3), (2, "and one more", 4, 5, 6)]


def test_lines_are_removed_and_empty_documents_go(spark):
    docs = spark.createDataFrame([(1, "a line of text\n\nanother one here", "en", 31), (2, "a line of text", "en", 14),
                                  (3, "a line of text\nown words", "en", 24), (4, "", "en", 0), (5, None, "en", None)],
                                 "doc_id long, text string, lang string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in lines.without_copies(docs).collect()}
    assert got == {1: ("a line of text\n\nanother one here", 31), 3: ("own words", 9), 4: ("", 0), 5: (None, None)}


def test_lines_of_another_text_with_the_same_id_stay(spark):
    rows = [(1, "a common line"), (5, "a common line\nfirst text only"), (5, "second text only\na common line"),
            (7, "one line of both\nown of the one"), (7, "one line of both\nown of the other"), (7, "one line of both\nown of the other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in lines.without_copies(docs).collect()]
    left = [x for _, t in got for x in t.split("\n")]
    assert sorted(set(left)) == sorted({x for _, t in rows for x in t.split("\n")})
    assert {(1, "a common line"), (5, "first text only"), (5, "second text only")} <= set(got)
    assert len({t for d, t in got if d == 7 and "one line of both" in t}) == 1  # one of the texts keeps it


def smith_waterman(a, b):
    best = 0
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def test_alignment_equals_the_plain_recurrence():
    rng = random.Random(2)
    for _ in range(30):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(1, 25))] for _ in range(2))
        assert decontaminate.align(np.array(a), np.array(b))[0] == smith_waterman(a, b)


def test_copies_of_test_items_are_found(spark):
    rng = random.Random(4)
    words = [f"v{k}" for k in range(800)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [text(n) for n in (40, 25, 12, 60, 3)]
    edited = list(items[3])
    for k in range(6, 60, 10):
        edited[k] = "changed"
    docs = [text(300) + items[0] + text(200), items[1], text(50) + edited + text(9), text(400), items[2][:5] + text(80), text(30) + items[4]]
    rows = [(i, " ".join(d).upper() if i == 1 else ", ".join(d), "n") for i, d in enumerate(docs)] + [(6, None, "n"), (7, "", "n"), (None, " ".join(items[0]), "n")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(9, None), (8, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(documents.union(documents), benchmark).collect()}
    assert set(got) == {(0, 0), (None, 0), (1, 1), (2, 3), (5, 4)}
    assert got[0, 0].score == 1 and (got[0, 0].first_word, got[0, 0].last_word) == (300, 339)
    assert 0.7 < got[2, 3].score < 1
    left = decontaminate.clean_documents(documents, benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 6, 7] and left.columns == documents.columns
    assert decontaminate.contaminated(documents, benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(documents.limit(0), benchmark).count() == 0


def test_copies_in_another_case_are_found_in_all_scripts(spark):
    items = ["Mañana será otra ocasión según él, así que volvió después", "Où étaient passés les élèves très âgés, à l'été déjà lointain",
             "Die Straße heißt außen größer als Öl und Übermut", "Ещё раз съешь этих мягких булок", "ο Οδυσσέας είναι σοφός και άλλος"]
    rows = [(10 * i + k, "x1 x2 " + change(t) + " x3") for i, t in enumerate(items)
            for k, change in enumerate([str, str.upper, str.title, str.lower, lambda t: t.upper().replace("SS", "ẞ")])]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.score, r.first_word) for r in decontaminate.contaminated(documents, benchmark).collect()}
    assert got == {(d, d // 10): (1.0, 2) for d, _ in rows}


def test_edited_copies_are_found_beside_exact_ones(spark):
    rng = random.Random(6)
    words = [f"v{k}" for k in range(60)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [text(n) for n in (3, 5, 6, 10, 15, 20, 31, 40)]
    docs = [text(20) + x + text(20) for x in items for _ in range(3)]
    for x in items:
        docs.append(text(9) + [w if k % 5 != 2 else "changed" for k, w in enumerate(x)] + text(9))
        for _ in range(6):
            y = list(x)
            for _ in range(rng.randint(1, 1 + 2 * len(x) // 5)):
                at = rng.randrange(len(y))
                y[at:at + rng.choice([0, 1, 1])] = rng.choice([[], ["other"], ["other"]])
            docs.append(text(30) + y + text(30))
    spread = []  # the words of the longest item two by two, the last four together
    for k, w in enumerate(items[7]):
        spread += [w] + (["other"] if k % 2 and k < 32 else [])
    docs += [spread, text(5) + spread]
    documents = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    best = {(d, i): smith_waterman(x, y) / len(y) for d, x in enumerate(docs) for i, y in enumerate(items)}
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(documents, benchmark).collect()}
    assert got == {k: v for k, v in best.items() if v >= 0.6}


def test_pieces_are_the_rarest():
    from itertools import combinations
    rng = random.Random(8)
    for _ in range(40):
        length = rng.randint(1, 9)
        places = [np.array([rng.randrange(9) for _ in range(max(0, length - n + 1))]) for n in range(1, 5)]
        every = [(at, n) for n in range(1, 5) for at in range(length - n + 1)]
        count = rng.randint(1, min(length, 4))
        apart = lambda some: all(x[0] + x[1] <= y[0] for x, y in zip(some, some[1:]))
        cost = lambda some: sum(places[n - 1][at] for at, n in some)
        got = decontaminate.rarest_pieces(places, count)
        assert len(got) == count and apart(got)
        assert cost(got) == min(cost(some) for some in combinations(sorted(every), count) if apart(some))


def test_long_items_have_enough_pieces():
    rng = np.random.default_rng(3)
    for length in (1, 3, 512, 513, 1700):
        places = [rng.integers(0, 50, max(0, length - n + 1)) for n in range(1, 5)]
        seeds = sorted(decontaminate.seeds_of(places, 0.6))
        assert len(seeds) >= decontaminate.most_edits(length, 0.6) + 1
        assert all(at + n <= length for at, n in seeds)


def test_frequent_runs_seed_nothing_where_rare_ones_can(spark):
    rng = random.Random(12)
    text = lambda n: [f"u{rng.randrange(3000)}" for _ in range(n)]
    common = ["it", "is", "the", "case", "that"]
    items = [text(8) + common + text(7) for _ in range(6)]
    docs = [text(20) + common + text(20) if k % 2 else text(40) for k in range(200)]
    for x in items:
        docs.append(text(20) + [w if k % 5 != 4 else "changed" for k, w in enumerate(x)] + text(20))
    documents = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents, benchmark).collect()}
    assert got == {(200 + i, i) for i in range(6)}
    places = [np.array([sum(" ".join(items[0][a:a + n]) in " ".join(d) for d in docs) for a in range(20 - n + 1)]) for n in range(1, 5)]
    assert max(places[n - 1][at] for at, n in decontaminate.seeds_of(places, 0.6)) < 100


def test_signs_and_scripts_without_blanks(spark):
    items = ["“Hello there,” said the old man… and left—quickly", "今天的天气非常好，我们一起去公园散步吧", "これは長い日本語の文章です、読んでください"]
    docs = ["x hello there said the old man and left quickly y", "前言。今天的天气非常好！我们一起去公园散步吧。后记", "はじめに「これは長い日本語の文章です、読んでください」おわり",
            "x “hello\u00a0there”, sa\u00adid ‘the’ old man, and left quickly", "一个完全不同的句子"]
    documents = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.score, r.first_word) for r in decontaminate.contaminated(documents, benchmark).collect()}
    assert got == {(0, 0): (1.0, 1), (3, 0): (1.0, 1), (1, 1): (1.0, 2), (2, 2): (1.0, 4)}


@pytest.mark.parametrize("n", [1, 3])
def test_run_hashes_agree_with_the_words(n):

    from eventmart.llm import words
    texts = ["a b c a b c", None, "", "a b c", "x" * 5000 + " a b c"]
    seen = {}
    for part in words.slices(pa.array(texts)):
        h = words.runs(part.hashes(), n)
        at = np.flatnonzero(words.inside(part.text, n))
        assert (words.runs_at(part.hashes(), at, n) == h[at]).all()
        for k in at:
            key = tuple(part.word(k + j) for j in range(n))
            assert seen.setdefault(key, h[k]) == h[k]
    assert len(set(seen.values())) == len(seen)
