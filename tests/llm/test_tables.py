"""Licenses, URL rules, top-k, packing and sharding: brute force, round trips and edge cases."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from eventmart.llm import licenses, mtree, packing, shards, urls
from eventmart.llm.queries import TOKENIZER

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_license_phrases_equal_brute_force(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
    texts = ["Released under the MIT License. under the mit license", "Apache License, Version 2.0", "CC BY-NC 4.0, cc by  nc", None, "", "nothing",
             "x " * 30000 + "under the mit license", mit + " files, the software, to deal in the said software without any restriction", "under the mit",
             "GNU General Public License"]
    docs = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)] + [(0, texts[0], "q"), (None, texts[1], "q")], "doc_id long, text string, labels string")
    rows, copies = licenses.license_scan(docs)
    got = rows.collect()
    assert len(got) == len(texts) + 2
    for r in got:
        words = ALNUM.findall((texts[r.doc_id] if r.doc_id is not None else texts[1] or "").lower()) if (r.doc_id is None or texts[r.doc_id]) else []
        places = {}
        for phrase, label in licenses.BASE_PHRASES:
            p = phrase.split()
            places.setdefault(label, []).extend(k for k in range(len(words)) if words[k:k + len(p)] == p)
        flat = [k for v in places.values() for k in v]
        assert (r.n_words, r.n_base) == (len(words), len(flat))
        assert (r.first_word, r.last_word) == ((min(flat), max(flat)) if flat else (None, None))
        assert r.base_labels == ",".join(sorted(k for k, v in places.items() if v))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1
    assert next(r for r in got if r.doc_id == 7).labels == "mit"
    assert copies.where("doc_id = 7").count() == 1
    assert licenses.license_scan(docs.limit(0))[0].count() == 0


def judged(url, rules, default):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, default)))


def test_url_rules_equal_brute_force(spark):
    rng = random.Random(1)
    hosts = ["com", "example.com", "www.example.com", "a.www.example.com", "xexample.com", "net", "a.net", "EXAMPLE.com", ""]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/", "/en/x/y?q=/fr/", "/fr/#a", "?/en/", "#"]
    made = [f"{rng.choice(['http', 'https', ''])}://{h}{p}" for h in hosts for p in paths]
    made += [None, "", "example.com/en/", "http://a.net/fr/" + "z" * 3000, "http://a.net/\n/fr/", "http://é.com/en/"] + ["http://a.net/es/same"] * 50
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(made)], "page_id long, url string, rule string")
    rules = urls.RULES + [("www.example.com", "/en/x/", "block"), ("com", "/en/x/y", "block"), ("a.net", "/es/same", "allow")]
    for own in (urls.RULES, rules):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, urls.rule_table(spark, own)).collect()}
        assert got == {i: judged(u, own, "allow") for i, u in enumerate(made)}
    empty = urls.rule_table(spark, urls.RULES).limit(0)
    assert {(r.rule, r.verdict) for r in urls.judge(pages, empty, "block").collect()} == {(None, "block")}
    assert urls.judge(pages.limit(0)).count() == 0


def test_url_rules_hold_in_every_range_of_a_hot_key(spark):
    made = ["http://a.com/"] * 400 + ["http://x.example.com/en/"] * 400 + [f"http://h{k}.org/es/" for k in range(400)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(made)], "page_id long, url string").repartition(8)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {i: judged(u, urls.RULES, "allow")[2:] for i, u in enumerate(made)}


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = np.round(rng.normal(size=(900, 8)), 2)
    vectors[100:160] = vectors[100]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(2000, None), (2100, []), (2200, [1.0, None]), (2300, [float("nan")] * 8), (2400, [float("inf")] * 8), (None, [0.5] * 8), (3000, [1.0, 2.0]), (3001, [2.0, 2.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    v = np.floor(1024 * vectors).astype(int)
    want = set()
    for q in range(0, 900, 100):
        scores = v @ v[q]
        order = [int(k) for k in np.lexsort((np.arange(900), -scores)) if k != q][:10]
        want |= {(q, n, k, int(scores[k])) for n, k in enumerate(order, 1)}
    want.add((3000, 1, 3001, 1024 * 2048 + 2048 * 2048))
    assert {tuple(r) for r in mtree.top_k(table).collect()} == want
    assert mtree.top_k(table.limit(0)).count() == 0


def test_tree_bounds_hold_and_save_work():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6)) * 2000
    v = np.concatenate([c + rng.normal(size=(200, 6)) * 20 for c in centres]).astype(int)
    largest = float((v * v).sum(axis=1).max())
    pages = mtree.build(mtree.lifted(v, largest), leaf=32)
    points = mtree.lifted(v, largest)
    for page in pages:
        if page["rows"] is not None:
            assert np.allclose(mtree.distances(points[page["rows"]], page["centre"]), page["away"])
            page["ids"], page["vectors"] = page["rows"], v[page["rows"]]
    tree, seen = mtree.Tree(pages), []
    plain = mtree._products
    mtree._products = lambda a, q: (seen.append(len(a)), plain(a, q))[1]
    try:
        for q in range(0, len(v), 150):
            got = tree.search(v[q], q, None, 10, largest)
            scores = v @ v[q]
            order = [int(k) for k in np.lexsort((np.arange(len(v)), -scores)) if k != q][:10]
            assert got == [(int(scores[k]), k) for k in order]
    finally:
        mtree._products = plain
    assert sum(seen) < 0.6 * len(v) * len(range(0, len(v), 150))


@pytest.mark.parametrize("sizes", [[], [1], [1024], [1025, 3], [700] * 9, [1, 2, 3, 5000, 1023, 512, 512, 90]])
def test_packing_holds_every_token_once(sizes):
    sequences = packing.pack(sizes)
    held = sorted((d, a, n) for s in sequences for d, a, n in s)
    assert all(n > 0 for _, _, n in held)
    for d, own in itertools.groupby(held, key=lambda p: p[0]):
        at = 0
        for _, a, n in own:
            assert a == at
            at += n
        assert at == sizes[d]
    assert {d for d, _, _ in held} == set(range(len(sizes)))
    lengths = [sum(p[2] for p in s) for s in sequences]
    assert all(n == 1024 or n & (n - 1) == 0 for n in lengths)


def test_first_fit_decreasing_takes_the_first_with_room():
    assert packing.first_fit_decreasing([500, 600, 400, 424, 100], 1024) == [[1, 3], [0, 2, 4]]


def test_packed_ids_equal_the_tokenizer(spark):
    texts = ["Hello world", None, "", "naïve 漢字 🙂\n\n  two  spaces ", "<|endoftext|> inside", "don't we'll 12345", "word " * 5000, "same", "same"]
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, start int")
    rows = packing.pack_documents(docs, TOKENIZER, group_docs=3, with_ids=True).collect()
    whole = Tokenizer.from_file(TOKENIZER)
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in own])
        assert ids.tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.doc_tokens == len(ids) for r in own)
    by = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    for _, group in itertools.groupby(by, key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
    assert packing.pack_documents(docs.limit(0), TOKENIZER).count() == 0


def greedy(sizes, capacity):
    out, used, at = [], 0, 0
    for s in sizes:
        if used + s > capacity:
            out.append(at)
            used = 0
        used += s
        at += s
    return [*out, at]


class FakeCells:
    """Cells as a query would give them, from a list of group sizes."""

    def __init__(self, sizes):
        ends = list(itertools.accumulate(sizes))
        self.groups = [(e - s, e) for s, e in zip(sizes, ends)]

    def __call__(self, _, width, stretches):
        cells = {}
        for s, e in self.groups:
            if any(s >= a and e <= b for a, b in stretches):
                low, high, n = cells.get(s // width, (s, e, 0))
                cells[s // width] = (min(s, low), max(e, high), n + 1)
        return sorted((s, e, n == 1) for s, e, n in cells.values())


@pytest.mark.parametrize("seed", range(40))
def test_capacity_is_the_smallest(monkeypatch, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 5, rng.randint(1, 300), rng.randint(1, 5000)]) for _ in range(rng.randint(1, 400))]
    if seed % 3 == 0:
        sizes[rng.randrange(len(sizes))] = sum(sizes) // 2 + 1
    monkeypatch.setattr(shards, "_read_cells", FakeCells(sizes))
    capacity, ends = shards.smallest_capacity(None, 16, sum(sizes), max(sizes), cells=rng.choice([8, 40, 4096]))
    cuts = greedy(sizes, capacity)
    assert len(cuts) <= 16 and (capacity == max(sizes) or len(greedy(sizes, capacity - 1)) > 16)
    assert ends[:len(cuts)] == cuts


def test_shards_of_awkward_rows(spark):
    rows = [(i, None if i % 7 == 0 else "hot text" if i % 3 == 0 else f"text {i} é" * (i % 40)) for i in range(300)] + [(None, "x"), (5, "dup"), (5, "dup")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    got = shards.shard_documents(docs).collect()
    assert len(got) == len(rows)
    assert sum(r["size"] for r in got) == sum(len((t or "").encode()) + 1 for _, t in rows)
    place = {}
    for r in got:
        assert 0 <= r.shard < 16 and r.law == "bytes" and r.grown_shard is None
        place.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(s) == 1 for s in place.values())
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards.shard_documents(docs.limit(0)).count() == 0


def test_long_runs_of_blanks_are_encoded():
    encode = packing.encoder(TOKENIZER)
    for run in (" " * 3_000_000, "\t" * 1_200_000, "\n " * 600_000):
        text = "x" + run + "y"
        assert encode.ids(text).tolist() == encode.whole.encode(text, add_special_tokens=False).ids


def test_equal_rows_and_rows_without_id_are_spread_over_groups(spark):
    docs = spark.createDataFrame([(1, "same text")] * 40 + [(None, "same text")] * 40, "doc_id long, text string").repartition(4)
    rows = packing.pack_documents(docs, TOKENIZER, group_docs=8).collect()
    for doc in (1, None):
        own = [r for r in rows if r.doc_id == doc]
        assert sum(r.length for r in own) == 40 * own[0].doc_tokens and len({r.sequence_id >> 32 for r in own}) > 3
