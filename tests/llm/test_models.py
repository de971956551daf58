"""Quality and toxicity models: held-out accuracy, edge cases, and the parts they are made of."""

import random

import numpy as np
import pyarrow as pa
import pytest

from eventmart.llm import quality, toxicity, words

TABLES = "/root/testdata/sf0.01"


@pytest.mark.parametrize("scores,column,least", [(quality.quality_scores, "quality", 0.95), (toxicity.toxicity_scores, "toxic", 0.95)])
def test_held_out_accuracy(spark, scores, column, least):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    rows = scores(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", column).collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r[column] for r in rows]) >= least


@pytest.mark.parametrize("scores,column", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_edge_cases(spark, scores, column):
    rows = [(1, "some words of text", 0.1), (2, "", 0.2), (3, None, 0.3), (None, "no id", 0.4), (1, "some words of text", 0.1), (4, "long " * 20000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    none = spark.createDataFrame([], f"doc_id long, {column} int")
    got = scores(docs, none).collect()
    assert len(got) == len(rows) and all(r.score == 0.5 for r in got)
    one = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 1)], f"doc_id long, {column} int")
    assert all(0.5 < r.score <= 1 for r in scores(docs, one).collect())
    assert scores(docs.limit(0), one).count() == 0


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    a, b = ({r.doc_id: r.score for r in quality.quality_scores(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_boosting_learns_a_curve_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (3000, 3))
    y = ((np.abs(x[:, 0]) < 0.4) | ((x[:, 1] > 0) & (x[:, 2] > 0))).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    assert model.pairs
    assert np.mean((model.score(x[2000:]) >= 0.5) == y[2000:]) > 0.93


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(6)
    entries = [("idiot", False), ("worthless", False), ("scum", False), ("lowei", True), ("dümmer", False), ("idiom", False)]
    machine = toxicity.compile_lexicon(entries)
    seen = {e for e, _ in entries} | {"lowei" + x for x in ("a", "ung", "keiten")}
    for word in list(seen):
        for _ in range(60):
            k = rng.randrange(len(word))
            seen.add(rng.choice([word[:k] + word[k + 1:], word[:k] + rng.choice("aeioußz") + word[k:], word[:k] + rng.choice("äetx") + word[k + 1:]]))
    seen = sorted(w for w in seen if w)

    def best(word):
        out = []
        for n, (e, stem) in enumerate(entries):
            d = min(distance(word[:k], e) for k in range(len(word) + 1)) if stem else distance(word, e)
            if d == 0 or d == 1 and len(e) > toxicity.STEM:
                out.append((d, -len(e), n))
        return min(out)[0] if out else None

    for part in words.slices(pa.array([" ".join(seen)])):
        at, number = machine.run(part.low, part.start, part.end)
        got = {part.word(k): machine.matches[m][1] for k, m in zip(at, number)}
    assert got == {w: best(w) for w in seen if best(w) is not None}


def test_quotation_is_told_from_abuse():
    machine = toxicity.compile_lexicon([("idiot", False)])
    texts = ["you are an idiot and so on", 'the sign read "what an idiot" in red', "he called him an idiot twice", "„so ein idiot“ stand da",
             'an open " mark before idiot without end', "idiot"]
    found = {}
    for part in words.slices(pa.array(texts)):
        at, _, quoted = toxicity.find(part, machine)
        found |= {int(part.text[k]): bool(q) for k, q in zip(at, quoted)}
    assert found == {0: False, 1: True, 2: True, 3: True, 4: False, 5: False}


def test_rejected_documents_go_and_all_others_stay_as_they_are(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(None, "no id"), (-1, None), (-2, ""), (-3, "a"), (-3, "a")], "doc_id long, text string")
    wide = docs.select("doc_id", "text").unionByName(odd).selectExpr("*", "'x' AS _bad", "2 AS score", "'p' AS predicted")
    judged = {}
    for r in quality.quality_scores(wide, labels).collect():
        judged[r.doc_id] = judged.get(r.doc_id, True) and r.predicted == 1
    kept = quality.keep_good(wide, labels)
    assert kept.columns == wide.columns
    rows = lambda df: sorted((str(r.doc_id), str(r.text)) for r in df.collect())
    assert rows(kept) == [x for x in rows(wide) if judged[None if x[0] == "None" else int(x[0])]]
    assert 0 < kept.count() < wide.count()
    assert quality.keep_good(wide.limit(0), labels).count() == 0
