"""Quality classifier, language ID and toxicity: held-out accuracy and awkward rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mailposture.llm import common, language_id, ordinal_quality, toxicity
from tests.llm.fixtures import SCHEMA, documents, prose


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).cache()


def test_ordinal_model_orders_grades(spark):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        grade = i % 3
        text = prose(rng, "en", 80)
        text = text.upper() + " ###!!" * 20 if grade == 0 else text + " $$" * 4 if grade == 1 else text
        rows.append((i, text, grade))
    rated = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = ordinal_quality.fit(rated.filter("doc_id % 4 < 3"))
    assert (np.diff(model.thresholds) > 0).all()
    out = ordinal_quality.score(rated.filter("doc_id % 4 = 3"), model).collect()
    mean = {g: np.mean([r.expected_grade for r in out if r.grade == g]) for g in range(3)}
    assert mean[0] < mean[1] < mean[2]
    assert np.mean([r.kept == (r.grade >= 1) for r in out]) > 0.9
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in out)


def test_ordinal_model_on_awkward_rows(spark, docs):
    with pytest.raises(ValueError, match="prefix"):
        ordinal_quality.score(docs.withColumn("kept", F.lit(1)), ordinal_quality.OrdinalModel(np.zeros(1 << ordinal_quality.BITS), np.zeros((5, 16)), np.zeros(1)))
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(60)] + [(None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    model = ordinal_quality.fit(ordinal_quality.graded(docs, labels))
    out = ordinal_quality.score(docs.withColumn("kept", F.lit("mine")), model, prefix="q_").collect()
    assert len(out) == docs.count() and all(r.kept == "mine" and r.q_kept is not None for r in out)
    twins = {r.q_tail_probability for r in out if r.doc_id == 7}
    assert len(twins) == 1
    empty = ordinal_quality.fit(ordinal_quality.graded(docs, labels.limit(0)))
    assert all(r.kept for r in ordinal_quality.score(docs, empty).collect())
    assert ordinal_quality.score(docs.limit(0), model).count() == 0


def test_scores_do_not_depend_on_windows(spark, monkeypatch):
    import pyarrow as pa

    from mailposture.llm import common

    rng = random.Random(2)
    texts = pa.array([prose(rng, "fr", n) for n in (1, 5, 3000, 2)] + [None, "", "ab"])
    weights = np.random.default_rng(0).normal(size=(1 << 12, 3))
    whole = common.gram_means(texts, weights, (1, 2, 4), 12)
    monkeypatch.setattr(common, "WINDOW", 257)
    assert np.allclose(whole, common.gram_means(texts, weights, (1, 2, 4), 12), atol=1e-12)
    # Brute force: the mean over the runs of one text.
    for row, text in zip(whole, texts.to_pylist(), strict=True):
        at, share = common.gram_counts((text or "").encode(), (1, 2, 4), 12)
        assert np.allclose(row, share @ weights[at] if len(at) else 0, atol=1e-5)


def test_language_probabilities_by_plain_means():
    """A text is the mean of its subwords' vectors, the softmax is linear in it, the temperature divides."""
    rng = np.random.default_rng(3)
    weights = rng.normal(size=(1 << language_id.BITS, 3))
    model = language_id.LanguageModel(["a", "b", "c"], weights, rng.normal(size=3), 1.7)
    texts = ["Ein kurzer Text", "ÉTÉ", "x", "", None, "many words " * 500]
    got = model.probabilities(pa.array(texts))
    for text, row in zip(texts, got, strict=True):
        at, share = common.gram_counts((text or "").lower().encode(), language_id.SIZES, language_id.BITS)
        z = ((share @ weights[at] if len(at) else np.zeros(3)) + model.bias) / 1.7
        assert np.allclose(row, np.exp(z) / np.exp(z).sum(), atol=1e-5)


def test_language_id(spark, docs):
    known = docs.filter("doc_id < 1000")
    model = language_id.fit(known.filter("doc_id % 3 <> 1"))
    held = language_id.predict(known.filter("doc_id % 3 = 1").drop("score"), model).collect()
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.9
    out = {r.doc_id: r for r in language_id.predict(docs, model, prefix="p_").collect()}
    assert {out[i].p_lang_pred for i in (1000, 1001, 1002, 1003)} == {"und"}
    assert all(out[i].p_score == 0 and out[i].p_rejected for i in (1000, 1003))
    assert out[1006].p_lang_pred in model.languages and out[1004].p_lang_pred == "en"
    assert out[0].score == 0.5  # the column of the input
    with pytest.raises(ValueError, match="prefix"):
        language_id.predict(docs, model)
    none = language_id.fit(docs.limit(0))
    assert {r.p_lang_pred for r in language_id.predict(docs, none, prefix="p_").collect()} == {"und"}


def distance(a, b):
    """Plain edit distance with swaps of neighbours."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_like_plain_distances():
    terms = ["idiot", "pathetic", "disgusting", "scum", "moron"]
    matcher = toxicity.Matcher(terms)
    rng = random.Random(9)
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(word) + 1)
            op = rng.randrange(4)
            if op == 0:
                word.insert(k, rng.choice("abcdiot"))
            elif op == 1 and word:
                word.pop(min(k, len(word) - 1))
            elif op == 2 and word:
                word[min(k, len(word) - 1)] = rng.choice("abcdiot")
            elif len(word) > 1:
                k = min(k, len(word) - 2)
                word[k], word[k + 1] = word[k + 1], word[k]
        w = "".join(word)
        exact = [t for t in terms if w.startswith(t)]
        near = [min(distance(w[:n], t) for n in range(max(0, len(w) - toxicity.TAIL), len(w) + 1)) for t in terms]
        best = min((d for d, t in zip(near, terms, strict=True) if d <= toxicity.allowed_edits(t)), default=None)
        got = matcher.match(w)
        if exact:
            assert got[1] == 0 and terms[got[0]] == max(exact, key=len)
        else:
            assert (got and got[1]) == best, w


def test_samples_are_bounded_under_repeated_ids(spark, docs):
    """100,000 rows of one id, of one text or of many: samples stay bounded, choices do not depend on the order."""
    many = spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.pmod("id", F.lit(50_000))).alias("text"), F.lit("en").alias("lang"))
    few = common.bounded_sample(many, "doc_id", "lang", 100, "text").collect()
    assert 40 < len(few) < 200 and len({r.text for r in few}) == len(few)
    assert sorted(few) == sorted(common.bounded_sample(many.repartition(7), "doc_id", "lang", 100, "text").collect())
    same = common.bounded_sample(many.withColumn("text", F.lit("one")), "doc_id", "lang", 200_000, "text", most_rows=200_000)
    assert same.count() == 1
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    both = many.drop("lang").union(spark.createDataFrame([(2, "two")], "doc_id long, text string"))
    graded = [tuple(r) for r in ordinal_quality.graded(both, labels).select("doc_id", "grade", "text").collect()]
    toxic = [tuple(r) for r in toxicity.sampled(both, labels).select("doc_id", "toxic", "text").collect()]
    assert sorted(r[:2] for r in graded) == [(1, 0), (2, 2)] and sorted(r[:2] for r in toxic) == [(1, 1), (2, 0)]
    assert sorted(graded) == sorted(tuple(r) for r in ordinal_quality.graded(both.repartition(5), labels.repartition(3)).select("doc_id", "grade", "text").collect())


def test_many_groups(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "en").otherwise(F.concat(F.lit("x"), "id")).alias("lang"))
    langs = {r.lang for r in common.bounded_sample(rows, "doc_id", "lang", 50, most_groups=3).collect()}
    assert "en" in langs and langs <= {"en", "x2000", "x2001"}


def test_ordinal_likelihood_by_plain_gradient():
    """Tails are those of the definition, and the fit's likelihood cannot be bettered by moving a threshold."""
    rng = np.random.default_rng(1)
    model = ordinal_quality.OrdinalModel(rng.normal(size=1 << ordinal_quality.BITS), rng.normal(size=(5, 16)), np.array([-0.5, 0.7]))
    texts = ["some words here", "", None, "Other, other!! text " * 30]
    tails = model.tails(pa.array(texts))
    for text, row in zip(texts, tails, strict=True):
        at, share = common.gram_counts((text or "").encode(), ordinal_quality.SIZES, ordinal_quality.BITS)
        x = ordinal_quality.RUNS_BOUND * math.tanh(float(share @ model.runs[at] if len(at) else 0) * ordinal_quality.SCALE / ordinal_quality.RUNS_BOUND)
        x += sum(model.shape[k, level] for k, level in enumerate(ordinal_quality.shape_levels(pa.array([text or ""]))[0]))
        assert np.allclose(row, [1 / (1 + math.exp(t - x)) for t in model.thresholds], atol=1e-4)


def test_fractional_grades_are_cut(spark):
    rows = [(i, "plain words of a text " * 5 if i % 2 else "#### $$$$ " * 20, 0.0 + i % 2 + 0.4) for i in range(60)] + [(99, "x", None), (98, "x", float("nan"))]
    model = ordinal_quality.fit(spark.createDataFrame(rows, "doc_id long, text string, grade double"))
    assert len(model.thresholds) == 1
    out = {r.doc_id: r.expected_grade for r in ordinal_quality.score(spark.createDataFrame(rows, "doc_id long, text string, grade double"), model).collect()}
    assert out[1] > 0.8 and out[0] < 0.2


def test_quotations_of_any_length():
    long = "word " * 1000
    assert toxicity.quotations(f'a "{long}" b') == [(2, 2 + len(long) + 2)]
    assert toxicity.quotations("İ “x” „y“ «z»") == [(2, 5), (6, 9), (10, 13)]
    assert toxicity.quotations('an "open one\nand a "closed" one\n> whole line') == [(19, 27), (32, 44)]
    assert toxicity.quotations("“" * 50_000) == [] and toxicity.quotations("") == []
    model = toxicity.ToxicityModel(["grumblo"], np.ones(1), np.ones(1))
    memory = toxicity.Memory(toxicity.Matcher(model.terms))
    for text, told in ((f'x "{long} grumblo" y', True), ('İstanbul "a grumblo b"', True), ("İİİ grumblo", False), ("„grumblo” x", True)):
        f, hits = model.features(text, memory)
        assert hits and (f[3] > 0) == told and (f[1] > 0) != told, text


def test_toxicity_learns_misspellings_and_quotation(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        words = prose(rng, "en", 60).split()
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["blockhead", "nitwit", "dunce"]) + rng.choice(["", "s"])
        rows.append((i, " ".join(words), toxic))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(labelled.filter("doc_id % 8 < 6"))
    assert {t[:4] for t in model.terms} >= {"bloc", "nitw", "dunc"}
    out = toxicity.score(labelled.filter("doc_id % 8 >= 6"), model).collect()
    assert np.mean([r.predicted == r.toxic for r in out]) > 0.97
    body = prose(rng, "en", 40)
    texts = [(0, f"{body} you blokchead and nitwitt {body}"), (1, f'{body} He said "you blockhead" {body}'), (2, f"{body} you blockhead {body}"), (3, None), (4, ""), (5, body)]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert got[0].toxic_terms and got[0].score > got[5].score
    assert got[1].score < got[2].score
    assert got[3].score == got[4].score == got[5].score and got[3].predicted == 0
    plain = toxicity.learn(labelled.limit(0))
    assert {r.score for r in toxicity.score(labelled, plain).collect()} == {0.0}
    with pytest.raises(ValueError, match="prefix"):
        toxicity.score(labelled.withColumn("score", F.lit(1)), model)
