"""Words one edit apart, against a plain reading of the definition."""

import random
import re
import zlib
from collections import Counter

from mailposture.llm import spelling
from mailposture.llm.queries import op13_spelling_variants
from tests.llm.fixtures import SCHEMA, documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edit_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and edit_one(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_words_of_the_awkward_documents(spark):
    docs = documents(120)
    got = rows(spelling.group(spelling.words(spark.createDataFrame(docs, SCHEMA))))
    assert got == plain([(r[0], r[1]) for r in docs])


def test_chains_ties_and_lengths(spark):
    rng = random.Random(5)
    base = ["strasse", "straßen", "motorway", "ÀÉÿfghij", "abcdefghijklmnopqrstuvwxyz"]
    texts = []
    for w in base:
        v = w
        for times in (3000, 250, 20, 2):
            texts += [v] * times
            i = rng.randrange(len(v))
            v = v[:i] + rng.choice("xyzß") + v[i + rng.randint(0, 1) :]
    texts += ["aaaaaaaa", "aaaaaaa"] * 2 + ["tiebreak", "tiebreac"] * 30 + ["tiebreax"] * 3
    docs = [(i, " ".join(texts[i::50]) + " \U0001f600 x×y÷zabcd") for i in range(50)]
    got = rows(spelling.group(spelling.words(spark.createDataFrame(docs, "doc_id long, text string"))))
    assert got == plain(docs)
    assert any(r[1] is not None and r[1] != r[2] for r in got)  # a form that has a form


def test_query_and_empty(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = rows(op13_spelling_variants(spark, small))
    assert got and got == plain(docs)
    assert spelling.group(spelling.words(spark.createDataFrame([], SCHEMA))).count() == 0
