"""Ranks against the scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from mailposture.llm import lexical_search
from mailposture.llm.queries import op12_lexical_search
from mailposture.llm.sql import OP12_LEXICAL_SEARCH
from tests.llm.fixtures import SCHEMA, documents
from tests.oracle import duck_rows, spark_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, top=20):
    split = [(k, Counter(TERM.findall((t or "").translate(LOWER)))) for k, t in docs]
    split = [(k, c) for k, c in split if c]
    n, total = len(split), sum(c.total() for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for key, c in split:
            m = 100 - 25 + (25 * c.total() * n) // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in Counter(TERM.findall((text or "").translate(LOWER))).items() if c[t])
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def test_awkward_documents(spark):
    docs = documents(200)
    docs += [(2000 + i, docs[3][1], "en", "s", 1, None, None) for i in range(40)]  # more equal scores than places
    items = [(k, " ".join(docs[k * 7][1].split()[5:40])) for k in range(12)]
    items += [(50, None), (51, ""), (52, "unknownterm 77"), (53, docs[3][1][:200].upper()), (53, "der der DER die"), (54, "Über ÉTÉ éau é\0é"), (54, "Über ÉTÉ éau é\0é"), (None, "the of ing")]
    got = rows(lexical_search.search(spark.createDataFrame(docs, SCHEMA).repartition(5), spark.createDataFrame(items, "item_id long, text string")))
    assert got == plain([(d[0], d[1]) for d in docs], items)
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame(items, "item_id long, text string")
    assert lexical_search.search(none, some).count() == 0
    assert lexical_search.search(spark.createDataFrame(docs, SCHEMA), some.limit(0)).count() == 0
    with pytest.raises(ValueError):
        lexical_search.search(none, none, item="doc_id")


def test_blocks_and_small_trees(spark, monkeypatch):
    monkeypatch.setattr(lexical_search.blocks, "__defaults__", (300,))
    docs = documents(100)
    items = [(k, " ".join(docs[k][1].split()[:30])) for k in range(20)]
    got = rows(lexical_search.search(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), top=3))
    assert got == plain([(d[0], d[1]) for d in docs], items, 3)


def test_branches_are_left_out():
    """Trees give the scores of a full search, and do not look at every node."""
    rng = random.Random(3)
    docs = []
    for _ in range(1500):
        ranks = sorted(set(int(rng.random() ** 0.4 * 300) for _ in range(rng.randint(1, 40))))
        docs.append((ranks, [rng.randint(1, 5) for _ in ranks], rng.randint(80, 200)))
    tree, ids = lexical_search.Tree(docs), list(range(1500))
    tried = 0
    for _ in range(20):
        ranks = np.array(sorted(rng.sample(range(310), 12)), np.int64)
        item = ranks, 6000 - 18 * ranks
        best = []
        tried += tree.search(item, best, ids, 20)
        full = []
        for d, (r, tf, m) in enumerate(docs):
            s = sum(int(6000 - 18 * k) * (1_000_000_000 * f // (1000 * f + 12 * m)) for k, f in zip(r, tf, strict=True) if k in ranks)
            if s:
                full.append((-s, False, d))
        assert best == sorted(full)[:20]
    assert tried < 20 * len(tree.doc) * 0.8


def test_query_against_sql(spark, small):
    assert spark_rows(op12_lexical_search(spark, small)) == duck_rows(OP12_LEXICAL_SEARCH, small)
