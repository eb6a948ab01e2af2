"""Decontamination, compression bands, URL filter."""

import random
import re
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from mailposture.llm import compression_bands, string_tiling, url_filter
from tests.llm.fixtures import SCHEMA, documents, prose


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain_tiles(doc, item, least):
    """Greedy string tiling by the definition: longest free match first."""
    used_d, used_i, total = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (least - 1, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while p + n < len(item) and t + n < len(doc) and item[p + n] == doc[t + n] and not used_i[p + n] and not used_d[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return total
        for k in range(n):
            used_i[p + k] = used_d[t + k] = True
        total += n


def test_tiling_like_the_definition(spark):
    rng = random.Random(11)
    vocabulary = ["a", "b", "c", "d", "e", "f", "g"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 16)))) for i in range(12)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    docs += [(100, items[5][1]), (101, " ".join(reversed([" ".join(words_of(items[6][1])[:5]), " ".join(words_of(items[6][1])[5:])])))]
    got = {(r.doc_id, r.item_id): r.coverage for r in string_tiling.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), coverage=0.01).collect()}
    want = {}
    for d, text in docs:
        for i, item in items:
            w = words_of(item)
            n = plain_tiles(words_of(text), w, string_tiling.SEED_TOKENS)
            if len(w) < string_tiling.SEED_TOKENS:
                n = len(w) * (words_of(text) == w)
            if n:
                want[d, i] = round(n / len(w), 6)
    assert got == want


@pytest.mark.parametrize("step", [1, 1 << 20])
def test_repetitive_texts_like_the_definition(monkeypatch, step):
    """Few different words, so that every seed has many places; tiles and their order are those of the definition."""
    monkeypatch.setattr(string_tiling, "SPREAD", step)
    rng = random.Random(2)
    for _ in range(60):
        letters = "ab" if rng.random() < 0.5 else "a" * 9 + "b"
        items = [" ".join(rng.choice(letters) for _ in range(rng.randint(5, 40))) for _ in range(3)]
        texts = [" ".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3)]
        block = string_tiling.Block.of([0, 1, 2], items)
        got = {(r, i): c for r, i, tiles, c in block.tilings(pa.array(texts), string_tiling.Tokenizer())}
        want = {}
        for r, text in enumerate(texts):
            for i, item in enumerate(items):
                n = plain_tiles(words_of(text), words_of(item), string_tiling.SEED_TOKENS)
                if n:
                    want[r, i] = n / len(words_of(item))
        assert got == want


def test_memory_of_one_word_repeated():
    item, text = "so " * 5000, "so " * 100_000
    block = string_tiling.Block.of(["x"], [item])
    tokenizer = string_tiling.Tokenizer()
    tracemalloc.start()
    (found,) = block.tilings(pa.array([text]), tokenizer)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[2] == [(0, 0, 5000)] and found[3] == 1.0 and peak < 300e6
    # Two words in turn, and breaks: more than one tile.
    turn = ("so la " * 400 + "break ") * 100
    ((_, _, tiles, share),) = block.of(["y"], ["so la " * 1000]).tilings(pa.array([turn]), tokenizer)
    assert [t[2] for t in tiles] == [800, 800, 400] and share == 1.0


def test_leaks_in_blocks_and_awkward_rows(spark, monkeypatch):
    rng = random.Random(12)
    items = [(i, prose(rng, "en", 30)) for i in range(6)] + [(98, None), (99, "too short")]
    rows = documents()
    cut = items[2][1].split()
    rows += [(2000, f"{prose(rng, 'en', 50)} {items[0][1].upper()}! {prose(rng, 'en', 50)}", "en", "s", 1, None, None), (2001, " ".join(cut[15:]) + " and " + " ".join(cut[:15]), "en", "s", 1, None, None), (2002, "too short", "en", "s", 1, None, None), (2003, " ".join(cut[:10]), "en", "s", 1, None, None)]
    long = prose(rng, "fr", 20_000)
    rows.append((2004, f"{long} {items[1][1]} {long}", "fr", "s", 1, None, None))
    docs, benchmark = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    rows += [(2005, "A line.\n  Too short!\nMore", "en", "s", 1, None, None), (2006, "it is too short here", "en", "s", 1, None, None), (2007, "Too\nshort", "en", "s", 1, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = {(2000, 0), (2001, 2), (2004, 1), (2002, 99), (2005, 99), (2007, 99)}
    for size in (string_tiling.BLOCK_BYTES, 300):
        monkeypatch.setattr(string_tiling, "BLOCK_BYTES", size)
        found = string_tiling.leaks(docs, benchmark)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == want
    tiles = next(r.tiles for r in string_tiling.leaks(docs, benchmark).collect() if r.doc_id == 2001)
    assert sorted((t.item_at, t.tokens) for t in tiles) == [(0, 15), (15, 15)]
    kept = string_tiling.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {k for k, _ in want}
    (line,) = next(r.tiles for r in string_tiling.leaks(docs, benchmark).collect() if r.doc_id == 2005)
    assert (line.doc_at, line.item_at, line.tokens) == (2, 0, 2)
    assert string_tiling.leaks(docs, benchmark.limit(0)).count() == 0
    assert string_tiling.decontaminate(docs.limit(0), benchmark).count() == 0


def test_tokens_of_long_rows_do_not_depend_on_steps(monkeypatch):
    import numpy as np
    import pyarrow as pa

    texts = pa.array([prose(random.Random(1), "de", 3000), "x", None, prose(random.Random(2), "fr", 100)])
    whole = [h.tolist() for _, _, h, _ in string_tiling.Tokenizer().column(texts)]
    monkeypatch.setattr(string_tiling, "WINDOW", 100)
    parts = [h.tolist() for _, _, h, _ in string_tiling.Tokenizer().column(texts)]
    assert sum(whole, []) == sum(parts, [])
    assert len(set(sum(whole, []))) == len({w for t in texts.to_pylist() for w in words_of(t)})
    assert np.array_equal(string_tiling.run_hashes(np.array([1, 2, 3, 1, 2], np.uint64), 2)[[0]], string_tiling.run_hashes(np.array([1, 2], np.uint64), 2))


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_counts_like_the_definition(spark):
    rng = random.Random(3)
    texts = ["a b c a b c", "a a a a", "x\n\nx\n \n \nx y\nx", "é ü #|<>", None, "", "a b", "   x", "a\u000bb\u000cc a b c"]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) + "\n" * rng.randint(0, 2) + "q" for _ in range(60)]
    out = compression_bands.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(texts[r.doc_id]), texts[r.doc_id]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_bands(spark):
    rng = random.Random(4)
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") + (" " if i % 9 == 8 else "") for i in range(40_000))
    prose_text = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(4000))
    rows = [(0, prose_text), (1, noise), (2, " ".join(f"the same line {i % 3} again and" for i in range(400))), (3, prose_text[:20000] + " zz" * 10000)]
    out = {r.doc_id: r for r in compression_bands.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0].kept and not out[1].kept and not out[2].kept and not out[3].kept
    assert not out[1].base_failed  # what rejects it is the ratio alone
    pack = zstandard.ZstdCompressor(level=compression_bands.LEVEL)
    assert out[0].compression_ratio == len(prose_text.encode()) / len(pack.compress(prose_text.encode()))
    with pytest.raises(ValueError, match="exist"):
        compression_bands.judge(spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)))


def test_verdicts_like_the_rule(spark):
    """Whole and chunk ratios recomputed: texts of every class, repetitive, ordinary and incompressible."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    texts = [None, "", "short"]
    for size in (200, 300, 600, 1500, 2048, 3071, 3073, 5000, 20_000, 70_000):
        texts.append(prose(rng, "de", size // 4)[:size])
        texts.append("".join(rng.choice(letters) if i % 8 else " " for i in range(size)))
        texts.append((prose(rng, "en", 40) + " ") * (size // 100))
        texts.append(prose(rng, "fr", size // 8) + " " + "x1 " * (size // 8))
    pack = zstandard.ZstdCompressor(level=compression_bands.LEVEL)
    ratio = lambda b: len(b) / len(pack.compress(b))
    seen = set()
    for r in compression_bands.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        raw = (texts[r.doc_id] or "").encode()
        words, _, _, _, repeated = plain_counts_fast(raw.decode())
        failed = words < 50 or repeated > 0.5 * words
        low, high = next(((a, b) for least, a, b in reversed(compression_bands.BANDS) if len(raw) >= least), (0, 1e9))
        odd = []
        for at in range(0, len(raw), 2048) if len(raw) >= 4096 else []:
            chunk = raw[at : at + 2048]
            if len(chunk) == 2048:
                odd.append(not compression_bands.CHUNK_LOW <= ratio(chunk) <= compression_bands.CHUNK_HIGH)
            elif len(chunk) >= 256:
                bottom, top = next((x, y) for least, x, y in reversed(compression_bands.BANDS) if len(chunk) >= least)
                odd.append(not bottom <= ratio(chunk) <= top)
        odd = sum(odd) / max(1, len(odd))
        inside = not raw or len(raw) < 256 or (low <= ratio(raw) <= high and odd <= compression_bands.CHUNK_SHARE)
        assert (r.base_failed, r.kept) == (failed, inside and not failed), (r.doc_id, len(raw))
        assert len(raw) < 256 or abs(r.odd_chunks - odd) < 1e-12
        seen.add((failed, r.kept))
    assert seen == {(True, False), (False, False), (False, True)}


def test_a_single_chunk_is_judged_by_its_band():
    """A text of less than two chunks inside its band is kept, whatever the limits of chunks say."""
    rng = random.Random(12)
    pack = zstandard.ZstdCompressor(level=compression_bands.LEVEL)
    between = 0
    for i in range(400):
        data = ("".join(rng.choice("abcdefghijklmnop qrstuv") for _ in range(2048 - 4 * i)) + "again " * 1000)[: 2048 + i].encode()
        whole, odd, kept = compression_bands.in_band(data, pack)
        _, low, high = compression_bands.band_of(len(data))
        assert odd == 0 and kept == (low <= whole <= high)
        between += compression_bands.CHUNK_HIGH < whole <= high
    assert between


def plain_counts_fast(text):
    """``plain_counts`` with a table of windows, for long texts."""
    words = text.split()
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {i + k for i, g in enumerate(zip(words, words[1:], words[2:], strict=False)) if grams[g] > 1 for k in range(3)}
    return len(words), 0, 0, 0, len(hit)


def test_bands_decide_beyond_the_base_rules(spark, small):
    """Good texts stay; symbols behind the words, or spaced base64, go by their ratio in every class."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    good = spark.read.parquet(f"{small}/documents.parquet").join(spark.read.parquet(f"{small}/labels.parquet").filter("quality = 1"), "doc_id").select("doc_id", "text")
    out = compression_bands.judge(good).filter("not base_failed and compression_ratio is not null").collect()
    assert len(out) > 30 and all(r.kept for r in out)
    odd = []
    for size in (700, 1500, 5000, 20_000, 80_000):
        odd.append((size, "".join(rng.choice(letters) if i % 7 else " " for i in range(size))))
        odd.append((-size, " ".join("".join(rng.choice(letters[:12]) for _ in range(rng.randint(2, 9))) + rng.choice(["###", "***", "&&&"]) * 2 for _ in range(size // 12))))
    for r in compression_bands.judge(spark.createDataFrame(odd, "doc_id long, text string")).collect():
        assert not r.base_failed and not r.kept, (r.doc_id, r.compression_ratio, r.odd_chunks)


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
URLS = [
    ("http://a.example.net/en/1", "allow", "example.net/en/"),
    ("https://example.net/fr/1", "block", "net/"),
    ("https://examplenet/fr/1", "allow", None),
    ("HTTP://Sub.Example.COM/de/x?y#z", "block", "example.com/de/"),
    ("http://example.com/DE/x", "allow", None),
    ("http://x.net", "allow", None),
    ("http://x.net?a=/b", "allow", None),
    ("http://x.org/fr/?q", "allow", "org/fr/"),
    ("no scheme", "allow", None),
    (None, "allow", None),
    ("http://listed.com/p/?utm_source=x", "block", None),
    ("http://WWW.listed.com/p.html#f", "block", None),
    ("http://listed.com/q", "allow", None),
    ("", "allow", None),
]


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] + [(10, URLS[10][0])], "page_id long, url string")
    listed = spark.createDataFrame([("listed.com/p",), ("listed.com/p",), (None,)], "canonical string")
    out = url_filter.judge(pages, listed, RULES)
    got = out.collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r.verdict, r.rule) == URLS[r.page_id][1:], URLS[r.page_id]
    by = {r.page_id: r for r in got}
    assert (by[3].host, by[3].path) == ("sub.example.com", "/de/x") and (by[5].host, by[5].path) == ("x.net", "") and (by[9].host, by[9].path) == ("", "")
    assert {r.verdict for r in url_filter.judge(pages, listed.limit(0), []).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), listed, RULES).count() == 0


@pytest.mark.parametrize("bytes_", [0, 10**6])
def test_long_and_short_lists_and_clashes(spark, monkeypatch, bytes_):
    """The exact join by broadcast or by a shuffle; listed pages are found in any spelling, whatever their host."""
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", bytes_)
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.com/p/{i}{'.html' if i % 2 else '/'}?b={i}&a=1&utm_x=2") for i in range(300)] + [(900, None), (901, "x")], "page_id long, url string")
    spelled = pages.filter("page_id % 3 = 0 and page_id < 900").select(url_filter.respelled().alias("url"))
    assert spelled.filter("url like 'HTTPS://www.H%'").count() == 100
    listed = spelled.select(url_filter.canonical().alias("canonical"))
    out = url_filter.judge(pages.withColumn("verdict", F.lit("mine")), listed, [], prefix="u_").collect()
    assert len(out) == 302 and {r.verdict for r in out} == {"mine"}
    assert all((r.u_verdict == "block") == (r.page_id % 3 == 0 and r.page_id < 900) for r in out)
    with pytest.raises(ValueError, match="prefix"):
        url_filter.judge(pages.withColumn("rule", F.lit(1)), listed, [])


def test_bloom_has_no_false_negatives_and_few_false_positives(spark, monkeypatch):
    listed = spark.range(0, 3000).select(F.concat(F.lit("h/"), F.col("id").cast("string")).alias("canonical"))
    blocks = 256
    table = url_filter.bloom(listed, blocks)
    assert table.count() <= blocks
    asked = spark.range(0, 20000).select("id", F.concat(F.lit("h/"), F.col("id").cast("string")).alias("c"))
    joined = asked.join(table, url_filter.block_of(F.col("c"), blocks) == F.col("block"), "left")
    ok = F.lit(True)
    for k, m in enumerate(url_filter.masks(F.col("c"))):
        ok = ok & F.coalesce(F.col(f"w{k}").bitwiseAND(m) == m, F.lit(False))
    hits = joined.filter(ok)
    assert hits.filter("id < 3000").count() == 3000
    assert hits.filter("id >= 3000").count() < 0.1 * 17000
    # A filter that is far too small still gives exact verdicts.
    monkeypatch.setattr(url_filter, "MOST_BLOCKS", 1)
    pages = asked.select(F.col("id").alias("page_id"), F.concat(F.lit("http://"), F.col("c")).alias("url"))
    assert url_filter.judge(pages, listed, []).filter("(verdict = 'block') <> (page_id < 3000)").count() == 0


def test_pairs_under_the_coverage_are_not_tiled(monkeypatch):
    """A phrase that many items share: only pairs that can reach the coverage are tiled, with the same results."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    phrase = "this phrase is in every one"
    items = [" ".join([word() for _ in range(30)] + [phrase] + [word() for _ in range(30)]) for _ in range(300)]
    texts = [" ".join([word() for _ in range(100)] + [phrase, items[k][: (k + 1) * 60]]) for k in range(6)]
    block, tokenizer = string_tiling.Block.of(list(range(300)), items), string_tiling.Tokenizer()
    whole = [t for t in block.tilings(pa.array(texts), tokenizer) if t[3] >= 0.5]
    calls, greedy = [], string_tiling.greedy_tiles
    monkeypatch.setattr(string_tiling, "greedy_tiles", lambda *a: calls.append(1) or greedy(*a))
    assert [t for t in block.tilings(pa.array(texts), tokenizer, 0.5) if t[3] >= 0.5] == whole
    assert whole and len(calls) <= len(texts)
