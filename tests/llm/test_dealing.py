"""Sharding, mixing, quotation linking, the registered queries and the pipeline."""

import math
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from mailposture.llm import common, mixing, ordinal_quality, queries, quotation, rendezvous, simhash, sql
from tests.llm.fixtures import SCHEMA, documents, prose
from tests.llm.test_filters import plain_tiles, words_of
from tests.oracle import duck_rows, spark_rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).drop("shard").cache()


def test_place_is_the_least_weighted_log(spark):
    """Each key goes to the shard with the least -ln(u) / weight, u from the hash of key and shard."""
    weights = [1.0, 3.0, 0.5, 2.0]
    hashed = [F.xxhash64("id", F.lit(f"shard-{j}")).alias(f"h{j}") for j in range(4)]
    rows = spark.range(500).select("id", *hashed, rendezvous.place("id", weights).alias("weighted"), rendezvous.place("id", [2.0] * 4).alias("even")).collect()
    for r in rows:
        cost = [-math.log(((r[f"h{j}"] % (1 << 64) >> 11) + 0.5) / (1 << 53)) for j in range(4)]
        assert r.weighted == min(range(4), key=lambda j: cost[j] / weights[j])
        assert r.even == max(range(4), key=lambda j: r[f"h{j}"])


def test_hot_and_repeated_keys_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(rendezvous, "ROWS_PER_RANGE", 100)
    one = spark.range(20_000).select(F.lit(5).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    none = spark.range(5000).select(F.lit(None).cast("int").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    same = spark.range(5000).select(F.lit(7).alias("doc_id"), F.lit("same").alias("text"))
    for records in (one.union(none), one.union(none).union(same)):
        out = rendezvous.assign(records, "doc_id", [1.0, 1.0, 1.0])
        assert out.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.min("slot").alias("a"), F.max("slot").alias("b")).filter("n <> d or a <> 0 or b <> n - 1").count() == 0
        assert sorted(map(tuple, out.select("doc_id", "text").collect()), key=repr) == sorted(map(tuple, records.collect()), key=repr)
        again = rendezvous.assign(records.repartition(5, "text"), "doc_id", [1.0, 1.0, 1.0])
        assert out.exceptAll(again).count() == 0


def test_sharding(spark, docs, monkeypatch):
    monkeypatch.setattr(rendezvous, "ROWS_PER_RANGE", 2)  # many ranges
    out = rendezvous.assign(docs, "doc_id", [1.0] * 5, ["text", "source"], [1.0] * 6).collect()
    assert len(out) == docs.count()
    for s in range(5):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert all(r.grown_shard in (r.shard, 5) for r in out)
    one = rendezvous.assign(docs, "doc_id", [1.0], ["text"]).collect()
    assert {r.shard for r in one} == {0}
    assert rendezvous.assign(docs.limit(0), "doc_id", [1.0] * 3).count() == 0
    with pytest.raises(ValueError):
        rendezvous.place("doc_id", [1.0, 0.0])
    clashing = docs.withColumn("shard", F.lit("x")).withColumn("slot", F.lit(-1))
    with pytest.raises(ValueError, match="prefix"):
        rendezvous.assign(clashing, "doc_id", [1.0] * 3)
    kept = rendezvous.assign(clashing, "doc_id", [1.0] * 3, prefix="new_").collect()
    assert {(r.shard, r.slot) for r in kept} == {("x", -1)} and {r.new_shard for r in kept} == {0, 1, 2}


def test_weights_and_few_moves(spark):
    keys = spark.range(0, 30_000).withColumnRenamed("id", "doc_id")
    placed = keys.select("doc_id", rendezvous.place("doc_id", [1.0, 2.0, 3.0]).alias("shard"), rendezvous.place("doc_id", [1.0, 2.0, 3.0, 2.0]).alias("grown_shard"))
    counts = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    for s, share in enumerate((1 / 6, 2 / 6, 3 / 6)):
        assert abs(counts[s] / 30_000 - share) < 0.02
    assert placed.filter("grown_shard <> shard and grown_shard <> 3").count() == 0
    moved = {r.moved: r.records for r in rendezvous.moved_share(placed).collect()}
    assert abs(moved[True] / 30_000 - 0.25) < 0.02


def plain_targets(sizes, weights=(1, 2, 3)):
    """Shares by weight, cut at three times the size and dealt out anew until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full, out = sum(sizes.values()), {}, {}
    while True:
        left = [s for s in names if s not in full]
        rest = total - sum(full.values())
        out = {s: rest * w[s] / sum(w[x] for x in left) for s in left}
        over = [s for s in left if out[s] > 3 * sizes[s]]
        if not over:
            return full | out
        full |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixing(spark, seed):
    rng = random.Random(seed)
    rows = [(i, prose(rng, "en", rng.randint(1, 40)), rng.choice(["a"] * 40 + ["b", "c", "d", "e", "f", None, "g"])) for i in range(700)]
    rows += [(9000, None, "a"), (9001, "", "only-empty"), (9002, " \t", None), (3, rows[3][1], rows[3][2]), (None, "x y", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = plain_targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken in ({0} if r.size == 0 else {0, r.size, 2 * r.size, 3 * r.size})
    for s in sizes:
        taken = sum(r.taken for r in out if r.source == s)
        assert abs(taken - want[s]) <= 45, s
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr)
    repeated = mixing.repeat(docs.withColumn("hash", F.lit(1)).withColumn("copies", F.lit("x")))
    assert repeated.columns == ["doc_id", "text", "source", "hash", "copies"]
    assert sum(len((r.text or "").split()) for r in repeated.collect()) == sum(r.taken for r in out)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.repeat(docs.limit(0)).count() == 0


def test_targets_of_many_sources(spark, monkeypatch):
    """The table of sources is dealt to ranges; targets are those of the plain rule."""
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 40)
    rng = random.Random(8)
    sizes = {f"host{rng.getrandbits(30):x}": rng.choice([1, 5, 40, 1000, 0]) for _ in range(300)} | {None: 7}
    out = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = plain_targets(sizes)
    assert len(out) == len(sizes) and all(abs(r.target - want[r.source]) < 1e-6 for r in out)


def test_word_count_like_the_definition(spark):
    texts = [None, "", " ", "a", " a  b\t\nc ", " x", "a\u000bb", "x" * 10]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.word_count().alias("n")).collect()
    assert [r.n for r in got] == [0, 0, 0, 1, 3, 1, 2, 1]


CHAT = [
    (1, 0, "user", "How do I tie it?\nPlease help."),
    (1, 1, "assistant", "Over, then under."),
    (1, 2, "user", "> Over, then under.\nTwice?"),
    (1, 3, "assistant", "On Monday she wrote:\n> Twice?\n>> over,  THEN under.\nYes."),
    (1, 4, "user", "> How do I tie it?\n> Please help.\n> Over, then under.\nThanks"),
    (1, 5, "user", "> never said\nhm"),
    (2, 0, "user", None),
    (2, 1, "user", ""),
    (2, 70, "user", "common"),
    (2, 71, "user", "common"),
    (2, 200, "user", "> common"),
    (None, 0, "user", "> common"),
    (3, None, "user", "> common\nx"),
    (2, 200, "user", "> common"),
]


@pytest.mark.parametrize("width", [1, 64])
def test_quotation_linking(spark, width, monkeypatch):
    monkeypatch.setattr(quotation, "RANGE", width)
    messages = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string")
    out = quotation.conversations(messages).collect()
    assert len(out) == len(CHAT)
    at = {(r.conv_id, r.turn): r for r in out}
    place = {k: (r.reply_to, r.thread_root, r.depth) for k, r in at.items()}
    assert place[1, 2] == (1, 1, 1) and place[1, 3] == (2, 1, 2) and place[1, 4] == (0, 0, 1) and place[1, 5] == (None, 5, 0)
    assert place[2, 200] == (71, 71, 1) and place[3, None] == (None, None, 0) and place[None, 0] == (None, 0, 0)
    assert at[1, 3].clean_text == "Yes." and at[1, 2].clean_text == "Twice?" and at[2, 0].clean_text is None and at[2, 1].clean_text == ""
    assert at[1, 3].quoted_lines == 2 and at[1, 2].chat == "<|user|>\nTwice?\n<|end|>"
    # A message stands behind what it replies to.
    assert all((at[r.conv_id, r.reply_to].depth < r.depth) for r in out if r.reply_to is not None)
    assert quotation.conversations(messages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        quotation.conversations(messages.withColumn("depth", F.lit(1)))


def wrapped(text, width, sign):
    """Lines of a text, cut anew, each behind a quote sign."""
    out = []
    for line in text.split("\n"):
        words = line.split()
        out += [f"{sign} {' '.join(words[i : i + width])}" for i in range(0, len(words), width)] or [sign]
    return "\n".join(out)


def threads(seed, convs, most):
    """Generated conversations: replies quote their parent whole or cut, wrapped anew, with older quotes nested in it;
    many share common lines; one conversation holds a third of all messages, most of them replies to its first."""
    rng = random.Random(seed)
    rows, replied, whole = [], {}, set()
    for c in range(convs):
        n = most if c == 0 else rng.randint(1, 12)
        own = {}
        for t in range(n):
            lines = [prose(rng, "en", rng.randint(3, 14)) for _ in range(rng.randint(1, 4))]
            if rng.random() < 0.3:
                lines.insert(rng.randint(0, len(lines)), "Thanks a lot")
            if len(lines) > 2 and rng.random() < 0.4:
                lines.insert(2, "")
            own[t] = "\n".join(lines)
            text = own[t]
            if t and rng.random() < 0.7:
                parent = 0 if c == 0 and rng.random() < 0.8 else rng.randrange(t)
                replied[c, t] = parent
                quote = own[parent]
                if rng.random() < 0.3:
                    kept = [line for line in quote.split("\n") if line.strip()]
                    quote = rng.choice(kept)
                    block = f"> {quote}"
                else:
                    whole.add((c, t))
                    block = wrapped(quote, rng.randint(3, 9), ">")
                if (c, parent) in replied and rng.random() < 0.5:
                    block += "\n" + wrapped(own[replied[c, parent]], 5, rng.choice([">>", "> >"]))
                text = f"On Monday she wrote:\n{block.upper() if rng.random() < 0.2 else block}\n{own[t]}"
            rows.append((c, t, rng.choice(["user", "assistant"]), text))
    return rows, replied, whole


def plain_replies(rows):
    """Reply targets by looking at every earlier message of a conversation."""
    said = {}
    for c, t, _, text in rows:
        said.setdefault(c, {})[t] = {u[4] for u in quotation.units(quotation.marked(text)) if u[0] == 0}
    out = {}
    for c, t, _, text in rows:
        latest = lambda words: max((s for s in range(t) if words in said[c][s]), default=None)  # noqa: B023, E731
        passages = {}
        for level, passage, paragraph, size, words, n in quotation.units(quotation.marked(text)):
            if level:
                passages.setdefault((level, passage), []).append((size, paragraph, latest(words), n))
        votes = {}
        for (level, _), units in passages.items():
            found = [u for u in units if u[2] is not None]
            if any(u[0] == quotation.PASSAGE for u in found):
                found = [u for u in found if u[0] == quotation.PASSAGE]
            else:
                whole = {u[1] for u in found if u[0] == quotation.PARAGRAPH}
                found = [u for u in found if u[0] == quotation.PARAGRAPH or u[1] not in whole]
            for _, _, source, n in found:
                votes[level, source] = votes.get((level, source), 0) + n
        if votes:
            out[c, t] = max((-level, n, source) for (level, source), n in votes.items())[2]
    return out


@pytest.mark.parametrize("width", [8, 64])
def test_generated_threads(spark, tmp_path, monkeypatch, width):
    monkeypatch.setattr(quotation, "RANGE", width)
    monkeypatch.setattr(common, "HOT_LEAST", 50)
    monkeypatch.setattr(common, "SHORT", 10 if width == 8 else 100_000)
    rows, replied, whole = threads(3, 250, 700)
    assert len(rows) > 2000
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {(r.conv_id, r.turn): r for r in quotation.conversations(messages).collect()}
    want = plain_replies(rows)
    assert {k: r.reply_to for k, r in out.items() if r.reply_to is not None} == want
    # Whole quotations lead to the true parent, wrapped anew or not.
    assert len(whole) > 500 and sum(want.get(k) == replied[k] for k in whole) > 0.99 * len(whole)
    for k, r in out.items():
        root, depth = k[1], 0
        while (k[0], root) in want:
            root, depth = want[k[0], root], depth + 1
        assert (r.thread_root, r.depth) == (root, depth)
    if width == 64:
        write_table(spark, messages, tmp_path)
        assert spark_rows(queries.op9_quotation_linking(spark, str(tmp_path))) == duck_rows(sql.OP9_QUOTATION_LINKING, str(tmp_path))


def test_units_of_a_message():
    text = "Hi\n> a  B\n> c\n>\n> d\n>> e\n\nown\nwords\n> f"
    got = list(quotation.units(quotation.marked(text)))
    passages = [(u[0], u[4], u[5]) for u in got if u[3] == quotation.PASSAGE]
    assert passages == [(0, "hi own words", 3), (1, "a b c d", 3), (2, "e", 1), (1, "f", 1)]
    assert [(u[0], u[4]) for u in got if u[3] == quotation.PARAGRAPH] == [(0, "hi"), (0, "own words"), (1, "a b c"), (1, "d"), (2, "e"), (1, "f")]
    assert list(quotation.units([])) == [] and list(quotation.units(quotation.marked(">\n> \n"))) == []


def test_assembled_conversations(spark):
    messages = spark.createDataFrame(CHAT + [(2, 200, "user", "another text of the turn")], "conv_id long, turn long, role string, text string")
    placed = quotation.conversations(messages)
    whole = {r.conv_id: r for r in quotation.assemble(placed).collect()}
    assert whole.keys() == {1, 2} and whole[1].messages == 6 and whole[2].messages == 5
    # Thread by thread: turn 4 replies to 0, turns 2 and 3 belong to 1, turn 5 is alone.
    said = ["How do I tie it?\nPlease help.", "Thanks", "Over, then under.", "Twice?", "Yes.", "hm"]
    at = [whole[1].conversation.find(s) for s in said]
    assert -1 not in at and at == sorted(at) and ">" not in whole[1].conversation.replace("|>", "")
    parts = quotation.assemble(placed, part=2).orderBy("conv_id", "part").collect()
    assert all(r.messages <= 2 for r in parts) and sum(r.messages for r in parts) == 11
    assert quotation.assemble(placed.limit(0)).count() == 0
    kept = quotation.conversations(messages.withColumn("depth", F.lit("mine")), prefix="q_").collect()
    assert {r.depth for r in kept} == {"mine"} and max(r.q_depth for r in kept) == 2


def write_table(spark, messages, tmp_path):
    messages.coalesce(1).write.parquet(str(tmp_path / "c"))
    part = next((tmp_path / "c").glob("*.parquet"))
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        (tmp_path / f"{t}.parquet").symlink_to(part)


def test_quote_levels_and_same_sql(spark, tmp_path):
    rows = [r for r in CHAT if r[0] is not None and r[1] is not None]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").distinct().coalesce(1).write.parquet(str(tmp_path / "c"))
    part = next((tmp_path / "c").glob("*.parquet"))
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        (tmp_path / f"{t}.parquet").symlink_to(part)
    assert spark_rows(queries.op9_quotation_linking(spark, str(tmp_path))) == duck_rows(sql.OP9_QUOTATION_LINKING, str(tmp_path))


def test_long_interleaved_conversations(spark, tmp_path):
    """3,000 turns in seven threads: parts in their order are the conversation in reply order; the same in SQL."""
    said = lambda t: f"Own words of turn {t}."
    rows = [(c, t, "user", said(t) if t < 7 else f"> {said(t - 7)}\n\n{said(t)}") for c, n in ((1, 3000), (2, 900), (3, 1024)) for t in range(n)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = quotation.assemble(quotation.conversations(messages)).orderBy("conv_id", "part").collect()
    assert [(r.conv_id, r.part, r.messages) for r in parts] == [(1, 0, 1024), (1, 1, 1024), (1, 2, 952), (2, 0, 900), (3, 0, 1024)]
    whole = "\n".join(r.conversation for r in parts if r.conv_id == 1)
    order = [int(t) for t in re.findall(r"turn (\d+)", whole)]
    assert order == [t for thread in range(7) for t in range(thread, 3000, 7)]
    write_table(spark, messages, tmp_path)
    assert spark_rows(queries.op9_quotation_linking(spark, str(tmp_path))) == duck_rows(sql.OP9_QUOTATION_LINKING, str(tmp_path))


def test_rows_without_an_id_are_taken_apart(spark, tmp_path):
    """Half of a source's rows, or all, have no id: what is taken still comes near the target. The same in SQL."""
    rows = [(i if i % 2 else None, f"{i} " + "word " * 9, "half") for i in range(1500)] + [(None, f"{i} " + "word " * 9, "none") for i in range(2000)] + [(7, f"{i} " + "word " * 9, "one") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert len(got) == 3 and all(abs(r.taken - r.target) <= 10 for r in got)
    assert mixing.repeat(docs).count() == sum(r.taken for r in got) / 10
    write_table(spark, docs, tmp_path)
    assert spark_rows(queries.op8_mixing(spark, str(tmp_path))) == duck_rows(sql.OP8_MIXING, str(tmp_path))


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_queries_like_their_sql(spark, small, name):
    assert spark_rows(queries.queries()[name](spark, small)) == duck_rows(sql.oracle_sql()[name], small)


def test_other_queries_cover_their_tables(spark, small):
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    for name, query in queries.queries().items():
        if name not in sql.oracle_sql():
            rows = query(spark, small).collect()
            assert len(rows) == n or name == "op3_decontamination", name
    leaks = {r.doc_id for r in queries.op3_decontamination(spark, small).collect()}
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    docs = {r.doc_id: " ".join(r.text.lower().split()) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    verbatim = {k for k, t in docs.items() if any(i in t for i in items)}
    assert verbatim <= leaks and len(leaks) <= len(verbatim) + 3


def spark_hash(value, *words):
    """Spark's xxhash64 of a long (or null) and of texts behind it."""
    h = 42 if value is None else xxhash.xxh64_intdigest(struct.pack("<q", value), 42)
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), h)
    return h


def test_stages_like_brute_force(spark, small):
    """Each stage of the pipeline on its own input, against a plain version of it: SQL cannot express them."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    at = {c: i for i, c in enumerate(docs.columns)}
    text = lambda r: r[at["text"]] or ""
    # Quality: what the model scores, row by row.
    model = ordinal_quality.fit(ordinal_quality.graded(docs, spark.read.parquet(f"{small}/labels.parquet")))
    kept = [tuple(r) for r in corpus_pipeline.quality(spark, docs, small).collect()]
    tails = np.round(model.tails(pa.array([text(r) for r in rows])), 6)
    assert sorted(kept, key=repr) == sorted((r for r, t in zip(rows, tails, strict=True) if t[0] >= 0.25), key=repr)
    # Near copies: all pairs of fingerprints.
    single = [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, small).collect()]
    prints = np.array([simhash.fingerprint(text(r), 5, 4) for r in rows])
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := text(r).encode().lower().split()) else set() for r in rows]
    first = {}
    for i in sorted(range(len(rows)), key=lambda i: rows[i][at["doc_id"]]):
        close = [j for j in first if np.bitwise_count(prints[i] ^ prints[j]).sum() <= 51]
        if not any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in close):
            first[i] = rows[i]
    assert sorted(single, key=repr) == sorted(first.values(), key=repr)
    # Benchmark: greedy tiles by the definition, over the items that share five words with a document.
    items = [words_of(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    runs = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    clean = [tuple(r) for r in corpus_pipeline.decontamination(spark, docs, small).collect()]
    want = []
    for r in rows:
        words = words_of(text(r))
        shared = [i for i in items if runs(i) & runs(words)]
        if not any(plain_tiles(near(words, i), i, 5) >= 0.5 * len(i) for i in shared):
            want.append(r)
    assert sorted(clean, key=repr) == sorted(want, key=repr)
    # Mixing: the plain targets are met, and documents come as often as the table of all of them says.
    mixed = [tuple(r) for r in corpus_pipeline.mixture(spark, docs, small).collect()]
    sizes = {}
    for r in rows:
        sizes[r[at["source"]]] = sizes.get(r[at["source"]], 0) + len(text(r).split())
    longest = max(len(text(r).split()) for r in rows)
    for s, target in plain_targets(sizes).items():
        assert abs(sum(len(text(r).split()) for r in mixed if r[at["source"]] == s) - target) <= longest
    # Sharding: the largest hash of key and shard; slots without gaps.
    dealt = corpus_pipeline.shards(spark, docs, small).collect()
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    assert all(r.shard == max(range(24), key=lambda j: signed(spark_hash(r.doc_id, f"shard-{j}"))) for r in dealt)
    for s in range(24):
        assert sorted(r.slot for r in dealt if r.shard == s) == list(range(sum(r.shard == s for r in dealt)))
    assert sorted((tuple(r)[: len(docs.columns)] for r in dealt), key=repr) == sorted(rows, key=repr)


def near(words, item):
    """The words that a run of five of the item covers, with a mark for what lies between."""
    wanted = {tuple(item[i : i + 5]) for i in range(len(item) - 4)}
    held = set()
    for i in range(len(words) - 4):
        if tuple(words[i : i + 5]) in wanted:
            held |= set(range(i, i + 5))
    return [w if i in held else None for i, w in enumerate(words) if i in held or i - 1 in held]


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], small).cache())
    for before, after in zip(steps[:-2], steps[1:-1], strict=True):
        assert after.columns == before.columns
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in steps]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    poor = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").filter("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").filter("quality = 1").collect()}
    assert len(poor & ids[1]) <= 0.1 * len(poor) and len(good - ids[1]) <= 0.05 * len(good)
    texts = [r.text for r in steps[2].select("text").collect()]
    assert len(texts) == len(set(texts))
    assert steps[-1].groupBy("doc_id").count().filter("count > 3").count() == 0
    assert corpus_pipeline.run(spark, small).count() == steps[-1].count()
