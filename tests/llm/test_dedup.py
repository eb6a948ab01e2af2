"""SimHash: fingerprints, bit-sliced comparison, keys, groups, against brute force."""

import random
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mailposture.llm import common, simhash
from mailposture.llm.components import components
from tests.llm.fixtures import SCHEMA, documents, prose


def plain_fingerprint(text, k=4):
    raw = (text or "").encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_groups(rows, radius):
    """{row index: smallest id} of (id, fingerprint) rows."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [least.get(find(i)) if rows[i][0] is not None else None for i in range(len(rows))]


def test_fingerprints_and_groups(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = simhash.groups(simhash.fingerprints(docs), 4).collect()
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    assert sorted(((r.doc_id is None, r.doc_id, r.fp[0] % (1 << 64)) for r in got), key=repr) == sorted(((k is None, k, f) for k, f in prints), key=repr)
    want = plain_groups([p for p in prints if p[0] is not None], 4)
    have = sorted((r.doc_id, r.fp[0] % (1 << 64), r.component) for r in got if r.doc_id is not None)
    assert have == sorted((k, f, c) for (k, f), c in zip([p for p in prints if p[0] is not None], want, strict=True))
    assert simhash.groups(simhash.fingerprints(docs.limit(0)), 4).count() == 0


def planted(n=400, seed=8):
    """Fingerprints with clusters around a few centres, chains included."""
    rng = random.Random(seed)
    out = []
    centres = [rng.getrandbits(64) for _ in range(6)]
    for i in range(n):
        if i % 3 == 0:
            f = rng.getrandbits(64)
        else:
            f = rng.choice(centres)
            for b in rng.sample(range(64), rng.randint(0, 5)):
                f ^= 1 << b
        out.append((i, f))
    return out


@pytest.mark.parametrize("tile", [2048, 7])
def test_groups_like_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", tile)
    rows = planted()
    signed = [(k, [f - (1 << 64) if f >> 63 else f]) for k, f in rows]
    prints = spark.createDataFrame(signed, "doc_id long, fp array<long>")
    linked = simhash.links
    monkeypatch.setattr(simhash, "links", lambda folded, keys, radius, lanes: linked(folded, keys, radius, lanes, tile))
    got = {r.doc_id: r.component for r in simhash.groups(prints, 4).collect()}
    assert [got[k] for k, _ in rows] == plain_groups(rows, 4)


def test_block_keys_are_complete():
    rng = random.Random(1)
    for rows in (1000, 10**8, 10**10):
        keys = simhash.block_keys(64, 4, rows)
        for _ in range(300):
            flipped = set(rng.sample(range(64), 4))
            assert any(not flipped & set(k) for k in keys)


def test_close_pairs_like_popcount():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 2**63, (150, 2), dtype=np.int64).view(np.uint64)
    fps[50:100] = fps[0]
    fps[50:100, 1] ^= np.uint64(1) << rng.integers(0, 8, 50).astype(np.uint64)
    group = np.sort(rng.integers(0, 4, 150))
    for radius in (0, 1, 4, 60):
        pairs = {(int(a), int(b)) for x, y in simhash.close_pairs(fps, group, radius) for a, b in zip(x, y, strict=True)}
        want = {(i, j) for i in range(150) for j in range(i + 1, 150) if group[i] == group[j] and int(np.bitwise_count(fps[i] ^ fps[j]).sum()) <= radius}
        assert pairs == want


def test_keep_first_drops_near_copies(spark):
    rng = random.Random(6)
    rows = []
    for i in range(40):
        rows.append((i, prose(rng, "en", 150)))
    for i in range(10):
        words = rows[i][1].split()
        words[rng.randrange(150)] = "changed"
        rows.append((100 + i, " ".join(words)))
    other, lone = prose(rng, "fr", 150), prose(rng, "de", 150)
    # Equal rows; a second text of an id; copies without an id, of a text with and of one without.
    rows += [(200, rows[0][1]), (20, rows[20][1]), (300, None), (301, ""), (21, other), (None, rows[3][1]), (None, lone), (None, lone)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in simhash.keep_first(docs).collect()]
    assert sorted(kept, key=repr) == sorted([*rows[:40], (300, None), (21, other), (None, lone)], key=repr)
    assert simhash.keep_first(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="exist"):
        simhash.keep_first(docs.withColumn("_key", docs.doc_id))


@pytest.mark.parametrize("pairs", [60, 300])
def test_near_copies_link_at_every_table_size(spark, pairs):
    """Pairs of Jaccard similarity 0.8 against brute force, in tables of two sizes."""
    rng = random.Random(21)
    new = lambda n: " ".join(f"w{rng.getrandbits(40):x}" for _ in range(n))
    rows = []
    for i in range(pairs):
        same = new(250)  # 246 shingles in common, 30 own ones on each side
        rows += [(2 * i, f"{same} {new(30)}"), (2 * i + 1, f"{same} {new(30)}")]
    prints = [simhash.fingerprint(t, 5, 4) for _, t in rows]
    close = {2 * i + 1 for i in range(pairs) if np.bitwise_count(prints[2 * i] ^ prints[2 * i + 1]).sum() <= 51}
    assert len(close) > 0.93 * pairs
    kept = {r.doc_id for r in simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k for k, _ in rows} - kept == close


def candidate_groups(prints):
    """Of each folded document the smallest node that candidates reach."""
    folded = simhash.folded_prints(prints)
    reached = {r.node: r.component for r in components(simhash.candidates(folded, 51, 4)).collect()}
    return {r.first.doc_id: reached.get(r.node, r.node) for r in folded.collect()}


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_only_what_resembles_a_kept_text_goes(spark):
    """A chain of drifting texts and a template with many fillings, against the exact similarities of all pairs."""
    rng = random.Random(8)
    word = lambda: f"w{rng.getrandbits(40):x}"
    rows, words = [], [word() for _ in range(200)]
    for i in range(30):  # neighbours resemble one another, distant ones do not
        rows.append((i, " ".join(words)))
        words[6 * i : 6 * i + 6] = [word() for _ in range(6)]
    frame = [word() for _ in range(190)]
    for i in range(100, 140):  # 0.7 by template
        rows.append((i, " ".join(frame + [word() for _ in range(40)])))
    kept = {r.doc_id for r in simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    for k, t in rows:
        near = [j for j in kept if j < k and jaccard(text[j], t) >= 0.8]
        assert (k in kept) == (not near)
    assert set(range(100, 140)) <= kept and 1 < len(kept & set(range(30))) < 30


def first_independent(nodes, edges):
    """The nodes without an edge (a, b), b < a, to one that stays itself."""
    stays = set()
    for k in sorted(nodes):
        if not any(b in stays for a, b in edges if a == k):
            stays.add(k)
    return stays


def test_texts_just_below_the_threshold_need_few_rounds(spark, monkeypatch):
    """Of many texts, each 0.77 alike to each other, all stay but copies; the work does not grow by a round a text."""
    rng = random.Random(4)
    new = lambda n: [f"w{rng.getrandbits(40):x}" for _ in range(n)]
    frame, rows = new(300), []
    for i in range(30):
        words = frame + new(44)
        rows.append((2 * i, " ".join(words)))
        if i % 3 == 0:
            rows.append((2 * i + 1, " ".join([*words[:-3], *new(3)])))
    assert 0.74 < jaccard(rows[0][1], rows[-1][1]) < 0.8 < jaccard(rows[0][1], rows[1][1])
    cuts, cut = [], simhash.cut
    monkeypatch.setattr(simhash, "cut", lambda df: cuts.append(1) or cut(df))
    monkeypatch.setattr(simhash, "FIRST", 2, raising=False)
    kept = {r.doc_id for r in simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {2 * i for i in range(30)}
    assert len(cuts) < 40


@pytest.mark.parametrize(("tile", "first"), [(2048, 3), (7, 3), (2048, 1000)])
def test_near_pairs_or_late(spark, tile, first):
    """Each pair that is near is found, or both of its nodes are named as having others; nothing else is found."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(90):
        sketch = np.full(512, 1 + i % 2, np.uint8)
        sketch[rng.choice(512, 40, replace=False)] = 9
        rows.append((i, [0, sum(1 << int(b) for b in rng.choice(62, 2, replace=False))], [int(i % 5), *(1000 * i + 10 + np.arange(simhash.BANDS - 1)).tolist()], bytearray(sketch.tobytes())))
    left = spark.createDataFrame(rows, "node long, fp array<long>, bands array<long>, sketch binary")
    found = simhash.near_pairs(left, 3, 2, first, tile).distinct().collect()
    pairs, late = {(r.a, r.b) for r in found if r.b is not None}, {r.a for r in found if r.b is None}
    near = {(i, j) for i in range(90) for j in range(i) if (rows[i][1][1] ^ rows[j][1][1]).bit_count() <= 3 and i % 2 == j % 2}
    assert pairs <= near and all((i, j) in pairs or {i, j} <= late for i, j in near)
    assert late <= {k for p in near for k in p}
    assert bool(late) == (first < 90) and len(pairs) > 10


def test_settled_like_one_by_one(spark, monkeypatch):
    """What is decided does not depend on the edges that are not known yet, and is all if there are none."""
    monkeypatch.setattr(common, "HOT_LEAST", 5)
    rng = random.Random(12)
    edges = {(a, b) for a, b in ((rng.randrange(120), rng.randrange(120)) for _ in range(200)) if b < a} | {(a, 3) for a in range(40, 70)}
    frame = lambda rows, schema: spark.createDataFrame(sorted(rows), schema)
    gone, open_ = ({r.node for r in part.collect()} for part in simhash.settle(frame(edges, "a long, b long"), frame([], "node long")))
    assert gone == set(range(120)) - first_independent(range(120), edges) and not open_
    late = set(range(5, 120, 9))
    gone, open_ = ({r.node for r in part.collect()} for part in simhash.settle(frame(edges, "a long, b long"), frame([(k,) for k in late], "node long")))
    assert gone and late - gone <= open_ and not gone & open_
    for seed in range(20):
        more = {(max(p), min(p)) for p in (random.Random(seed).sample(sorted(late), 2) for _ in range(10))}
        stays = first_independent(range(120), edges | more)
        assert not gone & stays and set(range(120)) - gone - open_ <= stays


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_recall_against_all_pairs(spark, folder):
    """Of all pairs of given documents within the radius, with an id divisible by 100 on one side, 0.9 are in one group."""
    path = Path(f"/root/testdata/{folder}/documents.parquet")
    if not path.exists():
        pytest.skip("test tables are not here")
    docs = spark.read.parquet(str(path)).select("doc_id", "text")
    prints = simhash.fingerprints(docs, 5, 4, bands=True)
    got = candidate_groups(prints)
    rows = [(r.doc_id, np.array(r.fp)) for r in prints.filter(F.col("doc_id").isin(list(got))).collect()]
    ids, fps = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    found = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        for i in np.flatnonzero(np.bitwise_count(fps ^ fps[q]).sum(1) <= 51):
            total += i != q
            found += i != q and got[ids[i]] == got[ids[q]]
    assert found >= 0.9 * total


def test_equal_fingerprints_keep_all_their_bands(spark):
    """A text is found by its own bands also where another text of the same fingerprint stands for it."""
    a, b = [1, 2, 3, 4], [1, 2, 3, 4]
    c = [x ^ 0xFFF for x in a]  # 48 bits
    bands = lambda start: list(range(start, start + simhash.BANDS))
    rows = [(1, a, bands(0)), (2, b, bands(1000)), (3, c, bands(1000)), (4, a, bands(0)), (5, c, bands(2000)), (6, [~x for x in a], bands(0))]
    prints = spark.createDataFrame(rows, "doc_id long, fp array<long>, bands array<long>")
    got = candidate_groups(prints)
    assert got.keys() == {1, 2, 3, 5, 6} and len({got[i] for i in (1, 2, 3, 5)}) == 1 and got[6] != got[1]


def test_components_with_a_hot_node(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_LEAST", 20)
    rng = random.Random(3)
    links = [(0, i) for i in range(1, 300)] + [(900, i) for i in range(600, 700)] + [(500 + i, 500 + i + 1) for i in range(60)] + [(rng.randrange(300), 900)]
    want = {**dict.fromkeys([*range(300), *range(600, 700), 900], 0), **dict.fromkeys(range(500, 561), 500)}
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tiles_of_a_hot_key(spark):
    """All fingerprints share a key and lie near one another; tiles grow with the key, links stay complete."""
    rng = random.Random(5)
    rows = [(i, [sum(1 << b for b in rng.sample(range(40), 6))]) for i in range(700)]
    folded = spark.createDataFrame(rows, "node long, fp array<long>")
    found = simhash.links(folded, [list(range(45, 60))], 4, 1, 50)
    root = {r.node: r.component for r in components(found).collect()}
    want = plain_groups([(i, f[0]) for i, f in rows], 4)
    assert [root.get(i, i) for i, _ in rows] == want
