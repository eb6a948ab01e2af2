"""SimHash near-dedup with bit-sliced comparison.

Fingerprint: a bit is 1 if it is set in over half of the hashes of the text's word shingles. Two documents link if
their fingerprints differ in at most ``radius`` bits; a group is what links reach.

Equal fingerprints are folded to one row first, so copies never meet one another. Candidates share a key. With a small
radius the keys are bits of the fingerprint and complete: the bits are parted into blocks, two fingerprints within the
radius agree in at least ``agree`` blocks, and every choice of ``agree`` blocks is a key, so that no link is lost. With
a large radius (wide fingerprints) no complete set is affordable: there the keys are MinHash bands of the same shingles
(``BANDS`` keys of ``BAND_ROWS`` minima each). Their number does not depend on the table, so that two documents link in
a large table if they do in a small one. They miss a pair of Jaccard similarity 0.8 with probability 3e-5, and one of
0.68, whose fingerprints differ in a fifth of the bits on average, with 0.008. Fingerprints of that radius also bring
together texts of a similarity of 0.6, so ``keep_first`` compares the shingle sets of its candidates.

Fingerprints that share a key are compared bit-sliced: 64 of them lie vertically in one word for each bit of the
fingerprint; XOR with a query's bit gives 64 differences at once, carry-save counters add them up, and a block is
abandoned as soon as all its counters have exceeded the radius. From each comparison only a spanning forest of links
leaves the task, never all pairs; ``keep_first`` goes on with the pairs of a few nodes of each key. Keys with very many
fingerprints are parted into tiles, and each pair of tiles is compared apart, so that no task needs more than two tiles
at once. Tiles grow with the key up to MOST_TILE rows; until then a fingerprint is copied MOST_TILES times at most.

Nulls and texts without a word have fingerprint zero, linked like any other. In ``groups``, documents with equal ids
are one node for each fingerprint they have. Empty tables give no rows. Texts are read whole, in bounded steps. Other
columns are ignored by ``fingerprints``, unless named, and kept by ``keep_first``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from mailposture.llm.common import GOLDEN, cut, hot_join, mix
from mailposture.llm.components import components

SEED = 42
#: Shingles hashed at a time; pairs of (query, block of 64) compared at a time.
STEP, PAIRS = 1 << 15, 1 << 14
#: Fingerprints of a key in one tile at least and at most, and tiles of a key that are aimed at.
TILE, MOST_TILE, MOST_TILES = 2048, 1 << 18, 64
#: Fingerprints that are spread over their keys at a time, and the most hot keys that are broadcast.
KEYED_ROWS, HOT_KEYS = 2000, 50_000
#: Mean number of fingerprints of one key that is aimed at.
OCCUPANCY = 1024
#: Texts whose shingle sets leave a task at a time, and parts over which the partners of one text are dealt.
SET_ROWS, SET_SALTS = 64, 256
#: The first nodes of a key that meet all others of it, and how many times as many do in each further round.
FIRST, MORE_FIRST = 8, 8
#: Bins of a sketch (a byte each), the share that must agree (0.8 less over three standard deviations), pairs at a time.
SKETCH_BITS, SKETCH_SHARE, SKETCH_PAIRS = 9, 0.74, 8192
#: MinHash bands of a text, the minima in each, and shingles that meet all permutations at a time.
BANDS, BAND_ROWS, MIN_STEP = 20, 4, 1024


# ---------------------------------------------------------------- fingerprints


_RANDOM = np.random.default_rng(17).integers(0, 1 << 63, (2, BANDS * BAND_ROWS, 1)).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def new_minima() -> np.ndarray:
    """The minima of no shingles."""
    return np.full(BANDS * BAND_ROWS, ~np.uint64(0))


def add_minima(minima: np.ndarray, h: np.ndarray) -> None:
    """Lower each minimum to that of its permutation of the hashes."""
    for i in range(0, len(h), MIN_STEP):
        np.minimum(minima, ((h[i : i + MIN_STEP] ^ _RANDOM[0]) * _RANDOM[1]).min(axis=1), out=minima)


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key of each band: its number and its minima, mixed."""
    rows = minima.reshape(BANDS, BAND_ROWS)
    out = mix(np.arange(1 << 32, (1 << 32) + BANDS, dtype=np.uint64))  # apart from the numbers of other keys
    for j in range(BAND_ROWS):
        out = mix(out ^ rows[:, j])
    return out


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the space-joined shingles of ``words`` words of the A-Z lower-cased text, in bounded steps.

    Fewer words are one shingle; no words have none.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # splits at \x20 and \x09-\x0D
    if not parts:
        return
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(parts) - words + 1)
    last = ends[words - 1 :] if len(parts) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, STEP):
        spans = zip(starts[i : min(i + STEP, n)].tolist(), last[i : i + STEP].tolist(), strict=True)
        yield np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, min(STEP, n - i))


def fingerprint(text: str | None, words: int, lanes: int = 1, minima: np.ndarray | None = None) -> np.ndarray:
    """``lanes`` 64-bit words: the SimHash of the shingles of ``words`` words of the A-Z lower-cased text.

    The first lane uses the shingles' hashes; further lanes mix that hash anew. ``minima``, if given, are lowered to
    those of the shingles.
    """
    counts, n = np.zeros((lanes, 64), np.int64), 0
    for h in shingle_hashes(text, words):
        n += len(h)
        if minima is not None:
            add_minima(minima, h)
        for lane in range(lanes):
            counts[lane] += bit_counts(h if lane == 0 else mix(h + np.uint64(lane * int(GOLDEN) % (1 << 64))))
    bits = (2 * counts > n).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_BASE = (np.arange(8) * 256).astype(np.int64)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit values have each bit set, least bit first."""
    cells = np.bincount((h.view(np.uint8).reshape(-1, 8) + _BYTE_BASE).ravel(), minlength=2048).reshape(8, 256)
    return (cells @ _BYTE_BITS).ravel()


def fingerprints(docs: DataFrame, words: int = 4, lanes: int = 1, key: str = "doc_id", text: str = "text", bands: bool = False, others: tuple[str, ...] = ()) -> DataFrame:
    """(key, others, fp): fp is an array of ``lanes`` longs. With ``bands`` also the keys of the MinHash bands, as longs."""
    kept = docs.select(key, *others, text)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, banded = [], []
            for t in batch.column(batch.num_columns - 1):
                minima = new_minima() if bands else None
                found.append(fingerprint(t.as_py(), words, lanes, minima).view(np.int64))
                if bands:
                    banded.append(band_keys(minima).view(np.int64))
            columns = [pa.array(c, pa.list_(pa.int64())) for c in ([found, banded] if bands else [found])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *(["fp", "bands"] if bands else ["fp"])])

    schema = kept.drop(text).schema
    for name in ["fp", "bands"] if bands else ["fp"]:
        schema = type(schema)([*schema.fields]).add(name, ArrayType(LongType()))
    return kept.mapInArrow(hashed, schema)


# ---------------------------------------------------------------- candidate keys


def block_keys(bits: int, radius: int, rows: int) -> list[list[int]]:
    """Bit positions of complete keys: fingerprints within ``radius`` agree in all bits of at least one key."""
    for agree in range(1, 5):
        blocks = radius + agree
        edges = [bits * i // blocks for i in range(blocks + 1)]
        parts = [list(range(a, b)) for a, b in itertools.pairwise(edges)]
        keys = [sum(c, []) for c in itertools.combinations(parts, agree)]
        if rows / 2.0 ** min(map(len, keys)) <= OCCUPANCY or len(keys) > 40:
            break
    return keys


def key_values(fps: np.ndarray, keys: list[list[int]]) -> np.ndarray:
    """For each row of fingerprints and each key: the number of the key and its bits, mixed into one 64-bit value."""
    out = np.empty((len(fps), len(keys)), np.uint64)
    for t, positions in enumerate(keys):
        bits = np.zeros(len(fps), np.uint64)
        for p in positions:
            bits = (bits << np.uint64(1)) | (fps[:, p // 64] >> np.uint64(p % 64)) & np.uint64(1)
        out[:, t] = mix(bits + np.uint64((t + 1) * int(GOLDEN) % (1 << 64)))
    return out


def fingerprint_rows(column: pa.ChunkedArray, lanes: int) -> np.ndarray:
    """A column of fingerprints as a numpy table of words."""
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).view(np.uint64).reshape(-1, lanes)


# ---------------------------------------------------------------- bit-sliced comparison


def close_pairs(fps: np.ndarray, group: np.ndarray, radius: int, begin: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of rows with equal ``group`` that differ in at most ``radius`` bits, in steps.

    fps: a row of 64-bit words each; equal groups must be adjacent. begin: the first row that each row is compared
    with (the next one if not given).
    """
    n, lanes = fps.shape
    words = (n + 63) // 64
    padded = np.zeros((words * 64, lanes), np.uint64)
    padded[:n] = fps
    # planes[b, w]: bit b of the 64 fingerprints of block w, one fingerprint in each bit of the word
    bits = np.unpackbits(padded.view(np.uint8).reshape(words * 64, lanes * 8), axis=1, bitorder="little")
    planes = np.packbits(bits.reshape(words, 64, lanes * 64), axis=1, bitorder="little").transpose(2, 0, 1)
    planes = np.ascontiguousarray(planes).view(np.uint64).reshape(lanes * 64, words)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    ends = np.concatenate([starts[1:], [n]])
    end = np.repeat(ends, ends - starts)
    begin = np.arange(1, n + 1) if begin is None else begin
    first = begin // 64
    blocks = np.where(end > begin, (end - 1) // 64 - first + 1, 0)
    upto = np.cumsum(blocks)
    for q in range(0, int(upto[-1]), PAIRS):
        place = np.arange(q, min(q + PAIRS, int(upto[-1])))
        query = np.searchsorted(upto, place, "right")
        x, y = _compare(fps, planes, query, first[query] + place - (upto - blocks)[query], begin, end, radius)
        if len(x):
            yield x, y


def _below(count: np.ndarray) -> np.ndarray:
    """Words whose lowest ``count`` bits (0 to 64) are set."""
    full = count >= 64
    return np.where(full, ~np.uint64(0), (np.uint64(1) << np.where(full, 0, count).astype(np.uint64)) - np.uint64(1))


def _compare(fps: np.ndarray, planes: np.ndarray, query: np.ndarray, block: np.ndarray, begin: np.ndarray, end: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    base = block * 64
    live = _below(np.clip(end[query] - base, 0, 64)) & ~_below(np.clip(begin[query] - base, 0, 64))
    width = (radius + 1).bit_length()
    # Counters start so that exceeding the radius carries out of the top counter.
    counters = [np.full(len(query), ~np.uint64(0) if ((1 << width) - 1 - radius) >> k & 1 else 0, np.uint64) for k in range(width)]
    for b in range(planes.shape[0]):
        flip = -((fps[query, b // 64] >> np.uint64(b % 64)) & np.uint64(1))
        carry = planes[b][block] ^ flip
        for k in range(width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        live &= ~carry
        if b % 8 == 7:
            keep = np.flatnonzero(live)
            if len(keep) == 0:
                return keep, keep
            if len(keep) < 0.7 * len(live):
                query, block, live = query[keep], block[keep], live[keep]
                counters = [c[keep] for c in counters]
    lanes = np.unpackbits(live.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(lanes)
    return query[at], block[at] * 64 + lane


def forest(pairs: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """The smallest index that the pairs reach from each of n indices."""
    root = np.arange(n)
    for x, y in pairs:
        while True:
            a, b = root[x], root[y]
            open_ = a != b
            if not open_.any():
                break
            x, y = x[open_], y[open_]
            np.minimum.at(root, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
            while not (root[root] == root).all():
                root = root[root]
    return root


def agreeing(pairs: Iterator[tuple[np.ndarray, np.ndarray]], sketches: np.ndarray, early: np.ndarray, late: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs with an ``early`` index whose sketches agree in SKETCH_SHARE of the bins that either fills.

    The indices of other such pairs are marked in ``late``; pairs of marked ones need no look.
    """
    for x, y in pairs:
        for i in range(0, len(x), SKETCH_PAIRS):
            a, b = x[i : i + SKETCH_PAIRS], y[i : i + SKETCH_PAIRS]
            first = early[a] | early[b]
            looked = first | ~(late[a] & late[b])
            a, b, first = a[looked], b[looked], first[looked]
            one, other = sketches[a], sketches[b]
            filled = ((one | other) != 0).sum(1)
            near = ((one == other) & (one != 0)).sum(1) >= SKETCH_SHARE * filled
            late[a[near & ~first]] = late[b[near & ~first]] = True
            yield a[near & first], b[near & first]


# ---------------------------------------------------------------- links and groups


def units(folded: DataFrame, keys: list[list[int]], lanes: int, tile: int = TILE) -> DataFrame:
    """(node, fp, sketch if there, own, tiles, u, mixed): the nodes of ``folded`` (node, fp) by unit u, sorted by unit, tile and node.

    A unit has all nodes of a key, or those of one or two (mixed) of its ``tiles``; own is the node's tile. ``bands`` of
    ``folded``, if it has them, are keys beside those of the fingerprint.
    """
    banded = "bands" in folded.columns
    more = ["sketch"] if "sketch" in folded.columns else []

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = pa.Table.from_batches([batch])
            for part in (held.slice(i, KEYED_ROWS) for i in range(0, held.num_rows, KEYED_ROWS)):
                values = key_values(fingerprint_rows(part.column("fp"), lanes), keys).view(np.int64)
                if banded:
                    values = np.concatenate([values, fingerprint_rows(part.column("bands"), BANDS).view(np.int64)], axis=1)
                rows = part.select(["node", "fp", *more]).combine_chunks().take(np.repeat(np.arange(part.num_rows), values.shape[1]))
                yield from rows.append_column("k", pa.array(values.ravel())).to_batches()

    keyed = folded.select("node", "fp", *more, *(["bands"] if banded else [])).mapInArrow(keys_of, f"node bigint, fp array<bigint>, {'sketch binary, ' if more else ''}k bigint")
    # Only keys with more than a tile of fingerprints need dealing; there are few, if any.
    size = F.least(F.greatest(F.lit(tile), F.ceil(F.col("n") / MOST_TILES)), F.lit(max(tile, MOST_TILE)))
    hot = cut(keyed.groupBy("k").agg(F.count("*").alias("n")).filter(F.col("n") > tile).select("k", F.ceil(F.col("n") / size).cast("int").alias("tiles")))
    few = hot.limit(HOT_KEYS + 1).count()
    if few == 0:
        dealt = keyed.select("node", "fp", *more, F.lit(0).alias("own"), F.lit(1).alias("tiles"), F.col("k").alias("u"), F.lit(False).alias("mixed"))
    else:
        tiled = keyed.join(F.broadcast(hot) if few <= HOT_KEYS else hot, "k", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        tiled = tiled.withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        # A tile pair (low, high) is a task's unit: own tile with every tile, itself included.
        pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("lo"), F.greatest(o, F.col("own")).alias("hi"))))
        dealt = tiled.select("node", "fp", *more, "own", "tiles", "k", pair.alias("p"))
        dealt = dealt.select("node", "fp", *more, "own", "tiles", F.xxhash64("k", "p.lo", "p.hi").alias("u"), (F.col("p.lo") != F.col("p.hi")).alias("mixed"))
    return dealt.repartition("u").sortWithinPartitions("u", "own", "node")


def whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of ``units`` in parts that hold the rows of a unit together; the last unit of a batch may go on in the next."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        rows = [] if rest is None else [rest]
        rows += [] if batch is None else [pa.Table.from_batches([batch])]
        if not rows:
            return
        held = pa.concat_tables(rows)
        unit = held.column("u").to_numpy()
        stop = len(unit) if batch is None else int(np.searchsorted(unit, unit[-1])) if len(unit) else 0
        rest = held.slice(stop)
        if stop:
            yield held.slice(0, stop).combine_chunks()


def compared(part: pa.Table, radius: int, lanes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``part``, whole units, that share a unit and lie within the radius."""
    unit = part.column("u").to_numpy()
    begin = first_compared(unit, part.column("own").to_numpy(), part.column("mixed").to_numpy())
    return close_pairs(fingerprint_rows(part.column("fp"), lanes), unit, radius, begin)


def links(folded: DataFrame, keys: list[list[int]], radius: int, lanes: int, tile: int = TILE) -> DataFrame:
    """(a, b): links between the nodes of ``folded`` (node, fp), enough to connect what is within the radius.

    Of what a key connects, each node is linked to the least one, b. ``bands`` of ``folded`` are keys as in ``units``.
    """

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_units(batches):
            node = part.column("node").to_numpy()
            root = forest(compared(part, radius, lanes), len(node))
            least = node.copy()
            np.minimum.at(least, root, node)
            at = np.flatnonzero(node != least[root])
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(least[root[at]])], ["a", "b"])

    return units(folded, keys, lanes, tile).drop("tiles").mapInArrow(linked, "a bigint, b bigint")


def near_pairs(left: DataFrame, radius: int, lanes: int, first: int, tile: int = TILE) -> DataFrame:
    """(a, b), b < a: pairs of ``left`` (node, fp, bands, sketch) within the radius that share a band or a lane and agree in
    their sketches, if one of the two is among the ``first`` nodes of a key; (a, null): nodes of which a key has other pairs.

    In a key of several tiles each tile has its part of the first nodes, one at least. Pairs repeat from key to key.
    """

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_units(batches):
            node = part.column("node").to_numpy()
            early = tile_places(part) < np.maximum(1, first // part.column("tiles").to_numpy())
            late = np.zeros(len(node), bool)
            sketches = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
            for x, y in agreeing(compared(part, radius, lanes), sketches, early, late):
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(node[x], node[y])), pa.array(np.minimum(node[x], node[y]))], ["a", "b"])
            others = node[late]
            yield pa.RecordBatch.from_arrays([pa.array(others), pa.nulls(len(others), pa.int64())], ["a", "b"])

    return units(left, [list(range(64))], lanes, tile).mapInArrow(paired, "a bigint, b bigint")


def tile_places(part: pa.Table) -> np.ndarray:
    """The place of each row, from 0, among the rows of its unit and tile, which are adjacent."""
    unit, own = part.column("u").to_numpy(), part.column("own").to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (own[1:] != own[:-1])]))
    return np.arange(len(unit)) - np.repeat(starts, np.diff(starts, append=len(unit)))


def first_compared(unit: np.ndarray, own: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """The first row that each row is compared with: the next one, or in a pair of tiles the other tile's first.

    Rows are sorted by unit and tile. Rows of the second tile begin no comparison.
    """
    n = len(unit)
    ends = np.concatenate([np.flatnonzero(unit[1:] != unit[:-1]) + 1, [n]])
    length = np.diff(ends, prepend=0)
    second = own == np.repeat(own[ends - 1], length)
    start = np.repeat(ends - np.add.reduceat(second, ends - length), length)
    return np.where(mixed, np.where(second, np.repeat(ends, length), start), np.arange(1, n + 1))


def groups(prints: DataFrame, radius: int, lanes: int = 1, key: str = "doc_id") -> DataFrame:
    """(key, fp, component): component is the smallest id that links reach from each row of (key, fp).

    ``key`` must hold longs. Keys of the search are complete.
    """
    prints = cut(prints)
    known = prints.filter(F.col(key).isNotNull())
    folded = cut(known.groupBy("fp").agg(F.min(key).alias("node"), F.count("*").alias("_n")))
    nodes, rows = folded.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    found = links(folded, block_keys(64 * lanes, radius, nodes), radius, lanes)
    # Ids that occur with several fingerprints are one node.
    several = cut(known.groupBy(key).agg(F.count("*").alias("_n"), F.min("fp").alias("one"), F.max("fp").alias("other")).filter("one <> other").select(key, "_n"))
    if not several.isEmpty():
        same = hot_join(known, several, [key], rows).distinct().join(folded.select("fp", "node"), "fp")
        found = found.union(same.select(F.col(key).alias("a"), F.col("node").alias("b")))
    reached = components(found)
    by_print = folded.join(reached, "node", "left").select("fp", "_n", F.coalesce("component", "node").alias("component"))
    out = hot_join(known, by_print, ["fp"], rows).select(key, "fp", "component")
    return out.unionByName(prints.filter(F.col(key).isNull()).select(key, "fp", F.lit(None).cast("long").alias("component")))


def folded_prints(prints: DataFrame) -> DataFrame:
    """``prints`` (fp, bands, ...) folded to one row for each fp and bands: (fp, bands, first, node).

    first: the least struct of the other columns; node: a number in the order of first.
    """
    others = [c for c in prints.columns if c not in ("fp", "bands")]
    folded = prints.groupBy("fp", "bands").agg(F.min(F.struct(*others)).alias("first"))
    return cut(folded.orderBy("first").withColumn("node", F.monotonically_increasing_id()))


def candidates(folded: DataFrame, radius: int, lanes: int) -> DataFrame:
    """(a, b), b < a, of nodes that share a band and are connected within the radius there, or share a fingerprint.

    Of what a band or a fingerprint connects, each node is paired with the least one.
    """
    equal = folded.groupBy("fp").agg(F.min("node").alias("b"), F.count("*").alias("_n"))
    same = hot_join(folded.select("fp", "node"), equal.filter("_n > 1"), ["fp"], folded.count()).filter("node <> b")
    return cut(links(folded, [], radius, lanes).union(same.select(F.col("node").alias("a"), "b")).distinct())


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, shingles, sketch), from (node, text): the distinct hashes of the shingles, and a byte of the least in each of
    512 ranges of them (0: none)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SET_ROWS):
                part = batch.slice(i, SET_ROWS)
                found = [np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_hashes(t.as_py(), words)])) for t in part.column(1)]
                sets = pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), sets, pa.array([sketch(h) for h in found], pa.binary())], ["node", "shingles", "sketch"])

    return texts.mapInArrow(hashed, "node bigint, shingles array<bigint>, sketch binary")


def sketch(h: np.ndarray) -> bytes:
    """One byte for each range of hashes: 0 if none lies there, else from the least of them. h must be sorted."""
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    bins, first = np.unique(h >> np.uint64(64 - SKETCH_BITS), return_index=True)
    out[bins.astype(np.int64)] = (h[first] % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    return out.tobytes()


def resembling(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose ``sets`` (node, shingles) have a Jaccard similarity of ``similarity`` or more.

    The set of a b is copied to at most SET_SALTS parts, over which its partners are dealt.
    """
    salted = pairs.withColumn("_salt", F.pmod(F.xxhash64("a"), F.lit(SET_SALTS)))
    theirs = salted.select("b", "_salt").distinct().join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("_b")), "b")
    both = salted.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("_a")), "a").join(theirs, ["b", "_salt"])
    shared = F.size(F.array_intersect("_a", "_b"))
    return both.filter(shared >= similarity * (F.size("_a") + F.size("_b") - shared)).select("a", "b")


def settle(edges: DataFrame, late: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gone, open), each (node): of the ``edges`` (a, b), b < a, what goes because a smaller neighbour stays, and what waits.

    A node stays if no smaller neighbour of it does. ``late`` (node) has nodes with further neighbours, of which only
    that they go can be decided here; what waits for them is open like them. Rounds see numbers of nodes alone.
    """
    edges, gone = cut(edges), []
    while True:
        rows = edges.count()
        counts = edges.groupBy("b").agg(F.count("*").alias("_n"))
        waiting = edges.select(F.col("a").alias("b")).union(late.select("node")).distinct()
        goes = cut(hot_join(edges, counts.join(waiting, "b", "left_anti"), ["b"], rows).select(F.col("a").alias("node")).distinct())
        if goes.isEmpty():
            break
        gone.append(goes)
        rest = edges.join(goes.withColumnRenamed("node", "a"), "a", "left_anti")
        edges = cut(hot_join(rest, counts.join(goes.withColumnRenamed("node", "b"), "b", "left_anti"), ["b"], rows).select("a", "b"))
    out = reduce(DataFrame.union, gone, late.limit(0))
    return out, late.union(edges.select("a")).distinct().join(out, "node", "left_anti")


def repeated(folded: DataFrame, texts: DataFrame, radius: int, lanes: int, words: int, similarity: float) -> DataFrame:
    """(node): the nodes that resemble a smaller one that is not itself among them.

    ``texts`` has the columns of ``first`` and the text, a row each. First each node meets the least one that its keys
    connect it with: a node without a smaller partner stays, and partners that resemble it go. What is left is compared
    pair by pair, if the sketches agree as well; a pair of similarity 0.8 is lost by that with a probability of 0.0005 at
    most. So that large groups are not expanded into all their pairs, only the FIRST nodes of a key meet all others, and
    MORE_FIRST times as many each time that others are left, so that the times grow with the logarithm of the largest key.
    """
    pairs = candidates(folded, radius, lanes)
    if pairs.isEmpty():
        return folded.select("node").limit(0)
    involved = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    named = folded.join(involved, "node").select("node", "first.*")
    on = [c for c in texts.columns if c in named.columns]
    sets = cut(shingle_sets(texts.join(named.select("node", *on), on).select("node", *[c for c in texts.columns if c not in on]), words))
    staying = pairs.groupBy("b").agg(F.count("*").alias("_n")).join(pairs.select(F.col("a").alias("b")), "b", "left_anti")
    tested = hot_join(pairs, staying, ["b"], pairs.count()).select("a", "b")
    gone = [cut(resembling(tested, sets, similarity).select(F.col("a").alias("node")).distinct())]
    open_ = pairs.select(F.col("a").alias("node")).distinct().join(gone[0], "node", "left_anti")
    left, first = folded.select("node", "fp", "bands").join(sets.select("node", "sketch"), "node"), FIRST
    while True:
        left = cut(left.join(open_, "node", "left_semi"))
        if left.isEmpty():
            return reduce(DataFrame.union, gone)
        found = cut(near_pairs(left, radius, lanes, first).distinct())
        late = found.filter("b IS NULL").select(F.col("a").alias("node"))
        goes, open_ = settle(resembling(found.filter("b IS NOT NULL"), sets, similarity), late)
        gone.append(goes)
        first *= MORE_FIRST


def keep_first(docs: DataFrame, words: int = 5, lanes: int = 4, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that resemble none with a smaller id that stays; of equal ids the smallest text hash comes first.

    A document goes only if the Jaccard similarity of its shingles and those of a document that stays is ``similarity``
    or more, by an exact comparison. Candidates agree in ``similarity`` of the fingerprint's bits or more and share a
    MinHash band, so that whether two documents meet does not depend on the table; texts of equal fingerprint and bands
    count as equal. A pair of Jaccard similarity 0.8 differs in 0.15 of the bits on average; its bits spread, and with
    probability 0.016 it lies beyond the radius and both stay. Texts without words resemble one another. Rows without an
    id come last. Different texts of one id are different documents; rows that repeat id and text are one.
    """
    same = {"_none": F.col(key).isNull(), "_name": F.coalesce(F.col(key).cast("string"), F.lit("")), "_content": F.xxhash64(text)}
    marks = {**same, "_key": F.col(key)}
    if clash := {*marks, "node"} & set(docs.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    marked = docs.withColumns(marks)
    folded = folded_prints(cut(fingerprints(marked, words, lanes, "_none", text, bands=True, others=("_key", "_content", "_name"))))
    # Repeated rows are combined where they are before a shuffle of the texts.
    single = marked.drop("_key").dropDuplicates(list(same))
    gone = repeated(folded, single.select(*same, text), int((1 - similarity) * 64 * lanes), lanes, words, similarity)
    first = folded.join(gone, "node", "left_anti")
    return single.join(first.select(*[f"first.{c}" for c in same]), list(same), "left_semi").select(docs.columns)


def as_hex(fp: Column) -> Column:
    """The first lane as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.get(fp, 0)), 16, "0"))
