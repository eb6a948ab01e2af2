"""Benchmark decontamination by greedy string tiling.

Texts become lower-case tokens (runs of letters and digits) with 64-bit hashes. A seed is a run of SEED_TOKENS
tokens; the seeds of all documents are joined with those of the benchmark items by running Karp-Rabin hashes. For
each (document, item) that shares a seed, the longest run of tokens that both have, and that is free in both, is
marked again and again until none as long as a seed is left. The length of the next run is found by bisection over
running Karp-Rabin hashes, all runs of that length are marked in the order of their places in the item, then in the
text. That takes memory for the tokens of the two texts alone, however often they repeat themselves. The marked tiles
do not overlap and may stand in any order, so passages that were cut up and reordered are caught. The share of the
item's tokens under tiles is its coverage; from ``coverage`` on the document is contaminated.

The benchmark is the stated query set: it is taken in blocks of bounded size, each sent to all tasks, which scan
every document whole. No document leaves its task; nothing is gathered by passage, however many share it. Null and
empty texts match nothing. An item with fewer tokens than a seed is compared whole: it leaks if the document, or one
of its lines, has the item's tokens and no others (somewhere within a sentence, so few words say nothing). Repeated
rows are each judged. Rows without ids are judged too (their pairs have a null id). Other columns are kept by
``decontaminate``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailposture.llm.common import WINDOW, byte_view, mix

SEED_TOKENS = 5
COVERAGE = 0.5
#: Bytes of benchmark text sent to the tasks at a time.
BLOCK_BYTES = 32_000_000
#: Hash base of bytes within a token (odd, so that it can be inverted), and of tokens within a run.
BYTE_BASE, TOKEN_BASE = 0x100000001B3, 0x9E3779B97F4A7C15
_FILTER_BITS = 22
#: (seed, item) pairs that are looked at in one step.
SPREAD = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Tokenizer:
    """Token hashes of Arrow text columns; keeps tables of powers."""

    up: np.ndarray = field(default_factory=lambda: _powers(BYTE_BASE, WINDOW * 2))
    down: np.ndarray = field(default_factory=lambda: _powers(pow(BYTE_BASE, -1, 1 << 64), WINDOW * 2))

    def _hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of the tokens of ``data``, which are parted by spaces."""
        n = len(data)
        if n > len(self.up):
            self.up, self.down = _powers(BYTE_BASE, n), _powers(pow(BYTE_BASE, -1, 1 << 64), n)
        inside = data != 32
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * self.up[:n], dtype=np.uint64)])
        return start, mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def column(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, token hashes, row of each token); a row is never parted, whatever its length."""
        clean = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{N}]+", " ")
        # A space at the end of each row keeps neighbours apart.
        data, offsets = byte_view(pc.binary_join_element_wise(clean, "", " "))
        row, n = 0, len(offsets) - 1
        while row < n:
            end_row = max(row + 1, int(np.searchsorted(offsets, offsets[row] + WINDOW, "right")) - 1)
            a, b = int(offsets[row]), int(offsets[end_row])
            starts, hashes = [], []
            while a < b:  # one step, or several for a very long row, each cut at a space
                e = b
                if b - a > 2 * WINDOW:
                    space = np.flatnonzero(data[a + WINDOW : b] == 32)
                    e = a + WINDOW + int(space[0]) + 1
                s, h = self._hashes(data[a:e])
                starts.append(s + a)
                hashes.append(h)
                a = e
            start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
            yield row, end_row, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.searchsorted(offsets, start, "right") - 1
            row = end_row


def run_hashes(tokens: np.ndarray, n: int) -> np.ndarray:
    """Running hash of each ``n`` tokens in a row."""
    if len(tokens) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(tokens) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(TOKEN_BASE) + tokens[k : k + len(h)]
    return mix(h)


@dataclass
class Block:
    """A block of benchmark items: tokens of all, where each begins, the distinct seeds and the items that have each."""

    ids: list
    tokens: np.ndarray
    bounds: np.ndarray
    seeds: np.ndarray  # sorted
    seed_at: np.ndarray  # for each token: the seed that begins there, or -1
    starts: np.ndarray  # for each seed: where its items begin in ``holders``
    holders: np.ndarray
    known: np.ndarray
    short: dict[tuple[int, ...], list[int]]  # tokens of each item without a seed

    @staticmethod
    def of(ids: list, texts: list[str | None]) -> Block:
        parts = [np.zeros(0, np.uint64) for _ in ids]
        for r0, r1, hashes, rows in Tokenizer().column(pa.array(texts, pa.string())):
            at = np.searchsorted(rows, np.arange(r0, r1 + 1))
            for r in range(r0, r1):
                parts[r] = hashes[at[r - r0] : at[r - r0 + 1]]
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        tokens = np.concatenate([*parts, np.zeros(0, np.uint64)])
        runs = [run_hashes(p, SEED_TOKENS) for p in parts]
        places = np.concatenate([b + np.arange(len(r)) for b, r in zip(bounds, runs, strict=False)] + [np.zeros(0, np.int64)]).astype(np.int64)
        seeds, number = np.unique(np.concatenate([*runs, np.zeros(0, np.uint64)]), return_inverse=True)
        seed_at = np.full(len(tokens), -1, np.int64)
        seed_at[places] = number
        pairs = np.unique(number * max(1, len(ids)) + np.searchsorted(bounds, places, "right") - 1)
        seed, holders = pairs // max(1, len(ids)), pairs % max(1, len(ids))
        known = np.zeros(1 << _FILTER_BITS, bool)
        known[seeds >> np.uint64(64 - _FILTER_BITS)] = True
        short = defaultdict(list)
        for i, p in enumerate(parts):
            if 0 < len(p) < SEED_TOKENS:
                short[tuple(p.tolist())].append(i)
        return Block(ids, tokens, bounds, seeds, seed_at, np.searchsorted(seed, np.arange(len(seeds) + 1)), holders, known, dict(short))

    def shared(self, runs: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in runs, seed) of every run that is a seed of some item."""
        if not len(self.seeds):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.known[runs >> np.uint64(64 - _FILTER_BITS)] & usable)
        seed = np.minimum(np.searchsorted(self.seeds, runs[maybe]), len(self.seeds) - 1)
        sure = self.seeds[seed] == runs[maybe]
        return maybe[sure], seed[sure]

    def pairs(self, rows: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        """Sorted numbers row * items + item of the pairs that share one of the (row, seed)."""
        distinct = np.unique(rows * len(self.seeds) + seeds)
        row, seed = distinct // len(self.seeds), distinct % len(self.seeds)
        n = self.starts[seed + 1] - self.starts[seed]
        upto = np.cumsum(n)
        found, a = np.zeros(0, np.int64), 0
        while a < len(row):  # in steps of about SPREAD pairs, one seed at least
            b = max(a + 1, int(np.searchsorted(upto, upto[a] - n[a] + SPREAD, "right")))
            many, total = n[a:b], int(n[a:b].sum())
            at = np.repeat(self.starts[seed[a:b]] - (np.cumsum(many) - many), many) + np.arange(total)
            found = np.union1d(found, np.repeat(row[a:b], many) * len(self.ids) + self.holders[at])
            a = b
        return found

    def tilings(self, texts: pa.Array, tokenizer: Tokenizer, least: float = 0.0) -> Iterator[tuple[int, int, list[tuple[int, int, int]], float]]:
        """(row, item, tiles, coverage) of every row and item that share a seed, or a whole item without one; tiles:
        (at in text, at in item, tokens). Pairs that cannot reach the coverage ``least`` are left out: every token of a tile
        is under a shared seed, so the item's tokens under shared seeds are the most that tiles can cover."""
        if self.short:
            yield from self._whole(texts, tokenizer)
        for _, _, hashes, rows in tokenizer.column(texts):
            runs = run_hashes(hashes, SEED_TOKENS)
            at, seed = self.shared(runs, rows[: len(runs)] == rows[SEED_TOKENS - 1 :])
            for pair in self.pairs(rows[at], seed).tolist():
                r, i = divmod(pair, len(self.ids))
                first, a, b = int(np.searchsorted(rows, r)), int(np.searchsorted(rows[at], r)), int(np.searchsorted(rows[at], r, "right"))
                lo, hi = int(self.bounds[i]), int(self.bounds[i + 1])
                under = np.flatnonzero(np.isin(self.seed_at[lo:hi], seed[a:b]))
                if (int(np.minimum(np.diff(under), SEED_TOKENS).sum()) + SEED_TOKENS) / (hi - lo) < least:
                    continue
                mine = at[a:b][np.isin(seed[a:b], self.seed_at[lo:hi])]
                place, tokens, used = covered(mine, hashes)
                tiles = [(int(place[t]) - first, p, n) for t, p, n in greedy_tiles(tokens, used, self.tokens[lo:hi])]
                yield r, i, tiles, sum(t[2] for t in tiles) / (hi - lo)

    def _whole(self, texts: pa.Array, tokenizer: Tokenizer) -> Iterator[tuple[int, int, list[tuple[int, int, int]], float]]:
        """Items without a seed whose tokens are those of a text or of one of its lines."""
        split = pc.split_pattern(texts, "\n")
        parent = pc.list_parent_indices(split).to_numpy()
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for column, owner in ((texts, np.arange(len(texts))), (split.flatten(), parent)):
            size, hits = np.zeros(len(column), np.int64), []
            for r0, r1, hashes, rows in tokenizer.column(column):
                n = np.bincount(rows - r0, minlength=r1 - r0)
                size[r0:r1], start = n, np.cumsum(n) - n
                for k in np.flatnonzero((n > 0) & (n < SEED_TOKENS)).tolist():
                    tokens = tuple(hashes[start[k] : start[k] + n[k]].tolist())
                    hits += [(r0 + k, i) for i in self.short.get(tokens, ())]
            before = np.cumsum(size) - size
            for k, i in hits:
                r = int(owner[k])
                found.setdefault((r, i), (int(before[k] - before[np.searchsorted(owner, r)]), 0, int(size[k])))
        yield from ((r, i, [tile], 1.0) for (r, i), tile in sorted(found.items()))


def covered(at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, token, used) of the tokens under the seeds that begin at the sorted places ``at``.

    Behind each stretch stands one token that counts as used, so that no run goes on over a gap.
    """
    edge = np.flatnonzero(np.diff(at) > SEED_TOKENS) + 1
    starts, ends = at[np.concatenate([[0], edge])], at[np.concatenate([edge - 1, [len(at) - 1]])] + SEED_TOKENS
    n = ends - starts + 1
    place = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    used = np.zeros(len(place), bool)
    used[np.cumsum(n) - 1] = True
    return place, hashes[np.minimum(place, len(hashes) - 1)], used


class Runs:
    """Running hashes of any length of one token sequence, and which runs are free."""

    def __init__(self, tokens: np.ndarray, used: np.ndarray) -> None:
        n = len(tokens)
        self.used = used
        self.up = _powers(TOKEN_BASE, n + 1)
        down = _powers(pow(TOKEN_BASE, -1, 1 << 64), n + 1)
        # sums[i] = tokens[0] * B**-0 + ... + tokens[i - 1] * B**-(i - 1), brought back to B**0 by ``up``
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * down[:n], dtype=np.uint64)])

    def hashes(self, n: int) -> np.ndarray:
        return (self.sums[n:] - self.sums[:-n]) * self.up[: len(self.sums) - n]

    def free(self, n: int) -> np.ndarray:
        """Places at which a run of ``n`` free tokens begins."""
        marked = np.concatenate([[0], np.cumsum(self.used)])
        return np.flatnonzero(marked[n:] == marked[:-n])


def greedy_tiles(tokens: np.ndarray, used: np.ndarray, item: np.ndarray) -> list[tuple[int, int, int]]:
    """Tiles (at in text, at in item, tokens): the longest free match goes first; ties go to the earliest place in the
    item, then in the text. ``used``: tokens of the text that no tile may take."""
    text, item = Runs(tokens, used.copy()), Runs(item, np.zeros(len(item), bool))
    tiles, most = [], min(len(tokens), len(item.used))
    while True:
        # Runs of one length that both have free are also there of any smaller length: bisect for the largest.
        low, high = SEED_TOKENS - 1, most
        while low < high:
            n = (low + high + 1) // 2
            both = np.intersect1d(text.hashes(n)[text.free(n)], item.hashes(n)[item.free(n)]).size
            low, high = (n, high) if both else (low, n - 1)
        if low < SEED_TOKENS:
            return tiles
        n = most = low
        here, hashes = text.free(n), text.hashes(n)
        order = np.argsort(hashes[here], kind="stable")
        here, value = here[order], hashes[here][order]
        wanted, places = item.hashes(n), item.free(n)
        places = places[np.isin(wanted[places], value)]
        lo, hi = np.searchsorted(value, wanted[places], "left").tolist(), np.searchsorted(value, wanted[places], "right").tolist()
        seen: dict[int, int] = {}  # what is not free of equal runs of the text stays so
        for p, a, b in zip(places.tolist(), lo, hi, strict=True):
            if item.used[p : p + n].any():
                continue
            k = seen.get(a, a)
            while k < b and text.used[here[k] : here[k] + n].any():
                k += 1
            seen[a] = k
            if k < b:
                t = int(here[k])
                text.used[t : t + n] = item.used[p : p + n] = True
                tiles.append((t, p, n))


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_bytes`` of text, dealt by hash."""
    items = benchmark.select(item, text).filter(F.length(text) > 0)
    total = items.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / block_bytes))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64(item, text), F.lit(n)) == k).collect()  # about block_bytes
        rows.sort(key=lambda r: (r[0] is None, r[0], r[1]))
        yield Block.of([r[0] for r in rows], [r[1] for r in rows])


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(key, item, coverage, tiles, contaminated = true): the pairs whose coverage reaches ``coverage``."""
    key_kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    tile = "struct<doc_at:int,item_at:int,tokens:int>"
    schema = f"`{key}` {key_kind}, `{item}` {item_kind}, coverage double, tiles array<{tile}>, contaminated boolean"
    found = None
    for block in blocks(benchmark, item, "text"):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def pairs(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            tokenizer, items = Tokenizer(), sent.value
            for batch in batches:
                rows = [(batch.column(0)[r].as_py(), items.ids[i], round(c, 6), [{"doc_at": t, "item_at": p, "tokens": n} for t, p, n in tiles], True) for r, i, tiles, c in items.tilings(batch.column(1), tokenizer, coverage) if c >= coverage]
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip((key, item, "coverage", "tiles", "contaminated"), r, strict=True)) for r in rows], _arrow(batch.schema.field(0).type, items.ids, key, item))

        part = docs.select(key, text).mapInArrow(pairs, schema)
        found = part if found is None else found.unionByName(part)
    return found


def _arrow(key_type: pa.DataType, ids: list, key: str, item: str) -> pa.Schema:
    tile = pa.struct([("doc_at", pa.int32()), ("item_at", pa.int32()), ("tokens", pa.int32())])
    return pa.schema([(key, key_type), (item, pa.array(ids).type), ("coverage", pa.float64()), ("tiles", pa.list_(tile)), ("contaminated", pa.bool_())])


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, text: str = "text", item: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that no benchmark item reaches ``coverage`` in, in one pass without a shuffle."""
    at = docs.columns.index(text)
    for block in blocks(benchmark, item, "text"):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            tokenizer, items = Tokenizer(), sent.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[r for r, _, _, c in items.tilings(batch.column(at), tokenizer, coverage) if c >= coverage]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
