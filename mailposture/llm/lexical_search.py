"""Ranked lexical search: a tree of restricted documents, searched depth first by branch and bound for each item.

Of a document only the terms count that some item has. They are put in order of their document frequency, rarest first,
so that documents share the beginnings of their paths in a trie; beginnings that nothing branches from are one node. A
node knows the largest frequency of each term and the least length ``m`` of all documents below it, which bound every
score below from above: the score grows with the frequency and falls with ``m``. An item is searched from the root, the
child of the highest bound first, and a branch whose bound is under the score of the item's last place so far is left
out. A leaf is one document, and its bound is its score, so nothing is approximate.

Trees are built in memory over some hundreds of documents of a partition, and the places found so far go from tree to
tree. Documents are not shuffled; a partition passes on the places of each item only. The items go to the tasks in
blocks of a bounded size.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Places of an item.
TOP = 20
#: Bytes of item texts in a block, cells (terms x nodes) of a tree and most documents of one.
BLOCK_BYTES, CELLS, TREE_DOCS = 4 << 20, 1 << 23, 2048
#: Parts in which the places of an item are cut before they meet.
PARTS = 64
#: Every byte that is not in a term becomes a blank, A-Z become small; bytes from 128 on are in terms.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

Item = tuple[np.ndarray, np.ndarray]


def terms(text: str) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats."""
    return text.encode().translate(LETTERS).split()


def shares(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a unit of weight counts for, in billionths, for frequency ``tf`` in a text of length ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Tree:
    """The trie over documents (ranks ascending, frequencies, m): arrays over nodes, in which siblings stand together."""

    def __init__(self, docs: list[tuple[list[int], list[int], int]]) -> None:
        order = sorted(range(len(docs)), key=lambda d: docs[d][0])
        children: list[list[int]] = [[]]
        leaf = [-1]  # the document of a node, or -1

        def node(doc: int = -1) -> int:
            children.append([])
            leaf.append(doc)
            return len(leaf) - 1

        stack, last = [(0, 0)], []  # (node, terms on its path), the way to the last document
        for d in order:
            path = docs[d][0]
            same = next((k for k, (a, b) in enumerate(zip(path, last)) if a != b), min(len(path), len(last)))  # noqa: B905
            below = None
            while stack[-1][1] > same:
                below = stack.pop()[0]
            if stack[-1][1] < same:  # a branch off the middle of a path
                middle = node()
                children[stack[-1][0]][-1] = middle
                children[middle].append(below)
                stack.append((middle, same))
            if len(path) > same:
                end = node()
                children[stack[-1][0]].append(end)
                stack.append((end, len(path)))
            children[stack[-1][0]].append(node(d))
            last = path
        # breadth first, so that siblings stand together; a node with one child is that child
        wide, self.start, self.end = [0], [], []
        for v in wide:
            below = children[v]
            while len(below) == 1 and children[below[0]]:
                below = children[below[0]]
            if len(below) == 1 and v != 0:
                leaf[v], below = leaf[below[0]], []
            self.start.append(len(wide))
            wide.extend(below)
            self.end.append(len(wide))
        self.doc = np.array([leaf[v] for v in wide])
        self.terms = np.unique(np.concatenate([np.array(d[0], np.int64) for d in docs]))
        self.tf = np.zeros((len(self.terms), len(wide)), np.int32)
        self.m = np.zeros(len(wide), np.int64)
        for v in range(len(wide) - 1, -1, -1):
            a, b = self.start[v], self.end[v]
            if a == b:
                ranks, tf, self.m[v] = docs[self.doc[v]]
                self.tf[np.searchsorted(self.terms, ranks), v] = tf
            else:
                self.tf[:, v] = self.tf[:, a:b].max(1)
                self.m[v] = self.m[a:b].min()

    def search(self, item: Item, best: list[tuple], ids: list, top: int) -> int:
        """Enter the documents into ``best``, the item's sorted places (-score, id is null, id); returns the bounds taken."""
        ranks, weights = item
        at = np.searchsorted(self.terms, ranks)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == ranks[here]
        rows, weights = at[here], weights[here]
        if not len(rows):
            return 0
        tried, stack = 1, [(int(self._bounds(rows, weights, 0, 1)[0]), 0)]
        while stack:
            bound, v = stack.pop()
            if bound < (-best[-1][0] if len(best) == top else 1):
                continue
            a, b = self.start[v], self.end[v]
            bounds = self._bounds(rows, weights, a, b)
            tried += b - a
            good = np.flatnonzero(bounds >= (-best[-1][0] if len(best) == top else 1))
            good = good[np.argsort(bounds[good], kind="stable")]
            leaves = self.doc[a + good] >= 0
            for k in good[leaves].tolist():
                key = ids[self.doc[a + k]]
                best.append((-int(bounds[k]), key is None, key))
            best.sort(key=lambda p: (p[0], p[1]) if p[1] else p)
            del best[top:]
            stack += [(int(bounds[k]), a + k) for k in good[~leaves].tolist()]
        return tried

    def _bounds(self, rows: np.ndarray, weights: np.ndarray, a: int, b: int) -> np.ndarray:
        return weights @ shares(self.tf[rows, a:b].astype(np.int64), self.m[a:b])


def blocks(items: DataFrame, item: str, text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The distinct items (id, text) in lists of about ``block_bytes`` of text, dealt by hash."""
    rows = items.select(item, text).filter(F.length(text) > 0)
    total = rows.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / block_bytes))
    for k in range(n):
        yield [tuple(r) for r in rows.filter(F.pmod(F.xxhash64(item, text), F.lit(n)) == k).distinct().collect()]


def counted(docs: DataFrame, text: str, vocabulary: set[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, all their terms, and how many documents hold each term of the vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        df: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                found = terms(value.as_py() or "")
                n, total = n + bool(found), total + len(found)
                df.update(sent.value.intersection(found))
        yield pa.RecordBatch.from_pydict({"term": [None, *df], "docs": [n, *df.values()], "terms": [total] + [0] * len(df)}, pa.schema([("term", pa.binary()), ("docs", pa.int64()), ("terms", pa.int64())]))

    sums = docs.select(text).mapInArrow(count, "term binary, docs bigint, terms bigint").groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))
    rows = sums.collect()  # one row for each term of the block
    n, total = next(((r.docs, r.terms) for r in rows if r.term is None), (0, 0))
    return n, total, {bytes(r.term): r.docs for r in rows if r.term is not None}


def search(docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, rank, key, score): the ``top`` documents of each item with a score above 0, equal scores by ascending key.

    Items are the distinct (item, text); an item or a document that is null, empty or without a term has no row. A null
    key comes after all others; documents that repeat a key are ranked each. Other columns are not read, whatever their
    names; ``item`` and ``key`` must have different ones.
    """
    if key == item:
        raise ValueError(f"documents and items both have the id {key!r}: rename one")
    key_field, item_field = docs.schema[key], items.schema[item]
    schema = f"_item bigint, `{item}` {item_field.dataType.simpleString()}, `{key}` {key_field.dataType.simpleString()}, score bigint"
    out = None
    first = 0
    for block in blocks(items, item, text):
        split = [Counter(terms(t)) for _, t in block]
        n, total, df = counted(docs, text, set().union(*split))
        order = sorted(df, key=lambda t: (df[t], t))
        rank = {t: k for k, t in enumerate(order)}
        weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in order]
        wanted = []
        for c in split:
            found = sorted((rank[t], c[t] * weight[rank[t]]) for t in c if t in rank)
            wanted.append((np.array([r for r, _ in found], np.int64), np.array([w for _, w in found], np.int64)))
        sent = docs.sparkSession.sparkContext.broadcast((rank, wanted, [i for i, _ in block]))

        def places(batches: Iterator[pa.RecordBatch], sent=sent, n=n, total=total, first=first) -> Iterator[pa.RecordBatch]:
            rank, wanted, names = sent.value
            best: list[list[tuple]] = [[] for _ in wanted]
            held, ids, key_type = [], [], None
            most = max(32, min(TREE_DOCS, CELLS // (2 * max(1, len(rank)))))

            def enter() -> None:
                if held:
                    tree = Tree(held)
                    for k, one in enumerate(wanted):
                        tree.search(one, best[k], ids, top)
                held.clear()
                ids.clear()

            for batch in batches:
                key_type = batch.schema.field(0).type
                for name, value in zip(batch.column(0), batch.column(1), strict=True):
                    found = terms(value.as_py() or "")
                    counts = Counter(found)
                    mine = sorted((rank[t], counts[t]) for t in (counts.keys() & rank.keys()))
                    if mine:
                        held.append(([r for r, _ in mine], [c for _, c in mine], 75 + (25 * len(found) * n) // total))
                        ids.append(name.as_py())
                    if len(held) >= most:
                        enter()
            enter()
            rows = [(first + k, names[k], p[2], -p[0]) for k, taken in enumerate(best) for p in taken]
            if rows:
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.array(names).type, key_type, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["_item", item, key, "score"])

        part = docs.select(key, text).mapInArrow(places, schema)
        out = part if out is None else out.unionByName(part)
        first += len(block)
    by = [F.desc("score"), F.col(key).asc_nulls_last()]
    parts = Window.partitionBy("_item", F.pmod(F.xxhash64(key), F.lit(PARTS))).orderBy(*by)
    out = out.withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= top).drop("rank")
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("_item").orderBy(*by))).filter(F.col("rank") <= top)
    return out.select(item, "rank", key, "score")
