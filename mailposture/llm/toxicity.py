"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows.

The lexicon is a set of word beginnings with weights, given or learned from labelled texts. Its trie is walked
together with the Levenshtein automaton of the word at hand (insertions, deletions, replacements, swapped
neighbours), so all terms within a term's allowed distance are found in one walk; sets of states become single
states of a deterministic automaton when they first occur. Each hit is then read in its context: a window of words
around it counts further hits, and hits inside quotation marks, quoted lines or beside words that report speech count
apart from plain ones. A logistic regression over these sums gives the score.

Null and empty texts score like texts without a hit. Texts are read whole, quotations have any length. Rows without a
label are scored, not learned from; an id with both labels is toxic, and of several texts of a labelled id one is
learned from. Repeated rows get equal scores. Without labels of both kinds every text scores 0. Extra columns are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType

from mailposture.llm.common import bounded_sample, one_text, sigmoid

#: Bounds on learned rows of label 1 and label 0.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1000, 3000
#: Lengths of word beginnings that may become terms.
TERM_LENGTHS = range(4, 13)
#: A word that goes on for more letters than this behind a misspelled term is another word.
TAIL = 2
#: Words on each side of a hit that form its context.
CONTEXT = 8
THRESHOLD = 0.3
#: Words and states that a task remembers before it starts anew.
REMEMBER = 400_000

# Words that report speech or name a word.
REPORTING = frozenset(
    "said says say told wrote writes called calls quote quoted quotes word words term terms slur slurs meaning means "
    "sagte sagt schrieb nannte genannt wort wörter zitat begriff dit disait écrit appelé mot mots terme citation "
    "dijo dice escribió llamó palabra palabras término cita".split()
)
_WORD = re.compile(r"\w+")
_QUOTED_LINE = re.compile(r"^[ \t]*>.*$", re.M)
_MARK = re.compile(r"[\"“”„«»\n]")
#: What closes a quotation that each mark opens.
_CLOSES = {'"': '"', "“": "”", "„": "“”", "«": "»"}


def allowed_edits(term: str) -> int:
    """Edits within which a word still counts as this term."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Matcher:
    """Deterministic product of the lexicon's trie and Levenshtein automata, built as words are read."""

    def __init__(self, terms: list[str]) -> None:
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.budget: list[int] = [0]  # most edits of any term below a node
        for i, term in enumerate(terms):
            node, edits = 0, allowed_edits(term)
            self.budget[0] = max(self.budget[0], edits)
            for ch in term:
                node = self.children[node].setdefault(ch, len(self.children))
                if node == len(self.ends):
                    self.children.append({})
                    self.ends.append(-1)
                    self.budget.append(0)
                self.budget[node] = max(self.budget[node], edits)
            self.ends[node] = i
        self.start = self._closed({(0, 0, "")})
        self.steps: dict[frozenset, dict[str, frozenset]] = {}

    def _closed(self, states: set) -> frozenset:
        """States with those that are reached by leaving out letters of a term."""
        todo = list(states)
        while todo:
            node, edits, due = todo.pop()
            if due or node < 0:
                continue
            for child in self.children[node].values():
                state = (child, edits + 1, "")
                if edits + 1 <= self.budget[child] and state not in states:
                    states.add(state)
                    todo.append(state)
        # Ends reached with edits wait for the word's end: (-1 - term, edits, letters behind it)
        for node, edits, due in list(states):
            if node >= 0 and not due and edits and self.ends[node] >= 0 and edits <= allowed_edits(self.terms[self.ends[node]]):
                states.add((-1 - self.ends[node], edits, 0))
        return frozenset(states)

    def _step(self, states: frozenset, ch: str) -> frozenset:
        out = set()
        for node, edits, due in states:
            if node < 0:
                if due < TAIL:
                    out.add((node, edits, due + 1))
                continue
            if due:  # second letter of a swapped pair
                if ch == due:
                    out.add((node, edits, ""))
                continue
            below = self.children[node]
            if ch in below:
                out.add((below[ch], edits, ""))
            if edits + 1 <= self.budget[node]:
                out.add((node, edits + 1, ""))
                for c, child in below.items():
                    if edits + 1 > self.budget[child]:
                        continue
                    if c != ch:
                        out.add((child, edits + 1, ""))
                    after = self.children[child].get(ch)
                    if after is not None and c != ch and edits + 1 <= self.budget[after]:
                        out.add((after, edits + 1, c))
        return self._closed(out)

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the best match: the longest exact beginning, else the fewest edits; None if there is none."""
        node, exact = 0, -1
        for ch in word:
            node = self.children[node].get(ch, -1)
            if node < 0:
                break
            if self.ends[node] >= 0:
                exact = self.ends[node]
        if exact >= 0:
            return exact, 0
        states = self.start
        for ch in word:
            known = self.steps.get(states)
            if known is None:
                if len(self.steps) > REMEMBER // 20:
                    self.steps.clear()
                known = self.steps[states] = {}
            after = known.get(ch)
            if after is None:
                after = known[ch] = self._step(states, ch)
            states = after
            if not states:
                return None
        best = min(((edits, -1 - node) for node, edits, _ in states if node < 0), default=None)
        return (best[1], best[0]) if best else None


class Memory(dict):
    """Words seen so far and what they match."""

    def __init__(self, matcher: Matcher) -> None:
        super().__init__()
        self.matcher = matcher

    def __missing__(self, word: str) -> tuple[int, int] | None:
        if len(self) > REMEMBER:
            self.clear()
        found = self[word] = self.matcher.match(word)
        return found


FEATURES = ("any", "plain", "misspelled", "reported", "window", "density")


@dataclass
class ToxicityModel:
    """Lexicon with weights, weights of misspelled forms, and the logistic regression over FEATURES."""

    terms: list[str]
    weights: np.ndarray
    misspelled: np.ndarray
    bias: float = -30.0
    slopes: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))

    def features(self, text: str | None, memory: Memory) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Sums over the hits of one text, and the hits (term, edits)."""
        words = [w.lower() for w in _WORD.findall(text)] if text else []
        found = list(map(memory.__getitem__, words))
        at = [i for i, f in enumerate(found) if f is not None]
        if not at:
            return np.zeros(len(FEATURES)), []
        hits = [found[i] for i in at]
        weight = np.array([self.weights[t] if e == 0 else self.misspelled[t] for t, e in hits])
        off = np.array([e > 0 for _, e in hits])
        reported = self._reported(text, words, at)
        place = np.array(at)
        near = np.searchsorted(place, place + CONTEXT, "right") - np.searchsorted(place, place - CONTEXT, "left") - 1
        plain = weight[~off & ~reported].sum()
        wrong = weight[off & ~reported].sum()
        told = weight[reported].sum()
        live = weight * ~reported
        return np.array([float(live.max() > 0), np.log1p(plain), np.log1p(wrong), np.log1p(told), np.log1p((live * near).sum()), np.sqrt(live.sum() / len(words))]), hits

    @staticmethod
    def _reported(text: str, words: list[str], at: list[int]) -> np.ndarray:
        """Which hits stand in quotation marks or quoted lines, or beside a word that reports speech."""
        out = np.array([any(w in REPORTING for w in words[max(0, i - 3) : i]) for i in at])
        spans = quotations(text)
        if spans:
            starts = [m.start() for m in _WORD.finditer(text)]
            begin, end = (np.array(x) for x in zip(*spans, strict=True))
            place = np.array([starts[i] for i in at])
            k = np.searchsorted(begin, place, "right") - 1
            out |= (k >= 0) & (place < np.maximum.accumulate(end)[np.maximum(k, 0)])
        return out


def quotations(text: str) -> list[tuple[int, int]]:
    """Sorted (start, end) of what stands between quotation marks of one kind within a line, and of quoted lines."""
    spans, opened = [m.span() for m in _QUOTED_LINE.finditer(text)], {}
    for m in _MARK.finditer(text):
        mark = m.group()
        if mark == "\n":
            opened.clear()
            continue
        closed = [kind for kind in opened if mark in _CLOSES[kind]]
        for kind in closed:
            spans.append((opened.pop(kind), m.end()))
        if not closed and mark in _CLOSES:
            opened.setdefault(mark, m.start())
    return sorted(spans)


def beginnings(text: str | None) -> set[str]:
    """Word beginnings of a text that may become terms."""
    return {w[:n] for w in {w.lower() for w in _WORD.findall(text)} for n in TERM_LENGTHS if len(w) >= n} if text else set()


def learn(labelled: DataFrame, text: str = "text", toxic: str = "toxic", key: str = "doc_id") -> ToxicityModel:
    """Lexicon and regression from a bounded sample of (key, text, toxic 0/1), chosen by the hash of the ids.

    Terms are word beginnings found far more often in label 1 than chance allows, counted in tasks. The driver gets
    these, which the sampled texts bound, and from each sampled text the candidates that it holds.
    """
    rows = labelled.filter(f"{key} is not null and {toxic} is not null").select(key, text, F.col(toxic).try_cast("int").alias("toxic")).cache()
    try:
        return _learn(rows, key)
    finally:
        rows.unpersist()


def _learn(rows: DataFrame, key: str) -> ToxicityModel:
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    empty = ToxicityModel([], np.zeros(0), np.zeros(0))
    if not n1 or not n0:
        return empty

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, y in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                terms = list(beginnings(t.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([y] * len(terms), pa.int32())], ["term", "toxic"])

    counts = rows.mapInArrow(spread, "term string, toxic int").groupBy("term").agg(F.sum("toxic").alias("c1"), F.sum(1 - F.col("toxic")).alias("c0"))
    p = n1 / (n1 + n0)
    c1, c0 = F.col("c1"), F.col("c0")
    # Log likelihood ratio of the observed split against a split by chance.
    gain = c1 * F.log(c1 / (p * (c1 + c0))) + F.when(c0 > 0, c0 * F.log(c0 / ((1 - p) * (c1 + c0)))).otherwise(0)
    strong = counts.filter((c1 >= 4) & ((c0 + 0.5) / n0 <= 0.05 * c1 / n1) & (gain >= math.log(1e4)))
    found = strong.orderBy(F.desc("c1"), "term").collect()
    terms, held = [r["term"] for r in found], {r["term"]: i for i, r in enumerate(found)}
    odds = np.array([math.log((r["c1"] + 0.5) / (n1 + 1)) - math.log((r["c0"] + 0.5) / (n0 + 1)) for r in found])

    def holds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1), strict=True):
                at = sorted(held[x] for x in beginnings(t.as_py()) if x in held)
                if at:
                    yield pa.RecordBatch.from_arrays([pa.array([str(k.as_py())]), pa.array([at], pa.list_(pa.int32()))], ["key", "at"])

    texts = [r["at"] for r in rows.filter("toxic = 1").mapInArrow(holds, "key string, at array<int>").collect()]
    chosen = cover(terms, texts)
    if not chosen:
        return empty
    lexicon, weights = [terms[i] for i in chosen], np.clip(odds[chosen], 0.1, 8)
    model = ToxicityModel(lexicon, weights, 0.5 * weights)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(Matcher(model.terms))
        for batch in batches:
            both = [model.features(t.as_py(), memory) for t in batch.column(1)]
            wrong = [sorted({t for t, e in hits if e}) for _, hits in both]
            yield pa.RecordBatch.from_arrays(
                [pa.array([str(k) for k in batch.column(0).to_pylist()]), batch.column(2), pa.array([f.tolist() for f, _ in both], pa.list_(pa.float64())), pa.array(wrong, pa.list_(pa.int32()))], ["key", "toxic", "x", "wrong"]
            )

    kind = "key string, toxic int, x array<double>, wrong array<int>"
    # First: in how many texts of either label is each term misspelled? That sets the weight of misspelled forms.
    first = rows.mapInArrow(measured, kind).select("toxic", F.explode("wrong").alias("term")).groupBy("term").agg(F.sum("toxic").alias("c1"), F.sum(1 - F.col("toxic")).alias("c0")).collect()
    for r in first:
        seen = math.log((r["c1"] + 1) / (n1 + 2)) - math.log((r["c0"] + 1) / (n0 + 2))
        model.misspelled[r["term"]] = min(max(seen, 0.0), weights[r["term"]]) if r["c1"] + r["c0"] >= 3 else model.misspelled[r["term"]]
    data = rows.mapInArrow(measured, kind).select("key", "toxic", "x").toPandas().sort_values("key", kind="stable")
    return regress(model, np.array(data["x"].tolist()), data["toxic"].to_numpy(np.float64))


def cover(terms: list[str], texts: list[list[int]], times: int = 3, least: int = 3) -> list[int]:
    """Greedy choice of terms until texts hold ``times`` chosen ones; the longest of equally frequent beginnings."""
    where: list[list[int]] = [[] for _ in terms]
    for k, at in enumerate(texts):
        for i in at:
            where[i].append(k)
    sets = [np.array(w, np.int64) for w in where]
    count, chosen = np.zeros(len(texts), np.int64), []
    open_ = set(range(len(terms)))
    gain = {i: len(sets[i]) for i in open_}
    while open_:
        best = None
        for i in sorted(open_, key=lambda i: (-gain[i], -len(terms[i]), terms[i])):  # old gains are upper bounds
            if best is not None and gain[i] < best[0]:
                break
            gain[i] = int((count[sets[i]] < times).sum())
            if best is None or (gain[i], len(terms[i])) > best[:2]:
                best = (gain[i], len(terms[i]), i)
        if best is None or best[0] < least:
            break
        i = best[2]
        chosen.append(i)
        count[sets[i]] += 1
        open_ = {j for j in open_ if not terms[j].startswith(terms[i]) and not terms[i].startswith(terms[j])}
    return sorted(chosen, key=lambda i: terms[i])


def regress(model: ToxicityModel, x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 0.05) -> ToxicityModel:
    """Fit the logistic regression by Newton steps with a ridge."""
    full = np.concatenate([np.ones((len(x), 1)), x], 1)
    w = np.zeros(full.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = sigmoid(full @ w)
        step = np.linalg.solve((full * (p * (1 - p))[:, None]).T @ full + np.diag(penalty), full.T @ (y - p) - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    model.bias, model.slopes = float(w[0]), w[1:]
    return model


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD, prefix: str = "") -> DataFrame:
    """Add score, predicted (1 from ``threshold`` on) and toxic_terms (term~edits of each distinct hit)."""
    names = [f"{prefix}{x}" for x in ("score", "predicted", "toxic_terms")]
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"columns exist already, give a prefix: {sorted(clash)}")
    at = docs.columns.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(Matcher(model.terms))
        for batch in batches:
            both = [model.features(t.as_py(), memory) for t in batch.column(at)]
            x = np.array([f for f, _ in both]).reshape(-1, len(FEATURES))
            s = np.round(sigmoid(model.bias + x @ model.slopes), 6)
            hits = [[f"{model.terms[t]}~{e}" for t, e in sorted(set(h))] for _, h in both]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32)), pa.array(hits, pa.list_(pa.string()))], [*batch.schema.names, *names])

    schema = docs.schema
    for name, kind in zip(names, (DoubleType(), IntegerType(), ArrayType(StringType())), strict=True):
        schema = type(schema)([*schema.fields]).add(name, kind)
    return docs.mapInArrow(scored, schema)


def sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of at most about SAMPLE_TOXIC and SAMPLE_CLEAN labelled documents."""
    rated = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = bounded_sample(rated.filter("toxic = 1"), "doc_id", "toxic", SAMPLE_TOXIC).union(bounded_sample(rated.filter("toxic = 0"), "doc_id", "toxic", SAMPLE_CLEAN))
    return one_text(docs, chosen, "toxic")
