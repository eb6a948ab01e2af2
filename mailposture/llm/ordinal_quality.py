"""Quality classifier: ordinal cumulative-link regression on graded ratings.

All grades share one vector of hashed-text weights; K ordered thresholds part the K + 1 grades:
P(grade >= j | text) = sigmoid(w . x(text) - t_j) with t_1 < ... < t_K. From these come the expected grade and the
tail probability that a selection uses. x(text) is the mean over all byte runs of three and four bytes of the whole
text, hashed into 2**BITS buckets and bounded as a sum, plus one-hot shape tokens (length, compression, capitals, symbols, spaces).

Nulls and empty texts are scored as a text without runs, that is by the shape tokens alone. Rows with a null id or
null grade (or one that is no number) are scored but never learned from; fractional grades are cut to whole ones. Of several ratings of one id the
worst counts, of several texts of a rated id one is learned from. Repeated rows get equal scores. With no ratings at all
every tail probability is 1 (nothing is known against any text). Extra columns of the input are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailposture.llm.common import bounded_sample, byte_view, gram_counts, gram_means, one_text, sigmoid

#: Hash buckets (power of two) and lengths of the byte runs.
BITS, SIZES = 15, (3, 4)
#: Mean shares are small; this brings them to the scale of the one-hot tokens.
SCALE = 40.0
#: Bound on what the runs of a text say together, so that a few runs that fill a text cannot drown its shape.
RUNS_BOUND = 4.0
#: Bound on learned rows of each grade.
SAMPLE_PER_GRADE = 900
#: One-hot shape tokens: five features of SHAPE_LEVELS levels each.
SHAPES, SHAPE_LEVELS = 5, 16


@dataclass
class OrdinalModel:
    """Weights of the hashed runs, weights of the shape tokens, and ordered thresholds."""

    runs: np.ndarray
    shape: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: pa.Array) -> np.ndarray:
        """P(grade >= j) for j = 1..K, a row for each text."""
        x = RUNS_BOUND * np.tanh(gram_means(texts, self.runs[:, None], SIZES, BITS)[:, 0] * SCALE / RUNS_BOUND)
        for k, level in enumerate(shape_levels(texts).T):
            x = x + self.shape[k, level]
        return sigmoid(x[:, None] - self.thresholds[None, :])


def shape_levels(texts: pa.Array) -> np.ndarray:
    """Levels of the five shape tokens of each text: length, compression, capitals, symbols, spaces."""
    data, offsets = byte_view(texts)
    pack = zstandard.ZstdCompressor(level=1)
    classes = np.zeros(256, np.int8)
    classes[[*range(65, 91)]] = 1
    classes[[b for b in range(33, 127) if not chr(b).isalnum()]] = 2
    classes[[9, 10, 11, 12, 13, 32]] = 3
    out = np.zeros((len(offsets) - 1, SHAPES), np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        n = b - a
        if n:
            raw = data[a:b]
            counts = np.bincount(classes[raw], minlength=4)
            ratio = n / len(pack.compress(raw.tobytes()))
            shares = [np.sqrt(c / n) * SHAPE_LEVELS for c in counts[1:]]
            out[i] = [np.log2(n + 1), 2 * np.log2(ratio) + 3, *shares]
    return np.clip(out, 0, SHAPE_LEVELS - 1)


def fit(ratings: DataFrame, text: str = "text", grade: str = "grade", key: str = "doc_id", per_grade: int = SAMPLE_PER_GRADE, epochs: int = 10, seed: int = 7) -> OrdinalModel:
    """Learn from at most about ``per_grade`` rated texts of each integer grade, chosen by the hash of their ids.

    The texts become sparse counts in the tasks; the driver gets those (2**BITS pairs a text at most) and fits by
    stochastic gradient steps with AdaGrad on the cumulative-link likelihood, each grade weighing the same.
    """
    sample = bounded_sample(ratings.select(key, text, F.col(grade).try_cast("int").alias("grade")), key, "grade", per_grade, text)
    rows = sample.mapInArrow(_features, "grade int, at binary, share binary, shape binary").collect()
    grades = sorted({r["grade"] for r in rows})
    runs, shape = np.zeros(1 << BITS), np.zeros((SHAPES, SHAPE_LEVELS))
    if len(grades) < 2:
        return OrdinalModel(runs, shape, np.full(1, -30.0))
    y = np.searchsorted(grades, [r["grade"] for r in rows])
    weight = len(y) / len(grades) / np.bincount(y)[y]
    cuts = np.arange(1, len(grades)) - len(grades) / 2.0
    gap = np.concatenate([cuts[:1], np.log(np.diff(cuts))])  # cut j is gap 0 plus exponentials: always in order
    sums = [np.full(x.shape, 1e-2) for x in (runs, shape, gap)]
    at, share = [np.frombuffer(r["at"], np.int32) for r in rows], [np.frombuffer(r["share"], np.float32) * np.float32(SCALE) for r in rows]
    levels, axis = np.stack([np.frombuffer(r["shape"], np.int32) for r in rows]), np.arange(SHAPES)
    order = np.random.default_rng(seed)
    # A fixed order of the rows whatever the partitions: by grade and content.
    content = np.array([float(a @ np.arange(1, len(a) + 1) % 1e9) + float(s.sum()) for a, s in zip(at, share, strict=True)])
    base = np.lexsort((content, y))
    for epoch in range(epochs):
        step = 0.5 / (1 + 0.1 * epoch)
        for i in base[order.permutation(len(base))]:
            cuts = np.cumsum(np.concatenate([gap[:1], np.exp(gap[1:])]))
            bent = np.tanh(runs[at[i]] @ share[i] / RUNS_BOUND)
            x = RUNS_BOUND * bent + shape[axis, levels[i]].sum()
            # Bounds of the grade's interval on the line, and the likelihood's slope there.
            hi = sigmoid(x - cuts[y[i] - 1]) if y[i] > 0 else 1.0
            lo = sigmoid(x - cuts[y[i]]) if y[i] < len(cuts) else 0.0
            p = max(float(hi - lo), 1e-9)
            dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
            slope = weight[i] * (dhi - dlo)
            dcut = np.zeros(len(cuts))
            if y[i] > 0:
                dcut[y[i] - 1] -= weight[i] * dhi
            if y[i] < len(cuts):
                dcut[y[i]] += weight[i] * dlo
            dgap = np.cumsum(dcut[::-1])[::-1] * np.concatenate([[1.0], np.exp(gap[1:])])
            g = slope * (1 - bent * bent) * share[i] - 1e-5 * runs[at[i]]
            sums[0][at[i]] += g * g
            runs[at[i]] += step * g / np.sqrt(sums[0][at[i]])
            gs = slope - 1e-3 * shape[axis, levels[i]]
            sums[1][axis, levels[i]] += gs * gs
            shape[axis, levels[i]] += step * gs / np.sqrt(sums[1][axis, levels[i]])
            sums[2] += dgap * dgap
            gap = gap + step * dgap / np.sqrt(sums[2])
    return OrdinalModel(runs, shape, np.cumsum(np.concatenate([gap[:1], np.exp(gap[1:])])))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        raw = [t.encode() if t else b"" for t in texts.to_pylist()]
        counts = [gram_counts(t, SIZES, BITS) for t in raw]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(2),
                pa.array([c[0].tobytes() for c in counts], pa.binary()),
                pa.array([c[1].tobytes() for c in counts], pa.binary()),
                pa.array([x.tobytes() for x in shape_levels(texts).astype(np.int32)], pa.binary()),
            ],
            ["grade", "at", "share", "shape"],
        )


def score(docs: DataFrame, model: OrdinalModel, text: str = "text", keep_at: int = 1, keep_tail: float = 0.25, prefix: str = "") -> DataFrame:
    """Add expected_grade, tail_probability (of ``keep_at`` or more) and kept (tail at least ``keep_tail``).

    ``prefix`` goes before the three names where the input has columns so named.
    """
    names = [f"{prefix}{x}" for x in ("expected_grade", "tail_probability", "kept")]
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"columns exist already, give a prefix: {sorted(clash)}")
    at = docs.columns.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = np.round(model.tails(batch.column(at)), 6)
            tail = tails[:, min(keep_at, tails.shape[1]) - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tails.sum(1)), pa.array(tail), pa.array(tail >= keep_tail)], [*batch.schema.names, *names])

    schema = docs.schema
    for name, kind in zip(names, ("double", "double", "boolean"), strict=True):
        schema = type(schema)([*schema.fields]).add(name, kind)
    return docs.mapInArrow(scored, schema)


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, grade) of rated documents: 0 poor, 1 good but toxic, 2 good. Missing ratings give no row."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    rated = labels.select("doc_id", grade.alias("grade")).filter("doc_id is not null and grade is not null")
    worst = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    return one_text(docs, bounded_sample(worst, "doc_id", "grade", SAMPLE_PER_GRADE), "grade")
