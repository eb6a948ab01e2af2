"""Language ID: averaged hashed subword embeddings with a linear softmax, and calibrated rejection.

Every run of 1 to 4 bytes of the lower-cased whole text is a subword; it picks one of 2**BITS embedding vectors, a
text is the mean of its vectors, and a linear softmax over that mean gives the language. Embeddings and softmax are
trained together by stochastic gradient descent in numpy. A temperature, fitted on texts that the descent has not
seen, turns the softmax into calibrated probabilities; below the rejection threshold a prediction is marked rejected.

Null texts and texts without any letter get ``und`` with score 0, and are rejected. Texts of any length are read
whole. Rows without a language are scored, not learned from. Repeated rows get equal predictions. With fewer than
one labelled language every text gets ``und``. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailposture.llm.common import bounded_sample, gram_counts, gram_means

BITS, SIZES, DIMENSION = 15, (1, 2, 3, 4), 16
#: Bound on learned rows of each language.
SAMPLE_PER_LANGUAGE = 600
#: Default threshold of rejection: the least calibrated probability of an accepted prediction.
REJECT_BELOW = 0.6
UNDETERMINED = "und"


@dataclass
class LanguageModel:
    """Languages, the product of embeddings and softmax weights (a row for each bucket), bias, temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        logits = (gram_means(pc.utf8_lower(texts), self.weights, SIZES, BITS) + self.bias) / self.temperature
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = SAMPLE_PER_LANGUAGE, epochs: int = 8, seed: int = 11) -> LanguageModel:
    """Learn from at most about ``per_language`` texts of each language, chosen by the hash of their ids and texts.

    Of more than MOST_GROUPS languages the most frequent are learned, of all together about MOST_ROWS texts.

    Tasks turn those texts into bucket shares (2**BITS pairs a text at most), which is all that the driver gets.
    One text in five is held back from the descent, to fit the temperature.
    """
    rows = docs.filter(F.col(key).isNotNull()).select(key, text, lang)
    sample = bounded_sample(rows, key, lang, per_language, text).mapInArrow(_features, "key string, lang string, at binary, share binary").collect()
    sample = sorted((r for r in sample if r["at"]), key=lambda r: (r["key"], r["lang"], r["at"]))
    languages = sorted({r["lang"] for r in sample})
    if not languages:
        return LanguageModel([], np.zeros((1 << BITS, 1)), np.zeros(1), 1.0)
    y = np.searchsorted(languages, [r["lang"] for r in sample])
    at, share = [np.frombuffer(r["at"], np.int32) for r in sample], [np.frombuffer(r["share"], np.float32) for r in sample]
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1, 1, (1 << BITS, DIMENSION)) / DIMENSION
    soft, bias = np.zeros((DIMENSION, len(languages))), np.zeros(len(languages))
    order = rng.permutation(len(y))
    held, learn = order[: len(order) // 5], order[len(order) // 5 :]
    weight = len(learn) / len(languages) / np.maximum(np.bincount(y[learn], minlength=len(languages)), 1)
    for epoch in range(epochs):
        step = 2.0 * (1 - epoch / epochs)
        for i in rng.permutation(learn):
            vectors = embed[at[i]]
            mean = share[i] @ vectors
            z = mean @ soft + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= min(weight[y[i]], 3.0)
            pull = soft @ p
            soft -= step * np.outer(mean, p)
            bias -= 0.01 * step * p
            embed[at[i]] = vectors - (step * 20) * share[i][:, None] * pull
    weights = embed @ soft
    logits = np.array([share[i] @ weights[at[i]] for i in held]).reshape(-1, len(languages)) + bias
    return LanguageModel(languages, weights, bias, _temperature(logits, y[held]))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature under which held-back texts are likeliest, among fixed candidates."""

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]))

    return min(np.geomspace(0.25, 8, 31), key=loss) if len(y) else 1.0


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [gram_counts(t.encode() if t else b"", SIZES, BITS) for t in pc.utf8_lower(batch.column(1)).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pc.cast(batch.column(0), pa.string()), batch.column(2), pa.array([c[0].tobytes() for c in counts], pa.binary()), pa.array([c[1].tobytes() for c in counts], pa.binary())],
            ["key", "lang", "at", "share"],
        )


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", reject_below: float = REJECT_BELOW, prefix: str = "") -> DataFrame:
    """Add lang_pred, score (calibrated probability of it) and rejected; ``prefix`` avoids clashing names."""
    names = [f"{prefix}{x}" for x in ("lang_pred", "score", "rejected")]
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"columns exist already, give a prefix: {sorted(clash)}")
    at = docs.columns.index(text)
    languages = np.array(model.languages or [UNDETERMINED], object)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            p = model.probabilities(texts)
            best = p.argmax(1) if len(p) else np.zeros(0, int)
            known = letters & bool(model.languages)
            found = np.where(known, languages[best], UNDETERMINED)
            score = np.where(known, np.round(p[np.arange(len(best)), best], 6), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(score), pa.array(score < reject_below)], [*batch.schema.names, *names])

    schema = docs.schema
    for name, kind in zip(names, ("string", "double", "boolean"), strict=True):
        schema = type(schema)([*schema.fields]).add(name, kind)
    return docs.mapInArrow(predicted, schema)
