"""Helpers shared by the text operators: byte views of Arrow columns, rolling hashes, samples."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailposture.session import cut, ensure_checkpoint_dir  # noqa: F401  for the operators beside this module

#: Multipliers of the 64-bit mixing steps (SplitMix64 finaliser).
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

#: Bytes of text that one vectorised step looks at; longer texts are taken in several steps.
WINDOW = 1 << 19

#: Most groups that a bounded sample looks at, and most rows that it has about.
MOST_GROUPS, MOST_ROWS = 500, 20_000
#: A key is hot from this share of the rows on (1 / HOT_SHARE), if it has HOT_LEAST rows.
HOT_SHARE, HOT_LEAST = 1000, 1000
#: Rows up to which a narrow table is broadcast to a left join.
SHORT = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null ids give null."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(modulus))


def hash_share(*cols: str | Column) -> Column:
    """A number in [0, 1) that depends on the values of ``cols`` alone."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11)).cast("double") / float(1 << 53)


def bounded_sample(df: DataFrame, key: str, groups: str, per_group: int, text: str | None = None, most_groups: int = MOST_GROUPS, most_rows: int = MOST_ROWS) -> DataFrame:
    """Distinct rows of ``df`` chosen by the hash of ``key`` and ``text``: about ``per_group`` of each value of ``groups``.

    The share of each group comes from a count over all rows, so that the expected size is bounded by ``per_group``
    times the number of groups, and by ``most_rows``, and the choice does not depend on the order of the rows. Rows that
    repeat key, text and group are chosen once; an id with many texts is chosen text by text. Of more than
    ``most_groups`` groups the most frequent are sampled (the smaller value of equals). Rows whose group is null are
    left out.
    """
    rows = df.filter(F.col(groups).isNotNull())
    counts = rows.groupBy(groups).count().orderBy(F.desc("count"), groups).limit(most_groups).collect()
    if not counts:
        return rows.limit(0)
    per_group = min(per_group, most_rows / len(counts))
    share = F.create_map(*[x for r in counts for x in (F.lit(r[groups]), F.lit(min(1.0, per_group / r["count"])))])
    hashed = [key] if text is None else [key, text]
    chosen = rows.filter(hash_share(*map(F.col, hashed), F.lit(71)) < F.coalesce(share[F.col(groups)], F.lit(0.0)))
    return chosen.dropDuplicates([*hashed, groups])


def one_text(docs: DataFrame, chosen: DataFrame, label: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, label) of the documents in ``chosen`` (key, label), which must be a bounded sample with one row a key.

    Of several texts of one id the one with the least hash is taken.
    """
    rows = docs.select(key, text).join(F.broadcast(chosen), key)
    least = rows.groupBy(key, label).agg(F.min(F.struct(F.xxhash64(text), F.col(text).alias("text"))).alias("least"))
    return least.select(key, F.col("least.text").alias(text), label)


def hot_join(large: DataFrame, small: DataFrame, on: list[str], rows: int, count: str = "_n") -> DataFrame:
    """Inner join of ``large`` with ``small``, which has one row for each value of ``on`` and in ``count`` how many of
    the ``rows`` rows of ``large`` have it.

    Keys with more than a HOT_SHARE-th of the rows, which are fewer than HOT_SHARE, are joined by broadcast where their
    rows are; the others by a shuffle, in which no key has more than that. ``count`` is not in the result.
    """
    limit = max(HOT_LEAST, rows // HOT_SHARE)
    hot = small.filter(F.col(count) > limit)
    here = large.join(F.broadcast(hot), on)
    rest = large.join(F.broadcast(hot.select(on)), on, "left_anti").join(small.filter(F.col(count) <= limit), on)
    return here.unionByName(rest).drop(count)


def hot_left_join(large: DataFrame, small: DataFrame, on: list[str], keys: DataFrame, rows: int) -> DataFrame:
    """Left join of ``large`` with ``small``, which has one row for each value of ``on`` at most.

    A table of up to SHORT rows is broadcast. Beyond that the rows of hot keys, matched or not, stay where they are, as
    in ``hot_join``. ``keys`` has the columns ``on`` of the
    ``rows`` rows of ``large``.
    """
    if small.limit(SHORT + 1).count() <= SHORT:
        return large.join(F.broadcast(small), on, "left")
    counts = keys.groupBy(*on).agg(F.count("*").alias("_n"))
    hot = cut(counts.filter(F.col("_n") > max(HOT_LEAST, rows // HOT_SHARE)).select(on))  # fewer than HOT_SHARE
    if hot.isEmpty():
        return large.join(small, on, "left")
    here = large.join(F.broadcast(hot.join(small, on, "left")), on)
    return here.unionByName(large.join(F.broadcast(hot), on, "left_anti").join(small, on, "left"))


def byte_view(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column as numpy views; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def windows(offsets: np.ndarray, reach: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Cut rows into steps of about WINDOW bytes: (first row, end row, first byte, end byte, end byte with reach).

    Whole rows share a step; a longer row is cut, and each of its steps sees ``reach`` bytes beyond its end, so
    that a run of up to ``reach + 1`` bytes is seen whole by the step in which it begins.
    """
    n, row = len(offsets) - 1, 0
    while row < n:
        start = int(offsets[row])
        end_row = max(row + 1, int(np.searchsorted(offsets, start + WINDOW, "right")) - 1)
        stop = int(offsets[end_row])
        if stop - start <= WINDOW or end_row > row + 1:
            yield row, end_row, start, stop, stop
        else:
            for b in range(start, stop, WINDOW):
                e = min(b + WINDOW, stop)
                yield row, row + 1, b, e, min(e + reach, stop)
        row = end_row


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * MIX_1
    h = (h ^ (h >> np.uint64(27))) * MIX_2
    return h ^ (h >> np.uint64(31))


def gram_indices(data: np.ndarray, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each size: the bucket (of 2**bits) of the byte run that starts at each position and fits into ``data``."""
    h = np.zeros(len(data), np.uint64)
    for n in range(1, max(sizes) + 1):
        if len(data) < n:
            return
        h = h[: len(data) - n + 1] * np.uint64(0x100000001B3) + data[n - 1 :].astype(np.uint64) + np.uint64(n)
        if n in sizes:
            yield n, ((h * GOLDEN) >> np.uint64(64 - bits)).astype(np.int64)


def row_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of values[start:end] along the first axis for each pair; empty ranges give 0."""
    out = np.zeros((len(starts), *values.shape[1:]), np.float64)
    full = np.flatnonzero(ends > starts)
    if len(full) and len(values):
        cuts = np.stack([starts[full], ends[full]], 1).ravel()
        padded = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
        out[full] = np.add.reduceat(padded, cuts, axis=0, dtype=np.float64)[::2]
    return out


def gram_means(column: pa.Array, weights: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Mean over all byte runs of each row of the weights of their buckets; weights has a row for each bucket.

    Runs never cross a row's end. Rows without any run get zeros. The work is one pass over the column's bytes
    whatever the lengths of the texts.
    """
    data, offsets = byte_view(column)
    n, width = len(offsets) - 1, weights.shape[1]
    total, count = np.zeros((n, width)), np.zeros(n)
    for r0, r1, b0, b1, e in windows(offsets, max(sizes) - 1):
        lo, hi = np.maximum(offsets[r0:r1], b0) - b0, np.minimum(offsets[r0 + 1 : r1 + 1], b1) - b0
        ends = np.minimum(offsets[r0 + 1 : r1 + 1], e) - b0
        for size, index in gram_indices(data[b0:e], sizes, bits):
            last = np.maximum(np.minimum(hi, ends - size + 1), lo)
            total[r0:r1] += row_sums(weights[index], lo, last)
            count[r0:r1] += last - lo
    return total / np.maximum(count, 1)[:, None]


def gram_counts(text: bytes, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, shares) of one text's byte runs, for training; the shares add up to 1."""
    data, total = np.frombuffer(text, np.uint8), np.zeros(1 << bits)
    for _, _, b0, b1, e in windows(np.array([0, len(data)]), max(sizes) - 1):
        for _, index in gram_indices(data[b0:e], sizes, bits):
            total += np.bincount(index[: b1 - b0], minlength=1 << bits)
    at = np.flatnonzero(total)
    return at.astype(np.int32), (total[at] / max(total.sum(), 1)).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function without overflow."""
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


def planned_buckets(rows: int, per_bucket: int, most: int) -> int:
    """A power of two of buckets so that one holds about ``per_bucket`` rows, at most ``most``."""
    return min(most, 1 << max(0, math.ceil(math.log2(max(1, rows / per_bucket)))))
