"""Quality rules: compression bands over whole documents and fixed chunks.

Repetitive text compresses far better than prose, random or encoded text hardly at all. The ratio (bytes / zstandard
bytes) of the whole text must lie in the band for its length. From two full chunks on, so must that of its fixed
chunks, of which a share may be out of band; the rest behind them is held against the band of texts of its length. Plain counts (words, symbols, repeated lines and word windows) give a base verdict before that.

Null and empty texts have no words and fail the base rules. Texts shorter than the first band are not judged by
ratio. Whole texts of any length are measured. Repeated rows get equal verdicts; empty tables give no rows. Other
columns are kept; the new names must not exist yet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

# (least bytes, lowest ratio, highest ratio) of whole texts, from the texts rated good that pass the base rules in sf0.1
# and the smaller check table (18,552 different ones): their 0.001 quantile in the class less 10 %, their 0.999 quantile
# plus 2 %. None of them has 64 KB: there the upper limit stands 8 % above the class before, as limits rise by 5 to 11 %
# from class to class.
BANDS = (
    (256, 1.22, 1.94),
    (512, 1.32, 2.03),
    (1024, 1.55, 2.26),
    (4096, 1.82, 2.46),
    (16384, 2.04, 2.59),
    (65536, 2.04, 2.80),
)
# Bytes of a chunk, its lowest and highest ratio (by the same rule, from 24,313 chunks), and the share of chunks that may
# be out of band.
CHUNK, CHUNK_LOW, CHUNK_HIGH, CHUNK_SHARE = 2048, 1.60, 2.21, 0.3
LEVEL = 3

SPACES = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(data: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, lines equal to an earlier one, and words in repeated 3-word windows."""
    words = data.split()  # at \x20 and \x09-\x0D
    seen: set[bytes] = set()
    dup = 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    return len(words), len(data.translate(None, SPACES + CONTINUATION)), len(data) - len(data.translate(None, SYMBOLS)), dup, repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Number of words that lie in a 3-word window found at least twice."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    if len(index) < 2_000_000:  # three ids fit into 63 bits
        windows = (ids[:-2] * len(index) + ids[1:-1]) * len(index) + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * len(index) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * len(index) + ids[2:]
    _, place, n = np.unique(windows, return_inverse=True, return_counts=True)
    twice = n[place] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : k + len(twice)] |= twice
    return int(hit.sum())


def ratio(data: bytes, pack: zstandard.ZstdCompressor) -> float:
    """Bytes over compressed bytes."""
    return len(data) / len(pack.compress(data))


def band_of(size: int) -> tuple[int, float, float] | None:
    """The band of a text of ``size`` bytes; none below the first one."""
    return next((b for b in reversed(BANDS) if size >= b[0]), None)


def limits(size: int) -> tuple[int, float, float] | None:
    """The band of a chunk: its own for full ones, that of a text of its length for the rest."""
    return (CHUNK, CHUNK_LOW, CHUNK_HIGH) if size == CHUNK else band_of(size)


def in_band(data: bytes, pack: zstandard.ZstdCompressor) -> tuple[float | None, float, bool]:
    """(ratio of the whole, share of chunks out of band, verdict)."""
    band = band_of(len(data))
    if band is None:
        return (ratio(data, pack) if data else None), 0.0, True
    whole = ratio(data, pack)
    chunks = [(data[i : i + CHUNK], limits(min(CHUNK, len(data) - i))) for i in range(0, len(data), CHUNK)] if len(data) >= 2 * CHUNK else []
    odd = [not low <= ratio(c, pack) <= high for c, (_, low, high) in filter(lambda x: x[1], chunks)]
    out = sum(odd) / max(1, len(odd))
    return whole, out, band[1] <= whole <= band[2] and out <= CHUNK_SHARE


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the five counts, base_failed, compression_ratio, odd_chunks (share out of band) and kept."""
    names = [*COUNTS, "base_failed", "compression_ratio", "odd_chunks", "kept"]
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    at = docs.columns.index(text)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = []
            for t in batch.column(at):
                data = (t.as_py() or "").encode("utf-8", "surrogatepass")
                c = counts(data)
                failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
                whole, out, good = in_band(data, pack)
                rows.append((*c, failed, whole, out, good and not failed))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [*batch.schema.names, *names])

    schema = docs.schema
    for name, kind in zip(names, ["long"] * 5 + ["boolean", "double", "double", "boolean"], strict=True):
        schema = type(schema)([*schema.fields]).add(name, kind)
    return docs.mapInArrow(judged, schema)
