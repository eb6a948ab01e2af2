"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

For words of equal or neighbouring lengths the first of a pair contributes two disjoint chunks, its beginning and its
end of half its length each (less the middle letter of an odd length), and the second the grams of that size that can
stand at a chunk's place. One edit touches one of the chunks at most, so the other one is also in the second word: the
first chunk at the same place, the last one moved by the difference of the lengths, which is one at most. What is left
of the word beside that chunk holds the edit and has two disjoint chunks of its own, of half that size, one of which is
kept for the same reason. Joining on (length, which chunks, their letters) therefore loses no pair, and two words meet
only if they share about three quarters of their letters; the exact distance is part of the join's condition, so
candidates that fail are never rows. A pair that shares several chunks is taken by the first of them only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailposture.llm.common import cut

#: Fewest letters of a word, fewest occurrences, and how many times as frequent a word's form has to be.
LEAST_LETTERS, LEAST_COUNT, FORM_RATIO = 7, 2, 10
#: One run in so many loses a letter.
DROP_ONE_IN = 31
#: The letters of a run.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def typed(run: Column, key: Column, drop_one_in: int = DROP_ONE_IN) -> Column:
    """The run, less one letter where ``drop_one_in`` divides the crc32 of ``<key>:<run>``; a null key counts as empty."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(drop_one_in)) == 0, shorter).otherwise(run)


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LEAST_LETTERS, count: int = LEAST_COUNT, drop_one_in: int = DROP_ONE_IN) -> DataFrame:
    """(word, n) of all whole texts: words of at least ``letters`` letters and ``count`` occurrences.

    A null or empty text has none; repeated rows count as often as they stand there; other columns are not read.
    """
    lower = F.translate(F.col(text), UPPER, LOWER)
    # Shorter runs only get shorter still, so they are not taken out of the text at all.
    runs = docs.select(F.col(key).alias("key"), F.explode(F.regexp_extract_all(lower, F.lit(LETTERS + "{%d,}" % letters), F.lit(0))).alias("run"))
    found = runs.select(typed(F.col("run"), F.col("key"), drop_one_in).alias("word"))
    return found.groupBy("word").agg(F.count("*").alias("n")).filter((F.length("word") >= letters) & (F.col("n") >= count))


def _keys(word: Column, n: Column, half: Column, quarter: Column) -> list[Column]:
    """The letters of a word of ``n`` letters under the four pairs of a chunk and a chunk of the rest."""
    start = lambda k: F.substring(word, F.lit(1), k)
    end = lambda k: F.substring(word, n - k + 1, k)
    return [start(half + quarter), F.concat(start(half), end(quarter)), F.concat(start(quarter), end(half)), end(half + quarter)]


def _sizes(size: Column) -> tuple[Column, Column]:
    half = F.floor(size / 2).cast("int")
    return half, F.floor(half / 2).cast("int")


def _exploded(rows: DataFrame, keys: list[Column]) -> DataFrame:
    each = F.array(*[F.struct(F.lit(k).alias("chunk"), c.alias("gram")) for k, c in enumerate(keys)])
    return rows.select("*", F.explode(each).alias("_c")).select(*rows.columns, "_c.*")


def chunks(words: DataFrame, word: str = "word") -> DataFrame:
    """Four rows a word: its length, which chunks (0, 1: its first half and the first or last of the rest; 2, 3: its last
    half and the first or last of the rest), and their letters."""
    rows = words.select("*", F.length(word).alias("size"))
    return _exploded(rows, _keys(F.col(word), F.col("size"), *_sizes(F.col("size"))))


def grams(words: DataFrame, word: str = "word") -> DataFrame:
    """The same of the positional grams that can be chunks of a word of ``size`` letters, one less, equal or one more: of
    that word's chunk sizes, at the chunk's place, or moved by the difference of the lengths behind the edit."""
    n = F.length(word)
    rows = words.select("*", F.explode(F.array(n - 1, n, n + 1)).alias("size"))
    return _exploded(rows, _keys(F.col(word), n, *_sizes(F.col("size"))))


def near(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): all ordered pairs of distinct ``words`` (word, n) that are one edit apart.

    The words must be of six letters or more and one row each.
    """
    a = chunks(words)
    b = grams(words).select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("size").alias("_size"), F.col("chunk").alias("_chunk"), F.col("gram").alias("_gram"))
    sizes = _sizes(F.col("size"))
    mine, theirs = _keys(F.col("word"), F.length("word"), *sizes), _keys(F.col("other"), F.length("other"), *sizes)
    first = F.lit(3)
    for k in (2, 1, 0):
        first = F.when(mine[k] == theirs[k], k).otherwise(first)
    same = (F.col("size") == F.col("_size")) & (F.col("chunk") == F.col("_chunk")) & (F.col("gram") == F.col("_gram"))
    verified = (F.col("word") != F.col("other")) & (F.levenshtein("word", "other", 1) == 1) & (F.col("chunk") == first)
    return a.join(b, same & verified).select("word", "n", "other", "other_n")


def group(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all ``words`` (word, n).

    The form is the near word of largest n (the smallest word of equals) if that is ``ratio`` (2 or more) times the
    word's n, else null; the root follows forms to the last. n grows with each form, so that forms have no cycles and a
    path is no longer than the logarithm of n; roots are found by doubling. An empty table gives an empty table.
    """
    words = cut(words)
    found = near(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    best_n = -F.col("best.less")
    taken = best_n >= F.col("n") * ratio
    rows = words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.other")).alias("form"), F.when(taken, best_n).alias("form_n"),
    )
    rows = cut(rows)
    paths = rows.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        paths = cut(paths.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if paths.filter("moved").isEmpty():
            break
        paths = paths.select("word", "root")
    return rows.join(paths.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
