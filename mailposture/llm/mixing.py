"""Mixing sources to target weights: hash-threshold histograms.

A source whose target is r times its size (r up to 3) takes every document floor(r) times, and once more those
documents whose hash lies below the source's threshold. The threshold comes from histograms, without sorting: sum
sizes by source and hash bucket, find the bucket in which the cumulated sum meets the budget, refine that bucket
only by the next bits of the hash, and so on until a bucket is a single hash value; then filter by the threshold.
Thresholds are nested: a larger budget takes the same documents and more.

Null texts have size 0 and are taken 0 words; a null source is a source of its own, last in order. The hash
is of id and text, so that rows of one id, or without one, are taken apart. Rows equal in both share a hash and are
taken or left together. An empty table gives no rows. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailposture.llm.common import cut
from mailposture.operators.tables import running

#: Bits of the document hash, refined by LEVEL_BITS at a time.
HASH_BITS, LEVEL_BITS = 48, 12
#: No source, and no document, is taken more often than this.
MOST_REPEATS = 3
#: A table of sources up to this size is broadcast; beyond it the documents of one source are dealt over SALTS parts.
BROADCAST_SOURCES, SALTS = 20_000, 32


def word_count(text: str = "text") -> Column:
    """Number of words (runs of other than ASCII whitespace); null texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def document_hash(key: str = "doc_id", text: str = "text") -> Column:
    """HASH_BITS bits of the md5 of the key written as text, a colon and the text; nulls hash like empty ones."""
    both = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights repeat over the sources in order.

    The targets share the total size by weight. None exceeds MOST_REPEATS times its source's size; what is cut off
    is shared again by weight. That is a water level: sources fill up in the order of capacity over weight, and
    the level is (total - capacity of the full ones) / (weight of the others).
    """
    total, all_weights = F.sum("source_size").alias("total"), F.sum("weight").alias("all")
    ranked = running(sizes.select("source", "source_size"), [F.col("source").asc_nulls_last()], {"rank": F.lit(1)}, limit=BROADCAST_SOURCES)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * MOST_REPEATS).alias("room"))
    rows = running(rows, [(F.col("room") / F.col("weight")).asc(), F.col("source").asc_nulls_last()], {"place": F.lit(1), "full": F.col("room"), "before": F.col("weight")}, limit=BROADCAST_SOURCES)
    rows = rows.crossJoin(F.broadcast(rows.agg(total, all_weights)))  # one row
    rows = rows.withColumn("level", (F.col("total") - F.col("full")) / (F.col("all") - F.col("before")))
    first = rows.filter(F.col("level") * F.col("weight") <= F.col("room")).agg(F.min_by("level", "place").alias("water"))
    rows = rows.crossJoin(F.broadcast(first))  # one row
    target = F.least(F.col("room").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("room").cast("double")))
    return rows.select("source", "source_size", target.alias("target"))


def with_source(docs: DataFrame, sources: DataFrame, source: str = "source", hashed: str = "hash") -> DataFrame:
    """Join documents to a table with one row (_s, ...) a source: by broadcast after a look at the table's size, or
    with the documents of a hot source dealt over SALTS parts."""
    if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(sources), F.col(source).eqNullSafe(F.col("_s")))
    dealt = docs.withColumn("_salt", F.pmod(F.col(hashed), F.lit(SALTS)).cast("int"))
    copies = sources.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_salt") == F.col("_part"))).drop("_salt", "_part")


def thresholds(hashed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, copies, threshold): every document is taken ``copies`` times, and once more if hash < threshold."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    found = targets.select("source", copies.alias("copies"), (F.col("target") - copies * F.col("source_size")).alias("budget"))
    # lower: first hash of the bucket in which the budget ends; below: sum of sizes before it.
    found = found.select("*", F.lit(0).cast("long").alias("lower"), F.lit(0).cast("long").alias("below"))
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        # Only documents in a source's boundary bucket are looked at: all at first, then ever fewer.
        inside = with_source(hashed, found.select(F.col("source").alias("_s"), "lower"))
        inside = inside.filter(F.shiftright("hash", shift + LEVEL_BITS) == F.shiftright("lower", shift + LEVEL_BITS))
        sums = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("held"))
        upto = F.sum("held").over(Window.partitionBy("source").orderBy("bucket"))  # 2**LEVEL_BITS rows a source at most
        sums = sums.select(F.col("source").alias("s"), "bucket", "held", upto.alias("upto"))
        joined = sums.join(found, F.col("source").eqNullSafe(F.col("s"))).withColumn("before", F.col("below") + F.col("upto") - F.col("held"))
        # The last level takes a hash value whole if that comes nearer to the budget than leaving it.
        ends = F.col("below") + F.col("upto") > F.col("budget") if shift else F.col("before") + F.col("below") + F.col("upto") > 2 * F.col("budget")
        first = joined.filter(ends).groupBy("source").agg(F.min_by(F.struct("bucket", "before"), "bucket").alias("at"))
        # Where nothing ends the budget, all of the bucket (of everything, at first) is taken: go on behind it.
        after = (F.shiftright("lower", shift + LEVEL_BITS) + 1) * (1 << (shift + LEVEL_BITS))
        nxt = found.join(first.select(F.col("source").alias("s"), "at"), F.col("source").eqNullSafe(F.col("s")), "left")
        found = cut(
            nxt.select(
                "source",
                "copies",
                "budget",
                F.coalesce(F.col("at.bucket") * (1 << shift), after).cast("long").alias("lower"),
                F.coalesce(F.col("at.before"), F.col("below")).cast("long").alias("below"),
            )
        )
    return found.select("source", "copies", F.col("lower").alias("threshold"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(key, source, size, source_size, target, taken) of every document."""
    hashed = cut(docs.select(F.col(key), F.col(source).alias("source"), word_count(text).alias("size"), document_hash(key, text).alias("hash")))
    targets = cut(source_targets(hashed.groupBy("source").agg(F.sum("size").alias("source_size")), weights))
    plan = thresholds(hashed, targets).alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
    plan = plan.select(F.col("t.source").alias("_s"), "source_size", "target", "copies", "threshold")
    times = F.col("copies") + F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0)
    taken = F.col("size") * F.least(times, F.lit(MOST_REPEATS))
    return with_source(hashed, plan).select(key, "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def repeat(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), source: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them.

    Documents of size 0 have no words to take and stay once.
    """
    sized = docs.withColumns({"_size": word_count(text), "_hash": document_hash(key, text)})
    hashed = cut(sized.select(F.col(source).alias("source"), F.col("_size").alias("size"), F.col("_hash").alias("hash")))
    targets = cut(source_targets(hashed.groupBy("source").agg(F.sum("size").alias("source_size")), weights))
    plan = thresholds(hashed, targets).select(F.col("source").alias("_s"), F.col("copies").alias("_copies"), F.col("threshold").alias("_threshold"))
    times = F.col("_copies") + F.when(F.col("_hash") < F.col("_threshold"), 1).otherwise(0)
    times = F.when(F.col("_size") == 0, 1).otherwise(F.least(times, F.lit(MOST_REPEATS)).cast("int"))
    taken = with_source(sized, plan, source, "_hash").withColumn("_times", times).filter("_times > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(docs.columns)
