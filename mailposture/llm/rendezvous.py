"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has its own hash u in (0, 1); a record goes to the shard with the least -ln(u) / weight.
The place depends on the key and the shards alone, so a new shard takes records only into itself, on average
weight / total weight of them, and no other record moves.

Within its shard each record gets a slot, gapless from 0, in the order of a hash of its key and of the columns that tell
rows of one key apart. Slots are numbered without gathering a shard or a key in one task: a bucket is a range of that
hash, buckets are counted first, and each bucket is numbered on its own above the sum of those before it. Rows equal in
all columns are interchangeable; if so many are equal that they fill a bucket, they are counted, numbered as one and
dealt out again. A null key is a key like any other. Empty tables give no rows. Other columns are kept; the new names
must not exist yet, or be given a prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailposture.llm.common import cut, planned_buckets

#: Rows that one numbering task handles about, and the most ranges a shard is parted into.
ROWS_PER_RANGE, MOST_RANGES = 50_000, 2048
#: A range with more than FULL times the usual number of rows holds copies of one row.
FULL = 4


def place(key: str, weights: list[float]) -> Column:
    """Index of the shard of ``key``; ``weights`` has a positive number for each shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    hashed = [F.xxhash64(F.col(key), F.lit(f"shard-{j}")) for j in range(len(weights))]
    if len(set(weights)) == 1:  # equal weights: the largest hash has the least -ln(u)
        scores = [F.struct(h.alias("h"), F.lit(-j).alias("j")) for j, h in enumerate(hashed)]
    else:
        u = [(F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53) for h in hashed]
        scores = [F.struct((F.log(x) / w).alias("h"), F.lit(-j).alias("j")) for j, (x, w) in enumerate(zip(u, weights, strict=True))]
    return (-(F.greatest(*scores) if len(scores) > 1 else scores[0])["j"]).cast("int")


def assign(records: DataFrame, key: str, weights: list[float], ties: list[str] | None = None, grown: list[float] | None = None, prefix: str = "") -> DataFrame:
    """Add shard and slot, and grown_shard (the place among the weights ``grown``) if given; ``prefix`` goes before them.

    ``ties``: the columns that tell rows of one key apart, all if not given.
    """
    shard, slot, larger = (f"{prefix}{x}" for x in ("shard", "slot", "grown_shard"))
    added = [shard, slot, *([larger] if grown else [])]
    if clash := {*added, "_order", "_tie", "_range", "_times", "_before", "_start", "_part", "_i"} & set(records.columns):
        raise ValueError(f"columns exist already, give a prefix: {sorted(clash)}")
    placed = records.withColumn(shard, place(key, weights))
    if grown:
        placed = placed.withColumn(larger, place(key, grown))
    largest = placed.groupBy(shard).count().agg(F.max("count")).first()[0] or 0
    ranges = planned_buckets(largest, ROWS_PER_RANGE, MOST_RANGES)
    bits = ranges.bit_length() - 1
    content = [key, *(ties if ties is not None else [c for c in records.columns if c != key])]
    ranged = placed.withColumns({"_order": F.xxhash64(*content, F.lit("slot")), "_tie": F.xxhash64(*content, F.lit("tie"))})
    ranged = ranged.withColumn("_range", F.shiftrightunsigned("_order", 64 - bits).cast("int") if bits else F.lit(0))
    counts = cut(ranged.groupBy(shard, "_range").count())  # at most len(weights) * MOST_RANGES rows
    before = counts.select(shard, "_range", (F.sum("count").over(Window.partitionBy(shard).orderBy("_range")) - F.col("count")).alias("_before"))
    most = counts.agg(F.max("count")).first()[0] or 0
    bucket = Window.partitionBy(shard, "_range").orderBy("_order", "_tie")
    if most <= FULL * max(ROWS_PER_RANGE, largest // ranges):
        out = ranged.withColumn("_i", F.row_number().over(bucket) - 1).join(F.broadcast(before), [shard, "_range"])
        return out.select(*placed.columns, (F.col("_before") + F.col("_i")).cast("long").alias(slot))
    once = ranged.groupBy(*ranged.columns).agg(F.count("*").alias("_times"))
    start = F.sum("_times").over(bucket.rowsBetween(Window.unboundedPreceding, -1))
    once = once.withColumn("_start", F.coalesce(start, F.lit(0))).join(F.broadcast(before), [shard, "_range"])
    # Parts of ROWS_PER_RANGE copies are dealt to tasks before the copies are made.
    parts = once.withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / ROWS_PER_RANGE)))).repartition("_order", "_part")
    first = F.col("_part") * ROWS_PER_RANGE
    out = parts.withColumn("_i", F.explode(F.sequence(first, F.least(first + ROWS_PER_RANGE, "_times") - 1)))
    return out.select(*placed.columns, (F.col("_before") + F.col("_start") + F.col("_i")).cast("long").alias(slot))


def moved_share(placed: DataFrame) -> DataFrame:
    """Counts of records that stay and that move when the shards grow, from the two places."""
    return placed.groupBy((F.col("shard") != F.col("grown_shard")).alias("moved")).agg(F.count("*").alias("records"))
