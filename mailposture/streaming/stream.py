"""Streams: ingest, de-duplication, stale streaks, health."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mailposture.functions.classify import yes
from mailposture.sources.bronze import RAW, typed_answers

STALE_MONTHS = 3


def stream_bronze(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    """New raw answers as they are appended; each part file is read once, as the checkpoint remembers."""
    rows = spark.readStream.schema(f"{RAW}, method string").option("maxFilesPerTrigger", files_per_trigger).option("basePath", root).json(f"{root}/method=*")
    return typed_answers(rows)


def ingest(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all that is new to a Parquet folder, exactly once, then stop."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("method").trigger(availableNow=True).start()


def dedupe_stream(df: DataFrame, keys: list[str], time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The first answer of each key within the watermark's delay; state older than that is dropped."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def health_stream(df: DataFrame, time: str = "ts", delay: str = "2 hours", width: str = "1 hour", keys: tuple[str, ...] = ("purpose", "rcode")) -> DataFrame:
    """Answers and unobserved answers by hour, purpose and answer code; late ones count within the delay."""
    grouped = df.withWatermark(time, delay).groupBy(F.window(time, width), *keys)
    return grouped.agg(F.count("*").alias("answers"), F.count_if(~yes(F.col("observed"))).alias("unobserved")).select(F.col("window.start").alias("hour"), *keys, "answers", "unobserved")


def stale_streak_stream(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, month, streak, is_stale) for monthly rows (keys, month int, corroborated boolean).

    The state of a key is its streak and last month. A month without corroboration counts on, one with it starts
    anew; repeated and earlier months change nothing.
    """
    out = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", month int, streak int, is_stale boolean"

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak, last = state.get if state.exists else (0, -1)
        rows = pd.concat(list(batches)).sort_values("month")
        done = []
        for month, held in zip(rows["month"], rows["corroborated"], strict=True):
            if month <= last:
                continue
            streak, last = (0 if held is True or held == 1 else streak + 1), int(month)
            done.append((*key, last, streak, streak >= STALE_MONTHS))
        state.update((streak, last))
        yield pd.DataFrame(done, columns=[*keys, "month", "streak", "is_stale"])

    return df.groupBy(*keys).applyInPandasWithState(update, out, "streak int, last int", "append", GroupStateTimeout.NoTimeout)


def run_once(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> StreamingQuery:
    """Run a stream over all that is there into a memory table; for tests and looks at small results."""
    writer: DataStreamWriter = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    query = (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
    query.awaitTermination()
    return query
