"""Small helpers over whole tables: one row for each key, broadcasts behind a look at the size."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailposture.session import cut

#: Most rows of a table that is broadcast.
BROADCAST_ROWS = 100_000


def least_row(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """(keys, columns): one row for each key; of several the least, so that it does not matter how they lie."""
    columns = columns if columns is not None else [c for c in df.columns if c not in keys]
    if not columns:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_least")).select(*keys, "_least.*")


def short(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The table, marked for broadcast if it has ``limit`` rows at most; else Spark joins it by a shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def running(rows: DataFrame, order: list[Column], sums: dict[str, Column], keys: list[str] | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Add for each name the sum of its column over the rows before this one, in ``order`` and within equal ``keys``.

    The order should leave no ties. Beyond ``limit`` rows these are dealt to ranges of keys and order, of about that
    many; each range is added up on its own, above the sums of those before it, so that no group is gathered in one task.
    """
    zero = lambda c: F.coalesce(c, F.lit(0))
    return _before(rows, order, sums, keys or [], limit, lambda c: F.sum(c), zero, lambda a, b: a + b)


def reached(rows: DataFrame, order: list[Column], tops: dict[str, Column], keys: list[str] | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The same with the largest value before this row; NULL where there is none. Ties may lie in any order."""
    return _before(rows, order, tops, keys or [], limit, lambda c: F.max(c), lambda c: c, F.greatest)


def _before(rows: DataFrame, order: list[Column], folds: dict[str, Column], keys: list[str], limit: int, fold: Callable[[Column], Column], empty: Callable[[Column], Column], join: Callable[[Column, Column], Column]) -> DataFrame:
    parts = math.ceil(rows.count() / limit)
    if parts <= 1:
        group = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select("*", *[empty(fold(c).over(group)).alias(k) for k, c in folds.items()])
    dealt = rows.repartitionByRange(parts, *[F.col(k).asc() for k in keys], *order)
    dealt = cut(dealt.select("*", F.spark_partition_id().alias("_range"), *[c.alias(f"_{k}") for k, c in folds.items()]))
    ranges = dealt.groupBy(*keys, "_range").agg(*[fold(F.col(f"_{k}")).alias(f"_{k}_all") for k in folds])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = {f"_{k}_before": empty(fold(F.col(f"_{k}_all")).over(earlier)) for k in folds}
    ranges = ranges.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_range").alias("_r"), *[c.alias(n) for n, c in before.items()])
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.select("*", *[empty(fold(F.col(f"_{k}")).over(inside)).alias(f"_{k}_inside") for k in folds])
    same = F.col("_range") == F.col("_r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    out = out.join(short(ranges), same)
    return cut(out.select(*rows.columns, *[join(F.col(f"_{k}_before"), F.col(f"_{k}_inside")).alias(k) for k in folds]))


def must_be_short(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The same for joins by a pattern, which know no other way: raises beyond the limit."""
    if df.limit(limit + 1).count() > limit:
        raise ValueError(f"more than {limit} patterns: split the table and join part by part")
    return F.broadcast(df)
