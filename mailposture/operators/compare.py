"""Measurement quality: method comparison, saturation, samples, health, acceptance."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailposture.functions.classify import yes
from mailposture.functions.records import join_chunks
from mailposture.operators.tables import running, short
from mailposture.session import cut

#: Distinct values up to which a window may add up the values of a group.
WINDOW_ROWS = 1_000_000


def dedupe_last(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Of rows with equal keys the one that was written last, by the order columns."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def dedupe_first(df: DataFrame, keys: list[str], order: list[str], fill: list[str] | None = None) -> DataFrame:
    """The first row of each key; empty ``fill`` columns take the first value that a later row has."""
    at = F.struct(*order)
    filled = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(f"_{c}") for c in fill or []]
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), at).alias("r"), *filled)
    return out.select(*[F.coalesce(f"r.{c}", f"_{c}").alias(c) if c in (fill or []) else F.col(f"r.{c}").alias(c) for c in df.columns])


def comparison_key(bronze: DataFrame) -> DataFrame:
    """Bronze with the columns that comparisons join on: name, type, purpose, and the values sorted."""
    values = F.array_sort(F.transform(F.coalesce("answers", F.array().cast("array<struct<type:string,ttl:int,data:array<string>>>")), lambda a: join_chunks(a["data"])))
    return bronze.withColumns({"name": F.lower(F.regexp_replace("query_name", r"\.+$", "")), "qtype": F.upper("query_type"), "found": values})


def compare_methods(a: DataFrame, b: DataFrame, keys: list[str], purpose: str, observed: str = "observed", present: str = "record_present", values: str = "found") -> DataFrame:
    """(keys, kind) for every key of a purpose that both sides ask for.

    Kinds: only_in_a, only_in_b, observation_differs (one side could not ask), presence_differs, values_differ, agree.
    Both sides must be free of repeated keys (``dedupe_last``); purposes that one side lacks are no difference.
    """
    both = short(a.select(purpose).distinct().intersect(b.select(purpose).distinct()))
    take = lambda df, p: df.join(both, purpose, "left_semi").select(*keys, *[F.col(c).alias(f"{p}_{n}") for c, n in ((observed, "o"), (present, "p"), (values, "v"))], F.lit(True).alias(p))
    joined = take(a, "a").join(take(b, "b"), keys, "full")
    kind = (
        F.when(F.col("b").isNull(), "only_in_a")
        .when(F.col("a").isNull(), "only_in_b")
        .when(~yes(F.col("a_o")) | ~yes(F.col("b_o")), "observation_differs")
        .when(yes(F.col("a_p")) != yes(F.col("b_p")), "presence_differs")
        .when(~F.col("a_v").eqNullSafe(F.col("b_v")), "values_differ")
        .otherwise("agree")
    )
    return joined.select(*keys, kind.alias("kind"))


def plan_diff(a: DataFrame, b: DataFrame, purpose: str = "purpose") -> DataFrame:
    """(purpose, side): purposes in common and on one side only."""
    x, y = a.select(purpose).distinct(), b.select(purpose).distinct()
    side = lambda df, name: df.withColumn("side", F.lit(name))
    return side(x.intersect(y), "both").unionByName(side(x.subtract(y), "only_a")).unionByName(side(y.subtract(x), "only_b"))


def samples(df: DataFrame, key: str, k: int, order: list[str]) -> DataFrame:
    """T5: the first ``k`` rows of each class by a fixed order."""
    return df.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_i") <= k).drop("_i")


def method_stats(bronze: DataFrame) -> DataFrame:
    """Records, observed, present of each method, and a map of answer codes."""
    codes = bronze.groupBy("method", F.coalesce("rcode", F.lit("UNKNOWN")).alias("rcode")).agg(F.count("*").alias("n"), F.count_if(yes(F.col("observed"))).alias("o"), F.count_if(yes(F.col("record_present"))).alias("p"))
    return codes.groupBy("method").agg(F.sum("n").alias("records"), F.sum("o").alias("observed"), F.sum("p").alias("record_present"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("rcode", "n")))).alias("by_rcode"))


def sample_targets(df: DataFrame, key: str, rate: float, seed: int = 0) -> DataFrame:
    """T4: ceil(n * rate) keys, at least one, the same on every run: those with the smallest seeded hashes."""
    rows = df.select(key).distinct()
    n = rows.count()
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(max(1, math.ceil(n * rate)) if n else 0)


def saturation(hits: DataFrame, item: str, domain: str, order: list[str] | None = None) -> DataFrame:
    """(used, item, hits, new_domains, cumulative_domains, dead): what each further item adds.

    Items are taken by frequency and name, or in the given order. A domain counts for the first item that finds it;
    the curve itself is over the items, which are few, while the finders are one pass over the hits.
    """
    rows = hits.select(F.col(item).alias("item"), F.col(domain).alias("domain")).distinct()
    counts = rows.groupBy("item").agg(F.count("*").alias("hits"))
    if order is None:
        ranked = counts.withColumn("used", F.row_number().over(Window.orderBy(F.desc("hits"), "item")))
    else:
        places = rows.sparkSession.createDataFrame(list(enumerate(order, 1)), "used int, item string")
        ranked = places.join(counts, "item", "left").na.fill(0, ["hits"])
    finders = rows.join(short(ranked.select("item", "used")), "item").groupBy("domain").agg(F.min("used").alias("used"))
    new = finders.groupBy("used").agg(F.count("*").alias("new_domains"))
    out = ranked.join(new, "used", "left").na.fill(0, ["new_domains"])
    upto = F.sum("new_domains").over(Window.orderBy("used").rowsBetween(Window.unboundedPreceding, 0))
    return out.select(F.col("used").cast("int").alias("used"), "item", "hits", "new_domains", upto.alias("cumulative_domains"), (F.col("new_domains") == 0).alias("dead"))


def coverage(curve: DataFrame, n: int) -> Column:
    """Share of all found domains that the first ``n`` items find; use in ``curve.agg(...)``."""
    return F.round(F.max(F.when(F.col("used") <= n, F.col("cumulative_domains"))) / F.max("cumulative_domains"), 4)


def items_for(fraction: float) -> Column:
    """How many items it takes to find a share of the domains; use over a curve with its total in ``total``."""
    return F.min(F.when(F.col("cumulative_domains") >= F.col("total") * fraction, F.col("used")))


def selector_of(query_name: Column) -> Column:
    """Selector in a DKIM query name; NULL if it is none."""
    return F.when(query_name.contains("._domainkey."), F.nullif(F.lower(F.substring_index(query_name, "._domainkey.", 1)), F.lit("")))


def percentiles(df: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """N, p50 (median cut to an integer), p90 (value at place int(0.9 n) in order), max and mean of each group.

    The place of p90 is found by counting equal values and adding up, not by gathering a group; of a column with very
    many values the sums are formed range by range.
    """
    keys = keys or []
    there = df.filter(F.col(column).isNotNull())
    counts = there.groupBy(*keys, column).agg(F.count("*").alias("c"))
    few = there.count() <= WINDOW_ROWS
    if not few:
        counts = cut(counts)
        few = counts.limit(WINDOW_ROWS + 1).count() <= WINDOW_ROWS
    if few:
        upto = counts.withColumn("upto", F.sum("c").over(Window.partitionBy(*keys).orderBy(column)))
    else:
        upto = running(counts, [F.col(column).asc()], {"_earlier": F.col("c")}, keys, WINDOW_ROWS).withColumn("upto", F.col("_earlier") + F.col("c")).drop("_earlier")
    totals = counts.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sum("c").alias("n"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    rows = upto.join(short(totals), same)
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col(column)))
    n = F.col("n")
    out = rows.groupBy(*keys).agg(F.max("n").alias("n"), at(F.floor((n - 1) / 2)).alias("_lo"), at(F.floor(n / 2)).alias("_hi"), at(F.floor(n * 0.9)).alias("p90"), F.max(column).alias("max"), (F.sum(F.col(column) * F.col("c")) / F.max("n")).alias("mean"))
    return out.select(*keys, "n", F.floor((F.col("_lo") + F.col("_hi")) / 2).cast("long").alias("p50"), "p90", "max", "mean")


def measure_health(bronze: DataFrame) -> DataFrame:
    """Rows by purpose and answer code, and how many of them were not observed."""
    return bronze.groupBy("purpose", F.coalesce("rcode", F.lit("UNKNOWN")).alias("rcode")).agg(F.count("*").alias("answers"), F.count_if(~yes(F.col("observed"))).alias("unobserved"))


def domain_health(bronze: DataFrame) -> DataFrame:
    """Domains that were fully, partly and not at all observed."""
    one = bronze.groupBy("domain").agg(F.every(yes(F.col("observed"))).alias("all_"), F.some(yes(F.col("observed"))).alias("any_"))
    return one.agg(F.count_if("all_").alias("fully"), F.count_if(F.col("any_") & ~F.col("all_")).alias("partly"), F.count_if(~F.col("any_")).alias("none"))


def run_metrics(outcomes: DataFrame, phase: str) -> DataFrame:
    """(phase, input, success, failed, skipped, status, failures, warnings) from (key, outcome, reason, warning).

    Failures are counted by reason, warnings by code with their first five keys. A phase is failed if all input
    failed, partial if some did.
    """
    reasons = outcomes.filter("outcome = 'failed'").groupBy("reason").agg(F.count("*").alias("n"))
    failures = reasons.agg(F.array_sort(F.collect_list(F.struct("reason", "n"))).alias("failures"))
    first = outcomes.filter("warning is not null").groupBy("warning").agg(F.count("*").alias("n"))
    few = samples(outcomes.filter("warning is not null"), "warning", 5, ["key"]).groupBy("warning").agg(F.array_sort(F.collect_list("key")).alias("examples"))
    warnings = first.join(few, "warning").agg(F.array_sort(F.collect_list(F.struct("warning", "n", "examples"))).alias("warnings"))
    n = lambda o: F.count_if(F.col("outcome") == o)
    counts = outcomes.agg(F.lit(phase).alias("phase"), F.count("*").alias("input"), n("success").alias("success"), n("failed").alias("failed"), n("skipped").alias("skipped"))
    status = F.when((F.col("input") > 0) & (F.col("failed") == F.col("input")), "failed").when(F.col("failed") > 0, "partial").otherwise("success")
    return counts.withColumn("status", status).crossJoin(failures).crossJoin(warnings)


def acceptance(df: DataFrame, checks: dict[str, tuple[Column, float | None, float | None]]) -> DataFrame:
    """(check, value, low, high, passed) of named aggregate columns against their bounds."""
    names = list(checks)
    one = df.agg(*[checks[c][0].cast("double").alias(c) for c in names]).unpivot([], names, "check", "value")
    bounds = one.sparkSession.createDataFrame([(c, *[None if x is None else float(x) for x in checks[c][1:]]) for c in names], "check string, low double, high double")
    inside = (F.col("low").isNull() | (F.col("value") >= F.col("low"))) & (F.col("high").isNull() | (F.col("value") <= F.col("high")))
    return one.join(bounds, "check").withColumn("passed", F.coalesce(inside, F.lit(False)))


def run_table(metrics: DataFrame, phases: list[str]) -> DataFrame:
    """One row for each phase in order; phases that did not run are marked so, not failed."""
    wanted = metrics.sparkSession.createDataFrame(list(enumerate(phases)), "place int, phase string")
    return wanted.join(metrics, "phase", "left").withColumn("status", F.coalesce("status", F.lit("not_run")))


def phase_flow(runs: DataFrame) -> DataFrame:
    """Each phase that ran with the success of the one before, and the difference to its own input."""
    ran = runs.filter("status <> 'not_run'")
    before = F.lag("success").over(Window.orderBy("place"))  # a handful of phases
    return ran.withColumn("previous_success", before).withColumn("gap", F.col("previous_success") - F.col("input"))
