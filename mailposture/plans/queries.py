"""Registered queries: each applies an operator to the given tables or to what is derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailposture.functions import records as R
from mailposture.functions.classify import counts_as_using, effective_layer
from mailposture.operators import facts as facts_ops
from mailposture.operators import rules as rules_ops
from mailposture.operators import stats
from mailposture.plans import fixture

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    """Register a query under its name."""
    REGISTRY[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- record text and facts


@query
def dmarc_policy_effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-R7 to F-R10 over all derived DMARC records."""
    rows = fixture.facts(spark, sf_dir)
    return rows.select("k", "dmarc_present", "dmarc_p", "dmarc_sp", "dmarc_pct", F.array_join("dmarc_rua", ",").alias("rua"), "effective_7489", "effective_9989", "sp_effective_7489", "sp_weaker", "policy_label", "blind_enforcement", "spec_version", "dmarc_historic_tags")


@query
def spf_terms_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-R2 to F-R6 over all derived SPF records."""
    rows = fixture.facts(spark, sf_dir)
    return rows.select("k", "spf_present", "spf_error", "spf_all_qualifier", "spf_lookup_count", "spf_redirect", F.array_join("spf_includes", ",").alias("includes"), F.array_join("spf_mechanisms", " ").alias("mechanisms"), "spf_is_flattened", "spf_is_dynamic")


@query
def park_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-C3, F-R17: park class of every derived domain."""
    return fixture.facts(spark, sf_dir).select("k", "mx_present", "mx_null", F.array_join("mx_hosts", ",").alias("mx_hosts"), "park_class")


@query
def facts_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-R1, F-R19, F-R12, F-R13: raw answers folded to one row a domain."""
    rows = facts_ops.build_facts(fixture.bronze(spark, sf_dir))
    return rows.select("domain", "observed", "record_present", "raw_spf", "spf_lookup_count", "dmarc_p", "effective_7489", "mx_null", F.array_join("mx_hosts", ",").alias("mx_hosts"), "dkim_status", F.array_join(F.transform("dkim_key_bits", lambda b: b.cast("string")), ",").alias("key_bits"), "dkim_revoked", "txt_apex_bytes")


@query
def inherited_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies that subdomains inherit from their apex."""
    rows = facts_ops.inherit_policy(fixture.facts(spark, sf_dir), parent="apex")
    return rows.filter("not is_apex").select("k", "domain", "dmarc_present", "applied_7489", "policy_inherited")


@query
def spf_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole SPF evaluations through the name graph."""
    rows = fixture.dns(spark, sf_dir).filter("spf is not null").select(F.col("k").alias("key"), F.col("spf").alias("raw_spf"))
    walked = facts_ops.spf_walk(rows, fixture.graph(spark, sf_dir))
    return walked.select("key", F.least("lookups", F.lit(11)).alias("lookups"), "exceeds", F.when(F.col("lookups") <= 10, F.col("broken_target")).alias("broken_target"))


@query
def redirect_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The qualifier that counts in the end."""
    rows = fixture.dns(spark, sf_dir).filter("spf is not null").select(F.col("k").alias("key"), F.col("spf").alias("raw_spf"))
    return facts_ops.effective_all(rows, fixture.graph(spark, sf_dir))


@query
def address_space_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers covered by the ranges of each supplier's line items, overlaps once."""
    lines = table(spark, sf_dir, "lineitem")
    low = (F.col("l_partkey") * 10).cast("long")
    ranges = lines.select(F.col("l_suppkey").alias("key"), low.alias("low"), (low + F.col("l_quantity").cast("long") * 20).alias("high"))
    return facts_ops.address_space(ranges)


@query
def spf_address_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 on the ip4 terms of the derived records."""
    rows = fixture.dns(spark, sf_dir).select(F.col("k").alias("key"), F.col("spf").alias("raw_spf"))
    return facts_ops.address_space(facts_ops.spf_ranges(rows))


@query
def spf_address_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 in both families, on a record for each order; those of a customer count together."""
    rows = spark.sql("SELECT o_custkey AS key, " + fixture.RANGES + " AS raw_spf FROM {orders}", orders=table(spark, sf_dir, "orders"))
    return facts_ops.spf_spaces(rows).withColumn("ip6_networks", F.col("ip6_networks").cast("long"))


# ---------------------------------------------------------------- inference


def _rules(spark: SparkSession) -> DataFrame:
    return rules_ops.load_rules(spark, fixture.RULES, "1")


@query
def rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All (rule, value) pairs of the derived facts."""
    hits = rules_ops.match_rules(fixture.facts(spark, sf_dir), _rules(spark), ["k"])
    return hits.select("k", F.col("id").alias("rule_id"), "record_type", "value")


@query
def rule_match_all_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 on page URLs: every pattern that every URL matches."""
    patterns = {"com": r"\.example\.com/", "lang": r"/(de|fr)/\d+", "sub": r"//(www|m|blog)\.", "query": r"\?"}
    rules = rules_ops.load_rules(spark, [{"id": k, "vendor": k, "category": "esp", "record": "TXT", "pattern": p} for k, p in patterns.items()])
    pages = table(spark, sf_dir, "pages").select("page_id", F.array("url").alias("verification_txt"))
    return rules_ops.match_rules(pages, rules.filter("record = 'TXT'"), ["page_id"]).select("page_id", "id")


@query
def inferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5, F-C4 to F-C7, W1 to W4: inferred vendors with confidence, layer, primary flag and sentinels."""
    rows = rules_ops.infer(fixture.stored_facts(spark, sf_dir), _rules(spark), ["k"])
    return rows.select("k", "category", "layer", "vendor", "product", "confidence", "engine", "undetectable_reason", "is_layer_primary", F.coalesce("hits", F.lit(0)).alias("hits"))


def _using(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["k", "population_id", "entity_id", "domain_id"]
    rows = rules_ops.infer(fixture.stored_facts(spark, sf_dir), _rules(spark), keys)
    types = F.coalesce(F.transform("evidence", lambda e: e["record_type"]), R.no_strings())
    rows = rows.withColumns({"layer": effective_layer(F.col("layer"), F.col("category"), types), "receiving": F.array_contains(types, "MX")})
    return rows.filter(counts_as_using(F.col("vendor"), F.col("undetectable_reason"), F.col("is_layer_primary"), F.col("layer")))


@query
def platform_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, F-C8: platform table of each population, small vendors bundled."""
    return stats.stats_platform(_using(spark, sf_dir), "population_id", k=40)


@query
def vendor_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that count for each gateway vendor."""
    return stats.vendor_share(rules_ops.infer(fixture.stored_facts(spark, sf_dir), _rules(spark), ["k"]), "security_gateway")


@query
def topn_with_remainder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent page hosts, and what the list leaves out."""
    pages = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    rows = pages.select(F.regexp_replace(host, r"^(www|m|blog)\.", "").alias("registered_domain"), host.alias("host"))
    return rules_ops.unknown_hosts(rows, 10).withColumn("examples", F.array_join("examples", ","))


# ---------------------------------------------------------------- statistics

SEGMENT_METRICS = [
    "total_domains",
    "observed_domains",
    "entities_with_domains",
    "spf_adopted_entities",
    "spf_adopted_domains",
    "dmarc_adopted_domains",
    "dmarc_enforced_entities",
    "dmarc_enforced_domains",
    "dmarc_invalid_domains",
    "dmarc_no_rua_domains",
    "dmarc_none_no_rua_domains",
    "rua_placeholder_domains",
    "reject_with_rua_domains",
    "nominal_reject_domains",
    "enforced_reject_domains",
    "blind_reject_domains",
    "sp_enforced_domains",
    "sp_weaker_domains",
    "subdomains_measured",
    "subdomains_observed",
    "subdomains_with_own_dmarc",
    "spf_all_fail_domains",
    "spf_all_softfail_domains",
    "spf_all_neutral_domains",
    "spf_all_missing_domains",
    "dmarc_historic_tags_domains",
    "dmarc_testing_domains",
    "sending_domains",
    "parked_domains",
    "parked_hardened",
    "parked_neglected",
    "park_defense_rate",
]


@query
def adoption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: SPF and DMARC adoption and enforcement among the observed domains of each population."""
    rows = stats.stats_overall(fixture.domain_rows(spark, sf_dir), ["population_id"])
    share = lambda c: F.round(F.col(c) / F.nullif(F.col("observed_domains"), F.lit(0)), 4)
    counts = ["observed_domains", "spf_adopted_domains", "dmarc_adopted_domains", "dmarc_enforced_domains"]
    return rows.select("population_id", *counts, share("dmarc_adopted_domains").alias("dmarc_share"), share("dmarc_enforced_domains").alias("enforced_share"))


@query
def stats_overall_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric table of each population."""
    return stats.stats_overall(fixture.domain_rows(spark, sf_dir), ["population_id"]).select("population_id", *SEGMENT_METRICS)


@query
def stats_overall_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of mail use by entity and maturity by domain, of each population."""
    rows = stats.stats_overall(fixture.domain_rows(spark, sf_dir), ["population_id"])
    return rows.select("population_id", "evidence_signed_entities", "evidence_sending_entities", "evidence_receiving_entities", "evidence_none_entities", "maturity_0", "maturity_1", "maturity_stage_dist")


@query
def stats_sector_suppressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, A3: sectors of each population with small cells hidden."""
    rows = fixture.domain_rows(spark, sf_dir)
    totals = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("population_id"), F.col("c_nationkey").alias("sector_code")).agg(F.count("*").alias("n"))
    out = stats.stats_by_sector(rows, "population_id", "sector_code", totals, k=8)
    return out.select("population_id", "sector_label", "total_entities", "total_domains", "observed_domains", "spf_adopted_domains", "dmarc_enforced_domains")


@query
def suppression_recoverable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4: hidden cells of each population and whether they could be computed."""
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("population_id"), F.col("c_nationkey").alias("sector_code")).agg(F.count("*").alias("n"))
    return stats.is_recoverable(stats.suppression_plan(counts, "population_id", "sector_code", "n", 8), "population_id", "n", 8)


@query
def ownership_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities by order status, all cells present."""
    return stats.ownership_crosstab(table(spark, sf_dir, "orders"), [], "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


def _months(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [fixture.facts(spark, sf_dir, m).withColumn("has_rua", F.size("dmarc_rua") > 0) for m in (1, 2, 3)]


@query
def monthly_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each domain from the first month to the third."""
    first, second, third = _months(spark, sf_dir)
    return stats.monthly_delta(third, second, first)


@query
def monthly_delta_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as counts."""
    first, second, third = _months(spark, sf_dir)
    return stats.delta_counts(stats.monthly_delta(third, second, first))


@query
def transition_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves of the derived domains between policy states from the first month to the second."""
    first, second, _ = _months(spark, sf_dir)
    return stats.transition_matrix(stats.monthly_delta(second, first))


@query
def metric_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order figures that changed from one month to the next."""
    month = F.trunc("o_orderdate", "month")
    sums = table(spark, sf_dir, "orders").groupBy("o_orderpriority", month.cast("date").alias("m")).agg(F.count("*").alias("orders"), F.sum(F.floor("o_totalprice")).alias("volume"))
    later = sums.withColumn("m", F.add_months("m", -1))
    return stats.changes(later, sums, ["o_orderpriority", "m"], ["orders", "volume"])


@query
def headline_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of headline figures of each population between two months, and whether domains shrank."""
    now, before = (stats.stats_overall(fixture.domain_rows(spark, sf_dir, m), ["population_id"]) for m in (2, 1))
    names = [c for c in stats.HEADLINE if c != "total_entities"]
    small = stats.shrinking(now, before).select("population_id", F.lit(True).alias("shrunk"))
    return stats.diff_stats(now, before, ["population_id"], names).join(small, "population_id", "left").withColumn("shrunk", F.coalesce("shrunk", F.lit(False)))


@query
def indicator_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates and bands of each population."""
    rows = stats.stats_overall(fixture.domain_rows(spark, sf_dir), ["population_id"])
    ratios = {"spf": ("spf_adopted_domains", "observed_domains"), "dmarc": ("dmarc_adopted_domains", "observed_domains"), "enforced": ("dmarc_enforced_domains", "observed_domains"), "subdomains": ("subdomains_with_own_dmarc", "subdomains_observed")}
    return stats.indicators(rows, ["population_id"], ratios)
