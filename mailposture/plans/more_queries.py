"""Registered queries of the operators that the other two modules leave out: records, statistics, populations, texts,
sources, sinks and streams, on what is derived from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mailposture.functions import classify as C
from mailposture.functions import names as N
from mailposture.functions import records as R
from mailposture.functions import text as T
from mailposture.operators import candidates, population, stats, views
from mailposture.operators import facts as facts_ops
from mailposture.operators import rules as rules_ops
from mailposture.plans import fixture
from mailposture.plans.queries import query, table
from mailposture.session import ensure_checkpoint_dir
from mailposture.sources import bronze as bronze_io
from mailposture.sources import listings, tables
from mailposture.streaming import stream


def joined(c: str | Column) -> Column:
    """An array of strings as one text."""
    return F.array_join(c, ",")


def folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/query-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- records and facts


@query
def facts_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-R13 to F-R18, J34, U4: what the other records of each domain say."""
    rows = facts_ops.build_facts(fixture.bronze_full(spark, sf_dir))
    plain = ["domain", "dnssec_signed", "mta_sts_present", "mta_sts_id", "tls_rpt_present", "bimi_present", "bimi_has_svg", "bimi_has_vmc", "dane_present", "dane_orphan", "dkim_wildcard_suspect", "dkim_wildcard_revoked", "dkim_domainkey_exists", "dkim_status", "dkim_testing_flag", "dkim_ed25519_only", "txt_apex_count", "txt_apex_tcp", "rua_external"]
    lists = {"tls_rpt_rua": "tls_rpt_rua", "dkim_selectors": "dkim_selectors", "cnames": "dkim_cname_targets", "other_txt": "verification_txt"}
    return rows.select(*plain, *[joined(c).alias(name) for name, c in lists.items()], joined(F.transform("dkim_key_bits", lambda b: b.cast("string"))).alias("key_bits"))


@query
def first_look(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-C2: the probe row of each derived domain."""
    rows = facts_ops.first_look(fixture.bronze_full(spark, sf_dir))
    return rows.withColumns({c: joined(c) for c in ("mx_hosts", "spf_includes", "failures")})


@query
def dkim_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains that answer for a selector that nobody uses."""
    return facts_ops.dkim_control(fixture.bronze_full(spark, sf_dir))


@query
def answer_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-R20: pages as answers of every code, with and without content."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.element_at(F.array(*[F.lit(x) for x in ("NOERROR", "NODATA", "NXDOMAIN", "SERVFAIL", "TIMEOUT")]), (F.col("page_id") % 5 + 1).cast("int")).alias("rcode"), F.when(F.col("page_id") % 2 == 0, F.array("url")).otherwise(R.no_strings()).alias("answers"))
    return rows.select("page_id", "rcode", R.answer_state(F.col("rcode"), F.col("answers")).alias("s")).select("page_id", "rcode", "s.observed", "s.record_present")


@query
def sts_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-R15: policy texts of suppliers, and whether their mail host fits."""
    k = F.col("s_suppkey")
    line = lambda cond, text: F.when(cond, text).otherwise(F.lit(""))
    text = F.concat(line(k % 7 > 0, F.lit("version: STSv1\r\n")), F.lit("mode: "), F.element_at(F.array(*[F.lit(x) for x in ("enforce", "Testing", "none", "strict")]), (k % 4 + 1).cast("int")), F.lit("\n"), line(k % 3 > 0, F.lit("mx: *.vendor.example.\nMX: Mail.Example\n")), F.lit("max_age: "), (k * 1000000).cast("string"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", R.sts_policy(F.when(k % 11 > 0, text)).alias("p"), F.array(F.when(k % 2 == 0, F.lit("a.vendor.example")).otherwise(F.lit("a.b.vendor.example"))).alias("hosts"))
    return rows.select("s_suppkey", "p.valid", "p.mode", "p.max_age", joined("p.mx").alias("mx"), R.sts_mismatch(F.col("p"), F.col("hosts")).alias("mismatch"))


@query
def fact_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each owner of a domain; domains without one are unknown's."""
    rows = fixture.dns(spark, sf_dir)
    owned = rows.filter("k % 3 > 0").select("domain", F.concat(F.lit("d"), "k").alias("domain_id"), "entity_id", "is_apex")
    second = owned.filter("domain_id like '%7'").withColumn("entity_id", F.lit("e-second"))
    return facts_ops.fan_out(rows.select("domain", "observed"), owned.unionByName(second)).select("domain", "entity_id", "observed")


@query
def measured_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of domains that are measured no longer."""
    domains = fixture.dns(spark, sf_dir).select("domain", (F.col("k") % 4 > 0).alias("is_measured"), F.when(F.col("k") % 2 == 0, "A").otherwise("C").alias("measure_tier"))
    kept, left = facts_ops.restrict_to_measured(fixture.bronze(spark, sf_dir), candidates.measured(domains, "A"))
    return left.unionByName(kept.groupBy("domain").agg(F.lit(0).cast("long").alias("rows_left_out")))


@query
def mx_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the MX hosts of each domain have addresses, and whether somebody could register them."""
    facts = fixture.facts(spark, sf_dir)
    number = F.conv(F.substring(F.md5(F.col("name").cast("binary")), 1, 4), 16, 10).cast("int")
    hosts = facts.select(F.explode("mx_hosts").alias("name")).distinct().withColumn("n", number)
    answer = lambda qtype, seen, present, rcode: hosts.select("name", F.lit(qtype).alias("qtype"), seen.alias("observed"), (seen & present).alias("record_present"), rcode.alias("rcode"))
    n = F.col("n")
    code = F.when(n % 5 == 1, "NXDOMAIN").when(n % 5 == 2, "SERVFAIL").when(n % 5 == 3, "NODATA").otherwise("NOERROR")
    a = answer("A", n % 5 != 2, n % 5 == 0, code)
    aaaa = answer("AAAA", n % 7 != 2, n % 7 == 0, F.lit("NOERROR"))
    rules = spark.createDataFrame([(r,) for r in fixture.SUFFIX_RULES], "rule string")
    owner = N.registrable(hosts, "name", rules, "owner").select(F.coalesce("owner", "name").alias("name")).distinct().withColumn("n", number)
    ns = owner.select("name", F.lit("NS").alias("qtype"), (n % 3 > 0).alias("observed"), F.lit(False).alias("record_present"), F.when(n % 3 == 1, "NXDOMAIN").otherwise("NOERROR").alias("rcode"))
    out = facts_ops.mx_reach(facts, a.unionByName(aaaa).unionByName(ns), rules)
    return out.withColumn("mx_hosts_nxdomain", joined("mx_hosts_nxdomain"))


@query
def report_permissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the report targets of each domain allow it, and whether they are registered."""
    facts = fixture.facts(spark, sf_dir)
    asked = facts.select("k", "domain", F.explode("dmarc_rua").alias("target"))
    permit = asked.select(F.concat("domain", F.lit("._report._dmarc."), "target").alias("name"), F.lit("TXT").alias("qtype"), (F.col("k") % 3 > 0).alias("observed"), (F.col("k") % 3 == 1).alias("record_present"), F.lit("NOERROR").alias("rcode"))
    ns = spark.createDataFrame([("r.example", "NS", True, False, "NXDOMAIN"), ("s.example", "NS", False, None, "SERVFAIL")], "name string, qtype string, observed boolean, record_present boolean, rcode string")
    rules = spark.createDataFrame([("example",)], "rule string")
    return facts_ops.rua_checks(facts, permit.unionByName(ns), rules)


@query
def wildcard_mx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MX of guessed names below an apex that answers for any name."""
    rows = fixture.facts(spark, sf_dir).select("domain", "apex", (~F.col("is_apex")).alias("guessed"), F.col("mx_present").alias("mx_exists"), "k")
    probe = rows.select(F.concat(F.lit("wildcard-check-0000."), "apex").alias("name"), F.lit("MX").alias("qtype"), (F.length("apex") % 2 == 0).alias("observed"), F.lit(True).alias("record_present")).distinct()
    return facts_ops.demote_wildcard(rows.drop("k"), probe)


@query
def spf_walk_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole SPF evaluations that stay within ten lookups, with every name that could not be read."""
    rows = fixture.dns(spark, sf_dir).filter("spf is not null").select(F.col("k").alias("key"), F.col("spf").alias("raw_spf"))
    walked = facts_ops.spf_walk(rows, fixture.graph(spark, sf_dir)).filter("lookups <= 10")
    return walked.select("key", "lookups", "complete", *[joined(c).alias(c) for c in ("missing", "multiple", "macro", "unobserved")])


# ---------------------------------------------------------------- inference


OWN_TEXT_RULES = [
    *fixture.RULES,
    {"id": "f-own", "vendor": "Vendor F", "category": "verification_txt", "record": "TXT", "pattern": "^vendor-f-verification=", "confidence": "medium", "corroborated_by": ("vendor-c", ["spf.vendor-b.example"], "vendor-d")},
    {"id": "a-own", "vendor": "Vendor A", "category": "verification_txt", "record": "TXT", "pattern": "^vendor-a-site=", "confidence": "high"},
]


def _own_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the fixture with ownership texts and CNAMEs, written once."""
    more = spark.sql(fixture.extras_sql().replace("FROM customer", "FROM {customer}"), customer=table(spark, sf_dir, "customer")).filter("observed")
    one = lambda c: F.array_compact(F.array(c))
    texts = more.select("k", one("other").alias("verification_txt"), one(F.lower(R.no_dot("cname"))).alias("dkim_cname_targets"))
    rows = fixture.stored_facts(spark, sf_dir).drop("verification_txt", "dkim_cname_targets").join(texts, "k", "left")
    return rows.withColumns({c: F.coalesce(c, R.no_strings()) for c in ("verification_txt", "dkim_cname_targets")})


@query
def ownership_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6, F-C5, W4: what ownership texts say, corroborated or not, and for how many months without."""
    rules = rules_ops.load_rules(spark, OWN_TEXT_RULES, "1")
    prev = fixture.dns(spark, sf_dir).select("k", F.lit("esp").alias("category"), F.lit("Vendor F").alias("vendor"), (F.col("k") % 4).cast("int").alias("stale_streak_months")).filter("stale_streak_months > 0")
    rows = rules_ops.infer(_own_texts(spark, sf_dir), rules, ["k"], prev)
    return rows.filter("vendor in ('Vendor F', 'Vendor A')").select("k", "category", "layer", "vendor", "confidence", "corroborated", "only_ownership_text", "stale_streak_months", "is_stale", "hits")


@query
def parked_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains by park class, counted over inference rows of which one each has it."""
    facts = fixture.stored_facts(spark, sf_dir)
    rows = rules_ops.infer(facts, rules_ops.load_rules(spark, fixture.RULES, "1"), ["k"])
    once = rules_ops.attach_once(rows, facts.select("k", "park_class"), "k")
    return once.groupBy("park_class").agg(F.count("*").alias("rows")).filter("park_class is not null")


@query
def vendor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors and hidden companies of each layer, on suppliers as vendors of parts' brands."""
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.select(F.lit("p").alias("g"), F.concat(F.lit("l"), F.col("l_linenumber") % 3).alias("layer"), F.concat(F.lit("v"), F.col("l_suppkey") % 50).alias("vendor"), F.concat(F.lit("e"), F.col("l_orderkey") % 4000).alias("entity_id"), F.concat(F.lit("d"), F.col("l_orderkey")).alias("domain_id"), F.lit(None).cast("string").alias("engine"), F.lit(True).alias("receiving"))
    return stats.platform_summary(stats.stats_platform(rows, "g", k=30))


@query
def self_hosted_mx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-C12: domains whose MX hosts are all below their own registrable domain."""
    rules = spark.createDataFrame([(r,) for r in fixture.SUFFIX_RULES], "rule string")
    rows = fixture.facts(spark, sf_dir).select("k", "apex", F.explode("mx_hosts").alias("host"))
    hosts = N.registrable(rows, "host", rules).groupBy("k", "apex").agg(F.collect_list("registrable").alias("owners"))
    return hosts.select("k", C.self_hosted(F.col("owners"), F.col("apex")).alias("self_hosted"))


@query
def policy_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-C13: policies in words."""
    return fixture.facts(spark, sf_dir).select("k", C.describe_policy(F.col("dmarc_p"), F.size("dmarc_rua") > 0).alias("words"))


@query
def domain_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-C1, F-C9: weighted evidence, its parts, ownership tier and stage of each domain."""
    rows = fixture.facts(spark, sf_dir)
    methods = F.when(F.col("k") % 4 == 0, F.array(F.lit("dmarc_rua"), F.lit("official_url"))).when(F.col("k") % 4 == 1, F.array(F.lit("site_link"), F.lit("spf_include"))).when(F.col("k") % 4 == 2, F.array(F.lit("guess"))).otherwise(R.no_strings())
    failures = F.when(F.col("observed"), R.no_strings()).otherwise(F.array(F.lit("MX:SERVFAIL")))
    parts = C.domain_evidence(F.col("mx_present"), F.col("mx_hosts"), F.col("mx_null"), F.col("spf_present"), F.col("dmarc_present"), methods, failures)
    return rows.select("k", C.evidence_count(F.col("mx_present"), F.col("spf_present"), F.col("k") % 5 == 0).alias("count"), F.array_join(F.transform(parts, lambda e: F.concat_ws(":", e["type"], e["weight"].cast("string"), e["value"])), "|").alias("parts"), C.ownership_tier(methods).alias("ownership"), C.domain_stage(F.col("mx_present") & ~F.col("mx_null"), F.size("spf_includes") > 0, F.when(F.col("k") % 5 == 0, "detected")).alias("stage"))


# ---------------------------------------------------------------- statistics

EXTRA_METRICS = [
    "dmarc_adopted_entities", "subdomains_dmarc_enforced", "subdomains_inherited_policy", "entities_with_subdomain_mail", "dkim_detected_domains",
    "dkim_not_found_domains", "dkim_key_short_domains", "dkim_key_1024_domains", "dkim_key_2048_domains", "mta_sts_domains", "mta_sts_enforce_domains",
    "mta_sts_testing_domains", "mta_sts_unusable_domains", "mta_sts_mx_mismatch_domains", "tls_rpt_domains", "rua_external_domains",
    "rua_unauthorized_domains", "rua_unregistered_domains", "spf_lookup_exceeded_domains", "spf_target_broken_domains", "spf_dangling_domains",
    "txt_apex_oversize_domains", "dkim_ed25519_only_domains", "dkim_other_selector_domains", "spf_ip4_broad_domains", "spf_ptr_domains",
    "dmarc_ruf_domains", "spf_all_pass_domains", "spf_all_unknown_domains", "bimi_domains", "bimi_vmc_domains", "dnssec_domains", "maturity_0",
    "maturity_1", "maturity_2", "maturity_3", "maturity_4", "dmarc_np_domains", "bulk_spf_ok_domains", "bulk_dkim_domains", "bulk_dmarc_ok_domains",
    "bulk_ready_domains", "sending_enforced", "parked_defended", "parked_intentional", "dane_domains", "dane_dnssec_valid", "dane_orphan",
    "evidence_dkim_hint_entities", "mail_off_site_entities", "ownership_evidence_dist",
]


@query
def stats_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the metric table that rest on the other records and on walks."""
    facts = facts_ops.build_facts(fixture.bronze_full(spark, sf_dir))
    k = F.col("k")
    known = fixture.dns(spark, sf_dir).select("domain", "k", "population_id", "entity_id", "is_apex")
    rows = facts.join(known, "domain")
    rows = rows.withColumns(
        {
            "domain_id": F.concat(F.lit("d"), "k"),
            "park_class": C.park_class(*[F.col(c) for c in ("observed", "mx_null", "mx_present", "spf_present", "dmarc_present", "spf_all_qualifier", "effective_7489")]),
            "mta_sts_policy_status": F.when(F.col("mta_sts_present"), F.when(k % 4 < 3, "ok").otherwise("invalid")),
            "mta_sts_mode": F.when(k % 12 < 6, "enforce").otherwise("testing"),
            "mta_sts_mx_mismatch": k % 18 == 0,
            "mx_unreachable": k % 23 == 0,
            "spf_total_exceeds": k % 31 == 0,
            "spf_target_broken": k % 37 == 0,
            "spf_target_unregistered": k % 47 == 0,
            "spf_ip4_addresses": k * 100,
            "spf_has_ptr": k % 41 == 0,
            "rua_authorized": k % 3 < 2,
            "rua_domain_unregistered": k % 43 == 0,
            "ownership": F.when(k % 3 == 0, "company_stated").when(k % 3 == 1, "own_dns"),
            "is_official": k % 2 == 0,
        }
    )
    return stats.stats_overall(stats.derive_domain_row(rows), ["population_id"]).select("population_id", *EXTRA_METRICS)


@query
def fact_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of listed, active companies by population, and those of no known company."""
    k = F.col("c_custkey")
    companies = table(spark, sf_dir, "customer").select(F.concat(F.lit("e"), k % 701).alias("entity_id"), F.lit("XX").alias("country"), F.array(F.lit("all"), F.concat(F.lit("p"), k % 701 % 3)).alias("population_ids"), F.concat(F.lit("s"), k % 701 % 5).alias("common12_code"), F.lit("label").alias("common12_label"), F.element_at(F.array(*[F.lit(x) for x in ("active", "renamed", "delisted")]), (k % 701 % 3 + 1).cast("int")).alias("status"), F.lit(None).cast("string").alias("official_domain_id"), F.when(k % 701 % 7 > 0, F.concat(F.lit(""), k % 701)).alias("securities_code"), F.when(k % 701 % 11 == 0, "unlisted").alias("listing")).distinct()
    listed = population.entity_attrs(population.active(population.select_listed(companies)))
    known, orphans = stats.with_entities(fixture.dns(spark, sf_dir).select("domain", "entity_id"), listed)
    spread = stats.explode_population(known).groupBy("population_id").agg(F.count("*").alias("facts"))
    return spread.unionByName(orphans.agg(F.lit("(none)").alias("population_id"), F.count("*").alias("facts")))


@query
def subdomain_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subdomains of each population and how many their apex's record covers."""
    facts = fixture.facts(spark, sf_dir)
    return stats.subdomain_coverage(facts, facts, ["population_id"])


@query
def entity_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that ordered in one year only, of all pairs of neighbouring years."""
    orders = table(spark, sf_dir, "orders").select(F.concat_ws(":", F.year("o_orderdate"), "o_custkey").alias("key"), F.concat_ws(":", F.year("o_orderdate") + 1, "o_custkey").alias("next"))
    came, went = stats.churn(orders.select("key"), orders.select(F.col("next").alias("key")), "key")
    return came.select("key", F.lit("came").alias("what")).unionByName(went.select("key", F.lit("went").alias("what")))


@query
def measurement_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether tool versions and figures changed in the same month, and whether the sectors did."""
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    versions = lambda y: orders.groupBy(F.col("o_orderpriority").alias("phase")).agg(F.max(F.when(F.col("y") == y, F.col("o_orderkey"))).cast("string").alias("value")).select("phase", F.when(F.substring("phase", 1, 1) == "1", "config_hash").otherwise("tool").alias("key"), "value")
    figures = lambda y: orders.filter(F.col("y") == y).groupBy("o_orderstatus").agg(F.count("*").alias("orders"))
    moved = stats.measurement_moved(stats.version_changes(versions(1996), versions(1995)), stats.changes(figures(1996), figures(1995), ["o_orderstatus"], ["orders"]))
    codes = lambda y: orders.filter(F.col("y") == y).select(F.concat(F.month("o_orderdate"), F.lit("-"), F.dayofmonth("o_orderdate")).alias("code"))
    return moved.crossJoin(stats.sector_set_changed(codes(1996), codes(1995), "code"))  # a row each


@query
def measure_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each domain with its company, its facts in words, and its vendors by layer."""
    facts = fixture.stored_facts(spark, sf_dir)
    rows = rules_ops.infer(facts, rules_ops.load_rules(spark, fixture.RULES, "1"), ["domain_id"])
    domains = facts.select("domain_id", "domain", "entity_id")
    companies = facts.select("entity_id", F.concat(F.lit("Company "), "entity_id").alias("company")).distinct()
    out = views.drilldown(domains, facts.select("domain_id", "spf_present", "dmarc_present"), companies, rows, ["platform", "inbound_gateway", "outbound_gateway"])
    return out.select("domain", "company", "spf_present_label", "dmarc_present_label", "platform", "inbound_gateway", "outbound_gateway")


@query
def domain_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that is known of one domain, and the published cell it fell in."""
    facts = fixture.stored_facts(spark, sf_dir)
    rows = rules_ops.infer(facts, rules_ops.load_rules(spark, fixture.RULES, "1"), ["domain_id"])
    cells = facts.groupBy("population_id", "sector_code").agg(F.count("*").alias("domains"))
    out = views.trace(fixture.bronze(spark, sf_dir), facts, rows, cells, "c2.jp.example")
    return out.select("domain", "population_id", "domains", joined(F.transform("answers", lambda a: F.concat_ws("=", a["purpose"], a["rcode"]))).alias("answers"), joined(F.transform("inferences", lambda i: F.concat_ws("=", i["category"], i["vendor"]))).alias("vendors"))


@query
def source_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The credits that the segments shown ask for, in order of first mention."""
    shown = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("population_id"))
    sources = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("population_id")).agg(F.array(F.lit("registry"), F.concat(F.lit("list of "), F.max("c_mktsegment")), F.lit("exchange")).alias("credits"))
    return views.credits(shown, sources)


@query
def public_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the derived facts that may not be published."""
    facts = fixture.facts(spark, sf_dir)
    named = facts.select(F.explode(F.array(*[F.lit(c) for c in facts.columns])).alias("column")).groupBy("column").agg(F.count("*").alias("rows"))
    return named.filter(F.col("column").isin(views.IDENTIFYING))


# ---------------------------------------------------------------- populations


@query
def non_operating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as filers with industry codes and forms; why some are no operating companies."""
    k = F.col("c_custkey")
    pick = lambda n, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (k % n + 1).cast("int"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", pick(6, "6770", "6221", "6199", "6189", "6792", "7372").alias("sic"), F.array(pick(5, "10-K", "N-CSR", "N-2", "8-K", "485BPOS"), pick(2, "S-1", "10-Q")).alias("forms"), pick(7, "Gold Trust", "Acme Acquisition Corp", "Blue Fund", "Acme Acquisition II Ltd", "Royalty Trust", "Steel Inc", "Index ETF").alias("name"))
    kept, out = population.split_non_operating(rows)
    return out.groupBy("reason").agg(F.count("*").alias("filers")).unionByName(kept.agg(F.lit("(operating)").alias("reason"), F.count("*").alias("filers")))


@query
def segment_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against a table of segments, matched or not, with the label that each gets."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 9 > 0, F.col("c_mktsegment")).alias("segment"))
    mapping = spark.createDataFrame([("BUILDING", "b"), ("MACHINERY", "m"), ("MACHINERY", "n")], "segment string, code string")
    coded = population.lookup(rows, mapping, "segment", ["code"]).groupBy("code").agg(F.count("*").alias("customers"))
    return coded.crossJoin(population.lookup_counts(rows, mapping, "segment"))  # one row of counts


@query
def top_unmapped_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent words at the beginning of documents that a table of words lacks."""
    docs = table(spark, sf_dir, "documents").select(F.lower(F.regexp_extract("text", r"^([A-Za-z]+)", 1)).alias("label"))
    known = spark.createDataFrame([("the",), ("of",), ("le",), ("der",)], "label string")
    return population.top_unmapped(docs, known, "label", 15)


@query
def ordered_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers' sites from three sources in order, each filling what is still empty, with its name."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("own"), "c_custkey")).alias("site"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("c_nationkey"), F.concat(F.lit("s"), F.lpad("s_suppkey", 9, "0")).alias("site"), "s_suppkey")
    nation = population.from_table(suppliers, "c_nationkey", "c_custkey", "site")
    by_nation = lambda todo: nation(todo.filter("c_custkey % 3 = 0"))
    by_key = population.from_table(suppliers.filter("s_suppkey % 2 = 0").withColumn("c_custkey", F.col("s_suppkey")), "c_custkey", "c_custkey", "site")
    guess = lambda todo: todo.filter("c_custkey % 7 < 3").select("c_custkey", F.concat(F.lit("g"), "c_custkey").alias("site"))
    return population.enrich(rows, "c_custkey", "site", [("nation", by_nation), ("key", by_key), ("guess", guess)]).drop("c_nationkey")


@query
def enrichment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values each source gave, and how many are missing."""
    return population.provenance(ordered_enrichment(spark, sf_dir), "site")


@query
def coalesced_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation and balance of customers' namesakes from two tables in order of priority."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.col("c_nationkey")).alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("nation"))
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.year("o_orderdate")).alias("nation"))
    return population.coalesce_sources(rows, [("supplier", suppliers), ("orders", orders)], "c_custkey", ["nation"])


@query
def preferred_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The only site that a company's orders state replaces the known one, if nobody else states it."""
    companies = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id"), F.concat(F.lit("d"), F.col("c_custkey") % 50).alias("official_domain"), F.lit(None).cast("array<string>").alias("alt_domains"))
    stated = table(spark, sf_dir, "orders").filter("o_orderkey % 16 = 1").select(F.col("o_custkey").alias("entity_id"), F.concat(F.lit("d"), F.floor(F.col("o_orderkey") / 40)).alias("domain"))
    out = population.prefer_filing(companies, stated)
    return out.withColumn("alt_domains", joined("alt_domains"))


@query
def stated_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty domains from texts; one that several companies state stays only where the name fits."""
    companies = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id"), F.concat(F.lit("acme"), F.col("c_custkey") % 30).alias("name"), F.when(F.col("c_custkey") % 6 == 0, "own.example").alias("official_domain"))
    stated = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity_id"), F.concat(F.lit("acme"), F.col("o_orderkey") % 30, F.lit(".example")).alias("domain"))
    lone = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.concat(F.lit("s"), F.col("s_suppkey"), F.lit(".example")).alias("domain"))
    return population.fill_from_stated(companies, stated.unionByName(lone), F.concat("name", F.lit(".example")) == F.col("_stated")).drop("name")


@query
def derived_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers on a list by their own code or their nation's."""
    companies = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("c"), "c_custkey").alias("code"), F.concat(F.lit("n"), "c_nationkey").alias("parent"), F.array(F.lit("base")).alias("population_ids"))
    members = table(spark, sf_dir, "supplier").select(F.concat(F.lit("c"), "s_suppkey").alias("code")).unionByName(spark.createDataFrame([("n3",), ("n7",)], "code string"))
    out = population.add_derived(companies, members, "listed", ["code", "parent"])
    return out.select("c_custkey", joined("population_ids").alias("populations"))


@query
def registry_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers found in a registry by exact name, the area deciding between several."""
    asked = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("n"), F.col("s_suppkey") % 40).alias("name_normalized"), F.concat(F.lit("a"), F.col("s_suppkey") % 3).alias("prefecture"))
    registry = table(spark, sf_dir, "customer").filter("c_custkey < 60").select(F.concat(F.lit("n"), F.col("c_custkey") % 37).alias("name_normalized"), F.concat(F.lit("a"), F.col("c_custkey") % 4).alias("prefecture"), F.concat(F.lit("num"), F.col("c_custkey")).alias("number"), F.when(F.col("c_custkey") % 5 > 0, F.concat(F.lit("u"), F.col("c_custkey"))).alias("url"))
    return population.lookup_name(asked, registry).select("s_suppkey", "outcome", "number", "url")


@query
def article_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites from articles that list the company's code, unless another company takes the site."""
    articles = table(spark, sf_dir, "part").select(F.concat(F.lit("t"), F.col("p_partkey") % 500).alias("title"), F.array(F.concat(F.lit("c"), F.col("p_partkey") % 120), F.concat(F.lit("c"), F.col("p_partkey") % 77)).alias("codes"), F.concat(F.lit("d"), F.col("p_partkey") % 400).alias("domain"))
    companies = table(spark, sf_dir, "supplier").select(F.concat(F.lit("e"), "s_suppkey").alias("entity_id"), F.concat(F.lit("c"), F.col("s_suppkey") % 120).alias("code"), F.array(F.concat(F.lit("t"), F.col("s_suppkey") % 500), F.concat(F.lit("t"), F.col("s_suppkey") * 3 % 500)).alias("titles"))
    return population.article_sites(articles, companies)


@query
def confirmed_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first guessed host of each supplier whose page names it."""
    k = F.col("s_suppkey")
    guesses = table(spark, sf_dir, "supplier").select(k.alias("entity_id"), F.concat(F.lit("name"), k % 5).alias("core"), F.array(*[F.concat(F.lit("d"), (k * m) % 90) for m in (1, 3, 7)]).alias("guesses"))
    pages = table(spark, sf_dir, "part").filter("p_partkey < 90 and p_partkey % 2 = 0").select(F.concat(F.lit("d"), "p_partkey").alias("domain"), F.concat(F.lit("about name"), F.col("p_partkey") % 5).alias("html"))
    return population.confirm_guesses(guesses, pages, F.contains("html", F.col("core")))


@query
def promoted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-C10: ids by the strongest identifier, and the old ids of those that got a stronger one."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 5 == 0, F.concat(F.lit(" l"), k)).alias("lei"), F.when(k % 3 == 0, F.lpad(k, 13, "0")).alias("num"), F.when(k % 2 == 0, F.lpad(k, 10, "0")).alias("cik"), F.when(k % 7 == 0, F.concat(F.lit("E"), k)).alias("filer"), F.when(k % 11 == 0, F.concat(F.lit("Q"), k)).alias("qid"))
    none = F.lit(None).cast("string")
    rows = rows.withColumn("entity_id", C.entity_id(none, F.col("num"), F.col("cik"), F.col("filer"), F.col("qid")))
    return population.promote_id(rows).select("c_custkey", "entity_id", "is_duplicate_of")


@query
def all_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The population that all customers of a nation belong to."""
    rows = table(spark, sf_dir, "customer").select("c_nationkey", F.array(F.concat(F.lit("n"), "c_nationkey"), F.lit("all"), "c_mktsegment").alias("population_ids"))
    named = rows.agg(F.count("*").alias("customers")).withColumn("population", F.lit(candidates.common_population(rows)))
    one = rows.filter("c_nationkey = 3")
    return named.unionByName(one.agg(F.count("*").alias("customers")).withColumn("population", F.lit(candidates.common_population(one.select(F.array_remove("population_ids", "all").alias("population_ids"))))))


# ---------------------------------------------------------------- candidates and plans


@query
def candidate_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by method, distinct domains, companies without any."""
    rows = fixture.dns(spark, sf_dir).filter("k % 5 > 0").select("entity_id", "domain", F.element_at(F.array(*[F.lit(x) for x in ("official_url", "ct_log", "dmarc_rua")]), (F.col("k") % 3 + 1).cast("int")).alias("method"))
    return candidates.candidate_stats(rows, fixture.dns(spark, sf_dir).select("entity_id").distinct())


@query
def domain_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains by confidence, role and tier; companies without a confirmed one."""
    rows = fixture.facts(spark, sf_dir)
    conf = C.domain_confidence(F.col("mx_present"), F.col("spf_present"), F.lit(False), F.col("dmarc_present"), F.when(F.col("k") % 3 == 0, 1).otherwise(0), F.col("spf_all_qualifier") == "-")
    rows = rows.withColumn("confidence", conf).withColumn("tier", C.measure_tier(F.col("confidence"))).withColumn("role", C.domain_role(F.col("domain"), F.concat(F.lit("c"), F.col("k"), F.lit(".jp.example")), F.col("confidence")))
    none = candidates.without_confirmed(rows, rows.select("entity_id").distinct())
    return candidates.domain_stats(rows).unionByName(none.agg(F.lit(None).cast("boolean").alias("is_apex"), F.lit("(companies without)").alias("confidence"), F.lit("").alias("role"), F.lit("").alias("tier"), F.count("*").alias("domains")))


@query
def tier_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries of a plan that their tier allows, by purpose."""
    facts = fixture.facts(spark, sf_dir)
    domains = facts.select("domain", F.when(F.col("k") % 2 == 0, "A").otherwise("C").alias("tier"), F.array_distinct("mx_hosts").alias("mx_hosts"))
    plan = candidates.expand_plan(domains, facts.select("domain", F.array(F.lit("s1")).alias("selectors"))).join(domains.select("domain", "tier"), "domain")
    config = spark.createDataFrame([("A", p) for p in ("mx", "spf", "dmarc", "dkim")] + [("C", "mx"), ("C", "dkim_wildcard")], "tier string, purpose string")
    return candidates.allowed(plan, config).groupBy("tier", "purpose").agg(F.count("*").alias("queries"))


@query
def mail_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail-like names below the apex of each customer, the first two of them."""
    k = F.col("c_custkey")
    labels = ["mail", "mx2", "smtp-out", "mailer", "a.mail", "imap.eu", "www", "mail.a.b", "MX"]
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("e"), k % 50).alias("entity_id"), F.concat(F.lit("c"), k % 50, F.lit(".example")).alias("apex"), F.element_at(F.array(*[F.lit(x) for x in labels]), (k % len(labels) + 1).cast("int")).alias("label"))
    return candidates.mail_names(rows.select("entity_id", "apex", F.concat_ws(".", "label", "apex").alias("name")), 2)


@query
def placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page hosts, as they are and with other ends, that stand for examples only."""
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    rows = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, host).when(F.col("page_id") % 3 == 1, F.concat(host, F.lit(".shop."))).otherwise(F.concat(host, F.lit(".Test"))).alias("host"))
    return rows.select("page_id", "host", stats.is_placeholder(F.col("host")).alias("placeholder"))


@query
def certificate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J36, F-T13: part brands whose organisation is a supplier's name up to its legal form."""
    pairs = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    name = lambda k, ends: F.concat(F.lit("Acme Steel "), k, F.element_at(F.array(*[F.lit(e) for e in ends]), (k % len(ends) + 1).cast("int")))
    rows = pairs.select("l_suppkey", "l_partkey", name(F.col("l_partkey") % 20, ["", " Inc", ", LTD."]).alias("organisation"), name(F.col("l_suppkey") % 20, [" Corporation", " Co., Ltd.", " Group"]).alias("name"))
    return rows.filter(T.organisation_matches(F.col("organisation"), F.col("name"))).select("l_suppkey", "l_partkey")


# ---------------------------------------------------------------- names and texts


@query
def wide_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-N2, F-N3, F-N4: codes and addresses written in full-width letters, in comparable form."""
    k = F.col("c_custkey")
    wide = lambda c: F.when(k % 2 == 0, F.translate(c, N.NARROW, N.WIDE)).otherwise(c)
    rows = table(spark, sf_dir, "customer").select("c_custkey", wide(F.concat(F.lpad(k, 4, "0"), F.when(k % 3 == 0, "0").otherwise(""))).alias("code"), wide(F.concat(F.lit("T-"), F.lpad(k, 13, "7"))).alias("number"), wide(k.cast("string")).alias("cik"), wide(F.concat(F.lit(" "), F.when(k % 3 > 0, "https://").otherwise(""), F.lit("WWW.C"), k, F.lit(".Example./x"))).alias("url"))
    return rows.select("c_custkey", N.securities_code(F.col("code")).alias("code"), N.digits(F.col("number"), 13).alias("number"), N.cik_key(F.col("cik")).alias("cik"), N.url_host(F.col("url")).alias("host"))


@query
def plain_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-N7, F-N9, F-N10, F-N5: organisations folded, sites to compare, segments by alias, domains of URLs."""
    rows = table(spark, sf_dir, "customer")
    rules = spark.createDataFrame([("example",)], "rule string")
    site = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("https://www.C"), "c_custkey", F.lit(".example/x"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit(" no site "), "c_custkey")).otherwise(F.concat(F.lit("c"), "c_custkey", F.lit(".example")))
    out = rows.select("c_custkey", N.fold_organisation(F.concat(F.lit(" A  B\t"), "c_name")).alias("organisation"), N.conflict_key(site).alias("site_key"), N.segment(F.concat(F.lit(" "), "c_mktsegment"), {"BUILDING": "standard", "MACHINERY": "prime"}).alias("segment"), N.url_host(site).alias("host"))
    return N.registrable(out, "host", rules).drop("host")


@query
def stated_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T4: domains that filings of the suppliers state as their own, in every way of putting it."""
    k = F.col("s_suppkey")
    ways = [
        "Visit our corporate website at <b>www.s{k}.com</b>, or the SEC website at www.sec.gov.",
        "We maintain an internet website at www.wire.com and www.s{k}.com.",
        "The Company's web site address is s{k}.com.",
        "Acme{k} Steel's website, www.s{k}.com, is new. Other Bank's website is www.other.com.",
        "It is found through its website at www.acme{k}.com and elsewhere.",
        "It is found through its website at www.elsewhere.com.",
        "The Acme{k} website is located at www.acme{k}.com. The Other website is www.other.com.",
        "Ask your website provider at www.nobody.com.",
    ]
    text = F.element_at(F.array(*[F.replace(F.lit(w), F.lit("{k}"), k.cast("string")) for w in ways]), (k % len(ways) + 1).cast("int"))
    docs = table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("html"), F.concat(F.lit("Acme"), k, F.lit(" Steel Inc")).alias("name"))
    rules = spark.createDataFrame([("com",), ("gov",)], "rule string")
    third = spark.createDataFrame([("wire.com",)], "domain string")
    return T.stated_domains(docs, rules, third, "s_suppkey", "html", "name").select("s_suppkey", "registrable", "times")


@query
def entry_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T10: where entry pages lead on their own domain."""
    ways = ['<META HTTP-EQUIV="Refresh" CONTENT="0; URL=/jp/{k}.html">', "<meta content='3;url=http://www.d.example/{k}' http-equiv=refresh>", '<frameset><frame name=a src="main{k}.html"></frameset>', '<script>window.location.href = "/js/{k}";</script>', "<script>location.replace('//d.example/r{k}')</script>", '<script>location = "https://other.example/{k}"</script>', '<meta http-equiv="refresh" content="0;url=https://d.example/">', "<meta name=refresh content='url=/no'>"]
    k = F.col("s_suppkey")
    html = F.element_at(F.array(*[F.replace(F.lit(w), F.lit("{k}"), k.cast("string")) for w in ways]), (k % len(ways) + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.redirect_target(html, F.lit("d.example")).alias("target"))


@query
def sibling_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T11: the same names under other ends, without "the" and holding ends."""
    k = F.col("s_suppkey")
    forms = ["acme{k}-holdings.co.jp", "theacme{k}.com", "acme{k}group-hd.jp", "global.acme{k}", "ab{k}.com"]
    domain = F.element_at(F.array(*[F.replace(F.lit(w), F.lit("{k}"), k.cast("string")) for w in forms]), (k % len(forms) + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", joined(T.sibling_domains(domain, ["co.jp", "com"])).alias("siblings"))


@query
def accepted_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T7: which notice site each company gets: no vendors, nobody else's, confirmed ones first."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("e"), k).alias("entity_id"), F.array(F.concat(F.lit("d"), k % 60), F.concat(F.lit("n"), k), F.lit("vendor.example")).alias("domains"))
    vendors = spark.createDataFrame([("vendor.example",)], "domain string")
    taken = table(spark, sf_dir, "supplier").filter("s_suppkey % 4 = 0").select(F.concat(F.lit("e"), k).alias("entity_id"), F.concat(F.lit("d"), k % 60).alias("domain"))
    confirmed = table(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 0").select(F.concat(F.lit("e"), k).alias("entity_id"), F.concat(F.lit("n"), k).alias("domain"))
    return T.accept_notices(rows, vendors, taken, confirmed)


@query
def notice_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T6, F-T8: notice hosts, newspapers, prefectures and subsidiaries in made-up reports of the suppliers."""
    k = F.col("s_suppkey").cast("string")
    place = F.element_at(F.array(*[F.lit(x) for x in ("東京都千代田区", "大阪市北区", "京都 中京区", "海外")]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    text = F.concat(F.lit("公告掲載方法 電子公告 https://www.s"), k, F.lit(".co.jp/koukoku "), F.when(F.col("s_suppkey") % 3 == 0, "日本経済新聞").otherwise(""), F.lit(" 【関係会社の状況】 (連結子会社) 株式会社子"), k, F.lit(" 東京都 自社株式会社 (関連会社) 株式会社外 【従業員の状況】 株式会社他"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", joined(T.notice_hosts(text)).alias("hosts"), T.newspaper_notice(text).alias("newspaper"), T.prefecture(place).alias("prefecture"), joined(T.subsidiary_names(text, F.lit("自社株式会社"))).alias("subsidiaries"))


@query
def wiki_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T9, F-T12: codes, infobox fields and links of made-up articles on the suppliers, and kana as letters."""
    k = F.lpad(F.col("s_suppkey") % 9000 + 1000, 4, "0")
    wiki = F.concat(F.lit("{{基礎情報 会社\n|市場情報={{上場情報|東証|"), k, F.lit("}}\n|外部リンク=[https://s"), k, F.lit(".example/ x]\n}}\n== 構成 ==\n{|\n| "), k, F.lit(" || a\n| 285A || b\n|}\n== 次 ==\n| 9999 || no"))
    box = T.infobox(F.col("w"), "基礎情報 会社")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", k.alias("code"), wiki.alias("w")).withColumn("b", box)
    market = T.infobox_field(F.col("b"), "市場情報")
    return rows.select("s_suppkey", joined(T.constituent_codes(F.col("w"), "構成")).alias("codes"), T.code_listed(market, F.col("code")).alias("listed"), T.external_link(T.infobox_field(F.col("b"), "外部リンク")).alias("link"), T.kana_latin(F.when(F.col("s_suppkey") % 2 == 0, "トヨタ").otherwise("ニッポン")).alias("kana"), joined(T.title_forms(F.concat(F.lit("株式会社"), k))).alias("titles"))


@query
def release_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T5: domains behind "About ..." and in mail addresses of made-up releases."""
    k = F.col("s_suppkey").cast("string")
    html = F.concat(F.lit("<p>About Acme Steel</p> Acme makes steel. www.s"), k, F.lit(".com <a>press@news"), k, F.lit(".com</a> press@wire.com"))
    docs = table(spark, sf_dir, "supplier").select("s_suppkey", html.alias("html"))
    rules = spark.createDataFrame([("com",)], "rule string")
    return T.release_domains(docs, rules, spark.createDataFrame([("wire.com",)], "domain string"), "s_suppkey", "html")


@query
def page_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T2, F-T13: whether made-up pages of the suppliers name their company, in the title or anywhere, and a parent."""
    k = F.col("s_suppkey")
    core = F.when(k % 2 == 0, F.concat(F.lit("山"), k % 10)).otherwise(F.concat(F.lit("長い社名"), k))
    titles = [F.concat(F.lit("株式会社"), core), F.concat(core, F.lit("のページ")), F.lit("Home")]
    title = F.element_at(F.array(*titles), (k % 3 + 1).cast("int"))
    english = F.concat(F.lit("Acme Steel Works "), k, F.lit(" Co., Ltd."))
    html = F.concat(F.lit("<html><title>"), title, F.lit("</title><body>"), F.when(k % 4 < 2, core).otherwise(""), F.lit(" 親会社"), F.lit("</body></html>"))
    page = F.concat(F.lit("<title>"), F.when(k % 2 == 0, F.upper(english)).otherwise("Other"), F.lit("</title>"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", core.alias("core"), english.alias("name"), html.alias("html"), page.alias("page"))
    found = T.page_names(F.col("html"), F.col("core"), ["株式会社{c}", "{c}株式会社"])
    return rows.select("s_suppkey", found.alias("named"), T.title_names_english(F.col("page"), F.col("name")).alias("english"), T.parent_mentioned(F.col("html"), F.lit("親会社"), F.when(k % 5 == 0, F.lit("親会社")).otherwise(F.col("core"))).alias("parent"))


@query
def decoded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T14: page bytes decoded by header, by the page's own word, or as UTF-8."""
    header = F.when(F.col("page_id") % 2 == 0, "utf-8")
    pages = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("body"), header.alias("header"))
    return pages.select("page_id", F.md5(T.decode_page(F.col("body"), F.col("header")).cast("binary")).alias("digest"))


# ---------------------------------------------------------------- sources, sinks and streams


@query
def bronze_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the fixture appended as raw parts in two goes and read again, by purpose and state."""
    rows = fixture.dns(spark, sf_dir)
    asked = rows.select("domain", F.col("domain").alias("query_name"), F.lit("TXT").alias("query_type"), F.lit("spf").alias("purpose"), F.concat(F.lit("m"), F.col("k") % 2).alias("method"), F.when(F.col("observed"), F.when(F.col("spf").isNotNull(), "NOERROR").otherwise("NODATA")).otherwise("SERVFAIL").alias("rcode"), F.when(F.col("spf").isNotNull(), F.array(F.array(F.substring("spf", 1, 9), F.expr("substring(spf, 10)")))).alias("values"), F.lit(60).alias("ttl"))
    root = folder(spark)
    bronze_io.append_bronze(bronze_io.to_raw(asked.filter("rcode = 'NOERROR'"), "r1", "t", "1"), root)
    bronze_io.append_bronze(bronze_io.to_raw(asked.filter("rcode <> 'NOERROR'"), "r2", "t", "1"), root)
    good, _ = bronze_io.read_bronze(spark, root)
    text = F.max(F.get(F.transform("answers", lambda a: R.join_chunks(a["data"])), 0))
    return good.groupBy("method", "rcode", "observed", "record_present").agg(F.count("*").alias("rows"), text.alias("last_text"))


@query
def typed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as a typed, sorted table and as JSON Lines, and read again; a column that came
    later is NULL."""
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_orderstatus", StringType()), StructField("later", StringType())])
    root = folder(spark)
    tables.write_table(table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey"), f"{root}/t", schema, ["o_orderstatus", "o_orderkey"])
    tables.write_jsonl(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), f"{root}/j")
    typed = tables.read_table(spark, f"{root}/t", schema)
    lines = spark.read.schema("o_orderkey long, o_orderstatus string").json(f"{root}/j")
    same = typed.select("o_orderkey", "o_orderstatus").exceptAll(lines).count()
    return typed.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"), F.count("later").alias("later")).withColumn("different", F.lit(same))


@query
def gold_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of order figures, one with a population replaced and a new column, stacked and exported."""
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    month = lambda y: orders.filter(F.col("y") == y).groupBy(F.col("o_orderpriority").alias("population_id")).agg(F.count("*").alias("n"))
    root = folder(spark)
    month(1995).write.parquet(f"{root}/gold/month=1995/stats")
    again = month(1997).filter("population_id = '1-URGENT'").withColumn("fresh", F.lit(True))
    tables.upsert_population(month(1996), again).write.parquet(f"{root}/gold/month=1996/stats")
    stacked = tables.read_gold(spark, f"{root}/gold", "stats")
    stacked = stacked.withColumn("month", F.regexp_extract(F.input_file_name(), r"month=(\d+)", 1).cast("int"))
    tables.export_public(stacked.select("population_id", "n", "fresh", F.col("month").alias("measured_month")), f"{root}/public", ["population_id", "measured_month"])
    return spark.read.option("header", True).csv(f"{root}/public/csv").select("population_id", F.col("n").cast("long").alias("n"), F.col("fresh").cast("boolean").alias("fresh"), F.col("measured_month").cast("int").alias("measured_month"))


@query
def refreshed_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which extracts are read again, since their document or the reader changed."""
    k = F.col("o_orderkey")
    old = table(spark, sf_dir, "orders").filter("o_orderkey % 5 > 0").select(k.alias("key"), F.concat(F.lit("d"), k % 1000).alias("doc"), F.concat(F.lit(""), k % 3).alias("v"))
    documents = table(spark, sf_dir, "orders").select(k.alias("key"), F.concat(F.lit("d"), F.when(k % 7 == 0, 0).otherwise(k % 1000)).alias("doc"))
    kept, again = tables.refresh_extract(old, documents, "key", "doc", "v", "2")
    return kept.agg(F.lit("kept").alias("what"), F.count("*").alias("rows"), F.sum("key").alias("keys")).unionByName(again.agg(F.lit("again").alias("what"), F.count("*").alias("rows"), F.sum("key").alias("keys")))


@query
def listing_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code lists, mappings and registries written from the given tables and read again."""
    root = folder(spark)
    k = F.col("c_custkey")
    lines = table(spark, sf_dir, "customer").select(F.when(k % 50 == 0, F.concat(F.lit("broken,"), k)).otherwise(F.concat_ws(",", k, F.concat(F.lit('"N, '), k, F.lit('"')), "c_mktsegment")).alias("value"))
    lines.write.text(f"{root}/list")
    rows, rejected = listings.read_code_list(spark, f"{root}/list", ["code", "name", "segment"], "UTF-8", skip=0)
    coded = rows.groupBy("segment").agg(F.count("*").alias("rows"), F.min("name").alias("first_name"))
    bad = rejected.agg(F.lit("(rejected)").alias("segment"), F.count("*").alias("rows"), F.min("line").alias("first_name"))
    entries = table(spark, sf_dir, "customer").select(F.when(k % 9 == 0, "host").otherwise("domain").alias("kind"), F.concat(F.lit("c"), k, F.lit(".example")).alias("value"), F.lit("asked").alias("reason"), F.when(k % 4 > 0, "2026-01-01").otherwise("soon").alias("decided_on"))
    entries.write.option("header", True).csv(f"{root}/registry")
    good, problems = listings.read_registry(spark, f"{root}/registry", "exclusions")
    registry = good.agg(F.lit("(registry)").alias("segment"), F.count("*").alias("rows"), F.min("value").alias("first_name"))
    found = problems.groupBy(F.concat(F.lit("("), F.regexp_extract("problem", r"^(\w+ is (?:unknown|no date))", 1), F.lit(")")).alias("segment")).agg(F.count("*").alias("rows"), F.min("value").alias("first_name"))
    table(spark, sf_dir, "nation").select(F.concat(F.lit(" "), "n_name").alias("label"), F.col("n_regionkey").alias("code"), F.lit("1").alias("version")).write.option("header", True).csv(f"{root}/mapping")
    mapping = listings.read_mapping(spark, f"{root}/mapping", "label", ["code"], "version").agg(F.lit("(mapping)").alias("segment"), F.count("*").alias("rows"), F.min("label").alias("first_name"))
    table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("Acme "), F.col("s_suppkey") % 7, F.lit(" Inc"))).write.csv(f"{root}/numbers")
    numbers = listings.read_registry_csv(spark, f"{root}/numbers", ["number", "name"])
    ours = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("number"), F.concat(F.lit("acme"), F.col("s_suppkey") % 5).alias("ours"))
    wrong = listings.name_mismatches(ours, numbers, "number", "ours", "name").agg(F.lit("(names differ)").alias("segment"), F.count("*").alias("rows"), F.min("our_name").alias("first_name"))
    return coded.unionByName(bad).unionByName(registry).unionByName(found).unionByName(mapping).unionByName(wrong)


@query
def matrix_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON matrix of the suppliers, first row of each key, by exchange; bindings folded."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.array((k % 40).cast("string"), F.concat(F.lit("N"), F.lpad(k, 6, "0")), F.element_at(F.array(F.lit("NYSE"), F.lit("OTC"), F.lit("Nasdaq")), (k % 3 + 1).cast("int"))).alias("v"))
    doc = rows.agg(F.to_json(F.struct(F.array(F.lit("cik"), F.lit("name"), F.lit("exchange")).alias("fields"), F.array_sort(F.collect_list("v")).alias("data"))).alias("value"))  # a listing is one document
    root = folder(spark)
    doc.coalesce(1).write.text(root)
    listed = listings.read_matrix_json(spark, root, ["cik", "name", "exchange"], "cik", "exchange", ["NYSE", "Nasdaq"])
    counts = listings.exchange_counts(listed, "exchange").select("exchange", "rows", F.lit("").alias("conflicts"))
    bound = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 25).alias("company"), F.when(F.col("l_partkey") % 3 > 0, F.col("l_partkey") % 2).alias("site"), F.lit("one").alias("lei"), (F.col("l_orderkey").cast("long") * 10_000_000_000 + F.col("l_linenumber").cast("long") * 1_000_000_000 + F.col("l_partkey")).alias("at"))
    folded = listings.fold_bindings(bound, "company", ["site", "lei"], "at")
    return counts.unionByName(folded.select(F.concat(F.lit("company "), "company").alias("exchange"), F.col("site").cast("long").alias("rows"), joined("conflicts").alias("conflicts")))


def _raw_parts(spark: SparkSession, sf_dir: str) -> str:
    """Events as raw answers in JSON parts: the user is the domain, the type the purpose."""
    events = table(spark, sf_dir, "events")
    rows = events.select(F.concat(F.lit("u"), F.col("user_id") % 500).alias("domain"), F.lit("q").alias("query_name"), F.lit("TXT").alias("query_type"), F.col("event_type").alias("purpose"), F.lit("m").alias("method"), F.when(F.col("value") > 10, "NOERROR").otherwise("SERVFAIL").alias("rcode"), F.lit(None).cast("array<array<string>>").alias("values"), F.lit(60).alias("ttl"), "ts")
    root = folder(spark)
    bronze_io.append_bronze(bronze_io.to_raw(rows, "r", "t", "1"), root)
    return root


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw parts taken in by a stream in two goes, each part once."""
    root, out = _raw_parts(spark, sf_dir), folder(spark)
    for _ in range(2):
        stream.ingest(stream.stream_bronze(spark, root), f"{out}/table", f"{out}/state").awaitTermination()
    return spark.read.parquet(f"{out}/table").groupBy("purpose", "rcode").agg(F.count("*").alias("rows"))


def _streamed(df: DataFrame, out: str, mode: str = "append") -> DataFrame:
    """The rows of a stream over all that is there, from the files it wrote."""
    df.writeStream.format("parquet").option("path", f"{out}/table").option("checkpointLocation", f"{out}/state").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{out}/table")


@query
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer of each user and type, however often the run was repeated."""
    rows = stream.dedupe_stream(stream.stream_bronze(spark, _raw_parts(spark, sf_dir)), ["domain", "purpose"], delay="1000 days")
    return _streamed(rows, folder(spark)).groupBy("purpose").agg(F.count("*").alias("rows"), F.count_distinct("domain").alias("domains"))


@query
def stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers and unobserved ones by hour and type; hours that the watermark has not passed are left out."""
    source = stream.stream_bronze(spark, _raw_parts(spark, sf_dir))
    rows = stream.health_stream(source, delay="0 hours", keys=("purpose",))
    return _streamed(rows, folder(spark)).withColumn("hour", F.col("hour").cast("string"))


@query
def stream_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaks of months without corroboration, as keyed state over monthly rows of the orders."""
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    rows = table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("c"), F.col("o_custkey") % 50).alias("domain"), month.cast("int").alias("month")).agg((F.max("o_orderkey") % 3 == 0).alias("corroborated"))
    root = folder(spark)
    rows.write.parquet(root)
    source = spark.readStream.schema("domain string, month int, corroborated boolean").parquet(root)
    return _streamed(stream.stale_streak_stream(source, ["domain"]), folder(spark))
