"""Registered queries of the general operators, on the given tables by their column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailposture.functions import classify as C
from mailposture.functions import names as N
from mailposture.functions import text as T
from mailposture.operators import candidates, compare, population, views
from mailposture.operators import facts as facts_ops
from mailposture.operators import rules as rules_ops
from mailposture.plans import fixture
from mailposture.plans.queries import query, table

# ---------------------------------------------------------------- measurement quality


@query
def saturation_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that each further event type finds."""
    return compare.saturation(table(spark, sf_dir, "events"), "event_type", "user_id")


@query
def saturation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that each further clerk-like bucket of order days finds, with shares covered."""
    orders = table(spark, sf_dir, "orders").withColumn("day", F.concat(F.lit("d"), F.dayofmonth("o_orderdate")))
    return compare.saturation(orders, "day", "o_custkey")


@query
def method_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User against assistant messages by conversation and pair of turns: presence, length class, and all texts of a side."""
    rows = table(spark, sf_dir, "conversations").filter("role in ('user', 'assistant')")
    side = lambda role: rows.filter(F.col("role") == role).groupBy("conv_id", F.floor(F.col("turn") / 2).alias("pair")).agg(F.lit("chat").alias("purpose"), (F.max("turn") < 6).alias("observed"), (F.max(F.length("text")) > 60).alias("record_present"), F.array_sort(F.collect_set(F.sha2("text", 256))).alias("found"))
    return compare.compare_methods(side("user"), side("assistant"), ["conv_id", "pair"], "purpose")


@query
def method_compare_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J17 as counts by kind."""
    return method_compare(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("n"))


@query
def plan_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities of small and of large orders, in common and apart."""
    orders = table(spark, sf_dir, "orders").select(F.concat_ws("|", "o_orderpriority", "o_orderstatus").alias("purpose"), "o_totalprice")
    return compare.plan_diff(orders.filter("o_totalprice < 2000"), orders.filter("o_totalprice > 450000"))


@query
def percentile_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of order prices by priority."""
    orders = table(spark, sf_dir, "orders").withColumn("price", F.floor("o_totalprice"))
    out = compare.percentiles(orders, "price", ["o_orderpriority"])
    return out.withColumn("mean", F.round("mean", 3))


@query
def health_by_rcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type and hour, and those without a value above 10."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("purpose"), F.hour("ts").cast("string").alias("rcode"), (F.col("value") > 10).alias("observed"))
    return compare.measure_health(events)


@query
def domain_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose events were fully, partly and never above a value."""
    return compare.domain_health(table(spark, sf_dir, "events").select(F.col("user_id").alias("domain"), (F.col("value") > 10).alias("observed")))


@query
def method_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the derived bronze table by method."""
    rows = compare.method_stats(fixture.bronze(spark, sf_dir))
    return rows.select("method", "records", "observed", "record_present", F.array_join(F.transform(F.map_entries("by_rcode"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("by_rcode"))


@query
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a phase over the orders, failures by reason, warnings with their first keys."""
    orders = table(spark, sf_dir, "orders")
    outcome = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("skipped")
    rows = orders.select(F.col("o_orderkey").alias("key"), outcome.alias("outcome"), F.col("o_orderpriority").alias("reason"), F.when(F.col("o_totalprice") > 400000, "LARGE").alias("warning"))
    out = compare.run_metrics(rows, "orders")
    return out.withColumns({"failures": F.to_json("failures"), "warnings": F.to_json("warnings")})


@query
def acceptance_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of the orders against bounds."""
    checks = {"rows": (F.count("*"), 1.0, None), "failed_share": (F.avg((F.col("o_orderstatus") == "F").cast("int")), 0.3, 0.6), "cheap_share": (F.avg((F.col("o_totalprice") < 1000).cast("int")), 0.5, None)}
    return compare.acceptance(table(spark, sf_dir, "orders"), checks).withColumn("value", F.round("value", 6))


@query
def phase_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run table over order years as phases, and what each passed on."""
    orders = table(spark, sf_dir, "orders")
    metrics = orders.groupBy(F.year("o_orderdate").cast("string").alias("phase")).agg(F.lit("success").alias("status"), F.count("*").alias("input"), F.count_if(F.col("o_orderstatus") == "F").alias("success"))
    runs = compare.run_table(metrics, [str(y) for y in range(1992, 2003)])
    return compare.phase_flow(runs).select("phase", "input", "success", "previous_success", "gap")


@query
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: one customer in ten, the same on every run."""
    return compare.sample_targets(table(spark, sf_dir, "customer"), "c_custkey", 0.1, seed=7)


@query
def samples_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the first three orders of each priority."""
    return compare.samples(table(spark, sf_dir, "orders"), "o_orderpriority", 3, ["o_orderkey"]).select("o_orderpriority", "o_orderkey")


@query
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and type."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return compare.dedupe_last(events, ["user_id", "event_type"], "ts", "event_id")


@query
def first_row_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user, with the first large value that any of the user's events has."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("value") > 20, F.col("value")).alias("large"))
    return compare.dedupe_first(events, ["user_id"], ["event_id"], ["large"])


# ---------------------------------------------------------------- populations


@query
def longest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest of some prefixes that each part's name begins with."""
    prefixes = spark.createDataFrame([("P", "p"), ("Part", "part"), ("part#1", "one"), ("part#", "number"), ("part#12", "twelve"), ("B", "b")], "prefix string, common string")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("part#"), F.col("p_partkey").cast("string")).alias("code"))
    return population.longest_prefix(parts, prefixes, "code", "prefix", "common").select("p_partkey", "common")


@query
def entity_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders in two years as two populations; a quarter changes its name."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y"))
    name = lambda y: F.concat(F.lit("c"), (F.col("o_custkey") + F.when(F.col("o_custkey") % 4 == 0, y).otherwise(0)).cast("string"))
    year = lambda y: orders.filter(F.col("y") == y).select(F.col("o_custkey").alias("entity_id"), name(y).alias("name")).distinct()
    before = year(1996).withColumns({"status": F.lit("active"), "first_seen": F.lit("1995-01-01").cast("date"), "last_seen": F.lit("1996-01-01").cast("date")})
    return population.entity_diff(year(1997), before, F.lit("1997-01-01").cast("date"))


@query
def fill_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation's name for customers that have none, by key."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n"), F.when(F.col("c_custkey") % 3 == 0, "own").cast("string").alias("n_name"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"), "n_name")
    return population.fill_by_key(customers, nations, "n", ["n_name"])


@query
def weak_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers found by rounded balance, conflicts and disagreeing names refused."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.round("c_acctbal", -2).cast("long").alias("bal"), F.lit(None).cast("string").alias("site"), F.concat(F.lit("acme "), (F.col("c_custkey") % 2).cast("string")).alias("name"))
    suppliers = table(spark, sf_dir, "supplier").select(F.round("s_acctbal", -2).cast("long").alias("bal"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("site"), F.concat(F.lit("Acme "), (F.col("s_suppkey") % 2).cast("string"), F.lit(" Inc")).alias("title"))
    return population.fill_by_weak_key(customers, suppliers, "bal", "site", "name", "title").select("c_custkey", "site", "outcome")


@query
def as_of_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer's latest earlier order before each order."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("at"))
    history = table(spark, sf_dir, "orders").groupBy("o_custkey", F.col("o_orderdate").alias("t")).agg(F.max("o_orderkey").alias("prev"))
    return population.as_of(orders, history, "o_custkey", "at", "t", ["prev"]).select("o_orderkey", F.col("prev_before").alias("previous_order"))


@query
def merged_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as two populations, merged over chained keys and names."""
    customers = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("row_id"), F.lit(0).alias("rank"), F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("L"), (F.col("c_custkey") % 40).cast("string"))).alias("lei"), F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("K"), F.col("c_custkey").cast("string"))).alias("cik"), F.lit(None).cast("string").alias("corporate_number"), F.concat(F.lit("n"), (F.col("c_custkey") % 97).cast("string")).alias("name_normalized"), F.array(F.lit("A")).alias("population_ids"))
    suppliers = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("row_id"), F.lit(1).alias("rank"), F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("L"), (F.col("s_suppkey") % 40).cast("string"))).alias("lei"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("K"), F.col("s_suppkey").cast("string"))).alias("cik"), F.lit(None).cast("string").alias("corporate_number"), F.concat(F.lit("n"), (F.col("s_suppkey") % 97).cast("string")).alias("name_normalized"), F.array(F.lit("B")).alias("population_ids"))
    merged = population.merge_entities(customers, suppliers)
    return merged.select("row_id", "lei", "cik", "name_normalized", F.array_join("population_ids", ",").alias("populations"), "merged_rows")


@query
def group_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as group companies of their suppliers, with the reason for which each is dropped."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("name"), F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("parent"), F.concat(F.lit("d"), F.floor(F.col("l_partkey") / 100).cast("string")).alias("domain")).distinct()
    names = spark.createDataFrame([("7",), ("8",)], "name string")
    sites = spark.createDataFrame([("d3",)], "domain string")
    return population.build_group(lines, names, sites, most_parents=28, most_siblings=2)


@query
def latest_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest urgent or high order of each customer."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    rows = population.latest_filing(orders.withColumn("date", F.struct("o_orderdate", "o_orderkey")), "o_custkey", "o_orderpriority", "date", ["1-URGENT", "2-HIGH"])
    return rows.select("o_custkey", "o_orderkey")


@query
def folded_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-N1: customer names with legal forms around them, folded (the NFKC step runs in Arrow batches)."""
    raw = F.concat(F.lit("Ｔｈｅ "), F.col("c_name"), F.element_at(F.array(F.lit(" Co., Ltd."), F.lit(" Holdings Inc"), F.lit("（株式会社）"), F.lit("")), (F.col("c_custkey") % 4 + 1).cast("int")))
    return table(spark, sf_dir, "customer").select("c_custkey", N.fold_name(raw).alias("folded"))


@query
def hashed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-N11: domain ids of the derived domains."""
    return fixture.dns(spark, sf_dir).select("k", N.hash_id("d", F.col("entity_id"), F.col("domain")).alias("id"))


# ---------------------------------------------------------------- candidates, names, plans


@query
def shared_dns_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of documents that two or more sources have, all of them even-numbered."""
    docs = table(spark, sf_dir, "documents").select(F.concat(F.col("lang"), F.floor(F.col("n_chars") / 1000).cast("string")).alias("domain"), F.col("source").alias("entity_id"), F.when(F.col("doc_id") % 7 < 6, "spf_include").otherwise("official_url").alias("method"))
    return candidates.shared_dns_only(docs)


@query
def shared_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page hosts that are reached under several languages."""
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("domain"), F.regexp_extract("url", "://[^/]*/([a-z]+)/", 1).alias("entity_id"))
    return candidates.shared_domains(pages).select("domain", F.array_join("entities", ",").alias("entities"))


@query
def cap_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two largest line items of each order and how many were left out."""
    kept, over = candidates.cap_per_group(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), ["l_orderkey"], 2, [F.desc("l_extendedprice"), "l_linenumber"])
    return kept.select("l_orderkey", "l_linenumber").join(over, "l_orderkey", "left").withColumn("left_out", F.coalesce("left_out", F.lit(0)))


@query
def suffix_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose host is not on, or below a name on, a list of hosts."""
    registry = spark.createDataFrame([("domain", "example.net"), ("domain", "thther.example.org"), ("domain", "ther.example.com")], "kind string, value string")
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"))
    return candidates.exclude(pages, registry, "host").select("page_id", "host")


@query
def registrable_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-N6: registrable domain of every page host under the query's suffix rules."""
    rules = spark.createDataFrame([(r,) for r in fixture.SUFFIX_RULES], "rule string")
    pages = table(spark, sf_dir, "pages").select("page_id", N.url_host(F.col("url")).alias("host"))
    return N.registrable(pages, "host", rules)


@query
def candidate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of the derived companies over two paths, with guessed names below owned apexes."""
    rows = fixture.dns(spark, sf_dir)
    one = rows.select("entity_id", F.col("apex").alias("domain"), "apex", F.when(F.col("k") % 3 == 0, "official_url").otherwise("dmarc_rua").alias("method"), F.lit("a").alias("detail"))
    two = rows.select("entity_id", "domain", "apex", F.lit("spf_redirect").alias("method"), F.lit("b").alias("detail"))
    return candidates.add_labels(candidates.union_candidates(one, two), ["mail", "smtp"]).select("entity_id", "domain", "method")


@query
def picked_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event type that each user has most often, the first seen of equals."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return candidates.pick_domain(events, "user_id", "event_type", "event_id")


@query
def measurement_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries still to be asked for the derived domains, selectors by provider."""
    facts = fixture.facts(spark, sf_dir)
    providers = spark.createDataFrame([(1, "MX", r"vendor-a\.example$", ["a1", "s1"]), (2, "SPF_INCLUDE", "vendor-b", ["b1"])], "rank int, record string, pattern string, selectors array<string>")
    selectors = rules_ops.selectors_for(facts, providers, ["s1", "default"], ["domain"])
    tier = F.when(F.col("k") % 2 == 0, "A").otherwise("C")
    plan = candidates.expand_plan(facts.groupBy("domain").agg(F.min(tier).alias("tier"), F.min("mx_hosts").alias("mx_hosts")), selectors)
    return candidates.remaining(plan, fixture.bronze(spark, sf_dir).filter("observed"))


@query
def plan_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many queries of each purpose are still to be asked."""
    return candidates.plan_volume(measurement_plan(spark, sf_dir))


@query
def san_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part brands that share an order, orders with too many left out."""
    lines = table(spark, sf_dir, "lineitem")
    certs = lines.select(F.col("l_orderkey").alias("cert_id"), F.concat(F.lit("e"), (F.col("l_suppkey") % 50).cast("string")).alias("entity_id"), F.lit("b0").alias("own"), F.concat(F.lit("b"), (F.col("l_partkey") % 25).cast("string")).alias("registrable"))
    return candidates.san_siblings(certs, 3)


@query
def company_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between derived sites that are the same company's."""
    k = F.col("o_orderkey")
    target = F.when(k % 2 == 0, F.floor(k / 40) * 2).otherwise(F.floor(k / 4) * 2 + 1)  # twenty orders lead to each even one
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("e"), F.col("o_custkey").cast("string")).alias("entity_id"), F.concat(F.lit("s"), F.col("o_custkey").cast("string")).alias("source"), F.concat(F.lit("t"), target.cast("string")).alias("target"), (F.col("o_orderkey") % 3 > 0).alias("has_mx"), (F.col("o_orderkey") % 5 > 2).alias("names_company"), F.lit(False).alias("links_back"))
    companies = table(spark, sf_dir, "customer").select(F.concat(F.lit("e"), F.col("c_custkey").cast("string")).alias("entity_id"), F.concat(F.lit("t"), (F.col("c_custkey") * 7).cast("string")).alias("official_domain"))
    return candidates.same_company_links(orders, companies, k=8)


@query
def domain_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-C1, P18, A25: confidence, role, tier and decision of every derived domain."""
    rows = fixture.facts(spark, sf_dir)
    conf = C.domain_confidence(F.col("mx_present"), F.col("spf_present"), F.lit(False), F.col("dmarc_present"), F.when(F.col("k") % 3 == 0, 1).otherwise(0), F.col("spf_all_qualifier") == "-")
    rows = rows.withColumn("confidence", conf).withColumn("tier", C.measure_tier(F.col("confidence"))).withColumn("role", C.domain_role(F.col("domain"), F.concat(F.lit("c"), F.col("k").cast("string"), F.lit(".jp.example")), F.col("confidence")))
    judged = candidates.measure_decision(rows.withColumnsRenamed({"mx_present": "mx_exists", "dmarc_present": "dmarc_exists"}))
    return judged.groupBy("is_apex", "confidence", "role", "tier", F.coalesce("exclusion_reason", F.lit("measured")).alias("decision")).agg(F.count("*").alias("domains"))


@query
def report_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report targets of the derived records and the vendor that each belongs to."""
    vendors = spark.createDataFrame([("Vendor R", r"^r\.example$")], "vendor string, pattern string")
    return candidates.report_targets(fixture.facts(spark, sf_dir), vendors)


# ---------------------------------------------------------------- views and text


@query
def view_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of some nations by segment, with shares and places."""
    customers = table(spark, sf_dir, "customer").withColumn("segment", F.when(F.col("c_custkey") % 11 > 0, F.col("c_mktsegment")))
    return views.summarize(views.apply_view(customers, c_nationkey=[1, 2, 3, 5, 8, 13]), "segment", "segment")


@query
def search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: the second page of customers in which any column holds a text."""
    return views.search_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), "BUILD", 10, 20, ["c_custkey"]).select("c_custkey")


@query
def vocabulary_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms found in the documents, with how often."""
    terms = spark.createDataFrame([("idiot", "neutral word"), ("license", "check the licence"), ("token =", "secret?"), ("!!", "less emphasis")], "term string, advice string")
    return views.lint_text(table(spark, sf_dir, "documents"), terms, "doc_id", "text").select("doc_id", "term", "advice", "hits")


@query
def unknown_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For how many months in a row each user of the last month has been there; odd months were cut off."""
    events = table(spark, sf_dir, "events").withColumn("month", (F.hour("ts") % 12).cast("int"))
    by_month = events.groupBy("month", F.col("user_id").cast("string").alias("registered_domain")).agg(F.count("*").alias("count"))
    months = events.select("month").distinct().withColumn("truncated", F.col("month") % 2 == 1)
    return views.unknown_streak(by_month, months)


@query
def overdue_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are still open too long, by status."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("opened_at"), F.when(F.col("o_orderstatus") == "O", "open").otherwise("fixed").alias("status"))
    return views.overdue(orders, F.lit("1998-01-01 00:00:00").cast("timestamp"), 24 * 365).groupBy("status").agg(F.count_if("overdue").alias("overdue"), F.count("*").alias("items"))


@query
def finding_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J39, F-C11: findings of the derived facts, and whom not to write to."""
    facts = fixture.facts(spark, sf_dir).withColumns({"dkim_status": F.lit("not_applicable"), "dkim_revoked": F.lit(False)})
    optouts = spark.createDataFrame([("domain", "c7.jp.example"), ("entity", "e5")], "kind string, value string")
    names = facts.select("entity_id", F.concat(F.lit("Company "), F.col("entity_id")).alias("company")).distinct()
    return views.finding_targets(facts, names, optouts).select("domain", "entity_id", "company", F.array_join("findings", ",").alias("findings"), "skip_reason")


@query
def link_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T1: hosts that pages link to, by page."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.array_join(T.link_hosts(F.concat("html", F.lit('<a href="'), "url", F.lit('">self</a>'))), ",").alias("hosts"))


@query
def title_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T2: title of each page without blanks, and whether it holds a word."""
    pages = table(spark, sf_dir, "pages").select("page_id", T.title(F.col("html")).alias("title"))
    return pages.withColumn("has_the", F.contains(F.lower("title"), F.lit("the")))


@query
def plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T3: length and beginning of the plain text of each page."""
    return table(spark, sf_dir, "pages").select("page_id", T.plain_text(F.col("html")).alias("plain")).select("page_id", F.length("plain").alias("n"), F.md5(F.col("plain").cast("binary")).alias("digest"))


@query
def domain_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-T11: domains that suppliers with made-up English names may have."""
    name = F.concat(F.lit("Acme Steel "), F.col("s_suppkey").cast("string"), F.element_at(F.array(F.lit(" Holdings Inc"), F.lit(" Co., Ltd.")), (F.col("s_suppkey") % 2 + 1).cast("int")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(T.domain_guesses(name, ["co.jp"]), ",").alias("guesses"))


@query
def org_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisational domain by suffix rules and by tree walk, and whether they differ."""
    rules = spark.createDataFrame([(r,) for r in fixture.SUFFIX_RULES], "rule string")
    rows = fixture.dns(spark, sf_dir)
    answers = rows.filter("k % 3 = 0").select(F.concat(F.lit("_dmarc."), F.col("apex")).alias("name"), F.array(F.lit("v=DMARC1; p=none; psd=n")).alias("txts")).distinct()
    top = spark.createDataFrame([("_dmarc.jp.example", ["v=DMARC1; p=none; psd=y"])], "name string, txts array<string>")
    return facts_ops.org_domain(rows.select("k", "domain"), answers.unionByName(top), rules)
