"""Candidate domains and the measurement plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailposture.functions.classify import yes
from mailposture.functions.names import suffixes
from mailposture.operators.tables import must_be_short, short

# Discovery methods that follow DNS only, and those that prove ownership.
DNS_METHODS = ["spf_redirect", "spf_include", "dmarc_rua"]
OWNING_METHODS = ["official_url", "ct_log", "ct_org", "manual"]
# Left labels of names that look like mail hosts.
MAIL_LABELS = ["mail", "mx", "smtp", "imap", "pop", "webmail", "owa", "relay", "mta", "exchange"]


def cap_per_group(df: DataFrame, keys: list[str], n: int, order: list) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` rows of each group, and how many were left out of each group."""
    ranked = df.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    over = df.groupBy(*keys).agg(F.greatest(F.count("*") - n, F.lit(0)).alias("left_out")).filter("left_out > 0")
    return ranked.filter(F.col("_i") <= n).drop("_i"), over


def exclude(df: DataFrame, registry: DataFrame, domain: str = "domain", entity: str | None = None) -> DataFrame:
    """Rows whose domain is listed or lies below a listed domain go; with ``entity`` also exact companies.

    Names are spread into their parents and joined on equality, once for each distinct name.
    """
    listed = registry.filter("kind = 'domain'").select(F.lower("value").alias("_s")).distinct()
    names = df.select(F.lower(F.col(domain)).alias("_d")).filter("_d is not null").distinct()
    below = names.select("_d", F.explode(suffixes(F.col("_d"))).alias("_s")).join(listed, "_s", "left_semi").select("_d").distinct()
    out = df.join(below, F.lower(F.col(domain)) == F.col("_d"), "left_anti")
    if entity is not None:
        out = out.join(registry.filter("kind = 'entity'").select(F.col("value").alias("_e")).distinct(), F.col(entity) == F.col("_e"), "left_anti")
    return out


def union_candidates(*paths: DataFrame) -> DataFrame:
    """(entity_id, domain, apex, method, detail) of all paths; each (entity, domain, method) once, first detail.

    A row whose domain is not its apex stays only where the apex has a method that proves ownership; the apex itself
    is always a candidate.
    """
    rows = paths[0]
    for p in paths[1:]:
        rows = rows.unionByName(p)
    rows = rows.filter("apex is not null")
    apexes = rows.select("entity_id", F.col("apex").alias("domain"), "apex", "method", "detail")
    owned = rows.filter(F.col("method").isin(OWNING_METHODS)).select("entity_id", "apex").distinct()
    below = rows.filter("domain <> apex").join(owned, ["entity_id", "apex"], "left_semi")
    both = apexes.unionByName(below.select(apexes.columns))
    return both.groupBy("entity_id", "domain", "apex", "method").agg(F.min("detail").alias("detail"))


def shared_domains(df: DataFrame, domain: str = "domain", entity: str = "entity_id") -> DataFrame:
    """(domain, entities) of domains that several companies have."""
    return df.groupBy(domain).agg(F.count_distinct(entity).alias("n"), F.array_sort(F.collect_set(entity)).alias("entities")).filter("n > 1").drop("n")


def shared_dns_only(df: DataFrame, domain: str = "domain", entity: str = "entity_id", method: str = "method", dns: list[str] | None = None) -> DataFrame:
    """Domains of two or more companies that only DNS records led to: somebody else's service."""
    only = F.bool_and(F.col(method).isin(dns or DNS_METHODS))
    return df.groupBy(domain).agg(F.count_distinct(entity).alias("entities"), only.alias("dns_only")).filter("entities >= 2 and dns_only").select(domain, "entities")


def drop_shared_dns_only(candidates: DataFrame) -> DataFrame:
    """Candidates without such domains and without the names below them."""
    shared = shared_dns_only(candidates).select(F.col("domain").alias("_d"))
    out = candidates.join(shared, F.col("domain") == F.col("_d"), "left_anti")
    return out.join(shared, F.col("apex") == F.col("_d"), "left_anti")


def add_labels(candidates: DataFrame, labels: list[str], methods: list[str] | None = None) -> DataFrame:
    """Add guessed names below owned apexes (method common_label) where no other path found them."""
    owned = candidates.filter((F.col("domain") == F.col("apex")) & F.col("method").isin(methods or OWNING_METHODS)).select("entity_id", "apex").distinct()
    names = owned.withColumn("label", F.explode(F.array(*[F.lit(x) for x in labels])))
    rows = names.select("entity_id", F.concat_ws(".", "label", "apex").alias("domain"), "apex", F.lit("common_label").alias("method"), F.concat(F.lit("common label under "), F.col("apex")).alias("detail"))
    fresh = rows.join(candidates.select("entity_id", "domain").distinct(), ["entity_id", "domain"], "left_anti")
    return candidates.unionByName(fresh.select(candidates.columns))


def common_population(df: DataFrame, populations: str = "population_ids") -> str:
    """The first population that every row belongs to, else ``mixed``."""
    n = df.count()
    row = df.select(F.explode(F.array_distinct(populations)).alias("p")).groupBy("p").count().filter(F.col("count") == n).agg(F.min("p")).first()
    return row[0] if n and row[0] is not None else "mixed"


def candidate_stats(candidates: DataFrame, entities: DataFrame) -> DataFrame:
    """(measure, value): rows by method, distinct domains, companies without any candidate."""
    by = candidates.groupBy(F.concat(F.lit("method:"), F.col("method")).alias("measure")).agg(F.count("*").alias("value"))
    unique = candidates.agg(F.lit("unique_domains").alias("measure"), F.count_distinct("domain").alias("value"))
    none = entities.join(candidates.select("entity_id").distinct(), "entity_id", "left_anti").agg(F.lit("entities_without_candidates").alias("measure"), F.count("*").alias("value"))
    return by.unionByName(unique).unionByName(none)


def pick_domain(df: DataFrame, key: str, domain: str, position: str, fits: Column | None = None) -> DataFrame:
    """The domain a company states most often, the first seen of equals; with ``fits``, of those that fit."""
    rows = df if fits is None else df.filter(yes(fits))
    counts = rows.groupBy(key, domain).agg(F.count("*").alias("n"), F.min(position).alias("first"))
    return counts.groupBy(key).agg(F.max_by(domain, F.struct("n", -F.col("first"))).alias(domain))


def domain_stats(domains: DataFrame) -> DataFrame:
    """Domains by confidence, role and tier, apexes and names below apart."""
    return domains.groupBy("is_apex", "confidence", "role", "tier").agg(F.count("*").alias("domains"))


def without_confirmed(domains: DataFrame, entities: DataFrame) -> DataFrame:
    """Companies that have no confirmed domain."""
    return entities.join(domains.filter("confidence = 'confirmed'").select("entity_id").distinct(), "entity_id", "left_anti")


def report_targets(facts: DataFrame, vendors: DataFrame) -> DataFrame:
    """(target, domains, entities, vendor): report domains that are not the own one, with the vendor if known.

    ``vendors`` is a short table of (vendor, pattern).
    """
    spread = facts.select("domain", "entity_id", F.explode("dmarc_rua").alias("target")).filter("target <> domain")
    counts = spread.groupBy("target").agg(F.count_distinct("domain").alias("domains"), F.count_distinct("entity_id").alias("entities"))
    known = counts.join(must_be_short(vendors), F.expr("rlike(target, concat('(?i)', pattern))"), "left")
    return known.groupBy("target", "domains", "entities").agg(F.min("vendor").alias("vendor"))


def is_mail_name(name: Column, apex: Column) -> Column:
    """At most two labels below the apex, the left one a mail word with digits or a hyphenated part behind it."""
    below = name.endswith(F.concat(F.lit("."), apex))
    left = F.substring(name, F.lit(1), F.greatest(F.length(name) - F.length(apex) - 1, F.lit(0)))
    first = F.regexp_extract(left, r"^([^.]*)", 1)
    return yes(below & (F.size(F.split(left, r"\.")) <= 2) & first.rlike(rf"^({'|'.join(MAIL_LABELS)})(\d*|-.*)$"))


def mail_names(names: DataFrame, most: int = 30) -> DataFrame:
    """(entity_id, apex, names): mail-like names below each apex, the first ``most`` in order, with the total."""
    rows = names.filter(is_mail_name(F.lower("name"), F.col("apex"))).select("entity_id", "apex", F.lower("name").alias("name")).distinct()
    kept, over = cap_per_group(rows, ["entity_id", "apex"], most, ["name"])
    return kept.join(over, ["entity_id", "apex"], "left").na.fill(0, ["left_out"])


def measure_decision(df: DataFrame) -> DataFrame:
    """Add is_measured and exclusion_reason: what could not be observed is not measured, and a name below an
    apex only with MX or DMARC of its own. Rows are marked, not dropped."""
    bare = ~yes(F.col("is_apex")) & ~yes(F.col("mx_exists")) & ~yes(F.col("dmarc_exists"))
    reason = F.when(~yes(F.col("observed")), "primary_probe_failed").when(bare, "subdomain_without_own_mail")
    return df.withColumn("exclusion_reason", reason).withColumn("is_measured", F.col("exclusion_reason").isNull())


# ---------------------------------------------------------------- plan of queries

# What is asked for in each tier.
TIER_PURPOSES = {
    "A": ["mx", "spf", "dmarc", "dmarc_subdomain", "dkim", "dkim_control", "dkim_wildcard", "dkim_parent", "mta_sts", "tls_rpt", "bimi", "dane"],
    "C": ["mx", "spf", "dmarc", "dmarc_subdomain", "dkim_wildcard"],
}


def expand_plan(domains: DataFrame, selectors: DataFrame) -> DataFrame:
    """(domain, purpose, query_name, query_type) of every query of a measurement.

    ``domains``: (domain, tier, mx_hosts); ``selectors``: (domain, selectors). The control selector is a hash of the
    domain, so that repeated plans ask for the same names.
    """
    tier = F.create_map(*[x for k, v in TIER_PURPOSES.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in v]))])
    rows = domains.join(selectors, "domain", "left").withColumn("purpose", F.explode(tier[F.col("tier")]))
    d, p = F.col("domain"), F.col("purpose")
    one = lambda name: F.array(F.concat(F.lit(name), d))
    names = (
        F.when(p.isin("mx", "spf"), F.array(d))
        .when(p == "dmarc", one("_dmarc."))
        .when(p == "dmarc_subdomain", F.array(F.concat(F.lit("_dmarc.nx-"), F.substring(F.sha2(F.concat(F.lit("subdomain|"), d), 256), 1, 12), F.lit("."), d)))
        .when(p == "dkim", F.transform(F.coalesce("selectors", F.array().cast("array<string>")), lambda s: F.concat(s, F.lit("._domainkey."), d)))
        .when(p == "dkim_control", F.array(F.concat(F.lit("x-"), F.substring(F.sha2(F.concat(F.lit("control|"), d), 256), 1, 12), F.lit("._domainkey."), d)))
        .when(p == "dkim_wildcard", one("*._domainkey."))
        .when(p == "dkim_parent", one("_domainkey."))
        .when(p == "mta_sts", one("_mta-sts."))
        .when(p == "tls_rpt", one("_smtp._tls."))
        .when(p == "bimi", one("default._bimi."))
        .when(p == "dane", F.transform(F.coalesce("mx_hosts", F.array().cast("array<string>")), lambda h: F.concat(F.lit("_25._tcp."), h)))
    )
    qtype = F.when(p == "mx", "MX").when(p == "dane", "TLSA").otherwise("TXT")
    return rows.select("domain", "purpose", F.explode(names).alias("query_name"), qtype.alias("query_type")).distinct()


def plan_volume(plan: DataFrame) -> DataFrame:
    """Queries by purpose."""
    return plan.groupBy("purpose").agg(F.count("*").alias("queries"))


def allowed(plan: DataFrame, config: DataFrame) -> DataFrame:
    """The rows of a plan (with tier) whose purpose the tier's configuration allows; a short table."""
    return plan.join(short(config.select("tier", "purpose").distinct()), ["tier", "purpose"], "left_semi")


def measured(domains: DataFrame, tier: str | None = None) -> DataFrame:
    """Domains that are measured, of one tier if given."""
    rows = domains.filter(yes(F.col("is_measured")))
    return rows if tier is None else rows.filter(F.col("measure_tier") == tier)


def remaining(plan: DataFrame, bronze: DataFrame) -> DataFrame:
    """What is still to be asked: domains without any answer, and purposes that are missing for the others."""
    return plan.join(bronze.select("domain", "purpose").distinct(), ["domain", "purpose"], "left_anti")


# ---------------------------------------------------------------- certificates and links


def san_siblings(certs: DataFrame, limit: int) -> DataFrame:
    """(entity_id, registrable): names on a company's certificates; certificates with too many names are shared
    ones and prove nothing. ``certs``: (cert_id, entity_id, own, registrable), a row for each name."""
    sizes = certs.groupBy("cert_id").agg(F.count_distinct("registrable").alias("n")).filter(F.col("n") <= limit)
    rows = certs.join(sizes, "cert_id", "left_semi").filter("registrable is not null and registrable <> own")
    return rows.select("entity_id", "registrable").distinct()


def org_certs(certs: DataFrame, names: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Names on certificates whose organisation equals the company's up to blanks and case, and the companies
    whose list was cut at ``limit``. ``certs``: (organisation, registrable); ``names``: (entity_id, name)."""
    fold = lambda c: F.lower(F.regexp_replace(F.trim(c), r"\s+", " "))
    asked = names.select("entity_id", fold(F.col("name")).alias("_o"))
    rows = certs.withColumn("_o", fold(F.col("organisation"))).join(asked, "_o").select("entity_id", "registrable").filter("registrable is not null").distinct()
    return cap_per_group(rows, ["entity_id"], limit, ["registrable"])


def same_company_links(links: DataFrame, companies: DataFrame, k: int, most: int = 15) -> DataFrame:
    """(entity_id, target): links from a company's site to a domain that is its own as well.

    Out go targets that ``k`` or more sites link to, official sites of other companies, targets without MX, and pages
    that neither name the company nor link back. ``links``: (entity_id, source, target, has_mx, names_company,
    links_back); ``companies``: (entity_id, official_domain).
    """
    rows = links.filter("source <> target")
    shared = rows.groupBy("target").agg(F.count_distinct("source").alias("n")).filter(F.col("n") >= k)
    others = companies.select(F.col("entity_id").alias("_e"), F.col("official_domain").alias("target"))
    rows = rows.join(shared, "target", "left_anti").join(others, (rows["target"] == others["target"]) & (rows["entity_id"] != others["_e"]), "left_anti")
    good = rows.filter(yes(F.col("has_mx")) & (yes(F.col("names_company")) | yes(F.col("links_back")))).select("entity_id", "target").distinct()
    return cap_per_group(good, ["entity_id"], most, ["target"])[0]
