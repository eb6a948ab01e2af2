"""Published statistics: the metric table, sectors, platforms, deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailposture.functions import classify as C
from mailposture.functions.classify import yes
from mailposture.operators.tables import least_row

# Bytes of a TXT answer that fit into one UDP packet, addresses from which on a range counts as broad,
# names that stand for examples only, and the least size of a published cell.
TXT_SAFE_BYTES, BROAD_ADDRESSES, MIN_CELL = 1232, 65536, 5
EXAMPLE_NAMES = ["example.com", "example.net", "example.org"]
EXAMPLE_TLDS = ["example", "invalid", "test", "localhost"]
OTHER_SECTOR, OTHER_VENDOR = "other", "other_suppressed"
VALID_P = ["none", "quarantine", "reject"]
# Metrics whose change from month to month is shown.
HEADLINE = [
    "total_entities",
    "total_domains",
    "observed_domains",
    "entities_with_domains",
    "spf_adopted_domains",
    "dmarc_adopted_domains",
    "dmarc_enforced_domains",
    "enforced_reject_domains",
    "parked_hardened",
    "parked_neglected",
]

#: Columns of facts that the metrics read, and their types; missing ones count as never measured.
FACT_COLUMNS = {
    "domain_id": "string", "entity_id": "string", "is_apex": "boolean", "observed": "boolean", "spf_present": "boolean", "spf_error": "string",
    "spf_all_effective": "string", "spf_all_qualifier": "string", "spf_all_unknown": "boolean", "spf_includes": "array<string>",
    "spf_mechanisms": "array<string>", "raw_spf": "string", "spf_total_exceeds": "boolean", "spf_target_broken": "boolean",
    "spf_target_unregistered": "boolean", "spf_ip4_addresses": "bigint", "spf_has_ptr": "boolean", "txt_apex_bytes": "int",
    "dmarc_present": "boolean", "dmarc_multiple_records": "boolean", "dmarc_p": "string", "dmarc_np": "string", "dmarc_t": "string",
    "dmarc_rua": "array<string>", "dmarc_ruf": "array<string>", "effective_7489": "string", "applied_7489": "string", "sp_effective_7489": "string",
    "sp_weaker": "boolean", "policy_label": "string", "dmarc_historic_tags": "boolean", "rua_external": "boolean", "rua_authorized": "boolean",
    "rua_domain_unregistered": "boolean", "dkim_status": "string", "dkim_key_bits": "array<int>", "dkim_ed25519_only": "boolean",
    "dkim_domainkey_exists": "boolean", "mta_sts_present": "boolean", "mta_sts_mode": "string", "mta_sts_policy_status": "string",
    "mta_sts_mx_mismatch": "boolean", "tls_rpt_present": "boolean", "bimi_present": "boolean", "bimi_has_vmc": "boolean", "dnssec_signed": "boolean",
    "dane_present": "boolean", "dane_orphan": "boolean", "mx_present": "boolean", "mx_null": "boolean", "mx_unreachable": "boolean",
    "park_class": "string", "ownership": "string", "is_official": "boolean",
}


def null_policy(df: DataFrame, spec: dict[str, str], defaults: dict[str, object] | None = None) -> DataFrame:
    """Give missing columns as typed NULLs, fill the defaults, and keep other NULLs as NULLs."""
    out = df.withColumns({c: F.lit(None).cast(kind) for c, kind in spec.items() if c not in df.columns})
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()}) if defaults else out


def is_placeholder(domain: Column) -> Column:
    """A name that is reserved for examples."""
    d = F.regexp_replace(F.lower(F.trim(domain)), r"\.+$", "")
    below = F.lit(False)
    for name in EXAMPLE_NAMES:
        below = below | (d == name) | d.endswith(f".{name}")
    return yes((d != "") & (below | F.element_at(F.split(d, r"\."), -1).isin(EXAMPLE_TLDS)))


def derive_domain_row(facts: DataFrame) -> DataFrame:
    """The derived columns that metrics read, on top of the null policy.

    ``spf_all_effective`` wins wherever the column exists, even where it is NULL.
    """
    counted = "spf_all_effective" if "spf_all_effective" in facts.columns else "spf_all_qualifier"
    rows = null_policy(facts, FACT_COLUMNS, {"is_apex": True})
    listed = lambda c: yes(F.size(c) > 0)
    sends = listed("spf_includes") | listed("spf_mechanisms") | yes(F.col("raw_spf").rlike(r"(?i)(^|\s)[+]?ip[46]:"))
    rows = rows.withColumns(
        {
            "mx_reachable": yes(F.col("mx_present")) & ~yes(F.col("mx_null")) & ~yes(F.col("mx_unreachable")),
            "spf_sends": yes(F.col("spf_present")) & sends,
            "all_qualifier": F.col(counted),
            "has_rua": listed("dmarc_rua"),
            "has_ruf": listed("dmarc_ruf"),
            "rua_placeholder": yes(F.exists("dmarc_rua", is_placeholder)),
            "min_key_bits": F.array_min("dkim_key_bits"),
            "detected": yes(F.col("dkim_status") == "detected"),
            "enforced": yes(F.col("effective_7489").isin(C.ENFORCING)),
            "spf_usable": yes(F.col("spf_present")) & ~yes(F.col("spf_error").isin("multiple_records", "permerror")) & ~yes(F.col("spf_total_exceeds")),
            "dmarc_usable": yes(F.col("dmarc_present")) & ~yes(F.col("dmarc_multiple_records")) & yes(F.col("dmarc_p").isin(VALID_P)),
        }
    )
    stage = C.maturity_stage(*[F.col(c) for c in ("spf_present", "detected", "dmarc_present", "enforced", "mta_sts_present", "tls_rpt_present", "dnssec_signed")], yes(F.col("bimi_present")) & yes(F.col("bimi_has_vmc")), F.col("dane_present"))
    return rows.withColumns({"stage": stage, "domain_stage": C.domain_stage(F.col("mx_reachable"), F.col("spf_sends"), F.col("dkim_status"))})


def count_true(base: Column, value: Column) -> Column:
    """How often ``value`` is true where ``base`` holds; NULL if it was never measured there."""
    return F.when(F.count(F.when(base, value)) > 0, F.count_if(base & yes(value)))


def metrics() -> dict[str, Column]:
    """A1: the aggregate columns of the metric table over rows of ``derive_domain_row``.

    Denominators are the observed apex rows; subdomains have metrics of their own.
    """
    c, t = F.col, lambda name: yes(F.col(name))
    apex = yes(c("is_apex"))
    obs = apex & t("observed")
    sub = ~apex
    sub_obs = sub & t("observed")
    spf, dmarc = obs & t("spf_present"), obs & t("dmarc_present")
    eq = lambda name, value: yes(F.col(name) == value)
    n = F.count_if
    fetched = n(obs & t("mta_sts_present") & c("mta_sts_policy_status").isNull()) == 0
    walked = n(obs & (c("spf_total_exceeds").isNotNull() | c("spf_target_broken").isNotNull())) > 0
    single = spf & ~eq("spf_error", "multiple_records")
    known = single & ~t("spf_all_unknown")
    keyed = obs & t("detected") & c("min_key_bits").isNotNull()
    sending = obs & eq("park_class", "active_sending")
    parked = obs & yes(c("park_class").isin(C.PARKED))
    defended = n(obs & yes(c("park_class").isin("hardened_parked", "defended_parked")))
    label = lambda value: n(obs & eq("policy_label", value))
    park = lambda value: n(obs & eq("park_class", value))
    return {
        "total_domains": n(apex),
        "observed_domains": n(obs),
        "spf_adopted_domains": n(spf),
        "dmarc_adopted_domains": n(dmarc),
        "dmarc_enforced_domains": n(obs & c("enforced")),
        "dmarc_invalid_domains": n(dmarc & (t("dmarc_multiple_records") | ~yes(c("dmarc_p").isin(VALID_P)))),
        "dmarc_no_rua_domains": n(dmarc & ~c("has_rua")),
        "rua_placeholder_domains": n(dmarc & c("rua_placeholder")),
        "reject_with_rua_domains": n(dmarc & ~t("dmarc_multiple_records") & eq("dmarc_p", "reject") & c("has_rua") & ~c("rua_placeholder")),
        "dmarc_none_no_rua_domains": n(dmarc & ~c("has_rua") & eq("dmarc_p", "none")),
        "nominal_reject_domains": n(obs & eq("dmarc_p", "reject")),
        "enforced_reject_domains": label("enforced_reject"),
        "blind_reject_domains": label("blind_reject"),
        "sp_enforced_domains": n(obs & yes(c("sp_effective_7489").isin(C.ENFORCING))),
        "sp_weaker_domains": n(obs & t("sp_weaker")),
        "subdomains_measured": n(sub),
        "subdomains_observed": n(sub_obs),
        "subdomains_with_own_dmarc": n(sub_obs & t("dmarc_present")),
        "subdomains_dmarc_enforced": n(sub_obs & yes(F.coalesce("applied_7489", "effective_7489").isin(C.ENFORCING))),
        "subdomains_inherited_policy": n(sub_obs & ~t("dmarc_present") & (F.coalesce(c("applied_7489"), F.lit("")) != "")),
        "dkim_detected_domains": n(obs & c("detected")),
        "dkim_not_found_domains": n(obs & eq("dkim_status", "not_found_in_known_selectors")),
        "dkim_key_short_domains": n(keyed & (c("min_key_bits") < 1024)),
        "dkim_key_1024_domains": n(keyed & (c("min_key_bits") >= 1024) & (c("min_key_bits") < 2048)),
        "dkim_key_2048_domains": n(keyed & (c("min_key_bits") >= 2048)),
        "mta_sts_domains": n(obs & t("mta_sts_present")),
        "mta_sts_enforce_domains": F.when(fetched, n(obs & t("mta_sts_present") & eq("mta_sts_mode", "enforce"))),
        "mta_sts_testing_domains": F.when(fetched, n(obs & t("mta_sts_present") & eq("mta_sts_mode", "testing"))),
        "mta_sts_unusable_domains": F.when(fetched, n(obs & t("mta_sts_present") & yes(c("mta_sts_policy_status") != "ok"))),
        "mta_sts_mx_mismatch_domains": F.when(fetched, n(obs & t("mta_sts_mx_mismatch"))),
        "tls_rpt_domains": n(obs & t("tls_rpt_present")),
        "rua_external_domains": n(dmarc & t("rua_external")),
        "rua_unauthorized_domains": n(dmarc & t("rua_external") & yes(~c("rua_authorized"))),
        "rua_unregistered_domains": n(dmarc & t("rua_external") & t("rua_domain_unregistered")),
        "spf_lookup_exceeded_domains": F.when(walked, n(spf & t("spf_total_exceeds"))),
        "spf_target_broken_domains": F.when(walked, n(spf & t("spf_target_broken"))),
        "spf_dangling_domains": count_true(spf, c("spf_target_unregistered")),
        "txt_apex_oversize_domains": count_true(obs, c("txt_apex_bytes") > TXT_SAFE_BYTES),
        "dkim_ed25519_only_domains": count_true(obs, c("dkim_ed25519_only")),
        "dkim_other_selector_domains": count_true(obs & eq("dkim_status", "not_found_in_known_selectors"), c("dkim_domainkey_exists")),
        "dmarc_historic_tags_domains": count_true(dmarc, c("dmarc_historic_tags")),
        "spf_ip4_broad_domains": F.when(F.count(F.when(obs, c("spf_ip4_addresses"))) > 0, n(spf & yes(c("spf_ip4_addresses") > BROAD_ADDRESSES))),
        "spf_ptr_domains": count_true(spf, c("spf_has_ptr")),
        "dmarc_ruf_domains": n(dmarc & c("has_ruf")),
        "spf_all_fail_domains": n(known & eq("all_qualifier", "-")),
        "spf_all_softfail_domains": n(known & eq("all_qualifier", "~")),
        "spf_all_neutral_domains": n(known & eq("all_qualifier", "?")),
        "spf_all_pass_domains": n(known & eq("all_qualifier", "+")),
        "spf_all_missing_domains": n(known & c("all_qualifier").isNull()),
        "spf_all_unknown_domains": n(single & t("spf_all_unknown")),
        "bimi_domains": n(obs & t("bimi_present")),
        "bimi_vmc_domains": n(obs & t("bimi_present") & t("bimi_has_vmc")),
        "dnssec_domains": n(obs & t("dnssec_signed")),
        **{f"maturity_{k}": n(obs & (c("stage") == k)) for k in range(5)},
        "sending_domains": n(sending),
        "dmarc_np_domains": n(dmarc & yes(c("dmarc_np").isin(VALID_P))),
        "dmarc_testing_domains": n(dmarc & yes(F.lower("dmarc_t") == "y")),
        "bulk_spf_ok_domains": n(sending & c("spf_usable")),
        "bulk_dkim_domains": n(sending & c("detected")),
        "bulk_dmarc_ok_domains": n(sending & c("dmarc_usable")),
        "bulk_ready_domains": n(sending & c("spf_usable") & c("detected") & c("dmarc_usable")),
        "sending_enforced": n(sending & c("enforced")),
        "parked_domains": n(parked),
        "parked_hardened": park("hardened_parked"),
        "parked_defended": park("defended_parked"),
        "parked_intentional": park("intentional_no_send"),
        "parked_neglected": park("neglected"),
        "park_defense_rate": F.round(defended / F.nullif(n(parked), F.lit(0)), 4),
        "dane_domains": n(obs & t("dane_present")),
        "dane_dnssec_valid": n(obs & t("dane_present") & t("dnssec_signed") & ~t("dane_orphan")),
        "dane_orphan": n(obs & t("dane_orphan")),
    }


#: Counts of entities; groups without any have 0, but the hint stays NULL.
ENTITY_COUNTS = [
    "entities_with_domains", "entities_with_subdomain_mail", "spf_adopted_entities", "dmarc_adopted_entities", "dmarc_enforced_entities",
    "evidence_signed_entities", "evidence_sending_entities", "evidence_receiving_entities", "evidence_none_entities", "mail_off_site_entities",
]


def entity_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per group how many entities have domains and records, are in each exclusive stage of mail use, use mail
    off their site, and give the DKIM hint.

    Entities are folded first, then counted, so that no distinct count spreads the rows; the hint is NULL if it was
    never measured. Stages look at observed apexes.
    """
    apex, official = yes(F.col("is_apex")), yes(F.col("is_official"))
    obs = apex & yes(F.col("observed"))
    some = lambda cond: F.bool_or(obs & yes(cond))
    reach = F.col("mx_reachable")
    one = rows.filter(F.coalesce("entity_id", F.lit("")) != "").groupBy(*keys, "entity_id")
    one = one.agg(
        F.bool_or(apex).alias("apex"),
        F.bool_or(~apex).alias("below"),
        F.bool_or(obs).alias("seen"),
        some(F.col("spf_present")).alias("spf"),
        some(F.col("dmarc_present")).alias("dmarc"),
        some(F.col("enforced")).alias("enforced"),
        some(reach).alias("mx"),
        some(F.col("spf_sends")).alias("send"),
        some(F.col("detected")).alias("signed"),
        some(F.col("dkim_domainkey_exists")).alias("hint"),
        (F.count(F.when(obs, F.col("dkim_domainkey_exists"))) > 0).alias("hinted"),
        (some(official) & ~some(official & reach) & some(~official & reach)).alias("off_site"),
    )
    o, m, s, g = F.col("seen"), F.col("mx"), F.col("send"), F.col("signed")
    n = F.count_if
    return one.groupBy(*keys).agg(
        n("apex").alias("entities_with_domains"),
        n("below").alias("entities_with_subdomain_mail"),
        n("spf").alias("spf_adopted_entities"),
        n("dmarc").alias("dmarc_adopted_entities"),
        n("enforced").alias("dmarc_enforced_entities"),
        n(m & s & g).alias("evidence_signed_entities"),
        n(m & s & ~g).alias("evidence_sending_entities"),
        F.when(F.bool_or("hinted"), n(m & s & ~g & F.col("hint"))).alias("evidence_dkim_hint_entities"),
        n(m & ~s).alias("evidence_receiving_entities"),
        n(o & ~m).alias("evidence_none_entities"),
        n("off_site").alias("mail_off_site_entities"),
    )


def ownership_crosstab(rows: DataFrame, keys: list[str], row: str = "ownership", column: str = "domain_stage", columns: list[str] | None = None) -> DataFrame:
    """Counts of each ``row`` value by ``column`` value, all cells present."""
    values = columns or C.STAGES
    return rows.filter(F.col(row).isNotNull()).groupBy(*keys, row).pivot(column, values).count().na.fill(0, values)


def ownership_cells() -> tuple[dict[str, Column], Column]:
    """A8 at the gold boundary: the cells of the crosstab of all tiers as aggregates, and the JSON made of them, NULL
    where nothing has an owner."""
    obs = yes(F.col("is_apex")) & yes(F.col("observed"))
    cells = {f"_{t}|{s}": F.count_if(obs & yes(F.col("ownership") == t) & (F.col("domain_stage") == s)) for t in C.OWNERSHIP_TIERS for s in C.STAGES}
    cells["_owned"] = F.count(F.when(obs, F.col("ownership")))
    tiers = F.struct(*[F.struct(*[F.col(f"_{t}|{s}").alias(s) for s in sorted(C.STAGES)]).alias(t) for t in sorted(C.OWNERSHIP_TIERS)])
    return cells, F.when(F.col("_owned") > 0, F.to_json(tiers))


def stats_overall(rows: DataFrame, keys: list[str], totals: DataFrame | None = None) -> DataFrame:
    """The metric table, one row for each value of ``keys``.

    ``rows`` comes from ``derive_domain_row`` with the key columns added; ``totals`` has the keys and total_entities
    (entities without any domain count too). What counts domains is one aggregation with map-side combining; what
    counts entities is a second one, folded by entity.
    """
    dist = F.to_json(F.struct(*[F.col(f"maturity_{k}").alias(str(k)) for k in range(5)]))
    cells, owned = ownership_cells()
    out = rows.groupBy(*keys).agg(*[m.alias(name) for name, m in (metrics() | cells).items()])
    out = out.withColumns({"maturity_stage_dist": dist, "ownership_evidence_dist": owned}).drop(*cells)
    out = out.join(entity_counts(rows, keys), keys, "left").na.fill(0, ENTITY_COUNTS)
    return out if totals is None else totals.select(*keys, "total_entities").join(out, keys, "left")


def with_entities(facts: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts of known entities, and the facts of entities that are in no population."""
    return facts.join(entities, "entity_id"), facts.join(entities, "entity_id", "left_anti")


def explode_population(df: DataFrame, populations: str = "population_ids", out: str = "population_id") -> DataFrame:
    """A row for each population an entity belongs to."""
    return df.withColumn(out, F.explode(populations))


def subdomain_coverage(domains: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Subdomains found per group and how many of them a record of the apex or their own covers."""
    sub = domains.filter(~yes(F.col("is_apex"))).select(*keys, "entity_id", "apex", "domain")
    top = facts.filter(yes(F.col("dmarc_present"))).select(F.col("domain").alias("apex"), F.lit(True).alias("covered")).distinct()
    return sub.join(top, "apex", "left").groupBy(*keys).agg(F.count("*").alias("subdomains_found"), F.count_if(yes(F.col("covered"))).alias("subdomains_found_dmarc"))


# ---------------------------------------------------------------- disclosure control


def suppression_plan(counts: DataFrame, group: str | list[str], code: str, n: str = "n", k: int = MIN_CELL) -> DataFrame:
    """A3: add ``suppressed`` and ``secondary``: cells below ``k`` are hidden; where only one is, the smallest other too."""
    keys = [group] if isinstance(group, str) else group
    small = F.col(n) < k
    hidden = F.count_if(small).over(Window.partitionBy(*keys))
    rank = F.row_number().over(Window.partitionBy(*keys, small).orderBy(n, code))
    secondary = (hidden == 1) & ~small & (rank == 1)
    return counts.withColumn("secondary", secondary).withColumn("suppressed", small | F.col("secondary"))


def is_recoverable(plan: DataFrame, group: str | list[str], n: str = "n", k: int = MIN_CELL) -> DataFrame:
    """A4: per group whether hidden cells could be computed: one alone, or all together below ``k``."""
    keys = [group] if isinstance(group, str) else group
    hidden = F.count_if("suppressed")
    return plan.groupBy(*keys).agg(hidden.alias("hidden"), ((hidden == 1) | ((hidden > 0) & (F.coalesce(F.sum(F.when(F.col("suppressed"), F.col(n))), F.lit(0)) < k))).alias("recoverable"))


def stats_by_sector(rows: DataFrame, group: str, sector: str, totals: DataFrame, k: int = MIN_CELL) -> DataFrame:
    """A2: the metric table by sector, hidden sectors together in one row ``other``.

    ``totals`` has (group, sector, n) with the entities of each cell, those without domains included.
    """
    plan = suppression_plan(totals, group, sector, "n", k)
    label = F.when(F.col("suppressed"), OTHER_SECTOR).otherwise(F.col(sector).cast("string"))
    cells = plan.select(group, sector, label.alias("sector_label"), "n")
    bundled = rows.join(cells.drop("n"), [group, sector])
    sums = cells.groupBy(group, "sector_label").agg(F.sum("n").alias("total_entities"))
    return stats_overall(bundled, [group, "sector_label"], sums)


def stats_platform(inferences: DataFrame, group: str, k: int = MIN_CELL) -> DataFrame:
    """A5: per group, layer and vendor the entities and domains that use it at all, and for receiving.

    ``inferences`` has (group, layer, vendor, entity_id, domain_id, engine, receiving), filtered by
    ``classify.counts_as_using``. Vendors of fewer than ``k`` entities are bundled by set union, counted over their
    rows again, not by adding up.
    """
    sizes = inferences.groupBy(group, "layer", "vendor").agg(F.count_distinct("entity_id").alias("_size"))
    rows = inferences.join(sizes, [group, "layer", "vendor"]).withColumn("suppressed", F.col("_size") < k)
    rows = rows.withColumn("label", F.when(F.col("suppressed"), OTHER_VENDOR).otherwise(F.col("vendor")))
    engine = F.when(~F.bool_or("suppressed") & (F.count_distinct("engine") == 1), F.max("engine"))
    receiving = lambda c: F.count_distinct(F.when(yes(F.col("receiving")), F.col(c)))
    out = rows.groupBy(group, "layer", "label").agg(
        engine.alias("engine"),
        F.count_distinct("entity_id").alias("entities_any"),
        F.count_distinct("domain_id").alias("domains_any"),
        receiving("entity_id").alias("entities_receiving"),
        receiving("domain_id").alias("domains_receiving"),
        F.bool_or("suppressed").alias("suppressed"),
    )
    identified = inferences.groupBy(group, "layer").agg(F.count_distinct("domain_id").alias("identified_domains"), F.count_distinct("entity_id").alias("identified_entities"))
    return out.join(identified, [group, "layer"]).withColumnRenamed("label", "vendor")


def platform_summary(platform: DataFrame) -> DataFrame:
    """Vendors and suppressed entities of each layer."""
    return platform.groupBy("layer").agg(F.count("*").alias("vendors"), F.coalesce(F.sum(F.when(F.col("suppressed"), F.col("entities_any"))), F.lit(0)).alias("suppressed_entities"))


def vendor_share(inferences: DataFrame, category: str, layer: str | None = None, by: str = "vendor") -> DataFrame:
    """How many rows of a category count for each vendor, or with ``by='engine'`` for each engine."""
    rows = inferences.filter((F.col("category") == category) & (F.coalesce("undetectable_reason", F.lit("")) == "") & F.coalesce("is_layer_primary", F.lit(True)) & (F.coalesce(by, F.lit("")) != "") & (F.col("vendor") != C.NOT_DETECTED))
    rows = rows if layer is None else rows.filter(F.col("layer") == layer)
    return rows.groupBy(by).agg(F.count("*").alias("count"))


# ---------------------------------------------------------------- month over month

# Rank and state of effective policies in comparisons; NULL is "no DMARC".
POLICY_RANK = {"none": 1.0, "quarantine_partial": 1.5, "quarantine": 2.0, "reject": 3.0}
POLICY_STATE = {"none": "none", "quarantine_partial": "quarantine", "quarantine": "quarantine", "reject": "reject"}


def _mapped(c: Column, values: dict, missing: object) -> Column:
    out = F.lit(missing)
    for key, value in values.items():
        out = F.when(c == key, value).otherwise(out)
    return out


def monthly_delta(cur: DataFrame, prev: DataFrame, prev2: DataFrame | None = None, key: str = "domain_id") -> DataFrame:
    """One row for each domain of either month with what became of it.

    Inputs have (key, observed, effective_7489, has_rua, record_present). A domain that was not observed is neither
    gone nor weaker; ``disappeared`` needs two observed absences in a row after a month in which it was observed.
    """
    take = lambda df, p: least_row(df, [key], ["observed", "effective_7489", "has_rua", "record_present"]).select(key, *[F.col(c).alias(f"{p}_{c}") for c in ("observed", "effective_7489", "has_rua", "record_present")], F.lit(True).alias(p))
    out = take(cur, "c").join(take(prev, "p"), key, "full")
    if prev2 is not None:
        out = out.join(take(prev2, "q"), key, "left")
    c, p = yes(F.col("c")), yes(F.col("p"))
    both = c & p & yes(F.col("c_observed")) & yes(F.col("p_observed"))
    had, has = F.col("p_effective_7489"), F.col("c_effective_7489")
    # An unknown policy name ranks 0 and reads as "none"; NULL reads as "no DMARC".
    rank = lambda x: F.when(x.isNull(), 0.0).otherwise(_mapped(x, POLICY_RANK, 0.0))
    state = lambda x: F.when(x.isNull(), "no_dmarc").otherwise(_mapped(x, POLICY_STATE, "none"))
    records = had.isNotNull() & has.isNotNull()
    gone = lambda m: yes(F.col(f"{m}_observed")) & yes(~F.col(f"{m}_record_present"))
    return out.select(
        key,
        (c & ~p).alias("is_new"),
        (p & ~(c & yes(F.col("c_observed")))).alias("unobserved"),
        F.when(both, F.concat(state(had), F.lit(">"), state(has))).alias("transition"),
        (both & (rank(has) > rank(had))).alias("upgraded"),
        (both & (rank(has) < rank(had))).alias("downgraded"),
        (both & records & yes(F.col("c_has_rua")) & ~yes(F.col("p_has_rua"))).alias("rua_added"),
        (both & records & yes(F.col("p_has_rua")) & ~yes(F.col("c_has_rua"))).alias("rua_removed"),
        (F.lit(None).cast("boolean") if prev2 is None else yes(F.col("q_observed")) & gone("p") & gone("c")).alias("disappeared"),
    )


def delta_counts(delta: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The delta as counts; ``disappeared`` is NULL where the month before last is missing."""
    n = lambda c: F.count_if(c)
    return delta.groupBy(*(keys or [])).agg(
        n("is_new").alias("domains_new"),
        n("unobserved").alias("domains_unobserved_this_month"),
        n("upgraded").alias("policy_upgraded"),
        n("downgraded").alias("policy_downgraded"),
        n("rua_added").alias("rua_added"),
        n("rua_removed").alias("rua_removed"),
        F.when(F.count("disappeared") > 0, F.count_if("disappeared")).alias("domains_disappeared"),
    )


def transition_matrix(delta: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """How many domains went from which policy state to which, the diagonal included."""
    return delta.filter("transition is not null").groupBy(*(keys or []), "transition").agg(F.count("*").alias("domains"))


def churn(cur: DataFrame, prev: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Keys that came and keys that went."""
    return cur.select(key).distinct().join(prev, key, "left_anti"), prev.select(key).distinct().join(cur, key, "left_anti")


def diff_stats(cur: DataFrame, prev: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Change of the headline metrics; a missing earlier value counts as 0."""
    names = columns or HEADLINE
    old = prev.select(*keys, *[F.col(c).alias(f"_p_{c}") for c in names])
    return cur.join(old, keys, "left").select(*keys, *[(F.coalesce(c, F.lit(0)) - F.coalesce(f"_p_{c}", F.lit(0))).alias(c) for c in names])


def changes(cur: DataFrame, prev: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, metric, before, after) of the tracked values that changed; NULLs on either side are left out."""
    long = lambda df, name: df.select(*keys, *[F.col(c).cast("long").alias(c) for c in columns]).unpivot(keys, columns, "metric", name)
    return long(cur, "after").join(long(prev, "before"), [*keys, "metric"]).filter("before <> after").select(*keys, "metric", "before", "after")


def version_changes(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """(phase, key, before, after) of versions that differ, missing ones included; no rows without an earlier month."""
    joined = cur.select("phase", "key", F.col("value").alias("after")).join(prev.select("phase", "key", F.col("value").alias("before")), ["phase", "key"], "full")
    any_before = prev.limit(1).select(F.lit(True).alias("_any"))
    return joined.filter(~F.col("before").eqNullSafe(F.col("after"))).join(F.broadcast(any_before), how="left_semi", on=F.lit(True)).withColumn("kind", F.when(F.col("key") == "config_hash", "config").otherwise("version"))


def measurement_moved(versions: DataFrame, metrics: DataFrame) -> DataFrame:
    """(version_changes, config_changes, metric_changes, coincide): the note that measuring and figures changed in
    the same month, so that the figures' change cannot be read as one of the world.

    ``versions`` comes from ``version_changes``, ``metrics`` from ``changes``.
    """
    measured = versions.agg(F.count_if(F.col("kind") == "version").alias("version_changes"), F.count_if(F.col("kind") == "config").alias("config_changes"))
    both = measured.crossJoin(metrics.agg(F.count("*").alias("metric_changes")))  # a row each
    return both.withColumn("coincide", (F.col("version_changes") + F.col("config_changes") > 0) & (F.col("metric_changes") > 0))


def sector_set_changed(cur: DataFrame, prev: DataFrame, sector: str) -> DataFrame:
    """(added, removed, changed): sector codes of one month only; a changed set cannot be compared sector by sector.

    NULL ``changed`` where one month has no codes at all.
    """
    now, before = cur.select(F.col(sector).alias("s")).filter("s is not null").distinct(), prev.select(F.col(sector).alias("s")).filter("s is not null").distinct()
    both = now.withColumn("_now", F.lit(True)).join(before.withColumn("_before", F.lit(True)), "s", "full")
    added, removed = F.count_if(F.col("_before").isNull()).alias("added"), F.count_if(F.col("_now").isNull()).alias("removed")
    known = (F.count("_now") > 0) & (F.count("_before") > 0)
    return both.agg(added, removed, F.when(known, F.count_if(F.col("_before").isNull() | F.col("_now").isNull()) > 0).alias("changed"))


def shrinking(cur: DataFrame, prev: DataFrame, key: str = "population_id", column: str = "total_domains") -> DataFrame:
    """Populations whose figure fell below the earlier one."""
    return cur.select(key, F.col(column).alias("now")).join(prev.select(key, F.col(column).alias("before")), key).filter("now < before")


def indicators(stats: DataFrame, keys: list[str], ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """(keys, indicator, numerator, denominator, rate, band) from named ratios of metric columns.

    Bands: high from 0.8 on, low below 0.5, else middle; NULL where the denominator is 0 or unknown.
    """
    rows = F.array(*[F.struct(F.lit(name).alias("indicator"), F.col(a).cast("long").alias("numerator"), F.col(b).cast("long").alias("denominator")) for name, (a, b) in ratios.items()])
    out = stats.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")
    rate = F.round(F.col("numerator") / F.nullif(F.col("denominator"), F.lit(0)), 4)
    return out.withColumn("rate", rate).withColumn("band", F.when(F.col("rate") >= 0.8, "high").when(F.col("rate") < 0.5, "low").when(F.col("rate").isNotNull(), "middle"))


def pair_table(stats: DataFrame, key: str, values: list[str], row: str, column: str) -> DataFrame:
    """One metric of several populations side by side."""
    return stats.groupBy(row).pivot(key, values).agg(F.max(column))
