"""Classifications as columns: park class, confidence, tiers, layers, stages, findings (survey 2.8, F-C1 to F-C13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strength of evidence types, and order of confidence levels.
EVIDENCE_PRIORITY = {"DKIM_CNAME": 4, "MX": 3, "SPF_INCLUDE": 2, "SPF_MECHANISM": 2, "VERIFICATION_TXT": 1}
CONFIDENCE = ["low", "medium", "high"]
# Weights of the evidence of a domain's mail use.
EVIDENCE_WEIGHT = {"dkim_cname": 4, "mx": 3, "spf_include": 2}
# Which discovery method supports ownership how well, strongest first.
OWNERSHIP_TIERS = ["company_stated", "certificate", "own_dns", "web_link", "other"]
OWNERSHIP_OF_METHOD = {
    "official_url": "company_stated",
    "official_alt": "company_stated",
    "edinet_koukoku": "company_stated",
    "manual": "company_stated",
    "ct_org": "certificate",
    "ct_log": "certificate",
    "tls_san": "certificate",
    "ct_mail_name": "certificate",
    "spf_redirect": "own_dns",
    "spf_include": "own_dns",
    "dmarc_rua": "own_dns",
    "site_link": "web_link",
    "sibling_tld": "web_link",
}
ENFORCING = ["reject", "quarantine"]
PARKED = ["hardened_parked", "defended_parked", "intentional_no_send", "neglected"]
STAGES = ["signed", "sending", "receiving", "none"]
NOT_DETECTED = "not_detected"
# Signs of services that expand includes away.
FLATTENING_SIGNS = ["powerspf.com", "_spf.vali.email", "spf.has.pphosted.com", "spf25.jp"]


def yes(c: Column) -> Column:
    """True only where the value is known to be true."""
    return F.coalesce(c, F.lit(False))


def any_true(values: Column) -> Column:
    """Three-valued "any" of an array of booleans: true, else NULL if one is unknown, else false."""
    return F.when(F.exists(values, lambda v: yes(v)), True).when(F.exists(values, lambda v: v.isNull()), F.lit(None).cast("boolean")).otherwise(False)


def ladder(c: Column, ranks: dict[str, int]) -> Column:
    """Rank of a value by a table; NULL for unknown values."""
    out = F.lit(None).cast("int")
    for value, rank in ranks.items():
        out = F.when(c == value, rank).otherwise(out)
    return out


def priority(record_type: Column) -> Column:
    """Strength of an evidence type; 0 for those without."""
    return F.coalesce(ladder(record_type, EVIDENCE_PRIORITY), F.lit(0))


def confidence_rank(c: Column) -> Column:
    return F.coalesce(ladder(c, {x: i for i, x in enumerate(CONFIDENCE)}), F.lit(0))


def confidence_of(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in CONFIDENCE]), rank + 1)


def park_class(observed: Column, mx_null: Column, mx_present: Column, spf_present: Column, dmarc_present: Column, qualifier: Column, effective: Column) -> Column:
    """F-C3: six classes of use; NULL where nothing was observed. ``qualifier`` is the record's own ``all``."""
    hard, soft = yes(qualifier == "-"), yes(qualifier.isin("-", "~"))
    enforced = yes(effective.isin(ENFORCING))
    return F.when(
        yes(observed),
        F.when(yes(mx_present) & yes(spf_present), "active_sending")
        .when(yes(mx_present), "inconsistent")
        .when(yes(mx_null) & hard & yes(effective == "reject"), "hardened_parked")
        .when(soft & enforced, "defended_parked")
        .when(soft, "intentional_no_send")
        .when(~yes(spf_present) & ~yes(dmarc_present), "neglected")
        .otherwise("inconsistent"),
    )


def domain_confidence(mx: Column, spf_aligned: Column, dkim: Column, dmarc: Column, independent: Column, hard_deny: Column) -> Column:
    """F-C1: confirmed, likely, unknown or parked."""
    primary = yes(spf_aligned) | yes(dkim)
    return (
        F.when(~yes(mx), F.when(yes(hard_deny), "parked").otherwise("unknown"))
        .when(primary & (independent >= 1), "confirmed")
        .when(primary | yes(dmarc), "likely")
        .otherwise("unknown")
    )


def domain_role(domain: Column, official: Column, confidence: Column) -> Column:
    """F-C1: parked, primary (the official domain) or related."""
    return F.when(confidence == "parked", "parked").when(yes(domain == official), "primary").otherwise("related")


def measure_tier(confidence: Column, full: tuple[str, ...] = ("confirmed", "likely")) -> Column:
    """F-C1: A (full) for the confidences of the configuration, else C."""
    return F.when(yes(confidence.isin(*full)), "A").otherwise("C")


def evidence_count(mx: Column, spf: Column, dkim: Column) -> Column:
    """F-C1: weighted number of proofs."""
    weigh = lambda c, k: F.when(yes(c), EVIDENCE_WEIGHT[k]).otherwise(0)
    return weigh(dkim, "dkim_cname") + weigh(mx, "mx") + weigh(spf, "spf_include")


def domain_evidence(mx: Column, hosts: Column, null_mx: Column, spf: Column, dmarc: Column, methods: Column, failures: Column) -> Column:
    """F-C1: why a domain was judged so, as an array of (type, weight, value)."""
    item = lambda kind, weight, value: F.struct(F.lit(kind).alias("type"), F.lit(weight).alias("weight"), value.alias("value"))
    fixed = F.array(
        F.when(yes(mx), item("mx", 3, F.array_join(F.slice(hosts, 1, 5), ","))),
        F.when(yes(null_mx), item("null_mx", 0, F.lit("0 ."))),
        F.when(yes(spf), item("spf", 2, F.lit("present"))),
        F.when(yes(dmarc), item("dmarc", 0, F.lit("present"))),
    )
    more = F.concat(F.transform(methods, lambda m: item("discovery", 0, m)), F.transform(failures, lambda f: item("query_failed", 0, f)))
    return F.concat(F.array_compact(fixed), more)


def ownership_tier(methods: Column) -> Column:
    """F-C9: the strongest ownership tier of the discovery methods; NULL without methods."""
    rank = {m: OWNERSHIP_TIERS.index(t) for m, t in OWNERSHIP_OF_METHOD.items()}
    best = F.array_min(F.transform(methods, lambda m: F.coalesce(ladder(m, rank), F.lit(len(OWNERSHIP_TIERS) - 1))))
    return F.get(F.array(*[F.lit(t) for t in OWNERSHIP_TIERS]), best)


def domain_stage(mx_reachable: Column, spf_sends: Column, dkim_status: Column) -> Column:
    """F-C9: how far a domain's set-up goes: none, receiving, sending, signed."""
    return F.when(~yes(mx_reachable), "none").when(~yes(spf_sends), "receiving").when(yes(dkim_status == "detected"), "signed").otherwise("sending")


def maturity_stage(spf: Column, dkim: Column, dmarc: Column, enforced: Column, mta_sts: Column, tls_rpt: Column, dnssec: Column, bimi_vmc: Column, dane: Column) -> Column:
    """0 to 4; each stage needs the one before. Stage 3 asks for MTA-STS presence, not enforcement."""
    return (
        F.when(~(yes(spf) & yes(dkim) & yes(dmarc)), 0)
        .when(~yes(enforced), 1)
        .when(~((yes(mta_sts) | yes(tls_rpt)) & yes(dnssec)), 2)
        .when(~(yes(bimi_vmc) | yes(dane)), 3)
        .otherwise(4)
    )


def effective_layer(layer: Column, category: Column, evidence_types: Column) -> Column:
    """F-C8: the layer a row counts in; rows that cannot be placed give NULL."""
    sends = F.arrays_overlap(evidence_types, F.array(F.lit("SPF_INCLUDE"), F.lit("SPF_MECHANISM"), F.lit("DKIM_CNAME")))
    return F.when(F.coalesce(layer, F.lit("")) != "", layer).when((category == "esp") & yes(sends), "sending_service").when(category == "dmarc_vendor", "dmarc_report_service")


def counts_as_using(vendor: Column, reason: Column, primary: Column, layer: Column) -> Column:
    """F-C8: whether a row proves use. Only an explicit ``false`` of ``primary`` excludes."""
    return (F.coalesce(vendor, F.lit("")) != NOT_DETECTED) & (F.coalesce(reason, F.lit("")) == "") & F.coalesce(primary, F.lit(True)) & layer.isNotNull()


def evidence_types(evidence_json: Column) -> Column:
    """Record types in an evidence JSON text; empty where it cannot be read."""
    return F.coalesce(F.transform(F.from_json(evidence_json, "array<struct<record_type:string>>"), lambda e: e["record_type"]), F.array().cast("array<string>"))


def self_hosted(registrable_hosts: Column, own: Column) -> Column:
    """F-C12: every MX host lies under the own registrable domain."""
    return yes((F.size(registrable_hosts) > 0) & (own != "") & F.forall(registrable_hosts, lambda h: h == own))


def undetectable_reason(observed: Column, is_self_hosted: Column, flattened: Column, spf_text: Column) -> Column:
    """F-C7: why no gateway can be seen, the strongest reason first."""
    signs = F.lit(False)
    for sign in FLATTENING_SIGNS:
        signs = signs | F.lower(F.coalesce(spf_text, F.lit(""))).contains(sign)
    return F.when(~yes(observed), "not_observed").when(yes(is_self_hosted), "self_hosted_mx").when(yes(flattened) | signs, "spf_flattened").otherwise("api_mode_product")


def entity_id(lei: Column, corporate_number: Column, cik: Column, filer_code: Column, qid: Column) -> Column:
    """F-C10: id by the strongest identifier; NULL if there is none."""
    full = lambda c: F.when(c != "", c)
    short = F.regexp_replace(full(cik), r"^0+", "")
    return F.coalesce(
        F.concat(F.lit("lei:"), F.upper(F.trim(full(lei)))),
        F.concat(F.lit("jp:"), full(corporate_number)),
        F.concat(F.lit("cik:"), F.when(short == "", "0").otherwise(short)),
        F.concat(F.lit("edinet:"), full(filer_code)),
        F.concat(F.lit("wd:"), full(qid)),
    )


def finding_codes(fact: dict[str, Column]) -> Column:
    """F-C11: codes of what a fact shows; empty where nothing was observed.

    ``dkim_not_found`` uses the status that the data really has (not found among the known selectors).
    """
    absent = lambda c: yes(~c)
    found = F.array(
        F.when(absent(fact["spf_present"]), "spf_absent").when(absent(fact["spf_valid"]), "spf_invalid"),
        F.when(yes(fact["spf_exceeds_limit"]), "spf_lookup_limit"),
        F.when(yes(fact["spf_all_qualifier"].isin("+", "?")), "spf_all_permissive"),
        F.when(absent(fact["dmarc_present"]), "dmarc_absent").when(yes(fact["effective_7489"] == "none"), "dmarc_none"),
        F.when(~absent(fact["dmarc_present"]) & yes(fact["blind_enforcement"]), "dmarc_no_rua"),
        F.when(~absent(fact["dmarc_present"]) & yes(fact["dmarc_multiple_records"]), "dmarc_multiple"),
        F.when(yes(fact["dkim_status"] == "not_found_in_known_selectors"), "dkim_not_found"),
        F.when(yes(fact["dkim_revoked"]), "dkim_revoked"),
    )
    return F.when(yes(fact["observed"]), F.array_compact(found)).otherwise(F.array().cast("array<string>"))


def describe_policy(policy: Column, has_rua: Column) -> Column:
    """F-C13: a policy in neutral words."""
    report = F.when(yes(has_rua), "aggregate reports are asked for").otherwise("no aggregate reports are asked for")
    what = F.when(policy == "reject", "mail that fails is to be rejected").when(policy == "quarantine", "mail that fails is to be set apart").when(policy == "none", "mail that fails is to be delivered").otherwise("no valid policy is given")
    return F.concat_ws("; ", what, report)
