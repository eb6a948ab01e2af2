"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from mailposture.plans import fixture

ORACLE: dict[str, str] = {}


def tag(name: str) -> str:
    """Value of a DMARC tag of the only record, NULL if missing or empty."""
    return rf"nullif(lower(trim(regexp_extract(rec, '(?i)(?:^|;)\s*{name}\s*=([^;]*)', 1))), '')"


def effective(p: str, pct: str) -> str:
    return f"CASE WHEN {p} = 'reject' THEN CASE WHEN coalesce({pct}, 100) >= 100 THEN 'reject' WHEN {pct} > 0 THEN 'quarantine' ELSE 'none' END WHEN {p} = 'quarantine' THEN CASE WHEN coalesce({pct}, 100) >= 100 THEN 'quarantine' WHEN {pct} = 0 THEN 'none' ELSE 'quarantine_partial' END ELSE 'none' END"


def strength(c: str) -> str:
    return f"CASE {c} WHEN 'none' THEN 0 WHEN 'quarantine_partial' THEN 1 WHEN 'quarantine' THEN 2 WHEN 'reject' THEN 3 END"


def facts(month: int = 1, name: str = "facts") -> str:
    """CTEs that end in a table of facts like ``fixture.facts``."""
    n = name
    return rf"""
{n}_dns AS ({fixture.dns_sql(month)}),
{n}_rec AS (SELECT *, CASE WHEN observed AND regexp_matches(dmarc, '^[vV]=\s*DMARC1\s*(;|$)') THEN dmarc END AS rec,
  CASE WHEN observed THEN spf END AS rs, CASE WHEN observed THEN mx END AS rm FROM {n}_dns),
{n}_tags AS (SELECT *, rec IS NOT NULL AS dmarc_present, {tag("p")} AS dmarc_p, {tag("sp")} AS dmarc_sp, {tag("np")} AS dmarc_np, {tag("t")} AS dmarc_t, {tag("psd")} AS dmarc_psd,
  TRY_CAST({tag("pct")} AS INT) AS dmarc_pct,
  list_filter(list_transform(string_split(regexp_extract(rec, '(?i)(?:^|;)\s*rua\s*=([^;]*)', 1), ','), lambda x: lower(regexp_extract(x, '@([^!]*)', 1))), lambda x: x <> '') AS rua,
  list_slice(string_split(rs, ' '), 2, 1000) AS terms FROM {n}_rec),
{n}_eff AS (SELECT *, CASE WHEN dmarc_present THEN {effective("dmarc_p", "dmarc_pct")} END AS effective_7489,
  CASE WHEN dmarc_present THEN CASE WHEN coalesce(dmarc_t, 'n') <> 'y' THEN CASE WHEN dmarc_p IN ('none', 'quarantine', 'reject') THEN dmarc_p ELSE 'none' END WHEN dmarc_p = 'reject' THEN 'quarantine' ELSE 'none' END END AS effective_9989,
  CASE WHEN dmarc_sp IN ('none', 'quarantine', 'reject') THEN dmarc_sp ELSE dmarc_p END AS below FROM {n}_tags),
{n}_eff2 AS (SELECT *, CASE WHEN dmarc_present THEN {effective("below", "dmarc_pct")} END AS sp_effective_7489 FROM {n}_eff),
{n} AS (SELECT *, concat('d', k) AS domain_id, coalesce({strength("sp_effective_7489")} < {strength("effective_7489")}, false) AS sp_weaker,
  coalesce(len(rua), 0) > 0 AS has_rua,
  CASE WHEN dmarc_present THEN CASE
    WHEN dmarc_p = 'reject' AND dmarc_pct < 100 THEN 'nominal_reject_weak_pct'
    WHEN dmarc_p = 'quarantine' AND dmarc_pct < 100 THEN 'nominal_quarantine_weak_pct'
    WHEN dmarc_p IN ('reject', 'quarantine') AND dmarc_t = 'y' THEN 'nominal_reject_testing'
    WHEN dmarc_p = 'reject' THEN CASE WHEN coalesce(len(rua), 0) > 0 THEN 'enforced_reject' ELSE 'blind_reject' END
    WHEN dmarc_p = 'quarantine' THEN CASE WHEN coalesce(len(rua), 0) > 0 THEN 'enforced_quarantine' ELSE 'blind_quarantine' END
    WHEN dmarc_p = 'none' THEN CASE WHEN coalesce(len(rua), 0) > 0 THEN 'monitoring' ELSE 'ineffective' END
    ELSE 'none' END END AS policy_label,
  rs IS NOT NULL AS spf_present,
  substr(list_filter(terms, lambda t: regexp_matches(t, '^[-+~?]?all$'))[1], 1, 1) AS spf_all_qualifier,
  coalesce(len(list_filter(terms, lambda t: regexp_matches(t, '^(include:|a$|mx$|redirect=)'))), 0) AS spf_lookup_count,
  CASE WHEN len(list_filter(terms, lambda t: ends_with(t, 'all'))) > 0 THEN NULL ELSE replace(list_filter(terms, lambda t: starts_with(t, 'redirect='))[1], 'redirect=', '') END AS spf_redirect,
  coalesce(array_to_string(list_transform(list_filter(terms, lambda t: starts_with(t, 'include:')), lambda t: replace(t, 'include:', '')), ','), '') AS includes,
  coalesce(array_to_string(list_filter(terms, lambda t: NOT ends_with(t, 'all') AND NOT starts_with(t, 'ip4:')), ' '), '') AS mechanisms,
  CASE WHEN observed THEN coalesce(rm = '.', false) END AS mx_null,
  coalesce(rm <> '.', false) AS mx_present,
  CASE WHEN rm <> '.' THEN rm ELSE '' END AS mx_hosts,
  CASE WHEN NOT observed THEN NULL
    WHEN coalesce(rm <> '.', false) THEN CASE WHEN rs IS NOT NULL THEN 'active_sending' ELSE 'inconsistent' END
    WHEN coalesce(rm = '.', false) AND coalesce(rs LIKE '% -all', false) AND coalesce(effective_7489 = 'reject', false) THEN 'hardened_parked'
    WHEN regexp_matches(coalesce(rs, ''), ' [-~]all$') AND coalesce(effective_7489 IN ('reject', 'quarantine'), false) THEN 'defended_parked'
    WHEN regexp_matches(coalesce(rs, ''), ' [-~]all$') THEN 'intentional_no_send'
    WHEN rs IS NULL AND NOT dmarc_present THEN 'neglected' ELSE 'inconsistent' END AS park_class,
  observed AND (rs IS NOT NULL OR dmarc_present) AS record_present,
  coalesce(effective_7489 IN ('reject', 'quarantine'), false) AS enforced
  FROM {n}_eff2)"""


ORACLE["dmarc_policy_effective"] = f"""WITH {facts()}
SELECT k, dmarc_present, dmarc_p, dmarc_sp, dmarc_pct, coalesce(array_to_string(rua, ','), '') AS rua, effective_7489, effective_9989, sp_effective_7489, sp_weaker, policy_label,
  enforced AND NOT has_rua AS blind_enforcement,
  CASE WHEN dmarc_present THEN CASE WHEN dmarc_pct IS NULL AND coalesce(dmarc_t, dmarc_psd, dmarc_np) IS NOT NULL THEN 'rfc9989' ELSE 'rfc7489' END END AS spec_version,
  CASE WHEN dmarc_present THEN dmarc_pct IS NOT NULL END AS dmarc_historic_tags FROM facts"""

ORACLE["spf_terms_counts"] = f"""WITH {facts()}
SELECT k, spf_present, NULL::VARCHAR AS spf_error, spf_all_qualifier, spf_lookup_count::INT AS spf_lookup_count, spf_redirect, includes, mechanisms, false AS spf_is_flattened, false AS spf_is_dynamic FROM facts"""

ORACLE["park_classes"] = f"""WITH {facts()} SELECT k, mx_present, mx_null, mx_hosts, park_class FROM facts"""

# c_custkey decides the derived key record: of each domain that several customers share, all rows meet in one fact.
ORACLE["facts_from_bronze"] = f"""WITH {facts()},
one AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY k) AS i, count(*) OVER (PARTITION BY domain) AS n FROM facts)
SELECT domain, observed, CASE WHEN observed THEN spf_present OR dmarc IS NOT NULL OR mx IS NOT NULL OR k % 3 < 2 END AS record_present,
  rs AS raw_spf, spf_lookup_count::INT AS spf_lookup_count, dmarc_p, effective_7489, coalesce(rm = '.', false) AS mx_null, mx_hosts,
  CASE WHEN observed AND k % 3 = 0 THEN 'detected' ELSE 'not_found_in_known_selectors' END AS dkim_status,
  CASE WHEN observed AND k % 3 = 0 THEN '2048' ELSE '' END AS key_bits, observed AND k % 3 = 1 AS dkim_revoked,
  CASE WHEN observed THEN 27 + len(domain) + 2 + CASE WHEN spf IS NULL THEN 0 ELSE 14 + len(spf) END END::INT AS txt_apex_bytes
FROM one"""

ORACLE["inherited_policy"] = f"""WITH {facts()},
above AS (SELECT domain, arg_min(sp_effective_7489, domain) AS policy FROM facts WHERE is_apex AND dmarc_present GROUP BY domain)
SELECT f.k, f.domain, f.dmarc_present, coalesce(CASE WHEN f.dmarc_present THEN f.effective_7489 END, CASE WHEN NOT f.dmarc_present THEN a.policy END) AS applied_7489,
  NOT f.dmarc_present AND a.policy IS NOT NULL AS policy_inherited
FROM facts f LEFT JOIN above a ON f.apex = a.domain WHERE NOT f.is_apex"""

# A walk level by level; from each record the lookups it costs and the names it goes on to.
_GRAPH = rf"""graph AS ({fixture.graph_sql()}),
parts AS (SELECT *, list_slice(string_split(txt, ' '), 2, 100) AS terms FROM graph)"""
_NEXT = "list_transform(list_filter({t}, lambda x: starts_with(x, 'include:') OR (starts_with(x, 'redirect=') AND len(list_filter({t}, lambda y: ends_with(y, 'all'))) = 0)), lambda x: regexp_replace(x, '^(include:|redirect=)', ''))"
_COST = "len(list_filter({t}, lambda x: regexp_matches(x, '^(include:|a$|mx$)') OR (starts_with(x, 'redirect=') AND len(list_filter({t}, lambda y: ends_with(y, 'all'))) = 0)))"

ORACLE["spf_walk"] = f"""WITH RECURSIVE dns AS ({fixture.dns_sql()}), {_GRAPH},
walk AS (
  SELECT k AS key, list_slice(string_split(spf, ' '), 2, 100) AS terms, 'record' AS state, 0 AS level FROM dns WHERE spf IS NOT NULL
  UNION ALL
  SELECT w.key, p.terms, CASE WHEN t.name LIKE '%\\%%' ESCAPE '\\' THEN 'macro' WHEN p.state IS NULL OR p.state = 'unknown' THEN 'unobserved' WHEN p.state = 'absent' THEN 'missing' WHEN p.state = 'several' THEN 'multiple' ELSE 'record' END, w.level + 1
  FROM walk w, unnest({_NEXT.format(t="w.terms")}) AS t(name) LEFT JOIN parts p ON p.name = t.name
  WHERE w.state = 'record' AND w.level <= 11),
sums AS (
  SELECT key, sum(CASE WHEN state = 'record' THEN {_COST.format(t="terms")} ELSE 0 END) AS total, bool_or(state IN ('missing', 'multiple')) AS broken, bool_or(state IN ('macro', 'unobserved')) AS open FROM walk GROUP BY key)
SELECT key, least(total, 11)::BIGINT AS lookups, CASE WHEN total > 10 THEN true WHEN NOT open THEN false END AS exceeds,
  CASE WHEN total > 10 THEN NULL WHEN broken THEN true WHEN NOT open THEN false END AS broken_target FROM sums"""

ORACLE["redirect_chain"] = f"""WITH RECURSIVE dns AS ({fixture.dns_sql()}), {_GRAPH},
walk AS (
  SELECT k AS key, list_slice(string_split(spf, ' '), 2, 100) AS terms, true AS known, 0 AS hop FROM dns WHERE spf IS NOT NULL
  UNION ALL
  SELECT w.key, p.terms, coalesce(p.state = 'single', false) AND w.hop < 9, w.hop + 1
  FROM walk w, unnest({_NEXT.format(t="w.terms")}) AS t(name) LEFT JOIN parts p ON p.name = t.name
  WHERE w.known AND w.hop < 10 AND len(list_filter(w.terms, lambda y: ends_with(y, 'all'))) = 0 AND len(list_filter(w.terms, lambda y: starts_with(y, 'redirect='))) > 0),
ends AS (SELECT key, arg_max(terms, hop) AS terms, arg_max(known, hop) AS known FROM walk GROUP BY key)
SELECT key, CASE WHEN known THEN substr(list_filter(terms, lambda y: ends_with(y, 'all'))[1], 1, 1) END AS qualifier, known FROM ends"""

_COVER = """cover AS (SELECT *, coalesce(max(high) OVER (PARTITION BY key ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), low - 1) AS reached FROM ranges)
SELECT key, sum(greatest(high - greatest(low - 1, reached), 0))::BIGINT AS covered FROM cover GROUP BY key"""
ORACLE["address_space_union"] = f"""WITH ranges AS (SELECT l_suppkey AS key, (l_partkey * 10)::BIGINT AS low, (l_partkey * 10)::BIGINT + trunc(l_quantity)::BIGINT * 20 AS high FROM lineitem), {_COVER}"""
ORACLE["spf_address_space"] = f"""WITH dns AS ({fixture.dns_sql()}),
terms AS (SELECT k AS key, unnest(regexp_extract_all(spf, 'ip4:([0-9./]+)', 1)) AS r FROM dns),
nums AS (SELECT key, string_split(split_part(r, '/', 1), '.') AS o, coalesce(TRY_CAST(nullif(split_part(r, '/', 2), '') AS INT), 32) AS p FROM terms),
vals AS (SELECT key, ((o[1]::BIGINT * 256 + o[2]::BIGINT) * 256 + o[3]::BIGINT) * 256 + o[4]::BIGINT AS v, pow(2, 32 - p)::BIGINT AS span FROM nums),
ranges AS (SELECT key, v - v % span AS low, v - v % span + span - 1 AS high FROM vals), {_COVER}"""

ORACLE["spf_address_families"] = f"""WITH records AS (SELECT o_custkey AS key, {fixture.RANGES} AS spf FROM orders),
fours AS (SELECT key, unnest(regexp_extract_all(spf, ' [+]?ip4:([0-9./]+)', 1)) AS r FROM records),
sixes AS (SELECT key, unnest(regexp_extract_all(spf, ' ip6:([0-9a-f:/]+)', 1)) AS r FROM records),
octets AS (SELECT key, string_split(split_part(r, '/', 1), '.') AS o, coalesce(TRY_CAST(nullif(split_part(r, '/', 2), '') AS INT), 32) AS p FROM fours),
groups_ AS (SELECT key, list_transform(string_split(split_part(r, '/', 1), ':'), lambda g: ('0x' || CASE WHEN g = '' THEN '0' ELSE g END)::BIGINT) AS g, coalesce(TRY_CAST(nullif(split_part(r, '/', 2), '') AS INT), 128) AS p FROM sixes WHERE NOT contains(r, ':::')),
vals AS (
  SELECT key, 4 AS family, p, (((o[1]::BIGINT * 256 + o[2]::BIGINT) * 256 + o[3]::BIGINT) * 256 + o[4]::BIGINT)::HUGEINT AS v, pow(2, 32 - p)::HUGEINT AS span FROM octets WHERE o[4]::BIGINT < 256
  UNION ALL SELECT key, 6, p, ((g[1]::HUGEINT * 65536 + g[2]) * 65536 + g[3]) * 65536 + g[4], pow(2, 64 - least(p, 64))::HUGEINT FROM groups_),
ranges AS (SELECT key, family, p, v - v % span AS low, v - v % span + span - 1 AS high FROM vals),
cover AS (SELECT *, coalesce(max(high) OVER (PARTITION BY key, family ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), low - 1) AS reached FROM ranges),
sums AS (SELECT key, family, sum(greatest(high - greatest(low - 1, reached), 0))::BIGINT AS covered, min(p) AS widest FROM cover GROUP BY key, family)
SELECT r.key, coalesce(max(covered) FILTER (WHERE family = 4), 0)::BIGINT AS ip4_addresses, (max(widest) FILTER (WHERE family = 4))::INT AS ip4_widest_prefix,
  coalesce(max(covered) FILTER (WHERE family = 6), 0)::BIGINT AS ip6_networks, (max(widest) FILTER (WHERE family = 6))::INT AS ip6_widest_prefix
FROM (SELECT DISTINCT key FROM records) r LEFT JOIN sums s ON r.key = s.key GROUP BY r.key"""

_RULES = "rules AS (SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join("NULL" if v is None else "'" + v + "'" for v in (r["id"], r["vendor"], r.get("product"), r["category"], r["record"], r["pattern"], r["confidence"], r.get("layer") or ("platform" if r["category"] == "mail_platform" else None), r.get("engine"))) + ")"
    for r in fixture.RULES
) + ") AS t(id, vendor, product, category, record, pattern, confidence, layer, engine))"
_HITS = f"""{facts()}, {_RULES},
vals AS (
  SELECT k, 'MX' AS record, mx_hosts AS value FROM facts WHERE mx_hosts <> ''
  UNION ALL SELECT k, 'SPF_INCLUDE', unnest(string_split(includes, ',')) FROM facts WHERE includes <> ''
  UNION ALL SELECT k, 'SPF_MECHANISM', unnest(string_split(mechanisms, ' ')) FROM facts WHERE mechanisms <> ''
  UNION ALL SELECT k, 'DMARC_RUA_DOMAIN', unnest(list_distinct(rua)) FROM facts WHERE has_rua),
hits AS (SELECT v.k, v.value, r.* FROM vals v JOIN rules r ON v.record = r.record AND regexp_matches(v.value, '(?i)' || r.pattern))"""
ORACLE["rule_hits"] = f"WITH {_HITS} SELECT k, id AS rule_id, record AS record_type, value FROM hits"
ORACLE["rule_match_all_hits"] = r"""SELECT page_id, id FROM pages JOIN (VALUES ('com', '\.example\.com/'), ('lang', '/(de|fr)/\d+'), ('sub', '//(www|m|blog)\.'), ('query', '\?')) AS p(id, pattern) ON regexp_matches(url, '(?i)' || pattern)"""

_CONF = "CASE confidence WHEN 'low' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END"
_PRIO = "CASE record WHEN 'DKIM_CNAME' THEN 4 WHEN 'MX' THEN 3 WHEN 'SPF_INCLUDE' THEN 2 WHEN 'SPF_MECHANISM' THEN 2 ELSE 0 END"
_DRAFTS = f"""{_HITS},
drafts AS (
  SELECT k, category, layer, vendor, arg_max(product, (product IS NOT NULL, {_PRIO}, {_CONF}, len(pattern), id)) AS product,
    ['low', 'medium', 'high'][(least(2, max({_CONF}) + CASE WHEN count(DISTINCT CASE WHEN {_PRIO} >= 2 THEN record END) >= 2 THEN 1 ELSE 0 END) + 1)::INT] AS confidence,
    CASE WHEN count(DISTINCT engine) = 1 THEN max(engine) END AS engine, max({_PRIO}) AS strongest, count(*) AS hits, bool_or(record = 'MX') AS receiving, bool_or(record IN ('SPF_INCLUDE', 'SPF_MECHANISM', 'DKIM_CNAME')) AS sends
  FROM hits GROUP BY k, category, layer, vendor),
ranked AS (
  SELECT *, CASE WHEN layer IS NOT NULL THEN row_number() OVER (PARTITION BY k, layer ORDER BY strongest DESC, {_CONF} DESC, hits DESC, category, vendor) = 1 END AS is_layer_primary FROM drafts)"""
ORACLE["inferences"] = f"""WITH {_DRAFTS}
SELECT k, category, layer, vendor, product, confidence, engine, NULL::VARCHAR AS undetectable_reason, is_layer_primary, hits FROM ranked
UNION ALL
SELECT k, 'security_gateway', NULL, 'not_detected', NULL, 'low', NULL, CASE WHEN NOT observed THEN 'not_observed' ELSE 'api_mode_product' END, NULL, 0
FROM facts WHERE k NOT IN (SELECT k FROM ranked WHERE category = 'security_gateway')"""
ORACLE["platform_share"] = f"""WITH {_DRAFTS},
placed AS (
  SELECT r.*, f.population_id, f.entity_id, f.domain_id, coalesce(r.layer, CASE WHEN category = 'esp' AND sends THEN 'sending_service' WHEN category = 'dmarc_vendor' THEN 'dmarc_report_service' END) AS lay
  FROM ranked r JOIN facts f USING (k) WHERE coalesce(is_layer_primary, true)),
sized AS (SELECT p.*, s.n < 40 AS suppressed FROM placed p JOIN (SELECT population_id, lay, vendor, count(DISTINCT entity_id) AS n FROM placed WHERE lay IS NOT NULL GROUP BY ALL) s USING (population_id, lay, vendor)),
ident AS (SELECT population_id, lay, count(DISTINCT domain_id) AS identified_domains, count(DISTINCT entity_id) AS identified_entities FROM placed WHERE lay IS NOT NULL GROUP BY ALL),
rows_ AS (
  SELECT population_id, lay, CASE WHEN suppressed THEN 'other_suppressed' ELSE vendor END AS vendor,
    CASE WHEN NOT bool_or(suppressed) AND count(DISTINCT engine) = 1 THEN max(engine) END AS engine, count(DISTINCT entity_id) AS entities_any, count(DISTINCT domain_id) AS domains_any,
    count(DISTINCT CASE WHEN receiving THEN entity_id END) AS entities_receiving, count(DISTINCT CASE WHEN receiving THEN domain_id END) AS domains_receiving, bool_or(suppressed) AS suppressed
  FROM sized GROUP BY 1, 2, 3)
SELECT r.population_id, r.lay AS layer, vendor, engine, entities_any, domains_any, entities_receiving, domains_receiving, suppressed, identified_domains, identified_entities FROM rows_ r JOIN ident USING (population_id, lay)"""
ORACLE["vendor_share"] = f"""WITH {_DRAFTS} SELECT vendor, count(*) AS count FROM ranked WHERE category = 'security_gateway' AND coalesce(is_layer_primary, true) GROUP BY vendor"""
ORACLE["topn_with_remainder"] = r"""WITH h AS (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages),
c AS (SELECT regexp_replace(host, '^(www|m|blog)\.', '') AS registered_domain, count(*) AS count, array_to_string(list_slice(list_sort(list_distinct(list(host))), 1, 3), ',') AS examples FROM h GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY count DESC, registered_domain) AS i FROM c)
SELECT registered_domain, count, examples, NULL::BIGINT AS omitted_names FROM r WHERE i <= 10
UNION ALL SELECT NULL, (coalesce(sum(count) FILTER (i > 10), 0))::BIGINT, '', count(*) FILTER (i > 10) FROM r"""

_METRICS = {
    "total_domains": "count(*) FILTER (is_apex)",
    "observed_domains": "count(*) FILTER (is_apex AND observed)",
    "entities_with_domains": "count(DISTINCT entity_id) FILTER (is_apex)",
    "spf_adopted_entities": "count(DISTINCT entity_id) FILTER (is_apex AND spf_present)",
    "spf_adopted_domains": "count(*) FILTER (is_apex AND spf_present)",
    "dmarc_adopted_domains": "count(*) FILTER (is_apex AND dmarc_present)",
    "dmarc_enforced_entities": "count(DISTINCT entity_id) FILTER (is_apex AND enforced)",
    "dmarc_enforced_domains": "count(*) FILTER (is_apex AND enforced)",
    "dmarc_invalid_domains": "count(*) FILTER (is_apex AND dmarc_present AND coalesce(dmarc_p, '') NOT IN ('none', 'quarantine', 'reject'))",
    "dmarc_no_rua_domains": "count(*) FILTER (is_apex AND dmarc_present AND NOT has_rua)",
    "dmarc_none_no_rua_domains": "count(*) FILTER (is_apex AND dmarc_p = 'none' AND NOT has_rua)",
    "rua_placeholder_domains": "count(*) FILTER (is_apex AND dmarc_present AND has_rua)",
    "reject_with_rua_domains": "0::BIGINT",
    "nominal_reject_domains": "count(*) FILTER (is_apex AND dmarc_p = 'reject')",
    "enforced_reject_domains": "count(*) FILTER (is_apex AND policy_label = 'enforced_reject')",
    "blind_reject_domains": "count(*) FILTER (is_apex AND policy_label = 'blind_reject')",
    "sp_enforced_domains": "count(*) FILTER (is_apex AND sp_effective_7489 IN ('reject', 'quarantine'))",
    "sp_weaker_domains": "count(*) FILTER (is_apex AND sp_weaker)",
    "subdomains_measured": "count(*) FILTER (NOT is_apex)",
    "subdomains_observed": "count(*) FILTER (NOT is_apex AND observed)",
    "subdomains_with_own_dmarc": "count(*) FILTER (NOT is_apex AND dmarc_present)",
    "spf_all_fail_domains": "count(*) FILTER (is_apex AND spf_present AND spf_all_qualifier = '-')",
    "spf_all_softfail_domains": "count(*) FILTER (is_apex AND spf_present AND spf_all_qualifier = '~')",
    "spf_all_neutral_domains": "count(*) FILTER (is_apex AND spf_present AND spf_all_qualifier = '?')",
    "spf_all_missing_domains": "count(*) FILTER (is_apex AND spf_present AND spf_all_qualifier IS NULL)",
    "dmarc_historic_tags_domains": "count(*) FILTER (is_apex AND dmarc_present AND dmarc_pct IS NOT NULL)",
    "dmarc_testing_domains": "count(*) FILTER (is_apex AND dmarc_t = 'y')",
    "sending_domains": "count(*) FILTER (is_apex AND park_class = 'active_sending')",
    "parked_domains": "count(*) FILTER (is_apex AND park_class IN ('hardened_parked', 'defended_parked', 'intentional_no_send', 'neglected'))",
    "parked_hardened": "count(*) FILTER (is_apex AND park_class = 'hardened_parked')",
    "parked_neglected": "count(*) FILTER (is_apex AND park_class = 'neglected')",
    "park_defense_rate": "round(count(*) FILTER (is_apex AND park_class IN ('hardened_parked', 'defended_parked')) / nullif(count(*) FILTER (is_apex AND park_class IN ('hardened_parked', 'defended_parked', 'intentional_no_send', 'neglected')), 0)::DOUBLE, 4)",
}


def _select(names: list[str] | tuple[str, ...]) -> str:
    return ", ".join(f"{_METRICS[m]} AS {m}" for m in names)


_SHARE = "round({c} / nullif(observed_domains, 0)::DOUBLE, 4)"
ORACLE["adoption"] = f"""WITH {facts()},
m AS (SELECT population_id, {_select(("observed_domains", "spf_adopted_domains", "dmarc_adopted_domains", "dmarc_enforced_domains"))} FROM facts GROUP BY 1)
SELECT *, {_SHARE.format(c="dmarc_adopted_domains")} AS dmarc_share, {_SHARE.format(c="dmarc_enforced_domains")} AS enforced_share FROM m"""
ORACLE["stats_overall_by_segment"] = f"WITH {facts()} SELECT population_id, {_select(list(_METRICS))} FROM facts GROUP BY population_id"
ORACLE["stats_overall_evidence"] = f"""WITH {facts()},
one AS (SELECT population_id, entity_id, bool_or(mx_present) AS m, bool_or(spf_present AND (includes <> '' OR mechanisms <> '' OR rs LIKE '% ip4:%')) AS s FROM facts WHERE is_apex AND observed GROUP BY ALL),
e AS (SELECT population_id, 0::BIGINT AS evidence_signed_entities, count(*) FILTER (m AND s) AS evidence_sending_entities, count(*) FILTER (m AND NOT s) AS evidence_receiving_entities, count(*) FILTER (NOT m) AS evidence_none_entities FROM one GROUP BY 1),
g AS (SELECT population_id, count(*) FILTER (is_apex AND observed) AS n FROM facts GROUP BY 1)
SELECT e.*, n AS maturity_0, 0::BIGINT AS maturity_1, concat('{{"0":', n, ',"1":0,"2":0,"3":0,"4":0}}') AS maturity_stage_dist FROM e JOIN g USING (population_id)"""
_PLAN = """counts AS (SELECT c_mktsegment AS population_id, c_nationkey AS sector_code, count(*) AS n FROM customer GROUP BY ALL),
ranked AS (SELECT *, n < 8 AS small, count(*) FILTER (n < 8) OVER (PARTITION BY population_id) AS hidden, row_number() OVER (PARTITION BY population_id, n < 8 ORDER BY n, sector_code) AS i FROM counts),
plan AS (SELECT *, small OR (hidden = 1 AND i = 1) AS suppressed FROM ranked)"""
ORACLE["suppression_recoverable"] = f"""WITH {_PLAN}
SELECT population_id, count(*) FILTER (suppressed) AS hidden, count(*) FILTER (suppressed) = 1 OR (count(*) FILTER (suppressed) > 0 AND coalesce(sum(n) FILTER (suppressed), 0) < 8) AS recoverable FROM plan GROUP BY 1"""
_SECTOR = ("total_domains", "observed_domains", "spf_adopted_domains", "dmarc_enforced_domains")
ORACLE["stats_sector_suppressed"] = f"""WITH {facts()}, {_PLAN},
cells AS (SELECT population_id, sector_code, n, CASE WHEN suppressed THEN 'other' ELSE sector_code::VARCHAR END AS sector_label FROM plan),
sums AS (SELECT population_id, sector_label, sum(n)::BIGINT AS total_entities FROM cells GROUP BY ALL),
m AS (SELECT f.population_id, sector_label, {_select(_SECTOR)} FROM facts f JOIN cells c ON f.population_id = c.population_id AND f.sector_code = c.sector_code GROUP BY ALL)
SELECT population_id, sector_label, total_entities, {", ".join(_SECTOR)} FROM sums LEFT JOIN m USING (population_id, sector_label)"""
ORACLE["ownership_crosstab"] = """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1"""

_RANK = "CASE WHEN {c} IS NULL THEN 0 WHEN {c} = 'none' THEN 1 WHEN {c} = 'quarantine_partial' THEN 1.5 WHEN {c} = 'quarantine' THEN 2 WHEN {c} = 'reject' THEN 3 ELSE 0 END"
_STATE = "CASE WHEN {c} IS NULL THEN 'no_dmarc' WHEN {c} LIKE 'quarantine%' THEN 'quarantine' ELSE {c} END"
_OLD, _NEW = "p.effective_7489", "c.effective_7489"
_DELTA = f"""{facts(1, "f1")}, {facts(2, "f2")}, {facts(3, "f3")},
delta AS (
  SELECT coalesce(c.domain_id, p.domain_id) AS domain_id, c.k IS NOT NULL AND p.k IS NULL AS is_new, p.k IS NOT NULL AND NOT coalesce(c.observed, false) AS unobserved,
    CASE WHEN c.observed AND p.observed THEN {_STATE.format(c=_OLD)} || '>' || {_STATE.format(c=_NEW)} END AS transition,
    coalesce(c.observed AND p.observed, false) AND {_RANK.format(c=_NEW)} > {_RANK.format(c=_OLD)} AS upgraded,
    coalesce(c.observed AND p.observed, false) AND {_RANK.format(c=_NEW)} < {_RANK.format(c=_OLD)} AS downgraded,
    coalesce(c.observed AND p.observed AND c.dmarc_present AND p.dmarc_present AND c.has_rua AND NOT p.has_rua, false) AS rua_added,
    coalesce(c.observed AND p.observed AND c.dmarc_present AND p.dmarc_present AND p.has_rua AND NOT c.has_rua, false) AS rua_removed,
    coalesce(q.observed, false) AND coalesce(p.observed AND NOT p.record_present, false) AND coalesce(c.observed AND NOT c.record_present, false) AS disappeared
  FROM f3 c FULL JOIN f2 p ON c.domain_id = p.domain_id LEFT JOIN f1 q ON coalesce(c.domain_id, p.domain_id) = q.domain_id)"""
ORACLE["monthly_delta"] = f"WITH {_DELTA} SELECT * FROM delta"
ORACLE["monthly_delta_counts"] = f"""WITH {_DELTA} SELECT count(*) FILTER (is_new) AS domains_new, count(*) FILTER (unobserved) AS domains_unobserved_this_month, count(*) FILTER (upgraded) AS policy_upgraded,
  count(*) FILTER (downgraded) AS policy_downgraded, count(*) FILTER (rua_added) AS rua_added, count(*) FILTER (rua_removed) AS rua_removed, count(*) FILTER (disappeared) AS domains_disappeared FROM delta"""
ORACLE["transition_matrix"] = f"""WITH {facts(1, "p")}, {facts(2, "c")}
SELECT {_STATE.format(c=_OLD)} || '>' || {_STATE.format(c=_NEW)} AS transition, count(*) AS domains FROM c JOIN p USING (domain_id) WHERE c.observed AND p.observed GROUP BY 1"""
ORACLE["metric_changes"] = """WITH sums AS (SELECT o_orderpriority, date_trunc('month', o_orderdate)::DATE AS m, count(*) AS orders, sum(floor(o_totalprice))::BIGINT AS volume FROM orders GROUP BY ALL),
long AS (SELECT o_orderpriority, m, 'orders' AS metric, orders AS v FROM sums UNION ALL SELECT o_orderpriority, m, 'volume', volume FROM sums)
SELECT b.o_orderpriority, b.m, b.metric, b.v AS before, a.v AS after FROM long b JOIN long a ON a.o_orderpriority = b.o_orderpriority AND a.metric = b.metric AND a.m = (b.m + INTERVAL 1 MONTH)::DATE WHERE a.v <> b.v"""
_HEAD = ("total_domains", "observed_domains", "entities_with_domains", "spf_adopted_domains", "dmarc_adopted_domains", "dmarc_enforced_domains", "enforced_reject_domains", "parked_hardened", "parked_neglected")
ORACLE["headline_diff"] = f"""WITH {facts(1, "f1")}, {facts(2, "f2")},
a AS (SELECT population_id, {_select(_HEAD)} FROM f2 GROUP BY 1), b AS (SELECT population_id, {_select(_HEAD)} FROM f1 GROUP BY 1)
SELECT a.population_id, {", ".join(f"a.{m} - coalesce(b.{m}, 0) AS {m}" for m in _HEAD)}, coalesce(a.total_domains < b.total_domains, false) AS shrunk FROM a LEFT JOIN b USING (population_id)"""
ORACLE["indicator_rates"] = f"""WITH {facts()},
m AS (SELECT population_id, {_select(("observed_domains", "spf_adopted_domains", "dmarc_adopted_domains", "dmarc_enforced_domains", "subdomains_with_own_dmarc", "subdomains_observed"))} FROM facts GROUP BY 1),
r AS (SELECT population_id, 'spf' AS indicator, spf_adopted_domains AS numerator, observed_domains AS denominator FROM m UNION ALL SELECT population_id, 'dmarc', dmarc_adopted_domains, observed_domains FROM m
  UNION ALL SELECT population_id, 'enforced', dmarc_enforced_domains, observed_domains FROM m UNION ALL SELECT population_id, 'subdomains', subdomains_with_own_dmarc, subdomains_observed FROM m),
s AS (SELECT *, round(numerator / nullif(denominator, 0)::DOUBLE, 4) AS rate FROM r)
SELECT *, CASE WHEN rate >= 0.8 THEN 'high' WHEN rate < 0.5 THEN 'low' WHEN rate IS NOT NULL THEN 'middle' END AS band FROM s"""
