"""DuckDB SQL for the queries of ``more_queries``."""

from __future__ import annotations

from mailposture.plans import fixture
from mailposture.plans.sql import ORACLE, facts

_DNS = f"dns AS ({fixture.dns_sql()})"
# Facts beside the other records of each domain.
_X = f"""{facts()},
more AS ({fixture.extras_sql()}),
x AS (SELECT f.*, m.sts, m.rpt, m.bimi, m.tlsa, m.control, m.wildcard, m.cname, m.other, f.observed AND m.k % 3 < 2 AS detected,
  f.observed AND m.k % 10 = 0 AS suspect, f.observed AND m.k % 4 = 0 AS signed FROM facts f JOIN more m ON f.k = m.k)"""

ORACLE["facts_extras"] = f"""WITH {_X}
SELECT domain, signed AS dnssec_signed, observed AND k % 6 < 2 AS mta_sts_present, CASE WHEN observed THEN CASE k % 6 WHEN 0 THEN '2026' WHEN 1 THEN 'x1' END END AS mta_sts_id,
  observed AND k % 5 < 2 AS tls_rpt_present, CASE WHEN observed AND k % 5 = 0 THEN 'r.example' ELSE '' END AS tls_rpt_rua,
  observed AND k % 8 < 3 AS bimi_present, observed AND k % 8 < 2 AS bimi_has_svg, observed AND k % 8 = 0 AS bimi_has_vmc,
  observed AND k % 9 = 0 AS dane_present, observed AND k % 9 = 0 AND NOT signed AS dane_orphan,
  suspect AS dkim_wildcard_suspect, observed AND k % 12 = 0 AS dkim_wildcard_revoked,
  CASE WHEN NOT suspect AND observed THEN CASE k % 3 WHEN 0 THEN false WHEN 1 THEN true END END AS dkim_domainkey_exists,
  CASE WHEN detected THEN 'detected' ELSE 'not_found_in_known_selectors' END AS dkim_status, false AS dkim_testing_flag,
  CASE WHEN detected AND NOT suspect THEN k % 3 = 1 END AS dkim_ed25519_only, CASE WHEN detected THEN 's1' ELSE '' END AS dkim_selectors,
  CASE WHEN detected AND k % 3 = 0 THEN '2048' ELSE '' END AS key_bits,
  CASE WHEN observed THEN coalesce(CASE k % 7 WHEN 3 THEN 's1.dkim.vendor-d.example' WHEN 4 THEN 's2.dkim.vendor-e.example' END, '') ELSE '' END AS cnames,
  CASE WHEN observed THEN coalesce(other, '') ELSE '' END AS other_txt,
  CASE WHEN observed THEN (spf IS NOT NULL)::INT + (other IS NOT NULL)::INT END AS txt_apex_count, CASE WHEN observed THEN k % 6 = 0 END AS txt_apex_tcp,
  coalesce(has_rua, false) AS rua_external
FROM x"""

ORACLE["first_look"] = f"""WITH {facts()}
SELECT domain, observed, mx_present AS mx_exists, coalesce(mx_null, false) AS null_mx, mx_hosts, spf_present AS spf_exists, spf_all_qualifier, includes AS spf_includes,
  spf_present AS spf_aligned, dmarc_present AS dmarc_exists, CASE WHEN observed THEN '' ELSE 'MX:SERVFAIL,TXT:SERVFAIL,DMARC:SERVFAIL' END AS failures FROM facts"""
ORACLE["dkim_controls"] = f"WITH {_X} SELECT domain, suspect AS wildcard_suspect FROM x"
ORACLE["answer_states"] = """WITH p AS (SELECT page_id, ['NOERROR', 'NODATA', 'NXDOMAIN', 'SERVFAIL', 'TIMEOUT'][page_id % 5 + 1] AS rcode, page_id % 2 = 0 AS has FROM pages)
SELECT page_id, rcode, rcode IN ('NOERROR', 'NODATA', 'NXDOMAIN') AS observed, CASE WHEN rcode IN ('NOERROR', 'NODATA', 'NXDOMAIN') THEN has AND rcode <> 'NXDOMAIN' END AS record_present FROM p"""
ORACLE["sts_policies"] = """WITH s AS (SELECT s_suppkey AS k, s_suppkey % 11 > 0 AS there, ['enforce', 'testing', 'none', NULL][s_suppkey % 4 + 1] AS mode, s_suppkey % 3 > 0 AS mx, s_suppkey::BIGINT * 1000000 AS age, s_suppkey % 7 > 0 AS v FROM supplier),
p AS (SELECT *, v AND mode IS NOT NULL AND age <= 31557600 AND (mode = 'none' OR mx) AS valid FROM s)
SELECT k AS s_suppkey, CASE WHEN there THEN valid END AS valid, CASE WHEN there THEN mode END AS mode, CASE WHEN there THEN age END AS max_age,
  CASE WHEN there THEN CASE WHEN mx THEN '*.vendor.example,mail.example' ELSE '' END END AS mx,
  CASE WHEN there AND valid AND mode <> 'none' THEN k % 2 <> 0 END AS mismatch FROM p"""
ORACLE["fact_owners"] = f"""WITH {_DNS} SELECT domain, CASE WHEN k % 3 > 0 THEN entity_id ELSE 'unknown' END AS entity_id, observed FROM dns
UNION ALL SELECT domain, 'e-second', observed FROM dns WHERE k % 3 > 0 AND k % 10 = 7"""
ORACLE["measured_bronze"] = f"WITH {_DNS} SELECT domain, CASE WHEN k % 4 > 0 AND k % 2 = 0 THEN 0 ELSE 4 END::BIGINT AS rows_left_out FROM dns"
ORACLE["mx_reachability"] = rf"""WITH {facts()},
h AS (SELECT domain, mx_hosts AS host, ('0x' || substr(md5(mx_hosts), 1, 4))::INT AS n, ('0x' || substr(md5(regexp_extract(mx_hosts, '([^.]+\.jp\.example|[^.]+\.example)$', 1)), 1, 4))::INT AS o FROM facts WHERE mx_present),
s AS (SELECT *, CASE WHEN n % 5 = 2 THEN 'unknown' WHEN n % 5 = 0 THEN 'reachable' WHEN n % 5 = 1 THEN 'nxdomain' WHEN n % 7 = 2 THEN 'unknown' WHEN n % 7 = 0 THEN 'reachable' ELSE 'no_address' END AS state FROM h)
SELECT domain, CASE WHEN state = 'nxdomain' THEN host ELSE '' END AS mx_hosts_nxdomain, CASE WHEN state = 'reachable' THEN false WHEN state <> 'unknown' THEN true END AS mx_unreachable,
  CASE WHEN state = 'nxdomain' THEN CASE o % 3 WHEN 1 THEN true WHEN 2 THEN false END WHEN state <> 'unknown' THEN false END AS mx_domain_unregistered FROM s"""
ORACLE["report_permissions"] = f"""WITH {facts()},
t AS (SELECT k, domain, unnest(list_distinct(rua)) AS target FROM facts WHERE has_rua)
SELECT domain, true AS rua_external, NOT bool_or(k % 3 = 2) AS rua_authorized, CASE WHEN bool_or(target = 'r.example') THEN true END AS rua_domain_unregistered FROM t GROUP BY domain"""
ORACLE["wildcard_mx"] = f"""WITH {facts()}
SELECT domain, apex, NOT is_apex AS guessed, CASE WHEN NOT is_apex AND len(apex) % 2 = 0 THEN false ELSE mx_present END AS mx_exists, CASE WHEN len(apex) % 2 = 0 THEN true END AS wildcard_mx FROM facts"""
_NEXT = "list_transform(list_filter({t}, lambda x: starts_with(x, 'include:') OR (starts_with(x, 'redirect=') AND len(list_filter({t}, lambda y: ends_with(y, 'all'))) = 0)), lambda x: regexp_replace(x, '^(include:|redirect=)', ''))"
_COST = "len(list_filter({t}, lambda x: regexp_matches(x, '^(include:|a$|mx$)') OR (starts_with(x, 'redirect=') AND len(list_filter({t}, lambda y: ends_with(y, 'all'))) = 0)))"
ORACLE["spf_walk_whole"] = f"""WITH RECURSIVE {_DNS}, graph AS ({fixture.graph_sql()}),
parts AS (SELECT *, list_slice(string_split(txt, ' '), 2, 100) AS terms FROM graph),
walk AS (
  SELECT k AS key, list_slice(string_split(spf, ' '), 2, 100) AS terms, 'record' AS state, '' AS name, 0 AS level FROM dns WHERE spf IS NOT NULL
  UNION ALL
  SELECT w.key, p.terms, CASE WHEN contains(t.name, '%') THEN 'macro' WHEN p.state IS NULL OR p.state = 'unknown' THEN 'unobserved' WHEN p.state = 'absent' THEN 'missing' WHEN p.state = 'several' THEN 'multiple' ELSE 'record' END, t.name, w.level + 1
  FROM walk w, unnest({_NEXT.format(t="w.terms")}) AS t(name) LEFT JOIN parts p ON p.name = t.name
  WHERE w.state = 'record' AND w.level <= 11)
SELECT key, sum(CASE WHEN state = 'record' THEN {_COST.format(t="terms")} ELSE 0 END)::BIGINT AS lookups, NOT bool_or(state IN ('macro', 'unobserved')) AS complete,
  {", ".join(f"coalesce(array_to_string(list_sort(list(DISTINCT name) FILTER (state = '{s}')), ','), '') AS {s}" for s in ("missing", "multiple", "macro", "unobserved"))}
FROM walk GROUP BY key HAVING sum(CASE WHEN state = 'record' THEN {_COST.format(t="terms")} ELSE 0 END) <= 10"""

# Vendor F's text is corroborated by a CNAME of vendor D or an include of vendor B; Vendor A has rules of other kinds too.
ORACLE["ownership_texts"] = f"""WITH {_X},
f AS (SELECT k, 'esp' AS category, NULL AS layer, 'Vendor F' AS vendor, 'low' AS confidence, coalesce(mx_hosts LIKE '%vendor-c%', false) OR includes LIKE '%spf.vendor-b.example%' OR k % 7 = 3 AS corroborated, true AS only_ownership_text, 1::BIGINT AS hits
  FROM x WHERE observed AND other LIKE 'vendor-f%'),
a AS (SELECT k, observed AND rm = 'mx1.vendor-a.example' AS m, includes = 'spf.vendor-a.example' AS s, coalesce(observed AND other LIKE 'vendor-a%', false) AS t FROM x)
SELECT k, category, layer, vendor, confidence, corroborated, only_ownership_text, CASE WHEN NOT corroborated THEN k % 4 + 1 END::INT AS stale_streak_months, coalesce(NOT corroborated AND k % 4 + 1 >= 3, false) AS is_stale, hits FROM f
UNION ALL
SELECT k, 'mail_platform', 'platform', 'Vendor A', CASE WHEN t AND NOT m AND NOT s THEN 'low' WHEN m THEN 'high' ELSE CASE WHEN t THEN 'high' ELSE 'medium' END END,
  NULL, t AND NOT m AND NOT s, NULL, false, coalesce(m, false)::INT + coalesce(s, false)::INT + t::INT FROM a WHERE m OR s OR t"""
ORACLE["parked_once"] = f"WITH {facts()} SELECT park_class, count(*) AS rows FROM facts WHERE park_class IS NOT NULL GROUP BY 1"
ORACLE["vendor_summary"] = """WITH r AS (SELECT concat('l', l_linenumber % 3) AS layer, l_suppkey % 50 AS v, l_orderkey % 4000 AS e FROM lineitem),
s AS (SELECT layer, v, count(DISTINCT e) < 30 AS small FROM r GROUP BY ALL),
b AS (SELECT layer, CASE WHEN small THEN 'other' ELSE v::VARCHAR END AS label, bool_or(small) AS small, count(DISTINCT e) AS n FROM r JOIN s USING (layer, v) GROUP BY ALL)
SELECT layer, count(*) AS vendors, coalesce(sum(n) FILTER (small), 0)::BIGINT AS suppressed_entities FROM b GROUP BY 1"""
ORACLE["self_hosted_mx"] = f"WITH {facts()} SELECT k, mx_hosts = concat('mx.', apex) AND is_apex AS self_hosted FROM facts WHERE mx_hosts <> ''"
ORACLE["policy_words"] = f"""WITH {facts()} SELECT k, concat(CASE dmarc_p WHEN 'reject' THEN 'mail that fails is to be rejected' WHEN 'quarantine' THEN 'mail that fails is to be set apart' WHEN 'none' THEN 'mail that fails is to be delivered' ELSE 'no valid policy is given' END,
  '; ', CASE WHEN has_rua THEN 'aggregate reports are asked for' ELSE 'no aggregate reports are asked for' END) AS words FROM facts"""
ORACLE["domain_evidence"] = f"""WITH {facts()}
SELECT k, (CASE WHEN k % 5 = 0 THEN 4 ELSE 0 END + CASE WHEN mx_present THEN 3 ELSE 0 END + CASE WHEN spf_present THEN 2 ELSE 0 END)::INT AS count,
  concat_ws('|', CASE WHEN mx_present THEN concat('mx:3:', mx_hosts) END, CASE WHEN mx_null THEN 'null_mx:0:0 .' END, CASE WHEN spf_present THEN 'spf:2:present' END, CASE WHEN dmarc_present THEN 'dmarc:0:present' END,
    CASE k % 4 WHEN 0 THEN 'discovery:0:dmarc_rua|discovery:0:official_url' WHEN 1 THEN 'discovery:0:site_link|discovery:0:spf_include' WHEN 2 THEN 'discovery:0:guess' END, CASE WHEN NOT observed THEN 'query_failed:0:MX:SERVFAIL' END) AS parts,
  CASE k % 4 WHEN 0 THEN 'company_stated' WHEN 1 THEN 'own_dns' WHEN 2 THEN 'other' END AS ownership,
  CASE WHEN NOT mx_present THEN 'none' WHEN includes = '' THEN 'receiving' WHEN k % 5 = 0 THEN 'signed' ELSE 'sending' END AS stage FROM facts"""

ORACLE["stats_extras"] = f"""WITH {_X},
y AS (SELECT *, is_apex AND observed AS obs, observed AND k % 9 = 0 AS dane, observed AND k % 6 < 2 AS sts_on, observed AND k % 5 < 2 AS rpt_on, park_class = 'active_sending' AS sending,
  spf_present AND k % 31 <> 0 AS spf_ok, dmarc_present AND coalesce(dmarc_p IN ('none', 'quarantine', 'reject'), false) AS dmarc_ok, mx_present AND k % 23 <> 0 AS reach,
  spf_present AND (includes <> '' OR mechanisms <> '' OR rs LIKE '% ip4:%') AS sends,
  CASE WHEN observed AND NOT suspect THEN CASE k % 3 WHEN 0 THEN false WHEN 1 THEN true END END AS hint FROM x),
z AS (SELECT *, CASE WHEN NOT (spf_present AND detected AND dmarc_present) THEN 0 WHEN NOT enforced THEN 1 WHEN NOT ((sts_on OR rpt_on) AND signed) THEN 2 WHEN NOT (k % 8 = 0 OR dane) THEN 3 ELSE 4 END AS stage,
  CASE WHEN NOT reach THEN 'none' WHEN NOT sends THEN 'receiving' WHEN detected THEN 'signed' ELSE 'sending' END AS place,
  CASE k % 3 WHEN 0 THEN 'company_stated' WHEN 1 THEN 'own_dns' END AS ownership FROM y),
one AS (SELECT population_id, entity_id, bool_or(reach) AS m, bool_or(sends) AS s, bool_or(detected) AS g, bool_or(coalesce(hint, false)) AS h, count(hint) > 0 AS asked,
  bool_or(k % 2 = 0) AND NOT bool_or(k % 2 = 0 AND reach) AND bool_or(k % 2 = 1 AND reach) AS off FROM z WHERE obs GROUP BY ALL),
ev AS (SELECT population_id, CASE WHEN bool_or(asked) THEN count(*) FILTER (m AND s AND NOT g AND h) END AS evidence_dkim_hint_entities, count(*) FILTER (off) AS mail_off_site_entities FROM one GROUP BY 1),
cells AS (SELECT population_id, concat('{{', string_agg(concat('"', tier, '":{{', body, '}}'), ',' ORDER BY tier), '}}') AS dist FROM (
  SELECT population_id, tier, string_agg(concat('"', stage, '":', n), ',' ORDER BY stage) AS body FROM (
    SELECT p.population_id, t.tier, s.stage, count(z.k) AS n FROM (SELECT DISTINCT population_id FROM z WHERE obs AND ownership IS NOT NULL) p, (VALUES ('company_stated'), ('certificate'), ('own_dns'), ('web_link'), ('other')) t(tier), (VALUES ('signed'), ('sending'), ('receiving'), ('none')) s(stage)
    LEFT JOIN z ON z.obs AND z.population_id = p.population_id AND z.ownership = t.tier AND z.place = s.stage GROUP BY ALL) GROUP BY ALL) GROUP BY 1)
SELECT population_id, count(DISTINCT entity_id) FILTER (obs AND dmarc_present) AS dmarc_adopted_entities,
  count(*) FILTER (NOT is_apex AND observed AND enforced) AS subdomains_dmarc_enforced, 0 AS subdomains_inherited_policy, count(DISTINCT entity_id) FILTER (NOT is_apex) AS entities_with_subdomain_mail,
  count(*) FILTER (obs AND detected) AS dkim_detected_domains, count(*) FILTER (obs AND NOT detected) AS dkim_not_found_domains, 0 AS dkim_key_short_domains, 0 AS dkim_key_1024_domains,
  count(*) FILTER (obs AND k % 3 = 0) AS dkim_key_2048_domains, count(*) FILTER (obs AND sts_on) AS mta_sts_domains, count(*) FILTER (obs AND sts_on AND k % 12 < 6) AS mta_sts_enforce_domains,
  count(*) FILTER (obs AND sts_on AND k % 12 >= 6) AS mta_sts_testing_domains, count(*) FILTER (obs AND sts_on AND k % 4 = 3) AS mta_sts_unusable_domains, count(*) FILTER (obs AND k % 18 = 0) AS mta_sts_mx_mismatch_domains,
  count(*) FILTER (obs AND rpt_on) AS tls_rpt_domains, count(*) FILTER (obs AND dmarc_present AND has_rua) AS rua_external_domains, count(*) FILTER (obs AND dmarc_present AND has_rua AND k % 3 = 2) AS rua_unauthorized_domains,
  count(*) FILTER (obs AND dmarc_present AND has_rua AND k % 43 = 0) AS rua_unregistered_domains, count(*) FILTER (obs AND spf_present AND k % 31 = 0) AS spf_lookup_exceeded_domains,
  count(*) FILTER (obs AND spf_present AND k % 37 = 0) AS spf_target_broken_domains, CASE WHEN count(*) FILTER (obs AND spf_present) > 0 THEN count(*) FILTER (obs AND spf_present AND k % 47 = 0) END AS spf_dangling_domains,
  CASE WHEN count(*) FILTER (obs) > 0 THEN 0 END AS txt_apex_oversize_domains, CASE WHEN count(*) FILTER (obs AND detected AND NOT suspect) > 0 THEN count(*) FILTER (obs AND k % 3 = 1 AND NOT suspect) END AS dkim_ed25519_only_domains,
  NULL::BIGINT AS dkim_other_selector_domains, CASE WHEN count(*) FILTER (obs) > 0 THEN count(*) FILTER (obs AND spf_present AND k * 100 > 65536) END AS spf_ip4_broad_domains,
  CASE WHEN count(*) FILTER (obs AND spf_present) > 0 THEN count(*) FILTER (obs AND spf_present AND k % 41 = 0) END AS spf_ptr_domains, 0 AS dmarc_ruf_domains, 0 AS spf_all_pass_domains, 0 AS spf_all_unknown_domains,
  count(*) FILTER (obs AND k % 8 < 3) AS bimi_domains, count(*) FILTER (obs AND k % 8 = 0) AS bimi_vmc_domains, count(*) FILTER (obs AND signed) AS dnssec_domains,
  {", ".join(f"count(*) FILTER (obs AND stage = {i}) AS maturity_{i}" for i in range(5))}, 0 AS dmarc_np_domains,
  count(*) FILTER (obs AND sending AND spf_ok) AS bulk_spf_ok_domains, count(*) FILTER (obs AND sending AND detected) AS bulk_dkim_domains, count(*) FILTER (obs AND sending AND dmarc_ok) AS bulk_dmarc_ok_domains,
  count(*) FILTER (obs AND sending AND spf_ok AND detected AND dmarc_ok) AS bulk_ready_domains, count(*) FILTER (obs AND sending AND enforced) AS sending_enforced,
  count(*) FILTER (obs AND park_class = 'defended_parked') AS parked_defended, count(*) FILTER (obs AND park_class = 'intentional_no_send') AS parked_intentional,
  count(*) FILTER (obs AND dane) AS dane_domains, count(*) FILTER (obs AND dane AND signed) AS dane_dnssec_valid, count(*) FILTER (obs AND dane AND NOT signed) AS dane_orphan,
  any_value(ev.evidence_dkim_hint_entities) AS evidence_dkim_hint_entities, any_value(ev.mail_off_site_entities) AS mail_off_site_entities, any_value(cells.dist) AS ownership_evidence_dist
FROM z LEFT JOIN ev USING (population_id) LEFT JOIN cells USING (population_id) GROUP BY population_id"""

ORACLE["fact_orphans"] = f"""WITH {_DNS}, n AS (SELECT domain, entity_id, substr(entity_id, 2)::INT AS e FROM dns),
g AS (SELECT *, EXISTS (SELECT 1 FROM customer WHERE c_custkey % 701 = e) AND e % 3 < 2 AND e % 7 > 0 AND e % 11 <> 0 AS good FROM n)
SELECT 'all' AS population_id, count(*) AS facts FROM g WHERE good HAVING count(*) > 0 UNION ALL SELECT concat('p', e % 3), count(*) FROM g WHERE good GROUP BY 1 UNION ALL SELECT '(none)', count(*) FROM g WHERE NOT good"""
ORACLE["subdomain_cover"] = f"""WITH {facts()}, t AS (SELECT DISTINCT domain FROM facts WHERE dmarc_present)
SELECT population_id, count(*) AS subdomains_found, count(*) FILTER (apex IN (SELECT domain FROM t)) AS subdomains_found_dmarc FROM facts WHERE NOT is_apex GROUP BY 1"""
ORACLE["entity_churn"] = """WITH a AS (SELECT DISTINCT concat_ws(':', year(o_orderdate), o_custkey) AS key FROM orders), b AS (SELECT DISTINCT concat_ws(':', year(o_orderdate) + 1, o_custkey) AS key FROM orders)
SELECT key, 'came' AS what FROM a ANTI JOIN b USING (key) UNION ALL SELECT key, 'went' FROM b ANTI JOIN a USING (key)"""
ORACLE["measurement_moved"] = """WITH v AS (SELECT o_orderpriority AS p, max(o_orderkey) FILTER (year(o_orderdate) = 1996) AS a, max(o_orderkey) FILTER (year(o_orderdate) = 1995) AS b FROM orders GROUP BY 1),
m AS (SELECT o_orderstatus AS s, count(*) FILTER (year(o_orderdate) = 1996) AS a, count(*) FILTER (year(o_orderdate) = 1995) AS b FROM orders GROUP BY 1),
c AS (SELECT count(*) FILTER (a IS DISTINCT FROM b AND p[1] <> '1') AS version_changes, count(*) FILTER (a IS DISTINCT FROM b AND p[1] = '1') AS config_changes FROM v),
d AS (SELECT count(*) FILTER (a > 0 AND b > 0 AND a <> b) AS metric_changes FROM m),
now AS (SELECT DISTINCT concat(month(o_orderdate), '-', day(o_orderdate)) AS code FROM orders WHERE year(o_orderdate) = 1996), old AS (SELECT DISTINCT concat(month(o_orderdate), '-', day(o_orderdate)) AS code FROM orders WHERE year(o_orderdate) = 1995),
e AS (SELECT count(*) FILTER (old.code IS NULL) AS added, count(*) FILTER (now.code IS NULL) AS removed, count(now.code) > 0 AND count(old.code) > 0 AS known FROM now FULL JOIN old ON now.code = old.code)
SELECT version_changes, config_changes, metric_changes, version_changes + config_changes > 0 AND metric_changes > 0 AS coincide, added, removed, CASE WHEN known THEN added + removed > 0 END AS changed FROM c, d, e"""
ORACLE["measure_drilldown"] = f"""WITH {facts()}
SELECT domain, concat('Company ', entity_id) AS company, CASE WHEN spf_present THEN 'yes' ELSE 'no' END AS spf_present_label, CASE WHEN dmarc_present THEN 'yes' ELSE 'no' END AS dmarc_present_label,
  CASE WHEN mx_hosts = 'mx1.vendor-a.example' OR includes = 'spf.vendor-a.example' THEN 'Vendor A' ELSE '' END AS platform,
  CASE WHEN mx_hosts LIKE '%vendor-c.example' THEN 'Vendor C' ELSE '' END AS inbound_gateway, CASE WHEN includes = 'spf.vendor-b.example' THEN 'Vendor B' ELSE '' END AS outbound_gateway FROM facts"""
ORACLE["domain_trace"] = f"""WITH {facts()}
SELECT domain, population_id, (SELECT count(*) FROM facts g WHERE g.population_id = f.population_id AND g.sector_code = f.sector_code) AS domains,
  'dkim=NODATA,dmarc=NOERROR,mx=NOERROR,spf=NOERROR' AS answers, 'dmarc_vendor=Vendor R,mail_platform=Vendor A,security_gateway=not_detected' AS vendors
FROM facts f WHERE domain = 'c2.jp.example'"""
ORACLE["source_credits"] = """WITH c AS (SELECT DISTINCT c_mktsegment AS s FROM customer), r AS (SELECT 'registry' AS credit, 0 AS pos UNION ALL SELECT concat('list of ', s), 1 FROM c UNION ALL SELECT 'exchange', 2)
SELECT credit, row_number() OVER (ORDER BY pos, credit)::INT AS place FROM r"""
ORACLE["public_columns"] = """SELECT c AS column, (SELECT count(*) FROM customer) AS rows FROM (VALUES ('entity_id'), ('domain'), ('domain_id'), ('raw_spf'), ('raw_dmarc')) v(c)"""

ORACLE["non_operating"] = """WITH f AS (SELECT c_custkey AS k, ['6770', '6221', '6199', '6189', '6792', '7372'][k % 6 + 1] AS sic, [['10-K', 'N-CSR', 'N-2', '8-K', '485BPOS'][k % 5 + 1], ['S-1', '10-Q'][k % 2 + 1]] AS forms,
  ['Gold Trust', 'Acme Acquisition Corp', 'Blue Fund', 'Acme Acquisition II Ltd', 'Royalty Trust', 'Steel Inc', 'Index ETF'][k % 7 + 1] AS name FROM customer),
r AS (SELECT CASE WHEN sic = '6770' OR name LIKE '%Acquisition%' THEN 'spac' WHEN sic = '6221' AND regexp_matches(name, 'Trust|Fund|ETF') THEN 'commodity_trust' WHEN sic = '6199' AND regexp_matches(name, 'Fund|ETF') THEN 'commodity_trust'
  WHEN sic = '6189' OR (sic = '6792' AND name LIKE '%Trust%') THEN 'passive_trust' WHEN forms[1] = 'N-CSR' OR (forms[1] IN ('N-2', '485BPOS') AND forms[2] <> '10-Q') THEN 'registered_fund' ELSE '(operating)' END AS reason FROM f)
SELECT reason, count(*) AS filers FROM r GROUP BY 1"""
ORACLE["segment_lookup"] = """WITH c AS (SELECT CASE WHEN c_custkey % 9 > 0 THEN c_mktsegment END AS s FROM customer), m AS (SELECT s, CASE s WHEN 'BUILDING' THEN 'b' WHEN 'MACHINERY' THEN 'm' END AS code FROM c)
SELECT code, count(*) AS customers, (SELECT count(*) FROM m) AS rows, (SELECT count(*) FROM m WHERE code IS NOT NULL) AS matched, (SELECT count(*) FROM m WHERE code IS NULL AND s IS NOT NULL) AS unmatched, (SELECT count(*) FROM m WHERE s IS NULL) AS no_key FROM m GROUP BY 1"""
ORACLE["top_unmapped_labels"] = """WITH w AS (SELECT lower(regexp_extract(text, '^([A-Za-z]+)', 1)) AS label FROM documents)
SELECT label, count(*) AS rows FROM w WHERE label <> '' AND label NOT IN ('the', 'of', 'le', 'der') GROUP BY 1 ORDER BY rows DESC, label LIMIT 15"""
_ENRICHED = """n AS (SELECT s_nationkey, concat('s', lpad(min(s_suppkey)::VARCHAR, 9, '0')) AS site FROM supplier GROUP BY 1),
e AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN concat('own', c_custkey) END AS own, CASE WHEN c_custkey % 3 = 0 THEN n.site END AS nation, CASE WHEN s.s_suppkey % 2 = 0 THEN concat('s', lpad(s.s_suppkey::VARCHAR, 9, '0')) END AS key,
  CASE WHEN c_custkey % 7 < 3 THEN concat('g', c_custkey) END AS guess FROM customer LEFT JOIN n ON n.s_nationkey = c_nationkey LEFT JOIN supplier s ON s.s_suppkey = c_custkey),
enriched AS (SELECT c_custkey, coalesce(own, nation, key, guess) AS site, CASE WHEN own IS NOT NULL THEN 'own' WHEN nation IS NOT NULL THEN 'nation' WHEN key IS NOT NULL THEN 'key' WHEN guess IS NOT NULL THEN 'guess' END AS site_source FROM e)"""
ORACLE["ordered_enrichment"] = f"WITH {_ENRICHED} SELECT * FROM enriched"
ORACLE["enrichment_counts"] = f"WITH {_ENRICHED} SELECT coalesce(site_source, 'missing') AS source, count(*) AS rows FROM enriched GROUP BY 1"
ORACLE["coalesced_sources"] = """WITH o AS (SELECT o_custkey, max(year(o_orderdate))::INT AS y FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 4 = 0 THEN c_nationkey END, s_nationkey, y)::INT AS nation, CASE WHEN c_custkey % 4 = 0 THEN 'own' WHEN s_nationkey IS NOT NULL THEN 'supplier' WHEN y IS NOT NULL THEN 'orders' END AS nation_source
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN o ON o_custkey = c_custkey"""
ORACLE["preferred_sites"] = """WITH s AS (SELECT DISTINCT o_custkey AS e, concat('d', o_orderkey // 40) AS d FROM orders WHERE o_orderkey % 16 = 1),
j AS (SELECT *, count(*) OVER (PARTITION BY e) AS sites, count(*) OVER (PARTITION BY d) AS owners FROM s), n AS (SELECT e, d FROM j WHERE sites = 1 AND owners = 1),
c AS (SELECT c_custkey AS entity_id, concat('d', c_custkey % 50) AS old, d FROM customer LEFT JOIN n ON e = c_custkey)
SELECT entity_id, coalesce(d, old) AS official_domain, CASE WHEN d <> old THEN old ELSE '' END AS alt_domains FROM c"""
ORACLE["stated_fill"] = """WITH s AS (SELECT DISTINCT o_custkey AS e, concat('acme', o_orderkey % 30, '.example') AS d FROM orders UNION SELECT s_suppkey, concat('s', s_suppkey, '.example') FROM supplier),
j AS (SELECT e, d, count(*) OVER (PARTITION BY d) > 1 AS shared FROM s), b AS (SELECT e, arg_min(d, (shared, d)) AS d, min(shared) AS shared FROM j GROUP BY e)
SELECT c_custkey AS entity_id, CASE WHEN c_custkey % 6 = 0 THEN 'own.example' WHEN d IS NOT NULL AND (NOT shared OR d = concat('acme', c_custkey % 30, '.example')) THEN d END AS official_domain FROM customer LEFT JOIN b ON e = c_custkey"""
ORACLE["derived_population"] = "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT s_suppkey FROM supplier) OR c_nationkey IN (3, 7) THEN 'base,listed' ELSE 'base' END AS populations FROM customer"
ORACLE["registry_names"] = """WITH a AS (SELECT s_suppkey, concat('n', s_suppkey % 40) AS nm, concat('a', s_suppkey % 3) AS p FROM supplier),
r AS (SELECT concat('n', c_custkey % 37) AS nm, concat('a', c_custkey % 4) AS p, concat('num', c_custkey) AS number, CASE WHEN c_custkey % 5 > 0 THEN concat('u', c_custkey) END AS url FROM customer WHERE c_custkey < 60),
j AS (SELECT a.s_suppkey, count(DISTINCT number) AS n, count(DISTINCT number) FILTER (a.p = r.p) AS near, arg_max({'number': number, 'url': url}, (a.p = r.p, number)) AS best FROM a LEFT JOIN r ON a.nm = r.nm GROUP BY 1)
SELECT s_suppkey, CASE WHEN n = 0 THEN 'not_found' WHEN NOT (n = 1 OR near = 1) THEN 'ambiguous' WHEN coalesce(best.url, '') = '' THEN 'no_url' ELSE 'found' END AS outcome,
  CASE WHEN n = 1 OR near = 1 THEN best.number END AS number, CASE WHEN n = 1 OR near = 1 THEN best.url END AS url FROM j"""
ORACLE["article_sites"] = """WITH a AS (SELECT concat('t', p_partkey % 500) AS title, p_partkey % 120 AS x, p_partkey % 77 AS y, concat('d', p_partkey % 400) AS domain FROM part),
c AS (SELECT concat('e', s_suppkey) AS e, s_suppkey % 120 AS code, unnest([concat('t', s_suppkey % 500), concat('t', s_suppkey * 3 % 500)]) AS title FROM supplier),
h AS (SELECT DISTINCT e, domain FROM c JOIN a USING (title) WHERE code = x OR code = y), o AS (SELECT domain FROM h GROUP BY 1 HAVING count(DISTINCT e) = 1)
SELECT e AS entity_id, min(domain) AS domain FROM h SEMI JOIN o USING (domain) GROUP BY 1"""
ORACLE["confirmed_guesses"] = """WITH g AS (SELECT s_suppkey AS k, i, (s_suppkey * [1, 3, 7][i]) % 90 AS d FROM supplier, (VALUES (1), (2), (3)) v(i)),
j AS (SELECT k, i, d, p_partkey IS NOT NULL AS seen, coalesce(p_partkey % 5 = k % 5, false) AS ok FROM g LEFT JOIN part ON p_partkey = d AND p_partkey < 90 AND p_partkey % 2 = 0),
o AS (SELECT k, arg_min(concat('d', d), i) FILTER (ok) AS domain, bool_or(seen) AS seen FROM j GROUP BY 1)
SELECT k AS entity_id, domain, CASE WHEN domain IS NOT NULL THEN 'confirmed' WHEN seen THEN 'page_without_name' ELSE 'no_page' END AS outcome FROM o"""
ORACLE["promoted_ids"] = """WITH i AS (SELECT c_custkey AS k, CASE WHEN k % 3 = 0 THEN concat('jp:', lpad(k::VARCHAR, 13, '0')) WHEN k % 2 = 0 THEN concat('cik:', k) WHEN k % 7 = 0 THEN concat('edinet:E', k) WHEN k % 11 = 0 THEN concat('wd:Q', k) END AS old, CASE WHEN k % 5 = 0 THEN concat('lei:L', k) END AS lei FROM customer)
SELECT k AS c_custkey, coalesce(lei, old) AS entity_id, CASE WHEN lei <> old THEN old END AS is_duplicate_of FROM i"""
ORACLE["all_population"] = """SELECT count(*) AS customers, 'all' AS population FROM customer UNION ALL SELECT count(*), CASE WHEN count(*) > 0 THEN 'n3' ELSE 'mixed' END FROM customer WHERE c_nationkey = 3"""

ORACLE["candidate_measures"] = f"""WITH {_DNS}, c AS (SELECT *, ['official_url', 'ct_log', 'dmarc_rua'][k % 3 + 1] AS method FROM dns WHERE k % 5 > 0)
SELECT concat('method:', method) AS measure, count(*) AS value FROM c GROUP BY 1 UNION ALL SELECT 'unique_domains', count(DISTINCT domain) FROM c
UNION ALL SELECT 'entities_without_candidates', count(*) FROM (SELECT DISTINCT entity_id FROM dns ANTI JOIN c USING (entity_id))"""
ORACLE["domain_roles"] = f"""WITH {facts()},
c AS (SELECT *, CASE WHEN NOT mx_present THEN CASE WHEN spf_all_qualifier = '-' THEN 'parked' ELSE 'unknown' END WHEN spf_present AND k % 3 = 0 THEN 'confirmed' WHEN spf_present OR dmarc_present THEN 'likely' ELSE 'unknown' END AS confidence FROM facts)
SELECT is_apex, confidence, CASE WHEN confidence = 'parked' THEN 'parked' WHEN domain = concat('c', k, '.jp.example') THEN 'primary' ELSE 'related' END AS role, CASE WHEN confidence IN ('confirmed', 'likely') THEN 'A' ELSE 'C' END AS tier, count(*) AS domains FROM c GROUP BY ALL
UNION ALL SELECT NULL, '(companies without)', '', '', count(*) FROM (SELECT DISTINCT entity_id FROM c WHERE entity_id NOT IN (SELECT entity_id FROM c WHERE confidence = 'confirmed'))"""
ORACLE["tier_plan"] = f"""WITH {_DNS} SELECT CASE WHEN k % 2 = 0 THEN 'A' ELSE 'C' END AS tier, p AS purpose, count(*) AS queries FROM dns, unnest(CASE WHEN k % 2 = 0 THEN ['mx', 'spf', 'dmarc', 'dkim'] ELSE ['mx', 'dkim_wildcard'] END) u(p) GROUP BY ALL"""
ORACLE["mail_names"] = """WITH c AS (SELECT DISTINCT c_custkey % 50 AS e, lower(['mail', 'mx2', 'smtp-out', 'mailer', 'a.mail', 'imap.eu', 'www', 'mail.a.b', 'MX'][c_custkey % 9 + 1]) AS l FROM customer),
m AS (SELECT e, concat(l, '.c', e, '.example') AS name FROM c WHERE l IN ('mail', 'mx2', 'smtp-out', 'imap.eu', 'mx'))
SELECT concat('e', e) AS entity_id, concat('c', e, '.example') AS apex, name, greatest(count(*) OVER (PARTITION BY e) - 2, 0) AS left_out FROM m QUALIFY row_number() OVER (PARTITION BY e ORDER BY name) <= 2"""
ORACLE["placeholders"] = """WITH p AS (SELECT page_id, concat(regexp_extract(url, '://([^/?#]*)', 1), ['', '.shop.', '.Test'][page_id % 3 + 1]) AS host FROM pages)
SELECT page_id, host, CASE page_id % 3 WHEN 0 THEN regexp_matches(host, '(^|\\.)example\\.(com|net|org)$') WHEN 1 THEN false ELSE true END AS placeholder FROM p"""
ORACLE["certificate_names"] = "SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_suppkey % 20 = l_partkey % 20"

ORACLE["wide_codes"] = """SELECT c_custkey, lpad(c_custkey::VARCHAR, 4, '0')[1:4] AS code, lpad(c_custkey::VARCHAR, 13, '7') AS number, lpad(c_custkey::VARCHAR, 10, '0') AS cik, concat('www.c', c_custkey, '.example') AS host FROM customer"""
ORACLE["plain_names"] = """SELECT c_custkey, concat('a b ', lower(c_name)) AS organisation, CASE c_custkey % 3 WHEN 1 THEN concat('no site ', c_custkey) ELSE concat('c', c_custkey, '.example') END AS site_key,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'standard' WHEN 'MACHINERY' THEN 'prime' ELSE c_mktsegment END AS segment, CASE c_custkey % 3 WHEN 1 THEN NULL ELSE concat('c', c_custkey, '.example') END AS registrable FROM customer"""
ORACLE["stated_sites"] = """SELECT s_suppkey, CASE WHEN s_suppkey % 8 IN (4, 6) THEN concat('acme', s_suppkey, '.com') ELSE concat('s', s_suppkey, '.com') END AS registrable, 1 AS times FROM supplier WHERE s_suppkey % 8 IN (0, 1, 2, 3, 4, 6)"""
ORACLE["entry_redirects"] = """SELECT s_suppkey, CASE s_suppkey % 8 WHEN 0 THEN concat('https://d.example/jp/', s_suppkey, '.html') WHEN 1 THEN concat('http://www.d.example/', s_suppkey) WHEN 2 THEN concat('https://d.example/main', s_suppkey, '.html')
  WHEN 3 THEN concat('https://d.example/js/', s_suppkey) WHEN 4 THEN concat('https://d.example/r', s_suppkey) END AS target FROM supplier"""
ORACLE["sibling_domains"] = """SELECT s_suppkey, CASE s_suppkey % 5
  WHEN 0 THEN replace('acmeK-holdings.com,acmeK.co.jp,acmeK.com', 'K', s_suppkey::VARCHAR)
  WHEN 1 THEN replace('theacmeK.co.jp,acmeK.co.jp,acmeK.com', 'K', s_suppkey::VARCHAR)
  WHEN 2 THEN replace('acmeKgroup-hd.co.jp,acmeKgroup-hd.com,acmeKgroup.co.jp,acmeKgroup.com,acmeK.co.jp,acmeK.com', 'K', s_suppkey::VARCHAR)
  WHEN 3 THEN replace('acmeK.co.jp,acmeK.com', 'K', s_suppkey::VARCHAR) ELSE replace('abK.co.jp', 'K', s_suppkey::VARCHAR) END AS siblings FROM supplier"""
ORACLE["accepted_notices"] = """WITH t AS (SELECT s_suppkey % 60 AS d, count(*) AS n, min(s_suppkey) AS o FROM supplier WHERE s_suppkey % 4 = 0 GROUP BY 1),
b AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN concat('n', s_suppkey) WHEN t.d IS NULL OR (t.n = 1 AND t.o = s_suppkey) THEN concat('d', s_suppkey % 60) ELSE concat('n', s_suppkey) END AS domain FROM supplier LEFT JOIN t ON t.d = s_suppkey % 60)
SELECT concat('e', k) AS entity_id, domain, CASE WHEN k % 3 = 0 THEN 'confirmed' ELSE 'fallback' END AS outcome FROM b QUALIFY count(*) OVER (PARTITION BY domain) = 1"""
ORACLE["notice_sections"] = """SELECT s_suppkey, concat('www.s', s_suppkey, '.co.jp') AS hosts, s_suppkey % 3 = 0 AS newspaper, ['東京都', '大阪府', '京都府', NULL][s_suppkey % 4 + 1] AS prefecture, concat('株式会社子', s_suppkey) AS subsidiaries FROM supplier"""
ORACLE["wiki_fields"] = """WITH s AS (SELECT s_suppkey, lpad((s_suppkey % 9000 + 1000)::VARCHAR, 4, '0') AS c FROM supplier)
SELECT s_suppkey, concat(c, ',285A') AS codes, true AS listed, concat('https://s', c, '.example/') AS link, CASE WHEN s_suppkey % 2 = 0 THEN 'toyota' ELSE 'nippon' END AS kana, concat(c, ',', c, ' (企業)') AS titles FROM s"""
ORACLE["release_domains"] = """SELECT s_suppkey, concat('s', s_suppkey, '.com') AS registrable, 1 AS times, 0 AS pos FROM supplier UNION ALL SELECT s_suppkey, concat('news', s_suppkey, '.com'), 1, 1 FROM supplier"""
ORACLE["page_naming"] = """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey % 3 = 0 ELSE s_suppkey % 3 < 2 OR s_suppkey % 4 < 2 END AS named, s_suppkey % 2 = 0 AS english, s_suppkey % 5 <> 0 AS parent FROM supplier"""
ORACLE["decoded_pages"] = "SELECT page_id, md5(html) AS digest FROM pages"

ORACLE["bronze_round_trip"] = f"""WITH {_DNS}
SELECT concat('m', k % 2) AS method, CASE WHEN NOT observed THEN 'SERVFAIL' WHEN spf IS NULL THEN 'NODATA' ELSE 'NOERROR' END AS rcode, observed, CASE WHEN observed THEN spf IS NOT NULL END AS record_present, count(*) AS rows, max(spf) AS last_text FROM dns GROUP BY ALL"""
ORACLE["typed_round_trip"] = "SELECT o_orderstatus, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys, 0 AS later, 0 AS different FROM orders GROUP BY 1"
ORACLE["gold_months"] = """WITH m AS (SELECT o_orderpriority AS population_id, count(*) AS n, year(o_orderdate)::INT AS y FROM orders GROUP BY ALL)
SELECT population_id, n, NULL::BOOLEAN AS fresh, y AS measured_month FROM m WHERE y = 1995 OR (y = 1996 AND NOT (population_id = '1-URGENT' AND EXISTS (SELECT 1 FROM m WHERE y = 1997 AND population_id = '1-URGENT')))
UNION ALL SELECT population_id, n, true, 1996 FROM m WHERE y = 1997 AND population_id = '1-URGENT'"""
ORACLE["refreshed_extracts"] = """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 5 > 0 AND o_orderkey % 3 = 2 AND (o_orderkey % 7 > 0 OR o_orderkey % 1000 = 0) AS same FROM orders)
SELECT CASE WHEN same THEN 'kept' ELSE 'again' END AS what, count(*) AS rows, sum(k)::BIGINT AS keys FROM o GROUP BY 1"""
ORACLE["listing_round_trip"] = """SELECT c_mktsegment AS segment, count(*) AS rows, min(concat('N, ', c_custkey)) AS first_name FROM customer WHERE c_custkey % 50 > 0 GROUP BY 1
UNION ALL SELECT '(rejected)', count(*), min(concat('broken,', c_custkey)) FROM customer WHERE c_custkey % 50 = 0
UNION ALL SELECT '(registry)', count(*), min(concat('c', c_custkey, '.example')) FROM customer WHERE c_custkey % 9 > 0 AND c_custkey % 4 > 0
UNION ALL SELECT '(kind is unknown)', count(*), min(concat('c', c_custkey, '.example')) FROM customer WHERE c_custkey % 9 = 0
UNION ALL SELECT '(decided_on is no date)', count(*), min(concat('c', c_custkey, '.example')) FROM customer WHERE c_custkey % 4 = 0
UNION ALL SELECT '(mapping)', count(*), min(n_name) FROM nation
UNION ALL SELECT '(names differ)', count(*), min(concat('acme', s_suppkey % 5)) FROM supplier WHERE s_suppkey % 5 <> s_suppkey % 7"""
ORACLE["matrix_listing"] = """WITH s AS (SELECT s_suppkey % 40 AS c, ['NYSE', 'OTC', 'Nasdaq'][s_suppkey % 3 + 1] AS x, concat('N', lpad(s_suppkey::VARCHAR, 6, '0')) AS n FROM supplier),
f AS (SELECT arg_min(x, (n, x)) AS x FROM s WHERE x <> 'OTC' GROUP BY c),
b AS (SELECT l_suppkey % 25 AS c, arg_min(l_partkey % 2, l_orderkey::BIGINT * 10000000000 + l_linenumber::BIGINT * 1000000000 + l_partkey) FILTER (l_partkey % 3 > 0) AS site, count(DISTINCT CASE WHEN l_partkey % 3 > 0 THEN l_partkey % 2 END) AS n FROM lineitem GROUP BY 1)
SELECT x AS exchange, count(*) AS rows, '' AS conflicts FROM f GROUP BY 1 UNION ALL SELECT concat('company ', c), site::BIGINT, CASE WHEN n > 1 THEN 'site' ELSE '' END FROM b"""
ORACLE["stream_ingest"] = "SELECT event_type AS purpose, CASE WHEN value > 10 THEN 'NOERROR' ELSE 'SERVFAIL' END AS rcode, count(*) AS rows FROM events GROUP BY ALL"
ORACLE["stream_dedupe"] = "SELECT event_type AS purpose, count(DISTINCT user_id % 500) AS rows, count(DISTINCT user_id % 500) AS domains FROM events GROUP BY 1"
ORACLE["stream_health"] = """WITH e AS (SELECT date_trunc('hour', ts) AS h, event_type AS purpose, value FROM events), m AS (SELECT max(ts) AS last FROM events)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS hour, purpose, count(*) AS answers, count(*) FILTER (NOT coalesce(value > 10, false)) AS unobserved FROM e, m WHERE h + INTERVAL 1 HOUR <= last GROUP BY ALL"""
ORACLE["stream_streaks"] = """WITH r AS (SELECT concat('c', o_custkey % 50) AS domain, (year(o_orderdate) * 12 + month(o_orderdate))::INT AS month, max(o_orderkey) % 3 = 0 AS held FROM orders GROUP BY ALL),
g AS (SELECT *, count(*) FILTER (held) OVER (PARTITION BY domain ORDER BY month) AS block FROM r),
s AS (SELECT domain, month, count(*) FILTER (NOT held) OVER (PARTITION BY domain, block ORDER BY month) AS streak FROM g)
SELECT domain, month, streak::INT AS streak, streak >= 3 AS is_stale FROM s"""
