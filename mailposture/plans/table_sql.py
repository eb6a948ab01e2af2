"""DuckDB SQL for the queries of ``table_queries``."""

from __future__ import annotations

from mailposture.plans import fixture
from mailposture.plans.sql import ORACLE, facts

_CURVE = """counts AS (SELECT item, count(*) AS hits, row_number() OVER (ORDER BY count(*) DESC, item) AS used FROM pairs GROUP BY item),
firsts AS (SELECT domain, min(used) AS used FROM pairs JOIN counts USING (item) GROUP BY domain),
fresh AS (SELECT used, count(*) AS n FROM firsts GROUP BY used)
SELECT used::INT AS used, item, hits, coalesce(n, 0) AS new_domains, (sum(coalesce(n, 0)) OVER (ORDER BY used))::BIGINT AS cumulative_domains, coalesce(n, 0) = 0 AS dead FROM counts LEFT JOIN fresh USING (used)"""
ORACLE["saturation_curve"] = f"WITH pairs AS (SELECT DISTINCT event_type AS item, user_id AS domain FROM events), {_CURVE}"
ORACLE["saturation_orders"] = f"WITH pairs AS (SELECT DISTINCT concat('d', day(o_orderdate)) AS item, o_custkey AS domain FROM orders), {_CURVE}"

_SIDES = """s AS (SELECT role, conv_id, floor(turn / 2)::BIGINT AS pair, max(turn) < 6 AS o, max(len(text)) > 60 AS p, list_sort(list(DISTINCT sha256(text))) AS v FROM conversations WHERE role IN ('user', 'assistant') GROUP BY ALL),
kinds AS (SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.pair, b.pair) AS pair,
  CASE WHEN b.conv_id IS NULL THEN 'only_in_a' WHEN a.conv_id IS NULL THEN 'only_in_b' WHEN NOT a.o OR NOT b.o THEN 'observation_differs' WHEN a.p <> b.p THEN 'presence_differs' WHEN a.v IS DISTINCT FROM b.v THEN 'values_differ' ELSE 'agree' END AS kind
  FROM (SELECT * FROM s WHERE role = 'user') a FULL JOIN (SELECT * FROM s WHERE role = 'assistant') b ON a.conv_id = b.conv_id AND a.pair = b.pair)"""
ORACLE["method_compare"] = f"WITH {_SIDES} SELECT * FROM kinds"
ORACLE["method_compare_counts"] = f"WITH {_SIDES} SELECT kind, count(*) AS n FROM kinds GROUP BY kind"
ORACLE["plan_differences"] = """WITH p AS (SELECT DISTINCT concat_ws('|', o_orderpriority, o_orderstatus) AS purpose, o_totalprice < 2000 AS a, o_totalprice > 450000 AS b FROM orders WHERE o_totalprice < 2000 OR o_totalprice > 450000),
g AS (SELECT purpose, bool_or(a) AS a, bool_or(b) AS b FROM p GROUP BY 1)
SELECT purpose, CASE WHEN a AND b THEN 'both' WHEN a THEN 'only_a' ELSE 'only_b' END AS side FROM g"""
ORACLE["percentile_rule"] = """WITH p AS (SELECT o_orderpriority, list_sort(list(floor(o_totalprice)::BIGINT)) AS v, count(*) AS n, avg(floor(o_totalprice)) AS m FROM orders GROUP BY 1)
SELECT o_orderpriority, n, floor((v[((n - 1) // 2 + 1)::INT] + v[(n // 2 + 1)::INT]) / 2)::BIGINT AS p50, v[(floor(n * 0.9) + 1)::INT] AS p90, v[n::INT] AS max, round(m, 3) AS mean FROM p"""
ORACLE["health_by_rcode"] = "SELECT event_type AS purpose, hour(ts)::VARCHAR AS rcode, count(*) AS answers, count(*) FILTER (NOT coalesce(value > 10, false)) AS unobserved FROM events GROUP BY ALL"
ORACLE["domain_health"] = """WITH u AS (SELECT user_id, bool_and(coalesce(value > 10, false)) AS a, bool_or(coalesce(value > 10, false)) AS b FROM events GROUP BY 1)
SELECT count(*) FILTER (a) AS fully, count(*) FILTER (b AND NOT a) AS partly, count(*) FILTER (NOT b) AS none FROM u"""
ORACLE["method_statistics"] = f"""WITH dns AS ({fixture.dns_sql()}),
q AS (SELECT observed, unnest([mx IS NOT NULL, spf IS NOT NULL, dmarc IS NOT NULL, k % 3 < 2]) AS p FROM dns),
c AS (SELECT CASE WHEN NOT observed THEN 'SERVFAIL' WHEN p THEN 'NOERROR' ELSE 'NODATA' END AS rcode, observed, p AND observed AS present FROM q),
g AS (SELECT rcode, count(*) AS n FROM c GROUP BY 1)
SELECT 'base' AS method, count(*) AS records, count(*) FILTER (observed) AS observed, count(*) FILTER (present) AS record_present, (SELECT array_to_string(list(concat(rcode, '=', n) ORDER BY rcode), ',') FROM g) AS by_rcode FROM c"""
ORACLE["run_metrics"] = """WITH o AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'skipped' END AS outcome FROM orders),
f AS (SELECT concat('[', string_agg(concat('{"reason":"', o_orderpriority, '","n":', n, '}'), ',' ORDER BY o_orderpriority), ']') AS failures FROM (SELECT o_orderpriority, count(*) AS n FROM o WHERE outcome = 'failed' GROUP BY 1)),
w AS (SELECT concat('[{"warning":"LARGE","n":', count(*), ',"examples":[', array_to_string(list_slice(list_sort(list(o_orderkey)), 1, 5), ','), ']}]') AS warnings FROM o WHERE o_totalprice > 400000)
SELECT 'orders' AS phase, count(*) AS input, count(*) FILTER (outcome = 'success') AS success, count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'skipped') AS skipped, 'partial' AS status, any_value(failures) AS failures, any_value(warnings) AS warnings FROM o, f, w"""
ORACLE["acceptance_checks"] = """WITH v AS (SELECT count(*)::DOUBLE AS rows_, avg((o_orderstatus = 'F')::INT) AS f, avg((o_totalprice < 1000)::INT) AS c FROM orders)
SELECT 'rows' AS check, rows_ AS value, 1.0::DOUBLE AS low, NULL::DOUBLE AS high, rows_ >= 1 AS passed FROM v UNION ALL SELECT 'failed_share', round(f, 6), 0.3, 0.6, f >= 0.3 AND f <= 0.6 FROM v UNION ALL SELECT 'cheap_share', round(c, 6), 0.5, NULL, c >= 0.5 FROM v"""
ORACLE["phase_flow"] = """WITH y AS (SELECT year(o_orderdate)::VARCHAR AS phase, count(*) AS input, count(*) FILTER (o_orderstatus = 'F') AS success FROM orders GROUP BY 1)
SELECT phase, input, success, lag(success) OVER (ORDER BY phase) AS previous_success, lag(success) OVER (ORDER BY phase) - input AS gap FROM y WHERE phase BETWEEN '1992' AND '2002'"""
ORACLE["samples_per_class"] = "SELECT o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) <= 3"
ORACLE["last_write_wins"] = "SELECT event_id, ts, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"
ORACLE["first_row_filled"] = """SELECT min(event_id) AS event_id, user_id, arg_min(value, event_id) FILTER (value > 20) AS large FROM events GROUP BY user_id"""

ORACLE["longest_prefix"] = """WITH p AS (SELECT * FROM (VALUES ('P', 'p'), ('Part', 'part'), ('part#1', 'one'), ('part#', 'number'), ('part#12', 'twelve'), ('B', 'b')) AS t(prefix, common))
SELECT p_partkey, arg_max(common, len(prefix)) AS common FROM part LEFT JOIN p ON starts_with(concat('part#', p_partkey), prefix) GROUP BY 1"""
ORACLE["entity_diff"] = """WITH c AS (SELECT DISTINCT o_custkey AS entity_id, concat('c', o_custkey + CASE WHEN o_custkey % 4 = 0 THEN 1997 ELSE 0 END) AS name FROM orders WHERE year(o_orderdate) = 1997),
p AS (SELECT DISTINCT o_custkey AS entity_id, concat('c', o_custkey + CASE WHEN o_custkey % 4 = 0 THEN 1996 ELSE 0 END) AS name FROM orders WHERE year(o_orderdate) = 1996)
SELECT coalesce(c.entity_id, p.entity_id) AS entity_id, coalesce(c.name, p.name) AS name, CASE WHEN c.name IS NULL THEN 'delisted' WHEN p.name <> c.name THEN 'renamed' ELSE 'active' END AS status, p.name IS NULL AS is_new,
  CASE WHEN p.name IS NULL THEN DATE '1997-01-01' ELSE DATE '1995-01-01' END AS first_seen, CASE WHEN c.name IS NULL THEN DATE '1996-01-01' ELSE DATE '1997-01-01' END AS last_seen, CASE WHEN p.name <> c.name THEN p.name END AS previous_name
FROM c FULL JOIN p ON c.entity_id = p.entity_id"""
ORACLE["fill_empty"] = "SELECT c_custkey, c_nationkey AS n, coalesce(CASE WHEN c_custkey % 3 = 0 THEN 'own' END, n_name) AS n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"
ORACLE["weak_key_join"] = """WITH c AS (SELECT c_custkey, round(c_acctbal, -2)::BIGINT AS bal, c_custkey % 2 AS odd FROM customer),
s AS (SELECT round(s_acctbal, -2)::BIGINT AS bal, count(DISTINCT s_suppkey) AS n, max(concat('s', s_suppkey)) AS site, list(DISTINCT s_suppkey % 2) AS odds FROM supplier GROUP BY 1),
j AS (SELECT c_custkey, site, CASE WHEN s.bal IS NULL THEN 'no_match' WHEN n > 1 THEN 'conflict' WHEN NOT list_contains(odds, odd) THEN 'name_rejected' ELSE 'filled' END AS outcome FROM c LEFT JOIN s USING (bal))
SELECT c_custkey, CASE WHEN outcome = 'filled' THEN site END AS site, outcome FROM j"""
ORACLE["as_of_previous"] = """SELECT a.o_orderkey, arg_max(b.o_orderkey, (b.o_orderdate, b.o_orderkey)) AS previous_order FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate < a.o_orderdate GROUP BY 1"""
ORACLE["group_companies"] = """WITH l AS (SELECT DISTINCT l_partkey::VARCHAR AS name, concat('p', l_suppkey) AS parent, concat('d', l_partkey // 100) AS domain FROM lineitem),
p AS (SELECT name, count(DISTINCT parent) AS parents FROM l GROUP BY 1), s AS (SELECT parent, domain, count(DISTINCT name) AS siblings FROM l GROUP BY ALL)
SELECT name, parent, domain, CASE WHEN name IN ('7', '8') THEN 'listed_company' WHEN domain = 'd3' THEN 'listed_domain' WHEN parents > 28 THEN 'many_parents' WHEN row_number() OVER (PARTITION BY name, domain ORDER BY parent) > 1 THEN 'repeated' WHEN siblings > 2 THEN 'shared_site' END AS dropped
FROM l JOIN p USING (name) JOIN s USING (parent, domain)"""
ORACLE["latest_filing"] = "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1"
ORACLE["folded_names"] = "SELECT c_custkey, concat('the', lower(c_name)) AS folded FROM customer"
ORACLE["hashed_ids"] = f"WITH dns AS ({fixture.dns_sql()}) SELECT k, concat('d:', substr(sha256(concat_ws('|', entity_id, domain)), 1, 16)) AS id FROM dns"

ORACLE["shared_dns_only"] = """WITH d AS (SELECT concat(lang, floor(n_chars / 1000)::BIGINT) AS domain, source, doc_id % 7 < 6 AS dns FROM documents)
SELECT domain, count(DISTINCT source) AS entities FROM d GROUP BY 1 HAVING bool_and(dns) AND count(DISTINCT source) >= 2"""
ORACLE["shared_domains"] = """WITH p AS (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS domain, regexp_extract(url, '://[^/]*/([a-z]+)/', 1) AS e FROM pages)
SELECT domain, array_to_string(list_sort(list(DISTINCT e)), ',') AS entities FROM p GROUP BY 1 HAVING count(DISTINCT e) > 1"""
ORACLE["cap_per_group"] = """SELECT l_orderkey, l_linenumber, greatest(count(*) OVER (PARTITION BY l_orderkey) - 2, 0) AS left_out FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) <= 2"""
ORACLE["suffix_antijoin"] = """WITH p AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages)
SELECT * FROM p WHERE NOT (host = 'example.net' OR ends_with(host, '.example.net') OR host = 'thther.example.org' OR ends_with(host, '.thther.example.org') OR host = 'ther.example.com' OR ends_with(host, '.ther.example.com'))"""
ORACLE["registrable_hosts"] = r"""WITH p AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages)
SELECT page_id, host, nullif(regexp_extract(host, '([^.]+\.example\.(com|net|org))$', 1), '') AS registrable FROM p"""
ORACLE["candidate_union"] = f"""WITH dns AS ({fixture.dns_sql()}),
r AS (SELECT entity_id, apex AS domain, apex, CASE WHEN k % 3 = 0 THEN 'official_url' ELSE 'dmarc_rua' END AS method FROM dns UNION ALL SELECT entity_id, domain, apex, 'spf_redirect' FROM dns),
o AS (SELECT DISTINCT entity_id, apex FROM r WHERE method = 'official_url'),
u AS (SELECT entity_id, apex AS domain, method FROM r UNION SELECT r.entity_id, r.domain, r.method FROM r JOIN o USING (entity_id, apex) WHERE r.domain <> r.apex),
l AS (SELECT o.entity_id, concat(x, '.', apex) AS domain FROM o, (VALUES ('mail'), ('smtp')) AS t(x))
SELECT * FROM u UNION ALL SELECT entity_id, domain, 'common_label' FROM l WHERE (entity_id, domain) NOT IN (SELECT (entity_id, domain) FROM u)"""
ORACLE["picked_domains"] = """WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL)
SELECT user_id, event_type FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) = 1"""
ORACLE["san_siblings"] = """WITH c AS (SELECT l_orderkey AS c, concat('e', l_suppkey % 50) AS entity_id, concat('b', l_partkey % 25) AS registrable FROM lineitem),
s AS (SELECT c FROM c GROUP BY 1 HAVING count(DISTINCT registrable) <= 3)
SELECT DISTINCT entity_id, registrable FROM c SEMI JOIN s USING (c) WHERE registrable <> 'b0'"""
ORACLE["company_links"] = """WITH r AS (SELECT concat('e', o_custkey) AS entity_id, o_custkey AS e, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey // 40 * 2 ELSE o_orderkey // 4 * 2 + 1 END AS t, o_orderkey % 3 > 0 AS mx, o_orderkey % 5 > 2 AS named FROM orders),
shared AS (SELECT t FROM r GROUP BY 1 HAVING count(DISTINCT e) >= 8),
good AS (SELECT DISTINCT entity_id, concat('t', t) AS target FROM r WHERE t NOT IN (SELECT t FROM shared) AND NOT (t % 7 = 0 AND t // 7 IN (SELECT c_custkey FROM customer) AND t // 7 <> e) AND mx AND named)
SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY target) <= 15"""
ORACLE["domain_decisions"] = f"""WITH {facts()},
c AS (SELECT *, CASE WHEN NOT mx_present THEN CASE WHEN spf_all_qualifier = '-' THEN 'parked' ELSE 'unknown' END WHEN spf_present AND k % 3 = 0 THEN 'confirmed' WHEN spf_present OR dmarc_present THEN 'likely' ELSE 'unknown' END AS confidence FROM facts)
SELECT is_apex, confidence, CASE WHEN confidence = 'parked' THEN 'parked' WHEN domain = concat('c', k, '.jp.example') THEN 'primary' ELSE 'related' END AS role, CASE WHEN confidence IN ('confirmed', 'likely') THEN 'A' ELSE 'C' END AS tier,
  CASE WHEN NOT observed THEN 'primary_probe_failed' WHEN NOT is_apex AND NOT mx_present AND NOT dmarc_present THEN 'subdomain_without_own_mail' ELSE 'measured' END AS decision, count(*) AS domains
FROM c GROUP BY ALL"""
ORACLE["report_targets"] = f"""WITH {facts()}, t AS (SELECT domain, entity_id, unnest(list_distinct(rua)) AS target FROM facts WHERE has_rua)
SELECT target, count(DISTINCT domain) AS domains, count(DISTINCT entity_id) AS entities, CASE WHEN target = 'r.example' THEN 'Vendor R' END AS vendor FROM t GROUP BY target"""
_PURPOSES = """plan AS (
  SELECT domain, p AS purpose, CASE p WHEN 'mx' THEN [domain] WHEN 'spf' THEN [domain] WHEN 'dmarc' THEN ['_dmarc.' || domain]
    WHEN 'dmarc_subdomain' THEN ['_dmarc.nx-' || substr(sha256('subdomain|' || domain), 1, 12) || '.' || domain]
    WHEN 'dkim' THEN list_transform(list_distinct(list_concat(CASE WHEN mx_hosts = 'mx1.vendor-a.example' THEN ['a1', 's1'] ELSE [] END, CASE WHEN includes LIKE '%vendor-b%' THEN ['b1'] ELSE [] END, ['s1', 'default'])), lambda s: s || '._domainkey.' || domain)
    WHEN 'dkim_control' THEN ['x-' || substr(sha256('control|' || domain), 1, 12) || '._domainkey.' || domain] WHEN 'dkim_wildcard' THEN ['*._domainkey.' || domain] WHEN 'dkim_parent' THEN ['_domainkey.' || domain]
    WHEN 'mta_sts' THEN ['_mta-sts.' || domain] WHEN 'tls_rpt' THEN ['_smtp._tls.' || domain] WHEN 'bimi' THEN ['default._bimi.' || domain] ELSE CASE WHEN mx_hosts = '' THEN [] ELSE ['_25._tcp.' || mx_hosts] END END AS names
  FROM facts, unnest(CASE WHEN k % 2 = 0 THEN ['mx', 'spf', 'dmarc', 'dmarc_subdomain', 'dkim', 'dkim_control', 'dkim_wildcard', 'dkim_parent', 'mta_sts', 'tls_rpt', 'bimi', 'dane'] ELSE ['mx', 'spf', 'dmarc', 'dmarc_subdomain', 'dkim_wildcard'] END) AS u(p)
  WHERE NOT (observed AND p IN ('mx', 'spf', 'dmarc', 'dkim')))"""
ORACLE["measurement_plan"] = f"WITH {facts()}, {_PURPOSES} SELECT domain, purpose, unnest(names) AS query_name, CASE purpose WHEN 'mx' THEN 'MX' WHEN 'dane' THEN 'TLSA' ELSE 'TXT' END AS query_type FROM plan"
ORACLE["plan_volume"] = f"WITH {facts()}, {_PURPOSES} SELECT purpose, sum(len(names))::BIGINT AS queries FROM plan WHERE len(names) > 0 GROUP BY 1"

ORACLE["view_summary"] = """WITH c AS (SELECT coalesce(CASE WHEN c_custkey % 11 > 0 THEN c_mktsegment END, '(unclassified)') AS code, count(*) AS n FROM customer WHERE c_nationkey IN (1, 2, 3, 5, 8, 13) GROUP BY 1)
SELECT code, code AS label, n, round(n / sum(n) OVER ()::DOUBLE, 4) AS share, row_number() OVER (ORDER BY n DESC, code) AS place FROM c"""
ORACLE["search_rows"] = "SELECT c_custkey FROM customer WHERE c_custkey::VARCHAR ILIKE '%BUILD%' OR c_name ILIKE '%BUILD%' OR c_mktsegment ILIKE '%BUILD%' ORDER BY c_custkey LIMIT 20 OFFSET 10"
ORACLE["vocabulary_lint"] = """WITH t AS (SELECT * FROM (VALUES ('idiot', 'neutral word'), ('license', 'check the licence'), ('token =', 'secret?'), ('!!', 'less emphasis')) AS v(term, advice))
SELECT doc_id, term, advice, ((len(lower(text)) - len(replace(lower(text), term, ''))) / len(term))::BIGINT AS hits FROM documents JOIN t ON contains(lower(text), term)"""
ORACLE["unknown_streak"] = """WITH e AS (SELECT hour(ts) % 12 AS month, user_id::VARCHAR AS name FROM events),
m AS (SELECT month, month % 2 = 1 AS truncated, row_number() OVER (ORDER BY month) AS i FROM (SELECT DISTINCT month FROM e)),
c AS (SELECT name, i, count(*) AS n FROM e JOIN m USING (month) GROUP BY ALL),
g AS (SELECT *, i - row_number() OVER (PARTITION BY name ORDER BY i) AS g FROM c),
s AS (SELECT name, arg_max(n, i) AS n, min(i) AS f, max(i) AS l FROM g GROUP BY name, g)
SELECT name AS registered_domain, n AS count, l - f + 1 AS months_unknown, coalesce(m.truncated, false) AS streak_uncertain, l - f + 1 >= 3 AS is_stale FROM s LEFT JOIN m ON m.i = s.f - 1 WHERE l = (SELECT max(i) FROM m)"""
ORACLE["overdue_items"] = """SELECT CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'fixed' END AS status, count(*) FILTER (o_orderstatus = 'O' AND epoch(TIMESTAMP '1998-01-01') - epoch(o_orderdate) > 3600 * 24 * 365) AS overdue, count(*) AS items FROM orders GROUP BY 1"""
ORACLE["finding_targets"] = f"""WITH {facts()},
f AS (SELECT *, CASE WHEN observed THEN list_filter([CASE WHEN NOT spf_present THEN 'spf_absent' END, CASE WHEN spf_all_qualifier IN ('+', '?') THEN 'spf_all_permissive' END, CASE WHEN NOT dmarc_present THEN 'dmarc_absent' WHEN effective_7489 = 'none' THEN 'dmarc_none' END, CASE WHEN dmarc_present AND enforced AND NOT has_rua THEN 'dmarc_no_rua' END], lambda x: x IS NOT NULL) ELSE [] END AS x FROM facts)
SELECT domain, entity_id, concat('Company ', entity_id) AS company, array_to_string(x, ',') AS findings,
  CASE WHEN NOT observed THEN 'not_observed' WHEN domain = 'c7.jp.example' OR ends_with(domain, '.c7.jp.example') OR entity_id = 'e5' THEN 'opted_out' WHEN len(x) = 0 THEN 'no_findings' END AS skip_reason FROM f"""
ORACLE["link_domains"] = r"""SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS hosts FROM pages"""
ORACLE["title_contains"] = r"""WITH t AS (SELECT page_id, regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1) AS t FROM pages),
u AS (SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', '', 'g') AS title FROM t)
SELECT *, contains(lower(title), 'the') AS has_the FROM u"""
ORACLE["plain_text"] = r"""WITH t AS (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS plain FROM pages)
SELECT page_id, len(plain)::INT AS n, md5(plain) AS digest FROM t"""
ORACLE["domain_guesses"] = """SELECT s_suppkey, concat('acmesteel', s_suppkey, '.co.jp,acme-steel-', s_suppkey, '.co.jp,acme.co.jp,acmesteel.co.jp',
  CASE WHEN s_suppkey % 2 = 0 THEN concat(',acme-steel-', s_suppkey, '-hd.co.jp,acmesteel', s_suppkey, 'hd.co.jp,acme-steel-', s_suppkey, '-holdings.co.jp,acmesteel', s_suppkey, 'holdings.co.jp') ELSE '' END) AS guesses FROM supplier"""
ORACLE["org_domains"] = f"""WITH dns AS ({fixture.dns_sql()}), stops AS (SELECT DISTINCT apex FROM dns WHERE k % 3 = 0),
o AS (SELECT k, domain, apex AS psl, CASE WHEN apex IN (SELECT apex FROM stops) THEN apex ELSE 'jp.example' END AS walked FROM dns)
SELECT k, domain, psl AS org_domain_psl, walked AS org_domain_treewalk, psl <> walked AS org_domain_divergence FROM o"""
ORACLE["merged_identities"] = """WITH RECURSIVE r AS (
  SELECT concat('c', c_custkey) AS row_id, 0 AS rank, CASE WHEN c_custkey % 5 = 0 THEN concat('L', c_custkey % 40) END AS lei, CASE WHEN c_custkey % 7 = 0 THEN concat('K', c_custkey) END AS cik, concat('n', c_custkey % 97) AS nm, 'A' AS p FROM customer
  UNION ALL SELECT concat('s', s_suppkey), 1, CASE WHEN s_suppkey % 3 = 0 THEN concat('L', s_suppkey % 40) END, CASE WHEN s_suppkey % 2 = 0 THEN concat('K', s_suppkey) END, concat('n', s_suppkey % 97), 'B' FROM supplier),
l AS (SELECT row_id, 'lei:' || lei AS key FROM r WHERE lei IS NOT NULL UNION SELECT row_id, 'cik:' || cik FROM r WHERE cik IS NOT NULL UNION SELECT row_id, 'name:' || nm FROM r WHERE lei IS NULL AND cik IS NULL),
walk AS (SELECT row_id AS a, row_id AS b FROM r UNION SELECT w.a, y.row_id FROM walk w JOIN l x ON x.row_id = w.b JOIN l y ON y.key = x.key),
label AS (SELECT w.a AS row_id, arg_min(r.row_id, (r.rank, r.row_id)) AS label FROM walk w JOIN r ON r.row_id = w.b GROUP BY 1)
SELECT label AS row_id, arg_min(lei, (rank, r.row_id)) FILTER (lei IS NOT NULL) AS lei, arg_min(cik, (rank, r.row_id)) FILTER (cik IS NOT NULL) AS cik, arg_min(nm, (rank, r.row_id)) AS name_normalized, array_to_string(list_sort(list(DISTINCT p)), ',') AS populations, count(*) AS merged_rows
FROM r JOIN label USING (row_id) GROUP BY label"""
