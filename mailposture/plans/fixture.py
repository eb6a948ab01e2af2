"""DNS-like inputs derived from the given tables; the same SQL runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailposture.functions import records as R
from mailposture.functions.classify import park_class
from mailposture.operators import facts as facts_ops
from mailposture.operators import stats
from mailposture.session import cut

# Record strings of one domain for each customer; {m} stands for the month's shift of the DMARC branch.
DNS = """
SELECT c_custkey AS k,
 c_mktsegment AS population_id, c_nationkey AS sector_code,
 CASE WHEN c_custkey % 13 = 0 THEN concat('mail.c', c_custkey - c_custkey % 10 + 1, '.jp.example') ELSE concat('c', c_custkey, '.jp.example') END AS domain,
 concat('c', CASE WHEN c_custkey % 13 = 0 THEN c_custkey - c_custkey % 10 + 1 ELSE c_custkey END, '.jp.example') AS apex,
 concat('e', c_custkey % 701) AS entity_id,
 c_custkey % 13 <> 0 AS is_apex,
 c_custkey % 29 <> 0 AS observed,
 CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'v=spf1 -all'
  WHEN 2 THEN 'v=spf1 include:spf.vendor-a.example ~all'
  WHEN 3 THEN 'v=spf1 include:spf.vendor-b.example ip4:198.51.100.0/24 ip4:198.51.100.128/25 -all'
  WHEN 4 THEN concat('v=spf1 include:n', c_custkey % 40, '.spf.example mx -all')
  WHEN 5 THEN concat('v=spf1 redirect=n', c_custkey % 40, '.spf.example')
  ELSE 'v=spf1 mx a ?all' END AS spf,
 CASE (c_custkey + {m}) % 11 WHEN 0 THEN NULL WHEN 1 THEN 'v=DMARC1; p=none'
  WHEN 2 THEN 'v=DMARC1; p=none; rua=mailto:a@r.example!10m'
  WHEN 3 THEN 'v=DMARC1; p=quarantine; pct=50; rua=mailto:a@r.example'
  WHEN 4 THEN 'v=DMARC1; p=quarantine'
  WHEN 5 THEN 'v=DMARC1; p=reject; rua=mailto:a@r.example,mailto:b@s.example'
  WHEN 6 THEN 'v=DMARC1; p=reject; pct=10'
  WHEN 7 THEN 'V=DMARC1;P=reject;sp=none; rua=mailto:x@r.example'
  WHEN 8 THEN 'v=DMARC1; p=reject; t=y; rua=mailto:x@r.example'
  WHEN 9 THEN 'v=DMARC1; p=bogus'
  ELSE 'v=dmarc1; p=reject' END AS dmarc,
 CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '.' WHEN 2 THEN 'mx1.vendor-a.example'
  WHEN 3 THEN concat('mx.c', c_custkey, '.jp.example') ELSE concat('in', c_custkey % 9, '.vendor-c.example') END AS mx
FROM customer
"""
#: Shift of the DMARC branch in the months that queries compare; the later months miss some customers.
MONTHS = {1: ("0", "true"), 2: ("c_custkey % 3", "c_custkey % 17 <> 0"), 3: ("c_custkey % 4", "c_custkey % 19 <> 0")}

# What else is asked of each domain, beside the columns of the fixture.
EXTRAS = """
SELECT *,
 CASE k % 6 WHEN 0 THEN 'v=STSv1; id=2026' WHEN 1 THEN 'v=stsv1;id=x1' WHEN 2 THEN 'v=STSv2; id=1' END AS sts,
 CASE k % 5 WHEN 0 THEN 'v=TLSRPTv1; rua=mailto:t@r.example' WHEN 1 THEN 'v=TLSRPTv1;rua=https://x.example/t' END AS rpt,
 CASE k % 8 WHEN 0 THEN 'v=BIMI1; l=https://x.example/a.svg; a=https://x.example/a.pem' WHEN 1 THEN 'v=BIMI1; l=https://x.example/a.svg; a='
  WHEN 2 THEN 'v=BIMI1; l=; a=' END AS bimi,
 CASE k % 9 WHEN 0 THEN '3 1 1 ab' END AS tlsa,
 CASE k % 10 WHEN 0 THEN 'v=DKIM1; p=x' END AS control,
 CASE k % 12 WHEN 0 THEN 'v=DKIM1; p=' WHEN 1 THEN 'v=DKIM1; p=abc' END AS wildcard,
 CASE WHEN k % 3 < 2 THEN 'v=DKIM1; k=' END AS dkim_head,
 CASE k % 7 WHEN 3 THEN 's1.dkim.vendor-d.example.' WHEN 4 THEN 'S2.dkim.vendor-e.example' END AS cname,
 CASE k % 5 WHEN 2 THEN 'vendor-f-verification=abc' WHEN 3 THEN 'vendor-a-site=1' END AS other
FROM ({dns}) AS base
"""

# Names that SPF records refer to: forty, each with the TXT records that its number calls for.
GRAPH = """
SELECT concat('n', i, '.spf.example') AS name,
 CASE i % 8 WHEN 0 THEN 'absent' WHEN 4 THEN 'several' WHEN 6 THEN 'unknown' ELSE 'single' END AS state,
 CASE i % 8 WHEN 1 THEN 'v=spf1 -all'
  WHEN 2 THEN concat('v=spf1 include:n', (3 * i + 1) % 40, '.spf.example -all')
  WHEN 3 THEN concat('v=spf1 include:n', (i + 1) % 40, '.spf.example include:n', (i + 2) % 40, '.spf.example a mx -all')
  WHEN 4 THEN 'v=spf1 a -all'
  WHEN 5 THEN concat('v=spf1 redirect=n', (i + 5) % 40, '.spf.example')
  WHEN 7 THEN concat('v=spf1 include:%{{i}}.x.example -all') END AS txt
FROM (SELECT DISTINCT c_custkey % 40 AS i FROM customer) AS numbers
"""


def dns_sql(month: int = 1) -> str:
    """The fixture of a month as SQL over the table customer."""
    shift, keep = MONTHS[month]
    return DNS.format(m=shift) + f" WHERE {keep}"


def dns(spark: SparkSession, sf_dir: str, month: int = 1) -> DataFrame:
    """The fixture of a month as a DataFrame."""
    return _run(spark, sf_dir, dns_sql(month))


def extras_sql(month: int = 1) -> str:
    """The fixture with the other records as SQL over the table customer."""
    return EXTRAS.format(dns=dns_sql(month))


def bronze_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw answers of every purpose: beside MX, SPF, DMARC and one DKIM selector also the other records, a control
    selector, a wildcard and the parent of the selectors (which one domain in three does not answer)."""
    rows = _run(spark, sf_dir, extras_sql())
    rows = rows.withColumn("dkim", F.concat("dkim_head", F.when(F.col("k") % 3 == 0, F.concat(F.lit("rsa; p="), F.repeat(F.lit("MIIB"), 98))).otherwise(F.concat(F.lit("ed25519; p="), F.repeat(F.lit("A"), 44)))))
    one = lambda c: F.array(F.struct(F.lit("TXT").alias("type"), F.lit(300).alias("ttl"), F.array(F.substring(c, 1, 12), F.expr(f"substring({c}, 13)")).alias("data")))
    answers = {"mx": ("", "mx"), "dmarc": ("_dmarc.", "dmarc"), "dkim": ("s1._domainkey.", "dkim"), "mta_sts": ("_mta-sts.", "sts"), "tls_rpt": ("_smtp._tls.", "rpt"), "bimi": ("default._bimi.", "bimi"), "dane": ("_25._tcp.mx.", "tlsa"), "dkim_control": ("x-1._domainkey.", "control"), "dkim_wildcard": ("*._domainkey.", "wildcard")}
    none = F.array().cast("array<struct<type:string,ttl:int,data:array<string>>>")
    item = lambda purpose, prefix, found, rcode: F.struct(F.lit(purpose).alias("purpose"), F.concat(F.lit(prefix), F.col("domain")).alias("query_name"), found.alias("found"), rcode.alias("asked"))
    listed = [item(p, prefix, F.when(F.col(c).isNotNull(), one(c)).otherwise(none), F.lit("NOERROR")) for p, (prefix, c) in answers.items()]
    both = F.concat(F.when(F.col("spf").isNotNull(), one("spf")).otherwise(none), F.when(F.col("other").isNotNull(), one("other")).otherwise(none))
    listed.append(item("spf", "", both, F.lit("NOERROR")))
    listed.append(item("dkim_parent", "_domainkey.", none, F.when(F.col("k") % 3 == 0, "NXDOMAIN").when(F.col("k") % 3 == 1, "NODATA").otherwise("SERVFAIL")))
    spread = rows.select("k", "domain", "cname", "observed", F.explode(F.array(*listed)).alias("q"))
    seen = F.col("observed") & (F.col("q.asked") != "SERVFAIL")
    present = F.size("q.found") > 0
    return spread.select(
        "domain",
        "q.query_name",
        "q.purpose",
        F.lit("base").alias("method"),
        F.lit("2026-01-01 00:00:00").cast("timestamp").alias("ts"),
        F.when((F.col("q.purpose") == "spf") & (F.col("k") % 6 == 0), "tcp").otherwise("udp").alias("protocol"),
        F.when(~F.col("observed"), "SERVFAIL").when(F.col("q.asked") != "NOERROR", F.col("q.asked")).when(present, "NOERROR").otherwise("NODATA").alias("rcode"),
        seen.alias("observed"),
        F.when(seen, present).alias("record_present"),
        F.when(seen, F.col("q.found")).alias("answers"),
        F.when((F.col("q.purpose") == "dkim") & F.col("cname").isNotNull() & seen, F.array(F.lit("hop.example"), F.col("cname"))).otherwise(F.array().cast("array<string>")).alias("cname_chain"),
        F.struct(F.lit(True).alias("do"), (seen & (F.col("k") % 4 == 0)).alias("ad"), F.lit(False).alias("rrsig_present")).alias("dnssec"),
    )


#: A record of both address families for each order, the same in Spark and DuckDB.
RANGES = """concat('v=spf1 ip4:10.', o_orderkey % 200, '.', o_orderkey % 7 * 16, '.0/', 12 + o_orderkey % 21, ' +ip4:10.', o_custkey % 256, '.1.2 ip4:10.0.0.', o_orderkey % 300,
 CASE WHEN o_orderkey % 4 = 0 THEN ' mx' ELSE concat(' ip6:2001:db8:', o_orderkey % 5000, '::/', 34 + o_orderkey % 40, ' ip6:2001:db8:', o_custkey % 100, ':', o_orderkey % 3, ':1:2:3:4') END,
 ' -ip6:::/0 ip6:2001:', o_orderkey % 9, ':::1 -all')"""


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("FROM customer", "FROM {customer}"), customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))


def graph_sql() -> str:
    return GRAPH.replace("%{{i}}", "%{i}")


def graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, txts): NULL was not fetched, empty is absent."""
    rows = spark.sql(GRAPH.replace("FROM customer", "FROM {customer}"), customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))
    txts = F.when(F.col("state") == "single", F.array("txt")).when(F.col("state") == "several", F.array("txt", "txt")).when(F.col("state") == "absent", R.no_strings())
    return rows.select("name", txts.alias("txts"))


def facts(spark: SparkSession, sf_dir: str, month: int = 1) -> DataFrame:
    """Facts of the fixture: records of unobserved domains are not read."""
    rows = dns(spark, sf_dir, month)
    listed = lambda c: F.when(F.col("observed"), F.array_compact(F.array(c))).otherwise(R.no_strings())
    out = rows.withColumns({"domain_id": F.concat(F.lit("d"), F.col("k").cast("string")), "_txt": listed("spf"), "_dmarc_txt": listed("dmarc"), "_mx": listed("mx")})
    out = facts_ops.spf_columns(out, "_txt")
    for step in R.dmarc_row(F.col("_dmarc_txt")):
        out = out.withColumns(step)
    out = out.withColumns(facts_ops.mx_row(F.col("_mx"), F.when(F.col("observed"), 1).otherwise(0)))
    park = park_class(*[F.col(c) for c in ("observed", "mx_null", "mx_present", "spf_present", "dmarc_present", "spf_all_qualifier", "effective_7489")])
    out = out.withColumns({"park_class": park, "dkim_cname_targets": R.no_strings(), "verification_txt": R.no_strings(), "record_present": F.col("observed") & (F.col("spf_present") | F.col("dmarc_present"))})
    return out.select([c for c in out.columns if not c.startswith("_")])


def stored_facts(spark: SparkSession, sf_dir: str, month: int = 1) -> DataFrame:
    """Facts as inference finds them: written once, then read."""
    return cut(facts(spark, sf_dir, month))


def domain_rows(spark: SparkSession, sf_dir: str, month: int = 1) -> DataFrame:
    """Rows that the metric table reads."""
    return stats.derive_domain_row(facts(spark, sf_dir, month))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw answers behind the fixture: MX, SPF and DMARC queries and one DKIM selector of each domain."""
    rows = dns(spark, sf_dir)
    answer = lambda c: F.when(F.col(c).isNotNull(), F.array(F.struct(F.lit("TXT").alias("type"), F.lit(300).alias("ttl"), F.array(F.substring(c, 1, 12), F.expr(f"substring({c}, 13)")).alias("data"))))
    one = lambda purpose, prefix, c: F.struct(F.lit(purpose).alias("purpose"), F.concat(F.lit(prefix), F.col("domain")).alias("query_name"), answer(c).alias("answers"))
    keyed = rows.withColumn("dkim", F.when(F.col("k") % 3 == 0, F.concat(F.lit("v=DKIM1; k=rsa; p="), F.repeat(F.lit("MIIB"), 98))).when(F.col("k") % 3 == 1, F.lit("v=DKIM1; p=")))
    spread = keyed.select("domain", "observed", F.explode(F.array(one("mx", "", "mx"), one("spf", "", "spf"), one("dmarc", "_dmarc.", "dmarc"), one("dkim", "s1._domainkey.", "dkim"))).alias("q"))
    present = F.col("q.answers").isNotNull()
    return spread.select(
        "domain",
        "q.query_name",
        "q.purpose",
        F.lit("base").alias("method"),
        F.lit("2026-01-01 00:00:00").cast("timestamp").alias("ts"),
        F.lit("udp").alias("protocol"),
        F.when(F.col("observed"), F.when(present, "NOERROR").otherwise("NODATA")).otherwise("SERVFAIL").alias("rcode"),
        "observed",
        F.when(F.col("observed"), present).alias("record_present"),
        F.when(F.col("observed"), F.coalesce("q.answers", F.array().cast("array<struct<type:string,ttl:int,data:array<string>>>"))).alias("answers"),
        F.array().cast("array<string>").alias("cname_chain"),
        F.struct(F.lit(True).alias("do"), F.lit(False).alias("ad"), F.lit(False).alias("rrsig_present")).alias("dnssec"),
    )


RULES = [
    {"id": "a-mx", "vendor": "Vendor A", "product": "Mail A", "category": "mail_platform", "record": "MX", "pattern": r"(^|\.)vendor-a\.example$", "confidence": "high"},
    {"id": "a-spf", "vendor": "Vendor A", "category": "mail_platform", "record": "SPF_INCLUDE", "pattern": r"^spf\.vendor-a\.example$", "confidence": "medium"},
    {"id": "b-spf", "vendor": "Vendor B", "category": "security_gateway", "record": "SPF_INCLUDE", "pattern": r"^spf\.vendor-b\.example$", "confidence": "high", "layer": "outbound_gateway"},
    {"id": "c-mx", "vendor": "Vendor C", "category": "security_gateway", "record": "MX", "pattern": r"vendor-c\.example$", "confidence": "medium", "layer": "inbound_gateway", "engine": "engine-c"},
    {"id": "r-rua", "vendor": "Vendor R", "category": "dmarc_vendor", "record": "DMARC_RUA_DOMAIN", "pattern": r"^r\.example$", "confidence": "high"},
]

SUFFIX_RULES = ["example", "jp.example", "com", "net", "org", "co.jp", "*.ck", "!www.ck", "github.io", "example.com", "example.net", "example.org"]
