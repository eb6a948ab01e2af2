"""From raw answers to facts: one row a domain, and the joins that follow names (F-R19, F-C2, J1, J20, J28 to J34, W7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailposture.functions import records as R
from mailposture.functions.classify import any_true, yes
from mailposture.functions.names import registrable, suffixes
from mailposture.operators.tables import BROADCAST_ROWS, least_row, reached, short
from mailposture.session import cut

#: Names that a tree walk asks for at most, and labels from which it goes on for long names.
WALK_NAMES, WALK_LABELS = 8, 7


def build_facts(bronze: DataFrame) -> DataFrame:
    """F-R19: one row for each domain of the bronze table, with the columns of F-R2 to F-R18.

    One shuffle by domain and one list of its rows in query order, which is then read by purpose; a domain has as many
    rows as its measurement plan has queries. NULL stays "not known".
    """
    seen = yes(F.col("observed"))
    row = F.struct(
        "purpose",
        "query_name",
        "ts",
        F.transform("answers", lambda a: R.join_chunks(a["data"])).alias("v"),
        F.when(F.col("purpose") == "spf", F.transform("answers", lambda a: a["data"])).alias("chunks"),
        "protocol",
        F.element_at(F.when(F.size("cname_chain") > 0, F.col("cname_chain")), -1).alias("cname"),
        seen.alias("seen"),
        (seen & yes(F.col("record_present"))).alias("present"),
    )
    is_purpose = lambda p: F.col("purpose") == p
    grouped = bronze.groupBy("domain").agg(
        F.coalesce(F.bool_or("observed"), F.lit(False)).alias("observed"),
        F.bool_or("record_present").alias("_present"),
        F.coalesce(F.bool_or(seen & yes(F.col("dnssec.ad"))), F.lit(False)).alias("dnssec_signed"),
        F.coalesce(F.bool_or(is_purpose("dkim_control") & yes(F.col("record_present"))), F.lit(False)).alias("dkim_wildcard_suspect"),
        F.bool_or(F.when(is_purpose("dkim_parent") & seen, F.when(F.col("rcode") == "NXDOMAIN", False).when(F.col("rcode").isin("NOERROR", "NODATA"), True))).alias("_domainkey"),
        F.array_sort(F.collect_list(row)).alias("_rows"),
    )
    rows_of = lambda p: F.filter("_rows", lambda r: r["purpose"] == p)
    texts = lambda p: F.flatten(F.transform(F.filter("_rows", lambda r: (r["purpose"] == p) & r["seen"] & r["v"].isNotNull()), lambda r: r["v"]))
    first = lambda r: F.when(r["present"], F.get(r["v"], 0))
    key = lambda r: F.struct(F.substring_index(r["query_name"], "._domainkey.", 1).alias("selector"), first(r).alias("txt"), r["cname"].alias("cname"))
    names = {"_mx": "mx", "_txt": "spf", "_dmarc_txt": "dmarc", "_sts": "mta_sts", "_rpt": "tls_rpt", "_bimi": "bimi", "_tlsa": "dane"}
    grouped = grouped.withColumns(
        {
            **{c: texts(p) for c, p in names.items()},
            "_n_mx": F.size(rows_of("mx")),
            "_keys": F.array_sort(F.transform(rows_of("dkim"), key)),
            "_wildcard": F.array_max(F.transform(rows_of("dkim_wildcard"), first)),
            "_apex": F.get(F.filter("_rows", lambda r: (r["purpose"] == "spf") & r["seen"]), 0),
        }
    )
    out = grouped.withColumns({"record_present": F.when(F.col("observed"), F.coalesce("_present", F.lit(False))), **mx_row(F.col("_mx"), F.col("_n_mx"))})
    out = spf_columns(out, "_txt")
    for step in R.dmarc_row(F.col("_dmarc_txt")):
        out = out.withColumns(step)
    out = out.withColumns(R.extras_row(F.col("_sts"), F.col("_rpt"), F.col("_bimi")))
    out = out.withColumns(
        {
            "verification_txt": R.other_txt(F.col("_txt")),
            "txt_apex_count": F.size("_apex.chunks"),
            "txt_apex_bytes": F.when(F.col("_apex").isNotNull(), R.txt_bytes(F.col("domain"), F.coalesce("_apex.chunks", F.array().cast("array<array<string>>")))),
            "txt_apex_tcp": F.col("_apex.protocol") == "tcp",
            "dane_present": F.size("_tlsa") > 0,
            "dane_orphan": R.dane_orphan(F.col("_tlsa"), F.col("dnssec_signed")),
            "rua_external": F.exists("dmarc_rua", lambda d: d != F.lower(R.no_dot(F.col("domain")))),
        }
    )
    out = dkim_columns(out)
    return out.select([c for c in out.columns if not c.startswith("_")])


def first_look(bronze: DataFrame) -> DataFrame:
    """F-C2: the probe row of each domain from its MX, TXT (purpose spf) and DMARC answers: (domain, observed,
    mx_exists, null_mx, mx_hosts, spf_exists, spf_all_qualifier, spf_includes, spf_aligned, dmarc_exists, failures).

    ``observed`` is false if MX or TXT could not be asked; a failed DMARC question is a failure, but not that. What was
    never asked counts as not answered. A null MX receives nothing, so there is no MX then; of several SPF records the
    first is read.
    """
    values = F.transform("answers", lambda a: R.join_chunks(a["data"]))
    row = F.struct(yes(F.col("observed")).alias("ok"), F.coalesce("rcode", F.lit("UNKNOWN")).alias("rcode"), F.coalesce(values, R.no_strings()).alias("v"))
    asked = {"mx": "MX", "spf": "TXT", "dmarc": "DMARC"}
    last = [F.max_by(F.when(F.col("purpose") == p, row), F.when(F.col("purpose") == p, F.struct("ts", "query_name"))).alias(f"_{p}") for p in asked]
    out = bronze.filter(F.col("purpose").isin(list(asked))).groupBy("domain").agg(*last)
    ok = {p: yes(F.col(f"_{p}.ok")) for p in asked}
    failed = [F.when(~ok[p], F.concat(F.lit(f"{name}:"), F.coalesce(f"_{p}.rcode", F.lit("not_asked")))) for p, name in asked.items()]
    read = lambda p: F.when(ok[p], F.col(f"_{p}.v")).otherwise(R.no_strings())
    out = out.withColumns({"_records": F.filter(read("spf"), R.is_spf), "null_mx": R.null_mx(read("mx")), "mx_hosts": R.mx_hosts(read("mx"))})
    terms = R.spf_terms(F.get("_records", F.lit(0)))
    return out.select(
        "domain",
        (ok["mx"] & ok["spf"]).alias("observed"),
        ((F.size("mx_hosts") > 0) & ~F.col("null_mx")).alias("mx_exists"),
        yes(F.col("null_mx")).alias("null_mx"),
        "mx_hosts",
        (F.size("_records") > 0).alias("spf_exists"),
        R.all_qualifier(terms).alias("spf_all_qualifier"),
        R.spf_includes(terms).alias("spf_includes"),
        (F.size("_records") > 0).alias("spf_aligned"),
        (F.size(F.filter(read("dmarc"), R.is_dmarc)) > 0).alias("dmarc_exists"),
        F.array_compact(F.array(*failed)).alias("failures"),
    )


def mx_row(values: Column, n: Column) -> dict[str, Column]:
    """F-R17: MX columns; ``mx_null`` is NULL where MX was not asked for."""
    return {"mx_hosts": R.mx_hosts(values), "mx_present": (F.size(R.mx_hosts(values)) > 0) & ~R.null_mx(values), "mx_null": F.when(n > 0, R.null_mx(values))}


def spf_columns(df: DataFrame, txts: str) -> DataFrame:
    """Add the columns of F-R6 from a column of TXT strings."""
    columns = R.spf_row(F.col(txts))
    return df.withColumn("_spf", columns.pop("_spf")).withColumns(columns)


def dkim_columns(df: DataFrame) -> DataFrame:
    """F-R13, J34: three-valued DKIM result from ``_keys`` (selector, txt, cname) and ``_wildcard``."""
    keyed = df.withColumns(
        {
            "_found": F.transform(F.filter("_keys", lambda k: k["txt"].isNotNull()), lambda k: F.struct(k["selector"].alias("selector"), R.dkim_key(k["txt"]).alias("key"))),
            "_star": F.when(F.col("_wildcard").isNotNull(), R.dkim_key(F.col("_wildcard"))),
        }
    )
    live = F.filter("_found", lambda k: k["key"]["valid"] & ~k["key"]["revoked"])
    suspect = F.col("dkim_wildcard_suspect")
    return keyed.withColumns(
        {
            "dkim_status": F.when(F.size("_keys") == 0, "not_applicable").when(F.size(live) > 0, "detected").otherwise("not_found_in_known_selectors"),
            "dkim_selectors": F.transform(live, lambda k: k["selector"]),
            "dkim_key_bits": F.array_compact(F.transform(live, lambda k: k["key"]["key_bits"])),
            "dkim_testing_flag": F.exists("_found", lambda k: k["key"]["testing"]),
            "dkim_revoked": F.exists("_found", lambda k: k["key"]["revoked"]),
            "dkim_cname_targets": F.array_sort(F.array_distinct(F.filter(F.transform("_keys", lambda k: F.lower(R.no_dot(R.strip(k["cname"])))), lambda c: c != ""))),
            "dkim_wildcard_revoked": yes(F.col("_star.revoked")),
            "dkim_ed25519_only": F.when((F.size(live) > 0) & ~suspect, F.forall(live, lambda k: k["key"]["key_type"] == "ed25519")),
            "dkim_domainkey_exists": F.when(~suspect, F.col("_domainkey")),
        }
    )


def fan_out(facts: DataFrame, domains: DataFrame) -> DataFrame:
    """One fact for each owner of a domain; unowned domains get the owner ``unknown``."""
    owners = domains.select("domain", "domain_id", "entity_id", "is_apex").distinct()
    return facts.join(owners, "domain", "left").withColumn("entity_id", F.coalesce("entity_id", F.lit("unknown")))


def restrict_to_measured(bronze: DataFrame, domains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of domains that are measured, and counts of the others' rows by domain."""
    measured = domains.filter(yes(F.col("is_measured"))).select("domain").distinct()
    return bronze.join(measured, "domain", "left_semi"), bronze.join(measured, "domain", "left_anti").groupBy("domain").agg(F.count("*").alias("rows_left_out"))


def inherit_policy(facts: DataFrame, parent: str = "registrable") -> DataFrame:
    """Add applied_7489 and policy_inherited: the own policy, else what the parent says for its subdomains."""
    above = facts.filter("is_apex and dmarc_present").groupBy(F.col("domain").alias("_p")).agg(F.min_by("sp_effective_7489", "domain").alias("_policy"))
    joined = facts.join(above, (F.col(parent) == F.col("_p")) & ~F.col("is_apex") & ~yes(F.col("dmarc_present")), "left")
    own = F.when(yes(F.col("dmarc_present")), F.col("effective_7489"))
    return joined.withColumns({"applied_7489": F.coalesce(own, "_policy"), "policy_inherited": own.isNull() & F.col("_policy").isNotNull()}).drop("_p", "_policy")


# ---------------------------------------------------------------- walks over names


def spf_walk(start: DataFrame, names: DataFrame, key: str = "key", record: str = "raw_spf") -> DataFrame:
    """Lookups of a whole SPF evaluation: (key, lookups, complete, missing, multiple, macro, unobserved,
    exceeds, broken_target).

    ``names`` has (name, txts): NULL txts were not fetched, a missing name counts as not fetched too. Records are
    read level by level in the order of the terms; the budget of ten is shared by all of them, so a level has ten
    targets a key at most and eleven levels end every walk, loops included. ``exceeds`` and ``broken_target`` are
    NULL where a part could not be seen. Each level is cut off in the checkpoint folder.
    """
    lookup = least_row(names.select(F.col("name").alias("target"), "txts"), ["target"])
    level = start.select(F.col(key).alias("key"), F.col(record).alias("record"), F.lit("").alias("path"), F.lit(0).cast("long").alias("before")).filter("record is not null")
    seen = None
    for _ in range(R.MAX_LOOKUPS + 1):
        terms = R.spf_terms(F.col("record"))
        order = Window.partitionBy("key").orderBy("path")
        level = level.withColumn("terms", terms).withColumn("upto", F.col("before") + F.sum(R.own_lookups(F.col("terms"))).over(order))
        level = level.withColumn("total", F.max("upto").over(Window.partitionBy("key")))
        targets = F.concat(R.spf_includes(F.col("terms")), F.array_compact(F.array(R.spf_redirect(F.col("terms")))))
        spread = level.filter(F.col("upto") <= R.MAX_LOOKUPS).select("key", "path", "total", F.posexplode(targets).alias("pos", "target"))
        met = spread.join(lookup, "target", "left").withColumn("found", F.filter("txts", R.is_spf))
        n = F.size("found")
        state = F.when(F.col("target").contains("%"), "macro").when(F.col("txts").isNull(), "unobserved").when(n == 0, "missing").when(n > 1, "multiple").otherwise("record")
        met = cut(met.select("key", "total", "target", state.alias("state"), F.get("found", 0).alias("record"), F.concat("path", F.format_string("%03d", "pos")).alias("path")))
        stop = F.min(F.when(F.col("upto") > R.MAX_LOOKUPS, F.col("upto")))
        counted = level.groupBy("key").agg(F.coalesce(stop, F.max("upto")).alias("lookups"), F.lit(None).cast("string").alias("state"), F.lit(None).cast("string").alias("target"))
        here = counted.unionByName(met.filter("state <> 'record'").select("key", F.lit(None).cast("long").alias("lookups"), "state", "target"))
        seen = cut(here if seen is None else seen.unionByName(here))
        level = met.filter((F.col("state") == "record") & (F.col("total") <= R.MAX_LOOKUPS)).select("key", "record", "path", F.col("total").alias("before"))
        if level.isEmpty():
            break
    list_of = lambda s: F.array_sort(F.array_distinct(F.collect_list(F.when(F.col("state") == s, F.col("target"))))).alias(s)
    out = seen.groupBy("key").agg(F.max("lookups").alias("lookups"), *[list_of(s) for s in ("missing", "multiple", "macro", "unobserved")])
    out = out.withColumn("complete", (F.size("macro") == 0) & (F.size("unobserved") == 0))
    verdict = lambda bad: F.when(bad, True).when(F.col("complete"), False)
    return out.withColumns({"exceeds": verdict(F.col("lookups") > R.MAX_LOOKUPS), "broken_target": verdict((F.size("missing") > 0) | (F.size("multiple") > 0))})


def effective_all(start: DataFrame, names: DataFrame, key: str = "key", record: str = "raw_spf", hops: int = R.MAX_LOOKUPS) -> DataFrame:
    """(key, qualifier, known): the ``all`` that counts in the end, through redirects."""
    lookup = least_row(names.select(F.col("name").alias("target"), "txts"), ["target"])
    level = start.select(F.col(key).alias("key"), F.col(record).alias("record")).filter("record is not null")
    done = None
    for hop in range(hops + 1):
        terms = R.spf_terms(F.col("record"))
        level = level.select("key", R.all_qualifier(terms).alias("qualifier"), R.spf_redirect(terms).alias("target"))
        ends = level.filter(F.col("qualifier").isNotNull() | F.col("target").isNull()).select("key", "qualifier", F.lit(True).alias("known"))
        on = level.filter(F.col("qualifier").isNull() & F.col("target").isNotNull()).join(lookup, "target", "left").withColumn("found", F.filter("txts", R.is_spf))
        goes = F.coalesce((F.size("found") == 1) & ~F.col("target").contains("%"), F.lit(False)) & F.lit(hop < hops - 1)
        met = cut(on.select("key", F.get("found", 0).alias("record"), goes.alias("goes")))
        lost = met.filter("not goes").select("key", F.lit(None).cast("string").alias("qualifier"), F.lit(False).alias("known"))
        here = ends.unionByName(lost)
        done = cut(here if done is None else done.unionByName(here))
        level = met.filter("goes").select("key", "record")
        if level.isEmpty():
            break
    return done


def walk_names(domain: Column) -> Column:
    """Names that a tree walk asks for: the domain and its parents, never the last label alone."""
    names = suffixes(R.no_dot(F.lower(R.strip(domain))))
    n = F.size(names)
    long = F.concat(F.slice(names, 1, 1), F.slice(names, n - WALK_LABELS + 1, WALK_LABELS - 1))
    return F.slice(F.when(n > WALK_NAMES, long).otherwise(F.slice(names, 1, F.greatest(n - 1, F.lit(0)))), 1, WALK_NAMES)


def org_domain(df: DataFrame, answers: DataFrame, rules: DataFrame, domain: str = "domain") -> DataFrame:
    """Add org_domain_psl, org_domain_treewalk and org_domain_divergence (NULL without a tree-walk result).

    ``answers`` has (name, txts) of ``_dmarc.`` names. The walk stops at the first record with ``psd=y`` or ``n``.
    """
    names = df.select(F.col(domain).alias("_d")).distinct().select("_d", F.posexplode(walk_names(F.col("_d"))).alias("_i", "_n"))
    record = F.get(F.filter("txts", R.is_dmarc), 0)
    stops = answers.filter(F.lower(R.tag(record, "psd")).isin("y", "n")).select(F.regexp_replace("name", r"^_dmarc\.", "").alias("_n"))
    walked = names.join(stops.distinct(), "_n", "left_semi").groupBy("_d").agg(F.min_by("_n", "_i").alias("org_domain_treewalk"))
    out = registrable(df, domain, rules, "org_domain_psl").join(walked, F.col(domain) == F.col("_d"), "left").drop("_d")
    differs = F.coalesce("org_domain_psl", F.lit("")) != F.col("org_domain_treewalk")
    return out.withColumn("org_domain_divergence", F.when(F.col("org_domain_treewalk").isNotNull(), differs))


def rua_checks(facts: DataFrame, answers: DataFrame, rules: DataFrame) -> DataFrame:
    """(domain, rua_external, rua_authorized, rua_domain_unregistered) for domains with external report targets.

    ``answers`` has (name, qtype, observed, record_present, rcode). A target is unauthorised if its permission record
    was asked for and is not there; unregistered only if its registrable domain is known not to exist, NULL if that
    could not be asked.
    """
    spread = facts.select("domain", F.explode(F.array_distinct("dmarc_rua")).alias("target")).filter(F.col("target") != F.lower(R.no_dot("domain")))
    spread = registrable(spread, "target", rules, "owner").withColumn("owner", F.coalesce("owner", "target"))
    asked = lambda qtype, p: answers.filter(F.col("qtype") == qtype).select(*[F.col(c).alias(f"{p}_{c}") for c in ("name", "observed", "record_present", "rcode")])
    permit, ns = asked("TXT", "t"), asked("NS", "n")
    name = F.concat(R.no_dot("domain"), F.lit("._report._dmarc."), R.no_dot("target"))
    joined = spread.join(permit, name == F.col("t_name"), "left").join(ns, F.col("owner") == F.col("n_name"), "left")
    refused = yes(F.col("t_observed")) & ~yes(F.col("t_record_present"))
    gone = F.when(yes(F.col("n_observed")), F.col("n_rcode") == "NXDOMAIN")
    return joined.groupBy("domain").agg(F.lit(True).alias("rua_external"), (~F.bool_or(refused)).alias("rua_authorized"), any_true(F.collect_list(F.struct(gone.alias("g")))["g"]).alias("rua_domain_unregistered"))


def mx_reach(facts: DataFrame, answers: DataFrame, rules: DataFrame) -> DataFrame:
    """(domain, mx_hosts_nxdomain, mx_unreachable, mx_domain_unregistered), each set only where it is certain."""
    spread = facts.filter(yes(F.col("mx_present"))).select("domain", F.explode("mx_hosts").alias("host"))
    spread = registrable(spread, "host", rules, "owner").withColumn("owner", F.coalesce("owner", "host"))
    asked = lambda qtype, p: answers.filter(F.col("qtype") == qtype).select(*[F.col(c).alias(f"{p}_{c}") for c in ("name", "observed", "record_present", "rcode")])
    a, aaaa, ns = asked("A", "a"), asked("AAAA", "q"), asked("NS", "n")
    joined = spread.join(a, F.col("host") == F.col("a_name"), "left").join(aaaa, F.col("host") == F.col("q_name"), "left").join(ns, F.col("owner") == F.col("n_name"), "left")
    state = (
        F.when(~yes(F.col("a_observed")), "unknown")
        .when(yes(F.col("a_record_present")), "reachable")
        .when(F.col("a_rcode") == "NXDOMAIN", "nxdomain")
        .when(~yes(F.col("q_observed")), "unknown")
        .when(yes(F.col("q_record_present")), "reachable")
        .otherwise("no_address")
    )
    gone = F.when(yes(F.col("n_observed")), F.col("n_rcode") == "NXDOMAIN")
    states = joined.withColumns({"state": state, "gone": gone})
    n = lambda s: F.count_if(F.col("state") == s)
    return states.groupBy("domain").agg(
        F.array_sort(F.collect_set(F.when(F.col("state") == "nxdomain", F.col("host")))).alias("mx_hosts_nxdomain"),
        F.when(n("reachable") > 0, False).when(n("unknown") == 0, True).alias("mx_unreachable"),
        F.when(n("nxdomain") > 0, any_true(F.collect_list(F.when(F.col("state") == "nxdomain", F.struct(F.col("gone").alias("g"))))["g"])).when(n("unknown") == 0, False).alias("mx_domain_unregistered"),
    )


def demote_wildcard(domains: DataFrame, answers: DataFrame, label: str = "wildcard-check-0000") -> DataFrame:
    """Add wildcard_mx: whether a fixed name that nobody uses has MX too; NULL if it was not answered.

    ``domains`` has (domain, apex, guessed, mx_exists); the MX of a guessed name below a wildcard does not count.
    """
    probe = answers.filter(F.col("qtype") == "MX").select(F.col("name").alias("_n"), F.when(yes(F.col("observed")), yes(F.col("record_present"))).alias("wildcard_mx"))
    out = domains.join(probe, F.concat(F.lit(f"{label}."), F.col("apex")) == F.col("_n"), "left").drop("_n")
    return out.withColumn("mx_exists", F.when(yes(F.col("guessed")) & yes(F.col("wildcard_mx")), False).otherwise(F.col("mx_exists")))


def dkim_control(bronze: DataFrame) -> DataFrame:
    """(domain, wildcard_suspect): a selector that does not exist was answered."""
    return bronze.groupBy("domain").agg(F.coalesce(F.bool_or(F.when(F.col("purpose") == "dkim_control", yes(F.col("record_present")))), F.lit(False)).alias("wildcard_suspect"))


# ---------------------------------------------------------------- address space


#: Numbers of an address: IPv4 addresses, or the IPv6 networks of 64 bits, up to 2**64 of them.
NUMBER = "decimal(20,0)"
#: Keys are counted in so many buckets first, to find those that have very many ranges.
KEY_BUCKETS = 1 << 16
_TOP = -(1 << 63)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_DOTTED = rf"(?:{_OCTET}\.){{3}}{_OCTET}"


def ip4_octets(address: Column) -> Column:
    """The octets of a dotted IPv4 address, as texts; NULL if it is none. Octets have no leading zeros."""
    return F.split(R.filled(F.regexp_extract(address, rf"^({_DOTTED})$", 1)), r"\.")


def ip4_number(octets: Column) -> Column:
    """The number of an IPv4 address."""
    a, b, c, d = (F.get(octets, F.lit(i)).cast("long") for i in range(4))
    return ((a * 256 + b) * 256 + c) * 256 + d


def ip6_plain(text: Column) -> Column:
    """An IPv6 text with a dotted tail written as two groups; NULL if the tail is no address."""
    tail = F.split(R.filled(F.regexp_extract(text, rf"^.*:({_DOTTED})$", 1)), r"\.")
    last = F.array_join(F.transform(tail, lambda o: F.lpad(F.lower(F.hex(o.cast("int"))), 2, "0")), "")
    return F.when(text.contains("."), F.concat(F.regexp_replace(text, r"[^:]*$", ""), F.substring(last, 1, 4), F.lit(":"), F.substring(last, 5, 4))).otherwise(text)


def colons(text: Column) -> Column:
    """How many there are."""
    return F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit("")))


def ip6_groups(text: Column) -> Column:
    """The eight groups of an IPv6 text in lower case; NULL if it is none. At its ends ``::`` has a 0 outside (``0::1``)."""
    group = "[0-9a-f]{1,4}"
    good = F.when(text.contains("::"), text.rlike(f"^{group}(?::{group})*::{group}(?::{group})*$") & (colons(text) <= 8)).otherwise(text.rlike(f"^{group}(?::{group}){{7}}$"))
    return F.when(good, F.split(F.replace(text, F.lit("::"), F.concat(F.lit(":"), F.repeat(F.lit("0:"), 8 - colons(text)))), ":"))


def ip6_network(groups: Column) -> Column:
    """The first four groups, as the bits of a long."""
    group = lambda i: F.lpad(F.get(groups, F.lit(i)), 4, "0")
    half = lambda i: F.conv(F.concat(group(i), group(i + 1)), 16, 10).cast("long")
    return F.shiftleft(half(0), 32).bitwiseOR(half(2))


def net_mask(family: str = "family", prefix: str = "prefix") -> Column:
    """The bits of a long that a range leaves fixed."""
    free = F.when(F.col(family) == 4, 32 - F.col(prefix)).otherwise(64 - F.least(F.col(prefix), F.lit(64)))
    return F.when(free < 64, F.call_function("shiftleft", F.lit(-1).cast("long"), free)).otherwise(F.lit(0).cast("long"))


def address_space(ranges: DataFrame, key: str | list[str] = "key", low: str = "low", high: str = "high", limit: int = BROADCAST_ROWS) -> DataFrame:
    """(key, covered): how many numbers the ranges of a key cover, overlaps once.

    Each range adds what lies beyond all ranges that begin before it. Beyond ``limit`` ranges they are swept range by
    range of the order (``reached``), so that the ranges of one key lie in many tasks. ``covered`` is a long, or has the
    type NUMBER if low has.
    """
    keys = [key] if isinstance(key, str) else key
    swept = reached(ranges.select(*keys, low, high), [F.col(low).asc(), F.col(high).asc()], {"_reached": F.col(high)}, keys, limit)
    begin = F.greatest(F.col(low) - 1, F.coalesce("_reached", F.col(low) - 1))
    fresh = F.greatest(F.col(high) - begin, F.lit(0))
    kind = NUMBER if dict(ranges.dtypes)[low].startswith("decimal") else "long"
    return swept.groupBy(*keys).agg(F.sum(fresh).cast(kind).alias("covered"))


def passed(facts: DataFrame, key: str, record: str) -> DataFrame:
    """(key, family, low, prefix): the ranges that the ip4 and ip6 terms of a record let pass.

    A row for each such term, NULL but for the key if it is no range, and one such row for a record without terms. low is
    the first number less 2**63, so that all have their order as longs. Each step stands in a projection of its own, since
    what is named several times in one would be worked out several times, or make code too long for the JVM to compile.
    """
    text, value, family, six = F.col(record), F.col("value"), F.col("family"), F.col("six")
    terms = F.when(R.is_spf(text), F.regexp_extract_all(text, F.lit(r"(?i)\s[+]*(ip[46]:\S*)"), F.lit(1)))
    out = facts.select(F.col(key).alias("key"), F.explode_outer(terms).alias("t"))
    out = out.select("key", F.when(F.substring("t", 3, 1) == "4", 4).when(F.col("t").isNotNull(), 6).alias("family"), F.expr("substring(t, 5)").alias("value"))
    size = F.when(value.contains("/"), F.regexp_extract(value, r"^[^/]*/(\d{1,9})$", 1))
    out = out.select("key", "family", F.substring_index(value, "/", 1).alias("address"), size.alias("size"))
    most = F.when(family == 4, 32).otherwise(128)
    prefix = F.when(F.col("size").isNull(), most).when(F.col("size") != "", F.col("size").cast("int"))
    out = out.select("key", "family", prefix.alias("prefix"), F.when(family == 4, F.col("address")).alias("four"), F.when(family == 6, F.lower("address")).alias("six"))
    out = out.select("key", "family", "prefix", ip4_octets(F.col("four")).alias("octets"), ip6_plain(six).alias("six"))
    # ``::`` stands for one group at least: up to seven colons, or eight where it is at an end and gets a 0 outside.
    begins, ends = six.startswith("::"), six.endswith("::")
    outside = lambda there: F.when(there, "0").otherwise("")
    out = out.select("key", "family", "prefix", "octets", F.when(begins | ends, F.concat(outside(begins), six, outside(ends))).when(colons(six) <= 7, six).alias("six"))
    out = out.select("key", "family", "prefix", "octets", ip6_groups(six).alias("groups"))
    number = F.coalesce(ip4_number(F.col("octets")), ip6_network(F.col("groups")))
    out = out.select("key", "family", "prefix", F.when(F.col("prefix") <= most, number).alias("number"))
    out = out.select("key", "family", "prefix", F.col("number").bitwiseAND(net_mask()).bitwiseXOR(_TOP).alias("low"))
    # Behind explode_outer a filter stays above, else Spark puts all steps into its condition.
    found = F.when(F.col("low").isNotNull(), F.array(F.struct("family", "low", "prefix")))
    return out.select("key", F.explode_outer(found).alias("r")).select("key", "r.family", "r.low", "r.prefix")


def last_number(low: str = "low") -> Column:
    """The last number of a range of ``passed``, less 2**63 as its first."""
    return F.col(low).bitwiseXOR(_TOP).bitwiseOR(F.bitwise_not(net_mask())).bitwiseXOR(_TOP)


def from_zero(number: Column) -> Column:
    """A number of ``passed`` with the 2**63 that it lacks, as NUMBER."""
    return (number.cast(NUMBER) + F.lit(str(1 << 63)).cast(NUMBER)).cast(NUMBER)


def spf_ranges(facts: DataFrame, key: str = "key", record: str = "raw_spf") -> DataFrame:
    """(key, low, high, prefix) of the IPv4 ranges that a record lets pass."""
    return passed(facts, key, record).filter("family = 4").select("key", F.col("low").bitwiseXOR(_TOP).alias("low"), last_number().bitwiseXOR(_TOP).alias("high"), "prefix")


def spf_ranges6(facts: DataFrame, key: str = "key", record: str = "raw_spf") -> DataFrame:
    """(key, low, high, prefix) of the IPv6 ranges that a record lets pass, in networks of 64 bits, numbered as NUMBER.

    A range within one network counts as it.
    """
    return passed(facts, key, record).filter("family = 6").select("key", from_zero(F.col("low")).alias("low"), from_zero(last_number()).alias("high"), "prefix")


def many_ranges(facts: DataFrame, key: str, record: str, limit: int) -> DataFrame | None:
    """(_key): the keys that may have more than ``limit`` ranges, few by that; None without any.

    Each range has the letters ip before it. These are counted in buckets of keys first, then for the keys of full ones.
    """
    text = F.lower(F.col(record))
    counted = facts.select(F.col(key).alias("_key"), (1 + (F.length(text) - F.length(F.replace(text, F.lit("ip"), F.lit("")))) / 2).cast("long").alias("_n"))
    counted = counted.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(KEY_BUCKETS)))
    full = cut(counted.groupBy("_bucket").agg(F.sum("_n").alias("_all")).filter(F.col("_all") > limit).select("_bucket"))
    if full.isEmpty():
        return None
    keys = counted.join(F.broadcast(full), "_bucket", "left_semi").groupBy("_key").agg(F.sum("_n").alias("_all"))
    keys = cut(keys.filter(F.col("_all") > limit).select("_key"))
    return None if keys.isEmpty() else keys


def spf_spaces(facts: DataFrame, key: str = "key", record: str = "raw_spf", limit: int = BROADCAST_ROWS) -> DataFrame:
    """W7 in both families, a row for each key that has a record.

    (key, ip4_addresses, ip4_widest_prefix, ip6_networks, ip6_widest_prefix): what the passing ranges cover, overlaps
    once, in IPv4 addresses and in IPv6 networks of 64 bits (smaller ranges count as the network they lie in); 0 if there
    is none, and then no prefix. Several records of a key count together. Ranges are shuffled by key and swept there; keys
    with more than ``limit`` of them are swept by ``address_space``, which deals the ranges of a key to many tasks.
    """
    records = facts.filter(F.col(record).isNotNull())
    large = many_ranges(records, key, record, limit)
    if large is None:
        return _swept(records, key, record)
    same = F.col(key).eqNullSafe(F.col("_key"))
    few = _swept(records.join(short(large), same, "left_anti"), key, record)
    return few.unionByName(_swept_in_parts(records.join(short(large), same, "left_semi"), key, record, limit))


def _swept(records: DataFrame, key: str, record: str) -> DataFrame:
    """The result of ``spf_spaces`` with all ranges of a key in one task."""
    # Records without a key count, but have no ranges.
    ranges = passed(records, key, record).withColumn("family", F.when(F.col("key").isNotNull(), F.col("family"))).repartition("key")
    order = Window.partitionBy("key", "family").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("high", last_number()).withColumn("_reached", F.max("high").over(order))
    whole = lambda c: F.col(c).cast(NUMBER)
    fresh = F.when(F.col("_reached") >= F.col("high"), F.lit(0).cast(NUMBER)).when(F.col("_reached") >= F.col("low"), whole("high") - whole("_reached")).otherwise(whole("high") - whole("low") + 1)
    of = lambda f, c: F.when(F.col("family") == f, F.col(c))
    return ranges.withColumn("_fresh", fresh).groupBy("key").agg(
        F.coalesce(F.sum(of(4, "_fresh")), F.lit(0)).cast("long").alias("ip4_addresses"),
        F.min(of(4, "prefix")).alias("ip4_widest_prefix"),
        F.coalesce(F.sum(of(6, "_fresh")), F.lit(0)).cast(NUMBER).alias("ip6_networks"),
        F.min(of(6, "prefix")).alias("ip6_widest_prefix"),
    )


def _swept_in_parts(records: DataFrame, key: str, record: str, limit: int) -> DataFrame:
    """The same with the ranges of a key in many tasks."""
    both = cut(passed(records, key, record).filter("family IS NOT NULL").select("key", "family", from_zero(F.col("low")).alias("low"), from_zero(last_number()).alias("high"), "prefix"))
    widest = both.groupBy("key", "family").agg(F.min("prefix").alias("widest"))
    found = address_space(both, ["key", "family"], limit=limit).join(widest, ["key", "family"])
    of = lambda f, c: F.max(F.when(F.col("family") == f, F.col(c)))
    keys = records.select(F.col(key).alias("key"), F.lit(None).cast("int").alias("family"), F.lit(None).cast(NUMBER).alias("covered"), F.lit(None).cast("int").alias("widest"))
    none = F.lit(0).cast(NUMBER)
    return found.select("key", "family", "covered", "widest").unionByName(keys).groupBy("key").agg(
        F.coalesce(of(4, "covered"), none).cast("long").alias("ip4_addresses"),
        of(4, "widest").alias("ip4_widest_prefix"),
        F.coalesce(of(6, "covered"), none).alias("ip6_networks"),
        of(6, "widest").alias("ip6_widest_prefix"),
    )
