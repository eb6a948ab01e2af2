"""Record text as columns: SPF, DMARC, DKIM, MTA-STS, TLS-RPT, BIMI, DANE, MX (survey 2.8, F-R1 to F-R20).

Every function takes and returns columns, so one Spark job reads a whole table of answers. NULL stays NULL where a
thing was not observed; an empty array means "observed, nothing there".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of RFC 7208: terms that cost a lookup, terms that do not, and the limit of lookups.
LOOKUP_MECHANISMS = ["include", "a", "mx", "ptr", "exists"]
ADDRESS_MECHANISMS = ["all", "ip4", "ip6"]
MAX_LOOKUPS = 10
# Address terms from which on, and includes up to which, a record counts as flattened.
FLATTENED_ADDRESSES, FLATTENED_INCLUDES = 20, 1
# Fixed values of RFC 7489 / 9989.
POLICIES = ["none", "quarantine", "reject"]
RETIRED_TAGS = ["pct", "rf", "ri"]
# Fixed values of RFC 8461.
STS_MODES = ["enforce", "testing", "none"]
STS_MAX_AGE = 31_557_600
# RSA lengths that an estimate snaps to.
RSA_BITS = [512, 1024, 2048, 3072, 4096]

STRINGS = "array<string>"


def none(kind: str) -> Column:
    """A typed NULL."""
    return F.lit(None).cast(kind)


def no_strings() -> Column:
    """An empty array of strings."""
    return F.array().cast(STRINGS)


def strip(c: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def filled(c: Column) -> Column:
    """NULL where the text is empty."""
    return F.when(c != "", c)


def no_dot(c: Column) -> Column:
    """Without dots at the end."""
    return F.regexp_replace(c, r"\.+$", "")


def join_chunks(data: Column) -> Column:
    """F-R1: the character strings of one TXT answer, joined in order without a separator."""
    return F.array_join(data, "")


# ---------------------------------------------------------------- SPF


def is_spf(txt: Column) -> Column:
    """F-R2: ``v=spf1`` in any case, then a blank or the end."""
    return F.coalesce(strip(txt).rlike(r"(?i)^v=spf1([ \t]|$)"), F.lit(False))


def spf_terms(txt: Column) -> Column:
    """F-R3: what follows the version, split at blanks; empty if this is no SPF record."""
    return F.when(is_spf(txt), F.slice(F.split(strip(txt), r"\s+"), 2, 1 << 20)).otherwise(no_strings())


def bare(term: Column) -> Column:
    """A term without its qualifier."""
    return F.regexp_replace(term, r"^[+\-~?]+", "")


def term_name(term: Column) -> Column:
    """Mechanism or modifier name of a term."""
    return F.lower(F.regexp_extract(bare(term), r"^([^:=/]*)", 1))


def all_qualifier(terms: Column) -> Column:
    """Qualifier of the first ``all``; ``+`` where none is written; NULL without ``all``."""
    first = F.get(F.filter(terms, lambda t: t.rlike(r"(?i)^[+\-~?]?all$")), 0)
    return F.when(F.length(first) == 3, "+").otherwise(F.substring(first, 1, 1))


def spf_includes(terms: Column) -> Column:
    """Targets of ``include:``, lower-case, in order."""
    found = F.transform(F.filter(terms, lambda t: t.rlike(r"(?i)^include:")), lambda t: strip(F.regexp_replace(t, r"(?i)^include:", "")))
    return F.transform(F.filter(found, lambda d: d != ""), lambda d: F.lower(no_dot(d)))


def spf_redirect(terms: Column) -> Column:
    """Target of ``redirect=``; NULL where an ``all`` makes it dead."""
    found = F.transform(F.filter(terms, lambda t: t.rlike(r"(?i)^redirect=")), lambda t: strip(F.regexp_replace(t, r"(?i)^redirect=", "")))
    return F.when(all_qualifier(terms).isNull(), F.lower(no_dot(F.get(F.filter(found, lambda d: d != ""), 0))))


def spf_domains(terms: Column) -> Column:
    """Domains named by ``a:``, ``mx:`` and ``exists:``."""
    low = F.transform(terms, lambda t: F.lower(bare(t)))
    named = F.filter(low, lambda t: t.rlike(r"^(a|mx|exists):"))
    found = F.transform(named, lambda t: strip(F.regexp_extract(t, r"^[^:]*:([^/]*)", 1)))
    return F.transform(F.filter(found, lambda d: d != ""), no_dot)


def spf_mechanisms(terms: Column) -> Column:
    """Terms without qualifier that rules are matched with: all but addresses and ``all``."""
    return F.transform(F.filter(terms, lambda t: ~term_name(t).isin(ADDRESS_MECHANISMS)), bare)


def lookups(terms: Column) -> Column:
    """F-R5: terms that cost a DNS lookup, ``redirect`` included."""
    return F.size(F.filter(terms, lambda t: term_name(t).isin([*LOOKUP_MECHANISMS, "redirect"])))


def own_lookups(terms: Column) -> Column:
    """Lookups of one record on a walk: ``redirect`` counts only while it is alive."""
    counted = F.size(F.filter(terms, lambda t: term_name(t).isin(LOOKUP_MECHANISMS)))
    return counted + F.when(spf_redirect(terms).isNotNull(), 1).otherwise(0)


def void_lookups(present: Column) -> Column:
    """F-R5: how many targets (array of booleans) had no record."""
    return F.size(F.filter(present, lambda p: ~p))


def is_dynamic(txt: Column) -> Column:
    """F-R4: the record holds a macro, or a service that is known to expand one."""
    return F.coalesce(txt.rlike(r"(?i)%\{[a-z]\}|_spf\.vali\.email"), F.lit(False))


def count_terms(terms: Column, prefix: str) -> Column:
    return F.size(F.filter(terms, lambda t: F.lower(bare(t)).startswith(prefix)))


def is_flattened(terms: Column) -> Column:
    """F-R4: many addresses and hardly an include."""
    addresses = count_terms(terms, "ip4:") + count_terms(terms, "ip6:")
    return (addresses >= FLATTENED_ADDRESSES) & (F.size(spf_includes(terms)) <= FLATTENED_INCLUDES)


def spf_row(txts: Column) -> dict[str, Column]:
    """F-R6: columns of the SPF result of all TXT strings of a name, in two steps.

    The first entry ``_spf`` must be added before the others, which read it.
    """
    records = F.filter(txts, is_spf)
    # Terms are read from a single record only: of several none is valid.
    step = F.struct(records.alias("records"), F.when(F.size(records) == 1, spf_terms(F.get(records, 0))).otherwise(no_strings()).alias("terms"))
    spf, terms, n = F.col("_spf"), F.col("_spf.terms"), F.size(F.col("_spf.records"))
    one = n == 1
    exceeds = lookups(terms) > MAX_LOOKUPS
    return {
        "_spf": step,
        "raw_spf": F.get(spf["records"], 0),
        "spf_present": n > 0,
        "spf_valid": one & ~exceeds,
        "spf_error": F.when(n > 1, "multiple_records").when(exceeds, "permerror"),
        "spf_all_qualifier": all_qualifier(terms),
        "spf_lookup_count": lookups(terms),
        "spf_exceeds_limit": exceeds,
        "spf_includes": spf_includes(terms),
        "spf_mechanisms": spf_mechanisms(terms),
        "spf_redirect": spf_redirect(terms),
        "spf_is_flattened": is_flattened(terms),
        "spf_is_dynamic": one & is_dynamic(F.get(spf["records"], 0)),
        "spf_has_ptr": F.when(one, F.exists(terms, lambda t: F.lower(F.regexp_extract(bare(t), r"^([^:]*)", 1)) == "ptr")),
    }


# ---------------------------------------------------------------- DMARC


def is_dmarc(txt: Column) -> Column:
    """F-R7: tag name ``v`` in any case, value exactly ``DMARC1``."""
    return F.coalesce(strip(txt).rlike(r"^[vV]=\s*DMARC1\s*(;|$)"), F.lit(False))


def tag(txt: Column, name: str) -> Column:
    """Value of the first tag of that name; empty text if it is missing."""
    return strip(F.regexp_extract(txt, rf"(?is)(?:^|;)\s*{name}\s*=([^;]*)", 1))


def tag_map(txt: Column) -> Column:
    """All tags, names in lower case; of repeated names the first wins."""
    parts = F.filter(F.split(txt, ";"), lambda p: p.contains("="))
    named = F.filter(F.transform(parts, lambda p: F.struct(F.lower(strip(F.substring_index(p, "=", 1))).alias("k"), strip(F.regexp_replace(p, r"(?s)^[^=]*=", "")).alias("v"))), lambda s: s["k"] != "")
    return F.aggregate(named, F.map_from_arrays(no_strings(), no_strings()), lambda m, s: F.when(F.map_contains_key(m, s["k"]), m).otherwise(F.map_concat(m, F.create_map(s["k"], s["v"]))))


def repeats_tag(txt: Column) -> Column:
    """Whether a tag name occurs twice."""
    names = F.transform(F.filter(F.split(txt, ";"), lambda p: p.contains("=")), lambda p: F.lower(strip(F.substring_index(p, "=", 1))))
    return F.size(F.array_distinct(names)) < F.size(names)


def address_domain(uri: Column) -> Column:
    """Domain of ``mailto:local@domain!size``; NULL without an @. The local part is never kept."""
    value = F.substring_index(F.regexp_replace(strip(uri), r"(?i)^mailto:", ""), "!", 1)
    return F.when(value.contains("@"), filled(F.lower(no_dot(strip(F.substring_index(value, "@", -1))))))


def report_domains(txt: Column, name: str = "rua") -> Column:
    """F-R8: distinct domains of a report tag in order."""
    return F.array_distinct(F.array_compact(F.transform(F.split(tag(txt, name), ","), address_domain)))


def to_int(c: Column) -> Column:
    """An integer, or NULL where the text is none."""
    return F.when(strip(c).rlike(r"^[+-]?\d{1,9}$"), strip(c)).cast("int")


def effective_7489(p: Column, pct: Column) -> Column:
    """F-R9: strength of a policy where receivers honour ``pct``."""
    share = F.coalesce(pct, F.lit(100))
    return (
        F.when((p == "reject") & (share >= 100), "reject")
        .when((p == "reject") & (share > 0), "quarantine")
        .when((p == "quarantine") & (share >= 100), "quarantine")
        .when((p == "quarantine") & (share != 0), "quarantine_partial")
        .otherwise("none")
    )


def effective_9989(p: Column, t: Column) -> Column:
    """F-R9: strength where ``pct`` is ignored and ``t=y`` takes one step off."""
    testing = F.coalesce(t == "y", F.lit(False))
    return F.when(~testing, F.when(p.isin(POLICIES), p).otherwise("none")).when(p == "reject", "quarantine").otherwise("none")


# Order of effective policies.
STRENGTH = {"none": 0, "quarantine_partial": 1, "quarantine": 2, "reject": 3}


def strength(policy: Column) -> Column:
    """Place of an effective policy in the order of strength; NULL for unknown ones."""
    out = none("int")
    for name, rank in STRENGTH.items():
        out = F.when(policy == name, rank).otherwise(out)
    return out


def policy_label(p: Column, pct: Column, t: Column, has_rua: Column) -> Column:
    """F-R10: nominal and effective policy in one word."""
    weak = F.coalesce(pct < 100, F.lit(False))
    testing = F.coalesce(t == "y", F.lit(False))
    reject, quarantine = p == "reject", p == "quarantine"
    return (
        F.when(reject & weak, "nominal_reject_weak_pct")
        .when(quarantine & weak, "nominal_quarantine_weak_pct")
        .when((reject | quarantine) & testing, "nominal_reject_testing")
        .when(reject, F.when(has_rua, "enforced_reject").otherwise("blind_reject"))
        .when(quarantine, F.when(has_rua, "enforced_quarantine").otherwise("blind_quarantine"))
        .when(p == "none", F.when(has_rua, "monitoring").otherwise("ineffective"))
        .otherwise("none")
    )


def dmarc_row(txts: Column) -> list[dict[str, Column]]:
    """F-R7 to F-R11: columns of the DMARC result, in the order in which they must be added."""
    records = F.filter(txts, is_dmarc)
    first = {"_dmarc": records}
    n = F.size(F.col("_dmarc"))
    raw = F.when(n == 1, F.get(F.col("_dmarc"), 0))
    low = lambda name: filled(F.lower(tag(raw, name)))
    tags = {
        "raw_dmarc": F.get(F.col("_dmarc"), 0),
        "dmarc_present": n > 0,
        "dmarc_multiple_records": n > 1,
        **{f"dmarc_{name}": low(name) for name in ("p", "sp", "np", "t", "psd", "adkim", "aspf")},
        "dmarc_pct": to_int(tag(raw, "pct")),
        "dmarc_rua": F.coalesce(report_domains(raw, "rua"), no_strings()),
        "dmarc_ruf": F.coalesce(report_domains(raw, "ruf"), no_strings()),
        "dmarc_has_duplicate_tag": F.coalesce(repeats_tag(raw), F.lit(False)),
        "dmarc_historic_tags": F.when(n > 0, F.arrays_overlap(F.map_keys(tag_map(F.get(F.col("_dmarc"), 0))), F.array(*[F.lit(x) for x in RETIRED_TAGS]))),
    }
    one = F.col("dmarc_present") & ~F.col("dmarc_multiple_records")
    p, pct, t = F.col("dmarc_p"), F.col("dmarc_pct"), F.col("dmarc_t")
    has_rua = F.size("dmarc_rua") > 0
    below = F.when(F.col("dmarc_sp").isin(POLICIES), F.col("dmarc_sp")).otherwise(p)
    effect = {
        "dmarc_valid": one & F.coalesce(p.isin(POLICIES), F.lit(False)),
        "effective_7489": F.when(one, effective_7489(p, pct)),
        "effective_9989": F.when(one, effective_9989(p, t)),
        "sp_effective_7489": F.when(one, effective_7489(below, pct)),
        "sp_effective_9989": F.when(one, effective_9989(below, t)),
        "policy_label": F.when(one, policy_label(p, pct, t, has_rua)),
        "spec_version": F.when(one, F.when(pct.isNull() & F.coalesce(t, F.col("dmarc_psd"), F.col("dmarc_np")).isNotNull(), "rfc9989").otherwise("rfc7489")),
    }
    last = {
        "sp_weaker": F.coalesce(strength(F.col("sp_effective_7489")) < strength(F.col("effective_7489")), F.lit(False)),
        "blind_enforcement": F.coalesce(F.col("effective_7489").isin("reject", "quarantine") & ~has_rua, F.lit(False)),
    }
    return [first, tags, effect, last]


# ---------------------------------------------------------------- DKIM


def key_bits(p: Column) -> Column:
    """F-R12: RSA length estimated from the size of the base64 key, snapped to the usual lengths."""
    letters = F.length(F.regexp_replace(p, r"[^A-Za-z0-9+/]", ""))
    size = F.floor(letters * 6 / 8)
    bits = F.greatest(size - 24, F.lit(0)) * 8
    out = F.when(bits > 0, bits)
    for usual in reversed(RSA_BITS):
        out = F.when(F.abs(bits - usual) <= usual * 0.15, usual).otherwise(out)
    return F.when((letters > 0) & (letters % 4 != 1), out).cast("int")


def dkim_key(txt: Column) -> Column:
    """F-R12: (valid, revoked, testing, key_type, key_bits) of one key record."""
    tags = tag_map(txt)
    version, p = tags["v"], tags["p"]
    known = F.coalesce(F.upper(version) == "DKIM1", F.lit(True))
    kind = F.lower(F.coalesce(filled(tags["k"]), F.lit("rsa")))
    valid = known & p.isNotNull()
    return F.struct(
        F.coalesce(valid, F.lit(False)).alias("valid"),
        F.coalesce(valid & (p == ""), F.lit(False)).alias("revoked"),
        F.coalesce(known & F.array_contains(F.split(F.lower(tags["t"]), ":"), "y"), F.lit(False)).alias("testing"),
        F.when(known, kind).alias("key_type"),
        F.when(valid & (p != "") & (kind == "rsa"), key_bits(p)).alias("key_bits"),
    )


# ---------------------------------------------------------------- other records


def versioned(txts: Column, version: str) -> Column:
    """The first text whose ``v`` tag is ``version`` in any case."""
    return F.get(F.filter(txts, lambda t: F.upper(tag(t, "v")) == version.upper()), 0)


def extras_row(mta_sts: Column, tls_rpt: Column, bimi: Column) -> dict[str, Column]:
    """F-R14: MTA-STS, TLS-RPT and BIMI columns from the TXT strings of their names."""
    sts, rpt, logo = versioned(mta_sts, "STSv1"), versioned(tls_rpt, "TLSRPTv1"), versioned(bimi, "BIMI1")
    return {
        "mta_sts_present": sts.isNotNull(),
        "mta_sts_id": filled(tag(sts, "id")),
        "tls_rpt_present": rpt.isNotNull(),
        "tls_rpt_rua": F.coalesce(report_domains(rpt, "rua"), no_strings()),
        "bimi_present": logo.isNotNull(),
        "bimi_has_svg": F.coalesce(tag(logo, "l") != "", F.lit(False)),
        "bimi_has_vmc": F.coalesce(tag(logo, "a") != "", F.lit(False)),
    }


def sts_policy(text: Column) -> Column:
    """F-R15: (valid, mode, mx, max_age) of a fetched MTA-STS policy text; NULL text gives NULL."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: x.contains(":"))
    fields = F.transform(lines, lambda x: F.struct(F.lower(strip(F.substring_index(x, ":", 1))).alias("k"), strip(F.regexp_replace(x, r"^[^:]*:", "")).alias("v")))
    first = lambda k: F.get(F.filter(fields, lambda s: s["k"] == k), 0)["v"]
    mode = F.lower(first("mode"))
    mode = F.when(mode.isin(STS_MODES), mode)
    age = F.when(first("max_age").rlike(r"^\d{1,18}$"), first("max_age")).cast("long")
    mx = F.transform(F.filter(fields, lambda s: (s["k"] == "mx") & (s["v"] != "")), lambda s: no_dot(F.lower(s["v"])))
    valid = F.coalesce(first("version") == "STSv1", F.lit(False)) & mode.isNotNull() & F.coalesce(age <= STS_MAX_AGE, F.lit(False)) & ((mode == "none") | (F.size(mx) > 0))
    return F.when(text.isNotNull(), F.struct(F.coalesce(valid, F.lit(False)).alias("valid"), mode.alias("mode"), mx.alias("mx"), age.alias("max_age")))


def mx_allowed(host: Column, patterns: Column) -> Column:
    """Whether a host fits a policy: ``*.`` stands for exactly one label."""
    h = no_dot(F.lower(host))
    return F.exists(patterns, lambda p: F.when(p.startswith("*."), F.regexp_replace(h, r"^[^.]+", "*") == p).otherwise(h == p))


def sts_mismatch(policy: Column, hosts: Column) -> Column:
    """Whether a host is missing from a valid policy that is not ``none``; NULL if that cannot be said."""
    asked = policy["valid"] & (policy["mode"] != "none") & (F.size(hosts) > 0)
    return F.when(asked, ~F.forall(hosts, lambda h: mx_allowed(h, policy["mx"])))


def dane_orphan(tlsa: Column, dnssec: Column) -> Column:
    """F-R16: TLSA records without DNSSEC."""
    return (F.size(tlsa) > 0) & F.coalesce(~dnssec, F.lit(False))


def null_mx(exchanges: Column) -> Column:
    """F-R17: a single exchange that is the root: mail is refused on purpose."""
    return (F.size(exchanges) == 1) & strip(F.get(exchanges, 0)).isin(".", "")


def mx_hosts(exchanges: Column) -> Column:
    """F-R17: exchange names without end dot, lower-case, the root left out."""
    return F.filter(F.transform(exchanges, lambda h: F.lower(no_dot(strip(h)))), lambda h: h != "")


def txt_bytes(name: Column, answers: Column) -> Column:
    """F-R18: estimated size of a TXT response; ``answers`` is an array of arrays of character strings."""
    head = F.lit(12 + 4 + 11) + F.length(no_dot(name)) + 2
    return F.aggregate(answers, head, lambda n, a: n + 12 + F.aggregate(a, F.lit(0), lambda m, s: m + 1 + F.octet_length(s)))


def other_txt(txts: Column) -> Column:
    """U4: distinct non-empty TXT strings other than SPF, sorted."""
    return F.array_sort(F.array_distinct(F.filter(txts, lambda t: (t != "") & ~is_spf(t))))


def answer_state(rcode: Column, answers: Column) -> Column:
    """F-R20: (observed, record_present). Failures leave presence NULL: not fetched is not absent."""
    has = F.coalesce(F.size(answers) > 0, F.lit(False))
    observed = rcode.isin("NOERROR", "NODATA", "NXDOMAIN")
    return F.struct(F.coalesce(observed, F.lit(False)).alias("observed"), F.when(observed, has & (rcode != "NXDOMAIN")).alias("record_present"))
