"""Record strings against expected values, and against a plain reading of the rules."""

import contextlib
import io
import ipaddress
import random
import re

import pytest
from pyspark.sql import functions as F

from mailposture.functions import records as R
from mailposture.operators import facts


def one(spark, rows, schema, **columns):
    return spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()


SPF = [
    (["v=spf1 -all"], True, None, "-", 0, []),
    (["V=SPF1 include:a.example Include:B.example. ~all"], True, None, "~", 2, ["a.example", "b.example"]),
    (["v=spf10 -all"], False, None, None, 0, []),
    (["v=spf1"], True, None, None, 0, []),
    (["v=spf1 all"], True, None, "+", 0, []),
    (["v=spf1 mx a ptr exists:%{i}.x.example redirect=r.example"], True, None, None, 5, []),
    (["v=spf1 -all", "v=spf1 ~all"], True, "multiple_records", None, 0, []),
    (["v=spf1 " + " ".join(f"include:i{n}.example" for n in range(11)) + " -all"], True, "permerror", "-", 11, [f"i{n}.example" for n in range(11)]),
    ([], False, None, None, 0, []),
]


def test_spf(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(SPF)], "i int, txts array<string>")
    rows = facts.spf_columns(df, "txts").orderBy("i").collect()
    for row, (_, present, error, qualifier, lookups, includes) in zip(rows, SPF, strict=True):
        assert (row.spf_present, row.spf_error, row.spf_all_qualifier, row.spf_lookup_count, row.spf_includes) == (present, error, qualifier, lookups, includes)
    assert rows[0].spf_valid and not rows[6].spf_valid and not rows[7].spf_valid
    assert rows[5].spf_is_dynamic and rows[5].spf_has_ptr and rows[5].spf_redirect == "r.example"


def test_redirect_is_dead_beside_all_and_terms_are_split(spark):
    rows = one(spark, [("v=spf1 redirect=x.example -all",), ("v=spf1\tip4:1.2.3.4  a:WWW.x.example/24 ?mx:m.example ",)], "t string", r=R.spf_redirect(R.spf_terms(F.col("t"))), d=R.spf_domains(R.spf_terms(F.col("t"))), m=R.spf_mechanisms(R.spf_terms(F.col("t"))))
    assert rows[0].r is None
    # The version is only split off at blanks, and a tab is one.
    assert rows[1].d == ["www.x.example", "m.example"]
    assert rows[1].m == ["a:WWW.x.example/24", "mx:m.example"]


def test_flattened(spark):
    many = "v=spf1 " + " ".join(f"ip4:10.0.0.{n}" for n in range(20)) + " include:a.example -all"
    few = "v=spf1 " + " ".join(f"ip4:10.0.0.{n}" for n in range(19)) + " -all"
    rows = one(spark, [(many,), (few,)], "t string", f=R.is_flattened(R.spf_terms(F.col("t"))))
    assert [r.f for r in rows] == [True, False]


# record, p, 7489, 9989, label, subdomains, weaker
DMARC = [
    ("v=DMARC1; p=reject; rua=mailto:a@r.example", "reject", "reject", "reject", "enforced_reject", "reject", False),
    ("v=DMARC1;p=reject", "reject", "reject", "reject", "blind_reject", "reject", False),
    ("v=DMARC1; p=reject; pct=50; rua=mailto:a@r.example", "reject", "quarantine", "reject", "nominal_reject_weak_pct", "quarantine", False),
    ("v=DMARC1; p=reject; pct=0", "reject", "none", "reject", "nominal_reject_weak_pct", "none", False),
    ("v=DMARC1; p=quarantine; pct=10", "quarantine", "quarantine_partial", "quarantine", "nominal_quarantine_weak_pct", "quarantine_partial", False),
    ("v=DMARC1; p=reject; t=y; rua=mailto:x@y.example", "reject", "reject", "quarantine", "nominal_reject_testing", "reject", False),
    ("V=DMARC1; P=Reject; SP=none; rua=mailto:x@y.example!10m,mailto:q@Z.example.", "reject", "reject", "reject", "enforced_reject", "none", True),
    ("v=DMARC1; p=none", "none", "none", "none", "ineffective", "none", False),
    ("v=DMARC1; p=none; p=reject; rua=mailto:a@r.example", "none", "none", "none", "monitoring", "none", False),
    ("v=DMARC1; p=bogus", "bogus", "none", "none", "none", "none", False),
    ("v=DMARC1; p=quarantine; t=y", "quarantine", "quarantine", "none", "nominal_reject_testing", "quarantine", False),
]


def test_dmarc(spark):
    df = spark.createDataFrame([(i, [r[0]]) for i, r in enumerate(DMARC)], "i int, txts array<string>")
    for step in R.dmarc_row(F.col("txts")):
        df = df.withColumns(step)
    rows = df.orderBy("i").collect()
    for row, want in zip(rows, DMARC, strict=True):
        assert (row.dmarc_p, row.effective_7489, row.effective_9989, row.policy_label, row.sp_effective_7489, row.sp_weaker) == want[1:], want[0]
    assert rows[6].dmarc_rua == ["y.example", "z.example"]
    assert rows[8].dmarc_has_duplicate_tag and not rows[7].dmarc_has_duplicate_tag
    assert rows[1].blind_enforcement and not rows[0].blind_enforcement
    assert rows[5].spec_version == "rfc9989" and rows[3].spec_version == "rfc7489"
    assert rows[3].dmarc_historic_tags and not rows[1].dmarc_historic_tags


@pytest.mark.parametrize(("txt", "want"), [("v=dmarc1; p=none", False), ("v=DMARC1", True), (" v=DMARC1 ; p=none", True), ("v =DMARC1; p=none", False), ("p=none; v=DMARC1", False), ("v=DMARC12", False)])
def test_is_dmarc(spark, txt, want):
    assert one(spark, [(txt,)], "t string", x=R.is_dmarc(F.col("t")))[0].x is want


def test_several_dmarc_records_void_the_policy(spark):
    df = spark.createDataFrame([(["v=DMARC1; p=reject", "v=DMARC1; p=none"],), ([],)], "txts array<string>")
    for step in R.dmarc_row(F.col("txts")):
        df = df.withColumns(step)
    several, absent = df.collect()
    assert several.dmarc_present and several.dmarc_multiple_records and several.effective_7489 is None and not several.dmarc_valid
    assert not absent.dmarc_present and absent.effective_7489 is None and absent.dmarc_historic_tags is None


def test_effective_policy_like_a_plain_reading(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["reject", "quarantine", "none", "x", None]), rng.choice([None, 0, 1, 50, 99, 100, 150, -1]), rng.choice([None, "y", "n"])) for _ in range(300)]

    def reading(p, pct, t):
        share = 100 if pct is None else pct
        if p == "reject":
            old = "reject" if share >= 100 else "quarantine" if share > 0 else "none"
        elif p == "quarantine":
            old = "quarantine" if share >= 100 else "none" if share == 0 else "quarantine_partial"
        else:
            old = "none"
        new = p if p in ("reject", "quarantine", "none") else "none"
        if t == "y":
            new = {"reject": "quarantine", "quarantine": "none", "none": "none"}[new]
        return old, new

    got = one(spark, rows, "p string, pct int, t string", a=R.effective_7489(F.col("p"), F.col("pct")), b=R.effective_9989(F.col("p"), F.col("t")))
    assert [(r.a, r.b) for r in got] == [reading(*r) for r in rows]


def test_tags_keep_the_first(spark):
    assert one(spark, [("k=a; K=b; x; =c; n=1=2",)], "t string", m=R.tag_map(F.col("t")))[0].m == {"k": "a", "n": "1=2"}


def test_dkim_keys(spark):
    rsa = lambda n: "A" * n
    rows = one(spark, [(f"v=DKIM1; k=rsa; p={rsa(392)}",), (f"p={rsa(216)}",), ("v=DKIM1; p=",), ("v=DKIM2; p=AAAA",), ("v=DKIM1; k=ed25519; t=y:s; p=AAAA",), ("v=DKIM1",)], "t string", k=R.dkim_key(F.col("t")))
    keys = [r.k for r in rows]
    assert [k.key_bits for k in keys] == [2048, 1024, None, None, None, None]
    assert [k.valid for k in keys] == [True, True, True, False, True, False]
    assert keys[2].revoked and not keys[0].revoked and keys[4].testing and keys[4].key_type == "ed25519"


def test_mta_sts_policy(spark):
    good = "version: STSv1\r\nmode: enforce\r\nmx: mail.example.com\r\nmx: *.example.net\r\nmax_age: 86400\r\n"
    df = spark.createDataFrame([(good, ["mail.example.com", "a.example.net"]), (good, ["a.b.example.net"]), ("version: STSv1\nmode: testing\nmax_age: 1", ["x"]), (None, ["x"]), ("version: STSv1\nmode: none\nmax_age: 99999999", ["x"])], "t string, h array<string>")
    rows = df.select(R.sts_policy(F.col("t")).alias("p"), "h").withColumn("bad", R.sts_mismatch(F.col("p"), F.col("h"))).collect()
    assert [r.p and r.p.valid for r in rows] == [True, True, False, None, False]
    assert [r.bad for r in rows] == [False, True, None, None, None]


def test_mx_and_answers(spark):
    rows = one(spark, [(["."],), (["MX1.Example.COM."],), ([],), ([".", "a."],)], "m array<string>", n=R.null_mx(F.col("m")), h=R.mx_hosts(F.col("m")))
    assert [r.n for r in rows] == [True, False, False, False]
    assert [r.h for r in rows] == [[], ["mx1.example.com"], [], ["a"]]
    state = one(spark, [("NOERROR", ["a"]), ("NOERROR", []), ("NXDOMAIN", []), ("SERVFAIL", None)], "r string, a array<string>", s=R.answer_state(F.col("r"), F.col("a")))
    assert [(r.s.observed, r.s.record_present) for r in state] == [(True, True), (True, False), (True, False), (False, None)]


def test_spf_walk(spark):
    names = [("a.example", ["v=spf1 include:b.example -all"]), ("b.example", ["v=spf1 include:a.example -all"]), ("gone.example", []), ("two.example", ["v=spf1 -all", "v=spf1 ~all"]), ("lost.example", None), ("ok.example", ["v=spf1 mx a -all"])]
    start = [("loop", "v=spf1 include:a.example -all"), ("gone", "v=spf1 include:gone.example -all"), ("two", "v=spf1 include:two.example -all"), ("lost", "v=spf1 include:lost.example -all"), ("macro", "v=spf1 include:%{i}.example -all"), ("ok", "v=spf1 include:ok.example redirect=gone.example"), ("plain", "v=spf1 -all")]
    out = facts.spf_walk(spark.createDataFrame(start, "key string, raw_spf string"), spark.createDataFrame(names, "name string, txts array<string>"))
    got = {r.key: r for r in out.collect()}
    assert got["loop"].exceeds is True
    assert got["gone"].broken_target is True and got["gone"].exceeds is False
    assert got["two"].multiple == ["two.example"]
    assert got["lost"].exceeds is None and got["lost"].broken_target is None
    assert got["macro"].macro == ["%{i}.example"] and not got["macro"].complete
    assert (got["ok"].lookups, got["ok"].broken_target) == (4, True)
    assert (got["plain"].lookups, got["plain"].exceeds) == (0, False)


def test_effective_all(spark):
    names = [("r1", ["v=spf1 redirect=r2"]), ("r2", ["v=spf1 ~all"]), ("c1", ["v=spf1 redirect=c1"]), ("none", [])]
    start = [("chain", "v=spf1 redirect=r1"), ("own", "v=spf1 mx -all"), ("loop", "v=spf1 redirect=c1"), ("missing", "v=spf1 redirect=none"), ("bare", "v=spf1 mx")]
    out = facts.effective_all(spark.createDataFrame(start, "key string, raw_spf string"), spark.createDataFrame(names, "name string, txts array<string>"))
    assert {r.key: (r.qualifier, r.known) for r in out.collect()} == {"chain": ("~", True), "own": ("-", True), "loop": (None, False), "missing": (None, False), "bare": (None, True)}


def test_address_space(spark):
    rows = [("a", "v=spf1 ip4:10.0.0.0/24 ip4:10.0.0.128/25 ip4:10.0.1.7 -ip4:11.0.0.0/8 ip4:999.0.0.1 -all"), ("b", "v=spf1 +ip4:10.1.2.3/16 -all")]
    out = facts.address_space(facts.spf_ranges(spark.createDataFrame(rows, "key string, raw_spf string")))
    assert {r.key: r.covered for r in out.collect()} == {"a": 257, "b": 65536}


def test_both_address_families(spark):
    """Against ipaddress: what is a range, what it covers, and the widest prefix."""
    texts = [
        "ip6:2001:db8::/32", "ip6:2001:db8:1::/48", "+ip6:2001:DB8:ffff::1", "IP6:::1", "ip6:::/0", "ip6:1:2:3:4:5:6:7::", "ip6:1:2:3:4:5:6:7:8/64", "ip6:::ffff:10.1.2.3/96",
        "ip6:1::2::3", "ip6:1:2:3", "ip6:12345::", "ip6:1:2:3:4:5:6:7:8::", "ip6:::ffff:10.1.2.300", "ip6:2001:db8::/129", "ip6:2001:db8::/", "ip6:10.0.0.0/8", "-ip6:fe80::/10", "ip6:fe80::/10",
        "ip6:g::", "ip6::1", "ip6:1:::2", "ip6:ff00::/8", "ip4:10.0.0.0/8", "ip4:010.0.0.1", "ip4:10.0.0.1/33", "ip4:::1", "ip4:10.0.0.7/032",
    ]
    rng = random.Random(4)
    records = {str(i): rng.sample(texts, rng.randrange(1, 6)) for i in range(80)} | {str(100 + i): [t] for i, t in enumerate(texts)}
    rows = [(k, " ".join(["v=spf1", *v, "-all"])) for k, v in records.items()] + [("none", None), ("bare", "v=spf1 -all")]
    got = {r.key: tuple(r)[1:] for r in facts.spf_spaces(spark.createDataFrame(rows, "key string, raw_spf string")).collect()}
    assert got.keys() == records.keys() | {"bare"} and got["bare"] == (0, None, 0, None)
    for k, terms in records.items():
        nets = {4: [], 6: []}
        for t in terms:
            name, _, value = t.lstrip("+").partition(":")
            try:
                net = ipaddress.ip_network(value, strict=False)
            except ValueError:
                continue
            if name.lower() == f"ip{net.version}":
                nets[net.version].append(net)
        four = sum(n.num_addresses for n in ipaddress.collapse_addresses(nets[4]))
        wide = [n if n.prefixlen <= 64 else n.supernet(new_prefix=64) for n in nets[6]]
        six = sum(n.num_addresses >> 64 for n in ipaddress.collapse_addresses(wide))
        assert got[k] == (four, min((n.prefixlen for n in nets[4]), default=None), six, min((n.prefixlen for n in nets[6]), default=None)), (k, terms)


def test_range_texts_are_read_once(spark):
    """No step is repeated where Spark puts projections together, and what it compiles is small enough for the JVM."""
    df = spark.createDataFrame([("a", "v=spf1 ip4:10.0.0.0/24 ip6:::1 -all")], "key string, raw_spf string")
    for ranges in (facts.spf_ranges, facts.spf_ranges6):
        assert len(ranges(df)._jdf.queryExecution().executedPlan().toString()) < 10_000
        with contextlib.redirect_stdout(io.StringIO()) as out:
            ranges(df).explain("codegen")
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())
        assert sizes and max(map(int, sizes)) < 8_000


def test_keys_with_many_ranges(spark):
    """Keys beyond the limit are swept in parts, with the same result; rows without a key have no ranges."""
    rng = random.Random(5)
    range4 = lambda: f"ip4:10.{rng.randrange(4)}.{rng.randrange(256)}.0/{rng.randrange(14, 33)}"
    range6 = lambda: f"IP6:2001:db8:{rng.randrange(40):x}:{rng.randrange(40):x}::/{rng.randrange(44, 80)}"
    rows = [(k, " ".join(["v=spf1", *(rng.choice((range4, range6))() for _ in range(4)), "-all"])) for k in ["hot"] * 60 + ["warm"] * 12 + [f"k{i}" for i in range(40)] + [None] * 30]
    df = spark.createDataFrame([*rows, ("hot", None), ("none", None), ("bare", "v=spf1 -all")], "key string, raw_spf string")
    assert {r._key for r in facts.many_ranges(df.filter("raw_spf is not null"), "key", "raw_spf", 40).collect()} == {"hot", "warm", None}
    assert facts.many_ranges(df.filter("raw_spf is not null"), "key", "raw_spf", 1_000) is None
    whole, parts = ({r.key: tuple(r)[1:] for r in facts.spf_spaces(df, limit=n).collect()} for n in (100_000, 40))
    assert whole == parts and len(whole) == 44
    assert whole[None] == whole["bare"] == (0, None, 0, None)


def test_ranges_of_one_key_lie_in_many_tasks(spark):
    """A million ranges of one key, in pieces of the order, cover what one sweep says."""
    rows = spark.range(1_000_000).select(F.lit("hot").alias("key"), (F.pmod(F.xxhash64("id"), F.lit(40_000_000))).alias("low"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(60))).alias("n"))
    rows = rows.select("key", "low", (F.col("low") + F.col("n")).alias("high")).union(spark.createDataFrame([("hot", 1_000, 90_000), ("small", 5, 6), ("small", 6, 9)], "key string, low long, high long"))
    got = {r.key: r.covered for r in facts.address_space(rows).collect()}
    ends = rows.filter("key = 'hot'").toPandas().sort_values(["low", "high"])
    before = ends.high.cummax().shift(fill_value=-1)
    assert got == {"hot": int((ends.high - (ends.low - 1).clip(lower=before)).clip(lower=0).sum()), "small": 5}


def test_three_valued_checks(spark):
    rules = spark.createDataFrame([("example",), ("jp.example",)], "rule string")
    f = spark.createDataFrame([("a.example", ["x.r.example", "a.example"]), ("b.example", ["gone.example"]), ("c.example", ["dark.example"])], "domain string, dmarc_rua array<string>")
    answers = spark.createDataFrame(
        [("a.example._report._dmarc.x.r.example", "TXT", True, True, "NOERROR"), ("r.example", "NS", True, True, "NOERROR"), ("b.example._report._dmarc.gone.example", "TXT", True, False, "NXDOMAIN"), ("gone.example", "NS", True, False, "NXDOMAIN"), ("dark.example", "NS", False, None, "SERVFAIL")],
        "name string, qtype string, observed boolean, record_present boolean, rcode string",
    )
    got = {r.domain: (r.rua_authorized, r.rua_domain_unregistered) for r in facts.rua_checks(f, answers, rules).collect()}
    assert got == {"a.example": (True, False), "b.example": (False, True), "c.example": (True, None)}
    m = spark.createDataFrame([("a", True, ["up.example", "off.example"]), ("b", True, ["off.example"]), ("c", True, ["dark.example"])], "domain string, mx_present boolean, mx_hosts array<string>")
    answers = spark.createDataFrame([("up.example", "A", True, True, "NOERROR"), ("off.example", "A", True, False, "NXDOMAIN"), ("off.example", "NS", True, False, "NXDOMAIN"), ("dark.example", "A", False, None, "SERVFAIL")], "name string, qtype string, observed boolean, record_present boolean, rcode string")
    got = {r.domain: (r.mx_hosts_nxdomain, r.mx_unreachable, r.mx_domain_unregistered) for r in facts.mx_reach(m, answers, rules).collect()}
    assert got == {"a": (["off.example"], False, True), "b": (["off.example"], True, True), "c": ([], None, None)}
