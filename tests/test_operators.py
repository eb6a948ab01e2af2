"""Operators on hand-made rows: rules, statistics, populations, candidates, views, text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mailposture.functions import classify as C
from mailposture.functions import names as N
from mailposture.functions import text as T
from mailposture.operators import candidates, compare, facts, population, rules, stats, views

DAY = dt.date(2026, 1, 1)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- rules

DICTIONARY = [
    {"id": "p1", "vendor": "P", "product": "Suite", "category": "mail_platform", "record": "MX", "pattern": r"\.p\.example$", "confidence": "medium"},
    {"id": "p2", "vendor": "P", "category": "mail_platform", "record": "SPF_INCLUDE", "pattern": r"^spf\.p\.example$", "confidence": "low"},
    {"id": "p3", "vendor": "P", "category": "verification_txt", "record": "VERIFICATION_TXT", "pattern": "^p-verify=", "confidence": "low", "corroborated_by": ("p.example$", ["spf.p.example"], None)},
    {"id": "q1", "vendor": "Q", "product": "Gate", "category": "security_gateway", "record": "MX", "pattern": r"\.q\.example$", "confidence": "high", "layer": "inbound_gateway", "engine": "e1"},
    {"id": "q2", "vendor": "Q", "category": "security_gateway", "record": "MX", "pattern": r"gate.*\.q\.example$", "confidence": "high", "layer": "inbound_gateway", "engine": "e2"},
    {"id": "t1", "vendor": "T", "category": "mail_platform", "record": "MX", "pattern": r"\.invalid$", "confidence": "low", "undetectable_reason": "tenant_placeholder_mx"},
    {"id": "d1", "vendor": "D", "category": "mail_platform", "record": "DKIM_CNAME", "pattern": "d.example$", "confidence": "low"},
]
FACT = "k int, observed boolean, mx_hosts array<string>, spf_includes array<string>, spf_mechanisms array<string>, dkim_cname_targets array<string>, verification_txt array<string>, dmarc_rua array<string>, spf_is_flattened boolean, raw_spf string"


def fact(k, mx=(), spf=(), cname=(), txt=(), observed=True, flat=False, raw=None):
    return (k, observed, list(mx), list(spf), [], list(cname), list(txt), [], flat, raw)


def test_inference(spark):
    f = spark.createDataFrame(
        [
            fact(1, mx=["MX.P.example"], spf=["spf.p.example"]),
            fact(2, txt=["p-verify=1"]),
            fact(3, mx=["gate1.q.example", "x.p.example"]),
            fact(4, mx=["t.invalid"]),
            fact(5, cname=["s.d.example"]),
            fact(6, observed=False),
            fact(7, flat=True),
            fact(8, raw="v=spf1 include:_spf.vali.email"),
        ],
        FACT,
    )
    table = rules.load_rules(spark, DICTIONARY, "v1")
    got = {(r.k, r.vendor): r for r in rules.infer(f, table, ["k"]).collect()}
    # A strong pair of record types raises the confidence by one.
    assert got[1, "P"].confidence == "high" and got[1, "P"].product == "Suite" and got[1, "P"].hits == 2
    assert [e.record_type for e in got[1, "P"].evidence] == ["MX", "SPF_INCLUDE"]
    # An ownership text alone is low, takes the vendor's own category, and is uncorroborated for its first month.
    text = got[2, "P"]
    assert (text.confidence, text.category, text.layer, text.stale_streak_months, text.is_stale) == ("low", "mail_platform", "platform", 1, False)
    # Both gateway rules of one vendor are hits of one row; two engines mean none.
    assert (got[3, "Q"].hits, got[3, "Q"].engine, got[3, "Q"].is_layer_primary) == (2, None, True)
    assert got[4, "T"].undetectable_reason == "tenant_placeholder_mx"
    assert got[5, "D"].confidence == "high"
    reasons = {k: got[k, "not_detected"].undetectable_reason for k in (1, 2, 6, 7, 8)}
    assert reasons == {1: "api_mode_product", 2: "api_mode_product", 6: "not_observed", 7: "spf_flattened", 8: "spf_flattened"}
    assert (3, "not_detected") not in got
    before = spark.createDataFrame([(2, "mail_platform", "P", 2)], "k int, category string, vendor string, stale_streak_months int")
    later = {(r.k, r.vendor): r for r in rules.infer(f, table, ["k"], before).collect()}
    assert (later[2, "P"].stale_streak_months, later[2, "P"].is_stale) == (3, True)
    assert len({r.inference_id for r in got.values()}) == len(got)


def test_corroborated_texts_have_no_streak(spark):
    f = spark.createDataFrame([fact(1, mx=["a.p.example"], txt=["p-verify=1"]), fact(2, spf=["SPF.p.example"], txt=["p-verify=1"])], FACT)
    table = rules.load_rules(spark, [DICTIONARY[2]], "v1")
    hits = rules.corroborate(rules.match_rules(f, table, ["k"]), f, ["k"])
    assert rows(hits, "k", "corroborated") == [(1, True), (2, True)]


def test_rules_are_checked(spark):
    bad = [{**DICTIONARY[0], "id": "x"}, {**DICTIONARY[0], "id": "x", "record": "A"}, {**DICTIONARY[3], "id": "y", "layer": None}, {**DICTIONARY[0], "id": "z", "pattern": "", "confidence": "sure"}]
    with pytest.raises(ValueError, match="unusable"):
        rules.load_rules(spark, bad)
    with pytest.raises(ValueError, match="gateway without layer"):
        rules.load_rules(spark, bad[2:3])


def test_unknown_hosts_count_the_rest(spark):
    hosts = spark.createDataFrame([(f"d{i % 5}", f"h{i}") for i in range(23)], "registered_domain string, host string")
    out = {r.registered_domain: r for r in rules.unknown_hosts(hosts, 2).collect()}
    assert set(out) == {"d0", "d1", None} and out[None]["count"] == 13 and out[None].omitted_names == 3 and len(out["d0"].examples) == 3


# ---------------------------------------------------------------- statistics


@pytest.mark.parametrize(
    ("counts", "hidden"),
    [({"a": 5, "b": 5, "c": 5}, set()), ({"a": 4, "b": 4, "c": 50}, {"a", "b"}), ({"a": 4, "b": 9, "c": 7, "d": 7}, {"a", "c"}), ({"a": 2}, {"a"})],
)
def test_suppression(spark, counts, hidden):
    df = spark.createDataFrame([("p", c, n) for c, n in counts.items()], "pop string, code string, n int")
    plan = stats.suppression_plan(df, "pop", "code")
    assert {r.code for r in plan.collect() if r.suppressed} == hidden
    row = stats.is_recoverable(plan, "pop").first()
    assert row.recoverable == (len(hidden) == 1 or 0 < sum(counts[c] for c in hidden) < 5)


def test_metrics_keep_unknown_apart(spark):
    base = {"domain_id": "d", "entity_id": "e", "observed": True, "spf_present": True, "dmarc_present": True}
    data = [
        {**base, "domain_id": "1", "effective_7489": "reject", "dmarc_p": "reject", "dmarc_rua": ["r.example.com"], "mta_sts_present": True, "mta_sts_policy_status": "ok", "mta_sts_mode": "enforce"},
        {**base, "domain_id": "2", "entity_id": "f", "effective_7489": "quarantine_partial", "dmarc_p": "quarantine", "dmarc_rua": ["r.net"], "mta_sts_present": None, "mta_sts_policy_status": None, "mta_sts_mode": None},
        {**base, "domain_id": "3", "observed": False, "effective_7489": "reject", "dmarc_p": "reject", "dmarc_rua": None, "mta_sts_present": None, "mta_sts_policy_status": None, "mta_sts_mode": None},
    ]
    schema = "domain_id string, entity_id string, observed boolean, spf_present boolean, dmarc_present boolean, effective_7489 string, dmarc_p string, dmarc_rua array<string>, mta_sts_present boolean, mta_sts_policy_status string, mta_sts_mode string"
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in data], schema).withColumn("g", F.lit(1))
    totals = spark.createDataFrame([(1, 9), (2, 4)], "g int, total_entities int")
    out = {r.g: r for r in stats.stats_overall(stats.derive_domain_row(df), ["g"], totals).collect()}
    one = out[1]
    assert (one.total_entities, one.total_domains, one.observed_domains, one.entities_with_domains) == (9, 3, 2, 2)
    assert (one.dmarc_enforced_domains, one.dmarc_enforced_entities, one.rua_placeholder_domains) == (1, 1, 1)
    assert one.mta_sts_enforce_domains == 1
    # Never measured: not zero.
    assert one.spf_lookup_exceeded_domains is None and one.txt_apex_oversize_domains is None and one.park_defense_rate is None and one.evidence_dkim_hint_entities is None
    assert out[2].total_entities == 4 and out[2].total_domains is None
    unfetched = stats.stats_overall(stats.derive_domain_row(df.withColumn("mta_sts_policy_status", F.lit(None).cast("string"))), ["g"]).first()
    assert unfetched.mta_sts_domains == 1 and unfetched.mta_sts_enforce_domains is None


def test_platform_bundles_by_set_union(spark):
    data = [("p", "platform", "A", f"e{i}", f"d{i}", "x", True) for i in range(6)] + [("p", "platform", v, "e0", "d0", None, False) for v in ("B", "C")]
    out = {r.vendor: r for r in stats.stats_platform(spark.createDataFrame(data, "pop string, layer string, vendor string, entity_id string, domain_id string, engine string, receiving boolean"), "pop").collect()}
    assert out["A"].entities_any == 6 and out["A"].engine == "x" and out["A"].domains_receiving == 6
    assert out["other_suppressed"].entities_any == 1 and out["other_suppressed"].identified_entities == 6
    summary = stats.platform_summary(spark.createDataFrame(list(out.values()))).first()
    assert (summary.vendors, summary.suppressed_entities) == (2, 1)


def test_delta(spark):
    schema = "domain_id string, observed boolean, effective_7489 string, has_rua boolean, record_present boolean"
    q = spark.createDataFrame([("gone", True, "none", False, True)], schema)
    p = spark.createDataFrame([("up", True, None, False, False), ("same", True, "quarantine_partial", True, True), ("dark", True, "reject", True, True), ("gone", True, None, False, False), ("left", True, "none", False, True)], schema)
    c = spark.createDataFrame([("up", True, "reject", True, True), ("same", True, "quarantine", False, True), ("dark", False, None, None, None), ("gone", True, None, False, False), ("new", True, "none", False, True)], schema)
    row = stats.delta_counts(stats.monthly_delta(c, p, q)).first()
    assert (row.domains_new, row.domains_unobserved_this_month, row.policy_upgraded, row.policy_downgraded, row.rua_added, row.rua_removed, row.domains_disappeared) == (1, 2, 2, 0, 0, 1, 1)
    assert stats.delta_counts(stats.monthly_delta(c, p)).first().domains_disappeared is None
    assert rows(stats.transition_matrix(stats.monthly_delta(c, p)), "transition", "domains") == [("no_dmarc>no_dmarc", 1), ("no_dmarc>reject", 1), ("quarantine>quarantine", 1)]
    versions = lambda *r: spark.createDataFrame(list(r), "phase string, key string, value string")
    changed = stats.version_changes(versions(("p5", "config_hash", "b"), ("p5", "tool", "2")), versions(("p5", "config_hash", "a"), ("p5", "tool", "2"), ("p4", "tool", "1")))
    assert rows(changed, "phase", "key", "before", "after", "kind") == [("p4", "tool", "1", None, "version"), ("p5", "config_hash", "a", "b", "config")]
    assert stats.version_changes(versions(("p5", "tool", "2")), versions(("p", "k", "v")).limit(0)).count() == 0


# ---------------------------------------------------------------- classification and names


def test_park_classes(spark):
    cases = [
        (True, True, False, True, True, "-", "reject", "hardened_parked"),
        (True, False, False, True, True, "~", "quarantine", "defended_parked"),
        (True, False, False, True, True, "-", "none", "intentional_no_send"),
        (True, False, False, False, False, None, None, "neglected"),
        (True, False, True, True, False, None, None, "active_sending"),
        (True, False, True, False, False, None, None, "inconsistent"),
        (True, False, False, True, False, "?", None, "inconsistent"),
        (False, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(cases, "o boolean, n boolean, m boolean, s boolean, d boolean, q string, e string, want string")
    assert df.filter(~C.park_class(*[F.col(c) for c in "onmsdqe"]).eqNullSafe(F.col("want"))).count() == 0


def test_three_valued_any(spark):
    df = spark.createDataFrame([([True, None],), ([False, None],), ([False],), ([],)], "v array<boolean>")
    assert [r.a for r in df.select(C.any_true(F.col("v")).alias("a")).collect()] == [True, None, False, False]


def test_names(spark):
    df = spark.createDataFrame([("株式会社ＡＢＣ・ホールディングス",), ("The ACME Company, Inc.",), ("Holdings Group",), ("",), (None,)], "n string")
    assert [r.f for r in df.select(N.fold_name(F.col("n")).alias("f")).collect()] == ["abcホールディングス", "theacme", "", "", ""]
    hosts = spark.createDataFrame([("a.b.co.jp",), ("co.jp",), ("www.ck",), ("a.b.ck",), ("b.ck",), ("x.github.io",), ("a.unknown",), ("com",), (None,)], "h string")
    suffix = spark.createDataFrame([(r,) for r in ("com", "jp", "co.jp", "*.ck", "!www.ck", "github.io")], "rule string")
    got = {r.h: r.registrable for r in N.registrable(hosts, "h", suffix).collect()}
    assert got == {"a.b.co.jp": "b.co.jp", "co.jp": None, "www.ck": "www.ck", "a.b.ck": "a.b.ck", "b.ck": None, "x.github.io": "x.github.io", "a.unknown": "a.unknown", "com": None, None: None}
    codes = spark.createDataFrame([("72030", "1234567890123", "320193"), ("7203", "12-3", "x")], "s string, c string, k string")
    assert rows(codes.select(N.securities_code(F.col("s")).alias("s"), N.digits(F.col("c"), 13).alias("c"), N.cik_key(F.col("k")).alias("k")), "s", "c", "k") == [("7203", "1234567890123", "0000320193"), ("7203", None, None)]
    urls = spark.createDataFrame([("www.Example.com./x",), ("https://u:p@Host.example:8080/?q",), ("http://bad host/",), (" ",)], "u string")
    assert [r.h for r in urls.select(N.url_host(F.col("u")).alias("h")).collect()] == ["www.example.com", "host.example", None, None]
    pairs = spark.createDataFrame([("Brookfield Infrastructure", "brookfield.com", True), ("The Trust Company", "trust.com", False), ("Toyota", "toy-ota.co.jp", True), ("IBM", "ibm.com", True)], "n string, d string, w boolean")
    assert pairs.filter(N.name_in_domain(F.col("n"), F.col("d")) != F.col("w")).count() == 0
    agree = spark.createDataFrame([("Acme Steel Inc", "ACME Steel", True), ("Acme", "Acme Steel", True), ("Blue Sky", "Bluesky", True), ("Acme Steel", "Acme Paper", False), ("Inc", "Inc", False)], "a string, b string, w boolean")
    assert agree.filter(N.names_agree(F.col("a"), F.col("b")) != F.col("w")).count() == 0


def test_text(spark):
    page = '<html><head><title>Acme &amp; Sons | Home</title><meta property="og:site_name" content="Acme"></head><body><a href="https://www.other.co.jp/x">o</a> <a href=\'http://a.acme.example/\'>a</a><a HREF="/rel">r</a><p>Visit our website at<b>www.acme.com</b>.</p> About Acme Steel. www.wire.com press@news.acme.com</body></html>'
    df = spark.createDataFrame([(1, page, "Acme Steel Inc")], "k int, html string, name string")
    row = df.select(T.link_hosts(F.col("html")).alias("l"), T.title(F.col("html")).alias("t"), T.plain_text(F.col("html")).alias("p"), T.redirect_target(F.lit('<META http-equiv="Refresh" content="0; url=/jp/index.html">'), F.lit("acme.com")).alias("r")).first()
    assert row.l == ["www.other.co.jp", "a.acme.example"] and row.t == "Acme&Sons|HomeAcme" and "at www.acme.com" in row.p and row.r == "https://acme.com/jp/index.html"
    suffix = spark.createDataFrame([("com",), ("jp",), ("co.jp",), ("example",)], "rule string")
    third = spark.createDataFrame([("wire.com",)], "domain string")
    assert rows(T.stated_domains(df, suffix, third, "k", "html", "name"), "registrable", "times") == [("acme.com", 1)]
    assert rows(T.release_domains(df, suffix, third, "k", "html"), "registrable") == [("acme.com",)]
    assert rows(T.link_domains(df, suffix, "k", "html"), "registrable", "pos") == [("acme.example", 1), ("other.co.jp", 0)]
    notice = spark.createDataFrame([("目次 公告掲載方法 … " + "x" * 500 + "公告掲載方法 電子公告 https://www.acme.co.jp/koukoku/ 日本経済新聞",)], "t string")
    row = notice.select(T.notice_hosts(F.col("t")).alias("h"), T.newspaper_notice(F.col("t")).alias("n")).first()
    assert row.h == ["www.acme.co.jp"] and row.n is False
    wiki = "{{基礎情報 会社\n|市場情報={{上場情報|東証|7203}}\n|外部リンク=[https://global.toyota/ x] {{URL|a.example}}\n|x=1}}\n== 構成銘柄一覧 ==\n{|\n| 7203 || Toyota\n| 285A || Kioxia\n|}\n== 次 ==\n| 9999 || no"
    row = spark.createDataFrame([(wiki,)], "w string").select(T.infobox(F.col("w"), "基礎情報 会社").alias("b"), T.constituent_codes(F.col("w"), "構成銘柄一覧").alias("c")).withColumns({"m": T.infobox_field(F.col("b"), "市場情報"), "e": T.external_link(T.infobox_field(F.col("b"), "外部リンク"))}).withColumn("ok", T.code_listed(F.col("m"), F.lit("7203"))).first()
    assert row.c == ["7203", "285A"] and row.m == "{{上場情報|東証|7203}}" and row.e == "https://global.toyota/" and row.ok
    kana = spark.createDataFrame([("オヤデンキサービス", "oyadenkiservice"), ("トヨタ", "toyota"), ("ニッポン", "nippon"), ("キャノン", "kyanon"), ("シャープ", "shapu")], "k string, w string")
    assert kana.filter(T.kana_latin(F.col("k"), {"サービス": "service"}) != F.col("w")).count() == 0
    places = spark.createDataFrame([("東京都千代田区", "東京都"), ("大阪市北区", "大阪府"), ("京都 中京区", "京都府"), ("海外", None)], "a string, w string")
    assert places.filter(~T.prefecture(F.col("a")).eqNullSafe(F.col("w"))).count() == 0
    report = "関係会社の状況 …12 【関係会社の状況】 (連結子会社) 株式会社エービー 東京都 シーディー株式会社 (持分法適用関連会社) 外部株式会社 【従業員の状況】 他社株式会社"
    assert spark.createDataFrame([(report,)], "t string").select(T.subsidiary_names(F.col("t"), F.lit("自社株式会社")).alias("n")).first().n == ["株式会社エービー", "シーディー株式会社"]
    body = spark.createDataFrame([(bytearray("<meta charset=Shift_JIS>日本".encode("cp932")), None), (bytearray("日本".encode()), None), (bytearray("日本".encode("euc_jp")), "EUC-JP"), (bytearray("日本".encode("cp932")), None)], "b binary, h string")
    assert [r.t[-2:] for r in body.select(T.decode_page(F.col("b"), F.col("h")).alias("t")).collect()] == ["日本"] * 4
    assert spark.range(1).select(T.organisation_matches(F.lit("ACME STEEL, Inc."), F.lit("Acme Steel Corporation")).alias("o"), T.parent_mentioned(F.lit("Acme Steel of Acme"), F.lit("Acme"), F.lit("Acme Steel")).alias("p"), T.sibling_domains(F.lit("acme-hd.co.jp"), ["co.jp", "jp"]).alias("s")).first().asDict() == {"o": True, "p": True, "s": ["acme-hd.jp", "acme.co.jp", "acme.jp"]}


# ---------------------------------------------------------------- populations, candidates, views


def test_merge_follows_chains_and_guards_names(spark):
    schema = "row_id string, rank int, lei string, cik string, corporate_number string, name_normalized string, official_domain string, population_ids array<string>"
    old = spark.createDataFrame([("a", 0, "L1", None, None, "acme", None, ["x"]), ("b", 0, None, None, None, "solo", None, ["x"]), ("c", 0, "L9", None, None, "twin", None, ["x"])], schema)
    new = spark.createDataFrame([("d", 1, "l1 ", "7", None, "other", "d.example", ["y"]), ("e", 1, None, "7", "N1", "third", None, ["z"]), ("f", 1, None, None, None, "solo", None, ["y"]), ("g", 1, None, None, None, "twin", None, ["y"])], schema)
    got = {r.row_id: r for r in population.merge_entities(old, new).collect()}
    assert set(got) == {"a", "b", "c", "g"}
    assert (got["a"].population_ids, got["a"].official_domain, got["a"].cik, got["a"].corporate_number, got["a"].name_normalized, got["a"].merged_rows) == (["x", "y", "z"], "d.example", "7", "N1", "acme", 3)
    assert got["b"].population_ids == ["x", "y"]


def test_population_choices(spark):
    filers = spark.createDataFrame([("6770", [], "A"), ("1000", [], "Blue Acquisition Corp"), ("6221", [], "Gold Trust"), ("6189", [], "x"), ("1", ["N-CSR", "10-K"], "Fund"), ("1", ["N-2", "10-K"], "BDC"), (None, None, "Acme")], "sic string, forms array<string>, name string")
    kept, gone = population.split_non_operating(filers)
    assert rows(kept, "name") == [("Acme",), ("BDC",)] and {r.reason for r in gone.collect()} == {"spac", "commodity_trust", "passive_trust", "registered_fund"}
    known = spark.createDataFrame([("e1", "old.example", None), ("e2", None, None), ("e3", None, None)], "entity_id string, official_domain string, alt_domains array<string>")
    scan = spark.createDataFrame([("e1", "new.example"), ("e2", "s.example"), ("e3", "s.example"), ("e2", None)], "entity_id string, domain string")
    assert rows(population.prefer_filing(known, scan), "entity_id", "official_domain", "alt_domains") == [("e1", "new.example", ["old.example"]), ("e2", None, []), ("e3", None, [])]
    stated = population.fill_from_stated(known.drop("alt_domains"), scan.filter("domain is not null"), F.col("entity_id") == "e3")
    assert rows(stated, "entity_id", "official_domain") == [("e1", "old.example"), ("e2", None), ("e3", "s.example")]
    registry = spark.createDataFrame([("acme", "Tokyo", "1", "u1"), ("acme", "Osaka", "2", ""), ("solo", "Kyoto", "3", "u3"), ("two", "A", "4", "x"), ("two", "A", "5", "y")], "name_normalized string, prefecture string, number string, url string")
    asked = spark.createDataFrame([("acme", "Tokyo"), ("acme", "Osaka"), ("acme", None), ("solo", None), ("two", "A"), ("none", None)], "name_normalized string, prefecture string")
    got = {(r.name_normalized, r.prefecture): (r.outcome, r.number) for r in population.lookup_name(asked, registry).collect()}
    assert got == {("acme", "Tokyo"): ("found", "1"), ("acme", "Osaka"): ("no_url", "2"), ("acme", None): ("ambiguous", None), ("solo", None): ("found", "3"), ("two", "A"): ("ambiguous", None), ("none", None): ("not_found", None)}
    derived = population.add_derived(spark.createDataFrame([("1", None, ["p"]), ("2", "1", ["p"]), ("3", None, ["p"])], "code string, parent string, population_ids array<string>"), spark.createDataFrame([("1",)], "code string"), "idx", ["code", "parent"], (2, 2))
    assert [r[1] for r in rows(derived, "code", "population_ids")] == [["idx", "p"], ["idx", "p"], ["p"]]
    with pytest.raises(ValueError, match="expected"):
        population.add_derived(derived, spark.createDataFrame([("9",)], "code string"), "none", ["code"], (1, 1))
    sources = [("registry", spark.createDataFrame([("e1", "x", None)], "entity_id string, site string, tel string")), ("filing", spark.createDataFrame([("e1", "y", "1"), ("e2", None, "2")], "entity_id string, site string, tel string"))]
    filled = population.coalesce_sources(spark.createDataFrame([("e1", None, None), ("e2", "own", None)], "entity_id string, site string, tel string"), sources, "entity_id", ["site", "tel"])
    assert rows(filled, "entity_id", "site", "site_source", "tel", "tel_source") == [("e1", "x", "registry", "1", "filing"), ("e2", "own", "own", "2", "filing")]
    assert rows(population.provenance(filled, "tel"), "source", "rows") == [("filing", 2)]
    articles = spark.createDataFrame([("Acme", ["7203"], "acme.example"), ("Acme (企業)", ["1"], "no.example"), ("Beta", ["2"], "b.example"), ("Gamma", ["3"], "b.example")], "title string, codes array<string>, domain string")
    companies = spark.createDataFrame([("e1", "7203", ["Acme", "Acme (企業)"]), ("e2", "2", ["Beta"]), ("e3", "3", ["Gamma"])], "entity_id string, code string, titles array<string>")
    assert rows(population.article_sites(articles, companies), "entity_id", "domain") == [("e1", "acme.example")]
    guesses = spark.createDataFrame([("e1", ["a", "b", "c"]), ("e2", ["z"]), ("e3", ["a"])], "entity_id string, guesses array<string>")
    pages = spark.createDataFrame([("a", "nothing"), ("b", "e1 here"), ("c", "e1 too")], "domain string, html string")
    assert rows(population.confirm_guesses(guesses, pages, F.contains(F.col("html"), F.col("entity_id"))), "entity_id", "domain", "outcome") == [("e1", "b", "confirmed"), ("e2", None, "no_page"), ("e3", None, "page_without_name")]
    ids = spark.createDataFrame([("l1", "jp:1"), (None, "jp:2")], "lei string, entity_id string")
    assert rows(population.promote_id(ids), "entity_id", "is_duplicate_of") == [("jp:2", None), ("lei:L1", "jp:1")]


def test_enrichment_from_a_table(spark):
    source = spark.createDataFrame([("n", f"s{i:02}") for i in range(30, 0, -1)] + [("n", None), (None, "a"), ("m", None)], "of string, site string")
    asked = spark.createDataFrame([(i, "n", None) for i in range(20)] + [(20, "m", None), (21, None, None), (22, "n", "own")], "id int, of string, site string")
    step = population.from_table(source, "of", "id", "site")
    assert rows(step(asked.filter("site is null")), "id", "site") == sorted(((i, "s01") for i in range(20)), key=repr)
    filled = population.enrich(asked, "id", "site", [("table", step)])
    assert rows(population.provenance(filled, "site"), "source", "rows") == [("missing", 2), ("own", 1), ("table", 20)]


def test_candidates(spark):
    links = [("e1", "a", "b", True, True, False), ("e1", "a", "a", True, True, True), ("e1", "a", "c", False, True, False), ("e2", "x", "b", True, False, False), ("e3", "y", "a", True, True, False)]
    companies = spark.createDataFrame([("e1", "a"), ("e2", "x"), ("e3", "y")], "entity_id string, official_domain string")
    out = candidates.same_company_links(spark.createDataFrame(links, "entity_id string, source string, target string, has_mx boolean, names_company boolean, links_back boolean"), companies, k=3)
    assert rows(out, "entity_id", "target") == [("e1", "b")]
    names = spark.createDataFrame([("e", "x.example", n) for n in ("mail.x.example", "MX1.x.example", "mail-out.sub.x.example", "www.x.example", "mail.a.b.x.example", "mailer.x.example", "x.example", "mailx.example")], "entity_id string, apex string, name string")
    assert [r[0] for r in rows(candidates.mail_names(names), "name")] == ["mail-out.sub.x.example", "mail.x.example", "mx1.x.example"]
    certs = spark.createDataFrame([("ACME  Inc", "a.example"), ("acme inc", "b.example"), ("Acme Inc.", "c.example"), ("acme inc", None)], "organisation string, registrable string")
    kept, over = candidates.org_certs(certs, spark.createDataFrame([("e1", " Acme Inc")], "entity_id string, name string"), 1)
    assert rows(kept, "registrable") == [("a.example",)] and rows(over, "left_out") == [(1,)]
    pops = spark.createDataFrame([(["a", "b"],), (["b"],)], "population_ids array<string>")
    assert candidates.common_population(pops) == "b" and candidates.common_population(pops.limit(0)) == "mixed"
    registry = spark.createDataFrame([("domain", "X.example"), ("entity", "e9")], "kind string, value string")
    rows_in = spark.createDataFrame([("x.example", "e1"), ("a.x.example", "e1"), ("ax.example", "e1"), ("y.example", "e9"), ("z.example", "e1")], "domain string, entity_id string")
    assert rows(candidates.exclude(rows_in, registry, entity="entity_id"), "domain") == [("ax.example",), ("z.example",)]
    wild = facts.demote_wildcard(spark.createDataFrame([("mail.a", "a", True, True), ("mail.b", "b", True, True), ("own.a", "a", False, True)], "domain string, apex string, guessed boolean, mx_exists boolean"), spark.createDataFrame([("wildcard-check-0000.a", "MX", True, True), ("wildcard-check-0000.b", "MX", False, None)], "name string, qtype string, observed boolean, record_present boolean"))
    assert rows(wild, "domain", "mx_exists", "wildcard_mx") == [("mail.a", False, True), ("mail.b", True, None), ("own.a", True, True)]


def test_views_and_gates(spark):
    df = spark.createDataFrame([(1, "A", ["p"]), (2, "B", ["q"]), (3, None, ["p", "q"])], "i int, c string, population_ids array<string>")
    assert views.apply_view(df, ["p"]).count() == 2 and views.apply_view(df, None, c=["A"]).count() == 1
    assert rows(views.summarize(df, "c", "c"), "code", "n", "share")[0] == ("(unclassified)", 1, 0.3333)
    with pytest.raises(ValueError, match="identifying"):
        views.assert_public(df.withColumn("domain", F.lit("x")))
    with pytest.raises(ValueError, match="undeclared"):
        views.assert_excluded_list(df)
    assert rows(views.credits(spark.createDataFrame([("a",), ("b",)], "population_id string"), spark.createDataFrame([("a", ["S1", "S2"]), ("b", ["S2", "S3"]), ("c", ["S9"])], "population_id string, credits array<string>")), "credit", "place") == [("S1", 1), ("S2", 2), ("S3", 3)]
    domains = spark.createDataFrame([("d1", "x.example", "e1"), ("d2", "y.example", "e9")], "domain_id string, domain string, entity_id string")
    f = spark.createDataFrame([("d1", True, None)], "domain_id string, spf_present boolean, dmarc_present boolean")
    inf = spark.createDataFrame([("d1", "platform", "P", True), ("d1", "platform", "Q", False)], "domain_id string, layer string, vendor string, is_layer_primary boolean")
    out = {r.domain_id: r for r in views.drilldown(domains, f, spark.createDataFrame([("e1", "Acme")], "entity_id string, name string"), inf, ["platform", "inbound_gateway"]).collect()}
    assert (out["d1"].name, out["d1"].platform, out["d1"].spf_present_label, out["d1"].dmarc_present_label, out["d2"].platform) == ("Acme", "P", "yes", "unknown", None)
    raw = spark.createDataFrame([("x.example", "mx", "x.example", "NOERROR")], "domain string, purpose string, query_name string, rcode string")
    fact_ = spark.createDataFrame([("x.example", "d1", "p", 1, "reject")], "domain string, domain_id string, population_id string, sector_code int, effective_7489 string")
    traced = views.trace(raw, fact_, spark.createDataFrame([("d1", "esp", "V", "low")], "domain_id string, category string, vendor string, confidence string"), spark.createDataFrame([("p", 1, False)], "population_id string, sector_code int, suppressed boolean"), "x.example").first()
    assert (traced.suppressed, traced.answers[0].purpose, traced.inferences[0].vendor) == (False, "mx", "V")


def test_streaks_skip_months_without_a_list(spark):
    by = spark.createDataFrame([(m, n, 1) for m, n in [(1, "a"), (2, "a"), (4, "a"), (1, "b"), (4, "b"), (4, "c")]], "month int, registered_domain string, count int")
    months = spark.createDataFrame([(1, False), (2, True), (4, False)], "month int, truncated boolean")
    assert rows(views.unknown_streak(by, months), "registered_domain", "months_unknown", "streak_uncertain", "is_stale") == [("a", 3, False, True), ("b", 1, True, False), ("c", 1, True, False)]


def test_saturation_and_percentiles(spark):
    hits = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s2", "b"), ("s3", "c"), ("s3", "a"), ("s3", "b")], "s string, d string")
    curve = compare.saturation(hits, "s", "d", ["s1", "s2", "s3", "s4"])
    assert rows(curve, "used", "item", "hits", "new_domains", "cumulative_domains", "dead") == [(1, "s1", 2, 2, 2, False), (2, "s2", 1, 0, 2, True), (3, "s3", 3, 1, 3, False), (4, "s4", 0, 0, 3, True)]
    row = curve.crossJoin(curve.agg(F.max("cumulative_domains").alias("total"))).agg(compare.coverage(curve, 1).alias("c"), compare.items_for(0.9).alias("i")).first()
    assert (row.c, row.i) == (0.6667, 3)
    ten = spark.createDataFrame([(i,) for i in range(10)], "v long")
    assert tuple(compare.percentiles(ten, "v").first()) == (10, 4, 9, 9, 4.5)
    assert compare.percentiles(ten.limit(0), "v", ["v"]).count() == 0
    assert compare.sample_targets(ten, "v", 0.01).count() == 1 and compare.sample_targets(ten.limit(0), "v", 0.5).count() == 0
    assert rows(compare.sample_targets(ten, "v", 0.3, 1), "v") == rows(compare.sample_targets(ten.repartition(3), "v", 0.3, 1), "v")
    sel = spark.createDataFrame([("S1._domainkey.x",), ("x",)], "q string").select(compare.selector_of(F.col("q")).alias("s")).collect()
    assert [r.s for r in sel] == ["s1", None]
