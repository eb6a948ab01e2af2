"""Rule-based inference of vendors: matching, confidence, layers, staleness (S13, J5, J6, J25, F-C4 to F-C7, W1 to W4, W11, T2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailposture.functions import classify as C
from mailposture.functions.classify import yes
from mailposture.functions.names import hash_id
from mailposture.operators.tables import short
from mailposture.session import cut

VERIFICATION = "verification_txt"
DEFAULT_CATEGORY = "esp"
DEFAULT_LAYER = {"mail_platform": "platform"}
#: Months without corroboration after which an inference is stale.
STALE_MONTHS = 3
#: Which column of facts holds the values of a record type.
VALUES_OF = {"MX": "mx_hosts", "SPF_INCLUDE": "spf_includes", "SPF_MECHANISM": "spf_mechanisms", "DKIM_CNAME": "dkim_cname_targets", "TXT": "verification_txt", "VERIFICATION_TXT": "verification_txt", "DMARC_RUA_DOMAIN": "dmarc_rua"}

RULE_SCHEMA = (
    "id string, vendor string, product string, category string, record string, pattern string, confidence string, layer string, engine string, "
    "undetectable_reason string, note string, corroborated_by struct<mx_pattern:string,spf_includes:array<string>,dkim_cname:string>"
)
CATEGORIES = ["mail_platform", "security_gateway", "esp", "dmarc_vendor", VERIFICATION]
LAYERS = ["platform", "inbound_gateway", "outbound_gateway"]
#: Rule tables up to this size may be broadcast; larger ones are joined by record type.
BROADCAST_RULES = 20_000


def check_rules(rules: DataFrame) -> DataFrame:
    """(id, problem) of rules that cannot be used: repeated ids, unknown values, empty patterns."""
    rows = rules.withColumn("_n", F.count("*").over(Window.partitionBy("id")))
    has_pattern = F.length("pattern") > 0
    problems = F.array_compact(
        F.array(
            F.when(F.col("_n") > 1, "repeated id"),
            F.when(~F.coalesce(F.col("record").isin(*VALUES_OF), F.lit(False)), "unknown record type"),
            F.when(~F.coalesce(F.col("category").isin(CATEGORIES), F.lit(False)), "unknown category"),
            F.when(~F.coalesce(F.col("confidence").isin(C.CONFIDENCE), F.lit(False)), "unknown confidence"),
            F.when(F.col("layer").isNotNull() & ~F.col("layer").isin(LAYERS), "unknown layer"),
            F.when((F.col("category") == "security_gateway") & F.col("layer").isNull(), "gateway without layer"),
            F.when(~F.coalesce(has_pattern, F.lit(False)), "no pattern"),
            F.when(F.col("undetectable_reason").isNotNull() & ~F.col("undetectable_reason").isin("api_mode_product", "self_hosted_mx", "spf_flattened", "tenant_placeholder_mx", "not_observed"), "unknown reason"),
        )
    )
    return rows.select("id", F.explode(problems).alias("problem")).distinct()


def load_rules(spark, rows: list[dict], version: str | None = None) -> DataFrame:
    """A rule dictionary (parsed from YAML, say) as a table; raises if a rule cannot be used."""
    names = ["id", "vendor", "product", "category", "record", "pattern", "confidence", "layer", "engine", "undetectable_reason", "note", "corroborated_by"]
    plain = [tuple((r.get("layer") or DEFAULT_LAYER.get(r.get("category"))) if k == "layer" else r.get(k, "medium" if k == "confidence" else None) for k in names) for r in rows]
    rules = spark.createDataFrame(plain, RULE_SCHEMA)
    if bad := check_rules(rules).limit(20).collect():
        raise ValueError("unusable rules: " + "; ".join(f"{r['id']}: {r['problem']}" for r in bad))
    return rules.withColumn("fingerprint_version", F.lit(version))


def observed_values(facts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, record, value): every value of a fact that rules look at."""
    present = {r: c for r, c in VALUES_OF.items() if c in facts.columns}
    values = F.array(*[F.struct(F.lit(r).alias("record"), F.coalesce(F.col(c), F.array().cast("array<string>")).alias("v")) for r, c in present.items()])
    spread = facts.select(*keys, F.explode(values).alias("s")).select(*keys, "s.record", F.explode("s.v").alias("value"))
    return spread.filter("value <> ''")


def match_rules(facts: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """Every (rule, observed value) pair that matches, ignoring case; no match stops another.

    Distinct values are matched once, however many facts share them; rules meet values of their record type only.
    """
    values = observed_values(facts, keys)
    distinct = values.select("record", "value").distinct()
    hits = distinct.join(short(rules, BROADCAST_RULES), "record").filter("rlike(value, concat('(?iu)', pattern))")
    record_type = F.when(F.col("category") == VERIFICATION, "VERIFICATION_TXT").otherwise(F.col("record"))
    return values.join(hits, ["record", "value"]).withColumn("record_type", record_type)


def vendor_categories(rules: DataFrame) -> DataFrame:
    """F-C5: (vendor, own_category) by the vendor's first rule that is not about ownership texts."""
    return rules.filter(F.col("category") != VERIFICATION).groupBy("vendor").agg(F.min_by("category", "id").alias("own_category"))


def corroborate(hits: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``corroborated`` to hits: NULL where the rule has no condition, else whether a condition holds."""
    needed = facts.select(*keys, *[F.coalesce(c, F.array().cast("array<string>")).alias(f"_{c}") for c in ("mx_hosts", "spf_includes", "dkim_cname_targets")])
    c = F.col("corroborated_by")
    matches = lambda values, pattern: yes(F.exists(values, lambda v: F.regexp(v, F.concat(F.lit("(?i)"), pattern))))
    holds = matches("_mx_hosts", c["mx_pattern"]) | yes(F.arrays_overlap(F.transform("_spf_includes", lambda x: F.lower(F.trim(x))), c["spf_includes"])) | matches("_dkim_cname_targets", c["dkim_cname"])
    return hits.join(needed, keys, "left").withColumn("corroborated", F.when(c.isNotNull(), holds)).drop("_mx_hosts", "_spf_includes", "_dkim_cname_targets")


def combined_confidence() -> Column:
    """F-C4: aggregate: ownership texts alone are low, a DKIM CNAME is high, two strong types raise by one."""
    declared = F.max(C.confidence_rank(F.col("confidence")))
    types = F.collect_set("record_type")
    strong = F.size(F.filter(types, lambda t: C.priority(t) >= 2))
    only_texts = (F.size(types) == 1) & F.array_contains(types, "VERIFICATION_TXT")
    rank = F.when(only_texts, 0).when(F.array_contains(types, "DKIM_CNAME"), 2).when(strong >= 2, F.least(declared + 1, F.lit(2))).otherwise(declared)
    return C.confidence_of(rank)


def drafts(hits: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """F-C5, F-C6, W2, W3: one row for each (keys, category, layer, vendor) with evidence, strongest first.

    Product: of rules with a product first, then by strength, confidence, pattern length and rule id. Engine: only if
    all hits that name one agree. Reason: only if all hits agree, where no reason is a value of its own.
    """
    own = hits.join(vendor_categories(rules), "vendor", "left")
    text = F.col("category") == VERIFICATION
    category = F.when(text, F.coalesce("own_category", F.lit(DEFAULT_CATEGORY))).otherwise(F.col("category"))
    layer = F.when(text, F.when(F.col("_category") == "mail_platform", "platform")).otherwise(F.col("layer"))
    rows = own.withColumn("_category", category).withColumn("_layer", layer).withColumn("_p", C.priority(F.col("record_type")))
    rank = F.struct(F.col("product").isNotNull(), "_p", C.confidence_rank(F.col("confidence")), F.length("pattern"), "id")
    item = F.struct((-F.col("_p")).alias("o"), F.col("id").alias("rule_id"), F.col("value").alias("matched_value"), "record_type")
    reason = F.coalesce("undetectable_reason", F.lit(""))
    out = rows.groupBy(*keys, F.col("_category").alias("category"), F.col("_layer").alias("layer"), "vendor").agg(
        F.max_by("product", rank).alias("product"),
        combined_confidence().alias("confidence"),
        F.array_sort(F.collect_list(item)).alias("evidence"),
        F.when(F.count_distinct("engine") == 1, F.max("engine")).alias("engine"),
        F.when(F.count_distinct(reason) == 1, F.nullif(F.max(reason), F.lit(""))).alias("undetectable_reason"),
        F.max("_p").alias("strongest"),
        F.count("*").alias("hits"),
        F.bool_and(F.col("record_type") == "VERIFICATION_TXT").alias("only_ownership_text"),
        F.bool_or("corroborated").alias("corroborated"),
    )
    return out.withColumn("evidence", F.transform("evidence", lambda e: F.struct(e["record_type"].alias("record_type"), e["matched_value"].alias("matched_value"), e["rule_id"].alias("rule_id"))))


def mark_primary(inferences: DataFrame, keys: list[str]) -> DataFrame:
    """Add is_layer_primary: the strongest row of each layer; runner-ups stay, flagged false; NULL without layer."""
    order = [F.desc("strongest"), F.desc(C.confidence_rank(F.col("confidence"))), F.desc("hits"), F.asc("category"), F.asc("vendor")]
    first = F.row_number().over(Window.partitionBy(*keys, "layer").orderBy(*order)) == 1
    return inferences.withColumn("is_layer_primary", F.when(F.col("layer").isNotNull(), first))


def stale_streak(inferences: DataFrame, prev: DataFrame | None, keys: list[str]) -> DataFrame:
    """Add stale_streak_months and is_stale to ``drafts``: months in a row without corroboration, stale from three on.

    Only rows that rest on ownership texts alone, with a condition that did not hold, count on; others have no streak.
    """
    on = [*keys, "category", "vendor"]
    if prev is None:
        out = inferences.withColumn("_before", F.lit(0))
    else:
        out = inferences.join(prev.groupBy(*on).agg(F.max("stale_streak_months").alias("_before")), on, "left")
    counts = F.col("only_ownership_text") & yes(~F.col("corroborated"))
    streak = F.when(counts, F.coalesce("_before", F.lit(0)) + 1).cast("int")
    return out.withColumn("stale_streak_months", streak).withColumn("is_stale", yes(F.col("stale_streak_months") >= STALE_MONTHS)).drop("_before")


def sentinels(facts: DataFrame, inferences: DataFrame, keys: list[str]) -> DataFrame:
    """F-C7: a row ``not_detected`` with its reason for each fact without any gateway row."""
    seen = inferences.filter(F.col("category") == "security_gateway").select(*keys).distinct()
    text = F.concat_ws(" ", "spf_includes", "spf_mechanisms", "raw_spf")
    hosted = F.col("is_self_hosted") if "is_self_hosted" in facts.columns else F.lit(False)
    reason = C.undetectable_reason(F.col("observed"), hosted, F.col("spf_is_flattened"), text)
    return facts.join(seen, keys, "left_anti").select(*keys, F.lit("security_gateway").alias("category"), F.lit(C.NOT_DETECTED).alias("vendor"), F.lit("low").alias("confidence"), reason.alias("undetectable_reason"))


def infer(facts: DataFrame, rules: DataFrame, keys: list[str], prev: DataFrame | None = None) -> DataFrame:
    """The whole step: match, corroborate, fold, streak, primary, and the sentinel rows, with hashed ids.

    The folded rows are cut off in the checkpoint folder, since the sentinels look at them again; ``facts`` should be
    a stored table, it is read for values, for corroboration and for the sentinels.
    """
    hits = match_rules(facts, rules, keys)
    if rules.filter("corroborated_by is not null").isEmpty():
        hits = hits.withColumn("corroborated", F.lit(None).cast("boolean"))
    else:
        hits = corroborate(hits, facts, keys)
    rows = cut(mark_primary(stale_streak(drafts(hits, rules, keys), prev, keys), keys))
    out = rows.unionByName(sentinels(facts, rows, keys), allowMissingColumns=True)
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in [*keys, "category", "layer", "vendor"]]
    return out.withColumn("inference_id", hash_id("i", *parts))


def attach_once(inferences: DataFrame, park: DataFrame, key: str) -> DataFrame:
    """Carry park_class on the first inference row of each domain only, so that it is counted once."""
    first = F.row_number().over(Window.partitionBy(key).orderBy("category", "layer", "vendor", "inference_id")) == 1
    return inferences.withColumn("_first", first).join(park.select(key, F.col("park_class").alias("_park")), key, "left").withColumn("park_class", F.when(F.col("_first"), F.col("_park"))).drop("_first", "_park")


def unknown_hosts(hosts: DataFrame, n: int, name: str = "registered_domain", host: str = "host") -> DataFrame:
    """The ``n`` most frequent names with three examples, and a row (NULL name) that counts what was left out.

    ``hosts`` has a row for each occurrence that no rule matched, other than self-hosted and non-existing hosts.
    """
    counts = hosts.groupBy(name).agg(F.count("*").alias("count"), F.slice(F.array_sort(F.collect_set(host)), 1, 3).alias("examples"))
    listed = counts.orderBy(F.desc("count"), name).limit(n)
    # The remainder by difference of two sums: no global numbering of all names.
    total = counts.agg(F.count("*").alias("names"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows"))
    shown = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum("count"), F.lit(0)).alias("r"))
    rest = total.crossJoin(shown).select(F.lit(None).cast("string").alias(name), (F.col("rows") - F.col("r")).alias("count"), F.array().cast("array<string>").alias("examples"), (F.col("names") - F.col("n")).alias("omitted_names"))
    return listed.withColumn("omitted_names", F.lit(None).cast("long")).unionByName(rest)


def selectors_for(domains: DataFrame, providers: DataFrame, core: list[str], keys: list[str]) -> DataFrame:
    """(keys, selectors): those of matching providers in provider order, then the core list, each once.

    ``providers`` has (rank, record, pattern, selectors), a short table; ``domains`` has the value columns of facts.
    """
    hits = observed_values(domains, keys).join(short(providers), "record").filter("rlike(value, concat('(?i)', pattern))")
    own = hits.groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_set(F.struct("rank", "selectors"))), lambda s: s["selectors"])).alias("_own"))
    wanted = F.array_distinct(F.concat(F.coalesce("_own", F.array().cast("array<string>")), F.array(*[F.lit(s) for s in core])))
    return domains.select(*keys).distinct().join(own, keys, "left").select(*keys, wanted.alias("selectors"))
