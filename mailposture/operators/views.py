"""Views, lineage, disclosure gates, credits, lints and lists for people."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailposture.functions.classify import finding_codes, yes
from mailposture.functions.names import suffixes
from mailposture.operators.tables import must_be_short, short

#: Letters of a term by which long lists of terms meet the texts, and terms up to which a list is short.
SEED, FEW_TERMS = 4, 1000

# Columns that may not leave in published tables.
IDENTIFYING = ["entity_id", "name", "name_en", "name_normalized", "domain", "domain_id", "lei", "cik", "corporate_number", "securities_code", "official_url", "official_domain", "raw_spf", "raw_dmarc", "raw_mx", "evidence"]
EXCLUDED_COLUMNS = ["population_id", "reason", "name", "country", "securities_code", "source", "run_id", "measured_month"]
AXES = {"sector": ("common12_code", "common12_label"), "industry": ("industry_label", "industry_label"), "segment": ("market_segment", "market_segment"), "country": ("country", "country"), "status": ("status", "status")}
UNCLASSIFIED = "(unclassified)"


def apply_view(df: DataFrame, populations: list[str] | None = None, **allowed: list[str]) -> DataFrame:
    """Rows whose columns hold one of the allowed values, and that belong to any of the populations."""
    out = df
    for column, values in allowed.items():
        out = out.filter(F.col(column).isin(values))
    return out if populations is None else out.filter(F.arrays_overlap("population_ids", F.array(*[F.lit(p) for p in populations])))


def summarize(df: DataFrame, code: str, label: str, numeric: bool = False) -> DataFrame:
    """(code, label, n, share, place) of a view; missing values have a bucket of their own.

    Places follow the number in ``code`` if ``numeric``, else the counts.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(UNCLASSIFIED))
    counts = df.groupBy(named(code).alias("code"), named(label).alias("label")).agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(0))  # a row for each code
    order = [F.coalesce(F.expr("try_cast(code AS double)"), F.lit(9999.0)), "code"] if numeric else [F.desc("n"), "code"]
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(every), 4)).withColumn("place", F.row_number().over(every.orderBy(*order)).cast("long"))


def view_coverage(df: DataFrame, view: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the run and of the view, and how many of the view have each column."""
    return view.agg(F.count("*").alias("in_view"), *[F.count(c).alias(f"with_{c}") for c in columns]).crossJoin(df.agg(F.count("*").alias("in_run")))


def search_rows(df: DataFrame, text: str, offset: int, limit: int, order: list[str]) -> DataFrame:
    """P10: a page of the rows in which any column holds the text, case ignored."""
    cells = F.array(*[F.lower(F.col(c).cast("string")) for c in df.columns])
    return df.filter(F.exists(cells, lambda c: F.coalesce(F.contains(c, F.lit(text.lower())), F.lit(False)))).orderBy(*order).offset(offset).limit(limit)


def assert_public(df: DataFrame, forbidden: Iterable[str] = IDENTIFYING) -> DataFrame:
    """The table itself; raises if it has a column that identifies a company."""
    if bad := sorted(set(df.columns) & set(forbidden)):
        raise ValueError(f"identifying columns may not be published: {bad}")
    return df


def assert_excluded_list(df: DataFrame) -> DataFrame:
    """The list of excluded filers may hold its declared columns only."""
    if bad := sorted(set(df.columns) - set(EXCLUDED_COLUMNS)):
        raise ValueError(f"undeclared columns: {bad}")
    return df


def overdue(df: DataFrame, now: Column, hours: float, opened: str = "opened_at", status: str = "status") -> DataFrame:
    """Add overdue: open items older than the limit."""
    age = (F.unix_timestamp(now) - F.unix_timestamp(opened)) / 3600
    return df.withColumn("overdue", yes((F.col(status) == "open") & (age > hours)))


def lint_text(df: DataFrame, terms: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, advice, hits, excerpt) of every term found in a text, case ignored.

    ``terms`` is a table of (term, advice). Each text is cut into its runs of SEED letters, of which a term's first one
    must be among, so that texts and terms meet by an equal key; terms shorter than that are few by nature and are
    looked for in every text.
    """
    seeded = terms.withColumn("_seed", F.lower(F.substring("term", 1, SEED)))
    rows = df.select(key, F.col(text).alias("_t"))
    runs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("_t") - SEED + 1, F.lit(1))), lambda i: F.substring(F.lower("_t"), i, F.lit(SEED))))
    if terms.limit(FEW_TERMS + 1).count() <= FEW_TERMS:
        met = rows.join(F.broadcast(seeded), F.contains(F.lower("_t"), F.lower("term")))
    else:
        long = rows.withColumn("_seed", F.explode(runs)).join(short(seeded.filter(F.length("term") >= SEED)), "_seed")
        met = long.select(key, "_t", "term", "advice", "_seed").unionByName(rows.join(must_be_short(seeded.filter(F.length("term") < SEED)), F.contains(F.lower("_t"), F.lower("term"))))
    hit = met.filter(F.contains(F.lower("_t"), F.lower("term")))
    low, term = F.lower("_t"), F.lower("term")
    count = ((F.length(low) - F.length(F.replace(low, term, F.lit("")))) / F.length(term)).cast("long")
    at = F.instr(low, term)
    return hit.select(key, "term", "advice", count.alias("hits"), F.substring("_t", F.greatest(at - 20, F.lit(1)), F.length("term") + 40).alias("excerpt"))


def credits(populations: DataFrame, sources: DataFrame) -> DataFrame:
    """The source credits of the populations shown, each once, in the order of first mention.

    ``populations``: (population_id); ``sources``: (population_id, credits array).
    """
    spread = sources.join(populations.select("population_id").distinct(), "population_id", "left_semi").select(F.posexplode("credits").alias("pos", "credit"))
    return spread.groupBy("credit").agg(F.min("pos").alias("pos")).select("credit", F.row_number().over(Window.orderBy("pos", "credit")).alias("place"))


def drilldown(domains: DataFrame, facts: DataFrame, entities: DataFrame, inferences: DataFrame, layers: list[str]) -> DataFrame:
    """A row for each domain with its facts, its company, and its vendors by layer side by side."""
    vendors = inferences.filter(F.coalesce("is_layer_primary", F.lit(True))).groupBy("domain_id").pivot("layer", layers).agg(F.array_join(F.array_sort(F.collect_set("vendor")), ", "))
    own = facts.drop(*[c for c in facts.columns if c in domains.columns and c != "domain_id"])
    out = domains.join(own, "domain_id", "left").join(entities, "entity_id", "left").join(vendors, "domain_id", "left")
    return out.withColumns({f"{c}_label": F.when(F.col(c).isNull(), "unknown").when(F.col(c), "yes").otherwise("no") for c in ("spf_present", "dmarc_present") if c in out.columns})


def trace(bronze: DataFrame, facts: DataFrame, inferences: DataFrame, cells: DataFrame, domain: str) -> DataFrame:
    """One row with all that is known of a domain: answers, fact, inferences, and the published cell it fell in."""
    raw = bronze.filter(F.col("domain") == domain).agg(F.array_sort(F.collect_list(F.struct("purpose", "query_name", "rcode"))).alias("answers"))
    fact = facts.filter(F.col("domain") == domain)
    found = inferences.join(fact.select("domain_id"), "domain_id", "left_semi").agg(F.array_sort(F.collect_list(F.struct("category", "vendor", "confidence"))).alias("inferences"))
    cell = fact.select("domain", "domain_id", "population_id", "sector_code", "effective_7489").join(cells, ["population_id", "sector_code"], "left")
    return cell.crossJoin(raw).crossJoin(found)


def finding_targets(facts: DataFrame, names: DataFrame, optouts: DataFrame) -> DataFrame:
    """(domain, entity_id, findings, skip_reason): whom the findings concern; a table only, nothing is sent.

    Skip reasons: not_observed, no_findings, opted_out (the domain, one above it, or the whole company).
    """
    rows = facts.withColumn("findings", finding_codes({c: F.col(c) for c in ("spf_present", "spf_valid", "spf_exceeds_limit", "spf_all_qualifier", "dmarc_present", "effective_7489", "blind_enforcement", "dmarc_multiple_records", "dkim_status", "dkim_revoked", "observed")}))
    sites = optouts.filter("kind = 'domain'").select(F.lower("value").alias("_s"), F.lit(True).alias("_site")).distinct()
    out_names = rows.select("domain").distinct().select("domain", F.explode(suffixes(F.lower("domain"))).alias("_s")).join(sites, "_s").select("domain", "_site").distinct()
    companies = optouts.filter("kind = 'entity'").select(F.col("value").alias("entity_id"), F.lit(True).alias("_company")).distinct()
    joined = rows.join(out_names, "domain", "left").join(companies, "entity_id", "left").join(names, "entity_id", "left")
    reason = F.when(~yes(F.col("observed")), "not_observed").when(F.col("_site") | F.col("_company"), "opted_out").when(F.size("findings") == 0, "no_findings")
    return joined.select("domain", "entity_id", *[c for c in names.columns if c != "entity_id"], "findings", reason.alias("skip_reason"))


def unknown_streak(by_month: DataFrame, months: DataFrame, name: str = "registered_domain") -> DataFrame:
    """(name, count, months_unknown, streak_uncertain, is_stale) of the names on the last month's list.

    ``by_month``: (month number, name, count); ``months``: (month number, truncated) of months that have a list.
    Months without a list are skipped, not counted as absences; a streak that ends at a list that was cut off may be
    longer than it looks.
    """
    numbered = months.withColumn("_i", F.row_number().over(Window.orderBy("month")))  # a row for each month
    rows = by_month.join(short(numbered), "month")
    # Islands: consecutive list numbers less their rank within the name are equal.
    rows = rows.withColumn("_g", F.col("_i") - F.row_number().over(Window.partitionBy(name).orderBy("_i")))
    island = rows.groupBy(name, "_g").agg(F.max("_i").alias("_last"), F.min("_i").alias("_first"), F.max_by("count", "_i").alias("count"))
    newest = numbered.agg(F.max("_i").alias("_last"))
    current = island.join(F.broadcast(newest), "_last")  # one row
    before = numbered.select((F.col("_i") + 1).alias("_first"), "truncated")
    out = current.join(short(before), "_first", "left")
    months_unknown = F.col("_last") - F.col("_first") + 1
    return out.select(name, "count", months_unknown.cast("long").alias("months_unknown"), yes(F.col("truncated")).alias("streak_uncertain"), (months_unknown >= 3).alias("is_stale"))
