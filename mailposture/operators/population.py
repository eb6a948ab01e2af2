"""Populations and identities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailposture.functions.classify import entity_id, yes
from mailposture.functions.names import names_agree
from mailposture.operators.tables import least_row, short
from mailposture.session import cut

ACTIVE = ["active", "renamed"]
# Industry codes and forms of companies that do not operate a business.
SPAC_SIC, COMMODITY_SIC, FINANCE_SIC, ASSET_SIC, ROYALTY_SIC = "6770", "6221", "6199", "6189", "6792"
FUND_FORMS = ["N-CSR", "N-CSRS", "NPORT-P", "N-CEN", "N-2", "N-2/A", "N-1A", "485BPOS", "N-30D", "N-Q"]
REGISTERED_FORMS = ["N-CSR", "N-CSRS", "NPORT-P", "N-CEN", "N-30D", "N-Q"]
OPERATING_FORMS = ["10-K", "10-K/A", "10-Q", "20-F", "40-F"]
# Industry codes that say nothing.
NO_SIC = ["0000", "8880"]
STRONG_KEYS = ["lei", "cik", "corporate_number"]


def active(df: DataFrame, status: str = "status") -> DataFrame:
    """Companies that are there, renamed ones included."""
    return df.filter(F.col(status).isin(ACTIVE))


def select_listed(df: DataFrame, allow: DataFrame | None = None, code: str = "securities_code", flag: str = "listing") -> DataFrame:
    """P5: companies with a securities code that are not flagged as unlisted, and in the allow-list if there is one."""
    out = df.filter((F.coalesce(code, F.lit("")) != "") & (F.coalesce(flag, F.lit("")) != "unlisted"))
    return out if allow is None else out.join(allow.select(code).distinct(), code, "left_semi")


def non_operating(sic: Column, forms: Column, name: Column) -> Column:
    """Why a filer is no operating company: spac, commodity_trust, passive_trust, registered_fund; else NULL."""
    title = F.coalesce(name, F.lit(""))
    says = lambda pattern: title.rlike(rf"(?i){pattern}")
    filed = lambda names: yes(F.arrays_overlap(forms, F.array(*[F.lit(x) for x in names])))
    code = F.coalesce(F.trim(sic), F.lit(""))
    acquisition = says(r"\bacquisition(\s+([ivx]{1,4}|\d{1,2}))?\s+(corp(oration)?|co|company|ltd|limited)\b")
    return (
        F.when((code == SPAC_SIC) | acquisition, "spac")
        .when((code == COMMODITY_SIC) & says(r"\b(etf|etp|trust|fund)\b"), "commodity_trust")
        .when((code == FINANCE_SIC) & says(r"\b(etf|etp|fund)\b"), "commodity_trust")
        .when((code == ASSET_SIC) | ((code == ROYALTY_SIC) & says(r"\btrust\b")), "passive_trust")
        .when(filed(REGISTERED_FORMS) | (filed(FUND_FORMS) & ~filed(OPERATING_FORMS)), "registered_fund")
    )


def split_non_operating(df: DataFrame, sic: str = "sic", forms: str = "forms", name: str = "name") -> tuple[DataFrame, DataFrame]:
    """Operating companies, and the rejected ones with their reason."""
    judged = df.withColumn("reason", non_operating(F.col(sic), F.col(forms), F.col(name)))
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def entity_attrs(entities: DataFrame) -> DataFrame:
    """What aggregation needs of a company; identifying columns stay behind."""
    return entities.select("entity_id", "country", "population_ids", "common12_code", "common12_label", "status", "official_domain_id")


def fill_by_key(df: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fill empty columns from a source with unique keys (of several rows the least); what is there stays."""
    other = least_row(source.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns]), ["_key"])
    joined = df.join(other, F.col(key) == F.col("_key"), "left")
    return joined.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop("_key", *[f"_{c}" for c in columns])


def fill_by_weak_key(df: DataFrame, source: DataFrame, key: str, column: str, name: str, source_name: str) -> DataFrame:
    """Fill ``column`` by a key that is not unique by nature, and add ``outcome``.

    Keys of the source with several values are not used at all, and the names must agree. Outcomes: kept, no_key,
    no_match, conflict, name_rejected, filled.
    """
    grouped = source.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count_distinct(column).alias("_n"), F.max(column).alias("_value"), F.collect_set(source_name).alias("_names"))
    joined = df.join(grouped, F.col(key) == F.col("_key"), "left")
    agrees = F.exists("_names", lambda n: names_agree(F.col(name), n))
    outcome = (
        F.when(F.col(column).isNotNull(), "kept")
        .when(F.col(key).isNull(), "no_key")
        .when(F.col("_key").isNull() | F.col("_value").isNull(), "no_match")
        .when(F.col("_n") > 1, "conflict")
        .when(~yes(agrees), "name_rejected")
        .otherwise("filled")
    )
    out = joined.withColumn("outcome", outcome)
    return out.withColumn(column, F.when(F.col("outcome") == "filled", F.col("_value")).otherwise(F.col(column))).drop("_key", "_n", "_value", "_names")


def merge_entities(existing: DataFrame, incoming: DataFrame, keys: list[str] | None = None, name: str = "name_normalized", fill: list[str] | None = None) -> DataFrame:
    """One row for each company over both tables: populations united, empty columns filled, existing first.

    Rows that share a strong key are one company, directly or through others (rounds of smallest labels over keys and
    rows, cut off by checkpoints). Then rows without any strong key join the first row of the same name that has none
    either. Both tables have ``row_id`` (unique), ``rank`` (existing before incoming), the keys and population_ids.
    """
    strong = keys or STRONG_KEYS
    rows = cut(existing.unionByName(incoming, allowMissingColumns=True))
    pairs = [rows.filter(F.coalesce(k, F.lit("")) != "").select("row_id", F.concat(F.lit(f"{k}:"), F.upper(F.trim(k))).alias("key")) for k in strong]
    weak = rows.filter(" AND ".join(f"coalesce({k}, '') = ''" for k in strong)).filter(F.coalesce(name, F.lit("")) != "")
    pairs.append(weak.select("row_id", F.concat(F.lit("name:"), F.col(name)).alias("key")))
    links = pairs[0]
    for p in pairs[1:]:
        links = links.unionByName(p)
    links = cut(links.distinct())
    order = rows.select("row_id", F.struct("rank", "row_id").alias("label"))
    while True:
        by_key = links.join(order, "row_id").groupBy("key").agg(F.min("label").alias("label"))
        by_row = links.join(by_key, "key").groupBy("row_id").agg(F.min("label").alias("new"))
        after = cut(order.join(by_row, "row_id", "left").select("row_id", "label", F.least("label", F.coalesce("new", "label")).alias("new")))
        order = after.select("row_id", F.col("new").alias("label"))
        if after.filter("label <> new").isEmpty():
            break
    at = F.struct("rank", "row_id")
    columns = [c for c in rows.columns if c not in ("row_id", "rank", "population_ids")]
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), at)) if fill is None or c in fill else F.min_by(F.col(c), at)
    merged = rows.join(order, "row_id").groupBy("label").agg(*[first(c).alias(c) for c in columns], F.array_sort(F.array_distinct(F.flatten(F.collect_list("population_ids")))).alias("population_ids"), F.count("*").alias("merged_rows"))
    return merged.select(F.col("label.row_id").alias("row_id"), *columns, "population_ids", "merged_rows")


def promote_id(df: DataFrame, lei: str = "lei", cid: str = "entity_id") -> DataFrame:
    """F-C10: companies with an LEI get its id; the old one is kept in is_duplicate_of."""
    none = F.lit(None).cast("string")
    new = F.coalesce(entity_id(F.col(lei), none, none, none, none), F.col(cid))
    return df.withColumn("is_duplicate_of", F.when(new != F.col(cid), F.col(cid))).withColumn(cid, new)


def prefer_filing(df: DataFrame, scan: DataFrame, key: str = "entity_id", domain: str = "official_domain") -> DataFrame:
    """The site that a filing states replaces the known one if the filing states one only and no other company
    states it; the old one moves to alt_domains."""
    stated = scan.filter("domain is not null").select(key, "domain").distinct()
    stated = stated.withColumns({"_sites": F.count("*").over(Window.partitionBy(key)), "_owners": F.count("*").over(Window.partitionBy("domain"))})
    sure = stated.filter("_sites = 1 and _owners = 1").select(key, F.col("domain").alias("_new"))
    joined = df.join(sure, key, "left")
    moved = F.col("_new").isNotNull() & F.col(domain).isNotNull() & (F.col("_new") != F.col(domain))
    alt = F.coalesce("alt_domains", F.array().cast("array<string>"))
    return joined.withColumns({"alt_domains": F.when(moved, F.array_distinct(F.array_append(alt, F.col(domain)))).otherwise(alt), domain: F.coalesce("_new", domain)}).drop("_new")


def fill_from_stated(df: DataFrame, stated: DataFrame, fits: Column, key: str = "entity_id", domain: str = "official_domain") -> DataFrame:
    """Fill empty domains from texts; a domain that several companies state stays only where ``fits`` holds
    (a column over the joined rows, ``names.name_in_domain`` say). Decided on the counts before any filling."""
    one = stated.select(key, F.col("domain").alias("_stated")).distinct().withColumn("_shared", F.count("*").over(Window.partitionBy("_stated")) > 1)
    best = one.groupBy(key).agg(F.min_by(F.struct("_stated", "_shared"), F.struct("_shared", "_stated")).alias("_s"))
    joined = df.join(best, key, "left").withColumns({"_stated": F.col("_s._stated"), "_shared": F.col("_s._shared")})
    good = F.col(domain).isNull() & F.col("_stated").isNotNull() & (~F.col("_shared") | yes(fits))
    return joined.withColumn(domain, F.when(good, F.col("_stated")).otherwise(F.col(domain))).drop("_s", "_stated", "_shared")


def lookup(df: DataFrame, table: DataFrame, key: str, columns: list[str], limit: int = 100_000) -> DataFrame:
    """Left join to a mapping table, which is broadcast if it has ``limit`` rows at most; of several rows of a
    key the least counts."""
    return df.join(short(least_row(table, [key], columns), limit), key, "left")


def lookup_counts(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """(rows, matched, unmatched, no_key): how the rows fare against a mapping table."""
    known = short(table.select(F.col(key).alias("_known")).filter("_known is not null").distinct())
    joined = df.join(known, F.col(key) == F.col("_known"), "left")
    empty = F.coalesce(F.col(key).cast("string"), F.lit("")) == ""
    hit = F.col("_known").isNotNull()
    return joined.agg(F.count("*").alias("rows"), F.count_if(hit).alias("matched"), F.count_if(~hit & ~empty).alias("unmatched"), F.count_if(~hit & empty).alias("no_key"))


def top_unmapped(df: DataFrame, table: DataFrame, key: str, n: int = 20) -> DataFrame:
    """(key, rows): the ``n`` most frequent labels without an entry in the mapping table, ties by the label."""
    lost = df.filter(F.coalesce(F.col(key), F.lit("")) != "").groupBy(F.trim(key).alias(key)).agg(F.count("*").alias("rows"))
    lost = lost.join(short(table.select(key).distinct()), key, "left_anti")
    return lost.orderBy(F.desc("rows"), key).limit(n)


def longest_prefix(df: DataFrame, prefixes: DataFrame, code: str, prefix: str, value: str) -> DataFrame:
    """Add ``value`` of the longest prefix that the code begins with.

    Codes are spread into their own beginnings, up to the longest prefix of the table, and joined on equality, so there
    is no comparison of all codes with all prefixes.
    """
    most = prefixes.agg(F.coalesce(F.max(F.length(prefix)), F.lit(0))).first()[0]
    if not most:
        return df.withColumn(value, F.lit(None).cast(prefixes.schema[value].dataType))
    codes = df.select(F.col(code).alias("_code")).filter("_code is not null").distinct()
    parts = codes.select("_code", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("_code"), F.lit(most))), lambda n: F.substring("_code", F.lit(1), n))).alias("_prefix"))
    hits = parts.join(prefixes.select(F.col(prefix).alias("_prefix"), F.col(value).alias("_value")), "_prefix")
    best = hits.groupBy("_code").agg(F.max_by("_value", F.length("_prefix")).alias(value))
    return df.join(best, F.col(code) == F.col("_code"), "left").drop("_code")


def sic_code(c: Column) -> Column:
    """Four digits with leading zeros; placeholders mean that there is none."""
    padded = F.lpad(F.trim(c), 4, "0")
    return F.when(padded.rlike(r"^\d{4}$") & ~padded.isin(NO_SIC), padded)


def add_derived(df: DataFrame, members: DataFrame, population: str, codes: list[str], size: tuple[int, int] | None = None) -> DataFrame:
    """Add a population id to companies whose code (own or parent's) is on a list; raise if the size is off."""
    wanted = members.select("code").distinct()
    hit = F.lit(False)
    for k, c in enumerate(codes):
        df = df.join(wanted.select(F.col("code").alias(f"_m{k}")), F.col(c) == F.col(f"_m{k}"), "left")
        hit = hit | F.col(f"_m{k}").isNotNull()
    out = df.withColumn("population_ids", F.when(hit, F.array_sort(F.array_union("population_ids", F.array(F.lit(population))))).otherwise(F.col("population_ids"))).drop(*[f"_m{k}" for k in range(len(codes))])
    if size is not None:
        n = out.filter(F.array_contains("population_ids", population)).count()
        if not size[0] <= n <= size[1]:
            raise ValueError(f"{population} has {n} companies, expected {size[0]} to {size[1]}")
    return out


def entity_diff(cur: DataFrame, prev: DataFrame, month: Column, key: str = "entity_id", name: str = "name") -> DataFrame:
    """(key, name, status, first_seen, last_seen, previous_name): new, renamed, and delisted once.

    Only companies that were active before can be delisted now; a delisted row is not carried on.
    """
    before = prev.filter(F.col("status") == "active").select(key, F.col(name).alias("_name"), F.col("first_seen").alias("_first"), F.col("last_seen").alias("_last"), F.lit(True).alias("_was"))
    joined = cur.select(key, name, F.lit(True).alias("_is")).join(before, key, "full")
    is_, was = yes(F.col("_is")), yes(F.col("_was"))
    renamed = is_ & was & (F.coalesce("_name", F.lit("")) != F.col(name))
    status = F.when(~is_, "delisted").when(renamed, "renamed").otherwise("active")
    return joined.select(
        key,
        F.coalesce(name, "_name").alias(name),
        status.alias("status"),
        (is_ & ~was).alias("is_new"),
        F.coalesce("_first", month).alias("first_seen"),
        F.when(is_, month).otherwise(F.col("_last")).alias("last_seen"),
        F.when(renamed, F.col("_name")).alias("previous_name"),
    )


def build_group(rows: DataFrame, listed_names: DataFrame, listed_domains: DataFrame, most_parents: int = 2, most_siblings: int = 2) -> DataFrame:
    """Group companies (name, parent, domain) with ``dropped``, the first reason that applies, else NULL.

    Reasons in order: listed company, listed domain, too many parents, repeated row, too many siblings on one site.
    """
    names = listed_names.select("name", F.lit(True).alias("_ln")).distinct()
    sites = listed_domains.select("domain", F.lit(True).alias("_ld")).distinct()
    parents = rows.groupBy("name").agg(F.count_distinct("parent").alias("_parents"))
    siblings = rows.filter("domain is not null").groupBy("parent", "domain").agg(F.count_distinct("name").alias("_siblings"))
    first = F.row_number().over(Window.partitionBy("name", "domain").orderBy("parent")) > 1
    out = rows.join(names, "name", "left").join(sites, "domain", "left").join(parents, "name", "left").join(siblings, ["parent", "domain"], "left").withColumn("_again", first)
    reason = (
        F.when(F.col("_ln"), "listed_company")
        .when(F.col("_ld"), "listed_domain")
        .when(F.col("_parents") > most_parents, "many_parents")
        .when(F.col("_again"), "repeated")
        .when(F.col("_siblings") > most_siblings, "shared_site")
    )
    return out.select("name", "parent", "domain", reason.alias("dropped"))


def lookup_name(df: DataFrame, registry: DataFrame, name: str = "name_normalized", area: str = "prefecture") -> DataFrame:
    """Add (number, url, outcome) by exact folded name, the area deciding between several.

    Outcomes: found, no_url, ambiguous, not_found.
    """
    entries = registry.select(F.col(name).alias("_name"), F.col(area).alias("_area"), "number", "url").distinct()
    asked = df.select(name, area).distinct()
    hits = asked.join(entries, F.col(name) == F.col("_name"), "left").withColumn("_same", yes(F.col(area) == F.col("_area")))
    grouped = hits.groupBy(name, area).agg(F.count_distinct("number").alias("_n"), F.count_distinct(F.when(F.col("_same"), F.col("number"))).alias("_near"), F.max(F.struct("_same", "number", "url")).alias("_best"))
    sure = (F.col("_n") == 1) | (F.col("_near") == 1)
    outcome = F.when(F.col("_n") == 0, "not_found").when(~sure, "ambiguous").when(F.coalesce("_best.url", F.lit("")) == "", "no_url").otherwise("found")
    picked = grouped.select(F.col(name).alias("_q"), F.col(area).alias("_a"), outcome.alias("outcome"), F.when(sure, F.col("_best.number")).alias("number"), F.when(sure, F.col("_best.url")).alias("url"))
    return df.join(picked, F.col(name).eqNullSafe(F.col("_q")) & F.col(area).eqNullSafe(F.col("_a")), "left").drop("_q", "_a")


def as_of(df: DataFrame, history: DataFrame, key: str, at: str, time: str, values: list[str]) -> DataFrame:
    """Add the latest ``values`` of the history strictly before each row's ``at``, with their ``time``.

    One sort-merge pass over both tables together: the last history row before each asking row.
    """
    order = Window.partitionBy(key).orderBy(F.col("_t"), F.col("_asks").desc()).rowsBetween(Window.unboundedPreceding, -1)
    kept = F.struct(F.col(time).alias("time"), *values)
    past = history.filter(F.col(time).isNotNull()).select(F.col(key), F.col(time).alias("_t"), F.lit(False).alias("_asks"), kept.alias("_h"))
    asks = df.select(F.col(key), F.col(at).alias("_t"), F.lit(True).alias("_asks"), F.struct(*[c for c in df.columns if c != key]).alias("_row"))
    both = asks.unionByName(past, allowMissingColumns=True).withColumn("_last", F.last("_h", ignorenulls=True).over(order))
    out = both.filter("_asks")
    return out.select(key, *[F.col(f"_row.{c}").alias(c) for c in df.columns if c != key], F.col("_last.time").alias(f"{time}_before"), *[F.col(f"_last.{v}").alias(f"{v}_before") for v in values])


def coalesce_sources(df: DataFrame, sources: list[tuple[str, DataFrame]], key: str, columns: list[str]) -> DataFrame:
    """Fill columns from the sources in order of priority and say in ``<column>_source`` where each came from."""
    out = df.withColumns({f"{c}_source": F.when(F.col(c).isNotNull(), "own") for c in columns})
    for name, source in sources:
        other = source.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns]).filter("_key is not null")
        other = least_row(other, ["_key"])
        joined = out.join(other, F.col(key) == F.col("_key"), "left")
        fresh = {f"{c}_source": F.when(F.col(c).isNull() & F.col(f"_{c}").isNotNull(), name).otherwise(F.col(f"{c}_source")) for c in columns}
        out = joined.withColumns(fresh).withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop("_key", *[f"_{c}" for c in columns])
    return out


def enrich(df: DataFrame, key: str, column: str, steps: list[tuple[str, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Ordered enrichment: each step fills only the rows that are still empty, and ``<column>_source`` says which.

    A step gets those rows and returns (key, column), from J8, J9, J12 or any other source; of several values of a key
    the least counts. Each step is cut off in the checkpoint folder, so that later steps do not look everything up again.
    """
    out = df.withColumn(f"{column}_source", F.when(F.col(column).isNotNull(), "own"))
    for name, step in steps:
        found = step(out.filter(F.col(column).isNull())).filter(F.col(column).isNotNull())
        one = found.groupBy(F.col(key).alias("_key")).agg(F.min(column).alias("_value"))
        joined = out.join(one, F.col(key) == F.col("_key"), "left")
        fresh = F.col(column).isNull() & F.col("_value").isNotNull()
        out = cut(joined.withColumns({f"{column}_source": F.when(fresh, name).otherwise(F.col(f"{column}_source")), column: F.coalesce(column, "_value")}).drop("_key", "_value"))
    return out


def from_table(source: DataFrame, on: str, key: str, column: str) -> Callable[[DataFrame], DataFrame]:
    """A step of J42: the value that a source has for each row's ``on``.

    Of several values of an ``on`` the least alone can count, so the source is brought down to it before the join; else
    all rows of a frequent ``on`` would meet all its source rows.
    """
    least = source.filter(F.col(on).isNotNull() & F.col(column).isNotNull()).groupBy(F.col(on).alias("_on")).agg(F.min(column).alias(column))
    return lambda todo: todo.select(F.col(key), F.col(on).alias("_of")).join(short(least), F.col("_of") == F.col("_on")).select(key, column)


def provenance(df: DataFrame, column: str) -> DataFrame:
    """How many values each source gave, and how many are still missing."""
    return df.groupBy(F.coalesce(f"{column}_source", F.lit("missing")).alias("source")).agg(F.count("*").alias("rows"))


def article_sites(articles: DataFrame, companies: DataFrame) -> DataFrame:
    """(entity_id, domain): an article's link is taken if the article lists the company's code and no other
    company takes the link. Articles: (title, codes, domain); companies: (entity_id, code, titles)."""
    titled = companies.select("entity_id", "code", F.explode("titles").alias("title"))
    hits = titled.join(articles, "title").filter(F.array_contains("codes", F.col("code")) & F.col("domain").isNotNull()).select("entity_id", "domain").distinct()
    owners = hits.groupBy("domain").agg(F.count_distinct("entity_id").alias("n"))
    return hits.join(owners.filter("n = 1"), "domain", "left_semi").groupBy("entity_id").agg(F.min("domain").alias("domain"))


def confirm_guesses(guesses: DataFrame, pages: DataFrame, confirmed: Column) -> DataFrame:
    """(entity_id, domain, outcome): the first guessed domain whose page passes ``confirmed``.

    ``guesses``: (entity_id, guesses array, other columns); ``pages``: (domain, html, ...). Outcomes: confirmed,
    page_without_name, no_page.
    """
    spread = guesses.select("*", F.posexplode("guesses").alias("pos", "domain")).join(pages, "domain", "left")
    seen = F.col("html").isNotNull()
    grouped = spread.groupBy("entity_id").agg(F.min_by("domain", F.when(seen & yes(confirmed), F.col("pos"))).alias("domain"), F.bool_or(seen).alias("seen"))
    outcome = F.when(F.col("domain").isNotNull(), "confirmed").when(F.col("seen"), "page_without_name").otherwise("no_page")
    return grouped.select("entity_id", "domain", outcome.alias("outcome"))


def latest_filing(df: DataFrame, key: str, form: str, date: str, forms: list[str], since: str | None = None) -> DataFrame:
    """The latest filing of a form family for each company, not before ``since`` (a column) if given."""
    rows = df.filter(F.col(form).isin(forms))
    rows = rows if since is None else rows.filter(F.col(since).isNull() | (F.col(date) >= F.col(since)))
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), F.struct(date, form)).alias("r")).select(key, "r.*")
