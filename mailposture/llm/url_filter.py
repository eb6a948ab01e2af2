"""URL filters: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

The filter is a table: a row for each block of 256 bits, as four longs. A URL's hash names one block, and six bits in
it; a page whose bits are not all set is surely unlisted and goes no further. Possible hits are joined exactly with
the list, which removes the false positives. The number of blocks grows with the list up to MOST_BLOCKS, which
bounds what is broadcast; a longer list only makes more false positives.

Host and path rules come first: a rule fits its host and all subdomains if the path starts with the rule's path; the
longest fitting rule decides. Null URLs and URLs without ``://`` have empty host and path, fit no rule, and are
allowed unless listed. Repeated rows get equal verdicts; an empty list allows all that no rule blocks. Other columns
are kept; the new names must not exist yet, or be given a prefix. Built-in functions and joins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailposture.llm.common import planned_buckets

#: Bits of a block, bits set by a URL, listed URLs of a block about, and most blocks (2**16 rows are broadcast).
BLOCK_BITS, PROBES, URLS_PER_BLOCK, MOST_BLOCKS = 256, 6, 20, 1 << 16
LANES = BLOCK_BITS // 64
#: Bytes of a list that is broadcast to the exact join at most, and bytes of a row beside its text.
BROADCAST_BYTES, ROW_BYTES = 20_000_000, 40

# Query parameters that do not change the page.
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid|source)"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: str = "url") -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(F.col(url), r"://([^/?#]*)", 1)), F.lit(""))


def path(url: str = "url") -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(F.col(url), r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _parts(url: str) -> tuple[Column, Column, Column]:
    bare = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    short = F.regexp_replace(path(url), r"(/|/?index\.html?|\.html?)$", "")
    query = F.regexp_extract(F.col(url), r"^[^?#]*\?([^#]*)", 1)
    return bare, short, F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"^{TRACKING}=")))


def canonical(url: str = "url") -> Column:
    """Host without www. and port, path without end slash or .html, and sorted query without tracking parameters."""
    bare, short, params = _parts(url)
    return F.concat(bare, short, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def block_of(c: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")


def masks(c: Column) -> list[Column]:
    """The bits of a URL in its block, as LANES longs."""
    h = F.xxhash64(c, F.lit("bits"))
    bits = [F.shiftrightunsigned(h, 8 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for k in range(PROBES)]
    out = []
    for lane in range(LANES):
        word = F.lit(0).cast("long")
        for b in bits:
            word = word.bitwiseOR(F.when(F.shiftright(b, 6) == lane, F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(F.lit(63)))).otherwise(F.lit(0).cast("long")))
        out.append(word)
    return out


def bloom(listed: DataFrame, blocks: int, url: str = "canonical") -> DataFrame:
    """The filter: (block, w0..w3) of the URLs in ``listed``; at most ``blocks`` rows."""
    words = [m.alias(f"w{k}") for k, m in enumerate(masks(F.col(url)))]
    return listed.select(block_of(F.col(url), blocks).alias("block"), *words).groupBy("block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(LANES)])


def rule_of(rules: list[tuple[str, str]], host_c: Column, path_c: Column) -> Column:
    """The (verdict, rule) of the longest fitting rule, as a struct; null if none fits. ``rules`` is a short fixed list."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host_c == name) | host_c.endswith(f".{name}")) & path_c.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def respelled(url: str = "url") -> Column:
    """Another spelling of a URL: its canonical form in capitals with www., an index page, tracking and a fragment."""
    bare, short, params = _parts(url)
    name = F.translate(bare, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    query = F.concat(F.lit("?utm_source=list"), F.when(F.size(params) > 0, F.concat(F.lit("&"), F.array_join(F.reverse(params), "&"))).otherwise(""))
    return F.concat(F.lit("HTTPS://www."), name, short, F.lit("/index.html"), query, F.lit("#top"))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], url: str = "url", prefix: str = "") -> DataFrame:
    """Add host, path, rule and verdict to ``pages``; ``listed`` has a column canonical. ``prefix`` goes before the names."""
    names = [f"{prefix}{x}" for x in ("host", "path", "rule", "verdict")]
    columns = pages.columns
    if clash := {*names, "_canonical", "_rule", "_block", "_possible", "_listed", "block", "canonical", *(f"w{k}" for k in range(LANES))} & set(columns):
        raise ValueError(f"columns exist already, give a prefix: {sorted(clash)}")
    listed = listed.filter("canonical is not null").select("canonical").distinct()
    held = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("canonical")), F.lit(0)).alias("bytes")).first()
    blocks = planned_buckets(held["n"], URLS_PER_BLOCK, MOST_BLOCKS)
    split = pages.withColumns({names[0]: host(url), names[1]: path(url), "_canonical": canonical(url)})
    split = split.withColumn("_rule", rule_of(rules, F.col(names[0]), F.col(names[1])))
    probe = split.withColumn("_block", block_of(F.col("_canonical"), blocks)).join(F.broadcast(bloom(listed, blocks)), F.col("_block") == F.col("block"), "left")
    set_ = F.lit(True)
    for k, m in enumerate(masks(F.col("_canonical"))):
        set_ = set_ & F.coalesce(F.col(f"w{k}").bitwiseAND(m) == m, F.lit(False))
    # Pages that a rule decides, or whose bits are not all set, need no look at the list.
    probe = probe.withColumn("_possible", set_ & F.col("_rule").isNull() & F.col("_canonical").isNotNull())
    kept = [*columns, *names[:2], F.col("_rule.rule").alias(names[2])]
    exact = listed.select("canonical", F.lit(True).alias("_listed"))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed"), "block").otherwise("allow")).alias(names[3])
    if held["bytes"] + ROW_BYTES * held["n"] <= BROADCAST_BYTES:
        asked = F.when(F.col("_possible"), F.col("_canonical"))
        return probe.join(F.broadcast(exact), asked == F.col("canonical"), "left").select(*kept, verdict)
    # Too long a list for one task's memory: only possible hits are moved, which takes a second look at the filter.
    decided = probe.filter(~F.col("_possible")).withColumn("_listed", F.lit(False))
    hits = probe.filter("_possible").join(exact, F.col("_canonical") == F.col("canonical"), "left")
    return decided.select(*kept, verdict).unionByName(hits.select(*kept, verdict))
