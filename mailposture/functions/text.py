"""Text of pages, filings and wiki articles as columns (survey 2.8, F-T1 to F-T14).

All are expressions over whole tables of texts; steps that need the public-suffix rules (``names.registrable``) are
left to a join, so hosts come out as written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailposture.functions.names import COMMON_WORDS, LEGAL_FORMS_EN, hostname, name_in_domain, registrable
from mailposture.functions.records import filled, no_dot, strip

HREF = r"(?i)href\s*=\s*[\"']?(https?://[^\"'\s>]+)"
HOST = r"(?i)\b(?:https?://)?(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,24}\b"
#: How far behind a phrase a host is looked for.
WINDOW, ABOUT_WINDOW, NOTICE_WINDOW = 160, 600, 400
# How a filing names its own company, kinds of sites, and words for a site.
OWNERS = ["company", "corporation", "registrant", "partnership", "bank"]
SITE_KINDS = ["main", "primary", "corporate", "internet", "investor relations", "principal"]
SITE_WORDS = ["website", "web site", "homepage", "home page", "internet website", "internet site", "internet address"]
#: Words of a name in front of "website" at most.
NAME_WORDS = 4
# Hosts with these ends are files, not sites.
FILE_ENDS = r"(?i)\.(htm|html|xml|xsd|pdf|jpg|gif|png|txt)$"
# Entities in plain text.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def either(words: list[str]) -> str:
    """Pattern of any of the words; a blank in one stands for any blanks."""
    return "(?:" + "|".join(w.replace(" ", r"\s+") for w in words) + ")"


_KINDS = rf"(?:{either(SITE_KINDS)}\s+){{0,2}}"
_SITE = rf"{_KINDS}{either(SITE_WORDS)}(?:\s+address)?"
_OWNER = rf"the\s+{either(OWNERS)}"
_WORD = r"\p{Lu}[\w&.-]*"
_NAME = rf"{_WORD}(?:\s+{_WORD}){{0,{NAME_WORDS - 1}}}"
#: Phrases with which a company speaks of its own site: "our website", "the Company's website", "we maintain a website".
SELF_PHRASES = [rf"(?i)\b(?:our|{_OWNER}['’]?s)\s+{_SITE}", rf"(?i)\b(?:we|{_OWNER})\s+(?:also\s+)?{either(['maintain', 'maintains', 'have established', 'has established'])}\s+an?\s+{_SITE}"]
#: Phrases that name the owner, which must be the company: "Acme Steel's website", "the Acme website".
POSSESSIVE, NAMED = rf"({_NAME})['’]s?\s+(?i:{_SITE})", rf"\b[Tt]he\s+({_NAME})\s+(?i:{_SITE})"
#: "Its" may be another company, so the domain must fit the name: "through its website".
ITS_PHRASE = rf"(?i)\b{either(['through', 'on', 'at', 'via'])}\s+its\s+{_SITE}"


def url_hosts(urls: Column) -> Column:
    """Comparable hosts of an array of URLs; those that are none are left out."""
    return F.array_compact(F.transform(urls, lambda u: hostname(F.regexp_replace(F.regexp_extract(u, r"(?i)^https?://([^/?#:\\]*)", 1), r"^.*@", ""))))


def link_hosts(html: Column) -> Column:
    """F-T1: hosts of the absolute links of a page in order, each once."""
    return F.array_distinct(url_hosts(F.regexp_extract_all(html, F.lit(HREF), 1)))


def link_domains(pages: DataFrame, rules: DataFrame, key: str, html: str, own: str | None = None) -> DataFrame:
    """F-T1: (key, registrable, pos): registrable domains that a page links to, other than its own, by first place."""
    cols = [key] if own is None else [key, own]
    spread = pages.select(*cols, F.posexplode(link_hosts(F.col(html))).alias("pos", "host"))
    found = registrable(spread, "host", rules).filter("registrable is not null")
    found = found if own is None else found.filter(F.col("registrable") != F.col(own))
    return found.groupBy(key, "registrable").agg(F.min("pos").alias("pos"))


def title(html: Column) -> Column:
    """F-T2: title, og:title and og:site_name, joined without blanks."""
    parts = F.concat(F.regexp_extract_all(html, F.lit(r"(?is)<title[^>]*>(.*?)</title>"), 1), F.regexp_extract_all(html, F.lit(r"(?i)property=[\"']og:(?:title|site_name)[\"'][^>]*content=[\"']([^\"']*)"), 1))
    return F.array_join(F.transform(parts, lambda p: F.regexp_replace(unescape(p), r"\s+", "")), "")


def unescape(text: Column) -> Column:
    """Common entities as characters; the ampersand last."""
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def page_names(html: Column, core: Column, forms: list[str], short: int = 4, least: int = 2, strict: bool = False) -> Column:
    """F-T2: the page names the company: short names (or all, if strict) in one of the title forms, others anywhere.

    ``forms`` hold ``{c}`` for the name, ``株式会社{c}`` say.
    """
    low = F.lower(core)
    in_title = F.lit(False)
    for form in forms:
        before, after = form.split("{c}")
        in_title = in_title | F.contains(F.lower(title(html)), F.concat(F.lit(before), low, F.lit(after)))
    anywhere = F.contains(F.regexp_replace(unescape(html), r"\s+", ""), core)
    return F.coalesce((F.length(core) >= least) & F.when(F.lit(strict) | (F.length(core) <= short), in_title).otherwise(anywhere), F.lit(False))


# Legal forms at the end of an English name in capitals, and what may stand before them.
NAME_HEADS = ["COMPANY", "CO"]
NAME_TAILS = ["LIMITED", "LTD", "INCORPORATED", "INC", "CORPORATION", "CORP", "KK", "HOLDINGS", "HOLDING"]


def title_names_english(html: Column, name: Column) -> Column:
    """F-T2: the title holds the full English name with its legal form, or ten letters or more of it without."""
    plain = lambda c: F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")
    full = plain(name)
    core = F.regexp_replace(full, f"({'|'.join(NAME_HEADS)})?({'|'.join(NAME_TAILS)})$", "")
    head = plain(unescape(F.array_join(F.regexp_extract_all(html, F.lit(r"(?is)<title[^>]*>(.*?)</title>"), 1), " ")))
    return F.coalesce(((F.length(core) >= 10) & F.contains(head, core)) | ((F.length(core) >= 5) & (full != core) & F.contains(head, full)), F.lit(False))


def plain_text(html: Column) -> Column:
    """F-T3: tags become blanks (so that words stay apart), entities characters, blanks are collapsed."""
    return strip(F.regexp_replace(unescape(F.regexp_replace(html, r"<[^>]+>", " ")), r"\s+", " "))


def windows_after(text: Column, phrase: str, size: int) -> Column:
    """The texts of ``size`` characters behind each place where a phrase ends."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?:{phrase})(?=(.{{0,{size}}}))"), 1)


def usable_hosts(text: Column, explicit_cc: bool = True) -> Column:
    """The hosts of a text that may be sites, in order. Two-letter ends count only where written as a site."""
    good = lambda h: ~h.rlike(FILE_ENDS) & (F.lit(not explicit_cc) | (F.length(F.substring_index(h, ".", -1)) > 2) | h.rlike(r"(?i)^(https?://|www\.)|\.(us|io|ai|co|tv|me)$"))
    return F.array_compact(F.transform(F.filter(F.regexp_extract_all(text, F.lit(HOST), 0), good), lambda h: hostname(F.regexp_replace(h, r"(?i)^https?://", ""))))


def first_hosts(texts: Column, explicit_cc: bool = True) -> Column:
    """The first usable host in each text."""
    return F.array_compact(F.transform(texts, lambda t: F.get(usable_hosts(t, explicit_cc), 0)))


def named_windows(text: Column, phrase: str, size: int) -> Column:
    """(said, window) of each phrase with a name in it: the name, and ``size`` characters behind the phrase."""
    behind = rf"(?s){phrase}(?=(.{{0,{size}}}))"
    return F.arrays_zip(F.regexp_extract_all(text, F.lit(behind), 1).alias("said"), F.regexp_extract_all(text, F.lit(behind), 2).alias("window"))


def own_name(said: Column, name: Column) -> Column:
    """The words said are words of the company's name, common ones left out, and at least one is."""
    words = lambda c: F.filter(F.split(F.lower(c), "[^a-z0-9&]+"), lambda w: (w != "") & ~w.isin(COMMON_WORDS))
    return F.coalesce((F.size(words(said)) > 0) & (F.size(F.array_except(words(said), words(name))) == 0), F.lit(False))


def stated_phrases(text: Column, name: Column | None = None) -> Column:
    """F-T4: (window, fit) of the phrases that state a site; ``fit``: only a domain that fits the name counts."""
    listed = lambda windows, fit: F.transform(windows, lambda w: F.struct(w.alias("window"), F.lit(fit).alias("fit")))
    found = [listed(windows_after(text, p, WINDOW), False) for p in SELF_PHRASES]
    if name is not None:
        for phrase, fit in ((POSSESSIVE, False), (NAMED, True)):
            own = F.filter(named_windows(text, phrase, WINDOW), lambda p: own_name(p["said"], name))
            found.append(listed(F.transform(own, lambda p: p["window"]), fit))
        found.append(listed(windows_after(text, ITS_PHRASE, WINDOW), True))
    return F.concat(*found)


def stated_domains(docs: DataFrame, rules: DataFrame, third: DataFrame, key: str, html: str, name: str | None = None) -> DataFrame:
    """F-T4: (key, registrable, times, pos) of domains that a filing states as its own.

    Of each phrase the first domain counts that is no third party's and not the government's. With ``name`` phrases
    that name the company are read too.
    """
    cols = [key] if name is None else [key, name]
    phrases = docs.select(*cols, F.posexplode(stated_phrases(plain_text(F.col(html)), None if name is None else F.col(name))).alias("pos", "p"))
    spread = phrases.select(*cols, "pos", "p.fit", F.posexplode(usable_hosts(F.col("p.window"))).alias("at", "host"))
    known = registrable(spread, "host", rules).filter(F.col("registrable").isNotNull() & ~F.col("registrable").endswith(".gov"))
    known = known.join(third.select(F.col("domain").alias("registrable")).distinct(), "registrable", "left_anti")
    first = known.groupBy(*cols, "pos", "fit").agg(F.min_by("registrable", "at").alias("registrable"))
    fits = F.lit(True) if name is None else ~F.col("fit") | name_in_domain(F.col(name), F.col("registrable"))
    return first.filter(fits).groupBy(key, "registrable").agg(F.count("*").alias("times"), F.min("pos").alias("pos"))


#: A heading about somebody: what follows it is looked through, the name included.
ABOUT = r"\bAbout\s+(?=\p{Lu})"
EMAIL = r"(?i)[a-z0-9._%+-]+@((?:[a-z0-9-]+\.)+[a-z]{2,24})"


def release_domains(docs: DataFrame, rules: DataFrame, third: DataFrame, key: str, html: str) -> DataFrame:
    """F-T5: the same for press releases: the first host behind "About ...", and the domains of mail addresses."""
    text = plain_text(F.col(html))
    hosts = F.concat(first_hosts(windows_after(text, ABOUT, ABOUT_WINDOW)), F.array_compact(F.transform(F.regexp_extract_all(text, F.lit(EMAIL), 1), hostname)))
    spread = registrable(docs.select(key, F.posexplode(hosts).alias("pos", "host")), "host", rules)
    spread = spread.filter(F.col("registrable").isNotNull() & ~F.col("registrable").endswith(".gov"))
    kept = spread.join(third.select(F.col("domain").alias("registrable")), "registrable", "left_anti")
    return kept.groupBy(key, "registrable").agg(F.count("*").alias("times"), F.min("pos").alias("pos"))


NOTICE = "公告掲載方法"


def notice_hosts(text: Column) -> Column:
    """F-T6: hosts of the first section on public notices that holds a URL."""
    found = F.transform(windows_after(text, NOTICE, NOTICE_WINDOW), lambda w: F.array_distinct(url_hosts(F.regexp_extract_all(w, F.lit(r"https?://[A-Za-z0-9.\-]+(?:/[^\s<>\"'）)」]*)?"), 0))))
    return F.coalesce(F.get(F.filter(found, lambda h: F.size(h) > 0), 0), F.array().cast("array<string>"))


def newspaper_notice(text: Column) -> Column:
    """F-T6: notices go to a newspaper."""
    return F.coalesce(F.contains(F.get(windows_after(text, NOTICE, NOTICE_WINDOW), 0), F.lit("新聞")), F.lit(False))


def accept_notices(rows: DataFrame, vendors: DataFrame, taken: DataFrame, confirmed: DataFrame) -> DataFrame:
    """F-T7: (entity_id, domain, outcome): which notice domain each company gets.

    ``rows``: (entity_id, domains array). Vendors and domains of other companies go, confirmed ones come first, else
    the first one is a fallback; a domain that two companies would get goes to neither.
    """
    spread = rows.select("entity_id", F.posexplode("domains").alias("pos", "domain"))
    spread = spread.join(vendors.select("domain").distinct(), "domain", "left_anti")
    others = taken.select(F.col("domain"), F.col("entity_id").alias("_owner")).distinct()
    spread = spread.join(others, (spread["domain"] == others["domain"]) & (spread["entity_id"] != others["_owner"]), "left_anti")
    sure = confirmed.select("entity_id", "domain", F.lit(True).alias("_sure")).distinct()
    ranked = spread.join(sure, ["entity_id", "domain"], "left").groupBy("entity_id").agg(F.min_by(F.struct("domain", F.col("_sure").isNotNull().alias("sure")), F.struct(F.col("_sure").isNull(), "pos")).alias("b"))
    best = ranked.select("entity_id", "b.domain", F.when(F.col("b.sure"), "confirmed").otherwise("fallback").alias("outcome"))
    shared = best.groupBy("domain").agg(F.count("*").alias("n")).filter("n > 1")
    return best.join(shared, "domain", "left_anti").select("entity_id", "domain", "outcome")


# The forty-seven prefectures, and the designated cities that stand for theirs.
PREFECTURES = (
    "北海道 青森県 岩手県 宮城県 秋田県 山形県 福島県 茨城県 栃木県 群馬県 埼玉県 千葉県 東京都 神奈川県 新潟県 富山県 石川県 福井県 山梨県 "
    "長野県 岐阜県 静岡県 愛知県 三重県 滋賀県 京都府 大阪府 兵庫県 奈良県 和歌山県 鳥取県 島根県 岡山県 広島県 山口県 徳島県 香川県 愛媛県 "
    "高知県 福岡県 佐賀県 長崎県 熊本県 大分県 宮崎県 鹿児島県 沖縄県"
).split()
CITIES = {
    "札幌市": "北海道", "仙台市": "宮城県", "さいたま市": "埼玉県", "千葉市": "千葉県", "横浜市": "神奈川県", "川崎市": "神奈川県",
    "相模原市": "神奈川県", "新潟市": "新潟県", "静岡市": "静岡県", "浜松市": "静岡県", "名古屋市": "愛知県", "京都市": "京都府", "大阪市": "大阪府",
    "堺市": "大阪府", "神戸市": "兵庫県", "岡山市": "岡山県", "広島市": "広島県", "北九州市": "福岡県", "福岡市": "福岡県", "熊本市": "熊本県",
}


def prefecture(address: Column) -> Column:
    """F-T8: prefecture at the beginning of an address, by a designated city if need be, or its short form."""
    short = {p[:-1]: p for p in PREFECTURES if p != "北海道" and len(p) > 2}
    head = F.regexp_extract(strip(address), "^(" + "|".join([*PREFECTURES, *CITIES, *short]) + ")", 1)
    return F.create_map(*[F.lit(x) for pair in ({p: p for p in PREFECTURES} | CITIES | short).items() for x in pair])[filled(head)]


COMPANY = r"(?:(?:株式会社|有限会社|合同会社)[^\s、。,()（）]{2,30}|[^\s、。,()（）]{2,30}?(?:株式会社|有限会社|合同会社))"


def affiliates_section(text: Column, size: int = 20_000) -> Column:
    """F-T8: the section on affiliated companies: the first place where the heading is followed by a company name."""
    parts = windows_after(text, "【関係会社の状況】|関係会社の状況", size)
    cut = F.transform(parts, lambda p: F.regexp_extract(p, r"(?s)^(.*?)(?:【従業員の状況】|従業員の状況|【提出会社の状況】|$)", 1))
    return F.get(F.filter(cut, lambda p: p.rlike(COMPANY)), 0)


def subsidiary_part(section: Column) -> Column:
    """F-T8: what stands under the headings of subsidiaries; the whole section if it has no such headings."""
    heads = r"(?:持分法適用非連結子会社|非連結子会社|連結子会社|持分法適用関連会社|関連会社|親会社|その他の関係会社)"
    own = F.regexp_extract_all(section, F.lit(rf"(?s)[(（]?(?:持分法適用非連結子会社|非連結子会社|連結子会社)[)）]?(.*?)(?=[(（]?{heads}[)）]|$)"), 1)
    return F.when(F.size(own) > 0, F.array_join(own, " ")).otherwise(section)


def subsidiary_names(text: Column, own_name: Column, most: int = 200) -> Column:
    """F-T8: names with a legal form in the part on subsidiaries, without the own name, each once, the first ``most``."""
    names = F.transform(F.regexp_extract_all(subsidiary_part(affiliates_section(text)), F.lit(COMPANY), 0), lambda n: F.regexp_replace(n, r"^.*?\d+(号|番地)|\s", ""))
    return F.slice(F.array_distinct(F.filter(names, lambda n: (n != F.regexp_replace(own_name, r"\s", "")) & ~n.rlike("^[のはがをにでとへも]"))), 1, most)


def constituent_codes(wikitext: Column, section: str) -> Column:
    """F-T9: codes in the first column of the table of a section, each once."""
    body = F.regexp_extract(wikitext, rf"(?s)== {section} ==(.*?)(?:\n==[^=]|$)", 1)
    return F.array_distinct(F.regexp_extract_all(body, F.lit(r"(?m)^\|\s*([0-9][0-9A-Z]{3})\s*(?:\|\||$)"), 1))


def infobox(wikitext: Column, name: str) -> Column:
    """F-T9: the body of an infobox up to its closing braces, nested ones included (five levels)."""
    inner = r"[^{}]"
    for _ in range(5):
        inner = rf"(?:[^{{}}]|\{{(?!\{{)|\}}(?!\}})|\{{\{{{inner}*\}}\}})"
    return filled(F.regexp_extract(wikitext, rf"(?s)\{{\{{\s*{name}({inner}*)\}}\}}", 1))


def infobox_field(box: Column, field: str) -> Column:
    """F-T9: value of a field; bars inside braces and brackets do not end it."""
    piece = r"(?:\{\{[^{}]*\}\}|\[\[[^\[\]]*\]\]|[^|{}\[\]]|[{}\[\]])"
    return strip(F.regexp_extract(box, rf"(?s)\|\s*{field}\s*=({piece}*?)(?=\||$)", 1))


def code_listed(value: Column, code: Column) -> Column:
    """F-T9: the code stands in the text as a word of its own."""
    return F.coalesce(F.array_contains(F.split(value, r"[^0-9A-Za-z]+"), code), F.lit(False))


def external_link(value: Column) -> Column:
    """F-T9: the first URL of a field, written out or in a template."""
    plain = F.regexp_replace(F.regexp_extract(value, r"https?://[^\s|\]}<]+", 0), "[.,]+$", "")
    template = F.regexp_extract(value, r"(?i)\{\{\s*url\s*\|\s*(?:https?://)?([^|}\s]+)", 1)
    return F.coalesce(filled(plain), F.concat(F.lit("https://"), filled(template)))


def title_forms(name: Column) -> Column:
    """F-T9: titles an article on the company may have."""
    base = strip(F.regexp_replace(name, "株式会社|有限会社|合同会社", ""))
    return F.when(base != "", F.array(base, F.concat(base, F.lit(" (企業)")))).otherwise(F.array().cast("array<string>"))


def tags(html: Column, name: str) -> Column:
    """The opening tags of an element, as written."""
    return F.regexp_extract_all(html, F.lit(rf"(?i)<{name}\b[^>]*>"), 0)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, quoted or not; NULL if there is none."""
    value = F.regexp_extract(tag, rf"(?i)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return filled(strip(unescape(F.regexp_replace(value, "^[\"']|[\"']$", ""))))


def redirect_target(html: Column, domain: Column, base: Column | None = None) -> Column:
    """F-T10: where an entry page leads on the same domain: refresh, else frame, else script; relative targets are
    taken as paths of the domain. A page that leads to itself (``base``, else the domain) leads nowhere."""
    here = F.regexp_replace(F.coalesce(base, F.concat(F.lit("https://"), domain)) if base is not None else F.concat(F.lit("https://"), domain), "/+$", "")
    refresh = F.filter(tags(html, "meta"), lambda t: F.lower(attribute(t, "http-equiv")) == "refresh")
    waits = F.array_compact(F.transform(refresh, lambda t: F.regexp_extract(attribute(t, "content"), r"(?i)\burl\s*=\s*[\"']?([^\s\"']+)", 1)))
    frames = F.array_compact(F.transform(tags(html, "frame"), lambda t: attribute(t, "src")))
    # location = "x", location.href = "x" and location.replace("x")
    script = F.regexp_extract_all(html, F.lit(r"(?i)\blocation\s*(?:\.\s*href)?(?:=|\s+=|\.replace\s*\()\s*(\"[^\"]+\"|'[^']+')"), 1)
    scripts = F.transform(script, lambda x: F.substring(x, F.lit(2), F.length(x) - 2))
    same = []
    for way in (waits, frames, scripts):
        raw = filled(unescape(F.get(way, 0)))
        full = F.when(raw.rlike("(?i)^https?://"), raw).when(raw.rlike("^//"), F.concat(F.lit("https:"), raw)).otherwise(F.concat(F.lit("https://"), domain, F.lit("/"), F.regexp_replace(raw, "^/+", "")))
        host = no_dot(F.lower(F.regexp_extract(full, r"(?i)^https?://([^/?#:]*)", 1)))
        inside = (host == domain) | host.endswith(F.concat(F.lit("."), domain))
        same.append(F.when(inside & (F.regexp_replace(full, "/+$", "") != here), full))
    return F.coalesce(*same)


def domain_guesses(name_en: Column, ends: list[str], most: int = 4) -> Column:
    """F-T11: names that a company may have: joined, hyphened, first word, first two; holding and group forms too."""
    raw = F.filter(F.split(F.upper(name_en), "[^A-Z0-9]+"), lambda w: w != "")
    stop = [w.upper() for w in [*LEGAL_FORMS_EN, *COMMON_WORDS]]
    words = F.transform(F.filter(raw, lambda w: ~w.isin(stop)), F.lower)
    joined, hyphen, first = F.array_join(words, ""), F.array_join(words, "-"), F.get(words, 0)
    holding = F.exists(raw, lambda w: w.isin("HOLDINGS", "HOLDING"))
    more = F.when(holding, F.array(F.concat(hyphen, F.lit("-hd")), F.concat(joined, F.lit("hd")), F.concat(hyphen, F.lit("-holdings")), F.concat(joined, F.lit("holdings"))))
    base = F.slice(F.array_distinct(F.array_compact(F.array(joined, hyphen, first, F.concat(first, F.get(words, 1))))), 1, most)
    stems = F.array_distinct(F.filter(F.concat(base, F.coalesce(more, F.array().cast("array<string>"))), lambda s: F.length(s) >= 3))
    return F.when(F.size(words) > 0, F.flatten(F.transform(F.array(*[F.lit(e) for e in ends]), lambda e: F.transform(stems, lambda s: F.concat(s, F.lit("."), e))))).otherwise(F.array().cast("array<string>"))


# Ends of the labels of holding companies, and labels under a brand's own top level that are no names.
HOLDING_ENDS = ["-holdings", "holdings", "-hd", "hd", "-grp", "grp", "-group", "group", "-global", "global", "world", "-fg", "fg", "-corporation", "corporation", "-corp", "corp", "-inc", "inc", "bancorp"]
GENERIC_LABELS = ["global", "corp", "corporate", "group", "www", "jp", "japan", "en", "holdings"]
#: Ends are taken off so many times, if a label of SHORTEST letters is left; "the" is taken off labels of over THE letters.
ENDS_OFF, SHORTEST, THE = 2, 3, 6


def sibling_domains(domain: Column, ends: list[str]) -> Column:
    """F-T11: the same label under other ends, also without "the" and without one or two holding ends.

    ``domain`` is a registrable domain. The label of a brand's own top level (``global.acme``) is the brand.
    """
    label, rest = F.substring_index(domain, ".", 1), F.regexp_extract(domain, r"^[^.]*\.(.*)$", 1)
    label = F.when(label.isin(GENERIC_LABELS) & ~F.contains(rest, F.lit(".")), rest).otherwise(label)
    labels = F.array_compact(F.array(label, F.when(label.startswith("the") & (F.length(label) > THE), F.substring(label, F.lit(4), F.length(label)))))
    for _ in range(ENDS_OFF):
        shorter = lambda x: F.transform(F.array(*[F.lit(e) for e in HOLDING_ENDS]), lambda e: F.when(x.endswith(e) & (F.length(x) - F.length(e) >= SHORTEST), F.regexp_replace(F.substring(x, F.lit(1), F.length(x) - F.length(e)), "-+$", "")))
        labels = F.array_distinct(F.concat(labels, F.array_compact(F.flatten(F.transform(labels, shorter)))))
    spread = F.flatten(F.transform(labels, lambda x: F.array(*[F.concat(x, F.lit(f".{e}")) for e in ends])))
    return F.filter(F.array_distinct(spread), lambda d: d != domain)


# Katakana rows and the consonant of each; a row has the vowels a i u e o.
KANA_ROWS = {"": "アイウエオ", "k": "カキクケコ", "s": "サシスセソ", "t": "タチツテト", "n": "ナニヌネノ", "h": "ハヒフヘホ", "m": "マミムメモ", "r": "ラリルレロ", "g": "ガギグゲゴ", "z": "ザジズゼゾ", "d": "ダヂヅデド", "b": "バビブベボ", "p": "パピプペポ"}
KANA_ODD = {"シ": "shi", "チ": "chi", "ツ": "tsu", "フ": "fu", "ジ": "ji", "ヂ": "ji", "ヅ": "zu", "ヤ": "ya", "ユ": "yu", "ヨ": "yo", "ワ": "wa", "ヲ": "o", "ン": "n", "ヴ": "vu", "ー": ""}


def kana_table() -> dict[str, str]:
    """Kana units and their Latin forms, from the rows by rule; small y- and vowel kana join the one before."""
    plain = {k: c + v for c, row in KANA_ROWS.items() for k, v in zip(row, "aiueo", strict=True)} | KANA_ODD
    out = dict(plain)
    for k, latin in plain.items():
        if latin.endswith("i") and len(latin) > 1:
            stem = latin[:-1]
            for small, v in zip("ャュョ", ("a", "u", "o"), strict=True):
                out[k + small] = stem + (v if stem in ("sh", "ch", "j") else f"y{v}")
        for small, v in zip("ァィゥェォ", "aiueo", strict=True):
            if k in "フヴテデウシチジ":
                out[k + small] = {"フ": "f", "ヴ": "v", "テ": "t", "デ": "d", "ウ": "w", "シ": "sh", "チ": "ch", "ジ": "j"}[k] + v
    return out


def kana_latin(text: Column, loanwords: dict[str, str] | None = None) -> Column:
    """F-T12: katakana as Latin letters; loan words of the given table first, double consonants and long vowels by rule."""
    units = kana_table() | (loanwords or {})
    order = sorted(units, key=lambda u: (-len(u), u))
    table = F.create_map(*[F.lit(x) for u in order for x in (u, units[u])])
    found = F.regexp_extract_all(text, F.lit("(ッ|" + "|".join(order) + "|.)"), 1)
    latin = F.array_join(F.transform(found, lambda u: F.when(u == "ッ", "*").otherwise(F.coalesce(table[u], u))), "")
    doubled = F.regexp_replace(F.regexp_replace(latin, r"\*ch", "tch"), r"\*([a-z])", "$1$1")
    return F.regexp_replace(F.regexp_replace(doubled, r"\*", ""), r"(ou|oo)", "o")


def organisation_matches(organisation: Column, name_en: Column) -> Column:
    """F-T13: both names are the same without legal forms, four letters at least."""
    stop = [*LEGAL_FORMS_EN, *COMMON_WORDS]
    core = lambda c: F.array_join(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(stop)), "")
    return F.coalesce((F.length(core(name_en)) >= 4) & (core(organisation) == core(name_en)), F.lit(False))


def parent_mentioned(html: Column, parent: Column, own: Column) -> Column:
    """F-T13: the parent's name stands on the page outside the own name."""
    return F.coalesce(F.contains(F.replace(html, own, F.lit("")), parent), F.lit(False))


# Charset names as they are declared, and those of the decoder.
CHARSETS = {"utf-8": "UTF-8", "utf8": "UTF-8", "shift_jis": "windows-31j", "shift-jis": "windows-31j", "sjis": "windows-31j", "x-sjis": "windows-31j", "cp932": "windows-31j", "windows-31j": "windows-31j", "euc-jp": "EUC-JP", "iso-8859-1": "ISO-8859-1", "us-ascii": "US-ASCII"}


def decode_page(body: Column, header: Column) -> Column:
    """F-T14: page bytes as text by the header's charset, the page's own, or UTF-8 if valid, else windows-31j.

    Charsets other than UTF, ISO and ASCII need spark.sql.legacy.javaCharsets, and pages with bytes that do not fit
    theirs need spark.sql.legacy.codingErrorAction (which puts a mark in place of such bytes).
    """
    names = F.create_map(*[F.lit(x) for pair in CHARSETS.items() for x in pair])
    metas = tags(F.decode(F.substring(body, 1, 8192), "ISO-8859-1"), "meta")
    written = F.transform(metas, lambda t: F.coalesce(attribute(t, "charset"), filled(F.regexp_extract(attribute(t, "content"), r"(?i)charset\s*=\s*([^\s;]+)", 1))))
    declared = F.coalesce(names[F.lower(strip(header))], names[F.lower(F.get(F.array_compact(written), 0))])
    text = body.cast("string")
    charset = F.coalesce(declared, F.when(F.is_valid_utf8(text), "UTF-8").otherwise("windows-31j"))
    out = F.make_valid_utf8(text)
    for name in sorted(set(CHARSETS.values()) - {"UTF-8"}):
        out = F.when(charset == name, F.decode(body, name)).otherwise(out)
    return out
