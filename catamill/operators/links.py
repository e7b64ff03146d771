"""Jobs over pages and links: canonical pages, extraction, scores and frontiers, candidate screening, ingestion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catamill.functions import hosts as H
from catamill.functions import texts as T
from catamill.functions import urls as U
from catamill.functions.common import UI, first_reason, matches, text
from catamill.operators.geo import out_of_state


def normalize_pages(pages: DataFrame, order: Column | None = None, unescape: bool = False) -> DataFrame:
    """One row per canonical address (the first in order): key, host, title, n_text, status and the page's columns.
    Named references stay encoded unless asked for, which keeps the job free of Python."""
    order = order if order is not None else F.col("page_id")
    p = pages.withColumns({"key": U.canonical_url(F.col("url")), "page_text": T.html_to_text(F.col("html"), unescape)})
    p = p.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(order))).where(F.col("rank") == 1)
    title = F.regexp_extract(text("html"), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return p.withColumns({"host": U.host_of(F.col("url")), "title": title, "n_text": F.length("page_text"), "status": T.page_status(F.col("page_text"))}).drop("rank")


def extract_links(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """page_id, pos, url (absolute), label, score; links that lead nowhere are left out. keep: columns of the page that its links carry."""
    links = pages.select("page_id", F.col("url").alias("base"), *keep, F.posexplode(T.page_links(F.col("html"))).alias("pos", "link"))
    links = links.select("page_id", *keep, "pos", U.absolute(F.col("base"), F.col("link.href")).alias("url"), F.col("link.label").alias("label")).where(F.col("url") != "")
    return links.withColumn("score", U.crawl_score(F.col("url"), F.col("label")))


def frontier(links: DataFrame, by: str, n: int, least: int = 1) -> DataFrame:
    """Per group the n best distinct links: score descending, then address."""
    best = links.where(F.col("score") >= least).groupBy(by, "url").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.col("score").desc(), "url"))).where(F.col("rank") <= n)


def slop_reason(url: Column, label: Column) -> Column:
    """Why a link is no record of its own, or null."""
    low = F.lower(text(url))
    return first_reason([
        ("media", U.is_media(url)), ("junk path", U.path(url).rlike(UI + U.JUNK_PATH)), ("chrome label", T.bad_name_reason(label).isNotNull()),
        ("social", U.host_of(url).rlike(r"(?:^|\.)(?:facebook|twitter|instagram|youtube|linkedin|pinterest|tiktok)\.com$")), ("search or login", low.rlike(r"[?&](?:q|s|search)=|/login|/signin")),
    ])


# Chains whose branch pages are sources of their own, and what paths, titles, hosts and paths tell of a search hit.
CHAIN_BRANCHES = (
    "codeninjas.com", "schoolofrock.com", "goldfishswimschool.com", "britishswimschool.com", "idtech.com", "mathnasium.com", "kumon.com", "snapology.com", "kidcreate.com", "engineeringforkids.com",
    "challengersports.com", "ussportscamps.com", "supersoccerstars.com", "skyhawks.com", "britishsoccercamps.com",
)
REJECTED_PATHS = ("/after-school", "/afterschool", "/childcare", "/child-care", "/daycare")
REJECTED_TITLES = ("after school", "after-school", "afterschool", "childcare", "daycare", "babysitter", "nanny", "tutor", "jobs", "careers", "employment")
TITLE_OVERRIDES = ("summer camp", "summer camps", "day camp", "sleepaway")
PREFERRED_HOSTS = ("communityed.org", "communityed.com", "myrec.com", "ymca.org", "ymca.net", "jcc", "bgclub", "burlingtonrecreation.org", "recreation.org")
PREFERRED_SOURCE_PATHS = ("/recreation", "/summer-camp", "/summer-camps", "/programs")
HOME_ZIPS = r"\b0[12]\d{3}\b"


def _holds(c: Column, parts: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


def validate_hits(hits: DataFrame, towns: Sequence[str] = (), aggregators: Sequence[str] = H.AGGREGATORS, guides: Sequence[str] = H.GUIDE_DOMAINS) -> DataFrame:
    """hits (url, title, snippet) with canonical url, verdict (keep or reject), reason, source_type and preferred; the first
    rule that holds decides: no url; aggregators, but for branches of chains that name a place (a /location/, a home ZIP,
    or one of the towns); another state; guides, kept for their links; paths and titles of what is no camp, unless the
    title names a camp; preferred hosts and paths; summer or camp anywhere; and else kept as ambiguous."""
    h = hits.withColumns({"__url": U.canonical_url(F.col("url"))})
    url, low = F.col("__url"), F.lower(F.col("__url"))
    said = F.lower(F.concat_ws(" ", text("url"), text("title"), text("snippet")))
    domain, host, at = U.registered_domain(U.host_of(url)), U.authority(url), F.lower(U.path(url))
    place = _holds(low, ("/locations/", "/location/")) | F.concat_ws(" ", low, said).rlike(HOME_ZIPS) | _holds(said, [t.lower() for t in towns])
    other = out_of_state(url, F.col("title"), F.col("snippet"))
    preferred = out_of_state(url, F.col("title"), F.lit("")).isNull() & (_holds(host, PREFERRED_HOSTS) | (host.endswith(".gov") & _holds(at, ("/recreation", "/parks", "/programs"))) | _holds(at, PREFERRED_SOURCE_PATHS))
    path_hit = F.coalesce(*[F.when(F.contains(at, F.lit(p)), F.lit(p)) for p in REJECTED_PATHS])
    is_aggregator = domain.isin(*aggregators)
    says = lambda s: F.concat(F.lit(s), domain)
    row = lambda verdict, reason, kind, liked=False: F.struct(F.lit(verdict).alias("verdict"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"), F.lit(kind).alias("source_type"), F.lit(liked).alias("preferred"))
    found = (
        F.when(url == "", row("reject", "empty url", "irrelevant"))
        .when(is_aggregator & domain.isin(*CHAIN_BRANCHES) & place, row("keep", says("chain branch w/ location: "), "primary"))
        .when(is_aggregator, row("reject", says("aggregator domain: "), "aggregator"))
        .when(other.isNotNull(), row("reject", F.concat(F.lit("out of state: "), other), "irrelevant"))
        .when(domain.isin(*guides), row("keep", says("parent guide (mine outbound): "), "guide"))
        .when(path_hit.isNotNull(), row("reject", F.concat(F.lit("url path contains "), path_hit), "after_school"))
        .when(_holds(said, REJECTED_TITLES) & ~_holds(said, TITLE_OVERRIDES), row("reject", "title/snippet indicates after-school or non-camp", "after_school"))
        .when(preferred, row("keep", "preferred primary source host/path", "primary", True))
        .when(_holds(said, ("summer", "camp")), row("keep", "summer/camp in metadata", "unknown"))
        .otherwise(row("keep", "passed rules; ambiguous", "unknown"))
    )
    return h.withColumn("__r", found).select(*[c for c in hits.columns if c != "url"], F.col("__url").alias("url"), "__r.*")


def screen_hits(hits: DataFrame, deny_domains: DataFrame | None = None) -> DataFrame:
    """hits (url, title, snippet) with keep, reason, source_type and preferred. deny_domains: domain."""
    h = hits.withColumn("domain", U.registered_domain(U.host_of(F.col("url"))))
    denied = F.lit(False)
    if deny_domains is not None:
        h = h.join(deny_domains.select("domain", F.lit(True).alias("denied")).distinct(), "domain", "left")
        denied = F.coalesce("denied", F.lit(False))
    words = F.concat_ws(" ", text("title"), text("snippet"), F.lower(text("url")))
    reason = first_reason([
        ("no url", text("url") == ""), ("denied domain", denied), ("media", U.is_media(F.col("url"))), ("junk path", U.path(F.col("url")).rlike(UI + U.JUNK_PATH) & ~U.is_registration(F.col("url"))),
        ("no camp signal", ~matches(words, r"camp|summer|program|recreation|youth") & ~U.is_registration(F.col("url"))),
    ])
    return h.select(*hits.columns, "domain", reason.isNull().alias("keep"), reason.alias("reason"), U.page_class(F.col("url")).alias("source_type"), (U.is_catalog(F.col("url")) | U.is_registration(F.col("url"))).alias("preferred"))


def first_per(rows: DataFrame, key: Column, order: list[Column], keep_blank: bool = True) -> DataFrame:
    """The first row of each key; rows with a blank key all stay, or all go."""
    name = "first_key"
    w = Window.partitionBy(name).orderBy(*order)
    blank_key = F.col(name) == ""
    r = rows.withColumn(name, F.coalesce(key, F.lit("")))
    hit = r.where(~blank_key).withColumn("first_rank", F.row_number().over(w)).where(F.col("first_rank") == 1).drop("first_rank")
    return (hit.unionByName(r.where(blank_key)) if keep_blank else hit).drop(name)


def one_seed_per_host(candidates: DataFrame) -> DataFrame:
    """Per host the candidate with the best path (preferred ones before others), the first in `ord` among equals."""
    rank = U.seed_rank(F.col("url")) + F.when(F.coalesce("preferred", F.lit(False)), 10).otherwise(0)
    best = F.max_by(F.struct(*[F.col(c) for c in candidates.columns]), F.struct(rank, -F.col("ord")))
    return candidates.withColumn("host", U.host_of(F.col("url"))).where(F.col("host") != "").groupBy("host").agg(best.alias("row")).select("host", "row.*")


def breadth_first(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The first row of each key before any second one, then in `ord`, n rows in all."""
    r = rows.withColumn("turn", F.row_number().over(Window.partitionBy(key).orderBy("ord")))
    return r.orderBy((F.col("turn") > 1).cast("int"), "ord").limit(n).drop("turn")


def only_new(links: DataFrame, seen: DataFrame) -> DataFrame:
    """Links (url, ord) whose canonical address was not seen (key), each once, first wins."""
    keyed = links.withColumn("key", U.canonical_url(F.col("url")))
    fresh = keyed.join(seen.select("key").distinct(), "key", "left_anti")
    return first_per(fresh, F.col("key"), [F.col("ord")], keep_blank=False)


def one_seed_per_domain(candidates: DataFrame) -> DataFrame:
    """candidates (url, classified_as, ord) with `kept` and `why`: guides all, camp venues once per canonical address, and of
    other directory pages the best of each registered domain (the first among equals); scores of 100 and more never."""
    c = candidates.withColumns({"__score": H.directory_score(F.col("url")), "__key": U.canonical_url(F.col("url")), "__domain": U.registered_domain(U.authority(F.col("url")))})
    guide, camp = text("classified_as") == "guide", H.is_camp_host(F.col("url")) | (text("classified_as") == "camp")
    kind = F.when(guide, "guide").when(F.col("__score") >= 100, "skip").when(camp, "camp").otherwise("directory")
    c = c.withColumn("__kind", kind)
    # Each kind is ranked by its own key; rows that need no rank have keys of their own.
    by = F.when(F.col("__kind") == "camp", F.col("__key")).when(F.col("__kind") == "directory", F.col("__domain")).otherwise(F.col("ord").cast("string"))
    place = F.row_number().over(Window.partitionBy("__kind", "__by").orderBy(F.when(F.col("__kind") == "directory", F.col("__score")).otherwise(0), "ord"))
    c = c.withColumn("__by", by).withColumn("__place", place)
    kept = (F.col("__kind") == "guide") | ((F.col("__kind") == "camp") & (F.col("__place") == 1) & (F.col("__key") != "")) | ((F.col("__kind") == "directory") & (F.col("__place") == 1))
    return c.select(*candidates.columns, kept.alias("kept"), F.when(kept, F.col("__kind")).when(F.col("__kind") == "skip", "score").otherwise("duplicate").alias("why"))


def cap_per_domain(links: DataFrame, cap: int = 80) -> DataFrame:
    """Links (url, ord) with the most promising registrations first, at most `cap` per registered domain."""
    r = links.withColumns({"priority": U.registration_priority(F.col("url")), "domain": U.registered_domain(U.authority(F.col("url")))})
    return r.withColumn("domain_rank", F.row_number().over(Window.partitionBy("domain").orderBy(F.col("priority").desc(), "ord"))).where(F.col("domain_rank") <= cap)


def discovered_registry(urls: DataFrame, most: int = 80) -> DataFrame:
    """town, name, host, seed, vendor, org_id, rank from urls (town, url, ord): the first address of each host of a town,
    hosts of known vendors first, at most `most` a town; hosts that are no providers are left out."""
    u = urls.withColumn("host", F.replace(U.authority(F.col("url")), F.lit("www."), F.lit(""))).where((F.col("host") != "") & ~F.col("host").rlike(UI + H.DENY_HOST))
    one = u.groupBy("town", "host").agg(F.min_by("url", "ord").alias("seed"), F.min("ord").alias("ord")).withColumn("v", H.vendor(F.col("seed")))
    rank = F.row_number().over(Window.partitionBy("town").orderBy(F.col("v.vendor").isNull(), "ord"))
    return one.withColumn("rank", rank).where(F.col("rank") <= most).select("town", F.col("host").alias("name"), "host", "seed", F.coalesce("v.vendor", F.lit("unknown")).alias("vendor"), F.coalesce("v.org_id", F.lit("")).alias("org_id"), "rank")


def direct_links(candidates: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates (url, title, town, phase, classified_as, crawled, ord) that are camps themselves, as link rows that are new
    (seen: key) and no slop; and all candidates with `crawled` true for those that were taken up."""
    camp = (text("classified_as") == "camp") & ~F.coalesce("crawled", F.lit(False))
    rows = candidates.where(camp).select(F.col("url"), F.col("town").alias("town_hint"), F.lit("direct").alias("source_type"), F.col("phase").alias("found_via"), F.col("url").alias("found_on_page"), F.col("title").alias("link_text"), "ord")
    fresh = only_new(rows, seen)
    fresh = fresh.where(slop_reason(F.col("url"), F.col("link_text")).isNull())
    return fresh, candidates.withColumn("crawled", F.coalesce("crawled", F.lit(False)) | camp)
