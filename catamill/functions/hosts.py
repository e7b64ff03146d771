"""What hosts and addresses tell: vendors and platforms, kinds of institutions, seeds, candidates and links worth keeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.functions import urls as U
from catamill.functions.common import UI, first_reason, text

# Vendors by a part of an address, the first that fits counts.
VENDOR_SIGNATURES = (
    ("myvscloud.com", "webtrac"), ("webtrac", "webtrac"), ("myrec.com", "myrec"), ("campscui.active.com", "active"), ("activecommunities.com", "active"), ("hisawyer.com", "sawyer"),
    ("campbrainregistration.com", "campbrain"), ("campbrain.com", "campbrain"), ("enrollsy.com", "enrollsy"), ("daxko.com", "daxko"), ("recdesk.com", "recdesk"), ("civicrec", "civicrec"),
    ("communitypass.net", "communitypass"), ("ultracamp.com", "ultracamp"),
)
# Hosts that are no providers.
DENY_HOST = r"facebook|instagram|youtube|twitter|x\.com|yelp|tripadvisor|activityhero|macaronikid|mommypoppins|care\.com|niche\.com|yellowpages"
BLOCKED_HOST_PARTS = ("mail.google.com", "accounts.google.com", "printfriendly.com", "gmail.com")
BLOCKED_HOSTS = ("google.com", "facebook.com", "instagram.com")
AGGREGATORS = (
    "yelp.com", "care.com", "sittercity.com", "summercamps.com", "campnavigator.com", "mommynearest.com", "kidscamps.com", "kidvoyage.com", "verywellfamily.com", "parents.com", "activekids.com",
    "patch.com", "lexobserver.org", "lexmedia.org", "facebook.com", "instagram.com", "twitter.com", "x.com", "linkedin.com", "indeed.com", "eventbrite.com", "issuu.com", "weebly.com", "ecode360.com",
)
DENY_DOMAINS = (
    "mail.google.com", "printfriendly.com", "facebook.com", "fb.com", "instagram.com", "twitter.com", "x.com", "linkedin.com", "youtube.com", "youtu.be", "tiktok.com", "wikipedia.org",
    "reddit.com", "pinterest.com", "patch.com", "cnn.com", "nytimes.com", "washingtonpost.com", "bostonglobe.com", "boston.com", "nbcnews.com", "abcnews.go.com", "cbsnews.com", "foxnews.com",
    "usatoday.com", "reuters.com", "apnews.com", *AGGREGATORS,
)
GUIDE_DOMAINS = (
    "activityhero.com", "macaronikid.com", "kidsoutandabout.com", "communitykangaroo.com", "mommypoppins.com", "bostoncentral.com", "bostonmoms.com", "bostonparentspaper.com",
    "bostontechmom.com", "metrowestmom.com", "masscamps.com", "teenlife.com", "getfamilyhq.com", "jewishboston.com", "thebestcamps.com", "acanewengland.org", "tourlexington.us",
    "walthamplaygroup.org",
)
REGISTRATION_SIGNALS = (
    "/register", "/registration", "/course", "/courses", "/program", "/programs", "/activity", "/activities", "/camp", "/camps", "/class", "/classes", "/session", "programid=", "/enroll",
    "/signup", "/sign-up",
)
REC_CENTER_HINTS = (
    "jwhayden.org", "hayden", "ymca.org", "ymca.net", "ymcaboston", "myrec.com", "communityed.org", "communityed.com", "jcc", "bgclub", "boysandgirlsclub", "summersedgedaycamp", "daycamp",
)
# Paths by which one directory page of a domain is chosen.
SKIPPED_PATHS = ("/category/blog", "/category/", "/tag/", "/author/", "/wait-listed")
PREFERRED_PATHS = (
    "lexplorations", "lexploration", "childrens-programs", "children's-programs", "summer-camp", "summer-camps", "/camps", "/camp/", "registration", "register", "/activities", "/recreation",
    "/programs",
)
# Patterns of camp venues, candidates and links.
CAMP_HOST_PATH = r"summer-camp|summer-camps|/camps?[/\-]|specialty-camp|camp-program|day-camp|lexplorations|summer_vacation|summerfun|/summer(?:[/\-]|$)"
CAMP_DOMAIN = r"(^|\.)((summer)?sedge|camp[a-z0-9\-]*)\."
SUMMER_SIGNAL = (
    r"camp|camps|summer|clinic|clinics|academy|vacation|lexplor|day\s*camp|sport|sports|swim|stem|workshop|week\s*\d|register|enroll|sign\s*up|grader?|ages?\s*\d|multi[\s-]?sport|"
    r"specialty|playground|recreation|sacc|cit\b|lit\b|baseball|basketball|soccer|lacrosse|flag\s*football|gymnastics|tennis"
)
STRONG_SIGNAL = r"summer\s*camp|day\s*camp|sport\s*camp|camp\s*program|summer\s*program|youth\s*camp|vacation\s*camp|lexplor|sport\s*camps"
DROPPED_CANDIDATE = (
    r"/(login|signin|cart|privacy|terms|contact|employment|career|donate|membership|news|blog|gallery|photo|faq|about-us|calendar)(/|$|\?)|\.(pdf|jpg|jpeg|png|gif|css|js)(\?|$)|mailto:|tel:|#"
)
CARE_OR_TEST = r"after\s*care|before\s*care|swim\s*test|life\s*jacket|pre[\s-]?camp\s*test"
KEPT_LINK = r"camp|program|class|clinic|session|academy|workshop|lessons|summer"
DROPPED_PATH = r"(/login|/signin|/cart|/privacy|/terms|/about|/contact|/after-school|/afterschool)(/|$|\?)"
COMMUNITY_ED_DROPPED = r"(/class-category/|/category/|/tag/|/author/|add-to-cart=|/wait-listed|/adult-programs)"
COMMUNITY_ED_SIGNAL = r"camp|summer|lexplor|children|youth|kids|vacation"
ASSET = r"\.(jpg|jpeg|png|gif|svg|webp|css|js|ico)(\?|$)"
# Addresses that a reviewer need not see, or must.
AUTO_DROP = (
    r"\.pdf($|\?)|wp-content/uploads.*\.(jpg|jpeg|png|gif)|\.gov/documentcenter|/senior(/|$)|/membership(/|$)|/government/|/discover/contact|mail\.google\.com|printfriendly\.com|gmail\.com/mail"
)
HIGH_CONFIDENCE = (
    r"program_details\.aspx|myvscloud\.com|webtrac|/camp[/\-]|summer-camp|summer-camps|specialty-camp|lexplorations|/class/(?!category)[^/]+|arux\.app/courses|type=camp|module=ar|"
    r"/summervacation|summer_vacation|summerfun|ymca.*/camp|/day-camp"
)
NEEDS_REVIEW = (
    r"\.gov/|documentcenter|calendar\.aspx|formcenter|senior|tax|vaccine|parking|housing|liheap|crime|jail|storm-water|rain-barrel|classification"
)


def _holds(c: Column, parts: Sequence[str]) -> Column:
    """Whether any of the parts stands in the text."""
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


def signature(url: Column, signatures: Sequence[tuple[str, str]] = VENDOR_SIGNATURES) -> Column:
    """Name of the first signature that stands in the address, or null."""
    return first_reason([(name, F.contains(F.lower(text(url)), F.lit(part))) for part, name in signatures])


def vendor(url: Column, org: bool = True) -> Column:
    """struct<vendor, org_id> of one address by its signature; vendor is null without one. Organisations are the
    vendor's own names for its customers, where the address holds them."""
    host, first_label = U.authority(url), F.substring_index(U.host_of(url), ".", 1)
    own = F.contains(host, F.lit("communityed"))
    name = F.when(own, "communityed").otherwise(signature(url))
    found = (
        F.when(name == "communityed", first_label).when((name == "webtrac") & host.endswith("myvscloud.com"), first_label).when(name == "myrec", first_label)
        .when(name == "active", F.regexp_extract(text(url), r"/orgs/([\w-]+)", 1)).when(name == "sawyer", F.regexp_extract(F.lower(text(url)), r"hisawyer\.com/([\w-]+)", 1)).otherwise("")
    )
    return F.struct(name.alias("vendor"), (found if org else F.lit("")).alias("org_id"))


def fingerprint(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """seed, vendor, org_id, evidence of each seed: by the seed's own address, else its first link that a signature fits.

    seeds: seed. links: seed, pos, url. A seed without any is `unknown`; the evidence is the address that told."""
    every = seeds.select("seed", F.lit(-1).cast("long").alias("pos"), F.col("seed").alias("url")).unionByName(links.select("seed", F.col("pos").cast("long").alias("pos"), "url"))
    told = every.withColumn("v", vendor(F.col("url"))).where(F.col("v.vendor").isNotNull())
    first = told.groupBy("seed").agg(F.min_by(F.struct("v.vendor", "v.org_id", "url"), "pos").alias("f"))
    out = seeds.select("seed").distinct().join(first, "seed", "left")
    return out.select("seed", F.coalesce("f.vendor", F.lit("unknown")).alias("vendor"), F.coalesce("f.org_id", F.lit("")).alias("org_id"), F.coalesce("f.url", F.lit("")).alias("evidence"))


# What shows a platform in hosts of links and in the text of a page.
YMCA_HOST = r"ymca\.(org|net|com)|ymcaboston|ymcaof"
SHOP_PATH = r"/(class-category|product-category|shop|find-a-class)(/|$|\?)"
SHOP_TEXT = r"woocommerce|add-to-cart|wp-content/plugins/woocommerce"
GRID_ITEM = r"^/(?:courses|programs|camps|classes|activities|offerings|workshops|sessions)/([a-z0-9][a-z0-9\-]{2,})/?$"
GRID_DENIED = r"elementary|middle-school|high-school|competition|mental-health|wellness|nutrition|opioid|self-management|first-aid|volunteer|training$"
GRID_SKIPPED = ("index", "search", "category", "categories", "all", "featured", "archive", "archives", "page", "tag", "tags")
GRID_COUNTER = r"results?\s*:\s*\d+|\d+\s+courses?|\d+\s+programs?"
BUILDERS = (("squarespace", ("squarespace",)), ("wix", ("wixsite.com", "wixstatic", "wix.com")), ("weebly", ("weebly",)))


def community_ed(url: Column) -> Column:
    return U.host_of(url).rlike(r"communityed\.(?:org|com)$")


def grid_item(base: Column, url: Column) -> Column:
    """Whether a link leads to one item of a catalog grid of its own host."""
    slug = F.regexp_extract(F.lower(U.path(url)), GRID_ITEM, 1)
    return (U.host_of(base) == U.host_of(url)) & (slug != "") & ~slug.rlike(GRID_DENIED) & ~slug.isin(*GRID_SKIPPED)


def platforms(pages: DataFrame, links: DataFrame, signatures: Sequence[tuple[str, str]] = VENDOR_SIGNATURES, builders: Sequence[tuple[str, Sequence[str]]] = BUILDERS) -> DataFrame:
    """page_id, platform of every page by tiers: community education, YMCA, a registration system among its hosts, one
    embedded in its text, a catalog grid (8 items, or 5 with a counter), a shop, a site builder, and `custom` at last.

    pages: page_id, url, html. links: page_id, url. Signatures are in order; the first that any host has counts."""
    hosts = links.withColumn("host", U.host_of(F.col("url")))
    base = pages.select("page_id", F.col("url").alias("base"))
    rank = F.coalesce(*[F.when(F.contains(F.col("host"), F.lit(part)), F.lit(k)) for k, (part, _) in enumerate(signatures)])
    told = hosts.join(base, "page_id").groupBy("page_id").agg(
        F.min(rank).alias("best"), F.count_if(grid_item(F.col("base"), F.col("url"))).alias("items"),
        F.bool_or((U.host_of(F.col("base")) == F.col("host")) & F.concat(U.path(F.col("url")), F.lit("?"), U.query(F.col("url"))).rlike(UI + SHOP_PATH)).alias("shop_links"),
        F.bool_or(F.lower("url").rlike(SHOP_TEXT)).alias("shop_marks"), *[F.bool_or(_holds(F.col("host"), parts)).alias(f"by_{name}") for name, parts in builders],
    )
    p = pages.select("page_id", "url", F.lower(text("html")).alias("t")).join(told, "page_id", "left")
    own = F.coalesce(*[F.when(F.contains(U.host_of(F.col("url")), F.lit(part)), F.lit(k)) for k, (part, _) in enumerate(signatures)])
    best = F.least(own, F.col("best"))  # skips nulls
    named = F.get(F.array(*[F.lit(name) for _, name in signatures]), best)
    embedded = F.regexp_extract(F.col("t"), r"https?://[^\s\"'<>]*?(myvscloud\.com|webtrac|daxko|veracross\.com)", 1)
    items, shop = F.coalesce("items", F.lit(0)), F.coalesce("shop_links", F.lit(False)) | F.coalesce("shop_marks", F.lit(False)) | F.col("t").rlike(SHOP_TEXT)
    grid = ~shop & ((items >= 8) | ((items >= 5) & F.col("t").rlike(GRID_COUNTER)))
    platform = first_reason([
        ("community_ed", community_ed(F.col("url"))), ("ymca", U.authority(F.col("url")).rlike(YMCA_HOST)), (named, best.isNotNull()), ("sawyer", F.contains("t", F.lit("hisawyer"))),
        ("webtrac", embedded.isin("myvscloud.com", "webtrac")), ("veracross", embedded == "veracross.com"), ("daxko", embedded == "daxko"), ("catalog_grid", grid), ("woocommerce", shop),
        *[(name, F.coalesce(f"by_{name}", F.lit(False)) | _holds(U.host_of(F.col("url")), parts) | _holds(F.col("t"), parts)) for name, parts in builders],
        ("wordpress", F.contains("t", F.lit("wp-content"))), ("custom", F.lit(True)),
    ])
    return p.select("page_id", platform.alias("platform"))


def platform_type(url: Column) -> Column:
    """webtrac, myrec, community_ed, woocommerce or generic, by one address."""
    low, host = F.lower(text(url)), U.authority(url)
    return F.coalesce(first_reason([
        ("webtrac", _holds(low, ("myvscloud", "webtrac"))), ("myrec", F.contains(host, F.lit("myrec.com")) | F.contains(low, F.lit("program_details"))),
        ("community_ed", F.contains(host, F.lit("communityed"))), ("woocommerce", _holds(low, ("woocommerce", "/class/", "/product/"))),
    ]), F.lit("generic"))


def is_session_url(url: Column) -> Column:
    """Whether an address is one item of a registration system."""
    low, at = F.lower(text(url)), U.path(url)
    program = F.exists(U.params(url), lambda p: p["k"].isin("ProgramID", "programid") & (p["v"] != ""))
    return (
        (F.contains(low, F.lit("iteminfo")) & F.contains(F.replace(low, F.lit(" "), F.lit("")), F.lit("fmid="))) | (F.contains(low, F.lit("program_details.aspx")) & program)
        | (at.rlike(r"(?i)/class/[^/]+/?$") & community_ed(url)) | at.rlike(r"(?i)/product/[^/]+/?$")
    )


def institution_kind(rows: DataFrame, host: str, institutions: DataFrame) -> DataFrame:
    """rows with `institution`: college, private, public, trade, or null. institutions: host, kind; a host also stands for
    all its subdomains, the longest that fits counts. Else the host's own form tells."""
    labels = F.split(F.lower(text(host)), r"\.")
    at = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    some = rows.withColumn("__row", F.monotonically_increasing_id())
    each = some.select("__row", F.posexplode(at).alias("cut", "suffix"))
    known = institutions.groupBy(F.lower("host").alias("suffix")).agg(F.min("kind").alias("kind"))
    best = each.join(known, "suffix").groupBy("__row").agg(F.min_by("kind", "cut").alias("kind"))
    h = F.lower(text(host))
    by_form = first_reason([
        ("college", h.endswith(".edu")), ("public", h.endswith(".k12.ma.us") | F.contains(h, F.lit("publicschool"))), ("private", _holds(h, ("academy", "prepschool")) | h.endswith("school.org")),
    ])
    return some.join(best, "__row", "left").select(*rows.columns, F.coalesce("kind", by_form).alias("institution"))


def best_register_url(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """seed, register_url: the seed's first link to a registration system, else its first to a registering path of its own host, else the seed."""
    j = seeds.select("seed").distinct().join(links.select("seed", "pos", "url"), "seed", "left")
    tier = F.when(U.is_registration(F.col("url")), 0).when((U.host_of(F.col("url")) == U.host_of(F.col("seed"))) & U.path(F.col("url")).rlike(r"(?i)regist|enroll|signup|sign-up"), 1)
    best = j.groupBy("seed").agg(F.min_by("url", F.when(tier.isNotNull(), F.struct(tier, "pos"))).alias("best"))
    return best.select("seed", F.coalesce("best", "seed").alias("register_url"))


def is_camp_host(url: Column) -> Column:
    """Whether an address is itself the page of a camp venue."""
    at, host = F.lower(U.path(url)), U.authority(url)
    centre = _holds(host, REC_CENTER_HINTS)
    return (text(url) != "") & (
        at.rlike(CAMP_HOST_PATH) | (centre & F.concat(host, at).rlike(CAMP_HOST_PATH)) | (centre & at.isin("", "/") & _holds(host, ("daycamp", "summercamp", "camp"))) | host.rlike(CAMP_DOMAIN)
        | _holds(host, ("daycamp", "summercamp", "camp.org", "camp.com")) | F.contains(at, F.lit("program_details.aspx"))
    )


def is_rec_center(url: Column) -> Column:
    return _holds(U.authority(url), REC_CENTER_HINTS) | U.authority(url).endswith(".gov")


def directory_score(url: Column) -> Column:
    """Lower is better; 100 and more is never worth a visit."""
    at = F.lower(U.path(url))
    add = lambda parts, n: sum((F.when(F.contains(at, F.lit(p)), n).otherwise(0) for p in parts), F.lit(0))
    return add(SKIPPED_PATHS, 100) + add(PREFERRED_PATHS, -20) + F.when(at.isin("", "/"), 50).otherwise(0) + F.when(is_camp_host(url), -40).otherwise(0)


def candidate_score(url: Column, label: Column) -> Column:
    """How likely a link is a camp, 0 and up."""
    both = F.concat(text(url), F.lit(" "), text(label))
    plus = lambda test, n: F.when(test, n).otherwise(0)
    score = (
        1 + plus(both.rlike(UI + STRONG_SIGNAL), 3) + plus(both.rlike(r"(?i)register|enroll|sign[\s-]?up|program_details|iteminfo"), 2)
        + plus(F.lower(U.path(url)).rlike(r"/(camp|class|program|course|activity|session)s?/"), 1) + plus(both.rlike(UI + CARE_OR_TEST), -4)
    )
    return F.when((text(url) == "") | text(url).rlike(UI + DROPPED_CANDIDATE) | ~both.rlike(UI + SUMMER_SIGNAL), 0).otherwise(F.greatest(F.lit(0), score))


def locality_score(url: Column, town: Column) -> Column:
    """4 for a town's own recreation site, 2 where its name stands in the address and no namesake's does, else 0."""
    t, u = F.replace(F.lower(text(town)), F.lit(" "), F.lit("")), F.lower(text(url))
    has = lambda *parts: F.contains(u, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))
    own = has(t, "ma.myrec") | has("townof", t) | has(t, "recreation") | has(t, "rec")
    other = has(t, "vt") | has(t, "nc") | has(t, "nj") | has(t, "ia")
    return F.when(t == "", 0).when(own, 4).when(has(t) & ~other, 2).otherwise(0)


def is_camp_link(url: Column, label: Column) -> Column:
    """Whether a link likely leads to camps; of registration systems only filtered catalogs do."""
    low, both = F.lower(text(url)), F.concat(text(url), F.lit(" "), text(label))
    denied = U.registered_domain(U.authority(url)).isin(*DENY_DOMAINS) | (U.authority(url).endswith(".gov") & _holds(F.lower(U.path(url)), ("/press", "/news", "/media")))
    at = F.lower(U.path(url))
    hub = low.rlike(COMMUNITY_ED_DROPPED) | F.contains(at, F.lit("/class-category"))
    fits = ~community_ed(url) | (~hub & (~at.rlike(r"/class/[^/]+") | F.lower(both).rlike(COMMUNITY_ED_SIGNAL)))
    kept, dropped = both.rlike(UI + KEPT_LINK), low.rlike(DROPPED_PATH)
    return F.coalesce(
        F.when(text(url) == "", False).when(U.is_registration(url), U.is_catalog(url)).when(low.rlike(r"^(?:mailto:|tel:|#)"), False).when(is_camp_host(url), True).when(denied, False)
        .when(is_rec_center(url) & kept, fits & ~(dropped & ~F.contains(F.lower(both), F.lit("camp")))).when(dropped, False).otherwise(fits & kept),
        F.lit(False),
    )


def is_external_lead(guide: Column, url: Column, label: Column) -> Column:
    """Whether a guide's link leads to a provider on another domain and shows a sign of registration."""
    low, domain = F.lower(text(url)), U.registered_domain(U.authority(url))
    other = (text(url) != "") & ~low.rlike(r"^(?:mailto:|tel:|#)") & ~low.rlike(ASSET) & (domain != U.registered_domain(U.authority(guide))) & ~domain.isin(*AGGREGATORS, *GUIDE_DOMAINS)
    return other & F.when(U.is_registration(url), U.is_catalog(url)).otherwise(_holds(F.concat(low, F.lit(" "), F.lower(text(label))), REGISTRATION_SIGNALS))


def url_triage(url: Column) -> Column:
    """auto_drop, high_confidence, needs_review or plain: how much review an address needs."""
    drop = text(url).rlike(UI + AUTO_DROP)
    return F.coalesce(first_reason([
        ("auto_drop", drop), ("high_confidence", text(url).rlike(UI + HIGH_CONFIDENCE)), ("needs_review", text(url).rlike(UI + NEEDS_REVIEW) | U.authority(url).endswith(".gov")),
    ]), F.lit("plain"))


def is_blocked(url: Column) -> Column:
    """Hosts of mail, shares and portals, which are no providers."""
    return _holds(U.host_of(url), BLOCKED_HOST_PARTS) | U.host_of(url).isin(*BLOCKED_HOSTS)


def matches_hosts(url: Column, filters: Sequence[str]) -> Column:
    """Whether any filter stands in the registered domain and path; all match without filters."""
    return _holds(F.lower(F.concat(U.registered_domain(U.authority(url)), U.path(url))), filters) if filters else F.lit(True)
