"""Relevance of records to the catalog's focus: ordered rules, recovery of ambiguous drops, and screens of extracted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.functions import hosts as H
from catamill.functions import texts as T
from catamill.functions import urls as U
from catamill.functions.common import UI, blank, first_reason, text

# What speaks for and against a youth summer programme.
ADULT = r"\b(adult|adults|grown[\s-]?up|senior|seniors|18\s*\+|21\s*\+|men'?s|women'?s|over\s*1[8-9]|over\s*2\d)\b"
ADULT_MINIMUM = r"\b1[8-9]\s*(?:\+|and\s*up|&\s*up)\b|\b2\d\s*\+"
NON_PROGRAM = (
    r"\b(membership|memberships|scholarship|donation|donate|fundraiser|fund\b|gala|lunch|lunches|gift\s*card|punch\s*pass|drop[\s-]?in|locker|"
    r"sponsor|volunteer|trip|trips|league|boot\s*camp|bootcamp|open\s*(gym|play|skate|swim)|public\s*skate|stick\s*&\s*puck)\b"
)
ADULT_FITNESS = r"\b(yoga|pilates|zumba|spin\b|cycling|aerobics|cardio|strength|crossfit|bootcamp|pickleball)\b"
CAMP_TYPE = r"\b(camp|camps|clinic|clinics|workshop|workshops|academy|day\s*camp|sports?\s*camp)\b"
YOUTH = (
    r"\b(kid|kids|child|children|youth|junior|jr\.?|teen|teens|tween|camper|campers|cit\b|leader\s*in\s*training|lit\b|"
    r"pre[\s-]?k|preschool|kindergarten|grade|grades|boys?|girls?|toddler|elementary|middle\s*school)\b"
)
SUMMER = r"\b(summer|jun(e|\.)?|jul(y|\.)?|aug(ust|\.)?)\b|\b0?[678]/\d{1,2}"
OTHER_SEASON = (
    r"\b(fall|autumn|winter|spring|sept(ember)?|oct(ober)?|nov(ember)?|dec(ember)?|jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?)\b|\b(0?9|1[012])/\d{1,2}"
)
# Names of catalog rows that are no items, and products that are no camps.
NOT_AN_ITEM = r"^(item details|add to (cart|selection|wishlist)|share|more info|enrollment count details)"
ITEM_NOISE = r"swim\s*test|life\s*jacket|pre[\s-]?camp\s*test|fitting|membership|donat"
ADULT_CATEGORIES = ("cooking", "business", "esl", "exercise-dance", "humanities", "financial", "social-security", "grief", "mandarin-immersion", "adult", "senior")
HUB_SLUG = r"teens|children-classes|faq|contact|membership|donate|about"
AFTERCARE = r"after\s*-?\s*care|before\s*-?\s*care|extended\s*day|kidsborough"
CATEGORY_SIGNAL = r"summer|camp|vacation|lexplor"
PRODUCT_SIGNAL = r"summer|camp|vacation|lexplor|youth|kids|children"
NON_CAMP_PATH = r"/(?:fitness|afterschool|after-school|aquatics|membership|preschool|childcare)(?:/|$)"


def classify(rows: DataFrame) -> DataFrame:
    """rows (name, ages, dates, price, text, register_url, platform) with `keep` and `focus_reason`: hard drops, then the
    season, then what the platform says, then signals, and evidence on a registration system at last."""
    blob = F.concat_ws(" ", *[F.nullif(text(c), F.lit("")) for c in ("name", "ages", "dates", "text")])
    b = rows.withColumn("__b", F.trim(blob))
    hit = lambda p: F.col("__b").rlike(UI + p)
    evidence = T.has_evidence(F.col("ages"), F.col("dates"), F.col("price"))
    summer, youth, camp = hit(SUMMER), hit(YOUTH), hit(CAMP_TYPE)
    grid = text("platform") == "catalog_grid"
    reason = first_reason([
        ("empty", (F.col("__b") == "") & ~evidence), ("adult", hit(ADULT) | hit(ADULT_MINIMUM)), ("non-program", hit(NON_PROGRAM)), ("adult-fitness", hit(ADULT_FITNESS) & ~youth),
        ("off-season", hit(OTHER_SEASON) & ~summer), ("camp-catalog", text("platform") == "webtrac"), ("youth-summer", F.when(grid, camp | summer).otherwise(camp | youth | summer)),
        ("registrable-evidence", ~grid & evidence & U.is_registration(F.col("register_url"))), ("no-signal", F.lit(True)),
    ])
    out = b.withColumn("focus_reason", reason)
    return out.withColumn("keep", F.col("focus_reason").isin("camp-catalog", "youth-summer", "registrable-evidence")).drop("__b")


def recover(rows: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """classify()'s rows, with ambiguous drops (no-signal) kept again: by a verdict of `verdicts` (register_url, keep)
    where there is one, else if they have evidence or lie on a registration system."""
    r = rows
    if verdicts is not None:
        one = verdicts.groupBy("register_url").agg(F.bool_or("keep").alias("__said"))
        r = r.join(one, "register_url", "left")
    said = F.col("__said") if verdicts is not None else F.lit(None).cast("boolean")
    open_ = T.has_evidence(F.col("ages"), F.col("dates"), F.col("price")) | U.is_registration(F.col("register_url"))
    again = (F.col("focus_reason") == "no-signal") & F.coalesce(said, open_)
    return r.withColumns({"keep": F.col("keep") | again, "focus_reason": F.when(again, F.when(said.isNotNull(), "model-keep").otherwise("fail-open")).otherwise(F.col("focus_reason"))}).select(*rows.columns)


def accepted(programs: DataFrame, least: float = 0.6) -> DataFrame:
    """Extracted programs (seed, name, register_url, confidence as text) that are sure enough, named, and on the seed's host or a registration system."""
    sure = F.coalesce(F.col("confidence").cast("string").try_cast("double") >= least, F.lit(False))
    near = (U.host_of(F.col("register_url")) == U.host_of(F.col("seed"))) | U.is_registration(F.col("register_url"))
    return programs.where(sure & ~blank("name") & ~blank("register_url") & near)


def item_noise(name: Column) -> Column:
    """Why a catalog row is no item, or null."""
    n = F.trim(text(name))
    return first_reason([("blank", n == ""), ("control", n.rlike("(?i)" + NOT_AN_ITEM)), ("date only", n.rlike(r"^\s*\d{1,2}/\d{1,2}/\d{2,4}")), ("noise", n.rlike("(?i)" + ITEM_NOISE))])


def category_allowed(url: Column, prefix: str | None = None) -> Column:
    """Whether a shop's category is of the catalog (under the prefix) and for the young."""
    at = F.lower(U.path(url))
    slug = F.regexp_extract(at, r"([^/]*)/*$", 1)
    inside = F.lit(True)
    if prefix:
        bare = F.regexp_replace(at, "/+$", "")
        inside = at.startswith(prefix.lower()) & ~bare.isin("/shop", prefix.rstrip("/").lower() + "/shop")
    denied = F.lit(False)
    for word in ADULT_CATEGORIES:
        denied = denied | F.contains(slug, F.lit(word))
    return inside & ~denied & at.rlike(CATEGORY_SIGNAL)


def product_allowed(url: Column, name: Column, prefix: str | None = None) -> Column:
    at = F.lower(U.path(url))
    slug = F.regexp_extract(at, r"([^/]*)/*$", 1)
    both = F.concat(slug, F.lit(" "), F.lower(text(name)))
    return (at.startswith(prefix.lower()) if prefix else F.lit(True)) & ~slug.rlike(HUB_SLUG) & ~both.rlike(AFTERCARE) & both.rlike(PRODUCT_SIGNAL)


def camp_pages_only(records: DataFrame) -> DataFrame:
    """records (provider_id, info_url, dates, ages, detail) without sections that are no camps; where any of a provider's
    is on a camp path, only those, detail pages, and records with dates and ages stay."""
    r = records.where(~F.lower(U.path(F.col("info_url"))).rlike(NON_CAMP_PATH))
    camp = F.lower(U.path(F.col("info_url"))).rlike(r"/(?:[a-z-]*camps?|summer[a-z-]*)(?:/|$)")
    any_camp = r.groupBy("provider_id").agg(F.bool_or(camp).alias("__any"))
    strong = F.coalesce("detail", F.lit(False)) | (~blank("dates") & ~blank("ages"))
    return r.join(any_camp, "provider_id").where(~F.col("__any") | camp | strong).select(*records.columns)


def page_roles(pages: DataFrame, links: DataFrame) -> DataFrame:
    """page_id, role: catalog, register, detail, or null. A filtered catalog's address, a registration system's, three
    links to camps, and one or two of them on a page that speaks of the young. pages: page_id, url, html. links: page_id, url, label."""
    n = links.groupBy("page_id").agg(F.countDistinct(F.when(H.is_camp_link(F.col("url"), F.col("label")), F.col("url"))).alias("n"))
    p = pages.select("page_id", "url", "html").join(n, "page_id", "left")
    role = first_reason([
        ("catalog", U.is_catalog(F.col("url"))), ("register", U.is_registration(F.col("url"))), ("catalog", F.coalesce("n", F.lit(0)) >= 3),
        ("detail", (F.coalesce("n", F.lit(0)) >= 1) & text("html").rlike(UI + r"\b(?:summer|day|youth)\s*camps?\b|\b(?:kids|children|campers?)\b")),
    ])
    return p.select("page_id", role.alias("role"))
