"""Whether a page takes registrations: signals of its address and html, and the verdict that they give in two modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.functions import hosts as H
from catamill.functions import urls as U
from catamill.functions.common import bind, first_reason, matches, text

# What registers, costs, addresses the young or others, and keeps visitors out.
CART = r"add[- ]to[- ]cart|addtocart|enroll\s+now|register\s+now|sign\s+up\s+now|proceed\s+to\s+(checkout|payment)|checkout|place\s+order|buy\s+now|register\s+online"
PRICE = r"\$\s?\d{2,4}(?:\.\d{2})?|woocommerce-Price-amount|program\s+fee|tuition|cost:\s*\$|price:\s*\$"
YOUTH = r"summer\s+camp|day\s+camp|ages?\s+\d|grades?\s+[k0-9]|week\s+of|june|july|august|youth|kids?|children|clinic|lexplorations"
ADULT = r"adult\s+education|continuing\s+education|18\+|ages?\s+18|senior\s+center|after[- ]school|year[- ]round\s+childcare|men'?s\s+league|women'?s\s+league|workforce\s+development|for\s+adults"
ADULT_OLDER = r"adult\s+education|continuing\s+education|18\+|ages?\s+18|senior\s+center|after[- ]school|year[- ]round\s+childcare|men'?s\s+league|women'?s\s+league|workforce\s+development"
BROCHURE = r"contact\s+us\s+to\s+register|call\s+to\s+register|registration\s+opens|download\s+brochure|coming\s+soon"
BROCHURE_OLDER = r"contact\s+us\s+to\s+register|call\s+to\s+register|registration\s+opens|learn\s+more|download\s+brochure|coming\s+soon"
LOGIN = r"sign\s+in\s+to\s+register|log\s+in\s+to\s+register|members?\s+only|create\s+an\s+account\s+to\s+enroll"
ROW = r"program_details\.aspx\?ProgramID=|iteminfo\.aspx\?FMID=|/class/[^/\s\"']+|add-to-cart"
WEBTRAC, SHOP, MYREC = r"addtocart|iteminfo|module=ar|webtrac", r"woocommerce|add-to-cart|single_add_to_cart", r"register|enroll|add\s+to\s+cart|program_details"
JUNK_URL = r"/(?:about|contact|faq|privacy|terms|careers?|employment|news|blog|donate|membership|gallery|photos)(?:/|$)|\.pdf($|\?)"
HUB_PATH = r"/program/(teens|children-classes|faq|membership)(/|$|\?)"


def enrollment(url: Column, html: Column, context: Column | None = None, older: bool = False) -> Column:
    """struct<has_cart_cta, has_price, has_catalog_menu, youth_camp_keywords, blockers, auto_verdict>.

    The newer mode only upgrades (parent_ready) or rejects (wrong_audience); the older one also says brochure_only. Of
    the texts that tell audiences, the first 8000 characters count; context (a name) speaks for the young alone."""
    said = text(context) if context is not None else F.lit("")
    adult, brochure = (ADULT_OLDER, BROCHURE_OLDER) if older else (ADULT, BROCHURE)

    def form(page: Column) -> Column:
        blob = F.concat(said, F.lit(" "), F.substring(page, 1, 8000))
        cart, price, youth = matches(page, CART), matches(page, PRICE), matches(blob, YOUTH)
        menu = F.size(F.regexp_extract_all(page, F.lit("(?i)" + ROW), F.lit(0))) >= 3
        kind, item, low = H.platform_type(url), H.is_session_url(url), F.lower(text(url))
        shop = matches(page, SHOP)
        junk = (H.url_triage(url) == "auto_drop") | low.rlike(HUB_PATH) if older else matches(url, JUNK_URL)
        other = matches(blob, adult) & ~matches(said, YOUTH)
        stands = page.rlike(r"\S")
        shops = kind.isin("woocommerce", "community_ed") & shop & (item & price | (F.contains(low, F.lit("lexplorations")) if older else F.lit(False)))
        ready = (
            ((kind == "webtrac") & item & (cart | matches(page, WEBTRAC))) | ((kind == "myrec") & item & (cart | matches(page, MYREC))) | shops | (menu & cart & youth) | (stands & youth & price & cart)
        )
        weak = stands & youth & ~cart & (matches(page, brochure) | ~menu if older else matches(page, brochure))
        verdict = first_reason([("wrong_audience", junk | other), ("parent_ready", ready), *([("brochure_only", weak)] if older else [])])
        early = junk | other
        blockers = F.array_compact(F.array(
            F.when(junk, F.lit("junk_url")), F.when(~junk & other, F.lit("adult_ed")), F.when(~early & matches(page, LOGIN) & ~cart, F.lit("login_wall")),
            F.when(~early & ~ready & ~stands, F.lit("empty_page")), F.when(~early & ~ready & weak, F.lit("brochure_only")),
        ))
        return F.struct(cart.alias("has_cart_cta"), price.alias("has_price"), menu.alias("has_catalog_menu"), youth.alias("youth_camp_keywords"), blockers.alias("blockers"), verdict.alias("auto_verdict"))

    return bind(text(html), form)


def verdict_of(signals: Column, html: Column) -> Column:
    """The verdict of a fetched page: fetch_failed where nothing came, else what the signals say, else their first blocker if it is a verdict."""
    first = F.get(signals["blockers"], 0)
    return F.when(~text(html).rlike(r"\S"), F.lit("fetch_failed")).otherwise(F.coalesce(signals["auto_verdict"], F.when(first.isin("brochure_only", "wrong_audience", "login_wall"), first), F.lit("unverified")))


# Names in catalog listings that are no items, and the dates and ages in their labels.
WEBTRAC_VIEW = r"option=|mode=|interfaceparameter"
NOT_A_NAME = r"^(item details|add to (cart|selection|wishlist)|share|more info|enrollment count details)"
DATE_FIRST, DATE_RANGE = r"^\s*\d{1,2}/\d{1,2}/\d{2,4}", r"\d{1,2}/\d{1,2}/\d{2,4}\s*[-–]\s*\d{1,2}/\d{1,2}/\d{2,4}"
NO_PROGRAM = r"^(?:view|more|details|register|search|calendar|login|sign in|home)$"
LABEL_AGES = r"(?i)ages?\s*:?\s*\d{1,2}(?:\s*[-–&]\s*\d{1,2})?(?:\s*\+)?"
LABEL_DATES = r"(?i)(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s*\d{1,2}(?:[a-z]{2})?(?:\s*[-–—]\s*(?:[a-z]+\.?\s*)?\d{1,2}(?:[a-z]{2})?)?"
DETAIL, NOISE = r"(?i)ProgramDetail\.mvc|OfferingDetail\.mvc|program_id=\d+|offering_id=\d+", r"(?i)swim\s*test|life\s*jacket|pre[\s-]?camp\s*test|fitting|membership|donat"


def catalog_items(links: DataFrame, rule: str) -> DataFrame:
    """page_id, item, name, url, dates, ages of the items that a catalog page's links name, one row each.

    links: page_id, pos, url, label. rule: webtrac (by FMID: the first name, address and date, views of an item apart),
    myrec (by ProgramID: the longest name, the first date and ages in a label) or daxko (by address: the longest name, noise apart)."""
    low, label = F.lower(text("url")), F.trim(F.regexp_replace(text("label"), r"(?U)\s+", " "))
    own = links.withColumns({"label": label, "key": U.canonical_url(F.col("url"))})
    first = lambda c, test: F.min_by(c, F.when(test, F.col("pos")))
    longest = F.max_by("label", F.struct(F.length("label"), -F.col("pos")))
    empty = F.lit("")
    if rule == "webtrac":
        item = U.value(F.col("url"), "fmid")
        plain = ~low.rlike(WEBTRAC_VIEW)
        named = plain & (F.col("label") != "") & ~F.col("label").rlike(DATE_FIRST) & ~F.col("label").rlike("(?i)" + NOT_A_NAME)
        dated = F.col("label").rlike(DATE_RANGE) | F.col("label").rlike(DATE_FIRST)
        some = own.where(F.contains(F.lower(U.path(F.col("url"))), F.lit("iteminfo"))).withColumn("item", item).where(F.col("item").isNotNull())
        out = some.groupBy("page_id", "item").agg(first("label", named).alias("name"), first("key", plain).alias("url"), F.coalesce(first(F.replace("label", F.lit(" -"), F.lit(" - ")), dated), empty).alias("dates"), empty.alias("ages"))
        return out.where(F.col("name").isNotNull() & F.col("url").isNotNull())
    if rule == "myrec":
        some = own.where(F.contains(low, F.lit("program_details.aspx"))).withColumn("item", U.value(F.col("url"), "programid"))
        some = some.where(F.col("item").isNotNull() & (F.col("label") != "") & ~F.col("label").rlike("(?i)" + NO_PROGRAM))
        dates, ages = F.regexp_extract("label", LABEL_DATES, 0), F.regexp_extract("label", LABEL_AGES, 0)
        return some.groupBy("page_id", "item").agg(longest.alias("name"), F.min_by("key", "pos").alias("url"), F.coalesce(first(dates, dates != ""), empty).alias("dates"), F.coalesce(first(ages, ages != ""), empty).alias("ages"))
    if rule == "daxko":
        some = own.where(F.contains(low, F.lit("daxko.com")) & F.col("url").rlike(DETAIL) & (F.col("label") != "") & ~F.col("label").rlike(NOISE))
        return some.groupBy("page_id", F.col("key").alias("item")).agg(longest.alias("name"), F.first("key").alias("url"), empty.alias("dates"), empty.alias("ages"))
    raise ValueError(f"no rule {rule!r}")
