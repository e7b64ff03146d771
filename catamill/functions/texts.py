"""Text functions as column expressions: page text, names, ages, prices, places and page status."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from catamill.functions.common import UI, bind, blank, first_reason, strip, text


@F.pandas_udf(StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    """Character references decoded; there is no native function for the named ones."""
    return s.map(html.unescape, na_action="ignore")


def html_to_text(page: Column, unescape: bool = True) -> Column:
    """Without scripts, styles and tags, white space in one."""
    bare = F.regexp_replace(F.regexp_replace(text(page), r"(?is)<(script|style)[^>]*>.*?</\1>", " "), r"(?s)<[^>]+>", " ")
    return strip(F.regexp_replace(html_unescape(bare) if unescape else bare, r"(?U)\s+", " "))


def page_links(page: Column) -> Column:
    """array<struct<href, label>> of the anchors, in page order."""
    pattern = F.lit(r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>")
    label = lambda x: strip(F.regexp_replace(F.regexp_replace(x, r"(?s)<[^>]+>", " "), r"(?U)\s+", " "))
    return F.transform(F.arrays_zip(F.regexp_extract_all(text(page), pattern, F.lit(1)).alias("href"), F.regexp_extract_all(text(page), pattern, F.lit(2)).alias("label")), lambda x: F.struct(x["href"].alias("href"), label(x["label"]).alias("label")))


def markdown_to_text(c: Column) -> Column:
    """Labels of links stay, their addresses, images and bullets go."""
    out = F.regexp_replace(text(c), r"!\[[^\]]*\]\([^)]*\)", " ")
    out = F.regexp_replace(F.regexp_replace(out, r"\[([^\]]*)\]\([^)]*\)", "$1"), r"https?://\S+", " ")
    return strip(F.regexp_replace(F.regexp_replace(out, r"(?m)^\s*[*+-]\s+", ""), r"(?U)[ \t]+", " "))


# Words without identity in a programme's name.
FILLER = ("camp", "camps", "summer", "2025", "2026", "week", "session", "the", "a")
STOP = ("the", "a", "an", "of", "and", "for", "at", "in", "to", "with")
WEEK_LABEL = r"\b(?:week|session|wk|sess)\s*(?:[#:]?\s*)?(?:\d+|one|two|three|four|five|six|seven|eight|nine|ten)\b"
DATE_FRAGMENT = (
    r"\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s*\d{1,2}(?:\s*[-–—]\s*(?:[a-z]+\.?\s*)?\d{1,2})?\b"
    r"|\b\d{1,2}/\d{1,2}(?:/\d{2,4})?\b|\b20\d{2}\b"
)


def _words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def identity_name(name: Column) -> Column:
    """Lower case, no punctuation, no filler words."""
    low = F.regexp_replace(F.lower(text(name)), r"(?U)[^\w\s]", " ")
    return F.array_join(F.filter(_words(low), lambda x: ~x.isin(*FILLER)), " ")


def sorted_name(name: Column) -> Column:
    """Distinct tokens of a-z and 0-9, sorted."""
    return F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text(name)), F.lit("[a-z0-9]+"), F.lit(0)))), " ")


def undated_name(name: Column) -> Column:
    """Lower case without dates, week labels and punctuation."""
    out = F.lower(text(name))
    for pattern in (UI + DATE_FRAGMENT, UI + WEEK_LABEL, r"(?U)[^a-z0-9\s]"):
        out = F.regexp_replace(out, pattern, " ")
    return strip(F.regexp_replace(out, r"(?U)\s+", " "))


def display_name(name: Column) -> Column:
    """As written, without week labels, dates and what they leave at the ends."""
    out = F.regexp_replace(F.regexp_replace(text(name), UI + DATE_FRAGMENT, " "), UI + WEEK_LABEL, " ")
    return F.regexp_replace(F.regexp_replace(out, r"(?U)\s+", " "), r"(?U)^[\s:,|–-]+|[\s:,|–-]+$", "")


def slug(c: Column, sep: str = "_") -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", sep), f"^{sep}+|{sep}+$", "")


# Labels of page furniture that extraction takes for names.
CHROME_LABELS = (
    "back to top", "skip to main content", "skip to content", "skip to cookie notice", "skip to footer", "manage cookies", "cookie notice", "accept cookies", "see details", "details",
    "more info", "more information", "learn more", "read more", "view all", "view more", "show more", "register", "register here", "register now", "register online", "enroll",
    "enroll now", "sign up", "sign up now", "signup", "join waitlist", "join the waitlist", "waitlist", "add to cart", "checkout", "click here", "home", "menu", "close", "search",
    "next", "previous", "back", "continue", "submit", "login", "log in", "sign in", "my account", "contact", "contact us", "referral",
)
CHROME_PATTERN = r"^(?:skip to\b.*|back to\b.*|jump to\b.*|toggle\b.*|open\b.*menu|close\b.*menu)$"


def bad_name_reason(name: Column) -> Column:
    n = F.lower(F.regexp_replace(F.regexp_replace(strip(text(name)), r"^[.:|–-]+|[.:|–-]+$", ""), r"(?U)\s+", " "))
    return first_reason([
        ("empty name", n == ""),
        ("chrome name", n.isin(*CHROME_LABELS) | n.rlike(CHROME_PATTERN)),
        ("filename as name", n.rlike(r"\.(?:png|jpe?g|gif|svg|webp|pdf|docx?|xlsx?|css|js)$")),
        ("bare id as name", n.rlike(r"^[#\-\s]*\d[\d\s\-#]*$")),
    ])


def name_in_text(name: Column, page: Column) -> Column:
    """All but one of the name's telling words stand in the text, at least one."""
    words = F.filter(F.regexp_extract_all(F.lower(text(name)), F.lit("[a-z0-9]+"), F.lit(0)), lambda x: ~x.isin(*STOP, "camp"))
    held = lambda low: bind(words, lambda w: (F.size(w) > 0) & (F.size(F.filter(w, lambda x: F.contains(low, x))) >= F.greatest(F.lit(1), F.size(w) - 1)))
    return bind(F.lower(text(page)), held)


# Names that say nothing by themselves.
GENERIC_NAME = (
    r"^(?:the\s+)?(?:(?:full|half|all)[-\s]?day\s+|1/2\s*day\s+|outdoor\s+|youth\s+|kids?\s+)?(?:summer\s+|day\s+)?"
    r"(?:camps?|programs?|sessions?|units?|summer\s+program|outdoor\s+summer\s+camp)\.?$|\bunit$"
)


def prefixed_name(name: Column, provider: Column) -> Column:
    """A name that says nothing gets the provider's before it, unless they share a word of three letters or more."""
    n, p = strip(text(name)), strip(text(provider))
    words = lambda c: F.filter(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0)), lambda x: F.length(x) > 2)
    plain = (p == "") | (n == "") | ~n.rlike(UI + GENERIC_NAME) | F.arrays_overlap(words(n), words(p))
    return F.when(plain, n).otherwise(F.concat(p, F.lit(" — "), n))


def clean_age(ages: Column) -> Column:
    """Without ages that are remains of something else: zero-padded, or 0 to 2 with no unit."""
    a = strip(text(ages))
    return F.when(a.rlike(r"(?i)\bages?\s*:?\s*0\d\b") | a.rlike(r"(?i)^\s*ages?\s*:?\s*[0-2]\s*$"), F.lit("")).otherwise(a)


def is_adult_age(ages: Column) -> Column:
    """Whether the lower bound is 18 or more (never of months or weeks)."""
    a = strip(text(ages))
    low = F.coalesce(F.nullif(F.regexp_extract(a, r"(?i)^\s*(?:ages?\s*:?\s*)?(\d{1,2})\s*\+", 1), F.lit("")), F.nullif(F.regexp_extract(a, r"(?i)^\s*(?:ages?\s*:?\s*)?(\d{1,2})\s*[-–]\s*\d{1,2}\s*$", 1), F.lit("")))
    return F.coalesce(low.try_cast("int") >= 18, F.lit(False)) & ~a.rlike("(?i)month|week")


def ages_text(low: Column, high: Column) -> Column:
    """`ages a-b`, `ages a+` (also for 18 and more), or empty."""
    return F.when(low.isNull() & high.isNull(), "").when(high.isNull() | (low >= 18), F.concat(F.lit("ages "), low, F.lit("+"))).otherwise(F.concat(F.lit("ages "), F.coalesce(low, F.lit(0)), F.lit("-"), high))


def price_amount(price: Column) -> Column:
    """The first amount of a price text as decimal(10,2)."""
    return F.regexp_extract(F.replace(text(price), F.lit(","), F.lit("")), r"(\d+(?:\.\d{1,2})?)", 1).try_cast("decimal(10,2)")


def venue_parts(venue: Column) -> Column:
    """struct<city, state, zip> of a free text like `Name, City, ST 01234`."""
    v = strip(text(venue))
    return F.struct(
        strip(F.regexp_extract(v, r"([A-Za-z .'-]+),\s*[A-Z]{2}\b", 1)).alias("city"), F.regexp_extract(v, r",\s*([A-Z]{2})\b", 1).alias("state"), F.regexp_extract(v, r"\b(\d{5})(?:-\d{4})?\b", 1).alias("zip"),
    )


# What shows that a page takes registrations.
AFFORDANCE = (
    r"add[\s_-]?to[\s_-]?cart|/cart|class=[\"'][^\"']*cart|register\s*now|enroll\s*now|program[\s_-]?detail|iteminfo|program_details|begin\s*registration|add\s*to\s*selection|wbwsc|__doPostBack"
)


def has_affordance(page: Column) -> Column:
    return text(page).rlike("(?i)" + AFFORDANCE)


def page_status(page_text: Column, enough: int = 200) -> Column:
    """empty, login_wall, needs_js or ok, by the text of the page."""
    t, n = F.lower(text(page_text)), F.length(text(page_text))
    return F.when(blank(page_text), "empty").when((n < 1200) & t.rlike(r"sign in|log ?in|password"), "login_wall").when((n < enough) & ~t.rlike(r"camp|register|session|program"), "needs_js").otherwise("ok")


def has_evidence(*fields: Column) -> Column:
    return F.concat_ws("", *[strip(text(f)) for f in fields]) != ""
