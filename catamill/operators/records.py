"""Records from payloads and pages in one shape: dates, ages, prices, names, statuses, and links matched by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catamill.functions import texts as T
from catamill.functions import urls as U
from catamill.functions.common import blank, first_nonblank, strip, text

# Leaves of paths that are no detail pages, and evidence in page texts.
NO_DETAIL = (
    r"^(?:faqs?|register|registration|how-to-register|tuition|rates|dates-rates|forms?|financial-aid|bus-program|extended-day|extended-day-program|counselors?|join-our-team|contact|about|"
    r"resources?|family-resources|campanion|directions|map|staff|employment|policy|policies|home|index|leadership[a-z-]*|young-leaders?|leaders?-in-training|counselor-in-training)$"
)
SLUG_AGE = r"\b(grades?|ages?)-((?:pre)?k?\d{1,2})(?:-(\d{1,2}))?\b"
PAGE_DATES = r"(?i)(?:june|july|august)\s*\d{1,2}(?:[a-z]{2})?(?:\s*[-–]\s*(?:[a-z]+\s*)?\d{1,2}(?:[a-z]{2})?)?|\b[678]/\d{1,2}\s*[-–]\s*[678]?/?\d{1,2}\b"
PAGE_AGES = r"(?i)ages?\s*:?\s*\d{1,2}\s*(?:[-–to&]+\s*\d{1,2})?|grades?\s*:?\s*(?:pre)?[k0-9][-–k0-9 ]{0,8}|preschool|pre-k"
SHARED_WORDS = ("camp", "camps", "the", "and", "for", "a", "of", "program", "programs", "summer")


def day_text(d: Column) -> Column:
    """mm/dd/yyyy of a struct<month, day, year>; empty without a month."""
    return F.when(d["month"].isNull(), F.lit("")).otherwise(F.concat(F.format_string("%02d/%02d/", d["month"].cast("int"), F.coalesce(d["day"].cast("int"), F.lit(1))), F.coalesce(d["year"].cast("string"), F.lit(""))))


def range_text(begin: Column, end: Column) -> Column:
    """`a - b`, or the one that there is."""
    return F.when((begin != "") & (end != ""), F.concat(begin, F.lit(" - "), end)).otherwise(first_nonblank(begin, end))


def ranges_text(begins: Column, ends: Column, most: int = 4) -> Column:
    """The first ranges of two arrays of timestamps as texts, `b–e; …`."""
    day = lambda c: F.substring_index(text(c), " ", 1)
    pairs = F.slice(F.arrays_zip(begins.alias("b"), ends.alias("e")), 1, most)
    pairs = F.filter(pairs, lambda p: p["b"].isNotNull())
    return F.array_join(F.transform(pairs, lambda p: F.when(text(p["e"]) != "", F.concat(day(p["b"]), F.lit("–"), day(p["e"]))).otherwise(day(p["b"]))), "; ")


def age_or_grade(low: Column, high: Column, low_grade: Column, high_grade: Column) -> Column:
    """`ages 18+`, `ages a-b` or `grades a-b`; `?` for a bound that is missing."""
    or_what = lambda c: F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("?"))
    some = lambda *c: F.concat_ws("", *[x.cast("string") for x in c]) != ""
    return (
        F.when(F.coalesce(low.cast("string").try_cast("int") >= 18, F.lit(False)), F.lit("ages 18+")).when(some(low, high), F.concat(F.lit("ages "), or_what(low), F.lit("-"), or_what(high)))
        .when(some(low_grade, high_grade), F.concat(F.lit("grades "), or_what(low_grade), F.lit("-"), or_what(high_grade))).otherwise("")
    )


def first_amount(amounts: Column) -> Column:
    """`$x` of the first amount that is not blank or 0, in an array of texts."""
    found = F.get(F.filter(amounts, lambda a: ~text(a).isin("", "0")), 0)
    return F.when(found.isNotNull(), F.concat(F.lit("$"), found)).otherwise("")


def minor_units(amount: Column, unit: Column) -> Column:
    """`$x` of an amount in the currency's smallest unit; without needless zeros."""
    value = amount.cast("string").try_cast("decimal(18,0)").cast("double") / F.pow(F.lit(10.0), F.coalesce(unit.cast("int"), F.lit(2)))
    return F.when(value.isNull() | (value == 0), F.lit("")).otherwise(F.concat(F.lit("$"), F.regexp_replace(F.format_string("%.2f", value), r"\.?0+$", "")))


def make_sessions(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """rows of any source in the one shape of sessions: trimmed, addresses canonical, and names that are page furniture
    taken out (name_status needs_name, raw_name as it was). Missing columns count as blank; keep: more columns, as they are."""
    c = lambda n: text(n) if n in rows.columns else F.lit("")
    raw = strip(c("name"))
    bad = T.bad_name_reason(raw).isNotNull() | F.lower(raw).rlike(r"^[a-z]{18,}$")  # furniture, or a domain in one word
    return rows.select(
        F.when(bad, F.lit("")).otherwise(raw).alias("name"), first_nonblank(U.canonical_url(c("register_url")), c("register_url")).alias("register_url"), U.canonical_url(c("info_url")).alias("info_url"),
        *[strip(c(n)).alias(n) for n in ("details_text", "dates", "ages", "price")], *[c(n).alias(n) for n in ("platform", "source_url", "name_source")],
        first_nonblank(c("kind"), F.lit("session")).alias("kind"), F.when(bad, "needs_name").otherwise("ok").alias("name_status"), F.when(bad, raw).otherwise("").alias("raw_name"),
        first_nonblank(c("granularity"), F.lit("session")).alias("granularity"), *keep,
    )


def hit_sessions(hits: DataFrame, platform: str, site: str) -> DataFrame:
    """API rows (town, sport, camp_title, brand, min_age, max_age, session_dates, city, state, camp_url, object_id) as sessions with their venue, start and towns."""
    venue = F.concat_ws(", ", F.nullif(F.trim(text("city")), F.lit("")), F.nullif(F.trim(text("state")), F.lit("")))
    ages = F.when((text("min_age") != "") & (text("max_age") != ""), F.concat(text("min_age"), F.lit("-"), text("max_age"))).otherwise("")
    some = [F.nullif(x, F.lit("")) for x in (text("brand"), text("sport"), venue)]
    more = {
        "venue": venue, "venue_city": F.trim(text("city")), "venue_state": F.trim(text("state")), "start_date": F.trim(F.regexp_extract(text("session_dates"), r"^([^;–-]*)", 1)),
        "serving_towns": F.when(text("town") != "", F.array("town")).otherwise(F.array().cast("array<string>")), "_hub": F.lit(platform), "parent_ready": F.lit(True), "registrable": F.lit(True),
    }
    shaped = hits.select(
        F.col("camp_title").alias("name"), F.col("camp_url").alias("register_url"), F.col("camp_url").alias("info_url"), F.concat_ws(" | ", *some).alias("details_text"), F.lit(platform).alias("platform"),
        F.col("session_dates").alias("dates"), ages.alias("ages"), F.lit(site).alias("source_url"), F.lit("adapter").alias("name_source"), "object_id", "sport", *[c.alias(n) for n, c in more.items()],
    )
    return make_sessions(shaped, ("object_id", "sport", *more))


def offered(rows: DataFrame) -> DataFrame:
    """rows (status, info_url, external_url) with registrable, parent_ready and register_url: open, not full, no waiting
    list; an external registration counts only where it is open, else the detail page stands in."""
    s = F.lower(text("status"))
    open_ = F.contains(s, F.lit("available")) & ~F.contains(s, F.lit("full")) & ~F.contains(s, F.lit("notify"))
    return rows.withColumns({"registrable": open_, "parent_ready": open_, "register_url": F.when(open_ & ~blank("external_url"), F.col("external_url")).otherwise(F.col("info_url"))})


def _leaf(url: Column) -> Column:
    return F.regexp_extract(U.path(url), r"([^/]*)/*$", 1)


def slug_age(url: Column) -> Column:
    """`Ages a-b` or `Grades a-b` of the last path segment, or empty."""
    leaf = _leaf(url)
    part = lambda k: F.regexp_extract(leaf, "(?i)" + SLUG_AGE, k)
    kind = F.when(F.lower(part(1)).startswith("grade"), "Grades").otherwise("Ages")
    return F.when(part(2) == "", F.lit("")).otherwise(F.concat(kind, F.lit(" "), part(2), F.when(part(3) != "", F.concat(F.lit("-"), part(3))).otherwise("")))


def slug_name(url: Column) -> Column:
    """A name from the last path segment without its ages; empty for ids and very short ones."""
    leaf = F.regexp_replace(F.regexp_replace(_leaf(url), "(?i)" + SLUG_AGE, ""), r"^[-_ ]+|[-_ ]+$", "")
    name = F.trim(F.regexp_replace(leaf, "[-_]+", " "))
    digits = F.length(F.regexp_replace(name, r"\D", ""))
    return F.when((F.length(name) < 3) | ~name.rlike("(?i)[a-z]{3}") | (digits * 2 > F.length(name)), F.lit("")).otherwise(F.initcap(name))


def page_name(html: Column, url: Column) -> Column:
    """The first heading, else the title, without the site's name and ages; else from the address."""

    def inner(tag: str) -> Column:
        t = F.regexp_replace(F.regexp_replace(F.regexp_extract(text(html), rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1), "<[^>]+>", " "), r"(?U)\s+", " ")
        t = F.regexp_extract(strip(t), r"(?s)^(.*?)(?:\s+[|–—]\s+.*|\s+-\s+.*)?$", 1)
        t = F.regexp_replace(strip(t), r"(?i)\s*\((?:grades?|ages?)[^)]*\)\s*$", "")
        return F.when(F.length(t) >= 3, t)

    return F.coalesce(inner("h1"), inner("title"), F.initcap(F.trim(F.regexp_replace(_leaf(url), "[-_]", " "))))


def detail_records(pages: DataFrame) -> DataFrame:
    """page_id, name, info_url, dates, ages, detail of detail pages (page_id, url, page_text, html): not an administrative
    leaf, and with a date, an age, or a camp's address; dates and ages are the first in the text, ages of the address first."""
    leaf, t = F.lower(_leaf(F.col("url"))), text("page_text")
    own = slug_age(F.col("url"))
    dates, ages = F.regexp_extract(t, PAGE_DATES, 0), F.regexp_extract(t, PAGE_AGES, 0)
    kept = (leaf != "") & ~leaf.rlike(NO_DETAIL) & ((dates != "") | (ages != "") | (own != "") | F.contains(leaf, F.lit("camp")))
    return pages.where(kept).select("page_id", first_nonblank(slug_name(F.col("url")), page_name(F.col("html"), F.col("url"))).alias("name"), F.col("url").alias("info_url"), dates.alias("dates"), first_nonblank(own, ages).alias("ages"), F.lit(True).alias("detail"))


def links_by_name(sessions: DataFrame, links: DataFrame, most: int = 3) -> DataFrame:
    """page_id, name, url, score, rank: the best links of its page for each session's name. 100 where the label holds the
    name or the name the label, else 10 for each shared word; 5 more for filtered catalogs, 3 for registration systems.

    sessions: page_id, name. links: page_id, pos, url, label. Candidates share a page, not all pairs."""
    words = lambda c: F.filter(F.regexp_extract_all(F.lower(text(c)), F.lit("[a-z0-9]+"), F.lit(0)), lambda w: ~w.isin(*SHARED_WORDS))
    s = sessions.select("page_id", "name").distinct()
    j = s.join(links.select("page_id", "pos", U.canonical_url(F.col("url")).alias("url"), "label"), "page_id").where(F.col("url") != "")
    a, b = F.lower(F.trim(text("name"))), F.lower(F.trim(text("label")))
    same = (b != "") & (F.contains(a, b) | F.contains(b, a))
    score = F.when(same, 100).otherwise(10 * F.size(F.array_intersect(words("name"), words("label"))))
    j = j.withColumn("score", score).where(F.col("score") > 0)
    j = j.withColumn("score", F.col("score") + F.when(U.is_catalog(F.col("url")), 5).when(U.is_registration(F.col("url")), 3).otherwise(0))
    once = j.groupBy("page_id", "name", "url").agg(F.min_by("score", "pos").alias("score"), F.min("pos").alias("pos"))
    rank = F.row_number().over(Window.partitionBy("page_id", "name").orderBy(F.col("score").desc(), "pos"))
    return once.withColumn("rank", rank).where(F.col("rank") <= most).drop("pos")


def first_names(records: DataFrame, by: str = "provider_id", order: str = "ord") -> DataFrame:
    """The first record of each name and provider; case and white space at the ends don't count."""
    key = F.lower(strip(text("name")))
    rank = F.row_number().over(Window.partitionBy(by, key).orderBy(order))
    return records.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")
