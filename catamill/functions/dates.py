"""Four readings of dates in free text, which differ on purpose: the first month, the first date, the span of all dates,
and a window without years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catamill.functions.common import bind, text

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_NAMES = "|".join(MONTHS)

# How the four readings find months and dates. They differ on purpose.
MONTH = rf"(?i)\b({_NAMES})[a-z]*\b|\b(\d{{1,2}})/\d{{1,2}}\b"
FIRST_ISO, FIRST_NAMED, FIRST_NUMERIC = r"\b(\d{4})-(\d{1,2})-(\d{1,2})\b", rf"(?i)\b({_NAMES}|sept)[a-z.]*\s+(\d{{1,2}})(?:,?\s*(\d{{4}}))?\b", r"\b(\d{1,2})[/-](\d{1,2})(?:[/-](\d{2,4}))?\b"
SPAN_ISO, SPAN_NUMERIC = r"\b(\d{4})-(\d{2})-(\d{2})\b", r"\b(\d{1,2})/(\d{1,2})(?:/(\d{2,4}))?\b"
SPAN_NAMED = rf"(?i)\b({_NAMES})[a-z]*\.?\s+(\d{{1,2}})(?:\s*[-–]\s*(\d{{1,2}}))?(?:\s*,?\s*(\d{{4}}))?"
WINDOW_NAMED, WINDOW_NUMERIC, WINDOW_ISO = r"(?i)\b([a-z]{3,9})\.?\s*(\d{1,2})\b", r"\b(\d{1,2})/(\d{1,2})(?:/\d{2,4})?\b", r"\b\d{4}-(\d{2})-(\d{2})\b"


def month_number(name: Column) -> Column:
    """1 to 12 by the first three letters, else null."""
    at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(name, 1, 3)))
    return F.get(F.array(F.lit(None).cast("int"), *[F.lit(k) for k in range(1, 13)]), at.cast("int"))


def _int(c: Column) -> Column:
    return c.try_cast("int")  # empty texts are null


def _date(y: Column, m: Column, d: Column) -> Column:
    """Null where there is no such day. By numbers alone: a text that is no date would cost an exception a row."""

    def made(x: Column) -> Column:
        first = F.make_date(x["y"], F.when(x["m"].between(1, 12), x["m"]), F.lit(1))
        return F.when(x["d"].between(1, F.day(F.last_day(first))), F.date_add(first, x["d"] - 1))

    return bind(F.struct(y.alias("y"), m.alias("m"), d.alias("d")), made)


def starts_in_summer(dates: Column, accept_iso: bool = False) -> Column:
    """Whether the first month that the text names, by word or as m/d, is June to August; without any, whether it says
    `summer 20xx`. ISO dates name no month, unless asked for."""
    t = text(dates)
    found = F.transform(_all(t, MONTH, 1, 2), lambda x: F.when(x["g1"] != "", month_number(x["g1"])).otherwise(_int(x["g2"])))
    first = F.get(F.filter(found, lambda m: m.between(1, 12)), 0)
    if accept_iso:
        first = F.coalesce(_int(F.regexp_extract(t, r"\b\d{4}-(\d{1,2})-\d{1,2}\b", 1)), first)
    return F.coalesce(bind(first, lambda m: m.between(6, 8)), t.rlike(r"(?i)summer\s+20\d{2}"))


def _short_year(y: Column, year: int | Column) -> Column:
    """Years of two digits are of this century; missing ones are `year`."""
    return bind(y, lambda y: F.coalesce(F.when(y < 100, y + 2000).otherwise(y), F.lit(year)))


def first_date(blob: Column, year: int) -> Column:
    """The first ISO date; without one the first with a month's name, else the first numeric one. Years default to `year`. Null if that date does not exist."""
    t = text(blob)

    def found(pattern: str, date, otherwise: Column | None = None) -> Column:
        """The date of the first match, which is short; the text is searched once, and for later patterns only where this one is not there."""
        part = lambda one: date(*[F.regexp_extract(one, pattern, k) for k in (1, 2, 3)])
        return bind(F.regexp_extract(t, pattern, 0), lambda one: F.when(one != "", part(one)).otherwise(F.lit(None).cast("date") if otherwise is None else otherwise))

    num = found(FIRST_NUMERIC, lambda m, d, y: _date(_short_year(_int(y), year), _int(m), _int(d)))
    named = found(FIRST_NAMED, lambda m, d, y: _date(F.coalesce(_int(y), F.lit(year)), month_number(m), _int(d)), num)
    return found(FIRST_ISO, lambda y, m, d: _date(_int(y), _int(m), _int(d)), named)


def _all(t: Column, pattern: str, *groups: int) -> Column:
    """array<struct<g1, ..>> of all matches."""
    return F.arrays_zip(*[F.regexp_extract_all(t, F.lit(pattern), F.lit(g)).alias(f"g{g}") for g in groups])


def _bounds(found: Column, first: str, last: str) -> Column:
    """The least and the greatest of the values, null without any."""
    return bind(F.array_compact(found), lambda x: F.when(F.size(x) > 0, F.struct(F.array_min(x).alias(first), F.array_max(x).alias(last))))


def date_span(blob: Column, year: int) -> Column:
    """struct<first, last> of all dates in the text (null without any); years default to `year`."""
    t = text(blob)
    iso = F.transform(_all(t, SPAN_ISO, 1, 2, 3), lambda x: _date(_int(x["g1"]), _int(x["g2"]), _int(x["g3"])))
    numbers = F.transform(_all(t, SPAN_NAMED, 1, 2, 3, 4), lambda x: F.struct(F.coalesce(_int(x["g4"]), F.lit(year)).alias("y"), month_number(x["g1"]).alias("m"), _int(x["g2"]).alias("d"), _int(x["g3"]).alias("e")))
    named = F.flatten(F.transform(numbers, lambda x: F.array(_date(x["y"], x["m"], x["d"]), F.when(x["e"].isNotNull(), _date(x["y"], x["m"], x["e"])))))
    num = F.transform(_all(t, SPAN_NUMERIC, 1, 2, 3), lambda x: _date(_short_year(_int(x["g3"]), year), _int(x["g1"]), _int(x["g2"])))
    return _bounds(F.concat(iso, named, num), "first", "last")


def day_window(blob: Column) -> Column:
    """struct<lo, hi> of month * 31 + day over all dates in the text, years ignored (null without any)."""
    t = text(blob)
    named = F.transform(_all(t, WINDOW_NAMED, 1, 2), lambda x: month_number(x["g1"]) * 31 + _int(x["g2"]))
    numbers = F.transform(_all(t, WINDOW_NUMERIC, 1, 2), lambda x: F.struct(_int(x["g1"]).alias("m"), _int(x["g2"]).alias("d")))
    num = F.transform(numbers, lambda x: F.when(x["m"].between(1, 12) & x["d"].between(1, 31), x["m"] * 31 + x["d"]))
    iso = F.transform(_all(t, WINDOW_ISO, 1, 2), lambda x: _int(x["g1"]) * 31 + _int(x["g2"]))
    return _bounds(F.concat(named, num, iso), "lo", "hi")


def overlap(a: Column, b: Column) -> Column:
    return F.coalesce((a["lo"] <= b["hi"]) & (b["lo"] <= a["hi"]), F.lit(False))


def in_season(date: Column, first: str = "06-01", last: str = "08-31") -> Column:
    """Whether month and day are in the season, whatever the year; null dates stay null."""
    return F.date_format(date, "MM-dd").between(first, last)
