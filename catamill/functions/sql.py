"""Functions for SQL texts of a session: `canonical_url`, `host_of`, `registered_domain`, `summer_window` and `gate_reason` as
temporary SQL functions, which Catalyst inlines, and the table function `page_links(base, html)` for lateral joins.

They give what the column functions of the same names give; their tests hold them side by side."""

from __future__ import annotations

import re
from urllib.parse import urljoin

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from catamill.functions import dates as D
from catamill.functions import urls as U
from catamill.operators import gates as G


def _r(pattern: str) -> str:
    """A pattern as a raw SQL text."""
    if '"' not in pattern:
        return f'r"{pattern}"'
    return f"r'{pattern}'"


def _part(u: str, n: int) -> str:
    return f"regexp_extract(regexp_replace(coalesce({u}, ''), {_r(r'(?U)^\s+|\s+$')}, ''), {_r(U._PARTS)}, {n})"


def _decoded(x: str) -> str:
    return f"try_url_decode(regexp_replace({x}, {_r('%(?![0-9A-Fa-f]{2})')}, '%25'))"


def _encoded(x: str) -> str:
    return f"replace(replace(url_encode({x}), '%7E', '~'), '*', '%2A')"


def _rules(pairs: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{reason}'" for reason, test in pairs) + " END"


def _definitions() -> dict[str, str]:
    """The bodies by head, in the order in which they use each other."""
    bare = f"regexp_replace(coalesce(host, ''), {_r(r':\d+$')}, '')"
    suffix = U.LONG_SUFFIX.removeprefix(r"(?:^|\.)(").removesuffix(")$")
    pairs = (
        f"transform(filter(split({_part('url', 4)}, '&'), x -> x <> ''), x -> named_struct('k', {_decoded("substring_index(x, '=', 1)")},"
        f" 'v', coalesce({_decoded(f"CASE WHEN contains(x, '=') THEN regexp_replace(x, {_r('^[^=]*=')}, '') END")}, '')))"
    )
    volatile = ", ".join(f"'{v}'" for v in U.VOLATILE)
    kept = f"array_sort(filter({pairs}, p -> NOT p.k RLIKE {_r(U.TRACKING)} AND lower(p.k) NOT IN ({volatile})))"
    months = f"transform(regexp_extract_all(coalesce(dates, ''), {_r(D.MONTH)}, 0), x -> CASE WHEN x RLIKE '^[0-9]' THEN CAST(split(x, '/')[0] AS INT) ELSE CAST((instr('janfebmaraprmayjunjulaugsepoctnovdec', lower(left(x, 3))) + 2) / 3 AS INT) END)"
    low = lambda c, p: f"coalesce({c}, '') RLIKE {_r('(?iU)' + p)}"
    at, camp = f"lower({_part('url', 3)})", f"({low('name', G.CAMP_WORD)} AND NOT coalesce(name, '') RLIKE {_r(r'(?i)^\W*boot\s*camp\W*$')})"
    return {
        "host_of(url STRING) RETURNS STRING": f"regexp_replace(lower({_part('url', 2)}), {_r(r'^www\.')}, '')",
        "registered_domain(host STRING) RETURNS STRING": (
            f"CASE WHEN {bare} RLIKE {_r(r'^\d{1,3}(?:\.\d{1,3}){3}$')} THEN {bare} WHEN {bare} RLIKE {_r(U.LONG_SUFFIX)} THEN regexp_extract({bare}, {_r(rf'(?:[^.]+\.)?(?:{suffix})$')}, 0)"
            f" ELSE regexp_extract({bare}, {_r(r'(?:[^.]*\.)?[^.]*$')}, 0) END"
        ),
        "url_parameters(url STRING) RETURNS ARRAY<STRUCT<k: STRING, v: STRING>>": kept,
        "canonical_url(url STRING) RETURNS STRING": (
            f"CASE WHEN {_part('url', 1)} = '' OR {_part('url', 2)} = '' THEN regexp_replace(coalesce(url, ''), {_r(r'(?U)^\s+|\s+$')}, '') ELSE concat('https://', host_of(url), CASE WHEN {_part('url', 3)} = '/' THEN '/'"
            f" ELSE regexp_replace({_part('url', 3)}, '/+$', '') END, CASE WHEN size(url_parameters(url)) > 0 THEN concat('?', array_join(transform(url_parameters(url), p -> concat({_encoded('p.k')}, '=', {_encoded('p.v')})), '&')) ELSE '' END) END"
        ),
        "summer_window(dates STRING) RETURNS BOOLEAN": f"coalesce(get(filter({months}, m -> m BETWEEN 1 AND 12), 0) BETWEEN 6 AND 8, coalesce(dates, '') RLIKE {_r(r'(?i)summer\s+20\d{2}')})",
        "gate_reason(name STRING, url STRING) RETURNS STRING": _rules([
            ("job", f"{low('name', G.JOB_NAME)} OR {at} RLIKE {_r(G.JOB_PATH)}"), ("lessons", f"{low('name', G.LESSON_NAME)} AND NOT {camp}"), ("resource page", f"{low('name', G.RESOURCE_NAME)} OR {at} RLIKE {_r(G.RESOURCE_PATH)}"),
            ("school service", f"{low('name', G.SCHOOL_SERVICE)} OR {at} RLIKE {_r(G.SCHOOL_PATH)}"),
        ]),
    }


_ANCHOR = re.compile(r"<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>", re.I | re.S)
_TAG, _SPACE = re.compile(r"<[^>]+>", re.S), re.compile(r"\s+")


@udtf(returnType="pos: int, url: string, label: string")
class PageLinks:
    """The links of a page, absolute and in page order; those that lead nowhere are left out."""

    def eval(self, base: str, html: str):
        for pos, m in enumerate(_ANCHOR.finditer(html or "")):
            href = m[1].strip()
            if not href or re.match(r"(?i)javascript:|mailto:|tel:|#", href):
                continue
            try:
                url = urljoin(base or "", href)
            except ValueError:
                continue
            if url.lower().startswith(("http://", "https://")):
                yield pos, url, _SPACE.sub(" ", _TAG.sub(" ", m[2])).strip()


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session's SQL."""
    for head, body in _definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.udtf.register("page_links", PageLinks)
