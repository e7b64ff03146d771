"""URL filters: block and allow rules by host and path, and empirical-Bayes host reputation for all other pages.

Native: DataFrame functions only. Outcomes of labelled pages shrink through beta-binomial priors from the host to its
registered domain to its suffix to all pages; a host is blocked when a proven lower bound of its posterior bad rate is high.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.llm.common import join_lookup, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Labels under which names are registered in countries' domains (as in co.uk); a suffix has two labels
#: where one of these stands before a top-level domain of two letters.
SECOND_LEVEL = (
    "ac", "asn", "co", "com", "edu", "gen", "go", "gob", "gouv", "gov", "id", "info", "ltd", "me", "mil", "ne", "net", "nhs", "nom", "or", "org", "plc", "police", "sch", "web",
)
IP = r"^(?:\d{1,3}(?:\.\d{1,3}){3}|\[.*\])$"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Reputation:
    """block_rate: bad rate that the posterior's lower bound must exceed. error: how probable a rate under the bound is at most.
    rho_low, rho_high: range of the estimated intra-class correlation, from which the prior's strength (1-rho)/rho follows."""

    block_rate: float = 0.5
    error: float = 0.05
    rho_low: float = 0.001
    rho_high: float = 0.5


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or end, A-Z lower-cased; empty for null or without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or end; empty for null or without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, second_level: Sequence[str] = SECOND_LEVEL) -> Column:
    """The part of a host under which names are registered; of an address of numbers, the address. Ports don't count."""
    bare = F.regexp_replace(host, r":\d*$", "")
    two = F.regexp_extract(bare, rf"(?:^|\.)((?:{'|'.join(second_level)})\.[a-z]{{2}})$", 1)
    return F.when(bare.rlike(IP), bare).when(two != "", two).otherwise(F.substring_index(bare, ".", -1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one label more; the host itself where it has no more labels."""
    bare = F.regexp_replace(host, r":\d*$", "")
    labels = F.size(F.split(suffix, r"\."))
    return F.when(bare == suffix, bare).when(labels == 2, F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def _strength(groups: DataFrame, by: list[str], p: Reputation) -> DataFrame:
    """Method of moments over the children (n > 0) of each group: n, k, and the strength of the prior that they share."""
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    seen = F.col("n") > 0
    sums = groups.groupBy(*by).agg(
        F.sum("n").alias("gn"), F.sum("k").alias("gk"), F.sum(F.when(seen, 1).otherwise(0)).alias("j"),
        F.sum(n * n).alias("n2"), F.sum(F.when(seen, k * k / n)).alias("k2n"),
    )
    gn, gk = F.nullif(F.col("gn").cast("double"), F.lit(0.0)), F.col("gk").cast("double")
    mu = gk / gn
    between = F.coalesce(F.col("k2n"), F.lit(0.0)) - gk * mu
    unit, free = mu * (1 - mu), F.col("j") - 1
    below = (gn - F.col("n2") / gn - free) * unit
    rho = F.when(below > 1e-9, (between - free * unit) / below)
    rho = F.greatest(F.lit(p.rho_low), F.least(F.lit(p.rho_high), F.coalesce(rho, F.lit(p.rho_high))))
    return sums.select(*by, F.col("gn").alias("n"), F.col("gk").alias("k"), ((1 - rho) / rho).alias("m"))


def reputation(hosts: DataFrame, p: Reputation = Reputation()) -> DataFrame:
    """hosts: host, suffix, domain, n labelled pages, k bad ones (0 allowed). Returns host, bad_rate, bad_low, blocked.

    A host's posterior is a beta law with mean bad_rate and `total` = its pages and the prior's strength. A beta law of
    parameters a, b is sub-Gaussian with variance factor 1 / (4 (a + b + 1)), so that its chance to lie under bad_low,
    the mean less sqrt(log(1 / error) / (2 (total + 1))), is `error` at most, whatever the counts."""
    # Row counts fall from hosts to domains to suffixes to one; each level needs its parent's mean and strength.
    domains = _strength(hosts, ["suffix", "domain"], p)
    suffixes = _strength(domains.select("suffix", "n", "k"), ["suffix"], p)
    top = _strength(suffixes.select("n", "k"), [], p).first()  # one row of sums
    up, um = ((top.k + 0.5) / (top.n + 1.0), top.m) if top.n else (0.0, top.m)
    mean = (F.col("k") + F.col("um") * F.col("up")) / (F.col("n") + F.col("um"))
    suffixes = suffixes.select("suffix", "n", "k", "m", F.lit(up).alias("up"), F.lit(um).alias("um")).select("suffix", mean.alias("up"), F.col("m").alias("um"))
    domains = domains.join(suffixes, "suffix").select("suffix", "domain", mean.alias("up"), F.col("m").alias("um"))
    total = F.col("n") + F.col("um")
    low = F.col("bad_rate") - F.sqrt(F.lit(math.log(1 / p.error)) / (2 * (F.col("total") + 1)))
    return (
        hosts.join(domains, ["suffix", "domain"])
        .select("host", mean.alias("bad_rate"), total.alias("total"))
        .select("host", "bad_rate", F.greatest(F.lit(0.0), low).alias("bad_low"))
        .withColumn("blocked", F.col("bad_low") > p.block_rate)
    )


def text_key(text: Column) -> Column:
    """Hash of a text without white space, which pages and documents break differently; null without any text."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s\u00a0]+", "")
    return F.when(bare != "", F.sha2(bare, 256))


def held_text(html: Column) -> Column:
    """Text of the first article (else main, else body) after its first heading: no comments or tags, entities as their characters."""
    html = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", "")
    inner = F.coalesce(*[F.nullif(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1), F.lit("")) for tag in ("article", "main", "body")])
    text = F.regexp_replace(F.regexp_replace(inner, r"(?is)^\s*<h1\b[^>]*>.*?</h1\s*>", ""), r"<[^>]*>", "")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def outcomes_of(pages: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, bad: one row per distinct page (page_id, html) that holds the whole text of a labelled document.

    documents: doc_id, text. labels: doc_id, bad (null: not labelled). A text that several labelled documents have is
    bad if half of its labels or more are."""
    keys = documents.select("doc_id", text_key(F.col("text")).alias("key")).where(F.col("key").isNotNull())
    marks = keys.join(labels.where(F.col("bad").isNotNull()), "doc_id").groupBy("key").agg((F.avg(F.col("bad").cast("int")) >= 0.5).alias("bad"))
    held = join_lookup(pages.select("page_id", text_key(held_text(F.col("html"))).alias("key")), written(marks, "marks"), ["key"], "inner")
    return held.distinct().select("page_id", "bad")


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], p: Reputation = Reputation()) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate, bad_low per row of pages (page_id, url; other columns are not read).

    outcomes: page_id, bad (boolean; null: not labelled), at most a few rows a page; several rows of one page all count.
    A null url has an empty host, which is a host like others; very long urls are read whole; repeated pages are judged alike; without any outcome
    nothing but the rules blocks. Tables may be empty.
    """
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    marks = outcomes.where(F.col("bad").isNotNull()).groupBy("page_id").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
    known = pages.select("page_id", "host").join(marks, "page_id", "left").select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).alias("k"))
    hosts = known.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("suffix", suffix_of(F.col("host")))
    hosts = written(hosts.withColumn("domain", domain_of(F.col("host"), F.col("suffix"))), "hosts")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    fame = written(reputation(hosts, p), "fame")
    return join_lookup(pages, fame, ["host"]).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"), "bad_rate", "bad_low",
    )
