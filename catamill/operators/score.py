"""Evaluation: recall and precision against ground truth, baselines, and comparisons of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.functions import dates as D
from catamill.functions import texts as T
from catamill.functions import urls as U
from catamill.functions.common import text
from catamill.operators.similar import both_ways, similar_names
from catamill.session import cut


def _inner_hosts(c: str) -> Column:
    """All dotted parts of a host: those that stand inside it between dots or at its ends."""
    labels = F.split(c, r"\.")
    n = F.size(labels)
    cuts = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.array_join(F.slice(labels, i, k), "."))))
    return F.array_distinct(cuts)


def related_hosts(truth: DataFrame, published: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """gh, ph: hosts of both sides that are equal, one of which holds the other between dots, or that are aliases. They
    meet by equality of dotted parts, so no two hosts are compared that share none."""
    a, b = truth.select("gh").where("gh <> ''").distinct(), published.select("ph").where("ph <> ''").distinct()
    inside = b.select("ph", F.explode(_inner_hosts("ph")).alias("gh")).join(a, "gh", "left_semi").select("gh", "ph")
    around = a.select("gh", F.explode(_inner_hosts("gh")).alias("ph")).join(b, "ph", "left_semi").select("gh", "ph")
    both = inside.union(around)
    if aliases is not None:
        both = both.union(aliases.select(F.lower("provider_host").alias("gh"), F.lower("alt_host").alias("ph")))
    return both.distinct()


def _alike(left: DataFrame, right: DataFrame, block: list[str], threshold: float, flavour: str) -> DataFrame:
    """block.., m, n: names of left and right (block.., n) in one block that are equal or reach the threshold."""
    left, right = left.distinct(), right.distinct()
    sided = left.withColumn("side", F.lit(1)).union(right.withColumn("side", F.lit(2))).groupBy(*block, "n").agg(F.bit_or("side").alias("side"))
    found = similar_names(sided, block, threshold, flavour)
    pairs = both_ways(found, block).join(left.withColumnRenamed("n", "m"), [*block, "m"], "left_semi").join(right, [*block, "n"], "left_semi")
    same = left.where("n <> ''").join(right, [*block, "n"], "left_semi")
    return pairs.select(*block, "m", "n").union(same.select(*block, F.col("n").alias("m"), "n"))


def match_programs(truth: DataFrame, published: DataFrame, aliases: DataFrame | None = None, threshold: float = 0.85) -> DataFrame:
    """gt, pub (ids): ground-truth rows and published rows of related hosts with similar names. truth: gt, provider_host,
    program_name, session_dates. published: pub, host, name, dates. aliases: alt_host, provider_host.

    Related: equal, an alias, or one host inside the other between dots."""
    gt = truth.select("gt", F.lower(F.trim(text("provider_host"))).alias("gh"), T.undated_name(F.col("program_name")).alias("gn"), D.day_window(F.col("session_dates")).alias("gw"))
    pub = published.select("pub", F.lower(text("host")).alias("ph"), T.undated_name(F.col("name")).alias("pn"), D.day_window(F.col("dates")).alias("pw"))
    hosts = related_hosts(gt, pub, aliases)
    there, here = gt.select("gh", "gn").distinct().join(hosts, "gh"), pub.select("ph", "pn").distinct().join(hosts, "ph")
    alike = _alike(there.select("gh", "ph", F.col("gn").alias("n")), here.select("gh", "ph", F.col("pn").alias("n")), ["gh", "ph"], threshold, "blocks").select("gh", "ph", F.col("m").alias("gn"), F.col("n").alias("pn"))
    return gt.join(alike, ["gh", "gn"]).join(pub, ["ph", "pn"]).select("gt", "pub", D.overlap(F.col("gw"), F.col("pw")).alias("dates_meet"))


def score_run(truth: DataFrame, published: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """One row: program recall (0 without truth), session recall and precision (null without a base), and their counts."""
    m = match_programs(truth, published, aliases)
    key = F.concat_ws("|", F.lower(F.trim(text("provider_host"))), T.undated_name(F.col("program_name")))
    t = truth.select("gt", key.alias("program"), (F.trim(text("session_dates")) != "").alias("dated"))
    hit = m.groupBy("gt").agg(F.bool_or("dates_meet").alias("meets")).withColumn("hit", F.lit(True))
    sums = t.join(hit, "gt", "left").agg(
        F.countDistinct("program").alias("programs"), F.countDistinct(F.when(F.col("hit"), F.col("program"))).alias("programs_found"),
        F.count_if("dated").alias("sessions"), F.count_if(F.col("dated") & F.coalesce("meets", F.lit(False))).alias("sessions_found"),
    )
    rows = published.select("pub").join(m.select("pub", F.lit(True).alias("hit")).distinct(), "pub", "left").agg(F.count("*").alias("published"), F.count_if(F.coalesce("hit", F.lit(False))).alias("published_hit"))
    both = sums.withColumn("one", F.lit(1)).join(rows.withColumn("one", F.lit(1)), "one").drop("one")
    share = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return both.select("*", F.coalesce(share("programs_found", "programs"), F.lit(0.0)).alias("program_recall"), share("sessions_found", "sessions").alias("session_recall"), share("published_hit", "published").alias("precision"))


def compare_metrics(a: DataFrame, b: DataFrame) -> DataFrame:
    """metric, before, after, delta (null where either is)."""
    return a.toDF("metric", "before").join(b.toDF("metric", "after"), "metric", "full_outer").withColumn("delta", F.col("after") - F.col("before"))


def regressions(baseline: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Counts per key in both runs, and the difference; keys of one run alone count 0 in the other."""
    count = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    return count(baseline, "before").join(count(new, "after"), key, "full_outer").fillna(0, ["before", "after"]).withColumn("delta", F.col("after") - F.col("before"))


def info_validity(published: DataFrame, pages: DataFrame, least: int = 400) -> DataFrame:
    """checked, valid and their share: published rows (name, info_url) whose info page is long enough and names them. pages: url, text."""
    one = pages.groupBy(F.col("url").alias("info_url")).agg(F.first("text").alias("t"))
    j = published.select("name", text("info_url").alias("info_url")).join(one, "info_url", "left")
    ok = (F.length(text("t")) >= least) & T.name_in_text(F.col("name"), F.col("t"))
    return j.agg(F.count("*").alias("checked"), F.count_if(ok).alias("valid")).withColumn("info_url_validity", F.try_divide("valid", "checked"))


def _program_rows(rows: DataFrame, *more: Column) -> DataFrame:
    """host, norm, url (and more) of each row, worked out once and kept, as several joins read them. They are dealt to all
    tasks first: few tasks read a small file, but an address takes many times as long as its reading."""
    host = F.coalesce(F.nullif(U.host_of(F.col("register_url")), F.lit("")), U.host_of(F.col("source_url")))
    dealt = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return cut(dealt.select(host.alias("host"), T.identity_name(F.col("name")).alias("norm"), F.regexp_replace(U.canonical_url(F.col("register_url")), "/+$", "").alias("url"), *more))


def match_baseline(baseline: DataFrame, published: DataFrame, threshold: float = 0.75) -> DataFrame:
    """host, norm, exact, by_url, fuzzy of each programme of the baseline: whether the published rows have it by host and
    name, by a shared registration address, or under a similar name on the same host. Rows: name, register_url, source_url."""
    return _matched(_program_rows(baseline), _program_rows(published), threshold)


def _matched(base: DataFrame, pub: DataFrame, threshold: float) -> DataFrame:
    programs, there = base.select("host", "norm").distinct(), pub.select("host", "norm").distinct()
    exact = programs.join(there, ["host", "norm"], "left_semi").withColumn("exact", F.lit(True))
    urls = pub.select("url").where("url <> ''").distinct()
    by_url = base.where("url <> ''").join(urls, "url", "left_semi").select("host", "norm").distinct().withColumn("by_url", F.lit(True))
    m = cut(programs.join(exact, ["host", "norm"], "left").join(by_url, ["host", "norm"], "left").fillna(False, ["exact", "by_url"]))  # read twice
    rest = m.where(~F.col("exact") & ~F.col("by_url")).select("host", "norm")
    alike = _alike(rest.toDF("host", "n"), there.toDF("host", "n"), ["host"], threshold, "indel").select("host", F.col("m").alias("norm")).distinct().withColumn("alike", F.lit(True))
    return m.join(alike, ["host", "norm"], "left").withColumn("fuzzy", F.col("exact") | F.col("by_url") | F.coalesce("alike", F.lit(False))).drop("alike")


def score_baseline(baseline: DataFrame, published: DataFrame, provider_hosts: DataFrame, threshold: float = 0.75) -> DataFrame:
    """One row: strict and fuzzy programme recall, session recall by address, precision, and the share of providers that
    are published, each to four digits and 0 without a base. published: parent_verdict as well. provider_hosts: host."""
    hs, ok = F.array_distinct(F.array(U.host_of(F.col("register_url")), U.host_of(F.col("source_url")))), ~text("parent_verdict").isin("wrong_audience", "off_season")
    base, pub = _program_rows(baseline), _program_rows(published, hs.alias("hs"), ok.alias("ok"))
    m = _matched(base, pub, threshold)
    share = lambda a, b: F.round(F.col(a) / F.greatest(F.col(b), F.lit(1)), 4)
    programs = m.agg(F.count("*").alias("programs"), F.count_if(F.col("exact") | F.col("by_url")).alias("strict"), F.count_if("fuzzy").alias("loose"))
    urls = pub.select("url").where("url <> ''").distinct().withColumn("hit", F.lit(True))
    sessions = base.where("url <> ''").join(urls, "url", "left").agg(F.count("*").alias("sessions"), F.count("hit").alias("sessions_found"))
    hosts = cut(provider_hosts.select(F.lower("host").alias("h")).where("h <> ''").distinct())  # read three times
    each = pub.withColumn("row", F.monotonically_increasing_id()).select("row", "ok", F.explode("hs").alias("h")).where("h <> ''")
    precise = each.where("ok").join(hosts, "h", "left_semi").agg(F.countDistinct("row").alias("precise"))
    covered = hosts.join(each.select("h").distinct(), "h", "left_semi").agg(F.count("*").alias("covered"))
    out = programs.crossJoin(sessions).crossJoin(precise).crossJoin(covered).crossJoin(pub.agg(F.count("*").alias("published"))).crossJoin(hosts.agg(F.count("*").alias("providers")))  # one row each
    return out.select(
        "programs", "sessions", "published", "providers", share("strict", "programs").alias("recall_strict"), share("loose", "programs").alias("recall_fuzzy"), share("sessions_found", "sessions").alias("session_recall"),
        share("precise", "published").alias("precision"), share("covered", "providers").alias("providers_covered"),
    )
