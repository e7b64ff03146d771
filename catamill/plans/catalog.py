"""Registered queries of catalog jobs (gates, verdicts, seeds, sources, linkage, streams) over whole driver tables, whose
columns take the roles that the jobs ask for."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catamill.functions import hosts as H
from catamill.functions import sql
from catamill.functions import urls as U
from catamill.operators import coverage, extract, gates, geo, linkage, links, monitor, records, relevance, reports, score, suffixes, verdicts
from catamill.session import shared_dir, table
from catamill.sources import catalog as files
from catamill.streaming import jobs as streams
from catamill.streaming import stores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


def _place(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/catalog-{uuid.uuid4().hex}"


# Rules


@query
def relevance_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as catalog rows: kept or dropped, with the first reason; ambiguous drops with a price are taken up again."""
    kind = F.when(F.col("p_size") % 4 == 0, "Summer Camp").when(F.col("p_size") % 4 == 1, "Adult Yoga").when(F.col("p_size") % 4 == 2, "October").otherwise("Robots")
    p = table(spark, sf, "part").select(
        F.concat_ws(" ", kind, "p_name").alias("name"), F.when(F.col("p_size") > 25, F.lit("ages 7-12")).otherwise("").alias("ages"), F.lit("").alias("dates"), F.lit("").alias("text"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("$20")).otherwise("").alias("price"), F.concat(F.lit("https://lex.myrec.com/"), "p_partkey").alias("register_url"),
        F.when(F.col("p_type") == "ECONOMY", "webtrac").when(F.col("p_type") == "PROMO", "catalog_grid").otherwise("").alias("platform"),
    )
    out = relevance.recover(relevance.classify(p))
    return out.groupBy("platform", "keep", "focus_reason").agg(F.count("*").alias("n"))


@query
def noncamp_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The reason of each part's name and address, counted."""
    p = table(spark, sf, "part")
    kinds = ("Counselor wanted", "Swim lessons", "Swim lessons camp", "Newsletter", "ESL program", "Learning Center", "Day camp")
    name = F.concat_ws(" ", F.get(F.array(*[F.lit(k) for k in kinds]), (F.col("p_size") % 7).cast("int")), "p_name")
    url = F.when(F.col("p_partkey") % 11 == 0, F.lit("https://a.org/careers/x")).otherwise("https://a.org/x")
    reason = gates.noncamp_reason(name, url, F.lit(""), F.lit(""), F.col("p_partkey") % 2 == 0)
    return p.groupBy((F.col("p_size") % 7).cast("long").alias("kind"), F.coalesce(reason, F.lit("camp")).alias("reason")).agg(F.count("*").alias("n"))


@query
def publish_gate_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents as programmes with their texts as information pages, so that every reason comes up: published, for
    review (in one of two modes), or a gap with its evidence."""
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    m = F.col("doc_id") % 12
    opening = F.when(m == 6, "Camp camper kids clinical therapist patients ").otherwise("Camp camper kids ")
    pages = d.select(F.concat(F.lit("https://a.org/"), "doc_id").alias("key"), F.concat(opening, F.coalesce("text", F.lit(""))).alias("text"))
    s = lab.select(
        F.lit("Camp").alias("program_name"), F.lit("").alias("provider_name"), F.when(m == 0, "Read more").when(m == 3, "Robotics Zephyr").when(m == 4, "Kids lessons").otherwise("Camper Camp").alias("name"),
        F.concat(F.when(m == 1, "https://a.org/texas/").when(m == 2, "https://b.org/").otherwise("https://a.org/"), "doc_id").alias("info_url"), F.lit("https://lex.myrec.com/x").alias("register_url"),
        F.when(m == 7, "October 3").when(m == 8, "").otherwise("July 6-10").alias("dates"), F.when(m == 5, "18+").otherwise("").alias("ages"), F.lit("").alias("price"), (~m.isin(6, 8)).alias("camp_scoped"),
    )
    both = gates.judged_sessions(s, pages).withColumn("review", F.explode(F.array(F.lit(False), F.lit(True))))  # judged once for both modes
    out = gates.publish_judged(both, F.col("review"))
    return out.groupBy("review", "status", F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce("evidence", F.lit("")).alias("evidence"), F.coalesce("verdict", F.lit("")).alias("verdict")).agg(F.count("*").alias("n"))


@query
def published_rows_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as rows to publish: held, with the first reason, or labelled."""
    o = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "parent_ready").when(F.col("o_orderstatus") == "O", "brochure_only").otherwise("").alias("parent_verdict"),
        F.when(F.col("o_custkey") % 5 == 0, "program").otherwise("").alias("granularity"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("dates"), F.concat(F.lit("Camp "), F.when(F.col("o_custkey") % 7 == 0, "Senior").otherwise("x")).alias("name"),
    )
    out = gates.publish_rows(o, year=1996)
    return out.groupBy(F.coalesce("held_reason", F.lit("")).alias("held_reason"), F.coalesce("label", F.lit("")).alias("label")).agg(F.count("*").alias("n"))


@query
def junk_reasons_customers(spark: SparkSession, sf: str) -> DataFrame:
    """All reasons against each customer as a row, counted one by one; every row is in one of kept and quarantined."""
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(
        F.when(k % 5 == 0, "Read more").when(k % 5 == 1, "12345").otherwise(F.col("c_name")).alias("name"), F.when(k % 7 == 0, "").when(k % 7 == 1, "https://b.org/x").otherwise("https://a.org/x").alias("register_url"), F.lit("").alias("info_url"),
        F.lit("https://www.a.org/").alias("source_url"), F.when(k % 3 == 0, "program").otherwise("").alias("granularity"), F.lit("").alias("ages"), F.lit("").alias("dates"), F.when(F.col("c_acctbal") > 0, "$1").otherwise("").alias("price"),
    )
    out = gates.junk_reasons(c)
    return out.select(F.explode(F.when(F.size("reasons") == 0, F.array(F.lit("kept"))).otherwise(F.col("reasons"))).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query
def verdict_buckets_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders through the platform's policy, the programme floor and the buckets."""
    o = table(spark, sf, "orders").select(
        F.lit("x").alias("name"), F.when(F.col("o_orderstatus") == "F", "parent_ready").when(F.col("o_orderstatus") == "O", "unverified").otherwise("").alias("parent_verdict"), F.when(F.col("o_custkey") % 3 == 0, "MyRec").otherwise("").alias("platform"),
        F.when(F.col("o_orderkey") % 7 == 0, "https://a.org/x.pdf").otherwise("https://lex.myrec.com/x").alias("register_url"), F.lit("").alias("source_url"), F.lit("").alias("kind"), F.when(F.col("o_custkey") % 5 == 0, "program").otherwise("").alias("granularity"),
    )
    floored = o.withColumn("parent_verdict", verdicts.program_floor(F.col("granularity"), F.col("parent_verdict")))
    out = verdicts.with_buckets(verdicts.with_policy(floored))
    return out.groupBy("platform", "parent_verdict", "bucket").agg(F.count("*").alias("n"))


@query
def register_gate_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers' registrations against checks of two thirds of them."""
    s = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("https://a.org/"), "s_suppkey").alias("register_url"), F.lit(True).alias("registrable"), (F.col("s_acctbal") > 0).alias("parent_ready"))
    checks = s.where("s_suppkey % 3 <> 0").select(F.col("register_url").alias("url"), F.when(F.col("s_suppkey") % 4 == 0, 404).otherwise(200).alias("status"), F.when(F.col("s_suppkey") % 2 == 0, "Register now").otherwise("hello").alias("html"))
    out = gates.register_gate(s, checks)
    return out.groupBy("registrable", "parent_ready", F.coalesce("gate_reason", F.lit("")).alias("gate_reason")).agg(F.count("*").alias("n"))


# Hosts, links and places


@query
def url_triage_links(spark: SparkSession, sf: str) -> DataFrame:
    """All links of all pages by review class and by whether they likely lead to camps."""
    found = links.extract_links(table(spark, sf, "pages"))
    return found.groupBy(H.url_triage(F.col("url")).alias("triage"), (H.candidate_score(F.col("url"), F.col("label")) > 0).alias("candidate")).agg(F.count("*").alias("n"))


@query
def institution_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts of pages by kind: the dimension holds the registered domains of the first pages, which stand for all their subdomains."""
    p = table(spark, sf, "pages").select("page_id", U.host_of(F.col("url")).alias("host"))
    dim = p.groupBy(U.registered_domain(F.col("host")).alias("host")).agg(F.min("page_id").alias("k")).where("k % 2 = 0").select("host", F.when(F.col("k") % 4 == 0, "college").otherwise("public").alias("kind"))
    out = H.institution_kind(p, "host", dim)
    return out.groupBy("host", F.coalesce("institution", F.lit("none")).alias("institution")).agg(F.count("*").alias("n"))


@query
def seed_per_domain_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as candidates for seeds: which stay, and why the others don't."""
    p = table(spark, sf, "pages").select("url", F.when(F.col("page_id") % 10 == 0, "guide").otherwise("").alias("classified_as"), F.col("page_id").alias("ord"))
    out = links.one_seed_per_domain(p)
    return out.select(F.col("ord").alias("page_id"), "kept", "why")


@query
def domain_cap_pages(spark: SparkSession, sf: str) -> DataFrame:
    """At most four pages of a registered domain, in order."""
    p = table(spark, sf, "pages").select("url", F.col("page_id").alias("ord"))
    return links.cap_per_domain(p, 4).select(F.col("ord").alias("page_id"), "domain", *_long("domain_rank"))


@query
def discovered_registry_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Per language of a page's path, as a town, its hosts in order of discovery."""
    p = table(spark, sf, "pages").select(F.regexp_extract("url", r"://[^/]*/([a-z]*)", 1).alias("town"), "url", F.col("page_id").alias("ord"))
    return links.discovered_registry(p, 10).select("town", "host", "seed", "vendor", *_long("rank"))


@query
def venue_tags_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' venues of free text: town by ZIP, then by name; kept on evidence of the home state alone."""
    k = F.col("c_custkey")
    where = F.when(k % 4 == 0, F.concat(F.lit("Hall, Town"), k % 9, F.lit("x, MA "))).when(k % 4 == 1, F.concat(F.lit("Field, Nashua, NH 0"), 3000 + k % 50)).when(k % 4 == 2, F.concat(F.lit("Yard 0"), 1700 + k % 20)).otherwise("")
    towns = table(spark, sf, "nation").select(F.concat(F.lit("Town"), "n_nationkey").alias("town"), F.concat(F.lit("0"), F.col("n_nationkey") + 1700).alias("zip"))
    out = geo.tag_venues(table(spark, sf, "customer").select(where.alias("venue")), towns)
    return out.groupBy("geo_town", "geo_state", "geo_keep", F.coalesce("geo_reject", F.lit("")).alias("geo_reject")).agg(F.count("*").alias("n"))


# SQL texts, and rules as tables


@query
def sql_links_by_host(spark: SparkSession, sf: str) -> DataFrame:
    """Links of all pages by host and domain, in one SQL text with the library's functions and its table function."""
    sql.register(spark)
    table(spark, sf, "pages").createOrReplaceTempView("catamill_pages")
    return spark.sql("""
      WITH l AS (SELECT host_of(l.url) AS host, canonical_url(l.url) AS url, gate_reason(concat(CASE WHEN l.pos % 4 = 1 THEN 'Swim lessons ' ELSE '' END, l.label), l.url) AS reason,
        summer_window(CASE l.pos % 3 WHEN 0 THEN 'July 6' WHEN 1 THEN '10/3' ELSE l.label END) AS summer FROM catamill_pages p, LATERAL page_links(p.url, p.html) l)
      SELECT host, registered_domain(host) AS domain, count(*) AS n, count(DISTINCT url) AS urls, count_if(summer) AS summer, count_if(reason = 'lessons') AS lessons, count_if(reason IS NULL) AS camps FROM l GROUP BY host""")


@query
def domains_by_rules_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages by registered domain, suffixes being those of a table of rules with a wildcard and an exception."""
    rules = spark.createDataFrame([(r,) for r in ("com", "net", "org", "example.com", "*.example.net", "!blog.example.net", "!news.example.net")], "rule string")
    p = table(spark, sf, "pages").select(U.host_of(F.col("url")).alias("host"))
    return suffixes.registered_domains(p, rules).groupBy("suffix", "domain").agg(F.count("*").alias("n"))


# Verdicts, coverage and evaluation


@query
def fallback_rows_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as providers: of those known, the ones of whose items a third at most was returned get one row of their own."""
    s = table(spark, sf, "supplier").select(F.concat(F.lit("https://s"), "s_suppkey", F.lit(".example.com/")).alias("seed"), F.col("s_name").alias("provider_name"), F.lit("").alias("platform"), F.lit("").alias("register_url"), "s_suppkey", "s_acctbal")
    lines = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count("*").alias("n"))
    busy = lines.where(F.col("returned") * 3 > F.col("n")).select(F.concat(F.lit("https://s"), "l_suppkey", F.lit(".example.com/")).alias("seed"))
    known = s.where("s_acctbal > 0").select(F.concat(F.lit("s"), "s_suppkey", F.lit(".example.com")).alias("host"))
    return verdicts.fallback_rows(s, busy, known).select("name", "register_url", "granularity", "platform")


@query
def stale_programs_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' rows by nation as host: programme rows go where the nation has a session row."""
    c = table(spark, sf, "customer").select("c_custkey", F.when((F.col("c_nationkey") % 3 > 0) | (F.col("c_custkey") % 4 == 0), "program").otherwise("").alias("granularity"), F.concat(F.lit("https://n"), "c_nationkey", F.lit(".example.com/x")).alias("source_url"))
    out = verdicts.drop_stale_programs(c)
    return out.groupBy("source_url", "granularity").agg(F.count("*").alias("n"))


@query
def provider_rollup_nations(spark: SparkSession, sf: str) -> DataFrame:
    """Nations, their customers, and these customers' orders, summed before they are joined."""
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("provider_id"), F.col("n_name").alias("name"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("provider_id"), F.col("c_custkey").alias("program_id"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("program_id"), F.when(F.col("o_orderstatus") == "F", "parent_ready").otherwise("x").alias("verdict"))
    return verdicts.provider_rollup(n, c, o).select("name", *_long("programs", "sessions", "ready"))


@query
def hub_stats_lineitems(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as rows of hubs (their return flags): rejected, collapsed and emitted ones."""
    r = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("_hub"), (F.month("l_shipdate").between(6, 8)).alias("season_ok"), (F.col("l_suppkey") % 5 > 0).alias("geo_ok"), (F.col("l_linenumber") == 1).alias("first"))
    out = verdicts.hub_stats(r)
    return out.withColumnRenamed("_hub", "hub")


@query
def town_counts_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers per nation that they serve: their own, and the next one of rich ones; poor ones serve none."""
    n = lambda c: F.concat(F.lit("N"), c)
    serves = F.when(F.col("s_acctbal") < 0, F.array().cast("array<string>")).when(F.col("s_acctbal") > 5000, F.array(n("s_nationkey"), n(F.col("s_nationkey") + 1))).otherwise(F.array(n("s_nationkey")))
    return verdicts.town_counts(table(spark, sf, "supplier").select(serves.alias("serving_towns")))


@query
def catalog_holes_customers(spark: SparkSession, sf: str) -> DataFrame:
    """What a catalog of customers lacks: categories, providers, brochures alone, failed enrolments."""
    c = table(spark, sf, "customer")
    verdict = F.when(F.col("c_acctbal") > 9000, "parent_ready").when(F.col("c_acctbal") < -900, "fetch_failed").when(F.col("c_acctbal") < 3000, "brochure_only").otherwise("unverified")
    s = c.select(F.array(F.concat(F.lit("kind_"), F.col("c_custkey") % 500)).alias("categories"), verdict.alias("parent_verdict"), F.concat(F.lit("https://h"), F.floor(F.col("c_custkey") / 3), F.lit(".example.com/x")).alias("register_url"), F.lit("").alias("source_url"))
    kinds = c.select(F.concat(F.lit("kind_"), F.col("c_custkey") % 500).alias("category"), F.when(F.col("c_custkey") % 500 < 100, "core").otherwise("long_tail").alias("tier")).distinct()
    hosts = table(spark, sf, "supplier").select(F.concat(F.lit("h"), "s_suppkey", F.lit(".example.com")).alias("host"))
    out = coverage.catalog_holes(s, kinds, hosts, F.lit("Anytown"))
    return out.select("hole_id", "kind", F.coalesce("category", F.lit("")).alias("category"), F.coalesce("host", F.lit("")).alias("host"), *_long("priority"), "query")


@query
def provider_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as providers of the nations within reach of theirs, on a grid."""
    n, s = table(spark, sf, "nation"), table(spark, sf, "supplier")
    towns = n.select(F.col("n_name").alias("town"), (42.0 + F.floor(F.col("n_nationkey") / 5) * 0.08).alias("lat"), (-71.0 - (F.col("n_nationkey") % 5) * 0.09).alias("lon"))
    rows = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("ord"), F.col("s_name").alias("name"), F.col("n_name").alias("town"), F.array(F.when(F.col("s_suppkey") % 2 == 0, "swimming").otherwise("chess")).alias("categories"),
        F.when(F.col("s_acctbal") > 5000, "parent_ready").alias("parent_verdict"), F.lit("").alias("verdict"), F.concat(F.lit("https://s"), "s_suppkey", F.lit(".example.com/x")).alias("register_url"), F.lit("").alias("info_url"),
    )
    registry = coverage.registry_fold(rows)
    shared = coverage.shared_coverage(registry.select("host", "town", "categories", "parent_ready"), towns)
    return coverage.manifest(registry, shared).select("url", "provider_name", "host", "towns_served", "categories", "parent_verdict", *_long("priority"))


@query
def baseline_scores_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of even numbers against parts of a third of all numbers, as a baseline and what is published: many names are
    published in the plural or with a letter left out, so that likeness decides."""
    host = F.concat(F.lit("https://"), F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))), F.lit(".example.com/"))
    p = table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("name"), F.concat(host, "p_partkey").alias("register_url"), F.lit("").alias("source_url"), F.when(F.col("p_size") > 45, "wrong_audience").otherwise("parent_ready").alias("parent_verdict"),
    )
    k = F.col("p_partkey")
    other = F.when(k % 5 < 2, F.concat("name", F.lit("s"))).when(k % 5 == 2, F.concat(F.substring("name", 1, 2), F.substring(F.col("name"), F.lit(4), F.length("name")))).otherwise(F.col("name"))
    published = p.where("p_partkey % 3 = 0").withColumns({"name": other, "register_url": F.when(k % 4 == 0, F.col("register_url")).otherwise(F.concat("register_url", F.lit("/x")))})
    hosts = p.where("p_partkey % 2 = 0").select(U.host_of(F.col("register_url")).alias("host")).distinct()
    return score.score_baseline(p.where("p_partkey % 2 = 0"), published, hosts)


@query
def score_run_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as ground truth against those of positive balance, by related hosts and names: of three published names one
    is the same, one lacks its end and still is alike, one shares its first half alone and is not."""
    s, k = table(spark, sf, "supplier"), F.col("s_suppkey")
    host = F.concat(F.lit("s"), k % 40, F.lit(".example.com"))
    name = _word(k)
    published = F.when(k % 3 == 0, name).when(k % 3 == 1, F.substring(name, 1, 28)).otherwise(F.concat(F.substring(name, 1, 16), F.substring(_word(-k - 1), 1, 16)))
    truth = s.select(k.alias("gt"), host.alias("provider_host"), name.alias("program_name"), F.when(k % 2 == 0, F.lit("2026-07-06")).otherwise("").alias("session_dates"))
    pub = s.where("s_acctbal > 0").select(k.alias("pub"), F.concat(F.lit("www2."), host).alias("host"), published.alias("name"), F.when(k % 4 == 0, F.lit("2026-07-06")).otherwise("2026-08-01").alias("dates"))
    out = score.score_run(truth, pub)
    return out.select(*_long("programs", "programs_found", "sessions", "sessions_found", "published", "published_hit"), *[F.round(c, 6).alias(c) for c in ("program_recall", "session_recall", "precision")])


@query
def session_ids_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Identities of customers as sessions: the platform's number where the address has one, else name, ZIP and day."""
    c = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("https://lex.myrec.com/info/program_details.aspx?ProgramID="), F.col("c_custkey") % 100)).otherwise("https://a.org/x").alias("register_url"),
        F.lit("").alias("info_url"), F.concat(F.lit("024"), 20 + F.col("c_nationkey")).alias("geo_zip"), F.lit("2026-07-06").alias("start_date"),
    )
    return linkage.session_uid(c).select("c_custkey", "session_uid")


def _word(c: Column) -> Column:
    """32 letters of a number; those of two numbers are not alike."""
    return F.translate(F.md5(c.cast("string").cast("binary")), "0123456789", "ghijklmnop")


@query
def collapsed_sessions_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Six customers each as sessions of like names in one ZIP on one day: some have a platform's number and join by it, one
    kept row takes one number, and of every third six the first has no ZIP until its last one brings it."""
    k = F.col("c_custkey")
    six, m = F.floor(k / 6), k % 6
    late = six % 3 == 1
    number = F.when(m.isin(2, 5) & ~(late & (m == 5)), six * 3).when(m == 3, six * 3 + 1).when(late & m.isin(0, 5), six * 3 + 2)
    c = table(spark, sf, "customer").select(
        k.alias("ord"), F.when(m % 2 == 1, F.substring(_word(six), 1, 31)).otherwise(_word(six)).alias("name"), F.coalesce(F.concat(F.lit("https://lex.myrec.com/info/program_details.aspx?ProgramID="), number), F.lit("")).alias("register_url"),
        F.lit("").alias("info_url"), F.when(late & (m == 0), "").otherwise(F.concat(F.lit("024"), six % 25 + 20)).alias("geo_zip"), F.lit("2026-07-06").alias("start_date"), F.concat(F.lit("hub"), m).alias("platform"), F.array().cast("array<string>").alias("discovered_via"),
    )
    out = linkage.dedupe_sessions(c)
    return out.select(F.col("ord").alias("c_custkey"), "n_merged", F.array_join("discovered_via", ";").alias("via"), "geo_zip", (F.col("session_uid").startswith("fuzzy|")).alias("by_name"))


@query
def merged_catalog_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as four sources of one catalog: the first pipeline's by number, verified ones that have the same numbers,
    gap-fills without, and a hub's with like names; start dates are read from dates, towns from venues."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    k = F.col("c_custkey")
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).withColumns({"ord": k, "name": _word(k), "url": F.concat(F.lit("https://lex.myrec.com/info/program_details.aspx?ProgramID="), k), "zip": F.concat(F.lit("0"), F.col("c_nationkey") + 1700)})
    engine = rows.where(k % 4 < 2).select("ord", "name", F.col("url").alias("register_url"), F.lit("July 6 - July 10").alias("dates"), F.col("n_name").alias("town"))
    checked = rows.where(k % 8 == 1).select("ord", F.lit("other").alias("name"), F.concat("url", F.lit("&x=1")).alias("register_url"), F.lit("$5").alias("price"), F.lit("shop").alias("platform"))
    gap = rows.where(k % 4 == 2).select("ord", "name", F.concat(F.lit("https://a.org/"), k).alias("register_url"), F.lit("2026-08-03").alias("dates"), F.col("zip").alias("geo_zip"), F.lit("").alias("platform"))
    hub = rows.where((k % 4 == 2) | (k % 4 == 3)).select(
        "ord", F.when(k % 8 == 2, F.substring("name", 1, 30)).when(k % 8 == 6, F.substring("name", 1, 20)).otherwise(F.col("name")).alias("name"), F.concat(F.lit("https://hub.org/"), k).alias("register_url"), F.lit("2026-08-03").alias("start_date"),
        F.when(k % 4 == 2, F.col("zip")).otherwise("").alias("geo_zip"), F.concat(F.lit("Hall "), "zip").alias("venue"), F.lit("hub").alias("platform"), F.array(F.lit("search")).alias("discovered_via"),
    )
    towns = n.select(F.col("n_name").alias("town"), F.concat(F.lit("0"), F.col("n_nationkey") + 1700).alias("zip"))
    out = linkage.merge_catalog({"engine": engine, "pipeline": checked, "gap": gap, "part_d": hub}, 2026, towns)
    return out.groupBy("source", "start_date", "price", F.array_join("discovered_via", ";").alias("via"), "n_merged", "geo_state", (F.col("geo_town") == "").alias("no_town")).agg(F.count("*").alias("n"))


@query
def deduped_published_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as published rows: of those that share a platform's number the one of the highest balance stays."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_name").alias("name"), F.concat(F.lit("https://lex.myrec.com/info/program_details.aspx?ProgramID="), F.col("c_custkey") % 100).alias("register_url"), F.lit("").alias("dates"), "c_acctbal")
    return linkage.dedupe_published(c, F.col("c_acctbal")).select(F.col("ord").alias("c_custkey"), "c_acctbal")


@query
def grouped_programs_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a customer as sessions of a programme: names that differ by their week alone are one."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("provider_id"), F.col("o_orderkey").alias("ord"), F.concat(F.lit("Camp "), "o_orderstatus", F.lit(" Week "), (F.col("o_orderkey") % 9 + 1)).alias("name"))
    return linkage.group_programs(o).select("provider_id", "program_key", "program_name", F.size("sessions").cast("long").alias("sessions"))


@query
def section_pages_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as records of pages: addresses that are parents of others go."""
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("https://a.org/"), F.lower("p_type"), F.when(F.col("p_partkey") % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("/"), "p_partkey"))).alias("info_url"))
    return extract.drop_section_pages(p).select("p_partkey")


@query
def validated_hits_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as search hits of twelve kinds, so that every rule decides some of them; by verdict, reason and source."""
    k = F.col("c_custkey")
    kinds = [
        ("https://www.yelp.com/biz/", "Camp"), ("https://codeninjas.com/locations/burlington/", "Code"), ("https://codeninjas.com/about/", "Code"), ("https://codeninjas.com/x/", "Code in Woburn"), ("https://a.org/camp/", "Camp, Nashua, NH"),
        ("https://macaronikid.com/lists/", "Camps"), ("https://a.org/after-school/", "Summer camp"), ("https://a.org/x/", "Afterschool tutor"), ("https://a.org/x/", "Afterschool and day camp"), ("https://town.myrec.com/info/", "Activities"),
        ("https://a.org/zoo/", "Animals"), ("", "Camp"),
    ]
    pick = lambda n: F.get(F.array(*[F.lit(x[n]) for x in kinds]), (k % 12).cast("int"))
    hits = table(spark, sf, "customer").select(F.when(k % 12 == 11, "").otherwise(F.concat(pick(0), k)).alias("url"), pick(1).alias("title"), F.lit("").alias("snippet"))
    out = links.validate_hits(hits, towns=("Woburn", "Acton"), aggregators=(*H.AGGREGATORS, "codeninjas.com"))
    return out.groupBy("verdict", "reason", "source_type", "preferred").agg(F.count("*").alias("n"), F.sum(F.length("url")).alias("letters"))


@query
def gap_counts_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that are not finished as gaps of customers: counted by reason, and the five customers with most of them."""
    o = table(spark, sf, "orders").where("o_orderstatus <> 'F'").select(F.col("o_custkey").alias("provider_id"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("reason"))
    by_reason, most = reports.gaps(o)
    one = by_reason.select(F.lit("reason").alias("kind"), F.col("reason").alias("key"), "n")
    return one.unionByName(most.select(F.lit("provider").alias("kind"), F.col("provider_id").cast("string").alias("key"), "n"))


@query
def funnel_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as candidates and orders as links of five kinds: what came in, what was crawled, what was slop and why."""
    k = F.col("o_orderkey")
    url = F.when(k % 5 == 0, "https://a.org/camp.pdf").when(k % 5 == 1, "https://a.org/about/us").when(k % 5 == 2, "https://www.facebook.com/camp").when(k % 5 == 3, "https://a.org/find?q=camp").otherwise(F.concat(F.lit("https://a.org/camp/"), k))
    found = table(spark, sf, "orders").select(url.alias("url"), F.lit("Robot Camp").alias("label"))
    c = table(spark, sf, "customer").select(F.when(F.col("c_acctbal") > 0, F.lit(True)).alias("crawled"))
    out = reports.funnel(c, found, links.slop_reason(F.col("url"), F.col("label")))
    slop = F.array_join(F.transform(F.map_entries("slop"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")
    return out.select("candidates", "crawled", "links", "clean", slop.alias("slop"))


@query
def out_of_state_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as search hits of eight kinds: why they are no providers of the home state, counted."""
    k = F.col("c_custkey")
    kinds = [
        ("https://find.acacamps.org/", "Camp"), ("https://ymcacky.org/", "Camp"), ("https://www.townky.gov/", "Camp"), ("https://lexky.myrec.com/", "Camp"), ("https://lex.ky.myrec.com/", "Camp"), ("https://a.org/", "Camp, Nashua, NH"),
        ("https://a.org/", "Camp of Central Kentucky"), ("https://a.org/", "Camp of Central Kentucky in Lexington, MA"),
    ]
    pick = lambda n: F.get(F.array(*[F.lit(x[n]) for x in kinds]), (k % 8).cast("int"))
    c = table(spark, sf, "customer").select(F.concat(pick(0), k).alias("url"), pick(1).alias("title"), F.lit("").alias("snippet"))
    return c.groupBy(F.coalesce(geo.out_of_state(F.col("url"), F.col("title"), F.col("snippet")), F.lit("")).alias("reason")).agg(F.count("*").alias("n"))


@query
def first_names_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The first part of each name and brand."""
    p = table(spark, sf, "part").select(F.col("p_brand").alias("provider_id"), F.col("p_partkey").alias("ord"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" "), F.upper("p_name"))).otherwise(F.col("p_name")).alias("name"))
    return records.first_names(p)


@query
def catalog_segments_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Per host the first parts of paths that most pages have."""
    return extract.catalog_segments(table(spark, sf, "pages").select("url")).select("host", "segment", "n", *_long("rank"))


@query
def nested_payloads_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their orders and line items as one nested payload each, flattened again: items by segment and status."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("lines"))
    orders = table(spark, sf, "orders").join(lines, "o_orderkey").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "lines")).alias("orders"))
    payload = F.to_json(F.struct(F.col("c_mktsegment").alias("segment"), "orders"))
    rows = table(spark, sf, "customer").join(orders, "c_custkey").select("c_custkey", payload.alias("payload"))
    schema = "segment string, orders array<struct<o_orderkey: long, o_orderstatus: string, lines: array<struct<l_linenumber: long, l_quantity: double>>>>"
    flat = extract.flatten_nested(rows, "payload", schema, ["orders", "lines"])
    return flat.groupBy("segment", "o_orderstatus").agg(F.count("*").alias("items"), F.countDistinct("c_custkey").alias("customers"), F.countDistinct("o_orderkey").alias("orders"), F.sum("l_quantity").cast("long").alias("quantity"))


def _state_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' orders as pages with a graph of events, an application state that nests them, and a block that is torn.
    Both are in the order of their own fields, as rows have none: of events of one name and day the cheapest stands first."""
    o = table(spark, sf, "orders")
    name, day = F.concat(F.lit("Camp "), F.col("o_orderkey") % 4), F.date_format("o_orderdate", "yyyy-MM-dd")
    event = F.struct(F.when(F.col("o_orderstatus") == "P", "WebPage").otherwise("Event").alias("@type"), name.alias("name"), F.concat(day, F.lit("T09:00")).alias("startDate"), F.struct((F.col("o_orderkey") % 7).alias("price"), F.lit("USD").alias("priceCurrency")).alias("offers"))
    item = F.struct(F.concat(F.lit("Item "), F.col("o_orderkey") % 3).alias("title"), F.when(F.col("o_orderkey") % 5 > 0, day).alias("startsAt"), F.struct(F.array(F.struct(name.alias("name"), day.alias("start_date"), day.alias("end_date"))).alias("days")).alias("more"))
    both = o.repartition("o_custkey").groupBy(F.col("o_custkey").alias("page_id")).agg(F.sort_array(F.collect_list(event)).alias("graph"), F.sort_array(F.collect_list(item)).alias("items"))
    graph, state = F.to_json(F.struct(F.col("graph").alias("@graph"))), F.to_json(F.struct(F.struct("items").alias("state")))
    html = F.concat(F.lit('<html><script type="application/ld+json">'), graph, F.lit('</script><script type="application/json">'), state, F.lit('</script><script type="application/json">{"name": torn</script></html>'))
    return both.select("page_id", html.alias("html"))


@query
def structured_events_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Events of pages' JSON-LD and of their application state, by kind and price."""
    out = extract.structured_events(_state_pages(spark, sf))
    return out.groupBy("kind", "price").agg(F.count("*").alias("n"), F.countDistinct("page_id").alias("pages"), F.countDistinct("name", "dates").alias("events"))


@query
def embedded_events_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Events of pages' application state alone, walked as variants."""
    out = extract.embedded_state_events(_state_pages(spark, sf))
    return out.groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("page_id").alias("pages"), F.countDistinct("dates").alias("dates"))


@query
def heading_programs_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' orders as marketing pages: a heading for each order, some of them noise, and a link to its activity set for every third."""
    o = table(spark, sf, "orders")
    name = F.when(F.col("o_orderstatus") == "P", "Stay connected").otherwise(F.concat(F.lit("Robots <b>"), F.split("o_orderpriority", "-")[1], F.lit("</b>\n Grades 2-4: "), "o_orderkey"))
    link = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(' <a href="https://www.hisawyer.com/org/schedules/activity-set/'), "o_orderkey", F.lit('">go</a>'))).otherwise("")
    piece = F.struct("o_orderkey", F.concat(F.lit("<h2 class='x'>"), name, F.lit("</h2><p>text</p>"), link).alias("t"))
    pages = o.groupBy(F.col("o_custkey").alias("page_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["t"]), "").alias("html"))
    return extract.heading_programs(pages)


@query
def name_links_pages(spark: SparkSession, sf: str) -> DataFrame:
    """For the title of each page, its three best links by name."""
    p = table(spark, sf, "pages").select("page_id", "url", "html", F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("name"))
    found = links.extract_links(p)
    out = records.links_by_name(p.select("page_id", "name"), found)
    return out.groupBy("rank").agg(F.count("*").alias("n"), F.sum("score").alias("scores")).select(*_long("rank"), "n", *_long("scores"))


# Files


@query
def files_split_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written once each to the folder of their status, with the reason."""
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("n"))
    status = F.when(F.col("n") < 400, "quarantined").when(F.col("n") > 9000, "held").otherwise("kept")
    return files.write_split(d, status, F.when(F.col("n") < 400, "short").when(F.col("n") > 9000, "long"), _place(spark)).select(F.col("status").cast("string").alias("status"), "reason", "n")


@query
def files_towns_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in a folder a nation; one region's nations are written again with rich ones alone, others stay."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_acctbal", "n_regionkey", F.col("n_name").alias("town"))
    at = _place(spark)
    files.write_towns(c, at)
    files.write_towns(c.where("n_regionkey = 1 AND c_acctbal > 0"), at)
    return spark.read.parquet(at).groupBy("town").agg(F.count("*").alias("n"), F.sum("c_custkey").cast("long").alias("ids")).select(F.col("town").cast("string").alias("town"), "n", "ids")


@query
def files_ledger_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of orders a year as runs of a ledger, each added to it."""
    o, at = table(spark, sf, "orders"), _place(spark)
    for year in range(1992, 1999):
        files.append_ledger(o.where(F.year("o_orderdate") == year).groupBy("o_orderstatus").agg(F.count("*").alias("n")), at, F.lit(f"{year}-12-31"))
    return spark.read.parquet(at).select("o_orderstatus", "n", F.col("run_date").cast("string").alias("run_date"))


@query
def files_layout_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The four catalog files written from nations, suppliers, customers and parts, and read back with their types."""
    n, s, c, p = (table(spark, sf, t) for t in ("nation", "supplier", "customer", "part"))
    at = _place(spark)
    tables = {
        "providers": n.select(F.col("n_nationkey").alias("provider_id"), F.col("n_name").alias("name")), "programs": s.select(F.col("s_suppkey").alias("program_id"), F.col("s_nationkey").alias("provider_id"), F.col("s_name").alias("name")),
        "sessions": c.select(F.col("c_custkey").alias("session_id"), F.concat(F.col("c_name"), F.lit(' "x, y"')).alias("name"), F.col("c_nationkey").alias("content_chars")), "gaps": p.select(F.col("p_partkey").alias("provider_id"), F.col("p_type").alias("reason")),
    }
    wrote = files.write_layout(tables, at)
    back = files.read_layout(spark, at)
    sums = {"providers": F.sum(F.length("name")), "programs": F.sum(F.length("name")), "sessions": F.sum(F.length("name") + F.col("content_chars")), "gaps": F.sum(F.length("reason"))}
    out = None
    for name, df in back.items():
        one = df.agg(F.count("*").alias("n"), sums[name].cast("long").alias("total")).select(F.lit(name).alias("file"), F.lit(wrote[name]).cast("long").alias("wrote"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


@query
def files_town_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Files of published rows in folders of towns, scanned by a pattern; towns come from the paths and hosts from the rows."""
    at = _place(spark)
    s = table(spark, sf, "supplier").select(F.concat(F.lit("town_"), "s_nationkey").alias("town"), F.col("s_name").alias("name"), F.concat(F.lit("https://www.s"), "s_suppkey", F.lit(".example.com/x")).alias("source_url"), F.lit("").alias("info_url"), F.lit("").alias("register_url"), F.lit("").alias("dates"))
    s.write.partitionBy("town").options(**files.CSV).csv(at)
    rows = files.scan_towns(spark, f"{at}/town=*", level=1)
    published = files.read_published(spark, f"{at}/town=*")
    hosts = published.agg(F.countDistinct("host")).first()[0]
    return rows.withColumn("town", F.lower(F.regexp_replace("town", "^Town=", ""))).groupBy("town").agg(F.count("*").alias("n")).withColumn("hosts", F.lit(hosts).cast("long"))


@query
def grid_upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The grid of order states by priority, one priority's column replaced by its rich orders."""
    o = table(spark, sf, "orders")
    cells = lambda df: df.groupBy(F.col("o_orderstatus").alias("category"), F.col("o_orderpriority").alias("town")).agg(F.count("*").cast("string").alias("value"))
    grid = files.upsert_town(cells(o), cells(o.where("o_orderpriority = '1-URGENT' AND o_totalprice > 250000")))
    wide = files.wide_grid(grid, ["1-URGENT", "5-LOW"])
    return wide.select("category", F.col("1-URGENT").alias("urgent"), F.col("5-LOW").alias("low"))


# Streams, run to the end of what there is


@query
def stream_yield_stop(spark: SparkSession, sf: str) -> DataFrame:
    """The stream's form of yield_stop, over one batch of events."""
    e = streams.read_stream(spark, f"{sf}/events.parquet").select(F.col("event_type").alias("group"), F.col("event_id").alias("seq"), F.col("user_id").alias("key"))
    at = _place(spark)
    streams.run_until_dry(e, "append", streams.put_saturation(f"{at}/dry", 50, 10), f"{at}/state")
    return streams.stopped(spark, f"{at}/dry")


@query
def stream_latest_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as a stream into a store that keeps the latest of each address; its pages per host."""
    pages = streams.read_stream(spark, f"{sf}/pages.parquet").withColumn("ts", F.timestamp_seconds(F.col("page_id")))
    at = _place(spark)
    q = pages.writeStream.option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(streams.latest_pages(f"{at}/store")).start()
    q.awaitTermination()
    return streams.stored_pages(spark, f"{at}/store").groupBy(U.host_of(F.col("url")).alias("host")).agg(F.count("*").alias("n"), F.sum("page_id").cast("long").alias("ids"))


@query
def stream_new_links(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses of pages that a stream has not met within its horizon."""
    pages = streams.read_stream(spark, f"{sf}/pages.parquet").select("url", F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"))
    return streams.drain(streams.new_links(pages), "append", ["key"]).select("key")


@query
def stream_hole_states(spark: SparkSession, sf: str) -> DataFrame:
    """The stream's form of hole_state_latest, over one batch of events."""
    e = streams.read_stream(spark, f"{sf}/events.parquet").select(F.col("user_id").alias("hole_id"), F.col("ts").cast("timestamp").alias("ts"), F.lit(1).alias("variants"), (F.col("event_type") == "purchase").alias("found"))
    out = streams.drain(streams.hole_states_stream(e), "update", ["hole_id"])
    return out.select("hole_id", F.date_format("searched_at", "yyyy-MM-dd HH:mm:ss").alias("searched_at"), *_long("attempts"), "status")


@query
def stream_running_yields(spark: SparkSession, sf: str) -> DataFrame:
    """Running yields of users as a stream tells them."""
    e = streams.read_stream(spark, f"{sf}/events.parquet").select(F.col("user_id").alias("key"), (F.col("event_type") == "purchase").alias("success"), F.col("event_id").alias("ts"))
    out = streams.drain(streams.running_yields(e), "update", ["key"])
    return out.select(F.col("key").alias("user_id"), "attempts", F.round("mean_yield", 6).alias("mean_yield"), F.col("last_success").alias("last_purchase"))


# Streams over several batches, stopped halfway and gone on from their checkpoints


def _replayed(spark: SparkSession, df: DataFrame, part: Column, parts: int, run: Callable[[DataFrame], None], at: str) -> None:
    """df as `parts` parts that come one after another, each written by all tasks and one batch of the stream; `run` goes on
    from its checkpoint for each of them."""
    bring = streams.in_files(df, part, f"{at}/in")
    for k in range(parts):
        bring(k)
        run(streams.files_of(spark, f"{at}/in", df.schema, None))


def _put_out(spark: SparkSession, at: str) -> DataFrame:
    return spark.read.option("basePath", f"{at}/out").parquet(f"{at}/out/*")


@query
def stream_batches_yield_stop(spark: SparkSession, sf: str) -> DataFrame:
    """yield_stop as a stream of six batches with restarts, its state in stores."""
    at = _place(spark)
    e = table(spark, sf, "events").select(F.col("event_type").alias("group"), F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("key"))
    size = e.agg(F.max("seq")).first()[0] + 1
    _replayed(spark, e, F.floor(F.col("seq") * 6 / size), 6, lambda s: streams.run_until_dry(s, "append", streams.put_saturation(f"{at}/dry", 50, 10), f"{at}/state"), at)
    return streams.stopped(spark, f"{at}/dry")


@query
def stream_batches_hole_states(spark: SparkSession, sf: str) -> DataFrame:
    """Users' events as searches of holes that rest for a day, exhausted ones for two: their states after seven batches with a
    restart, and those that are due again."""
    at = _place(spark)
    e = table(spark, sf, "events").select(F.col("user_id").alias("hole_id"), F.col("ts").cast("timestamp").alias("ts"), F.lit(1).alias("variants"), (F.col("event_type") == "purchase").alias("found"))
    last = e.agg(F.max("ts")).first()[0]
    day = F.dayofmonth("ts")
    # The last event comes by itself, and after it a row of no hole, which counts as none.
    part = F.when(F.col("ts") == F.lit(last), 5).otherwise(F.floor(F.least(day - 1, F.lit(29)) / 6))
    nudge = e.limit(1).select(F.lit(-1).cast("long").alias("hole_id"), F.lit(last).alias("ts"), F.lit(1).alias("variants"), F.lit(False).alias("found"))
    both = e.withColumn("part", part).unionByName(nudge.withColumn("part", F.lit(6))).select("hole_id", "ts", "variants", "found", F.col("part").cast("int").alias("part"))
    put = stores.put_holes(stores.hole_store(f"{at}/holes"), f"{at}/out", days=1, exhausted_days=2)
    _replayed(spark, both, F.col("part"), 7, lambda s: streams.run_until_dry(s, "append", put, f"{at}/state"), at)
    order = F.struct("batch", (F.col("status") == "due").cast("int"))
    out = _put_out(spark, at).where("hole_id >= 0").groupBy("hole_id").agg(F.max_by(F.struct("searched_at", "attempts", "status"), order).alias("s")).select("hole_id", "s.*")
    return out.select("hole_id", F.date_format("searched_at", "yyyy-MM-dd HH:mm:ss").alias("searched_at"), "attempts", "status")


@query
def stream_batches_seen_links(spark: SparkSession, sf: str) -> DataFrame:
    """Pages' addresses as a stream of six batches: those that no batch before had, by the batch."""
    at = _place(spark)
    p = table(spark, sf, "pages").select("page_id", "url")
    store = stores.seen_store(f"{at}/seen", buckets=16, every=2)
    _replayed(spark, p, (F.col("page_id") % 6).cast("int"), 6, lambda s: streams.run_until_dry(s, "append", stores.put_seen(store, U.canonical_url(F.col("url"))), f"{at}/state"), at)
    return store.read(spark)


@query
def stream_batches_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as a stream of six batches into a store of deltas, compacted on the way: the latest of each address, by host."""
    at = _place(spark)
    p = table(spark, sf, "pages").withColumn("ts", F.timestamp_seconds("page_id"))
    store = stores.page_store(f"{at}/pages", buckets=16, every=2)
    _replayed(spark, p, (F.col("page_id") % 6).cast("int"), 6, lambda s: streams.run_until_dry(s, "append", stores.put_pages(store), f"{at}/state"), at)
    return store.read(spark).groupBy(U.host_of(F.col("url")).alias("host")).agg(F.count("*").alias("n"), F.sum("page_id").cast("long").alias("ids"))


@query
def stream_batches_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as sessions of fifty hosts, in six batches: the registry folded from partial rows."""
    at = _place(spark)
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(
        k.alias("ord"), F.concat("c_mktsegment", F.repeat(F.lit("x"), (k % 3).cast("int"))).alias("name"), F.concat(F.lit("t"), k % 4).alias("town"), F.array("c_mktsegment").alias("categories"), F.when(F.col("c_acctbal") > 9500, "parent_ready").otherwise("").alias("parent_verdict"),
        F.lit("").alias("verdict"), F.concat(F.lit("https://h"), k % 50, F.lit(".org/"), F.floor(k / 50) % 14).alias("register_url"), F.lit("").alias("info_url"),
    )
    store = stores.registry_store(f"{at}/registry", buckets=16, every=2)
    _replayed(spark, c, (F.col("ord") % 6).cast("int"), 6, lambda s: streams.run_until_dry(s, "append", stores.put_registry(store), f"{at}/state"), at)
    out = stores.registry(store, spark)
    return out.select("host", "name", "town", F.array_join("categories", ";").alias("categories"), "parent_ready", F.array_join("urls", ";").alias("urls"))


@query
def stream_batches_alarms(spark: SparkSession, sf: str) -> DataFrame:
    """Events of six spans of five days each: types per user whose count moved by more than 30 % from one to the next."""
    at = _place(spark)
    e = table(spark, sf, "events").select("user_id", "event_type", F.least(F.floor((F.dayofmonth("ts") - 1) / 5), F.lit(5)).cast("int").alias("part"))
    store = stores.Store(f"{at}/counts", ("user_id", "event_type"), lambda d: d.groupBy("user_id", "event_type").agg(F.sum("n").alias("n")), buckets=16)
    _replayed(spark, e, F.col("part"), 6, lambda s: streams.run_until_dry(s, "append", stores.put_counts(store, f"{at}/alarms", ["user_id", "event_type"]), f"{at}/state"), at)
    out = spark.read.option("basePath", f"{at}/alarms").parquet(f"{at}/alarms/*")
    return out.groupBy(F.col("batch").cast("long").alias("batch"), "event_type").agg(F.count("*").alias("n"), F.sum("old_n").cast("long").alias("old_n"), F.sum("new_n").cast("long").alias("new_n"))


@query
def stream_batches_finished(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers of line items as providers, in six batches with a restart: each is worked on in the first batch that has it, with that batch's items."""
    at = _place(spark)
    lines = table(spark, sf, "lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("provider_id"), "l_orderkey")
    part = F.when(F.col("l_orderkey") % 100 == 0, 0).when(F.col("l_orderkey") % 100 == 1, 1).otherwise((F.col("l_orderkey") % 4 + 2)).cast("int")
    work = lambda b: b.groupBy("provider_id").agg(F.count("*").alias("items"))
    _replayed(spark, lines, part, 6, lambda s: streams.run_until_dry(s, "append", streams.finished_once(f"{at}/done", work), f"{at}/state"), at)
    return spark.read.option("basePath", f"{at}/done").parquet(f"{at}/done/v=*").select("provider_id", "items", F.col("v").cast("long").alias("batch"))


@query
def ranked_gaps_customers(spark: SparkSession, sf: str) -> DataFrame:
    """All customers ranked by balance, in as many tasks as there are ranges."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return coverage.ranked(c, [F.col("c_acctbal").desc(), F.col("c_custkey")], "place")


@query
def seen_places_events(spark: SparkSession, sf: str) -> DataFrame:
    """Each event's place among those of its type."""
    e = table(spark, sf, "events").select("event_type", "event_id")
    return monitor.placed(e, "event_type", "event_id")
