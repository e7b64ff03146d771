"""Registered queries of the library's own operators, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catamill.functions import dates as D
from catamill.functions import texts as T
from catamill.functions import urls as U
from catamill.functions.common import first_reason
from catamill.operators import coverage, extract, gates, linkage, links, monitor, reports, score
from catamill.session import table
from catamill.streaming import jobs as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


# Pages and links


@query
def host_rollup_page_status(spark: SparkSession, sf: str) -> DataFrame:
    """One page per canonical address, then pages and characters of text by host and status."""
    pages = links.normalize_pages(table(spark, sf, "pages"))
    return pages.groupBy("host", "status").agg(F.count("*").alias("n_pages"), F.sum("n_text").cast("long").alias("n_text"))


@query
def canonical_url_pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", U.canonical_url(F.col("url")).alias("canonical_url"), U.host_of(F.col("url")).alias("host"), U.registered_domain(U.host_of(F.col("url"))).alias("domain"))


@query
def duplicate_pages_by_url(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "pages").groupBy(U.canonical_url(F.col("url")).alias("canonical_url")).agg(F.count("*").alias("n"), F.min("page_id").alias("first_page"))
    return g.where(F.col("n") > 1)


@query
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    out = links.extract_links(table(spark, sf, "pages"))
    return out.select("page_id", *_long("pos"), "url", "label", *_long("score"))


@query
def frontier_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Per host the three links most worth a visit, over all its pages."""
    pages = table(spark, sf, "pages").withColumn("host", U.host_of(F.col("url")))
    found = links.extract_links(pages, ("host",))
    return links.frontier(found, "host", 3).select("host", "url", *_long("score", "rank"))


@query
def one_seed_per_host(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("url", F.col("page_id").alias("ord"), F.lit(False).alias("preferred"))
    return links.one_seed_per_host(pages).select("host", "url", F.col("ord").alias("page_id"))


@query
def breadth_first_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The first page of every host before any second one; the 100 best are the report."""
    pages = table(spark, sf, "pages").select("page_id", U.host_of(F.col("url")).alias("host"), F.col("page_id").alias("ord"))
    return links.breadth_first(pages, "host", 100).select("page_id", "host")


@query
def ingest_new_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of the second half whose canonical address the first half has not."""
    pages = table(spark, sf, "pages")
    old = pages.where(F.col("page_id") % 2 == 0).select(U.canonical_url(F.col("url")).alias("key"))
    new = pages.where(F.col("page_id") % 2 == 1).select("url", F.col("page_id").alias("ord"))
    return links.only_new(new, old).select("url", F.col("ord").alias("page_id"))


@query
def link_slop(spark: SparkSession, sf: str) -> DataFrame:
    out = links.extract_links(table(spark, sf, "pages"))
    return out.groupBy(F.coalesce(links.slop_reason(F.col("url"), F.col("label")), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query
def page_host_link_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts by links a page and whether a page has as many as a catalog grid (five or more)."""
    pages = table(spark, sf, "pages")
    n = links.extract_links(pages).groupBy("page_id").agg(F.count("*").alias("n_links"))
    j = pages.select("page_id", U.host_of(F.col("url")).alias("host")).join(n, "page_id", "left").fillna(0, ["n_links"])
    return j.groupBy("host").agg(F.count("*").alias("pages"), F.sum("n_links").alias("links"), F.count_if(F.col("n_links") >= 5).alias("grids"))


# Rules and gates


@query
def season_filter_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates written out, parsed back and filtered to June to August."""
    orders = table(spark, sf, "orders").select("o_orderstatus", F.date_format("o_orderdate", "MMMM d, yyyy").alias("dates"))
    kept = gates.season_filter(orders, year=2026)
    return kept.groupBy("o_orderstatus", F.year("start_day").cast("long").alias("year"), "in_season").agg(F.count("*").alias("n"))


@query
def date_readings_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The four readings of one range of dates: first month, first date, span and window."""
    day = F.to_date("o_orderdate")
    orders = table(spark, sf, "orders").select("o_orderkey", F.concat(F.date_format(day, "MMM d, yyyy"), F.lit(" - "), F.date_format(F.date_add(day, 9), "M/d/yyyy")).alias("dates"))
    read = orders.select("o_orderkey", D.starts_in_summer(F.col("dates")).alias("summer"), D.first_date(F.col("dates"), 2026).alias("first"), D.date_span(F.col("dates"), 2026).alias("span"), D.day_window(F.col("dates")).alias("w"))
    return read.select("o_orderkey", "summer", F.col("first").cast("string").alias("first_date"), F.col("span.first").cast("string").alias("span_first"), F.col("span.last").cast("string").alias("span_last"), F.col("w.lo").cast("long").alias("lo"), F.col("w.hi").cast("long").alias("hi"))


@query
def rule_chain_documents(spark: SparkSession, sf: str) -> DataFrame:
    """First reason of each document against its labels."""
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    t = F.coalesce("text", F.lit(""))
    reason = first_reason([
        ("empty", F.trim(t) == ""), ("short", F.length(t) < 300), ("symbols", F.length(F.regexp_replace(t, r"[^#*$%&|<>]", "")) * 20 > F.length(t)),
        ("capitals", F.length(F.regexp_replace(t, r"[^A-Z]", "")) * 4 > F.length(t)), ("adult", t.rlike(r"(?i)\badults?\b")),
    ])
    j = d.select("doc_id", F.coalesce(reason, F.lit("kept")).alias("reason")).join(lab, "doc_id", "left")
    return j.groupBy("reason", "quality", "toxic").agg(F.count("*").alias("n"))


@query
def gate_with_label_join(spark: SparkSession, sf: str) -> DataFrame:
    """Documents against their labels, as records against their pages: published, or a gap with the first reason."""
    d, lab = table(spark, sf, "documents").select("doc_id", "source", "n_chars"), table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    reason = first_reason([("not labelled", F.col("quality").isNull()), ("low quality", F.col("quality") == 0), ("toxic", F.col("toxic") == 1), ("too short", F.col("n_chars") < 400)])
    return j.select("source", reason.alias("r")).groupBy("source", F.when(F.col("r").isNull(), "published").otherwise("gap").alias("status"), F.coalesce("r", F.lit("")).alias("reason")).agg(F.count("*").alias("n"))


@query
def dimension_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of `part` that break a rule, and names that stand more than once."""
    rules = {"size at most 45": F.col("p_size") <= 45, "price over 905": F.col("p_retailprice") > 905, "brand": F.col("p_brand").rlike(r"^Brand#\d+$")}
    return gates.violations(table(spark, sf, "part"), "p_partkey", rules, "p_name")


@query
def enrollability_customers(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    verdict = F.when(F.col("c_acctbal") > 7000, "parent_ready").when(F.col("c_acctbal") < 0, "brochure_only").when(F.col("c_mktsegment") == "BUILDING", "fetch_failed")
    return coverage.enrollability(c.select(verdict.alias("parent_verdict")))


@query
def page_text_status(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages")
    t = T.html_to_text(F.col("html"), unescape=False)
    return p.select("page_id", F.length(t).cast("long").alias("n_text"), T.page_status(t).alias("status"), T.has_affordance(F.col("html")).alias("affordance"))


# Windows, monitoring and state


@query
def host_cap_rows(spark: SparkSession, sf: str) -> DataFrame:
    """At most 60 line items a supplier, in order; how many went."""
    _, cut = monitor.cap_per_key(table(spark, sf, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber"], 60)
    return cut


@query
def host_cap_kept(spark: SparkSession, sf: str) -> DataFrame:
    kept, _ = monitor.cap_per_key(table(spark, sf, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"], 60)
    return kept.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.max("l_orderkey").alias("last_order"))


@query
def nearest_n_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """Per brand and size class, the three parts nearest a price of 950."""
    p = table(spark, sf, "part").select("p_brand", "p_partkey", F.round(F.abs(F.col("p_retailprice") - 950), 2).alias("gap"))
    return monitor.nearest(p, ["p_brand"], "gap", "p_partkey", 3).select("p_brand", "p_partkey", "gap", *_long("rank"))


@query
def nearest_once_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """Brands served one after another by the three kinds of part (type and size) nearest a price of 950 that no brand before took."""
    p = table(spark, sf, "part").select("p_brand", F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("turn"), F.concat_ws("|", "p_type", "p_size").alias("kind"), F.round(F.abs(F.col("p_retailprice") - 950), 2).alias("gap"))
    return monitor.nearest_once(p, "p_brand", "turn", "gap", "kind", 3).select("p_brand", "kind", "gap", *_long("rank"))


@query
def snapshot_diff_alarms(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    half = lambda test: e.where(test).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    out = monitor.snapshot_alarms(half(F.col("ts").cast("timestamp_ntz") < cut), half(F.col("ts").cast("timestamp_ntz") >= cut), ["user_id", "event_type"])
    return out.select("user_id", "event_type", "old_n", "new_n", F.round("delta", 4).alias("delta"))


@query
def zero_floor(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), "n_name")
    return monitor.zero_floor(nation, table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "nation"), "nation", least=4)


@query
def yield_stop(spark: SparkSession, sf: str) -> DataFrame:
    """Per event type, the event at which the last ten events of 50 or more brought no new user."""
    e = table(spark, sf, "events")
    return monitor.saturation(e, "event_type", "event_id", "user_id", floor=50, window=10).select("event_type", "stop_at", *_long("searches"))


@query
def hole_state_latest(spark: SparkSession, sf: str) -> DataFrame:
    s = monitor.hole_states(_attempts(spark, sf))
    return s.select("hole_id", F.date_format("searched_at", "yyyy-MM-dd HH:mm:ss").alias("searched_at"), *_long("attempts"), "status")


def _attempts(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(F.col("user_id").alias("hole_id"), F.col("ts").cast("timestamp_ntz").alias("ts"), F.lit(1).alias("variants"), (F.col("event_type") == "purchase").alias("found"))


@query
def ttl_searchable(spark: SparkSession, sf: str) -> DataFrame:
    """Users whose last event is a day old at the end of January (60 days for exhausted ones)."""
    states = monitor.hole_states(_attempts(spark, sf), exhausted_at=80)
    holes = table(spark, sf, "events").select(F.col("user_id").alias("hole_id")).distinct()
    return monitor.searchable(holes, states, F.lit("2024-01-31").cast("timestamp_ntz"), days=1)


@query
def latest_event_per_user(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return monitor.latest(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).select("user_id", "event_id", "event_type", "value")


@query
def first_event_wins(spark: SparkSession, sf: str) -> DataFrame:
    """The first event of each user and type (first wins, as in a funnel)."""
    e = table(spark, sf, "events")
    return links.first_per(e, F.concat_ws("|", "user_id", "event_type"), [F.col("event_id")]).select("user_id", "event_type", "event_id")


@query
def running_yield(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    out = monitor.running_yield(e, "user_id", F.col("event_type") == "purchase", "event_id")
    return out.select("user_id", "attempts", F.round("mean_yield", 6).alias("mean_yield"), F.col("last_success").alias("last_purchase"))


@query
def brochure_only_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with two or more orders, all of them open or in progress."""
    return coverage.unconvincing_hosts(table(spark, sf, "orders"), "o_custkey", "o_orderstatus", ("O", "P"))


@query
def top_customers(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))
    return g.orderBy(F.col("total").desc(), "o_custkey").limit(12)


@query
def user_set_operations(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    of = lambda t: e.where((F.col("event_type") == t) & (F.col("value") > 12)).select("user_id").distinct()
    out = reports.set_operations(of("view"), of("click")).items()
    both = [df.agg(F.count("*").alias("n"), F.coalesce(F.sum("user_id"), F.lit(0)).cast("long").alias("ids")).select(F.lit(name).alias("op"), "n", "ids") for name, df in out]
    return both[0].union(both[1]).union(both[2])


# Linkage


@query
def union_dedupe_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers as two sources of one catalog, collapsed by the number in their names; the first source wins, blanks are filled."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_name").alias("name"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"), F.lit(None).cast("double").alias("balance"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ord"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    both = linkage.union_sources({"customer": c, "supplier": s}).withColumn("via", F.array("source"))
    out = linkage.collapse_by_id(both, F.regexp_extract("name", r"#0*(\d+)$", 1), lists=["via"])
    return out.select("name", "segment", "balance", F.array_join("via", ";").alias("via"), "n_merged")


@query
def reconcile_sources(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_nationkey").alias("k"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ord"), F.col("s_nationkey").alias("k"))
    both = linkage.union_sources({"customer": c, "supplier": s})
    return linkage.reconcile(both, links.first_per(both, F.concat_ws("|", "k", (F.col("ord") % 97).cast("string")), [F.col("ord")]))


@query
def short_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", linkage.short_id("prog", "p_brand", "p_name").alias("program_id"))


@query
def name_forms(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    name = F.concat("p_name", F.lit(" Summer Camp, Week 3 (2026)"))
    return p.select("p_partkey", T.identity_name(name).alias("identity"), T.sorted_name(name).alias("sorted"), T.undated_name(name).alias("undated"), T.slug(name).alias("slug"))


@query
def registry_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Brands as hosts: longest part name, kinds, whether any part is large, first ten parts."""
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("ord"), F.col("p_name").alias("name"), F.col("p_type").alias("town"), F.array("p_type").alias("categories"), F.when(F.col("p_size") > 49, "parent_ready").alias("parent_verdict"),
        F.lit("").alias("verdict"), F.concat(F.lit("https://"), F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))), F.lit(".example.com/"), "p_partkey").alias("register_url"), F.lit("").alias("info_url"),
    )
    out = coverage.registry_fold(p)
    return out.select("host", "name", "town", F.array_join("categories", ";").alias("categories"), "parent_ready", F.array_join("urls", ";").alias("urls"))


@query
def interval_overlap_match(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of a customer's orders whose windows of nine days meet, per customer."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", D.day_window(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("w"))
    o = o.select("o_custkey", "o_orderkey", F.struct(F.col("w.lo").alias("lo"), (F.col("w.hi") + 8).alias("hi")).alias("w"))
    a, b = o.alias("a"), o.alias("b")
    met = a.join(b, (F.col("a.o_custkey") == F.col("b.o_custkey")) & (F.col("a.o_orderkey") < F.col("b.o_orderkey")) & D.overlap(F.col("a.w"), F.col("b.w")))
    return met.groupBy(F.col("a.o_custkey").alias("o_custkey")).agg(F.count("*").alias("pairs"))


@query
def fuzzy_pairs_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of suppliers of one nation whose whole names, in sorted words, are alike (tested against all pairs)."""
    s = table(spark, sf, "supplier").select("s_nationkey", "s_suppkey", T.sorted_name(F.col("s_name")).alias("n"))
    return linkage.fuzzy_pairs(s, ["s_nationkey"], "n", "s_suppkey", 0.94)


# Coverage


def _sessions(spark: SparkSession, sf: str) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    verdict = F.when(F.col("c_acctbal") > 9500, "parent_ready").when(F.col("c_acctbal") < 0, "brochure_only").otherwise("unverified")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("ord"), F.array("n_name", "c_mktsegment").alias("categories"), verdict.alias("parent_verdict"), F.lit("").alias("verdict"),
        F.concat(F.lit("https://"), F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))), F.lit(".example.com/")).alias("register_url"), F.lit("").alias("info_url"),
    )


def _categories(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    return n.select(F.col("n_name").alias("category"), F.when(F.col("n_regionkey") < 3, "core").otherwise("long_tail").alias("tier"), (F.col("n_nationkey") % 8).cast("long").alias("demand"))


@query
def coverage_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.coverage_matrix(_sessions(spark, sf), _categories(spark, sf))


@query
def coverage_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = coverage.coverage_summary(coverage_matrix(spark, sf))
    return out.withColumn("holes", F.array_join("holes", ";"))


@query
def gap_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Holes of the matrix and suppliers' nations without convincing orders, ranked."""
    o = table(spark, sf, "orders")
    weak = coverage.unconvincing_hosts(o, "o_custkey", "o_orderstatus", ("O",), 3).select(F.concat(F.lit("customer-"), F.col("o_custkey")).alias("host"))
    out = coverage.audit(coverage_matrix(spark, sf), weak, F.lit("Anytown"))
    return out.select("hole_id", "kind", F.coalesce("category", F.lit("")).alias("category"), *_long("demand"), "core", "query", *_long("priority"))


@query
def county_pivot(spark: SparkSession, sf: str) -> DataFrame:
    j = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return reports.pivot_counts(j, "n_name", "o_orderstatus", ["F", "O", "P"]).select("n_name", F.col("F").alias("n_f"), F.col("O").alias("n_o"), F.col("P").alias("n_p"))


@query
def regional_sharing(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as towns on a grid, suppliers as providers: the first provider within reach of each town and kind."""
    n, s = table(spark, sf, "nation"), table(spark, sf, "supplier")
    towns = n.select(F.col("n_name").alias("town"), (42.0 + F.floor(F.col("n_nationkey") / 5) * 0.08).alias("lat"), (-71.0 - (F.col("n_nationkey") % 5) * 0.09).alias("lon"))
    kinds = F.array(F.when(F.col("s_suppkey") % 2 == 0, "swimming").otherwise("chess"), F.when(F.col("s_suppkey") % 7 == 0, "sailing").otherwise("arts"))
    providers = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("host"), F.col("n_name").alias("town"), kinds.alias("categories"), (F.col("s_acctbal") > 5000).alias("parent_ready"))
    return coverage.shared_coverage(providers, towns, rare=("sailing",))


#: Terms of part names and kinds, as a taxonomy: slug, term, whether it is specific.
PART_TAXONOMY = [("small_goods", "small", True), ("red_goods", "red", True), ("rings", "ring", True), ("widgets", "widget", True), ("economy", "economy", False), ("standard", "standard", False), ("promo", "promo", False)]


@query
def category_tags(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(F.col("p_name").alias("name"), F.col("p_type").alias("platform"))
    t = coverage.categorize(p, PART_TAXONOMY)
    return t.select(F.explode("categories").alias("category")).groupBy("category").agg(F.count("*").alias("n"))


@query
def summary_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by status and priority with subtotals."""
    return reports.subtotals(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query
def completeness_report(spark: SparkSession, sf: str) -> DataFrame:
    """Per source: documents, labelled ones, short ones, and a letter grade by the share that is labelled good."""
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = reports.completeness(d.join(lab, "doc_id", "left"), "source", {"short": F.col("n_chars") < 400}, F.col("quality") == 1, F.col("quality").isNotNull())
    return out.withColumnRenamed("base", "labelled")


# Evaluation


@query
def score_recall_precision(spark: SparkSession, sf: str) -> DataFrame:
    """Recall and precision of a simple rule against the labels."""
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    t = F.coalesce("text", F.lit(""))
    rule = (F.length(F.regexp_replace(t, r"[^#*$%&|<>]", "")) * 20 <= F.length(t)) & (F.length(F.regexp_replace(t, r"[^A-Z]", "")) * 4 <= F.length(t))
    j = lab.join(d.select("doc_id", rule.alias("said")), "doc_id")
    good = F.col("quality") == 1
    g = j.agg(F.count("*").alias("n"), F.count_if(good).alias("good"), F.count_if("said").alias("said"), F.count_if(good & F.col("said")).alias("hit"))
    return g.select("*", F.round(F.try_divide(F.col("hit"), F.col("good")), 6).alias("recall"), F.round(F.try_divide(F.col("hit"), F.col("said")), 6).alias("precision"))


@query
def provider_regressions(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    return score.regressions(o.where("y = 1996"), o.where("y = 1997"), "o_custkey")


@query
def provider_floors(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers below a floor of line items, each order counted once; some are and some aren't."""
    one = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("s_suppkey")).distinct()
    return monitor.zero_floor(table(spark, sf, "supplier").select("s_suppkey", "s_name"), one, "s_suppkey", least=600)


# Extraction


@query
def event_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """JSON payloads flattened with a fixed schema."""
    flat = extract.flatten_payload(table(spark, sf, "events"), "props", "k long")
    return flat.groupBy("event_type", (F.col("k") % 10).alias("bucket")).agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query
def item_link_collapse(spark: SparkSession, sf: str) -> DataFrame:
    """Anchors of one item on a page become one row: the longest name and the first place."""
    found = links.extract_links(table(spark, sf, "pages")).withColumn("item", F.lower(F.regexp_extract("url", r"/([^/]*)$", 1)))
    return extract.collapse_item_links(found, ["page_id", "item"]).select("page_id", "item", "name", *_long("pos", "n"))


# Streams, run to the end of what there is


@query
def stream_event_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tumbling hours of events by type, counted by a stream with a watermark."""
    return streams.run_event_counts(spark, f"{sf}/events.parquet")


@query
def stream_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Users as a stream meets them, each once."""
    return streams.run_first_seen(spark, f"{sf}/events.parquet")
