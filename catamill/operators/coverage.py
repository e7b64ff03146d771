"""Coverage analytics: category tags, coverage matrix and its summary, regional sharing, registry, audits."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catamill.functions import urls as U
from catamill.functions.common import text
from catamill.session import cut

EARTH_MILES = 3958.8


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_MILES * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def categorize(rows: DataFrame, taxonomy: list[tuple[str, str, bool]], most: int = 4) -> DataFrame:
    """rows (name, platform, register_url, info_url) with `categories` (at most four) and `category`. taxonomy: (slug,
    term, specific): a term that stands anywhere in the row's text tags it; specific categories come first."""
    blob = F.lower(F.concat_ws(" ", *[text(c) for c in ("name", "platform", "register_url", "info_url") if c in rows.columns]))
    terms = F.array(*[F.struct(F.lit(0 if special else 1).alias("g"), F.lit(k).alias("k"), F.lit(slug).alias("slug"), F.lit(term).alias("term")) for k, (slug, term, special) in enumerate(taxonomy)])
    hits = F.array_sort(F.filter(terms, lambda t: F.contains(blob, t["term"])))
    tagged = rows.withColumn("categories", F.slice(F.array_distinct(F.transform(hits, lambda t: t["slug"])), 1, most))
    return tagged.withColumn("category", F.get("categories", 0))


def coverage_matrix(sessions: DataFrame, categories: DataFrame, shared: DataFrame | None = None, exhausted: DataFrame | None = None) -> DataFrame:
    """Per category (category, tier, demand): ready and brochure counts of distinct rows, an example provider, and status:
    covered, covered_via:town, exhausted or hole. sessions: categories, parent_verdict, verdict, register_url, info_url, ord."""
    host = U.host_of(F.coalesce(F.nullif(text("register_url"), F.lit("")), text("info_url")))
    each = sessions.select("ord", F.explode("categories").alias("category"), host.alias("host"), (text("parent_verdict").isin("parent_ready", "info_confirmed") | (text("verdict") == "info_confirmed")).alias("ready"), (text("parent_verdict") == "brochure_only").alias("brochure"))
    counts = each.groupBy("category").agg(
        F.count_if("ready").alias("ready_count"), F.count_if("brochure").alias("brochure_count"),
        F.min_by("host", F.when(F.col("ready"), F.col("ord"))).alias("ready_host"), F.min_by("host", F.when(F.col("brochure"), F.col("ord"))).alias("brochure_host"),
    )
    m = categories.join(counts, "category", "left").fillna(0, ["ready_count", "brochure_count"])
    m = m.join(shared.select("category", F.col("town").alias("via")), "category", "left") if shared is not None else m.withColumn("via", F.lit(None).cast("string"))
    m = m.join(exhausted.select("category", F.lit(True).alias("spent")).distinct(), "category", "left") if exhausted is not None else m.withColumn("spent", F.lit(None).cast("boolean"))
    ready = F.col("ready_count") > 0
    status = F.when(ready, "covered").when(F.col("via").isNotNull(), F.concat(F.lit("covered_via:"), "via")).when(F.coalesce("spent", F.lit(False)), "exhausted").otherwise("hole")
    example = F.when(ready, F.col("ready_host")).when(F.col("via").isNull(), F.col("brochure_host"))
    return m.select("category", "tier", "demand", "ready_count", "brochure_count", status.alias("status"), F.coalesce(example, F.lit("")).alias("example_provider"))


def coverage_summary(matrix: DataFrame) -> DataFrame:
    covered, core = F.col("status").startswith("covered"), F.col("tier") == "core"
    return matrix.agg(
        F.count("*").alias("categories"), F.count_if(covered).alias("covered"), F.count_if(core).alias("core_total"), F.count_if(core & covered).alias("core_covered"),
        F.bround(100.0 * F.count_if(core & covered) / F.greatest(F.lit(1), F.count_if(core)), 0).cast("long").alias("core_pct"), F.array_sort(F.collect_list(F.when(F.col("status") == "hole", F.col("category")))).alias("holes"),
    )


def shared_coverage(providers: DataFrame, towns: DataFrame, *, radius: float = 10.0, rare_radius: float = 15.0, rare: tuple[str, ...] = ()) -> DataFrame:
    """town, category, via_town, host: the first provider (by host) that covers a category within reach of each town.
    providers: host, town, categories, parent_ready. towns: town, lat, lon (a dimension: its pairs within reach are few)."""
    a, b = towns.toDF("town", "lat", "lon"), towns.toDF("via_town", "lat2", "lon2")
    # Towns meet only in their own and neighbouring bands of latitude, and there in cells of longitude as wide as the
    # reach where the band's circles are shortest; cells wrap at the date line. Towns near a pole meet in one cell a band.
    reach = max(radius, rare_radius)
    band = reach / 69.0

    def cells(lat: Column) -> Column:
        """Cells around the globe in a band and its neighbours."""
        far = F.least(F.lit(90.0), F.abs((F.floor(lat / band) + 0.5) * band) + 1.5 * band)
        return F.greatest(F.lit(1), F.floor(360.0 / (band / F.greatest(F.cos(F.radians(far)), F.lit(1e-9)))).cast("int"))

    own = lambda lat, lon, n: F.pmod(F.floor((lon + 180.0) / 360.0 * n), n).cast("int")
    # Each band has its own number of cells: a town asks in its own band and the two beside it, by their numbers.
    a = a.withColumn("cy", F.explode(F.array(*[F.floor(F.col("lat") / band) + i for i in (-1, 0, 1)]))).withColumn("n", cells((F.col("cy") + 0.5) * band))
    here = own(F.col("lat"), F.col("lon"), F.col("n"))
    a = a.withColumn("cx", F.explode(F.array_distinct(F.array(*[F.pmod(here + j, F.col("n")) for j in (-1, 0, 1)])))).select("town", "lat", "lon", "cy", "cx")
    b = b.withColumn("cy", F.floor(F.col("lat2") / band)).withColumn("n", cells((F.col("cy") + 0.5) * band))
    b = b.select("via_town", "lat2", "lon2", "cy", own(F.col("lat2"), F.col("lon2"), F.col("n")).alias("cx"))
    close = a.join(b, ["cy", "cx"]).withColumn("miles", haversine_miles(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))).where(F.col("miles") <= reach).select("town", "via_town", "miles")
    offers = providers.where("parent_ready").select("host", F.col("town").alias("via_town"), F.explode("categories").alias("category"))
    hit = close.join(offers, "via_town").where(F.col("miles") <= F.when(F.col("category").isin(*rare) if rare else F.lit(False), rare_radius).otherwise(radius))
    return hit.groupBy("town", "category").agg(F.min_by(F.struct("via_town", "host"), "host").alias("f")).select("town", "category", "f.via_town", "f.host")


def registry_fold(rows: DataFrame, most_urls: int = 10) -> DataFrame:
    """Per host: longest name (the first among equals), first town, sorted categories, whether any row is ready, first addresses."""
    url = F.coalesce(F.nullif(text("register_url"), F.lit("")), text("info_url"))
    ready = text("parent_verdict").isin("parent_ready") | text("verdict").isin("parent_ready", "info_confirmed")
    r = rows.withColumns({"u": url, "host": U.host_of(url)}).where(F.col("host") != "")
    out = r.groupBy("host").agg(
        F.max_by("name", F.struct(F.length(text("name")), -F.col("ord"))).alias("name"), F.min_by("town", "ord").alias("town"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("categories")))).alias("categories"),
        F.bool_or(ready).alias("parent_ready"),
    )
    first = r.groupBy("host", "u").agg(F.min("ord").alias("o")).withColumn("k", F.row_number().over(Window.partitionBy("host").orderBy("o"))).where(F.col("k") <= most_urls)
    urls = first.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "u"))), lambda x: x["u"]).alias("urls"))
    return out.join(urls, "host")


def unconvincing_hosts(rows: DataFrame, host: str, verdict: str, only: tuple[str, ...], least: int = 2) -> DataFrame:
    """Hosts with some rows all of whose verdicts are among `only`."""
    g = rows.groupBy(host).agg(F.count("*").alias("n"), F.collect_set(verdict).alias("seen"))
    return g.where((F.col("n") >= least) & (F.size(F.array_except("seen", F.array(*[F.lit(v) for v in only]))) == 0)).select(host, "n")


def audit(matrix: DataFrame, unready: DataFrame, town: Column) -> DataFrame:
    """Holes with priority and a search: missing categories, then hosts that offer brochures alone. Ranked: core first, then demand."""
    missing = matrix.where(F.col("status") == "hole").select(F.concat(F.lit("missing_category_"), "category").alias("hole_id"), F.lit("missing_category").alias("kind"), "category", "demand", (F.col("tier") == "core").alias("core"), F.concat_ws(" ", F.replace("category", F.lit("_"), F.lit(" ")), F.lit("summer camp"), town).alias("query"))
    gaps = unready.select(F.concat(F.lit("brochure_gap_"), "host").alias("hole_id"), F.lit("brochure_gap").alias("kind"), F.lit(None).cast("string").alias("category"), F.lit(0).alias("demand"), F.lit(False).alias("core"), F.concat_ws(" ", F.lit("register"), "host").alias("query"))
    both = missing.unionByName(gaps)
    return ranked(both, [F.col("core").desc(), F.col("demand").desc(), F.col("hole_id")], "priority")


def ranked(rows: DataFrame, order: list[Column], into: str) -> DataFrame:
    """rows with their place in the order, 1 and up: sorted by ranges in as many tasks as there are, each counting on from those before."""
    # Cut, so that the ranges, which are drawn from a sample, are the same for both reads.
    at = cut(rows.orderBy(*order).withColumn("__part", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id()))
    before = at.groupBy("__part").agg(F.count("*").alias("n"), F.min("__id").alias("first"))  # one row a task
    before = before.withColumn("skip", F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
    return at.join(F.broadcast(before), "__part").withColumn(into, (F.col("__id") - F.col("first") + F.coalesce("skip", F.lit(0)) + 1).cast("long")).drop("__part", "__id", "n", "first", "skip")


def enrollability(rows: DataFrame) -> DataFrame:
    """Counts of verdicts and the score 100 * (ready + unverified / 2) / all, rounded half to even."""
    v = F.when(text("parent_verdict").isin("parent_ready", "brochure_only", "wrong_audience", "fetch_failed"), text("parent_verdict")).otherwise("unverified")
    n = lambda x: F.count_if(v == x)
    return rows.agg(F.count("*").alias("total"), n("parent_ready").alias("ready"), n("brochure_only").alias("brochure"), n("unverified").alias("unverified"), F.bround(100.0 * (n("parent_ready") + 0.5 * n("unverified")) / F.greatest(F.count("*"), F.lit(1)), 0).cast("long").alias("score"))


def demand_prior(tier: Column) -> Column:
    """Demand of a category without figures, by its tier."""
    return F.when(tier == "core", 8).when(tier == "long_tail", 3).otherwise(6)


# Words of the three broad categories.
BROAD = (("sports", ("sport", "soccer", "basketball", "tennis")), ("arts", ("art", "craft", "paint")), ("stem", ("robot", "code", "stem", "lego")))


def one_category(rows: DataFrame, categories: tuple[str, ...]) -> Column:
    """The first category whose name stands in name, platform or address; else a broad one by its words; else null."""
    blob = F.lower(F.concat_ws(" ", *[text(c) for c in ("name", "platform", "register_url") if c in rows.columns]))
    has = lambda w: F.contains(blob, F.lit(w))
    own = [F.when(has(c.replace("_", " ")) | has(c), F.lit(c)) for c in categories]
    broad = [F.when(functools.reduce(lambda x, y: x | y, [has(w) for w in words]), F.lit(c)) for c, words in BROAD]
    return F.coalesce(*own, *broad)


def catalog_holes(sessions: DataFrame, categories: DataFrame, known_hosts: DataFrame, town: Column) -> DataFrame:
    """hole_id, kind, category, host, priority, query: categories without a ready session, known hosts without one, hosts
    with brochures alone, and hosts whose enrolment could not be read.

    sessions: categories, parent_verdict, register_url, source_url. categories: category, tier. known_hosts: host."""
    verdict = text("parent_verdict")
    s = sessions.select(F.coalesce("categories", F.array().cast("array<string>")).alias("categories"), verdict.alias("v"), U.host_of(F.coalesce(F.nullif(text("register_url"), F.lit("")), text("source_url"))).alias("host"))
    ready = s.where(F.col("v").isin("parent_ready", "info_confirmed"))
    short = lambda kind: F.concat(F.lit(f"{kind}_"), F.substring(F.replace("host", F.lit("."), F.lit("_")), 1, 40))
    none = F.lit(None).cast("string")
    missing = categories.join(ready.select(F.explode("categories").alias("category")).distinct(), "category", "left_anti").select(
        F.concat(F.lit("missing_category_"), "category").alias("hole_id"), F.lit("missing_category").alias("kind"), "category", none.alias("host"), F.when(F.col("tier") == "core", 1).otherwise(3).alias("priority"),
        F.concat_ws(" ", F.replace("category", F.lit("_"), F.lit(" ")), F.lit("summer camp"), town).alias("query"),
    )
    by_host = s.where(F.col("host") != "").groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("v") == "parent_ready").alias("ready"), F.bool_and(F.col("v").isin("brochure_only", "unverified")).alias("weak"), F.bool_or(F.col("v") == "fetch_failed").alias("failed"))

    def gap(df: DataFrame, kind: str, priority: int, words: str) -> DataFrame:
        return df.select(short(kind).alias("hole_id"), F.lit(kind).alias("kind"), none.alias("category"), "host", F.lit(priority).alias("priority"), F.concat_ws(" ", town, F.substring_index("host", ".", 1), F.lit(words)).alias("query"))

    unseen = known_hosts.select(F.lower("host").alias("host")).distinct().join(by_host.where(F.col("ready") > 0), "host", "left_anti")
    out = missing.unionByName(gap(unseen, "missing_provider", 2, "summer camp registration"))
    out = out.unionByName(gap(by_host.where(F.col("weak") & (F.col("n") >= 2)), "brochure_gap", 2, "summer camp register online"))
    return out.unionByName(gap(by_host.where(F.col("failed") & (F.col("ready") == 0)), "failed_enrollment", 1, "youth summer camp registration catalog"))


def coverage_score(sessions: DataFrame) -> DataFrame:
    """ready, total, and their share to two digits; 0 for an empty catalog."""
    g = sessions.agg(F.count_if(text("parent_verdict") == "parent_ready").alias("ready"), F.count("*").alias("total"))
    return g.select("ready", "total", F.bround(F.col("ready") / F.greatest(F.col("total"), F.lit(1)), 2).alias("coverage_score"))


def searchable_holes(holes: DataFrame, shared: DataFrame) -> DataFrame:
    """holes (town, category, ..) with `covered_via`: another town whose providers cover the category; null: still to be
    searched. shared: town, category, via_town, as shared_coverage() gives it."""
    other = shared.where(F.col("via_town") != F.col("town")).select("town", "category", F.col("via_town").alias("covered_via"))
    return holes.join(other, ["town", "category"], "left")


def manifest(registry: DataFrame, shared: DataFrame) -> DataFrame:
    """One row per provider: url, provider_name, host, towns_served, categories, parent_verdict, priority.

    registry: as registry_fold() gives it. shared: town, category, via_town. A provider serves the towns that are covered
    from its own town in one of its categories; without any, its own town."""
    offers = registry.select("host", F.col("town").alias("via_town"), F.explode_outer("categories").alias("category"))
    served = offers.join(shared.select("town", "category", "via_town").distinct(), ["via_town", "category"]).groupBy("host").agg(F.array_sort(F.collect_set("town")).alias("towns"))
    r = registry.where(F.size("urls") > 0).join(served, "host", "left")
    return r.select(
        F.get("urls", 0).alias("url"), F.col("name").alias("provider_name"), "host", F.array_join(F.coalesce("towns", F.array(text("town"))), ";").alias("towns_served"), F.array_join("categories", ";").alias("categories"),
        F.when(F.col("parent_ready"), "parent_ready").otherwise("info_confirmed").alias("parent_verdict"), F.when(F.col("parent_ready"), 1).otherwise(2).alias("priority"),
    )


def fill_round(sessions: DataFrame, found: DataFrame, categories: DataFrame, known_hosts: DataFrame, town: Column) -> tuple[DataFrame, DataFrame]:
    """One round of filling gaps: the catalog with the found sessions whose registration it has not, each once, and its holes after that."""
    url = text("register_url")
    fresh = found.where(url != "").join(sessions.select("register_url").distinct(), "register_url", "left_anti").dropDuplicates(["register_url"])
    both = sessions.unionByName(fresh, allowMissingColumns=True)
    return both, catalog_holes(both, categories, known_hosts, town)
