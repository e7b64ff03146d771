"""Record linkage: stable ids, collapse by id, fuzzy collapse in blocks, merges with provenance, unions of sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.functions import dates as D
from catamill.functions import texts as T
from catamill.functions import urls as U
from catamill.functions.common import blank, first_nonblank, text
from catamill.operators.collapse import greedy_leads
from catamill.operators.geo import tag_venues
from catamill.operators.similar import similar_pairs
from catamill.session import cut


def short_id(prefix: str, *parts: Column | str) -> Column:
    """prefix_ and ten hexadecimal digits of the SHA-1 of the parts."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha1(F.concat_ws("|", *[text(p) for p in parts])), 1, 10))


def session_uid(rows: DataFrame) -> DataFrame:
    """rows (name, register_url, info_url, course_no, geo_zip, venue_zip, start_date, dates: missing ones count as empty)
    with stable_id, zip, day and session_uid: the platform's id, else `fuzzy|name|zip|day`."""
    c = lambda n: text(n) if n in rows.columns else F.lit("")
    pid = U.stable_id(first_nonblank(c("register_url"), c("info_url")), c("course_no"))
    zip_, day = first_nonblank(c("geo_zip"), c("venue_zip")), F.substring(F.trim(first_nonblank(c("start_date"), c("dates"))), 1, 10)
    out = rows.withColumns({"stable_id": pid, "match_name": T.sorted_name(c("name")), "zip": F.trim(zip_), "day": day})
    return out.withColumn("session_uid", F.when(F.col("stable_id") != "", F.col("stable_id")).otherwise(F.concat_ws("|", F.lit("fuzzy"), "match_name", "zip", "day")))


def _merged(rows: DataFrame, by: str, ord_: str, lists: Sequence[str]) -> DataFrame:
    """One row per key: each column's first non-blank value in order, list columns joined in first-seen order."""
    plain = [c for c in rows.columns if c not in (by, ord_, *lists)]
    types = dict(rows.dtypes)
    some = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c)) != "") if types[c] == "string" else F.col(c).isNotNull()
    first = [F.min_by(F.col(c), F.when(some(c), F.col(ord_))).alias(c) for c in plain]
    joined = [F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(ord_).alias("o"), F.coalesce(F.col(c), F.array().cast(types[c])).alias("v")))), lambda x: x["v"]))).alias(c) for c in lists]
    return rows.groupBy(by).agg(F.min(ord_).alias(ord_), F.count("*").alias("n_merged"), *first, *joined)


def collapse_by_id(rows: DataFrame, key: Column, ord_: str = "ord", lists: Sequence[str] = ()) -> DataFrame:
    """Rows of one key become one (blank keys: none); blanks are filled from later rows. n_merged: rows that went in."""
    keyed = rows.withColumn("merge_key", F.when(~blank(key), key).otherwise(F.concat(F.lit("\0row|"), F.col(ord_).cast("string"))))
    return _merged(keyed, "merge_key", ord_, lists).drop("merge_key")


def _joined(rows: DataFrame, by: str, ord_: str, lists: Sequence[str]) -> DataFrame:
    """Per key and list column the different values in the order in which rows first bring them."""
    out = None
    for c in lists:
        each = rows.select(by, F.col(ord_).alias("o"), F.posexplode(c).alias("p", "v")).groupBy(by, "v").agg(F.min(F.struct("o", "p")).alias("at"))
        one = each.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias(c))
        out = one if out is None else out.join(one, by, "full_outer")
    return out


def dedupe_sessions(rows: DataFrame, lists: Sequence[str] = ("discovered_via", "serving_towns"), threshold: float = 0.92) -> DataFrame:
    """rows with `ord` (unique): in order, each row joins the kept one with its stable id, else the first kept one of its
    (zip, day) with a similar name unless both have ids, else it is kept. A kept row keeps its session_uid, its blanks are
    filled from later rows, and its lists take in theirs; n_merged counts all. A row's `platform`, where there is one,
    stands in its discovered_via if that is empty, and at its end when the row joins another. Rows without name, zip or
    day join by id alone."""
    lists = [c for c in lists if c in rows.columns]
    keyed = cut(session_uid(rows))
    leads = greedy_leads(keyed.select("ord", F.col("stable_id").alias("id"), F.col("match_name").alias("name"), "zip", "day"), threshold)
    both = keyed.join(leads, "ord")
    if "platform" in rows.columns and "discovered_via" in lists:
        own, via = F.when(text("platform") != "", F.array("platform")).otherwise(F.array().cast("array<string>")), F.coalesce("discovered_via", F.array().cast("array<string>"))
        both = both.withColumn("discovered_via", F.when((F.col("ord") == F.col("lead")) & (F.size(via) > 0), via).otherwise(F.concat(via, own)))
    merged = _merged(both.drop(*lists), "lead", "ord", [])
    joined = _joined(both, "lead", "ord", lists)
    if joined is not None:
        merged = merged.join(joined, "lead", "left").withColumns({c: F.coalesce(c, F.array().cast(dict(rows.dtypes)[c])) for c in lists})
    return merged.drop("lead")


def fill_starts(rows: DataFrame, default_year: int) -> DataFrame:
    """rows with blank start_date filled by the first date that `dates` has."""
    found = F.date_format(D.first_date(F.col("dates"), F.lit(default_year)), "yyyy-MM-dd")
    return rows.withColumn("start_date", first_nonblank(F.col("start_date"), found))


def merge_catalog(sources: dict[str, DataFrame], default_year: int, towns: DataFrame | None = None, state: str = "MA") -> DataFrame:
    """One catalog of several sources (name, platform, register_url, info_url, dates, town, and more): in the order given,
    rows without name and address left out, start dates read from dates, the same session collapsed, and the geography of
    rows that have none read from their venue. A source of one town is at that town, in `state`.

    `ord` in a source orders its rows. Columns that a source lacks are blank."""
    wanted = ("name", "platform", "register_url", "info_url", "dates", "start_date", "ages", "price", "verdict", "town", "geo_town", "geo_city", "geo_state", "geo_zip", "venue")
    rows = union_sources(sources)
    for c in (*wanted, "course_no"):
        rows = rows.withColumn(c, text(c) if c in rows.columns else F.lit(""))
    none = F.array().cast("array<string>")
    for c in ("serving_towns", "discovered_via"):
        rows = rows.withColumn(c, F.coalesce(c, none) if c in rows.columns else none)
    by_town = F.col("town") != ""
    rows = rows.withColumns({
        "serving_towns": F.when((F.size("serving_towns") == 0) & by_town, F.array("town")).otherwise(F.col("serving_towns")),
        "platform": first_nonblank(F.col("platform"), F.col("source")),
        "geo_town": first_nonblank(F.col("geo_town"), F.col("town")), "geo_state": F.when(by_town, first_nonblank(F.col("geo_state"), F.lit(state))).otherwise(F.col("geo_state")),
    })
    out = dedupe_sessions(fill_starts(rows.where((F.col("name") != "") | (F.col("register_url") != "")), default_year))
    out = out.withColumns({c: text(c) for c in (*wanted, "course_no")})
    if towns is None:
        return out
    tagged = tag_venues(out.select("ord", "venue"), towns).select("ord", F.col("geo_town").alias("venue_town"), F.col("geo_state").alias("venue_state"))
    lacks = F.col("geo_state") == ""
    out = out.join(tagged, "ord", "left").withColumns({"geo_town": F.when(lacks, first_nonblank(F.col("geo_town"), F.col("venue_town"))).otherwise(F.col("geo_town")), "geo_state": first_nonblank(F.col("geo_state"), F.col("venue_state"))})
    return out.drop("venue_town", "venue_state")


def fuzzy_pairs(rows: DataFrame, block: Sequence[str], name: str, key: str, threshold: float, flavour: str = "indel") -> DataFrame:
    """a, b, ratio of rows in one block whose names are similar, none left out (threshold: 0.7 or more)."""
    return similar_pairs(rows, block, name, key, threshold, flavour)


def dedupe_published(rows: DataFrame, rank: Column) -> DataFrame:
    """Rows with `ord` that share any of platform id, canonical register address, or (host, name, dates): the one with
    the highest rank stays, the first among equals. Keys link transitively."""
    from catamill.operators.graph import components

    url = U.canonical_register_url(F.col("register_url"))
    triple = F.concat_ws("|", U.host_of(F.col("register_url")), T.identity_name(F.col("name")), text("dates"))
    keys = F.array(F.nullif(U.register_platform_id(url), F.lit("")), F.nullif(url, F.lit("")), F.when(T.identity_name(F.col("name")) != "", F.concat(F.lit("t|"), triple)))
    each = cut(rows.select("ord", F.explode(F.array_compact(keys)).alias("key")))  # read twice; addresses are taken apart once
    # Only keys of several rows link any; a row that shares none is its own component.
    leads = each.groupBy("key").agg(F.min("ord").alias("lead"), F.max("ord").alias("last")).where("lead <> last").select("key", "lead")
    edges = each.join(leads, "key").where("ord <> lead").select(F.col("ord").alias("a"), F.col("lead").alias("b")).distinct()
    labels = components(edges)
    r = rows.join(labels.withColumnRenamed("node", "ord"), "ord", "left").withColumn("label", F.coalesce("label", "ord"))
    best = F.max_by(F.struct(*rows.columns), F.struct(rank.alias("rank"), (-F.col("ord")).alias("first")))
    return r.groupBy("label").agg(best.alias("r")).select("r.*")


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources in one schema, with `source` and `ord`: rank of the source first, then the row's own order (`ord` or none)."""
    out = None
    for k, (name, df) in enumerate(sources.items()):
        own = F.col("ord") if "ord" in df.columns else F.monotonically_increasing_id()
        df = df.withColumns({"source": F.lit(name), "ord": F.lit(k << 50) + own})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no sources")
    return out


def reconcile(rows: DataFrame, deduped: DataFrame, source: str = "source") -> DataFrame:
    """Per source: rows that came in, that stayed, and that were collapsed."""
    a, b = rows.groupBy(source).agg(F.count("*").alias("raw")), deduped.groupBy(source).agg(F.count("*").alias("kept"))
    return a.join(b, source, "left").select(source, "raw", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("raw") - F.coalesce("kept", F.lit(0))).alias("collapsed"))


def group_programs(sessions: DataFrame) -> DataFrame:
    """Sessions of one provider whose names differ by dates and week labels alone: name of the first, and all sessions."""
    key = F.coalesce(F.nullif(T.undated_name(F.col("name")), F.lit("")), F.lower(text("name")))
    first = F.min_by(F.struct(T.display_name(F.col("name")).alias("d"), text("name").alias("n")), "ord")
    out = sessions.groupBy("provider_id", key.alias("program_key")).agg(first.alias("f"), F.array_sort(F.collect_list(F.struct("ord", "name"))).alias("members"))
    return out.select("provider_id", "program_key", first_nonblank(F.col("f.d"), F.col("f.n")).alias("program_name"), F.transform("members", lambda m: m["name"]).alias("sessions"))
