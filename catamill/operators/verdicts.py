"""Verdicts from start to publication: policies, floors, buckets, fallback rows of providers, and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.functions import urls as U
from catamill.functions.common import blank, first_nonblank, text
from catamill.operators.gates import quality_tier

# The buckets of verdicts.
BUCKETS = ("parent_ready", "brochure_only", "wrong_audience", "fetch_failed", "unverified")


def with_policy(rows: DataFrame, platform: str = "myrec", verdict: str = "needs_js") -> DataFrame:
    """rows (platform, parent_verdict): those of a platform whose carts need a browser take its verdict unless they are
    ready, with parent_can_register false and a reason if they have none."""
    hit = F.contains(F.lower(text("platform")), F.lit(platform)) & (text("parent_verdict") != "parent_ready")
    c = lambda n, kind: F.col(n) if n in rows.columns else F.lit(None).cast(kind)
    why = first_nonblank(c("parent_verify_reason", "string"), F.lit("cart needs a browser; to be confirmed by a rendered page"))
    return rows.withColumns({
        "parent_verdict": F.when(hit, F.lit(verdict)).otherwise(F.col("parent_verdict")), "parent_can_register": F.when(hit, F.lit(False)).otherwise(c("parent_can_register", "boolean")),
        "parent_verify_reason": F.when(hit, why).otherwise(c("parent_verify_reason", "string")),
    })


def program_floor(granularity: Column, verdict: Column) -> Column:
    """A provider's row claims less than a session's: unverified, it still is a brochure."""
    return F.when((text(granularity) == "program") & (text(verdict) == "unverified"), F.lit("brochure_only")).otherwise(verdict)


def with_buckets(rows: DataFrame) -> DataFrame:
    """rows with `bucket`: the verdict if it is one of BUCKETS; without a verdict, wrong_audience where the tier is rejected; else unverified."""
    v = text("parent_verdict")
    tiered = quality_tier(rows)
    bucket = F.when(v == "", F.when(F.col("quality_tier") == "rejected", "wrong_audience").otherwise("unverified")).when(v.isin(*BUCKETS), v).otherwise("unverified")
    return tiered.withColumn("bucket", bucket).select(*rows.columns, "bucket")


def fabrication_blocked(status: Column) -> Column:
    """Whether a page had too little to make a record from."""
    return text(status).isin("needs_js", "login_wall", "empty")


def catalog_rows(sessions: DataFrame) -> DataFrame:
    """Sessions of the extraction (name, info_url, register_url, dates, ages, price, verdict, extractor) in the shape of published rows."""
    return sessions.select(
        *[text(c).alias(c) for c in ("name", "register_url", "info_url", "dates", "ages", "price")], first_nonblank(F.col("extractor"), F.lit("engine")).alias("platform"),
        text("info_url").alias("source_url"), F.lit("session").alias("kind"), text("verdict").alias("parent_verdict"),
    )


def fallback_rows(results: DataFrame, sessions: DataFrame, known_hosts: DataFrame) -> DataFrame:
    """One program row for each result (seed, provider_name, platform, register_url) that is of a known host and has no
    session. sessions: seed. known_hosts: host."""
    r = results.withColumn("host", U.host_of(F.col("seed"))).where(F.col("host") != "")
    r = r.join(known_hosts.select(F.lower("host").alias("host")).distinct(), "host", "left_semi").join(sessions.select("seed").distinct(), "seed", "left_anti")
    name = first_nonblank(F.col("provider_name"), F.initcap(F.replace(F.regexp_replace("host", r"\.[^.]*$", ""), F.lit("."), F.lit(" "))))
    return r.select(
        F.concat(name, F.lit(" — Summer Program")).alias("name"), first_nonblank(F.col("register_url"), F.col("seed")).alias("register_url"), F.lit("").alias("info_url"),
        first_nonblank(F.col("platform"), F.lit("fallback")).alias("platform"), *[F.lit("").alias(c) for c in ("dates", "ages", "price")], F.lit("session").alias("kind"),
        F.col("seed").alias("source_url"), F.lit("program").alias("granularity"), F.lit("fallback").alias("name_source"), F.lit("ok").alias("name_status"),
    )


def drop_stale_programs(rows: DataFrame) -> DataFrame:
    """rows (granularity, source_url) without program rows of hosts that have sessions; a blank granularity is a session's."""
    g = first_nonblank(F.col("granularity"), F.lit("session"))
    r = rows.withColumns({"granularity": g, "__host": U.host_of(F.col("source_url"))})
    busy = r.where(F.col("granularity") == "session").select("__host").distinct()
    stays = r.where(F.col("granularity") != "program")
    return stays.unionByName(r.where(F.col("granularity") == "program").join(busy, "__host", "left_anti")).drop("__host")


def provider_rollup(providers: DataFrame, programs: DataFrame, sessions: DataFrame) -> DataFrame:
    """Per provider its programs and sessions, and how many of these are ready. providers: provider_id, name. programs:
    provider_id, program_id. sessions: program_id, verdict. Sums come before the joins, so that no provider is multiplied."""
    per_program = sessions.groupBy("program_id").agg(F.count("*").alias("s"), F.count_if(F.col("verdict") == "parent_ready").alias("r"))
    per_provider = programs.join(per_program, "program_id", "left").groupBy("provider_id").agg(F.count("*").alias("programs"), F.sum(F.coalesce("s", F.lit(0))).alias("sessions"), F.sum(F.coalesce("r", F.lit(0))).alias("ready"))
    return providers.select("provider_id", "name").join(per_provider, "provider_id", "left").fillna(0, ["programs", "sessions", "ready"])


def hub_stats(rows: DataFrame) -> DataFrame:
    """Per hub (`_hub`): raw rows, rows rejected by season and place, collapsed and emitted ones, and the emitted share.
    rows: _hub, season_ok, geo_ok, first (whether the row leads its group of repeats)."""
    passed = F.col("season_ok") & F.col("geo_ok")
    g = rows.groupBy("_hub").agg(
        F.count("*").alias("raw"), F.count_if(~F.col("season_ok")).alias("season_rejected"), F.count_if(F.col("season_ok") & ~F.col("geo_ok")).alias("geo_rejected"),
        F.count_if(passed & ~F.col("first")).alias("collapsed"), F.count_if(passed & F.col("first")).alias("emitted"),
    )
    return g.withColumn("emit_rate", F.round(F.try_divide(F.col("emitted"), F.col("raw")), 4))


def town_counts(rows: DataFrame, column: str = "serving_towns") -> DataFrame:
    """Rows per town that they serve; those that serve none count under `_`."""
    towns = F.when(F.size(F.coalesce(column, F.array().cast("array<string>"))) > 0, F.col(column)).otherwise(F.array(F.lit("_")))
    return rows.select(F.explode(towns).alias("town")).groupBy("town").agg(F.count("*").alias("n"))


def not_blank(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(~blank(column))
