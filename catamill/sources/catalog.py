"""Catalog files: session tables in two layouts, per-town folders, split writes with reasons, ledgers, and the town grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catamill.functions import urls as U
from catamill.functions.common import blank, text
from catamill.operators.gates import violations

#: Layout of one extraction's output: file name to columns. All are texts in files; blank ones are empty texts.
LAYOUT = {
    "providers": "provider_id string, name string, host string, town string, platform string, platform_org_id string, seed_url string, status string",
    "programs": "program_id string, provider_id string, name string, info_url string, category_hint string, description_snippet string",
    "sessions": "session_id string, program_id string, name string, info_url string, register_url string, dates string, ages string, price string, verdict string, evidence_json string, extractor string, fetched_at string, content_chars string",
    "gaps": "provider_id string, reason string, evidence string, suggested_action string",
}
#: Columns that become other types when read.
TYPED = {"sessions": {"fetched_at": "timestamp", "content_chars": "int"}}
CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def read_layout(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four tables of a folder (providers, programs, sessions, gaps as CSV), blank cells as empty texts and typed
    columns parsed; what can't be parsed is null."""
    out = {}
    for name, schema in LAYOUT.items():
        df = spark.read.options(**CSV, enforceSchema="false").schema(schema).csv(f"{folder}/{name}.csv").na.fill("")
        for c, kind in TYPED.get(name, {}).items():
            df = df.withColumn(c, F.nullif(F.col(c), F.lit("")).try_cast(kind))
        out[name] = df
    return out


def write_layout(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Writes the tables of LAYOUT as CSV and returns their row counts, counted while they are written."""
    counts = {}
    for name, schema in LAYOUT.items():
        wanted = [c.split()[0] for c in schema.split(", ")]
        df = tables[name].select(*[text(F.col(c).cast("string")).alias(c) if c in tables[name].columns else F.lit("").alias(c) for c in wanted])
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").options(**CSV).csv(f"{folder}/{name}.csv")
        counts[name] = seen.get["n"]
    return counts


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """Published rows of either layout, with `host`: the first that source, info or registration address has. Rows without a name are left out."""
    df = spark.read.options(**CSV).csv(path).na.fill("")
    for c in ("name", "source_url", "info_url", "register_url", "dates"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(""))
    host = F.coalesce(*[F.nullif(U.host_of(F.col(c)), F.lit("")) for c in ("source_url", "info_url", "register_url")], F.lit(""))
    return df.where(~blank("name")).withColumns({"name": F.trim("name"), "host": host})


def scan_towns(spark: SparkSession, pattern: str, level: int = 2) -> DataFrame:
    """All files that a pattern like folder/*/engine/sessions.csv matches, with `town` from the path: the folder that many
    levels above the file, in words."""
    df = spark.read.options(**CSV).csv(pattern).na.fill("")
    parts = F.split(F.url_decode(F.col("_metadata.file_path")), "/")
    slug = F.element_at(parts, -1 - level)
    return df.withColumn("town", F.initcap(F.translate(slug, "_-", "  ")))


def write_towns(rows: DataFrame, path: str) -> None:
    """One folder a town; towns of these rows are replaced, others stay."""
    rows.repartition("town").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("town").parquet(path)


def write_split(rows: DataFrame, status: Column, reason: Column, path: str) -> DataFrame:
    """All rows once, each in the folder of its status with its reason; returns counts by status and reason."""
    tagged = rows.withColumns({"status": status, "reason": F.coalesce(reason, F.lit(""))})
    tagged.write.mode("overwrite").partitionBy("status").parquet(path)
    return rows.sparkSession.read.parquet(path).groupBy("status", "reason").agg(F.count("*").alias("n"))


def append_ledger(rows: DataFrame, path: str, run_date: Column) -> None:
    """Adds rows of one run to a ledger; what it has is never rewritten."""
    rows.withColumn("run_date", run_date).write.mode("append").partitionBy("run_date").parquet(path)


def upsert_town(grid: DataFrame | None, rows: DataFrame) -> DataFrame:
    """The long grid (category, town, value) with all cells of the rows' towns replaced."""
    rows = rows.select("category", "town", "value")
    if grid is None:
        return rows
    return grid.select("category", "town", "value").join(rows.select("town").distinct(), "town", "left_anti").select("category", "town", "value").unionByName(rows)


def wide_grid(grid: DataFrame, towns: list[str]) -> DataFrame:
    """Categories by towns, the columns in the order given; cells without a value are empty."""
    return grid.groupBy("category").pivot("town", towns).agg(F.first("value")).na.fill("")


# Vendors that a registry may name.
VENDORS = ("webtrac", "myrec", "active", "sawyer", "campbrain", "enrollsy", "daxko", "communityed", "recdesk", "civicrec", "communitypass", "ultracamp", "viking", "unknown")


def load_registry(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """entries (name, host, vendor, seed) that break no rule, with `host` in lower case, and the violations of the others:
    key (host), rule. A host that stands twice counts as broken throughout."""
    e = entries.withColumn("host", F.lower(F.trim(text("host"))))
    rules = {
        "name": ~blank("name"), "host": F.col("host") != "", "vendor": text("vendor").isin(*VENDORS), "absolute seed": text("seed").rlike(r"^https?://[^/]+"),
    }
    broken = violations(e, "host", rules, "host")
    return e.join(broken.select(F.col("key").alias("host")).distinct(), "host", "left_anti").select(*entries.columns), broken


# Reasons of gaps, and the band of the region's ZIPs.
GAP_REASONS = ("needs_adapter", "render_failed", "blocked", "empty", "needs_review", "budget_exceeded")
TOWN_ZIP = r"^0(?:1[4-9]|2[0-4])\d{2}$"


def town_violations(towns: DataFrame, state: str = "MA") -> DataFrame:
    """key (town), rule for every town (town, zip, state) without a ZIP of the band or in another state, and towns that stand twice."""
    return violations(towns, "town", {"zip": ~blank("zip"), "zip band": blank("zip") | F.trim("zip").rlike(TOWN_ZIP), "state": F.upper(text("state")) == state}, "town")


def gap_violations(gaps: DataFrame) -> DataFrame:
    """key (provider_id), rule for every gap whose reason is none of GAP_REASONS."""
    return violations(gaps, "provider_id", {"reason": text("reason").isin(*GAP_REASONS)})
