"""Reports over whole tables: quality and completeness, funnels, summaries with subtotals, gaps, and tops of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.functions.common import text


def completeness(rows: DataFrame, by: str, fields: dict[str, Column], good: Column, base: Column, grades: tuple[tuple[float, str], ...] = ((0.9, "A"), (0.8, "B"), (0.7, "C"))) -> DataFrame:
    """Per group its rows, those with each field (a test), good ones among the base, and a letter by their share; the last letter is D."""
    g = rows.groupBy(by).agg(F.count("*").alias("n"), F.count_if(base).alias("base"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in fields.items()], F.count_if(F.coalesce(base & good, F.lit(False))).alias("good"))
    share = F.try_divide(F.col("good"), F.col("base"))
    letter = F.coalesce(*[F.when(share >= least, F.lit(name)) for least, name in grades], F.lit("D"))
    return g.withColumn("grade", letter)


def subtotals(rows: DataFrame, *by: str) -> DataFrame:
    """Counts by all columns and, column by column from the last, with `all` in its place."""
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in by]
    g = rows.select(*keys).rollup(*by).agg(F.count("*").alias("n"))
    return g.select(*[F.coalesce(c, F.lit("all")).alias(c) for c in by], "n")


def funnel(candidates: DataFrame, links: DataFrame, reason: Column) -> DataFrame:
    """One row: candidates and crawled ones, links, clean links, and slop by reason (map). candidates: crawled. reason: why a link is slop, or null."""
    c = candidates.agg(F.count("*").alias("candidates"), F.count_if(F.coalesce("crawled", F.lit(False))).alias("crawled"))
    tagged = links.select(reason.alias("r"))
    sums = tagged.agg(F.count("*").alias("links"), F.count_if(F.col("r").isNull()).alias("clean"))
    slop = tagged.where(F.col("r").isNotNull()).groupBy("r").agg(F.count("*").alias("n"))  # one row a reason
    slop = slop.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("r", "n")))).alias("slop"))
    return c.crossJoin(sums).crossJoin(slop)  # one row each


def gaps(rows: DataFrame, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """Gaps (provider_id, reason) counted by reason, and the n providers with most of them."""
    by_reason = rows.groupBy(text("reason").alias("reason")).agg(F.count("*").alias("n"))
    return by_reason, tops(rows, "provider_id", n)


def tops(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The n most frequent keys; the first by name among equals."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), key).limit(n)


def pivot_counts(rows: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of each value of a column, side by side."""
    return rows.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0)


def set_operations(a: DataFrame, b: DataFrame) -> dict[str, DataFrame]:
    """Union, difference and intersection of two key tables, each key once."""
    return {"union": a.union(b).distinct(), "minus": a.subtract(b), "both": a.intersect(b)}
