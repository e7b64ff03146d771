"""Registered domains by rules of public suffixes, given as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catamill.functions.common import text


def registered_domains(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """hosts (host and more) with `suffix` and `domain`: the host's public suffix, and that with one label more.

    rules: rule, as lists of public suffixes have them: `com`, `co.uk`, `*.ck` (any label before it), `!www.ck` (an
    exception: no suffix). An exception wins, its suffix is the rule without its first label; else the rule of most labels;
    without any the last label is the suffix. A host that is a suffix itself, or an address of numbers, is its own domain;
    ports, case and a dot at the end don't count. Each suffix of a host meets the rules by equality, once a distinct host."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(text("host")), r":\d+$", ""), r"\.$", "")
    one = hosts.select("host").distinct().withColumns({"bare": bare, "labels": F.split(bare, r"\.")})
    n = F.size("labels")
    own = F.explode(F.transform(F.sequence(F.lit(1), n), lambda k: F.struct(k.alias("size"), F.array_join(F.slice("labels", n - k + 1, k), ".").alias("name"))))
    each = one.where(~F.col("bare").rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$") & (F.col("bare") != "")).select("host", "labels", own.alias("s")).select("host", "labels", "s.size", "s.name")
    r = rules.select(F.lower(F.trim("rule")).alias("rule")).where("rule <> ''").distinct()
    kind = F.when(F.col("rule").startswith("!"), "!").when(F.col("rule").startswith("*."), "*").otherwise("")
    r = r.select(kind.alias("kind"), F.regexp_replace("rule", r"^(?:!|\*\.)", "").alias("name"))
    # A rule `*.x` makes a suffix of one label more than x.
    hit = each.join(r, "name").select("host", F.size("labels").alias("n"), "kind", F.when(F.col("kind") == "*", F.col("size") + 1).when(F.col("kind") == "!", F.col("size") - 1).otherwise(F.col("size")).alias("size"))
    hit = hit.where(F.col("size") <= F.col("n"))
    best = hit.groupBy("host").agg(F.max(F.struct((F.col("kind") == "!").alias("exception"), "size")).alias("b")).select("host", F.col("b.size").alias("size"))
    size = F.coalesce("size", F.lit(1))
    last = lambda k: F.array_join(F.slice("labels", F.greatest(n - k, F.lit(0)) + 1, k), ".")
    alone = F.col("bare").rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$") | (F.col("bare") == "")
    found = one.join(best, "host", "left").select("host", F.when(alone, F.col("bare")).otherwise(last(size)).alias("suffix"), F.when(alone, F.col("bare")).otherwise(last(size + 1)).alias("domain"))
    return hosts.join(found, hosts["host"].eqNullSafe(found["host"]), "left").drop(found["host"])
