"""Greedy collapse of records in order, without any block in one task.

Said in a loop: each row joins the kept row that has its id; else the first kept row of its block with a similar name,
unless both have an id; else it is kept itself. What joins fills the kept row's blanks: its id, name, zip and day.

Three facts make that a distributed job. Of an id, only the first row decides, and the others follow it. A kept row whose
name, zip or day is blank can be joined by its id alone, so the row that completes it is known beforehand, and from there
on it takes part as well. And rows without an id, of equal name and block, follow the first of them, as they would find
the same kept row. What is left decides in rounds: a row looks at the first of its earlier neighbours that is not yet
known to be no kept row. If that is kept, the row joins it; if there is none, it is kept; else it waits. A kept row
without an id takes one id alone, that of the first row in order that chooses it. Each round settles the first row that
is left at least, and most rows in the first few.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catamill.operators.similar import both_ways, similar_names
from catamill.session import cut

#: Edges up to which the rest is settled in one task once the rounds have become thin.
LAST_EDGES, LAST_ROUND = 200_000, 6


def _heads(rows: DataFrame) -> DataFrame:
    """Per id: its first row (head), and what its rows make of it: name, zip, day, and `since`, the row that completed them."""
    first = lambda c: F.min(F.when(F.col(c) != "", F.struct("ord", F.col(c).alias("v")))).alias(c)
    found = rows.where("id <> ''").groupBy("id").agg(F.min("ord").alias("head"), first("name"), first("zip"), first("day"))
    complete = F.col("name").isNotNull() & F.col("zip").isNotNull() & F.col("day").isNotNull()
    since = F.when(complete, F.greatest("name.ord", "zip.ord", "day.ord"))
    return found.select("id", "head", since.alias("since"), *[F.col(f"{c}.v").alias(c) for c in ("name", "zip", "day")])


def _late_records(late: DataFrame, near: DataFrame) -> DataFrame:
    """zip, day, name, since, head: for each name the late rows next to it that come before all late ones known until then."""
    by = late.select("zip", "day", F.col("name").alias("n"), "since", "head").join(near.withColumnRenamed("m", "own"), ["zip", "day", "n"])
    w = Window.partitionBy("zip", "day", "own").orderBy("since").rowsBetween(Window.unboundedPreceding, -1)
    lower = by.withColumn("before", F.min("head").over(w)).where(F.col("before").isNull() | (F.col("head") < F.col("before")))
    return lower.select("zip", "day", F.col("own").alias("name"), "since")


def _settled(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rounds' rules, row by row: edges r, has_id, c, p."""
    lead: dict[int, int] = {}
    taken: set[int] = set()
    out = []
    for r, own in pdf.sort_values(["r", "p"]).groupby("r", sort=True):
        to = r
        for c, has_id in zip(own["c"], own["has_id"], strict=True):
            # Those that have no edges themselves are kept.
            if lead.get(c, c) == c and not (has_id and c in taken):
                to = c
                if has_id:
                    taken.add(c)
                break
        lead[r] = to
        out.append((r, to))
    return pd.DataFrame(out, columns=["r", "lead"])


def _rounds(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes: r. edges: r, has_id, c, p (the order of c), live (c is known to be kept). Returns r, lead."""
    left, edges = cut(nodes), cut(edges)
    done = []
    for k in range(1 << 20):
        if left.limit(1).count() == 0:
            break
        if k >= LAST_ROUND and edges.count() <= LAST_EDGES:
            # A bounded rest, such as a chain in which each waits for the one before.
            done.append(cut(edges.groupBy(F.lit("rest").alias("rest")).applyInPandas(_settled, "r long, lead long")))
            left = left.join(edges.select("r").distinct(), "r", "left_anti")
            break
        first = edges.groupBy("r").agg(F.min(F.struct("p", "c", "live")).alias("f"), F.first("has_id").alias("has_id"))
        turn = edges.where("has_id").groupBy("c").agg(F.min("r").alias("turn"))
        seen = left.join(first, "r", "left").select("r", "has_id", F.col("f.c").alias("c"), F.col("f.live").alias("live")).join(turn, "c", "left")
        lead = F.when(F.col("c").isNull(), F.col("r")).when(F.col("live") & (~F.col("has_id") | (F.col("turn") == F.col("r"))), F.col("c"))
        now = cut(seen.select("r", "has_id", lead.alias("lead")).where("lead is not null"))
        done.append(now.select("r", "lead"))
        left = cut(left.join(now, "r", "left_anti"))
        # Edges of settled rows go, and those to rows that are not kept, and to kept ones that have taken an id.
        kept = now.select(F.col("r").alias("c"), (F.col("r") == F.col("lead")).alias("kept"))
        taken = now.where("has_id and lead <> r").select(F.col("lead").alias("c"), F.lit(True).alias("taken"))
        e = edges.join(now.select("r"), "r", "left_anti").join(kept, "c", "left").join(taken, "c", "left")
        e = e.where(F.coalesce("kept", F.lit(True)) & ~(F.col("has_id") & F.coalesce("taken", F.lit(False))))
        edges = cut(e.select("r", "has_id", "c", "p", (F.col("live") | F.coalesce("kept", F.lit(False))).alias("live")))
    out = left.withColumn("lead", F.col("r"))  # what has no edges
    for d in done:
        out = out.union(d)
    return out


def greedy_leads(rows: DataFrame, threshold: float) -> DataFrame:
    """rows: ord (unique), id, name, zip, day, blank where unknown. Returns ord, lead: the kept row that each row ends in."""
    base = cut(rows.select("ord", *[F.coalesce(c, F.lit("")).alias(c) for c in ("id", "name", "zip", "day")]))
    whole = (F.col("name") != "") & (F.col("zip") != "") & (F.col("day") != "")
    heads = cut(_heads(base))
    # Deciders: first rows of ids, and rows without one, that are complete by themselves.
    with_id = base.where(whole).join(heads.select(F.col("head").alias("ord")), "ord", "left_semi").select("ord", "zip", "day", "name")
    without = base.where(whole & (F.col("id") == "")).select("ord", "zip", "day", "name")
    late = heads.where(F.col("since") > F.col("head")).select("head", "since", "zip", "day", "name")
    names = with_id.select("zip", "day", F.col("name").alias("n")).union(without.select("zip", "day", "name")).union(late.select("zip", "day", "name")).distinct()
    alike = similar_names(names, ["zip", "day"], threshold)
    near = cut(both_ways(alike, ["zip", "day"]).unionByName(names.select("zip", "day", F.col("n").alias("m"), "n")))
    # Classes of equal rows without an id; a late row that comes first from some row on begins a new one.
    if late.limit(1).count():
        marks = _late_records(late, near).select("zip", "day", "name", F.col("since").alias("at"), F.lit(None).cast("long").alias("ord"))
        both = without.select("zip", "day", "name", F.col("ord").alias("at"), "ord").unionByName(marks)
        w = Window.partitionBy("zip", "day", "name").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        hit = marks.select("zip", "day", "name").distinct()
        counted = both.join(hit, ["zip", "day", "name"], "left_semi").withColumn("epoch", F.count_if(F.col("ord").isNull()).over(w)).where("ord is not null").select("ord", "zip", "day", "name", "epoch")
        without = counted.unionByName(without.join(hit, ["zip", "day", "name"], "left_anti").withColumn("epoch", F.lit(0).cast("long")))
    else:
        without = without.withColumn("epoch", F.lit(0).cast("long"))
    without = cut(without)
    classes = cut(without.groupBy("zip", "day", "name", "epoch").agg(F.min("ord").alias("head")))
    # Who may join whom: rows without an id any earlier row, rows with one those without.
    to_free = classes.select("zip", "day", F.col("name").alias("n"), F.col("head").alias("c"), F.col("head").alias("since"), F.lit(False).alias("live"), F.lit(False).alias("c_id"))
    to_own = with_id.select("zip", "day", F.col("name").alias("n"), F.col("ord").alias("c"), F.col("ord").alias("since"), F.lit(False).alias("live"), F.lit(True).alias("c_id"))
    to_late = late.select("zip", "day", F.col("name").alias("n"), F.col("head").alias("c"), "since", F.lit(True).alias("live"), F.lit(True).alias("c_id"))
    there = to_free.unionByName(to_own).unionByName(to_late)
    here = classes.select("zip", "day", F.col("name").alias("m"), F.col("head").alias("r"), F.lit(False).alias("has_id")).union(with_id.select("zip", "day", "name", "ord", F.lit(True)))
    met = here.join(near, ["zip", "day", "m"]).join(there, ["zip", "day", "n"]).where((F.col("since") < F.col("r")) & ~(F.col("has_id") & F.col("c_id")))
    leads = _rounds(here.select("r"), met.select("r", "has_id", "c", F.col("c").alias("p"), "live"))
    leads = cut(leads)
    # Rows follow their class's or id's first row; all others stay.
    follow = without.join(classes, ["zip", "day", "name", "epoch"]).select("ord", "head")
    follow = follow.union(base.where("id <> ''").join(heads.select("id", "head"), "id").select("ord", "head"))
    led = follow.join(leads.withColumnRenamed("r", "head"), "head", "left").select("ord", F.coalesce("lead", "head").alias("lead"))
    return base.select("ord").join(led, "ord", "left").select("ord", F.coalesce("lead", "ord").alias("lead"))
