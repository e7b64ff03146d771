"""Run monitoring and incremental state in batch form: caps, drift alarms, floors, saturation, states with a time to live."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catamill.session import cut


def cap_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str], cap: int) -> tuple[DataFrame, DataFrame]:
    """The first `cap` rows of each key, and per truncated key how many went."""
    kept = rows.withColumn("cap_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("cap_rank") <= cap).drop("cap_rank")
    return kept, rows.groupBy(*key).count().where(F.col("count") > cap).select(*key, (F.col("count") - cap).alias("truncated"))


def snapshot_alarms(old: DataFrame, new: DataFrame, key: Sequence[str], threshold: float = 0.3) -> DataFrame:
    """key..., old_n, new_n, delta where counts (n) moved by more than the threshold; keys of either side count as 0 on
    the other. Without an earlier snapshot there are no alarms."""
    j = old.select(*key, F.col("n").alias("old_n")).join(new.select(*key, F.col("n").alias("new_n")), list(key), "full_outer").fillna(0, ["old_n", "new_n"])
    delta = (F.col("new_n") - F.col("old_n")) / F.greatest(F.col("old_n"), F.lit(1))
    return j.select(*key, "old_n", "new_n", delta.alias("delta")).where(F.abs("delta") > threshold)


def zero_floor(dimension: DataFrame, rows: DataFrame, key: str, least: int = 1) -> DataFrame:
    """Keys of a dimension with fewer rows than the floor."""
    n = rows.groupBy(key).count()
    return dimension.join(n, key, "left").select(*dimension.columns, F.coalesce("count", F.lit(0)).alias("n")).where(F.col("n") < least)


def saturation(events: DataFrame, group: str, seq: str, key: str, floor: int, window: int) -> DataFrame:
    """Per group the first place in order at which `floor` searches are done and the last `window` found no new key
    (null: never). seq numbers searches; a search may have several rows, or one with a null key.

    A search that ends a dry window lies at least `window` searches behind the last one that found something, so only
    these are needed: places come from a sort by ranges, and per group the finds alone, one row a key at most, are put in order."""
    first = events.where(F.col(key).isNotNull()).groupBy(group, key).agg(F.min(seq).alias(seq)).select(group, seq).distinct().withColumn("fresh", F.lit(True))
    each = placed(events.select(group, seq).distinct(), group, seq)
    finds = each.join(first, [group, seq]).select(group, "place")
    sizes = each.groupBy(group).agg(F.max("place").alias("searches"))
    # A run of dry searches follows each find, and stands before the first one.
    starts = finds.unionByName(sizes.select(group, F.lit(0).cast("long").alias("place")))
    nxt = F.lead("place").over(Window.partitionBy(group).orderBy("place"))
    runs = starts.withColumn("next", nxt).join(sizes, group)
    stop = F.greatest(F.col("place") + window, F.lit(max(1, floor)).cast("long"))
    stops = runs.where(stop < F.coalesce("next", F.col("searches") + 1)).groupBy(group).agg(F.min(stop).alias("place"))
    out = sizes.join(stops.join(each, [group, "place"]).select(group, F.col(seq).alias("stop_at")), group, "left")
    return out.select(group, "stop_at", F.col("searches"))


def placed(rows: DataFrame, group: str, seq: str) -> DataFrame:
    """rows with `place`, 1 and up in each group: sorted by ranges of (group, seq), each task counting on from those before."""
    at = cut(rows.orderBy(group, seq).withColumn("__part", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id()))
    before = at.groupBy("__part", group).agg(F.count("*").alias("n"), F.min("__id").alias("first"))  # a row for each group that a task holds
    skip = F.sum("n").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    before = before.withColumn("skip", F.coalesce(skip, F.lit(0))).drop("n")
    return at.join(before, ["__part", group]).withColumn("place", (F.col("__id") - F.col("first") + F.col("skip") + 1).cast("long")).select(*rows.columns, "place")


def latest(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key."""
    return rows.withColumn("latest_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("latest_rank") == 1).drop("latest_rank")


def hole_states(attempts: DataFrame, exhausted_at: int = 6) -> DataFrame:
    """attempts (hole_id, ts, variants, found) folded per hole: last time, attempts, and status: filled if the last one
    found something, exhausted from so many attempts on, else searched."""
    g = attempts.groupBy("hole_id").agg(F.max("ts").alias("searched_at"), F.sum("variants").alias("attempts"), F.max_by("found", "ts").alias("found"))
    return g.select("hole_id", "searched_at", "attempts", F.when(F.col("found"), "filled").when(F.col("attempts") >= exhausted_at, "exhausted").otherwise("searched").alias("status"))


def searchable(holes: DataFrame, states: DataFrame, as_of: Column, days: int = 7, exhausted_days: int = 60) -> DataFrame:
    """Holes whose last search is as old as its time to live or older (exhausted ones rest longer), or that have none."""
    ttl = F.when(F.col("status") == "exhausted", exhausted_days).otherwise(days)
    fresh = F.coalesce(as_of < F.col("searched_at") + F.make_interval(days=ttl), F.lit(False))
    return holes.join(states, "hole_id", "left").where(~fresh).select(*holes.columns)


def running_yield(events: DataFrame, key: str, success: Column, ts: str) -> DataFrame:
    return events.groupBy(key).agg(F.count("*").alias("attempts"), F.avg(success.cast("double")).alias("mean_yield"), F.max(F.when(success, F.col(ts))).alias("last_success"))


def nearest(rows: DataFrame, group: Sequence[str], distance: str, object_id: str, n: int) -> DataFrame:
    """Per group the n nearest distinct objects."""
    one = rows.withColumn("o_rank", F.row_number().over(Window.partitionBy(*group, object_id).orderBy(distance))).where(F.col("o_rank") == 1).drop("o_rank")
    return one.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(distance, object_id))).where(F.col("rank") <= n)


def nearest_once(rows: DataFrame, group: str, order: str, distance: str, object_id: str, n: int) -> DataFrame:
    """Groups served in `order`, each by the n nearest objects that no group before took; rank in each group. An object's
    row that is nearest counts; rows without an object don't.

    As a loop this is one group after another. Here each group asks for its n nearest at once, an object goes to the first
    group in order that asks, and the others ask on: deferred acceptance, whose result is that of the loop, as all objects
    prefer groups alike. Once a group asks for an object, no later group can have it, so these rows go as well."""
    some = rows.where(F.col(object_id).isNotNull())
    one = some.groupBy(group, order, object_id).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in (group, order, object_id)]), distance).alias("r"))
    left = cut(one.select(group, order, object_id, "r.*"))
    w = Window.partitionBy(group).orderBy(distance, object_id)
    while True:
        asked = cut(left.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n))
        goes = asked.groupBy(object_id).agg(F.min(order).alias("__to"))
        late = left.join(goes, object_id).where(F.col(order) > F.col("__to")).select(group, object_id)
        late = cut(late)
        if not asked.join(late, [group, object_id], "left_semi").limit(1).count():
            return asked
        left = cut(left.join(late, [group, object_id], "left_anti"))
