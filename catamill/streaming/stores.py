"""Stores that streams add to: each batch writes its own delta, readers merge, and compaction folds deltas into a base.

A store is a folder of `delta=k` (what batch k wrote) and `base=k` (all up to batch k, folded). Either counts only once it
is whole, and readers take the last base and the deltas behind it. So a batch that runs again replaces its own delta, a
failure at any place leaves what was there before, and a base takes effect at the moment its last file is written; what
it replaces goes a compaction later. Deltas and bases are split by a hash of the key, so that a batch reads only the parts
that its own keys fall into.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catamill.functions import urls as U
from catamill.functions.common import bind, text
from catamill.operators.monitor import snapshot_alarms

Fold = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Store:
    """path: of the folder. key: the columns that split rows over `buckets`. fold: rows of one key, of several deltas, to
    one row of the same columns. every: deltas after which they are folded."""

    path: str
    key: tuple[str, ...]
    fold: Fold
    buckets: int = 64
    every: int = 8

    def _versions(self, spark: SparkSession, kind: str) -> list[int]:
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [(f.getPath(), f.getPath().getName()) for f in fs.listStatus(root)]
        return sorted(int(n.split("=")[1]) for p, n in names if n.startswith(f"{kind}=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _filled(self, spark: SparkSession, path: str) -> bool:
        """Whether a version has rows: one without leaves no part."""
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return any(f.getPath().getName().startswith("bucket=") for f in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at))

    def _delete(self, spark: SparkSession, name: str) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame, k: int) -> None:
        """rows, one for each key, as the delta of batch k."""
        rows.withColumn("bucket", self.bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/delta={k}")

    def read(self, spark: SparkSession, before: int | None = None, touched: DataFrame | None = None) -> DataFrame | None:
        """What batches (those before `before`) have written, folded; with `touched` (its keys) only the parts that these
        fall into. None where nothing is written."""
        last = lambda vs: [v for v in vs if before is None or v < before]
        base = last(self._versions(spark, "base"))[-1:]
        deltas = [v for v in last(self._versions(spark, "delta")) if not base or v > base[0]]
        paths = [f"{self.path}/base={v}" for v in base] + [f"{self.path}/delta={v}" for v in deltas]
        paths = [p for p in paths if self._filled(spark, p)]
        if not paths:
            return None
        wanted = None if touched is None else sorted(r[0] for r in touched.select(self.bucket()).distinct().collect())  # `buckets` numbers at most
        out = None
        for path in paths:  # one base, and fewer than `every` deltas and those that a compaction has yet to remove
            part = spark.read.parquet(path)
            part = part if wanted is None else part.where(F.col("bucket").isin(wanted))  # prunes folders
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return self.fold(out.drop("bucket"))

    def compact(self, spark: SparkSession, k: int) -> bool:
        """Folds everything up to batch k into a base, if so many deltas are there; goes by whole batches, so that a batch
        that is run again finds what it found before."""
        bases, deltas = self._versions(spark, "base"), self._versions(spark, "delta")
        behind = [v for v in deltas if v <= k and (not bases or v > bases[-1])]
        if len(behind) < self.every:
            return False
        rows = self.read(spark, k + 1)
        if rows is None:
            return False
        rows.withColumn("bucket", self.bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base={k}")
        for v in bases[:-1]:
            self._delete(spark, f"base={v}")
        if bases:  # covered by the base before this one
            for v in [v for v in deltas if v <= bases[-1]]:
                self._delete(spark, f"delta={v}")
        return True


# Pages: the latest of each address


def _latest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.max_by(F.struct(*rows.columns), F.struct("ts", "html")).alias("r")).select("r.*")


def page_store(path: str, buckets: int = 64, every: int = 8) -> Store:
    """Pages (key, url, html, ts): the latest of each canonical address; of equal times the greater text."""
    return Store(path, ("key",), _latest, buckets, every)


def put_pages(store: Store):
    """For foreachBatch: non-blank pages (url, html, ts and more) go to the store; a batch writes no more than it brings."""

    def put(batch: DataFrame, k: int) -> None:
        own = batch.where(F.trim(text("html")) != "").withColumn("key", U.canonical_url(F.col("url")))
        store.write(_latest(own), k)
        store.compact(batch.sparkSession, k - 1)

    return put


# Keys: all that were ever seen


def seen_store(path: str, buckets: int = 64, every: int = 8) -> Store:
    """Keys with the batch that brought them first."""
    return Store(path, ("key",), lambda rows: rows.groupBy("key").agg(F.min("batch").alias("batch")), buckets, every)


def put_seen(store: Store, key: Column):
    """For foreachBatch: keys that no earlier batch had are written with the batch's number; blank ones are left out."""

    def put(batch: DataFrame, k: int) -> None:
        own = batch.select(key.alias("key")).where(text("key") != "").distinct()
        before = store.read(batch.sparkSession, k, own)
        fresh = own if before is None else own.join(before, "key", "left_anti")
        store.write(fresh.withColumn("batch", F.lit(k).cast("long")), k)
        store.compact(batch.sparkSession, k - 1)

    return put


# Holes, registries and counts: partial aggregates that merge


def hole_store(path: str, buckets: int = 16, every: int = 8) -> Store:
    """Holes' searches (hole_id, attempts, searched_at, found_at, batch): how many, the last of all and the last that found
    something, and the last batch that brought any."""
    fold = lambda rows: rows.groupBy("hole_id").agg(F.sum("attempts").alias("attempts"), *[F.max(c).alias(c) for c in ("searched_at", "found_at", "batch")])
    return Store(path, ("hole_id",), fold, buckets, every)


def put_holes(store: Store, out: str, late: str = "1 hour", exhausted_at: int = 6, days: int = 7, exhausted_days: int = 60):
    """For foreachBatch: rows hole_id, ts, variants, found of searches; the batch forms are operators.monitor.hole_states and
    searchable. Under the batch's number it writes to `out` the state of each hole that the batch has, and `due` for those
    whose time to live has ended, `late` before the latest search so far: holes of the batch, and those of earlier ones that
    were not due then. Searches of any age count; of equal times one that found something decides. A batch reads one row a
    hole, and none goes through Python."""

    def put(batch: DataFrame, k: int) -> None:
        spark = batch.sparkSession
        own = batch.groupBy("hole_id").agg(F.coalesce(F.sum("variants"), F.lit(0)).cast("long").alias("attempts"), F.max("ts").alias("searched_at"), F.max(F.when(F.col("found"), F.col("ts"))).alias("found_at"))
        store.write(own.withColumn("batch", F.lit(k).cast("long")), k)
        store.compact(spark, k - 1)
        before, now = store.read(spark, k), store.read(spark, k + 1)
        if now is None:
            return
        latest = lambda df: df.agg(F.max(F.unix_micros("searched_at"))).first()[0] if df is not None else None
        reached = lambda t: F.coalesce(F.col("due_at") <= F.timestamp_micros(F.lit(t).cast("long")) - F.expr(f"INTERVAL {late}"), F.lit(False))
        status = F.when(F.col("found_at") == F.col("searched_at"), "filled").when(F.col("attempts") >= exhausted_at, "exhausted").otherwise("searched")
        rests = F.make_dt_interval(days=F.when(F.col("status") == "exhausted", exhausted_days).otherwise(days))
        mine = F.col("batch") == k
        due = reached(latest(now)) & (mine | ~reached(latest(before)))
        states = now.withColumn("status", status).withColumn("due_at", F.col("searched_at") + rests)
        told = F.array_compact(F.array(F.when(mine, F.col("status")), F.when(due, F.lit("due"))))
        told = states.select("hole_id", "searched_at", "attempts", F.explode(told).alias("status"))
        told.withColumn("batch", F.lit(k)).write.mode("overwrite").parquet(f"{out}/b={k}")

    return put


def _fold_registry(most: int) -> Fold:
    def fold(rows: DataFrame) -> DataFrame:
        """Of partial rows of a host: the longest name, the first town, all categories, whether any is ready, and the first
        addresses, each with the row that brought it."""
        whole = rows.groupBy("host").agg(
            F.max_by("name", F.struct(F.length(F.coalesce("name.v", F.lit(""))), -F.col("name.o"))).alias("name"), F.min_by("town", "town.o").alias("town"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("categories")))).alias("categories"), F.bool_or("ready").alias("ready"), F.flatten(F.collect_list("urls")).alias("urls"),
        )  # fmt: skip  # at most one row of each delta: lists of `most`
        once = lambda urls: F.filter(urls, lambda x, i: ~F.exists(F.slice(urls, F.lit(1), i), lambda y: y["u"] == x["u"]))
        return whole.withColumn("urls", F.slice(bind(F.array_sort("urls"), once), 1, most))

    return fold


def registry_partials(rows: DataFrame, most: int = 10) -> DataFrame:
    """Session rows (ord 0 and up) as one partial row a host."""
    url = F.coalesce(F.nullif(text("register_url"), F.lit("")), text("info_url"))
    ready = text("parent_verdict").isin("parent_ready") | text("verdict").isin("parent_ready", "info_confirmed")
    r = rows.withColumns({"u": url, "host": U.host_of(url), "o": F.col("ord").cast("long"), "ready": ready}).where(F.col("host") != "")
    part = r.groupBy("host").agg(
        F.max_by(F.struct(F.col("name").alias("v"), "o"), F.struct(F.length(text("name")), -F.col("o"))).alias("name"), F.min_by(F.struct(F.col("town").alias("v"), "o"), "o").alias("town"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("categories")))).alias("categories"), F.bool_or("ready").alias("ready"),
    )
    each = r.groupBy("host", "u").agg(F.min("o").alias("o"))
    first = each.groupBy("host").agg(F.slice(F.array_sort(F.collect_list(F.struct("o", "u"))), 1, most).alias("urls"))  # different addresses of one host in one batch
    return part.join(first, "host")


def registry_store(path: str, most: int = 10, buckets: int = 64, every: int = 8) -> Store:
    return Store(path, ("host",), _fold_registry(most), buckets, every)


def put_registry(store: Store, most: int = 10):
    """For foreachBatch: a batch of session rows is folded by itself; nothing that is stored is folded anew but at compaction."""

    def put(batch: DataFrame, k: int) -> None:
        store.write(registry_partials(batch, most), k)
        store.compact(batch.sparkSession, k - 1)

    return put


def registry(store: Store, spark: SparkSession) -> DataFrame:
    """The fold of all rows so far, as operators.coverage.registry_fold gives it."""
    out = store.read(spark)
    return out.select("host", F.col("name.v").alias("name"), F.col("town.v").alias("town"), "categories", F.col("ready").alias("parent_ready"), F.transform("urls", lambda x: x["u"]).alias("urls"))


def put_counts(store: Store, alarms: str, key: list[str], threshold: float = 0.3):
    """For foreachBatch: counts of a batch against those of the batch before; alarms are written beside them under the
    batch's number. Only the two batches' counts are read."""

    def put(batch: DataFrame, k: int) -> None:
        spark = batch.sparkSession
        store.write(batch.groupBy(*key).agg(F.count("*").alias("n")), k)
        if (k - 1) in store._versions(spark, "delta"):
            none = batch.select(*key, F.lit(0).cast("long").alias("n")).limit(0)
            side = lambda v: spark.read.parquet(f"{store.path}/delta={v}").drop("bucket") if store._filled(spark, f"{store.path}/delta={v}") else none
            snapshot_alarms(side(k - 1), side(k), key, threshold).write.mode("overwrite").parquet(f"{alarms}/batch={k}")

    return put
