"""Structured Streaming forms of the incremental operators, and runs of them over the files that a folder has."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catamill.functions import urls as U
from catamill.operators.coverage import registry_fold
from catamill.operators.monitor import placed, snapshot_alarms
from catamill.session import cut, shared_dir
from catamill.streaming.stores import Store


def event_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tumbling windows of events by type; windows are final once the watermark has passed them."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"))


def new_links(links: DataFrame, horizon: str = "7 days") -> DataFrame:
    """Links whose canonical address was not seen within the horizon, which bounds the state."""
    return links.withColumn("key", U.canonical_url(F.col("url"))).withWatermark("ts", horizon).dropDuplicatesWithinWatermark(["key"])


def _versions(spark: SparkSession, store: str) -> list[int]:
    """The versions of a store that are written to the end."""
    root = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [(f.getPath(), f.getPath().getName()) for f in fs.listStatus(root)]
    return sorted(int(n[2:]) for p, n in names if n.startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def stored_pages(spark: SparkSession, store: str, as_of: Column | None = None, days: int = 7) -> DataFrame | None:
    """The store's pages, without those older than their time to live at as_of; None if nothing is stored."""
    found = _versions(spark, store)
    if not found:
        return None
    pages = spark.read.parquet(f"{store}/v={found[-1]}")
    return pages if as_of is None else pages.where(F.col("ts") >= as_of - F.make_interval(days=F.lit(days)))


def latest_pages(store: str, keep: int = 2):
    """For foreachBatch: the store keeps the latest non-blank page (url, html, ts) per canonical address, in a version for
    each batch. A version counts only once it is whole, so a failure leaves the one before; a batch that runs again writes
    its version anew. All but the last `keep` versions go."""

    def put(batch: DataFrame, k: int) -> None:
        spark = batch.sparkSession
        own = batch.where(F.trim(F.coalesce("html", F.lit(""))) != "").withColumn("key", U.canonical_url(F.col("url")))
        before = [v for v in _versions(spark, store) if v < k]
        if before:
            own = spark.read.parquet(f"{store}/v={before[-1]}").unionByName(own, allowMissingColumns=True)
        last = own.groupBy("key").agg(F.max_by(F.struct(*own.columns), "ts").alias("r")).select("r.*")
        last.write.mode("overwrite").parquet(f"{store}/v={k}")
        for v in before[: len(before) + 1 - keep]:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/v={v}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    return put


def counts_alarms(store: str, key: list[str], threshold: float = 0.3):
    """For foreachBatch: counts of each batch (key.., n) against those of the batch before; alarms go to `alarms` beside the counts."""

    def put(batch: DataFrame, k: int) -> None:
        spark = batch.sparkSession
        batch.groupBy(*key).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{store}/counts/v={k}")
        before = [v for v in _versions(spark, f"{store}/counts") if v < k]
        if before:
            now = spark.read.parquet(f"{store}/counts/v={k}")
            snapshot_alarms(spark.read.parquet(f"{store}/counts/v={before[-1]}"), now, key, threshold).write.mode("overwrite").parquet(f"{store}/alarms/v={k}")

    return put


def running_yields(events: DataFrame) -> DataFrame:
    """events: key, success, ts. Attempts, mean yield and last success of each key so far, for update mode."""
    return events.groupBy("key").agg(F.count("*").alias("attempts"), F.avg(F.col("success").cast("double")).alias("mean_yield"), F.max(F.when(F.col("success"), F.col("ts"))).alias("last_success"))


def finished_once(store: str, work):
    """For foreachBatch: runs `work` on the providers of a batch that no earlier batch finished, and writes what it
    returns under the batch's number: a batch that runs again, as after a failure, gives the same rows once.
    Rows: provider_id and more; work: DataFrame to DataFrame with provider_id."""

    def put(batch: DataFrame, k: int) -> None:
        spark = batch.sparkSession
        before = [v for v in _versions(spark, store) if v < k]
        if before:
            done = spark.read.parquet(*[f"{store}/v={v}" for v in before]).select("provider_id").distinct()
            batch = batch.join(done, "provider_id", "left_anti")
        work(batch).write.mode("overwrite").parquet(f"{store}/v={k}")

    return put


def registry_store(store: str):
    """For foreachBatch: session rows are added under the batch's number, and the registry of all is folded anew."""

    def put(batch: DataFrame, k: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{store}/rows/v={k}")
        rows = spark.read.parquet(*[f"{store}/rows/v={v}" for v in _versions(spark, f"{store}/rows") if v <= k])
        registry_fold(rows).write.mode("overwrite").parquet(f"{store}/registry/v={k}")

    return put


GROUPS = "group string, searches long, last long, stop_at long"


def put_saturation(at: str, floor: int, window: int, buckets: int = 16, every: int = 8):
    """For foreachBatch: rows group, seq, key of searches, all of a search in one batch; the batch form is
    operators.monitor.saturation. Keys that were seen lie in a store of deltas, and of each group its searches so far, the
    place of the last one that found a key, and where it stopped. A batch's searches are put in order by ranges, and
    groups that have stopped are left out, so that no task holds a group."""
    keys = ["group", "key"]
    seen = Store(f"{at}/seen", ("group", "key"), lambda d: d.groupBy(*keys).agg(F.min("seq").alias("seq")), buckets, every)

    def put(batch: DataFrame, k: int) -> None:
        spark = batch.sparkSession
        before = [v for v in _versions(spark, f"{at}/groups") if v < k]
        known = spark.read.parquet(f"{at}/groups/v={before[-1]}") if before else spark.createDataFrame([], GROUPS)
        rows = batch.select("group", "seq", "key").join(known.where("stop_at is not null").select("group"), "group", "left_anti")
        own = rows.where("key is not null").groupBy(*keys).agg(F.min("seq").alias("seq"))
        stored = seen.read(spark, k, own)
        fresh = cut(own if stored is None else own.join(stored.select(*keys), keys, "left_anti"))
        seen.write(fresh, k)
        seen.compact(spark, k - 1)
        each = placed(rows.select("group", "seq").distinct(), "group", "seq")
        sizes = each.groupBy("group").agg(F.max("place").alias("n")).join(known.select("group", "searches", "last"), "group", "left").fillna(0, ["searches", "last"])
        each = each.join(sizes.select("group", "searches"), "group").select("group", "seq", (F.col("place") + F.col("searches")).alias("place"))
        finds = each.join(fresh.select("group", "seq").distinct(), ["group", "seq"]).select("group", "place")
        # A run of dry searches follows each find, the last one of earlier batches, and the beginning.
        starts = finds.unionByName(sizes.select("group", F.col("last").alias("place")))
        runs = starts.withColumn("next", F.lead("place").over(Window.partitionBy("group").orderBy("place"))).join(sizes, "group")
        stop = F.greatest(F.col("place") + window, F.lit(max(1, floor)).cast("long"))
        stops = runs.where(stop < F.coalesce("next", F.col("searches") + F.col("n") + 1)).groupBy("group").agg(F.min(stop).alias("place"))
        found = stops.join(each, ["group", "place"]).select("group", F.col("seq").cast("long").alias("stop_at"))
        ends = runs.groupBy("group").agg(F.max(F.col("searches") + F.col("n")).alias("searches"), F.max("place").alias("last"))
        now = ends.join(found, "group", "left").unionByName(known.join(ends, "group", "left_anti"))
        now.select("group", F.col("searches").cast("long"), F.col("last").cast("long"), "stop_at").coalesce(1).write.mode("overwrite").parquet(f"{at}/groups/v={k}")  # a row a group

    return put


def stopped(spark: SparkSession, at: str) -> DataFrame:
    """group, stop_at of the groups that have run dry so far."""
    found = _versions(spark, f"{at}/groups")
    rows = spark.read.parquet(f"{at}/groups/v={found[-1]}") if found else spark.createDataFrame([], GROUPS)
    return rows.where("stop_at is not null").select("group", "stop_at")


def hole_machine(exhausted_at: int, days: int, exhausted_days: int):
    """For applyInPandasWithState per hole: status after each batch of attempts; the state goes when its time to live is over."""

    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        attempts, status, last = state.get if state.exists else (0, "new", None)
        filled = status == "filled"
        # A hole's rows may come in several pieces, whose order tells nothing: the latest search of all decides.
        for pdf in batches:
            attempts += int(pdf["variants"].sum())
            at = pdf["ts"].idxmax()
            if last is None or pdf["ts"][at] >= last:
                last, filled = pdf["ts"][at], bool(pdf["found"][at])
        status = "filled" if filled else "exhausted" if attempts >= exhausted_at else "searched"
        state.update((attempts, status, last))
        ttl = exhausted_days if status == "exhausted" else days
        state.setTimeoutTimestamp(max(int(last.timestamp() * 1000) + ttl * 86_400_000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"hole_id": [key[0]], "searched_at": [last], "attempts": [attempts], "status": [status]})

    return run


def hole_states_stream(attempts: DataFrame, exhausted_at: int = 6, days: int = 7, exhausted_days: int = 60) -> DataFrame:
    schema = "hole_id long, searched_at timestamp, attempts int, status string"
    kept = "attempts int, status string, searched_at timestamp"
    return attempts.withWatermark("ts", "1 hour").groupBy("hole_id").applyInPandasWithState(hole_machine(exhausted_at, days, exhausted_days), schema, kept, "update", "EventTimeTimeout")


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def read_stream(spark: SparkSession, file: str) -> DataFrame:
    """A stream over a Parquet file, or the files of its folder."""
    schema = spark.read.parquet(file).schema
    path = PurePosixPath(file)
    source = spark.readStream.schema(schema).option("pathGlobFilter", path.name)
    head = file[: len(file) - len(path.name)]
    return source.parquet(head) if not _is_folder(spark, file) else spark.readStream.schema(schema).parquet(file)


def _is_folder(spark: SparkSession, file: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()


def drain(stream: DataFrame, mode: str, key: list[str]) -> DataFrame:
    """Runs a stream over all there is, once; returns the last row of each key that it has put out."""
    spark, at = stream.sparkSession, _folder(stream.sparkSession)

    def put(batch: DataFrame, k: int) -> None:
        # The batch's number names its folder, so that a batch that runs again replaces what it wrote.
        batch.withColumn("batch", F.lit(k)).write.mode("overwrite").parquet(f"{at}/out/b={k}")

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(put).start()
    q.awaitTermination()
    out = spark.read.option("basePath", f"{at}/out").parquet(f"{at}/out/*")
    return out.groupBy(*key).agg(F.max_by(F.struct(*[c for c in stream.columns if c not in key]), "batch").alias("last")).select(*key, "last.*")


def in_files(df: DataFrame, part: Column, at: str):
    """As in_parts, with as many files a part as tasks read it: for streams that take all new files as one batch."""
    numbered = df.withColumn("__part", part)
    return lambda k: numbered.where(F.col("__part") == k).drop("__part").write.mode("append").parquet(at)


def in_parts(df: DataFrame, part: Column, at: str):
    """Puts df into the folder as one file for each part, in the order of the parts, as a source brings them in: each call
    of what it returns, with a first and a last part, adds those files."""
    numbered = df.withColumn("__part", part)

    def bring(first: int, last: int) -> None:
        for k in range(first, last + 1):
            numbered.where(F.col("__part") == k).drop("__part").coalesce(1).write.mode("append").parquet(at)

    return bring


def files_of(spark: SparkSession, at: str, schema, most: int | None = 1) -> DataFrame:
    """A stream over the folder's files, `most` a batch, the oldest first; None: all that are new."""
    source = spark.readStream.schema(schema)
    return (source if most is None else source.option("maxFilesPerTrigger", most)).parquet(at)


def run_until_dry(stream: DataFrame, mode: str, put, state: str) -> None:
    """Runs the stream over all that is there, batch by batch, from where its checkpoint left off."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(put).start().awaitTermination()


def to_batches(out: str):
    """For foreachBatch: what a batch puts out, under its number."""
    return lambda batch, k: batch.withColumn("batch", F.lit(k)).write.mode("overwrite").parquet(f"{out}/b={k}")


def run_event_counts(spark: SparkSession, file: str) -> DataFrame:
    events = read_stream(spark, file).select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    flat = event_counts(events).select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "n")
    return drain(flat, "update", ["hour", "event_type"])


def run_first_seen(spark: SparkSession, file: str) -> DataFrame:
    """user_id and the first event that brought it, in the order of the stream's ids."""
    events = read_stream(spark, file).select("user_id", "event_id")
    return drain(events.groupBy("user_id").agg(F.min("event_id").alias("first_event")), "update", ["user_id"])
