"""Streams over several batches with restarts between, against their batch forms; stores that write deltas."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catamill.operators import coverage, monitor
from catamill.streaming import jobs, state, stores

T0 = datetime(2026, 1, 1)


def files_under(path, kind):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) if f"/{kind}" in d for f in names if f.endswith(".parquet"))


def replayed(spark, tmp_path, df, parts, run, cuts):
    """Brings parts in and runs the stream from its checkpoint after each cut."""
    at = str(tmp_path / "in")
    bring = jobs.in_parts(df, F.col("part"), at)
    first = 0
    for last in cuts:
        bring(first, last)
        run(jobs.files_of(spark, at, df.drop("part").schema))
        first = last + 1
    assert first == parts


def test_yield_stop_over_batches(spark, tmp_path):
    state.use_state_store(spark)
    rnd = random.Random(1)
    rows = [(g, k, None if rnd.random() < 0.1 else f"h{min(int(rnd.expovariate(0.15)), 40 if g == 'a' else 400)}", k // 20) for g in "abc" for k in range(140)]
    df = spark.createDataFrame(rows, "`group` string, seq long, key string, part int")
    out, at = str(tmp_path / "out"), str(tmp_path / "state")
    replayed(spark, tmp_path, df, 7, lambda s: jobs.run_until_dry(state.saturation_states(s, 20, 12), "append", jobs.to_batches(out), at), [2, 4, 6])
    got = {r.group: r.stop_at for r in spark.read.parquet(f"{out}/*").collect()}
    want = {r.group: r.stop_at for r in monitor.saturation(df, "group", "seq", "key", 20, 12).collect() if r.stop_at is not None}
    assert got == want and want and len(set(want.values())) > 1


def test_holes_over_batches(spark, tmp_path):
    state.use_state_store(spark)
    rnd = random.Random(2)
    rows = [(h, T0 + timedelta(days=d, hours=rnd.randrange(20)), rnd.randint(1, 2), rnd.random() < 0.15, d // 4) for d in range(28) for h in range(12) if rnd.random() < 0.12]
    rows.append((99, T0 + timedelta(days=28), 1, False, 7))  # moves the watermark on
    rows.append((99, T0 + timedelta(days=28, hours=2), 1, False, 8))
    df = spark.createDataFrame(rows, "hole_id long, ts timestamp, variants int, found boolean, part int")
    out, at = str(tmp_path / "out"), str(tmp_path / "state")
    replayed(spark, tmp_path, df, 9, lambda s: jobs.run_until_dry(state.hole_due_states(s), "update", jobs.to_batches(out), at), [3, 6, 8])
    last = {r.hole_id: r.s for r in spark.read.parquet(f"{out}/*").groupBy("hole_id").agg(F.max_by(F.struct("searched_at", "attempts", "status"), F.struct("batch", (F.col("status") == "due").cast("int"))).alias("s")).collect()}
    states = monitor.hole_states(df)
    want = {r.hole_id: r for r in states.collect()}
    holes = df.select("hole_id").distinct()
    as_of = T0 + timedelta(days=28, hours=1)  # the last watermark
    free = {r.hole_id for r in monitor.searchable(holes, states, F.lit(as_of)).collect()}
    assert set(last) == set(want) and free and len(free) < len(want)
    for h, s in last.items():
        assert (s.searched_at, s.attempts) == (want[h].searched_at, want[h].attempts)
        assert s.status == ("due" if h in free else want[h].status), h


def test_holes_by_stores(spark, tmp_path):
    """Searches in any order, old ones behind newer ones, over batches of which one runs again: states and holes that are due
    again are those of the batch forms after every batch, and a hole is told to be due once."""
    rnd = random.Random(6)
    rows = [(h, T0 + timedelta(days=d, hours=rnd.randrange(20), seconds=h), rnd.randint(1, 2), rnd.random() < 0.15, d // 6) for d in range(30) for h in range(14) if rnd.random() < 0.12]
    rows += [(50, T0 + timedelta(days=d), 1, False, min(d, 4)) for d in range(5)] + [(50, T0 - timedelta(days=1), 1, False, 4)]  # its sixth search is older than its last
    rows += [(51, T0 + timedelta(days=1), 1, f, 0) for f in (False, True)] + [(99, T0 + timedelta(days=28, hours=k), 1, False, 4 + k) for k in range(2)]
    rnd.shuffle(rows)
    df, out = spark.createDataFrame(rows, "hole_id long, ts timestamp, variants int, found boolean, part int").repartition(3), str(tmp_path / "out")
    put = stores.put_holes(stores.hole_store(str(tmp_path / "holes"), buckets=4, every=2), out)
    for k in (0, 1, 1, 2, 3, 4, 5):
        put(df.where(F.col("part") == k), k)
        told = spark.read.parquet(f"{out}/*")
        last = {r.hole_id: r.s for r in told.groupBy("hole_id").agg(F.max_by(F.struct("searched_at", "attempts", "status"), F.struct("batch", (F.col("status") == "due").cast("int"))).alias("s")).collect()}
        states = monitor.hole_states(df.where(F.col("part") <= k).groupBy("hole_id", "ts").agg(F.sum("variants").alias("variants"), F.max("found").alias("found")))
        want = {r.hole_id: r for r in states.collect()}
        as_of = max(r.searched_at for r in want.values()) - timedelta(hours=1)
        free = {r.hole_id for r in monitor.searchable(df.where(F.col("part") <= k).select("hole_id").distinct(), states, F.lit(as_of)).collect()}
        assert {h: tuple(s) for h, s in last.items()} == {h: (r.searched_at, r.attempts, "due" if h in free else r.status) for h, r in want.items()}
        assert not told.where("status = 'due'").groupBy("hole_id", "searched_at", "attempts").count().where("count > 1").count()
    assert want[50].status == "exhausted" and free and len(free) < len(want)


def test_saturation_by_stores(spark, tmp_path):
    """Searches in any order and in pieces, over batches of which one runs again: the batch form's stops."""
    rnd = random.Random(4)
    rows = [(g, k, None if rnd.random() < 0.1 else f"h{min(int(rnd.expovariate(0.15)), 40 if g == 'a' else 400)}", k // 40) for g in "abcd" for k in range(160)]
    rows += [(g, k, f"h{k % 9}", p) for g, k, _, p in rows if k % 7 == 0]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "`group` string, seq long, key string, part int").repartition(5)
    want = {r.group: r.stop_at for r in monitor.saturation(df, "group", "seq", "key", 20, 12).collect() if r.stop_at is not None}
    assert want and len(set(want.values())) > 1
    put = jobs.put_saturation(str(tmp_path / "many"), 20, 12, buckets=4, every=2)
    for k in (0, 1, 1, 2, 3):
        put(df.where(F.col("part") == k), k)
    assert {r.group: r.stop_at for r in jobs.stopped(spark, str(tmp_path / "many")).collect()} == want
    jobs.put_saturation(str(tmp_path / "one"), 20, 12, buckets=4)(df, 0)
    assert {r.group: r.stop_at for r in jobs.stopped(spark, str(tmp_path / "one")).collect()} == want


def test_parts_are_written_by_all_tasks(spark, tmp_path):
    at = str(tmp_path / "in")
    jobs.in_files(spark.range(1000).repartition(4), F.col("id") % 2, at)(0)
    assert len([f for f in os.listdir(at) if f.endswith(".parquet")]) == 4
    assert jobs.files_of(spark, at, "id long", None).isStreaming and spark.read.parquet(at).count() == 500


def test_holes_in_pieces():
    """A hole's rows come in pieces of any order, and over batches: the latest search decides, and all are counted."""
    import pandas as pd

    class Kept:
        hasTimedOut, exists, get = False, False, None

        def update(self, value):
            self.exists, self.get = True, value

        def getCurrentWatermarkMs(self):
            return 0

        def setTimeoutTimestamp(self, ms):
            self.due = ms

    day = lambda *rows: pd.DataFrame([(pd.Timestamp(T0 + timedelta(days=d)), 1, f) for d, f in rows], columns=["ts", "variants", "found"])
    kept, run = Kept(), jobs.hole_machine(6, 7, 60)
    row = lambda pieces: [tuple(r) for df in run((1,), iter(pieces), kept) for r in df.itertuples(index=False)]
    at = lambda d: pd.Timestamp(T0 + timedelta(days=d))
    assert row([day((5, False), (9, True)), day((1, False), (3, False))]) == [(1, at(9), 4, "filled")]
    assert row([day((8, False)), day((2, False))]) == [(1, at(9), 6, "filled")]
    assert row([day((12, False)), day((10, True))]) == [(1, at(12), 8, "exhausted")]


def test_seen_keys_over_batches(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(f"k{rnd.randrange(60)}" if rnd.random() < 0.95 else "", k // 12) for k in range(120)]
    df = spark.createDataFrame(rows, "key string, part int")
    store = stores.seen_store(str(tmp_path / "seen"), buckets=8, every=3)
    put = stores.put_seen(store, F.col("key"))
    replayed(spark, tmp_path, df, 10, lambda s: jobs.run_until_dry(s, "append", put, str(tmp_path / "state")), [3, 9])
    first = {}
    for k, part in rows:
        if k:
            first.setdefault(k, part)
    assert {r.key: r.batch for r in store.read(spark).collect()} == first
    assert store._versions(spark, "base")
    before = {r.key: r.batch for r in store.read(spark).collect()}
    put(df.where("part = 9").select("key"), 9)  # the last batch runs again
    assert {r.key: r.batch for r in store.read(spark).collect()} == before
    put(df.where("part = 9").select("key"), 10)  # an old one under a new number adds nothing
    assert {r.key: r.batch for r in store.read(spark).collect()} == before


def test_page_store_writes_deltas(spark, tmp_path):
    store = stores.page_store(str(tmp_path / "pages"), buckets=4, every=3)
    put = stores.put_pages(store)
    big = [(f"https://a.org/{k}", "x" * 50 + str(k), T0) for k in range(2000)]
    page = lambda rows: spark.createDataFrame(rows, "url string, html string, ts timestamp")
    put(page(big), 0)
    size = files_under(tmp_path / "pages", "delta=0")
    newest = {u: h for u, h, _ in big}
    for k in range(1, 8):
        rows = [(f"http://www.a.org/{j}/", f"new {k} {j}", T0 + timedelta(days=k)) for j in range(k, k + 5)] + [(f"https://a.org/{k}", "older", T0 - timedelta(days=1)), ("https://a.org/1", " ", T0 + timedelta(days=99))]
        put(page(rows), k)
        newest |= {f"https://a.org/{j}": f"new {k} {j}" for j in range(k, k + 5)}
        assert files_under(tmp_path / "pages", f"delta={k}") < size / 5
    read = lambda: {r.key: r.html for r in store.read(spark).collect()}
    assert read() == newest and store._versions(spark, "base")
    # A batch that dies before its last file, and a compaction that does, leave what was there.
    for kind in ("delta=8", "base=8"):
        os.makedirs(tmp_path / "pages" / kind / "bucket=0")
        (tmp_path / "pages" / kind / "bucket=0" / "part-0.parquet").write_bytes(b"torn")
    assert read() == newest
    put(page([("https://a.org/3", "last", T0 + timedelta(days=50))]), 8)
    assert read() == newest | {"https://a.org/3": "last"}


def test_registry_is_the_fold(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(k, rnd.choice(["A", "Bb", "Ccc", "Ddd", ""]) + "x" * rnd.randrange(3), f"t{rnd.randrange(3)}", rnd.sample(["c", "d", "e", "f"], 2), rnd.choice(["", "parent_ready"]) if rnd.random() < 0.2 else "", "", f"https://h{rnd.randrange(4)}.org/{rnd.randrange(9)}", "", k // 30) for k in range(240)]
    df = spark.createDataFrame(rows, "ord long, name string, town string, categories array<string>, parent_verdict string, verdict string, register_url string, info_url string, part int")
    store = stores.registry_store(str(tmp_path / "reg"), most=3, buckets=4, every=3)
    replayed(spark, tmp_path, df, 8, lambda s: jobs.run_until_dry(s, "append", stores.put_registry(store, 3), str(tmp_path / "state")), [2, 7])
    key = lambda r: (r.host, r.name, r.town, r.categories, r.parent_ready, r.urls)
    assert sorted(map(key, stores.registry(store, spark).collect())) == sorted(map(key, coverage.registry_fold(df, 3).collect()))


def test_counts_and_resume(spark, tmp_path):
    rows = [(f"k{k % 5}", k // 10) for k in range(60)] + [("k0", 3)] * 9
    df = spark.createDataFrame(rows, "k string, part int")
    store, alarms = stores.Store(str(tmp_path / "counts"), ("k",), lambda d: d.groupBy("k").agg(F.sum("n").alias("n"))), str(tmp_path / "alarms")
    replayed(spark, tmp_path, df, 6, lambda s: jobs.run_until_dry(s, "append", stores.put_counts(store, alarms, ["k"]), str(tmp_path / "state")), [2, 5])
    got = sorted((int(r.batch), r.k, r.old_n, r.new_n) for r in spark.read.option("basePath", alarms).parquet(f"{alarms}/*").collect())
    assert got == [(3, "k0", 2, 11), (4, "k0", 11, 2)]


def test_finished_providers_after_a_crash(spark, tmp_path):
    """A stream that fails in its third batch goes on from there: each provider is worked on once."""
    rows = [(f"p{k % 7}", k // 6) for k in range(30)]
    df = spark.createDataFrame(rows, "provider_id string, part int")
    done, at, fail = str(tmp_path / "done"), str(tmp_path / "in"), [True]
    jobs.in_parts(df, F.col("part"), at)(0, 4)
    inner = jobs.finished_once(done, lambda b: b.groupBy("provider_id").agg(F.count("*").alias("n")))

    def put(batch, k):
        inner(batch, k)
        if k == 2 and fail:
            fail.clear()
            raise RuntimeError("lost")

    run = lambda: jobs.run_until_dry(jobs.files_of(spark, at, "provider_id string"), "append", put, str(tmp_path / "state"))
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    got = spark.read.parquet(f"{done}/v=*").collect()
    assert sorted(r.provider_id for r in got) == [f"p{k}" for k in range(7)]
