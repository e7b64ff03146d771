"""Extraction, linkage, coverage, evaluation, files and stream stores over small tables, against hand-worked or brute-force results."""

import math
import random

import pytest
from pyspark.sql import functions as F

from catamill.functions import dates as D
from catamill.functions import similarity as S
from catamill.operators import coverage, extract, linkage, monitor, score
from catamill.sources import catalog as files
from catamill.streaming import jobs
from tests.test_rules import frame, values

LD = """<script type="application/ld+json">{"@graph": [{"@type": "ChildrensEvent", "name": "Art Camp", "startDate": "2026-07-06T09:00", "endDate": "2026-07-10", "offers": [{"price": 200, "url": "https://a.org/r"}]},
{"@type": ["Course", "Thing"], "name": "Chess", "startDate": "2026-07-06", "endDate": "2026-07-06", "offers": {"lowPrice": "50", "priceCurrency": "CAD"}, "url": "https://a.org/c"}, {"@type": "Person", "name": "X"}]}</script>
<script type='application/ld+json'>[{"@type": "Event", "name": "Art Camp", "startDate": "2026-07-06", "endDate": "2026-07-10"}, {"@type": "Camp", "name": ""}]</script><script type="application/ld+json">{broken</script>"""


def test_structured_events(spark):
    pages = spark.createDataFrame([(1, LD), (2, '<script type="application/json">{"props": {"items": [{"title": "Robots", "start_date": "2026-07-01", "price": 5}]}}</script>'), (3, "none"), (4, None)], "page_id long, html string")
    got = {tuple(r) for r in extract.structured_events(pages).collect()}
    assert got == {
        (1, "jsonld", "Art Camp", "2026-07-06 – 2026-07-10", "$200", "https://a.org/r"), (1, "jsonld", "Chess", "2026-07-06", "CAD 50", "https://a.org/c"), (2, "state", "Robots", "2026-07-01", "5", ""),
    }
    plain = sorted((r.name, r.dates, r.price) for r in extract.structured_events(pages, plain=True).where("kind = 'jsonld'").collect())
    assert plain == [("Art Camp", "2026-07-06", ""), ("Art Camp", "2026-07-06", ""), ("Chess", "2026-07-06", "")]
    text = extract.events_summary(extract.structured_events(pages).where("page_id = 1")).first().summary
    assert text == "## STRUCTURED PROGRAMS (embedded schema.org data)\n- Art Camp | 2026-07-06 – 2026-07-10 | $200\n- Chess | 2026-07-06 | CAD 50"


def test_page_rules(spark):
    pages = spark.createDataFrame([(1, "https://a.org/fun-camp", "<h1>Fun <b>Camp</b></h1> ages 7-12, July 6 - 10"), (2, "https://a.org/x-y", "hello")], "page_id long, url string, html string")
    links = spark.createDataFrame([(1, 0, "https://a.org/about", 10), (1, 1, "https://lex.myrec.com/x", 60), (1, 2, "https://b.org/register", 40)], "page_id long, pos int, url string, score int")
    got = {r.page_id: (r.name, r.register_url, r.ages, r.dates, r.status) for r in extract.page_record(pages, links).collect()}
    assert got[1] == ("Fun Camp", "https://lex.myrec.com/x", "ages 7-12", "July 6 - 10", "ok") and got[2][0] == "X Y" and got[2][4] == "needs_js"
    parts = spark.createDataFrame([(1, 0, "heading", "A"), (1, 1, "heading", "B"), (1, 2, "link", "l1"), (1, 3, "heading", "C"), (1, 4, "link", "l2"), (1, 5, "heading", "D")], "page_id long, pos int, kind string, value string")
    assert {(r.link, r.name) for r in extract.enclosing_link(parts).collect()} == {("l1", "A"), ("l2", "C")}
    rows = [{"ord": k, "page_id": 1, "name": f"Item {k}", "dates": "July 6", "ages": ""} for k in range(9)] + [{"ord": 100 + k, "page_id": 2, "name": f"Item {k}", "dates": f"July {k}", "ages": ""} for k in range(9)]
    assert {r.page_id for r in extract.drop_menu_batches(frame(spark, rows)).collect()} == {2}
    rows = frame(spark, [{"id": k, "info_url": f"https://a.org/{p}"} for k, p in enumerate(["camps", "camps/x", "camps/x/y", "other"])])
    assert sorted(r.id for r in extract.drop_section_pages(rows).collect()) == [2, 3]
    urls = spark.createDataFrame([(f"https://a.org/courses/{k}",) for k in range(3)] + [("https://a.org/camps/1",), ("https://a.org/x",)], "url string")
    assert [(r.segment, r.n, r.rank) for r in extract.catalog_segments(urls).orderBy("rank").collect()] == [("courses", 3, 1), ("camps", 1, 2)]


# Linkage


def test_similarity():
    assert S.token_set("art camp", "camp art", "indel") == 1.0 and S.token_set("art", "art camp", "indel") == 1.0 and S.token_set("", "x", "indel") == 0.0
    assert S.indel_ratio("robotics", "robotic") == pytest.approx(14 / 15) and S.lcs_length("abcde", "ace") == 3
    rnd = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 8))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert S.lcs_length(a, b) == table[-1][-1]


@pytest.mark.parametrize("threshold", [0.92, 0.8])
def test_fuzzy_pairs(spark, threshold):
    rnd = random.Random(2)
    names = ["robotics", "robotic", "robotics camp", "camp of robots", "a", "b", "", "summer art", "sumer art"]
    for _ in range(60):
        base = list(rnd.choice(["swimming lessons", "adventure in nature", "chess masters", "creative arts studio"]))
        for _ in range(rnd.randrange(4)):
            base[rnd.randrange(len(base))] = rnd.choice("abcdefgh")
        names.append("".join(base))
    rows = [(k, k % 2, n) for k, n in enumerate(names)]
    got = {(r.a, r.b) for r in linkage.fuzzy_pairs(spark.createDataFrame(rows, "k long, block int, n string"), ["block"], "n", "k", threshold).collect()}
    want = {(a, b) for a, x, m in rows for b, y, n in rows if a < b and x == y and S.token_set(m, n, "indel") >= threshold}
    assert got == want and want


def test_dedupe_sessions(spark):
    row = {"name": "Art Camp", "register_url": "", "info_url": "", "geo_zip": "02420", "start_date": "2026-07-06", "price": ""}
    rows = [
        row | {"ord": 1, "register_url": "https://lex.myrec.com/program_details.aspx?ProgramID=7", "discovered_via": ["a"]}, row | {"ord": 2, "register_url": "https://lex.myrec.com/info/program_details.aspx?ProgramID=7&x=1", "discovered_via": ["b"], "price": "$5"},
        row | {"ord": 3, "name": "camp art", "discovered_via": ["c"]}, row | {"ord": 4, "name": "Art Camp", "geo_zip": "02421", "discovered_via": ["d"]}, row | {"ord": 5, "name": "Chess", "discovered_via": ["e"]},
        row | {"ord": 6, "register_url": "https://lex.myrec.com/program_details.aspx?ProgramID=8", "discovered_via": ["f"]},
    ]
    got = {r.ord: (sorted(r.discovered_via), r.price or "", r.n_merged) for r in linkage.dedupe_sessions(frame(spark, rows)).collect()}
    assert got == {1: (["a", "b", "c"], "$5", 3), 4: (["d"], "", 1), 5: (["e"], "", 1), 6: (["f"], "", 1)}
    rows = frame(spark, [
        {"ord": 1, "name": "Art", "register_url": "https://a.org/x", "dates": "July", "rank": 1}, {"ord": 2, "name": "Art", "register_url": "https://a.org/y", "dates": "July", "rank": 3}, {"ord": 3, "name": "Other", "register_url": "https://a.org/y", "dates": "", "rank": 2},
        {"ord": 4, "name": "Art", "register_url": "https://b.org/x", "dates": "July", "rank": 1},
    ])
    assert sorted(r.ord for r in linkage.dedupe_published(rows, F.col("rank")).collect()) == [2, 4]


# Coverage


def test_sharing_anywhere_on_the_globe(spark):
    """All pairs within reach, near the poles and over the date line too."""
    rnd = random.Random(4)
    centres = [(42.4, -71.2), (60.2, 25.0), (-75.0, 10.0), (16.5, 179.98), (89.7, 0.0), (0.0, 0.0)]
    towns = [(f"t{k:03d}", lat + rnd.uniform(-0.25, 0.25), (lon + rnd.uniform(-0.4, 0.4) / max(0.02, math.cos(math.radians(lat))) + 180) % 360 - 180) for k, (lat, lon) in enumerate(centres * 25)]
    towns = [(t, min(lat, 90.0), lon) for t, lat, lon in towns]

    def miles(a, b):
        h = math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 3958.8 * math.asin(min(1, math.sqrt(h)))

    providers = [(f"h{t}", t, ["swim", "sail"] if k % 2 else ["swim"], k % 3 > 0) for k, (t, _, _) in enumerate(towns)]
    got = {(r.town, r.category): (r.via_town, r.host) for r in coverage.shared_coverage(spark.createDataFrame(providers, "host string, town string, categories array<string>, parent_ready boolean"), spark.createDataFrame(towns, "town string, lat double, lon double"), rare=("sail",)).collect()}
    want = {}
    for a in towns:
        for h, t, cats, ready in providers:
            d = miles(a, next(x for x in towns if x[0] == t))
            for c in cats:
                if ready and d <= (15 if c == "sail" else 10) and (a[0], c) not in want:
                    want[a[0], c] = (t, h)
    assert got == want and len({a for (a, _), (t, _) in want.items() if a != t and a[1:] > '0'}) > 40


def test_categories_and_rounds(spark):
    rows = frame(spark, [{"id": 1, "name": "Water Polo fun", "platform": "", "register_url": ""}, {"id": 2, "name": "Basketball"}, {"id": 3, "name": "Painting"}, {"id": 4, "name": "Lego"}, {"id": 5, "name": "x"}])
    assert {r.id: r.c for r in rows.select("id", coverage.one_category(rows, ("water_polo", "chess")).alias("c")).collect()} == {1: "water_polo", 2: "sports", 3: "arts", 4: "stem", 5: None}
    assert values(spark, coverage.demand_prior(F.col("x")), ["core", "standard", "long_tail"]) == [8, 6, 3]
    sessions = frame(spark, [{"categories": ["chess"], "parent_verdict": "unverified", "register_url": "https://a.org/1", "source_url": ""}])
    found = frame(spark, [{"categories": ["chess"], "parent_verdict": "parent_ready", "register_url": u, "source_url": ""} for u in ("https://a.org/1", "https://b.org/2", "https://b.org/2", "")])
    cats = spark.createDataFrame([("chess", "core")], "category string, tier string")
    hosts = spark.createDataFrame([("b.org",), ("c.org",)], "host string")
    both, holes = coverage.fill_round(sessions, found, cats, hosts, F.lit("Lex"))
    assert both.count() == 2 and sorted(r.hole_id for r in holes.collect()) == ["missing_provider_c_org"]
    assert tuple(coverage.coverage_score(both).first()) == (1, 2, 0.5)
    holes = spark.createDataFrame([("a", "chess"), ("a", "swim"), ("b", "chess")], "town string, category string")
    shared = spark.createDataFrame([("a", "chess", "b"), ("b", "chess", "b")], "town string, category string, via_town string")
    assert {(r.town, r.category): r.covered_via for r in coverage.searchable_holes(holes, shared).collect()} == {("a", "chess"): "b", ("a", "swim"): None, ("b", "chess"): None}


def test_saturation(spark):
    """Against the plain walk over each group's events."""
    rnd = random.Random(7)
    rows = [(f"g{g}", seq, None if rnd.random() < 0.2 else rnd.randrange(3 + 6 * g)) for g in range(5) for seq in sorted(rnd.sample(range(1, 400), 120))]
    got = {r.g: (r.stop_at, r.searches) for r in monitor.saturation(spark.createDataFrame(rows, "g string, seq long, key int").repartition(4), "g", "seq", "key", 15, 8).collect()}
    for g in range(5):
        seen, dry, stop = set(), 0, None
        own = [r for r in rows if r[0] == f"g{g}"]
        for place, (_, seq, key) in enumerate(own, 1):
            dry = 0 if key is not None and key not in seen else dry + 1
            seen.add(key)
            if stop is None and place >= 15 and dry >= 8:
                stop = seq
        assert got[f"g{g}"] == (stop, len(own))


# Evaluation


def test_baselines(spark):
    row = lambda n, u, v="": {"name": n, "register_url": u, "source_url": "", "parent_verdict": v}
    base = frame(spark, [row("Art Camp", "https://a.org/1"), row("Art Camp", "https://a.org/2"), row("Robotics Week", "https://a.org/3"), row("Chess", "https://b.org/4"), row("Sailing", "https://c.org/5")])
    pub = frame(spark, [row("Art", "https://a.org/9"), row("Robotics Weeks", "https://a.org/8"), row("Else", "https://b.org/4", "off_season"), row("New", "https://d.org/1")])
    got = {r.norm: (r.exact, r.by_url, r.fuzzy) for r in score.match_baseline(base, pub).collect()}
    assert got == {"art": (True, False, True), "robotics": (False, False, True), "chess": (False, True, True), "sailing": (False, False, False)}
    hosts = spark.createDataFrame([("a.org",), ("b.org",), ("c.org",)], "host string")
    r = score.score_baseline(base, pub, hosts).first()
    assert (r.programs, r.sessions, r.published, r.providers) == (4, 5, 4, 3)
    assert (r.recall_strict, r.recall_fuzzy, r.session_recall, r.precision, r.providers_covered) == (0.5, 0.75, 0.2, 0.5, 0.6667)
    empty = score.score_baseline(base.limit(0), pub.limit(0), hosts.limit(0)).first()
    assert (empty.recall_strict, empty.precision, empty.providers_covered) == (0.0, 0.0, 0.0)


def test_scoring(spark):
    truth = spark.createDataFrame([(1, "a.org", "Art Camp", "July 6-10"), (2, "a.org", "Chess Camp", ""), (3, "sub.b.org", "Sailing", ""), (4, "old.com", "Robots", "")], "gt int, provider_host string, program_name string, session_dates string")
    pub = spark.createDataFrame([(1, "www2.a.org", "Art Camp week 2", "2026-07-06"), (2, "b.org", "Sailing", ""), (3, "new.com", "Robots", ""), (4, "xa.org", "Chess Camp", "")], "pub int, host string, name string, dates string")
    aliases = spark.createDataFrame([("new.com", "old.com")], "alt_host string, provider_host string")
    assert {(r.gt, r.pub, r.dates_meet) for r in score.match_programs(truth, pub, aliases).collect()} == {(1, 1, True), (3, 2, False), (4, 3, False)}
    r = score.score_run(truth, pub, aliases).first()
    assert (r.program_recall, r.session_recall, r.precision) == (0.75, 1.0, 0.75)
    pages = spark.createDataFrame([("u1", "Art Camp " + "x" * 500), ("u2", "Art Camp")], "url string, text string")
    rows = frame(spark, [{"name": "Art Camp", "info_url": u} for u in ("u1", "u2", "u3", "")])
    assert tuple(score.info_validity(rows, pages).first()) == (4, 1, 0.25)
    assert {tuple(r) for r in score.compare_metrics(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "m string, v double"), spark.createDataFrame([("a", 3.0)], "m string, v double")).collect()} == {("a", 1.0, 3.0, 2.0), ("b", 2.0, None, None)}


def test_dates(spark):
    texts = ["July 6 - 10, 2026", "10/3/2026", "2026-07-06", "summer 2026", "June-July", "", None, "Sept 5"]
    assert values(spark, D.starts_in_summer(F.col("x")), texts) == [True, False, False, True, True, False, False, False]
    assert [str(x) for x in values(spark, D.first_date(F.col("x"), 2026), texts)] == ["2026-07-06", "2026-10-03", "2026-07-06", "None", "None", "None", "None", "2026-09-05"]
    got = values(spark, D.date_span(F.col("x"), 2026), ["July 6-10, 2026 and 8/1", "2026-07-06", "none"])
    assert [v and (str(v["first"]), str(v["last"])) for v in got] == [("2026-07-06", "2026-08-01"), ("2026-07-06", "2026-07-06"), None]
    got = values(spark, D.day_window(F.col("x")), ["July 6 to Aug 2", "13/40", "7/6/26", "2026-07-06"])
    assert [v and (v["lo"], v["hi"]) for v in got] == [(223, 250), None, (223, 223), (223, 223)]


# Files


def test_files(spark, tmp_path):
    entries = frame(spark, [{"name": "A", "host": "A.org", "vendor": "myrec", "seed": "https://a.org"}, {"name": "", "host": "b.org", "vendor": "odd", "seed": "x"}, {"name": "C", "host": "c.org", "vendor": "viking", "seed": "http://c.org"}, {"name": "C2", "host": "c.org", "vendor": "viking", "seed": "http://c.org"}])
    good, broken = files.load_registry(entries)
    assert [r.host for r in good.collect()] == ["a.org"] and sorted((r.key, r.rule) for r in broken.collect()) == [("b.org", "absolute seed"), ("b.org", "name"), ("b.org", "vendor"), ("c.org", "unique host")]
    towns = frame(spark, [{"town": "a", "zip": "02420", "state": "ma"}, {"town": "b", "zip": "02801", "state": "MA"}, {"town": "c", "zip": "", "state": "NH"}, {"town": "a", "zip": "02420", "state": "MA"}])
    assert sorted((r.key, r.rule) for r in files.town_violations(towns).collect()) == [("a", "unique town"), ("b", "zip band"), ("c", "state"), ("c", "zip")]
    assert [tuple(r) for r in files.gap_violations(frame(spark, [{"provider_id": "p", "reason": "empty"}, {"provider_id": "q", "reason": "odd"}])).collect()] == [("q", "reason")]
    tables = {n: frame(spark, [{"provider_id": "p", "program_id": "g", "session_id": "s", "name": 'A "b", c\nd', "fetched_at": "2026-07-06 10:00:00", "content_chars": "12"}]) for n in files.LAYOUT}
    assert files.write_layout(tables, str(tmp_path / "one")) == dict.fromkeys(files.LAYOUT, 1)
    back = files.read_layout(spark, str(tmp_path / "one"))
    r = back["sessions"].first()
    assert r.name == 'A "b", c\nd' and r.content_chars == 12 and r.fetched_at.hour == 10 and r.price == "" and back["gaps"].first().reason == ""
    frame(spark, [{"name": "x", "info_url": "", "register_url": "https://www.b.org/x"}, {"name": " ", "info_url": "https://c.org", "register_url": ""}]).write.options(**files.CSV).csv(str(tmp_path / "pub"))
    assert [(r.name, r.host) for r in files.read_published(spark, str(tmp_path / "pub")).collect()] == [("x", "b.org")]
    grid = files.upsert_town(None, spark.createDataFrame([("art", "a", "1"), ("art", "b", "2")], "category string, town string, value string"))
    grid = files.upsert_town(grid, spark.createDataFrame([("swim", "a", "3")], "category string, town string, value string"))
    assert sorted(tuple(r) for r in files.wide_grid(grid, ["a", "b"]).collect()) == [("art", "", "2"), ("swim", "3", "")]


# Stream stores


def test_stream_stores(spark, tmp_path):
    page = lambda *rows: spark.createDataFrame(rows, "url string, html string, ts timestamp")
    from datetime import datetime as t

    put = jobs.latest_pages(str(tmp_path / "pages"))
    put(page(("https://a.org/x", "one", t(2026, 1, 1)), ("https://a.org/y", " ", t(2026, 1, 1))), 0)
    put(page(("http://www.a.org/x/", "two", t(2026, 1, 2)), ("https://b.org", "b", t(2026, 1, 9))), 1)
    put(page(("https://a.org/x", "late", t(2025, 1, 2))), 2)
    put(page(("https://a.org/x", "late", t(2025, 1, 2))), 2)  # a batch that runs again
    got = jobs.stored_pages(spark, str(tmp_path / "pages"))
    assert sorted(r.html for r in got.collect()) == ["b", "two"]
    assert [r.html for r in jobs.stored_pages(spark, str(tmp_path / "pages"), F.lit(t(2026, 1, 10)), 7).collect()] == ["b"]
    assert jobs.stored_pages(spark, str(tmp_path / "none")) is None
    put = jobs.counts_alarms(str(tmp_path / "counts"), ["k"])
    for k, batch in enumerate((["a"] * 10 + ["b"] * 4, ["a"] * 9 + ["b"] * 1)):
        put(spark.createDataFrame([(x,) for x in batch], "k string"), k)
    assert [(r.k, r.old_n, r.new_n) for r in spark.read.parquet(str(tmp_path / "counts" / "alarms" / "v=1")).collect()] == [("b", 4, 1)]
    put = jobs.finished_once(str(tmp_path / "done"), lambda df: df.withColumn("n", F.lit(1)))
    for k, batch in enumerate((["p1", "p2"], ["p2", "p3"], ["p2", "p3"])):
        put(spark.createDataFrame([(x,) for x in batch], "provider_id string"), min(k, 1))
    assert sorted(r.provider_id for r in spark.read.parquet(str(tmp_path / "done" / "v=*")).collect()) == ["p1", "p2", "p3"]
    put = jobs.registry_store(str(tmp_path / "reg"))
    row = lambda o, n, u: {"ord": o, "name": n, "town": "t", "categories": ["c"], "parent_verdict": "", "verdict": "", "register_url": u, "info_url": ""}
    put(frame(spark, [row(1, "A", "https://a.org/1")]), 0)
    put(frame(spark, [row(2, "A long", "https://a.org/2"), row(3, "B", "https://b.org")]), 1)
    assert {r.host: (r.name, len(r.urls)) for r in spark.read.parquet(str(tmp_path / "reg" / "registry" / "v=1")).collect()} == {"a.org": ("A long", 2), "b.org": ("B", 1)}


# Nested values and raw pages


def test_baseline_works_addresses_out_once_in_many_tasks(spark):
    """Rows of one task are dealt out before their addresses are worked out, and no later step works them out again."""
    rows = [(f"Chess {k}", f"https://A.org/{k // 2}?b=1&utm_x=2", "https://b.org/", "off_season" if k % 5 == 0 else "") for k in range(40)]
    one = spark.createDataFrame(rows, "name string, register_url string, source_url string, parent_verdict string").coalesce(1)
    kept = score._program_rows(one)
    assert kept.rdd.getNumPartitions() > 1 and sorted(tuple(r) for r in kept.collect()) == sorted(("a.org", f"chess {k}", f"https://a.org/{k // 2}?b=1") for k in range(40))
    out = score.score_baseline(one, one.where("name <> 'Chess 1'"), spark.createDataFrame([("a.org",), ("c.org",)], "host string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "register_url" not in plan and "source_url" not in plan
    r = out.first()
    assert (r.programs, r.sessions, r.published, r.providers, r.recall_strict, r.session_recall, r.precision, r.providers_covered) == (40, 40, 39, 2, 1.0, 1.0, round(31 / 39, 4), 0.5)


def test_state_events_walk_any_nesting(spark):
    """The native walk gives what the walk over parsed lists gives."""
    state = [
        '{"a": [{"b": {"name": " One ", "startDate": "2026-07-06T09:00", "endDate": "2026-07-10", "price": 5, "url": "https://a.org"}}, [{"title": "Two", "start_date": "2026-08-01"}]], "name": "no start"}',
        '{"name": "one", "startsAt": "2026-07-06", "endsAt": "2026-07-10"}', '{"name": 7, "startDate": "2026-07-06"}', '{torn', '[]', '{"title": "Deep", "startDate": "2026-01-01", "x": {"y": {"z": [{"w": {"name": "Deeper", "startDate": "2026-02-02"}}]}}}',
    ]
    html = "".join(f'<script type="application/json">{x}</script>' for x in state)
    pages = spark.createDataFrame([(1, html), (2, html + html), (3, None), (4, "<p>none</p>")], "page_id long, html string")
    got = sorted(tuple(r) for r in extract.embedded_state_events(pages).collect())
    want = sorted((r.page_id, r.name, r.dates, r.price, r.register_url) for r in extract.structured_events(pages).where("kind = 'state'").collect())
    assert got == want and len(got) == 8
    assert extract.embedded_state_events(pages.where("page_id > 2")).count() == 0


def test_walk_parses_once_and_asks_no_schema_of_what_is_inside(spark, monkeypatch):
    """Each text is parsed once, nodes are told apart by their own kind, and nothing behind nulls or empty arrays is lost."""
    plans = []
    monkeypatch.setattr(extract, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df.localCheckpoint())
    texts = ['[null, {"a": 1}]', '[[], [null, [{"b": {}}]], "x", 1]', '{"c": null, "d": [true, {"e": [2]}]}', "null", "7", '"{}"', "[]", "{}", "{torn", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = sorted((r.id, r.place, r.node) for r in extract.json_objects(rows, "id", "t").select("id", "place", F.to_json("node").alias("node")).collect())
    assert got == [(0, [0, 1], '{"a":1}'), (1, [0, 1, 1, 0], '{"b":{}}'), (1, [0, 1, 1, 0, 0], "{}"), (2, [0], '{"c":null,"d":[true,{"e":[2]}]}'), (2, [0, 1, 1], '{"e":[2]}'), (7, [0], "{}")]
    assert plans[0].lower().count("parsejson") + plans[0].lower().count("parse_json") == 1 and not any("schemaofvariant" in p.lower().replace("_", "") for p in plans)


def test_nested_payloads(spark):
    rows = spark.createDataFrame([(1, '{"n": "a", "os": [{"k": 1, "ls": [{"q": 2}, {"q": 3}]}, {"k": 2, "ls": []}, {"k": 3}]}'), (2, '{"n": "b", "os": []}'), (3, "{torn"), (4, None)], "id long, j string")
    got = [tuple(r) for r in extract.flatten_nested(rows, "j", "n string, os array<struct<k: long, ls: array<struct<q: long>>>>", ["os", "ls"]).collect()]
    assert got == [(1, "a", 1, 2), (1, "a", 1, 3)]


def test_heading_programs(spark):
    link = "https://www.hisawyer.com/org/schedules/activity-set/"
    html = (
        f"<h2>Art <b>Club</b>\n Gr. K-2</h2> <h3>Stay connected</h3><a href='{link}11'>go</a><h1> </h1><h4>{'x' * 71}</h4><h5>Small</h5><H2 class=x>Chess</H2><p>hisawyer.com/org/schedules/activity-set/12</p>"
        f"<h2>Again</h2><a href='{link}11'>go</a><h2><a href='{link}13'>Inside</a></h2><h2>Last</h2>"
    )
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<h2>Only</h2>")], "page_id long, html string")
    got = sorted(tuple(r) for r in extract.heading_programs(pages).collect())
    assert got == [(1, "11", "Art Club Gr. K-2", link + "11", "Gr. K-2"), (1, "12", "Chess", link + "12", ""), (1, "13", "Inside", link + "13", "")]


@pytest.mark.parametrize("turned", [False, True])
def test_equal_events_by_price(spark, tmp_path, turned):
    """Orders of one customer, name and day at different prices: the SQL's lowest is taken, whatever order rows come in."""
    import duckdb

    from catamill.plans import ORACLES, QUERIES

    rows = [(k, 1, "O", 1.0, "1996-01-02", "1-URGENT") for k in (2, 6, 10, 14, 18)] + [(3, 2, "P", 1.0, "1996-01-02", "1-URGENT")]
    o = spark.createDataFrame(rows[::-1] if turned else rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string")
    o.withColumn("o_orderdate", F.to_date("o_orderdate")).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    got = QUERIES["structured_events_orders"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == sorted(c.sql(ORACLES["structured_events_orders"]).project(", ".join(got.columns)).fetchall())


def test_published_links_alone(spark, monkeypatch):
    """Rows that share no key bring no edge; linked ones keep the best, the first among equals, and rows without rank last."""
    from catamill.operators import graph

    met, inner = [], graph.components
    monkeypatch.setattr(graph, "components", lambda edges: met.extend(tuple(r) for r in edges.collect()) or inner(edges))
    rows = [(k, f"n{k}", f"https://lex.myrec.com/info/program_details.aspx?ProgramID={k // 3 if k < 6 else k}", "", {0: 2.0, 1: 5.0, 2: 5.0, 4: 1.0}.get(k)) for k in range(9)]
    df = spark.createDataFrame(rows, "ord long, name string, register_url string, dates string, r double")
    out = linkage.dedupe_published(df, F.col("r"))
    assert out.columns == df.columns and sorted(r.ord for r in out.collect()) == [1, 4, 6, 7, 8]
    assert sorted(met) == [(1, 0), (2, 0), (4, 3), (5, 3)]
