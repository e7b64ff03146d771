"""Rule chains, hosts, places, verdicts and records over literal rows, each result worked out by hand."""

import pytest
from pyspark.sql import functions as F

from catamill.functions import dates as D
from catamill.functions import hosts as H
from catamill.functions import texts as T
from catamill.functions import urls as U
from catamill.operators import gates, geo, links, records, relevance, reports, signals, verdicts


def values(spark, column, rows, schema="x string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.withColumn("__k", F.monotonically_increasing_id()).coalesce(1).orderBy("__k").select(column).collect()]


def frame(spark, rows):
    """Rows of dicts as texts, missing keys blank; booleans, ints and lists keep their types."""
    names = list(dict.fromkeys(k for r in rows for k in r))
    kind = {k: next((v for r in rows if (v := r.get(k)) is not None), "") for k in names}
    types = {k: "boolean" if isinstance(v, bool) else "long" if isinstance(v, int) else "array<string>" if isinstance(v, list) else "string" for k, v in kind.items()}
    blank = lambda k: "" if types[k] == "string" else None
    return spark.createDataFrame([tuple(r.get(k, blank(k)) for k in names) for r in rows], ", ".join(f"`{k}` {types[k]}" for k in names))


# Addresses


def test_register_urls(spark):
    rows = [
        ("https://www.X.myvscloud.com/webtrac/web/iteminfo.html?Module=AR&FMID=12&_csrf_token=a&utm_source=b", "webtrac"), ("http://lex.myrec.com/info/activities/program_details.aspx?ProgramID=30025&x=1", ""),
        ("https://a.org/register?sid=9&week=2&fbclid=1", ""), ("", ""), ("/relative/", ""),
    ]
    got = values(spark, U.canonical_register_url(F.col("u"), F.col("p")), rows, "u string, p string")
    assert got == ["https://x.myvscloud.com/webtrac/web/iteminfo.html?FMID=12&Module=AR", "https://lex.myrec.com/info/activities/program_details.aspx?ProgramID=30025", "https://a.org/register?week=2", "", "/relative/"]
    ids = values(spark, U.register_platform_id(F.col("x")), [got[0], got[1], got[2]])
    assert ids == ["x.myvscloud.com|fmid|12", "lex.myrec.com|programid|30025", ""]
    rows = [("https://register.configio.com/pd/9912/x", ""), ("https://skyhawks.com/a", "SSA 12345 SSA12345"), ("https://www.invent.org/program-search/camp-invention/ma/M123", ""), ("https://apm.activecommunities.com/lex/activity/search/551", ""), ("", "")]
    assert values(spark, U.stable_id(F.col("u"), F.col("c")), rows, "u string, c string") == ["configio|pd|9912", "configio|course|SSA12345", "camp_invention|ma|M123", "activenet|activity|551", ""]


def test_registered_domains(spark):
    hosts = ["a.b.example.co.uk", "co.uk", "www.example.com:80", "lex.k12.ma.us", "x.lex.k12.ma.us", "town.lexington.ma.us", "localhost", "", "10.0.0.1:80", "shop.com.br", "a.org"]
    assert values(spark, U.registered_domain(F.col("x")), hosts) == ["example.co.uk", "co.uk", "example.com", "lex.k12.ma.us", "lex.k12.ma.us", "lexington.ma.us", "localhost", "", "10.0.0.1", "shop.com.br", "a.org"]


def test_priorities_and_classes(spark):
    urls = ["https://x.myvscloud.com/webtrac/web/search.html?type=camp&module=AR", "https://lex.myrec.com/program_details.aspx?ProgramID=1", "https://a.org/about"]
    assert values(spark, U.registration_priority(F.col("x")), urls) == [65, 25, 0]
    got = values(spark, U.page_class(F.col("x"), H.GUIDE_DOMAINS), ["https://www.macaronikid.com/x", "https://lex.myrec.com/", "https://town.gov/parks", "https://town.gov/x", "https://a.org/Summer-Camps", "https://a.org/class/x", "https://a.org/list", "https://a.org/x"])
    assert got == ["guide", "directory", "directory", "unknown", "directory", "camp", "directory", "unknown"]
    assert values(spark, H.candidate_score(F.col("u"), F.col("t")), [("https://a.org/camps/x", "Summer Camp - register"), ("https://a.org/login", "camp"), ("https://a.org/x", "after care camp"), ("https://a.org/zoo", "x")], "u string, t string") == [7, 0, 0, 0]
    assert values(spark, H.directory_score(F.col("x")), ["https://a.org/", "https://a.org/category/blog/x", "https://a.org/recreation", "https://daycamp.org/summer-camps/"]) == [50, 200, -20, -80]
    assert values(spark, H.locality_score(F.col("u"), F.col("t")), [("https://burlingtonma.myrec.com", "Burlington"), ("https://burlingtonvt.gov", "Burlington"), ("https://burlington.org", "Burlington"), ("https://x.org", "")], "u string, t string") == [4, 0, 2, 0]
    assert values(spark, H.is_camp_host(F.col("x")), ["https://a.org/summer-camps", "https://campx.org/", "https://a.org/", "", "https://myrec.com/program_details.aspx"]) == [True, True, False, False, True]
    assert values(spark, H.is_rec_center(F.col("x")), ["https://www.ymca.org/x", "https://town.gov", "https://a.org"]) == [True, True, False]
    assert values(spark, H.url_triage(F.col("x")), ["https://a.org/x.pdf", "https://a.org/summer-camp", "https://town.gov/x", "https://a.org/x"]) == ["auto_drop", "high_confidence", "needs_review", "plain"]
    assert values(spark, H.is_blocked(F.col("x")), ["https://mail.google.com/x", "https://www.facebook.com", "https://a.org"]) == [True, True, False]
    assert values(spark, H.matches_hosts(F.col("x"), ["lexington"]), ["https://rec.lexingtonma.gov/x", "https://a.org/lexington/y", "https://a.org"]) == [True, True, False]


def test_camp_links(spark):
    rows = [
        ("https://a.org/summer-camp", ""), ("https://a.org/x", "Art class"), ("https://a.org/about/", "camp"), ("https://x.myvscloud.com/webtrac/cart", "camp"), ("https://x.myvscloud.com/webtrac/search.html?type=camp", ""),
        ("mailto:a@b.c", "camp"), ("https://facebook.com/camp", "camp"), ("", "camp"), ("https://lex.communityed.org/class-category/x", "summer"), ("https://lex.communityed.org/class/pottery", "Pottery"),
        ("https://lex.communityed.org/class/kids-pottery", "Kids camp"),
    ]
    assert values(spark, H.is_camp_link(F.col("u"), F.col("t")), rows, "u string, t string") == [True, True, False, False, True, False, False, False, False, False, True]
    rows = [("https://macaronikid.com/x", "https://a.org/programs", ""), ("https://macaronikid.com/x", "https://macaronikid.com/register", ""), ("https://macaronikid.com/x", "https://yelp.com/camp", ""), ("https://macaronikid.com/x", "https://a.org/zoo", "x")]
    assert values(spark, H.is_external_lead(F.col("g"), F.col("u"), F.col("t")), rows, "g string, u string, t string") == [True, False, False, False]


def test_fingerprints(spark):
    seeds = spark.createDataFrame([("https://town.gov",), ("https://lex.myrec.com/info",), ("https://x.org",)], "seed string")
    found = spark.createDataFrame([("https://town.gov", 0, "https://a.org"), ("https://town.gov", 1, "https://myapm.hisawyer.com/studio-a/x"), ("https://town.gov", 2, "https://b.daxko.com")], "seed string, pos int, url string")
    got = {r.seed: tuple(r)[1:] for r in H.fingerprint(seeds, found).collect()}
    assert got == {"https://town.gov": ("sawyer", "studio-a", "https://myapm.hisawyer.com/studio-a/x"), "https://lex.myrec.com/info": ("myrec", "lex", "https://lex.myrec.com/info"), "https://x.org": ("unknown", "", "")}
    assert values(spark, H.platform_type(F.col("x")), ["https://x.myvscloud.com/a", "https://a.org/program_details.aspx", "https://lex.communityed.org", "https://a.org/product/x", "https://a.org"]) == ["webtrac", "myrec", "community_ed", "woocommerce", "generic"]
    assert values(spark, H.is_session_url(F.col("x")), ["https://a/iteminfo.html?fmid=1", "https://a/program_details.aspx?ProgramID=2", "https://a/program_details.aspx", "https://lex.communityed.org/class/x", "https://a.org/class/x", "https://a.org/product/y/"]) == [True, True, False, True, False, True]
    hosts = frame(spark, [{"h": "cs.mit.edu"}, {"h": "www2.lexhs.org"}, {"h": "x.k12.ma.us"}, {"h": "artacademy.com"}, {"h": "a.org"}, {"h": "prep.sub.lexhs.org"}])
    dim = spark.createDataFrame([("lexhs.org", "public"), ("sub.lexhs.org", "private")], "host string, kind string")
    assert {r.h: r.institution for r in H.institution_kind(hosts, "h", dim).collect()} == {"cs.mit.edu": "college", "www2.lexhs.org": "public", "x.k12.ma.us": "public", "artacademy.com": "private", "a.org": None, "prep.sub.lexhs.org": "private"}
    seeds = spark.createDataFrame([("https://a.org",), ("https://b.org",), ("https://c.org",)], "seed string")
    found = spark.createDataFrame([("https://a.org", 0, "https://a.org/signup"), ("https://a.org", 1, "https://lex.myrec.com/x"), ("https://b.org", 0, "https://b.org/zoo"), ("https://b.org", 1, "https://b.org/sign-up"), ("https://c.org", 0, "https://d.org/sign-up")], "seed string, pos int, url string")
    assert {tuple(r) for r in H.best_register_url(seeds, found).collect()} == {("https://a.org", "https://lex.myrec.com/x"), ("https://b.org", "https://b.org/sign-up"), ("https://c.org", "https://c.org")}


def test_platforms(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://lex.communityed.org/x", ""), (2, "https://www.ymcaboston.org", ""), (3, "https://a.org", ""), (4, "https://b.org", "<script src=hisawyer.js>"),
            (5, "https://c.org", "see https://www.daxko.com/x"), (6, "https://d.org", ""), (7, "https://e.org", ""), (8, "https://f.org", "made with Squarespace"), (9, "https://g.org", "/wp-content/x"), (10, "https://h.org", ""),
        ],
        "page_id long, url string, html string",
    )
    found = [(3, "https://x.org"), (3, "https://lex.myrec.com/a"), (7, "https://e.org/shop/")] + [(6, f"https://d.org/courses/robot-{k}") for k in range(8)] + [(10, f"https://h.org/courses/robot-{k}") for k in range(4)]
    got = {r.page_id: r.platform for r in H.platforms(pages, spark.createDataFrame(found, "page_id long, url string")).collect()}
    assert got == {1: "community_ed", 2: "ymca", 3: "myrec", 4: "sawyer", 5: "daxko", 6: "catalog_grid", 7: "woocommerce", 8: "squarespace", 9: "wordpress", 10: "custom"}


# Places


def test_places(spark):
    got = values(spark, geo.venue(F.col("x")), ["Hall, 1 Main St, Lexington, MA 02420", "Nashua, New Hampshire", "Somewhere 02421-1234", "", None, "Boston, Massachusetts"])
    assert [tuple(v) for v in got] == [("Lexington", "MA", "02420"), ("", "NH", ""), ("", "MA", "02421"), ("", "", ""), ("", "", ""), ("Boston", "MA", "")]
    assert values(spark, geo.state_code(F.col("x")), ["ma", "New York", "", None, "Narnia", "zz"]) == ["MA", "NY", "", "", "", "ZZ"]
    rows = [
        ("https://www.burlingtonnc.gov/x", "", ""), ("https://rec.vt.gov", "", ""), ("https://a.nj.myrec.com/", "", ""), ("https://find.acacamps.org/x", "", ""), ("https://www.burlingtony.org", "", ""),
        ("https://a.org", "Camp in Stowe, Vermont", ""), ("https://a.org", "Camp in Stowe, Vermont", "and Lexington, MA"), ("https://a.org", "", "Greater Pittsburgh fun"), ("https://a.org", "Lexington", ""), ("", "x, Vermont", ""),
    ]
    assert values(spark, geo.out_of_state(F.col("u"), F.col("t"), F.col("s")), rows, "u string, t string, s string") == [
        "out-of-state municipal host (.nc.gov)", "out-of-state municipal host (.vt.gov)", "out-of-state MyRec host (.nj.myrec.com)", "national camp index (not a local provider)",
        "out-of-state host (burlingtony.org)", "location text (Vermont)", None, "Greater Pittsburgh", None, None,
    ]
    towns = spark.createDataFrame([("Lexington", "02420"), ("Concord", "01742")], "town string, zip string")
    rows = frame(spark, [{"id": 1, "venue": "Field, Concord, MA 02420"}, {"id": 2, "venue_city": "Nashua", "venue_state": "New Hampshire"}, {"id": 3, "venue": "Hall, Concord, MA"}, {"id": 4}])
    got = {r.id: (r.geo_town, r.geo_state, r.geo_keep, r.geo_reject) for r in geo.tag_venues(rows, towns).collect()}
    assert got == {1: ("Lexington", "MA", True, None), 2: ("", "NH", False, "venue not MA (NH)"), 3: ("Concord", "MA", True, None), 4: ("", "", False, "venue not MA (unknown)")}
    rows = frame(spark, [{"name": "Camp", "register_url": "https://waltham.org", "info_url": ""}, {"name": "Camp at 0245", "register_url": "", "info_url": ""}, {"name": "x", "register_url": "", "info_url": ""}])
    assert [r.local for r in geo.local_first(rows, "Waltham", "0245").collect()] == [True, True, False]
    assert values(spark, gates.other_state(F.col("x")), ["https://a.org/locations/new-hampshire/x", "https://a.org/nc/x", "https://a.org/ma/x", "https://a.org/nc/1"]) == [True, True, False, False]


# Gates


def test_noncamp(spark):
    rows = [
        ("Camp Counselor", "", "", "", False), ("Swim lessons", "", "", "", False), ("Swim lessons camp", "", "", "", False), ("Summer Camp Newsletter", "", "", "", False), ("Camp", "https://a.org/careers/x", "", "", False),
        ("ESL program", "", "", "", False), ("Learning Center", "", "", "", False), ("Learning Center", "", "", "", True), ("Camp X", "", "", "", True),
    ]
    got = values(spark, gates.noncamp_reason(F.col("n"), F.col("i"), F.col("r"), F.col("p"), F.col("s")), rows, "n string, i string, r string, p string, s boolean")
    assert got == ["job", "lessons", None, "resource page", "job", "school service", "year-round childcare", None, None]


LONG = " Join us for a day of games, arts and sports with our friendly team on the green field." * 6


def test_publish_gate(spark):
    base = {"program_name": "Adventure Camp", "provider_name": "Lex Rec", "name": "Adventure Camp", "info_url": "https://a.org/camp", "register_url": "https://lex.myrec.com/x", "dates": "July 6-10", "ages": "ages 7-12", "price": "$200", "camp_scoped": False}
    rows = [
        base | {"id": 1}, base | {"id": 2, "info_url": "https://a.org/none"}, base | {"id": 3, "info_url": "https://a.org/short"}, base | {"id": 4, "name": "Read more", "program_name": "Read more"},
        base | {"id": 5, "register_url": "https://b.org/locations/vermont/x"}, base | {"id": 6, "dates": "October 3-7"}, base | {"id": 7, "ages": "18+"}, base | {"id": 8, "dates": "", "ages": "", "price": ""},
        base | {"id": 9, "name": "Pottery Wheel Week", "program_name": "Pottery Wheel Week"}, base | {"id": 10, "name": "Summer Camp", "program_name": "Summer Camp", "info_url": "https://a.org/generic"},
    ]
    pages = spark.createDataFrame([(f"https://a.org/{k}", t) for k, t in (("camp", "Adventure Camp for kids." + LONG), ("short", "Adventure Camp"), ("generic", "Summer camp for kids." + LONG))] + [("https://lex.myrec.com/x", "Summer camp, $200. Register now: add to cart")], "key string, text string")
    s = frame(spark, rows)
    got = {r.id: r for r in gates.publish_gate(s, pages).collect()}
    assert (got[1].status, got[1].verdict, got[1].evidence) == ("published", "parent_ready", None)
    assert (got[2].status, got[2].reason, got[2].evidence) == ("gap", "empty", "info page not fetched")
    assert got[3].evidence == "info page too short" and got[4].evidence == "program: chrome name" and got[5].evidence == "out of state"
    assert got[6].evidence == "off-season dates" and got[7].evidence == "adult evidence" and got[9].evidence == "name absent from info page"
    assert got[8].evidence == "no evidence" and got[8].reason == "needs_review"
    assert got[10].name == "Lex Rec — Summer Camp"
    review = {r.id: r for r in gates.publish_gate(s, pages, include_review=True).collect()}
    assert review[8].verdict == "needs_review" and review[8].status == "published" and review[2].status == "gap" and review[6].status == "gap"


def test_publish_gate_spreads(spark):
    """A small table of sessions lies in one part, and all of them may name one register page; the checks are dealt out all the same."""
    k = F.col("id")
    s = spark.range(0, 2400, 1, 1).select(
        "id", F.lit("Adventure Camp").alias("program_name"), F.lit("").alias("provider_name"), F.when(k % 4 == 0, "Read more").when(k % 4 == 1, "Swim lessons").otherwise("Adventure Camp").alias("name"),
        F.concat(F.lit("https://a.org/"), F.when(k % 3 == 0, k).otherwise(-1)).alias("info_url"), F.lit("https://lex.myrec.com/x").alias("register_url"), F.lit("July 6-10").alias("dates"), F.lit("").alias("ages"), F.lit("").alias("price"), F.lit(False).alias("camp_scoped"),
    )
    pages = spark.createDataFrame([(f"https://a.org/{k}", "Adventure Camp for kids, swim lessons." + LONG) for k in range(-1, 2400, 3)] + [("https://a.org/-1", "Adventure Camp, swim lessons." + LONG), ("https://lex.myrec.com/x", "Summer camp, $200. Register now: add to cart")], "key string, text string").coalesce(1)
    pages = pages.unionByName(spark.range(0, 2400, 3, 1).select(F.concat(F.lit("https://a.org/"), "id").alias("key"), F.lit("Adventure Camp for kids, swim lessons." + LONG).alias("text")))
    out = gates.publish_gate(s, pages)
    assert {(r.evidence, r.verdict): r["count"] for r in out.groupBy("evidence", "verdict").count().collect()} == {("chrome name", None): 600, ("lessons", None): 600, (None, "parent_ready"): 1200}
    parts = [r["count"] for r in out.where("evidence is null or evidence = 'lessons'").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 1800 and max(parts) < 900
    both = gates.judged_sessions(s, pages).withColumn("review", F.explode(F.array(F.lit(False), F.lit(True))))
    assert {(r.review, r.evidence, r.status): r["count"] for r in gates.publish_judged(both, F.col("review")).groupBy("review", "evidence", "status").count().collect()} == {
        (False, "chrome name", "gap"): 600, (False, "lessons", "gap"): 600, (False, None, "published"): 1200, (True, "chrome name", "gap"): 600, (True, "lessons", "published"): 600, (True, None, "published"): 1200,
    }


def test_dates_are_read_once(spark):
    """Each pattern is searched once in the text and once in its match for each group, however often the numbers are used."""
    df = spark.createDataFrame([("Feb 29, 2024 - 3/9/24",), ("Feb 30, 2023",), ("2026-02-29 July 6-31",), ("13/45/26",), (None,)], "t string")
    t = F.col("t")
    for f, most in ((D.first_date(t, 2026), 12), (D.date_span(t, 2026), 10), (D.day_window(t), 6)):
        plan = df.select(f.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract" in plan and plan.count("regexp_extract") <= most
    got = [(str(r.f), r.s and (str(r.s["first"]), str(r.s["last"]))) for r in df.select(D.first_date(t, 2026).alias("f"), D.date_span(t, 2026).alias("s")).collect()]
    assert got == [("2024-02-29", ("2024-02-29", "2024-03-09")), ("None", None), ("None", ("2026-07-06", "2026-07-31")), ("None", None), ("None", None)]


def test_publish_rows(spark):
    rows = frame(spark, [
        {"id": 1, "parent_verdict": "parent_ready", "granularity": "", "dates": "July 6-10", "name": "Senior Camp"}, {"id": 2, "parent_verdict": "", "granularity": "", "dates": "July 6-10", "name": "x"},
        {"id": 3, "parent_verdict": "brochure_only", "granularity": "session", "dates": "January 5-9", "name": "x"}, {"id": 4, "parent_verdict": "brochure_only", "granularity": "program", "dates": "", "name": "x"},
        {"id": 5, "parent_verdict": "brochure_only", "granularity": "session", "dates": "July 1", "name": "Parent Night"}, {"id": 6, "parent_verdict": "wrong_audience", "granularity": "", "dates": "July 1", "name": "x"},
    ])
    assert {r.id: (r.held_reason, r.label) for r in gates.publish_rows(rows, year=2026).collect()} == {
        1: (None, ""), 2: ("unverified", None), 3: ("date_sanity", None), 4: (None, "brochure_only"), 5: ("audience_keyword", None), 6: ("verdict:wrong_audience", None),
    }


def test_junk_and_tiers(spark):
    rows = frame(spark, [
        {"id": 1, "name": "Read more", "register_url": "", "source_url": "https://a.org", "ages": "", "dates": "", "price": "", "granularity": ""},
        {"id": 2, "name": "Fun Camp", "register_url": "https://b.org/x", "source_url": "https://a.org", "ages": "7", "dates": "", "price": "", "granularity": ""},
        {"id": 3, "name": "Fun Camp", "register_url": "https://form.jotform.com/x", "source_url": "https://a.org", "ages": "", "dates": "", "price": "", "granularity": "program"},
        {"id": 4, "name": "themunroecenterforthearts", "register_url": "https://a.org/faculty/x", "source_url": "https://a.org", "ages": "7", "dates": "", "price": "", "granularity": ""},
        {"id": 5, "name": "Fun Camp", "register_url": "https://www.a.org/x", "source_url": "https://sub.a.org", "ages": "7", "dates": "", "price": "", "granularity": ""},
    ])
    assert {r.id: r.reasons for r in gates.junk_reasons(rows).collect()} == {1: ["chrome_name", "no_register_url", "no_evidence"], 2: ["offhost_register"], 3: [], 4: ["unusable_name", "off_topic"], 5: []}
    rows = frame(spark, [
        {"id": 1, "name": "x", "register_url": "https://lex.myrec.com/program_details.aspx?ProgramID=1", "source_url": "", "platform": "myrec", "kind": "session", "granularity": ""},
        {"id": 2, "name": "x", "register_url": "https://a.org/programs", "source_url": "", "platform": "", "kind": "", "granularity": ""}, {"id": 3, "name": "x", "register_url": "https://a.org/x.pdf", "source_url": "", "platform": "", "kind": "", "granularity": ""},
        {"id": 4, "name": "x", "register_url": "https://a.org/x", "source_url": "https://a.org/x/", "platform": "llm", "kind": "", "granularity": ""}, {"id": 5, "name": "x", "register_url": "https://a.org/x", "source_url": "https://b.org", "platform": "", "kind": "portal", "granularity": ""},
        {"id": 6, "name": "x", "register_url": "https://a.org/x", "source_url": "", "platform": "", "kind": "", "granularity": "program"},
    ])
    assert {r.id: (r.quality_tier, r.quality_reason) for r in gates.quality_tier(rows).collect()} == {
        1: ("registrable", "platform register URL"), 2: ("rejected", "program hub page"), 3: ("rejected", "junk register URL"), 4: ("needs_trail", "model session with marketing page as register URL"),
        5: ("needs_trail", "portal entry"), 6: ("needs_trail", "provider-level program row"),
    }


def test_register_gate(spark):
    rows = frame(spark, [{"id": k, "register_url": u, "registrable": True, "parent_ready": True} for k, u in enumerate(["", "https://a", "https://b", "https://c", "https://d"])])
    checks = spark.createDataFrame([("https://a", 404, ""), ("https://b", 200, "hello"), ("https://c", 200, "Register now")], "url string, status int, html string")
    assert {r.id: (r.registrable, r.gate_reason) for r in gates.register_gate(rows, checks).collect()} == {
        0: (False, "no register_url"), 1: (False, "register_url 404"), 2: (False, "no registration affordance"), 3: (True, "200+affordance"), 4: (True, "unchecked"),
    }


def test_signals(spark):
    item = "https://x.myvscloud.com/webtrac/iteminfo.html?fmid=1"
    rows = [
        (item, "Add to cart"), (item, "hello"), ("https://a.org/x", "Summer camp, $200, register now"), ("https://a.org/x", "Summer camp. Coming soon"), ("https://a.org/x", "Summer camp"), ("https://a.org/faq/", "Summer camp $200 register now"),
        ("https://a.org/x", "Adult education for all"), ("https://a.org/x", "Members only"), ("https://a.org/x", "  "), ("https://a.org/product/x", "woocommerce add-to-cart $200"), ("https://a.org/program/teens/", "Summer camp"),
    ]
    new = values(spark, signals.enrollment(F.col("u"), F.col("h")), rows, "u string, h string")
    assert [s.auto_verdict for s in new] == ["parent_ready", None, "parent_ready", None, None, "wrong_audience", "wrong_audience", None, None, "parent_ready", None]
    assert [s.blockers for s in new] == [[], [], [], ["brochure_only"], [], ["junk_url"], ["adult_ed"], ["login_wall"], ["empty_page"], [], []]
    old = values(spark, signals.verdict_of(signals.enrollment(F.col("u"), F.col("h"), older=True), F.col("h")), rows, "u string, h string")
    assert old == ["parent_ready", "unverified", "parent_ready", "brochure_only", "brochure_only", "parent_ready", "wrong_audience", "login_wall", "fetch_failed", "parent_ready", "wrong_audience"]


def test_catalog_items(spark):
    iteminfo, details = "https://x.myvscloud.com/webtrac/iteminfo.html?Module=AR&FMID=", "https://lex.myrec.com/info/program_details.aspx?ProgramID="
    rows = [(1, 0, iteminfo + "1", "Item Details"), (1, 1, iteminfo + "1", "Art Camp"), (1, 2, iteminfo + "1", "07/06/2026 -07/10/2026"), (1, 3, iteminfo + "2&option=dates", "Chess"), (1, 4, "https://a.org", "Art")]
    got = signals.catalog_items(spark.createDataFrame(rows, "page_id int, pos int, url string, label string"), "webtrac").collect()
    assert [(r.item, r.name, r.dates) for r in got] == [("1", "Art Camp", "07/06/2026 - 07/10/2026")]
    rows = [(1, 0, details + "7", "View"), (1, 1, details + "7", "Art Camp"), (1, 2, details + "7", "Art Camp Ages 7-12 Jul 6-10"), (1, 3, details + "8", "details")]
    got = signals.catalog_items(spark.createDataFrame(rows, "page_id int, pos int, url string, label string"), "myrec").collect()
    assert [(r.item, r.name, r.dates, r.ages) for r in got] == [("7", "Art Camp Ages 7-12 Jul 6-10", "Jul 6-10", "Ages 7-12")]
    rows = [(1, 0, "https://o.daxko.com/ProgramDetail.mvc?program_id=1", "Camp"), (1, 1, "https://o.daxko.com/ProgramDetail.mvc?program_id=1", "Camp Fun"), (1, 2, "https://o.daxko.com/ProgramDetail.mvc?program_id=2", "Swim test"), (1, 3, "https://o.daxko.com/x", "Camp")]
    got = signals.catalog_items(spark.createDataFrame(rows, "page_id int, pos int, url string, label string"), "daxko").collect()
    assert [(r.name, r.url) for r in got] == [("Camp Fun", "https://o.daxko.com/ProgramDetail.mvc?program_id=1")]


def test_reports(spark):
    rows = frame(spark, [{"s": "a", "label": "1"}, {"s": "a", "label": "0"}, {"s": "a", "label": ""}, {"s": "b", "label": "1"}, {"s": "c", "label": ""}])
    got = {r.s: (r.n, r.base, r.blank, r.good, r.grade) for r in reports.completeness(rows, "s", {"blank": F.col("label") == ""}, F.col("label") == "1", F.col("label") != "").collect()}
    assert got == {"a": (3, 2, 1, 1, "D"), "b": (1, 1, 0, 1, "A"), "c": (1, 0, 1, 0, "D")}
    assert {tuple(r) for r in reports.subtotals(frame(spark, [{"a": "x", "b": "1"}, {"a": "x", "b": "2"}, {"a": "y", "b": "1"}]), "a", "b").collect()} == {("x", "1", 1), ("x", "2", 1), ("y", "1", 1), ("x", "all", 2), ("y", "all", 1), ("all", "all", 3)}
    c, found = frame(spark, [{"crawled": True}, {"crawled": False}]), frame(spark, [{"r": "media"}, {"r": None}, {"r": "media"}, {"r": "junk"}])
    assert tuple(reports.funnel(c, found, F.col("r")).first()) == (2, 1, 4, 1, {"media": 2, "junk": 1})
    by_reason, most = reports.gaps(frame(spark, [{"provider_id": p, "reason": r} for p, r in (("a", "empty"), ("a", "empty"), ("b", "js"))]), 1)
    assert {tuple(r) for r in by_reason.collect()} == {("empty", 2), ("js", 1)} and [tuple(r) for r in most.collect()] == [("a", 2)]


def test_screen_hits(spark):
    hits = spark.createDataFrame([("https://a.org/summer-camp", "Camp", ""), ("https://deny.com/camp", "Camp", ""), ("https://a.org/x.pdf", "Camp", ""), ("", "Camp", ""), ("https://a.org/zoo", "Animals", "cats")], "url string, title string, snippet string")
    deny = spark.createDataFrame([("deny.com",)], "domain string")
    assert [(r.url, r.reason) for r in links.screen_hits(hits, deny).orderBy("url").collect()] == [("", "no url"), ("https://a.org/summer-camp", None), ("https://a.org/x.pdf", "media"), ("https://a.org/zoo", "no camp signal"), ("https://deny.com/camp", "denied domain")]


# Relevance


def test_relevance(spark):
    rows = frame(spark, [
        {"id": 1}, {"id": 2, "name": "Adult tennis"}, {"id": 3, "name": "Gift card"}, {"id": 4, "name": "Yoga flow"}, {"id": 5, "name": "Kids yoga"}, {"id": 6, "name": "Winter camp"}, {"id": 7, "name": "Robots", "platform": "webtrac"},
        {"id": 8, "name": "Robots", "platform": "catalog_grid"}, {"id": 9, "name": "Robots", "ages": "9-11", "register_url": "https://lex.myrec.com/x"}, {"id": 10, "name": "Robots", "price": "$5", "register_url": "https://a.org"}, {"id": 11, "name": "Robots"},
        {"id": 12, "name": "Camp 6/29", "dates": "", "text": ""}, {"id": 13, "name": "Chess", "ages": "18 and up"},
    ])
    got = {r.id: (r.keep, r.focus_reason) for r in relevance.classify(rows).collect()}
    assert got == {
        1: (False, "empty"), 2: (False, "adult"), 3: (False, "non-program"), 4: (False, "adult-fitness"), 5: (True, "youth-summer"), 6: (False, "off-season"), 7: (True, "camp-catalog"), 8: (False, "no-signal"),
        9: (True, "registrable-evidence"), 10: (False, "no-signal"), 11: (False, "no-signal"), 12: (True, "youth-summer"), 13: (False, "adult"),
    }
    again = {r.id: (r.keep, r.focus_reason) for r in relevance.recover(relevance.classify(rows)).collect()}
    assert again[10] == (True, "fail-open") and again[11] == (False, "no-signal") and again[2] == (False, "adult")
    said = spark.createDataFrame([("https://a.org", False)], "register_url string, keep boolean")
    assert {r.id: r.keep for r in relevance.recover(relevance.classify(rows), said).collect()}[10] is False


def test_extracted_rows(spark):
    rows = frame(spark, [
        {"id": 1, "seed": "https://a.org", "name": "x", "register_url": "https://a.org/y", "confidence": "0.7"}, {"id": 2, "seed": "https://a.org", "name": "x", "register_url": "https://b.org/y", "confidence": "0.9"},
        {"id": 3, "seed": "https://a.org", "name": "x", "register_url": "https://lex.myrec.com/y", "confidence": "0.6"}, {"id": 4, "seed": "https://a.org", "name": "", "register_url": "https://a.org/y", "confidence": "1"}, {"id": 5, "seed": "https://a.org", "name": "x", "register_url": "https://a.org", "confidence": "high"},
    ])
    assert sorted(r.id for r in relevance.accepted(rows).collect()) == [1, 3]
    assert values(spark, relevance.item_noise(F.col("x")), ["Item Details", "6/29/2026 - x", "Swim test", "Camp", None]) == ["control", "date only", "noise", None, "blank"]
    assert values(spark, relevance.category_allowed(F.col("x"), "/lexplorations/"), ["https://a.org/lexplorations/shop", "https://a.org/lexplorations/summer-kids", "https://a.org/other/summer", "https://a.org/lexplorations/adult-summer"]) == [False, True, False, False]
    assert values(spark, relevance.product_allowed(F.col("u"), F.col("n")), [("https://a.org/class/summer-art", "Art camp"), ("https://a.org/class/care", "After care camp"), ("https://a.org/class/teens", "camp")], "u string, n string") == [True, False, False]
    rows = frame(spark, [
        {"id": 1, "provider_id": "a", "info_url": "https://a.org/camps/x", "dates": "", "ages": "", "detail": False}, {"id": 2, "provider_id": "a", "info_url": "https://a.org/other", "dates": "", "ages": "", "detail": False},
        {"id": 3, "provider_id": "a", "info_url": "https://a.org/other", "dates": "July", "ages": "7", "detail": False}, {"id": 4, "provider_id": "b", "info_url": "https://b.org/other", "dates": "", "ages": "", "detail": False},
        {"id": 5, "provider_id": "b", "info_url": "https://b.org/fitness/x", "dates": "", "ages": "", "detail": True},
    ])
    assert sorted(r.id for r in relevance.camp_pages_only(rows).collect()) == [1, 3, 4]
    pages = spark.createDataFrame([(1, "https://x.myvscloud.com/s?type=camp", ""), (2, "https://lex.myrec.com/x", ""), (3, "https://a.org", ""), (4, "https://b.org", "Our summer camp"), (5, "https://c.org", "x")], "page_id long, url string, html string")
    found = spark.createDataFrame([(3, f"https://a.org/summer-camp/{k}", "") for k in range(3)] + [(4, "https://b.org/camps/", "")], "page_id long, url string, label string")
    assert {r.page_id: r.role for r in relevance.page_roles(pages, found).collect()} == {1: "catalog", 2: "register", 3: "catalog", 4: "detail", 5: None}


# Verdicts


def test_verdicts(spark):
    rows = frame(spark, [
        {"id": 1, "name": "x", "platform": "MyRec", "parent_verdict": "unverified", "register_url": "https://a.org/x.pdf", "source_url": "", "kind": "", "granularity": ""},
        {"id": 2, "name": "x", "platform": "MyRec", "parent_verdict": "parent_ready", "register_url": "", "source_url": "", "kind": "", "granularity": ""},
        {"id": 3, "name": "x", "platform": "", "parent_verdict": "", "register_url": "https://a.org/x.pdf", "source_url": "", "kind": "", "granularity": ""},
        {"id": 4, "name": "x", "platform": "", "parent_verdict": "odd", "register_url": "", "source_url": "", "kind": "", "granularity": "program"},
    ])
    assert {r.id: (r.parent_verdict, r.parent_can_register) for r in verdicts.with_policy(rows).collect()} == {1: ("needs_js", False), 2: ("parent_ready", None), 3: ("", None), 4: ("odd", None)}
    assert {r.id: r.bucket for r in verdicts.with_buckets(rows).collect()} == {1: "unverified", 2: "parent_ready", 3: "wrong_audience", 4: "unverified"}
    assert values(spark, verdicts.program_floor(F.col("g"), F.col("v")), [("program", "unverified"), ("session", "unverified"), ("program", "parent_ready")], "g string, v string") == ["brochure_only", "unverified", "parent_ready"]
    assert values(spark, verdicts.fabrication_blocked(F.col("x")), ["needs_js", "ok", None]) == [True, False, False]


def test_fallback_rows(spark):
    results = frame(spark, [{"seed": "https://www.a.org/x", "provider_name": "Art House", "platform": "", "register_url": "https://a.org/sign-up"}, {"seed": "https://b.org", "provider_name": ""}, {"seed": "https://c.org"}, {"seed": "https://d.camp.org"}])
    known = spark.createDataFrame([("a.org",), ("B.org",), ("d.camp.org",)], "host string")
    got = {r.source_url: (r.name, r.register_url, r.granularity, r.platform) for r in verdicts.fallback_rows(results, spark.createDataFrame([("https://b.org",)], "seed string"), known).collect()}
    assert got == {"https://www.a.org/x": ("Art House — Summer Program", "https://a.org/sign-up", "program", "fallback"), "https://d.camp.org": ("D Camp — Summer Program", "https://d.camp.org", "program", "fallback")}
    rows = frame(spark, [{"id": 1, "granularity": "", "source_url": "https://a.org"}, {"id": 2, "granularity": "program", "source_url": "https://www.a.org/x"}, {"id": 3, "granularity": "program", "source_url": "https://b.org"}])
    assert sorted(r.id for r in verdicts.drop_stale_programs(rows).collect()) == [1, 3]
    engine = frame(spark, [{"name": "x", "info_url": "https://a", "register_url": "", "dates": "", "ages": "", "price": "", "verdict": "info_confirmed", "extractor": ""}])
    r = verdicts.catalog_rows(engine).first()
    assert (r.platform, r.source_url, r.parent_verdict, r.kind) == ("engine", "https://a", "info_confirmed", "session")


def test_rollups(spark):
    providers = spark.createDataFrame([("p1", "A"), ("p2", "B")], "provider_id string, name string")
    programs = spark.createDataFrame([("p1", "g1"), ("p1", "g2")], "provider_id string, program_id string")
    sessions = spark.createDataFrame([("g1", "parent_ready"), ("g1", "x"), ("g2", "x")], "program_id string, verdict string")
    assert sorted(tuple(r) for r in verdicts.provider_rollup(providers, programs, sessions).collect()) == [("p1", "A", 2, 3, 1), ("p2", "B", 0, 0, 0)]
    rows = spark.createDataFrame([("h", True, True, True), ("h", True, True, False), ("h", False, True, True), ("h", True, False, True)], "_hub string, season_ok boolean, geo_ok boolean, first boolean")
    assert tuple(verdicts.hub_stats(rows).first()) == ("h", 4, 1, 1, 1, 1, 0.25)
    rows = spark.createDataFrame([(["a", "b"],), ([],), (None,), (["a"],)], "serving_towns array<string>")
    assert {r.town: r.n for r in verdicts.town_counts(rows).collect()} == {"a": 2, "b": 1, "_": 2}


# Records


def test_payload_texts(spark):
    day = "struct<month:int,day:int,year:int>"
    assert values(spark, records.day_text(F.col("d")), [((7, 6, 2026),), ((None, 6, 2026),), ((7, None, 2026),)], f"d {day}") == ["07/06/2026", "", "07/01/2026"]
    assert values(spark, records.range_text(F.col("a"), F.col("b")), [("x", "y"), ("x", ""), ("", "y"), ("", "")], "a string, b string") == ["x - y", "x", "y", ""]
    assert values(spark, records.ranges_text(F.col("a"), F.col("b")), [(["7/6/2026 09:00", "7/13/2026"], ["7/10/2026 15:00"]), ([], []), (["1", "2", "3", "4", "5"], [])], "a array<string>, b array<string>") == ["7/6/2026–7/10/2026; 7/13/2026", "", "1; 2; 3; 4"]
    rows = [("7", "12", None, None), ("18", "", None, None), ("7", "", None, None), (None, None, "3", ""), (None, None, None, None)]
    assert values(spark, records.age_or_grade(*[F.col(c) for c in "abcd"]), rows, "a string, b string, c string, d string") == ["ages 7-12", "ages 18+", "ages 7-?", "grades 3-?", ""]
    assert values(spark, records.first_amount(F.col("a")), [(["", "0", "75"],), ([],), (None,)], "a array<string>") == ["$75", "", ""]
    assert values(spark, records.minor_units(F.col("a"), F.col("u")), [("12500", 2), ("12550", 2), ("x", 2), (None, None), ("99", 0)], "a string, u int") == ["$125", "$125.5", "", "", "$99"]


def test_make_sessions(spark):
    rows = frame(spark, [{"name": " Fun Camp ", "register_url": "http://www.A.org/x/?utm_source=1", "ages": " 7 "}, {"name": "Read More", "register_url": ""}, {"name": "photo.png", "kind": "portal"}])
    got = sorted((r.name, r.register_url, r.name_status, r.raw_name, r.kind, r.granularity, r.ages) for r in records.make_sessions(rows).collect())
    assert got == [("", "", "needs_name", "Read More", "session", "session", ""), ("", "", "needs_name", "photo.png", "portal", "session", ""), ("Fun Camp", "https://a.org/x", "ok", "", "session", "session", "7")]
    hits = frame(spark, [{"town": "Lexington", "sport": "tennis", "camp_title": "Nike Tennis Camp", "brand": "Nike", "min_age": "8", "max_age": "16", "session_dates": "7/6/2026–7/10/2026; 7/13/2026", "city": "Weston", "state": "MA", "camp_url": "https://a.org/c", "object_id": "o1"}])
    r = records.hit_sessions(hits, "ussc", "https://site").first()
    assert (r.name, r.venue, r.start_date, r.ages, r.serving_towns, r.details_text, r.object_id, r.registrable) == ("Nike Tennis Camp", "Weston, MA", "7/6/2026", "8-16", ["Lexington"], "Nike | tennis | Weston, MA", "o1", True)
    rows = frame(spark, [{"id": 1, "status": "Available", "info_url": "i", "external_url": "e"}, {"id": 2, "status": "Full - Notify me", "info_url": "i", "external_url": "e"}, {"id": 3, "status": "Available", "info_url": "i", "external_url": ""}, {"id": 4, "status": "", "info_url": "i", "external_url": ""}])
    assert {r.id: (r.registrable, r.register_url) for r in records.offered(rows).collect()} == {1: (True, "e"), 2: (False, "i"), 3: (True, "i"), 4: (False, "i")}


def test_detail_pages(spark):
    urls = ["https://a.org/trekkers-grades-5-6", "https://a.org/creative-arts-camp/", "https://a.org/x/12345", "https://a.org/excursions-ages-4-12"]
    assert values(spark, records.slug_age(F.col("x")), urls) == ["Grades 5-6", "", "", "Ages 4-12"]
    assert values(spark, records.slug_name(F.col("x")), urls) == ["Trekkers", "Creative Arts Camp", "", "Excursions"]
    assert values(spark, records.page_name(F.col("h"), F.col("u")), [("<h1>Fun <b>Camp</b> (Ages 7-12)</h1>", ""), ("<title>Fun Camp | Site</title>", ""), ("", "https://a.org/fun-camp")], "h string, u string") == ["Fun Camp", "Fun Camp", "Fun Camp"]
    pages = spark.createDataFrame([(1, "https://a.org/camp-fun", "From July 6 - 10, ages 7-12", ""), (2, "https://a.org/faq", "July 6", ""), (3, "https://a.org/zoo", "x", ""), (4, "https://a.org/fun-grades-5-6", "x", "")], "page_id long, url string, page_text string, html string")
    assert {r.page_id: (r.name, r.dates, r.ages) for r in records.detail_records(pages).collect()} == {1: ("Camp Fun", "July 6 - 10", "ages 7-12"), 4: ("Fun", "", "Grades 5-6")}
    sessions = spark.createDataFrame([(1, "Robot Week"), (1, "Art")], "page_id long, name string")
    found = spark.createDataFrame([(1, 0, "https://a.org/r", "Robot Week 1"), (1, 1, "https://lex.myrec.com/r", "robots: a robot week"), (1, 2, "https://a.org/w", "Week of dance"), (1, 3, "https://a.org/n", "Nothing"), (2, 0, "https://a.org/z", "Art")], "page_id long, pos int, url string, label string")
    assert {(r.name, r.url, r.score, r.rank) for r in records.links_by_name(sessions, found).collect()} == {("Robot Week", "https://lex.myrec.com/r", 103, 1), ("Robot Week", "https://a.org/r", 100, 2), ("Robot Week", "https://a.org/w", 10, 3)}
    rows = frame(spark, [{"ord": 1, "provider_id": "a", "name": "Camp "}, {"ord": 2, "provider_id": "a", "name": "camp"}, {"ord": 3, "provider_id": "b", "name": "Camp"}])
    assert sorted(r.ord for r in records.first_names(rows).collect()) == [1, 3]


# Seeds and link rows


def test_seeds(spark):
    c = [("https://guide.com/a", "guide"), ("https://guide.com/b", "guide"), ("https://a.org/summer-camp", ""), ("http://www.a.org/summer-camp/", ""), ("https://b.org/", ""), ("https://b.org/recreation", ""), ("https://c.org/tag/x", ""), ("https://d.org/x", "camp")]
    rows = spark.createDataFrame([(u, k, n) for n, (u, k) in enumerate(c)], "url string, classified_as string, ord int")
    assert {r.ord: (r.kept, r.why) for r in links.one_seed_per_domain(rows).collect()} == {
        0: (True, "guide"), 1: (True, "guide"), 2: (True, "camp"), 3: (False, "duplicate"), 4: (False, "duplicate"), 5: (True, "directory"), 6: (False, "score"), 7: (True, "camp"),
    }
    rows = spark.createDataFrame([(f"https://a.org/{k}", k) for k in range(4)] + [("https://a.org/register", 9), ("https://b.org", 10)], "url string, ord int")
    assert sorted(r.ord for r in links.cap_per_domain(rows, 2).collect()) == [0, 9, 10]
    rows = spark.createDataFrame([("lex", "https://x.org/a", 0), ("lex", "https://lex.myrec.com/b", 1), ("lex", "https://www.x.org/c", 2), ("lex", "https://facebook.com/d", 3), ("bur", "https://x.org", 4)], "town string, url string, ord int")
    assert sorted((r.town, r.host, r.vendor, r.org_id, r.rank) for r in links.discovered_registry(rows).collect()) == [("bur", "x.org", "unknown", "", 1), ("lex", "lex.myrec.com", "myrec", "lex", 1), ("lex", "x.org", "unknown", "", 2)]
    rows = frame(spark, [{"url": f"https://a.org/{p}", "title": "Fun", "town": "lex", "phase": "a", "classified_as": k, "crawled": False, "ord": n} for n, (p, k) in enumerate([("summer", "camp"), ("x", "guide"), ("seen", "camp"), ("privacy", "camp")])])
    fresh, after = links.direct_links(rows, spark.createDataFrame([("https://a.org/seen",)], "key string"))
    assert [r.url for r in fresh.collect()] == ["https://a.org/summer"] and {r.url: r.crawled for r in after.collect()}["https://a.org/x"] is False


def test_names(spark):
    names = ["Skip to anything", "Jump to x", "open the menu", "View all", "a.pdf", "#12-3", "", "Fun Camp", "go to x"]
    assert values(spark, T.bad_name_reason(F.col("x")), names) == ["chrome name", "chrome name", "chrome name", "chrome name", "filename as name", "bare id as name", "empty name", None, None]
    assert values(spark, T.name_in_text(F.col("n"), F.col("t")), [("Robot Art Week", "robot art"), ("Robot Art Week", "robot"), ("The Camp", "x"), ("Robot", "a robot")], "n string, t string") == [True, False, False, True]
    assert values(spark, T.prefixed_name(F.col("n"), F.col("p")), [("Summer Camp", "Lex Rec"), ("Robot Camp", "Lex Rec"), ("Camp", "")], "n string, p string") == ["Lex Rec — Summer Camp", "Robot Camp", "Camp"]
    assert values(spark, T.clean_age(F.col("x")), ["ages 05", "age 2", "7-12", None]) == ["", "", "7-12", ""]
    assert values(spark, T.is_adult_age(F.col("x")), ["18+", "ages 21-65", "7-12", "18 months", "18-24 months"]) == [True, True, False, False, False]
    assert values(spark, T.markdown_to_text(F.col("x")), ["* [Camp](https://a.org) now https://b.org ![x](y)"]) == ["Camp now"]
    assert values(spark, T.display_name(F.col("x")), ["Robot Camp - Week 3, July 6-10"]) == ["Robot Camp"]


@pytest.mark.parametrize("page, want", [("", "empty"), ("Please sign in", "login_wall"), ("x", "needs_js"), ("Register for camp", "ok")])
def test_page_status(spark, page, want):
    assert values(spark, T.page_status(F.col("x")), [page]) == [want]
