"""The distributed greedy collapse against the plain loop, and the similarity join against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from catamill.functions.similarity import token_set
from catamill.operators import collapse, linkage, similar
from catamill.operators.collapse import greedy_leads

WORDS = ["camp", "camps", "summer", "robot", "robots", "robotics", "art", "arts", "soccer", "socker", "the", "of", "week", "chess", "ch", "a", "aa", "aaa", "and"]


def loop(rows, threshold):
    """rows: ord, id, name, zip, day."""
    kept, lead = [], {}
    for ord_, *own in sorted(rows):
        hit = next((k for k in kept if own[0] and k[1] == own[0]), None)
        hit = hit or next((k for k in kept if not (k[1] and own[0]) and own[1] and k[2] and own[2] and own[3] and k[3:] == own[2:] and token_set(k[2], own[1], "indel") >= threshold), None)
        if hit:
            hit[1:] = [a or b for a, b in zip(hit[1:], own, strict=True)]
            lead[ord_] = hit[0]
        else:
            kept.append([ord_, *own])
            lead[ord_] = ord_
    return lead


def names(rnd, n):
    for _ in range(n):
        w = [rnd.choice(WORDS) for _ in range(rnd.randint(1, 4))]
        if rnd.random() < 0.5:
            i = rnd.randrange(len(w))
            j = rnd.randrange(len(w[i]))
            w[i] = w[i][:j] + rnd.choice("xyz") + w[i][j + rnd.randint(0, 1) :]
        yield " ".join(sorted(set(w)))


def leads(spark, rows, threshold):
    df = spark.createDataFrame(rows, "ord long, id string, name string, zip string, day string").repartition(3)
    got = [(r.ord, r.lead) for r in greedy_leads(df, threshold).collect()]
    assert len(got) == len(rows)
    return dict(got)


@pytest.mark.parametrize("seed", range(4))
def test_collapse_is_the_loop(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    some = list(names(rnd, 25))
    rows = []
    for k in range(160):
        id_ = f"i{rnd.randrange(30)}" if rnd.random() < (0.2, 0.5, 0.8, 0.5)[seed] else ""
        full = rnd.random() < (0.95, 0.8, 0.5, 0.3)[seed]
        hide = lambda v: v if full or rnd.random() < 0.6 else ""  # noqa: B023, E731
        rows.append((k * 3, id_, hide(rnd.choice(some)), hide(f"0242{rnd.randrange(2)}"), hide("2026-07-06")))
    want = loop(rows, 0.85)
    assert leads(spark, rows, 0.85) == want and len(set(want.values())) < len(rows)
    if seed == 1:  # the rest in one task gives the same, and so do rounds alone
        monkeypatch.setattr(collapse, "LAST_ROUND", 0)
        assert leads(spark, rows, 0.85) == want
        monkeypatch.setattr(collapse, "LAST_EDGES", -1)
        assert leads(spark, rows, 0.85) == want


def test_collapse_chains_and_hot_blocks(spark):
    chain = [(k, "", "".join(sorted("abcdefghijklmnopqrstuvwxyz"[k : k + 12])), "02420", "2026-07-06") for k in range(14)]  # each is like the next alone
    assert leads(spark, chain, 0.9) == loop(chain, 0.9)
    hot = [(k, f"i{k}" if k % 2 else "", "art camp", "02420", "2026-07-06") for k in range(400)]
    assert leads(spark, hot, 0.92) == loop(hot, 0.92)
    late = [(0, "x", "art camp", "", ""), (1, "", "art camp", "02420", "2026-07-06"), (2, "", "art camps", "02420", "2026-07-06"), (3, "x", "", "02420", "2026-07-06"), (4, "", "art camp", "02420", "2026-07-06"), (5, "y", "art camp", "02420", "2026-07-06"), (6, "y", "q", "02421", "z"), (7, "", "art camp", "02421", "z")]
    want = loop(late, 0.9)
    assert want[4] == 0 and want[5] == 1 and want[6] == 1
    assert leads(spark, late, 0.9) == want
    assert leads(spark, [(1, None, None, None, None), (2, None, None, None, None)], 0.9) == {1: 1, 2: 2}
    assert greedy_leads(spark.createDataFrame([], "ord long, id string, name string, zip string, day string"), 0.9).count() == 0


def test_merge_catalog(spark):
    engine = spark.createDataFrame([(0, "Art Camp", "https://lex.myrec.com/info/program_details.aspx?ProgramID=7", "", "July 6", "Lexington")], "ord long, name string, register_url string, info_url string, dates string, town string")
    hub = spark.createDataFrame(
        [(0, "camp art", "https://lex.myrec.com/info/program_details.aspx?ProgramID=7&x=1", "$5", "webtrac", ["hub1"], "Hall, Burlington, MA"), (1, "Chess", "https://a.org/x", "", "shop", [], "Field, Burlington, MA"), (2, "", "", "", "", [], "")],
        "ord long, name string, register_url string, price string, platform string, discovered_via array<string>, venue string",
    )
    gap = spark.createDataFrame([(0, "Chess Club", "https://b.org/y", "2026-07-06", "02420", "x"), (1, "Club of Chess", "", "2026-07-06", "02420", "y")], "ord long, name string, register_url string, start_date string, geo_zip string, platform string")
    towns = spark.createDataFrame([("Burlington", "01803")], "town string, zip string")
    got = {r.name: r for r in linkage.merge_catalog({"engine": engine, "part_d": hub, "gap": gap}, 2026, towns).collect()}
    assert set(got) == {"Art Camp", "Chess", "Chess Club"} and got["Chess Club"].n_merged == 2  # all its words stand in the other's
    art = got["Art Camp"]
    assert (art.start_date, art.price, art.n_merged, art.geo_town, art.geo_state, art.session_uid) == ("2026-07-06", "$5", 2, "Lexington", "MA", "lex.myrec.com|programid|7")
    assert art.discovered_via == ["engine", "hub1", "webtrac"] and art.serving_towns == ["Lexington"]
    assert (got["Chess"].geo_town, got["Chess"].geo_state, got["Chess"].discovered_via) == ("Burlington", "MA", ["shop"])


@pytest.mark.parametrize("flavour", ["indel", "blocks"])
@pytest.mark.parametrize("threshold", [0.7, 0.75, 0.85, 1.0])
def test_similar_names_lose_none(spark, flavour, threshold):
    rnd = random.Random(3)
    rows = sorted({(rnd.randint(0, 1), n) for n in names(rnd, 130)})
    want = {(b, m, n) for b, m in rows for c, n in rows if b == c and m < n and token_set(m, n, flavour) >= threshold}
    df = spark.createDataFrame(rows, "b int, n string")
    assert {(r.b, r.m, r.n) for r in similar.similar_names(df, ["b"], threshold, flavour).collect()} == want and want


def test_similar_candidates_are_few(spark):
    p = spark.read.parquet("/root/testdata/sf0.01/part.parquet").select(F.lit(1).alias("b"), F.col("p_name").alias("n")).distinct()
    n = p.count()
    for threshold in (0.75, 0.85):
        assert similar.candidate_names(p, ["b"], threshold).count() < 0.05 * n * (n - 1) / 2
    with pytest.raises(ValueError):
        similar.candidate_names(p, ["b"], 0.6)


def test_nearest_once_is_the_loop(spark):
    from catamill.operators import monitor

    rnd = random.Random(6)
    rows = [(f"g{g}", g, f"o{rnd.randrange(25)}" if rnd.random() < 0.95 else None, float(rnd.randrange(12))) for g in range(12) for _ in range(14)]
    want, taken = {}, set()
    for g in range(12):
        best = {}
        for _, _, o, d in (r for r in rows if r[1] == g and r[2]):
            best[o] = min(best.get(o, d), d)
        own = sorted((d, o) for o, d in best.items() if o not in taken)[:3]
        taken |= {o for _, o in own}
        want |= {(f"g{g}", o): (k + 1, d) for k, (d, o) in enumerate(own)}
    df = spark.createDataFrame(rows, "g string, turn int, o string, d double").repartition(3)
    assert {(r.g, r.o): (r["rank"], r.d) for r in monitor.nearest_once(df, "g", "turn", "d", "o", 3).collect()} == want
    assert monitor.nearest_once(df.limit(0), "g", "turn", "d", "o", 3).count() == 0


def long_names(rnd, n):
    """Names of long tokens from few letters, some of them edited, turned round, cut, split or with short ones beside."""
    word = lambda k: "".join(rnd.choice("abcdefgh") for _ in range(k))
    some = [" ".join(word(rnd.choice((3, 9, 16, 32))) for _ in range(rnd.randint(1, 3))) for _ in range(n // 4)]
    for _ in range(n):
        s = rnd.choice(some)
        for _ in range(rnd.randrange(5)):
            i = rnd.randrange(len(s) + 1)
            s = rnd.choice((s[:i] + s[i + 1 :], s[:i] + rnd.choice("abz ") + s[i:], " ".join(s.split()[::-1]), s))
        yield " ".join(sorted(set(s.split())))


@pytest.mark.parametrize("threshold,flavour", [(0.92, "indel"), (0.9, "indel"), (0.85, "blocks"), (0.75, "indel")])
def test_long_names_lose_no_pair(spark, threshold, flavour):
    rnd = random.Random(int(threshold * 100))
    some = sorted(set(long_names(rnd, 260)) - {""})
    sides = {n: rnd.choice((1, 2, 3)) for n in some}
    df = spark.createDataFrame([(1, n, sides[n]) for n in some], "b int, n string, side int")
    near = {(m, n) for i, m in enumerate(some) for n in some[i + 1 :] if token_set(m, n, flavour) >= threshold}
    assert len(near) > 100
    assert {(r.m, r.n) for r in similar.similar_names(df.drop("side"), ["b"], threshold, flavour).collect()} == near
    assert {(r.m, r.n) for r in similar.similar_names(df, ["b"], threshold, flavour).collect()} == {(m, n) for m, n in near if sides[m] | sides[n] == 3}


def test_long_names_that_meet(spark, monkeypatch):
    """Of long names from sixteen letters, hardly any meet another that is not alike; before, a third of all pairs did."""
    rnd = random.Random(8)
    some = sorted({"".join(rnd.choice("abcdefghijklmnop") for _ in range(32)) for _ in range(500)})
    monkeypatch.setattr(similar, "_possible", lambda threshold: F.lit(True))
    df = spark.createDataFrame([(1, n) for n in some], "b int, n string")
    assert similar.candidate_names(df, ["b"], 0.92).count() < 0.005 * len(some) ** 2 / 2


def test_numbered_names_that_meet(spark, monkeypatch):
    """Of names of one form with numbers, those meet that are a digit apart or nearly so; before, all met all."""
    some = [f"{k * 37:09d} supplier" for k in range(500)]
    monkeypatch.setattr(similar, "_possible", lambda threshold: F.lit(True))
    df = spark.createDataFrame([(1, n) for n in some], "b int, n string")
    near = sum(token_set(m, n, "indel") >= 0.94 for i, m in enumerate(some) for n in some[i + 1 :])
    assert 0 < near <= similar.candidate_names(df, ["b"], 0.94).count() < 1.1 * near < 0.05 * len(some) ** 2 / 2


def nearly_equal_names(rnd, n):
    """Numbered names, some with a character taken out or put in, a token moved, cut in two or run into the next."""
    for _ in range(n):
        w = ["supplier", f"{rnd.randrange(40):06d}", *rnd.sample(["a", "b", "zz", "éa", "supplies", "000"], rnd.randrange(4))]
        s = " ".join(sorted(set(w)))
        for _ in range(rnd.randrange(3)):
            i = rnd.randrange(len(s) + 1)
            s = rnd.choice((s[:i] + s[i + 1 :], s[:i] + rnd.choice("01a ") + s[i:], s.replace(" ", "", 1)))
        yield " ".join(sorted(set(s.split())))


@pytest.mark.parametrize("threshold,flavour,most", [(0.94, "indel", 64), (0.94, "indel", 18), (0.92, "blocks", 64), (0.97, "indel", 64)])
def test_names_less_one_character_lose_no_pair(spark, monkeypatch, threshold, flavour, most):
    """Also where the longer names of a block are met by grams and the shorter ones by their texts less one character."""
    monkeypatch.setattr(similar, "LESS_ONE", most)
    rnd = random.Random(most)
    some = sorted(set(nearly_equal_names(rnd, 330)) - {""})
    sides = {n: rnd.choice((1, 2, 3)) for n in some}
    df = spark.createDataFrame([(1, n, sides[n]) for n in some], "b int, n string, side int")
    near = {(m, n) for i, m in enumerate(some) for n in some[i + 1 :] if token_set(m, n, flavour) >= threshold}
    assert len(near) > 50
    assert {(r.m, r.n) for r in similar.similar_names(df.drop("side"), ["b"], threshold, flavour).collect()} == near
    assert {(r.m, r.n) for r in similar.similar_names(df, ["b"], threshold, flavour).collect()} == {(m, n) for m, n in near if sides[m] | sides[n] == 3}


def test_less_one(spark):
    row = spark.createDataFrame([(["a", "bc", "d"],)], "t array<string>").select(similar.less_one(F.col("t")).alias("x")).head()
    assert sorted(row.x) == sorted(["a bc d", "bc d", "a c d", "a b d", "a bc", "abc d", "ad bc", "a bcd"])
