"""The toxicity classifier: responses and slopes against plain ones, held-out accuracy, thresholds, edges."""

from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from catamill.llm import queries, toxicity
from catamill.llm.toxicity import Fit, Scorer, largest, rows_of, slopes
from catamill.session import table
from tests.llm.test_operators import odd  # noqa: F401


def net_of(fit, numbers, label):
    return toxicity._starts([np.array(x, np.int32) for x in numbers], np.array(label, np.float64), fit)


def test_largest_responses(monkeypatch):
    rnd = np.random.default_rng(3)
    fit = Fit(filters=3, size=4)
    numbers = [rnd.integers(0, 300, n) for n in (5, 1, 0, 9, 3, 500, 0, 70, 0)]
    net = net_of(fit, numbers[:6], [1, 0, 1, 0, 1, 0])
    rows = [rows_of(net, x) for x in numbers]
    shares = np.vstack([np.zeros((1, fit.size)), net.embedding]) @ net.kernels
    want = []
    for r in rows:
        padded, at, high = [*r, 0, 0, 0], 0, []
        for width in fit.widths:
            windows = [[sum(shares[padded[i + o], at + o * fit.filters + f] for o in range(width)) for f in range(fit.filters)] for i in range(max(1, len(r)))]
            high += np.max(windows, axis=0).tolist()
            at += width * fit.filters
        want.append(high)
    flat, ends = np.concatenate(rows), np.cumsum([len(r) for r in rows])
    for span in (1 << 17, 64, 7, 1):
        monkeypatch.setattr(toxicity, "SPAN", span)
        assert np.allclose([largest(shares.astype(np.float32), r, fit)[0] for r in rows], want, atol=1e-5)
        assert np.allclose(Scorer(net, fit).margins(flat, ends), (np.tanh(np.array(want) + net.bias) * net.weight).sum(axis=1) + net.base, atol=1e-5)


def test_slopes_are_those_of_differences():
    rnd = np.random.default_rng(0)
    fit = Fit(size=3, filters=2)
    numbers = [rnd.integers(0, 20, n) for n in (5, 1, 0, 9, 3)]
    label, weight = np.array([1, 0, 1, 0, 1.0]), np.array([1, 2, 1, 0.5, 1.0])
    net = net_of(fit, numbers, label)
    net = replace(net, embedding=net.embedding.astype(np.float64) * 5, kernels=net.kernels.astype(np.float64), bias=rnd.normal(size=6), weight=rnd.normal(size=6), base=0.3)
    rows = [rows_of(net, x) for x in numbers]
    _, by, used = slopes(net, fit, rows, label, weight)

    def difference(name, at):
        out = []
        for step in (1e-3, -1e-3):
            moved = np.array(getattr(net, name), np.float64)
            moved[at] += step
            out.append(slopes(replace(net, **{name: float(moved) if name == "base" else moved}), fit, rows, label, weight)[0])
        return (out[0] - out[1]) / 2e-3

    for name in ("kernels", "bias", "weight", "base"):
        for at in np.ndindex(np.shape(getattr(net, name))):
            assert abs(difference(name, at) - np.asarray(by[name])[at]) < 1e-4
    for k, row in enumerate(used):
        for c in range(3):
            assert abs(difference("embedding", (row, c)) - by["embedding"][k, c]) < 1e-4


def test_op12(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op12_toxicity(spark, sf).collect()}
    assert len(got) == table(spark, sf, "documents").count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    marks = [(got[r.doc_id], r.toxic) for r in table(spark, sf, "labels").collect()]
    held = [(r.predicted, y) for r, y in marks if r.held_out]
    assert len(held) > 50 and sum(p == y for p, y in held) / len(held) > 0.95
    assert sum(p for p, y in held if not y) == 0 and sum(p for p, y in held if y) >= 4  # of six, two of which have no word that the others have


PLAIN = ["the house by the lake was quiet", "we walked along the river today", "bread and cheese are on the table"]
FRENCH = ["la maison du lac est calme", "nous marchons pres de la riviere", "le pain et le fromage sont la"]


def made(n):
    """Texts of two languages in which one word of each is toxic, and each is harmless in the other."""
    rnd = np.random.default_rng(5)
    rows = []
    for k in range(n):
        french, bad = k % 3 == 0, k % 4 == 0
        words = " ".join(rnd.choice(FRENCH if french else PLAIN, 3)).split()
        words.insert(int(rnd.integers(0, len(words))), ("crapule" if french else "Moron!") if bad else "ok")
        rows.append((k, " ".join(words), "fr" if french else "en", int(bad)))
    return rows


def test_op12_learns_and_has_thresholds(spark):
    rows = made(400)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows if r[0] < 300], "doc_id long, label int")
    model = toxicity.train(docs, labels)
    assert set(toxicity.thresholds(model)) == {"en", "fr", None}
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all((got[k].score >= 0.5) == bool(bad) for k, _, _, bad in rows)
    # Neither the layout, nor ids, languages and other columns change a score.
    other = docs.selectExpr("text", "'xx' lang", "-doc_id doc_id", "'s' source").repartition(1)
    assert {r.doc_id: r.score for r in toxicity.score(other, model).collect()} == {-k: r.score for k, r in got.items()}
    again = toxicity.train(docs.repartition(7), labels.repartition(2))
    assert {r.doc_id: r.score for r in toxicity.score(docs, again).collect()} == {k: r.score for k, r in got.items()}
    long = spark.createDataFrame([(1, " ".join(PLAIN * 30000)), (2, " ".join([*PLAIN * 30000, "moron"])), (3, " ".join(["Moron", *PLAIN * 30000]))], "doc_id long, text string")
    assert [r.score >= 0.5 for r in toxicity.score(long, model).orderBy("doc_id").collect()] == [False, True, True]


def test_op12_sample_is_bounded(spark):
    rows = [(k, "copied text with moron" if k % 3 else f"row {k}", "en", k % 2) for k in range(3000)] + [(7, "again " * 50, "en", 1)] * 40
    docs, labels = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string"), spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, label int")
    fit = Fit(sample=200, words=3000)
    few = toxicity.sampled(docs, labels, fit).toPandas()
    assert 100 < len(few) <= 800 and few.ids.map(len).sum() < 4 * 2 * fit.words
    assert few.groupby("label").weight.first().round(1).to_dict() == {0: 7.5, 1: 7.5}


def test_op12_edges(spark, odd):  # noqa: F811
    labels = spark.createDataFrame([(3, 1), (3, 0), (3, 1), (5, 1), (7, 0), (0, 0), (1, 1), (None, 1), (9, None), (12, 5), (999, 1)], "doc_id long, label int")
    model = toxicity.train(odd, labels)
    out = toxicity.score(odd, model)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["score"] and out.count() == odd.count()
    by = {}
    for r in out.collect():
        assert 0 <= r.score <= 1
        by.setdefault(r.text or "", set()).add(r.score)
    assert all(len(v) == 1 for v in by.values())
    assert toxicity.score(odd.limit(0), model).count() == 0
    assert toxicity.train(odd, labels.limit(0)) is None and toxicity.train(odd.limit(0), labels) is None
    assert {r.score for r in toxicity.score(odd, None).collect()} == {0.5}
    one = toxicity.train(odd, labels.where("doc_id = 5"))  # one label alone
    assert toxicity.score(odd, one).where(F.col("score").isNull() | F.isnan("score")).count() == 0
    none = toxicity.train(odd.drop("lang"), labels)
    assert none.names == [] and toxicity.score(odd, none).count() == odd.count()
