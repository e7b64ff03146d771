"""Vector codes and whitening against brute force, and their defined results at the edges."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from catamill.llm import codes_oracle, queries, vector_codes, whitening
from catamill.llm.vector_codes import Codes, compress, nearest, sequency_order, walsh
from catamill.llm.whitening import largest_eigenvalues, leading, sturm_counts, tridiagonal, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x long, c_ double"


def made(rows):
    return [(k, v, label, "x", 1, 2.0) for k, v, label in rows]


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """The contract in plain loops; rows: vec_id, vector, label."""
    rows = sorted(((k, [math.floor(1024 * float(c)) for c in v], label) for k, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = max(1, -(-max(len(v) for _, v, _ in rows) // parts))
    full = [v + [0] * (parts * size - len(v)) for _, v, _ in rows]
    cut = [[tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for v in full]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, book: min((dist(v, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            to = [near(c[p], books[p])[1] for c in cut]
            for k in set(to):
                own = [c[p] for c, t in zip(cut, to, strict=True) if t == k]
                books[p][k] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    out, sums = [], {}
    for (k, _, label), c in zip(rows, cut, strict=True):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((k, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
        sums[label] = sums.get(label, 0) + out[-1][3]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(k), code, error, sums[label], digest) for k, label, code, error in out)


def got_codes(df, fit=Codes()):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in compress(df, fit).collect())


def test_sequency():
    for width in (1, 2, 4, 16, 64):
        plain = np.array([[1 - 2 * (bin(i & j).count("1") % 2) for j in range(width)] for i in range(width)])
        ordered = sorted(range(width), key=lambda i: int((np.diff(plain[i]) != 0).sum()))
        assert sequency_order(width).tolist() == ordered
        assert (walsh(np.eye(width, dtype=np.int64)).T == plain[ordered]).all()


def test_nearest_is_exact_and_takes_the_first():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        n, k, size, most = rnd.integers(1, 60), rnd.integers(1, 40), rnd.integers(1, 20), rnd.integers(1, 6)
        x, book = rnd.integers(-most, most, (n, size)), rnd.integers(-most, most, (k, size))
        index, scaled = nearest(walsh(x), walsh(book), int(rnd.integers(1, 20)), float(rnd.choice([0, 0.12, 1])))
        plain = ((x[:, None] - book) ** 2).sum(axis=2)
        assert (index == plain.argmin(axis=1)).all() and (scaled == plain.min(axis=1) * walsh(x).shape[1]).all()


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_op11(spark, size):
    sf = f"/root/testdata/sf{size}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(con.sql(codes_oracle.sql()).project("vec_id, code, error, label_error, codebooks_sha256").fetchall())
    assert sorted(tuple(r) for r in queries.op11_vector_codes(spark, sf).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()) == want


def test_op11_edges(spark):
    rnd = np.random.default_rng(4)
    nan, inf = float("nan"), float("inf")
    rows = [(int(k), [float(x) for x in rnd.normal(0, 0.1, 16)], None if k % 5 == 0 else int(k % 3)) for k in rnd.permutation(60)]
    rows += [(100, None, 1), (101, [nan] * 16, 1), (102, [0.1, None] + [0.0] * 14, 1), (103, [inf] * 16, None), (104, [-inf] + [0.0] * 15, 2)]
    rows += [rows[0], rows[0], (None, rows[1][1], None), (None, rows[2][1], 1), (7, rows[3][1], 9), (-5, [0.0] * 16, 9), (200, [1.5], 3), (201, [], 3)]
    df = spark.createDataFrame(made(rows), SCHEMA).repartition(3)
    assert got_codes(df) == brute_codes(rows)
    few = Codes(entries=8)
    assert got_codes(df, few) == brute_codes(rows, entries=8)
    odd = [(k, [float(x) for x in rnd.normal(0, 0.1, 10)], k % 2) for k in range(30)]  # four parts don't divide ten
    assert got_codes(spark.createDataFrame(made(odd), SCHEMA).repartition(4), few) == brute_codes(odd, entries=8)
    same = [(k, [0.25, -0.5, 0.001, -0.001], 0) for k in range(20)]
    assert got_codes(spark.createDataFrame(made(same), SCHEMA)) == brute_codes(same)
    assert {r.code for r in compress(spark.createDataFrame(made(same), SCHEMA)).collect()} == {"00000000"}
    empty = compress(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError):
        compress(spark.createDataFrame(made([(1, [1e6], 1)]), SCHEMA))


def test_op11_large_numbers(spark):
    rows = [(k, [65536.0 * (-1) ** k, 60000.5 - k, -65536.0, 3.0 * k], None) for k in range(12)]
    assert got_codes(spark.createDataFrame(made(rows), SCHEMA), Codes(entries=4)) == brute_codes(rows, entries=4)


def test_op11_does_not_depend_on_the_layout(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert got_codes(df.repartition(1)) == got_codes(df.repartition(7, "label")) == got_codes(df.orderBy(F.desc("vec_id")))


# Whitening


@pytest.mark.parametrize("size", [1, 2, 3, 8, 40])
def test_leading(size):
    rnd = np.random.default_rng(size)
    q = np.linalg.qr(rnd.normal(size=(size, size)))[0]
    x = rnd.normal(size=(max(1, size // 3), size))
    near = (q * np.sort(rnd.choice([1.0, 2.0, 2.0 + 1e-9], size))) @ q.T
    for a in (q @ np.diag(np.arange(size) + 1.0) @ q.T, np.eye(size) * 3, np.diag(rnd.integers(1, 4, size) + 0.0), (near + near.T) / 2, x.T @ x, np.zeros((size, size))):
        values, z = leading(a, 8)
        want = np.linalg.eigvalsh(a)[::-1][:8]
        norm = max(1e-20, np.abs(want).max())  # the zero matrix gives 1e-36
        assert len(values) == min(8, size) and np.abs(values - want).max() <= 1e-13 * norm
        assert np.abs(z.T @ z - np.eye(len(values))).max() < 1e-13 and np.abs(a @ z - z * values).max() <= 1e-13 * norm


def test_tridiagonal_and_counts():
    rnd = np.random.default_rng(1)
    a = rnd.normal(size=(30, 30))
    a = a + a.T
    d, e, reflectors = tridiagonal(a)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    assert np.allclose(np.linalg.eigvalsh(t), np.linalg.eigvalsh(a)) and len(reflectors) == 28
    points = np.linspace(-20, 20, 101)
    assert (sturm_counts(d, e * e, points, 1e-300) == (np.linalg.eigvalsh(a)[:, None] < points).sum(axis=0)).all()
    assert np.allclose(largest_eigenvalues(d, e, 30), np.linalg.eigvalsh(a)[::-1])


def brute_white(rows, most=8):
    """vec_id, deviation and absolute whitened values of each kept row."""
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max(1, max(len(v) for _, v in kept))
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] + [100000] * (size - len(v)) for _, v in kept]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(r, s, strict=True)) for r in x]
    y = np.array([[c - 100000 for c in r] for r in x], np.float64)
    y -= np.array([t - n * 100000 for t in s]) / n
    values, q = np.linalg.eigh(y.T @ y / n)
    values, q = values[::-1][:most], q[:, ::-1][:, :most]
    return [k for k, _ in kept], deviation, y @ q, values, float((y * y).sum() / n)


def test_op13(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, deviation, projected, values, trace = brute_white(rows)
    got = queries.op13_whitening(spark, sf).collect()
    assert len(got) == 8 * len(ids)
    at = {k: i for i, k in enumerate(ids)}
    sign = np.zeros(8)
    for r in got:
        i, c = at[r.vec_id], r.component - 1
        want = projected[i, c] / math.sqrt(values[c])
        assert abs(abs(r.whitened) - abs(want)) < 1e-9 and r.deviation == deviation[i] == int(r.deviation_exact) and r.n == len(ids)
        assert abs(r.explained - values[c] / trace) < 1e-10 and r.identity_error < 1e-9
        if abs(want) > 1e-3:  # one sign for all rows
            assert sign[c] in (0, np.sign(r.whitened * want))
            sign[c] = np.sign(r.whitened * want)


def test_op13_edges(spark):
    rnd = np.random.default_rng(6)
    rows = [(k, [float(x) for x in rnd.normal(0, 0.1, 5)]) for k in range(40)] + [(1, [0.5] * 5), (1, [0.5] * 5), (None, [0.1] * 5), (50, [2.0]), (51, []), (60, None), (61, [float("nan")] * 5), (62, [None, 1.0]), (63, [float("inf")])]
    df = spark.createDataFrame([(*r, 1, "x", 1, 2.0) for r in rows], SCHEMA).repartition(3)
    ids, deviation, projected, values, trace = brute_white(rows)
    got = whiten(df).collect()
    assert len(got) == 5 * len(ids) and {r.component for r in got} == {1, 2, 3, 4, 5}
    mine = sorted((str(r.vec_id), r.component, r.deviation, round(abs(r.whitened), 9) + 0.0) for r in got)
    assert mine == sorted((str(k), c + 1, deviation[i], round(abs(projected[i, c]) / math.sqrt(values[c]), 9) + 0.0) for i, k in enumerate(ids) for c in range(5))
    assert max(r.identity_error for r in got) < 1e-12
    assert whiten(df.limit(0)).count() == 0 and whiten(df.where("vec_id = 60")).columns == whiten(df).columns
    same = whiten(df.where("vec_id = 1 and embedding[0] = 0.5")).collect()
    assert len(same) == 10 and all(r.whitened is None and r.explained == 0 and r.identity_error is None and r.deviation == 0 and r.n == 2 for r in same)
    two = whiten(df.where("vec_id in (2, 3)")).collect()  # one direction alone varies
    assert {(r.component, r.whitened is None) for r in two} == {(1, False), *((c, True) for c in (2, 3, 4, 5))}
    assert {round(abs(r.whitened), 9) for r in two if r.component == 1} == {1.0} and max(r.identity_error for r in two) < 1e-9


def test_op13_beyond_longs():
    m = whitening.Moments(10**9, np.array([5, -5]), np.array([3, -4]))
    x = np.array([[5, -5], [100, -3000], [6, -5]])
    want = [sum((10**9 * (int(c) - int(k)) - int(r)) ** 2 for c, k, r in zip(row, m.middle, m.rest, strict=True)) for row in x]
    assert whitening.deviations(x, m) == want and want[1] > 1 << 63


def test_op13_covariance_keeps_its_digits(spark):
    """Components next to 65536 that differ by a thousandth: squares would leave no digits."""
    rnd = np.random.default_rng(8)
    rows = [(k, [65000 + int(x) / 1024 for x in rnd.integers(0, 9, 3)]) for k in range(200)]
    df = spark.createDataFrame([(k, v, 0, "x", 1, 1.0) for k, v in rows], SCHEMA.replace("array<float>", "array<double>"))
    _, _, projected, values, _ = brute_white(rows)
    got = whiten(df).orderBy("vec_id", "component").collect()
    assert max(abs(abs(r.whitened) - abs(projected[r.vec_id, r.component - 1]) / math.sqrt(values[r.component - 1])) for r in got) < 1e-9
    assert vector_codes.compress(df).count() == 200
