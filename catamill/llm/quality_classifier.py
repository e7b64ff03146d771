"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata of the text.

Pairwise interactions have low rank, so a row is scored in time linear in its features by the sum-of-squares identity:
sum over pairs of <v_i, v_j> x_i x_j = 1/2 sum over factors of ((sum v_if x_i)^2 - sum v_if^2 x_i^2). The model is
fitted on a bounded sample of the labelled rows (about `sample` rows, drawn by a hash of their ids before any text is
read), shards of which are trained in tasks side by side and averaged between epochs. Rows held back from training fit
the curve that turns margins into scores; scoring covers every row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catamill.llm.arrow_text import slices, split_words, texts
from catamill.llm.common import written

STATISTICS = 12


@dataclass(frozen=True)
class Fit:
    """sample: labelled rows to learn from, about. buckets: of hashed words, a power of two. rank: of the interactions.
    shards: parts trained side by side; rounds: times they are averaged; epochs: passes over a shard in a round, more
    where a shard has so few rows that they make less than `steps` steps of `batch` rows."""

    sample: int = 6000
    buckets: int = 8192
    rank: int = 6
    shards: int = 4
    rounds: int = 3
    epochs: int = 4
    steps: int = 40
    batch: int = 32
    rate: float = 0.05
    decay: float = 1e-5
    seed: int = 3

    @property
    def width(self) -> int:
        return STATISTICS + self.buckets


@dataclass(frozen=True)
class Model:
    fit: Fit
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    #: Of the logistic curve from margins to scores.
    slope: float = 1.0
    shift: float = 0.0


STEP = 2 << 20


def features(text: pa.Array, fit: Fit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the non-zero features. Words: hashed, lower case, without repeats, as unit rows.
    Statistics: shares and logarithms, about 0 to 1; metadata is what the text itself tells (its length in characters, words and lines)."""
    n = len(text)
    index, words, ends = split_words(pc.ascii_lower(text))
    row = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    bucket = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words)) & (fit.buckets - 1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    pairs = np.unique(row * fit.buckets + bucket[index])
    rows, columns = pairs // fit.buckets, pairs % fit.buckets + STATISTICS
    distinct = np.bincount(rows, minlength=n)
    values = 1 / np.sqrt(np.maximum(distinct, 1))[rows]

    number = lambda pattern: pc.count_substring_regex(text, pattern).to_numpy(zero_copy_only=False).astype(np.float64)
    chars = np.maximum(pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.float64), 1)
    n_words = np.bincount(row, minlength=n).astype(np.float64)
    some = np.maximum(n_words, 1)
    lines = number(r"\n") + 1
    # Shares of repeated neighbours and of distinct words tell repetition.
    same = np.zeros(len(index), bool)
    same[1:] = (index[1:] == index[:-1]) & (row[1:] == row[:-1])
    kinds = np.unique(row * (len(words) + 1) + index) // (len(words) + 1)
    stats = np.stack(
        [
            np.log1p(chars) / 12, np.log1p(n_words) / 10, np.log1p(lines) / 8, np.bincount(row, weights=size[index], minlength=n) / some / 10,
            number(r"[A-Z]") / chars * 2, number(r"[#*$%&|<>]") / chars * 4, number(r"[.,;:]") / chars * 4, number(r"[!?]") / chars * 4,
            number(r"[0-9]") / chars * 4, np.bincount(row[same], minlength=n) / some, np.bincount(kinds, minlength=n) / some, some < 50,
        ],
        axis=1,
    )
    r, c = np.nonzero(stats)
    return np.concatenate([rows, r]), np.concatenate([columns, c]), np.concatenate([values, stats[r, c]]).astype(np.float32)


def margins(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """The machine's output of each row, and the rows' factor sums."""
    vx = m.factors[columns] * values[:, None]
    sums = np.zeros((n, m.factors.shape[1]))
    squares = np.zeros(n)
    for f in range(m.factors.shape[1]):
        sums[:, f] = np.bincount(rows, weights=vx[:, f], minlength=n)
    squares += np.bincount(rows, weights=(vx * vx).sum(axis=1), minlength=n)
    linear = np.bincount(rows, weights=m.linear[columns] * values, minlength=n)
    return m.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def start(fit: Fit) -> Model:
    return Model(fit, 0.0, np.zeros(fit.width, np.float32), np.random.default_rng(fit.seed).normal(0, 0.05, (fit.width, fit.rank)).astype(np.float32))


def descend(m: Model, sets: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Model:
    """Adagrad over minibatches of (rows, columns, values, labels)."""
    fit, bias, w, v = m.fit, m.bias, m.linear.copy(), m.factors.copy()
    gw, gv, gb = np.full_like(w, 1e-3), np.full_like(v, 1e-3), 1e-3
    order = np.random.default_rng(fit.seed)
    for _ in range(max(fit.epochs, -(-fit.steps // max(1, len(sets))))):
        for k in order.permutation(len(sets)):
            rows, columns, values, y = sets[k]
            out, sums = margins(rows, columns, values, len(y), Model(fit, bias, w, v))
            slope = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y) / len(y)
            gb += (g := slope.sum()) ** 2
            bias -= fit.rate * g / np.sqrt(gb)
            used, at = np.unique(columns, return_inverse=True)
            sx = slope[rows] * values
            g = np.bincount(at, weights=sx, minlength=len(used)) + fit.decay * w[used]
            gw[used] += g * g
            w[used] -= fit.rate * g / np.sqrt(gw[used])
            x2 = np.bincount(at, weights=sx * values, minlength=len(used))
            gf = np.stack([np.bincount(at, weights=sx * sums[rows, f], minlength=len(used)) for f in range(v.shape[1])], axis=1) - v[used] * x2[:, None] + fit.decay * v[used]
            gv[used] += gf * gf
            v[used] -= fit.rate * gf / np.sqrt(gv[used])
    return Model(fit, float(bias), w, v)


def sampled(docs: DataFrame, labels: DataFrame, fit: Fit) -> DataFrame:
    """text, label, shard of about `sample` rows. Labels are drawn by a hash of their id, so no text is moved but those
    drawn; where ids repeat in docs, their rows are drawn once more by place. Each fifth row is held back (shard -1)."""
    marks = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).count()
    hash_of = lambda seed, *c: F.pmod(F.xxhash64(*c, F.lit(seed)), F.lit(1 << 30))
    marks = written(marks.select("doc_id", "label", hash_of(fit.seed, "doc_id", "label").alias("draw")), "labelled")
    few = marks.where(F.col("draw") < min(1.0, fit.sample / max(1, marks.count())) * (1 << 30)).select("doc_id", "label")
    # About `sample` short rows, whatever the input.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), "doc_id")
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    held_back = hash_of(fit.seed + 2, "doc_id", "place") % 5 == 0
    shard = F.when(held_back, -1).otherwise((hash_of(fit.seed + 1, "doc_id", "place") % fit.shards).cast("int"))
    rows = written(rows.select("text", "label", shard.alias("shard"), hash_of(fit.seed + 3, "doc_id", "place").alias("draw")), "quality-sample")
    n = rows.count()
    return rows if n <= 2 * fit.sample else written(rows.where(F.col("draw") < fit.sample / n * (1 << 30)), "quality-sample")


def calibration(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits labels to margins, with Platt's smoothed targets; Newton's method."""
    good = label > 0.5
    n1, n0 = int(good.sum()), int((~good).sum())
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(good, 1 / max(n1, 1), 1 / max(n0, 1)) * (n1 + n0) / 2  # both labels count alike
    scale = margin.std() or 1.0
    x = np.stack([margin / scale, np.ones(len(margin))], axis=1)
    b = np.array([1.0, 0.0])
    loss = lambda b: float((weight * (np.logaddexp(0, x @ b) - target * (x @ b))).sum() + 1e-3 * b @ b)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (p - target)) + 2e-3 * b
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 2e-3 * np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and loss(b - size * step) > loss(b):
            size /= 2
        b = b - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(max(b[0], 1e-3) / scale), float(b[1])


def _margin_rows(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Margins and labels of sampled rows: two numbers a row."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, STEP):
            out, _ = margins(*features(texts(batch.column(0)), model.fit), batch.num_rows, model)
            yield pa.RecordBatch.from_arrays([pa.array(out), batch.column(1)], ["margin", "label"])

    found = rows.select("text", "label").mapInArrow(run, "margin double, label int").orderBy("margin", "label").collect()
    return np.array([r.margin for r in found]), np.array([r.label for r in found], np.float64)


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model | None:
    """docs: doc_id, text. labels: doc_id, label (0 or 1; null: not labelled). Null texts are empty. Labels of one id that
    differ all count, equal ones once. None without any label. Rows held back from training calibrate the scores; the
    curve is fitted on all sampled rows where those held back lack a label."""
    few = sampled(docs, labels, fit)
    if not few.limit(1).count():
        return None
    model = start(fit)
    kept = few.where(F.col("shard") >= 0).select("text", "label", "shard")
    for _ in range(fit.rounds):
        packed = model.bias, model.linear.tobytes(), model.factors.tobytes()

        def shard(pdf: pd.DataFrame) -> pd.DataFrame:
            bias, linear, factors = packed  # noqa: B023  used at once, before the next round
            m = Model(fit, bias, np.frombuffer(linear, np.float32), np.frombuffer(factors, np.float32).reshape(fit.width, fit.rank))
            pdf = pdf.sort_values(["text", "label"])
            pdf = pdf.iloc[np.random.default_rng(fit.seed).permutation(len(pdf))]
            sets = []
            for k in range(0, len(pdf), fit.batch):
                part = pdf.iloc[k : k + fit.batch]
                sets.append((*features(pa.array(part["text"], pa.large_string()), fit), part["label"].to_numpy(np.float64)))
            m = descend(m, sets)
            return pd.DataFrame({"n": [len(pdf)], "bias": [m.bias], "linear": [m.linear.astype(np.float32).tobytes()], "factors": [m.factors.astype(np.float32).tobytes()]})

        parts = kept.groupBy("shard").applyInPandas(shard, "n long, bias double, linear binary, factors binary").orderBy("n", "bias").collect()  # one model per shard
        if not parts:
            break
        share = np.array([p.n for p in parts]) / sum(p.n for p in parts)
        mean = lambda xs: np.tensordot(share, np.stack([np.frombuffer(bytes(x), np.float32) for x in xs]), 1).astype(np.float32)  # noqa: B023, E731
        model = Model(fit, float(share @ [p.bias for p in parts]), mean([p.linear for p in parts]), mean([p.factors for p in parts]).reshape(fit.width, fit.rank))
    margin, label = _margin_rows(few.where(F.col("shard") < 0), model)
    if not 0 < label.sum() < len(label):
        margin, label = _margin_rows(few, model)
    slope, shift = calibration(margin, label)
    return replace(model, slope=slope, shift=shift)


def score(docs: DataFrame, model: Model | None, into: str = "score") -> DataFrame:
    """docs with a column `into` (in place of one of that name): 0 to 1, higher where label 1 is likelier. Null texts are
    empty and scored as such; without a model all scores are 0.5. Equal texts, also very long ones, have equal scores, so
    repeated rows do; empty tables stay empty. Other columns stay as they are, whatever their names."""
    kept = [c for c in docs.columns if c != into]
    at = kept.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # width * (rank + 1) floats
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn(into, F.lit(0.0)).schema

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, at, STEP):
            out = np.zeros(batch.num_rows)
            if model:
                out, _ = margins(*features(texts(batch.column(at)), model.fit), batch.num_rows, model)
                out = model.slope * out + model.shift
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))], [*kept, into])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)
