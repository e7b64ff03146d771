"""Language identification: nearest centroid over normalised TF-IDF vectors of hashed byte n-grams, several clustered
centroids per language, cosine similarity, and rejection by distance.

Document frequencies of n-grams are counted over all labelled rows, in tasks, and summed by Spark. Each language's
vectors are then clustered in a task of its own, on a bounded sample (at most about `per_language` rows of each language,
drawn by a hash of the text and its id). Scoring covers every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catamill.llm.arrow_text import slices, texts
from catamill.llm.common import join_lookup, row_draw, written

UNKNOWN = "und"
LETTER = r"\pL"


@dataclass(frozen=True)
class Fit:
    """per_language: rows of a language to learn from, about. orders: lengths of the byte n-grams. buckets: of the hash, a
    power of two. clusters: centroids per language. reject: share of a language's own rows that its radius leaves out,
    slack: what that radius is widened by (in cosine distance). seed: of the hash that draws the sample."""

    per_language: int = 1000
    orders: tuple[int, ...] = (2, 3)
    buckets: int = 4096
    clusters: int = 4
    rounds: int = 8
    reject: float = 0.005
    slack: float = 0.1
    seed: int = 7


@dataclass(frozen=True)
class Model:
    fit: Fit
    idf: np.ndarray  # by bucket
    centroids: np.ndarray  # unit rows
    languages: list[str]  # of each centroid
    radius: np.ndarray  # largest cosine distance of each centroid's language


STEP, BLOCK = 1 << 20, 1 << 20
_TABLE = np.random.default_rng(11).integers(1, 1 << 31, size=(8, 256), dtype=np.int64) | 1


def counts(text: pa.Array, fit: Fit) -> np.ndarray:
    """n-gram counts, one row per text. Case is folded, and whatever is no letter is one space between words."""
    folded = pc.replace_substring_regex(pc.utf8_lower(text), r"[^\pL]+", " ")
    n = len(folded)
    ends = np.frombuffer(folded.buffers()[1], np.int64, n + 1, folded.offset * 8)
    data = np.frombuffer(folded.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    past = ends[1:] - ends[0]
    out = np.zeros(n * fit.buckets, np.int64)
    for order in fit.orders:
        # In blocks of bytes that overlap by an n-gram, so that a very long text needs no more than others.
        for low in range(0, max(0, len(data) - order + 1), BLOCK):
            part = data[low : low + BLOCK + order - 1].astype(np.int64)
            row = np.searchsorted(past, np.arange(low, low + len(part)), side="right")
            h = np.zeros(len(part) - order + 1, np.int64)
            for k in range(order):
                h += _TABLE[k + 1][part[k : len(h) + k]] * (order * 2 + 1)
            h ^= h >> 15
            first = row[: len(h)]
            at = (first * fit.buckets + ((h * 0x9E3779B1) >> 16 & (fit.buckets - 1)))[first == row[order - 1 :]]
            out += np.bincount(at, minlength=len(out))
    return out.reshape(n, fit.buckets)


def vectors(text: pa.Array, idf: np.ndarray, fit: Fit) -> np.ndarray:
    """Unit TF-IDF rows (logarithmic term frequency); a row of zeros for a text without letters."""
    x = np.log1p(counts(text, fit)).astype(np.float32) * idf
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(size, 1e-9)


def cluster(x: np.ndarray, fit: Fit) -> tuple[np.ndarray, float]:
    """Spherical k-means from the row nearest the mean and then the farthest rows; centroids and the radius."""
    start = [int(np.argmax(x @ x.mean(axis=0)))]
    near = x @ x[start[0]]
    while len(start) < min(fit.clusters, len(x)):
        start.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[start[-1]])
    c = x[start]
    for _ in range(fit.rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[own == k].mean(axis=0) if (own == k).any() else c[k] for k in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    distance = 1 - (x @ c.T).max(axis=1)
    return c, float(np.quantile(distance, 1 - fit.reject) + fit.slack)


def train(labelled: DataFrame, fit: Fit = Fit()) -> Model | None:
    """labelled: text, lang, and doc_id if there is one. Null langs and texts without letters teach nothing; None if nothing
    is left, as of an empty table. Repeated rows count as often as they stand there, and are drawn one by one."""
    rows = labelled.where(F.col("lang").isNotNull() & F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")).withColumn("lang", F.col("lang").cast("string"))
    sizes = written(rows.groupBy("lang").count(), "langs")  # one row per language
    draw = F.pmod(row_draw(rows, fit.seed), F.lit(1 << 30)) / float(1 << 30)
    few = join_lookup(rows.withColumn("draw", draw).select("lang", "text", "draw"), sizes, ["lang"], "inner")
    few = written(few.where(F.col("draw") * F.col("count") < fit.per_language).select("lang", "text"), "lang-sample")

    def frequencies(batches) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(fit.buckets, np.int64), 0
        for batch in slices(batches, 0, STEP):
            for at in range(0, batch.num_rows, 500):
                part = texts(batch.column(0).slice(at, 500))
                total, n = total + (counts(part, fit) > 0).sum(axis=0), n + len(part)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.flatnonzero(total), -1)), pa.array(np.append(total[total > 0], n))], ["bucket", "n"])

    df = {r.bucket: r.n for r in rows.select("text").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # buckets + 1 rows at most
    if not df.get(-1):
        return None
    idf = np.log((1 + df[-1]) / (1 + np.array([df.get(b, 0) for b in range(fit.buckets)], np.float64))).astype(np.float32) + 1

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        text = pa.array(sorted(pdf["text"]), pa.large_string())
        x = np.concatenate([vectors(text.slice(k, 100).take(np.arange(min(100, len(text) - k))), idf, fit) for k in range(0, len(text), 100)])
        c, radius = cluster(x, fit)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "cluster": np.arange(len(c)), "radius": radius, "centroid": [v.tobytes() for v in c]})

    found = few.groupBy("lang").applyInPandas(group, "lang string, cluster int, radius double, centroid binary").orderBy("lang", "cluster").collect()  # clusters rows per language
    return Model(fit, idf, np.stack([np.frombuffer(bytes(r.centroid), np.float32) for r in found]), [r.lang for r in found], np.array([r.radius for r in found]))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, distance, rejected of every row of docs (doc_id, text; others are not read).

    lang_pred: the language of the nearest centroid, also beyond its radius (rejected is true there). score: how much
    nearer it is than the nearest of another language, 0.5 for as near, 1 for twice as near or more in cosine. Texts
    that are null or have no letter, and all texts without a model, are `und` with score 0, no distance, and rejected.
    Between languages that are as near, the first by name counts. Texts are read whole, very long ones in blocks, and
    equal texts are told alike, so repeated rows are; an empty table gives no rows.
    """
    names = sorted(set(model.languages)) if model else []
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets * clusters * languages floats

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, 1, STEP):
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                text, n = texts(part.column(1)), part.num_rows
                letters = pc.match_substring_regex(text, LETTER).to_numpy(zero_copy_only=False) & bool(model)
                pred, score, distance, rejected = np.full(n, UNKNOWN, object), np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
                if letters.any():
                    near = vectors(text, model.idf, model.fit) @ model.centroids.T
                    best = np.stack([near[:, [k for k, x in enumerate(model.languages) if x == name]].max(axis=1) for name in names], axis=1)
                    top = best.argmax(axis=1)
                    radius = np.array([model.radius[model.languages.index(name)] for name in names])[top]
                    first = best[np.arange(n), top].astype(np.float64)
                    best[np.arange(n), top] = -1
                    second = np.maximum(best.max(axis=1) if len(names) > 1 else np.zeros(n), 0)
                    margin = np.clip(first / np.maximum(first + second, 1e-9), 0, 1)
                    pred[letters] = np.array(names, object)[top][letters]
                    score[letters] = np.clip(0.5 + (margin - 0.5) * 3, 0, 1)[letters]
                    distance[letters] = (1 - first)[letters]
                    rejected[letters] = (1 - first > radius)[letters]
                columns = [part.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(distance, pa.float64(), mask=~letters), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "distance", "rejected"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, distance double, rejected boolean")
