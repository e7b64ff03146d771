"""Toxicity: a convolutional classifier over hashed word embeddings, trained in numpy, with thresholds by language.

A text is the sequence of its words (runs of letters and digits, lower case), each hashed to a row of an embedding.
Filters of several widths slide over it, the largest response of each filter is kept, and a logistic layer weighs these.
A filter's response is the sum of what each word under it adds, so these shares are computed once for each word that was
seen and gathered from there.

The model is fitted on a bounded sample of the labelled rows, which tasks turn into word numbers; one task trains on it,
as gradients touch but the words under the largest responses. Rows held back choose the threshold of each language. A
text's language is read off its words by naive Bayes, never from a column, and the score is shifted so that 0.5 is that
language's threshold. Scoring covers every row and whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catamill.llm.arrow_text import slices, split_words, texts
from catamill.llm.common import written


@dataclass(frozen=True)
class Fit:
    """sample: labelled rows to learn from, of each label, about; words: of all of them together, about (at least one row
    each). buckets: of hashed words, a power of two. size: of an embedding. widths: of filters; filters: of each width.
    epochs, batch, rate, decay: of the descent. languages: that have a threshold of their own, the most frequent ones."""

    sample: int = 5000
    words: int = 8_000_000
    buckets: int = 1 << 18
    size: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 5
    batch: int = 32
    rate: float = 0.05
    decay: float = 1e-4
    languages: int = 64
    seed: int = 7

    @property
    def shares(self) -> int:
        """Numbers that a word adds to responses: one for each filter and place under it."""
        return sum(self.widths) * self.filters


@dataclass(frozen=True)
class Net:
    """seen, embedding: the words of the sample, rising, and their rows; other words are zeros. kernels: size x shares, by
    width and place. bias, weight: of each filter's largest response; base: of the output."""

    seen: np.ndarray
    embedding: np.ndarray
    kernels: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    base: float


@dataclass(frozen=True)
class Model:
    """names, tongue: languages and what each seen word adds to their log-likelihood, prior: theirs. shift: of the margins
    of each language, and the last of all others. slope: from margins to scores."""

    fit: Fit
    net: Net
    names: list[str]
    tongue: np.ndarray
    prior: np.ndarray
    slope: float
    shift: np.ndarray


STEP = 2 << 20
#: Words of a text that are convolved at once.
SPAN = 1 << 17


def word_numbers(text: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, one text after another, and the end of each text's words."""
    index, words, ends = split_words(pc.replace_substring_regex(pc.utf8_lower(text), r"[^\pL\pN]+", " "))
    bucket = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words)) & (buckets - 1)
    return bucket[index].astype(np.int32), ends.astype(np.int64)


def rows_of(net: Net, numbers: np.ndarray) -> np.ndarray:
    """1 and up: place among the seen words; 0: unseen."""
    at = np.searchsorted(net.seen, numbers)
    at[at == len(net.seen)] = 0
    return np.where(net.seen[at] == numbers, at + 1, 0) if len(net.seen) else np.zeros(len(numbers), np.int64)


def largest(shares: np.ndarray, rows: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter along a text's rows, and where it begins; zeros follow the text's end."""
    k, wide = fit.filters, max(fit.widths)
    count = max(1, len(rows))
    padded = np.concatenate([rows, np.zeros(wide, rows.dtype)])
    best, place = np.full(k * len(fit.widths), -np.inf, np.float32), np.zeros(k * len(fit.widths), np.int64)
    for lo in range(0, count, SPAN):
        own = padded[lo : lo + min(SPAN, count - lo) + wide - 1]
        n, at = len(own) - wide + 1, 0
        for w, width in enumerate(fit.widths):
            response = shares[own[:n], at : at + k]
            for o in range(1, width):
                response = response + shares[own[o : n + o], at + o * k : at + (o + 1) * k]
            top = response.argmax(axis=0)
            high = response[top, np.arange(k)]
            better = high > best[w * k : (w + 1) * k]
            best[w * k : (w + 1) * k][better], place[w * k : (w + 1) * k][better] = high[better], top[better] + lo
            at += width * k
    return best, place


def _starts(rows: list[np.ndarray], label: np.ndarray, fit: Fit) -> Net:
    """Embeddings start at random but for the first number, which starts at what the word tells of the label: its log-odds
    over texts, less one standard error; the first filter of each width looks at it."""
    seen, inverse = np.unique(np.concatenate([*rows, np.zeros(0, np.int32)]), return_inverse=True)
    draw = np.random.default_rng(fit.seed)
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    pairs = np.unique(text * max(1, len(seen)) + inverse)
    bad = label[pairs // max(1, len(seen))] > 0.5
    word = pairs % max(1, len(seen))
    n1, n0 = max(1.0, label.sum()), max(1.0, len(label) - label.sum())
    has1, has0 = np.bincount(word[bad], minlength=len(seen)) + 0.5, np.bincount(word[~bad], minlength=len(seen)) + 0.5
    odds = np.log(has1 / (n1 + 1)) - np.log(has0 / (n0 + 1))
    sure = np.sign(odds) * np.maximum(0, np.abs(odds) - np.sqrt(1 / has1 + 1 / has0))
    embedding = draw.normal(0, 0.05, (len(seen), fit.size)).astype(np.float32)
    if len(seen):
        embedding[:, 0] = sure / 2
    kernels = draw.normal(0, 0.3, (fit.size, fit.shares)).astype(np.float32)
    weight, at = draw.normal(0, 0.1, fit.filters * len(fit.widths)).astype(np.float32), 0
    for w, width in enumerate(fit.widths):
        for o in range(width):
            kernels[0, at + o * fit.filters] = 1.0
        weight[w * fit.filters] = 1.0
        at += width * fit.filters
    return Net(seen.astype(np.int64), embedding, kernels, np.zeros(len(weight), np.float32), weight, 0.0)


def slopes(net: Net, fit: Fit, rows: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray | float], np.ndarray]:
    """Weighted mean loss of texts (rows: places among the seen words plus one), its slopes, and the places that `embedding`'s
    slopes are of. Filters' responses go through tanh."""
    used, inverse = np.unique(np.concatenate([*rows, np.zeros(1, np.int64)]), return_inverse=True)  # 0 is always there, and first
    table = np.vstack([np.zeros((1, fit.size), np.float32), net.embedding[used[1:] - 1]])
    shares = table @ net.kernels
    local, begin = [], 0
    for r in rows:
        local.append(inverse[begin : begin + len(r)])
        begin += len(r)
    found = [largest(shares, r, fit) for r in local]
    high = np.stack([b for b, _ in found])
    h = np.tanh(high + net.bias)
    out = h @ net.weight + net.base
    total = weight.sum()
    loss = float((weight * (np.logaddexp(0, out) - label * out)).sum() / total)
    slope = weight * (1 / (1 + np.exp(-np.clip(out, -30, 30))) - label) / total
    back = slope[:, None] * net.weight * (1 - h * h)
    on_table, on_kernels, k = np.zeros_like(table, dtype=np.float64), np.zeros(net.kernels.shape), fit.filters
    places = np.stack([p for _, p in found])
    wide = max(fit.widths)
    padded = np.concatenate([np.concatenate([r, np.zeros(wide, np.int64)]) for r in local])
    starts = np.concatenate([[0], np.cumsum([len(r) + wide for r in local])[:-1]])
    at = 0
    for w, width in enumerate(fit.widths):
        g = back[:, w * k : (w + 1) * k]
        for o in range(width):
            word = padded[starts[:, None] + places[:, w * k : (w + 1) * k] + o]
            column = np.broadcast_to(np.arange(at + o * k, at + (o + 1) * k), word.shape)
            np.add.at(on_table, word.reshape(-1), (g[:, :, None] * net.kernels[:, column].transpose(1, 2, 0)).reshape(-1, fit.size))
            np.add.at(on_kernels.T, column.reshape(-1), (g[:, :, None] * table[word]).reshape(-1, fit.size))
        at += width * k
    return loss, {"embedding": on_table[1:], "kernels": on_kernels, "bias": back.sum(axis=0), "weight": slope @ h, "base": float(slope.sum())}, used[1:] - 1


def descend(net: Net, fit: Fit, rows: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> Net:
    """Adagrad over minibatches."""
    order, eps = np.random.default_rng(fit.seed + 1), 1e-3
    parts = {"embedding": net.embedding.copy(), "kernels": net.kernels.copy(), "bias": net.bias.copy(), "weight": net.weight.copy(), "base": np.float32(net.base)}
    squares = {name: np.full_like(v, eps) for name, v in parts.items()}
    for _ in range(fit.epochs):
        deal = order.permutation(len(rows))
        for lo in range(0, len(deal), fit.batch):
            some = deal[lo : lo + fit.batch]
            now = Net(net.seen, **parts)
            _, by, used = slopes(now, fit, [rows[k] for k in some], label[some], weight[some])
            for name, g in by.items():
                if name == "embedding":
                    g = g + fit.decay * parts[name][used]
                    squares[name][used] += g * g
                    parts[name][used] -= fit.rate * g / np.sqrt(squares[name][used])
                else:
                    if name != "base":
                        g = g + fit.decay * parts[name]
                    squares[name] = squares[name] + g * g
                    parts[name] = (parts[name] - fit.rate * g / np.sqrt(squares[name])).astype(np.float32)
    return Net(net.seen, **(parts | {"base": float(parts["base"])}))


class Scorer:
    """What all seen words add to responses, computed once for a task, so that a text's margin depends on nothing beside it."""

    def __init__(self, net: Net, fit: Fit):
        self.net, self.fit = net, fit
        shares = np.vstack([np.zeros((1, fit.size), np.float32), net.embedding]) @ net.kernels
        k = fit.filters
        self.shares = [np.ascontiguousarray(shares[:, at : at + k]) for at in range(0, fit.shares, k)]

    def rows(self, numbers: np.ndarray) -> np.ndarray:
        distinct, inverse = np.unique(numbers, return_inverse=True)
        return rows_of(self.net, distinct)[inverse]

    def margins(self, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The output of each text; rows: of all words, one text after another."""
        fit, wide, texts_ = self.fit, max(self.fit.widths), len(ends)
        sizes = np.diff(ends, prepend=0)
        # Each text with zeros behind it, in which its last windows end.
        begin = np.cumsum(sizes + wide) - sizes - wide
        padded = np.zeros(len(rows) + wide * (texts_ + 1), rows.dtype)
        padded[np.arange(len(rows)) + np.repeat(begin - (ends - sizes), sizes)] = rows
        end = begin + np.maximum(sizes, 1)
        best = np.full((texts_, fit.filters * len(fit.widths)), -np.inf, np.float32)
        for lo in range(0, int(end[-1]) if texts_ else 0, SPAN):
            hi = min(lo + SPAN, int(end[-1]))
            first, last = np.searchsorted(end, lo, side="right"), np.searchsorted(begin, hi, side="left")
            if first >= last:
                continue
            cuts = np.stack([np.maximum(begin[first:last], lo), np.minimum(end[first:last], hi)], axis=1).reshape(-1) - lo
            cuts = cuts[:-1] if cuts[-1] == hi - lo else cuts
            at = 0
            for w, width in enumerate(fit.widths):
                response = np.take(self.shares[at], padded[lo:hi], axis=0)
                for o in range(1, width):
                    response += np.take(self.shares[at + o], padded[lo + o : hi + o], axis=0)
                own = best[first:last, w * fit.filters : (w + 1) * fit.filters]
                np.maximum(own, np.maximum.reduceat(response, cuts, axis=0)[::2], out=own)
                at += width
        return (np.tanh(best + self.net.bias) * self.net.weight).sum(axis=1, dtype=np.float64) + self.net.base


def language_of(tongue: np.ndarray, prior: np.ndarray, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each text's likeliest language, the first among equals; -1 where none is known. tongue: by row, whole thousandths."""
    total = np.tile(prior, (len(ends), 1))
    if not len(prior):
        return np.full(len(ends), -1)
    some = np.flatnonzero(np.diff(ends, prepend=0))
    if len(some):
        total[some] += np.add.reduceat(np.take(tongue, rows, axis=0), np.concatenate([[0], ends[:-1]])[some], axis=0, dtype=np.int64)
    return total.argmax(axis=1)


def _tongues(net: Net, rows: list[np.ndarray], language: list[str | None], most: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, what each word adds to their log-likelihood (by row, 0 for unseen words), and their log shares of the rows,
    in whole thousandths, whose sums are exact."""
    known = pd.Series(language).dropna()
    names = sorted(known.value_counts().sort_index(kind="stable").sort_values(ascending=False, kind="stable").index[:most])
    counts = np.zeros((len(net.seen) + 1, len(names)))
    for r, of in zip(rows, language, strict=True):
        if of in names:
            counts[:, names.index(of)] += np.bincount(r, minlength=len(net.seen) + 1)
    counts[0] = 0
    if not names:
        return [], counts.astype(np.int32), np.zeros(0, np.int64)
    likely = np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * len(counts)))
    likely[0] = 0
    share = np.array([(known == n).sum() for n in names], np.float64)
    return names, np.rint(likely * 1000).astype(np.int32), np.rint(np.log(share / share.sum()) * 1000).astype(np.int64)


def _logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, around: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """Coefficients of the weighted logistic curve, held near `around` by `ridge`; Newton's method with halved steps."""
    b = around.copy()
    loss = lambda b: float((weight * (np.logaddexp(0, x @ b) - target * (x @ b))).sum() + (ridge * (b - around) ** 2).sum())
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (p - target)) + 2 * ridge * (b - around)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(2 * ridge + 1e-9), slope)
        size = 1.0
        while size > 1e-6 and loss(b - size * step) > loss(b):
            size /= 2
        b = b - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return b


def calibrated(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, language: np.ndarray, languages: int) -> tuple[float, np.ndarray]:
    """The slope of all rows, and the shift of each language and of others (last): a language's shift is held near that of
    all rows, the more the fewer of its rows there are."""
    n1, n0 = max(1, int((label > 0.5).sum())), max(1, int((label <= 0.5).sum()))
    target = np.where(label > 0.5, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = float(margin.std()) or 1.0
    both = _logistic(np.stack([margin / scale, np.ones(len(margin))], axis=1), target, weight, np.array([1.0, 0.0]), np.array([1e-3, 1e-3]))
    slope, shift = max(float(both[0]), 1e-2) / scale, float(both[1])
    shifts = np.full(languages + 1, shift)
    for k in range(languages):
        own = language == k
        if own.any():
            shifts[k] = _shift(slope * margin[own], target[own], weight[own], shift)
    return slope, shifts


def _shift(offset: np.ndarray, target: np.ndarray, weight: np.ndarray, around: float, ridge: float = 2.0) -> float:
    """The shift of a logistic curve of slope 1 over `offset`, held near `around`."""
    b = around
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(offset + b, -30, 30)))
        step = ((weight * (p - target)).sum() + 2 * ridge * (b - around)) / ((weight * p * (1 - p)).sum() + 2 * ridge)
        b -= float(np.clip(step, -1, 1))
        if abs(step) < 1e-9:
            break
    return b


def _bits(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def sampled(docs: DataFrame, labels: DataFrame, fit: Fit) -> DataFrame:
    """doc_id, label, weight, lang, draw, ids of about `sample` rows of each label. Labels are drawn by a hash of their id,
    so no text moves but those drawn, and these as word numbers. weight: labelled rows that a drawn one stands for."""
    draw = F.pmod(F.xxhash64("doc_id", "label", F.lit(fit.seed)), F.lit(1 << 30))
    marks = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).distinct()
    marks = written(marks.withColumn("draw", draw), "toxic-labels")
    count = {r.label: r["count"] for r in marks.groupBy("label").count().collect()}  # two rows at most
    share = lambda k: min(1.0, fit.sample / max(1, count.get(k, 0)))
    level = F.when(F.col("label") == 1, F.lit(share(1))).otherwise(F.lit(share(0)))
    few = marks.where(F.col("draw") < level * (1 << 30)).withColumn("weight", 1 / level)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), lang.cast("string").alias("lang"))
    rows = rows.join(F.broadcast(few), "doc_id").select("doc_id", "label", "weight", "lang", "text")  # about 2 * `sample` short rows, whatever the input
    schema = "doc_id long, label int, weight double, lang string, ids binary"

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4, STEP):
            numbers, ends = word_numbers(texts(batch.column(4)), fit.buckets)
            begins = np.concatenate([[0], ends[:-1]])
            ids = [_bits(numbers[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(ids, pa.binary())], ["doc_id", "label", "weight", "lang", "ids"])

    again = F.pmod(F.xxhash64("doc_id", "label", "ids", F.lit(fit.seed + 1)), F.lit(1 << 30))
    out = written(rows.mapInArrow(run, schema).withColumn("again", again), "toxic-sample")
    n, size = out.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("ids")), F.lit(0))).first()
    # Repeated ids and long texts may make the sample larger than was asked for: then a part of it, by another hash.
    part = min(1.0, 2 * 2 * fit.sample / max(1, n), 4 * fit.words / max(1, size))
    return out if part == 1.0 else written(out.where(F.col("again") < part * (1 << 30)), "toxic-sample")


MODEL = "seen binary, embedding binary, kernels binary, bias binary, weight binary, base double, names array<string>, tongue binary, prior binary, slope double, shift binary"


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model | None:
    """docs: doc_id, text, and lang if known. labels: doc_id, label (0 or 1; null: not labelled). Null texts are empty;
    labels of one id that differ all count, equal ones once. None without any label. A fifth of the sample, by a hash of
    its ids and words, trains nothing and sets slope and thresholds; where it lacks a label, the whole sample does."""
    few = sampled(docs, labels, fit)
    if not few.limit(1).count():
        return None

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["again", "doc_id", "label", "ids"]).reset_index(drop=True)
        numbers = [np.frombuffer(x, np.int32).astype(np.int64) for x in pdf["ids"]]
        label, weight = pdf["label"].to_numpy(np.float64), pdf["weight"].to_numpy(np.float64)
        back = (pdf["again"] % 5 == 0).to_numpy()
        kept = np.flatnonzero(~back) if (~back).any() else np.arange(len(pdf))
        net = _starts([numbers[k] for k in kept], label[kept], fit)
        rows = [rows_of(net, x) for x in numbers]
        net = descend(net, fit, [rows[k] for k in kept], label[kept], np.ones(len(kept)))
        names, tongue, prior = _tongues(net, [rows[k] for k in kept], [pdf["lang"][k] for k in kept], fit.languages)
        use = np.flatnonzero(back) if 0 < label[back].sum() < back.sum() else np.arange(len(pdf))
        ends = np.cumsum([len(rows[k]) for k in use])
        flat = np.concatenate([rows[k] for k in use])
        margin, tongues = Scorer(net, fit).margins(flat, ends), language_of(tongue, prior, flat, ends)
        slope, shift = calibrated(margin, label[use], weight[use] / weight[use].mean(), tongues, len(names))
        one = [_bits(net.seen), _bits(net.embedding), _bits(net.kernels), _bits(net.bias), _bits(net.weight), net.base, names, _bits(tongue), _bits(prior), slope, _bits(shift)]
        return pd.DataFrame({name.split()[0]: [v] for name, v in zip(MODEL.split(", "), one, strict=True)})

    # One group of bounded rows and words.
    r = written(few.groupBy(F.lit(0).alias("all")).applyInPandas(run, MODEL), "toxic-model").first()
    array = lambda name, kind=np.float32: np.frombuffer(bytes(r[name]), kind)
    net = Net(array("seen", np.int64), array("embedding").reshape(-1, fit.size), array("kernels").reshape(fit.size, -1), array("bias"), array("weight"), r.base)
    return Model(fit, net, list(r.names), array("tongue", np.int32).reshape(len(net.seen) + 1, -1), array("prior", np.int64), r.slope, array("shift", np.float64))


def thresholds(model: Model) -> dict[str | None, float]:
    """Margins from which a text counts as toxic, by language, and under None that of all others."""
    return {name: -float(s) / model.slope for name, s in zip([*model.names, None], model.shift, strict=True)}


def score(docs: DataFrame, model: Model | None, into: str = "score") -> DataFrame:
    """docs with a column `into` (in place of one of that name): 0 to 1, 0.5 at the threshold of the text's language. Null
    texts are empty and scored as such; without a model all scores are 0.5. Equal texts have equal scores, so repeated rows
    do; very long ones are read to the end; empty tables stay empty. Other columns stay as they are, whatever their names."""
    kept = [c for c in docs.columns if c != into]
    at = kept.index("text")
    # At most the sample's distinct words, by size of an embedding and languages.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn(into, F.lit(0.0)).schema

    def run(batches) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer = Scorer(m.net, m.fit) if m else None
        for batch in slices(batches, at, STEP):
            out = np.zeros(batch.num_rows)
            if m:
                numbers, ends = word_numbers(texts(batch.column(at)), m.fit.buckets)
                rows = scorer.rows(numbers)
                out = m.slope * scorer.margins(rows, ends) + m.shift[language_of(m.tongue, m.prior, rows, ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))], [*kept, into])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)
