"""LM scoring: a hierarchical Pitman-Yor bigram model. Each context word has a restaurant, and all share the unigram
restaurant as parent; seats are sampled by Gibbs, and predictive probabilities are averaged over the samples.

Pairs of (context, word) with their documents are dealt into buckets by word (frequent words by word and context), as
compressed arrays. A bucket then knows all customers of its words. In each sweep it takes all customers of a pair up and
seats them anew given all others, pair by pair (`seating`); buckets sample side by side. After each sweep the sums of
tables per context pass through owners of contexts, which know once for all whose numbers belong together, and totals and frequent words' counts through the driver, so that
the next sweep has the whole corpus's. Each bucket then scores its pairs; documents sum what their chunks got. A pair
that many documents of a chunk have is dealt once for all of them, and its score comes back to the chunk, so no bucket
receives a row for each document of a pair.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catamill.llm.arrow_text import cut, slices, split_words, texts
from catamill.llm.common import partitions_for, removed, result, scratch, shared_dir, written
from catamill.llm.seating import draw_tables


@dataclass(frozen=True)
class Fit:
    """discount, strength: of the context restaurants; base_*: of the unigram restaurant. sweeps: of Gibbs, of which the
    last `samples` are kept. bucket_bytes: text for each bucket; chunk_bytes: text that is dealt at once. shared: documents
    of a chunk from which on a pair is dealt once for all. seed: of the seating."""

    discount: float = 0.8
    strength: float = 1.0
    base_discount: float = 0.7
    base_strength: float = 10.0
    sweeps: int = 4
    samples: int = 2
    bucket_bytes: int = 12 << 20
    chunk_bytes: int = 8 << 20
    shared: int = 64
    seed: int = 5


START, END = np.uint64(1), np.uint64(2)
STEP = 2 << 20
TOKENS, DOCS, STATE, NAMES, ASK, SUMS, SEATS = range(7)  # kinds of rows
_ROWS = "bucket int, kind int, chunk long, owner int, data binary"


def _pack(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def _unpack(data: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _small(x: np.ndarray) -> np.ndarray:
    """The same non-negative numbers in as few bytes as they need."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ h >> np.uint64(33)


def word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode()) | 4  # never START or END


def _parts(batches, column: int) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray, np.ndarray]]:
    """Slices with their texts, A-Z folded: very long ones in parts. Also the row of each part, and whether it ends its text."""
    for batch in slices(batches, column, STEP):
        text = texts(batch.column(column))
        if batch.num_rows > 1 or len(text[0].as_py()) <= 2 * STEP:
            yield batch, pc.ascii_lower(text), np.arange(batch.num_rows), np.ones(batch.num_rows, bool)
            continue
        found = cut(text[0].as_py(), STEP)
        for k, part in enumerate(found):
            yield batch, pc.ascii_lower(pa.array([part], pa.large_string())), np.zeros(1, np.int64), np.array([k == len(found) - 1])


#: Words of a slice that are told, by count; and words that have short names where contexts are dealt.
TOLD, SHORT = 4, 65_000


def _frequent(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words with half a bucket's share of tokens or more, sorted, and over how many buckets each is dealt;
    and hashes of the most frequent words, sorted, whose places there are shorter names.

    Slices tell the words that have half of that share there (and those with TOLD tokens, which shape names alone). What
    the others leave out of a word is under half of the share, so that no such word is missed; there are four for each
    bucket at most."""
    share = 1 / (2 * buckets)

    def count(batches) -> Iterator[pa.RecordBatch]:
        for _, text, _, ends in _parts(batches, 0):
            index, words, _ = split_words(text)
            n = np.bincount(index, minlength=len(words))
            total = len(index) + int(ends.sum())
            many = np.flatnonzero(n >= min(share / 2 * total, TOLD))
            names = [word_hash(words[k]) for k in many.tolist()]
            arrays = np.array([*names, END, START], np.uint64).view(np.int64), np.concatenate([n[many], [ends.sum(), total]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["h", "n"])

    counts = written(docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "frequent")
    total = counts.where(F.col("h") == int(START)).first()
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    few = counts.where((F.col("h") != int(START)) & (F.col("n") >= share / 2 * total.n)).collect()  # four a bucket at most
    names = np.array([r.h for r in few], np.int64).view(np.uint64)
    parts = np.array([1 + int(2 * buckets * r.n / total.n) for r in few], np.int64)
    order = np.argsort(names)
    short = counts.where(F.col("h") != int(START)).orderBy(F.col("n").desc(), "h").limit(SHORT).select("h").collect()  # SHORT numbers
    return names[order], parts[order], np.sort(np.array([r.h for r in short], np.int64).view(np.uint64))


def _shortened(names: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """New place of each of the sorted names: those in `short` first, as steps between their places there, then the others."""
    at, known = _find(names, short)
    place = np.where(known, np.cumsum(known) - 1, known.sum() + np.cumsum(~known) - 1)
    return place, _small(np.diff(at[known], prepend=0)), names[~known]


def _named(steps: np.ndarray, others: np.ndarray, short: np.ndarray) -> np.ndarray:
    return np.concatenate([short[np.cumsum(steps.astype(np.int64))], others])


def _find(names: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted `among`, and whether each name is there."""
    if not len(among):
        return np.zeros(len(names), np.int64), np.zeros(len(names), bool)
    at = np.minimum(np.searchsorted(among, names), len(among) - 1)
    return at, among[at] == names


def _pairs(text: pa.Array, part: np.ndarray, ends: np.ndarray, before: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of word and context, part and count of each distinct (word, context, part), and tokens by part. before: the word before the first part."""
    index, words, stops = split_words(text)
    names = np.concatenate([np.fromiter(map(word_hash, words), np.uint64, len(words)), [END, before, START]]).astype(np.uint64)
    n_words = np.diff(stops, prepend=0)
    lengths = n_words + ends
    w = np.full(int(lengths.sum()), len(words), np.int64)
    past = np.cumsum(lengths)
    is_word = np.ones(len(w), bool)
    is_word[past[ends] - 1] = False
    w[is_word] = index
    u = np.concatenate([[0], w[:-1]])
    begins = (past - lengths)[lengths > 0]
    u[begins] = len(words) + 2
    if before != START and len(u):
        u[0] = len(words) + 1
    own = np.repeat(part, lengths)
    n, d = len(names), int(part.max()) + 1
    key, count = np.unique((w * n + u) * d + own, return_counts=True)
    return names[key // (n * d)], names[key // d % n], key % d, count, lengths


def _deal(docs: DataFrame, buckets: int, frequent: tuple[np.ndarray, np.ndarray, np.ndarray], fit: Fit) -> DataFrame:
    """docs: doc_id, learn, text."""
    hot, over, short = frequent

    def chunk_rows(chunk: int, found: list, docs: list) -> pa.RecordBatch:
        w, u, doc, count = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        ids, learn, lengths = [x for d in docs for x in d[0]], np.concatenate([d[1] for d in docs]), np.concatenate([d[2] for d in docs])
        d = len(ids)
        at, is_hot = _find(w, hot)
        to = mix(w)
        if len(hot):
            to = to + np.where(is_hot, mix(u) % over[at].astype(np.uint64), np.uint64(0)) * np.uint64(0x9E3779B97F4A7C15)
            to = np.where(is_hot, mix(to), to)
        to = (to % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((u, w, to))
        w, u, doc, count, to = w[order], u[order], doc[order], count[order], to[order]
        fresh = np.ones(len(w), bool)
        fresh[1:] = (w[1:] != w[:-1]) | (u[1:] != u[:-1])
        first = np.flatnonzero(fresh)
        n_docs = np.diff(first, append=len(w))
        many = n_docs >= fit.shared
        pair = np.cumsum(fresh) - 1
        kept = many[pair]
        # Shared pairs: their documents stay with the chunk, and the bucket sees them as one more document.
        learned = np.bincount(pair, weights=np.where(learn[doc], count, 0), minlength=len(first)).astype(np.int64)
        apart = _small((np.cumsum(many) - 1)[pair[kept]]), _small(doc[kept]), _small(count[kept])
        more = np.flatnonzero(many)
        pw, pu, pto = w[first], u[first], to[first]
        runs = np.where(many, 1, n_docs)
        doc, count = np.concatenate([doc[~kept], d + np.arange(len(more))]), np.concatenate([count[~kept], np.ones(len(more), np.int64)])
        pair = np.concatenate([pair[~kept], more])
        order = np.argsort(pair, kind="stable")
        doc, count = _small(doc[order]), _small(count[order])
        rows = [(chunk % buckets, DOCS, _pack(ids, learn, lengths, apart))]
        bits, begin = np.packbits(learn), 0
        bounds = np.flatnonzero(np.diff(pto, prepend=-1, append=-1))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            words, wi = np.unique(pw[a:b], return_inverse=True)
            contexts, ui = np.unique(pu[a:b], return_inverse=True)
            place, steps, others = _shortened(contexts, short)
            entries = slice(begin, begin := begin + int(runs[a:b].sum()))
            rows.append((int(pto[a]), TOKENS, _pack(words, _small(np.bincount(wi)), (steps, others), _small(place[ui]), _small(runs[a:b]), doc[entries], count[entries], bits, d, len(more), _small(learned[a:b][many[a:b]]))))
        return _record(rows, chunk)

    def run(batches) -> Iterator[pa.RecordBatch]:
        place, k, size = TaskContext.get().partitionId() << 32, 0, 0
        found: list[tuple] = []
        docs: list[tuple] = []
        n = 0
        before, open_doc = START, False
        for batch, text, part, ends in _parts(batches, 2):
            w, u, own, count, lengths = _pairs(text, part, ends, before)
            if not open_doc:
                docs.append((batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False).astype(bool), lengths))
                base, n = n, n + batch.num_rows
            else:
                docs[-1][2][-1] += lengths[0]
            found.append((w, u, (base + own).astype(np.int32), count.astype(np.int32)))
            open_doc = not ends[-1]
            if open_doc:
                tail = text[0].as_py().split()
                before = np.uint64(word_hash(tail[-1])) if tail else before
            else:
                before = START
            size += text.nbytes
            if size >= fit.chunk_bytes and not open_doc:
                yield chunk_rows(place + k, found, docs)
                docs.clear()
                n, k, size = 0, k + 1, 0
        if docs:
            yield chunk_rows(place + k, found, docs)

    return docs.mapInArrow(run, _ROWS)


def _record(rows: list[tuple], chunk: int) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([chunk] * n, pa.int64()), pa.array([0] * n, pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
        ["bucket", "kind", "chunk", "owner", "data"],
    )


def _distinct(pieces: list[np.ndarray]) -> np.ndarray:
    """The different numbers of all pieces, sorted: each piece's own first, so that no copy of all of them is sorted at once."""
    found = [np.unique(x[k : k + DISTINCT_AT_ONCE]) for x in pieces for k in range(0, len(x), DISTINCT_AT_ONCE)]
    while len(found) > 1:
        found = [np.unique(np.concatenate(found[k : k + 4])) for k in range(0, len(found), 4)]
    return found[0]


#: Numbers that are sorted at once.
DISTINCT_AT_ONCE = 1 << 20


def _gather(buckets: int, hot: np.ndarray, short: np.ndarray):
    """Of one bucket: its pairs with counts, its tokens by pair, and what it asks and tells of contexts and sums with one table a pair."""

    def run(key, table):
        bucket = key[0].as_py()
        out: list[tuple] = []  # kind, chunk, owner, data
        parts, chunks = [], []
        for kind, chunk, data in zip(table["kind"], table["chunk"], table["data"], strict=True):  # one row's data at a time
            if kind.as_py() == DOCS:
                out.append((DOCS, chunk.as_py(), 0, data.as_py()))
            else:
                part = list(_unpack(data.as_buffer()))
                part[2] = _named(*part[2], short)
                parts.append(part)
                chunks.append(chunk.as_py())
        if parts:
            W, w_at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            U = _distinct([p[2] for p in parts])
            owner = (mix(U) % np.uint64(buckets)).astype(np.int64)
            U = U[np.lexsort((U, owner))]
            owner = np.sort(owner)
            by_name = np.argsort(U)
            sorted_names = U[by_name]
            sizes = [len(p[3]) for p in parts]
            pair, learned = np.empty(sum(sizes), np.int64), np.empty(sum(sizes), np.int64)
            begin = past = 0
            for p in parts:
                own_w = np.repeat(w_at[begin : begin + len(p[0])], p[1])
                begin += len(p[0])
                own = slice(past, past := past + len(p[3]))
                pair[own] = own_w * len(U) + by_name[np.searchsorted(sorted_names, p[2])][p[3]]
                doc, count, d = p[5], p[6].astype(np.int64), p[8]
                alone = doc < d
                n = np.zeros(len(doc), np.int64)
                n[alone] = np.where(np.unpackbits(p[7], count=d)[doc[alone]], count[alone], 0)
                n[~alone] = p[10]
                learned[own] = np.add.reduceat(n, np.cumsum(p[4].astype(np.int64)) - p[4])
                p[0] = p[1] = p[2] = p[3] = p[7] = p[10] = None  # what is told of words, contexts and learning is read
            pairs = _distinct([pair])
            place = np.searchsorted(pairs, pair).astype(np.int32 if len(pairs) < 1 << 31 else np.int64)
            del pair
            c = np.bincount(place, weights=learned, minlength=len(pairs)).astype(np.int64)
            del learned
            w, u = pairs // len(U), pairs % len(U)
            cw = np.bincount(w, weights=c, minlength=len(W)).astype(np.int64)
            del pairs
            _, is_hot = _find(W, hot)
            bounds = np.searchsorted(owner, np.arange(buckets + 1))
            state = np.bincount(w, minlength=len(W)), u, c, cw, W[is_hot], np.flatnonzero(is_hot), bounds
            out.append((STATE, 0, 0, _pack(*map(_small, state[:4]), *state[4:6], bounds)))
            out += [(NAMES, 0, o, _pack(U[bounds[o] : bounds[o + 1]])) for o in np.flatnonzero(np.diff(bounds)).tolist()]
            t = (c > 0).astype(np.int64)
            below = np.bincount(w, weights=t, minlength=len(W)).astype(np.int64)
            out += _tell(state, [t], [below], [(below > 0).astype(np.int64)], False)
            del w, u, c, state, sorted_names, by_name, owner
            begin = 0
            for k, (chunk, n) in enumerate(zip(chunks, sizes, strict=True)):
                p, parts[k] = parts[k], None
                out.append((TOKENS, chunk, 0, _pack(_small(place[begin : begin + n]), p[4], p[5], p[6], p[8] + p[9])))
                begin += n
        return _rows(bucket, out)

    return run


def _rows(bucket: int, out: list[tuple]) -> pa.Table:
    n = len(out)
    return pa.table({
        "bucket": pa.array([bucket] * n, pa.int32()), "kind": pa.array([r[0] for r in out], pa.int32()), "chunk": pa.array([r[1] for r in out], pa.int64()),
        "owner": pa.array([r[2] for r in out], pa.int32()), "data": pa.array([r[3] for r in out], pa.binary()),
    })


def _tell(state: tuple, t: list, below: list, above: list, last: bool) -> list[tuple]:
    """Rows of a bucket's seating: tables of each kept sample for itself, sums per context for their owners, and totals."""
    _, u, c, cw, hot_names, hot_at, bounds = state
    many = np.flatnonzero(c > 1)  # one customer sits at one table whatever is drawn
    out = [(SEATS, 0, 0, _pack([_small(x[many]) for x in t], [_small(x) for x in below], [_small(x) for x in above]))]
    asked = [np.bincount(u, weights=x, minlength=bounds[-1]).astype(np.int64) for x in ([c, *t] if last else t[-1:])]
    for o in np.flatnonzero(np.diff(bounds)).tolist():
        out.append((ASK, 0, o, _pack([_small(x[bounds[o] : bounds[o + 1]]) for x in asked])))
    cold = np.ones(len(cw), bool)
    cold[hot_at] = False
    sums = int(c.sum()), int((cw[cold] > 0).sum()), [int(x[cold].sum()) for x in below], [int(x[cold].sum()) for x in above]
    return [*out, (SUMS, 0, 0, _pack(sums, hot_names, np.stack([cw[hot_at], *[x[hot_at] for x in below]]).astype(np.int64)))]


def _served(total: dict, hot: np.ndarray, hot_names: np.ndarray, hot_at: np.ndarray, below: np.ndarray, above: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Customers and tables of a bucket's words in the unigram restaurant of the whole corpus, in sample s of total."""
    customers, seated = below.astype(np.float64), above.astype(np.float64)
    at = np.searchsorted(hot, hot_names)
    customers[hot_at], seated[hot_at] = total["hot"][1:][s][at], total["hot_tables"][s][at]
    return customers, seated


def _new(fit: Fit, total: dict, s: int) -> float:
    return (fit.base_strength + fit.base_discount * total["above"][s]) / (total["kinds"] + 1)


def _told(right: pa.Table) -> list[np.ndarray]:
    """What the owners told of a bucket's contexts, in its order of them."""
    told = [_unpack(d)[0] for k, _, d in sorted(zip(right["kind"].to_pylist(), right["owner"].to_pylist(), right["data"].to_pylist(), strict=True)) if k == ASK]
    return [np.concatenate(x).astype(np.float64) for x in zip(*told, strict=True)]


def _base_tables(fit: Fit, customers: np.ndarray, old: np.ndarray, all_tables: int, kinds: int, rng: np.random.Generator) -> np.ndarray:
    """Tables of words in the unigram restaurant, given the others'."""
    others = fit.base_strength + fit.base_discount * (all_tables - old)
    return draw_tables(customers, old, lambda k, i: np.log((others[k] + fit.base_discount * i) / (kinds + 1)), fit.base_discount, rng)


def _sweep(fit: Fit, total: dict, hot: np.ndarray, sweep: int):
    """Of one bucket: its customers seated anew, given all buckets' tables of the sweep before."""

    def run(key, left, right):
        bucket = key[0].as_py()
        states = left["data"].to_pylist()
        if not states:
            return _rows(bucket, [])
        w_count, u, c, cw, hot_names, hot_at, bounds = state = _unpack(states[0])
        rng = np.random.default_rng([fit.seed, bucket, sweep])
        seats = next(d for k, d in zip(right["kind"].to_pylist(), right["data"].to_pylist(), strict=True) if k == SEATS)
        t_many, below, above = _unpack(seats)
        w, many = np.repeat(np.arange(len(w_count)), w_count), np.flatnonzero(c > 1)
        customers, seated = _served(total, hot, hot_names, hot_at, below[-1], above[-1], -1)
        old = t_many[-1].astype(np.int64)
        # What is left without the pair's own customers: tables of its context, customers and tables of its word.
        context = fit.strength + fit.discount * (_told(right)[0][u[many]] - old)
        left_over = np.maximum(customers[w[many]] - old, 0)
        known = left_over > 0
        dish = np.where(known, left_over - fit.base_discount * np.minimum(seated[w[many]], left_over), -fit.base_discount)
        new, room = _new(fit, total, -1), fit.base_strength + total["below"][-1] - old

        def opening(k: np.ndarray, i: np.ndarray) -> np.ndarray:
            served = np.where(known[k] | (i >= 1), dish[k] + i, 0.0)  # a word that nobody else has starts anew
            return np.log((context[k] + fit.discount * i) * (served + new) / (room[k] + i))

        kept = []
        for x in [*t_many[len(t_many) - fit.samples + 1 :], None] if sweep >= fit.sweeps - fit.samples + 1 else [None]:
            t = (c > 0).astype(np.int64)
            t[many] = draw_tables(c[many], old, opening, fit.discount, rng) if x is None else x
            kept.append(t)
        tables = np.bincount(w, weights=kept[-1], minlength=len(w_count)).astype(np.int64)
        n = len(kept) - 1
        below = [*below[len(below) - n :], tables]
        above = [*above[len(above) - n :], _base_tables(fit, tables, np.minimum(above[-1].astype(np.int64), tables), total["above"][-1], total["kinds"], rng)]
        return _rows(bucket, _tell(state, kept, below, above, sweep == fit.sweeps - 1))

    return run


def _number(key, table):
    """Owners of contexts: the names that each bucket asks of, as numbers that equal names share."""
    buckets, datas = zip(*sorted(zip(table["bucket"].to_pylist(), table["data"].to_pylist(), strict=True)), strict=True)
    names = [_unpack(x)[0] for x in datas]
    at = np.unique(np.concatenate(names), return_inverse=True)[1]
    ends = np.cumsum([len(x) for x in names])
    data = [_pack(_small(x)) for x in np.split(at, ends[:-1])]
    return pa.table({"owner": pa.array([key[0].as_py()] * len(data), pa.int32()), "bucket": pa.array(buckets, pa.int32()), "data": pa.array(data, pa.binary())})


def _sum_contexts(key, numbers, asks):
    """Owners of contexts: sums over all buckets, told back to each in the order in which it asked."""
    known = dict(zip(numbers["bucket"].to_pylist(), numbers["data"].to_pylist(), strict=True))
    asked = dict(zip(asks["bucket"].to_pylist(), asks["data"].to_pylist(), strict=True))
    buckets = sorted(known)
    ats, asked = [_unpack(known[b])[0] for b in buckets], [_unpack(asked[b])[0] for b in buckets]
    at = np.concatenate(ats)
    sums = [np.bincount(at, weights=np.concatenate(x)).astype(np.int64)[at] for x in zip(*asked, strict=True)]
    ends = np.cumsum([len(x) for x in ats])[:-1]
    data = [_pack([_small(x) for x in own]) for own in zip(*[np.split(x, ends) for x in sums], strict=True)]
    n = len(data)
    return pa.table({"bucket": pa.array(buckets, pa.int32()), "kind": pa.array([ASK] * n, pa.int32()), "chunk": pa.array([0] * n, pa.int64()), "owner": pa.array([key[0].as_py()] * n, pa.int32()), "data": pa.array(data, pa.binary())})


def _score(fit: Fit, total: dict, hot: np.ndarray):
    """Of one bucket, with its contexts' sums: per chunk, what its pairs add to each document."""

    def run(key, left, right):
        kinds, chunks, datas = left["kind"].to_pylist(), left["chunk"].to_pylist(), left["data"].to_pylist()
        states = [d for k, d in zip(kinds, datas, strict=True) if k == STATE]
        out: list[tuple] = []
        if states:
            w_count, u, c, cw, hot_names, hot_at, bounds = _unpack(states[0])
            t_many, below, above = _unpack(next(d for k, d in zip(right["kind"].to_pylist(), right["data"].to_pylist(), strict=True) if k == SEATS))
            w = np.repeat(np.arange(len(w_count)), w_count)
            many = np.flatnonzero(c > 1)
            cu, *tus = _told(right)
            assert len(cu) == bounds[-1]
            cw = cw.astype(np.float64)
            cw[hot_at] = total["hot"][0][np.searchsorted(hot, hot_names)]
            p = np.zeros(len(u))
            for s, tu in enumerate(tus):
                customers, seated = _served(total, hot, hot_names, hot_at, below[s], above[s], s)
                base = (np.maximum(customers - fit.base_discount * seated, 0) + _new(fit, total, s)) / (fit.base_strength + total["below"][s])
                t = (c > 0).astype(np.float64)
                t[many] = t_many[s]
                p += (np.maximum(c - fit.discount * t, 0) + (fit.strength + fit.discount * tu[u]) * base[w]) / (fit.strength + cu[u])
            logs = np.log10(p / fit.samples)
            plain = np.log10((cw + 1) / (total["tokens"] + 1 * (total["kinds"] + 1)))[w]
            known = (cw > 0)[w]
            for kind, chunk, data in zip(kinds, chunks, datas, strict=True):
                if kind == TOKENS:
                    pair, runs, doc, count, n = _unpack(data)
                    at = np.repeat(pair, runs)
                    add = lambda x: np.bincount(doc, weights=x[at] * count, minlength=n)  # noqa: B023, E731
                    out.append((chunk, _pack(_small(add(known).astype(np.int64)), add(plain), add(logs))))
        n = len(out)
        return pa.table({"chunk": pa.array([r[0] for r in out], pa.int64()), "kind": pa.array([TOKENS] * n, pa.int32()), "data": pa.array([r[1] for r in out], pa.binary())})

    return run


def _documents(key, table):
    known = plain = logs = 0
    for kind, data in zip(table["kind"].to_pylist(), table["data"].to_pylist(), strict=True):
        if kind == DOCS:
            ids, learn, lengths, (pair, doc, count) = _unpack(data)
        else:
            a, b, c = _unpack(data)
            known, plain, logs = known + a.astype(np.int64), plain + b, logs + c
    d = len(ids)
    whole = lambda x: x[:d] + np.bincount(doc, weights=x[d:][pair] * count, minlength=d)  # noqa: E731  what shared pairs add
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "learned": pa.array(learn), "n_tokens": pa.array(lengths, pa.int64()), "n_known": pa.array(whole(known).astype(np.int64)), "base_score": pa.array(whole(plain)), "score": pa.array(whole(logs))})


def _totals(rows: DataFrame, fit: Fit, hot: np.ndarray, before: dict | None, sweep: int) -> dict:
    """Totals of a seating over all buckets; lists have an item for each kept sample. hot: customers in texts, and tables
    of each sample, of each frequent word; hot_tables: its tables in the unigram restaurant."""
    total: dict = {"tokens": 0, "kinds": 0, "below": [], "above": [], "hot": np.zeros((2, len(hot)), np.int64)}
    add = lambda a, b: [x + y for x, y in zip(a or [0] * len(b), b, strict=True)]
    for r in rows.where(F.col("kind") == SUMS).select("data").toLocalIterator():  # a few numbers a bucket, and its frequent words, about two a bucket
        (tokens, kinds, below, above), names, counts = _unpack(bytes(r.data))
        total["tokens"] += tokens
        total["kinds"] += kinds
        total["below"], total["above"] = add(total["below"], below), add(total["above"], above)
        if len(total["hot"]) != len(counts):
            total["hot"] = np.zeros((len(counts), len(hot)), np.int64)
        total["hot"][:, np.searchsorted(hot, names)] += counts
    if not total["below"]:
        total["below"], total["above"] = [0], [0]
    total["kinds"] += int((total["hot"][0] > 0).sum())
    # Frequent words' tables in the unigram restaurant, of all their customers at once.
    samples = len(total["below"])
    total["hot_tables"] = []
    for s in range(samples):
        rng = np.random.default_rng([fit.seed, sweep - samples + 1 + s + fit.sweeps])
        customers = total["hot"][1 + s]
        old = np.minimum(before["hot_tables"][-1] if before else 1, customers)
        tables = _base_tables(fit, customers, old, before["above"][-1] if before else total["above"][s] + int(old.sum()), total["kinds"], rng)
        total["hot_tables"].append(tables)
        total["below"][s] += int(customers.sum())
        total["above"][s] += int(tables.sum())
    return total


def score_documents(docs: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """docs: doc_id, text, learn (whether the model learns from the row; others are not read). Per row: doc_id, learned,
    n_tokens, n_known, train_tokens, base_score, score.

    A token is a word (A-Z folded) or the end of a text. base_score: log10 of add-one unigram probabilities; score: of
    the model's averaged probabilities; sums over the tokens. Null texts are empty and have one token; very long texts
    are read in parts. Null `learn` is false. Without any row to learn from, every token is as likely as a new word.
    Repeated rows count as often as they stand there. Empty tables give no rows. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("learn", F.lit(False)).alias("learn"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    buckets = partitions_for(int(size), fit.bucket_bytes, 4)
    made: list[str] = []

    def kept(df: DataFrame, by: str, *parts: str) -> DataFrame:
        """Written in buckets, so that later steps find the rows of a bucket or owner together without another shuffle; by kind, so that they read no others."""
        name = f"pitman_yor_{uuid.uuid4().hex}"
        made.append(name)
        df.write.format("parquet").option("compression", "none").option("path", f"{shared_dir(spark)}/{name}").partitionBy(*parts).bucketBy(buckets, by).saveAsTable(name)
        return spark.table(name).select(*df.columns)

    try:
        with scratch(spark):
            frequent = hot, _, short = _frequent(docs, buckets)
            rows = last = kept(_deal(docs, buckets, frequent, fit).groupBy("bucket").applyInArrow(_gather(buckets, hot, short), _ROWS), "bucket", "kind")
            owners = kept(rows.where(F.col("kind") == NAMES).groupBy("owner").applyInArrow(_number, "owner int, bucket int, data binary"), "owner")
            total = _totals(last, fit, hot, None, -1)

            def told():
                asks = last.where(F.col("kind") == ASK).groupBy("owner")
                return owners.groupBy("owner").cogroup(asks).applyInArrow(_sum_contexts, _ROWS).union(last.where(F.col("kind") == SEATS)).groupBy("bucket")

            for sweep in range(fit.sweeps):
                last = written(rows.where(F.col("kind") == STATE).groupBy("bucket").cogroup(told()).applyInArrow(_sweep(fit, total, hot, sweep), _ROWS), "seats")
                total = _totals(last, fit, hot, total, sweep)
            here = rows.where(F.col("kind").isin(STATE, TOKENS))
            parts = here.groupBy("bucket").cogroup(told()).applyInArrow(_score(fit, total, hot), "chunk long, kind int, data binary")
            parts = parts.union(rows.where(F.col("kind") == DOCS).select("chunk", "kind", "data"))
            out = parts.groupBy("chunk").applyInArrow(_documents, "doc_id long, learned boolean, n_tokens long, n_known long, base_score double, score double")
            return result(out.withColumn("train_tokens", F.lit(total["tokens"]).cast("long")), "scores")
    finally:
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            removed(spark, f"{shared_dir(spark)}/{name}")
