"""Product codes of vectors, in whole numbers throughout.

Parts and codebook entries are padded with zeros to a power of two and sent through the Walsh-Hadamard transform, which
only adds and subtracts. By Parseval's identity the squared differences of two transforms, over as many as they have
coefficients, are the squared distance times that width; so they are summed in order of sequency, and an entry is out
as soon as its sum exceeds that of one whose sum is known to the end. Nothing is rounded and no entry is out in vain.

Each round is one pass: tasks assign their rows and add up parts per entry, Spark adds these sums, and the driver divides
them: it holds the codebooks alone, of 4 x 256 entries whatever the input.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catamill.llm.common import BROADCAST_ROWS, result, scratch, written
from catamill.llm.vectors import Whole, blocks, whole_vectors


@dataclass(frozen=True)
class Codes:
    """parts: of a vector. entries: of a part's codebook, 256 at most. rounds: of assignment and update."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4


@functools.cache
def sequency_order(width: int) -> np.ndarray:
    """Places in the transform (in Hadamard's order) by the number of sign changes of their rows: Gray codes, bits reversed."""
    bits = width.bit_length() - 1
    s = np.arange(width)
    gray, place = s ^ (s >> 1), np.zeros(width, np.int64)
    for b in range(bits):
        place |= ((gray >> b) & 1) << (bits - 1 - b)
    return place


def walsh(rows: np.ndarray) -> np.ndarray:
    """The transforms of whole-numbered rows, padded with zeros to a power of two, in order of sequency."""
    n, size = rows.shape
    width = 1 << max(0, size - 1).bit_length()
    out = np.zeros((n, width), np.int64)
    out[:, :size] = rows
    half = 1
    while half < width:
        pairs = out.reshape(n, width // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return out[:, sequency_order(width)]


def nearest(rows: np.ndarray, book: np.ndarray, at_once: int = 128, sparse: float = 0.12) -> tuple[np.ndarray, np.ndarray]:
    """rows, book: transforms. Per row the nearest entry, the first among equals, and its squared distance times the width.

    Sums grow by a quarter of the coefficients at a time, for all entries of a block of rows. After each quarter the entry
    with the least sum gives a bound, its whole distance; once few pairs of row and entry are within it (a share of
    `sparse`), only these go on, fewer with each step."""
    n, width = rows.shape
    index, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    columns = np.ascontiguousarray(book.T)
    quarter, step = max(1, width // 4), max(1, width // 16)
    for lo in range(0, n, at_once):
        x = rows[lo : lo + at_once]
        sums, done, bound = np.zeros((len(x), len(book)), np.int64), 0, None
        while done < width:
            for j in range(done, min(done + quarter, width)):
                d = x[:, j, None] - columns[j]
                d *= d
                sums += d
            done = min(done + quarter, width)
            whole = ((x - book[sums.argmin(axis=1)]) ** 2).sum(axis=1)
            bound = whole if bound is None else np.minimum(bound, whole)
            within = sums <= bound[:, None]
            if np.count_nonzero(within) <= sparse * within.size:
                break
        # Pairs that may still win, by row and entry.
        row, entry = np.nonzero(within)
        sums = sums[row, entry]
        for j in range(done, width, step):
            d = x[row, j : j + step] - book[entry, j : j + step]
            sums = sums + (d * d).sum(axis=1)
            left = sums <= bound[row]
            row, entry, sums = row[left], entry[left], sums[left]
        least = np.minimum.reduceat(sums, np.searchsorted(row, np.arange(len(x))))
        tied = np.flatnonzero(sums == least[row])
        wins = tied[np.searchsorted(row[tied], np.arange(len(x)))]
        index[lo : lo + len(x)], best[lo : lo + len(x)] = entry[wins], sums[wins]
    return index, best


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x: rows of parts x width numbers; books: parts, entries, width. Entries (row, part), and squared distances summed over parts."""
    parts, _, width = books.shape
    index, error = np.zeros((len(x), parts), np.int64), np.zeros(len(x), np.int64)
    for p in range(parts):
        own = walsh(x[:, p * width : (p + 1) * width])
        index[:, p], scaled = nearest(own, walsh(books[p]))
        error += scaled // own.shape[1]
    return index, error


def first_books(whole: Whole, fit: Codes) -> np.ndarray:
    """The parts of the first vectors by id (nulls last; by their components where ids repeat)."""
    width = max(1, -(-whole.longest // fit.parts))
    few = whole.rows.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(fit.entries).collect()  # at most `entries` rows
    rows = np.zeros((len(few), fit.parts * width), np.int64)
    for k, r in enumerate(few):
        rows[k, : len(r.x)] = r.x
    return rows.reshape(len(few), fit.parts, width).transpose(1, 0, 2).copy()


def refined(whole: Whole, books: np.ndarray) -> np.ndarray:
    """One round: all parts to their nearest entries, and entries to the floored means of their parts."""
    parts, entries, width = books.shape
    spark = whole.rows.sparkSession
    shared = spark.sparkContext.broadcast(books)  # parts * entries * width numbers, whatever the input

    def run(batches) -> Iterator[pa.RecordBatch]:
        books = shared.value
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for _, x in blocks(batches, parts * width):
            index, _ = assign(x, books)
            for p in range(parts):
                to = index[:, p] + p * entries
                counts += np.bincount(to, minlength=parts * entries)
                order = np.argsort(to, kind="stable")
                own, starts = np.unique(to[order], return_index=True)
                sums[own] += np.add.reduceat(x[order, p * width : (p + 1) * width], starts, axis=0)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], ["entry", "n", "sums"])

    each = whole.rows.select("x").mapInArrow(run, "entry int, n long, sums array<bigint>")
    added = each.groupBy("entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)])
    out = books.reshape(parts * entries, width).copy()
    for r in added.collect():  # one row an entry
        out[r.entry] = np.array(r[2:], np.int64) // r.n
    shared.unpersist()
    return out.reshape(parts, entries, width)


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def coded(whole: Whole, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of all rows."""
    parts, _, width = books.shape
    shared = whole.rows.sparkSession.sparkContext.broadcast(books)
    schema = whole.rows.select("vec_id", "label").withColumns({"code": F.lit(""), "error": F.lit(0).cast("long")}).schema
    digits = [f"{k:02x}" for k in range(256)]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch, x in blocks(batches, parts * width):
            index, error = assign(x, shared.value)
            code = ["".join(map(digits.__getitem__, r)) for r in index.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return whole.rows.select("vec_id", "label", "x").mapInArrow(run, schema)


def compress(df: DataFrame, fit: Codes = Codes()) -> DataFrame:
    """df: vec_id, embedding, label. Returns vec_id, code (two hexadecimal digits a part), error, label_error and
    codebooks_sha256 of each vector that is finite.

    Null vectors and those with a null or non-finite component are left out. Shorter vectors, and those whose length the
    parts don't divide, end with zeros. Equal vectors have equal codes, and repeated rows all count; null ids come last and
    null labels are one label. With fewer vectors than entries the codebooks have as many entries as there are vectors. An
    empty table gives no rows. Other columns don't matter, whatever their names. `label_error` is null where it exceeds a
    long."""
    spark = df.sparkSession
    with scratch(spark):
        whole = whole_vectors(df, "embedding", ["vec_id", "label"], "whole-vectors")
        books = first_books(whole, fit)
        for _ in range(fit.rounds if whole.n else 0):
            books = refined(whole, books)
        rows = written(coded(whole, books) if whole.n else whole.rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), "codes")
        sums = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("all"))
        sums = written(sums.select(F.col("label").alias("of"), F.col("all").try_cast("long").alias("label_error")), "label-errors")
        few = sums.count() <= BROADCAST_ROWS
        out = rows.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("of")), "left")
        return result(out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")), "vector-codes")
