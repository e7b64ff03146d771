"""Tables of vectors: rows whose components are all finite, as whole numbers, in a written table and as numpy blocks in tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.llm.common import written

#: Components become floor(SCALE * c). Sums of squares fit a long up to LARGEST.
SCALE, LARGEST = 1024, 1 << 16
#: Numbers in one block of a task.
BLOCK = 1 << 19


@dataclass(frozen=True)
class Whole:
    """rows: the named columns and x array<int>. n: of the rows. longest: most components of a vector."""

    rows: DataFrame
    n: int
    longest: int


def finite(vector: Column) -> Column:
    """False for null vectors and those with a null or non-finite component; a vector without components is finite."""
    real = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, real)


def whole_vectors(df: DataFrame, vector: str, keep: list[str], name: str) -> Whole:
    """The finite vectors of df as a written table: `keep`, and x with floor(1024 * c) of each component as a double.
    Raises ValueError where a component is beyond 65536 either way, as its squares would not fit a long."""
    at = F.col(f"`{vector}`")
    some = df.where(finite(at)).select(*[F.col(f"`{c}`") for c in keep], F.transform(at, lambda c: c.cast("double")).alias("c_"))
    size = some.agg(F.count("*").alias("n"), F.max(F.size("c_")).alias("longest"), F.max(F.array_max(F.transform("c_", lambda c: F.abs(c)))).alias("largest")).first()
    if (size.largest or 0) > LARGEST:
        raise ValueError(f"a component of {size.largest} is beyond {LARGEST}")
    rows = some.select(*[F.col(f"`{c}`") for c in keep], F.transform("c_", lambda c: F.floor(c * SCALE).cast("int")).alias("x"))
    return Whole(written(rows, name), size.n, size.longest or 0)


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The lists as rows of `width` numbers; shorter ones end with zeros."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - (np.cumsum(sizes) - sizes)[row]] = flat
    return out


def blocks(batches, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches and the matrix of their last column, x, in blocks of bounded size."""
    most = max(1, BLOCK // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            yield part, matrix(part.column(part.num_columns - 1), width)
