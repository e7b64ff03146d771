"""What the operators of this subpackage share: the shared folder, written intermediate tables, folds and columns."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space of the word contracts, as a Java and Python character class.
SPACE = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir); one of our own only where that is unset and all
    tasks run on this machine, as in tests."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.conf.get("catamill.shared.dir", None)
        if not at:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            at = "file://" + tempfile.mkdtemp(prefix="spark-catamill-", dir="/tmp")
            spark.conf.set("catamill.shared.dir", at)
    return at.rstrip("/")


#: Paths written within `scratch`, by nesting.
_SCRATCH: list[list[str]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: it cuts the lineage and outlives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """What is written within goes at the end, also after a failure, but for what `result` writes."""
    paths: list[str] = []
    _SCRATCH.append(paths)
    try:
        yield paths
    finally:
        _SCRATCH.remove(paths)
        for path in paths:
            removed(spark, path)


def removed(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def result(df: DataFrame, name: str) -> DataFrame:
    """df written so that it outlives the surrounding `scratch`."""
    held, _SCRATCH[:] = list(_SCRATCH), []
    try:
        return written(df, name)
    finally:
        _SCRATCH[:] = held


#: Rows and bytes of texts up to which a written lookup table is sent to all executors; beyond, the join shuffles, and AQE splits hot keys.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20


def join_lookup(left: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Joins a written lookup table with unique keys; it is broadcast only if its rows and the bytes of its texts, both
    counted, are few."""
    texts = [F.octet_length(f.name) for f in lookup.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = functools.reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0)) for t in texts], F.lit(0))
    n, held = lookup.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return left.join(F.broadcast(lookup) if n <= rows and held <= BROADCAST_BYTES else lookup, on, how)


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(k)


def row_draw(df: DataFrame, seed: int) -> Column:
    """Hash of each row's text and doc_id, so that copies of a text are drawn one by one; without ids, of its place in df."""
    own = F.col("doc_id") if "doc_id" in df.columns else F.monotonically_increasing_id()
    return F.xxhash64("text", own, F.lit(seed))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def partitions_for(n: int, per: int, least: int = 1) -> int:
    """Partitions so that each has about `per` of n units."""
    return max(least, -(-n // per))
