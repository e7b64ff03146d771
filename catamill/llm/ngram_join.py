"""N-gram Jaccard join by grouped prefixes: components of documents whose sets of word shingles are similar.

Shingles are ordered by hash, those that very many documents share last; any fixed order gives right results. Two sets
that are similar enough share a shingle in their prefixes. Documents with equal sets are one class; classes with equal
prefixes and size are one group; candidate pairs of groups come from shared prefix shingles, are filtered by size,
position and counts of hash buckets, and are then expanded to members and verified on the whole sets.

Of a shingle's list, round one pairs each group with the next and with the first, in order of size and in order of the
shingle's place in the prefixes (the first there has the fewest shingles of its own, as the text that others were copied
from), which links most of what is similar without all pairs. Round two takes all pairs of lists, but only between what is still in different
components, so large groups of copies cost no pairs and no link between different texts is lost.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catamill.llm.arrow_text import slices, split_words, texts
from catamill.llm.common import join_lookup, result, scratch, written
from catamill.llm.components import connected

STEP = 4 << 20
#: Buckets of the counts that bound an overlap, and the largest set that they count.
BUCKETS, COUNTED = 256, 8_000_000
#: Sets of a part of a task that make a shingle count as frequent, and how many such shingles are ordered last at most.
LOCAL, FREQUENT_MOST = 3, 200_000
#: Groups of a shingle's list that one task puts in order; longer lists are dealt over several tasks.
LIST_MOST = 50_000
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xD6E8FEB86659FD93)


def shingle_sets(text: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's n-word shingles (A-Z folded); of a shorter text, of all its words; none without words."""
    index, words, ends = split_words(pc.ascii_lower(text))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in words), np.uint64, len(words))[index]
    h = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        h = (h ^ hashes[k : len(h) + k]) * np.uint64(_MIX[k % len(_MIX)] + 2 * (k // len(_MIX)))
        h ^= h >> np.uint64(29)
    out, begin = [], 0
    for end in ends.tolist():
        if end - begin >= n:
            out.append(np.unique(h[begin : end - n + 1]))
        elif end > begin:
            out.append(np.array([xxhash.xxh3_64_intdigest(hashes[begin:end].tobytes(), seed=end - begin)], np.uint64))
        else:
            out.append(h[:0])
        begin = end
    return out


def frequent_shingles(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, the rank of each (rarest first) and its count, by counts of distinct sets within parts of
    tasks: what stands in LOCAL sets of such a part is counted over all parts. At most FREQUENT_MOST are taken. They only
    shape the order of shingles, so that one missed costs time alone."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, np.ndarray] = {}
        size = 0

        def frequent() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(list(kept.values())), return_counts=True) if kept else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            many = c >= LOCAL
            return pa.RecordBatch.from_arrays([pa.array(h[many].view(np.int64)), pa.array(c[many])], ["h", "n"])

        for batch in slices(batches, 0, STEP):
            for s in shingle_sets(texts(batch.column(0)), n):
                if (key := xxhash.xxh3_128_digest(s.tobytes())) not in kept:
                    kept[key] = s
                    size += len(s)
            if size > 4_000_000:
                yield frequent()
                kept, size = {}, 0
        yield frequent()

    found = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "h").limit(FREQUENT_MOST).collect()
    h = np.array([r.h for r in found], np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], (len(h) - 1 - np.arange(len(h)))[order], np.array([r.n for r in found], np.int64)[order]


def _ordered(s: np.ndarray, last: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A set in the order of all: by hash, and the frequent shingles at the end, rarest first."""
    if not len(last):
        return s
    at = np.minimum(np.searchsorted(last, s), len(last) - 1)
    late = last[at] == s
    return np.concatenate([s[~late], s[late][np.argsort(rank[at[late]])]])


def prefix_length(size: int, percent: int) -> int:
    return size - (percent * size + 99) // 100 + 1


def prefixed(docs: DataFrame, n: int, percent: int, frequent: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, size, class (hash of the whole set), prefix, counts (shingles by hash bucket; null for very large sets). Texts without words: size 0, no class."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches) -> Iterator[pa.RecordBatch]:
        last, rank, _ = shared.value
        for batch in slices(batches, 1, STEP):
            sizes, classes, prefixes, counts = [], [], [], []
            for s in shingle_sets(texts(batch.column(1)), n):
                sizes.append(len(s))
                if not len(s):
                    classes.append(None), prefixes.append(None), counts.append(None)
                    continue
                classes.append(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))
                counts.append(np.bincount((s & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS) if len(s) < COUNTED else None)
                prefixes.append(_ordered(s, last, rank)[: prefix_length(len(s), percent)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int16()))],
                ["doc_id", "size", "class", "prefix", "counts"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, size long, class long, prefix array<long>, counts array<short>")


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """Of two sizes, the smallest intersection with percent of the union."""
    return F.ceil((a + b) * percent / (100 + percent) - 1e-9)


def similar(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Of pairs (a, b: classes), those whose whole sets are similar. classes: class, first (a document of it)."""
    pairs = written(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    needed = written(classes.join(ids, "class", "left_semi").select(F.col("first").alias("doc_id"), "class"), "needed")

    def sets(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, STEP):
            own = shingle_sets(texts(batch.column(2)), n)
            found = [np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64) if len(s) else None for s in own]
            keep = [k for k, (c, got) in enumerate(zip(batch.column(1).to_pylist(), found, strict=True)) if c == got]  # an id may stand on several texts
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(keep, pa.int64())), pa.array([own[k].view(np.int64) for k in keep], pa.list_(pa.int64()))], ["class", "shingles"])

    chosen = join_lookup(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), needed, ["doc_id"], "inner", rows=500_000)
    whole = written(chosen.select("doc_id", "class", "text").mapInArrow(sets, "class long, shingles array<long>").dropDuplicates(["class"]), "sets")
    left = pairs.join(whole.select(F.col("class").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(whole.select(F.col("class").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return written(both.where(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b"), "similar")


def within_groups(members: DataFrame, docs: DataFrame, n: int, percent: int, frequent: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """a, b: classes of one group that may be similar, of different labels. members: class, group, label, first.

    Such sets have one size and one prefix; behind it, they share a shingle among the next ones, as many as the overlap
    still leaves open, so that not all members of a group meet each other."""
    needed = written(members.select(F.col("first").alias("doc_id"), "class", "group", "label"), "mixed")
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches) -> Iterator[pa.RecordBatch]:
        last, rank, _ = shared.value
        for batch in slices(batches, 3, STEP):
            keep, found = [], []
            for k, (c, s) in enumerate(zip(batch.column(0).to_pylist(), shingle_sets(texts(batch.column(3)), n), strict=True)):
                if len(s) and c == int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)):  # an id may stand on several texts
                    least = -(-2 * len(s) * percent // (100 + percent))
                    begin = prefix_length(len(s), percent)
                    keep.append(k)
                    found.append(_ordered(s, last, rank)[begin : begin + len(s) - least + 1].view(np.int64))
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in range(3)], pa.array(found, pa.list_(pa.int64()))], ["class", "group", "label", "next"])

    chosen = join_lookup(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), needed, ["doc_id"], "inner", rows=500_000)
    lists = chosen.select("class", "group", "label", "text").mapInArrow(run, "class long, group long, label long, next array<long>").dropDuplicates(["class"])
    lists = written(lists.select("class", "group", "label", F.explode("next").alias("shingle")), "next")
    x, y = lists.alias("x"), lists.alias("y")
    met = x.join(y, (F.col("x.group") == F.col("y.group")) & (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.class") < F.col("y.class")) & (F.col("x.label") != F.col("y.label")))
    return met.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()


def join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text; others are not read).

    component_id: the smallest doc_id reachable over links; two rows are linked if 100 * intersection >= percent * union
    of their sets of n-word shingles. Null and empty texts have no shingles and no links; equal sets are one class, so
    repeated rows are linked; very long texts are read whole. Sets are compared by 64-bit hashes of shingles. Empty
    tables give no rows. BUCKETS, COUNTED, LOCAL, FREQUENT_MOST and LIST_MOST shape the order of work alone, not its result.
    """
    with scratch(docs.sparkSession):
        return result(_join(docs.select("doc_id", "text"), n, percent), "components")


def _salted(lists: DataFrame, frequent: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """lists with `salt`: null, and a part for each row of the lists of shingles that are known to be long. It shapes round one alone."""
    long = [(int(h), int(1 + c // LIST_MOST)) for h, c in zip(frequent[0].view(np.int64), frequent[2], strict=True) if c > LIST_MOST]
    if not long:
        return lists.withColumn("salt", F.lit(None).cast("int"))
    table = lists.sparkSession.createDataFrame(long, "shingle long, parts int")  # at most FREQUENT_MOST rows of two numbers
    return lists.join(F.broadcast(table), "shingle", "left").withColumn("salt", F.pmod(F.col("group"), F.col("parts")).cast("int")).drop("parts")


def _join(docs: DataFrame, n: int, percent: int) -> DataFrame:
    frequent = frequent_shingles(docs, n)
    rows = written(prefixed(docs, n, percent, frequent), "rows")
    classes = written(
        rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("first"), F.first("size").alias("size"), F.first("prefix").alias("prefix"), F.first("counts").alias("counts"))
        .withColumn("group", F.xxhash64("size", "prefix")), "classes",
    )
    # Groups: classes with equal prefix and size. The class with the smallest hash stands for the group in round one.
    leads = classes.groupBy("group").agg(F.min("class").alias("class"))
    groups = classes.join(leads, ["group", "class"], "left_semi")
    lists = groups.select("group", F.col("size").cast("int").alias("size"), F.posexplode("prefix").alias("at", "shingle"))
    lists = _salted(lists, frequent)
    by_size = Window.partitionBy("shingle", "salt").orderBy("size", "group")
    by_place = Window.partitionBy("shingle", "salt").orderBy("at", "size", "group")  # what has few rarer shingles of its own comes first
    place = F.struct("group", "size", "at")
    lists = lists.withColumn("before", F.lag(place).over(by_size)).withColumn("lead", F.first(place).over(by_size)).withColumn("after", F.lead("group").over(by_size))
    lists = lists.withColumn("near", F.lag(place).over(by_place)).withColumn("centre", F.first(place).over(by_place))
    alone = F.col("before").isNull() & F.col("after").isNull() & F.col("salt").isNull()
    lists = written(lists.where(~alone).drop("after"), "lists")  # a list of one links nothing

    near_size = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)
    stars = []
    for x in ("before", "lead", "near", "centre"):
        size, at = F.col(f"{x}.size"), F.col(f"{x}.at")
        # What two sets share is the shingle, at most all that stands before it in either, and all that stands behind it.
        most = F.least(at, F.col("at")) + F.least(size - at, F.col("size") - F.col("at"))
        star = lists.where(F.col(x).isNotNull() & near_size(size, F.col("size")) & (most >= least_overlap(size, F.col("size"), percent)))
        stars.append(star.select(F.col(f"{x}.group").alias("g"), F.col("group").alias("h")).where(F.col("g") != F.col("h")).distinct())
    lead = lambda g, c: leads.select(F.col("group").alias(g), F.col("class").alias(c))
    stars = [functools.reduce(DataFrame.union, stars).select(F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h")).distinct().join(lead("g", "x"), "g").join(lead("h", "y"), "h").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))]
    inner = classes.groupBy("group").agg(F.count("*").alias("members"), F.min("class").alias("lead")).where(F.col("members") > 1)
    members = classes.select("class", "group").join(inner, "group")  # of groups with several classes
    stars.append(members.where(F.col("class") != F.col("lead")).select(F.col("lead").alias("a"), F.col("class").alias("b")))
    first = stars[0].union(stars[1]).where(F.col("a") != F.col("b")).distinct()
    sums = classes.select("class", "size", "counts")
    edges = similar(_possible(first, sums, percent), classes, docs, n, percent)
    labels = connected(edges)

    # Round two: between components. A group whose members are in several components counts as one of its own.
    named = written(classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select("class", "group", "size", F.coalesce("label", "class").alias("label")), "named")
    of_group = named.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    of_group = of_group.select("group", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.xxhash64("group")).alias("part"), (F.col("low") != F.col("high")).alias("mixed"))
    lists = lists.select("shingle", "group", "size", "at").join(of_group, "group")
    # Only lists that hold several components have pairs left.
    open_lists = lists.groupBy("shingle").agg(F.min("part").alias("p"), F.max("part").alias("q")).where(F.col("p") != F.col("q")).select("shingle")
    lists = written(lists.join(open_lists, "shingle", "left_semi"), "open")
    x, y = lists.alias("x"), lists.alias("y")
    # The first shared shingle bounds the overlap: what stands behind it in either set, and itself.
    behind = F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at"))
    met = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.part") < F.col("y.part")) & near_size(F.col("x.size"), F.col("y.size"))
        & (behind >= least_overlap(F.col("x.size"), F.col("y.size"), percent)),
    )
    met = met.select(F.col("x.group").alias("g"), F.col("y.group").alias("h")).distinct()
    mixed = named.join(of_group.where("mixed").select("group"), "group", "left_semi").join(classes.select("class", "first"), "class")
    side = lambda g, c, p: named.select(F.col("group").alias(g), F.col("class").alias(c), F.col("label").alias(p))
    more = met.join(side("g", "a", "p"), "g").join(side("h", "b", "q"), "h").where((F.col("p") != F.col("q")) & (F.col("a") != F.col("b")))
    more = more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = more.union(within_groups(mixed, docs, n, percent, frequent)).distinct()
    edges = edges.union(similar(_possible(more, sums, percent), classes, docs, n, percent))
    labels = connected(edges).withColumnRenamed("node", "class")

    first_of = labels.join(classes.select("class", "first"), "class").groupBy("label").agg(F.min("first").alias("component"))
    linked = labels.join(first_of, "label").select("class", "component")
    ends = classes.select("class", "first").join(linked, "class", "left").select("class", F.coalesce("component", "first").alias("component"))
    return rows.select("doc_id", "size", "class").join(ends, "class", "left").select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _possible(pairs: DataFrame, sums: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes whose counts of hash buckets allow the overlap: no bucket shares more than the smaller count."""
    p = pairs.join(sums.toDF("a", "m", "x"), "a").join(sums.toDF("b", "k", "y"), "b")
    shared = F.aggregate(F.zip_with("x", "y", lambda u, v: F.least(u, v)), F.lit(0), lambda s, u: s + u.cast("int"))
    return p.where(F.col("x").isNull() | F.col("y").isNull() | (shared >= least_overlap(F.col("m"), F.col("k"), percent))).select("a", "b")
