"""Quality rules: adaptive thresholds from mergeable quantile sketches (KLL) per language and source.

Native: DataFrame functions only. One pass measures every row; sketches of each measure are built per language and
source with partial aggregation, then merged upward per language and over all rows; a group's quartiles shrink toward
those of its language, and these toward those of all rows, the more the fewer rows it has. Documents beyond a threshold
of their group fail; one that meets it stays. Thresholds are outer fences (quartile plus a multiple of the spread), so a group's usual documents
stay whatever its language or source looks like.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.llm.common import SPACE, free_name, join_lookup, written


@dataclass(frozen=True)
class Measure:
    """name: field of the measures. reach: spreads beyond the quartile. least: smallest spread that is taken, so that a
    group in which nearly all values are equal doesn't reject the first that differs. log: compare logarithms.
    low: values under the lower fence fail as well."""

    name: str
    least: float
    reach: float = 4.0
    log: bool = False
    low: bool = False


MEASURES = (
    Measure("symbol_rate", 0.02),
    Measure("dup_line_rate", 0.1),
    Measure("repeat_rate", 0.1),
    Measure("mean_word", 0.08, log=True, low=True),
)


@dataclass(frozen=True)
class Rules:
    """weight: rows that a group's own quartiles must have to count as much as those of the level above. k: of the sketches."""

    min_words: int = 50
    repeat_percent: int = 50
    measures: tuple[Measure, ...] = MEASURES
    weight: float = 5.0
    k: int = 400


def counts() -> dict[str, Column]:
    """Steps of columns over one text `t`; each may use the names of those before it."""
    return {
        "w": F.filter(F.split("t", SPACE + "+"), lambda x: x != ""),
        "lines": F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        # Windows of three words by 64-bit hash, with their place; sorted, equal ones are neighbours.
        "h": F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).otherwise(F.array().cast("array<bigint>")),
        "again": F.size("h") > F.size(F.array_distinct("h")),
        "s": F.when(F.col("again"), F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).otherwise(F.array().cast("array<struct<x:bigint,i:int>>")),
        "at": F.array_sort(F.transform(F.filter("s", lambda e, k: F.coalesce(e.x == F.get("s", k - 1).x, F.lit(False)) | F.coalesce(e.x == F.get("s", k + 1).x, F.lit(False))), lambda e: e.i)),
    }


def measured(docs: DataFrame, text: str, into: str) -> DataFrame:
    """docs with a struct column `into`: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and rates."""
    # The row is packed meanwhile, so that its columns can't clash with the steps' names.
    row = free_name(docs, "__row")
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.coalesce(F.col(text), F.lit("")).alias("t"))
    for name, c in counts().items():
        df = df.withColumn(name, c)
    n = F.size("w").cast("long")
    rate = lambda a, b: F.coalesce(a / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))
    word_chars = F.length(F.regexp_replace("t", SPACE + "+", "")).cast("long")
    n_symbols = F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long")
    n_dup = (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    n_rep = F.aggregate(F.transform("at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.select(row, n.alias("n_words"), word_chars.alias("word_chars"), n_symbols.alias("n_symbols"), n_dup.alias("n_dup_lines"), n_rep.alias("n_repeat_words"), F.size("lines").alias("n_lines"))
    m = F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rate(F.col("n_symbols"), F.col("word_chars")).alias("symbol_rate"),
        rate(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_rate"),
        rate(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_rate"),
        rate(F.col("word_chars"), F.col("n_words")).alias("mean_word"),
    )
    out = df.select(row, m.alias(into))
    return out.select(*[F.col(row)[c].alias(c) for c in docs.columns], into)


def thresholds(m: DataFrame, rules: Rules) -> DataFrame:
    """m: lang, source (no nulls) and the measures' struct `m`, without rows that fail the base rules. Per lang and source: `fence`, a struct of low and high by measure."""
    value = lambda x: F.log(F.greatest(F.col(f"m.{x.name}"), F.lit(1e-6))) if x.log else F.col(f"m.{x.name}")
    by_group = written(m.groupBy("lang", "source").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(value(x), F.lit(rules.k)).alias(f"s_{x.name}") for x in rules.measures]), "sketches")
    merged = lambda df: [F.sum("n").alias("n"), *[F.kll_merge_agg_double(f"s_{x.name}", F.lit(rules.k)).alias(f"s_{x.name}") for x in rules.measures]]

    def quartiles(df: DataFrame, *keys: str) -> DataFrame:
        q = [F.struct(*[F.kll_sketch_get_quantile_double(f"s_{x.name}", F.lit(r)).alias(f"q{k}") for k, r in enumerate((0.25, 0.75))]).alias(x.name) for x in rules.measures]
        return df.select(*keys, "n", F.struct(*q).alias("q"))

    def shrunk(own: Column, n: Column, above: Column) -> Column:
        part = lambda x, k: ((n * own[x.name][k] + rules.weight * above[x.name][k]) / (n + rules.weight)).alias(k)
        return F.struct(*[F.struct(part(x, "q0"), part(x, "q1")).alias(x.name) for x in rules.measures])

    def fence(q: Column, x: Measure) -> Column:
        spread = F.greatest(q[x.name]["q1"] - q[x.name]["q0"], F.lit(x.least)) * x.reach
        return F.struct((q[x.name]["q0"] - spread).alias("low"), (q[x.name]["q1"] + spread).alias("high")).alias(x.name)

    top = quartiles(by_group.groupBy().agg(*merged(by_group)).where(F.col("n") > 0)).first()  # two numbers a measure
    if not top:
        none = F.lit(None).cast("struct<low:double,high:double>")
        return by_group.select("lang", "source", F.struct(*[none.alias(x.name) for x in rules.measures]).alias("fence"))  # no row is left
    every = F.struct(*[F.struct(F.lit(top.q[x.name].q0).alias("q0"), F.lit(top.q[x.name].q1).alias("q1")).alias(x.name) for x in rules.measures])
    langs = quartiles(by_group.groupBy("lang").agg(*merged(by_group)), "lang")
    langs = langs.select("lang", shrunk(F.col("q"), F.col("n"), every).alias("above"))
    groups = quartiles(by_group, "lang", "source").join(langs, "lang").select("lang", "source", shrunk(F.col("q"), F.col("n"), F.col("above")).alias("q"))
    return groups.select("lang", "source", F.struct(*[fence(F.col("q"), x) for x in rules.measures]).alias("fence"))


def apply_rules(docs: DataFrame, rules: Rules = Rules(), into: str = "qr", slim: bool = False) -> DataFrame:
    """docs (text, lang, source, more columns as they are) with a struct `into`: the counts, base_failed, kept, failed (names of measures beyond their fence).

    A null text is empty: it has no words and fails the base rules. Null lang or source are groups of their own. Rows
    are judged one by one and whole, very long ones too, so repeated rows are judged alike. An empty table stays empty.
    Columns of docs are kept whatever their names, except one named `into`;
    slim leaves out text.
    """
    wide = measured(docs.drop(into), "text", into)
    wide = written(wide.drop("text") if slim else wide, "measured")
    key = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("lang", "source")]
    n, rep = F.col(f"{into}.n_words"), F.col(f"{into}.n_repeat_words")
    base_failed = (n < rules.min_words) | (100 * rep > rules.repeat_percent * n)
    slim = wide.select(key[0].alias("lang"), key[1].alias("source"), F.col(into).alias("m"), base_failed.alias("bad"))
    fence = written(thresholds(slim.where(~F.col("bad")), rules), "fences")
    kl, ks, kf = (free_name(wide, x) for x in ("__lang", "__source", "__fence"))
    fence = fence.select(F.col("lang").alias(kl), F.col("source").alias(ks), F.col("fence").alias(kf))
    out = join_lookup(wide.withColumns({kl: key[0], ks: key[1]}), fence, [kl, ks])
    beyond = []
    for x in rules.measures:
        v = F.log(F.greatest(F.col(f"{into}.{x.name}"), F.lit(1e-6))) if x.log else F.col(f"{into}.{x.name}")
        over = v > F.col(f"{kf}.{x.name}.high")
        over = over | (v < F.col(f"{kf}.{x.name}.low")) if x.low else over
        beyond.append(F.when(F.coalesce(over, F.lit(False)), F.lit(x.name)))
    failed = F.array_compact(F.array(*beyond))
    fields = [F.col(f"{into}.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "symbol_rate", "dup_line_rate", "repeat_rate", "mean_word")]
    struct = F.struct(*fields, base_failed.alias("base_failed"), (~base_failed & (F.size(failed) == 0)).alias("kept"), failed.alias("failed"))
    return out.select(*[F.col(f"`{c}`") for c in wide.columns if c != into], struct.alias(into))
