"""Similarity join of names by token-set ratio: pairs that cannot reach the threshold are left out before they are compared.

A name is its set of tokens. With r the threshold and |a| the length of the sorted tokens joined by spaces, two names
reach r only if

- the common tokens joined by spaces have at least r / (2 - r) of one name's length (one side is nearly all in common), or
- the insertions and deletions between the names, common tokens first, are at most (1 - r)(|a| + |b|). A name's bigrams,
  each token with a blank on either side, are the same in whatever order its tokens stand. A deletion takes two of them
  away and an insertion one, so such names share at least (1.5 r - 1)(|a| + |b|) + 1 bigrams, counted with repeats, and
  the shorter has at least r / (2 - r) of the longer's length. That bound is above 0 where r > 2/3.

Two letters are soon the same, so that of many long names most share some bigrams. Where the threshold allows it, names
are met by longer grams: those of q characters inside each token with its blanks, of which a deletion takes q away at most
and an insertion q - 1. With |b| from r / (2 - r) |a| to its inverse, a name of g such grams shares at least g - c |a| of
them, where c is the greater of q (1 - r / (2 - r)) and (q - 1) ((2 - r) / r - 1). Names for which that is 1 or more meet
one another by these; bigrams are asked only where one of the two is none of these (a short one, or of short tokens).

Grams tell numbered names of one form hardly apart (supplier 000000017, supplier 000000018): what all have in common is as
much as the bound asks for. Where the lengths of two names allow either side to lose one character at most, the names are
met by what is left instead. Of the tokens that they don't share, one side's and the other's, joined, are the same text
once each has lost a character or none; so their tokens, shared ones included, are the same with one character taken out of
one of them (an empty one left out), or two of them run together, or as they are. Names that meet so are nearly all alike,
so that pairs grow with the result and not with the square of a block. Lengths that allow nothing to be lost ask for equal
tokens, which the first bound has.

Marks (tokens, and numbered grams) are ordered by how many names of the block have them, the rarest first. By the first
bound a name shares one of its first tokens, as many as leave less than the bound's length behind them; by the second, both
share one of their first bigrams, and their places there bound how many they can share at all. What is left is counted exactly (bigrams, and
characters, of which the longest common subsequence has no more), and only then compared. The ratio of matching blocks is never above that of insertions and deletions, so the
same bounds hold for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catamill.functions.common import bind
from catamill.functions.similarity import token_set_from
from catamill.functions.texts import STOP
from catamill.session import cut

LEAST = 0.7

#: Lengths of grams from which the longest is taken that leaves a part of a name's grams, at least so large, in common.
LONG_GRAMS, LEFT = (5, 4, 3), 0.15

#: Length up to which names are met by their texts less one character; longer ones would have too many, and have many grams.
LESS_ONE = 64


def _long_gram(threshold: float) -> tuple[int, float] | None:
    """q, and the grams that edits may cost a name for each of its characters (c); None where no q leaves enough."""
    share = threshold / (2 - threshold)
    costs = {q: max(q * (1 - share), (q - 1) * (1 / share - 1)) for q in LONG_GRAMS}
    return next(((q, c) for q, c in costs.items() if 1 - c >= LEFT), None)


def tokens_of(name: Column, flavour: str) -> Column:
    """The name's distinct tokens, sorted; without stop words for matching blocks."""
    words = F.filter(F.array_distinct(F.split(name, r"\s+")), lambda w: w != "")
    if flavour == "blocks":
        words = F.filter(words, lambda w: ~w.isin(*sorted(STOP)))
    return F.array_sort(words)


def _numbered(items: Column) -> Column:
    """Each item with its number among equal ones: ab#1, ab#2. Sorted, equal ones are neighbours, so that the number is an
    item's place less that of the first of them."""
    return bind(F.array_sort(items), lambda ordered: F.transform(ordered, lambda x, i: F.concat(x, F.lit("#"), (i + 2 - F.array_position(ordered, x)).cast("string"))))


def bigrams_of(tokens: Column) -> Column:
    """Bigrams of all tokens with a blank on either side, numbered."""
    return _numbered(F.flatten(F.transform(tokens, lambda t: F.transform(F.sequence(F.lit(1), F.length(t) + 1), lambda i: F.substring(F.concat(F.lit(" "), t, F.lit(" ")), i, F.lit(2))))))


def long_grams_of(tokens: Column, q: int) -> Column:
    """Grams of q characters of all tokens with a blank on either side, numbered; shorter tokens have none."""
    inside = F.filter(tokens, lambda t: F.length(t) + 2 >= q)
    return _numbered(F.flatten(F.transform(inside, lambda t: F.transform(F.sequence(F.lit(1), F.length(t) + 3 - q), lambda i: F.substring(F.concat(F.lit(" "), t, F.lit(" ")), i, F.lit(q))))))


def less_one(tokens: Column) -> Column:
    """The tokens, sorted and joined by blanks: as they are, and each way with one character less, one between two tokens
    included."""
    ends = lambda i: F.slice(tokens, i + 2, F.size(tokens))
    shorter = lambda t, i: F.transform(F.sequence(F.lit(1), F.length(t)), lambda j: F.concat(F.slice(tokens, 1, i), ends(i), F.array(F.concat(F.substring(t, F.lit(1), j - 1), F.substring(t, j + 1, F.length(t))))))
    joined = lambda t, i: F.transform(ends(i), lambda u, j: F.concat(F.slice(tokens, 1, i), F.slice(ends(i), 1, j), F.slice(ends(i), j + 2, F.size(tokens)), F.array(F.concat(t, u))))
    ways = F.concat(F.array(tokens), F.flatten(F.transform(tokens, shorter)), F.flatten(F.transform(tokens, joined)))
    return F.array_distinct(F.transform(ways, lambda w: F.array_join(F.array_sort(F.filter(w, lambda t: t != "")), " ")))


def _letters_of(tokens: Column) -> Column:
    """Characters of the tokens joined by blanks, numbered."""
    return _numbered(F.split(F.array_join(tokens, " "), ""))


def _size(tokens: Column) -> Column:
    """Length of the tokens joined by blanks."""
    return F.length(F.array_join(tokens, " "))


def _needed_grams(total: Column, threshold: float) -> Column:
    """Bigrams that names of that total length share at least; rounding never asks for too many."""
    return F.ceil(total * (1.5 * threshold - 1) + 1 - 1e-6)


def _shed(a: Column, b: Column, threshold: float) -> Column:
    """Characters that the longer of two names of these lengths may lose at most; null where they are too unlike in length."""
    common = F.ceil((a + b) * threshold / 2 - 1e-6)
    return F.when(common <= F.least(a, b), F.greatest(a, b) - common)


def _by_one(a: Column, b: Column, threshold: float) -> Column:
    """Whether names of these lengths are met by their texts less one character."""
    return F.coalesce((_shed(a, b, threshold) == 1) & (F.greatest(a, b) <= LESS_ONE), F.lit(False))


def _by_grams(a: Column, b: Column, threshold: float) -> Column:
    """Whether names of these lengths are met by grams."""
    return F.coalesce((_shed(a, b, threshold) >= 1) & ~_by_one(a, b, threshold), F.lit(False))


def _asked(sets: DataFrame, block: Sequence[str], threshold: float) -> DataFrame:
    """sets with what others of its block ask of a name by their lengths: `one` (its texts less one character), `g`
    (bigrams: one of the two has no long grams that serve) and `q` (long grams)."""
    lens = sets.groupBy(*block, F.col("own.len").alias("len")).agg((F.count("*") > 1).alias("many"), F.bool_or(~F.col("meets")).alias("short"))
    lens = lens.groupBy(*block).agg(F.collect_list(F.struct("len", "many", "short")).alias("lens"))
    asks = lambda x, how: F.exists("lens", lambda y: ((x["len"] != y["len"]) | x["many"]) & how(x, y))
    flags = F.transform("lens", lambda x: F.struct(
        x["len"].alias("len"), asks(x, lambda x, y: _by_one(x["len"], y["len"], threshold)).alias("one"), asks(x, lambda x, y: _by_grams(x["len"], y["len"], threshold)).alias("any"),
        asks(x, lambda x, y: _by_grams(x["len"], y["len"], threshold) & y["short"]).alias("short"),
    ))
    flags = lens.select(*block, F.inline(flags))
    both = sets.withColumn("len", F.col("own.len")).join(flags, [*block, "len"])
    return both.withColumns({"g": F.col("any") & (~F.col("meets") | F.col("short")), "q": F.col("any") & F.col("meets")}).drop("any", "short")


def _possible(threshold: float) -> Column:
    """Of pairs with each side's tokens (t), length (len), bigrams and letters, as structs x and y: whether either bound is
    met. Characters in common, counted with repeats, are no fewer than those of the longest common subsequence."""
    share, x, y = threshold / (2 - threshold), F.col("x"), F.col("y")
    a, b = x["len"], y["len"]
    both = lambda c: F.array_intersect(x[c], y[c])
    common = bind(both("t"), lambda c: (F.size(c) > 0) & (_size(c) >= share * F.least(a, b) - 1e-6))
    near = (F.least(a, b) >= share * F.greatest(a, b) - 1e-6) & (F.size(both("letters")) >= threshold * (a + b) / 2 - 1e-6)
    return common | (near & (F.size(both("grams")) >= _needed_grams(a + b, threshold)))


def _met(names: DataFrame, block: Sequence[str], threshold: float, flavour: str) -> tuple[DataFrame, DataFrame]:
    """names: block.., n, distinct, and maybe `side` (1, 2, or 3 for both). Returns the names' own lists (block.., n, own),
    and block.., m, n (m before n) of all pairs that share a mark within the bounds of their places; with sides, of those
    alone of which one name is on one side and one on the other."""
    if threshold < LEAST:
        raise ValueError(f"no bound holds below {LEAST}")
    share = threshold / (2 - threshold)
    side_of = F.col("side") if "side" in names.columns else F.lit(3)
    sets = names.select(*block, "n", side_of.cast("int").alias("side"), tokens_of(F.col("n"), flavour).alias("t")).where(F.size("t") > 0)
    # Each name's own lists are made once; pairs take them along.
    sets = sets.select(*block, "n", "side", F.struct(F.col("t"), _size(F.col("t")).alias("len"), bigrams_of(F.col("t")).alias("grams"), _letters_of(F.col("t")).alias("letters")).alias("own"))
    long = _long_gram(threshold)
    q, cost = long if long else (0, 0.0)
    longs = long_grams_of(F.col("own.t"), q) if long else F.array().cast("array<string>")
    sets = sets.withColumn("longs", longs).withColumn("need", F.ceil(F.size("longs") - F.col("own.len") * cost - 1e-6).cast("int") if long else F.lit(0))
    sets = cut(sets.withColumn("meets", F.col("need") >= 1))  # read several times
    asked = _asked(sets, block, threshold)
    mark = lambda kind, xs: F.transform(xs, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("mark")))
    none = F.array().cast("array<struct<kind:string,mark:string>>")
    marks = F.concat(mark("t", F.col("own.t")), F.when(F.col("g"), mark("g", F.col("own.grams"))).otherwise(none), F.when(F.col("q"), mark("q", F.col("longs"))).otherwise(none))
    each = asked.select(*block, "n", "side", "meets", "need", "len", F.explode(marks).alias("m")).select(*block, "n", "side", "meets", "need", "len", "m.kind", "m.mark")
    often = each.groupBy(*block, "kind", "mark").agg(F.count("*").alias("often"))
    # By name: its marks of each kind, the rarest first.
    lists = each.join(often, [*block, "kind", "mark"]).groupBy(*block, "n", "side", "meets", "need", "len", "kind").agg(F.array_sort(F.collect_list(F.struct("often", "mark"))).alias("marks"))
    lists = cut(lists.select(*block, "n", "side", "meets", "need", "len", "kind", F.transform("marks", lambda m: m["mark"]).alias("marks")))  # read on both sides of the join
    # Tokens: the length from each to the end tells whether what follows it could still reach the bound alone.
    rest = F.transform("marks", lambda m, i: F.length(F.array_join(F.slice("marks", i + 1, F.size("marks")), " ")))
    first_tokens = F.size(F.filter(rest, lambda left: left >= F.col("len") * share - 1e-6))
    grams = F.size("marks")
    first_grams = F.least(grams, grams - _needed_grams(F.col("len") * 2 / (2 - threshold), threshold).cast("int") + 1)
    heads = lists.withColumn("head", F.when(F.col("kind") == "t", first_tokens).when(F.col("kind") == "g", first_grams).otherwise(grams - F.col("need") + 1))
    placed = heads.select(*block, "n", "side", "meets", "need", "len", "kind", F.size("marks").alias("count"), "head", F.posexplode("marks").alias("place", "mark"))
    here = placed.where((F.col("place") < F.col("head")) & ((F.col("kind") != "g") | ~F.col("meets")))
    there = placed.where((F.col("kind") == "t") | (F.col("place") < F.col("head")))
    x, y = here.alias("x"), there.alias("y")
    on = (F.col("x.mark") == F.col("y.mark")) & (F.col("x.n") != F.col("y.n")) & (F.col("x.side").bitwiseOR(F.col("y.side")) == 3)
    for b in block:
        on = on & (F.col(f"x.{b}") == F.col(f"y.{b}"))
    total = F.col("x.len") + F.col("y.len")
    left = F.least(F.col("x.count") - F.col("x.place"), F.col("y.count") - F.col("y.place"))
    # Each pair is met once: a name that only bigrams serve looks for all others, else the first looks for the second.
    turn = (F.col("x.n") < F.col("y.n")) | ((F.col("x.kind") == "g") & F.col("y.meets"))
    needed = F.when(F.col("x.kind") == "g", _needed_grams(total, threshold)).otherwise(F.greatest("x.need", "y.need", F.ceil((F.col("x.count") + F.col("y.count")) / 2 - (q - 0.5) * (1 - threshold) * total - 1e-6)))
    grams_fit = turn & (F.least("x.len", "y.len") >= share * F.greatest("x.len", "y.len") - 1e-6) & (left >= needed) & _by_grams(F.col("x.len"), F.col("y.len"), threshold)
    met = x.join(y, on & (F.col("x.kind") == F.col("y.kind")) & F.when(F.col("x.kind") == "t", F.lit(True)).otherwise(grams_fit))
    less = asked.where("one").select(*block, "n", "side", "len", F.explode(less_one(F.col("own.t"))).alias("mark"))
    near = less.alias("x").join(less.alias("y"), on & (F.col("x.n") < F.col("y.n")) & _by_one(F.col("x.len"), F.col("y.len"), threshold))
    pair = [*[F.col(f"x.{b}").alias(b) for b in block], F.least("x.n", "y.n").alias("m"), F.greatest("x.n", "y.n").alias("n")]
    return sets, met.select(*pair).union(near.select(*pair)).distinct()


def candidate_names(names: DataFrame, block: Sequence[str], threshold: float, flavour: str = "indel") -> DataFrame:
    """names: block.., n, distinct. Returns block.., m, n (m before n) of all pairs that may reach the threshold, by all bounds."""
    sets, pairs = _met(names, block, threshold, flavour)
    side = lambda n, own: sets.select(*block, F.col("n").alias(n), F.col("own").alias(own))
    return pairs.join(side("m", "x"), [*block, "m"]).join(side("n", "y"), [*block, "n"]).where(_possible(threshold)).select(*block, "m", "n")


def similar_names(names: DataFrame, block: Sequence[str], threshold: float, flavour: str = "indel") -> DataFrame:
    """names: block.., n. Returns block.., m, n, ratio of all pairs of different names of a block that reach the threshold.
    With `side` (one row a name: 1, 2, or 3 for both), of those alone that stand on different sides."""
    # Pairs go to be compared without their lists, which are many times their names.
    ratio = token_set_from(threshold, flavour)("m", "n")
    _, found = _met(names.select(*block, "n", *[c for c in names.columns if c == "side"]).where(F.col("n") != "").distinct(), block, threshold, flavour)
    return found.withColumn("ratio", ratio).where(F.col("ratio") >= threshold)


def both_ways(pairs: DataFrame, block: Sequence[str], *more: str) -> DataFrame:
    """Each pair (m, n) and the same pair turned round."""
    turns = F.explode(F.array(F.struct("m", "n"), F.struct(F.col("n").alias("m"), F.col("m").alias("n")))).alias("p")
    return pairs.select(*block, *more, turns).select(*block, "p.m", "p.n", *more)


def similar_pairs(rows: DataFrame, block: Sequence[str], name: str, key: str, threshold: float, flavour: str = "indel") -> DataFrame:
    """a, b (keys, a before b), ratio of rows of one block whose names reach the threshold. Names are compared once however
    many rows have them; equal names have a ratio of 1, blank names reach nothing, nor do null keys of a block."""
    rows = rows.select(*block, F.col(key).alias("k"), F.col(name).alias("n")).where(F.col("n") != "")
    one = similar_names(rows, block, threshold, flavour)
    both = both_ways(one, block, "ratio").unionByName(rows.select(*block, F.col("n").alias("m"), "n", F.lit(1.0).alias("ratio")).distinct())
    a, b = rows.select(*block, F.col("k").alias("a"), F.col("n").alias("m")), rows.select(*block, F.col("k").alias("b"), "n")
    return a.join(both, [*block, "m"]).join(b, [*block, "n"]).where(F.col("a") < F.col("b")).select("a", "b", "ratio")
