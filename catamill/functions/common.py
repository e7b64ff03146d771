"""Blank tests and reasons: missing values are empty strings throughout, and a rule chain's first hit is its reason."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flags that give Java patterns the reach of Python's on text: Unicode classes, and case folding.
U, UI = "(?U)", "(?iU)"


def text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank(c: Column | str) -> Column:
    return strip(text(c)) == ""


def first_nonblank(*columns: Column) -> Column:
    return F.coalesce(*[F.when(~blank(c), c) for c in columns], F.lit(""))


def matches(c: Column, pattern: str) -> Column:
    """Whether the pattern occurs, case folded."""
    return text(c).rlike(UI + pattern)


def distinct_hits(c: Column, pattern: str, group: int = 0, letters: int | None = None) -> Column:
    """How many different texts the pattern finds (lower case, cut to some letters)."""
    found = F.transform(F.regexp_extract_all(text(c), F.lit(UI + pattern), F.lit(group)), lambda x: F.lower(x) if letters is None else F.substring(F.lower(x), 1, letters))
    return F.size(F.array_distinct(found))


def bind(c: Column, then: Callable[[Column], Column]) -> Column:
    """then(c) with c worked out once, however often `then` uses it: nested functions stay as large as they are written."""
    return F.get(F.transform(F.array(c), then), 0)


Rule = tuple[str | Column, Column]


def first_reason(rules: Sequence[Rule]) -> Column:
    """The reason of the first rule that holds, or null. Each rule is a column of its own, so long chains stay within
    what generated code may hold."""
    return F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(reason) if isinstance(reason, str) else reason) for reason, test in rules])


def all_reasons(rules: Sequence[Rule]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(reason) if isinstance(reason, str) else reason) for reason, test in rules]))
