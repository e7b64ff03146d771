"""Token-set similarity of names, in two flavours that are not interchangeable, as Arrow-batched functions."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from catamill.functions.texts import STOP


def _three(a: set[str], b: set[str]) -> tuple[str, str, str]:
    """The sorted common tokens, and those followed by each side's own."""
    common = " ".join(sorted(a & b))
    return common, f"{common} {' '.join(sorted(a - b))}".strip(), f"{common} {' '.join(sorted(b - a))}".strip()


def block_ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & at.get(c, 0)
        state = (state + hit | state - hit) & full
    return len(a) - state.bit_count()


def indel_ratio(a: str, b: str) -> float:
    return 2 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 1.0


def token_set(a: str, b: str, flavour: str) -> float:
    """0 to 1. a, b: names already normalized. flavour `blocks`: matching blocks, stop words left out; `indel`:
    insertions and deletions, and 1 where one side's tokens are all the other's."""
    x, y = set(a.split()), set(b.split())
    if flavour == "blocks":
        x, y = x.difference(STOP), y.difference(STOP)
        if not x or not y:
            return float(bool(a) and a == b)
    elif not x or not y:
        return 0.0
    common, left, right = _three(x, y)
    if flavour == "indel":
        return 1.0 if common and (x <= y or y <= x) else max(indel_ratio(left, right), *(indel_ratio(common, s) if common else 0.0 for s in (left, right)))
    return max(block_ratio(left, right), *(block_ratio(common, s) if common else 0.0 for s in (left, right)))


@F.pandas_udf(DoubleType())
def token_set_blocks(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set(x or "", y or "", "blocks") for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def token_set_indel(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set(x or "", y or "", "indel") for x, y in zip(a, b, strict=True)], dtype="float64")


def token_set_from(threshold: float, flavour: str):
    """The same as a function of two columns, which may give 0 where the threshold is not reached: of matching blocks that
    is known from the common subsequence, which is quick to find and never shorter."""

    def reached(a: str, b: str) -> float:
        if flavour == "blocks":
            x, y = set(a.split()).difference(STOP), set(b.split()).difference(STOP)
            common, left, right = _three(x, y)
            if x and y and max(indel_ratio(left, right), *(indel_ratio(common, s) if common else 0.0 for s in (left, right))) < threshold:
                return 0.0
        return token_set(a, b, flavour)

    def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([reached(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")

    return F.pandas_udf(ratios, DoubleType())


def words(s: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", s.lower())
