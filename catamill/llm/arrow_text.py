"""Helpers inside Arrow tasks: slices of bounded bytes, a memo of bounded size, and gathering of variable-length runs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANK = re.compile(r"[\x20\x09-\x0D]")


def texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column without nulls, copied so that it starts at offset 0 (some string kernels misread sliced arrays)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    return pc.fill_null(pa.concat_arrays([column, pa.array([], pa.large_string())]), "")


def slices(batches, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices whose texts have about `most` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def cut(text: str, most: int) -> list[str]:
    """A long text in parts of `most` characters or a little more, cut at ASCII white space, which the next part begins with."""
    out, at = [], 0
    while len(text) - at > most:
        m = _BLANK.search(text, at + most)
        if m is None:
            break
        out.append(text[at : m.start()])
        at = m.start()
    return [*out, text[at:]]


class Memo:
    """A dict of at most `most` entries in two generations: the older goes when the younger is full."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most // 2, {}, {}

    def look_up(self, keys: list) -> tuple[list, list[int]]:
        """Values (None where missing) and the places of the missing."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        get, out, missing = self.young.get, [], []
        for k, v in enumerate(map(get, keys)):
            if v is None and (v := self.old.get(keys[k])) is not None:
                self.young[keys[k]] = v
            if v is None:
                missing.append(k)
            out.append(v)
        return out, missing

    def put(self, key, value) -> None:
        self.young[key] = value


def gather(flat: np.ndarray, lengths: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flat holds runs of the given lengths one after another; returns the picked runs one after another, and their ends."""
    starts = np.cumsum(lengths) - lengths
    n = lengths[pick]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts[pick] - (ends - n), n) + np.arange(total)
    return flat[at], ends


def split_runs(text: pa.Array, mark: str) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Splits at the mark: index of each part among the distinct parts, those, and per text the end of its parts. Empty parts are left out."""
    parts = pc.split_pattern(text, mark)
    return _coded(parts)


def split_words(text: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Splits at ASCII white space, like split_runs."""
    return _coded(pc.ascii_split_whitespace(text))


def _coded(parts: pa.LargeListArray) -> tuple[np.ndarray, list[str], np.ndarray]:
    coded = parts.flatten().dictionary_encode()
    ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))
    index = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary.to_pylist()
    if "" in words:
        keep = index != words.index("")
        before = np.concatenate([[0], np.cumsum(keep)])
        index, ends = index[keep], before[ends]
    return index, words, ends
