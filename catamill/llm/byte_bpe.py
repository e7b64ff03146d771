"""Byte-level BPE: encoding by backtracking over longest matches, and decoding.

Bytes map to Latin-1 characters, so that an Aho-Corasick automaton finds tokens. A text is a token sequence in which
each adjacent pair is compatible: merging the bytes of both by rank gives back just the two. The exact merge result is
the only such sequence, so encoding takes the longest match at each place, checks it against the token before
(memoised), tries shorter prefixes and else steps back, never reaching a dead place twice: linear time.

Texts are first split where the pattern must split anyway (before a single space, around a single line break, between
a letter and a punctuation mark); distinct parts are encoded once each and remembered.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catamill.llm.arrow_text import Memo, gather, slices, split_runs, texts

#: Bytes of text in a step; parts that a worker remembers; adjacent pairs that it remembers.
STEP, REMEMBERED, PAIRS = 3 << 20, 300_000, 600_000
#: Texts with two white-space characters in a row, or the mark, are split by the pattern alone.
SPACES = r"[\s\pZ\x0b\x1c-\x1f\x{85}]{2}|\x00"


class BytePairEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.find = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            self.find.add_word(token.decode("latin-1"), rank)
        self.find.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.alone: dict[int, bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})

    def merged(self, data: bytes) -> list[int]:
        """Merges by rank from single bytes, for the few bytes of a token or two."""
        parts, ranks = [data[i : i + 1] for i in range(len(data))], self.ranks
        while len(parts) > 1:
            rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def spine(self, token: int, right: bool) -> list[tuple[int, bytes]]:
        """(rank, bytes) of the token's last byte (or first), then of each merge that took it in, up to the token."""
        if (known := self.spines[right].get(token)) is None:
            data = self.bytes_of[token]
            if len(data) == 1:
                known = [(-1, data)]
            else:
                parts = [data[i : i + 1] for i in range(len(data))]
                while len(parts) > 2:
                    at = min(range(len(parts) - 1), key=lambda i: (self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i))
                    parts[at : at + 2] = [parts[at] + parts[at + 1]]
                known = [*self.spine(self.ranks[parts[right]], right), (token, data)]
            self.spines[right][token] = known
        return known

    def fits(self, before: int | None, token: int) -> bool:
        """Whether the pair stays as it is when merged; without a token before, whether the token itself is reached.

        While both are built up by rank, only the parts at their border can merge across it; the pair fits if at no
        time such a merge has a lower rank than the next one that either side makes on its own.
        """
        if (ok := self.alone.get(token)) is None:
            ok = self.alone[token] = self.merged(self.bytes_of[token]) == [token]
        if before is None or not ok:
            return ok
        if (ok := self.compatible.get((before, token))) is None:
            if len(self.compatible) >= PAIRS:
                self.compatible.clear()
            ok, get = True, self.ranks.get
            a, b = self.spine(before, True), self.spine(token, False)
            i, j, last_a, last_b = 0, 0, len(a) - 1, len(b) - 1
            while True:
                next_a = a[i + 1][0] if i < last_a else 1 << 60
                next_b = b[j + 1][0] if j < last_b else 1 << 60
                across = get(a[i][1] + b[j][1])
                if across is not None and across < next_a and across <= next_b:
                    ok = False
                    break
                if i == last_a and j == last_b:
                    break
                if next_a <= next_b:
                    i += 1
                else:
                    j += 1
            self.compatible[before, token] = ok
        return ok

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        starting: list[list[int]] = [[] for _ in range(n)]  # tokens by start, shorter ones first
        for end, rank in self.find.iter(piece.decode("latin-1")):
            starting[end + 1 - len(self.bytes_of[rank])].append(rank)
        out: list[int] = []
        at, dead = 0, bytearray(n + 1)
        left = [len(s) for s in starting]  # matches still to be tried at each place
        while at < n:
            before = out[-1] if out else None
            while left[at]:
                left[at] -= 1
                token = starting[at][left[at]]
                end = at + len(self.bytes_of[token])
                if not dead[end] and self.fits(before, token):
                    out.append(token)
                    at = end
                    if at < n:
                        left[at] = len(starting[at])
                    break
            else:
                dead[at] = 1
                at -= len(self.bytes_of[out.pop()])
        return out

    def encode(self, text: str) -> list[int]:
        return [t for piece in self.pattern.findall(text) for t in self.encode_piece(piece.encode())]


_LOADED: dict[tuple[str, str], tuple] = {}


def _loaded(path: str, pattern: str) -> tuple[BytePairEncoder, Memo, pa.Array, pa.Array]:
    """Of this worker: the encoder, remembered parts, and each id's decimal digits with a comma and its bytes."""
    if (path, pattern) not in _LOADED:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        e = BytePairEncoder(ranks, pattern)
        _LOADED[path, pattern] = e, Memo(REMEMBERED), pa.array([b"%d," % i for i in range(len(e.bytes_of))], pa.large_binary()), pa.array(e.bytes_of, pa.large_binary())
    return _LOADED[path, pattern]


def _ids(text: pa.Array, encoder: BytePairEncoder, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after another, and each text's end."""
    plain = pc.invert(pc.match_substring_regex(text, SPACES))
    marked = pc.replace_substring_regex(pc.if_else(plain, text, ""), r"(\pL)([.,;:!?])", "\\1\x00\\2")
    marked = pc.replace_substring(pc.replace_substring(marked, " ", "\x00 "), "\n", "\x00\n\x00")
    index, parts, part_ends = split_runs(marked, "\x00")
    values, missing = memo.look_up(parts)
    for k in missing:
        values[k] = np.array(encoder.encode(parts[k]), "<u4").tobytes()
        memo.put(parts[k], values[k])
    lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
    flat, ends = gather(np.frombuffer(b"".join(values), "<u4"), lengths, index)
    ends = np.concatenate([[0], ends])[part_ends]
    if pc.all(plain).as_py() is not False:
        return flat, ends
    runs, begin = [], 0
    for k, (own, end) in enumerate(zip(plain.to_pylist(), ends.tolist(), strict=True)):
        runs.append(flat[begin:end] if own else np.array(encoder.encode(text[k].as_py()), np.uint32))
        begin = end
    return np.concatenate(runs), np.cumsum([len(r) for r in runs])


def encode(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int) of every row of docs (doc_id, text; others are not read). Null texts are empty and have no
    ids; very long texts are encoded whole; equal texts have equal ids, so repeated rows do; an empty table gives no rows."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        encoder, memo, *_ = _loaded(vocabulary, pattern)
        for batch in slices(batches, 1, STEP):
            flat, ends = _ids(texts(batch.column(1)), encoder, memo)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends, prepend=0), pa.int64()), ids], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decode(ids: DataFrame, vocabulary: str, pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to keep, decoded (binary) and ids_text (decimal ids joined by commas) of rows of doc_id, ids. Null
    lists are empty; repeated rows are decoded as often as they stand there; an empty table gives no rows."""
    kept = ["doc_id", *keep]

    def run(batches) -> Iterator[pa.RecordBatch]:
        *_, digits, token_bytes = _loaded(vocabulary, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lists = part.column(len(kept))
                flat = lists.flatten()
                ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
                columns = list(part.columns[:-1])
                for words, cut in ((token_bytes, 0), (digits, 1)):
                    taken = words.take(flat)
                    offsets = np.frombuffer(taken.buffers()[1], np.int64, len(flat) + 1, taken.offset * 8)[ends]
                    data = taken.buffers()[2]
                    # A text's bytes are one run of the buffer; of the digits the last comma goes.
                    columns.append(pa.array([data[a : max(a, b - cut)].to_pybytes() if data is not None else b"" for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*kept, "decoded", "ids_text"])

    ids = ids.select(*kept, "ids")
    fields = [T.StructField(c, T.BinaryType()) for c in ("decoded", "ids_text")]
    return ids.mapInArrow(run, T.StructType([*ids.schema.fields[:-1], *fields]))
