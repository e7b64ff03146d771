"""Packing of tokenized documents into fixed-length sequences: shortest-pack-first over the length histogram.

Documents are cut into whole windows of the sequence length and one remainder. The histogram of piece lengths has at
most `size` entries whatever the number of documents, so the packing itself runs on it alone: lengths are placed
longest first, each into the pattern with the fewest tokens that still has room, and counts of patterns are split as
they change; pieces of equal length may share a pattern. Patterns then meet the pieces again by the rank of a piece among
those of its length; ranks come from windows over salted parts of each length and the parts' counts. A length has more
parts the more pieces it has, so one that holds a third of all rows is spread.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catamill.llm.arrow_text import Memo, gather, slices, split_words, texts
from catamill.llm.common import written

PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"
#: Parts of all lengths for ranking, besides one a length; of what they hold, at least LEAST pieces.
PARTS, LEAST = 8192, 500
#: Bytes of text in a step, and words that a worker remembers.
STEP, REMEMBERED = 4 << 20, 300_000


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """(count, lengths) of each pattern. Longest lengths first; a length goes to the pattern with the fewest tokens that
    has room (the shortest pack), else to new packs, which take as many of that length as they hold."""
    open_packs: dict[int, list[tuple[int, list[int]]]] = {}  # by tokens used
    used: list[int] = []  # the keys of open_packs, ascending
    full: list[tuple[int, list[int]]] = []

    def add(total: int, count: int, pack: list[int]) -> None:
        if total == size:
            full.append((count, pack))
            return
        if total not in open_packs:
            open_packs[total] = []
            used.insert(bisect_left(used, total), total)
        open_packs[total].append((count, pack))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not used or used[0] + length > size:
                each = size // length
                if left >= each:
                    add(length * each, left // each, [length] * each)
                if left % each:
                    add(length * (left % each), 1, [length] * (left % each))
                break
            total = used[0]
            count, pack = open_packs[total].pop()
            if not open_packs[total]:
                del open_packs[total], used[0]
            taken = min(left, count)
            if taken < count:
                add(total, count - taken, pack)
            add(total + length, taken, [*pack, length])
            left -= taken
    return full + [x for t in used for x in open_packs[t]]


def tokenized_pieces(docs: DataFrame, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece of docs (doc_id, text; null: empty).

    Where the vocabulary's file says that it drops white space and never joins across it, words between white space are
    tokenized once each and remembered; a space put between a letter and a punctuation mark changes nothing, as no token
    has both. Texts that hold a mark of the vocabulary's own (like an end of text), and all texts of other vocabularies,
    are tokenized whole, a text at a time.
    """

    def pieces(batches) -> Iterator[pa.RecordBatch]:
        encode, memo, marks, by_words = _tokenizer(vocabulary)
        for batch in slices(batches, 1, STEP):
            plain = texts(batch.column(1))
            low = pc.ascii_lower(plain)
            whole = np.full(batch.num_rows, not by_words)
            for mark in marks:
                whole |= pc.match_substring(low, mark.lower()).to_numpy(zero_copy_only=False)
            text = pc.replace_substring_regex(pc.if_else(pa.array(whole), "", low), r"(\pL)([.,;:!?])", r"\1 \2")
            index, words, word_ends = split_words(text)
            values, missing = memo.look_up(words)
            for k, ids in zip(missing, encode([words[k] for k in missing]), strict=True):
                values[k] = ids
                memo.put(words[k], ids)
            lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
            ids, ends = gather(np.frombuffer(b"".join(values), "<u4"), lengths, index)
            ends = np.concatenate([[0], ends])[word_ends]
            rows: list[tuple] = []
            begin = 0
            for k, (doc, end) in enumerate(zip(batch.column(0).to_pylist(), ends.tolist(), strict=True)):
                found = np.frombuffer(next(encode([plain[k].as_py()])), "<u4") if whole[k] else ids[begin:end]
                own = np.append(found, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(own), size):
                    piece = own[start : start + size]
                    rows.append((doc, start, len(piece), zlib.crc32(piece.tobytes()), len(own)))
                begin = end
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECES)


#: What the file of a vocabulary must say for words to be tokenized one by one.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}

_LOADED: dict[str, tuple] = {}


def _tokenizer(vocabulary: str) -> tuple:
    """Encoder of lists of texts, the memo of this worker, the vocabulary's own marks, and whether it splits at white space."""
    if vocabulary not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as f:
            file = json.load(f)
        split = (file["pre_tokenizer"] or {}).get("pretokenizers", [None, None])
        known = file["normalizer"] == NORMALIZER and split[0] == SPLIT and len(split) == 2 and not split[1].get("add_prefix_space") and not file["post_processor"]
        marks = [x["content"] for x in file["added_tokens"]]
        _LOADED[vocabulary] = (lambda found: (np.array(e.ids, "<u4").tobytes() for e in t.encode_batch_fast(found, add_special_tokens=False)), Memo(REMEMBERED), marks, known)
    return _LOADED[vocabulary]


def parts_of(histogram: dict[int, int]) -> dict[int, int]:
    """Parts in which each length is ranked: one, and more in proportion to its pieces; PARTS and one a length in all at most."""
    each = max(LEAST, -(-sum(histogram.values()) // PARTS))
    return {n: 1 + count // each for n, count in histogram.items()}


def place(salts: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), salts).cast("int")


def pack(docs: DataFrame, vocabulary: str, end_id: int, size: int = 4096) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece of docs (doc_id, text).

    Null and empty texts have the end id alone; very long texts have as many pieces as they need. Repeated rows are
    packed as often as they stand there; ties of length and id are ranked in any order. An empty table gives no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    pieces = written(tokenized_pieces(docs, vocabulary, end_id, size), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `size` rows
    runs: dict[int, list[tuple[int, int, int, int, int]]] = {}
    placed: dict[int, int] = dict.fromkeys(histogram, 0)
    sequence = 0
    for count, lengths in pack_histogram(histogram, size):
        offset = 0
        for n, same in groupby(lengths):
            each = len(list(same))
            runs.setdefault(n, []).append((placed[n], placed[n] + count * each, each, sequence, offset))
            placed[n] += count * each
            offset += n * each
        sequence += count
    # One row per length: its parts, the pieces in the parts before each, and the runs of ranks that each slot of a
    # pattern takes. Its size follows `size` and PARTS, not the input.
    salts = parts_of(histogram)
    salted = pieces.join(F.broadcast(spark.createDataFrame(list(salts.items()), "length int, salts int")), "length").withColumn("salt", place(F.col("salts")))
    before = {n: [0] * k for n, k in salts.items()}
    for r in salted.groupBy("length", "salt").count().collect():  # at most PARTS and one a length
        before[r["length"]][r["salt"]] = r["count"]
    before = {n: np.cumsum([0, *x[:-1]]).tolist() for n, x in before.items()}
    table = spark.createDataFrame([(n, salts[n], before[n], runs[n]) for n in runs], "length int, salts int, before array<bigint>, runs array<struct<first:bigint,past:bigint,each:bigint,sequence:bigint,offset:bigint>>")
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")) - 1
    out = pieces.join(F.broadcast(table), "length").withColumn("salt", place(F.col("salts"))).withColumn("own", own)
    out = out.withColumn("rank", F.get("before", F.col("salt")) + F.col("own"))
    run = F.filter("runs", lambda r: (F.col("rank") >= r["first"]) & (F.col("rank") < r["past"]))[0]
    out, at = out.withColumn("run", run), F.col("rank") - F.col("run.first")
    return out.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("run.sequence") + F.expr("(rank - run.first) div run.each")).cast("long").alias("sequence_id"), (F.col("run.offset") + at % F.col("run.each") * F.col("length")).cast("long").alias("offset"),
    )
