"""Telephony audio columns: mu-law, A-law and ADPCM (IMA) media, expanded by tables or decoded over all blocks at once,
and stored as resampled PCM.

Media are WAV files (RIFF) with one channel. mu-law and A-law expand through tables of 256 entries. ADPCM blocks start
with a predictor and a step index, so all blocks of a batch are decoded together: one numpy step per sample of a
block, over as many blocks as there are.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catamill.llm.arrow_text import slices

#: WAV format tags.
PCM, ALAW, MULAW, IMA = 1, 6, 7, 17
#: Bytes of an ADPCM block: 4 of header and two samples in each other byte.
BLOCK = 64
#: Bytes of media in a step.
STEP = 2 << 20


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = ((((code & 15) << 3) + 132) << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    segment, size = (code >> 4) & 7, ((code & 15) << 4) + 8
    size = np.where(segment > 0, (size + 256) << np.maximum(segment - 1, 0), size)
    return np.where(code & 128, size, -size).astype(np.int16)


# Fixed values of the format (IMA ADPCM): step sizes and index moves.
IMA_STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
    1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132,
    7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
IMA_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int8)

MULAW_TABLE, ALAW_TABLE = mulaw_table(), alaw_table()


def _ima_tables() -> tuple[np.ndarray, np.ndarray]:
    """Change of the predictor and next index, by index * 16 + code."""
    step, code = IMA_STEPS[:, None], np.arange(16)[None, :]
    change = (step >> 3) + ((code & 1) > 0) * (step >> 2) + ((code & 2) > 0) * (step >> 1) + ((code & 4) > 0) * step
    change = np.where(code & 8, -change, change)
    move = np.clip(np.arange(89)[:, None] + IMA_MOVES[None, :], 0, 88)
    return change.astype(np.int32).ravel(), (move * 16).astype(np.int32).ravel()


IMA_CHANGE, IMA_NEXT = _ima_tables()


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """blocks: bytes, one block a row. Samples (int16), one block a row: the header's predictor, then two a byte, low nibble first. An index beyond 88 counts as 88."""
    data = np.ascontiguousarray(blocks[:, 4:].T)
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], 88).astype(np.int32) * 16
    out = np.empty((1 + 2 * len(data), len(blocks)), np.int16)
    out[0] = value
    k = 1
    for byte in data:
        for nibble in (byte & 15, byte >> 4):
            at = index + nibble
            value += IMA_CHANGE[at]
            np.clip(value, -32768, 32767, out=value)
            index = IMA_NEXT[at]
            out[k] = value
            k += 1
    return out.T


def encode_ima(samples: np.ndarray, block: int = BLOCK) -> bytes:
    """ADPCM blocks of int16 samples, all blocks at once; the last is filled with its last sample. No samples, no bytes."""
    per = 1 + 2 * (block - 4)
    if not len(samples):
        return b""
    n = -(-len(samples) // per)
    x = np.concatenate([samples, np.repeat(samples[-1:], n * per - len(samples))]).astype(np.int32).reshape(n, per)
    out = np.zeros((n, block), np.uint8)
    out[:, :2] = x[:, 0].astype("<i2").view(np.uint8).reshape(n, 2)
    value, index = x[:, 0].copy(), np.zeros(n, np.int32)
    for k in range(1, per):
        step, gap = IMA_STEPS[index], x[:, k] - value
        code = np.where(gap < 0, 8, 0) + np.minimum(np.abs(gap) * 4 // step, 7)
        at = index * 16 + code
        value = np.clip(value + IMA_CHANGE[at], -32768, 32767)
        index = IMA_NEXT[at] // 16
        out[:, 4 + (k - 1) // 2] |= (code << (4 * ((k - 1) % 2))).astype(np.uint8)
    return out.tobytes()


def wav(tag: int, data: bytes, rate: int) -> bytes:
    """A WAV file of one channel."""
    bits, align = {PCM: (16, 2), ALAW: (8, 1), MULAW: (8, 1), IMA: (4, BLOCK)}[tag]
    per_second = {PCM: 2 * rate, ALAW: rate, MULAW: rate, IMA: rate * BLOCK // (1 + 2 * (BLOCK - 4))}[tag]
    extra = struct.pack("<HH", 2, 1 + 2 * (BLOCK - 4)) if tag == IMA else b"" if tag == PCM else struct.pack("<H", 0)
    fmt = struct.pack("<HHIIHH", tag, 1, rate, per_second, align, bits) + extra
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> tuple[int, int, bytes]:
    """Format tag, rate and sample bytes of a WAV file; chunks other than fmt and data are skipped."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, tag, rate = 12, 0, 0
    while at + 8 <= len(media):
        name, n = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        if name == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", media, at + 8)
        elif name == b"data":
            return tag, rate, media[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("no data chunk")


def doubled(x: np.ndarray) -> np.ndarray:
    """Twice the rate by linear interpolation; the last sample stands twice."""
    out = np.empty(2 * len(x), np.int16)
    out[::2] = x
    if len(x):
        out[1:-1:2] = (x[:-1].astype(np.int32) + x[1:]) >> 1
        out[-1] = x[-1]
    return out


def padded(text: Column, unit: int = 64) -> Column:
    """UTF-8 bytes of the text (null: empty), followed by bytes 0 up to a positive multiple of unit."""
    data = F.coalesce(text, F.lit("")).cast("binary")
    n = F.octet_length(data)
    total = F.greatest(F.lit(unit), (F.ceil(n / F.lit(unit)) * unit).cast("int"))
    return F.concat(data, F.substring(F.lit(bytes(unit)), F.lit(1), total - n))


def store(df: DataFrame, codec: int = MULAW, rate: int = 8000) -> DataFrame:
    """df with `media` in place of `payload`: its bytes as the codec's samples (blocks of 64 for ADPCM), unchanged. Null payloads stay null;
    very long ones are stored whole; equal payloads make equal media, so repeated rows do; an empty table stays empty."""
    kept = [c for c in df.columns if c not in ("payload", "media")]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(kept), STEP):
            media = [None if x is None else wav(codec, x, rate) for x in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(media, pa.binary())], [*kept, "media"])

    return df.select(*kept, "payload").mapInArrow(run, T.StructType([*df.select(*kept).schema.fields, T.StructField("media", T.BinaryType())]))


def _facts(x: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """Peak, mean size and zero crossings of each run of samples (none empty)."""
    starts = np.concatenate([[0], ends[:-1]])
    size = np.abs(x.astype(np.int32))
    flips = np.zeros(len(x), np.int32)
    flips[1:] = (x[1:] < 0) != (x[:-1] < 0)
    flips[starts] = 0
    mean = np.add.reduceat(size.astype(np.int64), starts) // (ends - starts)
    return list(zip(np.maximum.reduceat(size, starts).tolist(), mean.tolist(), np.add.reduceat(flips, starts).tolist(), strict=True))


def expand(df: DataFrame, pcm: bool = True) -> DataFrame:
    """df with payload, feature and pcm in place of `media` (WAV of the three codecs or PCM).

    payload: the stored sample bytes, read back. pcm: a PCM WAV file at twice the rate (null unless asked for).
    feature: `codec:rate:samples` and peak, mean size and zero crossings of the resampled PCM; then the same three for
    the stored bytes taken as A-law and, in whole blocks, as ADPCM. Null media give nulls, media without samples a
    feature of zeros; other files raise ValueError.
    """

    new = ("payload", "feature", "pcm")
    kept = [c for c in df.columns if c not in (*new, "media")]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(kept), STEP):
            files = batch.column(len(kept)).to_pylist()
            parts = [(0, 0, b"") if f is None else read_wav(f) for f in files]
            # Of each file: the PCM at its rate; all ADPCM blocks of the step are decoded at once.
            wide = [doubled(x) for x in _samples(parts)]
            facts = [""] * len(parts)
            some = [k for k, (tag, _, data) in enumerate(parts) if len(data) and len(wide[k])]
            if some:
                rows = [_facts(np.concatenate([wide[k] for k in some]), np.cumsum([len(wide[k]) for k in some]))]
                raw = np.frombuffer(b"".join(parts[k][2] for k in some), np.uint8)
                rows.append(_facts(ALAW_TABLE[raw], np.cumsum([len(parts[k][2]) for k in some])))
                whole = [k for k in some if len(parts[k][2]) >= BLOCK]
                blocks = [len(parts[k][2]) // BLOCK for k in whole]
                ima = dict.fromkeys(some, (0, 0, 0))
                if whole:
                    raw = np.frombuffer(b"".join(parts[k][2][: n * BLOCK] for k, n in zip(whole, blocks, strict=True)), np.uint8)
                    ima |= dict(zip(whole, _facts(decode_ima(raw.reshape(-1, BLOCK)).ravel(), np.cumsum(blocks) * (1 + 2 * (BLOCK - 4))), strict=True))
                for k, own, alaw in zip(some, *rows, strict=True):
                    facts[k] = ";".join(":".join(map(str, x)) for x in (own, alaw, ima[k]))
            features = [None if f is None else f"{tag}:{2 * rate}:{len(x)};{y or '0:0:0;0:0:0;0:0:0'}" for f, (tag, rate, _), x, y in zip(files, parts, wide, facts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1], pa.array([None if f is None else p[2] for f, p in zip(files, parts, strict=True)], pa.binary()), pa.array(features, pa.string()),
                    pa.array([wav(PCM, x.astype("<i2").tobytes(), 2 * p[1]) if pcm and f is not None else None for f, p, x in zip(files, parts, wide, strict=True)], pa.binary()),
                ],
                [*kept, *new],
            )

    fields = [T.StructField(c, T.StringType() if c == "feature" else T.BinaryType()) for c in new]
    return df.select(*kept, "media").mapInArrow(run, T.StructType([*df.select(*kept).schema.fields, *fields]))


def _samples(parts: list[tuple[int, int, bytes]]) -> list[np.ndarray]:
    out: list = []
    for tag, _, data in parts:
        raw = np.frombuffer(data, np.uint8)
        out.append(MULAW_TABLE[raw] if tag == MULAW else ALAW_TABLE[raw] if tag == ALAW else raw[: len(raw) // 2 * 2].view("<i2") if tag == PCM else np.zeros(0, np.int16))
    ima = [k for k, p in enumerate(parts) if p[0] == IMA]
    if ima:
        blocks = [np.frombuffer(parts[k][2][: len(parts[k][2]) // BLOCK * BLOCK], np.uint8).reshape(-1, BLOCK) for k in ima]
        both = decode_ima(np.concatenate(blocks))
        for k, rows in zip(ima, np.split(both, np.cumsum([len(b) for b in blocks])[:-1]), strict=True):
            out[k] = rows.ravel()
    return out
