"""Telephony audio columns: G.711 expansion by lookup tables, IMA ADPCM blocks decoded across blocks, resampled PCM.

* ``store_audio`` puts bytes into a mu-law or A-law WAV file, one byte a sample, so that any payload is kept as it is.
  Without a given law the payload's CRC decides, so that equal payloads have equal files.
* ``read_audio`` reads those files, expands the samples, resamples 8 kHz to 16 kHz PCM, which is a column of its result,
  and computes features.
* ``decode_adpcm`` decodes blocks of an IMA ADPCM stream, all blocks at once, one nibble position a step.

Files are written to the shared folder as a table, and results come from what is read there; the resampled PCM is a
column of the result, to be stored with it. Texts of any length are one file, up to the 4 GB of the format.

Nulls and empty texts give one unit of 64 zero bytes. Equal payloads give equal rows, whatever stands beside them.
Extra columns are ignored; repeated rows are kept; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batch, id_text, map_batches, slices, written

UNIT = 64
FORMATS = {"alaw": 6, "mulaw": 7}
LAWS = ("mulaw", "alaw")

# Step sizes and index changes of the IMA ADPCM format.
IMA_STEPS = np.array([7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767], np.int32)
IMA_INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8, -1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def mulaw_table() -> np.ndarray:
    """Linear values of the 256 mu-law codes."""
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = ((((code & 15) << 3) + 132) << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    """Linear values of the 256 A-law codes."""
    code = np.arange(256, dtype=np.int32) ^ 0x55
    seg, low = (code >> 4) & 7, (code & 15) << 4
    size = np.where(seg == 0, low + 8, (low + 264) << np.maximum(seg - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


EXPAND = {"mulaw": mulaw_table(), "alaw": alaw_table()}


def wav_file(payload: bytes, codec: str = "mulaw", rate: int = 8000) -> bytes:
    fmt = struct.pack("<HHIIHHH", FORMATS[codec], 1, rate, rate, 1, 8, 0)
    pad = b"\0" * (len(payload) % 2)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<II", 4, len(payload)) + b"data" + struct.pack("<I", len(payload)) + payload + pad
    return b"RIFF" + struct.pack("<I", len(body)) + body


def wav_samples(media: bytes) -> tuple[str, int, bytes]:
    """Codec, rate and sample bytes of a stored file, found by walking its chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, codec, rate = 12, "", 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", media, at + 8)
            codec = {v: k for k, v in FORMATS.items()}[tag]
        elif name == b"data":
            return codec, rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """PCM of IMA ADPCM blocks (rows of bytes: predictor, index, 0, then two nibbles a byte, low one first)."""
    value = blocks[:, 0].astype(np.int32) | (blocks[:, 1].astype(np.int8).astype(np.int32) << 8)
    index = np.minimum(blocks[:, 2], 88).astype(np.int32)
    out = np.empty((2 * (blocks.shape[1] - 4) + 1, len(blocks)), np.int16)
    out[0] = value
    for k in range(blocks.shape[1] - 4):
        column = blocks[:, 4 + k]
        for j, nibble in enumerate((column & 15, column >> 4)):
            step = IMA_STEPS[index]
            change = step >> 3
            change += (step >> 2) * (nibble & 1) + (step >> 1) * ((nibble >> 1) & 1) + step * ((nibble >> 2) & 1)
            value = np.clip(value + np.where(nibble & 8, -change, change), -32768, 32767)
            index = np.clip(index + IMA_INDEX[nibble], 0, 88)
            out[1 + 2 * k + j] = value
    return out.T


def resample_double(pcm: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Twice the rate: samples stay, between them the half-band filter (-1, 9, 9, -1)/16; edges repeat within a signal."""
    x = pcm.astype(np.int32)
    after = np.empty_like(x)
    after[:-1], after[-1:] = x[1:], x[-1:]
    after[ends - 1] = x[ends - 1]
    before = np.empty_like(x)
    before[1:], before[:1] = x[:-1], x[:1]
    before[starts] = x[starts]
    later = np.empty_like(x)
    later[:-1], later[-1:] = after[1:], after[-1:]
    later[ends - 1] = x[ends - 1]
    out = np.empty(2 * len(x), np.int16)
    out[0::2] = pcm
    out[1::2] = np.clip((9 * (x + after) - before - later + 8) >> 4, -32768, 32767)
    return out


STORED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])


def store_audio(docs: DataFrame, codec: str | None = None, rate: int = 8000) -> DataFrame:
    """doc_id, n_bytes and media: each text's bytes, padded to a multiple of 64, as samples of a WAV file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in slices(batch):
                raw = data.tobytes()
                files = []
                for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                    payload = raw[a:b]
                    payload += b"\0" * (max(1, -(-len(payload) // UNIT)) * UNIT - len(payload))
                    files.append(wav_file(payload, codec or LAWS[zlib.crc32(payload) & 1], rate))
                yield arrow_batch(STORED, doc_id=rows.column(0), n_bytes=np.diff(offs), media=files)

    return map_batches(id_text(docs), run, "doc_id long, n_bytes long, media binary")


READ = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("pcm", pa.binary())])
READ_DDL = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pcm binary"


def read_audio(stored: DataFrame) -> DataFrame:
    """Read stored files back: digests of payload and file, the feature string and the 16 kHz PCM.

    Features are the law, RMS of the expanded samples, their zero crossings, RMS and peak of the payload taken as ADPCM blocks
    of 64 bytes, and length and CRC of the resampled PCM.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in slices(batch, "media"):
                raw = data.tobytes()
                files = [raw[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
                found = [wav_samples(x) for x in files]
                parts = [x[2] for x in found]
                sizes = np.array([len(x) for x in parts], np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                codes = np.frombuffer(b"".join(parts), np.uint8)
                laws = np.repeat(np.array([x[0] == "alaw" for x in found]), sizes) if len({x[0] for x in found}) > 1 else found[0][0] == "alaw"
                signal = np.where(laws, EXPAND["alaw"][codes], EXPAND["mulaw"][codes]) if isinstance(laws, np.ndarray) else EXPAND["alaw" if laws else "mulaw"][codes]
                wide = signal.astype(np.int64)
                power = np.add.reduceat(wide * wide, starts)
                turns = np.zeros(len(signal), np.int64)
                turns[1:] = (signal[1:] < 0) != (signal[:-1] < 0)
                turns[starts] = 0
                crossings = np.add.reduceat(turns, starts)
                blocks = decode_adpcm(codes.reshape(-1, UNIT)).astype(np.int64)
                a_power = np.add.reduceat((blocks * blocks).sum(axis=1), starts // UNIT)
                a_peak = np.maximum.reduceat(np.abs(blocks).max(axis=1), starts // UNIT)
                double = resample_double(signal, starts, ends).astype("<i2").tobytes()
                features, more = [], []
                for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
                    out = double[4 * a : 4 * b]
                    n = b - a
                    features.append(f"law={found[k][0]};rms={np.sqrt(power[k] / n):.3f};zc={crossings[k]};adpcm_rms={np.sqrt(a_power[k] / (n // UNIT * 121)):.3f};adpcm_peak={a_peak[k]};pcm16k={2 * n}:{zlib.crc32(out)}")
                    more.append(out)
                yield arrow_batch(
                    READ, doc_id=rows.column(0), n_bytes=rows.column(1), payload_bytes=sizes, payload_sha256=[hashlib.sha256(x).hexdigest() for x in parts], tail_crc32=[zlib.crc32(x[-UNIT:]) for x in parts],
                    media_bytes=np.diff(offs), media_sha256=[hashlib.sha256(x).hexdigest() for x in files], feature=features, pcm=more,
                )

    return map_batches(stored.select("doc_id", "n_bytes", "media"), run, READ_DDL)


def telephony_audio(docs: DataFrame) -> DataFrame:
    """Rows of ``read_audio`` from stored files, with length and digest of the resampled PCM beside it."""
    found = read_audio(written(store_audio(docs), "audio-files", "zstd"))
    return found.withColumns({"pcm_bytes": F.octet_length("pcm").cast("long"), "pcm_sha256": F.sha2("pcm", 256)})


def op1_telephony_audio(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return telephony_audio(table(spark, sf_dir, "documents"))
