"""Texts as WAV payloads: lossless 8-bit samples, short-time spectra and spectral-peak pair fingerprints.

Null and empty texts are one frame of padding. Any length works: the payload grows with the text and is never cut.
Equal texts give equal rows; repeated rows are returned as often as they come, null ids as null. No rows give none.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import blocks, table

FRAME = 576
RATE = 8000
#: Peaks kept per frame, and frames ahead with which a peak is paired.
PEAKS = 2
AHEAD = 2
_BANDS = ((2, 48), (48, 289))
_WINDOW = np.hanning(FRAME).astype(np.float32)


def payload(text: bytes) -> bytes:
    """The text's bytes, with bytes 255 up to a positive multiple of FRAME."""
    short = -len(text) % FRAME if text else FRAME
    return text + b"\xff" * short


def to_wav(data: bytes) -> bytes:
    """A mono 8-bit WAV file that holds the bytes as its samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(RATE)
        f.writeframes(data)
    return out.getvalue()


def from_wav(data: bytes) -> bytes:
    """The samples of a WAV file, as stored."""
    with wave.open(io.BytesIO(data), "rb") as f:
        return f.readframes(f.getnframes())


def fingerprint(samples: bytes) -> np.ndarray:
    """Time-coded peak pairs: frame << 32 | first bin << 20 | second bin << 8 | frames between, in order.

    Each frame's spectrum (Hann window, no overlap) gives the strongest bin of a low and a high band. Every peak is
    paired with every peak of the next AHEAD frames; a single frame pairs its own two peaks.
    """
    x = np.frombuffer(samples, dtype=np.uint8).astype(np.float32).reshape(-1, FRAME) - 128
    parts = []
    for at in range(0, len(x), 512):  # bounded spectra for very long texts
        power = np.abs(np.fft.rfft(x[at:at + 512] * _WINDOW, axis=1)).astype(np.float32)
        parts.append(np.stack([lo + power[:, lo:hi].argmax(axis=1) for lo, hi in _BANDS], axis=1))
    peaks = np.concatenate(parts).astype(np.int64)
    frames = np.arange(len(peaks), dtype=np.int64)
    codes = [frames << 32 | peaks[:, 0] << 20 | peaks[:, 1] << 8]
    for gap in range(1, AHEAD + 1):
        for a in range(PEAKS):
            for b in range(PEAKS):
                codes.append(frames[:-gap] << 32 | peaks[:-gap, a] << 20 | peaks[gap:, b] << 8 | gap)
    return np.sort(np.concatenate(codes))


def describe(text: bytes | None) -> dict:
    """All values of one text's media row."""
    text = text or b""
    media = to_wav(payload(text))
    back = from_wav(media)
    codes = fingerprint(back)
    return {
        "n_bytes": len(text), "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(),
        "tail_crc32": zlib.crc32(back[-32:]), "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(),
        "feature": hashlib.sha256(codes.astype("<i8").tobytes()).hexdigest(), "fingerprint": codes,
    }


_TYPES = {"n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "fingerprint": pa.list_(pa.int64())}


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A media row per document: sizes, digests of payload and WAV, feature digest and the fingerprint array."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1, rows=64):
                rows = [describe(t) for t in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[k] for r in rows], type=t) for k, t in _TYPES.items())], names=[id_col, *_TYPES])

    schema = f"`{id_col}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, fingerprint array<long>"
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(table(spark, sf_dir, "documents"))
