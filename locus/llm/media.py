"""Media columns: texts as WAV payloads, their spectra and spectral-peak pair fingerprints.

A payload is stored as unsigned 8-bit mono samples in a WAV file made by the wave module and read back by
it. The samples, with silence before and after them, go through a short-time Fourier transform of
overlapping frames, so that no byte lies at the edge of all its frames; of each frame the strongest local maxima are
peaks, and each peak is paired with peaks of the next frames. A pair is one number (the two frequencies
and the frames between), stored with the time at which it starts, in whole frame lengths.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm.common import table, whole

RATE, FRAME, HOP, PEAKS, AHEAD, CHUNK = 8000, 256, 64, 4, 2, 4096
#: Silence before the samples, so that the first bytes too are in as many frames as others.
LEAD = FRAME - HOP
WINDOW = np.hanning(FRAME).astype(np.float32)


def payload(text: str | None) -> bytes:
    """The text as UTF-8 with zero bytes up to a positive multiple of 64."""
    raw = (text or "").encode()
    return raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))


def to_wav(samples: bytes) -> bytes:
    with wave.open(out := io.BytesIO(), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(samples)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        if (r.getnchannels(), r.getsampwidth()) != (1, 1):
            raise ValueError("8-bit mono samples are stored")
        return r.readframes(r.getnframes())


def _peaks(samples: np.ndarray, first: int, last: int) -> np.ndarray:
    """The PEAKS strongest local maxima of frames first to last, as rows of frequency numbers; 0: none."""
    begin = first * HOP - LEAD
    part = samples[max(0, begin) : (last - 1) * HOP + FRAME - LEAD].astype(np.float32) - 128.0
    if begin < 0:
        part = np.concatenate([np.zeros(-begin, np.float32), part])
    short = (last - 1 - first) * HOP + FRAME - len(part)
    if short > 0:
        part = np.concatenate([part, np.zeros(short, np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(part, FRAME)[::HOP] * WINDOW
    power = np.abs(np.fft.rfft(frames, axis=1)).astype(np.float32)
    power[:, 0] = 0
    inner = power[:, 1:-1]
    peak = np.where((inner > power[:, :-2]) & (inner >= power[:, 2:]), inner, 0)
    top = np.argpartition(-peak, PEAKS - 1, axis=1)[:, :PEAKS]
    found = np.where(np.take_along_axis(peak, top, 1) > 0, top + 1, 0)
    return np.sort(found, axis=1)


def fingerprint(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Times (in frame lengths) and pair codes of the samples, a chunk of frames after another."""
    x = np.frombuffer(samples, np.uint8)
    n = max(AHEAD + 1, -(-(len(x) + LEAD) // HOP))
    times, codes = [], []
    for first in range(0, n, CHUNK):
        own = min(n, first + CHUNK) - first
        peaks = _peaks(x, first, min(n, first + CHUNK + AHEAD))
        for ahead in range(1, AHEAD + 1):
            a, b = peaks[: len(peaks) - ahead][:own], peaks[ahead:][:own]
            for i in range(PEAKS):
                for j in range(PEAKS):
                    at = np.flatnonzero((a[:, i] > 0) & (b[:, j] > 0))
                    times.append((at + first) * HOP // FRAME)
                    codes.append((a[at, i] << 12) | (b[at, j] << 4) | ahead)
    t, c = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((c, t))
    return t[order].astype(np.int32), c[order].astype(np.int32)


COLUMNS = {
    "doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(),
    "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(),
    "media": pa.binary(), "peak_times": pa.list_(pa.int32()), "peak_codes": pa.list_(pa.int32()),
}
DDL = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media binary, peak_times array<int>, peak_codes array<int>"


def _row(doc, text: str | None, whole_media: bool) -> dict:
    media = to_wav(payload(text))
    back = from_wav(media)
    times, codes = fingerprint(back)
    digest = hashlib.blake2b(times.astype("<i4").tobytes() + codes.astype("<i4").tobytes(), digest_size=16).hexdigest()
    out = {
        "doc_id": doc, "n_bytes": len((text or "").encode()), "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-64:]),
        "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(), "feature": f"{len(codes)}:{digest}",
    }
    return out | {"media": media, "peak_times": times, "peak_codes": codes} if whole_media else out


def _media(whole_media: bool):
    schema = pa.schema(list(COLUMNS.items())[: None if whole_media else 8])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = [_row(d, t, whole_media) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_media: bool = True) -> DataFrame:
    """For each row of docs the WAV file of its text, digests of what is stored and read back, and its
    fingerprint; without ``whole_media`` the digests alone.

    A null text is empty and gives 64 zero bytes. A short payload has AHEAD + 1 frames too, and so pairs;
    texts that differ in a few letters may still have the same peaks, and then the same fingerprint.
    Equal texts get equal values; repeated rows stay; a null id stays null; other columns are not looked at.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col)).mapInArrow(_media(whole_media), DDL if whole_media else DDL.split(", media binary")[0])


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"), whole_media=False)
