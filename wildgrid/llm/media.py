"""Media columns: WAV written and read by the wave module, short-time Fourier transforms, spectral-peak pairs.

A media column holds a whole WAV file as binary. ``encode_wav`` stores bytes as
8-bit mono samples without loss; ``wav_features`` reads the stored form back and
adds digests, and the fingerprint: pairs of spectral peaks as an array of
(time, f1, f2, dt), time being the number of the first peak's frame.
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

from .common import table

RATE = 8000
FRAME, HOP = 192, 96
#: Frames that are transformed at a time.
CHUNK = 4096
#: Frequency bins below this one belong to the mean and the slope, not to peaks.
LOW_BIN = 2
#: A peak is paired with the next ones, so many at most and within so many frames: the fingerprint's definition.
FAN_OUT, REACH = 3, 32

_PAIR = pa.struct([("time", pa.int32()), ("f1", pa.int16()), ("f2", pa.int16()), ("dt", pa.int16())])
FEATURES = pa.schema([("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("fingerprint", pa.list_(_PAIR))])
_FEATURES_DDL = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, fingerprint array<struct<time:int,f1:short,f2:short,dt:short>>"


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        if (w.getnchannels(), w.getsampwidth()) != (1, 1):
            raise ValueError("8-bit mono is expected")
        return w.readframes(w.getnframes())


_WINDOW = np.hanning(FRAME).astype(np.float32)


def spectrogram(samples: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the first frame, power by frame and bin), ``CHUNK`` frames at a time; a rest shorter than a hop is left out."""
    signal = samples.astype(np.float32) - np.float32(128)
    n = max(0, (len(signal) - FRAME) // HOP + 1)
    for k in range(0, n, CHUNK):
        part = signal[k * HOP : (min(n, k + CHUNK) - 1) * HOP + FRAME]
        frames = np.lib.stride_tricks.sliding_window_view(part, FRAME)[::HOP]
        spectrum = np.fft.rfft(frames * _WINDOW, axis=1)
        yield k, spectrum.real**2 + spectrum.imag**2


def peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(time, bin) of each frame's strongest bin, where it is above both neighbouring frames' power in that bin.

    Frames tell apart by whole numbers of a 64th of the logarithm, so rounding
    errors make no peaks; on a tie the earlier frame and the lower bin have it.
    """
    best, logs = [], []
    for _, power in spectrogram(samples):
        level = np.floor(np.log2(power[:, LOW_BIN:-1] + np.float32(1)) * 64).astype(np.int32)
        b = level.argmax(axis=1)
        best.append(b)
        logs.append(level[np.arange(len(b)), b])
    if not best:
        return np.empty(0, int), np.empty(0, int)
    bins, top = np.concatenate(best), np.concatenate(logs)
    before, after = np.r_[-1, top[:-1]], np.r_[top[1:], -1]
    time = np.flatnonzero((top > before) & (top >= after) & (top > 0))
    return time, bins[time] + LOW_BIN


def pairs(time: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Rows (time, f1, f2, dt) in the order of time, then dt: each peak with its next ``FAN_OUT`` within ``REACH`` frames."""
    found = []
    for k in range(1, FAN_OUT + 1):
        dt = time[k:] - time[:-k]
        near = np.flatnonzero(dt <= REACH)
        found.append(np.column_stack([time[near], bins[near], bins[near + k], dt[near]]))
    out = np.concatenate(found)
    return out[np.lexsort((out[:, 3], out[:, 0]))].astype(np.int32)


def features(media: bytes) -> tuple:
    payload = from_wav(media)
    found = pairs(*peaks(np.frombuffer(payload, np.uint8)))
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), found


def encode_wav(df: DataFrame, payload: str, media: str = "media", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the payload) and a column of WAV files that hold the payload's bytes.

    A null payload has a null file, an empty one a file without samples. A column
    named like ``media`` is refused.
    """
    keep = [c for c in df.columns if c != payload] if keep is None else keep
    if media in keep:
        raise ValueError(f"there is a column {media}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            files = [None if x is None else to_wav(x) for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(files, pa.binary())], names=[*b.schema.names[:-1], media])

    slim = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{payload}`").cast("binary").alias(media))
    return slim.mapInArrow(encode, slim.schema)


def wav_features(df: DataFrame, media: str = "media") -> DataFrame:
    """All columns but the file itself, with payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, fingerprint.

    A null file has null features, one without samples an empty fingerprint.
    Columns with these names are refused.
    """
    keep = [c for c in df.columns if c != media]
    if clash := set(keep) & set(FEATURES.names):
        raise ValueError(f"columns {sorted(clash)} clash with the features")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                rows = [(None,) * 6 if x is None else features(x) for x in part.column(part.num_columns - 1).to_pylist()]
                plain = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(FEATURES) if f.name != "fingerprint"]
                ends = np.cumsum([0, *(0 if r[5] is None else len(r[5]) for r in rows)], dtype=np.int32)
                flat = np.concatenate([np.empty((0, 4), np.int32), *(r[5] for r in rows if r[5] is not None)])
                values = pa.StructArray.from_arrays([pa.array(flat[:, i].astype(t)) for i, t in enumerate((np.int32, np.int16, np.int16, np.int16))], names=[f.name for f in _PAIR])
                none = pa.array([r[5] is None for r in rows])
                prints = pa.ListArray.from_arrays(pa.array(ends), values, mask=none)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *plain, prints.cast(FEATURES.field("fingerprint").type)], names=[*part.schema.names[:-1], *FEATURES.names])

    slim = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{media}`"))
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]] + [_FEATURES_DDL])
    return slim.mapInArrow(compute, ddl)


def text_payload(text, multiple: int = FRAME, fill: str = " "):
    """UTF-8 bytes of a text (null: empty), filled up to a positive multiple of ``multiple`` bytes."""
    raw = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    n = F.octet_length(raw)
    more = F.when(n == 0, multiple).otherwise(F.pmod(-n, F.lit(multiple)))
    return F.concat(raw, F.encode(F.repeat(F.lit(fill), more.cast("int")), "UTF-8"))


def op1_wav_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A last column, fingerprint: the time-coded array itself. feature is the number of its pairs and their digest.

    The file of each text is read back in the stage that makes it; a table of media to be
    kept is ``encode_wav`` written by Spark's writer, and ``wav_features`` reads such a table alike.
    """
    docs = table(spark, sf_dir, "documents")
    n = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    rows = docs.select("doc_id", n.alias("n_bytes"), text_payload(F.col("text")).alias("payload"))
    found = wav_features(encode_wav(rows, "payload"))
    coded = F.sha2(F.to_json("fingerprint"), 256)
    feature = F.concat_ws(":", F.lit("pairs"), F.size("fingerprint").cast("string"), coded)
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"), "fingerprint")
