"""Audio features: polyphase resampling, overlapped log-mel filterbanks, hysteresis segmentation.

Method. A payload of bytes is stored as a WAV file of unsigned 8-bit mono samples; the samples are
read back from the stored file, byte for byte. Features of the read samples:

- resampling from RATE to TARGET by UP/DOWN polyphase filtering: a windowed-sinc low-pass is split
  into UP phases, and each output is the dot product of one phase with the samples about it;
- log-mel: frames of FRAME samples every HOP, Hann window, power spectrum, MELS triangular bands;
- segments: runs of frames whose level rises over ON decibels below the loudest frame and stays
  over OFF decibels below it.

Frames are stored in chunks of CHUNK x MELS, the last one padded with the floor, as an Arrow
fixed-shape tensor column beside each chunk's start and end in seconds, in one Arrow IPC stream per
text. Signals are taken in pieces that overlap by what filter and frames need, so memory is bounded
by the piece and not by the text.

Input cases. Text null or empty: a payload of 64 zero bytes. Texts are taken whole, as UTF-8,
padded with zero bytes to a positive multiple of 64. Silence (equal levels throughout) is one
segment. Equal texts give equal values. Repeated rows give repeated rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import io
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import tables, text

RATE, UP, DOWN = 12_000, 2, 3
TARGET = RATE * UP // DOWN
FRAME, HOP, MELS, CHUNK = 200, 80, 40, 64
ON, OFF, FLOOR = 12.0, 18.0, 1e-10
PAD = 64
#: Taps of a phase on either side of its centre, and frames worked out together.
REACH, FRAMES = 12, 4096


def wav(payload: bytes) -> bytes:
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload)) + payload


def samples(stored: bytes) -> bytes:
    """The data of a WAV file, found by walking its chunks."""
    at = 12
    while at + 8 <= len(stored):
        name, size = struct.unpack_from("<4sI", stored, at)
        if name == b"data":
            return stored[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def _phases() -> np.ndarray:
    """(UP, 2 * REACH + 1) taps; row p gives outputs that lie p / UP of a sample after the centre."""
    taps = np.arange(-REACH, REACH + 1)[None, :] - np.arange(UP)[:, None] / UP
    cut = min(1.0, UP / DOWN) * 0.9
    window = np.where(np.abs(taps) <= REACH, 0.5 + 0.5 * np.cos(np.pi * taps / (REACH + 1)), 0.0)
    out = cut * np.sinc(cut * taps) * window
    return (out / out.sum(axis=1, keepdims=True)).astype(np.float32)


def _bands() -> np.ndarray:
    def mel(f: np.ndarray | float) -> np.ndarray:
        return 2595 * np.log10(1 + np.asarray(f) / 700)

    edges = 700 * (10 ** (np.linspace(0, mel(TARGET / 2), MELS + 2) / 2595) - 1)
    f = np.fft.rfftfreq(256, 1 / TARGET)[:, None]
    up, down = (f - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - f) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(up, down)).astype(np.float32)


PHASES, BANDS = _phases(), _bands()
HANN = (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(FRAME) / FRAME)).astype(np.float32)


def resample(x: np.ndarray, first: int, last: int, start: int = 0) -> np.ndarray:
    """Outputs first..last of the resampled signal; x holds its samples from `start`, zero beyond."""
    k = np.arange(first, last)
    out = np.zeros(len(k), dtype=np.float32)
    for phase in range(UP):
        own = np.flatnonzero(k * DOWN % UP == phase)
        if not len(own):
            continue
        centre = k[own] * DOWN // UP - start
        lo, hi = int(centre[0]) - REACH, int(centre[-1]) + REACH + 1
        body = x[max(0, lo) : max(0, hi)]
        body = np.concatenate([np.zeros(max(0, -lo), np.float32), body, np.zeros(hi - lo - max(0, -lo) - len(body), np.float32)])
        step = int(centre[1] - centre[0]) if len(centre) > 1 else 1
        out[own] = np.lib.stride_tricks.sliding_window_view(body, 2 * REACH + 1)[::step] @ PHASES[phase]
    return out


def log_mel(data: bytes) -> np.ndarray:
    """(frames, MELS) in decibels; a signal shorter than a frame is one frame."""
    n = -(-len(data) * UP // DOWN)
    frames = 1 + max(0, -(-(n - FRAME) // HOP))
    out = np.empty((frames, MELS), dtype=np.float32)
    raw = np.frombuffer(data, dtype=np.uint8)
    for a in range(0, frames, FRAMES):
        b = min(frames, a + FRAMES)
        first, last = a * HOP, (b - 1) * HOP + FRAME
        s, e = max(0, first * DOWN // UP - REACH - 1), min(len(raw), last * DOWN // UP + REACH + 2)
        signal = resample((raw[s:e].astype(np.float32) - 128) / 128, first, min(last, n), s)
        signal = np.pad(signal, (0, last - first - len(signal)))
        cut = np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP] * HANN
        spectrum = np.fft.rfft(cut, 256)
        power = (spectrum.real**2 + spectrum.imag**2).astype(np.float32)
        out[a:b] = 10 * np.log10(power @ BANDS + FLOOR)
    return out


def segments(level: np.ndarray) -> list[tuple[int, int]]:
    """Half-open runs of frames: opened over ON below the loudest, closed under OFF below it."""
    top = level.max()
    open_at, keep = level >= top - ON, level >= top - OFF
    edge = np.flatnonzero(np.diff(np.concatenate([[False], keep, [False]]).astype(np.int8)))
    sure = np.concatenate([[0], np.cumsum(open_at)])
    return [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if sure[b] > sure[a]]


def tensor_table(mel: np.ndarray) -> pa.Table:
    """start_s, end_s and the fixed-shape tensor (CHUNK, MELS) of each chunk of frames."""
    chunks = -(-len(mel) // CHUNK)
    padded = np.full((chunks * CHUNK, MELS), 10 * math.log10(FLOOR), dtype=np.float32)
    padded[: len(mel)] = mel
    first = np.arange(chunks) * CHUNK
    last = np.minimum(first + CHUNK, len(mel)) - 1
    tensor = pa.FixedShapeTensorArray.from_numpy_ndarray(padded.reshape(chunks, CHUNK, MELS))
    return pa.table({"start_s": first * HOP / TARGET, "end_s": (last * HOP + FRAME) / TARGET, "log_mel": tensor})


def features(data: bytes) -> tuple[bytes, list[tuple[float, float]], str]:
    """The tensors as an Arrow IPC stream, the segments in seconds, and a digest of both."""
    mel = log_mel(data)
    table = tensor_table(mel)
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    spans = [(a * HOP / TARGET, ((b - 1) * HOP + FRAME) / TARGET) for a, b in segments(mel.mean(axis=1))]
    rounded = np.round(mel).astype(np.int16)
    digest = hashlib.sha256(rounded.tobytes() + repr([(round(a, 3), round(b, 3)) for a, b in spans]).encode()).hexdigest()[:16]
    return sink.getvalue(), spans, f"{len(mel)}x{MELS}:{len(spans)}:{digest}"


def store(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) as doc_id, n_bytes and media, the WAV file of each text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text.buffers(batch.column(1))
            for lo, hi in text.slices(offsets):
                own = [body[a:b].tobytes() for a, b in zip(offsets[lo:hi].tolist(), offsets[lo + 1 : hi + 1].tolist(), strict=True)]
                media = [wav(x.ljust(max(PAD, -(-len(x) // PAD) * PAD), b"\0")) for x in own]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([len(x) for x in own], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, n_bytes long, media binary")


def describe(media: DataFrame) -> DataFrame:
    """media (doc_id, n_bytes, media) with the payload read back, tensors, segments and feature."""
    spans = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text.buffers(batch.column(2))
            for lo, hi in text.slices(offsets):
                part = batch.slice(lo, hi - lo)
                payload = [samples(x) for x in part.column(2).to_pylist()]
                made = [features(x) for x in payload]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(payload, pa.binary()),
                        pa.array([x[0] for x in made], pa.binary()),
                        pa.array([[{"start_s": a, "end_s": b} for a, b in x[1]] for x in made], spans),
                        pa.array([x[2] for x in made], pa.string()),
                    ],
                    names=["doc_id", "n_bytes", "media", "payload", "tensors", "segments", "feature"],
                )

    return media.select("doc_id", "n_bytes", "media").mapInArrow(work, "doc_id long, n_bytes long, media binary, payload binary, tensors binary, segments array<struct<start_s:double,end_s:double>>, feature string")


def op1_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = describe(store(tables.read(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -PAD, PAD)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        F.size("segments").alias("n_segments"),
    )
