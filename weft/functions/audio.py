"""Audio kernels in numpy, and one Arrow pass that applies them to WAV bytes."""

from __future__ import annotations

import hashlib
import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

FLOOR = 1e-10


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """Mono float32 samples and rate of 8-, 16- or 32-bit PCM."""
    with wave.open(io.BytesIO(data)) as f:
        width, channels, rate = f.getsampwidth(), f.getnchannels(), f.getframerate()
        raw = f.readframes(f.getnframes())
    if width == 1:
        x = np.frombuffer(raw, np.uint8).astype(np.float32) / 128 - 1
    elif width in (2, 4):
        x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / float(1 << (8 * width - 1))
    else:
        raise ValueError(f"unsupported sample width {width}")
    return x.reshape(-1, channels).mean(axis=1), rate


#: Frames of the level gate: seconds, least frames, least level in dB, and dB under the 90th percentile (fixed values).
GATE_FRAME, GATE_LEAST, GATE_FLOOR, GATE_BELOW = 0.04, 4, -52.0, 32.0


def frames_of(x: np.ndarray, size: int) -> np.ndarray:
    """Whole frames of ``size`` samples at half a frame's hop; none if four do not fit."""
    if size <= 0 or len(x) < 4 * size:
        return np.zeros((0, max(size, 1)))
    return np.lib.stride_tricks.sliding_window_view(x.astype(np.float64), size)[:: max(1, size // 2)]


def levels(x: np.ndarray, size: int) -> np.ndarray:
    """Level in dB of each frame."""
    return 20 * np.log10(np.maximum(np.sqrt((frames_of(x, size) ** 2).mean(axis=1)), 1e-7))


def voiced(x: np.ndarray, rate: int) -> tuple[np.ndarray, int] | None:
    """Which frames of 40 ms reach the gate, and their samples; None for sounds too short."""
    size = int(GATE_FRAME * rate)
    db_ = levels(x, size)
    if len(db_) < GATE_LEAST:
        return None
    return db_ >= max(GATE_FLOOR, float(np.percentile(db_, 90)) - GATE_BELOW), size


def frame_rms(x: np.ndarray, rate: int, seconds: float = 0.025) -> np.ndarray:
    """RMS of frames at half a frame's hop."""
    n = max(256, int(rate * seconds))
    if len(x) < n:
        x = np.pad(x, (0, n - len(x)))
    frames = np.lib.stride_tricks.sliding_window_view(x, n)[:: n // 2]
    return np.sqrt((frames.astype(np.float64) ** 2).mean(axis=1))


def db(v: np.ndarray | float) -> np.ndarray | float:
    return 20 * np.log10(np.maximum(v, FLOOR))


def longest_run(mask: np.ndarray) -> int:
    """Length of the longest run of true values."""
    if not mask.any():
        return 0
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return int((edges[1::2] - edges[::2]).max())


def edge_silence(x: np.ndarray, rate: int) -> tuple[float | None, float | None]:
    """Seconds before the first and after the last frame that reaches the gate; None if too short or none does."""
    found = voiced(x, rate)
    if found is None or not found[0].any():
        return None, None
    at, size = np.flatnonzero(found[0]), found[1]
    hop = max(1, size // 2)
    return round(float(at[0] * hop / rate), 3), round(float((len(x) - at[-1] * hop - size) / rate), 3)


def cap_tail(x: np.ndarray, rate: int, seconds: float = 0.15) -> np.ndarray:
    """At most ``seconds`` after the last frame that reaches the gate; unchanged where there is none."""
    found = voiced(x, rate)
    if found is None or not found[0].any():
        return x
    size = found[1]
    return x[: int(np.flatnonzero(found[0])[-1]) * max(1, size // 2) + size + int(seconds * rate)]


def normalise_peak(x: np.ndarray, peak: float = 0.95) -> np.ndarray:
    """Scaled up or down to ``peak``; silence stays."""
    top = float(np.abs(x).max(initial=0.0))
    return x * (peak / top) if top > 1e-8 else x


def speech_ratio(x: np.ndarray, rate: int) -> float | None:
    """Share of frames that reach the gate."""
    found = voiced(x, rate)
    return None if found is None else round(float(found[0].mean()), 4)


def floor_separation(x: np.ndarray, rate: int) -> float | None:
    """Decibels between the 85th and the 15th percentile of the levels of 50 ms frames; None for under eight frames."""
    db_ = levels(x, int(0.05 * rate))
    return None if len(db_) < 8 else round(float(np.percentile(db_, 85) - np.percentile(db_, 15)), 2)


def mean_spectrum(x: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Mean power spectrum of Hann frames of 40 ms (256 samples at least) and its frequencies; None for under four frames."""
    size = max(256, int(0.04 * rate))
    frames = frames_of(x, size)
    if len(frames) < 4:
        return None
    total = np.zeros(size // 2 + 1)
    for at in range(0, len(frames), 256):
        total += (np.abs(np.fft.rfft(frames[at : at + 256] * np.hanning(size), axis=1)) ** 2).sum(axis=0)
    return total / len(frames), np.fft.rfftfreq(size, 1 / rate)


def rolloff(x: np.ndarray, rate: int, share: float = 0.99) -> float | None:
    """Frequency below which ``share`` of the mean spectrum's energy lies; None for silence."""
    found = mean_spectrum(x, rate)
    if found is None or found[0].sum() <= 1e-12:
        return None
    total = np.cumsum(found[0])
    return round(float(found[1][min(int(np.searchsorted(total, share * total[-1])), len(total) - 1)]), 1)


def band_share(x: np.ndarray, rate: int, low: float = 2000.0, high: float = 8000.0) -> float | None:
    """Share of the energy from ``low`` to ``high`` in that above 100 Hz; None for silence."""
    found = mean_spectrum(x, rate)
    if found is None:
        return None
    power, hz = found
    total = float(power[hz >= 100].sum())
    return None if total <= 1e-12 else round(float(power[(hz >= low) & (hz <= high)].sum()) / total, 4)


def measure(data: bytes) -> dict[str, object]:
    """All measures of one file, or the reason why there are none; null measures where the sound is too short or silent."""
    names = ("seconds", "rms_db", "peak", "head_silence", "tail_silence", "speech_ratio", "separation_db", "rolloff_hz", "band_share", "clip_run_ms")
    try:
        x, rate = decode_wav(data)
        if not len(x) or not np.isfinite(x).all():
            raise ValueError("empty or not finite")
    except Exception as error:  # noqa: BLE001  any broken file is a row with a reason
        return dict.fromkeys(names) | {"pcm_sha256": None, "error": type(error).__name__}
    head, tail = edge_silence(x, rate)
    values = (
        len(x) / rate, float(db(np.sqrt((x.astype(np.float64) ** 2).mean()))), float(np.abs(x).max()), head, tail, speech_ratio(x, rate),
        floor_separation(x, rate), rolloff(x, rate), band_share(x, rate), longest_run(np.abs(x) >= 0.999) * 1000 / rate,
    )
    return dict(zip(names, values)) | {"pcm_sha256": hashlib.sha256(x.astype("<f4").tobytes()).hexdigest(), "error": None}


def measure_files(files: DataFrame) -> DataFrame:
    """Measures of a ``binaryFile`` table: one Arrow pass, no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = pd.DataFrame([measure(d) for d in b["content"]])
            out.insert(0, "path", b["path"].to_numpy())
            yield out

    schema = "path string, seconds double, rms_db double, peak double, head_silence double, tail_silence double, speech_ratio double, separation_db double, rolloff_hz double, band_share double, clip_run_ms double, pcm_sha256 string, error string"
    return files.select("path", "content").mapInPandas(run, schema)
