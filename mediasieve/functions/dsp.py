"""Numpy kernels for audio, for use inside Arrow-batched functions."""

from __future__ import annotations

import io
import wave
from functools import lru_cache

import numpy as np

from . import flac

RATE = 16_000


def read_wav(content: bytes) -> tuple[np.ndarray, int]:
    """Samples in [-1, 1], channels averaged, and the rate of a PCM wav."""
    with wave.open(io.BytesIO(content)) as w:
        width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
        raw = w.readframes(w.getnframes())
    if width == 1:
        y = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        y = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8).astype(np.float32) / (1 << 23)
    else:
        y = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / float(1 << (8 * width - 1))
    return y.reshape(-1, channels).mean(axis=1).astype(np.float32), rate


def write_wav(y: np.ndarray, rate: int = RATE) -> bytes:
    """16-bit PCM wav."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.round(np.clip(y, -1, 1 - 1 / 32768) * 32768).astype("<i2").tobytes())
    return out.getvalue()


def duration(content: bytes) -> float | None:
    """Seconds a wav or FLAC says it has; None where it can't be read."""
    if content[:4] == flac.MAGIC:
        return flac.duration(content)
    try:
        with wave.open(io.BytesIO(content)) as w:
            return w.getnframes() / w.getframerate()
    except (wave.Error, EOFError, ZeroDivisionError):
        return None


def resample(y: np.ndarray, rate: int, to: int = RATE, zeros: int = 16) -> np.ndarray:
    """Band-limited resampling with a Hann-windowed sinc."""
    if rate == to or not len(y):
        return y.astype(np.float32)
    ratio = to / rate
    cut = min(1.0, ratio)
    n = int(np.ceil(len(y) * ratio))
    reach = int(np.ceil(zeros / cut))
    out = np.empty(n, np.float32)
    padded = np.pad(y.astype(np.float64), (reach, reach + 1))
    for at in range(0, n, 1 << 15):
        place = np.arange(at, min(n, at + (1 << 15))) / ratio
        whole = np.floor(place).astype(np.int64)
        k = np.arange(-reach + 1, reach + 1)
        t = (place - whole)[:, None] - k[None, :]
        kernel = np.sinc(t * cut) * cut * (0.5 + 0.5 * np.cos(np.pi * np.clip(t / reach, -1, 1)))
        out[at : at + len(place)] = (padded[whole[:, None] + k[None, :] + reach] * kernel).sum(1)
    return out


def load(content: bytes, rate: int = RATE) -> np.ndarray:
    """Samples of a PCM wav or a FLAC file, mono, at a rate."""
    y, own = flac.read(content) if content[:4] == flac.MAGIC else read_wav(content)
    return resample(y, own, rate)


def window_rms(y: np.ndarray, window: int, hop: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and root mean squares of sliding windows, by running sums; a shorter input is one partial window."""
    if not len(y):
        return np.zeros(0, np.int64), np.zeros(0)
    sums = np.concatenate(([0.0], np.cumsum(y.astype(np.float64) ** 2)))
    if len(y) < window:
        return np.zeros(1, np.int64), np.sqrt(sums[-1:] / len(y))
    starts = np.arange(0, len(y) - window + 1, hop)
    return starts, np.sqrt(np.maximum(sums[starts + window] - sums[starts], 0) / window)


def separated(starts: np.ndarray, rms: np.ndarray, count: int, apart: int, threshold: float | None = None, latest: bool = False) -> list[int]:
    """Places of up to count windows, loudest first, each at least apart from those taken; equal ones earliest first, or latest."""
    order = np.lexsort((-starts if latest else starts, -rms))
    out: list[int] = []
    for k in order:
        if len(out) >= count:
            break
        if (threshold is None or rms[k] >= threshold) and all(abs(starts[k] - starts[o]) >= apart for o in out):
            out.append(int(k))
    return out


def loudest(y: np.ndarray, window: int, hop: int) -> tuple[int | None, str | None]:
    """Start of the loudest window (the earliest of equal ones), or why there is none."""
    if len(y) < window:
        return None, "too_short"
    starts, rms = window_rms(y, window, hop)
    best = int(starts[int(np.argmax(rms))])
    return (None, "all_zero") if not np.any(y[best : best + window]) else (best, None)


def loudest_or_pad(y: np.ndarray, window: int, hop: int) -> tuple[np.ndarray | None, int | None, bool]:
    """The loudest window, its start, and whether it had to be filled with zeros; None for silence."""
    if len(y) >= window:
        start, why = loudest(y, window, hop)
        return (None, None, False) if why else (y[start : start + window], start, False)
    return (np.pad(y, (0, window - len(y))), 0, True) if np.any(y) else (None, None, False)


def spectrum(y: np.ndarray, n_fft: int = 512, hop: int = 128) -> np.ndarray:
    """Magnitudes (bin, frame) of centred Hann frames, the ends filled with zeros."""
    padded = np.pad(y.astype(np.float32), n_fft // 2)
    if len(padded) < n_fft:
        padded = np.pad(padded, (0, n_fft - len(padded)))
    frames = np.lib.stride_tricks.sliding_window_view(padded, n_fft)[::hop]
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n_fft) / n_fft)
    return np.abs(np.fft.rfft(frames * hann, axis=1)).T


def _mel(hz: np.ndarray) -> np.ndarray:
    """Mel scale that is linear to 1000 Hz and logarithmic above."""
    hz = np.asarray(hz, float)
    return np.where(hz < 1000, hz * 3 / 200, 15 + 27 * np.log(np.maximum(hz, 1) / 1000) / np.log(6.4))


def _hz(mel: np.ndarray) -> np.ndarray:
    return np.where(mel < 15, mel * 200 / 3, 1000 * np.exp((mel - 15) * np.log(6.4) / 27))


@lru_cache(maxsize=16)
def mel_filters(rate: int, n_fft: int, bands: int, top: float) -> np.ndarray:
    """Triangles of equal area over mel-spaced frequencies."""
    edges = _hz(np.linspace(_mel(0.0), _mel(top), bands + 2))
    bins = np.linspace(0, rate / 2, n_fft // 2 + 1)
    up = (bins[None, :] - edges[:-2, None]) / np.diff(edges)[:-1, None]
    down = (edges[2:, None] - bins[None, :]) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def log_mel(y: np.ndarray, rate: int = RATE, bands: int = 128, hop: int = 128, n_fft: int = 512, top: float | None = 8000, floor: float = 80.0) -> np.ndarray:
    """Mel power in dB below its own peak, floor dB at most."""
    power = mel_filters(rate, n_fft, bands, top or rate / 2) @ spectrum(y, n_fft, hop) ** 2
    db = 10 * np.log10(np.maximum(power, 1e-10))
    db -= 10 * np.log10(max(float(power.max(initial=0)), 1e-10))
    return np.maximum(db, db.max(initial=-floor) - floor)


def contrast(magnitude: np.ndarray, rate: int = RATE, octaves: int = 6, low: float = 200.0, share: float = 0.02) -> np.ndarray:
    """Spectral contrast (band, frame): dB between the mean of the strongest and of the weakest bins of each octave band."""
    bins = np.linspace(0, rate / 2, len(magnitude))
    edges = np.concatenate(([0.0], low * 2.0 ** np.arange(octaves + 1)))
    out = np.zeros((octaves + 1, magnitude.shape[1]))
    for k in range(octaves + 1):
        inside = np.flatnonzero((bins >= edges[k]) & (bins <= edges[k + 1]))
        if k and len(inside) and inside[0] > 0:
            inside = np.concatenate(([inside[0] - 1], inside))
        if k == octaves:
            inside = np.concatenate((inside, np.arange(inside[-1] + 1, len(bins)))) if len(inside) else inside
        band = np.sort(magnitude[inside[:-1] if k < octaves and len(inside) > 1 else inside], axis=0)
        if not len(band):
            continue
        n = max(1, int(round(share * len(inside))))
        out[k] = 10 * np.log10(np.maximum(band[-n:].mean(0), 1e-10)) - 10 * np.log10(np.maximum(band[:n].mean(0), 1e-10))
    return out


def centroid(magnitude: np.ndarray, rate: int = RATE) -> np.ndarray:
    """Centre of gravity of each frame's spectrum in Hz; 0 for silence."""
    bins = np.linspace(0, rate / 2, len(magnitude))
    weight = magnitude.sum(0)
    return (bins @ magnitude) / np.where(weight > 0, weight, 1)


def salience(y: np.ndarray, rate: int = RATE) -> float:
    """0.7 of the mean spectral contrast over 40 dB and 0.3 of the mean centroid over the rate, in [0, 1]; 0 where it can't be computed."""
    if not len(y):
        return 0.0
    s = spectrum(y, 2048, 512)
    value = 0.7 * float(np.mean(contrast(s, rate))) / 40 + 0.3 * float(np.mean(centroid(s, rate))) / rate
    return float(np.clip(value, 0, 1)) if np.isfinite(value) else 0.0


def pooled(frames: np.ndarray) -> np.ndarray:
    """Mean and population deviation of each band over time."""
    return np.concatenate([frames.mean(1), frames.std(1)]).astype(np.float32)


def clip_embedding(y: np.ndarray, rate: int = RATE, hop: int = 512) -> np.ndarray:
    """Pooled log-mel of a clip, 256 numbers; zeros for an empty one."""
    return pooled(log_mel(y, rate, hop=hop)) if len(y) else np.zeros(256, np.float32)


def frame_embedding(y: np.ndarray, rate: int = RATE, seconds: float = 3.0) -> np.ndarray | None:
    """Log-mel frames of unit length (band, frame) of the first seconds; None below that length."""
    if len(y) < seconds * rate:
        return None
    m = log_mel(y[: int(seconds * rate)], rate)
    norm = np.linalg.norm(m, axis=0, keepdims=True)
    return m / np.where(norm > 0, norm, 1)


def frame_similarity(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """Mean, least and 5th percentile of the similarities of frames, the shorter one deciding how many."""
    n = min(a.shape[1], b.shape[1])
    sims = np.clip((a[:, :n] * b[:, :n]).sum(0), -1, 1)
    return float(sims.mean()), float(sims.min()), float(np.percentile(sims, 5))


def cnn_features(y: np.ndarray, rate: int = RATE, bands: int = 224, frames: int = 224, seconds: float = 3.0) -> np.ndarray:
    """Log-mel picture of a clip of fixed length, scaled to [0, 1]; NaN and infinities as 0. With too few frames the picture is read over again, row by row, until the shape is full."""
    n = int(rate * seconds)
    y = np.pad(y[:n], (0, max(0, n - len(y))))
    m = np.nan_to_num(log_mel(y, rate, bands=bands, hop=max(1, int((n - 512) / (frames - 1))), top=None)[:, :frames], posinf=0.0, neginf=0.0)
    span = m.max() - m.min()
    m = (m - m.min()) / span if span > 0 else np.zeros_like(m)
    return (m if m.shape == (bands, frames) else np.resize(m, (bands, frames))).astype(np.float32)


def soft_limit(y: np.ndarray, ceiling: float = 0.99, alpha: float = 5.0) -> np.ndarray:
    peak = float(np.abs(y).max(initial=0))
    return y if not peak else np.clip(np.tanh(alpha * y * min(1.0, ceiling / peak)) / alpha, -1, 1).astype(np.float32)


def curve_limit(y: np.ndarray, ceiling: float = 0.99, alpha: float = 5.0) -> np.ndarray:
    peak = float(np.abs(y).max(initial=0))
    if peak < 0.9999:
        return y
    scaled = y / peak * ceiling
    return (scaled * (1 + alpha) / (1 + alpha * np.abs(scaled))).astype(np.float32)


def kmeans(x: np.ndarray, k: int, seed: int = 42, rounds: int = 50) -> np.ndarray:
    """Lloyd's algorithm from k-means++ seeds over standardised columns."""
    scale = x.std(0)
    x = (x - x.mean(0)) / np.where(scale > 0, scale, 1)
    rng = np.random.default_rng(seed)
    centres = [x[rng.integers(len(x))]]
    while len(centres) < k:
        far = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0)
        centres.append(x[rng.choice(len(x), p=far / far.sum())] if far.sum() > 0 else x[rng.integers(len(x))])
    c, label = np.array(centres), np.full(len(x), -1)
    for _ in range(rounds):
        new = np.argmin(((x[:, None] - c[None]) ** 2).sum(2), axis=1)
        if np.array_equal(new, label):
            break
        label = new
        for j in range(k):
            if (label == j).any():
                c[j] = x[label == j].mean(0)
    return label
