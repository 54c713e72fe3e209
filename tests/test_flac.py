"""FLAC: the format's own published example, round trips, and frames put together bit by bit."""

import hashlib

import numpy as np
import pytest

from mediasieve.functions import dsp, flac
from mediasieve.operators import segments
from mediasieve.sources import sinks, tables

# The first example file of RFC 9639, one stereo sample, with its MD5.
EXAMPLE = bytes.fromhex("664c614380000022100010000000" "0f00000f0ac442f0000000013e84b41807dc690307586a3dad1a2e0f" "fff86918" "0000bf0358fd0312" "8baa9a")


def wave(kind, n):
    t = np.arange(n)
    return {"sine": 0.7 * np.sin(t / 9), "noise": np.random.default_rng(1).uniform(-1, 1, n), "silence": np.zeros(n), "square": np.sign(np.sin(t / 50)), "quiet": 0.0002 * np.sin(t)}[kind]


def whole(y):
    return np.round(np.clip(y, -1, 1 - 1 / 32768) * 32768).astype(int)


def put(*fields):
    """Bytes of (value, bits) pairs, filled up with zeros."""
    text = "".join(format(v & ((1 << n) - 1), f"0{n}b") for v, n in fields if n)
    text += "0" * (-len(text) % 8)
    return int(text, 2).to_bytes(len(text) // 8, "big")


def stream(samples, channel_code, channels, *subframes):
    """A file of one frame of 16-bit samples; samples (place, channel) give the MD5."""
    n = len(samples)
    head = put((16, 16), (16, 16), (0, 48), (8000, 20), (channels - 1, 3), (15, 5), (n, 36)) + hashlib.md5(np.array(samples).astype("<i2").tobytes()).digest()
    frame = put((0x7FFC, 15), (0, 1), (6, 4), (0, 4), (channel_code, 4), (4, 3), (0, 1), (0, 8), (n - 1, 8))
    frame += bytes([flac.crc8(frame)]) + put(*[f for s in subframes for f in s])
    return b"fLaC\x80\x00\x00\x22" + head + frame + flac.crc16(frame).to_bytes(2, "big")


def plain(values, size=16):
    return [(0, 1), (1, 6), (0, 1), *[(v, size) for v in values]]


def rice(values, k):
    u = [2 * v if v >= 0 else -2 * v - 1 for v in values]
    return [(0, 2), (0, 4), (k, 4), *[f for x in u for f in ((1, (x >> k) + 1), (x, k))]]


def test_published_example():
    y, rate, size = flac.decode(EXAMPLE)
    assert (y.tolist(), rate, size) == ([[25588], [10416]], 44100, 16)  # the values whose MD5 the file gives


@pytest.mark.parametrize("kind", ["sine", "noise", "silence", "square", "quiet"])
@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 4096, 4097, 20_000])
def test_round_trip(kind, n):
    y = wave(kind, n)
    content = flac.write(y)
    got, rate, size = flac.decode(content)
    assert (rate, size) == (16_000, 16) and np.array_equal(got, whole(y)[None, :])
    assert flac.duration(content) == (n / 16_000 or None)
    if kind != "noise" and n == 20_000:
        assert len(content) < 2 * n  # of 16-bit PCM


def test_many_frames_have_long_numbers():
    y = wave("silence", flac.BLOCK * 2100)
    assert flac.decode(flac.write(y))[0].shape == (1, len(y))


def test_stereo_codes():
    left, right = [100, -7, 32767, 5], [90, -9, -32768, 6]
    side = [a - b for a, b in zip(left, right)]
    mid = [(a + b) >> 1 for a, b in zip(left, right)]
    both = list(zip(left, right))
    for code, first, second in ((1, plain(left), plain(right)), (8, plain(left), plain(side, 17)), (9, plain(side, 17), plain(right)), (10, plain(mid), plain(side, 17))):
        assert flac.decode(stream(both, code, 2, first, second))[0].tolist() == [left, right]


def test_predictors_wasted_bits_and_raw_residuals():
    y = [1000, 1100, 1190, 1275, 1350, 1300, 900]
    # Order 2, coefficients 60 and -28 over 32: the newest sample first.
    said = [(60 * y[k - 1] - 28 * y[k - 2]) >> 5 for k in range(2, 7)]
    left = [v - p for v, p in zip(y[2:], said)]
    lpc = [(0, 1), (33, 6), (0, 1), (y[0], 16), (y[1], 16), (7, 4), (5, 5), (60, 8), (-28, 8)]
    assert flac.decode(stream([[v] for v in y], 0, 1, [*lpc, *rice(left, 5)]))[0].tolist() == [y]
    raw = [(0, 2), (0, 4), (15, 4), (12, 5), *[(v, 12) for v in left]]
    assert flac.decode(stream([[v] for v in y], 0, 1, [*lpc, *raw]))[0].tolist() == [y]
    z = [8, -16, 24, 800]
    wasted = [(0, 1), (1, 6), (1, 1), (1, 3), *[(v >> 3, 13) for v in z]]
    assert flac.decode(stream([[v] for v in z], 0, 1, wasted))[0].tolist() == [z]
    same = [(0, 1), (0, 6), (0, 1), (-3, 16)]
    assert flac.decode(stream([[-3]] * 9, 0, 1, same))[0].tolist() == [[-3] * 9]


def test_damage_is_an_error():
    good = flac.write(wave("sine", 5000))
    for at in (10, 30, 50, 300, len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 16
        with pytest.raises(ValueError):
            if flac.decode(bytes(bad))[0].tolist() == flac.decode(good)[0].tolist():
                raise ValueError("a header field that changes no sample")
    for cut in (0, 3, 41, 60, len(good) - 1):
        with pytest.raises(ValueError):
            flac.decode(good[:cut])


def test_in_tables(spark):
    y = wave("sine", 50_000)
    df = spark.createDataFrame([(1, y.tolist()), (2, None)], "id long, samples array<double>")
    files = sinks.with_flac(df).select("id", "content")
    assert [(r["id"], r["seconds"]) for r in tables.durations(files.where("id = 1")).collect()] == [(1, 3.125)]
    got = {r["id"]: r for r in segments.decoded(files.where("id = 1").unionByName(spark.createDataFrame([(3, bytearray(b"fLaCxx"))], files.schema))).collect()}
    assert np.array_equal(got[1]["samples"], whole(y.astype(np.float32)) / 32768)  # samples are single precision and got[1]["reason"] is None
    assert got[3]["samples"] is None and got[3]["reason"] == "decode: ValueError"
    assert sinks.with_flac(df).where("id = 2").first()["content"] is None
    assert np.allclose(dsp.load(flac.write(y, 8000), 16_000).size, 100_000)
