"""Validators on made files: frames, checksums, updates, nesting, and time in proportion to the bytes."""

import struct
import time

import numpy as np
from pyspark.sql import functions as F

from mediasieve.llm import media

FOUND = media.automaton()


def crc(data, bits, poly):
    """Bit by bit, the highest first."""
    x = 0
    for byte in data:
        x ^= byte << (bits - 8)
        for _ in range(8):
            x = (x << 1 ^ poly if x >> (bits - 1) else x << 1) & ((1 << bits) - 1)
    return x


def flac(frames=3, samples=192, total=True, seed=0):
    """Constant-subframe FLAC of one channel and 16 bits."""
    rng = np.random.default_rng(seed)
    count = frames * samples if total else 0
    info = struct.pack(">HH", samples, samples) + bytes(6) + (16_000 << 44 | 0 << 41 | 15 << 36 | count).to_bytes(8, "big") + bytes(16)
    out = b"fLaC" + b"\x00\x00\x00\x22" + info + b"\x81\x00\x00\x05hello"
    for k in range(frames):
        head = bytes([0xFF, 0xF8, 0x10 | 5, 0x08, k])
        head += bytes([crc(head, 8, 0x07)])
        body = head + b"\x02" + rng.bytes(samples * 2)  # a verbatim subframe
        out += body + crc(body, 16, 0x8005).to_bytes(2, "big")
    return out


def ogg(body, serial=b"abcd", flags=4, checked=True):
    page = b"OggS\0" + bytes([flags]) + bytes(8) + serial + bytes(8) + bytes([1, len(body)]) + body
    return page[:22] + struct.pack("<I", crc(page, 32, 0x04C11DB7)) + page[26:] if checked else page


def test_flac_ends_with_its_last_frame():
    for total in (True, False):
        a, b = flac(3, total=total), flac(2, seed=1, total=total)
        assert media.sniff(a, FOUND) == [("flac", 0, len(a))]
        got = media.sniff(b"#" * 7 + a + b"tail of other bytes" + b + b"##", FOUND)
        assert got == [("flac", 7, len(a)), ("flac", 26 + len(a), len(b))]
    broken = bytearray(flac(1))
    broken[-1] ^= 1
    assert media.sniff(bytes(broken), FOUND) == []


def test_ogg_checksums():
    good = ogg(b"hello", flags=0) + ogg(b"world")
    assert media.sniff(good, FOUND) == [("ogg", 0, len(good))]
    bad = good.replace(b"world", b"w0rld")
    assert media.sniff(bad, FOUND)[0] == ("ogg", 0, len(good) // 2)
    assert media.sniff(ogg(b"hello").replace(b"hello", b"hallo"), FOUND) == []


def test_pdf_with_updates_and_another_behind():
    one = b"%PDF-1.4\nx\nstartxref\n9\n%%EOF\nupdate\nstartxref\n20\n%%EOF"
    two = b"%PDF-1.7\ny\nstartxref\n3\n%%EOF"
    assert media.sniff(one + b"\n--\n" + two, FOUND) == [("pdf", 0, len(one)), ("pdf", len(one) + 4, len(two))]
    assert media.sniff(b"%PDF-1.4 without an end", FOUND) == [] == media.sniff(b"%PDF-1.4 %%EOF", FOUND)


def test_mp4_with_long_and_open_boxes():
    head = b"\0\0\0\x10ftypisom\0\0\0\0"
    wide = head + b"\0\0\0\x01mdat" + (16 + 5).to_bytes(8, "big") + b"abcde" + b"\0\0\0\x08free"
    assert media.sniff(wide + b"\xff\xff", FOUND) == [("mp4", 0, len(wide))]
    rest = head + b"\0\0\0\x00mdat" + b"x" * 40
    assert media.sniff(rest, FOUND) == [("mp4", 0, len(rest))]


def test_a_thumbnail_in_a_jpeg():
    small = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xda\x00\x03\x01" + b"\x11\x22" + b"\xff\xd9"
    exif = b"Exif\0\0" + small
    outer = b"\xff\xd8\xff\xe1" + (len(exif) + 2).to_bytes(2, "big") + exif + b"\xff\xda\x00\x03\x01" + b"\x33\xff\x00\x44" + b"\xff\xd9"
    assert media.sniff(outer, FOUND) == [("jpeg", 0, len(outer)), ("jpeg", 12, len(small))]


def test_time_is_in_proportion():
    for text in (b"%PDF-", b"OggS\0\0", b"\xff\xd8\xff", b"GIF89a", b"fLaC\0\0\0\x22", b"RIFF", b"%PDF-%%EOF", b"\0\0\0\x08ftyp"):
        began = time.time()
        media.sniff(text * (4_000_000 // len(text)), FOUND)
        assert time.time() - began < 20, text


def test_carving_gives_bytes(spark):
    png, wav = media.store_png(bytes(64)), media.store_wav(bytes(128))
    blob = b"prefix" + png + b"between" + wav
    df = spark.createDataFrame([(1, bytearray(blob), "x", 5), (2, None, "x", 5), (3, bytearray(png), "png", 5)], "id int, data binary, declared string, start int")
    got = media.carved_media(media.sniffed(df, "data", "declared"), "data").collect()
    assert [(r["id"], r["kind"], bytes(r["media"])) for r in got] == [(1, "png", png), (1, "wav", wav)]
    assert media.carved_media(media.sniffed(df.where(F.lit(False)), "data", "declared"), "data").count() == 0


def test_features_come_from_the_samples(spark):
    docs = spark.createDataFrame([(1, "abc" * 50), (2, "abd" * 50), (3, "abc" * 50)], "doc_id long, text string")
    got = {r["doc_id"]: r["feature"].split("; ")[-1] for r in media.result(docs).collect()}
    assert got[1] == got[3] != got[2]
    x = np.frombuffer(b"abc" * 50 + bytes(42), np.uint8).astype(float)
    assert got[1] == f"mean {x.mean():.4f} rms {((x - 128) ** 2).mean() ** 0.5:.4f} crossings 0 entropy {-sum(p * np.log2(p) for p in np.unique(x, return_counts=True)[1] / len(x)):.4f}"
