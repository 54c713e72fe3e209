"""Media columns by signature sniffing.

One Aho-Corasick automaton finds the magic bytes of all formats in a blob in a single pass; a validator for each format
walks the structure behind them and confirms lengths and checksums. What is confirmed at the start is the blob's type,
whatever was declared; what is confirmed further in is embedded media and can be carved out.

A blob is read once by the automaton, which also notes where PDFs end. Validators step from one length to the next, and
a format is not looked for again inside what was confirmed of it, but for places that may hold another: a JPEG's segments
before its image data, the members of a RIFF of another format.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

# Magic bytes, the format each announces, and how far into the file they stand.
SIGNATURES = (
    (b"\x89PNG\r\n\x1a\n", "png", 0),
    (b"\xff\xd8\xff", "jpeg", 0),
    (b"GIF87a", "gif", 0),
    (b"GIF89a", "gif", 0),
    (b"BM", "bmp", 0),
    (b"RIFF", "riff", 0),
    (b"fLaC", "flac", 0),
    (b"OggS", "ogg", 0),
    (b"%PDF-", "pdf", 0),
    (b"ftyp", "mp4", 4),
    (b".snd", "au", 0),
)
#: Marks that the automaton notes beside the signatures.
PDF_MARKS = (b"%%EOF", b"startxref")
ALIGN, RATE, WIDTH = 64, 16_000, 64


def _png(b: bytes, at: int) -> int:
    i, first = at + 8, True
    while i + 12 <= len(b):
        (n,) = struct.unpack_from(">I", b, i)
        kind, end = b[i + 4 : i + 8], i + 12 + n
        if end > len(b) or first and (kind != b"IHDR" or n != 13) or zlib.crc32(b[i + 4 : end - 4]) != struct.unpack_from(">I", b, end - 4)[0]:
            return 0
        first, i = False, end
        if kind == b"IEND":
            return i - at
    return 0


def _jpeg(b: bytes, at: int) -> int:
    i, scans = at + 2, 0
    while i + 4 <= len(b):
        if b[i] != 0xFF:
            return 0
        kind = b[i + 1]
        if kind == 0xD9:
            return i + 2 - at if scans else 0
        if kind == 0xFF:  # a fill byte
            i += 1
            continue
        if kind < 0xC0 or kind == 0xD8:
            return 0
        n = struct.unpack_from(">H", b, i + 2)[0]
        if n < 2 or i + 2 + n > len(b):
            return 0
        i += 2 + n
        if kind == 0xDA:  # coded data runs to the next marker that is neither stuffed nor a restart
            scans += 1
            while True:
                i = b.find(b"\xff", i)
                if i < 0 or i + 1 >= len(b):
                    return 0
                if b[i + 1] != 0 and not 0xD0 <= b[i + 1] <= 0xD7:
                    break
                i += 2
    return i + 2 - at if scans and b[i : i + 2] == b"\xff\xd9" else 0


def _gif(b: bytes, at: int) -> int:
    if at + 13 > len(b):
        return 0
    flags, i = b[at + 10], at + 13
    i += 3 << ((flags & 7) + 1) if flags & 0x80 else 0

    def blocks(i: int) -> int:
        while i < len(b) and b[i]:
            i += b[i] + 1
        return i + 1

    images = 0
    while i < len(b):
        if b[i] == 0x3B:
            return i + 1 - at if images else 0
        if b[i] == 0x21:
            i = blocks(i + 2)
        elif b[i] == 0x2C and i + 10 < len(b):
            flags = b[i + 9]
            i, images = blocks(i + 11 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0)), images + 1
        else:
            return 0
    return 0


def _bmp(b: bytes, at: int) -> int:
    if at + 54 > len(b):
        return 0
    size, zero, start, head, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    if zero or head not in (40, 52, 56, 108, 124) or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or width <= 0 or not height:
        return 0
    least = start + (width * bits + 31) // 32 * 4 * abs(height)
    return size if struct.unpack_from("<I", b, at + 30)[0] == 0 and least == size <= len(b) - at and start >= 14 + head else 0


def _riff(b: bytes, at: int) -> int:
    if at + 12 > len(b):
        return 0
    (n,) = struct.unpack_from("<I", b, at + 4)
    end, i, seen = at + 8 + n, at + 12, []
    if end > len(b) or b[at + 8 : at + 12] not in (b"WAVE", b"WEBP", b"AVI "):
        return 0
    while i + 8 <= end:
        seen.append(b[i : i + 4])
        (k,) = struct.unpack_from("<I", b, i + 4)
        i += 8 + k + (k & 1)
    return end - at if i == end and (b[at + 8 : at + 12] != b"WAVE" or {b"fmt ", b"data"} <= set(seen)) and seen else 0


def _crc_table(bits: int, poly: int) -> list[int]:
    """Remainders of a CRC whose highest bit goes first, by byte."""
    out = []
    for byte in range(256):
        x = byte << (bits - 8)
        for _ in range(8):
            x = (x << 1 ^ poly if x >> (bits - 1) else x << 1) & ((1 << bits) - 1)
        out.append(x)
    return out


_CRC8, _CRC16 = _crc_table(8, 0x07), _crc_table(16, 0x8005)
_REVERSED = bytes(int(f"{x:08b}"[::-1], 2) for x in range(256))


def _flac_frame(b: bytes, at: int, width: int) -> tuple[int, int, int] | None:
    """Samples, bytes of the header and most bytes of the frame at a place, or None: sync, fields and checksum of the header must fit. width: bits of a sample in the stream's head."""
    if at + 6 > len(b) or b[at] != 0xFF or b[at + 1] & 0xFE != 0xF8:
        return None
    size, rate, channels, bits = b[at + 2] >> 4, b[at + 2] & 15, b[at + 3] >> 4, b[at + 3] >> 1 & 7
    if not size or rate == 15 or channels > 10 or bits == 3 or b[at + 3] & 1:
        return None
    i, lead = at + 4, b[at + 4]
    more = 0 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length() - 1  # bytes that follow in the coded number
    if lead >= 0x80 and not 1 <= more <= 6:
        return None
    i += 1 + more
    if i + 4 > len(b):
        return None
    samples = 192 if size == 1 else 576 << (size - 2) if size < 6 else 256 << (size - 8)
    if size == 6:
        samples, i = b[i] + 1, i + 1
    elif size == 7:
        samples, i = int.from_bytes(b[i : i + 2], "big") + 1, i + 2
    i += (0, 1, 2, 2)[max(0, rate - 11)]
    crc = 0
    for x in b[at:i]:
        crc = _CRC8[crc ^ x]
    if i >= len(b) or crc != b[i]:
        return None
    count = channels + 1 if channels < 8 else 2
    # Subframes as they are, with a byte each before them: no frame is longer.
    return samples, i + 1 - at, i + 3 - at + count * (2 + (samples * ((0, 8, 12, 0, 16, 20, 24, 32)[bits] or width) + samples + 7) // 8)


def _flac(b: bytes, at: int) -> int:
    if at + 42 > len(b) or b[at + 4] & 0x7F or b[at + 5 : at + 8] != b"\0\0\x22":
        return 0
    head = int.from_bytes(b[at + 18 : at + 26], "big")
    width, total = (head >> 36 & 31) + 1, head & ((1 << 36) - 1)
    i, last = at + 4, 0
    while not last:
        if i + 4 > len(b):
            return 0
        last, i = b[i] >> 7, i + 4 + int.from_bytes(b[i + 1 : i + 4], "big")
    done, good = 0, 0
    while (not total or done < total) and (frame := _flac_frame(b, i, width)):
        # A frame doesn't tell its length: it ends where its checksum comes out, before another frame or as the last.
        samples, size, most = frame
        crc, end = 0, 0
        for k in range(i, min(len(b), i + most)):
            crc = (crc << 8 & 0xFF00) ^ _CRC16[crc >> 8 ^ b[k]]
            if not crc and k >= i + size + 2:
                if total and done + samples >= total or _flac_frame(b, k + 1, width):
                    end = k + 1
                    break
                end = end or k + 1  # the first fit, where no frame follows
        if not end:
            break
        done, i, good = done + samples, end, end
    return good - at if good else 0


def _ogg_checked(page: bytes) -> bool:
    """Whether the checksum of a page fits; one of zero counts as not given."""
    said = struct.unpack_from("<I", page, 22)[0]
    if not said:
        return True
    raw = zlib.crc32((page[:22] + bytes(4) + page[26:]).translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int(f"{raw:032b}"[::-1], 2) == said


def _ogg(b: bytes, at: int) -> int:
    i, serial = at, None
    while b[i : i + 4] == b"OggS" and i + 27 <= len(b) and b[i + 4] == 0:
        n = b[i + 26]
        size = 27 + n + sum(b[i + 27 : i + 27 + n])
        own = b[i + 14 : i + 18]
        if i + size > len(b) or serial not in (None, own) or not _ogg_checked(b[i : i + size]):
            break
        serial, i = own, i + size
        if b[i - size + 5] & 4:
            return i - at
    return i - at


def _pdf(at: int, starts: list[int], ends: list[int], tables: list[int]) -> int:
    """Length of a PDF from the marks of the whole blob: to the last %%EOF before the next PDF, as updates add their own; there is a startxref before it."""
    k = bisect.bisect_right(starts, at)
    stop = starts[k] if k < len(starts) else 1 << 62
    e = bisect.bisect_left(ends, stop) - 1
    if e < 0 or ends[e] < at:
        return 0
    t = bisect.bisect_left(tables, at)
    return ends[e] + 5 - at if t < len(tables) and tables[t] < ends[e] else 0


def _mp4(b: bytes, at: int) -> int:
    """Boxes one behind the other, with lengths of 32 or 64 bits; one of length 0 runs to the end."""
    i, seen = at, []
    while i + 8 <= len(b):
        n, kind = struct.unpack_from(">I", b, i)[0], b[i + 4 : i + 8]
        if n == 1 and i + 16 <= len(b):
            n = struct.unpack_from(">Q", b, i + 8)[0]
        elif n == 0 and seen:
            n = len(b) - i
        if n < 8 or i + n > len(b) or not kind.isalnum():
            break
        seen.append(kind)
        i += n
    return i - at if seen[:1] == [b"ftyp"] and len(seen) > 1 else 0


def _au(b: bytes, at: int) -> int:
    if at + 24 > len(b):
        return 0
    start, size, coding, rate, channels = struct.unpack_from(">IIIII", b, at + 4)
    return start + size if 24 <= start <= 4096 and 1 <= coding <= 27 and 0 < rate <= 768_000 and 0 < channels <= 64 and at + start + size <= len(b) else 0


VALIDATORS: dict[str, Callable[[bytes, int], int]] = {"png": _png, "jpeg": _jpeg, "gif": _gif, "bmp": _bmp, "riff": _riff, "flac": _flac, "ogg": _ogg, "mp4": _mp4, "au": _au}


def automaton() -> ahocorasick.Automaton:
    """Over bytes as Latin-1 characters, one for one."""
    out = ahocorasick.Automaton()
    for magic, kind, offset in SIGNATURES:
        out.add_word(magic.decode("latin-1"), (kind, len(magic) - 1 + offset))
    for mark in PDF_MARKS:
        out.add_word(mark.decode("latin-1"), (mark, len(mark) - 1))
    out.make_automaton()
    return out


def _image_data(b: bytes, at: int) -> int:
    """Where the segments before a confirmed JPEG's image data end."""
    i = at + 2
    while b[i + 1] != 0xDA:
        i += 1 if b[i + 1] == 0xFF else 2 + struct.unpack_from(">H", b, i + 2)[0]
    return i


def sniff(data: bytes, found: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Confirmed (format, start, length) in data, by start; what lies inside a confirmed one of another format is given too, and a JPEG in another's segments."""
    hits, marks = [], {m: [] for m in PDF_MARKS}
    for end, (kind, back) in found.iter(data.decode("latin-1")):
        if kind in marks:
            marks[kind].append(end - back)
        elif end >= back:
            hits.append((kind, end - back))
    pdfs = [at for kind, at in hits if kind == "pdf"]
    out, past = [], {}
    for kind, at in hits:
        low, high = past.get(kind, (0, 0))
        if low <= at < high:
            continue
        if n := _pdf(at, pdfs, marks[PDF_MARKS[0]], marks[PDF_MARKS[1]]) if kind == "pdf" else VALIDATORS[kind](data, at):
            name = {b"WAVE": "wav", b"WEBP": "webp", b"AVI ": "avi"}[data[at + 8 : at + 12]] if kind == "riff" else kind
            out.append((name, at, n))
            if at + n > high:
                past[kind] = (_image_data(data, at) if kind == "jpeg" else at, at + n)
    return sorted(out, key=lambda x: x[1:])


def store_wav(payload: bytes) -> bytes:
    return b"RIFF" + struct.pack("<I", 36 + len(payload)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload


def store_bmp(payload: bytes) -> bytes:
    rows = len(payload) // WIDTH
    grey = b"".join(bytes((i, i, i, 0)) for i in range(256))
    head = struct.pack("<IIIIiiHHIIiiII", 54 + 1024 + len(payload), 0, 54 + 1024, 40, WIDTH, -rows, 1, 8, 0, len(payload), 2835, 2835, 256, 256)
    return b"BM" + head + grey + payload


def store_png(payload: bytes) -> bytes:
    rows = len(payload) // WIDTH

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    lines = b"".join(b"\0" + payload[i : i + WIDTH] for i in range(0, len(payload), WIDTH))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, rows, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines, 1)) + chunk(b"IEND", b"")


STORES = {"wav": store_wav, "bmp": store_bmp, "png": store_png}


def _chunks(b: bytes, at: int, order: str, size_first: bool) -> Iterator[tuple[bytes, bytes]]:
    while at + 8 <= len(b):
        n, kind = (struct.unpack_from(order + "I4s", b, at)) if size_first else struct.unpack_from(order + "4sI", b, at)[::-1]
        yield kind, b[at + 8 : at + 8 + n]
        at += 8 + n + (4 if size_first else n & 1)


def read_samples(kind: str, b: bytes) -> tuple[bytes, str]:
    """The 8-bit samples of a wav, bmp or png of this module's kind of storage, and a line of its shape."""
    if kind == "wav":
        parts = dict(_chunks(b, 12, "<", False))
        _, channels, rate, _, _, bits = struct.unpack("<HHIIHH", parts[b"fmt "][:16])
        return parts[b"data"], f"{rate}Hz x{channels} {bits}bit {len(parts[b'data'])} samples"
    if kind == "bmp":
        size, _, start, _, width, height = struct.unpack_from("<IIIIii", b, 2)
        return b[start:size], f"{width}x{abs(height)} 8bit"
    if kind == "png":
        parts = list(_chunks(b, 8, ">", True))
        width, height = struct.unpack(">II", parts[0][1][:8])
        lines = zlib.decompress(b"".join(body for k, body in parts if k == b"IDAT"))
        return b"".join(lines[i + 1 : i + 1 + width] for i in range(0, len(lines), width + 1)), f"{width}x{height} 8bit"
    raise ValueError(f"no samples in {kind}")


SNIFFED = "kind string, corrected boolean, length long, carved array<struct<kind:string,start:bigint,length:bigint>>"


def sniffed(df: DataFrame, data_col: str, declared_col: str) -> DataFrame:
    """df with kind, corrected, length and carved.

    kind: the format confirmed at the start of the bytes, else null; length: its confirmed bytes; corrected: whether a
    kind was confirmed and is not the declared one (a null declaration counts as another); carved: what is confirmed further in. Null or
    empty bytes have no kind. Columns of df with these names are replaced.
    """
    added = ("kind", "corrected", "length", "carved")
    own = df.select(*[c for c in df.columns if c not in added])
    schema = T.StructType(own.schema.fields + T.StructType.fromDDL(SNIFFED).fields)
    names = own.columns
    data, declared = names.index(data_col), names.index(declared_col)

    def run(batches):
        found = automaton()
        for b in batches:
            kinds, wrong, lengths, carved = [], [], [], []
            for blob, said in zip(b.column(data), b.column(declared), strict=True):
                hits = sniff(blob.as_py() or b"", found)
                head = next((h for h in hits if h[1] == 0), None)
                kinds.append(head[0] if head else None)
                lengths.append(head[2] if head else None)
                wrong.append(bool(head) and said.as_py() != head[0])
                carved.append([{"kind": k, "start": at, "length": n} for k, at, n in hits if at])
            inner = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(kinds, pa.string()), pa.array(wrong, pa.bool_()), pa.array(lengths, pa.int64()), pa.array(carved, inner)], [*names, *added])

    return own.mapInArrow(run, schema)


def carved_media(found: DataFrame, data_col: str) -> DataFrame:
    """A row for each embedded medium of sniffed rows: the other columns of found, and kind, start, length and media, its bytes. Rows without embedded media give none."""
    names = [c for c in found.columns if c not in (data_col, "kind", "corrected", "length", "carved", "start", "media")]
    each = found.select(*names, F.col(data_col).alias("media"), F.explode("carved").alias("x"))
    part = F.substring("media", (F.col("x.start") + 1).cast("int"), F.col("x.length").cast("int"))
    return each.select(*names, "x.kind", "x.start", "x.length", part.alias("media"))


def sample_features(samples: bytes) -> str:
    """Level, loudness, crossings of the middle and entropy of 8-bit samples."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64)
    n = max(1, len(x))
    share = np.bincount(x, minlength=256) / n
    entropy = -float((share[share > 0] * np.log2(share[share > 0])).sum())
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    return f"mean {x.sum() / n:.4f} rms {(((x - 128) ** 2).sum() / n) ** 0.5:.4f} crossings {crossings} entropy {entropy + 0.0:.4f}"


def stored(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df without text_col, with n_bytes, declared and data: each whole text (null: empty) as UTF-8, zero bytes up to a positive multiple of 64, in one of the formats of STORES by its checksum. declared is right for two texts of three."""
    names = [c for c in df.columns if c not in (text_col, "n_bytes", "declared", "data")]
    own = df.select(*names, F.col(text_col).cast("binary").alias(fresh(df, "_text")))
    schema = df.select(*names).schema.add("n_bytes", "long").add("declared", "string").add("data", "binary")
    kinds = tuple(STORES)

    def run(batches):
        for b in batches:
            sizes, said, blobs = [], [], []
            for x in b.column(len(names)):
                raw = x.as_py() or b""
                payload = raw + bytes(-len(raw) % ALIGN or (0 if raw else ALIGN))
                mark = zlib.crc32(raw)
                kind = kinds[mark % 3]
                sizes.append(len(raw))
                said.append(kind if mark // 3 % 3 else kinds[(mark + 1) % 3])
                blobs.append(STORES[kind](payload))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(sizes, pa.int64()), pa.array(said, pa.string()), pa.array(blobs, pa.binary())], [*names, "n_bytes", "declared", "data"])

    return own.mapInArrow(run, schema)


def digests(df: DataFrame) -> DataFrame:
    """The contract's columns from stored and sniffed rows: the samples are read back from the bytes by the kind found in them."""
    out = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def run(batches):
        for b in batches:
            cols = [[] for _ in range(6)]
            for row in b.select(["kind", "corrected", "length", "carved", "data", "declared"]).to_pylist():
                payload, shape = read_samples(row["kind"], row["data"][: row["length"]])
                feature = f"{row['kind']} {shape}; declared {row['declared']}{' (corrected)' if row['corrected'] else ''}; embedded {len(row['carved'])}; {sample_features(payload)}"
                for c, v in zip(cols, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ALIGN:]), len(row["data"]), hashlib.sha256(row["data"]).hexdigest(), feature), strict=True):
                    c.append(v)
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")).cast(pa.int64()), b.column(b.schema.get_field_index("n_bytes")), *arrays], [x.split()[0] for x in out.split(", ")])

    return df.mapInArrow(run, out)


def result(docs: DataFrame) -> DataFrame:
    return digests(sniffed(stored(docs.select("doc_id", "text")), "data", "declared"))
