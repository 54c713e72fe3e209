"""FLAC (RFC 9639): decoding of whole files, and encoding of mono 16-bit ones with fixed predictors."""

from __future__ import annotations

import hashlib

import numpy as np

MAGIC = b"fLaC"
#: Samples of a block when encoding.
BLOCK = 4096
# Fixed values of the format: sample sizes by code.
SIZES = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}


def _table(poly: int, bits: int) -> list[int]:
    out = []
    for n in range(256):
        c = n << (bits - 8)
        for _ in range(8):
            c = (c << 1) ^ (poly if c >> (bits - 1) else 0)
            c &= (1 << bits) - 1
        out.append(c)
    return out


_CRC8, _CRC16 = _table(0x07, 8), _table(0x8005, 16)


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _CRC8[c ^ b]
    return c


def crc16(data: bytes) -> int:
    c = 0
    for b in data:
        c = (c << 8 & 0xFFFF) ^ _CRC16[c >> 8 ^ b]
    return c


class Bits:
    """Big-endian reader of single bits; reading beyond the end raises ValueError."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.p, self.end = data + bytes(8), at * 8, len(data) * 8

    def take(self, n: int) -> int:
        p = self.p
        self.p = p + n
        if self.p > self.end:
            raise ValueError("end of data")
        return int.from_bytes(self.data[p >> 3 : (p + n + 7) >> 3], "big") >> (-(p + n) & 7) & ((1 << n) - 1)

    def signed(self, n: int) -> int:
        v = self.take(n)
        return v - (1 << n) if n and v >> (n - 1) else v

    def rice(self, n: int, k: int) -> np.ndarray:
        """n numbers, each a quotient in unary and k bits, folded so that even ones are not negative."""
        data, p, mask, out = self.data, self.p, (1 << k) - 1, []
        for _ in range(n):
            q = 0
            while not (w := int.from_bytes(data[p >> 3 : (p >> 3) + 5], "big") >> (8 - (p & 7)) & 0xFFFFFFFF):
                q, p = q + 32, p + 32
                if p > self.end:
                    raise ValueError("end of data")
            lead = 32 - w.bit_length()
            p += lead + 1 + k
            out.append((q + lead) << k | (int.from_bytes(data[(p - k) >> 3 : (p + 7) >> 3], "big") >> (-p & 7) & mask))
        self.p = p
        if p > self.end:
            raise ValueError("end of data")
        u = np.array(out, np.int64)
        return (u >> 1) ^ -(u & 1)


def _residual(bits: Bits, block: int, order: int) -> np.ndarray:
    method = bits.take(2)
    if method > 1:
        raise ValueError("unknown residual")
    width, parts = 4 + method, 1 << bits.take(4)
    out = []
    for k in range(parts):
        n = block // parts - (0 if k else order)
        if n < 0 or block % parts:
            raise ValueError("bad partition")
        param = bits.take(width)
        if param == (1 << width) - 1:
            raw = bits.take(5)
            out.append(np.array([bits.signed(raw) for _ in range(n)], np.int64))
        else:
            out.append(bits.rice(n, param))
    return np.concatenate(out)


def _subframe(bits: Bits, block: int, size: int) -> np.ndarray:
    if bits.take(1):
        raise ValueError("bad subframe")
    kind, wasted = bits.take(6), 0
    if bits.take(1):
        wasted = 1
        while not bits.take(1):
            wasted += 1
    size -= wasted
    if kind == 0:
        y = np.full(block, bits.signed(size), np.int64)
    elif kind == 1:
        y = np.array([bits.signed(size) for _ in range(block)], np.int64)
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 8 if kind < 32 else kind - 31
        if order > block:
            raise ValueError("bad order")
        first = [bits.signed(size) for _ in range(order)]
        if kind < 32:
            # The residual is the order-th difference, so it is summed up as often, from the first samples' differences.
            heads = [int(np.diff(first, k)[0]) for k in range(order)]
            y = _residual(bits, block, order)
            for k in reversed(range(order)):
                y = np.cumsum(np.concatenate(([heads[k]], y)))
        else:
            precision, shift = bits.take(4) + 1, bits.signed(5)
            if precision == 16 or shift < 0:
                raise ValueError("bad predictor")
            c = [bits.signed(precision) for _ in range(order)][::-1]
            s = first
            for r in _residual(bits, block, order).tolist():
                s.append((sum(a * b for a, b in zip(c, s[-order:], strict=True)) >> shift) + r)
            y = np.array(s, np.int64)
    else:
        raise ValueError("reserved subframe")
    return y << wasted


def _frame(data: bytes, at: int, own_size: int) -> tuple[np.ndarray, int]:
    """Samples (channel, block) of the frame at a byte, and where the next begins."""
    bits = Bits(data, at)
    if bits.take(15) != 0x7FFC:
        raise ValueError("no frame")
    bits.take(1)
    block, rate, channels, size = bits.take(4), bits.take(4), bits.take(4), bits.take(3)
    bits.take(1)
    lead = bits.take(8)
    while lead & 0xC0 == 0xC0:  # the frame's number, as long as its first byte has leading ones
        bits.take(8)
        lead = lead << 1 & 0xFF
    if block == 6 or block == 7:
        block = bits.take(8 * (block - 5)) + 1
    else:
        block = 192 if block == 1 else 576 << (block - 2) if 2 <= block <= 5 else 256 << (block - 8) if block >= 8 else 0
    bits.take({12: 8, 13: 16, 14: 16}.get(rate, 0))
    if bits.take(8) != crc8(data[at : bits.p // 8 - 1]) or not block or channels > 10:
        raise ValueError("bad frame")
    size = SIZES[size] if size else own_size
    side = {8: 1, 9: 0, 10: 1}.get(channels)
    y = [_subframe(bits, block, size + (c == side)) for c in range(channels + 1 if side is None else 2)]
    end = -(-bits.p // 8)
    if int.from_bytes(data[end : end + 2], "big") != crc16(data[at:end]) or end + 2 > len(data):
        raise ValueError("bad checksum")
    if channels == 8:
        y[1] = y[0] - y[1]
    elif channels == 9:
        y[0] = y[0] + y[1]
    elif channels == 10:
        mid = y[0] << 1 | y[1] & 1
        y = [(mid + y[1]) >> 1, (mid - y[1]) >> 1]
    return np.array(y), end + 2


def info(content: bytes) -> tuple[int, int, int, int, bytes, int]:
    """(rate, channels, bits a sample, samples, MD5 of the samples, where frames begin); samples are 0 where not given."""
    if content[:4] != MAGIC or len(content) < 42 or content[4] & 0x7F:
        raise ValueError("no FLAC")
    v = int.from_bytes(content[18:26], "big")
    at, last = 4, 0
    while not last:
        if at + 4 > len(content):
            raise ValueError("end of data")
        last, at = content[at] >> 7, at + 4 + int.from_bytes(content[at + 1 : at + 4], "big")
    return v >> 44, (v >> 41 & 7) + 1, (v >> 36 & 31) + 1, v & ((1 << 36) - 1), content[26:42], at


def duration(content: bytes) -> float | None:
    """Seconds the header says; None where it says none or can't be read."""
    try:
        rate, _, _, samples, _, _ = info(content)
    except ValueError:
        return None
    return samples / rate if rate and samples else None


def decode(content: bytes) -> tuple[np.ndarray, int, int]:
    """Samples (channel, place) as whole numbers, the rate, and bits a sample. Checksums of frames, and the MD5 where it is given, must hold."""
    rate, channels, size, samples, md5, at = info(content)
    blocks, n = [np.zeros((channels, 0), np.int64)], 0
    while at < len(content) and not (samples and n >= samples):
        y, at = _frame(content, at, size)
        if len(y) != channels:
            raise ValueError("channels change")
        blocks.append(y)
        n += y.shape[1]
    y = np.concatenate(blocks, axis=1)
    if samples and y.shape[1] != samples:
        raise ValueError("samples missing")
    if any(md5):
        width = (size + 7) // 8
        raw = y.T.astype("<i4").reshape(-1, 1).view(np.uint8)[:, :width]
        if hashlib.md5(raw.tobytes()).digest() != md5:
            raise ValueError("bad MD5")
    return y, rate, size


def read(content: bytes) -> tuple[np.ndarray, int]:
    """Samples in [-1, 1], channels averaged, and the rate."""
    y, rate, size = decode(content)
    return (y.mean(axis=0) / (1 << (size - 1))).astype(np.float32), rate


def _number(n: int) -> bytes:
    """A frame's number, coded as UTF-8 codes a character."""
    if n < 0x80:
        return bytes([n])
    k = 2
    while n >= 1 << (5 * k + 1):
        k += 1
    return bytes([(0xFF << (8 - k) & 0xFF) | n >> 6 * (k - 1), *[0x80 | n >> 6 * j & 0x3F for j in range(k - 2, -1, -1)]])


def _coded(y: np.ndarray) -> np.ndarray:
    """Bits of a subframe: the fixed predictor of least residual, one partition, the Rice parameter of least length."""
    orders = range(min(4, len(y) - 1) + 1)
    order = min(orders, key=lambda k: int(np.abs(np.diff(y, k)).sum()))
    r = np.diff(y, order)
    u = np.where(r >= 0, 2 * r, -2 * r - 1)
    k = min(range(15), key=lambda k: int((u >> k).sum()) + len(u) * (k + 1))
    head = [0, *_binary(8 + order, 6), 0, *[b for v in y[:order] for b in _binary(int(v) & 0xFFFF, 16)], *_binary(0, 6), *_binary(k, 4)]
    q = u >> k
    ends = np.cumsum(q + 1 + k)
    body = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    body[ends - k - 1] = 1
    for j in range(k):
        body[ends - 1 - j] = u >> j & 1
    return np.concatenate((np.array(head, np.uint8), body))


def _binary(v: int, n: int) -> list[int]:
    return [v >> j & 1 for j in range(n - 1, -1, -1)]


def write(y: np.ndarray, rate: int = 16_000) -> bytes:
    """A mono 16-bit FLAC of samples in [-1, 1]."""
    whole = np.round(np.clip(np.asarray(y, np.float64), -1, 1 - 1 / 32768) * 32768).astype(np.int64)
    head = BLOCK.to_bytes(2, "big") * 2 + bytes(6) + (rate << 44 | 15 << 36 | len(whole)).to_bytes(8, "big") + hashlib.md5(whole.astype("<i2").tobytes()).digest()
    out = [MAGIC, b"\x80" + len(head).to_bytes(3, "big"), head]
    for k, at in enumerate(range(0, len(whole), BLOCK)):
        block = whole[at : at + BLOCK]
        frame = b"\xff\xf8\x70\x08" + _number(k) + (len(block) - 1).to_bytes(2, "big")
        frame += bytes([crc8(frame)]) + np.packbits(_coded(block)).tobytes()
        out.append(frame + crc16(frame).to_bytes(2, "big"))
    return b"".join(out)
