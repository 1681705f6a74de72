"""Media columns: FLAC streams of 8-bit mono samples, written and read with numpy over many frames at once.

`encoded` stores the bytes of a binary column as samples (byte - 128) in frames of 576. Each frame takes the cheapest of a
constant, verbatim samples, the best fixed predictor of order 0 to 4, and a linear predictor of its own, both with
Rice-coded residuals; verbatim samples also stay where a predictor would save less than a twentieth of them. A seek table has the
byte offset of every frame. `decoded` parses the streams, decodes all frames that the seek tables name in step (one
sample of each frame at a time, residuals and predictors alike), goes on from a frame's end where no seek point
stands, verifies the header's CRC-8, the frame's CRC-16, the sample count and the MD5 of the samples, and writes PCM
blocks with the offset of their first sample, and features of the samples.

Results: null bytes are stored like none: a stream without frames, no blocks. Equal bytes give equal streams. The
decoder reads mono streams of 4 to 16 bits with constant, verbatim, fixed and linear-predictive subframes, escaped
partitions and either Rice method; wasted bits and more channels are an error, as is any damaged stream.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from terrane.llm.arrow import extend

BLOCK = 576
RATE = 8000
#: Frames of one PCM block.
BLOCK_FRAMES = 64
#: Seek points of a table at most: its size has 24 bits, a point 18 bytes.
MOST_POINTS = ((1 << 24) - 1) // 18
#: Bytes of samples or streams that are worked on together.
BATCH_BYTES = 2 << 20
#: Order of the encoder's linear predictors, and bits of a coefficient.
ORDER, COEF_BITS = 6, 9
#: A predictor must save this part of what verbatim samples take: a table that holds the streams compresses text kept
#: verbatim once more, but hardly Rice codes.
LEAST_SAVED = 1 / 20
#: Fixed values of the format: the fixed predictors, and block sizes by code.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))
SEEK_POINT = [("s", ">u8"), ("o", ">u8"), ("n", ">u2")]
SIZES = np.array([0, 192, 576, 1152, 2304, 4608, 0, 0, 256, 512, 1024, 2048, 4096, 8192, 16384, 32768])


@lru_cache(maxsize=2)
def _crc_table(poly: int, bits: int, length: int) -> np.ndarray:
    """table[d, b]: the CRC of byte b with d zero bytes after it. A CRC is the XOR of these over its bytes."""
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    one = np.arange(256, dtype=np.uint32) << (bits - 8)
    for _ in range(8):
        one = np.where(one & top, (one << 1) ^ poly, one << 1) & mask
    rows = [one]
    for _ in range(length - 1):
        rows.append(((rows[-1] << 8) & mask) ^ one[rows[-1] >> (bits - 8)])
    return np.array(rows, dtype=np.uint16)


def _crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, poly: int, bits: int) -> np.ndarray:
    """The CRC of each data[start:end]; ranges must not be empty."""
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    table = _crc_table(poly, bits, 1 << int(sizes.max() - 1).bit_length())
    back = np.repeat(sizes, sizes) - 1 - at
    return np.bitwise_xor.reduceat(table[back, data[np.repeat(starts, sizes) + at]], first)


def _numbered(n: int) -> bytes:
    """A frame number in the format's extension of UTF-8."""
    if n < 128:
        return bytes([n])
    tail = []
    room = 6
    while n >= 1 << room:
        tail.append(0x80 | n & 63)
        n >>= 6
        room -= 1
    return bytes([(0xFF << (room + 1)) & 0xFF | n, *reversed(tail)])


@lru_cache(maxsize=1 << 16)
def _header(number: int, size: int) -> bytes:
    code, extra = (2, b"") if size == BLOCK else (7, struct.pack(">H", size - 1))
    raw = bytes([0xFF, 0xF8, code << 4, 1 << 1]) + _numbered(number) + extra
    crc = 0
    for b in raw:
        crc = int(_crc_table(0x07, 8, 1)[0][crc ^ b])
    return raw + bytes([crc])


def _residuals(x: np.ndarray, coefs, shift=0) -> np.ndarray:
    """What the predictor leaves of each row after its first samples; coefficients and shifts are numbers or columns."""
    guess = np.zeros_like(x[:, len(coefs) :])
    for j, c in enumerate(coefs):
        guess += c * x[:, len(coefs) - 1 - j : x.shape[1] - 1 - j]
    return x[:, len(coefs) :] - (guess >> shift)


def _predictors(x: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """A linear predictor for each row (none all zeros): whole coefficients (order x rows) and their shifts.

    Levinson and Durbin's recursion on autocorrelations, which are whole numbers below 2**24 and so exact in any order of
    adding; the recursion works on single elements. So equal frames get equal predictors everywhere.
    """
    w = x.astype(np.float32)
    r = [np.einsum("ij,ij->i", w[:, lag:], w[:, : w.shape[1] - lag]).astype(np.float64) for lag in range(order + 1)]
    a: list[np.ndarray] = []
    left = r[0]
    for i in range(order):
        k = r[i + 1].copy()
        for j in range(i):
            k -= a[j] * r[i - j]
        k = np.clip(k / np.maximum(left, 1e-6), -1, 1)
        a = [a[j] - k * a[i - 1 - j] for j in range(i)] + [k]
        left = left * (1 - k * k)
    found = np.array(a)
    shift = np.clip(COEF_BITS - 1 - np.frexp(np.abs(found).max(axis=0))[1], 0, COEF_BITS).astype(np.int32)
    most = (1 << (COEF_BITS - 1)) - 1
    return np.clip(np.rint(np.ldexp(found, shift)), -most, most).astype(np.int32), shift


def _rice(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Residuals folded to whole numbers from 0, and for each row the Rice parameter of the least bits, and these bits."""
    u = (r << 1) ^ (r >> 31)
    if not len(u):
        return u, np.zeros(0, np.int64), np.zeros(0, np.int64)
    guess = np.log2(np.maximum(1, u.mean(axis=1))).astype(np.int64)
    best, least = guess, np.full(len(u), 1 << 30)
    for step in (-1, 0, 1):
        k = np.clip(guess + step, 0, 14)
        bits = (u >> k[:, None]).sum(axis=1) + u.shape[1] * (1 + k)
        best, least = np.where(bits < least, k, best), np.minimum(bits, least)
    return u, best, least


def encode_many(payloads: list[bytes], linear: tuple[tuple[int, ...], int] | None = None, seek_every: int = 1) -> list[bytes]:
    """A FLAC stream of each payload. `linear` (coefficients, shift): that predictor for all whole frames
    instead of the cheapest; `seek_every`: frames for each seek point (0: no seek table), more where the table could not hold all."""
    whole = [len(p) // BLOCK for p in payloads]
    x = np.frombuffer(b"".join(p[: n * BLOCK] for p, n in zip(payloads, whole)), dtype=np.uint8).reshape(-1, BLOCK).astype(np.int32) - 128
    numbers = [i for n in whole for i in range(n)]
    frames = _encode_frames(x, numbers, linear)
    out, at = [], 0
    for p, n in zip(payloads, whole):
        own, at = frames[at : at + n], at + n
        counts = [BLOCK] * n
        if rest := p[n * BLOCK :]:
            raw = _header(n, len(rest)) + b"\x02" + (np.frombuffer(rest, np.uint8) ^ 128).tobytes()
            crc = int(_crcs(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]), 0x8005, 16)[0])
            own, counts = [*own, raw + struct.pack(">H", crc)], [*counts, len(rest)]
        sizes = [len(f) for f in own]
        md5 = hashlib.md5((np.frombuffer(p, np.uint8) ^ 128).tobytes()).digest() if p else bytes(16)
        info = struct.pack(">HH", BLOCK, BLOCK) + min(sizes, default=0).to_bytes(3, "big") + max(sizes, default=0).to_bytes(3, "big")
        info += (RATE << 44 | 7 << 36 | len(p)).to_bytes(8, "big") + md5
        points = b""
        if own and seek_every:
            every = max(seek_every, -(-len(own) // MOST_POINTS))
            offsets = np.cumsum([0, *sizes[:-1]])[::every]
            table = np.zeros(len(offsets), dtype=SEEK_POINT)
            table["s"], table["o"], table["n"] = np.arange(0, len(own), every) * BLOCK, offsets, counts[::every]
            points = table.tobytes()
            points = b"\x83" + len(points).to_bytes(3, "big") + points
        out.append(b"fLaC" + (b"\x00" if points else b"\x80") + len(info).to_bytes(3, "big") + info + points + b"".join(own))
    return out


def _encode_frames(x: np.ndarray, numbers: list[int], linear: tuple[tuple[int, ...], int] | None) -> list[bytes]:
    if not len(x):
        return []
    n = len(x)
    heads = [_header(i, BLOCK) for i in numbers]
    head = np.array([len(h) for h in heads])
    constant = (x == x[:, :1]).all(axis=1)
    kind = np.where(constant, 0, 1)
    body = np.where(constant, 8, 8 * BLOCK if linear is None else 1 << 30)
    rice = np.zeros(n, dtype=np.int64)
    codes: list[tuple[int, np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]] = []

    def offer(rows: np.ndarray, r: np.ndarray, code: int, order: int, coefs: np.ndarray | None = None, shift: np.ndarray | None = None) -> None:
        """Take this predictor for the rows where it needs fewer bits than what they have."""
        u, k, bits = _rice(r)
        bits += 8 * order + 10 + (0 if coefs is None else 9 + COEF_BITS * order)
        less = bits < np.where(kind[rows] == 1, body[rows] * (1 - LEAST_SAVED), body[rows])
        own = rows[less]
        kind[own], body[own], rice[own] = code, bits[less], k[less]
        codes.append((code, own, u[less], None if coefs is None else coefs[:, less], None if shift is None else shift[less]))

    if linear is None:
        # The order of the least mean magnitude, then the parameter of the least bits.
        found = [_residuals(x, c) for c in FIXED]
        order = np.argmin([np.abs(r).mean(axis=1) for r in found], axis=0)
        for o, r in enumerate(found):
            rows = np.flatnonzero((order == o) & ~constant)
            offer(rows, r[rows], 8 + o, o)
        del found
    rows = np.flatnonzero(~constant)
    if len(rows):
        if linear is None:
            coefs, shift = _predictors(x[rows], ORDER)
        else:
            coefs, shift = np.repeat(np.array(linear[0], np.int32)[:, None], len(rows), axis=1), np.full(len(rows), linear[1], np.int32)
        offer(rows, _residuals(x[rows], coefs[:, :, None], shift[:, None]), 31 + len(coefs), len(coefs), coefs, shift)
    size = head + 1 + -(-body // 8) + 2
    ends = np.cumsum(size)
    starts = ends - size
    out = np.zeros(int(ends[-1]), dtype=np.uint8)
    at = np.repeat(starts, head) + (np.arange(int(head.sum())) - np.repeat(np.cumsum(head) - head, head))
    out[at] = np.frombuffer(b"".join(heads), dtype=np.uint8)
    sub = starts + head
    out[sub] = kind << 1
    rows = np.flatnonzero(constant)
    out[sub[rows] + 1] = x[rows, 0] & 255
    rows = np.flatnonzero(kind == 1)
    out[(sub[rows] + 1)[:, None] + np.arange(BLOCK)] = x[rows] & 255
    bits = np.zeros(len(out) * 8, dtype=np.uint8)
    for code, rows, u, coefs, shift in codes:
        keep = kind[rows] == code  # the others have got a better one since
        rows, u = rows[keep], u[keep]
        if not len(rows):
            continue
        o = code - 8 if coefs is None else len(coefs)
        for j in range(o):
            out[sub[rows] + 1 + j] = x[rows, j] & 255
        p = (sub[rows] + 1 + o) * 8

        def put(p: np.ndarray, value, width: int) -> np.ndarray:
            for j in range(width):
                bits[p + j] = value >> (width - 1 - j) & 1
            return p + width

        if coefs is not None:
            p = put(put(p, COEF_BITS - 1, 4), shift[keep], 5)
            for c in coefs[:, keep]:
                p = put(p, c, COEF_BITS)
        k = rice[rows]
        p = put(put(p, 0, 6), k, 4)
        for each in np.unique(k).tolist():
            own = np.flatnonzero(k == each)
            q = u[own] >> each
            end = p[own][:, None] + np.cumsum(q + (1 + each), axis=1)
            stop = end - (1 + each)
            bits[stop] = 1
            for j in range(each):
                bits[stop + 1 + j] = u[own] >> (each - 1 - j) & 1
    out |= np.packbits(bits)
    crc = _crcs(out, starts, ends - 2, 0x8005, 16)
    out[ends - 2], out[ends - 1] = crc >> 8, crc & 255
    raw = out.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


class Damaged(ValueError):
    """A stream that breaks the format or fails a check."""


def _need(ok, what: str) -> None:
    if not np.all(ok):
        raise Damaged(what)


class _Bits:
    """Reading bits at many places of one buffer at once."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate((data, np.zeros(16, dtype=np.uint8))).astype(np.uint64)
        n = len(data) + 8
        self.words = np.zeros(n, dtype=np.uint64)
        for j in range(8):
            self.words |= padded[j : j + n] << np.uint64(56 - 8 * j)

    def window(self, p: np.ndarray) -> np.ndarray:
        """57 bits at least from p on, at the top of a 64-bit word."""
        return self.words[np.minimum(p >> 3, len(self.words) - 1)] << (p & 7).astype(np.uint64)

    def take(self, p: np.ndarray, width: np.ndarray | int) -> np.ndarray:
        width = np.asarray(width)
        return (self.window(p) >> np.uint64(1) >> (63 - width).astype(np.uint64)).astype(np.int64)

    def signed(self, p: np.ndarray, width: np.ndarray | int) -> np.ndarray:
        v, width = self.take(p, width), np.asarray(width)
        return np.where(width > 0, v - ((v >> np.maximum(width - 1, 0) & 1) << width), 0)

    def zeros(self, p: np.ndarray) -> np.ndarray:
        """The number of zero bits before the next one."""
        top = (self.window(p) >> np.uint64(32)).astype(np.float64)
        q = 32 - np.frexp(top)[1].astype(np.int64)
        more = np.flatnonzero(top == 0)
        q[more] = 32
        while len(more):
            at = p[more] + q[more]
            _need(at >> 3 < len(self.words) - 1, "a residual runs over the end")
            top = (self.window(at) >> np.uint64(32)).astype(np.float64)
            q[more] += np.where(top == 0, 32, 32 - np.frexp(top)[1].astype(np.int64))
            more = more[top == 0]
        return q


def decode_frames(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Ends, samples and numbers of the frames at `starts`; each frame's CRCs are verified."""
    bits = _Bits(data)
    b = lambda i: data[np.minimum(i, len(data) - 1)].astype(np.int64)
    _need((b(starts) == 0xFF) & (b(starts + 1) & 0xFE == 0xF8), "no frame where one should be")
    size_code, rate_code, third = b(starts + 2) >> 4, b(starts + 2) & 15, b(starts + 3)
    _need(third >> 4 == 0, "more than one channel")
    lead = b(starts + 4)
    more = np.where(lead < 128, 0, 7 - np.frexp((~lead & 255).astype(np.float64))[1])
    number = np.where(lead < 128, lead, lead & (63 >> more))
    for j in range(6):
        number = np.where(more > j, number << 6 | b(starts + 5 + j) & 63, number)
    at = starts + 5 + more
    size = SIZES[size_code]
    size = np.where(size_code == 6, b(at) + 1, np.where(size_code == 7, (b(at) << 8 | b(at + 1)) + 1, size))
    at = at + np.where(size_code == 6, 1, np.where(size_code == 7, 2, 0)) + np.where(rate_code == 12, 1, np.where((rate_code == 13) | (rate_code == 14), 2, 0))
    _need(size > 0, "a block size is reserved")
    _need(_crcs(data, starts, at, 0x07, 8) == b(at), "a header fails its CRC-8")
    kind = b(at + 1)
    _need(kind & 0x81 == 0, "wasted bits, or a subframe without its zero bit")
    kind >>= 1
    p = (at + 2) * 8
    samples: list[np.ndarray | None] = [None] * len(starts)
    ends = np.zeros(len(starts), dtype=np.int64)
    groups: dict[tuple[int, int], list[int]] = {}
    for i, key in enumerate(zip(kind.tolist(), size.tolist())):
        groups.setdefault(key, []).append(i)
    for (k, n), rows in groups.items():
        own = np.array(rows)
        q = p[own]
        if k == 0:
            x = np.repeat(bits.signed(q, depth)[:, None], n, axis=1)
            q = q + depth
        elif k == 1:
            x = np.stack([bits.signed(q + depth * j, depth) for j in range(n)], axis=1)
            q = q + depth * n
        elif 8 <= k <= 12 or k >= 32:
            x, q = _predicted(bits, q, n, k - 8 if k < 32 else k - 31, k >= 32, depth)
        else:
            raise Damaged("a subframe type is reserved")
        ends[own] = -(-q // 8) + 2
        for i, row in zip(rows, x):
            samples[i] = row
    _need(ends <= len(data), "a frame runs over the end")
    _need(_crcs(data, starts, ends - 2, 0x8005, 16) == (b(ends - 2) << 8 | b(ends - 1)), "a frame fails its CRC-16")
    return ends, samples, number


def _predicted(bits: _Bits, p: np.ndarray, n: int, order: int, linear: bool, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Samples (frames x n) of fixed or linear-predictive subframes of one order, and where they end."""
    _need(n >= order, "a block is shorter than its predictor")
    x = np.zeros((n, len(p)), dtype=np.int64)  # one row a sample, of all frames
    for j in range(order):
        x[j] = bits.signed(p, depth)
        p = p + depth
    if linear:
        width = bits.take(p, 4) + 1
        shift = bits.signed(p + 4, 5)
        _need((shift >= 0) & (width < 16), "a predictor is invalid")
        p = p + 9
        coefs = np.zeros((order, len(p)), dtype=np.int64)
        for j in range(order):
            coefs[j] = bits.signed(p, width)
            p = p + width
    else:
        coefs = np.array(FIXED[order], dtype=np.int64)[:, None] if order else np.zeros((0, 1), np.int64)
        shift = 0
    method, parts = bits.take(p, 2), bits.take(p + 2, 4)
    _need(method < 2, "a residual method is reserved")
    p = p + 6
    for pair in {*zip(method.tolist(), parts.tolist())}:
        own = np.flatnonzero((method == pair[0]) & (parts == pair[1]))
        wide, each = 4 + pair[0], n >> pair[1]
        _need((n % (1 << pair[1]) == 0) & (each >= order), "a partition is invalid")
        at, q = order, p[own]
        for part in range(1 << pair[1]):
            k = bits.take(q, wide)
            q = q + wide
            raw = k == (1 << wide) - 1
            if raw.any():
                width = np.where(raw, bits.take(q, 5), 0)
                q = q + 5 * raw
            for _ in range(each - (order if part == 0 else 0)):
                stop = bits.zeros(q)
                rest = q + stop + 1
                u = stop << k | bits.take(rest, k)
                v = (u >> 1) ^ -(u & 1)
                if raw.any():
                    v = np.where(raw, bits.signed(q, width), v)
                    q = np.where(raw, q + width, rest + k)
                else:
                    q = rest + k
                x[at, own] = v
                at += 1
        p[own] = q
    if order:
        for t in range(order, n):
            x[t] += (coefs * x[t - order : t][::-1]).sum(axis=0) >> shift
    return x.T, p


def _metadata(s: bytes) -> tuple[dict, np.ndarray, int]:
    """What STREAMINFO says, the seek points (without placeholders), and where the frames begin."""
    _need(s[:4] == b"fLaC", "not a FLAC stream")
    at, last, info, points = 4, False, b"", np.zeros(0, dtype=SEEK_POINT)
    while not last:
        _need(len(s) >= at + 4, "a stream ends in its metadata")
        last, kind, n = s[at] >> 7, s[at] & 127, int.from_bytes(s[at + 1 : at + 4], "big")
        body, at = s[at + 4 : at + 4 + n], at + 4 + n
        if kind == 0:
            info = body
        elif kind == 3:
            points = np.frombuffer(body, dtype=SEEK_POINT)
            points = points[points["s"] != np.uint64(2**64 - 1)]
    _need(len(info) == 34, "a stream lacks its STREAMINFO")
    word = int.from_bytes(info[10:18], "big")
    _need((word >> 41 & 7) == 0, "more than one channel")
    return {"depth": (word >> 36 & 31) + 1, "total": word & (1 << 36) - 1, "md5": info[18:34], "frames": {}}, points, at


def samples_from(stream: bytes, first: int, count: int) -> np.ndarray:
    """Samples `first` to `first + count` (fewer at the stream's end), read from the last seek point before them: no
    frame before that point is decoded."""
    info, points, begin = _metadata(stream)
    stop = min(first + count, info["total"])
    if first >= stop:
        return np.zeros(0, dtype=np.int64)
    before = points[points["s"] <= np.uint64(first)]
    start, at = (int(before["s"][-1]), begin + int(before["o"][-1])) if len(before) else (0, begin)
    data, parts, end = np.frombuffer(stream, dtype=np.uint8), [], start
    while end < stop:
        _need(at < len(stream), "a stream ends before its last sample")
        ends, samples, _ = decode_frames(data, np.array([at]), info["depth"])
        parts.append(samples[0])
        at, end = int(ends[0]), end + len(samples[0])
    return np.concatenate(parts)[first - start : stop - start]


def decode_many(streams: list[bytes]) -> list[tuple[np.ndarray, int]]:
    """Samples and bits a sample of each stream."""
    infos, starts, owner, base = [], [], [], 0
    for i, s in enumerate(streams):
        info, points, at = _metadata(s)
        infos.append(info)
        if len(s) > at:
            known = np.unique(np.concatenate(([0], points["o"].astype(np.int64)))) + base + at
            starts += known.tolist()
            owner += [i] * len(known)
        base += len(s)
    data = np.frombuffer(b"".join(streams), dtype=np.uint8)
    limits = np.cumsum([len(s) for s in streams])
    known = set(starts)
    at, own = np.array(starts, dtype=np.int64), np.array(owner, dtype=np.int64)
    depths = np.array([f["depth"] for f in infos])
    while len(at):  # frames at seek points first, then those behind them
        ends = np.zeros(len(at), dtype=np.int64)
        for depth in np.unique(depths[own]).tolist():
            part = np.flatnonzero(depths[own] == depth)
            ends[part], samples, _ = decode_frames(data, at[part], depth)
            for i, a, x in zip(own[part].tolist(), at[part].tolist(), samples):
                infos[i]["frames"][a] = x
        _need(ends <= limits[own], "a frame runs over the end of its stream")
        go = [(e, o) for e, o in zip(ends.tolist(), own.tolist()) if e < limits[o] and e not in known]
        known.update(e for e, _ in go)
        at, own = np.array([e for e, _ in go], dtype=np.int64), np.array([o for _, o in go], dtype=np.int64)
    out = []
    for f in infos:
        parts = [f["frames"][a] for a in sorted(f["frames"])]
        x = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        _need(len(x) == f["total"] or f["total"] == 0 and not parts, "the samples are not as many as the stream says")
        if parts and any(f["md5"]):
            _need(hashlib.md5(x.astype("<i1" if f["depth"] <= 8 else "<i2").tobytes()).digest() == f["md5"], "the samples fail their MD5")
        out.append((x, f["depth"]))
    return out


def features(x: np.ndarray) -> str:
    """samples:sum:sum of squares:lowest:highest:sign changes."""
    if not len(x):
        return "0:0:0:0:0:0"
    return f"{len(x)}:{int(x.sum())}:{int((x * x).sum())}:{int(x.min())}:{int(x.max())}:{int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))}"


def encoded(df: DataFrame, payload: str, media: str = "media") -> DataFrame:
    """Add the binary column `media`: the FLAC stream of the bytes of `payload`."""

    def make():
        return lambda piece: [encode_many([p or b"" for p in piece.column(payload).to_pylist()])]

    return extend(df, payload, [T.StructField(media, T.BinaryType(), False)], make, BATCH_BYTES)


def decoded(df: DataFrame, media: str = "media") -> DataFrame:
    """Add `blocks`, an array of (first_sample, pcm), and `feature`, from the streams of `media` (null: neither).

    Samples of 8 bits or less become bytes (sample + 128), others little-endian 16-bit integers.
    """
    block = T.StructType([T.StructField("first_sample", T.LongType(), False), T.StructField("pcm", T.BinaryType(), False)])

    def make():
        def work(piece: pa.RecordBatch) -> list:
            streams = piece.column(media).to_pylist()
            got = iter(decode_many([s for s in streams if s is not None]))
            blocks, said = [], []
            for s in streams:
                if s is None:
                    blocks.append(None)
                    said.append(None)
                    continue
                x, depth = next(got)
                pcm = (x + 128).astype(np.uint8).tobytes() if depth <= 8 else x.astype("<i2").tobytes()
                each = BLOCK * BLOCK_FRAMES
                width = 1 if depth <= 8 else 2
                blocks.append([{"first_sample": a, "pcm": pcm[a * width : (a + each) * width]} for a in range(0, len(x), each)])
                said.append(features(x))
            return [blocks, said]

        return work

    fields = [T.StructField("blocks", T.ArrayType(block, False), True), T.StructField("feature", T.StringType(), True)]
    return extend(df, media, fields, make, BATCH_BYTES)
