"""FLAC streams against a plain decoder, which reads bit by bit, and against a stream of the format's document."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from terrane.llm import flac, queries

#: The third example stream of the format's document (RFC 9639), and its samples.
EXAMPLE = bytes.fromhex(
    "664c6143800000221000100000001f00001f07d0007000000018f8f9e396f5cbcfc6dc807f9977906b32"
    "fff868020017e944004f6f313d1047d227cb6d090831452bdc2822228057a3"
)
SAMPLES = [0, 79, 111, 78, 8, -61, -90, -68, -13, 42, 67, 53, 13, -27, -46, -38, -12, 14, 24, 19, 6, -4, -5, 0]
FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]


def plain_decode(stream):
    """Samples and the kinds of subframes of a mono stream of 8 bits."""
    at, last = 4, 0
    while not last:
        last, at = stream[at] >> 7, at + 4 + int.from_bytes(stream[at + 1 : at + 4], "big")
    samples, kinds = [], []
    while at < len(stream):
        pos = at * 8

        def take(n):
            nonlocal pos
            first, end = pos // 8, (pos + n + 7) // 8
            pos += n
            return int.from_bytes(stream[first:end], "big") >> (end * 8 - pos) & ((1 << n) - 1)

        def signed(n):
            v = take(n)
            return v - (1 << n) if v >> (n - 1) else v

        def unary():
            n = 0
            while not take(1):
                n += 1
                assert pos < len(stream) * 8
            return n

        assert take(15) == 0x7FFC
        take(1)
        size_code, rate_code = take(4), take(4)
        assert take(4) == 0
        take(4)
        lead = take(8)
        while lead & 0x80 and (lead := lead << 1 & 0xFF) & 0x80:
            take(8)
        size = {2: 576}.get(size_code) or take(8 if size_code == 6 else 16) + 1
        take({12: 8, 13: 16, 14: 16}.get(rate_code, 0))
        take(8)
        kind = take(8) >> 1
        kinds.append(kind)
        if kind == 0:
            x = [signed(8)] * size
        elif kind == 1:
            x = [signed(8) for _ in range(size)]
        else:
            order = kind - 31 if kind >= 32 else kind - 8
            x = [signed(8) for _ in range(order)]
            coefs, shift = FIXED[order] if kind < 32 else None, 0
            if coefs is None:
                width, shift = take(4) + 1, signed(5)
                coefs = [signed(width) for _ in range(order)]
            wide = 4 + take(2)
            parts = 1 << take(4)
            for part in range(parts):
                k = take(wide)
                raw = take(5) if k == (1 << wide) - 1 else None
                for _ in range(size // parts - (order if part == 0 else 0)):
                    u = unary() << k | take(k) if raw is None else 0
                    r = u >> 1 ^ -(u & 1) if not raw else signed(raw)
                    x.append(r + (sum(c * v for c, v in zip(coefs, x[::-1])) >> shift))
        samples += x
        at = -(-pos // 8) + 2
    return samples, kinds


def test_the_document_s_stream():
    assert plain_decode(EXAMPLE) == (SAMPLES, [34])
    assert flac.decode_many([EXAMPLE])[0][0].tolist() == SAMPLES
    assert flac.samples_from(EXAMPLE, 20, 9).tolist() == SAMPLES[20:]


def payloads():
    rng = random.Random(3)
    words = " ".join(rng.choice(["tree", "house", "of", "and", "water", "xylophone", "1984", "é"]) for _ in range(800)).encode()
    wave = bytes(int(128 + 60 * np.sin(i / 9) + 50 * np.sin(i / 5.3) + rng.randrange(3)) for i in range(576 * 4))
    return [words, wave, b"", b"x" * 1000, bytes(rng.randrange(256) for _ in range(1500)), bytes(i % 256 for i in range(1152))]


def test_streams_by_the_plain_decoder():
    kinds = Counter()
    for payload, stream in zip(payloads(), flac.encode_many(payloads())):
        x, seen = plain_decode(stream)
        assert bytes(v + 128 for v in x) == payload
        kinds.update(seen)
    assert kinds[31 + flac.ORDER] > 5 and kinds[0] and kinds[1] and any(kinds[8 + o] for o in range(5))


def test_each_frame_takes_the_least_bits():
    """No stream is longer than with verbatim samples, and a tone takes far less by its own predictor than by fixed ones."""
    for payload, stream in zip(payloads(), flac.encode_many(payloads(), seek_every=0)):
        assert len(stream) <= 42 + len(payload) + 16 * (len(payload) // 576 + 1)
    tone = bytes(int(128 + 100 * np.sin(i * 1.9)) for i in range(576 * 8))
    assert len(flac.encode_many([tone], seek_every=0)[0]) < 0.75 * len(tone)


@pytest.mark.parametrize("order", [1, 4, 6, 12])
def test_predictors_are_levinson_s(order):
    rng = np.random.default_rng(5)
    x = rng.integers(-128, 128, (20, 576)).astype(np.int32)
    x[:, 1:] = (x[:, 1:] + 2 * x[:, :-1]) // 3
    coefs, shift = flac._predictors(x, order)
    for i, row in enumerate(x.astype(float)):
        r = [row[lag:] @ row[: 576 - lag] for lag in range(order + 1)]
        want = np.linalg.solve([[r[abs(a - b)] for a in range(order)] for b in range(order)], r[1:])
        assert np.abs(coefs[:, i] / 2.0 ** shift[i] - want).max() <= 0.51 / 2.0 ** shift[i] + 1e-9


def test_linear_frames_in_the_query(spark):
    """The query's features by their definition, and frames of linear prediction in its streams."""
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op9_flac(spark, SMALL).select("doc_id", "feature").collect():
        raw = docs[r["doc_id"]]
        x = [b - 128 for b in raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))]
        crossings = sum((a < 0) != (b < 0) for a, b in zip(x, x[1:]))
        assert r["feature"] == f"{len(x)}:{sum(x)}:{sum(v * v for v in x)}:{min(x)}:{max(x)}:{crossings}"
    longest = max(docs.values(), key=len)[: 576 * 40]
    assert 31 + flac.ORDER in plain_decode(flac.encode_many([longest])[0])[1]


def test_a_text_of_twelve_million_bytes(spark):
    raw = (b"A line of a very long text, number %d.\n" * 400_000)[:12_000_000]
    df = spark.createDataFrame([(1, "x")], "i int, t string").withColumn("payload", F.expr("substring(repeat('A line of a very long text, number %d.\n', 400000), 1, 12000000)").cast("binary"))
    back = flac.decoded(flac.encoded(df, "payload")).select("blocks.pcm", F.octet_length("media").alias("n")).first()
    pcm = b"".join(map(bytes, back["pcm"]))
    assert zlib.crc32(pcm) == zlib.crc32(raw) and hashlib.sha256(pcm).digest() == hashlib.sha256(raw).digest()
    assert back["n"] < len(raw)
