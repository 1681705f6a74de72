"""Repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL

from terrane.llm import queries, repeats


def brute(texts, least):
    """(start, end) of the covered runs of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + least] for r in raw for i in range(len(r) - least + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - least + 1):
            if seen[r[i : i + least]] > 1:
                gone[i : i + least] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int))))).tolist()
        out.append(list(zip(edges[::2], edges[1::2])))
    return out


def made(seed, least, n=60):
    """Texts of few letters with shared passages, copies, periods and accents."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abé ") for _ in range(k))
    shared = [word(rng.randint(least // 2, 3 * least)) for _ in range(4)]
    texts = [None, "", "ab" * (3 * least), "é" * least]
    for _ in range(n):
        parts = [word(rng.randint(0, 3 * least)) for _ in range(rng.randint(0, 4))]
        texts.append("".join(p + (rng.choice(shared) if rng.random() < 0.5 else "") for p in parts))
    return texts + texts[5:9] + [texts[6][: least + 3]]


@pytest.mark.parametrize("least", [7, 12, 33])
def test_expansion(least):
    for seed in range(6):
        texts = [t.encode() for t in made(seed, least, 12) if t]
        codes = np.concatenate([np.zeros(1, dtype=np.int64), *[np.append(np.frombuffer(t, dtype=np.uint8).astype(np.int64) + 1, 0) for t in texts]])
        hit, at = repeats.repeated(codes, least), 1
        seen = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
        for t in texts:
            assert [bool(x) for x in hit[at : at + max(0, len(t) - least + 1)]] == [seen[t[i : i + least]] > 1 for i in range(len(t) - least + 1)]
            at += len(t) + 1


@pytest.mark.parametrize("least", [9, 40])
def test_contexts_share_starts(least, monkeypatch):
    """Each start stands in one context, and equal strings have one hash; pieces of long texts change nothing of that."""
    texts = [t.encode() for t in made(3, least) if t]
    ends = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    raw = b"".join(texts)
    for piece in (1 << 23, 50):
        monkeypatch.setattr(repeats, "PIECE", piece)
        hashed, first, last = repeats.contexts(np.frombuffer(raw, dtype=np.uint8), ends, least)
        starts = [i for a, b in zip(first, last) for i in range(a, b + 1)]
        assert starts == [i for a, b in zip(ends, ends[1:]) for i in range(a, b - least + 1)]
        of = {}
        for h, a, b in zip(hashed.tolist(), first, last):
            for i in range(a, b + 1):
                assert of.setdefault(raw[i : i + least], h) == h


@pytest.mark.parametrize("seed, least, most, block_bytes", [(1, 12, 4096, 1 << 20), (2, 12, 3, 300), (3, 40, 2, 1 << 20), (4, 40, 4096, 500), (5, 200, 4096, 1 << 20)])
def test_stripped(spark, seed, least, most, block_bytes):
    texts = made(seed, least)
    rows = [(None if i % 9 == 0 else i % 20, t, "k", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, __key int").repartition(3)
    got = repeats.stripped(df, least=least, most=most, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "text", "key", "__key", "removed", "kept"]
    out = {r["__key"]: r for r in got.collect()}
    assert len(out) == len(rows)
    for r, spans in zip(rows, brute(texts, least)):
        mine, raw = out[r[3]], (r[1] or "").encode()
        assert (mine["doc_id"], mine["text"]) == (r[0], r[1])
        assert [tuple(x) for x in mine["removed"]] == spans
        assert bytes(mine["kept"]) == b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(raw)]))


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x" * 250)] * 3 + [(2, "y" * 199)] * 2, "doc_id long, text string")
    assert Counter((r["doc_id"], len(r["kept"])) for r in repeats.stripped(df).collect()) == {(1, 0): 3, (2, 199): 2}
    assert repeats.stripped(df.limit(0)).count() == 0


def test_long_text(spark):
    """One text of 20 MB without a repeat but for its ends."""
    rng = np.random.default_rng(1)
    body = rng.integers(97, 123, 20 << 20, dtype=np.uint8).tobytes().decode()
    df = spark.createDataFrame([(1, body + body[:300])], "doc_id long, text string")
    (row,) = repeats.stripped(df, keep_text=False).collect()
    assert [tuple(x) for x in row["removed"]] == [(0, 300), (20 << 20, (20 << 20) + 300)]


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op11_repeats(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for d, spans in zip(docs, brute([d["text"] for d in docs], 200)):
        raw, r = (d["text"] or "").encode(), got[d["doc_id"]]
        kept = b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(raw)]))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    assert sum(r["n_removed"] for r in got.values()) > 0
