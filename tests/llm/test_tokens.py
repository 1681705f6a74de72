"""BPE by merge replay, and packed token files."""

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import SMALL
from tokenizers import Tokenizer

from terrane.llm import bpe, queries, tokenfile
from terrane.llm.pieces import chunks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=400):
    rng = random.Random(7)
    bits = [" ", "  ", "\n", "\t", "\xa0", "\x85", " ", "\x1c", "a", "b", "'s", "'ll", "é", "1", "²", ".", "!!", "aaaa", "abab", " the", "\r\n", "ſ", "<|endoftext|>", "日本", "\U0001f600"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(n)]
    return [*texts, "", " ", "a" * 4000, " " * 500, "ab" * 1500, "word " * 2000]


def test_chunks_join_back():
    texts = [*odd_texts(), None, "x é y", "a\u2028 b", "\u3000 c", "d\xa0 e"]
    for own in (pa.array(texts), pa.array(["lead", None, *texts])[2:]):
        parts, counts = chunks(own)
        ends = np.cumsum(counts)
        parts = parts.to_pylist()
        assert ["".join(parts[e - n : e]) for e, n in zip(ends, counts)] == [t or "" for t in texts]
    for text, cut in (("x é y", ["x", " é", " y"]), ("a\u2028 b", ["a\u2028 b"]), ("\u3000 c", ["\u3000 c"]), ("  a  b", ["  a", "  b"]), ("d\xa0 e", ["d\xa0 e"])):
        assert chunks(pa.array([text]))[0].to_pylist() == cut


def encoded(lexicon, texts):
    ids, cuts = lexicon.encode(pa.array(texts))
    return [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])]


def test_replay_is_tiktoken():
    enc, lexicon = reference(), bpe.lexicon(bpe.Vocabulary(RANKS), public_tokenizers.PATTERN)
    texts = odd_texts()
    for text, ids in zip(texts, encoded(lexicon, texts)):
        assert ids == enc.encode_ordinary(text)


def test_replay_of_a_merge_to_a_lower_rank(tmp_path):
    """A vocabulary in which joining b and c makes a pair of lower rank than theirs."""
    tokens = [bytes([b]) for b in range(256)] + [b"xy", b"abc", b"bc", b"aa", b"aaa"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    vocabulary = bpe.Vocabulary(str(path))
    rng = random.Random(1)
    words = [bytes(rng.choice(b"abcx") for _ in range(rng.randrange(1, 12))) for _ in range(500)]
    enc = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    for w, ids in zip(words, vocabulary.replay(words)):
        assert np.frombuffer(ids, "<u4").tolist() == vocabulary.merge_one(w) == enc.encode_ordinary(w.decode())


def test_query_is_whole(spark):
    enc = reference()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op1_bpe(spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = np.array(enc.encode_ordinary(docs[r["doc_id"]]), dtype="<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "a b", None)], "doc_id long, text string, ids string")
    back = bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"])) for r in back) == [(0, b"a b"), (1, b""), (2, b""), (2, b"")]
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 31, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    data = tokenfile.pack(ids, bits)
    assert len(data) == -(-1000 * bits // 8)
    assert (tokenfile.unpack(data, bits, 1000) == ids).all()
    if bits < 32:
        with pytest.raises(ValueError):
            tokenfile.pack(np.array([1 << bits], dtype=np.uint64), bits)


def test_bits():
    assert [tokenfile.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_random_access(monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 64)
    rng = np.random.default_rng(2)
    docs = [(i if i else None, rng.integers(0, 5000, rng.integers(0, 300)).astype("<u4")) for i in range(40)]
    out = pa.BufferOutputStream()
    writer = tokenfile.Writer(out, 13)
    for d, ids in docs:
        writer.add(d, ids)
    writer.close()
    reader = tokenfile.Reader(pa.BufferReader(out.getvalue()))
    every = np.concatenate([ids for _, ids in docs])
    assert reader.doc_ids == [d for d, _ in docs] and reader.n_ids == len(every)
    for a, b in [(0, 1), (63, 65), (100, 100), (5, len(every)), (len(every) - 1, len(every))]:
        assert (reader.ids(a, b) == every[a:b]).all()
    for (d, ids), (got, _, n, crc) in zip(docs, reader.documents()):
        assert (d, len(ids), zlib.crc32(ids.tobytes())) == (got, n, crc)


def test_file_query(spark):
    tokenizer = Tokenizer.from_file(JSON)
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in queries.op7_tokenfile(spark, SMALL).collect()}
    assert len(got) == len(docs)
    start = 0
    for d, text in docs:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        r = got[d]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_library_on_odd_texts():
    tokenizer = Tokenizer.from_file(JSON)
    mark = "<|endoftext|>"
    texts = [*odd_texts(), mark, f"x {mark} y", f"x  {mark}  y", f"a{mark}b{mark}", f" {mark}\n{mark} c", f"{mark} {mark} {mark}", f"q \n {mark}", f"<|end {mark}of text|>"]
    for text, ids in zip(texts, encoded(tokenfile.lexicon(JSON), texts)):
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
    assert 50256 in encoded(tokenfile.lexicon(JSON), [f"x {mark}"])[0]


def test_other_tokenizer_files_are_refused(tmp_path):
    import json

    with open(JSON, encoding="utf-8") as f:
        described = json.load(f)
    for change in ({"normalizer": {"type": "NFC"}}, {"added_tokens": [{**described["added_tokens"][0], "lstrip": True}]}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(described | change))
        with pytest.raises(ValueError):
            tokenfile.lexicon(str(path))


def test_file_of_repeated_rows_long_texts_and_other_columns(spark):
    tokenizer = Tokenizer.from_file(JSON)
    texts = ["word é " * 60_000, "b", "b", None, "  <|endoftext|> c"]
    df = spark.createDataFrame([(i, t, "z", i) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens long")
    got = {r["doc_id"]: r for r in tokenfile.read_files(tokenfile.write_files(df, JSON, 50257)).collect()}
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert (got[i]["n_tokens"], got[i]["ids_crc32"]) == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))


def test_file_edges(spark):
    df = spark.createDataFrame([(3, None), (None, "x"), (3, "b"), (1, "")], "doc_id long, text string")
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in tokenfile.read_files(tokenfile.write_files(df, JSON, 50257)).collect())
    assert got == [(0, None, 2), (2, 1, 1), (3, 3, 1), (4, 3, 2)]
    assert tokenfile.read_files(tokenfile.write_files(df.limit(0), JSON, 50257)).count() == 0


def test_documents_without_ids_are_many_ranges(spark):
    texts = [f"{i:04d} some words" for i in range(3000)]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(8)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = tokenfile.write_files(df, JSON)
        assert manifest.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    tokenizer = Tokenizer.from_file(JSON)
    got = [(r["n_tokens"], r["ids_crc32"]) for r in tokenfile.read_files(manifest).orderBy("start").collect()]
    for t, (n, crc) in zip(texts, got, strict=True):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        assert (n, crc) == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))


def test_vocabulary_of_the_file():
    assert tokenfile.vocabulary_of(JSON) == 50257
