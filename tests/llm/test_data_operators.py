"""Shuffle, neighbours, FLAC, mixing, and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from oracle import connection, same
from pyspark.sql import functions as F

from terrane.llm import flac, hilbert, mixing, queries, shuffle


def test_fisher_yates():
    assert sorted(shuffle.fisher_yates(100, [1, 2]).tolist()) == list(range(100))
    assert shuffle.fisher_yates(100, [1, 2]).tolist() == shuffle.fisher_yates(100, [1, 2]).tolist() != shuffle.fisher_yates(100, [1, 3]).tolist()
    assert shuffle.fisher_yates(0, [1]).tolist() == [] and shuffle.fisher_yates(1, [1]).tolist() == [0]
    orders = Counter(tuple(shuffle.fisher_yates(3, [s]).tolist()) for s in range(6000))
    assert len(orders) == 6 and min(orders.values()) > 850


def test_shuffle_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op5_shuffle(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op5_shuffle(spark, SMALL).collect()))


def test_shuffle_over_many_buckets(spark):
    rows = [(i, "t" * (i % 7), "k") for i in range(300)] + [(1000, "same", "k")] * 200 + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    got = shuffle.shuffled(df, 3, bucket_bytes=200)
    assert got.columns == ["doc_id", "text", "shard", "slot"]
    out = got.collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((a, b) for a, b, _ in rows)
    assert sorted(Counter(r["shard"] for r in out).values()) == [167, 168, 168]
    assert shuffle.shuffled(df.limit(0), 3).count() == 0


@pytest.mark.parametrize("tasks", [50_000, 3])
def test_shuffle_is_two_plain_passes(spark, monkeypatch, tasks):
    """Buckets by hash, each in the order of its rows and then by Fisher-Yates, one after another; heavy equal rows by number."""
    monkeypatch.setattr(shuffle, "MOST_TASKS", tasks)
    rows = [(i % 60, "t" * (i % 9), i // 120) for i in range(240)] + [(7, "same", 1)] * 150 + [(7, "same", 2)] * 50 + [(None, None, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, v int")
    hashed = {}
    for r in df.distinct().select("*", F.xxhash64("doc_id", "text", "v").alias("h")).collect():
        hashed[r["doc_id"], r["text"], r["v"]] = r["h"]
    total = sum(len(t or "") + 1 for _, t, _ in rows)
    buckets = -(-total // 200)
    heavy = {r for r, n in Counter(rows).items() if n * (len(r[1] or "") + 1) > 100}
    keys = spark.createDataFrame([(hashed[r], None if r not in heavy else i) for r, n in Counter(rows).items() for i in range(n)], "h long, i long")
    keyed = keys.select("h", F.pmod(F.when(F.col("i").isNull(), F.xxhash64(F.lit(17), "h")).otherwise(F.xxhash64(F.lit(17), "h", "i")), F.lit(buckets)).alias("b"))
    homes = {(h, b): n for h, b, n in [tuple(r) for r in keyed.groupBy("h", "b").count().collect()]}
    plain, of = [], {h: r for r, h in hashed.items()}
    for b in range(buckets):
        own = sorted(h for (h, c), n in homes.items() if c == b for _ in range(n))
        plain += [of[own[i]] for i in shuffle.fisher_yates(len(own), [17, b])]
    for parts in (1, 5):
        out = shuffle.shuffled(df.repartition(parts), 4, bucket_bytes=200).collect()
        got = {(r["shard"], r["slot"]): (r["doc_id"], r["text"], r["v"]) for r in out}
        assert got == {(i % 4, i // 4): r for i, r in enumerate(plain)}
    assert heavy


def test_shuffle_order_ignores_partitions(spark):
    import datetime
    import decimal

    rows = [(i % 5, "t", datetime.date(2020, 1, 1 + i), decimal.Decimal(i), float(i), bytearray([i])) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, d date, n decimal(5,1), f float, b binary")
    got = [sorted(map(str, shuffle.shuffled(df.repartition(n), 3).collect())) for n in (1, 4)]
    assert got[0] == got[1]


def test_shards_written(spark, tmp_path):
    shuffle.write_shards(spark.createDataFrame([(i, str(i)) for i in range(50)], "doc_id long, text string"), str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 50 and back.select("shard").distinct().count() == 4


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve(dims, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    keys = hilbert.hilbert_index(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute(ids, vectors, asked, k):
    out = {}
    v = np.array(vectors, dtype=np.float64)
    for i in asked:
        s = (v * v[i]).sum(axis=1) / (np.linalg.norm(v, axis=1) * np.linalg.norm(v[i]))
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[ids[i]] = [(ids[j], s[j]) for j in order]
    return out


def test_neighbours_query(spark):
    t = sorted((r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect())
    ids = [a for a, _ in t]
    want = brute(ids, [b for _, b in t], [i for i, a in enumerate(ids) if a % 50 == 0], 5)
    got = {}
    for r in sorted(queries.op6_hilbert(spark, SMALL).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    for q in want:
        assert [a for a, _ in got[q]] == [a for a, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


def test_recall_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "BLOCK_ROWS", 64)
    monkeypatch.setattr(hilbert, "SAMPLE", 600)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 24))
    v = centres[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 24))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    want = brute(np.arange(3000), v, range(0, 3000, 50), 5)
    got = {}
    for r in hilbert.nearest(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(got[q] & {a for a, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_blocks_in_pieces_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(600, 12)))], "vec_id long, embedding array<double>")
    plain = sorted(map(tuple, hilbert.nearest(df, F.col("vec_id") % 50 == 0).collect()))
    monkeypatch.setattr(hilbert, "BLOCK_MOST", 16)
    assert sorted(map(tuple, hilbert.nearest(df, F.col("vec_id") % 50 == 0).collect())) == plain


def test_copies_are_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "id long, v array<double>")
    from pyspark.sql import Window

    plan = df.withColumn("copy", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where("copy <= 6")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_neighbour_edges(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (7, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [float("nan"), 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (10, [0.0, 2.0]), (11, [float("inf"), 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, rank string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in hilbert.nearest(df, F.col("vec_id") % 50 == 0, k=3).collect())
    assert got == [(0, 1, 3, 1.0), (0, 2, 7, 1.0), (0, 3, 50, 1.0), (50, 1, 0, 1.0), (50, 2, 3, 1.0), (50, 3, 7, 1.0)]
    assert hilbert.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    many = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3000)] + [(5000 + i, [float(i), 1.0]) for i in range(2000)], "vec_id long, embedding array<double>")
    one = [r["vec_id"] for r in hilbert.nearest(many, F.col("vec_id") == 100, k=5).orderBy("rank").collect()]
    assert one == [0, 1, 2, 3, 4]


PAYLOADS = [b"", b"\xff" * 576, b"a" * 577, bytes(random.Random(1).randrange(256) for _ in range(4000)), b"hello world " * 300, bytes(576 * 130), bytes(i * 3 % 256 for i in range(576 * 3))]


@pytest.mark.parametrize("options", [{}, {"seek_every": 0}, {"seek_every": 5}, {"linear": ((2, -1), 0)}, {"linear": ((40, -20, 10), 5), "seek_every": 3}])
def test_flac_round_trip(options):
    back = flac.decode_many(flac.encode_many(PAYLOADS, **options))
    assert [(x + 128).astype(np.uint8).tobytes() for x, _ in back] == PAYLOADS


@pytest.mark.parametrize("options", [{}, {"seek_every": 0}, {"seek_every": 5}, {"linear": ((40, -20, 10), 5), "seek_every": 3}])
def test_flac_from_an_offset(options, monkeypatch):
    for payload, stream in zip(PAYLOADS, flac.encode_many(PAYLOADS, **options)):
        for first in (0, 1, 575, 576, 577, 1700, len(payload) - 1, len(payload), len(payload) + 5):
            for count in (0, 1, 600):
                want = payload[first : first + count] if first >= 0 else b""
                if first >= 0:
                    assert (flac.samples_from(stream, first, count) + 128).astype(np.uint8).tobytes() == want
    # With a point for every frame a read decodes but the frames that it needs.
    calls, plain = [], flac.decode_frames
    monkeypatch.setattr(flac, "decode_frames", lambda *a: calls.append(1) or plain(*a))
    flac.samples_from(flac.encode_many(PAYLOADS)[5], 576 * 100 + 3, 576)
    assert len(calls) == 2


def test_flac_seek_table_has_its_bound(monkeypatch):
    monkeypatch.setattr(flac, "MOST_POINTS", 7)
    stream = flac.encode_many([PAYLOADS[5]])[0]
    assert len(flac._metadata(stream)[1]) <= 7
    assert (flac.decode_many([stream])[0][0] + 128).astype(np.uint8).tobytes() == PAYLOADS[5]


def test_flac_damage():
    stream = flac.encode_many([PAYLOADS[4]])[0]
    rng = random.Random(2)
    for _ in range(100):
        broken = bytearray(stream)
        broken[rng.randrange(42, len(stream))] ^= 1 << rng.randrange(8)
        try:
            x, _ = flac.decode_many([bytes(broken)])[0]
        except (ValueError, IndexError):
            continue
        assert (x + 128).astype(np.uint8).tobytes() == PAYLOADS[4]  # a seek point's unused field at most
    for cut in (3, 20, 60, len(stream) - 1):
        with pytest.raises((ValueError, IndexError)):
            flac.decode_many([stream[:cut]])


def test_crcs():
    data = np.frombuffer(b"123456789" * 2, dtype=np.uint8)
    starts, ends = np.array([0, 9]), np.array([9, 18])
    assert flac._crcs(data, starts, ends, 0x07, 8).tolist() == [0xF4] * 2
    assert flac._crcs(data, starts, ends, 0x8005, 16).tolist() == [0xFEE8] * 2


def test_flac_query(spark):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op9_flac(spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        raw = docs[r["doc_id"]]
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        assert (r["n_bytes"], r["payload_bytes"], r["tail_crc32"]) == (len(raw), len(payload), zlib.crc32(payload[-32:]))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest()
        media = flac.encode_many([payload])[0]
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())


def test_flac_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, bytearray(b""), "y"), (3, bytearray(b"z" * 80_000), "z")], "i int, payload binary, media string")
    back = flac.decoded(flac.encoded(df, "payload")).orderBy("i").collect()
    assert [len(r["blocks"]) for r in back] == [0, 0, 3]
    assert [b["first_sample"] for b in back[2]["blocks"]] == [0, 36864, 73728]
    assert b"".join(bytes(b["pcm"]) for b in back[2]["blocks"]) == b"z" * 80_000
    assert flac.decoded(flac.encoded(df.limit(0), "payload")).count() == 0


def test_mixing_query(spark):
    same(queries.op10_mixing(spark, SMALL), mixing.ORACLE_SQL, connection(SMALL))


def plain_targets(sizes, weights, total):
    """Share by weight, cap, share the excess again, until none is above."""
    target, open_ = {}, dict(weights)
    left = total
    while open_:
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            del open_[s]
    return target


def test_mixing_rules(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 50, 400])), rng.choice(["b", "a", "é", "z", None, "tiny"] if i % 40 == 0 else ["a", "é", None, "b"])) for i in range(600)]
    rows += [(1000 + i, None, "empty") for i in range(5)] + [(2000, "x " * 20_000, "b")] + rows[:20]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, taken int")
    got = mixing.mixed(df).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s), key=lambda s: s.encode()) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want = plain_targets(sizes, weights, 1.5 * sum(sizes.values()))
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert np.isclose(r["target"], want[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - want[s]) <= 3 + 0.01 * want[s], (s, taken[s], want[s])
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed(df).collect()))
    plan = mixing.mixed(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert mixing.mixed(df.limit(0)).count() == 0


def test_apportionment_is_by_highest_quotients(spark):
    rng = random.Random(3)
    for _ in range(6):
        n, seats = rng.randint(1, 12), rng.randint(0, 60)
        weights = [rng.choice([0.0, 1.0, 2.5, 7.0, 100.0]) for _ in range(n)]
        df = spark.createDataFrame([(i, w, seats, 1000) for i, w in enumerate(weights)], "i int, w double, seats long, most long")
        got = {r["i"]: r["__seats"] for r in mixing.apportion(df, [], "w", "seats", "most", "i").collect()}
        quotients = sorted(((-w / (2 * k - 1), i) for i, w in enumerate(weights) if w > 0 for k in range(1, seats + 1)))[:seats]
        want = Counter(i for _, i in quotients)
        assert got == {i: want[i] for i in range(n)}


def test_pipeline(spark):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["language ID", "SimHash near-dedup", "PII", "mixing sources", "BPE"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(10_001, "12345 678", "en", "src0", 9), (10_002, None, None, None, None)], docs.schema)
    clean = docs.unionByName(extra)
    kept = p.keep_languages(spark, clean, SMALL)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns and 10_001 not in ids and 10_002 not in ids and len(ids) >= docs.count() * 0.99
    single = p.drop_copies(spark, kept, SMALL)
    texts = [r["text"] for r in single.collect()]
    assert len(texts) == len(set(texts)) and {r["text"] for r in docs.groupBy("text").count().where("count = 1").collect()} & set(texts)
    hidden = p.hide_personal_data(spark, single, SMALL)
    assert hidden.columns == docs.columns and hidden.where(F.col("text").rlike(r"[a-z]@[a-z]+\.[a-z]")).count() == 0
    mixed = p.mix_sources(spark, hidden, SMALL)
    words = mixed.select(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n")).first()["n"]
    assert mixed.columns == docs.columns
    assert abs(words / hidden.select(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n")).first()["n"] - 1.5) < 0.1
    assert p.run(spark, SMALL).count() > 0


def test_pipeline_mix_meets_its_targets(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(i, " ".join(["w"] * (150 + i % 100)), "en", f"s{i % 3}", 1) for i in range(600)]
    long = spark.createDataFrame(rows, docs.schema)
    size = F.regexp_count("text", F.lit(mixing.WORD))
    targets = {r["source"]: (r["target"], r["most"]) for r in mixing.mixed(long).groupBy("source").agg(F.first("target").alias("target"), F.max("size").alias("most")).collect()}
    got = {r["source"]: r["n"] for r in p.mix_sources(spark, long, SMALL).groupBy("source").agg(F.sum(size).alias("n")).collect()}
    assert len(got) == 3 and all(abs(got[s] - target) <= 2 * most for s, (target, most) in targets.items())


def test_documents_without_words_stay_in_the_mix(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20)
    blank = spark.createDataFrame([(10_001, " ", "en", "src0", 1), (10_002, None, None, None, None)], docs.schema)
    assert {10_001, 10_002} <= {r["doc_id"] for r in p.mix_sources(spark, docs.unionByName(blank), SMALL).collect()}
