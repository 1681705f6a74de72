"""Hard negatives: exact products, and whole results against brute force and SQL."""

from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from oracle import connection, same
from pyspark.sql import functions as F

from terrane.llm import negatives, queries


@pytest.mark.parametrize("bound, width", [(3, 4), (300, 64), (1 << 20, 700), (1 << 27, 5)])
def test_products_are_exact(bound, width):
    rng = np.random.default_rng(bound)
    a, b = rng.integers(-bound, bound + 1, (7, width)), rng.integers(-bound, bound + 1, (9, width))
    a[0], b[0] = bound, -bound
    rns = negatives.Residues(negatives.primes(bound * bound * width))
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    assert rns.product(rns.reduced(a), rns.reduced(b)).tolist() == want


def test_primes():
    for bound in (0, 1, 10**6, 1 << 59):
        found = negatives.primes(bound)
        assert np.prod([float(p) for p in found]) > 2 * bound and len(set(found)) == len(found) and all(p < 1024 for p in found)


def brute(rows, asked, k=5):
    ok = [(i, y, [int(np.floor(256 * np.float64(x))) for x in v]) for i, y, v in rows if y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for at, (i, y, v) in enumerate(ok):
        if i is None or not asked(i):
            continue
        scored = [(sum(p * q for p, q in zip(v, w)), j, z) for n, (j, z, w) in enumerate(ok) if n != at and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], j if (j := s[1]) is not None else 1 << 63))
        for best, j, _ in [s for s in scored if s[2] == y][:k]:
            for rank, (s, n, _) in enumerate([s for s in scored if s[2] != y and 80 * best <= 100 * s[0] <= 100 * best][:k], 1):
                out[i, j, rank, n, best, s] += 1
    return out


@pytest.mark.parametrize("block", [4096, 17])
def test_against_brute_force(spark, block):
    rng = np.random.default_rng(block)
    rows = [(int(i), int(rng.integers(0, 3)), [float(x) for x in np.round(rng.normal(size=3), 1)]) for i in range(150)]
    rows += [rows[10], rows[20], (10, 2, rows[10][2]), (None, 1, [0.5, 0.5, 0.5]), (None, 2, [0.5, 0.5, 0.5]), (200, None, [1.0, 1.0, 1.0]), (210, 1, None), (220, 1, [1.0, None, 1.0])]
    rows += [(230, 1, [float("nan"), 1.0, 1.0]), (240, 1, [float("inf"), 1.0, 1.0]), (250, 1, [1.0, 2.0]), (260, 1, [1.0, 1.0]), (270, 2, [0.9, 2.0]), (280, 1, []), (290, 1, []), (300, 2, []), (310, 0, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("row", F.lit("x")).repartition(4)
    got = negatives.mined(df, F.col("vec_id") % 10 == 0, block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == brute(rows, lambda i: i % 10 == 0)


def test_empty_and_too_long(spark):
    df = spark.createDataFrame([(1, 1, [1e10, 1.0])], "vec_id long, label int, embedding array<double>")
    assert negatives.mined(df.limit(0), F.col("vec_id") > 0).count() == 0
    with pytest.raises(ValueError):
        negatives.mined(df, F.col("vec_id") > 0)


def test_query(spark):
    assert queries.op13_negatives(spark, SMALL).count() > 0
    same(queries.op13_negatives(spark, SMALL), negatives.ORACLE_SQL, connection(SMALL))
