"""Approximate nearest neighbours by cosine, over shifted Hilbert curves.

Several curves are laid through the unit vectors: each projects them at random to a few dimensions, shifts them
within its cube and takes the Hilbert index as its key. In Spark each curve's keys are cut at their quantiles to blocks
of equal rows. A query visits, on every curve, the blocks within a window about its own key; each block scores its
queries against its rows, and the best of all blocks and curves are merged, ranked anew and cut.

The windows' share of a curve is fitted: on a bounded sample (`SAMPLE` vectors and `SAMPLE_QUERIES` of them as queries, the
least by a hash of the id) it is the smallest of `SHARES` whose recall on the sample reaches `AIM`. At the same
share recall rises with the number of vectors, so the sample errs towards wider windows. Vectors without structure need
wide windows, clustered ones narrow ones. Every row is in every curve; nothing else is left to the sample.

Results: vectors that are null, zero, of another length than most of the sample's, or hold a null or non-finite
component take no part, nor do rows without an id. Equal vectors are kept six times at most, by least id: no query's
list of `k` can need more than k + 1. A query's own id is never among its neighbours. Ties go to the smaller id. With
fewer than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.storage import saved

CURVES, DIMS, BITS = 12, 12, 5
SAMPLE, SAMPLE_QUERIES, AIM = 4096, 256, 0.92
SHARES = (1 / 256, 1 / 128, 1 / 64, 1 / 32, 1 / 24, 1 / 16, 1 / 12, 1 / 8, 1 / 6, 1 / 4, 1 / 2, 1.0)
#: Rows of a block, blocks of a curve at most, rows that one task takes of a block, and queries that it scores against it.
BLOCK_ROWS, MOST_BLOCKS, BLOCK_MOST, TASK_QUERIES = 1024, 4096, 1 << 15, 8192


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of integers of `bits` bits (Skilling's transposed form, in numpy)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            turn = x[i] >> b & 1 == 1
            swap = np.where(turn, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turn, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[i]
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where(x[n - 1] >> b & 1 == 1, flip ^ ((1 << b) - 1), flip)
    x ^= flip
    key = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Curves:
    """Projections, shifts and ranges of the curves; a few kilobytes, whatever the table's size."""

    def __init__(self, sample: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.width = sample.shape[1]
        self.project = [rng.normal(size=(self.width, DIMS)) for _ in range(CURVES)]
        self.shift = rng.random((CURVES, DIMS))
        unit = _unit(sample)
        ends = [np.quantile(unit @ p, (0.001, 0.999), axis=0) for p in self.project]
        self.low = [e[0] for e in ends]
        self.span = [np.maximum(e[1] - e[0], 1e-12) for e in ends]

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Keys, curves x vectors. The data take half of the cube's side; the shift moves them within it."""
        unit = _unit(vectors)
        top = (1 << BITS) - 1
        out = []
        for c in range(CURVES):
            cell = ((unit @ self.project[c] - self.low[c]) / self.span[c] + self.shift[c]) / 2 * (top + 1)
            out.append(hilbert_index(np.clip(cell, 0, top).astype(np.int64), BITS))
        return np.array(out)


def _share(curves: Curves, sample: np.ndarray, k: int) -> float:
    """The least share of a curve, for a query's window, that reaches `AIM` on the sample."""
    n, asked = len(sample), min(SAMPLE_QUERIES, len(sample))
    unit = _unit(sample)
    scores = unit[:asked] @ unit.T
    scores[np.arange(asked), np.arange(asked)] = -2
    k = min(k, n - 1)
    if k < 1:
        return 1.0
    best = np.argsort(-scores, axis=1)[:, :k]
    away = np.full(best.shape, n)
    for key in curves.keys(sample):
        rank = np.empty(n, dtype=np.int64)
        rank[np.argsort(key, kind="stable")] = np.arange(n)
        away = np.minimum(away, np.abs(rank[best] - rank[:asked, None]))
    return next((s for s in SHARES if (away <= s * n / 2).mean() >= AIM), 1.0)


def nearest(df: DataFrame, queries, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", seed: int = 7) -> DataFrame:
    """The k rows nearest by cosine to each row of `df` where the condition `queries` holds: query_id, rank, vec_id, score."""
    spark = df.sparkSession
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toPandas()["v"].tolist()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = [len(v) for v in sample]
    width = max(set(lengths), key=lambda n: (lengths.count(n), n))
    sample = np.array([v for v in sample if len(v) == width])
    curves = Curves(sample, seed)
    share = _share(curves, sample, k)

    def keyed(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), width)
            keys = pa.array(curves.keys(v).T.tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "keys"])

    rows = rows.where(F.size("v") == width)
    # Of equal vectors the least k + 1 ids can be found: a plain limit by rank, which Spark applies before the shuffle
    # too, so that a vector of very many rows meets no window whole. The queries, all of them, stand in rows of their own.
    copy = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    found = rows.withColumn("copy", copy).where(F.col("copy") <= k + 1).select("id", "v", F.lit(False).alias("asked"))
    both = found.unionByName(rows.where("asked").select("id", "v", "asked"))
    rows = saved(both.mapInArrow(keyed, "id long, v array<double>, asked boolean, keys array<long>"), "keyed")
    counts = rows.agg(F.count(F.when(~F.col("asked"), 1)).alias("n"), F.count(F.when(F.col("asked"), 1)).alias("q")).first()
    blocks = max(1, min(MOST_BLOCKS, -(-counts["n"] // BLOCK_ROWS)))
    reach = math.ceil(share * blocks / 2) if blocks > 1 else 0
    parts = max(1, -(-counts["q"] * min(blocks, 2 * reach + 1) // blocks // TASK_QUERIES))

    # Beyond MOST_BLOCKS bounds a block's rows are dealt to pieces of `BLOCK_MOST` rows; its queries visit all of them.
    pieces = max(1, -(-counts["n"] // blocks // BLOCK_MOST))
    curve = rows.select("id", "v", "asked", F.posexplode("keys").alias("curve", "key"))
    # One row a curve, with at most MOST_BLOCKS bounds.
    if blocks > 1:
        at = [i / blocks for i in range(1, blocks)]
        bounds = curve.where("NOT asked").groupBy("curve").agg(F.percentile_approx("key", at, 20 * blocks).alias("bounds"))
    else:
        bounds = curve.select("curve").distinct().withColumn("bounds", F.array().cast("array<long>"))
    curve = curve.join(F.broadcast(saved(bounds, "bounds")), "curve")
    # Equal keys that span several blocks are spread over these.
    low = F.expr("CAST(size(filter(bounds, b -> b < key)) AS INT)")
    high = F.expr("CAST(size(filter(bounds, b -> b <= key)) AS INT)")
    curve = curve.withColumns({"low": low, "high": high}).drop("bounds", "key")
    home = (F.col("low") + F.pmod(F.xxhash64("id"), F.col("high") - F.col("low") + 1)).cast("int")
    all_parts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    piece = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(pieces)).cast("int").alias("piece")
    held = curve.where("NOT asked").select("curve", home.alias("block"), piece, "id", "v", all_parts.alias("part"))
    visit = F.explode(F.sequence(F.greatest(F.lit(0), F.col("low") - reach), F.least(F.lit(blocks - 1), F.col("high") + reach)))
    asked = curve.where("asked").select("curve", visit.alias("block"), "id", "v", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int").alias("part"))
    asked = asked.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            qid, vid = np.array(left.column("id")), np.array(right.column("id"))
            q, v = _matrix(left.column("v").combine_chunks(), width), _matrix(right.column("v").combine_chunks(), width)
            nq, nv = np.linalg.norm(q, axis=1), np.linalg.norm(v, axis=1)
            for a in range(0, len(q), 512):
                rough = (q[a : a + 512] @ v.T) / nq[a : a + 512, None] / nv
                rough[qid[a : a + 512, None] == vid] = -2
                last = np.partition(rough, -min(k, len(v)), axis=1)[:, -min(k, len(v))]
                for i, j in enumerate(last):
                    near = np.flatnonzero((rough[i] >= j - 1e-9) & (rough[i] > -1.5))
                    # Row by row, so that equal vectors get equal scores.
                    exact = (v[near] * q[a + i]).sum(axis=1) / (nq[a + i] * nv[near])
                    keep = np.lexsort((vid[near], -exact))[:k]
                    out["query_id"] += [int(qid[a + i])] * len(keep)
                    out["vec_id"] += vid[near[keep]].tolist()
                    out["score"] += exact[keep].tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    keys = ("curve", "block", "piece", "part")
    held = held.toDF(*held.columns)  # names of its own, as both sides come from one table
    near = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(score, "query_id long, vec_id long, score double")
    merged = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
