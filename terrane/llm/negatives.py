"""Hard negatives by exact integer scores: residue-number-system products and a window below each positive.

A component x becomes floor(scale * x). Scores are integer inner products, taken exactly in single precision: the matrices
are reduced modulo a few small primes, the residues multiplied as float32 matrices (in slices of components so short that no
partial sum reaches 2^24), and each score is put together from its residues by Chinese remaindering, in balanced mixed
digits, which give its sign too. How many primes it takes follows from the largest squared norm, which bounds all scores.

Vectors are dealt to blocks of about `BLOCK` rows by a hash of their row; the anchors visit every block, and a block's task
holds its vectors and takes the anchors as they come. From each block an anchor gets at most k positives, in a second pass,
with the scores of all its positives known, at most k negatives a positive; windows then select among these, so no
task sees all scores of an anchor.

Results: rows with a null label or vector, or with a component that is null or not finite, take no part. An anchor scores
vectors of its own length only. The anchor's own row is no partner of it; another row of the same id, or the same vector
again, is. A null id is no anchor and comes last in ties. Rows of equal id and score are alike. An empty table gives an
empty one. Squared norms of 2^59 or more raise an error, as scores would not fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.storage import saved

#: Vectors that a task holds, about.
BLOCK = 4096
#: Anchors that are scored together.
ANCHORS = 256
#: Squared norms below this keep all scores, times five, in a long.
MOST_NORM = 1 << 59
#: What stands for a null id in ties.
LAST = np.iinfo(np.int64).max


def primes(bound: int) -> list[int]:
    """The largest primes under 2^10 whose product is over 2 * bound + 1, so that scores of both signs up to `bound` differ."""
    sieve = [p for p in range(1023, 2, -2) if all(p % q for q in range(3, int(p**0.5) + 1, 2))]
    out, product = [], 1
    for p in sieve:
        if product > 2 * bound + 1:
            break
        out.append(p)
        product *= p
    return out or sieve[:1]


class Residues:
    """Matrices of integers modulo each of some primes, and their exact products."""

    def __init__(self, moduli: list[int]):
        self.moduli = moduli
        half = max(m // 2 for m in moduli)
        #: Components that can be summed in float32 without loss.
        self.width = max(1, ((1 << 24) - 1) // (half * half))

    def reduced(self, matrix: np.ndarray) -> list[np.ndarray]:
        """Balanced residues as float32, one matrix a prime."""
        out = []
        for m in self.moduli:
            r = np.remainder(matrix, m)
            out.append(np.where(r > m // 2, r - m, r).astype(np.float32))
        return out

    def product(self, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """left @ right.T of the integer matrices, exactly, as int64."""
        rests = []
        for m, a, b in zip(self.moduli, left, right):
            total = np.zeros((len(a), len(b)), dtype=np.int32)
            for i in range(0, a.shape[1], self.width):
                total += np.remainder((a[:, i : i + self.width] @ b[:, i : i + self.width].T).astype(np.int32), m)
            rests.append(np.remainder(total, m))
        # Garner's digits: each is what is left of its residue after the digits before it.
        digits: list[np.ndarray] = []
        for i, m in enumerate(self.moduli):
            x = rests[i]
            for j in range(i):
                x = (x - digits[j]) * pow(self.moduli[j], -1, m) % m
            digits.append(np.where(x > m // 2, x - m, x))
        value = digits[-1].astype(np.int64)
        for m, d in zip(reversed(self.moduli[:-1]), reversed(digits[:-1])):
            value = value * m + d
        return value


def _first(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores among some places, which stand in the order of ids; ties by that order."""
    if len(among) > k:
        s = scores[among]
        least = np.partition(s, len(s) - k)[len(s) - k]
        above = among[s > least]
        among = np.concatenate((above, among[s == least][: k - len(above)]))
    return among[np.argsort(-scores[among], kind="stable")]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1 if len(flat) else 0).astype(np.int64)


def _visits(moduli: list[int], k: int, low: int, high: int, mining: bool):
    """Over rows sorted by (block, size, asks), a block's vectors before the anchors: with `mining`, (anchor, place, score of
    the positive, negative, score) for each positive that an anchor brings, else (anchor, positive, score)."""
    rns = Residues(moduli)

    def run(batches):
        at, held, table = None, [], None
        for batch in batches:
            home = batch.column("block").to_numpy(zero_copy_only=False) << 32 | batch.column("size").to_numpy(zero_copy_only=False)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((home[1:] != home[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(home)]):
                if a == b:
                    continue
                if home[a] != at:
                    at, held, table = home[a], [], None
                if not asks[a]:
                    held.append(batch.slice(a, b - a))
                    continue
                if held and table is None:
                    rows = pa.Table.from_batches(held).combine_chunks()
                    ids = rows.column("id").fill_null(LAST).to_numpy()
                    by = np.argsort(ids, kind="stable")
                    table = [rows.column("row").to_numpy()[by], ids[by], rows.column("label").to_numpy()[by], rns.reduced(_matrix(rows.column("v").combine_chunks())[by])]
                    held = []
                if table is not None:
                    for c in range(a, b, ANCHORS):
                        yield found(batch.slice(c, min(ANCHORS, b - c)), *table)

    def found(anchors: pa.RecordBatch, row, ids, label, reduced) -> pa.RecordBatch:
        scores = rns.product(rns.reduced(_matrix(anchors.column("v"))), reduced)
        own, kind = anchors.column("row").to_numpy(), anchors.column("label").to_numpy()
        out: list[list] = [[] for _ in range(5 if mining else 3)]
        positives = anchors.column("positives").to_pylist() if mining else [None] * len(own)
        for i, line in enumerate(scores):
            if not mining:
                near = _first(line, np.flatnonzero((label == kind[i]) & (row != own[i])), k)
                made = [[int(own[i])] * len(near), ids[near].tolist(), line[near].tolist()]
                for to, v in zip(out, made):
                    to += v
                continue
            other = label != kind[i]
            for place, best in [(p["place"], p["score"]) for p in positives[i]]:
                near = _first(line, np.flatnonzero(other & (high * line <= high * best) & (high * line >= low * best)), k)
                for to, v in zip(out, ([int(own[i])] * len(near), [place] * len(near), [best] * len(near), ids[near].tolist(), line[near].tolist())):
                    to += v
        names = ["anchor", "place", "best", "partner", "score"] if mining else ["anchor", "partner", "score"]
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], names=names)

    return run


def mined(df: DataFrame, anchors: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label", scale: int = 256, low: int = 4, high: int = 5, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row where the condition `anchors`
    holds, and each of its k best rows of the same label, the k best rows of other labels with a score from low/high of the positive's up to it."""
    kind = F.col(label) if isinstance(label, str) else label
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("id"), kind.cast("long").alias("label"), F.when(F.col(vector).isNotNull() & finite, whole).alias("v"), F.coalesce(anchors, F.lit(False)).alias("asked"))
    rows = rows.where("label IS NOT NULL AND v IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    # Written once, so that rows keep their numbers.
    rows = saved(rows.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))), "vectors")
    seen = rows.agg(F.count("*").alias("n"), F.max("norm").alias("norm")).first()
    if seen["norm"] is not None and seen["norm"] >= MOST_NORM:
        raise ValueError("vectors are so long that their scores would not fit a long")
    # The norm was summed in doubles; a little more covers its rounding.
    moduli, blocks = primes(int((seen["norm"] or 0) * 1.001) + 1), max(1, -(-seen["n"] // block))
    held = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("long").alias("block"), F.size("v").cast("long").alias("size"), F.lit(False).alias("asks"), "row", "id", "label", "v")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    asked = rows.where("asked").select(every, F.size("v").cast("long").alias("size"), F.lit(True).alias("asks"), "row", "id", "label", "v")

    def visit(both: DataFrame, columns: str, mining: bool) -> DataFrame:
        dealt = both.repartitionById(blocks, F.col("block").cast("int")).sortWithinPartitions("block", "size", "asks")
        return dealt.mapInArrow(_visits(moduli, k, low, high, mining), columns)

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "partner")
    near = visit(held.unionByName(asked), "anchor long, partner long, score long", False).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    positives = saved(near.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(F.struct(F.col("place").cast("long").alias("place"), "partner", "score"))).alias("positives")), "positives")
    mine = held.withColumn("positives", F.lit(None).cast(positives.schema["positives"].dataType)).unionByName(asked.join(positives, "row"))
    best = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "partner")
    far = visit(mine, "anchor long, place long, best long, partner long, score long", True).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = rows.where("asked").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")).join(positives.select(F.col("row").alias("anchor"), F.explode("positives").alias("p")), "anchor")
    names = names.select("anchor", "anchor_id", F.col("p.place").alias("place"), "p.partner")
    known = lambda c: F.nullif(F.col(c), F.lit(int(LAST)))
    return far.join(names.withColumnRenamed("partner", "positive"), ["anchor", "place"]).select(
        "anchor_id", known("positive").alias("positive_id"), "rank", known("partner").alias("negative_id"), F.col("best").alias("positive_score"), F.col("score").alias("negative_score"))


#: The query's result in DuckDB's SQL: all scores of the anchors, by integers of any size.
ORACLE_SQL = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS kind, b.vec_id, b.label, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE label = kind) WHERE place <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> s.kind AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
