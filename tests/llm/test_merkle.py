"""Merkle manifests against a plain tree and SQL."""

import hashlib
from collections import Counter, defaultdict

import pytest
from conftest import SMALL
from oracle import connection, same
from pyspark.sql import functions as F

from terrane.llm import merkle, queries


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """The root, and the steps of each leaf."""
    paths, level, own = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, at in enumerate(own):
            run = level[at // 2 * 2 : at // 2 * 2 + 2]
            paths[i].append(("".join(run[: at % 2]), "".join(run[at % 2 + 1 :])))
        own = [at // 2 for at in own]
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def brute(rows, claims):
    """rows: (doc_id, lang, text)."""
    groups = defaultdict(list)
    for r, c in zip(rows, claims):
        groups[r[1]].append((r[0] is not None, r[0] or 0, h(*map(field, r)), h(*map(field, c))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in names:
        groups[g].sort()
        subs[g] = tree([x[2] for x in groups[g]])
    root, upper = tree([subs[g][0] for g in names])
    out = Counter()
    for g, above in zip(names, upper):
        for x, path in zip(groups[g], subs[g][1]):
            folded = x[3]
            for left, right in path + above:
                folded = h(left, folded, right)
            out[x[1] if x[0] else None, g, x[2], subs[g][0], root, tuple(path + above), folded, folded == root] += 1
    return out


@pytest.mark.parametrize("sizes, bits", [((1,), 7), ((2, 1), 7), ((37, 5, 1, 8), 2), ((70, 3), 3), ((150, 1, 129), 7)])
def test_manifest(spark, sizes, bits):
    rows = [(i * 7 % 100, f"l{g}" if g else None, f"text {i}é" if i % 5 else None) for g, n in enumerate(sizes) for i in range(n)]
    rows += rows[:3] + [(None, rows[0][1], "x")] * 2 if len(rows) > 3 else []
    df = spark.createDataFrame([(*r, 1) for r in rows], "id long, lang string, text string, rank int").repartition(3)
    got = merkle.manifest(df, ("id", "lang", "text"), "lang", "id", {"text": F.when(F.col("id") % 3 == 1, F.lit("!")).otherwise(F.col("text"))}, bits=bits)
    assert got.columns == ["id", "lang", "leaf", "subroot", "root", "steps", "folded_root", "verified"]
    claims = [(a, b, "!" if a is not None and a % 3 == 1 else c) for a, b, c in rows]
    assert Counter((*r[:5], tuple(map(tuple, r["steps"])), *r[6:]) for r in got.collect()) == brute(rows, claims)


def test_many_groups_and_empty(spark):
    rows = [(i, str(i % 40), "t") for i in range(90)]
    df = spark.createDataFrame(rows, "id long, lang string, text string")
    got = merkle.manifest(df, ("id", "lang", "text"), "lang", "id", bits=2)
    assert Counter((*r[:5], tuple(map(tuple, r["steps"])), *r[6:]) for r in got.collect()) == brute(rows, rows)
    assert merkle.manifest(df.limit(0), ("id", "lang", "text"), "lang", "id").count() == 0


def test_no_join_after_ranks(spark):
    plan = queries.op12_merkle(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_query(spark):
    out = queries.op12_merkle(spark, SMALL)
    same(out, merkle.ORACLE_SQL, connection(SMALL))
    rows = out.collect()
    assert any(r["verified"] for r in rows) and not all(r["verified"] for r in rows)
