"""Fuzzy names and places against all pairs, on small tables."""

import random
import re
from difflib import SequenceMatcher

import pytest

from terrane.functions.text import PROJECT_PREFIXES
from terrane.operators import resolve

WORDS = "green park river tower sky".split()


def tables(seed=5):
    rng = random.Random(seed)

    def name():
        return " ".join(rng.sample(WORDS, rng.randint(1, 4))) + rng.choice(["", "", " 1", " 2", " 10", " 2b"])

    src = [(i, name(), rng.choice([None, "a", "b"])) for i in range(150)]
    dst = []
    for i in range(150):
        n = name()
        dst.append((i, n, rng.choice([None, "a", "b"]), rng.choice([None, "", f"chung cu {n}", f"{n} new", n.replace("park", "pork"), name()])))
    return src, dst


def norm(x):
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9]+", " ", (x or "").lower())).strip()


def core(x):
    return re.sub(f"^(?:(?:{'|'.join(PROJECT_PREFIXES)})(?: |$))+", "", norm(x)).strip()


def number(x):
    found = re.search(r"(\d+)(?:\s*[a-z])?$", x)
    return found[1] if found else None


def ratio(a, b):
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def plain_score(s, s_region, d, d_region, other):
    sn, sc = norm(s), core(s)
    variants = list(dict.fromkeys(v for v in (norm(d), norm(other)) if v))
    cores = list(dict.fromkeys(c for c in map(core, variants) if c))
    words, every = set(sn.split()), set(" ".join(variants).split())
    if len(words & every) < (1 if len(words) <= 2 else 2) or (s_region and d_region and s_region != d_region):
        return 0.0
    best, own = 0.0, norm(d)
    for source, targets, core_of in ((sn, variants, False), (sc, cores, True)):
        for v in targets:
            if (r := ratio(source, v)) > best:
                best, own = r, norm(d) if core_of else v
    t = set(own.split())
    score = 0.65 * best + 0.3 * len(words & t) / len(words | t)
    score += 0.05 * (s_region is not None and s_region == d_region)
    score += 0.05 * (len(sn) >= 8 and any(sn in v or v in sn for v in variants))
    numbers = {number(v) for v in variants + cores} - {None}
    mine = number(sc or sn)
    return min(1.0, max(0.0, score - 0.18 * bool(mine and numbers and mine not in numbers)))


@pytest.mark.parametrize("least", [0.85, 0.91])
def test_scores_are_those_of_all_pairs(spark, least):
    src, dst = tables()
    s = resolve.named(spark.createDataFrame(src, "id long, name string, region string"))
    d = resolve.named(spark.createDataFrame(dst, "id long, name string, region string, other string"), variants=("other",))
    got = {(r["s_norm"], r["s_region"], r["d_norm"], tuple(r["d_variants"]), r["d_region"]): round(r["score"], 9) for r in resolve.scored(s, d, least).collect()}
    want = {}
    for _, a, x in src:
        for _, b, y, other in dst:
            if (score := plain_score(a, x, b, y, other)) >= least:
                want[norm(a), x, norm(b), tuple(dict.fromkeys(v for v in (norm(b), norm(other)) if v)), y] = round(score, 9)
    assert got == want and len(want) >= 20


def test_matches_of_nothing(spark):
    src, dst = tables()
    s, d = spark.createDataFrame(src, "id long, name string, region string"), spark.createDataFrame(dst, "id long, name string, region string, other string")
    assert resolve.matched(s.limit(0), d).count() == resolve.matched(s, d.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "id long, name string, region string")
    assert resolve.matched(blank, d, variants=("other",)).count() == 0


def test_places_by_tier(spark):
    dim = spark.createDataFrame([(1, 1, "la gi"), (2, 1, "ia gi"), (3, 2, "binh an"), (4, 1, "binh an dong"), (5, 2, "xi ma")], "id long, parent long, name string")
    src = spark.createDataFrame(
        [(1, 1, "la gi"), (2, 1, "binh an"), (3, 3, "binh an"), (4, 2, "la gi"), (5, 1, "an"), (6, 1, "x"), (7, 2, "an"), (8, 1, None), (9, None, "la gi"), (10, 1, "binh an dong tay")],
        "id long, parent long, name string",
    )
    got = {r["id"]: (r["target"], r["score"]) for r in resolve.places(src, dim, spellings={"la ": "ia "}).collect()}
    assert got == {1: (1, 1.0), 2: (3, 0.95), 3: (3, 0.95), 4: (1, 0.95), 9: (1, 0.95), 10: (4, 0.9)}


def test_proposals_take_the_best_ratio(spark):
    rng = random.Random(2)
    names = ["".join(rng.choice("abcd") for _ in range(rng.randint(4, 9))) for _ in range(40)]
    dim = [(i, i % 3, n) for i, n in enumerate(names)]
    src = [(100 + i, i % 3, "".join(rng.choice("abcd") if rng.random() < 0.15 else c for c in n)) for i, n in enumerate(names)]
    got = {r["id"]: (r["target"], round(r["score"], 9)) for r in resolve.proposals(spark.createDataFrame(src, "id long, parent long, name string"), spark.createDataFrame(dim, "id long, parent long, name string"), 0.7).collect()}
    want = {}
    for i, p, n in src:
        found = [(ratio(n, m), -t) for t, q, m in dim if p == q and abs(len(n) - len(m)) <= 5 and ratio(n, m) > 0.7]
        if found:
            r, t = max(found)
            want[i] = (-t, round(r, 9))
    assert got == want and want


def test_review_is_the_best_of_all_pairs(spark):
    src, dst = tables(9)
    low, high, k = 0.85, 0.91, 3
    s = resolve.named(spark.createDataFrame(src, "id long, name string, region string"))
    d = resolve.named(spark.createDataFrame(dst, "id long, name string, region string, other string"), variants=("other",))
    got = {}
    for r in resolve.review(s, d, low, high, k).collect():
        got.setdefault((r["s_norm"], r["s_region"]), {})[r["place"]] = (round(r["score"], 9), r["d_norm"], tuple(r["d_variants"]), r["d_region"])
    want = {}
    for _, a, x in src:
        for _, b, y, other in dst:
            if low <= (score := plain_score(a, x, b, y, other)) < high:
                want.setdefault((norm(a), x), set()).add((round(score, 9), norm(b), tuple(dict.fromkeys(v for v in (norm(b), norm(other)) if v)), y))
    assert got.keys() == want.keys() and len(want) > 10
    for key, rows in want.items():
        best = sorted((r[0] for r in rows), reverse=True)[:k]
        assert [got[key][i][0] for i in range(1, len(best) + 1)] == best and len(got[key]) == len(best)
        assert set(got[key].values()) <= rows
