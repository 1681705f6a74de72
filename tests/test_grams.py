"""Joins on pieces of texts against all pairs."""

import random
from difflib import SequenceMatcher

import pytest

from terrane.operators import grams, resolve


def words(seed, n, letters="abcd ", low=1, high=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)]


def ratio(a, b):
    return SequenceMatcher(None, a, b).ratio()


@pytest.mark.parametrize("least", [0.5, 0.6, 0.75, 0.88, 1.0])
def test_similar(spark, least):
    rng = random.Random(int(least * 100))
    left = words(1, 120) + ["a", "ab", "b", "aaaa", "x" * 300]
    right = ["".join(rng.choice("abcd ") if rng.random() < 0.1 else c for c in n) for n in left] + words(2, 60) + ["x" * 290 + "y", "", None]
    rows = lambda names: [(i % 3, n) for i, n in enumerate(names)]
    got = grams.similar(spark.createDataFrame(rows(left), "k int, name string"), spark.createDataFrame(rows(right), "k int, name string"), ["k"], least)
    got = {(r["k"], r["a"], r["b"]): round(r["score"], 9) for r in got.collect()}
    want = {(k, a, b): round(ratio(a, b), 9) for k, a in rows(left) for j, b in rows(right) if k == j and a and b and ratio(a, b) >= least}
    assert got == want and len(want) > 20


def test_occurring(spark):
    rng = random.Random(4)
    texts = words(5, 80, "abc ", 0, 60) + [None, "zz" * 3000]
    patterns = words(6, 60, "abc ", 1, 5) + ["c" * 40, "", None, "z" * 4000] + [t[3:25] for t in texts[:20] if t and len(t) > 30]
    for keys in ([], ["k"]):
        t = [(rng.randint(0, 1), x) for x in texts for _ in range(2)]
        p = [(rng.randint(0, 1), x) for x in patterns]
        df = grams.occurring(spark.createDataFrame(t, "k int, text string"), spark.createDataFrame(p, "k int, pattern string"), keys)
        want = {((k,) if keys else ()) + (x, y) for k, x in t for j, y in p if x and y and y in x and (not keys or k == j)}
        got = [tuple(r) for r in df.collect()]
        assert set(got) == want and len(got) == len(want)


def test_longest_prefix(spark):
    rules = spark.createDataFrame([("ban", "s", 1), ("ban-dat", "s", 2), ("ban-dat", "s", 3), ("ban-dat-nen-du-an", "s", 4), ("", "e", 5), (None, "n", 6), ("ban-", "h", 7)], "prefix string, trade string, kind int")
    paths = ["ban", "ban-dat", "ban-dat-x", "ban-dat-nen", "ban-dat-nen-du-an", "ban-dat-nen-du-an-1-2-3-4-5-6-7-8", "band-dat", "x", "", "-x", "ban--x", None, "ban-dat", "ban-" + "x-" * 5000]
    df = spark.createDataFrame(list(enumerate(paths)), "id int, path string")
    got = {r["id"]: (r["trade"], r["kind"]) for r in grams.by_longest_prefix(df, "path", rules).collect()}
    table = [("ban", "s", 1), ("ban-dat", "s", 2), ("ban-dat-nen-du-an", "s", 4), ("", "e", 5), ("ban-", "h", 7)]
    for i, p in enumerate(paths):
        fits = [r for r in table if p is not None and (p == r[0] or p.startswith(r[0] + "-"))]
        assert got[i] == (max(fits, key=lambda r: len(r[0]))[1:] if fits else (None, None))
    assert grams.by_longest_prefix(df, "path", rules.limit(0)).where("trade IS NULL").count() == len(paths)


def wards(seed, n):
    """Trees of wards whose districts are alike, and rows as another source spells them."""
    rng = random.Random(seed)
    districts = ["quan nam", "quan ba", "quan bac", "huyen nam", "quan nam 2", "tay bac", "q uan ba"]
    dim = []
    for i in range(n):
        d = rng.randrange(len(districts))
        dim.append((i, i % 2, 10 * (i % 2) + d, districts[d], rng.choice(["hoa binh", "hoa bin", "tan hoa", "tan hoa dong", "an hoa", "phuong 1"]) + rng.choice(["", " a", " bc", " thuong ha noi"])))
    spelt = lambda x: "".join(c for c in x if rng.random() > 0.07) if rng.random() < 0.6 else x.replace(" ", "")
    src = [(1000 + i, x[1], spelt(x[3]), spelt(x[4])) for i, x in enumerate(dim)] + [(5000, 0, "zzz", "hoa binh"), (5001, 3, "quan nam", "hoa binh"), (5002, 0, None, "hoa binh")]
    return src, dim


def test_wards_of_the_best_district(spark):
    src, dim = wards(7, 200)
    got = resolve.proposals_of_wards(spark.createDataFrame(src, "id long, parent long, district string, name string"), spark.createDataFrame(dim, "id long, parent long, district_id long, district string, name string"))
    want = {}
    for i, p, d, w in src:
        own = sorted({(x[2], x[3]) for x in dim if x[1] == p})
        if not own or not d:
            continue
        equal = [k for k, n in own if n.replace(" ", "") == d.replace(" ", "")]
        score, k = (1.0, -equal[0]) if equal else max((ratio(d, n), -k) for k, n in own)
        if score < 0.6:
            continue
        r, t = max((ratio(w, x[4]), -x[0]) for x in dim if x[2] == -k)
        if r > 0.88 and abs(len(w) - len(dim[-t][4])) <= 5:
            want[i] = (-t, round(r, 9))
    assert {r["id"]: (r["target"], round(r["score"], 9)) for r in got.collect()} == want and len(want) > 60


def test_the_better_district_goes_first(spark):
    dim = spark.createDataFrame([(1, 1, 1, "quan ba", "hoa binh"), (2, 1, 2, "quan nam", "hoa bin")], "id long, parent long, district_id long, district string, name string")
    src = spark.createDataFrame([(7, 1, "quan nam", "hoa binh")], "id long, parent long, district string, name string")
    assert [(r["id"], r["target"]) for r in resolve.proposals_of_wards(src, dim).collect()] == [(7, 2)]


def test_aliases_of_any_length_and_inside_words(spark):
    aliases = spark.createDataFrame([("hue", 1), ("mot hai ba bon nam sau bay tam", 2), ("ba bon", 3), ("tp hcm", 4)], "alias string, region long")
    rows = [(1, "12 thanhue"), (2, "pho mot hai ba bon nam sau bay tam cu"), (3, "so ba bon"), (4, "khong"), (5, "gan hue va ba bon, xx"), (6, None), (7, "xom, tp hcm, Việt Nam")]
    got = {r["id"]: r["region"] for r in resolve.region_of_address(spark.createDataFrame(rows, "id long, address string"), aliases).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 5: 3, 7: 4}
