"""SimHash, Golay keys and components."""

import random

import numpy as np
import xxhash
from conftest import SMALL

from terrane.llm import queries, simhash
from terrane.llm.components import components


def plain_print(text, size=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Least index of each index's component, links at three bits or fewer."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_the_code_is_perfect():
    patterns, _ = simhash.golay()
    assert len(set(patterns.tolist())) == 2048 and max(int(p).bit_count() for p in patterns) == 3
    words = np.random.default_rng(0).integers(0, 1 << 23, 1000)
    rows, _ = simhash.segment_keys(words)
    assert set(np.bincount(rows).tolist()) <= {1, 6}


def test_prints_within_three_bits_share_a_key():
    rng = random.Random(5)
    a = [rng.getrandbits(64) for _ in range(3000)]
    b = []
    for x in a:
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            x ^= 1 << bit
        b.append(x)
    keys = []
    for side in (a, b):
        rows, key = simhash.golay_keys(np.array(side, dtype=np.uint64))
        own = [set() for _ in side]
        for r, k in zip(rows.tolist(), key.tolist()):
            own[r].add(k)
        keys.append(own)
    assert all(x & y for x, y in zip(*keys))


def test_prints():
    texts = ["", None, "one", "One two", "a b c d e f a b c", "x " * 70000, "É é\x0bA", "word"]
    assert simhash.fingerprints(texts, 3).tolist() == [plain_print(t) for t in texts]


def test_query(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    prints = [plain_print(t) for _, t in docs]
    groups = plain_groups(prints)
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in queries.op2_simhash(spark, SMALL).collect())
    assert got == [(d, f"{p:016x}", docs[g][0]) for (d, _), p, g in zip(docs, prints, groups)]


def chained(rng, n):
    """Prints of which many are linked, in chains and clusters."""
    out = [rng.getrandbits(64)]
    for _ in range(n - 1):
        x = rng.choice(out) if rng.random() < 0.8 else rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.randint(0, 5)):
            x ^= 1 << bit
        out.append(x)
    return sorted(set(out))


def grouped(spark, prints):
    rows = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    got = components(simhash.links(spark.createDataFrame(rows, "print long"))).collect()
    root = {r["node"]: r["root"] for r in got}
    return [root.get(p, p) for (p,) in rows]


def test_links_of_hot_keys(spark, monkeypatch):
    """The same components whether a group of equal keys is compared in a task or, as a hot one, through its neighbours."""
    prints = chained(random.Random(9), 120)
    want = plain_groups(prints)
    for most in (simhash.MOST, 2):
        monkeypatch.setattr(simhash, "MOST", most)
        got = grouped(spark, prints)
        assert {(a, b) for a in range(len(want)) for b in range(a) if want[a] == want[b]} == {(a, b) for a in range(len(got)) for b in range(a) if got[a] == got[b]}


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (200, 200), (300, 299), (299, 298), (500, 501)] + [(500, x) for x in range(600, 640)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100, 300: 298, 299: 298, 501: 500} | {x: 500 for x in range(600, 640)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges(spark):
    df = spark.createDataFrame([(5, None, "k"), (3, "", "k"), (4, "a b c", None), (None, "a b c", "k"), (9, "a b c", "k"), (9, "a b c", "k")], "doc_id long, text string, component_id string")
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in simhash.grouped(df).collect())
    assert got == [(0, 4), (3, 3), (4, 4), (5, 3), (9, 4), (9, 4)]
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4]
    assert simhash.grouped(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(7, "same words here", 1)] * 3, "doc_id long, text string, __x int")
    assert simhash.deduplicated(twice).count() == 1
    assert simhash.deduplicated(df.limit(0)).collect() == [] and simhash.deduplicated(df.limit(0)).columns == df.columns


def test_columns_with_inner_names(spark):
    names = ["__row", "__set", "__keys", "__print", "__SIZE", "node", "root", "key", "fingerprint"]
    rows = [(1, "one two three four five", *range(9)), (2, "One two three four five", *range(9)), (3, "x", *range(9)), (None, "y", *range(9))]
    df = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'`{n}` int' for n in names)}")
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(kept.collect(), key=lambda r: r[0] or 9) == [r for r in df.collect() if r[0] != 2]
    named = {r["doc_id"]: r for r in simhash.grouped(df).collect()}
    assert [named[i]["component_id"] for i in (1, 2, 3, None)] == [1, 1, 3, None] and named[1]["__row"] == 0 and named[1]["fingerprint"] != 8


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


def test_near_copies_go(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    near = [*base[:200], "changed", *base[201:]]
    far = [w if i % 25 else f"other{i}" for i, w in enumerate(base)]
    other = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    assert jaccard(base, near) > 0.95 and 0.6 < jaccard(base, far) < 0.75
    rows = [(1, base), (2, near), (3, other), (4, far), (5, [w.upper() for w in base]), (6, base[::-1])]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows] + [(7, None), (8, " ")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.deduplicated(df).collect()) == [1, 3, 4, 6, 7]


def test_similarity_is_exact(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(4, 14))) for _ in range(40)]
    pairs = [(i, j) for i in range(40) for j in range(i)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = simhash.similar(edges, spark.createDataFrame(list(enumerate(texts)), "__row long, text string"), "text", 5, 0.8).collect()

    def sets(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    want = {(i, j) for i, j in pairs if len(sets(texts[i]) & sets(texts[j])) >= 0.8 * len(sets(texts[i]) | sets(texts[j]))}
    assert {(r["a"], r["b"]) for r in got} == want


def brute_kept(texts):
    """Ids that stay, by all pairs: the least of each group that chains of pairs at 0.8 or more connect."""
    sets = [set(simhash.shingle_hashes(t or "", 5)) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted({find(i) for i in range(len(texts))})


def kept_ids(spark, texts):
    return sorted(r["doc_id"] for r in simhash.deduplicated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())


def test_near_copies_with_the_words_of_an_earlier_text(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**9)}" for _ in range(300)]
    swapped = [*base[:100], base[101], base[100], *base[102:]]
    assert kept_ids(spark, [" ".join(w) for w in (sorted(base), base, swapped)]) == [0, 1]


def test_a_large_group_is_compared_like_a_small_one(spark, monkeypatch):
    """Copies that differ from the first text by a few words each, about as far as 0.8 from one another."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**9)}" for _ in range(120)]
    texts = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(120), rng.choice((1, 2, 3, 6))):
            words[at] = f"w{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    want = brute_kept(texts)
    assert 1 < len(want) < 75
    for most, few in ((simhash.MOST, 64), (2, 4)):
        monkeypatch.setattr(simhash, "MOST", most)
        monkeypatch.setattr(simhash, "FEW", few, raising=False)
        assert kept_ids(spark, texts) == want


def test_sketches_never_part_similar_sets():
    rng = np.random.default_rng(5)
    for n in (5, 60, 400, 3000, 5000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[n // 9 :], rng.integers(0, 2**63, n // 9 * 2).astype(np.uint64))))
        apart, words = len(np.setxor1d(a, b)), min(len(simhash.sketch(a)), len(simhash.sketch(b)))
        for w in (words, simhash.SKETCH // 64):
            bits = int(np.bitwise_count(simhash.folded(simhash.sketch(a), w) ^ simhash.folded(simhash.sketch(b), w)).sum())
            assert bits <= apart and (w < words or bits >= apart / 3)
        other = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        assert n < 60 or np.bitwise_count(simhash.sketch(a)[:words] ^ simhash.sketch(other)[:words]).sum() > (len(a) + len(other)) / 9


def test_short_near_copies_are_all_found(spark):
    rng = random.Random(8)
    texts = []
    for words in (5, 12, 25, 60):
        for _ in range(60):
            one = [f"w{rng.randrange(10**9)}" for _ in range(words)]
            near = {5: one, 12: [*one, "more"], 25: [*one[:-2], "other", one[-1]], 60: [*one[:-6], "other", *one[-5:]]}[words]
            texts += [" ".join(one), " ".join(near)]
    assert kept_ids(spark, texts) == brute_kept(texts) == list(range(0, len(texts), 2))
