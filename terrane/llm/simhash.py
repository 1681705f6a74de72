"""SimHash near-duplicates by Golay-code fuzzy hashing.

The 64 bits of a fingerprint are cut to segments a (23 bits), b (23) and c (18). In the perfect binary Golay code of
length 23 every word has exactly one codeword within three bits. The keys of a 23-bit segment are the codewords to which
it and its 23 neighbours at one bit decode, six at most on average: two segments that differ in two bits or fewer have
a word between them at one bit from each, so they share a key. With three errors in all, pigeonholes tell which parts
are free of errors, and these join the Golay key of a segment, so that a key has 32 to 42 bits:

    errors in (a, b, c)              key
    a free, b two at most            a, Golay(b)             and the same with a and b exchanged
    c free, b one at most, a two     c, a half of b, Golay(a)      likewise
    a and b free | all c, a three    b, c                    likewise
    one each                         a half of b, a half of c, Golay(a)

Fingerprints of equal keys are candidates; the exact distance decides. Equal fingerprints are one node from the start,
so copies cost nothing. In a group of equal keys the linked ones are joined to trees, which emits fewer links than members.
Groups of over `MOST` fingerprints, found by counting keys before the shuffle, never meet in one task: each of their
fingerprints is hung on the words at up to two bits from it, and a word's members are linked to one that is at
one bit from it. That is exact for a distance of three and needs no pairs.

Results: a null text, like one without words, has fingerprint zero. All rows take part; rows of equal text get equal
results; null ids are in no component's name unless the component has no other. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm.arrow import extend, shielding, slices
from terrane.llm.components import components
from terrane.llm.storage import saved

DISTANCE = 3
SEED = 42
#: Fingerprints of one key that a task compares with one another.
MOST = 2048
#: Fixed value: the generator polynomial of the Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def shingle_hashes(text: str, size: int) -> list[int]:
    """XXH64 of all runs of `size` words, repeats included, each joined by single spaces."""
    words = text.encode().lower().split()
    if len(words) < size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:-1]]
    hashed, seed = xxhash.xxh64_intdigest, SEED
    return [hashed(line[a : b - 1], seed) for a, b in zip(starts, ends[size - 1 :])]


def fingerprints(texts: list[str | None], size: int) -> np.ndarray:
    return majorities([shingle_hashes(t or "", size) for t in texts])


def majorities(lists: list[list[int]]) -> np.ndarray:
    """One fingerprint a list: a bit is 1 if it is set in over half of the list's hashes."""
    counts = np.array([len(x) for x in lists], dtype=np.int64)
    out = np.zeros(len(lists), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    values = np.fromiter((h for x in lists for h in x), dtype=np.uint64, count=int(counts.sum()))
    # Sixteen-bit lanes: four bits are counted at a time, over runs of at most 2**15 hashes.
    starts = (np.cumsum(counts) - counts)[full]
    cuts = np.unique(np.concatenate((starts, *[np.arange(s, s + n, 1 << 15) for s, n in zip(starts[counts[full] > 1 << 15], counts[full][counts[full] > 1 << 15])])))
    owner = np.searchsorted(starts, cuts, side="right") - 1
    first = np.searchsorted(owner, np.arange(len(full)))
    lane = np.uint64(0x0001000100010001)
    for shift in range(16):
        sums = np.add.reduceat(values >> np.uint64(shift) & lane, cuts)
        for j in range(4):
            ones = np.add.reduceat((sums >> np.uint64(16 * j) & np.uint64(0xFFFF)).astype(np.int64), first)
            out[full] |= (ones * 2 > counts[full]).astype(np.uint64) << np.uint64(16 * j + shift)
    return out


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """For all 2**23 words would be large; instead the codeword index is found by syndrome: the remainder of each byte
    and half word, and the error pattern (three bits at most) of each of the 2**11 remainders."""

    def rest(word: int) -> int:
        for i in range(22, 10, -1):
            if word >> i & 1:
                word ^= GENERATOR << (i - 11)
        return word

    patterns = np.zeros(1 << 11, dtype=np.int32)
    for weight in (1, 2, 3):
        for places in combinations(range(23), weight):
            e = sum(1 << p for p in places)
            patterns[rest(e)] = e
    high = np.array([rest(h << 11) for h in range(1 << 12)], dtype=np.int32)
    return patterns, high


def codewords(words: np.ndarray) -> np.ndarray:
    """Index (the upper twelve bits) of the codeword nearest to each 23-bit word."""
    patterns, high = golay()
    return (words ^ patterns[(words & 2047) ^ high[words >> 11]]) >> 11


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All distinct keys of each 23-bit word: rows (positions in `words`) and keys."""
    near = np.concatenate((words[:, None], words[:, None] ^ (1 << np.arange(23))), axis=1)
    keys = np.sort(codewords(near), axis=1)
    new = np.ones(keys.shape, dtype=bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return np.nonzero(new)[0], keys[new]


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and 64-bit keys of the fingerprints; any two within three bits share one."""
    v = prints.astype(np.uint64)
    a, b, c = ((v >> np.uint64(s) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in ((41, 23), (18, 23), (0, 18)))
    rows, keys, kind = [], [], 0

    def add(at: np.ndarray, *parts: tuple[np.ndarray, int]) -> None:
        nonlocal kind
        key = np.zeros(len(at), dtype=np.int64)
        for value, width in parts:
            key = key << width | value
        rows.append(at)
        keys.append(kind << 48 | key)
        kind += 1

    every = np.arange(len(v))
    halves = lambda x, low, high: ((x & ((1 << low) - 1), low), (x >> low, high))
    for one, two in ((a, b), (b, a)):
        at, code = segment_keys(one)
        add(at, (two[at], 23), (code, 12))
        for part, width in halves(two, 11, 12):
            add(at, (c[at], 18), (part[at], width), (code, 12))
        add(every, (two, 23), (c, 18))
    at, code = segment_keys(a)
    for part, width in halves(b, 11, 12):
        for other, w in halves(c, 9, 9):
            add(at, (part[at], width), (other[at], w), (code, 12))
    return np.concatenate(rows), np.concatenate(keys)


def linked_trees(key: np.ndarray, value: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (each of two values within `distance`) that join what is linked within each run of equal keys, as trees.

    `key` is sorted. Runs of two or three are done together; longer ones one at a time.
    """
    bounds = np.flatnonzero(np.diff(key)) + 1
    starts, sizes = np.concatenate(([0], bounds)), np.diff(np.concatenate(([0], bounds, [len(key)])))
    left, right = [], []
    few = starts[(sizes > 1) & (sizes <= 3)]
    third = starts[sizes == 3]
    for p, i, j in ((few, 0, 1), (third, 0, 2), (third, 1, 2)):
        x, y = value[p + i], value[p + j]
        near = np.bitwise_count(x ^ y) <= distance
        left.append(x[near])
        right.append(y[near])
    for s, n in zip(starts[sizes > 3].tolist(), sizes[sizes > 3].tolist()):
        own = value[s : s + n]
        todo = np.ones(n, dtype=bool)
        while todo.any():  # breadth first from the first that is left
            front = np.flatnonzero(todo)[:1]
            todo[front] = False
            while len(front):
                rest = np.flatnonzero(todo)
                if not len(rest):
                    break
                near = np.bitwise_count(own[front[:256], None] ^ own[rest]) <= distance
                hit = near.any(axis=0)
                left.append(own[front[:256]][near[:, hit].argmax(axis=0)])
                right.append(own[rest[hit]])
                todo[rest[hit]] = False
                front = np.concatenate((front[256:], rest[hit]))
    return np.concatenate(left or [value[:0]]), np.concatenate(right or [value[:0]])


def _linker(distance: int):
    def run(batches):
        """Links within the runs of equal keys of a partition that is sorted by key."""
        held_key, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.concatenate((held_key, batch.column(0).to_numpy()))
            value = np.concatenate((held, batch.column(1).to_numpy().view(np.uint64)))
            cut = int(np.searchsorted(key, key[-1], side="left")) if len(key) else 0
            held_key, held = key[cut:], value[cut:]  # the last run may go on; it has MOST members at most
            if cut:
                yield _edges(*linked_trees(key[:cut], value[:cut], distance))
        if len(held):
            yield _edges(*linked_trees(held_key, held, distance))

    return run


def _edges(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])


def _keyed(batches):
    for batch in batches:
        value = batch.column(0).to_numpy().view(np.uint64)
        for s in range(0, len(value), 4096):
            own = value[s : s + 4096]
            rows, keys = golay_keys(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[rows].view(np.int64))], names=["key", "print"])


def _hung(batches):
    """Each fingerprint with the words at up to two bits from it, `one` telling those at one bit at most."""
    bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    two = np.array([x | y for x, y in combinations(bit.tolist(), 2)], dtype=np.uint64)
    flips = np.concatenate(([np.uint64(0)], bit, two))
    one = np.arange(len(flips)) <= 64
    for batch in batches:
        for v in batch.column(0).to_numpy().view(np.uint64):
            word = (v ^ flips).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(np.full(len(word), v.view(np.int64))), pa.array(one)], names=["word", "print", "one"])


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (long column `print`) that connect just what chains of pairs within
    `DISTANCE` bits connect; the keys and the way of hot ones hold for that distance alone."""
    keyed = prints.mapInArrow(_keyed, "key long, print long")  # cheaper to make twice than to store
    counts = keyed.groupBy("key").count().where(F.col("count") > MOST).select("key")
    hot = saved(counts, "hot")
    rest = keyed
    if hot.take(1):
        rest = keyed.join(hot, "key", "left_anti")
        members = keyed.join(hot, "key", "left_semi").select("print").distinct()
        hung = members.repartition("print").mapInArrow(_hung, "word long, print long, one boolean")
        centre = hung.groupBy("word").agg(F.min(F.when(F.col("one"), F.col("print"))).alias("a"), F.count("*").alias("n")).where("n > 1 AND a IS NOT NULL")
        stars = hung.join(centre, "word").where("a <> print").select("a", F.col("print").alias("b")).distinct()
    near = rest.repartition("key").sortWithinPartitions("key").mapInArrow(_linker(DISTANCE), "a long, b long")
    return near.union(stars) if rest is not keyed else near


def printed(df: DataFrame, size: int = 3, text: str = "text", out: str = "__print") -> DataFrame:
    """Add the fingerprint as a long."""

    def make():
        return lambda piece: [pa.array(fingerprints(piece.column(text).to_pylist(), size).view(np.int64))]

    return extend(df, text, [T.StructField(out, T.LongType(), False)], make)


@shielding
def grouped(df: DataFrame, size: int = 3, text: str = "text", doc_id: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """All rows of `df` with `fingerprint` (16 hex digits) and `component_id`, the least id of the row's component.

    Columns of `df` with those names are replaced. `keep_text=False` drops the texts once they are hashed.
    """
    return _named(df, size, text, doc_id, keep_text).drop("__row")


@shielding
def deduplicated(df: DataFrame, size: int = 5, least: float = 0.8, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each group of near-duplicates, that of the least id; of rows with the same id any one, but only one.

    Texts are near-duplicates if the Jaccard similarity of their sets of shingles of `size` words (A-Z in lower case) is
    `least` or more; groups are what chains of such pairs connect. Texts of equal sets are one from the start.

    Fingerprints within `DISTANCE` bits, met by their Golay keys, give the first pairs. Sets that are just similar enough
    differ in about ten bits, so these are not all. The others are found by exact prefix filtering: with all shingles in
    one order, the first shingle that two similar sets share stands among the first n - ceil(least * n) + 1 of each. Any
    order will do; the common ones of a sample of texts stand last, so that a line that many texts hold brings few of them
    together. Every pair is verified exactly.

    In a group of up to `FEW` texts of one key all pairs are compared. In a larger one they are compared with a few of
    them first; then all pairs that verified ones do not connect by then are compared. Sketches go first: the parities of a set's
    shingles in classes, about as many as it has shingles. Two sets differ in as many shingles at least as their sketches
    in bits, so only pairs that pass, nearly all of them similar, fetch their shingles.

    Results: texts without words are copies of one another. Null ids stand behind all others. All columns
    keep their names and values. An empty table gives an empty one.
    """
    common, ranks = common_shingles(df, text, size)

    def make():
        def work(piece: pa.RecordBatch) -> list:
            lists = [shingle_hashes(t or "", size) for t in piece.column(text).to_pylist()]
            sets = [np.unique(np.array(x, dtype=np.uint64)) for x in lists]
            sketches = list(map(sketch, sets))
            digests = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64)
            return [
                pa.array(digests.view(np.int64)),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array([leading(s, common, ranks, least).tobytes() for s in sets], pa.binary()),
                pa.array(majorities(lists).view(np.int64)),
                pa.array([s.tobytes() for s in sketches], pa.binary()),
                pa.array([folded(s, SKETCH // 64).view(np.int64) for s in sketches], pa.list_(pa.int64())),
            ]

        return work

    fields = [("__set", T.LongType()), ("__size", T.IntegerType()), ("__keys", T.BinaryType()), ("__print", T.LongType()), ("__sketch", T.BinaryType()), ("__small", T.ArrayType(T.LongType()))]
    hashed = extend(df, text, [T.StructField(n, t) for n, t in fields], make)
    hashed = saved(hashed.withColumn("__row", F.monotonically_increasing_id()), "prints")
    place = F.struct(_place(doc_id).alias("at"), F.col("__print").alias("print"))
    nodes = hashed.groupBy("__set", "__size").agg(F.min(place).alias("first")).select(F.col("first.at").alias("least"), F.col("first.at.row").alias("node"), F.col("first.print").alias("print"))
    nodes = saved(nodes, "nodes")
    texts, marks = hashed.select("__row", text), hashed.select("__row", "__size", "__sketch")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
        near = saved(may_be_similar(pairs, marks, least), "candidates")
        return saved(similar(near, texts, text, size, least), "similar")

    # Nodes of one fingerprint are hung on the least of them, and these on each other.
    homes = saved(nodes.groupBy("print").agg(F.min("node").alias("home")), "homes")
    same = nodes.join(homes, "print").select(F.col("home").alias("a"), F.col("node").alias("b"))
    near = links(homes.select("print"))
    for end in ("a", "b"):
        near = near.join(homes.select(F.col("print").alias(end), F.col("home").alias(f"home_{end}")), end)
    linked = same.union(near.select("home_a", "home_b"))

    keyed = hashed.select("__row", "__size", "__keys").join(nodes.select(F.col("node").alias("__row")), "__row", "left_semi").mapInArrow(_led, _KEYED)
    met = saved(_by_key(keyed, _met(least, FEW), _KEYED + ", other long"), "met")
    edges = verified(linked.union(met.where("other IS NOT NULL").select("node", "other")))
    roots = components(edges)
    large = met.where("other IS NULL").drop("other")
    if large.take(1):
        large = saved(large.join(hashed.select(F.col("__row").alias("node"), F.col("__small").alias("sketch")), "node"), "large")
        for i in range(ROUNDS + 1):
            labelled = large.join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).select("key", "node", "size", "place", "label", "sketch")
            edges = edges.union(verified(_by_key(labelled, _apart(least, i if i < ROUNDS else None), "a long, b long")))
            roots = components(edges)
    groups = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = groups.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.row").alias("__row"))
    return hashed.join(kept, "__row", "left_semi").select(*df.columns)


#: Texts of one key all of whose pairs are compared at once.
FEW = 64
#: Rounds in which the texts of a larger group are compared with `PIVOTS` of them, before all pairs that are still apart.
ROUNDS, PIVOTS = 1, 24
#: One text in `PART` tells which shingles are common: those in `COMMON` of these texts, `MOST_COMMON` shingles at most.
PART, COMMON, MOST_COMMON = 32, 3, 1 << 18
#: Classes of shingles in the least sketch, which stands for any set in large groups; a power of two.
SKETCH = 512
#: Pairs that a task looks at or gives out at once.
PAIRS = 1 << 17

_KEYED = "key long, node long, size int, place int"


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text or "", size), dtype=np.uint64))


def sketch(own: np.ndarray) -> np.ndarray:
    """Whether the number of shingles in each class is odd, as 64-bit words; the classes are a power of two, not under
    the number of shingles."""
    classes = max(SKETCH, 1 << max(0, len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(words: np.ndarray, n: int) -> np.ndarray:
    """The same sketch with the classes of `n` words, a power of two."""
    return np.bitwise_xor.reduce(words.reshape(-1, n), axis=0)


def may_be_similar(edges: DataFrame, marks: DataFrame, least: float) -> DataFrame:
    """The edges whose sizes and sketches (`__row`, `__size`, `__sketch`) allow a similarity of `least`."""

    def run(batches):
        for batch in batches:
            sizes = batch.column("m").to_numpy() + batch.column("n").to_numpy()
            most = (1 - least) / (1 + least) * sizes + 1e-6
            keep = np.abs(batch.column("m").to_numpy() - batch.column("n").to_numpy()) <= most
            for i in np.flatnonzero(keep).tolist():
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint64) for c in ("x", "y"))
                n = min(len(x), len(y))
                keep[i] = np.bitwise_count(folded(x, n) ^ folded(y, n)).sum() <= most[i]
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    pairs = edges.join(marks.toDF("a", "m", "x"), "a").join(marks.toDF("b", "n", "y"), "b")
    return pairs.select("a", "b", F.col("m").cast("long").alias("m"), F.col("n").cast("long").alias("n"), "x", "y").mapInArrow(run, "a long, b long")


def common_shingles(df: DataFrame, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles of a sample, sorted, and the place of each in the order of their counts. They decide how many
    candidates there are, but not which pairs are found."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, text):
                sets = [shingle_set(t, size).view(np.int64) for t in piece.column(text).to_pylist()]
                owner = np.repeat(piece.column("t").to_numpy(), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets)), pa.array(owner)], names=["key", "t"])

    sample = df.select(F.col(text), F.xxhash64(text).alias("t")).where(F.pmod("t", F.lit(PART)) == 0)
    counts = sample.mapInArrow(run, "key long, t long").groupBy("key").agg(F.count("*").alias("n"), F.min("t").alias("x"), F.max("t").alias("y"))
    rows = counts.where((F.col("n") >= COMMON) & (F.col("x") != F.col("y"))).orderBy(F.desc("n"), "key").limit(MOST_COMMON).select("key").toPandas()
    keys = rows["key"].to_numpy(dtype=np.int64).view(np.uint64)[::-1]
    order = np.argsort(keys)
    return keys[order], order


def leading(own: np.ndarray, common: np.ndarray, ranks: np.ndarray, least: float) -> np.ndarray:
    """The first shingles of a sorted set, of which a set of similarity `least` or more shares one with its own first."""
    if not len(own):
        return own
    want = len(own) - math.ceil(least * len(own) - 1e-9) + 1
    if not len(common):
        return own[:want]
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    known = common[at] == own
    rare = own[~known]
    if len(rare) < want:
        rare = np.concatenate((rare, own[known][np.argsort(ranks[at[known]])]))
    return rare[:want]


def _led(batches):
    """A row for each leading shingle of a text, with its place among them."""
    for batch in batches:
        for piece in slices(batch, "__keys"):
            lists = [np.frombuffer(x, dtype=np.int64) for x in piece.column("__keys").to_pylist()]
            counts = [len(x) for x in lists]
            places = np.concatenate([np.arange(n, dtype=np.int32) for n in counts])
            columns = [np.concatenate(lists), np.repeat(piece.column("__row").to_numpy(), counts), np.repeat(piece.column("__size").to_numpy(), counts), places]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", "size", "place"])


def _by_key(keyed: DataFrame, run, schema: str) -> DataFrame:
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


def _whole_runs(batches):
    """The columns of a partition that is sorted by its first, cut where that changes; with the starts and sizes of its runs."""
    held: list[list[np.ndarray]] = []

    def joined():
        columns = [np.concatenate(c) for c in zip(*held)]
        starts = np.concatenate(([0], np.flatnonzero(np.diff(columns[0])) + 1))
        return columns, starts, np.diff(np.concatenate((starts, [len(columns[0])])))

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy() if pa.types.is_primitive(c.type) else c.flatten().to_numpy().reshape(batch.num_rows, -1) for c in batch.columns]
        cut = int(np.searchsorted(columns[0], columns[0][-1], side="left"))
        if held and cut == 0 and held[-1][0][-1] != columns[0][0]:
            yield joined()
            held = []
        if cut:
            held.append([c[:cut] for c in columns])
            yield joined()
            held = []
        held.append([c[cut:] for c in columns])
    if held:
        yield joined()


def _may(size, place, i, j, least: float) -> np.ndarray:
    """Whether the sets, if this is the first shingle that they share, are large enough behind it to be similar."""
    need = least / (1 + least) * (size[i].astype(np.int64) + size[j]) - 1e-6
    return np.minimum(size[i] - place[i], size[j] - place[j]) >= need


def _met(least: float, few: int):
    def run(batches):
        """Pairs (node, other) of the runs of up to `few`; the rows of larger ones as they are, with `other` null."""
        for (key, node, size, place), starts, sizes in _whole_runs(batches):
            for n in np.unique(sizes[(sizes > 1) & (sizes <= few)]).tolist():
                left, right = np.triu_indices(n, 1)
                own = starts[sizes == n]
                step = max(1, PAIRS // len(left))
                for s in range(0, len(own), step):
                    i, j = (own[s : s + step, None] + left).ravel(), (own[s : s + step, None] + right).ravel()
                    good = _may(size, place, i, j, least)
                    i, j = i[good], j[good]
                    yield pa.RecordBatch.from_arrays([pa.array(c[i]) for c in (key, node, size, place)] + [pa.array(node[j])], names=["key", "node", "size", "place", "other"])
            many = np.repeat(sizes > few, sizes)
            if many.any():
                columns = [pa.array(c[many]) for c in (key, node, size, place)]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(int(many.sum()), pa.int64())], names=["key", "node", "size", "place", "other"])

    return run


def _apart(least: float, turn: int | None):
    def run(batches):
        """Pairs of different labels in each run: those with the pivots of this turn, or all without one."""
        for (_, node, size, place, label, marks), starts, sizes in _whole_runs(batches):
            for s, n in zip(starts.tolist(), sizes.tolist()):
                every = np.arange(s, s + n)
                if turn is None:
                    # Those of the most frequent label need no comparing with one another.
                    names, at, counts = np.unique(label[every], return_inverse=True, return_counts=True)
                    first = every[at != counts.argmax()]
                else:
                    mixed = (node[every].astype(np.uint64) + np.uint64(turn * 0x632BE59BD9B4E019 & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
                    mixed ^= mixed >> np.uint64(29)
                    first = every[np.argsort(mixed * np.uint64(0xBF58476D1CE4E5B9))[:PIVOTS]]
                step = max(1, PAIRS // n)
                for f in range(0, len(first), step):
                    i, j = np.repeat(first[f : f + step], n), np.tile(every, len(first[f : f + step]))
                    good = (label[i] != label[j]) & _may(size, place, i, j, least)
                    i, j = i[good], j[good]
                    good = np.bitwise_count((marks[i] ^ marks[j]).view(np.uint64)).sum(axis=1) <= (1 - least) / (1 + least) * (size[i].astype(np.int64) + size[j]) + 1e-6
                    yield _edges(node[i[good]], node[j[good]])

    return run


#: Rows whose ids are broadcast at most, as eight bytes each, to fetch their texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def similar(edges: DataFrame, texts: DataFrame, text: str, size: int, least: float) -> DataFrame:
    """The edges (a, b), of row numbers, whose texts' sets of shingles have a Jaccard similarity of `least` or more."""
    ids = saved(edges.select(F.col("a").alias("__row")).union(edges.select("b")).distinct(), "ends")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def shingled(batches):
        for batch in batches:
            for piece in slices(batch, text):
                lists = [shingle_hashes(t or "", size) for t in piece.column(text).to_pylist()]
                sets = [np.unique(np.array(x, dtype=np.uint64)).tobytes() for x in lists]
                yield pa.RecordBatch.from_arrays([piece.column("__row"), pa.array(sets, pa.binary())], names=["row", "shingles"])

    def compared(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both >= least * (len(a) + len(b) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    sets = saved(texts.join(wanted, "__row", "left_semi").mapInArrow(shingled, "row long, shingles binary"), "shingles")
    pairs = edges.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return pairs.select("a", "b", "x", "y").mapInArrow(compared, "a long, b long")


def _place(doc_id: str):
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("__row").alias("row"))


def _named(df: DataFrame, size: int, text: str, doc_id: str, keep_text: bool) -> DataFrame:
    hashed = printed(df.drop("fingerprint", "component_id"), size, text)
    # The numbers are stored with the rows, so they stay the same ever after.
    hashed = saved((hashed if keep_text else hashed.drop(text)).withColumn("__row", F.monotonically_increasing_id()), "prints")
    nodes = saved(hashed.groupBy("__print").agg(F.min(_place(doc_id)).alias("__least")), "nodes")
    roots = components(links(nodes.select(F.col("__print").alias("print"))))
    # The least id of each component, over its distinct fingerprints.
    homes = nodes.join(roots.withColumnRenamed("node", "__print"), "__print", "left").withColumn("root", F.coalesce("root", "__print"))
    least = homes.groupBy("root").agg(F.min("__least").alias("least"))
    named = homes.join(least, "root").select("__print", F.col("least.id").alias("component_id"))
    return hashed.join(named, "__print", "left").withColumn("fingerprint", F.lower(F.lpad(F.hex("__print"), 16, "0"))).drop("__print")
