"""Repeated passages, by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte is removed if a string of `least` bytes that covers it starts at any other place of the corpus too. No task holds the
corpus. Each string of `least` bytes has one minimizer: the leftmost of its k-grams of the least hash. Equal strings
have equal minimizers at equal offsets, so the starts of a text, cut to runs of one minimizer, make contexts (a run of
starts with the bytes that their strings cover), and two equal strings stand in contexts of one minimizer. So:

1. Hashes of minimizers are counted; contexts of one that occurs once have no repeat.
2. Equal contexts of a hash are counted together. One that occurs twice repeats at each of its starts. A hash of several
   contexts, one of them single, needs the bytes of each different one, once.
3. These are dealt by hash to blocks of bounded bytes. A block's suffixes are put in order, which gives the transform, and
   intervals are expanded backwards, breadth first: those of strings of n symbols set the common prefixes of value n - 1
   that were not set, and only these are carried on (the values below seven can be read from the first sort). The expansion ends at `least`. Neighbours
   in order whose common prefix was not set by then share `least` bytes; as every start is in one context, both repeat.
4. A hash of more than `MOST` different contexts does not meet in one task: the strings of its contexts, which are few
   for each, are counted by 128-bit digests.

Texts travel under a 64-bit key of id and text; whatever comes back to a text is checked against its bytes, so collisions
of keys do no harm. Contexts are equal by a 64-bit digest beside the 64-bit hash of their minimizer.

Results: null texts are like empty ones. Texts shorter than `least` stay whole. Repeated rows are rows of their own, so
equal texts of `least` bytes or more are removed wholly, each of them. Null and equal ids change nothing. An
empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm.arrow import extend, shielding, slices
from terrane.llm.storage import saved

LEAST = 200
#: Bytes of contexts that one block holds, about.
BLOCK_BYTES = 1 << 20
#: Different contexts of one minimizer that meet in a task.
MOST = 4096
#: Bytes of text that are hashed at once.
SLICE = 1 << 20
#: Windows of one text that are looked at together; places among them take 24 bits.
PIECE = 1 << 23
_MASK = np.uint64((1 << 24) - 1)


def gram(least: int) -> int:
    """The length of the k-grams: the power of two up to a third of `least`."""
    return 1 << max(0, (least // 3).bit_length() - 1)


def contexts(data: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the minimizer, first start and last start of each context of texts that stand one after another, with their
    bounds `ends` (0 first)."""
    found = [_contexts(data[a : a + PIECE + least - 1], ends - a, a, least) for a in range(0, max(1, len(data) - least + 1), PIECE)]
    return tuple(np.concatenate(x) for x in zip(*found))  # type: ignore[return-value]


def _contexts(data: np.ndarray, ends: np.ndarray, base: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k, none = gram(least), np.zeros(0, dtype=np.int64)
    windows = len(data) - least + 1
    if windows < 1:
        return none.astype(np.uint64), none, none
    # Polynomial hashes of all k-grams by doubling, then mixed.
    hashed, length, power = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while length < k:
        hashed = hashed[:-length] * np.uint64(power) + hashed[length:]
        length, power = 2 * length, power * power % 2**64
    hashed = (hashed ^ hashed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    hashed ^= hashed >> np.uint64(32)
    # The least of each window with its place, again by doubling.
    key = hashed & ~_MASK | np.arange(len(hashed), dtype=np.uint64)
    width, have = least - k + 1, 1
    while 2 * have <= width:
        key, have = np.minimum(key[:-have], key[have:]), 2 * have
    if have < width:
        key = np.minimum(key[: len(key) - (width - have)], key[width - have :])
    # Windows that lie in one text.
    inside = np.zeros(windows + 1, dtype=np.int32)
    low, high = np.clip(ends[:-1], 0, windows), np.clip(ends[1:] - least + 1, 0, windows)
    full = high > low
    np.add.at(inside, low[full], 1)
    np.add.at(inside, high[full], -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]))
    if not len(at):
        return none.astype(np.uint64), none, none
    place = (key[at] & _MASK).astype(np.int64)
    cut = np.flatnonzero((place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut, [len(at)])) - 1
    return hashed[place[first]], at[first] + base, at[last] + base


def _anchors(least: int):
    """(key, at, anchor, digest) of the contexts of each text; `at` holds the first start and, in 16 bits, how many follow."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                texts = piece.column("text").fill_null(b"").cast(pa.large_binary())
                raw = b"".join(texts.to_pylist())
                sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
                anchor, first, last = contexts(np.frombuffer(raw, dtype=np.uint8), ends, least)
                own = np.searchsorted(ends, first, side="right") - 1
                hashed = xxhash.xxh3_64_intdigest
                digest = np.fromiter((hashed(raw[a : b + least]) for a, b in zip(first.tolist(), last.tolist())), dtype=np.uint64, count=len(first))
                keys = piece.column("__key").to_numpy(zero_copy_only=False)[own]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array((first - ends[own]) << 16 | last - first), pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64))], names=["key", "at", "anchor", "digest"])

    return run


def _cut(least: int):
    """The bytes of the contexts that a text is asked for: (anchor, digest, n, block, key, at, bytes)."""

    def run(batches):
        before = None
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for key, text, asked in zip(batch.column("__key").to_pylist(), batch.column("__text"), batch.column("__asked").to_pylist()):
                # Rows that are equal stand one after another, and one is enough.
                if (key, text) == before:
                    continue
                before, raw = (key, text), text.as_py() or b""
                for x in asked:
                    start = x["at"] >> 16
                    part = raw[start : start + (x["at"] & 0xFFFF) + least]
                    if np.uint64(xxhash.xxh3_64_intdigest(part)).view(np.int64) == x["digest"]:
                        for to, v in zip(out, (x["anchor"], x["digest"], x["n"], x["block"], key, x["at"], part)):
                            to.append(v)
            yield pa.RecordBatch.from_arrays([*[pa.array(v, pa.int64()) for v in out[:6]], pa.array(out[6], pa.binary())], names=["anchor", "digest", "n", "block", "key", "at", "part"])

    return run


def suffix_order(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of `codes` (0 to 256) in the order of at least `least` symbols from there on; and, by place in this order,
    whether it differs from the one before in its first seven symbols."""
    n = len(codes)
    key, padded = np.zeros(n, dtype=np.int64), np.concatenate((codes, np.zeros(7, dtype=np.int64)))
    for i in range(7):
        key = key << 9 | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    first, rank, length = new, np.empty(n, dtype=np.int64), 7
    rank[order] = np.cumsum(new) - 1
    while length < least:
        after = np.zeros(n, dtype=np.int64)
        after[: n - length] = rank[length:] + 1
        open_ = np.flatnonzero(~(new & np.concatenate((new[1:], [True]))))
        if not len(open_):
            break
        places = order[open_]
        key = rank[places] << 32 | after[places]
        by = np.argsort(key)
        order[open_], key = places[by], key[by]
        new = new.copy()
        new[open_] |= np.concatenate(([True], key[1:] != key[:-1]))
        rank[order] = np.cumsum(new) - 1
        length *= 2
    return order, first


def repeated(codes: np.ndarray, least: int) -> np.ndarray:
    """For each place of `codes` (0: a bound between texts, which stands first too) whether the `least` symbols from there
    on stand at another place too; of meaning only where none of these is a bound."""
    n = len(codes)
    order, begun = suffix_order(codes, least)
    bwt = codes[order - 1].astype(np.int16)
    by_symbol = np.argsort(bwt, kind="stable")
    step = np.empty(n, dtype=np.int64)  # from a row to the row of the suffix one symbol longer
    step[by_symbol] = np.arange(n)
    symbols = bwt[by_symbol]
    same = symbols[1:] == symbols[:-1]
    following = np.full(n, n)  # the next row of the same symbol
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    run_ends = np.flatnonzero(np.concatenate((bwt[1:] != bwt[:-1], [True])))
    run = np.zeros(n, dtype=np.int64)
    run[run_ends[:-1] + 1] = 1
    run = np.cumsum(run)
    ranked = symbols.astype(np.int64) * n + by_symbol

    # `known`: rows whose common prefix with the row before is set. `begun` sets those of values up to six.
    known = np.concatenate((begun, [True]))
    low = np.flatnonzero(begun)
    high = np.concatenate((low[1:], [n])) - 1
    if least < 7:
        raise ValueError("the shortest passage has seven bytes")
    for _ in range(7, least):
        # The last row of each symbol in each interval: the ends of its runs there that no row of the same symbol follows.
        count = run[high] - run[low] + 1
        total = int(count.sum())
        if not total:
            break
        own = np.repeat(np.arange(len(count)), count)
        ends = run_ends[np.arange(total) - np.repeat(np.cumsum(count) - count, count) + run[low][own]]
        ends = np.minimum(ends, high[own])
        last = (following[ends] > high[own]) & (bwt[ends] != 0)
        ends, own = ends[last], own[last]
        to = step[ends]
        new = ~known[to + 1]
        ends, own, to = ends[new], own[new], to[new]
        known[to + 1] = True
        low, high = np.searchsorted(ranked, bwt[ends].astype(np.int64) * n + low[own]), to
    alike = np.flatnonzero(~known[:n])
    hit = np.zeros(n, dtype=bool)
    hit[order[alike]] = True
    hit[order[alike - 1]] = True
    return hit


_RUNS = T.ArrayType(T.StructType([T.StructField("low", T.IntegerType()), T.StructField("high", T.IntegerType())]))


def _runs(hit: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [{"low": a, "high": b - 1} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def _expanded(least: int):
    """(key, at, digest, runs) of the single contexts of one block that hold repeats: runs of their starts."""

    def run(table: pa.Table) -> pa.Table:
        rows = {(a, d): (n, key, at, part) for a, d, n, key, at, part in zip(*[table.column(c).to_pylist() for c in ("anchor", "digest", "n", "key", "at", "part")])}
        parts = [np.frombuffer(x[3], dtype=np.uint8) for x in rows.values()]
        sizes = np.array([len(p) for p in parts])
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1] + 1
        codes = np.zeros(int(sizes.sum()) + len(parts) + 1, dtype=np.int64)
        for b, p in zip(begin.tolist(), parts):
            codes[b : b + len(p)] = p.astype(np.int64) + 1
        hit = repeated(codes, least)
        out: list[list] = [[], [], [], []]
        for (_, digest), (n, key, at, part), b in zip(rows, rows.values(), begin.tolist()):
            if n == 1 and (runs := _runs(hit[b : b + len(part) - least + 1])):
                for to, v in zip(out, (key, at, digest, runs)):
                    to.append(v)
        kinds = [pa.int64()] * 3 + [pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))]
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds)], names=["key", "at", "digest", "runs"])

    return run


def _strings(least: int):
    """(key, at, digest, n, place, x, y): the digest of each string of each context."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "part", 1 << 16):
                out: list[list] = [[] for _ in range(7)]
                for key, at, digest, n, part in zip(*[piece.column(c).to_pylist() for c in ("key", "at", "digest", "n", "part")]):
                    for i in range(len(part) - least + 1):
                        both = np.frombuffer(xxhash.xxh3_128_digest(part[i : i + least]), dtype=np.int64)
                        for to, v in zip(out, (key, at, digest, n, i, int(both[0]), int(both[1]))):
                            to.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], names=["key", "at", "digest", "n", "place", "x", "y"])

    return run


def _marked(least: int):
    def make():
        def work(piece: pa.RecordBatch) -> list:
            spans, kept = [], []
            for text, marks in zip(piece.column("__text"), piece.column("__marks")):
                raw = text.as_py() or b""
                covered = np.zeros(len(raw) + 1, dtype=np.int32)
                for m in marks.as_py() or ():
                    start, more = m["at"] >> 16, m["at"] & 0xFFFF
                    if np.uint64(xxhash.xxh3_64_intdigest(raw[start : start + more + least])).view(np.int64) != m["digest"]:
                        continue
                    for low, high in [(x["low"], x["high"]) for x in m["runs"]] if m["runs"] is not None else ((0, more),):
                        covered[start + low] += 1
                        covered[start + high + least] -= 1
                gone = np.cumsum(covered[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).tolist()
                spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
                kept.append(np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes() if edges else raw)
            return [spans, kept]

        return work

    return make


@shielding
def stripped(df: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, block_bytes: int = BLOCK_BYTES, most: int = MOST, keep_text: bool = True) -> DataFrame:
    """All rows and columns of `df` with `removed`, the runs of bytes (start, end) that repeat, and `kept`, the other bytes.

    Columns of `df` with those names are replaced; the text goes along only if `keep_text`."""
    others = [c for c in df.columns if c not in (text, "removed", "kept")]
    docs = df.select(*others, F.xxhash64(F.col(key), F.col(text)).alias("__key"), F.col(text).cast("binary").alias("__text"))
    every = docs.select("__key", F.col("__text").alias("text")).where(F.octet_length("text") >= least).mapInArrow(_anchors(least), "key long, at long, anchor long, digest long")
    # Tables of their own on the right of these joins, so that Spark can split the rows of a hot hash on the left.
    twice = saved(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "twice")
    places = saved(every.join(twice, "anchor", "left_semi"), "places")

    # Different contexts of a minimizer, with a place of each.
    each = saved(places.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.first("key").alias("key"), F.first("at").alias("at")), "contexts")
    groups = each.groupBy("anchor").agg(F.count("*").alias("of"), F.count_if(F.col("n") == 1).alias("single")).where("of > 1 AND single > 0")
    groups = saved(groups.select("anchor", "of"), "groups")
    wanted = each.join(groups, "anchor")
    size = F.expr(f"(at & 65535) + {least + 1}")
    counted = wanted.agg(F.sum(F.when(F.col("of") <= most, size)).alias("bytes"), F.count_if(F.col("of") > most).alias("hot")).first()
    blocks = max(1, -(-int(counted["bytes"] or 0) // block_bytes))
    block = F.when(F.col("of") > most, -1).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(blocks))).cast("long")
    asked = wanted.withColumn("block", block).groupBy(F.col("key").alias("__key")).agg(F.collect_list(F.struct("at", "anchor", "digest", "n", "block")).alias("__asked"))
    # All columns of the texts go along, so that Spark shuffles them by key once, for this join and the last one.
    parts = docs.join(asked, "__key").mapInArrow(_cut(least), "anchor long, digest long, n long, block long, key long, at long, part binary")
    some = T.StructType([*[T.StructField(c, T.LongType()) for c in ("key", "at", "digest")], T.StructField("runs", _RUNS)])
    marks = parts.where("block >= 0").groupBy("block").applyInArrow(_expanded(least), some)
    if counted["hot"]:
        strings = parts.where("block < 0").mapInArrow(_strings(least), "key long, at long, digest long, n long, place long, x long, y long")
        again = strings.groupBy("x", "y").agg(F.sum("n").alias("__n")).where("__n > 1")
        met = strings.where("n = 1").join(again, ["x", "y"], "left_semi").groupBy("key", "at", "digest").agg(F.array_sort(F.collect_set(F.col("place").cast("int"))).alias("p"))
        marks = marks.unionByName(met.select("key", "at", "digest", F.transform("p", lambda x: F.struct(x.alias("low"), x.alias("high"))).alias("runs")))
    # A context that occurs twice repeats at all its starts.
    whole = places.join(each.where("n > 1").select("anchor", "digest"), ["anchor", "digest"], "left_semi")
    marks = marks.unionByName(whole.select("key", "at", "digest", F.lit(None).cast(_RUNS).alias("runs")))
    by_text = marks.groupBy(F.col("key").alias("__key")).agg(F.collect_set(F.struct("at", "digest", "runs")).alias("__marks"))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    # What Python does not need to give back is replaced by what it makes.
    kept = "kept" if keep_text else "__text"
    made = extend(docs.join(by_text, "__key", "left"), "__text", [T.StructField("__marks", T.ArrayType(span)), T.StructField(kept, T.BinaryType())], _marked(least))
    own = [F.col("__text").cast(df.schema[text].dataType).alias(c) if c == text else F.col(c) for c in df.columns if c not in ("removed", "kept") and (keep_text or c != text)]
    return made.select(*own, F.col("__marks").alias("removed"), F.col(kept).alias("kept"))
