"""Byte-level BPE by corpus-level merge replay.

Texts are cut into chunks; each worker keeps a lexicon from chunk to ids. For the chunks that a batch brings new,
all their distinct pieces are laid out in one token array, with an inverted index from the rank of each adjacent
pair to the positions that hold it. Ranks are replayed in rising order, each over all its positions at once; a
merge changes only the pairs of its two neighbours, and these alone are filed again in the index. Merges never
cross pieces, so the replay over any part of the corpus gives what a replay over all of it would; no word list
grows with the corpus, is shuffled or is broadcast.

Results: a null text is encoded like an empty one, as no ids. Ids are held as little-endian unsigned 32-bit
integers in a binary column, which `decode` turns back to bytes exactly. Repeated rows give equal rows.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from terrane.llm.arrow import extend, worker_state
from terrane.llm.pieces import Lexicon

#: Entries of a worker's lexicon; beyond them it starts anew (speed only, never the result).
LEXICON_ENTRIES = 300_000
#: Bytes of text that share one replay.
BLOCK_BYTES = 4 << 20

_NONE = np.int32(2**31 - 1)
_SHIFT = 21


class Vocabulary:
    """Ranks of a tiktoken file, and the rank of each pair of tokens that joins to a token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        if any(bytes([b]) not in ranks for b in range(256)) or max(ranks.values()) >= 1 << _SHIFT:
            raise ValueError("a byte-level vocabulary has all 256 bytes, and ranks below 2**21")
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << _SHIFT | b] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.joined = np.array([pairs[k] for k in self.keys.tolist()] or [0], dtype=np.int32)[: len(self.keys)]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair joins to; `_NONE` where it joins to no token."""
        if not len(self.keys):
            return np.full(len(left), _NONE)
        key = left.astype(np.int64) << _SHIFT | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.joined[at], _NONE)

    def merge_one(self, word: bytes) -> list[int]:
        """The plain rule for one word: merge the lowest rank, leftmost first, until none is left."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, _NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == _NONE:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(words) else 0
        if not n:
            return [b""] * len(words)
        # Position n stands for the edge of a word.
        token = np.append(self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)], np.int32(-1))
        after = np.arange(1, n + 2, dtype=np.int64)
        before = np.arange(-1, n, dtype=np.int64)
        after[ends[sizes > 0] - 1] = n
        before[(ends - sizes)[sizes > 0]] = n
        after[n] = n
        rank = np.full(n + 1, _NONE, dtype=np.int32)
        inner = np.flatnonzero(after[:n] < n)
        rank[inner] = self.pair_ranks(token[inner], token[after[inner]])
        alive = np.ones(n, dtype=bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def file(positions: np.ndarray) -> None:
            ranks = rank[positions]
            positions, ranks = positions[ranks != _NONE], ranks[ranks != _NONE]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for r, group in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(positions, cuts) if len(cuts) else [positions]):
                if r in index:
                    index[r].append(group)
                else:
                    index[r] = [group]
                    heapq.heappush(heap, r)

        file(inner)
        odd: list[np.ndarray] = []
        while heap:
            r = heapq.heappop(heap)
            groups = index.pop(r)
            at = np.unique(np.concatenate(groups)) if len(groups) > 1 else groups[0]
            at = at[rank[at] == r]
            if not len(at):
                continue
            second = after[at]
            if len(at) > 1 and (chained := second[:-1] == at[1:]).any():
                # In a chain such as "aaaa" every other pair is taken, from the left.
                start = np.maximum.accumulate(np.where(np.concatenate(([True], ~chained)), np.arange(len(at)), 0))
                taken = (np.arange(len(at)) - start) % 2 == 0
                at, second = at[taken], second[taken]
            follow = after[second]
            token[at] = r
            after[at] = follow
            before[follow] = at
            rank[second] = _NONE
            alive[second] = False
            right = follow < n
            rank[at] = _NONE
            rank[at[right]] = self.pair_ranks(token[at[right]], token[follow[right]])
            left = before[at]
            left = left[left < n]
            rank[left] = self.pair_ranks(token[left], token[after[left]])
            touched = np.concatenate((at, left))
            if (early := rank[touched] < r).any():
                odd.append(touched[early])
            file(touched)
        ids = token[:n][alive].astype("<u4")
        bounds = np.concatenate(([0], np.cumsum(alive)))[np.concatenate((ends - sizes, [n]))]
        raw, cut = ids.tobytes(), (bounds * 4).tolist()
        out = [raw[a:b] for a, b in zip(cut, cut[1:])]
        if odd:  # a merge made a pair of lower rank: such words, if any, follow the plain rule
            for w in np.unique(np.searchsorted(ends, np.concatenate(odd), side="right")).tolist():
                out[w] = np.array(self.merge_one(words[w]), dtype="<u4").tobytes()
        return out


def split_pattern(pattern: str) -> regex.Pattern:
    r"""The pattern with `\s` spelt out as Unicode's White_Space, as the Rust engine of tiktoken has it."""
    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))


def lexicon(words: Vocabulary, pattern: str) -> Lexicon:
    split = split_pattern(pattern)

    def ids_of(texts: list[str]) -> list[bytes]:
        """Replay the merges over all distinct pieces of the texts."""
        found = list(map(split.findall, texts))
        distinct = list({w for pieces in found for w in pieces})
        ids = dict(zip(distinct, words.replay([w.encode() for w in distinct])))
        return [b"".join(map(ids.__getitem__, pieces)) for pieces in found]

    return Lexicon(ids_of, LEXICON_ENTRIES)


class Codec:
    """A worker's vocabulary and, once it encodes, its lexicon of a pattern."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.lexicons: dict[str, Lexicon] = {}

    def encode(self, texts: pa.Array, pattern: str) -> tuple[np.ndarray, np.ndarray]:
        if pattern not in self.lexicons:
            self.lexicons = {pattern: lexicon(self.vocabulary, pattern)}
        return self.lexicons[pattern].encode(texts)


def codec(path: str) -> Codec:
    return worker_state(f"bpe {path}", lambda: Codec(path))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the binary column `ids`: the ids of the whole text. `path`: a tiktoken rank file that workers can read."""

    def make():
        known = codec(path)

        def work(piece: pa.RecordBatch) -> list:
            ids, cuts = known.encode(piece.column(text), pattern)
            return [pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * 4).astype(np.int32)), pa.py_buffer(ids)])]

        return work

    return extend(df, text, [T.StructField(ids, T.BinaryType(), False)], make, BLOCK_BYTES)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the binary column `decoded`: the bytes of all tokens, joined. Null ids give no bytes; an id that is
    not of the vocabulary is an error."""

    def make():
        tokens = codec(path).vocabulary.tokens

        def work(piece: pa.RecordBatch) -> list:
            return [[b"".join(map(tokens.__getitem__, np.frombuffer(x or b"", dtype="<u4").tolist())) for x in piece.column(ids).to_pylist()]]

        return work

    return extend(df, ids, [T.StructField(decoded, T.BinaryType(), False)], make)
