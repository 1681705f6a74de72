"""Cutting texts where no token of the byte-level pattern can cross."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Bytes that are white space by themselves.
_SPACE = np.array([b < 128 and chr(b).isspace() for b in range(256)])
#: Other white space, as the bytes of UTF-8.
_WIDE = [chr(c).encode() for c in range(128, 0x3001) if chr(c).isspace()]


def chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The texts cut before each single space that follows a non-space, and the number of chunks of each text; null is
    like an empty text, which has none.

    The splitting pattern looks ahead only over white space and takes a space only together with what follows it, so each
    chunk splits into the same pieces alone as inside the text. Only offsets are made; the bytes are shared.
    """
    texts = texts.cast(pa.string()).fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    low = int(ends[0])
    own = np.frombuffer(data, dtype=np.uint8)[low : int(ends[-1])] if data else np.zeros(0, np.uint8)
    at = np.flatnonzero(own == 32)
    at = at[at > 0]
    before = own[at - 1]
    keep = ~_SPACE[before]
    wide = np.flatnonzero(before >= 128)
    if len(wide):
        p, spaces = at[wide], np.zeros(len(wide), dtype=bool)
        for mark in _WIDE:
            hit = p >= len(mark)
            for j, byte in enumerate(reversed(mark)):
                hit &= own[np.maximum(p - 1 - j, 0)] == byte
            spaces |= hit
        keep[wide[spaces]] = False
    cut = np.zeros(len(own) + 1, dtype=bool)
    cut[at[keep]] = True
    cut[ends - low] = True
    bounds = np.flatnonzero(cut)
    counts = np.diff(np.searchsorted(bounds, ends - low))
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer((bounds + low).astype(np.int32)), data]), counts


class Lexicon:
    """Ids of the chunks that a worker has met.

    `ids_of` gives the ids of a list of strings, as little-endian unsigned 32-bit integers. Long chunks are forgotten
    at once, and when there are more than `entries`, those that were not met lately: this bounds memory and changes no result.
    """

    LONG = 200

    def __init__(self, ids_of: Callable[[list[str]], list[bytes]], entries: int):
        self.ids_of, self.entries = ids_of, entries
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after another, and where each text's begin (and, last, their number)."""
        if len(self.known) > self.entries // 2:
            self.known, self.older = {}, self.known
        parts, counts = chunks(texts)
        coded = parts.dictionary_encode()
        words, known = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        new = [w for w in words if w not in known]
        if self.older:
            older = self.older
            known.update((w, older[w]) for w in new if w in older)
            new = [w for w in new if w not in known]
        known.update(zip(new, self.ids_of(new)))
        each = [known[w] for w in words]
        for w in new:
            if len(w) > self.LONG:
                del known[w]
        sizes = np.fromiter(map(len, each), dtype=np.int64, count=len(each)) // 4
        flat, which = np.frombuffer(b"".join(each), dtype="<u4"), coded.indices.to_numpy()
        held = sizes[which]
        ends = np.concatenate(([0], np.cumsum(held)))
        # The ids of the words, in the order in which these stand in the texts.
        place = np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], held) + np.arange(ends[-1])
        return flat[place], ends[np.concatenate(([0], np.cumsum(counts)))]
