"""Language of texts by a linear-chain conditional random field over their words.

A word's features are its prefixes and suffixes of one to three letters, its letter bigrams and trigrams with the
word's edges, and, for words that the training sample has often, the word itself (the lexicon). The field labels every word
of a text with a language; learned transitions tell how likely the language changes from one word to the next, and the
forward-backward recursion gives each word's distribution. The text's language is the one with the largest mean.
All texts of a slice run through the recursion in step. A text of over `LONG` characters runs alone: the forward pass
keeps its state at every `CHUNK` words, the backward pass takes the chunks from the last to the first, so that besides the
text only four bytes a word and the scores of its distinct words are held; the probabilities are the same.

Training takes a bounded sample of labelled rows: for each of the `MOST_LABELS` most frequent labels about `DOCS` rows, the
least by a hash of their id, and of each row `WINDOW` words of its first `CHARS` characters. Sequences are spliced from
such windows, so the transitions see changes of language. The model (at most `FEATURES` features, a weight for
each label) is trained on the driver by gradient ascent of the likelihood and sent to the workers. Predictions run
over whole texts and use nothing but the text.

Results: `und` with score 0 if a text is null or has no letter, or if no row is labelled; else one of the learned labels
and the mean probability of that label over the words. Rows are independent; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
import uuid
from array import array
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm.arrow import extend, worker_state

UND = "und"
MOST_LABELS, DOCS, CHARS, WINDOW = 64, 400, 20_000, 60
FEATURES, LEXICON = 60_000, 20_000
ROUNDS, RATE, RIDGE = 60, 0.15, 1e-4
#: Bytes of text that run through the recursion together.
SLICE = 2 << 20
#: A text of more characters runs through the recursion alone, `CHUNK` words at a time.
LONG, CHUNK = 1 << 20, 1 << 14
#: Words whose scores a worker keeps.
KEPT_WORDS = 300_000

_LETTER = regex.compile(r"\p{L}")
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str) -> list[str]:
    w = f"^{word}$"
    found = [w[:2], w[:3], w[:4], w[-2:], w[-3:], w[-4:]]
    found += [w[i : i + 2] for i in range(1, len(w) - 2)]
    found += [w[i : i + 3] for i in range(len(w) - 2)]
    return found


class Model:
    """Labels, the index of features and lexicon words, and the weights."""

    def __init__(self, labels: list[str], index: dict[str, int]):
        self.name = uuid.uuid4().hex
        self.labels, self.index = labels, index
        self.weights = np.zeros((len(index) + 1, len(labels)))  # the last row is the bias
        self.moves = np.zeros((len(labels), len(labels)))

    def rows(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the features of each word, one after another, and where each word's begin."""
        get, bias = self.index.get, len(self.index)
        flat: list[int] = []
        starts = []
        for w in found:
            starts.append(len(flat))
            flat.append(bias)
            flat += [i for f in features(w) if (i := get(f)) is not None]
            if (i := get("=" + w)) is not None:
                flat.append(i)
        return np.array(flat, dtype=np.int64), np.array(starts, dtype=np.int64)

    def scores(self, found: list[str]) -> np.ndarray:
        if not found:
            return np.zeros((0, len(self.labels)))
        flat, starts = self.rows(found)
        return np.add.reduceat(self.weights[flat], starts, axis=0)


def marginals(scores: np.ndarray, moves: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many sequences in step.

    `scores`: label scores of all words, sequence after sequence, of `sizes` (positive) words. Gives each word's label
    probabilities, the expected counts of moves, and each sequence's log normaliser.
    """
    n, labels = scores.shape
    order = np.argsort(-sizes, kind="stable")
    long = sizes[order]
    starts = (np.cumsum(sizes) - sizes)[order]
    # Word t of all sequences that have one: a run of `live[t]` rows, the longest sequences first.
    live = np.searchsorted(-long, -np.arange(int(long[0])), side="left")
    offsets = np.concatenate(([0], np.cumsum(live)))
    at = np.empty(n, dtype=np.int64)
    step = np.repeat(np.arange(len(live)), live)
    at[:] = starts[np.arange(n) - offsets[step]] + step
    top = scores.max(axis=1)
    emit = np.exp(scores - top[:, None])[at]
    jump = np.exp(moves)
    alpha, scale = np.empty((n, labels)), np.empty(n)
    back = np.ones((n, labels))
    for t in range(len(live)):
        a, b = offsets[t], offsets[t + 1]
        own = emit[a:b] if t == 0 else (alpha[offsets[t - 1] : offsets[t - 1] + live[t]] @ jump) * emit[a:b]
        scale[a:b] = own.sum(axis=1)
        alpha[a:b] = own / scale[a:b, None]
    seen = np.zeros((labels, labels))
    for t in range(len(live) - 1, 0, -1):
        a, b, c = offsets[t], offsets[t + 1], offsets[t - 1]
        ahead = emit[a:b] * back[a:b] / scale[a:b, None]
        back[c : c + live[t]] = ahead @ jump.T
        seen += alpha[c : c + live[t]].T @ ahead
    each = alpha * back
    each /= each.sum(axis=1, keepdims=True)
    out = np.empty_like(each)
    out[at] = each
    total = np.zeros(len(sizes))
    np.add.at(total, np.arange(n) - offsets[step], np.log(scale))
    norm = np.empty(len(sizes))
    norm[order] = total
    return out, seen * jump, norm + np.add.reduceat(top, np.cumsum(sizes) - sizes)


def mean_marginals(which: np.ndarray, table: np.ndarray, moves: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Mean label probabilities of one sequence, whose word t has the scores `table[which[t]]`, in memory of one chunk."""
    jump = np.exp(moves)

    def emitted(start: int) -> np.ndarray:
        scores = table[which[start : start + chunk]]
        return np.exp(scores - scores.max(axis=1, keepdims=True))

    def forward(emit: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        alpha = np.empty_like(emit)
        for t, e in enumerate(emit):
            own = e if before is None else (before @ jump) * e
            alpha[t] = before = own / own.sum()
        return alpha

    starts, entries, state = range(0, len(which), chunk), [], None
    for start in starts:
        entries.append(state)
        state = forward(emitted(start), state)[-1]
    total, back = np.zeros(len(moves)), np.ones(len(moves))
    for start, entry in zip(reversed(starts), reversed(entries)):
        emit = emitted(start)
        alpha = forward(emit, entry)
        behind = np.empty_like(emit)
        for t in range(len(emit) - 1, -1, -1):
            behind[t] = back
            back = jump @ (emit[t] * back)
            back /= back.sum()
        each = alpha * behind
        total += (each / each.sum(axis=1, keepdims=True)).sum(axis=0)
    return total / len(which)


def train(rows: list[tuple[str, str]], seed: int = 11) -> Model | None:
    """A model from (text, label) rows, or None if there are none with words."""
    rng = random.Random(seed)
    windows: dict[str, list[list[str]]] = {}
    for text, label in rows:
        found = words(text)
        if found:
            start = rng.randrange(max(1, len(found) - WINDOW + 1))
            windows.setdefault(label, []).append(found[start : start + WINDOW])
    labels = sorted(windows)
    if not labels:
        return None
    counts, lexicon = Counter(), Counter()
    for w, n in Counter(w for own in windows.values() for part in own for w in part).items():
        lexicon["=" + w] += n
        for f in features(w):
            counts[f] += n
    kept = [f for f, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: FEATURES - LEXICON] if n >= 3]
    kept += [w for w, n in sorted(lexicon.items(), key=lambda x: (-x[1], x[0]))[:LEXICON] if n >= 5]
    model = Model(labels, {f: i for i, f in enumerate(kept)})
    # Sequences: every window alone, and splices of two or three windows' parts.
    sequences = [[(w, i) for w in part] for i, label in enumerate(labels) for part in windows[label]]
    for _ in range(len(sequences)):
        parts = [(i := rng.randrange(len(labels)), rng.choice(windows[labels[i]])) for _ in range(rng.randint(2, 3))]
        sequences.append([(w, i) for i, part in parts for w in part[: rng.randint(5, 40)]])
    distinct = {w: k for k, w in enumerate(dict.fromkeys(w for s in sequences for w, _ in s))}
    flat, starts = model.rows(list(distinct))
    owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(flat))))
    which = np.array([distinct[w] for s in sequences for w, _ in s])
    truth = np.array([i for s in sequences for _, i in s])
    sizes = np.array([len(s) for s in sequences])
    first = np.zeros(len(which), dtype=bool)
    first[np.cumsum(sizes) - sizes] = True
    n, k = len(which), len(labels)
    right = np.bincount(which * k + truth, minlength=len(distinct) * k).reshape(-1, k)
    moved = np.bincount(truth[:-1][~first[1:]] * k + truth[1:][~first[1:]], minlength=k * k).reshape(k, k)
    params, grads = [model.weights, model.moves], [np.zeros_like(model.weights), np.zeros_like(model.moves)]
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, ROUNDS + 1):  # Adam on the mean log-likelihood
        scores = np.add.reduceat(model.weights[flat], starts, axis=0)
        each, seen, _ = marginals(scores[which], model.moves, sizes)
        for j in range(k):
            miss = right[:, j] - np.bincount(which, weights=each[:, j], minlength=len(distinct))
            grads[0][:, j] = np.bincount(flat, weights=miss[owner], minlength=len(model.weights))
        grads[1] = moved - seen
        for p, g, m, v in zip(params, grads, mean, var):
            g = g / n - RIDGE * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


class Labeller:
    """A model with the scores of the words that this worker has met."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.labels)))

    def _learn(self, found: set[str]) -> None:
        new = list(found.difference(self.known))
        start = len(self.known)
        self.known.update(zip(new, range(start, start + len(new))))
        if len(self.known) > len(self.table):
            self.table = np.concatenate((self.table[:start], np.zeros((2 * len(self.known) - start, self.table.shape[1]))))
        self.table[start : len(self.known)] = self.model.scores(new)

    def _share(self, text: str) -> np.ndarray | None:
        """Mean label probabilities of a long text, whose words are never held all at once."""
        which = array("i")
        found = (m[0] for m in _WORD.finditer(text.lower()))
        while part := list(islice(found, CHUNK)):
            self._learn(set(part))
            which.extend(map(self.known.__getitem__, part))
        return mean_marginals(np.frombuffer(which, dtype=np.int32), self.table, self.model.moves, CHUNK) if which else None

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if len(self.known) > KEPT_WORDS:
            self.known, self.table = {}, self.table[:1024]
        lettered = [bool(t and _LETTER.search(t)) for t in texts]
        shares = {i: self._share(t) for i, t in enumerate(texts) if lettered[i] and len(t) > LONG}
        found = [words(t) if lettered[i] and i not in shares else [] for i, t in enumerate(texts)]
        self._learn(set().union(*found))
        full = [i for i, f in enumerate(found) if f]
        if full:
            get = self.known.__getitem__
            which = np.array([k for i in full for k in map(get, found[i])], dtype=np.int64)
            sizes = np.array([len(found[i]) for i in full])
            each, _, _ = marginals(self.table[which], self.model.moves, sizes)
            shares |= dict(zip(full, np.add.reduceat(each, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]))
        langs, scores = [UND] * len(texts), [0.0] * len(texts)
        for i, share in shares.items():
            if share is not None:
                langs[i], scores[i] = self.model.labels[int(share.argmax())], min(1.0, max(0.0, float(share.max())))
        return langs, scores


def remainder(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


def fit(df: DataFrame, usable: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model | None:
    """A model from the rows of `df` where `usable` holds and text and label are not null."""
    rows = df.where(usable & F.col(text).isNotNull() & F.col(lang).isNotNull())
    # At most MOST_LABELS rows come to the driver here, then about DOCS rows a label.
    counts = rows.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(MOST_LABELS).collect()
    if not counts:
        return None
    place = F.pmod(F.xxhash64(doc_id), F.lit(1 << 30))
    wanted = F.lit(False)
    for r in counts:
        wanted = wanted | ((F.col(lang) == r[lang]) & (place < int(min(1.0, DOCS / r["count"]) * (1 << 30))))
    picked = rows.where(wanted).select(F.substring(text, 1, CHARS).alias("t"), F.col(lang).alias("l"), place.alias("p"), F.col(doc_id).alias("d"))
    picked = picked.orderBy("p", "d", "t", "l").limit(2 * DOCS * len(counts)).collect()
    return train([(r["t"], r["l"]) for r in picked])


def predicted(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add `lang_pred` and `score`. Columns of `df` with those names are replaced."""
    fields = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)]
    if model is None:
        return df.drop("lang_pred", "score").withColumns({"lang_pred": F.lit(UND), "score": F.lit(0.0)})
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value
        labeller = worker_state(f"language {model.name}", lambda: Labeller(model))

        def work(piece: pa.RecordBatch) -> list:
            return list(labeller.predict(piece.column(text).to_pylist()))

        return work

    return extend(df, text, fields, make, SLICE)
