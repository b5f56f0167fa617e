"""Supervised subword embeddings for whole texts.

A text is its white-space words, with case, an end mark, and a repetition mark for
each word that equals the one before it.  A word's features are the word
and its character 3- to 5-grams inside ``<word>``, each hashed to one of 2^18
rows of a learned embedding table.  A text is the mean of its features'
vectors; a linear softmax layer gives the class probabilities.  Table and layer are
trained together by plain stochastic gradient descent in numpy, text by text, on a
sample of at most ``MAX_TRAIN`` labelled texts: Spark tasks build the features, one task gets their
hashed counts (a bounded number of rows) and trains, and the finished logits come to the driver.

A text's logits are means of per-feature numbers, so scoring needs one row of
logits per distinct word and no embedding.  Words are hashed straight from the Arrow buffer and
looked up in a bounded table of fixed-width entries.
"""

from __future__ import annotations

import re
import zlib
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace.llm import words as W
from zonepace.llm.words import U, mix

BITS, DIM, GRAMS = 18, 8, (3, 4, 5)
MAX_TRAIN = 4000
EPOCHS, LEAST_STEPS, RATE, SEED = 4, 12_000, 0.1, 11
CACHE_WORDS = 500_000
LEARN_CHARS = 1_000_000  # characters of new words taken at once
WORD = re.compile(r"[^\x20\x09-\x0D]+")
END, AGAIN = "\n", "\n\n"  # the end and repetition marks: no white-space word can be equal to them


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, feature) of every feature of every word."""
    marked = [f"<{w}>" for w in words]
    size = np.array([len(m) for m in marked], np.int64)
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(code))  # characters from here to the word's end
    owners, features = [], []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            ok = np.flatnonzero(left >= n)
            h = np.full(len(ok), U(n))
            for k in range(n):
                h = h * U(0x100000001B3) + code[ok + k]
            owners.append(word[ok])
            features.append(h)
        at = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
        whole = mix(code * U(0x9E3779B97F4A7C15) + at.astype(np.uint64))
        features.append(np.add.reduceat(whole, np.cumsum(size) - size) if len(words) else np.zeros(0, np.uint64))
        owners.append(np.arange(len(words)))
        row = (mix(np.concatenate(features)) >> U(64 - BITS)).astype(np.int32)
    return np.concatenate(owners), row


def repetitions(words: list[str]) -> int:
    return sum(map(eq, words, islice(words, 1, None)))


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(feature, share): the distinct features of a text with their share of all its features."""
    words = WORD.findall(text)
    count: dict[str, int] = {END: 1, AGAIN: repetitions(words)}
    for w in words:
        count[w] = count.get(w, 0) + 1
    owner, feature = word_features(list(count))
    times = np.fromiter(count.values(), np.int64)[owner]
    kind, place = np.unique(feature, return_inverse=True)
    total = np.bincount(place, times, minlength=len(kind))
    kind, total = kind[total > 0], total[total > 0]
    return kind.astype(np.int32), (total / total.sum()).astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, epochs: int | None = None,
          rate: float = RATE, seed: int = SEED) -> np.ndarray:
    """Per-feature logits, 2^BITS x classes.  Without rows of two classes: the smoothed class shares for any text.

    By default EPOCHS passes, or as many as make LEAST_STEPS steps, so that a few hundred texts teach enough too.
    """
    prior = np.bincount(labels, minlength=classes) + 1.0
    prior /= prior.sum()
    if len(np.unique(labels)) < 2:
        return np.tile(np.log(prior).astype(np.float32), (1 << BITS, 1))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, classes), np.float32), np.log(prior).astype(np.float32)
    epochs = epochs or max(EPOCHS, -(-LEAST_STEPS // len(rows)))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            feature, share = rows[i]
            vectors = table[feature]
            text = share @ vectors
            logit = text @ layer + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[i]] -= 1
            step = np.float32(rate * (1 - done / steps))
            back = layer @ p
            layer -= step * text[:, None] * p
            bias -= step * 0.1 * p
            # A feature's gradient is its share, times the number of features so that texts of any length learn alike.
            table[feature] = vectors - (step * len(feature)) * share[:, None] * back
            done += 1
    return (table @ layer + bias).astype(np.float32)


class Scorer:
    """Class probabilities of whole texts; one per worker."""

    def __init__(self, logits: np.ndarray):
        self.logits = logits
        self.marks, self.mark_sizes = self._sums([END, AGAIN])
        self._reset()

    def _reset(self) -> None:
        self.known = W.Known()
        self.sums, self.sizes = np.zeros((0, self.logits.shape[1])), np.zeros(0)

    def _sums(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of logits and number of features of each word."""
        owner, feature = word_features(words)
        got = self.logits[feature].astype(np.float64)
        return (np.column_stack([np.bincount(owner, got[:, k], minlength=len(words)) for k in range(got.shape[1])]),
                np.bincount(owner, minlength=len(words)).astype(float))

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        upto = np.cumsum(ends - starts)
        lo = 0
        while lo < len(hashes):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + LEARN_CHARS, side="right")))
            sums, sizes = self._sums([data[a:b].tobytes().decode() for a, b in zip(starts[lo:hi], ends[lo:hi])])
            self.known.add(hashes[lo:hi], np.arange(len(self.sizes), len(self.sizes) + hi - lo))
            self.sums, self.sizes = np.concatenate([self.sums, sums]), np.concatenate([self.sizes, sizes])
            lo = hi

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(texts x classes, words of each text); nulls are empty texts."""
        data, offsets = W.buffers(column)
        hashes, bounds, starts, ends = W.hash_words(data, offsets, True, W.SPACED)
        kinds, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        at = self.known.find(kinds)
        if len(self.known) + np.count_nonzero(at < 0) > CACHE_WORDS and len(self.known):
            self._reset()
            at = np.full(len(kinds), -1)
        new = np.flatnonzero(at < 0)
        if len(new):
            self._learn(kinds[new], data, starts[first[new]], ends[first[new]])
            at = self.known.find(kinds)
        words = at[place]
        n = np.diff(bounds)
        full = np.flatnonzero(n)
        logit, size = np.tile(self.marks[0], (len(n), 1)), np.full(len(n), self.mark_sizes[0])
        if len(full):
            logit[full] += np.add.reduceat(self.sums[words], bounds[full])
            size[full] += np.add.reduceat(self.sizes[words], bounds[full])
            text = np.repeat(np.arange(len(n)), n)
            again = np.bincount(text[1:][(hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])], minlength=len(n))
            logit += again[:, None] * self.marks[1]
            size += again * self.mark_sizes[1]
        logit /= size[:, None]
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), n


_SCORERS: dict[int, Scorer] = {}


def scorer_of(logits: np.ndarray) -> Scorer:
    """The worker's scorer of these logits: what one task has learnt serves the next; other logits replace it."""
    key = zlib.crc32(logits.tobytes())
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(logits)
    return _SCORERS[key]


def fit(docs: DataFrame, labels: DataFrame, classes: int, max_train: int = MAX_TRAIN, **options) -> np.ndarray:
    """Per-feature logits from (doc_id, text) and (doc_id, label): labels of one id are averaged and rounded half up.

    At most ``max_train`` labelled ids, those with the smallest hash, are used, each with one text; the bound
    also bounds the broadcast id list and the training task.
    """
    one = (labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id")
           .agg(F.floor(F.avg("label") + 0.5).cast("int").alias("label")))
    picked = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)

    def build(batches):
        for b in batches:
            made = [text_features(t) for t in b.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": b.column("doc_id").cast(pa.string()), "label": b.column("label"),
                                   "feature": pa.array([f.tobytes() for f, _ in made], pa.binary()),
                                   "share": pa.array([s.tobytes() for _, s in made], pa.binary())})

    def learn(batches):
        # The order of rows must not matter.
        rows = sorted(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        logits = train([(np.frombuffer(f, np.int32), np.frombuffer(s, np.float32)) for _, _, f, s in rows],
                       np.array([label for _, label, _, _ in rows], np.int64), classes, **options)
        yield pa.record_batch({"logits": pa.array([logits.tobytes()], pa.binary())})

    # One text an id, whatever the number of rows that repeat it: the one with the smallest hash.
    sample = (docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label")
              .agg(F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text")))
    made = (sample.mapInArrow(build, "doc_id string, label int, feature binary, share binary")
            .repartition(1).mapInArrow(learn, "logits binary").collect())
    if not made:
        return train([], np.zeros(0, np.int64), classes)
    return np.frombuffer(made[0]["logits"], np.float32).reshape(1 << BITS, classes)
