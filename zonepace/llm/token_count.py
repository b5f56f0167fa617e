"""Token counts by rank-synchronous merging of ragged arrays.

The vocabulary is a byte-level BPE with word ends (``</w>``), lower case,
white space dropped, read from a ``tokenizers`` JSON file.  Method:

1. A text's special strings are counted and cut out; what lies between white
   space is a word, and a word's pre-tokens do not depend on its neighbours, so
   each distinct word is tokenised once per worker (a cache of bounded size,
   emptied when full).
2. The pre-tokens of all new words of a batch are laid end to end as one array of
   symbols.  In each round every sequence finds its lowest-ranked adjacent pair
   and merges all its occurrences, left to right, at once; sequences without a
   ranked pair are finished.  This equals the library's order because no symbol
   takes part in a merge of lower rank than the one that makes it (checked when
   the file is read).
3. The surviving symbols are counted.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace.llm.common import small_batches, text_of

CACHE_WORDS = 500_000
LIMIT = 2048
NO_RANK = np.iinfo(np.int64).max
# The white space of the vocabulary's patterns.
WHITE = "\t-\r \x85\xa0  -     　"
# Python's split() knows these and not the patterns.
ODD_WHITE = re.compile("[\x1c-\x1f]")


BMP = 0xFFFF
ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def _ranges(major: str, top: int) -> str:
    """The character-class body of all characters up to ``top`` of a Unicode major category."""
    out, start = [], None
    for c in range(top + 2):
        inside = c <= top and unicodedata.category(chr(c))[0] == major
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


class Pieces:
    """All matches of a pattern with the classes {letters}, {numbers} and {white}.

    Up to U+FFFF a class is one table look-up; the hundreds of ranges beyond are tried one by one, so
    only texts that have such characters get the full classes.
    """

    def __init__(self, pattern: str):
        self.low, self.full = (re.compile(pattern.format(letters=_ranges("L", top), numbers=_ranges("N", top), white=WHITE))
                               for top in (BMP, sys.maxunicode))

    def __call__(self, text: str) -> list[str]:
        return (self.full if ASTRAL.search(text) else self.low).findall(text)


class Merges:
    """Symbols and ranked merges of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = {a + b: i for i, (a, b) in enumerate(pairs)}
        if len(made) < len(pairs) or any(made.get(x, -1) >= i for i, p in enumerate(pairs) for x in p):
            raise ValueError("merges are not in order of dependence; simultaneous merging would differ from the library")
        self.size = max(vocab.values()) + 1
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        keys = left * self.size + right
        self.rank = np.argsort(keys)
        self.keys = keys[self.rank]
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # Bytes that print stand for themselves in the vocabulary, the others for 256, 257, ... in order.
        printing = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        sign = {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(printing))}
        self.byte = np.array([vocab[sign[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[sign[b] + end] for b in range(256)], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NO_RANK)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols left of each (non-empty) pre-token."""
        size = np.array([len(t) for t in tokens], np.int64)
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        owner = np.repeat(np.arange(len(tokens)), size)
        symbols = self.byte[raw]
        ends = np.cumsum(size) - 1
        symbols[ends] = self.last[raw[ends]]
        counts = np.zeros(len(tokens), np.int64)
        while len(symbols):
            same = owner[1:] == owner[:-1]
            rank = np.full(len(symbols), NO_RANK)
            rank[:-1][same] = self.ranks(symbols[:-1][same], symbols[1:][same])
            heads = np.flatnonzero(np.concatenate([[True], ~same]))
            least = np.minimum.reduceat(rank, heads)
            length = np.diff(np.append(heads, len(symbols)))
            finished = least == NO_RANK
            counts[owner[heads[finished]]] = length[finished]
            merge = (rank == np.repeat(least, length)) & (rank != NO_RANK)
            # In a run of overlapping occurrences (a a a) every second one merges.
            run = np.flatnonzero(merge)
            if len(run) > 1:
                fresh = np.concatenate([[True], (np.diff(run) > 1) | (owner[run[1:]] != owner[run[:-1]])])
                offset = np.arange(len(run)) - np.repeat(np.flatnonzero(fresh), np.diff(np.append(np.flatnonzero(fresh), len(run))))
                run = run[offset % 2 == 0]
            symbols[run] = self.result[rank[run]]
            keep = ~np.repeat(finished, length)
            keep[run + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts


class Counter:
    """Token counts of whole texts; one per worker."""

    def __init__(self, merges: Merges):
        self.merges, self.known = merges, {}
        # The vocabulary's pre-token pattern.
        self.pieces = Pieces("'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{white}{letters}{numbers}]+")
        self.words = re.compile(f"[^{WHITE}]+")
        self.special = re.compile("|".join(map(re.escape, merges.specials))) if merges.specials else None

    def split(self, text: str) -> tuple[list[str], int]:
        """(words, number of special strings)."""
        specials = 0
        if self.special and any(s in text for s in self.merges.specials):
            text, specials = self.special.subn(" ", text)
        return (self.words.findall(text) if ODD_WHITE.search(text) else text.split()), specials

    def learn(self, words: set[str]) -> None:
        tokens, owner = [], []
        for i, w in enumerate(words):
            if not w.isascii():
                w = unicodedata.normalize("NFC", w).replace("Σ", "σ")
            for t in self.pieces(w.lower()):
                tokens.append(t.encode())
                owner.append(i)
        counts = self.merges.count(tokens)
        total = np.bincount(np.array(owner, np.int64), counts, minlength=len(words)).astype(int).tolist()
        self.known.update(zip(words, total))

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        split = [self.split(text) for text in texts]
        got = [list(map(known.get, words)) for words, _ in split]
        new = {w for (words, _), counts in zip(split, got) if None in counts for w, c in zip(words, counts) if c is None}
        if new:
            self.learn(new)
        return [sum(counts if None not in counts else map(known.get, words)) + specials
                for (words, specials), counts in zip(split, got)]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``; ``vocabulary`` is the JSON file's path.

    Null and empty texts have no bytes and no tokens.  Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(Merges(vocabulary))
    source = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def count(batches):
        counter = Counter(shared.value)
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), b.column("n_bytes"), pa.array(counter.count(b.column("text").to_pylist()), pa.int64())],
                                  names=["doc_id", "n_bytes", "n_tokens"])

    return (source.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
