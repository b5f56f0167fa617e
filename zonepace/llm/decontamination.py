"""Benchmark decontamination with suffix arrays over the training documents.

Words are those of ``words.py`` (A-Z lower-cased).  A window is 10 consecutive
words of a benchmark item, or the whole item when it has fewer.  Method:

1. The documents are cut into shards (the batches of each task).  Of a shard,
   the word positions whose first two words begin some window (a bitmap over
   the benchmark decides; it never misses one) are sorted by the ten words
   that follow: the part of the shard's suffix array that a test suffix can meet.
2. Every test suffix that is at least a window long is binary-searched in each
   shard, all of them at once; the suffixes that share its window are a range
   of the array and give the locations.
3. Locations of consecutive suffixes of one item on one diagonal are one longest
   verbatim match (item, item word, document word, length).

The benchmark is read in slices of bounded size; each is broadcast and searched
against all documents.  Documents are never shuffled for one slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace.llm import words as W
from zonepace.llm.common import small_batches, text_of

WINDOW = 10
SLICE_BYTES = 32 << 20
U = W.U
_BITS = 20
_PAIR = U(0x9FB21C651E98DF25)


class Windows:
    """The windows of a slice of benchmark items: distinct word rows, their items and places."""

    def __init__(self, ids: list[str], texts: list[str], width: int):
        self.ids, self.width = sorted(set(ids)), width
        number = {k: i for i, k in enumerate(self.ids)}
        hashes, bounds = W.hash_words(*W.buffers(pa.array(texts, pa.string())))
        rows, sizes, item, place = [], [], [], []
        for k, name in enumerate(ids):
            own = hashes[bounds[k]:bounds[k + 1]]
            if not len(own):
                continue
            size = min(width, len(own))
            for p in range(len(own) - size + 1):
                row = np.zeros(width, np.uint64)
                row[:size] = own[p:p + size]
                rows.append(row)
                sizes.append(size)
                item.append(number[name])
                place.append(p)
        table = np.array(rows, np.uint64).reshape(-1, width)
        tagged = np.column_stack([table, np.array(sizes, np.uint64)])
        distinct, which = np.unique(tagged, axis=0, return_inverse=True)
        self.rows, self.sizes = np.ascontiguousarray(distinct[:, :width]), distinct[:, width].astype(np.int64)
        order = np.argsort(which.ravel(), kind="stable")
        self.item, self.place = np.array(item, np.int64)[order], np.array(place, np.int64)[order]
        self.at = np.searchsorted(which.ravel()[order], np.arange(len(distinct) + 1))
        self.ones = np.unique(self.rows[self.sizes == 1, 0])
        self.pairs = np.zeros(1 << _BITS, bool)
        wide = self.rows[self.sizes > 1]
        if len(wide):
            self.pairs[pair_cell(wide[:, 0], wide[:, 1])] = True


def pair_cell(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((a * _PAIR + b) * _PAIR >> U(64 - _BITS)).astype(np.int64)


def suffix_array(seq: np.ndarray, windows: Windows, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, their next ``width`` words), sorted by those words.  ``seq`` has 0 between texts."""
    cand = windows.pairs[pair_cell(seq[:-1], seq[1:])] & (seq[:-1] != 0)
    if len(windows.ones):
        cand |= np.isin(seq[:-1], windows.ones)
    pos = np.flatnonzero(cand)
    pos = pos[pos + width <= len(seq)]
    rows = seq[pos[:, None] + np.arange(width)]
    order = np.lexsort(rows.T[::-1])
    return pos[order], rows[order]


def search(rows: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """For each window the range [lo, hi) of suffixes that begin with it."""
    used = np.arange(windows.width)[None, :] < windows.sizes[:, None]
    bounds = []
    for upper in (False, True):
        lo, hi = np.zeros(len(windows.rows), np.int64), np.full(len(windows.rows), len(rows), np.int64)
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            a, b = rows[mid], windows.rows[open_]
            differs = (a != b) & used[open_]
            k = differs.argmax(axis=1)
            at = np.arange(len(open_))
            unequal = differs[at, k]
            right = np.where(unequal, a[at, k] < b[at, k], upper)
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]
        bounds.append(lo)
    return bounds[0], bounds[1]


def shard_matches(hashes: np.ndarray, bounds: np.ndarray, windows: Windows):
    """(text, word, window) of every occurrence of a window in a shard's texts."""
    none = np.zeros(0, np.int64)
    if not len(windows.rows) or not len(hashes):
        return none, none, none
    n = len(bounds) - 1
    text = np.repeat(np.arange(n), np.diff(bounds))
    seq = np.zeros(len(hashes) + n + windows.width + 1, np.uint64)
    seq[np.arange(len(hashes)) + text] = hashes
    pos, rows = suffix_array(seq, windows, windows.width)
    lo, hi = search(rows, windows)
    size = hi - lo
    which = np.repeat(np.arange(len(size)), size)
    place = pos[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)]
    # A text's words start at bounds[i] + i of the padded sequence.
    heads = bounds[:-1] + np.arange(n)
    t = np.searchsorted(heads, place, side="right") - 1
    return t, place - heads[t], which


_MATCH = "array<struct<item:string,item_word:int,word:int,length:int>>"
_MATCH_TYPE = pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int32()), ("word", pa.int32()), ("length", pa.int32())]))


def _longest(t, word, which, windows: Windows, n: int):
    """Per text the longest verbatim matches as Arrow lists, and the item numbers."""
    times = windows.at[which + 1] - windows.at[which]
    row = np.repeat(np.arange(len(which)), times)
    k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(windows.at[which], times)
    item, place, text, at, size = windows.item[k], windows.place[k], t[row], word[row], windows.sizes[which[row]]
    order = np.lexsort((place, at - place, item, text))
    item, place, text, at, size = item[order], place[order], text[order], at[order], size[order]
    new = np.ones(len(item), bool)
    new[1:] = ((text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (at[1:] - place[1:] != at[:-1] - place[:-1])
               | (place[1:] > place[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(item)) - 1 if len(item) else first
    length = place[last] + size[last] - place[first]
    names = pa.array(windows.ids, pa.string())
    rows = pa.StructArray.from_arrays(
        [names.take(pa.array(item[first])), pa.array(place[first].astype(np.int32)), pa.array(at[first].astype(np.int32)),
         pa.array(length.astype(np.int32))], names=["item", "item_word", "word", "length"])
    offsets = np.searchsorted(text[first], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), rows)


def benchmark_slices(benchmark: DataFrame, item_col: str, text_col: str, width: int, slice_bytes: int) -> list[Windows]:
    """The benchmark's windows, in slices of about ``slice_bytes`` of text; each goes through the driver on its own."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), text_of(benchmark, text_col).alias("t"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("b")).first()["b"]
    slices = max(1, -(-int(total) // slice_bytes))
    for s in range(slices):
        part = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(slices)) == s) if slices > 1 else rows
        got = part.collect()
        yield Windows([r["i"] for r in got], [r["t"] for r in got], width)


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW,
                 slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, items, matches, contaminated: one row per row of ``docs``.

    ``items`` are the ids (as strings, sorted, distinct) whose windows occur;
    ``matches`` the longest verbatim matches.  Null and empty texts have no words; items
    without words match nothing; a null item id counts as the empty string; an empty
    benchmark or document table gives no hit or no row.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    passes = []
    for windows in benchmark_slices(benchmark, item_col, item_text_col, width, slice_bytes):
        shared = spark.sparkContext.broadcast(windows)

        def match(batches, shared=shared):
            for b in batches:
                hashes, bounds = W.hash_words(*W.buffers(b.column("text")))
                t, word, which = shard_matches(hashes, bounds, shared.value)
                found = _longest(t, word, which, shared.value, b.num_rows)
                yield pa.record_batch([b.column("doc_id"), *map(pa.array, digest(hashes, bounds)), pa.array(np.diff(bounds)),
                                       found.cast(_MATCH_TYPE)], names=["doc_id", "h1", "h2", "n_words", "matches"])

        passes.append(source.mapInArrow(match, f"doc_id {kind}, h1 long, h2 long, n_words long, matches {_MATCH}"))
    every = passes[0]
    if len(passes) > 1:  # the slices' matches of a row come together by id and content
        for p in passes[1:]:
            every = every.unionByName(p)
        every = (every.groupBy("doc_id", "h1", "h2", "n_words").agg(F.flatten(F.collect_list("matches")).alias("matches"),
                                                                    F.count(F.lit(1)).alias("times"))
                 .withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("times") / len(passes)).cast("int"))))
                 .withColumn("matches", F.array_distinct("matches")))

    def cover(batches):
        for b in batches:
            lists = b.column("matches")
            rows = lists.flatten()
            t = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            hit = np.zeros(b.num_rows, np.int64)
            if len(rows):
                word, length = rows.field("word").to_numpy().astype(np.int64), rows.field("length").to_numpy().astype(np.int64)
                order = np.lexsort((word, t))
                t, word, end = t[order], word[order], (word + length)[order]
                # Texts laid end to end, so that one running maximum serves all.
                shift = t * (int(end.max()) + 1)
                reach = np.maximum.accumulate(end + shift)
                before = np.concatenate([[0], reach[:-1]])
                hit = np.bincount(t, np.maximum(end + shift - np.maximum(word + shift, before), 0), minlength=b.num_rows).astype(np.int64)
            yield pa.record_batch([b.column("doc_id"), b.column("n_words"), pa.array(hit), lists], names=["doc_id", "n_words", "n_hit", "matches"])

    covered = every.select("doc_id", "n_words", "matches").mapInArrow(cover, f"doc_id {kind}, n_words long, n_hit long, matches {_MATCH}")
    return (covered.withColumn("items", F.array_sort(F.array_distinct(F.col("matches.item"))))
            .withColumn("contaminated", F.col("n_hit") > 0).select("doc_id", "n_words", "n_hit", "items", "matches", "contaminated"))


def digest(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over (word, place): the same for equal word sequences."""
    n = len(bounds) - 1
    out = []
    place = np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))
    full = np.flatnonzero(np.diff(bounds))
    for seed in (17, 71):
        h = np.zeros(n, np.uint64)
        if len(full):
            with np.errstate(over="ignore"):
                h[full] = np.add.reduceat(W.mix(hashes + W.mix(place.astype(np.uint64) + U(seed))), bounds[:-1][full])
        out.append(h.view(np.int64))
    return out[0], out[1]


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text", width: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, in which no benchmark window occurs."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = docs.schema
    for windows in benchmark_slices(benchmark, item_col, item_text_col, width, slice_bytes):
        shared = spark.sparkContext.broadcast(windows)

        def clean(batches, shared=shared):
            for b in batches:
                t, _, _ = shard_matches(*W.hash_words(*W.buffers(b.column(text_col))), shared.value)
                keep = np.ones(b.num_rows, bool)
                keep[t] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, schema)
    return docs
