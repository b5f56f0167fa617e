"""Substring dedup: content-defined chunks cut by a gear rolling hash.

1. Each text (its UTF-8 bytes) is cut after every byte whose gear hash (of the last
   16 bytes) is the smallest within REACH bytes on either side, so cuts lie more than
   REACH apart and depend on nothing but the 2 REACH + 16 bytes around them: they move
   with the content, and chunks behind an insertion are found again.  Where
   no cut falls for MAX_CHUNK bytes (text that repeats itself) one is put there.
2. Chunks are grouped by a 64-bit digest.  The occurrence in the document with
   the smallest id (and the first in it) stays; the others repeat it.
3. Consecutive chunks that occur more than once form a run.  Runs of MIN_RUN
   bytes or more are repeated passages; shorter ones (single lines, notices) are
   left alone.  A run needs several equal digests in a row or one long chunk, so a chance
   collision of two digests makes none.
4. A passage loses what lies before its first and behind its last cut, so one of
   just over 50 words can leave a run that is too short.  So runs of SEED words are
   sampled where their hash is the smallest of the SEED-grams in some WORDS words
   (winnowing): equal stretches of WORDS words share a sample whatever their length
   in bytes.  Around samples that occur twice and lie outside a long run somewhere, all
   windows of WORDS words are hashed and counted; windows that occur twice and touch no long run
   of their row are repeated passages too, joined where they follow each other.

Runs start and end at chunk cuts, so up to about a chunk at either end of a
passage with a long run stays.  Counting folds map-side; the join back to a chunk that a third
of the documents share is a plain sort-merge join that AQE splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonepace.llm import words as W
from zonepace.llm.common import small_batches, text_of, written

REACH, MAX_CHUNK, MIN_RUN = 24, 256, 112
WORDS, SEED = 51, 13  # a passage of over 50 words; words of a sample
SPAN = 16  # bytes that the gear hash looks back
U = W.U

with np.errstate(over="ignore"):
    GEAR = (W.mix(np.arange(1, 257, dtype=np.uint64) * U(0xA0761D6478BD642F)) >> U(40)).astype(np.uint16)
    BYTE = W.mix(np.arange(1, 257, dtype=np.uint64) * U(0xE7037ED1A0B428DB)) | U(1)


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of h[i:i + width] for every i (shorter at the end), by doubling."""
    out, have = h.copy(), 1
    while have < width:
        step = min(have, width - have)
        np.minimum(out[:-step], out[step:], out=(nxt := out.copy())[:-step])
        out, have = nxt, have + step
    return out


def cuts(data: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Positions behind the bytes of data[begin:end] where the gear hash is a local minimum.

    Gear: h <- 2h + GEAR[byte] in 16 bits, so h depends on 16 bytes; it is summed by doubling.
    Of equal hashes within reach the first counts.
    """
    found = []
    for a in range(begin, end, W.BLOCK):
        b = min(a + W.BLOCK, end)
        lo, hi = max(begin, a - SPAN - REACH), min(end, b + REACH)
        h = GEAR[data[lo:hi]]
        for shift in (1, 2, 4, 8):
            if len(h) > shift:
                more = h[:-shift] << np.uint16(shift)
                h = h.copy()
                h[shift:] += more
        least = _window_min(h, REACH + 1)
        before = np.full(len(h), 65535, np.uint16)
        if len(h) > REACH:
            before[REACH:] = _window_min(h, REACH)[:len(h) - REACH]
        hit = np.flatnonzero((h == least) & (h < before)) + lo
        found.append(hit[(hit >= a) & (hit < b)] + 1)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of every chunk, index of its text)."""
    begin, end = int(offsets[0]), int(offsets[-1])
    heads = np.unique(offsets[:-1][np.diff(offsets) > 0]) if len(offsets) > 1 else np.zeros(0, np.int64)
    inner = cuts(data, begin, end)
    if len(inner):  # a cut whose hash would look back over its text's start is none
        head = heads[np.searchsorted(heads, inner, side="right") - 1]
        inner = inner[(inner - head >= SPAN) & (inner < end)]
    starts = np.union1d(heads, inner).astype(np.int64)
    gap = np.diff(np.append(starts, end))
    wide = np.flatnonzero(gap > MAX_CHUNK)
    if len(wide):
        starts = np.union1d(starts, np.concatenate([np.arange(starts[i], starts[i] + gap[i], MAX_CHUNK) for i in wide]))
    return starts, np.searchsorted(offsets, starts, side="right") - 1


def chunk_digests(data: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    """64-bit digest of each chunk's bytes; the chunks lie side by side up to ``end``."""
    out = np.zeros(len(starts), np.uint64)
    ends = np.append(starts[1:], end)
    k = 0
    power, inverse = W._tables(W.BLOCK)
    while k < len(starts):
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + W.BLOCK, side="right")))
        a, b = int(starts[k]), int(ends[stop - 1])
        with np.errstate(over="ignore"):
            value = BYTE[data[a:b]] * power[:b - a]
            own = starts[k:stop] - a
            size = (ends[k:stop] - starts[k:stop]).astype(np.uint64)
            out[k:stop] = W.mix(np.add.reduceat(value, own) * inverse[own] + size)
        k = stop
    return out


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, key): ``key`` is equal for equal ids and texts."""
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    return rows.withColumn("key", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))


def chunk_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, key, seq, start, length, digest): every chunk of every row, written."""
    small_batches(docs.sparkSession)
    source = keyed(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())

    def cut(batches):
        for b in batches:
            data, offsets = W.buffers(b.column("text"))
            starts, text = chunk_starts(data, offsets)
            digest = chunk_digests(data, starts, int(offsets[-1]))
            length = np.diff(np.append(starts, offsets[-1]))
            count = np.bincount(text, minlength=b.num_rows)
            seq = np.arange(len(starts)) - np.repeat(np.cumsum(count) - count, count)
            at = pa.array(text)
            yield pa.record_batch([b.column("doc_id").take(at), b.column("row").take(at), b.column("key").take(at), pa.array(seq.astype(np.int32)),
                                   pa.array(starts - offsets[text]), pa.array(length.astype(np.int32)), pa.array(digest.view(np.int64))],
                                  names=["doc_id", "row", "key", "seq", "start", "length", "digest"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return written(source.mapInArrow(cut, f"doc_id {kind}, row long, key long, seq int, start long, length int, digest long"), "chunks")


# ---------------------------------------------------------------- windows of words

def _stretches(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the bytes from word i to the end of word i + n - 1, for every i; bytes are one text's."""
    if len(starts) < n:
        return np.zeros(0, np.uint64)
    power, inverse = W._tables(len(data))
    first, last = starts[:len(starts) - n + 1], ends[n - 1:]
    with np.errstate(over="ignore"):
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE[data] * power[:len(data)], dtype=np.uint64)])
        return W.mix((upto[last] - upto[first]) * inverse[first] + (last - first).astype(np.uint64))


def sampled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the smallest of some ``width`` consecutive ones."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _window_min(hashes, width)[:len(hashes) - width + 1]
    pad = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(~_window_min(~np.concatenate([pad, least, pad]), width)[:len(hashes)] == hashes)


def _texts(column: pa.Array):
    """(bytes, word starts, word ends) of each text, places counted from its start."""
    data, offsets = W.buffers(column)
    _, bounds, starts, ends = W.hash_words(data, offsets, places=True)
    for i, a in enumerate(offsets[:-1]):
        own = slice(bounds[i], bounds[i + 1])
        yield data[a:offsets[i + 1]], starts[own] - a, ends[own] - a


def _word_windows(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, row, place, start, end, first_doc_id, digest): every repeated window of WORDS words outside ``spans`` (key, spans).

    ``docs`` are (doc_id, text, key); equal keys are equal ids and texts.
    """

    def sample(batches):
        for b in batches:
            got = [np.zeros((0, 5), np.int64)]
            for i, (data, starts, ends) in enumerate(_texts(b.column("text"))):
                if len(starts) >= WORDS:
                    h = _stretches(data, starts, ends, SEED)
                    at = sampled(h, WORDS - SEED + 1)
                    got.append(np.stack([np.full(len(at), i), h[at].view(np.int64), at, starts[at], ends[at + SEED - 1]], 1))
            t = np.concatenate(got)
            yield pa.record_batch([b.column("key").take(pa.array(t[:, 0])), *[pa.array(t[:, k].copy()) for k in range(1, 5)]],
                                  names=["key", "seed", "place", "start", "end"])

    def window(batches):
        for b in batches:
            got = [np.zeros((0, 5), np.int64)]
            for i, ((data, starts, ends), places) in enumerate(zip(_texts(b.column("text")), b.column("places"))):
                n = len(starts) - WORDS + 1
                step = np.zeros(n + 1, np.int64)
                p = np.asarray(places.values.to_numpy(zero_copy_only=False))
                np.add.at(step, np.maximum(p - (WORDS - SEED), 0), 1)
                np.add.at(step, np.minimum(p + 1, n), -1)
                at = np.flatnonzero(np.cumsum(step[:-1]) > 0)
                h = _stretches(data, starts, ends, WORDS)
                got.append(np.stack([np.full(len(at), i), at, starts[at], ends[at + WORDS - 1], h[at].view(np.int64)], 1))
            t = np.concatenate(got)
            own = pa.array(t[:, 0])
            yield pa.record_batch([*[b.column(c).take(own) for c in ("doc_id", "row", "key")], *[pa.array(t[:, k].copy()) for k in range(1, 5)]],
                                  names=["doc_id", "row", "key", "place", "start", "end", "digest"])

    touches = F.exists(F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>")),
                       lambda x: (x["a"] < F.col("end")) & (x["b"] > F.col("start")))
    seeds = written(docs.select("key", "text").mapInArrow(sample, "key long, seed long, place long, start long, end long"), "word-seeds")
    often = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("seed")
    again = written(seeds.join(often, "seed"), "repeated-seeds")
    free = written(again.join(spans, "key", "left").filter(~touches).select("seed").distinct(), "free-seeds")
    places = again.join(free, "seed").groupBy("key").agg(F.collect_set("place").alias("places"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.join(places, "key").withColumn("row", F.monotonically_increasing_id())
    windows = written(found.select("doc_id", "row", "key", "text", "places").mapInArrow(
        window, f"doc_id {kind}, row long, key long, place long, start long, end long, digest long"), "word-windows")
    twice = windows.groupBy("digest").agg(F.min("doc_id").alias("first_doc_id"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    return windows.join(twice, "digest").join(spans, "key", "left").filter(~touches).drop("spans")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, start, n_bytes, n_chunks, first_doc_id, removed_bytes, removed, key: the repeated passages of each row of ``docs``.

    One row per stretch with one owner: ``start`` and ``n_bytes`` (UTF-8 bytes) are exactly the bytes that repeat
    ``first_doc_id``, the smallest id that holds them.  ``removed`` says that this occurrence
    repeats an earlier one and goes (rows that repeat a document id count as that
    document).  A byte goes only with a chunk or window whose first occurrence is earlier in (id, place), so
    some occurrence of it always stays, whatever goes around it.  ``n_chunks`` is 0 for a passage found by its words;
    ``key`` is equal for equal ids and texts.  Rows without a repeated passage, null and empty texts give
    none.  Other columns are not read.
    """
    chunks = chunk_table(docs, id_col, text_col)
    twice = written(chunks.groupBy("digest").agg(F.min("doc_id").alias("first_doc_id"), F.count(F.lit(1)).alias("c"))
                    .filter("c > 1").select("digest", "first_doc_id"), "repeated-chunks")
    in_row = Window.partitionBy("row").orderBy("seq")
    of_digest = Window.partitionBy("row", "digest").orderBy("seq")
    of_run, of_owner = Window.partitionBy("row", "run"), Window.partitionBy("row", "run", "first_doc_id", "gone").orderBy("seq")
    stays = F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.row_number().over(of_digest) == 1)
    runs = written(chunks.join(twice, "digest").withColumn("gone", ~stays)
                   .withColumn("run", F.col("seq") - F.row_number().over(in_row))
                   .withColumns({"run_bytes": F.sum("length").over(of_run), "run_start": F.min("start").over(of_run)})
                   .filter(F.col("run_bytes") >= min_run)
                   .withColumn("part", F.col("seq") - F.row_number().over(of_owner))
                   .groupBy("row", "run", "first_doc_id", "gone", "part")
                   .agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.min("start").alias("start"), F.sum("length").alias("n_bytes"),
                        F.count(F.lit(1)).alias("n_chunks"), F.min("run_start").alias("a"), F.min(F.col("run_start") + F.col("run_bytes")).alias("b")), "long-runs")
    spans = runs.groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    of_digest = Window.partitionBy("row", "digest").orderBy("place")
    of_owner = Window.partitionBy("row", "first_doc_id", "gone").orderBy("place")
    passages = (_word_windows(keyed(docs, id_col, text_col), written(spans, "spans"))
                .withColumn("gone", ~(F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.row_number().over(of_digest) == 1)))
                .withColumn("part", F.col("place") - F.row_number().over(of_owner))
                .groupBy("row", "first_doc_id", "gone", "part")
                .agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.min("start").alias("start"),
                     (F.max("end") - F.min("start")).alias("n_bytes"), F.lit(0).cast("long").alias("n_chunks")))
    columns = ["doc_id", "start", "n_bytes", "n_chunks", "first_doc_id", "gone", "key"]
    return runs.select(*columns).unionByName(passages.select(*columns)).select(
        "doc_id", "start", "n_bytes", "n_chunks", "first_doc_id", F.when(F.col("gone"), F.col("n_bytes")).otherwise(0).alias("removed_bytes"),
        F.col("gone").alias("removed"), "key")


def without_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the removed stretches of ``passages`` cut out of the texts.

    A stretch is narrowed to whole characters.  Texts that lose nothing, nulls included, pass unchanged.
    """
    gone = (passages.filter("removed").groupBy(F.col("key").alias("cut__key"))
            .agg(F.collect_set(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("n_bytes")).alias("b"))).alias("cut__spans")))
    rows = docs.withColumn("cut__key", F.xxhash64(docs[id_col].isNull(), docs[id_col], text_of(docs, text_col)))
    met = rows.join(gone, "cut__key", "left").drop("cut__key").select(*docs.columns, "cut__spans")
    names, place = docs.columns, docs.columns.index(text_col)

    def cut(batches):
        for b in batches:
            texts = b.column(place).to_pylist()
            for i, spans in enumerate(b.column("cut__spans").to_pylist()):
                if not spans:
                    continue
                raw = texts[i].encode()
                data = np.frombuffer(raw, np.uint8)
                keep = np.ones(len(raw), bool)
                for span in spans:
                    a, z = span["a"], span["b"]
                    while a < z and data[a] & 0xC0 == 0x80:
                        a += 1
                    while z > a and z < len(raw) and data[z] & 0xC0 == 0x80:
                        z -= 1
                    keep[a:z] = False
                texts[i] = data[keep].tobytes().decode()
            columns = [pa.array(texts, b.column(k).type) if k == place else b.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return met.mapInArrow(cut, docs.schema)
