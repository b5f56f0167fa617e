"""Near-duplicates by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

Shingles are runs of five words (``words.py``; all words of a shorter text).
The weight of a shingle in a text is tf x idf with
``idf = ln(N / max(df, FLOOR N)) / ln(1 / FLOOR)``: 1 for every shingle in at most 2 %
of all texts, falling to 0 for one that is in all.  N and df count provisional classes
of copies, not rows: a group of near copies, however large, must not lower the weights of its own text.
Two min-hashes of the plain shingles place a text: its class is the second hash that most texts
with its first hash have, so a copy leaves its group only where an edit moved both.

df is counted over all texts in two passes: a two-row sketch of fixed size that counts every occurrence finds
the cells that may lie above FLOOR, then the classes that hold shingles of such cells are counted, cell by
cell (the cells' noise, shingles per text / 2^18 of N, lies far below FLOOR at any N).

Method:

1. Texts with the same word sequence (128-bit digest) collapse to one node.
2. 36 ICWS samples per node, in 12 bands of 3: texts of similarity 0.8 share a
   band with probability 0.9998, of 0.3 with 0.28.
3. Every node of a shared bucket is compared with the bucket's smallest node
   (its leader); similarity is the exact weighted Jaccard.
4. Buckets whose other members are still in several components are compared in
   blocks: all members against those outside the bucket's largest component,
   by matrix products over shared shingles.  A block pair gives back only
   links that join components.  So no pair of different components that
   shares a bucket goes uncompared, and no bucket is emitted as pairs.
5. Connected components of the links are the classes.

The work of step 4 grows with (members) x (members outside the largest
component) of a bucket; blocks are dealt over tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace.llm import words as W
from zonepace.llm.common import small_batches, text_of, written
from zonepace.llm.components import components

WIDTH, THRESHOLD, BANDS, ROWS = 5, 0.8, 12, 3
FLOOR, SKETCH_BITS, SKETCH_ROWS, CELLS = 0.02, 18, 2, 4096
BLOCK_NODES, BLOCK_SHINGLES, TILE = 1024, 1_000_000, 4096
U = W.U
_GOLD, _MINHASH = 0x9E3779B97F4A7C15, (U(0xD1342543DE82EF95), U(0xAF251AF3B0F025B5))
_SKETCH_SEED = [U(0x243F6A8885A308D3), U(0x13198A2E03707344)]


# ---------------------------------------------------------------- shingles with counts

def counted(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle, tf, bounds): the distinct shingles of each text, sorted within it."""
    hashes, bounds = W.hash_words(*W.buffers(column))
    shing, at = W.shingles(hashes, bounds, width)
    text = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))
    order = np.argsort(shing)
    order = order[np.argsort(text[order], kind="stable")]
    shing = shing[order]
    new = np.ones(len(shing), bool)
    new[1:] = (shing[1:] != shing[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    tf = np.diff(np.append(first, len(shing)))
    text = text[first]
    return text, shing[first], tf, np.searchsorted(text, np.arange(len(at)))


def cell(shing: np.ndarray, row: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (W.mix(shing ^ _SKETCH_SEED[row]) >> U(64 - SKETCH_BITS)).astype(np.int64)


def _blocks(counts: np.ndarray) -> pa.RecordBatch:
    """A count table as its blocks of CELLS that are not all zero."""
    flat = counts.reshape(-1, CELLS)
    some = np.flatnonzero(flat.any(axis=1))
    return pa.record_batch({"block": pa.array(some.astype(np.int32)), "counts": pa.array([flat[k].astype("<i8").tobytes() for k in some], pa.binary())})


def _summed(parts: DataFrame) -> np.ndarray:
    """The sum of tasks' count tables (``_blocks``): [SKETCH_ROWS, cells]; parts are added as they stream by."""
    n = SKETCH_ROWS * (1 << SKETCH_BITS) // CELLS

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, raw in zip(b.column("block").to_pylist(), b.column("counts").to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(raw, "<i8")
        yield pa.record_batch({"block": pa.array(list(sums), pa.int32()),
                               "counts": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

    out = np.zeros((n, CELLS), np.int64)
    for r in parts.repartition(n // 8, "block").mapInArrow(add, "block int, counts binary").collect():  # at most n rows of fixed size
        out[r["block"]] = np.frombuffer(r["counts"], "<i8")
    return out.reshape(SKETCH_ROWS, -1)


def occurrence_sketch(docs: DataFrame, width: int) -> np.ndarray:
    """counts[row, cell] of shingles, every occurrence counted, over all rows of (id, text): no shingle is in more texts."""

    def count(batches):
        sums = np.zeros((SKETCH_ROWS, 1 << SKETCH_BITS), np.int64)
        for b in batches:
            shing, _ = W.shingles(*W.hash_words(*W.buffers(b.column("text"))), width)
            for r in range(SKETCH_ROWS):
                sums[r] += np.bincount(cell(shing, r), minlength=1 << SKETCH_BITS)
        yield _blocks(sums)

    return _summed(docs.select("text").mapInArrow(count, "block int, counts binary"))


def class_counts(docs: DataFrame, width: int, hot: np.ndarray) -> tuple[np.ndarray, int]:
    """(counts[row, cell] of provisional classes by shingle in the ``hot`` cells, number of classes), over all rows of (id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    size = 1 << SKETCH_BITS
    span = SKETCH_ROWS * size

    def place(batches):
        marks = shared.value
        for b in batches:
            shing, at = W.shingles(*W.hash_words(*W.buffers(b.column("text"))), width)
            full = np.flatnonzero(np.diff(at))
            one, two = (np.minimum.reduceat(W.mix(shing ^ m), at[full]) if len(full) else np.zeros(0, np.uint64) for m in _MINHASH)
            group, own = np.unique(np.stack([one, two], 1).view(np.int64), axis=0, return_inverse=True)
            cells = [cell(shing, r) for r in range(SKETCH_ROWS)]
            often = np.flatnonzero(marks[0][cells[0]] & marks[1][cells[1]])
            holder = own[np.searchsorted(full, np.searchsorted(at, often, side="right") - 1)] if len(often) else np.zeros(0, np.int64)
            pairs = np.unique(np.concatenate([holder * span + r * size + cells[r][often] for r in range(SKETCH_ROWS)]))
            bounds = np.searchsorted(pairs // span, np.arange(len(group) + 1))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array((pairs % span).astype(np.int32)))
            yield pa.record_batch({"m1": pa.array(group[:, 0].copy()), "m2": pa.array(group[:, 1].copy()),
                                   "texts": pa.array(np.bincount(own, minlength=len(group)).astype(np.int64)), "cells": lists})

    def count(batches):
        # The rows of a class follow one another; each cell counts once for it.
        sums, last, held = np.zeros(span, np.int64), None, []
        for b in batches:
            ids, cells = b.column("class").to_numpy(), b.column("cells")
            for i in range(len(ids)):
                if ids[i] != last:
                    if held:
                        sums[np.unique(np.concatenate(held))] += 1
                    last, held = ids[i], []
                held.append(cells[i].values.to_numpy())
                if len(held) > 256:
                    held = [np.unique(np.concatenate(held))]
        if held:
            sums[np.unique(np.concatenate(held))] += 1
        yield _blocks(sums)

    groups = written(docs.select("text").mapInArrow(place, "m1 long, m2 long, texts long, cells array<int>"), "text-groups")
    lead = written(groups.groupBy("m1", "m2").agg(F.sum("texts").alias("texts")).groupBy("m1")
                   .agg(F.max_by("m2", F.struct("texts", "m2")).alias("class")), "text-classes")
    n = lead.select("class").distinct().count()
    held = groups.filter(F.size("cells") > 0).select("m1", "cells").join(lead, "m1").select("class", "cells")
    return _summed(held.repartition("class").sortWithinPartitions("class").mapInArrow(count, "block int, counts binary")), n


def frequencies(docs: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """(counts[row, cell] of classes by shingle, number of classes): counted where a shingle may be in over FLOOR of all texts."""
    seen = occurrence_sketch(docs, width)
    return class_counts(docs, width, seen > FLOOR * docs.count())


def idf_tables(counts: np.ndarray, n: int, floor: float = FLOOR) -> np.ndarray:
    """idf by sketch cell; a shingle's idf is the largest of its cells' (their counts only err upwards)."""
    share = np.clip(counts / max(n, 1), floor, None)
    return np.clip(np.log(1.0 / share) / np.log(1.0 / floor), 1e-3, 1.0).astype(np.float32)


def idf_of(shing: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return np.maximum(tables[0][cell(shing, 0)], tables[1][cell(shing, 1)])


# ---------------------------------------------------------------- ICWS signatures

def _quantiles() -> tuple[np.ndarray, np.ndarray]:
    """Gamma(2, 1) quantiles and -ln u at 65,536 mid-points."""
    u = (np.arange(65536) + 0.5) / 65536
    x = np.linspace(0, 30, 600_001)
    return np.interp(u, 1 - np.exp(-x) * (1 + x), x).astype(np.float32), (-np.log(u)).astype(np.float32)


_TABLES: list[np.ndarray] = []


def icws(shing: np.ndarray, weight: np.ndarray, heads: np.ndarray, samples: int) -> np.ndarray:
    """samples x texts: the consistent sample (shingle, step) of each text, packed in 64 bits.

    ``heads`` are the first shingles of the texts (none empty).  The upper half
    of a packed value is the sample's rank ln a as sortable bits.
    """
    if not _TABLES:
        _TABLES.extend(_quantiles())
    gamma, minus_log = _TABLES
    log_w = np.log(weight).astype(np.float32)
    out = np.empty((samples, len(heads)), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(samples):
            z = W.mix(shing + U((j + 1) * _GOLD & (2**64 - 1)))
            q = z.view(np.uint16).reshape(-1, 4)
            r = gamma[q[:, 0]]
            beta = q[:, 1].astype(np.float32)
            beta *= np.float32(1 / 65536)
            step = np.floor(log_w / r + beta)
            log_a = np.log(minus_log[q[:, 2]] + minus_log[q[:, 3]])
            log_a -= r * (step - beta + 1)
            bits = log_a.view(np.int32)
            bits = (bits ^ ((bits >> 31) | np.int32(-0x80000000))).view(np.uint32)
            low = (z.astype(np.uint32) * np.uint32(2654435761)) ^ (step.astype(np.int32).view(np.uint32) * np.uint32(40503))
            out[j] = np.minimum.reduceat((bits.astype(np.uint64) << U(32)) | low, heads)
    return out


def occurrences(shing: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) of every occurrence of a shingle, the n-th with a value of its own."""
    times = np.repeat(np.arange(len(tf)), tf)
    nth = np.arange(len(times)) - np.repeat(np.cumsum(tf) - tf, tf)
    with np.errstate(over="ignore"):
        return times, shing[times] + W.mix(nth.astype(np.uint64)) * (nth > 0)


def digests(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digest of each text's word sequence."""
    n = len(bounds) - 1
    out = []
    with np.errstate(over="ignore"):
        place = np.arange(len(hashes), dtype=np.int64) - np.repeat(bounds[:-1], np.diff(bounds))
        full = np.flatnonzero(np.diff(bounds))
        for seed in (0x452821E638D01377, 0xBE5466CF34E90C6C):
            h = np.zeros(n, np.uint64)
            if len(full):
                h[full] = np.add.reduceat(W.mix(hashes ^ W.mix(place.astype(np.uint64) + U(seed))), bounds[:-1][full])
            out.append(W.mix(h + np.diff(bounds).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def signatures(docs: DataFrame, tables, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, row, h1, h2, n, b0..): digest, number of shingles and band keys of every row of (doc_id, text)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tables)

    def sign(batches):
        idf = shared.value
        for b in batches:
            text = b.column("text")
            h1, h2 = digests(*W.hash_words(*W.buffers(text)))
            _, shing, tf, at = counted(text, width)
            weight = tf * idf_of(shing, idf)
            count = np.diff(at)
            keys = np.zeros((bands, len(count)), np.uint64)
            full = np.flatnonzero(count)
            start = 0
            while start < len(full):  # tiles that stay in the processor's cache
                stop = start + 1
                while stop < len(full) and at[full[stop] + 1] - at[full[start]] <= 65536:
                    stop += 1
                part = full[start:stop]
                lo, hi = at[part[0]], at[part[-1] + 1]
                sig = icws(shing[lo:hi], weight[lo:hi], at[part] - lo, bands * rows)
                with np.errstate(over="ignore"):
                    for k in range(bands):
                        key = np.full(len(part), U(k + 1))
                        for x in sig[k * rows:(k + 1) * rows]:
                            key = W.mix(key * U(31) + x)
                        keys[k, part] = key
                start = stop
            yield pa.record_batch([b.column("doc_id"), b.column("text_hash"), pa.array(h1), pa.array(h2), pa.array(count.astype(np.int32)),
                                   *[pa.array(k.view(np.int64)) for k in keys]],
                                  names=["doc_id", "text_hash", "h1", "h2", "n", *[f"b{k}" for k in range(bands)]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, h1 long, h2 long, n int, " + ", ".join(f"b{k} long" for k in range(bands))
    return written(docs.mapInArrow(sign, schema).withColumn("row", F.monotonically_increasing_id()), "signatures")


# ---------------------------------------------------------------- exact similarity

def pair_similarity(a: pa.Array, b: pa.Array, tables: np.ndarray, width: int) -> np.ndarray:
    """Weighted Jaccard of text i of ``a`` and text i of ``b``."""
    n = len(a)
    ta, sa, fa, _ = counted(a, width)
    tb, sb, fb, _ = counted(b, width)
    text, shing, tf = np.concatenate([ta, tb]), np.concatenate([sa, sb]), np.concatenate([fa, fb])
    order = np.argsort(shing, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    text, shing, tf = text[order], shing[order], tf[order]
    weight = idf_of(shing, tables).astype(np.float64)
    total = np.bincount(text, tf * weight, minlength=n)
    same = np.flatnonzero((text[1:] == text[:-1]) & (shing[1:] == shing[:-1]))
    both = np.bincount(text[same], np.minimum(tf[same], tf[same + 1]) * weight[same], minlength=n)
    return both / np.maximum(total - both, 1e-12)


def link_block(texts: pa.Array, comp: np.ndarray, focus: np.ndarray, member: np.ndarray, tables: np.ndarray,
               width: int, threshold: float) -> list[tuple[int, int]]:
    """Links (component, component) between focus and member texts that join different components."""
    text, shing, tf, at = counted(texts, width)
    weight = idf_of(shing, tables).astype(np.float64)
    total = np.bincount(text, tf * weight, minlength=len(texts))
    # One column per occurrence number: sums of products are then sums of minima.
    times, column = occurrences(shing, tf)
    column, place, often = np.unique(column, return_inverse=True, return_counts=True)
    shared = often[place] > 1
    rank = np.cumsum(often > 1) - 1
    col, who, w = rank[place[shared]], text[times[shared]], np.sqrt(weight[times[shared]])
    order = np.argsort(col, kind="stable")
    col, who, w = col[order], who[order], w[order]
    f, m = np.flatnonzero(focus), np.flatnonzero(member)
    both = np.zeros((len(f), len(m)))
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, TILE):
        a, b = np.searchsorted(col, [lo, lo + TILE])
        tile = np.zeros((len(texts), TILE), np.float32)
        tile[who[a:b], col[a:b] - lo] = w[a:b]
        both += tile[f] @ tile[m].T
    # float32 sums can be off by about 1e-6: accept from just below, then look again exactly.
    near = both >= (threshold - 1e-4) * (total[f][:, None] + total[m][None, :] - both)
    x, y = np.nonzero(near & (comp[f][:, None] != comp[m][None, :]))
    links, up = [], {}

    def root(c):
        while up.get(c, c) != c:
            c = up[c]
        return c

    for i, j in zip(f[x], m[y]):
        a, b = root(int(comp[i])), root(int(comp[j]))
        if a == b:
            continue
        one, two = slice(at[i], at[i + 1]), slice(at[j], at[j + 1])
        _, p, q = np.intersect1d(shing[one], shing[two], assume_unique=True, return_indices=True)
        common = (np.minimum(tf[one][p], tf[two][q]) * weight[one][p]).sum()
        if common >= threshold * (total[i] + total[j] - common) - 1e-9:
            up[max(a, b)] = min(a, b)
            links.append((int(comp[i]), int(comp[j])))
    return links


# ---------------------------------------------------------------- the operator

def _candidate_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes (node, k, text_hash, h1, h2), found by id and text hash and confirmed by digest."""

    def confirm(batches):
        for b in batches:
            h1, h2 = digests(*W.hash_words(*W.buffers(b.column("text"))))
            same = (h1 == b.column("h1").to_numpy()) & (h2 == b.column("h2").to_numpy())
            yield b.select(["node", "text"]).filter(pa.array(same))

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k"), "text_hash", "text")
    found = keyed.join(wanted, ["k", "text_hash"]).mapInArrow(confirm, "node long, text string")
    return written(found.groupBy("node").agg(F.first("text").alias("text")), "candidate-texts")


def _verified(pairs: DataFrame, texts: DataFrame, tables, width: int, threshold: float) -> DataFrame:
    """The pairs (node, leader) whose similarity reaches the threshold."""
    shared = pairs.sparkSession.sparkContext.broadcast(tables)

    def compare(batches):
        for b in batches:
            sim = pair_similarity(b.column("text"), b.column("other"), shared.value, width)
            yield b.select(["node", "leader"]).filter(pa.array(sim >= threshold - 1e-9))

    leaders = texts.select(F.col("node").alias("leader"), F.col("text").alias("other"))
    return (pairs.join(texts, "node").join(leaders, "leader").select("node", "leader", "text", "other")
            .mapInArrow(compare, "node long, leader long"))


def _block_links(members: DataFrame, texts: DataFrame, tables, width: int, threshold: float) -> DataFrame:
    """Links of step 4; ``members`` are (band, key, node, n, leader, comp) with the leaders' own rows left out."""
    shared = members.sparkSession.sparkContext.broadcast(tables)
    key = ["band", "key"]
    by_comp = members.groupBy(*key, "comp").agg(F.count(F.lit(1)).alias("c"))
    tops = by_comp.groupBy(*key).agg(F.max_by("comp", "c").alias("main"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    tops = written(tops.select(*key, "main"), "open-buckets")
    if tops.isEmpty():
        return members.select(F.col("node").alias("node"), F.col("node").alias("leader")).limit(0)
    marked = members.join(tops, key).withColumn("focus", F.col("comp") != F.col("main"))
    # Buckets of several bands that hold the same nodes are one piece of work.
    own, other = F.xxhash64("node", "comp"), F.xxhash64(F.lit(7), "comp", "node")
    facts = marked.groupBy(*key).agg(
        F.sum(own % 1_000_000_007).alias("s1"), F.sum(other % 998_244_353).alias("s2"), F.count(F.lit(1)).alias("nodes"),
        F.sum("n").alias("shingles"), F.sum(F.col("focus").cast("long")).alias("f_nodes"),
        F.sum(F.when(F.col("focus"), F.col("n")).otherwise(0)).alias("f_shingles"))
    once = facts.groupBy("s1", "s2", "nodes", "shingles", "f_nodes", "f_shingles").agg(F.min(F.struct(*key)).alias("b"))
    parts = lambda rows, grams: F.ceil(F.greatest(F.col(rows) / BLOCK_NODES, F.col(grams) / BLOCK_SHINGLES, F.lit(1.0))).cast("int")
    once = written(once.select("b.band", "b.key", parts("nodes", "shingles").alias("m_parts"), parts("f_nodes", "f_shingles").alias("f_parts")),
                   "distinct-buckets")
    dealt = marked.join(once, key)
    spread = F.xxhash64(F.lit(11), "node")
    as_member = dealt.select(*key, "node", "comp", F.lit(False).alias("focus"), F.pmod(spread, F.col("m_parts")).cast("int").alias("mp"),
                             F.explode(F.sequence(F.lit(0), F.col("f_parts") - 1)).alias("fp"))
    as_focus = dealt.filter("focus").select(*key, "node", "comp", "focus", F.explode(F.sequence(F.lit(0), F.col("m_parts") - 1)).alias("mp"),
                                            F.pmod(spread, F.col("f_parts")).cast("int").alias("fp"))
    rows = as_member.unionByName(as_focus).join(texts, "node")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        focus = pdf["focus"].to_numpy(bool)
        block = pa.array(pdf["text"], pa.string()), pdf["comp"].to_numpy(np.int64), focus, ~focus
        got = link_block(*block, shared.value, width, threshold)
        return pd.DataFrame(got, columns=["node", "leader"]).astype("int64")

    return rows.groupBy(*key, "mp", "fp").applyInPandas(link, "node long, leader long")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                 threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id, class_size, kept, text_hash): one row per row of ``docs``.

    ``class_id`` is the smallest id in the class; rows that have it stay.  Texts
    without a word (null, empty, signs only) are classes of their own.  Rows with
    the same word sequence are in one class.  ``text_hash`` (xxhash64) tells rows
    apart that repeat an id with another text.  Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    tables = idf_tables(*frequencies(docs, width))
    sig = signatures(docs, tables, width, bands, rows)

    names = [f"b{k}" for k in range(bands)]
    nodes = written(sig.filter("n > 0").groupBy("h1", "h2").agg(
        F.min("row").alias("node"), F.min(F.struct("doc_id", "text_hash")).alias("least_row"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"),
        *[F.max(b).alias(b) for b in names]), "nodes")
    keyed = nodes.select("node", "n", F.inline(F.array(*[F.struct(F.lit(k).alias("band"), F.col(b).alias("key")) for k, b in enumerate(names)])))
    buckets = written(keyed.groupBy("band", "key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("c")).filter("c > 1")
                      .select("band", "key", "leader"), "buckets")
    members = written(keyed.join(buckets, ["band", "key"]), "members")

    wanted = members.select("node").distinct().join(
        nodes.select("node", F.coalesce(F.col("least_row.doc_id").cast("string"), F.lit("")).alias("k"), F.col("least_row.text_hash").alias("text_hash"),
                     "h1", "h2"), "node")
    texts = _candidate_texts(docs, wanted)
    others = members.filter("node <> leader")
    links = written(_verified(others.select("node", "leader").distinct(), texts, tables, width, threshold), "links-1")
    first = written(components(links, "node", "leader"), "components-1")
    placed = written(others.join(first, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root"), "placed")
    more = _block_links(placed, texts, tables, width, threshold)
    rooted = first.select("node", F.col("root").alias("leader"))
    final = written(components(rooted.unionByName(more), "node", "leader"), "components")

    digest = written(nodes.join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
                     .select("h1", "h2", "root", "least", "copies"), "digest-classes")
    classes = written(digest.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
                      .filter("class_size > 1"), "classes")
    labelled = written(digest.join(classes, "root").select("h1", "h2", "class_id", "class_size"), "labelled")
    merged = sig.filter("n > 0").select("doc_id", "text_hash", "h1", "h2").join(labelled, ["h1", "h2"], "left")
    own = F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    table = (merged.select("doc_id", "text_hash", "class_id", "class_size")
             .unionByName(sig.filter("n = 0").select("doc_id", "text_hash"), allowMissingColumns=True))
    return table.select("doc_id", own.alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
                        F.col("doc_id").eqNullSafe(own).alias("kept"), "text_hash")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that stay: one document of each class."""
    found = near_classes(docs, id_col, text_col, **options)
    gone = written(found.filter("NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")), "near-copies")
    return docs.join(gone, docs[id_col].eqNullSafe(gone.gone_id) & (F.xxhash64(text_of(docs, text_col)) == gone.gone_hash), "left_anti")
