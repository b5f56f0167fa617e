"""Training-order materialisation: packed token sequences at permuted slots, in fixed-stride shards.

1. Documents are tokenised where they lie (byte-level BPE, two bytes an id) and each
   ends with the end-of-text id.  A task writes its documents with their running
   token offset; the table's order is (task, offset).
2. The tasks' totals (one row each) give every document its place in one global stream, which is cut into
   sequences of ``length`` tokens; the last one is padded with end-of-text ids.
3. A keyed Feistel network over the next power of four, walked until it falls below the
   number of sequences, is a permutation: sequence i gets slot P(i).  Nothing is sorted or
   collected to shuffle, and any slot can be computed, and inverted, on its own.
4. The pieces of sequences are range-partitioned by shard (``per_shard`` slots), sorted by slot
   and joined to records of exactly ``2 length`` bytes.  Record s lies at byte
   ``2 length (s mod per_shard)`` of shard ``s div per_shard``, so a reader resumes at any slot.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonepace.llm.common import at_most, small_batches, text_of, written
from zonepace.llm.token_count import Pieces
from zonepace.llm.words import SPACED, Known, U, buffers, hash_words, mix

LENGTH, PER_SHARD, KEY, ROUNDS = 2048, 2048, 20240601, 6
CACHE_TOKENS = 1_000_000  # entries of fixed width; four times as many ids
# The white space beyond ASCII, in UTF-8.
WIDE_WHITE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
MAX_PARTS = 2_000_000


# ---------------------------------------------------------------- the permutation

def _feistel(x: np.ndarray, half: int, key: int, inverse: bool) -> np.ndarray:
    mask = U((1 << half) - 1)
    left, right = x >> U(half), x & mask
    with np.errstate(over="ignore"):
        for r in range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS):
            salt = mix(np.array([(key * 0x9E3779B97F4A7C15 + r + 1) & (2**64 - 1)], np.uint64))[0]
            if inverse:
                left, right = right ^ (mix(left + salt) & mask), left
            else:
                left, right = right, left ^ (mix(right + salt) & mask)
    return (left << U(half)) | right


def permute(index: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """The slot of each sequence (or, inverted, the sequence of each slot): a permutation of 0..n-1."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    out = _feistel(np.asarray(index).astype(np.uint64), half, key, inverse)
    while len(walk := np.flatnonzero(out >= U(n))):
        out[walk] = _feistel(out[walk], half, key, inverse)
    return out.astype(np.int64)


# ---------------------------------------------------------------- tokens

class Encoder:
    """Token ids of whole texts as little-endian 16-bit numbers; one per worker.

    In the vocabulary's pattern, what lies between ASCII white space is cut without regard to its
    neighbours; only whether a single space goes before it matters.  So each distinct (word, space before)
    is encoded once, found again by its hash, and a text's ids are gathered from the stored ones.  Other white
    space (line feeds, runs) is a pre-token or two of its own.  Batches with white space beyond ASCII, which may
    join such runs, are cut by the pattern itself.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # The vocabulary's pre-token pattern.
        self.pieces = Pieces("'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{white}{letters}{numbers}]+"
                             "|[{white}]+(?![^{white}])|[{white}]+")
        self.end = max(ranks.values()) + 1
        self.stop = ranks[b"\0"]
        # Two ways to encode given pre-tokens: many at once between zero bytes, or one that holds such a byte.
        self.many = tiktoken.Encoding("many", pat_str=r"\x00|[^\x00]+", mergeable_ranks=ranks, special_tokens={})
        self.one = tiktoken.Encoding("one", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self._reset()

    def _reset(self) -> None:
        """Entry 0 is empty, entry 1 the end of a text."""
        self.known, self.gaps = Known(), {}
        self.flat = np.array([self.end], "<u2")
        self.begin, self.size = np.array([0, 0]), np.array([0, 1])

    def _encoded(self, pieces: set[str]) -> dict[str, bytes]:
        plain = [p for p in pieces if "\0" not in p]
        ids = np.array(self.many.encode_ordinary("\0".join(plain)), "<u2")
        stops = np.flatnonzero(ids == self.stop)
        raw = ids.tobytes()
        starts, ends = [0, *(2 * stops + 2).tolist()], [*(2 * stops).tolist(), len(raw)]
        out = dict(zip(plain, [raw[a:b] for a, b in zip(starts, ends)]))
        out.update((p, np.array(self.one.encode_ordinary(p), "<u2").tobytes()) for p in pieces if "\0" in p)
        return out

    def _enter(self, cut: list[list[str]]) -> np.ndarray:
        """New entries, one per list of pre-tokens."""
        got = self._encoded({p for pieces in cut for p in pieces})
        raw = [b"".join(map(got.__getitem__, pieces)) for pieces in cut]
        size = np.array([len(r) // 2 for r in raw])
        first = len(self.size)
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(raw), "<u2")])
        return np.arange(first, first + len(cut))

    def _gap(self, gap: bytes, last: bool) -> int:
        """The entry of white space before a word (less the space that goes with the word) or at a text's end."""
        if (gap, last) not in self.gaps:
            text = gap.decode()
            cut = [text] if last else [text[:-1]] if text.endswith(" ") else [text[:-1], text[-1]]
            self.gaps[gap, last] = int(self._enter([[p for p in cut if p]])[0])
        return self.gaps[gap, last]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of each text's), each text closed by the end-of-text id; nulls are empty."""
        data, offsets = buffers(column)
        if len(offsets) < 2:
            return np.zeros(0, "<u2"), np.zeros(0, np.int64)
        if len(self.size) > CACHE_TOKENS or len(self.flat) > 4 * CACHE_TOKENS:
            self._reset()
        if WIDE_WHITE.search(data[offsets[0]:offsets[-1]]):
            texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
            cut = list(map(self.pieces, texts))
            got = self._encoded({p for pieces in cut for p in pieces})
            raw = [b"".join(map(got.__getitem__, pieces)) + np.array([self.end], "<u2").tobytes() for pieces in cut]
            return np.frombuffer(b"".join(raw), "<u2"), np.array([len(r) // 2 for r in raw])
        hashes, bounds, starts, ends = hash_words(data, offsets, True, SPACED)
        n, texts = np.diff(bounds), len(bounds) - 1
        text = np.repeat(np.arange(texts), n)
        before = np.concatenate([[0], ends[:-1]])
        heads = bounds[:-1][n > 0]
        before[heads] = offsets[:-1][n > 0]
        spaced = (starts > before) & (data[np.maximum(starts - 1, 0)] == 32)
        entries = np.zeros(2 * len(starts) + 2 * texts, np.int64)
        word_at = 2 * np.arange(len(starts)) + 2 * text + 1
        kinds, first, place = np.unique(mix(hashes + spaced.astype(np.uint64)), return_index=True, return_inverse=True)
        at = self.known.find(kinds)
        new = np.flatnonzero(at < 0)
        if len(new):
            own = first[new]
            cut = [self.pieces((" " if s else "") + data[a:b].tobytes().decode()) for s, a, b in zip(spaced[own], starts[own], ends[own])]
            at[new] = self._enter(cut)
            self.known.add(kinds[new], at[new])
        entries[word_at] = at[place]
        # White space that is more than the one space of the word behind it.
        for i in np.flatnonzero(starts - before > spaced):
            entries[word_at[i] - 1] = self._gap(data[before[i]:starts[i]].tobytes(), False)
        tail = offsets[:-1].copy()
        tail[n > 0] = ends[bounds[1:][n > 0] - 1]
        end_at = 2 * bounds[1:] + 2 * np.arange(texts)
        for t in np.flatnonzero(offsets[1:] > tail):
            entries[end_at[t]] = self._gap(data[tail[t]:offsets[t + 1]].tobytes(), True)
        entries[end_at + 1] = 1
        size = self.size[entries]
        upto = np.cumsum(size)
        ids = self.flat[np.repeat(self.begin[entries] - (upto - size), size) + np.arange(int(upto[-1]))]
        return ids, np.diff(np.concatenate([[0], upto[end_at + 1]]))


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The worker's encoder: what one task has learnt serves the next."""
    return Encoder(path)


def tokenised(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, at, n, doc_id, ids): the ids of every document with its offset in its task's stream, written."""
    small_batches(docs.sparkSession)
    source = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        encoder, part, at = encoder_of(vocabulary), TaskContext.get().partitionId(), 0
        for b in batches:
            ids, n = encoder.encode(b.column("text"))
            bounds = np.concatenate([[0], np.cumsum(n)])
            raw = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(2 * bounds), pa.py_buffer(ids)]).cast(pa.binary())
            yield pa.record_batch({"part": pa.array(np.full(len(n), part)), "at": pa.array(at + bounds[:-1]), "n": pa.array(n),
                                   "doc_id": b.column("doc_id"), "ids": raw})
            at += int(bounds[-1])

    return written(source.mapInArrow(encode, f"part long, at long, n long, doc_id {kind}, ids binary"), "tokens")


# ---------------------------------------------------------------- sequences and shards

def training_order(docs: DataFrame, vocabulary: str, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """shard, slot, byte_offset, sequence, n_tokens, doc_ids, payload: one row per sequence, in slot order within a shard.

    ``payload`` has exactly ``2 * length`` bytes; ``n_tokens`` counts those before the padding;
    ``doc_ids`` are the documents in the sequence, in order.  Null and empty texts are one end-of-text id;
    repeated rows are packed as often as they come; an empty table has no sequence.  Other columns are
    not read.
    """
    table = tokenised(docs, vocabulary, id_col, text_col)
    kind = table.schema["doc_id"].dataType.simpleString()
    parts = written(table.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("size")), "token-parts")
    # One row per task of the tokenising stage, whatever the size of its texts.
    if not at_most(parts, MAX_PARTS):
        raise ValueError("too many tokenising tasks; coalesce the documents")
    total = int(parts.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("t")).first()["t"])
    n = -(-total // length)
    bases = parts.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("base"))
    placed = table.join(F.broadcast(bases), "part").select((F.col("base") + F.col("at")).alias("start"), "n", "doc_id", "ids")

    def cut(batches):
        for b in batches:
            starts, sizes = b.column("start").to_numpy(), b.column("n").to_numpy()
            stream = np.frombuffer(b"".join(b.column("ids").to_pylist()), np.uint8)
            if not len(starts):
                continue
            # Rows that follow one another in the stream are cut as one stretch.
            fresh = np.flatnonzero(np.concatenate([[True], starts[1:] != starts[:-1] + sizes[:-1]]))
            local = np.cumsum(sizes) - sizes
            sequence, at, payload, ids = [], [], [], []
            docs_of = b.column("doc_id")
            for k, first in enumerate(fresh):
                last = int(fresh[k + 1]) if k + 1 < len(fresh) else len(starts)
                begin, end = int(starts[first]), int(starts[last - 1] + sizes[last - 1])
                for s in range(begin // length, -(-end // length)):
                    lo, hi = max(begin, s * length), min(end, (s + 1) * length)
                    base = int(local[first]) - begin
                    sequence.append(s)
                    at.append(lo - s * length)
                    payload.append(stream[2 * (lo + base):2 * (hi + base)].tobytes())
                    i = first + int(np.searchsorted(starts[first:last], lo, side="right")) - 1
                    j = first + int(np.searchsorted(starts[first:last], hi, side="left"))
                    ids.append((i, j))
            count = np.array([j - i for i, j in ids])
            take = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat([i for i, _ in ids], count)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), docs_of.take(pa.array(take)))
            slot = permute(np.array(sequence), n, key)
            yield pa.record_batch({"shard": pa.array(slot // per_shard), "slot": pa.array(slot), "sequence": pa.array(sequence, pa.int64()),
                                   "at": pa.array(at, pa.int32()), "doc_ids": lists, "payload": pa.array(payload, pa.binary())})

    pieces = placed.mapInArrow(cut, f"shard long, slot long, sequence long, at int, doc_ids array<{kind}>, payload binary")
    shards = max(1, -(-n // per_shard))
    dealt = pieces.repartitionByRange(shards, "shard").sortWithinPartitions("slot", "at")
    id_type = pa.list_(_arrow_type(docs, id_col))
    pad = None

    def assemble(batches):
        nonlocal pad
        pad = pad or _end_id(vocabulary).to_bytes(2, "little")
        slot = None

        def record():
            body = b"".join(held)
            return slot, sequence, len(body) // 2, doc_ids, body + pad * (length - len(body) // 2)

        def batch(rows):
            slots = np.array([r[0] for r in rows], np.int64)
            return pa.record_batch({
                "shard": pa.array(slots // per_shard), "slot": pa.array(slots), "byte_offset": pa.array(slots % per_shard * 2 * length),
                "sequence": pa.array([r[1] for r in rows], pa.int64()), "n_tokens": pa.array([r[2] for r in rows], pa.int32()),
                "doc_ids": pa.array([r[3] for r in rows], id_type), "payload": pa.array([r[4] for r in rows], pa.binary())})

        for b in batches:
            rows = []
            for s, q, ids, body in zip(b.column("slot").to_pylist(), b.column("sequence").to_pylist(), b.column("doc_ids").to_pylist(),
                                       b.column("payload").to_pylist()):
                if s == slot:
                    held.append(body)
                    doc_ids.extend(ids)
                    continue
                if slot is not None:
                    rows.append(record())
                slot, sequence, held, doc_ids = s, q, [body], list(ids)
            if rows:
                yield batch(rows)
        if slot is not None:
            yield batch([record()])

    return dealt.mapInArrow(assemble, f"shard long, slot long, byte_offset long, sequence long, n_tokens int, doc_ids array<{kind}>, payload binary")


def _arrow_type(docs: DataFrame, col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[col].dataType)


def _end_id(path: str) -> int:
    with open(path, "rb") as f:
        return max(int(x.split()[1]) for x in f) + 1


def write_shards(sequences: DataFrame, path: str) -> None:
    """One folder per shard, its records in slot order."""
    sequences.write.partitionBy("shard").parquet(path)


def read_slots(spark: SparkSession, path: str, first: int, count: int, per_shard: int = PER_SHARD) -> DataFrame:
    """Records first..first + count - 1 in order: only their shards are read, so a stopped run resumes at its slot."""
    rows = spark.read.parquet(path)
    last = first + count - 1
    return (rows.filter(F.col("shard").between(first // per_shard, last // per_shard) & F.col("slot").between(first, last))
            .orderBy("slot"))
