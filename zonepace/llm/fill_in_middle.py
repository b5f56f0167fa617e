"""Fill-in-middle transformation by secondary-sort assembly.

A text of n code points is cut at two of them into prefix, middle and suffix.  Seed and
document id decide where and in which form the parts are put together (``plan``):

    plain   the text as it is
    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle

1. Each task cuts its texts into pieces of at most ``UNITS`` code points, a sentinel
   with the piece that follows it, keyed by (row, place in the output).
2. Pieces are repartitioned by row and sorted within their partition by (row, place):
   the DataFrame form of ``repartitionAndSortWithinPartitions``, done (and
   spilled) by the JVM.  A partition is then read as a stream; the digest of
   each output grows piece by piece, and no text is ever put together in memory.
3. Restoration reads that stream again as an output of its form: it looks for the
   sentinels in the bytes, keys what lies between them by (row, place in the source),
   and the same partition is sorted again by that key (no second shuffle).  Its stream gives the
   digest of the restored text.

A long text is many pieces of one row, which its task streams; copies of a row
are rows of their own, so no key is hot.  Row numbers follow the rows as they are read: give a
table or another source whose order does not change when a task is run again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace.llm import words as W
from zonepace.llm.common import small_batches, text_of

UNITS = 65_536
SEED, RATE, SPM_RATE = 1, 90, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# Parts in output order, by form: (sentinel, place of the part in the source).
ORDER = {"plain": [(b"", 0)], "psm": [(PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)], "spm": [(SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)]}
_FACTS = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(row, doc_id, text, n, form, prefix_chars, middle_chars): form and cuts of every row; a null id counts as an empty one."""
    text = text_of(docs, text_col)
    own = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id_col].cast("string"), F.lit(""))).cast("binary"), 256)
    base = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), text.alias("text"),
                       F.length(text).cast("long").alias("n"),
                       *[F.conv(F.substring(own, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)])
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    marked = F.lit(False)
    for s in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(s.decode()))
    plain = (F.col("n") == 0) | marked | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_rate, "spm").otherwise("psm")
    return base.select("row", "doc_id", "text", "n", form.alias("form"), F.when(~plain, F.least(one, two)).alias("prefix_chars"),
                       F.when(~plain, F.abs(one - two)).alias("middle_chars"))


def byte_places(data: np.ndarray, points: list[int]) -> list[int]:
    """Byte offsets of code points (rising numbers; the number of all of them is the end), block by block."""
    out, seen, k = [], 0, 0
    for at in range(0, len(data), W.BLOCK):
        first = (data[at:at + W.BLOCK] & 0xC0) != 0x80
        count = int(np.count_nonzero(first))
        if k < len(points) and points[k] < seen + count:
            starts = np.flatnonzero(first)
            while k < len(points) and points[k] < seen + count:
                out.append(at + int(starts[points[k] - seen]))
                k += 1
        seen += count
    return out + [len(data)] * (len(points) - k)


def cut(data: np.ndarray, n: int, form: str, prefix: int | None, middle: int | None, units: int) -> list[bytes]:
    """The pieces of one output in order; an empty output is one empty piece."""
    ends = [0, n, n, n] if form == "plain" else [0, prefix, prefix + middle, n]
    points = sorted({*ends, *range(0, n, units)})
    place = dict(zip(points, points if len(data) == n else byte_places(data, points)))
    pieces = []
    for sentinel, part in ORDER[form]:
        own = [p for p in points if ends[part] <= p <= ends[part + 1]]
        raw = [data[place[a]:place[b]].tobytes() for a, b in zip(own, own[1:])] or [b""]
        pieces += [sentinel + raw[0], *raw[1:]]
    return pieces


def fim_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
               spm_rate: int = SPM_RATE, units: int = UNITS) -> DataFrame:
    """(row, place, doc_id, n, form, prefix_chars, middle_chars, piece): the outputs as pieces, each row's together and in order.

    ``piece`` is UTF-8; the facts of a row stand on its piece 0 and are null on the others.
    """
    small_batches(docs.sparkSession)
    source = plan(docs, id_col, text_col, seed, rate, spm_rate)

    def emit(batches):
        for b in batches:
            data, offsets = W.buffers(b.column("text"))
            facts = zip(*[b.column(c).to_pylist() for c in _FACTS[1:]])
            rows, places, pieces = [], [], []
            for i, own in enumerate(facts):
                got = cut(data[offsets[i]:offsets[i + 1]], *own, units)
                rows += [i] * len(got)
                places += range(len(got))
                pieces += got
            take = pa.array(rows, pa.int64())
            head = pa.array([r if p == 0 else None for r, p in zip(rows, places)], pa.int64())
            yield pa.record_batch([b.column("row").take(take), pa.array(places, pa.int32()), *[b.column(c).take(head) for c in _FACTS],
                                   pa.array(pieces, pa.binary())], names=["row", "place", *_FACTS, "piece"])

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"row long, place int, doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, piece binary"
    pieces = source.mapInArrow(emit, schema)
    return pieces.repartition("row").sortWithinPartitions("row", "place")


class _Reader:
    """Reads one output of a known form piece by piece: (place in the source, bytes) of what lies between its sentinels."""

    def __init__(self, form: str):
        self.parts, self.part, self.carry = list(ORDER[form]), 0, b""
        if self.parts[0][0] == b"":
            self.parts = self.parts[1:]

    def read(self, piece: bytes) -> list[tuple[int, bytes]]:
        data, out = self.carry + piece, []
        self.carry = b""
        while self.parts:
            sentinel, part = self.parts[0]
            at = data.find(sentinel)
            if at < 0:  # the piece may end inside a sentinel
                keep = next((k for k in (2, 1) if data.endswith(sentinel[:k])), 0)
                data, self.carry = data[:len(data) - keep], data[len(data) - keep:]
                break
            out.append((self.part, data[:at]))
            data, self.part, self.parts = data[at + len(sentinel):], part, self.parts[1:]
        return [(p, d) for p, d in [*out, (self.part, data)] if d]


def fim_digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256: one row per row of ``docs``.

    Null and empty texts, and texts that hold a sentinel, are plain; repeated rows each have their row; null ids
    are cut like an empty id; very long texts pass as pieces.  Other columns are not read.
    """
    pieces = fim_pieces(docs, **options)
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def assemble(batches):
        row = sha = reader = head = None
        seq = 0

        def close():
            return [(row, -1, 0, None, sha.hexdigest(), head)] if row is not None else []

        for b in batches:
            out = []
            for i, (r, place, piece) in enumerate(zip(b.column("row").to_pylist(), b.column("place").to_pylist(), b.column("piece").to_pylist())):
                if r != row:
                    out += close()
                    row, sha, seq = r, hashlib.sha256(), 0
                    head = [b.column(c)[i] for c in _FACTS]
                    reader = _Reader(head[2].as_py())
                sha.update(piece)
                for part, raw in reader.read(piece):
                    out.append((row, part, seq, raw, None, None))
                    seq += 1
            yield _restorable(out)
        yield _restorable(close())

    types = {"doc_id": None, "n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}
    from pyspark.sql.pandas.types import to_arrow_type
    types["doc_id"] = to_arrow_type(pieces.schema["doc_id"].dataType)

    def _restorable(out):
        blank = [None] * len(_FACTS)
        heads = list(zip(*[[x.as_py() if x is not None else None for x in o[5]] if o[5] else blank for o in out])) or [()] * len(_FACTS)
        cols = list(zip(*[o[:5] for o in out])) or [()] * 5
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.string()))]
                               + [pa.array(c, types[f]) for c, f in zip(heads, _FACTS)],
                               names=["row", "part", "seq", "raw", "output_sha256", *_FACTS])

    schema = f"row long, part int, seq long, raw binary, output_sha256 string, doc_id {kind}, n long, form string, prefix_chars long, middle_chars long"
    again = pieces.mapInArrow(assemble, schema).sortWithinPartitions("row", "part", "seq")

    def restore(batches):
        row = sha = head = None
        for b in batches:
            heads, digests = [], []
            for i, (r, raw) in enumerate(zip(b.column("row").to_pylist(), b.column("raw").to_pylist())):
                if r != row:  # the head row of a text sorts before its pieces
                    if row is not None:
                        heads.append(head)
                        digests.append(sha.hexdigest())
                    row, sha, head = r, hashlib.sha256(), b.slice(i, 1)
                else:
                    sha.update(raw)
            if heads:
                yield _finished(heads, digests)
        if row is not None:
            yield _finished([head], [sha.hexdigest()])

    def _finished(heads, digests):
        table = pa.Table.from_batches(heads).select([*_FACTS, "output_sha256"]).combine_chunks()
        return table.append_column("restored_sha256", pa.array(digests)).combine_chunks().to_batches()[0]

    return again.mapInArrow(restore, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
