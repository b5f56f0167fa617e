"""Exact dedup by content-defined chunk recipes.

Texts are equal when identical after every run of white space
(``[\\x20\\x09-\\x0D]+``) became one space.  Method:

1. A text is cut at content-defined points: the first sentence end at least
   ``MIN_CHUNK`` characters after the previous cut, and a cut after
   ``MAX_CHUNK`` characters where there is none.
2. Each chunk gets a 64-bit identifier.  The identifiers are verified against
   the chunk contents: distinct (identifier, content) pairs are counted per
   identifier, and contents that share one get an ordinal.  Chunk contents
   move once, after a map-side distinct.
3. A document is then its ordered identifier list.  Lists are grouped and
   compared; the texts themselves never move.

Only built-in functions.  A text shared by a third of all rows folds in the
map-side partial aggregate; the join back is a plain sort-merge join of two
written tables, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepace.llm.common import text_of, written

MIN_CHUNK, MAX_CHUNK = 512, 8192
CUT = rf"(?s)(?:.{{{MIN_CHUNK - 1},{MAX_CHUNK - 2}}}?[.!?]|.{{1,{MAX_CHUNK}}})"
WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, " ")


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(normalised(text), F.lit(CUT), F.lit(0))


def _identifier(chunk: Column, bits: int) -> Column:
    h = F.xxhash64(chunk)
    return h if bits >= 64 else h.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def colliding_chunks(docs: DataFrame, text_col: str = "text", bits: int = 64) -> DataFrame | None:
    """(c_id, c_chunk, c_ord): contents that share an identifier with another content; None if none do."""
    pairs = (docs.select(F.explode(_chunks(text_of(docs, text_col))).alias("c_chunk"))
             .select(_identifier(F.col("c_chunk"), bits).alias("c_id"), "c_chunk").distinct())
    clashes = pairs.groupBy("c_id").count().filter("count > 1").select("c_id")
    clashes = written(clashes, "chunk-clashes")
    if clashes.isEmpty():
        return None
    # Rare: fetch the contents of the shared identifiers and number them.  A
    # group holds the few distinct contents of one 64-bit identifier.
    both = pairs.join(clashes, "c_id", "left_semi")
    ranks = both.alias("a").join(both.select("c_id", F.col("c_chunk").alias("other")), "c_id")
    return (ranks.groupBy("c_id", "c_chunk").agg(F.sum((F.col("other") < F.col("c_chunk")).cast("int")).cast("int").alias("c_ord")))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """(doc_id, text_sha256, recipe, fix): one row per document, equal texts have equal (recipe, fix).

    ``recipe`` is the ordered list of chunk identifiers; ``fix`` is empty unless
    an identifier stands for several contents, and then holds the ordinals.
    """
    text = text_of(docs, text_col)
    ident = lambda c: _identifier(c, bits)
    base = docs.select(docs[id_col].alias("doc_id"), F.sha2(normalised(text).cast("binary"), 256).alias("text_sha256"),
                       _chunks(text).alias("chunks"))
    plain = base.select("doc_id", "text_sha256", F.transform("chunks", ident).alias("recipe"),
                        F.array().cast("array<int>").alias("fix"))
    clashes = colliding_chunks(docs, text_col, bits)
    if clashes is not None:
        clashes = written(clashes, "chunk-ordinals")
        parts = (base.withColumn("row", F.monotonically_increasing_id())
                 .select("row", "doc_id", "text_sha256", F.posexplode_outer("chunks").alias("pos", "chunk"))
                 .withColumn("id", ident(F.col("chunk"))))
        parts = parts.join(clashes, (parts.id == clashes.c_id) & (parts.chunk == clashes.c_chunk), "left")
        listed = F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "id", F.coalesce("c_ord", F.lit(0)).alias("o")))))
        plain = (parts.groupBy("row", "doc_id", "text_sha256").agg(listed.alias("l"))
                 .select("doc_id", "text_sha256", F.col("l.id").alias("recipe"), F.col("l.o").alias("fix")))
    return written(plain, "recipes")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    Of equal texts the row with the smallest id stays; null text counts as
    empty; rows that repeat the kept id stay with it; a null id is kept only
    where no row of its group has an id.  Other columns are not read.
    """
    table = recipes(docs, id_col, text_col, bits)
    groups = (table.groupBy("recipe", "fix").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .filter("group_size > 1"))
    groups = written(groups, "recipe-groups")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (table.join(groups, ["recipe", "fix"], "left")
            .select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"),
                    "text_sha256"))
