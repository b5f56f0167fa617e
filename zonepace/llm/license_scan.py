"""Licence scans: Dice coefficient over word bigrams, with size bounds.

A text is normalised (ASCII lower case; every run of other characters than
letters, digits and line feeds is one space).  Its units are

- ``line``: its lines,
- ``paragraph``: its paragraphs (parted by blank lines) of several lines,
- ``text``: the whole text, where it has several lines,
- ``window``: stretches of as many words as a template has, laid over the text, line breaks
  ignored, so that one of the template's anchors stands at its own place; clipped at the ends of the text.

A unit's set of word bigrams A is compared with a template's set B by
Dice = 2|A and B| / (|A| + |B|).  Dice >= t needs |A| between |B| t/(2-t) and
|B| (2-t)/t, and at least |B| t/(2-t) common bigrams; so a unit that reaches t holds at least one of
any |B| - ceil(|B| t/(2-t)) + 1 bigrams of B.  The longest ones without a common word, then the
longest others, are the template's anchors.  Texts, and then lines and paragraphs, without an anchor go unread; the others meet the
templates whose size bounds admit them in an equi-join on their size.  Windows come from an
equi-join of the text's word pairs with the anchors.  Both tables have (templates x
sizes) and (templates x words) rows, known before the scan, and are broadcast.  Only built-in
functions; hits, not texts, are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepace.llm.common import ascii_lower, text_of
from zonepace.llm.license_templates import TEMPLATES

THRESHOLD = 0.8
NOT_WORD = r"[^0-9a-z\n\x{80}-\x{10FFFF}]+"
BREAK = r"[^0-9a-z\x{80}-\x{10FFFF}]+"
BLANK_LINE = r"\n ?\n[ \n]*"
BIGRAM = r"(?=(?:^| )([^ ]+ [^ ]+))"
KINDS = ["line", "paragraph", "text", "window"]
MAX_SIZES = 100_000
# Common words, poor anchors.
COMMON = ["a", "all", "an", "and", "any", "are", "as", "at", "be", "by", "for", "from", "has", "have", "if", "in", "is", "it", "no", "not",
          "of", "on", "or", "shall", "so", "such", "that", "the", "this", "to", "under", "was", "which", "will", "with", "you"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(ascii_lower(text), NOT_WORD, " ")


def words_of(text: Column) -> Column:
    """All words of a text, in order, across its lines."""
    return F.array_remove(F.split(ascii_lower(text), BREAK), "")


def bigrams(unit: Column) -> Column:
    """Distinct word bigrams of a normalised, trimmed unit."""
    return F.array_distinct(F.regexp_extract_all(unit, F.lit(BIGRAM), F.lit(1)))


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """Least and largest number of bigrams that can reach the threshold against ``size``; the least is also that of common ones."""
    ratio = threshold / (2 - threshold)
    return math.ceil(size * ratio - 1e-9), math.floor(size / ratio + 1e-9)


def template_rows(spark: SparkSession, templates: list[tuple[str, str, str]]) -> list[tuple[int, list[str], list[str]]]:
    """(number, words, bigrams) of each template that has a bigram."""
    if not templates:
        return []
    rows = [F.struct(F.lit(i).alias("t_no"), F.lit(c).alias("t_text")) for i, (_, _, c) in enumerate(templates)]
    table = spark.range(1).select(F.inline(F.array(*rows))).withColumn("words", words_of(F.col("t_text")))
    return [tuple(r) for r in table.select("t_no", "words", bigrams(F.array_join("words", " "))).collect() if r[2]]


def anchors_of(grams: list[str], threshold: float) -> list[str]:
    """So many bigrams of a template, common words and short ones last, that a unit reaching the threshold holds one of them."""
    order = sorted(grams, key=lambda g: (any(w in COMMON for w in g.split(" ")), -len(g), g))
    return order[:len(grams) - bounds(len(grams), threshold)[0] + 1]


def word_of(anchor: str) -> str:
    """The word that texts are searched for before their word pairs are formed: the longest, common ones last."""
    return max(anchor.split(" "), key=lambda w: (w not in COMMON, len(w)))


def _literal(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _holds_anchor(words: Column, anchors: list[str]) -> Column:
    """True where two neighbouring words are an anchor; pairs are formed only where a word of one occurs."""
    known, members = _literal(anchors), _literal(sorted({word_of(a) for a in anchors}))
    pairs = lambda w: F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))
    # One array as the only element of another: the text is split once, not for each mention.
    return F.exists(F.array(words), lambda w: F.arrays_overlap(w, members) & F.arrays_overlap(pairs(w), known))


def _dice(size: Column) -> Column:
    return F.round(2.0 * F.size(F.array_intersect("grams", "t_grams")) / (size + F.size("t_grams")), 9)


def find_licenses(docs: DataFrame, templates: list[tuple[str, str, str]] | None = None, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kind, place, t_no, dice): the distinct units that reach the threshold against a template.

    ``kind`` is a place in ``KINDS``; ``place`` counts lines and paragraphs from 0, is 0 for
    a text and the place of the template's first word for a window (negative where the
    window is clipped).  ``t_no`` is the place of the template in the list.
    """
    spark = docs.sparkSession
    rows = template_rows(spark, TEMPLATES if templates is None else templates)
    sizes = [bounds(len(grams), threshold) for _, _, grams in rows]
    if sum(most - least + 1 for least, most in sizes) > MAX_SIZES:
        raise ValueError("too many template sizes; split the templates into several scans")
    if not rows:
        return docs.select(docs[id_col].alias("doc_id")).limit(0).selectExpr(
            "doc_id", "0 AS kind", "0 AS place", "0 AS t_no", "cast(0 AS double) AS dice")
    least, most = min(n for n, _ in sizes), max(n for _, n in sizes)
    chosen = {no: anchors_of(grams, threshold) for no, _, grams in rows}
    anchors = sorted({g for gs in chosen.values() for g in gs})
    first_words = sorted({a.split(" ")[0] for a in anchors})
    packed = F.array(*[F.struct(F.lit(no).alias("t_no"), _literal(words).alias("t_words"), _literal(grams).alias("t_grams"),
                                _literal(chosen[no]).alias("t_anchors")) for no, words, grams in rows])
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    table = spark.range(1).select(F.inline(packed))
    by_size = table.select("t_no", "t_grams", F.explode(F.sequence(
        F.ceil(F.size("t_grams") * low - 1e-9).cast("int"), F.floor(F.size("t_grams") * high + 1e-9).cast("int"))).alias("size"))
    by_anchor = (table.select("t_no", "t_grams", "t_anchors", "t_words", F.posexplode("t_words").alias("offset", "t_word"))
                 .withColumn("anchor", F.concat("t_word", F.lit(" "), F.get("t_words", F.col("offset") + 1)))
                 .filter(F.array_contains("t_anchors", F.col("anchor")))
                 .select("anchor", "t_no", "t_grams", "offset", F.size("t_words").alias("length")))

    texts = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    # Outer: an inner explode would add a filter that splits each text a second time.
    pairs = (texts.select("doc_id", words_of(F.col("text")).alias("words"))
             .select("doc_id", "words", F.posexplode_outer("words").alias("at", "word"))
             .filter(F.col("word").isin(first_words))
             .withColumn("anchor", F.concat("word", F.lit(" "), F.get("words", F.col("at") + 1))))
    begin = F.col("at") - F.col("offset")
    windows = (pairs.join(F.broadcast(by_anchor), "anchor")
               .select("doc_id", "t_no", "t_grams", begin.alias("place"),
                       bigrams(F.array_join(F.slice("words", F.greatest(begin, F.lit(0)) + 1,
                                                    F.col("length") + F.least(begin, F.lit(0))), " ")).alias("grams"))
               .select("doc_id", F.lit(3).alias("kind"), "place", "t_no", _dice(F.size("grams")).alias("dice")))

    norm = normalised(F.col("text"))
    layers = texts.filter(_holds_anchor(words_of(F.col("text")), anchors)).select("doc_id", F.posexplode(
        F.array(F.split(norm, "\n"), F.split(norm, BLANK_LINE), F.array(norm))).alias("kind", "layer"))
    units = (layers.select("doc_id", "kind", F.posexplode("layer").alias("place", "unit"))
             .filter((F.col("kind") == 0) | F.contains("unit", F.lit("\n")))
             .withColumn("unit", F.trim(F.regexp_replace(F.translate("unit", "\n", " "), " +", " ")))
             .withColumn("words", F.split("unit", " ")))
    # A unit with d distinct words has at least d - 1 and with w words at most w - 1 distinct bigrams.
    units = (units.filter((F.size("words") - 1 >= least) & _holds_anchor(F.col("words"), anchors))
             .filter(F.size(F.array_distinct("words")) - 1 <= most)
             .select("doc_id", "kind", "place", bigrams(F.col("unit")).alias("grams")))
    whole = (units.withColumn("size", F.size("grams")).join(F.broadcast(by_size), "size")
             .select("doc_id", "kind", "place", "t_no", _dice(F.col("size")).alias("dice")))
    return windows.unionByName(whole).filter(F.col("dice") >= threshold).distinct()


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str, str]] | None = None, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, family, dice, unit, place, licenses, n_hits: one row per row of ``docs``.

    The best hit decides ``license`` (highest Dice, then the longer template, then the earlier one, then line
    before paragraph before text before window, then the earlier place); ``licenses`` lists all ids
    found, sorted; ``n_hits`` counts distinct hits.  Without a hit: nulls, an empty list and 0; null and empty texts have
    none.  Rows that share an id, null included, share their findings.  A very long text is split
    into words whole, in one task.  Other columns are not read, whatever their names.
    """
    known = TEMPLATES if templates is None else templates
    ids, families = (_literal([t[i] for t in known]) for i in (0, 1))
    shorter = F.array(*[F.lit(-len(text)) for _, _, text in known]) if known else F.array().cast("array<int>")
    rank = F.struct((-F.col("dice")).alias("less"), F.get(shorter, F.col("t_no")).alias("shorter"), "t_no", "kind", "place")
    found = find_licenses(docs, templates, threshold, id_col, text_col).groupBy(F.col("doc_id").alias("f_id")).agg(
        F.min(rank).alias("best"), F.collect_set("t_no").alias("t_nos"), F.count(F.lit(1)).alias("hits"))
    found = found.withColumn("names", F.array_join(F.array_sort(F.array_distinct(
        F.transform("t_nos", lambda n: F.get(ids, n)))), ","))
    rows = docs.select(docs[id_col].alias("doc_id"))
    return (rows.join(found, rows.doc_id.eqNullSafe(found.f_id), "left")
            .select("doc_id", F.get(ids, F.col("best.t_no")).alias("license"), F.get(families, F.col("best.t_no")).alias("family"),
                    (-F.col("best.less")).alias("dice"), F.get(_literal(KINDS), F.col("best.kind")).alias("unit"),
                    F.col("best.place").alias("place"), F.coalesce("names", F.lit("")).alias("licenses"),
                    F.coalesce("hits", F.lit(0).cast("long")).alias("n_hits")))
