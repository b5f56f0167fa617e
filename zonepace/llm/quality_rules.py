"""Quality rules: a threshold table compiled into one projection of built-in functions.

A rule bounds the ratio of two counts of a text in per cent: ``(name, count, per, least,
most)`` fails a text when ``100 * count < least * per`` or ``100 * count > most * per``;
a rule without ``per`` bounds the count itself.  Whole numbers on both sides, so a
verdict never hangs on a rounded quotient.  ``compile_rules`` turns the table into one
array expression of the names that fail; nothing is joined, shuffled or handed to Python.

Words are ``[^\\x20\\x09-\\x0D]+``, lines are split at ``\\n`` and count when they hold a word.

Repeated words: every three consecutive words have a 64-bit hash.  Where two are equal
(a set of longs tells), the hashes are sorted with their places, neighbours with equal hashes
mark their places, and the marked places, sorted again, give the number of words they cover:
at most three for each, less where the next one is nearer.  n log n in the words of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepace.llm.common import text_of

# White space between words, the symbols that count, and frequent words of four languages.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the of and to a in is that it for on with as was by at be this from an are or not "
    "der die und das den von zu mit ist im ein eine für auf nicht des dem sich als "
    "de la le les et du un une en que qui dans pour par est au sur pas avec "
    "el los las y del se por con para una su al lo no es").split()

# A text that fails one of these is out whatever the other rules say.
BASE = [
    ("few_words", "n_words", None, 50, None),
    ("repeated_words", "n_repeat_words", "n_words", None, 50),
]
# The tunable table: bounds in per cent of ``per``.
THRESHOLDS = [
    ("word_length", "word_chars", "n_words", 300, 1000),
    ("symbols", "n_symbols", "n_words", None, 10),
    ("exclamations", "n_exclaim", "n_words", None, 10),
    ("stop_words", "n_stop_words", "n_words", 5, None),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 40),
    ("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
    ("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30),
]
BULLETS = "-*•‣·"


def _replaced(text: Column, chars: str, by: str) -> Column:
    """``text`` with each of ``chars`` replaced (byte searches: a text without them is passed on as it is)."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(_replaced(text, chars, ""))).cast("long")


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def _settled(df: DataFrame) -> DataFrame:
    """``df`` behind a one-row generator: no filter is pushed below it, where it would compute the arrays anew in lambdas."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """(id, counts...): the counts that rules may bound, one row per row of ``docs``.

    Each array is a column of its own that the next step reads more than once, so
    Catalyst keeps the steps apart and computes it once, outside the lambdas.
    """
    text, words, lines, grams = F.col("text"), F.col("words"), F.col("lines"), F.col("grams")
    split = (docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
             .withColumn("parts", F.split(_replaced(text, SPACE[1:], " "), " "))
             .select("doc_id", "text", F.array_remove("parts", "").alias("words"), (_size("parts") - 1).alias("spaces"),
                     F.filter(F.split(text, "\n"), lambda x: F.trim(_replaced(x, SPACE[2:], " ")) != "").alias("lines")))
    first = F.greatest(F.size(words) - 2, F.lit(0))
    stops = sorted({f(w) for w in stop_words for f in (str.lower, str.capitalize)})
    bare = lambda x: F.trim(_replaced(x, SPACE[2:], " "))
    counted = split.select(
        "doc_id", _size(words).alias("n_words"), (F.length(text) - F.col("spaces")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).alias("n_symbols"), _count(text, "!").alias("n_exclaim"),
        (_size(F.filter(words, lambda w: w.isin(stops))) if stops else F.lit(0).cast("long")).alias("n_stop_words"),
        _size(lines).alias("n_lines"), (_size(lines) - _size(F.array_distinct(lines))).alias("n_dup_lines"),
        _size(F.filter(lines, lambda x: F.substring(bare(x), 1, 1).isin(list(BULLETS)))).alias("n_bullet_lines"),
        _size(F.filter(lines, lambda x: F.endswith(bare(x), F.lit("...")) | F.endswith(bare(x), F.lit("…")))).alias("n_ellipsis_lines"),
        F.transform(F.slice(words, 1, first), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))).alias("grams"))
    again = F.size(F.array_distinct(grams)) < F.size(grams)
    ranked = counted.withColumn("ranked", F.when(again, F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda k: F.get("ranked", k)["h"]
    marked = ranked.drop("grams").withColumn("places", F.sort_array(F.transform(
        F.filter("ranked", lambda x, k: F.coalesce(near(k - 1) == x["h"], F.lit(False)) | F.coalesce(near(k + 1) == x["h"], F.lit(False))),
        lambda x: x["i"]))).drop("ranked")
    steps = F.zip_with(F.slice("places", 2, F.size("places")), F.col("places"), lambda b, a: F.least(b - a, F.lit(3)))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x, F.lit(3)))
    return _settled(marked.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("places"))


def compile_rules(rules: list[tuple]) -> Column:
    """One array expression: the names of the rules that fail, in the order of the table."""
    parts = []
    for name, count, per, least, most in rules:
        value, unit = (F.col(count) * 100, F.col(per)) if per else (F.col(count), F.lit(1))
        fails = F.lit(False)
        if least is not None:
            fails = fails | (value < unit * least)
        if most is not None:
            fails = fails | (value > unit * most)
        parts.append(F.when(fails, F.lit(name)))
    return F.array_compact(F.array(*parts)) if parts else F.array().cast("array<string>")


def judge_rules(docs: DataFrame, thresholds: list[tuple] = THRESHOLDS, base: list[tuple] = BASE, stop_words: list[str] = STOP_WORDS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, all counts, base_failed, kept, failed: one row per row of ``docs``, in one projection.

    ``failed`` lists the rules that fail, base rules first.  Null and empty texts have
    no words and fail ``few_words``; repeated rows and null ids are judged like any
    other; a very long text costs n log n in its words.  Other columns are not read.
    """
    counts = word_counts(docs, id_col, text_col, stop_words)
    judged = counts.withColumns({"_base": compile_rules(base), "_rules": compile_rules(thresholds)})
    return (judged.withColumns({"base_failed": F.size("_base") > 0, "kept": F.size("_base") + F.size("_rules") == 0,
                                "failed": F.array_join(F.concat("_base", "_rules"), ",")}).drop("_base", "_rules"))


def keep_by_rules(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that no rule rejects."""
    nested = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text_of(docs, text_col).alias("text"))
    kept = judge_rules(nested, id_col="row", **options).filter("kept")
    return kept.select("doc_id.*")
