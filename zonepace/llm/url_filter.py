"""URL rules by hashed host-suffix / path-prefix expressions.

A rule is (host, path, verdict).  It fits a URL when the URL's host is the
rule's host or a subdomain of it and the URL's path starts with the rule's
path.  Method:

1. Each URL is expanded into ``host suffix + path prefix`` expressions.  Host
   suffixes start at a label, path prefixes end at a slash; neither goes
   deeper than the deepest rule (a bound read from the rules, so nothing that
   could match is left out).
2. Each expression is hashed (SHA-256) and equi-joined to the rules on the
   first 8 hex digits.
3. A match counts only if the full digests agree and the path starts with the
   rule's whole path (a rule path that does not end in a slash is looked up
   by its parent prefix and confirmed here).
4. The longest rule wins: total length, then longer host; of two equal rules
   with different verdicts, ``block``.

Only built-in functions; the exploded rows of a URL stay in one task until
a map-side partial maximum folds them, so one shuffle of (id, host, path)
remains whatever the number of expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonepace.llm.common import ascii_lower, at_most

PREFIX_HEX = 8
BROADCAST_RULES = 200_000


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) literals as a DataFrame."""
    if not rules:
        return spark.sql("SELECT '' AS host, '' AS path, '' AS verdict WHERE false")
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _ranked(rules: DataFrame) -> DataFrame:
    """One row per (host, path): key expression, digest, precedence rank (larger wins), depths."""
    host = ascii_lower(F.trim(F.coalesce("host", F.lit(""))))
    raw = F.coalesce("path", F.lit(""))
    path = F.when(raw.startswith("/"), raw).otherwise(F.concat(F.lit("/"), raw))
    one = (rules.select(host.alias("r_host"), path.alias("r_path"), F.col("verdict").alias("r_verdict"))
           .filter("r_host <> '' AND r_verdict IS NOT NULL")
           .groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict")))
    key = F.concat("r_host", F.regexp_extract("r_path", r"(?s)^(.*/)[^/]*$", 1))
    order = Window.orderBy(F.length("r_host") + F.length("r_path"), F.length("r_host"), "r_host", "r_path")
    return (one.withColumn("r_digest", F.sha2(key, 256))
            .withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_HEX))
            .withColumn("r_rank", F.row_number().over(order).cast("long")))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", keep: tuple[str, ...] = ("page_id",),
               default: str = "allow") -> DataFrame:
    """Columns ``keep`` plus host, path, rule, verdict: one row per row of ``pages``.

    Null URLs and URLs without ``://`` have empty host and path, no rule and
    the default verdict; repeated rows stay repeated; other columns of
    ``pages`` are not read.  No rules at all: everything gets the default.
    """
    ranked = _ranked(rules).cache()
    depth = ranked.agg(F.coalesce(F.max(F.size(F.split("r_host", r"\."))), F.lit(1)).alias("labels"),
                       F.coalesce(F.max(F.size(F.split("r_path", "/")) - 1), F.lit(1)).alias("slashes")).first()
    small = at_most(ranked, BROADCAST_RULES)

    url = F.col(url_col).cast("string")
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(cast(`{url_col}` as string), instr(cast(`{url_col}` as string), '://') + 3)"))
    parts = pages.select(*[F.col(k) for k in keep],
                         ascii_lower(F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))).alias("host"),
                         F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"),
                         F.monotonically_increasing_id().alias("u_row"))
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - depth["labels"] + 1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    depths = F.least(F.size(segments) - 1, F.lit(depth["slashes"]))
    prefixes = F.when(depths > 0, F.transform(F.sequence(F.lit(1), F.greatest(depths, F.lit(1))),
                                              lambda j: F.concat(F.array_join(F.slice(segments, 1, j), "/"), F.lit("/"))))
    expressions = F.flatten(F.transform(F.filter(suffixes, lambda h: h != ""),
                                        lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    looked = parts.withColumn("u_digest", F.explode_outer(F.transform(expressions, lambda e: F.sha2(e, 256))))
    keyed = ranked.select("r_prefix", "r_digest", "r_path", "r_rank")
    joined = looked.join(F.broadcast(keyed) if small else keyed,
                         F.substring("u_digest", 1, PREFIX_HEX) == F.col("r_prefix"), "left")
    sure = (F.col("u_digest") == F.col("r_digest")) & F.expr("startswith(path, r_path)")
    best = (joined.groupBy("u_row", *keep, "host", "path").agg(F.max(F.when(sure, F.col("r_rank"))).alias("u_rank")))
    named = ranked.select(F.col("r_rank").alias("u_rank"), F.concat("r_host", "r_path").alias("rule"), "r_verdict")
    return (best.join(F.broadcast(named) if small else named, "u_rank", "left")
            .select(*keep, "host", "path", "rule", F.coalesce("r_verdict", F.lit(default)).alias("verdict")))
