"""Raw trip sources: monthly Parquet files with drifting column names.

Monthly files disagree on column names (``tpep_``/``lpep_`` prefixes) and
on physical types (passenger_count as bigint in one month, double in the
next).  A single multi-path read cannot merge such schemas, so files are
grouped by footer schema, each group is read once with a projection that
renames and casts to the canonical schema, and the groups are unioned by
name.  Thousands of files with a handful of distinct schemas become a
handful of scans.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from zonepace import config as C
from zonepace.functions import scalar as S

# Canonical types after standardisation.
CANONICAL_TYPES = {
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "trip_distance": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
    "fare_amount": "double",
    "passenger_count": "smallint",
}

_YM_RE = re.compile(r"(\d{4}-\d{2})")


class MissingColumnError(ValueError):
    """A required canonical column has no alias in the source."""


def resolve_column(columns: Iterable[str], aliases: list[str]) -> str | None:
    """First alias present in ``columns`` (exact, case-sensitive), else None (S3)."""
    cols = list(columns)
    for a in aliases:
        if a in cols:
            return a
    return None


def standardize_columns(df: DataFrame, keep_quality: bool = C.KEEP_QUALITY_COLUMNS,
                        fill_optional: bool = True) -> DataFrame:
    """Rename aliases to canonical names and keep only canonical columns.

    Missing required column → :class:`MissingColumnError`.  A missing
    optional column is added as a typed null when ``fill_optional`` so that
    unions across vintages share one schema; the quality rule is told about
    absence separately (see :func:`source_has_quality_columns`).
    """
    exprs = []
    for canonical, aliases in C.COLUMN_ALIASES.items():
        found = resolve_column(df.columns, aliases)
        if canonical in C.OPTIONAL_COLUMNS:
            if not keep_quality:
                continue
            if found is None:
                if fill_optional:
                    exprs.append(F.lit(None).cast(CANONICAL_TYPES[canonical]).alias(canonical))
                continue
        elif found is None:
            raise MissingColumnError(
                f"Cannot find a column for '{canonical}'. Tried aliases: {aliases}. "
                f"Available columns: {list(df.columns)}"
            )
        exprs.append(F.col(f"`{found}`").alias(canonical))
    passthrough = [F.col(c) for c in df.columns if c == "file_ym" or c.startswith("_")]
    return df.select(*exprs, *passthrough)


def source_has_quality_columns(df: DataFrame) -> dict[str, bool]:
    """Which optional columns exist in the raw source (decided from schema, not nulls)."""
    return {c: resolve_column(df.columns, C.COLUMN_ALIASES[c]) is not None for c in C.OPTIONAL_COLUMNS}


def cast_dtypes(df: DataFrame) -> DataFrame:
    """Coerce canonical columns; unparsable values, NaN and fractional ids → null."""
    out = []
    for c in df.columns:
        t = CANONICAL_TYPES.get(c)
        if t is None:
            out.append(F.col(c))
        elif t == "timestamp_ntz":
            out.append(S.to_timestamp_ntz(c).alias(c))
        elif t == "double":
            out.append(S.to_double(c).alias(c))
        else:
            out.append(S.to_whole(c, t).alias(c))
    return df.select(*out)


def add_trip_duration(df: DataFrame) -> DataFrame:
    """trip_duration = dropoff − pickup in fractional seconds."""
    return df.withColumn("trip_duration", S.duration_seconds())


def parse_year_month_expr(name: str | F.Column) -> F.Column:
    """``YYYY-MM`` found in a file name, or '' when absent."""
    return F.regexp_extract(S.col(name), r"(\d{4}-\d{2})", 1)


def parse_year_month(name: str) -> str:
    """Driver-side twin of :func:`parse_year_month_expr` for a single name."""
    m = _YM_RE.search(str(name))
    if not m:
        raise ValueError(f"Could not parse YYYY-MM from filename: {name}")
    return m.group(1)


def with_file_month(df: DataFrame, file_col: str = "_src_file", path_col: str | None = "_src_path",
                    need_modal: bool = True) -> DataFrame:
    """Stamp each row with its file's month.

    Order: a Hive-style partition value (``…/file_ym=2025-01/part-….parquet``)
    → a stamp in the file name (Spark's ``part-…`` names never count: their
    UUIDs can look like ``0000-70``) → a stamp in the parent folder name → the
    file's modal pickup month, ties going to the earliest month.
    """
    name = F.when(F.col(file_col).startswith("part-"), F.lit("")).otherwise(parse_year_month_expr(file_col))
    stamped = name
    if path_col and path_col in df.columns:
        part = F.regexp_extract(F.col(path_col), r"=(\d{4}-\d{2})/[^/]*$", 1)
        parent = F.regexp_extract(F.col(path_col), r"(\d{4}-\d{2})[^/]*/[^/]*$", 1)
        stamped = F.when(part != "", part).when(name != "", name).otherwise(parent)
    if not need_modal:  # every file carries a stamp: no extra pass
        return df.withColumn("file_ym", stamped)
    df = df.withColumn("_ym_name", stamped)
    modal = modal_month(df.filter(F.col("_ym_name") == ""), file_col)
    return (
        df.join(F.broadcast(modal), on=file_col, how="left")  # one row per file
        .withColumn("file_ym", F.when(F.col("_ym_name") != "", F.col("_ym_name")).otherwise(F.col("_modal_ym")))
        .drop("_ym_name", "_modal_ym")
    )


def _path_stamp(path: str) -> str:
    """Driver-side twin of the stamp order in :func:`with_file_month` (without the modal step)."""
    m = re.search(r"=(\d{4}-\d{2})/[^/]*$", path)
    if m:
        return m.group(1)
    parts = path.rsplit("/", 2)
    base = parts[-1]
    if not base.startswith("part-"):
        m = _YM_RE.search(base)
        if m:
            return m.group(1)
    if len(parts) >= 2:
        m = _YM_RE.search(parts[-2])
        if m:
            return m.group(1)
    return ""


def modal_month(df: DataFrame, group_col: str) -> DataFrame:
    """Most frequent pickup month per group; ties → earliest month.

    A partial count per (group, month) first, then a tiny max_by: no
    group's rows ever meet in one task.
    """
    counts = (
        df.where(F.col("pickup_datetime").isNotNull())
        .groupBy(group_col, S.year_month().alias("_ym"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.groupBy(group_col).agg(
        F.min_by(F.col("_ym"), F.struct(-F.col("_n"), F.col("_ym"))).alias("_modal_ym")
    )


def _list_parquet_files(spark: SparkSession, raw_dir: str) -> list[str]:
    """Sorted list of ``*.parquet`` files at any depth under ``raw_dir``: listed by Spark's own file source, contents unread."""
    try:
        listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                  .load(raw_dir).select("path"))
        return sorted(r["path"] for r in listed.collect())  # one row a file
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def scan_raw_trips(spark: SparkSession, raw_dir: str | list[str],
                   keep_quality: bool = C.KEEP_QUALITY_COLUMNS) -> DataFrame:
    """Read every raw monthly Parquet file under ``raw_dir`` into one table.

    Output columns: canonical trip columns (optional ones as typed nulls
    when a vintage lacks them), ``_has_fare`` / ``_has_passengers`` flags per
    file, ``_src_file``, ``_src_path``, ``_row_index`` (file order, for the
    keep-first duplicate rule) and ``file_ym``.
    """
    files = raw_dir if isinstance(raw_dir, list) else _list_parquet_files(spark, raw_dir)
    if not files:
        raise FileNotFoundError(f"No .parquet files found in {raw_dir}.")
    by_schema: dict[str, list[str]] = {}
    # Footer reads only (no data); issued concurrently so thousands of files
    # do not serialise on the driver.
    with ThreadPoolExecutor(max_workers=min(32, len(files))) as pool:
        keys = list(pool.map(lambda f: spark.read.parquet(f).schema.json(), files))
    for f, key in zip(files, keys):
        by_schema.setdefault(key, []).append(f)
    parts = []
    for key, paths in by_schema.items():
        raw = spark.read.parquet(*paths)
        present = source_has_quality_columns(raw)
        raw = raw.select(
            "*",
            F.col("_metadata.file_name").alias("_src_file"),
            F.col("_metadata.file_path").alias("_src_path"),
            F.col("_metadata.row_index").alias("_row_index"),
        )
        std = standardize_columns(raw, keep_quality=keep_quality).select(
            "*",
            F.lit(present["fare_amount"]).alias("_has_fare"),
            F.lit(present["passenger_count"]).alias("_has_passengers"),
        )
        parts.append(std)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = add_trip_duration(cast_dtypes(out))
    unstamped = [f for f in files if not _path_stamp(f)]
    return with_file_month(out, need_modal=bool(unstamped))
