"""The cleaning chain.

Row rules are expressed once as a ``reject_reason`` column: the name of the
first rule (in chain order) a row fails, or null when it passes them all.
Filtering on ``reject_reason IS NULL`` and counting by reason come from the
same expression, so the audit costs one aggregate over the same scan and
Catalyst still pushes plain range predicates to the Parquet reader.

Only two rules need more than the row: the duplicate rule (a shuffle on
the natural key, partially aggregated map-side) and the per-zone IQR fence
(exact quantiles on the survivors of every earlier rule).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepace import config as C
from zonepace.config import CleanConfig
from zonepace.functions import scalar as S
from zonepace.operators.quantile import exact_quantiles

# Rule names in chain order.
RULES = [
    "nulls", "timestamps", "wrong_month", "distance", "duration", "speed",
    "zones", "trivial_same_zone", "quality",
]


def _fails(pred: Column) -> Column:
    """True when the keep-predicate is false or null (a null drops the row)."""
    return ~F.coalesce(pred, F.lit(False))


# ---- single rules: keep-predicates -----------------------------------------

def keep_not_null() -> Column:
    out = F.lit(True)
    for c in C.CRITICAL_COLUMNS:
        out = out & F.col(c).isNotNull()
    return out


def keep_timestamps() -> Column:
    return F.col("pickup_datetime") < F.col("dropoff_datetime")


def keep_month(ym_col: str = "file_ym") -> Column:
    """Pickup month equals the file month; an unparsable month keeps the row."""
    ym = F.col(ym_col)
    return (S.year_month("pickup_datetime") == ym) | ~S.valid_year_month(ym)


def keep_distance() -> Column:
    return F.col("trip_distance").between(C.MIN_DISTANCE_MILES, C.MAX_DISTANCE_MILES)


def keep_duration() -> Column:
    return F.col("trip_duration").between(C.MIN_DURATION_SECONDS, C.MAX_DURATION_SECONDS)


def keep_speed() -> Column:
    return S.speed_mph().between(C.MIN_SPEED_MPH, C.MAX_SPEED_MPH)


def keep_zones() -> Column:
    return F.col("PULocationID").between(C.MIN_ZONE_ID, C.MAX_ZONE_ID) & F.col("DOLocationID").between(
        C.MIN_ZONE_ID, C.MAX_ZONE_ID
    )


def keep_not_trivial(max_distance: float = C.TRIVIAL_SAME_ZONE_DISTANCE_MILES) -> Column:
    same = F.col("PULocationID") == F.col("DOLocationID")
    near = F.coalesce(F.col("trip_distance") <= F.lit(max_distance), F.lit(False))  # NaN/null compares false
    return ~(same & near)


def keep_quality(has_fare: bool | Column = True, has_passengers: bool | Column = True) -> Column:
    """fare ≥ 0 (null fare fails); passengers > 0 or null; absent column → no test."""
    hf = F.lit(has_fare) if isinstance(has_fare, bool) else has_fare
    hp = F.lit(has_passengers) if isinstance(has_passengers, bool) else has_passengers
    fare_ok = ~hf | F.coalesce(F.col("fare_amount") >= 0, F.lit(False))
    pc = F.col("passenger_count")
    pass_ok = ~hp | pc.isNull() | (pc > 0)
    return fare_ok & pass_ok


def _quality_flags(df: DataFrame, has_fare: bool | None, has_passengers: bool | None):
    hf = F.col("_has_fare") if "_has_fare" in df.columns else F.lit("fare_amount" in df.columns if has_fare is None else has_fare)
    hp = F.col("_has_passengers") if "_has_passengers" in df.columns else F.lit(
        "passenger_count" in df.columns if has_passengers is None else has_passengers)
    return hf, hp


def reject_reason(df: DataFrame, cfg: CleanConfig = CleanConfig(),
                  has_fare: bool | None = None, has_passengers: bool | None = None) -> Column:
    """First failing row rule in chain order, or null (F1)."""
    checks: list[tuple[str, Column]] = [
        ("nulls", _fails(keep_not_null())),
        ("timestamps", _fails(keep_timestamps())),
    ]
    if cfg.check_month and "file_ym" in df.columns:
        checks.append(("wrong_month", _fails(keep_month())))
    checks += [
        ("distance", _fails(keep_distance())),
        ("duration", _fails(keep_duration())),
        ("speed", _fails(keep_speed())),
        ("zones", _fails(keep_zones())),
        ("trivial_same_zone", _fails(keep_not_trivial())),
    ]
    if cfg.use_quality_gate:
        hf, hp = _quality_flags(df, has_fare, has_passengers)
        if "fare_amount" not in df.columns:
            hf = F.lit(False)
        if "passenger_count" not in df.columns:
            hp = F.lit(False)
        fare_col = F.col("fare_amount") if "fare_amount" in df.columns else F.lit(None).cast("double")
        pc = F.col("passenger_count") if "passenger_count" in df.columns else F.lit(None).cast("int")
        fare_ok = ~hf | F.coalesce(fare_col >= 0, F.lit(False))
        pass_ok = ~hp | pc.isNull() | (pc > 0)
        checks.append(("quality", _fails(fare_ok & pass_ok)))
    expr = F.lit(None).cast("string")
    for name, failed in reversed(checks):
        expr = F.when(failed, F.lit(name)).otherwise(expr)
    return expr


# ---- duplicate rule ---------------------------------------------------------

ROW_ORDER = "_row_index"


def remove_duplicates(df: DataFrame, scope: list[str] | None = None, order_col: str = ROW_ORDER,
                      with_copies: bool = False) -> DataFrame:
    """Distinct on the natural key within each file, keeping the file's first row (F2).

    ``order_col`` is the row's place in its file (unique there, fixed at the
    scan); without it "first" has no meaning and the call fails.  The scope is the
    source file where it is known, else the month stamp.  Nearly every key is its own
    only row, so folding before the shuffle shrinks nothing and holds a whole split's rows in
    a hash table, which spills once the splits are full-sized.  The rows are therefore dealt by the key
    first (its doubles left out: grouping rounds -0.0 and NaN, so a deal by them would be
    dealt again) and folded behind that one shuffle, a shuffle partition at a time.  The kept
    row's columns are taken by ``min_by`` the order, all fixed-width: a hash aggregate.
    """
    if order_col not in df.columns:
        raise ValueError(f"remove_duplicates needs the row order column {order_col!r}")
    if scope is None:
        scope = [c for c in ("_src_file",) if c in df.columns] or [c for c in ("file_ym",) if c in df.columns]
    # Text columns describe the file, not the row: they are the same for all copies in a scope.
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string" and f.name not in (*scope, *C.DEDUP_KEY)]
    key = [*scope, *texts, *C.DEDUP_KEY]
    rest = [c for c in df.columns if c not in key and c != order_col]
    dealt = df.repartition(*[c for c in key if dict(df.dtypes)[c] not in ("double", "float")])
    picked = dealt.groupBy(*key).agg(F.min(order_col).alias(order_col), *[F.min_by(c, order_col).alias(c) for c in rest],
                                  *([F.count(F.lit(1)).alias("_copies")] if with_copies else []))
    return picked.select(*df.columns, *(["_copies"] if with_copies else []))


# ---- per-zone IQR fence -----------------------------------------------------

def iqr_fences(df: DataFrame, k: float = C.IQR_FENCE_K,
               min_trips_per_zone: int = C.IQR_MIN_TRIPS_PER_ZONE,
               scope: list[str] | None = None, approx: bool = False) -> DataFrame:
    """(scope…, PULocationID, lower, upper) for zones with ≥ min trips of non-null speed."""
    if scope is None:
        scope = ["file_ym"] if "file_ym" in df.columns else []
    group = [*scope, "PULocationID"]
    speeds = df.select(*group, S.speed_mph().alias("_speed"))
    q = exact_quantiles(speeds, group, "_speed", [0.25, 0.75], ["q1", "q3"], approx=approx, with_count=True)
    q = q.where(F.col("n") >= min_trips_per_zone)  # J4: eligible zones only
    iqr = F.col("q3") - F.col("q1")
    return q.select(*group, (F.col("q1") - F.lit(k) * iqr).alias("lower"),
                    (F.col("q3") + F.lit(k) * iqr).alias("upper"))


def remove_iqr_speed_outliers_by_zone(df: DataFrame, k: float = C.IQR_FENCE_K,
                                      min_trips_per_zone: int = C.IQR_MIN_TRIPS_PER_ZONE,
                                      scope: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Drop trips outside their zone's [Q1−k·IQR, Q3+k·IQR].

    Zones below ``min_trips_per_zone`` pass; null speed passes.  The fence
    table has one row per (month, zone) — at most 263 per month file — so
    it is broadcast (J2).
    """
    if scope is None:
        scope = ["file_ym"] if "file_ym" in df.columns else []
    fences = iqr_fences(df, k, min_trips_per_zone, scope, approx)
    group = [*scope, "PULocationID"]
    joined = df.join(F.broadcast(fences), on=group, how="left")
    sp = S.speed_mph()
    keep = sp.isNull() | (
        (sp >= F.coalesce(F.col("lower"), F.lit(float("-inf"))))
        & (sp <= F.coalesce(F.col("upper"), F.lit(float("inf"))))
    )
    return joined.where(keep).select(*df.columns)


# ---- the chain --------------------------------------------------------------

def key_rules(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> Column:
    """Conjunction of every row rule that reads only the duplicate key (or values
    derived from it: duration, speed) — all copies of a key pass or fail together."""
    keep = keep_not_null() & keep_timestamps()
    if cfg.check_month and "file_ym" in df.columns:
        keep = keep & keep_month()
    keep = keep & keep_distance() & keep_duration() & keep_speed() & keep_zones() & keep_not_trivial()
    # A plain conjunction: in a WHERE a null drops the row just like false, and
    # Catalyst can hand each simple range conjunct to the Parquet reader.
    return keep


def clean_trips(df: DataFrame, cfg: CleanConfig = CleanConfig(),
                has_fare: bool | None = None, has_passengers: bool | None = None,
                order_col: str = ROW_ORDER) -> DataFrame:
    """Whole chain: dedup → row rules → optional IQR fence.

    Rules on key columns run before the duplicate shuffle (same result: a key's
    copies share the outcome), so rejected rows never cross the network; the
    quality rule, which reads non-key columns, runs on the kept copy after it.
    """
    pre = df.where(key_rules(df, cfg))
    d = remove_duplicates(pre, order_col=order_col)
    out = d.where(reject_reason(d, cfg, has_fare, has_passengers).isNull())
    if cfg.use_iqr_filter:
        out = remove_iqr_speed_outliers_by_zone(out, cfg.iqr_k, cfg.iqr_min_trips)
    return out


def clean_audit(df: DataFrame, cfg: CleanConfig = CleanConfig(),
                has_fare: bool | None = None, has_passengers: bool | None = None,
                order_col: str = ROW_ORDER) -> DataFrame:
    """Rows removed per rule, plus input, duplicates and kept counts.

    One scan: the duplicate rule keeps a copy count per surviving row, the
    reject reason is computed on the survivors, and a single aggregate by
    reason yields every figure (input = Σ copies, duplicates = Σ copies − rows).
    Output (step_order, step, rows) in chain order.
    """
    spark = df.sparkSession
    d = remove_duplicates(df, order_col=order_col, with_copies=True)
    by = d.select(reject_reason(d, cfg, has_fare, has_passengers).alias("step"), "_copies").groupBy("step").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_copies").alias("copies"))
    tot = by.agg(F.sum("copies").alias("input"), (F.sum("copies") - F.sum("rows")).alias("duplicates"))
    head = tot.selectExpr("stack(2, 'input', input, 'duplicates', duplicates) as (step, rows)")
    named = by.select(F.coalesce(F.col("step"), F.lit("kept")).alias("step"), "rows")
    steps = ["input", "duplicates", *RULES, "kept"]
    order = spark.createDataFrame([(s, i) for i, s in enumerate(steps)], "step string, step_order int")
    return (
        F.broadcast(order).join(head.unionByName(named), on="step", how="left")
        .select("step_order", "step", F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("rows"))
    )
