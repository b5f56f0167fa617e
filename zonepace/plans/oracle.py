"""Independent DuckDB SQL for every SQL-checkable query key.

Only the base tables are registered as views on the DuckDB side, so each
statement repeats the trip adapter and the chain as CTEs.  Hygiene rules:
every column aliased, integers as BIGINT, doubles rounded to 6 places
(the Spark side rounds the same way in :mod:`zonepace.plans.catalog`),
decimal literals cast to DOUBLE, tie-breaks spelled out.
"""

from __future__ import annotations

from zonepace import config as C

D = "cast({} as double)"


def _in(values) -> str:
    return "(" + ", ".join(str(v) for v in values) + ")"


TRIPS_RAW = """
trips_raw as (
  select l_shipdate + to_minutes(cast(l_orderkey % 1500 as int)) as pickup_datetime,
         l_shipdate + to_minutes(cast(l_orderkey % 1500 as int)) + to_seconds(
           (cast(l_quantity - 3 as int) * 90 - case when l_linenumber = 7 then 70 else 0 end)
             * case when l_linenumber = 6 and l_quantity > 45 then 5 else 1 end) as dropoff_datetime,
         case when l_discount = 0.10 and l_tax = 0.08 then null
              else l_extendedprice / cast(5000 as double) - cast(0.18 as double) end as trip_distance,
         cast(l_partkey % 266 as int) as PULocationID,
         cast((l_partkey + (l_linenumber - 1) * 37) % 266 as int) as DOLocationID,
         l_extendedprice * (l_discount - cast(0.01 as double)) - copy * cast(3 as double) as fare_amount,
         case when l_tax = 0.05 then null else l_linenumber - 1 + copy end as passenger_count,
         l_orderkey * 100 + l_linenumber * 10
           + case when copy = 0 then 5 when l_orderkey % 2 = 0 then 1 else 9 end as row_index,
         strftime(l_shipdate, '%Y-%m') as file_ym
  from (select *, 0 as copy from lineitem union all select *, 1 as copy from lineitem where l_orderkey % 97 = 0) t
)"""

TRIPS_STD = """
trips as (
  select pickup_datetime, dropoff_datetime, trip_distance, PULocationID, DOLocationID,
         fare_amount, cast(passenger_count as smallint) as passenger_count, file_ym, row_index,
         date_diff('microsecond', pickup_datetime, dropoff_datetime) / cast(1000000 as double) as trip_duration
  from trips_raw
)"""

SPEED = "(trip_distance / nullif(trip_duration / cast(3600 as double), 0))"

DEDUP = """
dedup as (
  select * from trips
  qualify row_number() over (partition by file_ym, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_distance
                             order by row_index) = 1
)"""


def reason_sql(quality: bool = True, month: bool = True) -> str:
    """First failing rule, chain order; a null predicate counts as failing."""
    parts = [
        "when pickup_datetime is null or dropoff_datetime is null or trip_distance is null "
        "or trip_duration is null or PULocationID is null or DOLocationID is null then 'nulls'",
        "when not coalesce(pickup_datetime < dropoff_datetime, false) then 'timestamps'",
    ]
    if month:
        parts.append("when not coalesce(strftime(pickup_datetime, '%Y-%m') = file_ym, false) then 'wrong_month'")
    parts += [
        f"when not coalesce(trip_distance between {C.MIN_DISTANCE_MILES!r}::double and {C.MAX_DISTANCE_MILES!r}::double, false) then 'distance'",
        f"when not coalesce(trip_duration between {C.MIN_DURATION_SECONDS} and {C.MAX_DURATION_SECONDS}, false) then 'duration'",
        f"when not coalesce({SPEED} between {C.MIN_SPEED_MPH!r}::double and {C.MAX_SPEED_MPH!r}::double, false) then 'speed'",
        f"when not coalesce(PULocationID between {C.MIN_ZONE_ID} and {C.MAX_ZONE_ID} and DOLocationID between {C.MIN_ZONE_ID} and {C.MAX_ZONE_ID}, false) then 'zones'",
        f"when coalesce(PULocationID = DOLocationID and trip_distance <= {C.TRIVIAL_SAME_ZONE_DISTANCE_MILES!r}::double, false) then 'trivial_same_zone'",
    ]
    if quality:
        parts.append("when not (coalesce(fare_amount >= 0, false) and (passenger_count is null or passenger_count > 0)) then 'quality'")
    return "case " + " ".join(parts) + " else null end"


REASONED = f"""
reasoned as (
  select *, {reason_sql()} as reject_reason from dedup
)"""

CLEAN = """
clean as (
  select * exclude (reject_reason) from reasoned where reject_reason is null
)"""

FEAT = f"""
feat as (
  select *, hour(pickup_datetime) as hour_of_day, isodow(pickup_datetime) - 1 as day_of_week,
         isodow(pickup_datetime) - 1 >= 5 as is_weekend, month(pickup_datetime) as month,
         {SPEED} as speed_mph, PULocationID as zone_id
  from clean where {SPEED} is not null
)"""

def mean_sql(x: str, over: str = "") -> str:
    """The order-free mean: whole units of 2^-30 added as integers."""
    units = f"sum(cast(floor({x} * 1073741824.0::double + 0.5::double) as bigint)){over}"
    return f"(cast({units} as double) / count({x}){over} / 1073741824.0::double)"


CELLS0 = f"""
cells0 as (
  select zone_id, hour_of_day, day_of_week, is_weekend,
         {mean_sql('speed_mph')} as avg_speed_mph, count(speed_mph) as trip_density,
         {mean_sql('trip_duration')} as avg_trip_duration
  from feat group by zone_id, hour_of_day, day_of_week, is_weekend
)"""

CELLS = f"""
cells as (
  select *, avg_speed_mph - {mean_sql('avg_speed_mph', ' over (partition by zone_id, hour_of_day)')} as speed_deviation,
         sin(2 * pi() * hour_of_day / cast(24 as double)) as hour_sin,
         cos(2 * pi() * hour_of_day / cast(24 as double)) as hour_cos,
         ln(1 + cast(trip_density as double)) as log_trip_density,
         zone_id in {_in(C.AIRPORT_ZONES)} as is_airport,
         zone_id in {_in(C.CBD_ZONES)} as is_cbd,
         hour_of_day in {_in(C.RUSH_HOUR_MORNING + C.RUSH_HOUR_EVENING)} as is_rush_hour
  from cells0
)"""

CHAIN = [TRIPS_RAW, TRIPS_STD, DEDUP, REASONED, CLEAN, FEAT, CELLS0, CELLS]


def with_ctes(*ctes: str) -> str:
    return "with " + ",".join(ctes)


def chain_upto(name: str) -> str:
    names = ["trips_raw", "trips", "dedup", "reasoned", "clean", "feat", "cells0", "cells"]
    return with_ctes(*CHAIN[: names.index(name) + 1])


def r6(expr: str) -> str:
    """Same rounding steps as the Spark side (catalog.round6)."""
    x = f"cast({expr} as double)"
    return (f"(case when isnan({x}) or abs({x}) >= cast(1e12 as double) then {x} "
            f"else cast(floor({x} * cast(1000000 as double) + cast(0.5 as double)) as double) / cast(1000000 as double) end)")


ORACLE: dict[str, str] = {}


def ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}"


STEP_VALUES = ", ".join(
    f"('{s}', {i})" for i, s in enumerate(
        ["input", "duplicates", "nulls", "timestamps", "wrong_month", "distance", "duration",
         "speed", "zones", "trivial_same_zone", "quality", "kept"])
)

ORACLE["clean_audit"] = chain_upto("reasoned") + f""",
steps as (select * from (values {STEP_VALUES}) s(step, step_order)),
counts as (
  select 'input' as step, count(*) as n from trips
  union all select 'duplicates', (select count(*) from trips) - (select count(*) from dedup)
  union all select coalesce(reject_reason, 'kept'), count(*) from reasoned group by 1
)
select cast(s.step_order as bigint) as step_order, s.step as step, cast(coalesce(c.n, 0) as bigint) as rows
from steps s left join counts c on s.step = c.step
"""

CLEAN_COLS = (
    f"{ts('pickup_datetime')}, {ts('dropoff_datetime')}, {r6('trip_distance')} as trip_distance, "
    "cast(PULocationID as bigint) as PULocationID, cast(DOLocationID as bigint) as DOLocationID, "
    f"{r6('fare_amount')} as fare_amount, cast(passenger_count as bigint) as passenger_count, file_ym, "
    f"{r6('trip_duration')} as trip_duration"
)

ORACLE["clean_trips"] = chain_upto("clean") + f"\nselect {CLEAN_COLS} from clean"

CELL_KEY_SQL = ("cast(zone_id as bigint) as zone_id, cast(hour_of_day as bigint) as hour_of_day, "
                "cast(day_of_week as bigint) as day_of_week, is_weekend")

ORACLE["zone_hour_cells"] = chain_upto("cells0") + f"""
select {CELL_KEY_SQL}, {r6('avg_speed_mph')} as avg_speed_mph, cast(trip_density as bigint) as trip_density,
       {r6('avg_trip_duration')} as avg_trip_duration
from cells0"""

ORACLE["speed_deviation"] = chain_upto("cells") + f"""
select {CELL_KEY_SQL}, {r6('avg_speed_mph')} as avg_speed_mph, cast(trip_density as bigint) as trip_density,
       {r6('speed_deviation')} as speed_deviation
from cells"""

CELL_ALL = (CELL_KEY_SQL + ", " + ", ".join(
    f"{r6(c)} as {c}" for c in ["avg_speed_mph", "avg_trip_duration", "speed_deviation", "hour_sin", "hour_cos", "log_trip_density"])
    + ", cast(trip_density as bigint) as trip_density, is_airport, is_cbd, is_rush_hour")

ORACLE["cells_full"] = chain_upto("cells") + f"\nselect {CELL_ALL} from cells"

ORACLE["slowest_cells"] = chain_upto("cells") + f"""
select {CELL_KEY_SQL}, {r6('avg_speed_mph')} as avg_speed_mph, cast(trip_density as bigint) as trip_density,
       {r6('speed_deviation')} as speed_deviation
from cells order by speed_deviation asc, zone_id, hour_of_day, day_of_week, is_weekend limit 15"""


# ---- step 2 -----------------------------------------------------------------

ORACLE["scan_trips"] = chain_upto("trips") + f"""
select {CLEAN_COLS.replace(r6('fare_amount'), r6("case when cast(substr(file_ym, 6, 2) as int) % 3 = 2 then null else fare_amount end"))},
       cast(substr(file_ym, 6, 2) as int) % 3 <> 2 as has_fare from trips"""

ORACLE["standardize_columns"] = chain_upto("trips_raw") + f"""
select {ts('pickup_datetime')}, {ts('dropoff_datetime')}, {r6('trip_distance')} as trip_distance,
       cast(PULocationID as bigint) as PULocationID, cast(DOLocationID as bigint) as DOLocationID,
       {r6('fare_amount')} as fare_amount, cast(null as bigint) as passenger_count, file_ym
from trips_raw"""

ORACLE["cast_dtypes"] = chain_upto("trips_raw") + f"""
select {ts('pickup_datetime')}, {ts('dropoff_datetime')}, {r6('trip_distance')} as trip_distance,
       cast(case when passenger_count = 3 then null else PULocationID end as bigint) as PULocationID,
       cast(DOLocationID as bigint) as DOLocationID,
       {r6('case when passenger_count = 4 then null else fare_amount end')} as fare_amount,
       cast(passenger_count as bigint) as passenger_count, file_ym
from trips_raw"""

ORACLE["trip_duration"] = chain_upto("trips") + f"""
select {ts('pickup_datetime')}, {ts('dropoff_datetime')}, {r6('trip_duration')} as trip_duration from trips"""

ORACLE["parse_year_month"] = chain_upto("trips_raw") + r"""
select file_name, cast(count(*) as bigint) as trips, regexp_extract(file_name, '(\d{4}-\d{2})', 1) as year_month
from (select case when cast(substr(file_ym, 6, 2) as int) % 2 = 0 then 'yellow_tripdata_' || file_ym || '.parquet'
                  else 'trips_part_' || substr(file_ym, 6, 2) || '.parquet' end as file_name
      from trips_raw) t
group by file_name"""

ORACLE["modal_month"] = chain_upto("trips") + """
select file_ym, ym as modal_ym from (
  select file_ym, ym, row_number() over (partition by file_ym order by n desc, ym asc) as rn
  from (select file_ym, strftime(pickup_datetime, '%Y-%m') as ym, count(*) as n
        from trips where pickup_datetime is not null group by 1, 2) a
) b where rn = 1"""

RULE_SQL = {
    "remove_nulls": "pickup_datetime is not null and dropoff_datetime is not null and trip_distance is not null "
                    "and trip_duration is not null and PULocationID is not null and DOLocationID is not null",
    "remove_invalid_timestamps": "pickup_datetime < dropoff_datetime",
    "remove_wrong_month": "strftime(pickup_datetime, '%Y-%m') = file_ym",
    "remove_invalid_distance": f"trip_distance between {C.MIN_DISTANCE_MILES!r}::double and {C.MAX_DISTANCE_MILES!r}::double",
    "remove_invalid_duration": f"trip_duration between {C.MIN_DURATION_SECONDS} and {C.MAX_DURATION_SECONDS}",
    "remove_speed_outliers": f"{SPEED} between {C.MIN_SPEED_MPH!r}::double and {C.MAX_SPEED_MPH!r}::double",
    "remove_invalid_zones": f"PULocationID between {C.MIN_ZONE_ID} and {C.MAX_ZONE_ID} and DOLocationID between {C.MIN_ZONE_ID} and {C.MAX_ZONE_ID}",
    "remove_trivial_same_zone": f"not (PULocationID = DOLocationID and coalesce(trip_distance <= {C.TRIVIAL_SAME_ZONE_DISTANCE_MILES!r}::double, false))",
    "remove_invalid_quality": "coalesce(fare_amount >= 0, false) and (passenger_count is null or passenger_count > 0)",
}
for _k, _w in RULE_SQL.items():
    ORACLE[_k] = chain_upto("trips") + f"\nselect {CLEAN_COLS} from trips where {_w}"

ORACLE["remove_duplicates"] = chain_upto("dedup") + f"\nselect {CLEAN_COLS} from dedup"


def _rank_q(p: float) -> str:
    """Linear interpolation between the two ranks of a sorted list ``l`` of ``n`` values, spelled out."""
    h = f"((n - 1) * {p}::double)"
    low = f"l[cast(floor({h}) as bigint) + 1]"
    return f"{low} + (l[least(cast(floor({h}) as bigint) + 2, n)] - {low}) * ({h} - floor({h}))"


def fences_sql(k: float, min_n: int, scope: str = "") -> str:
    """Fences per zone, with ``scope`` ("file_ym, ") per month and zone."""
    return f"""
fences as (
  select {scope}PULocationID, q1, q3, n, q1 - cast({k!r} as double) * (q3 - q1) as lower,
         q3 + cast({k!r} as double) * (q3 - q1) as upper
  from (select *, {_rank_q(0.25)} as q1, {_rank_q(0.75)} as q3
        from (select {scope}PULocationID, list(s order by s) as l, count(*) as n
              from (select {scope}PULocationID, {SPEED} as s from clean) x where s is not null and not isnan(s)
              group by {scope}PULocationID) r) q
  where n >= {min_n}
)"""


ORACLE["iqr_fence"] = chain_upto("clean") + "," + fences_sql(3.0, 100) + f"""
select cast(PULocationID as bigint) as PULocationID, {r6('lower')} as lower, {r6('upper')} as upper from fences"""

ORACLE["clean_trips_iqr"] = chain_upto("clean") + "," + fences_sql(1.5, 100) + f"""
select {CLEAN_COLS} from (
  select c.*, f.lower, f.upper from clean c left join fences f on c.PULocationID = f.PULocationID
) j
where {SPEED} is null or ({SPEED} >= coalesce(lower, cast('-inf' as double)) and {SPEED} <= coalesce(upper, cast('inf' as double)))"""

ORACLE["iqr_fence_monthly"] = chain_upto("clean") + "," + fences_sql(C.IQR_FENCE_K, 3, "file_ym, ") + f"""
select file_ym, cast(PULocationID as bigint) as PULocationID, {r6('lower')} as lower, {r6('upper')} as upper from fences"""

ORACLE["clean_trips_iqr_monthly"] = chain_upto("clean") + "," + fences_sql(1.5, 3, "file_ym, ") + f"""
select {CLEAN_COLS} from (
  select c.*, f.lower, f.upper from clean c left join fences f on c.PULocationID = f.PULocationID and c.file_ym = f.file_ym
) j
where {SPEED} is null or ({SPEED} >= coalesce(lower, cast('-inf' as double)) and {SPEED} <= coalesce(upper, cast('inf' as double)))"""

ORACLE["clean_retention"] = chain_upto("clean") + f"""
select i.file_ym, cast(i.n as bigint) as rows_in, cast(coalesce(k.n, 0) as bigint) as rows_kept,
       {r6('100.0::double * coalesce(k.n, 0) / i.n')} as retention_pct
from (select file_ym, count(*) as n from trips group by 1) i
left join (select file_ym, count(*) as n from clean group by 1) k on i.file_ym = k.file_ym"""

ORACLE["time_features"] = chain_upto("clean") + f"""
select {ts('pickup_datetime')}, cast(PULocationID as bigint) as PULocationID,
       cast(hour(pickup_datetime) as bigint) as hour_of_day, cast(isodow(pickup_datetime) - 1 as bigint) as day_of_week,
       isodow(pickup_datetime) - 1 >= 5 as is_weekend, cast(month(pickup_datetime) as bigint) as month
from clean"""

ORACLE["speed_feature"] = chain_upto("trips") + f"""
select {ts('pickup_datetime')}, {ts('dropoff_datetime')}, {r6('trip_distance')} as trip_distance,
       {r6('trip_duration')} as trip_duration, {r6(SPEED)} as speed_mph
from trips"""

ORACLE["engineer_features"] = chain_upto("feat") + f"""
select {CLEAN_COLS}, cast(hour_of_day as bigint) as hour_of_day, cast(day_of_week as bigint) as day_of_week,
       is_weekend, cast(month as bigint) as month, {r6('speed_mph')} as speed_mph, cast(zone_id as bigint) as zone_id
from feat"""

ORACLE["cyclic_hour"] = chain_upto("cells") + f"""
select {CELL_KEY_SQL}, {r6('hour_sin')} as hour_sin, {r6('hour_cos')} as hour_cos from cells"""

ORACLE["log_density"] = chain_upto("cells") + f"""
select {CELL_KEY_SQL}, cast(trip_density as bigint) as trip_density, {r6('log_trip_density')} as log_trip_density from cells"""

ORACLE["zone_attributes"] = chain_upto("cells") + f"""
select {CELL_KEY_SQL}, is_airport, is_cbd, is_rush_hour from cells"""

ORACLE["cyclic_distance"] = chain_upto("cells") + f"""
select {CELL_KEY_SQL}, cast(abs(hour_of_day - 23) as bigint) as linear_distance,
       cast(least(abs(hour_of_day - 23), 24 - abs(hour_of_day - 23)) as bigint) as circular_distance
from cells"""

ORACLE["cells_summary"] = chain_upto("cells") + f"""
select cast(count(distinct zone_id) as bigint) as unique_zones, cast(count(distinct hour_of_day) as bigint) as hours_covered,
       cast(count(*) as bigint) as n_rows, {r6('avg(speed_deviation)')} as speed_dev_mean,
       {r6('stddev_samp(speed_deviation)')} as speed_dev_std, {r6('avg(log_trip_density)')} as log_density_mean,
       cast(count(*) filter (where is_airport) as bigint) as airport_rows,
       cast(count(*) filter (where is_cbd) as bigint) as cbd_rows,
       cast(count(*) filter (where is_rush_hour) as bigint) as rush_hour_rows,
       cast(min(hour_of_day) as bigint) as hour_min, cast(max(hour_of_day) as bigint) as hour_max
from cells"""


# ---- step 3: labelled cells, mart, charts, dashboard -------------------------

from zonepace.operators import dashboard as _DB  # noqa: E402


def _lst(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _case_map(col: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"when {k} then '{v}'" for k, v in mapping.items())
    return f"case {col} {whens} else {default} end"


LEVEL_LABEL = _case_map("congestion_level", C.CONGESTION_LABELS, "'L' || cast(congestion_level as varchar)")
LEVEL_HEX = _case_map("congestion_level", C.CONGESTION_HEX_COLORS, f"'{C.DEFAULT_HEX}'")
DAY_NAME = (f"case when day_of_week between 0 and 6 then {_lst(C.DAY_NAMES_SHORT)}[day_of_week + 1] "
            "else cast(day_of_week as varchar) end")

LABELLED = """
lab0 as (select *, cast(floor(hour_of_day / 6) as int) as raw_cluster from cells),
remap as (select raw_cluster, row_number() over (order by avg(avg_speed_mph) desc, raw_cluster asc) - 1 as congestion_level
          from lab0 group by raw_cluster),
labelled as (select lab0.* exclude (raw_cluster), remap.congestion_level from lab0 join remap on lab0.raw_cluster = remap.raw_cluster)"""

MART = f""",
mart as (
  select *, {LEVEL_LABEL} as congestion_label, {LEVEL_HEX} as color_hex, {DAY_NAME} as day_name from (
    select zone_id, hour_of_day, day_of_week, is_weekend, mode(congestion_level) as congestion_level,
           avg(avg_speed_mph) as avg_speed_mph, sum(trip_density) as trip_density,
           avg(speed_deviation) as speed_deviation, first(is_airport) as is_airport, first(is_cbd) as is_cbd,
           first(is_rush_hour) as is_rush_hour
    from labelled group by zone_id, hour_of_day, day_of_week, is_weekend) g
)"""


def with_mart() -> str:
    return chain_upto("cells") + "," + LABELLED + MART


def _pal_sql() -> str:
    canon = "(k = 3 and mn = 0 and mx = 2)"
    rgba_cfg = "case congestion_level " + " ".join(
        f"when {lv} then {v}" for lv, v in C.CONGESTION_RGBA_COLORS.items()) + " end"
    return f""",
lv as (select congestion_level, row_number() over (order by congestion_level) - 1 as pos,
              count(*) over () as k, min(congestion_level) over () as mn, max(congestion_level) over () as mx
       from (select distinct congestion_level from mart) d),
pal0 as (
  select congestion_level, {canon} as canon, rgba_cfg,
    case when {canon} then {LEVEL_LABEL}
         when k = 3 then {_lst(_DB.LABELS_3)}[pos + 1]
         when k = 4 then {_lst(_DB.LABELS_4)}[pos + 1]
         when pos < {len(_DB.DESCRIPTORS)} then {_lst(_DB.DESCRIPTORS)}[pos + 1]
         else 'Level ' || cast(congestion_level as varchar) end as label,
    case when {canon} then {LEVEL_HEX}
         when k = 4 then {_lst(_DB.RAMP_4)}[pos + 1]
         when k = 6 then {_lst(_DB.RAMP_6)}[pos + 1]
         when k <= {len(_DB.DISTINCT_SEVERITY_PALETTE)} then {_lst(_DB.DISTINCT_SEVERITY_PALETTE)}[pos + 1]
         when pos < {len(_DB.QUALITATIVE_24)} then {_lst(_DB.QUALITATIVE_24)}[pos + 1]
         else '{C.DEFAULT_HEX}' end as hex
  from (select *, {rgba_cfg} as rgba_cfg from lv) x
),
palette as (
  select congestion_level, label, hex,
         case when canon then rgba_cfg[1] else cast(('0x' || substr(hex, 2, 2)) as integer) end as r,
         case when canon then rgba_cfg[2] else cast(('0x' || substr(hex, 4, 2)) as integer) end as g,
         case when canon then rgba_cfg[3] else cast(('0x' || substr(hex, 6, 2)) as integer) end as b,
         case when canon then rgba_cfg[4] else {_DB.PALETTE_ALPHA} end as a
  from pal0
)"""


PALETTE = _pal_sql()
MART_COLS = (CELL_KEY_SQL + ", cast(congestion_level as bigint) as congestion_level, "
             f"{r6('avg_speed_mph')} as avg_speed_mph, cast(trip_density as bigint) as trip_density, "
             f"{r6('speed_deviation')} as speed_deviation, is_airport, is_cbd, is_rush_hour, "
             "congestion_label, color_hex, day_name")

ORACLE["semantic_labels"] = chain_upto("cells") + "," + LABELLED + f"""
select {CELL_KEY_SQL}, {r6('avg_speed_mph')} as avg_speed_mph, cast(congestion_level as bigint) as congestion_level from labelled"""

ORACLE["viz_mart"] = with_mart() + f"\nselect {MART_COLS} from mart"

ORACLE["level_lookup"] = chain_upto("cells") + "," + LABELLED + f"""
select cast(congestion_level as bigint) as congestion_level, {LEVEL_LABEL} as congestion_label, {LEVEL_HEX} as color_hex
from (select distinct congestion_level from labelled) d"""

ORACLE["severity_dim"] = with_mart() + PALETTE + """
select cast(congestion_level as bigint) as congestion_level, label, hex, cast(r as bigint) as r, cast(g as bigint) as g,
       cast(b as bigint) as b, cast(a as bigint) as a from palette"""

for _key, _level in (("severity_dim_3", "hour_of_day // 8"), ("severity_dim_6", "hour_of_day // 4"), ("severity_dim_24", "hour_of_day")):
    ORACLE[_key] = with_mart() + PALETTE.replace("distinct congestion_level from mart", f"distinct {_level} as congestion_level from mart") + """
select cast(congestion_level as bigint) as congestion_level, label, hex, cast(r as bigint) as r, cast(g as bigint) as g,
       cast(b as bigint) as b, cast(a as bigint) as a from palette"""

ORACLE["hourly_trend"] = with_mart() + f"""
select cast(hour_of_day as bigint) as hour_of_day, {r6('avg(avg_speed_mph)')} as avg_speed,
       {r6('avg(trip_density)')} as avg_density, {r6('avg(speed_deviation)')} as avg_deviation
from mart group by hour_of_day"""

ORACLE["cluster_distribution"] = with_mart() + f"""
select cast(congestion_level as bigint) as congestion_level, cast(count(*) as bigint) as count,
       {LEVEL_LABEL} as label, {LEVEL_HEX} as color
from mart group by congestion_level"""

ORACLE["cluster_distribution_view"] = with_mart() + PALETTE + f""",
c as (select congestion_level, count(*) as n from mart where hour_of_day = 8 group by 1)
select cast(p.congestion_level as bigint) as congestion_level, cast(coalesce(n, 0) as bigint) as count, p.label as label, p.hex as color
from palette p left join c using (congestion_level)"""


def _pivot24(value: str, src: str, key: str) -> str:
    cols = ", ".join(f"{r6(f'avg({value}) filter (where hour_of_day = {h})')} as h{h:02d}" for h in range(24))
    return f"select {key}, {cols} from {src} group by {key.split(' as ')[-1] if ' as ' not in key else 'day_of_week'}"


ORACLE["day_hour_heatmap"] = with_mart() + f"""
select cast(day_of_week as bigint) as day_of_week, {DAY_NAME} as day_name, {", ".join(f"{r6(f'avg(congestion_level) filter (where hour_of_day = {h})')} as h{h:02d}" for h in range(24))}
from mart group by day_of_week"""

ORACLE["day_hour_speed"] = chain_upto("feat") + f"""
select cast(day_of_week as bigint) as day_of_week, {DAY_NAME} as day_name, {", ".join(f"{r6(f'avg(speed_mph) filter (where hour_of_day = {h})')} as h{h:02d}" for h in range(24))}
from feat group by day_of_week"""

ORACLE["top_congested_zones"] = with_mart() + f"""
select cast(zone_id as bigint) as zone_id, {r6('m')} as congestion_level, cast(rank as bigint) as rank,
       case least(2, cast(round_even(m, 0) as int)) {" ".join(f"when {k} then '{v}'" for k, v in C.CONGESTION_HEX_COLORS.items())} else '{C.DEFAULT_HEX}' end as color
from (select zone_id, avg(congestion_level) as m, row_number() over (order by avg(congestion_level) desc, zone_id asc) as rank
      from mart group by zone_id) t where rank <= 20"""


def _zone_heat(metric: str, n: int) -> str:
    cols = ", ".join(f"{r6(f'avg(m.congestion_level) filter (where m.hour_of_day = {h})')} as h{h:02d}" for h in range(24))
    return with_mart() + f""",
top as (select zone_id, row_number() over (order by {metric} desc, zone_id asc) as zone_rank from mart group by zone_id)
select cast(t.zone_rank as bigint) as zone_rank, cast(t.zone_id as bigint) as zone_id, {cols}
from top t join mart m on t.zone_id = m.zone_id where t.zone_rank <= {n} group by t.zone_rank, t.zone_id"""


ORACLE["zone_hour_heatmap"] = _zone_heat("sum(trip_density)", 40)
ORACLE["zone_hour_heatmap_app"] = _zone_heat("avg(congestion_level)", 25)

_PROFILE = ["avg_speed_mph", "speed_deviation", "log_trip_density", "trip_density", "hour_of_day"]
ORACLE["cluster_profile"] = chain_upto("cells") + "," + LABELLED + f""",
means as (select congestion_level, {", ".join(f"cast(floor(avg({f}) * cast(1e9 as double) + cast(0.5 as double)) as double) / cast(1e9 as double) as {f}" for f in _PROFILE)} from labelled group by congestion_level)
select cast(congestion_level as bigint) as congestion_level, {", ".join(
    r6(f"({f} - avg({f}) over ()) / case when stddev_pop({f}) over () = 0 then 1 else stddev_pop({f}) over () end") + f" as z_{f}"
    for f in _PROFILE)}
from means"""

ORACLE["cluster_summary"] = with_mart() + f"""
select cast(congestion_level as bigint) as congestion_level, cast(count(*) as bigint) as n_obs,
       cast(count(distinct zone_id) as bigint) as n_zones, {r6('avg(avg_speed_mph)')} as avg_speed,
       {r6('avg(speed_deviation)')} as avg_dev, {r6('avg(trip_density)')} as avg_density,
       {r6('avg(cast(is_weekend as double))')} as wknd_share
from mart group by congestion_level"""


def _r3e(x: str) -> str:
    return f"(round_even(({x}) * cast(1000 as double), 0) / cast(1000 as double))"


_CM = C.CLUSTER_FEATURES + ["avg_speed_mph", "trip_density"]
ORACLE["centroid_means"] = chain_upto("cells") + "," + LABELLED + f"""
select cast(congestion_level as bigint) as congestion_level, {", ".join(r6(_r3e(f'avg(cast({f} as double))')) + f' as {f}' for f in _CM)}
from labelled group by congestion_level"""

ORACLE["mart_header"] = with_mart() + """
select cast(count(*) as bigint) as n_rows, cast(count(distinct zone_id) as bigint) as n_zones,
       cast(count(distinct congestion_level) as bigint) as k,
       array_to_string(list_sort(list(distinct congestion_level)), ',') as levels
from mart"""

_CORR = ["avg_speed_mph", "trip_density", "speed_deviation", "hour_of_day"]
ORACLE["feature_correlation"] = chain_upto("cells") + "\n" + "\nunion all\n".join(
    f"select '{a}' as feature_a, '{b}' as feature_b, {r6(f'corr(cast({a} as double), cast({b} as double))')} as r from cells"
    for a in _CORR for b in _CORR)

_DESC = ["trip_distance", "trip_duration", "speed_mph"]
_P = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
ORACLE["describe_trips"] = chain_upto("feat") + ",\nlong as (" + "\nunion all\n".join(
    f"select '{c}' as col, cast({c} as double) as v from feat" for c in _DESC) + f""")
select col as "column", cast(count(*) as bigint) as count, {r6('avg(v)')} as mean, {r6('stddev_samp(v)')} as std,
       {r6('min(v)')} as min, {r6('max(v)')} as max,
       {", ".join(r6(f'quantile_cont(v, {p})') + f' as p{int(round(p * 100)):02d}' for p in _P)}
from long where v is not null and not isnan(v) group by col"""


def hist_sql(src: str, value: str, bins: int, groups: list[str] | None = None, density: bool = False) -> str:
    """Equal-width histogram over the group's own min/max, every bin listed."""
    g = groups or []
    gsel = "".join(f"{c}, " for c in g)
    gjoin = " and ".join(f"s.{c} is not distinct from r.{c}" for c in g) or "true"
    gby = ", ".join(g)
    gout = "".join(f"d.{c}, " for c in g)
    dj = "".join(f" and d.{c} is not distinct from c.{c}" for c in g)
    dens = ""
    if density:
        dens = f", {r6(f'coalesce(c.n, 0) / (sum(coalesce(c.n, 0)) over (partition by {', '.join('d.' + c for c in g) or 1}) * ((d.hi - d.lo) / cast({bins} as double)))')} as density"
    return f""",
h_src as (select {gsel}x from (select {gsel}cast({value} as double) as x from {src}) t where x is not null and not isnan(x)),
h_rng as (select {gsel}case when min(x) = max(x) then min(x) - 0.5 else min(x) end as lo,
                 case when min(x) = max(x) then max(x) + 0.5 else max(x) end as hi
          from h_src {'group by ' + gby if g else ''}),
h_cnt as (select {''.join(f's.{c}, ' for c in g)}least(floor((x - lo) * (cast({bins} as double) / (hi - lo))), {bins - 1}) as bin, count(*) as n
          from h_src s join h_rng r on {gjoin} group by all),
h_dim as (select {''.join(f'r.{c}, ' for c in g)}r.lo, r.hi, b.range as bin from h_rng r cross join range(0, {bins}) b)
select {''.join(f'{"cast(d." + c + " as bigint)" if c == "congestion_level" else "d." + c} as {c}, ' for c in g)}cast(d.bin as bigint) as bin, cast(coalesce(c.n, 0) as bigint) as count,
       {r6(f'd.lo + d.bin * ((d.hi - d.lo) / cast({bins} as double))')} as bin_lo,
       {r6(f'case when d.bin = {bins - 1} then d.hi else d.lo + (d.bin + 1) * ((d.hi - d.lo) / cast({bins} as double)) end')} as bin_hi{dens}
from h_dim d left join h_cnt c on d.bin = c.bin{dj}"""


ORACLE["hist_distance"] = chain_upto("feat") + hist_sql("feat", "least(greatest(trip_distance, 0), 30)", 80)
ORACLE["hist_log_distance"] = chain_upto("feat") + hist_sql("feat", "ln(1 + trip_distance)", 80)
ORACLE["hist_duration"] = chain_upto("feat") + hist_sql("feat", "least(greatest(trip_duration / cast(60 as double), 0), 90)", 80)
ORACLE["hist_speed"] = chain_upto("feat") + hist_sql("feat", "least(greatest(speed_mph, 0), 100)", 100)
ORACLE["hist_deviation"] = chain_upto("cells") + hist_sql("cells", "least(greatest(speed_deviation, -20), 20)", 80)
ORACLE["hist_density"] = chain_upto("cells") + hist_sql("cells", "trip_density", 60)
ORACLE["hist_log_density"] = chain_upto("cells") + hist_sql("cells", "log_trip_density", 60)

ORACLE["feature_distributions"] = chain_upto("cells") + "," + LABELLED + ",\nlongf as (" + "\nunion all\n".join(
    f"select '{f}' as feature, congestion_level, cast({f} as double) as value from labelled" for f in C.CLUSTER_FEATURES
) + ")" + hist_sql("longf", "value", 40, ["feature", "congestion_level"], density=True)

ORACLE["box_duration"] = chain_upto("feat") + f""",
v as (select trip_duration / cast(60 as double) as x from feat where trip_duration / cast(60 as double) < 120),
q as (select quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as median, quantile_cont(x, 0.75) as q3, count(*) as n from v)
select {r6('q1')} as q1, {r6('median')} as median, {r6('q3')} as q3, cast(n as bigint) as n,
       {r6('min(x) filter (where x >= q1 - 1.5 * (q3 - q1))')} as whisker_lo,
       {r6('max(x) filter (where x <= q3 + 1.5 * (q3 - q1))')} as whisker_hi,
       cast(count(*) filter (where x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1)) as bigint) as n_fliers,
       {r6('avg(x)')} as mean
from v cross join q group by q1, median, q3, n"""

ORACLE["deviation_histogram"] = with_mart() + f""",
q as (select quantile_cont(speed_deviation, 0.005) as lo, quantile_cont(speed_deviation, 0.995) as hi from mart)
select cast(congestion_level as bigint) as congestion_level,
       cast(least(floor((speed_deviation - lo) * (cast(59 as double) / (hi - lo))), 58) as bigint) as bin,
       cast(count(*) as bigint) as count
from mart cross join q where speed_deviation >= lo and speed_deviation <= hi group by all"""

ORACLE["density_deviation_points"] = with_mart() + f""",
q as (select quantile_cont(trip_density, 0.99) as p99 from mart)
select {CELL_KEY_SQL}, cast(congestion_level as bigint) as congestion_level,
       {r6('least(greatest(cast(trip_density as double), 0), p99)')} as density_clipped,
       {r6('speed_deviation')} as speed_deviation
from mart cross join q"""

ORACLE["density_deviation_eda"] = chain_upto("cells") + f"""
select {CELL_KEY_SQL}, {r6('least(greatest(cast(trip_density as double), 0), 500)')} as density_clipped,
       {r6('least(greatest(speed_deviation, -20), 20)')} as deviation_clipped from cells"""

ORACLE["monthly_trend"] = chain_upto("feat") + f"""
select file_ym, {r6('avg(speed_mph)')} as avg_speed, cast(count(speed_mph) as bigint) as n_trips,
       {r6('quantile_cont(speed_mph, 0.5)')} as median_speed
from feat group by file_ym"""

ORACLE["hourly_counts"] = chain_upto("feat") + """
select cast(hour_of_day as bigint) as hour_of_day, cast(count(*) as bigint) as trips from feat group by hour_of_day"""

ORACLE["hourly_speed_weekend"] = chain_upto("feat") + f"""
select cast(hour_of_day as bigint) as hour_of_day, is_weekend, {r6('avg(least(greatest(speed_mph, 1), 100))')} as avg_speed
from feat group by hour_of_day, is_weekend"""

ORACLE["top_zones_volume"] = chain_upto("feat") + """
select cast(PULocationID as bigint) as PULocationID, cast(trips as bigint) as trips, cast(rank as bigint) as rank
from (select PULocationID, count(*) as trips, row_number() over (order by count(*) desc, PULocationID asc) as rank
      from feat group by PULocationID) t where rank <= 20"""

ORACLE["slowest_zones"] = chain_upto("feat") + f"""
select cast(PULocationID as bigint) as PULocationID, {r6('s')} as avg_speed, cast(rank as bigint) as rank
from (select PULocationID, avg(least(greatest(speed_mph, 1), 100)) as s,
             row_number() over (order by avg(least(greatest(speed_mph, 1), 100)) asc, PULocationID asc) as rank
      from feat group by PULocationID) t where rank <= 20"""

_EDA = ["avg_speed_mph", "trip_density", "speed_deviation"]
ORACLE["eda_cluster_summary"] = chain_upto("cells") + "," + LABELLED + f"""
select cast(congestion_level as bigint) as congestion_level,
       {", ".join(r6(_r3e(f'avg({f})')) + f' as {f}_mean' for f in _EDA)},
       {", ".join(r6(_r3e(f'stddev_samp({f})')) + f' as {f}_std' for f in _EDA)}
from labelled group by congestion_level"""

VIEW_WHERE = "hour_of_day = 8 and not is_weekend and day_of_week in (1, 2, 3)"
ORACLE["dashboard_filter"] = with_mart() + f"\nselect {MART_COLS} from mart where {VIEW_WHERE}"
ORACLE["dashboard_focus"] = with_mart() + f"\nselect {MART_COLS} from mart where hour_of_day = 17 and is_weekend and congestion_level = 3"

ORACLE["insights"] = with_mart() + f"""
select 'peak_hour' as insight, cast(rank as bigint) as rank, cast(hour_of_day as bigint) as key, {r6('v')} as value
from (select hour_of_day, avg(congestion_level) as v, row_number() over (order by avg(congestion_level) desc, hour_of_day) as rank
      from mart group by hour_of_day) a where rank <= 3
union all
select 'top_zone', cast(rank as bigint), cast(zone_id as bigint), {r6('v')}
from (select zone_id, avg(congestion_level) as v, row_number() over (order by avg(congestion_level) desc, zone_id) as rank
      from mart group by zone_id) b where rank <= 5
union all
select 'level_pct', cast(null as bigint), cast(congestion_level as bigint), {r6('100.0::double * count(*) / sum(count(*)) over ()')}
from mart group by congestion_level
union all select 'overall_avg_speed', cast(null as bigint), cast(null as bigint), {r6('avg(avg_speed_mph)')} from mart
union all select 'total_density', cast(null as bigint), cast(null as bigint), {r6('cast(sum(trip_density) as double)')} from mart"""

ORACLE["kpi_row"] = with_mart() + f""",
info as (select list_sort(list(distinct congestion_level)) as levels, avg(avg_speed_mph) as overall from mart),
thr as (select levels[cast(floor(len(levels) * 0.66::double) as int) + 1] as t, overall from info),
f as (select * from mart where {VIEW_WHERE})
select cast(count(*) as bigint) as n_obs, cast(count(distinct zone_id) as bigint) as n_zones,
       {r6('coalesce(avg(avg_speed_mph), 0)')} as avg_speed_filtered, {r6('any_value(thr.overall)')} as avg_speed_overall,
       {r6('coalesce(avg(avg_speed_mph), 0) - any_value(thr.overall)')} as delta_speed,
       cast(any_value(thr.t) as bigint) as high_threshold,
       {r6('100.0::double * count(*) filter (where congestion_level >= thr.t) / greatest(count(*), 1)')} as pct_high,
       cast(coalesce(sum(trip_density), 0) as bigint) as total_trips
from thr left join f on true"""

_R1 = "(floor(({x}) * cast(10 as double) + cast(0.5 as double)) / cast(10 as double))"
ORACLE["auto_story"] = with_mart() + PALETTE + f""",
allm as (select avg(avg_speed_mph) as a, max(congestion_level) as mx from mart),
f as (select * from mart where {VIEW_WHERE}),
facts as (
  select count(distinct zone_id) as n_zones, avg(avg_speed_mph) as avg_speed, avg(avg_speed_mph) - any_value(a) as delta,
         avg(speed_deviation) as avg_dev,
         (select congestion_level from f group by congestion_level order by count(*) desc, congestion_level asc limit 1) as dom_level,
         100.0::double * count(*) filter (where congestion_level >= mx - 1) / count(*) as pct_high
  from f cross join allm
),
phr as (
  select facts.*, coalesce(p.label, 'Level ' || cast(dom_level as varchar)) as dom_label,
    case when delta > 1 then printf('%.1f mph faster than the all-day average', {_R1.format(x='abs(delta)')})
         when delta < -1 then printf('%.1f mph slower than the all-day average', {_R1.format(x='abs(delta)')})
         else 'close to the all-day average' end as speed_phrase,
    case when avg_dev > 1 then 'zones are moving above their typical baseline — uncongested'
         when avg_dev < -1 then 'zones are moving below their typical baseline — congested'
         else 'zones are at their typical baseline speed' end as dev_phrase
  from facts left join palette p on p.congestion_level = facts.dom_level
)
select cast(n_zones as bigint) as n_zones, {r6('avg_speed')} as avg_speed, {r6('delta')} as delta, {r6('avg_dev')} as avg_dev,
       cast(dom_level as bigint) as dom_level, dom_label, {r6('pct_high')} as pct_high, speed_phrase, dev_phrase,
       printf('At %02d:00 (%s), %d zones are active. Average speed is %.1f mph, %s, and %s. The dominant cluster is %s, and %.0f%% of observations sit in the highest one-or-two congestion levels.',
              8, 'weekdays only', n_zones, {_R1.format(x='avg_speed')}, speed_phrase, dev_phrase, dom_label,
              floor(pct_high + 0.5)) as story
from phr"""

ORACLE["top_zones_dashboard"] = with_mart() + PALETTE + f""",
f as (select * from mart where {VIEW_WHERE}),
rng as (select min(congestion_level) as lo, max(congestion_level) as hi from palette),
agg as (select zone_id, avg(congestion_level) as avg_level, avg(avg_speed_mph) as avg_speed, sum(trip_density) as density,
               row_number() over (order by avg(congestion_level) desc, zone_id asc) as rank
        from f group by zone_id),
top as (select agg.*, least(greatest(cast(round_even(avg_level, 0) as int), lo), hi) as lvl_int from agg cross join rng where rank <= 15)
select cast(rank as bigint) as rank, cast(zone_id as bigint) as zone_id, {r6('avg_level')} as avg_level, {r6('avg_speed')} as avg_speed,
       cast(density as bigint) as density, cast(lvl_int as bigint) as lvl_int, coalesce(p.hex, '#e74c3c') as color,
       'Zone ' || cast(zone_id as varchar) as label
from top left join palette p on p.congestion_level = top.lvl_int"""

ORACLE["map_points"] = with_mart() + PALETTE + f""",
cent as (select zone_id, 40.5::double + zone_id * 0.002::double as latitude,
                -74.25::double + ((zone_id * 37) % 263) * 0.002::double as longitude
         from (select distinct zone_id from cells) z where zone_id % 50 <> 0),
m as (select f.*, c.latitude, c.longitude from mart f join cent c on f.zone_id = c.zone_id where {VIEW_WHERE.replace('hour_of_day', 'f.hour_of_day').replace('is_weekend', 'f.is_weekend').replace('day_of_week', 'f.day_of_week')}),
mx as (select max(trip_density) as mx from m)
select {CELL_KEY_SQL}, cast(m.congestion_level as bigint) as congestion_level, {r6('latitude')} as latitude,
       {r6('longitude')} as longitude, cast(trip_density as bigint) as trip_density,
       cast(coalesce(p.r, {_DB.DEFAULT_RGBA[0]}) as bigint) as r, cast(coalesce(p.g, {_DB.DEFAULT_RGBA[1]}) as bigint) as g,
       cast(coalesce(p.b, {_DB.DEFAULT_RGBA[2]}) as bigint) as b, cast(coalesce(p.a, {_DB.DEFAULT_RGBA[3]}) as bigint) as a,
       coalesce(p.label, cast(m.congestion_level as varchar)) as label,
       {r6('case when mx > 0 then least(greatest(trip_density / cast(mx as double) * 350.0::double + 140.0::double, 140.0::double), 580.0::double) else 180.0::double end')} as radius
from m cross join mx left join palette p on p.congestion_level = m.congestion_level"""

ORACLE["filtered_table"] = with_mart() + PALETTE + f"""
select cast(zone_id as bigint) as zone_id, cast(hour_of_day as bigint) as hour_of_day, day_name,
       p.label as congestion_label_dynamic, {r6('avg_speed_mph')} as avg_speed_mph, cast(trip_density as bigint) as trip_density,
       {r6('speed_deviation')} as speed_deviation, cast(m.congestion_level as bigint) as congestion_level
from mart m left join palette p on p.congestion_level = m.congestion_level where {VIEW_WHERE}"""


# ---- step 4 -------------------------------------------------------------------

_F = C.CLUSTER_FEATURES
_K3 = ("cast(zone_id as bigint) as zone_id, cast(hour_of_day as bigint) as hour_of_day, "
       "cast(day_of_week as bigint) as day_of_week")
FEATM = chain_upto("cells") + "," + LABELLED + """,
fm as (select zone_id, hour_of_day, day_of_week, congestion_level, avg_speed_mph,
              cast(hour_sin as double) as hour_sin, cast(hour_cos as double) as hour_cos,
              cast(cast(is_weekend as int) as double) as is_weekend, cast(speed_deviation as double) as speed_deviation,
              cast(log_trip_density as double) as log_trip_density
       from labelled where hour_sin is not null and hour_cos is not null and is_weekend is not null
         and speed_deviation is not null and log_trip_density is not null)"""

ORACLE["feature_matrix"] = FEATM + f"\nselect {_K3}, {', '.join(r6(f) + ' as ' + f for f in _F)} from fm"

STD_STATS = ",\nst as (select " + ", ".join(
    f"avg({f}) as {f}_c, case when stddev_pop({f}) = 0 then 1 else stddev_pop({f}) end as {f}_s" for f in _F) + " from fm)"
SCALED = STD_STATS + ",\nsc as (select fm.zone_id, fm.hour_of_day, fm.day_of_week, fm.congestion_level, " + ", ".join(
    f"(fm.{f} - st.{f}_c) / st.{f}_s as {f}" for f in _F) + " from fm cross join st)"

ORACLE["scale_standard"] = FEATM + SCALED + f"\nselect {_K3}, {', '.join(r6(f) + ' as ' + f for f in _F)} from sc"

ORACLE["scale_robust"] = FEATM + ",\nrs as (select " + ", ".join(
    f"quantile_cont({f}, 0.5) as {f}_c, case when quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) = 0 then 1 "
    f"else quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) end as {f}_s" for f in _F) + " from fm)" + f"""
select {_K3}, {', '.join(r6(f'(fm.{f} - rs.{f}_c) / rs.{f}_s') + ' as ' + f for f in _F)} from fm cross join rs"""

_CEN = ",\ncen as (select congestion_level, " + ", ".join(f"avg({f}) as c_{f}" for f in _F) + \
       ", count(*) as n from sc group by congestion_level)"
_DIST = " + ".join(f"(sc.{f} - cen.c_{f})^2" for f in _F)
ORACLE["davies_bouldin"] = FEATM + SCALED + _CEN + f""",
s as (select sc.congestion_level, avg(sqrt({_DIST})) as s from sc join cen on sc.congestion_level = cen.congestion_level group by 1),
cs as (select cen.*, s.s from cen join s on cen.congestion_level = s.congestion_level),
r as (select a.congestion_level, max(case when sqrt({' + '.join(f'(a.c_{f} - b.c_{f})^2' for f in _F)}) = 0 then cast('inf' as double)
              else (a.s + b.s) / sqrt({' + '.join(f'(a.c_{f} - b.c_{f})^2' for f in _F)}) end) as r
      from cs a join cs b on a.congestion_level <> b.congestion_level group by 1)
select {r6("case when (select count(*) from cen) between 2 and (select sum(n) from cen) - 1 then (select avg(r) from r) else cast('nan' as double) end")} as davies_bouldin"""

ORACLE["calinski_harabasz"] = FEATM + SCALED + _CEN + f""",
m as (select {', '.join(f'avg({f}) as m_{f}' for f in _F)} from sc),
w as (select sum({_DIST}) as W from sc join cen on sc.congestion_level = cen.congestion_level),
b as (select sum(n * ({' + '.join(f'(c_{f} - m_{f})^2' for f in _F)})) as B, count(*) as k, sum(n) as n from cen cross join m)
select {r6("case when k between 2 and n - 1 then case when W = 0 then 1.0 else (B / (k - 1)) / (W / (n - k)) end else cast('nan' as double) end")} as calinski_harabasz
from b cross join w"""

ORACLE["cv_intra"] = chain_upto("cells") + "," + LABELLED + f"""
select cast(congestion_level as bigint) as congestion_level,
       {r6("case when avg(avg_speed_mph) > 0 then stddev_pop(avg_speed_mph) / avg(avg_speed_mph) else cast('nan' as double) end")} as cv
from labelled group by congestion_level"""


def _ari_sql(b_expr: str) -> str:
    return chain_upto("cells") + "," + LABELLED + f""",
ct as (select congestion_level as a, {b_expr} as b, cast(count(*) as double) as nij from labelled group by 1, 2),
sa as (select sum(ai * (ai - 1) / 2) as sum_a from (select a, sum(nij) as ai from ct group by a) x),
sb as (select sum(bj * (bj - 1) / 2) as sum_b from (select b, sum(nij) as bj from ct group by b) y),
sij as (select sum(nij * (nij - 1) / 2) as sum_ij, sum(nij) as n from ct),
e as (select sum_ij, sum_a * sum_b / (n * (n - 1) / 2) as ex, (sum_a + sum_b) / 2 as mx from sij, sa, sb)
select {r6("case when mx - ex = 0 then 1.0 else (sum_ij - ex) / (mx - ex) end")} as ari from e"""


ORACLE["ari"] = _ari_sql("(zone_id + hour_of_day) % 4")
ORACLE["ari_identical"] = _ari_sql("10 - congestion_level")

# Silhouettes over all pairs of rows: per row the sums of distances to every level.
def _sil_ctes(table: str, feats: list[str], k: int) -> str:
    """CTEs ending in sil: ``table`` with its silhouettes s over levels 0..k-1."""
    pair = "sqrt(" + " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in feats) + ")"
    return f"""
sp as materialized (select *, row_number() over () as r, count(*) over (partition by congestion_level) as own_n from {table}),
pd as (select a.r, b.congestion_level as l, {pair} as d from sp a, sp b),
sums as materialized (select r, {', '.join(f'coalesce(sum(d) filter (l = {i}), 0) as s{i}' for i in range(k))} from pd group by r),
ns as (select {', '.join(f'nullif(count(*) filter (congestion_level = {i}), 0) as n{i}' for i in range(k))} from {table}),
ab as (select sp.*, [{', '.join(f's{i}' for i in range(k))}][congestion_level + 1] / nullif(own_n - 1, 0) as am,
              least({', '.join(f'case when congestion_level <> {i} then s{i} / n{i} end' for i in range(k))}) as bm from sp join sums using (r), ns),
sil as materialized (select *, case when own_n = 1 or greatest(am, bm) = 0 then 0 else (bm - am) / greatest(am, bm) end as s from ab)"""


SIL = FEATM + SCALED + "," + _sil_ctes("sc", _F, 4)
ORACLE["silhouette_overall"] = SIL + f"\nselect {r6('avg(s)')} as silhouette from sil"
ORACLE["silhouette_per_cluster"] = SIL + f"""
select cast(congestion_level as bigint) as congestion_level, {r6('avg(s)')} as silhouette from sil group by congestion_level"""
ORACLE["silhouette_samples"] = SIL + f"""
select {_K3}, {r6('s')} as sil_congestion_level, cast(congestion_level as bigint) as congestion_level,
       cast(row_number() over (partition by congestion_level order by {r6('s')} desc, zone_id, hour_of_day, day_of_week) as bigint) as band_rank from sil"""

ORACLE["cluster_quality"] = SIL + _CEN + f""",
s as (select sc.congestion_level, avg(sqrt({_DIST})) as s from sc join cen on sc.congestion_level = cen.congestion_level group by 1),
cs as (select cen.*, s.s from cen join s on cen.congestion_level = s.congestion_level),
r as (select a.congestion_level, max((a.s + b.s) / sqrt({' + '.join(f'(a.c_{f} - b.c_{f})^2' for f in _F)})) as r
      from cs a join cs b on a.congestion_level <> b.congestion_level group by 1),
m as (select {', '.join(f'avg({f}) as m_{f}' for f in _F)} from sc),
w as (select sum({_DIST}) as W from sc join cen on sc.congestion_level = cen.congestion_level),
b as (select sum(n * ({' + '.join(f'(c_{f} - m_{f})^2' for f in _F)})) as B, count(*) as k, sum(n) as n from cen cross join m),
cv as (select congestion_level, case when avg(avg_speed_mph) > 0 then stddev_pop(avg_speed_mph) / avg(avg_speed_mph)
              else cast('nan' as double) end as cv from fm group by 1)
select 'silhouette' as metric, cast(null as bigint) as level, (select {r6('avg(s)')} from sil) as value
union all select 'silhouette_cluster', cast(congestion_level as bigint), {r6('avg(s)')} from sil group by congestion_level
union all select 'davies_bouldin', null, {r6('(select avg(r) from r)')}
union all select 'calinski_harabasz', null, {r6('(B / (k - 1)) / (W / (n - k))')} from b cross join w
union all select 'cv_intra', cast(congestion_level as bigint), {r6('cv')} from cv
union all select 'cluster_size', cast(congestion_level as bigint), cast(count(*) as double) from fm group by congestion_level
union all select 'kpi_pass', null, case when (select avg(s) from sil) > {C.TARGET_SILHOUETTE} and (select max(cv) from cv) < {C.TARGET_CVINTRA} then 1.0::double else 0.0 end"""

ORACLE["kpi_gate"] = SIL + f""",
tight as (select floor(ln(avg_speed_mph) / ln(1.25)) as l, avg_speed_mph as v from labelled),
bands as (select l, count(*) as n, stddev_pop(v) / avg(v) as cv from tight group by l),
-- rows of a band lie on one point: the silhouette is 1 for each, 0 for a band of one row
t as (select sum(case when n > 1 then n else 0 end)::double / sum(n) > {C.TARGET_SILHOUETTE} and count(*) > 1 as sil_ok, max(cv) < {C.TARGET_CVINTRA} as cv_ok from bands),
h as (select (select avg(s) from sil) > {C.TARGET_SILHOUETTE} as sil_ok,
             (select max(cv) from (select stddev_pop(avg_speed_mph) / avg(avg_speed_mph) as cv from labelled group by congestion_level)) < {C.TARGET_CVINTRA} as cv_ok)
select 'hour_bands' as labeling, sil_ok, cv_ok, sil_ok and cv_ok as kpi_pass from h
union all select 'speed_bands', sil_ok, cv_ok, sil_ok and cv_ok from t"""


# ---- steps 5–7 ------------------------------------------------------------------

# Real cells scaled (standard) — for DBSCAN.
CELLSC = chain_upto("cells") + """,
fm as (select zone_id, hour_of_day, day_of_week, cast(hour_sin as double) as hour_sin, cast(hour_cos as double) as hour_cos,
              cast(cast(is_weekend as int) as double) as is_weekend, cast(speed_deviation as double) as speed_deviation,
              cast(log_trip_density as double) as log_trip_density from cells)""" + STD_STATS + """,
sc as (select fm.zone_id, fm.hour_of_day, fm.day_of_week, """ + ", ".join(
    f"(fm.{f} - st.{f}_c) / st.{f}_s as {f}" for f in _F) + " from fm cross join st)"

_EPS = C.DBSCAN_EPS
_OFFS = "offs as (select " + ", ".join(f"o{i}.range as o{i}" for i in range(5)) + " from " + ", ".join(
    f"range(-1, 2) o{i}" for i in range(5)) + ")"
EPS_NB = CELLSC + f""",
pts as (select *, {', '.join(f'floor({f} / {_EPS!r}::double) as b{i}' for i, f in enumerate(_F))} from sc),
{_OFFS},
nb as (select p.zone_id, p.hour_of_day, p.day_of_week, count(*) as neighbors
       from pts p cross join offs join pts q on {' and '.join(f'q.b{i} = p.b{i} + o{i}' for i in range(5))}
       where sqrt({' + '.join(f'(p.{f} - q.{f})^2' for f in _F)}) <= {_EPS!r}::double
       group by p.zone_id, p.hour_of_day, p.day_of_week)"""

ORACLE["eps_neighbors"] = EPS_NB + f"""
select {_K3}, cast(neighbors as bigint) as neighbors, neighbors >= {C.DBSCAN_MIN_SAMPLES} as is_core from nb"""

ORACLE["dbscan_core"] = EPS_NB + f"""
select cast(count(*) filter (where neighbors >= {C.DBSCAN_MIN_SAMPLES}) as bigint) as n_core, cast(count(*) as bigint) as n_points,
       cast(sum(neighbors) as bigint) as n_pairs from nb"""

# Clusters: core points of one cell of side just under eps / sqrt(5) are one node; smallest labels walk over the
# distinct links between nodes until nothing changes.
_SIDE = f"({_EPS!r}::double / sqrt(5) * (1 - 1e-8))"
_NEAR = f"sqrt({' + '.join(f'(p.{f} - q.{f})^2' for f in _F)}) <= {_EPS!r}::double"
_MET = " and ".join(f"q.b{i} = p.b{i} + o{i}" for i in range(5))
DBSCAN = EPS_NB.replace("with ", "with recursive ", 1) + f""",
allp as materialized (select pts.*, zone_id * 1000 + hour_of_day * 10 + day_of_week as id, neighbors >= {C.DBSCAN_MIN_SAMPLES} as core
         from pts join nb using (zone_id, hour_of_day, day_of_week)),
corep as materialized (select *, min(id) over (partition by {', '.join(f'floor({f} / {_SIDE})' for f in _F)}) as node from allp where core),
links as materialized (select distinct p.node as i, q.node as j from corep p cross join offs join corep q on {_MET} where p.node <> q.node and {_NEAR}),
walk(node, comp) using key (node) as (
  select distinct node, node from corep
  union
  select l.i, min(w.comp) from walk w join links l on l.j = w.node join recurring.walk r on r.node = l.i where w.comp < r.comp group by l.i),
numbered as materialized (select node, dense_rank() over (order by comp) - 1 as cluster from walk),
inside as materialized (select corep.*, cluster from corep join numbered using (node)),
edge as (select p.id, min(q.cluster) as cluster from (select * from allp where not core) p cross join offs join inside q on {_MET} where {_NEAR} group by p.id),
lab as (select a.zone_id, a.hour_of_day, a.day_of_week, coalesce(i.cluster, e.cluster, -1) as dbscan_label
        from allp a left join inside i on i.id = a.id left join edge e on e.id = a.id)"""

ORACLE["dbscan_labels"] = DBSCAN + f"\nselect {_K3}, cast(dbscan_label as bigint) as dbscan_label from lab"

ORACLE["dbscan_metrics"] = DBSCAN + f""",
sizes as (select dbscan_label, count(*) as size from lab where dbscan_label <> -1 group by 1)
select (select count(*) from sizes) as n_hotspots, cast(count(*) filter (dbscan_label = -1) as bigint) as n_noise,
       round_even(count(*) filter (dbscan_label = -1) / count(*)::double * 10000, 0) / 10000 as noise_fraction,
       count(*) filter (dbscan_label = -1) / count(*)::double > {C.DBSCAN_NOISE_WARN_FRACTION} as noise_fraction_warn,
       {_EPS!r}::double as eps, cast({C.DBSCAN_MIN_SAMPLES} as bigint) as min_samples,
       coalesce((select min(size) from sizes), 0) as hotspot_sizes_min, coalesce((select max(size) from sizes), 0) as hotspot_sizes_max,
       coalesce((select median(size) from sizes), 0)::double as hotspot_sizes_median,
       coalesce((select dbscan_label from sizes order by size desc, dbscan_label limit 1), -1) as largest_hotspot_label
from lab"""

FIXED_SWEEP = FEATM + SCALED + f""",
ks as (select range as k from range({C.K_RANGE[0]}, {C.K_RANGE[1]})),
lab as (select sc.*, ks.k, floor(hour_of_day * ks.k / 24) as band from sc cross join ks),
cen as (select k, band, {', '.join(f'avg({f}) as c_{f}' for f in _F)} from lab group by k, band),
sweep as (select lab.k, sum({' + '.join(f'(lab.{f} - cen.c_{f})^2' for f in _F)}) as inertia
          from lab join cen on lab.k = cen.k and lab.band = cen.band group by lab.k)"""

ORACLE["fixed_sweep"] = FIXED_SWEEP + f"\nselect cast(k as bigint) as k, {r6('inertia')} as inertia from sweep"

ORACLE["elbow_second_diff"] = FIXED_SWEEP + f""",
d2 as (select k, lead(inertia) over (order by k) - 2 * inertia + lag(inertia) over (order by k) as d2 from sweep)
select cast(case when (select count(*) from sweep) >= 3 then (select k from d2 where d2 is not null order by d2 desc, k asc limit 1)
            else {C.DEFAULT_K} end as bigint) as elbow_k,
       case when (select count(*) from sweep) >= 3 then '2nd-derivative' else 'default-k (too-few-points)' end as source"""

ORACLE["pca_covariance"] = FEATM + SCALED + "\n" + "\nunion all\n".join(
    f"select '{a}' as feature_a, '{b}' as feature_b, {r6(f'covar_samp({a}, {b})')} as cov from sc" for a in _F for b in _F)



def _r4(x: str) -> str:
    return r6(f"cast(floor(({x}) * 10000.0::double + 0.5::double) as double) / 10000.0::double")


def _pca_sql(squarings: int = 45) -> str:
    """Two components by repeated squaring of the covariance matrix (power 2^45), the second after deflation;
    sign by the largest loading."""
    n = range(len(_F))
    cov = ", ".join(f"covar_samp({_F[i]}, {_F[j]}) as c{i}{j}" for i in n for j in n)
    times = lambda m, v: [" + ".join(f"{m}.c{i}{j} * {v}.v{j}" for j in n) for i in n]

    def iterate(name: str, matrix: str) -> str:
        square = ", ".join(" + ".join(f"c{i}{h} * c{h}{j}" for h in n) + f" as q{i}{j}" for i in n for j in n)
        most = f"greatest({', '.join(f'abs(q{i}{j})' for i in n for j in n)})"
        start = [" + ".join(f"c{i}{j} * {1.0 + 0.1 * j}" for j in n) for i in n]
        length = f"sqrt({' + '.join(f'w{i} * w{i}' for i in n)})"
        return f"""
{name}_it as (
  select 0 as step, {', '.join(f'c{i}{j}' for i in n for j in n)} from {matrix}
  union all
  select step + 1, {', '.join(f'q{i}{j} / {most}' for i in n for j in n)}
  from (select step, {square} from {name}_it where step < {squarings}) q),
{name}_v as (
  select {', '.join(f'w{i} / {length} as v{i}' for i in n)}
  from (select {', '.join(f'{e} as w{i}' for i, e in enumerate(start))} from {name}_it where step = {squarings}) w),
{name} as (
  select p.*, {' + '.join(f'p.v{i} * ({e})' for i, e in enumerate(times('m', 'p')))} as lambda,
         list_transform([{', '.join(f'p.v{i}' for i in n)}], lambda x: abs(x)) as sizes
  from {name}_v p, {matrix} m),
{name}_s as (
  select *, sign([{', '.join(f'v{i}' for i in n)}][list_position(sizes, list_max(sizes))]) as sg from {name})"""

    deflated = ", ".join(f"c.c{i}{j} - a.lambda * a.v{i} * a.v{j} as c{i}{j}" for i in n for j in n)
    score = lambda a: f"{a}.sg * (" + " + ".join(f"(sc.{f} - mu.m{i}) * {a}.v{i}" for i, f in enumerate(_F)) + ")"
    trace = " + ".join(f"cov.c{i}{i}" for i in n)
    return (FEATM + SCALED).replace("with ", "with recursive ", 1) + f""",
cov as (select {cov} from sc),
mu as (select {', '.join(f'avg({f}) as m{i}' for i, f in enumerate(_F))} from sc),{iterate('pa', 'cov')},
cov2 as (select {deflated} from cov c, pa a),{iterate('pb', 'cov2')}
select {_K3}, cast(congestion_level as bigint) as congestion_level, {_r4(score('pa_s'))} as pc1, {_r4(score('pb_s'))} as pc2,
       {r6(f'pa_s.lambda / ({trace})')} as explained_pc1, {r6(f'pb_s.lambda / ({trace})')} as explained_pc2
from sc, mu, cov, pa_s, pb_s"""


ORACLE["pca_projection"] = _pca_sql()


# K-Means, all seeds side by side: a start by races over hashed waiting times, then Lloyd steps in a recursion.
_P = 2_147_483_647


def _kmeans_ctes(table: str, feats: list[str], k: int, seeds: list[int], group: str = "0", tol: float = 1e-4) -> str:
    """CTEs ending in fits(grp, seed, c, inertia): the best seed of each group, from ``table`` (rid, features)."""
    point = "{" + ", ".join(f"'{f}': p.{f}" for f in feats) + "}"
    far = lambda c: "(" + " + ".join(f"(p.{f} - {c}.{f}) * (p.{f} - {c}.{f})" for f in feats) + ")"
    hashed = f"select p.*, seed, ((rid % {_P}) * 48271 + (seed * 69621 + {{step}} * 40692 + 12345) % {_P}) % {_P} as z from {table} p, seeds"
    for add in (7, 11, 13):
        hashed = f"select * exclude (z, q), (q * q % {_P} * z + {add}) % {_P} as z from (select *, z * z % {_P} as q from ({hashed}))"
    out = f"seeds as (select unnest({seeds}) as seed),\n"
    for step in range(k):
        rate = "1.0" if step == 0 else "least(" + ", ".join(far(f"s.c{j}") for j in range(step)) + ")" if step > 1 else far("s.c0")
        kept = "".join(f", any_value(s.c{j}) as c{j}" for j in range(step))
        wait = f"case when rate > 0 then -ln((z + 1) / {_P + 1}.0::double) / rate else 'inf'::double end"
        source = f"({hashed.format(step=step)}) p" + (f" join start{step - 1} s using (seed)" if step else "")
        keeps = "".join(f", s.c{j} as c{j}" for j in range(step))
        out += (f"start{step} as materialized (select seed{kept.replace('s.c', 'c')}, arg_min(point, {wait}) as c{step} "
                f"from (select p.seed, z, {rate} as rate, {point} as point{keeps} from {source}) group by seed),\n")
    cs = [f"c{j}" for j in range(k)]
    near = lambda v: "case " + " ".join(f"when {v}{j} = nearest then {j}" for j in range(k)) + " end"
    dists = ", ".join(f"{far(f'l.c{j}')} as d{j}" for j in range(k))
    mean = lambda j: "{" + ", ".join(f"'{f}': coalesce(avg({f}) filter (near = {j}), any_value(c{j}.{f}))" for f in feats) + "}"
    shift = " + ".join(f"(n{j}.{f} - c{j}.{f}) * (n{j}.{f} - c{j}.{f})" for j in range(k) for f in feats)
    least = f"(select {tol} * ({' + '.join(f'var_pop({f})' for f in feats)}) / {len(feats)} from {table})"
    labelled = f"(select *, {near('d')} as near from (select *, least({', '.join(f'd{j}' for j in range(k))}) as nearest from (select l.*, p.*, {dists} from {{0}} l, {table} p)))"
    out += f"""lloyd(seed, it, {', '.join(cs)}, done) as (
  select seed, 0, {', '.join(cs)}, false from start{k - 1}
  union all
  select seed, it + 1, {', '.join(f'n{j}' for j in range(k))}, {shift} <= {least} or it + 1 >= {C.KMEANS_MAX_ITER} from (
    select seed, it, {', '.join(f'any_value(c{j}) as c{j}' for j in range(k))}, {', '.join(f'{mean(j)} as n{j}' for j in range(k))}
    from {labelled.format('(select * from lloyd where not done)')} group by seed, it)),
ended as materialized (select * exclude (done, it) from lloyd where done),
costs as materialized (select seed, sum(nearest) as inertia from {labelled.format('ended')} group by seed),
fits as materialized (select {group} as grp, arg_min(seed, (inertia, seed)) as seed, min(inertia) as inertia from costs group by 1),
near as materialized (select b.grp, b.inertia, n.* from {labelled.format('(select * from ended where seed in (select seed from fits))')} n join fits b using (seed))"""
    return out


_LEVELS = """,
lev as (select grp, near, row_number() over (partition by grp order by avg(avg_speed_mph) desc) - 1 as congestion_level,
               avg(avg_speed_mph) as speed, count(*) as n from near group by grp, near),
lab as (select near.*, lev.congestion_level from near join lev using (grp, near))"""
_CELLSC_ID = CELLSC.replace("with ", "with recursive ", 1) + f""",
scid as materialized (select sc.*, zone_id * 1000 + hour_of_day * 10 + day_of_week as rid, avg_speed_mph
                      from sc join cells using (zone_id, hour_of_day, day_of_week)),
"""
_SEED = C.KMEANS_RANDOM_STATE
_FIT = _CELLSC_ID + _kmeans_ctes("scid", _F, C.DEFAULT_K, list(range(_SEED, _SEED + C.KMEANS_N_INIT))) + _LEVELS
ORACLE["kmeans_labels"] = _FIT + f"""
select {_K3}, {r6('avg_speed_mph')} as avg_speed_mph, cast(congestion_level as bigint) as congestion_level from lab"""

ORACLE["kmeans_facts"] = _FIT + f"""
select cast(count(*) as bigint) as n_rows, (select count(*) from lev) as n_levels,
       cast(max(congestion_level) - min(congestion_level) + 1 as bigint) as level_span, (select max(n) from lev) as largest,
       (select bool_and(falls) from (select coalesce(speed < lag(speed) over (order by congestion_level), true) as falls from lev)) as speeds_fall,
       true as all_nearest, abs(sum(nearest) / any_value(inertia) - 1) < 1e-9 as cost_agrees,
       round(any_value(inertia), 4) as inertia, cast(any_value(seed) as bigint) as seed from lab"""

_QUICK = ["avg_speed_mph", "trip_density", "speed_deviation"]
_QUICK_LAB = chain_upto("cells").replace("with ", "with recursive ", 1) + f""",
st as (select {', '.join(f'avg({f}) as {f}_c, case when stddev_pop({f}) = 0 then 1 else stddev_pop({f}) end as {f}_s' for f in _QUICK)} from cells),
scid as materialized (select zone_id, hour_of_day, day_of_week, zone_id * 1000 + hour_of_day * 10 + day_of_week as rid, avg_speed_mph as raw_speed,
                             {', '.join(f'({f} - {f}_c) / {f}_s as {f}' for f in _QUICK)} from cells, st),
{_kmeans_ctes("scid", _QUICK, 3, list(range(_SEED, _SEED + C.KMEANS_N_INIT)))}{_LEVELS}"""
ORACLE["eda_quick_clusters"] = _QUICK_LAB + f"""
select {_K3}, {r6('raw_speed')} as avg_speed_mph, cast(congestion_level as bigint) as congestion_level from lab"""
ORACLE["eda_quick_silhouette"] = _QUICK_LAB + "," + _sil_ctes("lab", _QUICK, 3) + f"\nselect {r6('avg(s)')} as silhouette from sil"

ORACLE["stability"] = _CELLSC_ID + _kmeans_ctes("scid", _F, C.DEFAULT_K, [s * 1000 + i for s in range(C.STABILITY_N_SEEDS) for i in range(C.KMEANS_N_INIT)],
                                                "seed // 1000") + f""",
ct as (select a.grp as g, b.grp as h, a.near as i, b.near as j, cast(count(*) as double) as nij from near a join near b on a.rid = b.rid and a.grp < b.grp group by all),
sa as (select g, h, sum(ai * (ai - 1) / 2) as sum_a from (select g, h, i, sum(nij) as ai from ct group by all) group by all),
sb as (select g, h, sum(bj * (bj - 1) / 2) as sum_b from (select g, h, j, sum(nij) as bj from ct group by all) group by all),
sij as (select g, h, sum(nij * (nij - 1) / 2) as sum_ij, sum(nij) as n from ct group by all),
e as (select *, sum_a * sum_b / (n * (n - 1) / 2) as ex, (sum_a + sum_b) / 2 as mx from sij join sa using (g, h) join sb using (g, h)),
ari as (select case when mx - ex = 0 then 1.0 else (sum_ij - ex) / (mx - ex) end as ari from e)
select {r6('avg(ari)')} as ari_mean, {r6('min(ari)')} as ari_min, min(ari) >= {C.STABILITY_ARI_MIN} as ari_pass from ari"""

ORACLE["silhouette_sample"] = FEATM + SCALED + f"\nselect {_K3}, cast(congestion_level as bigint) as congestion_level from sc"

ORACLE["zone_centroids"] = chain_upto("cells") + """,
z as (select distinct zone_id from cells),
shape as (
  select zone_id, (zone_id % 20) * 10.0::double as cx, floor(zone_id / 20) * 10.0::double as cy,
         case when zone_id % 10 = 0 then [{'r':0,'s':0,'dx':0.0,'dy':0.0},{'r':0,'s':1,'dx':4.0,'dy':0.0},{'r':0,'s':2,'dx':4.0,'dy':4.0},{'r':0,'s':3,'dx':0.0,'dy':4.0},
                                          {'r':1,'s':0,'dx':1.0,'dy':1.0},{'r':1,'s':1,'dx':1.0,'dy':2.0},{'r':1,'s':2,'dx':2.0,'dy':2.0},{'r':1,'s':3,'dx':2.0,'dy':1.0}]
              when zone_id % 3 = 0 then [{'r':0,'s':0,'dx':0.0,'dy':0.0},{'r':0,'s':1,'dx':6.0,'dy':0.0},{'r':0,'s':2,'dx':0.0,'dy':3.0}]
              else [{'r':0,'s':0,'dx':0.0,'dy':0.0},{'r':0,'s':1,'dx':4.0,'dy':0.0},{'r':0,'s':2,'dx':4.0,'dy':4.0},{'r':0,'s':3,'dx':0.0,'dy':4.0}] end as pts
  from z),
v as (select zone_id, p.r as ring, p.s as seq, cx + p.dx as x, cy + p.dy as y from (select zone_id, cx, cy, unnest(pts) as p from shape) u),
e as (select zone_id, x, y,
             coalesce(lead(x) over (partition by zone_id, ring order by seq), first_value(x) over (partition by zone_id, ring order by seq)) as x2,
             coalesce(lead(y) over (partition by zone_id, ring order by seq), first_value(y) over (partition by zone_id, ring order by seq)) as y2
      from v),
a as (select zone_id, sum(x * y2 - x2 * y) / 2 as area, sum((x + x2) * (x * y2 - x2 * y)) as cxs,
             sum((y + y2) * (x * y2 - x2 * y)) as cys from e group by zone_id)
select cast(zone_id as bigint) as zone_id, """ + r6("area") + " as area, " + r6("cxs / (6 * area)") + " as longitude, " + \
    r6("cys / (6 * area)") + " as latitude from a"

ORACLE["data_freshness"] = chain_upto("clean") + f"""
select strftime(max(pickup_datetime), '%Y-%m-%d %H:%M:%S') as latest_pickup,
       {r6(f"date_diff('second', max(pickup_datetime), timestamp '1998-12-01 00:00:00') / 3600.0::double")} as lag_hours,
       date_diff('second', max(pickup_datetime), timestamp '1998-12-01 00:00:00') / 3600.0::double < {C.TARGET_FRESHNESS_HOURS} as fresh
from clean"""


_R3T = "printf('%.3f', floor(({x}) * cast(1000 as double) + cast(0.5 as double)) / cast(1000 as double))"
_STAB_BODY = ORACLE["stability"][:ORACLE["stability"].rindex("\nselect ")].replace("with recursive ", "with recursive\n", 1)
ORACLE["scorecard"] = f"""with kst as materialized ({_STAB_BODY}
select avg(ari) as ari_mean, min(ari) as ari_min from ari),
qual as materialized ({ORACLE["cluster_quality"]})
select 1 as ord, 'Silhouette' as metric, '> 0.50' as target, {_R3T.format(x='value')} as observed, value > {C.TARGET_SILHOUETTE} as pass from qual where metric = 'silhouette'
union all select 2, 'Davies–Bouldin', '< 1.00', {_R3T.format(x='value')}, value < 1.0 from qual where metric = 'davies_bouldin'
union all select 3, 'Calinski–Harabasz', 'higher better', format('{{:,.0f}}', floor(value + 0.5)), cast(null as boolean) from qual where metric = 'calinski_harabasz'
union all select 4, 'ARI seed stability (min)', '≥ 0.80', {_R3T.format(x='ari_min')}, ari_min >= 0.8 from kst
union all select 5, 'ARI seed stability (mean)', '≥ 0.90', {_R3T.format(x='ari_mean')}, ari_mean >= 0.9 from kst
union all select 6, 'Stability gate', 'PASS', case when ari_min >= {C.STABILITY_ARI_MIN} then 'PASS' else 'FAIL' end, ari_min >= {C.STABILITY_ARI_MIN} from kst"""

ORACLE["load_centroids"] = chain_upto("cells") + f"""
select cast(zone_id as bigint) as zone_id, {r6('40.5::double + zone_id * 0.002::double')} as latitude,
       {r6('-74.25::double + ((zone_id * 37) % 263) * 0.002::double')} as longitude
from (select distinct zone_id from cells) z where zone_id % 50 <> 0"""

ORACLE["hist_deviation_raw"] = chain_upto("cells") + hist_sql("cells", "speed_deviation", 70)
ORACLE["deviation_stats"] = chain_upto("cells") + f"""
select {r6('min(speed_deviation)')} as dev_min, {r6('max(speed_deviation)')} as dev_max,
       {r6('avg(speed_deviation)')} as dev_mean, {r6('stddev_samp(speed_deviation)')} as dev_std from cells"""
