"""Column expressions (JVM-side built-ins only; no Python UDFs).

Every function returns a ``Column`` so callers can stack them inside one
projection, which keeps the whole chain in a single codegen stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonepace import config as C


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN → null, so comparisons and averages skip it as pandas does."""
    x = col(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def to_double(c: str | Column) -> Column:
    """Numeric coercion with bad text / NaN → null (ANSI-safe)."""
    x = col(c)
    return nan_to_null(x.try_cast("double"))


def to_whole(c: str | Column, to_type: str) -> Column:
    """Integer coercion; fractional or unparsable values become null."""
    d = to_double(c)
    return F.when(d == F.floor(d), d.try_cast(to_type))


def to_timestamp_ntz(c: str | Column) -> Column:
    return col(c).try_cast("timestamp_ntz")


def duration_seconds(pickup: str | Column = "pickup_datetime", dropoff: str | Column = "dropoff_datetime") -> Column:
    """Fractional seconds between two naive timestamps.

    The difference of two TIMESTAMP_NTZ values is a zone-free day-time
    interval; its fields are summed to seconds.  (``timestampdiff`` resolves
    naive values through the session zone and gains or loses an hour across
    a daylight-saving change.)
    """
    iv = col(dropoff) - col(pickup)
    secs = (F.extract(F.lit("DAY"), iv) * 86400 + F.extract(F.lit("HOUR"), iv) * 3600
            + F.extract(F.lit("MINUTE"), iv) * 60 + F.extract(F.lit("SECOND"), iv))
    return secs.cast("double")


def speed_mph(distance: str | Column = "trip_distance",
              duration: str | Column = "trip_duration") -> Column:
    """Miles per hour; zero or null duration gives null."""
    hours = col(duration) / F.lit(3600.0)
    return F.try_divide(col(distance), F.when(hours != 0, hours))


def hour_of_day(ts: str | Column = "pickup_datetime") -> Column:
    return F.hour(col(ts))


def day_of_week(ts: str | Column = "pickup_datetime") -> Column:
    """0 = Monday … 6 = Sunday."""
    return F.weekday(col(ts))


def is_weekend(dow: str | Column = "day_of_week") -> Column:
    return col(dow) >= 5


def year_month(ts: str | Column = "pickup_datetime") -> Column:
    """``YYYY-MM`` from the date parts (``date_format`` would pass naive values
    through the session zone and move times inside a daylight-saving gap)."""
    x = col(ts)
    return F.format_string("%04d-%02d", F.year(x), F.month(x))


def timestamp_text(ts: str | Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` of a naive timestamp, zone-free."""
    return F.substring(col(ts).cast("string"), 1, 19)


def valid_year_month(ym: str | Column) -> Column:
    """True when the text is a real ``YYYY-MM`` period."""
    x = col(ym)
    return F.coalesce(
        x.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), F.lit(False)
    )


def hour_sin(h: str | Column = "hour_of_day") -> Column:
    return F.sin(F.lit(2.0 * math.pi) * col(h).cast("double") / F.lit(24.0))


def hour_cos(h: str | Column = "hour_of_day") -> Column:
    return F.cos(F.lit(2.0 * math.pi) * col(h).cast("double") / F.lit(24.0))


def log_density(d: str | Column = "trip_density") -> Column:
    return F.log1p(col(d).cast("double"))


def is_airport(z: str | Column = "zone_id") -> Column:
    return col(z).isin(C.AIRPORT_ZONES)


def is_cbd(z: str | Column = "zone_id") -> Column:
    return col(z).isin(C.CBD_ZONES)


def is_rush_hour(h: str | Column = "hour_of_day") -> Column:
    return col(h).isin(C.RUSH_HOUR_MORNING + C.RUSH_HOUR_EVENING)


def circular_hour_distance(h: str | Column = "hour_of_day", ref: int = 23) -> Column:
    """min(|h−ref|, 24−|h−ref|)."""
    d = F.abs(col(h) - F.lit(ref))
    return F.least(d, F.lit(24) - d)


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    x = col(c)
    if lo is not None:
        x = F.greatest(x, F.lit(lo))
    if hi is not None:
        x = F.least(x, F.lit(hi))
    return x


def level_label(level: str | Column = "congestion_level") -> Column:
    """Level → name; unknown → ``L{n}`` (P10)."""
    lv = col(level)
    m = F.create_map(*[x for k, v in C.CONGESTION_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, lv), F.concat(F.lit("L"), lv.cast("string")))


def level_hex(level: str | Column = "congestion_level") -> Column:
    """Level → hex colour; unknown → the default grey (P10)."""
    lv = col(level)
    m = F.create_map(*[x for k, v in C.CONGESTION_HEX_COLORS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, lv), F.lit(C.DEFAULT_HEX))


def day_name_short(dow: str | Column = "day_of_week") -> Column:
    """0..6 → Mon..Sun; anything else → the number as text."""
    d = col(dow)
    names = F.array(*[F.lit(n) for n in C.DAY_NAMES_SHORT])
    return F.when((d >= 0) & (d < 7), F.element_at(names, (d + 1).cast("int"))).otherwise(d.cast("string"))


def hex_channel(hex_col: str | Column, i: int) -> Column:
    """Integer value of the i-th colour byte of ``#rrggbb`` (0=r,1=g,2=b)."""
    return F.conv(F.substring(col(hex_col), 2 + 2 * i, 2), 16, 10).cast("int")


# One unit of the order-free sums: 2^-30.
UNITS = 1 << 30


def exact_sum(c: Column) -> Column:
    """Aggregate: the sum in whole units of 2^-30, the same in any order of the rows (a decimal)."""
    return F.sum(F.floor(c * F.lit(float(UNITS)) + F.lit(0.5)).cast("decimal(20,0)"))


def exact_mean(c: Column) -> Column:
    """Aggregate: the mean of ``exact_sum``, off the true one by less than 2^-30."""
    return exact_sum(c).cast("double") / F.count(c) / F.lit(float(UNITS))
