"""Scalar feature expressions (C6, D1-D5): all JVM-side Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed threshold sets of the app features (right-closed bins).
EVALUATE_THRESHOLDS = [10, 100, 1000]
COUNT_THRESHOLDS = [1000, 10000, 100000]       # download, stars, install
APPSIZE_THRESHOLDS = [10240, 102400, 102400, 1024000]
APP_BIN_THRESHOLDS = {
    "fevaluate_count": EVALUATE_THRESHOLDS,
    "fdownload_count": COUNT_THRESHOLDS,
    "fstars": COUNT_THRESHOLDS,
    "finstall_count": COUNT_THRESHOLDS,
    "appsize": APPSIZE_THRESHOLDS,
}

# Fixed event labels.
EVENT_EXPOSE = "AD_MQ_EVENT_CPD_EXPOSE"
EVENT_DETAIL = "AD_MQ_EVENT_CPD_DETAIL"
EVENT_INSTALL = "AD_MQ_EVENT_CPD_INSTALL"

STRINGABLE = (T.StringType, T.IntegerType, T.LongType, T.BooleanType, T.DoubleType)


def to_string(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast columns to string (C6); string, int, bigint, boolean, double only.

    Spark's casts render doubles as Java does (``10.0``, ``1.0E10``).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in cols:
        if not isinstance(types[c], STRINGABLE):
            raise TypeError(f"column {c!r} has unsupported type {types[c].simpleString()}")
    return df.withColumns({c: F.col(c).cast("string") for c in cols
                           if not isinstance(types[c], T.StringType)})


def bin_right_closed(col: Column | str, thresholds: Sequence[float]) -> Column:
    """Index of the first threshold >= value, else len(thresholds).

    Intervals are (-inf, r0] -> 0, (r0, r1] -> 1, ...; NaN -> 0, NULL -> NULL,
    text that is no number -> NULL (``try_cast``).
    """
    c = F.col(col) if isinstance(col, str) else col
    w = c.try_cast("double")
    out = F.when(w.isNull(), F.lit(None)).when(F.isnan(w), F.lit(0.0))
    for i, r in enumerate(thresholds):
        out = out.when(w <= F.lit(float(r)), F.lit(float(i)))
    return out.otherwise(F.lit(float(len(thresholds)))).cast("double")


def event_label(col: Column | str) -> Column:
    """EXPOSE -> 0, DETAIL / INSTALL -> 1, anything else (NULL too) -> -1 (D3)."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c == F.lit(EVENT_EXPOSE), F.lit(0.0))
            .when(c.isin(EVENT_DETAIL, EVENT_INSTALL), F.lit(1.0))
            .otherwise(F.lit(-1.0)))


MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000
EPOCH_WEEKDAY = 5      # 1970-01-01 was a Thursday (Sunday = 1)


def _ms(ms: Column | str) -> Column:
    return F.col(ms) if isinstance(ms, str) else ms


def epoch_ms(ts_ntz: Column | str) -> Column:
    """Wall-clock timestamp (timestamp_ntz) -> epoch ms, read as UTC.

    Independent of the session time zone."""
    c = F.col(ts_ntz) if isinstance(ts_ntz, str) else ts_ntz
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def local_time(ms: Column | str, zone: Column | str) -> Column:
    """Epoch ms -> wall-clock timestamp (timestamp_ntz) in a zone, daylight-saving steps included.

    ``zone`` is a zone's name or a column of names. Independent of the session time zone.
    """
    instant = F.timestamp_add("MILLISECOND", _ms(ms).cast("bigint"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone) if isinstance(zone, str) else zone, instant)


def utc_hour(ms: Column | str) -> Column:
    return F.pmod(F.floor(_ms(ms) / F.lit(MS_PER_HOUR)), F.lit(24))


def day_of_week(ms: Column | str, zone: Column | str | None = None) -> Column:
    """Epoch ms -> day of week in a zone (None: UTC), Sunday = 1 ... Saturday = 7.

    UTC is pure arithmetic on the epoch day, so the session time zone does not matter."""
    if zone is not None:
        return F.dayofweek(local_time(ms, zone)).cast("double")
    day = F.floor(_ms(ms) / F.lit(MS_PER_DAY))
    return (F.pmod(day + F.lit(EPOCH_WEEKDAY - 1), F.lit(7)) + F.lit(1)).cast("double")


def hour_band(ms: Column | str, zone: Column | str | None = None) -> Column:
    """Epoch ms -> hour in a zone (None: UTC) 2-7 -> 0, 8-13 -> 1, 14-19 -> 2, 20-23 and 0-1 -> 3."""
    hour = utc_hour(ms) if zone is None else F.hour(local_time(ms, zone))
    return F.floor(((hour + F.lit(22)) % F.lit(24)) / F.lit(6)).cast("double")
