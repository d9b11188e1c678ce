"""Daily app snapshot.

Three sources, each a one-day (or whole-history) scan: advertised app ids,
app attributes, app versions. The snapshot is ``ads ⋈ versions`` using
``appid`` (and any extra keys such as ``stat_date`` when several days are
merged at once) then ``⋈ apps`` on ``appid = fid``; both inner joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import day, day_columns, distinct_ids, max_by_key

# Fixed attribute columns of the app table.
APP_COLUMNS = ["fid", "fname", "fcategoryid", "fcategory2id", "fstatus",
               "fevaluate_count", "fdownload_count", "fstars", "finstall_count"]
MERGE_TYPES = ("int", "bigint", "string")


def _maybe_day(df: DataFrame, dt: int | None) -> DataFrame:
    return df if dt is None else day(df, dt)


def advertised_apps(ads: DataFrame, dt: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """``select distinct fappid as appid`` for the day (A2)."""
    src = _maybe_day(ads, dt)
    if keys:
        return src.select(F.col("fappid").alias("appid"), *keys).distinct()
    return distinct_ids(src, "fappid", "appid")


def app_attributes(apps: DataFrame, dt: int | None = None) -> DataFrame:
    return apps.select(*APP_COLUMNS) if dt is None else day_columns(apps, dt, APP_COLUMNS)


def app_versions(versions: DataFrame, dt: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """``select fappid as appid, max(fsize) as appsize group by fappid`` (A5)."""
    src = _maybe_day(versions, dt)
    if keys:
        return src.groupBy(F.col("fappid").alias("appid"), *keys).agg(F.max("fsize").alias("appsize"))
    return max_by_key(src, "fappid", "fsize", "appid", "appsize")


def merge_apps(ads: DataFrame, apps: DataFrame, versions: DataFrame,
               keys: Sequence[str] = ()) -> DataFrame:
    """``appid, fname, ..., finstall_count, appsize`` (plus ``keys``)."""
    keys = list(keys)
    # The narrow sides first: a sort for their join holds no attributes.
    joined = ads.join(versions, ["appid", *keys]).join(apps, F.col("appid") == F.col("fid"))
    cols = [*keys, "appid", *[c for c in APP_COLUMNS if c != "fid"], "appsize"]
    out = joined.select(*cols)
    for f in out.schema.fields:
        if f.name not in keys and f.dataType.simpleString() not in MERGE_TYPES:
            raise TypeError(f"snapshot column {f.name!r} has type {f.dataType.simpleString()}; "
                            f"expected one of {MERGE_TYPES}")
    return out
