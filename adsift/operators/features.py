"""Training-feature tables.

Category codes (E1) are 0-based ranks of each column's distinct values in
ascending string order; NULL gets its own code, the number of non-null
values. The dictionary ``(feature, value, code)`` is built for all columns in
one distributed pass:

1. unpivot the category columns to (feature, value) and take distinct pairs
   (combined map-side, so a value held by a third of all rows is one row
   per task);
2. range-partition the pairs by (feature, value) and sort inside partitions;
   a row's rank inside its partition is its position there;
3. per (partition, feature) counts form a table of at most
   ``partitions + columns`` rows; a running sum over it gives each
   partition's offset, and that bounded table is broadcast back.

The distinct pairs are written once; the ranks, the counts and the NULL entries
all read that table. No value list passes through the driver and no window
holds a whole column. The dictionary is written as a table so later days can
be coded with it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.features import (APP_BIN_THRESHOLDS, bin_right_closed, day_of_week, event_label,
                                  hour_band, to_string)
from ..plans.strategy import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, ROW_OVERHEAD_BYTES, fits_broadcast, write_table
from .sampling import finished, sample

# Fixed column lists of the reference's feature tables.
PROFILE_COLUMNS = ["user_age", "sex", "user_job", "marriage_status", "mz_apps_car_owner", "user_network_type"]
APP_CATEGORY_COLUMNS = ["fcategoryid", "fcategory2id"]
APP_BIN_COLUMNS = ["fevaluate_count", "fdownload_count", "fstars", "finstall_count", "appsize"]
EVENT_TRACKER_TYPE = 2

Dictionary = DataFrame | Callable[[DataFrame, Sequence[str]], DataFrame] | None


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Different (feature, value) pairs of ``cols``, values as text; NULL is one."""
    return (to_string(df, cols).select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in cols])).alias("p"))
            .select("p.feature", "p.value")
            .distinct())


def _range_written(pairs: DataFrame, partitions: int) -> DataFrame:
    """The pairs written in order, with partition and row numbers.

    Written once, NULLs first in their partition: partition ids and row ids must
    be the same rows for the offsets and for the ranks.
    """
    return write_table(pairs.repartitionByRange(partitions, "feature", "value")
                       .sortWithinPartitions("feature", "value")
                       .withColumn("_pid", F.spark_partition_id())
                       .withColumn("_mid", F.monotonically_increasing_id()), "code_values")


def _ranked(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((feature, value, rank) of written values without NULLs, counts per partition and feature)."""
    parts = values.groupBy("_pid", "feature").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    run = Window.partitionBy("feature").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # At most partitions + columns rows: a bounded table, broadcast back.
    offsets = parts.withColumn("_start", F.coalesce(F.sum("_n").over(run), F.lit(0)))
    ranked = (values.join(F.broadcast(offsets.select("_pid", "feature", "_start", "_first")), ["_pid", "feature"])
              .select("feature", "value", (F.col("_start") + F.col("_mid") - F.col("_first")).alias("rank")))
    return ranked, parts


def ranked_values(pairs: DataFrame, partitions: int) -> DataFrame:
    """(feature, value, rank): ascending ranks from 0 of different (feature, value) pairs without NULLs."""
    return _ranked(_range_written(pairs, partitions))[0]


def fit_codes(df: DataFrame, cols: Sequence[str], partitions: int | None = None,
              checkpoint: bool = True) -> DataFrame:
    """Dictionary ``(feature string, value string, code double)`` for ``cols``."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    pairs = _range_written(distinct_values(df, cols), n)
    ranked, parts = _ranked(pairs.where(F.col("value").isNotNull()))
    coded = ranked.select("feature", "value", F.col("rank").cast("double").alias("code"))
    totals = parts.groupBy("feature").agg(F.sum("_n").alias("_total"))
    nulls = (pairs.where(F.col("value").isNull())
             .join(totals, "feature", "left")
             .select("feature", "value", F.coalesce(F.col("_total"), F.lit(0)).cast("double").alias("code")))
    dictionary = coded.unionByName(nulls)
    return write_table(dictionary, "code_dictionary") if checkpoint else dictionary


def apply_codes(df: DataFrame, dictionary: DataFrame, cols: Sequence[str],
                max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Replace each column by its code; NULL matches the NULL entry, a value the
    dictionary has not seen gets that entry's code, too, or the column's value
    count if there is none.

    One aggregate over the dictionary (one row per feature) gives each
    column's value count and its size, which decides the broadcast per column.
    """
    out = to_string(df, cols)
    stats = {r["feature"]: r for r in (
        dictionary.groupBy("feature")
        .agg(F.coalesce(F.max(F.when(F.col("value").isNull(), F.col("code"))), F.count("value").cast("double")).alias("extra"), F.count(F.lit(1)).alias("rows"),
             F.sum(F.coalesce(F.octet_length("value"), F.lit(0))).alias("bytes"))
        .collect())}
    for c in cols:
        st = stats.get(c)
        extra = float(st["extra"]) if st else 0.0
        d = (dictionary.where(F.col("feature") == F.lit(c))
             .select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}")))
        if st and st["rows"] <= max_rows and (st["bytes"] or 0) + ROW_OVERHEAD_BYTES * st["rows"] <= max_bytes:
            d = F.broadcast(d)
        out = (out.join(d, out[c].eqNullSafe(d[f"_v_{c}"]), "left")
               .withColumn(c, F.coalesce(F.col(f"_c_{c}"), F.lit(extra)))
               .drop(f"_v_{c}", f"_c_{c}"))
    return out


def multi_col_process(df: DataFrame, label: str, cols: Sequence[str] | None = None,
                      dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Code every column but the label; returns (coded frame, dictionary)."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c != label]
    d = dictionary if dictionary is not None else fit_codes(df, cols)
    return apply_codes(df, d, cols), d


def profile_features(profiles: DataFrame, cols: Sequence[str] = PROFILE_COLUMNS, key: str = "imei",
                     dictionary: Dictionary = None) -> DataFrame:
    """E5: every user profile, every column coded; ``dictionary`` as for ``app_features``."""
    rows = profiles.select(key, *cols)
    coded, _ = multi_col_process(rows, key, cols, dictionary(rows, cols) if callable(dictionary) else dictionary)
    return coded


def sampled_profile_features(profiles: DataFrame, rows: int, strata: Sequence[str] = (), cols: Sequence[str] = PROFILE_COLUMNS,
                             key: str = "imei", dictionary: Dictionary = None) -> DataFrame:
    """Coded features of a sample (``operators.sampling``), codes of all profiles, with ``sample_weight``."""
    slim = profiles.select(key, *cols)
    taken = finished(sample(slim, key, rows, strata), key, rows, strata)
    found = dictionary(slim, cols) if callable(dictionary) else fit_codes(slim, cols) if dictionary is None else dictionary
    return apply_codes(taken, found, cols)


def profile_sample(profiles: DataFrame, rows: int, key: str = "imei", cols: Sequence[str] = PROFILE_COLUMNS) -> DataFrame:
    """The first ``rows`` profiles in order of their key, not coded.

    For looking at a few profiles: a top-k report, no input of another operator.
    """
    return profiles.select(key, *cols).orderBy(key, *cols).limit(int(rows))


def app_features(apps: DataFrame, key: str = "appid", recode_bins: bool = True,
                 thresholds: dict[str, list[float]] | None = None, dictionary: Dictionary = None) -> DataFrame:
    """Right-closed bins on the count columns, then category codes.

    With ``recode_bins`` (the reference's behaviour) the bins are coded as
    categories too; otherwise they stay ordinal. The codes are those of
    ``dictionary``, of the one it makes from the rows to be coded and their
    columns, or (None) of one fitted on these rows.
    """
    th = thresholds or APP_BIN_THRESHOLDS
    # Written once: the dictionary fit and the coding both read it.
    binned = apps.select(key, *APP_CATEGORY_COLUMNS,
                         *[bin_right_closed(c, th[c]).alias(c) for c in APP_BIN_COLUMNS])
    binned = write_table(binned, "app_binned")
    cols = APP_CATEGORY_COLUMNS + (APP_BIN_COLUMNS if recode_bins else [])
    coded, _ = multi_col_process(binned, key, cols, dictionary(binned, cols) if callable(dictionary) else dictionary)
    return coded


def event_features(events: DataFrame, keep: Sequence[str] = (), zone: Column | str | None = None) -> DataFrame:
    """Tracker type 2 only; label, day of week and hour band in ``zone``
    (None: UTC); ``app_id`` renamed ``appid`` so the instance join resolves."""
    return (events.where(F.col("tracker_type") == F.lit(EVENT_TRACKER_TYPE))
            .select(*keep, "imei", F.col("app_id").alias("appid"),
                    event_label("oper_type").alias("oper_type"),
                    day_of_week("oper_time", zone).alias("day_of_week"),
                    hour_band("oper_time", zone).alias("hour_of_day")))


def instances_of_buckets(events: DataFrame, profiles: DataFrame, apps: DataFrame, label: str = "oper_type") -> DataFrame:
    """J7 on tables whose days are sorted buckets by ``imei`` (events, profiles): the events are not shuffled.

    Events and profiles are merged bucket by bucket. The apps are broadcast if
    their counted size is small; else the joined rows are shuffled by app.
    """
    small = fits_broadcast(apps)
    return instances(events, profiles.hint("merge"), F.broadcast(apps) if small else apps, label)


def instances(events: DataFrame, profiles: DataFrame, apps: DataFrame,
              label: str = "oper_type") -> DataFrame:
    """Events joined with profile (imei) and app (appid) features.

    Columns: label, profile features, app features, other event columns.
    Spark picks each join from the sizes its stages measure: a small feature
    table is broadcast and the event side stays in place; with shuffle joins
    AQE splits a device or app that holds a large share of the events.
    """
    p_cols = [c for c in profiles.columns if c != "imei"]
    a_cols = [c for c in apps.columns if c != "appid"]
    e_cols = [c for c in events.columns if c not in ("imei", "appid", label)]
    joined = events.join(profiles, "imei").join(apps, "appid")
    return joined.select(label, *p_cols, *a_cols, *e_cols)


def assemble(df: DataFrame, label: str, cols: Sequence[str] | None = None,
             output: str = "features") -> DataFrame:
    """All non-label columns into one vector; keeps (label, features)."""
    from pyspark.ml.feature import VectorAssembler

    cols = list(cols) if cols is not None else [c for c in df.columns if c != label]
    return VectorAssembler(inputCols=cols, outputCol=output).transform(df).select(label, output)


def one_hot(df: DataFrame, cols: Sequence[str], suffix: str = "_vec") -> DataFrame:
    """One-hot vectors of category codes, one slot per category."""
    from pyspark.ml.feature import OneHotEncoder

    enc = OneHotEncoder(inputCols=list(cols), outputCols=[c + suffix for c in cols], dropLast=False)
    return enc.fit(df).transform(df)
