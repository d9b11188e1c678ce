"""The batch jobs of the reference as functions and a command line.

    python -m adsift.jobs match <mode> <sdate> <edate> <pdate> --bids T --searches T --out T [--bid-history T]
    python -m adsift.jobs bid-history <dt> --bids T --out T
    python -m adsift.jobs flatten <dt> --src T --out T
    python -m adsift.jobs app-merge <dt> --ads T --apps T --versions T --out T
    python -m adsift.jobs instances <dt> --profiles T --apps T --events T --out-prefix P [--codes-day D] [--buckets N]

Each job reads catalogue tables, builds one lazy plan and writes one day of
a ``stat_date``-partitioned table; re-running a day replaces it.
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .operators.adlog import flatten_ads
from .operators.codebook import CategoryCoder, load_codes
from .operators.features import app_features, event_features, instances, instances_of_buckets, profile_features
from .operators.matching import DEFAULT, MatchConfig, Sides, match
from .operators.merge import advertised_apps, app_attributes, app_versions, merge_apps
from .plans.strategy import write_table
from .session import get_session
from .sinks.daily import SNAPSHOT_TYPES, save_day, save_match
from .sources.history import history_words, update_history
from .sources.tables import DAY_COL, bid_words, day, search_words


LOG = logging.getLogger("adsift.jobs")


@dataclass(frozen=True)
class MatchInputs:
    """The written inputs of a match and their sizes, counted on the written tables."""
    bids: DataFrame
    searches: DataFrame
    sizes: dict[str, int]


def match_inputs(spark: SparkSession, sdate: int, edate: int, bid_table: str, search_table: str,
                 bid_history: str | None = None) -> MatchInputs:
    """Bid words of all history before ``edate``, from the state table ``bid_history`` if there is one; searches in [sdate, edate)."""
    bids = history_words(spark, bid_history, 0, edate) if bid_history else bid_words(spark.table(bid_table), 0, edate)
    bids = write_table(bids, "bid_words")
    searches = write_table(search_words(spark.table(search_table), sdate, edate), "search_words")
    return MatchInputs(bids, searches, {"bid_words": bids.count(), "search_words": searches.count()})


def match_job(spark: SparkSession, mode: str, sdate: int, edate: int, pdate: int,
              bid_table: str, search_table: str, out_table: str, cfg: MatchConfig = DEFAULT,
              inputs: MatchInputs | None = None, sides: Sides | None = None, bid_history: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Save one mode's day; the result and the input sizes (bid words, search words).

    Several modes of one day can share ``inputs`` (``match_inputs``) and ``sides``
    (``matching.prepare`` of these), so that each side is read and written once.
    """
    found = inputs or match_inputs(spark, sdate, edate, bid_table, search_table, bid_history)
    LOG.info("match %s day %s: %s", mode, pdate, found.sizes)
    result = match(mode, found.bids, found.searches, cfg, sides)
    save_match(result, mode, out_table, pdate)
    return result, found.sizes


def bid_history_job(spark: SparkSession, bid_table: str, dt: int, history_table: str) -> None:
    """Merge one day's bid words into the state table that ``match`` reads them from."""
    update_history(spark, bid_words(day(spark.table(bid_table), dt)), history_table, dt)


def flatten_job(spark: SparkSession, src_table: str, dt: int, out_table: str) -> DataFrame:
    flat = flatten_ads(day(spark.table(src_table), dt))
    save_day(flat, out_table, dt, allowed=("string",))
    return flat


def app_merge_job(spark: SparkSession, ad_table: str, app_table: str, version_table: str,
                  dt: int, out_table: str) -> DataFrame:
    snap = merge_apps(advertised_apps(spark.table(ad_table), dt),
                      app_attributes(spark.table(app_table), dt),
                      app_versions(spark.table(version_table), dt))
    save_day(snap, out_table, dt, allowed=SNAPSHOT_TYPES)
    return snap


def instances_job(spark: SparkSession, profile_table: str, app_table: str, event_table: str,
                  dt: int, out_prefix: str, codes_day: int | None = None, buckets: int | None = None) -> DataFrame:
    """Save profile, app and event features for the day, then join the saved
    tables (read back, so nothing is recomputed or cached).

    Category codes are kept by day in ``<prefix>_profile_codes`` and
    ``<prefix>_app_codes``: the day adds its new values, or is scored with the
    dictionaries of ``codes_day`` as they are. With ``buckets``, events and
    profiles are saved in so many sorted buckets by device and joined in place.
    """
    by = ("imei", buckets) if buckets else None
    def codes(name: str):
        table = f"{out_prefix}_{name}_codes"
        if codes_day is not None:
            return load_codes(spark, table, codes_day)
        return lambda rows, cols: CategoryCoder(inputCols=list(cols), table=table, day=dt).fit(rows).dictionary(spark)

    tables = {k: f"{out_prefix}_{k}" for k in ("profile", "app", "event", "instances")}
    save_day(profile_features(spark.table(profile_table), dictionary=codes("profile")), tables["profile"], dt, bucket=by)
    save_day(app_features(day(spark.table(app_table), dt), dictionary=codes("app")), tables["app"], dt)
    save_day(event_features(day(spark.table(event_table), dt)), tables["event"], dt, bucket=by)
    saved = {k: day(spark.table(t), dt).drop(DAY_COL) for k, t in tables.items() if k != "instances"}
    inst = (instances_of_buckets if buckets else instances)(saved["event"], saved["profile"], saved["app"])
    save_day(inst, tables["instances"], dt)
    return inst


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="adsift.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    m = sub.add_parser("match")
    m.add_argument("mode")
    m.add_argument("sdate", type=int)
    m.add_argument("edate", type=int)
    m.add_argument("pdate", type=int)
    m.add_argument("--bids", required=True)
    m.add_argument("--searches", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--bid-history")
    h = sub.add_parser("bid-history")
    h.add_argument("dt", type=int)
    h.add_argument("--bids", required=True)
    h.add_argument("--out", required=True)
    f = sub.add_parser("flatten")
    f.add_argument("dt", type=int)
    f.add_argument("--src", required=True)
    f.add_argument("--out", required=True)
    a = sub.add_parser("app-merge")
    a.add_argument("dt", type=int)
    a.add_argument("--ads", required=True)
    a.add_argument("--apps", required=True)
    a.add_argument("--versions", required=True)
    a.add_argument("--out", required=True)
    i = sub.add_parser("instances")
    i.add_argument("dt", type=int)
    i.add_argument("--profiles", required=True)
    i.add_argument("--apps", required=True)
    i.add_argument("--events", required=True)
    i.add_argument("--out-prefix", required=True)
    i.add_argument("--codes-day", type=int)
    i.add_argument("--buckets", type=int)
    args = ap.parse_args(argv)
    spark = get_session(app_name=f"adsift-{args.job}")
    if args.job == "match":
        match_job(spark, args.mode, args.sdate, args.edate, args.pdate, args.bids, args.searches, args.out, bid_history=args.bid_history)
    elif args.job == "bid-history":
        bid_history_job(spark, args.bids, args.dt, args.out)
    elif args.job == "flatten":
        flatten_job(spark, args.src, args.dt, args.out)
    elif args.job == "app-merge":
        app_merge_job(spark, args.ads, args.apps, args.versions, args.dt, args.out)
    else:
        instances_job(spark, args.profiles, args.apps, args.events, args.dt, args.out_prefix, args.codes_day, args.buckets)


if __name__ == "__main__":
    main()
