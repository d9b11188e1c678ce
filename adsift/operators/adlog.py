"""Nested JSON ad logs to flat rows.

``flatten_ads`` turns each log into one row per ad: 17 device/session fields,
7 ad fields and 2 algorithm fields, all strings, missing values as "".
It is one narrow projection plus ``explode_outer``: no shuffle, and the log
text is parsed once per row.

Rules, in order: (1) text that does not parse to an object -> one all-empty
row; (2) ``event_content`` missing or not an object -> the same all-empty
row; (3) a missing or wrongly typed leaf -> "" for that leaf only; (4) ``ads``
missing, not an array or empty -> one row with empty ad fields; (5) ads are
taken up to the first element that is not an object.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import jsonfields as J
from ..session import scratch_dir

# Fixed field lists and output order of the flattened log.
DEVICE_STRING_FIELDS = ["device_model", "firmware", "imei", "ip", "net", "oper_type", "operator",
                        "product_type", "req_uri", "screen_size", "sn", "u_search_id",
                        "u_session_id", "version_name"]
DEVICE_LONG_FIELDS = ["oper_time", "uid", "version_code"]
AD_INT_FIELDS = ["display", "kw_type"]
AD_LONG_FIELDS = ["app_id", "kw_id", "unit_id"]
AD_STRING_FIELDS = ["kw", "request_id"]
ALGO_FIELDS = ["algorithm_version", "keyword"]
# The strict extract requires these device strings (no "operator").
STRICT_DEVICE_FIELDS = ["device_model", "firmware", "imei", "ip", "net", "oper_type",
                        "product_type", "req_uri", "screen_size", "sn",
                        "u_search_id", "u_session_id", "version_name"]

DEVICE_FIELDS = DEVICE_STRING_FIELDS + DEVICE_LONG_FIELDS
AD_FIELDS = AD_INT_FIELDS + AD_LONG_FIELDS + AD_STRING_FIELDS
FLAT_COLUMNS = DEVICE_FIELDS + AD_FIELDS + ALGO_FIELDS


ROOT_FIELDS = DEVICE_FIELDS + ["event_content"]
EVENT_FIELDS = ALGO_FIELDS + ["ads"]


def _ad_leaves(ad):
    """Typed ad leaves from an ad struct (``object_fields`` of an ad)."""
    out = {}
    for f in AD_INT_FIELDS:
        out[f] = J.integral_value(ad[f], "int")
    for f in AD_LONG_FIELDS:
        out[f] = J.integral_value(ad[f], "bigint")
    for f in AD_STRING_FIELDS:
        out[f] = J.string_value(ad[f])
    return out


def _parsed(df: DataFrame, text, keep: Sequence[str]) -> DataFrame:
    """Parse once, then read the log and its event_content with one struct
    cast each (``_r``, ``_e``: NULL when not an object) and the ads as
    structs (``_ads``: NULL elements where an ad is not an object).

    Each step is its own projection so the parsed VARIANT is computed once
    per row and not inlined into every field expression.
    """
    v = df.select(*keep, J.parse(text).alias("_v"))
    r = v.select(*keep, J.object_fields(F.col("_v"), ROOT_FIELDS).alias("_r"))
    e = r.select(*keep, "_r", J.object_fields(F.col("_r")["event_content"], EVENT_FIELDS).alias("_e"))
    arr = F.try_variant_get(F.col("_e")["ads"], "$", "array<variant>")
    return e.select(*keep, "_r", "_e",
                    F.transform(arr, lambda a: J.object_fields(a, AD_FIELDS)).alias("_ads"))


def flatten_ads(df: DataFrame, col: str = "vcontent", keep: Sequence[str] = ()) -> DataFrame:
    """One row per ad, 26 string columns (plus ``keep`` columns first)."""
    keep = list(keep)
    p = _parsed(df, F.col(col), keep)
    r, e, ads = F.col("_r"), F.col("_e"), F.col("_ads")
    fields = {}
    for f in DEVICE_STRING_FIELDS:
        fields[f] = J.string_value(r[f])
    for f in DEVICE_LONG_FIELDS:
        fields[f] = J.integral_value(r[f], "bigint")
    for f in ALGO_FIELDS:
        fields[f] = J.string_value(e[f])
    ok = r.isNotNull() & e.isNotNull()
    # Rules (1) and (2): a bad log keeps one all-empty row. Rule (5): ads up
    # to the first element that is not an object.
    stop = J.first_null_index(ads)
    prefix = F.when(stop > 0, F.slice(ads, F.lit(1), (stop - 1).cast("int"))).otherwise(ads)
    staged = p.select(*keep,
                      *[F.when(ok, J.text_or_empty(c)).otherwise(F.lit("")).alias(n) for n, c in fields.items()],
                      F.when(ok, prefix).alias("_pre"))
    exploded = staged.select(*keep, *fields.keys(), F.explode_outer("_pre").alias("_ad"))
    ad_cols = [J.text_or_empty(c).alias(name) for name, c in _ad_leaves(F.col("_ad")).items()]
    return exploded.select(*keep, *DEVICE_FIELDS, *ad_cols, *ALGO_FIELDS)


# Fixed reason codes of the quarantine.
NOT_JSON, NOT_OBJECT, MISSING, WRONG_TYPE = "not_json", "not_object", "missing", "wrong_type"
REASONS = (NOT_JSON, NOT_OBJECT, MISSING, WRONG_TYPE)


def _first_fault(strict: bool):
    """Struct (path, reason) of the first thing that a parsed log (``_v``, ``_r``, ``_e``) fails by, NULL if it is taken."""
    v, r, e = F.col("_v"), F.col("_r"), F.col("_e")

    def at(cond, path, reason):
        return F.when(cond, F.struct(F.lit(path).alias("path"), reason.alias("reason")))

    def text(x, path):
        return at(J.string_value(x).isNull(), path, F.when(J.missing(x), F.lit(MISSING)).otherwise(F.lit(WRONG_TYPE)))

    faults = [at(v.isNull(), "$", F.lit(NOT_JSON)), at(r.isNull(), "$", F.lit(NOT_OBJECT))]
    if strict:
        faults += [text(r[f], f"$.{f}") for f in STRICT_DEVICE_FIELDS]
    event = r["event_content"]
    faults.append(at(e.isNull(), "$.event_content", F.when(J.missing(event), F.lit(MISSING)).otherwise(F.lit(NOT_OBJECT))))
    if strict:
        faults += [text(e[f], f"$.event_content.{f}") for f in ALGO_FIELDS]
    return F.coalesce(*faults)


def quarantined(df: DataFrame, col: str = "vcontent", keep: Sequence[str] = (), strict: bool = False,
                tab_split: bool = False) -> tuple[DataFrame, DataFrame, Observation]:
    """One pass over the logs: (taken, rejected, counts).

    ``taken`` has the columns of ``df`` and holds the logs that ``flatten_ads``
    reads fields of (rules 1 and 2; ``strict``: those that ``strict_extract``
    gives a row for). ``rejected`` has ``keep``, the text, and the first JSON path
    that failed with a reason code. Every log is in one of them. ``counts``
    holds the number of taken and rejected logs, by reason, counted on the way.

    Both are written in the pass, as one table with each log's fault, so that
    neither parses the logs again to find its own. The text is written once, in
    its log, and rows are written as they come: a write by verdict sorts them.
    """
    text = first_field(col) if tab_split else F.col(col)
    # A projection for each step, so that nothing is parsed or cast again for each field.
    p = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("log"), J.parse(text).alias("_v"))
    p = p.select("log", "_v", J.object_fields(F.col("_v"), ROOT_FIELDS).alias("_r"))
    p = p.select("log", "_v", "_r", J.object_fields(F.col("_r")["event_content"], EVENT_FIELDS).alias("_e"))
    judged = p.select("log", _first_fault(strict).alias("fault"))
    counts = Observation()
    reason = F.col("fault.reason")
    judged = judged.observe(counts, F.count_if(reason.isNull()).alias("taken"), *[F.count_if(reason == r).alias(r) for r in REASONS])
    path = scratch_dir(df.sparkSession, f"tables/quarantine-{uuid.uuid4().hex}")
    judged.write.option("compression", "zstd").parquet(path)
    written = df.sparkSession.read.schema(judged.schema).parquet(path)
    bad = F.col("fault.reason").isNotNull()
    taken = written.where(~bad).select("log.*")
    text = first_field(f"log.{col}") if tab_split else F.col(f"log.{col}")
    rejected = written.where(bad).select(*[F.col(f"log.`{c}`") for c in keep], text.alias("text"), "fault.path", "fault.reason")
    return taken, rejected, counts


def first_field(line_col: str = "value", sep: str = "\t"):
    """The text before the first separator."""
    return F.split_part(F.col(line_col), F.lit(sep), F.lit(1))


def strict_extract(df: DataFrame, col: str = "value", keep: Sequence[str] = (),
                   tab_split: bool = True) -> DataFrame:
    """Strict extract (X7): lines lacking a required field are skipped.

    -> 13 device strings, 2 algorithm strings and ``n_ads``: the number of
    leading ads that are objects with every ad field present and typed.
    """
    keep = list(keep)
    text = first_field(col) if tab_split else F.col(col)
    p = _parsed(df, text, keep)
    r, e, ads = F.col("_r"), F.col("_e"), F.col("_ads")
    fields = {f: J.string_value(r[f]) for f in STRICT_DEVICE_FIELDS}
    fields.update({f: J.string_value(e[f]) for f in ALGO_FIELDS})

    def complete(ad):
        ok = ad.isNotNull()
        for c in _ad_leaves(ad).values():
            ok = ok & c.isNotNull()
        return ok

    # The place of the first incomplete ad, with one behind the last: read once, as each look at it reads all ads again.
    n_ads = F.coalesce(F.array_position(F.concat(F.transform(ads, complete), F.array(F.lit(False))), False) - 1, F.lit(0)).cast("int")
    rec = F.struct(*[F.col(k) for k in keep], *[c.alias(n) for n, c in fields.items()],
                   n_ads.alias("n_ads"), (r.isNotNull() & e.isNotNull()).alias("_ok"))

    def required(x):
        ok = x["_ok"]
        for n in fields:
            ok = ok & x[n].isNotNull()
        return ok

    # Zero or one row per line, as a generator: no Filter node exists that the
    # optimizer could push below the parse (which would re-parse per check).
    out = p.select(F.inline(F.filter(F.array(rec), required)))
    return out.drop("_ok")
