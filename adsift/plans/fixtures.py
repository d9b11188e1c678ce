"""Input tables of the reference's jobs, derived by Spark from the driver's
TPC-H-like tables. Each grows with the tables it is built from.

* ``search_log``: one search per line item, its words those of the part: name,
  type, a group token that three parts share and a token of the part alone.
  So the number of different searches grows with the parts. The day is the
  first of the ship date's month.
* ``bid_table``: one bid keyword per part, of a shape that its size picks, one
  for each match rule: two tokens as searches hold them, a cut one (substring,
  not token), swapped tokens, one extra token. A bid meets a few searches.
* ``han_search_log`` and ``han_bid_table``: the same idea in Han characters.
* ``byte_lines``: lines of files, some written in GBK.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import epoch_ms
from ..session import scratch_dir
from ..sources.tables import DAY_COL, day_number, read_parquet


def spread(scan: DataFrame) -> DataFrame:
    """The driver's small files have one split each: spread such a scan over the cores before heavy narrow work."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def month_start(ts: Column) -> Column:
    """The first of the month as a day number."""
    return day_number(F.trunc(ts, "month"))


def by_day(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table partitioned by its day, one file a day, and read back."""
    path = scratch_dir(df.sparkSession, f"tables/{name}-{uuid.uuid4().hex}")
    df.repartition(DAY_COL).write.partitionBy(DAY_COL).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(keyword string, stat_date bigint)"""
    li = spread(read_parquet(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber", "l_shipdate"))
    part = read_parquet(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    group, own = F.expr(_GROUP), F.expr(_OWN)
    keyword = (F.when(F.col("l_linenumber") == 1, F.concat_ws(" ", "p_name", group, own))
               .when(F.col("l_linenumber") == 2, F.concat_ws(" ", group, own))
               .otherwise(F.concat_ws(" ", "p_name", F.lower("p_type"), group, own)))
    return (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(keyword.alias("keyword"), month_start(F.col("l_shipdate")).alias("stat_date")))


def bid_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fkey_words string, stat_date bigint): all of one day before the searches."""
    part = read_parquet(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    word = F.expr(BID_SQL)
    return part.select(word.alias("fkey_words"), F.lit(BID_DAY).cast("bigint").alias("stat_date"))


BID_DAY = 19900101
# The same text in Spark and in DuckDB, up to the integer division.
_GROUP, _OWN = "concat('z', lpad(cast(p_partkey div 3 as string), 9, '0'))", "concat('m', lpad(cast(p_partkey as string), 9, '0'))"
BID_SQL = f"""case p_size % 4 when 0 then concat({_GROUP}, ' ', {_OWN})
  when 1 then left(concat(split_part(p_name, ' ', 2), ' ', {_GROUP}, ' ', {_OWN}), length(p_name) - length(split_part(p_name, ' ', 1)) + 19)
  when 2 then concat({_OWN}, ' ', {_GROUP})
  else concat({_GROUP}, ' ', {_OWN}, ' deluxe') end"""


def han(code: Column) -> Column:
    """A character of the main Han block by its number."""
    return F.decode(F.unhex(F.lpad(F.hex(F.lit(0x4E00) + F.pmod(code, F.lit(20000))), 4, "0")), "UTF-16BE")


def han_search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(keyword string): Han texts without spaces, with a model number in Latin letters."""
    li = spread(read_parquet(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber"))
    k = F.col("l_partkey")
    return li.select(F.concat(han(k), han(k * 7 + 3), han(F.col("l_linenumber").cast("bigint") + 9), F.lit("v"), k.cast("string")).alias("keyword"))


def han_bid_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fkey_words string): two Han characters of a part, swapped for every second part."""
    k = F.col("p_partkey")
    a, b = han(k), han(k * 7 + 3)
    word = F.when(k % 2 == 0, F.concat(b, a)).when(k % 3 == 0, F.concat(a, b, han(k + 1))).otherwise(F.concat(a, b))
    return read_parquet(spark, sf_dir, "part").select(word.alias("fkey_words"))


FILE_LINES = 64


def byte_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file string, value binary): customers as lines; the files of odd number are written in GBK."""
    c = read_parquet(spark, sf_dir, "customer").select("c_custkey", "c_name")
    n = F.floor(F.col("c_custkey") / FILE_LINES)
    line = F.concat("c_name", F.lit("\t"), han(F.col("c_custkey") % 500))
    return c.select(F.concat(F.lit("f"), n.cast("string")).alias("file"), F.when(n % 2 == 1, F.encode(line, "GBK")).otherwise(line.cast("binary")).alias("value"))


# --------------------------------------------------------------------------- oracle texts

def _duck(text: str) -> str:
    return text.replace("p_partkey div 3", "p_partkey // 3").replace("as string", "as varchar")


SEARCH_LOG_SQL = f"""
select case l_linenumber when 1 then concat(p_name, ' ', {_duck(_GROUP)}, ' ', {_duck(_OWN)})
            when 2 then concat({_duck(_GROUP)}, ' ', {_duck(_OWN)})
            else concat(p_name, ' ', lower(p_type), ' ', {_duck(_GROUP)}, ' ', {_duck(_OWN)}) end as keyword,
       cast(strftime(date_trunc('month', l_shipdate), '%Y%m%d') as bigint) as stat_date
from lineitem join part on l_partkey = p_partkey
"""

SEARCHES_SQL = f"""
select trim(keyword) as search_word, count(*) as cnt from ({SEARCH_LOG_SQL}) t
where trim(keyword) is not null group by trim(keyword)
"""

BIDS_SQL = f"""
select distinct trim(bw) as bid_word from (select {_duck(BID_SQL)} as bw from part) t where trim(bw) is not null
"""

HAN_SEARCHES_SQL = """
select chr(cast(19968 + l_partkey % 20000 as int)) || chr(cast(19968 + (l_partkey * 7 + 3) % 20000 as int))
       || chr(cast(19968 + l_linenumber + 9 as int)) || 'v' || l_partkey as search_word, count(*) as cnt
from lineitem group by 1
"""

HAN_BIDS_SQL = """
select distinct case when p_partkey % 2 = 0 then b || a when p_partkey % 3 = 0 then a || b || c else a || b end as bid_word
from (select p_partkey, chr(cast(19968 + p_partkey % 20000 as int)) as a, chr(cast(19968 + (p_partkey * 7 + 3) % 20000 as int)) as b,
             chr(cast(19968 + (p_partkey + 1) % 20000 as int)) as c from part) t
"""


# --------------------------------------------------------------------------- JSON ad log

# Fixed fault rules of the ad-log fixture, by order key (first rule applies):
# not JSON, no event_content, no ads key. Independent leaf faults: operator
# missing, sn missing, uid written as a numeric string, and a non-object
# element after the first two ads.
FAULT_NOT_JSON, FAULT_NO_EVENT, FAULT_NO_ADS = 97, 89, 5
LEAF_NO_OPERATOR, LEAF_NO_SN, LEAF_UID_TEXT, ADS_BREAK = 3, 7, 13, 11
ADS_BREAK_AFTER = 2


def adlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, stat_date, vcontent, line): one JSON log per order.

    ``line`` is ``vcontent`` TAB day, the text-file form of the log.
    """
    return with_line(adlog_rows(spark, sf_dir))


def with_line(logs: DataFrame) -> DataFrame:
    return logs.withColumn("line", F.concat(F.col("vcontent"), F.lit("\t"), F.col("stat_date").cast("string")))


def adlog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, stat_date, vcontent): the order is the device/session block, its line items are the ads.

    Both tables are dealt out by order before anything is rendered, so that no
    text is shuffled.
    """
    orders = read_parquet(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    li = read_parquet(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus").repartition("l_orderkey")
    ad = F.struct(
        F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_returnflag"),
        F.col("l_linestatus"),
        F.to_json(F.struct(
            (F.col("l_linenumber") % 2).cast("int").alias("display"),
            F.col("l_linenumber").cast("int").alias("kw_type"),
            F.col("l_partkey").alias("app_id"),
            F.col("l_suppkey").alias("kw_id"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("unit_id"),
            F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("kw"),
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
            .alias("request_id"))).alias("j"))
    # One group per order: at most a handful of line items each.
    ads = (li.groupBy("l_orderkey")
           .agg(F.array_sort(F.collect_list(ad)).alias("a"))
           .select(F.col("l_orderkey"), F.transform("a", lambda x: x["j"]).alias("ad_json")))
    k = F.col("o_orderkey")
    dev = F.to_json(F.struct(
        F.col("o_orderpriority").alias("device_model"),
        F.col("o_orderstatus").alias("firmware"),
        F.col("o_custkey").cast("string").alias("imei"),
        F.concat_ws(".", F.lit("10"), (F.col("o_custkey") % 256).cast("string"),
                    (k % 256).cast("string"), F.lit("1")).alias("ip"),
        F.lit("wifi").alias("net"),
        F.lit("FIND_ADS").alias("oper_type"),
        F.when(k % LEAF_NO_OPERATOR != 0, (F.col("o_custkey") % 100).cast("string")).alias("operator"),
        F.lit("KIND_A").alias("product_type"),
        F.lit("/v1/find").alias("req_uri"),
        F.lit("720x1280").alias("screen_size"),
        F.when(k % LEAF_NO_SN != 0, k.cast("string")).alias("sn"),
        F.concat(F.lit("S"), k.cast("string")).alias("u_search_id"),
        F.concat_ws("-", F.col("o_custkey").cast("string"), k.cast("string")).alias("u_session_id"),
        F.lit("2.0.1").alias("version_name"),
        epoch_ms("o_orderdate").alias("oper_time"),
        F.when(k % LEAF_UID_TEXT != 0, F.col("o_custkey")).alias("uid"),
        F.when(k % LEAF_UID_TEXT == 0, F.col("o_custkey").cast("string")).alias("uid_text"),
        (k % 1000).alias("version_code")))
    # uid as text for some logs: rename the helper key in the rendered text.
    dev = F.regexp_replace(dev, '"uid_text":', '"uid":')
    ad_items = F.coalesce(F.col("ad_json"), F.array().cast("array<string>"))
    ad_items = F.when(k % ADS_BREAK == 0,
                      F.concat(F.slice(ad_items, 1, ADS_BREAK_AFTER), F.array(F.lit("0")),
                               F.slice(ad_items, F.lit(ADS_BREAK_AFTER + 1), F.greatest(F.size(ad_items), F.lit(1))))).otherwise(ad_items)
    algo = F.to_json(F.struct(F.lit("alg-7").alias("algorithm_version"),
                              F.col("o_orderpriority").alias("keyword")))
    ec = (F.when(k % FAULT_NO_ADS != 0,
                 F.concat(F.lit('{"ads":['), F.array_join(ad_items, ","), F.lit("],"),
                          algo.substr(F.lit(2), F.length(algo))))
          .otherwise(algo))
    body = dev.substr(F.lit(1), F.length(dev) - 1)
    vcontent = (F.when(k % FAULT_NOT_JSON == 0, F.concat(F.lit("not json: "), k.cast("string")))
                .when(k % FAULT_NO_EVENT == 0, dev)
                .otherwise(F.concat(body, F.lit(',"event_content":'), ec, F.lit("}"))))
    day = month_start(F.col("o_orderdate"))
    return (orders.repartition("o_orderkey").join(ads, k == F.col("l_orderkey"), "left")
            .select(k.alias("o_orderkey"), day.alias("stat_date"), vcontent.alias("vcontent")))


# --------------------------------------------------------------------------- feature inputs

def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User profiles from customers: one column of each sink type, one with NULLs."""
    c = read_parquet(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("imei"),
        F.col("c_nationkey").alias("user_age"),
        F.col("c_mktsegment").alias("sex"),
        (F.col("c_custkey") % 7).alias("user_job"),
        (F.col("c_acctbal") > 5000).alias("marriage_status"),
        F.floor(F.col("c_acctbal") / 1000).cast("double").alias("mz_apps_car_owner"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("user_network_type"))


def ad_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertised apps by day: (fappid, stat_date) from line items."""
    li = read_parquet(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("fappid"), month_start(F.col("l_shipdate")).alias("stat_date"))


def app_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App attributes from parts (integer counts only)."""
    p = read_parquet(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("fid"),
        F.col("p_name").alias("fname"),
        F.col("p_brand").alias("fcategoryid"),
        F.col("p_type").alias("fcategory2id"),
        (F.col("p_size") % 2).alias("fstatus"),
        (F.col("p_size") * 20).alias("fevaluate_count"),
        (F.col("p_partkey") * 37).alias("fdownload_count"),
        (F.col("p_size") * 1000).alias("fstars"),
        ((F.col("p_partkey") % 50) * F.col("p_size") * 100).alias("finstall_count"))


def version_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App versions by day: (fappid, fsize, stat_date) from line items."""
    li = read_parquet(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("fappid"),
                     (F.col("l_quantity").cast("bigint") * 10240).alias("fsize"),
                     month_start(F.col("l_shipdate")).alias("stat_date"))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad event log from events: device, app, event name, epoch ms, tracker, day. Events reach all apps."""
    e = read_parquet(spark, sf_dir, "events")
    apps = read_parquet(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()
    name = (F.when(F.col("event_type") == "view", F.lit("AD_MQ_EVENT_CPD_EXPOSE"))
            .when(F.col("event_type") == "click", F.lit("AD_MQ_EVENT_CPD_DETAIL"))
            .when(F.col("event_type") == "purchase", F.lit("AD_MQ_EVENT_CPD_INSTALL"))
            .otherwise(F.col("event_type")))
    return e.select(
        F.col("user_id").cast("string").alias("imei"),
        (F.col("event_id") % apps).alias("app_id"),
        name.alias("oper_type"),
        epoch_ms("ts").alias("oper_time"),
        F.when(F.col("event_type") == "error", F.lit(1)).otherwise(F.lit(2)).alias("tracker_type"),
        day_number(F.col("ts")).alias("stat_date"))


PROFILE_SQL = """select cast(c_custkey as varchar) as imei, c_nationkey as user_age, c_mktsegment as sex,
       c_custkey % 7 as user_job, c_acctbal > 5000 as marriage_status,
       cast(floor(c_acctbal / 1000) as double) as mz_apps_car_owner,
       case when c_custkey % 11 <> 0 then c_mktsegment end as user_network_type
from customer"""

APP_SQL = """select p_partkey as fid, p_name as fname, p_brand as fcategoryid, p_type as fcategory2id,
       p_size % 2 as fstatus, p_size * 20 as fevaluate_count, p_partkey * 37 as fdownload_count,
       p_size * 1000 as fstars, (p_partkey % 50) * p_size * 100 as finstall_count
from part"""

EVENT_SQL = """select cast(user_id as varchar) as imei, event_id % (select count(*) from part) as app_id,
       case event_type when 'view' then 'AD_MQ_EVENT_CPD_EXPOSE' when 'click' then 'AD_MQ_EVENT_CPD_DETAIL'
            when 'purchase' then 'AD_MQ_EVENT_CPD_INSTALL' else event_type end as oper_type,
       ts, case when event_type = 'error' then 1 else 2 end as tracker_type,
       cast(strftime(ts, '%Y%m%d') as bigint) as stat_date
from events"""
