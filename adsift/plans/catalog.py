"""Registered queries over the driver's tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame. Queries that need
an intermediate table (both sides of a match, a dictionary, a day-partitioned
input, a saved day) run the jobs that write it when they are called; the rest
is lazy. Each oracle is ANSI SQL over the same tables; column names and types
agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as FF
from ..operators import adlog as A
from ..operators import features as FE
from ..operators import merge as MG
from ..operators import sampling as SM
from ..operators import matching as M
from ..operators import segment as SG
from ..session import configure
from ..sources import tables as S
from ..sources import text as TX
from . import fixtures as FX
from . import saved as SV
from . import strategy as W

Query = Callable[[SparkSession, str], DataFrame]

RANGE_FROM, RANGE_TO = 19950101, 19980101
DAY = 19970301          # the day of the one-day queries
MATCH = M.DEFAULT
HAN = M.MatchConfig(token_mode="cjk_char")


# --------------------------------------------------------------------------- inputs

def searches(spark: SparkSession, sf: str) -> DataFrame:
    return S.search_words(FX.search_log(spark, sf))


def bids(spark: SparkSession, sf: str) -> DataFrame:
    return S.bid_words(FX.bid_table(spark, sf))


def q_bid_words(spark, sf):
    return bids(spark, sf)


def q_search_words(spark, sf):
    return searches(spark, sf)


def q_date_range_scan(spark, sf):
    return S.search_words(FX.by_day(FX.search_log(spark, sf), "search-log"), RANGE_FROM, RANGE_TO)


def q_date_range_open(spark, sf):
    return S.search_words(FX.by_day(FX.search_log(spark, sf), "search-log"), RANGE_FROM, 0)


def q_exact_match(spark, sf):
    return M.exact_match(searches(spark, sf), bids(spark, sf))


def q_exact_include(spark, sf):
    return M.exact_include(searches(spark, sf), bids(spark, sf), MATCH)


def q_token_include(spark, sf):
    return M.token_include(searches(spark, sf), bids(spark, sf), MATCH)


def q_token_include_han(spark, sf):
    return M.token_include(S.search_words(FX.han_search_log(spark, sf)), S.bid_words(FX.han_bid_table(spark, sf)), HAN)


def q_lattice_words(spark, sf):
    """The dictionary that the search log teaches."""
    return SG.learn_words(S.search_words(FX.han_search_log(spark, sf)), M.SEARCH, "cnt").words


def q_token_include_lattice(spark, sf):
    """Token include on segmented words, the dictionary learned from the searches."""
    found = W.write_table(S.search_words(FX.han_search_log(spark, sf)), "han-searches")
    cfg = M.MatchConfig(token_mode="lattice", words=SG.learn_words(found, M.SEARCH, "cnt"))
    return M.token_include(found, S.bid_words(FX.han_bid_table(spark, sf)), cfg)


def q_segment_words(spark, sf):
    """Every search with the words of its cheapest path, in order of text."""
    found = W.write_table(S.search_words(FX.han_search_log(spark, sf)), "han-searches")
    told = SG.with_words(found, M.SEARCH, "words", SG.learn_words(found, M.SEARCH, "cnt"))
    return told.select(M.SEARCH, F.array_join(F.array_sort("words"), " ").alias("words"))


def q_core_include(spark, sf):
    return M.core_include(searches(spark, sf), bids(spark, sf), MATCH)


def q_word_pairs(spark, sf):
    return M.word_pairs(searches(spark, sf), bids(spark, sf), MATCH)


def q_word_pair_list(spark, sf):
    return M.word_pair_list(searches(spark, sf), bids(spark, sf), MATCH)


def q_coverage(spark, sf):
    return M.coverage(searches(spark, sf), bids(spark, sf), MATCH)


def q_bidlist_json(spark, sf):
    arrays = M.word_pair_arrays(searches(spark, sf), bids(spark, sf), MATCH)
    return arrays.select(M.SEARCH, M.bidlist_json(F.col("pairs")).alias("bidlist_json"))


def q_bidlist_first(spark, sf):
    """Path access into the rendered list: first word and tag (X8b). Only the first pair is rendered."""
    first = M.first_pairs(searches(spark, sf), bids(spark, sf), MATCH)
    pairs = F.when(F.col("first").isNotNull(), F.array("first")).otherwise(F.array().cast(f"array<{M.PAIR_TYPE}>"))
    j = M.bidlist_json(pairs)
    return first.select(
        M.SEARCH,
        F.get_json_object(j, "$.bidlist[0].word").alias("first_word"),
        F.get_json_object(j, "$.bidlist[0].tag").alias("first_tag"))


def q_bidlist_rows(spark, sf):
    return M.bidlist_rows(q_bidlist_json(spark, sf)).select(
        M.SEARCH, F.col("word"), F.col("tag"))


def q_charset_vote(spark, sf):
    return TX.decode_by_vote(FX.byte_lines(spark, sf))


# --------------------------------------------------------------------------- oracle texts

def _tok(x: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array({x}, '[ \\t\\n\\x0B\\f\\r]+'), lambda t: t <> ''))"


def _with(searches_sql: str = FX.SEARCHES_SQL, bids_sql: str = FX.BIDS_SQL, tok=_tok) -> str:
    """s, b; q and bb with tokens; p: (search_word, bid_word, n, k) of pairs with a common token or a bid without any."""
    return f"""with s as ({searches_sql}), b as ({bids_sql}),
q as (select search_word, {tok('search_word')} as qt from s),
bb as (select bid_word, {tok('bid_word')} as bt, len({tok('bid_word')}) as n from b),
qx as (select search_word, unnest(qt) as t from q),
bx as (select bid_word, unnest(bt) as t from bb),
kk as (select search_word, bid_word, count(*) as k from qx join bx using (t) group by all),
p as (select search_word, bid_word, n, k from kk join bb using (bid_word)
      union all select search_word, bid_word, 0, 0 from q, bb where n = 0)"""


def _han_tok(x: str) -> str:
    return f"list_distinct(regexp_extract_all({x}, '[\\x{{4E00}}-\\x{{9FFF}}]|[^\\x{{4E00}}-\\x{{9FFF}}]+'))"


_HAN_RUN, _OTHER_RUN = r"[\x{4E00}-\x{9FFF}]+", r"[^\x{4E00}-\x{9FFF}]+"

# wd: the dictionary (word, n, cost); it reads s.
_WORDS_SQL = f"""
lr as (select run, sum(cnt) as w from (select unnest(regexp_extract_all(search_word, '{_HAN_RUN}')) as run, cnt from s) t group by run),
li as (select run, w, unnest(range(1, length(run) + 1)) as i from lr),
lg as (select run, w, i, unnest(range(1, least({SG.LONGEST}, length(run) - i + 1) + 1)) as l from li),
lb as (select substr(run, i, l) as word, w, case when i > 1 then substr(run, i - 1, 1) end as lb,
              case when i + l <= length(run) then substr(run, i + l, 1) end as rb from lg),
lc as (select word, 'L' as side, lb as beside, sum(w) as c from lb group by all union all select word, 'R', rb, sum(w) from lb group by all),
lw as (select word, sum(c) filter (where side = 'L') as n,
              coalesce(sum(c * ln(c)) filter (where side = 'L' and beside is not null), 0) as hl,
              coalesce(sum(c * ln(c)) filter (where side = 'R' and beside is not null), 0) as hr from lc group by word),
wn as (select word, n from lw
       where length(word) = 1 or (n >= {SG.LEAST_COUNT} and ln(n) - greatest(hl, hr) / n >= {SG.LEAST_ENTROPY})),
wt as (select sum(n) as total from wn),
wd as materialized (select word, n, cast(round(ln(total / n) * {SG.COST_UNIT}) as bigint) as cost from wn, wt)"""

# tx: (text, words): the different words of the texts of s and b, runs segmented by the cheapest path.
_SEGMENTED_SQL = f"""
tt as (select search_word as text from s union select bid_word from b),
tr as (select text, unnest(list_distinct(regexp_extract_all(text, '{_HAN_RUN}'))) as run from tt),
rr as (select distinct run from tr),
ri as (select run, unnest(range(1, length(run) + 1)) as e from rr),
rl as (select run, e, unnest(range(1, least({SG.LONGEST}, e) + 1)) as l from ri),
re as materialized (
  select run, e, list({{'l': l, 'c': coalesce(cost, cast(round(ln(total / 0.5) * {SG.COST_UNIT}) as bigint))}}) as ways
  from rl left join wd on word = substr(run, e - l + 1, l), wt where l = 1 or cost is not null group by run, e),
bp as (
  select run, 0 as e, [{{'c': 0::bigint, 'p': []::varchar[]}}] as best from rr
  union all
  select bp.run, bp.e + 1, list_append(bp.best, list_sort(list_transform(ways, lambda x: {{
           'c': bp.best[bp.e + 2 - x.l].c + x.c, 'l': x.l, 'p': list_append(bp.best[bp.e + 2 - x.l].p, substr(bp.run, bp.e + 2 - x.l, x.l))}}))[1])
  from (select run, e, list_transform(best, lambda x: {{'c': x.c, 'l': 0::bigint, 'p': x.p}}) as best from bp) bp
  join re on re.run = bp.run and re.e = bp.e + 1),
rw as (select run, best[e + 1].p as words from bp where e = length(run)),
tw as (select text, unnest(words) as word from tr join rw using (run) union select text, unnest(regexp_extract_all(text, '{_OTHER_RUN}')) from tt),
tx as (select tt.text, coalesce(list(word) filter (where word is not null), []) as words from tt left join tw on tw.text = tt.text group by tt.text)"""

PAIRS_SQL = _with() + """,
tp as (
  select search_word, bid_word, n, 1 as tag from q join bb on search_word = bid_word
  union all select search_word, bid_word, n, 2 from q join bb on search_word <> bid_word and contains(search_word, bid_word)
  union all select search_word, bid_word, n, 3 from p where search_word <> bid_word and k = n
  union all select search_word, bid_word, n, 4 from p where search_word <> bid_word and k <> n and k > 0 and k = n - 1)
"""

ORACLES_MATCH = {
    "bid_words": FX.BIDS_SQL,
    "search_words": FX.SEARCHES_SQL,
    "date_range_scan": f"""
select trim(keyword) as search_word, count(*) as cnt from ({FX.SEARCH_LOG_SQL}) l
where stat_date >= {RANGE_FROM} and stat_date < {RANGE_TO} and trim(keyword) is not null
group by trim(keyword)""",
    "date_range_open": f"""
select trim(keyword) as search_word, count(*) as cnt from ({FX.SEARCH_LOG_SQL}) l
where stat_date >= {RANGE_FROM} and trim(keyword) is not null
group by trim(keyword)""",
    "exact_match": f"""
select search_word, cnt from ({FX.SEARCHES_SQL}) s
where search_word in (select bid_word from ({FX.BIDS_SQL}) b)""",
    "exact_include": f"""
select search_word, cnt from ({FX.SEARCHES_SQL}) s
where exists (select 1 from ({FX.BIDS_SQL}) b where contains(s.search_word, b.bid_word))""",
    "token_include": _with() + """
select search_word, cnt from s where search_word in (select search_word from p where k = n)""",
    "token_include_han": _with(FX.HAN_SEARCHES_SQL, FX.HAN_BIDS_SQL, _han_tok) + """
select search_word, cnt from s where search_word in (select search_word from p where k = n)""",
    "lattice_words": f"""with s as ({FX.HAN_SEARCHES_SQL}), {_WORDS_SQL}
select word, n::bigint as n, cost from wd""",
    "segment_words": f"""with recursive s as ({FX.HAN_SEARCHES_SQL}), b as (select '' as bid_word where false), {_WORDS_SQL}, {_SEGMENTED_SQL}
select search_word, array_to_string(list_sort(words), ' ') as words from s join tx on text = search_word""",
    "token_include_lattice": f"""with recursive s as ({FX.HAN_SEARCHES_SQL}), b as ({FX.HAN_BIDS_SQL}), {_WORDS_SQL}, {_SEGMENTED_SQL},
sx as (select distinct search_word, unnest(words) as word from s join tx on text = search_word),
bx as (select distinct bid_word, unnest(words) as word, len(words) as n from b join tx on text = bid_word),
hit as (select search_word, bid_word from sx join bx using (word) group by search_word, bid_word, n having count(*) = n)
select search_word, cnt from s where search_word in (select search_word from hit)""",
    "charset_vote": f"""
select 'f' || (c_custkey // {FX.FILE_LINES}) as file, c_name || chr(9) || chr(cast(19968 + c_custkey % 500 as int)) as value,
       case when (c_custkey // {FX.FILE_LINES}) % 2 = 1 then 'GBK' else 'UTF-8' end as charset
from customer""",
    "core_include": _with() + """
select search_word, cnt from s
where search_word in (select search_word from p where (n = 1 and k = 1) or (n > 1 and k >= n - 1))""",
    "word_pairs": PAIRS_SQL + "select search_word, bid_word, tag from tp",
    "word_pair_list": PAIRS_SQL + """
select q.search_word,
       coalesce(string_agg(tp.bid_word || ',' || cast(tp.tag as varchar), ' ' order by tp.bid_word, tp.tag), '')
         as bidlist
from q left join tp on q.search_word = tp.search_word
group by q.search_word""",
    "coverage": PAIRS_SQL + """,
f as (select search_word,
             bool_or(tag = 1) as m1, bool_or(tag in (1, 2)) as m2, bool_or(tag in (1, 3)) as m3,
             bool_or(tag in (1, 3, 4) and n > 0) as m4
      from tp group by search_word),
a as (select count(*) as tw, sum(cnt) as tc,
             count(*) filter (where coalesce(m1, false)) as w1, coalesce(sum(cnt) filter (where coalesce(m1, false)), 0) as c1,
             count(*) filter (where coalesce(m2, false)) as w2, coalesce(sum(cnt) filter (where coalesce(m2, false)), 0) as c2,
             count(*) filter (where coalesce(m3, false)) as w3, coalesce(sum(cnt) filter (where coalesce(m3, false)), 0) as c3,
             count(*) filter (where coalesce(m4, false)) as w4, coalesce(sum(cnt) filter (where coalesce(m4, false)), 0) as c4
      from s left join f using (search_word))
select mode, cast(w as bigint) as matched_words, cast(c as bigint) as matched_cnt,
       cast(tw as bigint) as total_words, cast(tc as bigint) as total_cnt, cast(c as double) / cast(tc as double) as pvr
from (select 'exact-match' as mode, w1 as w, c1 as c, tw, tc from a
      union all select 'exact-include', w2, c2, tw, tc from a
      union all select 'syno-include', w3, c3, tw, tc from a
      union all select 'core-include', w4, c4, tw, tc from a) u""",
    "bidlist_json": PAIRS_SQL + """
select q.search_word,
       coalesce('{"bidlist":[' || string_agg('{"word":' || cast(to_json(tp.bid_word) as varchar) || ',"tag":'
                || cast(tp.tag as varchar) || '}', ',' order by tp.bid_word, tp.tag) || ']}', '') as bidlist_json
from q left join tp on q.search_word = tp.search_word
group by q.search_word""",
    "bidlist_rows": PAIRS_SQL + "select search_word, bid_word as word, tag from tp",
    "bidlist_first": PAIRS_SQL + """,
r as (select search_word, bid_word, tag,
             row_number() over (partition by search_word order by bid_word, tag) as rn from tp)
select q.search_word, r.bid_word as first_word, cast(r.tag as varchar) as first_tag
from q left join r on q.search_word = r.search_word and r.rn = 1""",
}

QUERIES_MATCH: dict[str, Query] = {
    "bid_words": q_bid_words,
    "search_words": q_search_words,
    "date_range_scan": q_date_range_scan,
    "date_range_open": q_date_range_open,
    "exact_match": q_exact_match,
    "exact_include": q_exact_include,
    "token_include": q_token_include,
    "token_include_han": q_token_include_han,
    "lattice_words": q_lattice_words,
    "segment_words": q_segment_words,
    "token_include_lattice": q_token_include_lattice,
    "charset_vote": q_charset_vote,
    "core_include": q_core_include,
    "word_pairs": q_word_pairs,
    "word_pair_list": q_word_pair_list,
    "coverage": q_coverage,
    "bidlist_json": q_bidlist_json,
    "bidlist_rows": q_bidlist_rows,
    "bidlist_first": q_bidlist_first,
}


# --------------------------------------------------------------------------- JSON ad log

def q_json_flatten(spark, sf):
    return A.flatten_ads(FX.adlog(spark, sf)).select(*A.FLAT_COLUMNS)


def q_json_strict(spark, sf):
    return A.strict_extract(FX.adlog(spark, sf), "line")


_ADLOG_ORDERS = f"""o as (
  select *, case when o_orderkey % {FX.FAULT_NOT_JSON} = 0 or o_orderkey % {FX.FAULT_NO_EVENT} = 0 then 0
                 when o_orderkey % {FX.FAULT_NO_ADS} = 0 then 2 else 1 end as st
  from orders)"""


def _dev(expr: str, extra: str = "") -> str:
    return f"case when st = 0{extra} then '' else {expr} end"


_DEVICE_SQL = {
    "device_model": "o_orderpriority",
    "firmware": "o_orderstatus",
    "imei": "cast(o_custkey as varchar)",
    "ip": "'10.' || cast(o_custkey % 256 as varchar) || '.' || cast(o_orderkey % 256 as varchar) || '.1'",
    "net": "'wifi'",
    "oper_type": "'FIND_ADS'",
    "operator": "cast(o_custkey % 100 as varchar)",
    "product_type": "'KIND_A'",
    "req_uri": "'/v1/find'",
    "screen_size": "'720x1280'",
    "sn": "cast(o_orderkey as varchar)",
    "u_search_id": "'S' || cast(o_orderkey as varchar)",
    "u_session_id": "cast(o_custkey as varchar) || '-' || cast(o_orderkey as varchar)",
    "version_name": "'2.0.1'",
    "oper_time": "cast(epoch_ms(o_orderdate) as varchar)",
    "uid": "cast(o_custkey as varchar)",
    "version_code": "cast(o_orderkey % 1000 as varchar)",
    "algorithm_version": "'alg-7'",
    "keyword": "o_orderpriority",
}
_DEVICE_EXTRA = {"operator": f" or o_orderkey % {FX.LEAF_NO_OPERATOR} = 0",
                 "sn": f" or o_orderkey % {FX.LEAF_NO_SN} = 0"}
_AD_SQL = {
    "display": "cast(l_linenumber % 2 as varchar)",
    "kw_type": "cast(l_linenumber as varchar)",
    "app_id": "cast(l_partkey as varchar)",
    "kw_id": "cast(l_suppkey as varchar)",
    "unit_id": "cast(l_orderkey * 10 + l_linenumber as varchar)",
    "kw": "l_returnflag || l_linestatus",
    "request_id": "cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar)",
}


def _flatten_sql(day: int | None = None) -> str:
    cols = []
    for c in A.FLAT_COLUMNS:
        if c in _AD_SQL:
            cols.append(f"coalesce({_AD_SQL[c]}, '') as {c}")
        else:
            cols.append(_dev(_DEVICE_SQL[c], _DEVICE_EXTRA.get(c, "")) + f" as {c}")
    return f"""with {_ADLOG_ORDERS},
l as (select *, row_number() over (partition by l_orderkey
                                   order by l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) as rn
      from lineitem)
select {', '.join(cols)}
from o left join l on o.st = 1 and l.l_orderkey = o.o_orderkey
                  and (o.o_orderkey % {FX.ADS_BREAK} <> 0 or l.rn <= {FX.ADS_BREAK_AFTER})
{"" if day is None else f"where strftime(date_trunc('month', o_orderdate), '%Y%m%d') = '{day}'"}"""


def _strict_sql() -> str:
    cols = [f"{_DEVICE_SQL[c]} as {c}" for c in A.STRICT_DEVICE_FIELDS + A.ALGO_FIELDS]
    return f"""with {_ADLOG_ORDERS},
lc as (select l_orderkey, count(*) as c from lineitem group by l_orderkey)
select {', '.join(cols)},
       cast(case when st = 2 then 0
                 when o_orderkey % {FX.ADS_BREAK} = 0 then least(coalesce(c, 0), {FX.ADS_BREAK_AFTER})
                 else coalesce(c, 0) end as integer) as n_ads
from o left join lc on lc.l_orderkey = o.o_orderkey
where st <> 0 and o_orderkey % {FX.LEAF_NO_SN} <> 0"""


def q_flatten_day(spark, sf):
    """One day of a day-partitioned log."""
    logs = FX.by_day(FX.adlog(spark, sf).select("vcontent", "stat_date"), "ad-log")
    return A.flatten_ads(S.day(logs, DAY)).select(*A.FLAT_COLUMNS)


def _quarantined(logs, strict):
    col = "line" if strict else "vcontent"
    return A.quarantined(logs.select("o_orderkey", col), col, ("o_orderkey",), strict, tab_split=strict)


def q_quarantine(spark, sf):
    """Rejected logs of the strict extract with path and reason."""
    return _quarantined(FX.adlog(spark, sf), True)[1].select("o_orderkey", "path", "reason")


def q_quarantine_counts(spark, sf):
    """Logs by verdict, flatten and strict, as counted in the pass, and the flat rows of the logs that were taken."""
    logs, out = FX.with_line(W.write_table(FX.adlog_rows(spark, sf), "adlog")), []
    for rules, strict in (("flatten", False), ("strict", True)):
        taken, _, counts = _quarantined(logs, strict)
        rows = (A.strict_extract(taken, "line") if strict else A.flatten_ads(taken)).count()
        out += [(rules, verdict, n) for verdict, n in counts.get.items()] + [(rules, "rows", rows)]
    return spark.createDataFrame(out, "rules string, verdict string, n bigint")


_ZONES = ("Europe/Berlin", "America/New_York", "Australia/Lord_Howe")


def q_event_zones(spark, sf):
    """Weekday and hour band of orders in three zones, over years of daylight-saving steps."""
    orders = S.read_parquet(spark, sf, "orders")
    ms = FF.epoch_ms("o_orderdate") + (F.col("o_orderkey") * 7919 % 86400) * 1000
    zone = F.element_at(F.array(*map(F.lit, _ZONES)), (F.col("o_custkey") % 3 + 1).cast("int"))
    return orders.select("o_orderkey", ms.alias("ms"), zone.alias("zone")).select(
        "o_orderkey", "zone", FF.day_of_week("ms", F.col("zone")).alias("day_of_week"), FF.hour_band("ms", F.col("zone")).alias("hour_of_day"))


QUERIES_JSON: dict[str, Query] = {
    "quarantine": q_quarantine,
    "quarantine_counts": q_quarantine_counts,
    "event_zones": q_event_zones,
    "json_flatten": q_json_flatten,
    "flatten_day": q_flatten_day,
    "json_strict": q_json_strict,
}
_REASON_SQL = f"""select o_orderkey,
       case when o_orderkey % {FX.FAULT_NOT_JSON} = 0 then '$' when {{sn}} then '$.sn'
            when o_orderkey % {FX.FAULT_NO_EVENT} = 0 then '$.event_content' end as path,
       case when o_orderkey % {FX.FAULT_NOT_JSON} = 0 then 'not_json' when {{sn}} or o_orderkey % {FX.FAULT_NO_EVENT} = 0 then 'missing' end as reason
from orders"""
_NO_SN = f"o_orderkey % {FX.LEAF_NO_SN} = 0"

ORACLES_JSON = {
    "quarantine": f"select * from ({_REASON_SQL.format(sn=_NO_SN)}) t where reason is not null",
    "quarantine_counts": f"""with f as ({_REASON_SQL.format(sn='false')}), t as ({_REASON_SQL.format(sn=_NO_SN)}), v as (
  select 'flatten' as rules, reason from f union all select 'strict', reason from t)
select r.rules, c.verdict, (select count(*) from v where v.rules = r.rules and coalesce(reason, 'taken') = c.verdict) as n
from (values ('flatten'), ('strict')) r(rules), (values ('taken'), ('not_json'), ('not_object'), ('missing'), ('wrong_type')) c(verdict)
union all select 'strict', 'rows', count(*) from t where reason is null
union all select 'flatten', 'rows', sum(case when o_orderkey % {FX.FAULT_NO_ADS} = 0 then 1
                   when o_orderkey % {FX.ADS_BREAK} = 0 then greatest(least(coalesce(c, 0), {FX.ADS_BREAK_AFTER}), 1) else greatest(coalesce(c, 0), 1) end)::bigint
from f left join (select l_orderkey, count(*) as c from lineitem group by 1) l on l_orderkey = o_orderkey where reason is null""",
    "event_zones": f"""with z as (
  select o_orderkey, (['{"', '".join(_ZONES)}'])[o_custkey % 3 + 1] as zone, (o_orderdate + to_seconds(o_orderkey * 7919 % 86400)) at time zone 'UTC' as ts from orders
), w as (select o_orderkey, zone, timezone(zone, ts) as wall from z)
select o_orderkey, zone, cast(dayofweek(wall) + 1 as double) as day_of_week, cast(floor(((hour(wall) + 22) % 24) / 6) as double) as hour_of_day from w""",
    "json_flatten": _flatten_sql(),
    "flatten_day": _flatten_sql(DAY),
    "json_strict": _strict_sql(),
}


# --------------------------------------------------------------------------- features

def q_bins(spark, sf):
    li = S.read_parquet(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        FF.bin_right_closed("l_quantity", FF.EVALUATE_THRESHOLDS).alias("qty_bin"),
        FF.bin_right_closed("l_extendedprice", FF.COUNT_THRESHOLDS).alias("price_bin"),
        FF.bin_right_closed(F.col("l_quantity") * 10240, FF.APPSIZE_THRESHOLDS).alias("size_bin"))


def q_category_codes(spark, sf):
    return FE.fit_codes(FX.profile_table(spark, sf), FE.PROFILE_COLUMNS)


PROFILE_SAMPLE_ROWS = 10000
STRATUM_ROWS, STRATA = 100, ("sex",)


def q_profile_strata(spark, sf):
    """A stratified sample of all profiles, merged from the samples of two parts."""
    profiles = FX.profile_table(spark, sf).withColumn("weight", 1 + F.col("user_job"))
    parts = [profiles.where("user_job < 3"), profiles.where("user_job >= 3")]
    k = STRATUM_ROWS
    told = SM.merged([SM.sample(p, "imei", k, STRATA, "weight") for p in parts], "imei", k, STRATA)
    return SM.finished(told, "imei", k, STRATA, "weight")


def q_sampled_features(spark, sf):
    """Coded features of a sample, with the codes of all profiles."""
    return FE.sampled_profile_features(FX.profile_table(spark, sf), STRATUM_ROWS, STRATA)


def q_profile_sample(spark, sf):
    return FE.profile_sample(FX.profile_table(spark, sf), PROFILE_SAMPLE_ROWS)


def q_profile_features(spark, sf):
    return FE.profile_features(FX.profile_table(spark, sf))


def app_snapshot(spark, sf, keys=()):
    return MG.merge_apps(MG.advertised_apps(FX.ad_table(spark, sf), keys=keys),
                         MG.app_attributes(FX.app_table(spark, sf)),
                         MG.app_versions(FX.version_table(spark, sf), keys=keys), keys=keys)


def q_app_merge(spark, sf):
    return app_snapshot(spark, sf)


def q_app_merge_daily(spark, sf):
    return app_snapshot(spark, sf, keys=("stat_date",))


def q_app_merge_day(spark, sf):
    """One day of day-partitioned tables."""
    ads, versions = (FX.by_day(t, n) for t, n in ((FX.ad_table(spark, sf), "ads"), (FX.version_table(spark, sf), "versions")))
    apps = FX.by_day(FX.app_table(spark, sf).withColumn("stat_date", F.lit(DAY).cast("bigint")), "apps")
    return MG.merge_apps(MG.advertised_apps(ads, DAY), MG.app_attributes(apps, DAY), MG.app_versions(versions, DAY))


def q_app_features(spark, sf):
    return FE.app_features(app_snapshot(spark, sf))


def q_event_features(spark, sf):
    return FE.event_features(FX.event_log(spark, sf), keep=("stat_date",))


def q_instances(spark, sf):
    return FE.instances(FE.event_features(FX.event_log(spark, sf), keep=("stat_date",)),
                        FE.profile_features(FX.profile_table(spark, sf)),
                        FE.app_features(app_snapshot(spark, sf)))


def q_one_hot(spark, sf):
    from pyspark.ml.functions import vector_to_array

    apps = FE.app_features(app_snapshot(spark, sf))
    enc = FE.one_hot(apps, ["fcategoryid"])
    arr = vector_to_array(F.col("fcategoryid_vec"))
    return enc.select("appid", "fcategoryid",
                      (F.array_position(arr, 1.0) - 1).cast("double").alias("hot_index"),
                      F.size(arr).alias("n_slots"))


def q_assemble(spark, sf):
    from pyspark.ml.functions import vector_to_array

    apps = FE.app_features(app_snapshot(spark, sf))
    vec = FE.assemble(apps, "appid")
    text = F.array_join(F.transform(vector_to_array(F.col("features")), lambda x: x.cast("string")), ",")
    return vec.select("appid", text.alias("features"))


def _bin_sql(expr: str, th) -> str:
    cases = " ".join(f"when {expr} <= {float(r)} then {float(i)}" for i, r in enumerate(th))
    return f"cast(case when {expr} is null then null when isnan({expr}) then 0.0 {cases} else {float(len(th))} end as double)"


def _codes_sql(src: str, key: str, cols) -> str:
    """CTEs ``d_<src>`` (dictionary) and ``coded_<src>`` (key + codes) over ``src``."""
    d, dc, dv, dn, pv = (f"{x}_{src}" for x in ("d", "dc", "dv", "dn", "pv"))
    unions = " union all ".join(f"select '{c}' as feature, cast({c} as varchar) as value from {src}" for c in cols)
    joins = " ".join(f"left join {d} as j_{c} on j_{c}.feature = '{c}' "
                     f"and j_{c}.value is not distinct from cast({src}.{c} as varchar)" for c in cols)
    sel = ", ".join(f"coalesce(j_{c}.code, (select coalesce(max(total), 0) from {dc} where {dc}.feature = '{c}')) as {c}"
                    for c in cols)
    return f"""{pv} as ({unions}),
{dv} as (select distinct feature, value from {pv}),
{dn} as (select feature, value,
               cast(dense_rank() over (partition by feature order by value) - 1 as double) as code
        from {dv} where value is not null),
{dc} as (select feature, cast(count(*) as double) as total from {dn} group by feature),
{d} as (select feature, value, code from {dn}
      union all select {dv}.feature, {dv}.value, coalesce({dc}.total, 0)
      from {dv} left join {dc} using (feature) where {dv}.value is null),
coded_{src} as (select {src}.{key}, {sel} from {src} {joins})"""


_PROFILE_CTE = f"""ps as ({FX.PROFILE_SQL}),
{_codes_sql('ps', 'imei', FE.PROFILE_COLUMNS)}"""

_SNAPSHOT_SQL = f"""select a.appid, fname, fcategoryid, fcategory2id, fstatus, fevaluate_count, fdownload_count,
       fstars, finstall_count, v.appsize
from (select distinct l_partkey as appid from lineitem) a
join ({FX.APP_SQL}) p on a.appid = p.fid
join (select l_partkey as appid, max(cast(l_quantity as bigint) * 10240) as appsize from lineitem group by l_partkey) v
  on a.appid = v.appid"""

_MONTH = "cast(strftime(date_trunc('month', l_shipdate), '%Y%m%d') as bigint)"

_SNAPSHOT_DAY_SQL = f"""select a.appid, fname, fcategoryid, fcategory2id, fstatus, fevaluate_count, fdownload_count,
       fstars, finstall_count, v.appsize
from (select distinct l_partkey as appid from lineitem where {_MONTH} = {DAY}) a
join ({FX.APP_SQL}) p on a.appid = p.fid
join (select l_partkey as appid, max(cast(l_quantity as bigint) * 10240) as appsize
      from lineitem where {_MONTH} = {DAY} group by l_partkey) v on a.appid = v.appid"""

_SNAPSHOT_DAILY_SQL = f"""select a.stat_date, a.appid, fname, fcategoryid, fcategory2id, fstatus, fevaluate_count,
       fdownload_count, fstars, finstall_count, v.appsize
from (select distinct l_partkey as appid, {_MONTH} as stat_date from lineitem) a
join ({FX.APP_SQL}) p on a.appid = p.fid
join (select l_partkey as appid, {_MONTH} as stat_date,
             max(cast(l_quantity as bigint) * 10240) as appsize
      from lineitem group by 1, 2) v
  on a.appid = v.appid and a.stat_date = v.stat_date"""

_APP_BINNED = "ab as (select appid, fcategoryid, fcategory2id, " + ", ".join(
    f"{_bin_sql(c, FF.APP_BIN_THRESHOLDS[c])} as {c}" for c in FE.APP_BIN_COLUMNS) + " from snap)"

_APP_CTE = f"""snap as ({_SNAPSHOT_SQL}), {_APP_BINNED},
{_codes_sql('ab', 'appid', FE.APP_CATEGORY_COLUMNS + FE.APP_BIN_COLUMNS)}"""

_EVENT_FEATURES_SQL = f"""select stat_date, imei, app_id as appid,
       cast(case when oper_type = 'AD_MQ_EVENT_CPD_EXPOSE' then 0.0
                 when oper_type in ('AD_MQ_EVENT_CPD_DETAIL', 'AD_MQ_EVENT_CPD_INSTALL') then 1.0
                 else -1.0 end as double) as oper_type,
       cast(dayofweek(ts) + 1 as double) as day_of_week,
       cast(floor(((hour(ts) + 22) % 24) / 6) as double) as hour_of_day
from ({FX.EVENT_SQL}) e where tracker_type = 2"""

def _sample_sql(src: str, weight: str) -> str:
    """CTE sm: the rows of ``src`` of the smallest keyed hashes of each sex, with sample_weight."""
    return f"""sr as (
  select *, (('0x' || md5('sample-1:' || imei)[1:{SM.HEX_DIGITS}])::bigint + 1)::double / {2 ** (4 * SM.HEX_DIGITS)}::double / {weight}::double as rank from {src}
), sp as (
  select *, row_number() over (partition by sex order by rank, imei) as place from sr
), st as (
  select *, max(case when place = {STRATUM_ROWS + 1} then rank end) over (partition by sex) as threshold from sp
), sm as (
  select * exclude (rank, place, threshold), case when threshold is null then {weight}::double else greatest({weight}::double, 1 / threshold) end as sample_weight
  from st where place <= {STRATUM_ROWS}
)"""


ORACLES_FEATURES = {
    "profile_strata": f"""with ps as (select *, 1 + user_job as weight from ({FX.PROFILE_SQL}) x), {_sample_sql('ps', 'weight')}
select * from sm""",
    "sampled_features": f"""with {_PROFILE_CTE}, {_sample_sql('ps', '1')}
select coded_ps.*, sm.sample_weight from coded_ps join sm using (imei)""",
    "bins": f"""select l_orderkey, l_linenumber,
       {_bin_sql('l_quantity', FF.EVALUATE_THRESHOLDS)} as qty_bin,
       {_bin_sql('l_extendedprice', FF.COUNT_THRESHOLDS)} as price_bin,
       {_bin_sql('(l_quantity * 10240)', FF.APPSIZE_THRESHOLDS)} as size_bin
from lineitem""",
    "category_codes": f"""with prof as ({FX.PROFILE_SQL}),
{_codes_sql('prof', 'imei', FE.PROFILE_COLUMNS)}
select feature, value, code from d_prof""",
    "profile_sample": f"""select * from ({FX.PROFILE_SQL}) x order by imei limit {PROFILE_SAMPLE_ROWS}""",
    "profile_features": f"""with {_PROFILE_CTE}
select * from coded_ps""",
    "app_merge": _SNAPSHOT_SQL,
    "app_merge_daily": _SNAPSHOT_DAILY_SQL,
    "app_merge_day": _SNAPSHOT_DAY_SQL,
    "app_features": f"""with {_APP_CTE}
select * from coded_ab""",
    "event_features": _EVENT_FEATURES_SQL,
    "instances": f"""with {_PROFILE_CTE}, {_APP_CTE}, ev as ({_EVENT_FEATURES_SQL})
select ev.oper_type, {', '.join('coded_ps.' + c for c in FE.PROFILE_COLUMNS)},
       {', '.join('coded_ab.' + c for c in FE.APP_CATEGORY_COLUMNS + FE.APP_BIN_COLUMNS)},
       ev.stat_date, ev.day_of_week, ev.hour_of_day
from ev join coded_ps on ev.imei = coded_ps.imei join coded_ab on ev.appid = coded_ab.appid""",
    "one_hot": f"""with {_APP_CTE}
select appid, fcategoryid, fcategoryid as hot_index,
       cast((select max(fcategoryid) from coded_ab) + 1 as integer) as n_slots
from coded_ab""",
    "assemble": f"""with {_APP_CTE}
select appid, {" || ',' || ".join(f"cast({c} as varchar)" for c in FE.APP_CATEGORY_COLUMNS + FE.APP_BIN_COLUMNS)}
       as features
from coded_ab""",
}

QUERIES_FEATURES: dict[str, Query] = {
    "bins": q_bins,
    "category_codes": q_category_codes,
    "profile_features": q_profile_features,
    "profile_sample": q_profile_sample,
    "profile_strata": q_profile_strata,
    "sampled_features": q_sampled_features,
    "app_merge_day": q_app_merge_day,
    "app_merge": q_app_merge,
    "app_merge_daily": q_app_merge_daily,
    "app_features": q_app_features,
    "event_features": q_event_features,
    "instances": q_instances,
    "one_hot": q_one_hot,
    "assemble": q_assemble,
}


# --------------------------------------------------------------------------- saved days and whole jobs

QUERIES_SAVED: dict[str, Query] = {
    "sink_days": lambda spark, sf: SV.sink_days(S.read_parquet(spark, sf, "lineitem")),
    "job_match_modes": lambda spark, sf: SV.match_modes(FX.bid_table(spark, sf), FX.search_log(spark, sf), RANGE_FROM, RANGE_TO, MATCH),
    "job_match_counts": lambda spark, sf: SV.match_counts(FX.bid_table(spark, sf), FX.search_log(spark, sf), RANGE_FROM, RANGE_TO),
    "job_flatten": lambda spark, sf: SV.flatten(FX.adlog(spark, sf).select("vcontent", "stat_date"), DAY),
    "job_app_merge": lambda spark, sf: SV.app_merge(FX.ad_table(spark, sf), FX.app_table(spark, sf), FX.version_table(spark, sf), DAY),
    "job_instances": lambda spark, sf: SV.instances(FX.profile_table(spark, sf), app_snapshot(spark, sf), FX.event_log(spark, sf), EVENT_DAY),
    "bid_word_history": lambda spark, sf: SV.bid_history(_bid_runs(spark, sf)),
    "backfill_rows": lambda spark, sf: SV.backfill(FX.event_log(spark, sf), *BACKFILL)[0],
    "backfill_manifest": lambda spark, sf: SV.backfill(FX.event_log(spark, sf), *BACKFILL)[1],
    "coverage_days": lambda spark, sf: SV.coverage_days(_daily_searches(spark, sf), bids(spark, sf), MATCH).select(
        "level", "period", "mode", "matched_cnt", "total_cnt", "pvr"),
    "instances_buckets": lambda spark, sf: SV.instances(FX.profile_table(spark, sf), app_snapshot(spark, sf), FX.event_log(spark, sf), EVENT_DAY, BUCKETS),
    "category_codes_days": lambda spark, sf: SV.codes_by_day(_order_days(spark, sf), CODE_COLUMNS),
    "job_instances_codes": lambda spark, sf: _instances_codes(spark, sf),
}

EVENT_DAY = 20240115
EARLIER_DAY = 20240114
EARLIER_PROFILES = "user_age < 13 and (mz_apps_car_owner is null or mz_apps_car_owner < 5)"
EARLIER_APPS = "fevaluate_count <= 400"

CODE_COLUMNS = ["customer", "priority", "urgent", "status"]
CODE_DAYS = {19950401: "o_orderdate < date '1995-04-01'", 19950901: "o_orderdate >= date '1995-04-01' and o_orderdate < date '1995-09-01'",
             20011231: "o_orderdate >= date '1995-09-01'"}
_CODE_ROWS = """o_custkey as customer, o_orderpriority as priority, case when o_orderdate >= date '1995-04-01' then o_orderpriority = '1-URGENT' end as urgent,
       case when o_orderkey % 7 <> 0 then o_orderstatus end as status"""


BUCKETS = 8


def _daily_searches(spark, sf) -> DataFrame:
    log = FX.search_log(spark, sf).select(F.trim("keyword").alias(M.SEARCH), "stat_date").where(F.col(M.SEARCH).isNotNull())
    return log.groupBy(M.SEARCH, "stat_date").agg(F.count(F.lit(1)).alias("cnt"))


BACKFILL = (20240101, 20240201)
# Words of a day's runs, by part key; the second day is run again with other words, the third comes late.
BID_DAYS = {20240101: "p_partkey % 4 <> 1", 20240102: "p_partkey % 4 <> 2", 20240103: "p_partkey % 4 <> 3 and p_partkey % 5 <> 0", 20240104: "p_partkey % 5 = 1"}
BID_FIRST_RUN = "p_partkey % 3 = 0"


def _bid_runs(spark, sf) -> list[tuple[int, DataFrame]]:
    part = S.read_parquet(spark, sf, "part").select("p_partkey", F.expr(FX.BID_SQL).alias("bid_word"))
    words = {d: part.where(cond).select("bid_word") for d, cond in BID_DAYS.items()}
    first_run = part.where(BID_FIRST_RUN).select(F.concat("bid_word", F.when(F.col("p_partkey") % 2 == 0, F.lit(" once")).otherwise(F.lit(""))).alias("bid_word"))
    days = list(BID_DAYS)
    return [(days[0], words[days[0]]), (days[1], first_run), (days[3], words[days[3]]), (days[2], words[days[2]]), (days[1], words[days[1]]), (days[0], words[days[0]])]


def _order_days(spark, sf) -> dict[int, DataFrame]:
    """All orders in three days: customers of high cardinality, a column that is all NULL on the first day, one with NULLs."""
    orders = S.read_parquet(spark, sf, "orders")
    return {dt: orders.where(cond).select(*[F.expr(c) for c in _exprs(_CODE_ROWS)]) for dt, cond in CODE_DAYS.items()}


def _exprs(text: str) -> list[str]:
    return [x.strip() for x in text.split(",")]


def _instances_codes(spark, sf):
    """Rows of a day with its own codes and with those of the day before, when fewer profiles and apps were known."""
    profiles, apps = FX.profile_table(spark, sf), app_snapshot(spark, sf)
    return SV.instances_of_two_days([profiles.where(EARLIER_PROFILES), profiles], [apps.where(EARLIER_APPS), apps],
                                    FX.event_log(spark, sf), [EARLIER_DAY, EVENT_DAY])


def _grown_sql(name: str, days: list[str], cols) -> str:
    """CTEs ``<name>`` (k, feature, value, code): what each of ``days`` (relations) adds to the dictionary of those before, k from 0."""
    out = []
    for k, rel in enumerate(days):
        values = " union ".join(f"select '{c}' as feature, cast({c} as varchar) as value from {rel} where {c} is not null" for c in cols)
        known = f"{name}_{k - 1}"
        if k == 0:
            features = ", ".join(f"('{c}')" for c in cols)
            out.append(f"""{name}_v0 as ({values}),
{name}_0 as (select 0 as k, feature, value, cast(row_number() over (partition by feature order by value) - 1 as double) as code from {name}_v0
             union all select 0, f.feature, null, cast((select count(*) from {name}_v0 v where v.feature = f.feature) as double) from (values {features}) f(feature))""")
        else:
            out.append(f"""{name}_v{k} as (select feature, value from ({values}) t where (feature, value) not in (select (feature, value) from {known} where value is not null)),
{name}_{k} as (select * from {known} union all
             select {k}, feature, value, (select max(code) from {known} p where p.feature = {name}_v{k}.feature) + row_number() over (partition by feature order by value)
             from {name}_v{k})""")
    return ",\n".join(out) + f",\n{name} as (select * from {name}_{len(days) - 1})"


def _coded_sql(alias: str, src: str, key: str, cols, dictionary: str) -> str:
    """CTE ``alias``: ``src`` with the codes of ``dictionary``; a value it lacks has the code of NULL."""
    joins = " ".join(f"left join {dictionary} j_{c} on j_{c}.feature = '{c}' and j_{c}.value is not distinct from cast({src}.{c} as varchar)" for c in cols)
    sel = ", ".join(f"coalesce(j_{c}.code, (select code from {dictionary} where feature = '{c}' and value is null)) as {c}" for c in cols)
    return f"{alias} as (select {src}.{key}, {sel} from {src} {joins})"


_IN_RANGE = f"""select trim(keyword) as search_word, count(*) as cnt from ({FX.SEARCH_LOG_SQL}) l
where stat_date >= {RANGE_FROM} and stat_date < {RANGE_TO} and trim(keyword) is not null group by trim(keyword)"""
_RANGE_PAIRS = PAIRS_SQL.replace(FX.SEARCHES_SQL, _IN_RANGE)

_APP_ALL = FE.APP_CATEGORY_COLUMNS + FE.APP_BIN_COLUMNS


def _instances_codes_sql() -> str:
    rows = lambda when, p, a: f"""select ev.oper_type, {', '.join(f'{p}.{c}' for c in FE.PROFILE_COLUMNS)}, {', '.join(f'{a}.{c}' for c in _APP_ALL)},
       ev.day_of_week, ev.hour_of_day, cast({when} as bigint) as codes_day
from ev join {p} on ev.imei = {p}.imei join {a} on ev.appid = {a}.appid where ev.stat_date = {EVENT_DAY}"""  # noqa: E731
    return f"""with ps as ({FX.PROFILE_SQL}), ps0 as (select * from ps where {EARLIER_PROFILES}),
snap as ({_SNAPSHOT_SQL}), {_APP_BINNED},
ab0 as (select ab.* from ab join snap using (appid) where snap.{EARLIER_APPS}),
{_grown_sql('gp', ['ps0', 'ps'], FE.PROFILE_COLUMNS)}, {_grown_sql('ga', ['ab0', 'ab'], _APP_ALL)},
{_coded_sql('p0', 'ps', 'imei', FE.PROFILE_COLUMNS, 'gp_0')}, {_coded_sql('p1', 'ps', 'imei', FE.PROFILE_COLUMNS, 'gp')},
{_coded_sql('a0', 'ab', 'appid', _APP_ALL, 'ga_0')}, {_coded_sql('a1', 'ab', 'appid', _APP_ALL, 'ga')},
ev as ({_EVENT_FEATURES_SQL})
{rows(EARLIER_DAY, 'p0', 'a0')} union all {rows(EVENT_DAY, 'p1', 'a1')}"""


ORACLES_SAVED = {
    "sink_days": """
select l_returnflag as word, count(*) as cnt, cast(20240101 as bigint) as stat_date from lineitem where l_quantity > 25 group by 1
union all select l_linestatus, count(*), 20240102 from lineitem group by 1""",
    "job_match_modes": _RANGE_PAIRS + """,
r as (select search_word, string_agg(bid_word || ',' || tag, ' ' order by bid_word, tag) as bidlist from tp group by 1)
select 'exact-match' as mode, search_word, cast(cnt as varchar) as value from s where search_word in (select search_word from tp where tag = 1)
union all select 'exact-include', search_word, cast(cnt as varchar) from s where search_word in (select search_word from tp where tag in (1, 2))
union all select 'syno-include', search_word, cast(cnt as varchar) from s where search_word in (select search_word from p where k = n)
union all select 'core-include', search_word, cast(cnt as varchar) from s
          where search_word in (select search_word from p where (n = 1 and k = 1) or (n > 1 and k >= n - 1))
union all select 'get-data', search_word, coalesce(bidlist, '') from s left join r using (search_word)""",
    "job_match_counts": f"""
select m.mode, (select count(*) from ({FX.BIDS_SQL}) b) as bid_words, (select count(*) from ({_IN_RANGE}) s) as search_words
from (values {', '.join(f"('{m}')" for m in M.MODES)}) m(mode)""",
    "job_flatten": _flatten_sql(DAY),
    "job_app_merge": _SNAPSHOT_DAY_SQL,
    "job_instances": f"""with {_PROFILE_CTE}, {_APP_CTE}, ev as ({_EVENT_FEATURES_SQL})
select ev.oper_type, {', '.join('coded_ps.' + c for c in FE.PROFILE_COLUMNS)},
       {', '.join('coded_ab.' + c for c in FE.APP_CATEGORY_COLUMNS + FE.APP_BIN_COLUMNS)}, ev.day_of_week, ev.hour_of_day
from ev join coded_ps on ev.imei = coded_ps.imei join coded_ab on ev.appid = coded_ab.appid
where ev.stat_date = {EVENT_DAY}""",
    "coverage_days": PAIRS_SQL + f""",
f as (select search_word, bool_or(tag = 1) as m1, bool_or(tag in (1, 2)) as m2, bool_or(tag in (1, 3)) as m3, bool_or(tag in (1, 3, 4) and n > 0) as m4
      from tp group by search_word),
l as (select stat_date as d, trim(keyword) as search_word, count(*) as cnt from ({FX.SEARCH_LOG_SQL}) t where trim(keyword) is not null group by all),
x as (select d, d // 100 as month, cnt, unnest([{{'mode': 'exact-match', 'hit': coalesce(m1, false)}}, {{'mode': 'exact-include', 'hit': coalesce(m2, false)}},
             {{'mode': 'syno-include', 'hit': coalesce(m3, false)}}, {{'mode': 'core-include', 'hit': coalesce(m4, false)}}], recursive := true)
      from l left join f using (search_word)),
y as (select d, month, mode, sum(case when hit then cnt else 0 end)::bigint as matched_cnt, sum(cnt)::bigint as total_cnt
      from x group by grouping sets ((d, mode), (month, mode), (mode)))
select case when d is not null then 'day' when month is not null then 'month' else 'all' end as level, coalesce(d, month, 0)::bigint as period, mode,
       matched_cnt, total_cnt, matched_cnt / total_cnt as pvr from y""",
    "instances_buckets": f"""with {_PROFILE_CTE}, {_APP_CTE}, ev as ({_EVENT_FEATURES_SQL})
select ev.oper_type, {', '.join('coded_ps.' + c for c in FE.PROFILE_COLUMNS)},
       {', '.join('coded_ab.' + c for c in FE.APP_CATEGORY_COLUMNS + FE.APP_BIN_COLUMNS)}, ev.day_of_week, ev.hour_of_day
from ev join coded_ps on ev.imei = coded_ps.imei join coded_ab on ev.appid = coded_ab.appid
where ev.stat_date = {EVENT_DAY}""",
    "bid_word_history": "select bid_word, min(d)::bigint as first_day, max(d)::bigint as last_day from (" + " union all ".join(
        f"select {FX._duck(FX.BID_SQL)} as bid_word, {d} as d from part where {cond}" for d, cond in BID_DAYS.items()) + ") t where bid_word is not null group by bid_word",
    "backfill_rows": _EVENT_FEATURES_SQL,
    "backfill_manifest": f"""with ev as ({_EVENT_FEATURES_SQL})
select cast(strftime(d, '%Y%m%d') as bigint) as stat_date, (select count(*) from ev where ev.stat_date = cast(strftime(d, '%Y%m%d') as bigint)) as rows
from (select unnest(range(timestamp '2024-01-01', timestamp '2024-02-01', interval 1 day)) as d) t""",
    "category_codes_days": "with " + ", ".join(f"o{k} as (select {_CODE_ROWS} from orders where {cond})" for k, cond in enumerate(CODE_DAYS.values())) + f""",
{_grown_sql('g', [f'o{k}' for k in range(len(CODE_DAYS))], CODE_COLUMNS)}
select cast(case k {' '.join(f'when {k} then {dt}' for k, dt in enumerate(CODE_DAYS))} end as bigint) as stat_date, feature, value, code from g""",
    "job_instances_codes": _instances_codes_sql(),
}


def _configured(name: str, fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    run.__name__ = name
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(QUERIES_MATCH)
    out.update(QUERIES_JSON)
    out.update(QUERIES_FEATURES)
    out.update(QUERIES_SAVED)
    return {k: _configured(k, v) for k, v in out.items()}


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(ORACLES_MATCH)
    out.update(ORACLES_JSON)
    out.update(ORACLES_FEATURES)
    out.update(ORACLES_SAVED)
    return out
