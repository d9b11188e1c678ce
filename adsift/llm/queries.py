"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import ann, exact_dedup, infill, licenses, mixing, ngram_join, packing, spelling, surrogates, toxicity, urls, warc, wavelet
from .shared import table

Query = Callable[[SparkSession, str], DataFrame]


WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities", "kinds")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.label_documents(*licenses.scan(table(spark, sf_dir, "documents"), across=licenses.TEMPLATES + licenses.NOTICES))


def op3_patricia_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op4_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), urls.rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.placements(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), specials=True))


def op7_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = wavelet.new_folder(spark)
    shards = wavelet.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY), folder, specials=True)
    return wavelet.digests(spark, shards, folder)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "kept")


def op10_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"),
                         (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infill.restore(infill.transform(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2("restored", 256).alias("restored_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


def op13_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark)
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_surrogates, op2_license_scan, op3_patricia_dedup, op4_projection_forest, op5_url_filter, op6_best_fit_pack,
                                    op7_wavelet_shards, op8_source_mix, op9_ngram_jaccard, op10_toxicity_gru, op11_fill_in_middle,
                                    op12_spelling_variants, op13_warc_shards)}


def _license_sql() -> str:
    pattern = licenses.WORD
    lower = f"translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}')"
    notices = ", ".join(f"('{label}', '{notice}')" for label, notice in licenses.TEMPLATES)
    starts = []
    for phrase, label in licenses.PHRASES:
        hit = " and ".join(f"words[i + {k + 1}] = '{p}'" for k, p in enumerate(phrase.split(" ")))
        starts.append(f"list_transform(list_filter(range(len(words)), lambda i: coalesce({hit}, false)), lambda i: {{'l': '{label}', 'i': i}})")
    return f"""
with notice as (
  select label, list_distinct(regexp_extract_all(notice, '{pattern}')) as t from (values {notices}) v(label, notice)
), d as (
  select row_number() over () as rid, doc_id, {lower} as low from documents
), w as (
  select rid, doc_id, low, regexp_extract_all(low, '{pattern}') as words from d
), s as (
  select rid, doc_id, low, len(words) as n_words, list_concat({', '.join(starts)}) as found from w
), line as (
  select rid, list_distinct(regexp_extract_all(unnest(string_split(low, chr(10))), '{pattern}')) as b from s
), met as (
  select rid, label, len(list_intersect(b, t)) / len(t) as c
  from line, notice where len(list_intersect(b, t)) >= greatest(1, ceil(len(t) * {licenses.THRESHOLD} - 1e-9))
), told as (
  select rid, list(distinct label) as labels, max(c) as most from met group by rid
), x as (
  select s.*, coalesce(told.labels, []) as more, coalesce(most, 0) as most,
         list_distinct(list_transform(found, lambda f: f.l)) as base
  from s left join told using (rid)
)
select doc_id, n_words::BIGINT as n_words, len(found)::BIGINT as n_base,
       list_min(list_transform(found, lambda f: f.i))::BIGINT as first_word,
       list_max(list_transform(found, lambda f: f.i))::BIGINT as last_word,
       coalesce(array_to_string(list_sort(base), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base, more))), ','), '') as labels,
       (case when len(found) > 0 then 1.0 else most end)::DOUBLE as score
from x"""


DEDUP_SQL = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))"""


def _url_sql() -> str:
    rules = ", ".join(f"('{r}', '{v}')" for r, v in urls.RULES)
    return f"""
with rule as (
  select rule, v, rule[1:instr(rule, '/') - 1] as rh, rule[instr(rule, '/'):] as rp from (values {rules}) x(rule, v)
), p as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages
), k as (select distinct host, path from p
), best as (
  select host, path, arg_max(rule, length(rule)) as rule, arg_max(v, length(rule)) as v
  from k, rule where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by all
)
select page_id, p.host, p.path, rule, coalesce(v, '{urls.DEFAULT}') as verdict
from p left join best on p.host = best.host and p.path = best.path"""


def _mix_sql() -> str:
    weight = " ".join(f"when {i} then {w}" for i, w in enumerate(mixing.WEIGHTS))
    return f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}'))::BIGINT as size from documents
), s as (
  select source, sum(size)::BIGINT as source_size, (sum(size) * {mixing.MOST_COPIES})::BIGINT as cap,
         case (row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} {weight} end as weight
  from d group by source
), o as (
  select *, row_number() over by_ratio as k,
         coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as capped,
         sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as open,
         sum(source_size) over () as whole
  from s window by_ratio as (order by cap / weight, source nulls last)
), f as (
  select *, (whole - capped)::DOUBLE / open as level from o
), z as (
  select min(k) as k0, arg_min(level, k) as level0 from f where level * weight <= cap
), t as (
  select source, source_size, case when k < k0 then cap::DOUBLE else level0 * weight end as target,
         case when source_size > 0 then (case when k < k0 then cap::DOUBLE else level0 * weight end) / source_size else 0 end as rate,
         ('0x' || md5('{mixing.SEED}:' || coalesce('=' || source, ''))[1:8])::BIGINT / 4294967296.0::DOUBLE as u
  from f, z
), r as (
  select doc_id, source, size, row_number() over (partition by source order by size, doc_id nulls last) as i from d
)
select doc_id, size, source_size, target,
       ((floor(rate * i + u) - floor(rate * (i - 1) + u)) * size)::BIGINT as taken
from r join t on r.source is not distinct from t.source"""


INFILL_SQL = """
with d as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id) as h from documents
), w as (
  select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as w, ('0x' || h[1:8])::BIGINT as h1, ('0x' || h[9:16])::BIGINT as h2,
         ('0x' || h[17:24])::BIGINT as h3, ('0x' || h[25:32])::BIGINT as h4
  from d
), c as (
  select *, len(w) as n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) as a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from w
), s as (
  select doc_id, t, n, form, array_to_string(list_filter(w, lambda x, i: i <= a), '') as p,
         array_to_string(list_filter(w, lambda x, i: i > a and i <= b), '') as m, array_to_string(list_filter(w, lambda x, i: i > b), '') as e
  from c
)
select doc_id, n::BIGINT as n, form, case when form <> 'plain' then length(p) end::BIGINT as prefix_chars,
       case when form <> 'plain' then length(m) end::BIGINT as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || e || '<M>' || m else '<S>' || e || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from s"""


def _spelling_sql() -> str:
    letters = "".join(chr(c) for c in range(0xC0, 0x100))
    # CRC-32 by its table: eight steps of the polynomial for each byte value, then one look-up a byte.
    shift = "case when {c} % 2 = 1 then xor({c} // 2, 3988292384) else {c} // 2 end"
    steps = ", ".join(f"s{k + 1} as (select b, {shift.format(c='c')} as c from s{k})" for k in range(8))
    return f"""
with recursive s0 as (select b, b::BIGINT as c from range(256) r(b)), {steps},
tab as materialized (select list(c order by b) as tab from s8),
run as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[a-z{letters}]+')) as r from documents
), seen as (
  select doc_id, r, count(*) as k from run where length(r) >= {spelling.LEAST_CHARS} group by all
), h as (
  select r, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(doc_id || ':' || r)),
           lambda i: ('0x' || hex(encode(doc_id || ':' || r))[2 * i + 1 : 2 * i + 2])::BIGINT)),
           lambda c, x: xor(c // 256, tab[(xor(c % 256, x) + 1)::INT])), 4294967295)::BIGINT as h
  from seen, tab
), v as (
  select case when h % {spelling.SLIP} = 0 then r[1 : h % length(r)] || r[h % length(r) + 2 :] else r end as word, k from h
), w as materialized (
  select word, sum(k)::BIGINT as n from v where length(word) >= {spelling.LEAST_CHARS} group by word having sum(k) >= {spelling.LEAST_COUNT}
), cut as (
  select word, i, word[1 : i] || word[i + 2 :] as c from (select word, unnest(range(length(word))) as i from w)
), near as materialized (
  select x.word, y.word as other from cut x join cut y on x.i = y.i and x.c = y.c and x.word <> y.word
  union select word, c from cut where c in (select word from w)
  union select c, word from cut where c in (select word from w)
), best as (
  select near.word, count(*) as n_near, arg_min(other, (-w.n, other)) as form, max(w.n) as form_n from near join w on w.word = near.other group by near.word
), f as materialized (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= {spelling.RATIO} * w.n then form end as form,
         case when form_n >= {spelling.RATIO} * w.n then form_n end as form_n
  from w left join best using (word)
), up as (
  select word, word as root, form as onward from f
  union all select up.word, up.onward, f.form from up join f on f.word = up.onward
)
select f.word, f.form, up.root, f.n, f.n_near::BIGINT as n_near, f.form_n::BIGINT as form_n from f join up on f.word = up.word and up.onward is null"""


WARC_SQL = """
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h, first_value(page_id) over g as first_id, row_number() over g as k
  from pages window g as (partition by coalesce(html, '') order by page_id nulls last)
)
select page_id, strlen(html)::BIGINT as payload_bytes,
       array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
         ((('0x' || h[(i // 4) * 5 + 1 : (i // 4) * 5 + 5])::BIGINT >> ((3 - i % 4) * 5)) & 31) + 1]), '') as payload_digest,
       case when k = 1 then 'response' else 'revisit' end as record_type, case when k > 1 then first_id end as refers_to
from p"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_fill_in_middle": INFILL_SQL,
        "op12_spelling_variants": _spelling_sql(),
        "op13_warc_shards": WARC_SQL,
        "op2_license_scan": _license_sql(),
        "op3_patricia_dedup": DEDUP_SQL,
        "op5_url_filter": _url_sql(),
        "op8_source_mix": _mix_sql(),
    }
