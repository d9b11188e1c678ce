"""URL filter: host-suffix and path-prefix expressions against hashed rules.

A rule is a host with a path; it fits that host, all its subdomains, and
every path that starts with its own. Each URL is expanded into the
expressions that could be a rule (host suffixes of as many labels, path
prefixes of as many characters, as some rule has), and they meet the rules in an
equi-join on the first 32 bits of their SHA-256 alone: the rules of a prefix are
one row, of which those with the same full digest are confirmed after the
join. Of the rules that fit, the longest wins; of equally long ones the one
with the longer host, then a block.

Many URLs share a host and the first characters of a path, which is all that
rules see. So these pairs are made distinct (map-side first) before they are
expanded, and each URL gets its verdict by a join on the pair.

Defined cases: a null URL or one without ``://`` has empty host and path and
fits no rule; an empty path fits no rule with a path of ``/``; repeated rows
each get their verdict; a port belongs to the host. URLs that no rule fits
get the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed rules: host and path up to the first slash and from it, verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DEFAULT = "allow"
PREFIX_HEX = 8


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark, rules=RULES) -> DataFrame:
    """(rule, verdict) pairs as a table: rule, verdict, host, path and digest."""
    rows = spark.createDataFrame(list(rules), "rule string, verdict string")
    at = F.instr("rule", "/")
    rows = rows.select("rule", "verdict", F.expr("substring(rule, 1, instr(rule, '/') - 1)").alias("host"),
                       F.expr("substring(rule, instr(rule, '/'))").alias("path")).where(at > 0)
    return rows.withColumn("digest", digest(F.col("host"), F.col("path")))


def digest(h: Column, p: Column) -> Column:
    return F.sha2(F.concat(h, p), 256)


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` as they are, plus host, path, rule and verdict (instead of own columns of these names).

    ``rules`` comes from ``rule_table``. Two lists are read from it on the driver: the
    different label counts of its hosts and lengths of its paths.
    """
    shape = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).collect()[0]
    labels, lengths = sorted(shape["labels"]), sorted(shape["lengths"])
    columns = [f"`{c}`" for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    seen = pages.select(F.struct(*[F.col(c) for c in columns]).alias("page"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    seen = seen.withColumn("head", F.substring("path", 1, max(lengths, default=0)))
    keys = seen.select("host", "head").distinct()
    expanded = keys.select("host", "head", F.split("host", r"\.").alias("parts"))
    suffix = [F.when(F.size("parts") >= n, F.array_join(F.slice("parts", -n, n), ".")) for n in labels]
    prefix = [F.when(F.length("head") >= n, F.substring("head", 1, n)) for n in lengths]
    pairs = [F.struct(s.alias("s"), p.alias("p")) for s in suffix for p in prefix]
    empty = F.array().cast("array<struct<s:string,p:string>>")
    wanted = F.filter(F.array(*pairs) if pairs else empty, lambda x: x["s"].isNotNull() & x["p"].isNotNull())
    asked = (expanded.select("host", "head", F.explode(wanted).alias("e"))
             .select("host", "head", "e.s", "e.p", F.substring(digest(F.col("e.s"), F.col("e.p")), 1, PREFIX_HEX).alias("short")))
    # A group holds the rules whose digests begin alike.
    known = (rules.select(F.substring("digest", 1, PREFIX_HEX).alias("known"),
                          F.struct("digest", "rule", F.col("verdict").alias("said"), F.length("host").alias("host_length")).alias("r"))
             .groupBy("known").agg(F.collect_list("r").alias("rules")))
    met = asked.join(known, F.col("short") == F.col("known")).withColumn("asked", digest(F.col("s"), F.col("p")))
    hits = met.select("host", "head", F.inline(F.filter("rules", lambda r: r["digest"] == F.col("asked"))))
    order = F.struct(F.length("rule"), F.col("host_length"), (F.col("said") == "block"), F.col("rule"))
    best = hits.groupBy(F.col("host").alias("h"), F.col("head").alias("q")).agg(F.max_by(F.struct("rule", "said"), order).alias("best"))
    judged = seen.join(best, (F.col("host") == F.col("h")) & (F.col("head") == F.col("q")), "left")
    return judged.select("page.*", F.col("host").alias("host"), F.col("path").alias("path"), F.col("best.rule").alias("rule"),
                         F.coalesce("best.said", F.lit(default)).alias("verdict"))
