"""Search-word x bid-word matching.

Every mode is an equi-join on a candidate key followed by an exact check, so
the cost follows the number of true candidates and not |queries| x |bids|:

* tokens: each bid is indexed under its one or two rarest tokens (rarest by
  the number of queries that hold them). A query that holds all of a bid's
  tokens holds the rarest one; one that misses at most one token holds at
  least one of any two.
* substrings: each bid is keyed by a substring that few queries hold. Keys
  begin with ``gram`` characters; where even a bid's rarest one is held by more
  than ``most_queries`` queries, the bid's substrings of twice the length are
  counted, and so on up to the bid itself. So a short key never stays common
  because the log grows, and only what is common is counted at greater length.
  Not every substring is looked at, but a sample that depends on the substring
  alone: a query that contains a bid has all the bid's sampled substrings. Only
  hashes of substrings travel.
* bids without a token are held by every query, and the empty bid is contained
  in every one: such pairs need no key. They are dealt out by a salt, so no
  key gathers all queries.

Both sides are written once, every search row under an id of its own. Only
ids, bids and single keys travel to the candidate join; the search words meet
the pairs after it, by id. So there is one plan for short and long queries,
and a search word that repeats is matched row by row.

Pairs are dealt out by the search row's id once. They are made distinct,
checked and gathered to lists, first pairs or flags where they then lie, so
that nothing with a text is shuffled a second time. Token sets that are an
expression of a text are made from it again there and don't travel. The
number of tasks follows the search rows, so that a task's sorts stay in memory.

A bid-side table is broadcast only when its own number of rows and bytes,
counted on the written bids, is within bounds. Beyond them both sides shuffle
on the key and AQE splits a hot one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grams import sampled_hashes, sampled_substrings
from ..functions.tokens import TOKEN_MODES, overlap, substrings, tokens
from ..plans.strategy import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, ROW_OVERHEAD_BYTES, write_table
from .segment import Dictionary, with_words

SEARCH = "search_word"
BID = "bid_word"

# Fixed tag values of the word-pair report.
TAG_EQUAL = 1          # query == bid
TAG_CONTAINS = 2       # query contains bid as a substring
TAG_ALL_TOKENS = 3     # every bid token is a query token
TAG_ALL_BUT_ONE = 4    # all bid tokens but one are query tokens (and at least one is)

# Fixed mode names of the reference's dispatcher.
MODES = ("exact-match", "exact-include", "syno-include", "core-include", "get-data")

SALTS = 64


@dataclass(frozen=True)
class MatchConfig:
    token_mode: str | Callable[[Column], Column] = "whitespace"    # or "lattice", with ``words``
    words: Dictionary | None = None
    gram: int = 3               # characters of the shortest keys
    most_queries: int = 16      # that may hold a key which could grow
    drop_empty_bids: bool = False
    rarest: bool = True
    broadcast_max_rows: int = DEFAULT_MAX_ROWS
    broadcast_max_bytes: int = DEFAULT_MAX_BYTES
    rows_per_task: int = 100_000    # search rows that a task of the pairs has, if that makes more tasks than cores


DEFAULT = MatchConfig()


# --------------------------------------------------------------------------- inputs

@dataclass(frozen=True)
class Sides:
    """The written sides and what the bids' one pass of counting found.

    ``queries``: qid, word, qt (tokens), row (the search row as it came, which holds the word).
    ``bids``: bid (the word), bt (tokens), n (their number).
    """
    cfg: MatchConfig
    queries: DataFrame
    bids: DataFrame
    rows: int
    text_bytes: int
    tokens: int
    token_bytes: int
    grams: int
    lengths: tuple[int, ...]    # key lengths if keys don't grow
    has_tokenless: bool
    has_empty: bool
    searches: int = 0

    def fits(self, rows: int, data: int) -> bool:
        return rows <= self.cfg.broadcast_max_rows and data + rows * ROW_OVERHEAD_BYTES <= self.cfg.broadcast_max_bytes

    def bounded(self, df: DataFrame, rows: int, data: int) -> DataFrame:
        """Broadcast a bid-side table of at most so many rows and bytes of data, if that is little."""
        return F.broadcast(df) if self.fits(rows, data) else df

    def by_row(self, df: DataFrame) -> DataFrame:
        """Deal out by search row: many rows over a number of tasks that follows them, which Spark doesn't merge to fewer."""
        spark = self.queries.sparkSession
        tasks = -(-self.searches // self.cfg.rows_per_task)
        if tasks <= spark.sparkContext.defaultParallelism:
            return df.repartition("qid")
        return df.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "qid")

    def no_pairs(self) -> DataFrame:
        return self.queries.sparkSession.createDataFrame([], "qid bigint, bid string")


def distinct_bids(bids: DataFrame, cfg: MatchConfig) -> DataFrame:
    b = bids.select(F.col(BID).alias("bid")).where(F.col("bid").isNotNull())
    if cfg.drop_empty_bids:
        b = b.where(F.length("bid") > 0)
    return b.distinct()


def _with_tokens(df: DataFrame, col: str, alias: str, cfg: MatchConfig) -> DataFrame:
    if cfg.token_mode == "lattice":
        if cfg.words is None:
            raise ValueError("token mode lattice needs a dictionary")
        return with_words(df, col, alias, cfg.words)
    return df.withColumn(alias, tokens(col, cfg.token_mode))


def prepare(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT) -> Sides:
    """Write both sides and count the bids. A NULL search word takes no part.

    Token sets of search words that are an expression of the word are not written.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in searches.columns])
    q, qid = searches.where(F.col(SEARCH).isNotNull()).select(F.col(SEARCH).alias("word"), row.alias("row")), F.monotonically_increasing_id().alias("qid")
    if cfg.token_mode in TOKEN_MODES:
        q = write_table(q.select(qid, "row"), "match_queries").withColumn("word", F.col(f"row.{SEARCH}")).withColumn("qt", tokens("word", cfg.token_mode))
    else:
        q = write_table(_with_tokens(q, "word", "qt", cfg).select(qid, "qt", "row"), "match_queries").withColumn("word", F.col(f"row.{SEARCH}"))
    q = q.select("qid", "word", "qt", "row")
    b = _with_tokens(distinct_bids(bids, cfg), "bid", "bt", cfg).withColumn("n", F.size("bt"))
    b = write_table(b, "match_bids")
    key_length = F.least(F.length("bid"), F.lit(cfg.gram))
    counts = b.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("bid")).alias("text_bytes"),
        F.sum("n").alias("tokens"), F.sum(F.octet_length(F.array_join("bt", ""))).alias("token_bytes"),
        F.sum(F.greatest(F.length("bid") - (cfg.gram - 1), F.lit(1))).alias("grams"),
        F.array_sort(F.collect_set(key_length)).alias("lengths"),
        F.count_if(F.col("n") == 0).alias("tokenless")).collect()[0]
    lengths = tuple(counts["lengths"])
    return Sides(cfg, q, b, counts["rows"], counts["text_bytes"] or 0, counts["tokens"] or 0, counts["token_bytes"] or 0,
                 counts["grams"] or 0, tuple(x for x in lengths if x > 0), counts["tokenless"] > 0, 0 in lengths, q.count())


def _frequencies(keys: DataFrame, vocab: DataFrame, col: str, within: bool) -> DataFrame:
    """Number of queries holding each bid-side key: ``(col, df)``.

    With a broadcast vocabulary the query keys are cut to it in place before
    the count. Otherwise they are counted first (combined map-side, so a hot
    key is one row per task) and only the counts meet the vocabulary.
    """
    if within:
        return keys.join(F.broadcast(vocab), col, "left_semi").groupBy(col).agg(F.count(F.lit(1)).alias("df"))
    return keys.groupBy(col).agg(F.count(F.lit(1)).alias("df")).join(vocab, col, "left_semi")


# --------------------------------------------------------------------------- candidates

def token_candidates(s: Sides, per_bid: int) -> DataFrame:
    """(qid, bid) of the pairs that share one of the bid's ``per_bid`` rarest tokens; some come twice."""
    bid_tok = s.bids.select("bid", F.explode("bt").alias("tok"))
    query_tok = s.queries.select("qid", F.explode("qt").alias("tok"))
    if s.cfg.rarest:
        vocab = bid_tok.select("tok").distinct()
        freq = _frequencies(query_tok.select("tok"), vocab, "tok", s.fits(s.tokens, s.token_bytes))
        rank = F.struct(F.coalesce(F.col("df"), F.lit(0)).alias("df"), F.col("tok"))
        # A group holds the tokens of one bid.
        index = (bid_tok.join(s.bounded(freq, s.tokens, s.token_bytes), "tok", "left").groupBy("bid")
                 .agg(F.slice(F.array_sort(F.collect_list(rank)), 1, per_bid).alias("r"))
                 .select("bid", F.explode("r.tok").alias("tok")))
    else:
        index = s.bids.select("bid", F.explode(F.slice("bt", 1, per_bid)).alias("tok"))
    index = s.bounded(index, per_bid * s.rows, per_bid * s.text_bytes + s.token_bytes)
    return query_tok.join(index, "tok").select("qid", "bid")


def _parts(length: int) -> int:
    """How thin substrings of this length are sampled; a bid of one and a half times the length has at least one."""
    return length // 2 + 1


_MOST = (1 << 31) - 1


def _grown_keys(s: Sides) -> tuple[DataFrame, dict[int, int]]:
    """((bid, key, hash, df), {length of keys: parts of their sample}): each non-empty bid with a substring that few queries hold, or with itself.

    A round counts the sampled substrings of one length (in bytes), in the bids
    that are still open and among the queries. A bid is closed with its rarest one
    if at most ``most_queries`` queries hold it (``df``); a bid too short for a
    sample is its own key (``df`` NULL), as whatever holds that is a match. The
    rest grows to twice the length.
    """
    g, still, closed, lengths = s.cfg.gram, s.bids.where(F.length("bid") > 0).select("bid"), [], {}
    while True:
        grams = write_table(sampled_substrings(still, "bid", g, _parts(g)), "match_grams")
        whole, grams = grams.where("whole"), grams.where("not whole")
        total = grams.count()
        keys = sampled_hashes(s.queries, "qid", "word", {g: _parts(g)}).select("hash")
        freq = write_table(_frequencies(keys, grams.select("hash").distinct(), "hash", s.fits(total, 8 * total)), "match_counts")
        held = freq.count()
        # Number of queries and place in one number: the aggregate then has a fixed width and keeps a row a bid, where one of texts sorts all substrings.
        rank = F.shiftleft(F.least(F.coalesce(F.col("df"), F.lit(0)), F.lit(_MOST)), 32) + F.col("place")
        best = (grams.join(s.bounded(freq, held, 16 * held), "hash", "left").groupBy("bid").agg(F.min(rank).alias("rank"), F.min_by("hash", rank).alias("hash"))
                .select("bid", F.col("rank").bitwiseAND(_MOST).cast("int").alias("place"), F.lit(g).alias("size"), "hash", F.shiftright("rank", 32).alias("df"))
                .withColumn("done", F.col("df") <= s.cfg.most_queries))
        short = whole.select("bid", "place", "size", "hash", F.lit(None).cast("bigint").alias("df"), F.lit(True).alias("done"))
        level = write_table(best.unionByName(short), "match_keys")
        counts = level.agg(F.collect_set(F.when(F.col("df").isNull(), F.col("size"))).alias("whole"),
                           F.count_if(F.col("done") & F.col("df").isNotNull()).alias("sampled"), F.count_if(~F.col("done")).alias("open")).collect()[0]
        if counts["sampled"]:
            lengths.setdefault(g, _parts(g))
        lengths |= dict.fromkeys(counts["whole"], 1)
        key = F.col("bid").cast("binary").substr(F.col("place") + 1, F.col("size")).cast("string")
        closed.append(level.where("done").select("bid", key.alias("key"), "hash", "df"))
        if not counts["open"]:
            break
        still, g = level.where("not done").select("bid"), 2 * g
    keys = closed[0]
    for more in closed[1:]:
        keys = keys.unionByName(more)
    return keys, lengths


def substring_candidates(s: Sides) -> DataFrame:
    """(qid, bid) of the pairs whose query holds the bid's key (or one of the same hash); each once."""
    if not s.lengths:
        return s.no_pairs()
    if not s.cfg.rarest:
        keyed = s.bids.where(F.length("bid") > 0).select("bid", F.substring("bid", 1, s.cfg.gram).alias("key"))
        held = F.array_distinct(F.concat(*[substrings(F.col("word"), n) for n in s.lengths]))
        return s.queries.select("qid", F.explode(held).alias("key")).join(s.bounded(keyed, s.rows, 2 * s.text_bytes), "key").select("qid", "bid")
    keyed, lengths = _grown_keys(s)
    keyed = keyed.where("df is null or df > 0").select("bid", "hash")    # the others no query holds
    held, found = sampled_hashes(s.queries, "qid", "word", lengths), keyed.count()
    if s.fits(found, s.text_bytes + 8 * found):
        return held.join(F.broadcast(keyed), "hash").select("qid", "bid")
    if s.fits(found, 8 * found):    # the hashes alone are little: only what meets a bid is sent to the join
        held = held.join(F.broadcast(keyed.select("hash").distinct()), "hash", "left_semi")
    return held.join(keyed, "hash").select("qid", "bid")


def tokenless_pairs(s: Sides) -> DataFrame:
    """(qid, bid) of every query with every bid that has no token, dealt out by a salt."""
    if not s.has_tokenless:
        return s.no_pairs()
    blank = s.bids.where("n = 0").select("bid", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return s.queries.select("qid", F.pmod("qid", F.lit(SALTS)).cast("int").alias("salt")).join(blank, "salt").select("qid", "bid")


def empty_pairs(s: Sides) -> DataFrame:
    """(qid, bid) of every query with the empty bid, if there is one."""
    return s.queries.select("qid", F.lit("").alias("bid")) if s.has_empty else s.no_pairs()


def _checked(s: Sides, pairs: DataFrame, *columns: str) -> DataFrame:
    """Pairs with the queries' and the bids' columns."""
    bids = s.bounded(s.bids, s.rows, s.text_bytes + s.token_bytes + 16 * s.tokens)
    return pairs.join(s.queries.select("qid", *columns), "qid").join(bids, "bid")


# --------------------------------------------------------------------------- pairs and tags

def _with_both_tokens(s: Sides, pairs: DataFrame, how: str) -> DataFrame:
    """(qid, word, qt, bid, bt): the search rows with their pairs, both dealt out by qid."""
    if s.cfg.token_mode in TOKEN_MODES:
        queries = s.by_row(s.queries.select("qid", "word")).withColumn("qt", tokens("word", s.cfg.token_mode))
        return queries.join(pairs, "qid", how).withColumn("bt", tokens("bid", s.cfg.token_mode))
    bids = s.bounded(s.bids, s.rows, s.text_bytes + s.token_bytes + 16 * s.tokens)
    return s.queries.select("qid", "word", "qt").join(pairs, "qid", how).join(bids.select("bid", "bt"), "bid", "left")


def _tagged(s: Sides, rows: bool = False) -> DataFrame:
    """(qid, word, bid, n, tags): every pair of the word-pair rules once, with all its tags.

    ``rows``: also the candidates that are no pair, and each search row without
    a candidate, with empty tags. Rows lie by qid if tokens are an expression.
    """
    # The empty bid has no token, so its pairs are among the tokenless ones.
    pairs = s.by_row(token_candidates(s, 2).unionByName(substring_candidates(s)).unionByName(tokenless_pairs(s))).distinct()
    both = _with_both_tokens(s, pairs, "left" if rows else "inner")
    both = both.withColumn("k", overlap(F.col("qt"), F.col("bt"))).withColumn("n", F.size("bt"))
    k = F.col("k")
    by_tokens = (F.when(k == F.col("n"), F.lit(TAG_ALL_TOKENS))
                 .when((k > 0) & (k == F.col("n") - 1), F.lit(TAG_ALL_BUT_ONE)))
    other = F.filter(F.array(F.when(F.col("word").contains(F.col("bid")), F.lit(TAG_CONTAINS)), by_tokens), lambda t: t.isNotNull())
    tags = (F.when(F.col("bid").isNull(), F.array().cast("array<int>"))
            .when(F.col("word") == F.col("bid"), F.array(F.lit(TAG_EQUAL))).otherwise(other))
    found = both.select("qid", "word", "bid", "n", tags.alias("tags"))
    return found if rows else found.where(F.size("tags") > 0)


def word_pairs(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT) -> DataFrame:
    """(search_word, bid_word, tag) rows of the word-pair rules (J5), for each search row.

    tag 1: equal; otherwise tag 2: query contains bid, and tag 3: all bid
    tokens in the query, else tag 4: all but one (at least one shared).
    """
    return _tagged(prepare(searches, bids, cfg)).select(
        F.col("word").alias(SEARCH), F.col("bid").alias(BID), F.explode("tags").alias("tag"))


PAIR_TYPE = "struct<bid_word:string,tag:int>"


def _with_pairs(s: Sides, pair: Column, agg: Callable[[str], Column], alias: str) -> DataFrame:
    """Each search row with an aggregate of its pairs, grouped where its pairs were checked."""
    found = _tagged(s, rows=True).select("qid", "word", "bid", F.explode_outer("tags").alias("tag"))
    found = found.select("qid", "word", F.when(F.col("tag").isNotNull(), pair).alias("p"))
    return found.groupBy("qid", "word").agg(agg("p").alias(alias)).select(F.col("word").alias(SEARCH), alias)


def _pair() -> Column:
    return F.struct(F.col("bid").alias(BID), F.col("tag").cast("int").alias("tag")).cast(PAIR_TYPE)


def word_pair_arrays(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT, sides: Sides | None = None) -> DataFrame:
    """Every search row with its sorted (bid_word, tag) list, empty without a pair."""
    return _with_pairs(sides or prepare(searches, bids, cfg), _pair(), lambda p: F.array_sort(F.collect_list(p)), "pairs")


def first_pairs(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT) -> DataFrame:
    """Every search row with the first pair of its list (NULL without one); no list is built."""
    return _with_pairs(prepare(searches, bids, cfg), _pair(), F.min, "first")


def bidlist_text(pairs: Column) -> Column:
    """``bid,tag bid,tag ...`` or ``""`` (C4)."""
    return F.array_join(F.transform(pairs, lambda x: F.concat_ws(",", x["bid_word"], x["tag"].cast("string"))), " ")


def bidlist_json(pairs: Column) -> Column:
    """``{"bidlist":[{"word":..,"tag":..},..]}`` or ``""`` when empty."""
    renamed = F.transform(pairs, lambda x: F.struct(x["bid_word"].alias("word"), x["tag"].alias("tag")))
    return F.when(F.size(pairs) > 0, F.to_json(F.struct(renamed.alias("bidlist")))).otherwise(F.lit(""))


BIDLIST_SCHEMA = "struct<bidlist:array<struct<word:string,tag:int>>>"


def bidlist_rows(df: DataFrame, json_col: str = "bidlist_json", keep: tuple[str, ...] = (SEARCH,)) -> DataFrame:
    """Read a rendered bid list back to (word, tag) rows."""
    parsed = F.from_json(F.col(json_col), BIDLIST_SCHEMA)
    return df.select(*keep, F.inline(parsed["bidlist"]))


def word_pair_list(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT, sides: Sides | None = None) -> DataFrame:
    """(search_word, bidlist) with the text rendering, ``""`` for no match."""
    return word_pair_arrays(searches, bids, cfg, sides).select(SEARCH, bidlist_text(F.col("pairs")).alias("bidlist"))


# --------------------------------------------------------------------------- match modes

def _keep(s: Sides, matched: DataFrame) -> DataFrame:
    """The search rows whose id is among the matched ones."""
    return s.queries.join(matched.select("qid").distinct(), "qid", "left_semi").select("row.*")


def exact_match(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT, sides: Sides | None = None) -> DataFrame:
    """Searches whose keyword equals a bid word (J1): a left-semi equi-join."""
    return searches.join(distinct_bids(bids, cfg).withColumnRenamed("bid", SEARCH), SEARCH, "left_semi")


def exact_include(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT, sides: Sides | None = None) -> DataFrame:
    """Searches that contain some bid word as a substring."""
    s = sides or prepare(searches, bids, cfg)
    if s.has_empty:
        return s.queries.select("row.*")
    pairs = substring_candidates(s).join(s.queries.select("qid", "word"), "qid")
    return _keep(s, pairs.where(F.col("word").contains(F.col("bid"))))


def token_include(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT, sides: Sides | None = None) -> DataFrame:
    """Searches whose token set holds all tokens of some bid (J3, "syno")."""
    s = sides or prepare(searches, bids, cfg)
    if s.has_tokenless:
        return s.queries.select("row.*")
    both = _checked(s, token_candidates(s, 1), "qt")
    return _keep(s, both.where(overlap(F.col("qt"), F.col("bt")) == F.col("n")))


def core_include(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT, sides: Sides | None = None) -> DataFrame:
    """Searches holding a one-token bid, or all but one token of a longer bid."""
    s = sides or prepare(searches, bids, cfg)
    both = _checked(s, token_candidates(s, 2), "qt")
    k, n = overlap(F.col("qt"), F.col("bt")), F.col("n")
    return _keep(s, both.where(((n == 1) & (k == 1)) | ((n > 1) & (k >= n - 1))))


def match(mode: str, bids: DataFrame, searches: DataFrame, cfg: MatchConfig = DEFAULT, sides: Sides | None = None) -> DataFrame:
    """Mode dispatch of the reference's entry point (F5). ``sides``: what ``prepare`` wrote of these inputs, to share it."""
    modes = {"exact-match": exact_match, "exact-include": exact_include, "syno-include": token_include,
             "core-include": core_include, "get-data": word_pair_list}
    if mode not in modes:
        raise ValueError(f"unknown match mode {mode!r}; expected one of {MODES}")
    return modes[mode](searches, bids, cfg, sides)


COVERAGE_MODES = MODES[:4]


def _mode_flags(s: Sides, *columns: Column) -> DataFrame:
    """Each search row with one boolean per mode and the ``columns`` of its row.

    All four modes come from the tags of a row: exact = tag 1, include = tag
    1|2, syno = tag 1|3, core = tag 1|3|4 with a bid of at least one token.
    """
    has = lambda *tags: F.bool_or(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])))
    core = F.bool_or(F.arrays_overlap("tags", F.array(*map(F.lit, (TAG_EQUAL, TAG_ALL_TOKENS, TAG_ALL_BUT_ONE)))) & (F.col("n") > 0))
    flags = dict(zip(COVERAGE_MODES, (has(TAG_EQUAL), has(TAG_EQUAL, TAG_CONTAINS), has(TAG_EQUAL, TAG_ALL_TOKENS), core), strict=True))
    found = _tagged(s).groupBy("qid").agg(*[flag.alias(mode) for mode, flag in flags.items()])
    kept = s.queries.select("qid", F.struct(*columns).alias("kept"))
    return kept.join(found, "qid", "left").select("kept.*", *[F.coalesce(f"`{mode}`", F.lit(False)).alias(mode) for mode in flags])


def coverage(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT) -> DataFrame:
    """Share of search volume each mode matches.

    -> (mode, matched_words, matched_cnt, total_words, total_cnt, pvr).
    """
    per_row = _mode_flags(prepare(searches, bids, cfg), F.col("row.cnt").cast("bigint").alias("cnt"))
    totals = per_row.agg(
        F.count(F.lit(1)).alias("total_words"), F.sum("cnt").alias("total_cnt"),
        F.array(*[F.struct(F.lit(mode).alias("mode"), F.count_if(F.col(f"`{mode}`")).alias("matched_words"),
                           F.sum(F.when(F.col(f"`{mode}`"), F.col("cnt")).otherwise(0)).alias("matched_cnt")) for mode in COVERAGE_MODES]).alias("m"))
    out = totals.select("total_words", "total_cnt", F.inline("m"))
    return out.select("mode", "matched_words", F.coalesce("matched_cnt", F.lit(0)).alias("matched_cnt"), "total_words",
                      F.coalesce("total_cnt", F.lit(0)).alias("total_cnt"), F.try_divide("matched_cnt", "total_cnt").alias("pvr"))


def coverage_of_days(searches: DataFrame, bids: DataFrame, cfg: MatchConfig = DEFAULT, day_col: str = "stat_date") -> DataFrame:
    """Coverage of each day and mode, to be stored and rolled up without matching again.

    ``searches``: (search_word, day, cnt), a word once a day. Different words
    are matched once, however many days hold them. -> (stat_date, mode,
    matched_cnt, total_cnt, matched_words, total_words, and sketches of the
    matched and of all words).
    """
    # A word's group holds an entry a day; it goes along with the word, so that its days needn't be joined to it again.
    day = F.struct(F.col(day_col).alias("stat_date"), F.col("cnt").cast("bigint").alias("cnt"))
    words = searches.where(F.col(SEARCH).isNotNull()).groupBy(SEARCH).agg(F.collect_list(day).alias("days"))
    flags = _mode_flags(prepare(words, bids, cfg), F.col("word").alias(SEARCH), F.col("row.days").alias("days"))
    joined = flags.select(SEARCH, F.inline("days"), *[f"`{m}`" for m in COVERAGE_MODES])
    # One group a day: with one a mode, every row came four times, and the sketches' aggregate sorts its rows beyond 128 groups.
    per_day = joined.groupBy("stat_date").agg(
        F.sum("cnt").alias("total_cnt"), F.count(F.lit(1)).alias("total_words"), F.hll_sketch_agg(SEARCH).alias("total_sketch"),
        F.array(*[F.struct(F.lit(m).alias("mode"), F.sum(F.when(F.col(f"`{m}`"), F.col("cnt")).otherwise(0)).alias("matched_cnt"),
                           F.count_if(F.col(f"`{m}`")).alias("matched_words"),
                           F.hll_sketch_agg(F.when(F.col(f"`{m}`"), F.col(SEARCH))).alias("matched_sketch")) for m in COVERAGE_MODES]).alias("m"))
    return per_day.select("stat_date", "total_cnt", "total_words", "total_sketch", F.inline("m")).select(
        "stat_date", "mode", "matched_cnt", "total_cnt", "matched_words", "total_words", "matched_sketch", "total_sketch")


def coverage_rollup(stored: DataFrame) -> DataFrame:
    """(level, period, mode, matched_cnt, total_cnt, pvr, matched_words, total_words) of stored days, by day, month and in all.

    Sums are exact. Numbers of different words over several days are estimates
    from the days' sketches (standard error about 1.6 %); a period is a day
    number, yyyymm, or 0.
    """
    days = stored.withColumn("month", F.floor(F.col("stat_date") / 100))
    sets = days.groupingSets([("stat_date", "mode"), ("month", "mode"), ("mode",)], "stat_date", "month", "mode").agg(
        F.grouping_id().alias("g"), F.sum("matched_cnt").alias("matched_cnt"), F.sum("total_cnt").alias("total_cnt"),
        F.hll_sketch_estimate(F.hll_union_agg("matched_sketch")).alias("matched_words"),
        F.hll_sketch_estimate(F.hll_union_agg("total_sketch")).alias("total_words"))
    level = F.when(F.col("stat_date").isNotNull(), "day").when(F.col("month").isNotNull(), "month").otherwise("all")
    return sets.select(level.alias("level"), F.coalesce("stat_date", "month", F.lit(0)).cast("bigint").alias("period"), "mode", "matched_cnt", "total_cnt",
                       F.try_divide("matched_cnt", "total_cnt").alias("pvr"), "matched_words", "total_words")
