"""Spelling variant grouping by pivotal grams.

Words are the different runs of letters that occur often enough. Two words are
near if one inserted, deleted or replaced code point makes one the other.

* Bigrams have one global order, from rare to frequent. A word's gram prefix is
  its three rarest bigrams (by place; all bigrams as rare as the third belong to
  it). Two disjoint ones among the three rarest, the rarest such pair by dynamic
  programming over places, are its pivots.
* One edit destroys at most one of two disjoint bigrams. So of two near words,
  the one whose prefix ends earlier in the order has a pivot that stands in the
  other's prefix: pivots are joined with gram prefixes of words that end as late
  or later.
* Position limits: the edit lies wholly before or behind a pivot that survives.
  Behind it, the pivot's place and all before it are the same. Before it, its
  place moves with the length and all behind it is the same. Of the side with
  the edit, one half is the same, the near or the far one. The join key holds
  gram, place, length, the side without the edit and such a half, so that a
  frequent gram, or words that begin alike, don't gather in one key.
* Candidates are verified in the join by exact edit distance.

A word's form is its most frequent near word (ties: the smallest), if that is
often enough more frequent; roots follow forms from the words that have none,
level by level. A form is at least ``ratio`` times as frequent, so the levels
are at most the logarithm of the largest count, and a word is the form of no
more words than it can have near ones.

The number of different bigrams is bounded by the alphabet (90 squared), so
their order is broadcast. Counts are combined before they are shuffled.

Defined cases: null and empty texts have no runs; runs of any length in very
long texts are read whole; rows with the same id and run read it alike, each
occurrence counts; a null id is an empty one in the checksum; ties go to the
smaller word; no rows, or no word often enough, give no rows; other columns
don't matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..plans.strategy import write_table
from .urls import LOWER, UPPER

RUN = "[a-zÀ-ÿ]+"      # after A-Z are lower-cased
SLIP = 97                         # of so many runs, one loses a code point
LEAST_CHARS, LEAST_COUNT = 5, 3
RATIO = 2
EDITS = 1
GRAM = 2
PREFIX = GRAM * EDITS + 1
# (change of length, change of place, unchanged side) from a word with a surviving pivot to its near word.
MOVES = ((0, 0, "L"), (0, 0, "R"), (1, 0, "L"), (1, 1, "R"), (-1, 0, "L"), (-1, -1, "R"))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def read_word(doc_id: Column, run: Column, slip: int = SLIP) -> Column:
    """The run, or the run less one code point where the checksum of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % slip == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough."""
    runs = F.filter(F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), F.lit(RUN), F.lit(0)),
                    lambda r: F.length(r) >= least_chars)
    found = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))
    words = found.select(read_word(F.col("id"), F.col("run"), slip).alias("word")).where(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _bigrams(word: Column) -> Column:
    places = F.sequence(F.lit(0), F.length(word) - GRAM)
    return F.transform(places, lambda p: F.struct(F.substring(word, p + 1, F.lit(GRAM)).alias("gram"), p.alias("place")))


def gram_order(words: DataFrame) -> DataFrame:
    """(gram, rank, weight): rank from rare to frequent, weight the places that hold it. As many rows as the alphabet has pairs."""
    grams = words.select(F.explode(_bigrams(F.col("word"))).alias("g")).groupBy("g.gram").agg(F.count(F.lit(1)).alias("weight"))
    return grams.select("gram", "weight", F.row_number().over(W.orderBy("weight", "gram")).alias("rank"))


def _disjoint_pair(grams: Column) -> Column:
    """The two disjoint grams of least weight in all, by dynamic programming over grams in order of place.

    The state holds the best single gram so far, the best one without the last gram (which may overlap
    the next), the last place and the best pair.
    """
    one = "struct<weight:bigint,rank:int,place:int>"
    pair = f"struct<weight:bigint,a:{one},b:{one}>"

    def step(state: Column, g: Column) -> Column:
        single = F.struct(g["weight"].alias("weight"), g["rank"].alias("rank"), g["place"].alias("place"))
        ahead = F.when(state["last"] == g["place"] - 1, state["without"]).otherwise(state["best"])
        both = F.when(ahead.isNotNull(), F.struct((ahead["weight"] + g["weight"]).alias("weight"), ahead.alias("a"), single.alias("b")))
        return F.struct(F.least(state["best"], single).cast(one).alias("best"), state["best"].alias("without"),
                        g["place"].alias("last"), F.least(state["pair"], both).cast(pair).alias("pair"))

    start = F.struct(F.lit(None).cast(one).alias("best"), F.lit(None).cast(one).alias("without"),
                     F.lit(None).cast("int").alias("last"), F.lit(None).cast(pair).alias("pair"))
    return F.aggregate(grams, start, step, lambda s: F.array(s["pair"]["a"], s["pair"]["b"]))


def gram_prefixes(words: DataFrame, order: DataFrame) -> DataFrame:
    """(word, n, last, prefix, pivots): rank of the prefix's last gram, its grams, and the two pivots."""
    held = words.select("word", "n", F.explode(_bigrams(F.col("word"))).alias("g")).select("word", "n", "g.gram", "g.place")
    ranked = held.join(F.broadcast(order), "gram")
    # A group holds the bigrams of one word.
    grams = ranked.groupBy("word", "n").agg(F.array_sort(F.collect_list(F.struct("rank", "place", "weight"))).alias("grams"))
    rarest = F.array_sort(F.transform(F.slice("grams", 1, PREFIX), lambda g: F.struct(g["place"].alias("place"), g["rank"].alias("rank"), g["weight"].alias("weight"))))
    last = F.element_at("grams", PREFIX)["rank"]
    return grams.select("word", "n", last.alias("last"), F.filter("grams", lambda g: g["rank"] <= last).alias("prefix"),
                        _disjoint_pair(rarest).alias("pivots"))


def _sides(word: Column, place: Column, side: str) -> tuple[Column, Column]:
    """(unchanged side, side with the edit) of the gram at ``place``."""
    before, behind = F.left(word, place), F.substring(word, place + GRAM + 1, F.length(word))
    return (before, behind) if side == "L" else (behind, before)


def _keys(g: Column, word: Column, side: str, d_length: int, d_place: int, halves: Column) -> list[Column]:
    """Join keys for the gram ``g`` at its place in a word of ``d_length`` more characters whose edited side was cut after ``halves``
    characters from the gram: one for the near and one for the far half being the same."""
    same, edited = _sides(word, g["place"], side)
    near, far = halves["near"], halves["far"]
    parts = (F.left(edited, near), F.right(edited, far)) if side == "L" else (F.right(edited, near), F.left(edited, far))
    at = (g["rank"], (g["place"] + d_place).cast("int"), (F.length(word) + d_length).cast("int"), F.lit(side), same)
    return [F.xxhash64(*at, F.lit(kind), part) for kind, part in zip(("near", "far"), parts, strict=True)]


def _halves(m: Column) -> Column:
    """Lengths of the near and the far half of an edited side of ``m`` characters."""
    near = F.floor(m / 2).cast("int")
    return F.struct(near.alias("near"), (m - near).cast("int").alias("far"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) of the near words a < b of ``words`` (word, n); words of four code points or more."""
    told = write_table(gram_prefixes(words, gram_order(words)), "spelling-prefixes")
    word = F.col("word")

    def edited(g: Column, side: str) -> Column:
        return F.length(_sides(word, g["place"], side)[1])

    def asks(g: Column) -> Column:
        """Keys of the near words in which the pivot ``g`` survives; without an edited side there is only an insertion."""
        return F.flatten(F.array(*[F.when((edited(g, side) > 0) | F.lit(dl > 0), F.array(*_keys(g, word, side, dl, dp, _halves(edited(g, side)))))
                                   .otherwise(F.array().cast("array<bigint>")) for dl, dp, side in MOVES]))

    def answers(g: Column) -> Column:
        """Keys under which a word is found by its gram ``g``: the other's edited side is one shorter, as long, or one longer."""
        return F.array(*[k for side in "LR" for dl in (-1, 0, 1)
                         for k in _keys(g, word, side, 0, 0, _halves(F.greatest(edited(g, side) - dl, F.lit(0))))])

    asked = told.select(F.col("word").alias("p_word"), F.col("n").alias("p_n"), F.col("last").alias("p_last"),
                        F.explode(F.array_distinct(F.flatten(F.transform("pivots", asks)))).alias("key"))
    known = told.select("word", "n", "last", F.explode(F.array_distinct(F.flatten(F.transform("prefix", answers)))).alias("key"))
    met = asked.join(known, "key").where((F.col("p_last") <= F.col("last")) & (F.col("p_word") != F.col("word"))
                                         & (F.levenshtein("p_word", "word", EDITS) == EDITS))
    smaller = F.col("p_word") < F.col("word")
    return met.select(F.when(smaller, F.col("p_word")).otherwise(word).alias("a"), F.when(smaller, F.col("p_n")).otherwise(F.col("n")).alias("a_n"),
                      F.when(smaller, word).otherwise(F.col("p_word")).alias("b"), F.when(smaller, F.col("n")).otherwise(F.col("p_n")).alias("b_n")).distinct()


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) of ``words`` (word, n); form and form_n null without a form."""
    near = near_pairs(words).select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))).alias("x"))
    best = near.groupBy("x.word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("x.other_n")).alias("minus"), F.col("x.other").alias("other"))).alias("best"))
    best = best.select(F.col("word").alias("w"), "n_near", F.col("best.other").alias("other"), (-F.col("best.minus")).alias("other_n"))
    takes = F.col("other_n") >= ratio * F.col("n")
    return words.join(best, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("other")).alias("form"), F.when(takes, F.col("other_n")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last word on the way of forms."""
    links = write_table(formed.where(F.col("form").isNotNull()).select("word", "form"), "spelling-links")
    heads = links.select(F.col("form").alias("root")).distinct().join(links, F.col("root") == F.col("word"), "left_anti")
    known = heads.select(F.col("root").alias("at"), "root")
    found = links.limit(0).select("word", F.col("form").alias("root"))
    while True:
        level = write_table(links.join(known, F.col("form") == F.col("at")).select("word", "root"), "spelling-roots")
        if level.isEmpty():
            return found
        found = found.unionByName(level)
        known = level.select(F.col("word").alias("at"), "root")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
          ratio: int = RATIO, slip: int = SLIP) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    if least_chars < 2 * GRAM:
        raise ValueError("words need four code points or more, so that two disjoint bigrams are among their three rarest")
    if ratio < 2:
        raise ValueError("a form has to be at least twice as frequent")
    words = write_table(count_words(docs, id_col, text_col, least_chars, least_count, slip), "spelling-words")
    formed = write_table(forms(words, ratio), "spelling-forms")
    ends = roots(formed).select(F.col("word").alias("w"), "root")
    return formed.join(ends, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
