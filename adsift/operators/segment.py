"""Word segmentation of unspaced text (C7): a learned dictionary and a best path through a word lattice.

``learn_words`` reads a log: n-grams of Han runs with their counts and their
neighbours on both sides. An n-gram is a word if it is frequent enough and if
what stands beside it varies enough, measured as the entropy of its left and
right neighbours (an occurrence at the edge of a run counts as a neighbour of
its own). Every single character of the log is a word. A word costs the
negative logarithm of its share, as a whole number of thousandths, so that
sums are exact in any order.

``with_words`` segments texts. Different runs are segmented once: their
substrings meet the dictionary in an equi-join (the lattice), and a fold over
the positions of a run keeps the cheapest path to each of the last positions
(``aggregate``; no Python). Of equally cheap paths the one with the shorter
last word wins. A character that the dictionary doesn't know costs half an
occurrence. Other runs of letters and digits are words as they are.

Keys of all shuffles are n-grams, runs or texts, combined before the shuffle
where they are counted; no dictionary goes through the driver. It is broadcast
only if its written size is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.strategy import fits_broadcast, write_table

# Fixed patterns: what is segmented, and what is a word as it is.
HAN_RUN = r"\p{IsHan}+"
OTHER_RUN = r"[\p{L}\p{N}&&[^\p{IsHan}]]+"

LONGEST = 4
LEAST_COUNT = 5
LEAST_ENTROPY = 0.5
COST_UNIT = 1000
SEPARATOR = "\u0001"


@dataclass(frozen=True)
class Dictionary:
    """``words``: (word, n, cost), written. ``unknown``: cost of a character that is not among them."""
    words: DataFrame
    longest: int
    unknown: int


def _characters(run: Column) -> Column:
    return F.split(run, "")


def _joined(characters: Column, start: Column, length: Column | int) -> Column:
    return F.array_join(F.slice(characters, start, length), "")


def neighbours(log: DataFrame, col: str, weight: str | None = None, longest: int = LONGEST) -> DataFrame:
    """(word, side, beside, c): how often each n-gram has which character beside it, null at the edge of a run."""
    runs = (log.select(F.explode(F.regexp_extract_all(F.col(col), F.lit(HAN_RUN), F.lit(0))).alias("run"),
                       (F.col(weight) if weight else F.lit(1)).cast("long").alias("w"))
            .groupBy("run").agg(F.sum("w").alias("w")))
    chars = runs.select("w", _characters(F.col("run")).alias("ch")).withColumn("m", F.size("ch"))

    def gram(start: Column, length: Column) -> Column:
        word = _joined(F.col("ch"), start, length)
        return F.array(F.struct(word.alias("word"), F.lit("L").alias("side"), F.get("ch", start - 2).alias("beside")),
                       F.struct(word.alias("word"), F.lit("R").alias("side"), F.get("ch", start + length - 1).alias("beside")))

    grams = F.flatten(F.flatten(F.transform(F.sequence(F.lit(1), F.col("m")), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(longest), F.col("m") - i + 1)), lambda n: gram(i, n)))))
    return chars.select("w", F.explode(grams).alias("g")).groupBy("g.word", "g.side", "g.beside").agg(F.sum("w").alias("c"))


def learn_words(log: DataFrame, col: str, weight: str | None = None, longest: int = LONGEST,
                least_count: int = LEAST_COUNT, least_entropy: float = LEAST_ENTROPY) -> Dictionary:
    """The dictionary of a log whose ``col`` holds texts, each as often as ``weight`` says."""
    c, on = F.col("c"), lambda s: F.col("side") == s
    spread = lambda s: F.coalesce(F.sum(F.when(on(s) & F.col("beside").isNotNull(), c * F.log(c))), F.lit(0.0))
    told = neighbours(log, col, weight, longest).groupBy("word").agg(
        F.sum(F.when(on("L"), c)).alias("n"), spread("L").alias("left"), spread("R").alias("right"))
    entropy = F.log("n") - F.greatest("left", "right") / F.col("n")
    words = write_table(told.where((F.length("word") == 1) | ((F.col("n") >= least_count) & (entropy >= least_entropy)))
                        .select("word", "n"), "words")
    total = words.agg(F.sum("n")).collect()[0][0] or 1
    cost = lambda n: F.round(F.log(F.lit(total) / n) * COST_UNIT).cast("long")
    unknown = words.sparkSession.range(1).select(cost(F.lit(0.5))).collect()[0][0]
    return Dictionary(words.withColumn("cost", cost(F.col("n"))), longest, unknown)


def _place(end: Column, length: Column | int, longest: int) -> Column:
    """Place (from 0) of (end, length) in a lattice in order of both: ``least(end, longest)`` lengths for each end."""
    full = longest * (longest - 1) // 2
    before = F.when(end <= longest, (end * (end - 1) / 2).cast("int")).otherwise(F.lit(full) + (end - longest) * longest)
    return before + length - 1


def best_paths(runs: DataFrame, dictionary: Dictionary) -> DataFrame:
    """(run, words) of different non-empty ``runs`` (run): the words of the cheapest path in order."""
    longest = dictionary.longest
    chars = runs.select("run", _characters(F.col("run")).alias("ch"))
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.size("ch")), lambda e: F.transform(
        F.sequence(F.lit(1), F.least(e, F.lit(longest))),
        lambda n: F.struct(e.alias("end"), n.alias("len"), _joined(F.col("ch"), e - n + 1, n).alias("word")))))
    words = dictionary.words.select("word", "cost")
    known = F.broadcast(words) if fits_broadcast(words) else words
    edges = chars.select("run", F.explode(grams).alias("g")).select("run", "g.end", "g.len", "g.word").join(known, "word", "left")
    # A group holds the substrings of one run.
    lattice = edges.groupBy("run").agg(F.transform(F.array_sort(F.collect_list(F.struct("end", "len", "cost"))), lambda x: x["cost"]).alias("costs"))
    lattice = lattice.select("run", "costs", _characters(F.col("run")).alias("ch"))
    step_type = "struct<cost:bigint,len:int,path:string>"

    def step(held: Column, e: Column) -> Column:
        """The cheapest paths to the last positions, with that to position ``e`` behind them."""
        ways = []
        for n in range(1, longest + 1):
            cost = F.get("costs", _place(e, n, longest))
            cost = F.coalesce(cost, F.lit(dictionary.unknown)) if n == 1 else cost
            before = F.get(held, F.size(held) - n)
            ways.append(F.when((e >= n) & cost.isNotNull(), F.struct((before["cost"] + cost).alias("cost"), F.lit(n).alias("len"), before["path"].alias("path"))))
        best = F.least(*ways) if len(ways) > 1 else ways[0]
        path = F.concat(best["path"], F.lit(SEPARATOR), _joined(F.col("ch"), e - best["len"] + 1, best["len"]))
        now = F.struct(best["cost"].alias("cost"), best["len"].alias("len"), path.alias("path")).cast(step_type)
        kept = F.slice(held, F.greatest(F.size(held) - (longest - 2), F.lit(1)), longest)
        return F.concat(kept, F.array(now)) if longest > 1 else F.array(now)

    start = F.array(F.struct(F.lit(0).cast("long").alias("cost"), F.lit(0).alias("len"), F.lit("").alias("path")).cast(step_type))
    folded = F.aggregate(F.sequence(F.lit(1), F.size("ch")), start, step, lambda held: F.element_at(held, -1)["path"])
    return lattice.select("run", F.split(F.substring(folded, F.lit(2), F.length(folded)), SEPARATOR).alias("words"))


def with_words(df: DataFrame, col: str, alias: str, dictionary: Dictionary) -> DataFrame:
    """``df`` with the different words of its texts as ``alias``; NULL stays NULL."""
    texts = df.select(F.col(col).alias("_text")).where(F.col("_text").isNotNull()).distinct()
    runs = texts.select("_text", F.explode(F.array_distinct(F.regexp_extract_all("_text", F.lit(HAN_RUN), F.lit(0)))).alias("run"))
    paths = best_paths(runs.select("run").distinct(), dictionary)
    # A group holds the runs of one text.
    held = runs.join(paths, "run").groupBy("_text").agg(F.flatten(F.collect_list("words")).alias("_words"))
    others = F.regexp_extract_all(F.col(col), F.lit(OTHER_RUN), F.lit(0))
    words = F.array_distinct(F.concat(others, F.coalesce("_words", F.array().cast("array<string>"))))
    return df.join(held, F.col(col) == F.col("_text"), "left").withColumn(alias, words).drop("_text", "_words")
