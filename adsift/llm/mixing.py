"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the
source's target over its size. The documents of a source stand in order of
size (so that the sample holds small and large ones alike), their expected
copies are prefix-summed, one random offset of the source is added, and a
document is emitted once for each integer boundary that its interval crosses.

Positions inside a source come from a range-partitioned table: counts of each
(partition, source) are prefix-summed, and positions are counted inside a
partition. So no task holds a whole source, however large its share.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; a source of size 0 has target 0 and no copies; repeated rows
are documents of their own; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..plans.strategy import write_table
from .shared import FILE, ROW, as_scan, with_row_key

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) -> the same plus target.

    Shares of the whole follow the weights; a source takes at most ``most``
    times its size and the others share the excess by weight. In order of
    cap over weight, the first source whose share at the level that the capped
    ones before it leave is within its cap sets the level for all after it.
    One row per source: the only table that is ordered in one task.
    """
    by_source = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = W.partitionBy(F.lit(1))
    ranked = (sizes
              .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                 ((F.row_number().over(by_source) - 1) % len(weights) + 1).cast("int")))
              .withColumn("cap", F.col("source_size") * most)
              .withColumn("k", F.row_number().over(by_ratio))
              .withColumn("capped", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
              .withColumn("whole", F.sum("source_size").over(everything))
              .withColumn("level", (F.col("whole") - F.col("capped")).cast("double") / F.col("open"))
              .withColumn("first", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("k", "level")))
                          .over(everything)))
    target = F.when(F.col("k") < F.col("first.k"), F.col("cap").cast("double")).otherwise(F.col("first.level") * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: str = SEED) -> Column:
    """The source's random offset in [0, 1)."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """One row per document: its place, id, source, size, source_size, target and copies."""
    slim = with_row_key(docs, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        word_count(F.col(text_col)).alias("size"))
    # Written first, as range partitioning reads its input twice: once to find the ranges.
    slim = write_table(slim, "mix-sizes")
    # Written with the partition numbers, so that both uses below see the same ones.
    ranged = write_table(slim.repartitionByRange(F.col("source").asc_nulls_last(), "size", F.col("doc_id").asc_nulls_last(), FILE, ROW)
                         .withColumn("part", F.spark_partition_id()), "mix-ranged")
    counts = ranged.groupBy("part", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    before = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(F.col("part").alias("p"), F.col("source").alias("s"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    goal = targets(counts.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    goal = goal.withColumnRenamed("source", "g")
    starts = starts.join(goal, F.col("s").eqNullSafe(F.col("g")))
    inside = W.partitionBy("part", "source").orderBy("size", F.col("doc_id").asc_nulls_last(), FILE, ROW)
    placed = (ranged.withColumn("i", F.row_number().over(inside))
              .join(starts, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    last = F.col("start") + F.col("i")
    placed = placed.withColumn("rate", rate).withColumn("u", offset(F.col("source"), seed))
    copies = (F.floor(F.col("rate") * last + F.col("u")) - F.floor(F.col("rate") * (last - 1) + F.col("u"))).cast("long")
    return placed.select(FILE, ROW, "doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, all columns, each as often as the mix takes it."""
    docs = as_scan(docs)
    taken = mix(docs, **options).where("copies > 0").select(F.col(FILE).alias("f"), F.col(ROW).alias("r"), "copies")
    rows = with_row_key(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    joined = rows.join(taken, (F.col(FILE) == F.col("f")) & (F.col(ROW) == F.col("r")))
    repeated = joined.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return repeated.select("doc.*")
