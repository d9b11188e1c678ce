"""Mergeable samples (S5, L1): the rows of the smallest keyed hashes, by stratum, with weights.

A row's hash is a number in (0, 1] that its key alone decides; its rank is the
hash over its weight, so heavy rows come first. A sample holds the ``k + 1``
rows of the smallest ranks of each stratum. The same rows are found in any
order and any split of the input, and the samples of parts (days) merge into
the sample of the whole: a key that is among the smallest of all is among the
smallest of its part. The last row is the threshold: ``finished`` drops it
and gives each row the weight max(own weight, 1 / threshold) (priority
sampling), whose sums estimate those of all rows without bias.

Each task keeps its own ``k + 1`` rows per stratum before the shuffle (a row
number that is cut at once), so a stratum of a third of all rows sends as
little as any other.

Defined cases: a NULL key takes no part; a key that comes twice is one row, the
one of the largest ``version`` (ties: any of equal ones, by all columns);
weights belong to the key, not to a version of it; rows of weight NULL, zero
or less take no part; a stratum of at most ``k`` rows is whole, each row with its
own weight; NULL is a stratum.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_DIGITS = 13
RANK = "sample_rank"


def keyed_hash(key: Column, seed: str) -> Column:
    """A number in (0, 1] from the key's text."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key.cast("string"))), 1, HEX_DIGITS)
    return (F.conv(digits, 16, 10).cast("bigint") + 1) / F.lit(2.0 ** (4 * HEX_DIGITS))


def sample(df: DataFrame, key: str, k: int, strata: Sequence[str] = (), weight: str | None = None,
           version: str | None = None, seed: str = "sample-1") -> DataFrame:
    """``df``'s rows of the ``k + 1`` smallest ranks of each stratum, with ``sample_rank``."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    ranked = df.drop(RANK).where(F.col(key).isNotNull() & (w > 0)).withColumn(RANK, keyed_hash(F.col(key), seed) / w)
    return _smallest(ranked, key, k, strata, version)


def merged(samples: Sequence[DataFrame], key: str, k: int, strata: Sequence[str] = (), version: str | None = None) -> DataFrame:
    """The sample of the union, from the samples of its parts."""
    return _smallest(reduce(DataFrame.unionByName, samples), key, k, strata, version)


def _smallest(ranked: DataFrame, key: str, k: int, strata: Sequence[str], version: str | None) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in ranked.columns]
    last = ([F.col(version).desc()] if version else []) + columns
    # Equal keys share a rank, so they stand together: cut by dense rank first, then take one row of each key.
    places = Window.partitionBy(*strata).orderBy(RANK, key)
    cut = ranked.withColumn("_place", F.dense_rank().over(places)).where(F.col("_place") <= k + 1)
    one = Window.partitionBy(*strata, "_place").orderBy(*last)
    return cut.withColumn("_one", F.row_number().over(one)).where("_one = 1").drop("_place", "_one")


def finished(sampled: DataFrame, key: str, k: int, strata: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """The ``k`` rows of each stratum with ``sample_weight``."""
    own = F.col(weight).cast("double") if weight else F.lit(1.0)
    whole = Window.partitionBy(*strata).orderBy(RANK, key)    # k + 1 rows
    placed = sampled.withColumn("_place", F.row_number().over(whole)).withColumn(
        "_threshold", F.max(F.when(F.col("_place") == k + 1, F.col(RANK))).over(Window.partitionBy(*strata)))
    return (placed.where(F.col("_place") <= k)
            .withColumn("sample_weight", F.coalesce(F.greatest(own, 1 / F.col("_threshold")), own)).drop("_place", "_threshold", RANK))
