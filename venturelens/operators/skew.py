"""Building blocks that keep hot keys from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name.

    Turns off ``spark.sql.unionOutputPartitioning`` for the session: in Spark 4.1 a union of inputs
    that were repartitioned by the same key claims that partitioning, but may be executed as a plain
    union, and an aggregate by the key then yields a key several times.
    """
    frames[0].sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    return reduce(DataFrame.unionByName, frames)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartitions a source with fewer splits than cores, ahead of costly per-row work.

    So few splits also mean little data (splits are at most maxPartitionBytes); a source with
    enough splits stays as it is and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def salt_of(parts: Sequence[str], salts: int) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(salts)).cast("int")


def keyed_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join left to the engine: statistics decide on a broadcast, and the adaptive skew join splits a hot key of ``big``.

    ``how`` is inner, left, left_semi or left_anti: for all of them the left side can be split. No job runs while the plan is built.
    """
    return big.join(small, list(keys), how)


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread: Sequence[str],
    rank: str = "rank",
    salts: int = 16,
) -> DataFrame:
    """The first ``n`` rows per key in ``order`` (which must end in a unique column).

    Two rounds: ``n`` per (key, salt), then ``n`` per key. Map tasks keep ``n`` rows per group
    before each shuffle (WindowGroupLimit), so the last task of a hot key sees salts x n rows.
    ``salts=1`` is the single round, for input that is already small per key.
    """
    cut = df
    if salts > 1:
        first = Window.partitionBy(*keys, "_salt").orderBy(*order)
        cut = (
            df.withColumn("_salt", salt_of(spread, salts))
            .withColumn("_r", F.row_number().over(first))
            .filter(F.col("_r") <= n)
            .drop("_r", "_salt")
        )
    last = Window.partitionBy(*keys).orderBy(*order)
    return cut.withColumn(rank, F.row_number().over(last)).filter(F.col(rank) <= n)
