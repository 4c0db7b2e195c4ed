"""Physical distribution chosen by the user (P*, G1).

Content never changes; only which task holds a row.  ``replicate`` copies
each row once per target task (bounded by ``n``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.functions.hashing import java_hash


def shuffle_random(df: DataFrame, n: int | None = None, seed: int = 42) -> DataFrame:
    """Random target task per row (``n`` defaults to the shuffle
    partitions of the session)."""
    return df.repartition(n, F.rand(seed)) if n else df.repartition(F.rand(seed))


def rebalance(df: DataFrame, n: int | None = None) -> DataFrame:
    """Round robin - evens out skewed inputs."""
    if n is None:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n)


def rescale(df: DataFrame, n: int | None = None) -> DataFrame:
    """Local merge of neighbouring partitions, no shuffle (only reduces); by
    default to half the session's shuffle partitions."""
    if n is None:
        n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 2)
    return df.coalesce(n)


def replicate(df: DataFrame, n: int, name: str = "task") -> DataFrame:
    """Every row to every one of ``n`` tasks (tagged with its target).  The
    output is ``n`` times the input; a growing table is better joined."""
    d = df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return by_id(d, n, name)


def by_id(df: DataFrame, n: int, col: str) -> DataFrame:
    """Rows go to the partition whose number is ``col`` (0..n-1)."""
    if hasattr(df, "repartitionById"):
        return df.repartitionById(n, F.col(col))
    return df.repartitionByRange(n, col)


def custom(df: DataFrame, key: str, n: int | None = None, name: str = "slot") -> DataFrame:
    """User partitioner ``pmod(java_hash(key), n)`` (the reference's
    ``hashCode % n`` can be negative; ``pmod`` cannot); ``n`` defaults to the
    session's shuffle partitions."""
    if n is None:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.withColumn(name, F.pmod(java_hash(key), F.lit(n)))
    return by_id(d, n, name)
