"""Keyed state in batch form (K1, K6, K7, T5).

Each reproduces what a keyed process function with that state emits per
row, in arrival order, using two-level scans (see ``scan``) so that no key
is ever sorted whole in one task.  The streaming forms are in
``eventide.streaming.processors``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventide.functions.hashing import java_hash
from eventide.operators import scan
from eventide.sources.sensor import epoch_us


def jump_alert(df: DataFrame, keys: Sequence[str], value: str, threshold: int = 10,
               order: str = "seq", default: int = 0) -> DataFrame:
    """K1: value state holding the previous value (``default`` before the
    first); rows whose value differs from it by more than ``threshold``."""
    d = scan.previous(df, keys, order, F.col(value), "last_value")
    d = d.withColumn("last_value", F.coalesce(F.col("last_value"), F.lit(default)))
    return d.filter(F.abs(F.col(value) - F.col("last_value")) > threshold)


def ttl_state(df: DataFrame, keys: Sequence[str], value: str, ts: str, ttl_us: int,
              refresh_on_read: bool, write_when=None, order: str = "seq",
              name: str = "state") -> DataFrame:
    """K6: value state with a time-to-live; every row first reads the state
    (``name``; expired values are never returned), then writes its value
    when ``write_when`` holds.  A value written or refreshed at ``t`` expires
    at ``t + ttl`` (a gap of exactly ttl has expired).

    * write-only refresh: the latest earlier write, if ``now < write + ttl``;
    * read-and-write refresh: every row reads, so the value lives as long as
      consecutive rows of the key are closer than ttl: the latest earlier
      write, if no gap >= ttl has ended since (one scan finds the gaps, one
      the latest write and the latest gap).
    Event time stands in for the processing clock.
    """
    write_when = write_when if write_when is not None else F.col(value) > 10
    t = epoch_us(ts)
    d = df.withColumn("__t", t)
    if not refresh_on_read:
        d = scan.running(d, keys, order, {"__w": ("max", F.when(
            write_when, F.struct(F.col(order).alias("o"), F.col("__t").alias("t"),
                                 F.col(value).alias("v"))))}, exclusive=True)
        alive = F.col("__t") < F.col("__w.t") + F.lit(ttl_us)
        return d.withColumn(name, F.when(alive, F.col("__w.v"))).drop("__t", "__w")
    d = scan.previous(d, keys, order, F.col("__t"), "__prev_t")
    d = d.withColumn("__cut", F.col("__t") - F.col("__prev_t") >= ttl_us)
    d = scan.running(d, keys, order, {
        "__w": ("max", F.when(write_when, F.struct(F.col(order).alias("o"), F.col(value).alias("v")))),
        "__c": ("max", F.when(F.col("__cut"), F.col(order)))}, exclusive=True)
    # the latest write counts unless the key was silent for ttl since, this row's own gap included
    alive = ~F.coalesce("__cut", F.lit(False)) & (F.col("__c").isNull() | (F.col("__w.o") >= F.col("__c")))
    return d.withColumn(name, F.when(alive, F.col("__w.v"))).drop("__t", "__prev_t", "__cut", "__w", "__c")


KEY_GROUPS = 128


def key_group(key: str, key_groups: int = KEY_GROUPS):
    """Fixed shard of a key: ``pmod(java_hash(key), key_groups)``."""
    return F.pmod(java_hash(key), F.lit(key_groups))


def slot_of_group(kg, slots: int, key_groups: int = KEY_GROUPS):
    """Slot owning a key group when there are ``slots`` slots (contiguous
    ranges of groups, so a new slot count moves whole groups)."""
    return F.floor(kg * F.lit(slots) / F.lit(key_groups)).cast("int")


def durable_count(df: DataFrame, key: str, slots: int, key_groups: int = KEY_GROUPS) -> DataFrame:
    """K7 re-aimed: the count per slot plus the total (slot null).  Counts are
    kept per fixed key group; a slot is a range of groups, so restarting
    with a different slot count just regroups the same checkpointed group
    counts (``streaming.operators.key_group_counts``).  Rows are counted per key
    first, so only the different keys are hashed."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    return slot_counts(per_key.select(key_group(key, key_groups).alias("kg"), "cnt"), slots, key_groups)


def slot_counts(group_counts: DataFrame, slots: int, key_groups: int = KEY_GROUPS) -> DataFrame:
    """Regroup per-key-group counts (``kg``, ``cnt``) into ``slots`` slots."""
    d = group_counts.withColumn("slot", slot_of_group(F.col("kg"), slots, key_groups))
    return d.rollup("slot").agg(F.sum("cnt").alias("cnt"))


def changelog(df: DataFrame, keys: Sequence[str], value: str, order: str = "seq") -> DataFrame:
    """T5: the changelog of ``SELECT key, sum(value) GROUP BY key``: ``+I``
    for a key's first row, then ``-U`` old / ``+U`` new when the sum changes
    (an unchanged sum emits nothing).  Adds ``op_no`` (0/1 inside a row)."""
    d = scan.running(df, keys, order, {"__sum": ("sum", F.col(value).cast("bigint")),
                                      "__n": ("count", F.lit(1))})
    old = F.col("__sum") - F.col(value).cast("bigint")
    ops = (F.when(F.col("__n") == 1, F.array(F.struct(F.lit("+I").alias("op"), F.col("__sum").alias("v"))))
            .when(F.col(value) != 0, F.array(F.struct(F.lit("-U").alias("op"), old.alias("v")),
                                              F.struct(F.lit("+U").alias("op"), F.col("__sum").alias("v"))))
            .otherwise(F.array().cast("array<struct<op:string,v:bigint>>")))
    return d.select(*keys, order, F.posexplode(ops).alias("op_no", "__c")) \
        .select(*keys, order, "op_no", F.col("__c.op").alias("op"), F.col("__c.v").alias(f"{value}_sum"))
