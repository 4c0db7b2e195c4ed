"""K7: operator state handed from a stopped query to a new one.

A checkpoint can be restarted only by the query that made it: with another number
of slots, or another schema of its state, a query needs a checkpoint of its own.
The old state is read from the old checkpoint as a table, dealt to the new slots,
and is the initial state of the new query, which goes on from the source position
that the old one had reached.

``split`` deals the entries to the new slots in turn, so that their sum stays the
same; ``union`` gives every new slot all of them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.operators.state import KEY_GROUPS, key_group, slot_of_group
from eventide.streaming.processors import SLOT_SCHEMA, SlotCount


def old_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(slot, cnt)`` of a stopped ``slot_counts`` query."""
    state = spark.read.format("statestore").option("stateVarName", "count").load(checkpoint)
    return state.select(F.col("key")[state.schema["key"].dataType.names[0]].alias("slot"), F.col("value.v").alias("cnt"))


def old_group_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(slot, cnt)`` of a stopped ``operators.key_group_counts`` query, whose state has
    another schema: one entry per key group."""
    state = spark.read.format("statestore").load(checkpoint)
    key, value = (state.schema[c].dataType.names[0] for c in ("key", "value"))
    return state.select(F.col("key")[key].cast("int").alias("slot"), F.col("value")[value].alias("cnt"))


def split(entries: DataFrame, slots: int) -> DataFrame:
    """Entries dealt to ``slots`` slots in turn."""
    return entries.groupBy(F.pmod("slot", F.lit(slots)).cast("int").alias("slot")).agg(F.sum("cnt").alias("cnt"))


def union(entries: DataFrame, slots: int) -> DataFrame:
    """All entries for each of ``slots`` slots."""
    each = entries.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return each.groupBy("slot").agg(F.sum("cnt").alias("cnt"))


def slot_counts(stream: DataFrame, key: str, slots: int, initial: DataFrame | None = None) -> DataFrame:
    """``(slot, cnt)``: rows per slot so far, on from ``initial (slot, cnt)``."""
    dealt = stream.withColumn("slot", slot_of_group(key_group(key), slots, KEY_GROUPS))
    start = initial.groupBy("slot") if initial is not None else None
    return dealt.groupBy("slot").transformWithStateInPandas(SlotCount(), SLOT_SCHEMA, "Update", "None", initialState=start)


def files_read(spark: SparkSession, checkpoint: str) -> list[str]:
    """The files that the old query's source has read, from its source log."""
    logs = spark.read.text(f"{checkpoint}/sources/0/[0-9]*").where(F.col("value").startswith("{"))
    return sorted({json.loads(r.value)["path"] for r in logs.collect()})
