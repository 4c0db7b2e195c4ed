"""Streaming forms of the windowed and keyed operators.

Event time must be a ``timestamp`` column for ``withWatermark`` (the test
tables hold ``timestamp_ntz``; session time zone is UTC).  The reference's
watermark is ``max - delay - 1 ms``; Spark's is ``max - delay``, so the
delay is given 1 ms more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.operators.joins import asof_last
from eventide.operators.topn import top_n
from eventide.operators.windows import with_ingest_time


def with_event_time(df: DataFrame, ts: str, delay_ms: int, name: str = "event_time") -> DataFrame:
    """Event-time column plus bounded out-of-orderness watermark."""
    d = df.withColumn(name, F.col(ts).cast("timestamp"))
    return d.withWatermark(name, f"{delay_ms + 1} milliseconds")


def window_aggregate(df: DataFrame, keys: Sequence[str], ts: str, size: str, aggs: Sequence[Column],
                     slide: str | None = None) -> DataFrame:
    """H1/H2 + I*: windowed aggregate; append mode emits a window once the
    watermark passes its end (W9)."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (df.groupBy(*keys, w.alias("w")).agg(*aggs)
              .withColumn("window_start", F.col("w.start")).withColumn("window_end", F.col("w.end"))
              .drop("w"))


def session_aggregate(df: DataFrame, keys: Sequence[str], ts: str, gap: str | Column,
                      aggs: Sequence[Column]) -> DataFrame:
    """H3/H4: session windows (fixed or per-row gap)."""
    return (df.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(*aggs)
              .withColumn("window_start", F.col("w.start")).withColumn("window_end", F.col("w.end"))
              .drop("w"))


def top_n_batches(group: Sequence[str], order: Sequence[Column], n: int,
                  sink: Callable[[DataFrame, int], None], name: str = "rank"):
    """J2/J3 streaming: a ``foreachBatch`` function for the append output of a
    windowed count (``window_aggregate``).  A watermark passes a window's end
    once, so all counts of a window arrive, final, in one micro-batch, and the
    batch top-N (a partial limit per task, then per group) is exact there.  With
    ``sinks.exactly_once.idempotent_batch_writer`` a replayed batch replaces its
    own output."""
    def run(batch: DataFrame, batch_id: int) -> None:
        sink(top_n(batch, group, order, n, name), batch_id)
    return run


def running_count(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """Keyed count in update mode: one row per changed key per batch."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def key_group_counts(df: DataFrame, key: str, key_groups: int = 128) -> DataFrame:
    """K7 streaming: running count per fixed key group in checkpointed state
    (``complete``/``update`` mode); survives restarts, and any slot count is
    derived from it with ``state.slot_counts``."""
    from eventide.operators.state import key_group
    return df.groupBy(key_group(key, key_groups).alias("kg")).agg(F.count(F.lit(1)).alias("cnt"))


def config_threshold_batch(read_config, sink, value: str = "vc", default: int = 0,
                           name: str = "threshold"):
    """F4 streaming: a ``foreachBatch`` function.  Each micro-batch re-reads
    the config table (``read_config() -> DataFrame(seq, threshold)``), takes
    its latest value as a scalar subquery (one value, nothing broadcast but
    that) and passes rows above it to ``sink(df, batch_id)``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        cfg = read_config()
        latest = cfg.agg(F.max_by(F.col(name), F.col("seq"))).scalar()
        th = F.coalesce(latest, F.lit(default))
        sink(batch.withColumn(name, th).filter(F.col(value) > F.col(name)), batch_id)
    return run


class ConfigThreshold:
    """F4 streaming with the configuration as a stream of its own: a
    ``foreachBatch`` function over the union of both inputs (``is_config``, a SQL
    condition, marks configuration rows).  Inside a micro-batch a row sees the
    latest configuration before it in arrival order; the last one of a batch is
    kept as one row per batch id in a shared folder, so a replayed batch starts
    from the value it started from before."""

    def __init__(self, state_dir: str, is_config: str, value: str, order: str,
                 emit: Callable[[DataFrame, int], None], default: int = 0, name: str = "threshold"):
        self.state_dir, self.is_config, self.value, self.order, self.emit, self.default, self.name = \
            state_dir.rstrip("/"), is_config, value, order, emit, default, name

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        config, value = F.expr(self.is_config), F.col(self.value)
        before = self.default
        if batch_id > 0:                     # one row
            before = batch.sparkSession.read.parquet(f"{self.state_dir}/v={batch_id - 1}").first()[0]
        seen = asof_last(batch, config, value, self.order, before, self.name)
        self.emit(seen.filter(~config & (value > F.col(self.name))), batch_id)
        last = batch.agg(F.max_by(value, F.when(config & value.isNotNull(), F.col(self.order))).alias(self.name))
        last.select(F.coalesce(self.name, F.lit(before)).alias(self.name)) \
            .write.mode("overwrite").parquet(f"{self.state_dir}/v={batch_id}")


def processing_time_window(df: DataFrame, keys: Sequence[str], size: str,
                           aggs: Sequence[Column], slide: str | None = None) -> DataFrame:
    """H5 streaming: tumbling windows (sliding with ``slide``) over the ingest
    clock, one timestamp per micro-batch: every row lands in the windows of its
    batch's start time."""
    return window_aggregate(with_ingest_time(df, "ingest_ts"), keys, "ingest_ts", size, aggs, slide)


def processing_time_session(df: DataFrame, keys: Sequence[str], gap: str, aggs: Sequence[Column]) -> DataFrame:
    """H5 streaming: sessions over the ingest clock."""
    return session_aggregate(with_ingest_time(df, "ingest_ts"), keys, "ingest_ts", gap, aggs)
