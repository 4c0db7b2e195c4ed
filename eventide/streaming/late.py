"""W8 streaming: allowed lateness, late side output and re-firing, per row.

Spark drops rows behind the previous micro-batch's watermark before its
stateful operators see them, so this operator keeps its own state and runs
in ``foreachBatch``.  State is small and distributed:

* the largest event time seen so far (one value);
* per (key, window) not yet cleaned up: on-time count/sum, late count/sum and
  whether the main firing happened.

Within a micro-batch every row is judged against the exact watermark before
it (previous batches' maximum combined with a two-level scan of the batch in
arrival order), so the result equals the batch form
(``operators.watermark.late_classify`` / ``late_window_firings``) row for
row.  State is written as a new version per batch id in a shared folder; a
replayed batch reads the version before it and overwrites its own, so
replays are harmless when the outputs are written idempotently too.  Only those
two versions stay: a batch starts after the one before it is committed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventide.operators import scan
from eventide.session import retire
from eventide.sources.sensor import epoch_us, from_epoch_us


class LateWindows:
    """``foreachBatch`` function.  ``emit(kind, df, batch_id)`` receives
    ``'firing'`` rows (keys, window_start, window_end, firing, n, vc_sum) and
    ``'late'`` rows (the input rows beyond the allowed lateness)."""

    def __init__(self, state_dir: str, keys: Sequence[str], ts: str, order: Sequence[str], value: str,
                 size_us: int, delay_us: int, lateness_us: int,
                 emit: Callable[[str, DataFrame, int], None]):
        self.state_dir = state_dir.rstrip("/")
        self.keys, self.ts, self.order, self.value = list(keys), ts, list(order), value
        self.size, self.lag, self.lateness = size_us, delay_us + 1000, lateness_us
        self.emit = emit

    # ---------------------------------------------------------------- state
    def _state_schema(self, batch: DataFrame) -> T.StructType:
        fields = [batch.schema[k] for k in self.keys]
        return T.StructType(fields + [T.StructField(n, t) for n, t in [
            ("__ws", T.LongType()), ("n0", T.LongType()), ("s0", T.LongType()),
            ("nl", T.LongType()), ("sl", T.LongType()), ("fired", T.BooleanType())]])

    def _load(self, spark: SparkSession, batch_id: int, schema: T.StructType):
        if batch_id < 0:
            return spark.createDataFrame([], schema), None
        path = f"{self.state_dir}/v={batch_id}"
        windows = spark.read.schema(schema).parquet(f"{path}/windows")
        max_t = spark.read.parquet(f"{path}/meta").agg(F.max("max_t")).scalar()
        return windows, max_t

    def _save(self, spark: SparkSession, batch_id: int, windows: DataFrame, max_t) -> None:
        path = f"{self.state_dir}/v={batch_id}"
        windows.write.mode("overwrite").parquet(f"{path}/windows")
        spark.range(1).select(max_t.cast("long").alias("max_t")).write.mode("overwrite").parquet(f"{path}/meta")
        retire(spark, f"{self.state_dir}/v={batch_id - 2}")

    def _window_cols(self, ws: str = "__ws"):
        return [from_epoch_us(F.col(ws)).alias("window_start"),
                from_epoch_us(F.col(ws) + self.size).alias("window_end")]

    # ----------------------------------------------------------------- batch
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = self._state_schema(batch)
        state, prev_max = self._load(spark, batch_id - 1, schema)
        prev_max = prev_max if prev_max is not None else F.lit(None).cast("long")

        b = batch.withColumn("__t", epoch_us(self.ts))
        b = scan.running(b, [], self.order, {"__mx": ("max", F.col("__t"))}, exclusive=True,
                         chunk=scan.micros_chunk(b, self.order[0]))
        wm = F.greatest(prev_max, F.col("__mx")) - F.lit(self.lag)
        b = b.withColumn("__ws", F.floor(F.col("__t") / self.size) * self.size)
        end_ms = F.col("__ws") + F.lit(self.size - 1000)
        cls = (F.when(wm.isNull() | (end_ms > wm), "on_time")
                .when(end_ms + F.lit(self.lateness) <= wm, "too_late").otherwise("late_allowed"))
        b = scan.stage(b.withColumn("__class", cls))

        self.emit("late", b.filter(F.col("__class") == "too_late")
                  .drop("__t", "__mx", "__ws", "__class"), batch_id)

        wkeys = [*self.keys, "__ws"]
        v = F.col(self.value).cast("long")
        on = b.filter(F.col("__class") == "on_time").groupBy(*wkeys).agg(
            F.count(F.lit(1)).alias("bn0"), F.sum(v).alias("bs0"))
        merged = state.join(on, wkeys, "full_outer").select(
            *wkeys,
            (F.coalesce("n0", F.lit(0)) + F.coalesce("bn0", F.lit(0))).alias("n0"),
            (F.coalesce("s0", F.lit(0)) + F.coalesce("bs0", F.lit(0))).alias("s0"),
            F.coalesce("nl", F.lit(0)).alias("nl"), F.coalesce("sl", F.lit(0)).alias("sl"),
            F.coalesce("fired", F.lit(False)).alias("fired"))

        # re-firings: every late-but-allowed row, with everything so far
        late = b.filter(F.col("__class") == "late_allowed")
        late = scan.running(late, wkeys, self.order, {"__k": ("count", F.lit(1)), "__ls": ("sum", v)},
                            chunk=scan.micros_chunk(late, self.order[0]))
        z = lambda c: F.coalesce(F.col(c), F.lit(0))  # noqa: E731  (window new to the state)
        refire = late.join(merged, wkeys, "left").select(
            *self.keys, *self._window_cols(),
            (z("nl") + F.col("__k")).alias("firing"),
            (z("n0") + z("nl") + F.col("__k")).alias("n"),
            (z("s0") + z("sl") + F.col("__ls")).alias("vc_sum"))

        # the new watermark closes windows: main firing once, cleanup later
        batch_max = b.agg(F.max("__t")).scalar()
        new_max = F.greatest(prev_max, batch_max)
        new_wm = new_max - F.lit(self.lag)
        late_tot = late.groupBy(*wkeys).agg(F.count(F.lit(1)).alias("__dn"), F.sum(v).alias("__ds"))
        # full outer: a window seen so far only through late rows enters the state too
        merged = merged.join(late_tot, wkeys, "full_outer").select(
            *wkeys, z("n0").alias("n0"), z("s0").alias("s0"),
            (z("nl") + z("__dn")).alias("nl"), (z("sl") + z("__ds")).alias("sl"),
            F.coalesce(F.col("fired"), F.lit(False)).alias("fired"))
        closes = (F.col("__ws") + F.lit(self.size - 1000)) <= new_wm
        merged = scan.stage(merged.withColumn("__fire_now", ~F.col("fired") & closes & (F.col("n0") > 0)))
        main = merged.filter("__fire_now").select(
            *self.keys, *self._window_cols(), F.lit(0).cast("long").alias("firing"),
            F.col("n0").alias("n"), F.col("s0").alias("vc_sum"))
        self.emit("firing", main.unionByName(refire), batch_id)

        keep = merged.withColumn("fired", F.col("fired") | closes).filter(
            ~((F.col("__ws") + F.lit(self.size - 1000 + self.lateness)) <= new_wm)).drop("__fire_now")
        self._save(spark, batch_id, keep.select(*schema.fieldNames()), new_max)

    def flush(self, spark: SparkSession, last_batch_id: int, schema_from: DataFrame) -> DataFrame:
        """End of a bounded input: main firings of the windows still open."""
        state, _ = self._load(spark, last_batch_id, self._state_schema(schema_from))
        return state.filter(~F.col("fired") & (F.col("n0") > 0)).select(
            *self.keys, *self._window_cols(), F.lit(0).cast("long").alias("firing"),
            F.col("n0").alias("n"), F.col("s0").alias("vc_sum"))
