"""F3 streaming: an interval join of two inputs with late rows set aside.

One ``foreachBatch`` operator over both inputs, each row tagged with its side.
Every row is judged against the watermark in force before it, the lesser of both
inputs' (largest event time so far - delay - 1 ms), from the batches before and a
two-level scan of its own batch in arrival order; so the result equals the batch
form (``joins.late_split_two_inputs`` and ``interval_join``) row for row.

State is append-only: a batch writes its own rows that are on time, once, and a
table of one row per batch says how far the rows of each batch that is still
needed reach.  A batch whose rows the watermark has passed by the interval matches
nothing more: its folder goes.  A replayed batch reads what the batch before it
left and writes its own folders again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from eventide.operators import joins, scan
from eventide.session import retire
from eventide.sources.sensor import epoch_us

_META = "max_l bigint, max_r bigint, live array<struct<batch:bigint,reach:bigint>>, dead array<bigint>"


class IntervalJoinLate:
    """``foreachBatch`` function.  ``emit(kind, df, batch_id)`` gets ``'pair'`` rows
    (the columns of both sides as ``l_<c>`` and ``r_<c>``), and the rows of a side
    that came too late as ``'late_left'`` and ``'late_right'``.

    ``side`` is 'L' or 'R'; a pair has equal ``key`` and a right time between the
    left one plus ``lower_us`` and plus ``upper_us``."""

    def __init__(self, state_dir: str, side: str, key: str, ts: str, order: Sequence[str], lower_us: int, upper_us: int, delay_us: int,
                 emit: Callable[[str, DataFrame, int], None]):
        self.state_dir, self.side, self.key, self.ts, self.order = state_dir.rstrip("/"), side, key, ts, list(order)
        self.lower, self.upper, self.lag, self.emit = lower_us, upper_us, delay_us + 1000, emit

    def _meta(self, spark, batch_id: int):
        """What the batch left: one row."""
        if batch_id < 0:
            return None, None, [], []
        row = spark.read.schema(_META).parquet(f"{self.state_dir}/meta/v={batch_id}").first()
        return row.max_l, row.max_r, [tuple(x) for x in row.live], list(row.dead)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, columns = batch.sparkSession, batch.columns
        max_l, max_r, live, dead = self._meta(spark, batch_id - 1)
        for old in dead:                                    # the batch before is committed: nothing reads these
            retire(spark, f"{self.state_dir}/rows/b={old}")
        retire(spark, f"{self.state_dir}/meta/v={batch_id - 2}")
        left = F.col(self.side) == "L"
        b = batch.withColumn("__t", epoch_us(self.ts))
        b = scan.running(b, [], self.order, {"__l": ("max", F.when(left, F.col("__t"))), "__r": ("max", F.when(~left, F.col("__t")))},
                         exclusive=True, chunk=scan.micros_chunk(b, self.order[0]))
        seen = [F.greatest(F.lit(m).cast("bigint"), F.col(c)) for m, c in ((max_l, "__l"), (max_r, "__r"))]
        wm = F.when(seen[0].isNotNull() & seen[1].isNotNull(), F.least(*seen) - F.lit(self.lag))
        b = scan.stage(b.withColumn("__late", F.coalesce(F.col("__t") < wm, F.lit(False))))
        for kind, of in (("late_left", left), ("late_right", ~left)):
            self.emit(kind, b.where(F.col("__late") & of).select(*columns), batch_id)

        mine = f"{self.state_dir}/rows/b={batch_id}"
        b.where("NOT __late").select(*columns).write.mode("overwrite").parquet(mine)
        now = spark.read.schema(batch.schema).parquet(mine)
        paths = [f"{self.state_dir}/rows/b={i}" for i, _ in live]
        before = spark.read.schema(batch.schema).parquet(*paths) if paths else now.where("false")
        # Each pair in the batch of its later row.
        pairs = self._pairs(now, now.unionByName(before)).unionByName(self._pairs(before, now))
        self.emit("pair", pairs, batch_id)

        top = b.agg(F.max(F.when(left, F.col("__t"))).alias("l"), F.max(F.when(~left, F.col("__t"))).alias("r")).first()
        most = [max((x for x in pair if x is not None), default=None) for pair in ((max_l, top.l), (max_r, top.r))]
        end = epoch_us(self.ts)
        reach = now.agg(F.max(F.when(left, end + F.lit(self.upper)).otherwise(end - F.lit(self.lower)))).first()[0]
        if reach is not None:
            live = [*live, (batch_id, reach)]
        passed = min(most) - self.lag if None not in most else None
        keep = [x for x in live if passed is None or x[1] >= passed]
        gone = [i for i, _ in live if i not in {k for k, _ in keep}] + ([batch_id] if reach is None else [])
        spark.createDataFrame([(*most, keep, gone)], _META).coalesce(1).write.mode("overwrite").parquet(f"{self.state_dir}/meta/v={batch_id}")

    def _pairs(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """Pairs of left rows of ``a`` and right rows of ``b``."""
        left, right = (df.where(F.col(self.side) == s).select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns if c != self.side])
                       for df, s, p in ((a, "L", "l"), (b, "R", "r")))
        return joins.interval_join(left, right, f"l_{self.key}", f"r_{self.key}", f"l_{self.ts}", f"r_{self.ts}", self.lower, self.upper)
