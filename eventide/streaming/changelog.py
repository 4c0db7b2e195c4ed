"""T5 streaming: the changelog (+I, -U, +U) of ``SELECT key, sum(v) GROUP BY key``.

Update mode gives only the new value per key and batch.  This
``foreachBatch`` function keeps the last sum and row count per key as a
versioned table in a shared folder (one version per batch id, so a replayed
batch reads the version before it; older versions are removed) and emits, for every input row in
arrival order, exactly the change rows of the batch form
``operators.state.changelog``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from eventide.operators import scan
from eventide.session import retire


class ChangelogSum:
    def __init__(self, state_dir: str, keys: Sequence[str], value: str, order: str,
                 emit: Callable[[DataFrame, int], None]):
        self.state_dir, self.keys, self.value, self.order, self.emit = \
            state_dir.rstrip("/"), list(keys), value, order, emit

    def _state(self, batch: DataFrame, batch_id: int) -> DataFrame:
        schema = T.StructType([batch.schema[k] for k in self.keys]
                              + [T.StructField("__s0", T.LongType()), T.StructField("__n0", T.LongType())])
        if batch_id < 1:
            return batch.sparkSession.createDataFrame([], schema)
        return batch.sparkSession.read.schema(schema).parquet(f"{self.state_dir}/v={batch_id - 1}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        v = F.col(self.value).cast("long")
        d = scan.running(batch, self.keys, self.order, {"__s": ("sum", v), "__n": ("count", F.lit(1))})
        d = d.join(self._state(batch, batch_id), self.keys, "left")
        total = F.coalesce("__s0", F.lit(0)) + F.col("__s")
        n = F.coalesce("__n0", F.lit(0)) + F.col("__n")
        old = total - v
        ops = (F.when(n == 1, F.array(F.struct(F.lit("+I").alias("op"), total.alias("s"))))
                .when(v != 0, F.array(F.struct(F.lit("-U").alias("op"), old.alias("s")),
                                      F.struct(F.lit("+U").alias("op"), total.alias("s"))))
                .otherwise(F.array().cast("array<struct<op:string,s:bigint>>")))
        d = scan.stage(d.withColumn("__total", total).withColumn("__count", n).withColumn("__ops", ops))
        self.emit(d.select(*self.keys, self.order, F.posexplode("__ops").alias("op_no", "__c"))
                  .select(*self.keys, self.order, "op_no", F.col("__c.op").alias("op"),
                          F.col("__c.s").alias(f"{self.value}_sum")), batch_id)
        last = d.groupBy(*self.keys).agg(F.max_by("__total", self.order).alias("__s0"),
                                         F.max("__count").alias("__n0"))
        carried = self._state(batch, batch_id).join(last.select(*self.keys), self.keys, "left_anti")
        carried.unionByName(last).write.mode("overwrite").parquet(f"{self.state_dir}/v={batch_id}")
        retire(batch.sparkSession, f"{self.state_dir}/v={batch_id - 2}")
