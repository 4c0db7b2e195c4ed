"""Effectively-once output from a replayable source + checkpoint.

Each micro-batch is written to its own ``batch_id=<n>`` folder with
overwrite; when a batch is replayed after a failure it replaces its earlier
(partial) output instead of adding to it, so the result is the same as a
single clean run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def idempotent_batch_writer(path: str, fmt: str = "parquet"):
    def run(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")
    return run


def read_committed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
