"""Replay a batch input as a file stream, one slice per file, in arrival order.

Used to check that a streaming operator equals its batch form.  The input is
range-partitioned on the arrival column (Spark samples the ranges; no task
sees all rows) and written once; file times are set in slice order so that
``maxFilesPerTrigger=1`` reads one slice per micro-batch in order.
"""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame, SparkSession


def write_replay(df: DataFrame, path: str, parts: int, order: str) -> list[str]:
    df.repartitionByRange(parts, order).sortWithinPartitions(order) \
        .write.mode("overwrite").parquet(path)
    files = sorted(glob.glob(os.path.join(path, "part-*.parquet")))
    base = 1_600_000_000
    for i, f in enumerate(files):        # local replays only: stamp file order
        os.utime(f, (base + i, base + i))
    return files


def replay_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(path))


def run_to_end(df: DataFrame, name: str, checkpoint: str, mode: str = "append",
               timeout_s: int = 300):
    """Run a streaming DataFrame over everything available into a memory
    table ``name``; returns the finished query."""
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    return q
