"""Row-format file sink bucketed by time.

Rows are written as text lines under ``bucket=<yyyy-MM-dd HH>`` folders.  In
streaming, files become visible atomically through the sink's commit log at
the end of each micro-batch (the trigger interval is the roll interval);
``max_records`` caps rows per file (the size-based roll).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BUCKET_FORMAT = "yyyy-MM-dd HH"


def _bucketed(df: DataFrame, ts: str, value: str, fmt: str) -> DataFrame:
    return df.select(F.col(value).cast("string").alias("value"),
                     F.date_format(F.col(ts), fmt).alias("bucket"))


def write_bucketed_text(df: DataFrame, path: str, ts: str, value: str,
                        fmt: str = BUCKET_FORMAT, max_records: int | None = None,
                        mode: str = "overwrite") -> None:
    # Range-partition on (bucket, row hash): each task writes a contiguous run
    # of buckets (one open file at a time, few files per folder), and a hot
    # bucket spans several tasks because the hash splits it between ranges.
    b = _bucketed(df, ts, value, fmt)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = b.repartitionByRange(n, "bucket", F.xxhash64("value")).sortWithinPartitions("bucket")
    w = b.write.mode(mode).partitionBy("bucket")
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.text(path)


def stream_bucketed_text(df: DataFrame, path: str, checkpoint: str, ts: str, value: str,
                         fmt: str = BUCKET_FORMAT, roll_interval: str = "1 minute",
                         max_records: int | None = None):
    w = (_bucketed(df, ts, value, fmt).writeStream.format("text").partitionBy("bucket")
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(processingTime=roll_interval))
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    return w


def read_bucketed_text(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("value", T.StringType()),
                           T.StructField("bucket", T.StringType())])
    return spark.read.schema(schema).text(path)
