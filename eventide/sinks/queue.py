"""Message-queue sinks.

The queue sink of Spark is at-least-once; effectively-once delivery is
built from an idempotent batch write (see ``exactly_once``).  The
connector jar is not part of this environment; these build the writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def encode_key_value(df: DataFrame, line: str, sep: str = ",") -> DataFrame:
    """``k,v`` text to key and value bytes (UTF-8)."""
    parts = F.split(F.col(line), sep, 2)
    return df.select(F.encode(parts.getItem(0), "UTF-8").alias("key"),
                     F.encode(parts.getItem(1), "UTF-8").alias("value"))


def queue_sink_options(servers: str, topic: str, checkpoint: str,
                       transactional_prefix: str | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    if transactional_prefix:
        # kept for configuration parity; Spark's queue sink does not use transactions
        opts["kafka.transactional.id.prefix"] = transactional_prefix
    return opts


def queue_stream_sink(df: DataFrame, **kw):
    w = df.writeStream.format("kafka")
    for k, v in queue_sink_options(**kw).items():
        w = w.option(k, v)
    return w
