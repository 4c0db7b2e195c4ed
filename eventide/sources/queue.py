"""Message-queue source options.

The queue connector jar is not part of this environment, so these build the
reader and its options; they run wherever the connector is installed.
Progress is kept by the streaming checkpoint, not by a consumer group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OFFSETS = {"earliest": "earliest", "latest": "latest"}


def queue_source_options(servers: str, topic: str, starting: str = "latest",
                         read_committed: bool = False, group_id: str | None = None) -> dict[str, str]:
    if starting not in OFFSETS and not starting.startswith("{"):
        raise ValueError("starting must be 'earliest', 'latest' or a JSON offsets map")
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": OFFSETS.get(starting, starting)}
    if read_committed:
        opts["kafka.isolation.level"] = "read_committed"   # A8
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def queue_stream(spark: SparkSession, **kw) -> DataFrame:
    """``value`` as a string column, like the reference's string schema."""
    r = spark.readStream.format("kafka")
    for k, v in queue_source_options(**kw).items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
