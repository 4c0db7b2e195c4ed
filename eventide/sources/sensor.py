"""The sensor record and its view over the ``events`` table.

A sensor row is ``(id string, ts, vc int, seq bigint)``: sensor id, event
time, water level and arrival order.  ``events`` is mapped onto it as

* ``id  = 's' || user_id``
* ``ts  = ts`` (event time)
* ``vc  = floor(value) % 15``  (levels 0..14, like the reference generator)
* ``seq = event_id``           (arrival order)

``arrival_view`` adds an out-of-order arrival time for the watermark and
late-data operators: ``arrival = ts + (event_id * 7919 % 3600) seconds``,
processed in ``(arrival, seq)`` order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

SENSOR_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("vc", T.IntegerType()),
])

# Fixed values of the mapping (shared with the SQL oracle in plans/).
LEVELS = 15
ARRIVAL_PRIME = 7919
ARRIVAL_SPREAD_S = 3600


def sensor_view(events: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return events.select(
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("id"),
        F.col("ts"),
        (F.floor("value").cast("int") % LEVELS).alias("vc"),
        F.col("event_id").alias("seq"),
        *extra,
    )


def arrival_view(events: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``arrival`` (timestamp) and ``arrival_us`` (its epoch microseconds,
    the first arrival-order column; ties broken by ``seq``)."""
    s = sensor_view(events, extra)
    delay = F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0),
        ((F.col("seq") * ARRIVAL_PRIME) % ARRIVAL_SPREAD_S).cast("decimal(18,6)"))
    s = s.withColumn("arrival", F.col("ts") + delay)
    return s.withColumn("arrival_us", epoch_us("arrival"))


# Time conversions never depend on the session time zone (the test tables
# hold timestamp_ntz).  In a UTC session the fast epoch functions are exact;
# in any other zone plain arithmetic against the epoch as timestamp_ntz is
# used instead (a zoned timestamp is then taken as its session wall clock).
_UTC = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Universal", "Zulu"}


def _utc_session() -> bool:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in _UTC


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_us(c: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp_ntz (or timestamp) column."""
    c = F.col(c) if isinstance(c, str) else c
    if _utc_session():
        return F.unix_micros(c.cast("timestamp"))
    return F.timestamp_diff("MICROSECOND", _epoch(), c.cast("timestamp_ntz"))


def epoch_ms(c: Column | str) -> Column:
    return F.floor(epoch_us(c) / 1000)


def epoch_s(c: Column | str) -> Column:
    """Whole seconds since the epoch (floor), like the sensor record's ts."""
    return F.floor(epoch_us(c) / 1_000_000)


def from_epoch_us(us: Column) -> Column:
    """timestamp_ntz for a count of microseconds since the epoch."""
    if _utc_session():
        return F.timestamp_micros(us).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", us, _epoch())
