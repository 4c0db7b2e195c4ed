"""Registry of named queries and their DuckDB oracle SQL.

``@query(name, sql)`` registers a callable ``(spark, sf_dir) -> DataFrame``.
``sql`` is an equivalent ANSI query over the driver's tables (DuckDB views of
the same parquet files); it is omitted only where no SQL form exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventide.sources.sensor import arrival_view, sensor_view
from eventide.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_view(table(spark, sf_dir, "events"))


def arrivals(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return arrival_view(table(spark, sf_dir, "events"), extra)


# ---------------------------------------------------------------- SQL pieces
# The sensor view in DuckDB SQL (same fixed values as sources/sensor.py).
SENSOR_SQL = ("SELECT 's' || CAST(user_id AS VARCHAR) AS id, ts, "
              "CAST(floor(value) AS INTEGER) % 15 AS vc, event_id AS seq, event_type FROM events")
ARRIVAL_SQL = ("SELECT *, epoch_us(arrival) AS arrival_us FROM (SELECT *, "
               "ts + to_seconds(CAST((seq * 7919) % 3600 AS BIGINT)) AS arrival FROM sensor)")


def with_sensor(body: str, ctes: str = "", arrival: bool = False) -> str:
    """``WITH sensor AS (...)[, arrivals AS (...)][, <ctes>] <body>``."""
    parts = [f"sensor AS ({SENSOR_SQL})"]
    if arrival:
        parts.append(f"arrivals AS ({ARRIVAL_SQL})")
    if ctes:
        parts.append(ctes)
    return "WITH " + ",\n".join(parts) + "\n" + body


def bucket(ts: str, width_us: int, offset_us: int = 0) -> str:
    """SQL timestamp of the epoch-aligned bucket start (plus offset)."""
    return f"make_timestamp((epoch_us({ts}) // {width_us}) * {width_us} + {offset_us})"
