"""User-chosen distribution (P1-P4, P7).  P5 (everything to one task) is
not registered: it funnels the whole input through a single task."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import distribution as D
from eventide.plans.registry import query, sensor, with_sensor
from eventide.sources.tables import table

_ROWS = with_sensor("SELECT seq, id, vc FROM sensor")


def _rows(spark, sf):
    return sensor(spark, sf).select("seq", "id", "vc")


@query("dist_random", _ROWS)
def dist_random(spark, sf):
    """P1 over the session's shuffle partitions."""
    return D.shuffle_random(_rows(spark, sf))


@query("dist_rebalance", _ROWS)
def dist_rebalance(spark, sf):
    """P2 over the session's shuffle partitions."""
    return D.rebalance(_rows(spark, sf))


@query("dist_rescale", _ROWS)
def dist_rescale(spark, sf):
    """P3 to half the input partitions (narrow, no shuffle)."""
    return D.rescale(_rows(spark, sf))


@query("dist_replicate", """SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(range AS INTEGER) AS task
    FROM events CROSS JOIN range(0, 4) GROUP BY event_type, range""")
def dist_replicate(spark, sf):
    """Replicate to 4 tasks - applied to a table of bounded size derived
    from events (counts per event type), never to the growing table itself."""
    per_type = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return D.replicate(per_type, 4)


@query("dist_custom", _ROWS)
def dist_custom(spark, sf):
    """Rows placed by ``pmod(java_hash(id), n)`` over the session's
    shuffle partitions (placement checked in the test suite)."""
    return D.custom(_rows(spark, sf), "id").drop("slot")
