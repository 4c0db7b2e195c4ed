"""Top-N (J*, U4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import topn as N
from eventide.operators import windows as W
from eventide.plans.registry import query, sensor, with_sensor
from eventide.sources.tables import table

SIZE, SLIDE = "1 h", "30 min"
SIZE_US, SLIDE_US = W.micros(SIZE), W.micros(SLIDE)

_SLIDING = f"""sw AS (SELECT *, make_timestamp(b - k * {SLIDE_US}) AS window_start,
                        make_timestamp(b - k * {SLIDE_US} + {SIZE_US}) AS window_end
        FROM (SELECT *, (epoch_us(ts) // {SLIDE_US}) * {SLIDE_US} AS b FROM sensor) s
        CROSS JOIN (SELECT range AS k FROM range(0, {SIZE_US // SLIDE_US})) r)"""


def _top_sql(group: str, n: int = 2) -> str:
    return with_sensor(f"""SELECT * FROM (
        SELECT {group}, vc, cnt, row_number() OVER (PARTITION BY {group} ORDER BY cnt DESC, vc) AS rank
        FROM (SELECT {group}, vc, CAST(count(*) AS BIGINT) AS cnt FROM sw GROUP BY ALL)) WHERE rank <= {n}""",
        ctes=_SLIDING)


def _sliding_counts(spark, sf, *by):
    return W.sliding_windows(sensor(spark, sf), list(by), "ts", SIZE, SLIDE, {"cnt": ("count", F.lit(1))})


def _top(counts, group):
    return N.top_n(counts, group, [F.desc("cnt"), F.asc("vc")], 2).withColumn("rank", F.col("rank").cast("bigint"))


@query("topn_window_all", _top_sql("window_start, window_end"))
def topn_window_all(spark, sf):
    """The 2 most frequent vc per sliding window over all sensors.
    Counts per slice, then a per-window limit - never one task."""
    return _top(_sliding_counts(spark, sf, "vc"), ["window_start", "window_end"])


@query("topn_two_stage", with_sensor(f"""SELECT * FROM (
        SELECT window_end, vc, cnt, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, vc) AS rank
        FROM (SELECT vc, window_end, CAST(count(*) AS BIGINT) AS cnt FROM sw GROUP BY ALL)) WHERE rank <= 2""",
        ctes=_SLIDING))
def topn_two_stage(spark, sf):
    """Stage 1 counts per (vc, window) with the window end attached;
    stage 2 regroups by window end and keeps the top 2."""
    return _top(_sliding_counts(spark, sf, "vc").drop("window_start"), ["window_end"])


@query("topn_per_key", _top_sql("id, window_start, window_end"))
def topn_per_key(spark, sf):
    """Top 2 vc per sensor id and window, for any number of ids."""
    return _top(_sliding_counts(spark, sf, "id", "vc"), ["id", "window_start", "window_end"])


@query("keyed_top3", with_sensor("""SELECT id, vc, seq, rank FROM (
    SELECT id, vc, seq, row_number() OVER (PARTITION BY id ORDER BY vc DESC, seq) AS rank FROM sensor)
    WHERE rank <= 3"""))
def keyed_top3(spark, sf):
    """J4 final: the 3 largest vc per key (earliest first on ties)."""
    return N.top_n(sensor(spark, sf).select("id", "vc", "seq"), ["id"], [F.desc("vc"), F.asc("seq")], 3) \
        .withColumn("rank", F.col("rank").cast("bigint"))


@query("keyed_top3_running", with_sensor("""SELECT s.seq, s.id, s.vc,
        (SELECT array_to_string(list(x.vc ORDER BY x.vc DESC)[1:3], ',')
         FROM sensor x WHERE x.id = s.id AND x.seq <= s.seq) AS top3
    FROM sensor s"""))
def keyed_top3_running(spark, sf):
    """K2/J4 running: list state holding the 3 largest vc so far, per row."""
    d = N.running_top_k(sensor(spark, sf).select("seq", "id", "vc"), ["id"], "vc", 3)
    return d.select("seq", "id", "vc",
                    F.array_join(F.transform("top3", lambda x: x.cast("string")), ",").alias("top3"))


@query("table_top2", """SELECT value, rank FROM (
    SELECT o_totalprice AS value, row_number() OVER (ORDER BY o_totalprice DESC) AS rank FROM orders)
    WHERE rank <= 2""")
def table_top2(spark, sf):
    """Table aggregate emitting (value, rank) for the 2 largest values.
    A global top-k: each task keeps its own 2 before the single merge."""
    return N.top_values(table(spark, sf, "orders").select(F.col("o_totalprice").alias("value")), "value", 2) \
        .withColumn("rank", F.col("rank").cast("bigint"))


@query("table_top2_by_key", """SELECT o_custkey, value, rank FROM (
    SELECT o_custkey, o_totalprice AS value,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rank FROM orders)
    WHERE rank <= 2""")
def table_top2_by_key(spark, sf):
    """J5 grouped: the table aggregate applied per customer."""
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_totalprice").alias("value"))
    return N.top_values(o, "value", 2, keys=["o_custkey"]).withColumn("rank", F.col("rank").cast("bigint"))
