"""Window assigners and window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import windows as W
from eventide.plans.registry import bucket, query, sensor, arrivals, with_sensor

# Reference durations scaled to the sparse test events.
SIZE, SLIDE, GAP = "1 h", "30 min", "2 h"
SIZE_US, SLIDE_US, GAP_US = W.micros(SIZE), W.micros(SLIDE), W.micros(GAP)
DYN_GAP_UNIT_US = W.micros("10 min")   # dynamic gap = (vc + 1) * 10 min


def _agg_cols():
    return [F.count(F.lit(1)).alias("n"), F.sum("vc").cast("bigint").alias("vc_sum")]


def _rows():
    """The rows of a count window (at most its size) in arrival order."""
    return F.sort_array(F.collect_list(F.struct("seq", "vc"))).alias("__l")


def _vc_list(col="vcs"):
    return F.array_join(F.transform(F.col(col), lambda x: x.cast("string")), ",").alias(col)


_BUCKET = f"{bucket('ts', SIZE_US)} AS window_start, {bucket('ts', SIZE_US, SIZE_US)} AS window_end"
_AGG_SQL = "CAST(count(*) AS BIGINT) AS n, CAST(sum(vc) AS BIGINT) AS vc_sum"


@query("tumbling_event", with_sensor(
    f"SELECT id, {_BUCKET}, {_AGG_SQL} FROM sensor GROUP BY ALL"))
def tumbling_event(spark, sf):
    return W.tumbling(sensor(spark, sf), "ts", SIZE) \
        .groupBy("id", "window_start", "window_end").agg(*_agg_cols())


@query("window_agg_bounds", with_sensor(
    f"SELECT id, {_BUCKET}, {_AGG_SQL}, CAST(max(vc) AS INTEGER) AS vc_max FROM sensor GROUP BY ALL"))
def window_agg_bounds(spark, sf):
    """Incremental aggregate per (key, window) + the window's bounds."""
    return W.tumbling(sensor(spark, sf), "ts", SIZE) \
        .groupBy("id", "window_start", "window_end") \
        .agg(*_agg_cols(), F.max("vc").alias("vc_max"))


@query("sliding_event", with_sensor(
    f"""SELECT id, make_timestamp(b - k * {SLIDE_US}) AS window_start,
               make_timestamp(b - k * {SLIDE_US} + {SIZE_US}) AS window_end, {_AGG_SQL}
        FROM (SELECT *, (epoch_us(ts) // {SLIDE_US}) * {SLIDE_US} AS b FROM sensor) s
        CROSS JOIN (SELECT range AS k FROM range(0, {SIZE_US // SLIDE_US})) r
        GROUP BY ALL"""))
def sliding_event(spark, sf):
    """H2: sliding windows put together from slices."""
    return W.sliding_windows(sensor(spark, sf), ["id"], "ts", SIZE, SLIDE, _session_aggs())


def _session_aggs():
    return {"n": ("count", F.lit(1)), "vc_sum": ("sum", F.col("vc"))}


_SESSION_SQL = """s1 AS (SELECT *, epoch_us(ts) AS t,
        max(epoch_us(ts) + {gap}) OVER (PARTITION BY id ORDER BY epoch_us(ts), seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM sensor),
    s2 AS (SELECT *, sum(CASE WHEN prev_end IS NULL OR t > prev_end THEN 1 ELSE 0 END)
        OVER (PARTITION BY id ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS session_no FROM s1)"""


@query("session_event", with_sensor(
    f"""SELECT id, make_timestamp(min(t)) AS window_start,
               make_timestamp(max(t + {GAP_US})) AS window_end, {_AGG_SQL}
        FROM s2 GROUP BY id, session_no""",
    ctes=_SESSION_SQL.format(gap=GAP_US)))
def session_event(spark, sf):
    """H3: sessions with a fixed gap (rows exactly ``gap`` apart share one)."""
    return W.session_windows(sensor(spark, sf), ["id"], "ts", GAP, _session_aggs())


@query("session_dynamic_gap", with_sensor(
    f"""SELECT id, make_timestamp(min(t)) AS window_start,
               make_timestamp(max(t + (CAST(vc AS BIGINT) + 1) * {DYN_GAP_UNIT_US})) AS window_end, {_AGG_SQL}
        FROM s2 GROUP BY id, session_no""",
    ctes=_SESSION_SQL.format(gap=f"(CAST(vc AS BIGINT) + 1) * {DYN_GAP_UNIT_US}")))
def session_dynamic_gap(spark, sf):
    """H4: each row brings its own gap, here ``(vc + 1) * 10 min``."""
    gap = (F.col("vc") + 1).cast("bigint") * F.lit(DYN_GAP_UNIT_US)
    return W.session_windows(sensor(spark, sf), ["id"], "ts", gap, _session_aggs())


@query("tumbling_ingest", with_sensor(
    f"""SELECT id, {bucket('arrival', SIZE_US)} AS window_start,
               {bucket('arrival', SIZE_US, SIZE_US)} AS window_end, {_AGG_SQL}
        FROM arrivals GROUP BY ALL""", arrival=True))
def tumbling_ingest(spark, sf):
    """H5: processing-time windows; the batch form takes the ingest column
    (here the replayed arrival time; live streams use ``with_ingest_time``)."""
    return W.tumbling(arrivals(spark, sf), "arrival", SIZE) \
        .groupBy("id", "window_start", "window_end").agg(*_agg_cols())


_COUNT_SQL = """n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn,
                    count(*) OVER (PARTITION BY id) AS total FROM sensor)"""


@query("count_tumbling", with_sensor(
    f"""SELECT id, (rn - 1) // 5 + 1 AS window_no, {_AGG_SQL},
               array_to_string(list(vc ORDER BY seq), ',') AS vcs
        FROM n WHERE ((rn - 1) // 5 + 1) * 5 <= total GROUP BY 1, 2""", ctes=_COUNT_SQL))
def count_tumbling(spark, sf):
    """H6 + I6: count window of 5 per key; fires only when full."""
    d = W.count_windows(sensor(spark, sf), ["id"], [*_agg_cols(), _rows()], 5)
    return d.withColumn("vcs", F.col("__l.vc")).select("id", "window_no", "n", "vc_sum", _vc_list())


@query("count_sliding", with_sensor(
    f"""SELECT id, f.w AS window_no, {_AGG_SQL},
               array_to_string(list(vc ORDER BY seq), ',') AS vcs
        FROM n JOIN (SELECT unnest(range(2, (SELECT max(total) FROM n) + 1, 2)) AS w) f
          ON n.rn <= f.w AND n.rn > f.w - 5 AND f.w <= n.total
        GROUP BY 1, 2""", ctes=_COUNT_SQL))
def count_sliding(spark, sf):
    """H7: count window (5, 2): every 2nd row fires with the last <= 5 rows."""
    d = W.count_windows(sensor(spark, sf), ["id"], [*_agg_cols(), _rows()], 5, 2)
    return d.withColumn("vcs", F.col("__l.vc")).select("id", "window_no", "n", "vc_sum", _vc_list())


@query("count_window_process", with_sensor(
    f"""SELECT id, (rn - 1) // 5 + 1 AS window_no, CAST(count(*) AS BIGINT) AS n,
               CAST(min(seq) AS BIGINT) AS first_seq, CAST(max(seq) AS BIGINT) AS last_seq,
               array_to_string(list(vc ORDER BY seq), ',') AS vcs
        FROM n WHERE ((rn - 1) // 5 + 1) * 5 <= total GROUP BY 1, 2""", ctes=_COUNT_SQL))
def count_window_process(spark, sf):
    """Full count-window function: sees all (at most 5) rows of the window."""
    aggs = [F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), _rows()]
    return W.count_windows(sensor(spark, sf), ["id"], aggs, 5) \
        .withColumn("vcs", F.col("__l.vc")).drop("__l").withColumn("vcs", _vc_list())


@query("window_all", with_sensor(
    f"SELECT {_BUCKET}, {_AGG_SQL} FROM sensor GROUP BY ALL"))
def window_all(spark, sf):
    """H9: non-keyed window.  Grouped by window only, with partial
    aggregation on every task - not funnelled through one task."""
    return W.tumbling(sensor(spark, sf), "ts", SIZE) \
        .groupBy("window_start", "window_end").agg(*_agg_cols())


@query("window_reduce_first", with_sensor(
    f"""SELECT id, {_BUCKET}, arg_min(ts, seq) AS ts, CAST(sum(vc) AS BIGINT) AS vc
        FROM sensor GROUP BY ALL"""))
def window_reduce_first(spark, sf):
    """Incremental reduce that keeps the first row's ts and sums vc."""
    return W.tumbling(sensor(spark, sf), "ts", SIZE) \
        .groupBy("id", "window_start", "window_end") \
        .agg(F.min_by("ts", "seq").alias("ts"), F.sum("vc").cast("bigint").alias("vc"))


@query("window_reduce_last", with_sensor(
    f"""SELECT id, {_BUCKET}, arg_max(ts, seq) AS ts, CAST(sum(vc) AS BIGINT) AS vc
        FROM sensor GROUP BY ALL"""))
def window_reduce_last(spark, sf):
    """The same reduce keeping the last row's ts."""
    return W.tumbling(sensor(spark, sf), "ts", SIZE) \
        .groupBy("id", "window_start", "window_end") \
        .agg(F.max_by("ts", "seq").alias("ts"), F.sum("vc").cast("bigint").alias("vc"))


@query("window_aggregate", with_sensor(
    f"""SELECT *, 'key=' || id || ' sum=' || CAST(vc_sum AS VARCHAR) AS summary
        FROM (SELECT id, {_BUCKET}, CAST(sum(vc) AS BIGINT) AS vc_sum
              FROM sensor GROUP BY ALL) w"""))
def window_aggregate(spark, sf):
    """Aggregate with distinct input, accumulator and output types
    (rows in, (id, int) accumulator, string out)."""
    return W.tumbling(sensor(spark, sf), "ts", SIZE) \
        .groupBy("id", "window_start", "window_end") \
        .agg(F.sum("vc").cast("bigint").alias("vc_sum")) \
        .withColumn("summary", F.format_string("key=%s sum=%d", "id", "vc_sum"))


@query("window_process", with_sensor(
    f"""SELECT id, {_BUCKET}, count(*) OVER (PARTITION BY id, epoch_us(ts) // {SIZE_US}) AS n,
               seq, vc FROM sensor"""))
def window_process(spark, sf):
    """I4: full-window function.  Every element is emitted with its window's
    bounds and size; the window's rows are never gathered into one value."""
    d = W.tumbling(sensor(spark, sf), "ts", SIZE)
    counts = d.groupBy("id", "window_start", "window_end").agg(F.count(F.lit(1)).alias("n"))
    return d.join(counts, ["id", "window_start", "window_end"]) \
        .select("id", "window_start", "window_end", "n", "seq", "vc")
