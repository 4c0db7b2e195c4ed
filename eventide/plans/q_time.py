"""Event time, watermarks, late data, timers (W*, F3, K8, K10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import joins as J
from eventide.operators import scan
from eventide.operators import watermark as WM
from eventide.operators.windows import micros
from eventide.plans.registry import arrivals, query, sensor, with_sensor
from eventide.sources.sensor import epoch_s

# Reference durations scaled to the sparse test events.
DELAY_US = micros("20 min")       # out-of-orderness 3 s
LATENESS_US = micros("20 min")    # allowed lateness 2 s
SIZE_US = micros("1 h")           # window 10 s
TIMER_US = micros("30 min")       # timer +5 s
PERIOD_US = micros("10 min")      # periodic watermark emit
IDLE_US = micros("30 min")        # idleness 5 s
HALF_US = micros("30 min")        # interval join +-2 s
LAG = DELAY_US + 1000             # watermark = max - delay - 1 ms
ARR = ["arrival_us", "seq"]
ARR_SQL = "ORDER BY arrival_us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@query("assign_timestamp", with_sensor(
    "SELECT seq, epoch_us(ts) // 1000000 AS ts_s, make_timestamp((epoch_us(ts) // 1000000) * 1000000) "
    "AS event_time FROM sensor"))
def assign_timestamp(spark, sf):
    """Event time assigned from a seconds field (x 1000 ms)."""
    s = sensor(spark, sf).select("seq", epoch_s("ts").alias("ts_s"))
    return WM.assign_timestamp(s, "ts_s", "s")


@query("watermark_trace", with_sensor(f"""SELECT seq, id, ts, arrival,
        make_timestamp(mb - {LAG}) AS wm_before, make_timestamp(greatest(mb, epoch_us(ts)) - {LAG}) AS wm_after
    FROM (SELECT *, max(epoch_us(ts)) OVER ({ARR_SQL}) AS mb FROM arrivals)""", arrival=True))
def watermark_trace(spark, sf):
    """The watermark before and after every row (punctuated:
    one watermark per row), bounded out-of-orderness 20 min."""
    a = arrivals(spark, sf)
    return WM.watermark_trace(a, "ts", ARR, DELAY_US) \
        .select("seq", "id", "ts", "arrival", "wm_before", "wm_after")


@query("watermark_periodic", with_sensor(f"""SELECT make_timestamp((period + 1) * {PERIOD_US}) AS period_end,
        make_timestamp(run - {LAG}) AS watermark
    FROM (SELECT period, run, lag(run) OVER (ORDER BY period) AS prev FROM (
        SELECT period, max(mx) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS run FROM (
            SELECT arrival_us // {PERIOD_US} AS period, max(epoch_us(ts)) AS mx FROM arrivals GROUP BY 1)))
    WHERE prev IS NULL OR run > prev""", arrival=True))
def watermark_periodic(spark, sf):
    """Periodic generator - the watermark emitted every 10 min of
    arrival time, only when it advanced."""
    return WM.periodic_watermark(arrivals(spark, sf), "ts", "arrival", PERIOD_US, DELAY_US)


@query("watermark_idle_sources", with_sensor(f"""SELECT make_timestamp((pp + 1) * {PERIOD_US}) AS period_end,
        CAST(count(*) AS BIGINT) AS active_sources, make_timestamp(min(run) - {LAG}) AS watermark
    FROM (SELECT pp, source, max(run) AS run FROM (
        SELECT source, period + k AS pp, run FROM (
            SELECT source, period, max(mx) OVER (PARTITION BY source ORDER BY period ROWS UNBOUNDED PRECEDING) AS run
            FROM (SELECT event_type AS source, arrival_us // {PERIOD_US} AS period, max(epoch_us(ts)) AS mx
                  FROM arrivals GROUP BY 1, 2)) r
        CROSS JOIN (SELECT range AS k FROM range(0, {-(-IDLE_US // PERIOD_US)})) c) GROUP BY 1, 2)
    GROUP BY pp""", arrival=True))
def watermark_idle_sources(spark, sf):
    """sources = event types; a source silent for 30 min stops holding
    the combined (minimum) watermark back."""
    a = arrivals(spark, sf, ("event_type",))
    return WM.idle_aware_watermark(a, "ts", "arrival", "event_type", PERIOD_US, DELAY_US, IDLE_US)


_CLASS_CTE = f"""c AS (SELECT *, (epoch_us(ts) // {SIZE_US}) * {SIZE_US} AS s,
            max(epoch_us(ts)) OVER ({ARR_SQL}) - {LAG} AS wm FROM arrivals),
    c2 AS (SELECT *, CASE WHEN wm IS NULL OR s + {SIZE_US} - 1000 > wm THEN 'on_time'
                          WHEN s + {SIZE_US} - 1000 + {LATENESS_US} <= wm THEN 'too_late'
                          ELSE 'late_allowed' END AS class FROM c)"""


def _classified(spark, sf):
    return WM.late_classify(arrivals(spark, sf), ["id"], "ts", ARR, SIZE_US, DELAY_US, LATENESS_US)


@query("late_classify", with_sensor(
    f"""SELECT seq, id, ts, make_timestamp(s) AS window_start, make_timestamp(s + {SIZE_US}) AS window_end,
               class FROM c2""", ctes=_CLASS_CTE, arrival=True))
def late_classify(spark, sf):
    """Each row against the watermark before it: on time, late but
    allowed (window re-fires), or too late (side output)."""
    return _classified(spark, sf).select("seq", "id", "ts", "window_start", "window_end", "class")


@query("late_side_output", with_sensor(
    "SELECT seq, id, ts, vc FROM c2 WHERE class = 'too_late'", ctes=_CLASS_CTE, arrival=True))
def late_side_output(spark, sf):
    """The late-data side output (rows beyond the allowed lateness)."""
    return _classified(spark, sf).filter(F.col("class") == "too_late").select("seq", "id", "ts", "vc")


@query("late_window_firings", with_sensor(f"""
    SELECT id, make_timestamp(s) AS window_start, make_timestamp(s + {SIZE_US}) AS window_end,
           CAST(0 AS BIGINT) AS firing, CAST(n0 AS BIGINT) AS n, CAST(s0 AS BIGINT) AS vc_sum FROM main
    UNION ALL
    SELECT l.id, make_timestamp(l.s), make_timestamp(l.s + {SIZE_US}), CAST(l.firing AS BIGINT),
           CAST(l.firing + coalesce(m.n0, 0) AS BIGINT), CAST(l.sl + coalesce(m.s0, 0) AS BIGINT)
    FROM late l LEFT JOIN main m ON l.id = m.id AND l.s = m.s""",
    ctes=_CLASS_CTE + """,
    main AS (SELECT id, s, count(*) AS n0, sum(vc) AS s0 FROM c2 WHERE class = 'on_time' GROUP BY id, s),
    late AS (SELECT id, s, row_number() OVER (PARTITION BY id, s ORDER BY arrival_us, seq) AS firing,
                    sum(vc) OVER (PARTITION BY id, s ORDER BY arrival_us, seq ROWS UNBOUNDED PRECEDING) AS sl
             FROM c2 WHERE class = 'late_allowed')""", arrival=True))
def late_window_firings(spark, sf):
    """The full-window results of every firing: the main firing when
    the watermark passes the window end, plus one re-firing per late-but-
    allowed row (with all rows so far)."""
    c = scan.stage(_classified(spark, sf))   # read by both firing branches
    return WM.late_window_firings(c, ["id"], "vc", ARR)


@query("timer_event_time", with_sensor(f"""SELECT DISTINCT id, make_timestamp(epoch_us(ts) + {TIMER_US}) AS timer_ts,
        epoch_us(ts) + {TIMER_US} <= (SELECT max(epoch_us(ts)) FROM sensor) - {LAG} AS fired FROM sensor"""))
def timer_event_time(spark, sf):
    """K8: a timer 30 min after each row's event time; duplicates per key
    collapse; fired = reached by the final watermark."""
    return WM.timers(sensor(spark, sf), ["id"], "ts", TIMER_US, DELAY_US)


_TIMER_CTE = f"""r AS (SELECT *, epoch_us(ts) AS t, row_number() OVER (ORDER BY arrival_us, seq) AS pos,
            max(epoch_us(ts)) OVER ({ARR_SQL}) AS mb FROM arrivals),
    adv AS (SELECT pos, seq, t - {LAG} AS wm FROM r WHERE mb IS NULL OR t > mb),
    tm AS (SELECT id, seq, pos, t + {TIMER_US} AS due, lead(pos) OVER k AS over_pos, lead(seq) OVER k AS over_seq
           FROM r WINDOW k AS (PARTITION BY id ORDER BY pos)),
    due AS (SELECT tm.*, adv.pos AS p1 FROM tm ASOF LEFT JOIN adv ON tm.due <= adv.wm),
    nxt AS (SELECT due.*, adv.pos AS p2 FROM due ASOF LEFT JOIN adv ON due.pos <= adv.pos),
    fires AS (SELECT nxt.*, adv.pos AS fired_pos, adv.seq AS fired_seq, make_timestamp(adv.wm) AS watermark
              FROM nxt LEFT JOIN adv ON adv.pos = CASE WHEN p1 IS NOT NULL AND p2 IS NOT NULL THEN greatest(p1, p2) END)"""


@query("timer_firings", with_sensor(
    "SELECT DISTINCT id, make_timestamp(due) AS timer_ts, fired_seq, watermark FROM fires", ctes=_TIMER_CTE, arrival=True))
def timer_firings(spark, sf):
    """K8: the row at which each timer fires and the watermark at that moment, in
    arrival order (null: fired by the end of the input)."""
    return WM.timer_firings(arrivals(spark, sf), ["id"], "ts", ARR, TIMER_US, DELAY_US) \
        .select("id", "timer_ts", "fired_seq", "watermark")


@query("timer_deleted", with_sensor("""
    SELECT id, seq, make_timestamp(due) AS timer_ts,
           CASE WHEN NOT gone THEN fired_seq END AS fired_seq, CASE WHEN NOT gone THEN watermark END AS watermark,
           CASE WHEN gone THEN over_seq END AS deleted_seq
    FROM (SELECT *, over_pos IS NOT NULL AND (fired_pos IS NULL OR fired_pos >= over_pos) AS gone FROM fires)""",
    ctes=_TIMER_CTE, arrival=True))
def timer_deleted(spark, sf):
    """K8, delete variant: each row replaces its key's pending timer, so a timer
    fires only if its key stays silent until the watermark reaches it."""
    return WM.timer_firings(arrivals(spark, sf), ["id"], "ts", ARR, TIMER_US, DELAY_US, delete_previous=True) \
        .select("id", "seq", "timer_ts", "fired_seq", "watermark", "deleted_seq")


_SIDES_SQL = """ev AS (SELECT seq, id, ts, arrival_us,
        CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'L' ELSE 'R' END AS side FROM arrivals)"""


def _sides(spark, sf):
    a = arrivals(spark, sf, ("event_type",))
    return a.withColumn("side", F.when(F.col("event_type").isin("click", "view", "signup"), "L")
                        .otherwise("R")).drop("event_type")


@query("interval_join_late", with_sensor(f"""
    SELECT 'pair' AS kind, l.seq AS l_seq, r.seq AS r_seq
    FROM lt l JOIN lt r ON l.side = 'L' AND r.side = 'R' AND NOT l.late AND NOT r.late AND l.id = r.id
         AND epoch_us(r.ts) BETWEEN epoch_us(l.ts) - {HALF_US} AND epoch_us(l.ts) + {HALF_US}
    UNION ALL SELECT 'late_left', seq, NULL FROM lt WHERE side = 'L' AND late
    UNION ALL SELECT 'late_right', NULL, seq FROM lt WHERE side = 'R' AND late""",
    ctes=_SIDES_SQL + f""",
    m AS (SELECT *, max(CASE WHEN side = 'L' THEN epoch_us(ts) END) OVER ({ARR_SQL}) AS ml,
                    max(CASE WHEN side = 'R' THEN epoch_us(ts) END) OVER ({ARR_SQL}) AS mr FROM ev),
    lt AS (SELECT *, coalesce(epoch_us(ts) < CASE WHEN ml IS NOT NULL AND mr IS NOT NULL
                                                  THEN least(ml, mr) - {LAG} END, false) AS late FROM m)""",
    arrival=True))
def interval_join_late(spark, sf):
    """interval join (+-30 min) whose late rows (event time below the
    join's watermark = minimum of both inputs) go to per-side outputs."""
    d = scan.stage(J.late_split_two_inputs(_sides(spark, sf), "side", "ts", ARR, DELAY_US))
    on = d.filter(~F.col("late"))
    left = on.filter(F.col("side") == "L").select(F.col("seq").alias("l_seq"), F.col("id").alias("l_id"),
                                                   F.col("ts").alias("l_ts"))
    right = on.filter(F.col("side") == "R").select(F.col("seq").alias("r_seq"), F.col("id").alias("r_id"),
                                                    F.col("ts").alias("r_ts"))
    pairs = J.interval_join(left, right, "l_id", "r_id", "l_ts", "r_ts", -HALF_US, HALF_US) \
        .select(F.lit("pair").alias("kind"), "l_seq", "r_seq")
    late = d.filter(F.col("late")).select(
        F.when(F.col("side") == "L", "late_left").otherwise("late_right").alias("kind"),
        F.when(F.col("side") == "L", F.col("seq")).alias("l_seq"),
        F.when(F.col("side") == "R", F.col("seq")).alias("r_seq"))
    return pairs.unionByName(late)
