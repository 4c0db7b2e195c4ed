"""Window, interval, broadcast-config and lateral joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import joins as J
from eventide.operators.windows import micros
from eventide.plans.q_basic import DOC_LINES_SQL
from eventide.plans.registry import query, sensor, with_sensor
from eventide.sources.tables import spread, table
from eventide.operators.transforms import split_lines
from eventide.sources.sensor import sensor_view

SIZE_US = micros("1 h")
HALF_US = micros("30 min")
_SIDES = """l AS (SELECT seq, id, ts FROM sensor WHERE event_type IN ('click', 'view', 'signup')),
    r AS (SELECT seq, id, ts FROM sensor WHERE event_type NOT IN ('click', 'view', 'signup'))"""


def _sides(spark, sf):
    """Two inputs from one table: click/view/signup rows on the left, the
    other event types on the right (distinct column names per side)."""
    s = sensor_view(table(spark, sf, "events"), ("event_type",))
    left_rows = F.col("event_type").isin("click", "view", "signup")
    left = s.filter(left_rows).select(F.col("seq").alias("l_seq"), F.col("id").alias("l_id"),
                                      F.col("ts").alias("l_ts"))
    right = s.filter(~left_rows).select(F.col("seq").alias("r_seq"), F.col("id").alias("r_id"),
                                        F.col("ts").alias("r_ts"))
    return left, right


@query("window_join", with_sensor(f"""SELECT l.seq AS l_seq, r.seq AS r_seq,
        make_timestamp((epoch_us(l.ts) // {SIZE_US}) * {SIZE_US}) AS window_start,
        make_timestamp((epoch_us(l.ts) // {SIZE_US}) * {SIZE_US} + {SIZE_US}) AS window_end
    FROM l JOIN r ON l.id = r.id AND epoch_us(l.ts) // {SIZE_US} = epoch_us(r.ts) // {SIZE_US}""", ctes=_SIDES))
def window_join(spark, sf):
    """pairs with equal key in the same 1 h tumbling window."""
    left, right = _sides(spark, sf)
    return J.window_join(left, right, "l_id", "r_id", "l_ts", "r_ts", SIZE_US) \
        .select("l_seq", "r_seq", "window_start", "window_end")


@query("interval_join", with_sensor(f"""SELECT l.seq AS l_seq, r.seq AS r_seq FROM l JOIN r
    ON l.id = r.id AND epoch_us(r.ts) BETWEEN epoch_us(l.ts) - {HALF_US} AND epoch_us(l.ts) + {HALF_US}""",
    ctes=_SIDES))
def interval_join(spark, sf):
    """equal key, right time within +-30 min of left (ends included);
    bucketed band join."""
    left, right = _sides(spark, sf)
    return J.interval_join(left, right, "l_id", "r_id", "l_ts", "r_ts", -HALF_US, HALF_US) \
        .select("l_seq", "r_seq")


@query("broadcast_threshold", with_sensor("""SELECT seq, id, vc, threshold FROM (
    SELECT *, coalesce(last_value(CASE WHEN event_type = 'error' THEN vc END IGNORE NULLS) OVER (
        ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS threshold FROM sensor)
    WHERE event_type <> 'error' AND vc > threshold"""))
def broadcast_threshold(spark, sf):
    """config rows (event type 'error' carrying a threshold in vc) and
    data rows in one arrival order; a data row alerts when vc exceeds the
    latest threshold (0 before any)."""
    s = sensor_view(table(spark, sf, "events"), ("event_type",))
    is_cfg = F.col("event_type") == "error"
    d = J.asof_last(s, is_cfg, F.col("vc"), "seq", 0)
    return d.filter(~is_cfg & (F.col("vc") > F.col("threshold"))).select("seq", "id", "vc", "threshold")


def _lines(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return split_lines(docs, "text", ["doc_id"])


@query("lateral_cross", f"WITH {DOC_LINES_SQL} SELECT doc_id, line_no, word, length(word) AS length FROM w")
def lateral_cross(spark, sf):
    """``FROM lines, LATERAL split(line)`` - rows without words vanish."""
    return J.lateral_words(_lines(spark, sf), "line", ["doc_id", "line_no"])


@query("lateral_left", f"""WITH {DOC_LINES_SQL}
    SELECT doc_id, line_no, unnest(CASE WHEN len(ws) = 0 THEN [NULL] ELSE ws END) AS word,
           length(unnest(CASE WHEN len(ws) = 0 THEN [NULL] ELSE ws END)) AS length FROM w0""")
def lateral_left(spark, sf):
    """``LEFT JOIN LATERAL split(line) AS T(word, length) ON TRUE``."""
    return J.lateral_words(_lines(spark, sf), "line", ["doc_id", "line_no"], outer=True)
