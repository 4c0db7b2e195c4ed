"""Keyed state and the changelog bridge (K1, K6, K7, T5)."""

from __future__ import annotations

from eventide.operators import state as S
from eventide.operators.windows import micros
from eventide.plans.registry import query, sensor, with_sensor

TTL_US = micros("30 min")   # ttl 5 s, scaled
JAVA_HASH_SQL = ("CAST(CASE WHEN x >= 2147483648 THEN x - 4294967296 ELSE x END AS INTEGER)")
JAVA_HASH_X = ("list_reduce(list_transform(string_split({c}, ''), lambda ch: CAST(ascii(ch) AS BIGINT)), "
               "lambda a, u: (a * 31 + u) % 4294967296, CAST(0 AS BIGINT))")


def java_hash_sql(col: str) -> str:
    return JAVA_HASH_SQL.replace("x", f"({JAVA_HASH_X.format(c=col)})")


@query("state_jump_alert", with_sensor("""SELECT seq, id, vc, last_value FROM (
    SELECT seq, id, vc, lag(vc, 1, 0) OVER (PARTITION BY id ORDER BY seq) AS last_value FROM sensor)
    WHERE abs(vc - last_value) > 10"""))
def state_jump_alert(spark, sf):
    """K1: value state with the previous vc (0 at first); alert when the
    level jumps by more than 10."""
    return S.jump_alert(sensor(spark, sf).select("seq", "id", "vc"), ["id"], "vc", 10)


_TTL_BASE = "a AS (SELECT *, epoch_us(ts) AS t FROM sensor)"


@query("state_ttl_write_only", with_sensor(f"""
    SELECT b.seq, b.id, b.ts, b.vc, CASE WHEN b.t < w.t + {TTL_US} THEN w.vc END AS state
    FROM (SELECT *, max(CASE WHEN vc > 10 THEN seq END) OVER (PARTITION BY id ORDER BY seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wseq FROM a) b
    LEFT JOIN a w ON w.seq = b.wseq""", ctes=_TTL_BASE))
def state_ttl_write_only(spark, sf):
    """K6: ttl 30 min refreshed on create and write only."""
    return S.ttl_state(sensor(spark, sf), ["id"], "vc", "ts", TTL_US, refresh_on_read=False) \
        .select("seq", "id", "ts", "vc", "state")


@query("state_ttl_read_write", with_sensor(f"""
    SELECT seq, id, ts, vc, last_value(CASE WHEN vc > 10 THEN vc END IGNORE NULLS) OVER (
        PARTITION BY id, run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state
    FROM (SELECT *, sum(CASE WHEN pt IS NULL OR t - pt >= {TTL_US} THEN 1 ELSE 0 END)
                 OVER (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run
          FROM (SELECT *, lag(t) OVER (PARTITION BY id ORDER BY seq) AS pt FROM a))""", ctes=_TTL_BASE))
def state_ttl_read_write(spark, sf):
    """K6: ttl 30 min refreshed on read and write; expired never returned."""
    return S.ttl_state(sensor(spark, sf), ["id"], "vc", "ts", TTL_US, refresh_on_read=True) \
        .select("seq", "id", "ts", "vc", "state")


@query("durable_count", with_sensor(f"""SELECT slot, CAST(count(*) AS BIGINT) AS cnt
    FROM (SELECT CAST((((h % 128) + 128) % 128) * 4 // 128 AS INTEGER) AS slot
          FROM (SELECT {java_hash_sql('id')} AS h FROM sensor))
    GROUP BY ROLLUP (slot)"""))
def durable_count(spark, sf):
    """K7 re-aimed: counts per slot (4 slots over 128 key groups) plus the
    total (slot null)."""
    return S.durable_count(sensor(spark, sf), "id", 4)


@query("changelog_sum", with_sensor("""
    SELECT id, seq, 0 AS op_no, '+I' AS op, s AS vc_sum FROM a WHERE n = 1
    UNION ALL SELECT id, seq, 0, '-U', s - vc FROM a WHERE n > 1 AND vc <> 0
    UNION ALL SELECT id, seq, 1, '+U', s FROM a WHERE n > 1 AND vc <> 0""",
    ctes="""a AS (SELECT *, CAST(sum(vc) OVER w AS BIGINT) AS s, row_number() OVER w AS n FROM sensor
                  WINDOW w AS (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING))"""))
def changelog_sum(spark, sf):
    """T5: ``SELECT id, sum(vc) GROUP BY id`` as a changelog (+I, -U, +U)."""
    return S.changelog(sensor(spark, sf).select("id", "seq", "vc"), ["id"], "vc")

