"""Event time, watermarks and late data (W*, K8, K10) in batch form.

The batch forms replay a stream exactly: rows are processed in arrival
order, the watermark after a row is ``max(event time so far) - delay - 1 ms``
(bounded out-of-orderness; ``delay = 0`` is the monotone generator), and a
row is judged against the watermark in force *before* it arrives.  The
running maximum over the global arrival order is a two-level scan
(``scan.running`` with no key), so no step sorts the whole input in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.operators import scan
from eventide.sources.sensor import epoch_us, from_epoch_us


def assign_timestamp(df: DataFrame, field: str, unit: str = "s", name: str = "event_time") -> DataFrame:
    """Event time from a numeric field in seconds or milliseconds."""
    c = F.col(field)
    us = c * (1_000_000 if unit == "s" else 1_000)
    return df.withColumn(name, from_epoch_us(us))


def _ts(us: Column) -> Column:
    return from_epoch_us(us)


def watermark_trace(df: DataFrame, ts: str, order: Sequence[str], delay_us: int,
                    chunk: Column | None = None) -> DataFrame:
    """Adds ``wm_before`` and ``wm_after`` (null = no watermark
    yet, i.e. minus infinity) for every row, in ``order`` (arrival).  The
    first order column is epoch microseconds of arrival (chunked by time)
    unless ``chunk`` says otherwise."""
    d = df.withColumn("__t", epoch_us(ts))
    if chunk is None:
        chunk = scan.micros_chunk(d, order[0])
    d = scan.running(d, [], list(order), {"__mx_before": ("max", F.col("__t"))},
                     exclusive=True, chunk=chunk)
    lag = F.lit(delay_us + 1000)
    return (d.withColumn("wm_before", _ts(F.col("__mx_before") - lag))
             .withColumn("wm_after", _ts(F.greatest(F.col("__mx_before"), F.col("__t")) - lag))
             .drop("__t", "__mx_before"))


def periodic_watermark(df: DataFrame, ts: str, arrival: str, period_us: int,
                       delay_us: int) -> DataFrame:
    """The watermark emitted at the end of every period of arrival time
    in which it advanced.  Per-period maxima form a table of (time span /
    period) rows; its running max is a scan over that small table."""
    per = df.groupBy(F.floor(epoch_us(arrival) / period_us).alias("period")) \
        .agg(F.max(epoch_us(ts)).alias("__mx"))
    # one scan: the max over earlier periods; the watermark advanced when this
    # period's own max exceeds it
    per = scan.running(per, [], "period", {"__prev_run": ("max", F.col("__mx"))}, exclusive=True)
    per = per.withColumn("__run", F.greatest("__prev_run", "__mx"))
    adv = per.filter(F.col("__prev_run").isNull() | (F.col("__mx") > F.col("__prev_run")))
    return adv.select(
        _ts((F.col("period") + 1) * period_us).alias("period_end"),
        _ts(F.col("__run") - F.lit(delay_us + 1000)).alias("watermark"))


def idle_aware_watermark(df: DataFrame, ts: str, arrival: str, source: str, period_us: int,
                         delay_us: int, idle_us: int) -> DataFrame:
    """Per period of arrival time, the minimum watermark over the sources
    that produced a row within the idle timeout; silent sources no longer
    hold the watermark back.  Works on per-(source, period) maxima only."""
    k = -(-idle_us // period_us)  # periods a source stays active after a row
    per = df.groupBy(F.col(source).alias("source"),
                     F.floor(epoch_us(arrival) / period_us).alias("period")) \
        .agg(F.max(epoch_us(ts)).alias("__mx"))
    per = scan.running(per, ["source"], "period", {"__run": ("max", F.col("__mx"))})
    # a source's latest running max is visible in the k periods after a row
    act = per.withColumn("__p", F.explode(F.sequence(F.col("period"), F.col("period") + k - 1)))
    best = act.groupBy("__p", "source").agg(F.max("__run").alias("__run"))
    return best.groupBy("__p").agg(
        F.count(F.lit(1)).alias("active_sources"),
        _ts(F.min("__run") - F.lit(delay_us + 1000)).alias("watermark")) \
        .select(_ts((F.col("__p") + 1) * period_us).alias("period_end"), "active_sources", "watermark")


def late_classify(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str],
                  size_us: int, delay_us: int, lateness_us: int) -> DataFrame:
    """Per row, its tumbling window and class against the watermark
    before it: ``on_time``; ``late_allowed`` (window already fired, still
    within allowed lateness - the window fires again); ``too_late``
    (``end - 1 ms + lateness <= watermark`` - side output)."""
    d = watermark_trace(df, ts, order, delay_us, chunk=scan.micros_chunk(df, order[0]))
    t = epoch_us(ts)
    start = F.floor(t / size_us) * size_us
    end = start + F.lit(size_us)
    wm = epoch_us("wm_before")
    cls = (F.when(wm.isNull() | (end - 1000 > wm), F.lit("on_time"))
             .when(end - 1000 + F.lit(lateness_us) <= wm, F.lit("too_late"))
             .otherwise(F.lit("late_allowed")))
    return d.withColumn("window_start", _ts(start)).withColumn("window_end", _ts(end)) \
        .withColumn("class", cls)


def late_window_firings(classified: DataFrame, keys: Sequence[str], value: str,
                        order: Sequence[str]) -> DataFrame:
    """Every firing of every window: the main firing (all on-time rows)
    and one re-firing per late-but-allowed row with everything so far.
    ``firing`` is 0 for the main firing and k for the k-th late row."""
    wkeys = [*keys, "window_start", "window_end"]
    main = classified.filter(F.col("class") == "on_time").groupBy(*wkeys).agg(
        F.count(F.lit(1)).alias("__n0"), F.sum(F.col(value).cast("bigint")).alias("__s0"))
    late = classified.filter(F.col("class") == "late_allowed")
    late = scan.running(late, wkeys, list(order), {
        "firing": ("count", F.lit(1)), "__s": ("sum", F.col(value).cast("bigint"))},
        chunk=scan.micros_chunk(late, order[0]))
    late = late.join(main, wkeys, "left").select(
        *wkeys, "firing",
        (F.col("firing") + F.coalesce(F.col("__n0"), F.lit(0))).alias("n"),
        (F.col("__s") + F.coalesce(F.col("__s0"), F.lit(0))).alias("vc_sum"))
    main = main.select(*wkeys, F.lit(0).cast("bigint").alias("firing"),
                       F.col("__n0").alias("n"), F.col("__s0").alias("vc_sum"))
    return main.unionByName(late)


def timers(df: DataFrame, keys: Sequence[str], ts: str, after_us: int, delay_us: int) -> DataFrame:
    """K8: each row registers an event-time timer at ``ts + after``; the same
    instant registered twice for a key is one timer.  ``fired`` tells
    whether the final watermark (max event time - delay - 1 ms) reached it;
    on a finished bounded input every timer fires at end of input."""
    t = epoch_us(ts)
    tm = df.select(*keys, (t + F.lit(after_us)).alias("__timer")).distinct()
    # the final watermark is one value: a scalar subquery, evaluated once
    final_wm = df.agg(F.max(t) - F.lit(delay_us + 1000)).scalar()
    return tm.select(*keys, _ts(F.col("__timer")).alias("timer_ts"),
                     (F.col("__timer") <= final_wm).alias("fired"))


def timer_firings(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], after_us: int, delay_us: int,
                  delete_previous: bool = False) -> DataFrame:
    """K8: when each event-time timer fires.  A row registers one at ``ts + after``;
    it fires at the first row from its own on that takes the watermark (max event
    time - delay - 1 ms) forward to its time or beyond.  Gives the keys,
    ``timer_ts``, the place ``fired_<o>`` of that row in ``order`` (arrival, epoch
    microseconds first) and its ``watermark``, all null for timers that only the
    end of the input fires.  The same instant of a key registered again before it
    fires is one timer.

    With ``delete_previous`` every row first deletes the pending timer of its key.
    Then there is one row per registration, with its place in ``order`` and
    ``deleted_<o>``, the place of the row that deleted it, if one did.

    The rows that take the watermark forward are found by a scan.  Two backward
    scans look up the first of them at or behind a row, and the first that
    reaches a timer's time; the later of the two fires it.  Rows without a time
    register nothing and do not move the watermark."""
    lag, places = F.lit(delay_us + 1000), [F.col(o) for o in order]
    back = [-c for c in places]
    d = df.withColumn("__t", epoch_us(ts)).where("__t IS NOT NULL").select(*keys, *order, "__t")
    d = scan.running(d, [], list(order), {"__before": ("max", F.col("__t"))}, exclusive=True, chunk=scan.micros_chunk(d, order[0]))
    step = F.struct(*places, (F.col("__t") - lag).alias("__wm"))
    d = d.withColumn("__step", F.when(F.col("__before").isNull() | (F.col("__t") > F.col("__before")), step)).drop("__before")
    if delete_previous:
        d = scan.previous(d, keys, back, F.struct(*places), "__over", chunk=scan.micros_chunk(d, back[0]))
    d = scan.stage(scan.running(d, [], back, {"__next": ("min", F.col("__step"))}, chunk=scan.micros_chunk(d, back[0])))
    # One axis of times: a step stands before the timers of the same instant.
    steps = d.where("__step IS NOT NULL").select(F.col("__step.__wm").alias("__x"), F.lit(0).alias("__kind"), "__step")
    asked = d.select(*keys, *order, "__next", *(["__over"] if delete_previous else []), (F.col("__t") + F.lit(after_us)).alias("__x"), F.lit(1).alias("__kind"))
    if not delete_previous:
        asked = asked.select(*keys, "__next", "__x", "__kind").distinct()
    both = asked.unionByName(steps, allowMissingColumns=True)
    reached = scan.running(both, [], [-F.col("__x"), F.col("__kind"), *(back if delete_previous else [])],
                           {"__reach": ("min", F.col("__step"))}, chunk=scan.micros_chunk(both, -F.col("__x")))
    fired = F.when(F.col("__next").isNotNull() & F.col("__reach").isNotNull(), F.greatest("__next", "__reach"))
    out = reached.where("__kind = 1").withColumn("__fired", fired)
    if not delete_previous:
        return out.select(*keys, _ts(F.col("__x")).alias("timer_ts"), *[F.col(f"__fired.{o}").alias(f"fired_{o}") for o in order],
                          _ts(F.col("__fired.__wm")).alias("watermark")).distinct()
    # At its own row a deletion comes before the watermark.
    at = F.struct(*[F.col(f"__fired.{o}") for o in order])
    gone = F.col("__over").isNotNull() & (F.col("__fired").isNull() | (at >= F.col("__over")))
    return out.select(*keys, *order, _ts(F.col("__x")).alias("timer_ts"),
                      *[F.when(~gone, F.col(f"__fired.{o}")).alias(f"fired_{o}") for o in order],
                      F.when(~gone, _ts(F.col("__fired.__wm"))).alias("watermark"),
                      *[F.when(gone, F.col(f"__over.{o}")).alias(f"deleted_{o}") for o in order])
