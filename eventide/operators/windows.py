"""Window assigners (tumbling, sliding, session, count, processing time)
and the window functions applied to them.

Time windows are ``[start, end)`` aligned to the epoch.  Window bounds are
returned flat as ``window_start`` / ``window_end``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.operators import scan
from eventide.sources.sensor import epoch_us, from_epoch_us

US = {"ms": 1_000, "s": 1_000_000, "min": 60_000_000, "h": 3_600_000_000}


def micros(duration: str) -> int:
    """'10 s', '30 min', '1 h', '250 ms' -> microseconds."""
    num, unit = duration.split()
    return int(float(num) * US[unit])


def _interval(duration: str) -> str:
    num, unit = duration.split()
    return f"{num} {dict(ms='milliseconds', s='seconds', min='minutes', h='hours')[unit]}"


def _flat(df: DataFrame, wcol: str = "__w") -> DataFrame:
    return (df.withColumn("window_start", F.col(f"{wcol}.start"))
              .withColumn("window_end", F.col(f"{wcol}.end")).drop(wcol))


def tumbling(df: DataFrame, ts: str, size: str) -> DataFrame:
    """H1: each row to the one window ``[k*size, (k+1)*size)`` holding it."""
    return _flat(df.withColumn("__w", F.window(ts, _interval(size))))


def sliding(df: DataFrame, ts: str, size: str, slide: str) -> DataFrame:
    """H2: each row to the ``size/slide`` windows holding it (one output row each)."""
    return _flat(df.withColumn("__w", F.window(ts, _interval(size), _interval(slide))))


def sliding_windows(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
                    aggs: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """H2 aggregated: one row per key and sliding window, put together from slices.

    Windows begin at multiples of ``slide``; all their ends lie at multiples of the
    greatest common divisor of size and slide, so the rows between two of these,
    a slice, share all their windows.  Rows are aggregated into slices first (partly
    on every task); only slices are copied to the ``size / slide`` windows that hold
    them.  ``aggs`` maps a name to ``(kind, column)`` with the kinds of
    ``scan.running``.  Rows with a null time are in no window; with ``slide`` beyond
    ``size`` those between windows are in none, either."""
    size_us, slide_us = micros(size), micros(slide)
    width = math.gcd(size_us, slide_us)
    t = epoch_us(ts)
    slices = df.withColumn("__slice", t - F.pmod(t, F.lit(width))).where("__slice IS NOT NULL") \
        .groupBy(*keys, "__slice").agg(*[scan.LOCAL[kind](c).alias(name) for name, (kind, c) in aggs.items()])
    least = F.col("__slice") + F.lit(width - size_us)         # no window that holds the slice begins before
    first, last = least + F.pmod(-least, F.lit(slide_us)), F.col("__slice") - F.pmod("__slice", F.lit(slide_us))
    starts = F.when(first <= last, F.sequence(first, last, F.lit(slide_us).cast("bigint")))
    windows = slices.withColumn("__start", F.explode(starts)).groupBy(*keys, "__start") \
        .agg(*[scan.COMBINE[kind](name).alias(name) for name, (kind, _) in aggs.items()])
    return windows.select(*keys, from_epoch_us(F.col("__start")).alias("window_start"),
                          from_epoch_us(F.col("__start") + F.lit(size_us)).alias("window_end"), *aggs)


def with_ingest_time(df: DataFrame, name: str = "ingest_ts") -> DataFrame:
    """H5: processing time as a column; one value per query / micro-batch."""
    return df.withColumn(name, F.current_timestamp())


def session(df: DataFrame, keys: Sequence[str], ts: str, gap: str | Column,
            order: Sequence[str] = ("seq",), name: str = "session_no") -> DataFrame:
    """H3/H4: number the sessions of each key.

    Each row opens ``[ts, ts + gap)``; rows whose spans overlap or touch share
    a session.  ``gap`` is a fixed duration or a per-row microsecond column
    (dynamic gap).  A row starts a new session when its time lies beyond the
    end of every earlier row of its key.  Both passes are two-level scans, so
    a hot key is spread over many tasks.  Adds ``name`` (1, 2, ... per key)
    and the helper columns ``__ts_us`` / ``__gap_us`` that ``session_bounds``
    aggregates.
    """
    gap_us = F.lit(micros(gap)) if isinstance(gap, str) else gap
    d = df.withColumn("__ts_us", epoch_us(ts)).withColumn("__gap_us", gap_us.cast("bigint"))
    ordering = ["__ts_us", *order]
    chunk = scan.micros_chunk(d, "__ts_us")
    d = scan.running(d, keys, ordering,
                     {"__prev_end": ("max", F.col("__ts_us") + F.col("__gap_us"))},
                     chunk=chunk, exclusive=True)
    d = d.withColumn("__open", F.when(F.col("__prev_end").isNull()
                                      | (F.col("__ts_us") > F.col("__prev_end")), 1).otherwise(0))
    d = scan.running(d, keys, ordering, {name: ("sum", F.col("__open"))},
                     chunk=scan.micros_chunk(d, "__ts_us"))
    return d.drop("__prev_end", "__open")


def session_bounds(grouped_cols: list[Column]) -> list[Column]:
    """Aggregates giving a session's ``[first ts, last end)``."""
    return [
        from_epoch_us(F.min("__ts_us")).alias("window_start"),
        from_epoch_us(F.max(F.col("__ts_us") + F.col("__gap_us"))).alias("window_end"),
        *grouped_cols,
    ]


def session_windows(df: DataFrame, keys: Sequence[str], ts: str, gap: str | Column,
                    aggs: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """H3/H4: one row per session with ``[first ts, last end)`` and its aggregates.

    ``gap`` is as in ``session``; ``aggs`` maps a name to ``(kind, column)`` with
    the kinds of ``scan.running``.  Two rows whose gaps are at least ``2**n``
    microseconds and whose times share a bucket of that width always belong to
    one session, so rows are first aggregated by (key, n, bucket) with ``2**n``
    the largest power within their gap.  That combines on every task, and leaves
    of a hot key one row per bucket; ``session_window`` then merges those spans.
    Rows with a null time or a gap that is null or not positive open no session
    and are left out.
    """
    gap_us = (F.lit(micros(gap)) if isinstance(gap, str) else gap).cast("bigint")
    d = df.withColumns({"__t": epoch_us(ts), "__gap": gap_us}).where("__t IS NOT NULL AND __gap > 0")
    d = d.withColumn("__n", F.length(F.bin("__gap")) - 1)
    d = d.withColumn("__b", F.call_function("shiftright", F.col("__t"), F.col("__n")))
    spans = d.groupBy(*keys, "__n", "__b").agg(
        F.min("__t").alias("__start"), F.max(F.col("__t") + F.col("__gap")).alias("__end"),
        *[scan.LOCAL[kind](c).alias(name) for name, (kind, c) in aggs.items()])
    # session_window merges spans that touch, as sessions do
    length = ((F.col("__end") - F.col("__start")) / F.lit(1_000_000)).cast("decimal(18,6)")
    exact = F.make_interval(secs=length)
    spans = spans.withColumn("__at", F.timestamp_micros("__start"))
    merged = spans.groupBy(*keys, F.session_window("__at", exact).alias("__w")).agg(
        from_epoch_us(F.min("__start")).alias("window_start"), from_epoch_us(F.max("__end")).alias("window_end"),
        *[scan.COMBINE[kind](name).alias(name) for name, (kind, _) in aggs.items()])
    return merged.drop("__w")


def count_number(df: DataFrame, keys: Sequence[str], order: str = "seq",
                 name: str = "rn") -> DataFrame:
    """Row number inside each key in arrival order (two-level, hot-key safe)."""
    return scan.running(df, keys, order, {name: ("count", F.lit(1))})


def count_tumbling(df: DataFrame, keys: Sequence[str], size: int = 5,
                   order: str = "seq") -> DataFrame:
    """H6: rows of a key in blocks of ``size``; a block fires only when full.

    Adds ``window_no`` (1-based) and keeps rows of full blocks only.
    """
    d = count_number(df, keys, order).withColumn("window_no", F.floor((F.col("rn") - 1) / size) + 1)
    held = F.count(F.lit(1)).over(Window.partitionBy(*keys, "window_no"))       # at most size rows
    return d.withColumn("__held", held).filter(F.col("__held") == size).drop("__held")


def count_sliding(df: DataFrame, keys: Sequence[str], size: int = 5, slide: int = 2,
                  order: str = "seq") -> DataFrame:
    """H7: every ``slide``-th row of a key fires with the last ``size`` rows.

    Each row is copied to the firings it belongs to (at most
    ``ceil(size/slide)`` copies); adds ``window_no`` = row number of the
    firing row.  Firings past the last row of the key do not happen.
    """
    d = count_number(df, keys, order)
    first = F.ceil(F.col("rn") / slide) * slide              # firing f holds rows f-size+1 .. f
    firings = F.sequence(first, first + F.lit((-(-size // slide) - 1) * slide), F.lit(slide).cast("bigint"))
    d = d.withColumn("window_no", F.explode(firings)).filter(F.col("window_no") - size < F.col("rn"))
    last = F.max("rn").over(Window.partitionBy(*keys, "window_no"))
    return d.withColumn("__last", last).filter(F.col("__last") == F.col("window_no")).drop("__last")


def count_windows(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], size: int = 5,
                  slide: int | None = None, order: str = "seq") -> DataFrame:
    """H6/H7 aggregated: one row per fired window (tumbling without ``slide``).

    A tumbling window has fired when it holds ``size`` rows, a sliding one when
    it holds the row its number names, so no total per key is needed."""
    d = count_number(df, keys, order)
    if slide is None:
        d = d.withColumn("window_no", F.floor((F.col("rn") - 1) / size) + 1)
        fired = F.col("__rows") == size
    else:
        first = F.ceil(F.col("rn") / slide) * slide
        firings = F.sequence(first, first + F.lit((-(-size // slide) - 1) * slide), F.lit(slide).cast("bigint"))
        d = d.withColumn("window_no", F.explode(firings)).filter(F.col("window_no") - size < F.col("rn"))
        fired = F.col("__last") == F.col("window_no")
    out = d.groupBy(*keys, "window_no").agg(*aggs, F.count(F.lit(1)).alias("__rows"), F.max("rn").alias("__last"))
    return out.filter(fired).drop("__rows", "__last")
