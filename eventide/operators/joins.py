"""Joins: keyed match, window join, interval (band) join with late rows,
broadcast-config (as-of) join, lateral table-function joins (E3, F*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventide.operators import scan
from eventide.sources.sensor import epoch_us, from_epoch_us


def keyed_match(left: DataFrame, right: DataFrame, lkey: str, rkey: str) -> DataFrame:
    """Rows of both inputs with equal keys (inner join).  The exchange on
    the key is added by the planner; AQE picks broadcast from runtime sizes
    and splits skewed partitions."""
    return left.join(right, F.col(lkey) == F.col(rkey), "inner")


def window_join(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lts: str, rts: str,
                size_us: int) -> DataFrame:
    """equal key and the same tumbling window ``[k*size, (k+1)*size)``:
    an equi-join on (key, window index).  Inputs carry distinct column
    names; adds ``window_start``/``window_end``."""
    lw = left.withColumn("__lw", F.floor(epoch_us(lts) / size_us))
    rw = right.withColumn("__rw", F.floor(epoch_us(rts) / size_us))
    j = lw.join(rw, (F.col(lkey) == F.col(rkey)) & (F.col("__lw") == F.col("__rw")))
    return (j.withColumn("window_start", from_epoch_us(F.col("__lw") * size_us))
             .withColumn("window_end", from_epoch_us((F.col("__lw") + 1) * size_us))
             .drop("__lw", "__rw"))


def interval_join(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lts: str, rts: str,
                  lower_us: int, upper_us: int, bucket_us: int | None = None) -> DataFrame:
    """equal key and ``left.ts + lower <= right.ts <= left.ts + upper``.

    Band join: time is cut into buckets of the interval's width; each left
    row is copied to the (at most two) buckets its interval touches, each
    right row sits in one bucket, and the equi-join on (key, bucket) is
    followed by the exact range test.  Every pair is produced once and no
    per-key cross product is formed.
    """
    width = bucket_us or max(upper_us - lower_us, 1)
    lt, rt = epoch_us(lts), epoch_us(rts)
    lo = F.floor((lt + F.lit(lower_us)) / width)
    hi = F.floor((lt + F.lit(upper_us)) / width)
    lb = left.withColumn("__lt", lt).withColumn("__b", F.explode(F.sequence(lo, hi)))
    rb = right.withColumn("__rt", rt).withColumn("__rb", F.floor(F.col("__rt") / width))
    cond = ((F.col(lkey) == F.col(rkey)) & (F.col("__b") == F.col("__rb"))
            & (F.col("__rt") >= F.col("__lt") + F.lit(lower_us))
            & (F.col("__rt") <= F.col("__lt") + F.lit(upper_us)))
    return lb.join(rb, cond, "inner").drop("__lt", "__b", "__rt", "__rb")


def stream_interval_join(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lts: str,
                         rts: str, lower: str, upper: str) -> DataFrame:
    """F2 streaming form: both sides watermarked; Spark keeps each side's
    state until the watermark passes the range, then drops it."""
    cond = (F.col(lkey) == F.col(rkey)) & F.expr(
        f"{rts} BETWEEN {lts} + INTERVAL {lower} AND {lts} + INTERVAL {upper}")
    return left.join(right, cond, "inner")


def stream_window_join(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lts: str, rts: str,
                       size: str) -> DataFrame:
    """F1 streaming form: both sides watermarked; equal key and equal
    tumbling window.  Spark drops a window's state once both watermarks pass
    its end."""
    lw = left.withColumn("__lw", F.window(lts, size))
    rw = right.withColumn("__rw", F.window(rts, size))
    j = lw.join(rw, (F.col(lkey) == F.col(rkey)) & (F.col("__lw") == F.col("__rw")))
    return (j.withColumn("window_start", F.col("__lw.start")).withColumn("window_end", F.col("__lw.end"))
             .drop("__lw", "__rw"))


def late_split_two_inputs(df: DataFrame, side: str, ts: str, order: list[str],
                          delay_us: int) -> DataFrame:
    """F3 helper: one arrival sequence holding both inputs (``side`` is 'L' or
    'R').  Each input's watermark is its running max event time - delay - 1 ms;
    the join's watermark is the minimum of the two, as seen *before* a row
    arrives.  Adds ``late`` (event time below that watermark).  Global scan,
    two levels (no single-task sort)."""
    t = epoch_us(ts)
    d = df.withColumn("__t", t)
    d = scan.running(d, [], order, {
        "__maxL": ("max", F.when(F.col(side) == "L", F.col("__t"))),
        "__maxR": ("max", F.when(F.col(side) == "R", F.col("__t"))),
    }, exclusive=True, chunk=scan.micros_chunk(d, order[0]))
    both = F.col("__maxL").isNotNull() & F.col("__maxR").isNotNull()
    wm = F.when(both, F.least(F.col("__maxL"), F.col("__maxR")) - F.lit(delay_us + 1000))
    # before both inputs have produced a row the combined watermark is -inf
    late = F.coalesce(F.col("__t") < wm, F.lit(False))
    return d.withColumn("late", late).drop("__t", "__maxL", "__maxR")


def asof_last(df: DataFrame, is_config: Column, value: Column, order: str,
              default, name: str = "threshold", keys=()) -> DataFrame:
    """every row sees the latest config value that arrived before it
    (``default`` before the first).  One arrival sequence holds both inputs;
    a two-level scan finds the last config row - no broadcast of the config
    history is needed, so its size never matters."""
    d = scan.previous(df, list(keys), order, value, name, where=is_config)
    return d.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def lateral_words(df: DataFrame, line: str, keep: list[str], outer: bool = False) -> DataFrame:
    """Lateral join with the split table function ``(word, length)``;
    ``outer`` keeps rows whose function output is empty (LEFT JOIN ... ON TRUE)."""
    from eventide.functions.text import words
    rows = F.transform(words(line), lambda w: F.struct(w.alias("word"), F.length(w).alias("length")))
    ex = F.explode_outer(rows) if outer else F.explode(rows)
    return df.select(*keep, ex.alias("__t")).select(*keep, "__t.word", "__t.length")
