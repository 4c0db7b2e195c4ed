"""Two-level prefix scans: running aggregates that survive hot keys.

Order-dependent operators (running sums, previous value, row numbers, the
running watermark, sessions) need a prefix over an ordered group.  A plain
``Window.partitionBy(key).orderBy(seq)`` sorts the whole group in one task,
so a key holding a third of all rows becomes a third of the job in a single
task.  Instead each group is cut into chunks of the order column:

1. a window over ``(key, chunk)`` computes the running value inside a chunk
   (every chunk holds at most ``width`` units of the order column);
2. per-chunk totals (one row per key and chunk, partially aggregated on
   every task, so the rows themselves are shuffled only once) get a prefix
   over the chunks of a key - a table ``width`` times smaller than the input;
3. the prefix is joined back on ``(key, chunk)``; AQE broadcasts it when its
   measured size allows and shuffle-joins it otherwise.

Supported kinds are ``sum``, ``count``, ``max`` and ``min``; ``max`` of a
struct whose first fields are the order columns gives the last value
(previous-row and last-non-null lookups).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

CONF_CHUNK_ROWS = "eventide.scan.chunkRows"
DEFAULT_CHUNK_ROWS = 1 << 18
CONF_CHUNK_MICROS = "eventide.scan.chunkMicros"
DEFAULT_CHUNK_MICROS = 1_000_000

_CH = "__ev_chunk"

# How each kind is computed over rows, and over partial results.
LOCAL = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
COMBINE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    return int(df.sparkSession.conf.get(key, str(default)))


def seq_chunk(df: DataFrame, order: str | Column, width: int | None = None) -> Column:
    """Chunk by ranges of an integral arrival-order column."""
    w = width or _conf_int(df, CONF_CHUNK_ROWS, DEFAULT_CHUNK_ROWS)
    c = F.col(order) if isinstance(order, str) else order
    return F.floor(c / F.lit(w))


def micros_chunk(df: DataFrame, order: str | Column, width: int | None = None) -> Column:
    """Chunk by ranges of an epoch-microsecond column."""
    w = width or _conf_int(df, CONF_CHUNK_MICROS, DEFAULT_CHUNK_MICROS)
    c = F.col(order) if isinstance(order, str) else order
    return F.floor(c / F.lit(w))


def dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows by key, for work in Python.  Adaptive execution keeps a task for every
    core unless the session sets ``parallelismFirst`` to false: it then merges
    partitions by their bytes alone, and few bytes of such rows are long work, so
    the session's number of partitions is kept."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst", "true").lower() == "true":
        return df.repartition(*by)
    return df.repartition(int(conf.get("spark.sql.shuffle.partitions")), *by)


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def running(df: DataFrame, keys: Sequence[str], order, aggs: Mapping[str, tuple[str, Column]],
            *, chunk: Column | None = None, exclusive: bool = False) -> DataFrame:
    """Add one running-aggregate column per entry of ``aggs``.

    ``order`` is a column (or list of columns) giving a total order inside a
    key; ``chunk`` maps rows to chunks that are contiguous in that order
    (default: ranges of the first order column, see ``seq_chunk``).  With
    ``exclusive`` the current row is left out (rows strictly before it).
    """
    keys = list(keys)
    order_cols = _cols(order)
    if chunk is None:
        chunk = seq_chunk(df, order_cols[0])
    names = list(aggs)
    d = df.withColumn(_CH, chunk).withColumns(
        {f"__ev_in{i}": aggs[n][1] for i, n in enumerate(names)})

    wl = Window.partitionBy(*keys, _CH).orderBy(*order_cols)
    inc = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exc = wl.rowsBetween(Window.unboundedPreceding, -1)
    local_cols = {}
    for i, n in enumerate(names):
        fn = LOCAL[aggs[n][0]]
        local_cols[f"__ev_inc{i}"] = fn(F.col(f"__ev_in{i}")).over(inc)
        if exclusive:
            local_cols[f"__ev_exc{i}"] = fn(F.col(f"__ev_in{i}")).over(exc)
    loc = d.withColumns(local_cols)

    # Chunk totals straight from the input: a partial aggregation on every
    # task, so only one small row per (key, chunk, task) is shuffled - the
    # rows themselves are shuffled once, for the window above.
    summ = d.groupBy(*keys, _CH).agg(
        *[LOCAL[aggs[n][0]](F.col(f"__ev_in{i}")).alias(f"__ev_tot{i}")
          for i, n in enumerate(names)])
    pw = Window.partitionBy(*keys).orderBy(_CH).rowsBetween(Window.unboundedPreceding, -1)
    kmap = {k: f"__ev_k{j}" for j, k in enumerate(keys)}
    pre = summ.select(
        *[F.col(k).alias(kmap[k]) for k in keys],
        F.col(_CH).alias("__ev_pch"),
        *[COMBINE[aggs[n][0]](F.col(f"__ev_tot{i}")).over(pw).alias(f"__ev_pre{i}")
          for i, n in enumerate(names)])

    cond = F.col(_CH) == F.col("__ev_pch")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(kmap[k]))
    j = loc.join(pre, cond, "left")

    out = {}
    for i, n in enumerate(names):
        kind = aggs[n][0]
        p = F.col(f"__ev_pre{i}")
        lc = F.col(f"__ev_exc{i}" if exclusive else f"__ev_inc{i}")
        if kind == "count":
            out[n] = F.coalesce(p, F.lit(0)) + F.coalesce(lc, F.lit(0))
        elif kind == "sum":
            out[n] = F.when(p.isNull(), lc).when(lc.isNull(), p).otherwise(p + lc)
        elif kind == "max":
            out[n] = F.greatest(p, lc)
        else:
            out[n] = F.least(p, lc)
    internal = [c for c in j.columns if c.startswith("__ev_")]
    return j.withColumns(out).drop(*internal)


def previous(df: DataFrame, keys: Sequence[str], order, value: Column, name: str,
             *, chunk: Column | None = None, where: Column | None = None) -> DataFrame:
    """``name`` = ``value`` of the latest earlier row of the key (optionally
    the latest earlier row satisfying ``where``); null when there is none."""
    order_cols = _cols(order)
    fields = [c.alias(f"o{i}") for i, c in enumerate(order_cols)] + [value.alias("v")]
    s = F.struct(*fields)
    if where is not None:
        s = F.when(where, s)
    r = running(df, keys, order_cols, {name: ("max", s)}, chunk=chunk, exclusive=True)
    return r.withColumn(name, F.col(name)["v"])


CONF_CHECKPOINT_CHAINS = "eventide.scan.checkpointChains"


def stage(df: DataFrame) -> DataFrame:
    """Cut lineage between chained scans.

    Each scan reads its input twice (rows for the window, partial totals for
    the prefix), so a chain of scans would recompute earlier stages over and
    over.  A reliable checkpoint in the shared folder (``spark.checkpoint.dir``)
    computes each stage once and also shortens recovery after a lost
    executor.  Disabled with ``eventide.scan.checkpointChains=false``.
    """
    spark = df.sparkSession
    if spark.conf.get(CONF_CHECKPOINT_CHAINS, "true").lower() != "true":
        return df
    from eventide.session import cut_lineage
    return cut_lineage(df, spark)
