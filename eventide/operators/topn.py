"""Top-N (J*).

``row_number() <= n`` over a partition is planned by Spark with a partial
``WindowGroupLimit`` before the shuffle, so every task sends at most ``n``
rows per group onward - a hot group never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
          name: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order) if group else Window.orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def count_top_n(df: DataFrame, group: Sequence[str], item: str, n: int) -> DataFrame:
    """Count per (group, item), then the ``n`` most frequent items per
    group; ties by item ascending."""
    counts = df.groupBy(*group, item).agg(F.count(F.lit(1)).alias("cnt"))
    return top_n(counts, group, [F.desc("cnt"), F.asc(item)], n)


def top_values(df: DataFrame, value: str, n: int = 2, keys: Sequence[str] = (),
               positive_only: bool = False) -> DataFrame:
    """Table aggregate emitting ``(value, rank)``; duplicates keep
    separate ranks.  ``positive_only`` reproduces the reference's (0, 0) start
    value, under which values <= 0 never appear."""
    d = df.select(*keys, value)
    if positive_only:
        d = d.filter(F.col(value) > 0)
    return top_n(d, list(keys), [F.desc(value)], n)


def _sieve(df: DataFrame, value: Column, k: int, keys: Sequence, order: Sequence, prefix: str) -> DataFrame:
    """Adds the running ``k`` largest values of a window, largest first, as
    ``<prefix>0 ..``, and those before the row as ``<prefix>b0 ..``.

    The largest is a running maximum.  A row passes the lesser of its value and the
    maximum before it on, and the running maximum of what is passed on is the second
    largest, and so forth: each value sinks past all that are larger."""
    w = Window.partitionBy(*keys).orderBy(*order)
    upto, before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, -1)
    d = df.withColumn(f"{prefix}v", value)
    for i in range(k):
        d = d.withColumns({f"{prefix}{i}": F.max(f"{prefix}v").over(upto), f"{prefix}b{i}": F.max(f"{prefix}v").over(before)})
        held = F.col(f"{prefix}b{i}")
        d = d.withColumn(f"{prefix}v", F.when(F.col(f"{prefix}v").isNotNull() & held.isNotNull(), F.least(f"{prefix}v", held)))
    return d.drop(f"{prefix}v")


def running_top_k(df: DataFrame, keys: Sequence[str], value: str, k: int = 3,
                  order: str = "seq") -> DataFrame:
    """K2/J4 running: adds ``top<k>``, the ``k`` largest values of the key so far,
    largest first; equal values stand side by side.  Nulls and NaN are passed over.

    Two-level, like ``scan.running``: running maxima inside a chunk of a key, the
    last of each chunk carried over the chunks (``k`` values a chunk), and both
    put together by array functions."""
    from eventide.operators.scan import seq_chunk

    keys = list(keys)
    by = [*keys, "__tk_chunk"]
    v = F.when(~F.isnan(value), F.col(value)) if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)) else F.col(value)
    tops, earlier = [f"__tk_l{i}" for i in range(k)], [f"__tk_pb{i}" for i in range(k)]
    loc = _sieve(df.withColumn("__tk_chunk", seq_chunk(df, order)), v, k, by, [order], "__tk_l").drop(*[f"__tk_lb{i}" for i in range(k)])
    last = loc.groupBy(*by).agg(*[F.max(c).alias(c) for c in tops])
    flat = last.select(*by, F.posexplode(F.array(*tops)).alias("__tk_i", "__tk_x"))
    pre = _sieve(flat, F.col("__tk_x"), k, keys, ["__tk_chunk", "__tk_i"], "__tk_p").where("__tk_i = 0")
    names = {c: f"__tk_k{i}" for i, c in enumerate(by)}
    pre = pre.select(*[F.col(c).alias(n) for c, n in names.items()], *earlier)
    same = F.lit(True)
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    found = F.filter(F.array(*tops, *earlier), lambda x: x.isNotNull())
    out = loc.join(pre, same, "left").withColumn(f"top{k}", F.slice(F.sort_array(found, asc=False), 1, k))
    return out.drop("__tk_chunk", *tops, *earlier, *names.values())
