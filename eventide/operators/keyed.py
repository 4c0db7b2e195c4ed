"""Keyed aggregation in final and running forms (G*, K3-K5).

Final forms are ``groupBy().agg`` (partial aggregation before the shuffle, so
hot keys are pre-combined on every task).  Running forms emit one row per
input row with the value after that row, in arrival order; they use the
two-level scan of ``scan.running`` so a hot key is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.operators import scan


def key_partition(df: DataFrame, keys: Sequence[str], n: int | None = None) -> DataFrame:
    """Rows of a key on one partition."""
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def running_sum(df: DataFrame, keys: Sequence[str], value: str | Column, name: str,
                order: str = "seq") -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    return scan.running(df, keys, order, {name: ("sum", v.cast("bigint"))})


def running_count(df: DataFrame, keys: Sequence[str], name: str = "count",
                  order: str | list = "seq", chunk: Column | None = None) -> DataFrame:
    return scan.running(df, keys, order, {name: ("count", F.lit(1))}, chunk=chunk)


def running_avg(df: DataFrame, keys: Sequence[str], value: str, name: str,
                order: str = "seq") -> DataFrame:
    d = scan.running(df, keys, order, {"__s": ("sum", F.col(value).cast("bigint")),
                                       "__n": ("count", F.col(value))})
    return d.withColumn(name, F.col("__s") / F.col("__n")).drop("__s", "__n")


def max_keep_first(df: DataFrame, keys: Sequence[str], field: str, other: Sequence[str],
                   order: str = "seq", use_min: bool = False) -> DataFrame:
    """``max(field)``/``min(field)``; all other fields from the key's first row."""
    agg = F.min if use_min else F.max
    first = F.min_by(F.struct(*[F.col(c) for c in other]), F.col(order)).alias("__first")
    return df.groupBy(*keys).agg(first, agg(field).alias(field)) \
        .select(*keys, *[F.col(f"__first.{c}").alias(c) for c in other], field)


def extreme_row(df: DataFrame, keys: Sequence[str], field: str, cols: Sequence[str],
                order: str = "seq", use_min: bool = False) -> DataFrame:
    """maxBy / minBy - the whole row holding the extreme value; on ties
    the earliest row wins (the numeric ``order`` is the second sort field).
    Rows without a value take no part; a key with none gives null fields."""
    tie = F.col(order) if use_min else -F.col(order)
    rank = F.when(F.col(field).isNotNull(), F.struct(F.col(field).alias("v"), tie.alias("o")))
    pick = F.min_by if use_min else F.max_by
    row = F.struct(*[F.col(c) for c in cols])
    return df.groupBy(*keys).agg(pick(row, rank).alias("__r")) \
        .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in cols])


def reduce_fields(df: DataFrame, keys: Sequence[str], fields: Mapping[str, str],
                  running: bool = False, order: str = "seq") -> DataFrame:
    """A fold given per field: ``sum``, ``min``, ``max``, ``first`` or
    ``last`` (in arrival order).  Final: one row per key, an aggregate.  Running:
    one row per input row, a two-level scan; the first row passes through.  Nulls
    count in no sum or extreme; ``first`` and ``last`` take them as they are."""
    unknown = {kind for kind in fields.values()} - {"sum", "min", "max", "first", "last"}
    if unknown:
        raise ValueError(f"unknown fold {sorted(unknown)}")
    place = {f: F.struct(F.col(order).alias("o"), F.col(f).alias("v")) for f in fields}
    extreme = {"first": "min", "last": "max"}
    aggs = {f: (extreme[k], place[f]) if k in extreme else (k, F.col(f).cast("bigint") if k == "sum" else F.col(f))
            for f, k in fields.items()}
    if running:
        out = scan.running(df, keys, order, {f"__{f}": a for f, a in aggs.items()})
    else:
        out = df.groupBy(*keys).agg(*[scan.LOCAL[kind](c).alias(f"__{f}") for f, (kind, c) in aggs.items()])
    return out.withColumns({f: F.col(f"__{f}")["v"] if k in extreme else F.col(f"__{f}") for f, k in fields.items()}) \
        .drop(*[f"__{f}" for f in fields])


def reduce_sums(df: DataFrame, keys: Sequence[str], fields: Sequence[str],
                running: bool = False, order: str = "seq") -> DataFrame:
    """G7 as the reference's fold does it: numeric fields are summed."""
    return reduce_fields(df, keys, {f: "sum" for f in fields}, running, order)


def value_counts_running(df: DataFrame, keys: Sequence[str], value: str,
                         name: str = "value_count", order: str = "seq") -> DataFrame:
    """K3 running: count of this row's value so far inside the key."""
    return scan.running(df, [*keys, value], order, {name: ("count", F.lit(1))})


def value_map_running(df: DataFrame, keys: Sequence[str], value: str, domain: Sequence,
                      name: str = "counts", order: str = "seq") -> DataFrame:
    """K3 running: after each row the whole map value -> count of its key.

    One running sum per value of ``domain``, all in one scan, so the map has at
    most that many entries; values outside the domain (and null) are not
    counted."""
    sums = {f"__v{i}": ("sum", F.when(F.col(value) == v, 1).otherwise(0)) for i, v in enumerate(domain)}
    d = scan.running(df, keys, order, sums)
    entries = F.filter(F.array(*[F.struct(F.lit(v).alias("key"), F.col(c).alias("value"))
                                 for c, v in zip(sums, domain)]), lambda e: e["value"] > 0)
    return d.withColumn(name, F.map_from_entries(entries)).drop(*sums)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """K3 final: the map value -> count per key (size = distinct values)."""
    per = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(*keys).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(value), F.col("n")))))
        .alias("counts"))
