"""Projection, filter, row expansion, splitting and combining (C*, D*, E1-E2).

User functions are plain ``DataFrame -> DataFrame`` callables (U6), applied
with ``df.transform(...)``; parameters are bound with closures.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from eventide.functions.text import lines, words
from eventide.sources.sensor import epoch_s


def map_project(*cols: str | Column) -> Callable[[DataFrame], DataFrame]:
    """Keep / compute the given fields."""
    return lambda df: df.select(*cols)


def filter_eq(col: str, value) -> Callable[[DataFrame], DataFrame]:
    """Parametrised equality filter (reaches the scan where ``col`` is a stored column)."""
    return lambda df: df.filter(F.col(col) == F.lit(value))


def flat_map(df: DataFrame, outputs: Column, keep: list[str] | None = None,
             name: str = "value") -> DataFrame:
    """0..n outputs per row.  ``outputs`` is an array expression; null or
    empty arrays emit nothing.  Adds ``pos`` (position inside the row)."""
    keep = keep or []
    return df.select(*keep, F.posexplode(outputs).alias("pos", name))


def sensor_flatmap_outputs() -> Column:
    """The reference's case rule: s1 -> vc, id; s2 -> ts, vc, id; other -> id
    (ts as epoch seconds, the unit of the sensor record)."""
    vc = F.col("vc").cast("string")
    ts = epoch_s("ts").cast("string")
    return (F.when(F.col("id") == "s1", F.array(vc, F.col("id")))
             .when(F.col("id") == "s2", F.array(ts, vc, F.col("id")))
             .otherwise(F.array(F.col("id"))))


def split_lines(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """A2 over a text column: one row per line, with its line number."""
    return df.select(*keep, F.posexplode(lines(text)).alias("line_no", "line"))


def split_words(df: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """C4: one row per word of a line, Java split semantics."""
    return df.select(*keep, F.posexplode(words(line)).alias("word_no", "word"))


def rich_map(df: DataFrame, fn: Callable[[pd.DataFrame, dict], pd.DataFrame], schema: str,
             open_fn: Callable[[], dict] | None = None,
             close_fn: Callable[[dict], None] | None = None) -> DataFrame:
    """Map with a per-task life cycle.  ``open_fn`` runs once per task
    before the first batch; its result and the number of the task (``task``) are
    handed to every call.  ``close_fn`` runs once after the last batch, also on
    failure.  Batches arrive through Arrow."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ctx = {"task": TaskContext.get().partitionId(), **(open_fn() if open_fn else {})}
        try:
            for b in batches:
                yield fn(b, ctx)
        finally:
            if close_fn:
                close_fn(ctx)
    return df.mapInPandas(run, schema)


def parity_split(df: DataFrame, col: str) -> DataFrame:
    """One pass; each row tagged ``even``/``odd`` (``pmod``, so negative
    odd numbers are odd too)."""
    return df.withColumn("parity", F.when(F.pmod(F.col(col), F.lit(2)) == 0, "even")
                         .otherwise("odd"))


def route(df: DataFrame, routes: Mapping[str, Column], default: str = "main",
          name: str = "route") -> DataFrame:
    """Side outputs as one route column; first matching predicate wins.
    Consumers filter on the route, or write with ``partitionBy(name)``."""
    expr = None
    for tag, pred in routes.items():
        expr = F.when(pred, F.lit(tag)) if expr is None else expr.when(pred, F.lit(tag))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(name, expr)


def tee(df: DataFrame, side: Mapping[str, Column], main: str = "main",
        name: str = "output") -> DataFrame:
    """D3: every row goes to ``main``; rows matching a side predicate are also
    copied to that side output.  One pass: an array of tags, exploded."""
    tags = [F.lit(main)] + [F.when(p, F.lit(t)) for t, p in side.items()]
    return df.withColumn(name, F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())))


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union of 2..n inputs of one schema (by name); duplicates kept."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def connect(left: DataFrame, right: DataFrame, left_fn: Callable[[DataFrame], DataFrame],
            right_fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Two inputs of different types, one function each, one output type."""
    return left.transform(left_fn).unionByName(right.transform(right_fn))
