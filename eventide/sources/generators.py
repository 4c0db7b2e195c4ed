"""Generated sources (A4-A6): a sequence ``0..n-1`` mapped by a function.

Batch: ``spark.range`` split over partitions (each task generates its own
slice, nothing passes through the driver).  Stream: the ``rate`` source,
whose ``value`` column is the same sequence, at ``rows_per_second``.
"Random" columns are a seeded integer hash of the index, so every run and
every engine gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The Lehmer generator modulus 2^31-1 and multiplier 48271,
# applied twice per step (48271^2 mod (2^31-1) = 182605794).
MODULUS = 2147483647
MULT2 = 182605794


def mix(i: Column, salt: int = 0) -> Column:
    """Deterministic pseudo-random integer in [0, 2^31-1) from an index."""
    x = F.pmod(i + F.lit(salt * 1_000_003), F.lit(MODULUS)) + 1
    h = F.pmod(x * F.lit(MULT2), F.lit(MODULUS))
    return F.pmod(h * F.lit(MULT2), F.lit(MODULUS))


def random_int(i: Column, lo: int, hi: int, salt: int) -> Column:
    return (F.lit(lo) + F.pmod(mix(i, salt), F.lit(hi - lo + 1))).cast("int")


def sequence_source(spark: SparkSession, n: int, fn: Callable[[Column], Column | list[Column]],
                    partitions: int | None = None) -> DataFrame:
    """A4: ``fn(i)`` for ``i`` in ``0..n-1``."""
    return generate(spark.range(0, n, 1, partitions), "id", fn)


def generate(df: DataFrame, index: str, fn: Callable[[Column], Column | list[Column]]) -> DataFrame:
    """A4 over the numbers of a column: ``fn(i)`` per row, up to the end of the
    shortest bounded sequence of ``fn``."""
    out = fn(F.col(index))
    end = getattr(fn, "rows", None)
    df = df if end is None else df.where(F.col(index) < end)
    return df.select(*out if isinstance(out, list) else [out])


def sequence_stream(spark: SparkSession, rows_per_second: int,
                    fn: Callable[[Column], Column | list[Column]], partitions: int = 1) -> DataFrame:
    """A4 streaming: the rate source, rows numbered from 0."""
    rate = (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
            .option("numPartitions", partitions).load())
    return generate(rate, "value", fn)


def number_string(i: Column) -> Column:
    """The reference demo's mapping: ``"Number:" + i``."""
    return F.concat(F.lit("Number:"), i.cast("string")).alias("value")


def sensor_row(i: Column, ids: int = 3, levels: int = 15, per_second: int = 3) -> list[Column]:
    """A5: ids s1..s<ids>, level 0..levels-1, ``per_second`` rows per second."""
    return [
        F.concat(F.lit("s"), (F.lit(1) + F.pmod(mix(i, 1), F.lit(ids))).cast("string")).alias("id"),
        F.floor(i / per_second).cast("bigint").alias("ts"),
        F.pmod(mix(i, 2), F.lit(levels)).cast("int").alias("vc"),
        i.alias("seq"),
    ]


def table_spec(spec: Mapping[str, tuple]) -> Callable[[Column], list[Column]]:
    """A per-column generator spec: ``("random", lo, hi)`` or
    ``("sequence", start, end)``; the source ends with the last value of its
    shortest sequence."""
    def fn(i: Column) -> list[Column]:
        cols = []
        for salt, (name, g) in enumerate(spec.items(), start=1):
            if g[0] == "random":
                cols.append(random_int(i, g[1], g[2], salt).alias(name))
            elif g[0] == "sequence":
                cols.append((F.lit(g[1]) + i).cast("bigint").alias(name))
            else:
                raise ValueError(f"unknown generator {g[0]!r}")
        return cols
    fn.rows = min((g[2] - g[1] + 1 for g in spec.values() if g[0] == "sequence"), default=None)
    return fn
