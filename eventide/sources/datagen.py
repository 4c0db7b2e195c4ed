"""The generator as a data source (A4-A6): tables declared in SQL or by a reader.

    CREATE TEMPORARY VIEW source (id INT, ts BIGINT, vc INT) USING eventide_datagen
    OPTIONS ('fields.id.kind' = 'random', 'fields.id.min' = '1', 'fields.id.max' = '10',
             'fields.ts.kind' = 'sequence', 'fields.ts.start' = '1', 'fields.ts.end' = '1000000')

(The catalog passes no options to sources in Python: a ``CREATE TABLE`` needs them
where it is read, ``FROM source WITH ('fields.id.kind' = ...)``.)

Row ``i`` (from 0) is a function of ``i`` alone: a sequence column is
``start + i``, a random one the hash of ``generators.mix``.  So tasks make disjoint
ranges of ``i``, a lost task makes its range again, and a stream's offset is the
next ``i``: after a restart no row is lost or repeated.

Options: ``number-of-rows`` (batch: needed unless a sequence ends), ``partitions``
(tasks, 8 by default), ``fields.<column>.kind`` ``random`` (``min``, ``max``) or
``sequence`` (``start``, ``end``).  A column without a kind is random over all numbers
of the hash.  Columns may be int, bigint, double or string.  The rows end with the
shortest sequence.

A stream has rows up to ``rows-per-second`` times the seconds since ``start-time``
(seconds since the epoch), which it needs: its rate limit is a clock, so it does not
depend on when a query was started or stopped.
"""

from __future__ import annotations

import math
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType

from eventide.sources.generators import MODULUS, MULT2

NAME = "eventide_datagen"
#: Rows made at once.
_BATCH = 65_536


def hashed(i: np.ndarray, salt: int) -> np.ndarray:
    """``generators.mix`` of numbers."""
    h = ((i + salt * 1_000_003) % MODULUS + 1) * MULT2 % MODULUS
    return h * MULT2 % MODULUS


class Rows:
    """The rows of a declared table."""

    def __init__(self, schema: StructType, options: dict):
        self.columns = []
        options = {k.lower(): v for k, v in options.items()}
        end = int(options["number-of-rows"]) if "number-of-rows" in options else None
        for salt, field in enumerate(schema.fields, start=1):
            of = {k: options.get(f"fields.{field.name}.{k}".lower()) for k in ("kind", "min", "max", "start", "end")}
            if of["kind"] not in (None, "random", "sequence"):
                raise ValueError(f"unknown generator {of['kind']!r} of column {field.name}")
            kinds = {IntegerType: pa.int32(), LongType: pa.int64(), DoubleType: pa.float64(), StringType: pa.string()}
            if type(field.dataType) not in kinds:
                raise ValueError(f"column {field.name}: no generator for {field.dataType.simpleString()}")
            low = int((of["start"] if of["kind"] == "sequence" else of["min"]) or 0)
            high = of["end"] if of["kind"] == "sequence" else of["max"]
            if of["kind"] == "sequence" and high is not None:
                end = min(int(high) - low + 1, end) if end is not None else int(high) - low + 1
            self.columns.append((salt if of["kind"] != "sequence" else 0, low, int(high) if high is not None else None, kinds[type(field.dataType)]))
        self.end = max(end, 0) if end is not None else None
        self.schema = pa.schema([(f.name, c[3]) for f, c in zip(schema.fields, self.columns)])

    def batches(self, start: int, end: int):
        for at in range(start, end, _BATCH):
            i = np.arange(at, min(at + _BATCH, end), dtype=np.int64)
            made = []
            for salt, low, high, kind in self.columns:
                v = low + i if not salt else low + (hashed(i, salt) % (high - low + 1) if high is not None else hashed(i, salt))
                made.append(pa.array(v).cast(kind))
            yield pa.RecordBatch.from_arrays(made, schema=self.schema)


class Range(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def _ranges(start: int, end: int, tasks: int) -> list[Range]:
    size = max(1, math.ceil((end - start) / max(tasks, 1)))
    return [Range(a, min(a + size, end)) for a in range(start, end, size)]


class GeneratorReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.rows, self.tasks = Rows(schema, options), int(options.get("partitions", 8))
        if self.rows.end is None:
            raise ValueError("a batch needs 'number-of-rows' or a sequence with an end")

    def partitions(self):
        return _ranges(0, self.rows.end, self.tasks) or [Range(0, 0)]

    def read(self, partition: Range):
        yield from self.rows.batches(partition.start, partition.end)


class GeneratorStreamReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.rows, self.tasks = Rows(schema, options), int(options.get("partitions", 8))
        if "start-time" not in options:
            raise ValueError("a stream needs 'start-time': seconds since the epoch of its first row")
        self.begin, self.rate = float(options["start-time"]), float(options.get("rows-per-second", 1))

    def initialOffset(self) -> dict:
        return {"next": 0}

    def latestOffset(self) -> dict:
        due = max(0, int((time.time() - self.begin) * self.rate))
        return {"next": due if self.rows.end is None else min(due, self.rows.end)}

    def partitions(self, start: dict, end: dict):
        return _ranges(start["next"], max(start["next"], end["next"]), self.tasks)

    def read(self, partition: Range):
        yield from self.rows.batches(partition.start, partition.end)


class GeneratorSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return "value bigint"

    def reader(self, schema: StructType) -> DataSourceReader:
        return GeneratorReader(schema, dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return GeneratorStreamReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeneratorSource)
