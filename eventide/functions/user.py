"""User functions written in Python: aggregates (U2, I3), table functions (U3) and
table aggregates (U4).

An aggregate is a class with an accumulator of any Spark type: ``create`` an
empty one, ``add`` a row to it, ``merge`` two, and ``finish`` it to a result.
Each task folds its rows into one accumulator per key, so only accumulators
are shuffled, and these meet in a tree of two levels: first in slots of ``FAN``
neighbouring tasks (``FAN`` slots per key at most), then the slots of a key.  A key
that holds all rows of ``T`` tasks so is ``FAN`` accumulators in each of ``T / FAN``
groups (``T / FAN`` in each of ``FAN``, if that is more) and one a group in the last;
its rows never meet, and up to ``FAN`` tasks leave one accumulator per key.
``merge`` must give the same result in any order and grouping.

A table aggregate gives rows instead of a result (``emit``).  It is called by name
in SQL as a table function with a partitioned table argument, over the table of
accumulators, whose groups are bounded by ``FAN``:

    SELECT * FROM top2(TABLE({accumulators}) PARTITION BY customer)

``running`` gives the result after every row, in arrival order: chunks of a key are
folded by themselves, their accumulators carried over the chunks in order, and the
rows of a chunk go on from there.  There ``merge`` only has to be associative.

Keys may be null (one group) and of any atomic type; rows of an empty table give
no group, with no keys included.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from eventide.operators import scan

#: Slots of a key on the first level of the tree: the most accumulators that a key
#: has on the second.
FAN = 1024
#: Accumulators that a task holds before it hands them on.
HELD = 50_000
_OUT = 10_000
_SLOT = "__ev_slot"


class UserAggregate:
    """An aggregate function.  A struct accumulator is a tuple in Python, a map a
    dict, any other type its usual Python value."""

    #: Spark types of the accumulator and the result.
    accumulator: str
    result: str

    def create(self):
        raise NotImplementedError

    def add(self, acc, *args):
        """The accumulator with one more row; nulls come as None."""
        raise NotImplementedError

    def merge(self, a, b):
        raise NotImplementedError

    def finish(self, acc):
        raise NotImplementedError


class UserTableAggregate(UserAggregate):
    """A table aggregate: ``emit`` gives the rows of an accumulator, ``fields`` their
    columns."""

    fields: str
    result = "boolean"

    def emit(self, acc) -> Iterator[tuple]:
        raise NotImplementedError

    def finish(self, acc):
        raise TypeError("a table aggregate gives rows, not one result")


class Reduce(UserAggregate):
    """A fold of two values of one type into one, the first row as it is.  A
    struct value comes as a tuple; rows without a value are passed over."""

    def __init__(self, fn: Callable, kind: str):
        self.fn, self.accumulator, self.result = fn, kind, kind
        self.codec = _Codec(kind)

    def create(self):
        return None

    def add(self, acc, value):
        return self.merge(acc, self.codec.load(value))

    def merge(self, a, b):
        return b if a is None else a if b is None else self.fn(a, b)

    def finish(self, acc):
        return self.codec.dump(acc)


Aggregates = Mapping[str, tuple[UserAggregate, Sequence[str | Column]]]


def _type(ddl: str) -> T.DataType:
    return T.DataType.fromDDL(ddl)


class _Codec:
    """An accumulator type between Arrow's Python values and the user's."""

    def __init__(self, ddl: str):
        spark_type = _type(ddl)
        self.arrow = to_arrow_type(spark_type)
        self.kind = "struct" if isinstance(spark_type, T.StructType) else "map" if isinstance(spark_type, T.MapType) else ""
        self.names = spark_type.names if self.kind == "struct" else []

    def load(self, value):
        if value is None or not self.kind:
            return value
        return tuple(value.values()) if self.kind == "struct" else dict(value)

    def dump(self, acc):
        if acc is None or not self.kind:
            return acc
        return dict(zip(self.names, acc)) if self.kind == "struct" else list(acc.items())


_NAN = float("nan")


def _key(value):
    """A key value that equals itself: one NaN, no negative zero."""
    if isinstance(value, float):
        return value + 0.0 if value == value else _NAN
    return value


def _keys(batch: pa.RecordBatch, n: int) -> list[tuple]:
    if not n:
        return [()] * batch.num_rows
    columns = [c.to_pylist() for c in batch.columns[:n]]
    columns = [[_key(v) for v in c] if pa.types.is_floating(t.type) else c for c, t in zip(columns, batch.schema)]
    return list(zip(*columns))


def accumulators(df: DataFrame, keys: Sequence[str], aggs: Aggregates) -> DataFrame:
    """``(keys, one column per aggregate)``: accumulators of all rows, at most
    ``FAN`` rows per key."""
    keys, names = list(keys), list(aggs)
    fns = [aggs[n][0] for n in names]
    codecs = [_Codec(f.accumulator) for f in fns]
    args, spans = [], []
    for n in names:
        columns = [F.col(c) if isinstance(c, str) else c for c in aggs[n][1]]
        spans.append(range(len(keys) + len(args), len(keys) + len(args) + len(columns)))
        args += [c.alias(f"__ev_a{len(args) + i}") for i, c in enumerate(columns)]
    rows = df.select(*keys, *args)
    schema = T.StructType(rows.schema.fields[:len(keys)] + [T.StructField(n, _type(f.accumulator)) for n, f in zip(names, fns)])
    out = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def fold(batches):
        held: dict[tuple, list] = {}
        for batch in batches:
            values = [None] * len(keys) + [c.to_pylist() for c in batch.columns[len(keys):]]
            found = _keys(batch, len(keys))
            for key in set(found).difference(held):
                held[key] = [f.create() for f in fns]
            for i, (f, span) in enumerate(zip(fns, spans)):
                add = f.add
                for key, *row in zip(found, *[values[j] for j in span]):
                    accs = held[key]
                    accs[i] = add(accs[i], *row)
            if len(held) > HELD:
                yield from _batches(held.items(), codecs, out)
                held = {}
        yield from _batches(held.items(), codecs, out)

    slot = F.pmod(F.floor(F.spark_partition_id() / FAN), F.lit(FAN))
    return _merged(rows.mapInArrow(fold, schema).withColumn(_SLOT, slot), [*keys, _SLOT], names, fns).drop(_SLOT)


def _batches(items, codecs: list[_Codec], schema: pa.Schema):
    items = list(items)
    n = len(schema) - len(codecs)
    for at in range(0, len(items), _OUT):
        some = items[at:at + _OUT]
        columns = [pa.array([key[i] for key, _ in some], schema.field(i).type) for i in range(n)]
        columns += [pa.array([c.dump(accs[i]) for _, accs in some], schema.field(n + i).type) for i, c in enumerate(codecs)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _merged(partial: DataFrame, by: list[str], names: list[str], fns: list[UserAggregate], finish: bool = False) -> DataFrame:
    """Accumulators of equal ``by`` merged; with ``finish`` to their results."""
    codecs = [_Codec(f.accumulator) for f in fns]
    dealt = (scan.dealt(partial, by) if by else partial.repartition(1)).select(*by, *names)
    fields = [f for f in dealt.schema.fields if f.name in by]
    schema = T.StructType(fields + [T.StructField(n, _type(f.result if finish else f.accumulator)) for n, f in zip(names, fns)])
    out = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    class Result:
        def __init__(self, f):
            self.dump = f.finish

    writers = [Result(f) for f in fns] if finish else codecs

    def run(batches):
        at, accs, done = None, None, []
        for batch in batches:
            columns = [[c.load(v) for v in column.to_pylist()] for c, column in zip(codecs, batch.columns[len(by):])]
            for key, *row in zip(_keys(batch, len(by)), *columns):
                if accs is not None and key == at:
                    accs = [f.merge(a, b) for f, a, b in zip(fns, accs, row)]
                    continue
                if accs is not None:
                    done.append((at, accs))
                at, accs = key, row
                if len(done) >= _OUT:
                    yield from _batches(done, writers, out)
                    done = []
        if accs is not None:
            done.append((at, accs))
        yield from _batches(done, writers, out)

    return (dealt.sortWithinPartitions(*by) if by else dealt).mapInArrow(run, schema)


def aggregate(df: DataFrame, keys: Sequence[str], aggs: Aggregates) -> DataFrame:
    """One row per key with the results of ``aggs``, a mapping from a column
    name to ``(aggregate, its arguments)``."""
    names = list(aggs)
    return _merged(accumulators(df, keys, aggs), list(keys), names, [aggs[n][0] for n in names], finish=True)


def running(df: DataFrame, keys: Sequence[str], aggs: Aggregates, order: str = "seq") -> DataFrame:
    """Adds the results of ``aggs`` after every row of its key, in the order
    of ``order`` (an integer column)."""
    keys, names, columns = list(keys), list(aggs), df.columns
    fns = [aggs[n][0] for n in names]
    codecs = [_Codec(f.accumulator) for f in fns]
    args, spans = [], []
    for n in names:
        of = [F.col(c) if isinstance(c, str) else c for c in aggs[n][1]]
        spans.append(range(len(args), len(args) + len(of)))
        args += [c.alias(f"__ev_a{len(args) + i}") for i, c in enumerate(of)]
    by = [*keys, "__ev_chunk"]
    rows = df.select("*", *args, scan.seq_chunk(df, order).alias("__ev_chunk"))
    k, accs = len(by), [f"__ev_acc{i}" for i in range(len(fns))]
    state = T.StructType([rows.schema[c] for c in by] + [T.StructField(a, _type(f.accumulator)) for a, f in zip(accs, fns)])
    held = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in state.fields])
    count = len(args)

    def added(now, row):
        return [f.add(a, *(row[j] for j in span)) for f, a, span in zip(fns, now, spans)]

    def totals(batches):
        at, now, done = None, None, []
        for batch in batches:
            for key, *row in zip(_keys(batch, k), *[c.to_pylist() for c in batch.columns[k:k + count]] or [[None] * batch.num_rows]):
                if now is None or key != at:
                    if now is not None:
                        done.append((at, now))
                    at, now = key, [f.create() for f in fns]
                now = added(now, row)
            yield from _batches(done, codecs, held)
            done = []
        yield from _batches([(at, now)] if now is not None else [], codecs, held)

    def prefix(batches):
        at, now = None, None
        for batch in batches:
            done = []
            for key, *row in zip(_keys(batch, k), *[[c.load(v) for v in x.to_pylist()] for c, x in zip(codecs, batch.columns[k:])]):
                if now is None or key[:-1] != at:
                    at, now = key[:-1], [f.create() for f in fns]
                # A copy: the next merge may change it.
                done.append((key, [c.load(c.dump(a)) if c.kind else copy.copy(a) for c, a in zip(codecs, now)]))
                now = [f.merge(a, b) for f, a, b in zip(fns, now, row)]
            yield from _batches(done, codecs, held)

    dealt = scan.dealt(rows, by).sortWithinPartitions(*by, order).select(*by, *[f"__ev_a{i}" for i in range(count)])
    before = dealt.mapInArrow(totals, state)
    before = (before.repartition(*keys) if keys else before.repartition(1)).sortWithinPartitions(*by).mapInArrow(prefix, state)
    both = before.withColumn("__ev_kind", F.lit(0)).unionByName(rows.withColumn("__ev_kind", F.lit(1)), allowMissingColumns=True)
    both = scan.dealt(both, by).sortWithinPartitions(*by, "__ev_kind", order)
    both = both.select("__ev_kind", *accs, *[f"__ev_a{i}" for i in range(count)], *columns)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, _type(f.result)) for n, f in zip(names, fns)]])
    out = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def fold(batches):
        now = None
        for batch in batches:
            made: list[list] = [[] for _ in fns]
            values = [c.to_pylist() for c in batch.columns[1 + len(fns):1 + len(fns) + count]]
            kinds = batch.column(0).to_pylist()
            for r, kind in enumerate(kinds):
                if kind == 0:
                    now = [c.load(batch.column(1 + i)[r].as_py()) for i, c in enumerate(codecs)]
                    continue
                now = added(now, [v[r] for v in values])
                for result, f, a in zip(made, fns, now):
                    result.append(f.finish(a))
            mine = batch.filter(pa.array([kind == 1 for kind in kinds], pa.bool_()))
            data = [c.cast(f.type) if c.type != f.type else c for c, f in zip(mine.columns[1 + len(fns) + count:], out)]
            yield pa.RecordBatch.from_arrays([*data, *[pa.array(x, out.field(len(columns) + i).type) for i, x in enumerate(made)]], schema=out)

    return both.mapInArrow(fold, schema)


def register_aggregate(spark: SparkSession, name: str, fn: UserAggregate) -> None:
    """The aggregate by name in SQL, over a column of ``accumulators``:
    ``SELECT k, name(acc) FROM {accumulators} GROUP BY k``."""
    codec = _Codec(fn.accumulator)

    def finish(accs: pa.Array) -> float:           # the hint says: an array to one value
        merged = None
        for k, value in enumerate(accs.to_pylist()):
            merged = codec.load(value) if not k else fn.merge(merged, codec.load(value))
        return fn.finish(merged)

    spark.udf.register(name, F.arrow_udf(finish, fn.result))


def register_table_function(spark: SparkSession, name: str, handler: type, fields: str, arguments: str | None = None) -> None:
    """A table function by name.  ``handler.eval(*args)`` yields the rows of
    one call, for use in ``LATERAL`` joins.

    With the ``arguments`` and their types (numbers, texts, booleans, bytes; fields,
    too) calls go to Python in batches and come back in batches of rows; without them
    each call is a table of its own, which takes several times as long."""
    if arguments is None:
        spark.udtf.register(name, F.udtf(handler, returnType=fields, useArrow=True))
        return
    given, made = _type(arguments), _type(fields)
    other = [f.name for f in [*given.fields, *made.fields] if not isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType, T.BinaryType))]
    if other or hasattr(handler, "terminate"):
        raise ValueError(f"{name}: no batches with {other or 'terminate'}; leave out arguments")
    kind = T.ArrayType(made)
    types = [to_arrow_type(f.dataType) for f in made.fields]

    def calls(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        called = handler()
        for batch in batches:
            rows, ends = [], [0]
            for args in zip(*[c.to_pylist() for c in batch.flatten()]):
                rows.extend(called.eval(*args) or ())
                ends.append(len(rows))
                if len(rows) >= _OUT:
                    yield _lists(rows, ends, types, made.names)
                    rows, ends = [], [0]
            if len(ends) > 1:
                yield _lists(rows, ends, types, made.names)

    spark.udf.register(f"__ev_{name}", F.arrow_udf(calls, kind))
    columns = ", ".join(f"`{n}`" for n in given.names)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({fields}) "
              f"RETURN SELECT inline(__ev_{name}(struct({columns})))")


def _lists(rows: list[tuple], ends: list[int], types: list[pa.DataType], names: list[str]) -> pa.Array:
    """A list of rows per call; ``ends`` are the edges of the calls."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    if len(columns) != len(types):
        raise ValueError(f"a row of {len(columns)} values for {len(types)} fields")
    values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _cast(field: T.StructField) -> Callable | None:
    """The Python value that a field of a pickled row needs (a plain one of its own
    type: others would come as null); a number beyond its type is an error."""
    kind = type(field.dataType)
    if kind in _BITS:
        most = 1 << (_BITS[kind] - 1)

        def whole(value):
            n = int(value)
            if n != value or not -most <= n < most:
                raise ValueError(f"{value!r} is no {field.dataType.simpleString()} ({field.name})")
            return n

        return whole
    return {T.FloatType: float, T.DoubleType: float, T.BooleanType: bool, T.StringType: str}.get(kind)


def register_table_aggregate(spark: SparkSession, name: str, fn: UserTableAggregate) -> None:
    """The table aggregate by name in SQL, over a table of keys and one
    column of ``accumulators`` (the last), partitioned by the keys.  Its rows are
    the keys and the aggregate's fields.  Groups are many and their rows few, so rows
    go in pickled batches: Arrow makes a table of its own for each call."""
    codec, fields = _Codec(fn.accumulator), T.StructType.fromDDL(fn.fields).fields
    casts = [_cast(f) for f in fields]

    class Handler:
        @staticmethod
        def analyze(table: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(T.StructType(table.dataType.fields[:-1] + fields))

        def __init__(self):
            self.keys, self.acc, self.any = (), None, False

        def eval(self, row: T.Row):
            value = row[-1].asDict() if isinstance(row[-1], T.Row) else row[-1]
            acc = codec.load(value)
            self.acc = fn.merge(self.acc, acc) if self.any else acc
            self.keys, self.any = tuple(row[:-1]), True

        def terminate(self):
            if self.any:
                for out in fn.emit(self.acc):
                    yield (*self.keys, *[v if v is None or cast is None else cast(v) for cast, v in zip(casts, out, strict=True)])

    spark.udtf.register(name, F.udtf(Handler, useArrow=False))
