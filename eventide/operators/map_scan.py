"""A running map per key: the scan whose state is a map (K3).

``scan.running`` carries one value per column and chunk; here the state of a key
is a map from a value to its count, over any domain.  It is kept as differences:

1. the counts of every chunk of a key, partly aggregated on every task;
2. their prefix over the chunks of a key, a table ``chunk`` times smaller than
   the input: the map in front of each chunk;
3. each chunk's rows, in order, go on from the map in front of it.  A chunk is
   a group of its own, so a hot key is as many groups as it has chunks.

Step 3 counts in blocks of rows and values, the rows of many small chunks together,
so a task holds the maps of one batch and one block.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventide.operators import scan

#: Counts that a task holds at once.
_BLOCK = 500_000
_NAN = float("nan")


def _plain(values: pa.Array) -> pa.Array:
    """Doubles with one NaN and no negative zero."""
    if not pa.types.is_floating(values.type):
        return values
    return pc.if_else(pc.is_nan(values), pa.scalar(_NAN, values.type), pc.add(values, pa.scalar(0.0, values.type)))


class _Counts:
    """Values of one group and their counts."""

    def __init__(self, values: pa.Array, n: np.ndarray):
        self.values, self.n = values, n

    def run(self, values: pa.Array, group: np.ndarray, entries: pa.Array, of: np.ndarray, n: np.ndarray, last: int):
        """Per block of rows the length, the map after every row and the count of its
        own value.  Group 0 goes on from here, others begin with their ``entries``
        (of group ``of``, counted ``n`` times); the ``last`` is held afterwards.
        Rows of many groups share a block, so that small groups cost no more."""
        encoded = pa.concat_arrays([self.values, _plain(entries), _plain(values)]).dictionary_encode(null_encoding="encode")
        order = pc.sort_indices(encoded.dictionary).to_numpy()
        domain = encoded.dictionary.take(pa.array(order))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        code = rank[encoded.indices.to_numpy(zero_copy_only=False)]
        wide = max(len(domain), 1)
        begun = len(code) - len(values)
        pair = code + wide * np.concatenate([np.zeros(len(self.values), np.int64), of, group])
        pairs, at = np.unique(pair, return_inverse=True)
        held = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(held, at[:begun], np.concatenate([self.n, n]))
        at = at[begun:]
        first = np.searchsorted(pairs, wide * np.arange(last + 2))       # pairs of a group: first[g] to first[g + 1]
        name = pairs % wide
        hidden = domain.is_null().to_numpy(zero_copy_only=False)          # null is no key of a map
        rows = np.searchsorted(group, np.arange(last + 2))
        for g, h, a, b in _blocks(rows, np.diff(first)):
            here, width = np.arange(b - a), int(np.diff(first[g:h + 1]).max())
            column = at[a:b] - first[group[a:b]]
            seen = np.zeros((b - a, width), dtype=np.int64)
            seen[here, column] = 1
            seen = seen.cumsum(axis=0)
            places = first[g:h, None] + np.arange(width)
            inside = places < first[g + 1:h + 1, None]
            places = np.where(inside, places, 0)
            start = np.maximum(rows[g:h], a) - a
            before = np.where((start > 0)[:, None], seen[np.maximum(start - 1, 0)], 0)
            mine = group[a:b] - g
            seen += (np.where(inside, held[places], 0) - before)[mine]
            shown = seen > 0
            if hidden.any():
                shown &= ~hidden[name[places]][mine]
            offsets = np.concatenate([[0], shown.sum(axis=1).cumsum()]).astype(np.int32)
            keys = domain.take(pa.array(name[places][mine][shown]))
            yield b - a, pa.MapArray.from_arrays(offsets, keys, pa.array(seen[shown])), pa.array(seen[here, column])
            size = first[h] - first[h - 1]
            held[first[h - 1]:first[h]] = seen[-1, :size]
        self.values, self.n = domain.take(pa.array(name[first[last]:])), held[first[last]:].copy()


def _blocks(rows: np.ndarray, widths: np.ndarray):
    """``(group, end group, row, end row)`` of blocks with rows: whole groups, or rows
    of one large group, of at most ``_BLOCK`` counts (one row at least)."""
    g, last = 0, len(widths)
    while g < last:
        h, most = g, 0
        while h < last and (rows[h + 1] - rows[g]) * max(most, widths[h]) <= _BLOCK:
            most = max(most, widths[h])
            h += 1
        if h > g:
            if rows[h] > rows[g]:
                end = h
                while rows[end] == rows[end - 1]:            # groups without rows behind keep their counts
                    end -= 1
                yield g, end, rows[g], rows[h]
        else:
            h, step = g + 1, max(1, _BLOCK // int(widths[g]))
            for a in range(rows[g], rows[h], step):
                yield g, h, a, min(a + step, rows[h])
        g = h


def _segments(batch: pa.RecordBatch, columns: Sequence[int]) -> list[int]:
    """Edges of the runs of rows that agree in the columns."""
    change = np.zeros(batch.num_rows, dtype=bool)
    for c in columns:
        code = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= code[1:] != code[:-1]
    return [0, *np.flatnonzero(change).tolist(), batch.num_rows]


def value_map(df: DataFrame, keys: Sequence[str], value: str, name: str = "counts", own: str | None = None,
              order: str = "seq") -> DataFrame:
    """Adds ``name``, the map value -> count of the row's key after the row, and with
    ``own`` the count of the row's own value.  Null values have no entry in the map,
    but an own count.  The values may be of any atomic type; a map's entries come in
    the order of its values."""
    keys, columns = list(keys), df.columns
    rows = df.withColumn("__ev_chunk", scan.seq_chunk(df, order))
    by = [*keys, "__ev_chunk"]
    counts = rows.groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    counts = counts.groupBy(*by).agg(F.collect_list(F.struct("v", "n")).alias("__ev_map"))
    n = len(keys)

    def prefix(batches):
        at, held = None, None
        for batch in batches:
            before = []
            for key, entries in zip(zip(*[c.to_pylist() for c in batch.columns[:n]]) if n else [()] * batch.num_rows, batch.column(n + 1).to_pylist()):
                if held is None or key != at:
                    at, held = key, {}
                before.append([{"v": v, "n": k} for v, k in held.items()])
                for e in entries:
                    v = _NAN if e["v"] != e["v"] else e["v"]
                    held[v] = held.get(v, 0) + e["n"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n + 1], pa.array(before, batch.column(n + 1).type)], schema=batch.schema)

    before = (counts.repartition(*keys) if keys else counts.repartition(1)).sortWithinPartitions(*by).mapInArrow(prefix, counts.schema)
    both = before.withColumn("__ev_kind", F.lit(0)).unionByName(rows.withColumn("__ev_kind", F.lit(1)), allowMissingColumns=True)
    both = both.select(*columns, "__ev_chunk", "__ev_kind", "__ev_map")
    dealt = scan.dealt(both, by).sortWithinPartitions(*by, "__ev_kind", order)
    kind = df.schema[value].dataType
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.MapType(kind, T.LongType())), *([T.StructField(own, T.LongType())] if own else [])])
    out, at = to_arrow_schema(schema), columns.index(value)

    def fold(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            # A group begins with its map; rows in front of the first go on with the last.
            begins = batch.column(len(columns) + 1).to_numpy(zero_copy_only=False) == 0
            group = begins.cumsum()
            maps = batch.column(len(columns) + 2).filter(pa.array(begins))
            entries = maps.flatten()
            of = np.repeat(np.arange(1, len(maps) + 1), pc.list_value_length(maps).to_numpy(zero_copy_only=False))
            some = batch.filter(pa.array(~begins))
            if held is None or begins[0]:
                held = _Counts(batch.column(at).slice(0, 0), np.zeros(0, np.int64))
            begin = 0
            for size, counted, mine in held.run(some.column(at), group[~begins], entries.field("v"), of, entries.field("n").to_numpy(zero_copy_only=False), int(group[-1])):
                part = some.slice(begin, size)
                begin += size
                made = [*part.columns[:len(columns)], counted, *([mine] if own else [])]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(made, out)], schema=out)

    return dealt.mapInArrow(fold, schema)
