"""The running count of every word, in text order (G3), without shuffling a word.

``scan.running`` would send each word as a row to the task of its word and back to
nothing smaller: many times the texts.  Here the lines stay together:

1. lines are dealt by ranges of documents (chunks), and each chunk counts its
   different words;
2. a prefix over the chunks of a word gives its count in front of a chunk (one
   row per word and chunk; words seen for the first time have none);
3. each chunk's lines, in order, are counted on from there, a batch of words at a
   time.  A task holds the different words of one chunk and one batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventide.operators import scan
from eventide.operators.map_scan import _segments

#: Rows of a batch handed on.
_OUT = 100_000


class _Words:
    """Words of a chunk as numbers, and their counts so far."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.n = np.zeros(0, dtype=np.int64)

    def places(self, words: pa.Array) -> np.ndarray:
        """Numbers of the words, new ones behind the others."""
        encoded = words.dictionary_encode()
        place = self.place
        known = np.array([place.setdefault(w, len(place)) for w in encoded.dictionary.cast(pa.binary()).to_pylist()], dtype=np.int64)
        if len(place) > len(self.n):
            self.n = np.concatenate([self.n, np.zeros(max(len(place) - len(self.n), len(self.n)), np.int64)])
        return known[encoded.indices.to_numpy(zero_copy_only=False)]

    def run(self, code: np.ndarray) -> np.ndarray:
        """The count of each word after itself."""
        by = np.argsort(code, kind="stable")
        of = code[by]
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(of)))
        out = np.empty(len(of), dtype=np.int64)
        out[by] = np.arange(1, len(of) + 1) - np.repeat(first, size) + self.n[of]
        self.n[of[first]] += size
        return out

    def totals(self, chunk, schema: pa.Schema):
        """Batches of ``(chunk, word, count)``."""
        words = list(self.place)
        for at in range(0, len(words), _OUT):
            of = schema.field(1).type
            some = pa.array(words[at:at + _OUT], pa.large_binary() if pa.types.is_large_string(of) else pa.binary()).view(of)
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(some), schema.field(0).type), some, pa.array(self.n[at:at + len(some)])], schema=schema)


def running_word_count(lines: DataFrame, line: str, order: Sequence[str], chunk: Column,
                       split: Callable[[Column], Column], name: str = "cnt") -> DataFrame:
    """``(order, word_no, word, name)``: one row per word of a line, with the number of
    times that the word came so far, itself included, in the order of ``order`` and
    ``word_no``.  ``split`` gives the words of a line; ``chunk`` maps lines to chunks
    that are contiguous in ``order``.  Lines that agree in ``order`` are counted word
    number by word number."""
    order = list(order)
    rows = lines.select(*order, F.col(line).alias("__ev_line"), chunk.alias("__ev_chunk"))
    text = F.col("__ev_line")
    alone = scan.dealt(rows.select("__ev_chunk", "__ev_line"), ["__ev_chunk"]).sortWithinPartitions("__ev_chunk")
    kind = T.StructType([rows.schema["__ev_chunk"], rows.schema["__ev_line"], T.StructField("n", T.LongType())])
    held_out = to_arrow_schema(kind)

    def totals(batches):
        held, at = _Words(), None
        for batch in batches:
            edges = _segments(batch, [0]) if batch.num_rows else []
            for a, b in zip(edges, edges[1:]):
                here = batch.column(0)[a].as_py()
                if at is not None and here != at[0]:
                    yield from held.totals(at[0], held_out)
                    held = _Words()
                at = (here,)
                code = held.places(batch.column(1).slice(a, b - a).flatten())
                held.n += np.bincount(code, minlength=len(held.n))
        if at is not None:
            yield from held.totals(at[0], held_out)

    counts = alone.select("__ev_chunk", split(text).alias("__ev_words")).mapInArrow(totals, kind)
    earlier = Window.partitionBy("__ev_line").orderBy("__ev_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("__ev_n", F.sum("n").over(earlier)).where("__ev_n IS NOT NULL").drop("n")
    both = before.withColumn("__ev_kind", F.lit(0)).unionByName(rows.withColumn("__ev_kind", F.lit(1)), allowMissingColumns=True)
    dealt = scan.dealt(both, ["__ev_chunk"]).sortWithinPartitions("__ev_chunk", "__ev_kind", *order)
    dealt = dealt.select(*order, "__ev_chunk", "__ev_kind", "__ev_n",
                         F.when(F.col("__ev_kind") == 0, F.array(text)).otherwise(split(text)).alias("__ev_words"))
    schema = T.StructType([*[lines.schema[c] for c in order], T.StructField("word_no", T.IntegerType()),
                           T.StructField("word", T.StringType()), T.StructField(name, T.LongType())])
    out, k = to_arrow_schema(schema), len(order)

    def counted(held: _Words, part: pa.RecordBatch):
        """The rows of whole lines of one chunk."""
        lists = part.column(k + 3)
        sizes = np.diff(lists.offsets.to_numpy()) if lists.null_count == 0 else np.array([len(x or ()) for x in lists.to_pylist()])
        found = lists.flatten()
        if not len(found):
            return
        at = np.repeat(np.arange(part.num_rows), sizes)
        number = np.arange(len(found)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        code = held.places(found)
        edges = _segments(part, range(k))
        if len(edges) <= part.num_rows:                     # lines that agree in the order
            group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            by = np.lexsort((number, group[at]))
            n = np.empty(len(code), dtype=np.int64)
            n[by] = held.run(code[by])
        else:
            n = held.run(code)
        keys = part.select(range(k)).take(pa.array(at))
        made = [*keys.columns, pa.array(number.astype(np.int32)), found, pa.array(n)]
        whole = pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(made, out)], schema=out)
        for begin in range(0, len(found), _OUT):
            yield whole.slice(begin, _OUT)

    def place(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(c)[row].as_py() for c in range(k + 2))

    def fold(batches):
        held, at, kept = _Words(), None, None

        def run(batch):
            nonlocal held, at
            edges = _segments(batch, [k, k + 1]) if batch.num_rows else []
            for a, b in zip(edges, edges[1:]):
                part = batch.slice(a, b - a)
                here = part.column(k)[0].as_py()
                if at is None or here != at[0]:
                    held, at = _Words(), (here,)
                if part.column(k + 1)[0].as_py() == 0:
                    code = held.places(part.column(k + 3).flatten())
                    held.n[code] += part.column(k + 2).to_numpy()
                else:
                    yield from counted(held, part)

        for batch in batches:
            if not batch.num_rows:
                continue
            if kept is not None:
                if place(kept, 0) == place(batch, 0):
                    batch = pa.concat_batches([kept, batch])
                else:
                    yield from run(kept)
                kept = None
            if batch.column(k + 1)[batch.num_rows - 1].as_py() == 0:
                yield from run(batch)
                continue
            # The last line waits: the next batch may begin with one that agrees with it.
            last = _segments(batch, range(k + 2))[-2]
            yield from run(batch.slice(0, last))
            kept = batch.slice(last)
        if kept is not None:
            yield from run(kept)

    return dealt.mapInArrow(fold, schema)
