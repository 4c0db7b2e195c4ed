"""Sum-of-squares packing of tokenized documents into fixed-length sequences.

Each document becomes its ids and an end id.  Only a document longer than a
sequence is cut, into full sequences and a first piece with the rest.  Pieces
are dealt by a hash into shards of about ``SHARD_DOCS`` documents, so no task
holds more than a shard.  In a shard the pieces go, longest first, to the open
bin (or a new one) that leaves the sum of the squared counts of open bins per
residual gap smallest; ties prefer the smaller gap.  The pieces of the bins
that are still open at the end are placed once more among themselves, each in
the fullest bin with room, where that needs fewer bins.

Null texts count as empty (their piece is the end id alone); repeated rows are
packed each on its own; an empty table gives an empty table; other columns are
not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm import byte_bpe
from eventide.llm.blocks import gather_runs, sorted_groups, text_blocks

#: Documents whose pieces share a shard, on average.
SHARD_DOCS = 16_384
#: Copies of a row that are written out at once.
COPY_RUN = 10_000


def cut(total: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents of ``total`` ids: ``(document, piece, start, length)``."""
    n = -(-total // capacity)
    doc = np.repeat(np.arange(len(total)), n)
    piece = gather_runs(np.zeros(len(n), np.int64), n)
    rest = total - (n - 1) * capacity                # length of the first piece
    start = np.where(piece == 0, 0, rest[doc] + (piece - 1) * capacity)
    length = np.where(piece == 0, rest[doc], capacity)
    return doc, piece, start, length


def pieces(df: DataFrame, vocab_path: str, capacity: int = 1024, end_id: int = 2,
           text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``(key, piece, start, length, ids_crc32[, ids])``."""
    build = byte_bpe.share(df.sparkSession, vocab_path)
    names = [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        vocab = build()
        for batch, texts in text_blocks(batches, "t"):
            at, ids = byte_bpe.encode_block(texts, vocab)
            total = np.diff(at) + 1
            ends = np.cumsum(total)
            full = np.full(int(ends[-1]), end_id, dtype="<u4")
            full[gather_runs(ends - total, total - 1)] = ids
            doc, piece, start, length = cut(total, capacity)
            begin = (ends - total)[doc] + start
            crc = [zlib.crc32(full[a:a + n]) for a, n in zip(begin.tolist(), length.tolist())]
            cols = [batch.column("k").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                off = np.concatenate([[0], np.cumsum(length)])
                cols.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(full.astype(np.int32), pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.selectExpr(f"`{key}` as k", f"cast(`{text}` as string) as t").mapInArrow(
        run, f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, in the given order.

    Placing an item of size ``s`` in a bin of gap ``g`` changes the sum of
    squares by ``2 * (N[g - s] - N[g]) + 2``, by ``1 - 2 * N[s]`` if the bin
    becomes full, and by ``2 * N[capacity - s] + 1`` for a new bin."""
    open_count = np.zeros(capacity + 1, dtype=np.int64)   # open bins per gap 1 .. capacity - 1
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    made = 0
    never = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        here, after = open_count[s:], open_count[:capacity + 1 - s]
        change = np.where(here > 0, 2 * (after - here) + 2, never)
        if here[0]:
            change[0] -= 1                           # the bin becomes full
        change[-1] = 2 * open_count[capacity - s] + 1 if s < capacity else 0     # a new bin
        g = s + int(change.argmin())
        if g == capacity:
            b, made = made, made + 1
        else:
            b = by_gap[g].pop()
            open_count[g] -= 1
        bins[i], offsets[i] = b, capacity - g
        if g > s:
            by_gap[g - s].append(b)
            open_count[g - s] += 1
    return bins, offsets


def pack_shard(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum-of-squares over a shard, longest pieces first; then once more over
    the pieces of the bins that stayed open, if that needs fewer bins."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    bins[order], offsets[order] = sum_of_squares(lengths[order], capacity)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    left = np.flatnonzero(fill < capacity)
    loose = np.flatnonzero(np.isin(bins, left))
    if len(left) > -(-int(fill[left].sum()) // capacity):
        best = _best_fit(lengths[loose], capacity)
        if best[0].max() + 1 < len(left):
            bins[loose], offsets[loose] = left[best[0]], best[1]
    return bins, offsets


def _best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest first into the fullest bin that has room."""
    gaps: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, dtype=np.int64)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        fit = np.flatnonzero(count[s:])
        if len(fit):
            g = s + int(fit[0])
            b = gaps[g].pop()
            count[g] -= 1
        else:
            g, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - g
        if g > s:
            gaps[g - s].append(b)
            count[g - s] += 1
    return bins, offsets


def pack(items: DataFrame, shards: int, capacity: int = 1024, key: str = "doc_id") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows of ``(key, piece, start,
    length, ids_crc32)``.  Every sequence lies in one shard.

    Equal rows are counted first and dealt as numbered copies, so that many
    repeats of one row fill all shards alike."""
    kind = items.select(key).schema[0].dataType.simpleString()
    names = [key, "piece", "start", "length", "ids_crc32"]
    counted = items.groupBy(*names).agg(F.count("*").alias("__n"))
    runs = counted.withColumn("__from", F.explode(F.sequence(F.lit(0), F.col("__n") - 1, F.lit(COPY_RUN))))
    copies = runs.select(*names, F.explode(F.sequence("__from", F.least("__n", F.col("__from") + COPY_RUN) - 1)).alias("__copy"))
    dealt = (copies.select(*names, F.pmod(F.xxhash64(key, "piece", "ids_crc32", "__copy"), F.lit(shards)).alias("shard"))
             .repartition(max(shards, 1), "shard").sortWithinPartitions("shard", key, "piece", "ids_crc32"))

    def run(frames):
        for pdf in sorted_groups(frames, ["shard"]):
            bins, offsets = pack_shard(pdf["length"].to_numpy(), capacity)
            pdf["sequence_id"] = (int(pdf["shard"].iat[0]) << 32) + bins
            pdf["offset"] = offsets
            yield pdf.drop(columns="shard")

    return dealt.mapInPandas(run, f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                  "sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, vocab_path: str, capacity: int = 1024, end_id: int = 2,
                   shard_docs: int = SHARD_DOCS, key: str = "doc_id") -> DataFrame:
    """Tokenize, cut and pack whole documents."""
    shards = max(1, -(-docs.count() // shard_docs))
    return pack(pieces(docs, vocab_path, capacity, end_id, key=key), shards, capacity, key)
