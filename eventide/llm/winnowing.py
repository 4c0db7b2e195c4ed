"""Winnowing fingerprints of documents.

Rolling hashes of all ``K``-grams of code points; of every window of ``W``
consecutive hashes the smallest is kept, of equals the rightmost, with its
position.  Any passage of ``K + W - 1`` code points that two texts share leaves
at least one common hash in both fingerprints, at matching positions.

A text shorter than ``K`` has one gram (the whole text), a text with fewer than
``W`` grams one window, an empty text an empty fingerprint.  Null texts count as
empty; two empty fingerprints are alike (1.0).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from eventide.llm.blocks import text_blocks
from eventide.session import cut_lineage

#: Code points of a gram and hashes of a window (powers of two, for doubling).
K = 16
W = 16
_BASE = 0x9E3779B97F4A7C15 | 1
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def winnow(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of a block of texts: ``(offsets per text, hashes,
    positions)``."""
    pad = "\0" * (K + W)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes + K + W)])[:-1]
    h = np.frombuffer(pad.join([*texts, ""]).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    n = len(h)
    if not n:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    width, factor = 1, _BASE
    while width < K:                                 # a gram of twice the width from two neighbours
        after = np.zeros(n, dtype=np.uint64)
        after[:n - width] = h[width:]
        h = h * np.uint64(factor) + after
        width, factor = 2 * width, factor * factor % (1 << 64)
    short = sizes < K
    h[begins[short & (sizes > 0)]] += sizes[short & (sizes > 0)].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    grams = np.where(sizes == 0, 0, np.maximum(sizes - K + 1, 1))
    change = np.zeros(n + 1, dtype=np.int8)
    np.add.at(change, begins, (grams > 0).astype(np.int8))
    np.add.at(change, begins + grams, -(grams > 0).astype(np.int8))
    valid = np.cumsum(change[:-1], dtype=np.int8) > 0
    h = np.minimum(h, _TOP - np.uint64(1))
    best = np.where(valid, h, _TOP)
    at = np.arange(n, dtype=np.int32 if n < 2**31 else np.int64)
    width = 1
    while width < W:                                 # rightmost minimum of a window of twice the width
        right = np.full(n, _TOP, dtype=np.uint64)
        right[:n - width] = best[width:]
        right_at = np.zeros_like(at)
        right_at[:n - width] = at[width:]
        take = (right <= best) & (right != _TOP)
        best, at = np.where(take, right, best), np.where(take, right_at, at)
        width *= 2
    windows = np.where(grams > 0, np.maximum(grams - W + 1, 1), 0)
    change = np.zeros(n + 1, dtype=np.int8)
    np.add.at(change, begins, (windows > 0).astype(np.int8))
    np.add.at(change, begins + windows, -(windows > 0).astype(np.int8))
    chosen = np.zeros(n, dtype=bool)
    chosen[at[np.cumsum(change[:-1], dtype=np.int8) > 0]] = True
    where = np.flatnonzero(chosen)
    offsets = np.searchsorted(where, np.append(begins, n))
    counts = np.diff(offsets)
    return offsets, h[where], where - np.repeat(begins, counts)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared part of two sorted sets of hashes (Jaccard)."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _digest(hashes: np.ndarray, positions: np.ndarray) -> bytes:
    return hashlib.sha256(hashes.astype("<u8").tobytes() + positions.astype("<i8").tobytes()).digest()


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, hashes array<bigint>, positions array<int>)``: the fingerprint."""
    def run(batches):
        for batch, texts in text_blocks(batches, "t"):
            at, h, pos = winnow(texts)
            off = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.ListArray.from_arrays(off, pa.array(h.view(np.int64))), pa.ListArray.from_arrays(off, pa.array(pos, pa.int32()))],
                names=[key, "hashes", "positions"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.selectExpr(f"`{key}` as k", f"cast(`{text}` as string) as t").mapInArrow(run, f"`{key}` {kind}, hashes array<bigint>, positions array<int>")


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by the beginning of the next one."""
    m = len(text) // 3
    return text[:len(text) - m] + following[:m]


def compare(texts: list[str], following: list[str], follows: list[int] | None = None):
    """Per text: fingerprint digests of it and of its edited form, and its
    likeness to the edited form and to the next text.  ``follows[i]`` is the
    place of the next text among ``texts``, -1: only in ``following``."""
    n = len(texts)
    follows = follows or [-1] * n
    extra = [i for i in range(n) if follows[i] < 0]
    forms = [edited(t, f) for t, f in zip(texts, following)]
    at, h, pos = winnow([*texts, *[following[i] for i in extra]])
    sets = [np.unique(h[a:b]) for a, b in zip(at.tolist(), at[1:].tolist())]
    place = dict(zip(extra, range(n, n + len(extra))))
    at2, h2, pos2 = winnow(forms)
    out = []
    for i in range(n):
        s, e = slice(at[i], at[i + 1]), slice(at2[i], at2[i + 1])
        out.append((hashlib.sha256(forms[i].encode()).digest(), _digest(h[s], pos[s]), _digest(h2[e], pos2[e]),
                    likeness(sets[i], np.unique(h2[e])), likeness(sets[i], sets[place.get(i, follows[i])])))
    return out


def _ordered(docs: DataFrame) -> DataFrame:
    """Rows ``(k, t)`` in ranges of their order."""
    order = [F.col("k").desc_nulls_last(), F.col("th"), F.col("z")]
    numbered = docs.withColumn("th", F.xxhash64("t")).withColumn("z", F.monotonically_increasing_id())
    return numbered.repartitionByRange(*order).sortWithinPartitions(*order).select("k", "t")


_RESULT = "n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def edit_report(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every document against its edited text and the next document, in
    descending key order (equal keys by their texts' hashes; after the last the
    first).

    Rows are range-partitioned once by key, text hash and a number, so equal keys,
    or equal rows (which may stand in for each other), share no one partition.  Each task handles the neighbours
    within its partition and hands on its first and last text; those ends, two
    per partition, are matched afterwards.  Rows without a key come last.
    An empty table gives an empty table; a single document is its own next."""
    kind = df.select(key).schema[0].dataType.simpleString()
    docs = df.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    ordered = _ordered(docs)
    names = ["pid", "part", "k", "t", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def rows(pid, part, keys, texts, results):
        n = len(keys)
        cols = list(zip(*results)) if results else [[None] * n] * 5
        kinds = [pa.binary()] * 3 + [pa.float64()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array([pid] * n, pa.int32()), pa.array([part] * n, pa.string()), keys,
             pa.array(texts if part != "row" else [None] * n, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
             *[pa.array(c, t) for c, t in zip(cols, kinds)]], names=names)

    def run(batches):
        pid = TaskContext.get().partitionId()
        held = None                                  # the last row so far: (key column, text)
        for batch, texts in text_blocks(batches, "t"):
            keys = batch.column("k")
            if held is None:
                yield rows(pid, "first", keys.slice(0, 1), texts[:1], None)
            else:
                keys = pa.concat_arrays([held[0], keys])
                texts = [held[1], *texts]
            if len(texts) > 1:
                done = compare(texts[:-1], texts[1:], [*range(1, len(texts) - 1), -1])
                yield rows(pid, "row", keys.slice(0, len(texts) - 1), texts[:-1], done)
            held = keys.slice(len(texts) - 1), texts[-1]
        if held:
            yield rows(pid, "last", held[0], [held[1]], None)

    first = cut_lineage(ordered.mapInArrow(run, f"pid int, part string, k {kind}, t string, {_RESULT}"))
    heads = first.where("part = 'first'").select("pid", F.col("t").alias("head"))
    pids = heads.select("pid")
    turn = Window.orderBy("pid")                     # one row per partition of the first pass
    to = pids.select("pid", F.lead("pid").over(turn).alias("nxt"), F.min("pid").over(turn).alias("least"))
    to = to.select("pid", F.coalesce("nxt", "least").alias("nxt"))
    ends = (first.where("part = 'last'").select("pid", "k", "t").join(to, "pid")
            .join(heads.select(F.col("pid").alias("nxt"), "head"), "nxt").select("k", "t", "head"))

    def finish(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                t, head = batch.column("t")[i].as_py(), batch.column("head")[i].as_py()
                yield rows(0, "row", batch.column("k").slice(i, 1), [t], compare([t], [head]))

    rest = ends.mapInArrow(finish, f"pid int, part string, k {kind}, t string, {_RESULT}")
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    return first.where("part = 'row'").unionByName(rest).select(F.col("k").alias(key), "n_chars", *hexed, "near_edited", "near_next")
