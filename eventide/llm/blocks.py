"""Helpers for work inside tasks: bounded blocks of texts and sorted groups."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Characters handled together; a longer text forms a block of its own.
BLOCK_CHARS = 5_000_000


def text_blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
                chars: int = BLOCK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with at most ``chars`` characters of text each
    (or a single longer text); null texts become empty."""
    for batch in batches:
        texts = [t if t is not None else "" for t in batch.column(column).to_pylist()]
        begin, held = 0, 0
        for i, t in enumerate(texts):
            if i > begin and held + len(t) > chars:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, held = i, 0
            held += len(t)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``df`` has none of them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def group_chunks(frames, keys: list[str]):
    """Frames of a partition sorted by ``keys``, cut so that each holds whole
    groups: ``(frame, edges)`` with the groups between consecutive edges.  A
    group must fit into memory; callers bound their groups."""
    held: list = []
    for pdf in frames:
        if not len(pdf):
            continue
        begin = pdf.iloc[0]
        if held and any(held[0][k].iat[0] != begin[k] for k in keys):
            yield _with_edges(held, keys)
            held = []
        last = np.ones(len(pdf), dtype=bool)
        for k in keys:
            v = pdf[k].to_numpy()
            last &= v == v[-1]
        cut = int(len(pdf) - np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            held.append(pdf.iloc[:cut])
            yield _with_edges(held, keys)
            held = []
        held.append(pdf.iloc[cut:])
    if held:
        yield _with_edges(held, keys)


def _with_edges(held: list, keys: list[str]):
    import pandas as pd

    pdf = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
    change = np.zeros(len(pdf), dtype=bool)
    for k in keys:
        v = pdf[k].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return pdf, [0, *np.flatnonzero(change).tolist(), len(pdf)]


def sorted_groups(frames, keys: list[str]):
    """The groups themselves, one frame each."""
    for pdf, edges in group_chunks(frames, keys):
        for a, b in zip(edges, edges[1:]):
            yield pdf.iloc[a:b].reset_index(drop=True)


def gather_runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all runs, in order."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)
