"""Hard-negative mining over an inverted multi-index.

Components become integers, so a score is an exact integer inner product.  The
two halves of the vectors have a codebook each (k-means on a bounded sample);
a row lies in the cell of its two nearest codes.  For an anchor the best score
that a cell can hold is at most the sum of two half bounds,

    half of the anchor * code + length of that half * radius of the code,

where the radius is the largest distance of any row from its code.  The
multi-sequence heap visits the cells by that sum, largest first.  A search of
windows (least and largest score, number wanted) is certified, and the visit
stops, once no cell left can reach what is still wanted.  So the results are
exact; the index only saves cells.

On Spark a search takes two rounds.  In the first each anchor visits cells up to
``VISIT_ROWS`` rows; what it finds raises the least score of its windows.  In the
second it visits all other cells that reach this score, which certifies it.
Anchors meet the rows of a cell in blocks of ``BLOCK`` rows, held one at a time,
with the anchors streamed past: neither a cell nor a score matrix is held whole,
and a hot cell is as many tasks as blocks.

Positives are the first rows of the anchor's label; negatives of other labels are
taken from a window of scores below each positive.  Ties go to the smaller key.

Rows with a null key, label or vector, or with a null or non-finite component,
take no part, nor do rows whose integer vector is ``2 ** 31`` or longer (a long
may not hold their scores).  Vectors of unequal size are compared over the
components that both have.  Equal rows (key, label and vector) are one row; a row
with the anchor's key is never its positive or negative.  Zero vectors take part.
An empty table, or one without anchors, gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from eventide.session import cut_lineage

#: Codes of each half; cells are pairs of them.
CODES = 32
#: Rows on which the codebooks are fitted, those of least hash.
SAMPLE_ROWS = 8192
#: Rows that an anchor's first round visits, at least.
VISIT_ROWS = 4096
#: Rows of a cell that meet anchors at once, on average at most.
BLOCK = 16_384
#: Anchors scored at once.
_CHUNK = 256
_LONGEST = float(2 ** 31)
_LEAST, _MOST = -(2 ** 62), 2 ** 62


def integers(df: DataFrame, anchors: str, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """``(id, label, vec, anchor)`` of the rows that take part, each once; ``vec``
    holds 32-bit integers."""
    def run(batches):
        for batch in batches:
            out = []
            for v in batch.column("v").to_pylist():
                x = None
                if v is not None and None not in v:
                    x = np.floor(np.asarray(v, dtype=np.float64) * scale)
                    x = x.astype("<i4").tobytes() if np.isfinite(x).all() and np.sqrt((x / _LONGEST) @ (x / _LONGEST)) < 1 else None
                out.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "label", "anchor")] + [pa.array(out, pa.binary())],
                                             names=["id", "label", "anchor", "vec"])

    kinds = {f.name: f.dataType.simpleString() for f in df.select(key, label).schema}
    rows = (df.selectExpr(f"`{key}` as id", f"`{label}` as label", f"coalesce({anchors}, false) as anchor", f"`{vector}` as v")
            .where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL"))
    rows = rows.mapInArrow(run, f"id {kinds[key]}, label {kinds[label]}, anchor boolean, vec binary").where("vec IS NOT NULL")
    return rows.groupBy("id", "label", "vec").agg(F.max("anchor").alias("anchor"))


def matrix(vecs, size: int) -> np.ndarray:
    """Integer vectors as rows of doubles, filled up with zeros to ``size``."""
    if all(len(v) == 4 * size for v in vecs):
        return np.frombuffer(b"".join(vecs), dtype="<i4").reshape(len(vecs), size).astype(np.float64)
    return np.stack([np.pad(np.frombuffer(v, dtype="<i4").astype(np.float64), (0, size - len(v) // 4)) for v in vecs])


def codebook(x: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    """k-means centres of the rows of ``x``, from its first different rows."""
    _, first = np.unique(x, axis=0, return_index=True)
    centres = x[np.sort(first)[:codes]].copy()
    for _ in range(rounds):
        near = nearest(x, centres)[0]
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of every row and the distance to it."""
    square = (centres * centres).sum(axis=1)
    near = np.concatenate([(square - 2 * x[i:i + 4096] @ centres.T).argmin(axis=1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])
    return near, np.sqrt(((x - centres[near]) ** 2).sum(axis=1))


class Index:
    """The two codebooks, the codes' radii and the number of rows per cell."""

    def __init__(self, size: int, books: list[np.ndarray]):
        self.size, self.half, self.books = size, size // 2, books
        self.second = len(books[1])                  # a cell's number: first code * second + second code
        self.radii = [np.full(len(b), -1.0) for b in books]
        self.rows: dict[int, int] = {}

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.half], x[:, self.half:]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        (i, p), (j, q) = (nearest(h, b) for h, b in zip(self.halves(x), self.books))
        return i * self.second + j, p, q

    def add(self, cell: int, rows: int, first: float, second: float) -> None:
        self.rows[cell] = rows
        for of, code, r in ((0, cell // self.second, first), (1, cell % self.second, second)):
            self.radii[of][code] = max(self.radii[of][code], r)

    def half_bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half the used codes by bound, largest first, and the bounds, raised
        by more than rounding can lower them."""
        out = []
        for h, book, radii in zip((q[:self.half], q[self.half:]), self.books, self.radii):
            used = np.flatnonzero(radii >= 0)
            length = np.sqrt(h @ h)
            bound = book[used] @ h + length * radii[used]
            bound += 1e-9 * (np.abs(book[used]) @ np.abs(h) + length * radii[used]) + 1e-6
            order = np.argsort(-bound, kind="stable")
            out.append((used[order], bound[order]))
        return out

    def visit(self, q: np.ndarray):
        """Cells that hold rows and their bounds, largest bound first: the heap
        holds the next pairs of codes, each reached from one neighbour only."""
        (codes1, bound1), (codes2, bound2) = self.half_bounds(q)
        if not len(codes1) or not len(codes2):
            return
        heap = [(-(bound1[0] + bound2[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < len(codes2):
                heapq.heappush(heap, (-(bound1[i] + bound2[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(codes1):
                heapq.heappush(heap, (-(bound1[i + 1] + bound2[0]), i + 1, 0))
            cell = int(codes1[i]) * self.second + int(codes2[j])
            if cell in self.rows:
                yield cell, -bound


def build(rows: DataFrame) -> tuple[Index | None, DataFrame]:
    """The index of the rows, and the rows with their ``cell`` and ``part`` of it."""
    rows = cut_lineage(rows)
    size = rows.agg(F.max(F.length("vec"))).first()[0]
    if size is None:
        return None, rows
    size = max(2, size // 4)
    sample = rows.select("vec", F.xxhash64("id", "vec").alias("h")).orderBy("h", "vec").limit(SAMPLE_ROWS).toArrow()
    x = matrix(sample["vec"].to_pylist(), size)
    index = Index(size, [codebook(h, CODES) for h in (x[:, :size // 2], x[:, size // 2:])])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cell, p, q = index.place(matrix(batch.column("vec").to_pylist(), index.size))
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, (cell, p, q))], names=[*batch.schema.names, "cell", "p", "q"])

    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    placed = cut_lineage(rows.mapInArrow(run, f"{kinds}, cell bigint, p double, q double"))
    # At most CODES ** 2 cells.
    for cell, n, p, q in placed.groupBy("cell").agg(F.count("*"), F.max("p"), F.max("q")).collect():
        index.add(cell, n, p, q)
    parts = F.broadcast(_parts(rows.sparkSession, index))
    return index, placed.join(parts, "cell").select("id", "label", "vec", "anchor", "cell", F.pmod(F.xxhash64("id", "vec"), "parts").alias("part"))


def _parts(spark, index: Index) -> DataFrame:
    return spark.createDataFrame([(c, -(-n // BLOCK)) for c, n in index.rows.items()], "cell bigint, parts bigint")


def _visits(anchors: DataFrame, index: Index, rows: int | None) -> DataFrame:
    """Adds ``cells`` to anchors ``(ak, vec, lo, done)``: those behind the first
    ``done`` that may reach the least score wanted, up to ``rows`` rows; ``done``
    counts them."""
    def run(batches):
        for batch in batches:
            cells, seen = [], []
            for vec, lo, done in zip(*(batch.column(c).to_pylist() for c in ("vec", "lo", "done"))):
                least, held, found, n = min(lo), 0, [], 0
                for cell, bound in index.visit(matrix([vec], index.size)[0]):
                    if bound < least or rows is not None and held >= rows:
                        break
                    n += 1
                    if n > done:
                        found.append(cell)
                        held += index.rows[cell]
                cells.append(found)
                seen.append(max(n, done))
            at = batch.schema.names.index("done")
            columns = [pa.array(seen, pa.int64()) if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cells, pa.list_(pa.int64()))], names=[*batch.schema.names, "cells"])

    kinds = ", ".join(f"{n} {t}" for n, t in anchors.dtypes)
    return anchors.mapInArrow(run, f"{kinds}, cells array<bigint>")


def _meet(rows: DataFrame, visits: DataFrame, index: Index, same: bool, k: int) -> DataFrame:
    """``(ak, w, id, score)``: per anchor, window and block the first ``k`` rows of
    the anchor's label (``same``) or of other labels within the window."""
    parts = F.broadcast(_parts(rows.sparkSession, index))
    asked = (visits.select("ak", "id", "label", "vec", "lo", "hi", F.explode("cells").alias("cell")).join(parts, "cell")
             .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))))
    none = F.lit(None)
    sides = rows.select("cell", "part", F.lit(0).alias("side"), "id", "label", "vec", none.cast("bigint").alias("ak"),
                        none.cast("array<bigint>").alias("lo"), none.cast("array<bigint>").alias("hi"))
    sides = sides.unionByName(asked.select("cell", "part", F.lit(1).alias("side"), "id", "label", "vec", "ak", "lo", "hi"))
    dealt = sides.repartition("cell", "part").sortWithinPartitions("cell", "part", "side")

    def run(frames):
        import pandas as pd

        held: list = []
        block, at = None, None
        for pdf in frames:
            cell, part, side = (pdf[c].to_numpy() for c in ("cell", "part", "side"))
            change = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (side[1:] != side[:-1])) + 1
            for s, e in zip([0, *change], [*change, len(pdf)]):
                if s == e:
                    continue
                here, run_ = (cell[s], part[s]), pdf.iloc[s:e]
                if here != at:
                    held, block, at = [], None, here
                if side[s] == 0:
                    held.append(run_)
                    continue
                if not held:
                    continue
                if block is None:
                    block = _Block(pd.concat(held), index.size)
                for i in range(0, len(run_), _CHUNK):
                    got = block.best(run_.iloc[i:i + _CHUNK], same, k)
                    if got:
                        yield pd.DataFrame({c: np.concatenate([g[n] for g in got]) for n, c in enumerate(("ak", "w", "id", "score"))})

    return dealt.mapInPandas(run, f"ak bigint, w int, id {dict(rows.dtypes)['id']}, score bigint")


class _Block:
    """Rows of a cell in a task, by key."""

    def __init__(self, pdf, size: int):
        pdf = pdf.sort_values("id")
        self.ids, self.labels, self.size = pdf["id"].to_numpy(), pdf["label"].to_numpy(), size
        self.x = matrix(pdf["vec"].tolist(), size)
        self.most = np.sqrt((self.x ** 2).sum(axis=1).max())

    def scores(self, q: np.ndarray) -> np.ndarray:
        if self.most * np.sqrt((q ** 2).sum(axis=1).max()) < 2 ** 52:
            return (q @ self.x.T).astype(np.int64)      # exact in doubles
        return q.astype(np.int64) @ self.x.astype(np.int64).T

    def best(self, anchors, same: bool, k: int) -> list:
        s = self.scores(matrix(anchors["vec"].tolist(), self.size))
        equal = anchors["label"].to_numpy()[:, None] == self.labels[None, :]
        ok = (equal if same else ~equal) & (anchors["id"].to_numpy()[:, None] != self.ids[None, :])
        s = np.where(ok, s, _LEAST - 1)
        top = s.max(axis=1)
        out = []
        for r, (ak, lows, highs) in enumerate(zip(anchors["ak"].to_numpy(), anchors["lo"], anchors["hi"])):
            for w, (lo, hi) in enumerate(zip(lows, highs)):
                if top[r] < lo:
                    continue
                hit = np.flatnonzero((s[r] >= lo) & (s[r] <= hi))
                if len(hit) > k:
                    least = np.partition(s[r][hit], len(hit) - k)[len(hit) - k]
                    hit = hit[s[r][hit] >= least]
                hit = hit[np.argsort(-s[r][hit], kind="stable")[:k]]
                if len(hit):
                    out.append((np.full(len(hit), ak), np.full(len(hit), w, np.int32), self.ids[hit], s[r][hit]))
        return out


def _first(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("ak", "w").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def search(index: Index, rows: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """``(ak, w, id, score, rank)``: the first ``k`` rows of each window of each
    anchor ``(ak, id, label, vec, lo, hi)``."""
    first = cut_lineage(_visits(anchors.withColumn("done", F.lit(0).cast("bigint")), index, VISIT_ROWS))
    found = cut_lineage(_first(_meet(rows, first, index, same, k), k).drop("rank"))
    # A window that is full wants no less than its last row's score.
    full = found.groupBy("ak", "w").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
    full = full.groupBy("ak").agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("least"))
    second = first.drop("cells").join(full, "ak", "left").withColumn(
        "lo", F.transform("lo", lambda v, w: F.greatest(v, F.element_at(F.col("least"), w)))).drop("least")
    more = _meet(rows, _visits(second, index, None), index, same, k)
    return cut_lineage(_first(found.unionByName(more), k))


def hard_negatives(df: DataFrame, anchors: str, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
                   key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``: for each anchor (rows that the SQL condition ``anchors``
    selects) and each of its first ``positives`` rows of the same label the first
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` hundredths
    of the positive's."""
    spark, kind = df.sparkSession, dict(df.dtypes)[key]
    schema = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score bigint, negative_score bigint"
    index, rows = build(integers(df, anchors, key, vector, label, scale))
    if index is None:
        return spark.createDataFrame([], schema)
    of = cut_lineage(rows.where("anchor").select(F.monotonically_increasing_id().alias("ak"), "id", "label", "vec"))

    def window(least, most):
        return F.array(F.lit(least).cast("bigint")), F.array(F.lit(most).cast("bigint"))

    lo, hi = window(_LEAST, _MOST)
    near = search(index, rows, of.withColumn("lo", lo).withColumn("hi", hi), True, positives).select(
        "ak", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    share = F.col("positive_score").cast("decimal(38,0)")
    bounds = near.select("ak", "w", F.ceil(share * low / 100).cast("bigint").alias("l"), F.floor(share * high / 100).cast("bigint").alias("h"))
    wanted = bounds.groupBy("ak").agg(F.array_sort(F.collect_list(F.struct("w", "l", "h"))).alias("wanted"))
    asked = of.join(wanted, "ak").select("ak", "id", "label", "vec", F.col("wanted.l").alias("lo"), F.col("wanted.h").alias("hi"))
    far = search(index, rows, asked, False, negatives)
    names = of.select("ak", F.col("id").alias("anchor_id"))
    return (far.join(near, ["ak", "w"]).join(names, "ak")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
