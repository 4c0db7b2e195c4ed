"""Euclidean p-stable hashing of embeddings for near-duplicate search.

Normalised vectors are projected on random directions with Gaussian entries,
shifted and cut into steps of ``WIDTH``; ``k`` such numbers form a bucket and
``t`` tables of buckets are made.  Two vectors of the same label that share a
bucket are compared exactly (cosine in double precision), in the first table in
which they meet, so a link counts once.

Bounds: equal vectors of a label form one class with a multiplicity.  The
number of projections follows the number of classes (a random vector should meet
about ``MEETINGS`` others per table) and the number of tables follows from the
wanted recall at the threshold.  Comparing is cheap beside shipping a vector to one
more table, so buckets are large and tables few.  A bucket of more than ``BLOCK``
classes is dealt into blocks and compared block by block, in as many tasks.  Blocks
are dealt on bucket numbers alone; a vector is shipped once per block, in the width
of its column.  A task hands on link counts and a spanning forest, never the pairs.

Vectors that are null, zero, or hold null or non-finite components link with
nothing; a null label links with nothing.  A row without a vec_id has no links
and no component and is not kept.  Repeated rows are vectors of their own: each
counts the others.  Rows with the same vec_id and different vectors or labels are
rows of their own, too.  Vectors of unequal size link with nothing of another size.  Components
may be as large or small as doubles are.  An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm.blocks import group_chunks
from eventide.llm.components import Forest, components
from eventide.session import cut_lineage

WIDTH = 2.5
RECALL = 0.98
MEETINGS = 1024
BLOCK = 8192
#: Rows of a block that are compared with the whole block at once.
_CHUNK = 512


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one projection puts two vectors at ``distance`` in one step."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(classes: int, cosine: float, recall: float = RECALL) -> tuple[int, int]:
    """Projections per table and tables for so many classes."""
    near, far = collision(math.sqrt(2 - 2 * cosine)), collision(math.sqrt(2))
    k = max(1, math.ceil(math.log(max(classes / MEETINGS, 1.0)) / -math.log(far)))
    t = max(1, math.ceil(math.log(1 - recall) / math.log(1 - near ** k))) if near < 1 else 1
    return k, t


def _classes(df: DataFrame, key: str, vector: str, label: str) -> tuple[DataFrame, str]:
    """``(id, label, vec)`` of every row, and the number type of ``vec``, its bytes."""
    number = "<f4" if dict(df.dtypes)[vector] == "array<float>" else "<f8"

    def run(batches):
        for batch in batches:
            out = []
            for v in batch.column("v").to_pylist():
                x = None
                if v is not None and len(v) and None not in v:
                    x = np.asarray(v, dtype=number)
                    if not np.isfinite(x).all() or not x.any():
                        x = None
                # -0.0 and 0.0 are equal components
                out.append((x + 0.0).astype(number).tobytes() if x is not None else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(out, pa.binary())], names=["id", "label", "vec"])

    kinds = {f.name: f.dataType.simpleString() for f in df.select(key, label).schema}
    rows = df.selectExpr(f"`{key}` as id", f"`{label}` as label", f"`{vector}` as v").mapInArrow(
        run, f"id {kinds[key]}, label {kinds[label]}, vec binary")
    return rows.withColumn("vec", F.when(F.col("label").isNotNull() & F.col("id").isNotNull(), F.col("vec"))), number


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component is divided out first, so that no
    square leaves the range of doubles."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _buckets(classes: DataFrame, number: str, k: int, t: int, seed: int) -> DataFrame:
    """``(name, label, size, buckets)``: one 64-bit bucket number per table."""
    def run(batches):
        made: dict[int, tuple] = {}
        mix = (np.random.default_rng(seed).integers(1, 2**62, size=k, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        for batch in batches:
            vecs = batch.column("vec").to_pylist()
            sizes = np.array([len(v) for v in vecs], dtype=np.int32)
            out: list = [None] * len(vecs)
            for size in np.unique(sizes).tolist():
                if size not in made:
                    rng = np.random.default_rng([seed, size])
                    made[size] = rng.standard_normal((size // np.dtype(number).itemsize, k * t)), rng.uniform(0, WIDTH, k * t)
                direction, shift = made[size]
                of = np.flatnonzero(sizes == size)
                x = _units([vecs[i] for i in of], number)
                steps = np.floor((x @ direction + shift) / WIDTH).astype(np.int64).reshape(len(of), t, k)
                h = (steps.astype(np.uint64) * mix).sum(axis=2, dtype=np.uint64)
                h ^= h >> np.uint64(31)
                h *= np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                for i, row in zip(of.tolist(), h.view(np.int64)):
                    out[i] = row
            yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("label"), pa.array(sizes), pa.array(out, pa.list_(pa.int64()))],
                                             names=["name", "label", "size", "buckets"])

    return classes.select("name", "label", "vec").mapInArrow(run, f"name bigint, label {dict(classes.dtypes)['label']}, size int, buckets array<bigint>")


def _units(vecs, number: str) -> np.ndarray:
    return unit(np.frombuffer(b"".join(vecs), dtype=number).reshape(len(vecs), -1).astype(np.float64))


def _linked(classes: DataFrame, hashed: DataFrame, number: str, cosine: float) -> DataFrame:
    """``(a, b, n)``, classes by name.  ``b`` -1: links counted for a class;
    otherwise a link of the spanning forest."""
    bucket = ["t", "bucket", "label", "size"]
    spread = hashed.select("name", "label", "size", "buckets", F.posexplode("buckets").alias("t", "bucket"))
    crowded = (spread.groupBy(*bucket).agg(F.count("*").alias("m")).where(F.col("m") > BLOCK)
               .select(*bucket, F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    # The buckets of the tables before tell where a pair has met already.
    spread = spread.select("name", *bucket, F.slice("buckets", 1, F.col("t")).alias("seen")).join(crowded, bucket, "left")
    spread = spread.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    spread = spread.withColumn("own", F.pmod(F.xxhash64("name", "t"), F.col("blocks")).cast("int"))
    meet = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meet = meet.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "blocks")
    keys = [*bucket, "i", "j"]
    dealt = meet.join(classes.select("name", "vec", "n"), "name").repartition(*keys).sortWithinPartitions(*keys, "own", "name")

    def run(frames):
        import pandas as pd

        for pdf, edges in group_chunks(frames, keys):
            names, mult, own = (pdf[c].to_numpy() for c in ("name", "n", "own"))
            vecs, tables, ii, jj, seen = (pdf[c].to_numpy() for c in ("vec", "t", "i", "j", "seen"))
            a, b, n = [], [], []                      # places in the frame
            for s, e in zip(edges, edges[1:]):
                if e - s < 2:
                    continue
                cross = ii[s] != jj[s]
                mid = int((own[s:e] == ii[s]).sum()) if cross else 0
                x = _units(vecs[s:e], number)
                met = np.stack(seen[s:e]) if tables[s] else None
                p, q = _near(x, mid, cosine, met) if cross else _near(x, None, cosine, met)
                if not len(p):
                    continue
                m = mult[s:e]
                got = np.bincount(p, weights=m[q], minlength=e - s) + np.bincount(q, weights=m[p], minlength=e - s)
                hit = np.flatnonzero(got)
                forest = Forest(e - s)
                forest.link(p, q)
                u, v = forest.edges()
                a += [s + hit, s + u]
                b += [np.full(len(hit), -1), s + v]
                n += [got[hit].astype(np.int64), np.zeros(len(u), np.int64)]
            if a:
                a, b, n = (np.concatenate(c) for c in (a, b, n))
                yield pd.DataFrame({"a": names[a], "b": np.where(b < 0, -1, names[b]), "n": n})

    return dealt.mapInPandas(run, "a bigint, b bigint, n bigint")


def _near(x: np.ndarray, mid: int | None, cosine: float, met: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows at ``cosine`` or nearer, those before ``mid`` with those behind it
    (all with all: None), that share no bucket of the tables before."""
    ps, qs = [], []
    end = len(x) if mid is None else mid
    for at in range(0, end, _CHUNK):
        stop = min(at + _CHUNK, end)
        first = at if mid is None else mid
        p, q = np.nonzero(x[at:stop] @ x[first:].T >= cosine)
        p, q = p + at, q + first
        later = q > p
        ps.append(p[later])
        qs.append(q[later])
    p, q = np.concatenate(ps) if ps else np.zeros(0, np.int64), np.concatenate(qs) if qs else np.zeros(0, np.int64)
    if met is not None and len(p):
        new = np.ones(len(p), dtype=bool)
        for c in range(met.shape[1]):
            new &= met[p, c] != met[q, c]
        p, q = p[new], q[new]
    return p, q


def near_duplicates(df: DataFrame, cosine: float = 0.93, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label", recall: float = RECALL, seed: int = 42) -> DataFrame:
    """``(key, n_links, component_id, kept)`` of every vector."""
    rows, number = _classes(df, key, vector, label)
    rows = cut_lineage(rows)
    classes = rows.where("vec IS NOT NULL").groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    classes = cut_lineage(classes.withColumn("name", F.monotonically_increasing_id()))
    k, t = plan(classes.count(), cosine, recall)
    found = cut_lineage(_linked(classes, cut_lineage(_buckets(classes, number, k, t, seed)), number, cosine))
    comp = components(found.where("b >= 0").select("a", "b")).withColumnRenamed("node", "name")
    more = found.where("b < 0").groupBy(F.col("a").alias("name")).agg(F.sum("n").alias("more"))
    named = classes.join(comp, "name", "left").withColumn("component", F.coalesce("component", "name"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of = named.join(least, "component").join(more, "name", "left").select(
        "label", "vec", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id")
    out = rows.join(of, ["label", "vec"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
