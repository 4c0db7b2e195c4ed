"""SimHash near-dedup by a self-join of a binary trie.

Fingerprints of equal bits are one entry.  The trie over the 64 bits is
traversed in node pairs: a pair carries the number of differing bits so far and
its children are visited only while that number is within the budget.  Two
fingerprints within ``e`` bits differ in at most ``e // 2`` bits of their upper
half or in at most ``e - e // 2 - 1`` bits of their lower half, so two tries
(one with the halves swapped) are traversed with that smaller budget over the
first 32 bits; together they lose no link and prune early.

On Spark the top of the trie is expanded as a DataFrame of node pairs, down to
nodes of ``LEAF`` fingerprints on average; a crowded node is expanded further.
The fingerprints meet in the remaining node pairs, where each task goes down
the two subtrees with sorted arrays.  A task hands on a spanning forest of the
links it finds, not the links; components follow on Spark.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.blocks import free_names, gather_runs, sorted_groups, text_blocks
from eventide.llm.components import Forest, components
from eventide.session import cut_lineage

BITS = 64
HALF = 32
#: Fingerprints below a node of the first expansion, on average, at most.
LEAF = 1 << 16
#: A node with more fingerprints than this is expanded further on Spark.
CROWDED = 8 * LEAF
#: Bits by which a crowded node is expanded at once.
STEP = 4
#: Node pairs with at most so many fingerprint pairs are compared directly.
DIRECT = 32
_LANES = np.uint64(0x0101010101010101)


def simhash_block(texts: list[str], shingle: int = 4, seed: int = 42) -> np.ndarray:
    """64-bit SimHash of each text: bit = set in over half of the shingles'
    XXH64 (repeats included); without words zero."""
    digest = xxhash.xxh64_intdigest
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for k, t in enumerate(texts):
        words = t.encode().lower().split()          # bytes: A-Z and ASCII white space only
        if not words:
            continue
        norm = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        if len(words) > shingle:
            starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
        else:
            starts, ends = starts[:1], ends[-1:]
        counts[k] = len(starts)
        hashes.append(np.fromiter((digest(norm[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts)))
    out = np.zeros(len(texts), dtype=np.uint64)
    if not hashes:
        return out
    h = np.concatenate(hashes)
    some = np.flatnonzero(counts)
    n = counts[some]
    parts = -(-n // 255)                             # runs of at most 255: a byte lane can't overflow
    runs = np.repeat(np.cumsum(n) - n, parts) + 255 * gather_runs(np.zeros(len(parts), np.int64), parts)
    doc_run = np.cumsum(parts) - parts
    for s in range(8):
        lanes = np.add.reduceat((h >> np.uint64(s)) & _LANES, runs)
        per_run = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        per_doc = np.add.reduceat(per_run, doc_run, axis=0)
        bits = (2 * per_doc > n[:, None]).astype(np.uint64)
        for lane in range(8):
            out[some] |= bits[:, lane] << np.uint64(8 * lane + s)
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, fp bigint)`` of every text; null texts count as empty."""
    def run(batches):
        for batch, texts in text_blocks(batches, "t"):
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(simhash_block(texts, shingle).view(np.int64))], names=[key, "fp"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.selectExpr(f"`{key}` as k", f"cast(`{text}` as string) as t").mapInArrow(run, f"`{key}` {kind}, fp bigint")


def _half_budget(order: int, bits: int) -> int:
    return bits // 2 if order == 0 else bits - bits // 2 - 1


def _shifted(code: Column, depth: int) -> Column:
    return F.lit(0).cast("bigint") if depth == 0 else F.shiftrightunsigned(code, BITS - depth)


def _node_pairs(codes: DataFrame, order: int, bits: int, size: int):
    """Node pairs of one trie to be joined in tasks: a list of ``(depth,
    DataFrame(x, y, diff))``, pairs of a depth with ``x <= y``."""
    half = _half_budget(order, bits)
    if half < 0:
        return []
    depth = min(HALF, max(0, int(np.ceil(np.log2(max(size, 1) / LEAF)))))
    nodes = codes.select(_shifted(F.col("code"), depth).alias("x")).groupBy("x").agg(F.count("*").alias("n"))
    masks = [sum(1 << b for b in c) for r in range(half + 1) for c in itertools.combinations(range(depth), r)]
    pairs = (nodes.select("x", F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])).alias("m"))
             .select("x", F.expr("x ^ m").alias("y"), F.bit_count("m").cast("int").alias("diff")).where("x <= y")
             .join(nodes.select(F.col("x").alias("y")), "y", "left_semi"))
    out = []
    while True:
        crowded = nodes.where(F.col("n") > CROWDED).select("x")
        if depth >= BITS or crowded.isEmpty():
            out.append((depth, pairs.select("x", "y", "diff")))
            return out
        # Pairs that touch a crowded node go down; the others are ready.
        cx, cy = crowded.withColumn("cx", F.lit(True)), crowded.select(F.col("x").alias("y")).withColumn("cy", F.lit(True))
        marked = pairs.join(cx, "x", "left").join(cy, "y", "left")
        out.append((depth, marked.where("cx IS NULL AND cy IS NULL").select("x", "y", "diff")))
        step = min(STEP, BITS - depth)
        down = marked.where("cx OR cy").select("x", "y", "diff")
        depth += step
        nodes = codes.select(_shifted(F.col("code"), depth).alias("x")).groupBy("x").agg(F.count("*").alias("n"))
        left = nodes.select(F.shiftright("x", step).alias("x"), F.col("x").alias("x2"))
        right = nodes.select(F.shiftright("x", step).alias("y"), F.col("x").alias("y2"))
        budget = half if depth <= HALF else bits
        mask = (1 << step) - 1
        pairs = cut_lineage(
            down.join(left, "x").join(right, "y").where("x2 <= y2")
            .select(F.col("x2").alias("x"), F.col("y2").alias("y"),
                    (F.col("diff") + F.bit_count(F.expr(f"(x2 ^ y2) & {mask}"))).cast("int").alias("diff"))
            .where(F.col("diff") <= budget))
        used = pairs.select("x").unionByName(pairs.select(F.col("y").alias("x"))).distinct()
        nodes = cut_lineage(nodes.join(used, "x", "left_semi"))


def _rotated(code: Column, order: int) -> Column:
    return code if order == 0 else F.shiftleft(code, HALF).bitwiseOR(F.shiftrightunsigned(code, HALF))


def links(fps: DataFrame, bits: int = 4) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints within ``bits`` bits of
    each other as those links do: per node pair a spanning forest.  ``fps`` has
    different values in column ``fp``."""
    size = fps.count()
    met = None
    for order in (0, 1):
        codes = fps.select(_rotated(F.col("fp"), order).alias("code"))
        for depth, pairs in _node_pairs(codes, order, bits, size):
            sides = pairs.select("x", "y", "diff", F.explode(F.array(F.struct(F.col("x").alias("p"), F.lit(0).cast("byte").alias("side")),
                                                                      F.struct(F.col("y").alias("p"), F.lit(1).cast("byte").alias("side")))).alias("s"))
            sides = sides.where("x < y OR s.side = 0").select("x", "y", "diff", "s.p", "s.side")
            rows = (codes.withColumn("p", _shifted(F.col("code"), depth)).join(sides, "p")
                    .select(F.lit(order).cast("byte").alias("turn"), F.lit(depth).cast("byte").alias("depth"), "x", "y", "diff", "side", "code"))
            met = rows if met is None else met.unionByName(rows)
    dealt = met.repartition("turn", "depth", "x", "y").sortWithinPartitions("turn", "depth", "x", "y", "side")

    def run(frames):
        import pandas as pd

        for pdf in sorted_groups(frames, ["turn", "depth", "x", "y"]):
            turn, depth = int(pdf["turn"].iat[0]), int(pdf["depth"].iat[0])
            codes, forest = join_nodes(pdf["code"].to_numpy().view(np.uint64), pdf["side"].to_numpy() == 1,
                                       depth, int(pdf["diff"].iat[0]), _half_budget(turn, bits), bits)
            i, j = forest.edges()
            a, b = codes[i], codes[j]
            if turn:
                a, b = (x << np.uint64(HALF) | x >> np.uint64(HALF) for x in (a, b))
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.mapInPandas(run, "a bigint, b bigint")


def join_nodes(codes: np.ndarray, second: np.ndarray, depth: int, diff: int, half: int, bits: int) -> tuple[np.ndarray, Forest]:
    """All links between the subtrees of two nodes (``second`` marks the codes
    of the other node; none marked: within one node), as a forest over the
    sorted codes."""
    codes = np.sort(codes)                          # the first node's prefix is the smaller
    n, first = len(codes), int((~second).sum())
    forest = Forest(n)
    padded = np.append(codes, np.uint64(0))
    if first < n:
        frontier = [np.array([v]) for v in (0, first, first, n, diff)]
    else:
        frontier = [np.array([v]) for v in (0, n, 0, n, diff)]
    while len(frontier[0]):
        a0, a1, b0, b1, d = frontier
        small = ((a1 - a0) * (b1 - b0) <= DIRECT) | (depth == BITS)
        _compare(padded, forest, a0[small], a1[small], b0[small], b1[small], bits)
        a0, a1, b0, b1, d = (v[~small] for v in (a0, a1, b0, b1, d))
        if not len(a0):
            return codes, forest
        # Where each node's one-child begins.
        bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
        below = bit - np.uint64(1)
        am = np.searchsorted(codes, (codes[a0] & ~(bit | below)) | bit)
        bm = np.searchsorted(codes, (codes[b0] & ~(bit | below)) | bit)
        own = a0 == b0
        depth += 1
        budget = half if depth <= HALF else bits
        parts = [(a0, am, b0, bm, d), (am, a1, bm, b1, d), (a0, am, bm, b1, d + 1),
                 tuple(v[~own] for v in (am, a1, b0, bm, d + 1))]
        frontier = [np.concatenate(v) for v in zip(*parts)]
        keep = (frontier[0] < frontier[1]) & (frontier[2] < frontier[3]) & (frontier[4] <= budget)
        frontier = [v[keep] for v in frontier]
    return codes, forest


def _compare(codes: np.ndarray, forest: Forest, a0, a1, b0, b1, bits: int, chunk: int = 1_000_000) -> None:
    """Compare every code of the ranges ``a`` with every code of the ranges ``b``."""
    na, nb = a1 - a0, b1 - b0
    work = np.cumsum(na * nb)
    begin = 0
    while begin < len(na):
        end = max(begin + 1, int(np.searchsorted(work, (work[begin - 1] if begin else 0) + chunk, side="right")))
        s = slice(begin, end)
        left = gather_runs(a0[s], na[s])
        i = np.repeat(left, np.repeat(nb[s], na[s]))
        j = gather_runs(np.repeat(b0[s], na[s]), np.repeat(nb[s], na[s]))
        hit = (i < j) & (np.bitwise_count(codes[i] ^ codes[j]) <= bits)
        forest.link(i[hit], j[hit])
        begin = end


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, fp, component_id)`` of every row: component_id is the smallest key
    reachable over fingerprints that differ in at most ``bits`` bits.

    Null and empty texts have fingerprint zero and link like any other; rows
    with a null key get the component of their fingerprint (null if no row of
    the component has a key); repeated rows stay; an empty table gives an empty
    table; other columns are not read."""
    prints = cut_lineage(fingerprints(docs, shingle, text, key))
    uniq = cut_lineage(prints.groupBy("fp").agg(F.min(key).alias("rep")))
    comp = components(links(uniq.select("fp"), bits))
    of = uniq.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left")
    of = of.withColumn("component", F.coalesce("component", "fp"))
    least = of.groupBy("component").agg(F.min("rep").alias("component_id"))
    to = of.join(least, "component").select("fp", "component_id")
    return prints.join(to, "fp").select(key, "fp", "component_id")


def deduplicate(docs: DataFrame, shingle: int = 4, bits: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group stays: the one with the smallest key, then text hash
    (rows without a key come last).  All columns are kept.  Repeated rows (equal key
    and text, a null text being an empty one, whatever their other columns) are one
    row first, of which the one with the least hash of all columns but maps stays;
    equal keys with different texts are documents of their own."""
    k, th, fp, r = free_names(docs, "__k", "__th", "__fp", "__r")
    hashed = docs.withColumn(k, F.col(key)).withColumn(th, F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    # Every task keeps one of its equal rows before the shuffle.
    same = Window.partitionBy(k, th).orderBy(F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind]))
    once = hashed.withColumn(r, F.row_number().over(same)).where(F.col(r) == 1).drop(r)
    named = docs.select(F.struct(F.col(key).alias("k"), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("th")).alias("row"), F.col(text).alias("t"))
    prints = cut_lineage(fingerprints(named, shingle, "t", "row").distinct())
    comp = components(links(prints.select("fp").distinct(), bits))
    of = prints.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    place = F.struct(F.col("row.k").isNull().alias("none"), F.col("row.k").alias("k"), F.col("row.th").alias("th"))
    first = of.groupBy("component").agg(F.min(place).alias("first")).select(F.col("first.k").alias(fp), F.col("first.th").alias("__of"))
    keep = once.join(first, once[k].eqNullSafe(first[fp]) & (once[th] == first["__of"]), "left_semi")
    return keep.select(*docs.columns)
