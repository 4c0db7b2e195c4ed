"""Approximate nearest neighbours by largest inner product over an NN-descent graph.

Equal vectors are one node.  Every node keeps its ``DEGREE`` best neighbours found
so far.  They start as the best of a few groupings by the nearest of random pivots (at
random where these are many nodes); then each round joins
neighbours of neighbours: a node's neighbours, forwards and backwards, are compared
with each other (pairs with at least one new link only), and each of the two takes
the other in if it is among its best.  Rounds end when few links are new.  Queries
are searched greedily: the best ``BEAM`` nodes found so far are expanded by their
neighbours until all of them have been.

On Spark nodes are numbered without gaps and dealt into buckets and shelves by their
numbers; links, vectors and scores go between tasks in packets, one row for all that
one task has for a bucket or shelf.  A round deals the pairs of neighbours to the
shelves of their centres; a shelf asks the buckets for the vectors that it needs, each
once, and hands on at most ``DEGREE`` candidates a node.  A hub's backward neighbours
are dealt into slots of about ``CROWD``, so no group grows with the table.  Queries go
in parts: their vectors go to the shelves of the nodes that they ask for, and only inner
products that may count come back.

Vectors are scaled by the longest and get one more component that makes them unit
vectors, which turns the largest inner product into the nearest vector; the graph
compares them in half precision.  What a search finds is scored in double precision
on the vectors themselves.

Recall depends on the data (tests and README give figures); nothing else is left
out: every row is a node's, and copies of a vector come in by key.  Vectors that are
null, zero, or hold null or non-finite components take no part, nor do rows without
a key.  Vectors of unequal size are filled up with zeros.  Equal rows are one row;
rows with the same key and other vectors are rows of their own.  Ties go to the
smaller key.  An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from eventide.llm.blocks import gather_runs
from eventide.operators.scan import dealt
from eventide.session import cut_lineage

#: Neighbours of a node.
DEGREE = 48
#: Best nodes that a search expands, and how many of them at once.
BEAM, STEP = 288, 144
#: Groupings at the start, nodes of a group, and pivots of a grouping at most.
STARTS, GROUP, PIVOTS = 8, 4096, 1024
#: Rounds at most, and the share of new links at which they end.
ROUNDS, FEW = 8, 0.05
#: Nodes of a shelf, backward neighbours of a slot, queries of a part, nodes of a
#: bucket.  A shelf needs at most 97 vectors a centre (in half precision 300 MB for 64
#: components); larger shelves need fewer copies of each.
CENTRES, CROWD, QUERIES, BUCKET = 24_576, 1024, 256, 1024
#: Nodes at which every search begins besides its own: so many of least hash and as
#: many of the longest.
ENTRIES = 16
#: Shelves at least, where there are as many buckets.
TASKS = 16
#: Links that a task holds before it sends them, or keeps only the best of each node.
_HELD = 4_000_000
#: Inner products of one step of a join, and bytes of a batch that a task hands on.
_CELLS, _BATCH = 1_000_000, 16_000_000


def _rows(df: DataFrame, queries: str, key: str, vector: str) -> tuple[DataFrame, str]:
    """``(id, vec, size, log, asked)`` of the rows that take part, each once, and
    the number type of ``vec``; ``log`` is the logarithm of the length."""
    number = "<f4" if dict(df.dtypes)[vector] == "array<float>" else "<f8"

    def whole(batch):
        """The same for rows of one size without nulls, all at once; None for others."""
        column = batch.column("v")
        flat, sizes = column.flatten(), np.diff(column.offsets.to_numpy())
        if not len(sizes) or not sizes[0] or flat.null_count or (sizes != sizes[0]).any():
            return None
        x = flat.to_numpy().astype(number).reshape(len(sizes), -1)
        ok = np.isfinite(x).all(axis=1) & x.any(axis=1)
        x[~ok] = 1.0
        most = np.abs(x).max(axis=1).astype(np.float64)
        logs = np.log(most) + np.log(np.linalg.norm(x.astype(np.float64) / most[:, None], axis=1))
        data = (x + 0.0).astype(number).tobytes()                                          # -0.0 is 0.0
        ends = np.arange(len(x) + 1, dtype=np.int32) * (len(data) // len(x))
        vecs = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
        return pc.if_else(pa.array(ok), vecs, pa.scalar(None, pa.binary())), sizes, logs

    def run(batches):
        for batch in batches:
            if (found := whole(batch)) is not None:
                vecs, sizes, logs = found
                yield pa.RecordBatch.from_arrays([batch.column("id"), vecs, pa.array(sizes, pa.int32()), pa.array(logs), batch.column("asked")],
                                                 names=["id", "vec", "size", "log", "asked"])
                continue
            vecs, logs, sizes = [], [], []
            for v in batch.column("v").to_pylist():
                x = np.asarray(v, dtype=number) if v is not None and None not in v else np.zeros(0)
                ok = len(x) and np.isfinite(x).all() and x.any()
                most = float(np.abs(x).max()) if ok else 1.0
                vecs.append((x + 0.0).astype(number).tobytes() if ok else None)       # -0.0 is 0.0
                logs.append(float(np.log(most) + np.log(np.linalg.norm(x.astype(np.float64) / most))) if ok else 0.0)
                sizes.append(len(x))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(vecs, pa.binary()), pa.array(sizes, pa.int32()), pa.array(logs, pa.float64()),
                                              batch.column("asked")], names=["id", "vec", "size", "log", "asked"])

    kind = dict(df.dtypes)[key]
    rows = df.selectExpr(f"`{key}` as id", f"coalesce({queries}, false) as asked", f"`{vector}` as v").where("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.mapInArrow(run, f"id {kind}, vec binary, size int, log double, asked boolean").where("vec IS NOT NULL")
    return rows.groupBy("id", "vec").agg(F.max("asked").alias("asked"), F.max("size").alias("size"), F.max("log").alias("log")), number


def padded(vecs, number: str, size: int) -> np.ndarray:
    """Vectors as rows of doubles, filled up with zeros."""
    width = np.dtype(number).itemsize * size
    if all(len(v) == width for v in vecs):
        return np.frombuffer(b"".join(vecs), dtype=number).reshape(len(vecs), size).astype(np.float64)
    return np.stack([np.pad(x, (0, size - len(x))) for x in (np.frombuffer(v, dtype=number).astype(np.float64) for v in vecs)])


def unit_codes(x: np.ndarray, logs: np.ndarray, longest: float) -> np.ndarray:
    """Unit vectors in half precision, one component longer."""
    length = np.exp(logs - longest)
    most = np.abs(x).max(axis=1, keepdims=True)
    y = x / most
    y *= (length / np.linalg.norm(y, axis=1))[:, None]
    rest = np.sqrt(np.maximum(0.0, 1 - length ** 2))
    return np.concatenate([y, rest[:, None]], axis=1).astype("<f2")


# --------------------------------------------------------------------- packets
#: What goes between tasks: arrays of many nodes, links or scores in one row.  ``to``
#: names the bucket, shelf, group or part of queries that gets it, ``kind`` says what
#: it is (0: what is at home there).
_FIELDS = ("a", "b", "c", "d", "e", "f")
_PACKET = "to bigint, kind int, src bigint, " + ", ".join(f"{c} binary" for c in _FIELDS)
_ARROW = pa.schema([("to", pa.int64()), ("kind", pa.int32()), ("src", pa.int64()), *((c, pa.binary()) for c in _FIELDS)])


def _order(by: np.ndarray) -> np.ndarray:
    """What sorts whole numbers, equal ones in order; few of them by their digits."""
    if len(by) and (low := by.min()) > by.max() - 65_536:
        by = (by - low).astype(np.uint16)
    return np.argsort(by, kind="stable")


def _array(value, dtype) -> np.ndarray:
    buf = value.as_buffer() if value is not None else None
    return np.frombuffer(buf, dtype=dtype) if buf is not None and buf.size else np.zeros(0, dtype)


class _Out:
    """Packets on their way out, in batches of some megabytes."""

    def __init__(self):
        self.rows, self.bytes = [], 0

    def put(self, to, kind, src, *arrays) -> None:
        cells = [np.ascontiguousarray(x).tobytes() for x in arrays]
        self.rows.append((int(to), int(kind), int(src), *cells, *[None] * (len(_FIELDS) - len(cells))))
        self.bytes += sum(map(len, cells))

    def deal(self, to, kind, src, *arrays) -> None:
        """One packet for each different ``to``, with its elements of the arrays in order."""
        order = _order(to)
        ends = to[order]
        edges = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1], [True]])) if len(ends) else [0]
        arrays = [x[order] for x in arrays]
        for a, b in zip(edges, edges[1:]):
            self.put(ends[a], kind, src, *[x[a:b] for x in arrays])

    def full(self, limit: int = _BATCH):
        if self.bytes > limit or limit == 0 and self.rows:
            rows, self.rows, self.bytes = self.rows, [], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def _packets(batches):
    """``(to, kind, src, fields)`` of every row."""
    for batch in batches:
        columns = [batch.column(c) for c in _FIELDS]
        for i, (to, kind, src) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("to", "kind", "src")))):
            yield to, kind, src, [c[i] if c[i].is_valid else None for c in columns]


def _each(step):
    """``step(to, packets, out)`` for all packets of each ``to``."""
    def run(batches):
        import itertools

        out = _Out()
        for to, group in itertools.groupby(_packets(batches), key=lambda p: p[0]):
            for _ in step(to, (p[1:] for p in group), out) or ():
                yield from out.full()
            yield from out.full()
        yield from out.full(0)
    return run


def _arrived(packets: DataFrame, places: int) -> DataFrame:
    """The packets in order where they arrive, for so many different ``to``: where
    these are few, so are the tasks."""
    return dealt(packets, ["to"]).coalesce(2 * places).sortWithinPartitions("to", "kind", "src")


def _sent(packets: DataFrame, step, places: int) -> DataFrame:
    """``step`` where the packets arrive."""
    return _arrived(packets, places).mapInArrow(_each(step), _PACKET)


def _here(packets: DataFrame, step) -> DataFrame:
    """``step(packets, out)`` where the packets are."""
    def run(batches):
        out = _Out()
        for _ in step(_packets(batches), out):
            yield from out.full()
        yield from out.full(0)
    return packets.mapInArrow(run, _PACKET)


# ------------------------------------------------------------- lists of links
def _runs(v: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the end."""
    return np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1], [True]])) if len(v) else np.zeros(1, np.int64)


def _best(v, u, s, old, k: int):
    """The ``k`` best links of every ``v``, each once; a link that was there before
    is not new."""
    o = np.lexsort((~old, u, v))
    v, u, s, old = v[o], u[o], s[o], old[o]
    once = np.ones(len(v), dtype=bool)
    once[1:] = (v[1:] != v[:-1]) | (u[1:] != u[:-1])
    v, u, s, old = v[once], u[once], s[once], old[once]
    o = np.lexsort((u, -s, v))
    v, u, s, old = v[o], u[o], s[o], old[o]
    edges = _runs(v)
    keep = np.arange(len(v)) - np.repeat(edges[:-1], np.diff(edges)) < k
    return v[keep], u[keep], s[keep], old[keep]


def _merged(links: DataFrame, k: int, z: _Sizes) -> DataFrame:
    """The graph of the ``k`` best links of each node: a packet per bucket with the
    number of links of each of its nodes, the neighbours, best first, their inner
    products, and which links are old; ``src`` counts the new ones.  Packets of links
    hold nodes, neighbours and inner products; those of kind 0 are a graph, whose
    links are old."""
    size = z.bucket

    def step(to, packets, out):
        parts = []
        for kind, _, (a, b, c, *_) in packets:
            u, s = _array(b, np.int64), _array(c, np.float32)
            v = np.repeat(np.arange(to * size, (to + 1) * size), _array(a, np.int32)) if kind == 0 else _array(a, np.int64)
            parts.append((v, u, s, np.full(len(u), kind == 0)))
        v, u, s, old = _best(*(np.concatenate(c) for c in zip(*parts)), k)
        links = np.bincount(v - to * size, minlength=size).astype(np.int32)
        out.put(to, 0, len(old) - np.count_nonzero(old), links, u, s, old)

    return _sent(links, step, z.buckets)


def _emitted(out: _Out, size: int, kind: int, src: int, v, u, s) -> None:
    """Links on their way to the buckets of their nodes."""
    out.deal(v // size, kind, src, v, u, s)


def _packed(rows: DataFrame, places: int, named: bool = True) -> DataFrame:
    """A packet for each of the ``places`` ``to`` of ``(to, node, code)``: its nodes, in order (if
    ``named``), and their vectors."""
    def run(batches):
        held, now, out = [], None, _Out()

        def put():
            ids, codes = (np.concatenate(c) for c in zip(*held))
            out.put(now, 0, 0, *([ids] if named else []), codes)

        for batch in batches:
            codes = batch.column("code")
            width = len(codes[0].as_py()) if len(codes) else 0
            nodes, codes = batch.column("node").to_numpy(), np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(-1, width) if width else None
            for to, ids, x in _grouped(batch.column("to").to_numpy(), nodes, codes) if width else ():
                if held and to != now:
                    put()
                    held = []
                now = to
                held.append((ids, x))
            yield from out.full()
        if held:
            put()
        yield from out.full(0)

    return dealt(rows.select("to", "node", "code"), ["to"]).coalesce(2 * places).sortWithinPartitions("to", "node").mapInArrow(run, _PACKET)


class _Sizes:
    """How the nodes, which are numbered without gaps, are dealt: into buckets of
    ``bucket`` nodes, and these into ``shelves`` of ``shelf`` nodes."""

    def __init__(self, n: int):
        self.n, self.bucket = n, BUCKET
        most = max(1, CENTRES // BUCKET)
        self.shelf = BUCKET * min(most, max(1, -(-n // (BUCKET * TASKS))))
        self.shelves = -(-n // self.shelf)
        self.buckets = -(-n // BUCKET)


# ------------------------------------------------------------------ NN-descent
def _start(codes: DataFrame, pivots: np.ndarray, z: _Sizes, size: int) -> DataFrame:
    """Best links within groups: nodes with the same nearest pivot, dealt at random
    where these are many."""
    turns = len(pivots)
    each = DEGREE if z.n <= GROUP else DEGREE // 2
    bucket, n, crowd = z.bucket, z.n, GROUP

    def cells(batches):
        """Nodes of each cell, counted; the nearest pivots are found anew when they
        are dealt, which costs less than keeping them."""
        counts = np.zeros(pivots.shape[:2], np.int64)
        for _, _, _, (a, *_) in _packets(batches):
            x = _coded(a, size)
            for t in range(turns):
                counts[t] += np.bincount((x @ pivots[t].T).argmax(axis=1), minlength=counts.shape[1])
        t, c = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(t * counts.shape[1] + c), pa.array(counts[t, c])], names=["cell", "n"])

    slots = np.ones(turns * pivots.shape[1], np.int64)
    for cell, count in codes.mapInArrow(cells, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect():
        slots[cell] = -(-count // crowd)
    first = np.concatenate([[0], np.cumsum(slots)])

    def deal(packets, out):
        held, n_held = [], 0

        def flush():
            group, ids, x = (np.concatenate(c) for c in zip(*held))
            out.deal(group, 0, ids[0], ids, x)

        for to, _, _, (a, *_) in packets:
            half = _halved(a, size)
            x, ids = half.astype(np.float32), to * bucket + np.arange(len(half))
            for t in range(turns):
                cell = t * pivots.shape[1] + (x @ pivots[t].T).argmax(axis=1)
                held.append((first[cell] + (_mixed(ids, t) % slots[cell].astype(np.uint64)).astype(np.int64), ids, half))
                n_held += len(ids)
            if n_held > _HELD // 32:
                flush()
                held, n_held = [], 0
                yield
        if held:
            flush()
            yield

    def join(batches):
        import itertools

        out, held, n_held = _Out(), [], 0
        for group, packets in itertools.groupby(_packets(batches), key=lambda p: p[0]):
            parts = [(_array(f[0], np.int64), _halved(f[1], size)) for _, _, _, f in packets]
            ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.float32)
            m, k = len(ids), min(each, len(ids) - 1)
            for at in range(0, m if k > 0 else 0, 512):
                s = x[at:at + 512] @ x.T
                here = np.arange(len(s))
                s[here, at + here] = -np.inf
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                held.append((np.repeat(ids[at:at + 512], k), ids[top].ravel(), np.take_along_axis(s, top, 1).ravel()))
                n_held += top.size
            if n_held > _HELD:
                _emitted(out, bucket, 1, group, *(np.concatenate(c) for c in zip(*held)))
                held, n_held = [], 0
                yield from out.full()
        if held:
            _emitted(out, bucket, 1, 0, *(np.concatenate(c) for c in zip(*held)))
        yield from out.full(0)

    groups = _arrived(_here(codes, deal), int(first[-1])).mapInArrow(join, _PACKET)
    # Every bucket has a row of its own, also where its nodes have no links.
    none = codes.select("to", F.lit(1).alias("kind"), F.lit(-1).cast("bigint").alias("src"), *[F.lit(None).cast("binary").alias(c) for c in _FIELDS])
    return _merged(groups.unionByName(none), DEGREE, z)


def _mixed(ids: np.ndarray, salt) -> np.ndarray:
    """Hashes (splitmix64)."""
    h = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * (np.atleast_1d(salt).astype(np.uint64) + np.uint64(1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _halved(value, size: int) -> np.ndarray:
    return _array(value, "<f2").reshape(-1, size + 1)


def _coded(value, size: int) -> np.ndarray:
    return _halved(value, size).astype(np.float32)


def _crowded(graph: DataFrame, z: _Sizes) -> DataFrame:
    """``(centre, slots)`` of the hubs: nodes whose backward neighbours fill more than
    one slot.  Tasks report nodes that have a share of a slot's links or more with them,
    so what is not reported is less than one more slot."""
    least, shelf, bucket = max(1, CROWD // (2 * z.shelves)), z.shelf, z.bucket

    def count(batches):
        held, n_held = [], 0

        def flush():
            node, links = np.unique(np.concatenate(held), return_counts=True)
            many = links >= least
            return pa.RecordBatch.from_arrays([pa.array(node[many]), pa.array(links[many])], names=["centre", "links"])

        for _, _, _, (_, b, *_) in _packets(batches):
            held.append(_array(b, np.int64))
            n_held += bucket
            if n_held >= shelf:
                yield flush()
                held, n_held = [], 0
        if held:
            yield flush()

    many = graph.mapInArrow(count, "centre bigint, links bigint").groupBy("centre").agg(F.sum("links").alias("links"))
    return many.select("centre", F.ceil(F.col("links") / CROWD).cast("bigint").alias("slots")).where("slots > 1")


def _round(graph: DataFrame, codes: DataFrame, z: _Sizes, size: int) -> DataFrame:
    """The graph after one join of neighbours of neighbours."""
    bucket, shelf, shelves, shelf_buckets = z.bucket, z.shelf, z.shelves, z.shelf // z.bucket
    hubs = cut_lineage(_crowded(graph, z))
    at = graph
    if not hubs.isEmpty():
        # Hubs go to all shelves that may have links to them.
        cell = F.struct("centre", "slots")
        lists = hubs.groupBy(F.floor(F.col("centre") / shelf).alias("src")).agg(F.sort_array(F.collect_list(cell)).alias("hubs"))
        rows = lists.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1)).cast("array<bigint>"))).select("to", "src", F.inline("hubs"))
        rows = rows.mapInArrow(_hub_packets, _PACKET)
        mine = graph.withColumn("f", F.lit(None).cast("binary")).withColumn("kind", F.lit(1)).withColumn("src", F.col("to"))
        mine = mine.withColumn("to", F.floor(F.col("to") / shelf_buckets))
        at = _arrived(rows.unionByName(mine), shelves)
    has_hubs = at is not graph

    def links_of(packets):
        """Links of some buckets at a time, each as ``(node, neighbour, old)``, the
        buckets with the worst links of their nodes, and the hubs."""
        hub, slots, shelf_now, held, n_held = [], [], None, [], 0
        for to, kind, src, (a, b, c, d, *_) in packets:
            if has_hubs and to != shelf_now:
                if held:
                    yield held, hub, slots
                hub, slots, shelf_now, held, n_held = [], [], to, [], 0
            if has_hubs and kind == 0:
                hub.append(_array(a, np.int64))
                slots.append(_array(b, np.int64))
                continue
            at = src if has_hubs else to
            links = _array(a, np.int32)
            held.append((at, links, _array(b, np.int64), _array(c, np.float32), _array(d, np.bool_)))
            n_held += len(links)
            if n_held >= shelf:
                yield held, hub, slots
                held, n_held = [], 0
        if held:
            yield held, hub, slots

    def pairs_of(held, hub, slots):
        """``(shelf, centre, slot, member, old)``: who is whose neighbour, in either
        direction, and the shelf that joins them."""
        v = np.concatenate([np.repeat(at * bucket + np.arange(len(links)), links) for at, links, *_ in held])
        u, old = np.concatenate([h[2] for h in held]), np.concatenate([h[4] for h in held])
        hub, slots = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (hub, slots))
        by = np.argsort(hub)
        hub, slots = hub[by], slots[by]

        def many(centre):
            out = np.ones(len(centre), np.int64)
            if len(hub):
                i = np.minimum(np.searchsorted(hub, centre), len(hub) - 1)
                out = np.where(hub[i] == centre, slots[i], out)
            return out

        # Forward neighbours are in every slot, a backward one is in one.
        copies = many(v)
        centre, member, flag = (np.repeat(c, copies) for c in (v, u, old))
        slot = np.arange(len(centre)) - np.repeat(np.cumsum(copies) - copies, copies)
        own = (_mixed(v, 7) % many(u).astype(np.uint64)).astype(np.int64)
        centre, member, flag, slot = np.concatenate([centre, u]), np.concatenate([member, v]), np.concatenate([flag, old]), np.concatenate([slot, own])
        other = (_mixed(centre, slot) % np.uint64(shelves)).astype(np.int64)
        return np.where(slot == 0, centre // shelf, other), centre, slot, member, flag

    def send_pairs(packets, out):
        for held, hub, slots in links_of(packets):
            part, centre, slot, member, old = pairs_of(held, hub, slots)
            out.deal(part, 1, held[0][0], centre, slot.astype(np.int32), member, old)
            yield

    def send_asks(packets, out):
        for held, hub, slots in links_of(packets):
            for at, links, _, s, _ in held:
                # The worst link of a full list is what a candidate has to beat.
                worst, full = np.full(len(links), -np.inf, np.float32), links == DEGREE
                worst[full] = s[np.cumsum(links)[full] - 1]
                out.put(at, 1, 0, worst)
            part, _, _, member, _ = pairs_of(held, hub, slots)
            for p, group in _grouped(part, member):
                group = np.unique(group)
                edges = _runs(group // bucket)
                for a, b in zip(edges, edges[1:]):
                    out.put(group[a] // bucket, 2, p, group[a:b])
            yield

    def reply(to, packets, out):
        x = worst = None
        asks: dict = {}
        for kind, src, (a, *_) in packets:
            if kind == 0:
                x = _halved(a, size)
            elif kind == 1:
                worst = _array(a, np.float32)
            else:
                asks.setdefault(src, []).append(_array(a, np.int64))
            if kind == 2 and len(asks) > 1:                # all of the shelf before are here
                done = next(iter(asks))
                answer(to, done, asks.pop(done), x, worst, out)
                yield
        for src, ids in asks.items():
            answer(to, src, ids, x, worst, out)
            yield

    def answer(to, src, ids, x, worst, out):
        ids = np.unique(np.concatenate(ids)) if len(ids) > 1 else ids[0]
        at = ids - to * bucket
        out.put(src, 0, to, ids, x[at], worst[at])

    def join(to, packets, out):
        known, pairs = [], []
        for kind, _, (a, b, c, d, *_) in packets:
            if kind == 0:
                known.append((_array(a, np.int64), _halved(b, size), _array(c, np.float32)))
            else:
                pairs.append((_array(a, np.int64), _array(b, np.int32), _array(c, np.int64), _array(d, np.bool_)))
        if not pairs:
            return
        ids, x, worst = (np.concatenate(c) for c in zip(*known))          # by bucket, so in order
        known.clear()
        v, u, s = _Join(ids, x, worst).run(*(np.concatenate(c) for c in zip(*pairs)))
        for a in range(0, len(v), _HELD):
            _emitted(out, bucket, 1, to, v[a:a + _HELD], u[a:a + _HELD], s[a:a + _HELD])
            yield

    wanted = codes.unionByName(_here(at, send_asks))
    replies = _sent(wanted, reply, z.buckets)
    found = _sent(replies.unionByName(_here(at, send_pairs)), join, shelves)
    return _merged(graph.unionByName(found), DEGREE, z)


def _grouped(by, *arrays):
    """``(value, *elements)`` for each different value of ``by``."""
    order = _order(by)
    by, arrays = by[order], [x[order] for x in arrays]
    edges = _runs(by)
    for a, b in zip(edges, edges[1:]):
        yield (by[a], *[x[a:b] for x in arrays])


def _hub_packets(batches):
    out = _Out()
    for batch in batches:
        to, src, centre, slots = (batch.column(c).to_numpy() for c in ("to", "src", "centre", "slots"))
        for t, a, b, c in _grouped(to, src, centre, slots):
            out.put(t, 0, a[0], b, c)
        yield from out.full()
    yield from out.full(0)


class _Join:
    """Neighbours of neighbours on one shelf: ``ids`` are the nodes that it needs, in
    order, ``x`` their vectors in half precision and ``worst`` what they have to beat."""

    def __init__(self, ids, x, worst):
        self.ids = ids
        self.x = np.concatenate([x, np.zeros((1, x.shape[1]), x.dtype)])         # the last one fills up
        self.worst = np.concatenate([worst, np.full(1, np.inf, np.float32)])
        # A candidate is one number: node, inner product (largest first), neighbour.
        self.bits = np.uint64(max(1, int(len(ids)).bit_length()))
        self.steps = np.float32(2 ** min(23, 64 - 2 * int(self.bits)) - 1)
        self.held: list = []
        self.n = 0

    def run(self, centre, slot, member, old):
        """``(node, neighbour, inner product)`` of the best candidates of each node."""
        member = np.searchsorted(self.ids, member).astype(np.uint64)
        group = self._groups(centre, slot)
        del centre, slot
        # A member from both ends is new if either link is; new ones first.
        key = (group << self.bits | member) << np.uint64(1) | old.astype(np.uint64)
        del member
        key.sort()
        once = np.ones(len(key), dtype=bool)
        once[1:] = key[1:] >> np.uint64(1) != key[:-1] >> np.uint64(1)
        key = key[once]
        group, member, old = key >> (self.bits + np.uint64(1)), (key >> np.uint64(1)) & ((np.uint64(1) << self.bits) - np.uint64(1)), key & np.uint64(1)
        key = (group << np.uint64(1) | old) << self.bits | member
        key.sort()
        group, member, old = key >> (self.bits + np.uint64(1)), (key & ((np.uint64(1) << self.bits) - np.uint64(1))).astype(np.int32), (key >> self.bits) & np.uint64(1)
        del key
        edges = _runs(group)
        begin, members = edges[:-1], np.diff(edges)
        new = members - np.add.reduceat(old.astype(np.int64), begin)
        some = np.flatnonzero((new > 0) & (members > 1))
        some = some[np.lexsort((members[some], new[some] // 12))]
        at = 0
        while at < len(some):
            # Groups of about the same size at once.
            size = max(1, min(len(some) - at, _CELLS // int(members[some[at]] ** 2)))
            while size > 1 and size * int(members[some[at:at + size]].max()) * int(new[some[at:at + size]].max()) > 2 * _CELLS:
                size //= 2
            self._centres(member, begin[some[at:at + size]], members[some[at:at + size]], new[some[at:at + size]])
            at += size
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        v, u, s = self._trim()
        return self.ids[v], self.ids[u], s

    def _groups(self, centre, slot):
        """Numbers of the groups, by centre and slot."""
        _, first = np.unique(centre, return_inverse=True)
        if slot.any():
            _, first = np.unique(first.astype(np.int64) * (int(slot.max()) + 1) + slot, return_inverse=True)
        return first.astype(np.uint64)

    def _centres(self, member, begin, members, new) -> None:
        rows, most = int(new.max()), int(members.max())
        at = np.arange(most)
        place = np.where(at < members[:, None], member[np.minimum(begin[:, None] + at, len(member) - 1)], len(self.ids))
        x, worst = self.x[place].astype(np.float32), self.worst[place]
        s = x[:, :rows] @ x.transpose(0, 2, 1)
        better = s > np.minimum(worst[:, :rows, None], worst[:, None, :])
        better &= at > np.arange(rows)[:, None]             # each pair of new ones once
        better &= (np.arange(rows) < new[:, None])[:, :, None]
        better &= (at < members[:, None])[:, None, :]
        hit = np.flatnonzero(better)
        i, j = np.divmod(hit, most)
        g = i // rows
        p, q, s = place.ravel()[g * most + i - g * rows], place.ravel()[g * most + j], s.ravel()[hit]
        code = np.clip((np.float32(1.001) - s) * (self.steps / np.float32(2.002)), 0, self.steps).astype(np.uint64)
        for a, b in ((p, q), (q, p)):
            ok = s > self.worst[a]
            if ok.any():
                self.held.append((a[ok].astype(np.uint64) << (np.uint64(64) - self.bits)) | code[ok] << self.bits | b[ok].astype(np.uint64))
                self.n += len(self.held[-1])
        if self.n > _HELD:
            v, _, s = self._trim()
            # What a node found here is a bar for its next candidates, too.
            edges = _runs(v)
            full = np.diff(edges) == DEGREE
            self.worst[v[edges[:-1][full]]] = np.maximum(self.worst[v[edges[:-1][full]]], s[edges[1:][full] - 1])

    def _trim(self):
        """Keeps the best of each node, each once."""
        key = np.concatenate(self.held)
        key.sort()
        once = np.ones(len(key), dtype=bool)
        once[1:] = key[1:] != key[:-1]
        key = key[once]
        v = (key >> (np.uint64(64) - self.bits)).astype(np.int64)
        edges = _runs(v)
        key = key[np.arange(len(v)) - np.repeat(edges[:-1], np.diff(edges)) < DEGREE]
        self.held, self.n = [key], 0
        mask = (np.uint64(1) << self.bits) - np.uint64(1)
        code = (key >> self.bits) & ((np.uint64(1) << (np.uint64(64) - np.uint64(2) * self.bits)) - np.uint64(1))
        s = np.float32(1.001) - code.astype(np.float32) * (np.float32(2.002) / self.steps)
        return (key >> (np.uint64(64) - self.bits)).astype(np.int64), (key & mask).astype(np.int64), s


def build(codes: DataFrame, pivots: np.ndarray, z: _Sizes, size: int) -> DataFrame:
    """The neighbour graph of the nodes, whose vectors are in packets by bucket."""
    graph = cut_lineage(_start(codes, pivots, z, size))
    if z.n <= GROUP:
        return graph                                    # one group: all pairs were compared
    for _ in range(ROUNDS):
        graph = cut_lineage(_round(graph, codes, z, size))
        links, new = graph.agg(F.sum(F.length("b") / 8), F.sum("src")).first()
        if new <= FEW * links:
            break
    return graph


# ---------------------------------------------------------------------- search
def _around(graph: DataFrame, z: _Sizes) -> DataFrame:
    """The neighbours that a search steps to, of either direction, as a graph."""
    bucket = z.bucket

    def back(packets, out):
        held, n_held = [], 0

        def flush():
            # A hub's best only, cut down on every task.
            u, v, s = (np.concatenate(c) for c in zip(*held))
            _emitted(out, bucket, 1, v[0] if len(v) else 0, *_best(v, u, s, np.zeros(len(v), dtype=bool), 2 * DEGREE)[:3])

        for to, _, _, (a, b, c, *_) in packets:
            links = _array(a, np.int32)
            held.append((np.repeat(to * bucket + np.arange(len(links)), links), _array(b, np.int64), _array(c, np.float32)))
            n_held += len(held[-1][0])
            if n_held > _HELD:
                flush()
                held, n_held = [], 0
                yield
        if held:
            flush()
            yield

    return _merged(graph.unionByName(_here(graph, back)), 2 * DEGREE, z)


def search(graph: DataFrame, codes: DataFrame, queries: DataFrame, parts: int, entries: np.ndarray, z: _Sizes, size: int, beam: int = BEAM) -> DataFrame:
    """``(q, ids)``: the nodes that a greedy search from each node ``q`` of
    ``queries`` (nodes and their vectors, in packets for ``parts`` parts) finds, largest inner product first."""
    around = cut_lineage(_around(graph, z))
    shelf_buckets = z.shelf // z.bucket
    shelved = codes.withColumn("src", F.col("to")).withColumn("to", F.floor(F.col("to") / shelf_buckets))
    state, first = queries, True
    while True:
        state, first = cut_lineage(_expand(state, parts, around, shelved, entries if first else entries[:0], z, size, beam)), False
        if not state.agg(F.sum("src")).first()[0]:
            break

    def found(batches):
        for _, _, _, (a, _, c, d, *_) in _packets(batches):
            q, ids = _array(a, np.int64), _array(d, np.int64)
            ends = np.concatenate([[0], np.cumsum(_array(c, np.int32))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], names=["q", "ids"])

    return state.mapInArrow(found, "q bigint, ids array<bigint>")


class _State:
    """The beams of one part of the queries: nodes, vectors, and for each query how
    many nodes it holds, these, their inner products, and how far each is (0: found,
    1: to be expanded now, 2: expanded)."""

    def __init__(self, fields, size: int):
        a, b, c, d, e, f = fields
        self.q, self.codes = _array(a, np.int64), _halved(b, size)
        self.links = _array(c, np.int32)
        self.ids, self.sims, self.done = _array(d, np.int64), _array(e, np.float32), _array(f, np.uint8)
        if f is None:                                      # before the first step: the query itself, to be expanded
            x = self.codes[:, :-1].astype(np.float32)
            self.links, self.ids = np.ones(len(self.q), np.int32), self.q
            self.sims, self.done = np.einsum("ij,ij->i", x, x), np.ones(len(self.q), np.uint8)
        self.of = np.repeat(np.arange(len(self.q)), self.links)


def _expand(state: DataFrame, parts: int, around: DataFrame, shelved: DataFrame, entries: np.ndarray, z: _Sizes, size: int, beam: int) -> DataFrame:
    """Scores the neighbours of the nodes to be expanded (and the entries) and keeps the best ``beam`` of
    each query; the first ``STEP`` of them not yet expanded are its next.  Vectors of
    queries go to the shelves of the nodes that they ask for, and inner products come back."""
    bucket, shelf = z.bucket, z.shelf

    def fronts(packets, out):
        for part, _, _, fields in packets:
            s = _State(fields, size)
            now = s.done == 1
            of, ids = s.of[now], s.ids[now]
            out.deal(ids // bucket, 1, part, of.astype(np.int32), ids)
            yield

    def step_to(to, packets, out):
        for kind, src, (a, b, *_) in packets:
            if kind == 0:
                links, nbr = _array(a, np.int32).astype(np.int64), _array(b, np.int64)
                begin = np.cumsum(links) - links
            else:
                of, at = _array(a, np.int32), _array(b, np.int64) - to * bucket
                out.put(src, 1, to, np.repeat(of, links[at]), nbr[gather_runs(begin[at], links[at])])
                yield

    def ask(part, packets, out):
        s, asked = None, []
        for kind, _, fields in packets:
            if kind == 0:
                s = _State(fields, size)
            else:
                asked.append((_array(fields[0], np.int32), _array(fields[1], np.int64)))
        of, ids = (np.concatenate(c) for c in zip(*asked)) if asked else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        if len(entries):
            of, ids = np.concatenate([of, np.repeat(np.arange(len(s.q)), len(entries))]), np.concatenate([ids, np.tile(entries, len(s.q))])
        of, ids = _pairs_left(of, ids, s.of, s.ids)
        # What does not beat the worst of a full beam need not come back.
        bar, full = np.full(len(s.q), -np.inf, np.float32), s.links == beam
        bar[full] = s.sims[np.cumsum(s.links)[full] - 1]
        for to, of, ids in _grouped(ids // shelf, of, ids):
            edges = _runs(of)
            some, at = of[edges[:-1]], np.repeat(np.arange(len(edges) - 1, dtype=np.int32), np.diff(edges))
            out.put(to, 1, part, some.astype(np.int32), s.codes[some], bar[some], at, ids)
        return ()

    def score(to, packets, out):
        table = []
        for kind, src, (a, b, c, d, e, _) in packets:
            if kind == 0:
                table.append(_halved(a, size)[:, :-1].astype(np.float32))
                continue
            if len(table) > 1:
                table = [np.concatenate(table)]
            # Without the additional component this is the inner product, scaled.
            some, y, bar = _array(a, np.int32), _halved(b, size)[:, :-1].astype(np.float32), _array(c, np.float32)
            at, ids = _array(d, np.int32), _array(e, np.int64)
            sims = np.concatenate([np.einsum("ij,ij->i", table[0][ids[i:i + 4096] - to * shelf], y[at[i:i + 4096]]) for i in range(0, len(ids), 4096)])
            good = sims > bar[at]
            out.put(src, 1, to, some[at[good]], ids[good], sims[good])
            yield

    def keep(part, packets, out):
        s, got = None, []
        for kind, _, fields in packets:
            if kind == 0:
                s = _State(fields, size)
            else:
                got.append(tuple(_array(x, t) for x, t in zip(fields, (np.int32, np.int64, np.float32))))
        of, ids, sims = (np.concatenate(c) for c in zip((s.of, s.ids, s.sims), *got))
        done = np.concatenate([np.where(s.done == 1, 2, s.done), np.zeros(len(ids) - len(s.ids))]).astype(np.uint8)
        order = np.lexsort((ids, -sims, of))
        edges = _runs(of[order])
        order = order[np.arange(len(order)) - np.repeat(edges[:-1], np.diff(edges)) < beam]
        of, ids, sims, done = of[order], ids[order], sims[order], done[order]
        # The first ones left are next.
        left = np.flatnonzero(done == 0)
        edges = _runs(of[left])
        now = left[np.arange(len(left)) - np.repeat(edges[:-1], np.diff(edges)) < STEP]
        done[now] = 1
        out.put(part, 0, len(now), s.q, s.codes, np.bincount(of, minlength=len(s.q)).astype(np.int32), ids, sims.astype(np.float32), done)
        return ()

    steps = _sent(around.unionByName(_here(state, fronts)), step_to, z.buckets)
    asks = _sent(state.unionByName(steps), ask, parts)
    scores = _sent(shelved.unionByName(asks), score, z.shelves)
    return _sent(state.unionByName(scores), keep, parts)


def _pairs_left(of, ids, had_of, had_ids):
    """The different pairs that were not there before, in order."""
    key, had = (a.astype(np.int64) << 44 | b for a, b in ((of, ids), (had_of, had_ids)))
    key.sort()
    key = key[_runs(key)[:-1]]
    if len(had):
        had.sort()
        key = key[had[np.minimum(np.searchsorted(had, key), len(had) - 1)] != key]
    return key >> 44, key & ((1 << 44) - 1)


def _numbered(nodes: DataFrame) -> DataFrame:
    """Nodes numbered without gaps; their numbers are unique and increase by one in
    each partition."""
    part = F.shiftright("node", 33)
    counts = dict(tuple(r) for r in nodes.groupBy(part).count().collect())
    first, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        first.append(total)
        total += counts.get(p, 0)
    at = F.get(F.lit(first).cast("array<bigint>"), part.cast("int"))
    return nodes.withColumn("node", at + F.col("node").bitwiseAND(F.lit((1 << 33) - 1).cast("bigint")))


def _pivots(nodes: DataFrame, z: _Sizes, size: int) -> np.ndarray:
    """For each turn of the start the vectors of some nodes, at most ``PIVOTS``."""
    turns = STARTS if z.n > GROUP else 1
    each = max(1, min(PIVOTS, 2 * z.n // GROUP)) if turns > 1 else 1
    rows = nodes.select("code", F.xxhash64("node").alias("h"), "node").orderBy("h", "node").limit(turns * each).collect()
    x = np.frombuffer(b"".join(r["code"] for r in rows), "<f2").reshape(-1, size + 1)
    return x[np.arange(turns * each) % len(x)].reshape(turns, each, size + 1).astype(np.float32)


def nearest(df: DataFrame, queries: str, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, key, score)``: for each row that the SQL condition
    ``queries`` selects its ``k`` nearest other rows found."""
    spark, kind = df.sparkSession, dict(df.dtypes)[key]
    rows, number = _rows(df, queries, key, vector)
    rows = cut_lineage(rows)
    size, longest = rows.agg(F.max("size"), F.max("log")).first()
    if size is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, `{key}` {kind}, score double")
    # A node's rows beyond the first k + 1 can't be among the k nearest of any other.
    first = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    kept = rows.select("vec", "id", "log", first.alias("r")).where(F.col("r") <= k + 1)
    classes = kept.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.max("log").alias("log"))
    coded = classes.select(F.monotonically_increasing_id().alias("node"), "vec", "ids", "log")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = padded(batch.column("vec").to_pylist(), number, size)
                code = unit_codes(x, batch.column("log").to_numpy(), longest)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in code], pa.binary())], names=[*batch.schema.names, "code"])

    nodes = _numbered(cut_lineage(coded.mapInArrow(run, f"node bigint, vec binary, ids array<{kind}>, log double, code binary")))
    asking = cut_lineage(rows.where("asked").select("vec", F.col("id").alias("query_id")).join(nodes.select("vec", "node", "code"), "vec")
                         .select("query_id", F.col("node").alias("q"), "code"))
    points = cut_lineage(asking.groupBy("q").agg(F.first("code").alias("code")))
    z, nq = _Sizes(nodes.count()), points.count()
    parts = max(1, -(-nq // QUERIES), min(TASKS, nq // 64))
    codes = cut_lineage(_packed(nodes.select(F.floor(F.col("node") / z.bucket).alias("to"), "node", "code"), z.buckets, named=False))
    asked = cut_lineage(_packed(points.select(F.pmod(F.xxhash64("q"), F.lit(parts)).alias("to"), F.col("q").alias("node"), "code"), parts))
    # A bounded number of common entries.
    entries = sorted({r[0] for by in (F.xxhash64("node"), F.col("log").desc())
                      for r in nodes.select("node", "log").orderBy(by, "node").limit(ENTRIES).collect()})
    graph = build(codes, _pivots(nodes, z, size), z, size)
    found = search(graph, codes, asked, parts, np.array(entries, dtype=np.int64), z, size, max(BEAM, 2 * (k + 1)))
    return _answers(found, nodes, asking, k, number, size, key, kind)


def _answers(found: DataFrame, nodes: DataFrame, asking: DataFrame, k: int, number: str, size: int, key: str, kind: str) -> DataFrame:
    """The best of the nodes found, by exact score, as rows."""
    near = found.select("q", F.explode(F.slice("ids", 1, 2 * (k + 1))).alias("node"))
    near = near.unionByName(found.select("q", F.col("q").alias("node"))).distinct().withColumn("own", F.col("q") == F.col("node"))
    near = near.join(nodes.select("node", "vec", "ids"), "node").join(nodes.select(F.col("node").alias("q"), F.col("vec").alias("of")), "q")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (padded(batch.column(c).to_pylist(), number, size) for c in ("vec", "of"))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("q", "own", "ids")), pa.array(np.einsum("ij,ij->i", x, y))],
                                                 names=["q", "own", "ids", "score"])

    scored = near.select("q", "own", "vec", "ids", "of").mapInArrow(run, f"q bigint, own boolean, ids array<{kind}>, score double")
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
    top = scored.select("q", "own", "score", F.explode("ids").alias("id")).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    # A query's own row goes; its copies stay.
    mine = asking.select("query_id", "q").join(top, "q").where(~(F.col("own") & (F.col("id") == F.col("query_id"))))
    by = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "id")
    return (mine.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(key), "score"))
