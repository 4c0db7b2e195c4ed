"""The neighbour graph against brute force: recall, exact scores, edge cases."""

import numpy as np
import pytest

pytest.importorskip("eventide.llm.queries")

from eventide.llm import neighbour_graph, queries

SMALL = "/root/testdata/sf0.01"


def brute(ids, x, asked, k=20):
    out = {}
    for q in asked:
        s = x @ x[q]
        order = [i for i in np.lexsort((ids, -s)) if i != q][:k]
        out[ids[q]] = [(ids[i], s[i]) for i in order]
    return out


def recall(got, want, k=20):
    """Share of the wanted places whose score was reached."""
    hit = total = 0
    for q, rows in want.items():
        mine = sorted((r for r in got if r[0] == q), key=lambda r: r[1])
        assert [r[1] for r in mine] == list(range(1, len(mine) + 1)) and len({r[2] for r in mine}) == len(mine) <= k
        assert all(a[3] > b[3] or a[3] == b[3] and a[2] < b[2] for a, b in zip(mine, mine[1:]))
        hit += sum(r[3] >= rows[-1][1] - 1e-12 for r in mine)
        total += len(rows)
    return hit / total


def test_registered_query_recall(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    got = queries.QUERIES["op13_neighbour_graph"](spark, SMALL).collect()
    want = brute(ids, x, np.flatnonzero(ids % 20 == 0))
    assert recall(got, want) >= 0.99
    score = {(i, j): s for i, rs in want.items() for j, s in rs}
    assert all(abs(score[r[0], r[2]] - r[3]) < 1e-12 for r in got if (r[0], r[2]) in score)


@pytest.mark.parametrize("shape", ["sphere", "clumps", "lengths"])
def test_recall(spark, shape):
    r = np.random.default_rng(4)
    x = r.standard_normal((4000, 24))
    if shape == "clumps":
        x = x[r.integers(0, 60, 4000)] + 0.05 * x
    if shape == "lengths":
        x *= np.exp(r.standard_normal((4000, 1)) / 2)
    else:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(4000) + 7
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>")
    got = neighbour_graph.nearest(df, "vec_id % 40 = 0").collect()
    assert recall(got, brute(ids, x, np.flatnonzero(ids % 40 == 0))) >= 0.95


def test_edges(spark):
    same = [0.5, -0.5, 0.25]
    rows = [(i, same) for i in range(60)] + [(3, same), (3, same), (3, [1.0, 0.0, 0.0])]            # copies, repeated rows, one key twice
    rows += [(100 + i, [float(i), 1.0, -1e-3 * i]) for i in range(30)]
    rows += [(200, None), (220, [0.0, 0.0, 0.0]), (240, [None, 1.0, 1.0]), (260, [float("nan"), 1.0, 1.0]), (280, [float("inf"), 1.0, 1.0]), (300, []),
             (None, same), (320, [2.0]), (340, [-0.0, 1.0, 0.0]), (341, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, node int, code string")
    got = neighbour_graph.nearest(df, "vec_id % 20 = 0", k=20)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    good = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            good[(i, tuple(c + 0.0 for c in v) + (0.0,) * (3 - len(v)))] = None
    want = []
    for q, qv in good:
        if q % 20 == 0:
            near = sorted(((-sum(a * b for a, b in zip(qv, v)), i) for i, v in good if (i, v) != (q, qv)))[:20]
            want += [(q, r, i, round(-s, 9)) for r, (s, i) in enumerate(near, 1)]
    assert sorted((r[0], r[1], r[2], round(r[3], 9)) for r in got.collect()) == sorted(want)
    assert neighbour_graph.nearest(df.where("false"), "vec_id % 20 = 0").collect() == []
    assert neighbour_graph.nearest(df.where("vec_id = 340"), "vec_id % 20 = 0").collect() == []


def test_hubs_are_dealt_into_slots(spark, monkeypatch):
    monkeypatch.setattr(neighbour_graph, "CROWD", 20)
    monkeypatch.setattr(neighbour_graph, "BUCKET", 64)
    monkeypatch.setattr(neighbour_graph, "CENTRES", 100)
    monkeypatch.setattr(neighbour_graph, "GROUP", 128)
    r = np.random.default_rng(9)
    x = r.standard_normal((1200, 12))
    x[:40] *= 6                                                # hubs under the inner product
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = neighbour_graph.nearest(df, "vec_id % 30 = 0").collect()
    assert recall(got, brute(np.arange(1200), x, np.arange(0, 1200, 30))) >= 0.95


def test_no_row_per_link_goes_to_python(spark, monkeypatch):
    monkeypatch.setattr(neighbour_graph, "BUCKET", 64)
    monkeypatch.setattr(neighbour_graph, "CENTRES", 512)
    monkeypatch.setattr(neighbour_graph, "GROUP", 512)
    n = 2000
    x = np.random.default_rng(5).standard_normal((n, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    steps = []
    for name in ("mapInArrow", "mapInPandas"):
        real = getattr(type(df), name)
        monkeypatch.setattr(type(df), name, lambda self, *a, real=real, **k: steps.append(self) or real(self, *a, **k))
    got = neighbour_graph.nearest(df, "vec_id % 200 = 0").collect()
    assert recall(got, brute(np.arange(n), x, np.arange(0, n, 200))) >= 0.95
    # Each of them would have tens of links a node.
    assert max(step.count() for step in steps) <= 2 * n
