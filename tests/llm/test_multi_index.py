"""Hard negatives against a plain form, and the index's bounds."""

import math
import random

import numpy as np
import pytest

pytest.importorskip("eventide.llm.queries")

from eventide.llm import multi_index

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=10, positives=5, negatives=5):
    kept = {}
    for i, v, l in rows:
        if i is None or l is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[(i, l, tuple(math.floor(256 * x) for x in v))] = None
    out = []
    for a, al, av in kept:
        if a % every:
            continue
        score = [(-sum(x * y for x, y in zip(av, v)), i, l) for i, l, v in kept if i != a]
        for ps, p, _ in sorted(s for s in score if s[2] == al)[:positives]:
            window = sorted(s for s in score if s[2] != al and 80 * -ps <= 100 * -s[0] <= 100 * -ps)
            out += [(a, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(window[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, l, 7, "x") for i, v, l in rows], "vec_id bigint, embedding array<double>, label int, cell int, ak string")
    got = multi_index.hard_negatives(df, "vec_id % 10 = 0", **kw)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


def rows_of(seed, n, size, clusters):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((clusters, size))
    out = []
    for i in range(n):
        x = centres[r.integers(clusters)] + 0.3 * r.standard_normal(size)
        out.append((i, (x / np.linalg.norm(x)).tolist(), int(r.integers(4))))
    return out


def test_equals_plain_form(spark, monkeypatch):
    # Few rows in the first round and small blocks, so both rounds and several parts matter.
    monkeypatch.setattr(multi_index, "VISIT_ROWS", 40)
    monkeypatch.setattr(multi_index, "BLOCK", 16)
    monkeypatch.setattr(multi_index, "CODES", 6)
    rows = rows_of(1, 400, 9, 12)
    assert mined(spark, rows) == plain(rows)


def test_edges(spark):
    r = random.Random(5)
    rows = [(i, [round(r.uniform(-1, 1), 1) for _ in range(4)], r.randint(0, 2)) for i in range(60)]
    same = [0.5, 0.5, -0.25, 0.0]
    rows += [(i, same, i % 3) for i in range(60, 100)]                          # ties
    rows += [(70, same, 70 % 3), (70, same, 70 % 3), (80, same, 0)]               # repeated rows, one key with two labels
    rows += [(None, same, 1), (110, None, 1), (120, same, None), (130, [0.1, None, 0.0, 1.0], 1), (140, [float("nan"), 1.0, 0.0, 1.0], 1),
             (150, [float("inf"), 1.0, 0.0, 1.0], 1), (160, [0.0] * 4, 1), (170, [1e300, 0.0, 0.0, 0.0], 1), (180, [0.5, 0.5], 1), (190, [], 2)]
    big = [x for x in rows if x[0] != 170]                                          # 170: too long for a score
    full = [(i, v + [0.0] * (4 - len(v)) if v is not None else v, l) for i, v, l in big]
    assert mined(spark, rows) == plain(full)
    assert mined(spark, []) == []
    assert mined(spark, [(1, same, 1), (2, same, 1)]) == []                         # no anchors
    assert mined(spark, [(10, same, 1), (2, same, 1)]) == []                        # no negatives


def test_visits_all_cells_by_bound():
    r = np.random.default_rng(2)
    x = np.floor(256 * r.standard_normal((500, 6)))
    index = multi_index.Index(6, [multi_index.codebook(h, 8) for h in (x[:, :3], x[:, 3:])])
    cell, p, q = index.place(x)
    for c in np.unique(cell):
        index.add(int(c), int((cell == c).sum()), p[cell == c].max(), q[cell == c].max())
    for a in x[:20]:
        seen = list(index.visit(a))
        assert len(seen) == len(index.rows) == len({c for c, _ in seen})
        assert all(u >= v for (_, u), (_, v) in zip(seen, seen[1:]))
        assert all(((x[cell == c] @ a) <= bound).all() for c, bound in seen)
