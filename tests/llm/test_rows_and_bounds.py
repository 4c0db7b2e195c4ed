"""Repeated, keyless and same-key rows, clashing names, bounded samples, and
results against plain forms."""

import math
import random

import numpy as np
import pytest

pytest.importorskip("eventide.llm.queries")

from eventide.llm import line_windows, pstable, queries, toxicity, trie_join

SMALL = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def text(seed, lines=6):
    r = random.Random(seed)
    return "\n".join(" ".join(r.choice(WORDS) for _ in range(12)) for _ in range(lines))


@pytest.mark.parametrize("keyed", [True, False])
def test_repeated_rows_leave_the_dedup_stages_once(spark, keyed):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(i if keyed else None, text(i), "en", "src", 0) for i in range(5) for _ in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = pipeline.drop_near_copies(spark, pipeline.drop_repeated_lines(spark, docs, SMALL), SMALL)
    assert out.columns == docs.columns
    assert sorted(r.text for r in out.collect()) == sorted(text(i) for i in range(5))


def test_keys_held_by_different_texts(spark):
    near = text(1).replace("alpha", "alfa", 1)
    rows = [(1, text(1)), (1, text(2)), (2, text(2)), (3, near), (None, text(1)), (None, text(3)), (4, None), (5, ""), (4, None), (7, text(4)), (7, text(4))]
    docs = spark.createDataFrame([(*r, n, "x") for n, r in enumerate(rows)], "doc_id bigint, text string, __k int, __TH string")
    out = trie_join.deduplicate(docs)
    assert out.columns == docs.columns
    prints = {t: int(f) for t, f in zip([t for _, t in rows], trie_join.simhash_block([t or "" for _, t in rows]))}
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    groups = []
    for k, t in rows:
        home = [g for g in groups if any((prints[t] ^ prints[u]).bit_count() <= 4 for _, u in g)]
        merged = [(k, t)] + [m for g in home for m in g]
        groups = [g for g in groups if g not in home] + [merged]
    # One row per group, that with the smallest key (keyless rows last).
    assert len(got) == len(groups) == 5 and len(set(got)) == 5
    for g in groups:
        least = min(k if k is not None else math.inf for k, _ in g)
        mine = [x for x in got if x in g]
        assert len(mine) == 1 and (mine[0][0] if mine[0][0] is not None else math.inf) == least


def test_hot_repeated_row(spark):
    docs = spark.range(0, 3000, 1, 8).selectExpr("1L as doc_id", f"'{text(1, 1)}' as text").unionByName(spark.createDataFrame([(2, text(2))], "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in trie_join.deduplicate(docs).collect()) == [1, 2]


def test_clashing_names_survive(spark):
    names = ["__n", "__cut", "__kept", "__id", "__th", "__t", "__hits"]
    docs = spark.createDataFrame([(1, "a\nb\nc\nd", *range(7)), (2, "a\nb\nc\nx", *range(7))], "doc_id bigint, text string, " + ", ".join(f"{n} int" for n in names))
    out = line_windows.deduplicate(docs, counts=True)
    assert out.columns == docs.columns + ["n_lines", "n_removed"]
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "a\nb\nc\nd", *range(7), 4, 0), (2, "x", *range(7), 4, 3)]
    none = toxicity.OrdinalModel([], np.zeros(0), np.full(3, 30.0))
    assert sorted(map(tuple, toxicity.reject(docs, none).collect())) == sorted(map(tuple, docs.collect()))


# -------------------------------------------------------------------- toxicity
def test_the_fit_reads_a_bounded_sample(spark, monkeypatch):
    """Many rows of a labelled key are one row of the sample."""
    seen = []
    real = toxicity.train_on
    monkeypatch.setattr(toxicity, "train_on", lambda ptr, *rest: seen.append(len(ptr) - 1) or real(ptr, *rest))
    docs = spark.range(0, 6000, 1, 4).selectExpr("id % 3 as doc_id", "concat('bad awful word ', id % 7) as text")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id bigint, toxic int")
    toxicity.train(docs, labels, rows=2)
    assert seen == [2]


def plain_loss(w, theta, x, grades, l2):
    """Mean -log P(grade) of a cumulative-link model, row by row."""
    total = 0.0
    for row, g in zip(x, grades):
        s = sum(a * b for a, b in zip(w, row))
        p = [1 / (1 + math.exp(-(t - s))) for t in theta]
        total -= math.log([*p, 1.0][g] - [0.0, *p][g])
    return total / len(x) + l2 / 2 * sum(a * a for a in w)


def test_fit_is_the_least_loss_of_a_plain_form():
    r = np.random.default_rng(3)
    x = r.poisson(0.7, (250, 5)).astype(float)
    grades = np.clip(np.floor(x @ [0.9, 0.4, 0.0, -0.5, 0.2] + r.logistic(size=250) + 0.5), 0, 3).astype(np.int64)
    rows, cols = np.nonzero(x)
    ptr = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=250))])
    w, theta = toxicity.fit(ptr, cols, x[rows, cols], 5, grades, 4, l2=1e-2, steps=4000)
    best = plain_loss(w, theta, x, grades, 1e-2)
    assert list(theta) == sorted(theta)
    for k in range(8):                                       # the gradient is zero
        for step in (1e-4, -1e-4):
            w2, t2 = w.copy(), theta.copy()
            if k < 5:
                w2[k] += step
            else:
                t2[k - 5] += step
            assert abs(plain_loss(w2, t2, x, grades, 1e-2) - best) < 1e-6
    for _ in range(40):                                      # and no place near it is better
        assert plain_loss(w + r.normal(0, 0.2, 5), np.sort(theta + r.normal(0, 0.2, 3)), x, grades, 1e-2) > best


def test_op2_equals_the_plain_model(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in queries.QUERIES["op2_toxicity"](spark, SMALL).collect()}
    assert len(got) == docs.count()
    weight = dict(zip(model.words, model.weights))
    for d in docs.collect():
        counts = {}
        for word in toxicity._WORD.findall((d.text or "").lower()):
            for f in (word, *(word[:n] + "~" for n in (4, 5, 6) if len(word) > n)):
                counts[f] = counts.get(f, 0) + 1
        s = sum(weight[f] * math.log1p(n) for f, n in counts.items() if f in weight)
        above = [1 / (1 + math.exp(t - s)) for t in model.thresholds]
        chance = [a - b for a, b in zip([1.0, *above], [*above, 0.0])]
        r = got[d.doc_id]
        assert r.severity == pytest.approx(sum(k * c for k, c in enumerate(chance)), abs=2e-6) and r.p_toxic == pytest.approx(above[0], abs=2e-6)
        assert chance[r.grade] == pytest.approx(max(chance)) and r.toxic == (r.p_toxic >= 0.5)


# ------------------------------------------------------------------ embeddings
def test_large_small_and_unequal_vectors(spark):
    rows = [(0, [1e200, 2e200], 1), (1, [1e200, 2e200], 1), (2, [1e-200, 2e-200], 1), (3, [3e-320, 6e-320], 1), (4, [1e200, -1e200], 1), (5, [1.0, 2.0, 0.0], 1),
            (6, [1.0], 1), (7, [5e300], 1), (8, [1.0, 2.0], 2), (9, [1.7e308, 1.7e308], 3), (10, [1.0, 1.0], 3)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pstable.near_duplicates(df).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (3, 0), 4: (0, 4), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (1, 9), 10: (1, 9)}


def test_recall_over_ten_thousand_planted_vectors(spark):
    """Links around the threshold among 12,000 vectors of 64 components, where a plan
    takes several projections a table: at least 0.95 of them, and none besides."""
    r = np.random.default_rng(11)
    base = r.standard_normal((6000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = r.standard_normal((6000, 64))
    other -= (other * base).sum(axis=1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cos = r.uniform(0.9, 0.99, (6000, 1))
    x = np.concatenate([base, cos * base + np.sqrt(1 - cos ** 2) * other]).astype(np.float32)
    label = np.concatenate([np.arange(6000) % 2] * 2)
    assert pstable.plan(12_000, 0.93)[0] > 1
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))], "vec_id bigint, embedding array<float>, label int")
    got = np.zeros(12_000, dtype=np.int64)
    for row in pstable.near_duplicates(df).collect():
        got[row.vec_id] = row.n_links
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    want = np.concatenate([((y[i:i + 1000] @ y.T >= 0.93) & (label[i:i + 1000, None] == label)).sum(axis=1) - 1 for i in range(0, 12_000, 1000)])
    assert (got <= want).all() and got.sum() >= 0.95 * want.sum() > 5000
