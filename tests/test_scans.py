"""Windows from slices, timers, the map scan and the running top-k against plain forms."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventide.functions.text import words
from eventide.operators import map_scan
from eventide.operators import topn as N
from eventide.operators import transforms as X
from eventide.operators import watermark as WM
from eventide.operators import windows as W
from eventide.operators.map_scan import value_map
from eventide.operators.word_scan import running_word_count
from eventide.plans import QUERIES


def sensor(spark, rows):
    df = spark.createDataFrame([(i, t, v, n + 1) for n, (i, t, v) in enumerate(rows)], "id string, us bigint, vc int, seq bigint")
    return df.withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz")).withColumn("arrival_us", F.col("seq") * 500_000)


# ------------------------------------------------------------ sliding windows
@pytest.mark.parametrize("size,slide", [("10 s", "5 s"), ("48 s", "1 s"), ("10 s", "4 s"), ("3 s", "7 s"), ("5 s", "5 s")])
def test_windows_from_slices_equal_copied_rows(spark, size, slide):
    r = random.Random(2)
    s = sensor(spark, [(f"s{r.randint(0, 2)}", r.randint(-60_000_000, 90_000_000), r.choice([None, 1, 2, 3])) for _ in range(300)])
    aggs = {"n": ("count", F.lit(1)), "m": ("count", F.col("vc")), "total": ("sum", F.col("vc")), "least": ("min", F.col("ts")), "most": ("max", F.col("vc"))}
    got = W.sliding_windows(s, ["id"], "ts", size, slide, aggs)
    if W.micros(slide) <= W.micros(size):                      # the built-in window takes no gaps
        rows = W.sliding(s, "ts", size, slide)
    else:
        rows = W.tumbling(s, "ts", slide).withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 3 SECONDS")).where("ts < window_end")
    want = rows.groupBy("id", "window_start", "window_end").agg(
        F.count("*").alias("n"), F.count("vc").alias("m"), F.sum("vc").alias("total"), F.min("ts").alias("least"), F.max("vc").alias("most"))
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_only_slices_are_copied(spark):
    """size / slide = 48: 20,000 rows in 100 slices make 4,800 copies, not 960,000."""
    rows = spark.range(20_000).select(F.lit("hot").alias("id"), F.timestamp_micros((F.col("id") % 100) * 1_000_000).cast("timestamp_ntz").alias("ts"))
    got = W.sliding_windows(rows, ["id"], "ts", "48 s", "1 s", {"n": ("count", F.lit(1))})
    assert got.agg(F.sum("n"), F.count("*")).first() == (20_000 * 48, 147)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Aggregate")     # an aggregate lies below the copying


def test_rows_without_a_time_are_in_no_window(spark):
    s = sensor(spark, [("a", None, 1), ("a", 5, 1)])
    assert W.sliding_windows(s, ["id"], "ts", "2 s", "1 s", {"n": ("count", F.lit(1))}).count() == 2
    assert W.sliding_windows(s.where("false"), ["id"], "ts", "2 s", "1 s", {"n": ("count", F.lit(1))}).collect() == []


# ---------------------------------------------------------------------- timers
def replay(rows, after, delay, delete):
    """Row by row, as a stream with one watermark per row would do it."""
    pending, out, wm, top = {}, [], None, None
    for k, t, seq in rows:
        if t is None:
            continue
        if delete and k in pending:
            due, reg = pending.pop(k)
            out.append((k, reg, due, None, None, seq))
        if delete:
            pending[k] = (t + after, seq)
        else:
            pending[(k, t + after)] = (t + after, seq)
        if top is None or t > top:
            top, wm = t, t - delay - 1000
            for name in [n for n, (due, _) in pending.items() if due <= wm]:
                due, reg = pending.pop(name)
                out.append((name if delete else name[0], reg, due, seq, wm, None))
    out += [(name if delete else name[0], reg, due, None, None, None) for name, (due, reg) in pending.items()]
    return out


def timers(s, delete, after=5_000_000, delay=3_000_000):
    got = WM.timer_firings(s, ["id"], "ts", ["arrival_us", "seq"], after, delay, delete_previous=delete)
    epoch = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias(c)
    if delete:
        return sorted(map(tuple, got.select("id", "seq", epoch("timer_ts"), "fired_seq", epoch("watermark"), "deleted_seq").collect()), key=repr)
    return sorted(map(tuple, got.select("id", epoch("timer_ts"), "fired_seq", epoch("watermark")).collect()), key=repr)


def test_g8_timer_moments(spark):
    s = sensor(spark, [("s1", t * 1_000_000, 1) for t in (1, 5, 9, 10)])
    assert timers(s, False) == sorted([("s1", 6_000_000, 4, 6_999_000), ("s1", 10_000_000, None, None), ("s1", 14_000_000, None, None),
                                       ("s1", 15_000_000, None, None)], key=repr)
    deleted = {r[1]: r[3:] for r in timers(s, True)}
    assert deleted == {1: (None, None, 2), 2: (None, None, 3), 3: (None, None, 4), 4: (None, None, None)}


@pytest.mark.parametrize("spread", [2_000_000, 40_000_000])
def test_timers_equal_a_replay(spark, spread):
    """Late rows, too: their timers are already due and fire with the next watermark."""
    r = random.Random(spread)
    rows = [(f"s{r.randint(0, 3)}", n * 1_000_000 - r.randint(0, spread) // 500_000 * 500_000 if n % 17 else None, n) for n in range(250)]
    s = sensor(spark, rows)
    plain = [(k, t, n + 1) for n, (k, t, _) in enumerate(rows)]
    want = {(k, due, at, wm) for k, _, due, at, wm, _ in replay(plain, 5_000_000, 3_000_000, False)}
    assert timers(s, False) == sorted(want, key=repr)
    assert timers(s, True) == sorted(replay(plain, 5_000_000, 3_000_000, True), key=repr)


def test_timers_of_an_empty_table(spark):
    s = sensor(spark, [("a", 1, 1)]).where("false")
    assert timers(s, False) == [] and timers(s, True) == []


# ------------------------------------------------------- running map and top-k
def test_running_map_over_any_domain(spark):
    r = random.Random(8)
    rows = [(r.choice(["hot", "hot", "hot", "b", None]), r.choice(["x", "y", "zz", None, f"only{n}"])) for n in range(400)]
    s = spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(rows)], "id string, value string, seq bigint")
    counts, want = {}, []
    for n, (k, v) in enumerate(rows):
        of = counts.setdefault(k, {})
        of[v] = of.get(v, 0) + 1
        want.append((n, {x: c for x, c in of.items() if x is not None}, of[v]))
    got = value_map(s, ["id"], "value", own="mine").orderBy("seq").collect()
    assert [(r.seq, r.counts, r.mine) for r in got] == want
    assert value_map(s, [], "value").columns == ["id", "value", "seq", "counts"]
    whole = value_map(s, [], "value").orderBy(F.desc("seq")).first()
    assert sum(whole.counts.values()) == sum(v is not None for _, v in rows)
    assert value_map(s.where("false"), ["id"], "value").collect() == []


def test_running_map_of_a_hot_key_is_chunked(spark):
    """2-row chunks (tests): a key of 400 rows is 200 groups, none larger."""
    s = spark.range(400).select(F.lit("hot").alias("id"), (F.col("id") % 5).cast("double").alias("v"), F.col("id").alias("seq"))
    d = value_map(s, ["id"], "v")
    assert d.where("seq = 399").first().counts == {float(v): 80 for v in range(5)}
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("__ev_chunk") and "REPARTITION_BY_COL" in plan


@pytest.mark.parametrize("block,most", [(500_000, 1), (64, 400), (1, 900)])
def test_rows_of_many_small_groups_share_a_block(monkeypatch, block, most):
    """Groups of a row or two beside a large one, some going on from a map, over two
    batches; equal to a plain count at any size of a block."""
    monkeypatch.setattr(map_scan, "_BLOCK", block)
    r = random.Random(4)
    domain = [None, float("nan"), -0.0, 0.0, 1.0, 2.0, 3.0]
    held, counts = map_scan._Counts(pa.array([], pa.float64()), np.zeros(0, np.int64)), {}
    plain = lambda v: "nan" if v != v else v
    for begin, sizes in ((1, [1, 2, 300, *[r.randint(1, 2) for _ in range(200)], 3]), (0, [40, 1, 5])):
        groups = [g + begin for g, n in enumerate(sizes) for _ in range(n)]
        values = [r.choice(domain) for _ in groups]
        entries = [(g, v, r.randint(1, 9)) for g in range(1, len(sizes) + begin) for v in r.sample([None, float("nan"), 0.0, 3.0], r.randint(0, 4))]
        counts = {0: counts}
        for g, v, n in entries:
            counts.setdefault(g, {})[plain(v)] = n
        want = []
        for g, v in zip(groups, values):
            of = counts.setdefault(g, {})
            of[plain(v)] = of.get(plain(v), 0) + 1
            want.append(({k: n for k, n in of.items() if k is not None}, of[plain(v)]))
        last = len(sizes) + begin - 1
        got, blocks = [], 0
        for size, maps, own in held.run(pa.array(values, pa.float64()), np.array(groups), pa.array([v for _, v, _ in entries], pa.float64()),
                                        np.array([g for g, _, _ in entries], dtype=np.int64), np.array([n for *_, n in entries], dtype=np.int64), last):
            assert size == len(maps) == len(own)
            blocks += 1
            for m in maps.to_pylist():
                assert [k for k, _ in m] == sorted((k for k, _ in m), key=lambda k: (k != k, k))
            got += [({plain(k): n for k, n in m}, o) for m, o in zip(maps.to_pylist(), own.to_pylist())]
        assert got == want and blocks <= most
        counts = counts[last]


# ------------------------------------------------------- running word count
@pytest.mark.parametrize("per_batch", ["3", "10000"])
def test_running_words_over_chunks_batches_and_repeated_documents(spark, per_batch):
    """Documents that share their number (also over the edge of a batch) are counted
    line by line and word number by word number; blank lines, null texts, null numbers."""
    r = random.Random(5)
    texts = ["\n".join(" ".join(r.choice(["a", "b", "", "é", f"w{n}"]) for _ in range(r.randint(0, 6))) for _ in range(r.randint(0, 5))) for n in range(60)]
    docs = spark.createDataFrame([(n // 2 * 3, t) for n, t in enumerate(texts)] + [(7, None), (8, ""), (10, "   ")], "doc_id bigint, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        lines = X.split_lines(docs, "text", ["doc_id"])
        got = running_word_count(lines, "line", ["doc_id", "line_no"], F.floor(F.col("doc_id") / 8), words).collect()
        none = running_word_count(lines.where("false"), "line", ["doc_id", "line_no"], F.floor(F.col("doc_id") / 8), words).collect()
        at_null = running_word_count(lines.withColumn("doc_id", F.lit(None).cast("bigint")), "line", ["doc_id", "line_no"], F.col("doc_id"), words).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plain = X.split_words(lines, "line", ["doc_id", "line_no"]).collect()
    assert none == [] and len(at_null) == len(plain)
    assert max(c.cnt for c in at_null if c.word == "a") == sum(p.word == "a" for p in plain)
    # Words at one place of two documents may come in any order.
    seen, want = collections.Counter(), []
    for p in sorted(plain, key=lambda p: (p.doc_id, p.line_no, p.word_no)):
        seen[p.word] += 1
        want.append((p.doc_id, p.line_no, p.word_no, p.word, seen[p.word]))
    assert sorted(tuple(g) for g in got) == sorted(want)


def test_running_words_are_not_shuffled_word_by_word(spark, tmp_path):
    """The plan that the query makes sends lines and counts only."""
    d = spark.createDataFrame([(1, "a b a"), (3000, "a c")], "doc_id bigint, text string")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["word_count_running"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, 0, "a", 1), (1, 0, 1, "b", 1), (1, 0, 2, "a", 2), (3000, 0, 0, "a", 3), (3000, 0, 1, "c", 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__ev_chunk" in plan and "hashpartitioning(word" not in plan


@pytest.mark.parametrize("kind", ["int", "double", "string"])
def test_running_top_k_of_any_type(spark, kind):
    r = random.Random(3)
    make = {"int": int, "double": float, "string": str}[kind]
    rows = [(r.choice(["a", "hot", "hot", None]), make(r.randint(0, 9)) if r.random() < 0.9 else None) for _ in range(300)]
    if kind == "double":
        rows[5] = ("hot", float("nan"))
    s = spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(rows)], f"id string, v {kind}, seq bigint")
    held, want = {}, []
    for k, v in rows:
        if v is not None and v == v:
            held[k] = sorted([*held.get(k, []), v], reverse=True)[:4]
        want.append(held.get(k, []))
    out = N.running_top_k(s, ["id"], "v", 4)
    assert [list(r.top4) for r in out.orderBy("seq").collect()] == want
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString() and "MapIn" not in out._jdf.queryExecution().executedPlan().toString()
