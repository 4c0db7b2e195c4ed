"""User aggregates, table functions and table aggregates."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.functions import user as U
from eventide.operators.map_scan import value_map
from eventide.plans import QUERIES
from eventide.plans.q_functions import KeyedSum, MostFrequent, SplitWords, Top2, WeightedAvg

SCORES = [("zs", 80, 3), ("zs", 90, 4), ("zs", 95, 4), ("ls", 75, 4), ("ls", 65, 4), ("ls", 85, 4), (None, 7, 1), (None, 9, 1), ("xx", None, 2)]


def variance():
    # Made here, so that tasks get the class itself, as from a script.
    class Variance(U.UserAggregate):
        """A list accumulator: number, mean, sum of squared differences."""

        accumulator, result = "array<double>", "struct<n bigint, variance double>"

        def create(self):
            return [0.0, 0.0, 0.0]

        def add(self, acc, value):
            return acc if value is None else self.merge(acc, [1.0, float(value), 0.0])

        def merge(self, a, b):
            n = a[0] + b[0]
            if not n:
                return a
            d = b[1] - a[1]
            return [n, a[1] + d * b[0] / n, a[2] + b[2] + d * d * a[0] * b[0] / n]

        def finish(self, acc):
            return {"n": int(acc[0]), "variance": acc[2] / acc[0] if acc[0] else None}

    return Variance()


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(SCORES, "name string, score int, weight int")


def test_f15_weighted_average(spark, scores):
    got = dict(U.aggregate(scores, ["name"], {"w": (WeightedAvg(), ["score", "weight"])}).collect())
    assert got["zs"] == pytest.approx(980 / 11) and got["ls"] == 75.0 and got[None] == 8.0 and got["xx"] is None
    U.register_aggregate(spark, "WeightedAvg", WeightedAvg())
    accs = U.accumulators(scores, ["name"], {"acc": (WeightedAvg(), ["score", "weight"])})
    assert dict(spark.sql("SELECT name, WeightedAvg(acc) FROM {accs} GROUP BY name", accs=accs).collect()) == got


def test_accumulators_of_three_types_equal_native_forms(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 11).cast("int").alias("v"), (F.col("id") % 3).alias("w"))
    got = U.aggregate(df, ["k"], {"avg": (WeightedAvg(), ["v", "w"]), "mode": (MostFrequent(), ["v"]), "var": (variance(), ["v"]),
                                  "text": (KeyedSum(), [F.col("k").cast("string"), F.col("v")])})
    native = df.groupBy("k").agg((F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("avg"), F.var_pop("v").alias("var"), F.count("v").alias("n"),
                                 F.sum("v").alias("s"))
    counts = collections.defaultdict(dict)
    for k, v, n in df.groupBy("k", "v").count().collect():
        counts[k][v] = n
    want = {r.k: r for r in native.collect()}
    rows = got.collect()
    assert len(rows) == 7
    for r in rows:
        w = want[r.k]
        assert r.avg == pytest.approx(w.avg) and r["var"].variance == pytest.approx(w["var"]) and r["var"].n == w.n
        assert r.mode == min(counts[r.k], key=lambda v: (-counts[r.k][v], v)) and r.text == f"key={r.k} sum={w.s}"


def test_hot_key_never_meets_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(U, "FAN", 4)
    df = spark.range(0, 40_000, 1, 32).select(F.lit("hot").alias("k"), (F.col("id") % 9).cast("int").alias("v"))
    accs = U.accumulators(df, ["k"], {"acc": (MostFrequent(), ["v"])})
    rows = accs.collect()
    assert len(rows) == 4                                        # 32 tasks in 4 slots
    assert sum(sum(r.acc.values()) for r in rows) == 40_000
    assert U.aggregate(df, ["k"], {"m": (MostFrequent(), ["v"])}).collect() == [("hot", 0)]


def test_few_tasks_leave_one_accumulator_per_key(spark):
    """Keys that stand in all of 8 tasks: one row each goes on to the table aggregate."""
    df = spark.range(0, 8000, 1, 8).select((F.col("id") % 50).alias("k"), F.col("id").cast("double").alias("v"))
    accs = U.accumulators(df, ["k"], {"acc": (Top2(), ["v"])})
    assert sorted((r.k, tuple(r.acc)) for r in accs.collect()) == [(k, (7950.0 + k, 7900.0 + k)) for k in range(50)]


def shapes():
    class Shapes(U.UserTableAggregate):
        """Values of other Python types than their fields'."""

        accumulator, fields = "bigint", "d double, n int, s string, b boolean, l bigint"

        def create(self):
            return 0

        def add(self, acc, value):
            return acc + value

        def merge(self, a, b):
            return a + b

        def emit(self, acc):
            yield int(acc), np.int64(acc), np.str_("x"), np.bool_(True), None
            yield np.float64(acc), float(acc), "y", False, acc * (1 << 62)

    return Shapes()


def test_table_aggregate_keeps_values_of_other_types(spark):
    U.register_table_aggregate(spark, "Shapes", shapes())
    df = spark.createDataFrame([(1, 1), (None, 0), (None, 0)], "k int, v int")
    got = spark.sql("SELECT * FROM Shapes(TABLE({accs}) PARTITION BY k)", accs=U.accumulators(df, ["k"], {"acc": (shapes(), ["v"])}))
    assert sorted(got.collect(), key=repr) == sorted(
        [(1, 1.0, 1, "x", True, None), (1, 1.0, 1, "y", False, 1 << 62), (None, 0.0, 0, "x", True, None), (None, 0.0, 0, "y", False, 0)], key=repr)
    more = spark.createDataFrame([(1, 2)], "k int, v int")                # 2 << 62 is no bigint
    with pytest.raises(Exception, match="is no bigint"):
        spark.sql("SELECT * FROM Shapes(TABLE({accs}) PARTITION BY k)", accs=U.accumulators(more, ["k"], {"acc": (shapes(), ["v"])})).collect()


def test_keys_beyond_what_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(U, "HELD", 10)
    df = spark.range(3000).select((F.col("id") % 500).alias("k"), F.lit(1).alias("v"), F.lit(1).alias("w"))
    got = U.aggregate(df, ["k"], {"s": (KeyedSum(), [F.col("k").cast("string"), "v"])}).collect()
    assert sorted(r.s for r in got) == sorted(f"key={k} sum=6" for k in range(500))


def test_double_keys_and_empty_tables(spark, scores):
    df = spark.createDataFrame([(float("nan"), 1), (float("nan"), 2), (0.0, 3), (-0.0, 4), (None, 5), (None, 6)], "k double, v int")
    got = U.aggregate(df, ["k"], {"m": (KeyedSum(), [F.lit("x"), "v"])}).collect()
    assert sorted(r.m for r in got) == ["key=x sum=11", "key=x sum=3", "key=x sum=7"]
    none = scores.where("false")
    assert U.aggregate(none, ["name"], {"w": (WeightedAvg(), ["score", "weight"])}).collect() == []
    assert U.aggregate(none, [], {"w": (WeightedAvg(), ["score", "weight"])}).collect() == []


def test_f16_top2_over_a_partitioned_table_argument(spark):
    U.register_table_aggregate(spark, "Top2", Top2())
    nums = spark.createDataFrame([(float(x),) for x in (3, 6, 12, 5, 8, 9, 4)], "num double")
    accs = U.accumulators(nums, [], {"acc": (Top2(), ["num"])})
    got = spark.sql("SELECT value, rank FROM Top2(TABLE({accs}) WITH SINGLE PARTITION)", accs=accs).collect()
    assert got == [(12.0, 1), (9.0, 2)]
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 5.0), ("a", 2, 1.0), ("b", 1, -3.0), (None, 1, 2.0), ("c", 1, None)], "k string, j int, v double")
    accs = U.accumulators(df, ["k", "j"], {"acc": (Top2(), ["v"])})
    got = spark.sql("SELECT * FROM Top2(TABLE({accs}) PARTITION BY (k, j))", accs=accs)
    assert got.columns == ["k", "j", "value", "rank"]
    assert sorted(got.collect(), key=repr) == sorted([("a", 1, 5.0, 1), ("a", 1, 5.0, 2), ("a", 2, 1.0, 1), (None, 1, 2.0, 1)], key=repr)


def test_f17_table_function_cross_and_left(spark):
    U.register_table_function(spark, "SplitFunction", SplitWords, "word string, length int")
    lines = spark.createDataFrame([("hello spark",), ("hello world hi",), ("hello java",), (None,), ("",)], "words string")
    cross = spark.sql("SELECT words, word, length FROM {lines}, LATERAL SplitFunction(words)", lines=lines).collect()
    assert sorted((r.word, r.length) for r in cross if r.words) == sorted(
        [("hello", 5), ("spark", 5), ("hello", 5), ("world", 5), ("hi", 2), ("hello", 5), ("java", 4)])
    left = spark.sql("SELECT words, T.w, T.n FROM {lines} LEFT JOIN LATERAL SplitFunction(words) AS T(w, n) ON true", lines=lines).collect()
    assert (None, None, None) in [tuple(r) for r in left] and len(left) == len(cross) + 1


def test_table_function_in_batches_equals_its_calls(spark, monkeypatch):
    monkeypatch.setattr(U, "_OUT", 7)                              # several batches out of one
    U.register_table_function(spark, "split_calls", SplitWords, "word string, length int")
    U.register_table_function(spark, "split_batches", SplitWords, "word string, length int", "line string")
    texts = ["hello spark", None, "", "   ", " a  b ", "é ü 𝒳", *[" ".join("w" * (n % 5) for n in range(k)) for k in range(40)]]
    lines = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, line string").repartition(3)
    for join in (", LATERAL {f}(line) t", " LEFT JOIN LATERAL {f}(line) AS t ON true"):
        each = [sorted(spark.sql("SELECT n, t.word, t.length FROM {lines}" + join.replace("{f}", f), lines=lines).collect(), key=repr) for f in ("split_calls", "split_batches")]
        assert each[0] == each[1] and len(each[0]) > 300
    assert spark.sql("SELECT * FROM split_batches('x yz')").collect() == [("x", 1), ("yz", 2)]


def test_table_function_of_two_arguments_in_batches(spark):
    class Repeat:
        def eval(self, value, times):
            if times is not None:
                for n in range(times):
                    yield value, n

    class Wide:
        def eval(self, value):
            yield value, 1, 2

    U.register_table_function(spark, "repeat_value", Repeat, "v double, n bigint", "value double, times int")
    rows = spark.createDataFrame([(1.5, 2), (None, 1), (2.0, None), (3.0, 0)], "a double, b int")
    got = spark.sql("SELECT a, t.v, t.n FROM {rows}, LATERAL repeat_value(a, b) t", rows=rows).collect()
    assert sorted(got, key=repr) == sorted([(1.5, 1.5, 0), (1.5, 1.5, 1), (None, None, 0)], key=repr)
    U.register_table_function(spark, "wide", Wide, "v double, n bigint", "value double")
    with pytest.raises(Exception, match="a row of 3 values for 2 fields"):
        spark.sql("SELECT t.* FROM {rows}, LATERAL wide(a) t", rows=rows).collect()
    with pytest.raises(ValueError, match="no batches"):
        U.register_table_function(spark, "late", Wide, "at timestamp", "value double")


def test_udtf_user_split_goes_in_batches(spark):
    plan = QUERIES["udtf_user_split"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "UDTF" not in plan


def test_python_work_is_not_merged_by_bytes(spark):
    """A session that merges partitions by bytes alone would leave few tasks."""
    df = spark.range(100).select((F.col("id") % 9).alias("k"), F.col("id").alias("seq"))
    conf = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    spark.conf.set(conf, "false")
    try:
        for d in (U.accumulators(df, ["k"], {"acc": (MostFrequent(), ["seq"])}), value_map(df.withColumn("v", F.col("seq") % 3), ["k"], "v"),
                  U.running(df, ["k"], {"n": (U.Reduce(max, "bigint"), ["seq"])})):
            last = next(x for x in d._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x)
            assert "REPARTITION_BY_NUM" in last
    finally:
        spark.conf.unset(conf)


@pytest.mark.parametrize("chunk", ["2", "1000000"])
def test_running_fold_in_order(spark, chunk):
    """A fold that is not commutative, over any number of chunks."""
    rows = [(k, v, n) for n, (k, v) in enumerate([("a", "x"), ("b", "y"), ("a", None), (None, "n"), ("a", "z"), ("b", "w"), (None, "m"), ("a", "x"), ("a", "q")])]
    df = spark.createDataFrame(rows, "k string, v string, seq bigint")
    held, want = {}, []
    for k, v, n in rows:
        held[k] = (held.get(k) or "") + v if v is not None else held.get(k)
        want.append((n, held[k]))
    before = spark.conf.get("eventide.scan.chunkRows")
    try:
        spark.conf.set("eventide.scan.chunkRows", chunk)
        got = U.running(df, ["k"], {"all": (U.Reduce(lambda a, b: a + b, "string"), ["v"]), "mode": (MostFrequent(), [F.length("v")])})
        assert got.columns == ["k", "v", "seq", "all", "mode"]
        assert [(r.seq, r["all"]) for r in got.orderBy("seq").collect()] == want
        whole = U.running(df, [], {"all": (U.Reduce(lambda a, b: a + b, "string"), ["v"])}).orderBy(F.desc("seq")).first()
        assert whole["all"] == "".join(v for _, v, _ in rows if v)
        assert U.running(df.where("false"), ["k"], {"all": (U.Reduce(lambda a, b: a + b, "string"), ["v"])}).collect() == []
    finally:
        spark.conf.set("eventide.scan.chunkRows", before)
