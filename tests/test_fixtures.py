"""Golden tests: the reference programs' inline inputs and hand-derived answers."""

from pyspark.sql import functions as F, types as T

import pytest

from eventide.functions import java_hash, register_functions, split_java, weighted_avg
from eventide.operators import joins as J
from eventide.operators import keyed as K
from eventide.operators import state as S
from eventide.operators import topn as N
from eventide.operators import transforms as X
from eventide.operators import watermark as WM
from eventide.operators import windows as W
from eventide.sources import generators as G
from eventide.sources.text import parse_fields

S_ = 1_000_000  # microseconds per second


def lines_df(spark, lines):
    return spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "doc_id long, line string")


def test_f1_word_count(spark):
    d = X.split_words(lines_df(spark, ["hello spark", "hello world", "hello java"]), "line", ["doc_id"])
    got = {r.word: r.cnt for r in d.groupBy("word").agg(F.count(F.lit(1)).alias("cnt")).collect()}
    assert got == {"hello": 3, "spark": 1, "world": 1, "java": 1}


NUMBERS = [
    "92 10 91 56 4 27 59 50 92 84 ", "98 52 19 37 28 49 34 71 51 46",
    "76 82 80 60 56 31 60 5 95 57 ", "60 72 27 6 47 39 53 24 69 88 ",
    "28 70 41 96 23 37 5 52 17 65 ", "90 5 33 93 7 32 84 94 51 96 ",
    "83 17 39 41 58 19 10 29 91 75", "39 12 37 70 13 28 21 87 47 23",
    "66 86 43 23 9 11 29 73 72 34 ", "57 46 88 65 41 3 90 46 10 39",
]


def test_f2_split_parity_java_split(spark):
    w = X.split_words(lines_df(spark, NUMBERS), "line", ["doc_id"])
    assert w.filter(F.col("word") == "").count() == 0          # trailing blanks dropped
    p = X.parity_split(w.select(F.col("word").cast("int").alias("n")), "n")
    got = {r.parity: r.c for r in p.groupBy("parity").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert got == {"even": 46, "odd": 54}


def test_split_java_edge_cases(spark):
    df = spark.createDataFrame([("a b ",), ("",), ("   ",), (" a  b",)], "s string")
    got = [r.w for r in df.select(split_java("s").alias("w")).collect()]
    assert got == [["a", "b"], [""], [], ["", "a", "", "b"]]


def test_f3_parse(spark):
    rows = ["s1,1,1", "s1,11,11", "s2,2,2", "s2,3,3", "s3,3,3", "s4,3,3", "bad,x,1"]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("ts", T.LongType()),
                           T.StructField("vc", T.IntegerType())])
    out = parse_fields(df, "value", schema).collect()
    assert [tuple(r)[:3] for r in out if r.valid] == [("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2),
                                                      ("s2", 3, 3), ("s3", 3, 3), ("s4", 3, 3)]
    assert [r.id for r in out if not r.valid] == ["bad"]


def test_f4_flatmap(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2), ("s3", 3, 3)])
    out = X.flat_map(s, X.sensor_flatmap_outputs(), keep=["seq"]).orderBy("seq", "pos")
    assert [r.value for r in out.collect()] == ["1", "s1", "11", "s1", "2", "2", "s2", "s3"]


def test_f5_f6_filter_map(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2), ("s3", 3, 3)])
    assert s.transform(X.filter_eq("id", "s1")).count() == 2
    s3 = sensor_rows([("s1", 1, 1), ("s2", 2, 2), ("s3", 3, 3)])
    assert [r.id for r in s3.transform(X.map_project("id")).orderBy("id").collect()] == ["s1", "s2", "s3"]


def test_f7_union(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "value int")
    b = spark.createDataFrame([(11,), (22,), (33,)], "value int")
    c = spark.createDataFrame([("111",), ("222",), ("333",)], "v string").select(F.col("v").cast("int").alias("value"))
    assert sorted(r.value for r in X.union_all(a, b, c).collect()) == [1, 2, 3, 11, 22, 33, 111, 222, 333]


def test_f8_connect(spark):
    nums = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    strs = spark.createDataFrame([("a",), ("b",), ("c",)], "s string")
    out = X.connect(nums, strs,
                    lambda d: d.select(F.concat(F.lit("number:"), F.col("n").cast("string")).alias("value")),
                    lambda d: d.select(F.concat(F.lit("string:"), "s").alias("value")))
    assert sorted(r.value for r in out.collect()) == ["number:1", "number:2", "number:3",
                                                      "string:a", "string:b", "string:c"]


def test_f9_keyed_match(spark):
    a = spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "b"), (3, "c")], "id int, name string")
    b = spark.createDataFrame([(1, "aa1", 1), (1, "aa2", 2), (2, "bb", 1), (3, "cc", 1)],
                              "id2 int, name2 string, seq int")
    out = J.keyed_match(a, b, "id", "id2")
    per = {r.id: r.c for r in out.groupBy("id").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert per == {1: 4, 2: 1, 3: 1}


def test_f10_reduce_running(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 1), ("s1", 2, 2), ("s1", 3, 3), ("s2", 2, 2), ("s3", 3, 3)])
    d = s.withColumn("ts_s", F.unix_seconds(F.col("ts").cast("timestamp")))
    out = K.reduce_sums(d.select("seq", "id", "ts_s", "vc"), ["id"], ["ts_s", "vc"], running=True)
    got = [(r.id, r.ts_s, r.vc) for r in out.orderBy("seq").collect()]
    assert got == [("s1", 1, 1), ("s1", 3, 3), ("s1", 6, 6), ("s2", 2, 2), ("s3", 3, 3)]


def test_f11_simple_aggregates(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 1), ("s1", 2, 2), ("s1", 3, 3), ("s1", 4, 7), ("s1", 5, 3), ("s1", 6, 8),
                     ("s2", 2, 2), ("s3", 3, 3)])
    s = s.withColumn("ts_s", F.unix_seconds(F.col("ts").cast("timestamp")))
    mb = K.extreme_row(s, ["id"], "vc", ["ts_s", "vc"]).filter("id = 's1'").first()
    assert (mb.ts_s, mb.vc) == (6, 8)
    mx = K.max_keep_first(s, ["id"], "vc", ["ts_s"]).filter("id = 's1'").first()
    assert (mx.ts_s, mx.vc) == (1, 8)
    mnb = K.extreme_row(s, ["id"], "vc", ["ts_s", "vc"], use_min=True).filter("id = 's1'").first()
    assert (mnb.ts_s, mnb.vc) == (1, 1)
    mn = K.max_keep_first(s, ["id"], "vc", ["ts_s"], use_min=True).filter("id = 's1'").first()
    assert (mn.ts_s, mn.vc) == (1, 1)
    assert K.reduce_sums(s, ["id"], ["vc"]).filter("id = 's1'").first().vc == 24


def test_maxby_tie_keeps_first(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 5), ("s1", 2, 5), ("s1", 3, 1)])
    r = K.extreme_row(s, ["id"], "vc", ["seq", "vc"]).first()
    assert (r.seq, r.vc) == (1, 5)


def test_f12_side_outputs(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2), ("s2", 3, 3), ("s3", 3, 3), ("s4", 3, 3)])
    r = X.route(s, {"s1": F.col("id") == "s1", "s2": F.col("id") == "s2"})
    got = {x.route: x.c for x in r.groupBy("route").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert got == {"s1": 2, "s2": 2, "main": 2}


def _join_inputs(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "k string, t long") \
        .select(F.col("k").alias("lk"), F.timestamp_seconds("t").cast("timestamp_ntz").alias("lts"),
                F.col("t").alias("lt"))
    right = spark.createDataFrame([("a", 1, 1), ("a", 11, 1), ("b", 2, 1), ("b", 12, 1), ("c", 14, 1),
                                   ("d", 15, 1)], "k string, t long, n int") \
        .select(F.col("k").alias("rk"), F.timestamp_seconds("t").cast("timestamp_ntz").alias("rts"),
                F.col("t").alias("rt"))
    return left, right


def test_f13_interval_join(spark):
    left, right = _join_inputs(spark)
    out = J.interval_join(left, right, "lk", "rk", "lts", "rts", -2 * S_, 2 * S_)
    assert sorted((r.lk, r.lt, r.rt) for r in out.collect()) == [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def test_f13_interval_join_small_buckets(spark):
    left, right = _join_inputs(spark)
    out = J.interval_join(left, right, "lk", "rk", "lts", "rts", -2 * S_, 2 * S_, bucket_us=S_ // 2)
    assert sorted((r.lk, r.lt, r.rt) for r in out.collect()) == [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def test_f14_window_join(spark):
    left, right = _join_inputs(spark)
    out = J.window_join(left, right, "lk", "rk", "lts", "rts", 10 * S_)
    assert sorted((r.lk, r.lt, r.rt) for r in out.collect()) == [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def test_f15_weighted_avg(spark):
    df = spark.createDataFrame([("zs", 80, 3), ("zs", 90, 4), ("zs", 95, 4), ("ls", 75, 4), ("ls", 65, 4),
                                ("ls", 85, 4)], "name string, score int, weight int")
    got = {r.name: r.w for r in df.groupBy("name").agg(weighted_avg("score", "weight").alias("w")).collect()}
    assert abs(got["zs"] - 980 / 11) < 1e-9 and got["ls"] == 75.0


def test_f16_top2(spark):
    df = spark.createDataFrame([(x,) for x in [3, 6, 12, 5, 8, 9, 4]], "num int")
    got = [(r.num, r.rank) for r in N.top_values(df, "num", 2).orderBy("rank").collect()]
    assert got == [(12, 1), (9, 2)]
    neg = spark.createDataFrame([(-1,), (-5,)], "num int")
    assert N.top_values(neg, "num", 2, positive_only=True).count() == 0
    assert N.top_values(neg, "num", 2).count() == 2


def test_f17_lateral_split(spark):
    df = lines_df(spark, ["hello spark", "hello world hi", "hello java"])
    out = J.lateral_words(df, "line", ["doc_id"]).collect()
    assert [(r.word, r.length) for r in out] == [("hello", 5), ("spark", 5), ("hello", 5), ("world", 5),
                                                 ("hi", 2), ("hello", 5), ("java", 4)]
    register_functions(spark)
    df.createOrReplaceTempView("fx_lines")
    sq = spark.sql("SELECT doc_id, t.word, t.length FROM fx_lines, LATERAL split_words(line) t").collect()
    assert sorted((r.doc_id, r.word, r.length) for r in sq) == sorted(
        [(0, "hello", 5), (0, "spark", 5), (1, "hello", 5), (1, "world", 5), (1, "hi", 2), (2, "hello", 5),
         (2, "java", 4)])


def test_f18_filter_sum_changelog(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 1), ("s1", 2, 2), ("s2", 2, 2), ("s3", 3, 3), ("s3", 4, 4)])
    s.createOrReplaceTempView("fx_sensor")
    f = spark.sql("SELECT id, unix_seconds(CAST(ts AS TIMESTAMP)) AS t, vc FROM fx_sensor "
                  "WHERE unix_seconds(CAST(ts AS TIMESTAMP)) > 2 ORDER BY t").collect()
    assert [(r.id, r.t, r.vc) for r in f] == [("s3", 3, 3), ("s3", 4, 4)]
    sums = {r.id: r.v for r in spark.sql("SELECT id, sum(vc) AS v FROM fx_sensor GROUP BY id").collect()}
    assert sums == {"s1": 3, "s2": 2, "s3": 7}
    cl = S.changelog(s, ["id"], "vc").orderBy("seq", "op_no").collect()
    assert [(r.op, r.id, r.vc_sum) for r in cl] == [("+I", "s1", 1), ("-U", "s1", 1), ("+U", "s1", 3),
                                                     ("+I", "s2", 2), ("+I", "s3", 3), ("-U", "s3", 3),
                                                     ("+U", "s3", 7)]


def test_f19_java_hash(spark):
    df = spark.createDataFrame([("s1",), ("s2",), ("s3",), ("",), ("hello world",), ("\U0001F600x",)], "s string")
    got = [r.h for r in df.select(java_hash("s").alias("h")).collect()]
    assert got[:4] == [3614, 3615, 3616, 0]
    assert got[4] == 1794106052            # "hello world".hashCode()
    assert got[5] == 54959989              # UTF-16 units D83D DE00 0078
    register_functions(spark)
    df.createOrReplaceTempView("fx_h")
    assert [r.h for r in spark.sql("SELECT java_hash(s) AS h FROM fx_h").collect()] == got
    nums = spark.createDataFrame([(5, 1 << 33)], "i int, l long")
    r = nums.select(java_hash("i", T.IntegerType()).alias("a"), java_hash("l", T.LongType()).alias("b")).first()
    assert (r.a, r.b) == (5, 2)


def test_java_hash_of_any_type(spark):
    """Column and SQL forms against values of the Java rules; nulls; refused types."""
    import struct
    doubles = [0.0, -0.0, 1.0, -1.5, 0.1, 1e300, -1e-300, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308,
               2.0 ** 31, 3.0, float("inf"), float("-inf"), None]

    def fold(bits):
        h = (bits ^ (bits >> 32)) & 0xFFFFFFFF
        return h - (1 << 32) if h >= 1 << 31 else h
    longs = [5, -5, 1 << 33, -(1 << 40) + 3, (1 << 63) - 1, -(1 << 63), None]
    cases = {"double": (doubles, lambda x: fold(struct.unpack(">Q", struct.pack(">d", x))[0])),
             "long": (longs, lambda v: fold(v & (1 << 64) - 1)), "int": ([5, -5, None], lambda v: v),
             "boolean": ([True, False, None], lambda v: 1231 if v else 1237),
             "string": (["s1", "", None], lambda v: 3614 if v else 0)}
    register_functions(spark)
    for kind, (values, want) in cases.items():
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        expected = [None if v is None else want(v) for v in values]
        named = spark.sql("SELECT i, java_hash(v) AS h FROM {df}", df=df)
        assert [r.h for r in named.orderBy("i").collect()] == expected, kind
        assert [r.h for r in df.select("i", java_hash("v").alias("h")).orderBy("i").collect()] == expected, kind
    with pytest.raises(Exception, match="no rule for date"):
        spark.sql("SELECT date'2024-01-01' AS d").select(java_hash("d")).collect()


def test_reduce_fields(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 3), ("s1", 2, 1), ("s2", 3, 4), ("s1", 4, 2)]) \
        .withColumns({"lo": F.col("vc"), "hi": F.col("vc"), "one": F.col("vc"), "end": F.col("vc")})
    fold = {"vc": "sum", "lo": "min", "hi": "max", "one": "first", "end": "last"}
    final = K.reduce_fields(s, ["id"], fold).orderBy("id").collect()
    assert [tuple(r[c] for c in fold) for r in final] == [(6, 1, 3, 3, 2), (4, 4, 4, 4, 4)]
    run = K.reduce_fields(s, ["id"], fold, running=True).orderBy("seq").collect()
    assert [tuple(r[c] for c in fold) for r in run] == [(3, 3, 3, 3, 3), (4, 1, 3, 3, 1), (4, 4, 4, 4, 4), (6, 1, 3, 3, 2)]
    with pytest.raises(ValueError, match="product"):
        K.reduce_fields(s, ["id"], {"vc": "product"})


def test_rich_map_task_number_and_close(spark, tmp_path):
    """Every task knows its number and closes once, also when it fails."""
    def mapped(pdf, ctx):
        if (pdf["id"] < 0).any():
            raise RuntimeError("bad row")
        return pdf.assign(task=ctx["task"])

    def close(ctx):
        (tmp_path / f"{ctx['name']}-{ctx['task']}").touch()
    df = spark.range(0, 40, 1, 4)
    out = X.rich_map(df, mapped, "id long, task int", lambda: {"name": "ok"}, close)
    rows = out.withColumn("pid", F.spark_partition_id()).collect()
    assert len(rows) == 40 and all(r.task == r.pid for r in rows)
    assert sorted(f.name for f in tmp_path.glob("ok-*")) == [f"ok-{i}" for i in range(4)]
    with pytest.raises(Exception, match="bad row"):
        X.rich_map(spark.range(-1, 0, 1, 1), mapped, "id long, task int", lambda: {"name": "failed"}, close).collect()
    assert (tmp_path / "failed-0").exists()


def test_table_names_and_sql_insert(spark, tmp_path):
    """Columns named on the way to a table; T3: INSERT INTO a declared table."""
    named = spark.createDataFrame([("s1", 1, 7), ("s2", 2, 3)]).toDF("id", "ts", "vc")
    spark.sql(f"CREATE TABLE eventide_sink (id STRING, vc BIGINT) USING parquet LOCATION '{tmp_path / 'sink'}'")
    try:
        for _ in range(2):
            spark.sql("INSERT INTO eventide_sink SELECT id, sum(vc) FROM {t} WHERE vc > 5 GROUP BY id", t=named)
        assert [tuple(r) for r in spark.table("eventide_sink").collect()] == [("s1", 7), ("s1", 7)]
    finally:
        spark.sql("DROP TABLE eventide_sink")


def test_value_map_running(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 1), ("s1", 2, 2), ("s2", 3, 1), ("s1", 4, 1), ("s1", 5, 9)])
    got = K.value_map_running(s, ["id"], "vc", [1, 2]).orderBy("seq").collect()
    assert [r.counts for r in got] == [{1: 1}, {1: 1, 2: 1}, {1: 1}, {1: 2, 2: 1}, {1: 2, 2: 1}]


def test_value_counts_running_of_all_levels(spark, sensor_rows):
    from eventide.plans.q_keyed import _value_counts_running
    s = sensor_rows([("s1", 1, -2), ("s1", 2, None), ("s1", 3, -2), ("s1", 4, None), ("s1", 5, 14)])
    got = _value_counts_running(s.select("seq", "id", "vc")).orderBy("seq").collect()
    assert [r.value_count for r in got] == [1, 1, 2, 2, 1]
    assert [r.counts for r in got] == ["-2:1", "-2:1", "-2:2", "-2:2", "-2:2,14:1"]


def test_f21_generator(spark):
    d = G.sequence_source(spark, 100, G.number_string, partitions=2)
    vals = [r.value for r in d.collect()]
    assert len(set(vals)) == 100 and "Number:0" in vals and "Number:99" in vals
    spec = G.table_spec({"id": ("random", 1, 10), "ts": ("sequence", 1, 1000), "vc": ("random", 1, 100)})
    t = G.sequence_source(spark, 1000, spec).agg(F.min("id"), F.max("id"), F.min("ts"), F.max("ts"),
                                                  F.min("vc"), F.max("vc")).first()
    assert tuple(t) == (1, 10, 1, 1000, 1, 100)


def test_g1_jump_alert(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 1), ("s1", 2, 12), ("s1", 3, 13), ("s1", 4, 1)])
    out = S.jump_alert(s, ["id"], "vc").orderBy("seq").collect()
    assert [(r.vc, r.last_value) for r in out] == [(12, 1), (1, 13)]


def test_g2_running_top3(spark, sensor_rows):
    s = sensor_rows([("s1", i, v) for i, v in enumerate([5, 1, 9, 7, 3])])
    out = N.running_top_k(s, ["id"], "vc", 3).orderBy("seq").collect()
    assert [list(r.top3) for r in out] == [[5], [5, 1], [9, 5, 1], [9, 7, 5], [9, 7, 5]]


def test_g3_value_counts_sum_avg(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 1), ("s1", 2, 1), ("s1", 3, 2)])
    vc = K.value_counts_running(s, ["id"], "vc").orderBy("seq").collect()
    assert [r.value_count for r in vc] == [1, 2, 1]
    final = K.value_counts(s, ["id"], "vc").first().counts
    assert final == {1: 2, 2: 1}
    assert [r.v for r in K.running_sum(s, ["id"], "vc", "v").orderBy("seq").collect()] == [1, 2, 4]
    avg = [r.a for r in K.running_avg(s, ["id"], "vc", "a").orderBy("seq").collect()]
    assert avg[:2] == [1.0, 1.0] and abs(avg[2] - 4 / 3) < 1e-12


def test_g4_count_windows(spark, sensor_rows):
    s = sensor_rows([("s1", i, i) for i in range(1, 8)])
    tum = W.count_tumbling(s, ["id"], 5).groupBy("window_no").agg(F.sort_array(F.collect_list("vc")).alias("v"))
    assert [list(r.v) for r in tum.collect()] == [[1, 2, 3, 4, 5]]
    sl = W.count_sliding(s, ["id"], 5, 2).groupBy("window_no").agg(F.sort_array(F.collect_list("vc")).alias("v"))
    assert [list(r.v) for r in sl.orderBy("window_no").collect()] == [[1, 2], [1, 2, 3, 4], [2, 3, 4, 5, 6]]


def test_g5_late_data(spark, sensor_rows):
    s = sensor_rows([("s1", t, t) for t in [1, 5, 13, 9, 15, 8, 4]])
    s = s.withColumn("arr", F.col("seq"))
    c = WM.late_classify(s, ["id"], "ts", ["arr"], 10 * S_, 3 * S_, 2 * S_)
    cls = {r.vc: r["class"] for r in c.collect()}
    assert cls == {1: "on_time", 5: "on_time", 13: "on_time", 9: "late_allowed", 15: "on_time",
                   8: "too_late", 4: "too_late"}
    f = WM.late_window_firings(c, ["id"], "vc", ["arr"]).filter(F.col("window_start") == F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    assert sorted((r.firing, r.n) for r in f.collect()) == [(0, 2), (1, 3)]
    tr = WM.watermark_trace(s, "ts", ["arr"], 3 * S_, chunk=F.floor(F.col("arr") / 2)).orderBy("seq").collect()
    after = [r.wm_after for r in tr]
    assert str(after[2]).endswith("00:00:09.999000") and str(after[4]).endswith("00:00:11.999000")


def test_g6_broadcast_threshold(spark):
    rows = [(1, "data", 3), (2, "config", 5), (3, "data", 6), (4, "data", 4)]
    df = spark.createDataFrame(rows, "seq long, kind string, vc int")
    cfg = F.col("kind") == "config"
    out = J.asof_last(df, cfg, F.col("vc"), "seq", 0).filter(~cfg & (F.col("vc") > F.col("threshold")))
    assert [(r.vc, r.threshold) for r in out.orderBy("seq").collect()] == [(3, 0), (6, 5)]


def test_g7_ttl(spark, sensor_rows):
    s = sensor_rows([("s1", 0, 20), ("s1", 4, 1), ("s1", 8, 1), ("s1", 14, 1)])
    rw = S.ttl_state(s, ["id"], "vc", "ts", 5 * S_, refresh_on_read=True).orderBy("seq")
    wo = S.ttl_state(s, ["id"], "vc", "ts", 5 * S_, refresh_on_read=False).orderBy("seq")
    assert [r.state for r in rw.collect()] == [None, 20, 20, None]
    assert [r.state for r in wo.collect()] == [None, 20, None, None]


def test_g8_timers(spark, sensor_rows):
    s = sensor_rows([("s1", 1, 1), ("s1", 5, 1), ("s1", 9, 1), ("s1", 10, 1), ("s1", 10, 2)])
    out = WM.timers(s, ["id"], "ts", 5 * S_, 3 * S_).orderBy("timer_ts").collect()
    assert [(r.timer_ts.second, r.fired) for r in out] == [(6, True), (10, False), (14, False), (15, False)]


def test_sessions_fixed_and_dynamic(spark, sensor_rows):
    s = sensor_rows([("s1", 0, 1), ("s1", 5, 1), ("s1", 11, 1), ("s1", 30, 1), ("s2", 1, 1)])
    d = W.session(s, ["id"], "ts", "5 s")
    got = sorted((r.id, r.session_no, r.n) for r in
                 d.groupBy("id", "session_no").agg(F.count(F.lit(1)).alias("n")).collect())
    # 0 and 5 touch (gap exactly 5 s) -> one session; 11 and 30 are alone
    assert got == [("s1", 1, 2), ("s1", 2, 1), ("s1", 3, 1), ("s2", 1, 1)]
    dyn = W.session(s, ["id"], "ts", F.col("vc").cast("bigint") * F.lit(20 * S_))
    assert dyn.filter("id = 's1'").agg(F.max("session_no")).first()[0] == 1


def test_ttl_gap_of_exactly_ttl_has_expired(spark, sensor_rows):
    """A value written or refreshed at t expires at t + ttl: a read exactly
    ttl later already sees nothing (both refresh rules)."""
    s = sensor_rows([("s1", 0, 20), ("s1", 5, 1), ("s1", 9, 1)])
    rw = S.ttl_state(s, ["id"], "vc", "ts", 5 * S_, refresh_on_read=True).orderBy("seq")
    wo = S.ttl_state(s, ["id"], "vc", "ts", 5 * S_, refresh_on_read=False).orderBy("seq")
    assert [r.state for r in rw.collect()] == [None, None, None]
    assert [r.state for r in wo.collect()] == [None, None, None]
    s2 = sensor_rows([("s1", 0, 20), ("s1", 4, 1), ("s1", 9, 1)])
    # read at 4 refreshes to 4; 9 - 4 = 5 = ttl -> expired under read+write too
    rw2 = S.ttl_state(s2, ["id"], "vc", "ts", 5 * S_, refresh_on_read=True).orderBy("seq")
    assert [r.state for r in rw2.collect()] == [None, 20, None]
