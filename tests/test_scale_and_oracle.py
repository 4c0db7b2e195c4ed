"""Two-level scan against a plain window; distribution; every registered
query against its DuckDB oracle on the smallest tables."""

import random

import duckdb
import pytest
from pyspark.sql import Window, functions as F

from eventide.operators import distribution as D
from eventide.operators import scan
from tools.check_oracle import rows_of
from collections import Counter

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_running_matches_plain_window(spark, width):
    rnd = random.Random(width)
    # one hot key with half of the rows, many small keys, some nulls
    data = [(("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(20)}"), n, rnd.choice([None, 1, 5, 9, -3]))
            for n in range(400)]
    df = spark.createDataFrame(data, "k string, seq long, v int")
    got = scan.running(df, ["k"], "seq", {"s": ("sum", F.col("v")), "c": ("count", F.col("v")),
                                          "mx": ("max", F.col("v")), "mn": ("min", F.col("v"))},
                       chunk=F.floor(F.col("seq") / width))
    got_x = scan.running(df, ["k"], "seq", {"s": ("sum", F.col("v")), "c": ("count", F.col("v"))},
                         chunk=F.floor(F.col("seq") / width), exclusive=True)
    w = Window.partitionBy("k").orderBy("seq")
    inc = w.rowsBetween(Window.unboundedPreceding, 0)
    exc = w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("k", "seq", F.sum("v").over(inc).alias("s"), F.count("v").over(inc).alias("c"),
                     F.max("v").over(inc).alias("mx"), F.min("v").over(inc).alias("mn"))
    want_x = df.select("k", "seq", F.sum("v").over(exc).alias("s"), F.count("v").over(exc).alias("c"))
    cols = ["k", "seq", "s", "c", "mx", "mn"]
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == \
        sorted(tuple(r[c] for c in cols) for r in want.collect())
    assert sorted(tuple(r) for r in got_x.select("k", "seq", "s", "c").collect()) == \
        sorted(tuple(r) for r in want_x.collect())


def test_previous_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 10), (None, 2, 20), ("a", 3, 30), (None, 4, 40)],
                               "k string, seq long, v int")
    got = scan.previous(df, ["k"], "seq", F.col("v"), "p", chunk=F.col("seq"))
    assert sorted((r.seq, r.p) for r in got.collect()) == [(1, None), (2, 10), (3, None), (4, 20)]


def test_custom_partitioner_places_rows(spark):
    df = spark.createDataFrame([(f"s{i}",) for i in range(50)], "id string")
    out = D.custom(df, "id", 4).withColumn("pid", F.spark_partition_id())
    assert out.filter(F.col("pid") != F.col("slot")).count() == 0
    rep = D.replicate(df, 3).withColumn("pid", F.spark_partition_id())
    assert rep.count() == 150 and rep.filter(F.col("pid") != F.col("task")).count() == 0


def test_key_partition_colocates(spark):
    from eventide.operators.keyed import key_partition
    df = spark.createDataFrame([(f"s{i % 7}", i) for i in range(100)], "id string, n long")
    per = key_partition(df, ["id"], 5).withColumn("pid", F.spark_partition_id()) \
        .groupBy("id").agg(F.countDistinct("pid").alias("p"))
    assert per.filter(F.col("p") > 1).count() == 0


def test_all_queries_match_oracle(spark):
    import __spark_entry__ as E
    con = duckdb.connect()
    from eventide.sources.tables import TABLES
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    bad = []
    for name in sorted(qs):
        df = qs[name](spark, SF)
        a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
        if name not in sqls:
            continue
        res = con.execute(sqls[name])
        b, bc = rows_of([d[0] for d in res.description], res.fetchall())
        if ac != bc or Counter(a) != Counter(b):
            bad.append(name)
    assert bad == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "window_start" in df.columns


def test_hot_key_is_spread_over_tasks(spark):
    """One key with a third of all rows: the two-level scan processes it in
    several partitions (a keyed window sorts the whole key in one task)."""
    rnd = random.Random(7)
    data = [("hot" if n % 3 == 0 else f"k{rnd.randrange(200)}", n, 1) for n in range(6000)]
    df = spark.createDataFrame(data, "k string, seq long, v int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scan.running(df, ["k"], "seq", {"s": ("sum", F.col("v"))}, chunk=F.floor(F.col("seq") / 300))
        # partition id taken before filtering (no filter pushdown past it)
        parts = out.withColumn("p", F.spark_partition_id()).filter("k = 'hot'") \
            .select("p").distinct().count()
        # and the result is still exact: the hot key's running sum is its row number
        hot = out.filter("k = 'hot'").orderBy("seq").select("s").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1
    assert [r.s for r in hot] == list(range(1, 2001))


def test_burst_minute_is_spread_over_tasks(spark):
    """A minute that holds every row: the global scan handles it in several
    partitions, one per second of arrival."""
    df = spark.range(6000).selectExpr("id as seq", "(id * 7919) % 60000 * 1000 as arr")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scan.running(df, [], ["arr", "seq"], {"n": ("count", F.lit(1))},
                           chunk=scan.micros_chunk(df, "arr", scan.DEFAULT_CHUNK_MICROS))
        rows = out.withColumn("p", F.spark_partition_id()).orderBy("arr", "seq").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.n for r in rows] == list(range(1, 6001))
    assert len({r.p for r in rows}) > 1


def test_no_shared_folder_is_a_clear_error():
    from eventide.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        conf, sparkContext = Conf(), Context()  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")


def test_print_batch_prints_every_row(spark, tmp_path, monkeypatch):
    """In the tasks: the printed lines are read from the tasks' own output."""
    from eventide.sinks import console
    from eventide.sinks.custom import RowSink
    lines = str(tmp_path / "lines")

    def show(_, row):
        with open(lines, "a") as out:
            out.write(f"p> {row}\n")

    monkeypatch.setattr(console, "print_rows", lambda label, to_stderr: RowSink(show))
    console.print_batch("p")(spark.range(25), 0)
    assert sorted(open(lines).read().splitlines()) == sorted(f"p> Row(id={i})" for i in range(25))


def test_print_stream_prints_in_the_tasks(spark, capsys, tmp_path):
    from eventide.sinks.console import print_rows, print_stream
    print_rows("p").run_partition(iter(range(25)))
    assert capsys.readouterr().out.count("p> ") == 25
    spark.range(25).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    q = print_stream(stream, "p").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination()
    assert q.exception() is None and q.recentProgress[0]["numInputRows"] == 25
    assert "p> " not in capsys.readouterr().out  # not on the driver


def test_sequence_ends(spark):
    from eventide.sources import generators as G
    got = G.sequence_source(spark, 50, G.table_spec({"ts": ("sequence", 5, 14), "r": ("random", 1, 3)})).collect()
    assert sorted(r.ts for r in got) == list(range(5, 15))


def test_extreme_row_leaves_nulls_out(spark):
    from eventide.operators.keyed import extreme_row
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, 5), ("a", 4, 2), ("b", 5, None)], "id string, seq bigint, vc int")
    assert {r.id: r.seq for r in extreme_row(df, ["id"], "vc", ["seq", "vc"]).collect()} == {"a": 2, "b": None}
    assert {r.id: r.seq for r in extreme_row(df, ["id"], "vc", ["seq", "vc"], use_min=True).collect()} == {"a": 4, "b": None}


@pytest.mark.parametrize("gap", ["fixed", "dynamic"])
def test_session_windows_match_the_row_form(spark, gap):
    """Microsecond times and gaps, touching and just missing spans, one hot key."""
    from eventide.operators import windows as W
    rnd = random.Random(7)
    data = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(6)}", rnd.randrange(4000), rnd.randrange(1, 40), n)
            for n in range(900)]
    data += [("touch", 0, 5, 900), ("touch", 5, 5, 901), ("miss", 0, 5, 902), ("miss", 6, 5, 903), (None, 3, 5, 904)]
    df = spark.createDataFrame(data, "id string, us long, g long, seq long") \
        .withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz"))
    width = "0.005 ms" if gap == "fixed" else F.col("g")
    got = W.session_windows(df, ["id"], "ts", width, {"n": ("count", F.lit(1)), "s": ("sum", F.col("g")), "m": ("max", F.col("seq"))})
    rows = W.session(df, ["id"], "ts", width).groupBy("id", "session_no").agg(*W.session_bounds(
        [F.count(F.lit(1)).alias("n"), F.sum("g").alias("s"), F.max("seq").alias("m")])).drop("session_no")
    assert got.columns == rows.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, rows.collect()))


def test_session_windows_leave_out_rows_without_a_time_or_gap(spark):
    from eventide.operators import windows as W
    df = spark.createDataFrame([("a", 1, 5), ("a", None, 5), ("a", 2, None), ("a", 3, 0)], "id string, us long, g long") \
        .withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz"))
    assert [r.n for r in W.session_windows(df, ["id"], "ts", F.col("g"), {"n": ("count", F.lit(1))}).collect()] == [1]
    none = W.session_windows(df.where("false"), ["id"], "ts", "1 s", {"n": ("count", F.lit(1))})
    assert none.collect() == []


def test_count_windows_match_the_row_forms(spark):
    from eventide.operators import windows as W
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.choice("aab"), n, n % 7) for n in range(61)], "id string, seq long, vc int")
    vs = F.sort_array(F.collect_list("seq")).alias("v")
    for size, slide in [(5, None), (5, 2), (3, 3), (2, 5)]:
        got = W.count_windows(df, ["id"], [vs], size, slide)
        rows = W.count_tumbling(df, ["id"], size) if slide is None else W.count_sliding(df, ["id"], size, slide)
        want = rows.groupBy("id", "window_no").agg(vs)
        assert Counter((r.id, r.window_no, tuple(r.v)) for r in got.collect()) == \
            Counter((r.id, r.window_no, tuple(r.v)) for r in want.collect()), (size, slide)
