"""Stream equals batch: replay inputs as files, one per micro-batch."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from eventide.operators import joins as J
from eventide.operators import state as S
from eventide.operators import topn as N
from eventide.operators import windows as W
from eventide.sources.sensor import sensor_view
from eventide.streaming import operators as SO
from eventide.streaming import processors as P
from eventide.streaming.replay import replay_stream, run_to_end, write_replay

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def replayed(spark):
    """sensor view of sf0.001 events in 6 arrival-ordered files."""
    d = tempfile.mkdtemp(prefix="eventide-replay-")
    s = sensor_view(spark.read.parquet(f"{SF}/events.parquet"))
    s = s.withColumn("ts", F.col("ts").cast("timestamp"))
    write_replay(s, f"{d}/in", 6, "seq")
    return d, s


def _stream(spark, replayed):
    d, s = replayed
    return replay_stream(spark, f"{d}/in", s.schema)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_window_aggregate_stream_equals_batch(spark, replayed):
    d, s = replayed
    st = SO.with_event_time(_stream(spark, replayed), "ts", 0)
    agg = SO.window_aggregate(st, ["id"], "event_time", "1 hour",
                              [F.count(F.lit(1)).alias("n"), F.sum("vc").alias("vc_sum")])
    run_to_end(agg, "st_win", f"{d}/ck_win")
    got = _rows(spark.table("st_win"), ["id", "window_start", "n", "vc_sum"])
    final_wm = s.agg(F.max("ts")).first()[0]
    batch = W.tumbling(s, "ts", "1 h").groupBy("id", "window_start", "window_end") \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("vc").alias("vc_sum"))
    # append mode emits windows the final watermark has passed
    closed = batch.filter(F.col("window_end") <= F.lit(final_wm) - F.expr("INTERVAL 1 MILLISECOND"))
    assert got == _rows(closed, ["id", "window_start", "n", "vc_sum"]) and len(got) > 100


def test_running_count_update_mode(spark, replayed):
    d, s = replayed
    st = SO.running_count(_stream(spark, replayed), ["id"])
    run_to_end(st, "st_cnt", f"{d}/ck_cnt", mode="update")
    got = {r.id: r.c for r in spark.table("st_cnt").groupBy("id").agg(F.max("cnt").alias("c")).collect()}
    want = {r.id: r.c for r in s.groupBy("id").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert got == want


def test_stream_interval_join_equals_batch(spark, replayed):
    d, s = replayed
    st = SO.with_event_time(_stream(spark, replayed), "ts", 2 * 3600 * 1000)
    left = st.filter(F.col("vc") % 2 == 0).select(F.col("seq").alias("l_seq"), F.col("id").alias("l_id"),
                                                  F.col("event_time").alias("l_ts"))
    right = st.filter(F.col("vc") % 2 == 1).select(F.col("seq").alias("r_seq"), F.col("id").alias("r_id"),
                                                   F.col("event_time").alias("r_ts"))
    j = J.stream_interval_join(left, right, "l_id", "r_id", "l_ts", "r_ts", "-30 minutes", "30 minutes")
    run_to_end(j.select("l_seq", "r_seq"), "st_ij", f"{d}/ck_ij")
    bl = s.filter(F.col("vc") % 2 == 0).select(F.col("seq").alias("l_seq"), F.col("id").alias("l_id"),
                                               F.col("ts").alias("l_ts"))
    br = s.filter(F.col("vc") % 2 == 1).select(F.col("seq").alias("r_seq"), F.col("id").alias("r_id"),
                                               F.col("ts").alias("r_ts"))
    want = J.interval_join(bl, br, "l_id", "r_id", "l_ts", "r_ts", -1800 * 10**6, 1800 * 10**6)
    assert _rows(spark.table("st_ij"), ["l_seq", "r_seq"]) == _rows(want, ["l_seq", "r_seq"])


def test_processors_work_in_blocks(monkeypatch):
    """Rows of a key in several frames, read and emitted in blocks, in order."""
    import pandas as pd
    from eventide.streaming import processors as P

    class Value:
        def __init__(self):
            self.v = None

        def exists(self):
            return self.v is not None

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

    monkeypatch.setattr(P, "BLOCK", 3)
    avg = P.RunningAverage()
    avg.acc = Value()
    frames = [pd.DataFrame({"seq": seqs, "vc": [10 * n for n in seqs], "id": "a"}) for seqs in ([7, 1, 4], [2, 6], [], [5, 3])]
    out = list(avg.handleInputRows(("a",), iter(frames), None))
    assert [len(f) for f in out] == [3, 3, 1]
    got = pd.concat(out)
    assert got["seq"].tolist() == list(range(1, 8)) and got["vc_sum"].tolist() == [10, 30, 60, 100, 150, 210, 280]
    assert avg.acc.v == (280, 7) and list(avg.handleInputRows(("a",), iter([]), None)) == []


def test_jump_alert_processor_equals_batch(spark, replayed):
    d, s = replayed
    out = P.apply(_stream(spark, replayed), "id", P.JumpAlert(10), P.JUMP_SCHEMA)
    run_to_end(out, "st_jump", f"{d}/ck_jump")
    want = S.jump_alert(s, ["id"], "vc")
    cols = ["id", "seq", "vc", "last_value"]
    assert _rows(spark.table("st_jump"), cols) == _rows(want, cols)


def test_running_average_processor_equals_batch(spark, replayed):
    from eventide.operators import keyed as K
    d, s = replayed
    run_to_end(P.apply(_stream(spark, replayed), "id", P.RunningAverage(), P.AVERAGE_SCHEMA), "st_avg", f"{d}/ck_avg")
    got = {r.seq: (r.vc_sum, round(r.vc_avg, 9)) for r in spark.table("st_avg").collect()}
    sums = {r.seq: r.v for r in K.running_sum(s, ["id"], "vc", "v").collect()}
    avgs = {r.seq: round(r.a, 9) for r in K.running_avg(s, ["id"], "vc", "a").collect()}
    assert got == {q: (v, avgs[q]) for q, v in sums.items()} and len(got) > 100


def test_value_counts_processor_equals_batch(spark, replayed):
    from eventide.operators import keyed as K
    d, s = replayed
    run_to_end(P.apply(_stream(spark, replayed), "id", P.ValueCounts(), P.MAP_SCHEMA), "st_map", f"{d}/ck_map")
    got = {r.seq: r.counts for r in spark.table("st_map").collect()}
    batch = K.value_map_running(s, ["id"], "vc", range(15)).collect()
    assert got == {r.seq: ",".join(f"{k}:{n}" for k, n in sorted(r.counts.items())) for r in batch}


def test_topk_processor_equals_batch(spark, replayed):
    d, s = replayed
    out = P.apply(_stream(spark, replayed), "id", P.RunningTopK(3), P.TOPK_SCHEMA)
    run_to_end(out, "st_topk", f"{d}/ck_topk")
    got = sorted((r.seq, list(r.top)) for r in spark.table("st_topk").collect())
    want = sorted((r.seq, list(r.top3)) for r in N.running_top_k(s, ["id"], "vc", 3).collect())
    assert got == want


def test_count_window_processor_equals_batch(spark, replayed):
    d, s = replayed
    out = P.apply(_stream(spark, replayed), "id", P.CountWindow(5, 2), P.COUNT_SCHEMA)
    run_to_end(out, "st_cw", f"{d}/ck_cw")
    got = sorted((r.id, r.window_no, tuple(r.vcs)) for r in spark.table("st_cw").collect())
    b = W.count_sliding(s, ["id"], 5, 2).groupBy("id", "window_no") \
        .agg(F.sort_array(F.collect_list(F.struct("seq", "vc"))).alias("l"))
    want = sorted((r.id, r.window_no, tuple(x.vc for x in r.l)) for r in b.collect())
    assert got == want


def test_event_time_timers_fixture_g8(spark, tmp_path):
    base = str(tmp_path)
    rows = [("s1", 1000), ("s1", 5000), ("s1", 9000), ("s1", 10000)]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "id string, ts_ms long, seq long")
    df = df.withColumn("ts", F.timestamp_millis("ts_ms"))
    write_replay(df, f"{base}/in", 4, "seq")
    st = replay_stream(spark, f"{base}/in", df.schema).withWatermark("ts", "3001 milliseconds")
    out = P.apply(st, "id", P.EventTimeTimers(5000), P.TIMER_SCHEMA, time_mode="EventTime")
    run_to_end(out, "st_timer", f"{base}/ck")
    got = [(r.timer_ms, r.watermark_ms) for r in spark.table("st_timer").collect()]
    assert got == [(6000, 6999)]


def test_idempotent_batch_replay(spark, tmp_path):
    from eventide.sinks.exactly_once import idempotent_batch_writer, read_committed
    out = str(tmp_path / "out")
    w = idempotent_batch_writer(out)
    b0 = spark.range(10)
    w(b0, 0)
    w(spark.range(10, 15), 1)
    w(b0, 0)                      # batch 0 replayed after a failure
    assert read_committed(spark, out).count() == 15


def test_bucketed_file_stream(spark, replayed, tmp_path):
    from eventide.sinks.files import read_bucketed_text, stream_bucketed_text
    d, s = replayed
    lines = _stream(spark, replayed).select(F.concat_ws(",", "id", F.col("vc").cast("string")).alias("line"), "ts")
    q = stream_bucketed_text(lines, str(tmp_path / "files"), str(tmp_path / "ck"), "ts", "line",
                             max_records=100).trigger(availableNow=True).start()
    q.awaitTermination(120)
    back = read_bucketed_text(spark, str(tmp_path / "files"))
    assert back.count() == s.count()
    assert back.select("bucket").distinct().count() == s.select(F.date_format("ts", "yyyy-MM-dd HH")).distinct().count()


def test_jdbc_sink_derby(spark, tmp_path):
    from eventide.sinks.jdbc import write_jdbc
    os.environ.setdefault("DERBY_HOME", str(tmp_path))
    url = "jdbc:derby:memory:eventide_ws;create=true"
    rows = spark.createDataFrame([("s1", 1, 1), ("s2", 3, 3), ("s3", 3, 3), ("s4", 3, 3)],
                                 "id string, ts long, vc int")
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    try:
        write_jdbc(rows, url, "ws", batch_rows=100, properties=props)
    except Exception as e:  # noqa: BLE001
        if "ClassNotFound" in str(e) or "No suitable driver" in str(e):
            pytest.skip("Derby driver not on the classpath")
        raise
    assert spark.read.jdbc(url, "ws", properties=props).count() == 4


def test_custom_row_sink(spark, tmp_path):
    from eventide.sinks.custom import RowSink
    out = str(tmp_path)

    def opener(pid, epoch):
        return {"f": open(os.path.join(out, f"p{pid}.txt"), "w")}

    def proc(ctx, row):
        ctx["f"].write(f"{row.id}\n")

    def closer(ctx, err):
        ctx["f"].close()

    spark.range(20).repartition(3).foreachPartition(RowSink(proc, opener, closer).run_partition)
    n = sum(len(open(os.path.join(out, f)).read().split()) for f in os.listdir(out))
    assert n == 20


def test_queue_options():
    from eventide.sinks.queue import queue_sink_options
    from eventide.sources.queue import queue_source_options
    o = queue_source_options("h:9092", "t", "earliest", read_committed=True)
    assert o["startingOffsets"] == "earliest" and o["kafka.isolation.level"] == "read_committed"
    assert queue_sink_options("h:9092", "t", "/ck")["topic"] == "t"
    with pytest.raises(ValueError):
        queue_source_options("h:9092", "t", "middle")


def test_durable_count_survives_restart_and_rescale(spark, replayed, tmp_path):
    from eventide.operators import state as St
    d, s = replayed
    src = f"{d}/in"
    files = sorted(f for f in os.listdir(src) if f.endswith(".parquet"))
    first = str(tmp_path / "first")
    os.makedirs(first)
    for f in files[:3]:
        os.link(os.path.join(src, f), os.path.join(first, f))
    ck = str(tmp_path / "ck")

    def run(path, name):
        st = replay_stream(spark, path, s.schema)
        q = (SO.key_group_counts(st, "id").writeStream.format("memory").queryName(name)
             .outputMode("complete").option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination(120)

    run(first, "kg1")
    # restart on the same checkpoint after more files arrived in the source folder
    for f in files[3:]:
        os.link(os.path.join(src, f), os.path.join(first, f))
    run(first, "kg2")
    kg = spark.table("kg2")
    for slots in (2, 4):
        got = sorted(((r.slot is None, r.slot or 0), r.cnt) for r in St.slot_counts(kg, slots).collect())
        want = sorted(((r.slot is None, r.slot or 0), r.cnt) for r in St.durable_count(s, "id", slots).collect())
        assert got == want


def test_config_threshold_per_batch(spark, replayed, tmp_path):
    d, s = replayed
    cfg_path = str(tmp_path / "cfg")
    spark.createDataFrame([(1, 9), (2, 12)], "seq long, threshold int").write.parquet(cfg_path)
    out = str(tmp_path / "alerts")
    sink = lambda df, bid: df.write.mode("append").parquet(out)
    fn = SO.config_threshold_batch(lambda: spark.read.parquet(cfg_path), sink)
    q = _stream(spark, replayed).writeStream.foreachBatch(fn) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == s.filter(F.col("vc") > 12).count()
    assert got.filter(F.col("threshold") != 12).count() == 0


def test_processing_time_window_counts_every_row(spark, replayed):
    d, s = replayed
    st = _stream(spark, replayed).withWatermark("ts", "0 seconds")
    agg = SO.processing_time_window(st, ["id"], "1 hour", [F.count(F.lit(1)).alias("n")])
    run_to_end(agg, "st_proc", f"{d}/ck_proc", mode="update")
    per = spark.table("st_proc").groupBy("id", "window_start").agg(F.max("n").alias("n"))
    assert per.agg(F.sum("n")).first()[0] == s.count()


def test_union_watermark_policy_min_vs_max(spark, tmp_path):
    """Two inputs, one far behind.  With the default 'min' policy the
    slow input holds the combined watermark back, so its window stays open;
    with 'max' the fast input's watermark closes it."""
    def side(rows, path):
        df = spark.createDataFrame(rows, "id string, t long, seq long").withColumn("ts", F.timestamp_seconds("t"))
        write_replay(df, path, 1, "seq")
        return df.schema

    sch = side([("a", 100 + i, i) for i in range(5)], str(tmp_path / "fast"))
    side([("b", 1 + i, 10 + i) for i in range(5)], str(tmp_path / "slow"))
    emitted = {}
    try:
        for policy in ("min", "max"):
            spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
            fast = replay_stream(spark, str(tmp_path / "fast"), sch).withWatermark("ts", "1 second")
            slow = replay_stream(spark, str(tmp_path / "slow"), sch).withWatermark("ts", "1 second")
            agg = SO.window_aggregate(fast.unionByName(slow), [], "ts", "10 seconds",
                                      [F.count(F.lit(1)).alias("n")])
            run_to_end(agg, f"wm_{policy}", str(tmp_path / f"ck_{policy}"))
            emitted[policy] = sorted((r.window_start.second, r.n) for r in spark.table(f"wm_{policy}").collect())
    finally:
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    assert emitted["min"] == []            # watermark = min(103 s, 4 s): [0,10) still open
    assert emitted["max"] == [(0, 5)]      # watermark = 103 s: [0,10) closed and emitted


def test_print_sink_labels(spark, capsys):
    from eventide.sinks.console import print_batch, print_rows
    print_batch("warn")(spark.range(3), 0)                    # on the tasks' output
    print_rows("warn").run_partition(spark.range(3).collect())
    assert capsys.readouterr().out.count("warn> ") == 3


def test_ttl_processor_processing_time(spark, tmp_path):
    """K6 on the wall clock: ttl 20 s, reads 12 s apart.  Read-and-write refresh
    keeps the value alive; write-only refresh lets it expire.  (Polls the
    committed output: processAllAvailable never returns with processing-time
    state, which keeps scheduling batches.)"""
    import time as _t
    src = tmp_path / "src"
    src.mkdir()
    schema = "id string, seq long, vc int"
    queries = []

    def rows(out):
        try:
            return spark.read.parquet(out).count()
        except Exception:  # noqa: BLE001  (no committed file yet)
            return 0

    try:
        for refresh in (True, False):
            name = f"ttl_{refresh}"
            out = str(tmp_path / name)
            st = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src))
            q = (P.apply(st, "id", P.TtlValue(20000, refresh), P.TTL_SCHEMA, time_mode="ProcessingTime")
                 .writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", str(tmp_path / f"ck_{name}"))
                 .trigger(processingTime="250 milliseconds").start())
            queries.append((q, out, refresh))
        # warm-up row on another key: Python workers start before the clock matters
        # s1 files are written 12 s apart (a batch starts right after its file),
        # so each read sees an age of ~12 s < ttl, and two steps ~24 s > ttl.
        feed = [("s0", 0)] + [("s1", vc) for vc in (20, 1, 1)]
        last_write = None
        for i, (key, vc) in enumerate(feed):
            if last_write is not None and i > 1:
                _t.sleep(max(0.0, last_write + 12.0 - _t.time()))
            last_write = _t.time()
            (src / f"f{i}.json").write_text(f'{{"id": "{key}", "seq": {i}, "vc": {vc}}}\n')
            deadline = _t.time() + 60
            while any(rows(out) < i + 1 for _, out, _ in queries):
                assert _t.time() < deadline, "stream did not process the file in time"
                _t.sleep(0.1)
            assert i < 2 or _t.time() - last_write < 10.0, "batches too slow for the wall-clock test"
        results = {refresh: [r.state for r in spark.read.parquet(out).filter("id = 's1'").orderBy("seq").collect()]
                   for _, out, refresh in queries}
    finally:
        for q, _, _ in queries:
            q.stop()
    assert results[True] == [None, 20, 20]
    assert results[False] == [None, 20, None]


def test_rate_generator_stream(spark, tmp_path):
    from eventide.sources.generators import number_string, sequence_stream
    import time as _t
    st = sequence_stream(spark, 20, lambda i: [number_string(i), i.alias("i")])
    q = st.writeStream.format("memory").queryName("rate_gen").option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="500 milliseconds").start()
    _t.sleep(4)
    q.stop()
    got = sorted(r.i for r in spark.table("rate_gen").collect())
    assert got and got == list(range(len(got)))
    assert spark.table("rate_gen").filter(F.col("value") == "Number:0").count() == 1


def test_stateless_operators_stream_equals_batch(spark, replayed):
    """C1-C4, D1-D3, A9, B5, U1 are row-wise: the same function on the stream
    gives the batch result."""
    from pyspark.sql import types as T

    from eventide.functions import java_hash
    from eventide.operators import transforms as X
    from eventide.sinks.queue import encode_key_value
    from eventide.sources.text import parse_fields, sensor_lines

    d, s = replayed
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("ts", T.LongType()),
                           T.StructField("vc", T.IntegerType())])
    ops = {
        "map": lambda df: df.transform(X.map_project("seq", "id")),
        "filter": lambda df: df.transform(X.filter_eq("id", "s1")).select("seq", "vc"),
        "flatmap": lambda df: X.flat_map(df, X.sensor_flatmap_outputs(), keep=["seq"]),
        "route": lambda df: X.route(df, {"s1": F.col("id") == "s1"}).select("seq", "route"),
        "tee": lambda df: X.tee(df, {"warn": F.col("vc") > 10}).select("seq", "output"),
        "parity": lambda df: X.parity_split(df, "vc").select("seq", "parity"),
        "parse": lambda df: parse_fields(sensor_lines(df), "value", schema),
        "kv": lambda df: encode_key_value(df.select(F.concat_ws(",", "id", "vc").alias("l")), "l"),
        "hash": lambda df: df.select("seq", java_hash("id").alias("h")),
    }
    for name, op in ops.items():
        run_to_end(op(_stream(spark, replayed)), f"sl_{name}", f"{d}/ck_sl_{name}")
        got = spark.table(f"sl_{name}")
        cols = got.columns
        assert _rows(got, cols) == _rows(op(s), cols), name


def test_late_windows_stream_equals_batch(spark, tmp_path):
    """W8 streaming (foreachBatch with own state) equals the batch replay:
    same late side output, same main firings and re-firings."""
    from eventide.operators import watermark as WM
    from eventide.sources.sensor import arrival_view
    from eventide.streaming.late import LateWindows

    # sf0.01: enough rows beyond the allowed lateness to test the side output
    a = arrival_view(spark.read.parquet("/root/testdata/sf0.01/events.parquet"))
    write_replay(a, str(tmp_path / "in"), 6, "arrival_us")
    out = str(tmp_path / "out")

    def emit(kind, df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/{kind}/batch_id={batch_id}")

    size, delay, lateness = 3600 * 10**6, 1200 * 10**6, 1200 * 10**6
    lw = LateWindows(str(tmp_path / "state"), ["id"], "ts", ["arrival_us", "seq"], "vc",
                     size, delay, lateness, emit)
    q = replay_stream(spark, str(tmp_path / "in"), a.schema).writeStream.foreachBatch(lw) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    last = q.lastProgress["batchId"]
    assert last >= 5
    assert sorted(os.listdir(tmp_path / "state")) == sorted([f"v={last - 1}", f"v={last}"])
    firings = spark.read.parquet(f"{out}/firing").drop("batch_id").unionByName(lw.flush(spark, last, a))
    c = WM.late_classify(a, ["id"], "ts", ["arrival_us", "seq"], size, delay, lateness)
    want = WM.late_window_firings(c, ["id"], "vc", ["arrival_us", "seq"])
    cols = ["id", "window_start", "firing", "n", "vc_sum"]
    assert _rows(firings, cols) == _rows(want, cols)
    late_got = sorted(r.seq for r in spark.read.parquet(f"{out}/late").collect())
    late_want = sorted(r.seq for r in c.filter(F.col("class") == "too_late").collect())
    assert late_got == late_want and len(late_want) > 0


def test_late_windows_late_only_window_across_batches(spark, tmp_path):
    """A window reached only by late-but-allowed rows, one per micro-batch:
    its re-firings keep counting across batches."""
    from eventide.streaming.late import LateWindows
    S1 = 1_000_000
    # (ts seconds, arrival order): window [0,10) never gets an on-time row
    rows = [("s1", 30, 1, 1), ("s1", 9, 2, 2), ("s1", 8, 3, 3)]
    df = spark.createDataFrame(rows, "id string, t long, vc int, seq long") \
        .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz")).withColumn("arr", F.col("seq"))
    write_replay(df, str(tmp_path / "in"), 3, "seq")
    out = str(tmp_path / "out")

    def emit(kind, d, batch_id):
        d.write.mode("overwrite").parquet(f"{out}/{kind}/batch_id={batch_id}")

    # delay 20 s, lateness 15 s: after ts 30 the watermark is 9.999 s, so
    # [0,10) has fired (empty) and rows at 9 and 8 are late but allowed
    lw = LateWindows(str(tmp_path / "state"), ["id"], "ts", ["arr"], "vc", 10 * S1, 20 * S1, 15 * S1, emit)
    q = replay_stream(spark, str(tmp_path / "in"), df.schema).writeStream.foreachBatch(lw) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r.firing, r.n, r.vc_sum) for r in spark.read.parquet(f"{out}/firing")
                 .filter(F.col("window_start") == F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).collect())
    assert got == [(1, 1, 2), (2, 2, 5)]


def test_event_time_timer_delete_variant(spark, tmp_path):
    """K8 delete variant: a new timer replaces the pending one."""
    rows = [("s1", 1000), ("s1", 5000), ("s1", 30000)]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "id string, ts_ms long, seq long")
    df = df.withColumn("ts", F.timestamp_millis("ts_ms"))
    write_replay(df, str(tmp_path / "in"), 3, "seq")
    got = {}
    for delete in (False, True):
        st = replay_stream(spark, str(tmp_path / "in"), df.schema).withWatermark("ts", "3001 milliseconds")
        out = P.apply(st, "id", P.EventTimeTimers(5000, delete_previous=delete), P.TIMER_SCHEMA,
                      time_mode="EventTime")
        run_to_end(out, f"st_tdel_{delete}", str(tmp_path / f"ck_{delete}"))
        got[delete] = sorted(r.timer_ms for r in spark.table(f"st_tdel_{delete}").collect())
    assert got[False] == [6000, 10000]      # watermark 26.999 s after the last row
    assert got[True] == []                  # 6 s and 10 s were replaced; 35 s not reached


def test_processing_time_timer_fires(spark, tmp_path):
    """K9: a timer 1 s after a row is seen fires on the wall clock.  (Polls the
    committed output; the query keeps running batches on its own.)"""
    import time as _t
    src = tmp_path / "src"
    src.mkdir()
    out = str(tmp_path / "out")
    st = spark.readStream.schema("id string, seq long").json(str(src))
    q = (P.apply(st, "id", P.ProcessingTimeTimers(1000), P.TIMER_SCHEMA, time_mode="ProcessingTime")
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(processingTime="250 milliseconds").start())
    try:
        (src / "f0.json").write_text('{"id": "s1", "seq": 0}\n')
        deadline = _t.time() + 90
        n = 0
        while n == 0 and _t.time() < deadline:
            _t.sleep(0.5)
            try:
                n = spark.read.parquet(out).count()
            except Exception:  # noqa: BLE001  (nothing committed yet)
                n = 0
    finally:
        q.stop()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1 and rows[0].id == "s1" and rows[0].watermark_ms >= rows[0].timer_ms


def test_session_window_stream_equals_batch(spark, replayed):
    d, s = replayed
    st = SO.with_event_time(_stream(spark, replayed), "ts", 0)
    agg = SO.session_aggregate(st, ["id"], "event_time", "2 hours", [F.count(F.lit(1)).alias("n")])
    run_to_end(agg, "st_sess", f"{d}/ck_sess")
    got = _rows(spark.table("st_sess"), ["id", "window_start", "window_end", "n"])
    b = W.session(s, ["id"], "ts", "2 h")
    batch = b.groupBy("id", "session_no").agg(*W.session_bounds([F.count(F.lit(1)).alias("n")]))
    final_wm = s.agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(final_wm).cast("timestamp_ntz")
                          - F.expr("INTERVAL 1 MILLISECOND"))
    want = [(i, a.replace(tzinfo=None), e.replace(tzinfo=None), n)
            for i, a, e, n in _rows(closed, ["id", "window_start", "window_end", "n"])]
    got = [(i, a.replace(tzinfo=None), e.replace(tzinfo=None), n) for i, a, e, n in got]
    assert got == want and len(got) > 50


def test_stream_window_join_equals_batch(spark, replayed):
    d, s = replayed
    st = SO.with_event_time(_stream(spark, replayed), "ts", 2 * 3600 * 1000)
    left = st.filter(F.col("vc") % 2 == 0).select(F.col("seq").alias("l_seq"), F.col("id").alias("l_id"),
                                                  F.col("event_time").alias("l_ts"))
    right = st.filter(F.col("vc") % 2 == 1).select(F.col("seq").alias("r_seq"), F.col("id").alias("r_id"),
                                                   F.col("event_time").alias("r_ts"))
    j = J.stream_window_join(left, right, "l_id", "r_id", "l_ts", "r_ts", "1 hour")
    run_to_end(j.select("l_seq", "r_seq"), "st_wj", f"{d}/ck_wj")
    bl = s.filter(F.col("vc") % 2 == 0).select(F.col("seq").alias("l_seq"), F.col("id").alias("l_id"),
                                               F.col("ts").alias("l_ts"))
    br = s.filter(F.col("vc") % 2 == 1).select(F.col("seq").alias("r_seq"), F.col("id").alias("r_id"),
                                               F.col("ts").alias("r_ts"))
    want = J.window_join(bl, br, "l_id", "r_id", "l_ts", "r_ts", 3600 * 10**6)
    assert _rows(spark.table("st_wj"), ["l_seq", "r_seq"]) == _rows(want, ["l_seq", "r_seq"])


def test_keyed_and_windowed_aggregates_on_streams(spark, replayed):
    """G4-G8, U2, K3 (update mode, final values) and H2, H9, I1, I2
    (watermarked windows, append mode): the library functions run unchanged
    on a stream and their final results equal the batch results."""
    from eventide.functions import weighted_avg
    from eventide.operators import keyed as K

    d, s = replayed
    keyed = {
        "sum": lambda df: K.reduce_sums(df, ["id"], ["vc"]),
        "max_by": lambda df: K.extreme_row(df, ["id"], "vc", ["seq", "vc"]),
        "min_by": lambda df: K.extreme_row(df, ["id"], "vc", ["seq", "vc"], use_min=True),
        "max_first": lambda df: K.max_keep_first(df, ["id"], "vc", ["seq"]),
        "wavg": lambda df: df.groupBy("id").agg(F.round(weighted_avg(F.col("vc").cast("long"),
                                                                     F.col("seq") % 5 + 1), 6).alias("w")),
        "value_counts": lambda df: df.groupBy("id", "vc").agg(F.count(F.lit(1)).alias("n")),
    }
    for name, op in keyed.items():
        out = op(_stream(spark, replayed))
        run_to_end(out, f"ka_{name}", f"{d}/ck_ka_{name}", mode="complete")
        cols = out.columns
        assert _rows(spark.table(f"ka_{name}"), cols) == _rows(op(s), cols), name

    _stream(spark, replayed).createOrReplaceTempView("sensor_stream")
    q = spark.sql("SELECT id, sum(vc) AS vc_sum FROM sensor_stream WHERE vc > 5 GROUP BY id")
    run_to_end(q, "ka_sql", f"{d}/ck_ka_sql", mode="complete")
    s.createOrReplaceTempView("sensor_batch")
    want = spark.sql("SELECT id, sum(vc) AS vc_sum FROM sensor_batch WHERE vc > 5 GROUP BY id")
    assert _rows(spark.table("ka_sql"), ["id", "vc_sum"]) == _rows(want, ["id", "vc_sum"])

    final_wm = s.agg(F.max("ts")).first()[0]
    windowed = {
        "sliding": (["id"], "30 minutes", [F.count(F.lit(1)).alias("n")]),
        "all": ([], None, [F.count(F.lit(1)).alias("n"), F.sum("vc").alias("vc_sum")]),
        "first_last": (["id"], None, [F.min_by("seq", "seq").alias("first"), F.max_by("seq", "seq").alias("last")]),
    }
    for name, (keys, slide, aggs) in windowed.items():
        st = SO.with_event_time(_stream(spark, replayed), "ts", 0)
        run_to_end(SO.window_aggregate(st, keys, "event_time", "1 hour", aggs, slide=slide),
                   f"kw_{name}", f"{d}/ck_kw_{name}")
        got = spark.table(f"kw_{name}")
        bs = W.sliding(s, "ts", "1 h", "30 min") if slide else W.tumbling(s, "ts", "1 h")
        want = bs.groupBy(*keys, "window_start", "window_end").agg(*aggs) \
            .filter(F.col("window_end") <= F.lit(final_wm) - F.expr("INTERVAL 1 MILLISECOND"))
        cols = [c for c in got.columns if c != "window_end"]
        assert _rows(got, cols) == _rows(want, cols), name


def test_union_and_text_operators_on_streams(spark, tmp_path):
    """A2/A3 line stream, C4/U3 word split with lengths, E1 union: run on
    streams and equal the batch results."""
    from eventide.operators import transforms as X
    from eventide.sources.text import read_lines, stream_lines

    src = tmp_path / "lines"
    src.mkdir()
    texts = ["hello spark", "hello world hi ", "", "   ", "hello java"]
    for i, t in enumerate(texts):
        (src / f"f{i}.txt").write_text(t + "\n")
    st = stream_lines(spark, str(src), max_files=1).withColumn("doc_id", F.lit(0))
    words = J.lateral_words(st, "value", ["doc_id"])
    run_to_end(words, "tx_words", str(tmp_path / "ck_w"))
    batch = J.lateral_words(read_lines(spark, str(src)).withColumn("doc_id", F.lit(0)), "value", ["doc_id"])
    assert _rows(spark.table("tx_words"), ["word", "length"]) == _rows(batch, ["word", "length"])
    assert _rows(batch, ["word", "length"]) == sorted(
        [("hello", 5), ("spark", 5), ("hello", 5), ("world", 5), ("hi", 2), ("", 0), ("hello", 5), ("java", 4)])

    a = stream_lines(spark, str(src)).select(F.length("value").alias("v"))
    b = stream_lines(spark, str(src)).select((F.length("value") * 10).alias("v"))
    run_to_end(X.union_all(a, b), "tx_union", str(tmp_path / "ck_u"))
    got = sorted(r.v for r in spark.table("tx_union").collect())
    want = sorted([len(t) for t in texts] + [10 * len(t) for t in texts])
    assert got == want


def test_changelog_stream_equals_batch(spark, replayed, tmp_path):
    """T5 streaming: the change rows of a group-by sum, per input row, across
    micro-batches, equal the batch changelog."""
    from eventide.streaming.changelog import ChangelogSum
    d, s = replayed
    out = str(tmp_path / "out")

    def emit(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    cl = ChangelogSum(str(tmp_path / "state"), ["id"], "vc", "seq", emit)
    q = _stream(spark, replayed).writeStream.foreachBatch(cl) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    last = q.lastProgress["batchId"]
    assert sorted(os.listdir(tmp_path / "state")) == sorted([f"v={last - 1}", f"v={last}"])
    cols = ["id", "seq", "op_no", "op", "vc_sum"]
    got = spark.read.parquet(out).drop("batch_id")
    assert _rows(got, cols) == _rows(S.changelog(s.select("id", "seq", "vc"), ["id"], "vc"), cols)


@pytest.mark.parametrize("group", [["window_end"], ["id", "window_end"]])
def test_stream_top_n_equals_batch(spark, replayed, group, tmp_path):
    """J2 (all sensors) and J3 (per sensor) over sliding windows."""
    from eventide.sinks.exactly_once import idempotent_batch_writer, read_committed
    d, s = replayed
    st = SO.with_event_time(_stream(spark, replayed), "ts", 0)
    keys = [c for c in group if c != "window_end"]
    counts = SO.window_aggregate(st, [*keys, "vc"], "event_time", "1 hour", [F.count(F.lit(1)).alias("cnt")], slide="30 minutes")
    out = str(tmp_path / "out")
    fn = SO.top_n_batches(group, [F.desc("cnt"), F.asc("vc")], 2, idempotent_batch_writer(out))
    q = counts.writeStream.foreachBatch(fn).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    final_wm = s.agg(F.max("ts")).first()[0]
    batch = N.count_top_n(W.sliding(s, "ts", "1 h", "30 min"), group, "vc", 2)
    closed = batch.filter(F.col("window_end") <= F.lit(final_wm) - F.expr("INTERVAL 1 MILLISECOND"))
    cols = [*group, "vc", "cnt", "rank"]
    got = _rows(read_committed(spark, out), cols)
    assert got == _rows(closed, cols) and len(got) > 100


def test_config_as_a_stream_changes_mid_batch(spark, replayed, tmp_path):
    """thresholds arrive inside the micro-batches and carry over to the next."""
    from eventide.sinks.exactly_once import idempotent_batch_writer, read_committed
    d, s = replayed
    out = str(tmp_path / "out")
    fn = SO.ConfigThreshold(str(tmp_path / "state"), "seq % 37 = 0", "vc", "seq", idempotent_batch_writer(out))
    q = _stream(spark, replayed).writeStream.foreachBatch(fn).option("checkpointLocation", str(tmp_path / "ck")) \
        .trigger(availableNow=True).start()
    q.awaitTermination(300)
    cfg = F.col("seq") % 37 == 0
    batch = J.asof_last(s, cfg, F.col("vc"), "seq", 0).filter(~cfg & (F.col("vc") > F.col("threshold")))
    cols = ["seq", "vc", "threshold"]
    assert _rows(read_committed(spark, out), cols) == _rows(batch, cols)
    assert len(os.listdir(tmp_path / "state")) == 6 and batch.select("threshold").distinct().count() > 3
    first = _rows(spark.read.parquet(f"{out}/batch_id=5"), cols)
    part = sorted(f for f in os.listdir(f"{d}/in") if f.startswith("part-"))[5]
    fn(spark.read.schema(s.schema).parquet(f"{d}/in/{part}"), 5)      # a replayed batch
    assert _rows(spark.read.parquet(f"{out}/batch_id=5"), cols) == first and first


def test_processing_time_sliding_and_sessions(spark, replayed):
    """H5: every row is counted in each window of its batch's time."""
    d, s = replayed
    n = s.count()
    count = [F.count(F.lit(1)).alias("n")]
    run_to_end(SO.processing_time_window(_stream(spark, replayed), ["id"], "1 hour", count, slide="30 minutes"),
               "st_pt_slide", f"{d}/ck_pt_slide", mode="complete")
    assert spark.table("st_pt_slide").agg(F.sum("n")).first()[0] == 2 * n
    run_to_end(SO.processing_time_session(_stream(spark, replayed), ["id"], "1 hour", count),
               "st_pt_sess", f"{d}/ck_pt_sess", mode="complete")
    assert spark.table("st_pt_sess").agg(F.sum("n")).first()[0] == n
    assert spark.table("st_pt_sess").count() == s.select("id").distinct().count()


def test_dynamic_gap_session_stream_equals_batch(spark, replayed):
    """H4: every row brings its own gap."""
    d, s = replayed
    st = SO.with_event_time(_stream(spark, replayed), "ts", 0)
    gap = F.make_interval(mins=(F.col("vc") + 1) * 10)
    run_to_end(SO.session_aggregate(st, ["id"], "event_time", gap, [F.count(F.lit(1)).alias("n")]), "st_dyn", f"{d}/ck_dyn")
    batch = W.session_windows(s, ["id"], "ts", (F.col("vc") + 1).cast("long") * F.lit(600 * 10**6), {"n": ("count", F.lit(1))})
    final_wm = s.agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(final_wm).cast("timestamp_ntz") - F.expr("INTERVAL 1 MILLISECOND"))
    cols = ["id", "window_start", "window_end", "n"]
    got = spark.table("st_dyn").withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols[1:3]})
    assert _rows(got, cols) == _rows(closed, cols) and len(_rows(got, cols)) > 50


def test_changelog_processor_equals_batch(spark, replayed):
    """T5 on the state store: each batch touches only its own keys."""
    d, s = replayed
    run_to_end(P.apply(_stream(spark, replayed), "id", P.KeyChangelog(), P.CHANGELOG_SCHEMA), "st_kcl", f"{d}/ck_kcl")
    cols = ["id", "seq", "op_no", "op", "vc_sum"]
    assert _rows(spark.table("st_kcl"), cols) == _rows(S.changelog(s, ["id"], "vc"), cols)


def test_keyed_connect_on_streams_within_a_time_bound(spark, replayed):
    """E3 on streams: equal keys, times at most two hours apart, so that the
    state of both sides ends."""
    d, s = replayed
    st = SO.with_event_time(_stream(spark, replayed), "ts", 3 * 3600 * 1000)

    def side(df, rest, p, ts):
        return df.filter(F.col("vc") % 2 == rest).select(F.col("seq").alias(f"{p}_seq"), F.col("id").alias(f"{p}_id"), F.col(ts).alias(f"{p}_ts"))
    j = J.stream_interval_join(side(st, 0, "l", "event_time"), side(st, 1, "r", "event_time"), "l_id", "r_id", "l_ts", "r_ts",
                               "-2 hours", "2 hours")
    run_to_end(j.select("l_seq", "r_seq"), "st_e3", f"{d}/ck_e3")
    want = J.keyed_match(side(s, 0, "l", "ts"), side(s, 1, "r", "ts"), "l_id", "r_id") \
        .where("abs(unix_micros(l_ts) - unix_micros(r_ts)) <= 7200000000L")
    assert _rows(spark.table("st_e3"), ["l_seq", "r_seq"]) == _rows(want, ["l_seq", "r_seq"])
