"""Streams over two inputs with late rows (F3), and state handed on (K7)."""

import glob
import os

from pyspark.sql import functions as F

from eventide.operators import joins as J
from eventide.operators import state as S
from eventide.plans.q_time import ARR
from eventide.sources.sensor import arrival_view, sensor_view
from eventide.streaming import handover as H
from eventide.streaming import operators as SO
from eventide.streaming.interval_late import IntervalJoinLate
from eventide.streaming.replay import replay_stream, write_replay

SF = "/root/testdata/sf0.001"
SPAN, DELAY = 7_200_000_000, 60_000_000          # two hours, a minute


def sides(spark):
    a = arrival_view(spark.read.parquet(f"{SF}/events.parquet"), ("event_type",))
    return a.withColumn("side", F.when(F.col("event_type").isin("click", "view", "signup"), "L").otherwise("R")).drop("event_type")


def test_interval_join_late_stream_equals_batch(spark, tmp_path):
    rows = sides(spark)
    write_replay(rows, f"{tmp_path}/in", 7, "arrival_us")
    got, live = {}, []

    def emit(kind, df, batch_id):
        got[kind, batch_id] = sorted(map(tuple, (df.select("l_seq", "r_seq") if kind == "pair" else df.select("seq")).collect()))

    join = IntervalJoinLate(f"{tmp_path}/state", "side", "id", "ts", ARR, -SPAN, SPAN, DELAY, emit)
    crashed = []

    def run(batch, batch_id):
        join(batch, batch_id)
        if batch_id == 3 and not crashed:                     # the outputs are out, the batch is not committed
            crashed.append(dict(got))
            raise RuntimeError("lost")
        live.append(len(glob.glob(f"{tmp_path}/state/rows/b=*")))

    for _ in range(2):
        q = replay_stream(spark, f"{tmp_path}/in", rows.schema).writeStream.foreachBatch(run) \
            .option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        try:
            q.awaitTermination(300)
        except Exception as e:  # noqa: BLE001
            assert "lost" in str(e)
    assert all(got[k] == v for k, v in crashed[0].items())     # the replay gives the same
    assert len(live) == 7 and max(live) < 7                    # folders of passed batches are gone
    of = lambda kind: sorted(x for (k, _), v in got.items() if k == kind for x in v)
    d = J.late_split_two_inputs(rows, "side", "ts", ARR, DELAY)
    left, right = (d.where(f"NOT late AND side = '{x}'").select(*[F.col(c).alias(f"{x}_{c}") for c in ("seq", "id", "ts")]) for x in "LR")
    pairs = J.interval_join(left, right, "L_id", "R_id", "L_ts", "R_ts", -SPAN, SPAN).select("L_seq", "R_seq")
    assert of("pair") == sorted(map(tuple, pairs.collect())) and len(of("pair")) > 50
    for kind, x in (("late_left", "L"), ("late_right", "R")):
        assert of(kind) == sorted(map(tuple, d.where(f"late AND side = '{x}'").select("seq").collect())) and of(kind)


def _run(spark, df, name, ck):
    q = (df.writeStream.format("memory").queryName(name).outputMode("update").option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(300)


def test_state_is_handed_to_a_query_with_other_slots(spark, tmp_path):
    s = sensor_view(spark.read.parquet(f"{SF}/events.parquet")).select("id", "seq")
    write_replay(s, f"{tmp_path}/all", 6, "seq")
    files = sorted(os.listdir(f"{tmp_path}/all"))
    files = [f for f in files if f.startswith("part-")]
    for folder, some in (("old", files[:3]), ("new", files[3:])):
        os.mkdir(f"{tmp_path}/{folder}")
        for f in some:
            os.link(f"{tmp_path}/all/{f}", f"{tmp_path}/{folder}/{f}")
    first = spark.read.parquet(f"{tmp_path}/old").count()
    assert 0 < first < s.count()

    # 4 slots, then a new query with 3.
    _run(spark, H.slot_counts(replay_stream(spark, f"{tmp_path}/old", s.schema), "id", 4), "ho_old", f"{tmp_path}/ck4")
    entries = H.old_counts(spark, f"{tmp_path}/ck4")
    assert sorted(map(tuple, entries.collect())) == sorted(
        (r.slot, r.cnt) for r in S.durable_count(spark.read.parquet(f"{tmp_path}/old"), "id", 4).collect() if r.slot is not None)
    assert len(H.files_read(spark, f"{tmp_path}/ck4")) == 3
    assert sorted(r.cnt for r in H.union(entries, 3).collect()) == [first] * 3
    new = H.slot_counts(replay_stream(spark, f"{tmp_path}/new", s.schema), "id", 3, H.split(entries, 3))
    _run(spark, new, "ho_new", f"{tmp_path}/ck3")
    assert sum(r.cnt for r in H.old_counts(spark, f"{tmp_path}/ck3").collect()) == s.count()

    # A state of another schema (one entry per key group) becomes that of 5 slots.
    _run(spark, SO.key_group_counts(replay_stream(spark, f"{tmp_path}/old", s.schema), "id"), "ho_kg", f"{tmp_path}/ckg")
    groups = H.old_group_counts(spark, f"{tmp_path}/ckg")
    by_range = groups.groupBy(S.slot_of_group(F.col("slot"), 5).alias("slot")).agg(F.sum("cnt").alias("cnt"))
    _run(spark, H.slot_counts(replay_stream(spark, f"{tmp_path}/new", s.schema), "id", 5, by_range), "ho_five", f"{tmp_path}/ck5")
    got = sorted((r.slot, r.cnt) for r in H.old_counts(spark, f"{tmp_path}/ck5").collect())
    assert got == sorted((r.slot, r.cnt) for r in S.durable_count(s, "id", 5).collect() if r.slot is not None)
