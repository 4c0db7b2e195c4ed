"""Streaming replay throughput: ``events`` replayed as 10 files, one per
micro-batch, through three streaming operators; prints one JSON line of
rows/s (input rows over wall time of the whole run, start-up included).

    python tools/stream_bench.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from eventide.operators import joins as J  # noqa: E402
from eventide.session import local_session  # noqa: E402
from eventide.sources.sensor import sensor_view  # noqa: E402
from eventide.streaming import operators as SO  # noqa: E402
from eventide.streaming import processors as P  # noqa: E402
from eventide.streaming.replay import replay_stream, write_replay  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    base = tempfile.mkdtemp(prefix="eventide-stream-bench-")
    s = sensor_view(spark.read.parquet(f"{sf}/events.parquet")).withColumn("ts", F.col("ts").cast("timestamp"))
    write_replay(s, f"{base}/in", 10, "seq")
    n = s.count()

    def timed(name, df, mode="append"):
        t0 = time.perf_counter()
        q = (df.writeStream.format("noop").outputMode(mode).option("checkpointLocation", f"{base}/ck_{name}")
             .trigger(availableNow=True).start())
        q.awaitTermination(1800)
        return round(n / (time.perf_counter() - t0), 1)

    src = lambda: replay_stream(spark, f"{base}/in", s.schema)
    out = {}
    st = SO.with_event_time(src(), "ts", 20 * 60 * 1000)
    out["tumbling_window"] = timed("win", SO.window_aggregate(
        st, ["id"], "event_time", "1 hour", [F.count(F.lit(1)).alias("n"), F.sum("vc").alias("vc_sum")]))
    st = SO.with_event_time(src(), "ts", 2 * 3600 * 1000)
    left = st.filter(F.col("vc") % 2 == 0).select(F.col("seq").alias("l_seq"), F.col("id").alias("l_id"),
                                                  F.col("event_time").alias("l_ts"))
    right = st.filter(F.col("vc") % 2 == 1).select(F.col("seq").alias("r_seq"), F.col("id").alias("r_id"),
                                                   F.col("event_time").alias("r_ts"))
    out["interval_join"] = timed("ij", J.stream_interval_join(left, right, "l_id", "r_id", "l_ts", "r_ts",
                                                               "-30 minutes", "30 minutes"))
    out["keyed_state"] = timed("state", P.apply(src(), "id", P.JumpAlert(10), P.JUMP_SCHEMA))
    print(json.dumps({"metric": "stream_rows_per_sec", "unit": "rows/s", "rows": n, "files": 10,
                      "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "queries": out}))
    spark.stop()


if __name__ == "__main__":
    main()
