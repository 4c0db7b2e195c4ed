import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from eventide.session import local_session
    s = local_session(cpus=4, shuffle_partitions=4, app="eventide-tests")
    # Tiny chunks so every fixture exercises both levels of the prefix scans.
    s.conf.set("eventide.scan.chunkRows", "2")
    s.conf.set("eventide.scan.chunkMicros", "3000000")
    yield s
    s.stop()


@pytest.fixture
def sensor_rows(spark):
    """Build a sensor DataFrame ``(id, ts, vc, seq)`` from ``(id, ts_seconds, vc)``
    tuples in arrival order (seq from 1)."""
    from pyspark.sql import functions as F

    def make(rows):
        data = [(i, t, v, n + 1) for n, (i, t, v) in enumerate(rows)]
        df = spark.createDataFrame(data, "id string, ts_s bigint, vc int, seq bigint")
        return df.select("id", F.timestamp_seconds("ts_s").cast("timestamp_ntz").alias("ts"), "vc", "seq")
    return make
