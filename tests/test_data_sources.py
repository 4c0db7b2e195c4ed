"""The generator as a source and the sinks that commit or print, as data sources."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventide.sinks import committed as C
from eventide.sources import datagen
from eventide.sources import generators as G

SPEC = {"fields.id.kind": "random", "fields.id.min": "1", "fields.id.max": "10", "fields.ts.kind": "sequence", "fields.ts.start": "1",
        "fields.vc.kind": "random", "fields.vc.min": "1", "fields.vc.max": "100"}
SCHEMA = "id int, ts bigint, vc int"


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    datagen.register(spark)
    C.register(spark)


def options(**more):
    return ", ".join(f"'{k}' = '{v}'" for k, v in {**SPEC, **more}.items())


# ------------------------------------------------------------------- generator
def test_declared_table_equals_the_columns(spark):
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW ev_source (id INT, ts BIGINT, vc INT) USING eventide_datagen OPTIONS ({options(**{'fields.ts.end': 100_000})})")
    spec = G.table_spec({"id": ("random", 1, 10), "ts": ("sequence", 1, 100_000), "vc": ("random", 1, 100)})
    want = G.sequence_source(spark, 200_000, spec)
    got = spark.table("ev_source")
    assert got.dtypes == [("id", "int"), ("ts", "bigint"), ("vc", "int")] and got.rdd.getNumPartitions() == 8
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    sums = spark.sql("SELECT id, sum(vc) AS total FROM ev_source WHERE id > 5 GROUP BY id").collect()
    assert sorted(map(tuple, sums)) == sorted(map(tuple, want.where("id > 5").groupBy("id").agg(F.sum("vc")).collect()))


def test_generator_options(spark):
    read = lambda schema, **o: spark.read.format("eventide_datagen").schema(schema).options(**o).load()
    assert [r.value for r in read("value bigint", **{"number-of-rows": 3, "fields.value.kind": "sequence"}).orderBy("value").collect()] == [0, 1, 2]
    assert read(SCHEMA, **SPEC, **{"fields.ts.end": 7, "number-of-rows": 5}).count() == 5
    assert read(SCHEMA, **SPEC, **{"fields.ts.end": 0}).count() == 0
    assert read("x string, y double", **{"number-of-rows": 4, "fields.y.min": 2, "fields.y.max": 2, "fields.y.kind": "random"}).distinct().count() == 4
    for schema, o in ((SCHEMA, SPEC), ("d date", {"number-of-rows": 1}), ("x int", {"number-of-rows": 1, "fields.x.kind": "odd"})):
        with pytest.raises(Exception, match="number-of-rows|no generator for date|unknown generator"):
            read(schema, **o).count()


def test_stream_restart_loses_and_repeats_nothing(spark, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    begin = time.time() - 20
    for run in range(3):
        stream = (spark.readStream.format("eventide_datagen").schema(SCHEMA)
                  .options(**SPEC, **{"start-time": begin, "rows-per-second": 50, "fields.ts.end": 3000}).load())
        q = stream.writeStream.format("eventide_committed").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        got = [r.ts for r in spark.read.format("eventide_committed").load(out).select("ts").collect()]
        assert sorted(got) == list(range(1, len(got) + 1))
        assert 1000 <= len(got) <= min(3000, (time.time() - begin) * 50)         # the rate limit
        if run == 1:                                                             # crashed before its batch was marked as done
            commits = sorted((p for p in os.listdir(f"{ck}/commits") if p.isdigit()), key=int)
            for name in (commits[-1], f".{commits[-1]}.crc"):
                if os.path.exists(f"{ck}/commits/{name}"):
                    os.remove(f"{ck}/commits/{name}")


def test_stream_needs_a_start(spark):
    stream = spark.readStream.format("eventide_datagen").schema(SCHEMA).options(**SPEC).load()
    with pytest.raises(Exception, match="start-time"):
        stream.writeStream.format("noop").trigger(availableNow=True).start().awaitTermination(60)


# ------------------------------------------------------------------------ sinks
def test_insert_into_and_overwrite(spark, tmp_path):
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW ev_sink (id INT, total BIGINT) USING eventide_committed OPTIONS (path '{tmp_path}/sink')")
    now = lambda: spark.read.format("eventide_committed").schema("id int, total bigint").load(f"{tmp_path}/sink")
    assert now().count() == 0
    spark.sql("INSERT INTO ev_sink SELECT CAST(id AS INT), id * 2 FROM range(0, 100, 1, 4)")
    spark.sql("INSERT INTO ev_sink VALUES (-1, NULL)")
    assert now().agg(F.count("*"), F.sum("total"), F.min("id")).first() == (101, 9900, -1)
    rows = spark.range(5).select(F.col("id").cast("int"), F.col("id").alias("total"))
    rows.write.format("eventide_committed").option("path", f"{tmp_path}/sink").mode("overwrite").save()
    assert now().count() == 5
    assert spark.read.format("eventide_committed").load(f"{tmp_path}/sink").dtypes == [("id", "int"), ("total", "bigint")]


def test_a_task_that_runs_twice_is_there_once(tmp_path):
    schema = StructType.fromDDL("v bigint")
    import pyarrow as pa
    rows = lambda *v: iter([pa.RecordBatch.from_pydict({"v": pa.array(v, pa.int64())})])
    w = C.CommittedStreamWriter(str(tmp_path / "t"), schema, "stream")
    read = lambda: sorted(v for f in w.folder.files() for b in w.folder.read(f) for v in b.column("v").to_pylist())

    def broken():
        yield next(rows(1, 2))
        raise RuntimeError("the executor is gone")
    with pytest.raises(RuntimeError):
        w.write(broken())
    lost = w.write(rows(1, 2))                                   # a second attempt, whose message got lost
    first, other = w.write(rows(1, 2)), w.write(rows(3))
    assert lost.name != first.name and read() == []              # nothing counts before the commit
    w.commit([first, None, other], 0)
    assert read() == [1, 2, 3]
    w.commit([w.write(rows(1, 2, 3))], 0)                        # the batch is replayed
    assert read() == [1, 2, 3]
    gone = w.write(rows(4))
    w.abort([gone, None], 1)
    assert read() == [1, 2, 3] and not os.path.exists(tmp_path / "t" / gone.name)
    w.commit([], 1)                                              # an empty batch
    C.CommittedStreamWriter(str(tmp_path / "t"), schema, "second").commit([w.write(rows(9))], 0)
    assert read() == [1, 2, 3, 9]


def test_a_failing_job_leaves_nothing(spark, tmp_path):
    bad = spark.range(0, 40, 1, 4).select(F.when(F.col("id") == 35, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("bigint").alias("v"))
    with pytest.raises(Exception, match="no"):
        bad.write.format("eventide_committed").option("path", f"{tmp_path}/t").mode("append").save()
    spark.range(3).toDF("v").write.format("eventide_committed").option("path", f"{tmp_path}/t").mode("append").save()
    assert spark.read.format("eventide_committed").load(f"{tmp_path}/t").count() == 3


def test_print_table_prints_in_the_tasks(spark, capsys):
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW ev_print (id INT, total BIGINT) USING eventide_print OPTIONS (label 'out')")
    spark.sql("INSERT INTO ev_print SELECT CAST(id AS INT), id FROM range(3)")          # on the tasks' output
    table = C.PrintTable({"label": "out"})
    table.writer(StructType.fromDDL("id int"), False).write(iter(["a", "b"]))            # what a task does
    assert capsys.readouterr().out == "out> a\nout> b\n"
    C.PrintTable({"stderr": "true"}).streamWriter(StructType.fromDDL("id int"), False).write(iter(["c"]))
    assert capsys.readouterr().err.endswith("c\n")
