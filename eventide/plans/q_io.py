"""Sources and sinks with query forms."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from eventide.session import shared_dir
from eventide.sinks.files import read_bucketed_text, write_bucketed_text
from eventide.sinks.queue import encode_key_value as encode_kv
from eventide.sources import datagen, generators as G
from eventide.sources.text import parse_fields, sensor_lines
from eventide.plans.registry import query, sensor, with_sensor
from eventide.sources.tables import table
from eventide.sources.sensor import epoch_s

M, P = G.MULT2, G.MODULUS


def _mix_sql(i: str, salt: int) -> str:
    x = f"((({i} + {salt * 1_000_003}) % {P} + {P}) % {P} + 1)"
    h = f"(({x} * {M}) % {P})"
    return f"(({h} * {M}) % {P})"


_IDX = "(SELECT event_id AS i FROM events)"


@query("gen_sequence", f"SELECT 'Number:' || CAST(i AS VARCHAR) AS value FROM {_IDX}")
def gen_sequence(spark, sf):
    """A4: the generator mapped over the events' numbers: ``"Number:" + i``."""
    return G.generate(table(spark, sf, "events"), "event_id", G.number_string)


@query("gen_sensor", f"""SELECT 's' || CAST(1 + {_mix_sql('i', 1)} % 3 AS VARCHAR) AS id,
        CAST(i // 3 AS BIGINT) AS ts, CAST({_mix_sql('i', 2)} % 15 AS INTEGER) AS vc, i AS seq FROM {_IDX}""")
def gen_sensor(spark, sf):
    """A5: the synthetic sensor stream (ids s1-s3, vc 0..14, 3 rows/s)."""
    return G.generate(table(spark, sf, "events"), "event_id", G.sensor_row)


@query("gen_table_spec", f"""SELECT CAST(1 + {_mix_sql('i', 1)} % 10 AS INTEGER) AS id,
        CAST(1 + i AS BIGINT) AS ts, CAST(1 + {_mix_sql('i', 3)} % 100 AS INTEGER) AS vc FROM {_IDX} WHERE i < 1000000""")
def gen_table_spec(spark, sf):
    """A table declared by per-column generators, used through SQL."""
    spec = {"id": ("random", 1, 10), "ts": ("sequence", 1, 1_000_000), "vc": ("random", 1, 100)}
    # salts follow the spec's column order: id 1, ts 2, vc 3
    source = G.generate(table(spark, sf, "events"), "event_id", G.table_spec(spec))
    return spark.sql("SELECT id, ts, vc FROM {source}", source=source)


@query("gen_source", f"""SELECT e.event_id, e.event_type, CAST(1 + {_mix_sql('i', 1)} % 10 AS INTEGER) AS id,
        CAST(1 + i AS BIGINT) AS ts, CAST(1 + {_mix_sql('i', 3)} % 100 AS INTEGER) AS vc
    FROM {_IDX} g JOIN events e ON e.event_id = g.i""")
def gen_source(spark, sf):
    """The declared generator as a data source, as long as the events' numbers,
    joined to the event of each row's number."""
    datagen.register(spark)
    events = table(spark, sf, "events").select("event_id", "event_type")
    rows = events.agg(F.max("event_id") + 1).first()[0] or 0
    options = {"number-of-rows": rows, "fields.id.kind": "random", "fields.id.min": 1, "fields.id.max": 10, "fields.ts.kind": "sequence",
               "fields.ts.start": 1, "fields.vc.kind": "random", "fields.vc.min": 1, "fields.vc.max": 100}
    source = spark.read.format(datagen.NAME).schema("id int, ts bigint, vc int").options(**options).load()
    return events.join(source, F.col("event_id") == F.col("ts") - 1).select("event_id", "event_type", "id", "ts", "vc")


@query("parse_sensor_line", with_sensor(
    "SELECT id, epoch_us(ts) // 1000000 AS ts, vc, true AS valid FROM sensor"))
def parse_sensor_line(spark, sf):
    """``id,ts,vc`` text records parsed into typed rows (bad rows are
    routed with ``valid = false`` instead of failing the job)."""
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("ts", T.LongType()),
                           T.StructField("vc", T.IntegerType())])
    return parse_fields(sensor_lines(sensor(spark, sf)), "value", schema)


@query("bucketed_files", with_sensor(
    "SELECT id || ',' || CAST(epoch_us(ts) // 1000000 AS VARCHAR) || ',' || CAST(vc AS VARCHAR) AS value, "
    "strftime(ts, '%Y-%m-%d %H') AS bucket FROM sensor"))
def bucketed_files(spark, sf):
    """Sensor records written as text under hourly bucket folders in the
    shared folder, read back."""
    s = sensor(spark, sf)
    lines = s.select(F.concat_ws(",", "id", epoch_s("ts").cast("string"),
                                 F.col("vc").cast("string")).alias("line"), "ts")
    path = shared_dir(spark, "bucketed_files")
    write_bucketed_text(lines, path, "ts", "line", max_records=1_000_000)
    return read_bucketed_text(spark, path)


@query("encode_key_value", with_sensor(
    "SELECT hex(encode(id)) AS key, hex(encode(CAST(vc AS VARCHAR))) AS value FROM sensor"))
def encode_key_value(spark, sf):
    """``k,v`` records to key / value bytes (shown as hex)."""
    kv = sensor(spark, sf).select(F.concat_ws(",", "id", F.col("vc").cast("string")).alias("line"))
    return encode_kv(kv, "line").select(F.hex("key").alias("key"), F.hex("value").alias("value"))
