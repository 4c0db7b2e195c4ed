"""Text sources and record parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from eventide.sources.sensor import epoch_s


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A2: one row per line (``value``)."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, directory: str, max_files: int | None = None) -> DataFrame:
    """A2/A3: an unbounded line stream from files arriving in a directory
    (replayable, takes the place of a socket)."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(directory)


def parse_fields(df: DataFrame, line: str, schema: T.StructType, sep: str = ",",
                 mode: str = "route") -> DataFrame:
    """Split a delimited line into typed fields.

    ``mode='fail'`` casts strictly (a bad row fails the job, like the
    reference); ``mode='route'`` uses ``try_cast`` and adds ``valid`` so bad
    rows can be sent to a reject output instead.
    """
    parts = F.split(F.col(line), sep, -1)
    cols, checks = [], [F.size(parts) == len(schema.fields)]
    for i, f in enumerate(schema.fields):
        raw = F.trim(parts.getItem(i))
        if mode == "fail":
            cols.append(raw.cast(f.dataType).alias(f.name))
        else:
            v = raw.try_cast(f.dataType)
            cols.append(v.alias(f.name))
            checks.append(v.isNotNull() | (raw == "") & F.lit(isinstance(f.dataType, T.StringType)))
    out = df.select(*cols)
    if mode == "fail":
        return out
    valid = checks[0]
    for c in checks[1:]:
        valid = valid & c
    return df.select(*cols, valid.alias("valid"))


def sensor_lines(sensor: DataFrame) -> DataFrame:
    """The sensor view as the reference's text records ``id,ts,vc`` (ts in
    epoch seconds)."""
    return sensor.select(F.concat_ws(",", "id", epoch_s("ts").cast("string"),
                                     F.col("vc").cast("string")).alias("value"))
