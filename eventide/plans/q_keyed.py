"""Keyed aggregation, final and running (G*, K3-K5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions import user
from eventide.functions.text import words
from eventide.operators import keyed as K
from eventide.operators.map_scan import value_map
from eventide.operators.transforms import split_lines
from eventide.operators.word_scan import running_word_count
from eventide.plans.q_basic import DOC_LINES_SQL, doc_words
from eventide.plans.registry import query, sensor, with_sensor
from eventide.sources.sensor import LEVELS, epoch_s
from eventide.sources.tables import table

RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query("key_partition", with_sensor("SELECT id, seq, vc FROM sensor"))
def key_partition(spark, sf):
    """G1: rows of a key on one task (content unchanged; placement is
    checked by the test suite with ``spark_partition_id``)."""
    return K.key_partition(sensor(spark, sf).select("id", "seq", "vc"), ["id"])


@query("word_count", f"WITH {DOC_LINES_SQL} SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM w GROUP BY word")
def word_count(spark, sf):
    """Batch word count over whole documents."""
    return doc_words(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query("word_count_running", f"""WITH {DOC_LINES_SQL}
    SELECT doc_id, line_no, word_no, word,
           CAST(count(*) OVER (PARTITION BY word ORDER BY doc_id, line_no, word_no {RUN}) AS BIGINT) AS cnt
    FROM w""")
def word_count_running(spark, sf):
    """The running count of each word in text order (one row per word
    occurrence).  Two-level scan of lines dealt by ranges of 1,024 documents, with
    the counts of the words in front of each range."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return running_word_count(split_lines(docs, "text", ["doc_id"]), "line", ["doc_id", "line_no"],
                              F.floor(F.col("doc_id") / 1024), words)


@query("keyed_sum", with_sensor("SELECT id, CAST(sum(vc) AS BIGINT) AS vc FROM sensor GROUP BY id"))
def keyed_sum(spark, sf):
    """G4 final / H8 global window: sum per key."""
    return sensor(spark, sf).groupBy("id").agg(F.sum("vc").cast("bigint").alias("vc"))


@query("keyed_sum_running", with_sensor(
    f"SELECT seq, id, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq {RUN}) AS BIGINT) AS vc FROM sensor"))
def keyed_sum_running(spark, sf):
    """G4 running: the keyed ``sum("vc")`` emitting after every row."""
    return K.running_sum(sensor(spark, sf).select("seq", "id", "vc"), ["id"], "vc", "vc_run") \
        .select("seq", "id", F.col("vc_run").alias("vc"))


@query("state_running_sum", with_sensor(
    f"SELECT seq, id, vc, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq {RUN}) AS BIGINT) AS vc_sum FROM sensor"))
def state_running_sum(spark, sf):
    """K4: reducing state holding the running sum; emitted per row."""
    return K.running_sum(sensor(spark, sf).select("seq", "id", "vc"), ["id"], "vc", "vc_sum")


@query("state_running_avg", with_sensor(
    f"""SELECT seq, id, vc, round(sum(vc) OVER (PARTITION BY id ORDER BY seq {RUN}) * 1.0
               / count(vc) OVER (PARTITION BY id ORDER BY seq {RUN}), 6) AS vc_avg FROM sensor"""))
def state_running_avg(spark, sf):
    """K5: aggregating state (sum, count) -> running average."""
    d = K.running_avg(sensor(spark, sf).select("seq", "id", "vc"), ["id"], "vc", "vc_avg")
    return d.withColumn("vc_avg", F.round("vc_avg", 6))


def _first_and(agg):
    return with_sensor(f"""SELECT id, arg_min(ts, seq) AS ts, CAST(min(seq) AS BIGINT) AS seq,
                                  {agg}(vc) AS vc FROM sensor GROUP BY id""")


@query("keyed_max_first", _first_and("max"))
def keyed_max_first(spark, sf):
    """``max("vc")`` - only vc changes; ts/seq stay from the first row."""
    return K.max_keep_first(sensor(spark, sf), ["id"], "vc", ["ts", "seq"])


@query("keyed_min_first", _first_and("min"))
def keyed_min_first(spark, sf):
    return K.max_keep_first(sensor(spark, sf), ["id"], "vc", ["ts", "seq"], use_min=True)


@query("keyed_max_by", with_sensor("""SELECT id, ts, seq, vc FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY vc DESC, seq) AS r FROM sensor) WHERE r = 1"""))
def keyed_max_by(spark, sf):
    """``maxBy("vc")`` - the whole row with the largest vc, first on ties."""
    return K.extreme_row(sensor(spark, sf), ["id"], "vc", ["ts", "seq", "vc"])


@query("keyed_min_by", with_sensor("""SELECT id, ts, seq, vc FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY vc, seq) AS r FROM sensor) WHERE r = 1"""))
def keyed_min_by(spark, sf):
    return K.extreme_row(sensor(spark, sf), ["id"], "vc", ["ts", "seq", "vc"], use_min=True)


def _with_ts_s(df):
    return df.withColumn("ts_s", epoch_s("ts"))


@query("keyed_reduce", with_sensor("""SELECT id, CAST(sum(epoch_us(ts) // 1000000) AS BIGINT) AS ts_s,
    CAST(sum(vc) AS BIGINT) AS vc FROM sensor GROUP BY id"""))
def keyed_reduce(spark, sf):
    """User fold summing ts (epoch seconds) and vc per key."""
    return K.reduce_sums(_with_ts_s(sensor(spark, sf)).select("id", "ts_s", "vc"), ["id"], ["ts_s", "vc"])


_REDUCE_SQL = with_sensor(f"""SELECT seq, id,
    CAST(sum(epoch_us(ts) // 1000000) OVER (PARTITION BY id ORDER BY seq {RUN}) AS BIGINT) AS ts_s,
    CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq {RUN}) AS BIGINT) AS vc FROM sensor""")


@query("keyed_reduce_running", _REDUCE_SQL)
def keyed_reduce_running(spark, sf):
    """G7 running: the first row passes through, then the running fold."""
    d = _with_ts_s(sensor(spark, sf)).select("seq", "id", "ts_s", "vc")
    return K.reduce_sums(d, ["id"], ["ts_s", "vc"], running=True)


@query("keyed_reduce_user", _REDUCE_SQL)
def keyed_reduce_user(spark, sf):
    """G7 running with a fold of the user's own over whole rows."""
    def add(a, b):
        return a[0] + b[0], a[1] + b[1]

    d = _with_ts_s(sensor(spark, sf)).select("seq", "id", F.struct("ts_s", F.col("vc").cast("bigint").alias("vc")).alias("row"))
    fold = user.Reduce(add, "struct<ts_s bigint, vc bigint>")
    return user.running(d, ["id"], {"sums": (fold, ["row"])}).select("seq", "id", "sums.ts_s", "sums.vc")


@query("sql_group_sum", with_sensor(
    "SELECT id, CAST(sum(vc) AS BIGINT) AS vc_sum FROM sensor WHERE vc > 5 GROUP BY id"))
def sql_group_sum(spark, sf):
    """SQL group-by with a filter, over a table given by name."""
    return spark.sql("SELECT id, CAST(sum(vc) AS BIGINT) AS vc_sum FROM {sensor} WHERE vc > 5 GROUP BY id",
                     sensor=sensor(spark, sf))


def _rendered(counts):
    """``v:n,...`` of a map of numbers, in the map's order."""
    text = F.col(counts).cast("string")                      # {v -> n, v -> n}
    inner = F.substr(text, F.lit(2), F.length(text) - 2)
    return F.replace(F.replace(inner, F.lit(" -> "), F.lit(":")), F.lit(", "), F.lit(","))


_MAP_SQL = ", ".join(f"""CASE WHEN count(CASE WHEN vc = {v} THEN 1 END) OVER w > 0
    THEN '{v}:' || CAST(count(CASE WHEN vc = {v} THEN 1 END) OVER w AS VARCHAR) END""" for v in range(LEVELS))


@query("state_value_counts_running", with_sensor(
    f"""SELECT seq, id, vc, CAST(count(*) OVER (PARTITION BY id, vc ORDER BY seq {RUN}) AS BIGINT) AS value_count,
               concat_ws(',', {_MAP_SQL}) AS counts
        FROM sensor WINDOW w AS (PARTITION BY id ORDER BY seq {RUN})"""))
def state_value_counts_running(spark, sf):
    """K3 running: map state value -> count; the whole map and the count of this
    row's value after every row, in one pass over any domain.  Null is no level and
    has no entry, but is counted in ``value_count``."""
    return _value_counts_running(sensor(spark, sf).select("seq", "id", "vc"))


def _value_counts_running(s):
    d = value_map(s, ["id"], "vc", own="value_count")
    return d.select("seq", "id", "vc", "value_count", _rendered("counts").alias("counts"))


@query("state_value_counts", with_sensor("""SELECT id,
    string_agg(CAST(vc AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY vc) AS counts
    FROM (SELECT id, vc, count(*) AS n FROM sensor GROUP BY id, vc) GROUP BY id"""))
def state_value_counts(spark, sf):
    """K3 final: the whole map per key (rendered ``v:n,...`` by value)."""
    m = K.value_counts(sensor(spark, sf), ["id"], "vc")
    return m.select("id", _rendered("counts").alias("counts"))
