"""Projection, filter, expansion, split/combine, SQL bridge (C*, D*, E*, T3)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from eventide.operators import transforms as X
from eventide.sources.sensor import sensor_view
from eventide.plans.registry import query, sensor, with_sensor
from eventide.sources.tables import spread, table

# DuckDB forms of lines / words with Java split semantics (see functions/text.py)
DOC_LINES_SQL = r"""l0 AS (SELECT doc_id, string_split_regex(regexp_replace(text, '\r?\n\z', ''), '\r?\n') AS ls
                FROM documents),
    l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS line_no FROM l0),
    w0 AS (SELECT doc_id, line_no, CASE WHEN t = '' AND line <> '' THEN CAST([] AS VARCHAR[])
                ELSE string_split(t, ' ') END AS ws
           FROM (SELECT *, regexp_replace(line, '(?: )+\z', '') AS t FROM l)),
    w AS (SELECT doc_id, line_no, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS word_no FROM w0)"""


def doc_words(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    ls = X.split_lines(docs, "text", ["doc_id"])
    return X.split_words(ls, "line", ["doc_id", "line_no"])


@query("map_project", with_sensor("SELECT id FROM sensor"))
def map_project(spark, sf):
    """A map function as a value, applied with ``transform``."""
    return sensor(spark, sf).transform(X.map_project("id"))


@query("filter_eq", with_sensor("SELECT id, ts, vc, seq FROM sensor WHERE id = 's1'"))
def filter_eq(spark, sf):
    """Parametrised filter class -> closure; on the stored column, so
    that it reaches the scan."""
    return sensor_view(table(spark, sf, "events").transform(X.filter_eq("user_id", 1)))


@query("flatmap_case", with_sensor("""
    SELECT seq, unnest(o) AS value, generate_subscripts(o, 1) - 1 AS pos
    FROM (SELECT seq, CASE WHEN id = 's1' THEN [CAST(vc AS VARCHAR), id]
                           WHEN id = 's2' THEN [CAST(epoch_us(ts) // 1000000 AS VARCHAR), CAST(vc AS VARCHAR), id]
                           ELSE [id] END AS o FROM sensor)"""))
def flatmap_case(spark, sf):
    """s1 -> vc, id; s2 -> ts, vc, id; others -> id."""
    return X.flat_map(sensor(spark, sf), X.sensor_flatmap_outputs(), keep=["seq"])


@query("split_words", f"WITH {DOC_LINES_SQL} SELECT doc_id, line_no, word_no, word FROM w")
def split_words(spark, sf):
    """C4: all words of all lines of every document (whole texts)."""
    return doc_words(spark, sf)


def _suffix(pdf: pd.DataFrame, ctx: dict) -> pd.DataFrame:
    return pd.DataFrame({"seq": pdf["seq"], "value": pdf["id"] + ctx["suffix"]})


@query("rich_map_suffix", with_sensor("SELECT seq, id || '_maped' AS value FROM sensor"))
def rich_map_suffix(spark, sf):
    """Map with per-task open/close (here open builds the suffix)."""
    return X.rich_map(sensor(spark, sf).select("seq", "id"), _suffix, "seq long, value string",
                      open_fn=lambda: {"suffix": "_maped"})


@query("sql_filter", with_sensor(
    "SELECT id, ts, vc FROM sensor WHERE ts > TIMESTAMP '2024-01-15 00:00:00'"))
def sql_filter(spark, sf):
    """A table queried with SQL."""
    return spark.sql("SELECT id, ts, vc FROM {sensor} WHERE ts > TIMESTAMP_NTZ '2024-01-15 00:00:00'",
                     sensor=sensor(spark, sf))


@query("sql_view_chain", with_sensor(
    "SELECT id, vc, seq FROM (SELECT id, vc, seq FROM sensor WHERE vc > 5) tmp WHERE vc > 7"))
def sql_view_chain(spark, sf):
    """A query over an intermediate view."""
    tmp = spark.sql("SELECT id, vc, seq FROM {sensor} WHERE vc > 5", sensor=sensor(spark, sf))
    return spark.sql("SELECT * FROM {tmp} WHERE vc > 7", tmp=tmp)


@query("split_parity", with_sensor(
    "SELECT seq, vc, CASE WHEN vc % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM sensor"))
def split_parity(spark, sf):
    """Even / odd in one pass over the input."""
    return X.parity_split(sensor(spark, sf).select("seq", "vc"), "vc")


@query("split_side_output", with_sensor("""
    SELECT seq, id, vc, CASE WHEN id = 's1' THEN 's1' WHEN id = 's2' THEN 's2' ELSE 'main' END AS route
    FROM sensor"""))
def split_side_output(spark, sf):
    """s1 and s2 to side outputs, the rest to the main output."""
    s = sensor(spark, sf).select("seq", "id", "vc")
    return X.route(s, {"s1": F.col("id") == "s1", "s2": F.col("id") == "s2"})


@query("alert_side_output", with_sensor("""
    SELECT seq, id, vc, 'main' AS output FROM sensor
    UNION ALL SELECT seq, id, vc, 'warn' AS output FROM sensor WHERE vc > 10"""))
def alert_side_output(spark, sf):
    """D3: alert rows (vc > 10) copied to a warn output; main unchanged."""
    return X.tee(sensor(spark, sf).select("seq", "id", "vc"), {"warn": F.col("vc") > 10})


@query("union_all", """
    SELECT l_linenumber AS value FROM lineitem
    UNION ALL SELECT c_nationkey FROM customer
    UNION ALL SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) FROM orders""")
def union_all(spark, sf):
    """Three inputs, the third converted from text, unioned."""
    a = table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("int").alias("value"))
    b = table(spark, sf, "customer").select(F.col("c_nationkey").cast("int").alias("value"))
    c = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("value"))
    return X.union_all(a, b, c)


@query("connect_comap", """
    SELECT 'number:' || CAST(o_orderkey AS VARCHAR) AS value FROM orders
    UNION ALL SELECT 'string:' || c_mktsegment FROM customer""")
def connect_comap(spark, sf):
    """Two inputs of different types, one function each."""
    return X.connect(
        table(spark, sf, "orders"), table(spark, sf, "customer"),
        lambda d: d.select(F.concat(F.lit("number:"), F.col("o_orderkey").cast("string")).alias("value")),
        lambda d: d.select(F.concat(F.lit("string:"), F.col("c_mktsegment")).alias("value")))


@query("connect_keyed_join", """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice
    FROM customer JOIN orders ON c_custkey = o_custkey""")
def connect_keyed_join(spark, sf):
    """Keyed match of two inputs (inner join).  Shuffle or broadcast is
    AQE's runtime choice; skewed keys are split by AQE's skew join."""
    from eventide.operators.joins import keyed_match
    return keyed_match(table(spark, sf, "customer"), table(spark, sf, "orders"),
                       "c_custkey", "o_custkey") \
        .select("c_custkey", "c_name", "o_orderkey", "o_totalprice")
