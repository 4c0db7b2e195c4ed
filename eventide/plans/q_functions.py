"""User functions: scalar, aggregate, table."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions import java_hash, register_functions, user, weighted_avg
from eventide.operators import windows as W
from eventide.operators.transforms import split_lines
from eventide.plans.q_basic import DOC_LINES_SQL
from eventide.plans.q_state import JAVA_HASH_SQL, java_hash_sql
from eventide.plans.registry import bucket, query, sensor, with_sensor
from eventide.sources.tables import spread, table


_LONG = "(50 - seq) * 1000003"
_LOW32 = f"(xor({_LONG}, ({_LONG}) >> 32) & 4294967295)"


@query("udf_java_hash", with_sensor(f"""SELECT seq, id, {java_hash_sql('id')} AS h, vc - 7 AS h_int,
    {JAVA_HASH_SQL.replace('x', _LOW32)} AS h_long, CASE WHEN vc > 7 THEN 1231 ELSE 1237 END AS h_bool,
    true AS api_same FROM sensor"""))
def udf_java_hash(spark, sf):
    """Scalar function of any type, called from SQL by name and from the
    DataFrame API; both give Java's hashCode (s1 = 3614)."""
    register_functions(spark)
    args = {"h": "id", "h_int": "vc - 7", "h_long": _LONG, "h_bool": "vc > 7"}
    named = spark.sql("SELECT *, " + ", ".join(f"java_hash({a}) AS {n}" for n, a in args.items()) + " FROM {sensor}",
                      sensor=sensor(spark, sf).select("seq", "id", "vc"))
    same = [F.col(n) == java_hash(F.expr(a)) for n, a in args.items()]
    return named.withColumn("api_same", same[0] & same[1] & same[2] & same[3]).drop("vc")


_WAVG_SQL = """SELECT l_suppkey,
    round(sum(CAST(l_linenumber AS BIGINT) * CAST(l_quantity AS BIGINT))
          / nullif(sum(CAST(l_quantity AS BIGINT)), 0), 6) AS wavg
    FROM lineitem GROUP BY l_suppkey"""


@query("udaf_weighted_avg", _WAVG_SQL)
def udaf_weighted_avg(spark, sf):
    """Weighted average of line number weighted by quantity, per supplier."""
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_suppkey").agg(F.round(weighted_avg(
        F.col("l_linenumber").cast("bigint"), F.col("l_quantity").cast("bigint")), 6).alias("wavg"))


@query("udtf_split", f"WITH {DOC_LINES_SQL} SELECT doc_id, line_no, word, length(word) AS length FROM w")
def udtf_split(spark, sf):
    """The table function ``split_words(line) -> (word, length)``
    registered by name and joined laterally in SQL."""
    register_functions(spark)
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return spark.sql("SELECT doc_id, line_no, t.word, t.length FROM {lines}, LATERAL split_words(line) t",
                     lines=split_lines(docs, "text", ["doc_id"]))


class WeightedAvg(user.UserAggregate):
    """Accumulator (weighted sum, sum of weights); null for no weight."""

    accumulator, result = "struct<total bigint, weight bigint>", "double"

    def create(self):
        return (0, 0)

    def add(self, acc, score, weight):
        return acc if score is None or weight is None else (acc[0] + score * weight, acc[1] + weight)

    def merge(self, a, b):
        return (a[0] + b[0], a[1] + b[1])

    def finish(self, acc):
        return acc[0] / acc[1] if acc[1] else None


class KeyedSum(user.UserAggregate):
    """Input (key, number), accumulator (key, sum), result a text."""

    accumulator, result = "struct<id string, total bigint>", "string"

    def create(self):
        return ("", 0)

    def add(self, acc, key, value):
        return (key, acc[1] + (value or 0))

    def merge(self, a, b):
        return (a[0] or b[0], a[1] + b[1])

    def finish(self, acc):
        return f"key={acc[0]} sum={acc[1]}"


class MostFrequent(user.UserAggregate):
    """Accumulator value -> count; the most frequent value, the smallest on ties."""

    accumulator, result = "map<int, bigint>", "int"

    def create(self):
        return {}

    def add(self, acc, value):
        if value is not None:
            acc[value] = acc.get(value, 0) + 1
        return acc

    def merge(self, a, b):
        for value, n in b.items():
            a[value] = a.get(value, 0) + n
        return a

    def finish(self, acc):
        return min(acc, key=lambda v: (-acc[v], v)) if acc else None


class Top2(user.UserTableAggregate):
    """The two largest positive values with their ranks (start value 0: values from 0
    down never appear)."""

    accumulator, fields = "struct<first double, second double>", "value double, rank bigint"

    def create(self):
        return (0.0, 0.0)

    def add(self, acc, value):
        return acc if value is None else self.merge(acc, (value, 0.0))

    def merge(self, a, b):
        return tuple(sorted((*a, *b), reverse=True)[:2])

    def emit(self, acc):
        for rank, value in enumerate(acc, 1):
            if value > 0:
                yield value, rank


class SplitWords:
    """The words of a line and their lengths, split at single blanks; empty words at
    the end are left out."""

    def eval(self, line: str):
        words = line.split(" ") if line is not None else []
        while words and not words[-1] and line:
            words.pop()
        for word in words:
            yield word, len(word)


@query("udaf_user_by_name", _WAVG_SQL)
def udaf_user_by_name(spark, sf):
    """The weighted average as a user aggregate, called from SQL by name
    over the accumulators of all tasks."""
    user.register_aggregate(spark, "WeightedAvg", WeightedAvg())
    li = table(spark, sf, "lineitem")
    accs = user.accumulators(li, ["l_suppkey"], {"acc": (WeightedAvg(), [
        F.col("l_linenumber").cast("bigint"), F.col("l_quantity").cast("bigint")])})
    return spark.sql("SELECT l_suppkey, round(WeightedAvg(acc), 6) AS wavg FROM {accs} GROUP BY l_suppkey", accs=accs)


_MODE_BUCKET = f"{bucket('ts', W.micros('1 h'))} AS window_start"


@query("window_user_aggregate", with_sensor(f"""
    SELECT id, window_start, 'key=' || id || ' sum=' || CAST(sum(vc * n) AS VARCHAR) AS summary,
           CAST(arg_max(vc, n * 100 - vc) AS INTEGER) AS mode
    FROM (SELECT id, {_MODE_BUCKET}, vc, count(*) AS n FROM sensor GROUP BY ALL) GROUP BY id, window_start"""))
def window_user_aggregate(spark, sf):
    """Two user aggregates per key and window whose input, accumulator and
    result types all differ, folded in one pass."""
    s = W.tumbling(sensor(spark, sf), "ts", "1 h")
    return user.aggregate(s, ["id", "window_start"], {"summary": (KeyedSum(), ["id", "vc"]), "mode": (MostFrequent(), ["vc"])})


@query("table_top2_user", """SELECT o_custkey, value, rank FROM (
    SELECT o_custkey, o_totalprice AS value,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rank FROM orders)
    WHERE rank <= 2 AND value > 0""")
def table_top2_user(spark, sf):
    """The top 2 per customer as a user table aggregate, called from SQL by
    name with a partitioned table argument."""
    user.register_table_aggregate(spark, "Top2", Top2())
    accs = user.accumulators(table(spark, sf, "orders"), ["o_custkey"], {"acc": (Top2(), ["o_totalprice"])})
    return spark.sql("SELECT * FROM Top2(TABLE({accs}) PARTITION BY o_custkey)", accs=accs)


@query("udtf_user_split", f"WITH {DOC_LINES_SQL} SELECT doc_id, line_no, word, length(word) AS length FROM w")
def udtf_user_split(spark, sf):
    """A user table function by name, joined laterally."""
    user.register_table_function(spark, "user_split", SplitWords, "word string, length int", "line string")
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return spark.sql("SELECT doc_id, line_no, t.word, t.length FROM {lines}, LATERAL user_split(line) t",
                     lines=split_lines(docs, "text", ["doc_id"]))
