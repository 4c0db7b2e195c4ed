"""User functions: scalar, aggregate and table functions.

SQL functions registered by name and Column expressions.  Only ``java_hash``
called by name runs in Python (Arrow batches): it takes any type.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from eventide.functions.hashing import hash_arrow

# Java split on single blanks (trailing empties dropped), as Spark SQL.
SPLIT_WORDS_SQL = r"""
SELECT w AS word, length(w) AS length FROM explode(
    CASE WHEN regexp_replace(line, '(?: )+\\z', '') = '' AND line <> '' THEN CAST(array() AS ARRAY<STRING>)
         ELSE split(regexp_replace(line, '(?: )+\\z', ''), ' ', -1) END) AS t(w)"""


def register_functions(spark: SparkSession) -> None:
    """Make the user functions callable by name from SQL."""
    spark.udf.register("java_hash", F.arrow_udf(hash_arrow, "int"))
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION split_words(line STRING) "
              f"RETURNS TABLE (word STRING, length INT) RETURN {SPLIT_WORDS_SQL}")


def weighted_avg(score: Column | str, weight: Column | str) -> Column:
    """Weighted average as an aggregate expression.  The accumulator is
    (sum of score*weight, sum of weight): partial aggregation on every task,
    merged exactly, so it works on hot keys and on merging windows alike.
    Zero total weight gives null (no division error under ANSI)."""
    s = F.col(score) if isinstance(score, str) else score
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.sum(s * w) / F.nullif(F.sum(w), F.lit(0))
