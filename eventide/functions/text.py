"""Text splitting with the semantics of Java's ``String.split``.

Java drops trailing empty strings and Spark's ``split`` keeps them:
``"a b ".split(" ")`` is ``[a, b]`` in Java and ``[a, b, '']`` in Spark.
``split_java`` strips the trailing separators first, so inner and leading
empties are kept, ``''`` gives ``['']`` and an all-separator string gives
``[]``.  Everything stays a JVM expression (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def split_java(s: Column | str, sep_regex: str = " ") -> Column:
    s = _c(s)
    trimmed = F.regexp_replace(s, F.lit(f"(?:{sep_regex})+\\z"), F.lit(""))
    return (F.when(s.isNull(), F.lit(None).cast("array<string>"))
             .when((trimmed == "") & (s != ""), F.array().cast("array<string>"))
             .otherwise(F.split(trimmed, sep_regex, -1)))


def lines(text: Column | str) -> Column:
    """Lines of a text as a line reader yields them (no empty last line
    after a final newline)."""
    t = F.regexp_replace(_c(text), F.lit("\r?\n\\z"), F.lit(""))
    return F.split(t, "\r?\n", -1)


def words(line: Column | str) -> Column:
    """Words of one line split on single blanks (C4)."""
    return split_java(line, " ")
