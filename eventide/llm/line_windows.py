"""Line dedup by overlapping windows of three consecutive lines.

Lines are compared without white space around them; blank lines count for no
window.  Every window of three lines in a row is hashed (two independent 64-bit
hashes of the lines' hashes), repeated windows are found over all documents, and
every occurrence but the first (smallest doc_id, then position) removes the
lines it covers, blank lines between them included.  Overlapping windows cover
together.

Documents with fewer than three lines keep them, as the SQL form of op5 has it; with
``short`` all their lines are one window, so exact copies of them go, too.  Null texts stay null; a
document whose lines all go keeps an empty text.  Rows with the same doc_id are
told apart by their text; equal rows are one occurrence and are treated alike.
A null doc_id comes first in the order.  An empty table gives an empty table;
other columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.blocks import free_names
from eventide.llm.feistel import let
from eventide.session import cut_lineage

#: Lines of a window.
WINDOW = 3
_BLANK = " \t\r"


def _windows(docs: DataFrame, text: str, key: str, short: bool = False) -> DataFrame:
    """``(id, th, a, b, w1, w2)``: lines ``a`` to ``b`` of a document as a window."""
    trimmed = F.transform(F.split(F.col(text).cast("string"), "\n"), lambda l: F.btrim(l, F.lit(_BLANK)))
    full = F.filter(F.transform(trimmed, lambda l, i: F.struct(i.alias("i"), F.length(l).alias("n"), F.xxhash64(l).alias("h"),
                                                                F.xxhash64(F.lit("second"), l).alias("g"))), lambda s: s["n"] > 0)
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("th"), full.alias("lines")).where(F.size("lines") >= (1 if short else WINDOW))

    def window(i: Column) -> Column:
        at = [F.get(F.col("lines"), i + k) for k in range(WINDOW)]
        # Lines that a short document lacks are null, which the hashes pass over.
        return F.struct(at[0]["i"].alias("a"), F.coalesce(*[x["i"] for x in reversed(at)]).alias("b"), F.xxhash64(*[x["h"] for x in at]).alias("w1"),
                        F.xxhash64(*[x["g"] for x in at]).alias("w2"))

    made = F.transform(F.sequence(F.lit(0), F.greatest(F.size("lines") - WINDOW, F.lit(0))), window)
    return rows.select("id", "th", F.inline(made))


def removals(docs: DataFrame, text: str = "text", key: str = "doc_id", short: bool = False) -> DataFrame:
    """``(id, th, a, b)``: the line ranges of later occurrences."""
    windows = _windows(docs, text, key, short)
    place = F.struct("id", "th", "a")
    first = cut_lineage(windows.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("n"), F.max(place).alias("last"))
                        .where("n > 1 AND NOT (first <=> last)").select("w1", "w2", "first"))
    return windows.join(first, ["w1", "w2"]).where(~place.eqNullSafe(F.col("first"))).select("id", "th", "a", "b")


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", counts: bool = False, short: bool = False) -> DataFrame:
    """``docs`` without the lines of repeated windows; ``counts`` adds
    ``n_lines`` and ``n_removed``; ``short``: documents with one or two lines
    form one window of them."""
    i, h, cuts, n, kept = free_names(docs, "__id", "__th", "__cut", "__n", "__kept")
    cut = removals(docs, text, key, short).groupBy("id", "th").agg(F.collect_set(F.struct("a", "b")).alias(cuts))
    cut = cut.withColumnRenamed("id", i).withColumnRenamed("th", h)
    out = docs.join(cut, docs[key].eqNullSafe(cut[i]) & (F.xxhash64(docs[text]) == cut[h]), "left")
    lines = F.split(F.col(text).cast("string"), "\n")
    covered = F.flatten(F.transform(cuts, lambda c: F.sequence(c["a"], c["b"])))
    out = out.withColumn(n, F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)))
    out = out.withColumn(kept, F.when(F.col(cuts).isNotNull(), F.array_except(F.sequence(F.lit(0), F.col(n) - 1), covered)))
    new = F.when(F.col(kept).isNull(), F.col(text)).otherwise(
        let(lines, lambda ls: F.array_join(F.transform(F.col(kept), lambda at: F.get(ls, at)), "\n")))
    if counts:
        out = out.withColumn("n_lines", F.col(n).cast("bigint")).withColumn(
            "n_removed", F.when(F.col(kept).isNull(), 0).otherwise(F.col(n) - F.size(kept)).cast("bigint"))
    return out.withColumn(text, new).drop(i, h, cuts, n, kept)
