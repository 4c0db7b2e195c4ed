"""op1's likeness and positions against a plain form; equal keys share no partition."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("eventide.llm.queries")

from eventide.llm import queries, winnowing

SMALL = "/root/testdata/sf0.001"


def plain(text):
    """``{position: gram}``: of every window of 16 grams the rightmost with the least
    hash (the hash of a gram does not depend on where it stands)."""
    if not text:
        return {}
    grams = [text[i:i + 16] for i in range(max(1, len(text) - 15))]
    hashes = winnowing.winnow(grams)[1].tolist()
    kept = {}
    for i in range(max(1, len(grams) - 15)):
        window = hashes[i:i + 16]
        at = max(j for j, h in enumerate(window) if h == min(window)) + i
        kept[at] = hashes[at]
    return kept


def alike(a, b):
    a, b = set(plain(a).values()), set(plain(b).values())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_hold_hashes_and_positions(spark):
    r = random.Random(1)
    texts = [None, "", "short", "ab" * 90] + ["".join(r.choice("abcd \n") for _ in range(r.randint(1, 400))) for _ in range(25)]
    df = spark.createDataFrame([(i // 2 if i else None, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, positions string")
    got = winnowing.fingerprints(df).collect()
    assert len(got) == len(texts)
    want = sorted(sorted((p, np.uint64(h).view(np.int64).item()) for p, h in plain(t).items()) for t in texts)
    assert sorted(list(zip(x.positions, x.hashes)) for x in got) == want


def test_a_shared_passage_matches_at_its_positions(spark):
    r = random.Random(2)
    rand = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    for _ in range(10):
        passage = rand(31)
        a, b = rand(40) + passage + rand(9), rand(5) + passage + rand(60)
        at, h, pos = winnowing.winnow([a, b])
        one, two = (dict(zip(h[s:e].tolist(), pos[s:e].tolist())) for s, e in zip(at, at[1:]))
        shift = a.index(passage) - b.index(passage)
        assert any(one[x] - two[x] == shift for x in one.keys() & two.keys())


def test_likeness_equals_the_plain_form(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(((r.doc_id, r.text or "") for r in rows), reverse=True)
    got = {r.doc_id: r for r in queries.QUERIES["op1_winnowing"](spark, SMALL).collect()}
    for (k, t), (_, following) in list(zip(rows, rows[1:] + rows[:1]))[:60]:
        assert got[k].near_edited == pytest.approx(alike(t, winnowing.edited(t, following)), abs=1e-12)
        assert got[k].near_next == pytest.approx(alike(t, following), abs=1e-12)


@pytest.mark.parametrize("key,text", [(None, "text of row "), (7, "text of row "), (7, None)])
def test_equal_keys_are_in_many_partitions(spark, key, text):
    docs = spark.range(0, 4000, 1, 4).select(F.lit(key).cast("bigint").alias("k"), (F.concat(F.lit(text), "id") if text else F.lit("same")).alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[1] for r in winnowing._ordered(docs).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 3 and max(sizes) < 2500
    report = winnowing.edit_report(docs.withColumnsRenamed({"k": "doc_id", "t": "text"}))
    assert report.count() == 4000 and (text or report.where("near_next < 1").count() == 0)
