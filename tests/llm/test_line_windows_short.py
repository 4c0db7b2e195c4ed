"""Documents with one or two lines as windows of their own."""

import corpus_pipeline


def test_short_documents(spark):
    rows = [(1, "a\nb"), (2, " a \n\nb"), (3, "a"), (4, "a"), (5, "a\nc"), (6, "a\nb\nc"), (7, None), (8, ""), (9, " \n"), (10, "a\nb\nd")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, df, "").collect()}
    assert got == dict(rows) | {2: "", 4: ""}
