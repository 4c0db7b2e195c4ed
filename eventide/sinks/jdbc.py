"""Database sink - parametrised insert in batches of ``batch_rows``.

Streaming: ``foreachBatch(jdbc_batch_writer(...))`` with a trigger equal to
the flush interval; a failed write is retried by Spark's task retry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 100,
               properties: dict | None = None, mode: str = "append") -> None:
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_rows))
    df.write.jdbc(url, table, mode=mode, properties=props)


def jdbc_batch_writer(url: str, table: str, batch_rows: int = 100, properties: dict | None = None):
    def run(df: DataFrame, batch_id: int) -> None:
        write_jdbc(df, url, table, batch_rows, properties)
    return run
