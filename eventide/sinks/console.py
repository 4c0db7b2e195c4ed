"""B1/B2: print sinks, labelled; ``stderr`` for the error print."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame

from eventide.sinks.custom import RowSink


def print_rows(label: str | None = None, to_stderr: bool = False) -> RowSink:
    """A row sink that prints every row in the task that holds it."""
    prefix = f"{label}> " if label else ""

    def show(_, row) -> None:
        print(f"{prefix}{row}", file=sys.stderr if to_stderr else sys.stdout, flush=True)
    return RowSink(show)


def print_batch(label: str | None = None, to_stderr: bool = False):
    """A ``foreachBatch`` function that prints every row of each micro-batch in the
    task that holds it."""
    sink = print_rows(label, to_stderr)

    def run(df: DataFrame, batch_id: int) -> None:
        df.foreachPartition(sink.run_partition)
    return run


def print_stream(df: DataFrame, label: str | None = None, to_stderr: bool = False):
    """Streaming print sink: returns the un-started writer.  The tasks print; no
    row passes through the driver."""
    return df.writeStream.foreach(print_rows(label, to_stderr))
