"""User sink with open / process / close per task and epoch.

``open`` gets (partition_id, epoch_id) and may refuse a partition (already
written); ``close`` always runs, with the error if any.
"""

from __future__ import annotations

from collections.abc import Callable


class RowSink:
    """``writeStream.foreach(RowSink(...))`` or ``df.foreachPartition``."""

    def __init__(self, process: Callable, open_fn: Callable | None = None,
                 close_fn: Callable | None = None):
        self._process, self._open, self._close = process, open_fn, close_fn
        self.ctx = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.ctx = self._open(partition_id, epoch_id) if self._open else {}
        return self.ctx is not False

    def process(self, row) -> None:
        self._process(self.ctx, row)

    def close(self, error) -> None:
        if self._close:
            self._close(self.ctx, error)

    def run_partition(self, rows) -> None:
        """Batch use: ``df.foreachPartition(sink.run_partition)``."""
        from pyspark import TaskContext
        tc = TaskContext.get()
        ok = self.open(tc.partitionId() if tc else 0, 0)
        err = None
        try:
            if ok:
                for r in rows:
                    self.process(r)
        except Exception as e:  # noqa: BLE001
            err = e
            raise
        finally:
            self.close(err)
