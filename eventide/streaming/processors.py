"""Stateful stream processors (keyed state, timers, count windows).

Each is a ``StatefulProcessor`` for ``groupBy(key).transformWithStateInPandas``
and reproduces the batch operator of the same name row for row.  Rows of a
key inside one micro-batch are handled in arrival (``seq``) order.  State is
kept in the checkpointed state store (RocksDB provider), so it survives
restarts, and every state is bounded: one value, a list of at most ``k`` or
``size`` entries, or one timer per distinct instant.

Run with ``spark.sql.streaming.stateStore.providerClass`` set to the RocksDB
provider and ``spark.python.unix.domain.socket.enabled=true``.
"""

from __future__ import annotations

import heapq
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming import StatefulProcessor

_INT = T.StructType([T.StructField("v", T.IntegerType())])
_LONG = T.StructType([T.StructField("v", T.LongType())])


#: Rows that are Python objects, or wait in an output frame, at a time.
BLOCK = 65_536


def _sorted_rows(rows, cols):
    """The rows of a key in arrival order.  Of the micro-batch's rows only the
    needed columns are kept, as arrays (8 bytes or less per value)."""
    parts = [[pdf[c].to_numpy() for c in cols] for pdf in rows]
    if not parts:
        return
    values = [np.concatenate(c) for c in zip(*parts)]
    del parts
    order = np.argsort(values[cols.index("seq")], kind="stable")
    for at in range(0, len(order), BLOCK):
        block = order[at:at + BLOCK]
        yield from zip(*(v[block].tolist() for v in values))


def _frames(rows, columns, dtypes=None):
    """Output rows as frames of at most ``BLOCK`` rows."""
    while block := list(itertools.islice(rows, BLOCK)):
        pdf = pd.DataFrame(block, columns=columns)
        yield pdf.astype(dtypes) if dtypes else pdf


class JumpAlert(StatefulProcessor):
    """K1: alert when |vc - previous vc| > threshold (previous = 0 at first)."""

    def __init__(self, threshold: int = 10):
        self.threshold = threshold

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", _INT)

    def handleInputRows(self, key, rows, timerValues):
        return _frames(self._changes(key, rows), ["id", "seq", "vc", "last_value"])

    def _changes(self, key, rows):
        last = self.last.get()[0] if self.last.exists() else 0
        for seq, vc in _sorted_rows(rows, ["seq", "vc"]):
            if abs(int(vc) - last) > self.threshold:
                yield key[0], int(seq), int(vc), last
            last = int(vc)
        self.last.update((last,))

    def close(self) -> None:
        pass


JUMP_SCHEMA = "id string, seq long, vc int, last_value int"


class RunningTopK(StatefulProcessor):
    """K2: list state held at the k largest values; emits them per row."""

    def __init__(self, k: int = 3):
        self.k = k

    def init(self, handle) -> None:
        self.top = handle.getListState("top", _INT)

    def handleInputRows(self, key, rows, timerValues):
        return _frames(self._changes(key, rows), ["id", "seq", "vc", "top"])

    def _changes(self, key, rows):
        heap = [r[0] for r in self.top.get()] if self.top.exists() else []
        heapq.heapify(heap)
        for seq, vc in _sorted_rows(rows, ["seq", "vc"]):
            if len(heap) < self.k:
                heapq.heappush(heap, int(vc))
            elif vc > heap[0]:
                heapq.heapreplace(heap, int(vc))
            yield key[0], int(seq), int(vc), sorted(heap, reverse=True)
        self.top.put([(v,) for v in heap])

    def close(self) -> None:
        pass


TOPK_SCHEMA = "id string, seq long, vc int, top array<int>"


class RunningAverage(StatefulProcessor):
    """K4, K5: reducing and aggregating state (sum and count of a key's values);
    emits both results, the sum and the average so far, per row."""

    def init(self, handle) -> None:
        self.acc = handle.getValueState("acc", T.StructType([T.StructField("s", T.LongType()), T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        return _frames(self._changes(key, rows), ["id", "seq", "vc", "vc_sum", "vc_avg"])

    def _changes(self, key, rows):
        s, n = self.acc.get() if self.acc.exists() else (0, 0)
        for seq, vc in _sorted_rows(rows, ["seq", "vc"]):
            s, n = s + int(vc), n + 1
            yield key[0], int(seq), int(vc), s, s / n
        self.acc.update((s, n))

    def close(self) -> None:
        pass


AVERAGE_SCHEMA = "id string, seq long, vc int, vc_sum long, vc_avg double"


class KeyChangelog(StatefulProcessor):
    """T5: the change rows (+I, -U, +U) of a key's sum.  State is the sum and
    the row count of each key; a batch touches only the keys it holds."""

    def init(self, handle) -> None:
        self.acc = handle.getValueState("acc", T.StructType([T.StructField("s", T.LongType()), T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        return _frames(self._changes(key, rows), ["id", "seq", "op_no", "op", "vc_sum"])

    def _changes(self, key, rows):
        s, n = self.acc.get() if self.acc.exists() else (0, 0)
        for seq, vc in _sorted_rows(rows, ["seq", "vc"]):
            old, s, n = s, s + int(vc), n + 1
            if n == 1:
                yield key[0], int(seq), 0, "+I", s
            elif s != old:
                yield from ((key[0], int(seq), 0, "-U", old), (key[0], int(seq), 1, "+U", s))
        self.acc.update((s, n))

    def close(self) -> None:
        pass


CHANGELOG_SCHEMA = "id string, seq long, op_no int, op string, vc_sum long"


class ValueCounts(StatefulProcessor):
    """K3: map state value -> count; emits the whole map per row (by value).
    The map grows with a key's different values, so it suits levels, not
    measurements."""

    def init(self, handle) -> None:
        self.counts = handle.getMapState("counts", _INT, _LONG)

    def handleInputRows(self, key, rows, timerValues):
        return _frames(self._changes(key, rows), ["id", "seq", "vc", "counts"])

    def _changes(self, key, rows):
        counts = {k[0]: v[0] for k, v in self.counts.iterator()}
        changed = set()
        for seq, vc in _sorted_rows(rows, ["seq", "vc"]):
            v = int(vc)
            counts[v] = counts.get(v, 0) + 1
            changed.add(v)
            yield key[0], int(seq), v, ",".join(f"{k}:{n}" for k, n in sorted(counts.items()))
        for v in changed:
            self.counts.updateValue((v,), (counts[v],))

    def close(self) -> None:
        pass


MAP_SCHEMA = "id string, seq long, vc int, counts string"


class CountWindow(StatefulProcessor):
    """H6/H7: count window of ``size`` rows sliding by ``slide`` (tumbling
    when equal).  Keeps at most ``size`` rows and the key's row count."""

    def __init__(self, size: int = 5, slide: int | None = None):
        self.size, self.slide = size, slide or size

    def init(self, handle) -> None:
        self.buf = handle.getListState("buf", T.StructType([T.StructField("seq", T.LongType()),
                                                           T.StructField("vc", T.IntegerType())]))
        self.n = handle.getValueState("n", _LONG)

    def handleInputRows(self, key, rows, timerValues):
        return _frames(self._changes(key, rows), ["id", "window_no", "n", "vcs"])

    def _changes(self, key, rows):
        buf = list(self.buf.get()) if self.buf.exists() else []
        buf = [(int(s), int(v)) for s, v in buf]
        n = self.n.get()[0] if self.n.exists() else 0
        for seq, vc in _sorted_rows(rows, ["seq", "vc"]):
            n += 1
            buf = (buf + [(int(seq), int(vc))])[-self.size:]
            full = self.slide < self.size or len(buf) == self.size
            if n % self.slide == 0 and full:
                wno = n // self.size if self.slide == self.size else n
                yield key[0], wno, len(buf), [v for _, v in buf]
                if self.slide == self.size:
                    buf = []
        self.buf.put(buf) if buf else self.buf.clear()
        self.n.update((n,))

    def close(self) -> None:
        pass


COUNT_SCHEMA = "id string, window_no long, n long, vcs array<int>"


class EventTimeTimers(StatefulProcessor):
    """K8: a timer ``after_ms`` after each row's event time; on expiry emits
    (key, timer time, watermark at firing).  Same instant twice = one timer.
    With ``delete_previous`` a new timer replaces the key's pending one (the
    delete variant), so at most one timer per key is pending."""

    def __init__(self, after_ms: int, delete_previous: bool = False):
        self.after_ms, self.delete_previous = after_ms, delete_previous

    def init(self, handle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", _LONG)

    def handleInputRows(self, key, rows, timerValues):
        last = None                          # (seq, ts) of the latest row
        for pdf in rows:
            if self.delete_previous:
                at = pdf["seq"].idxmax()
                here = (int(pdf["seq"][at]), int(pdf["ts_ms"][at]))
                last = here if last is None else max(last, here)
            else:
                for ts in pdf["ts_ms"].unique():
                    self.handle.registerTimer(int(ts) + self.after_ms)
        if last is not None:                 # of several timers only the latest row's would stay
            if self.pending.exists():
                self.handle.deleteTimer(self.pending.get()[0])
            self.handle.registerTimer(last[1] + self.after_ms)
            self.pending.update((last[1] + self.after_ms,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.delete_previous:
            self.pending.clear()
        yield pd.DataFrame({"id": [key[0]], "timer_ms": [expiredTimerInfo.getExpiryTimeInMs()],
                            "watermark_ms": [timerValues.getCurrentWatermarkInMs()]})

    def close(self) -> None:
        pass


class ProcessingTimeTimers(StatefulProcessor):
    """K9: a timer ``after_ms`` after the processing time a row is seen."""

    def __init__(self, after_ms: int):
        self.after_ms = after_ms

    def init(self, handle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        self.handle.registerTimer(now + self.after_ms)       # one instant, so one timer
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield pd.DataFrame({"id": [key[0]], "timer_ms": [expiredTimerInfo.getExpiryTimeInMs()],
                            "watermark_ms": [timerValues.getCurrentProcessingTimeInMs()]})

    def close(self) -> None:
        pass


TIMER_SCHEMA = "id string, timer_ms long, watermark_ms long"


class TtlValue(StatefulProcessor):
    """K6: value state with a time-to-live (processing time).  Each row reads
    the state first, then writes vc when vc > 10.  Spark refreshes the ttl on
    write; ``refresh_on_read`` writes the value back after a read, which
    gives read-and-write refresh."""

    def __init__(self, ttl_ms: int, refresh_on_read: bool):
        self.ttl_ms, self.refresh_on_read = ttl_ms, refresh_on_read

    def init(self, handle) -> None:
        self.state = handle.getValueState("last", _INT, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        return _frames(self._changes(key, rows), ["id", "seq", "state"], {"state": "Int32"})

    def _changes(self, key, rows):
        for seq, vc in _sorted_rows(rows, ["seq", "vc"]):
            cur = self.state.get()[0] if self.state.exists() else None
            yield key[0], int(seq), cur
            if cur is not None and self.refresh_on_read:
                self.state.update((cur,))
            if vc > 10:
                self.state.update((int(vc),))

    def close(self) -> None:
        pass


TTL_SCHEMA = "id string, seq long, state int"


def apply(df: DataFrame, key: str, processor: StatefulProcessor, schema: str,
          time_mode: str = "None", mode: str = "Append") -> DataFrame:
    return df.groupBy(key).transformWithStateInPandas(processor, schema, mode, time_mode)


class SlotCount(StatefulProcessor):
    """K7: the rows of a slot so far, one output row per micro-batch.  A new query
    starts from the state handed to it (``streaming.handover``)."""

    def init(self, handle) -> None:
        self.count = handle.getValueState("count", _LONG)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.count.update((int(initialState["cnt"].sum()),))

    def handleInputRows(self, key, rows, timerValues):
        n = (self.count.get()[0] if self.count.exists() else 0) + sum(len(pdf) for pdf in rows)
        self.count.update((n,))
        yield pd.DataFrame({"slot": [key[0]], "cnt": [n]})

    def close(self) -> None:
        pass


SLOT_SCHEMA = "slot int, cnt long"
