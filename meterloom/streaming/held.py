"""Rows of a key, held until the watermark has passed them and then folded in order.

A micro-batch brings rows in any order, and rows of one key in any number of batches. What
the watermark has passed can no longer be preceded by a row that is still to come (time
does not fall along the position), so folding that prefix in order gives the same result
under any dealing of rows to batches. State per key is what the watermark has not passed,
and one small value. What one batch brings of a key is held as one packed piece, and not
opened before the watermark has passed the earliest of its rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Lists, timers and times to live need the state store that keeps them on disk."""
    spark.conf.set(PROVIDER, ROCKSDB)


class Held(StatefulProcessor):
    """Subclasses name what they know and say how a row is read and a prefix folded.

    Rows to be held are tuples of plain values that start with their position and their
    event time in milliseconds.
    """

    HELD = "low bigint, high bigint, rows binary"
    KNOWN: str

    def read(self, row: Row) -> tuple:
        raise NotImplementedError

    def fold(
        self, key: tuple, known: tuple | None, ready: list[tuple], now: int
    ) -> tuple[list[Row], tuple | None, int | None]:
        """Rows to emit, what to remember (None: nothing), and when to look again."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.HELD)
        self.known = handle.getValueState("known", self.KNOWN)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh = [self.read(row) for row in rows]
        yield from self._advance(key, fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _advance(self, key: tuple, fresh: list[tuple], now: int) -> Iterator[Row]:
        pieces = [tuple(p) for p in self.held.get()]
        known = self.known.get()
        known = None if known is None else tuple(known)
        high = max((p[1] for p in pieces), default=None)
        rows, passed = fresh, 0
        if any(p[0] < now for p in pieces) or any(r[1] < now for r in fresh):
            before = [r for p in pieces for r in pickle.loads(p[2])]
            rows = sorted(before + fresh, key=lambda r: r[0])
            while passed < len(rows) and rows[passed][1] < now:
                passed += 1
        out, after, wake = self.fold(key, known, rows[:passed], now)
        if passed == len(rows) and passed:
            if pieces:
                self.held.clear()
        elif passed:
            self.held.put([_piece(rows[passed:])])
        elif fresh:
            self.held.appendList([_piece(fresh)])
        if after is None:
            if known is not None:
                self.known.clear()
        elif after != known:
            self.known.update(after)
        # Timers that were set stay: one for the latest row held, one for what is known.
        latest = max((r[1] for r in fresh), default=None)
        if latest is not None and passed < len(rows) and (high is None or latest > high):
            self.handle.registerTimer(max(latest, now) + 1)
        if wake is not None and after is not None and (after != known or wake <= now):
            self.handle.registerTimer(max(wake, now + 1))
        yield from out


def _piece(rows: list[tuple]) -> tuple[int, int, bytes]:
    times = [r[1] for r in rows]
    return min(times), max(times), pickle.dumps(rows)
