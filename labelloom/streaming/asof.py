"""State of routes in a stream: checks of one TTL, and the requests that wait for the watermark."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import STATE_STORE

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # a cluster needs no copy of this module


def state_store_ready(spark: SparkSession) -> None:
    """Timers need the RocksDB state store, which is a setting of the session."""
    name = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(name, "") != STATE_STORE:
        raise ValueError(f"set {name} to {STATE_STORE}")


NO_TIME = -(2**63)


class AsofRoutes(StatefulProcessor):
    """Position of the first backend that was up at each request's time. Times are in microseconds.

    Rows: a request has ``payload`` and ``size`` (backends of its route), a check has ``pos`` and ``up``; both have ``at``.
    """

    def __init__(self, ttl: int, unknown: str):
        if unknown not in ("up", "down"):
            raise ValueError(f"unknown: {unknown}")
        self.ttl, self.trusted = ttl, unknown == "up"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.checks = handle.getListState("checks", "at long, pos int, up boolean")
        self.waiting = handle.getListState("waiting", "at long, size int, payload string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        checks, waiting, ready = [], [], []
        for row in rows:
            if row.payload is None:
                if row.at is not None:
                    checks.append((row.at, row.pos, row.up))
            elif row.size and row.at is not None:
                waiting.append((row.at, row.size, row.payload))
            else:  # without a route there is nothing to wait for, and without a time nothing is known
                ready.append(Row(payload=row.payload, pos=0 if row.size and self.trusted else None))
        if checks:
            self.checks.appendList(checks)
            self._wake(max(at for at, _, _ in checks) + self.ttl + 1)  # then they can go
        if waiting:
            self.waiting.appendList(waiting)
            self._wake(min(at for at, _, _ in waiting))
        yield from ready

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        checks = sorted((tuple(x) for x in self.checks.get()), key=lambda x: x[:2])
        waiting = sorted(tuple(x) for x in self.waiting.get())
        due = [x for x in waiting if x[0] <= now]
        yield from self._resolved(checks, due)
        self._keep(self.checks, [x for x in checks if x[0] >= now - self.ttl])
        later = waiting[len(due) :]
        self._keep(self.waiting, later)
        if later:
            self._wake(later[0][0])

    def close(self) -> None:
        pass

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(math.ceil(at / 1000))

    @staticmethod
    def _keep(state, rows: list[tuple]) -> None:
        if rows:
            state.put(rows)
        else:
            state.clear()

    def _resolved(self, checks: list[tuple], due: list[tuple]) -> Iterator[Row]:
        last: dict[int, tuple[int, bool | None]] = {}  # position: time and state of the latest check
        k = 0
        for at, size, payload in due:
            while k < len(checks) and checks[k][0] <= at:
                when, pos, up = checks[k]
                if pos in last and last[pos][0] == when and last[pos][1] is not None:  # of several checks of one instant one that is up counts
                    up = bool(up) or last[pos][1]
                last[pos] = (when, up)
                k += 1
            found = None
            for pos in range(size):
                when, up = last.get(pos, (None, None))
                if when is None or when < at - self.ttl or up is None:
                    up = self.trusted
                if up:
                    found = pos
                    break
            yield Row(payload=payload, pos=found)


class AsofBlocks(AsofRoutes):
    """``AsofRoutes`` over frames of rows, for ``transformWithStateInPandas``: what a frame adds to a state is one entry of it.

    Frames have ``asked`` (a request, not a check), ``at`` (``NO_TIME`` where there is none), ``size``, ``pos``, ``up`` (1, 0 or -1 for unknown) and
    ``payload``. Positions come out as -1 where no backend was up.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.checks = handle.getListState("checks", "at binary, pos binary, up binary")
        self.waiting = handle.getListState("waiting", "at binary, size binary, payload array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        least, most = None, None
        for frame in rows:
            asked, at, size = (frame[name].to_numpy() for name in ("asked", "at", "size"))
            timed = at != NO_TIME
            check, wait = ~asked & timed, asked & timed & (size > 0)
            if check.any():
                self._put_checks(at[check], frame["pos"].to_numpy()[check], frame["up"].to_numpy()[check])
                most = max(at[check].max(), at[check].max() if most is None else most)
            if wait.any():
                self._put_waiting(at[wait], size[wait], frame["payload"].to_numpy()[wait])
                least = min(at[wait].min(), at[wait].min() if least is None else least)
            ready = asked & ~wait  # without a route there is nothing to wait for, and without a time nothing is known
            if ready.any():
                known = (size[ready] > 0) & self.trusted
                yield pd.DataFrame({"payload": frame["payload"].to_numpy()[ready], "pos": np.where(known, 0, -1).astype(np.int32)})
        if most is not None:
            self._wake(int(most) + self.ttl + 1)  # then they can go
        if least is not None:
            self._wake(int(least))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        at, pos, up = self._joined(self.checks, (np.int64, np.int32, np.int8))
        order = np.lexsort((pos, at))
        at, pos, up = at[order], pos[order], up[order]
        asked, size, payload = self._joined(self.waiting, (np.int64, np.int32, object))
        order = np.argsort(asked, kind="stable")
        asked, size, payload = asked[order], size[order], payload[order]
        due = int(np.searchsorted(asked, now, "right"))
        if due:
            checks = list(zip(at.tolist(), pos.tolist(), [None if x < 0 else x == 1 for x in up.tolist()], strict=True))
            found = self._resolved(checks, list(zip(asked[:due].tolist(), size[:due].tolist(), payload[:due], strict=True)))
            out = [(x.payload, -1 if x.pos is None else x.pos) for x in found]
            yield pd.DataFrame({"payload": [x for x, _ in out], "pos": np.array([x for _, x in out], np.int32)})
        keep = at >= now - self.ttl
        if not keep.all():
            self.checks.clear()
            if keep.any():
                self._put_checks(at[keep], pos[keep], up[keep])
        if due:
            self.waiting.clear()
            if due < len(asked):
                self._put_waiting(asked[due:], size[due:], payload[due:])
        if due < len(asked):
            self._wake(int(asked[due]))

    def _put_checks(self, at: np.ndarray, pos: np.ndarray, up: np.ndarray) -> None:
        self.checks.appendValue((at.astype(np.int64).tobytes(), pos.astype(np.int32).tobytes(), up.astype(np.int8).tobytes()))

    def _put_waiting(self, at: np.ndarray, size: np.ndarray, payload: np.ndarray) -> None:
        self.waiting.appendValue((at.astype(np.int64).tobytes(), size.astype(np.int32).tobytes(), list(payload)))

    @staticmethod
    def _joined(state, kinds: tuple) -> list[np.ndarray]:
        """The columns of all entries."""
        parts = [[np.zeros(0, kind)] for kind in kinds]
        for entry in state.get():
            for part, values, kind in zip(parts, entry, kinds, strict=True):
                part.append(np.array(values, object) if kind is object else np.frombuffer(values, kind))
        return [np.concatenate(part) for part in parts]
