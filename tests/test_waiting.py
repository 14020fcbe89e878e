"""Waiting windows of the streaming baseline, with a state that counts its calls."""

import pandas as pd
import pytest

from leakwatch.functions import fixed
from leakwatch.streaming import monitor
from pyspark.sql import types as T

FIELDS = [T.StructField("src_ip", T.StringType()), T.StructField("window_start", T.DoubleType()),
          T.StructField("request_count", T.DoubleType()), T.StructField("event_time", T.TimestampType())]


class State:
    """Value, list and map state and timers of one source in memory."""

    def __init__(self):
        self.calls, self.rows, self.value, self.cells, self.timers = 0, [], None, {}, set()

    def __getattribute__(self, name):
        if name in ("exists", "get", "update", "clear", "put", "appendList", "containsKey", "updateValue", "iterator", "removeKey", "registerTimer"):
            self.calls += 1
        return object.__getattribute__(self, name)

    def getValueState(self, *_):
        return Part(self, "value")

    def getListState(self, *_):
        return Part(self, "rows")

    def getMapState(self, *_):
        return Part(self, "cells")

    def registerTimer(self, at):
        self.timers.add(at)


class Part:
    def __init__(self, owner, name):
        self.owner, self.name = owner, name

    def _now(self, new=None, change=False):
        self.owner.calls += 1
        if change:
            setattr(self.owner, self.name, new)
        return object.__getattribute__(self.owner, self.name)

    def exists(self):
        return self._now() is not None

    def get(self):
        held = self._now()
        return iter(list(held)) if self.name == "rows" else held

    def update(self, value):
        self._now(value, True)

    put = update

    def clear(self):
        self._now([] if self.name == "rows" else None, True)

    def appendList(self, rows):
        self._now([*self._now(), *rows], True)

    def containsKey(self, key):
        return key in self._now()

    def updateValue(self, key, value):
        self._now()[key] = value

    def removeKey(self, key):
        del self._now()[key]

    def iterator(self):
        return iter(list(self._now().items()))


class Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    getExpiryTimeInMs = getCurrentWatermarkInMs


def frame(numbers):
    return pd.DataFrame({"src_ip": "a", "window_start": [60.0 * i for i in numbers], "request_count": [float(i % 7) for i in numbers],
                         "event_time": pd.to_datetime([60 * (i + 1) for i in numbers], unit="s")})


def fire(processor, state, watermark):
    out = []
    while due := sorted(t for t in state.timers if t < watermark):
        state.timers.discard(due[0])
        for found in processor.handleExpiredTimer(("a",), Clock(watermark), Clock(due[0])):
            out.extend(found["window_start"] / 60)
    return out


@pytest.mark.parametrize("n", [20, 400])
def test_state_calls_do_not_grow_with_waiting_windows(n):
    state = State()
    processor = monitor.BaselineProcessor(FIELDS, fixed.ONLINE_THRESHOLD, 5)
    processor.init(state)
    processor.handleInputRows(("a",), iter([frame(range(n - 1, -1, -1))]), Clock(0))
    minute = 60_000
    first = fire(processor, state, minute * (n // 2) + 1)
    assert first == list(range(n // 2)) and state.timers
    assert first + fire(processor, state, minute * n + 1) == list(range(n))
    assert state.calls < 25 and not state.rows
