"""The adaptive baseline as keyed streaming state, in order of event time."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from leakwatch.functions import fixed
from leakwatch.operators import baseline
from leakwatch.operators.moments import NAMES, Baselines

STATE = "n bigint, warm boolean, mean array<double>, m2 array<double>"


def plain(value):
    """A cell as Python has it: no numpy scalar, no missing value other than None."""
    if isinstance(value, (list, tuple, dict)) or hasattr(value, "tolist") and getattr(value, "ndim", 0):
        return value.tolist() if hasattr(value, "tolist") else value
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None if value is None or value is pd.NaT else float("nan")
    return value.item() if hasattr(value, "item") else value


def millis(event_time):
    return int(pd.Timestamp(event_time).timestamp() * 1000)


class BaselineProcessor(StatefulProcessor):
    """Windows wait in list state until the watermark passes their end and are then taken in order of their end and
    start, whatever trigger they came with. A source that waits has a timer at or before its earliest end; all its windows
    that are due are taken together. Baselines have a fixed size per source; a waiting window is
    dropped when it is taken. A row whose `reset` is true clears the source and gives no output."""

    def __init__(self, fields, threshold, warmup):
        self.fields = fields
        self.names = [f.name for f in fields]
        self.threshold = threshold
        self.warmup = warmup

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("baseline", STATE)
        self.waiting = handle.getListState("waiting", T.StructType(self.fields))

    def handleInputRows(self, key, rows, timerValues):
        at = self.names.index("event_time")
        came = [tuple(plain(v) for v in values) for frame in rows for values in frame[self.names].itertuples(index=False, name=None)]
        if came:
            self.waiting.appendList(came)
            self.handle.registerTimer(min(millis(r[at]) for r in came))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # What the watermark has passed is due, also where its own timer would fire later in this trigger.
        due = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        end, start = (self.names.index(n) for n in ("event_time", "window_start"))
        held = [(millis(r[end]), tuple(r)) for r in self.waiting.get()]
        ready = sorted((h for h in held if h[0] <= due), key=lambda h: (h[0], h[1][start]))
        if not ready:
            return
        later = [h for h in held if h[0] > due]
        if later:
            self.waiting.put([r for _, r in later])
            self.handle.registerTimer(min(h[0] for h in later))
        else:
            self.waiting.clear()
        rows = [r for _, r in ready]
        places = [self.names.index(n) if n in self.names else None for n in NAMES]
        cells = [[0.0 if p is None or r[p] is None else float(r[p]) for p in places] for r in rows]
        reset = self.names.index("reset") if "reset" in self.names else None
        baselines, results, kept = self._restore(), [], []
        for row, x in zip(rows, np.array(cells, dtype=float)):
            if reset is not None and row[reset]:
                baselines = Baselines(1)
                continue
            results.append([v[0] for v in baselines.step([0], x[None, :], self.threshold, self.warmup)])
            kept.append(row)
        if baselines.n[0] == 0:
            self.state.clear()
        else:
            self.state.update((int(baselines.n[0]), bool(baselines.warm[0]), baselines.mean[0].tolist(), baselines.m2[0].tolist()))
        if kept:
            out = pd.DataFrame(kept, columns=self.names)
            for name, values in zip(baseline.STEP.names, zip(*results)):
                out[name] = [v.tolist() for v in values] if name in ("_mean", "_std") else list(values)
            yield out

    def _restore(self):
        held = Baselines(1)
        if self.state.exists():
            n, warm, mean, m2 = self.state.get()
            held.n[0], held.warm[0], held.mean[0], held.m2[0] = n, warm, mean, m2
        return held

    def close(self):
        pass


def monitor(windows, threshold=fixed.ONLINE_THRESHOLD, warmup=fixed.WARMUP_WINDOWS, late="0 seconds"):
    """Score window rows of a stream against their source's past (needs RocksDB state).

    Windows may come in any order within `late` of the latest one; a window is scored once the watermark has passed
    its end, so that the result does not depend on how rows fall into triggers. Later rows are dropped and counted by the
    query. Output waits for the watermark: the last windows come out when later ones have come in.
    """
    columns = windows.columns
    timed = windows.withColumn("event_time", F.timestamp_micros(F.round(F.col("window_end") * 1e6).cast("bigint")))
    timed = timed.withWatermark("event_time", late)
    stepped = timed.groupBy("src_ip").transformWithStateInPandas(
        statefulProcessor=BaselineProcessor(timed.schema.fields, threshold, warmup),
        outputStructType=T.StructType(timed.schema.fields + baseline.STEP.fields),
        outputMode="Append",
        timeMode="EventTime",
    )
    return baseline.explained(stepped, columns, warmup)
