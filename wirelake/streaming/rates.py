"""Rates of counters while their samples arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wirelake.session import send_code_with_tasks


#: Samples of a series that are sorted into steps together.
AT_ONCE = 1 << 20


class WindowedRate(StatefulProcessor):
    """Keeps a series' samples of one window; a timer at the end of each step gives the step's rate.

    A timer fires once the watermark has passed it, when no sample of its window can come any
    more. State of a series is its samples of the last window and the timers ahead. Samples lie in
    parts by the step that they fall into, so a timer reads the steps of its own window only,
    however many a micro-batch has brought.
    """

    def __init__(self, keys: tuple[str, ...], window_us: int, step_us: int):
        self.keys, self.window_us, self.step_us = keys, window_us, step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "step bigint", "parts bigint")
        self.parts = handle.getMapState("parts", "step bigint, part bigint", "us binary, value binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, size = [], 0
        for part in rows:
            waiting.append((part["us"].to_numpy("int64"), part["value"].to_numpy("float64")))
            size += len(part)
            if size >= AT_ONCE:
                self._keep(waiting)
                waiting, size = [], 0
        if size:
            self._keep(waiting)
        yield from ()

    def _keep(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Store samples with the step that each falls into, and set the timers of their windows."""
        us, value = (np.concatenate(column) for column in zip(*parts))
        order = np.argsort(us, kind="stable")
        us, value = us[order], value[order]
        first = us + -us % self.step_us
        spans = (us + self.window_us - first) // self.step_us + 1  # ends of steps whose window has the sample
        us, value, first, spans = us[spans > 0], value[spans > 0], first[spans > 0], spans[spans > 0]
        steps, starts = np.unique(us // self.step_us, return_index=True)
        for step, a, b in zip(steps.tolist(), starts.tolist(), [*starts[1:].tolist(), len(us)]):
            count = self._count(step)
            self.parts.updateValue((step, count), (us[a:b].tobytes(), value[a:b].tobytes()))
            self.counts.updateValue((step,), (count + 1,))
        ends = [np.unique(first[spans > k]) + k * self.step_us for k in range(int(spans.max(initial=0)))]
        for end in np.unique(np.concatenate([first[:0], *ends])).tolist():  # a timer that is there already stays one
            self.handle.registerTimer(end // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() * 1000
        held = []
        for step in range((end - self.window_us) // self.step_us, end // self.step_us + 1):
            count = self._count(step)
            found = [self.parts.getValue((step, part)) for part in range(count)]
            us, value = (np.frombuffer(b"".join(bytes(f[i]) for f in found), kind) for i, kind in enumerate(("int64", "float64")))
            held.append((us, value))
            if count and us.max() < end + self.step_us - self.window_us:  # no later window has any of them
                for part in range(count):
                    self.parts.removeKey((step, part))
                self.counts.removeKey((step,))
        us, value = (np.concatenate(column) for column in zip(*held))
        inside = (us >= end - self.window_us) & (us <= end)
        us, value = us[inside], value[inside]
        if len(us) > 1:
            value = value[np.lexsort((value, us))]
            before, now = value[:-1], value[1:]
            with np.errstate(invalid="ignore"):
                increase = sum(np.where(now >= before, now - before, now).tolist())
            row = {k: [v] for k, v in zip(self.keys, key)}
            row |= {"at_us": [end], "increase": [increase], "rate": [increase / (self.window_us / 1e6)]}
            yield pd.DataFrame(row)

    def _count(self, step: int) -> int:
        """How many parts a step has."""
        return self.counts.getValue((step,))[0] if self.counts.containsKey((step,)) else 0

    def close(self) -> None:
        pass


def live_rates(
    samples: DataFrame, keys: tuple[str, ...] = ("series",), window_us: int = 60_000_000, step_us: int = 15_000_000, late: str = "1 minute"
) -> DataFrame:
    """Increase and per-second rate of each counter at each step, of a stream of samples.

    The same rows as ``counters.counter_rate`` gives of the whole table, each once its step has
    ended for longer than ``late``; samples that come later than that are dropped. Steps are whole
    milliseconds. Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    if step_us % 1000:
        raise ValueError("steps are whole milliseconds")
    send_code_with_tasks(__name__)
    timed = samples.withWatermark("scrape_ts", late).select(*keys, "scrape_ts", F.unix_micros("scrape_ts").alias("us"), "value")
    schema = ", ".join(f"`{k}` {t}" for k, t in samples.select(*keys).dtypes)
    found = timed.groupBy(*keys).transformWithStateInPandas(
        WindowedRate(keys, window_us, step_us), f"{schema}, at_us bigint, increase double, rate double", "Append", "EventTime"
    )
    return found.select(*keys, F.timestamp_micros("at_us").alias("at"), "increase", "rate")
