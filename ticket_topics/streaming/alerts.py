"""Alerts over a stream of predictions, with state and timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import QUIET_SECONDS, RATE_THRESHOLD, RATE_WINDOW_SECONDS, WATERMARK
from ..operators.monitor import rate_alerts
from .monitor import stream_rates

CHANGES = "topic int, state string, at timestamp, since timestamp, peak double, n_windows bigint"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Alerts(StatefulProcessor):
    """The open alert of one topic: since, last window over the threshold, peak, windows."""

    def __init__(self, quiet_seconds: int):
        self.quiet = quiet_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "since bigint, last bigint, peak double, n bigint")

    def _cleared(self, topic: int, since: int, last: int, peak: float, n: int) -> tuple:
        return topic, "cleared", last + self.quiet, since, peak, n

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (topic,) = key
        windows = sorted(
            row for part in rows for row in zip(part["end"].tolist(), part["rate"].tolist(), strict=True)
        )
        held = self.open.get() if self.open.exists() else None
        changes, was = [], held
        for end, rate in windows:
            if held is not None and end > held[1] + self.quiet:
                changes.append(self._cleared(topic, *held))
                held = None
            if held is None:
                changes.append((topic, "raised", end, end, rate, 1))
                held = (end, end, rate, 1)
            else:
                since, last, peak, n = held
                held = (since, max(last, end), max(peak, rate), n + 1)
        if was is not None:
            self.handle.deleteTimer(1000 * (was[1] + self.quiet))
        self.open.update(held)
        self.handle.registerTimer(1000 * (held[1] + self.quiet))
        yield _changes(changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            held = self.open.get()
            self.open.clear()
            yield _changes([self._cleared(key[0], *held)])

    def close(self) -> None:
        pass


def _changes(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["topic", "state", "at", "since", "peak", "n_windows"])
    for c in ("at", "since"):
        out[c] = pd.to_datetime(out[c], unit="s", utc=True)
    return out


def stream_alerts(
    predictions: DataFrame,
    ts: str = "ts",
    threshold: float = RATE_THRESHOLD,
    quiet_seconds: int = QUIET_SECONDS,
    window_seconds: int = RATE_WINDOW_SECONDS,
    slide_seconds: int = 60,
    watermark: str = WATERMARK,
) -> DataFrame:
    """The rows of :func:`operators.monitor.alert_changes` as they come about.

    Predictions are counted by window before any state is kept by topic, so a topic's state
    is one row, whatever share of the predictions it has. An alert is raised once the
    watermark closes its first window, and cleared by a later window or, where a topic falls
    silent, by a timer when the watermark reaches the time. Sets the session's state store to
    RocksDB, which timers need.
    """
    predictions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rates = stream_rates(predictions, ts, window_seconds, slide_seconds, watermark)
    hot = rate_alerts(rates, threshold).select(
        "topic", F.unix_seconds("window_end").alias("end"), "rate"
    )
    return hot.groupBy("topic").transformWithStateInPandas(
        _Alerts(quiet_seconds), CHANGES, "Append", "EventTime"
    )
