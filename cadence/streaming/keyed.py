"""Keyed state over streams: cooldown of alerts, one row per key.

State lives in the state store of the query (RocksDB), so it is part of the query's checkpoint: a restart
resumes it, and its size follows the keys, not the batches.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Start stateful queries inside: they keep their state in RocksDB, on disk, with changelogs in the checkpoint."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def stop_when_idle(query: StreamingQuery, quiet: int = 2, poll_sec: float = 0.5) -> None:
    """Stop a query with a processing-time trigger once its last ``quiet`` micro-batches brought no rows after some had."""
    while query.isActive:
        rows = [done.numInputRows for done in query.recentProgress]
        if len(rows) > quiet and not any(rows[-quiet:]):
            query.stop()
            break
        time.sleep(poll_sec)
    if query.exception() is not None:
        raise query.exception()


class Cooldown(StatefulProcessor):
    """Lets an alert through when its key was silent for the cooldown.

    Alerts wait in the state under their time, each with a timer at that time. Timers fire in the order of time once a batch's
    rows are all there and the watermark has passed it, so frames are taken as they come, in any order, and none is sorted or held.
    """

    def __init__(self, cooldown_sec: int) -> None:
        self.cooldown_sec = cooldown_sec

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")
        self.waiting = handle.getMapState("waiting", "at long", "level string, text string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for at, level, text in zip(frame["at"].tolist(), frame["level"], frame["text"], strict=True):
                self.waiting.updateValue((at,), (level, text))
                self.handle.registerTimer(at * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs() // 1000
        level, text = self.waiting.getValue((at,))
        self.waiting.removeKey((at,))
        if not self.last.exists() or at - self.last.get()[0] >= self.cooldown_sec:
            self.last.update((at,))
            yield pd.DataFrame({"at": [at], "level": [level], "line": [key[0]], "rule": [key[1]], "text": [text]})

    def close(self) -> None:
        pass


def stream_throttle(alerts: DataFrame, cooldown_sec: int, at: str = "window_end") -> DataFrame:
    """Greedy cooldown per ``(line, rule)`` over a stream of alert rows; start it inside :func:`state_store`.

    The stream needs a watermark, its own or that of the windows it comes from. Alerts of one key and time are one. An alert is
    judged once the watermark has passed its time.
    """
    # Times cross into Python as epoch seconds, which no time zone can move.
    kept = (
        alerts.select(F.unix_timestamp(at).alias("at"), "level", "line", "rule", "text")
        .groupBy("line", "rule")
        .transformWithStateInPandas(Cooldown(cooldown_sec), "at long, level string, line string, rule string, text string", "Append", "EventTime")
    )
    return kept.select(F.timestamp_seconds("at").alias(at), "level", "line", "rule", "text")
