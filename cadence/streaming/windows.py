"""Null-rate windows and alert rules as streaming queries, over event time or over the time of arrival."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cadence.functions import labels as L
from cadence.operators.alerts import CHECKED_FIELDS, COUNTED, alert_rules, null_windows
from cadence.params import Params
from cadence.sources.events import project_json
from cadence.streaming.keyed import stream_throttle

COUNTS = ("total", "null_event_id", *(f"null_{c}" for c in COUNTED))


def stamped(raw: DataFrame) -> DataFrame:
    """Processing-time form: rows are stamped on arrival, so none is ever late."""
    return raw.withColumn("seen_ts", F.current_timestamp())


def stream_null_windows(
    raw: DataFrame, ts: str, delay: str = "0 seconds", p: Params = Params()
) -> DataFrame:
    """Windows over a raw stream; a window is emitted once the watermark passes its end."""
    records = project_json(raw, names=CHECKED_FIELDS)
    return null_windows(records.withWatermark(ts, delay), ts, p)


class CountedWindows(StatefulProcessor):
    """Adds up counters per window and gives a window away when the clock passes its end, heard again or not."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "until long", "begin long, " + ", ".join(f"{c} long" for c in COUNTS))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for (begin, until), sums in frame.groupby(["begin", "until"])[list(COUNTS)].sum().iterrows():
                so_far = self.open.getValue((until,))[1:] if self.open.containsKey((until,)) else [0] * len(COUNTS)
                self.open.updateValue((int(until),), (int(begin), *(int(a) + b for a, b in zip(sums, so_far, strict=True))))
                self.handle.registerTimer(int(until) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = expiredTimerInfo.getExpiryTimeInMs() // 1000
        begin, *sums = self.open.getValue((until,))
        self.open.removeKey((until,))
        yield pd.DataFrame({"begin": [begin], "until": [until], "line": [key[0]], **{c: [n] for c, n in zip(COUNTS, sums, strict=True)}})

    def close(self) -> None:
        pass


def stream_arrival_windows(raw: DataFrame, ts: str = "seen_ts", p: Params = Params()) -> DataFrame:
    """The same windows over the time of arrival (see :func:`stamped`); start it inside ``keyed.state_store``.

    Timers follow the machine's clock, so the last window of a stream that goes quiet is emitted at its end, which a
    watermark would never do. A replay stamped in the past must come as one micro-batch, since each of its windows is
    over as soon as the batch is. Run it with a processing-time trigger: the query never runs out of timers to look at.
    """
    records = project_json(raw, names=CHECKED_FIELDS)
    flags = [L.broken_key("event_id"), *(L.is_blank(c) for c in COUNTED)]
    w = F.window(ts, p.alerts.window)
    rows = records.select(
        L.or_missing("line", p).alias("line"), w.alias("w"), F.lit(1).cast("long").alias("total"),
        *(F.coalesce(f, F.lit(False)).cast("long").alias(c) for f, c in zip(flags, COUNTS[1:], strict=True)),
    )
    rows = rows.select("line", F.unix_timestamp("w.start").alias("begin"), F.unix_timestamp("w.end").alias("until"), *COUNTS)
    schema = "begin long, until long, line string, " + ", ".join(f"{c} long" for c in COUNTS)
    found = rows.groupBy("line").transformWithStateInPandas(CountedWindows(), schema, "Append", "ProcessingTime")
    return found.select(F.timestamp_seconds("begin").alias("window_start"), F.timestamp_seconds("until").alias("window_end"), "line", *COUNTS)


def stream_alerts(raw: DataFrame, ts: str, delay: str = "0 seconds", p: Params = Params()) -> DataFrame:
    """Alert rows before cooldown."""
    return alert_rules(stream_null_windows(raw, ts, delay, p), p)


def alert_lane(raw: DataFrame, ts: str, delay: str = "0 seconds", p: Params = Params()) -> DataFrame:
    """Raw records in, throttled alerts out, as one query: windows closed by the watermark, rules, cooldown per line and rule.

    Both stateful steps keep their state in the query's checkpoint; start it inside ``keyed.state_store``.
    """
    return stream_throttle(stream_alerts(raw, ts, delay, p), p.alerts.cooldown_sec)
