"""The watchdog over a stream of receipts, with timers in the state store.

The receipts of a tick collapse to one row (the newest receipt of all, and of every expected key) in a window over event
time. Each expected key then keeps a few numbers: its last receipt, the newest receipt of all, its last alert. A timer a tick
judges the key once the watermark has passed the tick, in the order of ticks, whether or not the key was heard
again; ticks follow each other while the stream as a whole was heard within the quiet time.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cadence.functions import labels as L
from cadence.params import Params, WatchRules

KEY = ("line", "updn_line")
SILENCE = "tick_sec long, line string, updn_line string, last_sec long, silent_sec long"


class Watch(StatefulProcessor):
    """Judges one expected key at each tick; ``seed`` holds last receipts before ``start``, as epoch seconds."""

    def __init__(self, start: int, rules: WatchRules, seed: Mapping[tuple[str, str], int]) -> None:
        self.start, self.rules, self.seed = start, rules, dict(seed)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "seen long, clock long, sent long, next long")
        self.marks = handle.getMapState("marks", "tick long", "seen long, clock long")

    def _at(self, tick: int) -> int:
        return self.start + tick * self.rules.tick_sec

    def _arm(self, tick: int) -> None:
        self.handle.registerTimer(self._at(tick) * 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if not self.known.exists():
            clock = max(self.seed.values(), default=None)
            self.known.update((self.seed.get(tuple(key)), clock, None, 0))
            if clock is not None and self.start - clock <= self.rules.quiet_sec:
                self._arm(0)
        for frame in rows:
            for tick, seen, clock in zip(frame["tick"].tolist(), frame["seen"].tolist(), frame["clock"].tolist(), strict=True):
                mark = (None if pd.isna(seen) else int(seen), int(clock))
                if self.marks.containsKey((tick,)):
                    mark = _later(mark, self.marks.getValue((tick,)))
                self.marks.updateValue((tick,), mark)
                self._arm(tick)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        w = self.rules
        tick = (expiredTimerInfo.getExpiryTimeInMs() // 1000 - self.start) // w.tick_sec
        seen, clock, sent, after = self.known.get()
        if self.marks.containsKey((tick,)):
            seen, clock = _later((seen, clock), self.marks.getValue((tick,)))
            self.marks.removeKey((tick,))
        at = self._at(tick)
        silent = at - (self.start if seen is None else seen)
        raised = tick >= after and clock is not None and at - clock <= w.quiet_sec and silent > w.gap_sec
        if raised and (sent is None or at - sent >= w.cooldown_sec):
            sent = at
            yield pd.DataFrame({"tick_sec": [at], "line": [key[0]], "updn_line": [key[1]], "last_sec": pd.array([seen], "Int64"), "silent_sec": [silent]})
        self.known.update((seen, clock, sent, max(after, tick + 1)))
        if clock is not None and self._at(tick + 1) - clock <= w.quiet_sec:
            self._arm(tick + 1)

    def close(self) -> None:
        pass


def _later(a: tuple, b: tuple) -> tuple:
    return tuple(max((x for x in pair if x is not None), default=None) for pair in zip(a, b, strict=True))


def stream_watchdog(
    events: DataFrame,
    start: int,
    ts: str = "recptn_ts",
    seed: Mapping[tuple[str, str], int] | None = None,
    delay: str = "0 seconds",
    p: Params = Params(),
) -> DataFrame:
    """Silence alerts after cooldown: ``tick_ts line updn_line last_seen silent_sec``; start it inside ``keyed.state_store``.

    Time is event time. A tick is judged once, when a later receipt shows that it has passed. A
    receipt dated after the clock of its micro-batch counts as received then, so a wrong date
    cannot run ahead; one older than the watermark (the newest less ``delay``) is dropped by the engine. ``seed`` gives epoch
    seconds of receipts before ``start`` (see ``seed_from_current``).
    """
    w = p.watch
    keys = [(line, d) for line in w.lines for d in w.directions]
    at = F.least(F.unix_timestamp(ts), F.unix_timestamp(F.current_timestamp()))
    heard = events.where(~L.is_blank("line") & F.col(ts).isNotNull()).select(*KEY, at.alias("at"))
    # a receipt at a tick belongs to it, so windows are open at their start and closed at their end
    heard = heard.withColumn("inside", F.timestamp_seconds(F.col("at") - 1)).withWatermark("inside", delay)
    newest = [F.max(F.when((F.col("line") == line) & (F.col("updn_line") == d), F.col("at"))).alias(f"seen_{i}") for i, (line, d) in enumerate(keys)]
    ticks = heard.groupBy(F.window("inside", f"{w.tick_sec} seconds", None, f"{start % w.tick_sec} seconds").alias("w")).agg(F.max("at").alias("clock"), *newest)
    tick = F.greatest(F.expr(f"(unix_timestamp(w.end) - {start}) div {w.tick_sec}"), F.lit(0).cast("long"))
    each = [F.struct(F.lit(line).alias("line"), F.lit(d).alias("updn_line"), F.col(f"seen_{i}").alias("seen")) for i, (line, d) in enumerate(keys)]
    rows = ticks.select(tick.alias("tick"), "clock", F.inline(F.array(*each)))
    found = rows.groupBy(*KEY).transformWithStateInPandas(Watch(start, w, seed or {}), SILENCE, "Append", "EventTime")
    return found.select(F.timestamp_seconds("tick_sec").alias("tick_ts"), *KEY, F.timestamp_seconds("last_sec").alias("last_seen"), "silent_sec")
