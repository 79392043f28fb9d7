"""Arrivals from a stream of log rows, by keyed state.

Per train the state store holds the station it was last seen at, and the sightings that the watermark has not passed yet.
Once it has, they are put in order and compared with the one before, so rows may come in any order
inside the watermark's delay. State is as large as the trains and the sightings of one delay, however many batches there were.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cadence.operators.arrivals import ARRIVAL_COLUMNS, DEFAULT_TIES, sightings
from cadence.params import Params

KEYS = ("line", "train_no")


class Transitions(StatefulProcessor):
    """Lets a sighting through when its station differs from that of the one before.

    ``rest`` are the columns that are neither key nor order. With ``forget_sec``, a train not seen for that long is
    forgotten, and its next sighting is an arrival wherever it is.
    """

    def __init__(self, row: str, order: Sequence[str], rest: Sequence[str], forget_sec: int | None) -> None:
        self.row, self.order, self.rest, self.forget_sec = row, list(order), list(rest), forget_sec

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "station string, at long")
        self.waiting = handle.getListState("waiting", self.row)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = None
        columns = [*self.order, *self.rest]
        for frame in rows:
            held = frame[columns].astype(object).where(frame[columns].notna(), None)
            self.waiting.appendList(list(held.itertuples(index=False, name=None)))
            newest = max(filter(None.__ne__, (newest, int(frame["at"].max()))))
        if newest is not None:
            self.handle.registerTimer(-(-newest // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        columns = [*self.order, *self.rest]
        rows = list(self.waiting.get())
        done = [r for r in rows if r[0] <= closed]
        if done:
            later = [r for r in rows if r[0] > closed]
            self.waiting.put(later) if later else self.waiting.clear()
            # nothing sorts before a missing tie
            done.sort(key=lambda r: tuple((x is not None, 0 if x is None else x) for x in r[: len(self.order)]))
            station, judged = self.last.get() if self.last.exists() else (None, None)
            at_station, moved, newest = columns.index("statn_id"), [], judged
            for r in done:
                if judged is not None and r[0] <= judged:
                    continue  # late, though the engine's look at the watermark, a batch behind, let it through
                if station is None or r[at_station] != station or self._forgotten(newest, r[0]):
                    moved.append(r)
                station, newest = r[at_station], r[0]
            self.last.update((station, newest))
            if self.forget_sec is not None:
                self.handle.registerTimer(newest // 1000 + self.forget_sec * 1000)
            if moved:
                out = pd.DataFrame(moved, columns=columns)
                yield pd.DataFrame({"line": key[0], "train_no": key[1], "at": out["at"], **{c: out[c] for c in self.rest}})
        elif self.last.exists() and self._forgotten(self.last.get()[1], closed):
            self.last.clear()

    def _forgotten(self, seen: int, now: int) -> bool:
        return self.forget_sec is not None and now - seen >= self.forget_sec * 1_000_000

    def close(self) -> None:
        pass


def stream_arrivals(log: DataFrame, delay: str = "10 minutes", ties: Sequence[str] = DEFAULT_TIES, forget_sec: int | None = None, p: Params = Params()) -> DataFrame:
    """Station changes per ``(line, train_no)`` as a stream, in append mode; start it inside ``keyed.state_store``.

    A sighting is judged once the watermark (the newest receipt less ``delay``) has passed it. One that comes later than
    that is dropped by the engine, which counts it in the query's progress; the daily build takes it from the stored log.
    ``ties`` order sightings of one second, as in the batch form; those that are times are compared as times.
    """
    rows = sightings(log).withWatermark("recptn_ts", delay)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    own = [c for c in ties if c not in ("recptn_ts", "statn_id")]
    as_long = lambda c: F.unix_micros(c) if kinds[c] == "timestamp" else F.col(c)
    rest = [c for c in ARRIVAL_COLUMNS if c in rows.columns and c not in KEYS]
    order = ["at", *(f"tie_{i}" for i in range(len(own)))]
    rows = rows.select(*KEYS, F.unix_micros("recptn_ts").alias("at"), *(as_long(c).alias(f"tie_{i}") for i, c in enumerate(own)), *rest)
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    ddl = lambda names: ", ".join(f"{c} {types[c]}" for c in names)
    processor = Transitions(ddl([*order, *rest]), order, rest, forget_sec)
    found = rows.groupBy(*KEYS).transformWithStateInPandas(processor, ddl([*KEYS, "at", *rest]), "Append", "EventTime")
    at = F.timestamp_micros("at")
    present = [c for c in ARRIVAL_COLUMNS if c in found.columns]
    return found.select(*present, at.alias("arrival_ts"), F.date_format(at, "yyyy-MM-dd").alias("dt"))
