"""Completeness watchdog: which line and direction went silent, tick by tick.

The check at a tick: while the stream as a whole was heard within ``quiet_sec``,
every expected ``(line, direction)`` not heard for more than ``gap_sec`` raises an
alert; a key never heard raises one once the watch has run for ``gap_sec``.

The work follows the silences, not the ``ticks x keys`` grid. Receipts collapse to
the newest per key and tick (stored once, as three steps read it); the silent ticks of a key are generated from each gap
between two such receipts; the ticks at which the stream was heard are generated
from the newest receipt overall per tick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions import labels as L
from cadence.functions import texts
from cadence.operators.alerts import throttle
from cadence.operators.ordered import with_previous
from cadence.params import Params
from cadence.sources.staging import stage

KEY = ("line", "updn_line")


def silent_ticks(
    receipts: DataFrame,
    start: int,
    end: int,
    ts: str = "recptn_ts",
    since: int | None = None,
    p: Params = Params(),
) -> DataFrame:
    """Raw alerts before cooldown: ``tick_ts line updn_line last_seen silent_sec``.

    ``start`` and ``end`` are epoch seconds; ticks lie at ``start + i * tick_sec``.
    Receipts before ``start`` count as seen; a key never heard is silent from ``since``
    on, by default ``start``. Receipts of unexpected keys keep the
    stream-wide clock alive and raise nothing.
    """
    w = p.watch
    ticks = (end - start) // w.tick_sec
    per_key = stage(
        receipts.where(~L.is_blank("line") & F.col(ts).isNotNull())
        .select(*KEY, F.unix_timestamp(ts).alias("at"))
        .groupBy(*KEY, tick_at_or_after(F.col("at"), start, w.tick_sec).alias("tick_no"))
        .agg(F.max("at").alias("at"))
        .where(F.col("tick_no") <= ticks),
        "receipts",
    )
    expected = _expected(receipts, p)
    marks = (
        per_key.where(F.col("line").isin(*w.lines) & F.col("updn_line").isin(*w.directions))
        .unionByName(expected.withColumns({"tick_no": _long(0), "at": _long(None)}))
        .unionByName(expected.withColumns({"tick_no": _long(ticks + 1), "at": _long(None)}))
        .groupBy(*KEY, "tick_no")
        .agg(F.max("at").alias("at"))
    )
    spans = with_previous(marks, KEY, ("tick_no",), ("tick_no", "at"), p=p).where(F.col("prev").isNotNull())

    last_at = F.coalesce("prev.at", _long(start if since is None else since))
    first = F.greatest(
        F.col("prev.tick_no"), F.floor((last_at + w.gap_sec - start) / w.tick_sec) + 1
    )
    last = F.col("tick_no") - 1
    silent = (
        spans.select(*KEY, F.col("prev.at").alias("seen"), last_at.alias("since"), first.alias("a"), last.alias("b"))
        .where(F.col("a") <= F.col("b"))
        .select(*KEY, "seen", "since", F.explode(F.sequence("a", "b")).alias("tick_no"))
    )
    tick = _long(start) + F.col("tick_no") * w.tick_sec
    return silent.join(heard_ticks(per_key, start, ticks, p), "tick_no", "left_semi").select(
        F.timestamp_seconds(tick).alias("tick_ts"),
        *KEY,
        F.timestamp_seconds("seen").alias("last_seen"),
        (tick - F.col("since")).alias("silent_sec"),
    )


def heard_ticks(per_key: DataFrame, start: int, ticks: int, p: Params = Params()) -> DataFrame:
    """Ticks at most ``quiet_sec`` after the newest receipt of any key."""
    w = p.watch
    overall = per_key.groupBy("tick_no").agg(F.max("at").alias("at"))
    last = F.least(F.floor((F.col("at") + w.quiet_sec - start) / w.tick_sec), _long(ticks))
    return (
        overall.select("tick_no", last.alias("b"))
        .where(F.col("tick_no") <= F.col("b"))
        .select(F.explode(F.sequence("tick_no", "b")).alias("tick_no"))
        .distinct()
    )


def watchdog_alerts(silent: DataFrame, p: Params = Params()) -> DataFrame:
    """Silent ticks after cooldown, with level, rule and text."""
    kept = throttle(silent, KEY, "tick_ts", p.watch.cooldown_sec)
    return kept.select(
        "tick_ts",
        F.lit("WARN").alias("level"),
        "line",
        L.direction(p=p).alias("direction"),
        F.lit("no_data").alias("rule"),
        "silent_sec",
        F.format_string(texts.NO_DATA_TEXT, F.col("silent_sec"), F.lit(p.watch.gap_sec)).alias("text"),
    )


def seed_from_current(current: DataFrame, now: Column, p: Params = Params()) -> DataFrame:
    """Last-seen times to start from, shifted so that the newest receipt is ``now``.

    Only distances between receipts are used, so the zone of the feed is irrelevant.
    """
    seen = (
        current.where(~L.is_blank("line"))
        .withColumn("ts", F.substring("recptn_dt", 1, 19).try_cast("timestamp"))
        .where(F.col("ts").isNotNull())
        .groupBy(*KEY)
        .agg(F.max(F.unix_timestamp("ts")).alias("at"))
    )
    newest = seen.agg(F.max("at")).scalar()
    return seen.select(*KEY, (F.unix_timestamp(now) - (newest - F.col("at"))).alias("last_seen_sec"))


def _expected(any_df: DataFrame, p: Params) -> DataFrame:
    """The expected keys, a handful of literals."""
    keys = [
        F.struct(F.lit(line).alias("line"), F.lit(d).alias("updn_line"))
        for line in p.watch.lines
        for d in p.watch.directions
    ]
    return any_df.sparkSession.range(1).select(F.inline(F.array(*keys)))


def tick_at_or_after(at: Column, start: int, step: int) -> Column:
    return F.greatest(F.ceil((at - start) / step), _long(0))


def _long(v) -> Column:
    return F.lit(v).cast("bigint")
