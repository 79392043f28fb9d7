"""Data-quality windows, alert rules and cooldown."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions import labels as L
from cadence.functions import texts
from cadence.params import Params
from cadence.sources.staging import stage

COUNTED = ("statn_id", "statn_nm", "recptn_dt", "train_no")
#: Slices of a timeline that are summed up together.
CHAIN = 64
CHECKED_FIELDS = ("line", "event_id", *COUNTED)  # all that a window needs of a record


def null_windows(events: DataFrame, ts: str, p: Params = Params()) -> DataFrame:
    """Row count and null counters per tumbling window and line.

    Works on a batch and on a stream alike. A blank counts as NULL, and so does a
    composite key whose leading parts are empty.
    """
    return (
        events.groupBy(
            F.window(ts, p.alerts.window).alias("w"), L.or_missing("line", p).alias("line")
        )
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(L.broken_key("event_id")).alias("null_event_id"),
            *(F.count_if(L.is_blank(c)).alias(f"null_{c}") for c in COUNTED),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "line",
            "total",
            "null_event_id",
            *(f"null_{c}" for c in COUNTED),
        )
    )


def window_messages(windows: DataFrame) -> DataFrame:
    """One JSON text per window row, timestamps in ISO 8601, for a message sink."""
    return windows.select(texts.as_json(*windows.columns).alias("value"))


def alert_rules(windows: DataFrame, p: Params = Params()) -> DataFrame:
    """Zero or more alerts per window row: ``window_end level line rule text``.

    Stateless, one row in and up to five out, so it also runs on a stream.
    """
    r = p.alerts
    end_text = F.date_format("window_end", texts.ISO_FORMAT)
    total = F.col("total")
    share = F.col("null_train_no") / F.nullif(total, F.lit(0))
    made: list[Column] = []
    for field in r.critical_fields:
        n = F.col(f"null_{field}")
        made.append(
            F.when(
                n > 0,
                _alert(
                    "CRITICAL",
                    field,
                    F.format_string(texts.CRITICAL_TEXT, end_text, F.lit(field), n, total),
                ),
            )
        )
    made.append(
        F.when(
            (total > 0) & (F.col("line") != r.exempt_line) & (share >= r.train_null_rate),
            _alert(
                "WARN",
                "train_no",
                F.format_string(
                    texts.TRAIN_NULL_TEXT,
                    end_text, F.col("null_train_no"), total, texts.percent_text(share),
                ),
            ),
        )
    )
    made.append(
        F.when(
            (total > 0) & (total < r.min_rows),
            _alert(
                "WARN",
                "low_volume",
                F.format_string(texts.LOW_VOLUME_TEXT, end_text, total, F.lit(r.min_rows)),
            ),
        )
    )
    return windows.select(
        "window_end", "line", F.inline(F.array_compact(F.array(*made)))
    ).select("window_end", "level", "line", "rule", "text")


def _alert(level: str, rule: str, text: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule"), text.alias("text"))


def alert_log(alerts: DataFrame, at: str = "window_end") -> DataFrame:
    """Log line per alert."""
    c = F.col
    return alerts.select(
        at, "line", "rule", texts.log_line(c(at), c("level"), c("line"), c("rule"), c("text")).alias("message")
    )


def throttle(
    alerts: DataFrame, keys: Sequence[str], at: str, cooldown_sec: int, slice_sec: int = 86_400
) -> DataFrame:
    """Greedy cooldown: keep an alert when its key was silent for ``cooldown_sec``.

    A suppressed alert does not move the clock, so this is a left fold per key. To
    keep groups bounded the timeline is cut into slices (a day by default, a cooldown at least):

    * a slice's fold depends on the past only through the first alert it lets
      through, and that one lies within one cooldown of the slice's first alert (or
      is the next after), so a slice is summed up by a short list of
      ``first -> last`` pairs;
    * the lists of ``CHAIN`` neighbouring slices are summed up by a list of the same kind: an alert before them holds back at most
      the first slice, so what they let through first lies in it, or opens the second;
    * the lists of these chains are followed per key, which gives the last alert before each chain; then the lists of
      the slices inside each chain, which gives the last alert before each slice;
    * the slices are then folded independently.

    NULL keys are keys like any other. A group is one key and slice, holding one alert per window or tick of that
    time, one key and chain, holding ``CHAIN`` lists, or one key with a list per chain of ``CHAIN`` days.
    """
    cd = F.lit(int(cooldown_sec)).cast("bigint")
    slice_sec = max(int(slice_sec), int(cooldown_sec))
    never = F.lit(-(1 << 60)).cast("bigint")
    stamped = alerts.withColumn("__t", F.unix_timestamp(at)).withColumn(
        "__slice", F.floor(F.col("__t") / slice_sec)
    )
    times = stamped.groupBy(*keys, "__slice").agg(
        F.array_sort(F.collect_set("__t")).alias("__ts")
    )

    ts = F.col("__ts")
    soon = F.filter(ts, lambda t: t < F.element_at(ts, 1) + cd)
    later = F.slice(F.filter(ts, lambda t: t >= F.element_at(ts, 1) + cd), 1, 1)
    last_of = lambda c: F.aggregate(
        ts, c, lambda acc, t: F.when((t > acc) & (t >= acc + cd), t).otherwise(acc)
    )
    hops = F.transform(
        F.concat(soon, later), lambda c: F.struct(c.alias("first"), last_of(c).alias("last"))
    )

    def after(last: Column, part: Column) -> Column:
        """The last alert once a part was passed with ``last`` before it."""
        usable = F.filter(part["hops"], lambda h: h["first"] >= last + cd)
        return F.coalesce(F.get(usable, F.lit(0))["last"], last)

    def through(parts: Column, number: int, last: Column) -> Column:
        """The same for all parts from the given one on."""
        return F.aggregate(F.slice(parts, number, CHAIN), last, after)

    parts = F.col("parts")
    summed = times.select(*keys, F.floor(F.col("__slice") / CHAIN).alias("__chain"), F.struct(F.col("__slice").alias("no"), hops.alias("hops")).alias("s"))
    chains = stage(summed.groupBy(*keys, "__chain").agg(F.array_sort(F.collect_list("s")).alias("parts")), "chains")
    held = F.transform(F.get(parts, F.lit(0))["hops"], lambda h: F.struct(h["first"].alias("first"), through(parts, 2, h["last"]).alias("last")))
    opened = F.transform(F.slice(F.get(parts, F.lit(1))["hops"], 1, 1), lambda h: F.struct(h["first"].alias("first"), through(parts, 3, h["last"]).alias("last")))
    own = F.concat(held, F.coalesce(opened, F.array().cast("array<struct<first:bigint,last:bigint>>")))
    lists = chains.select(*keys, F.struct(F.col("__chain").alias("no"), own.alias("hops")).alias("s")).groupBy(*keys).agg(F.array_sort(F.collect_list("s")).alias("parts"))

    def followed(rows: DataFrame, first: Column, name: str) -> DataFrame:
        """``keys name entry``: the last alert before each part, ``first`` being that before all of them."""
        start = F.struct(first.alias("last"), F.array().cast("array<struct<no:bigint,entry:bigint>>").alias("out"))
        step = lambda acc, s: F.struct(
            after(acc["last"], s).alias("last"),
            F.concat(acc["out"], F.array(F.struct(s["no"].alias("no"), acc["last"].alias("entry")))).alias("out"),
        )
        return rows.select(*keys, F.inline(F.aggregate("parts", start, step, lambda acc: acc["out"]))).withColumnRenamed("no", name)

    before = followed(lists, never, "__chain")
    entries = followed(chains.join(*_null_safe(before, [*keys, "__chain"])).select(*keys, "parts", "entry"), F.col("entry"), "__slice")

    fold = F.aggregate(
        ts,
        F.struct(F.col("entry").alias("last"), F.array().cast("array<bigint>").alias("out")),
        lambda acc, t: F.when(
            t >= acc["last"] + cd,
            F.struct(t.alias("last"), F.concat(acc["out"], F.array(t)).alias("out")),
        ).otherwise(acc),
        lambda acc: acc["out"],
    )
    kept = times.join(*_null_safe(entries, [*keys, "__slice"])).select(
        *keys, "__slice", F.explode(fold).alias("__t")
    )
    once = stamped.dropDuplicates([*keys, "__slice", "__t"])
    return once.join(*_null_safe(kept, [*keys, "__slice", "__t"]), "left_semi").drop("__t", "__slice")


def _null_safe(side: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """The side under other names, and the condition that its keys are the same."""
    same = [F.col(k).eqNullSafe(F.col(f"__is_{k}")) for k in keys]
    rest = [c for c in side.columns if c not in keys]
    return side.select(*(F.col(k).alias(f"__is_{k}") for k in keys), *rest), reduce(lambda a, b: a & b, same)
