"""Planned against observed: plan headways, ratio classes, nearest planned time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import labels as L
from cadence.functions.clock import clock_seconds, second_of_day
from cadence.operators.headway import headway_histogram, histogram_stats, label_arrivals
from cadence.operators.sides import counted_broadcast
from cadence.params import Params

MATCH = ("statn_nm", "direction", "time_band", "svc_type")
DAY_SEC = 86_400


def timed(timetable: DataFrame) -> DataFrame:
    """Timetable with the planned time as seconds of the service day."""
    return timetable.withColumn("arrive_sec", clock_seconds(F.col("arrive_time"))).where(
        F.col("arrive_sec").isNotNull()
    )


def planned_headways(timetable: DataFrame, p: Params = Params(), week_tag: str = "1") -> DataFrame:
    """Median planned headway and its sample count, in the shape of the plan CSV.

    Input has ``station_nm inout_tag week_tag arrive_sec express_yn``. All trains
    together give the mixed service; each service is then measured on its own. Two
    trains of one second leave no gap between them, so seconds are made distinct
    first: a window partition then holds at most a day of seconds per service.
    """
    lab = p.labels
    day = timetable.where(F.col("week_tag") == week_tag).select(
        F.col("station_nm").alias("statn_nm"),
        F.when(F.col("inout_tag") == "1", lab.up).otherwise(lab.down).alias("direction"),
        F.when(F.col("express_yn") == "D", lab.svc_express).otherwise(lab.svc_local).alias("svc"),
        "arrive_sec",
    )
    seconds = day.distinct().select(
        "*", _planned_gap().alias("gap_any"), _planned_gap("svc").alias("gap_svc")
    )
    gaps = seconds.select(
        "statn_nm",
        "direction",
        L.band_of_hour(F.floor(F.col("arrive_sec") / 3600) % 24, lab).alias("time_band"),
        F.inline(
            F.array(
                F.struct(F.lit(lab.svc_all).alias("svc_type"), F.col("gap_any").alias("headway_sec")),
                F.struct(F.col("svc").alias("svc_type"), F.col("gap_svc").alias("headway_sec")),
            )
        ),
    )
    valid = gaps.where(F.col("headway_sec") > 0).withColumn("status", F.lit("valid"))
    stats = histogram_stats(headway_histogram(valid, MATCH, ()), MATCH, (), p)
    return stats.select(
        *MATCH,
        F.col("p50_sec").cast("double").alias("plan_p50_sec"),
        F.col("headway_samples").cast("int").alias("plan_n"),
    )


def _planned_gap(*extra: str):
    w = Window.partitionBy("statn_nm", "direction", *extra).orderBy("arrive_sec")
    return F.col("arrive_sec") - F.lag("arrive_sec").over(w)


def punctuality(mart: DataFrame, plan: DataFrame, p: Params = Params()) -> DataFrame:
    """Observed against planned median for one line on weekdays."""
    observed = mart.where(
        (F.col("line") == p.rules.plan_line) & (F.col("day_type") == p.labels.weekday)
    )
    ratio = F.col("p50_sec") / F.nullif(F.col("plan_p50_sec"), F.lit(0.0))
    return observed.join(plan, list(MATCH)).select(
        "line",
        "statn_nm",
        "direction",
        "svc_type",
        "time_band",
        "headway_samples",
        F.col("p50_sec").alias("obs_p50_sec"),
        "cv",
        "plan_p50_sec",
        F.round(ratio, 2).alias("vs_plan_ratio"),
        F.round(F.col("p50_sec") - F.col("plan_p50_sec"), 0).alias("excess_sec"),
        L.punctuality_class(ratio, p).alias("punctuality"),
    )


def worst_to_plan(table: DataFrame, p: Params = Params(), limit: int = 15) -> DataFrame:
    return (
        table.where(
            (F.col("svc_type") == p.labels.svc_all)
            & L.is_rush(p=p)
            & (F.col("headway_samples") >= p.min_samples)
        )
        .orderBy(F.desc("vs_plan_ratio"), "statn_nm", "direction", "time_band")
        .limit(limit)
        .select(
            "statn_nm", "direction", "time_band", F.col("headway_samples").alias("n"),
            "obs_p50_sec", "plan_p50_sec", "vs_plan_ratio", "punctuality",
        )
    )


def service_vs_plan(table: DataFrame, p: Params = Params()) -> DataFrame:
    lab = p.labels
    return (
        table.where(
            F.col("svc_type").isin(lab.svc_express, lab.svc_local)
            & L.is_rush(p=p)
            & (F.col("headway_samples") >= p.min_samples)
        )
        .groupBy("svc_type")
        .agg(
            F.count(F.lit(1)).alias("groups"),
            F.round(F.avg("vs_plan_ratio"), 2).alias("avg_vs_plan"),
            F.round(F.avg("obs_p50_sec"), 0).alias("avg_obs"),
            F.round(F.avg("plan_p50_sec"), 0).alias("avg_plan"),
        )
    )


def nearest_spans(timetable: DataFrame, p: Params = Params()) -> DataFrame:
    """For every planned time, the stretch of the service day to which it is nearest.

    A service day runs from ``service_day_start_sec`` to the same second after 24:00. A planned
    time before its start stands for the one after midnight.

    The stretches of one ``(station, direction, week tag)`` tile the day: each
    second belongs to exactly one planned time (the earlier one on a tie). They are
    cut at full hours, so an arrival meets at most the few stretches of its hour.
    Bounds are in half seconds: ``lo2 < 2 * second <= hi2``.
    """
    keys = ("station_nm", "inout_tag", "week_tag")
    w = Window.partitionBy(*keys).orderBy("arrive_sec")
    at, start = F.col("arrive_sec"), p.service_day_start_sec
    spans = (
        timetable.select(*keys, F.when(at < start, at + DAY_SEC).otherwise(at).alias("arrive_sec"))
        .distinct()
        .select(
            *keys,
            "arrive_sec",
            F.coalesce(F.lag(at).over(w) + at, F.lit(2 * start - 1)).alias("lo2"),
            F.coalesce(at + F.lead(at).over(w), F.lit(2 * (start + DAY_SEC))).alias("hi2"),
        )
    )
    first = F.greatest(F.floor((F.col("lo2") + 1) / 7200), F.lit(start // 3600))
    last = F.least(F.floor(F.col("hi2") / 7200), F.lit((start + DAY_SEC - 1) // 3600))
    return spans.where(first <= last).withColumn("hour_no", F.explode(F.sequence(first, last)))


def nearest_plan_delay(
    arrived: DataFrame, timetable: DataFrame, p: Params = Params()
) -> DataFrame:
    """Delay of each arrival against the nearest planned time of its station.

    Stations are matched by name, directions and day types by their timetable tags.
    An equi-join on station, tags and hour with a range test inside the hour: no
    nested loop, one match per arrival, and the arrivals are not shuffled while the
    timetable stays under the broadcast limit.
    """
    spans = counted_broadcast(nearest_spans(timetable, p), p)
    start = p.service_day_start_sec
    in_day = F.col("arrival_ts") - F.make_dt_interval(secs=F.lit(start).cast("decimal(18,6)"))
    actual = label_arrivals(arrived, p).withColumn("actual_sec", second_of_day(in_day) + start)
    actual = actual.withColumns(
        {
            "hour_no": F.floor(F.col("actual_sec") / 3600),
            "inout_tag": L.inout_tag(),
            "week_tag": L.week_tag(L.day_type(in_day, p), p),
            "station_nm": F.col("statn_nm"),
        }
    )
    twice = F.col("actual_sec") * 2
    delay = F.col("actual_sec") - F.col("arrive_sec")
    return (
        actual.join(spans, ["station_nm", "inout_tag", "week_tag", "hour_no"])
        .where((twice > F.col("lo2")) & (twice <= F.col("hi2")))
        .select(
            "line", "train_no", "statn_id", "station_nm", "direction", "svc", "day_type",
            "time_band", "arrival_ts",
            F.col("arrive_sec").alias("planned_sec"),
            delay.alias("delay_sec"),
            F.when(delay > p.late_after_sec, 1).otherwise(0).alias("is_delayed"),
        )
    )


def delay_stats(delays: DataFrame, *keys: str) -> DataFrame:
    """Arrivals, late arrivals, late share and mean delay per group."""
    return delays.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("arrivals"),
        F.sum("is_delayed").alias("delayed"),
        F.round(F.sum("is_delayed") / F.count(F.lit(1)), 3).alias("delay_rate"),
        F.round(F.avg("delay_sec"), 1).alias("avg_delay_sec"),
    )


def delay_by_station(delays: DataFrame) -> DataFrame:
    return delay_stats(delays, "station_nm")


def delay_by_timeband(delays: DataFrame) -> DataFrame:
    return delay_stats(delays, "day_type", "time_band")


def delay_by_direction(delays: DataFrame) -> DataFrame:
    return delay_stats(delays, "direction").drop("delay_rate")


def most_delayed(by_station: DataFrame, limit: int = 5) -> DataFrame:
    return by_station.orderBy(F.desc("delayed"), F.desc("delay_rate"), "station_nm").limit(limit)
