"""Receipt heartbeat per line and minute, coverage, and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.clock import receipt_instant, receipt_ts
from cadence.functions.labels import is_blank
from cadence.operators.ordered import with_previous
from cadence.params import Params


def per_train_minutes(log: DataFrame, p: Params = Params()) -> DataFrame:
    """Records and summed ingest lag per line, minute and train: what adds up over parts of a log."""
    lag = F.unix_timestamp("ingested_at") - F.unix_timestamp(receipt_instant(p=p))
    return (
        log.where(~is_blank("recptn_dt"))
        .groupBy("line", F.date_trunc("minute", receipt_ts()).alias("minute_ts"), "train_no")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(lag).alias("lag_sum"),
            F.count(lag).alias("lag_n"),
        )
    )


def freshness_mart(log: DataFrame, p: Params = Params()) -> DataFrame:
    """Records, distinct trains and mean ingest lag per line and minute.

    Rows collapse per ``(line, minute, train)`` before the second level, so a hot
    line or minute is combined on the map side.
    """
    return per_train_minutes(log, p).groupBy("line", "minute_ts").agg(
        F.sum("n").alias("records"),
        F.count("train_no").alias("distinct_trains"),
        F.round(F.try_divide(F.sum("lag_sum"), F.sum("lag_n")), 1).alias("ingest_lag_avg_sec"),
    )


def coverage(fresh: DataFrame) -> DataFrame:
    return fresh.groupBy("line").agg(
        F.min("minute_ts").alias("first_min"),
        F.max("minute_ts").alias("last_min"),
        F.count(F.lit(1)).alias("minutes_with_data"),
        F.sum("records").alias("total_records"),
    )


def minute_gaps(fresh: DataFrame, p: Params = Params()) -> DataFrame:
    """Seconds since the line's previous minute with data; first minutes are left out."""
    rows = with_previous(fresh.select("line", "minute_ts"), ("line",), ("minute_ts",), ("minute_ts",), p=p)
    return rows.select(
        "line",
        "minute_ts",
        (F.unix_timestamp("minute_ts") - F.unix_timestamp("prev.minute_ts")).alias("gap_sec"),
    ).where(F.col("gap_sec").isNotNull())


def _is_hiccup(p: Params) -> Column:
    return (F.col("gap_sec") > p.hiccup_min * 60) & (F.col("gap_sec") <= p.boundary_min * 60)


def gap_classes(fresh: DataFrame, p: Params = Params()) -> DataFrame:
    """Expected boundaries against hiccups inside a collection window, per line."""
    gap = F.col("gap_sec")
    inside = F.when(gap <= p.boundary_min * 60, gap / 60.0)
    return (
        minute_gaps(fresh, p)
        .groupBy("line")
        .agg(
            F.count_if(gap > p.boundary_min * 60).alias("window_boundaries"),
            F.count_if(_is_hiccup(p)).alias("within_window_hiccups"),
            F.round(F.max(inside), 1).alias("max_hiccup_min"),
        )
    )


def hiccup_total(fresh: DataFrame, p: Params = Params()) -> DataFrame:
    return minute_gaps(fresh, p).agg(F.count_if(_is_hiccup(p)).alias("hiccups"))


def heartbeat_series(fresh: DataFrame) -> DataFrame:
    """Minute series for a chart, in time order."""
    return fresh.select(
        "line", F.col("minute_ts").cast("string").alias("minute_ts"), "records"
    ).orderBy("minute_ts", "line")
