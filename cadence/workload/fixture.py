"""Position rows, raw records and a timetable derived from the ``events`` table.

Every row of ``events`` becomes one position row, so the work of each registered
query grows with the table. Defects are injected by row number: blank and NULL
trains and stations, blank receipts, missing keys, malformed records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions import labels as L
from cadence.functions.clock import receipt_ts, second_of_day
from cadence.operators.arrivals import arrivals
from cadence.params import AlertRules, LineRules, Params, WatchRules
from cadence.sources.staging import stage

TIES = ("ingest_seq",)

# The derived feed is sparser than a 30-second poll, so time limits are stretched.
PARAMS = Params(
    rules=LineRules(
        branch_line="view",
        branch_stations=("ST1",),
        edge_line="click",
        edge_stations=("ST2",),
        holidays=("2024-01-15",),
        plan_line="click",
    ),
    alerts=AlertRules(
        window="3 hours", min_rows=5, train_null_rate=0.1, exempt_line="click", cooldown_sec=28_800
    ),
    watch=WatchRules(
        lines=("click", "error", "purchase", "signup", "view", "ghost"),
        gap_sec=7_200,
        quiet_sec=1_800,
        tick_sec=3_600,
        cooldown_sec=28_800,
    ),
    max_headway_sec=7_200,
)


def position_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    seq = F.col("event_id")
    every = lambda n: seq % n == 0
    none = F.lit(None).cast("string")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    station = F.floor(k / 25).cast("int").cast("string")
    second = F.date_trunc("second", "ts")
    return events.select(
        seq.alias("ingest_seq"),
        F.col("event_type").alias("line"),
        F.when(every(53), "").when(every(59), none).otherwise(
            (F.col("user_id") % 40).cast("string")
        ).alias("train_no"),
        F.when(every(61), none).when(every(67), "").otherwise(station).alias("statn_id"),
        F.when(every(61), none).otherwise(F.concat(F.lit("ST"), station)).alias("statn_nm"),
        (k % 2).cast("string").alias("updn_line"),
        (seq % 4).cast("string").alias("train_sttus"),
        F.when(F.col("event_type").isin("click", "view") & every(3), "1").otherwise("0").alias("direct_at"),
        F.when(every(71), "").otherwise(second.cast("string")).alias("recptn_dt"),
        (second + F.make_dt_interval(secs=(seq % 9).cast("decimal(18,6)"))).alias("ingested_at"),
    )


def position_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    day = F.substring("recptn_dt", 1, 10)
    key = F.concat_ws("-", part("train_no"), part("statn_id"), part("train_sttus"), day)
    return position_src(spark, sf_dir).select(
        "*",
        F.when(F.col("ingest_seq") % 73 != 0, key).alias("event_id"),
        day.alias("dt"),
    )


RECORD = (
    "event_id", "line", "train_no", "statn_id", "statn_nm",
    "updn_line", "train_sttus", "direct_at", "recptn_dt",
)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per row; every 101st is malformed, every 97th has an object as a value."""
    flat = F.to_json(F.struct(*RECORD), {"ignoreNullFields": "false"})
    nested = F.to_json(
        F.struct(*RECORD, F.struct(F.col("direct_at").alias("flag")).alias("lstcar_at")),
        {"ignoreNullFields": "false"},
    )
    seq = F.col("ingest_seq")
    return position_log(spark, sf_dir).select(
        "ingest_seq",
        F.when(seq % 101 == 0, "not json").when(seq % 97 == 0, nested).otherwise(flat).alias("raw_json"),
        "ingested_at",
    )


def staged_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrivals table, written once per call, as the marts read it several times."""
    return stage(arrivals(position_log(spark, sf_dir), TIES, PARAMS), "arrivals")


def timetable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned times: quarter-hour slots at which any line was seen, shifted per station."""
    rows = position_log(spark, sf_dir).where(
        F.col("statn_nm").isNotNull() & ~L.is_blank("recptn_dt")
    )
    ts = receipt_ts()
    slot = F.floor(second_of_day(ts) / 900) * 900
    return rows.select(
        F.col("statn_nm").alias("station_nm"),
        L.week_tag(L.day_type(ts, PARAMS), PARAMS).alias("week_tag"),
        L.inout_tag().alias("inout_tag"),
        (slot + F.substring("statn_nm", 3, 2).cast("int") * 90).alias("arrive_sec"),
        F.when(F.col("train_sttus") == "0", "D").otherwise("G").alias("express_yn"),
    ).distinct()
