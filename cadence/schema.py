"""Schemas of the stored layers and of the wire formats."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _text(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


EVENT_FIELDS = (
    "event_id", "line", "subway_id", "train_no", "statn_id", "statn_nm",
    "statn_tnm", "updn_line", "train_sttus", "direct_at", "lstcar_at", "recptn_dt",
)

API_FIELDS = {
    "subwayId": "subway_id",
    "trainNo": "train_no",
    "statnId": "statn_id",
    "statnNm": "statn_nm",
    "statnTnm": "statn_tnm",
    "updnLine": "updn_line",
    "trainSttus": "train_sttus",
    "directAt": "direct_at",
    "lstcarAt": "lstcar_at",
    "recptnDt": "recptn_dt",
}

RAW = StructType(_text("raw_json"))

EVENT = StructType(_text(*EVENT_FIELDS))

POSITION_CURRENT = StructType(
    _text(*EVENT_FIELDS, "raw_json") + [StructField("ingested_at", TimestampType())]
)

POSITION_LOG = StructType(POSITION_CURRENT.fields + _text("dt"))

ARRIVAL = StructType(
    _text("line", "train_no", "statn_id", "statn_nm", "statn_tnm", "updn_line", "direct_at")
    + [StructField("arrival_ts", TimestampType())]
    + _text("dt")
)

DQ_WINDOW = StructType(
    [StructField("window_start", TimestampType()), StructField("window_end", TimestampType())]
    + _text("line")
    + [
        StructField(n, LongType())
        for n in (
            "total", "null_event_id", "null_statn_id",
            "null_statn_nm", "null_recptn_dt", "null_train_no",
        )
    ]
)

PLAN_CSV = StructType(
    _text("statn_nm", "direction", "time_band", "svc_type", "plan_p50_sec", "plan_n")
)

PLAN = StructType(
    _text("statn_nm", "direction", "time_band", "svc_type")
    + [StructField("plan_p50_sec", DoubleType()), StructField("plan_n", IntegerType())]
)

TIMETABLE_CSV = StructType(
    _text(
        "line", "station_cd", "fr_code", "station_nm", "train_no", "arrive_time",
        "left_time", "origin_station", "dest_station", "origin_nm", "dest_nm",
        "week_tag", "inout_tag", "express_yn", "fl_flag", "branch_line",
    )
)

# API names of the timetable columns after ``line``, in the same order.
TIMETABLE_API = (
    "STATION_CD", "FR_CODE", "STATION_NM", "TRAIN_NO", "ARRIVETIME", "LEFTTIME",
    "ORIGINSTATION", "DESTSTATION", "SUBWAYSNAME", "SUBWAYENAME", "WEEK_TAG",
    "INOUT_TAG", "EXPRESS_YN", "FL_FLAG", "BRANCH_LINE",
)
