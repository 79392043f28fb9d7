"""Alert texts and JSON records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message formats of the alert records.
CRITICAL_TEXT = "%s 창에서 %s null %d건 / 총 %d건 — 스키마·파싱 이상 의심"
TRAIN_NULL_TEXT = "%s 창 train_no null %d/%d (%s) — 비정상 급증"
LOW_VOLUME_TEXT = "%s 창 수신 %d건(<%d) — 수집 지연/장애 의심"
NO_DATA_TEXT = "%ds 무수신(>%ds) — 노선·방향 끊김 의심"
LOG_LINE = "[%s] %s · %s · %s — %s"

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def percent_text(share: Column) -> Column:
    """Integer percent, ties to even."""
    return F.concat(F.bround(share * 100, 0).cast("bigint").cast("string"), F.lit("%"))


def as_json(*cols: str, timestamp_format: str = ISO_FORMAT) -> Column:
    """Compact JSON of the named columns; text outside ASCII is kept as it is."""
    return F.to_json(
        F.struct(*cols), {"timestampFormat": timestamp_format, "ignoreNullFields": "false"}
    )


def log_line(at: Column, level: Column, line: Column, rule: Column, text: Column) -> Column:
    stamp = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    return F.format_string(LOG_LINE, stamp, level, line, rule, text)
