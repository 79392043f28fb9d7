"""Receipt strings to timestamps. Bad text gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadence.params import Params


def receipt_ts(c: str = "recptn_dt") -> Column:
    """Wall clock of the feed, held in the session time zone."""
    return F.col(c).try_cast("timestamp")


def receipt_instant(c: str = "recptn_dt", p: Params = Params()) -> Column:
    """The same receipt as an absolute instant, for comparison with zoned columns."""
    if p.feed_zone is None:
        return receipt_ts(c)
    return F.concat_ws(" ", F.col(c), F.lit(p.feed_zone)).try_cast("timestamp")


def clock_seconds(hhmmss: Column) -> Column:
    """``HH:MM:SS`` to seconds of the service day; hours past 23 are allowed."""
    part = F.split(hhmmss, ":")
    h, m, s = (F.try_element_at(part, F.lit(i)).try_cast("int") for i in (1, 2, 3))
    return h * 3600 + m * 60 + F.coalesce(s, F.lit(0))


def second_of_day(ts: Column | str) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
