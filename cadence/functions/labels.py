"""Classification columns: direction, service, branch, time band, day type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadence.params import Labels, Params


def is_blank(c: Column | str) -> Column:
    """True for NULL and for the empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (c == "")


def broken_key(c: Column | str) -> Column:
    """True for a blank composite key and for one whose two leading parts are empty."""
    c = F.col(c) if isinstance(c, str) else c
    return is_blank(c) | c.startswith("--")


def or_missing(c: Column | str, p: Params = Params()) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(p.labels.missing_line))


def known_direction(updn: Column | str = "updn_line") -> Column:
    return (F.col(updn) if isinstance(updn, str) else updn).isin("0", "1")


def direction(updn: Column | str = "updn_line", p: Params = Params()) -> Column:
    c = F.col(updn) if isinstance(updn, str) else updn
    return (
        F.when(c == "0", p.labels.up).when(c == "1", p.labels.down).otherwise(p.labels.unknown)
    )


def service(express_flag: Column | str = "direct_at", p: Params = Params()) -> Column:
    c = F.col(express_flag) if isinstance(express_flag, str) else express_flag
    return F.when(c == "1", p.labels.svc_express).otherwise(p.labels.svc_local)


def branch(line: str = "line", station: str = "statn_nm", p: Params = Params()) -> Column:
    on_branch = (F.col(line) == p.rules.branch_line) & F.col(station).isin(*p.rules.branch_stations)
    return F.when(on_branch, p.labels.branch_line).otherwise(p.labels.main_line)


def band_of_hour(hour: Column, lab: Labels) -> Column:
    return (
        F.when(hour.between(5, 6), lab.dawn)
        .when(hour.between(7, 9), lab.morning)
        .when(hour.between(10, 16), lab.midday)
        .when(hour.between(17, 19), lab.evening)
        .otherwise(lab.night)
    )


def time_band(ts: Column | str, p: Params = Params()) -> Column:
    return band_of_hour(F.hour(ts), p.labels)


def day_type(ts: Column | str, p: Params = Params()) -> Column:
    """Listed holidays win over the weekday; Sunday counts as a holiday."""
    lab, dow = p.labels, F.dayofweek(ts)
    return (
        F.when(F.date_format(ts, "yyyy-MM-dd").isin(*p.rules.holidays), lab.holiday)
        .when(dow == 1, lab.holiday)
        .when(dow == 7, lab.saturday)
        .otherwise(lab.weekday)
    )


def week_tag(day: Column, p: Params = Params()) -> Column:
    """Timetable tag of a day type: 1 weekday, 2 Saturday, 3 holiday."""
    lab = p.labels
    return F.when(day == lab.holiday, "3").when(day == lab.saturday, "2").otherwise("1")


def inout_tag(updn: Column | str = "updn_line") -> Column:
    """Timetable tag of a direction code: 0 becomes 1, 1 becomes 2."""
    c = F.col(updn) if isinstance(updn, str) else updn
    return F.when(c == "0", "1").when(c == "1", "2")


def is_rush(band: Column | str = "time_band", p: Params = Params()) -> Column:
    return (F.col(band) if isinstance(band, str) else band).isin(*p.labels.rush)


def punctuality_class(ratio: Column, p: Params = Params()) -> Column:
    """NULL (a zero plan) falls through to the worst class."""
    return (
        F.when(ratio <= p.on_time_ratio, p.labels.on_time)
        .when(ratio <= p.late_ratio, p.labels.tends_late)
        .otherwise(p.labels.very_late)
    )


def headway_status(gap: Column, p: Params = Params()) -> Column:
    """Why a gap is or is not used: ``first nonpos normal_term gap_missing valid``."""
    r = p.rules
    at_edge = (F.col("line") == r.edge_line) & F.col("statn_nm").isin(*r.edge_stations)
    return (
        F.when(gap.isNull(), "first")
        .when(gap <= 0, "nonpos")
        .when((gap > p.max_headway_sec) & at_edge, "normal_term")
        .when(gap > p.max_headway_sec, "gap_missing")
        .otherwise("valid")
    )
