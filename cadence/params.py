"""Every threshold, label and reference list, as frozen dataclasses.

Nothing is read from the environment: a caller builds a ``Params`` and passes it
down, so one session can hold several settings side by side (the batch mart and
an exploratory run with another cut-off, for example).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Labels:
    """Output labels. The defaults are fixed values of the published marts."""

    up: str = "상행"
    down: str = "하행"
    unknown: str = "미상"
    svc_all: str = "전체"
    svc_express: str = "급행"
    svc_local: str = "완행"
    main_line: str = "본선"
    branch_line: str = "지선"
    dawn: str = "새벽"
    morning: str = "출근"
    midday: str = "점심"
    evening: str = "퇴근"
    night: str = "밤"
    weekday: str = "평일"
    saturday: str = "토요일"
    holiday: str = "휴일"
    on_time: str = "정시"
    tends_late: str = "지연경향"
    very_late: str = "큰지연"
    missing_line: str = "(null)"

    @property
    def directions(self) -> tuple[str, ...]:
        return (self.up, self.down)

    @property
    def services(self) -> tuple[str, ...]:
        return (self.svc_all, self.svc_express, self.svc_local)

    @property
    def bands(self) -> tuple[str, ...]:
        return (self.dawn, self.morning, self.midday, self.evening, self.night)

    @property
    def rush(self) -> tuple[str, ...]:
        return (self.morning, self.evening)


@dataclass(frozen=True)
class LineRules:
    """Station lists and holidays. The defaults are fixed values."""

    branch_line: str = "2호선"
    branch_stations: tuple[str, ...] = (
        "성수지선", "용답", "신답", "용두", "신설동",
        "신정지선", "신도림지선", "도림천", "양천구청", "신정네거리", "까치산",
    )
    edge_line: str = "1호선"
    edge_stations: tuple[str, ...] = (
        "서울역", "청량리", "광운대", "구로", "도봉산",
        "인천", "신창", "서동탄", "광명", "병점",
    )
    holidays: tuple[str, ...] = ("2026-07-17",)
    plan_line: str = "9호선"


@dataclass(frozen=True)
class AlertRules:
    """Thresholds of the validity alerts over data-quality windows."""

    window: str = "1 minute"
    min_rows: int = 5
    train_null_rate: float = 0.5
    exempt_line: str = "1호선"
    cooldown_sec: int = 300
    critical_fields: tuple[str, ...] = ("statn_id", "statn_nm", "recptn_dt")


@dataclass(frozen=True)
class WatchRules:
    """Thresholds of the completeness watchdog."""

    lines: tuple[str, ...] = ("1호선", "2호선", "9호선")
    directions: tuple[str, ...] = ("0", "1")
    gap_sec: int = 180
    quiet_sec: int = 90
    tick_sec: int = 20
    cooldown_sec: int = 300


@dataclass(frozen=True)
class Params:
    """One bundle handed to every operator.

    ``hot_key_rows`` is the largest number of rows one window partition may hold
    before it is cut into time slices (see ``operators.ordered``).
    ``broadcast_rows`` is the largest counted side that gets a broadcast hint.
    ``service_day_start_sec`` is the second of the day at which a timetable's day
    begins; earlier arrivals belong to the day before, after its 24:00.
    ``feed_zone`` is the zone of the zone-less receipt strings; ``None`` means the
    session time zone.
    """

    labels: Labels = field(default_factory=Labels)
    rules: LineRules = field(default_factory=LineRules)
    alerts: AlertRules = field(default_factory=AlertRules)
    watch: WatchRules = field(default_factory=WatchRules)
    max_headway_sec: int = 900
    min_samples: int = 5
    over_ratio_num: int = 3
    over_ratio_den: int = 2
    hiccup_min: float = 1.5
    boundary_min: float = 30.0
    on_time_ratio: float = 1.15
    late_ratio: float = 1.5
    late_after_sec: int = 60
    service_day_start_sec: int = 10_800
    feed_zone: str | None = None
    hot_key_rows: int = 4_000_000
    broadcast_rows: int = 200_000

    def but(self, **changes) -> Params:
        return replace(self, **changes)


HEADWAY_KEYS = ("line", "statn_id", "direction", "svc_type", "time_band", "day_type")
