"""Write, audit, publish, validate: bad data never reaches the served marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cadence.operators import headway as H
from cadence.operators import quality as Q
from cadence.operators.freshness import freshness_mart
from cadence.params import Params
from cadence.sources.store import MartStore

STAGED = {"headway": "staging/headway_by_station_tod", "freshness": "staging/service_freshness"}
SERVED = {"headway": "gold/headway_by_station_tod", "freshness": "gold/service_freshness"}
STAGES = ("write", "audit", "publish", "validate")


class AuditFailed(RuntimeError):
    """Raised by a gate; ``report`` holds the rows that failed."""

    def __init__(self, gate: str, report: list):
        super().__init__(f"{gate} failed: {report}")
        self.report = report


def write(
    store: MartStore,
    arrived: DataFrame,
    log: DataFrame,
    ties: Sequence[str] = H.DEFAULT_TIES,
    p: Params = Params(),
) -> dict[str, int]:
    """Build both marts into staging."""
    return store.write_all(
        {STAGED["headway"]: H.headway_mart(arrived, ties, p), STAGED["freshness"]: freshness_mart(log, p)}
    )


def staged_versions(store: MartStore) -> dict[str, int]:
    """The versions that the staged marts are at."""
    heads = {r["mart"]: r["version"] for r in store.heads().select("mart", "version").collect()}  # one row per mart
    return {m: heads[m] for m in STAGED.values()}


def audit(
    store: MartStore,
    p: Params = Params(),
    where: dict[str, str] = STAGED,
    versions: dict[str, int] | None = None,
) -> DataFrame:
    """Check both marts (at ``versions``); raises :class:`AuditFailed` when any rule does not hold."""
    at = versions or {}
    read = lambda k: store.read(where[k], at.get(where[k]))
    report = Q.audit(read("headway"), read("freshness"), p)
    failed = report.where("NOT ok").collect()  # at most one row per rule
    if failed:
        raise AuditFailed("audit", failed)
    return report


def publish(store: MartStore, versions: dict[str, int] | None = None, p: Params = Params()) -> None:
    """Move both served marts to the audited versions in one commit.

    Without the versions that an audit has passed, the staged ones are audited here.
    """
    if versions is None:
        versions = staged_versions(store)
        audit(store, p, versions=versions)
    store.publish({SERVED[k]: STAGED[k] for k in SERVED}, versions)


def validate(store: MartStore) -> DataFrame:
    """Served against staged row counts; raises when they differ or are zero."""
    report = Q.reconcile(
        {k: store.read(v) for k, v in SERVED.items()}, {k: store.read(v) for k, v in STAGED.items()}
    )
    failed = report.where("NOT ok").collect()  # at most one row per mart
    if failed:
        raise AuditFailed("validate", failed)
    return report


def run(
    store: MartStore,
    arrived: DataFrame,
    log: DataFrame,
    stage: str = "all",
    ties: Sequence[str] = H.DEFAULT_TIES,
    p: Params = Params(),
) -> None:
    """One stage by name, or all of them in order. A failing gate stops the rest."""
    if stage not in (*STAGES, "all"):
        raise ValueError(f"unknown stage {stage}")
    def audited() -> dict[str, int]:
        versions = staged_versions(store)
        audit(store, p, versions=versions)
        return versions

    if stage in ("write", "all"):
        write(store, arrived, log, ties, p)
    if stage in ("audit", "publish", "all"):
        versions = audited()
        if stage != "audit":
            publish(store, versions)
    if stage in ("validate", "all"):
        validate(store)


def build_direct(
    store: MartStore,
    arrived: DataFrame,
    log: DataFrame,
    ties: Sequence[str] = H.DEFAULT_TIES,
    p: Params = Params(),
) -> DataFrame:
    """Without staging: build the served marts, then require at least one row in each."""
    store.write_all(
        {SERVED["headway"]: H.headway_mart(arrived, ties, p), SERVED["freshness"]: freshness_mart(log, p)}
    )
    counts = Q.mart_counts(**{k: store.read(v) for k, v in SERVED.items()})
    failed = counts.where("n_rows < 1").collect()  # at most one row per mart
    if failed:
        raise AuditFailed("build", failed)
    return counts
