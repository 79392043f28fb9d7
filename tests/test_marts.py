"""Quality suites, the mart store, and write-audit-publish."""

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from cadence.operators import arrivals as A
from cadence.operators import freshness as FR
from cadence.operators import headway as H
from cadence.operators import quality as Q
from cadence.plans import daily, ranges, wap
from cadence.sources.external import ExternalMarts
from cadence.sources.staging import stage
from cadence.sources.store import MartStore, StaleVersion
from cadence.workload import fixture as X
from cadence.workload import registered
from cadence.workload.registered import GAP_TIES

P = X.PARAMS.but(max_headway_sec=86_400)


@pytest.fixture(scope="module")
def layers(spark, sf):
    log = X.position_log(spark, sf).where(F.col("train_no").isNotNull()).cache()
    arrived = A.arrivals(log, X.TIES, P).cache()
    return log, arrived, H.headway_mart(arrived, GAP_TIES, P).cache()


def failed(report):
    return {(r.expectation, r.column) for r in report.collect() if not r.success}


def test_clean_mart_passes_and_contaminated_marts_fail(layers):
    mart = layers[2]
    rules = Q.headway_rules(P)
    assert failed(Q.run_suite(mart, rules)) == set()
    assert failed(Q.run_suite(Q.spoil(mart, cv=99.0, direction="X"), rules)) == {
        (Q.BETWEEN, "cv"), (Q.IN_SET, "direction"),
    }
    bad = Q.with_bad_row(mart, direction=None, cv=9.9)
    report = {(r.expectation, r.column): r.unexpected_count for r in Q.run_suite(bad, rules).collect() if not r.success}
    assert report == {(Q.NOT_NULL, "direction"): 1, (Q.BETWEEN, "cv"): 1}


def test_duplicate_keys_and_order_violations_are_counted(layers):
    mart = layers[2]
    twice = mart.unionByName(mart.limit(3)).withColumn("p90_sec", F.col("p50_sec") - 1)
    got = {r.check: (r.checked, r.violations) for r in Q.consistency_checks(twice).collect()}
    n = mart.count()
    assert got["p90_sec >= p50_sec"] == (n + 3, n + 3)
    assert got["grain 유일성(중복 그룹 없음)"] == (n, 3)


def test_empty_mart_fails(spark, layers):
    empty = layers[2].limit(0)
    assert (Q.ROW_COUNT, None) in failed(Q.run_suite(empty, Q.headway_rules(P)))
    assert [r.violations for r in Q.consistency_checks(empty).collect()] == [None] * 3
    assert not any(r.ok for r in Q.audit(empty, empty.sparkSession.createDataFrame(
        [], "records long, distinct_trains long"), P).where("source = 'check'").collect())


def test_one_scan_per_suite(layers):
    suite = Q.run_suite(stage(layers[2], "mart"), Q.headway_rules(P))
    plan = suite._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_wap_publishes_only_audited_marts(spark, folder, layers):
    log, arrived, mart = layers
    store = MartStore(spark, folder)
    wap.run(store, arrived, log, "all", GAP_TIES, P)
    served = wap.SERVED["headway"]
    assert as_set(store.read(served)) == as_set(mart)

    store.write(wap.STAGED["headway"], Q.spoil(mart, cv=99.0))
    with pytest.raises(wap.AuditFailed) as e:
        wap.audit(store, P)
    assert {r["column"] for r in e.value.report} == {"cv"}
    assert as_set(store.read(served)) == as_set(mart)
    store.write(wap.STAGED["headway"], mart.limit(0))
    with pytest.raises(wap.AuditFailed):
        wap.validate(store)
    with pytest.raises(ValueError):
        wap.run(store, arrived, log, "nonsense", GAP_TIES, P)


def test_both_marts_move_in_one_commit(spark, folder, layers):
    store = MartStore(spark, folder)
    wap.run(store, layers[1], layers[0], "all", GAP_TIES, P)
    rows = store.commits().where("operation = 'publish'").collect()
    assert len(rows) == 2 and len({r["commit"] for r in rows}) == 1


def test_recovery_drill(spark, folder, layers):
    """Publish, empty, look up the history, roll back: the rows return."""
    mart, store = layers[2], MartStore(spark, folder)
    n = mart.count()
    first = store.write("gold/h", mart)
    store.write("gold/other", mart.limit(2))
    assert store.empty("gold/h") == (n, 0)
    assert store.read("gold/h").count() == 0 and store.read("gold/h").columns == mart.columns
    assert [r.operation for r in store.history("gold/h").collect()] == ["delete", "replace"]
    assert store.rollback("gold/h", first) == (0, n)
    other = MartStore(spark.newSession(), folder)  # another session sees the same head
    assert as_set(other.read("gold/h")) == as_set(mart)
    assert [r.mart for r in other.marts().collect()] == ["gold/h", "gold/other"]
    assert [r.total_records for r in other.history("gold/h", 2).collect()] == [n, 0]
    with pytest.raises(LookupError):
        store.rollback("gold/h", 99)


def test_compaction_keeps_rows(spark, folder, layers):
    store = MartStore(spark, folder)
    store.write("m", layers[0].drop("ingested_at").repartition(9))
    done = store.compact("m").first()
    assert done.files_before == 9 and done.files_after == 1 and done.rows_unchanged
    assert store.history("m").first().operation == "compact"


def test_direct_build_needs_rows(spark, folder, layers):
    log, arrived, _ = layers
    with pytest.raises(wap.AuditFailed):
        wap.build_direct(MartStore(spark, folder), arrived.limit(0), log, GAP_TIES, P)


def test_daily_runs_equal_one_run(spark, folder, layers):
    log, arrived, mart = layers
    store = MartStore(spark, folder)
    express = H.express_lines(H.label_arrivals(arrived, P), P)
    for lo, hi in (("", "2024-01-09"), ("2024-01-09", "2024-01-20"), ("2024-01-20", "9")):
        part = log.where((F.col("dt") >= lo) & (F.col("dt") < hi))
        assert daily.run_day(store, lo or "start", part, express, X.TIES, GAP_TIES, P)
        assert not daily.run_day(store, lo or "start", part, express, X.TIES, GAP_TIES, P)
    assert as_set(store.read(daily.MART)) == as_set(mart)
    # a replay of finished days under another name changes nothing
    daily.run_day(store, "replay", log.where("dt < '2024-01-12'"), express, X.TIES, GAP_TIES, P)
    assert as_set(store.read(daily.MART)) == as_set(mart)
    assert as_set(daily.read_arrivals(store)) == as_set(arrived)


def test_daily_run_stores_its_rows_once(spark, folder, layers, monkeypatch):
    """The sightings and arrivals that the commit names are those that the run reads; the log is derived once for all ranges."""
    staged = []
    monkeypatch.setattr(A, "stage", lambda df, name: staged.append(name) or stage(df, name))
    monkeypatch.setattr(daily, "stage", A.stage, raising=False)
    log, arrived, _ = layers
    store = MartStore(spark, folder)
    daily.run_day(store, "all", log, H.express_lines(H.label_arrivals(arrived, P), P), X.TIES, GAP_TIES, P)
    assert not {"sightings", "arrived", "histogram"} & set(staged)
    (run,) = daily.live_ranges(store)
    assert as_set(store.read(f"{daily.SIGHTINGS}/{run['name']}")) == as_set(A.sightings(log))


def test_daily_query_derives_the_log_once(spark, sf, monkeypatch):
    plans = []
    monkeypatch.setattr(registered.daily, "run_day", lambda store, name, log, *a: plans.append(log._jdf.queryExecution().optimizedPlan().toString()))
    registered._daily(spark, sf)
    assert len(plans) == 4 and not any("regexp_extract" in x for x in plans)


def test_last_sightings(spark):
    rows = [("a", "1", "s1", "2026-07-20 08:00:00", 1), ("a", "1", "s2", "2026-07-20 08:00:00", 2), ("a", "1", "s3", "2026-07-20 07:00:00", 3),
            (None, "1", "s4", "2026-07-20 06:00:00", None), (None, "1", "s5", "2026-07-20 06:00:00", 4), ("b", "2", "s6", "no time", 5), ("b", "", "s7", "2026-07-20 06:00:00", 6)]
    log = spark.createDataFrame(rows, "line string, train_no string, statn_id string, recptn_dt string, ingest_seq long")
    got = A.last_sightings(log, X.TIES)
    assert sorted(((r.line, r.statn_id) for r in got.collect()), key=str) == [("a", "s2"), (None, "s5")]
    later = log.where("statn_id = 's3'").withColumn("recptn_dt", F.lit("2026-07-20 09:00:00"))
    assert {r.statn_id for r in A.last_sightings(later, X.TIES, got).collect()} == {"s3", "s5"}


def test_crash_before_a_commit_and_stale_versions(spark, folder, layers):
    mart, store = layers[2], MartStore(spark, folder)
    store._commit, commit = (lambda *a: (_ for _ in ()).throw(OSError("lost"))), store._commit
    with pytest.raises(OSError):
        store.write("m", mart)
    store._commit = commit
    assert store.write("m", mart.limit(3)) == 1 and store.read("m").count() == 3
    store.write("m", mart.limit(2))
    with pytest.raises(StaleVersion):
        store.publish({"gold": "m"}, {"m": 1})
    store.publish({"gold": "m"}, {"m": 2})
    assert store.read("gold").count() == 2


def test_freshness_gaps(spark):
    rows = [("a", f"2026-07-20 08:{m:02d}:00", 1) for m in (0, 1, 2, 5, 36)] + [("b", "2026-07-20 08:00:00", 1)]
    fresh = spark.createDataFrame(rows, "line string, t string, records long").withColumn("minute_ts", F.to_timestamp("t"))
    (r,) = FR.gap_classes(fresh).collect()
    assert (r.line, r.window_boundaries, r.within_window_hiccups, r.max_hiccup_min) == ("a", 1, 1, 3.0)
    assert FR.hiccup_total(fresh).first()[0] == 1
    assert FR.hiccup_total(fresh.limit(0)).first()[0] == 0


def test_external_marts_follow_publications(spark, folder):
    store = MartStore(spark, f"{folder}/marts")
    store.write_all({"gold/a": spark.range(3).toDF("n"), "gold/b": spark.range(5).toDF("m")})
    other = spark.newSession()
    reader = ExternalMarts(other, store.root, f"ext_{abs(hash(folder))}")
    assert [reader.table(m).count() for m in ("gold/a", "gold/b")] == [3, 5]
    assert reader.refresh() == []
    store.write("gold/a", spark.range(4).withColumn("x", F.lit("y")))
    assert reader.refresh() == ["gold/a"]
    assert reader.table("gold/a").columns == ["id", "x"] and reader.table("gold/a").count() == 4
    assert other.sql(f"SELECT COUNT(*) FROM {reader.name('gold/b')}").first()[0] == 5
    # the files stay the store's own, whatever happens to the tables
    other.sql(f"DROP DATABASE `{reader.database}` CASCADE")
    assert store.read("gold/a").count() == 4 and store.read("gold/a", 1).count() == 3


def test_freshness_by_ranges_in_any_order(spark, sf, folder):
    log = X.position_log(spark, sf)
    parts = {str(k): log.where(F.pmod("ingest_seq", F.lit(3)) == k) for k in range(3)}
    ranges.add_range(spark, folder, "2", parts["2"].limit(50), P)  # broke off, and is run again below
    for name in ("1", "0", "2", "0"):
        ranges.add_range(spark, folder, name, parts[name], P)
    assert as_set(ranges.read_freshness(spark, folder)) == as_set(FR.freshness_mart(log, P))
    numbers = spark.read.parquet(f"{folder}/trains")
    assert numbers.count() == numbers.select("train").distinct().count() == numbers.select("train_no").distinct().count()
    empty = f"{folder}/none"
    ranges.add_range(spark, empty, "x", log.limit(0), P)
    assert ranges.read_freshness(spark, empty).count() == 0
