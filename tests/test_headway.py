from conftest import as_set
from pyspark.sql import functions as F

from cadence import Labels, LineRules, Params
from cadence.functions import labels as L
from cadence.operators import headway as H
from cadence.operators import serving as S

P = Params()
LAB = Labels()


def arrivals(spark, rows):
    """Rows of ``(line, station, updn, express, time)``."""
    full = [(l, f"T{i}", s, f"{s}-nm", u, e, t) for i, (l, s, u, e, t) in enumerate(rows)]
    return spark.createDataFrame(
        full, "line string, train_no string, statn_id string, statn_nm string, updn_line string, direct_at string, t string"
    ).select("*", F.to_timestamp("t").alias("arrival_ts")).drop("t")


def test_status_chain(spark):
    rows = spark.createDataFrame(
        [
            (None, "1호선", "구로"), (0, "1호선", "구로"), (900, "1호선", "구로"),
            (901, "1호선", "구로"), (901, "1호선", "종각"), (901, "2호선", "구로"),
        ],
        "g long, line string, statn_nm string",
    )
    got = [r[0] for r in rows.select(L.headway_status(F.col("g"), P)).collect()]
    assert got == ["first", "nonpos", "valid", "normal_term", "gap_missing", "gap_missing"]


def test_bands_and_day_types(spark):
    rows = spark.createDataFrame(
        [("2026-07-17 05:00:00",), ("2026-07-18 07:30:00",), ("2026-07-19 16:59:59",),
         ("2026-07-20 19:59:59",), ("2026-07-20 20:00:00",), ("2026-07-21 04:59:59",)],
        "t string",
    ).select(F.to_timestamp("t").alias("ts"))
    got = [(r[0], r[1]) for r in rows.select(L.time_band("ts", P), L.day_type("ts", P)).collect()]
    assert got == [
        ("새벽", "휴일"), ("출근", "토요일"), ("점심", "휴일"),
        ("퇴근", "평일"), ("밤", "평일"), ("밤", "평일"),
    ]


def test_duplicate_second_is_an_anomaly_and_band_is_the_later_arrivals(spark):
    a = arrivals(spark, [
        ("9호선", "s", "0", "0", "2026-07-20 06:58:00"),
        ("9호선", "s", "0", "0", "2026-07-20 07:01:00"),
        ("9호선", "s", "0", "0", "2026-07-20 07:01:00"),
        ("9호선", "s", "0", "0", "2026-07-20 07:05:00"),
    ])
    (row,) = H.headway_mart(a, p=P).collect()
    assert (row.time_band, row.headway_samples, row.n_anomaly, row.n_missing) == ("출근", 2, 1, 0)
    assert (row.p50_sec, row.p90_sec, row.mean_sec, row.is_rush) == (180, 240, 210.0, True)
    assert (row.std_sec, row.cv, row.over_1p5x_ratio) == (42.4, 0.202, 0.0)


def test_single_sample_has_no_spread_and_groups_without_valid_rows_vanish(spark):
    a = arrivals(spark, [
        ("2호선", "s", "0", "0", "2026-07-20 08:00:00"),
        ("2호선", "s", "0", "0", "2026-07-20 08:05:00"),
        ("2호선", "t", "0", "0", "2026-07-20 08:00:00"),
        ("2호선", "t", "0", "0", "2026-07-20 09:00:00"),
        ("2호선", "s", "2", "0", "2026-07-20 08:00:00"),
    ])
    (row,) = H.headway_mart(a, p=P).collect()
    assert (row.statn_id, row.std_sec, row.cv, row.p50_sec) == ("s", None, None, 300)
    excluded = {r.statn_id: r.n_missing for r in H.exclusion_counts(H.headways(a, p=P)).collect()}
    assert excluded == {"s": 0, "t": 1}


def test_services_are_split_on_express_lines_only(spark):
    a = arrivals(spark, [
        ("9호선", "s", "0", "1", "2026-07-20 08:00:00"),
        ("9호선", "s", "0", "0", "2026-07-20 08:02:00"),
        ("9호선", "s", "0", "1", "2026-07-20 08:06:00"),
        ("2호선", "s", "0", "0", "2026-07-20 08:00:00"),
        ("2호선", "s", "0", "0", "2026-07-20 08:04:00"),
    ])
    got = {(r.line, r.svc_type): r.p50_sec for r in H.headway_mart(a, p=P).collect()}
    assert got == {("9호선", "전체"): 120, ("9호선", "급행"): 360, ("2호선", "전체"): 240}
    same = H.headways(a, p=P, express=spark.createDataFrame([("9호선",)], "line string"))
    assert as_set(same) == as_set(H.headways(a, p=P))


def test_rows_without_a_line_never_reach_the_mart(spark):
    a = arrivals(spark, [
        (None, "s", "0", "0", "2026-07-20 08:00:00"), (None, "s", "0", "0", "2026-07-20 08:04:00"),
    ])
    assert H.headway_mart(a, p=P).count() == 0
    assert H.exploratory_mart(a, 1, p=P).count() == 1


def test_percentiles_match_sparks_own(spark):
    rows = spark.range(5000).select(
        F.lit("l").alias("line"), F.lit("valid").alias("status"),
        (1 + F.pmod(F.xxhash64("id"), F.lit(900))).alias("headway_sec"), (F.col("id") % 7).alias("g"),
    )
    hist = H.headway_histogram(rows, ("line", "g"), ())
    got = H.histogram_stats(hist, ("line", "g"), (), P).select("g", "p50_sec", "p90_sec", "std_sec", "mean_sec")
    want = rows.groupBy("g").agg(
        F.percentile_approx("headway_sec", 0.5).alias("p50_sec"),
        F.percentile_approx("headway_sec", 0.9).alias("p90_sec"),
        F.round(F.stddev_samp("headway_sec"), 1).alias("std_sec"),
        F.round(F.avg("headway_sec"), 0).alias("mean_sec"),
    )
    assert as_set(got) == as_set(want)


def test_branch_label():
    p = Params(rules=LineRules(branch_line="b", branch_stations=("x",)))
    assert p.rules.branch_line == "b" and Params().rules.branch_line == "2호선"


def test_filter_builder(spark):
    mart = spark.createDataFrame(
        [(12, LAB.svc_all, "a", LAB.morning), (12, LAB.svc_all, "b", LAB.night), (3, LAB.svc_all, "a", LAB.morning)],
        "headway_samples long, svc_type string, line string, time_band string",
    )
    count = lambda **k: S.group_count(mart, S.mart_filter(**k)).first()[0]
    assert count() == 2
    assert count(line="a") == 1
    assert count(min_samples=3, line="a", band=LAB.morning) == 2
    assert count(service=LAB.svc_express) == 0
