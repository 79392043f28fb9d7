import random

from pyspark.sql import functions as F

from cadence import LineRules, Params
from cadence.operators import punctuality as P

BASE = Params(rules=LineRules(plan_line="9호선"))


def test_nearest_plan_equals_brute_force(spark):
    rnd = random.Random(3)
    plan = [(s, str(i), w, t) for s in ("A", "B") for i in (1, 2) for w in ("1", "2", "3")
            for t in sorted(rnd.sample(range(18_000, 88_000), 9))]
    plan += [("C", "1", "1", 40_000)]
    tt = spark.createDataFrame(plan, "station_nm string, inout_tag string, week_tag string, arrive_sec long")
    rows = []
    for i in range(400):
        day = rnd.choice(["2026-07-20", "2026-07-18", "2026-07-19", "2026-07-17"])
        s = rnd.randrange(86_400)
        rows.append(("9호선", f"T{i}", "x", rnd.choice("ABCD"), rnd.choice("01"), "0", day, s))
    # exact ties between two planned times
    a, b = sorted(t for s, i, w, t in plan if (s, i, w) == ("A", "1", "1"))[:2]
    if (a + b) % 2 == 0:
        rows.append(("9호선", "tie", "x", "A", "0", "0", "2026-07-20", (a + b) // 2))
    df = spark.createDataFrame(
        rows, "line string, train_no string, statn_id string, statn_nm string, updn_line string, direct_at string, day string, s long"
    )
    df = df.withColumn("arrival_ts", F.timestamp_seconds(F.unix_timestamp(F.to_timestamp("day")) + F.col("s")))
    got = {r.train_no: (r.planned_sec, r.delay_sec) for r in P.nearest_plan_delay(df.drop("day", "s"), tt, BASE).collect()}
    tag = {"2026-07-20": "1", "2026-07-18": "2", "2026-07-19": "3", "2026-07-17": "3"}
    want = {}
    eve = {"2026-07-20": "3", "2026-07-18": "3", "2026-07-19": "2", "2026-07-17": "1"}  # the day before each
    for _, train, _, st, updn, _, day, s in rows:
        kind, s = (eve[day], s + 86_400) if s < 10_800 else (tag[day], s)
        times = [t for n, i, w, t in plan if (n, i, w) == (st, "1" if updn == "0" else "2", kind)]
        if times:
            best = min(times, key=lambda t: (abs(s - t), t))
            want[train] = (best, s - best)
    assert got == want


def test_after_midnight_belongs_to_the_day_before(spark):
    tt = spark.createDataFrame([("A", "1", "1", 24 * 3600 + 600), ("A", "1", "1", 5 * 3600)], "station_nm string, inout_tag string, week_tag string, arrive_sec long")
    row = spark.createDataFrame([("9호선", "T", "x", "A", "0", "0", "2026-07-21 00:11:00")], "line string, train_no string, statn_id string, statn_nm string, updn_line string, direct_at string, t string")
    (r,) = P.nearest_plan_delay(row.withColumn("arrival_ts", F.to_timestamp("t")).drop("t"), tt, BASE).collect()
    assert (r.planned_sec, r.delay_sec) == (87_000, 60)


def test_zero_plan_falls_to_the_worst_class(spark):
    mart = spark.createDataFrame(
        [("9호선", "A", "상행", "전체", "출근", "평일", 9, v, 0.1) for v in (276, 360, 361)]
        + [("9호선", "Z", "상행", "전체", "출근", "평일", 9, 100, 0.1), ("2호선", "A", "상행", "전체", "출근", "평일", 9, 100, 0.1),
           ("9호선", "A", "상행", "전체", "출근", "휴일", 9, 100, 0.1)],
        "line string, statn_nm string, direction string, svc_type string, time_band string, day_type string, "
        "headway_samples long, p50_sec long, cv double",
    )
    plan = spark.createDataFrame(
        [("A", "상행", "출근", "전체", 240.0, 5), ("Z", "상행", "출근", "전체", 0.0, 5)],
        "statn_nm string, direction string, time_band string, svc_type string, plan_p50_sec double, plan_n int",
    )
    got = sorted((r.statn_nm, r.obs_p50_sec, r.vs_plan_ratio, r.excess_sec, r.punctuality) for r in P.punctuality(mart, plan, BASE).collect())
    assert got == [
        ("A", 276, 1.15, 36.0, "정시"), ("A", 360, 1.5, 120.0, "지연경향"),
        ("A", 361, 1.5, 121.0, "큰지연"), ("Z", 100, None, 100.0, "큰지연"),
    ]
    top = P.worst_to_plan(P.punctuality(mart, plan, BASE), BASE).collect()
    assert top[-1].statn_nm == "Z" and len(top) == 4


def test_planned_headways(spark):
    tt = spark.createDataFrame(
        [("A", "1", "1", t, e) for t, e in ((25_200, "G"), (25_500, "D"), (25_800, "G"), (25_800, "D"), (36_000, "G"))]
        + [("A", "1", "2", 25_200, "G")],
        "station_nm string, inout_tag string, week_tag string, arrive_sec long, express_yn string",
    )
    got = {(r.time_band, r.svc_type): (r.plan_p50_sec, r.plan_n) for r in P.planned_headways(tt, BASE).collect()}
    assert got == {
        ("출근", "전체"): (300.0, 2), ("점심", "전체"): (10_200.0, 1),
        ("출근", "완행"): (600.0, 1), ("점심", "완행"): (10_200.0, 1), ("출근", "급행"): (300.0, 1),
    }
