"""The sliced LAG equals the plain LAG, whatever the skew."""

import random

import pytest
from conftest import as_set
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadence.operators import arrivals as A
from cadence.operators import headway as H
from cadence.operators.ordered import _SLICE, _hot_keys, _sliced, with_previous
from cadence.workload import fixture as X
from cadence.workload.registered import GAP_TIES

P = X.PARAMS


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, one is NULL, and time is bunched."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else rnd.choice(["a", "b", None, "c"])
        t = rnd.choice([rnd.randrange(50), rnd.randrange(100_000)])
        rows.append((key, rnd.choice("xy"), t, i))
    df = spark.createDataFrame(rows, "k string, svc string, t long, seq long")
    return df.withColumn("ts", F.timestamp_seconds("t")).cache()


@pytest.mark.parametrize("limit", [10, 100, 700])
def test_sliced_equals_plain(skewed, limit):
    p = P.but(hot_key_rows=limit)
    assert _hot_keys(skewed, ["k"], p) is not None
    got = with_previous(
        skewed, ["k"], ["ts", "seq"], ["seq", "t"], views={"prev": (), "same": ("svc",)}, p=p
    ).select("seq", F.col("prev.seq").alias("a"), F.col("same.t").alias("b"))
    w, v = Window.partitionBy("k").orderBy("ts", "seq"), Window.partitionBy("k", "svc").orderBy("ts", "seq")
    want = skewed.select("seq", F.lag("seq").over(w).alias("a"), F.lag("t").over(v).alias("b"))
    assert as_set(got) == as_set(want)


def test_hot_keys_too_many_to_broadcast(skewed):
    p = P.but(hot_key_rows=20, broadcast_rows=2)
    assert _hot_keys(skewed, ["k"], p).count() > 2
    got = with_previous(skewed, ["k"], ["ts", "seq"], ["seq"], p=p)
    w = Window.partitionBy("k").orderBy("ts", "seq")
    want = skewed.select("seq", F.lag("seq").over(w).alias("a"))
    assert as_set(got.select("seq", F.col("prev.seq").alias("a"))) == as_set(want)


@pytest.mark.parametrize("shape", ["burst", "outlier", "second"])
def test_slices_follow_the_rows(spark, shape):
    """No slice holds twice the limit, however the rows lie in time."""
    at = {"burst": F.floor(F.col("id") / 100), "outlier": F.when(F.col("id") == 0, -31_536_000).otherwise(F.floor(F.col("id") / 100)), "second": F.lit(5)}[shape]
    df = spark.range(20_000).select(F.lit("k").alias("k"), F.timestamp_seconds(at).alias("ts"), F.col("id").alias("seq"))
    p = P.but(hot_key_rows=1000)
    sliced = _sliced(df, 20_000, ["k"], ["ts", "seq"], p)
    sizes = sliced.groupBy(_SLICE).count().agg(F.sum("count"), F.max("count"), F.count("*")).first()
    assert sizes[0] == 20_000 and sizes[1] <= 2 * p.hot_key_rows and sizes[2] >= 10
    got = with_previous(df, ["k"], ["ts", "seq"], ["seq"], p=p)
    assert got.where("prev.seq is distinct from nullif(seq - 1, -1)").isEmpty()


def test_one_task_cuts_many_slices(spark):
    """A small limit gives many slices, not as many tasks and files."""
    df = spark.range(20_000).select(F.lit("k").alias("k"), F.timestamp_seconds(F.floor(F.col("id") / 7)).alias("ts"), F.col("id").alias("seq"))
    p = P.but(hot_key_rows=10)
    sliced = _sliced(df, 20_000, ["k"], ["ts", "seq"], p)
    assert len(sliced.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = sliced.groupBy(_SLICE).agg(F.count("*").alias("n"), F.min("seq").alias("a"), F.max("seq").alias("b"))
    assert spans.agg(F.sum("n"), F.max("n")).first() == (20_000, 10)
    assert spans.where("b - a + 1 <> n").isEmpty()
    got = with_previous(df, ["k"], ["ts", "seq"], ["seq"], p=p)
    assert got.where("prev.seq is distinct from nullif(seq - 1, -1)").isEmpty()


def test_no_hot_key_keeps_one_shuffle(skewed):
    plan = with_previous(skewed, ["k"], ["ts", "seq"], ["seq"], views={"a": (), "b": ("svc",)}, p=P)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" not in text


def test_marts_do_not_depend_on_slicing(spark, sf):
    log = X.position_log(spark, sf)
    cut = P.but(hot_key_rows=20, max_headway_sec=86_400)
    plain = P.but(max_headway_sec=86_400)
    a, b = A.arrivals(log, X.TIES, plain), A.arrivals(log, X.TIES, cut)
    assert as_set(a) == as_set(b)
    assert as_set(A.arrival_runs(log, X.TIES, plain)) == as_set(A.arrival_runs(log, X.TIES, cut))
    assert as_set(H.headway_mart(a, GAP_TIES, plain)) == as_set(H.headway_mart(b, GAP_TIES, cut))
