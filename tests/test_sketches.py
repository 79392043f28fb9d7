"""Merged sketches against exact ranks."""

import random

from pyspark.sql import functions as F

from cadence.operators import sketches as K


def test_merged_quantiles_lie_within_the_rank_error(spark):
    r = random.Random(5)
    rows = [(g, k % 17, r.lognormvariate(0, 3) if g == "wide" else float(r.randint(0, 3))) for g in ("wide", "ties") for k in range(30_000)]
    rows += [("one", 0, 7.5), ("none", 0, None)]
    df = spark.createDataFrame(rows, "g string, day int, v double").repartition(6)
    parts = K.sketches(df, ["g", "day"], "v")
    shares = (0.0, 0.01, 0.5, 0.9, 0.99, 1.0)
    got = K.quantiles(K.merged(parts, ["g"]), shares).collect()
    values = {g: sorted(v for h, _, v in rows if h == g and v is not None) for g in ("wide", "ties", "one")}
    assert {x.g for x in got} == set(values) and len(got) == len(values) * len(shares)
    for x in got:
        v = values[x.g]
        assert x.n == len(v)
        below, upto = sum(y < x.value for y in v) / len(v), sum(y <= x.value for y in v) / len(v)
        assert below <= x.share + K.RANK_ERROR and upto >= x.share - K.RANK_ERROR


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert K.quantiles(K.merged(K.sketches(empty, ["g"], "v"), ["g"]), (0.5,)).count() == 0
    assert K.sketches(empty.withColumn("v", F.lit(None).cast("double")), ["g"], "v").count() == 0
