"""Quantiles of values without a small domain, from sketches that add up.

A KLL sketch of a few kilobytes stands for any number of values. Sketches are built per part of the data (a date, a range), kept, and merged for
whatever groups are asked for, so neither values nor exact histograms travel. With ``k`` of 400, the value given for a quantile
has a rank within ``RANK_ERROR`` of the one asked for. Headways, whole seconds up to a cut-off, stay with exact histograms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 400
RANK_ERROR = 0.02


def sketches(rows: DataFrame, keys: Sequence[str | Column], value: str) -> DataFrame:
    """``keys sketch``; NULL values count for nothing."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), K).alias("sketch"))


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups, or of the same groups over more parts."""
    return parts.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", K).alias("sketch"))


def quantiles(sketch: DataFrame, shares: Sequence[float]) -> DataFrame:
    """One row per group and share: ``n share value``."""
    keys = [c for c in sketch.columns if c != "sketch"]
    wanted = F.array(*(F.lit(float(s)) for s in shares))
    values = F.kll_sketch_get_quantile_double("sketch", wanted)
    each = F.arrays_zip(wanted.alias("share"), values.alias("value"))
    rows = sketch.select(*keys, F.kll_sketch_get_n_double("sketch").alias("n"), F.inline(each))
    return rows.toDF(*keys, "n", "share", "value")
