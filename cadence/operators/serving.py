"""Queries a dashboard asks of the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions import labels as L
from cadence.params import Params


def mart_filter(
    min_samples: int = 10,
    service: str | None = None,
    line: str | None = None,
    band: str | None = None,
    p: Params = Params(),
) -> Column:
    """Sample floor and service, and a line or band when one is chosen."""
    parts = [
        F.col("headway_samples") >= min_samples,
        F.col("svc_type") == (service or p.labels.svc_all),
    ]
    if line is not None:
        parts.append(F.col("line") == line)
    if band is not None:
        parts.append(F.col("time_band") == band)
    return reduce(lambda a, b: a & b, parts)


def group_count(mart: DataFrame, where: Column) -> DataFrame:
    return mart.where(where).agg(F.count(F.lit(1)).alias("n"))


def worst_line(mart: DataFrame, where: Column) -> DataFrame:
    return (
        mart.where(where)
        .groupBy("line")
        .agg(F.round(F.avg("cv"), 3).alias("c"))
        .orderBy(F.desc("c"), "line")
        .limit(1)
    )


def worst_station(mart: DataFrame, where: Column) -> DataFrame:
    return (
        mart.where(where)
        .orderBy(F.desc("cv"), "line", "statn_id", "direction", "svc_type", "time_band", "day_type")
        .limit(1)
        .select("statn_nm", "line", "direction", "cv")
    )


def line_band_summary(mart: DataFrame, where: Column | None = None) -> DataFrame:
    rows = mart if where is None else mart.where(where)
    return rows.groupBy("line", "time_band").agg(
        F.round(F.avg("cv"), 3).alias("avg_cv"),
        F.round(F.avg("p50_sec"), 0).alias("avg_headway_sec"),
        F.count(F.lit(1)).alias("n_groups"),
    )


def rush_topk(mart: DataFrame, p: Params = Params(), limit: int = 15) -> DataFrame:
    """Most irregular rush-hour groups of the mixed service."""
    return (
        mart.where(
            (F.col("svc_type") == p.labels.svc_all)
            & L.is_rush(p=p)
            & (F.col("headway_samples") >= p.min_samples)
        )
        .orderBy(F.desc("cv"), "line", "statn_id", "direction", "time_band", "day_type")
        .limit(limit)
        .select(
            "line", "statn_nm", "direction", "time_band",
            F.col("headway_samples").alias("n"),
            "p50_sec", "p90_sec", "cv", "over_1p5x_ratio",
        )
    )


def exploratory_topk(groups: DataFrame, p: Params = Params(), limit: int = 20) -> DataFrame:
    return (
        groups.where(L.is_rush(p=p))
        .orderBy(F.desc("cv"), "line", "statn_id", "statn_nm", "direction", "time_band")
        .limit(limit)
        .select("line", "statn_nm", "direction", "time_band", "n", "p50_sec", "p90_sec", "cv")
    )


def service_mix(mart: DataFrame, line: str | None, p: Params = Params(), limit: int = 15) -> DataFrame:
    """Is a station irregular in itself, or only because services mix?"""
    lab = p.labels
    rows = mart.where(L.is_rush(p=p) & (F.col("headway_samples") >= p.min_samples))
    if line is not None:
        rows = rows.where(F.col("line") == line)
    of = lambda svc: F.max(F.when(F.col("svc_type") == svc, F.col("cv")))
    return (
        rows.groupBy("line", "statn_nm", "direction", "time_band")
        .agg(
            of(lab.svc_all).alias("cv_all"),
            of(lab.svc_express).alias("cv_express"),
            of(lab.svc_local).alias("cv_local"),
        )
        .where(F.col("cv_express").isNotNull() | F.col("cv_local").isNotNull())
        .orderBy(F.desc("cv_all"), "line", "statn_nm", "direction", "time_band")
        .limit(limit)
    )
