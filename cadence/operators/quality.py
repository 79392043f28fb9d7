"""Data-quality suites in one scan.

A suite is a list of rules. All row rules of a suite become one aggregate over the
table, and key uniqueness rides on the same pass: rows are counted per key first
and the per-key results are added up. One job answers the whole suite, however
many rules it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.params import HEADWAY_KEYS, Params

ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"


@dataclass(frozen=True)
class Rule:
    """One expectation. NULL values pass every rule except ``not_null``."""

    name: str
    column: str | None
    low: float | None = None
    high: float | None = None
    allowed: tuple[str, ...] = ()

    def unexpected(self) -> Column:
        c = F.col(self.column)
        if self.name == NOT_NULL:
            return c.isNull()
        if self.name == IN_SET:
            return c.isNotNull() & ~c.isin(*self.allowed)
        if self.name == BETWEEN:
            bad = F.lit(False)
            if self.low is not None:
                bad |= c < self.low
            if self.high is not None:
                bad |= c > self.high
            return F.coalesce(bad, F.lit(False))
        raise ValueError(f"{self.name} is not a rule on rows")

    def count_ok(self, rows: Column) -> Column:
        return (rows >= (self.low or 0)) & (
            F.lit(True) if self.high is None else rows <= self.high
        )


def row_count(low: int = 1, high: int | None = None) -> Rule:
    return Rule(ROW_COUNT, None, low, high)


def not_null(column: str) -> Rule:
    return Rule(NOT_NULL, column)


def in_set(column: str, allowed: Sequence[str]) -> Rule:
    return Rule(IN_SET, column, allowed=tuple(allowed))


def between(column: str, low: float | None = None, high: float | None = None) -> Rule:
    return Rule(BETWEEN, column, low, high)


def headway_rules(p: Params = Params()) -> list[Rule]:
    lab = p.labels
    return [
        row_count(1),
        not_null("statn_id"),
        not_null("direction"),
        in_set("direction", lab.directions),
        in_set("time_band", lab.bands),
        not_null("svc_type"),
        in_set("svc_type", lab.services),
        between("cv", 0, 3),
        between("p50_sec", 1, p.max_headway_sec),
        between("headway_samples", 1),
        between("over_1p5x_ratio", 0, 1),
    ]


def freshness_rules() -> list[Rule]:
    return [row_count(1), between("records", 1), between("distinct_trains", 1)]


def rules_for(mart: str, p: Params = Params()) -> list[Rule]:
    return {"headway": headway_rules(p), "freshness": freshness_rules()}.get(mart, [])


def run_suite(table: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: ``expectation column success unexpected_count``."""
    rules = list(rules)
    on_rows = [(i, r) for i, r in enumerate(rules) if r.name != ROW_COUNT]
    totals = table.agg(
        F.count(F.lit(1)).alias("rows"), *(F.count_if(r.unexpected()).alias(f"u{i}") for i, r in on_rows)
    )
    lines = []
    for i, r in enumerate(rules):
        bad = F.lit(None).cast("bigint") if r.name == ROW_COUNT else F.col(f"u{i}")
        ok = r.count_ok(F.col("rows")) if r.name == ROW_COUNT else F.col(f"u{i}") == 0
        lines.append(
            F.struct(
                F.lit(i).alias("rule_no"),
                F.lit(r.name).alias("expectation"),
                F.lit(r.column).cast("string").alias("column"),
                ok.alias("success"),
                bad.alias("unexpected_count"),
            )
        )
    return totals.select(F.inline(F.array(*lines)))


def consistency_checks(mart: DataFrame, keys: Sequence[str] = HEADWAY_KEYS) -> DataFrame:
    """Row-consistency checks of the headway mart: ``check checked violations``.

    On an empty mart ``violations`` is NULL, which is not zero: the audit fails.
    """
    per_key = mart.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("c"),
        F.count_if(F.col("p90_sec") < F.col("p50_sec")).alias("v0"),
        F.count_if(F.col("mean_sec") <= 0).alias("v1"),
    )
    totals = per_key.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count(F.lit(1)).alias("groups"),
        F.sum("v0").alias("v0"),
        F.sum("v1").alias("v1"),
        F.sum(F.col("c") - 1).alias("v2"),
    )

    def line(text: str, n: str, v: str) -> Column:
        return F.struct(
            F.lit(text).alias("check"), F.col(n).alias("checked"), F.col(v).alias("violations")
        )

    # Names of the checks.
    return totals.select(
        F.inline(
            F.array(
                line("p90_sec >= p50_sec", "n", "v0"),
                line("mean_sec > 0", "n", "v1"),
                line("grain 유일성(중복 그룹 없음)", "groups", "v2"),
            )
        )
    )


def audit(headway: DataFrame, freshness: DataFrame, p: Params = Params()) -> DataFrame:
    """All rules and checks of both marts: ``source mart rule column ok unexpected``."""
    parts = []
    for name, table in (("headway", headway), ("freshness", freshness)):
        parts.append(
            run_suite(table, rules_for(name, p)).select(
                F.lit("suite").alias("source"),
                F.lit(name).alias("mart"),
                F.col("expectation").alias("rule"),
                "column",
                F.col("success").alias("ok"),
                F.col("unexpected_count").alias("unexpected"),
            )
        )
    parts.append(
        consistency_checks(headway).select(
            F.lit("check").alias("source"),
            F.lit("headway").alias("mart"),
            F.col("check").alias("rule"),
            F.lit(None).cast("string").alias("column"),
            F.coalesce(F.col("violations") == 0, F.lit(False)).alias("ok"),
            F.col("violations").alias("unexpected"),
        )
    )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def spoil(table: DataFrame, **values) -> DataFrame:
    """Overwrite columns with literals: a contaminated copy that must fail its suite."""
    return table.withColumns(
        {c: F.lit(v).cast(table.schema[c].dataType) for c, v in values.items()}
    )


def with_bad_row(table: DataFrame, **values) -> DataFrame:
    """The table plus one copy of a row with some columns overwritten."""
    return table.unionByName(spoil(table.limit(1), **values))


def mart_counts(**marts: DataFrame) -> DataFrame:
    """Rows per mart."""
    counts = [
        t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("mart"), "n_rows")
        for name, t in marts.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def reconcile(published: dict[str, DataFrame], staged: dict[str, DataFrame]) -> DataFrame:
    """Published against staged rows per mart; equal and above zero passes."""
    both = mart_counts(**published).withColumnRenamed("n_rows", "published_rows").join(
        mart_counts(**staged).withColumnRenamed("n_rows", "staged_rows"), "mart"
    )
    return both.withColumn(
        "ok", (F.col("published_rows") == F.col("staged_rows")) & (F.col("published_rows") > 0)
    )
