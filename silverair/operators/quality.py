"""Quality rules, their gate, and run counters taken while a table is written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named count of violations; the rule passes when it is zero."""

    name: str
    broken: Column | None = None
    unique: tuple[str, ...] = ()

    @property
    def violations(self) -> Column | None:
        return None if self.broken is None else F.count_if(self.broken)


def not_null(column: str) -> Rule:
    return Rule(f"not_null({column})", F.col(column).isNull())


def in_range(column: str, low: Any, high: Any) -> Rule:
    return Rule(f"in_range({column})", ~F.col(column).between(low, high))


def accepted(column: str, values: Sequence[Any]) -> Rule:
    return Rule(f"accepted({column})", ~F.col(column).isin(*values))


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the row-local rules that a row breaks; unknown is not broken."""
    names = [F.when(r.broken, F.lit(r.name)) for r in rules if r.broken is not None]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def unique(*columns: str) -> Rule:
    return Rule(f"unique({','.join(columns)})", unique=columns)


class QualityError(RuntimeError):
    """A gated check failed."""


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: ``rule, observed, passed``.

    The number of columns is always checked, as in ``ColumnCount > 0``. All
    row-local rules share one aggregate; a uniqueness rule counts its keys with
    a partial aggregate and then sums what exceeds one row per key.
    """
    local = [r for r in rules if r.violations is not None]
    width = F.struct(
        F.lit("column_count").alias("rule"),
        F.lit(len(df.columns)).cast("bigint").alias("observed"),
        F.lit(len(df.columns) > 0).alias("passed"),
    )
    entries = [width]
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[r.violations.alias(f"__{i}") for i, r in enumerate(local)]
    )
    for i, rule in enumerate(local):
        observed = F.col(f"__{i}").cast("bigint")
        entries.append(
            F.struct(F.lit(rule.name).alias("rule"), observed.alias("observed"), (observed == 0).alias("passed"))
        )
    reports = [counted.select(F.inline(F.array(*entries)))]
    for rule in rules:
        if rule.unique:
            repeats = (
                df.groupBy(*rule.unique)
                .agg(F.count(F.lit(1)).alias("__n"))
                .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("observed"))
            )
            reports.append(
                repeats.select(F.lit(rule.name).alias("rule"), "observed", (F.col("observed") == 0).alias("passed"))
            )
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame) -> None:
    """Raise if a rule of a report failed; the report has one row per rule."""
    failed = [f"{r.rule}: {r.observed}" for r in report.filter(~F.col("passed")).collect()]
    if failed:
        raise QualityError("; ".join(failed))


def source_counts(df: DataFrame, source: str = "sys_source_from") -> DataFrame:
    """Rows per source and in total: ``(source, is_total, rows)`` from one pass."""
    return (
        df.rollup(source)
        .agg(F.grouping(source).cast("boolean").alias("is_total"), F.count(F.lit(1)).alias("rows"))
        .select(source, "is_total", "rows")
    )


def run_counters(status: str = "status") -> list[Column]:
    """Counters of a landing run: processed, succeeded and failed units of work."""
    return [
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col(status) == "success").alias("succeeded"),
        F.count_if(F.col(status) == "error").alias("failed"),
    ]


def observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach counters that are filled by the action that writes ``df``."""
    observation = Observation(name)
    return df.observe(observation, *metrics), observation


def run_log(df: DataFrame, metrics: Sequence[Column]) -> DataFrame:
    """Counters of a finished table as one row."""
    return df.agg(*metrics)

