"""Row rules, quarantine and the quality gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_THRESHOLD = 0.99


@dataclass(frozen=True)
class Rule:
    """A named SQL condition; a null outcome counts as a failure."""

    name: str
    condition: str

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def not_null(col: str) -> Rule:
    return Rule(f"{col}_not_null", f"`{col}` IS NOT NULL")


def non_negative(col: str) -> Rule:
    return Rule(f"{col}_non_negative", f"`{col}` >= 0")


def assert_non_negative(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """Offending rows; an empty result means the assertion holds."""
    return df.filter(F.col(col) < 0).select(*keys, col)


def with_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_failed``, the names of the rules a row breaks."""
    names = F.array(*[F.when(~rule.passes(), rule.name) for rule in rules])
    return df.withColumn("_failed", F.array_compact(names))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: no row is lost; bad rows carry the rules they broke."""
    passed = reduce(lambda a, b: a & b, [rule.passes() for rule in rules])
    return df.filter(passed), with_failures(df.filter(~passed), rules)


def quality_gate(
    df: DataFrame, rules: Sequence[Rule], threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """One row per rule, and one for all of them together, in one pass.

    Columns: rule, rows_checked, rows_passed, pass_ratio, gate_passed.  An
    empty table passes.
    """
    everything = reduce(lambda a, b: a & b, [rule.passes() for rule in rules])
    checks = [(rule.name, rule.passes()) for rule in rules] + [("all_rules", everything)]
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(ok).alias(f"passed_{i}") for i, (_, ok) in enumerate(checks)],
    )
    per_rule = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("rule"), F.col(f"passed_{i}").alias("rows_passed"))
                for i, (name, _) in enumerate(checks)
            ]
        )
    )
    ratio = F.when(F.col("rows_checked") == 0, 1.0).otherwise(
        F.try_divide("rows_passed", "rows_checked")
    )
    return (
        counted.select("rows_checked", per_rule.alias("r"))
        .select("r.rule", "rows_checked", "r.rows_passed")
        .withColumn("pass_ratio", ratio)
        .withColumn("gate_passed", F.col("pass_ratio") >= threshold)
    )
