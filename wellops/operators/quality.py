"""Data-quality rules with three actions.

``count`` keeps the row and counts the violation, ``drop`` removes the row, ``fail`` stops the run.
A rule that yields null is violated. ``fail`` is tested on every row, also on rows that a ``drop``
rule would remove. All rules of a dataset are evaluated in one pass over its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

COUNT, DROP, FAIL = "count", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = COUNT

    def __post_init__(self) -> None:
        if self.action not in (COUNT, DROP, FAIL):
            raise ValueError(f"unknown action {self.action!r} in rule {self.name!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expect(name: str, predicate: str) -> Rule:
    return Rule(name, predicate, COUNT)


def expect_or_drop(name: str, predicate: str) -> Rule:
    return Rule(name, predicate, DROP)


def expect_or_fail(name: str, predicate: str) -> Rule:
    return Rule(name, predicate, FAIL)


def _kept(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [r.holds() for r in rules if r.action == DROP], F.lit(True))


def _stop(rule: Rule) -> Column:
    """Error that ends the run.

    The partition number makes the test non-deterministic for the optimizer, so no later filter is
    moved below it. Without that, a join on the tested key would remove its nulls before the test.
    """
    message = F.concat(F.lit(f"data-quality rule {rule.name} failed: {rule.predicate} (partition "),
                       F.spark_partition_id().cast("string"), F.lit(")"))
    return F.raise_error(message).cast("boolean")


def metric_columns(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates for one pass: rows seen, rows kept and violations per rule."""
    return [F.count(F.lit(1)).alias("rows"), F.count_if(_kept(rules)).alias("kept"),
            *[F.count_if(~r.holds()).alias(r.name) for r in rules]]


def apply_rules(df: DataFrame, rules: Sequence[Rule], observe: Observation | str | None = None) -> DataFrame:
    """Drop and fail according to the rules.

    With ``observe`` the metrics are collected while the rows pass (an ``Observation`` in batch, a
    name on a stream, where they arrive in ``observedMetrics`` of each progress report).
    """
    if observe is not None:
        df = df.observe(observe, *metric_columns(rules))
    for rule in rules:
        if rule.action == FAIL:
            df = df.filter(F.when(rule.holds(), F.lit(True)).otherwise(_stop(rule)))
    return df.filter(_kept(rules))


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rule, action, violations, total."""
    totals = df.agg(*metric_columns(rules))
    rows = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                     F.col(r.name).alias("violations"), F.col("rows").alias("total")) for r in rules]
    return totals.select(F.inline(F.array(*rows)))
