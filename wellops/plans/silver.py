"""Validated layer: typed and normalised columns, rules, one row per well code.

``raw`` may be a batch or a streaming DataFrame. ``observe`` collects the rule metrics in the same
pass. Processing time is stamped unless ``stamp=False``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wellops import schemas
from wellops.functions.columns import flag
from wellops.operators.dedup import one_per_key
from wellops.operators.quality import Rule, apply_rules
from wellops.plans.columns_of import typed
from wellops.plans.rules import MAX_BSW_PCT, OUTLIER_OIL_BBL, order_rules, production_rules, well_rules

WELL_VARIANTS = ("dedup", "plain", "expect_then_dedup")


def _stamped(df: DataFrame, stamp: bool) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp()) if stamp else df


def normalise_wells(raw: DataFrame) -> DataFrame:
    return typed(raw, schemas.WELLS)


def wells_before_rules(raw: DataFrame, variant: str = "dedup") -> DataFrame:
    """The rows the rules see: normalised, and for ``dedup`` already one per well code."""
    if variant not in WELL_VARIANTS:
        raise ValueError(f"unknown variant {variant!r}, expected one of {WELL_VARIANTS}")
    df = normalise_wells(raw)
    if variant == "plain":
        df = df.select(*schemas.WELL_COLUMNS)
    return one_per_key(df, "sap_code", ["well_id"]) if variant == "dedup" else df


def wells(raw: DataFrame, as_of: str | None = None, variant: str = "dedup",
          rules: Sequence[Rule] | None = None, observe: Observation | str | None = None,
          stamp: bool = True) -> DataFrame:
    """Validated wells.

    ``dedup``: one row per code before the rules, so a bad first copy can remove a good second one;
    all raw columns stay. ``plain``: no dedup, listed columns only. ``expect_then_dedup``: rules
    first, then one row per code. Batch keeps the lowest ``well_id``, a stream the first arrival.
    """
    rules = well_rules(as_of) if rules is None else rules
    checked = apply_rules(wells_before_rules(raw, variant), rules, observe)
    if variant == "expect_then_dedup":
        checked = one_per_key(checked, "sap_code", ["well_id"])
    return _stamped(checked, stamp)


def production_before_rules(raw: DataFrame, variant: str = "all", gather_years: bool = False) -> DataFrame:
    """``all`` keeps every raw column, ``plain`` only the listed ones.

    Typed values come first and the columns derived from them second, so that each cast is written once. Rows are
    gathered by year in between, so that no other derived column is shuffled.
    """
    readings = typed(raw, schemas.PRODUCTION)
    if variant == "plain":
        readings = readings.select(*schemas.PRODUCTION_COLUMNS)
    derived = {
        "is_outlier": flag(F.col("oil_bbl") > OUTLIER_OIL_BBL),
        "is_high_bsw": flag(F.col("bsw_pct") > MAX_BSW_PCT),
        "year": F.year("prod_date"),
        "month": F.month("prod_date"),
        "day": F.dayofmonth("prod_date"),
    }
    if not gather_years:
        return readings.withColumns(derived)
    order = readings.withColumns(derived).columns
    gathered = readings.withColumn("year", derived.pop("year")).hint("rebalance", "year")
    return gathered.withColumns(derived).select(*order)


def production(raw: DataFrame, as_of: str | None = None, variant: str = "all",
               rules: Sequence[Rule] | None = None, observe: Observation | str | None = None,
               stamp: bool = True, gather_years: bool = False) -> DataFrame:
    """Validated readings with calendar columns and outlier flags.

    ``gather_years`` (batch) brings the rows of a year together for a write by year; a large year
    takes many tasks. It comes before the rules, so that metrics are observed in the stage that
    writes, where a repeated task counts once.
    """
    rules = production_rules(as_of) if rules is None else rules
    df = production_before_rules(raw, variant, gather_years)
    return _stamped(apply_rules(df, rules, observe), stamp)


def orders_before_rules(raw: DataFrame, variant: str = "all") -> DataFrame:
    rows = typed(raw, schemas.ORDERS)
    return rows.select(*schemas.ORDER_COLUMNS) if variant == "plain" else rows


def orders(raw: DataFrame, variant: str = "all", rules: Sequence[Rule] | None = None,
           observe: Observation | str | None = None, stamp: bool = True) -> DataFrame:
    """Validated work orders. Completion before opening and unknown wells are not ruled out here."""
    rules = order_rules() if rules is None else rules
    return _stamped(apply_rules(orders_before_rules(raw, variant), rules, observe), stamp)
