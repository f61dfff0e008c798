"""Operational queries: dashboard tiles and the usual questions, with optional filters.

The period filter applies to the reading and opening dates and reaches the scan; field and well
type restrict the wells. Questions that ask for a ranking break ties by the key, so results are
reproducible.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellops.operators.rollup import mean, partials_per_well, total
from wellops.plans import gold


@dataclass(frozen=True)
class Filters:
    """Dashboard filters; ``None`` means no restriction. The period includes both ends."""

    field: str | None = None
    well_type: str | None = None
    first_day: str | None = None
    last_day: str | None = None

    def wells(self, wells: DataFrame) -> DataFrame:
        if self.field is not None:
            wells = wells.filter(F.col("field") == self.field)
        if self.well_type is not None:
            wells = wells.filter(F.col("well_type") == self.well_type)
        return wells

    def period(self, df: DataFrame, column: str) -> DataFrame:
        by_year = column == "prod_date" and "year" in df.columns  # readings are stored by year
        for day, within in ((self.first_day, Column.__ge__), (self.last_day, Column.__le__)):
            if day is not None:
                df = df.filter(within(F.col(column), F.lit(day).cast("date")))
                if by_year:
                    df = df.filter(within(F.col("year"), F.lit(int(day[:4]))))
        return df

    def of_wells(self, df: DataFrame, wells: DataFrame) -> DataFrame:
        """Rows of the selected wells, best summed per well before; without a well filter nothing is joined."""
        if self.field is None and self.well_type is None:
            return df
        return df.join(self.wells(wells).select("well_id"), "well_id", "left_semi")


NO_FILTERS = Filters()


def _kpi(df: DataFrame, name: str, value) -> DataFrame:
    return df.agg(value.cast("double").alias("value")).select(F.lit(name).alias("kpi"), "value")


def kpi_cards(production: DataFrame, wells: DataFrame, orders: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """Four figures, one row each: producing wells, total oil, mean BSW, open orders."""
    readings = (partials_per_well(filters.period(production, "prod_date"), ["well_id"], "reading_id",
                                  ["oil_bbl", "bsw_pct"]))
    readings = filters.of_wells(readings, wells).agg(total("oil_bbl").alias("total_oil_bbl"),
                                                     mean("bsw_pct").alias("mean_bsw_pct"))
    open_orders = partials_per_well(filters.period(orders, "opened_on").filter(F.col("status") == "Aberta"),
                                    ["well_id"], "order_id", [])
    open_orders = filters.of_wells(open_orders, wells)
    parts = [
        _kpi(filters.wells(wells).filter(F.col("status") == "Produzindo"), "producing_wells", F.count("well_id")),
        readings.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kpi"), F.col(k).alias("value"))
                                           for k in ("total_oil_bbl", "mean_bsw_pct")]))),
        _kpi(open_orders, "open_orders", F.coalesce(F.sum("n_rows"), F.lit(0))),
    ]
    return reduce(DataFrame.unionByName, parts)


def production_by_field(production: DataFrame, wells: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """Bars: volume per field, largest first."""
    per_well = gold.readings_per_well(filters.period(production, "prod_date"), ("oil_bbl",))
    return (per_well.join(filters.wells(wells).select("well_id", "field"), "well_id")
            .groupBy("field").agg(total("oil_bbl").alias("total_oil_bbl"))
            .orderBy(F.desc("total_oil_bbl"), "field"))


def monthly_evolution(production: DataFrame, wells: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """Line: volume per month."""
    per_well = partials_per_well(filters.period(production, "prod_date"), ["well_id", "year", "month"],
                                 "reading_id", ["oil_bbl"]) \
        if filters.field or filters.well_type else \
        partials_per_well(filters.period(production, "prod_date"), ["year", "month"], "reading_id", ["oil_bbl"])
    return (filters.of_wells(per_well, wells).groupBy("year", "month")
            .agg(total("oil_bbl").alias("total_oil_bbl")).orderBy("year", "month"))


def _cost_per(by: list[str], orders: DataFrame, wells: DataFrame, filters: Filters) -> DataFrame:
    """Estimated cost per group; with a filter on wells, summed per well before the wells are joined."""
    keys = by if filters.field is None and filters.well_type is None else [*by, "well_id"]
    sums = partials_per_well(filters.period(orders, "opened_on"), keys, "order_id", ["est_cost"])
    return filters.of_wells(sums, wells).groupBy(*by).agg(total("est_cost").alias("total_est_cost"))


def cost_by_equipment(orders: DataFrame, wells: DataFrame, k: int = 5, filters: Filters = NO_FILTERS) -> DataFrame:
    """The ``k`` equipment types with the largest estimated cost."""
    return (_cost_per(["equipment"], orders, wells, filters)
            .orderBy(F.desc("total_est_cost"), "equipment").limit(k))


def well_health(production: DataFrame, wells: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """Scatter: mean BSW against volume, one point per well."""
    per_well = gold.readings_per_well(filters.period(production, "prod_date"), ("oil_bbl", "bsw_pct"))
    return (per_well.join(filters.wells(wells).select("well_id", "well_name", "field", "well_type"), "well_id")
            .select("well_id", "well_name", "field", "well_type",
                    F.round(F.try_divide("sum_bsw_pct", "n_bsw_pct"), 2).alias("mean_bsw_pct"),
                    F.round("sum_oil_bbl", 2).alias("total_oil_bbl")))


def top_field(production: DataFrame, wells: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """The field with the highest production."""
    return production_by_field(production, wells, filters).limit(1)


def field_maintenance_spend(orders: DataFrame, wells: DataFrame, field: str,
                            filters: Filters = NO_FILTERS) -> DataFrame:
    """Orders, estimated and actual spend of one field."""
    per_well = partials_per_well(filters.period(orders, "opened_on"), ["well_id"], "order_id",
                                 ["est_cost", "actual_cost"])
    chosen = filters.wells(wells).filter(F.col("field") == field).select("well_id", "field")
    return (per_well.join(chosen, "well_id").groupBy("field")
            .agg(F.sum("n_rows").alias("orders"), total("est_cost").alias("total_est_cost"),
                 total("actual_cost").alias("total_actual_cost")))


def high_bsw_wells(production: DataFrame, wells: DataFrame, threshold: float = 80.0,
                   filters: Filters = NO_FILTERS) -> DataFrame:
    """Wells whose mean BSW lies above the threshold, the usual sign of the end of extraction."""
    per_well = gold.readings_per_well(filters.period(production, "prod_date"), ("bsw_pct",))
    high = per_well.filter(F.col("sum_bsw_pct") > threshold * F.col("n_bsw_pct"))
    return (high.join(filters.wells(wells).select("well_id", "well_name", "field"), "well_id")
            .select("well_id", "well_name", "field",
                    F.round(F.try_divide("sum_bsw_pct", "n_bsw_pct"), 2).alias("mean_bsw_pct")))


def producing_by_basin(wells: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """Number of producing wells per basin."""
    return (filters.wells(wells).filter(F.col("status") == "Produzindo")
            .groupBy("basin").agg(F.count("well_id").alias("producing_wells")))


def costliest_maint_type(orders: DataFrame, wells: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """The maintenance type with the largest estimated cost."""
    return (_cost_per(["maint_type"], orders, wells, filters)
            .orderBy(F.desc("total_est_cost"), "maint_type").limit(1))


def top_costs(orders: DataFrame, wells: DataFrame, k: int = 5, filters: Filters = NO_FILTERS) -> DataFrame:
    """The ``k`` single orders with the largest estimated cost."""
    chosen = filters.of_wells(filters.period(orders, "opened_on"), wells)
    return (chosen.select("order_id", "well_id", "maint_type", "equipment", "est_cost")
            .orderBy(F.desc("est_cost"), "order_id").limit(k))
