"""Weekly forecast features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellops.functions.columns import calendar_year
from wellops.operators.rollup import mean, partials_per_well, total
from wellops.operators.windows import lag_and_mean

FEATURE_COLUMNS = ["week", "mean_bsw_pct", "mean_wellhead_psi", "mean_temp_c", "mean_hours_on", "active_wells",
                   "prev_week_oil_bbl", "mean4_oil_bbl"]
TARGET = "weekly_oil_bbl"


def weekly_production(production: DataFrame, wells: DataFrame, iso_year: bool = False,
                      sort: bool = False) -> DataFrame:
    """Volumes, mean conditions and active wells by field, year and ISO week.

    By default the year is the calendar year, so the last days of December may fall in week 1 of
    the year that ends; ``iso_year=True`` uses the year of the week instead.
    """
    result = weekly_of_located(in_fields(weekly_per_well(production, iso_year), wells), one_row_a_well=True)
    return result.orderBy("field", "year", "week") if sort else result


def weekly_per_well(production: DataFrame, iso_year: bool = False) -> DataFrame:
    """Readings summed by well and week."""
    dated = production.select(
        "well_id", "reading_id", "oil_bbl", "bsw_pct", "wellhead_psi", "temp_c", "hours_on",
        calendar_year("prod_date", iso_year).alias("year"), F.weekofyear("prod_date").alias("week"))
    return partials_per_well(dated, ["well_id", "year", "week"], "reading_id",
                             ["oil_bbl", "bsw_pct", "wellhead_psi", "temp_c", "hours_on"])


def in_fields(per_well: DataFrame, wells: DataFrame) -> DataFrame:
    """Sums per well and week with the field of the well. Copies of a well in a field are one row that counts as often."""
    copies = wells.groupBy("well_id", "field").agg(F.count(F.lit(1)).alias("copies"))
    sums = [c for c in per_well.columns if c.startswith(("n_", "sum_"))]
    return per_well.join(copies, "well_id").withColumns({c: F.col(c) * F.col("copies") for c in sums}).drop("copies")


def weekly_of_located(per_well: DataFrame, one_row_a_well: bool = False) -> DataFrame:
    """Weeks by field from readings summed by well and week, with the field of the well.

    ``one_row_a_well``: no well has two rows in a week and field, so its rows are counted as they are. Telling
    wells apart would have every task hold a row of sums for each well and week.
    """
    active = F.count("well_id") if one_row_a_well else F.countDistinct("well_id")
    return (per_well.groupBy("field", "year", "week")
            .agg(total("oil_bbl").alias("weekly_oil_bbl"),
                 mean("bsw_pct").alias("mean_bsw_pct"),
                 mean("wellhead_psi", 1).alias("mean_wellhead_psi"),
                 mean("temp_c", 1).alias("mean_temp_c"),
                 mean("hours_on", 1).alias("mean_hours_on"),
                 active.alias("active_wells")))


def with_earlier_weeks(weekly: DataFrame, frame: tuple[int, int] = (-3, 0)) -> DataFrame:
    """Previous week's volume and the mean of four rows; rows with any null are left out.

    The default frame contains the row's own volume, which is the forecast target, so the mean leaks
    it. ``frame=(-4, -1)`` takes the four weeks before.
    """
    return lag_and_mean(weekly, "field", ["year", "week"], TARGET, "prev_week_oil_bbl", "mean4_oil_bbl",
                        frame).na.drop()


def weekly_features(production: DataFrame, wells: DataFrame, iso_year: bool = False,
                    frame: tuple[int, int] = (-3, 0)) -> DataFrame:
    return with_earlier_weeks(weekly_production(production, wells, iso_year), frame)
