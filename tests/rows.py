"""Inline rows for unit tests: valid defaults, to be varied one column at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wellops import schemas

WELL = {"well_id": "1", "sap_code": "POCO-1", "well_name": " frade-1 ", "field": "frade", "basin": "Campos",
        "well_type": "Produtor", "lift_method": "BCS", "depth_m": "2500.5", "latitude": "-22.5",
        "longitude": "-40.1", "status": "Produzindo", "drilled_on": "2010-05-17", "operator": "Op",
        "registered_at": "2018-01-01 00:00:00"}
READING = {"reading_id": "1_20200101_a", "well_id": "1", "prod_date": "2020-01-01", "oil_bbl": "100.0",
           "gas_mm3": "1.0", "water_bbl": "10.0", "bsw_pct": "20.0", "wellhead_psi": "500.0", "temp_c": "60.0",
           "hours_on": "20.0", "reading_type": "Fiscal", "source": "SAP_PP"}
ORDER = {"order_id": "1", "sap_om": "OM-1", "well_id": "1", "maint_type": "preventiva", "equipment": "EQ",
         "priority": "3-Normal", "status": "Aberta", "description": "x", "opened_on": "2020-01-01",
         "closed_on": "2020-02-01", "est_cost": "1000.0", "actual_cost": "900.0", "cost_center": "CC",
         "crew": "Equipe"}


def _frame(spark: SparkSession, default: dict, columns: list[str], changes: tuple[dict, ...]) -> DataFrame:
    """Rows as text, the way a CSV file without type inference arrives."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = [tuple(None if v is None else str(v) for v in ({**default, **change}[c] for c in columns))
            for change in changes]
    return spark.createDataFrame(rows, schema)


def wells(spark: SparkSession, *changes: dict) -> DataFrame:
    return _frame(spark, WELL, schemas.WELLS.names, changes)


def readings(spark: SparkSession, *changes: dict) -> DataFrame:
    return _frame(spark, READING, schemas.PRODUCTION.names, changes)


def orders(spark: SparkSession, *changes: dict) -> DataFrame:
    return _frame(spark, ORDER, schemas.ORDERS.names, changes)
