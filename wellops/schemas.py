"""Column types of the three landing sources and the order of the validated columns.

Keys are 64-bit: 32-bit keys overflow long before 100 TB of readings. Dates travel as
``yyyy-MM-dd`` text until the validated layer.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in spec])


WELLS = _struct([
    ("well_id", T.LongType()),
    ("sap_code", T.StringType()),
    ("well_name", T.StringType()),
    ("field", T.StringType()),
    ("basin", T.StringType()),
    ("well_type", T.StringType()),
    ("lift_method", T.StringType()),
    ("depth_m", T.DoubleType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("status", T.StringType()),
    ("drilled_on", T.StringType()),
    ("operator", T.StringType()),
    ("registered_at", T.StringType()),
])

PRODUCTION = _struct([
    ("reading_id", T.StringType()),
    ("well_id", T.LongType()),
    ("prod_date", T.StringType()),
    ("oil_bbl", T.DoubleType()),
    ("gas_mm3", T.DoubleType()),
    ("water_bbl", T.DoubleType()),
    ("bsw_pct", T.DoubleType()),
    ("wellhead_psi", T.DoubleType()),
    ("temp_c", T.DoubleType()),
    ("hours_on", T.DoubleType()),
    ("reading_type", T.StringType()),
    ("source", T.StringType()),
])

ORDERS = _struct([
    ("order_id", T.LongType()),
    ("sap_om", T.StringType()),
    ("well_id", T.LongType()),
    ("maint_type", T.StringType()),
    ("equipment", T.StringType()),
    ("priority", T.StringType()),
    ("status", T.StringType()),
    ("description", T.StringType()),
    ("opened_on", T.StringType()),
    ("closed_on", T.StringType()),
    ("est_cost", T.DoubleType()),
    ("actual_cost", T.DoubleType()),
    ("cost_center", T.StringType()),
    ("crew", T.StringType()),
])

# The listed form of the validated wells leaves out the registration time.
WELL_COLUMNS = [f.name for f in WELLS.fields if f.name != "registered_at"]
PRODUCTION_COLUMNS = [f.name for f in PRODUCTION.fields]
ORDER_COLUMNS = [f.name for f in ORDERS.fields]
