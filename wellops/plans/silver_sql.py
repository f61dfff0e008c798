"""The validated layer with its projections in SQL, for users who keep their jobs as SQL text.

Same results as the ``plain`` variant of ``silver``: listed columns, no dedup. The rules are the
same rule lists, applied to the output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from wellops import schemas
from wellops.operators.quality import Rule, apply_rules
from wellops.plans.columns_of import select_list
from wellops.plans.rules import MAX_BSW_PCT, OUTLIER_OIL_BBL, order_rules, production_rules, well_rules

WELLS = f"SELECT {select_list(schemas.WELLS, schemas.WELL_COLUMNS)} FROM {{raw}}"
ORDERS = f"SELECT {select_list(schemas.ORDERS, schemas.ORDER_COLUMNS)} FROM {{raw}}"
_FLAGS = {"is_outlier": f"oil_bbl > {OUTLIER_OIL_BBL}", "is_high_bsw": f"bsw_pct > {MAX_BSW_PCT}"}
_DERIVED = [f"coalesce({test}, false) AS {name}" for name, test in _FLAGS.items()] + [
    f"{part}(prod_date) AS {part}" for part in ("year", "month", "day")]
PRODUCTION = f"""
WITH typed AS (SELECT {select_list(schemas.PRODUCTION, schemas.PRODUCTION_COLUMNS)} FROM {{raw}})
SELECT *, {", ".join(_DERIVED)} FROM typed
"""


def _select(text: str, raw: DataFrame) -> DataFrame:
    return raw.sparkSession.sql(text, raw=raw)


def wells(raw: DataFrame, as_of: str | None = None, rules: Sequence[Rule] | None = None) -> DataFrame:
    return apply_rules(_select(WELLS, raw), well_rules(as_of) if rules is None else rules)


def production(raw: DataFrame, as_of: str | None = None, rules: Sequence[Rule] | None = None) -> DataFrame:
    return apply_rules(_select(PRODUCTION, raw), production_rules(as_of) if rules is None else rules)


def orders(raw: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    return apply_rules(_select(ORDERS, raw), order_rules() if rules is None else rules)
