"""Sorted results come in the order that SQL gives them."""

from __future__ import annotations

import importlib

import compare
import pytest

entry = importlib.import_module("__spark_entry__")
QUERIES, SQL = entry.queries(), entry.oracle_sql()
ORDERED = {
    "gold_production_by_field": "total_oil_bbl DESC", "gold_maintenance_cost": "total_est_cost DESC", "gold_efficiency": "total_oil_bbl DESC",
    "weekly_production": "field, year, week", "production_by_field": "total_oil_bbl DESC, field", "monthly_evolution": "year, month",
    "cost_by_equipment": "total_est_cost DESC, equipment", "top5_costs": "est_cost DESC, order_id"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    assert compare.order_differences(result, duck, SQL[name], ORDERED[name]) == []
    if result.count() > 2:  # the comparison notices rows that are not in order
        assert compare.order_differences(result.orderBy(result.columns[-1]), duck, SQL[name], ORDERED[name]) or \
            compare.order_differences(result.orderBy(result[result.columns[-1]].desc()), duck, SQL[name], ORDERED[name])
