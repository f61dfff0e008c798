from __future__ import annotations

import datetime as dt

import pytest
import rows

from wellops.plans import bi, features, gold, gold_sql, silver

AS_OF = "2024-01-29"


@pytest.fixture(scope="module")
def data(spark):
    wells = rows.wells(spark, {"well_id": 1, "sap_code": "a", "field": "frade"},
                       {"well_id": 2, "sap_code": "b", "field": "frade", "well_type": "Pioneiro"},
                       {"well_id": 3, "sap_code": "c", "field": "polvo", "status": "Parado"})
    readings = rows.readings(
        spark, {"well_id": 1, "oil_bbl": 100, "bsw_pct": 10, "prod_date": "2020-01-06"},
        {"well_id": 1, "oil_bbl": 200, "bsw_pct": None, "prod_date": "2020-01-14"},
        {"well_id": 2, "oil_bbl": 300, "bsw_pct": 90, "prod_date": "2020-02-03"},
        {"well_id": 3, "oil_bbl": 50, "bsw_pct": 85, "prod_date": "2020-02-04"},
        {"well_id": 9, "oil_bbl": 999, "prod_date": "2020-02-05"},
        {"well_id": 3, "reading_id": None, "oil_bbl": 70, "bsw_pct": 80, "prod_date": "2020-02-04"})
    orders = rows.orders(spark, {"order_id": 1, "well_id": 1, "est_cost": 100, "actual_cost": None},
                         {"order_id": 2, "well_id": 1, "est_cost": 300, "actual_cost": 500},
                         {"order_id": 3, "well_id": 999, "est_cost": 900, "status": "Concluida"})
    return (silver.production(readings, AS_OF, stamp=False), silver.wells(wells, AS_OF, stamp=False),
            silver.orders(orders, stamp=False))


def _by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_production_by_field(data):
    got = _by(gold.production_by_field(*data[:2]), "field")
    assert got["Frade"] == {"field": "Frade", "basin": "Campos", "readings": 3, "active_wells": 2,
                            "total_oil_bbl": 600.0, "mean_oil_bbl": 200.0, "mean_bsw_pct": 50.0,
                            "mean_wellhead_psi": 500.0, "mean_hours_on": 20.0}
    assert got["Polvo"]["readings"] == 1 and got["Polvo"]["total_oil_bbl"] == 120.0  # null id is not counted
    assert set(got) == {"Frade", "Polvo"}


def test_rollup_equals_a_direct_join_when_well_ids_repeat(spark, data):
    production, wells, _ = data
    twice = wells.union(wells.filter("well_id = 1").withColumns({"sap_code": wells["well_name"]}))
    got = _by(gold.production_by_field(production, twice), "field")["Frade"]
    assert (got["readings"], got["active_wells"], got["total_oil_bbl"]) == (5, 2, 900.0)
    assert got["mean_oil_bbl"] == 180.0


def test_maintenance_cost_ignores_null_actual_cost_and_keeps_orphans(data):
    got = gold.maintenance_cost(data[2]).collect()
    assert len(got) == 1
    assert got[0]["orders"] == 3 and got[0]["affected_wells"] == 2
    assert got[0]["total_est_cost"] == 1300.0 and got[0]["mean_actual_cost"] == 700.0


def test_efficiency_keeps_fields_without_orders(data):
    got = _by(gold.efficiency(*data), "field")
    assert got["Frade"]["maint_orders"] == 2 and got["Frade"]["maint_cost"] == 400.0
    assert got["Frade"]["oil_per_well_bbl"] == 300.0
    assert got["Polvo"]["maint_orders"] is None and got["Polvo"]["maint_cost"] is None


def test_sql_and_dataframe_forms_agree(data):
    for a, b in ((gold.production_by_field(*data[:2]), gold_sql.production_by_field(*data[:2])),
                 (gold.maintenance_cost(data[2]), gold_sql.maintenance_cost(data[2])),
                 (gold.efficiency(*data), gold_sql.efficiency(*data)),
                 (bi.field_maintenance_spend(data[2], data[1], "Frade"),
                  gold_sql.field_maintenance_spend(data[2], data[1], "Frade"))):
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_spend_period(data):
    _, wells, orders = data
    period = bi.Filters(first_day="2020-01-01", last_day="2020-01-01")
    assert bi.field_maintenance_spend(orders, wells, "Frade", period).first()["total_est_cost"] == 400.0
    assert gold_sql.field_maintenance_spend(orders, wells, "Frade", "2020-01-02", None).count() == 0
    assert gold_sql.field_maintenance_spend(orders, wells, "Frade", None, "2020-01-01").first()["orders"] == 2


def test_kpis_and_filters(data):
    def cards(filters=bi.NO_FILTERS):
        return {r["kpi"]: r["value"] for r in bi.kpi_cards(*data, filters).collect()}

    assert cards() == {"producing_wells": 2.0, "total_oil_bbl": 1719.0, "mean_bsw_pct": 57.0, "open_orders": 2.0}
    assert cards(bi.Filters(field="Frade", well_type="Pioneiro")) == {
        "producing_wells": 1.0, "total_oil_bbl": 300.0, "mean_bsw_pct": 90.0, "open_orders": 0.0}
    assert cards(bi.Filters(field="Polvo", last_day="2019-12-31"))["total_oil_bbl"] is None


def test_monthly_evolution(data):
    production, wells, _ = data
    assert [tuple(r) for r in bi.monthly_evolution(production, wells).collect()] == [(2020, 1, 300.0),
                                                                                     (2020, 2, 1419.0)]
    one = bi.monthly_evolution(production, wells, bi.Filters(field="Polvo", first_day="2020-02-01"))
    assert [tuple(r) for r in one.collect()] == [(2020, 2, 120.0)]


def test_rankings(data):
    production, wells, orders = data
    assert bi.top_field(production, wells).first()["field"] == "Frade"
    assert [r["order_id"] for r in bi.top_costs(orders, wells, 2).collect()] == [3, 2]
    assert [r["well_id"] for r in bi.high_bsw_wells(production, wells).orderBy("well_id").collect()] == [2, 3]
    assert {r["basin"]: r["producing_wells"] for r in bi.producing_by_basin(wells).collect()} == {"Campos": 2}
    health = _by(bi.well_health(production, wells), "well_id")
    assert health[1]["mean_bsw_pct"] == 10.0 and health[1]["total_oil_bbl"] == 300.0


def _weekly(spark, *weeks):
    return spark.createDataFrame([("F", y, w, float(v), 1.0, 1.0, 1.0, 1.0, 1) for y, w, v in weeks],
                                 "field string, year int, week int, weekly_oil_bbl double, mean_bsw_pct double, "
                                 "mean_wellhead_psi double, mean_temp_c double, mean_hours_on double, "
                                 "active_wells bigint")


def test_lag_and_mean_go_by_row_and_skip_gaps(spark):
    got = features.with_earlier_weeks(_weekly(spark, (2020, 1, 10), (2020, 2, 20), (2020, 5, 60))).collect()
    assert [(r["week"], r["prev_week_oil_bbl"], r["mean4_oil_bbl"]) for r in got] == [(2, 10.0, 15.0), (5, 20.0, 30.0)]


def test_frame_without_the_target(spark):
    weekly = _weekly(spark, (2020, 1, 10), (2020, 2, 20), (2020, 5, 60))
    got = features.with_earlier_weeks(weekly, frame=(-4, -1)).collect()
    assert [r["mean4_oil_bbl"] for r in got] == [10.0, 15.0]


def test_any_null_feature_removes_the_row(spark):
    weekly = _weekly(spark, (2020, 1, 10), (2020, 2, 20)).selectExpr(
        "* except (mean_temp_c)", "cast(null as double) as mean_temp_c")
    assert features.with_earlier_weeks(weekly).count() == 0


def test_iso_week_at_the_end_of_the_year(spark):
    reading = rows.readings(spark, {"prod_date": "2024-12-30"})
    production = silver.production(reading, "2025-06-01", stamp=False)
    wells = silver.wells(rows.wells(spark, {}), AS_OF, stamp=False)
    assert production.first()["prod_date"] == dt.date(2024, 12, 30)
    by_calendar = features.weekly_production(production, wells).first()
    by_week = features.weekly_production(production, wells, iso_year=True).first()
    assert (by_calendar["year"], by_calendar["week"]) == (2024, 1)
    assert (by_week["year"], by_week["week"]) == (2025, 1)
