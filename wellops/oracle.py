"""SQL that states the expected results on DuckDB, independent of the Spark plans.

The derived inputs are the shared texts of ``sources.fixtures``; everything after them is written
here anew: rules with plain CASE and WHERE, rollups with a direct join of all rows.
"""

from __future__ import annotations

from wellops.sources import fixtures

_TABLES = {t: t for t in ("customer", "nation", "region", "lineitem", "orders", "events")}
_TODAY = f"DATE '{fixtures.AS_OF}'"


def _initcap(column: str) -> str:
    return (f"array_to_string(list_transform(string_split(trim({column}), ' '), "
            "lambda w: upper(w[1]) || lower(w[2:])), ' ')")


# Fixed values of the rules.
_WELL_STATUS_OK = "status IN ('Produzindo', 'Parado', 'Manutencao', 'Abandonado', 'Completacao')"
_ORDER_STATUS_OK = "status IN ('Aberta', 'Em Execucao', 'Concluida', 'Cancelada', 'Aguardando Material')"
_PRIORITY_OK = "priority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')"

WELL_RULES = [
    ("coordinates_present", "drop", "latitude IS NOT NULL AND longitude IS NOT NULL"),
    ("depth_positive", "drop", "depth_m > 0"),
    ("drilled_not_in_future", "drop", f"drilled_on <= {_TODAY}"),
    ("status_known", "count", _WELL_STATUS_OK),
    ("well_id_present", "fail", "well_id IS NOT NULL"),
]
PRODUCTION_RULES = [
    ("oil_positive", "drop", "oil_bbl > 0"),
    ("date_not_in_future", "drop", f"prod_date <= {_TODAY}"),
    ("bsw_in_range", "count", "bsw_pct BETWEEN 0 AND 100"),
    ("oil_plausible", "count", "oil_bbl < 50000"),
    ("well_id_present", "fail", "well_id IS NOT NULL"),
]
ORDER_RULES = [
    ("cost_positive", "drop", "est_cost > 0"),
    ("status_known", "count", _ORDER_STATUS_OK),
    ("priority_known", "count", _PRIORITY_OK),
    ("description_present", "count", "description IS NOT NULL"),
    ("well_id_present", "drop", "well_id IS NOT NULL"),
]


def _kept(rules: list[tuple[str, str, str]]) -> str:
    return " AND ".join(f"coalesce({p}, false)" for _, action, p in rules if action == "drop")


def _rule_counts(relation: str, rules: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule, '{action}' AS action, "
        f"count(*) FILTER (WHERE NOT coalesce({p}, false)) AS violations, count(*) AS total FROM {relation}"
        for name, action, p in rules)


_WELL_FIRST = """SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sap_code ORDER BY well_id) AS rn FROM {0}) WHERE rn = 1"""

# Named sub-queries; each query below takes the ones it needs, in this order.
_PARTS: dict[str, tuple[str, ...]] = {}
_TEXTS: dict[str, str] = {}


def _part(name: str, text: str, *needs: str) -> None:
    _PARTS[name], _TEXTS[name] = needs, text


_part("raw_wells", fixtures.RAW_WELLS.format(**_TABLES))
_part("raw_production", fixtures.RAW_PRODUCTION.format(**_TABLES))
_part("raw_orders", fixtures.RAW_ORDERS.format(**_TABLES))
_part("typed_wells", f"""SELECT * REPLACE (upper(trim(well_name)) AS well_name, {_initcap('field')} AS field,
    {_initcap('status')} AS status) FROM raw_wells""", "raw_wells")
_part("unique_wells", _WELL_FIRST.format("typed_wells"), "typed_wells")
_part("wells", f"SELECT * FROM unique_wells WHERE {_kept(WELL_RULES)}", "unique_wells")
_part("wells_plain", f"SELECT * FROM typed_wells WHERE {_kept(WELL_RULES)}", "typed_wells")
_part("wells_rules_first", _WELL_FIRST.format("wells_plain"), "wells_plain")
_part("typed_production", """SELECT *,
    CASE WHEN oil_bbl > 50000 THEN true ELSE false END AS is_outlier,
    CASE WHEN bsw_pct > 100 THEN true ELSE false END AS is_high_bsw,
    CAST(year(prod_date) AS INTEGER) AS year, CAST(month(prod_date) AS INTEGER) AS month,
    CAST(day(prod_date) AS INTEGER) AS day FROM raw_production""", "raw_production")
_part("production", f"SELECT * FROM typed_production WHERE {_kept(PRODUCTION_RULES)}", "typed_production")
_part("typed_orders", f"""SELECT * REPLACE ({_initcap('maint_type')} AS maint_type,
    {_initcap('status')} AS status) FROM raw_orders""", "raw_orders")
_part("work_orders", f"SELECT * FROM typed_orders WHERE {_kept(ORDER_RULES)}", "typed_orders")
_part("located", "SELECT p.*, w.field, w.basin, w.well_name, w.well_type FROM production p "
      "JOIN wells w ON p.well_id = w.well_id", "production", "wells")
_part("located_orders", "SELECT o.*, w.field FROM work_orders o JOIN wells w ON o.well_id = w.well_id",
      "work_orders", "wells")


def _weekly(year: str) -> str:
    return f"""SELECT field, CAST({year}(prod_date) AS INTEGER) AS year, CAST(week(prod_date) AS INTEGER) AS week,
    round(sum(oil_bbl), 2) AS weekly_oil_bbl, round(avg(bsw_pct), 2) AS mean_bsw_pct,
    round(avg(wellhead_psi), 1) AS mean_wellhead_psi, round(avg(temp_c), 1) AS mean_temp_c,
    round(avg(hours_on), 1) AS mean_hours_on, count(DISTINCT well_id) AS active_wells
    FROM located GROUP BY ALL"""


def _features(weekly: str, frame: str) -> str:
    return f"""SELECT * FROM (SELECT *,
    lag(weekly_oil_bbl) OVER (PARTITION BY field ORDER BY year, week) AS prev_week_oil_bbl,
    round(avg(weekly_oil_bbl) OVER (PARTITION BY field ORDER BY year, week ROWS BETWEEN {frame}), 2) AS mean4_oil_bbl
    FROM {weekly}) t WHERE prev_week_oil_bbl IS NOT NULL AND mean4_oil_bbl IS NOT NULL AND mean_bsw_pct IS NOT NULL
    AND mean_wellhead_psi IS NOT NULL AND mean_temp_c IS NOT NULL AND mean_hours_on IS NOT NULL"""


_part("weekly", _weekly("year"), "located")
_part("weekly_iso", _weekly("isoyear"), "located")
_part("features", _features("weekly", "3 PRECEDING AND CURRENT ROW"), "weekly")
_part("production_by_field", """SELECT field, basin, count(reading_id) AS readings,
    count(DISTINCT well_id) AS active_wells, round(sum(oil_bbl), 2) AS total_oil_bbl,
    round(avg(oil_bbl), 2) AS mean_oil_bbl, round(avg(bsw_pct), 2) AS mean_bsw_pct,
    round(avg(wellhead_psi), 1) AS mean_wellhead_psi, round(avg(hours_on), 1) AS mean_hours_on
    FROM located GROUP BY field, basin""", "located")
_part("maintenance_cost", """SELECT maint_type, equipment, count(order_id) AS orders,
    round(sum(est_cost), 2) AS total_est_cost, round(avg(est_cost), 2) AS mean_est_cost,
    round(sum(actual_cost), 2) AS total_actual_cost, round(avg(actual_cost), 2) AS mean_actual_cost,
    count(DISTINCT well_id) AS affected_wells FROM work_orders GROUP BY maint_type, equipment""", "work_orders")
_part("efficiency", """SELECT p.*, o.maint_orders, o.maint_cost FROM (
    SELECT field, count(DISTINCT well_id) AS wells, round(sum(oil_bbl), 2) AS total_oil_bbl,
      round(avg(hours_on), 1) AS mean_uptime_hours, round(avg(bsw_pct), 2) AS mean_bsw_pct,
      round(sum(oil_bbl) / count(DISTINCT well_id), 2) AS oil_per_well_bbl FROM located GROUP BY field) p
    LEFT JOIN (SELECT field, count(order_id) AS maint_orders, round(sum(est_cost), 2) AS maint_cost
      FROM located_orders GROUP BY field) o ON p.field = o.field""", "located", "located_orders")


def _errors(prediction: str) -> dict[str, str]:
    return {"mae": f"avg(abs(weekly_oil_bbl - {prediction}))",
            "rmse": f"sqrt(avg((weekly_oil_bbl - {prediction}) * (weekly_oil_bbl - {prediction})))",
            "r2": f"1 - sum((weekly_oil_bbl - {prediction}) * (weekly_oil_bbl - {prediction})) / "
                  "(var_pop(weekly_oil_bbl) * count(*))"}


def _mean_2(column: str) -> str:
    """Mean to two places, half up on the decimal value. Means of few rows do fall on ties, where
    DuckDB's round on doubles follows the binary value instead."""
    return f"CAST(round(CAST(CAST(avg({column}) AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)"


# Metrics are sums over floating-point squares, so they are compared to a stated number of places.
METRIC_PLACES = {"mae": 2, "rmse": 2, "r2": 6}


def _metric(name: str, prediction: str) -> str:
    return f"round({_errors(prediction)[name]}, {METRIC_PLACES[name]})"


def _query(text: str, *needs: str) -> str:
    """The query with exactly the sub-queries it needs, in order of dependency."""
    chosen: list[str] = []

    def visit(name: str) -> None:
        for need in _PARTS[name]:
            visit(need)
        if name not in chosen:
            chosen.append(name)

    for need in needs:
        visit(need)
    return "WITH " + ",\n".join(f"{n} AS ({_TEXTS[n]})" for n in chosen) + "\n" + text


_ALL_COUNTS = {
    "bronze_wells": "raw_wells", "bronze_production": "raw_production", "bronze_orders": "raw_orders",
    "silver_wells": "wells", "silver_production": "production", "silver_orders": "work_orders",
    "gold_production_by_field": "production_by_field", "gold_maintenance_cost": "maintenance_cost",
    "gold_efficiency": "efficiency",
}


_FIELD, _KIND, _FIRST, _LAST = "Nation_7", "BUILDING", "DATE '1996-01-01'", "DATE '1998-12-31'"
_TILE = f"field = '{_FIELD}' AND well_type = '{_KIND}'"
_READ = f"{_TILE} AND prod_date BETWEEN {_FIRST} AND {_LAST}"
_OPENED = (f"opened_on BETWEEN {_FIRST} AND {_LAST} AND well_id IN (SELECT well_id FROM wells WHERE {_TILE})")
_HELD_OUT = "(year * 53 + week) % 5 = 0"
_COMMENTS = {
    "bronze_wells": "Raw wells (CSV)", "bronze_production": "Raw readings: CSV history and live feed",
    "bronze_orders": "Raw work orders (JSON)", "silver_wells": "Validated wells, one row per code",
    "silver_production": "Validated daily production", "silver_orders": "Validated work orders",
    "gold_production_by_field": "Production by field", "gold_maintenance_cost": "Maintenance cost by type and equipment",
    "gold_efficiency": "Operational efficiency by field"}


def _what_if() -> str:
    """Every feature row three times, and the ranges it leaves."""
    rows = "\nUNION ALL\n".join(
        f"SELECT * REPLACE ({change}), '{name}' AS scenario FROM features" for name, change in (
            ("as_is", "week AS week"), ("full_hours", "24.0::DOUBLE AS mean_hours_on"),
            ("more_water", "mean_bsw_pct + 10 AS mean_bsw_pct")))
    ranges = (("week_in_range", "week BETWEEN 1 AND 53"), ("bsw_in_range", "mean_bsw_pct BETWEEN 0 AND 100"),
              ("pressure_in_range", "mean_wellhead_psi BETWEEN 50 AND 5000"),
              ("temperature_in_range", "mean_temp_c BETWEEN 30 AND 150"), ("hours_in_range", "mean_hours_on BETWEEN 0 AND 24"),
              ("wells_in_range", "active_wells >= 1"),
              ("volumes_not_negative", "prev_week_oil_bbl >= 0 AND mean4_oil_bbl >= 0"))
    named = ", ".join(f"CASE WHEN NOT ({test}) THEN '{name}' END" for name, test in ranges)
    return (f"SELECT field, year, week, scenario, mean_bsw_pct, mean_hours_on, true AS in_range, "
            f"concat_ws(',', {named}) AS out_of_range FROM ({rows})")


def _more() -> dict[str, str]:
    scored = "SELECT field, year, week, weekly_oil_bbl, true AS in_range, true AS error_is_difference FROM features"
    vector = ("week", "mean_bsw_pct", "mean_wellhead_psi", "mean_temp_c", "mean_hours_on", "active_wells",
              "prev_week_oil_bbl", "mean4_oil_bbl")
    return {
        "forecast_holdout": "SELECT unnest(['mae', 'rmse', 'r2']) AS metric, true AS known, true AS better_fits",
        "forecast_batch": _query(scored, "features"),
        "forecast_errors": _query(f"{scored} WHERE {_HELD_OUT}", "features"),
        "scenario_scores": _query(_what_if(), "features"),
        "forecast_checks": _query(
            f"""SELECT count(*) AS scored, count(*) FILTER (WHERE {_HELD_OUT}) AS held_out, 0::BIGINT AS without_prediction,
            0::BIGINT AS out_of_range, 1::BIGINT AS champion_version, 2::BIGINT AS challenger_version FROM features""", "features"),
        "forecast_features_vector": _query(
            "SELECT field, year, week, 8::INTEGER AS n_features, " + ", ".join(
                f"{c}::DOUBLE AS feature_{k}" for k, c in enumerate(vector)) + " FROM features", "features"),
        "production_by_field_filtered": _query(
            f"SELECT field, round(sum(oil_bbl), 2) AS total_oil_bbl FROM located WHERE {_READ} GROUP BY field", "located"),
        "monthly_evolution_filtered": _query(
            f"""SELECT year, month, round(sum(oil_bbl), 2) AS total_oil_bbl FROM located WHERE {_READ}
            GROUP BY year, month""", "located"),
        "cost_by_equipment_filtered": _query(
            f"""SELECT equipment, round(sum(est_cost), 2) AS total_est_cost FROM work_orders WHERE {_OPENED}
            GROUP BY equipment ORDER BY total_est_cost DESC, equipment LIMIT 5""", "work_orders", "wells"),
        "well_health_filtered": _query(
            f"""SELECT well_id, any_value(well_name) AS well_name, any_value(field) AS field,
            any_value(well_type) AS well_type, {_mean_2('bsw_pct')} AS mean_bsw_pct,
            round(sum(oil_bbl), 2) AS total_oil_bbl FROM located WHERE {_READ} GROUP BY well_id""", "located"),
        "top_costs_filtered": _query(
            f"""SELECT order_id, well_id, maint_type, equipment, est_cost FROM work_orders WHERE {_OPENED}
            ORDER BY est_cost DESC, order_id LIMIT 5""", "work_orders", "wells"),
        "costliest_maint_type_filtered": _query(
            f"""SELECT maint_type, round(sum(est_cost), 2) AS total_est_cost FROM work_orders WHERE {_OPENED}
            GROUP BY maint_type ORDER BY total_est_cost DESC, maint_type LIMIT 1""", "work_orders", "wells"),
        "producing_by_basin_filtered": _query(
            f"""SELECT basin, count(*) AS producing_wells FROM wells WHERE status = 'Produzindo' AND {_TILE}
            GROUP BY basin""", "wells"),
        "high_bsw_wells_80": _query(
            f"""SELECT well_id, any_value(well_name) AS well_name, any_value(field) AS field,
            {_mean_2('bsw_pct')} AS mean_bsw_pct FROM located GROUP BY well_id HAVING avg(bsw_pct) > 80""", "located"),
        "stream_rescued_values": _query(
            """SELECT CASE WHEN order_id % 10 = 4 THEN order_id END AS order_id,
            CASE order_id % 10 WHEN 3 THEN '{"order_id":"x' || order_id || '"}' WHEN 4 THEN '{"vendor":"ACME"}'
                 ELSE '{"_line":"no json ' || order_id || '"}' END AS rescued
            FROM raw_orders WHERE order_id % 10 IN (3, 4, 5)""", "raw_orders"),
        "stream_added_columns": _query(
            """SELECT order_id, CASE WHEN order_id % 3 > 0 AND order_id % 2 = 0 THEN 'V' || (order_id % 9) END AS vendor,
            CASE order_id % 3 WHEN 1 THEN CAST(order_id % 7 AS DOUBLE) WHEN 2 THEN (order_id % 50) / 4.0 END AS rating,
            CASE WHEN order_id % 3 > 0 THEN order_id % 5 = 0 END AS urgent, true AS nothing_left FROM work_orders""", "work_orders"),
        "stream_audit_columns": _query(
            """SELECT 'bronze_orders' AS dataset, count(*) AS row_count, count(*) AS with_time, count(*) AS with_file,
            count(*) AS with_stamp FROM raw_orders UNION ALL
            SELECT 'silver_orders', count(*), count(*), count(*), count(*) FROM work_orders""", "raw_orders", "work_orders"),
        "table_comments": _query("\nUNION ALL\n".join(
            f"SELECT '{name}' AS name, '{_COMMENTS[name]}' AS comment, count(*) AS row_count FROM {part}"
            for name, part in _ALL_COUNTS.items()), *_ALL_COUNTS.values()),
        "union_by_position": _query(
            "SELECT * REPLACE (CAST(prod_date AS VARCHAR) AS prod_date) FROM raw_production", "raw_production"),
        "composed_reading_ids": """SELECT event_id || '_s' AS reading_id,
            user_id || '_' || strftime(CAST(ts AS DATE), '%Y%m%d') || '_' || event_id AS composed FROM events""",
    }


def queries() -> dict[str, str]:
    return {**_main(), **_more()}


def _main() -> dict[str, str]:
    naive = [(m, p) for m in ("mae", "rmse", "r2") for p in ("prev_week_oil_bbl", "mean4_oil_bbl")]
    compared = "\nUNION ALL\n".join(
        f"SELECT '{m}' AS metric, {_metric(m, 'prev_week_oil_bbl')} AS champion, "
        f"{_metric(m, 'mean4_oil_bbl')} AS challenger FROM features" for m in ("mae", "rmse", "r2"))
    spend = _query(
        """SELECT field, count(*) AS orders, round(sum(est_cost), 2) AS total_est_cost,
        round(sum(actual_cost), 2) AS total_actual_cost FROM located_orders WHERE field = 'Nation_5'
        GROUP BY field""", "located_orders")
    counts = "\nUNION ALL\n".join(
        f"SELECT '{name.split('_')[0].upper()}' AS layer, '{name}' AS dataset, count(*) AS row_count, "
        f"'ok' AS status FROM {part}" for name, part in _ALL_COUNTS.items())
    return {
        "silver_wells": _query("SELECT * FROM wells", "wells"),
        "silver_wells_plain": _query("SELECT * FROM wells_plain", "wells_plain"),
        "silver_wells_expect_first": _query("SELECT * FROM wells_rules_first", "wells_rules_first"),
        "silver_wells_sql": _query("SELECT * FROM wells_plain", "wells_plain"),
        "silver_production_sql": _query("SELECT * FROM production", "production"),
        "silver_orders_sql": _query("SELECT * FROM work_orders", "work_orders"),
        "silver_production": _query("SELECT * FROM production", "production"),
        "silver_orders": _query("SELECT * FROM work_orders", "work_orders"),
        "dq_wells": _query(_rule_counts("unique_wells", WELL_RULES), "unique_wells"),
        "dq_production": _query(_rule_counts("typed_production", PRODUCTION_RULES), "typed_production"),
        "dq_orders": _query(_rule_counts("typed_orders", ORDER_RULES), "typed_orders"),
        "gold_production_by_field": _query("SELECT * FROM production_by_field", "production_by_field"),
        "gold_production_by_field_sql": _query("SELECT * FROM production_by_field", "production_by_field"),
        "gold_maintenance_cost": _query("SELECT * FROM maintenance_cost", "maintenance_cost"),
        "gold_maintenance_cost_sql": _query("SELECT * FROM maintenance_cost", "maintenance_cost"),
        "gold_efficiency": _query("SELECT * FROM efficiency", "efficiency"),
        "gold_efficiency_sql": _query("SELECT * FROM efficiency", "efficiency"),
        "gold_production_by_field_portuguese": _query(
            """SELECT field AS campo, basin AS bacia, readings AS total_medicoes, active_wells AS pocos_ativos,
            total_oil_bbl AS producao_total_bbl, mean_oil_bbl AS producao_media_bbl, mean_bsw_pct AS bsw_medio_pct,
            mean_wellhead_psi AS pressao_media_psi, mean_hours_on AS horas_operacao_media
            FROM production_by_field""", "production_by_field"),
        "weekly_production": _query("SELECT * FROM weekly", "weekly"),
        "weekly_features": _query("SELECT * FROM features", "features"),
        "weekly_features_noleak": _query(_features("weekly", "4 PRECEDING AND 1 PRECEDING"), "weekly"),
        "weekly_features_iso": _query(_features("weekly_iso", "3 PRECEDING AND CURRENT ROW"), "weekly_iso"),
        "split_counts": _query(
            """SELECT CASE WHEN (year * 53 + week) % 5 <> 0 THEN 'train' ELSE 'test' END AS part, count(*) AS row_count
            FROM features GROUP BY ALL""", "features"),
        "naive_metrics": _query(
            "SELECT " + ", ".join(f"{_metric(m, p)} AS {m}_{'last_week' if p.startswith('prev') else 'mean4'}"
                                  for m, p in naive) + " FROM features", "features"),
        "champion_vs_challenger": _query(
            f"""SELECT *, CASE WHEN metric = 'r2' AND challenger > champion THEN 'challenger'
            WHEN metric <> 'r2' AND challenger < champion THEN 'challenger' ELSE 'champion' END AS better
            FROM ({compared})""", "features"),
        "alias_resolution": _query(
            "SELECT * FROM (" + "\nUNION ALL\n".join(
                f"SELECT '{alias}' AS alias, CAST({version} AS BIGINT) AS version, "
                + ", ".join(f"{_metric(m, p)} AS {m}" for m in ("mae", "rmse", "r2")) + " FROM features"
                for alias, version, p in (("champion", 2, "mean4_oil_bbl"), ("challenger", 2, "mean4_oil_bbl"),
                                          ("previous", 1, "prev_week_oil_bbl"))) + ")", "features"),
        "forecast_delta_bands": _query(
            """SELECT field, year, week, mean4_oil_bbl AS prediction, prev_week_oil_bbl,
            round(CASE WHEN prev_week_oil_bbl <> 0 THEN (mean4_oil_bbl - prev_week_oil_bbl) / prev_week_oil_bbl * 100
                  ELSE 0 END, 6) AS change_pct,
            CASE WHEN mean4_oil_bbl >= prev_week_oil_bbl THEN 'up' ELSE 'down' END AS direction,
            CASE WHEN mean4_oil_bbl < greatest(mean4_oil_bbl * 2, 200000) * 0.3e0 THEN 'low'
                 WHEN mean4_oil_bbl < greatest(mean4_oil_bbl * 2, 200000) * 0.7e0 THEN 'medium' ELSE 'high' END AS band
            FROM features""", "features"),
        "kpi_cards": _query(
            """SELECT 'producing_wells' AS kpi, CAST(count(*) AS DOUBLE) AS value FROM wells WHERE status = 'Produzindo'
            UNION ALL SELECT 'total_oil_bbl', round(sum(oil_bbl), 2) FROM production
            UNION ALL SELECT 'mean_bsw_pct', round(avg(bsw_pct), 2) FROM production
            UNION ALL SELECT 'open_orders', CAST(count(*) AS DOUBLE) FROM work_orders WHERE status = 'Aberta'""",
            "wells", "production", "work_orders"),
        "kpi_cards_filtered": _query(
            """SELECT 'producing_wells' AS kpi, CAST(count(*) AS DOUBLE) AS value FROM wells
              WHERE status = 'Produzindo' AND field = 'Nation_7' AND well_type = 'BUILDING'
            UNION ALL SELECT 'total_oil_bbl', round(sum(oil_bbl), 2) FROM located WHERE field = 'Nation_7'
              AND well_type = 'BUILDING' AND prod_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
            UNION ALL SELECT 'mean_bsw_pct', round(avg(bsw_pct), 2) FROM located WHERE field = 'Nation_7'
              AND well_type = 'BUILDING' AND prod_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
            UNION ALL SELECT 'open_orders', CAST(count(*) AS DOUBLE) FROM work_orders WHERE status = 'Aberta'
              AND opened_on BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
              AND well_id IN (SELECT well_id FROM wells WHERE field = 'Nation_7' AND well_type = 'BUILDING')""",
            "wells", "located", "work_orders"),
        "production_by_field": _query(
            "SELECT field, round(sum(oil_bbl), 2) AS total_oil_bbl FROM located GROUP BY field", "located"),
        "monthly_evolution": _query(
            "SELECT year, month, round(sum(oil_bbl), 2) AS total_oil_bbl FROM production GROUP BY year, month",
            "production"),
        "monthly_evolution_field": _query(
            """SELECT year, month, round(sum(oil_bbl), 2) AS total_oil_bbl FROM located
            WHERE field = 'Nation_3' GROUP BY year, month""", "located"),
        "cost_by_equipment": _query(
            """SELECT equipment, round(sum(est_cost), 2) AS total_est_cost FROM work_orders GROUP BY equipment
            ORDER BY total_est_cost DESC, equipment LIMIT 5""", "work_orders"),
        "well_health": _query(
            f"""SELECT well_id, any_value(well_name) AS well_name, any_value(field) AS field,
            any_value(well_type) AS well_type, {_mean_2('bsw_pct')} AS mean_bsw_pct,
            round(sum(oil_bbl), 2) AS total_oil_bbl FROM located GROUP BY well_id""", "located"),
        "top_field": _query(
            """SELECT field, round(sum(oil_bbl), 2) AS total_oil_bbl FROM located GROUP BY field
            ORDER BY total_oil_bbl DESC, field LIMIT 1""", "located"),
        "field_maintenance_spend": spend,
        "field_maintenance_spend_sql": spend,
        "high_bsw_wells": _query(
            f"""SELECT well_id, any_value(well_name) AS well_name, any_value(field) AS field,
            {_mean_2('bsw_pct')} AS mean_bsw_pct FROM located GROUP BY well_id HAVING avg(bsw_pct) > 55""",
            "located"),
        "producing_by_basin": _query(
            """SELECT basin, count(*) AS producing_wells FROM wells WHERE status = 'Produzindo' GROUP BY basin""",
            "wells"),
        "costliest_maint_type": _query(
            """SELECT maint_type, round(sum(est_cost), 2) AS total_est_cost FROM work_orders GROUP BY maint_type
            ORDER BY total_est_cost DESC, maint_type LIMIT 1""", "work_orders"),
        "top5_costs": _query(
            """SELECT order_id, well_id, maint_type, equipment, est_cost FROM work_orders
            ORDER BY est_cost DESC, order_id LIMIT 5""", "work_orders"),
        "stream_bronze_production": _query(
            "SELECT * REPLACE (CAST(prod_date AS VARCHAR) AS prod_date) FROM raw_production", "raw_production"),
        "stream_silver_wells": _query("SELECT * FROM wells", "wells"),
        "stream_wells_lowest": _query("SELECT * FROM wells", "wells"),
        "stream_silver_production": _query("SELECT * FROM production", "production"),
        "stream_silver_orders": _query("SELECT * FROM work_orders", "work_orders"),
        "stream_incremental": _query(
            """SELECT CAST(0 AS BIGINT) AS version, count(*) AS new_rows FROM raw_production WHERE source = 'SAP_PP'
            UNION ALL SELECT CAST(1 AS BIGINT), count(*) FROM raw_production WHERE source <> 'SAP_PP'""",
            "raw_production"),
        "stream_dq_metrics": _query(
            f"""SELECT 'silver_production' AS dataset, CASE WHEN source = 'SAP_PP' THEN 0::BIGINT ELSE 1::BIGINT END
            AS version, rule, violations FROM (
            {" UNION ALL ".join(
                f"SELECT source, '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({p}, false)) AS violations "
                "FROM typed_production GROUP BY source" for name, _, p in PRODUCTION_RULES)})""", "typed_production"),
        "stream_history_complete": _query(
            f"""SELECT dataset, version, row_count, CASE WHEN dataset = 'silver_production' THEN kept END AS kept FROM
            (SELECT CAST(((well_id % 4) + 4) % 4 AS BIGINT) AS version, count(*) AS row_count,
            count(*) FILTER (WHERE {_kept(PRODUCTION_RULES)}) AS kept FROM typed_production GROUP BY 1)
            CROSS JOIN (SELECT unnest(['bronze_production', 'silver_production']) AS dataset)""", "typed_production"),
        "stream_compacted": _query("SELECT * FROM production", "production"),
        "table_production_by_well": _query("SELECT * FROM production_by_field", "production_by_field"),
        "table_weekly_by_well": _query("SELECT * FROM weekly", "weekly"),
        "stream_active_wells": _query(
            """SELECT field, period, count(DISTINCT well_id) AS exact_wells, true AS within_two_percent FROM (
            SELECT field, well_id, 'all' AS period FROM located
            UNION ALL SELECT field, well_id, '1996' FROM located WHERE year(prod_date) = 1996)
            GROUP BY field, period""", "located"),
        "gold_incremental": _query("SELECT * FROM production_by_field", "production_by_field"),
        "gold_incremental_efficiency": _query("SELECT * FROM efficiency", "efficiency"),
        "gold_incremental_cost": _query("SELECT * FROM maintenance_cost", "maintenance_cost"),
        "layer_counts": _query(counts, *_ALL_COUNTS.values()),
        "run_history": _query(
            f"""SELECT dataset, version, 'CREATE OR REFRESH' AS operation, row_count AS written_rows FROM ({counts})
            CROSS JOIN (SELECT unnest([0::BIGINT, 1::BIGINT]) AS version)
            WHERE version = 0 OR layer = 'GOLD'""", *_ALL_COUNTS.values()),
        "namespace_names": """SELECT c_custkey AS user_key,
            lower(replace(replace(split_part(replace(c_name, '#', '.') || '-' || c_mktsegment || '@example.com', '@', 1),
            '.', '_'), '-', '_')) AS namespace FROM customer""",
    }
