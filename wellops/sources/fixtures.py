"""Wells, readings and work orders derived from the star-schema test tables.

Each text runs unchanged on Spark and on DuckDB; the braces stand for the tables. Keys stay 64-bit
and an unknown well gets a negative id, so that both hold at any scale factor. The measures are
whole or half units, which makes their sums exact in every order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-29"
ORDER_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")

RAW_WELLS = """
SELECT c_custkey AS well_id,
       'POCO-' || CAST(c_custkey - CASE WHEN c_custkey % 50 = 49 THEN 1 ELSE 0 END AS STRING) AS sap_code,
       '  ' || lower(c_name) || ' ' AS well_name,
       ' ' || lower(n_name) || ' ' AS field,
       r_name AS basin,
       c_mktsegment AS well_type,
       CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'BCS' WHEN 1 THEN 'Gas Lift' ELSE 'Rod Pump' END AS lift_method,
       c_acctbal AS depth_m,
       CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE -22.5e0 + (c_custkey % 200) / 100e0 END AS latitude,
       CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE -40.0e0 + (c_custkey % 150) / 100e0 END AS longitude,
       CASE CAST(c_custkey % 20 AS INT) WHEN 0 THEN 'produzindo' WHEN 1 THEN 'ATIVO' WHEN 2 THEN ' Parado '
            WHEN 3 THEN 'Manutencao' WHEN 4 THEN 'Abandonado' WHEN 5 THEN 'Completacao' ELSE 'Produzindo' END AS status,
       DATE '2005-01-01' + CAST((c_custkey * 37) % 7100 AS INT) AS drilled_on,
       'Operadora' AS operator
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

RAW_HISTORY = """
SELECT CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) AS reading_id,
       o_custkey AS well_id,
       CAST(l_shipdate AS DATE) AS prod_date,
       floor(l_extendedprice) * 0.5e0 - 1000e0 AS oil_bbl,
       CAST(floor(l_extendedprice * l_tax) AS DOUBLE) AS gas_mm3,
       l_quantity * 40e0 AS water_bbl,
       round(l_discount * 100e0) * 10.5e0 AS bsw_pct,
       50e0 + l_quantity * 50e0 AS wellhead_psi,
       30e0 + CAST(l_partkey % 90 AS DOUBLE) AS temp_c,
       CAST(CAST(l_quantity AS INT) % 49 AS DOUBLE) * 0.5e0 AS hours_on,
       l_returnflag AS reading_type,
       'SAP_PP' AS source
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

RAW_LIVE = """
SELECT CAST(event_id AS STRING) || '_s' AS reading_id,
       user_id AS well_id,
       CAST(ts AS DATE) AS prod_date,
       CAST(floor(value * 16e0) AS DOUBLE) AS oil_bbl,
       CAST(floor(value) AS DOUBLE) AS gas_mm3,
       CAST(floor(value * 10e0) AS DOUBLE) AS water_bbl,
       CAST(event_id % 95 AS DOUBLE) AS bsw_pct,
       50e0 + floor(value) AS wellhead_psi,
       30e0 + CAST(event_id % 90 AS DOUBLE) AS temp_c,
       CAST(event_id % 24 AS DOUBLE) AS hours_on,
       event_type AS reading_type,
       'SCADA_Streaming' AS source
FROM {events}
"""

RAW_PRODUCTION = f"{RAW_HISTORY} UNION ALL {RAW_LIVE}"

RAW_ORDERS = """
SELECT o_orderkey AS order_id,
       'OM-' || CAST(o_orderkey AS STRING) AS sap_om,
       CASE WHEN o_orderkey % 25 = 0 THEN -1 - o_custkey ELSE o_custkey END AS well_id,
       CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 'preventiva' WHEN 1 THEN 'CORRETIVA' WHEN 2 THEN ' Preditiva'
            WHEN 3 THEN 'Emergencial' ELSE 'parada programada' END AS maint_type,
       'EQ-' || CAST((o_orderkey * 7) % 10 AS STRING) AS equipment,
       o_orderpriority AS priority,
       CASE WHEN o_orderkey % 20 = 0 THEN 'CONC' WHEN o_orderkey % 20 = 1 THEN 'aberta'
            WHEN o_orderkey % 20 = 2 THEN 'aguardando material'
            WHEN o_orderstatus = 'O' THEN 'Aberta' WHEN o_orderstatus = 'P' THEN 'Em Execucao' ELSE 'Concluida' END AS status,
       CASE WHEN o_orderkey % 16 = 0 THEN NULL ELSE 'Inspecao ' || CAST(o_orderkey % 10 AS STRING) END AS description,
       CAST(o_orderdate AS DATE) AS opened_on,
       CASE WHEN o_orderkey % 33 = 0 THEN CAST(o_orderdate AS DATE) - CAST(1 + o_orderkey % 30 AS INT)
            WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 90 AS INT) END AS closed_on,
       floor(o_totalprice) - 15000e0 AS est_cost,
       CASE WHEN floor(o_totalprice) > 15000e0 THEN (floor(o_totalprice) - 15000e0) * 1.25e0 END AS actual_cost,
       'CC-' || CAST(o_orderkey % 7 AS STRING) AS cost_center,
       'Equipe ' || CAST(o_orderkey % 6 AS STRING) AS crew
FROM {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in names})


def raw_wells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RAW_WELLS, "customer", "nation", "region")


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RAW_HISTORY, "lineitem", "orders")


def raw_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RAW_LIVE, "events")


def raw_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_history(spark, sf_dir).union(raw_live(spark, sf_dir))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RAW_ORDERS, "orders")
