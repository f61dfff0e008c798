"""Portuguese column names, as found in landing files and used by existing reports.

Fixed values: these names must equal the ones users already have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

WELLS = {
    "id_poco": "well_id",
    "codigo_sap": "sap_code",
    "nome_poco": "well_name",
    "campo": "field",
    "bacia": "basin",
    "tipo_poco": "well_type",
    "metodo_elevacao": "lift_method",
    "profundidade_m": "depth_m",
    "data_perfuracao": "drilled_on",
    "operador": "operator",
    "data_cadastro_sap": "registered_at",
}

PRODUCTION = {
    "id_producao": "reading_id",
    "id_poco": "well_id",
    "data_producao": "prod_date",
    "vol_oleo_bbl": "oil_bbl",
    "vol_gas_mm3": "gas_mm3",
    "vol_agua_bbl": "water_bbl",
    "pressao_cabeca_psi": "wellhead_psi",
    "temperatura_c": "temp_c",
    "horas_operacao": "hours_on",
    "tipo_medicao": "reading_type",
    "fonte_dado": "source",
    "flag_outlier": "is_outlier",
    "flag_bsw_alto": "is_high_bsw",
    "ano": "year",
    "mes": "month",
    "dia": "day",
}

ORDERS = {
    "id_ordem": "order_id",
    "numero_om_sap": "sap_om",
    "id_poco": "well_id",
    "tipo_manutencao": "maint_type",
    "equipamento": "equipment",
    "prioridade": "priority",
    "descricao": "description",
    "data_abertura": "opened_on",
    "data_conclusao": "closed_on",
    "custo_estimado_brl": "est_cost",
    "custo_real_brl": "actual_cost",
    "centro_custo_sap": "cost_center",
    "responsavel": "crew",
}

AUDIT = {
    "_data_ingestao": "ingested_at",
    "_arquivo_origem": "source_file",
    "_processado_em": "processed_at",
}

PRODUCTION_BY_FIELD = {
    "campo": "field",
    "bacia": "basin",
    "total_medicoes": "readings",
    "pocos_ativos": "active_wells",
    "producao_total_bbl": "total_oil_bbl",
    "producao_media_bbl": "mean_oil_bbl",
    "bsw_medio_pct": "mean_bsw_pct",
    "pressao_media_psi": "mean_wellhead_psi",
    "horas_operacao_media": "mean_hours_on",
}

MAINTENANCE_COST = {
    "tipo_manutencao": "maint_type",
    "equipamento": "equipment",
    "total_ordens": "orders",
    "custo_estimado_total": "total_est_cost",
    "custo_estimado_medio": "mean_est_cost",
    "custo_real_total": "total_actual_cost",
    "custo_real_medio": "mean_actual_cost",
    "pocos_afetados": "affected_wells",
}

EFFICIENCY = {
    "campo": "field",
    "total_pocos": "wells",
    "producao_total_bbl": "total_oil_bbl",
    "uptime_medio_horas": "mean_uptime_hours",
    "bsw_medio_pct": "mean_bsw_pct",
    "producao_media_por_poco": "oil_per_well_bbl",
    "total_ordens_manutencao": "maint_orders",
    "custo_manutencao_total": "maint_cost",
}

FEATURES = {
    "campo": "field",
    "ano": "year",
    "semana": "week",
    "vol_oleo_semanal": "weekly_oil_bbl",
    "bsw_medio": "mean_bsw_pct",
    "pressao_media": "mean_wellhead_psi",
    "temperatura_media": "mean_temp_c",
    "horas_operacao_media": "mean_hours_on",
    "pocos_ativos": "active_wells",
    "vol_semana_anterior": "prev_week_oil_bbl",
    "vol_media_4_semanas": "mean4_oil_bbl",
    "producao_prevista_bbl": "predicted_oil_bbl",
    "erro_bbl": "error_bbl",
}

GLOSSARIES = {
    "wells": {**WELLS, **AUDIT},
    "production": {**PRODUCTION, **AUDIT},
    "orders": {**ORDERS, **AUDIT},
    "gold_production_by_field": PRODUCTION_BY_FIELD,
    "gold_maintenance_cost": MAINTENANCE_COST,
    "gold_efficiency": EFFICIENCY,
    "features": FEATURES,
}

# Dataset -> (Portuguese table name, glossary of its columns).
DATASETS = {
    "bronze_wells": ("bronze_pocos", "wells"),
    "bronze_production": ("bronze_producao", "production"),
    "bronze_orders": ("bronze_ordens", "orders"),
    "silver_wells": ("silver_pocos", "wells"),
    "silver_production": ("silver_producao", "production"),
    "silver_orders": ("silver_ordens", "orders"),
    "gold_production_by_field": ("gold_producao_por_campo", "gold_production_by_field"),
    "gold_maintenance_cost": ("gold_custos_manutencao", "gold_maintenance_cost"),
    "gold_efficiency": ("gold_eficiencia_operacional", "gold_efficiency"),
}


def to_english(df: DataFrame, glossary: str) -> DataFrame:
    """Rename the Portuguese columns that are present; others stay as they are."""
    return df.withColumnsRenamed(GLOSSARIES[glossary])


def to_portuguese(df: DataFrame, glossary: str) -> DataFrame:
    """The reverse renaming, for readers that use the Portuguese names."""
    return df.withColumnsRenamed({english: own for own, english in GLOSSARIES[glossary].items()})


def portuguese_schema(schema: T.StructType, glossary: str) -> T.StructType:
    """``schema`` with Portuguese field names, to read landing files that carry them."""
    reverse = {english: own for own, english in GLOSSARIES[glossary].items()}
    return T.StructType([T.StructField(reverse.get(f.name, f.name), f.dataType) for f in schema.fields])


def known_columns(schema: T.StructType, glossary: str) -> set[str]:
    """The columns of ``schema`` under both names."""
    return {*schema.names, *portuguese_schema(schema, glossary).names}
