"""Raw layer: the landing files as they are, plus ingestion time and file name.

Known columns get their types; the text of a value that cannot be read as its type, a column that is not known
and a line that is no row are kept in ``rescued``, a JSON object of names and texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellops import names, schemas
from wellops.sinks import evolution
from wellops.sinks.layout import Layout
from wellops.sources.landing import RESCUED, remembered_schema, scan, unknown_json_columns

AUDIT_COLUMNS = ["ingested_at", "source_file", RESCUED]
#: Option: what fields nobody knows do. ``rescue`` keeps them in ``rescued``, ``add`` makes them columns at the next start,
#: ``fail`` stops (only where the schema is inferred).
NEW_COLUMNS = "newColumns"


def _as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns ``df`` shares with ``schema``; others stay. Text that cannot be read is rescued."""
    present = set(df.columns)
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema if f.name in present}
    texts = [c for c in cast if dict(df.dtypes)[c] == "string" and schema[c].dataType != T.StringType()]
    if RESCUED in present and texts:
        none = F.create_map().cast("map<string,string>")
        unread = F.map_filter(F.create_map(*[x for c in texts for x in (F.lit(c), F.when(cast[c].isNull(), F.col(c)))]),
                              lambda name, text: text.isNotNull() & (F.trim(text) != ""))
        both = F.map_concat(F.coalesce(F.from_json(RESCUED, "map<string,string>"), none), unread)
        # Maps are built for the few rows that have anything to rescue.
        any_left = reduce(Column.__or__, [cast[c].isNull() & (F.trim(c) != "") for c in texts], F.col(RESCUED).isNotNull())
        cast[RESCUED] = F.when(any_left, F.when(F.size(both) > 0, F.to_json(both)))
    return df.withColumns(cast)


def _landed(spark: SparkSession, layout: Layout, source: str, fmt: str, schema: T.StructType, glossary: str,
            stream: bool, options: dict[str, str] | None) -> DataFrame:
    known = names.known_columns(schema, glossary)
    found = remembered_schema(spark, layout, source, fmt, known)
    options = dict(options or {})
    mode = options.pop(NEW_COLUMNS, "rescue")
    if fmt == "json":
        found = evolution.source_schema(found, evolution.added(spark, layout, source))
        if mode == "fail" and (unknown := set(unknown_json_columns(spark, layout, source, known)) - set(found.names)):
            raise ValueError(f"{source} has new columns: {', '.join(sorted(unknown))}")
    df = names.to_english(scan(spark, layout.landing(source), fmt, found, stream, options), glossary)
    return _as_schema(df, schema)


def wells(spark: SparkSession, layout: Layout, stream: bool = True,
          options: dict[str, str] | None = None) -> DataFrame:
    return _landed(spark, layout, "wells_csv", "csv", schemas.WELLS, "wells", stream, options)


def production_history(spark: SparkSession, layout: Layout, stream: bool = True,
                       options: dict[str, str] | None = None) -> DataFrame:
    return _landed(spark, layout, "production_csv", "csv", schemas.PRODUCTION, "production", stream, options)


def production_live(spark: SparkSession, layout: Layout, stream: bool = True,
                    options: dict[str, str] | None = None, portuguese: bool = False) -> DataFrame:
    """The live feed has a fixed schema, because its folder starts empty."""
    schema = names.portuguese_schema(schemas.PRODUCTION, "production") if portuguese else schemas.PRODUCTION
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    text = evolution.source_schema(text, evolution.added(spark, layout, "production_live"))
    options = {k: v for k, v in (options or {}).items() if k != NEW_COLUMNS}
    df = names.to_english(scan(spark, layout.landing("production_live"), "json", text, stream, options), "production")
    return _as_schema(df, schemas.PRODUCTION)


def union_production(history: DataFrame, live: DataFrame) -> DataFrame:
    """History and feed by column name; a column that one lacks is null there."""
    return _as_schema(history, schemas.PRODUCTION).unionByName(_as_schema(live, schemas.PRODUCTION),
                                                               allowMissingColumns=True)


def production(spark: SparkSession, layout: Layout, stream: bool = True, options: dict[str, str] | None = None,
               portuguese: bool = False) -> DataFrame:
    return union_production(production_history(spark, layout, stream, options),
                            production_live(spark, layout, stream, options, portuguese))


def orders(spark: SparkSession, layout: Layout, stream: bool = True,
           options: dict[str, str] | None = None) -> DataFrame:
    return _landed(spark, layout, "orders_json", "json", schemas.ORDERS, "orders", stream, options)


def union_production_sql(history: DataFrame, live: DataFrame) -> DataFrame:
    """The same union written in SQL: by position, so every branch lists and casts its columns. An audit column that only
    one of them has is null in the other."""
    columns = ", ".join(f"TRY_CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schemas.PRODUCTION)
    types = {**dict(history.dtypes), **dict(live.dtypes)}

    def listed(df: DataFrame) -> str:
        audit = [c if c in df.columns else f"CAST(NULL AS {types[c]}) AS {c}" for c in AUDIT_COLUMNS if c in types]
        return ", ".join([columns, *audit])

    return history.sparkSession.sql(
        f"SELECT {listed(history)} FROM {{history}} UNION ALL SELECT {listed(live)} FROM {{live}}", history=history, live=live)
