"""Namespaces and named tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellops import names
from wellops.functions.columns import namespace_name
from wellops.sinks import datasets
from wellops.sinks.layout import Layout


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(value: str) -> str:
    return ".".join(f"`{part}`" for part in value.split("."))


def user_namespace(spark: SparkSession) -> str:
    """Namespace of the current user."""
    return spark.range(1).select(namespace_name(F.current_user()).alias("name")).first()["name"]


def use_namespace(spark: SparkSession, name: str, location: str | None = None, catalog: str | None = None) -> None:
    """Create a schema where it is absent and make it current."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_name(name)}{place}")
    spark.sql(f"USE {_name(name)}")


def drop_namespace(spark: SparkSession, name: str) -> None:
    """Drop a schema with all its tables. Never called by the library itself."""
    spark.sql(f"DROP SCHEMA IF EXISTS {_name(name)} CASCADE")


def save_table(df: DataFrame, name: str, comment: str = "") -> None:
    """Overwrite a managed table and set its comment."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    if comment:
        df.sparkSession.sql(f"COMMENT ON TABLE {_name(name)} IS {_text(comment)}")


def _point(spark: SparkSession, name: str, path: str, schema: T.StructType, comment: str) -> None:
    """Make a name stand for the files at ``path``. A table of the same columns is moved there, so it is never absent;
    only other columns, or partitions, need a new table."""
    table = _name(name)
    if spark.catalog.tableExists(name):
        same = spark.table(name).schema.simpleString() == schema.simpleString()
        if same and not any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(path)}")
            spark.sql(f"COMMENT ON TABLE {table} IS {_text(comment)}")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema, description=comment)


def expose(spark: SparkSession, layout: Layout, namespace: str, portuguese: bool = False) -> None:
    """Make the newest versions of all datasets readable by name, with their comments.

    With ``portuguese`` each also gets a view under its Portuguese table and column names, so that
    existing SQL runs as it is.
    """
    known = datasets.current(spark, layout, list(names.DATASETS))
    for name, (_, path, comment) in known.items():
        table = _name(f"{namespace}.{name}")
        schema = spark.read.parquet(path).schema
        _point(spark, f"{namespace}.{name}", path, schema, comment or "")
        if portuguese:
            own_name, glossary = names.DATASETS[name]
            own = {english: column for column, english in names.GLOSSARIES[glossary].items()}
            columns = ", ".join(f"{_name(c)} AS {_name(own.get(c, c))}" for c in schema.names)
            spark.sql(f"CREATE OR REPLACE VIEW {_name(f'{namespace}.{own_name}')} AS SELECT {columns} FROM {table}")
