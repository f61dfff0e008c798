"""Columns that appear later: versions of the schema of a source and of the streaming tables fed from it.

A field nobody knew is first kept in ``rescued``. ``evolve``, called at a start, looks at the rows of the raw table that came
since it last did and makes the names found there columns, under the narrowest type that holds all their values: a new
version of the source's schema. The landing folder is not listed or read for that. From then on the stream reads them
as columns, and stores them as text, so a type can widen later without a file being written again. ``with_added`` gives a
table its added columns in their type; old rows get theirs from ``rescued``, where they no longer appear.

A value that came after the last look and does not fit the type yet is shown in ``rescued`` until the next one. Names that
a table cannot hold beside its own (equal but for case, or columns the jobs add) stay there for good.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellops import names, schemas
from wellops.sinks import commits
from wellops.sinks.layout import Layout, exists, saved_schema
from wellops.sources.landing import LINE, RESCUED

#: Streaming table -> (source whose new fields it takes, glossary, known columns).
FED_BY = {"bronze_orders": ("orders_json", "orders", schemas.ORDERS), "silver_orders": ("orders_json", "orders", schemas.ORDERS),
          "bronze_production": ("production_live", "production", schemas.PRODUCTION),
          "silver_production": ("production_live", "production", schemas.PRODUCTION)}
RESERVED = {"ingested_at", "source_file", "processed_at", "is_outlier", "is_high_bsw", "year", "month", "day", RESCUED, LINE, ""}
#: More new names in one look are data that were made names of, and an error.
MAX_NEW = 1000

_INTEGER = r"^(0|-?[1-9][0-9]{0,18})$"
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_TEXTS = "map<string,string>"


@dataclass(frozen=True)
class Added:
    """A field of a source that became a column. ``exact``: its integers so far are also exact as doubles."""
    name: str
    kind: str
    exact: bool = True


def added(spark: SparkSession, layout: Layout, source: str) -> list[Added]:
    """The added columns of a source, by its newest version."""
    return _newest(spark, layout, source)[0]


def _newest(spark: SparkSession, layout: Layout, source: str) -> tuple[list[Added], int | None, int]:
    """Added columns, up to when (in microseconds) the raw table was looked at, and the version."""
    version = commits.newest(spark, layout.schema_versions(source))
    if version < 0:
        return [], None, version
    entry = commits.read(spark, layout.schema_versions(source), version)
    return [Added(**a) for a in entry["added"]], entry["until"], version


def source_schema(schema: T.StructType, more: Sequence[Added]) -> T.StructType:
    """The schema a source is read with: added columns as text."""
    return T.StructType([*schema, *[T.StructField(a.name, T.StringType()) for a in more if a.name not in schema.names]])


def table_schema(spark: SparkSession, layout: Layout, table: str) -> T.StructType | None:
    """The newest schema a streaming table is stored with."""
    version = commits.newest(spark, layout.schema_versions(table))
    if version < 0:
        return saved_schema(spark, layout.schema(table))
    return T.StructType.fromJson(json.loads(commits.read(spark, layout.schema_versions(table), version)["schema"]))


def save_table_schema(spark: SparkSession, layout: Layout, table: str, schema: T.StructType) -> None:
    commits.commit_next(spark, layout.schema_versions(table), {"schema": schema.json()})


def stored_schema(spark: SparkSession, layout: Layout, table: str) -> T.StructType:
    """How the files of a streaming table are read: as its files are, and the columns that only newer ones have."""
    found = spark.read.parquet(layout.stream(table)).schema
    if commits.newest(spark, layout.schema_versions(table)) < 0:
        return found
    return T.StructType(list(table_schema(spark, layout, table)))


def _column_names(more: Sequence[Added], glossary: str) -> dict[str, str]:
    """Field in the source -> column of the table."""
    return {a.name: names.GLOSSARIES[glossary].get(a.name, a.name) for a in more}


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def allowed(spark: SparkSession, layout: Layout, table: str) -> set[str]:
    """The columns a streaming table may gain."""
    if table not in FED_BY:
        return set()
    source, glossary, _ = FED_BY[table]
    return set(_column_names(added(spark, layout, source), glossary).values())


# Which names become columns -------------------------------------------------------------------------

def _kind(r: Mapping) -> str:
    return "bigint" if r["integers"] else "double" if r["numbers"] else "boolean" if r["booleans"] else "string"


def _wider(a: Added, b: Added) -> Added:
    """The narrowest type that holds the values of both."""
    exact = a.exact and b.exact
    if a.kind == b.kind:
        return Added(a.name, a.kind, exact)
    return Added(a.name, "double" if {a.kind, b.kind} == {"bigint", "double"} and exact else "string", exact)


def _kinds(values: DataFrame) -> DataFrame:
    """Per ``name`` which types hold all of its texts. Combines before the shuffle, so a frequent name moves little."""
    text = F.trim("text")
    integer, exact = text.rlike(_INTEGER) & text.try_cast("bigint").isNotNull(), ~text.rlike(r"^-?[0-9]{16,}$")
    return values.filter("text IS NOT NULL").groupBy("name").agg(
        F.bool_and(integer).alias("integers"), F.bool_and(text.rlike(_NUMBER) & exact).alias("numbers"),
        F.bool_and(text.isin("true", "false")).alias("booleans"), F.bool_and(exact).alias("exact"))


def _choose(found: Sequence[Added], old: Sequence[Added], taken: Sequence[str], glossary: str) -> list[Added]:
    """``old`` with wider types and the names of ``found`` that a table with the columns ``taken`` can hold."""
    chosen = {a.name: a for a in old}
    columns = {c.lower() for c in (*taken, *RESERVED, *_column_names(old, glossary).values())}
    for a in sorted(found, key=lambda a: a.name):
        column = names.GLOSSARIES[glossary].get(a.name, a.name)
        if a.name in chosen:
            chosen[a.name] = _wider(chosen[a.name], a)
        elif column.lower() not in columns:
            chosen[a.name] = a
            columns.add(column.lower())
    return list(chosen.values())


def evolve(spark: SparkSession, layout: Layout, table: str, max_new: int = MAX_NEW) -> list[Added]:
    """Make the fields rescued in a raw table since the last look columns of its source; returns all added ones.

    Fields of known names keep the type they are known to have. Of two writers at a time one commits, and the other one
    looks again. An empty table, and one without rescued fields, adds none.
    """
    source, glossary, known = FED_BY[table]
    schema = table_schema(spark, layout, table)
    if schema is None or not exists(spark, f"{layout.stream(table)}/_spark_metadata"):
        return []
    while True:
        old, until, version = _newest(spark, layout, source)
        rows = spark.read.schema(schema).parquet(layout.stream(table))
        taken = [c for c in rows.columns if c not in _column_names(old, glossary).values()]
        if until is not None:
            rows = rows.filter(F.col("ingested_at") > F.timestamp_micros(F.lit(until)))
        end = rows.agg(F.unix_micros(F.max("ingested_at"))).first()[0]
        if end is None:
            return old
        texts = rows.select(F.explode(F.from_json(RESCUED, _TEXTS)).alias("name", "text"))
        # Known by name in the table and read as such: a value that does not fit is no reason for another type.
        texts = texts.filter(~F.col("name").isin(LINE, *taken))
        present = [F.struct(F.lit(field).alias("name"), _col(column).cast("string").alias("text"))
                   for field, column in _column_names(old, glossary).items() if column in rows.columns]
        if present:
            texts = texts.unionByName(rows.select(F.inline(F.array(*present))))
        seen = _kinds(texts).limit(max_new + len(old) + 1).collect()
        if len(seen) > max_new + len(old):
            raise ValueError(f"{source} has more than {max_new} new columns; leave them in {RESCUED}")
        fixed = {f.name: f.dataType.simpleString() for f in known}
        found = [Added(r["name"], fixed.get(names.GLOSSARIES[glossary].get(r["name"], r["name"])) or _kind(r), r["exact"])
                 for r in seen]
        new = _choose(found, old, taken, glossary)
        if commits.commit_at(spark, layout.schema_versions(source), version + 1, {"added": [asdict(a) for a in new], "until": end}):
            return new


# Reading --------------------------------------------------------------------------------------------

def with_added(df: DataFrame, more: Sequence[Added], glossary: str) -> DataFrame:
    """``df`` as stored, with the added columns in their type and the values of rows older than a column.

    Where ``df`` keeps no ``rescued`` only the columns it has are typed.
    """
    columns = {field: c for field, c in _column_names(more, glossary).items() if c in df.columns or RESCUED in df.columns}
    if not columns:
        return df
    kinds, stored = {a.name: a.kind for a in more}, dict(df.dtypes)
    texts = F.from_json(RESCUED, _TEXTS) if RESCUED in df.columns else F.lit(None).cast(_TEXTS)
    made: dict[str, Column] = {}
    unread = []
    for field, column in columns.items():
        own = _col(column) if column in stored else F.lit(None).cast("string")
        # A known column keeps the type of its table, be it a date; others are stored as text.
        kind = kinds[field] if stored.get(column, "string") == "string" else stored[column]
        made[column] = F.coalesce(own.try_cast(kind), texts[field].try_cast(kind))
        text = F.coalesce(own.cast("string"), texts[field])
        unread += [F.lit(field), F.when(made[column].isNull(), text)]
    if RESCUED in df.columns:
        none = F.create_map().cast(_TEXTS)
        rest = F.map_filter(F.coalesce(texts, none), lambda name, text: ~name.isin(*columns))
        left = F.map_concat(rest, F.map_filter(F.create_map(*unread), lambda name, text: text.isNotNull()))
        made[RESCUED] = F.when(F.size(left) > 0, F.to_json(left))
    return df.withColumns(made)


def read(spark: SparkSession, layout: Layout, table: str, df: DataFrame) -> DataFrame:
    """``df``, the stored rows of a streaming table, as its readers see it."""
    if table not in FED_BY:
        return df
    source, glossary, _ = FED_BY[table]
    return with_added(df, added(spark, layout, source), glossary)
