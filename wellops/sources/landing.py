"""Scans of the landing folders: CSV with header, JSON lines, in batch or as a stream.

Each scan adds the ingestion time and the file a row came from. That has to happen per source: the
hidden ``_metadata`` column does not exist above a union.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellops.sinks.layout import Layout, save_schema, saved_schema


# What a row holds beyond its columns: a JSON object of names and texts. A line that is no row is under LINE.
RESCUED, LINE = "rescued", "_line"
_WIDTH = {"int": 0, "bigint": 1, "double": 2}


def infer_schema(spark: SparkSession, path: str, fmt: str, known: Collection[str] = ()) -> T.StructType:
    """Schema of all files landed so far, from one distributed pass over them.

    ``known`` columns are read as text, to be cast to the type they are known to have; text takes
    every value a later file may bring. Only the others are inferred. CSV columns come from the
    header of one file, and a source whose header holds known columns only is not read beyond it; a
    file with another header stops the scan later (see ``scan``).
    """
    if fmt == "csv":
        reader = spark.read.option("header", True)
        columns = reader.csv(path).columns
        if all(c in known for c in columns):
            return T.StructType([T.StructField(c, T.StringType()) for c in columns])
        inferred = reader.option("inferSchema", True).csv(path)
    else:
        inferred = spark.read.option("columnNameOfCorruptRecord", LINE).json(path)
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in known else f.dataType)
                         for f in inferred.schema if f.name not in (RESCUED, LINE)])


def remembered_schema(spark: SparkSession, layout: Layout, source: str, fmt: str,
                      known: Collection[str] = ()) -> T.StructType:
    """The schema saved for a source; inferred and saved the first time.

    A file stream needs its schema up front and must see the same one after every restart.
    """
    location = layout.schema(source)
    schema = saved_schema(spark, location)
    if schema is None:
        schema = infer_schema(spark, layout.landing(source), fmt, known)
        save_schema(spark, location, schema)
    return schema


def _fits(seen: T.DataType, kept: T.DataType) -> bool:
    """Whether values of the type seen can be read as the type kept."""
    a, b = seen.simpleString(), kept.simpleString()
    return a == b or b == "string" or (a in _WIDTH and b in _WIDTH and _WIDTH[a] <= _WIDTH[b])


def schema_drift(spark: SparkSession, layout: Layout, source: str, fmt: str) -> list[str]:
    """Differences between the saved schema of a source and the files now present.

    New columns need a decision, so they are reported and never taken over silently.
    """
    kept = {f.name: f.dataType for f in remembered_schema(spark, layout, source, fmt)}
    seen = {f.name: f.dataType for f in infer_schema(spark, layout.landing(source), fmt)}
    return ([f"new column {c}" for c in seen if c not in kept]
            + [f"missing column {c}" for c in kept if c not in seen]
            + [f"column {c}: {kept[c].simpleString()} became {seen[c].simpleString()}"
               for c in kept if c in seen and not _fits(seen[c], kept[c])])


def with_audit(df: DataFrame) -> DataFrame:
    return df.select("*", F.current_timestamp().alias("ingested_at"), F.col("_metadata.file_name").alias("source_file"))


def unknown_json_columns(spark: SparkSession, layout: Layout, source: str, known: Collection[str] = ()) -> list[str]:
    """Columns in the landed files that the saved schema of a JSON source lacks."""
    kept = {f.name for f in remembered_schema(spark, layout, source, "json", known)}
    return [f.name for f in infer_schema(spark, layout.landing(source), "json") if f.name not in kept]


def _json_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON lines as columns; what the columns do not hold stays in ``RESCUED``.

    That is the fields that are not in ``schema``, values that are not of the type there, or the whole
    line under ``_line`` if it is no JSON object. Null where nothing was left over.
    """
    fields, row = F.col("_fields"), F.col("_row")
    known = [f.name for f in schema]
    typed = [f.name for f in schema if f.dataType != T.StringType()]

    def left_over(name, text):
        out = ~name.isin(*known)
        for c in typed:
            out = out | ((name == c) & row[c].isNull() & text.isNotNull())
        return out

    extra = F.map_filter(fields, left_over)
    broken = (F.trim("value") != "") & (fields.isNull() | ~F.trim("value").startswith("{"))
    rescued = F.when(broken, F.create_map(F.lit(LINE), F.col("value"))).when(F.size(extra) > 0, extra)
    # Each line is parsed once for its columns and once for all its fields.
    parsed = lines.filter(F.trim("value") != "").select(
        "value", F.from_json("value", schema).alias("_row"), F.from_json("value", "map<string,string>").alias("_fields"), "_metadata")
    return parsed.select("_row.*", F.when(rescued.isNotNull(), F.to_json(rescued)).alias(RESCUED), "_metadata")


def scan(spark: SparkSession, path: str, fmt: str, schema: T.StructType, stream: bool = True,
         options: dict[str, str] | None = None) -> DataFrame:
    """Scan of one landing folder. As a stream it takes each file once.

    ``options`` pass through, for example ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` to bound
    a micro-batch. A CSV header that differs from the schema stops the run. The column ``rescued``
    keeps what does not fit: unknown fields and broken lines of JSON, CSV lines with too many or
    too few values.
    """
    reader = (spark.readStream if stream else spark.read).options(**(options or {}))
    if fmt == "csv":
        kept = T.StructType([*schema, T.StructField(LINE, T.StringType())])
        rows = (reader.schema(kept).option("header", True).option("enforceSchema", False)
                .option("columnNameOfCorruptRecord", LINE).csv(path).select("*", "_metadata"))
        rescued = F.when(F.col(LINE).isNotNull(), F.create_map(F.lit(LINE), F.col(LINE)))
        rows = rows.withColumn(RESCUED, F.to_json(rescued)).drop(LINE)
    else:
        rows = _json_lines(reader.text(path).select("value", "_metadata"), schema)
    return with_audit(rows).drop("_metadata")
