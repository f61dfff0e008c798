"""How each landed column becomes a validated one, derived from its type in ``schemas``.

One rule serves the DataFrame and the SQL form: text stays text unless it is a name to trim or a date to read, and
any other type is a cast that yields null for text it cannot read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellops.functions.columns import DATE_PATTERN, as_date, as_type, title_trimmed, upper_trimmed

DATES = {"drilled_on", "prod_date", "opened_on", "closed_on"}
UPPER, TITLE = {"well_name"}, {"field", "status", "maint_type"}


def _column(field: T.StructField, present: T.DataType) -> Column | None:
    """The expression of a column, or None where it stays as it is."""
    name = field.name
    if name in UPPER or name in TITLE:
        return upper_trimmed(name) if name in UPPER else title_trimmed(name)
    if name in DATES:
        return as_date(name, present)
    return None if present == field.dataType else as_type(name, field.dataType.simpleString())


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """``raw`` with the columns of ``schema`` in their validated form; others pass."""
    kinds = {f.name: f.dataType for f in raw.schema}
    made = {f.name: _column(f, kinds[f.name]) for f in schema if f.name in kinds}
    return raw.withColumns({name: column for name, column in made.items() if column is not None})


def select_list(schema: T.StructType, columns: list[str]) -> str:
    """The same as a SQL select list of ``columns``."""
    def text(name: str) -> str:
        if name in UPPER or name in TITLE:
            return f"{'upper' if name in UPPER else 'initcap'}(trim({name}))"
        if name in DATES:
            return f"try_to_date({name}, '{DATE_PATTERN}')"
        return f"try_cast({name} AS {schema[name].dataType.simpleString()})"
    return ", ".join(f"{text(name)} AS {name}" for name in columns)
