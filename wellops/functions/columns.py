"""Column expressions: every one stays in the JVM and inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_PATTERN = "yyyy-MM-dd"


def upper_trimmed(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def title_trimmed(name: str) -> Column:
    """Trim and capitalise each word, which also repairs lower-case codes."""
    return F.initcap(F.trim(F.col(name)))


def as_type(name: str, kind: str) -> Column:
    """Cast that yields null for text it cannot read, so one bad value does not stop the run."""
    return F.col(name).try_cast(kind)


def as_date(name: str, present: T.DataType) -> Column:
    """Date from ``yyyy-MM-dd`` text; a column that is a date already passes unchanged."""
    if isinstance(present, T.DateType):
        return F.col(name)
    if isinstance(present, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return F.try_to_date(F.col(name), DATE_PATTERN)


def flag(condition: Column) -> Column:
    """True where the condition holds; null counts as false."""
    return F.when(condition, F.lit(True)).otherwise(F.lit(False))


def calendar_year(name: str, iso_year: bool = False) -> Column:
    """Calendar year, or the year the ISO week belongs to (they differ around New Year)."""
    if iso_year:
        return F.extract(F.lit("YEAROFWEEK"), F.col(name)).cast("int")
    return F.year(name)


def today(as_of: str | None) -> str:
    """SQL text for the validation date: a fixed date, or the day of the run."""
    return f"DATE '{as_of}'" if as_of else "current_date()"


def reading_id(well: str, day: str, suffix: Column) -> Column:
    """``{well}_{yyyymmdd}_{suffix}``."""
    return F.concat_ws("_", F.col(well).cast("string"), F.date_format(F.col(day), "yyyyMMdd"), suffix)


def namespace_name(user: Column) -> Column:
    """Per-user namespace: the part before ``@``, with ``.`` and ``-`` as ``_``, in lower case."""
    return F.lower(F.translate(F.substring_index(user, "@", 1), ".-", "__"))


def percent_change(value: Column, base: Column) -> Column:
    """Change against ``base`` in percent; 0 where there is no base."""
    return F.when(base != 0, (value - base) / base * 100).otherwise(F.lit(0.0))


def direction(value: Column, base: Column) -> Column:
    return F.when(value >= base, F.lit("up")).otherwise(F.lit("down"))


def band(prediction: Column, floor: float = 200_000.0, low: float = 0.3, high: float = 0.7) -> Column:
    """Low / medium / high on a scale that ends at twice the prediction or ``floor``."""
    scale = F.greatest(prediction * 2, F.lit(floor))
    return (F.when(prediction < scale * low, F.lit("low"))
            .when(prediction < scale * high, F.lit("medium"))
            .otherwise(F.lit("high")))
