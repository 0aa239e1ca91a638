"""Date and time parsing expressions. Malformed input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType

from riskloom.schema import WEEKDAYS

_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_CLOCK = r"^(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:[0-5]?[0-9]$"


def parse_date(col: Column) -> Column:
    """Date of ``yyyy-MM-dd`` text. The pattern keeps other spellings out, the cast does the rest."""
    return F.when(col.rlike(_DAY), col.try_cast("date"))


def date_column(df: DataFrame, name: str) -> Column:
    """A column as date, parsed only when it is still text."""
    if isinstance(df.schema[name].dataType, DateType):
        return F.col(name)
    return parse_date(F.col(name).cast("string"))


def parse_hour(col: Column) -> Column:
    """Hour of ``HH:mm:ss`` text. Plain text work, so the session time zone plays no part."""
    return F.when(col.rlike(_CLOCK), F.substring_index(col, ":", 1).cast("int"))


def weekday_name(col: Column) -> Column:
    """English weekday name of a date."""
    return F.get(F.array(*[F.lit(name) for name in WEEKDAYS]), F.weekday(col))


def age_years(on: Column, born: Column) -> Column:
    """Age in whole years, rounded, from two dates."""
    return F.round(F.datediff(on, born) / F.lit(365.25).cast("double")).cast("int")
