"""The one rule for a missing cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, the empty string, or NaN.  Never null itself, so it can be counted."""
    return missing_value(quoted(name), df.schema[name].dataType)


def missing_value(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return value.isNull() | (value == "")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def quoted(name: str) -> Column:
    """A column reference that survives dots and spaces in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def share(part: Column, whole: Column, default: float | None = None, digits: int = 6) -> Column:
    """``part / whole`` rounded; an empty whole gives the default."""
    ratio = F.round(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double"), digits)
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def family(dtype: T.DataType, declared: str | None = None) -> str:
    """Type family used by the profile and the type check."""
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.IntegralType):
        return "int"
    if isinstance(dtype, (T.FractionalType,)):
        return "float"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    return "category" if declared == "category" else "string"


def field_family(field: T.StructField) -> str:
    return family(field.dataType, (field.metadata or {}).get("declared_type"))
