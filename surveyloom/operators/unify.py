"""Stack editions into one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import named
from ..functions.names import common_names

_WIDTH = ["byte", "short", "integer", "long", "float", "double"]
# Decimal digits of the whole-number types.
_DIGITS = {"byte": 3, "short": 5, "integer": 10, "long": 19}


def tag_year(df: DataFrame, year: int, name: str = "ano") -> DataFrame:
    """Add the edition year as a constant integer."""
    return df.withColumn(name, F.lit(int(year)))


def widest_type(types: Sequence[T.DataType]) -> T.DataType:
    """Type that holds every edition's values of a column; text where nothing else does."""
    distinct = list(dict.fromkeys(types))
    if len(distinct) == 1:
        return distinct[0]
    as_numbers = [T.IntegerType() if isinstance(t, T.BooleanType) else t for t in distinct]
    if all(t.typeName() in _WIDTH for t in as_numbers):
        widest = max(as_numbers, key=lambda t: _WIDTH.index(t.typeName()))
        if isinstance(widest, T.FloatType) or (
            isinstance(widest, T.DoubleType) is False and any(isinstance(t, T.FloatType) for t in as_numbers)
        ):
            return T.DoubleType()
        if widest.typeName() == "double" and any(isinstance(t, T.LongType) for t in as_numbers):
            return T.StringType()  # a double holds no whole number above 2**53 exactly
        return widest
    if all(t.typeName() in _DIGITS or isinstance(t, T.DecimalType) for t in as_numbers):
        scale = max(t.scale for t in as_numbers if isinstance(t, T.DecimalType))
        digits = max(
            t.precision - t.scale if isinstance(t, T.DecimalType) else _DIGITS[t.typeName()] for t in as_numbers
        )
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else T.StringType()
    if all(isinstance(t, (T.DateType, T.TimestampNTZType)) for t in distinct):
        return T.TimestampNTZType()
    if all(isinstance(t, (T.DateType, T.TimestampType)) for t in distinct):
        return T.TimestampType()
    return T.StringType()


def _cast_to(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    def fit(field: T.StructField):
        value = named(field.name)
        wanted = types[field.name]
        if field.dataType == wanted:
            return value
        if isinstance(field.dataType, T.BooleanType) and not isinstance(wanted, T.StringType):
            value = value.cast("int")
        return value.cast(wanted).alias(field.name)

    return df.select(*[fit(field) for field in df.schema.fields])


def unify(
    editions: Mapping[int, DataFrame],
    how: str = "common",
    as_string: bool = False,
    lead: Sequence[str] = ("id", "ano"),
) -> DataFrame:
    """Editions stacked by name, ``lead`` columns first.

    ``common`` keeps the columns every edition has; ``outer`` keeps all, null where an edition
    lacks one. Columns take the widest type among the editions, or text with ``as_string``.
    """
    frames = list(editions.values())
    if how == "common":
        order = common_names([df.columns for df in frames], lead)
    elif how == "outer":
        every = list(dict.fromkeys(name for df in frames for name in df.columns))
        order = [n for n in lead if n in every] + [n for n in every if n not in lead]
    else:
        raise ValueError("how is 'common' or 'outer'")
    types = {
        name: T.StringType()
        if as_string
        else widest_type([df.schema[name].dataType for df in frames if name in df.columns])
        for name in order
    }
    fitted = [_cast_to(df.select(*[named(n) for n in order if n in df.columns]), types) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=how == "outer"), fitted).select(
        *[named(n) for n in order]
    )
