"""Column expressions: flags, safe casts, percentages, text normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import CODE_PREFIX, TUPLE_HEADER, UNSAFE_RUN, accent_table

# Spellings of a ticked and an unticked answer, and the missing category.
TICKED_TEXT = ("1", "1.0", "true", "sim")
UNTICKED_TEXT = ("0", "0.0", "false", "não", "nao")
FLAG_ONLY_TEXT = ("1", "1.0", "true", "0", "0.0", "false")
MISSING_TEXT = "Nao_informado"

NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def named(name: str) -> Column:
    """Column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def flag_int(text: Column) -> Column:
    """Text answer to 1, 0 or null for anything that is no such answer."""
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TICKED_TEXT), 1).when(word.isin(*UNTICKED_TEXT), 0)


def is_ticked(text: Column) -> Column:
    """Whether a text answer says yes; null counts as no in ``count_if`` and ``when``."""
    return F.lower(F.trim(text.cast("string"))).isin(*TICKED_TEXT)


def as_flag(df: DataFrame, name: str) -> Column:
    """A 0/1 answer as an integer, whatever type the edition delivered it in."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return flag_int(named(name))
    if isinstance(dtype, T.NumericType):
        return F.when(named(name).isin(0, 1), named(name).cast("int"))
    return named(name).try_cast("int")


def try_int(value: Column) -> Column:
    """Whole number, or null where the text is none."""
    return value.try_cast("int")


def coerce_number(df: DataFrame, name: str) -> Column:
    """Any column as a double; what is not a number counts as 0."""
    dtype = df.schema[name].dataType
    value = named(name)
    if isinstance(dtype, T.BooleanType):
        value = value.cast("int").cast("double")
    elif isinstance(dtype, T.StringType):
        # The pattern keeps out texts such as '1d' that only a lenient parser reads as numbers.
        word = F.trim(value)
        value = F.when(word.rlike(NUMBER_TEXT), word.try_cast("double"))
    else:
        value = value.cast("double")
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, half-up to one decimal; null for an empty whole."""
    hundred = F.lit("100.0").cast("decimal(4,1)")
    return F.round(F.try_divide(hundred * part, whole), 1).cast("double")


def normalise_text(text: Column) -> Column:
    """The rule of ``normalise_name`` as an expression over data.

    Pure ASCII text, where characters and bytes are equally many, skips the accent step.
    """
    lower = F.lower(text)
    ascii_only = F.char_length(text) == F.octet_length(text)
    plain = F.when(ascii_only, lower).otherwise(F.translate(lower, *accent_table()))
    return F.btrim(F.regexp_replace(plain, UNSAFE_RUN, "_"), F.lit("_"))


def clean_header_text(header: Column) -> Column:
    """The rule of ``clean_header`` as an expression over data."""
    trimmed = F.trim(header)
    label = F.when(trimmed.rlike(TUPLE_HEADER), F.regexp_extract(trimmed, TUPLE_HEADER, 4)).otherwise(trimmed)
    label = F.regexp_replace(F.trim(label), CODE_PREFIX, "")
    return normalise_text(F.replace(label, F.lit("%"), F.lit("pct")))
