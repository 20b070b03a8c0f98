"""Small per-field rules shared by load, ingest and restore."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def is_missing(value: Column, dtype: T.DataType) -> Column:
    """Null, empty text or zero. Blank text counts as present."""
    empty = F.lit("") if isinstance(dtype, T.StringType) else F.lit(0)
    return value.isNull() | (value == empty)


def too_long(value: Column, limit: int) -> Column:
    return F.coalesce(F.char_length(value) > limit, F.lit(False))


def to_nullable_int(value: Column, dtype: str = "int") -> Column:
    """Whole number or null; NaN and text that is no number give null."""
    return value.try_cast(dtype)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


WHOLE_NUMBER_TEXT = r"^[+-]?\d+(\.0*|\.?\d*[eE]\+?\d+)?$"


def is_whole_text(text: Column) -> Column:
    """Whether a text is a number without fraction, of any size; null counts as none."""
    number = F.trim(text).try_cast("decimal(38,6)")
    return F.coalesce(F.trim(text).rlike(WHOLE_NUMBER_TEXT) & (number.isNull() | (number == F.floor(number))), F.lit(False))


def whole_number(text: Column) -> Column:
    """A number without fraction as bigint; null when the text is none or is beyond 64 bits."""
    number = F.trim(text).try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number).try_cast("bigint")


def first_failure(*rules: tuple[Column, str]) -> Column:
    """Code of the first rule that fires, null when none does."""
    return F.coalesce(*[F.when(broken, F.lit(code)) for broken, code in rules], F.lit(None).cast("string"))
