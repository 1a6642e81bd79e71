"""Text cleaning and text formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import NULL_TOKENS

_MARK = "\u0001 "


def title_words(text: Column) -> Column:
    """Capitalise every run of letters and digits: ``non-fiction`` -> ``Non-Fiction``.

    ``initcap`` starts words at spaces only, so each separator gets a marked
    space first and the marks are taken out again. Unlike a lambda over split
    words this stays in generated code.
    """
    spaced = F.regexp_replace(text, r"([^\p{L}\p{N}])", "$1" + _MARK)
    return F.replace(F.initcap(spaced), F.lit(_MARK), F.lit(""))


def null_tokens(text: Column) -> Column:
    """NULL for the cell texts that CSV sources use for a missing value."""
    return F.when(~text.isin(*NULL_TOKENS), text)


def file_extension(name: Column) -> Column:
    """Last suffix of a file name, lower-cased, with its dot; '' if there is none."""
    return F.lower(F.regexp_extract(name, r"[^.](\.[^.]*)$", 1))


def file_stem(name: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def plain_text(value: Column, dtype: T.DataType) -> Column:
    """Text of a typed value in the raw layer's format.

    Booleans read ``True``/``False``. Floating point numbers keep a decimal
    point and use exponents only from 1e16 up and below 1e-4.
    """
    if isinstance(dtype, T.BooleanType):
        return F.initcap(value.cast("string"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _float_text(value)
    if isinstance(dtype, T.BinaryType):
        return F.decode(value, "UTF-8")
    return value.cast("string")


def _float_text(value: Column) -> Column:
    shown = value.cast("string")
    mantissa = F.regexp_extract(shown, r"^(.*)E", 1)
    exponent = F.regexp_extract(shown, r"E(-?\d+)$", 1).try_cast("int")
    size = F.abs(value)
    # Exact decimal of the shown digits; trailing zeros go, one digit stays.
    unrolled = F.regexp_replace(
        F.regexp_replace(shown.try_cast("decimal(38,21)").cast("string"), r"0+$", ""), r"\.$", ".0"
    )
    scientific = F.concat(
        F.regexp_replace(mantissa, r"\.0$", ""),
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")),
    )
    return (
        F.when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when(~shown.contains("E"), shown)
        .when((size >= 1e-4) & (size < 1e16), unrolled)
        .otherwise(scientific)
    )
