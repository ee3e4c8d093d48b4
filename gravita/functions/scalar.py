"""Rounding, text and lookup expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(x: Column) -> Column:
    """Nearest integer, halves to the even one."""
    return F.rint(x).cast("long")


def first_filled(*columns: Column) -> Column:
    """First value that is neither null nor empty after trimming."""
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in columns))


def required(x: Column, message: str) -> Column:
    """The value, or an error that names what is missing."""
    return F.when(x.isNull(), F.raise_error(F.lit(message)).cast("string")).otherwise(x)


def try_double(name: str) -> Column:
    return F.expr(f"try_cast(`{name}` as double)")


def coerced(name: str) -> Column:
    """A text column as a number; what is none, null or NaN counts as 0."""
    return F.coalesce(F.nanvl(try_double(name), F.lit(0.0)), F.lit(0.0))


def digits(x: Column) -> Column:
    """The digits of a text as a number; 0 if there are none."""
    return F.coalesce(F.nullif(F.regexp_replace(x, "[^0-9]", ""), F.lit("")).cast("long"), F.lit(0).cast("long"))


def census_id(x: Column) -> Column:
    """Whether a text is a census id of nine digits."""
    return x.rlike("^[0-9]{9}$")


def release_tag(x: Column) -> Column:
    """Whether a text is a release tag, date and revision."""
    return x.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}\\.[0-9]+$")


def weights_map(weights: Mapping[str, float]) -> Column:
    return F.create_map(*[F.lit(v) for pair in weights.items() for v in pair])


def padded(prefix: str, width: int, x: Column) -> Column:
    """An id such as work_000042. Longer numbers keep all their digits."""
    number = x.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(number) < width, F.lpad(number, width, "0")).otherwise(number))


def little_endian(data: Column, at: int, size: int) -> Column:
    """Unsigned integer from bytes of a binary column; ``at`` counts from 1."""
    byte = lambda i: F.conv(F.hex(F.substring(data, at + i, 1)), 16, 10).cast("long")
    out = byte(0)
    for i in range(1, size):
        out = out + byte(i) * F.lit(1 << (8 * i)).cast("long")
    return out


def stripped(column: str) -> Column:
    """Without white space at either end."""
    return F.btrim(F.col(column), F.lit(" \t\n\r\x0b\x0c"))
