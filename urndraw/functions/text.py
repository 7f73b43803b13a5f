"""String helpers that keep leading zeros and never raise on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_pad(value: Column, width: Column | int) -> Column:
    """Left-pad with zeros; a longer value stays whole (plain ``lpad`` would cut it)."""
    text = value.cast("string")
    width = F.lit(width) if isinstance(width, int) else width
    return F.lpad(text, F.greatest(width.cast("int"), F.length(text)), F.lit("0"))


def tail_2d(text: Column) -> Column:
    return F.right(text, F.lit(2))


def is_digits(text: Column, width: int | None = None) -> Column:
    return text.rlike("^[0-9]+$" if width is None else f"^[0-9]{{{width}}}$")


def is_placeholder(text: Column) -> Column:
    return text.rlike("^[.]+$")


def has_width(text: Column, width: Column) -> Column:
    return is_digits(text) & (F.length(text) == width)


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normal_name(text: Column) -> Column:
    return F.lower(collapse_spaces(text))


def digit_sum(text: Column) -> Column:
    """Sum of the digits of a short digit string."""
    total = F.lit(0).cast("long")
    for digit in range(1, 10):
        hits = F.length(text) - F.length(F.replace(text, F.lit(str(digit)), F.lit("")))
        total = total + hits.cast("long") * digit
    return total


