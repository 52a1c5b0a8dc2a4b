"""Text and number expressions, all native."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as an e-mail address.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def name_part(name: Column, position: int) -> Column:
    """The ``position``-th whitespace-separated word, null when there is none."""
    return F.get(F.split(F.trim(name), r"\s+"), position)


def bucket_label(value: Column, upper_bounds: Sequence[int] = (30, 40, 50, 60)) -> Column:
    """Label of the integer range a number falls into: ``<=30``, ``31-40``, ..., ``61+``; null stays null."""
    label = F.when(value <= upper_bounds[0], f"<={upper_bounds[0]}")
    for lower, upper in zip(upper_bounds, upper_bounds[1:]):
        label = label.when(value <= upper, f"{lower + 1}-{upper}")
    return label.when(value > upper_bounds[-1], f"{upper_bounds[-1] + 1}+")


def contains_ignoring_case(text: Column, part: str) -> Column:
    return F.contains(F.lower(text), F.lit(part.lower()))


def is_email(text: Column) -> Column:
    return text.rlike(EMAIL_PATTERN)


def first_non_empty(*choices: Column) -> Column:
    """First choice that is neither null nor blank after trimming."""
    return F.coalesce(*[F.nullif(F.trim(choice), F.lit("")) for choice in choices])


def plain_number(text: Column, suffixes: Sequence[str] = ()) -> Column:
    """Text of a displayed amount without thousands separators and unit suffixes, trimmed."""
    cleaned = F.replace(text, F.lit(","), F.lit(""))
    for suffix in suffixes:
        cleaned = F.replace(cleaned, F.lit(suffix), F.lit(""))
    return F.trim(cleaned)


def money(value: Column) -> Column:
    """Two decimals, as a double."""
    return F.round(value, 2).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; null, not an error, when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def object_name(key: Column, seconds: Column) -> Column:
    """``{key}-{epoch seconds}.json``."""
    return F.concat(F.concat_ws("-", key, seconds.cast("string")), F.lit(".json"))
