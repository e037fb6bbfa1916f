"""Numeric helpers. All casts are the null-on-failure kind, since ANSI mode raises otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_or_zero(text: Column) -> Column:
    """A whole number of 64 bits from text; fractions are cut off.

    Missing or unreadable text is 0. A number that is too large for 64 bits is null, so it is neither
    lost from sight nor taken for the id 0.
    """
    whole = text.try_cast("bigint")
    number = text.try_cast("double")
    cut = F.when(number.isNull(), F.lit(0)).otherwise(text.try_cast("decimal(38,6)").try_cast("bigint"))
    return F.coalesce(whole, cut.cast("bigint"))


def tenth(text: Column, precision: int = 10) -> Column:
    """A decimal with one fraction digit, rounded half up; null when unreadable."""
    return text.try_cast(f"decimal({precision},1)")


# Amounts and their sums have four fraction digits. 18 digits still fit a machine word.
MONEY = "decimal(18,4)"
MONEY_SUM = "decimal(28,4)"


def money(text: Column) -> Column:
    """An amount from its text in the warehouse; null when unreadable."""
    return text.try_cast(MONEY)


def share(part: Column, rest: Column) -> Column:
    """part / (part + rest) with two fraction digits, null for an empty whole."""
    return F.try_divide(part, part + rest).cast("decimal(4,2)")


def whole_units(start_ms: Column, end_ms: Column, unit_ms: int = 1000) -> Column:
    """Whole units of time between two epoch-millisecond marks."""
    return F.call_function("div", end_ms - start_ms, F.lit(unit_ms).cast("bigint"))


def percent_text(ratio: Column) -> Column:
    """A ratio as percent text without fraction digits, ties to the even digit; null as ``0%``."""
    percent = F.bround(ratio * 100, 0).cast("bigint").cast("string")
    return F.concat(F.coalesce(percent, F.lit("0")), F.lit("%"))


def ipv4_number(address: Column) -> Column:
    """A dotted address as one number; null when it is not four parts of 0-255."""
    parts = F.split(address, r"\.")
    octets = [F.get(parts, F.lit(at)).try_cast("int") for at in range(4)]
    valid = F.size(parts) == 4
    number = F.lit(0).cast("bigint")
    for octet in octets:
        valid = valid & octet.between(0, 255)
        number = number * 256 + octet
    return F.when(valid, number)
