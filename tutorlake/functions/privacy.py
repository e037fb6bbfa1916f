"""Masking of personal fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts a reader of the cleaned tables sees in place of personal data.
NAME_TAIL = "xx"
PHONE_MIDDLE = "*****"
PASSWORD_TEXT = "******"


def mask_name(name: Column) -> Column:
    """First character kept, null stays null."""
    return F.concat(F.left(name, F.lit(1)), F.lit(NAME_TAIL))


def mask_phone(phone: Column) -> Column:
    """Positions 1-3 and 8-11 kept; a number too short for that is masked completely."""
    kept = F.concat(F.left(phone, F.lit(3)), F.lit(PHONE_MIDDLE), F.substring(phone, 8, 4))
    return F.when(F.length(phone) >= 11, kept).when(phone.isNotNull(), F.lit(PHONE_MIDDLE))


def redacted_password() -> Column:
    return F.lit(PASSWORD_TEXT)
