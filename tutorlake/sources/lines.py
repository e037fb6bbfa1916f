"""Parsing of raw text lines (column ``value``), for batch and streaming frames alike."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_KEY, BAD_KEY = "__end", "__bad"
# The value of the last member, which no line holds.
END = uuid.uuid4().hex
BLANKS = r"[ \t\r\n]"
# What can stand before the last brace: a blank, or the end of a text, list, object, number, true, false, null, NaN or Infinity.
BEFORE_END = ' \t\r\n"]}{0123456789elNyF'


def json_objects(lines: DataFrame, keys: list[str]) -> DataFrame:
    """One row per line that holds one JSON object and nothing else; one text column per key.

    A key that is missing is null. All values are read as text because the logs write numbers both bare
    and quoted. Malformed text, arrays, scalars, names in single quotes and lines with anything after the
    object, a second object too, are broken lines and dropped. The last brace of a line makes way for one more
    member, so the first object of a line has that member only if its end is the end of the line; what follows an
    object is not read at all. Lines that cannot be objects by their first two or last two characters are not parsed,
    since the parser raises an exception for each. The parse is in a generator, as the optimizer would copy
    a plain column's parse into the filter.
    """
    value, ends, starts = F.col("value"), F.endswith("value", F.lit("}")), F.startswith("value", F.lit('{"'))
    members = ", ".join(f"`{key}`: string" for key in [*keys, END_KEY, BAD_KEY])
    # Bytes are cut at once, characters are counted first.
    held, size = value.cast("binary"), F.octet_length(value)
    before = F.substring(held, size - 1, F.lit(1)).cast("string")
    blank = F.rlike(F.substring(held, size, F.lit(1)).cast("string"), F.lit(BLANKS))
    closed = F.when(ends, F.contains(F.lit(BEFORE_END), before)).otherwise(
        blank & F.rlike(value, F.lit(rf"\}}{BLANKS}+\z"))
    )
    opened = starts | F.rlike(value, F.lit(rf"\A{BLANKS}*\{{{BLANKS}*[\"}}]"))
    cut = F.substring(held, F.lit(1), size - 1).cast("string")
    inside = F.when(ends, cut).otherwise(F.regexp_replace(value, rf"\}}{BLANKS}+\z", ""))
    empty = F.rlike(value, F.lit(rf"\A{BLANKS}*\{{{BLANKS}*\}}{BLANKS}*\z"))
    comma = F.when(starts | ~empty, F.lit(",")).otherwise(F.lit(""))
    framed = F.concat(inside, comma, F.lit(f'"{END_KEY}":"{END}"}}'))
    parsed = F.from_json(
        framed, f"struct<{members}>", {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": BAD_KEY}
    )
    objects = lines.where(closed & opened).select(F.inline(F.array(parsed)))
    whole = objects.where((F.col(END_KEY) == END) & F.col(BAD_KEY).isNull())
    return whole.select(*[F.col(f"`{key}`") for key in keys])


def tab_fields(lines: DataFrame, names: list[str]) -> DataFrame:
    """Lines with exactly ``len(names)`` tab-separated fields; trailing empty fields do not count."""
    trimmed = F.regexp_replace("value", r"\t+$", "")
    parts = lines.select(F.split(trimmed, "\t").alias("parts"))
    right_size = parts.where(F.size("parts") == len(names))
    return right_size.select(*[F.col("parts")[at].alias(name) for at, name in enumerate(names)])
