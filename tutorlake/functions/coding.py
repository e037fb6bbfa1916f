"""Code-to-label mappings and score bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Registration sources of the member log, and platforms of the registration stream.
REGISTER_SOURCES = {"1": "PC", "2": "Mobile", "3": "App", "4": "WeChat"}
REGISTER_SOURCE_DEFAULT = "other"
PLATFORMS = {"1": "PC", "2": "APP"}
PLATFORM_DEFAULT = "Other"

# Lower and upper bounds of the score bands. The first band includes its lower bound.
BANDS = [(0, 20), (20, 40), (40, 60), (60, 80), (80, 100)]
PASS_MARK = 60
FULL_MARK = 100


def label_code(code: Column, labels: dict[str, str], default: str) -> Column:
    """The label of ``code``; unknown and null codes get ``default``."""
    expr = F
    for key, label in labels.items():
        expr = expr.when(code == key, label)
    return expr.otherwise(default)


def register_source(code: Column) -> Column:
    return label_code(code, REGISTER_SOURCES, REGISTER_SOURCE_DEFAULT)


def platform(code: Column) -> Column:
    return label_code(code, PLATFORMS, PLATFORM_DEFAULT)


def score_band(score: Column) -> Column:
    """The band name, such as ``20-40``; null outside all bands."""
    expr = F
    for number, (low, high) in enumerate(BANDS):
        above = score >= low if number == 0 else score > low
        expr = expr.when(above & (score <= high), f"{low}-{high}")
    return expr


def failed(score: Column) -> Column:
    return score.between(0, PASS_MARK)


def passed(score: Column) -> Column:
    return (score > PASS_MARK) & (score <= FULL_MARK)
