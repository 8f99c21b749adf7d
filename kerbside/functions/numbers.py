"""Text to number, as strict as a Python ``int()`` or ``float()`` call. Bad text gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted number formats. A plain cast would also take "3d" or "1f".
INT_TEXT = r"^\s*[+-]?[0-9]+\s*\z"
FLOAT_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
NAN_TEXT = r"(?i)^\s*[+-]?nan\s*\z"
INFINITY_TEXT = r"(?i)^\s*[+-]?inf(inity)?\s*\z"


def parse_int(text: Column) -> Column:
    return F.when(text.rlike(INT_TEXT), text.try_cast("bigint"))


def parse_float(text: Column) -> Column:
    """Not-a-number and the infinities are numbers here; the grid functions refuse them later."""
    return (
        F.when(text.rlike(FLOAT_TEXT), text.try_cast("double"))
        .when(text.rlike(NAN_TEXT), F.lit(float("nan")))
        .when(text.rlike(INFINITY_TEXT), text.try_cast("double"))
    )
